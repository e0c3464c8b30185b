"""Status codes of collector results (fixed values)."""

OK, INVALID_MESSAGE, INVALID_DOMAIN_NAME, INVALID_ADDRESS, UNSUPPORTED_ADDRESS, INTERNAL_ERROR, DISABLED = range(7)
CANNOT_FETCH, TIMEOUT, NOT_FOUND, RATE_LIMITED, INVALID_RESPONSE, LOCAL_RATE_LIMIT, LRL_TIMEOUT = range(10, 17)
OTHER_DNS_ERROR, NO_ENDPOINT, WHOIS_NOT_PERFORMED, ICMP_DEST_UNREACHABLE, ICMP_TIME_EXCEEDED = 20, 30, 35, 40, 41
