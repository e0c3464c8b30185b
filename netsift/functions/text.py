"""Scalar and array functions on strings, as SQL fragments over an expression: native columns, no UDF."""

from __future__ import annotations

VOWELS, CONSONANTS, HEX = "aeiouyAEIOUY", "bcdfghjklmnpqrstvwxyz", "0-9A-Fa-f"


def let(value: str, name: str, body: str) -> str:
    """body with name for value, which is computed once; a lambda's variable is what SQL has for that."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def chars(s: str) -> str:
    """Array of the characters of s."""
    return f"regexp_extract_all({s}, '(?s).', 0)"


def entropy_of(a: str) -> str:
    """Shannon entropy in bits of the values of array a; 0 for an empty one. Quadratic in the distinct values."""
    each = "cast(size(filter(_e, y -> y <=> x)) as double) / size(_e)"
    return let(a, "_e", f"if(size(_e) > 0, abs(aggregate(transform(array_distinct(_e), x -> {each}), 0D, (z, p) -> z - p * log2(p))), 0D)")


def norm_entropy(s: str) -> str:
    """Character entropy divided by the length of s; 0 for an empty string. Meant for names, not for long texts.

    A character is counted by what s is shorter without it: one native pass for each distinct one, no lambda for each pair.
    """
    share = "(length(_s) - length(replace(_s, c, ''))) / length(_s)"
    return let(s, "_s", f"if(length(_s) > 0, abs(aggregate(transform(array_distinct(split(_s, '')), c -> {share}), 0D, (z, p) -> z - p * log2(p))) / length(_s), 0D)")


def count_class(s: str, cls: str) -> str:
    """How many characters of s are in the regex class."""
    return f"length(regexp_replace({s}, '[^{cls}]', ''))"


def ratio(part: str, whole: str) -> str:
    return f"if({whole} > 0, {part} / {whole}, 0D)"


def simhash32(s: str) -> str:
    """32-bit similarity hash over characters: a bit is set if at least half of the characters' md5 have it set.

    An empty string gives 4294967295.
    """
    low = f"transform({chars(s)}, x -> cast(conv(substr(md5(x), 25, 8), 16, 10) as bigint))"
    vote = "aggregate(_m, 0, (k, x) -> k + if((shiftright(x, i) & 1) = 1, 1, -1))"
    return let(low, "_m", f"aggregate(sequence(0, 31), 0L, (z, i) -> z + if({vote} >= 0, shiftleft(1L, i), 0L))")


def md5_mod(s: str) -> str:
    """md5 of s as a number modulo 2147483647, by Horner's rule over four 32-bit parts."""
    out = "0L"
    for i in range(4):
        out = f"(({out} * 4294967296L + cast(conv(substr(_h, {i * 8 + 1}, 8), 16, 10) as bigint)) % 2147483647L)"
    return let(f"md5({s})", "_h", out)


def longest_match(s: str, pattern: str) -> str:
    return f"coalesce(array_max(transform(regexp_extract_all({s}, '{pattern}', 0), x -> length(x))), 0)"


def longest_run(s: str) -> str:
    """Length of the longest run of one character."""
    return longest_match(s, r"(?s)(.)\\1*")


def contains_count(s: str, words: tuple[str, ...]) -> str:
    """How many of the words s contains, each counted once."""
    listed = ", ".join(f"'{w}'" for w in words)
    return f"size(filter(array({listed}), w -> contains({s}, w)))"


def any_suffix(s: str, suffixes: tuple[str, ...]) -> str:
    return f"cast({' or '.join(f'''endswith({s}, '{x}')''' for x in dict.fromkeys(suffixes))} as int)"


def ngrams(s: str, n: int) -> str:
    """Distinct n-grams of s."""
    return f"array_distinct(transform(sequence(1, greatest(length({s}) - {n - 1}, 1)), i -> substr({s}, i, {n})))"


def ipv4_inside(s: str) -> str:
    """Whether s holds a dotted or dashed IPv4 address anywhere."""
    octet = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
    return f"({s} rlike '(?:{octet}[.]){{3}}{octet}' or {s} rlike '(?:{octet}-){{3}}{octet}')"


# Arrays of numbers -----------------------------------------------------------------------------------------------


def mean_of(a: str, default: str = "0D") -> str:
    return f"if(size({a}) > 0, aggregate({a}, 0D, (z, x) -> z + x) / size({a}), {default})"


def stddev_of(a: str, default: str = "0D") -> str:
    """Population standard deviation; default for at most one value."""
    spread = let(f"aggregate({a}, 0D, (z, x) -> z + x) / size({a})", "_mean", f"sqrt(aggregate({a}, 0D, (z, x) -> z + (x - _mean) * (x - _mean)) / size({a}))")
    return f"if(size({a}) > 1, {spread}, {default})"


def mode_share(a: str) -> str:
    """The most frequent value's share of array a; 0 for an empty one."""
    return f"if(size({a}) > 0, array_max(transform(array_distinct({a}), x -> size(filter({a}, y -> y = x)))) / size({a}), 0D)"


def share_between(a: str, low: int, high: int) -> str:
    """The share of values in [low, high)."""
    return f"size(filter({a}, x -> x >= {low} and x < {high})) / size({a})"


def sorted_distinct(a: str) -> str:
    return f"array_sort(array_distinct({a}))"


def weighted_rtt(a: str) -> str:
    """Mean of avg weighted by received over the structs of status 0; 0 if they received nothing."""
    ok = f"filter({a}, x -> x.status_code = 0)"
    total = f"aggregate({ok}, 0D, (z, x) -> z + x.received)"
    return f"coalesce(if({total} > 0, aggregate({ok}, 0D, (z, x) -> z + x.avg * x.received) / {total}, 0D), 0D)"


def ip_prefix(ip: str) -> str:
    """IPv4: the first two octets as a number; IPv6: the first eight bytes in hex. Only equality matters."""
    v4 = f"cast(cast(split_part({ip}, '.', 1) as int) * 256 + cast(split_part({ip}, '.', 2) as int) as string)"
    head = f"if(contains({ip}, '::'), split_part({ip}, '::', 1), {ip})"
    groups = f"filter(split({head}, ':'), x -> x <> '')"
    tail = f"if(contains({ip}, '::'), filter(split(split_part({ip}, '::', 2), ':'), x -> x <> ''), cast(array() as array<string>))"
    full = f"concat({groups}, array_repeat('0', greatest(8 - size({groups}) - size({tail}), 0)), {tail})"
    return f"if(contains({ip}, ':'), array_join(transform(slice({full}, 1, 4), x -> lpad(lower(x), 4, '0')), ''), {v4})"
