"""Registered queries of nested-record features, conversions, the stream and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.operators import extract as ex
from netsift.operators import records as rec
from netsift.operators import routing as ro
from netsift.operators import scoring as sc
from netsift.operators import stored as st

from .features import _duck_simhash, read, rounded

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def flat(spark, sf_dir, with_items=False):
    """A flat record for each order: its line items as records, addresses, places and certificates."""
    item = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("q"), F.col("l_extendedprice").cast("double").alias("p"), F.col("l_discount").cast("double").alias("d"),
        F.expr("case pmod(l_partkey, 4) when 0 then 'AIR' when 1 then 'MAIL' when 2 then 'SHIP' else 'RAIL' end").alias("l_shipmode"), "l_returnflag", F.col("l_shipdate").cast("date").alias("ship"),
    )
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("i"))
    ip = "concat('10.', x.l_suppkey % 4, '.', x.l_partkey % 256, '.1')"
    cert = "named_struct('not_before', timestamp(x.ship), 'not_after', timestamp(date_add(x.ship, cast(x.q as int) * 20)), 'issuer_org', x.l_shipmode, 'issuer_cn', x.l_shipmode, 'extensions', array(named_struct('oid', '2.5', 'critical', x.q > 25)), 'san', array(concat('n', x.l_partkey)), 'eku', array('serverAuth'), 'policies', if(x.l_returnflag = 'N', array('2.1'), array('1.1')), 'is_ca', x.q > 30, 'aki', 'a', 'ski', if(x.q > 40, 'a', 'b'))"
    return rows.selectExpr(
        *["i"] * with_items, "l_orderkey", "concat('d', l_orderkey, '.com') as domain_name", "concat('zone', l_orderkey % 7, '.example.com') as dns_zone", "transform(i, x -> x.q) as dns_ttls",
        "transform(filter(i, x -> x.l_returnflag = 'N'), x -> x.l_shipmode) as dns_A", "if(l_orderkey % 2 = 0, transform(i, x -> x.l_shipmode), null) as dns_AAAA", "transform(i, x -> x.l_shipmode) as dns_NS",
        "transform(i, x -> if(x.l_returnflag = 'R', '', concat('ms=', x.l_shipmode))) as dns_TXT", "transform(i, x -> named_struct('name', x.l_shipmode)) as dns_MX", "cast(null as struct<value:string>) as dns_CNAME",
        "if(l_orderkey % 3 = 0, named_struct('primary_ns', 'ns1.example.com', 'resp_mailbox_dname', 'host1.ns.example.com', 'refresh', l_orderkey, 'retry', 2L, 'expire', 3L, 'min_ttl', 4L), null) as dns_SOA",
        "named_struct('primary_ns', 'ns.zone.com', 'resp_mailbox_dname', 'm.zone.com', 'refresh', 1L, 'retry', 2L, 'expire', 3L, 'min_ttl', 4L) as dns_zone_SOA", "named_struct('spf', true, 'dkim', false, 'dmarc', l_orderkey % 2 = 0) as dns_email_extras",
        f"transform(i, x -> named_struct('ip', {ip}, 'from_record', if(x.l_returnflag = 'N', 'A', 'MX'), 'average_rtt', if(x.q > 10, x.p, null), 'asn', x.l_suppkey % 5, 'as_address', concat('n', x.l_suppkey % 3), 'rdap', named_struct('ip_version', '4', 'prefix_len', cast(x.q as int), 'admin_name', x.l_shipmode, 'admin_email', cast(null as string)))) as ip_data",
        "transform(i, x -> x.l_shipmode) as countries", "transform(i, x -> x.d) as latitudes", "transform(i, x -> x.p) as longitudes", f"named_struct('protocol', 'TLSv1.2', 'cipher', 'AES128-SHA', 'certs', transform(i, x -> {cert})) as tls",
        "timestamp(i[0].ship) as rdap_registration_date", "timestamp(date_add(i[0].ship, 365)) as rdap_expiration_date", "timestamp(date_add(i[0].ship, 30)) as rdap_last_changed_date", "l_orderkey % 2 = 0 as rdap_dnssec",
        "map('registrar', array(named_struct('name', i[0].l_shipmode, 'email', cast(null as string))), 'registrant', array(named_struct('name', 'Some One', 'email', cast(null as string)))) as rdap_entities",
    )


_I = "WITH i AS (SELECT l_orderkey, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS q, l_extendedprice::DOUBLE AS p, l_discount::DOUBLE AS d, CASE l_partkey % 4 WHEN 0 THEN 'AIR' WHEN 1 THEN 'MAIL' WHEN 2 THEN 'SHIP' ELSE 'RAIL' END AS m, l_returnflag AS f, l_suppkey AS s, l_partkey AS k, l_shipdate::DATE AS ship FROM lineitem), g AS (SELECT l_orderkey, list(q) AS qs, list(m) AS ms, list(p) AS ps, list(d) AS ds, list(f) AS fs, list(s % 5) AS asn, list(s % 3) AS nets, count(*)::INTEGER AS c, list(s % 4 * 1) AS pre, list(CASE WHEN f = 'R' THEN '' ELSE 'ms=' || m END) AS ts FROM i GROUP BY 1)"


def _each(f: str, a: str = "ms") -> str:
    return f"list_transform({a}, lambda x: {f})"


def _entropy(x: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN list_entropy(string_split({x}, '')) / length({x}) ELSE 0 END"


def _name_columns(x: str, prefix: str, level: str) -> str:
    return f"""{level} AS {prefix}_level, length(regexp_replace({x}, '[^0-9]', '', 'g'))::INTEGER AS {prefix}_digit_count, length({x})::INTEGER AS {prefix}_len, round({_entropy(x)}, 9) AS {prefix}_entropy"""


@query(
    _I + f""", n AS (SELECT *, 'zone' || l_orderkey % 7 || '.example.com' AS zone, CASE WHEN l_orderkey % 3 = 0 THEN 'ns1.example.com' ELSE 'ns.zone.com' END AS ns, CASE WHEN l_orderkey % 3 = 0 THEN 'host1.ns.example.com' ELSE 'm.zone.com' END AS mail, list_filter(ts, lambda x: x <> '') AS own FROM g)
    SELECT l_orderkey, len(list_filter(fs, lambda x: x = 'N'))::INTEGER AS "dns_A_count", CASE WHEN l_orderkey % 2 = 0 THEN c ELSE 0 END AS "dns_AAAA_count", c AS "dns_MX_count", c AS "dns_NS_count", c AS "dns_TXT_count", (l_orderkey % 3 = 0)::INTEGER AS "dns_SOA_count", 0 AS "dns_CNAME_count",
    0::DOUBLE AS dns_dnssec_score, 4 + (l_orderkey % 2 = 0)::INTEGER + (l_orderkey % 3 = 0)::INTEGER AS dns_resolved_record_types, {_name_columns("zone", "dns_zone", "1")},
    round(list_avg(qs), 9) AS dns_ttl_avg, round(CASE WHEN c > 1 THEN list_stddev_pop(qs) ELSE 0 END, 9) AS dns_ttl_stdev, 1::DOUBLE AS dns_ttl_low, 0::DOUBLE AS dns_ttl_mid, len(list_distinct(qs))::INTEGER AS dns_ttl_distinct_count,
    {_name_columns("ns", "dns_soa_primary_ns", "1")}, {_name_columns("mail", "dns_soa_email", "1 + (l_orderkey % 3 = 0)::INTEGER")}, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey ELSE 1 END AS dns_soa_refresh, 2::BIGINT AS dns_soa_retry, 3::BIGINT AS dns_soa_expire, 4::BIGINT AS dns_soa_min_ttl,
    false AS dns_domain_name_in_mx, round(list_avg({_each("length(x)")}), 9) AS dns_mx_avg_len, round(list_avg({_each(_entropy("x"))}), 9) AS dns_mx_avg_entropy, round(list_avg({_each("length(x)", "ts")}), 9) AS dns_txt_avg_len, round(CASE WHEN len(own) > 0 THEN list_avg({_each(_entropy("x"), "own")}) END, 9) AS dns_txt_avg_entropy,
    len(own)::INTEGER AS dns_txt_external_verification_score, 1 AS dns_txt_spf_exists, 0 AS dns_txt_dkim_exists, (l_orderkey % 2 = 0)::INTEGER AS dns_txt_dmarc_exists FROM n"""
)
def dns_features(spark, sf_dir):
    out = rec.dns_features(flat(spark, sf_dir))
    raw = set(rec.RAW_COLUMNS)
    return rounded(out.select("l_orderkey", *[c for c in out.columns if c.startswith("dns_") and c not in raw]))


@query(
    _I + """, r AS (SELECT l_orderkey, avg(p) FILTER (WHERE q > 10) AS rtt FROM i GROUP BY 1) SELECT l_orderkey, c AS ip_count, round(coalesce(rtt, -1) + 1e-7, 4) AS ip_mean_average_rtt, 1.0::DOUBLE AS ip_v4_ratio, round(len(list_filter(fs, lambda x: x = 'N')) / c, 9) AS ip_a_aaaa_to_all_ratio,
    round(list_entropy(pre), 9) AS ip_entropy, round(list_entropy(nets), 9) AS ip_as_address_entropy, round(list_entropy(asn), 9) AS ip_asn_entropy, len(list_distinct(asn))::INTEGER AS ip_distinct_as_count FROM g JOIN r USING (l_orderkey)"""
)
def ip_features(spark, sf_dir):
    out = rec.ip_features(flat(spark, sf_dir)).select("l_orderkey", "ip_count", F.round(F.col("ip_mean_average_rtt") + 1e-7, 4).alias("ip_mean_average_rtt"), "ip_v4_ratio", "ip_a_aaaa_to_all_ratio", "ip_entropy", "ip_as_address_entropy", "ip_asn_entropy", "ip_distinct_as_count")
    return rounded(out)


_COUNTRIES = {"AIR": 187, "MAIL": 24, "SHIP": 3, "RAIL": 4}
_IDS = f"list_sort(list_distinct({_each('CASE x ' + ' '.join(f"WHEN '{k}' THEN {v}" for k, v in _COUNTRIES.items()) + ' END')}))"


def _places(a: str, name: str) -> str:
    low, high = f"list_min({a})", f"list_max({a})"
    return f"""round(CASE WHEN c > 1 THEN list_stddev_pop({a}) ELSE 0 END + 1e-7, 5) AS geo_{name}_stdev, round(list_avg({a}), 9) AS geo_mean_{name}, {low} AS geo_min_{name}, {high} AS geo_max_{name}, round({high} - {low}, 9) AS geo_{name}_range, round({low} + {high} / 2, 9) AS geo_centroid_{name}"""


@query(
    _I + f""" SELECT l_orderkey, len(list_distinct(ms))::INTEGER AS geo_countries_count, 1 AS geo_continents_count, {_places("ds", "lat")}, {_places("ps", "lon")}, round((list_max(ds) - list_min(ds)) * (list_max(ps) - list_min(ps)) + 1e-7, 5) AS geo_estimated_area, 0 AS geo_continent_hash,
    list_reduce(list_prepend(0::BIGINT, {_IDS}), lambda z, x: (z + x) * CASE WHEN x > 4 THEN 2 ELSE 1 END) % 2147483647 AS geo_countries_hash, (len(list_filter(list_distinct(ms), lambda x: x IN ('AIR', 'MAIL'))) > 0)::INTEGER AS geo_malic_host_country FROM g"""
)
def geo_features(spark, sf_dir):
    out = rec.geo_features(flat(spark, sf_dir), country_ids(spark))
    near = ("geo_lat_stdev", "geo_lon_stdev", "geo_estimated_area")
    out = out.select("l_orderkey", *[F.round(F.col(c) + 1e-7, 5).alias(c) if c in near else F.col(c) for c in out.columns if c.startswith("geo_")])
    return rounded(out)


def country_ids(spark):
    return spark.sql(f"SELECT * FROM VALUES {', '.join(f"('{k}', {v})" for k, v in _COUNTRIES.items())} AS t(country, id)")


AS_OF = "timestamp '1998-09-01'"


def _md5(x: str) -> str:
    return f"list_reduce([0::BIGINT, 0, 1, 2, 3], lambda z, i: (z * 4294967296 + CAST('0x' || substr(md5({x}), (i * 8 + 1)::INTEGER, 8) AS BIGINT)) % 2147483647)"


_OK, _FIRST = "stop IS NULL OR r < stop", "r = 1 AND (stop IS NULL OR stop > 1)"
_CHAIN = """, o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n, k, s, q, p, d, m, f, ship) AS r, date_diff('day', DATE '1998-09-01', ship + CAST(q * 20 AS INTEGER)) < 0 AS bad FROM i),
    st AS (SELECT l_orderkey, count(*) AS c, min(r) FILTER (WHERE bad) AS stop FROM o GROUP BY 1)"""
TLS_COLUMNS = f"""max(c)::INTEGER AS tls_chain_len, true AS tls_has_tls, coalesce(max((q > 40)::INTEGER) FILTER (WHERE {_FIRST}), 0) AS tls_is_self_signed, {_md5(f"coalesce(max(m) FILTER (WHERE r = c AND c > 1 AND stop IS NULL), '')")} AS tls_root_authority_hash, {_md5(f"coalesce(max(m) FILTER (WHERE {_FIRST}), '')")} AS tls_leaf_authority_hash,
    2 AS tls_negotiated_version_id, 13 AS tls_negotiated_cipher_id, coalesce(max(q * 20) FILTER (WHERE r = c AND c > 1 AND stop IS NULL), -1) AS tls_root_cert_validity_len, coalesce(max(q * 20) FILTER (WHERE {_FIRST}), -1) AS tls_leaf_cert_validity_len, 0 AS tls_broken_chain, max(stop IS NOT NULL)::INTEGER AS tls_expired_chain,
    (count(*) FILTER (WHERE {_OK}) - 1)::INTEGER AS tls_total_extension_count, (count(*) FILTER (WHERE q > 25 AND ({_OK})) - 1)::INTEGER AS tls_critical_extensions, (count(*) FILTER (WHERE {_OK}))::INTEGER AS tls_with_policies_crt_count, round(count(*) FILTER (WHERE {_OK}) / max(coalesce(stop, c)), 9) AS tls_percentage_crt_with_policies,
    0 AS tls_x509_anypolicy_crt_count, (count(*) FILTER (WHERE f <> 'N' AND ({_OK})))::INTEGER AS tls_iso_policy_crt_count, (count(*) FILTER (WHERE f = 'N' AND ({_OK})))::INTEGER AS tls_joint_isoitu_policy_crt_count, (count(*) FILTER (WHERE {_OK}) > 0)::INTEGER AS tls_subject_count, (count(*) FILTER (WHERE {_OK}))::INTEGER AS tls_server_auth_crt_count, 0 AS tls_client_auth_crt_count,
    round(count(*) FILTER (WHERE q > 30 AND ({_OK})) / max(coalesce(stop, c)), 9) AS "tls_CA_certs_in_chain_ratio", (count(DISTINCT k) FILTER (WHERE {_OK}))::INTEGER AS "tls_unique_SLD_count", (count(*) FILTER (WHERE {_OK}))::INTEGER AS tls_common_name_count"""


@query(_I + _CHAIN + f" SELECT l_orderkey, {TLS_COLUMNS} FROM o JOIN st USING (l_orderkey) GROUP BY 1")
def tls_features(spark, sf_dir):
    out = rec.tls_features(flat(spark, sf_dir), F.expr(AS_OF))
    return rounded(out.select("l_orderkey", *[c for c in out.columns if c.startswith("tls_")]))


RDAP_COLUMNS = f"""525600.0::DOUBLE AS rdap_registration_period, greatest(date_diff('day', ship, DATE '1998-09-01'), 0)::DOUBLE AS rdap_domain_age, greatest(date_diff('day', ship + 30, DATE '1998-09-01'), 0)::DOUBLE AS rdap_time_from_last_change,
    greatest(least(date_diff('day', ship, DATE '1998-09-01'), 365), 0)::DOUBLE AS rdap_domain_active_time, l_orderkey % 2 = 0 AS rdap_has_dnssec, length(m)::INTEGER AS rdap_registrar_name_len, round({_entropy("m")}, 9) AS rdap_registrar_name_entropy, {_duck_simhash("m")} AS rdap_registrar_name_hash,
    8 AS rdap_registrant_name_len, round(list_entropy(string_split('Some One', '')) / 8, 9) AS rdap_registrant_name_entropy, 0 AS rdap_admin_name_len, 0::DOUBLE AS rdap_admin_name_entropy, 0 AS rdap_admin_email_len, round(list_entropy(string_split('Some One', '')) / 8, 9) AS rdap_admin_email_entropy"""


@query(_I + f""", o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n, k, s, q, p, d, m, f, ship) AS r FROM i) SELECT l_orderkey, {RDAP_COLUMNS} FROM o WHERE r = 1""")
def rdap_features(spark, sf_dir):
    out = rec.rdap_features(flat(spark, sf_dir), F.expr(AS_OF))
    return rounded(out.select("l_orderkey", *[c for c in out.columns if c.startswith("rdap_") and c not in rec.RAW_COLUMNS]))


RDAP_IP_COLUMNS = f"""0 AS rdap_ip_v4_count, c AS rdap_ip_v6_count, 0 AS rdap_ip_shortest_v4_prefix_len, 0 AS rdap_ip_longest_v4_prefix_len, list_min(qs)::INTEGER AS rdap_ip_shortest_v6_prefix_len, list_max(qs)::INTEGER AS rdap_ip_longest_v6_prefix_len, round(list_avg({_each("length(x)")}), 9) AS rdap_ip_avg_admin_name_len,
    round(list_avg({_each(_entropy("x"))}), 9) AS rdap_ip_avg_admin_name_entropy, 0.0::DOUBLE AS rdap_ip_avg_admin_email_len, 0.0::DOUBLE AS rdap_ip_avg_admin_email_entropy"""


@query(_I + f" SELECT l_orderkey, {RDAP_IP_COLUMNS} FROM g")
def rdap_ip_features(spark, sf_dir):
    out = rec.rdap_ip_features(flat(spark, sf_dir))
    return rounded(out.select("l_orderkey", *[c for c in out.columns if c.startswith("rdap_ip_")]))


def merged_raw(spark, sf_dir):
    """Orders as messages with a merged record: key, value (JSON)."""
    data = lambda code=0, **own: f"named_struct('statusCode', {code}, 'data', named_struct(" + ", ".join(f"'{k}', {v}" for k, v in own.items()) + "))"
    ip = "concat('10.', x.l_suppkey % 4, '.', x.l_linenumber, '.', n)"
    geo = data(asn="x.l_suppkey % 5", networkAddress="concat('/n', x.l_suppkey % 3)", countryCode="x.l_shipmode", latitude="x.d", longitude="x.p")
    rtt = data("if(x.q > 10, 0, 11)", avg="x.p", received="3L")
    rdap = data(ipVersion="'v4'", prefixLen="cast(x.q as int)", adminName="x.l_shipmode")
    person = lambda role, name: f"named_struct('roles', array('{role}'), 'vcardArray', concat('[\"vcard\",[[\"fn\",{{}},\"text\",\"', {name}, '\"]]]'))"
    event = lambda action, days: f"named_struct('eventAction', '{action}', 'eventDate', concat(date_add(rdap_registration_date, {days}), 'T00:00:00Z'))"
    soa = "named_struct('primaryNS', if(own, 'ns1.example.com', 'ns.zone.com'), 'respMailboxDname', if(own, 'host1.ns.example.com', 'm.zone.com'), 'refresh', if(own, l_orderkey, 1L), 'retry', 2L, 'expire', 3L, 'minTTL', 4L)"
    parts = {
        "zone": f"named_struct('zone', if(own, domain_name, dns_zone), 'soa', {soa})",
        "dnsResult": f"""named_struct('statusCode', 0, 'lastAttempt', 1000L, 'ips', transform(i, (x, n) -> named_struct('ip', {ip}, 'rrType', if(x.l_returnflag = 'N', 'A', 'MX'))), 'dnsData', named_struct('ttlValues', map_from_entries(transform(i, (x, n) -> struct(concat('t', n), x.q))),
            'A', dns_A, 'AAAA', dns_AAAA, 'NS', transform(i, x -> named_struct('nameserver', x.l_shipmode)), 'MX', transform(i, x -> named_struct('value', x.l_shipmode, 'priority', 1)), 'TXT', dns_TXT))""",
        "tlsResult": "named_struct('statusCode', 0, 'html', concat('<p>order ', l_orderkey, '</p><script>eval(1)</script>'), 'tlsData', tls)",
        "rdapDomainResult": f"named_struct('statusCode', 0, 'rdapData', named_struct('events', array({event('registration', 0)}, {event('expiration', 365)}, {event('last changed', 30)}), 'secureDNS', named_struct('delegationSigned', rdap_dnssec)), 'entities', array({person('registrar', 'i[0].l_shipmode')}, {person('registrant', "'Some One'")}))",
        "ipResults": f"map_from_entries(transform(i, (x, n) -> struct({ip}, named_struct('geo-asn', {geo}, 'rtt', {rtt}, 'rdap-ip', {rdap}))))",
    }
    rows = flat(spark, sf_dir, with_items=True).withColumn("own", F.col("l_orderkey") % 3 == 0)
    return rows.selectExpr("domain_name as key", f"to_json(named_struct({', '.join(f"'{k}', {v}" for k, v in parts.items())})) as value")


def extractor(spark):
    return ex.feature_groups(country_ids(spark), F.expr(AS_OF))


_ZONE = "CASE WHEN l_orderkey % 3 = 0 THEN 'd' || l_orderkey || '.com' ELSE 'zone' || l_orderkey % 7 || '.example.com' END"


@query(
    _I + _CHAIN + f""", t AS (SELECT l_orderkey, {TLS_COLUMNS} FROM o JOIN st USING (l_orderkey) GROUP BY 1), rd AS (SELECT l_orderkey, {RDAP_COLUMNS} FROM o WHERE r = 1), ri AS (SELECT l_orderkey, {RDAP_IP_COLUMNS} FROM g),
    rtt AS (SELECT l_orderkey, round(avg(CASE WHEN q > 10 THEN p ELSE 0 END) + 1e-7, 4) AS ip_mean_average_rtt FROM i GROUP BY 1)
    SELECT 'd' || l_orderkey || '.com' AS domain_name, t.* EXCLUDE (l_orderkey), rd.* EXCLUDE (l_orderkey), ri.* EXCLUDE (l_orderkey), ip_mean_average_rtt, 0 AS dns_has_dnskey,
    c AS ip_count, 1.0::DOUBLE AS ip_v4_ratio, round(len(list_filter(fs, lambda x: x = 'N')) / c, 9) AS ip_a_aaaa_to_all_ratio, round(list_entropy(nets), 9) AS ip_as_address_entropy, round(list_entropy(asn), 9) AS ip_asn_entropy, len(list_distinct(asn))::INTEGER AS ip_distinct_as_count,
    len(list_distinct(ms))::INTEGER AS geo_countries_count, round(list_avg(ds), 9) AS geo_mean_lat, list_min(ds) AS geo_min_lat, list_max(ds) AS geo_max_lat, round(list_avg(ps), 9) AS geo_mean_lon, list_max(ps) AS geo_max_lon, list_reduce(list_prepend(0::BIGINT, {_IDS}), lambda z, x: (z + x) * CASE WHEN x > 4 THEN 2 ELSE 1 END) % 2147483647 AS geo_countries_hash,
    len(list_filter(fs, lambda x: x = 'N'))::INTEGER AS "dns_A_count", CASE WHEN l_orderkey % 2 = 0 THEN c ELSE 0 END AS "dns_AAAA_count", c AS "dns_MX_count", c AS "dns_NS_count", c AS "dns_TXT_count", (l_orderkey % 3 = 0)::INTEGER AS "dns_SOA_count", {_name_columns(_ZONE, "dns_zone", "(l_orderkey % 3 <> 0)::INTEGER")},
    round(list_avg(qs), 9) AS dns_ttl_avg, len(list_distinct(qs))::INTEGER AS dns_ttl_distinct_count, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey ELSE 1 END AS dns_soa_refresh, 4::BIGINT AS dns_soa_min_ttl, round(list_avg({_each("length(x)")}), 9) AS dns_mx_avg_len, len(list_filter(ts, lambda x: x <> ''))::INTEGER AS dns_txt_external_verification_score, 0 AS dns_txt_spf_exists,
    length('d' || l_orderkey || '.com')::INTEGER AS lex_name_len, 3 AS lex_tld_len, length('d' || l_orderkey)::INTEGER AS lex_sld_len, 1 AS lex_has_digit, 0 AS lex_sub_count, 1 AS html_num_of_paragraphs, 1 AS html_num_of_scripts, 1 AS html_eval, 2 AS html_num_of_words
    FROM g JOIN t USING (l_orderkey) JOIN rd USING (l_orderkey) JOIN ri USING (l_orderkey) JOIN rtt USING (l_orderkey)"""
)
def P13_P14_all_groups(spark, sf_dir):
    """The extractor from JSON to vectors: all groups, compared in the columns that SQL expresses."""
    out, _ = ex.extract(merged_raw(spark, sf_dir), extractor(spark))
    names = ["domain_name", "dns_has_dnskey", *[c for c in out.columns if c.startswith(("tls_", "rdap_"))], "ip_count", "ip_v4_ratio", "ip_a_aaaa_to_all_ratio", "ip_as_address_entropy", "ip_asn_entropy", "ip_distinct_as_count"]
    names += [f"geo_{x}" for x in ("countries_count", "mean_lat", "min_lat", "max_lat", "mean_lon", "max_lon", "countries_hash")] + [f"dns_{x}" for x in ("A_count", "AAAA_count", "MX_count", "NS_count", "TXT_count", "SOA_count", "zone_level", "zone_digit_count", "zone_len", "zone_entropy", "ttl_avg", "ttl_distinct_count", "soa_refresh", "soa_min_ttl", "mx_avg_len", "txt_external_verification_score", "txt_spf_exists")]
    names += ["lex_name_len", "lex_tld_len", "lex_sld_len", "lex_has_digit", "lex_sub_count", "html_num_of_paragraphs", "html_num_of_scripts", "html_eval", "html_num_of_words"]
    return rounded(out.select(*names, F.round(F.col("ip_mean_average_rtt") + 1e-7, 4).alias("ip_mean_average_rtt")))


@query("SELECT CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'o' || o_orderkey END AS domain_name, CASE WHEN o_orderkey % 7 = 0 THEN 'Invalid data' WHEN o_orderkey % 11 = 0 THEN 'Unreadable: dnsResult.lastAttempt, dnsResult.dnsData.A, tlsResult' ELSE 'Missing domain name' END AS error FROM orders WHERE o_orderkey % 3 <> 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)")
def S6_extractor_errors(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("if(o_orderkey % 5 = 0, '', concat('o', o_orderkey)) as key", """case when o_orderkey % 3 = 0 then null when o_orderkey % 7 = 0 then 'broken' when o_orderkey % 11 = 0 then '{"zone":{"zone":"z"},"dnsResult":{"statusCode":0,"lastAttempt":"soon","dnsData":{"A":"1.1.1.1","TXT":["t"]}},"tlsResult":7}' else '{}' end as value""")
    return ex.extract(rows, extractor(spark))[1]


@query(_I + " SELECT 'd' || l_orderkey || '.com' AS domain_name, c AS ip_count, len(list_distinct(asn))::INTEGER AS ip_distinct_as_count, 'd' || l_orderkey || '.com' AS inside FROM g")
def O16_vector_json(spark, sf_dir):
    rows = st.vector_json(ro.apply_transforms(flat(spark, sf_dir), extractor(spark), ["drop", "ip"]))
    number = lambda name: F.get_json_object("value", f"$.{name}").cast("int").alias(name)
    return rows.select("domain_name", number("ip_count"), number("ip_distinct_as_count"), F.get_json_object("value", "$.domain_name").alias("inside"))


def demo_model(batch):
    """A stand-in for a caller's model: a probability from two columns."""
    p = 1 / (1 + batch["ip_count"].astype(float))
    return [{"domain_name": n, "aggregate_probability": float(x), "aggregate_description": "", "timestamp": 0, "error": None, "classification_results": [{"category": 1 + len(n) % 3, "probability": float(x), "description": "", "details": {}}]} for n, x in zip(batch["domain_name"], p)]


@query("SELECT 'd' || l_orderkey || '.com' AS domain_name, round(1 / (1 + count(*)), 9) AS aggregate_probability, CASE length('d' || l_orderkey || '.com') % 3 WHEN 0 THEN 'phishing' WHEN 1 THEN 'malware' ELSE 'dga' END AS category FROM lineitem GROUP BY l_orderkey")
def M1_M4_score(spark, sf_dir):
    vectors = rec.ip_features(flat(spark, sf_dir)).select("domain_name", "ip_count")
    return rounded(sc.result_rows(sc.score(vectors, demo_model)).select("domain_name", "aggregate_probability", "category"))
