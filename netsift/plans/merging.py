"""Merge queries over events as collector results, with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.operators import merge as m
from netsift.sources import results as r

from .features import read

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') as int) as k")


KIND = "CASE event_type WHEN 'signup' THEN 'zone' WHEN 'click' THEN 'dns' WHEN 'view' THEN 'tls' WHEN 'error' THEN 'rdap-dn' END"
IP_KIND = "CASE event_type WHEN 'signup' THEN 'geo-asn' WHEN 'click' THEN 'rdap-ip' WHEN 'view' THEN 'rtt' WHEN 'purchase' THEN 'nerd' ELSE 'other' END"
#: SQL, Spark's and DuckDB's alike: collectors' results as JSON in the shapes that collectors give, keys in order. A DNS result has
#: no, one or two addresses; those of k % 5 = 4 are of mail servers, so that TLS isn't asked.
_ADDRESSES = "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '\"10.0.0.1\"' ELSE '\"10.0.0.1\",\"10.0.0.2\"' END"
_TYPED = "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN concat('{\"ip\":\"10.0.0.1\",\"rrType\":\"', rr, '\"}') ELSE concat('{\"ip\":\"10.0.0.1\",\"rrType\":\"', rr, '\"},{\"ip\":\"10.0.0.2\",\"rrType\":\"', rr, '\"}') END"
_RR = "CASE WHEN k % 5 = 4 THEN 'MX' ELSE 'A' END"
_TAIL = "',\"lastAttempt\":', 1700000000000 + event_id"
ZONE_BODY = "concat('{\"hasDNSKEY\":false,\"publicSuffix\":\"com\",\"soa\":{\"minTTL\":', 60 + k, ',\"primaryNS\":\"ns', k, '.example.com\",\"refresh\":900,\"respMailboxDname\":\"admin.example.com\"},\"zone\":\"d', user_id, '\"}')"
_DNS_BODY = f"""concat('{{"dnsData":{{"A":[', CASE WHEN k % 5 <> 4 THEN {_ADDRESSES} ELSE '' END, '],"AAAA":[],"CNAME":null,"MX":[{{"priority":', k, ',"relatedIPs":[', CASE WHEN k % 5 = 4 THEN {_ADDRESSES} ELSE '' END,
  '],"value":"mail.d', user_id, '.com"}}],"TXT":["v=spf1 -all"],"ttlValues":{{"A":', 100 + k, '}}}},"error":null,"ips":[', {_TYPED.replace(', rr,', f', {_RR},')}, ']', {_TAIL}, ',"statusCode":0}}')"""
BODY = f"""CASE WHEN value >= 80 THEN concat('{{"error":"failed"', {_TAIL}, ',"statusCode":10}}')
  WHEN event_type = 'signup' THEN concat('{{"error":null', {_TAIL}, ',"statusCode":0,"zone":', {ZONE_BODY}, '}}')
  WHEN event_type = 'click' THEN {_DNS_BODY}
  WHEN event_type = 'view' THEN concat('{{"error":null,"html":"<p>page ', k, '</p><a href=https://x.com>x</a>"', {_TAIL}, ',"statusCode":0,"tlsData":{{"certificates":[],"cipher":"TLS_AES_128_GCM_SHA256","fromIP":"10.0.0.1","protocol":"TLSv1.3"}}}}')
  ELSE concat('{{"entities":{{}},"error":null', {_TAIL}, ',"rdapData":{{"events":[{{"eventAction":"registration","eventDate":"2020-01-0', 1 + k % 9, 'T00:00:00Z"}}],"secureDNS":{{"delegationSigned":true}}}},"rdapTarget":"d', user_id, '.com","statusCode":0}}') END"""
_DATA = """CASE event_type WHEN 'signup' THEN concat('{"asn":', 64500 + k % 7, ',"countryCode":"CZ","latitude":', k % 90, ',"longitude":', k % 180, ',"networkAddress":"/10.0.0.0","prefixLength":24}')
  WHEN 'click' THEN concat('{"adminEmail":"a', k, '@x.com","adminName":"A', k, '","ipVersion":"4","prefixLen":', 16 + k % 9, '}')
  WHEN 'view' THEN concat('{"avg":', k, ',"received":', 1 + k % 5, '}') ELSE concat('{"reputation":', k % 2, '}') END"""
IP_BODY = f"""concat('{{"collector":"', {IP_KIND}, '"', CASE WHEN value < 80 THEN concat(',"data":', {_DATA}, ',"error":null') ELSE ',"error":"failed"' END, {_TAIL}, ',"statusCode":', CASE WHEN value < 80 THEN 0 ELSE 10 END, '}}')"""


def raw_domain(spark, sf_dir) -> DataFrame:
    """Events as raw messages: the collector's topic by event type, a JSON result as value."""
    return _events(spark, sf_dir).selectExpr(f"{KIND} as topic", "cast(concat('d', user_id) as binary) as key", f"cast({BODY} as binary) as value", "0 as partition", "event_id as offset", "ts as timestamp")


def domain_rows(spark, sf_dir) -> DataFrame:
    raw = raw_domain(spark, sf_dir)
    out = None
    for topic in m.DOMAIN_COLLECTORS:
        part = r.domain_results(raw.where(F.col("topic") == topic), topic)
        out = part if out is None else out.unionByName(part)
    return out


def raw_ip(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir).selectExpr("cast(concat('{\"dn\":\"d', user_id, '\",\"ip\":\"10.0.0.', k % 4, '\"}') as binary) as key", f"cast({IP_BODY} as binary) as value", "0 as partition", "event_id as offset", "ts as timestamp")


def ip_rows(spark, sf_dir) -> DataFrame:
    return r.ip_results(raw_ip(spark, sf_dir), m.IP_COLLECTORS)


_EV = f"""ev AS (SELECT *, CAST(props->>'k' AS INTEGER) AS k, CASE WHEN value < 80 THEN 0 ELSE 10 END AS status_code FROM events),
dom AS (SELECT 'd' || user_id AS domain, {KIND} AS collector, status_code, CASE WHEN status_code <> 0 THEN 'failed' END AS error, ts, event_id AS off, {BODY} AS body, {ZONE_BODY} AS zone_body,
  CASE WHEN status_code <> 0 THEN NULL WHEN k % 3 = 0 THEN [] WHEN k % 3 = 1 THEN ['10.0.0.1'] ELSE ['10.0.0.1', '10.0.0.2'] END AS ips, status_code = 0 AND k % 3 > 0 AND k % 5 <> 4 AS wants_tls
  FROM ev WHERE event_type <> 'purchase'),
ipr AS (SELECT 'd' || user_id AS domain, '10.0.0.' || (k % 4) AS ip, {IP_KIND} AS collector, status_code, ts, event_id AS off, {IP_BODY} AS body FROM ev WHERE event_type <> 'error'),
agg AS (SELECT domain, """ + ", ".join(
    f"max_by(off, (status_code = 0, ts, -off)) FILTER (WHERE collector = '{c}') AS {n}_offset" for c, n in m.DOMAIN_COLLECTORS.items()
) + """, max_by({'ips': ips, 'wants_tls': wants_tls}, (status_code = 0, ts, -off)) FILTER (WHERE collector = 'dns') AS d FROM dom GROUP BY domain),
a AS (SELECT * EXCLUDE (d), d.ips AS dns_ips, d.wants_tls AS wants_tls FROM agg),
best AS (SELECT domain, ip, collector, max_by(off, (status_code = 0, ts, -off)) AS best_offset, max_by(ts, (status_code = 0, ts, -off)) AS best_ts, max_by(body, (status_code = 0, ts, -off)) AS body FROM ipr GROUP BY ALL)"""


@query(f"WITH {_EV} SELECT domain, collector, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE status_code = 0) AS BIGINT) AS ok, count(error) AS errors FROM dom GROUP BY ALL")
def S1_S3_T3_union_results(spark, sf_dir):
    return domain_rows(spark, sf_dir).groupBy("domain", "collector").agg(F.count("*").alias("n"), F.count_if(F.col("status_code") == 0).alias("ok"), F.count("error").alias("errors"))


@query(f"WITH {_EV} SELECT domain, ip, collector, CAST(count(*) AS BIGINT) AS n FROM ipr GROUP BY ALL")
def S2_P2_ip_results(spark, sf_dir):
    return m.mergeable(ip_rows(spark, sf_dir)).groupBy("domain", "ip", "collector").agg(F.count("*").alias("n"))


@query(f"WITH {_EV} SELECT domain, ip, collector, best_offset FROM best")
def A1_more_useful(spark, sf_dir):
    return m.more_useful(ip_rows(spark, sf_dir), "domain", "ip", "collector").select("domain", "ip", "collector", F.col("entry.offset").alias("best_offset"))


@query(f"WITH {_EV} SELECT domain, zone_offset, dns_offset, rdap_offset, tls_offset, array_to_string(dns_ips, ',') AS ips, wants_tls FROM a")
def A2_domain_aggregate(spark, sf_dir):
    rows = m.domain_aggregate(domain_rows(spark, sf_dir))
    return rows.select("domain", *[F.col(f"{c}.offset").alias(f"{c}_offset") for c in ("zone", "dns", "rdap", "tls")], F.when(F.col("dns_ips").isNotNull(), F.array_join("dns_ips", ",")).alias("ips"), "wants_tls")


@query(f"WITH {_EV}, p AS (SELECT domain, ip, list(collector || '=' || best_offset ORDER BY collector) AS c FROM best GROUP BY ALL) SELECT domain, ip, array_to_string(c, ';') AS entries FROM p")
def A3_ip_aggregate(spark, sf_dir):
    rows = m.ip_aggregate(ip_rows(spark, sf_dir)).select("domain", F.explode("ips").alias("ip", "e"))
    return rows.select("domain", "ip", F.array_join(F.transform(F.map_entries("e"), lambda x: F.concat(x["key"], F.lit("="), x["value"]["offset"].cast("string"))), ";").alias("entries"))


@query(f"WITH {_EV} SELECT coalesce(len(dns_ips) > 0, false) AS has_ips, CAST(count(*) AS BIGINT) AS n FROM a GROUP BY 1")
def P1_split_by_ips(spark, sf_dir):
    some, none = m.split_by_ips(m.domain_aggregate(domain_rows(spark, sf_dir)))
    return some.withColumn("has_ips", F.lit(True)).unionByName(none.withColumn("has_ips", F.lit(False))).groupBy("has_ips").agg(F.count("*").alias("n"))


_COMPLETE = """rdap_offset IS NOT NULL AND coalesce(tls_offset IS NOT NULL OR NOT wants_tls, false) AND
    (coalesce(len(dns_ips) = 0, true) OR coalesce(least = 4 AND list_has_all(seen, dns_ips), false))"""


@query(
    f"""WITH {_EV}, m AS (SELECT * FROM a WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL),
    per AS (SELECT domain, ip, count(*) AS n FROM best GROUP BY ALL), seen AS (SELECT domain, list(ip) AS seen, min(n) AS least FROM per GROUP BY domain)
    SELECT m.domain, CASE WHEN len(dns_ips) > 0 THEN CAST(len(list_distinct(list_concat(coalesce(seen, []), dns_ips))) AS INTEGER) END AS n_ips, {_COMPLETE} AS is_complete FROM m LEFT JOIN seen USING (domain)"""
)
def A4_A5_J1_T6_merge_batch(spark, sf_dir):
    rows = m.merge_batch(domain_rows(spark, sf_dir), ip_rows(spark, sf_dir))
    return rows.select("domain", F.when(F.col("ips").isNotNull(), F.size("ips")).alias("n_ips"), "is_complete")


GAP = 7_200
_LIVES = f"""both_ AS (SELECT domain, ts FROM dom UNION ALL SELECT domain, ts FROM ipr),
    s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY domain ORDER BY ts) < INTERVAL {GAP} SECOND THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT * FROM both_)),
    g AS (SELECT domain, ts, sum(fresh) OVER (PARTITION BY domain ORDER BY ts) AS n FROM s),
    l AS (SELECT domain, ts, min(ts) OVER (PARTITION BY domain, n) AS life FROM g),
    own AS (SELECT dom.*, life FROM dom JOIN l USING (domain, ts)), per AS (SELECT ipr.*, life FROM ipr JOIN l USING (domain, ts)),
    agg_l AS (SELECT domain, life, """ + ", ".join(
    f"max_by(off, (status_code = 0, ts, -off)) FILTER (WHERE collector = '{c}') AS {n}_offset" for c, n in m.DOMAIN_COLLECTORS.items()
) + """, max_by({'ips': ips, 'wants_tls': wants_tls}, (status_code = 0, ts, -off)) FILTER (WHERE collector = 'dns') AS d FROM own GROUP BY domain, life),
    ml AS (SELECT * EXCLUDE (d), d.ips AS dns_ips, d.wants_tls AS wants_tls FROM agg_l WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL),
    perl AS (SELECT domain, life, ip, count(DISTINCT collector) AS n FROM per GROUP BY ALL), seenl AS (SELECT domain, life, list(ip) AS seen, min(n) AS least FROM perl GROUP BY ALL)"""


@query(
    f"""WITH {_EV}, {_LIVES} SELECT ml.domain, epoch_us(ml.life) AS life_us, zone_offset, dns_offset, rdap_offset, tls_offset,
    CASE WHEN len(dns_ips) > 0 THEN array_to_string(list_sort(list_distinct(list_concat(coalesce(seen, []), dns_ips))), ',') END AS ips, {_COMPLETE} AS is_complete
    FROM ml LEFT JOIN seenl ON ml.domain = seenl.domain AND ml.life = seenl.life"""
)
def T6_merge_by_life(spark, sf_dir):
    """One record for each life of each domain: two hours without any result end a life."""
    rows = m.merge_lives(domain_rows(spark, sf_dir), ip_rows(spark, sf_dir), GAP)
    offsets = [F.col(f"{c}.offset").alias(f"{c}_offset") for c in m.DOMAIN_COLLECTORS.values()]
    return rows.select("domain", F.unix_micros(F.col("life").cast("timestamp")).alias("life_us"), *offsets, F.when(F.col("ips").isNotNull(), F.array_join(F.map_keys("ips"), ",")).alias("ips"), "is_complete")


@query(
    f"""WITH {_EV}, w AS (SELECT domain, unnest([zone_offset, dns_offset, rdap_offset, tls_offset]) AS off, dns_ips FROM a WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL),
    own AS (SELECT w.domain, min(ts) AS t FROM w JOIN dom USING (off) GROUP BY 1), ip AS (SELECT domain, min(best_ts) AS t FROM best JOIN a USING (domain) WHERE len(dns_ips) > 0 GROUP BY 1)
    SELECT own.domain, epoch_us(least(own.t, coalesce(ip.t, own.t))) AS last_update_us FROM own LEFT JOIN ip USING (domain)"""
)
def A7_O3_earliest_ts(spark, sf_dir):
    rows = m.merge_batch(domain_rows(spark, sf_dir), ip_rows(spark, sf_dir))
    return rows.select("domain", F.unix_micros(m.earliest_ts().cast("timestamp")).alias("last_update_us"))


@query(
    f"""WITH {_EV}, s AS (SELECT domain, ts, off, CASE WHEN ts - lag(ts) OVER (PARTITION BY domain ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM dom),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY domain ORDER BY ts RANGE UNBOUNDED PRECEDING) AS life FROM s)
    SELECT domain, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS end_us, CAST(count(*) AS BIGINT) AS n, array_to_string(list(off ORDER BY off), ',') AS offsets FROM g GROUP BY domain, life"""
)
def T6_lifetimes(spark, sf_dir):
    rows = m.lifetimes(domain_rows(spark, sf_dir), "6 hours")
    return rows.select("domain", F.unix_micros(F.col("life_start").cast("timestamp")).alias("start_us"), F.unix_micros(F.col("life_end").cast("timestamp")).alias("end_us"), "n", F.array_join(F.transform("offsets", lambda x: x.cast("string")), ",").alias("offsets"))
