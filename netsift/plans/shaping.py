"""Registered queries of result shaping: keys, envelopes, replay and new dimension rows, with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.functions import text as t
from netsift.operators import conversion as cv
from netsift.operators import extract as ex
from netsift.operators import lookups as lk
from netsift.operators import merge as m
from netsift.operators import routing as ro
from netsift.operators import stored as st
from netsift.sources import results as r

from .features import HOST_SQL, hosts, read, rounded
from .flows import extractor
from .lookup import _IPS, customer_ips
from .merging import _EV, domain_rows, ip_rows, raw_ip

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query(f"SELECT {HOST_SQL} AS key FROM pages")
def S13_ingress_domain(spark, sf_dir):
    return r.ingress_domain(hosts(spark, sf_dir).withColumnRenamed("domain_name", "domain"))


@query("SELECT 'd' || user_id AS domain_name, '10.0.0.' || (CAST(props->>'k' AS INTEGER) % 4) AS ip, count(*) AS n FROM events GROUP BY 1, 2")
def O15_ip_key_struct(spark, sf_dir):
    return raw_ip(spark, sf_dir).select(st.ip_key(F.col("key")).alias("k")).select("k.*").groupBy("domain_name", "ip").agg(F.count("*").alias("n"))


@query(f"WITH {_EV} SELECT DISTINCT domain, ip FROM best JOIN a USING (domain) WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL AND len(dns_ips) > 0 AND ip <> '10.0.0.1'")
def O4_ip_dim(spark, sf_dir):
    merged = m.merge_batch(domain_rows(spark, sf_dir), ip_rows(spark, sf_dir))
    return st.new_ips(merged, merged.select("domain", F.lit("10.0.0.1").alias("ip")))


_MERGED = f"""WITH {_EV}, z AS (SELECT off, zone_body, status_code AS zs FROM dom), o AS (SELECT off, body FROM dom),
    m AS (SELECT * FROM a WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL),
    pairs AS (SELECT domain, ip, string_agg('"' || collector || '":' || body, ',' ORDER BY collector) AS inner_ FROM best GROUP BY ALL),
    every AS (SELECT domain, unnest(dns_ips) AS ip FROM m WHERE len(dns_ips) > 0 UNION SELECT domain, ip FROM pairs),
    maps AS (SELECT domain, string_agg('"' || ip || '":{{' || coalesce(inner_, '') || '}}', ',' ORDER BY ip) AS ips FROM every LEFT JOIN pairs USING (domain, ip) GROUP BY domain)"""
_JOINED = """m JOIN z ON m.zone_offset = z.off JOIN o AS dn ON m.dns_offset = dn.off LEFT JOIN o AS tl ON m.tls_offset = tl.off LEFT JOIN o AS rd ON m.rdap_offset = rd.off LEFT JOIN maps USING (domain)"""


@query(
    f"""{_MERGED} SELECT m.domain AS key, '{{' || CASE WHEN zs = 0 THEN '"zone":' || zone_body || ',' ELSE '' END || '"dnsResult":' || dn.body || coalesce(',"tlsResult":' || tl.body, '') ||
    coalesce(',"rdapDomainResult":' || rd.body, '') || CASE WHEN len(dns_ips) > 0 THEN ',"ipResults":{{' || ips || '}}' ELSE '' END || '}}' AS value FROM {_JOINED}"""
)
def O1_merged_json(spark, sf_dir):
    """Whole records, as text."""
    return st.merged_json(m.merge_batch(domain_rows(spark, sf_dir), ip_rows(spark, sf_dir)))


@query(
    f"""{_MERGED} SELECT m.domain AS domain, 'zone' AS collector, NULL AS ip, '{{"lastAttempt":' || CAST(1700000000000 + dns_offset - 500 AS VARCHAR) || ',"statusCode":0,"zone":' || zone_body || '}}' AS data FROM {_JOINED} WHERE zs = 0
    UNION ALL SELECT m.domain, 'dns', NULL, dn.body FROM {_JOINED} UNION ALL SELECT m.domain, 'tls', NULL, tl.body FROM {_JOINED} WHERE tl.body IS NOT NULL
    UNION ALL SELECT m.domain, 'rdap-dn', NULL, rd.body FROM {_JOINED} WHERE rd.body IS NOT NULL
    UNION ALL SELECT m.domain, best.collector, best.ip, best.body FROM m JOIN best USING (domain) WHERE len(dns_ips) > 0"""
)
def S14_split_merged_json(spark, sf_dir):
    """Merged records taken apart again: what the collectors gave."""
    return r.split_merged_json(O1_merged_json(spark, sf_dir)).select("domain", "collector", "ip", "data")


@query(
    f"""{_MERGED}, dk AS (SELECT off, k, status_code AS s, event_id FROM (SELECT event_id AS off, * FROM ev)), ok AS (SELECT domain, ip, collector, k FROM best JOIN dk ON best_offset = off WHERE s = 0 AND best.domain IN (SELECT domain FROM m WHERE len(dns_ips) > 0)),
    geo AS (SELECT m.domain, count(DISTINCT 64500 + g.k % 7) AS asns, round(avg(g.k % 90), 9) AS lat FROM m JOIN ok AS g ON m.domain = g.domain AND g.collector = 'geo-asn' AND list_contains(dns_ips, g.ip) GROUP BY 1)
    SELECT m.domain AS domain_name, CASE WHEN n.s = 0 AND n.k % 5 <> 4 THEN len(dns_ips) ELSE 0 END AS "dns_A_count", (n.s = 0)::INTEGER AS "dns_MX_count", (n.s = 0)::INTEGER AS "dns_TXT_count", CASE WHEN n.s = 0 THEN (100 + n.k)::DOUBLE END AS dns_ttl_avg,
    CASE WHEN z.zs = 0 THEN 900 END AS dns_soa_refresh, coalesce(len(dns_ips), 0) AS ip_count, asns::INTEGER AS ip_distinct_as_count, coalesce(lat, 0) AS geo_mean_lat,
    CASE WHEN tl.s = 0 THEN 1 ELSE 0 END AS html_num_of_paragraphs, CASE WHEN tl.s = 0 THEN 1 ELSE 0 END AS html_num_of_anchors, coalesce(rd.s = 0, false) AS rdap_has_dnssec, length(m.domain)::INTEGER AS lex_name_len, 264 AS n_columns
    FROM m JOIN z ON m.zone_offset = z.off JOIN dk AS n ON m.dns_offset = n.off LEFT JOIN dk AS tl ON m.tls_offset = tl.off LEFT JOIN dk AS rd ON m.rdap_offset = rd.off LEFT JOIN geo ON m.domain = geo.domain"""
)
def O1_S5_P14_merge_to_vectors(spark, sf_dir):
    """From collectors' results to vectors: the batch merge, its records as JSON, the extractor, which finds none to be in error."""
    good, errors = ex.extract(O1_merged_json(spark, sf_dir), extractor(spark))
    names = ["domain_name", "dns_A_count", "dns_MX_count", "dns_TXT_count", "dns_ttl_avg", "dns_soa_refresh", "ip_count", "ip_distinct_as_count", "geo_mean_lat", "html_num_of_paragraphs", "html_num_of_anchors", "rdap_has_dnssec", "lex_name_len"]
    rows = rounded(good.select(*names).withColumn("n_columns", F.lit(len(good.columns))))
    return rows.unionByName(errors.select("domain_name"), allowMissingColumns=True)


@query(f"WITH {_EV} SELECT domain AS domain_name, FALSE AS invalid_data, dns_offset, CASE WHEN len(dns_ips) > 0 THEN len(dns_ips) END AS n_ips FROM a WHERE zone_offset IS NOT NULL AND dns_offset IS NOT NULL")
def S5_parse_own_merged(spark, sf_dir):
    """The merge's own records are read without error."""
    rows = r.parse_merged(O1_merged_json(spark, sf_dir), r.MERGED)
    ips = F.col("data.dnsResult.ips")
    return rows.select("domain_name", "invalid_data", (F.col("data.dnsResult.lastAttempt") - 1700000000000).alias("dns_offset"), F.when(F.size(ips) > 0, F.size(ips).cast("bigint")).alias("n_ips"))


@query("SELECT l_orderkey AS domain, CASE WHEN l_orderkey % 2 = 0 THEN 'tls' ELSE 'none' END AS extra, 2 + (l_orderkey % 2 = 0)::INTEGER + count(DISTINCT l_suppkey) AS n, 1000 - 500 AS zone_at FROM lineitem GROUP BY 1")
def S14_split_merged(spark, sf_dir):
    entry = "named_struct('statusCode', 0, 'error', cast(null as string), 'lastAttempt', 1000L, 'data', '{}')"
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey").cast("string")).alias("s")).selectExpr(
        "l_orderkey as domain", "named_struct('zone', 'z') as zone", f"{entry} as dnsResult", f"if(l_orderkey % 2 = 0, {entry}, null) as tlsResult", f"if(l_orderkey < 0, {entry}, null) as rdapDomainResult",
        f"map_from_arrays(s, transform(s, x -> map('rtt', {entry}))) as ipResults",
    )
    out = r.split_merged(rows).groupBy("domain").agg(F.max(F.when(F.col("collector") == "tls", "tls")).alias("extra"), F.count("*").alias("n"), F.max(F.when(F.col("collector") == "zone", F.col("last_attempt"))).cast("int").alias("zone_at"))
    return out.withColumn("extra", F.coalesce("extra", F.lit("none")))


@query(f"WITH {_IPS} SELECT c_custkey, CASE WHEN ip = 'none' THEN 3 ELSE 0 END AS status_code, 'rtt' AS collector, CASE WHEN ip <> 'none' THEN ip END AS data FROM ips")
def P16_result_envelope(spark, sf_dir):
    code = F.when(lk.address_hex(F.col("ip")).isNull(), 3).otherwise(0)
    rows = customer_ips(spark, sf_dir).select("c_custkey", ro.result_envelope(code, collector="rtt", data=F.col("ip")).alias("e"))
    return rows.select("c_custkey", F.col("e.statusCode").alias("status_code"), "e.collector", "e.data")


@query(f"WITH {_IPS} SELECT c_custkey, CAST(CAST(split_part(ip, '.', 1) AS INTEGER) * 256 + CAST(split_part(ip, '.', 2) AS INTEGER) AS VARCHAR) AS prefix FROM ips WHERE ip <> 'none'")
def F8_ip_prefix(spark, sf_dir):
    return customer_ips(spark, sf_dir).where("ip <> 'none'").selectExpr("c_custkey", f"{t.ip_prefix('ip')} as prefix")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'A,MX' ELSE 'A,AAAA' END AS types FROM orders")
def P12_effective_types(spark, sf_dir):
    wanted = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("A"), F.lit("MX"))).when(F.col("o_orderkey") % 3 == 1, F.array().cast("array<string>"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(ro.effective_types(wanted, ("A", "AAAA")), ",").alias("types"))


@query("SELECT event_type AS source, 'Unknown collector: ' || event_type AS error, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY ALL")
def O9_domain_errors(spark, sf_dir):
    dim = spark.sql("SELECT * FROM VALUES ('click', 1), ('view', 2) AS t(collector, collector_id)")
    bad = lk.collector_ids(read(spark, sf_dir, "events").selectExpr("concat('d', user_id) as domain", "event_type as collector"), dim)[1]
    return st.domain_errors(bad, F.col("error")).groupBy("source", "error").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'own' ELSE 'zone' END AS soa, o_orderkey % 3 = 0 AS spf FROM orders")
def C2_soa_and_mail_flags(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "'a.com' as d", "if(o_orderkey % 2 = 0, 'a.com', 'com') as z", "named_struct('x', 1) as s", "if(o_orderkey % 3 = 0, array('V=SPF1 -all'), array('x')) as txt")
    rows = rows.withColumns(cv.soa_split(F.col("d"), F.col("z"), F.col("s")))
    return rows.select("o_orderkey", F.when(F.col("dns_SOA").isNotNull(), "own").when(F.col("dns_zone_SOA").isNotNull(), "zone").alias("soa"), cv.email_extras(F.col("txt"))["spf"].alias("spf"))
