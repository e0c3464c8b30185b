"""Registered routing, lookup and stored-table queries, with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsift.functions.domains import split_names
from netsift.operators import lookups as lk
from netsift.operators import routing as ro
from netsift.operators import stored as st
from netsift.sources import results as r

from .features import HOST_SQL, SPLIT_SQL, hosts, read

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


_SEEDS = f"WITH h AS (SELECT page_id, {HOST_SQL} AS name FROM pages), known AS (SELECT DISTINCT name FROM h WHERE page_id % 5 = 0)"


@query(f"{_SEEDS} SELECT DISTINCT name FROM h WHERE name NOT IN (SELECT name FROM known)")
def J2_new_domains(spark, sf_dir):
    h = hosts(spark, sf_dir).withColumnRenamed("domain_name", "name")
    return lk.known_names(h.select("name"), h.where("page_id % 5 = 0").select("name"))[0]


@query(f"{_SEEDS}, f AS (SELECT DISTINCT name FROM h WHERE name NOT IN (SELECT name FROM known)) SELECT (SELECT count(*) FROM f) AS stored, (SELECT count(*) FROM h) - (SELECT count(*) FROM f) AS duplicates")
def A11_load_summary(spark, sf_dir):
    h = hosts(spark, sf_dir).withColumnRenamed("domain_name", "name")
    return lk.known_names(h.select("name"), h.where("page_id % 5 = 0").select("name"))[1]


def networks(spark, sf_dir):
    """10.<nation>.0.0/16 and, for even nations, 10.<nation>.64.0/18 within it; 11.0.0.0/8 for region 0."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    wide = n.selectExpr("4 as version", "concat('0a', lpad(lower(hex(n_nationkey)), 2, '0'), '0000') as ip_start", "concat('0a', lpad(lower(hex(n_nationkey)), 2, '0'), 'ffff') as ip_end", "16 as prefix_len", "n_name as label")
    deep = n.where("n_nationkey % 2 = 0").selectExpr("4 as version", "concat('0a', lpad(lower(hex(n_nationkey)), 2, '0'), '4000') as ip_start", "concat('0a', lpad(lower(hex(n_nationkey)), 2, '0'), '7fff') as ip_end", "18 as prefix_len", "concat(n_name, ' inner') as label")
    big = read(spark, sf_dir, "region").where("r_regionkey = 0").selectExpr("4 as version", "'0b000000' as ip_start", "'0bffffff' as ip_end", "8 as prefix_len", "r_name as label")
    return wide.unionByName(deep).unionByName(big)


def customer_ips(spark, sf_dir):
    ip = "case when c_custkey % 11 = 0 then 'none' when c_custkey % 7 = 0 then concat('11.', c_custkey % 256, '.1.1') else concat('10.', c_custkey % 30, '.', c_custkey % 256, '.', c_custkey % 200) end"
    return read(spark, sf_dir, "customer").selectExpr("c_custkey", f"{ip} as ip")


_IPS = """ips AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'none' WHEN c_custkey % 7 = 0 THEN '11.' || c_custkey % 256 || '.1.1' ELSE '10.' || c_custkey % 30 || '.' || c_custkey % 256 || '.' || c_custkey % 200 END AS ip,
    c_custkey % 30 AS a, c_custkey % 256 AS b FROM customer)"""


@query(
    f"""WITH {_IPS} SELECT c_custkey, ip, CASE WHEN ip LIKE '11.%' THEN (SELECT r_name FROM region WHERE r_regionkey = 0) WHEN ip LIKE '10.%' THEN CASE WHEN a % 2 = 0 AND b BETWEEN 64 AND 127 THEN n_name || ' inner' ELSE n_name END END AS label,
    CASE WHEN ip = 'none' THEN 3 WHEN ip LIKE '10.%' AND n_name IS NULL THEN 12 ELSE 0 END AS status_code FROM ips LEFT JOIN nation ON a = n_nationkey"""
)
def J3_geo_asn_lookup(spark, sf_dir):
    nets = networks(spark, sf_dir)
    rows = lk.geo_asn(customer_ips(spark, sf_dir), nets, nets.where("prefix_len = 16"))
    return rows.select("c_custkey", "ip", F.col("geo.label").alias("label"), "status_code")


@query(f"WITH {_IPS}, s AS (SELECT '10.' || s_suppkey % 30 || '.' || s_suppkey % 256 || '.' || s_suppkey % 200 AS ip, max(s_acctbal) AS v FROM supplier GROUP BY 1) SELECT c_custkey, CAST(v AS DOUBLE) AS reputation, CASE WHEN ips.ip = 'none' THEN 3 WHEN v IS NULL THEN 12 ELSE 0 END AS status_code FROM ips LEFT JOIN s USING (ip)")
def J4_reputation_lookup(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").selectExpr("concat('10.', s_suppkey % 30, '.', s_suppkey % 256, '.', s_suppkey % 200) as ip", "s_acctbal").groupBy("ip").agg(F.max("s_acctbal").cast("double").alias("reputation"))
    return lk.reputation(customer_ips(spark, sf_dir), s).select("c_custkey", "reputation", "status_code")


@query(
    """WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), o AS (SELECT l_suppkey, array_to_string(list(l_orderkey ORDER BY l_orderkey), ',') AS ids FROM l GROUP BY 1)
    SELECT c_custkey, s_suppkey AS source_id, CASE WHEN s_suppkey IS NOT NULL THEN coalesce(ids, '') END AS offenses, CASE WHEN s_suppkey IS NULL THEN 12 ELSE 0 END AS status_code FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey * 3 LEFT JOIN o ON s_suppkey = l_suppkey"""
)
def J5_siem_lookup(spark, sf_dir):
    sources = read(spark, sf_dir, "supplier").selectExpr("s_suppkey as source_id", "cast(s_suppkey * 3 as string) as ip", "cast(s_acctbal as double) as magnitude")
    offenses = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("offense_id")).agg(F.collect_set("l_suppkey").alias("source_ids"))
    rows = lk.siem(read(spark, sf_dir, "customer").selectExpr("c_custkey", "cast(c_custkey as string) as ip"), sources, offenses)
    return rows.select("c_custkey", "source_id", F.when(F.col("offenses").isNotNull(), F.array_join(F.transform("offenses", lambda x: x.cast("string")), ",")).alias("offenses"), "status_code")


@query(
    f"""WITH {SPLIT_SQL}, z AS (SELECT DISTINCT domain_name AS zone FROM parts WHERE page_id % 3 = 0 UNION SELECT DISTINCT sld || '.' || suffix FROM parts WHERE suffix <> 'net'),
    c AS (SELECT domain_name, array_to_string(l[-k:], '.') AS zone, k FROM parts, range(2, 10) t(k) WHERE k <= len(l) AND k >= len(string_split(suffix, '.')) + 1),
    b AS (SELECT domain_name, max_by(zone, k) AS zone FROM c JOIN z USING (zone) GROUP BY 1) SELECT page_id, b.zone AS zone, CASE WHEN b.zone IS NULL THEN 12 ELSE 0 END AS status_code FROM parts LEFT JOIN b USING (domain_name)"""
)
def J6_zone_lookup(spark, sf_dir):
    h = hosts(spark, sf_dir)
    zones = h.where("page_id % 3 = 0").select(F.col("domain_name").alias("zone")).unionByName(split_names(h).where("suffix <> 'net'").select(F.concat_ws(".", "sld", "suffix").alias("zone")))
    return lk.zone(h, zones).select("page_id", "zone", "status_code")


@query(f"WITH {SPLIT_SQL} SELECT page_id, CASE WHEN l[-2:] = ['example', 'com'] THEN array_to_string(l[:-3], '.') ELSE array_to_string(l[:-2], '.') END AS rest, CASE WHEN l[-2:] = ['example', 'com'] THEN 'example.com' ELSE l[-1] END AS tld FROM parts WHERE l[-1] <> 'net' UNION ALL SELECT page_id, NULL, NULL FROM parts WHERE l[-1] = 'net'")
def P9_known_tld(spark, sf_dir):
    tlds = spark.sql("SELECT * FROM VALUES ('com', 'a'), ('org', 'b'), ('example.com', 'c') AS t(tld, endpoint)")
    return lk.known_tld(hosts(spark, sf_dir), tlds).select("page_id", "rest", "tld")


@query(
    f"""WITH {SPLIT_SQL}, q AS (SELECT page_id, domain_name, sld || '.' || suffix AS reg, abs(page_id) % 3 AS k FROM parts), resp AS (SELECT DISTINCT domain_name AS name, 0 AS c FROM q WHERE k = 0 UNION SELECT 'example.com', 0),
    j AS (SELECT q.*, a.c AS c1, b.c AS c2 FROM q LEFT JOIN resp a ON domain_name = a.name LEFT JOIN resp b ON reg = b.name AND reg <> domain_name)
    SELECT page_id, CASE WHEN c1 IS NULL AND c2 = 0 THEN reg ELSE domain_name END AS target, CASE WHEN c1 = 0 OR c2 = 0 THEN 0 ELSE 30 END AS status_code, coalesce(c1, c2, 1) <> 0 AS needs_whois FROM j"""
)
def P8_rdap_target(spark, sf_dir):
    h = hosts(spark, sf_dir)
    resp = h.where("page_id % 3 = 0").select(F.col("domain_name").alias("name")).union(spark.sql("SELECT 'example.com' AS name")).distinct().withColumn("status_code", F.lit(0))
    rows = lk.rdap_target(h.select("page_id", F.col("domain_name").alias("domain"), F.lit(None).cast("string").alias("zone")), resp)
    return rows.select("page_id", "target", "status_code", "needs_whois")


_LINES = "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), w AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '# ' || line WHEN 1 THEN substr(line, 1, 5) || ' www.site' || doc_id || '.example.com/x' WHEN 2 THEN '' ELSE line END AS line FROM l)"


@query(_LINES + r""" SELECT regexp_extract(line, '(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z0-9]') AS name, 'listed' AS category, count(*) AS n FROM w WHERE trim(line) <> '' AND NOT regexp_matches(line, '^\s*(#|;|//)') AND name <> '' GROUP BY 1, 2""")
def S7_plain_list(spark, sf_dir):
    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    value = "case doc_id % 4 when 0 then concat('# ', line) when 1 then concat(substr(line, 1, 5), ' www.site', doc_id, '.example.com/x') when 2 then '' else line end"
    return r.plain_list(lines.selectExpr("doc_id", f"{value} as value"), "listed").groupBy("name", "category").agg(F.count("*").alias("n"))


@query(
    f"""WITH h AS (SELECT page_id, {HOST_SQL} AS host FROM pages), c AS (SELECT *, CASE page_id % 3 WHEN 0 THEN 'Phish-kit' WHEN 1 THEN 'malware c2' ELSE 'misc' END AS raw FROM h WHERE page_id % 7 <> 0)
    SELECT host AS name, CASE WHEN raw ILIKE '%phish%' THEN 'phishing' WHEN raw ILIKE '%malware%' THEN 'malware' ELSE 'unknown' END AS category, 's' || page_id AS category_source FROM c"""
)
def S8_S10_S11_source_csv(spark, sf_dir):
    lines = hosts(spark, sf_dir).selectExpr("if(page_id % 7 = 0, domain_name, concat(domain_name, ',', case page_id % 3 when 0 then 'Phish-kit' when 1 then 'malware c2' else 'misc' end, ',s', page_id)) as value")
    return r.source_rows(lines, 0, 1, 2, mapper=[("phish", "phishing"), ("malware", "malware")])


@query(f"SELECT {HOST_SQL} AS name, 'urls' AS category FROM pages")
def S9_urlhaus_csv(spark, sf_dir):
    lines = read(spark, sf_dir, "pages").selectExpr("concat('\"', page_id, '\",\"2024-01-01\",\"', url, '\"') as value")
    return r.urlhaus_rows(lines, "urls").select(F.lower("name").alias("name"), "category")


@query(f"SELECT {HOST_SQL} AS name, 'feed' AS category, count(*) AS n FROM pages GROUP BY 1")
def S12_feed_attributes(spark, sf_dir):
    events = read(spark, sf_dir, "pages").groupBy((F.col("page_id") % 10).alias("g")).agg(F.collect_list(F.struct(F.col("url").alias("value"))).alias("attributes"))
    return r.feed_attributes(events, "feed").groupBy(F.lower("name").alias("name"), "category").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS domain, CASE WHEN bool_or(NOT failed) THEN 0 WHEN bool_and(e = 'Timeout') FILTER (WHERE failed) THEN 11 ELSE 20 END AS status_code, count(*) FILTER (WHERE failed)::INTEGER AS n_errors FROM (SELECT l_orderkey AS o_orderkey, l_returnflag <> 'N' AS failed, CASE l_returnflag WHEN 'A' THEN 'Timeout' WHEN 'R' THEN 'Refused' END AS e FROM lineitem) GROUP BY 1")
def P10_classify_dns(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey as domain", "concat_ws('-', l_linenumber, l_partkey, l_suppkey, l_quantity) as type", "case l_returnflag when 'A' then 'Timeout' when 'R' then 'Refused' end as error")
    return ro.classify_dns(rows).select("domain", "status_code", F.size("errors").alias("n_errors"))


_REC = "WITH r AS (SELECT l_orderkey AS domain, list(DISTINCT CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag = 'A') AS a, list(DISTINCT CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag = 'N') AS aaaa, list(DISTINCT CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag = 'R') AS cname FROM lineitem GROUP BY 1)"


def records(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("domain"))
    ips = lambda flag: F.collect_set(F.when(F.col("l_returnflag") == flag, F.col("l_partkey").cast("string")))
    return rows.agg(ips("A").alias("A"), ips("N").alias("AAAA"), F.struct(ips("R").alias("related_ips")).alias("CNAME"))


@query(_REC + ", u AS (SELECT domain, unnest(a) AS ip, 'A' AS rr_type FROM r UNION ALL SELECT domain, unnest(aaaa), 'AAAA' FROM r UNION ALL SELECT domain, unnest(cname), 'CNAME' FROM r) SELECT DISTINCT domain, ip, rr_type FROM u")
def P5_P11_ips_from_records(spark, sf_dir):
    return ro.ips_from_records(records(spark, sf_dir))


@query(_REC + ", u AS (SELECT domain, unnest(a) AS ip FROM r WHERE domain % 4 <> 0) SELECT domain, ip, count(*) AS n FROM u GROUP BY ALL")
def P5_route_dns_ips(spark, sf_dir):
    rows = records(spark, sf_dir).select("domain", F.col("A").alias("ips"), F.when(F.col("domain") % 4 == 0, 10).otherwise(0).alias("status_code"))
    return ro.route_dns_ips(rows).groupBy("domain", "ip").agg(F.count("*").alias("n"))


@query("SELECT 'd' || o_custkey AS domain, epoch_us(min(o_orderdate)::TIMESTAMP) AS last_update_us FROM orders WHERE o_custkey % 4 <> 0 GROUP BY 1")
def O3_new_domains(spark, sf_dir):
    merged = read(spark, sf_dir, "orders").selectExpr("concat('d', o_custkey) as domain", "cast(o_orderdate as timestamp) as last_update")
    stored = read(spark, sf_dir, "customer").where("c_custkey % 4 = 0").selectExpr("concat('d', c_custkey) as domain")
    return st.new_domains(merged, stored).select("domain", F.unix_micros("last_update").alias("last_update_us"))


@query("SELECT 'd' || o_custkey AS domain, 'qradar' AS collector, max_by(o_orderkey, o_orderkey) AS latest, count(*) FILTER (WHERE o_orderstatus = 'F') > 0 AS failed FROM orders GROUP BY 1")
def O11_siem_results(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("concat('d', o_custkey) as domain", "'1.1.1.1' as ip", "timestamp '2024-01-01' as ts", "if(o_orderstatus = 'F', 10, 0) as status_code", "cast(null as string) as error", "cast(o_orderkey as string) as raw", "o_orderkey as offset")
    found = st.siem_results(rows)
    failed = found.groupBy("domain").agg((F.max("status_code") > 0).alias("failed"))
    return st.collection_results(found).join(failed, "domain").select("domain", "collector", F.col("raw").cast("bigint").alias("latest"), "failed")


@query("SELECT 'd' || o_orderkey AS domain, o_orderkey * 1000 AS start FROM orders")
def O14_domain_and_start(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("concat('d', o_orderkey) as key", "concat('{\"dnsResult\":{\"lastAttempt\":', o_orderkey * 1000, '}}') as value")
    return st.with_domain_and_start(rows).select(F.col("domainName").alias("domain"), F.col("processingStart").alias("start"))


@query(_REC + " SELECT domain, coalesce(list_min(cname), list_min(a), list_min(aaaa)) AS ip FROM r")
def P6_ip_for_tls(spark, sf_dir):
    return records(spark, sf_dir).select("domain", ro.ip_for_tls().alias("ip"))


@query(f"WITH h AS (SELECT page_id, {HOST_SQL} AS d FROM pages) SELECT page_id, d AS domain, k FROM h, (VALUES ('dns'), ('rdap')) t(k) WHERE page_id % 4 <> 0 AND page_id % 5 <> 1 AND (k = 'rdap' OR page_id % 3 <> 0)")
def P3_P4_route_zone(spark, sf_dir):
    rows = hosts(spark, sf_dir).selectExpr("page_id", "if(page_id % 5 = 1, concat(domain_name, '.in-addr.ARPA'), domain_name) as domain", "cast(page_id as string) as zone", "if(page_id % 4 = 0, 12, 0) as status_code", "if(page_id % 3 = 0, false, null) as collect_dns", "cast(null as boolean) as collect_rdap", "cast(array() as array<string>) as types_to_collect", "cast(array() as array<string>) as types_to_process_ips_from")
    rows = rows.where(ro.reject_arpa(F.col("domain")) == 0)
    dns, rdap = ro.route_zone(rows)
    return dns.selectExpr("cast(zone as bigint) as page_id", "domain", "'dns' as k").unionByName(rdap.selectExpr("cast(zone as bigint) as page_id", "domain", "'rdap' as k"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderpriority LIKE '%URGENT%'")
def P7_collector_requested(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "if(o_orderkey % 3 = 0, null, array(substring_index(o_orderpriority, '-', -1))) as collectors")
    return ro.collector_requested(rows, "URGENT").select("o_orderkey")


@query("SELECT event_type AS collector, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS collector_id, count(*) AS n FROM events GROUP BY ALL")
def J9_collector_dim_join(spark, sf_dir):
    dim = spark.sql("SELECT * FROM VALUES ('click', 1), ('view', 2) AS t(collector, collector_id)")
    good, bad = lk.collector_ids(read(spark, sf_dir, "events").select(F.col("event_type").alias("collector")), dim)
    return good.unionByName(bad.select("collector", F.lit(None).cast("int").alias("collector_id"))).groupBy("collector", "collector_id").agg(F.count("*").alias("n"))


@query(
    """WITH e AS (SELECT l_orderkey AS k, l_linenumber AS i, l_partkey AS p, l_returnflag = 'N' AS card FROM lineitem), r AS (SELECT k, i, p, card, CASE WHEN NOT card AND p_partkey IS NOT NULL THEN p_name ELSE 'own' || p END AS n FROM e LEFT JOIN part ON p = p_partkey AND p_partkey % 2 = 0)
    SELECT k AS domain, array_to_string(list(n ORDER BY i, p::VARCHAR, card), ',') AS names FROM r GROUP BY 1"""
)
def J10_rdap_entities_resolve(spark, sf_dir):
    e = F.struct(F.col("l_linenumber").alias("i"), F.struct(F.col("l_partkey").cast("string").alias("handle"), F.array(F.lit("x")).alias("roles"), F.col("l_partkey").cast("string").alias("href"), (F.col("l_returnflag") == "N").alias("has_card"), F.concat(F.lit("own"), F.col("l_partkey").cast("string")).alias("name")).alias("e"))
    rec = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("domain")).agg(F.array_sort(F.collect_list(e)).alias("x")).select("domain", F.transform("x", lambda y: y["e"]).alias("entities"))
    ents = read(spark, sf_dir, "part").where("p_partkey % 2 = 0").selectExpr("cast(p_partkey as string) as href", "cast(p_partkey as string) as handle", "p_name as name")
    return lk.resolve_entities(rec, ents).select("domain", F.array_join(F.transform("entities", lambda x: x["name"]), ",").alias("names"))


@query("WITH r AS (SELECT l_orderkey AS k, list(DISTINCT l_suppkey) AS ns, min(l_suppkey) AS p FROM lineitem GROUP BY 1) SELECT k AS zone, array_to_string(list_sort(list_filter(ns, lambda x: x <> p)), ',') AS secondary, array_to_string(list_sort(list_transform(list_filter(ns, lambda x: x <> p), lambda x: x::VARCHAR)), ',') AS secondary_ips FROM r")
def J7_zone_nameservers(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("zone")).agg(F.collect_set("l_suppkey").alias("nameservers"), F.min("l_suppkey").alias("primary"))
    rows = rows.selectExpr("zone", "primary", "nameservers", "array(cast(primary as string)) as primary_ips", "map_from_arrays(nameservers, transform(nameservers, x -> array(cast(x as string)))) as nameserver_ips")
    out = lk.zone_nameservers(rows)
    return out.select("zone", F.array_join(F.transform("secondary", lambda x: x.cast("string")), ",").alias("secondary"), F.array_join(F.array_sort("secondary_ips"), ",").alias("secondary_ips"))


@query("SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS latest, count(*) AS n FROM orders GROUP BY 1")
def O5_collection_results(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) as domain", "cast(null as string) as ip", "'c' as collector", "timestamp '2024-01-01' as ts", "cast(o_orderkey as int) as status_code", "cast(null as string) as error", "cast(null as string) as raw", "struct(o_orderdate, o_orderkey) as offset", "o_custkey")
    best = st.collection_results(rows)
    n = rows.groupBy(F.col("domain").alias("d")).agg(F.count("*").alias("n"), F.first("o_custkey").alias("o_custkey"))
    return best.join(n, F.col("domain") == F.col("d")).select("o_custkey", F.col("status_code").cast("bigint").alias("latest"), "n")


@query(
    """WITH u AS (SELECT o_custkey AS k, max(o_orderdate)::DATE AS d FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT c_custkey, CASE WHEN u.k IS NOT NULL AND (c_custkey % 2 = 0 OR DATE '1996-01-01' <= d) THEN d WHEN c_custkey % 2 = 1 THEN DATE '1996-01-01' END AS geo_ts FROM customer LEFT JOIN u ON k = c_custkey"""
)
def O6_O7_newest_wins(spark, sf_dir):
    stored = read(spark, sf_dir, "customer").selectExpr("c_custkey", "cast(null as double) as price", "if(c_custkey % 2 = 1, date '1996-01-01', null) as geo_ts")
    updates = read(spark, sf_dir, "orders").selectExpr("o_custkey as c_custkey", "cast(o_totalprice as double) as price", "cast(o_orderdate as date) as geo_ts", "if(o_orderstatus = 'O', 0, 1) as status_code")
    return st.newest_wins(stored, updates, ["c_custkey"], ["price"], "geo_ts").select("c_custkey", "geo_ts")


@query(r"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN false WHEN 1 THEN true ELSE doc_id % 2 = 0 END AS storable FROM documents""")
def O8_json_nul_check(spark, sf_dir):
    raw = r"case doc_id % 3 when 0 then concat('{', doc_id) when 1 then concat('{\"a\":\"', doc_id, '\"}') else if(doc_id % 2 = 0, '{\"a\":\"\\\\u0000\"}', '{\"a\":[\"\\u0000\"]}') end"
    return read(spark, sf_dir, "documents").selectExpr("doc_id", f"{raw} as raw").select("doc_id", st.json_storable(F.col("raw")).alias("storable"))


@query(
    """WITH s AS (SELECT DISTINCT CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey ELSE 2 END AS id FROM lineitem)
    SELECT 'source' AS kind, id, 2::DOUBLE AS x FROM s UNION ALL SELECT 'source', l_suppkey, -1 FROM (SELECT DISTINCT l_suppkey FROM lineitem) WHERE l_suppkey NOT IN (SELECT id FROM s)
    UNION ALL SELECT 'offense', l_orderkey, max(l_linenumber) FROM lineitem GROUP BY 2 UNION ALL SELECT 'link', l_orderkey, l_suppkey FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)"""
)
def O10_siem_tables(spark, sf_dir):
    o = F.struct(F.col("l_orderkey").alias("id"), F.lit("d").alias("description"), F.lit(1.0).alias("magnitude"), F.col("l_linenumber").alias("updated"), F.array("l_suppkey").alias("source_ids"))
    rows = read(spark, sf_dir, "lineitem").where("l_suppkey % 2 = 0").select(F.col("l_suppkey").alias("source_id"), F.lit("1.1.1.1").alias("ip"), F.lit(2.0).alias("magnitude"), F.col("l_orderkey").alias("ts"), F.array(o).alias("offenses"))
    rest = read(spark, sf_dir, "lineitem").where("l_suppkey % 2 = 1").select(F.lit(2).cast("bigint").alias("source_id"), F.lit("1.1.1.1").alias("ip"), F.lit(2.0).alias("magnitude"), F.col("l_orderkey").alias("ts"), F.array(o).alias("offenses"))
    sources, offenses, links = st.siem_tables(rows.withColumn("source_id", F.col("source_id").cast("bigint")).unionByName(rest), spark.sql("SELECT CAST(-1 AS BIGINT) AS source_id"))
    parts = (("source", sources, "source_id", "magnitude"), ("offense", offenses, "id", "updated"), ("link", links, "offense_id", "source_id"))
    out = [df.select(F.lit(kind).alias("kind"), F.col(i).cast("bigint").alias("id"), F.col(x).cast("double").alias("x")) for kind, df, i, x in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT 'd' || user_id AS domain, CASE event_type WHEN 'click' THEN 'dns' WHEN 'view' THEN 'tls' ELSE event_type END AS collector, epoch_ms(date_trunc('second', ts)) AS timestamp, count(*) AS n FROM events GROUP BY ALL")
def O12_O13_result_row(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr(
        "case event_type when 'click' then 'processed_DNS' when 'view' then 'processed_TLS' else 'collected_IP_data' end as topic", "concat('d', user_id) as domain", "cast(null as string) as ip",
        "if(event_type in ('click', 'view'), '{\"statusCode\":0}', concat('{\"collector\":\"', event_type, '\"}')) as value", "date_trunc('second', ts) as ts",
    )
    return st.result_row(rows.withColumn("ts", F.col("ts").cast("timestamp"))).groupBy(F.col("domainName").alias("domain"), "collector", "timestamp").agg(F.count("*").alias("n"))


#: Rules with an exception, any-label rules, and one of six labels.
_RULES = ("com", "jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "a.b.c.d.e.f")
_RULED = "CASE c_custkey % 9 WHEN 0 THEN concat('a', c_custkey, '.com') WHEN 1 THEN concat('x.a', c_custkey, '.ck') WHEN 2 THEN 'www.ck' WHEN 3 THEN concat('y', c_custkey, '.www.ck') WHEN 4 THEN concat('b.c', c_custkey, '.kobe.jp') WHEN 5 THEN concat('z', c_custkey, '.city.kobe.jp') WHEN 6 THEN concat('q', c_custkey, '.a.b.c.d.e.f') WHEN 7 THEN concat('a', c_custkey, '.ck') ELSE concat('n', c_custkey, '.none') END"


@query(
    f"""WITH h AS (SELECT c_custkey, {_RULED} AS name FROM customer), l AS (SELECT *, string_split(name, '.') AS l FROM h),
    rules AS (SELECT * FROM (VALUES {", ".join(f"('{x.removeprefix('*.').removeprefix('!')}', {x.startswith('*.')}, {x.startswith('!')})" for x in _RULES)}) t(tail, wild, exempt)),
    c AS (SELECT c_custkey, l, k, array_to_string(l[-k:], '.') AS tail FROM l, range(1, 8) t(k) WHERE k <= len(l)),
    f AS (SELECT c_custkey, CASE WHEN exempt THEN k - 1 END AS e, CASE WHEN NOT exempt AND NOT (wild AND k = len(l)) THEN k + wild::INTEGER END AS n FROM c JOIN rules USING (tail)),
    g AS (SELECT c_custkey, coalesce(max(e), max(n), 0) AS n FROM f GROUP BY 1)
    SELECT c_custkey, name, CASE WHEN coalesce(n, 0) > 0 THEN array_to_string(l[len(l) - n + 1:], '.') ELSE '' END AS suffix, CASE WHEN len(l) > coalesce(n, 0) THEN l[len(l) - coalesce(n, 0)] ELSE '' END AS sld FROM l LEFT JOIN g USING (c_custkey)"""
)
def J8_suffix_rules(spark, sf_dir):
    rules = spark.createDataFrame([(x,) for x in _RULES], "suffix string")
    names = read(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_RULED} as name")
    return split_names(names, "name", rules).select("c_custkey", "name", "suffix", "sld")


@query(
    """WITH n AS (SELECT s_suppkey, 167772160 + s_suppkey * 777 AS a, 167772160 + s_suppkey * 777 + s_suppkey * 13 % 3000 AS z FROM supplier), c AS (SELECT c_custkey, 167772160 + c_custkey * 991 % 90000 AS x FROM customer),
    b AS (SELECT c_custkey, min_by(s_suppkey, (z - a, -a)) AS s_suppkey FROM c JOIN n ON x BETWEEN a AND z GROUP BY 1) SELECT c_custkey, s_suppkey FROM c LEFT JOIN b USING (c_custkey)"""
)
def J3_ranges_lookup(spark, sf_dir):
    """Networks that are no prefixes, many over each other."""
    as_hex = lambda x: f"lpad(lower(hex({x})), 8, '0')"
    a = "167772160 + s_suppkey * 777"
    nets = read(spark, sf_dir, "supplier").selectExpr("4 as version", f"{as_hex(a)} as ip_start", f"{as_hex(f'{a} + s_suppkey * 13 % 3000')} as ip_end", "s_suppkey")
    ips = read(spark, sf_dir, "customer").selectExpr("c_custkey", "c_custkey * 991 % 90000 as x").selectExpr("c_custkey", "concat('10.', x div 65536, '.', x div 256 % 256, '.', x % 256) as ip")
    return lk.range_lookup(ips, nets).select("c_custkey", F.col("network.s_suppkey").alias("s_suppkey"))


@query(
    f"""WITH h AS (SELECT page_id, {HOST_SQL} AS host FROM pages)
    SELECT host AS url, CASE WHEN page_id % 4 = 0 THEN 'This, "is"' || chr(10) || 'it' WHEN page_id % 4 = 1 THEN 'malware' WHEN page_id % 4 = 2 THEN 'phish' ELSE 'unknown' END AS category FROM h WHERE page_id % 5 > 0"""
)
def S8_S10_S11_quoted_sources(spark, sf_dir):
    """Source lists as data: quoted cells with delimiters, quotes and line ends, and getters and mappers in columns. Each record is
    one of a text of records, and its category is read from its own line."""
    rule = "case page_id % 4 when 0 then concat(host, ',\"This, \"\"is\"\"\\nit\",this,,') when 1 then concat('\"', host, '\",,csv,;2,\"kit;mal=malware\"') when 2 then concat(host, ',x,txt,\"kind=([A-Za-z]+)\",\"p.*sh=phish;x\"') else concat(host, ',x,other,,') end"
    records = hosts(spark, sf_dir).withColumnRenamed("domain_name", "host").selectExpr("page_id", f"case when page_id % 5 = 0 then 'short,line' else {rule} end as value")
    texts = records.groupBy((F.col("page_id") % 50).alias("g")).agg(F.array_join(F.collect_list("value"), "\n").alias("text"))
    rows = r.source_definitions(texts.select(F.explode(r.csv_records(F.col("text"), ",")).alias("value")), 0, 1, 2, 3, 4)
    lines = rows.withColumn("value", F.lit("1;2;Malicious kind=PoSH;kind=punish"))
    return r.categorised(lines).select("url", "category")
