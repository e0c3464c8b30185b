"""Hand-computed cases of what SQL oracles don't pin."""

import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from netsift.functions import text as t
from netsift.operators import conversion as cv
from netsift.operators import extract, html, lookups, merge, records, routing, scoring, stored
from netsift.sources import results


def one(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first().v


def test_sorted_distinct_longs(spark):
    for a, b in (([3, 4, 3, 5, 1, 4], [1, 3, 4, 5]), ([1, 2, 3], [1, 2, 3]), ([7, 7, 7], [7]), ([], []), ([-1, -3, -2, -1, 0], [-3, -2, -1, 0])):
        array = f"cast(array({', '.join(map(str, a))}) as array<bigint>)"
        assert one(spark, t.sorted_distinct(array)) == b


def test_entropy_is_divided_by_the_length(spark):
    assert one(spark, t.norm_entropy("''")) == 0
    assert math.isclose(one(spark, t.norm_entropy("'aabb'")), 1 / 4)


def test_hashes(spark):
    assert one(spark, t.simhash32("''")) == 4294967295
    assert one(spark, t.md5_mod("'abc'")) == int(hashlib.md5(b"abc").hexdigest(), 16) % 2147483647
    assert one(spark, t.longest_run("'aabbbc'")) == 3


def test_ip_prefixes(spark):
    assert one(spark, t.ip_prefix("'10.2.3.4'")) == str(10 * 256 + 2)
    assert one(spark, t.ip_prefix("'2001:db8::1'")) == "20010db800000000"
    rows = spark.createDataFrame([("1.2.3.4",), ("2001:DB8::1",), ("::",), ("1.2.3",), ("x",), (None,)], "ip string").select(lookups.address_hex(F.col("ip")).alias("h")).collect()
    assert [r.h for r in rows] == ["01020304", "20010db8" + "0" * 23 + "1", "0" * 32, None, None, None]


def test_ipv4_inside(spark):
    assert [one(spark, t.ipv4_inside(f"'{s}'")) for s in ("a1.2.3.4.com", "a1-2-3-4.com", "1.2.3.com")] == [True, True, False]


def results_of(spark, rows):
    return spark.createDataFrame([(d, c, v, s, None, o, ts) for d, c, v, s, o, ts in rows], "domain string, collector string, value string, status_code int, error string, offset long, ts_s long").withColumn("ts", F.timestamp_seconds("ts_s"))


def test_more_useful_does_not_depend_on_order(spark):
    rows = [("d", "dns", "a", 0, 1, 2), ("d", "dns", "b", 10, 2, 5), ("d", "dns", "c", 0, 3, 1)]
    for order in (rows, rows[::-1]):
        assert merge.more_useful(results_of(spark, order), "domain").first().entry.value == "a"


def test_merge_batch_cases(spark):
    none, some = '{"ips":[],"dnsData":{}}', '{"ips":[{"ip":"1.1.1.1","rrType":"A"}],"dnsData":{"A":["1.1.1.1"]}}'
    own = [("a", "zone", "{}", 0, 1, 1), ("a", "dns", none, 0, 2, 2), ("a", "rdap-dn", "{}", 0, 3, 3), ("b", "zone", "{}", 0, 4, 1), ("b", "dns", some, 0, 5, 2), ("b", "rdap-dn", "{}", 0, 6, 3), ("c", "rdap-dn", "{}", 0, 7, 1)]
    own += [("e", "zone", "{}", 0, 8, 1), ("e", "dns", some, 0, 9, 2), ("e", "rdap-dn", "{}", 0, 10, 3), ("e", "tls", "{}", 0, 11, 4)]
    ips = [("e", "1.1.1.1", c, "{}", 0, 20 + i, 5) for i, c in enumerate(merge.IP_COLLECTORS)] + [("x", "1.1.1.1", "rtt", "{}", 0, 30, 5)]
    ip = spark.createDataFrame([(d, i, c, v, s, None, o, ts) for d, i, c, v, s, o, ts in ips], "domain string, ip string, collector string, value string, status_code int, error string, offset long, ts_s long").withColumn("ts", F.timestamp_seconds("ts_s"))
    got = {r.domain: (r.is_complete, None if r.ips is None else len(r.ips)) for r in merge.merge_batch(results_of(spark, own), ip).collect()}
    assert got == {"a": (True, None), "b": (False, 1), "e": (True, 1)}
    more = ip.unionByName(ip.where("ip = '1.1.1.1' and collector = 'rtt' and domain = 'e'").withColumn("ip", F.lit("2.2.2.2")))
    assert not merge.merge_batch(results_of(spark, own), more).where("domain = 'e'").first().is_complete


def test_html_counts(spark):
    page = '<html><body><!-- <a href="x"> --><a href="http://a.com/x">1</a><a href="/y" style="display: none">2</a><script>eval(unescape("%41")); document.write(1)</script><script src="a.js"></script><form action="#"></form><input type="hidden"></body></html>'
    row = html.html_features(spark.createDataFrame([(page,), (None,)], "html string")).collect()
    full, empty = (row[0], row[1]) if row[0].html else (row[1], row[0])
    wanted = {"html_num_of_anchors": 2, "html_num_of_anchors_to_https": 1, "html_num_of_hidden_elements": 1, "html_num_of_input_hidden": 1, "html_eval": 1, "html_escape": 0, "html_unescape": 1, "html_document_write": 1, "html_num_of_external_js": 1, "html_num_of_scripts": 2, "html_num_of_form_hash": 1, "html_malicious_form": 1, "html_num_of_internal_hrefs": 1, "html_num_of_tags": 6, "html_num_of_input_password": 0, "html_most_common": 0.5}
    assert {k: full[k] for k in wanted} == wanted
    assert empty.html_num_of_words == 0 and empty.html_num_of_tags == 0 and empty.html_no_hrefs == 1


def test_tls_chain_stops_at_expiry(spark):
    cert = "named_struct('not_before', timestamp'2024-01-01', 'not_after', timestamp'{}', 'issuer_org', 'o', 'issuer_cn', 'c', 'extensions', array(named_struct('oid', '2', 'critical', true)), 'san', array('a.b'), 'eku', array('serverAuth'), 'policies', array('2.5'), 'is_ca', true, 'aki', 'a', 'ski', 'b')"
    rows = spark.sql(f"SELECT named_struct('protocol', 'TLSv1.3', 'cipher', 'AES128-SHA', 'certs', array({cert.format('2025-01-01')}, {cert.format('2024-02-01')}, {cert.format('2026-01-01')})) AS tls UNION ALL SELECT null")
    got = records.tls_features(rows, F.lit("2024-06-01").cast("timestamp")).collect()
    full = next(r for r in got if r.tls_has_tls)
    assert (full.tls_chain_len, full.tls_expired_chain, full.tls_broken_chain, full.tls_leaf_cert_validity_len, full.tls_root_cert_validity_len) == (3, 1, 0, 366, -1)
    assert (full.tls_total_extension_count, full.tls_critical_extensions, full.tls_subject_count, full.tls_CA_certs_in_chain_ratio, full.tls_negotiated_version_id) == (0, 0, 1, 0.5, 3)
    assert next(r for r in got if not r.tls_has_tls).tls_chain_len is None
    assert (full.tls_with_policies_crt_count, full.tls_common_name_count, full.tls_percentage_crt_with_policies) == (1, 1, 0.5)
    assert len([c for c in full.asDict() if c.startswith("tls_")]) == 24


def test_reading_of_results(spark):
    raw = spark.createDataFrame([(b"d", b'{"statusCode":0,"error":null}', 0, 1), (b"e", b"broken", 0, 2), (b"f", None, 0, 3)], "key binary, value binary, partition int, offset long").withColumn("timestamp", F.timestamp_seconds(F.lit(10)))
    assert {r.domain: r.status_code for r in results.domain_results(raw, "dns").collect()} == {"d": 0, "e": -1, "f": -1}
    good, bad = results.validate_merged(results.parse_merged(raw, "statusCode int"))
    assert [r.domain_name for r in good.collect()] == ["d"] and [(r.domain_name, r.error) for r in bad.collect()] == [("e", "Invalid data")]


def test_lists_and_categories(spark):
    lines = spark.createDataFrame([("  # no.com",), ("",), ("see www.a-b.com/x and c.com",), ("; x.org",), ("nothing",)], "value string")
    assert [r.name for r in results.plain_list(lines, "x").collect()] == ["www.a-b.com"]
    df = spark.createDataFrame([("a;b;c",)], "line string")
    got = df.select(results.category_getter(F.col("line"), ";1").alias("cell"), results.category_getter(F.col("line"), "/^(a)/").alias("group"), results.category_getter(F.col("line"), None).alias("none"), results.category_getter(F.col("line"), "fixed").alias("fixed")).first()
    assert (got.cell, got.group, got.none, got.fixed) == ("b", "a", "unknown", "fixed")


def test_dns_outcomes(spark):
    rows = spark.createDataFrame([("a", "A", "Timeout"), ("a", "MX", "Timeout"), ("b", "A", "Timeout"), ("b", "MX", "x"), ("c", "A", None), ("c", "MX", "x")], "domain string, type string, error string")
    got = {r.domain: (r.status_code, r.errors) for r in routing.classify_dns(rows).collect()}
    assert got == {"a": (11, {"A": "Timeout", "MX": "Timeout"}), "b": (20, {"A": "Timeout", "MX": "x"}), "c": (0, {"MX": "x"})}


def test_transform_groups_keep_their_order():
    groups = {"a": 1, "b": 2, "c": 3}
    assert routing.select_transforms(groups, ["c", "a", "none"]) == [1, 3] and routing.select_transforms(groups) == [1, 2, 3]


def test_scores_and_failed_batches(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "domain_name string, ip_count int")

    def broken(batch):
        raise RuntimeError("no model")

    got = scoring.score(df, broken).collect()
    assert [(r.domain_name, r.aggregate_probability, r.error) for r in got] == [("a", -1.0, "no model")]


def test_newest_wins_and_upsert(spark):
    old = spark.createDataFrame([("a", 1.0, 5), ("b", 1.0, None), ("c", 1.0, 9)], "ip string, v double, ts long")
    new = spark.createDataFrame([("a", 2.0, 5, 0), ("a", 3.0, 4, 0), ("b", 2.0, 1, 0), ("c", 2.0, 8, 0), ("c", 2.0, 20, 1)], "ip string, v double, ts long, status_code int")
    assert {r.ip: (r.v, r.ts) for r in stored.newest_wins(old, new, ["ip"], ["v"], "ts").collect()} == {"a": (2.0, 5), "b": (2.0, 1), "c": (1.0, 9)}
    merged = stored.upsert(old, spark.createDataFrame([("a", 7.0, 1), ("z", 8.0, 1)], old.schema), ["ip"])
    assert {r.ip: r.v for r in merged.collect()} == {"a": 7.0, "b": 1.0, "c": 1.0, "z": 8.0}


def test_rdap_and_whois_conversion(spark):
    body = '{"events":[{"eventAction":"registration","eventDate":"2020-01-01T00:00:00Z"},{"EventAction":"expiration","EventDate":"bad"}],"entities":[{"roles":["registrar"],"vcardArray":["vcard",[["fn",{},"text","Name"],["email",{},"text","a@b.c"]]]},{"roles":[{"value":"registrant"}],"vcardArray":["vcard",[["fn",{},"text","R"]]]}],"secureDNS":{"delegationSigned":true}}'
    row = cv.rdap_columns(spark.createDataFrame([(body,)], "b string"), F.col("b")).first()
    assert row.rdap_registration_date.year == 2020 and row.rdap_expiration_date is None and row.rdap_dnssec is True
    assert row.rdap_entities["registrar"][0].name == "Name" and row.rdap_entities["registrar"][0].email == "a@b.c" and row.rdap_entities["registrant"][0].name == "R"
    who = spark.sql("SELECT map('creation_date', array('2001-01-01', '2002-01-01'), 'expires', array('2003-01-01', '2004-01-01'), 'x', null) AS m")
    dates = who.select(*[c.alias(k) for k, c in cv.whois_dates(F.col("m")).items()], cv.strip_empty(F.col("m")).alias("m")).first()
    assert (dates.created.year, dates.expires.year, dates.updated, sorted(dates.m)) == (2001, 2004, None, ["creation_date", "expires"])


RECORD = {
    "zone": {"zone": "example.com", "soa": {"primaryNS": "ns.example.com", "respMailboxDname": "m.example.com", "serial": "1", "refresh": 7, "retry": 8, "expire": 9, "minTTL": 10}},
    "dnsResult": {"statusCode": 0, "lastAttempt": 1700000000000, "ips": [{"ip": "1.2.3.4", "rrType": "A"}, {"ip": "2001:db8::1", "rrType": "AAAA"}], "dnsData": {"ttlValues": {"A": 60, "MX": 200}, "A": ["1.2.3.4"], "CNAME": {"value": "x.y", "relatedIPs": []}, "MX": [{"value": "mail.example.com", "priority": 5}], "NS": [{"nameserver": "ns"}], "TXT": ["v=spf1 -all", "ms=1"]}},
    "tlsResult": {"statusCode": 0, "html": "<p>hello</p>", "tlsData": {"protocol": "TLSv1.3", "cipher": "AES128-SHA", "certs": [{"not_before": "2024-01-01T00:00:00Z", "not_after": "2030-01-01T00:00:00Z", "issuer_org": "o", "issuer_cn": "c", "extensions": [{"oid": "2", "critical": True}], "policies": ["2.5"]}]}},
    "rdapDomainResult": {"statusCode": 0, "whoisParsed": {"created_date": "2001-01-01", "expires": ["2030-01-01", "2031-01-01"]}, "whoisRaw": "Domain: x\nUpdated Date: 2020-05-06\n"},
    "ipResults": {
        "1.2.3.4": {"rtt": {"statusCode": 0, "data": {"avg": 10.0, "received": 1}}, "rtt-2": {"statusCode": 0, "data": {"avg": 40.0, "received": 2}}, "nerd": {"statusCode": 0, "data": {"reputation": 0}}, "geo-asn": {"statusCode": 0, "data": {"asn": 5, "networkAddress": "/1.2.0.0", "prefixLength": 16, "countryCode": "CZ", "latitude": 50.0, "longitude": 14.0}}},
        "2001:db8::1": {"rdap-ip": {"statusCode": 0, "data": {"ipVersion": "v6", "prefixLen": 32, "adminName": "abab"}}},
    },
}


def groups(spark):
    return extract.feature_groups(spark.sql("SELECT 'CZ' AS country, 24 AS id"), F.lit("2024-06-01").cast("timestamp"))


def test_flat_record(spark):
    row = cv.flat_record(results.parse_merged(spark.createDataFrame([("example.com", json.dumps(RECORD))], "key string, value string"), results.MERGED).select(F.col("domain_name").alias("domain"), "data.*")).first()
    assert (row.domain_name, row.dns_zone, row.dns_SOA.primary_ns, row.dns_SOA.min_ttl, row.dns_zone_SOA, row.dns_CNAME, sorted(row.dns_ttls)) == ("example.com", "example.com", "ns.example.com", 10, None, "x.y", [60, 200])
    assert (row.dns_email_extras.spf, row.dns_email_extras.dkim, row.html, row.countries, row.latitudes) == (True, False, "<p>hello</p>", ["CZ"], [50.0])
    four, six = row.ip_data
    assert (four.average_rtt, four.as_address, four.reputation, six.average_rtt, six.reputation, six.rdap.ip_version, six.rdap.prefix_len, six.as_address) == (30.0, "1.2.0.0/16", -1.0, 0.0, -1.0, "6", 32, None)
    assert [d and d.year for d in (row.rdap_registration_date, row.rdap_expiration_date, row.rdap_last_changed_date)] == [2001, 2031, 2020]


def test_files_of_records_give_whole_vectors(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/list.json").write_text(json.dumps([{"domain_name": "example.com", **RECORD}, {"domain_name": "b.org"}, {"zone": None}]))
    (tmp_path / "in/one.json").write_text(json.dumps({"domain_name": "c.net", "dnsResult": {"statusCode": 0}}))
    (tmp_path / "in/broken.json").write_text("{")
    errors = extract.extract_files(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", groups(spark)).collect()
    assert sorted((r.domain_name or "", r.error) for r in errors) == [("", "Invalid data"), ("", "Missing domain name")]
    rows = {r.domain_name: r for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert set(rows) == {"example.com", "b.org", "c.net"}
    full = rows["example.com"].asDict()
    assert len(full) == 264 and {p: sum(c.startswith(p) for c in full) for p in ("lex_", "html_", "dns_", "ip_", "geo_", "tls_", "rdap_ip_")} == {"lex_": 62, "html_": 87, "dns_": 40, "ip_": 8, "geo_": 18, "tls_": 24, "rdap_ip_": 10}
    assert (full["ip_mean_average_rtt"], full["dns_soa_retry"], full["tls_leaf_cert_validity_len"], full["lex_name_len"], full["html_num_of_paragraphs"], full["rdap_ip_longest_v6_prefix_len"]) == (15.0, 8, 2192, 11, 1, 32)
    assert rows["b.org"].tls_has_tls is False and rows["b.org"].ip_count == 0


def test_groups_can_be_left_out(spark):
    rows, errors = extract.extract(spark.createDataFrame([("a.com", json.dumps(RECORD)), (None, "{}"), ("x", None)], "key string, value string"), groups(spark), ["drop", "ip"])
    assert [c for c in rows.columns if c not in ("domain_name", "dns_has_dnskey")] == [c for c in rows.columns if c.startswith("ip_")]
    assert [r.error for r in errors.collect()] == ["Missing domain name"] and rows.count() == 1


def test_networks_by_prefix(spark):
    nets = [(4, "0a000000", 8, "ten"), (4, "0a020000", 15, "deep"), (4, "0a030180", 25, "deepest"), (4, "00000000", 0, "all"), (6, "20010db8" + "0" * 24, 32, "doc"), (6, "20010db8" + "8000" + "0" * 20, 33, "half"), (6, "2" + "0" * 31, 3, "global")]
    table = spark.createDataFrame(nets, "version int, ip_start string, prefix_len int, label string").withColumn("ip_end", F.lit(""))
    asked = ["10.0.0.1", "10.3.1.127", "10.3.1.128", "11.0.0.1", "2001:db8::5", "2001:db8:8000::5", "3fff::1", "fe80::1", "none", None, "10.0.0.1"]
    got = lookups.range_lookup(spark.createDataFrame([(x,) for x in asked], "ip string"), table).collect()
    wanted = {"10.0.0.1": "ten", "10.3.1.127": "deep", "10.3.1.128": "deepest", "11.0.0.1": "all", "2001:db8::5": "doc", "2001:db8:8000::5": "half", "3fff::1": "global", "fe80::1": None, "none": None, None: None}
    assert len(got) == len(asked) and all((r.network and r.network.label) == wanted[r.ip] for r in got)


def test_too_many_countries_stop_the_job(spark):
    ids = spark.range(records.MOST_COUNTRIES + 1).selectExpr("cast(id as string) as country", "id")
    with pytest.raises(Exception, match="too many rows"):
        records.geo_features(spark.sql("SELECT array('1') AS countries, array(1D) AS latitudes, array(1D) AS longitudes"), ids).collect()


def test_lifetimes_name_their_results(spark):
    at = lambda *seconds: [("d", s, o) for o, s in seconds]
    rows = spark.createDataFrame(at((12, 0), (10, 20), (11, 10), (3, 200)), "domain string, s long, offset long").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r.n, r.offsets) for r in merge.lifetimes(rows, "60 seconds").collect())
    assert got == [(1, [3]), (3, [10, 11, 12])]


def test_entropies_count_every_character_once_and_as_before(spark):
    words = ["", "a", "aabb", "a.b-c", "žluťoučký kůň", "😀😀x", "a\nb\\", "$1$1", None]
    rows = spark.createDataFrame([(w,) for w in words], "s string")
    before = f"if(length(s) > 0, {t.entropy_of(t.chars('s'))} / length(s), 0D)"
    for a, b in rows.select(F.expr(t.norm_entropy("s")), F.expr(before)).union(rows.select(records.entropy_column(F.col("s")), F.expr(before))).collect():
        assert a == b
    assert "filter" not in t.norm_entropy("s")  # no lambda for each pair of characters


def test_each_text_of_a_record_is_parsed_once(spark):
    raw = spark.createDataFrame([("a.com", '{"zone": {"zone": "a.com"}}')], "key string, value string").withColumn("value", F.translate("value", "~", "-"))
    good, _ = results.validate_merged(results.parse_merged(raw, results.MERGED))
    flat = cv.flat_record(good.select(F.col("domain_name").alias("domain"), "data.*"))
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1
    assert plan.count("from_json(StructField(events") == 1
    assert [r.dns_zone for r in flat.collect()] == ["a.com"]


def test_roles_versions_and_networks_in_all_their_forms(spark):
    """Roles as text, objects or both; versions and addresses with and without what is cut off; answers of several rtt collectors."""
    texts = ['["a", "b"]', '[{"value": "b"}]', '["a", {"value": "b"}]', "[null]", "[]", '"x"', '{"value": "c"}', "null", "", "broken", "[1, 2]", '[["a"]]', None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = {r.i: r.r for r in rows.select("i", cv.entity_roles(F.col("x")).alias("r")).collect()}
    assert [got[i] for i in range(len(texts))] == [["a", "b"], ["b"], ["a", '{"value":"b"}'], [None], [], None, ["c"], None, None, None, ["1", "2"], ['["a"]'], None]
    data = "struct<networkAddress:string, prefixLength:bigint, asn:bigint, countryCode:string, latitude:double, longitude:double, avg:double, received:bigint, reputation:double, ipVersion:string, prefixLen:int, adminName:string, adminEmail:string>"
    none = dict.fromkeys(("networkAddress", "prefixLength", "asn", "countryCode", "latitude", "longitude", "avg", "received", "reputation", "ipVersion", "prefixLen", "adminName", "adminEmail"))
    ok = lambda code=0, **own: {"statusCode": code, "data": none | own}
    cases = [("/1.0.0.0", 8, "v4"), ("2::", None, "v6"), ("", 1, "v5"), (None, 4, "4"), ("//x", 2, "v46"), ("/", 3, None)]
    results = {f"i{k}": {"geo-asn": ok(networkAddress=a, prefixLength=p), "rdap-ip": ok(ipVersion=v), "rtt": ok(avg=2.0, received=k), "rtt2": ok(avg=8.0, received=1), "rtt3": ok(11, avg=99.0, received=9), "xrtt": ok(avg=50.0, received=9)} for k, (a, p, v) in enumerate(cases)}
    ips = [{"ip": x, "rrType": "A"} for x in [*results, "absent"]]
    df = spark.createDataFrame([(ips, results)], f"ips array<struct<ip:string,rrType:string>>, results map<string,map<string,struct<statusCode:int, data:{data}>>>")
    one = df.select(F.inline(cv.ip_records(F.col("ips"), F.col("results")))).collect()
    assert [(r.as_address, r.rdap.ip_version if r.rdap else None, round(r.average_rtt, 6)) for r in one] == [("1.0.0.0/8", "4", 8.0), ("2::", "6", 5.0), ("/1", "v5", 4.0), (None, "4", 3.5), ("/x/2", "v46", 3.2), ("/3", None, 3.0), (None, None, 0.0)]


def test_digest_is_taken_once_for_all_parts(spark):
    assert "aggregate" not in t.md5_mod("x")
    texts = ["", "a", "žluť", "x" * 1000, None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").selectExpr(f"{t.md5_mod('x')} as h").collect()
    assert [r.h for r in rows] == [None if x is None else int(hashlib.md5(x.encode()).hexdigest(), 16) % 2147483647 for x in texts]
