"""Suffix rules, ranges of addresses and source lists, against plain Python."""

import csv
import io
import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from netsift.functions import domains
from netsift.operators import lookups
from netsift.sources import results

# cases as the public test vectors of the suffix list have them: name, rules, suffix, registered name
RULES = ["com", "biz", "jp", "ac.jp", "kyoto.jp", "ide.kyoto.jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "us", "ak.us", "k12.ak.us", "uk.com", "公司.cn", "cn", "рф", "a.b.c.d.e.f"]
CASES = {
    "example.com": ("com", "example"), "b.example.com": ("com", "example"), "WWW.Example.COM": ("com", "example"), "com": ("com", ""), "example.uk.com": ("uk.com", "example"), "a.b.example.uk.com": ("uk.com", "example"),
    "test.ac.jp": ("ac.jp", "test"), "b.test.kyoto.jp": ("kyoto.jp", "test"), "a.b.ide.kyoto.jp": ("ide.kyoto.jp", "b"), "c.kobe.jp": ("c.kobe.jp", ""), "b.c.kobe.jp": ("c.kobe.jp", "b"), "a.b.c.kobe.jp": ("c.kobe.jp", "b"),
    "city.kobe.jp": ("kobe.jp", "city"), "www.city.kobe.jp": ("kobe.jp", "city"), "kobe.jp": ("jp", "kobe"), "test.ck": ("test.ck", ""), "b.test.ck": ("test.ck", "b"), "www.ck": ("ck", "www"), "www.www.ck": ("ck", "www"), "ck": ("", "ck"),
    "test.k12.ak.us": ("k12.ak.us", "test"), "食狮.公司.cn": ("公司.cn", "食狮"), "xn--85x722f.xn--55qx5d.cn": ("xn--55qx5d.cn", "xn--85x722f"), "x.xn--p1ai": ("xn--p1ai", "x"), "x.рф": ("рф", "x"),
    "x.a.b.c.d.e.f": ("a.b.c.d.e.f", "x"), "y.b.c.d.e.f": ("", "f"), "nowhere.test": ("", "test"), "": ("", ""),
}


def test_suffix_rules(spark):
    rules = spark.createDataFrame([(r,) for r in [*RULES, " COM ", ""]], "suffix string")
    names = spark.createDataFrame([(n,) for n in [*CASES, None]], "domain_name string")
    got = {r.domain_name: (r.suffix, r.sld) for r in domains.split_names(names, suffixes=rules).collect()}
    assert {k: v for k, v in got.items() if k is not None} == CASES
    assert domains.split_names(names, suffixes=rules.limit(0)).where("suffix <> ''").count() == 0


def hexed(ip):
    try:
        x = ipaddress.ip_address(ip)
    except ValueError:
        return None
    x = getattr(x, "ipv4_mapped", None) or x
    return x.packed.hex()


def test_addresses(spark):
    rng = random.Random(1)
    given = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:", ":1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", ":::", "1:::2", "::ffff:1.2.3.4", "::FFFF:0102:0304", "64:ff9b::1.2.3.4", "::1.2.3.256", "1.2.3.4::", "::1.2.3", "12345::", "g::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "1.2.3.4", "", ":", "1:2:3:4::5:6:7:8", "fe80::1%eth0"]
    given += [":".join(rng.choice(["", "0", "1f", "abcd", "1.2.3.4", "12345"]) for _ in range(rng.randrange(1, 10))) for _ in range(400)]
    given = list(dict.fromkeys(given))
    rows = spark.createDataFrame([(g,) for g in given], "ip string").select("ip", lookups.address_hex(F.col("ip")).alias("h")).collect()
    wanted = {g: None if "%" in g else hexed(g) for g in given}
    assert {r.ip: r.h for r in rows} == wanted and sum(v is not None for v in wanted.values()) > 20


@pytest.mark.parametrize("bits", [32, 128])
def test_ranges_that_are_no_networks(spark, bits):
    rng = random.Random(bits)
    top, digits = (1 << bits) - 1, bits // 4
    base = rng.randrange(top >> 12) << 8
    ranges = [(0, top), (5, 4)]
    for _ in range(60):
        a = base + rng.randrange(3000)
        ranges.append((a, min(top, a + rng.choice([0, 1, 7, 100, 255, 1000]))))
    table = spark.createDataFrame([(4 if bits == 32 else 6, f"{a:0{digits}x}", f"{z:0{digits}x}", i) for i, (a, z) in enumerate(ranges)], "version int, ip_start string, ip_end string, i int")
    asked = [base + rng.randrange(4500) for _ in range(300)] + [0, top]
    text = {str((ipaddress.IPv4Address if bits == 32 else ipaddress.IPv6Address)(x)): x for x in asked}
    got = {r.ip: r.network.i for r in lookups.range_lookup(spark.createDataFrame([(t,) for t in text], "ip string"), table).collect()}
    for t, x in text.items():
        width, start = min((z - a, -a) for a, z in ranges if a <= x <= z)
        a, z = ranges[got[t]]
        assert (z - a, -a) == (width, start), t


CELLS = ["http://a.example.com/x", "b.example.org", 'say "hi"', "a, b", "", "two\nlines", "phish", "csv", "txt", ";2", "(mal\\w+)", "x=y;z", "no host"]


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "^", "]", "\\", "|"])
def test_quoted_csv(spark, tmp_path, delimiter):
    rng = random.Random(7)
    rows = [[rng.choice(CELLS) for _ in range(rng.randrange(1, 7))] for _ in range(300)]
    text = io.StringIO()
    csv.writer(text, delimiter=delimiter, lineterminator="\n").writerows(rows)
    (tmp_path / "list.csv").write_text(text.getvalue())
    host = re.compile(results.HOST)
    want = lambda rows: sorted(((r[1], r[3], r[2], None, r[0]) for r in rows if len(r) > 3 and host.search(r[1])), key=str)
    options = {"column": 1, "category": 3, "category_source": 2, "mapper": 0, "delimiter": delimiter}
    got = results.load_source_csv(spark, f"file://{tmp_path}/list.csv", **options)
    assert sorted(((r.url, r.category, r.category_source, r.getter_def, r.mapper_def) for r in got.collect()), key=str) == want(rows)
    single = [r for r in rows if not any("\n" in c for c in r)]
    text = io.StringIO()
    csv.writer(text, delimiter=delimiter, lineterminator="\n").writerows(single)
    lines = spark.createDataFrame([(x,) for x in text.getvalue().split("\n") if x], "value string")
    got = results.source_definitions(lines, **options)
    assert sorted(((r.url, r.category, r.category_source, r.getter_def, r.mapper_def) for r in got.collect()), key=str) == want(single)


def by_hand(line, category, source, getter, mapper):
    if source != "this":
        if not getter:
            category = "unknown"
        elif source == "csv":
            cells, i = line.split(getter[0]), int(getter[1:])
            category = cells[i] if 0 <= i < len(cells) else "unknown"
        elif source == "txt":
            m = re.search(getter, line)
            category = m.group(1) if m and m.groups() and m.group(1) else "unknown"
        else:
            category = "unknown"
    if not mapper or category == "unknown":
        return category
    for rule in mapper.split(";"):
        pattern, *name = rule.split("=")
        if re.search(pattern, category, re.IGNORECASE):
            return name[0] if len(name) == 1 else "unknown"
    return "unknown"


def test_categories_by_their_sources(spark):
    lines = ["h.com;Phish-kit;x", "h.com", "malware: dropper", "a|b|c", "", "h.com;;last"]
    getters = [None, "", ";1", "|2", ";9", ";-1", r"(\w+):", r"\w+", "(zzz)?", "]0"]
    mappers = [None, "", "phish=phishing;mal.*=malware", "kit=a;phish=b", "=all", "x", "a=b=c"]
    cases = [(x, "given", s, g, m) for x in lines for s in ("this", "csv", "txt", "other") for g in getters for m in mappers if not (s == "csv" and g and not re.fullmatch(r".-?\d+", g))]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, value string, category string, category_source string, getter_def string, mapper_def string")
    got = {r.i: r.category for r in results.categorised(rows).collect()}
    assert {i: got[i] for i in got if got[i] != by_hand(*cases[i])} == {}
