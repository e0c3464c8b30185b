"""Tables that streams write, over failures, restarts and compaction."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from netsift.streaming import merge as sm
from netsift.streaming import tables as tb

SCHEMA = "domain string, ip string, collector string, raw string, status_code int, error string, ts timestamp, offset long"
BASE = dt.datetime(2024, 1, 1)


def results(spark, rows):
    """Rows (domain, ip, collector, raw, status, second) in their order."""
    return spark.createDataFrame([(d, ip, c, v, s, None, BASE + dt.timedelta(seconds=at), i) for i, (d, ip, c, v, s, at) in enumerate(rows)], SCHEMA)


def geo(country):
    return json.dumps({"data": {"countryCode": country, "asn": 1}})


BATCHES = [
    [("a", None, "zone", "{}", 0, 1), ("a", "1.1.1.1", "geo-asn", geo("CZ"), 0, 5), ("b", None, "zone", "{broken", 0, 2)],
    [("a", None, "zone", '{"x":1}', 0, 1), ("a", "1.1.1.1", "geo-asn", geo("SK"), 0, 4), ("a", "1.1.1.1", "nerd", '{"data":{"reputation":0.5}}', 0, 6)],
    [("a", "1.1.1.1", "geo-asn", geo("AT"), 0, 5), ("a", "1.1.1.1", "geo-asn", geo("FR"), 10, 9), ("c", None, "dns", '{"t":"a\\u0000b"}', 0, 0)],
]


def start(spark, tmp_path, **options):
    tables = tb.Tables(spark, f"file://{tmp_path}/tables", tb.RESULT_TABLES, **options)
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    query = tb.store_stream(rows, tables, tb.result_frames, f"file://{tmp_path}/at", availableNow=True)
    return tables, query


def feed(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        results(spark, rows).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")


def check(tables):
    read = lambda name, *columns: sorted(map(tuple, tables.read(name).select(*columns).collect()), key=str)
    second = lambda c: (F.unix_timestamp(c) - 1704067200).alias("s")
    assert read("domains", "domain", second("last_update")) == [("a", 1), ("b", 2), ("c", 0)]
    assert read("ips", "domain", "ip") == [("a", "1.1.1.1")]
    assert read("geo", "ip", "countryCode", second("ts")) == [("1.1.1.1", "AT", 5)]
    assert read("reputation", "ip", "reputation") == [("1.1.1.1", 0.5)]
    assert read("errors", "domain", "source", "error") == [("b", "zone", "Invalid JSON"), ("c", "dns", "Invalid JSON")]
    wanted = [("a", "1.1.1.1", "geo-asn", 4, geo("SK")), ("a", "1.1.1.1", "geo-asn", 5, geo("AT")), ("a", "1.1.1.1", "geo-asn", 9, geo("FR")), ("a", "1.1.1.1", "nerd", 6, '{"data":{"reputation":0.5}}'), ("a", None, "zone", 1, '{"x":1}'), ("b", None, "zone", 2, None), ("c", None, "dns", 0, None)]
    assert read("collection_results", "domain", "ip", "collector", second("ts"), "raw") == sorted(wanted, key=str)


@pytest.mark.parametrize("compact_after", [50, 1])
def test_batches_are_stored(spark, tmp_path, compact_after):
    for rows in BATCHES:
        feed(spark, tmp_path, [rows])
        tables, query = start(spark, tmp_path, compact_after=compact_after)
        query.awaitTermination()
    check(tables)
    assert tables.append("results", tables.done("results"), {}) is False


@pytest.mark.parametrize("where", ["staging", "switch", "after"])
def test_a_batch_that_fails_is_there_once(spark, tmp_path, monkeypatch, where):
    """A failure while tables are staged, between staging and the switch, or after it, before the stream knows."""
    feed(spark, tmp_path, BATCHES[:1])
    start(spark, tmp_path)[1].awaitTermination()
    feed(spark, tmp_path, BATCHES[1:2])
    switch, frames = tb.Tables._switch, tb.result_frames

    def broken(self, *args):
        if where == "after":
            switch(self, *args)
        raise OSError("lost")

    def half(df):
        made = frames(df)
        return {k: v for k, v in made.items() if k in ("domains", "errors")} | {"collection_results": made["geo"].select(F.raise_error(F.lit("lost")).alias("domain"))}

    with monkeypatch.context() as patch:
        if where == "staging":
            patch.setattr(tb, "result_frames", half)
        else:
            patch.setattr(tb.Tables, "_switch", broken)
        tables, query = start(spark, tmp_path)
        with pytest.raises(Exception):
            query.awaitTermination()
    assert tables.read("collection_results").where("collector = 'nerd'").count() == (where == "after")
    feed(spark, tmp_path, BATCHES[2:])
    tables, query = start(spark, tmp_path)
    query.awaitTermination()
    check(tables)


def test_old_deltas_and_ledgers_go(spark, tmp_path):
    tables = tb.Tables(spark, f"file://{tmp_path}/tables", {"errors": tb.RESULT_TABLES["errors"]}, compact_after=3, kept=2)
    row = spark.createDataFrame([("d", "s", "e", None)], "domain string, source string, error string, sql_code string")
    for i in range(12):
        assert tables.append("x", i, {"errors": row})
    assert tables.read("errors").count() == 12
    assert len(list((tmp_path / "tables/data").iterdir())) < 9 and len(list((tmp_path / "tables/ledger").iterdir())) < 6


def test_siem_rows(spark, tmp_path):
    tables = tb.Tables(spark, f"file://{tmp_path}/tables", tb.SIEM_TABLES)
    schema = "ip string, source_id bigint, magnitude double, ts timestamp, offenses array<struct<id:bigint,description:string,magnitude:double,updated:bigint,source_ids:array<bigint>>>"
    for i, (ip, source, offense) in enumerate([("1.1.1.1", 1, (7, "old", 1.0, 5, [1, 2])), ("2.2.2.2", 2, (7, "new", 2.0, 9, [2])), ("3.3.3.3", 3, (7, "older", 3.0, 4, [1]))]):
        tables.append("siem", i, tb.siem_frames(spark.createDataFrame([(ip, source, 0.5, BASE, [offense])], schema)))
    assert sorted(map(tuple, tables.read("siem_sources").select("source_id", "ip").collect())) == [(1, "1.1.1.1"), (2, "2.2.2.2"), (3, "3.3.3.3")]
    assert [r.description for r in tables.read("siem_offenses").collect()] == ["new"]
    assert sorted(map(tuple, tables.read("siem_links").collect())) == [(7, 1), (7, 2)]


def test_entries_of_merged_rows(spark):
    entry = ("{}", 0, None, BASE, 1)
    rows = spark.createDataFrame([("d", entry, entry, None, None, ["1.1.1.1"], {"1.1.1.1": {"rtt": entry}, "2.2.2.2": {}}, False, 1), ("e", entry, entry, None, None, None, None, False, 1)], sm.MERGED)
    got = sorted(((r.domain, r.ip, r.collector, r.raw) for r in tb.entries(rows).collect()), key=str)
    assert got == sorted([("d", None, "zone", "{}"), ("d", None, "dns", "{}"), ("d", "1.1.1.1", "rtt", "{}"), ("e", None, "zone", "{}"), ("e", None, "dns", "{}")], key=str)
