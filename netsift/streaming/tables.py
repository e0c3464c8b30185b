"""Stored tables that a stream writes exactly once: deltas of batches, a ledger of batch ids, and one switch.

Parquet has no MERGE, and a snapshot of everything for each batch would cost more with every batch. So a batch writes only its own
rows, to a folder that nobody reads yet; then one row goes to the ledger: the batch ids that are done, and the folders that
count. The ledger's row is one file, which Spark's committer moves into place: before that the batch hasn't happened, after it
the batch is done. A batch that is run again after a failure overwrites what it had staged, or sees in the ledger that it is
done. Readers take the folders of the newest row and reduce them by key. ``compact`` reduces them for good.

One stream at a time writes to a folder of tables; several may take turns, each by a name of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators import stored as st
from netsift.sources.folders import exists, remove

LEDGER = "version long, batches map<string,bigint>, parts array<struct<name:string,path:string>>, old array<string>"
GEO = "continentCode string, countryCode string, region string, regionCode string, city string, postalCode string, latitude double, longitude double, timezone string, registeredCountryGeoNameId bigint, representedCountryGeoNameId bigint, asn bigint, asnOrg string, networkAddress string, prefixLength bigint"


class Table(NamedTuple):
    """A table's columns, its keys, and what the row that counts for a key is the largest of (the batch last); ``first`` keeps
    the row of the earliest batch instead. A table without keys keeps all rows."""

    schema: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    first: bool = False


#: What collectors' results are stored as.
RESULT_TABLES = {
    "domains": Table("domain string, last_update timestamp", ("domain",), first=True),
    "ips": Table("domain string, ip string", ("domain", "ip"), first=True),
    "collection_results": Table("domain string, ip string, collector string, ts timestamp, status_code int, error string, raw string", ("domain", "ip", "collector", "ts")),
    "geo": Table(f"domain string, ip string, ts timestamp, {GEO}", ("domain", "ip"), ("ts",)),
    "reputation": Table("domain string, ip string, ts timestamp, reputation double", ("domain", "ip"), ("ts",)),
    "errors": Table("domain string, source string, error string, sql_code string"),
}
SIEM_TABLES = {
    "siem_sources": Table("source_id bigint, ip string, magnitude double, described boolean", ("source_id",), ("described",)),
    "siem_offenses": Table("id bigint, description string, magnitude double, updated bigint", ("id",), ("updated",)),
    "siem_links": Table("offense_id bigint, source_id bigint", ("offense_id", "source_id"), first=True),
}


class Tables:
    """Tables under a path. compact_after: batches whose deltas are reduced together."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table], compact_after: int = 50, kept: int = 5):
        self.spark, self.path, self.tables, self.compact_after, self.kept = spark, path.rstrip("/"), tables, compact_after, kept

    def _newest(self):
        if not exists(self.spark, f"{self.path}/ledger"):
            return None
        rows = self.spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(f"{self.path}/ledger")
        return rows.orderBy(F.desc("version")).first()

    def _switch(self, version: int, batches: dict[str, int], parts: list[tuple[str, str]], old: list[str]) -> None:
        row = self.spark.createDataFrame([(version, batches, parts, old)], LEDGER)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/{version:012d}")

    def done(self, stream: str) -> int:
        """The last batch of a stream that is in the tables; -1 if none is."""
        newest = self._newest()
        return newest.batches.get(stream, -1) if newest else -1

    def append(self, stream: str, batch_id: int, frames: dict[str, DataFrame]) -> bool:
        """Add a batch's rows to tables, once: False if the ledger has the batch already."""
        newest = self._newest()
        batches, parts, old = (newest.batches, [tuple(p) for p in newest.parts], list(newest.old)) if newest else ({}, [], [])
        if batches.get(stream, -1) >= batch_id:
            return False
        version = (newest.version if newest else 0) + 1
        for name, df in frames.items():
            at = f"{self.path}/data/{version:012d}-{stream}-{batch_id}/{name}"
            columns = [F.col(f.name).cast(f.dataType) for f in self._schema(name)]
            df.select(*columns, F.lit(version).cast("long").alias("version")).write.mode("overwrite").parquet(at)
            parts.append((name, at))
        self._switch(version, {**batches, stream: batch_id}, parts, old)
        remove(self.spark, f"{self.path}/ledger/{version - self.kept:012d}")
        if len({p.rsplit("/", 1)[0] for _, p in parts}) > self.compact_after:
            self.compact()
        return True

    def _schema(self, name: str):
        return self.spark.createDataFrame([], self.tables[name].schema).schema.fields

    def _rows(self, name: str, parts) -> DataFrame:
        """The rows that count, with the version that brought them."""
        table = self.tables[name]
        paths = [p for n, p in parts if n == name]
        schema = f"{table.schema}, version long"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if not table.keys:
            return rows
        others = [c for c in rows.columns if c not in table.keys]
        order = F.struct(*table.order, "version")
        best = (F.min_by if table.first else F.max_by)(F.struct(*others), order)
        return rows.groupBy(*table.keys).agg(best.alias("_r")).select(*[F.col(c) if c in table.keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])

    def read(self, name: str) -> DataFrame:
        """A table as of the last batch that is done."""
        newest = self._newest()
        return self._rows(name, newest.parts if newest else []).drop("version")

    def compact(self) -> None:
        """Replace all deltas by the rows that count. What they replaced is deleted at the next time, so that readers can end."""
        newest = self._newest()
        if newest is None:
            return
        version = newest.version + 1
        parts = []
        for name in self.tables:
            at = f"{self.path}/data/{version:012d}-all/{name}"
            self._rows(name, newest.parts).write.mode("overwrite").parquet(at)
            parts.append((name, at))
        self._switch(version, newest.batches, parts, sorted({p.rsplit("/", 1)[0] for _, p in newest.parts}))
        for folder in newest.old:
            remove(self.spark, folder)


def entries(merged: DataFrame) -> DataFrame:
    """The results (domain, ip, collector, raw, status_code, error, ts, offset) that merged rows hold."""
    one = lambda ip, collector, e: F.struct(ip.alias("ip"), collector.alias("collector"), e["value"].alias("raw"), e["status_code"].alias("status_code"), e["error"].alias("error"), e["ts"].cast("timestamp").alias("ts"), e["offset"].alias("offset"))
    own = F.array(*[F.when(F.col(c).isNotNull(), one(F.lit(None).cast("string"), F.lit(name), F.col(c))) for name, c in (("zone", "zone"), ("dns", "dns"), ("rdap-dn", "rdap"), ("tls", "tls"))])
    per_ip = F.flatten(F.transform(F.map_entries("ips"), lambda x: F.transform(F.map_entries(x["value"]), lambda y: one(x["key"], y["key"], y["value"]))))
    return merged.select("domain", F.explode(F.filter(F.concat(own, F.coalesce(per_ip, F.filter(own, lambda _: F.lit(False)))), lambda x: x.isNotNull())).alias("r")).select("domain", "r.*")


def result_frames(results: DataFrame) -> dict[str, DataFrame]:
    """Rows for RESULT_TABLES of results (as entries() gives them). A raw value that can't be stored is left out and is an error."""
    good, errors = st.checked_raw(results)
    fine = good.where("status_code = 0 and ip is not null")
    body = lambda kind: F.from_json(F.get_json_object("raw", "$.data"), kind)
    of = lambda collector, kind: fine.where(F.col("collector") == collector).groupBy("domain", "ip").agg(F.max_by(F.struct("ts", "raw"), F.struct("ts", "offset")).alias("r")).select("domain", "ip", "r.*").select("domain", "ip", "ts", body(kind).alias("d")).select("domain", "ip", "ts", "d.*")
    return {
        "domains": results.groupBy("domain").agg(F.min("ts").alias("last_update")),
        "ips": results.where("ip is not null").select("domain", "ip").distinct(),
        "collection_results": st.collection_results(good),
        "geo": of("geo-asn", GEO),
        "reputation": of("nerd", "reputation double"),
        "errors": errors,
    }


def siem_frames(rows: DataFrame) -> dict[str, DataFrame]:
    """Rows for SIEM_TABLES of rows as siem_tables() takes them. Sources that are only linked to never replace a described one."""
    none = rows.sparkSession.createDataFrame([], "source_id bigint")
    sources, offenses, links = st.siem_tables(rows, none)
    return {"siem_sources": sources.withColumn("described", F.col("ip").isNotNull()), "siem_offenses": offenses, "siem_links": links}


def store_stream(rows: DataFrame, tables: Tables, frames: Callable[[DataFrame], dict[str, DataFrame]], checkpoint: str, stream: str = "results", **trigger):
    """Start a stream that stores what ``frames`` makes of each batch, exactly once over failures and restarts."""

    def store(batch: DataFrame, batch_id: int) -> None:
        if tables.done(stream) >= batch_id:
            return
        held = batch.persist()
        try:
            tables.append(stream, batch_id, frames(held))
        finally:
            held.unpersist()

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
