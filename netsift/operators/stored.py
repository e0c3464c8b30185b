"""Stored tables: dimensions, collection results, newest-wins columns and error rows, as DataFrames to merge or append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOPIC_COLLECTORS = {"processed_zone": "zone", "processed_DNS": "dns", "processed_RDAP_DN": "rdap-dn", "processed_TLS": "tls", "collected_IP_data": None, "processed_QRadar": "qradar"}


def merged_json(merged: DataFrame) -> DataFrame:
    """key and JSON value of merged rows with zone and dns, as parse_merged() reads it: bodies of results are objects in it, of
    zone's only its ``zone``. Other results may be missing, as are ipResults where DNS has no address. What is no JSON is left
    out. Bodies are passed on as variants, whatever they hold.
    """
    body = lambda entry: F.try_parse_json(entry["value"])
    zone = F.try_variant_get(body(F.col("zone")), "$.zone", "variant")
    own = [body(F.col(c)).alias(name) for c, name in (("dns", "dnsResult"), ("tls", "tlsResult"), ("rdap", "rdapDomainResult"))]
    ips = F.transform_values("ips", lambda _, m: F.transform_values(m, lambda _, e: body(e)))
    value = F.to_json(F.struct(zone.alias("zone"), *own, ips.alias("ipResults")))
    return merged.where("zone is not null and dns is not null").select(F.col("domain").alias("key"), value.alias("value"))


def write_stream(rows: DataFrame, path: str, checkpoint: str, every: str = "5 seconds", **kafka: str):
    """Start writing a stream, at least once: to Parquet under path, or to Kafka if options are given."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every)
    return writer.format("kafka").options(**kafka).start() if kafka else writer.format("parquet").option("path", path).start()


def new_domains(merged: DataFrame, stored: DataFrame) -> DataFrame:
    """domain, last_update of domains that aren't stored yet. A stored row is left as it is, so its last_update never moves."""
    rows = merged.groupBy("domain").agg(F.min("last_update").alias("last_update"))
    return rows.withColumn("last_update", F.coalesce("last_update", F.current_timestamp())).join(stored.select("domain"), "domain", "left_anti")


def new_ips(merged: DataFrame, stored: DataFrame) -> DataFrame:
    """domain, ip pairs of merged rows (ips: map) that aren't stored yet."""
    return merged.select("domain", F.explode(F.map_keys("ips")).alias("ip")).dropDuplicates().join(stored.select("domain", "ip"), ["domain", "ip"], "left_anti")


def collection_results(results: DataFrame) -> DataFrame:
    """One row for each (domain, ip or null, collector, ts) with the status, error and raw value of the latest offset."""
    rows = results.groupBy("domain", "ip", "collector", "ts").agg(F.max_by(F.struct("status_code", "error", "raw"), "offset").alias("r"))
    return rows.select("domain", "ip", "collector", "ts", "r.*")


def upsert(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """stored with the rows of fresh put in or over; fresh has one row a key."""
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    kept = stored.alias("s").join(fresh.alias("f"), on, "left_anti")
    return kept.unionByName(fresh)


def newest_wins(stored: DataFrame, updates: DataFrame, keys: list[str], columns: list[str], ts: str) -> DataFrame:
    """stored with columns and ts from the good update (status_code 0) of latest time, where it isn't older than what is stored."""
    best = updates.where("status_code = 0").groupBy(*keys).agg(F.max_by(F.struct(ts, *columns), ts).alias("_u"))
    rows = stored.join(best, keys, "left")
    fresh = F.col("_u").isNotNull() & (F.col(ts).isNull() | (F.col(ts) <= F.col(f"_u.{ts}")))
    return rows.withColumns({c: F.when(fresh, F.col(f"_u.{c}")).otherwise(F.col(c)) for c in [*columns, ts]}).drop("_u")


def json_storable(raw: Column) -> Column:
    """Whether text is JSON and holds no U+0000 in a string, written raw or escaped, at any depth."""
    escaped = raw.rlike(r"(?<!\\)(?:\\\\)*\\u0000")
    return F.coalesce(F.try_parse_json(raw).isNotNull(), F.lit(False)) & ~escaped & ~F.contains(raw, F.lit("\u0000"))


def checked_raw(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """results with raw nulled where it can't be stored, and error rows for those."""
    fine = F.col("raw").isNull() | json_storable(F.col("raw"))
    rows = results.withColumn("_ok", fine)
    return rows.withColumn("raw", F.when(F.col("_ok"), F.col("raw"))).drop("_ok"), domain_errors(rows.where("not _ok"), F.lit("Invalid JSON"))


def domain_errors(rows: DataFrame, error: Column, sql_code: Column | None = None) -> DataFrame:
    return rows.select("domain", F.col("collector").alias("source"), error.alias("error"), (sql_code if sql_code is not None else F.lit(None).cast("string")).alias("sql_code"))


def siem_tables(rows: DataFrame, stored_sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources, offenses and their links from rows (ip, source_id, magnitude, ts, offenses array<struct<id, description,
    magnitude, updated, source_ids>>). Linked sources that nothing describes are put in with default values once."""
    sources = rows.groupBy("source_id").agg(F.max_by(F.struct("ip", "magnitude"), "ts").alias("s")).select("source_id", "s.*")
    each = rows.select(F.explode("offenses").alias("o")).select("o.*")
    offenses = each.groupBy("id").agg(F.max_by(F.struct("description", "magnitude", "updated"), "updated").alias("o")).select("id", "o.*")
    links = each.select(F.col("id").alias("offense_id"), F.explode("source_ids").alias("source_id")).dropDuplicates()
    missing = links.select("source_id").distinct().join(sources.select("source_id").unionByName(stored_sources.select("source_id")).distinct(), "source_id", "left_anti")
    return sources.unionByName(missing.select("source_id", F.lit(None).cast("string").alias("ip"), F.lit(-1.0).alias("magnitude"))), offenses, links


def siem_results(rows: DataFrame) -> DataFrame:
    """SIEM rows as results of a collector, for collection_results."""
    return rows.select("domain", "ip", F.lit("qradar").alias("collector"), "ts", "status_code", "error", "raw", "offset")


def doc_key(results: DataFrame) -> DataFrame:
    """results (topic, domain, ip, value, ts) with key {domainName, ip, collector, timestamp}; a missing collector stops the job."""
    topics = F.create_map(*[F.lit(x) for k, v in TOPIC_COLLECTORS.items() if v for x in (k, v)])
    collector = F.coalesce(F.get_json_object("value", "$.collector"), topics[F.col("topic")])
    when = F.coalesce(F.get_json_object("value", "$.lastAttempt").cast("bigint"), F.unix_millis("ts"))
    sure = F.when(F.assert_true(collector.isNotNull(), F.lit("no collector")).isNull(), collector)
    return results.withColumn("key", F.struct(F.col("domain").alias("domainName"), "ip", sure.alias("collector"), when.alias("timestamp")))


def result_row(results: DataFrame, collectors: tuple[str, ...] | None = None) -> DataFrame:
    """Keyed results flattened to (domain, ip, collector, timestamp) and (status_code, error, raw)."""
    rows = doc_key(results).select("key.domainName", "key.ip", "key.collector", "key.timestamp", F.coalesce(F.get_json_object("value", "$.statusCode").cast("int"), F.lit(-1)).alias("status_code"), F.get_json_object("value", "$.error").alias("error"), F.col("value").alias("raw"))
    return rows if collectors is None else rows.where(F.col("collector").isin(*collectors))


def with_domain_and_start(merged: DataFrame) -> DataFrame:
    """key and value (JSON) of merged records with domainName and processingStart; a record without a DNS time stops the job."""
    start = F.get_json_object("value", "$.dnsResult.lastAttempt").cast("bigint")
    sure = F.when(F.assert_true(start.isNotNull(), F.lit("no dnsResult.lastAttempt")).isNull(), start)
    return merged.withColumns({"domainName": F.col("key"), "processingStart": sure})


def ip_key(key: Column) -> Column:
    """The key {dn, ip} as struct(domain_name, ip)."""
    got = F.from_json(key.cast("string"), "dn string, ip string")
    return F.struct(got["dn"].alias("domain_name"), got["ip"].alias("ip"))


def vector_json(vectors: DataFrame) -> DataFrame:
    """domain_name and the feature row as JSON."""
    return vectors.select("domain_name", F.to_json(F.struct("*")).alias("value"))
