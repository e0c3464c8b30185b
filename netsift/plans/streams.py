"""Registered stream queries: files of events as collector results, run until all that is there has been read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.sources.folders import new_folder
from netsift.streaming import merge as sm
from netsift.streaming import tables as tb

from .features import read
from .merging import _EV, BODY, IP_BODY, IP_KIND, KIND

QUERIES, ORACLE_SQL = {}, {}


def event_stream(spark, sf_dir, name: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("name", F.lit(name))


def stream_results(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The events of the batch merge as two streams of results."""
    common = ("concat('d', user_id) as domain", "if(value < 80, 0, 10) as status_code", "if(value < 80, null, 'failed') as error", "event_id as offset", "cast(ts as timestamp) as ts")
    own = event_stream(spark, sf_dir, "domain").selectExpr(*common, f"{KIND} as collector", f"{BODY} as value").where("collector is not null")
    per_ip = event_stream(spark, sf_dir, "ip").selectExpr(*common, "concat('10.0.0.', pmod(k, 4)) as ip", f"{IP_KIND} as collector", f"{IP_BODY} as value").where("collector <> 'other'")
    return own, per_ip


def T0_T1_T2_stream_merge(spark, sf_dir):
    """The last merged result of each domain, with lifetimes of hours instead of seconds to fit the events."""
    for k, v in sm.ROCKSDB.items():
        spark.conf.set(k, v)
    hour = 3600 * sm.SECOND
    processor = sm.Merge(grace=hour, domain_life=100 * hour, ip_life=100 * hour, after_domain=50 * hour)
    out, at = new_folder(spark, "merged"), new_folder(spark, "merge-checkpoint")
    rows = sm.merge_stream(*stream_results(spark, sf_dir), processor=processor)
    rows.writeStream.outputMode("append").option("checkpointLocation", at).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    done = spark.read.schema(sm.MERGED).parquet(out)
    return done.groupBy("domain").agg(F.max_by("is_complete", "emitted_at").alias("is_complete"), F.count("*").alias("n_results"), F.max("emitted_at").alias("last_at"))


QUERIES["T0_T1_T2_stream_merge"] = T0_T1_T2_stream_merge


def O2_O5_O6_stored_by_stream(spark, sf_dir):
    """Results of both streams as stored tables: those of each domain, address, collector and time, and each address's newest place."""
    own, per_ip = stream_results(spark, sf_dir)
    rows = own.withColumn("ip", F.lit(None).cast("string")).unionByName(per_ip).withColumnRenamed("value", "raw")
    tables = tb.Tables(spark, new_folder(spark, "tables"), tb.RESULT_TABLES)
    tb.store_stream(rows, tables, tb.result_frames, new_folder(spark, "tables-checkpoint"), availableNow=True).awaitTermination()
    results = tables.read("collection_results").select(F.lit("results").alias("stored"), "domain", "ip", "collector", F.unix_micros("ts").alias("ts_us"), "status_code", "error", "raw")
    geo = tables.read("geo").select(F.lit("geo").alias("stored"), "domain", "ip", F.unix_micros("ts").alias("ts_us"), F.col("asn").cast("string").alias("raw"))
    return results.unionByName(geo, allowMissingColumns=True)


QUERIES["O2_O5_O6_stored_by_stream"] = O2_O5_O6_stored_by_stream
ORACLE_SQL["O2_O5_O6_stored_by_stream"] = f"""WITH {_EV}, r AS (SELECT domain, NULL AS ip, collector, ts, off, status_code, body FROM dom UNION ALL SELECT domain, ip, collector, ts, off, status_code, body FROM ipr),
    b AS (SELECT domain, ip, collector, ts, max_by(status_code, off) AS status_code, max_by(body, off) AS raw FROM r GROUP BY ALL),
    g AS (SELECT domain, ip, max(ts) AS ts, max_by(body, (ts, off)) AS raw FROM r WHERE collector = 'geo-asn' AND status_code = 0 GROUP BY ALL)
    SELECT 'results' AS stored, domain, ip, collector, epoch_us(ts) AS ts_us, status_code, CASE WHEN status_code <> 0 THEN 'failed' END AS error, raw FROM b
    UNION ALL SELECT 'geo', domain, ip, NULL, epoch_us(ts), NULL, NULL, CAST(raw AS JSON)->'data'->>'asn' FROM g"""
