"""What surrounds the stateful merge: late rows as a table, heartbeats for idle inputs, and batches by count or age."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from netsift.sources.folders import exists

from .tables import Table, Tables

#: Tables that split_late() keeps: late rows, and the newest event time of each batch.
LATE_TABLES = {
    "late": Table("domain string, ip string, collector string, offset bigint, ts timestamp, batch bigint"),
    "seen": Table("batch bigint, newest timestamp", ("batch",), first=True),
}
HEARTBEAT = "heartbeat"


def split_late(results: DataFrame, out: str, tables: Tables, checkpoint: str, out_of_order: str = "1 second", **trigger):
    """Start a stream that parts results (domain, ip, collector, offset, ts, others) in those that a stateful operator would still
    take, written to folders of ``out`` by batch, and late ones, which go to the table ``late`` of ``tables`` with their batch.

    A row is late if it isn't after the watermark that Spark holds against the rows of a batch: the newest event time of all
    batches but the one before, less out_of_order. So the stateful query that reads ``out`` drops nothing more, and what is late can
    be counted. A batch that is run again neither writes nor counts twice.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = tables.read("seen").where(F.col("batch") <= batch_id - 2).agg(F.max("newest").alias("newest"))
        behind = seen.select((F.col("newest") - F.expr(f"interval {out_of_order}")).alias("w")).first().w
        held = batch.persist()
        late = F.lit(False) if behind is None else F.col("ts") <= F.lit(behind)
        folder = f"{out}/batch={batch_id:012d}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            held.where(~late).write.mode("overwrite").parquet(folder)
        columns = ["domain", "ip" if "ip" in held.columns else "cast(null as string) as ip", "collector", "offset", "ts"]
        rows = held.where(late).selectExpr(*columns, f"{batch_id}L as batch")
        newest = held.agg(F.max("ts").alias("newest")).select(F.lit(batch_id).alias("batch"), "newest").where("newest is not null")
        tables.append("split", batch_id, {"late": rows, "seen": newest})
        held.unpersist()

    return results.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def late_counts(tables: Tables) -> DataFrame:
    """Late rows by collector."""
    return tables.read("late").groupBy("collector").agg(F.count("*").alias("n"))


def with_heartbeat(results: DataFrame, idle: str, every: int = 1) -> DataFrame:
    """A stream of results with a row each ``every`` seconds whose time is ``idle`` ago.

    An input whose results come in time is ahead of these rows. One that is silent follows the clock by them, so that its watermark
    doesn't hold other inputs' results back. Their collector is HEARTBEAT, which the merge ignores; their domain is the number of
    the row modulo 64, so that no task gets all of them.
    """
    source = results.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load().where(F.col("value") % every == 0)
    own = {"domain": F.concat(F.lit("\u0000"), (F.col("value") % 64).cast("string")), "collector": F.lit(HEARTBEAT), "ts": F.col("timestamp") - F.expr(f"interval {idle}"), "offset": F.col("value"), "status_code": F.lit(-1), "ip": F.lit(None)}
    beats = source.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in results.schema])
    return results.unionByName(beats)


class Batches(StatefulProcessor):
    """Rows of a key as batches: a full one at once, a smaller one when its first row is ``age`` milliseconds old."""

    OUT = "slot int, n int, rows array<string>"

    def __init__(self, size: int = 100, age: int = 5000):
        self.size, self.age = size, age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "body string")
        self.open = handle.getValueState("open", "n int, due long")

    def _batch(self, slot: int, rows: list[str]) -> Row:
        return Row(slot=slot, n=len(rows), rows=rows)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, due = self.open.get() if self.open.exists() else (0, None)
        held: list[str] = []
        for r in rows:
            held.append(r.body)
            if n + len(held) == self.size:
                yield self._batch(key[0], [*(b[0] for b in self.rows.get()), *held] if n else held)
                if n:
                    self.rows.clear()
                if due is not None:
                    self.handle.deleteTimer(due)
                n, due, held = 0, None, []
        if held:
            self.rows.appendList([(b,) for b in held])
            if due is None:
                due = timerValues.getCurrentProcessingTimeInMs() + self.age
                self.handle.registerTimer(due)
        if n + len(held):
            self.open.update((n + len(held), due))
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists() and self.open.get()[1] == expiredTimerInfo.getExpiryTimeInMs():
            rows = [b[0] for b in self.rows.get()]
            self.rows.clear()
            self.open.clear()
            yield self._batch(key[0], rows)

    def close(self) -> None:
        pass


def batched(rows: DataFrame, size: int = 100, age: str = "5 seconds", slots: int = 64) -> DataFrame:
    """A stream of rows as batches (slot, n, rows: JSON texts) of ``size`` rows, or of what is there ``age`` after a batch's first
    row. Rows are dealt to ``slots`` by their hash; each slot fills batches of its own."""
    milliseconds = rows.sparkSession.sql(f"select unix_millis(timestamp_millis(0) + interval {age})").first()[0]
    body = rows.select(F.to_json(F.struct(*rows.columns)).alias("body"))
    keyed = body.withColumn("slot", F.pmod(F.xxhash64("body"), F.lit(slots)).cast("int"))
    return keyed.groupBy("slot").transformWithState(statefulProcessor=Batches(size, milliseconds), outputStructType=Batches.OUT, outputMode="append", timeMode="processingTime")
