"""Late rows, idle inputs and batches by count or age."""

import datetime as dt
import random
import time
from collections import Counter

from netsift.streaming import inputs
from netsift.streaming import merge as sm
from netsift.streaming.tables import Tables

SCHEMA = "domain string, ip string, collector string, value string, status_code int, error string, offset long, ts timestamp"
BASE = dt.datetime(2024, 1, 1)


def write(spark, path, rows):
    """Rows (domain, ip, collector, second) as one more file of a folder."""
    data = [(d, ip, c, "{}", 0, None, i, BASE + dt.timedelta(seconds=at)) for i, (d, ip, c, at) in enumerate(rows)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_those_that_spark_drops(spark, tmp_path):
    rng = random.Random(3)
    path = f"file://{tmp_path}/in"
    batches = []
    for i in range(6):
        batches.append([(f"d{rng.randrange(9)}", None, rng.choice(["zone", "dns", "tls"]), 10 * i + rng.randrange(-30, 10) + 100) for _ in range(25)])
        write(spark, path, batches[-1])
        time.sleep(0.05)
    read = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    # what Spark drops of the same batches
    direct = read().selectExpr("*", "unix_millis(ts) as at").withWatermark("ts", "1 second").groupBy("domain").transformWithState(statefulProcessor=sm.Merge(), outputStructType=sm._OUT, outputMode="append", timeMode="eventTime")
    query = direct.writeStream.format("noop").option("checkpointLocation", f"file://{tmp_path}/direct").trigger(availableNow=True).start()
    query.awaitTermination()
    dropped = {p.batchId: sum(o.numRowsDroppedByWatermark for o in p.stateOperators) for p in query.recentProgress}
    tables = Tables(spark, f"file://{tmp_path}/tables", inputs.LATE_TABLES)
    inputs.split_late(read(), f"file://{tmp_path}/out", tables, f"file://{tmp_path}/at", availableNow=True).awaitTermination()
    late = tables.read("late").collect()
    per_batch = Counter(r.batch for r in late)
    assert sum(per_batch.values()) > 20 and {b: n for b, n in dropped.items() if n} == dict(per_batch)
    # by hand: a row is late if it isn't after the newest of all batches but the one before, less a second
    wanted = Counter()
    for i, rows in enumerate(batches):
        earlier = [at for b in batches[: max(i - 1, 0)] for *_, at in b]
        wanted.update(c for _, _, c, at in rows if earlier and at <= max(earlier) - 1)
    assert {r.collector: r.n for r in inputs.late_counts(tables).collect()} == dict(wanted)
    kept = spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/out")
    assert kept.count() + len(late) == 6 * 25


def test_a_batch_is_split_once(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}/tables", inputs.LATE_TABLES)
    for at in (100, 200, 300, 50):
        write(spark, f"file://{tmp_path}/in", [("d", None, "zone", at)])
        rows = spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/in")
        inputs.split_late(rows, f"file://{tmp_path}/out", tables, f"file://{tmp_path}/at", availableNow=True).awaitTermination()
    last = max((tmp_path / "at/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    (last.parent / f".{last.name}.crc").unlink()
    last.unlink()  # as if the driver had been lost before it noted the batch
    inputs.split_late(rows, f"file://{tmp_path}/out", tables, f"file://{tmp_path}/at", availableNow=True).awaitTermination()
    assert tables.read("late").count() == 1 and spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/out").count() == 3


def test_an_idle_input_does_not_hold_results_back(spark, tmp_path):
    for name in ("own", "ips"):
        (tmp_path / name).mkdir()
    now = dt.datetime.now(dt.timezone.utc)
    rows = [("d", None, c, "{}", 0, None, i, now) for i, c in enumerate(("zone", "dns"))]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/own")
    read = lambda name: spark.readStream.schema(SCHEMA).parquet(f"file://{tmp_path}/{name}")
    merged = sm.merge_stream(read("own").drop("ip"), read("ips"), processor=sm.Merge(domain_life=2000), idle="2 seconds")
    query = merged.writeStream.format("memory").queryName("idle_results").option("checkpointLocation", f"file://{tmp_path}/at").trigger(processingTime="1 second").start()
    try:
        until = time.time() + 90
        while not (got := spark.table("idle_results").collect()) and time.time() < until:
            time.sleep(1)
    finally:
        query.stop()
    assert [(r.domain, r.is_complete) for r in got] == [("d", False)]


def test_batches_by_count_or_age(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    spark.range(23).coalesce(1).write.mode("append").parquet(path)
    rows = inputs.batched(spark.readStream.schema("id long").parquet(path), size=10, age="2 seconds", slots=1)
    query = rows.writeStream.format("memory").queryName("batches").option("checkpointLocation", f"file://{tmp_path}/at").trigger(processingTime="500 milliseconds").start()
    try:
        wait = lambda n: next((1 for _ in range(120) if spark.table("batches").count() >= n or time.sleep(0.5)), None)
        wait(3)
        spark.range(100, 109).coalesce(1).write.mode("append").parquet(path)
        wait(4)
    finally:
        query.stop()
    got = spark.table("batches").collect()
    assert [r.n for r in got] == [10, 10, 3, 9]
    ids = sorted(int(x.split(":")[1][:-1]) for r in got for x in r.rows)
    assert ids == [*range(23), *range(100, 109)]
