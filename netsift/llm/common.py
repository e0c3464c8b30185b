"""What the operators of this subpackage share: tables kept between jobs, and batches of text as numpy arrays."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that one numpy step holds at most, but for a single longer text.
SLICE_BYTES = 3_000_000

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset: one in the warehouse, which all executors share, or, with
    a local master, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        if not _own_folder:
            _own_folder.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        named = _own_folder[0]
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/netsift/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete all tables that keep() wrote in this application; call it when results that read them are written or collected."""
    remove(spark, f"{shared_folder(spark)}/netsift/{spark.sparkContext.applicationId}")


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def keep(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends here and lost executors lose nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def forget(df: DataFrame | None) -> None:
    """Delete a table that keep() wrote, when nothing reads it any more."""
    path = getattr(df, "_kept_at", None)
    if path:
        remove(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that no table refers to any more; otherwise they stay until the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def smallest(df: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` rows of df: those whose key has the smallest hash (ties by key), the same ones at every run.

    A first cut by the hash leaves little more than that, so that tasks send few rows however many tasks there are.
    """
    n = df.count()
    part = min(1.0, (most + 6 * most**0.5 + 20) / max(n, 1))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    return df.where(place < F.lit(int(part * (1 << 40)))).orderBy(place, key).limit(most)


def _mean(table: pa.Table) -> pa.Table:
    weight = table.column("weight").to_numpy()
    total = sum(w * np.frombuffer(p.as_buffer(), np.float32).astype(np.float64) for w, p in zip(weight, table.column("params")))
    return pa.table({"weight": pa.array([int(weight.sum())]), "params": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())})


def average(params: DataFrame, fan_in: int) -> np.ndarray | None:
    """The mean of rows (weight long, params: 32-bit floats), fan_in at a time until one is left; None without rows."""
    rows = keep(params.withColumn("i", F.spark_partition_id()), "params")
    while (n := rows.count()) > 1:
        grouped = rows.withColumn("g", F.col("i") % F.lit(-(-n // fan_in))).groupBy("g")
        after = keep(grouped.applyInArrow(_mean, "weight long, params binary").withColumn("i", F.spark_partition_id()), "params")
        forget(rows)
        rows = after
    last = rows.select("params").first()
    forget(rows)
    return np.frombuffer(bytes(last.params), np.float32) if last else None


def free_name(columns: list[str], name: str) -> str:
    """name with underscores before it until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column over all rows."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def buckets_for(items: float, per_bucket: float, least: int = 96) -> int:
    """Buckets so that each holds about per_bucket items: their number grows with the input, their size doesn't."""
    return int(max(least, -(-items // per_bucket)))


def held_out(doc_id, folds: int, fold: int):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece has about as many bytes of the column, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if sizes.sum() <= most:
            if len(sizes):
                yield batch
            continue
        piece = (np.cumsum(sizes) - 1) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a piece of texts: ``ids`` into ``vocab`` (an Arrow string array), ``starts`` of each text in ids."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        flat, offsets = lists.values, lists.offsets.to_numpy()
        full = pc.greater(pc.binary_length(flat), 0)
        coded = flat.dictionary_encode()
        full = full.to_numpy(zero_copy_only=False)
        self.starts = np.concatenate([[0], np.cumsum(full)])[offsets]
        self.ids = coded.indices.to_numpy()[full]
        self.vocab = coded.dictionary

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def rows(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash for each entry of vocab."""
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w, seed) for w in self.vocab.to_pylist()), np.uint64, len(self.vocab))


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text with fewer words than width has its whole sequence as one shingle; one without words has none.
    """
    h = words.hashes()[words.ids] if len(words.ids) else np.zeros(0, np.uint64)
    counts, starts = words.counts, words.starts
    per_text = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    rows = np.repeat(np.arange(len(counts)), per_text)
    first = starts[:-1][rows] + (np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text))
    value = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    length = np.minimum(counts[rows], width)
    odd = np.uint64(0x2545F4914F6CDD1D)
    for j in range(width):
        inside = j < length
        at = np.where(inside, first + j, 0)
        step = mix((value ^ h[at]) * odd) if len(h) else value
        value = np.where(inside, step, value)
    ends = np.cumsum(per_text).tolist()
    for a, b in zip([0, *ends], ends):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.searchsorted(rows, np.arange(len(counts) + 1))


def by_bucket(bucket: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket and where each bucket begins in it."""
    order = np.argsort(bucket.astype(np.uint16 if n_buckets <= 65536 else np.uint32), kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))
