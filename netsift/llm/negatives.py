"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels within a window.

A row's score is the inner product of its quantised vector with the anchor's. Both searches are one threshold join: ``windows``
ask for the first k rows of scores between a floor and a ceiling, higher scores first, ties by smaller id. The join is
of the L2AP kind. Dimensions are ordered by their energy over the anchors and cut into runs; the inverted index of a piece of
rows lists for each run the rows whose norm over this and all later runs could still lift a score to a threshold, all other
dimensions are left out of it. Scores accumulate over the runs; a pair is dropped once what it has and the product of both
remaining norms stay below its threshold; what is left is scored exactly, the dimensions out of the index too. Thresholds begin
high, at the best score in a sixteenth of the rows, and are lowered for windows that aren't filled: to the sample's k-th best,
which fills them, or to the window's floor where the sample has fewer rows.

Anchors are worked on in passes that are bounded by bytes, all rows in each pass: pieces of rows against a block of anchors,
without shuffling the rows. Only rows within windows leave a task, at most k a window.

Rows with a null id, label or vector, or any null or non-finite component take no part. Vectors of unequal lengths are compared
as if the shorter one went on with zeros. Scores are exact whole numbers; those beyond 64 bits are cut off there. Rows are told
apart by id: "other rows" are rows of another id. Repeated rows each take part, as anchors too, and equal rows follow each other in
no order. Empty tables, anchors without rows of their label or of other labels give no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, keep, new_path

#: Bytes of anchors' vectors that a pass broadcasts at most, and anchors in a pass.
PASS_BYTES, PASS_ANCHORS = 32_000_000, 16_384
#: Runs of dimensions that are accumulated and pruned one after the other.
RUNS = 8
#: Scores of a piece of rows against a block of anchors at once.
CELLS = 4_000_000
SAMPLE = 16
#: Share of pairs above which pairs are still scored as whole matrices.
DENSE = 0.01
LOW, HIGH = -(1 << 63), (1 << 63) - 1
FOUND = "w long, vec_id long, score long, last boolean"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def rows_of(batch: pa.RecordBatch, scale: float, dims: int | None) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Ids, labels and quantised vectors (one row each, filled up with zeros) of the rows that take part."""
    vectors = batch.column("vector")
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy().astype(np.int64)
    flat = pc.list_flatten(vectors)
    value = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    n, size0 = len(size), np.maximum(size, 0)
    row = np.repeat(np.arange(n), size0)
    bad = np.bincount(row[~np.isfinite(value)], minlength=n) > 0
    there = (size >= 0) & ~bad & ~batch.column("label").is_null().to_numpy(zero_copy_only=False) & ~batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
    width = dims if dims is not None else int(size.max(initial=0))
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.nan_to_num(np.floor(scale * value))
    column = np.arange(len(value)) - np.repeat(np.cumsum(size0) - size0, size0)
    out = np.zeros((n, width))
    inside = column < width
    out[row[inside], column[inside]] = whole[inside]
    label = batch.column("label").filter(pa.array(there)).to_pylist()
    return batch.column("vec_id").filter(pa.array(there)).to_numpy(), label, out[there]


class Block:
    """A pass's anchors: vectors in the order of dimensions, what is left of their norms before each run, labels as numbers."""

    def __init__(self, ids: np.ndarray, labels: list[str], vectors: np.ndarray):
        self.ids = ids
        self.code = {c: i for i, c in enumerate(sorted(set(labels)))}
        self.labels = np.array([self.code[c] for c in labels], np.int64)
        self.order = np.argsort(-(vectors**2).sum(0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.cuts = np.unique(np.linspace(0, vectors.shape[1], RUNS + 1).astype(int))
        self.rest = rests(self.vectors, self.cuts)


def rests(vectors: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The norm of each vector over the dimensions from each cut on."""
    energy = np.array([(vectors[:, a:b] ** 2).sum(1) for a, b in zip(cuts, cuts[1:])]).reshape(len(cuts) - 1, len(vectors))
    return np.sqrt(np.vstack([np.cumsum(energy[::-1], 0)[::-1], np.zeros((1, len(vectors)))])).T


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products as 64-bit numbers."""
    if not len(a):
        return np.zeros(0, np.int64)
    bound = (np.abs(a).max(1) * np.abs(b).max(1)).max(initial=0) * max(a.shape[1], 1)
    if bound < 1 << 53:
        return np.rint(np.einsum("ij,ij->i", a, b)).astype(np.int64)
    ints = (sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, b))
    return np.array([min(max(s, LOW), HIGH) for s in ints], np.int64)


def pairs_over(block: Block, vectors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (anchor, row, score) of scores of at least ``least`` (one for each anchor; infinite ones ask for nothing)."""
    asked = np.flatnonzero(least < np.inf)
    if not len(asked) or not len(vectors):
        return (np.zeros(0, np.int64),) * 3
    a_rest, x_rest = block.rest[asked], rests(vectors, block.cuts)
    slack = 0.5 + 1e-9 * a_rest[:, 0].max() * x_rest[:, 0].max()  # more than rounding can take from a bound
    need = least[asked] - slack
    # the index: a row stands in the lists of runs 0 to indexed - 1, as what is left after them can't reach a threshold by itself
    reach = x_rest * a_rest.max(0) >= need.min()
    indexed = np.minimum(reach.sum(1), len(block.cuts) - 1)
    by_length = np.argsort(-indexed, kind="stable")[: np.count_nonzero(indexed)]
    listed = indexed[by_length]
    if not len(listed) or len(block.cuts) < 2:
        everything = need.min() <= 0  # vectors without dimensions, or none that reaches a threshold
        ai, xi = np.repeat(asked, len(vectors)) if everything else asked[:0], np.tile(np.arange(len(vectors)), len(asked)) if everything else asked[:0]
        fine = least[ai] <= 0
        return ai[fine], xi[fine], np.zeros(np.count_nonzero(fine), np.int64)
    small = a_rest[:, 0].max() * x_rest[:, 0].max() < 1 << 22
    A, X = (m.astype(np.float32) if small else m for m in (block.vectors[asked], vectors[by_length]))
    scores = np.zeros((len(asked), len(by_length)), A.dtype)
    ai = xi = None
    for run, (a, b) in enumerate(zip(block.cuts, block.cuts[1:])):
        n = np.count_nonzero(listed > run)
        scores[:, :n] += A[:, a:b] @ X[:n, a:b].T
        if a_rest[:, run + 1].max() * x_rest[by_length, run + 1].max(initial=0) > need.max() and run + 2 < len(block.cuts):
            continue  # nothing can be dropped yet
        alive = scores + a_rest[:, run + 1, None].astype(A.dtype) * x_rest[None, by_length, run + 1].astype(A.dtype) >= need[:, None] - slack
        # rows that left the lists have more left than this bound says
        short = listed <= run
        if short.any():
            left = np.take_along_axis(x_rest[by_length], listed[:, None], 1)[:, 0]
            a_left = a_rest[:, listed[short]]
            alive[:, short] = scores[:, short] + a_left * left[None, short] >= need[:, None] - slack
        if np.count_nonzero(alive) <= DENSE * alive.size or run + 2 == len(block.cuts):
            ai, xi = np.nonzero(alive)
            break
    ai, xi = asked[ai], by_length[xi]
    out = np.concatenate([np.zeros(0, np.int64), *(exact(block.vectors[ai[k : k + 50_000]], vectors[xi[k : k + 50_000]]) for k in range(0, len(ai), 50_000))])
    fine = out >= least[ai]
    return ai[fine], xi[fine], out[fine]


class Windows:
    """What is asked: for each window its anchor (a number within the block), whether labels must be equal, floor, ceiling, k."""

    def __init__(self, anchor: np.ndarray, same: bool, floor: np.ndarray, ceiling: np.ndarray, k: int):
        self.anchor, self.same, self.floor, self.ceiling, self.k = anchor, same, floor, ceiling, k
        self.starts = np.searchsorted(anchor, np.arange(anchor.max(initial=-1) + 2))


def first_k(w: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first k of their window, in order."""
    order = np.lexsort((ids, -scores.astype(np.float64), w)) if np.abs(scores).max(initial=0) < 1 << 53 else np.array(sorted(range(len(w)), key=lambda i: (w[i], -int(scores[i]), ids[i])), np.int64)
    w = w[order]
    rank = np.arange(len(w)) - np.searchsorted(w, w)
    return order[rank < k]


def _as_float(limit: np.ndarray) -> np.ndarray:
    """Limits as numbers that no score of at least the limit is below."""
    return np.where(limit == LOW, -np.inf, np.nextafter(limit.astype(np.float64), -np.inf))


def in_windows(rows: DataFrame, block: Block, asked: Windows, limit: np.ndarray, limit_id: np.ndarray, open_: np.ndarray, scale: float) -> DataFrame:
    """Rows (w, vec_id, score) in windows whose ``open_`` is set, not behind (limit, limit_id), as tasks find them: the first k a window and task."""
    dims, k = block.vectors.shape[1], asked.k
    per_anchor = np.full(len(block.ids), np.inf)
    np.minimum.at(per_anchor, asked.anchor[open_], _as_float(limit[open_]))
    last = limit == asked.floor

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * 3
        bar = limit.copy()
        least = per_anchor.copy()
        step = max(1, CELLS // max(len(block.ids), 1))
        for batch in batches:
            ids, labels, vectors = rows_of(batch, scale, dims)
            codes = np.array([block.code.get(c, -1) for c in labels], np.int64)
            vectors = vectors[:, block.order]
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                ai, xi, score = pairs_over(block, vectors[part], least)
                xi = xi + at
                fits = (block.labels[ai] == codes[xi]) == asked.same
                fits &= block.ids[ai] != ids[xi]
                ai, xi, score = ai[fits], xi[fits], score[fits]
                begin, end = asked.starts[ai], asked.starts[ai + 1] if len(ai) else ai
                n = end - begin
                w = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                x, s = np.repeat(ids[xi], n), np.repeat(score, n)
                fits = open_[w] & (s <= asked.ceiling[w]) & (s >= asked.floor[w]) & ((s > bar[w]) | (s == bar[w]) & (x <= limit_id[w]) | (bar[w] != limit[w]) & (s == bar[w]))
                if not fits.any():
                    continue
                best = [np.concatenate(p) for p in zip(best, (w[fits], x[fits], s[fits]))]
                if len(best[0]) > 4 * CELLS // 10 or at + step >= len(ids):
                    first = first_k(*best, k)
                    best = [c[first] for c in best]
                    full = np.flatnonzero(np.bincount(best[0], minlength=len(bar)) == k)
                    if len(full):  # a task's own k-th best is a threshold too
                        bar[full] = np.maximum(bar[full], best[2][np.searchsorted(best[0], full, "right") - 1])
                        least = np.full(len(block.ids), np.inf)
                        np.minimum.at(least, asked.anchor[open_], _as_float(bar[open_]))
        first = first_k(*best, k)
        columns = [c[first] for c in best]
        yield pa.record_batch([pa.array(c) for c in (*columns, last[columns[0]])], ["w", "vec_id", "score", "last"])

    return rows.mapInArrow(search, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each window over all tasks, with rank, and n, the rows the window has."""
    own = Window.partitionBy("w").orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return first.withColumn("n", F.count("*").over(Window.partitionBy("w")))


def fill(rows: DataFrame, block: Block, asked: Windows, scale: float) -> Iterator[DataFrame]:
    """Tables (w, vec_id, score, rank) that together have the first k rows of each window; a window is in one table at most.

    What comes to the driver is bounded by the pass: k rows a window of the sample, and the numbers of windows that were filled.
    """
    k, n = asked.k, len(asked.anchor)
    if not n:
        return
    limits, ids = np.full((3, n), LOW), np.full((3, n), HIGH)
    open_ = np.ones(n, bool)
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(SAMPLE)) == 0)
    best = ranked(in_windows(sample, block, asked, asked.floor, ids[2], open_, scale), k).select("w", "vec_id", "score", "rank").toArrow()
    w, x, s, rank = (best.column(c).to_numpy() for c in ("w", "vec_id", "score", "rank"))
    for level, wanted in ((0, rank == 1), (1, rank == k)):
        limits[level, w[wanted]], ids[level, w[wanted]] = s[wanted], x[wanted]
    limits = np.maximum(limits, asked.floor)
    ids[limits == asked.floor] = HIGH
    for limit, limit_id in zip(limits, ids):
        found = keep(ranked(in_windows(rows, block, asked, limit, limit_id, open_, scale), k), "windows")
        done = found.where((F.col("n") == k) | F.col("last"))
        yield done.select("w", "vec_id", "score", "rank")
        open_ = open_ & (limit != asked.floor)
        open_[done.select("w").distinct().toArrow().column("w").to_numpy()] = False
        forget(found)
        if not open_.any():
            return


def _passes(anchors: DataFrame, most: int) -> Iterator[DataFrame]:
    """The anchors in tables of at most ``most`` rows, by their place within partitions."""
    per = anchors.groupBy((F.col("i").bitwiseAND(~((1 << 33) - 1))).alias("p")).agg(F.min("i").alias("first"), F.max("i").alias("last")).orderBy("p").collect()
    held, n = [], 0
    for r in per:
        at = r.first
        while at <= r.last:
            took = min(most - n, r.last - at + 1)
            held.append((at, at + took))
            at, n = at + took, n + took
            if n == most:
                yield _between(anchors, held)
                held, n = [], 0
    if held:
        yield _between(anchors, held)


def _between(anchors: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    where = F.lit(False)
    for a, b in ranges:
        where = where | ((F.col("i") >= a) & (F.col("i") < b))
    return anchors.where(where)


def _bounds(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent of scores as whole numbers, rounded up or down."""
    if np.abs(score).max(initial=0) < 1 << 55:
        return -(-percent * score // 100) if up else percent * score // 100
    return np.array([-(-percent * int(s) // 100) if up else percent * int(s) // 100 for s in score], np.int64)


def mine(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors (vec_id, label, vector).

    anchors says which rows are anchors. Their positives are the first n_positives other rows of the same label; each gets the
    first n_negatives rows of other labels whose score is low to high percent of its own. Components are floor(scale * x).
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "vector")
    dims = int(rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0])
    dims = max(dims, 0)
    asking = keep(rows.where(anchors).withColumn("i", F.monotonically_increasing_id()), "anchors")
    out = new_path(spark, "negatives")
    spark.createDataFrame([], MINED).write.parquet(out)
    for part in _passes(asking, max(1, min(PASS_ANCHORS, PASS_BYTES // (8 * max(dims, 1))))):
        taken = [rows_of(b, scale, dims) for b in part.select("vec_id", "label", "vector").toArrow().to_batches()]
        ids = np.concatenate([np.zeros(0, np.int64), *(t[0] for t in taken)])
        block = Block(ids, [c for t in taken for c in t[1]], np.vstack([np.zeros((0, dims)), *(t[2] for t in taken)]))
        m = len(ids)
        every = Windows(np.arange(m), True, np.full(m, LOW), np.full(m, HIGH), n_positives)
        found = [t.toArrow() for t in fill(rows, block, every, scale)]
        w, positive, score, rank = (np.concatenate([np.zeros(0, np.int64), *(t.column(c).to_numpy() for t in found)]) for c in ("w", "vec_id", "score", "rank"))
        floor, ceiling = _bounds(score, low, True), _bounds(score, high, False)
        order = np.lexsort((rank, w))
        order = order[floor[order] <= ceiling[order]]
        w, positive, score = w[order], positive[order], score[order]
        asked = Windows(w, False, floor[order], ceiling[order], n_negatives)
        names = spark.createDataFrame(pa.table({"w": np.arange(len(w)), "anchor_id": ids[w], "positive_id": positive, "positive_score": score}))
        for t in fill(rows, block, asked, scale):
            mined = t.join(names, "w").select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            mined.write.mode("append").parquet(out)
    forget(asking)
    return spark.read.schema(MINED).parquet(out)
