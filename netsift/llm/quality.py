"""Rule statistics of documents and an isolation forest over them, its threshold calibrated on labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, keep, mix, slices, smallest

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_distinct long"
SYMBOLS = b"#*$%&|<>"
#: Trees and rows of each tree; the forest learns from TREES * TREE_ROWS documents at most, those of smallest hash.
TREES, TREE_ROWS = 100, 256
#: Of the labelled good documents the forest may reject at most MOST_GOOD_LOST; a share of them that it rejects must be
#: worth LOSS times as large a share of the labelled bad ones. Without labelled bad documents it may reject GOOD_ALONE.
MOST_GOOD_LOST, LOSS, GOOD_ALONE = 0.01, 5.0, 0.005
BINS = 2000


def _of_bytes(texts: pa.Array, wanted: bytes) -> np.ndarray:
    """How many bytes of each text are among wanted (ASCII)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
    hit = np.zeros(256, bool)
    hit[list(wanted)] = True
    return np.diff(np.concatenate([[0], np.cumsum(hit[data])])[starts - starts[0]])


def _per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[starts])


def _distinct(rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Distinct codes of each row."""
    if not len(rows):
        return np.zeros(n, np.int64)
    pairs = np.unique(rows.astype(np.int64) * (int(codes.max()) + 1) + codes)
    return np.bincount(pairs // (int(codes.max()) + 1), minlength=n)


def _repeat_words(words: Words, width: int = 5) -> np.ndarray:
    """Words of each text in windows of width words that stand in it twice or more."""
    n = len(words.ids)
    out = np.zeros(len(words.starts) - 1, np.int64)
    if n < width:
        return out
    h = words.hashes()[words.ids]
    value = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        value = mix((value ^ h[j : n - width + 1 + j]) * np.uint64(0x2545F4914F6CDD1D))
    rows = words.rows
    inside = rows[: n - width + 1] == rows[width - 1 :]
    at = np.flatnonzero(inside)
    ordered, own = value[at].copy(), rows[at]
    ends = np.searchsorted(own, np.arange(len(words.starts))).tolist()
    for a, b in zip(ends, ends[1:]):
        ordered[a:b].sort()
    some = np.zeros(len(words.starts) - 1, bool)
    some[own[1:][(ordered[1:] == ordered[:-1]) & (own[1:] == own[:-1])]] = True
    at = at[some[own]]
    order = at[np.lexsort((value[at], rows[at]))]
    same = (value[order][1:] == value[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, order[twice], 1)
    np.add.at(edge, order[twice] + width, -1)
    return _per_text(np.cumsum(edge[:-1]) > 0, words.starts)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = pc.fill_null(batch.column("text"), "")
        words = Words(texts, lower=False)
        n = len(texts)
        chars = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        lines = pc.split_pattern(texts, "\n")
        starts = lines.offsets.to_numpy()
        line_rows = np.repeat(np.arange(n), np.diff(starts))
        coded = lines.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)), 0).to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy()
        has = worded[codes] if len(codes) else np.zeros(0, bool)
        n_lines = np.bincount(line_rows[has], minlength=n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(
                    pa.array(x.astype(np.int64))
                    for x in (
                        words.counts, _per_text(chars[words.ids] if len(words.ids) else np.zeros(0), words.starts), _of_bytes(texts, SYMBOLS),
                        n_lines - _distinct(line_rows[has], codes[has], n), _repeat_words(words), n_lines,
                        _of_bytes(texts, bytes(range(65, 91))), _distinct(words.rows, words.ids, n),
                    )
                ),
            ],
            names=[x.split()[0] for x in STATS.split(", ")],
        )


def statistics(docs: DataFrame) -> DataFrame:
    """The rule statistics of each document (STATS); null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_stats, STATS)


def _matrix(columns: dict[str, np.ndarray]) -> np.ndarray:
    c = {k: np.asarray(v, np.float64) for k, v in columns.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    parts = (c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_distinct"] / words**0.8, np.log1p(c["n_words"]))
    return np.column_stack(parts)


def _path(n: np.ndarray | float):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 1, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), 0.0)


def grow(rows: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """A forest of random splits as arrays: feature (-1 in a leaf), cut, left, right, length; root of each tree."""
    rng = np.random.default_rng(seed)
    feature, cut, left, right, length, roots = [], [], [], [], [], []
    limit = int(np.ceil(np.log2(TREE_ROWS)))
    order = rng.permutation(len(rows))

    def node(part: np.ndarray, depth: int) -> int:
        me = len(feature)
        for x in (feature, left, right):
            x.append(-1)
        cut.append(0.0)
        length.append(float(depth + _path(len(part))))
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth < limit and len(part) > 1 and len(varied):
            f = int(rng.choice(varied))
            at = rng.uniform(low[f], high[f])
            side = part[:, f] < at
            if 0 < side.sum() < len(part):
                feature[me], cut[me] = f, at
                left[me] = node(part[side], depth + 1)
                right[me] = node(part[~side], depth + 1)
        return me

    for t in range(TREES if len(rows) else 0):
        picked = order[t * TREE_ROWS : (t + 1) * TREE_ROWS] if len(rows) >= TREES * TREE_ROWS else rng.choice(len(rows), min(len(rows), TREE_ROWS), replace=False)
        roots.append(node(rows[picked], 0))
    size = min(len(rows), TREE_ROWS)
    return {"feature": np.array(feature, np.int32), "cut": np.array(cut), "left": np.array(left, np.int32), "right": np.array(right, np.int32), "length": np.array(length), "roots": np.array(roots, np.int32), "norm": np.array(max(float(_path(size)), 1e-9))}


def anomaly(forest: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """2 ** -(mean path length / expected length): near 1 for rows that random splits isolate early."""
    total = np.zeros(len(rows))
    if not len(forest["roots"]):
        return total
    at_row = np.arange(len(rows))
    for root in forest["roots"]:
        at = np.full(len(rows), root, np.int32)
        while True:
            f = forest["feature"][at]
            inner = f >= 0
            if not inner.any():
                break
            go_left = rows[at_row, np.maximum(f, 0)] < forest["cut"][at]
            at = np.where(inner, np.where(go_left, forest["left"][at], forest["right"][at]), at)
        total += forest["length"][at]
    return 2.0 ** (-(total / len(forest["roots"])) / forest["norm"])


def fit_forest(stats: DataFrame, most: int = TREES * TREE_ROWS) -> dict[str, np.ndarray]:
    """A forest from at most ``most`` documents with words, those whose doc_id has the smallest hash."""
    rows = smallest(stats.where("n_words > 0 and doc_id is not null"), most).toPandas()
    return grow(_matrix({k: rows[k].to_numpy() for k in rows.columns if k != "doc_id"}) if len(rows) else np.zeros((0, 7)))


def scored(stats: DataFrame, forest: dict[str, np.ndarray]) -> DataFrame:
    """stats with ``anomaly``."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix({k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names if k != "doc_id"})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly(shared.value, x))], names=[*batch.schema.names, "anomaly"])

    return stats.mapInArrow(score, STATS + ", anomaly double")


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def threshold(good: np.ndarray, bad: np.ndarray, most_good_lost: float = MOST_GOOD_LOST, loss: float = LOSS) -> float:
    """The bound of the score for which the share of bad documents over it less loss times that of good ones is largest.

    good, bad: labelled documents by bin of the score. At most most_good_lost of the good ones (GOOD_ALONE without bad
    ones) lie over it; of equally good bounds the highest; 2 without good documents.
    """
    if not good.sum():
        return 2.0
    lost, caught = (np.append(np.cumsum(n[::-1])[::-1], 0) / max(n.sum(), 1) for n in (good, bad))
    fine = np.flatnonzero(lost <= (most_good_lost if bad.sum() else GOOD_ALONE))
    gain = caught[fine] - loss * lost[fine] if bad.sum() else -fine
    return float(fine[len(fine) - 1 - np.argmax(gain[::-1])]) / BINS


def calibrate(rows: DataFrame, labels: DataFrame) -> float:
    """The threshold from all labelled rows that pass the base, counted by quality and bin; only the counts come to the driver."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    part = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS)).cast("int").alias("bin")
    bins = rows.where(~base_failed()).select("doc_id", part).join(known, "doc_id").groupBy("quality", "bin").agg(F.count("*").alias("n")).collect()
    counts = np.zeros((2, BINS + 1))
    for quality, at, n in bins:
        counts[int(quality == 1), at] += n
    return threshold(counts[1], counts[0])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: STATS, anomaly, base_failed, kept.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated five-word windows. Others are kept if their
    anomaly is under the calibrated threshold. Null and empty texts have zero counts and fail the base. doc_id may be null
    or repeated: rows are judged one by one. Columns other than doc_id and text (labels: doc_id, quality) are ignored.
    A document labelled twice counts by its better label. Without labelled good rows nothing is rejected but by the base; an
    empty table gives an empty result.
    """
    stats = keep(statistics(docs), "rule-stats")
    rows = keep(scored(stats, fit_forest(stats)), "anomaly")
    limit = calibrate(rows, labels)
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))
