"""Benchmark decontamination by latent semantic retrieval.

Passages (windows of words, half overlapping and more) become TF-IDF vectors over all words, hashed to FEATURES places; a
randomised SVD, for which Spark sums up all passages, gives the latent space. Every passage of every document is
projected into it and compared by cosine with all benchmark items; what is near is checked by the longest common
subsequence of words and by the item's answer, so that a paraphrase that keeps most of an item, or less of it but the
answer, is found. Texts are split into words once, and once more where an item may be.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, forget, keep, slices

RANK, MORE = 96, 16
#: Places of words (two bytes hold one), bytes of text that are taken at a time, and of features.
FEATURES, SLICE, CODED_SLICE = 1 << 14, 1_500_000, 400_000
#: Rows of a matrix that tasks send as one piece.
PIECE = 16
#: A passage is WINDOW blocks of BLOCK words; passages start at every block.
BLOCK, WINDOW = 16, 3
#: Rows that all passages of documents are summed up in for the SVD, tasks at most that send such sums, and passes over them.
SKETCH, SKETCH_TASKS, PASSES = 256, 192, 8
#: Weight of benchmark items' rows in the SVD, so that the space tells items apart, beside MOST_DOCS documents or fewer; beside
#: more it grows with the root of their number, so that items keep their share of all squares.
ITEM_WEIGHT, MOST_DOCS = 20.0, 800
#: Cosine from which an item is a candidate.
NEAR = 0.65
#: An item is found if the share of its words in the common subsequence is FULL, or PART and its answer is there.
FULL, PART, ANSWER = 0.75, 0.5, 0.75
#: Items of fewer words must be there word for word.
SHORT = 8
#: Items compared in one pass over the documents.
ITEMS_PER_PASS = 4096


def _features(words: Words) -> np.ndarray:
    """The feature of each word."""
    return (words.hashes(17) % np.uint64(FEATURES)).astype(np.int32)[words.ids] if len(words.ids) else np.zeros(0, np.int32)


def coded(docs: DataFrame) -> DataFrame:
    """docs with ids in place of text: the features of its words, two bytes each."""
    kept = [c for c in docs.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            words = Words(batch.column("text"))
            data = pa.py_buffer(_features(words).astype(np.uint16).tobytes())
            ids = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer((2 * words.starts).astype(np.int32).tobytes()), data])
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), ids], names=[*kept, "ids"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "ids binary"])
    return docs.mapInArrow(work, schema)


def _decoded(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all words, and where each text's begin."""
    count = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    flat = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(x.as_buffer(), np.uint16) for x in ids)])
    return flat.astype(np.int32), np.concatenate([[0], np.cumsum(count)])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature stands, and the number of documents, over all rows of docs, or of coded ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in slices(batches, "ids", CODED_SLICE):
            ids, starts = _decoded(batch.column("ids"))
            pairs = np.repeat(np.arange(batch.num_rows), np.diff(starts)) * FEATURES + ids
            pairs.sort()
            total += np.bincount(pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] % FEATURES if len(pairs) else pairs, minlength=FEATURES)
            n += batch.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([n, *total[at].tolist()], pa.int64())], names=["feature", "n"])

    own = docs if "ids" in docs.columns else coded(docs.select("text"))
    rows = own.select("ids").mapInArrow(work, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(FEATURES + 1, np.int64)
    out[rows["feature"].to_numpy()] = rows["n"].to_numpy()
    return out[:FEATURES], int(out[-1])


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log((n + 1.0) / (df + 1.0)).astype(np.float32)


def _blocks(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each block of BLOCK words (the last of a text may be shorter), and each text's first block."""
    count = -(-np.diff(starts) // BLOCK)
    first = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(count)), count)
    return starts[:-1][text] + (np.arange(first[-1]) - first[:-1][text]) * BLOCK, first


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end block of each passage, and its text; a text of fewer than WINDOW blocks is one passage."""
    count = np.diff(first)
    n = np.where(count > 0, np.maximum(count - WINDOW + 1, 1), 0)
    text = np.repeat(np.arange(len(count)), n)
    a = first[:-1][text] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return a, np.minimum(a + WINDOW, first[1:][text]), text


def _sum_rows(table: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of table[ids] over ids[at[i]:at[i + 1]], none of them empty, a stretch at a time."""
    out = np.empty((len(at) - 1, table.shape[1]), np.float32)
    step = 1024
    for i in range(0, len(out), step):
        j = min(i + step, len(out))
        np.add.reduceat(table.take(ids[at[i] : at[j]], axis=0), at[i:j] - at[i], axis=0, out=out[i:j])
    return out


def _windows(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of passages from those of blocks."""
    out = sums[a]
    for j in range(1, WINDOW):
        inside = a + j < b
        out[inside] += sums[a[inside] + j]
    return out


def project(table: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Latent vectors of all passages of length 1 (0 where nothing is known), their texts, their first and end word."""
    return _project(table, _features(words), words.starts)


def _project(table: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    block, first = _blocks(starts)
    edges = np.append(block, len(ids))
    sums = _sum_rows(table, ids, edges)
    a, b, text = _passages(first)
    vectors = _windows(sums, a, b)
    vectors /= np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None], 1e-9)
    return vectors, text, edges[a], edges[b]


def _weighted(ids: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges of blocks, first and end block of each passage, its text, and one over the norm of its words' weights."""
    block, first = _blocks(starts)
    a, b, text = _passages(first)
    norm = np.sqrt(_windows(np.add.reduceat(weights[ids].astype(np.float64) ** 2, block), a, b))
    return np.append(block, len(ids)), a, b, text, (1 / np.where(norm > 0, norm, 1.0)).astype(np.float32)


def _forward(scaled: np.ndarray, ids: np.ndarray, edges: np.ndarray, a: np.ndarray, b: np.ndarray, own: np.ndarray) -> np.ndarray:
    return _windows(_sum_rows(scaled, ids, edges), a, b) * own[:, None]


def _summed(rows: DataFrame, pieces, shape: tuple[int, int], dtype: type) -> np.ndarray:
    """The sum over tasks of the matrix that pieces gives for an iterator of slices (ids, starts), in stretches of its rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = pieces(x for batch in slices(batches, "ids", CODED_SLICE) for x in [_decoded(batch.column("ids"))] if len(x[0]))
        parts = [total[k : k + PIECE].astype(dtype).tobytes() for k in range(0, shape[0], PIECE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["piece", "part"])

    def add(table: pa.Table) -> pa.Table:
        total = 0.0
        for x in table.sort_by("task").column("part"):  # the same sum at every run
            total = total + np.frombuffer(x.as_buffer(), dtype).astype(np.float64)
        return pa.table({"piece": table.column("piece")[:1], "part": pa.array([total.astype(dtype).tobytes()], pa.binary())})

    parts = rows.select("ids").coalesce(SKETCH_TASKS).mapInArrow(work, "piece int, part binary").withColumn("task", F.spark_partition_id())
    sums = parts.groupBy("piece").applyInArrow(add, "piece int, part binary").toArrow().sort_by("piece")
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in sums.column("part")]).reshape(shape) if len(sums) else np.zeros(shape, dtype)


def _sketch(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """SKETCH x features: every passage of rows, weighted, is added with a random sign to the row that its text was given, so that
    B'B has the expectation A'A."""

    def work(each: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        total = np.zeros(SKETCH * FEATURES, np.float32)
        for ids, starts in each:
            rng = np.random.default_rng(zlib.crc32(ids.tobytes()))
            edges, a, b, text, own = _weighted(ids, starts, weights)
            signed = own * rng.choice(np.array([-1, 1], np.float32), len(own))
            block = np.zeros(len(edges) - 1, np.float32)
            for k in range(WINDOW):
                inside = a + k < b
                block[a[inside] + k] += signed[inside]
            place = np.repeat(rng.integers(SKETCH, size=len(starts) - 1) * FEATURES, np.diff(starts)) + ids
            np.add.at(total, place, np.repeat(block, np.diff(edges)) * weights[ids])
        return total.reshape(SKETCH, FEATURES)

    return _summed(rows, work, (SKETCH, FEATURES), np.float32)


def _spread(rows: DataFrame, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(A T)'(A T) over all passages of rows."""

    def work(each: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        scaled, total = table * weights[:, None], np.zeros((table.shape[1], table.shape[1]))
        for ids, starts in each:
            edges, a, b, _, own = _weighted(ids, starts, weights)
            y = _forward(scaled, ids, edges, a, b, own)
            total += y.T @ y
        return total

    return _summed(rows, work, (table.shape[1], table.shape[1]), np.float64)


def latent_space(docs: DataFrame, benchmark: DataFrame, weights: np.ndarray) -> np.ndarray:
    """For each feature, its weight times its place in the latent space: features x RANK. docs have texts or are coded.

    Randomised subspace iteration for the TF-IDF matrix of the passages of all documents, which one Spark job sums up in SKETCH
    rows, and of all items. A second job adds up how the passages spread in that space, exactly; the right singular vectors are
    turned and scaled so that they spread alike in all directions: what is common to all passages of a language counts little.
    """
    rows = docs if "ids" in docs.columns else keep(coded(docs.select("text")), "coded")
    more = np.float32(ITEM_WEIGHT * max(1.0, rows.count() / MOST_DOCS) ** 0.5)
    ids, starts = _decoded(pa.array([r.ids for r in coded(benchmark.select("text")).collect()], pa.binary()))
    seen = _sketch(rows, weights)
    edges, a, b, _, own = _weighted(ids, starts, weights)
    own = own * more
    word = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    table = np.random.default_rng(1).normal(size=(len(weights), RANK + MORE)).astype(np.float32)
    for _ in range(PASSES):
        y = _forward(table * weights[:, None], ids, edges, a, b, own) * own[:, None]
        back = np.zeros((len(edges) - 1, y.shape[1]), np.float32)
        for k in range(WINDOW):
            inside = a + k < b
            back[a[inside] + k] += y[inside]
        total = seen.T @ (seen @ table)
        np.add.at(total, ids, back[word] * weights[ids][:, None])
        table = np.ascontiguousarray(np.linalg.qr(total)[0])
    spread_docs = _spread(rows, weights, table)
    y = _forward(table * weights[:, None], ids, edges, a, b, own).astype(np.float64)
    values, vectors = np.linalg.eigh(spread_docs + y.T @ y)
    top = vectors[:, np.argsort(-values)[:RANK]]
    spread, turn = np.linalg.eigh(top.T @ spread_docs @ top)
    scale = 1 / np.sqrt(np.maximum(spread, 0) + max(spread.mean() * 0.02, 1e-9))
    return np.ascontiguousarray((table @ (top @ turn * scale) * weights[:, None]).astype(np.float32))


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    row, full = 0, (1 << len(a)) - 1
    for x in b:
        m = where.get(x)
        if m:
            u = row | m
            row = u & ~(u - ((row << 1) | 1)) & full
    return row.bit_count()


def answer(words: list[str]) -> list[str]:
    """An item's last sentence, or its last four words if that has fewer."""
    ends = [i for i, w in enumerate(words[:-1]) if w[-1] in ".?!"]
    return words[min(ends[-1] + 1 if ends else 0, max(len(words) - 4, 0)) :]


@dataclass
class Items:
    ids: list[int]
    words: list[list[str]]
    vectors: np.ndarray
    owner: np.ndarray
    features: list[list[int]]


def _items(rows: list, table: np.ndarray) -> Items:
    texts = pa.array([r.text for r in rows], pa.string())
    words = Words(texts)
    vocab = words.vocab.to_pylist()
    vectors, owner, *_ = project(table, words)
    features = [x.tolist() for x in np.split(_features(words), words.starts[1:-1])]
    return Items([r.item_id for r in rows], [[vocab[i] for i in words.ids[a:b]] for a, b in zip(words.starts, words.starts[1:])], vectors, owner, features)


def found(item: list[str], region: list[str]) -> float:
    """The share of the item in the region if that counts as found, else 0."""
    share = common_subsequence(item, region) / len(item)
    if len(item) < SHORT:
        return share if any(region[i : i + len(item)] == item for i in range(len(region) - len(item) + 1)) else 0.0
    if share >= FULL:
        return share
    own = answer(item)
    return share if share >= PART and common_subsequence(own, region) >= ANSWER * len(own) else 0.0


def _suspects(table: np.ndarray, items: Items):
    """doc_id of coded documents with a passage near an item, PART of whose features are around it: the others' words hold no item."""
    longest = max(map(len, items.words), default=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", CODED_SLICE):
            ids, starts = _decoded(batch.column("ids"))
            vectors, text, a, b = _project(table, ids, starts)
            hits: set[int] = set()
            for i in range(0, len(vectors), 4096):
                at, which = np.nonzero(vectors[i : i + 4096] @ items.vectors.T >= NEAR)
                last, around = -1, set()
                for p, w in sorted(set(zip((at + i).tolist(), items.owner[which].tolist()))):
                    row = int(text[p])
                    if row in hits:
                        continue
                    if p != last:
                        last, around = p, set(ids[max(starts[row], a[p] - longest) : min(starts[row + 1], b[p] + longest)].tolist())
                    if sum(map(around.__contains__, items.features[w])) >= PART * len(items.features[w]):
                        hits.add(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(sorted(hits), pa.int64()))], names=["doc_id"])

    return work


def _search(table: np.ndarray, items: Items):
    longest = max(map(len, items.words), default=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            words = Words(batch.column("text"))
            vectors, text, a, b = project(table, words)
            hits: dict[tuple[int, int], float] = {}
            vocab, place = None, {}
            for i in range(0, len(vectors), 4096):
                at, which = np.nonzero(vectors[i : i + 4096] @ items.vectors.T >= NEAR)
                if len(at) and vocab is None:
                    vocab = words.vocab.to_pylist()
                    place = {x: k for k, x in enumerate(vocab)}
                    coded = [[place.get(x, -1) for x in item] for item in items.words]
                last, near = -1, set()
                for p, w in sorted(set(zip((at + i).tolist(), items.owner[which].tolist()))):
                    row, reach = int(text[p]), longest
                    if p != last:
                        lo, hi = max(words.starts[row], a[p] - reach), min(words.starts[row + 1], b[p] + reach)
                        last, near = p, set(words.ids[lo:hi].tolist())
                    if sum(map(near.__contains__, coded[w])) < PART * len(coded[w]):
                        continue  # the common subsequence can't be longer
                    share = found(items.words[w], [vocab[x] for x in words.ids[lo:hi]])
                    if share > hits.get((row, w), 0.0):
                        hits[row, w] = share
            order = sorted(hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array([r for r, _ in order], pa.int64())), pa.array([items.ids[w] for _, w in order], pa.int64()), pa.array([hits[k] for k in order], pa.float64())],
                names=["doc_id", "item_id", "share"],
            )

    return work


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, share: every document with a doc_id in which an item is found.

    Items are taken ITEMS_PER_PASS at a time, each time with a latent space of their own; document frequencies are counted once.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    bench = benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    out, last, counted, lists = None, None, None, None
    while True:
        rest = bench if last is None else bench.where((F.col("item_id") > last[0]) | ((F.col("item_id") == last[0]) & (F.col("text") > last[1])))
        rows = rest.orderBy("item_id", "text").limit(ITEMS_PER_PASS).collect()
        worded = [r for r in rows if r.text.split()]
        if worded:
            own = docs.sparkSession.createDataFrame([(r.text,) for r in worded], "text string")
            lists = lists if lists is not None else keep(coded(texts), "coded")
            counted = counted or document_frequencies(lists)
            table = latent_space(lists, own, idf(*counted))
            items = _items(worded, table)
            near = keep(lists.where("doc_id is not null").mapInArrow(_suspects(table, items), "doc_id long"), "suspects").distinct()
            part = texts.join(near, "doc_id", "left_semi").mapInArrow(_search(table, items), "doc_id long, item_id long, share double")
            out = part if out is None else out.unionByName(part)
        if len(rows) < ITEMS_PER_PASS:
            break
        last = (rows[-1].item_id, rows[-1].text)
    forget(lists)
    return out if out is not None else texts.where("false").select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("share"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, contaminated, items (sorted item_ids), share (the largest).

    Null and empty texts have no passage and are clean, as is a row with a null doc_id. Items that repeat are one; items
    without words or item_id are left out. Repeated rows are judged alike. Columns other than doc_id and text (benchmark:
    item_id, text) are ignored; with an empty benchmark all is clean, and no documents give no rows.
    """
    hits = matches(docs, benchmark).where("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("share"))
    hits = keep(hits, "contaminated")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(hits, "doc_id", "left")
    return rows.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("share", F.lit(0.0)).alias("share"))


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs but for contaminated ones, with all columns."""
    gone = contaminated(docs, benchmark).where("contaminated").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
