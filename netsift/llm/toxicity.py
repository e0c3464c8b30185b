"""Toxicity from confirmed toxic examples and unlabelled text: a linear model under the non-negative PU risk.

Every text is reduced once to the features that toxic examples have, a small packed table that training and scoring read.
All training documents are the unlabelled side: in each round every partition takes steps over its own documents, a chunk
at a time, against the toxic sample that all have; then the partitions' parameters are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, average, held_out, keep, mix, slices, smallest

#: Bound of the toxic labelled documents that are learned from, those whose doc_id has the smallest hash.
MOST_TOXIC = 3_000
SLOTS = 1 << 20
#: A feature that is one in so many of a text's words is marked as standing there often.
SHARES = (200, 100)
#: A feature is learned if so many toxic training documents have it, and this share of them.
LEAST_DOCS, LEAST_SHARE = 3, 0.01
BATCH, RATE, SPARSITY = 512, 0.07, 8e-4
#: Rounds of averaging; in each a partition takes so many steps for each chunk of its documents.
ROUNDS, STEPS, CHUNK = 2, 450, 8_192
#: Partitions whose parameters are averaged at a time.
FAN_IN = 64
FOLDS, HELD = 5, 0
EDGE = " .,;:!?\"'()[]{}|*#%$&-_<>«»“”…"


def _slots(vocab: pa.Array) -> np.ndarray:
    """Three feature slots for each word: itself without outer punctuation, and its first five and four letters."""
    core = pc.utf8_trim(vocab, characters=EDGE)
    digest = xxhash.xxh3_64_intdigest
    out = np.empty((len(vocab), 3), np.int32)
    for j, (part, seed) in enumerate(((core, 1), (pc.utf8_slice_codeunits(core, 0, 5), 2), (pc.utf8_slice_codeunits(core, 0, 4), 3))):
        coded = part.dictionary_encode()
        slot = np.fromiter((digest(w, seed) % SLOTS for w in coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
        out[:, j] = slot[coded.indices.to_numpy()] if len(vocab) else 0
    return out


def _often(slots: np.ndarray, level: int) -> np.ndarray:
    """The slots that say that a feature stands often in a text."""
    return (mix(slots.astype(np.uint64) + np.uint64(level << 32)) % np.uint64(SLOTS)).astype(np.int64)


def features(texts: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature slots of each text and where each text's begin; only slots marked in used, if given.

    A feature that makes up one in SHARES[i] of a text's words or more has a second slot for each such i.
    """
    words = Words(texts)
    n = len(words.starts) - 1
    slots = _slots(words.vocab)
    if used is not None:
        asked = used.copy()
        for i in range(len(SHARES)):
            asked |= used[_often(np.arange(SLOTS), i)]
    parts = []
    for j in range(3):
        slot = slots[:, j]
        ids, rows = words.ids, words.rows
        if used is not None and len(slot):
            fine = asked[slot][ids]
            ids, rows = ids[fine], rows[fine]
        parts.append(rows * SLOTS + (slot[ids] if len(ids) else np.zeros(0, np.int64)))
    pairs, count = np.unique(np.concatenate(parts), return_counts=True)
    row, slot = np.divmod(pairs, SLOTS)
    size = words.counts[row]
    every = [pairs, *(row[f] * SLOTS + _often(slot[f], i) for i, f in enumerate(count * k >= size for k in SHARES))]
    pairs = np.unique(np.concatenate(every))
    if used is not None:
        pairs = pairs[used[pairs % SLOTS]]
    return (pairs % SLOTS).astype(np.int32), np.searchsorted(pairs // SLOTS, np.arange(n + 1))


def _sample(docs: DataFrame, ids: DataFrame) -> list[np.ndarray]:
    """Features of the documents with these ids; there are boundedly many, so they are broadcast."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            slot, starts = features(batch.column("text"))
            rows = pa.array([slot[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], names=["doc_id", "slots"])

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(packed, "doc_id long, slots binary").toPandas()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    return [np.frombuffer(rows["slots"].iat[i], np.int32) for i in order]


def _smallest(ids: DataFrame, most: int) -> DataFrame:
    return smallest(ids.where("doc_id is not null").select("doc_id").distinct(), most)


def _csr(docs: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = [p[p >= 0] for p in (place[d] for d in docs)]
    return np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def _dot(weight: np.ndarray, idx: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(weight[idx])])[starts])


def _take(idx: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = (starts[1:] - starts[:-1])[rows]
    at = np.concatenate([[0], np.cumsum(lengths)])
    return idx[np.repeat(starts[rows], lengths) + np.arange(at[-1]) - np.repeat(at[:-1], lengths)], at


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def common(toxic: list[np.ndarray]) -> np.ndarray:
    """Which features are learned: those of LEAST_DOCS toxic documents, and of LEAST_SHARE of all."""
    return np.bincount(np.concatenate([np.zeros(0, np.int32), *toxic]), minlength=SLOTS) >= max(LEAST_DOCS, LEAST_SHARE * len(toxic))


class Fit:
    """Weights and a bias that minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), logistic loss.

    Where the corrected negative part of a batch falls under 0, the step goes up along it, as the non-negative estimator
    has it. Soft thresholding after each step leaves weights only where they pay.
    """

    def __init__(self, params: np.ndarray, prior: float, seed: int):
        self.w, self.b, self.prior = params[:-1].astype(np.float64), float(params[-1]), prior
        self.sums, self.b_sum, self.rng = np.full(len(self.w), 1e-4), 1e-4, np.random.default_rng(seed)

    def params(self) -> np.ndarray:
        return np.append(self.w, self.b)

    def gradients(self, p: tuple[np.ndarray, np.ndarray], u: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, float]:
        """Of the risk of toxic examples p and unlabelled ones u, each as features and where each text's begin."""
        sp, su = (_sigmoid(_dot(self.w, *x) + self.b) for x in (p, u))
        negative = np.mean(-np.log1p(-np.minimum(su, 1 - 1e-12))) - self.prior * np.mean(-np.log1p(-np.minimum(sp, 1 - 1e-12)))
        if negative >= 0:
            gp, gu = (self.prior * (sp - 1) - self.prior * sp) / len(sp), su / len(su)
        else:
            gp, gu = self.prior * sp / len(sp), -su / len(su)
        n = len(self.w)
        return np.bincount(p[0], np.repeat(gp, np.diff(p[1])), n) + np.bincount(u[0], np.repeat(gu, np.diff(u[1])), n), gp.sum() + gu.sum()

    def steps(self, toxic: tuple[np.ndarray, np.ndarray], unlabelled: tuple[np.ndarray, np.ndarray], n: int) -> None:
        many = [len(x[1]) - 1 for x in (toxic, unlabelled)]
        size = [min(many[0], max(32, BATCH // 3)), min(many[1], BATCH)]
        order, at = self.rng.permutation(many[1]), 0
        for _ in range(n):
            if at + size[1] > many[1]:
                order, at = self.rng.permutation(many[1]), 0
            chosen, at = order[at : at + size[1]], at + size[1]
            g, gb = self.gradients(_take(*toxic, self.rng.choice(many[0], size[0], replace=False)), _take(*unlabelled, chosen))
            self.sums += g * g
            self.b_sum += gb * gb
            step = RATE / np.sqrt(self.sums)
            self.w -= step * g
            self.w = np.sign(self.w) * np.maximum(np.abs(self.w) - step * SPARSITY, 0)
            self.b -= RATE / np.sqrt(self.b_sum) * gb


def pack(docs: DataFrame, used: np.ndarray, folds: int, held: int) -> DataFrame:
    """doc_id, held_out, trained (neither held out nor without doc_id), ids: the places of each text's features among used."""
    place = np.full(SLOTS, -1, np.int32)
    place[used] = np.arange(len(used))
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            slot, starts = features(batch.column("text"), shared.value >= 0)
            ids = shared.value[slot].astype(_kind(len(used)))
            rows = pa.array([ids[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), rows], names=["doc_id", "held_out", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), folds, held).alias("held_out"), "text")
    return rows.mapInArrow(work, "doc_id long, held_out boolean, ids binary")


def _kind(n_features: int) -> type:
    """The narrowest numbers that name so many features."""
    return np.uint16 if n_features <= 1 << 16 else np.int32


def _packed(column: pa.Array, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    each = [np.frombuffer(x.as_buffer(), _kind(n_features)).astype(np.int32) for x in column]
    return np.concatenate([np.zeros(0, np.int32), *each]), np.cumsum([0, *map(len, each)])


def train(packed: DataFrame, toxic: tuple[np.ndarray, np.ndarray], n_features: int, prior: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and the bias after as many rounds over all training rows of packed."""
    own = packed.where("not held_out and doc_id is not null").select("ids")
    n = own.count()
    params = np.append(np.zeros(n_features), -2.0).astype(np.float32)
    own = own.coalesce(max(1, n // CHUNK))
    for r in range(rounds if n else 0):
        start, seed = params, 100 + r

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fit, held, seen = Fit(start, prior, seed), [], 0

            def use() -> None:
                idx, starts = zip(*held)
                ends = np.cumsum([0, *(len(x) for x in idx)])
                both = np.concatenate(idx), np.concatenate([[0], *(s[1:] + e for s, e in zip(starts, ends))])
                held.clear()
                fit.steps(toxic, both, STEPS)

            for batch in batches:
                if batch.num_rows:
                    held.append(_packed(batch.column("ids"), n_features))
                    seen += batch.num_rows
                if sum(len(s) - 1 for _, s in held) >= CHUNK:
                    use()
            if held:
                use()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([fit.params().astype(np.float32).tobytes()], pa.binary())], names=["weight", "params"])

        last = average(own.mapInArrow(work, "weight long, params binary"), FAN_IN)
        params = last if last is not None else params
    return params


def learn(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """The features in use, their weights with the bias, and the packed table of docs (None if there is nothing to learn from).

    Toxic labels of training rows are the confirmed examples, all training documents the unlabelled ones. The class prior is
    the share of toxic rows among labelled training rows; a label 0 is used for nothing else.
    """
    train_rows = ~held_out(F.col("doc_id"), folds, held)
    known = labels.where(train_rows)
    counts = known.agg(F.count_if(F.col("toxic") == 1), F.count("toxic")).first()
    prior = min(max(counts[0] / max(counts[1], 1), 0.01), 0.9)
    toxic = _sample(docs, _smallest(known.where("toxic = 1"), MOST_TOXIC))
    used = np.flatnonzero(common(toxic)) if toxic else np.zeros(0, np.int64)
    if not len(used):
        return used, np.array([-5.0]), None
    place = np.full(SLOTS, -1, np.int64)
    place[used] = np.arange(len(used))
    packed = keep(pack(docs, used, folds, held), "toxicity-features")
    return used, train(packed, _csr(toxic, place), len(used), prior), packed


def score_packed(packed: DataFrame, params: np.ndarray) -> DataFrame:
    """doc_id, held_out and score of packed texts."""
    shared = packed.sparkSession.sparkContext.broadcast(params.astype(np.float64))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(_sigmoid(_dot(shared.value[:-1], *_packed(batch.column("ids"), len(shared.value) - 1)) + shared.value[-1]))], names=["doc_id", "held_out", "score"])

    return packed.mapInArrow(scores, "doc_id long, held_out boolean, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts get the model's score of no feature. Rows with a null doc_id are scored and never trained on;
    repeated rows get equal scores. Without toxic labels, or words in toxic texts, every score is near 0. Columns other than
    doc_id and text (labels: doc_id, toxic) are ignored; an empty table gives an empty result.
    """
    used, params, packed = learn(docs, labels, folds, held)
    if packed is None:
        packed = pack(docs, used, folds, held)
    return score_packed(packed, params).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs but for those scored 0.5 or more, with all columns."""
    gone = classify(docs, labels).where("predicted = 1").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
