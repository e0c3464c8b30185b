"""A log-bilinear language model trained by noise-contrastive estimation, and unigram counts over the whole corpus.

Counts: tokens guessed to be frequent (HOT) are summed by batches; the guess changes how counts travel, not what they are. All
others travel as packed arrays, one entry for a document and token, to buckets of the token's hash; a bucket counts its
tokens over all training documents and sends back what each document needs of them, again packed, and its most frequent ones.

Model: the most frequent tokens are classes of their own, every other token belongs to the class of its ending, within
which it has its share of the counts (plus one; unseen ones together have one more). So all words take part, whatever
their number. The class is predicted from the classes of the two tokens before it: a linear map of their vectors is matched
with each class's vector. Training runs on all training documents, in every partition by itself, and the partitions'
parameters are averaged; scoring normalises over all classes by matrix products, once for each distinct pair in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, average, buckets_for, by_bucket, held_out, keep, mix, slices, smallest, text_bytes

#: Classes of endings (a power of two), of single tokens, and size of vectors.
FORMS, SINGLE, DIM = 512, 511, 16
ENDING = 2
#: Tokens that batches sum: the most frequent ones of a sample of so many documents, those of smallest hash.
HOT, HOT_DOCS = 4096, 2000
NOISE, BATCH, RATE, BIAS_RATE, ROUNDS = 128, 1024, 0.015, 0.005, 2
#: Training tokens that a partition has at least, if there are as many.
TRAIN_TOKENS = 1_500_000
FOLDS, HELD = 7, 2
#: The class of the end; those of endings come before it, those of single tokens after it.
END = FORMS
#: Bytes of text for one token, and tokens of a bucket, about.
TOKEN_BYTES, PER_BUCKET, FAN_IN = 10, 1_000_000, 64
_END_HASH = np.uint64(0xE5D0F5E27D3A1B47)
_NONE = np.iinfo(np.int64).max


@dataclass
class Tokens:
    """All tokens of a piece of texts, an end after each: index into hashes, and where each text begins."""

    ids: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def endings(vocab: pa.Array) -> np.ndarray:
    """The class of each word's last letters."""
    coded = pc.utf8_slice_codeunits(vocab, -ENDING).dictionary_encode()
    of = np.fromiter((xxhash.xxh3_64_intdigest(x) % FORMS for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return of[coded.indices.to_numpy()] if len(vocab) else np.zeros(0, np.uint64)


def tokens(texts: pa.Array) -> Tokens:
    """The last bits of a word's hash are the class of its ending."""
    words = Words(texts)
    n = len(words.counts)
    starts = words.starts + np.arange(n + 1)
    ids = np.full(starts[-1], len(words.vocab), np.int64)
    ids[np.arange(len(words.ids)) + words.rows] = words.ids
    return Tokens(ids, np.append(words.hashes() & ~np.uint64(FORMS - 1) | endings(words.vocab), _END_HASH), starts)


def _places(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where each hash is in known (sorted), -1 if it isn't."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out, and _k, a hash of doc_id and text: rows that repeat both have one _k."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.select("doc_id", "text", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), F.xxhash64(F.coalesce("doc_id", F.lit(_NONE)), "text").alias("_k"))


def hot_tokens(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of the HOT - 1 most frequent words of HOT_DOCS training documents (ties by hash), and of the end: what batches
    sum. No result depends on it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            t = tokens(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(t.hashes[:-1].view(np.int64)), pa.array(np.bincount(t.ids, minlength=len(t.hashes))[:-1])], names=["h", "n"])

    own = texts.where(~F.col("held_out"))
    sample = own.join(F.broadcast(smallest(own.select("_k").distinct(), HOT_DOCS, "_k")), "_k", "left_semi").select("text")
    top = sample.mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(HOT - 1).collect()
    return np.unique(np.append(np.array([r.h for r in top], np.int64).view(np.uint64), _END_HASH))


def _send(n_buckets: int, hot: np.ndarray):
    """bucket, payload: entries of documents' tokens; in buckets under 0, of which there are a tenth as many, each task's sums of hot tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, part = np.zeros(len(hot), np.int64), 0
        for batch in slices(batches):
            key = batch.column("_k").to_numpy(zero_copy_only=False)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            t = tokens(batch.column("text"))
            place = _places(t.hashes, hot)
            rows = t.rows
            learned = place[t.ids[train[rows]]]
            sums += np.bincount(learned[learned >= 0], minlength=len(hot))
            part = int(key[0]) if len(key) else part
            rest = place[t.ids] < 0
            pairs, n = np.unique(rows[rest] * len(t.hashes) + t.ids[rest], return_counts=True)
            row, h = pairs // len(t.hashes), t.hashes[pairs % len(t.hashes)]
            order, at = by_bucket((mix(h) % np.uint64(n_buckets)).astype(np.int64), n_buckets)
            row, h, n = row[order], h[order], n[order].astype(np.uint32)
            full = np.flatnonzero(np.diff(at))
            cut = lambda a, b: b"".join([h[a:b].tobytes(), key[row[a:b]].tobytes(), n[a:b].tobytes(), train[row[a:b]].tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([cut(at[b], at[b + 1]) for b in full], pa.binary())], names=["bucket", "payload"])
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array([-1 - part % (n_buckets // 10 + 1)], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["bucket", "payload"])

    return work


_COUNTED = "kind int, bucket int, payload binary, a long, b long"


def _count(n_buckets: int, hot: np.ndarray):
    def sums(kind: int, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
        m = len(at)
        return {"kind": pa.array(np.full(m, kind, np.int32)), "bucket": pa.array(at.astype(np.int32)), "payload": pa.nulls(m, pa.binary()), "a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64))}

    def work(table: pa.Table) -> pa.Table:
        """Of this bucket's tokens: parts of documents (kind 0), and for each ending tokens and types (kind 1), and
        counts and hashes of the SINGLE most frequent ones (kind 3); of sums of hot tokens their sum (kind 2)."""
        views = [memoryview(p.as_buffer()) for p in table.column("payload")]
        if table.column("bucket")[0].as_py() < 0:
            total = sum(np.frombuffer(v, np.int64) for v in views)
            return pa.table(sums(2, np.arange(len(hot)), total, np.zeros(len(hot))))
        sizes = [len(v) // 21 for v in views]
        column = lambda kind, at: np.concatenate([np.frombuffer(v[at * n : (at + np.dtype(kind).itemsize) * n], kind) for v, n in zip(views, sizes)])
        h, key, n, train = column(np.uint64, 0), column(np.int64, 8), column(np.uint32, 16).astype(np.int64), column(np.bool_, 20)
        order = np.argsort(h, kind="stable")
        h, key, n, train = h[order], key[order], n[order], train[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        count = np.add.reduceat(n * train, first)
        form = (h[first] & np.uint64(FORMS - 1)).astype(np.int64)
        own = sums(1, np.arange(FORMS), np.bincount(form, count, FORMS), np.bincount(form, count > 0, FORMS))
        top = np.argsort(-count, kind="stable")[:SINGLE]  # ties by hash, as first is in its order
        top = top[count[top] > 0]
        most = sums(3, np.arange(len(top)), count[top], h[first[top]].view(np.int64))
        each = np.repeat(count, np.diff(np.append(first, len(h))))
        order = np.argsort(key, kind="stable")
        key, n, each = key[order], n[order], each[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        docs = [key[at], np.add.reduceat(n * np.log10(each + 1.0), at), np.add.reduceat(n * (each > 0), at), np.add.reduceat(n, at)]
        order, cut = by_bucket((mix(docs[0].astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64), n_buckets)
        docs = [c[order] for c in docs]
        full = np.flatnonzero(np.diff(cut))
        parts = sums(0, full, np.zeros(len(full)), np.zeros(len(full)))
        parts["payload"] = pa.array([b"".join(c[cut[b] : cut[b + 1]].tobytes() for c in docs) for b in full], pa.binary())
        return pa.concat_tables([pa.table(parts), pa.table(own), pa.table(most)])

    return work


def _collect_parts(table: pa.Table) -> pa.Table:
    """Sum the parts of each document; n_entries tells how many tokens they have, of all rows that repeat it."""
    views = [memoryview(p.as_buffer()) for p in table.column("payload")]
    sizes = [len(v) // 32 for v in views]
    column = lambda kind, j: np.concatenate([np.frombuffer(v[8 * j * n : 8 * (j + 1) * n], kind) for v, n in zip(views, sizes)])
    key, logs, known, entries = column(np.int64, 0), column(np.float64, 1), column(np.int64, 2), column(np.int64, 3)
    order = np.lexsort((logs, key))  # a fixed order of summing, so that reruns agree
    key, logs, known, entries = key[order], logs[order], known[order], entries[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return pa.table({"_k": key[at], "log_rest": np.add.reduceat(logs, at), "known_rest": np.add.reduceat(known, at), "n_entries": np.add.reduceat(entries, at)})


@dataclass
class Vocabulary:
    hot: np.ndarray  # sorted hashes: what batches sum, and all single tokens
    hot_counts: np.ndarray
    classes: np.ndarray  # class of each hot token
    counts: np.ndarray  # training tokens by class
    types: np.ndarray  # and seen types; 1 for the end and single tokens
    summed: np.ndarray | None = None  # hot tokens that batches sum (None: all); the others' counts reach documents from buckets

    def __post_init__(self):
        if self.summed is None:
            self.summed = np.ones(len(self.hot), bool)

    @property
    def n_tokens(self) -> int:
        return int(self.counts.sum())

    @property
    def n_types(self) -> int:
        return int(self.types[:END].sum() + (self.counts[END:] > 0).sum())

    def of(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The class of each token, and its place among the hot ones (-1: none)."""
        place = _places(t.hashes, self.hot)
        return np.where(place >= 0, self.classes[place], (t.hashes & np.uint64(FORMS - 1)).astype(np.int64))[t.ids], place[t.ids]

    @property
    def within(self) -> np.ndarray:
        """Log10 of what a class's counts plus one have together, an unseen word among them; 0 for single tokens."""
        return np.log10(np.where(np.arange(len(self.counts)) < END, self.counts + self.types + 1.0, 1.0))

    @property
    def base(self) -> np.ndarray:
        """Log of each class's share of the counts, add-one."""
        n = self.counts + self.types + 1.0
        return np.log(n / n.sum())


def vocabulary(counted: DataFrame, hot: np.ndarray) -> Vocabulary:
    """Counts of classes: the SINGLE most frequent words of all training documents (ties by hash) are classes of their own."""
    rows = counted.where("kind in (1, 2)").groupBy("kind", "bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    forms, own = rows[rows["kind"] == 1], rows[rows["kind"] == 2]
    counts, types, hot_counts = np.zeros(FORMS), np.zeros(FORMS), np.zeros(len(hot))
    counts[forms["bucket"]], types[forms["bucket"]], hot_counts[own["bucket"]] = forms["a"], forms["b"], own["a"]
    # in order of the hash as an unsigned number
    top = counted.where("kind = 3").select("a", "b").orderBy(F.desc("a"), F.col("b").bitwiseXOR(F.lit(-(1 << 63)))).limit(SINGLE).collect()
    hot, hot_counts = np.append(hot, np.array([r.b for r in top], np.int64).view(np.uint64)), np.append(hot_counts, [float(r.a) for r in top])
    summed = np.arange(len(hot)) < len(hot) - len(top)
    order = np.lexsort((hot, -hot_counts))
    chosen = np.zeros(len(hot), bool)
    chosen[order[(hot[order] != _END_HASH) & (hot_counts[order] > 0)][:SINGLE]] = True
    at = np.flatnonzero(summed | chosen)
    at = at[np.argsort(hot[at])]
    hot, hot_counts, summed = hot[at], hot_counts[at], summed[at]
    rest = (hot[~summed] & np.uint64(FORMS - 1)).astype(np.int64)  # now single, no longer of their ending's class
    counts, types = counts - np.bincount(rest, hot_counts[~summed], FORMS), types - np.bincount(rest, minlength=FORMS)
    order = np.lexsort((hot, -hot_counts))
    single = order[(hot[order] != _END_HASH) & (hot_counts[order] > 0)][:SINGLE]
    classes = (hot & np.uint64(FORMS - 1)).astype(np.int64)
    classes[hot == _END_HASH] = END
    classes[single] = END + 1 + np.arange(len(single))
    k = END + 1 + len(single)
    counts = np.append(counts, np.zeros(k - FORMS)) + np.bincount(classes, hot_counts, k)
    types = np.append(types, np.zeros(k - FORMS)) + np.bincount(classes, hot_counts > 0, k)
    return Vocabulary(hot, hot_counts, classes, counts, types, summed)


@dataclass
class Model:
    context: np.ndarray
    target: np.ndarray
    maps: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(vocab: Vocabulary, seed: int = 3) -> Model:
        rng = np.random.default_rng(seed)
        k = len(vocab.counts)
        draw = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
        maps = np.stack([np.eye(DIM, dtype=np.float32)] * 2)
        return Model(draw(k, DIM, by=0.1), draw(k, DIM, by=0.1), maps, vocab.base.astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.maps, self.bias]

    def bytes(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float32).tobytes()

    def like(self, flat: np.ndarray) -> Model:
        out = []
        for p in self.parts():
            out.append(flat[: p.size].reshape(p.shape).astype(np.float32).copy())
            flat = flat[p.size :]
        return Model(*out)


def contexts(t: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens before; before a text's first token there are ends."""
    at = np.arange(len(classes)) - np.repeat(t.starts[:-1], np.diff(t.starts))
    one, two = np.roll(classes, 1), np.roll(classes, 2)
    one[at < 1] = END
    two[at < 2] = END
    return one, two


def _scatter(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(index.astype(np.int16), kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(index[order]) != 0]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[index[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Trainer:
    """Adam on the noise-contrastive loss; NOISE classes drawn from the unigram distribution serve a whole batch."""

    def __init__(self, model: Model, vocab: Vocabulary, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        noise = np.exp(vocab.base)
        self.cumulative = np.cumsum(noise)
        self.log_kq = np.log(noise * NOISE).astype(np.float32)
        self.mean = [np.zeros_like(p) for p in model.parts()]
        self.square = [np.zeros_like(p) for p in model.parts()]
        self.steps = 0

    def gradients(self, one: np.ndarray, two: np.ndarray, y: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the mean loss -log s(f(y) - log kq(y)) - sum over noise of log(1 - s(f - log kq)), s the logistic function."""
        m, k = self.m, len(self.log_kq)
        c1, c2 = m.context[one], m.context[two]
        q = c1 @ m.maps[0] + c2 @ m.maps[1]
        r_y, r_n = m.target[y], m.target[noise]
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g_y = sig(np.einsum("ij,ij->i", q, r_y) + m.bias[y] - self.log_kq[y]) - 1
        g_n = sig(q @ r_n.T + m.bias[noise] - self.log_kq[noise])
        n = np.float32(len(y))
        d_q = (g_y[:, None] * r_y + g_n @ r_n) / n
        d_target = _scatter(y, g_y[:, None] * q, k) / n
        np.add.at(d_target, noise, g_n.T @ q / n)
        d_bias = (np.bincount(y, g_y, k) + np.bincount(noise, g_n.sum(axis=0), k)) / n
        d_context = _scatter(np.concatenate([one, two]), np.concatenate([d_q @ m.maps[0].T, d_q @ m.maps[1].T]), k)
        return d_context, d_target, np.stack([c1.T @ d_q, c2.T @ d_q]), d_bias.astype(np.float32)

    def step(self, one: np.ndarray, two: np.ndarray, y: np.ndarray) -> None:
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(self.log_kq) - 1)
        self.steps += 1
        for p, g, m, v, rate in zip(self.m.parts(), self.gradients(one, two, y, noise), self.mean, self.square, (RATE, RATE, RATE / 10, BIAS_RATE)):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-6)


def _train(model: Model, vocab: Vocabulary, round_: int):
    flat = model.bytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(model.like(np.frombuffer(flat, np.float32)), vocab, 100 + round_)
        seen = 0
        for batch in slices(batches):
            t = tokens(batch.column("text"))
            y, _ = vocab.of(t)
            one, two = contexts(t, y)
            order = trainer.rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                at = order[i : i + BATCH]
                trainer.step(one[at], two[at], y[at])
            seen += len(y)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([trainer.m.bytes()], pa.binary())], names=["weight", "params"])

    return work


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model after as many rounds; each reads its share of the training texts, and all rounds together read all.

    The partitions' parameters, weighted by their tokens, are averaged FAN_IN at a time until one row is left.
    """
    model = Model.fresh(vocab)
    own = texts.where(~F.col("held_out")).coalesce(max(1, vocab.n_tokens // TRAIN_TOKENS))
    for r in range(rounds):
        part = own.where(F.pmod(F.col("_k"), F.lit(rounds)) == r).select("text")
        last = average(part.mapInArrow(_train(model, vocab, r), "weight long, params binary"), FAN_IN)
        if last is not None:
            model = model.like(last)
    return model


def _score(model: Model, vocab: Vocabulary):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, k = np.log(10.0), len(vocab.counts)
        tables = [model.context @ m for m in model.maps]
        log_hot, within, known = np.log10(vocab.hot_counts + 1), vocab.within, vocab.hot_counts > 0
        for batch in slices(batches):
            t = tokens(batch.column("text"))
            y, hot = vocab.of(t)
            one, two = contexts(t, y)
            pair, at = np.unique(one * k + two, return_inverse=True)
            q = tables[0][pair // k] + tables[1][pair % k]
            log_z = np.empty(len(pair), np.float32)
            for i in range(0, len(pair), 4096):
                z = q[i : i + 4096] @ model.target.T + model.bias
                top = z.max(axis=1)
                z -= top[:, None]
                log_z[i : i + 4096] = np.log(np.exp(z, out=z).sum(axis=1)) + top
            own = np.empty(len(y))
            for i in range(0, len(y), 1 << 17):
                a = at[i : i + (1 << 17)]
                own[i : i + (1 << 17)] = np.einsum("ij,ij->i", q[a], model.target[y[i : i + (1 << 17)]]) + model.bias[y[i : i + (1 << 17)]] - log_z[a]
            sums = lambda x: np.add.reduceat(x, t.starts[:-1]) if len(y) else np.zeros(0)
            is_hot = (hot >= 0) & vocab.summed[hot]
            log = np.where(is_hot, log_hot[hot], 0.0)
            # what the rest's counts add comes from their buckets, and is taken from those that are single
            inside = np.where(y < END, log - within[y], np.where(is_hot, 0.0, -log_hot[hot]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "held_out", "_k")), pa.array(np.diff(t.starts)), pa.array(sums(own / shift + inside)), pa.array(sums(log)), pa.array(sums((is_hot & known[hot]).astype(np.int64))), pa.array(sums((~is_hot).astype(np.int64)))],
                names=["doc_id", "held_out", "_k", "n_tokens", "own_score", "log_hot", "known_hot", "n_rest"],
            )

    return work


def score_texts(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are lower-cased words and one end; null and empty texts are the end alone. Counts are over all training rows;
    held-out rows (by the hash of doc_id) add nothing to counts or training; rows with a null doc_id are training rows.
    Repeated rows count as often as they stand and get equal scores. An unseen token has count 0. Columns other than
    doc_id and text are ignored; an empty table gives an empty result.
    """
    texts = _named(docs)
    n_buckets = buckets_for(text_bytes(docs) / TOKEN_BYTES, PER_BUCKET)
    hot = hot_tokens(texts)
    sent = texts.select("text", "held_out", "_k").mapInArrow(_send(n_buckets, hot), "bucket int, payload binary")
    counted = keep(sent.groupBy("bucket").applyInArrow(_count(n_buckets, hot), _COUNTED), "counted")
    vocab = vocabulary(counted, hot)
    parts = counted.where("kind = 0").groupBy("bucket").applyInArrow(_collect_parts, "_k long, log_rest double, known_rest long, n_entries long")
    model = train(texts, vocab)
    rows = texts.select("doc_id", "held_out", "_k", "text").mapInArrow(_score(model, vocab), "doc_id long, held_out boolean, _k long, n_tokens long, own_score double, log_hot double, known_hot long, n_rest long")
    # rows that repeat share their parts
    rows = rows.join(parts, "_k", "left").withColumn("_times", F.greatest(F.coalesce(F.col("n_entries") / F.col("n_rest"), F.lit(1.0)), F.lit(1.0)))
    rest = F.coalesce(F.col("log_rest") / F.col("_times"), F.lit(0.0))
    base = F.col("log_hot") + rest - F.col("n_tokens") * F.lit(float(np.log10(vocab.n_tokens + vocab.n_types + 1.0)))
    known = F.col("known_hot") + F.coalesce(F.round(F.col("known_rest") / F.col("_times")).cast("long"), F.lit(0).cast("long"))
    return rows.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(vocab.n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("own_score") + rest).alias("score"))
