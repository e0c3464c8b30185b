"""Language identification by a convolutional network over bytes, trained in numpy on labelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices, smallest

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 12
#: Bounds of the training sample: documents (smallest hash of doc_id), as many of each language, and windows of each, evenly spaced.
MOST_DOCS, MOST_WINDOWS = 6_000, 3
EPOCHS, BATCH, RATE = 6, 128, 0.01
FOLDS, HELD = 5, 0
#: Codes of bytes: 0 what is no letter, 1-26 ASCII letters without case, 27-154 bytes over 127.
CODES = 155
_CODE = np.zeros(256, np.uint8)
_CODE[65:91] = _CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all bytes of all texts in windows of fixed length, the last of each text filled up with 0, and each window's text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _CODE[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]]
    lengths = np.diff(starts)
    count = -(-lengths // WINDOW)
    rows = np.repeat(np.arange(len(lengths)), count)
    out = np.zeros(int(count.sum()) * WINDOW, np.uint8)
    shift = (np.cumsum(count) - count) * WINDOW - (starts[:-1] - starts[0])
    out[np.arange(len(data)) + np.repeat(shift, lengths)] = data
    return out.reshape(-1, WINDOW), rows


def _max_over_window(x: np.ndarray) -> np.ndarray:
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        y = np.maximum(x[:, :half], x[:, half : 2 * half])
        x = np.concatenate([y, x[:, 2 * half :]], axis=1) if x.shape[1] % 2 else y
    return x[:, 0]


class Network:
    """Filters of several widths over byte codes, their maxima over the window, and a softmax over languages."""

    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.3, (w, CODES, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self.tables: list[list[np.ndarray]] = []

    def ready(self) -> Network:
        """Join the tables of neighbouring positions, so that two bytes are one lookup."""
        self.tables = []
        for f in self.filters:
            pairs = [(f[i][:, None, :] + f[i + 1][None, :, :]).reshape(-1, FILTERS) for i in range(0, len(f) - 1, 2)]
            self.tables.append(pairs + ([f[-1]] if len(f) % 2 else []))
        return self

    def responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Filter responses at every position, for each width: (windows, positions, filters)."""
        pair = x[:, :-1].astype(np.int32) * CODES + x[:, 1:]
        for width, tables in zip(WIDTHS, self.tables):
            n = WINDOW - width + 1
            total = None
            for j, table in enumerate(tables):
                at = pair[:, 2 * j : 2 * j + n] if 2 * j + 1 < width else x[:, 2 * j : 2 * j + n]
                part = table.take(at, axis=0)
                total = part if total is None else np.add(total, part, out=total)
            yield total

    def pooled(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(np.concatenate([_max_over_window(r) for r in self.responses(x)], axis=1), 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [self.pooled(x[i : i + 1024]) for i in range(0, len(x), 1024)]
        z = (np.concatenate(parts) if parts else np.zeros((0, len(self.out)), np.float32)) @ self.out + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True, initial=-1e9))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 6) -> Network:
        """Adam on the cross-entropy, languages weighted alike."""
        rng = np.random.default_rng(seed)
        share = np.bincount(y, minlength=len(self.languages))
        weight = (len(y) / np.maximum(share, 1) / len(self.languages))[y].astype(np.float32)
        params = [*self.filters, self.out, self.bias]
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(max(EPOCHS, -(-EPOCHS * 3000 // max(len(x), 1))) if len(x) < 3000 else EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                at = order[i : i + BATCH]
                grads = self._gradients(x[at], y[at], weight[at])
                t += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        return self.ready()

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        self.ready()
        tops, values = [], []
        for r in self.responses(x):
            top = r.argmax(axis=1)
            tops.append(top)
            values.append(np.take_along_axis(r, top[:, None, :], axis=1)[:, 0])
        raw = np.concatenate(values, axis=1)
        hidden = np.maximum(raw, 0)
        z = hidden @ self.out + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= (weight / len(y))[:, None]
        back = (p @ self.out.T) * (raw > 0)
        grads, lanes, rows = [], np.arange(FILTERS), np.arange(len(x))[:, None]
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            out = np.empty((width, CODES, FILTERS), np.float32)
            for j in range(width):
                code = x[rows, tops[k] + j].astype(np.int64)
                out[j] = np.bincount((code * FILTERS + lanes).ravel(), g.ravel(), CODES * FILTERS).reshape(CODES, FILTERS)
            grads.append(out)
        return [*grads, hidden.T @ p, p.sum(axis=0)]


def learn(docs: DataFrame, folds: int = FOLDS, held: int = HELD) -> Network | None:
    """A network from windows of training documents with a language; None if there are none."""
    train = docs.where(~held_out(F.col("doc_id"), folds, held) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = train.where("doc_id is not null").select("doc_id", "lang").distinct()
    sizes = {r.lang: r.n for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    # languages that have less than their part leave it to the others
    part, left, open_ = {}, MOST_DOCS, sorted(sizes, key=lambda v: (sizes[v], v))
    for i, v in enumerate(open_):
        part[v] = min(sizes[v], max(left // (len(open_) - i), 1))
        left -= part[v]
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    bound = F.create_map(*[F.lit(x) for v in open_ for x in (v, int(part[v] / sizes[v] * (1 << 40)))])
    ids = smallest(named.where(place < bound[F.col("lang")]).select("doc_id").distinct(), MOST_DOCS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, rows = windows(batch.column("text"))
            first = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            for i in range(batch.num_rows):
                own = x[first[i] : first[i + 1]]
                own = own[np.unique(np.linspace(0, max(len(own) - 1, 0), MOST_WINDOWS).astype(int))] if len(own) else own
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), batch.column("lang").slice(i, 1), pa.array([own.tobytes()], pa.binary())], names=["doc_id", "lang", "x"])

    rows = train.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(cut, "doc_id long, lang string, x binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["doc_id", "lang"], kind="stable")
    languages = sorted(rows["lang"].unique())
    parts = [np.frombuffer(b, np.uint8).reshape(-1, WINDOW) for b in rows["x"]]
    x = np.concatenate(parts)
    y = np.repeat([languages.index(v) for v in rows["lang"]], [len(p) for p in parts])
    lettered = (x > 0).sum(axis=1) >= 16
    return Network(languages).train(x[lettered], y[lettered]) if lettered.any() else None


def identify(docs: DataFrame, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    The network reads every window of the text; the windows' probabilities are averaged by their numbers of letters. A
    null text, one without a letter, and every text if no training row has a language get und and score 0. Rows with null
    or repeated doc_id are predicted one by one; extra columns are ignored; an empty table gives an empty result.
    """
    network = learn(docs, folds, held)
    if network is not None:
        network.tables = []

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network and network.ready()
        for batch in slices(batches):
            n = batch.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if net is not None:
                x, rows = windows(batch.column("text"))
                p = net.probabilities(x) * ((x > 0).sum(axis=1) + 1e-6)[:, None]
                total = np.stack([np.bincount(rows, p[:, j], n) for j in range(p.shape[1])], axis=1).astype(np.float64)
                total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
                best, score = total.argmax(axis=1), total.max(axis=1)
            said = [net.languages[i] for i in best] if net is not None else ["und"] * n
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lettered"), pa.array(said, pa.string()), pa.array(np.clip(score, 0, 1))], names=["doc_id", "lettered", "said", "s"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    rows = rows.mapInArrow(predict, "doc_id long, lettered boolean, said string, s double")
    return rows.select(
        "doc_id", held_out(F.col("doc_id"), folds, held).alias("held_out"), F.when(F.col("lettered"), F.col("said")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("s")).otherwise(0.0).alias("score"),
    )
