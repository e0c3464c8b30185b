"""Substring deduplication by content-defined chunks: cuts follow a gear rolling hash, equal chunks are found by digest.

Where a cut falls depends on the sixteen bytes before it and on the cut before, never on offsets, so an insertion moves
only the cuts next to it. Chunks travel as packed arrays by bucket of their digest; of each digest a batch sends its first
occurrence only, since what follows it in the batch is known to repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, by_bucket, free_name, keep, mix, slices, text_bytes

#: Bytes that the rolling hash sees; a cut is never nearer to the start of a text.
SEEN = 16
#: One of 4 blanks, and one of 2,048 other places between characters, ends a chunk.
BLANK_BITS, OTHER_BITS = 2, 11
#: A cut nearer than LEAST to the one before is dropped; after MOST bytes without a cut there is one.
LEAST, MOST = 12, 1024
#: Repeated chunks in a row are removed if they have so many bytes together.
LEAST_RUN = 120
MEAN_CHUNK, PER_BUCKET = 30, 700_000
_NONE = np.iinfo(np.int64).max
_GEAR = np.random.default_rng(20240101).integers(0, 1 << 16, 256).astype(np.uint16)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All chunk boundaries in concatenated UTF-8 texts, the texts' own starts and ends among them."""
    n = len(data)
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        if n > step:
            h[step:] += h[:-step].copy() << np.uint16(step)
    fine = _BLANK[data] & (h >> np.uint16(16 - BLANK_BITS) == 0)
    fine |= h >> np.uint16(16 - OTHER_BITS) == 0
    at = np.flatnonzero(fine) + 1
    at = at[at < n]
    at = at[(data[at] & 0xC0) != 0x80]
    text = np.searchsorted(starts, at, side="right") - 1
    at = at[at - starts[text] >= SEEN]
    # the gap rule looks at the candidate before, kept or not, so that it stays local
    all_at = np.union1d(starts, at)
    inner = ~np.isin(all_at, starts)
    near = np.zeros(len(all_at), bool)
    near[1:] = np.diff(all_at) < LEAST
    all_at = all_at[~(inner & near)]
    gap = np.diff(all_at)
    long_ = np.flatnonzero(gap > MOST)
    if len(long_):
        extra = (gap[long_] - 1) // MOST
        more = np.repeat(all_at[long_], extra) + MOST * (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
        for _ in range(3):
            more = np.where((data[np.minimum(more, n - 1)] & 0xC0) == 0x80, more + 1, more)
        all_at = np.union1d(all_at, more)
    return all_at


def chunk(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each chunk: its text, start and end in the text's bytes, and digest (two 64-bit halves)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
    starts = starts - starts[0]
    at = cuts(data, starts)
    a, b = at[:-1], at[1:]
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    halves = np.frombuffer(b"".join([digest(view[i:j]) for i, j in zip(a.tolist(), b.tolist())]), np.uint64).reshape(-1, 2)
    text = np.searchsorted(starts, a, side="right") - 1
    return text, a - starts[text], b - starts[text], halves


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join([np.int64(len(columns[0])).tobytes(), *(c.tobytes() for c in columns)])


def _unpack(view: memoryview, kinds: tuple) -> tuple[list[np.ndarray], memoryview]:
    n, view = int(np.frombuffer(view[:8], np.int64)[0]), view[8:]
    out = []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(view[:size], kind))
        view = view[size:]
    return out, view


_PLACE = (np.int64, np.int64, np.uint32, np.uint16)
_EARLIER = (*_PLACE, np.int64)
_CHUNK = (np.uint64, np.uint64, *_PLACE)


def _send(n_buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_h"))
            order = np.lexsort((marks, ids))
            once = np.ones(len(order), bool)  # rows that repeat both are one document, whose chunks don't repeat each other
            once[1:] = (ids[order[1:]] != ids[order[:-1]]) | (marks[order[1:]] != marks[order[:-1]])
            if not once.all():
                own = np.sort(order[once])
                batch, ids, marks = batch.take(pa.array(own)), ids[own], marks[own]
            text, start, end, halves = chunk(batch.column("text"))
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((marks, ids))] = np.arange(len(ids))
            order = np.lexsort((start, rank[text]))
            order = order[np.lexsort((halves[order, 1], halves[order, 0]))]
            hi, lo = halves[order, 0], halves[order, 1]
            place = [ids[text[order]], marks[text[order]], start[order].astype(np.uint32), (end - start)[order].astype(np.uint16)]
            again = np.zeros(len(order), bool)
            again[1:] = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
            bucket = np.where(again, mix((place[0] ^ place[1]).astype(np.uint64)), hi).astype(np.uint64) % np.uint64(n_buckets)
            lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(order)))) if len(order) else np.zeros(0, np.int64)
            place.append(place[0][lead])
            key = bucket.astype(np.int64) * 2 + again
            by, at = by_bucket(key, 2 * n_buckets)
            columns = [c[by] for c in (hi, lo, *place)]
            rows = []
            full = np.flatnonzero(np.diff(at[::2]))
            for b in full:
                s, m, e = at[2 * b], at[2 * b + 1], at[2 * b + 2]
                rows.append(_pack(*(c[s:m] for c in columns[:-1])) + _pack(*(c[m:e] for c in columns[2:])))
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(rows, pa.binary())], names=["bucket", "payload"])

    return work


def _find(n_buckets: int):
    def work(table: pa.Table) -> pa.Table:
        """Of the chunks of this bucket those that aren't the first of their digest, packed by text."""
        firsts, known = [], []
        for payload in table.column("payload"):
            part, rest = _unpack(memoryview(payload.as_buffer()), _CHUNK)
            firsts.append(part)
            known.append(_unpack(rest, _EARLIER)[0])
        hi, lo, *place = (np.concatenate(c) for c in zip(*firsts))
        order = np.argsort(hi, kind="stable")
        run = hi[order]
        same = np.zeros(len(run), bool)
        same[1:] = run[1:] == run[:-1]
        some = same.copy()
        some[:-1] |= same[1:]
        order = order[some]
        order = order[np.lexsort((place[2][order], place[1][order], place[0][order], lo[order], hi[order]))]
        again = np.zeros(len(order), bool)
        h, low, where = hi[order], lo[order], [c[order] for c in place]
        again[1:] = (h[1:] == h[:-1]) & (low[1:] == low[:-1])
        itself = np.zeros(len(order), bool)  # the same place in a row that is repeated
        itself[1:] = again[1:] & (where[0][1:] == where[0][:-1]) & (where[1][1:] == where[1][:-1]) & (where[2][1:] == where[2][:-1])
        lead = np.maximum.accumulate(np.where(~again, np.arange(len(order)), 0)) if len(order) else np.zeros(0, np.int64)
        first_id = where[0][lead]
        at_first = (first_id == where[0]) & (where[1][lead] == where[1]) & (where[2][lead] == where[2])
        out = again & ~at_first & ~itself
        columns = [np.concatenate([c[out], *(k[j] for k in known)]) for j, c in enumerate(where)]
        columns.append(np.concatenate([first_id[out], *(k[4] for k in known)]))
        bucket = (mix((columns[0] ^ columns[1]).astype(np.uint64)) >> np.uint64(20)).astype(np.int64) % n_buckets
        by, at = by_bucket(bucket, n_buckets)
        full = np.flatnonzero(np.diff(at))
        return pa.table({"bucket": pa.array(full.astype(np.int32)), "payload": pa.array([_pack(*(c[by][at[b] : at[b + 1]] for c in columns)) for b in full], pa.binary())})

    return work


_SPANS = "_id long, _h long, spans array<struct<start:int,end:int>>, sources array<long>"


def _spans(table: pa.Table) -> pa.Table:
    """Runs of repeated chunks of each text that are long enough; sources: documents where such chunks stand earlier."""
    ids, marks, start, length, first = (np.concatenate(c) for c in zip(*(_unpack(memoryview(p.as_buffer()), _EARLIER)[0] for p in table.column("payload"))))
    order = np.lexsort((start, marks, ids))
    ids, marks, start, first = ids[order], marks[order], start[order].astype(np.int64), first[order]
    end = start + length[order]
    text = np.ones(len(ids), bool)
    text[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    run = text.copy()
    run[1:] |= start[1:] > end[:-1]
    head = np.flatnonzero(run)
    tail = np.append(head[1:], len(ids)) - 1
    fine = end[tail] - start[head] >= LEAST_RUN
    part = np.cumsum(run) - 1
    owner = np.cumsum(text) - 1
    out: dict[int, tuple[list, set]] = {}
    for h, t in zip(head[fine], tail[fine]):
        out.setdefault(int(owner[h]), ([], set()))[0].append({"start": int(start[h]), "end": int(end[t])})
    for i in np.flatnonzero(fine[part] & (first != _NONE)) if len(part) else []:
        out[int(owner[i])][1].add(int(first[i]))
    lead = np.flatnonzero(text)
    rows = list(out)
    return pa.table(
        {
            "_id": pa.array(ids[lead[rows]] if rows else [], pa.int64()), "_h": pa.array(marks[lead[rows]] if rows else [], pa.int64()),
            "spans": pa.array([out[r][0] for r in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "sources": pa.array([sorted(out[r][1]) for r in rows], pa.list_(pa.int64())),
        }
    )


def dedupe(docs: DataFrame, spans: str = "spans", sources: str = "sources") -> DataFrame:
    """docs with ``text`` cut, and spans (array of start and end in UTF-8 bytes) and sources (doc_ids) added.

    A passage that stands in several places stays where (doc_id, offset) is smallest and is cut elsewhere, also within one
    text, as far as whole chunks cover it and a run of them has LEAST_RUN bytes. sources names documents in which the
    cut chunks stand earlier: the first one, or the first of a batch. Texts without a cut are unchanged and have null spans;
    null and empty texts stay as they are. A null doc_id counts as the largest. Rows that repeat doc_id and text are one
    document. Columns that have the names of spans or sources are replaced; an empty table stays empty.
    """
    docs = docs.select([c for c in docs.columns if c.lower() not in (spans.lower(), sources.lower())])
    own, mark, cuts_ = (free_name(docs.columns, c) for c in ("_id", "_h", "_cuts"))
    n_buckets = buckets_for(text_bytes(docs) / MEAN_CHUNK, PER_BUCKET)
    # doc_id, null as the largest, and a hash of the text: together they name a text
    texts = docs.withColumns({own: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)), mark: F.xxhash64("text")})
    sent = texts.select(F.col(own).alias("_id"), F.col(mark).alias("_h"), "text").mapInArrow(_send(n_buckets), "bucket int, payload binary")
    found = sent.groupBy("bucket").applyInArrow(_find(n_buckets), "bucket int, payload binary")
    runs = keep(found.groupBy("bucket").applyInArrow(_spans, _SPANS), "spans")
    runs = runs.select(F.col("_id").alias(own), F.col("_h").alias(mark), F.col("spans").alias(cuts_), F.col("sources").alias(sources))
    rows = texts.join(runs, [own, mark], "left")
    edges = f"concat(array(0), flatten(transform({cuts_}, s -> array(s.start, s.end))), array(octet_length(text)))"
    kept = f"transform(sequence(0, size({cuts_})), i -> decode(substring(cast(text as binary), ({edges})[2 * i] + 1, ({edges})[2 * i + 1] - ({edges})[2 * i]), 'utf-8'))"
    cut = F.when(F.col(cuts_).isNull(), F.col("text")).otherwise(F.expr(f"array_join({kept}, '')"))
    return rows.select(*[cut.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], F.col(cuts_).alias(spans), sources)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut and n_chars, if there, counted anew; rows of which only blanks are left go.

    Rows without a cut stay as they are, null and blank texts too. All columns come back, whatever their names.
    """
    spans = free_name(docs.columns, "_spans")
    out = dedupe(docs, spans, free_name(docs.columns, "_sources")).where(F.col(spans).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select([F.col(f"`{c}`") for c in docs.columns])
