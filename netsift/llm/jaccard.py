"""Exact self-join of shingle sets at Jaccard similarity 0.75: partitions of the universe and the pigeonhole principle.

Two sets a <= b with J >= 0.75 differ in at most (a + b) / 7 elements. Sizes fall into bands; a pair is looked for under
the band of its larger set, so each set is indexed under its own band and the next one. A band hashes shingles into m
segments, and by the pigeonhole principle a pair that differs in at most H elements agrees on some segment as follows.

A segment that a set indexes with its exact subset buys one unit, one indexed with the subset and all its one-deletion
neighbours buys two; units over H guarantee that a pair meets. Cost decides: one unit costs a key, two units cost one key
more than the segment has elements. An empty segment buys nothing, since all sets share it. So a set pays with exact keys
where its segments suffice (level 0), else with deletion neighbours of all segments (level 1), and, if even these do not
suffice, with the empty ones too (level 2). Of a pair, the set of the lower level has units over H, and the other one has
indexed all keys that this needs; so every pair meets, whatever the data. Pairs that meet are verified exactly.

A key that many sets have (a line that stands everywhere, a large family of near copies) costs most and tells least, so
keys of more than FEW owners buy nothing: the number of candidates grows with the keys. A set that still has units over H
has met all its partners of its level or a higher one. What it can spare says nothing on partners of a lower level, since
these index fewer keys; where there may be such, one lost key makes it tight, but for the keys of empty segments, which a
lower level hasn't: a pair of unequal levels shares a key that the lower one indexes, and if no such key was met, it was
lost to both.

Tight sets, those that lost more than they could spare, buy again in the finest partition, where each shingle is a segment
of its own: a set of n shingles has n units, so it meets all its partners unless over two thirds of its shingles are hot.
That leaves families of near copies and texts that are mostly one common passage. These first try the hub of a few shared
shingles; what links they give are components, and a hot key whose owners are all of one component is done with. Owners
of the others are compared exactly, in blocks: members without a large component with all, whole components with each
other only where they share a key.

Keys travel as packed arrays, one row for a batch and bucket, and are matched by sorting within a bucket. Sets are
identified by digest, so that copies are one entry however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, buckets_for, by_bucket, forget, keep, mix, release, shingles, slices
from .components import components

WIDTH = 5
#: Similarity 3/4 in integers: 4 * common >= 3 * union.
NUM, DEN = 3, 4
#: Keys in a bucket, about.
PER_BUCKET = 2_000_000
#: Owners of a key up to which all their pairs are candidates; a key that more have buys nothing.
FEW = 8
#: A profile counts the shingles in so many parts of the universe that a part has 2 to 4 of them.
PART_SHINGLES = 2
#: Smallest shingles by which a set of a family looks for hubs.
LEADERS = 4
#: Members of a block, and their shingles together, about; columns of a comparison of two blocks.
BLOCK, BLOCK_SHINGLES, COLUMNS = 256, 1 << 16, 4096
#: Rows of two numbers that are broadcast at most.
MOST_SENT = 1_000_000
#: The bit of a key that tells keys of empty segments, and the bit in spare keys that tells sets that may have partners of a lower level.
_EMPTY, _STRICT = np.uint64(1), 1 << 15


def bands(largest: int) -> np.ndarray:
    """The least size of each band; a band's sizes are within a factor of 3/4, so a pair spans two bands at most."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-out[-1] * DEN // NUM)))
    return np.array(out, np.int64)


def most_apart(a: int, b: int) -> int:
    """Elements in which sets of sizes a and b can differ and still be similar."""
    return (DEN - NUM) * (a + b) // (DEN + NUM)


class Scheme:
    """Segments and the kind of keys for pairs whose larger set is in band k."""

    def __init__(self, edges: np.ndarray, k: int):
        low, high = int(edges[k]), int(edges[k + 1]) - 1
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(b"band %d" % low))
        self.salt = np.uint64(xxhash.xxh3_64_intdigest(b"cell %d" % low))
        self.most, self.apart = high, most_apart(high, high)
        self.least = max(1, -(-low * NUM // DEN))
        mid = (low + high) / 2
        # Level 0 needs apart + 1 segments that are not empty; of m segments hashed by mid elements m * (1 - exp(-mid / m)) are.
        self.segments, self.deletions = 1, self.apart <= 1
        if self.apart > 1:
            m = self.apart + 1
            while m * (1 - np.exp(-mid / m)) < self.apart + 1 + 1.5 * np.sqrt(m * np.exp(-mid / m)):
                m += max(1, m // 50)
                if m > 4 * mid:
                    break
            exact, deletions = min(m, mid), (self.apart + 1) / 2 + mid
            self.deletions = m > 4 * mid or deletions < exact
            self.segments = -(-(self.apart + 1) // 2) if self.deletions else m


def keys(tokens: np.ndarray, rows: np.ndarray, sizes: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the sets given by (row, token), the row of each key, and for each row how many of its keys it can spare,
    and whether partners may be of a lower level.

    sizes: of each row, 0 for rows without tokens here. The last bit of a key tells those of empty segments.
    """
    m = scheme.segments
    n = len(sizes)
    hashed = mix(tokens ^ scheme.seed)
    segment = (hashed >> np.uint64(33)).astype(np.int64) % m
    cell = rows * m + segment
    order = np.argsort(cell)
    cell, value = cell[order], mix(hashed[order] * np.uint64(0x9E3779B97F4A7C15))
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    cells = cell[first]
    total = np.add.reduceat(value, first) if len(first) else np.zeros(0, np.uint64)
    count = np.diff(np.append(first, len(cell)))
    owner = cells // m
    salt = mix((cells % m).astype(np.uint64) ^ scheme.salt)
    present = sizes > 0
    filled = np.bincount(owner, minlength=n)
    single = np.bincount(owner, count == 1, n).astype(np.int64)
    needed = (DEN - NUM) * (sizes + np.minimum(scheme.most, sizes * DEN // NUM)) // (DEN + NUM) + 1
    level = np.where(filled >= needed, 0, np.where(2 * filled - single >= needed, 1, 2))
    if scheme.deletions:
        level = np.maximum(level, 1)
    units = np.where(level == 0, filled, np.where(level == 1, 2 * filled - single, 2 * m))
    spare = (units - needed) // np.where(level == 0, 1, 2)
    out_keys, out_rows = [mix(total ^ salt) & ~_EMPTY], [owner]
    if (level > 0).any():
        each = np.repeat(np.arange(len(first)), count)
        chosen = (level[owner[each]] == 2) | ((level[owner[each]] == 1) & (count[each] > 1))
        each = each[chosen]
        out_keys.append(mix((total[each] - value[chosen]) ^ salt[each]) & ~_EMPTY | (count[each] == 1))
        out_rows.append(owner[each])
        low = np.flatnonzero((level == 2) & present)
        if len(low):
            missing = np.setdiff1d((low[:, None] * m + np.arange(m)).ravel(), cells)
            out_keys.append(mix(mix((missing % m).astype(np.uint64) ^ scheme.salt)) | _EMPTY)
            out_rows.append(missing // m)
    return np.concatenate(out_keys), np.concatenate(out_rows), spare, level > int(scheme.deletions)


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, starts, and two halves of the digest of each set."""
    tokens, starts = shingles(Words(texts), WIDTH)
    raw = tokens.view(np.uint8)
    halves = [xxhash.xxh3_128_intdigest(raw[8 * a : 8 * b]) for a, b in zip(starts, starts[1:])]
    high = np.array([h >> 65 << 1 for h in halves], np.uint64).view(np.int64)  # the last bit is left free for _pack
    low = np.array([h & 0xFFFFFFFFFFFFFFFF for h in halves], np.uint64).view(np.int64)
    return tokens, starts, high, low


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the digest of the shingle set as d1, d2, and its profile."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tokens, starts, high, low = _sets(batch.column("text"))
            profiles = [profile(tokens[a:b]) for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(starts)), pa.array(high), pa.array(low), pa.array(profiles, pa.binary())], names=["doc_id", "n_shingles", "d1", "d2", "profile"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, n_shingles long, d1 long, d2 long, profile binary")


def profile(tokens: np.ndarray) -> bytes:
    """Counts of a set's shingles by their leading bits, one byte each; empty (no statement) if a count has no room."""
    bits = max(int(len(tokens) // PART_SHINGLES).bit_length() - 1, 0)
    counts = np.bincount((tokens >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def least_apart(p: bytes, q: bytes) -> int:
    """Elements in which the sets of two profiles differ at least; the finer profile is summed to the other's parts."""
    if not p or not q:
        return 0
    p, q = np.frombuffer(p, np.uint8).astype(np.int64), np.frombuffer(q, np.uint8).astype(np.int64)
    n = min(len(p), len(q))
    return int(np.abs(p.reshape(n, -1).sum(axis=1) - q.reshape(n, -1).sum(axis=1)).sum())


def _pack(key: np.ndarray, owner: np.ndarray, name: np.ndarray, spare: np.ndarray, strict: np.ndarray) -> bytes:
    """Keys of one bucket, ordered by owner: 40 bits of each, and each owner's name and spare keys once, with its number of keys.

    The spare keys of owners that may have partners of a lower level have the bit _STRICT.
    """
    at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    count = np.diff(np.append(at, len(owner))).astype(np.uint32)
    head = np.array([len(key), len(at)], np.int64)
    low, high = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((key >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)
    free = np.minimum(spare[owner[at]], _STRICT - 1).astype(np.uint16) | np.where(strict[owner[at]], _STRICT, 0).astype(np.uint16)
    return b"".join([head.tobytes(), low.tobytes(), high.tobytes(), name[owner[at]].tobytes(), count.tobytes(), free.tobytes()])


def _unpack(payload: pa.Scalar) -> tuple[np.ndarray, ...]:
    """Keys, the owner of each, and the owners with what they can spare."""
    view = memoryview(payload.as_buffer())
    n, m = np.frombuffer(view[:16], np.int64).tolist()
    take = lambda kind, a, k: np.frombuffer(view[a : a + k * np.dtype(kind).itemsize], kind)
    key = take(np.uint32, 16, n).astype(np.uint64) | take(np.uint8, 16 + 4 * n, n).astype(np.uint64) << np.uint64(32)
    at = 16 + 5 * n
    name, count, spare = take(np.int64, at, m), take(np.uint32, at + 8 * m, m), take(np.uint16, at + 12 * m, m)
    return key, np.repeat(name, count), name, spare


def index(docs: DataFrame, largest: int, n_buckets: int) -> DataFrame:
    """bucket, payload: the keys of all sets and the first digest half of each key's set, packed by bucket."""
    edges = bands(largest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes: dict[int, Scheme] = {}
        for batch in slices(batches):
            tokens, starts, high, _ = _sets(batch.column("text"))
            sizes = np.diff(starts)
            _, first = np.unique(high, return_index=True)  # copies within a batch are one set already here
            once = np.zeros(len(sizes), bool)
            once[first] = True
            once &= sizes > 0
            band = np.searchsorted(edges, sizes, side="right") - 1
            row = np.repeat(np.arange(len(sizes)), sizes)
            all_keys, all_rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            spare, strict = np.zeros(2 * len(sizes), np.int64), np.zeros(2 * len(sizes), bool)
            for k in np.unique(np.concatenate([band[once], band[once] + 1])):
                scheme = schemes.setdefault(int(k), Scheme(bands_to(edges, k), int(k)))
                mine = once & ((band == k) | ((band == k - 1) & (sizes >= scheme.least)))
                held = mine[row]
                got, owner, free, lower = keys(tokens[held], row[held], np.where(mine, sizes, 0), scheme)
                upper = (band < k).astype(np.int64)  # a set is one owner under its own band, another one under the next
                all_keys.append(got)
                all_rows.append(2 * owner + upper[owner])
                spare[2 * np.flatnonzero(mine) + upper[mine]] = free[mine]
                strict[2 * np.flatnonzero(mine) + upper[mine]] = lower[mine]
            key, owner = np.concatenate(all_keys), np.concatenate(all_rows)
            name = np.stack([high, high | 1], axis=1).ravel()
            order = np.argsort(owner.astype(np.uint32), kind="stable")
            key, owner = key[order], owner[order]
            order, at = by_bucket((key >> np.uint64(44)).astype(np.int64) % n_buckets, n_buckets)
            key, owner = key[order], owner[order]
            full = np.flatnonzero(np.diff(at))
            payload = [_pack(key[at[b] : at[b + 1]], owner[at[b] : at[b + 1]], name, spare, strict) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(payload, pa.binary())], names=["bucket", "payload"])

    return docs.select("text").mapInArrow(work, "bucket int, payload binary")


def bands_to(edges: np.ndarray, k: int) -> np.ndarray:
    """edges with at least one band after k."""
    while len(edges) < k + 2:
        edges = np.append(edges, max(edges[-1] + 1, -(-edges[-1] * DEN // NUM)))
    return edges


def _runs(tables: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of owners that share a key, each owner once: number of the run, owner, and whether the key is of an empty
    segment; and all owners with what they can spare."""
    key, who, name, spare = (np.concatenate(c) for c in zip(*map(_unpack, tables.column("payload"))))
    order = np.argsort(key)
    key, who = key[order], who[order]
    run = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    shared = np.bincount(run)[run] > 1
    run, who, empty = run[shared], who[shared], (key[shared] & _EMPTY).astype(bool)
    order = np.lexsort((who, run))
    run, who, empty = run[order], who[order], empty[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (who[1:] != who[:-1])
    run, who, empty = run[new], who[new], empty[new]
    many = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    return run[many], who[many], empty[many], name, spare


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


_MET = "x long, y long, spare int"


def _meet_few(tables: pa.Table) -> pa.Table:
    """Pairs x, y of sets that share a key which at most FEW owners have; and with spare not null, for each owner x its
    number y of keys that more have, and how many it can spare. Where partners may be of a lower level, a key counts as
    more than can be spared, unless it is of an empty segment."""
    run, who, empty, name, spare = _runs(tables)
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(run)))
    x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in range(2, FEW + 1):
        block = who[first[size == n][:, None] + np.arange(n)] & ~1
        for i in range(n):
            for j in range(i + 1, n):
                x.append(np.minimum(block[:, i], block[:, j]))
                y.append(np.maximum(block[:, i], block[:, j]))
    pairs = np.stack([np.concatenate(x), np.concatenate(y)], axis=1)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    pairs = pairs[new]
    lost = np.repeat(size > FEW, size)
    hot, part = np.unique(who[lost], return_inverse=True)
    own, at = np.unique(name, return_index=True)
    free = spare[at][np.searchsorted(own, hot)].astype(np.int32)
    count = np.bincount(part, np.where((free[part] >= _STRICT) & ~empty[lost], _STRICT, 1), len(hot)).astype(np.int64)
    free %= _STRICT
    return pa.table({"x": np.concatenate([pairs[:, 0], hot]), "y": np.concatenate([pairs[:, 1], count]), "spare": pa.array([*[None] * len(pairs), *free.tolist()], pa.int32())})


def finest(held: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, payload: every shingle of the sets of held (d1, tokens) as a key, as index() packs them.

    Of n shingles a similar set lacks at most what most_apart says, so one of any more than that is shared.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column("d1").to_numpy()
            each = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("tokens")]
            if not each:
                continue
            sizes = np.array([len(x) for x in each])
            key, owner = mix(np.concatenate(each)) & ~_EMPTY, np.repeat(np.arange(len(each)), sizes)
            spare = sizes - most_apart(sizes, sizes * DEN // NUM) - 1
            order, at = by_bucket((key >> np.uint64(44)).astype(np.int64) % n_buckets, n_buckets)
            key, owner = key[order], owner[order]
            full = np.flatnonzero(np.diff(at))
            payload = [_pack(key[at[b] : at[b + 1]], owner[at[b] : at[b + 1]], name, spare, np.zeros(len(each), bool)) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(payload, pa.binary())], names=["bucket", "payload"])

    return held.select("d1", "tokens").mapInArrow(work, "bucket int, payload binary")


def _tight(met: DataFrame) -> DataFrame:
    """x, hot: the owners that lost more keys than they could spare."""
    lost = met.where("spare is not null").groupBy("x").agg(F.sum("y").alias("hot"), F.min("spare").alias("spare"))
    return lost.where("hot > spare").select("x", "hot")


def tokens_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """d1, tokens: the shingles of the sets asked for (d1, rep, a kept table), read from the document rep.

    Up to MOST_SENT of them go to where the texts are; more are joined, which shuffles the texts once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            value, starts, high, _ = _sets(batch.column("text"))
            own = np.flatnonzero(high == batch.column("d1").to_numpy())  # another text may have the same doc_id
            own = own[np.unique(high[own], return_index=True)[1]]
            raw = pa.array([value[starts[i] : starts[i + 1]].tobytes() for i in own.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(high[own]), raw], names=["d1", "tokens"])

    n, wanted = asked.count(), asked.select("rep", "d1")
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(F.broadcast(wanted) if n <= MOST_SENT else wanted, "rep").select("text", "d1")
    out = keep(rows.mapInArrow(work, "d1 long, tokens binary"), "tokens")
    if out.count() > n:  # rows that repeat
        once = keep(out.dropDuplicates(["d1"]), "tokens")
        forget(out)
        return once
    return out


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y, a, b: the pairs (x, y: first digest halves) that sizes and profiles don't rule out, with their documents."""
    one = sets.select(F.col("d1").alias("x"), F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("profile").alias("pa"))
    two = sets.select(F.col("d1").alias("y"), F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("profile").alias("pb"))
    pairs = pairs.join(one, "x").join(two, "y").where(f"{DEN} * least(na, nb) >= {NUM} * greatest(na, nb) and a <> b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()).tolist()
            both = zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), sizes)
            fine = pa.array([least_apart(p, q) <= most_apart(n, 0) for p, q, n in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(fine) for c in ("x", "y", "a", "b")], names=["x", "y", "a", "b"])

    return pairs.select("x", "y", "a", "b", "na", "nb", "pa", "pb").mapInArrow(near, "x long, y long, a long, b long")


def similar(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """a, b of the pairs (x, y, a, b) whose shingles (held: d1, tokens), compared in full, are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = np.zeros(batch.num_rows, bool)
            for i, (s, t) in enumerate(zip(batch.column("tx"), batch.column("ty"))):
                s, t = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum())
                fine[i] = DEN * common >= NUM * (len(s) + len(t) - common)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(fine)) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    both = pairs.join(held.select(F.col("d1").alias("x"), F.col("tokens").alias("tx")), "x").join(held.select(F.col("d1").alias("y"), F.col("tokens").alias("ty")), "y")
    return both.select("a", "b", "tx", "ty").mapInArrow(compare, "a long, b long")


def hubs(held: DataFrame, family: DataFrame) -> DataFrame:
    """d1, hub, hub_share for each set of family (d1, share) and each of its LEADERS smallest shingles: of the sets that have it among
    theirs the one with the largest share of hot shingles, which others are likely copies of."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [np.sort(mix(np.frombuffer(x.as_buffer(), np.uint64)))[:LEADERS] for x in batch.column("tokens")]
            count = np.array([len(x) for x in least], np.int64)
            columns = [pa.array(np.concatenate([np.zeros(0, np.uint64), *least]).view(np.int64)), *(pa.array(np.repeat(batch.column(c).to_numpy(), count)) for c in ("d1", "share"))]
            yield pa.RecordBatch.from_arrays(columns, names=["leader", "d1", "share"])

    rows = keep(held.join(family, "d1").select("d1", "share", "tokens").mapInArrow(work, "leader long, d1 long, share double"), "leaders")
    best = rows.groupBy("leader").agg(F.max_by("d1", F.struct("share", "d1")).alias("hub"), F.max("share").alias("hub_share"))
    return rows.join(best, "leader").select("d1", "hub", "hub_share")


def _parts(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, payload: key, block and label (-1 if mixed) of the least shingles of each block's members, as many of each
    that similar sets share one of them (the prefixes under one order of all shingles)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ms = batch.column("ms")
            each = [np.sort(mix(np.frombuffer(x.as_buffer(), np.uint64))) for x in ms.values.field("tokens").slice(ms.offsets[0].as_py(), ms.offsets[-1].as_py() - ms.offsets[0].as_py())]
            at = (ms.offsets.to_numpy() - ms.offsets[0].as_py()).tolist()
            prefix = [x[: len(x) + NUM * len(x) // -DEN + 1] for x in each]
            keys_, own = [], []
            for i, (s, e) in enumerate(zip(at, at[1:])):
                keys_.append(np.unique(np.concatenate(prefix[s:e])))
                own.append(np.full(len(keys_[-1]), i))
            if not keys_:
                continue
            key, own = np.concatenate(keys_), np.concatenate(own)
            order, cut = by_bucket((key >> np.uint64(44)).astype(np.int64) % n_buckets, n_buckets)
            key, own = key[order], own[order]
            block, label = batch.column("block").to_numpy()[own], batch.column("pure").to_numpy()[own]
            full = np.flatnonzero(np.diff(cut))
            payload = [b"".join(c[cut[b] : cut[b + 1]].tobytes() for c in (key, block, label)) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(payload, pa.binary())], names=["bucket", "payload"])

    return blocks.select("block", "pure", "ms").mapInArrow(work, "bucket int, payload binary")


def _open(table: pa.Table) -> pa.Table:
    """i, j: blocks that share a key of this bucket and may hold sets of different components."""
    views = [memoryview(p.as_buffer()) for p in table.column("payload")]
    sizes = [len(v) // 24 for v in views]
    key, block, label = (np.concatenate([np.frombuffer(v[8 * c * n : 8 * (c + 1) * n], kind) for v, n in zip(views, sizes)]) for c, kind in enumerate((np.uint64, np.int64, np.int64)))
    order = np.lexsort((block, key))
    key, block, label = key[order], block[order], label[order]
    names, block = np.unique(block, return_inverse=True)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).tolist()
    seen, codes = set(), np.zeros(0, np.int64)
    more: list[np.ndarray] = []
    for a, b in zip(first, [*first[1:], len(key)]):
        own, kind = block[a:b], label[a:b]
        if (own.tobytes()) in seen or (kind[0] >= 0 and (kind == kind[0]).all()):
            continue
        seen.add(own.tobytes())
        mixed, rest = own[kind < 0], kind >= 0
        pairs = [(np.repeat(mixed, len(own)), np.tile(own, len(mixed)))]
        for one in np.unique(kind[rest])[:-1]:
            here, above = own[kind == one], own[kind > one]
            pairs.append((np.repeat(here, len(above)), np.tile(above, len(here))))
        more += [np.minimum(i, j) * len(names) + np.maximum(i, j) for i, j in pairs]
        if sum(map(len, more)) > 1 << 20:
            codes, more = np.unique(np.concatenate([codes, *more])), []
    codes = np.unique(np.concatenate([codes, *more]))
    return pa.table({"i": names[codes // len(names)], "j": names[codes % len(names)]}) if len(names) else pa.table({"i": pa.array([], pa.int64()), "j": pa.array([], pa.int64())})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b: components of which two blocks hold similar sets, by their shared shingles counted in full."""

    def opened(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ms = cell.values
        each = [np.frombuffer(x.as_buffer(), np.uint64) for x in ms.field("tokens")]
        sizes = np.array([len(x) for x in each], np.int64)
        return ms.field("label").to_numpy(), sizes, np.concatenate(each), np.repeat(np.arange(len(each)), sizes)

    for batch in batches:
        out = [np.zeros((2, 0), np.int64)]
        for one, two in zip(batch.column("one"), batch.column("two")):
            (la, na, ta, ra), (lb, nb, tb, rb) = opened(one), opened(two)
            both = np.intersect1d(ta, tb)
            common = np.zeros((len(na), len(nb)), np.float32)
            places = []
            for t, r in ((ta, ra), (tb, rb)):
                at = np.minimum(np.searchsorted(both, t), max(len(both) - 1, 0))
                held = both[at] == t if len(both) else np.zeros(len(t), bool)
                order = np.argsort(at[held], kind="stable")
                places.append((at[held][order], r[held][order]))
            for c in range(0, len(both), COLUMNS):
                wide = []
                for (at, r), n in zip(places, (len(na), len(nb))):
                    s, e = np.searchsorted(at, [c, c + COLUMNS])
                    x = np.zeros((n, min(COLUMNS, len(both) - c)), np.float32)
                    x[r[s:e], at[s:e] - c] = 1
                    wide.append(x)
                common += wide[0] @ wide[1].T
            fine = (la[:, None] != lb) & (DEN * common >= NUM * (na[:, None] + nb - common))
            i, j = np.nonzero(fine)
            out.append(np.stack([np.minimum(la[i], lb[j]), np.maximum(la[i], lb[j])]))
        pairs = np.unique(np.concatenate(out, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _within_families(members: DataFrame, held: DataFrame) -> DataFrame:
    """a, b: links between components of members (d1, label, n_shingles, hub).

    A block holds members of one large component, or members of small ones that have their best hub in common.
    """
    whole = members.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= BLOCK).select("label", F.lit(True).alias("large"))
    rows = members.join(whole, "label", "left").withColumn("pure", F.when(F.col("large"), F.col("label")).otherwise(F.lit(-1)))
    rows = rows.withColumn("home", F.when(F.col("large"), F.col("label")).otherwise(F.col("hub")))
    parts = rows.groupBy("home", "pure").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts"))
    rows = rows.join(parts, ["home", "pure"]).select("d1", "label", "pure", F.xxhash64("home", "pure", F.pmod(F.xxhash64("d1"), "parts")).alias("block"))
    each = rows.join(held, "d1").groupBy("block", "pure").agg(F.collect_list(F.struct("label", "tokens")).alias("ms"))
    blocks = keep(each, "blocks")
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    n_buckets = buckets_for(total * (DEN - NUM) / DEN, PER_BUCKET, 12)
    met = keep(_parts(blocks, n_buckets).groupBy("bucket").applyInArrow(_open, "i long, j long").distinct(), "block-pairs")
    both = met.join(blocks.select(F.col("block").alias("i"), F.col("ms").alias("one")), "i").join(blocks.select(F.col("block").alias("j"), F.col("ms").alias("two")), "j")
    links = keep(both.select("one", "two").mapInArrow(_joined, "a long, b long").distinct(), "links")
    forget(blocks)
    forget(met)
    return links


def _relabel(found: DataFrame, links: DataFrame) -> DataFrame:
    """found (node, component) after its components are joined by links (a, b); components not in found are single nodes."""
    more = keep(components(links), "joined").withColumnsRenamed({"node": "_n", "component": "_c"})
    out = found.join(more, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    alone = more.join(found.select("node"), F.col("_n") == F.col("node"), "left_anti").select(F.col("_n").alias("node"), F.col("_c").alias("component"))
    return keep(out.unionByName(alone), "components")


def _linked(pairs: DataFrame, star: DataFrame | None, docs: DataFrame) -> DataFrame:
    """node, component from the pairs (x, y, a, b) that are similar.

    A forest comes first: each set with the least set that it may be similar to, and members of families with their hubs
    (star). Of the other pairs only those are compared whose sets it has not joined.
    """
    least = pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y")
    first = keep(pairs.join((least if star is None else least.unionByName(star)).distinct(), ["x", "y"], "left_semi"), "first-pairs")
    asked = pairs.select(F.col("x").alias("d1"), F.col("a").alias("rep")).unionByName(pairs.select(F.col("y").alias("d1"), F.col("b").alias("rep"))).distinct()
    held = tokens_of(docs, keep(asked, "asked"))
    found = keep(components(keep(similar(first, held), "links")), "components")
    of = lambda side: found.withColumnsRenamed({"node": side, "component": f"c{side}"})
    rest = pairs.join(first, ["x", "y"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left").select("x", "y", F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    links = keep(similar(rest, held).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    forget(held)
    forget(first)
    return found if links.isEmpty() else _relabel(found, links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id.

    Links join texts whose sets of distinct five-word shingles have Jaccard similarity 0.75 or more; component_id is the
    smallest doc_id that links reach. Texts with fewer than five words have their whole sequence as the one shingle; null,
    empty and blank texts have none and are linked with nothing: their component is their own doc_id. Copies are linked.
    Rows with a null doc_id keep a null component and link nothing; repeated rows give repeated rows. Columns other than
    doc_id and text are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    info = keep(describe(docs), "shingle-sets")
    known = info.where("n_shingles > 0 and doc_id is not null")
    sets = keep(known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("profile").alias("profile")), "distinct-sets")
    total = sets.agg(F.sum("n_shingles"), F.max("n_shingles")).first()
    if total[0] is None:
        return info.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    named = docs.where("doc_id is not null")
    met = keep(index(named, int(total[1]), buckets_for(0.8 * total[0], PER_BUCKET)).groupBy("bucket").applyInArrow(_meet_few, _MET), "met")
    release(spark)
    tight = keep(sets.join(_tight(met).select(F.col("x").bitwiseAND(F.lit(-2)).alias("d1")).distinct(), "d1", "left_semi").select("d1", "rep", "n_shingles"), "tight")
    few, hot, family, star, met_again = met.where("spare is null").select("x", "y"), None, None, None, None
    if not tight.isEmpty():
        hot = tokens_of(named, tight)
        again = tight.agg(F.sum("n_shingles")).first()[0]
        met_again = keep(finest(hot, buckets_for(again, PER_BUCKET, 12)).groupBy("bucket").applyInArrow(_meet_few, _MET), "met")
        few = few.unionByName(met_again.where("spare is null").select("x", "y"))
        family = keep(_tight(met_again).withColumnRenamed("x", "d1").join(tight, "d1").select("d1", "rep", "n_shingles", (F.col("hot") / F.col("n_shingles")).alias("share")), "families")
        if not family.isEmpty():
            hub = keep(hubs(hot, family.select("d1", "share")), "hubs")
            star = hub.where("d1 <> hub").select(F.least("d1", "hub").alias("x"), F.greatest("d1", "hub").alias("y"))
    pairs = keep(plausible((few if star is None else few.unionByName(star)).distinct(), sets), "pairs")
    found = None
    if not pairs.isEmpty():
        found = _linked(pairs, star, named)
    if star is not None:
        home = hub.groupBy("d1").agg(F.max_by("hub", F.struct("hub_share", "hub")).alias("hub"))
        label = F.coalesce("component", "rep") if found is not None else F.col("rep")
        rows = family.join(found, F.col("rep") == F.col("node"), "left") if found is not None else family
        links = _within_families(rows.select("d1", label.alias("label"), "n_shingles").join(home, "d1"), hot)
        if not links.isEmpty():
            found = _relabel(found, links) if found is not None else keep(components(links), "components")
    for done in (met, met_again, hot, pairs):
        forget(done)
    release(spark)
    sets = sets.join(found, F.col("rep") == F.col("node"), "left") if found is not None else sets.withColumn("component", F.col("rep"))
    several = sets.withColumn("_c", F.coalesce("component", "rep")).where("_c <> rep or last <> rep")
    named_sets = several.select(F.col("d1").alias("_1"), F.col("d2").alias("_2"), F.col("n_shingles").alias("_n"), "_c")
    same = (F.col("d1") == F.col("_1")) & (F.col("d2") == F.col("_2")) & (F.col("n_shingles") == F.col("_n"))
    rows = info.select("doc_id", "n_shingles", "d1", "d2").join(named_sets, same, "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without near duplicates: of each component the document of the smallest doc_id stays, with all its columns.

    Rows with a null doc_id stay; of repeated rows of one doc_id all stay.
    """
    gone = near_duplicates(docs).where("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
