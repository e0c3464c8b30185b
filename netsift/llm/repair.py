"""Repair of conversations: the cheapest edits that make the roles alternate, by a grammar-compressed shortest path.

Rows of a conversation are taken by turn (nulls first), ties by role, then by the SHA-256 of the text. Each row is a symbol: what its role begins
with (s, u, a or else) and whether it is sound, truncated, or has to go (blank, or a repeat of an earlier role and text). Four
states say what a sequence of roles may go on with; a symbol is a 4 x 4 matrix of (cost, edits) over them, and a sequence is
their product, which keeps the least cost and of equal ones the edits that come first as ASCII text. This is well defined piece
by piece: the edits fix the states they pass, so that none of two equally cheap edits between the same states begins the other.

The sequences are compressed by Re-Pair: rounds of a Spark job over the distinct sequences count neighbouring symbols, the most
frequent pairs become rules. Each rule has its matrix once, the product of its halves', with ropes as edits, for all conversations.

A conversation is cut into pieces of at most PIECE_ROWS rows or about PIECE_BYTES bytes, in ranges of (conv_id, turn, role)
that Spark deals out by a sample: one of any length goes over many tasks. Those within one piece are done where they lie. Of
others only symbols (a byte a row) are brought together, in order, as a stream; then edits go to their pieces, and the repaired
text of such a conversation passes through one task as a stream, as SHA-256 can't be split.

Nulls: a null conv_id is a conversation like others, a null turn comes first and counts in no gap; a null role or text is one
space. Empty texts are blank. Texts of any length are kept whole. Repeated rows are repeats, which go. A conversation without
rows has zeros, no edits and the hash of nothing. Empty tables give no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, forget, keep

SPACE = " \t\n\x0b\x0c\r"
#: Costs of the edits, and what a truncated row adds that isn't deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
PIECE_ROWS, PIECE_BYTES = 1024, 2_000_000
#: Rounds of Re-Pair, rules a round at most, and how often a pair has to stand in distinct sequences.
ROUNDS, RULES, OFTEN = 6, 48, 4
#: States: nothing yet, after a system row, after a user row, after an assistant row. The first and the last may end.
STATES, ENDS = 4, (0, 3)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
KINDS = "sua-"
#: Symbols: 0 has to go, 1 + kind is sound, 5 + kind is truncated. SEPARATOR stands between sequences.
GONE, SEPARATOR = 0, -1
SYMBOLS = 9


class Rope:
    """Edits as a tree: joined without copying, read when they are compared or asked for."""

    __slots__ = ("left", "right", "text")

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right

    def __add__(self, other: Rope) -> Rope:
        if other.text == "":
            return self
        return other if self.text == "" else Rope(None, self, other)

    def __str__(self) -> str:
        if self.text is None:
            parts, todo = [], [self]
            while todo:
                node = todo.pop()
                if node.text is not None:
                    parts.append(node.text)
                else:
                    todo += (node.right, node.left)
            self.text, self.left, self.right = "".join(parts), None, None
        return self.text


Cell = tuple[int, Rope] | None
Matrix = tuple[tuple[Cell, ...], ...]
EMPTY = Rope("")


def better(a: Cell, b: Cell) -> Cell:
    """The cheaper one, of equal ones that whose edits come first."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if str(a[1]) <= str(b[1]) else b


def through(row: tuple[Cell, ...], m: Matrix) -> tuple[Cell, ...]:
    """Where a row of cells leads by a matrix."""
    out = []
    for q in range(STATES):
        ways = [(row[r][0] + m[r][q][0], row[r], m[r][q]) for r in range(STATES) if row[r] is not None and m[r][q] is not None]
        least = min((w[0] for w in ways), default=None)
        best = None
        for cost, a, b in ways:
            if cost == least:
                best = better(best, (cost, a[1] + b[1]))
        out.append(best)
    return tuple(out)


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(through(row, b) for row in a)


def _insertions() -> Matrix:
    """Any number of inserted rows, none, or those that lead from a state to another."""
    rows = []
    for p in range(STATES):
        row: list[Cell] = [None] * STATES
        row[p] = (0, EMPTY)
        todo = [p]
        while todo:
            r = todo.pop()
            for kind in "ua":
                q = NEXT.get((r, kind))
                if q is not None and row[q] is None:
                    row[q] = (row[r][0] + INSERT, row[r][1] + Rope("I"))
                    todo.append(q)
        rows.append(tuple(row))
    return tuple(rows)


INSERTIONS = _insertions()


def of_symbol(symbol: int) -> Matrix:
    """The edits of one row, after any insertions."""
    rows = []
    for p in range(STATES):
        row: list[Cell] = [None] * STATES
        row[p] = (DELETE, Rope("D"))
        if symbol != GONE:
            extra = TRUNCATED if symbol > 4 else 0
            for kind in "sua":
                q = NEXT.get((p, kind))
                if q is not None:
                    if kind == KINDS[(symbol - 1) % 4]:
                        row[q] = better(row[q], (extra, Rope("K")))
                    if kind != "s":
                        row[q] = better(row[q], (extra + REROLE, Rope("R")))
        rows.append(tuple(row))
    return times(INSERTIONS, tuple(rows))


class Grammar:
    """Rules (a, b), the i-th of which is symbol SYMBOLS + i, and the matrix of each symbol."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules
        self.matrices = [of_symbol(i) for i in range(SYMBOLS)]
        for a, b in rules:
            self.matrices.append(times(self.matrices[a], self.matrices[b]))
        for m in self.matrices:
            for row in m:
                for cell in row:
                    if cell is not None:
                        str(cell[1])

    def compress(self, flat: np.ndarray) -> np.ndarray:
        """A row of symbols by all rules in their order, each from the left."""
        for i, (a, b) in enumerate(self.rules):
            hit = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b))
            if a == b and len(hit):  # of a run of equal symbols every other place
                run = np.cumsum(np.concatenate([[1], np.diff(hit) > 1]))
                hit = hit[(np.arange(len(hit)) - np.searchsorted(run, run)) % 2 == 0]
            if len(hit):
                flat = flat.copy()
                flat[hit] = SYMBOLS + i
                flat = np.delete(flat, hit + 1)
        return flat

    def compressed(self, sequences: list[bytes]) -> list[list[int]]:
        """Each sequence by the rules, all in one go."""
        flat = self.compress(joined(sequences))
        ends = np.flatnonzero(flat == SEPARATOR)
        return [flat[a:b].tolist() for a, b in zip([0, *(ends[:-1] + 1)], ends)]

    def after(self, row: tuple[Cell, ...], compressed: list[int]) -> tuple[Cell, ...]:
        """Where a row of cells leads by a sequence."""
        for symbol in compressed:
            row = through(row, self.matrices[symbol])
        return row


def joined(sequences: list[bytes]) -> np.ndarray:
    """Sequences one after the other, a SEPARATOR behind each."""
    flat = np.array(bytearray(b"\xff".join([*sequences, b""])), np.int32)
    flat[flat == 255] = SEPARATOR
    return flat


START: tuple[Cell, ...] = ((0, EMPTY), None, None, None)


def finish(row: tuple[Cell, ...]) -> tuple[int, str]:
    """The cheapest end, with insertions behind the last row where they are needed."""
    last = through(row, INSERTIONS)
    cost, edits = better(*[last[q] for q in ENDS])
    return cost, str(edits)


def learn(sequences: DataFrame) -> Grammar:
    """A grammar of Re-Pair rules over distinct sequences (column symbols). A task sends one row for each pair it sees."""
    rules: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        grammar = Grammar(rules)

        def pairs(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            n = SYMBOLS + len(grammar.rules)
            total = np.zeros((n, n), np.int64)
            for batch in batches:
                flat = grammar.compress(joined(batch.column("symbols").to_pylist()))
                a, b = flat[:-1], flat[1:]
                fine = (a >= 0) & (b >= 0)
                np.add.at(total, (a[fine], b[fine]), 1)
            a, b = np.nonzero(total)
            yield pa.record_batch([pa.array(a), pa.array(b), pa.array(total[a, b])], ["a", "b", "n"])

        counted = sequences.mapInArrow(pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
        new = [(r.a, r.b) for r in counted.orderBy(F.desc("n"), "a", "b").limit(RULES).collect()]
        if not new:
            break
        rules += new
    return Grammar(rules)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one that stands more often."""
    for batch in batches:
        names = ["conv_id", "turn", "role", "text"]
        table = pa.Table.from_batches([batch]).group_by(names).aggregate([("times", "sum")]).rename_columns([*names, "times"])
        yield from table.combine_chunks().to_batches()


def marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, times) with fault (blank, truncated or null) and digest of conversation, role and text;
    and for each row whose role and text stand at an earlier turn one with the same key before it, with ``flag`` and without text.

    Texts are neither grouped nor joined: what is a repeat is found by digests.
    """
    digest = F.unhex(F.sha2(F.concat_ws("\x00", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), "role", "text"), 256)).alias("digest")
    when = F.struct(F.col("turn").isNotNull().alias("later"), F.coalesce("turn", F.lit(0)).alias("turn")).alias("when")
    narrow = rows.where("times > 0").select("conv_id", "turn", "role", digest, when)
    firsts = narrow.groupBy("digest").agg(F.min("when").alias("first"), F.max("when").alias("last")).where("first < last").select("digest", "first")
    flags = narrow.join(firsts, "digest").where(F.col("when") > F.col("first")).select("conv_id", "turn", "role", "digest").distinct()
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    counted = rows.mapInArrow(_counted, "conv_id long, turn long, role string, text string, times long")
    texts = counted.select("conv_id", "turn", "role", digest, F.lit(False).alias("flag"), "text", "times", fault.alias("fault"))
    return texts.unionByName(flags.select("*", F.lit(True).alias("flag")), allowMissingColumns=True)


_PIECE = (
    "conv_id long, part long, piece long, edge boolean, symbols binary, kinds binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long"
)
REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_KIND = {"s": 0, "u": 1, "a": 2, "-": 3}


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n.split()[0], kinds[n.split()[1]]) for n in schema.split(", ")])


class Piece:
    """Rows of a conversation while they are gathered."""

    def __init__(self, conv_id, part: int, number: int):
        self.conv_id, self.part, self.number = conv_id, part, number
        self.symbols, self.kinds, self.roles, self.texts, self.turns = bytearray(), bytearray(), [], [], []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.size = 0

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        kind = _KIND[role[:1] if role[:1] in ("s", "u", "a") else "-"]
        self.kinds.append(kind)
        self.symbols.append(GONE if fault in ("blank", "duplicate") else 1 + kind + 4 * (fault == "truncated"))
        self.roles.append(role)
        self.texts.append(text)
        if fault:
            self.counts[fault] += 1
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.size += len(text)

    @property
    def full(self) -> bool:
        return len(self.symbols) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def row(self, edge: bool) -> dict:
        return {
            "conv_id": self.conv_id, "part": self.part, "piece": self.number, "edge": edge, "symbols": bytes(self.symbols), "kinds": bytes(self.kinds), "roles": self.roles, "texts": self.texts, **self.counts,
            "illegal": illegal(bytes(self.kinds)), "turns": len(self.turns), "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None,
        }


def illegal(kinds: bytes) -> int:
    """Neighbours that are neither su, ua nor au."""
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(kinds, kinds[1:]))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of marked() as pieces. edge: the conversation may have other pieces, here or in the neighbouring ranges."""
    part = TaskContext.get().partitionId()
    schema = _arrow(_PIECE)
    out, held, size, seen = [], None, 0, None
    first, long_ = True, False
    names = ("conv_id", "turn", "role", "digest", "flag", "text", "times", "fault")
    for batch in batches:
        for conv_id, turn, role, digest, flag, text, n, fault in zip(*(batch.column(c).to_pylist() for c in names)):
            repeat = seen == (conv_id, turn, role, digest)
            if flag or n:
                seen = conv_id, turn, role, digest
            if flag:
                continue
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    out.append(held.row(first or long_))
                    size, first, long_ = size + held.size, False, False
                held = Piece(conv_id, part, 0)
            for i in range(n):
                if held.full:
                    out.append(held.row(True))
                    size, long_ = size + held.size, True
                    held = Piece(conv_id, part, held.number + 1)
                held.add(turn, role, text, "blank" if fault == "blank" else "duplicate" if repeat or i else fault)
                if size >= PIECE_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
    if held is not None:
        out.append(held.row(True))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def applied(edits: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The lines ``role:text`` that edits leave of rows, from a state on, and the state they end in."""
    lines, row = [], 0
    for e in edits:
        wanted = "assistant" if state == 2 else "user"
        role, text = ("", "") if e == "I" else (roles[row], texts[row])
        row += e != "I"
        if e != "D":
            lines.append(f"{role if e == 'K' else wanted}:{text}")
            state = NEXT[state, role[:1] if e == "K" else wanted[0]]
    return lines, state


def _whole(grammar: Grammar):
    """Conversations of one piece, where they lie."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}
        for batch in batches:
            out, rows = [], batch.to_pylist()
            new = list({r["symbols"] for r in rows} - known.keys())
            if len(known) > 50_000:
                known, new = {}, list({r["symbols"] for r in rows})
            known |= {q: finish(grammar.after(START, c)) for q, c in zip(new, grammar.compressed(new))}
            for r in rows:
                cost, edits = known[r["symbols"]]
                text = "\n".join(applied(edits, r["roles"], r["texts"], 0)[0])
                gaps = r["last_turn"] - r["first_turn"] + 1 - r["turns"] if r["turns"] else 0
                out.append({c: r[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal")} | {"gaps": gaps, "cost": cost, "audit": edits, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, _arrow(REPAIRED))

    return repair


_EDITED = "conv_id long, part long, piece long, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[dict]]:
    """The rows of each conversation in order, as they stream by."""
    rows = (r for b in batches for r in b.to_pylist())
    for _, own in groupby(rows, key=lambda r: r["conv_id"]):
        yield own


def shared_prefix(row: tuple[Cell, ...]) -> tuple[str, tuple[Cell, ...]]:
    """What the edits of all cells begin with, and the cells without it."""
    texts = [str(c[1]) for c in row if c is not None]
    a, b = min(texts), max(texts)
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n], tuple(c and (c[0], Rope(str(c[1])[n:])) for c in row)


def _edits(grammar: Grammar):
    """The edits of each piece of conversations of several pieces, the first piece with the sums of all.

    Of the cells only what differs between states is carried on; what they share is settled.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _runs(batches):
            row, settled, pieces = START, [], []
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
            first = last = kind = None
            for r in own:
                row = grammar.after(row, grammar.compressed([r["symbols"]])[0])
                prefix, row = shared_prefix(row)
                settled.append(prefix)
                pieces.append((r["part"], r["piece"], len(r["symbols"])))
                for c in total:
                    total[c] += r[c]
                if r["kinds"]:
                    total["illegal"] += illegal(bytes((kind, r["kinds"][0]))) if kind is not None else 0
                    kind = r["kinds"][-1]
                if r["turns"]:
                    total["turns"] -= last == r["first_turn"]
                    first, last = r["first_turn"] if first is None else first, r["last_turn"]
            cost, rest = finish(row)
            audit = "".join(settled) + rest
            gaps = last - first + 1 - total.pop("turns") if first is not None else 0
            out, at = [], 0
            for i, (part, piece, n) in enumerate(pieces):
                end, left = at, n
                while end < len(audit) and (left or i == len(pieces) - 1):
                    left -= audit[end] != "I"
                    end += 1
                out.append({"conv_id": r["conv_id"], "part": part, "piece": piece, "edits": audit[at:end], "gaps": gaps, "cost": cost, **total})
                at = end
                if len(out) == 1000:
                    yield pa.RecordBatch.from_pylist(out, _arrow(_EDITED))
                    out = []
            yield pa.RecordBatch.from_pylist(out, _arrow(_EDITED))

    return solve


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of conversations whose pieces stream by with their edits."""
    for own in _runs(batches):
        digest, audit, state, any_ = hashlib.sha256(), [], 0, False
        for r in own:
            lines, state = applied(r["edits"], r["roles"], r["texts"], state)
            if lines:
                digest.update((("\n" if any_ else "") + "\n".join(lines)).encode())
                any_ = True
            audit.append(r["edits"])
        out = {c: r[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
        yield pa.RecordBatch.from_pylist([out], _arrow(REPAIRED))


def repair(rows: DataFrame) -> DataFrame:
    """REPAIRED for each conv_id of rows (conv_id, turn, role, text, times).

    A row stands ``times`` times, of which all but the first are repeats; 0 keeps its conversation without the row.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    clean = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role"), space("text"), F.col("times").cast("long"))
    n_bytes = clean.agg(F.coalesce(F.sum(F.octet_length("text") + 50), F.lit(0))).first()[0]
    key = ["conv_id", "turn", "role", "digest"]
    sorted_ = marked(clean).repartitionByRange(buckets_for(n_bytes, 32_000_000, 1), *key).sortWithinPartitions(*key, F.desc("flag"))
    pieces = keep(sorted_.mapInArrow(_pieces, _PIECE), "pieces")
    sequences = keep(pieces.select("symbols").distinct(), "sequences")
    grammar = learn(sequences)
    forget(sequences)
    whole = pieces.where("not edge").mapInArrow(_whole(grammar), REPAIRED)
    cut = pieces.where("edge")
    names = ["conv_id", "part", "piece"]
    narrow = cut.select(*names, "symbols", "kinds", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")
    edits = narrow.repartition("conv_id").sortWithinPartitions(*names).mapInArrow(_edits(grammar), _EDITED)
    edits = edits.withColumnsRenamed({c: f"e_{c}" for c in names})
    both = edits.join(cut.select(*names, "roles", "texts"), F.col("e_conv_id").eqNullSafe(F.col("conv_id")) & (F.col("e_part") == F.col("part")) & (F.col("e_piece") == F.col("piece")))
    rest = both.repartition("conv_id").sortWithinPartitions(*names).mapInArrow(_hashed, REPAIRED)
    return whole.unionByName(rest)
