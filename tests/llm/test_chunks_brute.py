"""Chunks, spans and sources of substring dedup against a plain rewrite, byte by byte."""

import random

import pytest

from netsift.llm import chunks

GEAR = [int(x) for x in chunks._GEAR]
BLANKS = b" \t\n\x0b\x0c\r"


def plain_chunks(text):
    """(start, end) of a text's chunks in its bytes."""
    data = text.encode()
    at_cut = []
    for i in range(chunks.SEEN - 1, len(data) - 1):
        h = sum(GEAR[data[i - j]] << j for j in range(16)) & 0xFFFF
        blank_cut = data[i] in BLANKS and h >> (16 - chunks.BLANK_BITS) == 0
        if (blank_cut or h >> (16 - chunks.OTHER_BITS) == 0) and data[i + 1] & 0xC0 != 0x80:
            at_cut.append(i + 1)
    edges, before = [0], 0
    for c in at_cut:
        if c - before >= chunks.LEAST:
            edges.append(c)
        before = c
    edges.append(len(data))
    out = []
    for a, b in zip(edges, edges[1:]):
        inner = []
        for k in range(1, (b - a - 1) // chunks.MOST + 1):
            c = a + k * chunks.MOST
            while data[c] & 0xC0 == 0x80:
                c += 1
            inner.append(c)
        out += list(zip([a, *inner], [*inner, b]))
    return [(a, b) for a, b in out if b > a]


def brute(docs):
    """doc_id -> (spans, the documents that hold one of the cut chunks earlier, text)."""
    first, holders, out = {}, {}, {}
    for i, text in sorted(docs.items()):
        for a, b in plain_chunks(text):
            piece = text.encode()[a:b]
            first.setdefault(piece, (i, a))
            holders.setdefault(piece, set()).add(i)
    for i, text in docs.items():
        data, runs = text.encode(), []
        for a, b in plain_chunks(text):
            if first[data[a:b]] != (i, a):
                if runs and runs[-1][-1][1] == a:
                    runs[-1].append((a, b))
                else:
                    runs.append([(a, b)])
        runs = [r for r in runs if r[-1][1] - r[0][0] >= chunks.LEAST_RUN]
        spans = [(r[0][0], r[-1][1]) for r in runs]
        sources = {j for r in runs for a, b in r for j in holders[data[a:b]] if j <= i}
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        out[i] = (spans, sources, (kept + data[at:]).decode())
    return out


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4)])
def test_spans_sources_and_texts(spark, seed, parts):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüéñ汉", k=rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.choice([15, 60, 150])) for _ in range(5)] + ["x" * 5000, "äö" * 1500]
    docs = {}
    for i in rng.sample(range(1000), 80):
        docs[i] = "\n".join(rng.choice(passages) if rng.random() < 0.4 else prose(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 7)))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(parts)
    got = {r.doc_id: r for r in chunks.dedupe(df).collect()}
    wanted = brute(docs)
    assert sum(len(w[0]) for w in wanted.values()) > 30
    for i, (spans, sources, text) in wanted.items():
        assert [tuple(s) for s in got[i].spans or []] == spans, i
        assert got[i].text == text, i
        assert bool(got[i].sources) == bool(spans) and set(got[i].sources or []) <= sources, i


def test_chunks_of_odd_texts(spark):
    import pyarrow as pa

    texts = ["", " ", "short", "a" * 3000, "ä" * 2000, "汉" * 800 + " x", " ".join(str(i) for i in range(900))]
    text, start, end, _ = chunks.chunk(pa.array(texts))
    for i, t in enumerate(texts):
        assert [(int(a), int(b)) for n, a, b in zip(text, start, end) if n == i] == plain_chunks(t), t[:20]
