"""Token stores against the tokenizer itself, and the perfect hash against a dictionary."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netsift.llm import queries, tokenstore

from ..conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    """doc_id, start, n_tokens, crc of rows (doc_id, text), equal doc_ids by crc."""
    model = Tokenizer.from_file(PATH)
    each = []
    for i, t in rows:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        each.append((i is not None, i or 0, crc32(np.array(ids, "<u2").tobytes()), i, len(ids), crc32(np.array(ids, "<u4").tobytes())))
    out, at = [], 0
    for *_, i, n, crc in sorted(each, key=lambda r: r[:3]):
        out.append((i, at, n, crc))
        at += n
    return out


def through_store(docs):
    store = tokenstore.write_store(docs, PATH)
    got = tokenstore.lookup(tokenstore.keys_of(docs), store)
    return [tuple(r) for r in got.select("doc_id", "start", "n_tokens", F.crc32("ids")).orderBy("start").collect()]


def test_the_query_equals_the_tokenizer(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_token_index(spark, SMALL).orderBy("start").collect()]
    assert got == brute(rows)


def test_odd_rows(spark):
    long_ = " ".join(f"w{i}" for i in range(50_000))
    rows = [(5, None), (3, ""), (3, "twice"), (3, "twice"), (None, "no name"), (None, None), (-7, " \t\n"), (9, long_), (2**40, "It's <|endoftext|> here <|startoftext|>x"), (4, "\x00\x1c ́e ΑΣ ŞI'S İ 12a3 ñ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("ids", "crc", "i", "k", "bucket")})
    assert through_store(docs) == brute(rows)
    assert through_store(docs.limit(0)) == []


def test_one_doc_id_over_many_files(spark, monkeypatch):
    """Files of a few hundred bytes: a doc_id that most rows share goes over several files and is counted on."""
    monkeypatch.setattr(tokenstore, "BLOCK_BYTES", 100)
    monkeypatch.setattr(tokenstore, "BLOCKS", 2)
    rng = random.Random(3)
    rows = [(7 if i % 3 else i, " ".join(rng.choices("ab cd ef gh ij".split(), k=rng.randrange(30)))) for i in range(300)]
    assert through_store(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_a_missing_key_gives_no_row(spark):
    store = tokenstore.write_store(spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string"), PATH)
    keys = spark.createDataFrame([(i, k) for i in (0, 499, 500, None, 7, 7) for k in (0, 1)], "doc_id long, k long")
    assert sorted((r.doc_id, r.k, r.n_tokens) for r in tokenstore.lookup(keys, store).collect()) == [(0, 0, 3), (7, 0, 3), (499, 0, 5)]


@pytest.mark.parametrize("seed", range(3))
def test_words_and_whole_texts_are_encoded_alike(seed):
    rng = random.Random(seed)
    signs = [*"abcXYZ019.,;:!?'\"<|>-_()#@ \t\n", "\x0b", "\x85", " ", " ", "é", "é", "ß", "Σ", "ς", "ſ", "١", "½", "汉", "ا", "🙂", "‍", "<|endoftext|>", "'s", "'LL", "\x1c", "\x00"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)]
    flat, starts = tokenstore.Encoder(PATH)(pa.array(texts))
    model = Tokenizer.from_file(PATH)
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:])] == [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def test_another_tokenizer_is_asked_for_whole_texts():
    own = tokenstore.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not own.by_word
    text = "Two words, and  spaces"
    assert own(pa.array([text, None]))[0].tolist() == own.model.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_the_hash_is_perfect_and_minimal(n):
    words = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    assert sorted(tokenstore.PerfectHash.of(words).slot(words)) == list(range(len(words)))


def test_equal_first_words_are_told_apart():
    h1 = np.array([5, 5, 5, 8], np.uint64)
    h2 = np.array([1, 2, 3, 4], np.uint64) << np.uint64(40)
    table = pa.table({"h1": h1.view(np.int64), "h2": h2.view(np.int64), "shard": np.arange(4), "offset": np.arange(4), "n_tokens": np.arange(4), "start": np.arange(4), "bucket": np.zeros(4, np.int64)})
    asked = pa.table({"doc_id": np.arange(4), "k": np.zeros(4, np.int64), "h1": h1.view(np.int64), "h2": h2.view(np.int64)})
    got = tokenstore._find(asked, tokenstore._build(table))
    assert got.column("shard").to_pylist() == [0, 1, 2, 3]
