"""Operators with exact results, against brute force."""

import gzip
import hashlib
import random
import re
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from netsift.llm import chunks, decontam, jaccard, langid, lblm, mixing, quality, toxicity, urlgraph, warc
from netsift.llm.components import components

from ..conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=True):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd_rows(spark):
    """Nulls in every column, empty and blank texts, a long text, repeated rows, columns with names used inside."""
    long_ = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 3), (4, "one two", "en", None, 7), (4, "one two", "en", None, 7), (None, "one two three four five six", "de", "t", 9), (5, long_, "en", "s", 1), (6, "the same words stand here again and again " * 40, "en", "s", 1), (7, "the same words stand here again and again " * 40, "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(1) for c in ("_id", "size", "bucket", "group", "score", "kept")})


# Jaccard -------------------------------------------------------------------------------------------------------------


def sets_of(texts):
    out = {}
    for i, t in texts:
        w = words(t)
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute_components(texts):
    sets = sets_of(texts)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    texts = []
    line = [f"common{i}" for i in range(30)]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 40, 150, 400]))]
        for _ in range(rng.choice([2, 5, 25])):
            texts.append(edited(rng, base, rng.randrange(0, max(2, len(base) // 18))))
    texts += [" ".join([*line, *(f"u{i}v{k}" for k in range(20))]) for i in range(40)]
    texts += ["a b", "a b", "a b c", "", "q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(enumerate(texts))


def test_families_with_outliers_equal_brute_force(spark, monkeypatch):
    """Large families around one base, variants that are near to some members only, and texts that are mostly one passage."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(17)
    base = [f"b{rng.randrange(900)}" for _ in range(90)]
    texts = [edited(rng, base, rng.randrange(0, 3)) for _ in range(70)]
    for _ in range(25):
        far = edited(rng, base, rng.randrange(3, 7)).split()
        texts += [" ".join(far), edited(rng, far, 1)]
    passage = [f"p{i}" for i in range(80)]
    texts += [" ".join([*passage, *(f"q{i}r{k}" for k in range(rng.choice([8, 24, 40])))]) for i in range(60)]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(enumerate(texts))
    assert len({c for _, c in got.values()}) > 20


def test_a_small_set_within_many_larger_ones_keeps_its_links(spark):
    """One set of 86 shingles and ten sets of 114 that hold it: all keys that they share are hot, their levels differ."""
    own = [f"s{i}" for i in range(90)]
    texts = [" ".join(own)] + [" ".join([*own, *(f"t{j}u{k}" for k in range(28))]) for j in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute_components(enumerate(texts)) and {c for _, c in got.values()} == {0}


def test_every_similar_pair_shares_a_key():
    """The pigeonhole argument itself, on sets at the very edge of the threshold."""
    rng = np.random.default_rng(5)
    edges = jaccard.bands(3000)
    for n in (1, 3, 4, 7, 8, 20, 60, 200, 900):
        for _ in range(30):
            base = rng.integers(0, 2**63, n).astype(np.uint64)
            apart = jaccard.most_apart(n, n) // 2
            other = base.copy()
            other[:apart] = rng.integers(0, 2**63, apart).astype(np.uint64)
            extra = rng.integers(0, 2**63, max(0, jaccard.most_apart(n, n + n // 3) - n // 3 if apart == 0 else 0)).astype(np.uint64)
            other = np.concatenate([other, extra])
            a, b = np.unique(base), np.unique(other)
            common = len(np.intersect1d(a, b))
            if 4 * common < 3 * (len(a) + len(b) - common):
                continue
            k = int(np.searchsorted(edges, max(len(a), len(b)), side="right") - 1)
            scheme = jaccard.Scheme(jaccard.bands_to(edges, k), k)
            got = [set(jaccard.keys(x, np.zeros(len(x), np.int64), np.array([len(x)]), scheme)[0].tolist()) for x in (a, b)]
            assert got[0] & got[1]


def test_pairs_of_unequal_levels_are_not_lost_to_hot_keys():
    """Where all keys that a pair shares are hot, both sets are indexed again, also if one has keys to spare at its level."""
    rng = np.random.default_rng(8)
    edges, n, seen = jaccard.bands(3000), 154, 0
    scheme = jaccard.Scheme(edges, int(np.searchsorted(edges, n, side="right") - 1))
    assert not scheme.deletions
    segments = lambda x: (jaccard.mix(x ^ scheme.seed) >> np.uint64(33)).astype(np.int64) % scheme.segments
    for _ in range(20):
        # too few segments are filled for level 0
        base = rng.integers(0, 2**63, 1000).astype(np.uint64)
        base = base[segments(base) < 51][:n]
        # 22 elements are replaced, which is all that the threshold allows: two go from each of 11 segments, 22 others get one more
        at = segments(base)
        count = np.bincount(at, minlength=scheme.segments)
        last = np.concatenate([np.flatnonzero(at == i)[:2] for i in np.flatnonzero(count > 2)[:11]])
        free = rng.integers(0, 2**63, 4000).astype(np.uint64)
        new = [free[segments(free) == i][0] for i in [*np.flatnonzero(count == 0)[:1], *np.setdiff1d(at, at[last])[:21]]]
        other = np.concatenate([np.delete(base, last), np.array(new, np.uint64)])
        assert len(last) == len(new) == 22
        rows = np.repeat([0, 1], n)
        key, owner, *own = jaccard.keys(np.concatenate([base, other]), rows, np.array([n, n]), scheme)
        filled = [len(np.unique(segments(x))) for x in (base, other)]
        deeper = np.bincount(owner) > filled
        if deeper[0] == deeper[1]:
            continue
        seen += 1
        shared = np.intersect1d(key[owner == 0], key[owner == 1])
        # more sets than FEW have just the shared keys
        key, owner = [key, *[shared] * jaccard.FEW], [owner, *(np.full(len(shared), 2 + i) for i in range(jaccard.FEW))]
        key, owner = np.concatenate(key), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        own = [np.concatenate([x, np.zeros(jaccard.FEW, x.dtype)]) for x in own]
        payload = jaccard._pack(key[order], owner[order], 2 * np.arange(2 + jaccard.FEW), *own)
        met = jaccard._meet_few(pa.table({"payload": pa.array([payload], pa.binary())})).to_pylist()
        tight = {r["x"] for r in met if r["spare"] is not None and r["y"] > r["spare"]}
        assert {0, 2} <= tight, (deeper, met)
    assert seen


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# Chunks --------------------------------------------------------------------------------------------------------------


def test_repeated_passages_are_cut_and_others_stay(spark):
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage, clean = text(70), [text(120) for _ in range(20)]
    rows = [(i, f"{c} {passage} {text(50)}" if i < 6 else c) for i, c in enumerate(clean)]
    got = {r.doc_id: r for r in chunks.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, original in rows:
        assert got[i].spans is None or 0 < i < 6
    assert got[0].text == rows[0][1]
    grams = Counter(g for r in got.values() for g in set(zip(*[words(r.text)[k:] for k in range(50)])))
    assert max(grams.values()) == 1
    assert all(got[i].sources == [0] or 0 in got[i].sources for i in range(1, 6))
    assert all(set(words(got[i].text)) >= set(words(clean[i])[:100]) for i in range(6))


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_rows_keep_their_text(spark, parts):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage, nameless = text(70), text(90)
    once = [(1, text(120)), (2, f"{passage} {text(50)} {passage} {text(50)}"), (3, f"{text(50)} {passage}"), (None, nameless), (None, text(100))]
    run = lambda rows: chunks.dedupe(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    wanted = sorted((str(r.doc_id), r.text) for r in run(once))
    assert ("1", once[0][1]) in wanted and ("None", nameless) in wanted
    assert sorted({(str(r.doc_id), r.text) for r in run(once * 3)}) == wanted
    assert sum(r.text == nameless for r in run(once * 3)) == 3


def test_cuts_resist_insertions():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefghij é") for _ in range(6)) for _ in range(4000))
    digests = lambda t: {bytes(h) for h in chunks.chunk(pa.array([t]))[3]}
    before, after = digests(text), digests("inserted " + text[:5000] + "more" + text[5000:])
    assert len(before - after) <= 8
    for t in (text, "", "x", "é" * 5000, " " * 5000, "ab" * 9000):
        text_of, a, b, _ = chunks.chunk(pa.array([t]))
        raw = t.encode()
        assert b"".join(raw[i:j] for i, j in zip(a, b)) == raw and all(j - i <= chunks.MOST + 3 for i, j in zip(a, b))
        assert all(raw[i:j].decode() is not None for i, j in zip(a, b))


# WARC ----------------------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    html = ["<p>" + "x" * 200, "<p>" + "x" * 200, "short", "short", None, "é\r\n\r\nWARC/1.1\r\n" + "y" * 100, "<p>" + "x" * 200]
    pages = spark.createDataFrame([(i, None if i == 3 else f"http://h/{i}\r\nX: y", h) for i, h in enumerate(html)] + [(None, "u", "z" * 120)], "page_id long, url string, html string").withColumn("record", F.lit(1))
    got = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    assert len(got) == 8 and all(r.intact for r in got.values())
    for i, h in enumerate(html):
        raw = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {i: got[i].refers_to for i in range(7)} == {0: None, 1: 0, 2: None, 3: None, 4: None, 5: None, 6: 0}
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_a_broken_archive_is_reported(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(Exception, match="ends early"):
        warc.read_archives(spark, f"file://{tmp_path}").collect()


# URLs ----------------------------------------------------------------------------------------------------------------


def test_urls_and_rules(spark):
    urls = ["http://A.Example.org/en/15?x", "http://example.org/en/2", "http://example.org/es/", "notexample.org", None, "x://b.com/fr/1#a", "x://com/de/", "x://b.net/", "http://evilorg/x", "http://example.org?en/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlgraph.judged(df).collect()}
    assert got == {
        0: ("a.example.org", "/en/15", "example.org/en/1", "block"), 1: ("example.org", "/en/2", "org/", "allow"), 2: ("example.org", "/es/", "example.org/es/", "block"), 3: ("", "", None, None), 4: ("", "", None, None),
        5: ("b.com", "/fr/1", "com/fr/", "allow"), 6: ("com", "/de/", "com/de/", "block"), 7: ("b.net", "/", None, None), 8: ("evilorg", "/x", None, None), 9: ("example.org", "", None, None),
    }


def test_trust_flows_along_links_and_distrust_against_them(spark):
    link = lambda h: f'<a href="http://{h}/">x</a>'
    pages = spark.createDataFrame([(1, "http://good.org/", link("a.xx")), (2, "http://bad.com/de/", ""), (3, "http://b.yy/", link("bad.com")), (4, "http://a.xx/", ""), (5, "http://lone.zz/", None), (6, None, link("a.xx"))], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlgraph.filter_urls(pages).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


def test_pagerank_equals_power_iteration(spark):
    edges = [("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0), ("c", "a", 2.0), ("c", "d", 2.0)]
    got = {r.host: r.score for r in urlgraph.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("a", 1.0)], "host string, seed double"), "t").collect()}
    out = Counter()
    for s, _, w in edges:
        out[s] += w
    score = {"a": 1.0}
    for _ in range(urlgraph.STEPS):
        fresh = Counter({"a": 1 - urlgraph.DAMPING})
        for s, d, w in edges:
            fresh[d] += urlgraph.DAMPING * score.get(s, 0) * w / out[s]
        score = fresh
    assert all(abs(got[k] - v) < 1e-12 for k, v in score.items())


def test_verdicts_equal_brute_force(spark):
    """Trust and distrust over links, domain edges and seeds, written out with dictionaries; many pages with real links."""
    rng = random.Random(21)
    hosts = [f"{a}.{b}" for a in ("a", "b", "c.d", "e", "f") for b in ("org", "com", "net", "xx")] + ["lone.yy"]
    rows = []
    for i in range(120):
        links = "".join(f'<a href="{rng.choice(["http:", "https:", ""])}//{rng.choice(hosts)}/p">x</a>' for _ in range(rng.randrange(4)))
        rows.append((i, f"http://{rng.choice(hosts)}{rng.choice(['/', '/fr/1', '/de/2'])}", links or None))
    got = {r.page_id: r for r in urlgraph.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    of = {i: (u.split("/")[2], "/" + u.split("/", 3)[3]) for i, u, _ in rows}

    def rule(host, path):
        fits = [(v, x) for v, x in urlgraph.RULES if (host == x.split("/")[0] or host.endswith("." + x.split("/")[0])) and path.startswith("/" + x.split("/", 1)[1])]
        return max(fits, key=lambda f: len(f[1]), default=(None, None))

    edges = Counter()
    for i, _, html in rows:
        for dst in re.findall(r'href="(?:https?:)?//([^/]+)/', html or ""):
            if dst != of[i][0]:
                edges[of[i][0], dst] += 1
    names = [h.split(".") for h in {h for h, _ in of.values()} | {d for _, d in edges}]
    for a, b in {(".".join(n[k:]), ".".join(n[k + 1 :])) for n in names for k in range(len(n) - 1)}:
        edges[a, b] += 1
        edges[b, a] += 1

    def spread(edges, seeds):
        out = Counter()
        for (a, _), n in edges.items():
            out[a] += n
        score = dict(seeds)
        for _ in range(urlgraph.STEPS):
            fresh = Counter({h: (1 - urlgraph.DAMPING) * v for h, v in seeds.items()})
            for (a, b), n in edges.items():
                fresh[b] += urlgraph.DAMPING * score.get(a, 0) * n / out[a]
            score = fresh
        return score

    verdicts = {i: rule(*of[i]) for i in of}
    seeds = {v: Counter(of[i][0] for i in of if verdicts[i][0] == v) for v in ("allow", "block")}
    share = lambda c: {h: n / sum(c.values()) for h, n in c.items()}
    trust, distrust = spread(edges, share(seeds["allow"])), spread({(b, a): n for (a, b), n in edges.items()}, share(seeds["block"]))
    for i, (host, path) in of.items():
        t, d = trust.get(host, 0.0), distrust.get(host, 0.0)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, verdicts[i][1])
        assert abs(got[i].trust - t) < 1e-9 and abs(got[i].distrust - d) < 1e-9
        assert got[i].verdict == (verdicts[i][0] or ("block" if d > urlgraph.BLOCK_OVER * (t + d) else "allow"))
    assert {got[i].verdict for i in of if not verdicts[i][0]} == {"allow", "block"}


# Quality -------------------------------------------------------------------------------------------------------------


def brute_stats(text):
    w, t = words(text, lower=False), text or ""
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_rule_statistics_equal_brute_force(spark):
    df = documents(spark).select("doc_id", "text").unionByName(odd_rows(spark).select("doc_id", "text"))
    texts = df.distinct().collect()
    got = Counter(tuple(r) for r in quality.statistics(df).distinct().select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == Counter({(r.doc_id, *brute_stats(r.text)) for r in texts})


def test_anomalies_equal_path_lengths_by_hand():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 7))
    rows[0] += 9
    forest = quality.grow(rows)

    def expected(n):
        return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 1 else 0.0

    def depth(node, row, at):
        f = forest["feature"][node]
        return at + 0 * f if f < 0 else depth(forest["left" if row[f] < forest["cut"][node] else "right"][node], row, at + 1)

    def leaf(node, row):
        f = forest["feature"][node]
        return node if f < 0 else leaf(forest["left" if row[f] < forest["cut"][node] else "right"][node], row)

    got = quality.anomaly(forest, rows[:40])
    for row, value in zip(rows[:40], got):
        # a leaf's length is its depth and what its rows would need further
        total = [forest["length"][leaf(r, row)] for r in forest["roots"]]
        assert all(x >= depth(r, row, 0) for x, r in zip(total, forest["roots"]))
        assert abs(value - 2 ** (-np.mean(total) / expected(quality.TREE_ROWS))) < 1e-12
    assert got[0] == got.max() and len(forest["roots"]) == quality.TREES
    small = quality.grow(np.array([[1.0] * 7, [2.0] * 7]))
    assert set(small["length"][small["feature"] < 0]) == {1.0}


def test_the_threshold_weighs_both_classes():
    good, bad = np.zeros(quality.BINS + 1), np.zeros(quality.BINS + 1)
    good[800], good[1200], good[1500], bad[1300], bad[1100], bad[700] = 990, 8, 2, 50, 30, 20
    best = max((k / quality.BINS for k in range(quality.BINS + 2)), key=lambda t: (
        (lambda lost: -1e9 if lost > quality.MOST_GOOD_LOST else bad[int(round(t * quality.BINS)):].sum() / bad.sum() - quality.LOSS * lost)(good[int(round(t * quality.BINS)):].sum() / good.sum()), t))
    assert quality.threshold(good, bad) == best
    assert quality.threshold(good, bad * 0) > 1200 / quality.BINS and quality.threshold(good * 0, bad) == 2.0


# Toxicity ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("prior", [0.1, 0.9])
def test_gradients_of_the_non_negative_risk_equal_differences(prior):
    """Both branches: the corrected negative part over 0, and under it, where the step goes up along that part alone."""
    rng = np.random.default_rng(1)
    make = lambda n: (lambda rows: (np.concatenate(rows), np.cumsum([0, *map(len, rows)])))([rng.choice(9, 4, replace=False) for _ in range(n)])
    p, u = make(5), make(8)
    fit = toxicity.Fit(np.append(rng.normal(size=9) * (3 if prior > 0.5 else 1), 0.4), prior, 1)

    def parts(w, b):
        z = lambda x: np.array([w[x[0][s:e]].sum() + b for s, e in zip(x[1], x[1][1:])])
        soft = lambda v: np.mean(np.log1p(np.exp(v)))
        return prior * soft(-z(p)), soft(z(u)) - prior * soft(z(p))

    positive, negative = parts(fit.w, fit.b)
    risk = (lambda w, b: sum(parts(w, b))) if negative >= 0 else (lambda w, b: -parts(w, b)[1])
    g, gb = fit.gradients(p, u)
    for i in range(9):
        step = np.eye(9)[i] * 1e-6
        assert abs((risk(fit.w + step, fit.b) - risk(fit.w - step, fit.b)) / 2e-6 - g[i]) < 1e-6
    assert abs((risk(fit.w, fit.b + 1e-6) - risk(fit.w, fit.b - 1e-6)) / 2e-6 - gb) < 1e-6


# Language ------------------------------------------------------------------------------------------------------------


def test_windows_hold_every_byte():
    texts = ["", None, "Abc é 1", "x" * 700]
    x, rows = langid.windows(pa.array(texts))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        own = x[rows == i].ravel()[: len(raw)]
        assert own.tolist() == [b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else b - 101 if b > 127 else 0 for b in raw] and not x[rows == i].ravel()[len(raw) :].any()


def test_the_network_equals_loops_and_its_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(langid, "WINDOW", 12)
    rng = np.random.default_rng(4)
    net = langid.Network(["a", "b", "c"])
    net.filters, net.out = [f.astype(np.float64) for f in net.filters], net.out.astype(np.float64)
    x, y, weight = rng.integers(0, 20, (3, 12)).astype(np.uint8), np.array([0, 2, 1]), np.array([1.0, 0.5, 2.0])

    def loss():
        total = 0.0
        for row, want, w in zip(x, y, weight):
            pooled = [max(0.0, max(sum(f[j, row[i + j], k] for j in range(width)) for i in range(12 - width + 1))) for width, f in zip(langid.WIDTHS, net.filters) for k in range(langid.FILTERS)]
            z = np.array(pooled) @ net.out + net.bias
            total -= w / len(y) * (z[want] - np.log(np.exp(z).sum()))
        return total

    got = net._gradients(x, y, weight)
    p = net.ready().probabilities(x)
    assert abs(-(weight / len(y) * np.log(p[np.arange(3), y])).sum() - loss()) < 1e-6
    for grad, part in zip(got, [*net.filters, net.out, net.bias]):
        for at in [tuple(a) for a in np.argwhere(np.abs(grad) > 1e-4)[:6]]:
            old, sides = part[at], []
            for step in (1e-4, -1e-4):
                part[at] = old + step
                sides.append(loss())
            part[at] = old
            assert abs((sides[0] - sides[1]) / 2e-4 - grad[at]) < 2e-3


# Mixing --------------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    rows = mixing.mix_sources(documents(spark).unionByName(odd_rows(spark).select(documents(spark).columns).where("doc_id < 5"))).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    wanted = brute_targets(sizes)
    for r in rows:
        assert abs(r.target - wanted[r.source]) < 1e-6 * max(1, wanted[r.source])
    for s, t in wanted.items():
        assert abs(t - taken[s]) <= max(0.02 * t, 60), s
    again = mixing.mix_sources(documents(spark).unionByName(odd_rows(spark).select(documents(spark).columns).where("doc_id < 5"))).collect()
    assert sorted((r.doc_id, r.source or "", r.taken) for r in rows) == sorted((r.doc_id, r.source or "", r.taken) for r in again)


def test_dual_meets_its_constraint(spark):
    sizes = spark.createDataFrame([("a", s) for s in range(1, 200)] + [("b", 10)] * 50, "source string, size long")
    goal = mixing.targets(sizes)
    for r in mixing.balance(sizes, goal).collect():
        own = [x.size for x in sizes.where(F.col("source") == r.source).collect()]
        mean = sum(own) / len(own)
        if r.tilt is not None:
            assert abs(sum(s * min(2, np.exp(r.tilt * s / mean)) for s in own) - r.target) < 1e-5 * r.target


# Language model counts -----------------------------------------------------------------------------------------------


def test_counts_and_base_scores_equal_brute_force(spark):
    df = documents(spark).select("doc_id", "text").unionByName(odd_rows(spark).select("doc_id", "text").where("doc_id is not null"))
    texts = [(r.doc_id, [*words(r.text), 0]) for r in df.collect()]
    held = {i: crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    counts = Counter(w for i, t in texts if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    wanted = Counter((i, held[i], len(t), sum(counts[w] > 0 for w in t), n, round(sum(log10((counts[w] + 1) / (n + v + 1)) for w in t), 5)) for i, t in texts)
    rows = lblm.score_texts(df).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == wanted
    assert len({(r.doc_id, r.n_tokens, round(r.base_score, 5)) for r in rows}) == len({(r.doc_id, r.n_tokens, round(r.base_score, 5), round(r.score, 5)) for r in rows})


def small_vocabulary():
    """Three endings in use, the end and two single tokens."""
    hot = np.array([3, 5, 9], np.uint64)
    counts, types = np.zeros(lblm.END + 3), np.zeros(lblm.END + 3)
    counts[[0, 1, 2, lblm.END, lblm.END + 1, lblm.END + 2]] = [6, 4, 2, 3, 5, 7]
    types[[0, 1, 2, lblm.END, lblm.END + 1, lblm.END + 2]] = [3, 2, 1, 1, 1, 1]
    return lblm.Vocabulary(hot, np.array([5.0, 7.0, 1.0]), np.array([lblm.END + 1, lblm.END + 2, 1]), counts, types)


def test_class_probabilities_are_normalised_and_learned():
    vocab = small_vocabulary()
    assert abs(np.exp(vocab.base).sum() - 1) < 1e-12 and vocab.n_tokens == 27 and vocab.n_types == 9
    assert abs(10 ** vocab.within[0] - (6 + 3 + 1)) < 1e-9 and vocab.within[lblm.END + 1] == 0
    model = lblm.Model.fresh(vocab)
    trainer = lblm.Trainer(model.like(np.frombuffer(model.bytes(), np.float32)), vocab, 1)
    y = np.array([2, 1] * 200)
    for _ in range(300):
        trainer.step(np.where(y == 2, 1, 2), np.full(len(y), lblm.END), y)
    m = trainer.m
    z = m.target @ (m.context[1] @ m.maps[0] + m.context[lblm.END] @ m.maps[1]) + m.bias
    assert (np.exp(z - z.max()) / np.exp(z - z.max()).sum())[2] > 0.5


def test_gradients_equal_differences_of_the_loss():
    vocab = small_vocabulary()
    trainer = lblm.Trainer(lblm.Model.fresh(vocab), vocab, 1)
    one, two, y, noise = np.array([0, 1, 2, 1]), np.array([lblm.END, 1, 1, 0]), np.array([1, 2, lblm.END + 1, 1]), np.array([0, 1, 1, lblm.END + 2])

    def loss(parts):
        context, target, maps, bias = (p.astype(np.float64) for p in parts)
        q = context[one] @ maps[0] + context[two] @ maps[1]
        sig = lambda v: 1 / (1 + np.exp(-v))
        good = np.log(sig((q * target[y]).sum(axis=1) + bias[y] - trainer.log_kq[y]))
        bad = np.log(1 - sig(q @ target[noise].T + bias[noise] - trainer.log_kq[noise]))
        return -(good.sum() + bad.sum()) / len(y)

    got = trainer.gradients(one, two, y, noise)
    rng = np.random.default_rng(2)
    for k, part in enumerate(trainer.m.parts()):
        for at in [tuple(x) for x in np.argwhere(np.abs(got[k]) > 1e-3)[rng.permutation((np.abs(got[k]) > 1e-3).sum())[:12]]]:
            sides = []
            for step in (1e-4, -1e-4):
                parts = [p.astype(np.float64).copy() for p in trainer.m.parts()]
                parts[k][at] += step
                sides.append(loss(parts))
            assert abs((sides[0] - sides[1]) / 2e-4 - got[k][at]) < 1e-3


# Decontamination -----------------------------------------------------------------------------------------------------


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_subsequence(a, b) == table[-1][-1]


def test_items_and_paraphrases_are_found_and_clean_texts_stay(spark):
    rng = random.Random(6)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    docs = [(r.doc_id, r.text) for r in documents(spark).collect()]
    planted = {}
    for k, item in enumerate(bench):
        w = item.text.split()
        kept = [x for x in w if rng.random() < 0.8] if k % 2 else w
        ctx = docs[k][1].split()[:150]
        planted[10_000 + k] = item.item_id
        docs.append((10_000 + k, " ".join([*ctx[:60], *kept, *ctx[60:]])))
    docs += [(90_000, None), (90_001, ""), (None, "a b c")]
    rows = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench)).collect()
    assert len(rows) == len(docs)
    found = {r.doc_id: r.items for r in rows if r.contaminated}
    assert sum(i in found.get(d, []) for d, i in planted.items()) >= 0.9 * len(planted)
    grams = {g for r in bench for w in [words(r.text)] for g in zip(*[w[k:] for k in range(6)])}
    clean = [d for d, t in docs if d is not None and d < 10_000 and not grams & set(zip(*[words(t)[k:] for k in range(6)]))]
    assert not set(clean) & set(found)


def exact_vectors(texts, weights):
    """Per passage: text, and word weights by feature, of length 1, written out without the operator's arrays."""
    out = []
    for i, text in enumerate(texts):
        own = words(text)
        n = max(1, -(-len(own) // decontam.BLOCK) - decontam.WINDOW + 1) if own else 0
        for k in range(n):
            part = own[k * decontam.BLOCK : (k + decontam.WINDOW) * decontam.BLOCK]
            total = Counter()
            for w in part:
                f = xxhash.xxh3_64_intdigest(w, 17) % decontam.FEATURES
                total[f] += float(weights[f])
            norm = sum(v * v for v in total.values()) ** 0.5
            out.append((i, {f: v / max(norm, 1e-9) for f, v in total.items()}))
    return out


def test_latent_search_recalls_brute_force_neighbours(spark):
    """Of the passages whose TF-IDF cosine with an item is 0.6 or more at least 0.9 are candidates, paraphrases with other
    words in place of some among them; the sample is smaller than the table."""
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect()
    rng = random.Random(12)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    for k, r in enumerate(bench):  # every fifth word gives way to a word of another document
        other = words(docs[k * 7 % len(docs)]) or ["x"]
        docs[k] = " ".join([*words(docs[k])[:60], *(rng.choice(other) if rng.random() < 0.2 else w for w in words(r.text)), *words(docs[k])[60:120]])
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert len(docs) > decontam.MOST_DOCS
    weights = decontam.idf(*decontam.document_frequencies(df))
    table = decontam.latent_space(df, spark.createDataFrame([(r.text,) for r in bench], "text string"), weights)
    items = decontam._items(bench, table)
    latent = decontam.project(table, decontam.Words(pa.array(docs)))[0] @ items.vectors.T >= decontam.NEAR
    own, all_ = exact_vectors([r.text for r in bench], weights), exact_vectors(docs, weights)
    assert latent.shape == (len(all_), len(own))
    where = {}
    for j, (_, v) in enumerate(own):
        for f, x in v.items():
            where.setdefault(f, []).append((j, x))
    near, got = 0, 0
    for i, (_, v) in enumerate(all_):
        cosines = Counter()
        for f, x in v.items():
            for j, y in where.get(f, ()):
                cosines[j] += x * y
        for j, c in cosines.items():
            if c >= 0.6:
                near, got = near + 1, got + bool(latent[i, j])
    assert near >= len(bench) and got >= 0.9 * near, (got, near)


def test_latent_space_is_fitted_on_the_passages_of_all_documents(spark):
    """Over all passages of all documents, more than a sample ever had, the space's directions are uncorrelated and none is spread
    more than 1, which holds of no fit that has left documents out."""
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    weights = decontam.idf(*decontam.document_frequencies(df))
    table = decontam.latent_space(df, spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text"), weights)
    total = np.zeros((decontam.RANK, decontam.RANK))
    for text in docs:
        ids = np.array([xxhash.xxh3_64_intdigest(w, 17) % decontam.FEATURES for w in words(text)], np.int64)
        for k in range(max(1, -(-len(ids) // decontam.BLOCK) - decontam.WINDOW + 1) if len(ids) else 0):
            part = ids[k * decontam.BLOCK : (k + decontam.WINDOW) * decontam.BLOCK]
            y = table[part].sum(axis=0, dtype=np.float64) / max(float(np.sqrt((weights[part].astype(np.float64) ** 2).sum())), 1e-9)
            total += np.outer(y, y)
    share = np.diag(total)
    assert share.max() <= 1.001 and np.median(share) > 0.5
    assert np.abs(total - np.diag(share)).max() < 0.005
