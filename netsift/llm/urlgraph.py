"""URL rules, and for urls without one a verdict from trust and distrust that spread over edges between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, keep

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING = 0.85
STEPS = 12
KEEP_EVERY = 3
#: A host without a rule's verdict is blocked if its distrust is over this share of trust and distrust together.
BLOCK_OVER = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does. The rules are parameters, not data."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.coalesce(out, F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return out


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    return rows.withColumn("_r", longest_rule(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "_r.rule", "_r.verdict")


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: links between different hosts, and between a host and the domain above it, both ways.

    Absolute and protocol-relative links count once for each time they stand in a page; relative ones stay on their host.
    The domain edges tie subdomains together, also where pages have no absolute link at all.
    """
    host, _ = split_url(F.col("url"))
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?(?:https?:)?//([^\s/?#"'<>]+)"""), F.lit(1))
    found = pages.select(host.alias("src"), F.explode(links).alias("dst"))
    found = found.select("src", F.lower("dst").alias("dst")).where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    names = pages.select(host.alias("host")).distinct().where("host <> ''").unionByName(found.select(F.col("dst").alias("host")).distinct())
    parts = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    steps = names.select(F.explode(F.arrays_zip(F.slice(chain, 1, F.size(chain) - 1).alias("a"), F.slice(chain, 2, F.size(chain)).alias("b"))).alias("e")).select("e.a", "e.b").distinct()
    up = steps.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1.0).alias("weight"))
    down = steps.select(F.col("b").alias("src"), F.col("a").alias("dst"), F.lit(1.0).alias("weight"))
    return found.unionByName(up).unionByName(down).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def _normal(edges: DataFrame) -> DataFrame:
    total = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    return edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def propagate(edges: DataFrame, seeds: DataFrame, name: str, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """Personalised PageRank: host, score. edges: src, dst, weight; seeds: host, seed (summing to 1, or empty).

    Each step joins scores with edges by host and sums by target with partial sums first. What reaches a host without
    outgoing edges goes nowhere; scores are compared with each other only.
    """
    share = keep(_normal(edges), f"{name}-edges")
    start = keep(seeds.select("host", F.col("seed").alias("score")), f"{name}-seed")
    score = start
    kept = None
    for step in range(steps):
        moved = share.join(score.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (F.col("share") * F.col("score") * damping).alias("score"))
        back = start.select("host", (F.col("score") * (1 - damping)).alias("score"))
        score = moved.unionByName(back).groupBy("host").agg(F.sum("score").alias("score"))
        if step % KEEP_EVERY == KEEP_EVERY - 1:
            score = keep(score, f"{name}-score")
            forget(kept)
            kept = score
    return score


def host_scores(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """host, trust, distrust: from hosts with allowed pages along links, from hosts with blocked pages against them."""
    edges = keep(host_edges(pages), "host-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    seeds = verdicts.where("verdict is not null and host <> ''").groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad"))
    seeds = keep(seeds, "host-seeds")
    sums = seeds.agg(F.sum("good"), F.sum("bad")).first()
    good = seeds.where("good > 0").select("host", (F.col("good") / F.lit(float(sums[0] or 1))).alias("seed"))
    bad = seeds.where("bad > 0").select("host", (F.col("bad") / F.lit(float(sums[1] or 1))).alias("seed"))
    trust = propagate(edges, good, "trust").withColumnRenamed("score", "trust")
    distrust = propagate(back, bad, "distrust").withColumnRenamed("score", "distrust")
    return keep(trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"]), "host-scores")


def filter_urls(pages: DataFrame, rules=RULES, block_over: float = BLOCK_OVER) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of pages (page_id, url, html; others ignored).

    The longest fitting rule decides. Without one the host's scores do: block if distrust / (trust + distrust) is over
    block_over; a host that neither reaches, an empty host among them, is allowed. Null url: empty host and path. Null
    html: no links. Repeated rows are judged alike; an empty table gives none.
    """
    verdicts = judged(pages, rules)
    scores = host_scores(pages, verdicts)
    rows = verdicts.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    risk = F.col("distrust") > block_over * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("verdict", F.when(risk, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
