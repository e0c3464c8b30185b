"""Lexical features of domain names: one select of native expressions after the name is split by public suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import domains as d
from netsift.functions import text as t

#: n-gram dictionaries and the lengths looked for in each.
DICTIONARIES = {"phishing": {"bi": 2, "tri": 3, "tetra": 4, "penta": 5}, "malware": {"bi": 2, "tri": 3, "tetra": 4}, "dga": {"bi": 2, "tri": 3, "tetra": 4}}


def part_columns(s: str, prefix: str) -> dict[str, str]:
    """Counts and shares of character classes of s, which are 0 for an empty string."""
    n = f"length({s})"
    out = {}
    for name, cls in (("digit", "0-9"), ("vowel", t.VOWELS), ("consonant", t.CONSONANTS), ("hex", t.HEX)):
        out[f"{prefix}_{name}_count"] = t.count_class(s, cls)
        out[f"{prefix}_{name}_ratio"] = t.ratio(t.count_class(s, cls), n)
    other = f"length(regexp_replace({s}, '[\\\\p{{L}}\\\\p{{N}}]', ''))"
    out[f"{prefix}_non_alphanum_count"] = other
    out[f"{prefix}_non_alphanum_ratio"] = t.ratio(other, n)
    out[f"{prefix}_digit_count"] = f"cast({out[f'{prefix}_digit_count']} as double)"
    return out


def ngram_matches(df: DataFrame, ngrams: DataFrame | None, s: str = "_sub") -> DataFrame:
    """Columns lex_<dict>_<n>gram_matches: dictionary n-grams that s contains, each counted once; 0 without a dictionary.

    ngrams: dict, n, ngram. Each distinct s gives its n-grams as rows, which meet the dictionaries in an equi-join, however
    large these are.
    """
    wanted = [(f"lex_{k}_{word}gram_matches", k, n) for k, sizes in DICTIONARIES.items() for word, n in sizes.items()]
    if ngrams is None:
        return df.selectExpr("*", *[f"0 as {name}" for name, *_ in wanted])
    lengths = sorted({n for *_, n in wanted})
    each = ", ".join(f"transform({t.ngrams(s, n)}, g -> named_struct('n', {n}, 'ngram', g))" for n in lengths)
    own = df.where(F.col(s).isNotNull()).select(s).distinct().selectExpr(s, f"inline(concat({each}))")
    hits = own.join(ngrams.select("dict", "n", "ngram").distinct(), ["n", "ngram"]).groupBy(s)
    counts = hits.agg(*[F.count_if((F.col("dict") == k) & (F.col("n") == n)).cast("int").alias(name) for name, k, n in wanted])
    out = df.join(counts.withColumnRenamed(s, "_s"), F.col(s) == F.col("_s"), "left").drop("_s")
    return out.withColumns({name: F.when(F.col(s).isNotNull(), F.coalesce(name, F.lit(0))) for name, *_ in wanted})


def lexical_features(df: DataFrame, suffixes: DataFrame | None = None, ngrams: DataFrame | None = None) -> DataFrame:
    """df (domain_name and others) with 62 lex_ columns. Null names give null features."""
    base = d.split_names(df, "domain_name", suffixes).selectExpr(
        "*", "concat(replace(subdomain, '.', ''), sld) as _sub", "split(domain_name, '[.]') as _labels", "transform(split(domain_name, '[.]'), x -> length(x)) as _lengths"
    )
    name, sld, sub = "domain_name", "sld", "_sub"
    scores = ", ".join(f"'{k}', {v}D" for k, v in d.TLD_ABUSE.items())
    cols = {
        "lex_name_len": f"length({name})",
        "lex_has_digit": f"cast({name} rlike '[0-9]' as int)",
        "lex_phishing_keyword_count": t.contains_count(name, d.PHISHING_KEYWORDS),
        "lex_benign_keyword_count": t.contains_count(name, d.BENIGN_KEYWORDS),
        "lex_consecutive_chars": t.longest_run(name),
        "lex_tld_len": "length(suffix)",
        "lex_tld_abuse_score": f"coalesce(element_at(map({scores}), suffix), 0D)",
        "lex_tld_hash": t.simhash32("suffix"),
        "lex_sld_len": f"length({sld})",
        "lex_sld_norm_entropy": t.norm_entropy(sld),
        "lex_sld_phishing_keyword_count": t.contains_count(sld, d.PHISHING_KEYWORDS),
        **part_columns(sld, "lex_sld"),
        "lex_sub_count": "if(subdomain = '', 0, size(split(subdomain, '[.]')) - cast(array_contains(split(subdomain, '[.]'), 'www') as int))",
        "lex_stld_unique_char_count": f"size(array_distinct({t.chars('''concat(sld, replace(suffix, '.', ''))''')}))",
        "lex_begins_with_digit": f"cast({name} rlike '^[0-9]' as int)",
        "lex_www_flag": "cast(_labels[0] = 'www' as int)",
        "lex_sub_max_consonant_len": t.longest_match(f"lower({sub})", f"[{t.CONSONANTS}]+"),
        "lex_sub_norm_entropy": t.norm_entropy(sub),
        **part_columns(sub, "lex_sub"),
        "lex_avg_part_len": t.mean_of("_lengths"),
        "lex_stdev_part_lens": t.stddev_of("_lengths"),
        "lex_longest_part_len": "array_max(_lengths)",
        "lex_short_part_count": "size(filter(_lengths, x -> x <= 3))",
        "lex_medium_part_count": "size(filter(_lengths, x -> x between 4 and 10))",
        "lex_long_part_count": "size(filter(_lengths, x -> x between 11 and 30))",
        "lex_superlong_part_count": "size(filter(_lengths, x -> x >= 31))",
        # the dots are gone before the parts are measured, so this is the length of the whole
        "lex_shortest_sub_len": f"length({sub})",
        "lex_ipv4_in_domain": f"cast({t.ipv4_inside(name)} as int)",
        # the two lists are swapped in the definition of these columns, and a plain ending counts
        "lex_has_trusted_suffix": t.any_suffix(name, d.FAMOUS_SUFFIXES),
        "lex_has_wellknown_suffix": t.any_suffix(name, d.PROVIDER_SUFFIXES),
        "lex_has_cdn_suffix": t.any_suffix(name, d.CDN_SUFFIXES),
        "lex_has_vps_suffix": t.any_suffix(name, d.VPS_SUFFIXES),
        "lex_has_img_suffix": t.any_suffix(name, d.IMAGE_SUFFIXES),
    }
    out = ngram_matches(base.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()]), ngrams)
    score = " + ".join(f"lex_has_{k}_suffix * {v}" for k, v in d.SUFFIX_SCORES.items())
    return out.selectExpr("*", f"{score} as lex_suffix_score").drop("subdomain", "sld", "suffix", "_sub", "_labels", "_lengths")
