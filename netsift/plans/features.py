"""Registered feature queries over hosts and pages, names and line items, with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions import domains as d
from netsift.functions import text as t
from netsift.operators import html as h
from netsift.operators import lexical as lx

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
SUFFIX_LIST = "[" + ", ".join(f"'{s}'" for s in d.DEFAULT_SUFFIXES) + "]"
SPLIT_SQL = f"""
    hosts AS (SELECT page_id, {HOST_SQL} AS domain_name FROM pages),
    labelled AS (SELECT *, string_split(domain_name, '.') AS l FROM hosts),
    suffixed AS (SELECT *, CASE WHEN len(l) >= 3 AND list_contains({SUFFIX_LIST}, array_to_string(l[-3:], '.')) THEN 3
        WHEN len(l) >= 2 AND list_contains({SUFFIX_LIST}, array_to_string(l[-2:], '.')) THEN 2
        WHEN list_contains({SUFFIX_LIST}, l[-1]) THEN 1 ELSE 0 END AS n FROM labelled),
    parts AS (SELECT page_id, domain_name, l, CASE WHEN n > 0 THEN array_to_string(l[len(l) - n + 1:], '.') ELSE '' END AS suffix,
        CASE WHEN len(l) > n THEN l[len(l) - n] ELSE '' END AS sld,
        CASE WHEN len(l) > n + 1 THEN array_to_string(l[1:len(l) - n - 1], '.') ELSE '' END AS subdomain FROM suffixed)"""


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").selectExpr("page_id", f"{d.url_host('url')} as domain_name")


@query(f"WITH {SPLIT_SQL} SELECT page_id, domain_name, subdomain, sld, suffix FROM parts")
def J8_public_suffix_split(spark, sf_dir):
    return d.split_names(hosts(spark, sf_dir)).select("page_id", "domain_name", "subdomain", "sld", "suffix")


def _duck_count(s: str, cls: str) -> str:
    return f"length(regexp_replace({s}, '[^{cls}]', '', 'g'))"


def _duck_parts(s: str, p: str) -> str:
    out = []
    for name, cls in (("digit", "0-9"), ("vowel", t.VOWELS), ("consonant", t.CONSONANTS), ("hex", t.HEX)):
        c = _duck_count(s, cls)
        kind = "DOUBLE" if name == "digit" else "INTEGER"
        out += [f"CAST({c} AS {kind}) AS {p}_{name}_count", f"round(CASE WHEN length({s}) > 0 THEN {c} / length({s}) ELSE 0 END, 9) AS {p}_{name}_ratio"]
    c = f"length(regexp_replace({s}, '[\\p{{L}}\\p{{N}}]', '', 'g'))"
    return ", ".join([*out, f"CAST({c} AS INTEGER) AS {p}_non_alphanum_count", f"round(CASE WHEN length({s}) > 0 THEN {c} / length({s}) ELSE 0 END, 9) AS {p}_non_alphanum_ratio"])


def _duck_entropy(s: str) -> str:
    return f"round(CASE WHEN length({s}) > 0 THEN list_entropy(string_split({s}, '')) / length({s}) ELSE 0 END, 9)"


def _duck_contains(s: str, words) -> str:
    return f"CAST(len(list_filter([{', '.join(repr(w) for w in words)}], lambda w: contains({s}, w))) AS INTEGER)"


def _duck_suffix(s: str, suffixes) -> str:
    return f"CAST(({' OR '.join(f'suffix({s}, {x!r})' for x in suffixes)}) AS INTEGER)"


def _duck_simhash(s: str) -> str:
    value = f"list_transform(string_split({s}, ''), lambda c: CAST('0x' || substr(md5(c), 25, 8) AS BIGINT))"
    vote = f"len(list_filter({value}, lambda v: (v >> i) & 1 = 1)) * 2 >= length({s})"
    return f"CASE WHEN {s} = '' THEN 4294967295 ELSE CAST(list_sum(list_transform(range(32), lambda i: CASE WHEN {vote} THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT) END"


_SUFFIXES = {"trusted": d.FAMOUS_SUFFIXES, "wellknown": d.PROVIDER_SUFFIXES, "cdn": d.CDN_SUFFIXES, "vps": d.VPS_SUFFIXES, "img": d.IMAGE_SUFFIXES}
_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
LEXICAL_SQL = f"""WITH {SPLIT_SQL}, s AS (SELECT *, replace(subdomain, '.', '') || sld AS sub, list_transform(l, lambda x: length(x)) AS n FROM parts)
    SELECT page_id, domain_name, length(domain_name)::INTEGER AS lex_name_len, regexp_matches(domain_name, '[0-9]')::INTEGER AS lex_has_digit,
    {_duck_contains('domain_name', d.PHISHING_KEYWORDS)} AS lex_phishing_keyword_count, {_duck_contains('domain_name', d.BENIGN_KEYWORDS)} AS lex_benign_keyword_count,
    length(suffix)::INTEGER AS lex_tld_len, round(coalesce(CASE suffix {' '.join(f"WHEN '{k}' THEN {v}" for k, v in d.TLD_ABUSE.items())} END, 0)::DOUBLE, 9) AS lex_tld_abuse_score,
    {_duck_simhash('suffix')} AS lex_tld_hash, length(sld)::INTEGER AS lex_sld_len, {_duck_entropy('sld')} AS lex_sld_norm_entropy,
    {_duck_contains('sld', d.PHISHING_KEYWORDS)} AS lex_sld_phishing_keyword_count, {_duck_parts('sld', 'lex_sld')},
    CASE WHEN subdomain = '' THEN 0 ELSE len(string_split(subdomain, '.')) - list_contains(string_split(subdomain, '.'), 'www')::INTEGER END::INTEGER AS lex_sub_count,
    len(list_distinct(string_split(sld || replace(suffix, '.', ''), '')))::INTEGER AS lex_stld_unique_char_count, regexp_matches(domain_name, '^[0-9]')::INTEGER AS lex_begins_with_digit,
    (l[1] = 'www')::INTEGER AS lex_www_flag, coalesce(list_max(list_transform(regexp_extract_all(lower(sub), '[{t.CONSONANTS}]+'), lambda x: length(x))), 0)::INTEGER AS lex_sub_max_consonant_len,
    {_duck_entropy('sub')} AS lex_sub_norm_entropy, {_duck_parts('sub', 'lex_sub')},
    round(list_avg(n), 9) AS lex_avg_part_len, round(list_stddev_pop(n), 9) AS lex_stdev_part_lens, list_max(n)::INTEGER AS lex_longest_part_len,
    len(list_filter(n, lambda x: x <= 3))::INTEGER AS lex_short_part_count, len(list_filter(n, lambda x: x BETWEEN 4 AND 10))::INTEGER AS lex_medium_part_count,
    len(list_filter(n, lambda x: x BETWEEN 11 AND 30))::INTEGER AS lex_long_part_count, len(list_filter(n, lambda x: x >= 31))::INTEGER AS lex_superlong_part_count,
    length(sub)::INTEGER AS lex_shortest_sub_len, (regexp_matches(domain_name, '(?:{_OCTET}[.]){{3}}{_OCTET}') OR regexp_matches(domain_name, '(?:{_OCTET}-){{3}}{_OCTET}'))::INTEGER AS lex_ipv4_in_domain,
    {', '.join(f'{_duck_suffix("domain_name", v)} AS lex_has_{k}_suffix' for k, v in _SUFFIXES.items())},
    CAST({' + '.join(f'{_duck_suffix("domain_name", v)} * {d.SUFFIX_SCORES[k]}' for k, v in _SUFFIXES.items())} AS INTEGER) AS lex_suffix_score FROM s"""


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query(LEXICAL_SQL)
def lexical_core(spark, sf_dir):
    out = lx.lexical_features(hosts(spark, sf_dir))
    return rounded(out.drop("lex_consecutive_chars", *[c for c in out.columns if c.endswith("gram_matches")]))


def _duck_grams(s: str) -> str:
    return f"unnest(list_distinct(list_transform(range(1, greatest(length({s}) - n + 1, 1) + 1), lambda i: substr({s}, i, n))))"


_RUNS = "|".join([*(f"{c}+" for c in "abcdefghijklmnopqrstuvwxyz0123456789"), "-+", "[.]+"])
_GRAM_COLUMNS = ", ".join(f"(count(*) FILTER (WHERE dict = '{k}' AND n = {n}))::INTEGER AS lex_{k}_{word}gram_matches" for k, sizes in lx.DICTIONARIES.items() for word, n in sizes.items())
_GRAM_NAMES = ", ".join(f"coalesce(lex_{k}_{word}gram_matches, 0)::INTEGER AS lex_{k}_{word}gram_matches" for k, sizes in lx.DICTIONARIES.items() for word in sizes)


@query(
    f"""WITH core AS ({LEXICAL_SQL}), subs AS (WITH {SPLIT_SQL} SELECT page_id, replace(subdomain, '.', '') || sld AS sub FROM parts), sizes AS (SELECT unnest([2, 3, 4, 5]) AS n),
    names AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'phishing' WHEN 1 THEN 'malware' ELSE 'dga' END AS dict, p_partkey, lower(replace(p_name, ' ', '')) AS s FROM part),
    known AS (SELECT dict, n, gram FROM (SELECT dict, n, {_duck_grams("s")} AS gram FROM names, sizes) GROUP BY ALL HAVING count(*) > 1),
    own AS (SELECT page_id, n, {_duck_grams("sub")} AS gram FROM subs, sizes), hits AS (SELECT page_id, {_GRAM_COLUMNS} FROM own JOIN known USING (n, gram) GROUP BY 1)
    SELECT core.*, coalesce(list_max(list_transform(regexp_extract_all(domain_name, '{_RUNS}'), lambda x: length(x))), 0)::INTEGER AS lex_consecutive_chars, {_GRAM_NAMES} FROM core LEFT JOIN hits USING (page_id)"""
)
def lexical_features(spark, sf_dir):
    """All 62 columns; the dictionaries are the n-grams of the part names that stand in several of them."""
    names = read(spark, sf_dir, "part").selectExpr("lower(replace(p_name, ' ', '')) as s", "case pmod(p_partkey, 3) when 0 then 'phishing' when 1 then 'malware' else 'dga' end as dict")
    each = ", ".join(f"transform({t.ngrams('s', n)}, g -> named_struct('n', {n}, 'ngram', g))" for n in (2, 3, 4, 5))
    grams = names.selectExpr("dict", f"inline(concat({each}))").groupBy("dict", "n", "ngram").agg(F.count("*").alias("freq")).where("freq > 1")
    return rounded(lx.lexical_features(hosts(spark, sf_dir), ngrams=grams))


@query(
    f"""WITH hosts AS (SELECT page_id, {HOST_SQL} AS s FROM pages), g AS (SELECT * FROM (VALUES ('th'), ('ex'), ('er'), ('co'), ('zz')) t(ngram))
    SELECT page_id, count(ngram) AS bigram_matches FROM hosts LEFT JOIN g ON contains(s, ngram) GROUP BY page_id"""
)
def F10_ngram_matches(spark, sf_dir):
    grams = spark.sql("SELECT 'phishing' AS dict, 2 AS n, ngram FROM VALUES ('th'), ('ex'), ('er'), ('co'), ('zz') AS t(ngram)")
    out = lx.ngram_matches(hosts(spark, sf_dir), grams, "domain_name")
    return out.select("page_id", F.col("lex_phishing_bigram_matches").cast("bigint").alias("bigram_matches"))


@query(
    f"""SELECT p_partkey, {_duck_entropy('p_name')} AS entropy, {_duck_simhash('p_name')} AS simhash,
    list_reduce([0::BIGINT, 0, 1, 2, 3], lambda z, i: (z * 4294967296 + CAST('0x' || substr(md5(p_name), (i * 8 + 1)::INTEGER, 8) AS BIGINT)) % 2147483647) AS md5_mod,
    coalesce(list_max(list_transform(regexp_extract_all(p_name, '{"|".join(f"{c}+" for c in "abcdefghijklmnopqrstuvwxyz ")}'), lambda x: length(x))), 0)::INTEGER AS longest_run FROM part"""
)
def F1_F2_F3_F9_names(spark, sf_dir):
    s = "p_name"
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"round({t.norm_entropy(s)}, 9) as entropy", f"{t.simhash32(s)} as simhash", f"{t.md5_mod(s)} as md5_mod",
        f"{t.longest_run('''regexp_replace(p_name, '[^a-z ]', '')''')} as longest_run",
    )


ORACLE_SQL["F1_F2_F3_F9_names"] = ORACLE_SQL["F1_F2_F3_F9_names"].replace("regexp_extract_all(p_name, '", "regexp_extract_all(regexp_replace(p_name, '[^a-z ]', '', 'g'), '")

_ITEMS = "WITH o AS (SELECT l_orderkey, list(CAST(l_quantity AS BIGINT) ORDER BY l_linenumber) AS a FROM lineitem GROUP BY l_orderkey)"


def order_arrays(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q")))).alias("s"))
    return rows.selectExpr("l_orderkey", "transform(s, x -> x.q) as a")


@query(
    _ITEMS + """ SELECT l_orderkey, len(a)::INTEGER AS n, len(list_distinct(a))::INTEGER AS distinct_count, round(list_avg(a), 9) AS mean, round(CASE WHEN len(a) > 1 THEN list_stddev_pop(a) ELSE 0 END, 9) AS stdev,
    list_min(a) AS least, list_max(a) AS most, round(list_entropy(a), 9) AS entropy, round(len(list_filter(a, lambda x: x < 20)) / len(a), 9) AS low, round(len(list_filter(a, lambda x: x >= 20 AND x < 40)) / len(a), 9) AS mid,
    array_to_string(list_sort(list_distinct(a)), ',') AS sorted_distinct, round(list_max(list_transform(list_distinct(a), lambda x: len(list_filter(a, lambda y: y = x)))) / len(a), 9) AS mode_share FROM o"""
)
def A8_A9_A10_F7_P15_arrays(spark, sf_dir):
    a = "a"
    return order_arrays(spark, sf_dir).selectExpr(
        "l_orderkey", "size(a) as n", "size(array_distinct(a)) as distinct_count", f"round({t.mean_of(a)}, 9) as mean", f"round({t.stddev_of(a)}, 9) as stdev", "array_min(a) as least", "array_max(a) as most",
        f"round({t.entropy_of(a)}, 9) as entropy", f"round({t.share_between(a, 0, 20)}, 9) as low", f"round({t.share_between(a, 20, 40)}, 9) as mid", f"array_join({t.sorted_distinct(a)}, ',') as sorted_distinct", f"round({t.mode_share(a)}, 9) as mode_share",
    )


@query(
    """SELECT l_orderkey, round(1e-7 + coalesce(sum(l_extendedprice * l_quantity) FILTER (WHERE l_returnflag <> 'R') / sum(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 0), 4) AS weighted_rtt
    FROM lineitem GROUP BY l_orderkey"""
)
def A6_weighted_rtt(spark, sf_dir):
    item = F.struct(F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("status_code"), F.col("l_extendedprice").cast("double").alias("avg"), F.col("l_quantity").cast("double").alias("received"))
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("r"))
    return rows.selectExpr("l_orderkey", f"round(1e-7 + {t.weighted_rtt('r')}, 4) as weighted_rtt")


_BODY = r"regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<!--.*?-->', '', 'gs'), '(<script\b[^>]*>).*?</script\s*>', '\1', 'gis'), '(<style\b[^>]*>).*?</style\s*>', '\1', 'gis')"
_JS = r"array_to_string(list_filter(regexp_extract_all(regexp_replace(coalesce(html, ''), '<!--.*?-->', '', 'gs'), '<script\b[^>]*>.*?</script\s*>', 0, 'is'), lambda x: NOT regexp_matches(x, '^<script[^>]*\ssrc\s*=', 'i')), '')"
_WORDS = r"list_filter(regexp_split_to_array(html, '\s+'), lambda x: x <> '')"
_PLAIN_CALLS = {k: v.replace("\\\\", "\\") for k, v in h.SCRIPT_CALLS.items()}
_NAMED = {"paragraphs": "p", "divs": "div", "titles": "title", "links": "link", "scripts": "script", "anchors": "a", "inputs": "input", "objects": "object", "embeds": "embed", "frame": "frame", "iframe": "iframe", "center": "center", "imgs": "img", "meta": "meta", "strong": "strong"}


def _duck_call(key: str) -> str:
    if key == "escape":
        return r"len(regexp_extract_all(js, 'escape\(')) - len(regexp_extract_all(js, 'nescape\('))"
    return f"len(regexp_extract_all(js, '{_PLAIN_CALLS[key]}'))"


@query(
    rf"""WITH h AS (SELECT page_id, coalesce(html, '') AS html, {_JS} AS js FROM pages)
    SELECT page_id, len({_WORDS})::INTEGER AS html_num_of_words, len(list_distinct({_WORDS}))::INTEGER AS html_unique_words, round(length(regexp_replace(html, '\s', '', 'g')) / len({_WORDS}), 9) AS html_average_word_len,
    regexp_matches(html, '\b(suspended|blocked|forbidden|denied|restricted)\b', 'i')::INTEGER AS html_blocked_keywords_label, len(regexp_extract_all(html, '\s{{2,}}'))::INTEGER AS html_num_of_blank_spaces,
    {', '.join(f'({_duck_call(k)})::INTEGER AS html_{k}' for k in h.SCRIPT_CALLS)} FROM h"""
)
def html_text_and_scripts(spark, sf_dir):
    out = h.html_features(read(spark, sf_dir, "pages").select("page_id", "html"))
    return rounded(out.select("page_id", *[c for c in h.text_columns("html") if c != "html_num_of_lines"], *[f"html_{k}" for k in h.SCRIPT_CALLS]))


@query(
    rf"""WITH h AS (SELECT page_id, {_BODY} AS body FROM pages)
    SELECT page_id, {', '.join(f"len(regexp_extract_all(body, '<{tag}(?:[\\s/][^<>]*)?>', 0, 'i'))::INTEGER AS html_num_of_{k}" for k, tag in _NAMED.items())} FROM h""".replace("\\\\s", "\\s")
)
def html_tags(spark, sf_dir):
    out = h.html_features(read(spark, sf_dir, "pages").select("page_id", "html"))
    return out.select("page_id", *[f"html_num_of_{k}" for k in _NAMED])


@query()
def html_features(spark, sf_dir):
    return rounded(h.html_features(read(spark, sf_dir, "pages").select("page_id", "html")).drop("html"))
