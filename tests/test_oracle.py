"""Every registered query with SQL gives what DuckDB gives on the same tables."""

from collections import Counter

import pytest

from netsift.operators.lexical import DICTIONARIES
from netsift.plans import catalog

from .conftest import SMALL


def ordered(rows):
    return sorted(tuple(map(repr, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    wanted = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert ordered(got) == ordered(wanted.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_widths_of_feature_groups(spark):
    count = lambda name, prefix: sum(c.startswith(prefix) for c in catalog.QUERIES[name](spark, SMALL).columns)
    assert count("lexical_features", "lex_") == 62
    assert count("html_features", "html_") == 87


def test_whole_dictionaries_are_matched(spark):
    freq = Counter()
    for r in spark.read.parquet(f"{SMALL}/part.parquet").select("p_partkey", "p_name").collect():
        name, kind = r.p_name.replace(" ", "").lower(), ("phishing", "malware", "dga")[r.p_partkey % 3]
        freq.update((kind, n, g) for n in (2, 3, 4, 5) for g in (name[i : i + n] for i in range(len(name) - n + 1)))
    known = {k for k, n in freq.items() if n > 1}
    assert len(known) > 200
    parts = {r.page_id: r.subdomain.replace(".", "") + r.sld for r in catalog.QUERIES["J8_public_suffix_split"](spark, SMALL).collect()}
    for r in catalog.QUERIES["lexical_features"](spark, SMALL).collect():
        s = parts[r.page_id]
        for kind, sizes in DICTIONARIES.items():
            for word, n in sizes.items():
                assert r[f"lex_{kind}_{word}gram_matches"] == len({g for g in (s[i : i + n] for i in range(len(s) - n + 1)) if (kind, n, g) in known})
