"""Scoring of feature vectors by a caller's model, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "domain_name string, aggregate_probability double, aggregate_description string, timestamp long, error string, classification_results array<struct<category: int, probability: double, description: string, details: map<string, string>>>"
CATEGORIES = {1: "phishing", 2: "malware", 3: "dga"}


def score(vectors: DataFrame, model: Callable[[pd.DataFrame], list[dict]]) -> DataFrame:
    """One result for each domain (RESULT). model takes a batch and returns a dict for each row.

    If it raises, each row of the batch gets probability -1 and the error. Rows without a domain are skipped.
    """
    fields = [f.split(" ")[0].strip() for f in RESULT.split(", ")[:5]] + ["classification_results"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                rows = model(batch)
            except Exception as e:  # noqa: BLE001  a model may fail in any way; its batch is reported, not lost
                rows = [{"domain_name": n, "aggregate_probability": -1.0, "aggregate_description": "", "timestamp": 0, "error": str(e), "classification_results": []} for n in batch["domain_name"]]
            yield pd.DataFrame([{f: r.get(f) for f in fields} for r in rows], columns=fields)

    return vectors.where("domain_name is not null and domain_name <> ''").mapInPandas(work, RESULT)


def result_rows(results: DataFrame) -> DataFrame:
    """One row for each domain and category."""
    names = F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv])
    rows = results.select("domain_name", "aggregate_probability", "timestamp", F.explode("classification_results").alias("r"))
    return rows.select("domain_name", "aggregate_probability", "timestamp", names[F.col("r.category")].alias("category"), "r.probability", "r.description")
