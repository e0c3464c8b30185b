"""Feature vectors from merged records: reading, conversion and all feature groups in their fixed order, as one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.conversion import flat_record
from netsift.operators.html import html_features
from netsift.operators.lexical import lexical_features
from netsift.operators.records import dns_features, drop_raw, geo_features, ip_features, rdap_features, rdap_ip_features, tls_features
from netsift.operators.routing import apply_transforms
from netsift.sources.results import MERGED, parse_merged, validate_merged

Groups = dict[str, Callable[[DataFrame], DataFrame]]


def feature_groups(country_ids: DataFrame, as_of: Column | None = None, suffixes: DataFrame | None = None, ngrams: DataFrame | None = None) -> Groups:
    """The groups by name in the order in which they are applied. as_of: the time that ages count to, else today's midnight."""
    day = as_of if as_of is not None else F.current_date().cast("timestamp")
    return {
        "html": html_features, "dns": dns_features, "ip": ip_features, "geo": lambda df: geo_features(df, country_ids), "tls": lambda df: tls_features(df, day),
        "lexical": lambda df: lexical_features(df, suffixes, ngrams), "rdap_dn": lambda df: rdap_features(df, day), "rdap_ip": rdap_ip_features, "drop": drop_raw,
    }


def vectors(merged: DataFrame, groups: Groups, enabled: list[str] | None = None) -> DataFrame:
    """A feature vector for each merged record (columns as MERGED has them, and domain): 264 columns with all groups."""
    return apply_transforms(flat_record(merged), groups, enabled)


def extract(raw: DataFrame, groups: Groups, enabled: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Vectors, and errors (domain_name, error), of messages: key is the domain, value the merged record as JSON text.

    Null values are skipped. Records that can't be read, or without a domain, are errors; dates, roles and addresses that
    can't be read within one are null, so that no record stops the others.
    """
    good, errors = validate_merged(parse_merged(raw, MERGED))
    return vectors(good.select(F.col("domain_name").alias("domain"), "data.*"), groups, enabled), errors


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Merged records of JSON files, each one record or a list of them, with domain_name inside: key and value as messages have them."""
    rows = spark.read.schema(f"domain_name string, {MERGED}, _corrupt_record string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    value = F.when(F.col("_corrupt_record").isNull(), F.to_json(F.struct(*[c for c in rows.columns if c not in ("domain_name", "_corrupt_record")]))).otherwise("broken")
    return rows.select(F.col("domain_name").alias("key"), value.alias("value"))


def extract_files(spark: SparkSession, path: str, out: str, groups: Groups, enabled: list[str] | None = None) -> DataFrame:
    """Write the vectors of the records in files under path as Parquet to out; the errors."""
    rows, errors = extract(read_records(spark, path), groups, enabled)
    rows.write.mode("overwrite").parquet(out)
    return errors
