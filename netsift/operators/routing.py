"""Routing of collection requests and uniform results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import codes

TIMEOUT_TEXT = "Timeout"
IP_TYPES = ("A", "AAAA", "CNAME")


def reject_arpa(domain: Column) -> Column:
    """Status code of a name before it is looked up."""
    return F.when(F.lower(domain).endswith(".arpa"), codes.INVALID_DOMAIN_NAME).otherwise(codes.OK)


def route_zone(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DNS and RDAP requests for good zone results, unless collect_dns or collect_rdap is false."""
    good = results.where("status_code = 0")
    wanted = lambda c: F.coalesce(F.col(c), F.lit(True))
    dns = good.where(wanted("collect_dns")).select("domain", "zone", "types_to_collect", "types_to_process_ips_from")
    return dns, good.where(wanted("collect_rdap")).select("domain", "zone")


def route_dns_ips(results: DataFrame) -> DataFrame:
    """An address request for each address of a good DNS result."""
    return results.where("status_code = 0").select("domain", F.explode("ips").alias("ip"))


def ip_for_tls() -> Column:
    """The address to fetch from: of the alias, else IPv4, else IPv6. The sets have no order, so the least one is taken."""
    least = lambda c: F.when(F.size(c) > 0, F.array_min(c))
    return F.coalesce(least(F.col("CNAME.related_ips")), least(F.col("A")), least(F.col("AAAA")))


def collector_requested(requests: DataFrame, collector: str) -> DataFrame:
    return requests.where(F.col("collectors").isNull() | F.array_contains("collectors", collector))


def classify_dns(outcomes: DataFrame) -> DataFrame:
    """domain, status_code, errors from per-type outcomes (domain, type, error): all failed is TIMEOUT if every error is a
    timeout, else OTHER_DNS_ERROR; otherwise OK with the errors by type."""
    rows = outcomes.groupBy("domain").agg(
        F.count("*").alias("n"), F.count("error").alias("failed"), F.bool_and(F.coalesce(F.col("error") == TIMEOUT_TEXT, F.lit(True))).alias("timeouts"),
        F.sort_array(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("type", "error")))).alias("e"),
    )
    code = F.when(F.col("failed") < F.col("n"), codes.OK).when(F.col("timeouts"), codes.TIMEOUT).otherwise(codes.OTHER_DNS_ERROR)
    return rows.select("domain", code.alias("status_code"), F.map_from_entries("e").alias("errors"))


def effective_types(requested: Column, configured: tuple[str, ...]) -> Column:
    return F.when(F.size(requested) > 0, requested).otherwise(F.array(*[F.lit(x) for x in configured]))


def _tag(kind: str) -> Callable[[Column], Column]:
    return lambda ip: F.struct(ip.alias("ip"), F.lit(kind).alias("rr_type"))


def ips_from_records(records: DataFrame, types: tuple[str, ...] = IP_TYPES) -> DataFrame:
    """domain, ip, rr_type: addresses in the chosen record types, each pair once. A, AAAA: array; CNAME: struct related_ips;
    MX, NS: array of struct related_ips."""
    tagged = []
    for kind in types:
        ips = F.col(kind) if kind in ("A", "AAAA") else F.col(f"{kind}.related_ips") if kind == "CNAME" else F.flatten(F.transform(kind, lambda x: x["related_ips"]))
        tagged.append(F.transform(F.coalesce(ips, F.array().cast("array<string>")), _tag(kind)))
    return records.select("domain", F.explode(F.array_distinct(F.concat(*tagged))).alias("x")).select("domain", "x.ip", "x.rr_type")


def select_transforms(groups: dict[str, Callable[[DataFrame], DataFrame]], enabled: list[str] | None = None) -> list[Callable[[DataFrame], DataFrame]]:
    """Feature groups in the fixed order of ``groups``, whatever the order asked for; None means all, unknown names are ignored."""
    return [f for name, f in groups.items() if enabled is None or name in enabled]


def apply_transforms(df: DataFrame, groups: dict[str, Callable[[DataFrame], DataFrame]], enabled: list[str] | None = None) -> DataFrame:
    for f in select_transforms(groups, enabled):
        df = df.transform(f)
    return df


def result_envelope(code: Column, error: Column | None = None, collector: str | None = None, data: Column | None = None, now: Column | None = None) -> Column:
    """The uniform result: statusCode, error, lastAttempt (ms), collector for address results, data on success."""
    fields = [code.cast("int").alias("statusCode"), (error if error is not None else F.lit(None).cast("string")).alias("error"), F.unix_millis(now if now is not None else F.current_timestamp()).alias("lastAttempt")]
    if collector is not None:
        fields.append(F.lit(collector).alias("collector"))
    if data is not None:
        fields.append(F.when(code == codes.OK, data).alias("data"))
    return F.struct(*fields)
