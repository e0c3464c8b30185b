"""Merging of collector results per domain and address, as aggregations.

"More useful" keeps a good result over a bad one, then the newer, then the first to arrive. As a fold over arrivals that is
an arg-max on (good, time, -offset), so partial aggregation applies and the order of rows doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOMAIN_COLLECTORS = {"zone": "zone", "dns": "dns", "rdap-dn": "rdap", "tls": "tls"}
#: Collectors of addresses that take part in the merge.
IP_COLLECTORS = ("geo-asn", "nerd", "rdap-ip", "rtt")
ENTRY = ("value", "status_code", "error", "ts", "offset")
ENTRY_TYPE = "struct<value:string, status_code:int, error:string, ts:timestamp, offset:bigint>"
_DNS = "ips array<struct<ip:string>>, dnsData struct<A:array<string>, AAAA:array<string>, CNAME:struct<relatedIPs:array<string>>>, _bad string"


def fitness() -> Column:
    return F.struct((F.col("status_code") == 0).alias("good"), F.col("ts").alias("ts"), (-F.col("offset")).alias("first"))


def _entry() -> Column:
    return F.struct(*ENTRY)


def more_useful(results: DataFrame, *keys: str) -> DataFrame:
    """The most useful result of each key, as ``entry``."""
    return results.groupBy(*keys).agg(F.max_by(_entry(), fitness()).alias("entry"))


def dns_info(value: Column) -> Column:
    """What the merge reads of a DNS result: addresses (ips), and whether it has any of A, AAAA or CNAME, which TLS can be asked
    of (wants_tls). Null if the payload is missing or can't be read."""
    got = F.from_json(F.when(F.trim(value) != "", value), _DNS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    ips = F.array_distinct(F.filter(F.transform(got["ips"], lambda x: x["ip"]), lambda x: x.isNotNull() & (x != "")))
    own = F.struct(ips.alias("ips"), (some(got["dnsData"]["A"]) | some(got["dnsData"]["AAAA"]) | some(got["dnsData"]["CNAME"]["relatedIPs"])).alias("wants_tls"))
    return F.when(got.isNotNull() & got["_bad"].isNull(), own)


def domain_aggregate(results: DataFrame, *keys: str) -> DataFrame:
    """domain (and other keys), zone, dns, rdap, tls (entries or null), dns_ips, wants_tls (null without a readable DNS result):
    one pass and one shuffle for all collectors."""
    own = {name: F.col("collector") == c for c, name in DOMAIN_COLLECTORS.items()}
    rows = results.where(F.col("collector").isin(*DOMAIN_COLLECTORS))
    rows = rows.groupBy("domain", *keys).agg(*[F.max_by(F.when(is_, _entry()), F.when(is_, fitness())).alias(name) for name, is_ in own.items()])
    return rows.withColumn("_info", dns_info(F.col("dns.value"))).withColumns({"dns_ips": F.col("_info.ips"), "wants_tls": F.col("_info.wants_tls")}).drop("_info")


def domain_complete() -> Column:
    """zone, dns and rdap are there, and tls too unless DNS has no address that it could have been fetched from."""
    enough = F.col("wants_tls").isNotNull() & (F.col("tls").isNotNull() | ~F.col("wants_tls"))
    return F.col("zone").isNotNull() & F.col("dns").isNotNull() & F.col("rdap").isNotNull() & enough


def split_by_ips(aggregates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Aggregates with DNS addresses, which go to the address merge, and those without, which are final."""
    some = F.coalesce(F.size("dns_ips") > 0, F.lit(False))
    return aggregates.where(some), aggregates.where(~some)


def mergeable(ip_results: DataFrame, collectors: tuple[str, ...] = IP_COLLECTORS) -> DataFrame:
    return ip_results.where(F.col("collector").isin(*collectors))


def ip_aggregate(ip_results: DataFrame, collectors: tuple[str, ...] = IP_COLLECTORS, keys: tuple[str, ...] = ()) -> DataFrame:
    """domain (and other keys), ips: map of address to map of collector to its most useful entry."""
    best = more_useful(mergeable(ip_results, collectors), "domain", *keys, "ip", "collector")
    per_ip = best.groupBy("domain", *keys, "ip").agg(F.sort_array(F.collect_list(F.struct("collector", "entry"))).alias("entries"))
    rows = per_ip.groupBy("domain", *keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("ip", "entries")))).alias("ips"))
    return rows.withColumn("ips", F.transform_values("ips", lambda _, e: F.map_from_entries(e)))


def expected_ips() -> Column:
    return F.array_sort(F.array_union(F.coalesce("dns_ips", F.array().cast("array<string>")), F.coalesce(F.map_keys("ips"), F.array().cast("array<string>"))))


def ip_complete(collectors: tuple[str, ...] = IP_COLLECTORS) -> Column:
    """Every expected address has a result of every collector."""
    required = F.array(*[F.lit(c) for c in collectors])
    none = F.array().cast("array<string>")
    return F.forall(expected_ips(), lambda ip: F.size(F.array_except(required, F.coalesce(F.map_keys(F.col("ips")[ip]), none))) == 0)


def merge_domain_ip(aggregates: DataFrame, ips: DataFrame, collectors: tuple[str, ...] = IP_COLLECTORS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates with the results of their addresses, addresses without results being empty maps; ips is null where DNS has no
    address. Results of unknown domains are dropped."""
    none = F.expr(f"cast(map() as map<string, {ENTRY_TYPE}>)")
    seen = F.coalesce("ips", F.expr(f"cast(map() as map<string, map<string, {ENTRY_TYPE}>>)"))
    every = F.array_sort(F.array_union("dns_ips", F.map_keys(seen)))
    rows = aggregates.join(ips, ["domain", *keys], "left")
    rows = rows.withColumn("ips", F.when(F.size("dns_ips") > 0, F.map_from_entries(F.transform(every, lambda ip: F.struct(ip, F.coalesce(seen[ip], none))))))
    return rows.withColumn("is_complete", domain_complete() & F.when(F.col("ips").isNull(), True).otherwise(ip_complete(collectors)))


def merge_batch(domain_results: DataFrame, ip_results: DataFrame, collectors: tuple[str, ...] = IP_COLLECTORS) -> DataFrame:
    """The whole merge of a finished period: domains with zone and dns, with is_complete. All results of a domain are one life;
    merge_lives() tells lives apart."""
    rows = domain_aggregate(domain_results).where("zone is not null and dns is not null")
    return merge_domain_ip(rows, ip_aggregate(ip_results, collectors), collectors)


def earliest_ts() -> Column:
    """The earliest time of all entries of a merged row."""
    own = [F.col(f"{c}.ts") for c in ("zone", "dns", "rdap", "tls")]
    maps = F.coalesce(F.map_values("ips"), F.expr(f"cast(array() as array<map<string, {ENTRY_TYPE}>>)"))
    inner = F.array_min(F.flatten(F.transform(maps, lambda m: F.transform(F.map_values(m), lambda e: e["ts"]))))
    return F.least(*own, inner)


def _micros(ts: Column | str) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def with_lives(domain_results: DataFrame, ip_results: DataFrame, gap: int = 60) -> tuple[DataFrame, DataFrame]:
    """Both with ``life``, the time of the first result of the domain's life, be it of the domain or of an address: a life ends
    when no result came for ``gap`` seconds.

    Time is cut into spans of that length. Results of one span are closer than the gap, so a span belongs to one life, and what
    has to be put in order is the first and last time of each span and domain, not the results. They then find their life by
    domain and span: a domain of any number of results is spread over tasks.
    """
    width = gap * 1_000_000
    spanned = [df.withColumn("_span", F.floor(_micros("ts") / width)) for df in (domain_results, ip_results)]
    spans = spanned[0].select("domain", "_span", "ts").unionByName(spanned[1].select("domain", "_span", "ts")).groupBy("domain", "_span").agg(F.min("ts").alias("_a"), F.max("ts").alias("_b"))
    order = Window.partitionBy("domain").orderBy("_span")
    begins = F.coalesce(_micros("_a") - _micros(F.lag("_b").over(order)) >= width, F.lit(True))
    lives = spans.withColumn("_first", F.when(begins, F.col("_a"))).withColumn("life", F.last("_first", True).over(order)).select("domain", "_span", "life")
    own, per_ip = (df.join(lives, ["domain", "_span"]).drop("_span") for df in spanned)
    return own, per_ip


def merge_lives(domain_results: DataFrame, ip_results: DataFrame, gap: int = 60, collectors: tuple[str, ...] = IP_COLLECTORS) -> DataFrame:
    """merge_batch() of each life (a column) of each domain. This is what the stream gives last for a life, unless results come
    later than its grace after a complete one: there they begin another life, here they belong to the same."""
    own, per_ip = with_lives(domain_results, ip_results, gap)
    rows = domain_aggregate(own, "life").where("zone is not null and dns is not null")
    return merge_domain_ip(rows, ip_aggregate(per_ip, collectors, ("life",)), collectors, ("life",))


def lifetimes(results: DataFrame, gap: str = "60 seconds") -> DataFrame:
    """Lives (life_start, life_end) of domains, the number of their results and these results' offsets in ascending order, all in
    one row: a gap without results ends a life."""
    rows = results.groupBy("domain", F.session_window("ts", gap).alias("life")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("offset")).alias("offsets"))
    return rows.select("domain", F.col("life.start").alias("life_start"), F.col("life.end").alias("life_end"), "n", "offsets")
