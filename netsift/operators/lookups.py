"""Lookups of domains and addresses in tables: all equi-joins, networks by their leading bits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import codes
from netsift.functions.domains import split_names

V4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
GROUP = r"^[0-9A-Fa-f]{1,4}$"
_V4_AT_END = r"^(.*:)([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})$"


def _v4_hex(ip: Column) -> Column:
    return F.array_join(F.transform(F.split(ip, r"\."), lambda x: F.lpad(F.lower(F.hex(x.cast("bigint"))), 2, "0")), "")


def address_hex(ip: Column) -> Column:
    """An address as fixed-width hex, 8 digits for IPv4 and 32 for IPv6, which compares like the number; null if it is none.

    IPv6 is read strictly: eight groups, or fewer with one ``::`` for at least one, the last two maybe written as IPv4. An address
    that maps an IPv4 one (::ffff:1.2.3.4) is that one.
    """
    inner = F.regexp_extract(ip, _V4_AT_END, 2)
    digits = _v4_hex(inner)
    plain = F.when(inner == "", ip).when(inner.rlike(V4), F.concat(F.regexp_extract(ip, _V4_AT_END, 1), F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4)))
    halves = F.split(plain, "::")
    none = F.array().cast("array<string>")
    groups = lambda x: F.when(x == "", none).otherwise(F.split(x, ":"))
    head, tail = groups(F.get(halves, 0)), F.when(F.size(halves) == 2, groups(F.get(halves, 1))).otherwise(none)
    n = F.size(head) + F.size(tail)
    whole = F.when(F.size(halves) == 1, n == 8).otherwise((F.size(halves) == 2) & (n <= 7))
    fits = whole & F.forall(F.concat(head, tail), lambda x: x.rlike(GROUP))
    fill = F.array_repeat(F.lit("0"), F.greatest(8 - n, F.lit(0)))
    v6 = F.array_join(F.transform(F.concat(head, fill, tail), lambda x: F.lpad(F.lower(x), 4, "0")), "")
    return F.when(ip.rlike(V4), _v4_hex(ip)).when(F.contains(ip, F.lit(":")) & fits, F.when(v6.startswith("0" * 20 + "ffff"), F.substring(v6, 25, 8)).otherwise(v6))


def known_names(seeds: DataFrame, known: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Seeds (name, ...) that are not known yet, one row a name, and the counts stored and duplicates. force keeps all."""
    own = seeds.dropDuplicates(["name"])
    fresh = own if force else own.join(known.select("name").distinct(), "name", "left_anti")
    total = seeds.agg(F.count("*").alias("seen"))
    counts = fresh.agg(F.count("*").alias("stored")).crossJoin(total).select("stored", (F.col("seen") - F.col("stored")).alias("duplicates"))
    return fresh, counts


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges (ip_start, ip_end: hex) as the fewest networks that cover them, two for each bit of an address at most: _p and _k, the
    length and the first bits of each, and _end; without ip_end, prefix says where it is. An upside-down range is no network."""
    for batch in batches:
        rows, lengths, keys, ends = [], [], [], []
        for i, (start, end, prefix) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("ip_start", "ip_end", "_prefix")))):
            if not start or (end and len(end) != len(start)) or (not end and prefix is None):
                continue
            bits, a = 4 * len(start), int(start, 16)
            if not end:
                a = a >> bits - prefix << bits - prefix
            z = int(end, 16) if end else a | (1 << bits - prefix) - 1
            while a <= z:
                # the largest block that begins at a and ends before z
                free = min(bits if a == 0 else (a & -a).bit_length() - 1, (z - a + 1).bit_length() - 1)
                rows.append(i)
                lengths.append(bits - free)
                keys.append(f"{a:0{len(start)}x}")
                ends.append(f"{z:0{len(start)}x}")
                a += 1 << free
        held = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*held.columns, pa.array(lengths, pa.int32()), pa.array(keys, pa.string()), pa.array(ends, pa.string())], [*batch.schema.names, "_p", "_start", "_end"])


def range_lookup(addresses: DataFrame, networks: DataFrame, ip: str = "ip", out: str = "network") -> DataFrame:
    """addresses with struct ``out``: the narrowest of networks that holds the address, of equals the one that starts last; null if
    none does.

    networks: version, ip_start, ip_end (hex, inclusive), others: any ranges; where ip_end is null or empty, prefix_len tells it. Each is cut into the fewest networks that cover it,
    those that share their first bits, so this is an equi-join: each distinct address is asked once for every prefix length
    that its version has (the lengths are a table of at most 162 rows).
    """
    kept = [c for c in networks.columns if c != "version"]
    prefix = F.col("prefix_len").cast("int") if "prefix_len" in networks.columns else F.lit(None).cast("int")
    named = networks.withColumn("_n", F.struct(*kept)).select(F.col("version").alias("_v"), "ip_start", "ip_end", prefix.alias("_prefix"), "_n")
    schema = f"_v {named.schema['_v'].dataType.simpleString()}, ip_start string, ip_end string, _prefix int, _n {named.schema['_n'].dataType.simpleString()}, _p int, _start string, _end string"
    nets = named.mapInArrow(_prefixes, schema).withColumn("_k", _leading(F.col("_start"), F.col("_p")))
    lengths = nets.select("_v", "_p").distinct().groupBy("_v").agg(F.collect_set("_p").alias("_ps"))
    hexed = addresses.select(ip).distinct().withColumn("_x", address_hex(F.col(ip))).where("_x is not null").withColumn("_v", F.when(F.length("_x") == 8, 4).otherwise(6))
    keys = hexed.join(F.broadcast(lengths), "_v").select(ip, "_v", F.col("_x"), F.explode("_ps").alias("_p")).select(ip, "_v", "_p", _leading(F.col("_x"), F.col("_p")).alias("_k"))
    hit = keys.join(nets, ["_v", "_p", "_k"])
    # the smallest width is the largest once its digits are turned round
    best = hit.groupBy(ip).agg(F.max_by("_n", F.struct(F.translate(_width("ip_start", "_end"), "0123456789abcdef", "fedcba9876543210").alias("w"), F.col("ip_start"))).alias(out))
    return addresses.join(best, ip, "left")


def _width(start: str, end: str) -> Column:
    """end - start of hex numbers, digit by digit from the right with a borrow, as hex of the same length."""
    digit = lambda c, i: F.conv(F.substring(c, i, F.lit(1)), 16, 10).cast("int")
    step = lambda z, i: F.struct(
        F.concat(F.lower(F.conv(F.pmod(digit(F.col(end), i) - digit(F.col(start), i) - z["borrow"], F.lit(16)).cast("string"), 10, 16)), z["text"]).alias("text"),
        F.when(digit(F.col(end), i) - digit(F.col(start), i) - z["borrow"] < 0, 1).otherwise(0).alias("borrow"),
    )
    places = F.sequence(F.length(start), F.lit(1), F.lit(-1))
    return F.aggregate(places, F.struct(F.lit("").alias("text"), F.lit(0).alias("borrow")), step)["text"]


def _leading(hexed: Column, bits: Column) -> Column:
    """The first bits of a number in hex, as its whole leading digits and what is left of the next one."""
    whole, left = F.floor(bits / 4).cast("int"), F.pmod(bits, F.lit(4)).cast("int")
    digit = F.conv(F.substring(hexed, whole + 1, F.lit(1)), 16, 10).cast("int")
    return F.concat(F.substring(hexed, F.lit(1), whole), F.lit("/"), F.when(left > 0, F.call_function("shiftright", digit, 4 - left)).otherwise(0).cast("string"))


def geo_asn(addresses: DataFrame, cities: DataFrame, networks: DataFrame, ip: str = "ip") -> DataFrame:
    """addresses with geo, asn and status_code: both tables are searched independently; neither found is NOT_FOUND."""
    rows = range_lookup(range_lookup(addresses, cities, ip, "geo"), networks, ip, "asn")
    bad = address_hex(F.col(ip)).isNull()
    none = F.col("geo").isNull() & F.col("asn").isNull()
    return rows.withColumn("status_code", F.when(bad, codes.INVALID_ADDRESS).when(none, codes.NOT_FOUND).otherwise(codes.OK))


def reputation(addresses: DataFrame, scores: DataFrame | None, ip: str = "ip") -> DataFrame:
    """addresses with reputation and status_code: IPv4 only; a table of None means that the source is switched off."""
    if scores is None:
        return addresses.withColumns({"reputation": F.lit(None).cast("double"), "status_code": F.lit(codes.DISABLED)})
    rows = addresses.join(scores.select(F.col("ip").alias("_ip"), "reputation"), F.col(ip) == F.col("_ip"), "left").drop("_ip")
    kind = address_hex(F.col(ip))
    code = F.when(kind.isNull(), codes.INVALID_ADDRESS).when(F.length(kind) == 32, codes.UNSUPPORTED_ADDRESS).when(F.col("reputation").isNull(), codes.NOT_FOUND).otherwise(codes.OK)
    return rows.withColumn("reputation", F.when(F.length(kind) == 8, F.col("reputation"))).withColumn("status_code", code)


def siem(addresses: DataFrame, sources: DataFrame, offenses: DataFrame, ip: str = "ip") -> DataFrame:
    """addresses with source_id, magnitude and offenses (sorted, distinct ids) of the source address; else NOT_FOUND.

    sources: source_id, ip, magnitude; offenses: offense_id, source_ids. The many-to-many relation is exploded and grouped
    by source before the address join.
    """
    by_source = offenses.select("offense_id", F.explode("source_ids").alias("source_id")).groupBy("source_id").agg(F.array_sort(F.collect_set("offense_id")).alias("offenses"))
    rows = sources.join(by_source, "source_id", "left").select(F.col("ip").alias("_ip"), "source_id", "magnitude", F.coalesce("offenses", F.array().cast("array<bigint>")).alias("offenses"))
    rows = addresses.join(rows, F.col(ip) == F.col("_ip"), "left").drop("_ip")
    return rows.withColumn("status_code", F.when(F.col("source_id").isNull(), codes.NOT_FOUND).otherwise(codes.OK))


def zone(domains: DataFrame, zones: DataFrame, suffixes: DataFrame | None = None, name: str = "domain_name") -> DataFrame:
    """domains with zone: the deepest known zone from the registered domain down to the name; names that are a suffix are
    looked up themselves; addresses and names of unknown suffix have none."""
    parts = split_names(domains.select(name).distinct(), name, suffixes)
    labels = F.split(F.lower(F.col(name)), r"\.")
    shortest = F.when(F.col("sld") == "", F.size(labels)).otherwise(F.size(F.split("suffix", r"\.")) + 1)
    tails = F.transform(F.sequence(shortest, F.size(labels)), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    own = parts.where(F.col("suffix") != "").select(name, F.posexplode(tails).alias("depth", "zone"))
    best = own.join(zones.select("zone").distinct(), "zone").groupBy(name).agg(F.max_by("zone", "depth").alias("zone"))
    rows = domains.join(best, name, "left")
    return rows.withColumn("status_code", F.when(F.col("zone").isNull(), codes.NOT_FOUND).otherwise(codes.OK))


def zone_nameservers(rows: DataFrame) -> DataFrame:
    """rows (primary, primary_ips, nameservers, nameserver_ips map) with secondary and secondary_ips, both without the primary's."""
    secondary = F.array_sort(F.array_except(F.array_distinct("nameservers"), F.array("primary")))
    ips = F.flatten(F.transform(F.col("secondary"), lambda s: F.coalesce(F.col("nameserver_ips")[s], F.array().cast("array<string>"))))
    return rows.withColumn("secondary", secondary).withColumn("secondary_ips", F.array_sort(F.array_except(F.array_distinct(ips), "primary_ips")))


def known_tld(domains: DataFrame, tlds: DataFrame, name: str = "domain_name") -> DataFrame:
    """domains with rest, tld and endpoint: the last two labels if they are registered, else the last one, else null."""
    labels = F.split(F.lower(F.col(name)), r"\.")
    n = F.size(labels)
    rows = domains.withColumns({"_2": F.when(n >= 2, F.array_join(F.slice(labels, -2, 2), ".")), "_1": F.element_at(labels, -1)})
    for k in (1, 2):
        rows = rows.join(tlds.select(F.col("tld").alias(f"_t{k}"), F.col("endpoint").alias(f"_e{k}")), F.col(f"_{k}") == F.col(f"_t{k}"), "left")
    tld = F.coalesce("_t2", "_t1")
    rest = n - F.size(F.split(tld, r"\."))
    return rows.withColumns({"tld": tld, "endpoint": F.coalesce("_e2", "_e1"), "rest": F.when(tld.isNotNull() & (rest > 0), F.array_join(F.slice(labels, F.lit(1), rest), ".")).when(tld.isNotNull(), "")}).drop("_1", "_2", "_t1", "_t2", "_e1", "_e2")


def rdap_target(requests: DataFrame, responses: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """requests (domain, zone) with target, status_code and needs_whois.

    responses: name, status_code. The zone, or else the domain, is asked first, then the registered domain if it differs;
    WHOIS is needed only if both fail.
    """
    first = F.coalesce("zone", "domain")
    rows = split_names(requests.withColumn("_first", first), "_first", suffixes).withColumn("_second", F.when(F.col("sld") != "", F.concat_ws(".", "sld", "suffix")))
    for k in ("_first", "_second"):
        rows = rows.join(responses.select(F.col("name").alias(f"{k}_n"), F.col("status_code").alias(f"{k}_code")), F.col(k) == F.col(f"{k}_n"), "left")
    ok1, ok2 = F.col("_first_code").eqNullSafe(0), F.col("_second_code").eqNullSafe(0) & (F.col("_second") != F.col("_first"))
    code = F.when(ok1 | ok2, codes.OK).otherwise(F.coalesce("_first_code", F.lit(codes.NO_ENDPOINT)))
    return rows.select(*requests.columns, F.when(~ok1 & ok2, F.col("_second")).otherwise(F.col("_first")).alias("target"), code.alias("status_code"), (code != codes.OK).alias("needs_whois"))


def collector_ids(results: DataFrame, dimension: DataFrame) -> tuple[DataFrame, DataFrame]:
    """results with collector_id, and error rows for collectors that dimension (collector, collector_id) lacks."""
    rows = results.join(dimension, "collector", "left")
    return rows.where("collector_id is not null"), rows.where("collector_id is null").drop("collector_id").withColumn("error", F.concat(F.lit("Unknown collector: "), F.coalesce("collector", F.lit("null"))))


def resolve_entities(records: DataFrame, entities: DataFrame, key: str = "domain") -> DataFrame:
    """records with entities resolved: one with a self link and no card becomes the linked one, keeping its roles.

    records: key, entities array<struct<handle, roles, href, has_card, name>>; entities: href, handle, name.
    """
    one = records.select(key, F.posexplode("entities").alias("i", "e"))
    linked = entities.select(F.col("href").alias("_href"), F.struct(F.col("handle").alias("h"), F.col("name").alias("n")).alias("_l"))
    one = one.join(linked, (F.col("e.href") == F.col("_href")) & ~F.col("e.has_card"), "left")
    got = F.struct(F.coalesce("_l.h", "e.handle").alias("handle"), F.col("e.roles").alias("roles"), F.coalesce("_l.n", "e.name").alias("name"))
    back = one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", got.alias("e")))), lambda x: x["e"]).alias("entities"))
    return records.drop("entities").join(back, key, "left")
