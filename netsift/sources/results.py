"""Reading of collector results, merged records and seed lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netsift.functions.domains import HOSTNAME

HOST = HOSTNAME.replace("\\\\", "\\")
COMMENT = r"^\s*(#|;|//)"
RAW = "key binary, value binary, partition int, offset bigint, timestamp timestamp"


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = "latest") -> DataFrame:
    """A stream of a topic's raw messages; a restarted query goes on at its checkpoint, a new one at ``start``."""
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}).load()


def read_folder(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """A stream of raw messages from Parquet files with the columns of RAW."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", files).parquet(path)


#: A merged record; certificates come decoded, registration bodies as JSON text.
MERGED = """zone struct<zone:string, soa:struct<primaryNS:string,respMailboxDname:string,serial:string,refresh:bigint,retry:bigint,expire:bigint,minTTL:bigint>>,
    dnsResult struct<statusCode:int, error:string, lastAttempt:bigint, ips:array<struct<ip:string,rrType:string>>, dnsData:struct<ttlValues:map<string,bigint>, A:array<string>, AAAA:array<string>,
        CNAME:struct<value:string,relatedIPs:array<string>>, MX:array<struct<value:string,priority:int,relatedIPs:array<string>>>, NS:array<struct<nameserver:string,relatedIPs:array<string>>>, TXT:array<string>>>,
    tlsResult struct<statusCode:int, error:string, lastAttempt:bigint, html:string, tlsData:struct<fromIP:string, protocol:string, cipher:string, certs:array<struct<not_before:timestamp, not_after:timestamp, issuer_org:string,
        issuer_cn:string, extensions:array<struct<oid:string,critical:boolean>>, san:array<string>, eku:array<string>, policies:array<string>, is_ca:boolean, aki:string, ski:string>>>>,
    rdapDomainResult struct<statusCode:int, error:string, lastAttempt:bigint, rdapTarget:string, rdapData:string, entities:string, whoisStatusCode:int, whoisError:string, whoisRaw:string, whoisParsed:string>,
    ipResults map<string,map<string,struct<statusCode:int, error:string, lastAttempt:bigint, collector:string, data:struct<asn:bigint, asnOrg:string, networkAddress:string, prefixLength:bigint, countryCode:string,
        latitude:double, longitude:double, avg:double, received:bigint, reputation:double, ipVersion:string, prefixLen:int, adminName:string, adminEmail:string>>>>""".replace("\n", " ")


def status_meta(value: str = "value") -> dict[str, Column]:
    """status_code (-1), error and collector of a result from the top level of its JSON, without decoding the body."""
    get = lambda name: F.get_json_object(value, f"$.{name}")
    return {"status_code": F.coalesce(get("statusCode").try_cast("int"), F.lit(-1)), "error": get("error"), "result_collector": get("collector")}


def domain_results(raw: DataFrame, collector: str) -> DataFrame:
    """Messages of a domain topic: the key is the domain, the value stays text."""
    rows = raw.select(F.col("key").cast("string").alias("domain"), F.lit(collector).alias("collector"), F.col("value").cast("string").alias("value"), "partition", "offset", F.col("timestamp").alias("ts"))
    meta = status_meta()
    return rows.withColumns({k: meta[k] for k in ("status_code", "error")})


def ip_results(raw: DataFrame, registered: tuple[str, ...]) -> DataFrame:
    """Messages of the address topic: the key is JSON {dn, ip}; unregistered collectors are dropped."""
    key = F.from_json(F.col("key").cast("string"), "dn string, ip string")
    rows = raw.select(key["dn"].alias("domain"), key["ip"].alias("ip"), F.col("value").cast("string").alias("value"), "partition", "offset", F.col("timestamp").alias("ts"))
    meta = status_meta()
    return rows.withColumns({"status_code": meta["status_code"], "error": meta["error"], "collector": meta["result_collector"]}).where(F.col("collector").isin(*registered))


def parse_payload(value: Column, schema: str) -> Column:
    """Typed payload; null for null and empty text, and a row with _corrupt_record for broken JSON."""
    return F.from_json(F.when(F.trim(value) != "", value), f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def unreadable_fields(value: Column, data: Column, schema: str) -> Column:
    """Paths of fields that JSON text gives a value for, while ``data``, read from it by schema, has none: of another type than the
    schema has, or with something of another type within. Null for text that is no JSON object."""

    def leaves(kind: StructType, path: str, at: Column) -> list[Column]:
        out = []
        for f in kind.fields:
            here, own = f"{path}.{f.name}", at[f.name]
            given = F.try_variant_get(body, here, "variant")
            there = given.isNotNull() & ~F.coalesce(F.is_variant_null(given), F.lit(False))
            if isinstance(f.dataType, StructType):
                out.append(F.when(there & own.isNull(), here[2:]))
                out += leaves(f.dataType, here, own)
            else:
                out.append(F.when(there & own.isNull(), here[2:]))
        return out

    body = F.try_parse_json(value)
    fields = F.filter(F.array(*leaves(StructType.fromDDL(schema), "$", data)), lambda x: x.isNotNull())
    # a struct that can't be read names all that is in it; the struct alone is enough
    short = F.filter(fields, lambda x: ~F.exists(fields, lambda y: F.startswith(x, F.concat(y, F.lit(".")))))
    return F.when(F.startswith(F.schema_of_variant(body), F.lit("OBJECT")), short)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with columns that are computed once a row: filters on them stay behind the array of one element that they come from,
    while a filter on a plain column is moved before it and computes it again."""
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def parse_merged(raw: DataFrame, schema: str) -> DataFrame:
    """key and value as text: domain_name from the key, data, invalid_data, and unreadable (the fields of invalid data that are of
    another type than schema has); null values are skipped."""
    rows = once(raw.select(F.col("key").cast("string").alias("domain_name"), F.col("value").cast("string").alias("value")), value=F.col("value")).where("value is not null")
    rows = once(rows, data=parse_payload(F.col("value"), schema))
    bad = F.col("data").isNull() | F.col("data._corrupt_record").isNotNull()
    rows = rows.withColumn("invalid_data", bad).withColumn("unreadable", F.when(F.col("invalid_data"), unreadable_fields(F.col("value"), F.col("data"), schema)))
    return rows.withColumn("data", F.when(~F.col("invalid_data"), F.col("data").dropFields("_corrupt_record"))).drop("value")


def validate_merged(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and errors (domain_name, error): one for each record, which names the fields that couldn't be read."""
    fields = F.when(F.size("unreadable") > 0, F.concat(F.lit("Unreadable: "), F.array_join("unreadable", ", ")))
    error = F.when(F.col("invalid_data"), F.coalesce(fields, F.lit("Invalid data"))).when(F.coalesce(F.trim("domain_name"), F.lit("")) == "", "Missing domain name")
    rows = parsed.withColumn("error", error)
    return rows.where("error is null").drop("error", "invalid_data", "unreadable"), rows.where("error is not null").select("domain_name", "error")


def plain_list(lines: DataFrame, category: str, column: str = "value") -> DataFrame:
    """name, category: the first host name of each line that is neither blank nor a comment."""
    rows = lines.select(F.trim(column).alias("line")).where((F.col("line") != "") & ~F.col("line").rlike(COMMENT))
    return rows.select(F.regexp_extract("line", HOST, 0).alias("name"), F.lit(category).alias("category")).where("name <> ''")


def load_plain_list(spark: SparkSession, path: str, category: str) -> DataFrame:
    return plain_list(spark.read.text(path), category)


def _field(fields: Column, i: int, default: Column) -> Column:
    return default if i < 0 else F.get(fields, i)


#: A cell put behind each line, so that an empty last cell can be told from a missing one.
_END = "\x02end"


def _cells(line: Column | str, n: int, delimiter: str) -> Column:
    """Fields c0 to c<n-1> of a CSV line, cells maybe quoted (quotes doubled within); null for lines of fewer cells."""
    options = {"sep": "\\\\" if delimiter == "\\" else delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    names = [f"c{i}" for i in range(n)]
    got = F.from_csv(F.concat(line, F.lit(delimiter + _END)), F.lit(", ".join(f"{c} string" for c in [*names, "rest"])), options)
    short = F.lit(False)
    for c in names:
        short = short | (F.coalesce(got[c], F.lit("")) == _END)
    return F.when(~short, F.struct(*[F.coalesce(got[c], F.lit("")).alias(c) for c in names]))


def csv_records(text: Column, delimiter: str) -> Column:
    """The records of a CSV text, whose quoted cells may go over several lines; lines without anything are left out."""
    d = re.escape(delimiter)
    cell = rf'(?:"(?:[^"]++|"")*+"[^{d}\r\n]*+|[^{d}\r\n"][^{d}\r\n]*+|)'
    return F.filter(F.regexp_extract_all(text, F.lit(f"{cell}(?:{d}{cell})*+"), F.lit(0)), lambda r: r != "")


def _from_cells(cells: Column, column: int, category: int, category_source: int, getter: int = -1, mapper: int = -1) -> dict[str, Column]:
    at = lambda i, default: cells[f"c{i}"] if i >= 0 else default
    none = F.lit(None).cast("string")
    return {"url": at(column, none), "category": at(category, F.lit("unknown")), "category_source": at(category_source, F.lit("this")), "getter_def": at(getter, none), "mapper_def": at(mapper, none)}


def source_definitions(lines: DataFrame, column: int = 0, category: int = -1, category_source: int = -1, getter: int = -1, mapper: int = -1, delimiter: str = ",") -> DataFrame:
    """url, category, category_source, getter_def, mapper_def from CSV lines (column ``value``), cells maybe quoted.

    Lines shorter than the highest index used, and those without a host name in ``column``, are dropped. A negative index means
    the default: unknown, this, null.
    """
    rows = lines.select(_cells(F.col("value"), max(column, category, category_source, getter, mapper) + 1, delimiter).alias("r")).where("r is not null")
    found = rows.select(*[c.alias(k) for k, c in _from_cells(F.col("r"), column, category, category_source, getter, mapper).items()])
    return found.where(F.col("url").rlike(HOST))


def load_source_csv(spark: SparkSession, path: str, delimiter: str = ",", **columns: int) -> DataFrame:
    """source_definitions() of files, whose quoted cells may go over several lines. A file is read by one task, as where a record
    begins depends on all quotes before it."""
    files = spark.read.text(path, wholetext=True)
    return source_definitions(files.select(F.explode(csv_records(F.col("value"), delimiter)).alias("value")), delimiter=delimiter, **columns)


def categorised(lines: DataFrame, line: str = "value") -> DataFrame:
    """lines with ``category`` as their source defines it in columns (category, category_source, getter_def, mapper_def).

    category_source: ``this`` takes category as it is, ``csv`` the cell that getter_def names as delimiter and index, ``txt`` the
    first group of the regex getter_def, anything else is unknown, as is a cell that isn't there or an index below zero, a regex
    that isn't found or has no group. mapper_def: ``regex=category;...``, of which the first that is found counts, without
    case; unknown if none is; without mapper_def the category stays, and unknown stays unknown.
    """
    text, getter = F.col(line), F.col("getter_def")
    quoted = F.concat(F.lit("\\Q"), F.substring(getter, 1, 1), F.lit("\\E"))
    index = F.substring(getter, 2, 10).try_cast("int")
    cell = F.when(index >= 0, F.get(F.split(text, quoted), index))
    group = F.call_function("regexp_extract", text, F.concat(F.lit("(?:"), getter, F.lit(")()")), F.lit(1))
    own = F.when(F.col("category_source") == "this", F.col("category")).when(F.coalesce(getter, F.lit("")) == "", "unknown")
    own = own.when(F.col("category_source") == "csv", cell).when(F.col("category_source") == "txt", F.when(group != "", group))
    own = F.coalesce(own, F.lit("unknown"))
    rules = F.transform(F.split("mapper_def", ";"), lambda r: F.split(r, "="))
    hit = F.get(F.filter(rules, lambda r: F.call_function("regexp", F.col("_own"), F.concat(F.lit("(?i)"), r[0]))), 0)
    mapped = F.when((F.coalesce("mapper_def", F.lit("")) == "") | (F.col("_own") == "unknown"), F.col("_own")).otherwise(F.coalesce(F.when(F.size(hit) == 2, hit[1]), F.lit("unknown")))
    return lines.withColumn("_own", own).withColumn("category", mapped).drop("_own")


def source_rows(lines: DataFrame, column: int, category: int = -1, category_source: int = -1, getter: Column | None = None, mapper: list[tuple[str, str]] | None = None, delimiter: str = ",") -> DataFrame:
    """name, category, category_source from CSV lines (column ``value``), cells maybe quoted.

    Lines shorter than the highest index used, and those without a host name in ``column``, are dropped. A negative index
    means the default: ``unknown`` or what getter says, and ``this``.
    """
    cells = _cells(F.col("value"), max(column, category, category_source) + 1, delimiter)
    rows = lines.withColumn("fields", cells).where("fields is not null")
    own = _from_cells(F.col("fields"), column, category, category_source)
    found = own["category"] if category >= 0 or getter is None else getter
    rows = rows.select(F.regexp_extract(own["url"], HOST, 0).alias("name"), category_mapper(found, mapper).alias("category"), own["category_source"].alias("category_source"))
    return rows.where("name <> ''")


def source_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return source_rows(spark.read.text(path), **options)


def urlhaus_rows(lines: DataFrame, category: str) -> DataFrame:
    """name, category: the host in the third column of each quoted CSV line that is no comment."""
    fields = F.from_csv("value", F.lit("a string, b string, url string"), {"quote": '"'})
    rows = lines.where(~F.col("value").rlike(COMMENT)).select(F.regexp_extract(fields["url"], HOST, 0).alias("name"))
    return rows.where("name <> ''").withColumn("category", F.lit(category))


def category_getter(line: Column, definition: str | None) -> Column:
    """A constant; a cell written ``<delimiter><index>``; the first group of ``/regex/``; or unknown."""
    if not definition:
        return F.lit("unknown")
    if len(definition) > 2 and definition[0] == definition[-1] == "/":
        got = F.regexp_extract(line, definition[1:-1], 1)
        return F.when(got == "", "unknown").otherwise(got)
    if not definition[0].isalnum() and definition[1:].lstrip("-").isdigit():
        if int(definition[1:]) < 0:
            raise ValueError("a negative cell index counts from the end by accident only")
        return F.coalesce(F.get(F.split(line, re.escape(definition[0])), int(definition[1:])), F.lit("unknown"))
    return F.lit(definition)


def category_mapper(category: Column, rules: list[tuple[str, str]] | None) -> Column:
    """The category of the first rule whose regex is found, without case; unknown if none is; unchanged without rules."""
    if not rules:
        return category
    out = F.lit("unknown")
    for pattern, name in reversed(rules):
        out = F.when(category.rlike("(?i)" + pattern), name).otherwise(out)
    return out


def feed_attributes(events: DataFrame, category: str) -> DataFrame:
    """name, category: a host name per attribute value of threat-feed events (attributes: array of struct with value)."""
    values = events.select(F.explode("attributes").alias("a")).select(F.regexp_extract("a.value", HOST, 0).alias("name"))
    return values.where("name <> ''").withColumn("category", F.lit(category))


def ingress_domain(rows: DataFrame) -> DataFrame:
    """key: the column domain; a null one stops the job."""
    return rows.select(F.when(F.assert_true(F.col("domain").isNotNull(), F.lit("domain is null")).isNull(), F.col("domain")).alias("key"))


def split_merged(merged: DataFrame) -> DataFrame:
    """A merged record's collector results, one row each: domain, ip, collector, status_code, error, last_attempt, data.

    merged: domain, zone, dnsResult, tlsResult, rdapDomainResult (structs) and ipResults. The zone has no envelope of its
    own: it is good, half a second before the DNS result.
    """
    entry = lambda name, c: F.struct(F.lit(None).cast("string").alias("ip"), F.lit(name).alias("collector"), F.col(f"{c}.statusCode").alias("status_code"), F.col(f"{c}.error").alias("error"), F.col(f"{c}.lastAttempt").alias("last_attempt"), F.to_json(c).alias("data"))
    zone = F.struct(F.lit(None).cast("string").alias("ip"), F.lit("zone").alias("collector"), F.lit(0).alias("status_code"), F.lit(None).cast("string").alias("error"), (F.col("dnsResult.lastAttempt") - 500).alias("last_attempt"), F.to_json("zone").alias("data"))
    own = F.array(F.when(F.col("zone").isNotNull(), zone), *[F.when(F.col(c).isNotNull(), entry(n, c)) for n, c in (("dns", "dnsResult"), ("tls", "tlsResult"), ("rdap-dn", "rdapDomainResult"))])
    per_ip = F.flatten(
        F.transform(
            F.map_entries("ipResults"),
            lambda x: F.transform(F.map_entries(x["value"]), lambda y: F.struct(x["key"].alias("ip"), y["key"].alias("collector"), y["value"]["statusCode"].alias("status_code"), y["value"]["error"].alias("error"), y["value"]["lastAttempt"].alias("last_attempt"), y["value"]["data"].alias("data"))),
        )
    )
    all_ = F.concat(F.filter(own, lambda x: x.isNotNull()), F.coalesce(per_ip, F.array().cast("array<struct<ip:string,collector:string,status_code:int,error:string,last_attempt:bigint,data:string>>")))
    return merged.select("domain", F.explode(all_).alias("r")).select("domain", "r.*")


def split_merged_json(raw: DataFrame) -> DataFrame:
    """split_merged() of messages (key: the domain, value: a merged record as JSON), whatever the bodies hold: data is the whole
    result as JSON text, zone's in an envelope. Records that are no JSON give no rows."""
    rows = raw.select(F.col("key").cast("string").alias("domain"), F.try_parse_json(F.col("value").cast("string")).alias("v"))
    at = lambda path, kind="variant": F.try_variant_get("v", path, kind)
    zone_at = at("$.dnsResult.lastAttempt", "bigint") - 500
    zone = F.to_json(F.struct(F.lit(0).alias("statusCode"), zone_at.alias("lastAttempt"), at("$.zone").alias("zone")))
    own = F.array(
        F.struct(F.lit(None).cast("string").alias("ip"), F.lit("zone").alias("collector"), F.when(at("$.zone").isNotNull() & ~F.is_variant_null(at("$.zone")), F.try_parse_json(zone)).alias("r")),
        *[F.struct(F.lit(None).cast("string").alias("ip"), F.lit(name).alias("collector"), at(f"$.{c}").alias("r")) for name, c in (("dns", "dnsResult"), ("tls", "tlsResult"), ("rdap-dn", "rdapDomainResult"))],
    )
    maps = at("$.ipResults", "map<string, map<string, variant>>")
    per_ip = F.flatten(F.transform(F.map_entries(maps), lambda x: F.transform(F.map_entries(x["value"]), lambda y: F.struct(x["key"].alias("ip"), y["key"].alias("collector"), y["value"].alias("r")))))
    none = F.array().cast("array<struct<ip: string, collector: string, r: variant>>")
    each = rows.select("domain", F.explode(F.concat(own, F.coalesce(per_ip, none))).alias("x")).select("domain", "x.*").where(F.col("r").isNotNull() & ~F.is_variant_null("r"))
    got = lambda path, kind: F.try_variant_get("r", path, kind)
    return each.select("domain", "ip", "collector", got("$.statusCode", "int").alias("status_code"), got("$.error", "string").alias("error"), got("$.lastAttempt", "bigint").alias("last_attempt"), F.to_json("r").alias("data"))
