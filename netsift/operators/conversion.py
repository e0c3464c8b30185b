"""From a merged record to the flat record that features read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def soa_split(domain: Column, zone: Column, soa: Column) -> dict[str, Column]:
    """dns_SOA if the name is its zone, else dns_zone_SOA."""
    own = domain == zone
    return {"dns_SOA": F.when(own, soa), "dns_zone_SOA": F.when(~own, soa)}


def email_extras(txt: Column) -> Column:
    """Whether TXT records have SPF, DKIM and DMARC entries."""
    has = lambda s: F.exists(F.coalesce(txt, F.array().cast("array<string>")), lambda x: F.contains(F.lower(x), F.lit(s)))
    return F.struct(has("v=spf1").alias("spf"), has("v=dkim1").alias("dkim"), has("v=dmarc1").alias("dmarc"))


def ip_records(ips: Column, results: Column) -> Column:
    """A struct for each DNS address: asn, as_address, rdap, geo, average_rtt and reputation from the map of results.

    A collector that failed has no data. The round-trip time is weighted over all collectors whose name begins with rtt, 0
    without any answer. A reputation of 0 counts as missing, -1.
    """

    # a step for each look-up, so that each address looks into the maps once, not for every field
    def found(x: Column) -> Column:
        return F.struct(x["ip"].alias("ip"), x["rrType"].alias("rrType"), results[x["ip"]].alias("own"))

    def data(x: Column) -> Column:
        own = x["own"]
        answers = F.filter(F.map_entries(own), lambda e: e["key"].startswith("rtt") & (e["value"]["statusCode"] == 0))
        return F.struct(x["ip"].alias("ip"), x["rrType"].alias("rrType"), *[own[c]["data"].alias(name) for c, name in (("geo-asn", "geo"), ("rdap-ip", "rdap"), ("nerd", "nerd"))], answers.alias("answers"))

    def one(x: Column) -> Column:
        geo, rdap, rep = x["geo"], x["rdap"], x["nerd"]["reputation"]
        address, version = geo["networkAddress"], rdap["ipVersion"]
        net = F.concat_ws("/", F.when(address.startswith("/"), F.substr(address, F.lit(2))).otherwise(address), geo["prefixLength"].cast("string"))
        count = F.aggregate(x["answers"], F.lit(0.0), lambda z, e: z + F.coalesce(e["value"]["data"]["received"], F.lit(0)))
        total = F.aggregate(x["answers"], F.lit(0.0), lambda z, e: z + F.coalesce(e["value"]["data"]["avg"] * e["value"]["data"]["received"], F.lit(0.0)))
        return F.struct(
            x["ip"].alias("ip"), x["rrType"].alias("from_record"), geo["asn"].alias("asn"), F.when(address.isNotNull(), net).alias("as_address"),
            geo["countryCode"].alias("country"), geo["latitude"].alias("latitude"), geo["longitude"].alias("longitude"), F.when(count > 0, total / count).otherwise(0.0).alias("average_rtt"),
            F.when(rep.isNull() | (rep == 0), -1.0).otherwise(rep).alias("reputation"), F.struct(F.when(version.isin("v4", "v6"), F.substr(version, F.lit(2))).otherwise(version).alias("ip_version"), rdap["prefixLen"].alias("prefix_len"), rdap["adminName"].alias("admin_name"), rdap["adminEmail"].alias("admin_email")).alias("rdap"),
        )

    return F.transform(F.transform(F.transform(F.coalesce(ips, F.array().cast("array<struct<ip:string,rrType:string>>")), found), data), one)


def flatten_geo(data: Column) -> dict[str, Column]:
    """countries, latitudes, longitudes of the addresses that have them."""
    pick = lambda f: F.filter(F.transform(data, lambda x: x[f]), lambda v: v.isNotNull())
    return {"countries": pick("country"), "latitudes": pick("latitude"), "longitudes": pick("longitude")}


def flat_record(merged: DataFrame) -> DataFrame:
    """domain_name and the columns of features from domain, zone, dnsResult, tlsResult, rdapDomainResult and ipResults."""
    dns = "dnsResult.dnsData"
    soa = F.col("zone.soa")
    names = {"primary_ns": "primaryNS", "resp_mailbox_dname": "respMailboxDname", "refresh": "refresh", "retry": "retry", "expire": "expire", "min_ttl": "minTTL"}
    rows = merged.select(
        F.col("domain").alias("domain_name"), F.col("zone.zone").alias("dns_zone"), F.when(soa.isNotNull(), F.struct(*[soa[v].alias(k) for k, v in names.items()])).alias("_soa"), F.timestamp_millis("dnsResult.lastAttempt").alias("dns_evaluated_on"),
        F.map_values(f"{dns}.ttlValues").alias("dns_ttls"), *[F.col(f"{dns}.{x}").alias(f"dns_{x}") for x in ("A", "AAAA", "NS", "TXT")], F.col(f"{dns}.CNAME.value").alias("dns_CNAME"),
        F.transform(f"{dns}.MX", lambda x: F.struct(x["value"].alias("name"), x["priority"])).alias("dns_MX"),
        # the flag is looked for beside the DNS data, where it never is
        F.lit(0).alias("dns_has_dnskey"), F.col("tlsResult.tlsData").alias("tls"), F.coalesce("tlsResult.html", F.lit("")).alias("html"), F.timestamp_millis("rdapDomainResult.lastAttempt").alias("rdap_evaluated_on"),
        F.col("rdapDomainResult").alias("_rdap"), ip_records(F.col("dnsResult.ips"), F.col("ipResults")).alias("ip_data"),
    )
    rows = rows.withColumns(soa_split(F.col("domain_name"), F.col("dns_zone"), F.col("_soa")) | {"dns_email_extras": email_extras(F.col("dns_TXT"))} | flatten_geo(F.col("ip_data")))
    rows = rdap_columns(rows, F.col("_rdap.rdapData"), F.col("_rdap.entities"))
    no_rdap = F.col("_rdap.rdapData").isNull()
    rows = rows.withColumn("_whois", F.when(no_rdap, whois_fields(F.col("_rdap.whoisParsed"))))
    dates = whois_dates(F.col("_whois"), F.col("_rdap.whoisRaw"))
    return rows.withColumns({c: F.when(no_rdap, dates[k]).otherwise(F.col(c)) for k, c in (("created", "rdap_registration_date"), ("expires", "rdap_expiration_date"), ("updated", "rdap_last_changed_date"))}).drop("_soa", "_rdap", "_whois")


RDAP = "events array<map<string,string>>, entities array<struct<roles: string, vcardArray: string, entities: string>>, secureDNS struct<delegationSigned: boolean>"


def rdap_columns(df: DataFrame, body: Column, entities: Column | None = None) -> DataFrame:
    """Dates, roles and the DNSSEC flag from an RDAP body (JSON text): what can't be read is null.

    Event keys come in case variants, roles as text or as objects with a value. Entities that were asked for one by one
    (JSON text) stand for those in the body.
    """
    # columns of a select of their own, so that each text is parsed once, not for every field that is read
    df = df.withColumns({"_body": F.from_json(body, RDAP), "_entities": F.from_json(F.lit(None).cast("string") if entities is None else entities, "array<struct<roles: string, vcardArray: string, entities: string>>")})
    event = lambda e: F.struct(F.lower(F.coalesce(e["eventAction"], e["EventAction"], e["eventaction"])).alias("action"), F.coalesce(e["eventDate"], e["EventDate"], e["eventdate"]).alias("date"))
    df = df.withColumns({"_own": F.coalesce("_entities", "_body.entities"), "_events": F.transform("_body.events", event)})
    got, own = F.col("_body"), F.col("_own")
    when = lambda action: F.try_to_timestamp(F.get(F.filter("_events", lambda e: e["action"] == action), 0)["date"])
    return df.withColumns(
        {"rdap_registration_date": when("registration"), "rdap_expiration_date": when("expiration"), "rdap_last_changed_date": when("last changed"), "rdap_dnssec": got["secureDNS"]["delegationSigned"], "rdap_entities": entities_by_role(own)}
    ).drop("_body", "_entities", "_own", "_events")


def entity_roles(roles: Column) -> Column:
    """Roles given as text, or as objects whose value is the role."""
    # a reading that fails is dear, so objects are only looked for where there is a brace
    plain = F.from_json(roles, "array<string>")
    return F.when(F.contains(roles, F.lit("{")), F.coalesce(F.transform(F.from_json(roles, "array<struct<value: string>>"), lambda x: x["value"]), plain)).otherwise(plain)


def entities_by_role(entities: Column) -> Column:
    """Map of role to entities (name, email), from their cards: pairs of a property's name and its last item."""
    field = lambda card, name: F.nullif(F.regexp_extract(card, rf'\["{name}",\{{[^}}]*\}},"[^"]*","([^"]*)"\]', 1), F.lit(""))
    one = F.transform(entities, lambda e: F.struct(F.coalesce(F.filter(entity_roles(e["roles"]), lambda r: r.isNotNull()), F.array().cast("array<string>")).alias("roles"), F.struct(field(e["vcardArray"], "fn").alias("name"), field(e["vcardArray"], "email").alias("email")).alias("e")))
    roles = lambda each: F.array_distinct(F.flatten(F.transform(each, lambda x: x["roles"])))
    of = lambda each, r: F.transform(F.filter(each, lambda x: F.array_contains(x["roles"], r)), lambda x: x["e"])
    # the cards are read once, however many roles there are
    return F.get(F.transform(F.array(one), lambda each: F.map_from_entries(F.transform(roles(each), lambda r: F.struct(r.alias("role"), of(each, r).alias("of"))))), 0)


def whois_fields(parsed: Column) -> Column:
    """WHOIS fields from JSON text: a map of names to arrays of text, for values that are one text or a list."""
    return F.transform_values(F.from_json(parsed, "map<string,string>"), lambda _, v: F.coalesce(F.from_json(v, "array<string>"), F.array(v)))


# How lines of a WHOIS answer begin that hold the dates.
WHOIS_LINES = {"created": "creation date|created|created on|registered on", "expires": "registry expiry date|registrar registration expiration date|expiration date|expiry date|expires|paid-till", "updated": "updated date|last updated|last-update|last modified|changed"}


def whois_dates(parsed: Column, raw: Column | None = None) -> dict[str, Column]:
    """created, expires, updated from WHOIS fields (map of text to array of text): the first creation date, the last other
    ones; two spellings of each; what the fields lack is looked for in the answer's text; no ISO date is null."""

    def pick(key: str, names: tuple[str, ...], at: int) -> Column:
        found = F.try_element_at(F.coalesce(*[parsed[n] for n in names]), F.lit(at))
        if raw is not None:
            lines = F.regexp_extract_all(raw, F.lit(rf"(?im)^\s*(?:{WHOIS_LINES[key]})\s*:\s*(\S+)"), F.lit(1))
            found = F.coalesce(found, F.try_element_at(lines, F.lit(at)))
        return F.try_to_timestamp(found)

    return {"created": pick("created", ("created_date", "created", "creation_date"), 1), "expires": pick("expires", ("expires_date", "expires", "expiration_date"), -1), "updated": pick("updated", ("updated_date", "updated"), -1)}


def strip_empty(fields: Column) -> Column:
    """A map of arrays without null and empty values."""
    return F.map_filter(fields, lambda _, v: v.isNotNull() & (F.size(v) > 0))
