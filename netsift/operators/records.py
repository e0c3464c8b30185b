"""Features of nested records: DNS, addresses, geography, certificates, registration.

Input columns are the flat record's (``flat_record``): arrays and structs per domain. Each function adds its group's columns in
one select of native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import text as t

# Fixed values.
VERIFIERS = ("google-site-verification=", "ms=", "apple-domain-verification=", "facebook-domain-verification=")
BAD_HOSTING_COUNTRIES = (187, 144, 37, 24, 192, 184, 78)
UNKNOWN_COUNTRY = 300
MOST_COUNTRIES = 10_000
TLS_VERSIONS = {"TLSv1": 0, "TLSv1.1": 1, "TLSv1.2": 2, "TLSv1.3": 3}
TLS_CIPHERS = {
    "ECDHE-RSA-AES128-GCM-SHA256": 0, "TLS_AES_128_GCM_SHA256": 1, "TLS_AES_256_GCM_SHA384": 2, "ECDHE-ECDSA-CHACHA20-POLY1305": 3, "ECDHE-RSA-AES128-SHA": 3,
    "ECDHE-RSA-CHACHA20-POLY1305": 4, "ECDHE-RSA-AES256-GCM-SHA384": 5, "ECDHE-ECDSA-AES128-GCM-SHA256": 6, "TLS_CHACHA20_POLY1305_SHA256": 7,
    "ECDHE-ECDSA-AES256-GCM-SHA384": 8, "ECDHE-RSA-AES256-SHA384": 9, "AES128-SHA256": 10, "DHE-RSA-AES256-GCM-SHA384": 11, "AES256-SHA256": 12, "AES128-SHA": 13,
    "DHE-RSA-AES128-GCM-SHA256": 14,
}
RAW_COLUMNS = (
    "dns_zone", "dns_evaluated_on", "dns_email_extras", "dns_ttls", "dns_SOA", "dns_zone_SOA", "dns_A", "dns_AAAA", "dns_CNAME", "dns_MX", "dns_NS", "dns_TXT",
    "tls", "html", "rdap_entities", "rdap_expiration_date", "rdap_last_changed_date", "rdap_registration_date", "rdap_evaluated_on", "rdap_dnssec", "ip_data",
    "countries", "latitudes", "longitudes",
)


def _map(values: dict) -> str:
    return "map(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def level(name: str) -> str:
    """SQL: labels before the last two, without www: the level of a name under a suffix of one label."""
    labels = f"split({name}, '[.]')"
    return f"greatest(size({labels}) - 2 - cast(array_contains(slice({labels}, 1, greatest(size({labels}) - 2, 0)), 'www') as int), 0)"


def string_columns(s: str, prefix: str) -> dict[str, str]:
    return {f"{prefix}_level": level(s), f"{prefix}_digit_count": t.count_class(s, "0-9"), f"{prefix}_len": f"length({s})", f"{prefix}_entropy": t.norm_entropy(s)}


def dns_features(df: DataFrame) -> DataFrame:
    """39 dns_ columns from dns_A, dns_AAAA, dns_NS, dns_TXT (arrays of text), dns_MX (struct name), dns_CNAME, dns_SOA and
    dns_zone_SOA (structs), dns_zone, dns_ttls, dns_email_extras (struct spf, dkim, dmarc) and domain_name."""
    df = df.withColumn("_zone", F.coalesce("dns_zone", F.lit(""))).selectExpr("*", f"if(dns_SOA is null and {level('_zone')} > 0, dns_zone_SOA, dns_SOA) as _soa", "filter(dns_TXT, x -> x <> '') as _txt")
    types = [f"dns_{x}" for x in ("A", "AAAA", "CNAME", "MX", "NS", "SOA", "TXT")]
    cols = {f"dns_{x}_count": f"if(dns_{x} is null, 0, size(dns_{x}))" for x in ("A", "AAAA", "MX", "NS", "TXT")}
    cols |= {f"dns_{x}_count": f"cast(dns_{x} is not null as int)" for x in ("SOA", "CNAME")}
    cols |= {"dns_dnssec_score": "0D", "dns_resolved_record_types": " + ".join(f"cast({x} is not null as int)" for x in types)} | string_columns("_zone", "dns_zone")
    some = "size(dns_ttls) > 0"
    cols |= {
        "dns_ttl_avg": f"if({some}, {t.mean_of('dns_ttls')}, null)", "dns_ttl_stdev": f"if({some}, {t.stddev_of('dns_ttls')}, null)", "dns_ttl_low": f"if({some}, {t.share_between('dns_ttls', 0, 101)}, null)",
        "dns_ttl_mid": f"if({some}, {t.share_between('dns_ttls', 101, 501)}, null)", "dns_ttl_distinct_count": f"if({some}, size(array_distinct(dns_ttls)), null)",
    }
    for part, field in (("primary_ns", "primary_ns"), ("email", "resp_mailbox_dname")):
        cols |= {k: f"if(_soa is null, null, {v})" for k, v in string_columns(f"_soa.{field}", f"dns_soa_{part}").items()}
    cols |= {f"dns_soa_{x}": f"_soa.{x}" for x in ("refresh", "retry", "expire", "min_ttl")}
    mx = "transform(dns_MX, x -> x.name)"
    over = lambda a, f: f"if(size({a}) > 0, aggregate(transform({a}, x -> cast({f} as double)), 0D, (z, x) -> z + x) / size({a}), null)"
    cols |= {
        "dns_domain_name_in_mx": f"coalesce(array_contains({mx}, domain_name), false)",
        # no exchanger at all gives null, where the definition divides by zero
        "dns_mx_avg_len": over(mx, "length(x)"),
        "dns_txt_avg_len": "if(dns_TXT is null, null, if(size(dns_TXT) > 0, aggregate(dns_TXT, 0D, (z, x) -> z + length(x)) / size(dns_TXT), 0D))",
        "dns_txt_external_verification_score": f"coalesce(aggregate(_txt, 0, (z, x) -> z + {' + '.join(f'''cast(contains(lower(x), '{v}') as int)''' for v in VERIFIERS)}), 0)",
    }
    cols |= {f"dns_txt_{x}_exists": f"coalesce(cast(dns_email_extras.{x} as int), 0)" for x in ("spf", "dkim", "dmarc")}
    out = df.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()])
    out = out.withColumn("dns_mx_avg_entropy", mean_entropy(F.transform("dns_MX", lambda x: x["name"])))
    positive = mean_entropy(F.col("_txt"))
    return out.withColumn("dns_txt_avg_entropy", F.when(positive > 0, positive)).drop("_zone", "_soa", "_txt")


def entropy_column(s: Column) -> Column:
    """Character entropy of s divided by its length, 0 for an empty string; usable inside higher-order functions."""
    n = F.length(s)
    parts = F.transform(F.array_distinct(F.split(s, "")), lambda c: (n - F.length(F.replace(s, c, F.lit("")))) / n)
    return F.when(n > 0, F.abs(F.aggregate(parts, F.lit(0.0), lambda z, p: z - p * F.log2(p))) / n).otherwise(0.0)


def mean_entropy(a: Column) -> Column:
    return F.when(F.size(a) > 0, F.aggregate(F.transform(a, entropy_column), F.lit(0.0), lambda z, x: z + x) / F.size(a))


def ip_features(df: DataFrame) -> DataFrame:
    """8 ip_ columns from ip_data: array of struct(ip, from_record, average_rtt, asn, as_address)."""
    v6 = "contains(x.ip, ':')"
    data = "ip_data"
    n = f"if({data} is null, 0, size({data}))"
    rtts = f"filter(transform({data}, x -> x.average_rtt), x -> x is not null)"
    asns, nets = f"filter(transform({data}, x -> x.asn), x -> x is not null)", f"filter(transform({data}, x -> x.as_address), x -> x is not null)"
    cols = {
        "ip_count": n,
        "ip_mean_average_rtt": f"if({n} > 0 and size({rtts}) > 0, {t.mean_of(rtts)}, -1D)",
        "ip_v4_ratio": f"if({n} > 0, size(filter({data}, x -> not {v6})) / {n}, 0D)",
        "ip_a_aaaa_to_all_ratio": f"if({n} > 0, size(filter({data}, x -> x.from_record in ('A', 'AAAA'))) / {n}, 0D)",
        "ip_entropy": f"if({n} > 0, {t.entropy_of(f'transform({data}, x -> ' + t.ip_prefix('x.ip') + ')')}, 0D)",
        "ip_as_address_entropy": f"if({n} > 0, {t.entropy_of(nets)}, 0D)",
        "ip_asn_entropy": f"if({n} > 0, {t.entropy_of(asns)}, 0D)",
        "ip_distinct_as_count": f"if(size({asns}) > 0, size(array_distinct({asns})), null)",
    }
    return df.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()])


def geo_features(df: DataFrame, country_ids: DataFrame) -> DataFrame:
    """18 geo_ columns from countries, latitudes, longitudes (arrays); country_ids: country, id.

    country_ids is a table of a few hundred rows and becomes one map in one row; more than MOST_COUNTRIES stop the job. Continents are looked up by name where
    codes are given, so every country lies on continent 0: the count is 1 and the hash 0. The hash of countries takes ids
    in ascending order, an id over the table's size doubling it.
    """
    few = country_ids.limit(MOST_COUNTRIES + 1)
    one = few.agg(F.map_from_entries(F.collect_list(F.struct("country", "id"))).alias("_ids"), F.count("*").alias("_n"))
    one = one.where(F.assert_true(F.col("_n") <= MOST_COUNTRIES, F.lit("country_ids has too many rows")).isNull())
    df = df.crossJoin(one).selectExpr("*", f"array_sort(array_distinct(transform(countries, x -> coalesce(element_at(_ids, x), {UNKNOWN_COUNTRY})))) as _own")
    some = "coalesce(size(countries) > 0, false)"
    cols = {
        "geo_countries_count": "if(countries is null, 0, size(array_distinct(countries)))", "geo_continents_count": f"cast({some} as int)",
        "geo_malic_host_country": f"cast(coalesce(arrays_overlap(_own, array({', '.join(map(str, BAD_HOSTING_COUNTRIES))})), false) as int)",
    }
    for name, a in (("lat", "latitudes"), ("lon", "longitudes")):
        a0 = f"if({a} is null, cast(array() as array<double>), {a})"
        cols |= {f"geo_{name}_stdev": t.stddev_of(a0), f"geo_mean_{name}": t.mean_of(a0), f"geo_min_{name}": f"coalesce(array_min({a0}), 0D)", f"geo_max_{name}": f"coalesce(array_max({a0}), 0D)"}
    out = df.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()])
    more = {f"geo_{x}_range": f"geo_max_{x} - geo_min_{x}" for x in ("lat", "lon")}
    # half of the largest value is added to the smallest one, by the precedence of the operators
    more |= {f"geo_centroid_{x}": f"geo_min_{x} + geo_max_{x} / 2" for x in ("lat", "lon")}
    more |= {"geo_estimated_area": "(geo_max_lat - geo_min_lat) * (geo_max_lon - geo_min_lon)", "geo_continent_hash": "0", "geo_countries_hash": "coalesce(aggregate(_own, 0L, (z, i) -> (z + i) * if(i > _n, 2, 1)) % 2147483647, 0)"}
    return out.selectExpr("*", *[f"{v} as {k}" for k, v in more.items()]).drop("_ids", "_n", "_own")


def tls_features(df: DataFrame, as_of: Column) -> DataFrame:
    """24 tls_ columns from tls: struct(protocol, cipher, certs array<struct<not_before, not_after, issuer_org, issuer_cn,
    extensions array<struct<oid, critical>>, san, eku, policies, is_ca, aki, ski>>>).

    The chain is folded up to its first certificate of negative validity (broken) or that has expired. A certificate that
    could not be decoded is a null struct and is skipped.
    """
    seconds = "86400D"
    full = "filter(tls.certs, c -> c is not null)"
    days = f"transform({full}, c -> named_struct('c', c, 'valid', cast(bround((unix_seconds(c.not_after) - unix_seconds(c.not_before)) / {seconds}) as bigint), 'left', cast(bround((unix_seconds(c.not_after) - _now) / {seconds}) as bigint)))"
    df = df.withColumn("_now", F.unix_seconds(as_of.cast("timestamp"))).selectExpr("*", f"{days} as _all")
    stop = "filter(sequence(1, size(_all)), i -> _all[i - 1].valid < 0 or _all[i - 1].left < 0)"
    df = df.selectExpr("*", f"if(size(_all) > 0, coalesce(array_min({stop}), 0), 0) as _stop")
    df = df.selectExpr("*", "if(_stop > 0, slice(_all, 1, _stop - 1), _all) as _ok", "if(_stop > 0, _stop, size(_all)) as _seen")
    total = lambda f: f"aggregate(_ok, 0, (z, x) -> z + {f})"
    with_policies = "cast(coalesce(size(x.c.policies) > 0, false) as int)"
    policies = "flatten(transform(_ok, x -> coalesce(x.c.policies, cast(array() as array<string>))))"
    usage = "flatten(transform(_ok, x -> coalesce(x.c.eku, cast(array() as array<string>))))"
    ext = "if(x.c.extensions is null, 0, size(x.c.extensions))"
    root = "if(size(_all) > 1 and size(_ok) = size(_all), element_at(_ok, -1), null)"
    leaf = "get(_ok, 0)"
    sans = "transform(_ok, x -> coalesce(x.c.san, cast(array() as array<string>)))"
    cols = {
        "tls_chain_len": "size(_all)", "tls_is_self_signed": f"cast(coalesce({leaf}.c.aki = {leaf}.c.ski, false) as int)",
        "tls_root_authority_hash": t.md5_mod(f"coalesce({root}.c.issuer_org, '')"), "tls_leaf_authority_hash": t.md5_mod(f"coalesce({leaf}.c.issuer_org, '')"),
        "tls_negotiated_version_id": f"coalesce(element_at({_map(TLS_VERSIONS)}, tls.protocol), 0)", "tls_negotiated_cipher_id": f"coalesce(element_at({_map(TLS_CIPHERS)}, tls.cipher), 0)",
        "tls_root_cert_validity_len": f"coalesce({root}.valid, -1)", "tls_leaf_cert_validity_len": f"coalesce({leaf}.valid, -1)",
        "tls_broken_chain": "cast(_stop > 0 and _all[_stop - 1].valid < 0 as int)", "tls_expired_chain": "cast(_stop > 0 and _all[_stop - 1].valid >= 0 as int)",
        # both counters begin at -1
        "tls_total_extension_count": f"{total(ext)} - 1", "tls_critical_extensions": f"{total('if(x.c.extensions is null, 0, size(filter(x.c.extensions, e -> e.critical)))')} - 1",
        "tls_with_policies_crt_count": total(with_policies), "tls_percentage_crt_with_policies": f"{total(with_policies)} / _seen",
        "tls_x509_anypolicy_crt_count": "0", "tls_iso_policy_crt_count": f"size(filter({policies}, p -> startswith(p, '1.')))", "tls_joint_isoitu_policy_crt_count": f"size(filter({policies}, p -> startswith(p, '2.')))",
        "tls_subject_count": f"if(size(filter({sans}, a -> size(a) > 0)) > 0, size(element_at(filter({sans}, a -> size(a) > 0), -1)), 0)", "tls_server_auth_crt_count": f"size(filter({usage}, u -> u = 'serverAuth'))", "tls_client_auth_crt_count": f"size(filter({usage}, u -> u = 'clientAuth'))",
        "tls_CA_certs_in_chain_ratio": f"{total('cast(coalesce(x.c.is_ca, false) as int)')} / _seen", "tls_unique_SLD_count": f"size(array_distinct(filter(flatten({sans}), n -> length(n) >= 2)))",
        "tls_common_name_count": total("cast(x.c.issuer_cn is not null as int)"),
    }
    has = "coalesce(size(_all) > 0, false)"
    return df.selectExpr("*", f"{has} as tls_has_tls", *[f"if({has}, {v}, null) as {k}" for k, v in cols.items()]).drop("_now", "_all", "_stop", "_ok", "_seen")


def rdap_features(df: DataFrame, as_of: Column) -> DataFrame:
    """14 rdap_ columns from rdap_registration_date, rdap_expiration_date, rdap_last_changed_date, rdap_dnssec and
    rdap_entities: map of role to array of struct(name, email)."""
    first = lambda role, field: f"get(element_at(rdap_entities, '{role}'), 0).{field}"
    day = lambda a, b: f"greatest((unix_seconds({a}) - unix_seconds({b})) / 86400D, 0D)"
    df = df.withColumn("_now", as_of.cast("timestamp"))
    cols = {
        "rdap_registration_period": "(unix_seconds(rdap_expiration_date) - unix_seconds(rdap_registration_date)) / 60D", "rdap_domain_age": day("_now", "rdap_registration_date"),
        "rdap_time_from_last_change": day("_now", "rdap_last_changed_date"), "rdap_domain_active_time": day("least(_now, rdap_expiration_date)", "rdap_registration_date"), "rdap_has_dnssec": "coalesce(rdap_dnssec, false)",
    }
    for role, name in (("registrar", "registrar"), ("registrant", "registrant"), ("administrative", "admin")):
        s = first(role, "name")
        cols |= {f"rdap_{name}_name_len": f"coalesce(length({s}), 0)", f"rdap_{name}_name_entropy": f"coalesce({t.norm_entropy(s)}, 0D)"}
    cols["rdap_registrar_name_hash"] = f"if({first('registrar', 'name')} is null, 0, {t.simhash32(first('registrar', 'name'))})"
    mail = first("administrative", "email")
    # without an e-mail its entropy is the registrant name's
    cols |= {"rdap_admin_email_len": f"coalesce(length({mail}), 0)", "rdap_admin_email_entropy": f"if({mail} is null, {cols['rdap_registrant_name_entropy']}, {t.norm_entropy(mail)})"}
    return df.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()]).drop("_now")


def rdap_ip_features(df: DataFrame) -> DataFrame:
    """10 rdap_ip_ columns from ip_data: array of struct(rdap struct(ip_version, prefix_len, admin_name, admin_email)).

    The version is text, which never equals the number 4: all addresses count as v6 and the v4 columns stay 0.
    """
    known = "filter(ip_data, x -> x.rdap.ip_version is not null)"
    nets = f"transform(filter({known}, x -> x.rdap.prefix_len is not null), x -> x.rdap.prefix_len)"
    n = "if(ip_data is null, 0, size(ip_data))"
    cols = {
        "rdap_ip_v4_count": "0", "rdap_ip_v6_count": f"if(ip_data is null, 0, size({known}))", "rdap_ip_shortest_v4_prefix_len": "0", "rdap_ip_longest_v4_prefix_len": "0",
        "rdap_ip_shortest_v6_prefix_len": f"coalesce(array_min({nets}), 0)", "rdap_ip_longest_v6_prefix_len": f"coalesce(array_max({nets}), 0)",
    }
    for field in ("name", "email"):
        a = f"filter(transform(ip_data, x -> x.rdap.admin_{field}), x -> x is not null)"
        cols[f"rdap_ip_avg_admin_{field}_len"] = f"if({n} > 0, aggregate({a}, 0D, (z, x) -> z + length(x)) / {n}, 0D)"
    out = df.selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()])
    for field in ("name", "email"):
        a = F.filter(F.col(f"ip_data.rdap.admin_{field}"), lambda x: x.isNotNull())
        total = F.aggregate(F.transform(a, entropy_column), F.lit(0.0), lambda z, x: z + x)
        out = out.withColumn(f"rdap_ip_avg_admin_{field}_entropy", F.when(F.coalesce(F.size("ip_data"), F.lit(0)) > 0, total / F.size("ip_data")).otherwise(0.0))
    return out


def drop_raw(df: DataFrame) -> DataFrame:
    return df.drop(*RAW_COLUMNS)
