"""Splitting of domain names by public suffix, and lists that domain features look for."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A short default table; callers may pass the full public list as a DataFrame with a column ``suffix``, rules with ``*.`` and
#: ``!`` included.
DEFAULT_SUFFIXES = ("com", "net", "org", "edu", "gov", "int", "info", "biz", "io", "eu", "cz", "de", "fr", "es", "it", "us", "cc", "me", "uk", "co.uk", "ac.uk", "org.uk", "com.au", "co.jp")

HOSTNAME = r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z0-9]"

# These lists and scores define the feature columns.
PHISHING_KEYWORDS = (
    "account", "action", "alert", "app", "auth", "bank", "billing", "center", "chat", "device", "fax", "event",
    "find", "free", "gift", "help", "info", "invoice", "live", "location", "login", "mail", "map", "message",
    "my", "new", "nitro", "now", "online", "pay", "promo", "real", "required", "safe", "secure", "security",
    "service", "signin", "support", "track", "update", "verification", "verify", "vm", "web",
)
BENIGN_KEYWORDS = (
    "blog", "book", "buy", "community", "design", "dev", "diary", "doc", "download", "edu", "family", "forum",
    "gallery", "game", "health", "home", "host", "lab", "learn", "media", "news", "photo", "play", "project",
    "research", "review", "school", "shop", "site", "store", "studio", "tech", "tutorial", "video", "wiki", "work",
    "safeframe", "googlesyndication", "silverhat", "fitcrack", "feta", "vut", "cesnet",
)
PROVIDER_SUFFIXES = (
    "googlesyndication.com", "office.com", "fbcdn.net", "gstatic.com", "yahoodns.net", "pinimg.com", "vut.cz", "vutbr.cz",
    "cvut.cz", "cuni.cz", "muni.cz", "cesnet.cz", "fitcrack.cz",
)
FAMOUS_SUFFIXES = (
    "google.com", "facebook.com", "apple.com", "microsoft.com", "amazon.com", "twitter.com", "instagram.com", "linkedin.com",
    "adobe.com", "spotify.com", "netflix.com", "youtube.com", "pinterest.com", "whatsapp.com", "tiktok.com", "wikipedia.org",
    "mozilla.org", "wordpress.org", "bbc.co.uk", "nytimes.com", "reddit.com", "slack.com", "salesforce.com", "shopify.com",
    "dropbox.com", "samsung.com", "oracle.com", "ibm.com", "cisco.com", "zoom.us", "paypal.com", "mastercard.com", "visa.com",
    "stripe.com", "americanexpress.com", "tesla.com", "uber.com", "airbnb.com", "tripadvisor.com", "yelp.com", "nasa.gov",
    "cdc.gov", "who.int", "un.org", "europa.eu", "harvard.edu", "stanford.edu", "mit.edu", "cam.ac.uk", "github.com",
)
CDN_SUFFIXES = (
    "akamaihd.net", "akamai.net", "akamaiedge.net", "akamaitechnologies.com", "cloudfront.net", "edgecastcdn.net", "fastly.net",
    "stackpathcdn.com", "cachefly.net", "keycdn.com", "cloudflare.net", "maxcdn.com", "cdn77.org", "cdnify.io", "belugacdn.link",
    "kxcdn.com", "cdnetworks.net", "incapdns.net", "lswcdn.net", "llnw.net", "hwcdn.net", "nyucd.net", "onappcdn.com",
    "panthercdn.com", "simplecdn.net", "ssl.hwcdn.net", "rncdn1.com", "rlcdn.com", "zenedge.net",
)
VPS_SUFFIXES = (
    "digitalocean.com", "linode.com", "vultr.com", "aws.amazon.com", "azure.com", "googleapis.com", "ovh.com", "hetzner.com",
    "bluehost.com", "hostgator.com", "godaddy.com", "dreamhost.com", "siteground.com", "a2hosting.com", "scaleway.com",
    "upcloud.com", "ramnode.com", "inmotionhosting.com", "liquidweb.com", "contabo.com", "cloud.google.com", "kamatera.com",
    "interserver.net", "lunanode.com", "buyvm.net", "time4vps.com", "vpsdime.com", "vpsserver.com", "hostwinds.com", "milesweb.com",
)
IMAGE_SUFFIXES = (
    "imgur.com", "flickr.com", "photobucket.com", "500px.com", "postimage.io", "tinypic.com", "deviantart.com", "imageshack.us",
    "imgbb.com", "imgsafe.org", "smugmug.com", "imagevenue.com", "imgbox.com", "imgpile.net", "pinterest.com", "pixabay.com",
    "unsplash.com", "pbase.com", "giphy.com", "gyazo.com", "directupload.net", "funkyimg.com", "imagebam.com", "cubeupload.com",
    "photo.net", "dropbox.com", "googleusercontent.com", "mediafire.com", "imgflip.com", "ifcdn.com", "img2share.com", "sli.mg",
    "imagefra.me", "yfrog.com", "cloudinary.com", "imgsrc.ru", "instagram.com", "snapfish.com", "shutterfly.com", "tumblr.com",
    "reddituploads.com", "vgy.me", "imageupper.com", "postimg.cc", "imgclick.net", "freeimagehosting.net", "imageupload.net",
    "image-share.com", "pic-upload.de", "imagehosting.com",
)
SUFFIX_SCORES = {"trusted": 10, "wellknown": 5, "cdn": 3, "vps": 2, "img": 8}
TLD_ABUSE = {
    "com": 0.6554, "net": 0.1040, "eu": 0.0681, "name": 0.0651, "co": 0.0107, "life": 0.0087, "moe": 0.0081, "org": 0.0081,
    "xyz": 0.0072, "site": 0.0051, "ch": 0.0051, "it": 0.0048, "club": 0.0046, "info": 0.0043, "de": 0.0041, "racing": 0.0040,
    "live": 0.0035, "ru": 0.0034, "cc": 0.0034, "mobi": 0.0029, "me": 0.0023, "au": 0.0020, "cn": 0.0019, "pw": 0.0014,
    "in": 0.0011, "fr": 0.0010, "be": 0.0010, "pro": 0.0010, "top": 0.0009, "stream": 0.0007,
}


def suffix_table(spark: SparkSession, suffixes: tuple[str, ...] = DEFAULT_SUFFIXES) -> DataFrame:
    """A table ``suffix`` whose size Spark knows, so that it decides on a broadcast by itself."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{s}')" for s in suffixes) + " AS t(suffix)")


def _ascii(names: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Names with each label that isn't ASCII as it stands in DNS (punycode)."""
    label = lambda x: x if x.isascii() else "xn--" + x.encode("punycode").decode()
    for batch in names:
        yield batch.map(lambda n: ".".join(map(label, unicodedata.normalize("NFC", n.lower()).split("."))))


def suffix_rules(suffixes: DataFrame) -> tuple[DataFrame, int]:
    """Rules by the name that they are found at: tail, plain, wild (``*.tail``), exempt (``!tail``); and the labels of the longest
    tail, which a small job over the rules finds. Rules that aren't ASCII stand in both spellings."""
    own = suffixes.select(F.lower(F.trim("suffix")).alias("rule")).where("rule <> ''")
    kinds = own.select(F.regexp_replace("rule", r"^(\*\.|!)", "").alias("tail"), F.startswith("rule", F.lit("*.")).alias("wild"), F.startswith("rule", F.lit("!")).alias("exempt"))
    foreign = kinds.where("tail rlike '[^\\\\x00-\\\\x7f]'")
    both = kinds.unionByName(foreign.withColumn("tail", F.pandas_udf(_ascii, "string")("tail")))
    found = both.groupBy("tail").agg(F.bool_or(~F.col("wild") & ~F.col("exempt")).alias("plain"), F.bool_or("wild").alias("wild"), F.bool_or("exempt").alias("exempt"))
    return found, own.agg(F.coalesce(F.max(F.size(F.split("rule", r"\."))), F.lit(0))).first()[0]


def split_names(df: DataFrame, name: str = "domain_name", suffixes: DataFrame | None = None) -> DataFrame:
    """df with subdomain, sld and suffix: an exception rule (``!``) wins, then the longest suffix, a ``*`` being any one label;
    without a rule, suffix is empty.

    One equi-join with the rules for each possible number of labels, of which there are as many as the longest rule has: no row is
    multiplied and none is grouped.
    """
    if suffixes is None:
        rules = suffix_table(df.sparkSession).select(F.col("suffix").alias("tail"), F.lit(True).alias("plain"), F.lit(False).alias("wild"), F.lit(False).alias("exempt"))
        most = max(s.count(".") + 1 for s in DEFAULT_SUFFIXES)
    else:
        rules, most = suffix_rules(suffixes)
    out = df.withColumn("_l", F.split(F.lower(F.col(name)), r"\."))
    size = F.size("_l")
    lengths, exempt = [], []
    for k in range(1, most + 1):
        tail = F.when(size >= k, F.array_join(F.slice("_l", -k, k), "."))
        out = out.withColumn(f"_c{k}", tail).join(rules.select(F.col("tail").alias(f"_s{k}"), *[F.col(c).alias(f"_{c}{k}") for c in ("plain", "wild", "exempt")]), F.col(f"_c{k}") == F.col(f"_s{k}"), "left")
        lengths += [F.when(F.col(f"_plain{k}"), k), F.when(F.col(f"_wild{k}") & (size > k), k + 1)]
        exempt.append(F.when(F.col(f"_exempt{k}"), k - 1))
    n = F.coalesce(*reversed(exempt), F.array_max(F.array(*lengths)), F.lit(0)) if most else F.lit(0)
    rest = size - F.col("_n")
    out = out.withColumn("_n", n).withColumns(
        {
            "suffix": F.when(F.col("_n") > 0, F.array_join(F.slice("_l", rest + 1, F.col("_n")), ".")).otherwise(""),
            "sld": F.when(rest > 0, F.element_at("_l", rest)).otherwise(""),
            "subdomain": F.when(rest > 1, F.array_join(F.slice("_l", F.lit(1), rest - 1), ".")).otherwise(""),
        }
    )
    return out.drop("_l", "_n", *[f"_{c}{k}" for k in range(1, most + 1) for c in ("c", "s", "plain", "wild", "exempt")])


def url_host(url: str) -> str:
    """SQL: the lower-cased host of a url without user and port; empty if there is none."""
    return f"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
