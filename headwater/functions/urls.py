"""Keys and display forms of links. Collection and audit have keys of their own on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headwater.functions.text import strip

#: Parameters that only track or change the looks of a page.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_name", "utm_reader",
    "fbclid", "gclid", "gclsrc", "dclid", "msclkid", "ttclid", "yclid", "igshid",
    "mc_cid", "mc_eid", "spm", "ref", "referer", "referrer", "referral", "source", "src", "from",
    "cmpid", "cmp", "campaign", "cloc", "dablewidget", "outputtype", "amp",
)
TRACKING_PREFIXES = ("utm_", "_ga", "ga_", "nil_", "t__nil", "pk_", "mtm_", "piwik_")
SECTION_PARAMETERS = ("sid", "sid1", "sid2", "mid")
SECTION_HOSTS = ("naver.com", "nate.com", "daum.net")
#: The shorter lists of the audit.
AUDIT_TRACKING = ("fbclid", "gclid", "igshid", "spm", "ref", "refer", "cmpid", "ncid")
AUDIT_PREFIXES = ("utm_", "_ga")


def _starts(c: Column, prefixes: tuple[str, ...]) -> Column:
    return c.rlike("^(" + "|".join(prefixes) + ")")


def _path(c: Column) -> Column:
    return F.when(F.length(c) > 1, F.regexp_replace(c, "/+$", "")).when(c == "", F.lit("/")).otherwise(c)


def _parts(url: Column) -> tuple[Column, Column, Column, Column]:
    """Scheme, authority, path and query, without failing on odd input."""
    whole = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    return tuple(F.regexp_extract(url, whole, i) for i in (1, 2, 3, 4))  # type: ignore[return-value]


def _query(query: Column, keep, blanks: bool) -> Column:
    """Sorted pairs that ``keep`` lets through, encoded again, with a question mark if there are any."""
    pairs = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.struct(_decoded(F.substring_index(x, "=", 1)).alias("name"), F.when(F.instr(x, "=") > 0, _decoded(F.substring(x, F.instr(x, "=") + 1, F.length(x)))).otherwise("").alias("value")))
    pairs = F.array_sort(F.filter(pairs, lambda p: keep(F.lower(p["name"])) & (F.lit(True) if blanks else p["value"] != "")))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(F.url_encode(p["name"]), F.lit("="), F.url_encode(p["value"]))), "&")
    return F.when(text != "", F.concat(F.lit("?"), text)).otherwise("")


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def collect_key(url: Column) -> Column:
    """Host without user, default port and one of www., m., mobile.; path without final slashes; sorted parameters that aren't tracking."""
    text = strip(url)
    scheme, authority, path, query = _parts(text)
    host = F.regexp_replace(F.lower(authority), "^.*@", "")
    host = F.when(F.lower(scheme) == "http", F.regexp_replace(host, ":80$", "")).when(F.lower(scheme) == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    host = F.regexp_replace(host, r"^(www\.|m\.|mobile\.)", "")
    portal = host.rlike(r"(^|\.)(" + "|".join(h.replace(".", r"\.") for h in SECTION_HOSTS) + ")$")
    keep = lambda name: ~(name.isin(*TRACKING) | _starts(name, TRACKING_PREFIXES) | (portal & name.isin(*SECTION_PARAMETERS)))
    return F.when(text == "", "").when(authority == "", F.regexp_replace(F.lower(text), "/+$", "")).otherwise(F.concat(host, _path(path), _query(query, keep, False)))


def audit_key(url: Column) -> Column:
    """Host without www. only, with any port; blank parameters stay."""
    text = strip(url)
    text = F.when(F.instr(F.substring_index(text, "?", 1), "//") > 0, text).otherwise(F.concat(F.lit("http://"), text))
    _, authority, path, query = _parts(text)
    host = F.regexp_replace(F.regexp_replace(F.lower(authority), "^.*@", ""), r"^www\.", "")
    keep = lambda name: ~(name.isin(*AUDIT_TRACKING) | _starts(name, AUDIT_PREFIXES))
    return F.when(strip(url) == "", "").otherwise(F.concat(host, _path(path), _query(query, keep, True)))


def tidy(url: Column) -> Column:
    """Without the default port of its own scheme."""
    c = F.regexp_replace(url, r"(?i)^(https://[^/?#]*):443(?=[/?#]|$)", "$1")
    return F.regexp_replace(c, r"(?i)^(http://[^/?#]*):80(?=[/?#]|$)", "$1")


def outlet(url: Column) -> Column:
    """The host by which outlets are told apart: without www., m. and amp., one after another."""
    host = F.regexp_replace(F.lower(_parts(strip(url))[1]), "^.*@|:.*$", "")
    for prefix in ("www", "m", "amp"):
        host = F.regexp_replace(host, rf"^{prefix}\.", "")
    return host


def short(url: Column, most: int = 48) -> Column:
    bare = F.regexp_replace(url, "^https?://", "")
    return F.when(F.length(bare) <= most, bare).otherwise(F.concat(F.left(bare, F.lit(most - 3)), F.lit("...")))
