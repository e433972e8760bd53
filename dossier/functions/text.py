"""Column functions on text: tokens, digits, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Legal forms and generic words that do not distinguish a name.
LEGAL_AND_GENERIC = (
    "as", "asa", "ans", "da", "enk", "iks", "sa", "sam", "sti", "stiftelsen",
    "nuf", "ab", "b", "v", "limited", "ltd", "inc", "plc", "the", "og", "and",
)
#: Words that a search result shares with any company.
GENERIC_NAME_TOKENS = ("as", "asa", "ans", "da", "enk", "sa", "nuf", "company", "norge", "norway", "gruppen", "group")
#: Query parameters that never mark a material change.
TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid", "mc_cid", "mc_eid", "_ga", "ref", "ref_src", "igshid",
)
#: Hosts that may name a company but never prove it.
BLOCKED_HOSTS = (
    "proff.no", "purehelp.no", "1881.no", "gulesider.no", "firmalisten.no", "companywall.no",
    "firmadatabasen.no", "sokfirma.no", "yra.no", "northdata.com", "nor47business.com",
    "linkedin.com", "facebook.com", "instagram.com", "x.com", "twitter.com", "youtube.com", "tiktok.com",
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def collapse(text: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fold_ascii(text: Column) -> Column:
    """Nordic letters and common accents to ASCII, the rest beyond ASCII dropped, then lower case."""
    plain = F.replace(F.replace(text, F.lit("æ"), F.lit("ae")), F.lit("Æ"), F.lit("AE"))
    plain = F.translate(plain, "øåØÅéèêëáàâäíìîïóòôöúùûüñçÉÈÊËÁÀÂÄÍÌÎÏÓÒÔÖÚÙÛÜÑÇ", "oaOAeeeeaaaaiiiioooouuuuncEEEEAAAAIIIIOOOOUUUUNC")
    return F.lower(F.regexp_replace(plain, r"[^\x00-\x7F]", ""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(fold_ascii(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def name_tokens(text: Column, drop: tuple[str, ...] = LEGAL_AND_GENERIC) -> Column:
    """Distinctive tokens of a company name: no legal forms, no single characters."""
    return F.filter(words(text), lambda w: ~w.isin(*drop) & (F.length(w) > 1))


def host(url: Column) -> Column:
    """Lower-case host without ``www.``; "" where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), r"^www\.", "")


def on_host(h: Column, hosts: tuple[str, ...]) -> Column:
    """``h`` is one of ``hosts`` or a subdomain of one."""
    hit = F.lit(False)
    for blocked in hosts:
        hit = hit | (h == blocked) | h.endswith(f".{blocked}")
    return hit


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encoded(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Scheme and host with its port in lower case, no ``www.``, no trailing slash, tracking and blank parameters and fragment
    gone, the rest decoded, sorted and encoded one way. Text that is no URL: white space collapsed."""
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(whole, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    netloc = F.regexp_replace(F.lower(F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.filter(F.split(F.regexp_extract(whole, r"\?(.*)$", 1), "&"), lambda p: p.rlike("^[^=]*=."))
    pairs = F.transform(query, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    keep = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING_PARAMS)))
    tail = F.array_join(F.transform(keep, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    made = F.concat(scheme, F.lit("://"), netloc, path, F.when(tail == "", "").otherwise(F.concat(F.lit("?"), tail)))
    return F.when(scheme == "", collapse(url)).otherwise(made)


def sha(text: Column) -> Column:
    return F.sha2(text, 256)
