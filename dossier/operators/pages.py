"""Web pages as Columns: fields, homepage form, priority links, news pages, address guard, module endpoints (SRC-05, SRC-08, SRC-09, PRJ-15, PRJ-16, LIM-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import collapse, host

#: Paths and link texts worth a second request, in order of preference.
PRIORITY_TERMS = (
    "om-oss", "om_oss", "about", "kontakt", "contact", "ledelse", "management", "team", "people", "locations",
    "lokasjoner", "avdelinger", "butikker", "news", "press", "aktuelt", "nyheter",
)
#: Fixed value: folders of news.
_NEWS = r"(?i)/(?:news|press|aktuelt|nyheter|artikler|blog)(?:/|$)"


def homepage(url: Column) -> Column:
    """https where no scheme is given; query and fragment dropped; null where there is no host."""
    text = F.trim(F.coalesce(url, F.lit("")))
    full = F.when(text.rlike("(?i)^https?://"), text).otherwise(F.concat(F.lit("https://"), text))
    bare = F.regexp_replace(full, r"[?#].*$", "")
    formed = F.when(bare.rlike(r"(?i)^https?://[^/]+$"), F.concat(bare, F.lit("/"))).otherwise(bare)
    return F.when((text != "") & (host(formed) != ""), formed)


#: Address blocks that are not global, as first and last number.
CLOSED_BLOCKS = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
    "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)


def address_number(h: Column) -> Column:
    """The IPv4 address a host writes in one to four decimal, octal or hexadecimal parts; null for a name, -1 out of range."""
    parts = F.split(h, r"\.")
    numeric = F.forall(parts, lambda p: p.rlike("^(0x[0-9a-f]{1,8}|[0-9]{1,12})$"))
    value = lambda p: F.when(p.startswith("0x"), F.conv(F.substr(p, F.lit(3)), 16, 10)).when(p.rlike("^0[0-7]+$"), F.conv(p, 8, 10)).otherwise(p).try_cast("long")
    n, size = F.transform(parts, value), F.size(parts)
    fits = F.forall(F.transform(n, lambda x, i: F.coalesce(x <= F.when(i < size - 1, 255).otherwise(F.pow(F.lit(256), 5 - size) - 1), F.lit(False))), lambda x: x)
    shifted = F.transform(n, lambda x, i: F.when(i < size - 1, x * F.pow(F.lit(256), 3 - i).cast("long")).otherwise(x))
    total = F.aggregate(shifted, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(numeric, F.when((size <= 4) & fits, total).otherwise(-1))


def public_address(url: Column) -> Column:
    """http or https, and a host that is neither local by name nor an address outside the global ranges, in any notation.

    An IPv6 literal has to lie in 2000::/3, apart from documentation and transition prefixes. Names are not resolved here.
    """
    import ipaddress

    h = F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)), r"\.$", "")
    number = address_number(h)
    closed = number < 0
    for block in map(ipaddress.ip_network, CLOSED_BLOCKS):
        closed = closed | number.between(int(block[0]), int(block[-1]))
    name = ~h.rlike(r"(^|\.)localhost$|\.local$") & h.contains(".")
    six = h.rlike(r"^\[[23][0-9a-f]{3}:") & ~h.rlike(r"^\[(2001:0?db8:|2001:0{0,4}:|2002:)")
    public = F.when(h.startswith("["), six).when(number.isNotNull(), ~closed).otherwise(name)
    return F.coalesce(url.rlike("(?i)^https?://") & (h != "") & public, F.lit(False))


def fields(pages: DataFrame) -> DataFrame:
    """title (500), description (2000), link and script counts, visible text length, extraction state."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = collapse(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))
    own = pages.withColumns({
        "title": F.left(collapse(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(500)),
        "description": F.left(F.regexp_extract(html, r"(?is)<meta[^>]+name=\"description\"[^>]+content=\"([^\"]*)\"", 1), F.lit(2000)),
        "links": F.size(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=\"([^\"]*)\""), F.lit(1))),
        "scripts": F.size(F.regexp_extract_all(html, F.lit(r"(?i)<script[^>]*\ssrc="), F.lit(0))),
        "text_length": F.length(text),
    })
    return own.withColumn("extraction_state", F.when((F.col("text_length") < 100) & (F.col("scripts") >= 2), "js_fallback_candidate").otherwise("static_complete"))


def priority_links(pages: DataFrame, most: int = 4) -> DataFrame:
    """Links of a page to its own host that hit a term: the least rank per URL, then the best ``most`` by (rank, URL)."""
    anchors = F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*href=\"([^\"]*)\"[^>]*>.*?</a>"), F.lit(0))
    own = pages.select("page_id", "url", F.explode(anchors).alias("a"))
    href = F.trim(F.regexp_extract("a", r"(?i)href=\"([^\"]*)\"", 1))
    root = F.regexp_extract("url", r"^([A-Za-z]+://[^/?#]+)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract("url", r"^([A-Za-z]+://[^/?#]+/(?:[^?#]*/)?)", 1), F.lit("")), F.concat(root, F.lit("/")))
    scheme = F.regexp_extract("url", r"^([A-Za-z]+:)", 1)
    beside = ~href.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#|\?|$)")
    target = F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(root, href)).when(beside, F.concat(folder, F.regexp_replace(href, r"^(\./)+", "")))
    own = own.select("page_id", "url", homepage(target).alias("link"), F.lower(F.regexp_replace("a", r"(?s)<[^>]*>", " ")).alias("said"), host(F.col("url")).alias("h"))
    own = own.where((host(F.col("link")) == F.col("h")) & (F.regexp_replace("link", "/$", "") != F.regexp_replace("url", "/$", "")))
    hay = F.concat_ws(" ", F.lower(F.regexp_extract("link", r"^[A-Za-z]+://[^/]+(.*)$", 1)), "said")
    terms = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(t).alias("term")) for i, t in enumerate(PRIORITY_TERMS)))
    own = own.withColumn("hay", hay)
    rank = F.array_min(F.transform(F.filter(terms, lambda t: F.col("hay").contains(t["term"])), lambda t: t["rank"]))
    best = own.withColumn("rank", rank).where("rank is not null").groupBy("page_id", "link").agg(F.min("rank").alias("rank"))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("rank", "link"))
    return best.withColumn("nth", nth).where(F.col("nth") <= most)


def site_news(events: DataFrame) -> DataFrame:
    """Per company the captured news page with most path segments, then the least URL."""
    path = F.regexp_extract("final_url", r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1)
    depth = F.size(F.filter(F.split(path, "/"), lambda p: p != ""))
    own = events.where((F.col("status") == "available") & path.rlike(_NEWS) & (F.length("content_sha256") == 64)).withColumn("depth", depth)
    order = Window.partitionBy("organisation_number").orderBy(F.col("depth").desc(), "final_url", "seq")
    return own.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("organisation_number", "final_url", "depth")


def site_surface(events: DataFrame) -> DataFrame:
    """Pages and distinct URLs of companies whose homepage was captured with a content hash."""
    own = events.where("status = 'available' and length(content_sha256) = 64").groupBy("organisation_number")
    found = own.agg(F.count("*").alias("pages"), F.count_distinct("final_url").alias("urls"), F.max((F.col("page_kind") == "homepage").cast("int")).alias("home"))
    return found.where("home = 1").drop("home")


def endpoints(requested: DataFrame, modules: dict[str, str]) -> DataFrame:
    """(organisation_number, module, url) of the modules asked for; ``modules`` maps a name to a template with one %s."""
    rows = [F.struct(F.lit(m).alias("module"), F.format_string(t, F.col("organisation_number")).alias("url")) for m, t in sorted(modules.items())]
    return requested.select("organisation_number", F.inline(F.array(*rows)))


def _news_events(s, d):
    """Page events whose every third URL is made a news path."""
    e = bind(s, d, "page_events")
    tail = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("/news/"), F.col("seq"))).when(F.col("seq") % 3 == 1, "/press").otherwise("")
    return e.withColumn("final_url", F.concat(F.regexp_extract("final_url", r"^([A-Za-z]+://[^/?#]+)", 1), tail))


#: Addresses for the oracle, and whether a crawler may ask for them.
ADDRESSES = (
    ("https://example.no/a", True), ("http://8.8.8.8/", True), ("ftp://example.no/", False), ("http://localhost:8080/", False), ("http://a.localhost/", False), ("http://printer.local/", False),
    ("http://127.0.0.1/", False), ("http://10.1.2.3/", False), ("http://172.31.0.1/", False), ("http://172.32.0.1/", True), ("http://192.168.1.1/", False), ("http://169.254.169.254/", False),
    ("http://100.64.0.1/", False), ("http://2130706433/", False), ("http://0x7f.1/", False), ("http://0177.0.0.1/", False), ("http://134744072/", True), ("http://[::1]/", False),
    ("http://[fd00::1]/", False), ("http://[fe80::1]/", False), ("http://[::ffff:10.0.0.1]/", False), ("http://[2606:4700::1111]/", True), ("http://256.1.1.1/", False), ("https://user@10.0.0.1/", False),
    ("http://intranet/", False), ("http://example.no./", True), ("", False),
)


def _addresses(s, d):
    n = len(ADDRESSES)
    at = F.element_at(F.array(*(F.lit(a) for a, _ in ADDRESSES)), (F.col("page_id") % n + 1).cast("int"))
    return bind(s, d, "pages").select("page_id", public_address(at).alias("public"))


def _linked_pages(s, d):
    """Pages with five links: below the page, to a root path twice, elsewhere, and to a mail address."""
    k = F.col("page_id")
    html = F.concat(F.lit('<a href="om-oss/'), k, F.lit('">x</a><a class="c" href="/side">Kontakt oss</a><a href="/side">Our team</a><a href="https://other.example/about">About</a><a href="mailto:about@a.no">about</a><a href="./news?x=1">n</a>'))
    return bind(s, d, "pages").select("page_id", F.concat(F.lit("https://site"), k, F.lit(".example/no/index.html")).alias("url"), html.alias("html"))


_E = ctes("page_events")
_MODULES = {"financials": "https://api.example/accounts/%s", "roles": "https://api.example/units/%s/roles"}
QUERIES = {
    "page_fields": (lambda s, d: fields(bind(s, d, "pages")).select("page_id", "title", "links", "scripts", "extraction_state"), r"""with p as (select page_id, coalesce(html, '') as h from pages),
 q as (select *, trim(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as t, len(regexp_extract_all(h, '(?i)<script[^>]*\ssrc=')) as sc from p)
 select page_id, left(trim(regexp_replace(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), 500) as title, cast(len(regexp_extract_all(h, '(?i)<a\s[^>]*href="([^"]*)"')) as int) as links,
 cast(sc as int) as scripts, case when length(t) < 100 and sc >= 2 then 'js_fallback_candidate' else 'static_complete' end as extraction_state from q"""),
    "page_homepage": (lambda s, d: bind(s, d, "pages").select("page_id", homepage(F.col("url")).alias("homepage"), public_address(F.col("url")).alias("public")), r"""with p as (select page_id, regexp_replace(url, '[?#].*$', '') as u from pages)
 select page_id, case when regexp_matches(u, '^https?://[^/]+$') then u || '/' else u end as homepage, true as public from p"""),
    "priority_links": (lambda s, d: priority_links(_linked_pages(s, d)).select("page_id", "link", "rank", "nth"), """select page_id, 'https://site' || page_id || '.example' || replace(p, '?', cast(page_id as varchar)) as link, cast(rank as int) as rank, cast(nth as int) as nth
 from pages, (values ('/no/om-oss/?', 0, 1), ('/side', 3, 2), ('/no/news', 13, 3)) t(p, rank, nth)"""),
    "public_addresses": (_addresses, f"select page_id, case page_id % {len(ADDRESSES)} {' '.join(f'when {i} then {ok}' for i, (_, ok) in enumerate(ADDRESSES))} end as public from pages"),
    "site_news": (lambda s, d: site_news(_news_events(s, d)), rf"""{_E}, e as (select *, regexp_extract(final_url, '^([A-Za-z]+://[^/?#]+)', 1) || case seq % 3 when 0 then '/news/' || seq when 1 then '/press' else '' end as u from page_events where status = 'available' and seq % 3 <> 2),
 n as (select organisation_number, u as final_url, cast(case when seq % 3 = 0 then 2 else 1 end as int) as depth, row_number() over (partition by organisation_number order by case when seq % 3 = 0 then 2 else 1 end desc, u, seq) as k from e)
 select organisation_number, final_url, depth from n where k = 1"""),
    "site_surface": (lambda s, d: site_surface(bind(s, d, "page_events")), f"{_E} select organisation_number, count(*) as pages, count(distinct final_url) as urls from page_events where status = 'available' group by 1 having count(*) filter (where page_kind = 'homepage') > 0"),
    "module_endpoints": (lambda s, d: endpoints(bind(s, d, "registry").select("organisation_number"), _MODULES), f"{ctes('registry')} select organisation_number, 'financials' as module, 'https://api.example/accounts/' || organisation_number as url from registry union all select organisation_number, 'roles', 'https://api.example/units/' || organisation_number || '/roles' from registry"),
}
