"""Payloads of connectors as rows: search results, news feeds, directory pages, linked data, videos, posts (SRC-14..17, SRC-20, ID-09, ID-12, ID-13, JON-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import collapse, digits, fold_ascii, host, words
from dossier.operators.normalize import exact_title

#: Legal forms that may end a directory's company name.
FORM_ENDINGS = ("as", "asa", "ans", "da", "enk", "sa", "nuf")
#: Two-label suffixes under which names are registered; a stand-in for the public list.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.nz", "co.jp", "com.br")
#: Page titles that are no names of a company.
BANNED_ALIASES = ("home", "homepage", "forside", "welcome", "velkommen", "official site")


def search_results(payloads: DataFrame) -> DataFrame:
    """(organisation_number, rank, url, title, snippet) of JSON search payloads; entries without a URL keep their rank."""
    shape = "struct<web:struct<results:array<struct<url:string,title:string,description:string>>>>"
    own = payloads.select("organisation_number", F.posexplode(F.from_json("payload", shape)["web"]["results"]).alias("at", "r"))
    rows = own.select("organisation_number", (F.col("at") + 1).alias("rank"), "r.url", F.coalesce("r.title", F.lit("")).alias("title"), F.coalesce("r.description", F.lit("")).alias("snippet"))
    return rows.where(F.coalesce("url", F.lit("")) != "")


def rfc822(text: Column) -> Column:
    """UTC timestamp of a mail date; null where it does not parse. Zones are numeric, GMT, UT or Z."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(bare, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx"))


def news_items(feeds: DataFrame, limit: int = 5) -> DataFrame:
    """Items of RSS payloads of ``feeds(organisation_number, name, payload)`` whose title names the company exactly.

    The first of a (title, publisher) pair counts, whatever its case; then the first ``limit`` of a company.
    """
    item = "channel struct<item:array<struct<title:string,link:string,source:string,pubDate:string>>>"
    own = feeds.select("organisation_number", "name", F.posexplode(F.from_xml("payload", item)["channel"]["item"]).alias("at", "i"))
    text = lambda c: F.trim(F.coalesce(F.col(f"i.{c}"), F.lit("")))
    own = own.select("organisation_number", "name", "at", text("title").alias("title"), text("link").alias("link"), text("source").alias("publisher"), rfc822(F.col("i.pubDate")).alias("published_at"))
    own = own.where((F.col("link") != "") & exact_title(F.col("name"), F.col("title")))
    again = F.row_number().over(Window.partitionBy("organisation_number", F.lower("title"), F.lower("publisher")).orderBy("at"))
    first = own.withColumn("_n", again).where("_n = 1")
    nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy("at"))
    return first.withColumn("nth", nth).where(F.col("nth") <= limit).select("organisation_number", "nth", "title", "link", "publisher", "published_at")


def slug(name: Column) -> Column:
    return F.array_join(words(name), "-")


def plain_company(name: Column) -> Column:
    """Folded name without the legal forms at its end."""
    return F.regexp_replace(F.array_join(words(name), " "), rf"(?:\s(?:{'|'.join(FORM_ENDINGS)}))+$", "")


def registered_domain(url: Column) -> Column:
    """The last two labels of a host, three under a two-label suffix; "" for an address or a single label."""
    labels = F.split(host(url), r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")
    return F.when((F.size(labels) < 2) | host(url).rlike(r"^[0-9.]+$"), "").when(two.isin(*TWO_LABEL_SUFFIXES), F.when(F.size(labels) > 2, three).otherwise("")).otherwise(two)


def full_name(text: Column) -> Column:
    """Lower-case words of letters a-z, æ, ø, å and digits, one space apart."""
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9æøå]+"), F.lit(0)), " ")


def aliases(legal_name: Column, titles: Column, most: int = 3) -> Column:
    """Names that ``titles`` give up to a spaced bar or long dash, other than banned ones and the legal name, of 3 to 80 characters
    as ``full_name``; in order, each once."""
    cut = F.transform(titles, lambda t: F.trim(F.regexp_replace(F.coalesce(t, F.lit("")), r"(?s)\s+[|–—]\s+.*$", "")))
    fit = lambda t: ~full_name(t).isin("", *BANNED_ALIASES) & (full_name(t) != full_name(legal_name)) & F.length(full_name(t)).between(3, 80)
    return F.slice(F.array_distinct(F.filter(cut, fit)), 1, most)


def review_label(stars: Column) -> Column:
    return F.when(stars <= 2, "negative").when(stars >= 4, "positive").when(stars.isNotNull(), "neutral")


def clean_label(text: Column) -> Column:
    """A model's answer as a label; null where it is none."""
    bare = F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n.,:;!\"'`*")))
    return F.when(bare.isin("positive", "neutral", "negative", "mixed"), bare)


def video_channels(results: DataFrame) -> DataFrame:
    """Channel of ``results(organisation_number, company, channel, channel_url, description, domain)`` with the company's name:
    the one with most results, then the least URL. It needs two results or the company's domain in a description; where it has
    neither, the company has none, whatever other channels prove.
    """
    same = fold_ascii(collapse(F.col("channel"))) == fold_ascii(collapse(F.col("company")))
    proof = (F.col("domain") != "") & F.lower("description").contains(F.col("domain"))
    per = results.where(same & (F.coalesce("channel_url", F.lit("")) != "")).groupBy("organisation_number", "channel_url").agg(F.count("*").alias("n"), F.max(F.coalesce(proof, F.lit(False))).alias("by_domain"))
    nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy(F.col("n").desc(), "channel_url"))
    return per.withColumn("_n", nth).where("_n = 1 and (n >= 2 or by_domain)").select("organisation_number", "channel_url", "n", "by_domain")


def post_engagement(posts: DataFrame, engagement: DataFrame) -> DataFrame:
    """Posts with their likes and comments by activity id; none counts as 0, of repeated ids the last."""
    last = engagement.groupBy("activity_id").agg(F.max_by(F.struct("likes", "comments"), "seq").alias("e"))
    held = posts.join(last, "activity_id", "left")
    return held.select(*posts.columns, F.coalesce("e.likes", F.lit(0)).cast("long").alias("likes"), F.coalesce("e.comments", F.lit(0)).cast("long").alias("comments"))


def typeahead(payloads: DataFrame) -> DataFrame:
    """(organisation_number, company_id, label, exact) of JSON suggestions of companies; exact where the plain names agree."""
    own = payloads.select("organisation_number", "name", F.explode(F.from_json("payload", "array<struct<type:string,id:string,displayName:string>>")).alias("s"))
    own = own.where("s.type = 'COMPANY' and s.id is not null")
    return own.select("organisation_number", F.col("s.id").alias("company_id"), F.col("s.displayName").alias("label"), (plain_company(F.col("s.displayName")) == plain_company(F.col("name"))).alias("exact"))


# --- bindings: payloads made of the driver's tables ------------------------------------------------------------------


def _companies(s, d):
    return bind(s, d, "registry").select("organisation_number", "name", (F.col("organisation_number").cast("bigint") - 900000000).alias("k"), "municipality")


def _search_payloads(s, d):
    entry = lambda i: F.struct(F.when((F.col("k") + i) % 4 != 0, F.concat(F.lit("https://e"), F.lit(i), F.lit(".example/"), "k")).alias("url"), F.concat("name", F.lit(f" {i}")).alias("title"), F.lit("said").alias("description"))
    return _companies(s, d).select("organisation_number", F.to_json(F.struct(F.struct(F.array(*map(entry, range(3))).alias("results")).alias("web"))).alias("payload"))


def _feeds(s, d):
    k = F.col("k")
    item = lambda title, link, source, date: F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><source>"), source, F.lit("</source><pubDate>"), date, F.lit("</pubDate></item>"))
    own = F.concat("name", F.lit(" vokser - Avisen"))
    body = F.concat(
        item(own, F.lit("https://n.example/1"), F.lit("Avisen"), F.lit("Mon, 03 Aug 2026 10:00:00 +0200")),
        item(F.concat("name", F.lit(" VOKSER - avisen")), F.lit("https://n.example/2"), F.lit("AVISEN"), F.lit("Mon, 03 Aug 2026 10:00:00 GMT")),
        item(F.concat(F.lit("Sjefen i Gruppe "), "name"), F.lit("https://n.example/3"), F.lit("Bladet"), F.lit("3 Aug 2026 10:00:00 GMT")),
        item(F.concat(F.lit("Nytt fra "), "name"), F.when(k % 3 == 0, "").otherwise("https://n.example/4"), F.lit("Bladet"), F.when(k % 2 == 0, "4 Aug 2026 08:30:00 GMT").otherwise("yesterday")),
    )
    return _companies(s, d).select("organisation_number", "name", F.concat(F.lit("<rss><channel>"), body, F.lit("</channel></rss>")).alias("payload"))


def _domains(s, d):
    k = F.col("page_id")
    url = F.when(k % 5 == 0, F.concat(F.lit("https://www.shop"), k, F.lit(".co.uk/x"))).when(k % 5 == 1, F.concat(F.lit("http://a.b.site"), k, F.lit(".no"))).when(k % 5 == 2, "https://10.0.0.1/").when(k % 5 == 3, "https://localhost/").otherwise("https://co.uk/")
    return bind(s, d, "pages").select("page_id", registered_domain(url).alias("domain"))


def _aliases(s, d):
    k = F.col("k")
    made = F.array(
        F.concat(F.lower("name"), F.lit(" | Home")), F.lit("Home | x"), F.lit("Official site"), F.concat("name", F.lit(" - "), "municipality"), F.concat(F.lit("Shop "), k % 3, F.lit(" – offers — more")), F.lit(" ab "), F.lit(None).cast("string"),
        F.when(k % 4 == 0, F.concat(F.lit("Shop "), k % 3)).otherwise("Third-party name"), F.repeat(F.lit("long "), F.lit(20)), F.lit("Fourth"), F.lit("Fifth"),
    )
    return _companies(s, d).select("organisation_number", F.array_join(aliases(F.col("name"), made), "/").alias("aliases"))


def _labels(s, d):
    k = F.col("doc_id")
    said = F.when(k % 5 == 0, " Positive.").when(k % 5 == 1, "NEGATIVE!").when(k % 5 == 2, "mixed").when(k % 5 == 3, "I think positive").otherwise(F.lit(None))
    stars = F.when(k % 7 != 6, k % 6)
    return bind(s, d, "labels").select("doc_id", clean_label(said).alias("said"), review_label(stars).alias("review"))


def _videos(s, d):
    e = bind(s, d, "events").select((F.col("user_id") % 200 + 1).alias("k"), F.col("event_id").alias("v"))
    own = e.join(_companies(s, d), "k")
    channel = F.when(F.col("v") % 3 == 0, F.upper("name")).otherwise(F.concat("name", F.lit(" fans")))
    return own.select("organisation_number", F.col("name").alias("company"), channel.alias("channel"), F.concat(F.lit("https://v.example/c"), F.col("v") % 4).alias("channel_url"), F.when(F.col("v") % 12 == 0, "see k.example").otherwise("").alias("description"), F.when(F.col("k") % 2 == 0, "k.example").otherwise("").alias("domain"))


def _posts(s, d):
    e = bind(s, d, "events")
    posts = e.where("event_id % 2 = 0").select(F.col("event_id").alias("activity_id"), "user_id")
    seen = e.where("event_id % 3 = 0").select(F.col("event_id").alias("activity_id"), F.floor("value").alias("likes"), F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 7).alias("comments"), F.col("event_id").alias("seq"))
    again = seen.where("activity_id % 4 = 0").select("activity_id", (F.col("likes") + 1).alias("likes"), "comments", (F.col("seq") + 1000000000).alias("seq"))
    return post_engagement(posts, seen.unionByName(again))


def _typeahead(s, d):
    k = F.col("k")
    entry = lambda t, i, n: F.struct(F.lit(t).alias("type"), i.alias("id"), n.alias("displayName"))
    made = F.array(entry("COMPANY", k.cast("string"), F.concat(F.upper("name"), F.lit(" ASA"))), entry("PERSON", F.lit("p"), F.col("name")), entry("COMPANY", F.when(k % 2 == 0, "x"), F.col("name")), entry("COMPANY", F.lit("y"), F.concat("name", F.lit(" Norge"))))
    return typeahead(_companies(s, d).select("organisation_number", "name", F.to_json(made).alias("payload")))


_R = f"{ctes('registry')}, c as (select organisation_number, name, cast(organisation_number as bigint) - 900000000 as k, municipality from registry)"
_LOWER = "lower(replace(name, '#', ' '))"
QUERIES = {
    "search_api_results": (lambda s, d: search_results(_search_payloads(s, d)), f"{_R} select organisation_number, cast(i + 1 as int) as rank, 'https://e' || i || '.example/' || k as url, name || ' ' || i as title, 'said' as snippet from c, range(3) t(i) where (k + i) % 4 <> 0"),
    "news_rss_items": (lambda s, d: news_items(_feeds(s, d)).withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm")), f"""{_R}, i as (select organisation_number, 1 as nth, name || ' vokser - Avisen' as title, 'https://n.example/1' as link, 'Avisen' as publisher, '2026-08-03 08:00' as published_at from c
 union all select organisation_number, 2, 'Nytt fra ' || name, 'https://n.example/4', 'Bladet', case when k % 2 = 0 then '2026-08-04 08:30' end from c where k % 3 <> 0) select organisation_number, cast(nth as int) as nth, title, link, publisher, published_at from i"""),
    "registered_domains": (_domains, "select page_id, case page_id % 5 when 0 then 'shop' || page_id || '.co.uk' when 1 then 'site' || page_id || '.no' else '' end as domain from pages"),
    "site_aliases": (_aliases, f"{_R} select organisation_number, name || ' - ' || municipality || '/Shop ' || k % 3 || case when k % 4 = 0 then '/Fourth' else '/Third-party name' end as aliases from c"),
    "label_cleaning": (_labels, "select doc_id, case doc_id % 5 when 0 then 'positive' when 1 then 'negative' when 2 then 'mixed' end as said, case when doc_id % 7 = 6 then null when doc_id % 6 <= 2 then 'negative' when doc_id % 6 >= 4 then 'positive' else 'neutral' end as review from labels"),
    "video_channels": (lambda s, d: video_channels(_videos(s, d)), f"""{_R}, v as (select c.organisation_number, k, event_id as v, 'https://v.example/c' || event_id % 4 as channel_url from events join c on c.k = user_id % 200 + 1 where event_id % 3 = 0),
 p as (select organisation_number, channel_url, count(*) as n, bool_or(v % 12 = 0 and k % 2 = 0) as by_domain from v group by all),
 r as (select *, row_number() over (partition by organisation_number order by n desc, channel_url) as i from p) select organisation_number, channel_url, n, by_domain from r where i = 1 and (n >= 2 or by_domain)"""),
    "post_engagement": (_posts, """select event_id as activity_id, user_id, cast(case when event_id % 3 = 0 then floor(value) + case when event_id % 4 = 0 then 1 else 0 end else 0 end as bigint) as likes,
 cast(case when event_id % 3 = 0 and event_id % 5 <> 0 then event_id % 7 else 0 end as bigint) as comments from events where event_id % 2 = 0"""),
    "company_typeahead": (_typeahead, f"""{_R} select organisation_number, cast(k as varchar) as company_id, upper(name) || ' ASA' as label, true as exact from c union all select organisation_number, 'x', name, true from c where k % 2 = 0
 union all select organisation_number, 'y', name || ' Norge', false from c"""),
    "company_slugs": (lambda s, d: _companies(s, d).select("organisation_number", slug(F.concat(F.lit("Ærlig Ål "), "name")).alias("slug"), plain_company(F.concat("name", F.lit(" NUF ASA"))).alias("plain")), f"{_R} select organisation_number, 'aerlig-al-' || regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') as slug, trim(regexp_replace(lower(replace(name, ' AS', '')), '[^a-z0-9]+', ' ', 'g')) as plain from c"),
}
