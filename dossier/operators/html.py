"""Pages as trees and their linked data as variants (SRC-08, SRC-16, PRJ-15, ID-13, main text, social links).

One tokeniser in Arrow batches turns a page into rows, a row per element and per piece of text, with depth, path and the
element that holds it; every field is then a DataFrame expression over these rows. Unclosed elements end with what holds
them, stray end tags say nothing, and paragraphs, list items, cells and options end where the next one begins.

Linked data is parsed into VARIANT and walked by a recursive query over ``variant_explode``: a row per value at any depth
(up to ``DEEPEST``), with its key and its path. Objects list their members by name there, so that is their order here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dossier.bindings import bind, ctes
from dossier.functions.frames import dealt, with_once
from dossier.functions.text import collapse, digits, host
from dossier.operators.feeds import slug
from dossier.operators.identity import social_url
from dossier.work import workers_see_us

#: Elements that have no content, that the next of their kind ends, that hold blocks of text, and whose text is none of the page's.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset("article aside body div dd dt footer form header li main nav section table td".split())
#: Element -> what its start ends, up to what it cannot leave.
ENDED_BY = {
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl div article aside footer form header main nav section table".split(), (("p",), BLOCKS)),
    "li": (("li",), ("ul", "ol")), "option": (("option",), ("select",)), **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("tr", "table"))), "tr": (("td", "th", "tr"), ("table",)),
}
SILENT = ("script", "style", "noscript", "template")
ASIDE = ("nav", "header", "footer", "aside", "form")
#: Kinds of organisation in linked data; how many of them a page may have.
ORGANISATIONS, MOST_ORGANISATIONS = ("Organization", "Corporation", "LocalBusiness", "Store", "Restaurant"), 20
#: Members of linked data that hold a name.
NAMES = ("name", "legalName", "alternateName")
DEEPEST = 90
#: Characters of pages after which a batch of what was picked from them ends.
PICKED = 1 << 20
NODE = "node int, parent int, depth int, tag string, path string, block int, attrs map<string,string>, text string"


class _Tree(HTMLParser):
    """Rows (node, parent, depth, tag, path, block, attrs, text) of one page; block is the nearest element of ``BLOCKS``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.open: list[tuple[int, str, str, int]] = []  # node, tag, path, block

    def _add(self, tag: str, attrs: list | None, text: str | None) -> tuple[int, str, str, int]:
        node = len(self.rows)
        parent, _, path, block = self.open[-1] if self.open else (-1, "", "/", -1)
        own = (node, tag, f"{path}{tag}/", node if tag in BLOCKS else block) if text is None else (node, tag, path, block)
        self.rows.append((node, parent, len(self.open), tag, own[2], own[3], attrs, text))
        return own

    def handle_starttag(self, tag, attrs):
        ended, scope = ENDED_BY.get(tag, ((), ()))
        ends = None
        for at in range(len(self.open) - 1, -1, -1) if ended else ():
            if self.open[at][1] in ended:
                ends = at
            elif self.open[at][1] in scope:
                break
        if ends is not None:
            del self.open[ends:]
        own = self._add(tag, [(k, v or "") for k, v in dict(reversed(attrs)).items()], None)
        if tag not in VOID:
            self.open.append(own)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][1] == tag:
                del self.open[at:]
                break

    def handle_data(self, data):
        last = self.rows[-1] if self.rows else None
        if last and last[3] == "#text" and last[1] == (self.open[-1][0] if self.open else -1):
            self.rows[-1] = (*last[:7], last[7] + data)  # the parser gives a text in parts
        elif data.strip():
            self._add("#text", None, data)


def tree(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(``key``, node, parent, depth, tag, path, block, attrs, text) of ``pages(key, html)``; null or empty pages have no rows."""
    workers_see_us(pages.sparkSession)
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string()]
    names = [key, *(c.split(" ")[0] for c in NODE.split(", "))]

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a page at a time: a page's rows may be many
                page = _Tree()
                page.feed(batch.column(1)[at].as_py() or "")
                page.close()
                if page.rows:
                    keys = batch.column(0).take(pa.array([at] * len(page.rows)))
                    yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(zip(*page.rows), kinds))], names=names)

    own = dealt(pages.select(key, "html"), key)
    return own.mapInArrow(nodes, f"{key} {own.schema[key].dataType.simpleString()}, {NODE}")


def picked(pages: DataFrame, pick: Callable[[list[tuple]], tuple], kinds: str) -> DataFrame:
    """``pages(..., html)`` without html, with the columns ``kinds`` that ``pick`` takes from a page's rows (those of ``tree``).

    A row per page: for what has many fields, none of which needs another page, so that pages are read once and nothing is
    joined. Null and empty pages have no rows to pick from. Batches end after ``PICKED`` characters of html.
    """
    workers_see_us(pages.sparkSession)
    added = StructType.fromDDL(kinds)
    kept = [c for c in pages.columns if c != "html"]
    own = pages.select(*kept, "html")
    types, names = [f.type for f in to_arrow_schema(added)], [*kept, *added.names]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, start, found, read = batch.column(len(kept)), 0, [], 0
            for at in range(batch.num_rows):
                text = html[at].as_py() or ""
                page = _Tree()
                page.feed(text)
                page.close()
                found.append(pick(page.rows))
                read += len(text)
                if read > PICKED or at + 1 == batch.num_rows:
                    columns = [c.slice(start, len(found)) for c in batch.columns[: len(kept)]]
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, t) for c, t in zip(zip(*found), types))], names=names)
                    start, found, read = at + 1, [], 0

    return own.mapInArrow(rows, StructType([*own.drop("html").schema, *added]))


def _under(*tags: str) -> Column:
    return F.col("path").rlike(f"/(?:{'|'.join(tags)})/")


def texts(nodes: DataFrame, where: Column, key: str, name: str) -> DataFrame:
    """Per page the text of the pieces that meet ``where``, in order, white space collapsed."""
    pieces = nodes.where((F.col("tag") == "#text") & where & ~_under(*SILENT))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "text"))), lambda t: t["text"]), " ")
    return pieces.groupBy(key).agg(collapse(joined).alias(name))


def main_texts(nodes: DataFrame, key: str) -> DataFrame:
    """(key, main_text): text of blocks of which links make half or less, outside navigation, headers, footers, asides and forms;
    where a page has an article or main element, of those inside it only."""
    pieces = nodes.where((F.col("tag") == "#text") & ~_under(*SILENT, *ASIDE, "title"))
    length = F.length(collapse(F.col("text")))
    blocks = pieces.groupBy(key, "block").agg(F.sum(length).alias("chars"), F.sum(F.when(_under("a"), length).otherwise(0)).alias("linked"), F.max(_under("article", "main").cast("int")).alias("inner"))
    best = blocks.withColumn("has_inner", F.max("inner").over(Window.partitionBy(key)))
    kept = best.where("2 * linked <= chars and inner = has_inner").select(key, "block")
    return texts(pieces.join(kept, [key, "block"], "left_semi"), F.lit(True), key, "main_text")


def fields(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page title (500), description (2000), footer, main_text (5000), links, scripts and extraction state."""
    nodes = tree(pages, key)
    attr = lambda name: F.col("attrs")[name]
    says = F.coalesce(F.lower(attr("name")) == "description", F.lit(False)) | F.coalesce(attr("property") == "og:description", F.lit(False))
    counted = nodes.groupBy(key).agg(
        F.min_by(F.trim(attr("content")), F.when((F.col("tag") == "meta") & says, F.col("node"))).alias("description"),
        F.count_if((F.col("tag") == "a") & attr("href").isNotNull()).alias("links"), F.count_if((F.col("tag") == "script") & attr("src").isNotNull()).alias("scripts"),
        F.min(F.when(F.col("path").rlike("/title/$") & ~_under("svg"), F.col("parent"))).alias("_title"),
    )
    first_title = nodes.where((F.col("tag") == "#text") & F.col("path").rlike("/title/$") & ~_under("svg")).groupBy(key, "parent").agg(F.min("node").alias("at"), collapse(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "text"))), lambda t: t["text"]), " ")).alias("title"))
    title = first_title.groupBy(key).agg(F.min_by("title", "at").alias("title"))
    own = pages.select(key).join(counted.drop("_title"), key, "left").join(title, key, "left").join(texts(nodes, _under("footer"), key, "footer"), key, "left").join(main_texts(nodes, key), key, "left")
    text = lambda c, most: F.left(F.coalesce(c, F.lit("")), F.lit(most)).alias(c)
    state = F.when((F.length(F.coalesce("main_text", F.lit(""))) < 100) & (F.coalesce("scripts", F.lit(0)) >= 2), "js_fallback_candidate").otherwise("static_complete")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return own.select(key, text("title", 500), text("description", 2000), F.coalesce("footer", F.lit("")).alias("footer"), text("main_text", 5000), zero("links"), zero("scripts"), state.alias("extraction_state"))


def linked_values(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, script, path, name, value, depth): every value of a page's linked data; texts that are no JSON have none.

    ``name`` is the member's name, null for elements of lists and the whole. The session's bound on rows of a recursion is
    lifted: they grow with the pages.
    """
    nodes = tree(pages, key)
    kind = F.lower(F.trim(F.substring_index(F.col("attrs")["type"], ";", 1))) == "application/ld+json"
    scripts = nodes.where((F.col("tag") == "script") & kind).select(key, F.col("node").alias("script"))
    said = nodes.where("tag = '#text'").select(key, F.col("parent").alias("script"), F.col("text").alias("json"))
    spark = pages.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(
        f"""with recursive walk({key}, script, path, name, value, depth) as (
        select {key}, script, cast(array() as array<int>), cast(null as string), try_parse_json(json), 0 from {{held}}
        union all
        select w.{key}, w.script, array_append(w.path, e.pos), e.key, e.value, w.depth + 1 from walk w, lateral variant_explode(w.value) e where w.depth < {DEEPEST})
        select * from walk where value is not null""",
        held=scripts.join(said, [key, "script"]),
    )


def _string(value: Column) -> Column:
    """A variant's text where it is a string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _number(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string").try_cast("double")


def structured_names(values: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, names): distinct sorted texts of name, legalName and alternateName at any depth."""
    own = values.where(F.col("name").isin(*NAMES)).select(key, F.trim(_string(F.col("value"))).alias("said")).where("said is not null").distinct()
    return own.groupBy(key).agg(F.array_sort(F.collect_list("said")).alias("names"))


def organisations(values: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, script, path, kinds, value, nth): objects whose @type is one of ``ORGANISATIONS``, the first twenty of a page."""
    kind = F.try_variant_get("value", "$['@type']", "string")
    kinds = F.coalesce(F.try_variant_get("value", "$['@type']", "array<string>"), F.array_compact(F.array(kind)))
    own = values.where(F.schema_of_variant("value").startswith("OBJECT")).select(key, "script", "path", kinds.alias("kinds"), "value").where(F.arrays_overlap("kinds", F.array(*map(F.lit, ORGANISATIONS))))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("script", "path"))
    return own.withColumn("nth", nth).where(F.col("nth") <= MOST_ORGANISATIONS)


def ratings(values: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, rating, n): of the first object at the top of a script, or of the list there, whose aggregateRating has both counts."""
    rated = F.try_variant_get("value", "$.aggregateRating", "variant")
    top = values.where((F.size("path") == 0) | ((F.size("path") == 1) & F.col("name").isNull())).select(key, "script", "path", rated.alias("r"))
    count = F.coalesce(F.nullif(_number(F.col("r"), "$.ratingCount"), F.lit(0.0)), _number(F.col("r"), "$.reviewCount"))
    own = top.select(key, "script", "path", _number(F.col("r"), "$.ratingValue").alias("rating"), count.cast("int").alias("n")).where("rating is not null and n is not null")
    return own.groupBy(key).agg(F.min_by(F.struct("rating", "n"), F.struct("script", "path")).alias("r")).select(key, "r.*")


def same_as(values: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, target): texts that are a sameAs or in the list that is one, at any depth."""
    same = values.where("name = 'sameAs'").select(key, "script", "path", "value")
    one = same.select(key, _string(F.col("value")).alias("target"))
    listed = values.where(F.col("name").isNull() & (F.size("path") > 0)).select(key, "script", F.slice("path", 1, F.size("path") - 1).alias("path"), _string(F.col("value")).alias("target"))
    many = listed.join(same.select(key, "script", "path"), [key, "script", "path"], "left_semi").select(key, "target")
    return one.unionByName(many).select(key, F.trim("target").alias("target")).where("target is not null")


def resolved(base: Column, href: Column) -> Column:
    """``href`` as seen from the page ``base``: whole URLs, paths from the root or the folder with ``./`` and ``../``, ``//`` and ``?``."""
    href = F.trim(href)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.regexp_replace(path, r"[^/]*$", ""))
    joined = F.when(href.startswith("/"), href).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), href))
    bare, tail = F.regexp_extract(joined, r"^([^?#]*)", 1), F.regexp_extract(joined, r"^[^?#]*(.*)$", 1)
    parts = F.split(bare, "/")
    dotted = F.filter(parts, lambda p: (p == ".") | (p == ".."))
    step = lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(p == ".", done).otherwise(F.array_append(done, p))
    ending = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    clean = F.when(F.size(dotted) == 0, bare).otherwise(F.concat(F.array_join(F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step), "/"), ending))
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href == "", base).when(href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href)).when(href.startswith("?"), F.concat(root, path, href)).otherwise(F.concat(root, clean, tail))
    )


def social_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, platform, url) of profiles that ``pages(key, url, html)`` link, embed (data-href, iframes, plugins) or name as sameAs; each once."""
    nodes, values = tree(pages, key), linked_values(pages, key)
    attrs = F.col("attrs")
    targets = F.array_compact(F.array(F.when(F.col("tag") == "a", attrs["href"]), attrs["data-href"], F.when(F.col("tag") == "iframe", attrs["src"])))
    linked = nodes.where("tag <> '#text'").select(key, F.explode(targets).alias("href")).join(pages.select(key, F.col("url").alias("base")), key)
    linked = with_once(linked, {"target": resolved(F.col("base"), F.col("href"))})
    plugin = (host(F.col("target")) == "facebook.com") & F.col("target").rlike("^[A-Za-z]+://[^/?#]+/plugins/")
    embedded = F.try_url_decode(F.nullif(F.regexp_extract("target", r"[?&]href=([^&#]*)", 1), F.lit("")))
    found = linked.select(key, F.when(plugin, F.coalesce(embedded, F.col("target"))).otherwise(F.col("target")).alias("target"))
    every = found.unionByName(same_as(values, key)).where("target is not null")
    return with_once(every, {"s": social_url(F.col("target"))}).where("s is not null").select(key, "s.platform", "s.url").distinct()


def _exact(pages: DataFrame) -> DataFrame:
    """Pages whose text has the company's name, and its number among the digits."""
    said = texts(tree(pages, "organisation_number"), F.lit(True), "organisation_number", "text")
    return pages.join(said, "organisation_number").where(F.lower("text").contains(F.lower("name")) & digits(F.col("text")).contains(F.col("organisation_number")))


def directory_observations(pages: DataFrame) -> DataFrame:
    """Three observations of a rating on an exact page of a directory: summary, metrics and buzz.

    ``pages(organisation_number, name, html)``: the text has to hold the company's name and its number among the digits, and
    the first rating to be above 0 and at most 5 of at least one. The content hash is of the page.
    """
    key = "organisation_number"
    held = _exact(pages).join(ratings(linked_values(pages, key), key), key).where("rating > 0 and rating <= 5 and n > 0")
    digest = F.sha2("html", 256)
    url = F.concat(F.lit("https://directory.example/"), slug(F.col("name")), F.lit("-"), key)
    span = F.concat(F.lit("Aggregate rating "), "rating", F.lit("/5 of "), "n", F.lit(" reviews on the exact page of the company."))
    kinds = F.array(*(F.struct(F.lit(a).alias("kind"), F.lit(b).alias("signal_type"), F.lit(c).alias("strategy")) for a, b, c in (("review", "review_summary", "places_rating_reviews"), ("metrics", "profile_metrics", "social_profile_metrics"), ("buzz", "buzz_metrics", "buzz_peer_normalization"))))
    own = held.select(key, digest.alias("content_sha256"), url.alias("source_url"), "rating", F.col("n").alias("review_count"), span.alias("evidence_span"), F.inline(kinds))
    ident = F.concat_ws("-", F.lit("directory"), "kind", F.col(key), F.left("content_sha256", F.lit(16)))
    fixed = {"platform": "company_directory", "acquisition_mode": "rights_review_experiment", "rights_status": "review_required", "source_class": "customer_review"}
    return own.withColumns({"id": ident, "exact_entity": F.lit(True), "identity_proof_count": F.lit(3), **{k: F.lit(v) for k, v in fixed.items()}}).drop("kind")


# --- bindings -----------------------------------------------------------------------------------------------------------


def _pages(s, d):
    """The driver's pages with a description, links to profiles in every form, and linked data of several depths at their end."""
    k = F.col("page_id")
    data = F.concat(
        F.lit('[{"@graph":[{"@type":["Thing","Organization"],"name":"Say \\"'), k % 10, F.lit('\\" AS","sub":{"legalName": "Legal '), k % 3, F.lit('","deep":[[{"alternateName":"Deep"}]]}},{"name":["no name"],"sameAs":'),
        F.when(k % 2 == 0, '["https://www.instagram.com/even/","https://linkedin.com/in/person",7]').otherwise('"https://www.x.com/odd"'), F.lit('}]},{"@type":"Store","aggregateRating":{"ratingValue":"'), k % 13 / 2, F.lit('","ratingCount":'), k % 2, F.lit(',"reviewCount":'), k % 5, F.lit("}}]"),
    )
    more = F.concat(
        F.lit('<a href="https://www.linkedin.com/company/p'), k, F.lit('/about?x=1">in</a><div data-href="//facebook.com/Block'), k % 4, F.lit('"></div><iframe src="https://www.facebook.com/plugins/page.php?href=https%3A%2F%2Fwww.facebook.com%2FIn%20Frame'), k % 3, F.lit('&w=1"></iframe>'),
        F.lit('<script type="application/ld+json">{"broken": </script>'), F.when(k % 4 != 3, F.concat(F.lit('<script type="Application/LD+JSON; charset=utf-8">'), data, F.lit("</script>"))).otherwise(""),
    )
    return bind(s, d, "pages").withColumn("html", F.replace(F.concat("html", more), F.lit("</title>"), F.concat(F.lit("</title><META content='Says &quot;"), k, F.lit("&quot; ' NAME=Description>"))))


def _directory(s, d):
    k = F.col("organisation_number").cast("bigint") - 900000000
    rated = F.concat(F.lit('{"aggregateRating":{"ratingValue":"'), (k % 13 / 2).cast("string"), F.lit('","'), F.when(k % 2 == 0, "ratingCount").otherwise("reviewCount"), F.lit('":'), k % 5, F.lit("}}"))
    data = F.when(k % 3 == 0, F.concat(F.lit('[7, {"@type":"Thing"}, '), rated, F.lit("]"))).otherwise(rated)
    said = F.when(k % 7 == 0, "Somebody else").otherwise(F.col("name"))
    html = F.concat(F.lit("<html><h1>"), said, F.lit("</h1> Org.nr <b>"), F.substring("organisation_number", 1, 3), F.lit("</b> "), F.substring("organisation_number", 4, 6), F.lit('<script type="application/ld+json">{"@type":"Thing"}</script><script type=application/ld+json>'), data, F.lit("</script></html>"))
    return bind(s, d, "registry").select("organisation_number", "name", html.alias("html"))


def _directory_pages(s, d):
    k = F.col("k")
    rating = F.concat(F.lit('<script type="application/ld+json">{"@type":"Thing"}</script><script type="application/ld+json">{"name":"x","aggregateRating":{"ratingValue":"'), (k % 13 / 2).cast("string"), F.lit('","'), F.when(k % 2 == 0, "ratingCount").otherwise("reviewCount"), F.lit('":'), k % 5, F.lit("}}</script>"))
    said = F.when(k % 7 == 0, "Somebody else").otherwise(F.col("name"))
    return bind(s, d, "registry").withColumn("k", F.col("organisation_number").cast("bigint") - 900000000).select("organisation_number", "name", "k", F.concat(F.lit("<html><h1>"), said, F.lit("</h1> Org.nr "), F.substring("organisation_number", 1, 3), F.lit(" "), F.substring("organisation_number", 4, 6), rating, F.lit("</html>")).alias("html"))


def _ld_pages(s, d):
    k = F.col("page_id")
    body = F.concat(F.lit('{"@graph":[{"name":"Page '), k % 10, F.lit('","sub":{"legalName": "Legal '), k % 3, F.lit('"}},{"sameAs":'), F.when(k % 2 == 0, '["https://a.example/1","https://b.example/2"]').otherwise('"https://c.example/3"'), F.lit("}]}"))
    return bind(s, d, "pages").select("page_id", F.concat("html", F.when(k % 4 != 3, F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))).otherwise("")).alias("html"))


def _rated(s, d):
    key = "organisation_number"
    pages = _directory_pages(s, d)
    held = _exact(pages).join(ratings(linked_values(pages, key), key), key).where("rating > 0 and rating <= 5 and n > 0")
    return held.select(key, F.concat(slug(F.col("name")), F.lit("-"), key).alias("page"), "rating", "n")


def _ld_names(s, d):
    pages = _ld_pages(s, d)
    values = linked_values(pages)
    links = same_as(values).groupBy("page_id").agg(F.array_sort(F.collect_set("target")).alias("links"))
    held = pages.select("page_id").join(structured_names(values), "page_id", "left").join(links, "page_id", "left")
    listed = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    return held.select("page_id", listed("names").alias("names"), listed("links").alias("same_as"))


def _names(s, d):
    pages = _pages(s, d)
    values = linked_values(pages)
    found = pages.select("page_id").join(structured_names(values), "page_id", "left").join(organisations(values).groupBy("page_id").agg(F.count("*").alias("organisations")), "page_id", "left")
    return found.select("page_id", F.coalesce(F.array_join("names", "|"), F.lit("")).alias("names"), F.coalesce("organisations", F.lit(0)).alias("organisations"))


_OBSERVED = ("id", "organisation_number", "signal_type", "strategy", "source_url", "content_sha256", "rating", "review_count", "evidence_span")
_LD = """case when page_id % 4 <> 3 then"""
_R = f"{ctes('registry')}, c as (select organisation_number, name, cast(organisation_number as bigint) - 900000000 as k from registry)"
QUERIES = {
    "directory_ratings": (_rated, f"{_R} select organisation_number, regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') || '-' || organisation_number as page, cast(k % 13 as double) / 2 as rating, cast(k % 5 as int) as n from c where k % 7 <> 0 and k % 13 between 1 and 10 and k % 5 > 0"),
    "structured_names": (_ld_names, """select page_id, case when page_id % 4 <> 3 then 'Legal ' || page_id % 3 || '|Page ' || page_id % 10 else '' end as names,
 case when page_id % 4 = 3 then '' when page_id % 2 = 0 then 'https://a.example/1|https://b.example/2' else 'https://c.example/3' end as same_as from pages"""),
    "page_tree_fields": (lambda s, d: fields(_pages(s, d)).drop("main_text").withColumn("links", F.col("links").cast("int")), r"""with p as (select page_id, html as h, regexp_replace(regexp_replace(html, '(?is)<(script)\b.*?</script\s*>|<!--.*?-->', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g') as b from pages)
 select page_id, left(trim(regexp_replace(replace(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1), '&amp;', '&'), '\s+', ' ', 'g')), 500) as title, 'Says "' || page_id || '"' as description,
 trim(regexp_replace(replace(replace(replace(regexp_extract(b, '(?is)<footer[^>]*>(.*?)</footer>', 1), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g')) as footer,
 cast(1 + len(regexp_extract_all(b, '(?i)<a\s[^>]*href=')) as int) as links, cast(len(regexp_extract_all(h, '(?i)<script[^>]*\ssrc=')) as bigint) as scripts, 'static_complete' as extraction_state from p"""),
    "page_social_links": (lambda s, d: social_links(_pages(s, d)), """select page_id, 'linkedin' as platform, 'https://linkedin.com/company/p' || page_id as url from pages union all select page_id, 'facebook', 'https://facebook.com/Block' || page_id % 4 from pages
 union all select page_id, 'facebook', 'https://facebook.com/In Frame' || page_id % 3 from pages union all select page_id, case when page_id % 2 = 0 then 'instagram' else 'x' end, case when page_id % 2 = 0 then 'https://instagram.com/even' else 'https://x.com/odd' end from pages where page_id % 4 <> 3"""),
    "linked_data_names": (_names, f"""select page_id, {_LD} 'Deep|Legal ' || page_id % 3 || '|Say "' || page_id % 10 || '" AS' else '' end as names, cast({_LD} 2 else 0 end as bigint) as organisations from pages"""),
    "directory_observations": (lambda s, d: directory_observations(_directory(s, d)).select(*_OBSERVED), f"""{ctes("registry")}, c as (select *, cast(organisation_number as bigint) - 900000000 as k from registry),
 r as (select *, cast(k % 13 as double) / 2 as rating, cast(k % 5 as int) as n, '{{"aggregateRating":{{"ratingValue":"' || cast(cast(k % 13 as double) / 2 as varchar) || '","' || case when k % 2 = 0 then 'ratingCount' else 'reviewCount' end || '":' || k % 5 || '}}}}' as rated from c),
 h as (select *, sha256('<html><h1>' || name || '</h1> Org.nr <b>' || organisation_number[1:3] || '</b> ' || organisation_number[4:9] || '<script type="application/ld+json">{{"@type":"Thing"}}</script><script type=application/ld+json>' || case when k % 3 = 0 then '[7, {{"@type":"Thing"}}, ' || rated || ']' else rated end || '</script></html>') as sha from r where k % 7 <> 0 and rating > 0 and rating <= 5 and n > 0)
 select 'directory-' || kind || '-' || organisation_number || '-' || sha[1:16] as id, organisation_number, signal_type, strategy, 'https://directory.example/' || regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g') || '-' || organisation_number as source_url, sha as content_sha256, rating, n as review_count,
 'Aggregate rating ' || rating || '/5 of ' || n || ' reviews on the exact page of the company.' as evidence_span from h, (values ('review', 'review_summary', 'places_rating_reviews'), ('metrics', 'profile_metrics', 'social_profile_metrics'), ('buzz', 'buzz_metrics', 'buzz_peer_normalization')) t(kind, signal_type, strategy)"""),
}
