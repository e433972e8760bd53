"""Handles of companies on a network of professionals: job cards and discovery by provenance and proof (SRC-17, SRC-19, ID-10, ID-11, UDF-02).

Job cards come from a table function over the nodes of pages, partitioned by page: it yields the cards and how many the page
had. Discovery is joins: exact suggestions, then candidate addresses with the set of ways that led to each, then five rules
over that set and what the profile says; the first candidate that a rule accepts stands.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from dossier.bindings import bind, ctes
from dossier.functions.frames import with_once
from dossier.functions.text import host, on_host
from dossier.operators.feeds import aliases, full_name
from dossier.operators.html import tree
from dossier.work import workers_see_us

#: Legal forms that may end a name, roles that lead, and the host of profiles.
ENDINGS = ("as", "asa", "ba", "da", "enk", "nuf", "sa", "stiftelsen")
LEADING = ("DAGL", "LEDE", "INNH")
NETWORK = "linkedin.com"
#: Suggestions of a company that are followed, leaders that count.
FOLLOWED, MOST_LEADERS = 2, 5


def core_name(text: Column) -> Column:
    """``full_name`` of the decoded text without legal forms at its end."""
    words = full_name(F.coalesce(F.try_url_decode(text), text))
    return F.trim(F.regexp_replace(words, rf"(?:(?:^|\s)(?:{'|'.join(ENDINGS)}))+$", ""))


def company_url(url: Column) -> Column:
    """The one form of a company's address on the network, null for any other address."""
    parts = F.filter(F.transform(F.split(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1), "/"), lambda p: F.trim(F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p))), lambda p: p != "")
    slug = F.lower(F.get(parts, F.lit(1)))
    quoted = F.replace(F.replace(F.replace(F.url_encode(slug), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.when(on_host(host(F.trim(url)), (NETWORK,)) & (F.lower(F.get(parts, F.lit(0))) == "company") & slug.isNotNull(), F.concat(F.lit(f"https://{NETWORK}/company/"), quoted))


def name_url(name: Column) -> Column:
    """The address that a name would have."""
    plain = F.translate(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("æ"), F.lit("ae")), "øå", "oa")
    slug = F.array_join(F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0)), "-")
    return F.when(slug != "", F.concat(F.lit(f"https://{NETWORK}/company/"), slug))


class JobCards:
    """``TABLE(key, node, depth, tag, attrs, text)`` -> a row per card of a page: (key, total, nth, urn, job_href, title, company,
    company_href, location, posted). The table's first column is the key, of any type; it and node decide parts and order."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        key = table.dataType.fields[0]
        made = StructType().add(key.name, key.dataType).add("total", IntegerType()).add("nth", IntegerType())
        for name in ("urn", "job_href", "title", "company", "company_href", "location", "posted"):
            made = made.add(name, StringType())
        return AnalyzeResult(made, partitionBy=[PartitioningColumn(key.name)], orderBy=[OrderingColumn("node")])

    def __init__(self):
        self.cards: list[dict] = []
        self.key = None
        self.inside: list[tuple[int, str]] = []  # depth and part of the elements that text belongs to
        self.card_depth: int | None = None

    def eval(self, row) -> None:
        self.key, depth, tag, attrs = row[0], row["depth"], row["tag"], row["attrs"] or {}
        self.inside = [x for x in self.inside if x[0] < depth]
        if self.card_depth is not None and depth <= self.card_depth:
            self.card_depth = None
        if tag == "#text":
            if self.inside and self.card_depth is not None:
                card, part = self.cards[-1], self.inside[-1][1]
                if part in card:
                    card[part].append(row["text"])
            return
        kinds = (attrs.get("class") or "").split()
        if tag == "div" and "base-search-card" in kinds:
            self.card_depth = depth
            self.cards.append({"urn": attrs.get("data-entity-urn"), "title": [], "company": [], "location": []})
            return
        if self.card_depth is None:
            return
        card = self.cards[-1]
        first = lambda name, value: card.setdefault(name, value or "")
        if tag == "h4" and "base-search-card__subtitle" in kinds:
            self.inside.append((depth, "subtitle"))
        elif tag == "a" and any(part == "subtitle" for _, part in self.inside) and "company_href" not in card:
            first("company_href", attrs.get("href"))
            self.inside.append((depth, "company"))
        elif tag == "a" and "base-card__full-link" in kinds:
            first("job_href", attrs.get("href"))
        elif tag == "span" and "sr-only" in kinds and not card["title"]:
            self.inside.append((depth, "title"))
        elif tag == "span" and "job-search-card__location" in kinds and not card["location"]:
            self.inside.append((depth, "location"))
        elif tag == "time":
            first("posted", attrs.get("datetime"))

    def terminate(self) -> Iterator[tuple]:
        for nth, card in enumerate(self.cards, 1):
            said = lambda part: " ".join(" ".join(card[part]).split())  # noqa: B023, E731
            yield self.key, len(self.cards), nth, card["urn"], card.get("job_href"), said("title"), said("company"), card.get("company_href"), said("location"), card.get("posted")


def job_cards(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Cards of ``pages(key, html)`` with the page's number of cards; job_id is null for cards without one."""
    from pyspark.sql.functions import udtf

    spark = pages.sparkSession
    workers_see_us(spark)
    spark.udtf.register("dossier_job_cards", udtf(JobCards))
    wanted = tree(pages, key).where("tag in ('div', 'h4', 'a', 'span', 'time', '#text')").select(key, "node", "depth", "tag", "attrs", "text")
    cards = spark.sql("select * from dossier_job_cards(table({nodes}))", nodes=wanted)
    number = F.coalesce(F.nullif(F.regexp_extract(F.coalesce("urn", F.lit("")), r"(\d{6,})", 1), F.lit("")), F.nullif(F.regexp_extract(F.coalesce("job_href", F.lit("")), r"-(\d{6,})(?:[/?]|$)", 1), F.lit("")))
    return with_once(cards, {"job_id": number, "company_url": company_url(F.col("company_href"))})


def exact_jobs(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, jobs, total) of ``pages(key, company_url, html)``: cards with a job id and exactly this company's address, and all cards."""
    cards = job_cards(pages, key).withColumnRenamed("company_url", "of")
    held = pages.select(key, "company_url").join(cards, key, "left")
    own = (F.col("of") == F.col("company_url")) & F.col("job_id").isNotNull()
    job = F.struct("nth", "job_id", "title", "company", "location", F.coalesce("posted", F.lit("")).alias("date_posted"))
    grouped = held.groupBy(key).agg(F.array_sort(F.collect_list(F.when(own, job))).alias("jobs"), F.coalesce(F.max("total"), F.lit(0)).alias("total"))
    return grouped


def detail_companies(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, company_url): companies that a job's page links, each once."""
    links = tree(pages, key).where("tag = 'a'").select(key, F.col("attrs")["href"].alias("href"))
    return links.select(key, company_url(F.col("href")).alias("company_url")).where("company_url is not null").distinct()


def page_identity(profile_name: Column, page_name: Column, own_domain: Column, page_domain: Column, page_url: Column) -> Column:
    """Whether a structured page is the company's by its core name or by the company's own domain."""
    same_name = (core_name(profile_name) != "") & (core_name(profile_name) == core_name(page_name))
    same_domain = (own_domain != "") & (own_domain == page_domain)
    return F.coalesce((F.coalesce(page_url, F.lit("")) != "") & (F.coalesce(same_name, F.lit(False)) | F.coalesce(same_domain, F.lit(False))), F.lit(False))


def candidates(companies: DataFrame, suggestions: DataFrame, jobs: DataFrame) -> DataFrame:
    """(organisation_number, url, ways, place): addresses to look at, in order, with the set of ways that led to them.

    ``companies(organisation_number, name, titles)``; ``suggestions(organisation_number, query, payload)`` of the name and of the
    aliases that ``titles`` give; ``jobs(company_id, html)``. A company without an exact suggestion has none.
    """
    own = with_once(companies, {"aliases": aliases(F.col("name"), F.col("titles"))})
    asked = own.select("organisation_number", F.posexplode(F.concat(F.array("name"), "aliases")).alias("q", "query"))
    said = suggestions.select("organisation_number", "query", F.posexplode(F.from_json("payload", "array<struct<type:string,id:string,displayName:string>>")).alias("at", "s"))
    exact = asked.join(said, ["organisation_number", "query"]).where((F.col("s.type") == "COMPANY") & (F.coalesce("s.id", F.lit("")) != "") & (full_name(F.col("s.displayName")) == full_name(F.col("query"))))
    nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy("q", "at"))
    exact = exact.select("organisation_number", "q", "query", F.col("s.id").alias("company_id"), nth.alias("nth"))
    way = F.when(F.col("q") == 0, "legal_name_slug").otherwise(F.concat(F.lit("official_site_alias:"), "query"))
    found = exact.select("organisation_number").distinct()
    slugs = asked.join(found, "organisation_number", "left_semi").select("organisation_number", company_url(name_url(F.col("query"))).alias("url"), F.array(way).alias("ways"), F.struct(F.lit(0).alias("a"), F.col("q").alias("b"), F.lit(0).alias("c")).alias("place"))
    links = job_cards(jobs, "company_id").where("company_url is not null").select("company_id", F.col("company_url").alias("url"), "nth")
    led = exact.where(F.col("nth") <= FOLLOWED).withColumnRenamed("nth", "turn").join(links, "company_id")
    ways = F.when(F.col("q") == 0, F.array(F.lit("company_id_job_link"))).otherwise(F.array(F.lit("company_id_job_link"), F.concat(F.lit("official_site_alias:"), "query")))
    led = led.select("organisation_number", "url", ways.alias("ways"), F.struct(F.lit(1).alias("a"), F.col("turn").alias("b"), F.col("nth").alias("c")).alias("place"))
    both = slugs.unionByName(led).where("url is not null")
    return both.groupBy("organisation_number", "url").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ways")))).alias("ways"), F.min("place").alias("place"))


def proofs(companies: DataFrame, held: DataFrame) -> DataFrame:
    """``held(organisation_number, url, ways, page_*)`` with every proof and whether they make the page the company's.

    ``companies(organisation_number, name, domain, municipality, roles)``; a page has page_name, page_domain, page_location and
    page_text, null where there is none.
    """
    leaders = F.slice(F.transform(F.filter("roles", lambda r: r["role_code"].isin(*LEADING) & (F.coalesce(r["name"], F.lit("")) != "")), lambda r: r["name"]), 1, MOST_LEADERS)
    own = held.join(companies.select("organisation_number", "name", F.coalesce("domain", F.lit("")).alias("domain"), full_name(F.col("municipality")).alias("town"), leaders.alias("leaders")), "organisation_number")
    page, text = full_name(F.col("page_name")), full_name(F.col("page_text"))
    alias = F.transform(F.filter("ways", lambda w: w.startswith("official_site_alias:")), lambda w: F.regexp_replace(w, "^[^:]*:", ""))
    own = with_once(own, {"_page": page, "_text": text, "_core": core_name(F.col("page_name")), "_alias": alias})
    own = with_once(own, {
        "full_name_match": (full_name(F.col("name")) != "") & (full_name(F.col("name")) == F.col("_page")), "core_name_match": (core_name(F.col("name")) != "") & (core_name(F.col("name")) == F.col("_core")),
        "domain_match": (F.col("domain") != "") & F.coalesce(F.col("domain") == F.col("page_domain"), F.lit(False)), "location_match": (F.col("town") != "") & full_name(F.col("page_location")).contains(F.col("town")),
        "job_link": F.array_contains("ways", "company_id_job_link"), "alias_match": F.exists("_alias", lambda a: (full_name(a) == F.col("_page")) | (core_name(a) == F.col("_core"))),
        "matched_leaders": F.filter("leaders", lambda n: F.col("_text").contains(full_name(n))),
    })
    col = F.col
    exact = (col("core_name_match") & col("domain_match")) | (col("alias_match") & col("domain_match")) | (col("full_name_match") & col("location_match")) | (col("full_name_match") & col("job_link")) | (col("alias_match") & col("location_match") & (F.size("matched_leaders") > 0))
    return own.withColumn("exact_entity", exact & col("page_name").isNotNull()).drop("_page", "_text", "_core", "_alias", "leaders", "town")


def discover(companies: DataFrame, suggestions: DataFrame, jobs: DataFrame, profiles: DataFrame) -> DataFrame:
    """The first accepted candidate of every company that has one, with its proofs; ``profiles(url, page_*)`` are the pages met."""
    assessed = proofs(companies, candidates(companies, suggestions, jobs).join(profiles, "url", "left"))
    nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy("place"))
    return assessed.where("exact_entity").withColumn("_n", nth).where("_n = 1").drop("_n")


# --- bindings -----------------------------------------------------------------------------------------------------------


def _job_pages(s, d):
    """A page per company: its own job, one of another company, one without a number, in forms that differ by company."""
    k = F.col("organisation_number").cast("bigint") - 900000000
    card = lambda urn, href, title, url, more: F.concat(F.lit('<div class="base-card base-search-card" data-entity-urn="'), urn, F.lit('"><a class="base-card__full-link x" href="'), href, F.lit('"></a><span class="sr-only">\n '), title, F.lit('</span><h4 class="base-search-card__subtitle"><a href="'), url, F.lit('">Firm <b>'), F.col("organisation_number"), F.lit("</b></a></h4>"), more, F.lit("</div>"))
    own = F.concat(F.lit("https://no.linkedin.com/company/Firm-"), k, F.lit("/life?trk=x"))
    jobs = F.concat(
        card(F.concat(F.lit("urn:li:jobPosting:"), k + 4000000), F.lit("https://no.linkedin.com/jobs/view/x"), F.concat(F.lit("Post "), k), own, F.lit('<span class="job-search-card__location">Oslo</span><time datetime="2026-08-23"></time>')),
        card(F.lit("none"), F.concat(F.lit("https://linkedin.com/jobs/view/b-"), k + 5000000, F.lit("?x=1")), F.lit("Other"), F.concat(F.lit("https://linkedin.com/company/firm-"), k, F.lit("-sverige")), F.lit("")),
        F.when(k % 2 == 0, card(F.lit(""), F.concat(F.lit("https://linkedin.com/jobs/view/c-"), k + 6000000), F.lit("Third"), F.lower(own), F.lit(""))).otherwise(card(F.lit("urn:12"), F.lit("https://linkedin.com/jobs/view/short-12"), F.lit("No number"), own, F.lit(""))),
    )
    html = F.when(k % 7 == 0, "<p>nothing here</p>").otherwise(F.concat(F.lit("<ul><li>"), jobs, F.lit("</ul><h4 class='base-search-card__subtitle'><a href='https://linkedin.com/company/outside'>x</a></h4>")))
    return bind(s, d, "registry").select("organisation_number", F.concat(F.lit("https://linkedin.com/company/firm-"), k).alias("company_url"), html.alias("html"))


def _exact_jobs(s, d):
    found = exact_jobs(_job_pages(s, d), "organisation_number")
    said = F.array_join(F.transform("jobs", lambda j: F.concat_ws("/", j["job_id"], j["title"], j["company"], j["location"], j["date_posted"])), "|")
    return found.select("organisation_number", said.alias("jobs"), "total")


def _discovery(s, d):
    """Companies of eight kinds: each of the five rules alone, one that fails by one proof, one without suggestion, one without page."""
    k = F.col("organisation_number").cast("bigint") - 900000000
    own = bind(s, d, "registry").select("organisation_number", F.concat(F.lit("Firm "), k, F.lit(" AS")).alias("name"), F.col("municipality"), k.alias("k"), (k % 8).alias("kind"))
    kind, role = F.col("kind"), F.array(F.struct(F.lit("MEDL").alias("role_code"), F.lit("Other Person").alias("name")), F.struct(F.lit("DAGL").alias("role_code"), F.concat(F.lit("Kari Nordmann "), "k").alias("name")))
    companies = own.select("organisation_number", "name", "municipality", F.concat(F.lit("f"), "k", F.lit(".no")).alias("domain"), F.when(kind.isin(1, 4), F.array(F.concat(F.lit("Brand "), "k", F.lit(" | Home")))).otherwise(F.array().cast("array<string>")).alias("titles"), role.alias("roles"))
    entry = lambda ident, name: F.struct(F.lit("COMPANY").alias("type"), ident.alias("id"), name.alias("displayName"))
    suggestion = lambda query, ident, shown: own.select("organisation_number", query.alias("query"), F.to_json(F.array(entry(F.lit("0"), F.lit("Somebody else")), entry(ident, shown))).alias("payload"), "kind")
    by_name = suggestion(F.col("name"), F.concat(F.lit("id"), "k"), F.when(kind == 6, "Firm").otherwise(F.upper("name")))
    by_alias = suggestion(F.concat(F.lit("Brand "), "k"), F.concat(F.lit("al"), "k"), F.concat(F.lit("BRAND "), "k")).where("kind in (1, 4)")
    card = lambda slug: F.concat(F.lit('<div class="base-search-card"><h4 class="base-search-card__subtitle"><a href="https://www.linkedin.com/company/'), slug, F.lit('/">x</a></h4></div>'))
    jobs = own.where("kind = 3").select(F.concat(F.lit("id"), "k").alias("company_id"), card(F.concat(F.lit("jobs-"), "k")).alias("html"))
    url = F.concat(F.lit("https://linkedin.com/company/"), F.when(kind.isin(1, 4), F.concat(F.lit("brand-"), "k")).when(kind == 3, F.concat(F.lit("jobs-"), "k")).otherwise(F.concat(F.lit("firm-"), "k", F.lit("-as"))))
    profiles = own.where("kind <> 7").select(
        url.alias("url"), F.when(kind == 0, F.concat(F.lit("FIRM "), "k")).when(kind.isin(1, 4), F.concat(F.lit("Brand "), "k", F.lit(" ASA"))).otherwise(F.col("name")).alias("page_name"), F.when(kind.isin(0, 1), F.concat(F.lit("f"), "k", F.lit(".no"))).otherwise("other.no").alias("page_domain"),
        F.when(kind.isin(2, 4), F.concat(F.lower("municipality"), F.lit(", Norway"))).otherwise("Nowhere").alias("page_location"), F.when(kind == 4, F.concat(F.lit("Says KARI nordmann "), "k", F.lit("!"))).otherwise("Text").alias("page_text"),
    )
    return companies, by_name.unionByName(by_alias).drop("kind"), jobs, profiles


def _discovered(s, d):
    found = discover(*_discovery(s, d))
    flags = ("full_name_match", "core_name_match", "domain_match", "location_match", "job_link", "alias_match")
    return found.select("organisation_number", "url", F.array_join("ways", ",").alias("ways"), *flags, F.size("matched_leaders").alias("leaders"))


_R = f"{ctes('registry')}, c as (select organisation_number, municipality, cast(organisation_number as bigint) - 900000000 as k from registry)"
QUERIES = {
    "job_cards": (_exact_jobs, f"""{_R} select organisation_number, case when k % 7 = 0 then '' else (k + 4000000) || '/Post ' || k || '/Firm ' || organisation_number || '/Oslo/2026-08-23' || case when k % 2 = 0 then '|' || (k + 6000000) || '/Third/Firm ' || organisation_number || '//' else '' end end as jobs,
 cast(case when k % 7 = 0 then 0 else 3 end as int) as total from c"""),
    "job_detail_companies": (lambda s, d: detail_companies(_job_pages(s, d), "organisation_number"), f"""{_R}, u as (select organisation_number, k, unnest(['firm-' || k, 'firm-' || k || '-sverige', 'outside']) as slug from c where k % 7 <> 0) select organisation_number, 'https://linkedin.com/company/' || slug as company_url from u"""),
    "handle_discovery": (_discovered, f"""{_R}, x as (select *, k % 8 as kind from c where k % 8 in (0, 1, 2, 3, 4)) select organisation_number, 'https://linkedin.com/company/' || case when kind in (1, 4) then 'brand-' || k when kind = 3 then 'jobs-' || k else 'firm-' || k || '-as' end as url,
 case when kind in (1, 4) then 'official_site_alias:Brand ' || k when kind = 3 then 'company_id_job_link' else 'legal_name_slug' end as ways, kind in (2, 3) as full_name_match, kind in (0, 2, 3) as core_name_match, kind in (0, 1) as domain_match, kind in (2, 4) as location_match, kind = 3 as job_link, kind in (1, 4) as alias_match,
 cast(case when kind = 4 then 1 else 0 end as int) as leaders from x"""),
}
