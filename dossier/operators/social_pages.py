"""Pages of companies on a network: the structured organisation, what the page says about it, and its posts (SRC-18, JON-11)."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.frames import dealt, with_once
from dossier.functions.text import collapse
from dossier.operators.handles import company_url
from dossier.operators.html import picked

#: Descriptions of a page, words that follow the number of followers, what a page says about a company.
NAMED, PROPERTY = ("description", "twitter:description"), ("og:description",)
FOLLOWERS = r"(?i)([\d\s\x{00a0}.,]+)\s+(?:followers|follower|følgere|Follower:innen|seguidores)"
ABOUT = {"employee_size_label": "about-us__size", "industry": "about-us__industry", "headquarters": "about-us__headquarters", "website": "about-us__website"}
FACET = r"(?i)facetCurrentCompany(?:%3D|=)(?:%255B|%5B|\[)(.*?)(?:%255D|%5D|\])"
ORGANISATION, POSTING, KIND = "Organization", "DiscussionForumPosting", "$['@type']"
#: The class of a post's card, and what counts on it: mark -> attribute.
CARD = "main-feed-activity-card"
COUNTED = {f"social-actions__{what}": f"data-num-{what}" for what in ("reactions", "comments")}
CLASSES, DETAIL, WEBSITE = re.compile(r"\s+", re.ASCII), re.compile("/dd/"), re.compile("/dd/(?:.*/)?a/")
SAID = "linked array<string>, told string, about map<string,array<string>>, cards map<string,array<string>>"


def number(text: Column) -> Column:
    """The digits of a text as a number, null without any."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def _below(rows: list[tuple], at: int) -> Iterator[tuple]:
    """The nodes below node ``at``: up to the next one that is no deeper."""
    for below in range(at + 1, len(rows)):
        if rows[below][2] <= rows[at][2]:
            return
        yield rows[below]


def _said(rows: list[tuple]) -> tuple:
    """What a page says, as ``SAID``: texts of linked data, descriptions, per mark of ``ABOUT`` the text in its dd and all of it,
    per activity the counts on its last card; all in the order of the page."""
    scripts, linked, told, about, cards = set(), [], [], {}, {}
    for at, parent, _, tag, _, _, attrs, text in rows:
        if tag == "#text":
            if parent in scripts:
                linked.append(text)
            continue
        has = dict(attrs)
        if tag == "script" and has.get("type", "").strip(" ").lower() == "application/ld+json":
            scripts.add(at)
        elif tag == "meta" and (has.get("name") in NAMED or has.get("property") in PROPERTY):
            told.append(has.get("content", ""))
        elif tag == "article" and CARD in CLASSES.split(has.get("class", "")) and "data-activity-urn" in has:
            first: dict[str, dict] = {}
            inner = False
            for row in _below(rows, at):
                inner = True
                of = dict(row[6] or ())
                first.setdefault(of.get("data-test-id"), of)
                if COUNTED.keys() <= first.keys():
                    break
            if inner:
                cards[has["data-activity-urn"].split(":")[-1]] = [first.get(mark, {}).get(count) for mark, count in COUNTED.items()]
        mark = has.get("data-test-id")
        if mark in ABOUT.values() and mark not in about:
            texts = [row for row in _below(rows, at) if row[3] == "#text"]
            want = WEBSITE if mark == ABOUT["website"] else DETAIL
            about[mark] = [" ".join(row[7] for row in texts if want.search(row[4])), " ".join(row[7] for row in texts)]
    return linked, " ".join(told), list(about.items()), list(cards.items())


def _field(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _objects(linked: Column) -> Column:
    """Objects of a page's linked data, those of a kind: of a script's @graph, of its list, or the script's own, in order."""
    parsed = F.filter(F.transform(linked, lambda t: F.try_parse_json(t)), lambda j: j.isNotNull())
    listed = F.transform(parsed, lambda j: F.coalesce(_field(j, "$['@graph']", "array<variant>"), _field(j, "$", "array<variant>"), F.array(j)))
    return F.filter(F.flatten(listed), lambda v: _field(v, KIND).isin(ORGANISATION, POSTING))


def social_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """A row per page of ``pages(key, expected_url, html)``: status and, where it is ``available``, the organisation's fields.

    ``no_organisation``: no structured organisation, as behind a login; ``mismatch``: the page is of another address than the
    expected one, where one is expected. Of several organisations the last counts. Posts are those of the page's own address.
    A page is read once, and all of it is one row: no field is joined to another.
    """
    facets = F.transform(F.regexp_extract_all("html", F.lit(FACET), F.lit(1)), lambda f: F.coalesce(F.try_url_decode(F.try_url_decode(f)), f))
    ids = F.flatten(F.transform(facets, lambda f: F.regexp_extract_all(f, F.lit(r"\d+"), F.lit(0))))
    ids = F.transform(F.array_sort(F.transform(F.array_distinct(ids), lambda i: F.struct(i.cast("decimal(38,0)").alias("n"), i.alias("i")))), lambda x: x["i"])
    own = dealt(pages.select(key, "expected_url", "html"), key).withColumn("organisation_ids", F.coalesce(ids, F.array().cast("array<string>")))
    held = with_once(picked(own, _said, SAID), {"objects": _objects(F.col("linked"))})
    held = with_once(held, {"own": F.try_element_at(F.filter("objects", lambda v: _field(v, KIND) == ORGANISATION), F.lit(-1))})
    held = with_once(held, {"page_url": company_url(_field(F.col("own"), "$.url"))})
    status = F.when(F.col("own").isNull(), "no_organisation").when(F.col("expected_url").isNotNull() & ~F.col("page_url").eqNullSafe(F.col("expected_url")), "mismatch").otherwise("available")
    held = with_once(held, {"status": status})
    text = lambda path: F.coalesce(_field(F.col("own"), path), F.lit(""))
    said = lambda mark, at: F.nullif(collapse(F.try_element_at("about", F.lit(ABOUT[mark]))[at]), F.lit(""))
    shown = {
        "organisation_ids": F.col("organisation_ids"), "name": text("$.name"), "page_url": F.col("page_url"), "visible_employees": number(_field(F.col("own"), "$.numberOfEmployees.value")), "description": text("$.description"),
        "address": F.to_json(_field(F.col("own"), "$.address", "variant")), "followers": number(F.regexp_extract("told", FOLLOWERS, 1)),
        **{name: said(name, 0) if name == "website" else F.coalesce(said(name, 0), said(name, 1)) for name in ABOUT}, "posts": _posts(),
    }
    return held.select(key, "status", *(F.when(F.col("status") == "available", c).alias(name) for name, c in shown.items()))


def _posts() -> Column:
    """Posts of the page's own address, in order, with likes and comments of the card of the same activity, else 0; null without any."""
    theirs = F.col("page_url").isNull()
    posts = F.filter("objects", lambda v: (_field(v, KIND) == POSTING) & (theirs | company_url(_field(v, "$.author.url")).eqNullSafe(F.col("page_url"))))
    url = lambda v: F.coalesce(F.nullif(_field(v, "$.url"), F.lit("")), _field(v, "$.mainEntityOfPage"), F.lit(""))
    posts = F.transform(posts, lambda v: F.struct(url(v).alias("url"), _field(v, "$.datePublished").alias("date_published"), F.trim(F.coalesce(_field(v, "$.text"), F.lit(""))).alias("text")))
    activity = lambda p: F.regexp_extract(F.coalesce(F.try_url_decode(p["url"]), p["url"]), r"activity-(\d+)", 1)
    posts = F.transform(posts, lambda p: F.struct(p.alias("p"), F.try_element_at("cards", activity(p)).alias("counts")))
    count = lambda x, at: F.coalesce(number(x["counts"][at]), F.lit(0).cast("long"))
    posts = F.transform(posts, lambda x: F.struct(x["p"]["url"].alias("url"), x["p"]["date_published"].alias("date_published"), x["p"]["text"].alias("text"), count(x, 0).alias("likes"), count(x, 1).alias("comments")))
    return F.when(F.size(posts) > 0, posts)


# --- bindings -----------------------------------------------------------------------------------------------------------


def _bound(s, d):
    """A page per company: in four of five an organisation, once of another address, with posts of its own and of others."""
    k = F.col("organisation_number").cast("bigint") - 900000000
    graph = F.concat(
        F.lit('{"@graph":[{"@type":"DiscussionForumPosting","author":{"url":"https://no.linkedin.com/company/Firm-'), k, F.lit('"},"datePublished":"2026-08-21","text":" Post '), k, F.lit(' ","url":"https://no.linkedin.com/posts/x-activity-'), k + 7000, F.lit('-x"},{"@type":"DiscussionForumPosting","author":{"url":"https://linkedin.com/company/other"},"text":"no"},'),
        F.lit('{"@type":"Organization","name":"Old"},{"@type":"Organization","name":"Firm '), k, F.lit('","url":"https://no.linkedin.com/company/firm-'), F.when(k % 7 == 0, F.lit("other")).otherwise(k.cast("string")), F.lit('","numberOfEmployees":{"value":'), k, F.lit('},"address":{"city":"Oslo"}}]}'),
    )
    html = F.concat(
        F.lit('<meta name="description" content="Firm | '), k % 90 + 10, F.lit(' 726 followers on it">'), F.when(k % 5 != 0, F.concat(F.lit('<script type="application/ld+json">'), graph, F.lit("</script>"))).otherwise("<script>recaptcha</script>"),
        F.lit('<div data-test-id="about-us__size"><dt>Size</dt><dd>5,001-10,000 employees</dd></div><div data-test-id="about-us__industry">Trade <b>and more</b></div><div data-test-id="about-us__website"><dd>see <a href="x">https://f'), k, F.lit('.no</a></dd></div><p>other</p><a href="/jobs?facetCurrentCompany=%5B12%2C'), k, F.lit("%5D\">jobs</a>"),
        F.lit('<article class="x main-feed-activity-card" data-activity-urn="urn:li:activity:'), k + 7000, F.lit('"><a data-test-id="social-actions__reactions" data-num-reactions="'), k % 30, F.lit('"></a><a data-test-id="social-actions__comments" data-num-comments="4"></a></article>'),
    )
    return bind(s, d, "registry").select("organisation_number", F.concat(F.lit("https://linkedin.com/company/firm-"), k).alias("expected_url"), html.alias("html"))


def _pages(s, d):
    found = social_pages(_bound(s, d), "organisation_number")
    return found.withColumns({"posts": F.to_json("posts"), "organisation_ids": F.array_join("organisation_ids", ",")}).drop("description", "headquarters")


QUERIES = {
    "social_pages": (_pages, f"""{ctes("registry")}, c as (select organisation_number, cast(organisation_number as bigint) - 900000000 as k from registry), s as (select *, case when k % 5 = 0 then 'no_organisation' when k % 7 = 0 then 'mismatch' else 'available' end as status from c)
 select organisation_number, status, case when ok then case when k < 12 then k || ',12' when k = 12 then '12' else '12,' || k end end as organisation_ids, case when ok then 'Firm ' || k end as name, case when ok then 'https://linkedin.com/company/firm-' || k end as page_url, case when ok then k end as visible_employees,
 case when ok then '{{"city":"Oslo"}}' end as address, case when ok then (k % 90 + 10) * 1000 + 726 end as followers, case when ok then '5,001-10,000 employees' end as employee_size_label, case when ok then 'Trade and more' end as industry, case when ok then 'https://f' || k || '.no' end as website,
 case when ok then '[{{"url":"https://no.linkedin.com/posts/x-activity-' || (k + 7000) || '-x","date_published":"2026-08-21","text":"Post ' || k || '","likes":' || k % 30 || ',"comments":4}}]' end as posts from (select *, status = 'available' as ok from s)"""),
}
