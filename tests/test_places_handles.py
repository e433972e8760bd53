"""Places against companies, job cards and handles: each rule with a row that fails by one proof."""

import json

from pyspark.sql import functions as F

from dossier.operators import handles, places, social_pages

COMPANY = "organisation_number string, name string, street string, postcode string, city string, phone string, site string"
PLACES = f"seq long, place_id string, data_id string, link string, title string, address string, phone string, web_site string, latitude double, longitude double, review_count long, review_rating double, user_reviews {places.REVIEWS}"
TRADES = "organisation_number string, trade_name string, source string"


def _place(seq, title, address=None, phone=None, site=None, n=0, rating=None, ident=None, data=None, reviews=None):
    return (seq, ident if ident is not None else f"p{seq}", data or f"d{seq}", f"https://maps.example/{seq}", title, address, phone, site, None, None, n, rating, reviews)


def test_places_need_proof(spark):
    companies = [
        ("1", "AF GRUPPEN ASA", "Standardveien 1", "0581", None, "22 89 11 00", "https://afgruppen.no/"), ("2", "EXAMPLE INDUSTRI AS", "c/o Accountant Other Street 1", "4021", "STAVANGER", None, None),
        ("3", "OSLOFJORDEN EIENDOMSMEGLING AS", "Stranden 81", "0250", "Oslo", "22620000", None), ("4", "Ålesund Trevare Fabrikk AS", "Lang Gate 5", None, None, "11223344", None), ("5", "Holding AS", "Vei 1", "1111", "By", None, None), ("6", "Tie Firm AS", "Vei 2", "2222", "By", None, None),
    ]
    found = [
        _place(1, "AF Gruppen", "Standardveien 1, 0581 Oslo, Norge", "+47 22 89 11 00", "https://afgruppen.no/", 21), _place(2, "AF Eiendom", "Standardveien 1, 0581 Oslo, Norge", "+47 22 89 11 00", "https://afgruppen.no/eiendom/"),
        _place(3, "Example Industri AS", "Factory Road 7, 4021 Stavanger, Norway", n=4), _place(4, "PrivatMegleren Premium", "Stranden 81, 0250 Oslo", "+47 22 62 00 00"), _place(5, "Alesund Trevare", "Lang gate 5", "11 22 33 44"),
        _place(6, "Ålesund Trevare", "Lang gate 9", "11 22 33 44"), _place(7, "Holding", "Elsewhere 3, 1111 By"), _place(8, "Tie Firm", "Vei 2, 2222 By"), _place(9, "Tie Firm", "Vei 2, 2222 By"), _place(10, "Gruppenn", None, None, "http://www.shop.afgruppen.no"), _place(11, "", None),
    ]
    profiles, held, none = spark.createDataFrame(companies, COMPANY), spark.createDataFrame(found, PLACES), spark.createDataFrame([], TRADES)
    accepted = lambda trades: {(r["organisation_number"], r["_place"]): r for r in places.scored(profiles, held, trades).where("accepted").collect()}
    got = accepted(none)
    assert set(got) == {("1", "p1"), ("1", "p10"), ("2", "p3"), ("4", "p5"), ("6", "p8"), ("6", "p9")}
    assert got["2", "p3"]["postcode_city_match"] and not got["2", "p3"]["address_match"] and got["1", "p10"]["name_share"] == 0
    trades = spark.createDataFrame([("3", "privatmegleren premium", "https://proof.example/"), ("1", "af eiendom", "https://no.example/")], TRADES)
    assert set(accepted(trades)) - set(got) == {("3", "p4"), ("1", "p2")}
    best = {r["organisation_number"]: (r["status"], r["_place"]) for r in places.best_places(profiles, places.scored(profiles, held, none)).collect()}
    assert best["1"] == ("exact_match", "p1") and best["6"] == ("ambiguous_exact_match", None) and best["3"] == best["5"] == ("no_exact_match", None)


def test_place_observations(spark):
    profiles = spark.createDataFrame([("1", "Firm Nord AS", "Vei 2", "2222", "By", None, None)], COMPANY)
    reviews = [(None, 5.0, "  ", "2026", None, None), ("r2", 2.0, " Bad ", None, "https://u", "N"), ("r3", 0.0, "no star", None, None, "N"), ("r4", 6.0, "too many", None, None, "N")]
    rows = [_place(1, "old", "x", ident="p"), _place(2, "Firm Nord", "Vei 2, 2222 By", None, "https://f.no", 12, 4.5, "p", None, reviews)]
    held = spark.createDataFrame(rows, PLACES)
    best = places.best_places(profiles, places.scored(profiles, held, spark.createDataFrame([], TRADES)))
    got = places.observations(best, held, "2026-08-01").collect()
    assert sorted(r["signal_type"] for r in got) == ["buzz_metrics", "company_profile", "place_summary", "profile_metrics", "review", "review", "review_summary"]
    first, second = sorted((r for r in got if r["signal_type"] == "review"), key=lambda r: -r["rating"])
    assert (first["evidence_span"], first["reviewer_id"], first["sentiment_label"]) == ("Explicit customer rating: 5.0/5", "anonymous-0", "positive")
    assert (second["id"], second["evidence_span"], second["reviewer_id"], second["sentiment_label"]) == ("places-review-1-r2", "Bad", "https://u", "negative")
    assert {r["evidence_span"] for r in got if r["signal_type"] == "place_summary"} == {"Firm Nord; Vei 2, 2222 By; None; rating=4.5; reviews=12"} and len({r["content_sha256"] for r in got}) == 1


def test_addresses_on_the_network(spark):
    urls = {
        "https://no.linkedin.com/company/Norsk-Fiskeeksport/about?trk=x": "https://linkedin.com/company/norsk-fiskeeksport", "https://linkedin.com/COMPANY/r%C3%B8d%20bl%C3%A5/": "https://linkedin.com/company/r%C3%B8d%20bl%C3%A5",
        "https://example.test/company/wrong": None, "https://linkedin.com/in/person": None, "https://linkedin.com/company/": None, "https://notlinkedin.com/company/x": None,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r[0]: r[1] for r in rows.select("u", handles.company_url(F.col("u"))).collect()} == urls
    one = rows.limit(1).select(handles.name_url(F.lit("RØD & BLÅ AS")), handles.core_name(F.lit("AF GRUPPEN ASA")), handles.core_name(F.lit("AF Gruppen")), handles.core_name(F.lit("AS")))
    assert tuple(one.first()) == ("https://linkedin.com/company/rod-bla-as", "af gruppen", "af gruppen", "")


def test_page_identity(spark):
    rows = [("A AS", "a asa", "a.no", "b.no", "u", True), ("A AS", "b", "a.no", "a.no", "u", True), ("A AS", "a", "a.no", "a.no", None, False), ("A AS", "b", "", "", "u", False), ("AS", "AS", "a.no", None, "u", False)]
    frame = spark.createDataFrame(rows, "n string, p string, d string, q string, u string, want boolean")
    assert all(r["want"] == r["got"] for r in frame.withColumn("got", handles.page_identity(*(F.col(c) for c in "npdqu"))).collect())


def test_job_cards_of_odd_pages(spark):
    card = '<div class="base-search-card" data-entity-urn="{}"><h4 class="base-search-card__subtitle"><a href="{}">F</a></h4><span class="sr-only">T</span></div>'
    pages = [("a", "https://linkedin.com/company/f", card.format("urn:123456", "https://linkedin.com/company/F?x") * 2 + card.format("", "https://linkedin.com/company/f")), ("b", "https://linkedin.com/company/f", None), ("c", None, card.format("urn:123456", "https://linkedin.com/company/f"))]
    got = {r["key"]: (len(r["jobs"]), r["total"]) for r in handles.exact_jobs(spark.createDataFrame(pages, "key string, company_url string, html string"), "key").collect()}
    assert got == {"a": (2, 3), "b": (0, 0), "c": (0, 1)}


def test_each_rule_fails_without_one_proof(spark):
    schema = "organisation_number string, url string, ways array<string>, page_name string, page_domain string, page_location string, page_text string"
    company = spark.createDataFrame([("1", "Dips AS", "dips.com", "BODØ", [("MEDL", "Not Leading"), ("DAGL", "Kari Nordmann")])], "organisation_number string, name string, domain string, municipality string, roles array<struct<role_code:string,name:string>>")
    alias, job, slug = "official_site_alias:Jarre&Co", "company_id_job_link", "legal_name_slug"
    cases = [
        ([slug], "DIPS ASA", "dips.com", None, None, True), ([slug], "DIPS ASA", "other.com", None, None, False), ([alias], "Jarre & Co", "dips.com", None, None, True), ([slug], "Jarre & Co", "dips.com", None, None, False), ([slug], "dips as", None, "Bodø, Norway", None, True),
        ([slug], "dips asa", None, "Bodø", None, False), ([job], "Dips AS", None, None, None, True), ([slug], "Dips AS", None, "Oslo", None, False), ([alias], "Jarre & Co AS", None, "bodø", "with KARI  nordmann!", True), ([alias], "Jarre & Co", None, "bodø", "with Not Leading", False),
        ([alias], "Jarre & Co", None, "Oslo", "Kari Nordmann", False), ([job], None, "dips.com", None, None, False),
    ]
    held = spark.createDataFrame([("1", str(i), w, n, d, place, t) for i, (w, n, d, place, t, _) in enumerate(cases)], schema)
    got = {int(r["url"]): r["exact_entity"] for r in handles.proofs(company, held).collect()}
    assert [got[i] for i in range(len(cases))] == [c[-1] for c in cases]


def test_social_page_is_read_where_it_is_the_companys(spark):
    graph = {"@graph": [{"@type": "DiscussionForumPosting", "author": {"url": "https://no.linkedin.com/company/af-gruppen"}, "datePublished": "2026-08-21", "text": "Exact company update", "url": "https://no.linkedin.com/posts/example-activity-7496-x"}, {"@type": "Organization", "name": "AF Gruppen", "url": "https://no.linkedin.com/company/af-gruppen", "numberOfEmployees": {"value": 1303}}]}
    html = (
        f'<meta property="og:description" content="AF Gruppen | 56\u00a0726 følgere"><script type="application/ld+json">{json.dumps(graph)}</script><script>const dormant="recaptcha/challengepage";</script><div data-test-id="about-us__size"><dd>5,001-10,000 employees</dd></div>'
        '<div data-test-id="about-us__website"><dd>no link</dd></div><article class="main-feed-activity-card" data-activity-urn="urn:li:activity:7496"><p><a data-test-id="social-actions__reactions" data-num-reactions="29"></a></article><a data-test-id="social-actions__comments" data-num-comments="4"></a>'
    )
    own = "https://linkedin.com/company/af-gruppen"
    pages = [(1, own, html), (2, "https://linkedin.com/company/other", html), (3, None, html), (4, own, "<script>recaptcha/challengepage</script>"), (5, own, None), (6, None, '<script type="application/ld+json">[{"@type":"Organization","name":"N"}]</script>')]
    got = {r["page_id"]: r for r in social_pages.social_pages(spark.createDataFrame(pages, "page_id long, expected_url string, html string")).collect()}
    assert [got[i]["status"] for i in range(1, 7)] == ["available", "mismatch", "available", "no_organisation", "no_organisation", "available"]
    one = got[1]
    assert (one["name"], one["followers"], one["visible_employees"], one["employee_size_label"], one["website"], one["organisation_ids"]) == ("AF Gruppen", 56726, 1303, "5,001-10,000 employees", None, [])
    assert [(p["text"], p["likes"], p["comments"]) for p in one["posts"]] == [("Exact company update", 29, 0)]
    assert got[2]["name"] is None and got[6]["page_url"] is None and got[6]["posts"] is None


def test_social_pages_are_read_once_and_joined_to_nothing(spark):
    """A page is tokenised once however many fields it has; cards of one activity count by the last, as their first marks say."""
    count = lambda what, n: f'<a data-test-id="social-actions__{what}" data-num-{what}="{n}"></a>'
    card = lambda inner: f'<article class="main-feed-activity-card x" data-activity-urn="urn:li:activity:7">{inner}</article>'
    post = {"@type": "DiscussionForumPosting", "url": "https://linkedin.com/posts/activity-7-x", "text": " t "}
    data = "".join(f'<script type="application/ld+json">{json.dumps(x)}</script>' for x in ([post], {"@type": "Organization", "name": "Old"}, {"@graph": [{"@type": "Organization", "name": "New"}, post]}, 7))
    html = data + card(count("reactions", "1,000") + count("comments", 5)) + card(count("reactions", "2,000") + count("reactions", 9)) + '<div data-test-id="about-us__website">x <dd>see <a>f.no</a></dd></div><p data-test-id="about-us__industry"> </p>'
    found = social_pages.social_pages(spark.createDataFrame([(i, None, html) for i in range(300)], "page_id long, expected_url string, html string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    rows = found.collect()
    assert sorted(r["page_id"] for r in rows) == list(range(300))
    assert {(r["name"], r["website"], r["industry"], *((p["text"], p["likes"], p["comments"]) for p in r["posts"])) for r in rows} == {("New", "f.no", None, ("t", 2000, 0), ("t", 2000, 0))}


def test_common_words_of_a_street_pair_nothing(spark):
    """Companies and places of one street whose names share words: a pair is one that the rarest word of the name makes."""
    companies = [(str(i), f"Firm{i} Industri Nord AS", "Gate 1", None, "By", None, None) for i in range(40)]
    long = " ".join(f"word{i:03d}" for i in range(100))
    companies.append(("long", long, "Gate 1", None, "By", None, None))
    found = [_place(i, f"Firm{i} Industri Nord", "Gate 1, By") for i in range(40)] + [_place(50, long.replace("word007", ""), "Gate 1"), _place(51, long.replace("word007", "").replace("word008", ""), "Gate 1")]
    profiles, held = spark.createDataFrame(companies, COMPANY), spark.createDataFrame(found, PLACES)
    same = {(str(i), f"p{i}") for i in range(40)} | {("long", "p50")}
    compared = {tuple(r) for r in places.pairs(profiles, places.latest_places(held)).collect()}
    assert same <= compared <= same | {("long", "p51")}
    assert {(r["organisation_number"], r["_place"]) for r in places.scored(profiles, held, spark.createDataFrame([], TRADES)).where("accepted").collect()} == same
