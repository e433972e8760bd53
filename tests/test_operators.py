"""Edge semantics on literal rows."""

from pyspark.sql import functions as F

from dossier.functions.text import canonical_url, name_tokens
from dossier.operators import claims, crawl, identity, normalize, refresh, sampling, scoring, screen


def one(spark, column, **values):
    names = list(values) or ["x"]
    kinds = {str: "string", int: "int", bool: "boolean", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).toDF(*names).select(column.alias("v")).first()["v"]


def test_screen_parser():
    plan = screen.parse("Companies in Oslo with more than 10 employees and revenue over 1 million top 5 by revenue")
    assert [(f["field"], f["operator"], f["value"]) for f in plan["filters"]] == [("municipality", "eq", "OSLO"), ("employees", ">", 10), ("revenue", ">", 1e6)]
    assert plan["sort"] == {"field": "revenue", "limit": 5} and plan["executable"]
    assert not screen.parse("companies with good sentiment in Oslo")["executable"]
    assert screen.parse("in Oslo top 500 by employees")["filters"] == []  # no digits in a municipality
    assert screen.parse("top 500 by employees")["sort"]["limit"] == 100


def test_canonical_url(spark):
    assert one(spark, canonical_url(F.col("u")), u="https://www.Example.no") == one(spark, canonical_url(F.col("u")), u="https://example.no/?utm_source=news&fbclid=1")
    assert one(spark, canonical_url(F.col("u")), u="HTTP://a.no/x/?b=2&a=1&c=#f") == "http://a.no/x?a=1&b=2"
    assert one(spark, canonical_url(F.col("u")), u="  not  a url ") == "not a url"


def test_strata_and_tokens(spark):
    row = dict(legal_form="AS", employees=12, bankrupt=False, liquidating=False, website="example.no")
    assert one(spark, sampling.stratum(), **row) == "AS|5-19|active|web"
    assert one(spark, sampling.stratum(), **{**row, "bankrupt": True, "website": ""}) == "AS|5-19|adverse|no-web"
    assert one(spark, name_tokens(F.col("n")), n="Ærlig Ølbryggeri & Co AS") == ["aerlig", "olbryggeri", "co"]


def test_percentiles(spark):
    log = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "latency_ms double")
    assert log.agg(crawl.nearest_rank("latency_ms", 0.5), crawl.nearest_rank("latency_ms", 0.95)).first() == (3.0, 100.0)


def test_obligation_and_states(spark):
    assert one(spark, claims.obligation(), legal_form="AS", latest_submitted_accounts="") == "required_by_legal_form"
    assert one(spark, claims.obligation(), legal_form="ENK", latest_submitted_accounts="") == "threshold_or_activity_dependent"
    assert one(spark, claims.obligation(), legal_form="ENK", latest_submitted_accounts="2024") == "filing_observed"
    assert one(spark, claims.terminal_state(F.col("s"), F.col("n")), s="blocked", n="robots.txt denied") == "blocked_robots"
    assert one(spark, claims.availability(F.col("s")), s="odd") == "failed"


def test_diff_null_to_zero(spark):
    schema = "organisation_number string, name string, legal_form string, employees int, municipality string, website string, latest_submitted_accounts string"
    old = spark.createDataFrame([("1", "Example AS", "AS", None, "M", "https://www.example.no", "2023")], schema)
    new = spark.createDataFrame([("1", "Example   AS", "AS", 0, "M", "https://example.no/?utm_source=n", "2023")], schema)
    assert [(r["field"], r["old_value"], r["new_value"]) for r in refresh.diff(old, new).collect()] == [("registry.employees", None, "0")]
    assert refresh.diff(new, new).count() == 0


def test_site_sample_skips_excluded_hosts(spark):
    rows = [("111111111", "https://a.no"), ("222222222", "https://www.a.no/x"), ("333333333", None), ("444444444", "https://b.no")]
    registry = spark.createDataFrame(rows, "organisation_number string, website string")
    exclude = spark.createDataFrame([("111111111",)], "organisation_number string")
    assert [r[0] for r in sampling.first_per_host(registry, exclude, "s", 5).select("organisation_number").collect()] == ["444444444"]


def test_social_urls(spark):
    get = lambda u: one(spark, identity.social_url(F.col("u")), u=u)
    assert tuple(get("https://www.facebook.com/Example/")) == ("facebook", "https://facebook.com/Example")
    assert get("https://facebook.com/sharer/x") is None and get("https://x.com/a/status/1") is None and get("https://example.no/a") is None


def test_title_gate(spark):
    gate = lambda c, t: one(spark, normalize.exact_title(F.col("c"), F.col("t")), c=c, t=t)
    assert gate("NORDIC DOOR AS", "Nordic Door AS åpner ny fabrikk - Lokalavisa")
    assert not gate("NORDIC DOOR AS", "Nordic investors prefer another door - Example")
    assert gate("SOLVANG ASA", "Sterkt årsresultat fra Solvang ASA i 2024 - Skipsrevyen")
    assert not gate("VIND HOLDING AS", "Inntektene til Aneo Roan Vind Holding AS stupte - mn24.no")


def test_workforce(spark):
    texts = [("Det er to ansatte i sameiet.", 2.0), ("Stiftelsen har ingen ansatte og ingen arsverk.", 0.0), ("Tal pa Aarsverk i rekneskapsaret 1.50", 1.5), ("Konsernet har 900 ansatte", None), ("Note 2 - antall ansatte og lan", None), ("10 ansatte\n12 ansatte", None), (None, None)]
    found = normalize.workforce(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "id int, text string"))
    assert [r["n_employees"] for r in found.orderBy("id").collect()] == [n for _, n in texts]


def test_budget_is_greedy(spark):
    tasks = spark.createDataFrame([("a", 1, 6.0), ("a", 2, 6.0), ("a", 3, 3.0)], "k string, seq bigint, cost double")
    assert tuple(scoring.budget_greedy(tasks, 10.0, "k").select("spent", "accepted").first()) == (9.0, 2)


def test_set_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "organisation_number string, field string")
    assert tuple(refresh.set_metrics(none, none).first()) == (0, 0, 0, 1.0, 1.0)


def test_priority_links(spark):
    html = '<a href="/kontakt">Kontakt</a><a href="https://other.no/about">x</a><a href="/products">p</a><a href="/x?y#z">Om oss: team</a>'
    pages = spark.createDataFrame([(1, "https://example.no/", html), (2, "https://example.no/", None)], "page_id long, url string, html string")
    from dossier.operators.pages import priority_links

    assert [(r["link"], r["rank"]) for r in priority_links(pages).orderBy("nth").collect()] == [("https://example.no/kontakt", 3), ("https://example.no/x", 7)]
