"""Enrichment plans under gates and budgets, connector enablement, identity gate, label audit, proxy score (FLT-13, ID-04, JON-08, AGG-05, SCO-06, Budget, EnrichmentController)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.operators.observations import _VALID, validated
from dossier.operators.refresh import QUERIES as REFRESH
from dossier.operators.refresh import refresh_idempotent, refresh_metrics
from dossier.operators.scoring import QUERIES as SENTIMENT
from dossier.operators.scoring import metrics_summary, rollup

#: Connectors with their requests, cost, need of an identity and rights.
POLICY = {
    "google_places_api": (1, 0.017, False, "approved"),
    "licensed_news_search": (1, 0.010, True, "approved"),
    "jobs_provider": (1, 0.005, True, "approved"),
    "permitted_search_api": (1, 0.005, False, "approved"),
    "linkedin_connector": (1, 0.0, True, "review_required"),
    "facebook_connector": (1, 0.0, True, "review_required"),
    "instagram_connector": (1, 0.0, True, "review_required"),
    "x_connector": (1, 0.0, True, "review_required"),
    "youtube_connector": (1, 0.0, True, "approved"),
    "tiktok_connector": (1, 0.0, True, "review_required"),
}
#: Reasons of decisions, in the order of the gates.
REASONS = {
    "rights": "connector has no approved rights path (review_required)",
    "handle": "social handle is not identity-verified",
    "identity": "company is not sufficiently identified for this connector",
    "redundant": "handles already known; discovery search is redundant",
    "budget": "budget headroom exhausted for optional enrichment",
    "run": "permitted, identified, useful, and within budget",
}
#: The share of a limit that optional work may use.
HEADROOM = 0.9


def _policy(spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(c, *p) for c, p in POLICY.items()], "connector string, est_requests int, est_cost double, requires_identity boolean, rights string"))


def enabled(connectors: DataFrame, names: list[str] | None, online: bool) -> DataFrame:
    """``connectors(name, default_enabled, requires_network)``: a list of names enables exactly those; else the defaults, and
    none that needs a network where there is none."""
    on = F.col("name").isin(*names) if names is not None else F.col("default_enabled")
    return connectors.withColumn("enabled", on & (F.lit(online) | ~F.col("requires_network")))


def gated(tasks: DataFrame) -> DataFrame:
    """The first gate that stops each of ``tasks(organisation_number, seq, connector, name, website_verified, has_social,
    handle_verified)``, null where only the budget is left to ask. Connectors without a policy have no rights."""
    own = tasks.join(_policy(tasks.sparkSession), "connector", "left")
    social = F.col("connector").endswith("_connector")
    known = F.col("website_verified") | (F.coalesce("name", F.lit("")) != "")
    gate = (
        F.when(F.coalesce("rights", F.lit("review_required")) != "approved", "rights")
        .when(F.col("requires_identity") & social & ~F.col("handle_verified"), "handle")
        .when(F.col("requires_identity") & ~social & ~known, "identity")
        .when((F.col("connector") == "permitted_search_api") & (F.col("website_verified") | F.col("has_social")), "redundant")
    )
    return own.withColumn("gate", gate)


def headroom(limit: float | None) -> float:
    return float("inf") if limit is None else HEADROOM * limit


def plan(tasks: DataFrame, most_requests: int | None, most_cost: float | None) -> DataFrame:
    """Decisions in order of seq within each company; a task that passes the gates reserves its estimate if both limits keep
    headroom for it, and a refused one reserves nothing. A company's tasks are a few: one fold each."""
    own = gated(tasks)
    order = F.array_sort(F.collect_list(F.struct("seq", "connector", "gate", "est_requests", F.round(F.col("est_cost") * 1e6).cast("long").alias("micro"))))
    zero = F.struct(F.lit(0).alias("requests"), F.lit(0).cast("long").alias("micro"), F.array().cast("array<struct<seq:bigint,connector:string,gate:string>>").alias("done"))
    requests, micro = headroom(most_requests), headroom(None if most_cost is None else most_cost * 1e6)

    def step(a, t):
        fits = t["gate"].isNull() & (a["requests"] + t["est_requests"] <= requests) & (a["micro"] + t["micro"] <= micro)
        gate = F.when(t["gate"].isNotNull(), t["gate"]).when(fits, "run").otherwise("budget")
        one = F.struct(t["seq"].cast("bigint").alias("seq"), t["connector"].alias("connector"), gate.alias("gate"))
        spend = lambda f: F.when(fits, a[f] + t[{"requests": "est_requests"}.get(f, f)]).otherwise(a[f]).alias(f)
        return F.struct(spend("requests"), spend("micro"), F.array_append(a["done"], one).alias("done"))

    folded = own.groupBy("organisation_number").agg(F.aggregate(order, zero, step).alias("f"))
    rows = folded.select("organisation_number", (F.col("f.micro") / 1e6).alias("planned_cost"), F.col("f.requests").alias("planned_requests"), F.inline("f.done"))
    reason = F.element_at(F.create_map(*(F.lit(x) for kv in REASONS.items() for x in kv)), F.col("gate"))
    return rows.select("organisation_number", "seq", "connector", F.when(F.col("gate") == "run", "run").otherwise("skip").alias("action"), reason.alias("reason"), "planned_requests", F.round("planned_cost", 6).alias("planned_cost"))


def identity_gate(sites: DataFrame) -> DataFrame:
    """Social links that may be published of ``sites(organisation_number, status, site_ok, links array<struct<url, ok>>)``: only
    of an available site, and only where site and link are identified; the rest is quarantined."""
    open_ = F.col("status") == "available"
    links = F.coalesce("links", F.array().cast("array<struct<url:string,ok:boolean>>"))
    kept = F.filter(links, lambda x: F.col("site_ok") & x["ok"])
    count = F.when(open_, F.size(links) - F.size(kept)).otherwise(0)
    return sites.select("organisation_number", F.when(open_, F.array_join(F.transform(kept, lambda x: x["url"]), " ")).alias("social_links"), count.alias("quarantined"))


def label_audit(observations: DataFrame, labels: DataFrame) -> DataFrame:
    """Published observations against ``labels(id, exact_entity, supported)``: audited, wrong, unsupported, precision and the gates."""
    own = observations.where("published").join(labels, "id").agg(
        F.count("*").alias("audited"), F.count_if(~F.col("exact_entity")).alias("wrong"), F.count_if(~F.col("supported")).alias("unsupported")
    )
    share = lambda c: F.round(F.coalesce(F.try_divide(F.col("audited") - F.col(c), F.col("audited")), F.lit(0.0)), 6)
    own = own.withColumns({"entity_precision": share("wrong"), "metric_precision": share("unsupported")})
    return own.withColumn("passed", (F.col("audited") >= 100) & (F.col("entity_precision") >= 0.995) & (F.col("metric_precision") >= 0.98))


#: What a part of the score is of, its most points, when it counts, and the share of the points it gets.
PROXY = (
    ("external", 10, "external_qualified and wrong = 0 and audited > 0", "1"), ("external", 10, "external_qualified", "two_platforms"), ("external", 7, "external_qualified", "workforce_jobs"),
    ("external", 8, "external_qualified", "ratings_reviews"), ("external", 7, "external_qualified", "buzz_engagement"), ("external", 10, "sentiment_qualified and sentiment_wrong = 0 and sentiment_support = 1", "sentiment"),
    ("external", 3, "external_qualified", "fresh"), ("foundation", 4, "true", "exact_registry"), ("foundation", 4, "true", "financial"), ("foundation", 4, "true", "roles_locations"), ("foundation", 3, "true", "website_terminal"),
    ("research_agent", 5, "true", "research / 6"), ("research_agent", 5, "external_qa", "research / 6 - 1"), ("daily", 4, "batch_valid", "1"), ("daily", 2, "resume_valid and refetched = 0", "1"),
    ("daily", 3, "refresh_qualified and refresh_complete and idempotent", "1"), ("daily", 1, "batch_valid and p95_ms <= 10000", "1"), ("daily", 2, "connector_policy", "1"), ("design", 4, "true", "ux / 4"), ("design", 4, "ux_external", "ux / 4 - 1"),
)
#: What has to hold for a score to be awarded.
GATES = ("audit_size", "wrong = 0 and audited > 0", "unsupported = 0 and audited > 0", "connector_policy", "exact_registry = 1", "batch_valid", "refresh_qualified and refresh_complete and idempotent")


def competition_proxy(measures: DataFrame) -> DataFrame:
    """Points by category of one row of ``measures``, their sum, whether all gates hold, and what is awarded then.

    A part is its most points by its share, from 0 to 1, where its condition holds; what is missing counts as 0 and as false.
    """
    points: dict[str, Column] = {}
    for category, most, gate, share in PROXY:
        part = F.when(F.expr(gate), float(most) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.expr(share).cast("double"), F.lit(0.0))))).otherwise(0.0)
        points[category] = points.get(category, F.lit(0.0)) + part
    every = F.forall(F.array(*(F.coalesce(F.expr(g), F.lit(False)) for g in GATES)), lambda g: g)
    own = measures.select(*(F.round(c, 3).alias(n) for n, c in points.items()), every.alias("qualified"))
    own = own.withColumn("raw", F.round(sum(map(F.col, points), F.lit(0.0)), 3))
    return own.withColumn("awardable", F.when(F.col("qualified"), F.col("raw")).otherwise(0.0))


# --- bindings --------------------------------------------------------------------------------------------------------


def _tasks(s, d):
    r = bind(s, d, "registry")
    k = F.col("organisation_number").cast("bigint")
    names = [*POLICY, "unheard_of"]
    flags = [F.when(k % 9 == 0, "").otherwise(F.col("name")).alias("name"), (k % 4 == 0).alias("website_verified"), (k % 6 == 1).alias("has_social"), (k % 2 == 0).alias("handle_verified")]
    return r.select("organisation_number", *flags, F.posexplode(F.array(*map(F.lit, names))).alias("seq", "connector"))


def _connectors(s):
    rows = [("company_site_activity", True, False), ("registry_workforce", True, False), ("news_search", False, True), ("places", True, True), ("jobs", False, True)]
    return s.createDataFrame(rows, "name string, default_enabled boolean, requires_network boolean")


def _enabled(s, d):
    """Under each of three settings, companies that an enabled connector serves: sites need a website."""
    ways = (("defaults offline", None, False), ("defaults online", None, True), ("named", ["news_search", "company_site_activity"], True))
    found = None
    for label, names, online in ways:
        one = enabled(_connectors(s), names, online).where("enabled").select(F.lit(label).alias("way"), "name")
        found = one if found is None else found.unionByName(one)
    counts = bind(s, d, "registry").agg(F.count("*").alias("n"), F.count("website").alias("sites"))
    return found.join(F.broadcast(counts)).select("way", "name", F.when(F.col("name") == "company_site_activity", F.col("sites")).otherwise(F.col("n")).alias("companies"))


def _gate(s, d):
    r = bind(s, d, "registry").select("organisation_number", F.col("organisation_number").cast("bigint").alias("k"))
    link = lambda i: F.struct(F.concat(F.lit(f"https://x.com/l{i}-"), "k").alias("url"), (F.col("k") % (i + 2) == 0).alias("ok"))
    status = F.when(F.col("k") % 5 == 0, "blocked").otherwise("available")
    return identity_gate(r.select("organisation_number", status.alias("status"), (F.col("k") % 3 != 0).alias("site_ok"), F.when(F.col("k") % 7 != 0, F.array(link(0), link(1))).alias("links")))


def _audit(s, d, wrong="seq % 500 = 0", unsupported="seq % 30 = 0"):
    o = bind(s, d, "observations").select("id", "seq", (F.col("rights_status") == "approved").alias("published"))
    labels = o.where("seq % 2 = 0").select("id", F.expr(f"not ({wrong})").alias("exact_entity"), F.expr(f"not ({unsupported})").alias("supported"))
    return label_audit(o, labels)


#: Signals that make a company count for a share.
_SHARES = {"workforce_jobs": ("job_posting", "workforce_snapshot"), "ratings_reviews": ("review", "review_summary"), "buzz_engagement": ("public_post", "public_mention", "buzz_metrics")}


def _measures(s, d):
    """Measures from registry, filings, roles, locations, observations, labels, sentiment, changes and the request log."""
    key = "organisation_number"
    n = F.lit(bind(s, d, "registry").count()).cast("double")
    registry, seen = bind(s, d, "registry"), validated(bind(s, d, "observations")).where("publishable")
    both = lambda a, b: a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")
    share = lambda rows, name: rows.select(key).distinct().join(registry.select(key), key, "left_semi").agg((F.count("*") / n).alias(name))
    newest = seen.agg(F.max("retrieved_at").alias("last"))
    parts = [
        registry.agg(F.count("*").alias("profiles"), (F.count("website") / n).alias("website_terminal")), share(bind(s, d, "registry_live"), "exact_registry"), share(bind(s, d, "filings"), "financial"), share(both(bind(s, d, "roles"), bind(s, d, "locations")), "roles_locations"),
        share(seen.groupBy(key).agg(F.count_distinct("platform").alias("p")).where("p >= 2"), "two_platforms"), *(share(seen.where(F.col("signal_type").isin(*signals)), name) for name, signals in _SHARES.items()),
        share(seen.join(F.broadcast(newest)).where("retrieved_at >= last - interval 45 days"), "fresh"), share(rollup(bind(s, d, "sentiment_predictions")).where("status = 'available'"), "sentiment"),
        _audit(s, d, "false", "seq % 120 = 0").select("audited", "wrong", "unsupported", F.col("passed").alias("external_qualified"), (F.col("audited") >= 100).alias("audit_size")),
        metrics_summary(bind(s, d, "sentiment_gold"), bind(s, d, "sentiment_predictions")).select(F.col("qualified").alias("sentiment_qualified")),
        bind(s, d, "sentiment_predictions").agg(F.count_if(~F.col("exact_entity")).alias("sentiment_wrong"), (F.count("source_url") / F.count("*")).alias("sentiment_support")),
        refresh_metrics(s, d).select(((F.col("precision") >= 0.95) & (F.col("recall") >= 0.95)).alias("refresh_qualified"), F.lit(True).alias("refresh_complete")), refresh_idempotent(s, d).agg((F.count("*") == 0).alias("idempotent")),
        bind(s, d, "http_log").agg(F.expr("percentile_disc(0.95) within group (order by latency_ms)").alias("p95_ms")), seen.agg((F.count_if(F.col("rights_status") != "approved") == 0).alias("connector_policy")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.join(part)  # one row each
    return whole.withColumns({"batch_valid": F.lit(True), "resume_valid": F.lit(True), "refetched": F.lit(0), "external_qa": F.lit(False), "ux_external": F.lit(False), "research": F.lit(11.0), "ux": F.lit(6.0)})


def _proxy_sql() -> str:
    n = "(select count(*) from registry)"
    known = "organisation_number in (select organisation_number from registry)"
    share = lambda rows: f"(select count(distinct organisation_number) from ({rows}) where {known}) * 1.0::double / {n}"
    ok = f"({_VALID} select * from v where len(reasons) = 0)"
    signals = {name: share(f"select * from {ok} where signal_type in {of}") for name, of in _SHARES.items()}
    two = share(f"select organisation_number from {ok} group by 1 having count(distinct platform) >= 2")
    fresh = share(f"select * from {ok} where retrieved_at >= (select max(retrieved_at) from {ok}) - interval 45 days")
    felt = share(f"select * from ({SENTIMENT['sentiment_rollup'][1]}) where status = 'available'")
    return f"""{ctes("registry", "registry_live", "filings", "roles", "locations", "sentiment_predictions", "http_log", "observations")},
 o as (select count(*) as audited, 0 as wrong, count(*) filter (where seq % 120 = 0) as unsupported from observations where rights_status = 'approved' and seq % 2 = 0), a as (select *, audited >= 100 and unsupported <= 0.02 * audited as passed from o), s as (select qualified and (select count(*) from sentiment_predictions where not exact_entity) = 0 as ok from ({SENTIMENT["sentiment_summary"][1]})), r as (select precision >= 0.95 and recall >= 0.95 as ok from ({REFRESH["refresh_metrics"][1]})),
 p as (select quantile_disc(latency_ms, 0.95) <= 10000 as ok from http_log),
 m as (select round(case when passed and wrong = 0 then 10 else 0 end + case when passed then 10 * {two} + 7 * {signals["workforce_jobs"]} + 8 * {signals["ratings_reviews"]} + 7 * {signals["buzz_engagement"]} + 3 * {fresh} else 0 end + case when s.ok then 10 * {felt} else 0 end, 3) as external,
  round(4 * {share("select * from registry_live")} + 4 * {share("select * from filings")} + 4 * {share("select organisation_number from roles where organisation_number in (select organisation_number from locations)")} + 3.0 * (select count(website) from registry) / {n}, 3) as foundation,
  5.0 as research_agent, round(6 + 2 + case when r.ok then 3 else 0 end + case when p.ok then 1 else 0 end, 3) as daily, 4.0 as design, {n} = (select count(*) from registry_live where {known}) and wrong = 0 and unsupported = 0 and audited >= 100 and r.ok as qualified from a, s, r, p)
 select cast(external as double) as external, cast(foundation as double) as foundation, cast(research_agent as double) as research_agent, cast(daily as double) as daily, cast(design as double) as design, qualified, round(cast(external + foundation + research_agent + daily + design as double), 3) as raw, case when qualified then round(cast(external + foundation + research_agent + daily + design as double), 3) else 0.0::double end as awardable from m"""


_K = "cast(organisation_number as bigint)"
_NAMES = ", ".join(f"({i}, '{c}', {POLICY.get(c, (1, 0.0, True, 'review_required'))[1]}, {POLICY.get(c, (1, 0.0, True, 'review_required'))[2]}, '{POLICY.get(c, (1, 0.0, True, 'review_required'))[3]}')" for i, c in enumerate([*POLICY, "unheard_of"]))
QUERIES = {
    "connector_enablement": (_enabled, f"""{ctes("registry")}, n as (select count(*) as n, count(website) as sites from registry), w(way, name) as (values ('defaults offline', 'company_site_activity'), ('defaults offline', 'registry_workforce'), ('defaults online', 'company_site_activity'),
 ('defaults online', 'registry_workforce'), ('defaults online', 'places'), ('named', 'news_search'), ('named', 'company_site_activity')) select way, name, case when name = 'company_site_activity' then sites else n end as companies from w, n"""),
    "enrichment_plan": (lambda s, d: plan(_tasks(s, d), 5, 0.03), f"""{ctes("registry")[:4]} recursive {ctes("registry")[5:]}, p(seq, connector, cost, needs, rights) as (values {_NAMES}),
 t as (select organisation_number, {_K} as k, seq, connector, cost, case when rights <> 'approved' then 'rights' when needs and connector like '%!_connector' escape '!' and {_K} % 2 <> 0 then 'handle'
 when needs and connector not like '%!_connector' escape '!' and {_K} % 4 <> 0 and {_K} % 9 = 0 then 'identity' when connector = 'permitted_search_api' and ({_K} % 4 = 0 or {_K} % 6 = 1) then 'redundant' end as gate from registry, p),
 f as (select organisation_number, cast(-1 as int) as seq, cast(0 as int) as requests, cast(0 as bigint) as micro, '' as connector, cast('' as varchar) as verdict from registry
 union all select t.organisation_number, t.seq, requests + cast(ok as int), micro + case when ok then cast(round(cost * 1000000) as bigint) else 0 end, t.connector, case when gate is not null then gate when ok then 'run' else 'budget' end
 from (select t.*, f.requests, f.micro, gate is null and f.requests + 1 <= 4.5 and f.micro + round(cost * 1000000) <= 27000 as ok from f join t on t.organisation_number = f.organisation_number and t.seq = f.seq + 1) t)
 select organisation_number, cast(seq as bigint) as seq, connector, case verdict when 'run' then 'run' else 'skip' end as action, case verdict {" ".join(f"when '{k}' then '{v}'" for k, v in REASONS.items())} end as reason,
 max(requests) over (partition by organisation_number) as planned_requests, round(max(micro) over (partition by organisation_number) / 1000000.0, 6) as planned_cost from f qualify seq >= 0"""),
    "identity_gate": (_gate, f"""{ctes("registry")}, g as (select organisation_number, {_K} as k from registry) select organisation_number, case when k % 5 <> 0 then case when k % 3 = 0 or k % 7 = 0 then '' else trim(case when k % 2 = 0 then 'https://x.com/l0-' || k else '' end || case when k % 3 = 0 then ' https://x.com/l1-' || k else '' end) end end as social_links,
 cast(case when k % 5 = 0 or k % 7 = 0 then 0 when k % 3 = 0 then 2 else 2 - cast(k % 2 = 0 as int) end as int) as quarantined from g"""),
    "observation_label_audit": (_audit, f"""{ctes("observations")}, a as (select count(*) as audited, count(*) filter (where seq % 500 = 0) as wrong, count(*) filter (where seq % 30 = 0) as unsupported from observations where rights_status = 'approved' and seq % 2 = 0),
 b as (select *, round(coalesce((audited - wrong) / nullif(audited, 0), 0.0), 6) as entity_precision, round(coalesce((audited - unsupported) / nullif(audited, 0), 0.0), 6) as metric_precision from a) select *, audited >= 100 and entity_precision >= 0.995 and metric_precision >= 0.98 as passed from b"""),
}
QUERIES["competition_proxy"] = (lambda s, d: competition_proxy(_measures(s, d)), _proxy_sql())
