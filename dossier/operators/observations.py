"""External observations: validation, source policy, resolution, merging and footprint (FLT-04..08, ID-06, AGG-02, AGG-05, AGG-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import BLOCKED_HOSTS, canonical_url, host, on_host

#: Domains of an observation.
PLATFORMS = (
    "company_site", "google_places", "linkedin", "facebook", "instagram", "x", "youtube", "tiktok", "glassdoor", "indeed",
    "job_board", "news", "openstreetmap", "brreg", "apple_app_store", "google_play", "wikidata", "wikipedia", "company_directory",
)
#: Signals of an observation.
SIGNALS = (
    "company_profile", "profile_handle", "profile_metrics", "place_summary", "review", "review_summary", "job_posting",
    "workforce_snapshot", "public_post", "public_mention", "buzz_metrics",
)
#: Ways of acquisition that may be published, and those on trial.
PUBLISHABLE_MODES = ("official_api", "licensed_api", "company_authorized_export", "permitted_public_page")
EXPERIMENTAL_MODES = ("jobspy_experiment", "unofficial_api_experiment", "rights_review_experiment")
#: Classes of sources that are independent of the company.
INDEPENDENT_CLASSES = ("customer_review", "employee_review", "licensed_news", "public_news", "public_mention")
#: Labels of sentiment.
LABELS = ("positive", "neutral", "negative", "mixed")
#: Classes of official sources, and of all others.
OFFICIAL_CLASSES = (
    "official_registry_bulk", "official_registry_live", "official_rule_interpretation", "official_annual_accounts",
    "official_annual_account_copies", "official_roles", "official_group_structure", "official_subunits",
)
OTHER_CLASSES = (
    "registry_linked_company_website", "registry_linked_company_website_scrapy", "company_owned", "company_site",
    "company_linked_social_profile", "company_reported_claim", "licensed_api", "licensed_news", "public_news", "public_mention",
    "customer_review", "employee_review",
)
#: Signals that need words as evidence.
NEEDS_SPAN = ("review", "public_post", "public_mention")


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) == ""


def reasons() -> Column:
    """Why an observation may not be published, in order; empty when it may."""
    label = F.col("sentiment_label").isNotNull()
    checks = [
        ("missing_id", F.trim(F.coalesce("id", F.lit(""))) == ""),
        ("organisation_not_digits", ~F.coalesce(F.col("organisation_number").rlike("^[0-9]+$"), F.lit(False))),
        ("platform", ~F.coalesce(F.col("platform").isin(*PLATFORMS), F.lit(False))),
        ("signal_type", ~F.coalesce(F.col("signal_type").isin(*SIGNALS), F.lit(False))),
        ("source_url", host(F.col("source_url")) == ""),
        ("retrieved_at", _blank("retrieved_at")),
        ("content_hash", F.length(F.coalesce("content_sha256", F.lit(""))) != 64),
        ("entity_not_exact", ~F.coalesce("exact_entity", F.lit(False))),
        ("no_identity_proof", F.coalesce("identity_proof_count", F.lit(0)) == 0),
        ("acquisition_mode", ~F.coalesce(F.col("acquisition_mode").isin(*PUBLISHABLE_MODES), F.lit(False))),
        ("rights", F.coalesce("rights_status", F.lit("")) != "approved"),
        ("no_evidence_span", F.col("signal_type").isin(*NEEDS_SPAN) & _blank("evidence_span")),
        ("sentiment_label", label & ~F.col("sentiment_label").isin(*LABELS)),
        ("sentiment_class", label & ~F.coalesce(F.col("source_class").isin(*INDEPENDENT_CLASSES), F.lit(False))),
        ("sentiment_model", label & _blank("sentiment_model_version")),
    ]
    return F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in checks)), lambda r: r.isNotNull())


def validated(observations: DataFrame) -> DataFrame:
    return observations.withColumn("reasons", reasons()).withColumn("publishable", F.size("reasons") == 0)


_REASONS_SQL = f"""list_filter([
 case when trim(coalesce(id, '')) = '' then 'missing_id' end,
 case when not coalesce(regexp_full_match(organisation_number, '[0-9]+'), false) then 'organisation_not_digits' end,
 case when not coalesce(platform in {PLATFORMS}, false) then 'platform' end,
 case when not coalesce(signal_type in {SIGNALS}, false) then 'signal_type' end,
 case when not coalesce(regexp_matches(source_url, '^https?://[^/]+'), false) then 'source_url' end,
 case when retrieved_at is null then 'retrieved_at' end,
 case when length(coalesce(content_sha256, '')) <> 64 then 'content_hash' end,
 case when not coalesce(exact_entity, false) then 'entity_not_exact' end,
 case when coalesce(identity_proof_count, 0) = 0 then 'no_identity_proof' end,
 case when not coalesce(acquisition_mode in {PUBLISHABLE_MODES}, false) then 'acquisition_mode' end,
 case when coalesce(rights_status, '') <> 'approved' then 'rights' end,
 case when signal_type in {NEEDS_SPAN} and coalesce(evidence_span, '') = '' then 'no_evidence_span' end,
 case when sentiment_label is not null and sentiment_label not in {LABELS} then 'sentiment_label' end,
 case when sentiment_label is not null and not coalesce(source_class in {INDEPENDENT_CLASSES}, false) then 'sentiment_class' end,
 case when sentiment_label is not null and coalesce(sentiment_model_version, '') = '' then 'sentiment_model' end], lambda r: r is not null)"""
_VALID = f"{ctes('observations')}, v as (select *, {_REASONS_SQL} as reasons from observations)"


def observation_reasons(spark, sf_dir):
    return validated(bind(spark, sf_dir, "observations")).select("id", F.array_join("reasons", ",").alias("reasons"), "publishable")


def publishable_counts(spark, sf_dir):
    return validated(bind(spark, sf_dir, "observations")).where("publishable").groupBy("signal_type").agg(F.count("*").alias("n"))


def resolve(observations: DataFrame, anchor: Column | None = None) -> DataFrame:
    """verified, rejected or ambiguous for the company ``anchor``."""
    own = validated(observations)
    identity = F.arrays_overlap("reasons", F.array(F.lit("entity_not_exact"), F.lit("no_identity_proof")))
    status = F.when(F.col("publishable"), "verified").when(identity, "rejected").otherwise("ambiguous")
    if anchor is not None:
        status = F.when(F.col("organisation_number") != anchor, "rejected").otherwise(status)
    return own.withColumn("resolution", status).withColumn("resolution_score", F.when(F.col("resolution") == "verified", 1.0).otherwise(0.0))


def observation_resolution(spark, sf_dir):
    return resolve(bind(spark, sf_dir, "observations")).select("id", "resolution", "resolution_score")


def decide(observations: DataFrame) -> DataFrame:
    """allowed, availability, rights and reasons of the source policy."""
    official = F.col("source_class").startswith("official_")
    known = F.col("source_class").isin(*OFFICIAL_CLASSES)
    checks = [
        ("host", on_host(host(F.col("source_url")), BLOCKED_HOSTS)),
        ("class", ~F.col("source_class").isin(*OFFICIAL_CLASSES, *OTHER_CLASSES)),
        ("mode_experimental", F.col("acquisition_mode").isin(*EXPERIMENTAL_MODES)),
        ("mode", ~F.col("acquisition_mode").isin(*PUBLISHABLE_MODES, *EXPERIMENTAL_MODES)),
        ("rights", F.col("rights_status") != "approved"),
    ]
    found = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks)), lambda r: r.isNotNull())
    why = F.when(official & known, F.array().cast("array<string>")).when(official, F.array(F.lit("class"))).otherwise(found)
    rights = F.when(F.size("why") == 0, "approved").when(official | (F.col("rights_status") == "blocked"), "blocked").otherwise(F.coalesce("rights_status", F.lit("review_required")))
    own = observations.withColumn("why", why).withColumn("rights", rights).withColumn("allowed", F.size("why") == 0)
    return own.withColumn("availability", F.when(F.col("allowed"), "available").when(F.col("rights") == "blocked", "blocked").otherwise("not_available"))


def source_policy_decisions(spark, sf_dir):
    return decide(bind(spark, sf_dir, "observations")).select("id", "allowed", "availability", "rights", F.array_join("why", ",").alias("why"))


def merge(observations: DataFrame) -> DataFrame:
    """First row per (company, platform, signal, canonical URL); ids in order, the rest follow the first."""
    own = observations.withColumn("url", canonical_url(F.col("source_url")))
    keys = ["organisation_number", "platform", "signal_type", "url"]
    ids = F.transform(F.array_sort(F.collect_list(F.struct("seq", "id"))), lambda s: s["id"])
    return own.groupBy(*keys).agg(F.min_by("id", "seq").alias("id"), F.min_by("content_sha256", "seq").alias("content_sha256"), ids.alias("ids"), F.count("*").alias("merged"))


def observation_dedupe(spark, sf_dir):
    return merge(bind(spark, sf_dir, "observations")).select("organisation_number", "platform", "signal_type", "url", "id", F.array_join("ids", ",").alias("ids"), "merged")


def footprint(observations: DataFrame, as_of: str, days: int = 45) -> DataFrame:
    """Conservative summary per company; counts stay apart by source."""
    own = validated(observations)
    ok = F.col("publishable")
    at = F.col("retrieved_at").cast("timestamp")
    age = F.lit(as_of).cast("timestamp").cast("double") - at.cast("double")
    public = ok & F.col("signal_type").isin("public_post", "public_mention", "buzz_metrics")
    felt = ok & F.col("sentiment_label").isNotNull()
    value = F.when(felt, F.when(F.col("sentiment_label") == "positive", 1).when(F.col("sentiment_label") == "negative", -1).when(F.col("sentiment_label") == "neutral", 0))
    found = own.groupBy("organisation_number").agg(
        F.count_if(ok).alias("accepted"),
        F.count_if(~ok).alias("rejected"),
        F.count_if(ok & (age >= 0) & (age <= days * 86400)).alias("fresh"),
        F.count_if(ok & F.col("signal_type").isin("review", "review_summary")).alias("reviews"),
        F.count_distinct(F.when(ok & (F.col("signal_type") == "job_posting"), F.col("source_url"))).alias("active_jobs"),
        F.count_distinct(F.when(public, F.col("source_url"))).alias("public_items"),
        F.coalesce(F.sum(F.when(public, F.col("likes"))), F.lit(0)).alias("engagement"),
        F.count_if(felt).alias("sentiment_items"),
        F.count_distinct(F.when(felt, host(F.col("source_url")))).alias("sentiment_hosts"),
        F.count_distinct(F.when(felt, F.col("reviewer_id"))).alias("reviewers"),
        F.array_join(F.array_sort(F.collect_set(F.when(ok, F.col("platform")))), ",").alias("platforms"),
        F.avg(value).alias("_mean"),
    )
    ready = (F.col("sentiment_items") >= 10) & ((F.col("sentiment_hosts") >= 2) | (F.col("reviewers") >= 10))
    return found.select(
        *(c for c in found.columns if c != "_mean"),
        F.when(F.col("accepted") > 0, "available").otherwise("not_available").alias("status"),
        F.when(ready, "available").otherwise("abstain").alias("sentiment_status"),
        F.when(ready, F.round(50 + 50 * F.col("_mean"), 1)).alias("sentiment_score"),
    )


def footprint_summary(spark, sf_dir):
    return footprint(bind(spark, sf_dir, "observations"), "2024-01-31 00:00:00", 10)


_FOOTPRINT_SQL = f"""{_VALID}, o as (select *, len(reasons) = 0 as ok, regexp_extract(source_url, '://([^/]+)', 1) as h from v), g as (
select organisation_number, count(*) filter (where ok) as accepted, count(*) filter (where not ok) as rejected,
 count(*) filter (where ok and retrieved_at <= timestamp '2024-01-31' and retrieved_at >= timestamp '2024-01-21') as fresh,
 count(*) filter (where ok and signal_type in ('review', 'review_summary')) as reviews,
 count(distinct source_url) filter (where ok and signal_type = 'job_posting') as active_jobs,
 count(distinct source_url) filter (where ok and signal_type in ('public_post', 'public_mention', 'buzz_metrics')) as public_items,
 cast(coalesce(sum(likes) filter (where ok and signal_type in ('public_post', 'public_mention', 'buzz_metrics')), 0) as bigint) as engagement,
 count(*) filter (where ok and sentiment_label is not null) as sentiment_items,
 count(distinct h) filter (where ok and sentiment_label is not null) as sentiment_hosts,
 count(distinct reviewer_id) filter (where ok and sentiment_label is not null) as reviewers,
 coalesce(string_agg(distinct platform, ',' order by platform) filter (where ok), '') as platforms,
 avg(case sentiment_label when 'positive' then 1 when 'negative' then -1 when 'neutral' then 0 end) filter (where ok) as m
from o group by organisation_number)
select * exclude (m), case when accepted > 0 then 'available' else 'not_available' end as status,
 case when sentiment_items >= 10 and (sentiment_hosts >= 2 or reviewers >= 10) then 'available' else 'abstain' end as sentiment_status,
 case when sentiment_items >= 10 and (sentiment_hosts >= 2 or reviewers >= 10) then round(50 + 50 * m, 1) end as sentiment_score from g"""


def coverage(observations: DataFrame, registry: DataFrame) -> DataFrame:
    """Shares of all companies with any accepted observation, handles, reviews, jobs, buzz, sentiment; absent ones count as none."""
    own = validated(observations).where("publishable").groupBy("organisation_number").agg(
        F.lit(1).alias("any"),
        F.max(F.col("signal_type").isin("review", "review_summary").cast("int")).alias("reviews"),
        F.max((F.col("signal_type") == "job_posting").cast("int")).alias("jobs"),
        F.max(F.col("signal_type").isin("public_post", "public_mention", "buzz_metrics").cast("int")).alias("buzz"),
        F.max(F.col("sentiment_label").isNotNull().cast("int")).alias("sentiment"),
    )
    all_ = registry.select("organisation_number").join(own, "organisation_number", "left")
    return all_.agg(F.count("*").alias("companies"), *(F.round(F.avg(F.coalesce(c, F.lit(0))), 6).alias(f"{c}_share") for c in ("any", "reviews", "jobs", "buzz", "sentiment")))


def external_coverage(spark, sf_dir):
    return coverage(bind(spark, sf_dir, "observations"), bind(spark, sf_dir, "registry"))


_BLOCKED_SQL = " or ".join(f"h = '{b}' or ends_with(h, '.{b}')" for b in BLOCKED_HOSTS)
QUERIES = {
    "observation_reasons": (observation_reasons, f"{_VALID} select id, array_to_string(reasons, ',') as reasons, len(reasons) = 0 as publishable from v"),
    "observation_publishable_counts": (publishable_counts, f"{_VALID} select signal_type, count(*) as n from v where len(reasons) = 0 group by signal_type"),
    "observation_resolution": (observation_resolution, f"""{_VALID} select id, case when len(reasons) = 0 then 'verified' when list_has_any(reasons, ['entity_not_exact', 'no_identity_proof']) then 'rejected' else 'ambiguous' end as resolution,
 case when len(reasons) = 0 then 1.0::double else 0.0::double end as resolution_score from v"""),
    "source_policy_decisions": (source_policy_decisions, f"""{ctes("observations")}, h as (select *, regexp_extract(source_url, '://([^/]+)', 1) as h from observations), w as (select *, list_filter([
 case when {_BLOCKED_SQL} then 'host' end, case when source_class not in {OFFICIAL_CLASSES + OTHER_CLASSES} then 'class' end,
 case when acquisition_mode in {EXPERIMENTAL_MODES} then 'mode_experimental' end, case when acquisition_mode not in {PUBLISHABLE_MODES + EXPERIMENTAL_MODES} then 'mode' end,
 case when rights_status <> 'approved' then 'rights' end], lambda r: r is not null) as why from h)
select id, len(why) = 0 as allowed, case when len(why) = 0 then 'available' when rights_status = 'blocked' then 'blocked' else 'not_available' end as availability,
 case when len(why) = 0 then 'approved' else rights_status end as rights, array_to_string(why, ',') as why from w"""),
    "observation_dedupe": (observation_dedupe, f"""{ctes("observations")} select organisation_number, platform, signal_type, source_url as url, min_by(id, seq) as id, string_agg(id, ',' order by seq) as ids, count(*) as merged
 from observations group by organisation_number, platform, signal_type, source_url"""),
    "footprint_summary": (footprint_summary, _FOOTPRINT_SQL),
    "external_coverage": (external_coverage, f"""{_VALID.replace("with ", "with ", 1)}, {ctes("registry").removeprefix("with ")}, o as (select organisation_number, 1 as a, max(cast(signal_type in ('review', 'review_summary') as int)) as r,
 max(cast(signal_type = 'job_posting' as int)) as j, max(cast(signal_type in ('public_post', 'public_mention', 'buzz_metrics') as int)) as b, max(cast(sentiment_label is not null as int)) as s from v where len(reasons) = 0 group by organisation_number)
select count(*) as companies, round(avg(coalesce(a, 0)), 6) as any_share, round(avg(coalesce(r, 0)), 6) as reviews_share, round(avg(coalesce(j, 0)), 6) as jobs_share, round(avg(coalesce(b, 0)), 6) as buzz_share, round(avg(coalesce(s, 0)), 6) as sentiment_share
from registry left join o using (organisation_number)"""),
}
