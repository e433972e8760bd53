"""Sentiment, coverage scores, strategies and budget (AGG-03, AGG-04, AGG-06, FLT-09, SCO-01, SCO-02, SCO-04, SCO-05, WIN-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import host
from dossier.operators.observations import _VALID, EXPERIMENTAL_MODES, LABELS, validated

#: Strategies in order.
STRATEGIES = (
    "company_site_feed", "company_site_identity", "company_site_activity", "company_directory_identity", "verified_handle_extraction",
    "registry_workforce_snapshot", "about_contact_deep_pages", "youtube_channel_feed", "places_identity_resolution", "places_rating_reviews",
    "jobs_feed_discovery", "linkedin_workforce_snapshot", "annual_report_workforce_snapshot", "social_profile_metrics",
    "independent_news_discovery", "exact_entity_article_capture", "independent_sentiment", "buzz_peer_normalization",
)


def rollup(predictions: DataFrame) -> DataFrame:
    """Company sentiment: accepted items of two independent sources at least, else abstain; mixed where labels other than neutral differ."""
    ok = F.col("exact_entity") & (F.col("source_class") != "company_owned")
    felt = F.array_remove(F.collect_set(F.when(ok, F.col("label"))), "neutral")
    own = predictions.groupBy("organisation_number").agg(F.count_if(ok).alias("items"), F.count_distinct(F.when(ok, host(F.col("source_url")))).alias("sources"), F.array_sort(felt).alias("_felt"))
    label = F.when(F.size("_felt") == 0, "neutral").when(F.size("_felt") == 1, F.col("_felt")[0]).otherwise("mixed")
    return own.select("organisation_number", "items", "sources", F.when(F.col("sources") < 2, "abstain").otherwise("available").alias("status"), F.when(F.col("sources") >= 2, label).alias("label"))


def label_metrics(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall, F1 per label; a missing prediction is a null label."""
    own = gold.join(predictions.select("id", F.col("label").alias("guess")), "id", "left")
    labels = F.array(*map(F.lit, LABELS))
    hits = own.select("label", "guess", F.explode(labels).alias("of"))
    t, g = F.coalesce(F.col("label") == F.col("of"), F.lit(False)), F.coalesce(F.col("guess") == F.col("of"), F.lit(False))
    n = hits.groupBy(F.col("of").alias("label")).agg(F.count_if(t & g).alias("tp"), F.count_if(~t & g).alias("fp"), F.count_if(t & ~g).alias("fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return n.select("label", "tp", "fp", "fn", F.round(ratio(tp, tp + fp), 6).alias("precision"), F.round(ratio(tp, tp + fn), 6).alias("recall"), F.round(ratio(2 * tp, 2 * tp + fp + fn), 6).alias("f1"))


def metrics_summary(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Accuracy and coverage over gold, macro-F1 over labels that gold has, and the gate."""
    own = gold.join(predictions.select("id", F.col("label").alias("guess")), "id", "left")
    whole = own.agg(F.count("*").alias("items"), F.round(F.avg(F.coalesce(F.col("label") == F.col("guess"), F.lit(False)).cast("int")), 6).alias("accuracy"), F.round(F.avg(F.col("guess").isNotNull().cast("int")), 6).alias("coverage"))
    macro = label_metrics(gold, predictions).where("tp + fn > 0").agg(F.round(F.avg("f1"), 6).alias("macro_f1"))
    return whole.join(macro).withColumn("qualified", (F.col("items") >= 300) & (F.col("macro_f1") >= 0.8) & (F.col("coverage") >= 0.5))


def development(observations: DataFrame) -> DataFrame:
    """Strict and experimental coverage score per company, from one conditional aggregate."""
    own = validated(observations)
    ok = F.col("publishable")
    trial = F.col("acquisition_mode").isin(*EXPERIMENTAL_MODES) & F.col("exact_entity") & (F.col("identity_proof_count") > 0) & F.col("content_sha256").isNotNull()
    has = lambda cond, *signals: F.max((cond & F.col("signal_type").isin(*signals)).cast("int"))
    handles = lambda cond: F.least(F.lit(15.0), 5.0 * F.count_distinct(F.when(cond & (F.col("signal_type") == "profile_handle"), F.col("platform"))))
    felt = ok & F.col("sentiment_label").isNotNull()
    tried = trial & F.col("sentiment_label").isNotNull()
    ready = lambda c: ((F.count_if(c) >= 10) & ((F.count_distinct(F.when(c, host(F.col("source_url")))) >= 2) | (F.count_distinct(F.when(c, F.col("reviewer_id"))) >= 10))).cast("int")

    def pieces(cond, ident, sentiment):
        place = (F.col("platform") == "google_places") & (F.col("signal_type") == "place_summary")
        return (
            20.0 * F.max((ident & place).cast("int")) + handles(cond) + 10.0 * has(cond, "profile_metrics") + 5.0 * has(cond, "place_summary")
            + 10.0 * has(cond, "review", "review_summary") + 10.0 * has(cond, "job_posting", "workforce_snapshot")
            + 10.0 * has(cond, "public_post", "public_mention", "buzz_metrics") + 15.0 * sentiment
        )

    fresh = 5.0 * F.max(ok.cast("int"))
    return own.groupBy("organisation_number").agg(
        F.count_if(ok).alias("accepted"), F.count_if(trial).alias("experimental"),
        F.round(pieces(ok, ok, ready(felt)) + fresh, 3).alias("score"), F.round(pieces(ok | trial, ok | trial, F.greatest(ready(felt), ready(tried))) + fresh, 3).alias("potential"),
    )


def completeness(found: DataFrame, external: DataFrame) -> DataFrame:
    """Foundation weights 5/10/5/5/5 by module and an enrichment part from the external score, rounded as components are."""
    weight = {"registry": 5, "financials": 10, "roles": 5, "registry_live": 5, "website": 5}
    part = F.lit(0.0)
    for module, w in weight.items():
        part = F.when(F.col("module") == module, F.lit(float(w))).otherwise(part)
    base = found.groupBy("organisation_number").agg(F.sum(F.when(F.col("status").isin("available", "not_found", "not_applicable"), part).otherwise(0.0)).alias("foundation"))
    clamp = F.round(70 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("score", F.lit(0.0)) / 100)), 3)
    return base.join(external, "organisation_number", "left").select("organisation_number", "foundation", clamp.alias("enrichment"), F.round(F.col("foundation") + clamp, 3).alias("strict"))


def completeness_summary(scores: DataFrame, base_size: int) -> DataFrame:
    """Means and threshold counts of the first ``base_size`` companies against the rest (their transfer)."""
    half = F.when(F.col("organisation_number").cast("bigint") - 900000000 <= base_size, "base").otherwise("extension")
    return scores.groupBy(half.alias("slice")).agg(F.count("*").alias("n"), F.round(F.avg("strict"), 3).alias("mean"), F.count_if(F.col("strict") >= 50).alias("at_50"), F.count_if(F.col("strict") >= 65).alias("at_65"))


def strategy_priority(iterations: DataFrame) -> DataFrame:
    """Mean gain plus an exploration bonus; a gain of zero falls through to the score delta."""
    spark = iterations.sparkSession
    names = spark.createDataFrame([(s, i) for i, s in enumerate(STRATEGIES)], "strategy string, ix int")
    gain = F.coalesce(F.nullif("learning_gain", F.lit(0.0)), F.nullif("score_delta", F.lit(0.0)), F.lit(0.0))
    per = iterations.groupBy("strategy").agg(F.count("*").alias("n"), F.avg(gain).alias("mean"))
    total = iterations.agg(F.greatest(F.lit(1), F.count("*")).alias("total"))
    own = names.join(per, "strategy", "left").join(total)
    n = F.coalesce("n", F.lit(0))
    return own.select("strategy", n.alias("n"), F.round(F.coalesce("mean", F.lit(0.0)) + 0.35 * F.sqrt(F.ln(F.col("total") + 1) / (n + 1)), 9).alias("priority"), F.row_number().over(Window.orderBy((F.coalesce("mean", F.lit(0.0)) + 0.35 * F.sqrt(F.ln(F.col("total") + 1) / (n + 1))).desc(), "ix")).alias("place"))


def budget_uniform(tasks: DataFrame, most: int, order: list[str]) -> DataFrame:
    """Equal costs: the first ``most`` tasks in order, a top-k."""
    return tasks.orderBy(*order).limit(most)


def budget_greedy(tasks: DataFrame, budget: float, group: str) -> DataFrame:
    """Unequal costs within each group: a refused task spends nothing and a cheaper one may still pass. A fold over the group's ordered tasks."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "cost")))
    zero = F.struct(F.lit(0.0).alias("spent"), F.array().cast("array<bigint>").alias("taken"))
    fits = lambda a, t: a["spent"] + t["cost"] <= budget
    step = lambda a, t: F.struct(F.when(fits(a, t), a["spent"] + t["cost"]).otherwise(a["spent"]).alias("spent"), F.when(fits(a, t), F.array_append(a["taken"], t["seq"])).otherwise(a["taken"]).alias("taken"))
    folded = tasks.groupBy(group).agg(F.aggregate(ordered, zero, step).alias("f"))
    return folded.select(group, F.round("f.spent", 6).alias("spent"), F.size("f.taken").alias("accepted"))


def _completeness(spark, sf_dir):
    from dossier.operators.claims import _modules

    return completeness(_modules(spark, sf_dir), development(bind(spark, sf_dir, "observations")).select("organisation_number", "score"))


def _tasks(spark, sf_dir):
    return bind(spark, sf_dir, "events").select(F.col("event_type").alias("connector"), F.col("event_id").alias("seq"), F.round("value", 2).alias("cost"), "user_id")


_S = ctes("sentiment_gold", "sentiment_predictions")
_LM = f"""{_S}, j as (select g.label, p.label as guess from sentiment_gold g left join sentiment_predictions p on g.id = p.id), n as (
 select l.label, count(*) filter (where j.label = l.label and guess = l.label) as tp, count(*) filter (where j.label <> l.label and guess = l.label) as fp, count(*) filter (where j.label = l.label and guess is distinct from l.label) as fn
 from (values ('positive'), ('neutral'), ('negative'), ('mixed')) l(label) cross join j group by l.label),
m as (select label, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::double, 0.0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0)::double, 0.0), 6) as recall, round(coalesce(2.0::double * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) as f1 from n)"""
_OK = "len(reasons) = 0"
_TRIAL = f"(acquisition_mode in {EXPERIMENTAL_MODES} and exact_entity and identity_proof_count > 0 and content_sha256 is not null)"


def _pieces(cond: str, sentiment: str) -> str:
    h = lambda *s: f"coalesce(max(cast({cond} and signal_type in ({', '.join(repr(x) for x in s)}) as int)), 0)"
    return (
        f"20.0 * max(cast({cond} and platform = 'google_places' and signal_type = 'place_summary' as int)) + least(15.0, 5.0 * count(distinct case when {cond} and signal_type = 'profile_handle' then platform end)) + 10.0 * {h('profile_metrics')} + 5.0 * {h('place_summary')}"
        f" + 10.0 * {h('review', 'review_summary')} + 10.0 * {h('job_posting', 'workforce_snapshot')} + 10.0 * {h('public_post', 'public_mention', 'buzz_metrics')} + 15.0 * {sentiment} + 5.0 * max(cast({_OK} as int))"
    )


def _ready(cond: str) -> str:
    c = f"({cond} and sentiment_label is not null)"
    return f"cast(count(*) filter (where {c}) >= 10 and (count(distinct case when {c} then regexp_extract(source_url, '://([^/]+)', 1) end) >= 2 or count(distinct case when {c} then reviewer_id end) >= 10) as int)"


_DEV = f"""{_VALID}, dev as (select organisation_number, count(*) filter (where {_OK}) as accepted, count(*) filter (where {_TRIAL}) as experimental,
 cast({_pieces(_OK, _ready(_OK))} as double) as score, cast({_pieces(f"({_OK} or {_TRIAL})", f"greatest({_ready(_OK)}, {_ready(_TRIAL)})")} as double) as potential from v group by organisation_number)"""
_COMP = f"""{_DEV}, {ctes("registry", "registry_live", "filings", "roles").removeprefix("with ")}, f as (select organisation_number, cast(5
 + case when organisation_number in (select organisation_number from registry_live) then 5 else 0 end + 10 + 5
 + case when website is not null and cast(organisation_number as bigint) % 5 = 0 then 0 else 5 end as double) as foundation from registry),
 s as (select f.organisation_number, foundation, round(70 * least(1.0::double, greatest(0.0::double, coalesce(score, 0.0) / 100)), 3) as enrichment from f left join dev on dev.organisation_number = f.organisation_number)"""
QUERIES = {
    "sentiment_rollup": (lambda s, d: rollup(bind(s, d, "sentiment_predictions")), f"""{ctes("sentiment_predictions")}, g as (select organisation_number, count(*) filter (where exact_entity and source_class <> 'company_owned') as items,
 count(distinct regexp_extract(source_url, '://([^/]+)', 1)) filter (where exact_entity and source_class <> 'company_owned') as sources,
 list_sort(list(distinct label) filter (where exact_entity and source_class <> 'company_owned' and label <> 'neutral')) as felt from sentiment_predictions group by 1)
 select organisation_number, items, sources, case when sources < 2 then 'abstain' else 'available' end as status, case when sources >= 2 then case when coalesce(len(felt), 0) = 0 then 'neutral' when len(felt) = 1 then felt[1] else 'mixed' end end as label from g"""),
    "sentiment_metrics": (lambda s, d: label_metrics(bind(s, d, "sentiment_gold"), bind(s, d, "sentiment_predictions")), f"{_LM} select * from m"),
    "sentiment_summary": (lambda s, d: metrics_summary(bind(s, d, "sentiment_gold"), bind(s, d, "sentiment_predictions")), f"""{_LM}, a as (select count(*) as items, round(avg(cast(coalesce(label = guess, false) as int)), 6) as accuracy, round(avg(cast(guess is not null as int)), 6) as coverage from j),
 b as (select round(avg(f1), 6) as macro_f1 from m where tp + fn > 0) select *, items >= 300 and macro_f1 >= 0.8 and coverage >= 0.5 as qualified from a, b"""),
    "development_score": (lambda s, d: development(bind(s, d, "observations")), f"{_DEV} select * from dev"),
    "completeness_scores": (_completeness, f"{_COMP} select *, round(foundation + enrichment, 3) as strict from s"),
    "completeness_transfer": (lambda s, d: completeness_summary(_completeness(s, d), 500), f"""{_COMP} select case when cast(organisation_number as bigint) - 900000000 <= 500 then 'base' else 'extension' end as slice, count(*) as n, round(avg(round(foundation + enrichment, 3)), 3) as mean,
 count(*) filter (where foundation + enrichment >= 50) as at_50, count(*) filter (where foundation + enrichment >= 65) as at_65 from s group by 1"""),
    "strategy_priority": (lambda s, d: strategy_priority(bind(s, d, "iterations")), f"""{ctes("iterations")}, st(strategy, ix) as (values {", ".join(f"('{s}', {i})" for i, s in enumerate(STRATEGIES))}),
 p as (select strategy, count(*) as n, avg(coalesce(nullif(learning_gain, 0), nullif(score_delta, 0), 0)) as mean from iterations group by 1),
 q as (select st.strategy, ix, coalesce(n, 0) as n, coalesce(mean, 0) + 0.35 * sqrt(ln((select count(*) from iterations) + 1) / (coalesce(n, 0) + 1)) as pr from st left join p on p.strategy = st.strategy)
 select strategy, n, round(pr, 9) as priority, cast(row_number() over (order by pr desc, ix) as int) as place from q"""),
    "budget_uniform": (lambda s, d: budget_uniform(_tasks(s, d), 500, ["user_id", "seq"]).select("user_id", "seq"), "select user_id, event_id as seq from events order by user_id, event_id limit 500"),
    "budget_greedy": (lambda s, d: budget_greedy(_tasks(s, d), 100.0, "user_id"), """with recursive t as (select user_id, round(value, 2) as cost, row_number() over (partition by user_id order by event_id) as k from events),
 g as (select user_id, k, case when cost <= 100 then cost else 0.0 end as spent, case when cost <= 100 then 1 else 0 end as accepted from t where k = 1
 union all select t.user_id, t.k, case when g.spent + t.cost <= 100 then g.spent + t.cost else g.spent end, g.accepted + case when g.spent + t.cost <= 100 then 1 else 0 end from g join t on t.user_id = g.user_id and t.k = g.k + 1)
 select user_id, round(max_by(spent, k), 6) as spent, cast(max(accepted) as int) as accepted from g group by user_id"""),
}
