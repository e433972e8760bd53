"""The control loop of a company: every strategy once, in the order that earlier gains give, and what each step adds (SCO-01, SCO-03).

A strategy's observations become visible when its turn comes. The order depends on the prior iterations and the step alone (a
strategy that ran never runs again, so its own gain can steer no later choice of the same company); hence it is one list for
all companies, and the steps are running windows over at most 18 rows of a company. All strategies run whatever the score, so
the last score is that of all visible observations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.frames import with_once
from dossier.functions.text import host
from dossier.operators.observations import _REASONS_SQL, EXPERIMENTAL_MODES, validated
from dossier.operators.scoring import STRATEGIES

#: Points of the parts of a score, and signals that earn them.
POINTS = {"metrics": (10.0, ("profile_metrics",)), "place": (5.0, ("place_summary",)), "reviews": (10.0, ("review", "review_summary")), "jobs": (10.0, ("job_posting", "workforce_snapshot")), "buzz": (10.0, ("public_post", "public_mention", "buzz_metrics"))}
IDENTITY, HANDLE, HANDLES, SENTIMENT, FRESH = 20.0, 5.0, 15.0, 15.0, 5.0
#: Labelled items, and hosts or reviewers among them, that make sentiment ready; ratings that make a summary.
ITEMS, HOSTS, REVIEWERS, RATINGS = 10, 2, 10, 10
#: Fixed value: where observations without a strategy belong.
DEFAULT = "buzz_peer_normalization"
#: What a step keeps of hosts, reviewers and handles each; no rule asks for more.
MOST = 10
_BITS = {name: 1 << i for i, name in enumerate((f"{side}.{part}" for side in ("accepted", "experimental") for part in ("identity", *POINTS, "summary")))}


def marks(observations: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per observation what the score asks for: (organisation_number, strategy, accepted, experimental, flags, felt, tried, seen).

    ``flags`` has a bit per rule that one observation meets; ``seen`` holds tagged platforms of handles, and hosts and reviewers
    of labelled items. Optional columns: strategy, rating, review_count. Columns named in ``keep`` stay.
    """
    own = validated(observations)
    for name, kind in (("strategy", "string"), ("rating", "double"), ("review_count", "long")):
        if name not in own.columns:
            own = own.withColumn(name, F.lit(None).cast(kind))
    yes = lambda c: F.coalesce(c, F.lit(False))
    trial = yes(F.col("acquisition_mode").isin(*EXPERIMENTAL_MODES) & F.col("exact_entity") & (F.col("identity_proof_count") > 0) & (F.col("content_sha256") != ""))
    own = with_once(own, {"_accepted": F.col("publishable"), "_tried": trial, "_site": host(F.col("source_url"))})
    signal, platform, labelled = F.col("signal_type"), F.col("platform"), F.col("sentiment_label").isNotNull()
    accepted, tried, site = F.col("_accepted"), F.col("_tried"), F.col("_site")
    place = (platform == "google_places") & (signal == "place_summary")
    rules = {f"{side}.{part}": signal.isin(*signals) for side in ("accepted", "experimental") for part, (_, signals) in POINTS.items()}
    rules |= {"accepted.identity": place | ((platform == "wikidata") & (signal == "company_profile")), "experimental.identity": place | ((platform == "company_directory") & (signal == "company_profile"))}
    rules |= {"experimental.summary": (signal == "review_summary") & (F.col("review_count") >= RATINGS) & (F.col("rating") > 0) & (F.col("rating") <= 5)}
    flags = F.lit(0).cast("long")
    for name, rule in rules.items():
        flags = flags.bitwiseOR(F.when((accepted if name.startswith("accepted") else tried) & yes(rule), _BITS[name]).otherwise(0))
    tag = lambda on, name, value: F.when(on & (value != ""), F.concat(F.lit(name + ":"), value))
    handle = signal == "profile_handle"
    seen = F.array_compact(F.array(tag(accepted & handle, "handle", platform), tag(tried & handle, "handle?", platform), tag(accepted & labelled, "host", site), tag(tried & labelled, "host?", site), tag(accepted & labelled, "reviewer", F.col("reviewer_id")), tag(tried & labelled, "reviewer?", F.col("reviewer_id"))))
    number = lambda c: c.cast("long")
    return own.select("organisation_number", F.coalesce(F.nullif("strategy", F.lit("")), F.lit(DEFAULT)).alias("strategy"), number(accepted).alias("accepted"), number(tried).alias("experimental"), flags.alias("flags"), number(accepted & labelled).alias("felt"), number(tried & labelled).alias("tried"), seen.alias("seen"), *keep)


def by_strategy(marked: DataFrame) -> DataFrame:
    """``marks`` summed per company and strategy; of ``seen`` values ten of a kind, which decide every rule that more would."""
    keys = ["organisation_number", "strategy"]
    sums = marked.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in ("accepted", "experimental", "felt", "tried")), F.bit_or("flags").alias("flags"))
    values = marked.select(*keys, F.explode("seen").alias("value")).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys, F.substring_index("value", ":", 1)).orderBy("value"))
    few = values.withColumn("nth", nth).where(F.col("nth") <= MOST).groupBy(*keys).agg(F.collect_list("value").alias("seen"))
    return sums.join(few, keys, "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))


def plan(prior: DataFrame, most: int | None = None) -> list[dict]:
    """The steps that ``prior(strategy, learning_gain, score_delta)`` gives: strategy, and its runs, successes and mean gain before."""
    gain = F.coalesce(F.nullif("learning_gain", F.lit(0.0)), F.nullif("score_delta", F.lit(0.0)), F.lit(0.0))
    known = prior.where(F.col("strategy").isin(*STRATEGIES)).groupBy("strategy").agg(F.count("*").alias("n"), F.avg(gain).alias("mean"), F.count_if(gain > 0).alias("good"))
    of = {r["strategy"]: r for r in known.collect()}  # at most one row per strategy
    left, total, steps = list(STRATEGIES), prior.count(), []
    for number in range(1, min(most if most is not None else len(left), len(left)) + 1):
        spread = math.log(max(1, total + number - 1) + 1)
        worth = lambda s: (of[s]["mean"] if s in of else 0.0) + 0.35 * math.sqrt(spread / ((of[s]["n"] if s in of else 0) + 1))  # noqa: B023, E731
        best = max(left, key=lambda s: (worth(s), -STRATEGIES.index(s)))
        left.remove(best)
        had = of.get(best)
        steps.append({"iteration": number, "strategy": best, "prior_runs": had["n"] if had else 0, "prior_successes": had["good"] if had else 0, "prior_mean_learning_gain": round(had["mean"], 3) if had else 0.0})
    return steps


def _score(side: str, site_ok: Column) -> Column:
    """A score from running sums; ``side`` is accepted, or both for what it could be with experimental evidence."""
    both = side == "both"
    sides = ("accepted", "experimental") if both else ("accepted",)
    bit = lambda part: F.col("flags").bitwiseAND(F.lit(sum(_BITS[f"{s}.{part}"] for s in sides))) != 0
    kinds = lambda name, also: F.size(F.array_distinct(F.transform(F.filter("seen", lambda v: v.startswith(name + ":") | (v.startswith(name + "?:") if also else F.lit(False))), lambda v: F.substring_index(v, ":", -1))))
    count = lambda name: F.size(F.filter("seen", lambda v: v.startswith(name + ":")))
    points = lambda on, n: F.when(on, n).otherwise(0.0)
    some = F.col("accepted") > 0
    ready = (F.col("felt") >= ITEMS) & ((count("host") >= HOSTS) | (count("reviewer") >= REVIEWERS))
    if both:
        more = (F.col("tried") >= ITEMS) & ((count("host?") >= HOSTS) | (count("reviewer?") >= REVIEWERS))
        ready = ready | more | (F.col("flags").bitwiseAND(F.lit(_BITS["experimental.summary"])) != 0)
    total = points((site_ok | bit("identity")) & (some | (F.col("experimental") > 0) if both else some), IDENTITY)
    total = total + F.least(F.lit(HANDLES), HANDLE * kinds("handle", both)) + points(ready, SENTIMENT) + points(some, FRESH)
    for part, (worth, _) in POINTS.items():
        total = total + points(bit(part), worth)
    return F.round(total, 3)


def control_loop(companies: DataFrame, marked: DataFrame, steps: list[dict]) -> DataFrame:
    """A row per company of ``companies(organisation_number, site_ok)`` and step: what became visible, scores, gain and verdict."""
    kinds = "array<struct<iteration:int,strategy:string,prior_runs:long,prior_successes:long,prior_mean_learning_gain:double>>"
    made = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in step.items())) for step in steps)).cast(kinds)
    rows = companies.select("organisation_number", F.coalesce("site_ok", F.lit(False)).alias("site_ok"), F.inline(made))
    held = rows.join(by_strategy(marked), ["organisation_number", "strategy"], "left")
    turns = Window.partitionBy("organisation_number").orderBy("iteration")
    so_far = turns.rowsBetween(Window.unboundedPreceding, 0)
    new = F.coalesce("n", F.lit(0)).alias("new_observations")
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).over(so_far).alias(c) for c in ("accepted", "experimental", "felt", "tried")]
    seen = F.array_distinct(F.flatten(F.collect_list(F.coalesce("seen", F.array().cast("array<string>"))).over(so_far)))
    flags = F.bit_or(F.coalesce("flags", F.lit(0).cast("long"))).over(so_far)
    run = held.select("organisation_number", "site_ok", "iteration", "strategy", "prior_runs", "prior_successes", "prior_mean_learning_gain", new, *sums, seen.alias("seen"), flags.alias("flags"))
    run = run.withColumns({"score_after": _score("accepted", F.col("site_ok")), "potential_after": _score("both", F.col("site_ok"))})
    before = lambda c: F.coalesce(F.lag(c).over(turns), F.lit(0.0))
    run = run.withColumns({"score_before": before("score_after"), "score_delta": F.round(F.col("score_after") - before("score_after"), 3), "potential_delta": F.round(F.col("potential_after") - before("potential_after"), 3)})
    gain = F.round(F.col("score_delta") + F.greatest(F.lit(0.0), F.col("potential_delta") - F.col("score_delta")) * 0.25, 3)
    verdict = F.when(F.col("score_delta") > 0, "reinforce_publishable").when(F.col("potential_delta") > 0, "reinforce_experimental").when(F.col("new_observations") > 0, "hold").otherwise("blocked_no_input")
    action = F.when(F.col("prior_mean_learning_gain") > 0, "replicate").otherwise("explore")
    run = run.withColumns({"learning_gain": gain, "result": verdict, "controller_action": action})
    return run.select(*ITERATION)


ITERATION = ("organisation_number", "iteration", "strategy", "controller_action", "prior_runs", "prior_successes", "prior_mean_learning_gain", "new_observations", "score_before", "score_after", "score_delta", "potential_after", "potential_delta", "learning_gain", "result")


def summary(iterations: DataFrame, target: float = 80.0) -> DataFrame:
    """Per company the number of steps, the last score and potential, and whether the target is met."""
    last = lambda c: F.max_by(c, "iteration")
    own = iterations.groupBy("organisation_number").agg(F.count("*").alias("iterations_run"), last("score_after").alias("final_score"), last("potential_after").alias("final_potential"))
    return own.withColumn("target_reached", F.col("final_score") >= target)


# --- bindings -----------------------------------------------------------------------------------------------------------

_EXTRA = {
    "strategy": f"case when seq % 20 = 18 then null when seq % 20 = 19 then 'strategy_of_another_list' else element_at(array({', '.join(repr(s) for s in STRATEGIES)}), cast(seq % 20 + 1 as int)) end",
    "rating": "cast(seq % 6 as double)", "review_count": "cast(seq % 15 as bigint)",
    "signal_type": "case when seq % 31 = 0 then 'profile_handle' when seq % 37 = 0 then 'review_summary' when seq % 41 = 0 then 'place_summary' when seq % 43 = 0 then 'company_profile' else signal_type end",
    "platform": "case when seq % 47 = 0 then 'wikidata' when seq % 53 = 0 then 'company_directory' when seq % 31 = 0 then element_at(array('facebook', 'x', 'youtube', 'linkedin'), cast(seq % 4 + 1 as int)) else platform end",
}


def control_observations(s, d):
    """Observations with strategies, ratings and some more signals and platforms."""
    return bind(s, d, "observations").withColumns({c: F.expr(e) for c, e in _EXTRA.items()})


def control_companies(s, d):
    site_ok = F.col("organisation_number").cast("bigint") % 3 == 0
    return bind(s, d, "observations").select("organisation_number").distinct().withColumn("site_ok", site_ok)


def _iterations(s, d):
    return control_loop(control_companies(s, d), marks(control_observations(s, d)), plan(bind(s, d, "iterations")))


def _has(side: str, rule: str) -> str:
    return f"count(*) filter (where {side} and ({rule})) > 0"


def _sql_score(both: bool) -> str:
    """The score of all rows that are visible, as SQL."""
    side = "(ok or tried)" if both else "ok"
    felt = lambda c: f"count(*) filter (where {c} and felt) >= {ITEMS} and (count(distinct h) filter (where {c} and felt) >= {HOSTS} or count(distinct reviewer_id) filter (where {c} and felt and reviewer_id <> '') >= {REVIEWERS})"
    place = "platform = 'google_places' and signal_type = 'place_summary'"
    known = _has("ok", f"{place} or platform = 'wikidata' and signal_type = 'company_profile'")
    ready = felt("ok")
    if both:
        known = f"{known} or {_has('tried', place + " or platform = 'company_directory' and signal_type = 'company_profile'")}"
        ready = f"{ready} or {felt('tried')} or {_has('tried', f"signal_type = 'review_summary' and review_count >= {RATINGS} and rating > 0 and rating <= 5")}"
    parts = [f"case when (any_value(site_ok) or {known}) and count(*) filter (where {side}) > 0 then {IDENTITY} else 0 end", f"least({HANDLES}, {HANDLE} * count(distinct platform) filter (where {side} and signal_type = 'profile_handle'))"]
    parts += [f"case when {ready} then {SENTIMENT} else 0 end", f"case when count(*) filter (where ok) > 0 then {FRESH} else 0 end"]
    parts += [f"case when {_has(side, f"signal_type in ({', '.join(map(repr, signals))})")} then {worth} else 0 end" for worth, signals in POINTS.values()]
    return f"cast({' + '.join(parts)} as double)"


def _sql() -> str:
    extra = {c: e.replace("element_at(array(", "list_extract(list_value(") for c, e in _EXTRA.items()}
    changed = ", ".join(f"{extra[c]} as {c}" for c in ("signal_type", "platform"))
    added = ", ".join(f"{extra[c]} as {c}" for c in ("strategy", "rating", "review_count"))
    strategies = ", ".join(f"('{s}', {i})" for i, s in enumerate(STRATEGIES))
    return f"""{ctes("observations", "iterations").replace("with ", "with recursive ", 1)},
 o as (select * replace ({changed}), {added} from observations),
 v as (select *, {_REASONS_SQL} as reasons from o),
 w as (select organisation_number, coalesce(strategy, '{DEFAULT}') as strategy, platform, signal_type, rating, review_count, reviewer_id, regexp_extract(source_url, '://([^/]+)', 1) as h, len(reasons) = 0 as ok, sentiment_label is not null as felt,
  coalesce(acquisition_mode in {EXPERIMENTAL_MODES} and exact_entity and identity_proof_count > 0 and content_sha256 is not null, false) as tried from v),
 st(strategy, ix) as (values {strategies}),
 g as (select strategy, coalesce(nullif(learning_gain, 0), nullif(score_delta, 0), 0) as gain from iterations),
 pr as (select st.strategy, ix, count(gain) as n, coalesce(avg(gain), 0) as mean, count(*) filter (where gain > 0) as good from st left join g on g.strategy = st.strategy group by all),
 total as (select count(*) as t from iterations),
 turn(k, taken) as (select 0, cast([] as varchar[]) union all
  select k + 1, list_append(any_value(taken), arg_max(strategy, mean + 0.35 * sqrt(ln(greatest(1, t + k) + 1) / (n + 1)) - ix * 1e-12)) from turn, pr, total where not list_contains(taken, strategy) group by k),
 steps as (select unnest(taken) as strategy, unnest(range(1, len(taken) + 1)) as iteration from turn where k = {len(STRATEGIES)}),
 grid as (select organisation_number, cast(organisation_number as bigint) % 3 = 0 as site_ok, s.* from (select distinct organisation_number from observations), steps s),
 seen as (select grid.organisation_number as org, grid.iteration as it, grid.strategy as turn_of, grid.site_ok, w.*, case when w.organisation_number is null then false else true end as there
  from grid left join (select w.*, steps.iteration as at from w join steps on steps.strategy = w.strategy) w on w.organisation_number = grid.organisation_number and w.at <= grid.iteration),
 sc as (select org as organisation_number, it as iteration, turn_of as strategy, count(*) filter (where there and strategy = turn_of) as new_observations, {_sql_score(False)} as score_after, {_sql_score(True)} as potential_after from seen group by org, it, turn_of),
 d as (select *, lag(score_after, 1, 0) over (partition by organisation_number order by iteration) as score_before, lag(potential_after, 1, 0) over (partition by organisation_number order by iteration) as potential_before from sc),
 e as (select *, score_after - score_before as score_delta, potential_after - potential_before as potential_delta from d),
 it as (select organisation_number, cast(iteration as int) as iteration, e.strategy, case when round(mean, 3) > 0 then 'replicate' else 'explore' end as controller_action, n as prior_runs, good as prior_successes, round(mean, 3) as prior_mean_learning_gain,
  new_observations, score_before, score_after, score_delta, potential_after, potential_delta, round(score_delta + greatest(0, potential_delta - score_delta) * 0.25, 3) as learning_gain,
  case when score_delta > 0 then 'reinforce_publishable' when potential_delta > 0 then 'reinforce_experimental' when new_observations > 0 then 'hold' else 'blocked_no_input' end as result from e join pr on pr.strategy = e.strategy)"""


QUERIES = {
    "control_iterations": (_iterations, f"{_sql()} select * from it"),
    "control_summary": (lambda s, d: summary(_iterations(s, d), 40.0), f"{_sql()} select organisation_number, count(*) as iterations_run, max_by(score_after, iteration) as final_score, max_by(potential_after, iteration) as final_potential, max_by(score_after, iteration) >= 40 as target_reached from it group by 1"),
}
