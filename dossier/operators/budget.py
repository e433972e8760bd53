"""The ledger of a run's budget: reserved and executed spend apart, hard limits, headroom for optional work, failures, run time.

A run's entries are folded in order, since each verdict depends on those before it; costs are whole millionths, so that sums
are exact. Reservations are held against executed and reserved spend together and never count as spent; commits and spending
are held against executed spend alone; what is recorded has happened already and is never refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind

MICRO = 1_000_000


@dataclass
class Limits:
    """Hard limits, None for none, and the part of each at which optional work stops."""

    requests: int | None = None
    cost: float | None = None
    seconds: float | None = None
    failures: int | None = None
    headroom: float = 0.9


_STATE = "struct<requests:bigint,micro:bigint,planned_requests:bigint,planned_micro:bigint,failures:bigint,degraded:boolean,verdicts:array<struct<seq:bigint,accepted:boolean>>>"


def _over(limits: Limits, share: float, requests: Column, micro: Column, elapsed: Column) -> Column:
    checks = [F.lit(False)]
    if limits.requests is not None:
        checks.append(requests > limits.requests * share)
    if limits.cost is not None:
        checks.append(micro > round(limits.cost * share * MICRO))
    if limits.seconds is not None:
        checks.append(elapsed > limits.seconds * share)
    over = checks[0]
    for check in checks[1:]:
        over = over | check
    return over


def ledger(entries: DataFrame, limits: Limits) -> DataFrame:
    """(run, requests, cost, planned_requests, planned_cost, failures, degraded, verdicts) of ``entries(run, seq, kind, requests, cost,
    elapsed, optional)``; kind is reserve, commit, spend, record or fail. ``verdicts`` are (seq, accepted) in order of seq.

    An entry that is refused changes nothing but ``degraded``. A run's entries are one row's array: they are the tasks of one
    batch of companies, thousands at most.
    """
    own = entries.select("run", F.struct("seq", "kind", F.coalesce("requests", F.lit(0)).cast("long").alias("requests"), F.round(F.coalesce("cost", F.lit(0.0)) * MICRO).cast("long").alias("micro"), F.col("elapsed").cast("double").alias("elapsed"), F.coalesce("optional", F.lit(True)).alias("optional")).alias("e"))

    def step(a: Column, e: Column) -> Column:
        reserve = e["kind"] == "reserve"
        requests = a["requests"] + F.when(reserve, a["planned_requests"]).otherwise(0) + e["requests"]
        micro = a["micro"] + F.when(reserve, a["planned_micro"]).otherwise(0) + e["micro"]
        failed = F.lit(False) if limits.failures is None else a["failures"] >= limits.failures
        hard = failed | _over(limits, 1.0, requests, micro, e["elapsed"])
        soft = (e["kind"] != "commit") & e["optional"] & _over(limits, limits.headroom, requests, micro, e["elapsed"])
        asks = e["kind"].isin("reserve", "commit", "spend")
        ok = ~asks | ~(hard | soft)
        add = lambda name, by, when: (a[name] + F.when(ok & when, by).otherwise(0)).alias(name)
        spent = e["kind"].isin("commit", "spend", "record")
        return F.struct(
            add("requests", e["requests"], spent), add("micro", e["micro"], spent), add("planned_requests", e["requests"], reserve), add("planned_micro", e["micro"], reserve), add("failures", F.lit(1), e["kind"] == "fail"),
            (a["degraded"] | ~ok).alias("degraded"), F.array_append(a["verdicts"], F.struct(e["seq"].cast("long").alias("seq"), ok.alias("accepted"))).alias("verdicts"),
        ).cast(_STATE)

    zero = F.from_json(F.lit('{"requests":0,"micro":0,"planned_requests":0,"planned_micro":0,"failures":0,"degraded":false,"verdicts":[]}'), _STATE)
    folded = own.groupBy("run").agg(F.aggregate(F.array_sort(F.collect_list("e")), zero, step).alias("s"))
    cost = lambda name: F.round(F.col(f"s.{name}") / MICRO, 6)
    return folded.select("run", "s.requests", cost("micro").alias("cost"), "s.planned_requests", cost("planned_micro").alias("planned_cost"), "s.failures", "s.degraded", "s.verdicts")


LIMITS = Limits(requests=60, cost=0.9, seconds=150.0, failures=6, headroom=0.8)
_KIND = "case event_id % 7 when 0 then 'commit' when 1 then 'spend' when 2 then 'record' when 3 then 'fail' else 'reserve' end"


def _entries(s, d):
    nth = F.expr("row_number() over (partition by user_id order by event_id)")
    own = bind(s, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), F.expr(_KIND).alias("kind"), (F.col("event_id") % 4).alias("requests"), (F.col("event_id") % 50 / 1000).alias("cost"), (nth * 1.5).alias("elapsed"), (F.col("event_id") % 3 != 0).alias("optional"))
    return own


def _ledgers(s, d):
    found = ledger(_entries(s, d), LIMITS)
    return found.withColumns({"refused": F.size(F.filter("verdicts", lambda v: ~v["accepted"])), "first_refused": F.array_min(F.transform(F.filter("verdicts", lambda v: ~v["accepted"]), lambda v: v["seq"]))}).drop("verdicts")


_SQL = f"""with recursive t as (select user_id as run, event_id as seq, {_KIND} as kind, event_id % 4 as requests, cast(event_id % 50 * 1000 as bigint) as micro, event_id % 3 <> 0 as optional, row_number() over (partition by user_id order by event_id) as k from events),
 g as (select run, cast(0 as bigint) as k, cast(0 as bigint) as er, cast(0 as bigint) as em, cast(0 as bigint) as pr, cast(0 as bigint) as pm, cast(0 as bigint) as f, cast(0 as bigint) as refused, cast(null as bigint) as first_refused from (select distinct run from t)
 union all select run, k, er + case when ok and kind in ('commit', 'spend', 'record') then requests else 0 end, em + case when ok and kind in ('commit', 'spend', 'record') then micro else 0 end, pr + case when ok and kind = 'reserve' then requests else 0 end, pm + case when ok and kind = 'reserve' then micro else 0 end,
  f + cast(kind = 'fail' as int), refused + cast(not ok as int), coalesce(first_refused, case when not ok then seq end)
 from (select *, kind not in ('reserve', 'commit', 'spend') or not (f >= {LIMITS.failures} or q > {LIMITS.requests} or m > 900000 or k * 1.5 > 150 or kind <> 'commit' and optional and (q > 48 or m > 720000 or k * 1.5 > 120)) as ok
  from (select t.*, g.er, g.em, g.pr, g.pm, g.f, g.refused, g.first_refused, er + case when kind = 'reserve' then pr else 0 end + requests as q, em + case when kind = 'reserve' then pm else 0 end + micro as m from g join t on t.run = g.run and t.k = g.k + 1) x) y)
 select run, er as requests, round(em / 1000000.0::double, 6) as cost, pr as planned_requests, round(pm / 1000000.0::double, 6) as planned_cost, f as failures, refused > 0 as degraded, cast(refused as int) as refused, first_refused from g qualify row_number() over (partition by run order by k desc) = 1"""
QUERIES = {"budget_ledger": (_ledgers, _SQL)}
