"""The control loop over a stream of observations: state per company, read out by an event-time timer (STM-05, UDF-01).

A company's state is what ``by_strategy`` has of it: sums, flag bits, and at most ten values of a kind per strategy, however
many observations came. Every arrival moves the company's timer to ``quiet`` after its newest observation; when the watermark
passes the timer, the iterations of the batch operator come out, once for each time that a company fell quiet.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dossier.operators import control
from dossier.work import workers_see_us

OUTPUT = (
    "organisation_number string, iteration int, strategy string, controller_action string, prior_runs long, prior_successes long, prior_mean_learning_gain double, "
    "new_observations long, score_before double, score_after double, score_delta double, potential_after double, potential_delta double, learning_gain double, result string"
)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SUMS = ("n", "accepted", "experimental", "felt", "tried")


def _limited(seen: set[str]) -> list[str]:
    """At most ten values of a kind, the least ones."""
    kinds: dict[str, list[str]] = {}
    for value in sorted(seen):
        kinds.setdefault(value.split(":", 1)[0], []).append(value)
    return [v for values in kinds.values() for v in values[: control.MOST]]


def merged(state: dict | None, more: dict) -> dict:
    """Two parts of a strategy's state as one; the order of parts makes no difference."""
    if state is None:
        return {**{k: int(more[k]) for k in _SUMS}, "flags": int(more["flags"]), "seen": _limited(set(more["seen"]))}
    return {**{k: state[k] + int(more[k]) for k in _SUMS}, "flags": state["flags"] | int(more["flags"]), "seen": _limited({*state["seen"], *more["seen"]})}


def _score(run: dict, site_ok: bool, both: bool) -> float:
    sides = ("accepted", "experimental") if both else ("accepted",)
    bit = lambda part: any(run["flags"] & control._BITS[f"{s}.{part}"] for s in sides)
    of = lambda kind: {v.split(":", 1)[1] for v in run["seen"] if v.split(":", 1)[0] == kind}
    enough = lambda items, mark: run[items] >= control.ITEMS and (len(of("host" + mark)) >= control.HOSTS or len(of("reviewer" + mark)) >= control.REVIEWERS)
    ready = enough("felt", "") or both and (enough("tried", "?") or bool(run["flags"] & control._BITS["experimental.summary"]))
    some = run["accepted"] > 0
    total = control.IDENTITY * ((site_ok or bit("identity")) and (some or both and run["experimental"] > 0))
    total += min(control.HANDLES, control.HANDLE * len(of("handle") | (of("handle?") if both else set()))) + control.SENTIMENT * ready + control.FRESH * some
    return round(total + sum(worth * bit(part) for part, (worth, _) in control.POINTS.items()), 3)


def iterations(company: str, site_ok: bool, held: dict[str, dict], steps: list[dict]) -> list[tuple]:
    """Rows of one company as ``control.control_loop`` makes them, from its state by strategy."""
    run: dict = {**dict.fromkeys(_SUMS, 0), "flags": 0, "seen": []}
    before = potential_before = 0.0
    rows = []
    for step in steps:
        new = held.get(step["strategy"])
        if new:
            run = {**{k: run[k] + new[k] for k in _SUMS}, "flags": run["flags"] | new["flags"], "seen": [*run["seen"], *new["seen"]]}
        after, potential = _score(run, site_ok, False), _score(run, site_ok, True)
        delta, more = round(after - before, 3), round(potential - potential_before, 3)
        result = "reinforce_publishable" if delta > 0 else "reinforce_experimental" if more > 0 else "hold" if new else "blocked_no_input"
        action = "replicate" if step["prior_mean_learning_gain"] > 0 else "explore"
        rows.append((company, step["iteration"], step["strategy"], action, step["prior_runs"], step["prior_successes"], step["prior_mean_learning_gain"], new["n"] if new else 0, before, after, delta, potential, more, round(delta + max(0.0, more - delta) * 0.25, 3), result))
        before, potential_before = after, potential
    return rows


class CompanyControl(StatefulProcessor):
    """State: strategy -> its sums as JSON; whether the company's site is its own; the timer that is set."""

    def __init__(self, steps: list[dict], quiet_ms: int):
        self.steps, self.quiet_ms = steps, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "strategy string", "part string")
        self.company = handle.getValueState("company", "site_ok boolean, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        known = self.company.get() if self.company.exists() else (False, 0)
        site_ok, due = bool(known[0]), int(known[1])
        newest = 0
        for frame in rows:
            site_ok = site_ok or bool(frame["site_ok"].any())
            newest = max(newest, int(frame["event_time"].max().timestamp() * 1000))
            for strategy, part in frame.groupby("strategy"):
                more = {**{k: part[k].sum() for k in _SUMS if k != "n"}, "n": len(part), "flags": 0, "seen": {v for seen in part["seen"] for v in seen}}
                for flags in part["flags"]:
                    more["flags"] |= int(flags)
                old = json.loads(self.held.getValue((strategy,))[0]) if self.held.containsKey((strategy,)) else None
                self.held.updateValue((strategy,), (json.dumps(merged(old, more)),))
        later = max(due, newest + self.quiet_ms)
        if due and later != due:
            self.handle.deleteTimer(due)
        if later != due:
            self.handle.registerTimer(later)
        self.company.update((site_ok, later))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        site_ok, due = self.company.get()
        held = {k[0]: json.loads(v[0]) for k, v in self.held.iterator()}
        self.company.update((site_ok, 0))
        yield pd.DataFrame(iterations(key[0], bool(site_ok), held, self.steps), columns=[c.strip().split(" ")[0] for c in OUTPUT.split(",")])

    def close(self) -> None:
        pass


def control_stream(observations: DataFrame, steps: list[dict], quiet: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Iterations of companies of a stream ``observations`` (columns of ``control.marks``, event_time, site_ok) that were quiet.

    A row later than ``late`` behind the newest is dropped, as Spark's watermark does. Needs the RocksDB state store.
    """
    import pandas as pd

    spark = observations.sparkSession
    workers_see_us(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    marked = control.marks(observations.withWatermark("event_time", late), keep=("event_time", "site_ok"))
    made = CompanyControl(steps, int(pd.Timedelta(quiet).total_seconds() * 1000))
    return marked.groupBy("organisation_number").transformWithStateInPandas(made, OUTPUT, "Append", "EventTime")
