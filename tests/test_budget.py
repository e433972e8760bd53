"""Reserved and executed spend apart; headroom for optional work; failures and run time."""

from dossier.operators.budget import Limits, ledger

SCHEMA = "run string, seq long, kind string, requests int, cost double, elapsed double, optional boolean"


def _run(spark, limits, *entries):
    rows = [("r", i, kind, *(rest + (0, 0.0, 0.0, True)[len(rest) :])) for i, (kind, *rest) in enumerate([(k, *v) for k, *v in entries]) for rest in [tuple(rest)]]
    row = ledger(spark.createDataFrame(rows, SCHEMA), limits).first()
    return row, [v["accepted"] for v in row["verdicts"]]


def test_reservations_are_no_spend(spark):
    row, said = _run(spark, Limits(requests=10), ("reserve", 8), ("reserve", 2), ("commit", 8), ("reserve", 1), ("commit", 2), ("commit", 1), ("record", 5))
    assert said == [True, False, True, False, True, False, True]
    assert (row["requests"], row["planned_requests"], row["degraded"]) == (15, 8, True)


def test_headroom_stops_optional_work_only(spark):
    row, said = _run(spark, Limits(cost=1.0), ("spend", 1, 0.9), ("spend", 1, 0.000001), ("spend", 1, 0.05, 0.0, False), ("commit", 0, 0.05), ("commit", 0, 0.000001))
    assert said == [True, False, True, True, False] and row["cost"] == 1.0 and row["requests"] == 2


def test_failures_and_time(spark):
    _, said = _run(spark, Limits(failures=2), ("fail",), ("spend", 1), ("fail",), ("spend", 1), ("record", 1))
    assert said == [True, True, True, False, True]
    _, said = _run(spark, Limits(seconds=100.0), ("spend", 1, 0.0, 90.0), ("spend", 1, 0.0, 90.5), ("spend", 1, 0.0, 100.0, False), ("commit", 1, 0.0, 100.5))
    assert said == [True, False, True, False]
    row, said = _run(spark, Limits(), ("reserve", 10**6, 10.0**6), ("commit", 10**6, 10.0**6))
    assert said == [True, True] and not row["degraded"]
