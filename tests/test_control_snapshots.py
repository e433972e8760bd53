"""The control loop, batch and stream, and the snapshot data source."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from dossier.operators import control
from dossier.operators.scoring import STRATEGIES
from dossier.sources import snapshots
from dossier.streaming import control as stream

DATA = "/root/testdata/sf0.001"
PRIOR = "strategy string, learning_gain double, score_delta double"


@pytest.fixture(scope="module")
def observations(spark):
    when = F.timestamp_seconds(F.lit(1_780_000_000) + F.col("seq") % 500)
    return control.control_observations(spark, DATA).withColumn("site_ok", F.col("organisation_number").cast("bigint") % 3 == 0).withColumn("event_time", when)


def test_plan_follows_earlier_gains(spark):
    prior = spark.createDataFrame([("youtube_channel_feed", 8.0, None), ("verified_handle_extraction", 0.0, 2.0), ("of another list", 99.0, None)], PRIOR)
    steps = control.plan(prior)
    assert [s["strategy"] for s in steps[:2]] == ["youtube_channel_feed", "verified_handle_extraction"] and len(steps) == len(STRATEGIES)
    assert steps[0]["prior_runs"] == 1 and steps[0]["prior_successes"] == 1 and steps[0]["prior_mean_learning_gain"] == 8.0
    assert [s["strategy"] for s in control.plan(prior.limit(0))] == list(STRATEGIES)
    assert len(control.plan(prior, 2)) == 2


def test_final_score_does_not_depend_on_the_order(spark, observations):
    """Other priors give other orders and the same end; target and companies without observations change nothing."""
    companies = control.control_companies(spark, DATA).union(spark.createDataFrame([("1", True)], "o string, s boolean"))
    marked = control.marks(observations)
    ends = []
    for prior in ([], [("buzz_peer_normalization", 5.0, 0.0), ("jobs_feed_discovery", 1.0, 0.0)]):
        rows = control.control_loop(companies, marked, control.plan(spark.createDataFrame(prior, PRIOR)))
        ends.append({r["organisation_number"]: (r["final_score"], r["final_potential"], r["iterations_run"]) for r in control.summary(rows).collect()})
    assert ends[0] == ends[1] and ends[0]["1"] == (0.0, 0.0, 18) and any(score > 20 for score, *_ in ends[0].values())


def test_stream_equals_batch(spark, observations, tmp_path):
    """Observations in three files, then silence: the state gives what the batch operator gives."""
    steps = control.plan(spark.createDataFrame([("places_rating_reviews", 3.0, None)], PRIOR))
    want = control.control_loop(control.control_companies(spark, DATA), control.marks(observations), steps)
    source = str(tmp_path / "in")
    later = observations.limit(1).withColumns({"organisation_number": F.lit("999999999"), "event_time": F.timestamp_seconds(F.lit(1_790_000_000))})
    parts = [observations.where(F.col("seq") % 3 == i) for i in range(3)] + [later, later.withColumn("event_time", F.timestamp_seconds(F.lit(1_790_000_001)))]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        rows = stream.control_stream(spark.readStream.schema(observations.schema).parquet(source), steps)
        query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    norm = lambda df: sorted(tuple(r[c] for c in control.ITERATION) for r in df.collect())
    assert norm(got) == norm(want)


ROWS = [("u1", 200, 5, '{ "a": 1 }', None, "2026-01-05", None, 2), ("u1", 500, 1, "{}", None, None, None, 3), ("u2", None, None, None, '{"b":1,"a":"\\u00e9"}', None, None, 1), ("u3", 404, 7, None, None, None, "2025", 1), ("u4", 200, 0, "", None, None, None, 1)]
RESPONSES = "url string, status int, elapsed_ms int, raw_json string, body string, retrieved_at string, effective_at string, seq int"


def test_snapshot_source(spark, tmp_path):
    folder = str(tmp_path / "snap")
    snapshots.save(spark.createDataFrame(ROWS, RESPONSES), folder, "seq", "2026-01-02", "2026-01-01")
    again = [("u1", 200, 0, "later", None, None, None, 1), ("u5", 200, 0, '{ "a": 1 }', None, None, None, 1)]
    snapshots.save(spark.createDataFrame(again, RESPONSES), folder, "seq", "of no effect", None)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    canonical = '{"a":"é","b":1}'
    want = {
        "u1": (200, 5, 10, '{ "a": 1 }', None, sha('{ "a": 1 }'), "2026-01-05", "2026-01-01"), "u2": (200, 0, len(canonical.encode()), canonical, None, sha(canonical), "2026-01-02", "2026-01-01"),
        "u3": (404, 7, 4, None, "HTTP 404", sha("null"), "2026-01-02", "2025"), "u4": (200, 0, 0, "", None, sha(""), "2026-01-02", "2026-01-01"),
        "u5": (200, 0, 10, '{ "a": 1 }', None, sha('{ "a": 1 }'), "2026-01-02", "2026-01-01"),
    }
    rows = lambda df: {r["url"]: tuple(r[c] for c in snapshots.COLUMNS[1:]) for r in df.collect()}
    loaded = snapshots.load(spark, folder)
    assert rows(loaded) == want
    missing = (0, 0, 0, None, snapshots.MISSING, None, "2026-01-02", "2026-01-01")
    assert rows(snapshots.replay(spark.createDataFrame([("u3",), ("nope",)], "url string"), folder)) == {"u3": want["u3"], "nope": missing}
    assert rows(loaded.where(F.col("url").isin("u2", "nope"))) == {"u2": want["u2"], "nope": missing}
    assert rows(loaded.where("url = 'u1' and status = 200")) == {"u1": want["u1"]} and rows(loaded.where("url = 'u1' and url = 'u2'")) == {}
    bodies = [os.path.join(d, f) for d, _, files in os.walk(os.path.join(folder, "bodies")) for f in files]
    assert len(bodies) == 4  # u1 and u5 share theirs


def test_snapshot_reads_only_what_is_asked_for(tmp_path):
    folder = snapshots.Folder(str(tmp_path))
    for i in range(50):
        folder.add({"url": f"u{i}", "status": 200, "elapsed_ms": 1, "raw_json": f"{i}", "body": None, "retrieved_at": None, "effective_at": None})
    reader = snapshots._Reader(str(tmp_path))
    rest = list(reader.pushFilters([snapshots.EqualTo(("status",), 200), snapshots.In(("url",), ("u1", "u7"))]))
    assert rest == [snapshots.EqualTo(("status",), 200)]
    parts = reader.partitions()
    assert sorted(u for p in parts for u in p.urls) == ["u1", "u7"]
    assert sum(len(p.urls or ()) for p in parts) == 2 and snapshots._Reader(str(tmp_path)).partitions()[0].urls is None
    body = next(p for p in (tmp_path / "bodies").rglob("*") if p.is_file() and p.read_bytes() == b"7")
    body.chmod(0o644)
    body.write_bytes(b"tampered")
    row = folder.row("u7", {})
    assert row[1] == 200 and row[4] is None and row[5] == "content differs from its hash"
    assert json.loads(next((tmp_path / "urls").rglob("*.json")).read_text())["status"] == 200
    assert not list(tmp_path.rglob("*.tmp")) and snapshots._Reader(str(tmp_path / "none")).partitions() == []
