"""Suffix rules, checkpoints of running batches, terminal events of finished crawls."""

import os

from pyspark.sql import functions as F

from dossier.operators import domains
from dossier.streaming import checkpoints

SCHEMA = "organisation_number string, seq long, value int"


def test_registered_domains(spark):
    want = {
        "www.example.no": "example.no", "EXAMPLE.no": "example.no", "no": "", "a.b.co.uk": "b.co.uk", "co.uk": "", "x.ck": "", "y.x.ck": "y.x.ck", "a.www.ck": "www.ck", "www.ck": "www.ck", "a.city.kawasaki.jp": "city.kawasaki.jp", "b.a.kawasaki.jp": "b.a.kawasaki.jp", "kawasaki.jp": "kawasaki.jp",
        "deep.name.example": "name.example", "localhost": "", "10.0.0.1": "", "[::1]": "", "": "", "a..no": "", ".no": "", "me.github.io": "me.github.io", "github.io": "",
    }
    rules = spark.createDataFrame([(r,) for r in domains.RULES], "rule string")
    hosts = spark.createDataFrame([(h, i) for i, h in enumerate([*want, "www.example.no", None])], "host string, i int")
    got = domains.registered_domains(hosts, rules).collect()
    assert len(got) == len(want) + 2 and all(r["domain"] == want.get(r["host"], "") for r in got)
    assert {r["domain"] for r in domains.registered_domains(hosts.where("i < 2"), rules.limit(0)).collect()} == {"example.no"}


def _rows(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def _content(path):
    return {os.path.relpath(d, path) for d, _, files in os.walk(path) if "_SUCCESS" in files}


def test_checkpoints_repeat_and_break(spark, tmp_path):
    path = str(tmp_path / "out")
    read = lambda: [tuple(r) for r in checkpoints.read(spark, path, SCHEMA).collect()]
    assert read() == [] and checkpoints.versions(spark, path) == (-1, [])
    checkpoints.write_batch(_rows(spark, ("b", 2, 1), ("a", 1, 1)), 0, path, 2)
    for _ in range(2):  # a repeated batch
        checkpoints.write_batch(_rows(spark, ("a", 1, 2), ("c", 3, 1)), 1, path, 2)
    want = [("a", 1, 2), ("b", 2, 1), ("c", 3, 1)]
    assert read() == want and checkpoints.versions(spark, path) == (1, [])
    broken = tmp_path / "out" / "batch=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half a file")  # a run that ended in the middle
    assert read() == want
    checkpoints.write_batch(_rows(spark, ("d", 0, 1)), 2, path, 2)
    assert read() == [("d", 0, 1), *want] and checkpoints.versions(spark, path) == (1, [2])
    assert _content(path) == {"batch=0", "batch=1", "state=1", "batch=2"}


def test_checkpoints_of_a_stream_equal_one_run(spark, tmp_path):
    source, ck, path = str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    parts = [[(str(i), i, p) for i in range(9) if i % 3 <= p] for p in range(3)]
    for part in parts:
        _rows(spark, *part).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # the second start finds nothing new
            checkpoints.start(spark.readStream.schema(SCHEMA).parquet(source), path, ck, 2).awaitTermination()
    assert [tuple(r) for r in checkpoints.read(spark, path, SCHEMA).collect()] == [(str(i), i, 2) for i in range(9)]
    assert checkpoints.versions(spark, path) == (1, [2])


def test_terminal_events_wait_for_the_end(spark):
    seeds = spark.createDataFrame([("1", "https://a.no"), ("2", "https://b.no"), ("3", ""), ("4", None)], "organisation_number string, website string")
    events = spark.createDataFrame([("1", "homepage")], "organisation_number string, page_kind string")
    assert checkpoints.terminal_events(seeds, events, False, "t").count() == 0
    assert [(r["organisation_number"], r["final_url"], r["status"]) for r in checkpoints.terminal_events(seeds, events, True, "t").collect()] == [("2", "https://b.no", "source_error")]
    assert checkpoints.terminal_events(seeds, events.withColumn("organisation_number", F.lit("2")), True, "t").count() == 1
