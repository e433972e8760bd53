"""Files in and out, and streams that end where the batch does."""

import gzip
from collections import Counter

import pytest

from dossier.operators.crawl import dedupe_events
from dossier.sources import files, workspace
from dossier.streaming import streams

HEAD = "organisasjonsnummer;navn;organisasjonsform.kode;antallAnsatte;konkurs;forretningsadresse.kommune\n"


def test_bulk_and_lists(spark, tmp_path):
    path = tmp_path / "bulk.csv.gz"
    path.write_bytes(gzip.compress((HEAD + '111111111;"A; ""B"" AS";AS;12x;True;OSLO\n22;short;AS;1;false;\n333333333;C;;0;false;BERGEN\n').encode()))
    rows = {r["organisation_number"]: r for r in files.bulk_registry(spark, str(path)).collect()}
    assert set(rows) == {"111111111", "333333333"}
    assert rows["111111111"]["name"] == 'A; "B" AS' and rows["111111111"]["employees"] is None and rows["111111111"]["bankrupt"]
    assert rows["333333333"]["employees"] == 0 and rows["333333333"]["legal_form"] == "" and rows["333333333"]["website"] == ""
    wanted = tmp_path / "orgs.txt"
    wanted.write_text('{"organisation_number": "333 333 333"}\n111111111\n')
    requested = files.organisation_list(spark, str(wanted))
    assert [r["organisation_number"] for r in files.requested_profiles(requested, files.bulk_registry(spark, str(path))).collect()] == ["333333333", "111111111"]
    wanted.write_text("1\n")
    with pytest.raises(ValueError):
        files.organisation_list(spark, str(wanted))


def test_organisation_lists_of_every_form(spark, tmp_path):
    forms = {"a.json": '["111 111 111", {"organisation_number": 222222222, "sample_slice": "s"}]', "b.json": '{"organisation_numbers": [111111111, {"organisation_number": "222222222", "sample_slice": "s", "other": 1}]}', "c.jsonl": '"111111111"\n\n{"organisation_number": "NO 222222222", "sample_slice": "s"}\n', "d.txt": " 111111111 \nNO222222222MVA\n"}
    for name, text in forms.items():
        (tmp_path / name).write_text(text)
        rows = files.organisation_list(spark, str(tmp_path / name)).orderBy("seq").collect()
        assert [r["organisation_number"] for r in rows] == ["111111111", "222222222"] and rows[0]["sample_slice"] is None
        assert rows[1]["sample_slice"] == (None if name == "d.txt" else "s")
    for text in ("{", '["1"]', '["111111111", "111111111"]'):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            files.organisation_list(spark, str(tmp_path / "bad.json")).collect()


def test_stream_equals_batch(spark, tmp_path):
    schema = "organisation_number string, page_kind string, final_url string, content_sha256 string, status string, retrieved_at string, seq long"
    rows = [(str(i % 3), "homepage", f"u{i % 4}", "h", "available", f"2026-08-{1 + i % 20:02d}T00:00:00Z", i) for i in range(60)]
    events = spark.createDataFrame(rows, schema)
    events.write.json(str(tmp_path / "in"))
    stream = streams.dedupe(streams.read_events(spark, str(tmp_path / "in"), schema))
    for _ in range(2):  # the second start finds nothing new
        streams.start(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == dedupe_events(events).count()


def test_change_feed(spark, tmp_path):
    schema = "organisation_number string, name string, legal_form string, employees int, municipality string, website string, latest_submitted_accounts string"
    row = lambda n: [("1", "A AS", "AS", n, "M", None, "2023"), ("2", "B AS", "AS", 1, "M", None, "2023")]
    source = str(tmp_path / "in")
    for n in (2, 3):
        spark.createDataFrame(row(n), schema).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(schema).json(source)
        streams.change_feed(stream, str(tmp_path / "state"), str(tmp_path / "changes"), str(tmp_path / "ck")).awaitTermination()
    found = [(r["organisation_number"], r["field"], r["old_value"], r["new_value"]) for r in spark.read.parquet(str(tmp_path / "changes")).collect()]
    assert found == [("1", "registry.employees", "2", "3")]


def test_windows_of_a_stream(spark, tmp_path):
    """A stream's sessions and overlapping windows are those that Python counts."""
    schema = "organisation_number string, page_kind string, final_url string, content_sha256 string, status string, retrieved_at string, seq long"
    minutes = [0, 10, 45, 46, 200, 229, 260, 61]  # by the hour and minute of one day
    stamp = lambda m: f"2026-08-01T{m // 60:02d}:{m % 60:02d}:00Z"
    late = [("9", "homepage", "u", "h", "available", "2026-12-01T00:00:00Z", 99)]
    rows = [(str(i % 2), "homepage", "u", "h", "available", stamp(m), i) for i, m in enumerate(minutes)]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / "in"))
    stream = streams.read_events(spark, str(tmp_path / "in"), schema)
    for name, made in (("s", streams.sessions(stream, "organisation_number")), ("w", streams.counts(stream, "2 hours", slide="1 hour"))):
        streams.start(made, str(tmp_path / name), str(tmp_path / f"ck-{name}")).awaitTermination()
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))  # lets the watermark pass
    for name, made in (("s", streams.sessions(stream, "organisation_number")), ("w", streams.counts(stream, "2 hours", slide="1 hour"))):
        streams.start(made, str(tmp_path / name), str(tmp_path / f"ck-{name}")).awaitTermination()
    want = []
    for org in "01":
        last = None
        for m in sorted(m for i, m in enumerate(minutes) if i % 2 == int(org)):
            if last is None or m - last >= 30:
                want.append([org, 0])
            want[-1][1] += 1
            last = m
    found = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sorted((r["organisation_number"], r["n"]) for r in found) == sorted(map(tuple, want))
    hours = Counter(h for m in minutes for h in (m // 60 - 1, m // 60))
    found = spark.read.parquet(str(tmp_path / "w")).select("n").collect()
    assert sorted(r["n"] for r in found) == sorted(hours.values())


def test_workspace(tmp_path):
    path = str(tmp_path / "deep" / "workspace.json")
    held, reason = workspace.load(path)
    assert held == workspace.Workspace() and reason is None
    for i in range(103):
        held = held.with_screen(f"q{i}", {"filters": []}, ["2", "1"], ["2"] if i % 2 else ["1"])
    held.save(path)
    again, reason = workspace.load(path)
    assert reason is None and again == held and again.pins == ("1", "2")
    assert [len(again.history), again.history[0]["query"], again.history[-1]["result_count"]] == [100, "q3", 2]
    for text in ("{", "[]", '{"schema_version": 2, "pins": [], "history": []}', '{"schema_version": 1, "pins": {}, "history": []}'):
        (tmp_path / "bad.json").write_text(text)
        held, reason = workspace.load(str(tmp_path / "bad.json"))
        assert held == workspace.Workspace() and reason
