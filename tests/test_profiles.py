"""Whole profiles: canonical differences, claims, sections, envelopes and answers on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from dossier.operators import envelopes, profile_claims, profile_diff

OBSERVATIONS = "organisation_number string, seq long, id string, platform string, signal_type string, source_class string, source_url string, sentiment_label string, metrics string"


def _profiles(spark, **of):
    rows = [(k.lstrip("n"), json.dumps(v)) for k, v in of.items()]
    return spark.createDataFrame(rows, "organisation_number string, text string").select("organisation_number", F.parse_json("text").alias("profile"))


def _changed(spark, old, new):
    return {r["field"]: (r["old_value"], r["new_value"]) for r in profile_diff.diff_profiles(_profiles(spark, n1=old), _profiles(spark, n1=new)).collect()}


def test_what_is_no_change(spark):
    site = lambda links: {"evidence": {"website": {"value": {"social_links": links}}}}
    a, b = {"platform": "x", "url": "https://www.x.com/a/"}, {"platform": "facebook", "url": "https://facebook.com/b?utm_source=y"}
    assert _changed(spark, site([a, b]), site([{"url": "https://facebook.com/b", "platform": "facebook"}, {"platform": "x", "url": "https://x.com/a"}])) == {}
    assert set(_changed(spark, site([a, a]), site([a]))) == {"website.social_links"} and set(_changed(spark, site([["p", "q"]]), site([["p", "r"]]))) == {"website.social_links"}
    assert _changed(spark, {"name": " A  B "}, {"name": "A B", "other": 1}) == {} and _changed(spark, {"name": None}, {}) == {}
    assert _changed(spark, {"employees": None}, {"employees": 0}) == {"registry.employees": (None, "0")} and set(_changed(spark, {"employees": 4}, {"employees": "4"})) == {"registry.employees"}
    records = lambda value: {"evidence": {"financials": {"value": {"records": value}}}}
    assert _changed(spark, records([{"a": {"b": [1, 2]}}]), records([{"a": {"b": [1.0, 2]}}])) == {} and set(_changed(spark, records([{"a": {"b": [1, 2]}}]), records([{"a": {"b": [2, 1]}}]))) == {"financials.records"}
    assert set(_changed(spark, records([]), records({}))) == {"financials.records"} and set(_changed(spark, records([{"a.b": 1}]), records([{"a": {"b": 1}}]))) == {"financials.records"}
    with pytest.raises(ValueError):
        profile_diff.diff_profiles(_profiles(spark, n1={}), _profiles(spark, n2={}))


def test_evidence_of_a_change(spark):
    record = lambda url, sha: {"source_url": url, "retrieved_at": "t", "source_type": "s", "content_sha256": sha, "status": "available"}
    old = {"name": "A", "evidence": {"registry": record("bulk", "h1")}}
    new = {"name": "B", "evidence": {"registry": record("bulk", "h2"), "registry_live": record("live", "h3")}}
    (row,) = profile_diff.diff_profiles(_profiles(spark, n1=old), _profiles(spark, n1=new)).collect()
    assert (row["source_url"], row["old_content_sha256"], row["new_content_sha256"], row["source_class"], row["status"]) == ("live", "h1", "h3", "s", "available")


def _claims(spark, profile, observations=()):
    found = profile_claims.claims(_profiles(spark, n1=profile), spark.createDataFrame(list(observations), OBSERVATIONS))
    return {r["field"]: r for r in found.collect()}


def test_missing_is_not_zero(spark):
    got = _claims(spark, {"employees": 0, "evidence": {"financials": {"status": "available", "value": {"records": [{"period": "2023", "revenue": 0, "debt": None}]}}, "locations": {"status": "available", "value": {"locations": []}}}})
    assert (got["registered_employees"]["value"], got["registered_employees"]["availability"]) == ("0", "available")
    assert (got["revenue"]["value"], got["revenue"]["financial_period"], got["debt"]["availability"], got["debt"]["value"]) == ("0", "2023", "not_available", None)
    assert got["registered_subunit_count"]["value"] == "0" and "registered_subunits" not in got and got["legal_name"]["availability"] == "not_available"
    failed = _claims(spark, {"evidence": {"financials": {"status": "odd", "value": None}, "website": {"status": "available", "value": {"final_url": "https://a.no"}}}})
    assert failed["equity"]["availability"] == "failed" and failed["verified_website"]["availability"] == "ambiguous" and failed["verified_website"]["value"] is None
    assert _claims(spark, {})["registration_status"]["availability"] == "not_available"


def test_sections_hold_jobs_and_activity_apart(spark):
    seen = [("1", 2, "o2", "news", "public_mention", "public_news", "u2", None, '{"n":1}'), ("1", 1, "o1", "job_board", "job_posting", None, "u1", None, None), ("1", 3, "", "x", "review", None, "u3", None, None), ("2", 1, "o9", "x", "review", None, "u9", None, None)]
    profiles, observations = _profiles(spark, n1={"name": "A AS", "evidence": {"registry": {"status": "available", "source_url": "u1"}}}), spark.createDataFrame(seen, OBSERVATIONS)
    claims = profile_claims.claims(profiles, observations)
    changes = spark.createDataFrame([], "organisation_number string, field_ix int, field string, old_value string, new_value string, source_url string, retrieved_at string")
    got = {}
    for r in profile_claims.sections(claims, changes, profile_claims.records(profiles, observations)).orderBy("section", "ix").collect():
        got.setdefault(r["section"], []).append((r["label"], r["evidence_ids"]))
    assert got["HIRING"] == [("external_job_posting", ["o1"])] and got["PUBLIC_ACTIVITY"] == [("external_public_mention", ["o2"])]
    assert [x for x, _ in got["SOURCES"]] == ["u1", "u2"] and ("revenue", []) in got["UNKNOWN"] and "RECENT_CHANGES" not in got
    text = profile_claims.summaries(claims, profiles.select("organisation_number", F.lit("").alias("name"))).first()
    assert text["summary"].startswith("A AS is a registered Norwegian entity.") and text["evidence_ids"] == ["ev-registry", "o1", "o2"] and text["facts"] == 3


def test_envelope_of_a_wrong_earlier_profile(spark):
    profiles = _profiles(spark, n1={"name": "B", "evidence": {"roles": {"status": "blocked", "note": "Robots.txt"}, "website": {"status": "source_error", "note": "HTTP 500", "source_url": "u"}, "junk": 5}}, n2={})
    previous = _profiles(spark, n1={"name": "A"}, n2={"name": "A"}).withColumn("previous_number", F.lit("2"))
    spent = spark.createDataFrame([("1", 3, 0, [5, 7], None)], "organisation_number string, requests long, runtime_ms long, latencies_ms array<long>, third_party_cost_usd double")
    got = {r["organisation_number"]: r for r in envelopes.envelopes(profiles, spark.createDataFrame([], OBSERVATIONS), previous, spent, ("roles", "website"), "r", "t0", "t1").collect()}
    one, two = got["1"], got["2"]
    assert [(e["stage"], e["error"]) for e in one["errors"]] == [("change_detection", envelopes.MISMATCH), ("website", "HTTP 500")] and one["changes"] == [] and one["modules"] == {"roles": "blocked_robots", "website": "source_error"}
    assert one["run"]["terminal_status"] == "completed" and [e["id"] for e in one["evidence"]] == ["ev-roles", "ev-website"] and tuple(one["operations"]) == (3, 12, 0.0)
    assert two["state"] == "submission_error" and two["errors"] == [] and [c["field"] for c in two["changes"]] == ["registry.name"] and tuple(two["operations"]) == (0, 0, 0.0)


def test_answers_say_what_they_lack(spark):
    profiles = _profiles(spark, n1={"name": "A", "evidence": {"website": {"status": "available", "value": {"description": "d", "identity_assessment": {"publishable": False}}}, "roles": {"value": {"roles": [{"organisation_number": "9", "group": "G"}]}}}})
    told = lambda question: [(r["label"], r["value"]) for r in envelopes.answers(profiles, question).orderBy("ix").collect()]
    assert told("Who leads?") == [("G", '"9"')] and told("social?") == [("note", envelopes.NOTES["quarantine"])]
    assert [x for x, _ in told("anything")] == ["Registered name", "Organisation number", "G", "note", "note", "note"] and told("sentiment?") == [("note", envelopes.NOTES["sentiment"])]
