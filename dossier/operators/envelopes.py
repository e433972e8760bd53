"""Terminal envelopes of whole profiles and answers from them (CLM-07, CLM-08, QNA-01).

An envelope gathers what one company has: its claims, evidence, changes against an earlier profile, structured errors and
operations. All parts are aggregated per company before they meet, so an envelope is one row of bounded arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind
from dossier.operators import profile_claims as P
from dossier.operators.normalize import topics
from dossier.operators.profile_diff import diff_profiles

KEY = "organisation_number"
#: What an error says.
MISMATCH, UNSAID = "previous profile organisation number mismatch", "source error"
#: Notes on what an answer does not say.
NOTES = {
    "financial": "No normalized annual-account record was returned; missing values are not interpreted as zero.", "role": "No active public role holder was returned.",
    "location": "No registered subunit was returned; this does not prove the company has no physical presence.", "site": "The registry-linked company website was not available to this run.",
    "quarantine": "A registry-linked website was fetched, but exact legal-entity identity was not established; its claims and social links are quarantined.",
    "sentiment": "Sentiment is not scored: no labelled Norwegian news/social evaluation corpus has been run, and company-owned pages are structurally promotional.",
}
#: Labels of an answer's facts and where a profile or its latest filing has them; how many people or units it lists.
REGISTRY_FACTS = (("Registered name", "name"), ("Organisation number", None), ("Legal form", "legal_form"), ("Municipality", "municipality"), ("Registry employee count", "employees"))
MONEY_FACTS = (("Reporting period", "period"), ("Revenue", "revenue"), ("Operating result", "operating_result"), ("Annual result", "annual_result"), ("Assets", "assets"), ("Debt", "debt"))
LISTED = 12


def module_state(status: Column, note: Column) -> Column:
    """Terminal state of a module by its record; without one, or with a status that is not known, a submission error."""
    robots = F.coalesce(F.lower(note).contains("robot"), F.lit(False))
    known = F.when(status == "available", "complete").when(status.isin("not_applicable", "not_found", "source_error"), status).when(status == "blocked", F.when(robots, "blocked_robots").otherwise("blocked_policy"))
    return F.coalesce(known, F.lit("submission_error"))


def _modules(profiles: DataFrame) -> DataFrame:
    """(KEY, module, r): evidence records, r being a VARIANT object."""
    own = profiles.select(KEY, F.variant_get("profile", "$.evidence", "map<string,variant>").alias("e")).select(KEY, F.explode("e").alias("module", "r"))
    return own.where(F.schema_of_variant("r").startswith("OBJECT"))


def _of(record: str, *names: str) -> Column:
    return F.coalesce(*(F.nullif(F.try_variant_get(record, f"$.{n}", "string"), F.lit("")) for n in names))


def _gathered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Rows of a company as one array in order, without the columns that order them only."""
    shown = [c for c in rows.columns if c != KEY and not c.startswith("_")]
    listed = F.array_sort(F.collect_list(F.struct(*order, F.struct(*shown).alias("_v"))))
    return rows.groupBy(KEY).agg(F.transform(listed, lambda x: x["_v"]).alias(name))


def evidence_rows(profiles: DataFrame, observations: DataFrame) -> DataFrame:
    """Evidence of a company: its modules by name, then its observations."""
    own = _modules(profiles).select(KEY, F.struct(F.lit(0).alias("part"), F.col("module").alias("name"), F.lit(0).cast("long").alias("seq")).alias("_at"), F.concat(F.lit("ev-"), "module").alias("id"), _of("r", "source_url").alias("source_url"), _of("r", "source_class", "source_type").alias("source_class"), _of("r", "content_sha256").alias("content_sha256"))
    seen = observations.where(F.coalesce("id", F.lit("")) != "").join(profiles.select(KEY), KEY, "left_semi")
    seen = seen.select(KEY, F.struct(F.lit(1).alias("part"), F.lit("").alias("name"), F.col("seq").alias("seq")).alias("_at"), "id", "source_url", F.coalesce(F.nullif("source_class", F.lit("")), "platform").alias("source_class"), F.lit(None).cast("string").alias("content_sha256"))
    return own.unionByName(seen)


def errors_of(profiles: DataFrame, previous: DataFrame) -> DataFrame:
    """(KEY, stage, error, source_url, _at): a wrong earlier profile first, then modules whose source failed."""
    wrong = previous.where(~F.col("previous_number").eqNullSafe(F.col(KEY))).select(KEY, F.lit("change_detection").alias("stage"), F.lit(MISMATCH).alias("error"), F.lit(None).cast("string").alias("source_url"), F.lit(0).alias("_at"))
    failed = _modules(profiles).where(F.try_variant_get("r", "$.status", "string") == "source_error")
    failed = failed.select(KEY, F.col("module").alias("stage"), F.coalesce(_of("r", "note"), F.lit(UNSAID)).alias("error"), _of("r", "source_url").alias("source_url"), F.lit(1).alias("_at"))
    return wrong.join(profiles.select(KEY), KEY, "left_semi").unionByName(failed)


def envelopes(profiles: DataFrame, observations: DataFrame, previous: DataFrame, operations: DataFrame, modules: tuple[str, ...], run_id: str, started_at: str, completed_at: str) -> DataFrame:
    """One row per profile: run, claims, evidence, changes, errors, operations, modules, state and conflicts.

    ``previous(organisation_number, previous_number, profile)`` are earlier profiles and the company each one says it is of; one
    of another company gives an error and no changes. ``operations(organisation_number, requests, runtime_ms, latencies_ms,
    third_party_cost_usd)``: the run time is the sum of the latencies where it is not given.
    """
    own = profiles.select(KEY, "profile")
    claims = _gathered(P.claims(profiles, observations).withColumnsRenamed({"seq": "_seq", "sub": "_sub"}), "claims", "_seq", "_sub")
    evidence = _gathered(evidence_rows(profiles, observations), "evidence", "_at")
    right = previous.where(F.col("previous_number") == F.col(KEY)).join(profiles.select(KEY), KEY, "left_semi").select(KEY, "profile")
    changes = _gathered(diff_profiles(right, own.join(right.select(KEY), KEY, "left_semi")).withColumnRenamed("field_ix", "_ix"), "changes", "_ix")
    errors = _gathered(errors_of(profiles, previous), "errors", "_at", "stage")
    conflicts = _gathered(P.conflicts(profiles), "conflicts", "field")
    states = F.map_from_arrays(F.array(*map(F.lit, modules)), F.array(*(module_state(F.try_variant_get("profile", f"$.evidence.{m}.status", "string"), F.try_variant_get("profile", f"$.evidence.{m}.note", "string")) for m in modules)))
    held = own.withColumn("modules", states)
    for part in (claims, evidence, changes, errors, conflicts):
        held = held.join(part, KEY, "left")
    spent = F.coalesce(F.nullif("runtime_ms", F.lit(0).cast("long")), F.aggregate("latencies_ms", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    told = operations.select(KEY, F.struct(F.coalesce("requests", F.lit(0).cast("long")).alias("requests"), spent.alias("runtime_ms"), F.coalesce("third_party_cost_usd", F.lit(0.0)).alias("third_party_cost_usd")).alias("operations"))
    held = held.join(told, KEY, "left")
    bad = F.exists(F.map_values("modules"), lambda s: s == "submission_error")
    none = F.struct(F.lit(0).cast("long").alias("requests"), F.lit(0).cast("long").alias("runtime_ms"), F.lit(0.0).alias("third_party_cost_usd"))
    run = F.struct(F.lit(run_id).alias("run_id"), F.lit(started_at).alias("started_at"), F.lit(completed_at).alias("completed_at"), F.when(bad, "failed").otherwise("completed").alias("terminal_status"))
    listed = lambda c: F.coalesce(F.col(c), F.array().cast(held.schema[c].dataType)).alias(c)
    return held.select(KEY, run.alias("run"), *map(listed, ("claims", "evidence", "changes", "errors")), F.coalesce("operations", none).alias("operations"), "modules", F.when(bad, "submission_error").otherwise("complete").alias("state"), listed("conflicts"))


def answers(profiles: DataFrame, question: str) -> DataFrame:
    """(KEY, ix, label, value): facts of a profile that a question asks for, values as JSON, and notes (label "note") on what it
    cannot say. ``ix`` orders them: facts by topic, then notes."""
    asked = topics(question)
    sentiment = "sentiment" in question.casefold()
    said, get = P._said, P._get
    one = lambda ix, label, value: F.struct(F.lit(ix).alias("ix"), label.alias("label"), value.alias("value"))
    note = lambda ix, name, when: F.when(when, one(ix, F.lit("note"), F.lit(NOTES[name])))
    rows, lists = [], []
    if "employee" in asked:
        for i, (label, field) in enumerate(REGISTRY_FACTS):
            value = said(f"$.{field}") if field else F.concat(F.lit('"'), KEY, F.lit('"'))
            rows.append(F.when(value != '""', one(i, F.lit(label), value)))
    if "financial" in asked:
        latest = "$.evidence.financials.value.records[0]"
        for i, (label, field) in enumerate(MONEY_FACTS):
            value = said(f"{latest}.{field}")
            rows.append(F.when(value.isNotNull(), one(10 + i, F.lit(label), value)))
        rows.append(note(900, "financial", said(latest).isNull()))
    if "role" in asked:
        kinds = "array<struct<name:string,organisation_number:string,role:string,`group`:string,inactive:boolean>>"
        people = F.coalesce(F.filter(F.from_json(said("$.evidence.roles.value.roles"), kinds), lambda p: ~F.coalesce(p["inactive"], F.lit(False))), F.array().cast(kinds))
        lists.append(F.transform(F.slice(people, 1, LISTED), lambda p, i: F.struct((i + 100).alias("ix"), F.coalesce(F.nullif(p["role"], F.lit("")), F.nullif(p["group"], F.lit("")), F.lit("Registered role")).alias("label"), F.concat(F.lit('"'), F.coalesce(F.nullif(p["name"], F.lit("")), p["organisation_number"]), F.lit('"')).alias("value"))))
        rows.append(note(901, "role", F.size(people) == 0))
    if "location" in asked:
        units = F.coalesce(F.from_json(said("$.evidence.locations.value.locations"), "array<struct<name:string,address:string>>"), F.array().cast("array<struct<name:string,address:string>>"))
        lists.append(F.transform(F.slice(units, 1, LISTED), lambda u, i: F.struct((i + 200).alias("ix"), F.lit("Registered subunit").alias("label"), F.to_json(u, {"ignoreNullFields": "false"}).alias("value"))))
        rows.append(note(902, "location", F.size(units) == 0))
    if "social" in asked:
        site = "$.evidence.website"
        shown = F.coalesce(get(f"{site}.value.identity_assessment.publishable", "boolean"), F.lit(True))
        there = F.coalesce(get(f"{site}.status") == "available", F.lit(False))
        about = said(f"{site}.value.description")
        rows.append(F.when(shown & (about != '""'), one(300, F.lit("Website description"), about)))
        links = F.coalesce(F.from_json(said(f"{site}.value.social_links"), "array<struct<platform:string,url:string>>"), F.array().cast("array<struct<platform:string,url:string>>"))
        lists.append(F.when(shown, F.transform(links, lambda x, i: F.struct((i + 301).alias("ix"), F.concat(F.lit("Declared "), x["platform"], F.lit(" profile")).alias("label"), F.concat(F.lit('"'), x["url"], F.lit('"')).alias("value")))).otherwise(F.array().cast("array<struct<ix:int,label:string,value:string>>")))
        rows += [note(903, "quarantine", there & ~shown), note(904, "site", ~there)]
    if sentiment:
        rows.append(note(905, "sentiment", F.lit(True)))
    kind = "array<struct<ix:int,label:string,value:string>>"
    every = F.array_compact(F.array(*rows)).cast(kind) if rows else F.array().cast(kind)
    for listed in lists:
        every = F.concat(every, listed.cast(kind))
    return profiles.select(KEY, F.inline(every))


# --- bindings -----------------------------------------------------------------------------------------------------------

_RUN = ("registry", "roles", "website")


def _envelopes(s, d):
    profiles, seen = P._profiles(s, d), P._observations(s, d)
    k = F.col(KEY).cast("bigint") - 900000000
    changed = F.parse_json(F.replace(F.to_json("profile"), F.lit('"name":"Firm '), F.lit('"name":"Old ')))
    previous = profiles.where(k % 4 == 0).select(KEY, F.when(k % 8 == 4, "111111111").otherwise(F.col(KEY)).alias("previous_number"), changed.alias("profile"))
    spent = profiles.where(k % 6 != 0).select(KEY, (k % 9).alias("requests"), F.when(k % 2 == 0, k).alias("runtime_ms"), F.array(k, F.lit(5).cast("long")).alias("latencies_ms"), F.when(k % 5 == 0, 0.25).alias("third_party_cost_usd"))
    found = envelopes(profiles, seen, previous, spent, _RUN, "run-1", "t0", "t1")
    states = F.array_join(F.transform(F.map_entries("modules"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return found.select(KEY, "run.terminal_status", F.size("claims").alias("claims"), F.size("evidence").alias("evidence"), F.to_json(F.transform("changes", lambda c: F.struct(c["field"].alias("field"), c["old_value"].alias("old_value")))).alias("changes"), F.to_json("errors").alias("errors"), F.size("conflicts").alias("conflicts"), states.alias("modules"), "state", "operations.requests", "operations.runtime_ms", "operations.third_party_cost_usd")


def _envelopes_sql() -> str:
    there = " + ".join(f"cast({when} as int)" for _, when in P._PARTS.values())
    return f"""{P._claims_sql()}, n as (select organisation_number, count(*) as claims from cl group by 1), o as (select organisation_number, count(*) as seen from observations where seq % 3 = 0 group by 1)
 select c.organisation_number, case when k % 13 = 0 or k % 7 = 0 or k % 11 = 0 then 'failed' else 'completed' end as terminal_status, cast(claims as int) as claims, cast({there} + coalesce(seen, 0) as int) as evidence,
 case when k % 8 = 0 then '[{{"field":"registry.name","old_value":"\\"Old ' || org || '\\""}}]' else '[]' end as changes,
 '[' || array_to_string(list_filter([case when k % 8 = 4 then '{{"stage":"change_detection","error":"{MISMATCH}"}}' end, case when k % 5 = 2 then '{{"stage":"financials","error":"{UNSAID}","source_url":"https://financials.example/' || org || '"}}' end, case when k % 3 = 0 and k % 4 = 0 then '{{"stage":"registry_live","error":"{UNSAID}","source_url":"https://registry_live.example/' || org || '"}}' end], lambda x: x is not null), ',') || ']' as errors,
 cast(cast(k % 12 = 6 as int) + cast(k % 15 = 0 and k % 4 <> 0 as int) as int) as conflicts, 'registry=' || case when k % 13 = 0 then 'submission_error' else 'complete' end || ',roles=' || case when k % 7 = 0 then 'submission_error' else 'complete' end || ',website=' || case when k % 11 = 0 then 'submission_error' when k % 11 = 1 then 'blocked_policy' else 'complete' end as modules,
 case when k % 13 = 0 or k % 7 = 0 or k % 11 = 0 then 'submission_error' else 'complete' end as state, cast(case when k % 6 <> 0 then k % 9 else 0 end as bigint) as requests, cast(case when k % 6 = 0 then 0 when k % 2 = 0 then k else k + 5 end as bigint) as runtime_ms, cast(case when k % 6 <> 0 and k % 5 = 0 then 0.25 else 0 end as double) as third_party_cost_usd
 from c join n on n.organisation_number = c.organisation_number left join o on o.organisation_number = c.organisation_number"""


_ANSWERS_SQL = P._claims_sql() + f""", a as (
 select organisation_number, 100 as ix, 'CEO' as label, '"A B"' as value from c where k % 7 > 1 union all select organisation_number, 101, 'BOARD', '"C D"' from c where k % 7 > 1 union all select organisation_number, 901, 'note', '{NOTES["role"]}' from c where k % 7 <= 1
 union all select organisation_number, 300, 'Website description', '"Says"' from c where k % 11 <> 0 and k % 3 <> 0 union all select organisation_number, 301 + i, 'Declared ' || p || ' profile', '"' || u || '"' from c, (values (0, 'x', 'https://x.com/a'), (1, 'x', 'https://x.com/a'), (2, 'facebook', 'https://facebook.com/b')) t(i, p, u) where k % 11 <> 0 and k % 3 <> 0
 union all select organisation_number, 903, 'note', '{NOTES["quarantine"]}' from c where k % 11 > 1 and k % 3 = 0 union all select organisation_number, 904, 'note', '{NOTES["site"]}' from c where k % 11 <= 1 union all select organisation_number, 905, 'note', '{NOTES["sentiment"]}' from c)
 select organisation_number, cast(ix as int) as ix, label, value from a"""
QUERIES = {
    "profile_envelopes": (_envelopes, _envelopes_sql()),
    "profile_answers": (lambda s, d: answers(P._profiles(s, d), "Who leads it, its social profiles and sentiment?"), _ANSWERS_SQL),
}
