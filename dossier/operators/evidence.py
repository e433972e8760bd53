"""Evidence records, claim spans, evidence of changes, sections of a synthesis, live entities, compact profiles (CLM-01, CLM-03, REF-05, SYN-02, PRJ-02, PRJ-07, PRJ-09, PRJ-11, PRJ-12, PRJ-17, JON-02, JON-03, SNK-03)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.operators import claims as C

#: What of a module's value may stand for its claim, the first that is filled.
SPAN_FIELDS = ("identity_text_excerpt", "title", "reason", "classification", "period")
#: Sections of a synthesis with their claims and labels, in order.
SECTIONS = {
    "COMPANY": (("legal_name", "Legal name"), ("legal_form", "Legal form"), ("industry_label", "Industry"), ("registration_status", "Status"), ("registered_employees", "Employees"), ("verified_website", "Verified website")),
    "LOCATIONS": (("municipality", "Municipality"), ("registered_subunit_count", "Registered subunits")),
    "FINANCIALS": (("revenue", "Revenue"), ("operating_result", "Operating result"), ("annual_result", "Annual result"), ("total_assets", "Total assets"), ("equity", "Equity"), ("debt", "Debt")),
}


def filled(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def claim_span(most: int = 280) -> Column:
    """What evidence says, from columns SPAN_FIELDS, source_row_key and note."""
    row = F.concat(F.lit("registry row key "), filled(F.col("source_row_key")))
    return F.coalesce(*(F.left(filled(F.col(c)), F.lit(most)) for c in SPAN_FIELDS), row, F.left(filled(F.col("note")), F.lit(most)))


def evidence_records(modules: DataFrame, observations: DataFrame) -> DataFrame:
    """One record per module that answered, whatever its status, in order of module, then one per observation with an id."""
    kind = F.coalesce(filled(F.col("source_class")), filled(F.col("source_type")))
    own = modules.select("organisation_number", F.lit(0).alias("part"), F.col("module").alias("place"), F.concat(F.lit("ev-"), "module").alias("id"), "source_url", kind.alias("source_class"), "content_sha256", claim_span().alias("claim_span"))
    seen = observations.where(F.coalesce("id", F.lit("")) != "")
    source = F.coalesce(filled(F.col("source_class")), filled(F.col("platform")))
    seen = seen.select("organisation_number", F.lit(1).alias("part"), F.lpad(F.col("seq").cast("string"), 20, "0").alias("place"), "id", "source_url", source.alias("source_class"), "content_sha256", F.col("evidence_span").alias("claim_span"))
    return own.unionByName(seen)


def change_evidence(changes: DataFrame, records: DataFrame) -> DataFrame:
    """Source of each change: for registry fields the live registry's record where there is one, else the bulk one; for others
    the record of the module before the point."""
    module = F.split_part("field", F.lit("."), F.lit(1))
    by = records.groupBy("organisation_number").agg(F.map_from_entries(F.collect_list(F.struct("module", F.struct("source_url", "retrieved_at")))).alias("by"))
    held = changes.join(by, "organisation_number", "left")
    own = F.when(module == "registry", F.coalesce(F.try_element_at("by", F.lit("registry_live")), F.try_element_at("by", F.lit("registry")))).otherwise(F.try_element_at("by", module))
    return held.withColumn("_e", own).select("organisation_number", "field", F.col("_e.source_url").alias("source_url"), F.col("_e.retrieved_at").alias("retrieved_at"))


def section_facts(long: DataFrame) -> DataFrame:
    """(organisation_number, section, ix, label, value, evidence_ids): the first available claim of each field of SECTIONS."""
    fields = [(s, i, f, label) for s, facts in SECTIONS.items() for i, (f, label) in enumerate(facts)]
    table = F.broadcast(long.sparkSession.createDataFrame(fields, "section string, ix int, field string, label string"))
    first = long.where("availability = 'available'").groupBy("organisation_number", "field").agg(F.min_by(F.struct("value", "evidence_ids"), "seq").alias("c"))
    return first.join(table, "field").select("organisation_number", "section", "ix", "label", "c.value", "c.evidence_ids")


def unknown_fields(long: DataFrame) -> DataFrame:
    """Fields a company's sources leave open, one row each; what does not apply is not unknown."""
    return long.where(F.col("availability").isin("not_available", "blocked", "ambiguous", "failed")).select("organisation_number", "field").distinct()


def sources(records: DataFrame) -> DataFrame:
    """URLs in the order in which a company's evidence first names them."""
    first = records.where(F.coalesce("source_url", F.lit("")) != "").groupBy("organisation_number", "source_url").agg(F.min(F.struct("part", "place")).alias("at"))
    listed = F.array_sort(F.collect_list(F.struct("at", "source_url")))
    return first.groupBy("organisation_number").agg(F.array_join(F.transform(listed, lambda x: x["source_url"]), " ").alias("sources"))


def live_entity(responses: DataFrame) -> DataFrame:
    """Fields of the live registry's JSON; nothing where the response is no object."""
    shape = "struct<organisasjonsnummer:string,navn:string,organisasjonsform:struct<kode:string>,antallAnsatte:int,konkurs:boolean,underAvvikling:boolean,naeringskode1:struct<kode:string,beskrivelse:string>,hjemmeside:string>"
    own = responses.select(F.from_json("body", shape).alias("e")).where("e.organisasjonsnummer is not null")
    industry = F.concat_ws(" ", "e.naeringskode1.kode", "e.naeringskode1.beskrivelse")
    return own.select(F.col("e.organisasjonsnummer").alias("organisation_number"), F.col("e.navn").alias("name"), F.col("e.organisasjonsform.kode").alias("legal_form"), F.col("e.antallAnsatte").alias("employees"), F.coalesce("e.konkurs", F.lit(False)).alias("bankrupt"), industry.alias("industry"), F.col("e.hjemmeside").alias("website"))


def seed_overlay(profiles: DataFrame, seeds: DataFrame) -> DataFrame:
    """Website and proof of seeded companies; raises where a seed is of no company or its URL not absolute."""
    bad = seeds.join(profiles, "organisation_number", "left_anti").count() + seeds.where(~F.coalesce(F.col("url").rlike("(?i)^https?://[^/]+"), F.lit(False))).count()
    if bad:
        raise ValueError(f"{bad} seeds of unknown companies or without an absolute URL")
    last = seeds.groupBy("organisation_number").agg(F.max_by(F.struct("url", "proof"), "seq").alias("s"))
    held = profiles.join(last, "organisation_number", "left")
    return held.select("organisation_number", F.coalesce("s.url", "website").alias("website"), F.col("s.proof").alias("proof"))


def with_previous(profiles: DataFrame, previous: DataFrame) -> DataFrame:
    """Profiles beside their previous state; of repeated ones the later row counts."""
    last = previous.groupBy("organisation_number").agg(F.max_by(F.struct("name", "employees"), "seq").alias("p"))
    return profiles.join(last, "organisation_number", "left").select("organisation_number", "name", F.col("p.name").alias("previous_name"), F.col("p.employees").alias("previous_employees"), F.col("p").isNotNull().alias("seen_before"))


def with_annotations(profiles: DataFrame, annotations: DataFrame) -> DataFrame:
    return profiles.join(annotations, "organisation_number", "left").select("organisation_number", F.coalesce("evaluation_split", F.lit("base")).alias("evaluation_split"), "sample_slice")


def curated(config: DataFrame, profiles: DataFrame) -> DataFrame:
    """Observations of a curated list: ids from company, URL and signal. Raises ValueError where a company is unknown or a hash is
    not 64 lower-case hex digits: such a list is to be mended, not read in part."""
    known = F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))
    good = config.where(known).join(profiles.select("organisation_number"), "organisation_number", "left_semi")
    if bad := config.count() - good.count():
        raise ValueError(f"{bad} curated rows of unknown companies or with bad hashes")
    text = F.concat_ws("|", "organisation_number", "source_url", "signal_type")
    return good.select(F.substring(F.sha2(text, 256), 1, 24).alias("id"), "organisation_number", "source_url", "signal_type")


def compact(registry: DataFrame, filings: DataFrame, roles: DataFrame, locations: DataFrame) -> DataFrame:
    """What a company's card shows: three latest periods, thirty role holders in force, thirty locations."""
    key = "organisation_number"

    def top(rows: DataFrame, value: str, order: list, n: int, name: str) -> DataFrame:
        """The first ``n`` by ``order``: ranked first, so no more than these are gathered."""
        nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        kept = rows.withColumn("_n", nth).where(F.col("_n") <= n)
        return kept.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", value))), lambda r: r[value]).alias(name))

    years = top(filings, "period_year", [F.col("period_year").desc()], 3, "years")
    holders = top(roles.where("not inactive"), "name", ["seq", "name"], 30, "holders")
    units = top(locations, "unit", ["seq", "unit"], 30, "units")
    own = reduce(lambda a, b: a.join(b, "organisation_number", "left"), (years, holders, units), registry.select("organisation_number", "name"))
    join = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return own.select("organisation_number", "name", join("years").alias("years"), join("holders").alias("holders"), join("units").alias("units"))


def run_report(found: DataFrame) -> DataFrame:
    """One row: companies, module states and their counts as a JSON object with sorted keys."""
    states = found.withColumn("state", C.terminal_state(F.col("status"), F.col("note"))).groupBy("state").agg(F.count("*").alias("n"))
    total = found.agg(F.count_distinct("organisation_number").alias("n")).withColumn("state", F.lit("companies"))
    return states.unionByName(total).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("state", "n"))))).alias("report"))


# --- bindings --------------------------------------------------------------------------------------------------------


def _modules(s, d):
    k = F.col("organisation_number").cast("bigint")
    some = lambda c, when: F.when(when, F.concat(F.lit(f"{c} "), "organisation_number", F.repeat(F.lit("."), 300))).alias(c)
    r = bind(s, d, "registry")
    spans = [some("identity_text_excerpt", k % 6 == 0), some("title", k % 3 == 0), F.when(k % 6 == 1, "").alias("reason"), some("classification", k % 6 == 1), some("period", F.lit(False)), F.when(k % 6 == 2, F.col("organisation_number")).alias("source_row_key"), F.when(k % 6 != 5, F.lit("noted")).alias("note")]
    own = r.select("organisation_number", F.lit("registry").alias("module"), F.lit("https://reg.example").alias("source_url"), F.lit("official_registry_bulk").alias("source_class"), F.lit("bulk").alias("source_type"), F.lit(None).cast("string").alias("content_sha256"), *spans)
    site = r.where("website is not null").select("organisation_number", F.lit("website").alias("module"), F.col("website").alias("source_url"), F.lit("").alias("source_class"), F.lit("site").alias("source_type"), F.lit(None).cast("string").alias("content_sha256"), *spans)
    return own.unionByName(site)


def _changes(s, d):
    r = bind(s, d, "registry").select("organisation_number", F.col("organisation_number").cast("bigint").alias("k"))
    changes = r.select("organisation_number", F.explode(F.array(F.lit("registry.employees"), F.lit("website.title"), F.lit("roles.chair"))).alias("field"))
    row = lambda m, when: F.when(when, F.struct(F.lit(m).alias("module"), F.concat(F.lit(f"https://{m}.example/"), "organisation_number").alias("source_url"), F.lit("2026-08-01").alias("retrieved_at")))
    records = r.select("organisation_number", F.inline(F.array_compact(F.array(row("registry", F.lit(True)), row("registry_live", F.col("k") % 3 == 0), row("website", F.col("k") % 2 == 0)))))
    return change_evidence(changes, records)


def _live(s, d):
    r = bind(s, d, "registry")
    k = F.col("organisation_number").cast("bigint")
    body = F.to_json(F.struct(F.col("organisation_number").alias("organisasjonsnummer"), F.col("name").alias("navn"), F.struct(F.col("legal_form").alias("kode")).alias("organisasjonsform"), F.col("employees").alias("antallAnsatte"), F.when(k % 2 == 0, F.col("bankrupt")).alias("konkurs"), F.struct(F.col("industry_code").alias("kode"), F.col("industry_label").alias("beskrivelse")).alias("naeringskode1")))
    return live_entity(r.select(F.when(k % 11 == 0, F.lit("[]")).when(k % 13 == 0, F.lit("no JSON")).otherwise(body).alias("body"))).drop("website")


def _seeds(s, d):
    r = bind(s, d, "registry").select("organisation_number", "website", F.col("organisation_number").cast("bigint").alias("k"))
    row = lambda n: F.struct(F.concat(F.lit(f"https://seed{n}.example/"), "k").alias("url"), F.lit(f"proof {n}").alias("proof"), F.lit(n).alias("seq"))
    seeds = r.where("k % 4 = 0").select("organisation_number", F.inline(F.when(F.col("k") % 8 == 0, F.array(row(1), row(2))).otherwise(F.array(row(1)))))
    return seed_overlay(r.select("organisation_number", "website"), seeds)


def _previous(s, d):
    old = bind(s, d, "registry_old").select("organisation_number", "name", "employees", F.col("organisation_number").cast("bigint").alias("k"))
    rows = old.where("k % 3 <> 0").select("organisation_number", F.lit("stale").alias("name"), F.lit(-1).alias("employees"), F.lit(1).alias("seq"))
    rows = rows.unionByName(old.where("k % 3 = 1").select("organisation_number", "name", "employees", F.lit(2).alias("seq")))
    return with_previous(bind(s, d, "registry").select("organisation_number", "name"), rows)


def _annotations(s, d):
    r = bind(s, d, "registry").select("organisation_number", F.col("organisation_number").cast("bigint").alias("k"))
    return with_annotations(r, r.where("k % 5 < 2").select("organisation_number", F.when(F.col("k") % 5 == 0, "extension").alias("evaluation_split"), F.concat(F.lit("slice "), F.col("k") % 5).alias("sample_slice")))


def _curated(s, d):
    o = bind(s, d, "observations")
    config = o.select("organisation_number", "source_url", "signal_type", F.when(F.col("seq") % 7 == 0, F.upper("content_sha256")).otherwise(F.col("content_sha256")).alias("content_sha256")).distinct()
    known = bind(s, d, "registry").where("not bankrupt")
    whole = config.where(F.col("content_sha256").rlike("^[0-9a-f]{64}$")).join(known.select("organisation_number"), "organisation_number", "left_semi")
    return curated(whole, known).distinct()


def _codes(s, d):
    code = F.element_at(F.array(*map(F.lit, (200, 404, 410, 500, 0, 301))), (F.col("page_id") % 6 + 1).cast("int"))
    return bind(s, d, "pages").select("page_id", C.response_status(code).alias("status"), C.availability(C.response_status(code)).alias("availability"))


_K = "cast(organisation_number as bigint)"
_EV = f"""{ctes("registry", "observations")}, m as (select organisation_number, 'registry' as module, 'https://reg.example' as source_url, 'official_registry_bulk' as source_class from registry
 union all select organisation_number, 'website', website, 'site' from registry where website is not null),
 e as (select organisation_number, 0 as part, module as place, 'ev-' || module as id, source_url, source_class, cast(null as varchar) as content_sha256,
 case when {_K} % 6 = 0 then left('identity_text_excerpt ' || organisation_number || repeat('.', 300), 280) when {_K} % 6 = 3 then left('title ' || organisation_number || repeat('.', 300), 280)
 when {_K} % 6 = 1 then left('classification ' || organisation_number || repeat('.', 300), 280) when {_K} % 6 = 2 then 'registry row key ' || organisation_number when {_K} % 6 = 4 then 'noted' end as claim_span from m
 union all select organisation_number, 1, lpad(cast(seq as varchar), 20, '0'), id, source_url, source_class, content_sha256, evidence_span from observations)"""
_FACTS = ", ".join(f"('{s}', {i}, '{f}', '{label}')" for s, facts in SECTIONS.items() for i, (f, label) in enumerate(facts))
QUERIES = {
    "evidence_records": (lambda s, d: evidence_records(_modules(s, d), bind(s, d, "observations")), f"{_EV} select * from e"),
    "claim_spans": (lambda s, d: _modules(s, d).where("module = 'registry'").select("organisation_number", claim_span(40).alias("span")), f"""{ctes("registry")} select organisation_number, left(case {_K} % 6 when 0 then 'identity_text_excerpt ' || organisation_number || repeat('.', 40)
 when 3 then 'title ' || organisation_number || repeat('.', 40) when 1 then 'classification ' || organisation_number || repeat('.', 40) when 2 then 'registry row key ' || organisation_number when 4 then 'noted' end, 40) as span from registry"""),
    "change_evidence": (_changes, f"""{ctes("registry")}, c as (select organisation_number, {_K} as k, f as field, case split_part(f, '.', 1) when 'registry' then case when {_K} % 3 = 0 then 'registry_live' else 'registry' end when 'website' then case when {_K} % 2 = 0 then 'website' end end as m
 from registry, (values ('registry.employees'), ('website.title'), ('roles.chair')) t(f)) select organisation_number, field, 'https://' || m || '.example/' || organisation_number as source_url, case when m is not null then '2026-08-01' end as retrieved_at from c"""),
    "synthesis_sections": (lambda s, d: section_facts(C.claims_long(s, d)), f"{C._C}, t(section, ix, field, label) as (values {_FACTS}) select organisation_number, section, cast(ix as int) as ix, label, arg_min(value, seq) as value, arg_min(evidence_ids, seq) as evidence_ids from k join t using (field) where availability = 'available' group by organisation_number, section, ix, label"),
    "synthesis_unknown": (lambda s, d: unknown_fields(C.claims_long(s, d)), f"{C._C} select distinct organisation_number, field from k where availability <> 'available'"),
    "synthesis_sources": (lambda s, d: sources(evidence_records(_modules(s, d), bind(s, d, "observations"))), f"{_EV}, f as (select organisation_number, source_url, min(part || place) as first_at from e group by all) select organisation_number, string_agg(source_url, ' ' order by first_at, source_url) as sources from f group by 1"),
    "live_entities": (_live, f"{ctes('registry')} select organisation_number, name, legal_form, employees, bankrupt and {_K} % 2 = 0 as bankrupt, industry_code || ' ' || industry_label as industry from registry where {_K} % 11 <> 0 and {_K} % 13 <> 0"),
    "seed_overlay": (_seeds, f"{ctes('registry')} select organisation_number, case when {_K} % 8 = 0 then 'https://seed2.example/' || organisation_number when {_K} % 4 = 0 then 'https://seed1.example/' || organisation_number else website end as website, case when {_K} % 8 = 0 then 'proof 2' when {_K} % 4 = 0 then 'proof 1' end as proof from registry"),
    "previous_profiles": (_previous, f"{ctes('registry', 'registry_old')} select r.organisation_number, r.name, case {_K.replace('organisation', 'r.organisation')} % 3 when 1 then o.name when 2 then 'stale' end as previous_name, case {_K.replace('organisation', 'r.organisation')} % 3 when 1 then o.employees when 2 then -1 end as previous_employees, {_K.replace('organisation', 'r.organisation')} % 3 <> 0 as seen_before from registry r join registry_old o using (organisation_number)"),
    "annotated_profiles": (_annotations, f"{ctes('registry')} select organisation_number, case when {_K} % 5 = 0 then 'extension' else 'base' end as evaluation_split, case when {_K} % 5 < 2 then 'slice ' || {_K} % 5 end as sample_slice from registry"),
    "curated_observations": (_curated, f"{ctes('registry', 'observations')} select distinct substr(sha256(organisation_number || '|' || source_url || '|' || signal_type), 1, 24) as id, organisation_number, source_url, signal_type from observations where content_sha256 is not null and not (seq % 7 = 0 and upper(content_sha256) <> content_sha256) and organisation_number in (select organisation_number from registry where not bankrupt)"),
    "compact_profiles": (lambda s, d: compact(*(bind(s, d, n) for n in ("registry", "filings", "roles", "locations"))), f"""{ctes("registry", "filings", "roles", "locations")},
 y as (select organisation_number, array_to_string(list(period_year order by period_year desc)[1:3], ',') as v from filings group by 1), h as (select organisation_number, array_to_string(list(name order by seq, name)[1:30], ',') as v from roles where not inactive group by 1),
 u as (select organisation_number, array_to_string(list(unit order by seq)[1:30], ',') as v from locations group by 1)
 select r.organisation_number, name, coalesce(y.v, '') as years, coalesce(h.v, '') as holders, coalesce(u.v, '') as units from registry r left join y using (organisation_number) left join h using (organisation_number) left join u using (organisation_number)"""),
    "run_report": (lambda s, d: run_report(C._modules(s, d)), f"{C._M}, n as (select state, count(*) as n from m group by 1 union all select 'companies', count(distinct organisation_number) from m) select '{{' || string_agg('\"' || state || '\":' || n, ',' order by state) || '}}' as report from n"),
    "response_classes": (_codes, "select page_id, case when page_id % 6 = 0 then 'available' when page_id % 6 in (1, 2) then 'not_found' else 'source_error' end as status, case when page_id % 6 = 0 then 'available' when page_id % 6 in (1, 2) then 'not_available' else 'failed' end as availability from pages"),
}
