"""Claims with availability, conflicts, synthesis and envelopes (CLM-01..08, SYN-01, AGG-15, JON-14, FLT-10, PRJ-07, PRJ-08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.operators.screen import latest_filing

#: Evidence status to availability.
AVAILABILITY = {"available": "available", "not_found": "not_available", "not_fetched": "not_available", "not_applicable": "not_applicable", "blocked": "blocked", "source_error": "failed"}
#: Confidence by source class.
CONFIDENCE = {
    "official_registry_bulk": 0.99, "official_registry_live": 0.99, "official_annual_accounts": 0.98, "official_annual_account_copies": 0.97,
    "official_roles": 0.97, "official_group_structure": 0.97, "official_subunits": 0.97, "official_rule_interpretation": 0.9,
    "registry_linked_company_website": 0.9, "registry_linked_company_website_scrapy": 0.9, "company_linked_social_profile": 0.9, "company_reported_claim": 0.85,
}
#: Legal forms with a duty to file, and those with one above a threshold.
ALWAYS_FORMS = ("AS", "ASA", "BRL", "BBL", "STI", "SF", "VPFO")
THRESHOLD_FORMS = ("ENK", "ANS", "DA", "SA", "FLI", "ESEK", "NUF", "UTLA", "ORGL", "SAM", "SPA", "KS", "BO")


def _cases(column: Column, table: dict, default) -> Column:
    out = F.lit(default)
    for key, value in reversed(table.items()):
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def availability(status: Column) -> Column:
    """No record: not_available; a status that is not known: failed."""
    return F.when(status.isNull(), "not_available").otherwise(_cases(status, AVAILABILITY, "failed"))


def confidence(source_class: Column, state: Column) -> Column:
    return F.when(state == "available", _cases(F.coalesce(source_class, F.lit("")), CONFIDENCE, 0.75))


def response_status(code: Column) -> Column:
    return F.when(code == 200, "available").when(code.isin(404, 410), "not_found").otherwise("source_error")


def terminal_state(status: Column, note: Column) -> Column:
    robots = F.coalesce(F.lower(note).contains("robot"), F.lit(False))
    return (
        F.when(status == "available", "complete").when(status == "not_applicable", "not_applicable").when(status == "not_found", "not_found")
        .when((status == "blocked") & robots, "blocked_robots").when(status == "blocked", "blocked_policy").otherwise("source_error")
    )


def obligation() -> Column:
    return (
        F.when(F.coalesce("latest_submitted_accounts", F.lit("")) != "", "filing_observed").when(F.col("legal_form").isin(*ALWAYS_FORMS), "required_by_legal_form")
        .when(F.col("legal_form").isin(*THRESHOLD_FORMS), "threshold_or_activity_dependent").otherwise("special_rule_or_review_required")
    )


def with_live(bulk: DataFrame, live: DataFrame) -> DataFrame:
    """Per field the live value where there is one, else bulk; a conflict where both are there and differ."""
    l = live.select("organisation_number", F.lit(True).alias("has_live"), *(F.col(c).alias(f"live_{c}") for c in ("name", "employees")))
    own = bulk.join(l, "organisation_number", "left")
    for c in ("name", "employees"):
        own = own.withColumn(f"{c}_conflict", F.coalesce(F.col(f"live_{c}") != F.col(c), F.lit(False)))
        own = own.withColumn(f"{c}_ids", F.when(F.col(f"live_{c}").isNotNull(), "ev-registry,ev-registry_live").otherwise("ev-registry"))
        own = own.withColumn(f"{c}_resolved", F.coalesce(f"live_{c}", c))
    return own


_MONEY = ("revenue", "annual_result")


def claims(registry: DataFrame, live: DataFrame, filings: DataFrame, roles: DataFrame, locations: DataFrame) -> DataFrame:
    """Long claims in emission order: seq, field, value, availability, confidence, evidence_ids, financial_period."""
    people = roles.where("not inactive").groupBy("organisation_number").agg(F.count("*").alias("people"))
    has_roles = roles.select("organisation_number").distinct().withColumn("has_roles", F.lit(True))
    units = locations.groupBy("organisation_number").agg(F.count("*").alias("units"))
    years = filings.groupBy("organisation_number").agg(F.array_join(F.array_sort(F.collect_set(F.col("period_year").cast("string"))), ",").alias("years"))
    own = with_live(registry, live).join(latest_filing(filings), "organisation_number", "left").join(years, "organisation_number", "left")
    own = own.join(people, "organisation_number", "left").join(has_roles, "organisation_number", "left").join(units, "organisation_number", "left")
    none = F.lit(None).cast("string")

    def row(seq: int, field: str, value: Column, state: Column, source: str, ids: Column, period: Column = none, when: Column | None = None) -> Column:
        made = F.struct(
            F.lit(seq).alias("seq"), F.lit(field).alias("field"), F.when(state == "available", value.cast("string")).alias("value"), state.alias("availability"),
            confidence(F.lit(source), state).alias("confidence"), ids.alias("evidence_ids"), period.alias("financial_period"),
        )
        return made if when is None else F.when(when, made)

    filled = lambda c: F.when(F.coalesce(c.cast("string"), F.lit("")) != "", "available").otherwise("not_available")
    bulk, filing = F.lit("ev-registry"), F.lit("ev-financials")
    status = F.when(F.col("bankrupt"), "bankrupt").when(F.col("liquidating"), "liquidating").otherwise("active")
    period = F.col("period_year").cast("string")
    rows = [
        row(1, "legal_name", F.col("name_resolved"), filled(F.col("name_resolved")), "official_registry_bulk", F.col("name_ids")),
        row(2, "legal_form", F.col("legal_form"), filled(F.col("legal_form")), "official_registry_bulk", bulk),
        row(3, "municipality", F.col("municipality"), filled(F.col("municipality")), "official_registry_bulk", bulk),
        row(4, "industry_code", F.col("industry_code"), filled(F.col("industry_code")), "official_registry_bulk", bulk),
        row(5, "industry_label", F.col("industry_label"), filled(F.col("industry_label")), "official_registry_bulk", bulk),
        row(6, "registered_employees", F.col("employees_resolved"), filled(F.col("employees_resolved")), "official_registry_bulk", F.col("employees_ids")),
        row(7, "registered_website", F.col("website"), filled(F.col("website")), "official_registry_bulk", bulk),
        row(8, "registration_status", status, F.lit("available"), "official_registry_bulk", bulk),
        row(9, "accounting_obligation", obligation(), F.lit("available"), "official_rule_interpretation", F.lit("ev-accounting_obligation")),
        *(row(10 + i, m, F.col(m).cast("decimal(18,2)"), filled(F.col(m)), "official_annual_accounts", filing, period) for i, m in enumerate(_MONEY)),
        row(17, "available_filing_years", F.col("years"), filled(F.col("years")), "official_annual_account_copies", F.lit("ev-financial_history"), when=F.col("years").isNotNull()),
        row(18, "role_holders", F.col("people"), filled(F.col("people")), "official_roles", F.lit("ev-roles"), when=F.col("has_roles")),
        row(20, "registered_subunit_count", F.col("units"), F.lit("available"), "official_subunits", F.lit("ev-locations"), when=F.col("units").isNotNull()),
    ]
    return own.select("organisation_number", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def dedupe(long: DataFrame) -> DataFrame:
    """First per (company, field, value); financial claims that are available bypass the check."""
    first = F.row_number().over(Window.partitionBy("organisation_number", "field", "value").orderBy("seq"))
    return long.withColumn("_n", first).where((F.col("_n") == 1) | (F.col("financial_period").isNotNull() & (F.col("availability") == "available"))).drop("_n")


def dangling(long: DataFrame, evidence_ids: list[str]) -> DataFrame:
    """Claims that name evidence that is not there."""
    return long.withColumn("missing", F.array_except(F.split("evidence_ids", ","), F.array(*map(F.lit, evidence_ids)))).where(F.size("missing") > 0)


def _spaced(n: Column) -> Column:
    whole = F.format_number(F.abs(n.cast("double")), 0)
    return F.concat(F.when(n.cast("double") < 0, "-").otherwise(""), F.replace(whole, F.lit(","), F.lit(" ")))


def synthesise(long: DataFrame) -> DataFrame:
    """Summary sentences of a company in fixed order, each only where its field is available, and unknown fields."""
    ok = F.col("availability") == "available"
    get = lambda f: F.min_by(F.when((F.col("field") == f) & ok, F.col("value")), F.when((F.col("field") == f) & ok, F.col("seq"))).alias(f)
    fields = ("legal_name", "legal_form", "municipality", "industry_label", "registered_employees", "revenue", "role_holders")
    unknown = F.array_join(F.array_sort(F.collect_set(F.when(F.col("availability").isin("not_available", "blocked", "ambiguous", "failed"), F.col("field")))), ",")
    own = long.groupBy("organisation_number").agg(*map(get, fields), unknown.alias("unknown"))
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    c = F.col
    text = F.concat_ws(
        " ", say(c("legal_name"), " is registered as ", c("legal_form"), "."), say("It is in ", c("municipality"), "."), say("Its trade is ", c("industry_label"), "."),
        say("It reports ", c("registered_employees"), " employees."), say("Latest revenue: ", _spaced(c("revenue")), "."), say("Role holders: ", c("role_holders"), "."),
    )
    return own.select("organisation_number", text.alias("summary"), "unknown")


def modules(registry: DataFrame, live: DataFrame, filings: DataFrame, roles: DataFrame) -> DataFrame:
    """(organisation_number, module, status, note) of the modules asked for."""
    flag = lambda df, m: df.select("organisation_number").distinct().withColumn(m, F.lit(True))
    own = registry.join(flag(live, "live"), "organisation_number", "left").join(flag(filings, "fin"), "organisation_number", "left").join(flag(roles, "rol"), "organisation_number", "left")
    site = F.when(F.col("website").isNull(), "not_applicable").when(F.col("organisation_number").cast("bigint") % 5 == 0, "blocked").otherwise("available")
    there = lambda c, other: F.when(F.col(c), "available").otherwise(other)
    note = F.when(F.col("organisation_number").cast("bigint") % 10 == 0, "robots.txt denied").otherwise("policy")
    row = lambda m, s, n: F.struct(F.lit(m).alias("module"), s.alias("status"), n.alias("note"))
    none = F.lit(None).cast("string")
    return own.select("organisation_number", F.inline(F.array(row("registry", F.lit("available"), none), row("registry_live", there("live", "source_error"), none), row("financials", there("fin", "not_found"), none), row("roles", there("rol", "not_found"), none), row("website", site, note))))


TERMINAL = ("complete", "not_applicable", "not_found", "blocked_policy", "blocked_robots", "source_error", "budget_exhausted", "submission_error")


def envelopes(requested: DataFrame, found: DataFrame, long: DataFrame) -> DataFrame:
    """One row per requested company: state, modules map, claims array."""
    states = found.withColumn("state", terminal_state(F.col("status"), F.col("note"))).groupBy("organisation_number").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("module", "state")))).alias("modules"))
    own = long.groupBy("organisation_number").agg(F.array_sort(F.collect_list(F.struct("seq", "field", "value", "availability", "confidence", "evidence_ids"))).alias("claims"))
    return requested.join(states, "organisation_number", "left").join(own, "organisation_number", "left").withColumn("state", F.when(F.col("modules").isNull(), "submission_error").otherwise("complete"))


def validate(done: DataFrame, requested: DataFrame) -> DataFrame:
    """Counts a batch must satisfy: one envelope per request, terminal states only, none dropped."""
    bad = F.exists(F.map_values("modules"), lambda s: ~s.isin(*TERMINAL))
    got = done.agg(F.count("*").alias("envelopes"), F.count_distinct("organisation_number").alias("distinct_companies"), F.count_if(~F.col("state").isin(*TERMINAL)).alias("bad_states"), F.count_if(bad).alias("bad_modules"))
    dropped = requested.join(done, "organisation_number", "left_anti").agg(F.count("*").alias("dropped"))
    return got.join(dropped)  # one row each


def _claims(spark, sf_dir):
    return claims(*(bind(spark, sf_dir, n) for n in ("registry", "registry_live", "filings", "roles", "locations")))


def _modules(spark, sf_dir):
    return modules(*(bind(spark, sf_dir, n) for n in ("registry", "registry_live", "filings", "roles")))


def claims_long(spark, sf_dir):
    return dedupe(_claims(spark, sf_dir))


def claims_availability_counts(spark, sf_dir):
    return claims_long(spark, sf_dir).groupBy("field", "availability").agg(F.count("*").alias("n"))


def registry_conflicts(spark, sf_dir):
    own = with_live(bind(spark, sf_dir, "registry"), bind(spark, sf_dir, "registry_live"))
    rows = [F.when(F.col(f"{c}_conflict"), F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("bulk_value"), F.col(f"live_{c}").cast("string").alias("live_value"))) for c in ("name", "employees")]
    return own.select("organisation_number", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def claims_dangling(spark, sf_dir):
    """Against a list that lacks the records of roles and of the live registry."""
    known = ["ev-registry", "ev-accounting_obligation", "ev-financials", "ev-financial_history", "ev-locations"]
    return dangling(claims_long(spark, sf_dir), known).select("organisation_number", "field")


def synthesis_summary(spark, sf_dir):
    return synthesise(claims_long(spark, sf_dir))


def module_terminal_states(spark, sf_dir):
    own = _modules(spark, sf_dir)
    return own.groupBy("module", terminal_state(F.col("status"), F.col("note")).alias("state")).agg(F.count("*").alias("n"))


def envelope_validation(spark, sf_dir):
    """A batch with faults: every 17th envelope is missing, every 19th twice, every 23rd in a state that is no end, and the
    module states of every 29th unknown."""
    requested = bind(spark, sf_dir, "registry").select("organisation_number")
    k = F.col("organisation_number").cast("bigint")
    done = envelopes(requested, _modules(spark, sf_dir), claims_long(spark, sf_dir)).where(k % 17 != 0)
    done = done.withColumn("state", F.when(k % 23 == 0, "running").otherwise(F.col("state")))
    done = done.withColumn("modules", F.when(k % 29 == 0, F.transform_values("modules", lambda m, v: F.lit("lost"))).otherwise(F.col("modules")))
    return validate(done.unionByName(done.where(k % 19 == 0)), requested)


def obligation_classification(spark, sf_dir):
    return bind(spark, sf_dir, "registry").select("organisation_number", obligation().alias("classification"))


_C = f"""{ctes("registry", "registry_live", "filings", "roles", "locations")},
latest as (select * from (select *, row_number() over (partition by organisation_number order by period_year desc) as rn from filings) where rn = 1),
y as (select organisation_number, string_agg(distinct cast(period_year as varchar), ',' order by cast(period_year as varchar)) as years from filings group by 1),
pe as (select organisation_number, count(*) filter (where not inactive) as people from roles group by 1), lo as (select organisation_number, count(*) as units from locations group by 1),
w as (select r.*, l.name as lname, l.employees as lemp, t.period_year, t.revenue, t.annual_result, y.years, pe.people, pe.organisation_number is not null as has_roles, lo.units,
 case when coalesce(r.latest_submitted_accounts, '') <> '' then 'filing_observed' when legal_form in {ALWAYS_FORMS} then 'required_by_legal_form' when legal_form in {THRESHOLD_FORMS} then 'threshold_or_activity_dependent' else 'special_rule_or_review_required' end as duty
 from registry r left join registry_live l on l.organisation_number = r.organisation_number left join latest t on t.organisation_number = r.organisation_number left join y on y.organisation_number = r.organisation_number
 left join pe on pe.organisation_number = r.organisation_number left join lo on lo.organisation_number = r.organisation_number),
c as (
 select organisation_number, 1 as seq, 'legal_name' as field, coalesce(lname, name) as value, 0.99 as conf, case when lname is not null then 'ev-registry,ev-registry_live' else 'ev-registry' end as evidence_ids, null as financial_period from w
 union all select organisation_number, 2, 'legal_form', legal_form, 0.99, 'ev-registry', null from w union all select organisation_number, 3, 'municipality', municipality, 0.99, 'ev-registry', null from w
 union all select organisation_number, 4, 'industry_code', industry_code, 0.99, 'ev-registry', null from w union all select organisation_number, 5, 'industry_label', industry_label, 0.99, 'ev-registry', null from w
 union all select organisation_number, 6, 'registered_employees', cast(coalesce(lemp, employees) as varchar), 0.99, case when lemp is not null then 'ev-registry,ev-registry_live' else 'ev-registry' end, null from w
 union all select organisation_number, 7, 'registered_website', website, 0.99, 'ev-registry', null from w
 union all select organisation_number, 8, 'registration_status', case when bankrupt then 'bankrupt' when liquidating then 'liquidating' else 'active' end, 0.99, 'ev-registry', null from w
 union all select organisation_number, 9, 'accounting_obligation', duty, 0.9, 'ev-accounting_obligation', null from w
 union all select organisation_number, 10, 'revenue', cast(cast(revenue as decimal(18,2)) as varchar), 0.98, 'ev-financials', cast(period_year as varchar) from w
 union all select organisation_number, 11, 'annual_result', cast(cast(annual_result as decimal(18,2)) as varchar), 0.98, 'ev-financials', cast(period_year as varchar) from w
 union all select organisation_number, 17, 'available_filing_years', years, 0.97, 'ev-financial_history', null from w where years is not null
 union all select organisation_number, 18, 'role_holders', cast(nullif(people, 0) as varchar), 0.97, 'ev-roles', null from w where has_roles
 union all select organisation_number, 20, 'registered_subunit_count', cast(units as varchar), 0.97, 'ev-locations', null from w where units is not null),
k as (select organisation_number, seq, field, nullif(value, '') as value, case when coalesce(value, '') <> '' then 'available' else 'not_available' end as availability,
 case when coalesce(value, '') <> '' then cast(conf as double) end as confidence, evidence_ids, financial_period from c)"""
_M = f"""{ctes("registry", "registry_live", "filings", "roles")}, m as (
 select organisation_number, 'registry' as module, 'complete' as state from registry
 union all select organisation_number, 'registry_live', case when organisation_number in (select organisation_number from registry_live) then 'complete' else 'source_error' end from registry
 union all select organisation_number, 'financials', case when organisation_number in (select organisation_number from filings) then 'complete' else 'not_found' end from registry
 union all select organisation_number, 'roles', case when organisation_number in (select organisation_number from roles) then 'complete' else 'not_found' end from registry
 union all select organisation_number, 'website', case when website is null then 'not_applicable' when cast(organisation_number as bigint) % 10 = 0 then 'blocked_robots' when cast(organisation_number as bigint) % 5 = 0 then 'blocked_policy' else 'complete' end from registry)"""
_NUM = "case when cast(revenue as double) < 0 then '-' else '' end || replace(format('{:,}', cast(round_even(abs(cast(revenue as double)), 0) as bigint)), ',', ' ')"
QUERIES = {
    "obligation_classification": (obligation_classification, f"""{ctes("registry")} select organisation_number, case when coalesce(latest_submitted_accounts, '') <> '' then 'filing_observed' when legal_form in {ALWAYS_FORMS} then 'required_by_legal_form'
 when legal_form in {THRESHOLD_FORMS} then 'threshold_or_activity_dependent' else 'special_rule_or_review_required' end as classification from registry"""),
    "registry_conflicts": (registry_conflicts, f"""{ctes("registry", "registry_live")} select r.organisation_number, 'name' as field, r.name as bulk_value, l.name as live_value from registry r join registry_live l using (organisation_number) where r.name <> l.name
 union all select r.organisation_number, 'employees', cast(r.employees as varchar), cast(l.employees as varchar) from registry r join registry_live l using (organisation_number) where r.employees <> l.employees"""),
    "claims_long": (claims_long, f"{_C} select * from k"),
    "claims_availability_counts": (claims_availability_counts, f"{_C} select field, availability, count(*) as n from k group by all"),
    "claims_dangling_evidence": (claims_dangling, f"{_C} select organisation_number, field from k where evidence_ids like '%ev-roles%' or evidence_ids like '%ev-registry_live%'"),
    "synthesis_summary": (synthesis_summary, f"""{_C}, p as (select organisation_number, max(value) filter (where field = 'legal_name') as n, max(value) filter (where field = 'legal_form') as f, max(value) filter (where field = 'municipality') as m,
 max(value) filter (where field = 'industry_label') as i, max(value) filter (where field = 'registered_employees') as e, max(value) filter (where field = 'revenue') as revenue, max(value) filter (where field = 'role_holders') as r,
 coalesce(string_agg(field, ',' order by field) filter (where availability = 'not_available'), '') as unknown from k group by 1)
 select organisation_number, concat_ws(' ', n || ' is registered as ' || f || '.', 'It is in ' || m || '.', 'Its trade is ' || i || '.', 'It reports ' || e || ' employees.', 'Latest revenue: ' || {_NUM} || '.', 'Role holders: ' || r || '.') as summary, unknown from p"""),
    "module_terminal_states": (module_terminal_states, f"{_M} select module, state, count(*) as n from m group by all"),
    "envelope_validation": (envelope_validation, f"""{ctes('registry')}, r as (select cast(organisation_number as bigint) as k from registry), e as (select k from r where k % 17 <> 0), d as (select k from e union all select k from e where k % 19 = 0)
 select count(*) as envelopes, count(distinct k) as distinct_companies, count(*) filter (where k % 23 = 0) as bad_states, count(*) filter (where k % 29 = 0) as bad_modules, (select count(*) from r where k % 17 = 0) as dropped from d"""),
}
