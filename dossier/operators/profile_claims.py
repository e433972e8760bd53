"""Claims of whole profiles, their summary and sections (CLM-02, CLM-04..06, SYN-01, SYN-02).

A profile is a VARIANT with bulk fields at its top and evidence records by module. One projection makes the rows of a company:
registry facts (live over bulk), status, obligation, seven financial measures, filing years, role holders, group, subunits,
website and its social profiles; verified observations come as rows of their own. Values are JSON texts, null unless available.
Of equal values of a field the first stands; measures and observations always stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.frames import dealt, with_once
from dossier.operators.claims import availability, confidence

#: Registry fields and the claims they make; measures and where a filing has them.
REGISTRY_CLAIMS = (("name", "legal_name"), ("legal_form", "legal_form"), ("municipality", "municipality"), ("industry_code", "industry_code"), ("industry_label", "industry_label"), ("employees", "registered_employees"), ("website", "registered_website"))
MEASURES = (("revenue", "revenue"), ("operating_result", "operating_result"), ("profit_before_tax", "profit_before_tax"), ("annual_result", "annual_result"), ("total_assets", "assets"), ("equity", "equity"), ("debt", "debt"))
#: Labels of facts by section.
FACTS = {
    "COMPANY": (("legal_name", "Legal name"), ("legal_form", "Legal form"), ("industry_label", "Industry"), ("registration_status", "Status"), ("registered_employees", "Employees"), ("verified_website", "Verified website")),
    "LOCATIONS": (("municipality", "Municipality"), ("registered_subunit_count", "Registered subunits")),
    "FINANCIALS": (("revenue", "Revenue"), ("operating_result", "Operating result"), ("annual_result", "Annual result"), ("total_assets", "Total assets"), ("equity", "Equity"), ("debt", "Debt")),
}
CLAIM = "seq int, sub int, field string, value string, availability string, confidence double, evidence_ids array<string>, financial_period string, always boolean"
_STRUCT = "struct<" + CLAIM.replace(" ", ":").replace(",:", ",") + ">"


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("profile", path, kind)


def _said(path: str) -> Column:
    """The JSON text of what stands there, null for nothing and for null."""
    value = _get(path, "variant")
    return F.when(value.isNotNull() & ~F.is_variant_null(value), F.to_json(value))


def _row(seq: int, field: Column | str, value: Column, state: Column, source: Column | str | None, ids: Column, period: Column | None = None, always: Column | bool = False, sub: Column | int = 0) -> Column:
    lit = lambda v, kind: v if isinstance(v, Column) else F.lit(v).cast(kind)
    source, none = lit(source, "string"), F.lit(None).cast("string")
    parts = {"seq": F.lit(seq), "sub": lit(sub, "int"), "field": lit(field, "string"), "value": F.when(state == "available", value), "availability": state, "confidence": confidence(source, state), "evidence_ids": ids, "financial_period": none if period is None else period, "always": lit(always, "boolean")}
    return F.struct(*(c.alias(n) for n, c in parts.items())).cast(_STRUCT)


def _ids(*named: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(when, f"ev-{module}") for module, when in named)))


def claims(profiles: DataFrame, observations: DataFrame) -> DataFrame:
    """(organisation_number, seq, sub, field, value, availability, confidence, evidence_ids, financial_period) in order of seq and sub.

    ``profiles(organisation_number, profile)``; ``observations(organisation_number, seq, id, platform, signal_type, source_class,
    sentiment_label, metrics)`` are resolved to this company already, ``metrics`` being JSON or null.
    """
    has = {m: _get(f"$.evidence.{m}", "variant").isNotNull() for m in ("registry", "registry_live", "accounting_obligation", "financials", "financial_history", "roles", "group", "locations", "website")}
    state = {m: F.when(has[m], availability(_get(f"$.evidence.{m}.status"))).otherwise("not_available") for m in has}
    source = {m: _get(f"$.evidence.{m}.source_class") for m in has}
    live = F.coalesce(_get("$.evidence.registry_live.status") == "available", F.lit(False))
    head = {**{f"h_{m}": c for m, c in has.items()}, **{f"s_{m}": c for m, c in state.items()}, **{f"c_{m}": c for m, c in source.items()}, "live": live}
    head |= {f"live_{f}": F.when(live, _said(f"$.evidence.registry_live.value.{f}")) for f, _ in REGISTRY_CLAIMS} | {f"bulk_{f}": _said(f"$.{f}") for f, _ in REGISTRY_CLAIMS}
    own = with_once(profiles, head)
    h, s, c = (lambda m: F.col(f"h_{m}")), (lambda m: F.col(f"s_{m}")), (lambda m: F.col(f"c_{m}"))
    one = lambda m: F.array(F.lit(f"ev-{m}"))
    rows = []
    for seq, (field, name) in enumerate(REGISTRY_CLAIMS, 1):
        now, bulk = F.col(f"live_{field}"), F.col(f"bulk_{field}")
        value = F.coalesce(now, bulk)
        state_of = F.when(value.isNotNull() & ((value != '""') if field != "employees" else F.lit(True)), "available").otherwise("not_available")
        ids = F.when(now.isNotNull(), _ids(("registry", h("registry")), ("registry_live", F.col("live")))).otherwise(_ids(("registry", h("registry"))))
        rows.append(_row(seq, name, value, state_of, F.when(now.isNotNull(), "official_registry_live").otherwise("official_registry_bulk"), ids))
    true = lambda path: F.coalesce(_get(path, "boolean"), F.lit(False))
    status = F.when(true("$.bankrupt"), '"bankrupt"').when(true("$.liquidating"), '"liquidating"').otherwise('"active"')
    rows.append(_row(8, "registration_status", status, F.when(h("registry") | F.col("live"), "available").otherwise("not_available"), "official_registry_bulk", _ids(("registry", h("registry")))))
    maybe = lambda when, row: F.when(when, row)
    m = "accounting_obligation"
    rows.append(maybe(h(m), _row(9, m, _said(f"$.evidence.{m}.value.classification"), s(m), c(m), one(m))))
    latest, m = "$.evidence.financials.value.records[0]", "financials"
    for i, (name, key) in enumerate(MEASURES):
        value = F.when(s(m) == "available", _said(f"{latest}.{key}"))
        there = value.isNotNull()
        rows.append(_row(10 + i, name, value, F.when(there, "available").when(s(m) == "available", "not_available").otherwise(s(m)), c(m), _ids((m, h(m))), F.when(there, _get(f"{latest}.period")), there))
    m = "financial_history"
    years = _said(f"$.evidence.{m}.value.years")
    some = years.isNotNull() & (years != "[]")
    rows.append(maybe(h(m), _row(17, "available_filing_years", years, F.when(some, s(m)).otherwise("not_available"), c(m), one(m))))
    m = "roles"
    kinds = "array<struct<name:string,role:string,`group`:string,inactive:boolean>>"
    people = F.filter(F.from_json(_said(f"$.evidence.{m}.value.roles"), kinds), lambda p: ~F.coalesce(p["inactive"], F.lit(False)))
    held = F.to_json(F.transform(people, lambda p: F.struct(p["name"].alias("name"), F.coalesce(F.nullif(p["role"], F.lit("")), p["group"]).alias("role"))))
    rows.append(maybe(h(m), _row(18, "role_holders", held, F.when(F.size(people) > 0, s(m)).otherwise("not_available"), c(m), one(m))))
    rows.append(maybe(h("group"), _row(19, "group_relationships", _said("$.evidence.group.value"), s("group"), c("group"), one("group"))))
    m = "locations"
    units = F.coalesce(F.size(_get(f"$.evidence.{m}.value.locations", "array<variant>")), F.lit(0))
    number = F.greatest(units, F.lit(0))
    rows.append(maybe(h(m), _row(20, "registered_subunit_count", number.cast("string"), s(m), c(m), one(m))))
    rows.append(maybe(h(m) & (s(m) == "available") & (number > 0), _row(21, "registered_subunits", _said(f"$.evidence.{m}.value.locations"), F.lit("available"), c(m), one(m))))
    m = "website"
    proved = true(f"$.evidence.{m}.value.identity_assessment.publishable")
    open_ = (s(m) == "available") & ~proved
    rows.append(maybe(h(m), _row(22, "verified_website", _said(f"$.evidence.{m}.value.final_url"), F.when(open_, "ambiguous").otherwise(s(m)), c(m), one(m))))
    shown = h(m) & (s(m) == "available") & proved
    for seq, part in ((23, "title"), (24, "description")):
        value = _said(f"$.evidence.{m}.value.{part}")
        rows.append(maybe(shown & value.isNotNull() & (value != '""'), _row(seq, f"website_{part}", value, F.lit("available"), "company_reported_claim", one(m))))
    links = F.coalesce(F.from_json(_said(f"$.evidence.{m}.value.social_links"), "array<struct<platform:string,url:string>>"), F.array().cast("array<struct<platform:string,url:string>>"))
    social = F.transform(links, lambda x, i: _row(25, F.concat(F.lit("social_profile_"), x["platform"]), F.concat(F.lit('"'), x["url"], F.lit('"')), F.lit("available"), "company_linked_social_profile", one(m), sub=i))
    every = F.concat(F.array_compact(F.array(*rows)), F.when(shown, social).otherwise(F.array().cast(f"array<{_STRUCT}>")))
    fixed = own.select("organisation_number", F.inline(every))
    seen = observations.where(F.coalesce("id", F.lit("")) != "").join(profiles.select("organisation_number"), "organisation_number", "left_semi")
    signal = F.coalesce(F.nullif("signal_type", F.lit("")), F.lit("external_signal"))
    said = F.to_json(F.struct("platform", "signal_type", F.try_parse_json("metrics").alias("metrics"), "sentiment_label"))
    nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy("seq", "id"))
    outside = seen.withColumn("_n", nth).select("organisation_number", _row(26, F.concat(F.lit("external_"), signal), said, F.lit("available"), F.col("source_class"), F.array("id"), always=True, sub=F.col("_n")).alias("r")).select("organisation_number", "r.*")
    again = F.row_number().over(Window.partitionBy("organisation_number", "field", "value", "always").orderBy("seq", "sub"))
    return fixed.unionByName(outside).withColumn("_n", again).where("always or _n = 1").drop("_n", "always")


def conflicts(profiles: DataFrame) -> DataFrame:
    """(organisation_number, field, live_value, bulk_value) of registry fields that both sources state and not alike; live stands."""
    live = _get("$.evidence.registry_live.status") == "available"
    rows = [F.struct(F.lit(f).alias("field"), _said(f"$.evidence.registry_live.value.{f}").alias("live_value"), _said(f"$.{f}").alias("bulk_value")) for f, _ in REGISTRY_CLAIMS if f != "website"]
    return profiles.where(live).select("organisation_number", F.inline(F.array(*rows))).where("live_value <> bulk_value")


def spaced(number: Column) -> Column:
    """A JSON number with spaces between thousands and two decimals where it is not whole; other text as it is."""
    n = number.try_cast("double")
    whole = n == F.floor(n)
    said = F.when(whole, F.format_number(n, 0)).otherwise(F.format_number(n, 2))
    return F.coalesce(F.replace(said, F.lit(","), F.lit(" ")), number)


def _first(long: DataFrame) -> DataFrame:
    """The first available claim of every field of a company."""
    nth = F.row_number().over(Window.partitionBy("organisation_number", "field").orderBy("seq", "sub"))
    return long.where("availability = 'available'").withColumn("_n", nth).where("_n = 1").drop("_n")


def summaries(long: DataFrame, names: DataFrame) -> DataFrame:
    """(organisation_number, summary, facts, evidence_ids): sentences of available claims only, with the evidence they rest on."""
    first = _first(long)
    plain = F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v"), F.col("value"))
    entry = F.struct("field", F.struct(plain.alias("value"), "evidence_ids", "financial_period"))
    by = first.groupBy("organisation_number").agg(F.map_from_entries(F.collect_list(entry)).alias("by"))
    own = names.select("organisation_number", "name").join(by, "organisation_number", "left")
    of = lambda f: F.try_element_at("by", F.lit(f))
    text = lambda f: F.nullif(of(f)["value"], F.lit(""))
    ids = lambda *fields: F.array_distinct(F.flatten(F.array(*(F.coalesce(of(f)["evidence_ids"], F.array().cast("array<string>")) for f in fields))))
    say = lambda when, said, *fields, also=None: F.when(when, F.struct(said.alias("text"), (also if also is not None else ids(*fields)).alias("ids")))
    lit = F.lit
    lead = F.concat(F.coalesce(F.nullif("name", lit("")), text("legal_name"), lit("This entity")), lit(" is a registered Norwegian entity"), F.coalesce(F.concat(lit(" of legal form "), text("legal_form")), lit("")), F.coalesce(F.concat(lit(", operating in "), text("industry_label")), lit("")), lit("."))
    names_of = lambda f: F.filter(F.transform(F.from_json(of(f)["value"], "array<struct<name:string>>"), lambda p: p["name"]), lambda n: F.coalesce(n, lit("")) != "")
    leaders = F.slice(names_of("role_holders"), 1, 3)
    period = F.coalesce(F.concat(lit(" for "), F.nullif(of("revenue")["financial_period"], lit(""))), lit(""))
    social = F.array_sort(F.filter(F.map_keys("by"), lambda k: k.startswith("social_profile_")))
    outside = F.array_sort(F.filter(F.map_keys("by"), lambda k: k.startswith("external_")))
    units = F.size(F.from_json(of("registered_subunits")["value"], "array<string>"))
    fixed = [
        say(of("legal_name").isNotNull() | of("legal_form").isNotNull() | of("industry_label").isNotNull(), lead, "legal_name", "legal_form", "industry_label"),
        say(text("registration_status").isNotNull() & (text("registration_status") != "active"), F.concat(lit("The registry records the entity as "), text("registration_status"), lit(".")), "registration_status"),
        say(text("municipality").isNotNull(), F.concat(lit("It is registered in the municipality of "), text("municipality"), lit(".")), "municipality"),
        say(of("registered_employees").isNotNull(), F.concat(lit("The registry reports "), spaced(text("registered_employees")), lit(" employees.")), "registered_employees"),
        say(of("revenue").isNotNull(), F.concat(lit("Latest reported revenue is NOK "), spaced(text("revenue")), period, lit(".")), "revenue"),
        say(of("annual_result").isNotNull(), F.concat(lit("The latest reported annual result is NOK "), spaced(text("annual_result")), lit(".")), "annual_result"),
        say(F.size(leaders) > 0, F.concat(lit("Registered role holders include "), F.array_join(leaders, ", "), lit(".")), "role_holders"),
        say(text("verified_website").isNotNull(), F.concat(lit("Its verified official website is "), text("verified_website"), lit(".")), "verified_website"),
        say(F.size(social) > 0, F.concat(lit("Verified social profiles were found on "), F.array_join(F.transform(social, lambda k: F.replace(k, lit("social_profile_"))), ", "), lit(".")), also=F.array_distinct(F.flatten(F.transform(social, lambda k: F.try_element_at("by", k)["evidence_ids"])))),
        say(units > 0, F.concat(lit("It has "), units.cast("string"), lit(" registered subunit(s).")), "registered_subunits"),
    ]
    signals = F.transform(outside, lambda k: F.struct(F.concat(lit("An independently verified external signal was recorded ("), F.replace(k, lit("external_")), lit(").")).alias("text"), F.try_element_at("by", k)["evidence_ids"].alias("ids")))
    none = F.array().cast("array<struct<text:string,ids:array<string>>>")
    said = with_once(own, {"sentences": F.concat(F.array_compact(F.array(*fixed)), F.coalesce(signals, none))})
    return said.select("organisation_number", F.array_join(F.transform("sentences", lambda x: x["text"]), " ").alias("summary"), F.size("sentences").alias("facts"), F.array_distinct(F.flatten(F.transform("sentences", lambda x: x["ids"]))).alias("evidence_ids"))


def sections(long: DataFrame, changes: DataFrame, records: DataFrame) -> DataFrame:
    """(organisation_number, section, ix, label, value, evidence_ids): facts, people, hiring, public activity, recent changes, unknown
    fields and sources. ``changes`` as ``profile_diff`` gives them; ``records(organisation_number, place, source_url)`` in order."""
    first = _first(long)
    key, none = "organisation_number", F.array().cast("array<string>")
    table = [(s, i, f, label) for s, facts in FACTS.items() for i, (f, label) in enumerate(facts)]
    facts = first.join(F.broadcast(long.sparkSession.createDataFrame(table, "section string, ix int, field string, label string")), "field")
    facts = facts.select(key, "section", "ix", "label", "value", "evidence_ids")
    people = first.where("field = 'role_holders'").select(key, "evidence_ids", F.posexplode(F.from_json("value", "array<struct<name:string,role:string>>")).alias("ix", "p"))
    people = people.where("coalesce(p.name, '') <> ''").select(key, F.lit("PEOPLE").alias("section"), "ix", F.col("p.name").alias("label"), F.col("p.role").alias("value"), "evidence_ids")
    outside = long.where("availability = 'available' and startswith(field, 'external_')")
    job = F.col("field") == "external_job_posting"
    nth = F.row_number().over(Window.partitionBy(key, job).orderBy("seq", "sub")) - 1
    activity = outside.select(key, F.when(job, "HIRING").otherwise("PUBLIC_ACTIVITY").alias("section"), nth.alias("ix"), F.col("field").alias("label"), "value", "evidence_ids")
    changed = changes.select(key, F.lit("RECENT_CHANGES").alias("section"), F.col("field_ix").alias("ix"), F.col("field").alias("label"), F.to_json(F.struct("old_value", "new_value", "source_url", "retrieved_at"), {"ignoreNullFields": "false"}).alias("value"), none.alias("evidence_ids"))
    unknown = long.where(F.col("availability").isin("not_available", "blocked", "ambiguous", "failed")).select(key, "field").distinct()
    unknown = unknown.select(key, F.lit("UNKNOWN").alias("section"), (F.row_number().over(Window.partitionBy(key).orderBy("field")) - 1).alias("ix"), F.col("field").alias("label"), F.lit(None).cast("string").alias("value"), none.alias("evidence_ids"))
    urls = records.where("coalesce(source_url, '') <> ''").groupBy(key, "source_url").agg(F.min("place").alias("place"))
    listed = urls.select(key, F.lit("SOURCES").alias("section"), (F.row_number().over(Window.partitionBy(key).orderBy("place")) - 1).alias("ix"), F.col("source_url").alias("label"), F.lit(None).cast("string").alias("value"), none.alias("evidence_ids"))
    parts = [facts, people, activity, changed, unknown, listed]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def records(profiles: DataFrame, observations: DataFrame) -> DataFrame:
    """(organisation_number, place, source_url): evidence in order, modules by name, then observations."""
    modules = profiles.select("organisation_number", F.variant_get("profile", "$.evidence", "map<string,variant>").alias("e")).select("organisation_number", F.explode("e").alias("module", "r"))
    own = modules.select("organisation_number", F.struct(F.lit(0).alias("part"), F.col("module").alias("name"), F.lit(0).cast("long").alias("seq")).alias("place"), F.try_variant_get("r", "$.source_url", "string").alias("source_url"))
    seen = observations.where(F.coalesce("id", F.lit("")) != "").join(profiles.select("organisation_number"), "organisation_number", "left_semi")
    return own.unionByName(seen.select("organisation_number", F.struct(F.lit(1).alias("part"), F.lit("").alias("name"), F.col("seq").alias("seq")).alias("place"), "source_url"))


# --- bindings -----------------------------------------------------------------------------------------------------------

#: SQL of a profile's parts for both engines; k is the company's place, org its number, null leaves a part out.
_RECORD = lambda module, status, cls, value: f"""concat('"{module}":{{"source_url":"https://{module}.example/', org, '","source_class":"{cls}","status":"', {status}, '","value":', {value}, '}}')"""
_MONEY = """concat('{"records":[{"period":"2023","revenue":', cast(k * 1000 as {S}), ',"operating_result":', case when k % 4 = 0 then 'null' else cast(k as {S}) end, ',"annual_result":', case when k % 2 = 0 then '-12.25' else '0' end, ',"assets":5000,"equity":', cast(k % 10 as {S}), '},{"period":"2022","debt":1}]}')"""
_PARTS = {
    "registry": (_RECORD("registry", "'available'", "official_registry_bulk", "'{}'"), "k % 13 <> 0"),
    "registry_live": (_RECORD("registry_live", "case when k % 4 = 0 then 'source_error' else 'available' end", "official_registry_live", """concat('{"name":"', case when k % 6 = 0 then 'Live ' else 'Firm ' end, org, '","employees":', case when k % 5 = 0 then '7' else 'null' end, '}')"""), "k % 3 = 0"),
    "accounting_obligation": (_RECORD("accounting_obligation", "'available'", "official_rule_interpretation", """'{"classification":"required"}'"""), "k % 2 = 0"),
    "financials": (_RECORD("financials", "case k % 5 when 1 then 'blocked' when 2 then 'source_error' else 'available' end", "official_annual_accounts", _MONEY), "k % 5 <> 0"),
    "financial_history": (_RECORD("financial_history", "'available'", "official_annual_account_copies", """case when k % 8 = 1 then '{"years":[]}' else '{"years":["2022","2023"]}' end"""), "k % 4 = 1"),
    "roles": (_RECORD("roles", "'available'", "official_roles", """case when k % 7 = 1 then '{"roles":[{"name":"Gone","inactive":true}]}' else '{"roles":[{"name":"A B","role":"CEO"},{"name":"Gone","role":"X","inactive":true},{"name":"C D","group":"BOARD"}]}' end"""), "k % 7 <> 0"),
    "group": (_RECORD("group", "case when k % 2 = 0 then 'available' else 'not_applicable' end", "official_group_structure", """'{"parent":"P"}'"""), "k % 9 < 4"),
    "locations": (_RECORD("locations", "case when k % 3 = 2 then 'not_found' else 'available' end", "official_subunits", """case when k % 3 = 0 then '{"locations":[]}' else '{"locations":[{"unit":"1"},{"unit":"2"}]}' end"""), "k % 10 <> 0"),
    "website": (_RECORD("website", "case when k % 11 = 1 then 'blocked' else 'available' end", "registry_linked_company_website", """concat('{"final_url":"https://f', org, '.no/","title":"', case when k % 2 = 0 then 'Title' else '' end, '","description":"Says","identity_assessment":{"publishable":', case when k % 3 = 0 then 'false' else 'true' end, '},"social_links":[{"platform":"x","url":"https://x.com/a"},{"platform":"x","url":"https://x.com/a"},{"platform":"facebook","url":"https://facebook.com/b"}]}')"""), "k % 11 <> 0"),
}
_TOP = """concat('{"name":"Firm ', org, '","legal_form":', case when k % 17 = 0 then 'null' else '"AS"' end, ',"municipality":"', case when k % 19 = 0 then '' else 'OSLO' end, '","industry_code":"62.010","industry_label":"software","employees":', case when k % 4 = 0 then 'null' else cast(k % 3 * 1000 as {S}) end, ',"bankrupt":', case when k % 23 = 0 then 'true' else 'false' end, ',"liquidating":', case when k % 29 = 0 then 'true' else 'false' end, ',"website":', case when k % 2 = 0 then 'null' else '"www.f.no"' end, ',"evidence":{')"""


def _profile_sql() -> str:
    parts = ", ".join(f"case when {when} then {text} end" for text, when in _PARTS.values())
    return f"concat({_TOP}, concat_ws(',', {parts}), '}}}}')"


def _profiles(s, d):
    own = dealt(bind(s, d, "registry").select("organisation_number"), "organisation_number").select(F.col("organisation_number"), F.col("organisation_number").alias("org"), (F.col("organisation_number").cast("bigint") - 900000000).alias("k"))
    return own.select("organisation_number", F.parse_json(F.expr(_profile_sql().replace("{S}", "string"))).alias("profile"))


def _observations(s, d):
    own = bind(s, d, "observations").where("seq % 3 = 0")
    return own.select("organisation_number", "seq", "id", "platform", "signal_type", "source_class", "source_url", "sentiment_label", F.when(F.col("seq") % 2 == 0, F.concat(F.lit('{"likes":'), F.col("likes"), F.lit("}"))).alias("metrics"))


def _claims(s, d):
    return claims(_profiles(s, d), _observations(s, d))


def _flat(frame):
    return frame.withColumn("evidence_ids", F.array_join("evidence_ids", ","))


def _summaries(s, d):
    names = bind(s, d, "registry").select("organisation_number", F.concat(F.lit("Firm "), "organisation_number").alias("name"))
    return _flat(summaries(_claims(s, d), names))


def _changes(s, d):
    k = F.col("organisation_number").cast("bigint")
    own = bind(s, d, "registry").where(k % 12 == 0)
    return own.select("organisation_number", F.lit(2).alias("field_ix"), F.lit("registry.employees").alias("field"), F.lit(None).cast("string").alias("old_value"), F.lit("0").alias("new_value"), F.lit("https://registry.example/").alias("source_url"), F.lit("2026").alias("retrieved_at"))


def _sections(s, d):
    return _flat(sections(_claims(s, d), _changes(s, d), records(_profiles(s, d), _observations(s, d))))


def _claims_sql() -> str:
    conf = {"official_registry_bulk": 0.99, "official_registry_live": 0.99, "official_rule_interpretation": 0.9, "official_annual_accounts": 0.98, "official_annual_account_copies": 0.97, "official_roles": 0.97, "official_group_structure": 0.97, "official_subunits": 0.97, "registry_linked_company_website": 0.9, "company_reported_claim": 0.85, "company_linked_social_profile": 0.9}
    arms = []

    def arm(seq, field, value, state, cls, ids, where="true", sub="0", period="null"):
        score = f"case when ({state}) = 'available' then {conf[cls] if cls in conf else cls} end"
        arms.append(f"select organisation_number, {seq} as seq, {sub} as sub, '{field}' as field, case when ({state}) = 'available' then {value} end as value, {state} as availability, cast({score} as double) as confidence, {ids} as evidence_ids, cast({period} as varchar) as financial_period from c where {where}")

    live = "k % 3 = 0 and k % 4 <> 0"
    bulk_id, both = "case when k % 13 <> 0 then 'ev-registry' else '' end", "case when k % 13 <> 0 then 'ev-registry,ev-registry_live' else 'ev-registry_live' end"
    arm(1, "legal_name", f"""case when {live} and k % 6 = 0 then '"Live ' else '"Firm ' end || org || '"'""", "'available'", "official_registry_bulk", f"case when {live} then {both} else {bulk_id} end")
    arm(2, "legal_form", "'\"AS\"'", "case when k % 17 = 0 then 'not_available' else 'available' end", "official_registry_bulk", bulk_id)
    arm(3, "municipality", "'\"OSLO\"'", "case when k % 19 = 0 then 'not_available' else 'available' end", "official_registry_bulk", bulk_id)
    arm(4, "industry_code", "'\"62.010\"'", "'available'", "official_registry_bulk", bulk_id)
    arm(5, "industry_label", "'\"software\"'", "'available'", "official_registry_bulk", bulk_id)
    said = f"{live} and k % 5 = 0"
    arm(6, "registered_employees", f"case when {said} then '7' else cast(k % 3 * 1000 as varchar) end", f"case when k % 4 = 0 and not ({said}) then 'not_available' else 'available' end", "official_registry_bulk", f"case when {said} then {both} else {bulk_id} end")
    arm(7, "registered_website", "'\"www.f.no\"'", "case when k % 2 = 0 then 'not_available' else 'available' end", "official_registry_bulk", bulk_id)
    arm(8, "registration_status", "case when k % 23 = 0 then '\"bankrupt\"' when k % 29 = 0 then '\"liquidating\"' else '\"active\"' end", f"case when k % 13 <> 0 or {live} then 'available' else 'not_available' end", "official_registry_bulk", bulk_id)
    arm(9, "accounting_obligation", "'\"required\"'", "'available'", "official_rule_interpretation", "'ev-accounting_obligation'", "k % 2 = 0")
    money = {"revenue": "cast(k * 1000 as varchar)", "operating_result": "case when k % 4 <> 0 then cast(k as varchar) end", "profit_before_tax": "null", "annual_result": "case when k % 2 = 0 then '-12.25' else '0' end", "total_assets": "'5000'", "equity": "cast(k % 10 as varchar)", "debt": "null"}
    for i, (name, value) in enumerate(money.items()):
        arm(10 + i, name, value, f"case k % 5 when 0 then 'not_available' when 1 then 'blocked' when 2 then 'failed' else case when {value} is null then 'not_available' else 'available' end end", "official_annual_accounts", "case when k % 5 = 0 then '' else 'ev-financials' end", period=f"case when k % 5 > 2 and {value} is not null then '2023' end")
    arm(17, "available_filing_years", "'[\"2022\",\"2023\"]'", "case when k % 8 = 1 then 'not_available' else 'available' end", "official_annual_account_copies", "'ev-financial_history'", "k % 4 = 1")
    arm(18, "role_holders", """'[{"name":"A B","role":"CEO"},{"name":"C D","role":"BOARD"}]'""", "case when k % 7 = 1 then 'not_available' else 'available' end", "official_roles", "'ev-roles'", "k % 7 <> 0")
    arm(19, "group_relationships", """'{"parent":"P"}'""", "case when k % 2 = 0 then 'available' else 'not_applicable' end", "official_group_structure", "'ev-group'", "k % 9 < 4")
    arm(20, "registered_subunit_count", "case when k % 3 = 0 then '0' else '2' end", "case when k % 3 = 2 then 'not_available' else 'available' end", "official_subunits", "'ev-locations'", "k % 10 <> 0")
    arm(21, "registered_subunits", """'[{"unit":"1"},{"unit":"2"}]'""", "'available'", "official_subunits", "'ev-locations'", "k % 10 <> 0 and k % 3 = 1")
    arm(22, "verified_website", "'\"https://f' || org || '.no/\"'", "case when k % 11 = 1 then 'blocked' when k % 3 = 0 then 'ambiguous' else 'available' end", "registry_linked_company_website", "'ev-website'", "k % 11 <> 0")
    shown = "k % 11 > 1 and k % 3 <> 0"
    arm(23, "website_title", "'\"Title\"'", "'available'", "company_reported_claim", "'ev-website'", f"{shown} and k % 2 = 0")
    arm(24, "website_description", "'\"Says\"'", "'available'", "company_reported_claim", "'ev-website'", shown)
    arm(25, "social_profile_x", "'\"https://x.com/a\"'", "'available'", "company_linked_social_profile", "'ev-website'", shown)
    arm(25, "social_profile_facebook", "'\"https://facebook.com/b\"'", "'available'", "company_linked_social_profile", "'ev-website'", shown, sub="2")
    arms.append("""select organisation_number, 26, row_number() over (partition by organisation_number order by seq, id), 'external_' || signal_type, '{"platform":"' || platform || '","signal_type":"' || signal_type || '"' || case when seq % 2 = 0 then ',"metrics":{"likes":' || likes || '}' else '' end || case when sentiment_label is not null then ',"sentiment_label":"' || sentiment_label || '"' else '' end || '}',
 'available', case source_class when 'company_site' then 0.75 else 0.75 end, id, null from observations where seq % 3 = 0 and organisation_number in (select organisation_number from registry)""")
    return f"""{ctes("registry", "observations")}, c as (select organisation_number, organisation_number as org, cast(organisation_number as bigint) - 900000000 as k from registry), cl as ({" union all ".join(arms)})"""


def _sections_sql() -> str:
    facts = ", ".join(f"('{s}', {i}, '{f}', '{label}')" for s, own in FACTS.items() for i, (f, label) in enumerate(own))
    urls = " union all ".join(f"select organisation_number, 0 as part, '{m}' as name, 0 as seq, 'https://{m}.example/' || org as url from c where {when}" for m, (_, when) in _PARTS.items())
    return f"""{_claims_sql()}, facts(section, ix, field, label) as (values {facts}), u as ({urls} union all select organisation_number, 1, '', seq, source_url from observations where seq % 3 = 0 and organisation_number in (select organisation_number from registry)),
 f as (select organisation_number, url, min((part, name, seq)) as place from u group by all)
 select organisation_number, section, cast(ix as int) as ix, label, value, evidence_ids from cl join facts using (field) where availability = 'available'
 union all select organisation_number, 'PEOPLE', i, n, r, 'ev-roles' from cl, (values (0, 'A B', 'CEO'), (1, 'C D', 'BOARD')) p(i, n, r) where field = 'role_holders' and availability = 'available'
 union all select organisation_number, case when field = 'external_job_posting' then 'HIRING' else 'PUBLIC_ACTIVITY' end, cast(row_number() over (partition by organisation_number, field = 'external_job_posting' order by sub) - 1 as int), field, value, evidence_ids from cl where seq = 26
 union all select organisation_number, 'RECENT_CHANGES', 2, 'registry.employees', '{{"old_value":null,"new_value":"0","source_url":"https://registry.example/","retrieved_at":"2026"}}', '' from registry where cast(organisation_number as bigint) % 12 = 0
 union all select organisation_number, 'UNKNOWN', cast(row_number() over (partition by organisation_number order by field) - 1 as int), field, null, '' from cl where availability in ('not_available', 'blocked', 'ambiguous', 'failed')
 union all select organisation_number, 'SOURCES', cast(row_number() over (partition by organisation_number order by place) - 1 as int), url, null, '' from f"""


_SUMMARY_SQL = """, e as (select organisation_number, list_sort(list(distinct field[10:])) as kinds from cl where seq = 26 group by 1),
 v as (select c.*, a.value as revenue, b.value as result, n.value as employees, kinds from c left join cl a on a.organisation_number = c.organisation_number and a.field = 'revenue' left join cl b on b.organisation_number = c.organisation_number and b.field = 'annual_result'
  left join cl n on n.organisation_number = c.organisation_number and n.field = 'registered_employees' left join e on e.organisation_number = c.organisation_number),
 t as (select organisation_number, list_filter([
  'Firm ' || org || ' is a registered Norwegian entity' || case when k % 17 <> 0 then ' of legal form AS' else '' end || ', operating in software.', case when (k % 13 <> 0 or k % 3 = 0 and k % 4 <> 0) and (k % 23 = 0 or k % 29 = 0) then 'The registry records the entity as ' || case when k % 23 = 0 then 'bankrupt' else 'liquidating' end || '.' end,
  case when k % 19 <> 0 then 'It is registered in the municipality of OSLO.' end, 'The registry reports ' || replace(format('{:,}', cast(employees as bigint)), ',', ' ') || ' employees.', 'Latest reported revenue is NOK ' || replace(format('{:,}', cast(revenue as bigint)), ',', ' ') || ' for 2023.', 'The latest reported annual result is NOK ' || result || '.',
  case when k % 7 > 1 then 'Registered role holders include A B, C D.' end, case when k % 11 > 1 and k % 3 <> 0 then 'Its verified official website is https://f' || org || '.no/.' end, case when k % 11 > 1 and k % 3 <> 0 then 'Verified social profiles were found on facebook, x.' end, case when k % 10 <> 0 and k % 3 = 1 then 'It has 2 registered subunit(s).' end], lambda x: x is not null) as said,
  list_transform(coalesce(kinds, []), lambda x: 'An independently verified external signal was recorded (' || x || ').') as signals from v)
 select organisation_number, array_to_string(list_concat(said, signals), ' ') as summary, cast(len(said) + len(signals) as int) as facts from t"""
QUERIES = {
    "profile_claims": (lambda s, d: _flat(_claims(s, d)), f"{_claims_sql()} select organisation_number, cast(seq as int) as seq, cast(sub as int) as sub, field, value, availability, confidence, evidence_ids, financial_period from cl"),
    "profile_conflicts": (lambda s, d: conflicts(_profiles(s, d)), f"""{_claims_sql()} select organisation_number, 'name' as field, '"Live ' || org || '"' as live_value, '"Firm ' || org || '"' as bulk_value from c where k % 12 = 6
 union all select organisation_number, 'employees', '7', cast(k % 3 * 1000 as varchar) from c where k % 15 = 0 and k % 4 <> 0"""),
    "profile_summaries": (lambda s, d: _summaries(s, d).drop("evidence_ids"), _claims_sql() + _SUMMARY_SQL),
    "profile_sections": (_sections, _sections_sql()),
}
