"""Structural diff of whole profiles (REF-02..05): sixteen fields, nested values in a canonical form, hashes of both sides.

A profile is a VARIANT. Every tracked value is walked by a recursive query to its leaves; a leaf's canonical text and the names
and places above it make its entry, and a value is the sorted list of its entries. Names of members are in no order, places in
a list are, but for declared social links, whose order says nothing: there an item's entries stand for its place. The
difference is then one join of (company, field) on these lists. Events carry the raw values as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.frames import dealt
from dossier.functions.text import canonical_url, collapse
from dossier.operators.refresh import membership_gap

#: Tracked fields and where a profile has them.
TRACKED = {
    "registry.name": ("name",), "registry.legal_form": ("legal_form",), "registry.employees": ("employees",), "registry.municipality": ("municipality",), "registry.website": ("website",),
    "registry.latest_submitted_accounts": ("latest_submitted_accounts",), "financials.records": ("evidence", "financials", "value", "records"), "financial_history.years": ("evidence", "financial_history", "value", "years"),
    "roles.roles": ("evidence", "roles", "value", "roles"), "locations.locations": ("evidence", "locations", "value", "locations"), "website.title": ("evidence", "website", "value", "title"),
    "website.description": ("evidence", "website", "value", "description"), "website.social_links": ("evidence", "website", "value", "social_links"), "external_footprint.review_count": ("external_metrics", "review_count"),
    "external_footprint.active_job_count": ("external_metrics", "active_job_count"), "external_footprint.public_item_count": ("external_metrics", "public_item_count"),
}
#: A list's order says nothing in fields that end so.
UNORDERED = "social_links"
DEEPEST = 60


def _at(path: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{p}']" for p in path)


def _get(path: tuple[str, ...], kind: str = "variant") -> Column:
    return F.try_variant_get("profile", _at(path), kind)


def tracked_values(profiles: DataFrame) -> DataFrame:
    """(organisation_number, field, value) of ``profiles(organisation_number, profile)``; fields that are missing or null have no row."""
    rows = [F.struct(F.lit(field).alias("field"), _get(path).alias("value")) for field, path in TRACKED.items()]
    return profiles.select("organisation_number", F.inline(F.array(*rows))).where("value is not null and not is_variant_null(value)")


def canonical_leaf(field: Column, value: Column) -> Column:
    """Kind and canonical text of a value without members: URLs one way, other text with its white space collapsed."""
    kind = F.schema_of_variant(value)
    text = F.trim(F.try_variant_get(value, "$", "string"))
    url = field.endswith("website") | field.endswith(UNORDERED) | text.rlike(r"(?i)^https?://") | text.startswith("www.")
    number = F.try_variant_get(value, "$", "double")
    said = F.when(kind == "STRING", F.concat(F.lit("s"), F.when(url, canonical_url(text)).otherwise(collapse(text))))
    said = said.when(kind.startswith("OBJECT"), "{").when(kind.startswith("ARRAY"), "[").when(kind == "VOID", "null").when(kind == "BOOLEAN", F.concat(F.lit("b"), text))
    return said.otherwise(F.concat(F.lit("n"), number.cast("string")))


def canonical_values(profiles: DataFrame) -> DataFrame:
    """(organisation_number, field, canonical): a string that two values share where they differ in nothing that is material."""
    values = tracked_values(profiles)
    spark = profiles.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    leaves = spark.sql(
        f"""with recursive walk(organisation_number, field, of, at, item, value, depth) as (
        select organisation_number, field, field, cast('' as string), cast(null as int), value, 0 from {{values}}
        union all
        select w.organisation_number, w.field, case when e.key is null then w.of else concat(w.of, '.', e.key) end,
          case when e.key is not null then concat(w.at, '.', length(e.key), ':', e.key) when w.depth = 0 and endswith(w.field, '{UNORDERED}') then w.at else concat(w.at, '[', lpad(cast(e.pos as string), 9, '0')) end,
          case when w.depth = 0 and e.key is null then e.pos else w.item end, e.value, w.depth + 1
        from walk w, lateral variant_explode(w.value) e where w.depth < {DEEPEST})
        select * from walk""",
        values=values,
    )
    keys = ["organisation_number", "field"]
    entries = leaves.select(*keys, "item", F.concat("at", F.lit("="), canonical_leaf(F.col("of"), F.col("value"))).alias("entry"))
    joined = lambda of: F.array_join(F.transform(F.array_sort(F.collect_list(of)), lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)), "")
    items = entries.groupBy(*keys, "item").agg(joined("entry").alias("text"))
    place = F.when(F.col("field").endswith(UNORDERED), "").otherwise(F.lpad(F.coalesce(F.col("item"), F.lit(-1)).cast("string"), 9, "0"))
    return items.groupBy(*keys).agg(joined(F.concat(place, F.lit("|"), "text")).alias("canonical"))


def _evidence(field: str) -> Column:
    """The evidence record that speaks for a field's module; for the registry the live one where there is one."""
    module = field.split(".", 1)[0]
    record = _get(("evidence", module))
    return F.coalesce(_get(("evidence", "registry_live")), record) if module == "registry" else record


def _told(profiles: DataFrame, name: str) -> DataFrame:
    """Per company and field the raw value as JSON and what its evidence says."""
    said = lambda record, *names: F.coalesce(*(F.try_variant_get(record, f"$['{n}']", "string") for n in names))
    rows = []
    for i, (field, path) in enumerate(TRACKED.items()):
        record, value = _evidence(field), _get(path)
        facts = {"source_url": said(record, "source_url"), "retrieved_at": said(record, "retrieved_at"), "effective_at": said(record, "effective_at", "as_of"), "source_class": said(record, "source_class", "source_type"), "content_sha256": said(record, "content_sha256"), "status": said(record, "status")}
        raw = F.when(value.isNotNull() & ~F.is_variant_null(value), F.to_json(value))
        rows.append(F.struct(F.lit(i).alias("ix"), F.lit(field).alias("field"), F.struct(raw.alias("raw"), *(c.alias(n) for n, c in facts.items())).alias(name)))
    return profiles.select("organisation_number", F.inline(F.array(*rows)))


def diff_profiles(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Change events between two versions of ``profiles(organisation_number, profile)`` of the same companies.

    Raises ValueError where a company is on one side only: profiles of different companies are never compared.
    """
    if gap := membership_gap(previous, current).count():
        raise ValueError(f"{gap} companies are on one side only")
    keys = ["organisation_number", "field"]
    old, new = canonical_values(previous).withColumnRenamed("canonical", "a"), canonical_values(current).withColumnRenamed("canonical", "b")
    changed = old.join(new, keys, "full_outer").where("not (a <=> b)").select(*keys)
    held = changed.join(_told(previous, "o").drop("ix"), keys).join(_told(current, "n"), keys)
    return held.select("organisation_number", F.col("ix").alias("field_ix"), "field", F.col("o.raw").alias("old_value"), F.col("n.raw").alias("new_value"), "n.source_url", "n.retrieved_at", "n.effective_at", "n.source_class", F.col("o.content_sha256").alias("old_content_sha256"), F.col("n.content_sha256").alias("new_content_sha256"), "n.status")


# --- bindings -----------------------------------------------------------------------------------------------------------

#: Per field: old value, a new one that says the same, a new one that differs; JSON texts in which § is the company's number.
_VERSIONS = {
    "registry.name": ('"Firm § AS"', '" Firm  § AS "', '"Firm § ASA"'), "registry.legal_form": ('"AS"', '"AS"', '"ASA"'), "registry.employees": ("null", "null", "0"), "registry.municipality": ('"OSLO"', '"OSLO\\t"', '"BERGEN"'),
    "registry.website": ('"https://www.f§.no/a/?b=2&a=1"', '"HTTPS://f§.no/a?utm_source=x&a=1&b=2#top"', '"https://f§.no/b"'), "registry.latest_submitted_accounts": ('"2023"', '"2023"', '"2024"'),
    "financials.records": ('[{"period":2022,"revenue":1.5},{"period":2023,"revenue":§}]', '[{"revenue":1.5,"period":2022},{"revenue":§,"period":2023.0}]', '[{"period":2023,"revenue":§},{"period":2022,"revenue":1.5}]'),
    "financial_history.years": ("[2021,2022]", "[2021,2022]", "[2022,2021]"), "roles.roles": ('[{"name":"A  B","who":{"code":"DAGL"}}]', '[{"name":"A B ","who":{"code":"DAGL"}}]', '[{"name":"A  B","who":{"code":"LEDE"}}]'),
    "locations.locations": ("[]", "[]", '[{"unit":"§"}]'), "website.title": ('"Title"', '"Title"', "null"), "website.description": ('"www.f§.no"', '"www.f§.no"', '"text"'),
    "website.social_links": ('[{"platform":"x","url":"https://x.com/f§"},{"platform":"linkedin","url":"https://www.linkedin.com/company/f§/"}]', '[{"platform":"linkedin","url":"https://linkedin.com/company/f§"},{"url":"https://x.com/f§","platform":"x"}]', '[{"platform":"x","url":"https://x.com/f§"}]'),
    "external_footprint.review_count": ("3", "3.0", "4"), "external_footprint.active_job_count": ("1", "1", '"1"'), "external_footprint.public_item_count": ("false", "false", "0"),
}


def _profile(version: dict[str, str]) -> str:
    """A profile's JSON with ``version[field]`` at every field."""
    v = lambda field: version[field]
    said = lambda module, value: f'"{module}":{{"value":{{{value}}},"source_url":"https://{module}.example/§","retrieved_at":"2026-08-0@","as_of":"2025","source_type":"{module}_class","content_sha256":"{module}-@","status":"available"}}'
    own = [f'"{f.split(".")[1]}":{v(f)}' for f in TRACKED if f.startswith("registry.")]
    lists = [said(f.split(".")[0], f'"{TRACKED[f][-1]}":{v(f)}') for f in ("financials.records", "financial_history.years", "roles.roles", "locations.locations")]
    site = said("website", ",".join(f'"{f.split(".")[1]}":{v(f)}' for f in TRACKED if f.startswith("website.")))
    outside = ",".join(f'"{f.split(".")[1]}":{v(f)}' for f in TRACKED if f.startswith("external_"))
    return "{" + ",".join(own) + ',"evidence":{' + ",".join([said("registry", ""), *lists, site]) + "}," + f'"external_metrics":{{{outside}}}' + "}"


def _filled(text: str, day: int) -> str:
    """SQL of ``text`` with the company's number and day in it, for both engines."""
    return "replace('" + text.replace("@", str(day)).replace("\\", "\\\\") + "', '§', organisation_number)"


def _versions() -> tuple[str, list[str]]:
    """SQL of the old profile, and of the new ones: the last says the same everywhere, each other differs in one field."""
    old = {f: v[0] for f, v in _VERSIONS.items()}
    same = {f: v[1] for f, v in _VERSIONS.items()}
    return _filled(_profile(old), 1), [_filled(_profile({**same, f: v[2]}), 2) for f, v in _VERSIONS.items()] + [_filled(_profile(same), 2)]


_TURN = f"cast(organisation_number as bigint) % {len(_VERSIONS) + 1}"


def versions(s, d):
    old, new = _versions()
    chosen = f"case {_TURN} {' '.join(f'when {i} then {text}' for i, text in enumerate(new))} end"
    own = dealt(bind(s, d, "registry").select("organisation_number"), "organisation_number")
    return tuple(own.select("organisation_number", F.parse_json(F.expr(x)).alias("profile")) for x in (old, chosen))


def _sql() -> str:
    arms = []
    for i, (field, (old, _, new)) in enumerate(_VERSIONS.items()):
        module = field.split(".")[0]
        value = lambda x: "cast(null as varchar)" if x == "null" else "replace('" + x.replace("\\t", "\t") + "', '§', organisation_number)"
        known = module != "external_footprint"
        fact = lambda x: f"replace('{x}', '§', organisation_number)" if known else "cast(null as varchar)"  # noqa: B023, E731
        arms.append(f"""select organisation_number, cast({i} as int) as field_ix, '{field}' as field, {value(old)} as old_value, {value(new)} as new_value, {fact(f"https://{module}.example/§")} as source_url, {fact("2026-08-02")} as retrieved_at, {fact("2025")} as effective_at,
 {fact(module + "_class")} as source_class, {fact(module + "-1")} as old_content_sha256, {fact(module + "-2")} as new_content_sha256, {fact("available")} as status from registry where {_TURN} = {i}""")
    return f"{ctes('registry')} " + " union all ".join(arms)


QUERIES = {
    "profile_diff": (lambda s, d: diff_profiles(*versions(s, d)), _sql()),
    "profile_diff_fields": (lambda s, d: diff_profiles(*versions(s, d)).groupBy("field").agg(F.count("*").alias("n")), f"with d as ({_sql()}) select field, count(*) as n from d group by field"),
}
