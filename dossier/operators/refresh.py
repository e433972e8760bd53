"""Snapshot refresh: canonical values, diffs and replay metrics (REF-01..05, PRJ-10, AGG-16, JON-05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import canonical_url, collapse

#: Tracked fields in order, and whether their values are URLs.
TRACKED = (("name", False), ("legal_form", False), ("employees", False), ("municipality", False), ("website", True), ("latest_submitted_accounts", False))


def canonical(field: str, is_url: bool) -> Column:
    c = F.col(field).cast("string")
    return canonical_url(c) if is_url else collapse(c)


def field_rows(profiles: DataFrame) -> DataFrame:
    """(organisation_number, ix, field, raw, canonical): one row per tracked field, unpivoted in a single pass."""
    rows = [F.struct(F.lit(i).alias("ix"), F.lit(f"registry.{f}").alias("field"), F.col(f).cast("string").alias("raw"), canonical(f, u).alias("canonical")) for i, (f, u) in enumerate(TRACKED)]
    return profiles.select("organisation_number", F.inline(F.array(*rows)))


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """A row per field whose canonical value differs, null-safe; raw values of both sides. One join on the company."""
    pack = lambda df, name: df.select("organisation_number", F.struct(*(F.struct(F.col(f).cast("string").alias("raw"), canonical(f, u).alias("can")).alias(f) for f, u in TRACKED)).alias(name))
    both = pack(old, "o").join(pack(new, "n"), "organisation_number")
    events = [F.when(~F.col(f"o.{f}.can").eqNullSafe(F.col(f"n.{f}.can")), F.struct(F.lit(i).alias("field_ix"), F.lit(f"registry.{f}").alias("field"), F.col(f"o.{f}.raw").alias("old_value"), F.col(f"n.{f}.raw").alias("new_value"))) for i, (f, _) in enumerate(TRACKED)]
    return both.select("organisation_number", F.inline(F.filter(F.array(*events), lambda e: e.isNotNull())))


def membership_gap(old: DataFrame, new: DataFrame) -> DataFrame:
    """Companies on one side only; a data-set diff asks for none."""
    o, n = old.select("organisation_number", F.lit(True).alias("o")), new.select("organisation_number", F.lit(True).alias("n"))
    return o.join(n, "organisation_number", "full_outer").where("o is null or n is null").select("organisation_number", F.when(F.col("o").isNull(), "new").otherwise("old").alias("side"))


def set_metrics(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Precision and recall of (company, field) sets; 1.0 where nothing was expected or observed."""
    e = expected.select("organisation_number", "field").distinct().withColumn("e", F.lit(1))
    o = observed.select("organisation_number", "field").distinct().withColumn("o", F.lit(1))
    n = e.join(o, ["organisation_number", "field"], "full_outer").agg(F.count_if(F.expr("e is not null and o is not null")).alias("tp"), F.count_if(F.col("e").isNull()).alias("fp"), F.count_if(F.col("o").isNull()).alias("fn"))
    share = lambda wrong: F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col(wrong)), F.lit(1.0))
    return n.select("tp", "fp", "fn", share("fp").alias("precision"), share("fn").alias("recall"))


def overlay(bulk: DataFrame, live: DataFrame) -> DataFrame:
    """Live values replace bulk ones wherever a live row exists, nulls included."""
    l = live.select("organisation_number", F.struct("name", "employees").alias("live"))
    pick = lambda c: F.when(F.col("live").isNotNull(), F.col(f"live.{c}")).otherwise(F.col(c)).alias(c)
    return bulk.join(l, "organisation_number", "left").select("organisation_number", pick("name"), pick("employees"))


def _both(spark, sf_dir):
    return bind(spark, sf_dir, "registry_old"), bind(spark, sf_dir, "registry")


def refresh_diff(spark, sf_dir):
    return diff(*_both(spark, sf_dir))


def refresh_counts(spark, sf_dir):
    return refresh_diff(spark, sf_dir).groupBy("field").agg(F.count("*").alias("n"))


def refresh_idempotent(spark, sf_dir):
    now = bind(spark, sf_dir, "registry")
    return diff(now, now)


def refresh_membership(spark, sf_dir):
    return membership_gap(bind(spark, sf_dir, "registry_live"), bind(spark, sf_dir, "registry"))


def refresh_metrics(spark, sf_dir):
    old, new = _both(spark, sf_dir)
    expected = new.where("employees is not null and cast(organisation_number as bigint) % 14 = 0").select("organisation_number", F.lit("registry.employees").alias("field"))
    return set_metrics(expected, diff(old, new))


def live_overlay(spark, sf_dir):
    return overlay(bind(spark, sf_dir, "registry"), bind(spark, sf_dir, "registry_live"))


def canonical_urls(spark, sf_dir):
    return bind(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("canonical"))


_O = ctes("registry", "registry_old")
_URL = "regexp_replace({0}, '[?&]utm_source=x$', '')"
_DIFF = f"""{_O}, d as (
select n.organisation_number, 2 as field_ix, 'registry.employees' as field, cast(o.employees as varchar) as old_value, cast(n.employees as varchar) as new_value
from registry n join registry_old o using (organisation_number) where o.employees is distinct from n.employees)"""
_CANON = """case when regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') then lower(regexp_extract(url, '^([^:]+)', 1)) || '://' || regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '')
 || case when rtrim(regexp_extract(split_part(url, '#', 1), '://[^/?]*([^?]*)', 1), '/') = '' then '/' else rtrim(regexp_extract(split_part(url, '#', 1), '://[^/?]*([^?]*)', 1), '/') end
 || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end else trim(regexp_replace(url, '\\s+', ' ', 'g')) end""".replace("\\\\", "\\")
_DROP = "'utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid','mc_cid','mc_eid','_ga','ref','ref_src','igshid'"
QUERIES = {
    "refresh_diff": (refresh_diff, f"{_DIFF} select * from d"),
    "refresh_field_counts": (refresh_counts, f"{_DIFF} select field, count(*) as n from d group by field"),
    "refresh_idempotent": (refresh_idempotent, f"{_DIFF} select organisation_number, field_ix, field, old_value, new_value from d where false"),
    "refresh_membership_gap": (refresh_membership, f"{ctes('registry', 'registry_live')} select organisation_number, 'new' as side from registry where organisation_number not in (select organisation_number from registry_live)"),
    "refresh_metrics": (refresh_metrics, f"""{_DIFF}, e as (select organisation_number, 'registry.employees' as field from registry where employees is not null and cast(organisation_number as bigint) % 14 = 0),
 c as (select count(*) filter (where e.field is not null and d.field is not null) as tp, count(*) filter (where e.field is null) as fp, count(*) filter (where d.field is null) as fn from e full join d on e.organisation_number = d.organisation_number and e.field = d.field)
 select tp, fp, fn, coalesce(cast(tp as double) / nullif(tp + fp, 0), 1.0) as precision, coalesce(cast(tp as double) / nullif(tp + fn, 0), 1.0) as recall from c"""),
    "refresh_live_overlay": (live_overlay, f"""{ctes('registry', 'registry_live')} select r.organisation_number, case when l.organisation_number is not null then l.name else r.name end as name,
 case when l.organisation_number is not null then l.employees else r.employees end as employees from registry r left join registry_live l on l.organisation_number = r.organisation_number"""),
    "canonical_urls": (canonical_urls, f"""with p as (select page_id, url, list_sort(list_filter(string_split(regexp_extract(split_part(url, '#', 1), '\\?(.*)$', 1), '&'), lambda x: regexp_matches(x, '^[^=]+=.+') and lower(split_part(x, '=', 1)) not in ({_DROP}))) as q from pages)
 select page_id, {_CANON} as canonical from p"""),
}
