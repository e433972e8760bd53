"""Deterministic samples by hash rank (FLT-01, SMP-01..05, WIN-01, WIN-02, AGG-01, AGG-17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import host


def eligible(year: str, active_only: bool = True) -> Column:
    """Filed for ``year`` and, where asked, neither bankrupt nor liquidating."""
    filed = F.coalesce(F.col("latest_submitted_accounts") == year, F.lit(False))
    return filed & ~(F.col("bankrupt") | F.col("liquidating")) if active_only else filed


def employee_band(n: Column) -> Column:
    return F.when(n.isNull(), "missing").when(n == 0, "0").when(n < 5, "1-4").when(n < 20, "5-19").when(n < 100, "20-99").otherwise("100+")


def stratum() -> Column:
    adverse = F.when(F.col("bankrupt") | F.col("liquidating"), "adverse").otherwise("active")
    web = F.when(F.coalesce("website", F.lit("")) != "", "web").otherwise("no-web")
    return F.concat_ws("|", F.coalesce(F.nullif("legal_form", F.lit("")), F.lit("missing")), employee_band(F.col("employees")), adverse, web)


def filer_stratum() -> Column:
    place = F.left(F.coalesce(F.nullif("municipality_number", F.lit("")), F.lit("missing")), F.lit(2))
    trade = F.left(F.coalesce(F.nullif("industry_code", F.lit("")), F.lit("missing")), F.lit(2))
    return F.concat_ws("|", F.coalesce(F.nullif("legal_form", F.lit("")), F.lit("missing")), employee_band(F.col("employees")), trade, place)


def rank_key(seed: str, org: Column | None = None) -> Column:
    """Order-free rank: hex SHA-256 sorts as its integer does."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), org if org is not None else F.col("organisation_number")), 256)


def hash_top(rows: DataFrame, seed: str, count: int) -> DataFrame:
    """The ``count`` rows of least hash rank: a top-k, no full sort."""
    return rows.dropDuplicates(["organisation_number"]).withColumn("rank", rank_key(seed)).orderBy("rank", "organisation_number").limit(count)


def extension(rows: DataFrame, exclude: DataFrame, seed: str, count: int) -> DataFrame:
    return hash_top(rows.join(exclude.select("organisation_number"), "organisation_number", "left_anti"), seed, count)


def splits(sample: DataFrame, seed: str, count: int) -> DataFrame:
    """development, validation, held_out by hash order; shares of the count asked for. ``sample`` has at most ``count`` rows."""
    at = F.row_number().over(Window.orderBy(rank_key(f"{seed}:order"), "organisation_number"))
    dev, val = round(0.6 * count), round(0.2 * count)
    return sample.withColumn("position", at).withColumn("split", F.when(at <= dev, "development").when(at <= dev + val, "validation").otherwise("held_out"))


def financial_filers(registry: DataFrame, preserved: DataFrame, year: str, seed: str, count: int) -> DataFrame:
    """Eligible preserved companies first, filled by hash rank, in hash order with splits."""
    own = registry.where(eligible(year))
    kept = own.join(preserved.select("organisation_number"), "organisation_number", "left_semi").withColumn("sample_slice", F.lit("preserved"))
    kept = hash_top(kept, f"{seed}:preserved", count).drop("rank")
    rest = own.join(kept, "organisation_number", "left_anti").withColumn("sample_slice", F.lit("fill"))
    fill = hash_top(rest, seed, count).drop("rank")
    both = kept.withColumn("_o", F.lit(0)).unionByName(fill.withColumn("_o", F.lit(1)))
    chosen = both.orderBy("_o", rank_key(seed), "organisation_number").limit(count).drop("_o")
    return splits(chosen, seed, count)


def first_per_host(registry: DataFrame, exclude: DataFrame, seed: str, count: int) -> DataFrame:
    """One company per website host: the least rank, of companies and hosts that are not excluded."""
    sited = registry.withColumn("host", host(F.col("website"))).where("host <> ''")
    taken = exclude.join(sited, "organisation_number").select("host").distinct()
    own = sited.join(exclude.select("organisation_number"), "organisation_number", "left_anti").join(taken, "host", "left_anti").withColumn("rank", rank_key(seed))
    first = F.row_number().over(Window.partitionBy("host").orderBy("rank", "organisation_number"))
    return own.withColumn("_n", first).where("_n = 1").orderBy("rank", "organisation_number").limit(count)


def stratified(registry: DataFrame, seed: str, count: int) -> DataFrame:
    """70 % by hash rank over all, the rest the least ranks of every stratum in turn: the reservoir's sizes without its scan order."""
    main = hash_top(registry, seed, round(0.7 * count)).withColumn("sample_slice", F.lit("population"))
    rest = registry.join(main, "organisation_number", "left_anti").withColumns({"rank": rank_key(f"{seed}:stress"), "stratum": stratum()})
    turn = F.row_number().over(Window.partitionBy("stratum").orderBy("rank", "organisation_number"))
    stress = rest.withColumn("_turn", turn).orderBy("_turn", "rank", "organisation_number").limit(count - round(0.7 * count)).withColumn("sample_slice", F.lit("stress"))
    return main.select("organisation_number", "sample_slice").unionByName(stress.select("organisation_number", "sample_slice"))


def membership_hash(sample: DataFrame) -> DataFrame:
    """SHA-256 of the sorted numbers joined by newlines; of a sample, so bounded."""
    return sample.agg(F.count("*").alias("n"), F.sha2(F.concat_ws("\n", F.array_sort(F.collect_set("organisation_number"))), 256).alias("selected_sha256"))


_BAND = "case when employees is null then 'missing' when employees = 0 then '0' when employees < 5 then '1-4' when employees < 20 then '5-19' when employees < 100 then '20-99' else '100+' end"
_STRATUM = f"concat_ws('|', legal_form, {_BAND}, case when bankrupt or liquidating then 'adverse' else 'active' end, case when coalesce(website, '') <> '' then 'web' else 'no-web' end)"
_R = ctes("registry")
_FILERS = f"""{_R}, e as (select * from registry where latest_submitted_accounts = '2001' and not (bankrupt or liquidating)),
p as (select organisation_number, 'preserved' as sample_slice, 0 as o from e where cast(organisation_number as bigint) % 50 = 0 order by sha256('s1:preserved:' || organisation_number), 1 limit 100),
f as (select organisation_number, 'fill' as sample_slice, 1 as o from e where organisation_number not in (select organisation_number from p) order by sha256('s1:' || organisation_number), 1 limit 100),
c as (select * from (select * from p union all select * from f) order by o, sha256('s1:' || organisation_number), organisation_number limit 100),
n as (select *, row_number() over (order by sha256('s1:order:' || organisation_number), organisation_number) as position from c)"""


def _preserved(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("organisation_number").cast("bigint") % 50 == 0)


def _filers(spark, sf_dir):
    registry = bind(spark, sf_dir, "registry")
    return financial_filers(registry, _preserved(registry), "2001", "s1", 100)


def sample_financial_filers(spark, sf_dir):
    return _filers(spark, sf_dir).select("organisation_number", "sample_slice", "position", "split")


def sample_split_counts(spark, sf_dir):
    return _filers(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def sample_extension(spark, sf_dir):
    registry = bind(spark, sf_dir, "registry")
    return extension(registry, _preserved(registry), "x7", 200).select("organisation_number", "rank")


def sample_website_hosts(spark, sf_dir):
    registry = bind(spark, sf_dir, "registry")
    return first_per_host(registry, _preserved(registry), "w1", 50).select("organisation_number", "host", "rank")


def sample_membership_hash(spark, sf_dir):
    return membership_hash(hash_top(bind(spark, sf_dir, "registry"), "x7", 300))


def stratified_sample(spark, sf_dir):
    return stratified(bind(spark, sf_dir, "registry"), "m3", 120)


def _counts(key):
    return lambda spark, sf_dir: bind(spark, sf_dir, "registry").groupBy(key().alias("stratum")).agg(F.count("*").alias("n"))


_HOST = "regexp_replace(lower(regexp_extract(coalesce(website, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '^www\\.', '')"
QUERIES = {
    "stratum_counts": (_counts(stratum), f"{_R} select {_STRATUM} as stratum, count(*) as n from registry group by 1"),
    "financial_stratum_counts": (_counts(filer_stratum), f"{_R} select concat_ws('|', legal_form, {_BAND}, left(industry_code, 2), left(municipality_number, 2)) as stratum, count(*) as n from registry group by 1"),
    "sample_financial_filers": (sample_financial_filers, f"{_FILERS} select organisation_number, sample_slice, cast(position as int) as position, case when position <= 60 then 'development' when position <= 80 then 'validation' else 'held_out' end as split from n"),
    "sample_split_counts": (sample_split_counts, f"{_FILERS} select case when position <= 60 then 'development' when position <= 80 then 'validation' else 'held_out' end as split, count(*) as n from n group by 1"),
    "sample_extension": (sample_extension, f"{_R} select organisation_number, sha256('x7:' || organisation_number) as rank from registry where cast(organisation_number as bigint) % 50 <> 0 order by rank limit 200"),
    "sample_website_hosts": (sample_website_hosts, f"""{_R}, s as (select *, {_HOST} as host, sha256('w1:' || organisation_number) as rank from registry),
 t as (select host from s where cast(organisation_number as bigint) % 50 = 0),
 o as (select *, row_number() over (partition by host order by rank, organisation_number) as n from s where host <> '' and cast(organisation_number as bigint) % 50 <> 0 and host not in (select host from t))
 select organisation_number, host, rank from o where n = 1 order by rank limit 50"""),
    "sample_membership_hash": (sample_membership_hash, f"{_R}, t as (select organisation_number as o from registry order by sha256('x7:' || organisation_number) limit 300) select count(*) as n, sha256(string_agg(o, chr(10) order by o)) as selected_sha256 from t"),
    "sample_stratified": (stratified_sample, f"""{_R}, m as (select organisation_number from registry order by sha256('m3:' || organisation_number), 1 limit 84),
 r as (select organisation_number, sha256('m3:stress:' || organisation_number) as rank, {_STRATUM} as st from registry where organisation_number not in (select * from m)),
 t as (select *, row_number() over (partition by st order by rank, organisation_number) as turn from r)
 select organisation_number, 'population' as sample_slice from m union all (select organisation_number, 'stress' from t order by turn, rank, organisation_number limit 36)"""),
}
