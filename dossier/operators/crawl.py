"""Crawl events and run telemetry (AGG-07..09, AGG-11..14, JON-06, SRT-02, SRC-06, SRC-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes


def dedupe_events(events: DataFrame) -> DataFrame:
    """First event per (company, kind, URL, content, status)."""
    keys = ("organisation_number", "page_kind", "final_url", "content_sha256", "status")
    return events.groupBy(*keys).agg(F.min_by(F.struct("retrieved_at", "seq"), "seq").alias("e")).select(*keys, "e.*")


def latest_homepage(events: DataFrame) -> DataFrame:
    """The homepage of the last time as text; of equal times the last in input order."""
    order = Window.partitionBy("organisation_number").orderBy(F.col("retrieved_at").desc(), F.col("seq").desc())
    own = events.where("page_kind = 'homepage' and status = 'available'").withColumn("_n", F.row_number().over(order))
    return own.where("_n = 1").drop("_n")


def unique_pages(events: DataFrame) -> DataFrame:
    """Available pages, homepage first, then by URL; of a URL the last row wins."""
    own = events.where("status = 'available'")
    last = own.groupBy("organisation_number", "final_url").agg(F.max_by(F.struct("page_kind", "content_sha256", "seq"), F.struct(F.when(F.col("page_kind") == "homepage", 0).otherwise(1), "seq")).alias("e"))
    at = F.row_number().over(Window.partitionBy("organisation_number").orderBy(F.when(F.col("e.page_kind") == "homepage", 0).otherwise(1), "final_url"))
    return last.select("organisation_number", "final_url", "e.page_kind", "e.content_sha256", at.alias("position"))


def missing_seeds(registry: DataFrame, events: DataFrame) -> DataFrame:
    """Companies with a website that no event answers for."""
    seeds = registry.where(F.coalesce("website", F.lit("")) != "").select("organisation_number", "website")
    return seeds.join(events.select("organisation_number").distinct(), "organisation_number", "left_anti")


def nearest_rank(column: str, q: float) -> Column:
    """sorted[max(0, ceil(q n) - 1)]; null for no rows."""
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    return F.expr(f"percentile_disc({q}) within group (order by {column})")


def latency_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("connector").agg(F.count("*").alias("n"), F.round(nearest_rank("latency_ms", 0.5), 3).alias("p50"), F.round(nearest_rank("latency_ms", 0.95), 3).alias("p95"), F.round(F.max("latency_ms"), 3).alias("most"))


def fairness(log: DataFrame) -> DataFrame:
    """Requests per domain, then their spread over domains."""
    per = log.groupBy("domain").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("domains"), nearest_rank("n", 0.5).alias("p50"), nearest_rank("n", 0.95).alias("p95"), F.max("n").alias("most"))


def at_index(log: DataFrame, group: str, column: str, index: str, name: str) -> DataFrame:
    """The value at a zero-based position, an expression of the group's n, without gathering a group; nulls do not count.

    Counts by bins that grow with the value give the bin that holds the position; only that bin's rows are ordered.
    """
    x = F.col(column)
    binned = log.where(x.isNotNull()).withColumn("_bin", F.floor(F.signum(x) * F.log2(1 + F.abs(x)) * 256))
    bins = binned.groupBy(group, "_bin").agg(F.count("*").alias("_in"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("_in").over(own.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.withColumns({"_before": before, "n": F.sum("_in").over(own)}).withColumn("_at", F.expr(f"least(n - 1, {index})"))
    held = binned.join(bins.where("_before <= _at and _at < _before + _in").select(group, "_bin", "_before", "_at"), [group, "_bin"])
    nth = F.row_number().over(Window.partitionBy(group).orderBy(column)) - 1
    return held.withColumn("_i", nth).where("_i = _at - _before").select(group, F.col(column).alias(name))


def runner_percentiles(log: DataFrame) -> DataFrame:
    """The batch runner's own definitions: n div 2, and int(0.95 n)."""
    return at_index(log, "connector", "latency_ms", "n div 2", "p50").join(at_index(log, "connector", "latency_ms", "cast(floor(n * 0.95) as bigint)", "p95"), "connector")


def interpolated_free(log: DataFrame) -> DataFrame:
    """A third definition: int((n - 1) f)."""
    return at_index(log, "connector", "latency_ms", "cast(floor((n - 1) * 0.95) as bigint)", "p95")


def pacing(log: DataFrame, gap: float = 2.1) -> DataFrame:
    """Per domain the last start and the sum of waits of requests that start in order and ``gap`` seconds apart at least.

    A request waits for what is left of the gap only: it starts at the later of its own time and the start before it plus the
    gap, which is the greatest of (time of an earlier one - its place * gap), plus its own place * gap.
    """
    asked = F.round(F.col("started_at").cast("timestamp").cast("double"), 3)
    order = Window.partitionBy("domain").orderBy("started_at", "latency_ms")
    own = log.withColumns({"_at": asked, "_i": F.row_number().over(order) - 1})
    start = F.max(F.col("_at") - F.col("_i") * gap).over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_i") * gap
    waits = own.withColumn("start", F.round(start, 3))
    return waits.groupBy("domain").agg(F.round(F.max("start"), 3).alias("last_start"), F.round(F.sum(F.col("start") - F.col("_at")), 1).alias("waited"), F.count_if(F.col("start") > F.col("_at") + 0.0005).alias("delayed"))


def replay(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests answered from a snapshot; status 0 where it has no answer."""
    held = requests.join(responses, "url", "left")
    return held.select("url", F.coalesce("status", F.lit(0)).alias("status"), F.when(F.col("body").isNotNull(), F.sha2("body", 256)).alias("content_sha256"))


def _on(name, fn):
    return lambda spark, sf_dir: fn(bind(spark, sf_dir, name))


def _replay(spark, sf_dir):
    pages = bind(spark, sf_dir, "pages")
    responses = pages.where("page_id % 4 <> 0").select("url", F.lit(200).alias("status"), F.col("html").alias("body")).groupBy("url").agg(F.min("status").alias("status"), F.min("body").alias("body"))
    return replay(pages.select("url").distinct(), responses)


_E, _H = ctes("page_events"), ctes("http_log")
_IX = "(select connector, latency_ms, row_number() over (partition by connector order by latency_ms) - 1 as i, count(*) over (partition by connector) as n from http_log)"
QUERIES = {
    "crawl_event_dedupe": (_on("page_events", dedupe_events), f"{_E} select organisation_number, page_kind, final_url, content_sha256, status, min_by(retrieved_at, seq) as retrieved_at, min(seq) as seq from page_events group by 1, 2, 3, 4, 5"),
    "crawl_latest_homepage": (_on("page_events", latest_homepage), f"{_E} select * exclude (n) from (select *, row_number() over (partition by organisation_number order by retrieved_at desc, seq desc) as n from page_events where page_kind = 'homepage' and status = 'available') where n = 1"),
    "crawl_unique_pages": (_on("page_events", unique_pages), f"""{_E}, l as (select *, row_number() over (partition by organisation_number, final_url order by page_kind = 'homepage', seq desc) as n from page_events where status = 'available')
 select organisation_number, final_url, page_kind, content_sha256, cast(row_number() over (partition by organisation_number order by page_kind <> 'homepage', final_url) as int) as position from l where n = 1"""),
    "crawl_missing_seeds": (lambda s, d: missing_seeds(bind(s, d, "registry"), bind(s, d, "page_events")), f"{ctes('registry', 'page_events')} select organisation_number, website from registry where coalesce(website, '') <> '' and organisation_number not in (select organisation_number from page_events)"),
    "request_latency_summary": (_on("http_log", latency_summary), f"{_H} select connector, count(*) as n, round(quantile_disc(latency_ms, 0.5), 3) as p50, round(quantile_disc(latency_ms, 0.95), 3) as p95, round(max(latency_ms), 3) as most from http_log group by connector"),
    "domain_fairness": (_on("http_log", fairness), f"{_H}, p as (select domain, count(*) as n from http_log group by domain) select count(*) as domains, quantile_disc(n, 0.5) as p50, quantile_disc(n, 0.95) as p95, max(n) as most from p"),
    "runner_percentiles": (_on("http_log", runner_percentiles), f"{_H}, x as {_IX} select connector, max(latency_ms) filter (where i = least(n - 1, n // 2)) as p50, max(latency_ms) filter (where i = least(n - 1, cast(floor(n * 0.95) as bigint))) as p95 from x group by connector"),
    "search_percentile": (_on("http_log", interpolated_free), f"{_H}, x as {_IX} select connector, latency_ms as p95 from x where i = cast(floor((n - 1) * 0.95) as bigint)"),
    "request_pacing": (_on("http_log", pacing), f"""{_H.replace("with ", "with recursive ", 1)}, x as (select domain, round(epoch(started_at), 3) as t, row_number() over (partition by domain order by started_at, latency_ms) as i from http_log),
 g as (select domain, i, t, t as s from x where i = 1 union all select x.domain, x.i, x.t, greatest(x.t, g.s + 2.1) from g join x on x.domain = g.domain and x.i = g.i + 1)
 select domain, round(max(s), 3) as last_start, round(sum(round(s, 3) - t), 1) as waited, count(*) filter (where s > t + 0.0005) as delayed from g group by domain"""),
    "snapshot_replay": (_replay, "with u as (select distinct url from pages), r as (select url, min(html) as body from pages where page_id % 4 <> 0 group by url) select u.url, case when body is null then 0 else 200 end as status, sha256(body) as content_sha256 from u left join r on u.url = r.url"),
}
