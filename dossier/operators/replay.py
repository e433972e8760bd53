"""Requests answered from a recorded snapshot (SRC-06, SRC-25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.bindings import bind
from dossier.sources import snapshots
from dossier.work import shared_folder


def _responses(s, d):
    """A response per page, two for every third one's URL: text as it came for even pages, a body for odd ones."""
    k = F.col("page_id")
    own = bind(s, d, "pages").select("page_id", "url")
    own = own.withColumn("seq", k).unionByName(own.where("page_id % 3 = 0").withColumn("seq", k + 1_000_000_000))
    raw = F.when(k % 2 == 0, F.concat(F.lit('{ "page": '), k, F.lit(', "seq": '), "seq", F.lit(" }")))
    body = F.when(k % 2 == 1, F.concat(F.lit('{"z": ['), k, F.lit(', 1.5], "a": "\\u00e9"}')))
    times = {"retrieved_at": F.when(k % 4 == 0, F.concat(F.lit("2026-08-01#"), k)), "effective_at": F.lit(None).cast("string")}
    return own.withColumns({"status": F.when(k % 7 == 0, 404).when(k % 11 != 0, 200), "elapsed_ms": (k % 900).cast("int"), "raw_json": raw, "body": body, **times}).drop("page_id")


def _replayed(s, d):
    folder = shared_folder(s, "snapshot")
    snapshots.save(_responses(s, d), folder, "seq", "2026-07-01T00:00:00Z", "2026-06-30T00:00:00Z")
    pages = bind(s, d, "pages")
    requests = pages.select("page_id", "url").unionByName(pages.where("page_id % 5 = 0").select((-F.col("page_id") - 1).alias("page_id"), F.concat(F.lit("https://missing.example/"), "page_id").alias("url")))
    return snapshots.replay(requests, folder).select("page_id", *snapshots.COLUMNS)


QUERIES = {
    "snapshot_source": (_replayed, """with f as (select url, min(page_id) as k from pages group by url),
 b as (select url, k, case when k % 7 = 0 then 404 else 200 end as status, case when k % 2 = 0 then '{ "page": ' || k || ', "seq": ' || k || ' }' else '{"a":"é","z":[' || k || ',1.5]}' end as raw from f),
 r as (select page_id, url from pages union all select -page_id - 1, 'https://missing.example/' || page_id from pages where page_id % 5 = 0)
 select page_id, r.url, cast(coalesce(status, 0) as int) as status, cast(coalesce(k % 900, 0) as int) as elapsed_ms, cast(coalesce(octet_length(encode(raw)), 0) as bigint) as bytes_received,
 case when status = 200 then raw end as body, case when k is null then 'snapshot response missing' when status <> 200 then 'HTTP ' || status end as error, sha256(raw) as content_sha256,
 case when k % 4 = 0 then '2026-08-01#' || k else '2026-07-01T00:00:00Z' end as retrieved_at, '2026-06-30T00:00:00Z' as effective_at from r left join b on b.url = r.url"""),
}
