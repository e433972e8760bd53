"""Driver tables as relations of companies, filings, observations, page events and labels.

A binding is SQL that both Spark and DuckDB read alike: ``{S}`` is the string type, ``{SHA}`` the SHA-256 function and
``{table}`` an input. Spark receives the inputs as parameters, the oracle gets the bindings as CTEs.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations", "benchmark", "embeddings")

BINDINGS = {
    "registry": """
select cast(900000000 + c_custkey as {S}) as organisation_number, concat(c_name, ' AS') as name,
  case c_mktsegment when 'AUTOMOBILE' then 'AS' when 'BUILDING' then 'ASA' when 'FURNITURE' then 'ENK' when 'HOUSEHOLD' then 'NUF' else 'STI' end as legal_form,
  case when c_acctbal < 0 then null when c_acctbal < 500 then 0 else cast(floor(c_acctbal / 60) as int) end as employees,
  c_custkey % 97 = 0 as bankrupt, c_custkey % 89 = 0 as liquidating, translate(n_name, '_0123456789', 'ZABCDEFGHIJ') as municipality,
  lpad(cast(c_nationkey as {S}), 4, '0') as municipality_number,
  concat(lpad(cast(c_custkey % 99 as {S}), 2, '0'), '.', lpad(cast(c_custkey % 1000 as {S}), 3, '0')) as industry_code,
  concat('trade ', lower(c_mktsegment)) as industry_label, p.url as website, y.latest_submitted_accounts
from {customer} join {nation} on c_nationkey = n_nationkey left join {pages} p on p.page_id = c_custkey
left join (select o_custkey, cast(max(year(o_orderdate)) as {S}) as latest_submitted_accounts from {orders} group by o_custkey) y on y.o_custkey = c_custkey""",
    "registry_raw": """
select cast(900000000 + c_custkey as {S}) as org, c_name as navn, case when c_custkey % 3 = 0 then '' else c_name end as name_b,
  case when c_acctbal < 0 then 'n/a' else cast(cast(floor(c_acctbal) as int) as {S}) end as ansatte,
  case when c_custkey % 97 = 0 then 'True' when c_custkey % 5 = 0 then 'false' end as konkurs from {customer}""",
    "registry_live": """
select cast(900000000 + c_custkey as {S}) as organisation_number, case when c_custkey % 11 = 0 then concat(c_name, ' ASA') when c_custkey % 6 = 0 then null else concat(c_name, ' AS') end as name,
  case when c_custkey % 9 = 0 then null when c_custkey % 4 = 0 then 7 when c_acctbal < 0 then null when c_acctbal < 500 then 0 else cast(floor(c_acctbal / 60) as int) end as employees
from {customer} where c_custkey % 8 <> 0""",
    "filings": """
select cast(900000000 + o_custkey as {S}) as organisation_number, cast(year(o_orderdate) as int) as period_year,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue,
  cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else -cast(o_totalprice as decimal(18,2)) end) as double) as annual_result,
  cast(count(*) as bigint) as filing_rows from {orders} group by o_custkey, year(o_orderdate)""",
    "registry_old": """
select organisation_number, case when cast(organisation_number as bigint) % 10 = 0 then name || '  ' else name end as name, legal_form,
  case when cast(organisation_number as bigint) % 7 = 0 then null else employees end as employees, municipality,
  case when cast(organisation_number as bigint) % 5 = 0 then website || case when website like '%?%' then '&' else '?' end || 'utm_source=x' else website end as website,
  latest_submitted_accounts from registry""",
    "observations": """
select concat('obs-', cast(event_id as {S})) as id, cast(900000000 + user_id as {S}) as organisation_number,
  case event_id % 5 when 0 then 'google_places' when 1 then 'news' when 2 then 'linkedin' when 3 then 'company_site' else 'unknown_platform' end as platform,
  case event_type when 'click' then 'profile_metrics' when 'view' then 'public_mention' when 'purchase' then 'review' when 'signup' then 'job_posting' else 'buzz_metrics' end as signal_type,
  concat('https://h', cast(event_id % 7 as {S}), '.example/', cast(event_id % 400 as {S})) as source_url, ts as retrieved_at,
  case when event_id % 23 = 0 then null else {SHA}(props) end as content_sha256, event_id % 11 <> 0 as exact_entity,
  case when event_id % 13 = 0 then 0 else 1 end as identity_proof_count,
  case event_id % 6 when 0 then 'official_api' when 1 then 'licensed_api' when 2 then 'permitted_public_page' when 3 then 'company_authorized_export' when 4 then 'jobspy_experiment' else 'rights_review_experiment' end as acquisition_mode,
  case when event_id % 17 = 0 then 'review_required' when event_id % 29 = 0 then 'blocked' else 'approved' end as rights_status,
  case when event_type = 'purchase' then 'customer_review' when event_type = 'view' then 'public_news' else 'company_site' end as source_class,
  case when event_id % 19 = 0 then null else props end as evidence_span,
  case when event_type = 'purchase' then case when value < 5 then 'negative' when value < 10 then 'neutral' when value < 40 then 'positive' else 'mixed' end end as sentiment_label,
  case when event_type = 'purchase' then 'm1' end as sentiment_model_version,
  case when event_type = 'purchase' then concat('r-', cast(event_id % 50 as {S})) end as reviewer_id,
  cast(floor(value) as bigint) as likes, event_id as seq from {events}""",
    "page_events": """
select cast(900000000 + page_id % 60 as {S}) as organisation_number, case when page_id % 4 = 0 then 'homepage' else 'priority' end as page_kind,
  url as final_url, {SHA}(html) as content_sha256, case when page_id % 9 = 0 then 'source_error' else 'available' end as status,
  concat('2026-08-', lpad(cast(1 + page_id % 28 as {S}), 2, '0'), 'T00:00:00Z') as retrieved_at, page_id as seq from {pages}
 union all select cast(900000000 + page_id % 60 as {S}), case when page_id % 4 = 0 then 'homepage' else 'priority' end, url, {SHA}(html), case when page_id % 9 = 0 then 'source_error' else 'available' end,
  concat('2026-08-', lpad(cast(1 + page_id % 28 as {S}), 2, '0'), 'T00:00:00Z'), page_id + 1000000000 from {pages} where page_id % 3 = 0""",
    "sentiment_gold": """
select cast(doc_id as {S}) as id, case when quality = 1 and toxic = 0 then 'positive' when quality = 0 and toxic = 1 then 'negative' when quality = 1 then 'mixed' else 'neutral' end as label from {labels}""",
    "sentiment_predictions": """
select cast(l.doc_id as {S}) as id, cast(900000000 + l.doc_id % 40 as {S}) as organisation_number,
  case when d.n_chars % 5 = 0 then 'neutral' when quality = 1 and toxic = 0 then 'positive' when quality = 0 and toxic = 1 then 'negative' when quality = 1 then 'mixed' else 'neutral' end as label,
  d.n_chars % 31 <> 0 as exact_entity, case when d.n_chars % 29 = 0 then 'company_owned' else 'licensed_news' end as source_class,
  concat('https://', d.source, '.example/', cast(l.doc_id as {S})) as source_url
 from {labels} l join {documents} d on l.doc_id = d.doc_id where l.doc_id % 13 <> 0""",
    "http_log": """
select concat('d', cast(user_id % 20 as {S}), '.no') as domain, event_type as connector, value as latency_ms, ts as started_at from {events}""",
    "roles": """
select cast(900000000 + l_orderkey % 500 as {S}) as organisation_number, concat('Person ', cast(l_suppkey as {S})) as name,
  case l_linenumber % 4 when 0 then 'DAGL' when 1 then 'LEDE' when 2 then 'MEDL' else 'INNH' end as role_code, l_returnflag = 'R' as inactive,
  cast(l_orderkey as bigint) * 100 + l_linenumber as seq from {lineitem}""",
    "locations": """
select cast(900000000 + s_suppkey % 60 as {S}) as organisation_number, cast(800000000 + s_suppkey as {S}) as unit, s_name as name, n_name as visiting,
  case when s_suppkey % 3 = 0 then null else concat('Postal ', n_name) end as postal, s_suppkey as seq from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "search_results": """
select r.organisation_number, p.page_id as rank_no, concat('https://', case when p.page_id % 7 = 0 then 'www.linkedin.com' when p.page_id % 2 = 0 then lower(replace(replace(r.name, ' AS', ''), '#', '')) || '.no' else 'other.example' end, '/p', cast(p.page_id as {S})) as url,
  case when p.page_id % 3 = 0 then r.name else 'About us' end as title,
  case when p.page_id % 5 = 0 then concat('Org ', r.organisation_number, ' ', r.municipality) else concat('Found in ', r.municipality) end as snippet
from registry r join {pages} p on cast(r.organisation_number as bigint) - 900000000 = p.page_id % 50""",
    "iterations": """
select event_id as seq, case event_id % 6 when 0 then 'jobs_feed_discovery' when 1 then 'places_rating_reviews' when 2 then 'independent_sentiment' when 3 then 'company_site_feed' when 4 then 'social_profile_metrics' else 'buzz_peer_normalization' end as strategy,
  cast(case when event_id % 4 = 0 then 0 else event_id % 7 end as double) as learning_gain, cast(event_id % 3 as double) as score_delta from {events}""",
}

_USES = {"registry_old": ("registry",), "search_results": ("registry",)}


@cache
def _tables(name: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t for t in re.findall(r"\{(\w+)\}", BINDINGS[name]) if t in TABLES))


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The relation ``name`` over the tables of ``sf_dir``."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _tables(name)}
    text = BINDINGS[name].replace("{S}", "string").replace("{SHA}", "_sha_")
    text = re.sub(r"_sha_\((\w+)\)", r"sha2(\1, 256)", text)
    for other in _USES.get(name, ()):
        used[f"b_{other}"] = bind(spark, sf_dir, other)
        text = re.sub(rf"\bfrom {other}\b", f"from {{b_{other}}}", text)
    return spark.sql(text, **used)


def ctes(*names: str) -> str:
    """``with`` clause that gives DuckDB the relations ``names``; further CTEs may follow after a comma."""
    order: list[str] = []
    for name in names:
        for n in (*_USES.get(name, ()), name):
            if n not in order:
                order.append(n)
    parts = []
    for n in order:
        text = BINDINGS[n].replace("{S}", "varchar").replace("{SHA}", "sha256")
        parts.append(f"{n} as ({re.sub(r'[{](\w+)[}]', r'\1', text)})")
    return "with " + ",\n".join(parts)
