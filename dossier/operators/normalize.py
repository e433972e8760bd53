"""Registry, filing, role and location normalisers, company answers, workforce phrases (PRJ-01, PRJ-03..06, QNA-01, SRC-22, FLT-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.bindings import bind, ctes
from dossier.functions.text import words
from dossier.operators.screen import latest_filing


def first_filled(*columns: str) -> Column:
    """The first that is neither null nor empty, else ""."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns), F.lit(""))


def registry_row(raw: DataFrame) -> DataFrame:
    """Two header spellings, a count that may not parse, a flag as text."""
    flag = F.coalesce(F.lower("konkurs") == "true", F.lit(False))
    return raw.select(F.col("org").alias("organisation_number"), first_filled("name_b", "navn").alias("name"), F.col("ansatte").try_cast("int").alias("employees"), flag.alias("bankrupt"))


def latest_three(filings: DataFrame) -> DataFrame:
    """The three latest periods, latest first; zero stays zero."""
    order = Window.partitionBy("organisation_number").orderBy(F.col("period_year").desc(), F.col("revenue").desc(), F.col("annual_result").desc())
    ranked = filings.withColumn("ix", F.row_number().over(order) - 1)
    return ranked.where("ix < 3").select("organisation_number", "ix", "period_year", "revenue", "annual_result")


def filing_years(filings: DataFrame) -> DataFrame:
    years = F.array_sort(F.array_distinct(F.filter(F.collect_list(F.col("period_year").cast("string")), lambda y: y.rlike("^[0-9]+$"))))
    return filings.groupBy("organisation_number").agg(F.array_join(years, ",").alias("years"), F.array_max(years).alias("first_pdf"))


def role_rows(roles: DataFrame) -> DataFrame:
    """Role holders in force of a company by code; birth dates never enter."""
    return roles.where("not inactive").groupBy("organisation_number", "role_code").agg(F.count("*").alias("n"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))


def location_rows(locations: DataFrame) -> DataFrame:
    return locations.select("organisation_number", "unit", "name", F.coalesce("visiting", "postal").alias("address"))


#: Words of a question that name a topic.
_TOPICS = {
    "financial": ("financial", "finance", "account", "revenue", "income", "profit", "result", "debt", "asset", "regnskap"),
    "role": ("lead", "role"), "location": ("location", "where"), "social": ("social",), "sentiment": ("sentiment",), "employee": ("employee",),
}


def topics(question: str) -> set[str]:
    q = question.casefold()
    named = {t for t, terms in _TOPICS.items() if any(term in q for term in terms)}
    return named or {"financial", "role", "location", "social", "employee"}


def answer(question: str, registry: DataFrame, filings: DataFrame, locations: DataFrame) -> DataFrame:
    """Facts (organisation_number, ix, label, value) that a question asks for; a missing value is no fact."""
    asked = topics(question)
    own = registry.join(latest_filing(filings).select("organisation_number", "period_year", "revenue", "annual_result"), "organisation_number", "left")
    fact = lambda i, label, c: F.struct(F.lit(i).alias("ix"), F.lit(label).alias("label"), F.col(c).cast("string").alias("value"))
    rows = []
    if "employee" in asked:
        rows += [fact(1, "Registered name", "name"), fact(2, "Organisation number", "organisation_number"), fact(3, "Legal form", "legal_form"), fact(4, "Municipality", "municipality"), fact(5, "Registry employee count", "employees")]
    if "financial" in asked:
        rows += [fact(6, "Reporting period", "period_year"), F.struct(F.lit(7).alias("ix"), F.lit("Revenue").alias("label"), F.col("revenue").cast("decimal(18,2)").cast("string").alias("value"))]
    empty = F.array().cast("array<struct<ix:int,label:string,value:string>>")
    facts = own.select("organisation_number", F.inline(F.filter(F.array(*rows) if rows else empty, lambda r: F.coalesce(r["value"], F.lit("")) != "")))
    if "location" in asked:
        nth = F.row_number().over(Window.partitionBy("organisation_number").orderBy("seq"))
        units = locations.join(registry.select("organisation_number"), "organisation_number", "left_semi").withColumn("_n", nth).where("_n <= 12")
        facts = facts.unionByName(units.select("organisation_number", (F.lit(100) + F.col("_n")).alias("ix"), F.lit("Registered subunit").alias("label"), F.col("name").alias("value")))
    return facts


def company_answers(question: str):
    return lambda s, d: answer(question, bind(s, d, "registry"), bind(s, d, "filings"), bind(s, d, "locations"))


def norwegian_number(text: Column) -> Column:
    """A number as annual reports print it, where a letter O is a zero: digits, then decimals after a comma or one or two
    after a last point; other points and spaces part thousands. Null where that leaves no number, or one beyond 0..100000."""
    bare = F.btrim(F.translate(text, "O ", "0"), F.lit(".,-"))
    at = F.when(F.contains(bare, F.lit(",")), F.instr(bare, ",")).when(bare.rlike(r"[.]\d\d?$"), F.length(bare) + 1 - F.instr(F.reverse(bare), "."))
    whole = F.when(at.isNull(), F.replace(bare, F.lit("."))).when(F.contains(bare, F.lit(",")), F.replace(F.left(bare, at - 1), F.lit("."))).otherwise(F.left(bare, at - 1))
    part = F.replace(F.substr(bare, at + 1), F.lit("."))
    n = F.round(F.concat(whole, F.coalesce(F.concat(F.lit("."), part), F.lit(""))).try_cast("double"), 2)
    return F.when(n.between(0, 100000), n)


#: The number that a phrase holds, and phrases that state a head count by priority; the number is group 1.
NUMBER = r"(?-i:\b[0-9O][0-9O .,-]{0,8})"
WORKFORCE = (
    (0, rf"(?i)(?:antall|tal\s+p[aå])\s+(?:aarsverk|arsverk|årsverk)\s+i\s+(?:regnskapsaret|rekneskapsaret)\s*(?:er|:|=)?\s*({NUMBER})"),
    (0, rf"(?i)antall\s+(?:aarsverk|arsverk|årsverk)(?:\s+sysselsatt\s+i\s+regnskapsaret)?\s*(?:er|:|=)?\s*({NUMBER})"),
    (0, rf"(?i)selskapet\s+har(?:\s+[i1]\s+\d{{4}})?\s+sysselsatt\s+({NUMBER})\s+(?:aarsverk|arsverk|årsverk)"),
    (0, rf"(?i)selskapet\s+har\s+({NUMBER})\s+(?:aarsverk|arsverk|årsverk)"),
    (0, rf"(?i)antall\s+(?:aarsverk|arsverk|årsverk)\s+(?:sysselsatt|syssetsatt)\s+i\s+regnskapsaret\s*(?:er|:|=)?\s*({NUMBER})"),
    (1, rf"(?i)gjennomsnittlig(?:e)?\s+antall\s+ansatte(?:\s+i\s+regnskapsaret)?\s*(?:er|:|=)?\s*({NUMBER})"),
    (1, rf"(?i)antall\s+ansatte\s*(?:er|:|=)?\s*({NUMBER})"),
    (2, rf"(?i)({NUMBER})\s+(?:heltids)?ansatte\b"),
)
#: Counts in words, with their phrase, and phrases that state that there is nobody.
WORD_COUNTS = {"ingen": 0, "en": 1, "ett": 1, "to": 2, "tre": 3, "fire": 4, "fem": 5}
WORD_PHRASE = r"(?i)\b(?:det\s+er|selskapet\s+har)\s+(ingen|en|ett|to|tre|fire|fem)\s+ansatte\b"
NOBODY = r"(?i)\b(?:selskapet|stiftelsen|legatet|sameiet|det)\s+(?:har\s+ingen\s+(ansatte|(?:aarsverk|arsverk|årsverk))|har\s+ikke\s+hatt\s+(?:noen\s+)?ansatte|hadde\s+ingen\s+ansatte|ikke\s+har\s+ansatte)\b"


def workforce(texts: DataFrame) -> DataFrame:
    """Head count a text states: the phrases of the best priority that occur have to agree. Lines about a group are blanked
    out by a sign that no phrase holds, so nothing matches across them."""
    lines = F.transform(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\t\r ]+", " "), "\n", -1), lambda x: F.when(x.rlike("(?i)konsern|group"), "#").otherwise(x))
    own = texts.withColumn("body", F.array_join(lines, "\n"))
    said = lambda priority: [F.transform(F.regexp_extract_all("body", F.lit(p), F.lit(1)), norwegian_number) for of, p in WORKFORCE if of == priority]
    table = F.create_map(*(F.lit(x) for word, n in WORD_COUNTS.items() for x in (word, float(n))))
    spelled = F.transform(F.regexp_extract_all("body", F.lit(WORD_PHRASE), F.lit(1)), lambda w: F.element_at(table, F.lower(w)))
    nobody = F.transform(F.regexp_extract_all("body", F.lit(NOBODY), F.lit(0)), lambda x: F.lit(0.0))
    levels = [F.concat(*said(0), nobody), F.concat(*said(1)), F.concat(*said(2), spelled)]
    agreed = [F.array_distinct(F.array_compact(level)) for level in levels]
    best = F.coalesce(*(F.when(F.size(level) > 0, level) for level in agreed))
    return own.withColumn("n_employees", F.when(F.size(best) == 1, best[0])).drop("body")


#: Words that may stand before a company's name in a headline.
TITLE_LEADS = ("av", "for", "fra", "hos", "i", "med", "om", "på", "til", "og", "kjøper", "velger")


def exact_title(company: Column, title: Column) -> Column:
    """All company words stand together in the title, at its start or after a word that introduces a name."""
    plain = lambda x: F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9æøå]+"), F.lit(0))
    c, t = plain(company), plain(F.regexp_replace(title, r"(?s)^(.*) - .*$", "$1"))
    leads = lambda i: (i == 1) | F.coalesce(F.try_element_at(t, F.greatest(i - 1, F.lit(1))).isin(*TITLE_LEADS), F.lit(False))
    return (F.size(c) > 0) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))), lambda i: (F.slice(t, i, F.greatest(F.size(c), F.lit(1))) == c) & leads(i))


#: Sentences for the oracle, with what they state.
SAID = (
    ("Selskapet har 12 ansatte.", 12), ("Konsernet har 900 ansatte.", None), ("Antall ansatte: 1 250", 1250), ("Det er to ansatte i sameiet.", 2), ("12 ansatte\n15 ansatte", None),
    ("Antall årsverk i regnskapsaret er 7,5. Antall ansatte: 9", 7.5), ("Selskapet har ingen ansatte", 0), ("3O ansatte", 30), ("antall\nGroup total\nansatte 5", None), ("Antall ansatte: 1.25O", 1250),
)


def workforce_from_text(spark, sf_dir):
    said = F.element_at(F.array(*(F.lit(t) for t, _ in SAID)), (F.col("doc_id") % len(SAID) + 1).cast("int"))
    return workforce(bind(spark, sf_dir, "documents").select("doc_id", F.concat(said, F.lit("\n"), "text").alias("text"))).select("doc_id", "n_employees")


def title_gate(spark, sf_dir):
    r = bind(spark, sf_dir, "registry")
    n = F.col("organisation_number").cast("bigint")
    title = F.when(n % 3 == 0, F.concat("name", F.lit(" grows - Daily"))).when(n % 3 == 1, F.concat(F.lit("News Group "), "name")).otherwise(F.concat(F.lit("Nytt hos "), "name", F.lit(" - Paper")))
    return r.select("organisation_number", exact_title(F.col("name"), title).alias("exact"))


def _on(name, fn):
    return lambda s, d: fn(bind(s, d, name))


_F = ctes("filings")
QUERIES = {
    "registry_normalize": (_on("registry_raw", registry_row), f"{ctes('registry_raw')} select org as organisation_number, coalesce(nullif(name_b, ''), nullif(navn, ''), '') as name, try_cast(ansatte as int) as employees, coalesce(lower(konkurs) = 'true', false) as bankrupt from registry_raw"),
    "financial_latest_three": (_on("filings", latest_three), f"{_F} select organisation_number, cast(n - 1 as int) as ix, period_year, revenue, annual_result from (select *, row_number() over (partition by organisation_number order by period_year desc) as n from filings) where n <= 3"),
    "filing_years": (_on("filings", filing_years), f"{_F} select organisation_number, string_agg(distinct cast(period_year as varchar), ',' order by cast(period_year as varchar)) as years, max(cast(period_year as varchar)) as first_pdf from filings group by 1"),
    "roles_flatten": (_on("roles", role_rows), f"{ctes('roles')} select organisation_number, role_code, count(*) as n, min(name) as first_name, max(name) as last_name from roles where not inactive group by 1, 2"),
    "locations_flatten": (_on("locations", location_rows), f"{ctes('locations')} select organisation_number, unit, name, coalesce(visiting, postal) as address from locations"),
    "company_answers": (company_answers("How many employees and what revenue, and where?"), f"""{ctes("registry", "filings", "locations")}, l as (select * from (select *, row_number() over (partition by organisation_number order by period_year desc) as n from filings) where n = 1),
 r as (select registry.*, l.period_year, l.revenue from registry left join l on l.organisation_number = registry.organisation_number),
 a as (select organisation_number, 1 as ix, 'Registered name' as label, name as value from r union all select organisation_number, 2, 'Organisation number', organisation_number from r union all select organisation_number, 3, 'Legal form', legal_form from r
 union all select organisation_number, 4, 'Municipality', municipality from r union all select organisation_number, 5, 'Registry employee count', cast(employees as varchar) from r union all select organisation_number, 6, 'Reporting period', cast(period_year as varchar) from r
 union all select organisation_number, 7, 'Revenue', cast(cast(revenue as decimal(18,2)) as varchar) from r
 union all select organisation_number, 100 + n, 'Registered subunit', name from (select *, cast(row_number() over (partition by organisation_number order by seq) as int) as n from locations where organisation_number in (select organisation_number from registry)) where n <= 12)
 select organisation_number, cast(ix as int) as ix, label, value from a where coalesce(value, '') <> ''"""),
    "workforce_from_text": (workforce_from_text, f"select doc_id, cast(case doc_id % {len(SAID)} {' '.join(f'when {i} then {n}' for i, (_, n) in enumerate(SAID) if n is not None)} end as double) as n_employees from documents"),
    "news_title_gate": (title_gate, f"{ctes('registry')} select organisation_number, cast(organisation_number as bigint) % 3 <> 1 as exact from registry"),
}
