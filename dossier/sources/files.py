"""Sources and sinks: bulk registry CSV, organisation lists, resume, JSONL (SRC-01..03, SRC-24, SNK-01, SNK-06)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions.text import digits

#: Header of the bulk file -> column here.
BULK = {
    "organisasjonsnummer": "organisation_number", "navn": "name", "organisasjonsform.kode": "legal_form", "antallAnsatte": "employees",
    "konkurs": "bankrupt", "underAvvikling": "liquidating", "forretningsadresse.kommune": "municipality",
    "forretningsadresse.kommunenummer": "municipality_number", "naeringskode1.kode": "industry_code",
    "naeringskode1.beskrivelse": "industry_label", "hjemmeside": "website", "sisteInnsendteAarsregnskap": "latest_submitted_accounts",
}


def separator(spark: SparkSession, path: str) -> str:
    """The most frequent of ; , TAB in the first 8192 characters."""
    line = "\n".join(r[0] for r in spark.read.text(path).limit(64).collect())[:8192]
    return max(";,\t", key=lambda c: (line.count(c), -";,\t".index(c)))


def bulk_registry(spark: SparkSession, path: str) -> DataFrame:
    """Typed registry rows whose number has nine characters; "" where text is missing, null where a count does not parse.

    A gzip file is one split: its rows are dealt out again before any other work. ``row`` grows in the order of the file.
    """
    raw = spark.read.csv(path, header=True, sep=separator(spark, path), quote='"', escape='"', multiLine=True)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    text = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in raw.columns else F.lit("")
    kinds = {"employees": lambda c: c.try_cast("int"), "bankrupt": lambda c: F.lower(c) == "true", "liquidating": lambda c: F.lower(c) == "true"}
    rows = raw.select(*(kinds.get(name, lambda c: c)(text(header)).alias(name) for header, name in BULK.items()), F.monotonically_increasing_id().alias("row"))
    return rows.where(F.length("organisation_number") == 9).repartition("organisation_number")


#: What an entry of a list may say beside its number.
ANNOTATIONS = ("evaluation_split", "sample_slice")


def organisation_list(spark: SparkSession, path: str) -> DataFrame:
    """(organisation_number, seq, evaluation_split, sample_slice) of a list: a ``.json`` file with a list or an object that has one under
    organisation_numbers, a ``.jsonl`` file, or lines of text. An entry is a number or an object; all but its digits is dropped.

    Raises ValueError where a number has not nine digits or repeats.
    """
    if path.endswith(".json"):
        whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
        listed = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.try_variant_get("v", "$.organisation_numbers", "array<variant>"))
        entries = whole.select(F.posexplode(listed).alias("seq", "e")).withColumn("seq", F.col("seq").cast("long"))
    else:
        lines = spark.read.text(path).where(F.trim("value") != "").select(F.monotonically_increasing_id().alias("seq"), F.trim("value").alias("text"))
        entries = lines.withColumn("e", F.try_parse_json("text"))  # a line of text is a number, or no JSON
    said = [F.try_variant_get("e", "$.organisation_number", "string"), F.try_variant_get("e", "$", "string")]
    number = F.coalesce(*said, *([] if path.endswith((".json", ".jsonl")) else [F.col("text")]), F.lit(""))
    rows = entries.select(digits(number).alias("organisation_number"), "seq", *(F.try_variant_get("e", f"$.{a}", "string").alias(a) for a in ANNOTATIONS))
    bad = rows.agg(F.count_if(F.length("organisation_number") != 9).alias("bad"), (F.count("*") - F.count_distinct("organisation_number")).alias("again")).first()
    if bad["bad"] or bad["again"]:
        raise ValueError(f"{path}: {bad['bad']} numbers without nine digits, {bad['again']} repeated")
    return rows


def requested_profiles(requested: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows of the requested companies in request order; raises where one is missing. Of repeated rows the later one wins, by
    ``row``; without that column the greatest."""
    own = F.struct(*(c for c in registry.columns if c not in ("organisation_number", "row")))
    last = registry.groupBy("organisation_number").agg((F.max_by(own, "row") if "row" in registry.columns else F.max(own)).alias("r"))
    held = requested.join(last, "organisation_number", "left")
    if missing := held.where("r is null").count():
        raise ValueError(f"{missing} requested companies are not in the registry")
    return held.select("seq", "organisation_number", *(c for c in requested.columns if c in ANNOTATIONS), "r.*").orderBy("seq")


def pending(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Requests without a complete profile; what a resumed batch has to do."""
    return requested.join(done.select("organisation_number"), "organisation_number", "left_anti")


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Replace ``path`` by JSON lines: written beside it and renamed, so a failed job leaves the old rows."""
    spark = rows.sparkSession
    own, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    rows.write.json(own)
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs = of(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(of(path)):
        fs.rename(of(path), of(old))
    fs.rename(of(own), of(path))
    if fs.exists(of(old)):
        fs.delete(of(old), True)


def append_events(rows: DataFrame, path: str) -> None:
    """Append-only feed."""
    rows.write.mode("append").json(path)
