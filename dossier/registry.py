"""Query name -> (function, DuckDB SQL); feeds ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("screen", "observations", "sampling", "refresh", "claims", "evidence", "crawl", "scoring", "identity", "normalize", "pages", "feeds", "enrichment", "replay", "control", "html", "profile_diff", "places", "handles", "profile_claims", "domains", "envelopes", "budget", "social_pages")


def _all() -> dict[str, tuple[Callable, str | None]]:
    found: dict[str, tuple[Callable, str | None]] = {}
    for name in MODULES:
        found |= import_module(f"dossier.operators.{name}").QUERIES
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
