"""Registered domains by a table of public suffix rules: the longest rule decides, exceptions before all others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.bindings import bind

#: Labels of a host that are looked at; no host has more.
MOST_LABELS = 127


def registered_domains(hosts: DataFrame, rules: DataFrame, column: str = "host") -> DataFrame:
    """``hosts`` with ``domain``: the public suffix of its host and one label more; "" where there is none, and for addresses.

    ``rules(rule)`` are ``com``, ``co.uk``, ``*.ck`` and ``!www.ck``, as the public list has them; without a rule the last label is
    the suffix. Distinct hosts are spread into their endings, each asking for the three rules that may hold for it by one
    equi-join; of the rules met an exception stands, else the one with most labels.
    """
    distinct = hosts.select(F.lower(F.col(column)).alias("_host")).where("_host is not null").distinct()
    named = distinct.where(~F.col("_host").rlike(r"^[0-9.]*$|[\[\]:]|^\.|\.$|\.\.")).withColumn("_labels", F.split("_host", r"\.")).withColumn("_n", F.size("_labels"))
    ending = lambda i: F.array_join(F.slice("_labels", i, F.col("_n")), ".")
    ask = lambda key, k, rank: F.struct(key.alias("rule"), k.alias("k"), F.lit(rank).alias("exception"))
    asked = F.flatten(F.transform(F.sequence(F.lit(1), F.least("_n", F.lit(MOST_LABELS))), lambda i: F.array(ask(ending(i), F.col("_n") - i + 1, 0), ask(F.concat(F.lit("*."), ending(i + 1)), F.col("_n") - i + 1, 0), ask(F.concat(F.lit("!"), ending(i)), F.col("_n") - i, 1))))
    known = rules.select(F.lower(F.trim("rule")).alias("rule")).distinct()
    met = named.select("_host", F.inline(asked)).join(known, "rule").groupBy("_host").agg(F.max(F.struct("exception", "k")).alias("m"))
    held = named.join(met, "_host", "left").withColumn("_k", F.coalesce("m.k", F.lit(1)))
    domain = F.when(F.col("_n") > F.col("_k"), F.array_join(F.slice("_labels", F.col("_n") - F.col("_k"), F.col("_k") + 1), ".")).otherwise("")
    found = held.select("_host", domain.alias("domain"))
    own = hosts.withColumn("_host", F.lower(F.col(column)))
    return own.join(found, "_host", "left").withColumn("domain", F.coalesce("domain", F.lit(""))).drop("_host")


#: A few rules of every kind, for the oracle; users bring the public list.
RULES = ("no", "com", "uk", "co.uk", "kommune.no", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp", "jp", "github.io")


def _hosts(s, d):
    """Hosts of pages and twelve kinds made of their numbers."""
    k = F.col("page_id")
    made = F.array(*(F.struct(F.lit(i).alias("kind"), F.concat(F.lit(a), k.cast("string"), F.lit(b)).alias("host")) for i, (a, b) in enumerate(_KINDS)))
    return bind(s, d, "pages").select("page_id", F.inline(made))


#: What stands before and after a number in a host, and in its registered domain (None: there is none).
_KINDS = (("www.shop", ".co.uk"), ("a.b.site", ".no"), ("x.oslo", ".kommune.no"), ("a.b", ".ck"), ("", ".ck"), ("A.B.W", ".kawasaki.jp"), ("x.y", ".unknown"), ("me", ".github.io"), ("localhost", ""), ("10.0.0.", ""))
_DOMAINS = (("shop", ".co.uk"), ("site", ".no"), ("oslo", ".kommune.no"), ("a.b", ".ck"), None, ("b.w", ".kawasaki.jp"), ("y", ".unknown"), ("me", ".github.io"), None, None)
QUERIES = {
    "public_suffix_domains": (lambda s, d: registered_domains(_hosts(s, d), s.createDataFrame([(r,) for r in RULES], "rule string")).select("page_id", "kind", "domain"),
     "select page_id, kind, case when a is null then '' else a || page_id || b end as domain from pages, (values " + ", ".join(f"(cast({i} as int), {'null, null' if x is None else repr(x[0]) + ', ' + repr(x[1])})" for i, x in enumerate(_DOMAINS)) + ") t(kind, a, b)"),
}
