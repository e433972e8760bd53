"""Quality rules: robust multivariate outliers per language and source.

Every text gets base statistics and a transformed vector of shape statistics that do not depend on its length. For
each (lang, source) the minimum-covariance-determinant location and scatter are found over all its rows: from two
deterministic starts (medians with MADs, and the spatial signs about them), concentration steps keep the rows of least
Mahalanobis distance that make up the share h until no group's determinant falls; the lesser determinant counts. A step is
one aggregate over (group, distance bin), so no group meets in one task; the bin in which h is reached counts by the part
that completes h. A coordinate's variance is the measured one, but no less than texts of the group's sizes have by chance:
most texts have no symbols, repeated lines or repeated words at all, and the scatter of those nearest the centre is 0. Rows
beyond the 0.999 quantile of chi-square are rejected.

Null or empty text: no words, base_failed. Null lang or source: a group like any other; without such a column all rows
share one. A scatter of five coordinates needs rows: groups under ``min_group`` are judged by the model of all rows of
their language, those of its large groups included; languages under ``min_group`` rows by the model of all rows. Repeated
rows count as often as they occur. doc_id may be of any type.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.shared import broadcast_if_few, cut, give_back, planned_once, quoted, row_key, sole_memory, table, unused

SYMBOLS = "#*$%&|<>"
#: Coordinates: log mean word length; angles asin(sqrt(share)) of symbols, upper-case letters, repeated lines, repeated words.
DIMS = 5
#: Least variance of a coordinate, against singular matrices only.
LEAST = 1e-6
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, x array<double>"
_UPPER = [chr(c) for c in range(0x250) if chr(c).isupper()]
_NO_UPPER = {ord(c): None for c in _UPPER}


def repeat_words(words: list) -> int:
    """Words that stand in a window of three that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, upto = 0, 0  # upto: words before this are counted
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def text_stats(text: str) -> tuple[int, int, int, int, int, int, list[float]]:
    words = text.encode().split()  # bytes: splits at [\x20\x09-\x0D] only
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0, [0.0] * DIMS
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    filled = [line for line in text.split("\n") if line.encode().strip()]
    dup = len(filled) - len(set(filled))
    again = repeat_words(words)
    upper = len(text) - len(text.translate(_NO_UPPER))
    angle = lambda share: math.asin(math.sqrt(min(1.0, share)))
    return n, chars, symbols, dup, again, len(filled), [math.log(chars / n), angle(symbols / chars), angle(upper / chars), angle(dup / len(filled)), angle(again / n)]


def _stats_batches(batches):
    sole_memory("rules")
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        rows = list(zip(*map(text_stats, texts.to_pylist()))) or [[]] * 7
        kinds = [pa.int64()] * 6 + [pa.list_(pa.float64())]
        kept = [batch.column(c) for c in ("doc_id", "_g", "_k1", "_k2")]
        yield pa.RecordBatch.from_arrays(
            kept + [pa.array(v, k) for v, k in zip(rows, kinds)],
            names=["doc_id", "_g", "_k1", "_k2", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "x"],
        )
    give_back()


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def chance() -> Column:
    """Variance of each coordinate by chance in a text of this size: 1 / 4n for the angle of a share of n; repeated words
    come in sixes (two windows of three), and a word's log length varies by about a half."""
    quarter = lambda n: 0.25 / F.col(n)
    return F.array(quarter("n_words"), quarter("word_chars"), quarter("word_chars"), quarter("n_lines"), 6 * quarter("n_words"))


def _chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma P(k/2, x/2) by its series."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    i = 0
    while term > total * 1e-15:
        i += 1
        term *= z / (a + i)
        total += term
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a))) if z > 0 else 0.0


def _chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < p else (low, mid)
    return high


#: A model belongs to a group and a start.
KEYS = ["_g", "_s"]
#: Histogram bins for a unit of a coordinate, and for a doubling of the distance.
_FINE, _COARSE = 256, 64
_MEAN, _LEAST, _FACTOR = [f"m{i}" for i in range(DIMS)], [f"v{i}" for i in range(DIMS)], [f"f{i}_{j}" for i, j in _PAIRS]


def _factor(frame: DataFrame) -> DataFrame:
    """Replace c{i}_{j} of a covariance by f{i}_{j} of its Cholesky factor and by logdet; variances have a floor."""
    made: dict[tuple[int, int], str] = {}
    for i, j in sorted(_PAIRS):
        rest = F.col(f"c{i}_{j}") - sum((F.col(made[i, k]) * F.col(made[j, k]) for k in range(j)), F.lit(0.0))
        if i == j:
            rest = F.sqrt(F.greatest(rest, F.col(f"v{i}") / 16))
        else:
            rest = rest / F.col(made[j, j])
        made[i, j] = f"f{i}_{j}"
        frame = frame.withColumn(made[i, j], rest)
    return frame.select(*KEYS, "rows", sum((2 * F.ln(f"f{i}_{i}") for i in range(DIMS)), F.lit(0.0)).alias("logdet"), *_MEAN, *_LEAST, *_FACTOR)


def _covariance(entry) -> list[Column]:
    return [(F.greatest(entry(i, j), F.col(f"v{i}")) if i == j else entry(i, j)).alias(f"c{i}_{j}") for i, j in _PAIRS]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the factor."""
    z: list[Column] = []
    for i in range(DIMS):
        z.append((F.col("x")[i] - F.col(f"m{i}") - sum((F.col(f"f{i}_{j}") * z[j] for j in range(i)), F.lit(0.0))) / F.col(f"f{i}_{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def _upto(bins: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The bins of a group, least first, up to the one that completes ``share`` of its rows; a group's bins are few.

    _part: how much of a bin's rows belong to the share, 1 but for the last.
    """
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = bins.withColumns({"_before": before, "_all": F.sum("n").over(own)}).where(F.col("_before") < share * F.col("_all"))
    return held.withColumn("_part", F.least(F.lit(1.0), (share * F.col("_all") - F.col("_before")) / F.col("n")))


def _small(groups: DataFrame, most: int = 100_000) -> DataFrame:
    """A table of one row a group, broadcast where it is counted to be small (16 MB at most), else joined by shuffle."""
    return F.broadcast(groups) if groups.count() <= most else groups


def _starts(stats: DataFrame) -> DataFrame:
    """Coordinate medians from histograms, with the squares of MADs (_s 0) or the covariance of spatial signs (_s 1)."""
    dims = [F.struct(F.lit(i).alias("dim"), F.floor(F.col("x")[i] * _FINE).alias("bin")) for i in range(DIMS)]
    bins = stats.select("_g", F.explode(F.array(*dims)).alias("b")).groupBy("_g", "b.dim", "b.bin").agg(F.count("*").alias("n"))
    bins = cut(bins, "mcd-bins")
    middle = _upto(bins, ["_g", "dim"], 0.5).groupBy("_g", "dim").agg(F.max("bin").alias("mid"), F.first("_all").alias("rows"))
    off = bins.join(middle, ["_g", "dim"]).select("_g", "dim", F.abs(F.col("bin") - F.col("mid")).alias("bin"), "n", "mid", "rows")
    mad = _upto(off, ["_g", "dim"], 0.5).groupBy("_g").agg(
        F.first("rows").alias("rows"),
        *(F.max(F.when(F.col("dim") == i, F.col("mid") / _FINE)).alias(f"m{i}") for i in range(DIMS)),
        *(F.max(F.when(F.col("dim") == i, 1.4826 * F.col("bin") / _FINE)).alias(f"s{i}") for i in range(DIMS)),
    )
    least = stats.groupBy("_g").agg(*(F.greatest(F.avg(F.col("v")[i]), F.lit(LEAST)).alias(f"v{i}") for i in range(DIMS)))
    centre = cut(mad.join(least, "_g"), "mcd-centre")
    scale = lambda i: F.greatest(F.col(f"s{i}"), F.sqrt(f"v{i}"))
    z = [(F.col("x")[i] - F.col(f"m{i}")) / scale(i) for i in range(DIMS)]
    far = sum((c * c for c in z), F.lit(0.0))
    signs = stats.join(_small(centre), "_g").groupBy("_g").agg(*(F.avg(F.when(far > 0, z[i] * z[j] / far)).alias(f"u{i}_{j}") for i, j in _PAIRS))
    spread = lambda i, j: DIMS * scale(i) * scale(j) * F.coalesce(F.col(f"u{i}_{j}"), F.lit(1.0 / DIMS if i == j else 0.0))
    own = ["_g", "rows", *_MEAN, *_LEAST]
    alone = centre.select(*own, F.lit(0).alias("_s"), *_covariance(lambda i, j: F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0)))
    signed = centre.join(signs, "_g").select(*own, F.lit(1).alias("_s"), *_covariance(spread))
    return _factor(alone.unionByName(signed))


def _concentrate(stats: DataFrame, now: DataFrame, share: float) -> DataFrame:
    """Mean and scatter of the rows nearest the centre that make up ``share`` of each group."""
    grow = share / _chi2_cdf(_chi2_quantile(share, DIMS), DIMS + 2)  # consistency at the normal
    far = stats.join(_small(now), "_g").withColumn("bin", F.floor(_COARSE * F.log2(1e-6 + _distance())))
    x = F.col("x")
    sums = {f"s{i}": x[i] for i in range(DIMS)} | {f"s{i}_{j}": x[i] * x[j] for i, j in _PAIRS}
    least = [F.first(v).alias(v) for v in _LEAST]
    bins = far.groupBy(*KEYS, "bin").agg(F.count("*").alias("n"), *least, *(F.sum(v).alias(k) for k, v in sums.items()))
    part = F.col("_part")
    near = _upto(bins, KEYS, share).groupBy(*KEYS).agg(F.first("_all").alias("rows"), F.sum(F.col("n") * part).alias("h"), *least, *(F.sum(F.col(k) * part).alias(k) for k in sums))
    near = near.select(*KEYS, "rows", *_LEAST, *((F.col(k) / F.col("h")).alias(k if "_" in k else f"m{k[1:]}") for k in sums))
    spread = lambda i, j: grow * (F.col(f"s{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
    return _factor(near.select(*KEYS, "rows", *_MEAN, *_LEAST, *_covariance(spread)))


def mcd(stats: DataFrame, share: float = 0.75, tolerance: float = 1e-3, most_steps: int = 200) -> DataFrame:
    """Per group of ``stats(_g, x)``: rows, logdet, mean m0.. and Cholesky factor f0_0.. of its scatter.

    ``v``, where there is one, has a row's variances by chance: their means over a group are its least variances.
    Groups leave the steps as their log determinants fall by ``tolerance`` no more. RuntimeError if any still falls after
    ``most_steps``.
    """
    if "v" not in stats.columns:
        stats = stats.withColumn("v", F.array(*[F.lit(LEAST)] * DIMS))
    with planned_once(stats.sparkSession):
        return _steps(stats, share, tolerance, most_steps)


def _steps(stats: DataFrame, share: float, tolerance: float, most_steps: int) -> DataFrame:
    now, settled = cut(_starts(stats), "mcd"), []
    for at in range(most_steps):
        fresh = _concentrate(stats, now, share)
        names = [c for c in fresh.columns if c not in KEYS]
        if at:  # the determinant may only fall
            both = fresh.join(now.select(*KEYS, F.struct(*names).alias("old")), KEYS)
            falls = F.col("logdet") < F.col("old.logdet") - tolerance
            stepped = both.select(*KEYS, falls.alias("_falls"), *(F.when(F.col("old.logdet") < F.col("logdet"), F.col(f"old.{c}")).otherwise(F.col(c)).alias(c) for c in names))
        else:
            stepped = fresh.withColumn("_falls", F.lit(True))
        stepped = cut(stepped, "mcd")
        settled.append(stepped.where("not _falls"))
        now = stepped.where("_falls").drop("_falls")
        if now.isEmpty():
            break
    else:
        raise RuntimeError("scatters did not settle")
    done = reduce(DataFrame.unionByName, settled)
    best = F.min_by(F.struct("rows", "logdet", *_MEAN, *_LEAST, *_FACTOR), F.struct("logdet", "_s"))
    return cut(done.groupBy("_g").agg(best.alias("b")).select("_g", "b.*"), "mcd-best")


def judge(docs: DataFrame, cut_at: float | None = None, min_group: int = 60) -> DataFrame:
    """doc_id, row key, base statistics, base_failed, distance and kept of every row of ``docs``."""
    cut_at = cut_at or _chi2_quantile(0.999, DIMS)
    k1, k2 = row_key(docs)
    parts = [(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")]
    own = docs.select("doc_id", "text", F.to_json(F.struct(*parts)).alias("_g"), k1.alias("_k1"), k2.alias("_k2"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    stats = cut(own.mapInArrow(_stats_batches, f"doc_id {kind}, _g string, _k1 long, _k2 long, {_STATS}"), "rule-stats")
    many = stats.where("n_words >= 50").groupBy("_g").count()
    language = F.to_json(F.struct(F.get_json_object("_g", "$.lang").alias("lang")))
    names = many.withColumn("_lang", F.concat(F.lit("lang "), language))
    small = F.col("count") < min_group
    tongues = names.groupBy("_lang").agg(F.sum("count").alias("_langs"), F.max(small).alias("_wanted"))
    tongues = tongues.withColumn("_large", F.col("_langs") >= min_group)
    tongues = tongues.join(tongues.agg(F.max(F.col("_wanted") & ~F.col("_large")).alias("_all")))
    names = names.join(tongues, "_lang").withColumn("_to", F.when(~small, F.col("_g")).when(F.col("_large"), F.col("_lang")).otherwise("all"))
    # A row counts in its own group's model if that is large, and in those of its language and of all where a small group needs them.
    into = F.array(F.when(~small, F.col("_g")), F.when(F.col("_wanted") & F.col("_large"), F.col("_lang")), F.when(F.col("_all"), "all"))
    names = cut(names.select("_g", "_to", F.array_compact(into).alias("_into")), "rule-groups")
    held = stats.where("n_words >= 50").join(_small(names), "_g").select(F.explode("_into").alias("_g"), "x", chance().alias("v"))
    found = mcd(cut(held, "rule-vectors"))
    models = cut(names.join(found.withColumnRenamed("_g", "_to"), "_to").drop("_into", "_to"), "rule-models")
    scored = stats.join(_small(models), "_g", "left")
    far = F.coalesce(_distance(), F.lit(0.0))
    scored = scored.withColumns({"base_failed": base_failed(), "distance": far})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= cut_at))


def keep_regular(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs`` whose text passes, unchanged; the anti-join carries keys of the rejected only."""
    n1, n2 = unused(docs.columns, "_k1", "_k2")
    gone = judge(docs, **settings).where("not kept").select(F.col("_k1").alias(n1), F.col("_k2").alias(n2)).distinct()
    k1, k2 = row_key(docs)
    held = docs.select(*map(quoted, docs.columns), k1.alias(n1), k2.alias(n2))
    return held.join(broadcast_if_few(cut(gone, "rule-rejects"), 1_000_000), [n1, n2], "left_anti").select(*map(quoted, docs.columns))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
