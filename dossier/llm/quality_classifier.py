"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): pairwise interactions of rank
``RANK`` in time linear in the text. x: log counts of words hashed into ``BUCKETS``, scaled to unit length, then
structure statistics of the whole text, then metadata (the n_chars column, where given). It is fitted on the driver on
a bounded sample of labelled rows (``sample_rows``, least hashes first) and sent to every task: its size is fixed.

Null or empty text: only the constant counts. Labels joined by doc_id; null labels or ids teach nothing, a label given
twice teaches once, and of rows that repeat a labelled doc_id the one of the least text hash teaches. Repeated rows are
scored alike. Other columns pass through; ``score`` and ``predicted`` are replaced. A null n_chars, or none that is a
number, counts as 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.shared import give_back, quoted, sole_memory, table, unused

BUCKETS, RANK, STRUCTURE = 4096, 6, 12
WIDTH = BUCKETS + STRUCTURE + 1
_UPPER = {c: None for c in range(0x250) if chr(c).isupper()}
_SEEN: dict[bytes, int] = {}


def _bucket(word: bytes) -> int:
    found = _SEEN.get(word)
    if found is None:
        if len(_SEEN) > 150_000:  # only a memory of hashes; a word's bucket is the same when found again
            _SEEN.clear()
        found = _SEEN[word] = zlib.crc32(word) % BUCKETS
    return found


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one whole text."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    n = len(words)
    counts = np.bincount(np.fromiter(map(_bucket, words), np.int64, n), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    own = np.log1p(counts[at])
    own /= np.sqrt((own * own).sum())
    kinds, lines = len(set(words)), text.split("\n")
    size = len(text)
    most = Counter(words).most_common(1)[0][1]
    marks = sum(map(text.count, "#*$%&|<>"))
    shape = [
        math.log1p(n) / 10,
        size / n / 10,
        (size - len(text.translate(_UPPER))) / size,
        marks / n,
        text.count("!") / n,
        (text.count(".") + text.count(",")) / n,
        1 - kinds / n,
        most / n,
        1 - len(set(lines)) / len(lines),
        sum(map(text.count, "0123456789")) / size,
        math.log1p(len(lines)) / 10,
        kinds / n * math.log1p(n) / 10,
    ]
    extra = math.log1p(max(n_chars, 0)) / 15 if n_chars is not None else 0.0
    return np.concatenate([at, np.arange(BUCKETS, WIDTH)]), np.concatenate([own, shape, [extra]]).astype(np.float32)


class FactorisationMachine:
    def __init__(self, width: int = WIDTH, rank: int = RANK, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(width, np.float64)
        self.v = draw.normal(0, 0.02, (width, rank))

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.v[at] * x[:, None]
        return float(self.bias + self.w[at] @ x + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum()))

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.raw(at, x)))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.08, decay: float = 1e-5) -> FactorisationMachine:
        """Adagrad on the logistic loss, classes weighted alike."""
        if not rows:
            return self
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        gw, gv, gb = np.full(self.w.shape, 1e-3), np.full(self.v.shape, 1e-3), 1e-3
        draw = np.random.default_rng(11)
        for _ in range(epochs):
            order = draw.permutation(len(rows))
            for i in range(0, len(order), batch):
                own = order[i : i + batch]
                x = np.zeros((len(own), self.w.size))
                for k, r in enumerate(own):
                    x[k, rows[r][0]] = rows[r][1]
                xv = x @ self.v
                z = self.bias + x @ self.w + 0.5 * ((xv**2).sum(1) - ((x * x) @ (self.v**2)).sum(1))
                off = weight[own] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]) / len(own)
                dw = x.T @ off + decay * self.w
                dv = x.T @ (off[:, None] * xv) - self.v * ((x * x).T @ off)[:, None] + decay * self.v
                db = off.sum()
                gw, gv, gb = gw + dw * dw, gv + dv * dv, gb + db * db
                self.w -= rate * dw / np.sqrt(gw)
                self.v -= rate * dv / np.sqrt(gv)
                self.bias -= rate * db / math.sqrt(gb)
        return self


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _feature_batches(batches):
    for batch in batches:
        texts, chars = pc.fill_null(batch.column("text"), "").to_pylist(), batch.column("n_chars").to_pylist()
        rows = [features(t, c) for t, c in zip(texts, chars)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("quality"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
            names=["quality", "at", "x"],
        )


def _with_meta(docs: DataFrame) -> Column:
    return F.col("n_chars").try_cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 8000) -> FactorisationMachine:
    """Learn ``labels.quality`` from at most ``sample_rows`` rows whose remainder is not 0."""
    taught = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
    taught = taught.where(remainder(F.col("_id")) != 0)
    taught = taught.distinct().orderBy(F.xxhash64("_id"), "_id", "quality").limit(sample_rows)
    own = docs.select("doc_id", "text", _with_meta(docs).alias("n_chars"))
    rows = own.join(F.broadcast(taught), F.col("doc_id") == F.col("_id")).groupBy("_id", "quality")
    rows = rows.agg(F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text"), "n_chars")).alias("row"))  # one row a label at most
    rows = rows.select("quality", "row.text", "row.n_chars", F.xxhash64("_id", "row.text").alias("o"))
    rows = rows.repartition(8, "o").mapInArrow(_feature_batches, "quality int, at array<int>, x array<float>").toArrow()
    y = rows.column("quality").to_numpy().astype(float)
    at, x = (rows.column(c).combine_chunks() for c in ("at", "x"))
    cuts = np.append(0, pc.list_value_length(at).to_numpy()).cumsum().tolist()
    at, x = at.flatten().to_numpy(), x.flatten().to_numpy()
    pairs = [(at[i:j], x[i:j]) for i, j in zip(cuts, cuts[1:])]  # views: the sample stays in two flat arrays
    order = sorted(range(len(pairs)), key=lambda i: (y[i], pairs[i][0].size, pairs[i][1].sum()))
    return FactorisationMachine().fit([pairs[i] for i in order], y[order])


def classify(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score and a prediction, in columns of these names."""
    kept = [c for c in docs.columns if c not in names]
    own = docs.select(*(quoted(c).alias(f"c{i}") for i, c in enumerate(kept)), _with_meta(docs).alias("meta"), F.col("text").alias("body"))
    schema = T.StructType([*own.schema.fields[:-2], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def scored(batches):
        sole_memory("classifier", _SEEN.clear)
        for batch in batches:
            texts, chars = pc.fill_null(batch.column("body"), "").to_pylist(), batch.column("meta").to_pylist()
            found = [model.score(*features(t, c)) for t, c in zip(texts, chars)]
            made = [pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*batch.schema.names[:-2], "score", "predicted"])
        give_back()

    return own.mapInArrow(scored, schema).toDF(*kept, *names)


def keep_good(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` that are predicted to be of quality, unchanged."""
    names = unused(docs.columns, "_score", "_predicted")
    found = classify(docs, model, threshold, tuple(names))
    return found.where(F.col(names[1]) == 1).select(*map(quoted, docs.columns))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held_out = (remainder(F.col("doc_id")) == 0).alias("held_out")
    return classify(docs, model).select("doc_id", held_out, "score", "predicted")
