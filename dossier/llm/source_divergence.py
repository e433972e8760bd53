"""Source divergence audit: how the words of a source differ from those of other sources and of its whole language.

A task counts the terms of its documents in byte-wise radix tries, one per language, whose leaves hold a counter per source
and the number of documents; a trie that reaches ``LEAVES`` is read out in UTF-8 order and begun anew. The runs are dealt by
ranges of (language, term), so that all parts of a term meet in one task whatever source they come from, and their walks are
merged there: the parts of a term are neighbours, and only the last term waits for more. Terms found in ``min_docs``
documents of the language are written, in order. A last walk over them adds up the pair sums of all sources of a language
and keeps, per source, the best ``top`` terms with ties by their bytes; tasks return these sums and candidates only.

Numbers are whole throughout: shares per 10^9 by long division in steps of 1,000, which holds for counts below 9 * 10^15.
Sources of a language are taken in blocks of ``SOURCES``, a pass for each pair of blocks, and languages in packs of about
``GROUPS`` sources, so neither a task nor the driver holds more than two blocks of a language, or a pack.

Null text, lang and source count as empty strings. Documents without terms still make their (lang, source) occur. Repeated
rows count as often as they occur. Empty in, empty out. Columns other than text, lang and source are not read.
"""

from __future__ import annotations

import gc
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.shared import cut, give_back, sole_memory, table

#: Leaves that a task's tries hold before they are read out, and counters before they go into the tries.
LEAVES, PENDING = 200_000, 250_000
#: Terms that a node holds before it bursts into nodes for the next byte.
BURST = 1_000
SOURCES, GROUPS = 512, 100_000
#: Bytes of a text that are split at once.
WINDOW = 1 << 20
SCALE = 10**9
#: Fixed by the contract: term bytes are letters of ASCII, lower-cased, and all of 0x80 and above; the rest parts terms.
_TERM = bytes((c + 32 if c < 91 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, window by window; a window ends between terms."""
    at = 0
    while at < len(text):
        end = at + WINDOW
        piece = text[at:end].translate(_TERM)
        while end < len(text) and 32 not in piece:
            piece += text[end : end + WINDOW].translate(_TERM)
            end += WINDOW
        if end < len(text):
            piece = piece[: piece.rindex(32) + 1]
        at += len(piece)
        yield piece.split()


class Trie:
    """A radix trie over bytes: a leaf is a term's counter per source. Nodes with few terms below them hold these as a list of
    suffixes, which bursts into a node per next byte when it has more than ``BURST``.

    ``index`` has the leaves by term, so only new terms go down the tree. ``docs`` counts documents by term.
    """

    class Node:
        __slots__ = ("held", "below")

        def __init__(self):
            self.held, self.below = [], None

        def burst(self) -> None:
            held, self.held, self.below = self.held, [], {}
            for suffix in held:
                self.at(suffix).held.append(suffix[1:])

        def at(self, suffix: bytes) -> Trie.Node:
            """The node below for the first byte of ``suffix``; this one for the end of a term."""
            if not suffix:
                return self
            child = self.below.get(suffix[0])
            if child is None:
                child = self.below[suffix[0]] = Trie.Node()
            return child

    def __init__(self):
        self.root, self.index, self.docs = Trie.Node(), {}, Counter()

    def add(self, source: str, counts: Counter) -> None:
        """Merge a counter of terms into the leaves' counters of ``source``."""
        index = self.index
        for term, n in counts.items():
            leaf = index.get(term)
            if leaf is None:
                index[term] = {source: n}
                self._insert(term)
            else:
                leaf[source] = leaf.get(source, 0) + n

    def _insert(self, term: bytes) -> None:
        node, at = self.root, 0
        while node.below is not None and at < len(term):
            node, at = node.at(term[at:]), at + 1
        node.held.append(term[at:])
        if node.below is None and len(node.held) > BURST:
            node.burst()

    def walk(self) -> Iterator[tuple[list[bytes], list[dict]]]:
        """Terms and leaves, node by node, in the order of bytes, which is that of UTF-8 code points."""
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            if node.held:
                found = [prefix + suffix for suffix in sorted(node.held)]
                yield found, [self.index[term] for term in found]
            if node.below:
                stack += [(prefix + bytes((first,)), node.below[first]) for first in sorted(node.below, reverse=True)]


_RUN = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_RUN_DDL = "lang string, term binary, docs long, sources array<string>, counts array<long>"


def _rows(lang: str, trie: Trie, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    def batch():
        ends = pa.array(np.append(0, np.cumsum(list(map(len, leaves)))), pa.int32())
        flat = [list(chain.from_iterable(leaves)), list(chain.from_iterable(map(dict.values, leaves)))]
        lists = [pa.ListArray.from_arrays(ends, pa.array(f, kind)) for f, kind in zip(flat, (pa.string(), pa.int64()))]
        docs = pa.array(list(map(trie.docs.__getitem__, names)), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names, pa.binary()), docs, *lists], schema=_RUN)

    names, leaves = [], []
    for some, of in trie.walk():
        names += some
        leaves += of
        if len(names) >= most:
            yield batch()
            names, leaves = [], []
    if names:
        yield batch()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a task's documents (lang, source, text in bytes): walks of its tries."""
    tries: dict[str, Trie] = defaultdict(Trie)
    counted: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def pour():
        for (lang, source), counter in counted.items():
            tries[lang].add(source, counter)
        counted.clear()

    def out():
        for lang in sorted(tries):
            yield from _rows(lang, tries.pop(lang))

    sole_memory("source_divergence")
    gc.disable()  # a trie has many small parts and no cycles
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in (0, 1)), batch.column(2)):
            seen: set = set()
            for piece in terms(text.as_py()):
                counted[lang, source].update(piece)
                seen.update(piece)
            tries[lang].docs.update(seen)
        if sum(map(len, counted.values())) > PENDING or sum(len(t.docs) for t in tries.values()) > LEAVES:
            pour()
            if sum(len(t.index) for t in tries.values()) > LEAVES:
                yield from out()
    pour()
    yield from out()
    gc.enable()
    give_back()


def _merging(min_docs: int):
    def merged(rows: pa.Table, whole: bool) -> tuple[pa.Table, pa.RecordBatch | None]:
        """The rows behind the last term, and kept terms before it (with ``whole``, all of them)."""
        lang, term = rows.column(0).combine_chunks(), rows.column(1).combine_chunks()
        other = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(other) + 1])
        ends = np.append(starts[1:], len(term))
        docs = np.add.reduceat(rows.column(2).to_numpy(), starts)
        kept = docs >= min_docs
        if not whole:
            kept[-1] = False
        found = None
        if kept.any():
            group = np.repeat(np.where(kept, np.cumsum(kept) - 1, -1), ends - starts)  # of each row; -1: not kept
            part = rows.filter(pa.array(group >= 0)).combine_chunks()
            lists = part.column(3).combine_chunks()
            names = lists.flatten().dictionary_encode()
            at = np.repeat(group[group >= 0], np.asarray(lists.value_lengths()))
            cell, inverse = np.unique(at * len(names.dictionary) + names.indices.to_numpy(), return_inverse=True)
            sums = np.zeros(len(cell), np.int64)
            np.add.at(sums, inverse, part.column(4).combine_chunks().flatten().to_numpy())
            of = pa.array(starts[kept])
            offsets = pa.array(np.searchsorted(cell, np.arange(int(kept.sum()) + 1) * len(names.dictionary)), pa.int32())
            sources = names.dictionary.take(pa.array(cell % len(names.dictionary)))
            made = [pa.ListArray.from_arrays(offsets, sources), pa.ListArray.from_arrays(offsets, pa.array(sums))]
            found = pa.RecordBatch.from_arrays([lang.take(of), term.take(of), pa.array(docs[kept]), *made], schema=_RUN)
        return rows.slice(starts[-1]), found

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kept terms of one range. Rows are walks of tries in one order, so the parts of a term are neighbours."""
        left = None
        for batch in (b for b in batches if b.num_rows):
            now = pa.Table.from_batches([batch], _RUN)
            left, found = merged(now if left is None else pa.concat_tables([left, now]), False)
            if found is not None:
                yield found
        if left is not None and (last := merged(left, True)[1]) is not None:
            yield last

    return merge


def source_terms(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """(lang, term, docs, sources, counts): terms in ``min_docs`` documents of a language and their counts by source; written."""
    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text"))
    runs = cut(docs.select(lang.alias("lang"), source.alias("source"), text.cast("binary").alias("text")).mapInArrow(_count, _RUN_DDL), "divergence-runs")
    ordered = runs.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    kept = ordered.mapInArrow(_merging(min_docs), _RUN_DDL)
    return cut(kept.withColumn("term", F.col("term").cast("string")), "divergence-terms")


def share(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """floor(10^9 * counts / total), exact in 64 bits."""
    out, rest = np.zeros_like(counts + total), counts + 0 * total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _auditing(groups: dict, block: tuple[int, int], top: int):
    """``groups``: lang -> (sources, their blocks, their totals, kept terms, total of the language), sources in order."""

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, best = None, None, None

        def out():
            if now is None:
                return
            sources, blocks = groups[now][:2]
            a, b = np.triu_indices(len(sources), 1)
            wanted = (blocks[a] == block[0]) & (blocks[b] == block[1])
            rows = [(now, sources[i], "pair", sources[j], int(sums[i, j])) for i, j in zip(a[wanted], b[wanted])]
            rows += [(now, sources[i], "term", term, -value) for i, found in best.items() for value, term in found]
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "part", "item", "value"), map(list, zip(*rows)))))

        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                if lang not in groups:
                    continue
                own = batch.filter(pc.equal(batch.column(0), lang))
                sources, blocks, totals, kept, whole = groups[lang]
                if lang != now:
                    yield from out()
                    now, sums, best = lang, np.zeros((len(sources), len(sources)), np.int64), defaultdict(list)
                lengths = np.asarray(own.column(2).value_lengths())
                row, n = np.repeat(np.arange(own.num_rows), lengths), own.column(3).flatten().to_numpy()
                at = pc.index_in(own.column(2).flatten(), value_set=pa.array(sources, pa.string())).fill_null(-1).to_numpy()
                counts = np.zeros((own.num_rows, len(sources)), np.int64)
                counts[row[at >= 0], at[at >= 0]] = n[at >= 0]
                p = 1 + share(counts + 2, (totals + 2 * kept)[None, :])
                for i in np.flatnonzero(blocks == block[0]):
                    sums[i] += _distance(p[:, i : i + 1], p).sum(axis=0)
                if block[0] == block[1]:
                    q = 1 + share(np.add.reduceat(n, np.cumsum(lengths) - lengths) + 2, np.int64(whole + 2 * kept))
                    value, above = _distance(p, q[:, None]), (counts > 0) & (p > q[:, None])
                    for i in range(len(sources)):
                        rows = np.flatnonzero(above[:, i])
                        if len(rows) > top:
                            rows = rows[value[rows, i] >= np.partition(value[rows, i], -top)[-top]]
                        if len(rows):
                            more = [(-int(value[r, i]), own.column(1)[int(r)].as_py()) for r in rows]
                            best[i] = sorted(best[i] + more, key=lambda x: (x[0], x[1].encode()))[:top]
        yield from out()

    return audit


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources of the language by distance (part pair) and the ``top`` terms a
    source has more of than its language (part term)."""
    kept = source_terms(docs, min_docs)
    by_source = kept.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("whole"))
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    groups = docs.select(lang.alias("lang"), source.alias("source")).distinct().join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = cut(groups.na.fill(0, ["total", "kept", "whole"]).withColumn("block", F.floor(nth / SOURCES)), "divergence-groups")
    size = groups.agg(F.count("*").alias("n"), F.max("block").alias("last")).first()
    packs, last = -(-size["n"] // GROUPS) or 1, size["last"] or 0
    found = []
    for pack in range(packs):
        mine = groups.where((F.pmod(F.xxhash64("lang"), F.lit(packs)) == pack) & (F.col("kept") > 0))
        for i in range(last + 1):
            for j in range(i, last + 1):
                held: dict = defaultdict(lambda: ([], [], []))
                ends = {}
                for r in mine.where(F.col("block").isin(i, j)).orderBy("lang", "source").collect():
                    for part, v in zip(held[r["lang"]], (r["source"], r["block"], r["total"])):
                        part.append(v)
                    ends[r["lang"]] = r["kept"], r["whole"]
                known = {k: (s, np.array(b), np.array(t, np.int64), *ends[k]) for k, (s, b, t) in held.items()}
                own = kept.select("lang", "term", "sources", "counts").sortWithinPartitions("lang", "term")
                found.append(own.mapInArrow(_auditing(known, (i, j), top), "lang string, source string, part string, item string, value long"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    rows = cut(rows, "divergence-found")
    sums = rows.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    none = groups.where("kept = 0").select("lang", "source")
    zero = none.join(none.withColumnRenamed("source", "item"), "lang").where("source < item").withColumn("value", F.lit(0).cast("long"))
    one_way = sums.unionByName(zero)
    pairs = one_way.unionByName(one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")).withColumn("part", F.lit("pair"))
    every = pairs.unionByName(rows.where("part = 'term'"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    every = every.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return every.select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = r"""
with d as (select row_number() over () as r, coalesce(text, '') as t, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term from w group by all having count(distinct r) >= 10),
c as (select lang, source, term, count(*) as n from w semi join k using (lang, term) group by all),
v as (select lang, count(*) as v from k group by all),
g as (select distinct lang, source from d),
gn as (select g.lang, g.source, coalesce(sum(n), 0)::hugeint as total from g left join c using (lang, source) group by all),
lt as (select lang, term, sum(n)::hugeint as n from c group by lang, term),
ln as (select lang, term, n, (sum(n) over (partition by lang))::hugeint as total from lt),
q as (select lang, term, (1 + 1000000000::hugeint * (n + 2) // (total + 2 * v))::hugeint as q from ln join v using (lang)),
p as (select k.lang, gn.source, k.term, coalesce(c.n, 0) as n, (1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (total + 2 * v))::hugeint as p
  from k join v using (lang) join gn using (lang) left join c on c.lang = k.lang and c.source = gn.source and c.term = k.term),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
found as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
 union all select p.lang, source, 'term', p.term, ((p - q) * (p - q) // (p + q))::bigint from p join q using (lang, term) where n > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from found)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
