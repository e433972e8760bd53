"""Best-fit packing by length histogram.

Texts become token ids, an end id 0 is added, and only documents beyond ``size`` ids are cut, into pieces of ``size``.
The plan is made over counts by length, not over documents: longest first, every length goes where the least room that
suffices is left, whole runs of equal sequences at a time. Pieces then take the planned slots by joining on their rank
within their length. A rank is the number within (task, length), given while tokenising and written with the piece,
plus the count of that length in earlier tasks; no group of equal lengths meets in one task.

Null or empty text: one piece of the end id. Repeated rows are packed as often as they occur; a null doc_id stays null,
and doc_id may be of any type. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossier.llm.shared import cut, give_back, sole_memory, table

SIZE, END = 2048, b"\0\0\0\0"


class WordCoder:
    """Ids as little-endian bytes, through a memory of what stands between ASCII white space.

    The tokenizer drops white space and looks at nothing across it, so a text's ids are those of its chunks in turn. A batch
    is split and dictionary-encoded in Arrow and its ids are assembled by one take; only distinct chunks pass through Python.
    Chunks not met before are encoded many at a time, joined by a special token that splits them again.
    """

    SPLIT, SPLIT_ID = "<|endoftext|>", 49407

    def __init__(self, path: str, remember: int = 250_000):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.enders = {i for token, i in self.encoder.get_vocab().items() if token.endswith("</w>")}
        self.remember, self.known, self.older = remember, {}, {}

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _parts(chunk: bytes) -> tuple[bytes, ...]:
        """A word and the stops after it, which the tokenizer takes apart too; anything else stays whole."""
        word = chunk.rstrip(b".,!?;:")
        if word.isascii():
            if word.isalpha():
                return (word.lower(), chunk[len(word) :]) if len(word) < len(chunk) else (word.lower(),)
        elif len(word) < len(chunk) and unicodedata.normalize("NFC", word.decode()).lower()[-1].isalpha():
            return word, chunk[len(word) :]
        return (chunk,)

    def _learn(self, chunks: list[bytes]) -> None:
        known, older = self.known, self.older
        split = {c: self._parts(c) for c in chunks}
        fresh = set().union(*split.values()).difference(known) if split else set()
        known.update((p, older[p]) for p in fresh if p in older)
        self._encode_parts([p for p in fresh if p not in older])
        for c, parts in split.items():
            if c not in known:
                known[c] = b"".join([known[p] for p in parts])

    def _encode_parts(self, parts: list[bytes]) -> None:
        """Words of letters only are one unit each, whose last id ends a word; other parts are told apart by SPLIT."""
        letters, even = [], []
        for p in parts:
            if p.isalpha() or (not p.isascii() and unicodedata.normalize("NFC", p.decode()).lower().isalpha()):
                letters.append(p)
            elif b"<|" in p:
                self.known[p] = array("I", self._plain([p.decode()])[0]).tobytes()
            else:
                even.append(p)
        for own in (letters[i : i + 2000] for i in range(0, len(letters), 2000)):
            ids = array("I", self._plain([b" ".join(own).decode()])[0])
            self._remember(own, [i + 1 for i, token in enumerate(ids) if token in self.enders], ids, 0)
        for own in (even[i : i + 2000] for i in range(0, len(even), 2000)):
            ids = array("I", self._plain([self.SPLIT.join([c.decode() for c in own])])[0] + [self.SPLIT_ID])
            self._remember(own, [i + 1 for i, token in enumerate(ids) if token == self.SPLIT_ID], ids, 1)

    def _remember(self, parts: list[bytes], ends: list[int], ids: array, apart: int) -> None:
        if len(ends) != len(parts):
            raise ValueError("the tokenizer takes words apart in another way than expected")
        packed, at = ids.tobytes(), 0
        for p, end in zip(parts, ends):
            self.known[p] = packed[4 * at : 4 * (end - apart)]
            at = end

    def encode_all(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of all texts one after the other, as bytes, and the byte at which each text starts and the last ends.

        White space other than ASCII is left to the tokenizer.
        """
        if len(self.known) > self.remember:
            self.known, self.older = {}, self.known
        split = pc.ascii_split_whitespace(texts)
        size = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        known, older = self.known, self.older
        known[b""] = b""
        met = list(map(known.get, distinct))
        late = [i for i, ids in enumerate(met) if ids is None]
        if older:
            known.update([(distinct[i], older[distinct[i]]) for i in late if distinct[i] in older])
        self._learn([distinct[i] for i in late if distinct[i] not in known])
        for i in late:
            met[i] = known[distinct[i]]
        flat = pa.array(met, pa.large_binary()).take(coded.indices)
        at = np.frombuffer(flat.buffers()[1], np.int64) if len(flat) else np.zeros(1, np.int64)
        return memoryview(flat.buffers()[2] or b""), at[np.concatenate([[0], size.cumsum()])]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text."""
        data, at = self.encode_all(pa.array([t.decode() for t in texts], pa.string()))
        return [bytes(data[i:j]) for i, j in zip(at.tolist(), at[1:].tolist())]


_CODERS: dict[str, WordCoder] = {}


def _coder(path: str) -> WordCoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


_PIECE = "piece int, start long, length long, ids_crc32 long, _part int, _nth long"


def cut_pieces(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece, numbered within (task, length); with its ids where asked."""

    def run(batches):
        from pyspark import TaskContext

        sole_memory("packing", _CODERS.clear)
        coder, part = _coder(path), TaskContext.get().partitionId()
        nth = np.zeros(size + 1, np.int64)
        for batch in batches:
            data, at = coder.encode_all(pc.fill_null(batch.column("text"), ""))
            total = np.diff(at) // 4 + 1  # with the end id
            pieces = -(-total // size)
            row = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(row)) - np.repeat(pieces.cumsum() - pieces, pieces)
            start = piece * size
            length = np.minimum(size, total[row] - start)
            first = at[row] + 4 * start
            last = np.minimum(first + 4 * length, at[row + 1])
            ends = length * 4 > last - first
            spans = list(zip(first.tolist(), last.tolist(), ends.tolist()))
            crc = [zlib.crc32(END, zlib.crc32(data[i:j])) if end else zlib.crc32(data[i:j]) for i, j, end in spans]
            order = np.argsort(length, kind="stable")
            kinds, runs, sizes = np.unique(length[order], return_index=True, return_counts=True)
            number = np.empty(len(row), np.int64)
            number[order] = np.arange(len(row)) - np.repeat(runs, sizes) + np.repeat(nth[kinds], sizes)
            nth[kinds] += sizes
            made = [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(number)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_nth"]
            if with_ids:
                made.append(pa.array([array("I", bytes(data[i:j]) + END * end).tolist() for i, j, end in spans], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(made, names=names)
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_PIECE}" + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Slots as runs (length, first rank, how many, first sequence, offset): rank first+i goes to sequence first+i.

    Best-fit decreasing over counts. ``room[r]`` holds runs of sequences with r ids left, ``open_`` marks the r in use.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    slots, open_, sequences = [], 0, 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank = counts[length], 0

        def put(at: int, n: int, used: int) -> None:
            nonlocal open_
            if used < size:
                room.setdefault(size - used, []).append((at, n))
                open_ |= 1 << size - used

        while left and (fits := open_ >> length):
            r = length + (fits & -fits).bit_length() - 1
            at, n = room[r].pop()
            if not room[r]:
                open_ &= ~(1 << r)
            take = min(n, left)
            slots.append((length, rank, take, at, size - r))
            if take < n:
                put(at + take, n - take, size - r)
            put(at, take, size - r + length)
            left, rank = left - take, rank + take
        each = size // length
        for n, deep in ((left // each, each), (int(left % each > 0), left % each)):
            if n:
                for k in range(deep):
                    slots.append((length, rank, n, sequences, k * length))
                    rank += n
                put(sequences, n, deep * length)
                sequences += n
    return slots


def _slots(spark: SparkSession, slots: list[tuple[int, int, int, int, int]], each: int = 1 << 16) -> DataFrame:
    """The plan's runs as a table; long runs are cut, so that no row stands for more than ``each`` pieces."""
    cut_up = [(n, first + i, min(each, many - i), seq + i, at) for n, first, many, seq, at in slots for i in range(0, many, each)]
    columns = list(zip(*cut_up)) or [()] * 5
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=["length", "_first", "_n", "_seq", "offset"]))


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False, broadcast_runs: int = 50_000) -> DataFrame:
    """Pieces with sequence_id and offset, gapless from 0 within a sequence.

    A plan of up to ``broadcast_runs`` runs (2 MB) is broadcast; the rows of a larger one are spread to one per slot and
    joined on (length, rank), a key that occurs once on either side, so a frequent length is dealt over all tasks.
    """
    spark = docs.sparkSession
    pieces = cut(cut_pieces(docs, path, size, with_ids), "pieces")
    by_task = cut(pieces.groupBy("length", "_part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = by_task.select("length", "_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    # one row per task and length: as many as there are tasks, so it is merged with the pieces, not sent to all
    ranked = pieces.join(before.hint("merge"), ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_nth"))
    planned = _slots(spark, plan(counts, size))
    place = F.col("_seq") + F.col("_rank") - F.col("_first")
    if planned.count() <= broadcast_runs:
        held = ranked.join(F.broadcast(planned.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_n")))
    else:
        spread = planned.repartition(max(8, spark.sparkContext.defaultParallelism)).withColumn("_rank", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)))
        held = ranked.join(spread.hint("merge"), ["length", "_rank"])
    out = [c for c in pieces.columns if not c.startswith("_")]
    return held.select(*out, place.alias("sequence_id"), "offset")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
