"""Byte-level BPE, encoded through a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list of parts. Every adjacent pair that may merge is filed under its merge rank:
a bucket of list positions per rank. Three levels of 64-way bitmaps mark the ranks with a bucket, so find-first-set
yields the least rank in constant time. Positions whose pair has changed since are skipped when met. A pre-token of n
bytes costs O(n) queue steps, at any length.

A batch is split at spaces and dictionary-encoded in Arrow; only its distinct chunks are taken apart into pre-tokens. Those
not met before share one linked list and one queue: merges of different pre-tokens do not touch each other, so popping
ranks over all of them merges each in the order of its own ranks, and a large bucket is merged by array operations.
The batch's ids are then gathered from what its chunks encode to.

Null or empty text: no tokens. Texts are whole; special tokens are ordinary text. Repeated rows are encoded alike, and
doc_id may be of any type.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from dossier.llm.shared import sole_memory, table

#: Pair keys are left << SHIFT | right; ranks are below 2**18.
SHIFT = 18
#: Buckets from this size on are merged by array operations.
MANY = 48


class RankQueue:
    """Buckets of positions by rank, with find-first-set over three bitmap levels (ranks below 2**18)."""

    def __init__(self):
        self.top, self.mid, self.low = 0, [0] * 64, [0] * 4096
        self.buckets: list[list[int] | None] = [None] * (1 << SHIFT)

    def push(self, rank: int, positions: list[int]) -> None:
        """File positions, which the queue keeps."""
        bucket = self.buckets[rank]
        if bucket is None:
            self.buckets[rank] = positions
            word, block = rank >> 6, rank >> 12
            self.low[word] |= 1 << (rank & 63)
            self.mid[block] |= 1 << (word & 63)
            self.top |= 1 << block
        else:
            bucket += positions

    def pop(self) -> tuple[int, list[int]]:
        """The least rank with a bucket, and the bucket."""
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = block << 6 | (bits & -bits).bit_length() - 1
        marks = self.low[word]
        rank = word << 6 | (marks & -marks).bit_length() - 1
        self.low[word] = marks & (marks - 1)
        if not self.low[word]:
            self.mid[block] = bits & (bits - 1)
            if not self.mid[block]:
                self.top &= self.top - 1
        positions, self.buckets[rank] = self.buckets[rank], None
        return rank, positions


class Runs:
    """A growing list of runs of ids, gathered many at a time."""

    def __init__(self):
        self.flat, self.at, self.n, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> range:
        """Append runs; their numbers."""
        n, used = self.n + len(sizes), self.used + len(values)
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(2 * used, np.int32)])
        if n + 1 > len(self.at):
            self.at = np.concatenate([self.at[: self.n + 1], np.zeros(2 * n, np.int64)])
        self.flat[self.used : used] = values
        self.at[self.n + 1 : n + 1] = self.used + sizes.cumsum()
        new = range(self.n, n)
        self.n, self.used = n, used
        return new

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' values one after the other, and where each run starts and the last ends."""
        first = self.at[numbers]
        sizes = self.at[numbers + 1] - first
        ends = sizes.cumsum()
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(first - ends + sizes, sizes) + np.arange(total)], np.concatenate([[0], ends])


class ByteBPE:
    """Encoder and decoder for a rank file and a pre-token pattern. ``remember``: chunks kept before all are forgotten."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 600_000):
        import regex

        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        get = ranks.get
        self.pair = {}  # every two tokens that are a token together
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = get(token[:k]), get(token[k:])
                if left is not None and right is not None:
                    self.pair[left << SHIFT | right] = rank
        self.keys = np.array(sorted(self.pair), np.int64)
        self.merged = np.array([self.pair[k] for k in self.keys.tolist()], np.int64)
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue()
        top = max(self.bytes_of) + 1
        self.decimals = pa.array([b"%d " % i for i in range(top)], pa.large_binary())
        self.raw = pa.array([self.bytes_of.get(i, b"") for i in range(top)], pa.large_binary())
        self.remember = remember
        self._forget()

    @classmethod
    def load(cls, path: str, pattern: str, **settings) -> ByteBPE:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, pattern, **settings)

    def _forget(self) -> None:
        self.pieces, self.chunks = Runs(), Runs()
        self.piece_no: dict[str, int] = {}
        self.plain: dict[str, int] = {}  # chunk -> number
        self.spaced: dict[str, int] = {}  # chunk without its leading space -> number
        self.white = bytearray()  # by chunk: 1 if white space follows its leading space, 2 if white space ends it
        self._add_chunks([""])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each two tokens, -1 where they do not merge."""
        keys = left << SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty pre-tokens one after the other, and how many each has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if not len(size):
            return size, size
        data, starts = np.frombuffer(b"".join(pieces), np.uint8), size.cumsum() - size
        n, get, queue = len(data), self.pair.get, self.queue
        ids = self.byte_ids[data]
        filed = np.append(self._ranks(ids[:-1], ids[1:]), [-1, -1])  # the rank under which the pair at a position stands
        filed[starts[1:] - 1] = -1
        before, after, alive = np.arange(-1, n), np.arange(1, n + 2), np.ones(n, bool)
        before[starts] = before[n] = -1
        self._file(filed[:n], np.arange(n))
        id_at, filed_at, before_at, after_at, alive_at = map(memoryview, (ids, filed, before, after, alive))
        while queue.top:
            rank, positions = queue.pop()
            if len(positions) >= MANY:
                own = np.unique(np.array(positions, np.int64))
                own = own[filed[own] == rank]
                if not (filed[after[own]] == rank).any():
                    gone = after[own]
                    end = after[gone]
                    after[own], ids[own], filed[gone], alive[gone] = end, rank, -1, False
                    inner = before[end] >= 0
                    before[end[inner]] = own[inner]
                    filed[own] = -1
                    left, right = before[own], own[inner]
                    left = left[left >= 0]
                    filed[right] = self._ranks(ids[right], ids[after[right]])
                    filed[left] = self._ranks(ids[left], ids[after[left]])
                    again = np.concatenate([left, right])
                    self._file(filed[again], again)
                    continue
                positions = own.tolist()
            positions.sort()
            for i in positions:
                if filed_at[i] != rank:
                    continue  # stale: merged away or filed anew
                gone = after_at[i]
                end = after_at[i] = after_at[gone]
                id_at[i], filed_at[i], filed_at[gone], alive_at[gone] = rank, -1, -1, False
                j = before_at[i]
                if before_at[end] >= 0:
                    before_at[end] = i
                    found = get(rank << SHIFT | id_at[end], -1)
                    if found >= 0:
                        filed_at[i] = found
                        queue.push(found, [i])
                if j >= 0:
                    found = filed_at[j] = get(id_at[j] << SHIFT | rank, -1)
                    if found >= 0:
                        queue.push(found, [j])
        return ids[alive], np.add.reduceat(alive.astype(np.int64), starts)

    def _file(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0) :]
        ranks, positions = ranks[order], positions[order].tolist()
        first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])) if len(ranks) else order
        for rank, a, b in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ranks)]):
            self.queue.push(rank, positions[a:b])

    def _add_chunks(self, chunks: list[str]) -> range:
        """Take chunks apart, encode the pre-tokens not met before, and note what the chunks encode to."""
        split = list(map(self.split, chunks))
        flat = [p for own in split for p in own]
        fresh = list(set(flat).difference(self.piece_no))
        if fresh:
            self.piece_no.update(zip(fresh, self.pieces.add(*self._encoded(fresh))))
        numbers = np.fromiter(map(self.piece_no.__getitem__, flat), np.int64, len(flat))
        ids, at = self.pieces.gather(numbers)
        bounds = at[np.concatenate([[0], np.fromiter(map(len, split), np.int64, len(split)).cumsum()])]
        for p in fresh:
            if len(p) > 64:
                del self.piece_no[p]
        self.white += bytes([(c[1:2].isspace() or len(c) < 2) | (c[-1:].isspace() << 1) for c in chunks])
        return self.chunks.add(ids, np.diff(bounds))

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_pieces``, which sees only what is not a token as a whole."""
        raw = [p.encode() for p in pieces]
        known = np.fromiter((self.ranks.get(p, -1) for p in raw), np.int64, len(raw))
        ids, size = self.encode_pieces([p for p, k in zip(raw, known.tolist()) if k < 0])
        sizes = np.ones(len(raw), np.int64)
        sizes[known < 0] = size
        out = np.empty(int(sizes.sum()), np.int64)
        ends = sizes.cumsum()
        own = np.repeat(known < 0, sizes)
        out[own], out[ends[known >= 0] - 1] = ids, known[known >= 0]
        return out, sizes

    def _numbers(self, spaced: list[str], plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of chunks, given without their leading space or whole."""
        fresh = [p for p in spaced if p not in self.spaced]
        own = list(set(plain).difference(self.plain))
        new = self._add_chunks([" " + p for p in fresh] + own)
        self.spaced.update(zip(fresh, new))
        self.plain.update(zip(own, new[len(fresh) :]))
        found = [np.fromiter(map(known.__getitem__, keys), np.int64, len(keys)) for known, keys in ((self.spaced, spaced), (self.plain, plain))]
        for known, keys in ((self.spaced, fresh), (self.plain, own)):
            for k in keys:
                if len(k) > 64:
                    del known[k]
        return tuple(found)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text starts and the last ends.

        A space that does not stand between two white-space characters begins a pre-token, so chunks begin at spaces.
        Where white space stands on both sides, chunks are joined again before they are encoded.
        """
        if len(self.spaced) + len(self.plain) + len(self.piece_no) > 2 * self.remember or self.chunks.used + self.pieces.used > 32 * self.remember:
            self._forget()
        split = pc.split_pattern(texts, " ")
        size = pc.list_value_length(split).to_numpy().astype(np.int64)
        starts = size.cumsum() - size
        flat = split.flatten()
        coded = flat.dictionary_encode()
        heads = flat.take(pa.array(starts)).to_pylist()
        numbers, head = self._numbers(coded.dictionary.to_pylist(), heads)
        numbers = numbers[coded.indices.to_numpy()]
        white = np.frombuffer(bytes(self.white), np.uint8)
        ends = (white[numbers] & 2) > 0
        numbers[starts], ends[starts] = head, (white[head] & 2) > 0
        joined = np.concatenate([[False], ((white[numbers[1:]] & 1) > 0) & ends[:-1]])
        joined[starts] = False
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(joined), "right") - 1).tolist():
            at = slice(starts[i], starts[i] + size[i])
            parts = flat.slice(starts[i], size[i]).to_pylist()
            cuts = np.append(np.flatnonzero(~joined[at]), size[i]).tolist()
            own = self._numbers([], [" " * (a > 0) + " ".join(parts[a:b]) for a, b in zip(cuts, cuts[1:])])[1]
            numbers[at] = np.concatenate([own, np.zeros(size[i] - len(own), np.int64)])  # chunk 0 is empty
        ids, at = self.chunks.gather(numbers)
        return ids, at[np.append(starts, len(numbers))]

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, texts: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
        """Per text: number of ids, SHA-256 of their decimals joined by spaces, SHA-256 of the bytes they decode to."""
        if not len(texts):
            return np.zeros(0, np.int64), [], []
        ids, bounds = self.encode_all(texts)
        out = [np.diff(bounds)]
        for tokens, gap in ((self.decimals, 1), (self.raw, 0)):
            flat = tokens.take(pa.array(ids))
            at = np.frombuffer(flat.buffers()[1], np.int64)[bounds].tolist() if len(ids) else [0] * len(bounds)
            data = memoryview(flat.buffers()[2] or b"")
            out.append([hashlib.sha256(data[a : max(a, b - gap)]).hexdigest() for a, b in zip(at, at[1:])])
        return tuple(out)


_LOADED: dict[str, ByteBPE] = {}


def _coder(path: str) -> ByteBPE:
    import public_tokenizers

    if path not in _LOADED:
        _LOADED[path] = ByteBPE.load(path, public_tokenizers.PATTERN)
    return _LOADED[path]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every text and the bytes they decode to."""

    def run(batches):
        sole_memory("byte-bpe", _LOADED.clear)
        coder = _coder(path)
        for batch in batches:
            ids, bounds = coder.encode_all(pc.fill_null(batch.column("text"), ""))
            held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            decoded = [coder.decode(ids[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held, pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digest_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""

    def run(batches):
        sole_memory("byte-bpe", _LOADED.clear)
        coder = _coder(path)
        for batch in batches:
            n, ids, back = coder.digests(pc.fill_null(batch.column("text"), ""))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
