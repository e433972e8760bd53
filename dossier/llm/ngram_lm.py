"""LM scoring over an Elias-Fano n-gram trie.

Words are ids: the rank of their 64-bit hash among all training words. Level 1 holds every word (sorted hashes, exact
counts); level n holds the n-grams seen ``least`` times or more, sorted by (context, word): per context a monotone
pointer to its children, per child its word, both Elias-Fano coded, and 8-bit codes of discounted log probabilities
and of back-off weights. Counting goes level by level: an n-gram can only be frequent where both its shorter parts
are, so the trie of the levels below admits what is counted next. Levels are cut into blocks by key; tasks write blocks to the
shared folder and scorers map them into memory. A query finds the context's place, then the successor of the word
among the context's children.

p(w | c) = max(n(cw) - d, 0) / n(c) + back(c) p(w | shorter c), back(c) = 1 - sum of the first terms of c: pruned mass
goes to the shorter context, and every context's probabilities sum to one. Words: (c + 0.5) / (N + 0.5 (V + 1)), in the same
8-bit codes for the score, exact for the base score.

Null or empty text: the end token only. Rows whose remainder is 1 are held out; a null id counts as the text "".
Repeated rows count as often as they occur. With no training text at all every token has probability 1 (V + 1 = 1).
"""

from __future__ import annotations

import os
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.shared import cut, mounted, new_uri, replace_file, sole_memory, table

END_WORD = b""
_U = np.uint64
#: 8-bit codes: log10 values from -12.75 to 0 in steps of 0.05, back-off weights alike.
STEP = 0.05


#: Place of set bit number j of a byte, 0 where it has no such bit.
_BIT = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[j] for j in range(8)] for b in range(256)], np.int64)

_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 255).astype(np.uint8)


# --- Elias-Fano -----------------------------------------------------------------------------------------------------


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary with a directory; access and successor for many keys."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros, self.ones = n, low_bits, low, high, zeros, ones
        self.wide = np.ndarray((len(low) - 7,), "<u8", np.ascontiguousarray(low), strides=(1,))  # the 64 bits from every byte on

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(_U)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
        bits = np.zeros(n * low_bits + 64, np.uint8)
        for b in range(low_bits):
            bits[b : n * low_bits : low_bits] = ((values >> _U(b)) & _U(1)).astype(np.uint8)
        low = np.packbits(bits, bitorder="little")
        low = np.concatenate([low, np.zeros(16 + -len(low) % 8, np.uint8)])
        high_values = (values >> _U(low_bits)).astype(np.int64)
        marks = np.zeros((top >> low_bits) + n + 65, np.uint8)
        marks[high_values + np.arange(n)] = 1
        marks = np.concatenate([marks, np.zeros(-len(marks) % 64, np.uint8)])
        high = np.packbits(marks, bitorder="little").view(_U)
        per_word = np.bitwise_count(high).astype(np.int64)
        ones = np.concatenate([[0], per_word.cumsum()]).astype(np.uint32)
        zeros = (np.arange(len(high) + 1) * 64 - ones).astype(np.uint32)
        return cls(n, low_bits, low, high, zeros, ones)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"shape": np.array([self.n, self.low_bits], np.int64), "low": self.low, "high": self.high, "zeros": self.zeros, "ones": self.ones}

    @classmethod
    def of(cls, found: dict[str, np.ndarray]) -> EliasFano:
        n, low_bits = map(int, found["shape"])
        return cls(n, low_bits, *(found[k] for k in ("low", "high", "zeros", "ones")))

    @staticmethod
    def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Position of the set bit number ``rank`` in each word: running counts of its bytes in one product, the byte by
        comparing all eight at once, then a table."""
        words, rank = np.ascontiguousarray(words), rank.astype(_U)
        upto = np.bitwise_count(words.view(np.uint8)).view(_U) * _ONES
        byte = np.minimum(np.bitwise_count(((rank * _ONES | _TOPS) - upto) & _TOPS), 7).astype(_U)
        shift = byte << _U(3)
        before = ((upto << _U(8)) >> shift) & _U(255)
        own = (words >> shift) & _U(255)
        return shift.astype(np.int64) + _BIT[own.astype(np.int64), np.clip(rank.astype(np.int64) - before.astype(np.int64), 0, 7)]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        bit = i * self.low_bits
        byte, over = bit >> 3, (bit & 7).astype(_U)
        out = self.wide[byte] >> over
        if self.low_bits > 57:
            more = self.low[byte + 8].astype(_U)
            out |= np.where(over > 0, more << (_U(64) - np.maximum(over, _U(1))), _U(0))
        return out & _U((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        place = word * 64 + self._select(self.high[word], i - self.ones[word].astype(np.int64))
        return ((place - i).astype(_U) << _U(self.low_bits)) | self.lows(i)

    def _range(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end index of the values whose high part is ``high``: the ones between two neighbouring zeros."""
        want = np.maximum(high - 1, 0)
        word = np.searchsorted(self.zeros, want.astype(np.uint32), "right") - 1
        word = np.minimum(word, len(self.high) - 1)
        bit = self._select(~self.high[word], want - self.zeros[word].astype(np.int64))
        first = np.where(high > 0, word * 64 + bit - want, 0)
        at = np.where(high > 0, word * 64 + bit + 1, 0)  # where the ones of ``high`` begin
        word = at >> 6
        rest = ~self.high[np.minimum(word, len(self.high) - 1)] >> (at & 63).astype(_U)
        size = np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)  # ones before the next zero
        beyond = np.flatnonzero(rest == 0)  # the next zero is in a later word
        if beyond.size:
            zero = high[beyond]
            later = np.minimum(np.searchsorted(self.zeros, zero.astype(np.uint32), "right") - 1, len(self.high) - 1)
            size[beyond] = later * 64 + self._select(~self.high[later], zero - self.zeros[later].astype(np.int64)) - at[beyond]
        return first, first + size

    def _search(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value >= key, n where there is none, and whether it equals the key."""
        if not self.n:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        keys = keys.astype(_U)
        top = int(self.zeros[-1]) - 1
        high = keys >> _U(self.low_bits)
        beyond = high > _U(max(top, 0))
        low, end = self._range(np.minimum(high, _U(max(top - 1, 0))).astype(np.int64))
        beyond |= high > _U(max(top - 1, 0))
        last = np.minimum(end, self.n)
        high_end = last.copy()
        want = keys & _U((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(low < high_end)
        while open_.size:  # halving within the values of one high part
            mid = (low[open_] + high_end[open_]) >> 1
            less = self.lows(mid) < want[open_]
            low[open_[less]] = mid[less] + 1
            high_end[open_[~less]] = mid[~less]
            open_ = open_[low[open_] < high_end[open_]]
        inside = np.flatnonzero((low < last) & ~beyond)
        same = np.zeros(len(keys), bool)
        same[inside] = self.lows(low[inside]) == want[inside]
        return np.where(beyond, self.n, np.minimum(low, self.n)), same

    def successor(self, keys: np.ndarray) -> np.ndarray:
        """Index of the first value >= key, n where there is none."""
        return self._search(keys)[0]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of the successor where it equals the key, else -1."""
        at, same = self._search(keys)
        return np.where(same, at, -1)


# --- block files ----------------------------------------------------------------------------------------------------


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    head, body, at = [], [], 0
    for name, a in arrays.items():
        data = np.ascontiguousarray(a).tobytes()
        data += bytes(-len(data) % 8)
        head.append(f"{name} {a.dtype.str} {a.size} {at}")
        body.append(data)
        at += len(data)
    text = "\n".join(head).encode()
    return len(text).to_bytes(8, "little") + text + bytes(-len(text) % 8) + b"".join(body)


def _mapped(path: str) -> dict[str, np.ndarray]:
    raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    start = 8 + size + -size % 8
    out = {}
    for line in raw[8 : 8 + size].tobytes().decode().split("\n"):
        name, kind, n, at = line.split(" ")
        kind = np.dtype(kind)
        out[name] = raw[start + int(at) : start + int(at) + int(n) * kind.itemsize].view(kind)
    return out


# --- counting -------------------------------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the batch's distinct words, every text's tokens as indices of them, one text after the other, and
    where each text ends."""
    import xxhash

    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, [*words, END_WORD]), _U, len(words) + 1)
    codes = coded.indices.to_numpy()
    blank = words.index(b"") if b"" in words else -1  # white space at a text's ends leaves empty parts
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    keep = codes != blank
    ends = (np.bincount(row[keep], minlength=len(texts)) + 1).cumsum()
    out = np.empty(int(keep.sum()) + len(texts), np.int64)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last], out[~last] = len(words), codes[keep]
    return hashes, out, ends


def _word_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, codes, _ = tokens(texts)
    counts = np.bincount(codes, minlength=len(hashes))
    return hashes[counts > 0], counts[counts > 0]


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


_BLOB = "bucket long, deltas binary, counts binary"


def _blobs(keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and their counts by bucket; deltas leave the shuffle's compression little to carry."""
    cuts = np.searchsorted(keys, bounds[1:])
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    rows = [(b, np.diff(keys[i:j], prepend=_U(0)).tobytes(), counts[i:j].astype(np.uint32).tobytes()) for b, (i, j) in enumerate(zip(starts, ends)) if j > i]
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["bucket", "deltas", "counts"])


def _count_level(keys_of, bounds: np.ndarray, at_once: int = 4_000_000):
    """Per task: the level's keys of whole texts, summed at every ``at_once`` and handed out by bucket."""

    def flushed(held: list) -> pa.RecordBatch:
        keys, counts = zip(*held)
        keys = np.concatenate(keys)
        return _blobs(*(np.unique(keys, return_counts=True) if counts[0] is None else _counted(keys, np.concatenate(counts))), bounds)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            own = keys_of(pc.fill_null(batch.column("text"), ""))
            held.append(own)
            n += len(own[0])
            if n >= at_once:
                yield flushed(held)
                held, n = [], 0
        if n:
            yield flushed(held)

    return run


def _gathered(blobs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(b.as_py(), _U).cumsum(dtype=_U) for b in blobs.column("deltas")]
    counts = [np.frombuffer(b.as_py(), np.uint32).astype(np.int64) for b in blobs.column("counts")]
    return _counted(np.concatenate(keys), np.concatenate(counts))


#: next: places in the block that are contexts of more than a block of the next level; hot: contexts split over blocks here.
_BLOCK = "bucket long, n long, tokens long, next array<long>, next_n array<long>, hot array<long>, hot_mass array<double>"


def _block_row(bucket: int, counts: np.ndarray, block_tokens: int, hot=(), hot_mass=()) -> pa.Table:
    large = np.flatnonzero(counts > block_tokens)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
    values = [[bucket], [len(counts)], [int(counts.sum())], [large.tolist()], [counts[large].tolist()], [list(hot)], [list(hot_mass)]]
    return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _BLOCK.split(", ")])


def _word_block(folder: str, bounds: np.ndarray, block_tokens: int):
    def build(blobs: pa.Table) -> pa.Table:
        bucket = blobs.column("bucket")[0].as_py()
        keys, counts = _gathered(blobs)
        replace_file(_path(folder, 1, bucket), _pack({f"hash_{k}": v for k, v in EliasFano.encode(keys - bounds[bucket]).arrays().items()} | {"counts": counts}))
        return _block_row(bucket, counts, block_tokens)

    return build


def _gram_block(folder: str, level: int, trie: dict, least: int, discount: float, last: bool, block_tokens: int):
    def build(blobs: pa.Table) -> pa.Table:
        bucket = blobs.column("bucket")[0].as_py()
        keys, counts = _gathered(blobs)
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
        context, word = (keys >> _U(32)).astype(np.int64), keys & _U(0xFFFFFFFF)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        own = context[first]
        above = Trie(trie).counts(level - 1, own)
        rank = np.repeat(np.arange(len(own)), np.diff(np.concatenate([first, [len(keys)]])))
        p = (counts - discount) / above[rank]
        mass = np.bincount(rank, p, len(own))
        coded = {
            "context": EliasFano.encode(own),
            "pointer": EliasFano.encode(np.concatenate([first, [len(keys)]])),
            "word": EliasFano.encode(rank.astype(_U) * _U(trie["V"]) + word),
        }
        arrays = {f"{name}_{k}": v for name, ef in coded.items() for k, v in ef.arrays().items()}
        arrays["p"] = quantise(np.log10(p))
        arrays["back"] = quantise(np.log10(np.maximum(1 - mass, 1e-12)))
        if not last:
            arrays["counts"] = counts
        replace_file(_path(folder, level, bucket), _pack(arrays))
        split = np.flatnonzero(np.isin(own, trie["hot"][level - 1][0]))
        return _block_row(bucket, counts, block_tokens, own[split].tolist(), mass[split].tolist())

    return build


# --- the trie -------------------------------------------------------------------------------------------------------

#: Blocks mapped in this process, the least recently used first; beyond ``MOST_OPEN`` that one is let go.
_OPEN: OrderedDict[str, dict] = OrderedDict()
MOST_OPEN = 2048


def _opened(path: str) -> dict:
    if path in _OPEN:
        _OPEN.move_to_end(path)
        return _OPEN[path]
    arrays = _mapped(path)
    names = {k.split("_")[0] for k in arrays if "_" in k}
    coded = {n: EliasFano.of({k.removeprefix(f"{n}_"): v for k, v in arrays.items() if k.startswith(f"{n}_")}) for n in names}
    _OPEN[path] = coded | {k: v for k, v in arrays.items() if "_" not in k}
    if len(_OPEN) > MOST_OPEN:
        _OPEN.popitem(last=False)
    return _OPEN[path]


def _path(folder: str, level: int, bucket: int) -> str:
    return os.path.join(folder, f"level{level}-{bucket:08d}")


class Trie:
    """Reader of the blocks that ``about`` lists: folder, N, V, order, levels {level: (first keys, first places, whether there
    is a block)}, hot {level: (contexts, back-off codes)}; ``MOST_BLOCKS`` bounds the lists."""

    def __init__(self, about: dict):
        self.about = about

    def _by_block(self, level: int, firsts: np.ndarray, keys: np.ndarray):
        """(block, its first place, slice) over sorted keys."""
        _, places, there = self.about["levels"][level]
        cuts = np.concatenate([[0], np.searchsorted(keys, firsts[1:]), [len(keys)]])
        for b in np.flatnonzero(np.diff(cuts)):
            if there[b]:
                yield _opened(_path(self.about["folder"], level, b)), int(places[b]), slice(cuts[b], cuts[b + 1])

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and training count of every hash; -1 and 0 where it was not met."""
        own, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(own), -1, np.int64), np.zeros(len(own), np.int64)
        firsts = self.about["levels"][1][0]
        for block, place, at in self._by_block(1, firsts, own):
            coded, key = block["hash"], own[at] - firsts[np.searchsorted(firsts, own[at][0], "right") - 1]
            i = coded.find(key)
            there = np.flatnonzero(i >= 0)
            ids[at][there], counts[at][there] = i[there] + place, block["counts"][i[there]]
        return ids[back], counts[back]

    def counts(self, level: int, places: np.ndarray) -> np.ndarray:
        """Counts at sorted places of a level."""
        out = np.zeros(len(places), np.int64)
        for block, place, at in self._by_block(level, self.about["levels"][level][1], places):
            out[at] = block["counts"][places[at] - place]
        return out

    def children(self, level: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and log10 probability of (context, word) at ``level``, -1 and 0 where absent; log10 back-off of the context."""
        place, p, back = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.zeros(len(context))
        valid = context >= 0
        word = np.where(word >= 0, word, 0xFFFFFFFF)  # no id: absent everywhere, but the context still backs off
        keys, inverse = np.unique((context[valid].astype(_U) << _U(32)) | word[valid].astype(_U), return_inverse=True)
        own_place, own_p, own_back = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.zeros(len(keys))
        hot, hot_back = self.about["hot"][level - 1]
        for block, first, at in self._by_block(level, self.about["levels"][level][0], keys):
            c, w = (keys[at] >> _U(32)).astype(np.int64), keys[at] & _U(0xFFFFFFFF)
            new = np.concatenate([[True], c[1:] != c[:-1]])
            distinct, which = c[new], new.cumsum() - 1
            rank = block["context"].find(distinct)
            ok = rank >= 0
            rank = np.where(ok, rank, 0)
            end = np.zeros(len(rank), np.int64)
            end[ok] = block["pointer"].get(rank[ok] + 1).astype(np.int64)
            code = np.zeros(len(rank))
            code[ok] = block["back"][rank[ok]]
            own_back[at] = -STEP * code[which]
            seek = np.flatnonzero(ok[which])
            key = rank[which[seek]].astype(_U) * _U(self.about["V"]) + w[seek]
            i = block["word"].find(key)
            inside = np.flatnonzero((i >= 0) & (i < end[which[seek]]))
            own_place[at][seek[inside]] = i[inside] + first
            own_p[at][seek[inside]] = -STEP * block["p"][i[inside]].astype(float)
        if len(hot):
            c = (keys >> _U(32)).astype(np.int64)
            spot = np.minimum(np.searchsorted(hot, c), len(hot) - 1)
            own_back = np.where(hot[spot] == c, -STEP * hot_back[spot].astype(float), own_back)
        place[valid], p[valid], back[valid] = own_place[inverse], own_p[inverse], own_back[inverse]
        return place, p, back

    def walk(self, texts: pa.Array, upto: int):
        """Ends, tokens as indices of distinct words, ids, counts of the distinct words, and per level from 2 to ``upto`` (context, place, log10 p, log10 back-off)."""
        hashes, codes, ends = tokens(texts)
        own_ids, own_counts = self.words(hashes)
        ids = own_ids[codes]
        starts = np.concatenate([[0], ends[:-1]])
        steps, place = [], ids
        for level in range(2, upto + 1):
            context = np.concatenate([[-1], place[:-1]])
            context[starts] = -1
            found = self.children(level, context, ids)
            steps.append((context, *found))
            place = found[0]
        return ends, codes, ids, own_counts, steps

    def score(self, texts: pa.Array):
        """Per text: tokens, known tokens, base score, score."""
        about = self.about
        ends, codes, _, counts, steps = self.walk(texts, about["order"])
        own = np.log10((counts + 0.5) / (about["N"] + 0.5 * (about["V"] + 1)))
        low, best, known = own[codes], (-STEP * quantise(own))[codes], (counts > 0)[codes]
        for _, place, p, back in steps:
            best = np.where(place >= 0, p, best + back)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        total = lambda v: np.add.reduceat(v, starts) if len(starts) else v[:0]
        return ends - starts, total(known.astype(np.int64)), total(low), total(best)


def _bounds(size: int, blocks: int, hot: list[tuple[int, int]], block_tokens: int, words: int) -> np.ndarray:
    """First keys of the blocks of a level: even ranges of contexts, and ranges of words within hot contexts."""
    keys = {(i * size // blocks) << 32 for i in range(blocks)}
    for context, n in hot:
        parts = -(-n // block_tokens)
        keys |= {(context << 32) | (j * words // parts) for j in range(parts)} | {(context + 1) << 32}
    return np.array(sorted(keys), _U)


def _collected(spark: SparkSession, blobs: DataFrame, build, bounds: np.ndarray):
    """Build a level's blocks; the list of blocks, a few numbers each and bounded by ``MOST_BLOCKS``, comes to the driver."""
    rows = cut(blobs.groupBy("bucket").applyInArrow(build, _BLOCK), "ngram-blocks").collect()
    by = {r["bucket"]: r for r in rows}
    sizes = np.array([by[b]["n"] if b in by else 0 for b in range(len(bounds))], np.int64)
    places = np.concatenate([[0], sizes.cumsum()[:-1]])
    there = np.array([b in by for b in range(len(bounds))])
    return by, places, there, int(sizes.sum())


#: Blocks of a level, apart from the parts of contexts that fill blocks of their own; blocks grow with the text beyond it.
MOST_BLOCKS = 1 << 16


def train(docs: DataFrame, order: int = 3, least: int = 1, discount: float = 0.75, block_tokens: int = 2_000_000) -> dict:
    """Learn from every text of ``docs(text)``; returns what ``Trie`` needs to read the model from the shared folder."""
    spark = docs.sparkSession
    folder = mounted(new_uri(spark, "trie"))
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block_tokens = max(block_tokens, size // 6 // MOST_BLOCKS)
    blocks = max(1, size // 6 // block_tokens)
    bounds = np.array([(i << 64) // blocks for i in range(blocks)], _U)
    blobs = texts.mapInArrow(_count_level(_word_counts, bounds), _BLOB)
    by, places, there, kinds = _collected(spark, blobs, _word_block(folder, bounds, block_tokens), bounds)
    if kinds >= 1 << 32:
        raise ValueError("more than 2**32 distinct words")
    large = lambda: sorted((int(places[b]) + i, n) for b, r in by.items() for i, n in zip(r["next"], r["next_n"]))
    hot = large()
    about = {"N": sum(r["tokens"] for r in by.values()), "V": kinds, "order": 1, "levels": {1: (bounds, places, there)}, "hot": {}, "folder": folder}
    for level in range(2, order + 1):
        about["hot"][level - 1] = (np.array([c for c, _ in hot], np.int64), np.zeros(len(hot), np.uint8))
        lower = dict(about)

        def keys(own, level=level, lower=lower):
            trie = Trie(lower)
            ends, codes, ids, counts, steps = trie.walk(own, level - 1)
            place = steps[-1][1] if steps else np.where(counts[codes] >= least, ids, -1)
            context = np.concatenate([[-1], place[:-1]])
            context[np.concatenate([[0], ends[:-1]])] = -1
            ok = (context >= 0) & (place >= 0)  # both shorter parts are frequent
            return (context[ok].astype(_U) << _U(32)) | ids[ok].astype(_U), None

        bounds = _bounds(max(1, int(places[-1]) + 1 if level > 2 else kinds), blocks, hot, block_tokens, max(1, kinds))
        blobs = texts.mapInArrow(_count_level(keys, bounds), _BLOB)
        by, places, there, _ = _collected(spark, blobs, _gram_block(folder, level, lower, least, discount, level == order, block_tokens), bounds)
        mass: dict[int, float] = {}
        for r in by.values():
            for c, m in zip(r["hot"], r["hot_mass"]):
                mass[c] = mass.get(c, 0.0) + m
        left = np.array([1 - mass.get(c, 0.0) for c, _ in hot], float)
        about["hot"][level - 1] = (about["hot"][level - 1][0], quantise(np.log10(np.maximum(left, 1e-12))))
        about["levels"][level] = (bounds, places, there)
        about["order"], hot = level, large()
    return about


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def score(docs: DataFrame, about: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every whole text."""

    def run(batches):
        sole_memory("trie", _OPEN.clear)
        trie = Trie(about)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            n, known, base, best = trie.score(texts) if len(texts) else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
            made = [batch.column("doc_id"), pa.array(n), pa.array(known), pa.array(np.full(len(n), about["N"], np.int64)), pa.array(base), pa.array(best)]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    about = train(docs.where(remainder(F.col("doc_id")) != 1))
    found = score(docs, about).withColumn("held_out", remainder(F.col("doc_id")) == 1)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
