"""Exact dedup: two-pass Bloom filtering; only rows whose text may be repeated move, the rest pass straight through.

Pass one is a Bloom filter of one hash function over all rows, kept sparse: a row's text falls on a position, positions are
counted (within a task first, so copies leave it as one row of 16 bytes), and those that were hit again become the elements
of the second filter. That one is blocked: an element has four bits in one 4 KB bitmap, sixteen bits are planned for each,
and the bitmaps are broadcast. Their size is known beforehand and at most ``most_bits`` / 8 bytes; beyond
``most_bits`` / 16 elements the filter fills up and lets more single rows through, but no result changes.

Pass two tests every row in place. Rows that pass are grouped by SHA-256 of the text: its largest doc_id and its rows, in the
tasks first. A group of more than 1 / 10,000 of all rows is one of fewer than 10,000, so these are broadcast and their rows
stay where they are; the other groups meet their rows in a shuffle join that no key can dominate.

Null text counts as empty, and empty texts equal each other. The row with the largest doc_id stays; rows that repeat both
doc_id and text share its fate. A null doc_id is smaller than all others; where a group has no other, its rows stay, with a
null keep_id. doc_id may be of any type with an order. Other columns pass through, but for those named as the ones added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.shared import cut, quoted, table, unused

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
#: Bits of one bitmap, as ``bitmap_construct_agg`` makes them.
BLOCK = 32768
BITS_EACH, BITS_PLANNED = 4, 16
#: First-pass positions per row: a single row shares its position with another one in about 1 case of 64.
POSITIONS_PER_ROW = 64
#: A group above this part of all rows is hot; there are fewer than so many.
HOT_PARTS = 10_000


def _power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def place_of(text: Column, positions: int) -> Column:
    """The position of a text in the first filter; ``positions`` is a power of two."""
    return F.xxhash64(text).bitwiseAND(F.lit(positions - 1))


def block_of(place: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), place), F.lit(blocks)).cast("int")


def bits_of(place: Column) -> list[Column]:
    """The four bits of an element in its bitmap: 15 bits each of one hash."""
    drawn = F.xxhash64(F.lit(2), place)
    return [F.shiftrightunsigned(drawn, 15 * i).bitwiseAND(F.lit(BLOCK - 1)) for i in range(BITS_EACH)]


def is_set(bitmap: Column, bit: Column) -> Column:
    """Whether ``bit`` of a 4 KB bitmap is set; false where there is no bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.bit_get(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


class RepeatFilter:
    """Both filters over the texts of ``docs``; ``mark`` tells rows that may repeat another's text from those that don't."""

    def __init__(self, docs: DataFrame, most_bits: int = 1 << 31):
        self.rows = docs.count()
        self.positions = _power(POSITIONS_PER_ROW * max(self.rows, 1))
        hits = docs.select(place_of(F.coalesce("text", F.lit("")), self.positions).alias("place")).groupBy("place").count()
        again = cut(hits.where("count > 1").select("place"), "dedup-again")
        self.elements = again.count()
        self.blocks = max(1, min(_power(BITS_PLANNED * self.elements), _power(most_bits)) // BLOCK)
        place = F.col("place")
        spread = again.select(block_of(place, self.blocks).alias("block"), F.explode(F.array(*bits_of(place))).alias("bit"))
        self.bitmaps = cut(spread.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "dedup-filter")

    def mark(self, docs: DataFrame, text: Column, name: str) -> DataFrame:
        """``docs`` with the boolean ``name``; true for every row whose text another row has, and for few others."""
        block, bitmap = unused(docs.columns, "_block", "_bitmap")
        place = place_of(text, self.positions)
        held = docs.withColumn(block, block_of(place, self.blocks))
        held = held.join(F.broadcast(self.bitmaps.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap))), block, "left")
        hit = F.lit(True)
        for bit in bits_of(place):
            hit = hit & is_set(F.col(bitmap), bit)
        return held.withColumn(name, hit).drop(block, bitmap)


def mark_copies(docs: DataFrame, most_bits: int = 1 << 31) -> DataFrame:
    """``docs`` with keep_id (the doc_id that stays), group_size, kept and text_sha256."""
    names = [c for c in docs.columns if c.lower() not in ADDED]
    docs = docs.select(*map(quoted, names))
    repeats = RepeatFilter(docs, most_bits)
    maybe, sha, top, size = unused(names, "_maybe", "_sha", "_top", "_size")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = repeats.mark(docs, text, maybe).withColumn(sha, F.sha2(text.cast("binary"), 256))
    groups = marked.where(F.col(maybe)).groupBy(sha).agg(F.max("doc_id").alias(top), F.count("*").alias(size))
    groups = cut(groups.where(F.col(size) > 1), "dedup-groups")
    hot = F.col(size) > repeats.rows // HOT_PARTS
    near = marked.join(F.broadcast(groups.where(hot)), sha, "left")
    single = F.col(size).isNull()
    stays = near.where(~F.col(maybe) | ~single)
    moves = near.where(F.col(maybe) & single).drop(top, size).join(groups.where(~hot), sha, "left")
    keep = F.when(single, F.col("doc_id")).otherwise(F.col(top))
    added = keep.alias("keep_id"), F.coalesce(F.col(size), F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col(sha).alias("text_sha256")
    return stays.select(*map(quoted, names), *added).unionAll(moves.select(*map(quoted, names), *added))


def drop_copies(docs: DataFrame, most_bits: int = 1 << 31) -> DataFrame:
    """Rows of ``docs`` that stay, with the columns of ``docs``."""
    found = mark_copies(docs, most_bits).where("kept")
    return found.select(*map(quoted, (c for c in docs.columns if c.lower() not in ADDED)))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *ADDED)


OP13_SQL = """
with t as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from t join g using (text_sha256)
"""
