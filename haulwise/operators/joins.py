"""Lookup joins.

The strategy is Spark's: a lookup whose written size is under the broadcast
threshold is broadcast, AQE corrects the choice by what it sees at run time.
What Spark cannot know is added here: rows without a key need no partner,
a few keys may hold a large share of the rows, and a large table that meets a
small set of keys can be cut down before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that a hot key (or the rows without a key) is dealt into.
PARTS = 64
#: Bits of one bitmap row, as Spark's bitmap functions have it.
BITMAP_BITS = 32_768


def lookup_join(big: DataFrame, small: DataFrame, on: str, how: str = "left", cols: list[str] | None = None) -> DataFrame:
    """Join a lookup table that is unique on ``on``, projected to ``cols``."""
    return big.join(small.select(*cols) if cols else small, on=on, how=how)


def hot_keys(rows: DataFrame, on: str, share: float = 1 / PARTS) -> list:
    """Non-NULL keys that hold more than ``share`` of the rows: at most 1 / share of them.

    Keys are counted map-side first, so a hot key costs a row per task.
    """
    counts = rows.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.where(F.col(on).isNotNull() & (F.col("n") > share * total)).collect()]


def spread_lookup(big: DataFrame, lookup: DataFrame, on: str, row_id: str, how: str = "left",
                  share: float = 1 / PARTS, parts: int = PARTS) -> DataFrame:
    """``lookup_join`` for a lookup too large to broadcast, with skewed keys.

    Rows of a hot key are dealt into ``parts`` by a hash of ``row_id``, and its lookup row is copied as often; rows
    without a key are dealt out in the same way and find nothing. ``lookup`` is unique on ``on``.
    """
    hot = hot_keys(big, on, share)
    dealt = F.pmod(F.xxhash64(row_id), F.lit(parts)).cast("int") + 1
    is_hot = F.col(on).isin(hot) if hot else F.lit(False)
    left = big.withColumn("_part", F.when(F.col(on).isNull() | is_hot, dealt).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(1), F.lit(parts))).otherwise(F.array(F.lit(0)))
    right = lookup.where(F.col(on).isNotNull()).withColumn("_part", F.explode(copies))
    return left.join(right, [on, "_part"], how).drop("_part")


def key_bitmap(keys: DataFrame, on: str, rows: int = 256) -> DataFrame:
    """Which hashes occur among the keys: at most ``rows`` bitmaps of 4 KiB (a Bloom filter of one hash)."""
    slot = F.pmod(F.xxhash64(on), F.lit(rows * BITMAP_BITS))
    return keys.where(F.col(on).isNotNull()).select(slot.alias("slot")).groupBy(
        F.bitmap_bucket_number("slot").alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits"))


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(1) == 1


def only_possible(table: DataFrame, keys: DataFrame, on: str, rows: int = 256) -> DataFrame:
    """Rows of ``table`` whose key may occur among ``keys`` (some that do not are left in, none that do is lost).

    Put before a join it keeps most of a large table out of the shuffle. What is broadcast is bounded by ``rows``: 256
    bitmaps are one MiB and tell some millions of keys apart.
    """
    slot = F.pmod(F.xxhash64(on), F.lit(rows * BITMAP_BITS))
    return table.withColumn("_map", F.bitmap_bucket_number(slot)).join(F.broadcast(key_bitmap(keys, on, rows)), "_map") \
        .where(_bit_is_set(F.col("_bits"), F.bitmap_bit_position(slot))).select(*table.columns)
