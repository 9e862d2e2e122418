"""Bloom filters as small tables of bitmaps, made and tested with built-in expressions.

A key falls into one of ``buckets`` bitmaps of BITS bits and sets PROBES of them. A filter has at most ``buckets`` rows of
4 KB, whatever the number of keys, so it may be broadcast; with more than about KEYS keys a bucket it lets more of the
other keys pass, never fewer of its own. Null keys are in no filter and never pass.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap (that of the bitmap functions), bits set per key, and keys per bitmap for about 1 % false hits.
BITS, PROBES, KEYS = 32_768, 4, 3_000
#: 64 MB: the largest filter that is broadcast.
MOST_BUCKETS = 16_384


def buckets_for(keys: int) -> int | None:
    """Number of bitmaps for so many keys; null if a filter of the largest size would let most keys pass."""
    wanted = 1 << max(0, ceil(keys / KEYS) - 1).bit_length()
    if wanted > 4 * MOST_BUCKETS:
        return None
    return min(wanted, MOST_BUCKETS)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def _places(key: Column) -> list[Column]:
    mixed = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(mixed, 15 * probe).bitwiseAND(F.lit(BITS - 1)) for probe in range(PROBES)]


def build(keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The filter of a column: ``bucket`` and ``bits``. Bitmaps are partly made before the shuffle."""
    c = F.col(key)
    placed = keys.where(c.isNotNull()).select(
        _bucket(c, buckets).alias("bucket"), F.explode(F.array(*_places(c))).alias("place")
    )
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def united(filters: DataFrame) -> DataFrame:
    """One filter of the rows of several that have the same number of buckets."""
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (place % 8).cast("int") + 1)) != 0


def passing(df: DataFrame, key: str, bloom: DataFrame, buckets: int, *, broadcast: bool = True) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and few others. Broadcasting it moves none of them."""
    if broadcast and buckets > MOST_BUCKETS:
        raise ValueError(f"a filter of {buckets} bitmaps is too large to broadcast")
    c = F.col(key)
    side = bloom.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    placed = df.where(c.isNotNull()).withColumn("_bucket", _bucket(c, buckets))
    joined = placed.join(F.broadcast(side) if broadcast else side, "_bucket")
    for place in _places(c):
        joined = joined.where(_is_set(F.col("_bits"), place))
    return joined.drop("_bucket", "_bits")
