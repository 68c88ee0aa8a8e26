"""A blocked Bloom filter as a DataFrame expression: an array of 64-bit blocks, four bits set for each value, or fewer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB: what is sent to all tasks never exceeds it; with more values than it is made for, more false hits pass.
MOST_BLOCKS = 1 << 18


def blocks_for(values: int, most: int = MOST_BLOCKS) -> int:
    """A power of two of blocks, four values or fewer in each up to `most`."""
    blocks = 1
    while blocks < min(most, values // 4 + 1):
        blocks *= 2
    return blocks


def _bits(h: F.Column, n: int = 4) -> F.Column:
    one, mask = F.lit(1).cast("long"), None
    for k in range(n):
        bit = F.call_function("shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def _block(h: F.Column, blocks: int) -> F.Column:
    return F.shiftright(h, 24).bitwiseAND(F.lit(blocks - 1)).cast("int")


def bloom(hashes: DataFrame, blocks: int, bits: int = 4) -> DataFrame:
    """One row, one array of longs: the filter of the 64-bit hashes in column h. blocks is a power of two."""
    filled = hashes.select(_block(F.col("h"), blocks).alias("block"), _bits(F.col("h"), bits).alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    return filled.agg(F.map_from_entries(F.collect_list(F.struct("block", "mask"))).alias("m")).select(
        F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long"))).alias("bloom")
    )


def as_literal(filter_: DataFrame) -> F.Column:
    """The filter as a constant, for use in functions of array elements, where Spark allows no subquery. At most 2 MB."""
    return F.split(F.lit(",".join(map(str, filter_.first()["bloom"]))), ",").cast("array<bigint>")


def may_hold(filter_: F.Column, h: F.Column, blocks: int, bits: int = 4) -> F.Column:
    """False only if no value has the hash h."""
    mask = _bits(h, bits)
    return F.get(filter_, _block(h, blocks)).bitwiseAND(mask) == mask
