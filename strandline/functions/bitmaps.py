"""Bitmaps of row positions, in blocks of 32,768 bits, built and tested by JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Bits of one block; fixed by Spark's bitmap functions.
BLOCK = 32768


def block_of(position: Column) -> Column:
    """Block of a 0-based position."""
    return F.shiftright(position, 15)


def bit_of(position: Column) -> Column:
    """Bit of a 0-based position inside its block."""
    return position.bitwiseAND(F.lit(BLOCK - 1))


def collect_bits(position: Column) -> Column:
    """Aggregate: the block's bitmap with the bits of all positions of the group set."""
    return F.bitmap_construct_agg(bit_of(position))


def invert(bitmap: Column) -> Column:
    """All bits flipped."""
    return F.unhex(F.translate(F.hex(bitmap), "0123456789ABCDEF", "FEDCBA9876543210"))


def full() -> Column:
    """A block with all bits set."""
    return F.unhex(F.repeat(F.lit("F"), 2 * BLOCK // 8))


def is_set(bitmap: Column, position: Column) -> Column:
    """Whether the position's bit is set."""
    bit = bit_of(position).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3) + F.lit(1), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), bit.bitwiseAND(F.lit(7))).cast("int")) != 0
