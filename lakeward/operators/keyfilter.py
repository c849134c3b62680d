"""Filters that tell which keys a table surely does not hold.

A filter is a small table of blocks: a key sets one bit in each of the eight
64-bit words of the block that its hash names.  Blocks are built with a
map-side combined ``bit_or``, merged the same way, and probed with one join on
the block number, so nothing is broadcast but by Spark's own size check.  With
``KEYS_PER_BLOCK`` keys a block, about one foreign key in a thousand passes as
possible; a key that the filter was built from always does.  Keys with a null
part equal no key: they are neither stored nor possible.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import qcol

WORDS = 8
KEYS_PER_BLOCK = 32
BLOCK = "__block"
COLUMNS = [f"__word{i}" for i in range(WORDS)]


def blocks_for(keys: int) -> int:
    """Blocks for a number of keys that may double."""
    return max(64, -(-2 * keys // KEYS_PER_BLOCK))


def _hashes(keys: list[str]) -> tuple[Column, Column]:
    """Two hashes of a key's text form, which typed and text frames share."""
    parts = [qcol(k).cast("string") for k in keys]
    return F.xxhash64(F.lit("block"), *parts), F.xxhash64(F.lit("bits"), *parts)


def _bit(word: int) -> Column:
    """The key's bit in a word: six bits of its hash choose it."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__bits, {6 * word}) & 63 as int))")


def _coded(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    where, bits = _hashes(keys)
    known = reduce(lambda a, b: a & b, [qcol(k).isNotNull() for k in keys])
    return df.filter(known).withColumn(BLOCK, F.pmod(where, F.lit(blocks)).cast("int")).withColumn("__bits", bits)


def build(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """``(__block, __word0 ..)`` of all keys of ``df``."""
    coded = _coded(df.select(*[qcol(k) for k in keys]), keys, blocks)
    return coded.groupBy(BLOCK).agg(*[F.bit_or(_bit(i)).alias(c) for i, c in enumerate(COLUMNS)])


def merge(one: DataFrame, other: DataFrame) -> DataFrame:
    """The filter of the keys of both."""
    return one.unionByName(other).groupBy(BLOCK).agg(*[F.bit_or(c).alias(c) for c in COLUMNS])


def possible(df: DataFrame, keys: list[str], filter_rows: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key the filter may hold."""
    coded = _coded(df, keys, blocks).join(filter_rows, BLOCK)
    hit = reduce(
        lambda a, b: a & b, [F.col(c).bitwiseAND(_bit(i)) != 0 for i, c in enumerate(COLUMNS)]
    )
    return coded.filter(hit).select(*[qcol(c) for c in df.columns])
