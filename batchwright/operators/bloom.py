"""A Bloom filter of column tuples, built and asked with Spark's own expressions.

A blocked filter: a tuple's hash names a block of 512 bits (eight longs), a second
hash six bits in it.  Building is a ``bit_or`` per block, combined map-side, so a
tuple that repeats costs nothing; asking is a broadcast lookup of one block and
eight masks, without a Python worker and before any shuffle.  No tuple that was put
in is ever refused; of others about one in a hundred passes.

The filter's size follows from the number of tuples, so it is known before it is
built: beyond the broadcast bound there is none.  A tuple with a NULL is neither
put in nor found, as with plain ``=``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_TUPLE, HASHES, WORDS = 12, 6, 8
#: Bytes of a block as a broadcast row: block number, words, hash entry.
BLOCK_BYTES = 8 + 8 + 8 * WORDS + 32


def without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in each of ``columns`` (``dropna`` would also drop NaN, which equals itself)."""
    for c in columns:
        df = df.where(df[c].isNotNull())
    return df


def blocks_for(tuples: int) -> int:
    return max(1, -(-tuples * BITS_PER_TUPLE // (64 * WORDS)))


def _block(columns: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks))


def _masks(columns: Sequence[str]) -> list[Column]:
    """The bits of a tuple in each word of its block."""
    g = F.xxhash64(*columns, F.lit("bits"))
    places = [F.shiftrightunsigned(g, 9 * i).bitwiseAND(F.lit(511)) for i in range(HASHES)]
    out = []
    for w in range(WORDS):
        bits = [F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long")) for p in places]
        mask = bits[0]
        for b in bits[1:]:
            mask = mask.bitwiseOR(b)
        out.append(mask)
    return out


def bloom_filter(tuples: DataFrame, columns: Sequence[str], blocks: int) -> DataFrame:
    """``_block, _w0 .. _w7``: one row for each block that holds a tuple."""
    rows = without_nulls(tuples.select(*columns), columns).select(_block(columns, blocks).alias("_block"), *[m.alias(f"_w{w}") for w, m in enumerate(_masks(columns))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)])


def prefilter(rows: DataFrame, tuples: DataFrame, columns: Sequence[str], limit: int, expected: int | None = None) -> DataFrame:
    """``rows`` without those whose ``columns`` cannot be among ``tuples``.

    ``expected``: number of tuples (counted when not given).  ``rows`` as they are
    when the filter would exceed ``limit`` bytes or the column types differ, as then
    equal values need not have equal hashes."""
    same = all(rows.schema[c].dataType == tuples.schema[c].dataType for c in columns)
    if not same or limit < 0:
        return rows
    blocks = blocks_for(tuples.count() if expected is None else expected)
    if blocks * BLOCK_BYTES > limit:
        return rows
    found = _block(columns, blocks) == F.col("_block")
    for w, mask in enumerate(_masks(columns)):
        found = found & (F.col(f"_w{w}").bitwiseAND(mask) == mask)
    # a semi join, as Spark would push a later semi join below an inner one
    return without_nulls(rows, columns).join(F.broadcast(bloom_filter(tuples, columns, blocks)), found, "left_semi")  # at most `blocks` rows
