"""Which keys a table may hold: Bloom filters in blocks, as rows.

A filter is a table with a row per block of 512 bits in eight words; a key sets one bit in each word of
its block.  Building is an aggregate by ``bit_or``, so a task sends a row per block, however many keys fall
into it; probing is a join on the block.  Filters come in groups (a day, say), each with as many blocks as its
number of keys asks for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
#: 16 bits a key: about one absent key in a thousand looks present.
KEYS_PER_BLOCK = 32

_WORD_NAMES = [f"w{i}" for i in range(WORDS)]


def _bits(key: Column) -> list[Column]:
    """The bit of each word, from six bits of a second hash."""
    second = F.xxhash64(F.lit("bits"), key)
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(63).cast("int")
        ) for i in range(WORDS)
    ]


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), blocks)


def sizes(keys: DataFrame, group: str, per_block: int = KEYS_PER_BLOCK) -> DataFrame:
    """``group`` and the number of ``blocks`` its filter has."""
    return keys.groupBy(group).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(per_block)).cast("bigint").alias("blocks")
    )


def build(keys: DataFrame, group: str, key: str, blocks: DataFrame) -> DataFrame:
    """Filter rows (``group``, ``block``, words) for the keys of each group."""
    counted = blocks.select(F.col(group).alias("_group"), "blocks")
    placed = keys.join(counted, F.col(group).eqNullSafe(F.col("_group"))).select(
        group, _block(F.col(key), F.col("blocks")).alias("block"),
        *[b.alias(n) for n, b in zip(_WORD_NAMES, _bits(F.col(key)), strict=True)],
    )
    return placed.groupBy(group, "block").agg(*[F.bit_or(n).alias(n) for n in _WORD_NAMES])


def probe(
    keys: DataFrame, filters: DataFrame, blocks: DataFrame, group: str, key: str, within: list[str]
) -> DataFrame:
    """Rows of ``keys`` that some filter of their group may hold, once for each.

    ``within`` names columns of ``filters`` and ``blocks`` that tell several filters of a group apart.
    """
    counted = blocks.select(F.col(group).alias("_group"), "blocks", *within)
    asked = keys.join(counted, F.col(group).eqNullSafe(F.col("_group"))).withColumn(
        "block", _block(F.col(key), F.col("blocks"))
    )
    rows = filters.select(
        F.col(group).alias("_in"), F.col("block").alias("_block"), *[F.col(c).alias(f"_{c}") for c in within],
        *_WORD_NAMES,
    )
    same = [F.col("block") == F.col("_block"), F.col(group).eqNullSafe(F.col("_in"))]
    same += [F.col(c) == F.col(f"_{c}") for c in within]
    held = [
        F.col(n).bitwiseAND(b) == b for n, b in zip(_WORD_NAMES, _bits(F.col(key)), strict=True)
    ]
    found = asked.join(rows, reduce(Column.__and__, same)).filter(reduce(Column.__and__, held))
    return found.select(*keys.columns)
