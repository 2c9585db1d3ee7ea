"""Reproducible shuffle into shards by a Feistel permutation of row numbers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.llm.numbering import numbered

ROUNDS = 8
# Steps a walk may take. At most three numbers of four lie outside the range, so that
# no walk of a table of 10^12 rows comes near; one that did would raise an error.
WALK = 256


def round_keys(seed: int) -> list[tuple[int, int]]:
    """An odd factor and a summand below 2^31 for each round."""
    found = []
    for i in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        found.append((int.from_bytes(digest[:4], "big") >> 1 | 1,
                      int.from_bytes(digest[4:8], "big") >> 1))
    return found


def half_bits(total: int) -> int:
    """Half the (even) number of bits that hold every row number."""
    return max(1, ((max(total, 1) - 1).bit_length() + 1) // 2)


def _permuted(number: Column, half: int, seed: int) -> Column:
    mask = (1 << half) - 1
    keys = F.array(*(F.struct(F.lit(c).cast("long").alias("c"), F.lit(k).cast("long").alias("k"))
                     for c, k in round_keys(seed)))

    def turn(state: Column, key: Column) -> Column:
        mixed = F.shiftright(state["r"] * key["c"] + key["k"], 17).bitwiseAND(F.lit(mask))
        return F.struct(state["r"].alias("l"), state["l"].bitwiseXOR(mixed).alias("r"))

    start = F.struct(F.shiftright(number, half).alias("l"),
                     number.bitwiseAND(F.lit(mask)).cast("long").alias("r"))
    return F.aggregate(keys, start, turn,
                       lambda s: F.shiftleft(s["l"], half).bitwiseOR(s["r"]))


def shuffled_number(number: Column, total: int, seed: int) -> Column:
    """Where the permutation of 0 .. total-1 puts a row number.

    The network permutes the next power of four; a result outside the range is
    permuted again until it lies inside (cycle walking).
    """
    half = half_bits(total)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), _permuted(number, half, seed),
        lambda at, _: F.when(at < total, at).otherwise(_permuted(at, half, seed)))
    return F.when(walked < total, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def sharded(rows: DataFrame, by: list[Column], shards: int = 16, seed: int = 7) -> DataFrame:
    """The rows with `shard` (0 .. shards-1) and `slot` (gapless from 0 in each shard).

    `by` fixes the order that is permuted; its columns should tell rows apart. Shards differ
    by one row at most. Rows equal in `by` are interchangeable. Nulls order as text "null".
    An empty table gives an empty one. Columns named shard or slot are replaced.
    """
    ordered, total = numbered(rows.drop("shard", "slot"), by, "slot")
    place = shuffled_number(F.col("slot"), total, seed)
    return (ordered.withColumn("slot", place)
            .withColumn("shard", (F.col("slot") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("slot") / shards).cast("long")
                        if shards & (shards - 1) else
                        F.shiftright("slot", shards.bit_length() - 1)))
