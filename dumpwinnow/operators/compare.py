"""Which keys differ between two versions of a table, by a tree of order-free digests.

Rows are dealt into ranges of their key's hash, and each range has a digest that does not depend
on the order of its rows: their number, and the exclusive or and the sum of two row hashes.
Digests are aggregated in the tasks, so a level shuffles a few numbers for each range only.  The
next level cuts the ranges that differ, and only those, into finer ones; rows are shuffled by
key in the last ones alone.  Two versions with few changes cost little more than reading them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges of each level; each number divides the next, so that a range is a part of one above.
LEVELS = (256, 65_536)

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def _digest(columns: Sequence[str]) -> list[Column]:
    one = F.xxhash64(F.lit(1), *columns)
    two = F.xxhash64(F.lit(2), *columns)
    return [
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(one).alias("x"),
        # halves, as a sum of whole hashes might overflow
        F.sum(F.shiftrightunsigned(two, 32)).alias("s"),
        F.sum(two.bitwiseAND(F.lit(0xFFFFFFFF))).alias("t"),
    ]


def _differs() -> Column:
    return ~(
        F.col("a.n").eqNullSafe(F.col("b.n"))
        & F.col("a.x").eqNullSafe(F.col("b.x"))
        & F.col("a.s").eqNullSafe(F.col("b.s"))
        & F.col("a.t").eqNullSafe(F.col("b.t"))
    )


def _ranges(rows: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    number = F.pmod(F.col("_hash"), F.lit(ranges))
    return rows.groupBy(number.alias("range")).agg(*_digest(columns))


def changed_keys(
    before: DataFrame,
    after: DataFrame,
    key: Sequence[str],
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """(key..., change, rows_before, rows_after) of the keys whose rows are not the same.

    ``change`` is added, removed or changed.  Rows are compared as sets with repeats: order
    plays no part, copies do.  NULL in a key is a value like any other.  Both versions must
    have the same columns.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    if any(fine % coarse for coarse, fine in zip(levels, levels[1:], strict=False)):
        raise ValueError("each level's ranges must divide the next one's")
    columns = before.columns
    sides = [rows.select(*columns).withColumn("_hash", F.xxhash64(*key)) for rows in (before, after)]
    for ranges in levels:
        one, two = (_ranges(rows, columns, ranges) for rows in sides)
        apart = one.alias("a").join(two.alias("b"), "range", "full_outer").where(_differs())
        # at most as many numbers as the level has ranges
        numbers = sorted(r["range"] for r in apart.select("range").collect())
        if not numbers:
            return _nothing(before, key)
        if len(numbers) == ranges:
            continue  # nothing to leave out
        differing = F.broadcast(
            before.sparkSession.createDataFrame([(n,) for n in numbers], "_range long")
        )
        sides = [
            rows.join(differing, F.pmod(F.col("_hash"), F.lit(ranges)) == F.col("_range"), "left_semi")
            for rows in sides
        ]
    one, two = (rows.groupBy(*key).agg(*_digest(columns)) for rows in sides)
    same_key = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in key]
    met = one.alias("a").join(two.alias("b"), same_key, "full_outer").where(_differs())
    change = F.when(F.col("a.n").isNull(), ADDED).when(F.col("b.n").isNull(), REMOVED).otherwise(CHANGED)
    return met.select(
        *[F.when(F.col("a.n").isNull(), F.col(f"b.`{k}`")).otherwise(F.col(f"a.`{k}`")).alias(k) for k in key],
        change.alias("change"),
        F.coalesce("a.n", F.lit(0)).alias("rows_before"),
        F.coalesce("b.n", F.lit(0)).alias("rows_after"),
    )


def _nothing(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    zero = F.lit(0).cast("long")
    return rows.limit(0).select(
        *key, F.lit("").alias("change"), zero.alias("rows_before"), zero.alias("rows_after")
    )
