"""Equi-joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000
SALTS = 32
HOT_ROWS = 100_000


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str, spread_by: list[str],
                salts: int = SALTS) -> DataFrame:
    """Shuffle join with every key cut into ``salts`` lanes.

    The salt is a hash of ``spread_by``, so a retried task produces the same
    lanes; ``small`` is repeated once per lane. Spark sizes it as if it were
    not repeated, so it is told not to broadcast it.
    """
    lane = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left = big.withColumn("_lane", lane)
    right = small.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, "_lane"], how).drop("_lane")


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                spread_by: list[str] | None = None, limit: int = BROADCAST_ROWS,
                rows: int | None = None) -> DataFrame:
    """Join a lookup table: broadcast while it has at most ``limit`` rows, salted beyond.

    Unless the caller knows ``rows``, they are counted first, so ``small``
    should be a stored table or a cheap aggregate.
    """
    known = small.limit(limit + 1).count() if rows is None else rows
    if known <= limit:
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, spread_by or [c for c in big.columns if c not in on])


def split_join(big: DataFrame, small: DataFrame, on: list[str], counted: str, spread_by: list[str],
               hot: int = HOT_ROWS) -> DataFrame:
    """Join back a table with one row per key of ``big`` and its row count there.

    Keys with ``hot`` rows or more are few and go through the lookup join; all
    others take a plain shuffle join, where no key can be large. ``small`` must
    be stored, and every key of ``big`` must be in it.
    """
    large = small.where(F.col(counted) >= hot).drop(counted).withColumn("_hot", F.lit(True))
    marked = lookup_join(big, large, on, "left", spread_by)
    rest = marked.where(F.col("_hot").isNull()).select(*big.columns)
    cold = rest.join(small.where(F.col(counted) < hot).drop(counted), on)
    return marked.where(F.col("_hot")).drop("_hot").unionByName(cold)


def null_key(column: str):
    """Text key under which NULL is a value of its own (for plain equi-joins)."""
    c = F.col(column).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c))
