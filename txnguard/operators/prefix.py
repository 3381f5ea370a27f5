"""Exact running totals over a value order, without a single-task sort.

Rows are range-partitioned on (keys, order) into slabs, so one hot key spans
many tasks. Totals are taken inside each slab, and the slab totals (one row
per slab and key) are accumulated and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.durable import materialize


SLAB_ROWS = (50_000, 4_000_000)


def slab_count(rows: int, usual: int) -> int:
    """Slabs of at least the smaller size up to the usual number of partitions, then as many as keep each below the larger."""
    least, most = SLAB_ROWS
    return max(1, min(usual, -(-rows // least)), -(-rows // most))


def running_totals(df: DataFrame, keys: list[str], order: list[Column], values: list[str],
                   previous: list[str] = (), partitions: int | None = None) -> DataFrame:
    """Add ``cum_<v>`` (inclusive), ``total_<v>`` (the key's whole) and ``prev_<c>``
    (the preceding row's value) per key.

    (keys, order) must be unique per row; callers aggregate duplicates first,
    which also lets the range partitioner cut inside a hot key.
    """
    by = [F.col(k) for k in keys] + list(order)
    if partitions is None:  # stored first: the footers give its rows, and the sampling pass reads it instead of the whole plan
        df = materialize(df, "folded")
        partitions = slab_count(df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(df.repartitionByRange(partitions, *by).withColumn("_slab", F.spark_partition_id()), "slabs")

    inside = Window.partitionBy(*keys, "_slab").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = {f"_in_{v}": F.sum(v).over(upto) for v in values}
    local |= {f"_lag_{c}": F.lag(c).over(inside) for c in previous}
    rows = placed.withColumns(local)

    totals = [F.sum(v).alias(f"_sum_{v}") for v in values]
    if previous:
        last = placed.withColumns({f"_end_{c}": F.last(c).over(whole) for c in previous})
        totals += [F.max(f"_end_{c}").alias(f"_end_{c}") for c in previous]
        per_slab = last.groupBy(*keys, "_slab").agg(*totals)
    else:
        per_slab = placed.groupBy(*keys, "_slab").agg(*totals)
    # One row per slab and key: at most as many rows in a group as there are slabs.
    order_slabs = Window.partitionBy(*keys).orderBy("_slab")
    earlier = order_slabs.rowsBetween(Window.unboundedPreceding, -1)
    every = order_slabs.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = per_slab.select(
        *keys, "_slab",
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(every).alias(f"total_{v}") for v in values],
        *[F.lag(f"_end_{c}").over(order_slabs).alias(f"_carry_{c}") for c in previous],
    )
    if not keys:
        carry = F.broadcast(carry)  # one row per slab
    out = rows.join(carry, [*keys, "_slab"])
    return out.select(
        *df.columns,
        *[(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(f"cum_{v}") for v in values],
        *[f"total_{v}" for v in values],
        *[F.coalesce(f"_lag_{c}", f"_carry_{c}").alias(f"prev_{c}") for c in previous],
    )


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles ``q0..qn`` per key, exact at any size.

    Distinct values are counted first, so memory does not depend on how many
    rows or distinct values a key has.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, keys, [F.col(value)], ["_n"]).withColumnRenamed("total__n", "_total")
    start, end = F.col("cum__n") - F.col("_n"), F.col("cum__n")
    aggs = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * F.lit(float(p))
        for tag, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (rank >= start) & (rank < end)
            aggs.append(F.max(F.when(here, F.col(value))).alias(f"_{tag}{i}"))
    picked = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *aggs)

    def between(i: int, p: float) -> Column:
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        return (lo + (hi - lo) * (at - F.floor(at))).alias(f"q{i}")

    return picked.select(*keys, F.col("_total").alias("n"), *[between(i, p) for i, p in enumerate(probs)])


def nearest_rank(df: DataFrame, value: str, percents: list[float]) -> DataFrame:
    """Nearest-rank percentiles ``p0..pn``: sorted position round-half-even(p/100*(n-1))."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counts, [], [F.col(value)], ["_n"]).withColumnRenamed("total__n", "_total")
    aggs = []
    for i, p in enumerate(percents):
        rank = F.rint((F.col("_total") - 1) * F.lit(p / 100.0))
        here = (rank >= F.col("cum__n") - F.col("_n")) & (rank < F.col("cum__n"))
        aggs.append(F.max(F.when(here, F.col(value))).alias(f"p{i}"))
    return ranked.agg(*aggs)
