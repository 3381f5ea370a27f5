"""Per-key history over event time, cut into time blocks.

A key's timeline is split into blocks of fixed length. Rows are first folded to
one per (key, millisecond), so a block never holds more rows than it has
milliseconds whatever share of the data its key has; the running state is
carried from block to block through one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOUR_MS = 3_600_000


def _points(df: DataFrame, key: str, ms: str, values: dict[str, Column]) -> DataFrame:
    return df.groupBy(F.col(key).alias("_key"), F.col(ms).alias("_t")).agg(
        *[F.sum(expr).alias(name) for name, expr in values.items()])


def trailing_totals(df: DataFrame, key: str, ms: str, values: dict[str, Column],
                    windows: dict[str, tuple[int, int]], block_ms: int = HOUR_MS) -> DataFrame:
    """Totals of ``values`` over ``[t - back, t - upto]`` for each distinct (key, t).

    ``windows`` maps a label to ``(back, upto)`` in ms; ``upto`` is 0 to include
    the present millisecond and 1 to stop just before it. Every window is the
    difference of two running totals, so its length does not change the cost.
    Output: key, ms, ``<value>_<label>``.
    """
    points = _points(df, key, ms, values)
    edges = sorted({upto for _, upto in windows.values()} | {back + 1 for back, _ in windows.values()})
    lanes = F.array(*[F.struct(F.lit(e).cast("long").alias("edge"), (F.col("_t") - e).alias("at")) for e in edges])
    walk = points.select("_key", "_t", *values, F.explode(lanes).alias("_p"))
    if 0 not in edges:
        own = points.select("_key", "_t", *values, F.struct(F.lit(0).cast("long").alias("edge"),
                                                            F.col("_t").alias("at")).alias("_p"))
        walk = walk.unionByName(own)
    own_row = F.col("_p.edge") == 0
    walk = walk.select(
        "_key", "_t", F.col("_p.edge").alias("_edge"), F.col("_p.at").alias("_at"),
        F.floor(F.col("_p.at") / F.lit(block_ms)).alias("_block"),
        *[F.when(own_row, F.col(v)).otherwise(F.lit(0)).alias(v) for v in values])

    inside = Window.partitionBy("_key", "_block").orderBy("_at")  # range frame: ties count together
    rows = walk.withColumns({f"_in_{v}": F.sum(v).over(inside) for v in values})
    # One row per (key, block): bounded by the data's time span over the block length.
    carried = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = walk.groupBy("_key", "_block").agg(*[F.sum(v).alias(v) for v in values]).select(
        "_key", "_block", *[F.coalesce(F.sum(v).over(carried), F.lit(0)).alias(f"_off_{v}") for v in values])
    placed = rows.join(per_block, ["_key", "_block"])
    folded = placed.groupBy("_key", "_t").agg(*[
        F.max(F.when(F.col("_edge") == e, F.col(f"_in_{v}") + F.col(f"_off_{v}"))).alias(f"_{v}_{e}")
        for v in values for e in edges])
    return folded.select(
        F.col("_key").alias(key), F.col("_t").alias(ms),
        *[(F.col(f"_{v}_{upto}") - F.col(f"_{v}_{back + 1}")).alias(f"{v}_{label}")
          for v in values for label, (back, upto) in windows.items()])


def near_totals(df: DataFrame, key: str, ms: str, values: dict[str, Column],
                windows: dict[str, tuple[int, int]], block_ms: int = HOUR_MS, judged: Column | None = None,
                span: tuple[int, int] | None = None) -> DataFrame:
    """The totals of ``trailing_totals`` for windows of about a block, in two shuffles.

    A row is copied to the later blocks whose windows reach back to it, so each block holds all that its own rows need:
    nothing is carried from block to block, and a row's window edges stay in its block. A block is at least a quarter of
    the longest window, which bounds the copies of a (key, millisecond) at six.

    With ``judged`` only points with a row of those have totals; the others just count. ``span``, the least and greatest ms of points
    that are asked for, leaves out copies to blocks before and after it, where no window is.
    """
    longest = max(back for back, _ in windows.values())
    size = F.lit(max(block_ms, -(-longest // 4)))
    points = _points(df, key, ms, values | {"_judged": F.lit(1) if judged is None else F.when(judged, 1).otherwise(0)}).where(F.col("_t").isNotNull())
    home, asked = F.floor(F.col("_t") / size), F.col("_judged") > 0
    blocks = F.sequence(home, F.floor((F.col("_t") + longest) / size))
    if span is not None:
        first, last = (F.floor(F.lit(t) / size) for t in span)
        blocks = F.filter(blocks, lambda b: (b >= first) & (b <= last))
    edges = sorted({0} | {upto for _, upto in windows.values()} | {back + 1 for back, _ in windows.values()})
    # the row itself in every block that needs it, and its window edges in its own
    copies = F.transform(blocks, lambda b: F.struct(
        b.alias("block"), F.lit(0).cast("long").alias("edge"), F.col("_t").alias("at")))
    lanes = F.array(*[F.struct(home.alias("block"), F.lit(e).cast("long").alias("edge"), (F.col("_t") - e).alias("at"))
                      for e in edges if e])
    placed = F.concat(copies, lanes) if judged is None else F.when(asked, F.concat(copies, lanes)).otherwise(copies)
    walk = points.select("_key", "_t", *values, F.when(asked, home).alias("_home"), F.explode(placed).alias("_p")).select(
        "_key", "_t", "_home", F.col("_p.block").alias("_block"), F.col("_p.edge").alias("_edge"), F.col("_p.at").alias("_at"),
        *[F.when(F.col("_p.edge") == 0, F.col(v)).otherwise(F.lit(0)).alias(v) for v in values])
    inside = Window.partitionBy("_key", "_block").orderBy("_at")  # range frame: ties count together
    rows = walk.withColumns({f"_in_{v}": F.sum(v).over(inside) for v in values}).where("_block = _home")
    folded = rows.groupBy("_key", "_block", "_t").agg(*[
        F.max(F.when(F.col("_edge") == e, F.col(f"_in_{v}"))).alias(f"_{v}_{e}") for v in values for e in edges])
    return folded.select(
        F.col("_key").alias(key), F.col("_t").alias(ms),
        *[(F.col(f"_{v}_{upto}") - F.col(f"_{v}_{back + 1}")).alias(f"{v}_{label}")
          for v in values for label, (back, upto) in windows.items()])


def totals_before(df: DataFrame, key: str, ms: str, values: dict[str, Column],
                  block_ms: int = HOUR_MS) -> DataFrame:
    """Totals of everything strictly earlier on the key (``before_<v>``) and the
    preceding distinct time (``prev_ms``), one row per distinct (key, ms)."""
    points = _points(df, key, ms, values).withColumn("_block", F.floor(F.col("_t") / F.lit(block_ms)))
    inside = Window.partitionBy("_key", "_block").orderBy("_t")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = points.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}
                              | {"_lag": F.lag("_t").over(inside)})
    blocks = Window.partitionBy("_key").orderBy("_block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    per_block = points.groupBy("_key", "_block").agg(
        *[F.sum(v).alias(v) for v in values], F.max("_t").alias("_last")).select(
        "_key", "_block", F.lag("_last").over(blocks).alias("_carry"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in values])
    return rows.join(per_block, ["_key", "_block"]).select(
        F.col("_key").alias(key), F.col("_t").alias(ms),
        F.coalesce("_lag", "_carry").alias("prev_ms"),
        *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"before_{v}") for v in values])
