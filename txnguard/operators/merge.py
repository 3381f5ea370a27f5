"""Latest-wins merges of keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard.schemas import EVENT_FIELDS, SCORE_FIELDS


def difference(rows: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``part``, in key order: train = all - test. A null key is in no part."""
    return rows.join(part.select(key), key, "left_anti").orderBy(key)


def latest_wins(rows: DataFrame, first: list[str], latest: list[str], version: str = "scored_at_ms",
                arrival: str = "arrival", key: str = "event_id") -> DataFrame:
    """Fold deliveries into one row per key.

    ``first`` columns stay as they first arrived; ``latest`` columns come from
    the greatest ``version``, the later arrival winning ties. Both parts are
    partial aggregates, so many copies of one key shrink before the shuffle.
    """
    folded = rows.groupBy(key).agg(
        F.min_by(F.struct(*first), F.col(arrival)).alias("_first"),
        F.max_by(F.struct(*latest), F.struct(version, arrival)).alias("_latest"))
    return folded.select(key, *[f"_first.{c}" for c in first], *[f"_latest.{c}" for c in latest])


def merge_scored(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    return latest_wins(rows, [c for c in EVENT_FIELDS if c != "event_id"],
                       [c for c in SCORE_FIELDS if c in rows.columns], arrival=arrival)


def merge_into(current: DataFrame | None, batch: DataFrame, first: list[str], latest: list[str],
               version: str = "scored_at_ms", key: str = "event_id") -> DataFrame:
    """The table after a batch: stored rows count as arriving before it."""
    cols = [key, *first, *latest]
    rows = batch.select(*cols, "arrival")
    if current is not None:
        rows = current.select(*cols, F.lit(-1).cast("long").alias("arrival")).unionByName(rows)
    return latest_wins(rows, first, latest, version, key=key)


def update_matched(table: DataFrame, updates: DataFrame, columns: list[str], key: str = "event_id") -> DataFrame:
    """Replace ``columns`` where the key has an update; other rows and columns stay."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = table.join(new, key, "left")
    return joined.withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(
        *table.columns)


def latest_per(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Newest row per key."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_r"))
    return top.select(*keys, "_r.*")


def second_scorer_rows(df: DataFrame) -> DataFrame:
    """The second scorer carries its reason in ``blocklist_reason``; store it as ``llm_reason``."""
    return df.select(*EVENT_FIELDS, *[c for c in SCORE_FIELDS[:7]], F.col("blocklist_reason").alias("llm_reason"))
