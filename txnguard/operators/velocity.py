"""Burst detection per card over trailing windows of event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.operators.timeline import HOUR_MS, near_totals


def _edges(windows) -> dict[str, tuple[int, int]]:
    """Closed windows, but the longest one loses its lower bound (evicted first)."""
    longest = max(s for _, s, _ in windows)
    return {label: (s * 1000 - (1 if s == longest else 0), 0) for label, s, _ in windows}


def verdict(windows) -> dict[str, Column]:
    """Hit, window and reason from ``n_<label>`` counts, narrowest window first."""
    hit, label, reason = F.lit(False), F.lit(""), F.lit("")
    for name, _, threshold in reversed(list(windows)):
        n = F.coalesce(F.col(f"n_{name}"), F.lit(0))
        over = n >= threshold
        text = F.concat(n.cast("string"), F.lit(f" txns on card in {name} (threshold {threshold})"))
        hit, label, reason = over | hit, F.when(over, name).otherwise(label), F.when(over, text).otherwise(reason)
    return {"velocity_hit": hit, "velocity_window": label, "velocity_reason": reason}


def _once(events: DataFrame) -> DataFrame:
    """Events with a card; a repeated event counts once, at its latest time."""
    live = events.where(F.col("card_token").isNotNull() & (F.col("card_token") != ""))
    return live.groupBy("event_id", "card_token").agg(F.max("event_timestamp_ms").alias("event_timestamp_ms"))


def counts(events: DataFrame, windows=K.VELOCITY_WINDOWS, block_ms: int = HOUR_MS) -> DataFrame:
    """``n_<label>`` for each distinct (card, ms)."""
    return counts_of(_once(events), windows, block_ms)


def counts_of(once: DataFrame, windows=K.VELOCITY_WINDOWS, block_ms: int = HOUR_MS, judged: Column | None = None,
              span: tuple[int, int] | None = None) -> DataFrame:
    """The same for events that are folded already: one row each, with a card. ``judged`` and ``span`` as in ``near_totals``."""
    return near_totals(once, "card_token", "event_timestamp_ms", {"n": F.lit(1)}, _edges(windows), block_ms, judged, span)


def check(events: DataFrame, windows=K.VELOCITY_WINDOWS, recorded: Column | None = None,
          block_ms: int = HOUR_MS, history: DataFrame | None = None) -> DataFrame:
    """Events with velocity verdicts.

    ``recorded`` selects the events that enter the history (those no list
    caught); the others are neither counted nor judged. ``history`` holds
    events recorded earlier (event_id, card_token, event_timestamp_ms): they
    count but are not returned. Event time replaces the wall clock, and events
    sharing a millisecond count each other.
    """
    keep = F.lit(True) if recorded is None else recorded
    cols = ["event_id", "card_token", "event_timestamp_ms"]
    counted = events.where(keep).select(*cols)
    if history is not None:
        counted = counted.unionByName(history.select(*cols))
    found = counts(counted, windows, block_ms)
    key = ["card_token", "event_timestamp_ms"]
    judged = events.join(found, key, "left")
    zero = {f"n_{label}": F.when(keep, F.coalesce(F.col(f"n_{label}"), F.lit(0))).otherwise(0) for label, _, _ in windows}
    return judged.withColumns(zero).withColumns(verdict(windows))


def current_counts(events: DataFrame, as_of: Column, windows=K.VELOCITY_WINDOWS) -> DataFrame:
    """Read-only counts per card at ``as_of``."""
    edges = _edges(windows)
    longest = max(back for back, _ in edges.values())
    t = F.col("event_timestamp_ms")
    recent = events.where((t >= as_of - longest) & (t <= as_of) & (F.col("card_token") != ""))
    return recent.groupBy("card_token").agg(
        *[F.count_if(t >= as_of - back).alias(f"n_{label}") for label, (back, _) in edges.items()])
