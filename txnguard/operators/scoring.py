"""The fast path: lists, then velocity, then the model, then the decision."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.durable import materialize
from txnguard.functions import scalars as X
from txnguard.operators import features, lists, velocity
from txnguard.operators.joins import lookup_join, split_join
from txnguard.operators.timeline import HOUR_MS
from txnguard.schemas import SCORED


@dataclass
class Scorecard:
    """A logistic model over live feature values, scored as one expression."""

    intercept: float
    weights: dict[str, float]
    name: str = "scorecard"
    version: str = "v1"
    high_amount: float = K.HIGH_AMOUNT
    extra: dict[str, Column] = field(default_factory=dict)

    def values(self) -> dict[str, Column]:
        every = features.live_values(self.high_amount) | self.extra
        return {n: every[n] for n in self.weights}

    def score(self) -> Column:
        z = F.lit(self.intercept)
        for n, v in self.values().items():
            z = z + F.lit(self.weights[n]) * v
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def completeness() -> Column:
    """Share of the 43 features an event can fill; each absent value lowers it."""
    values = features.live_values()
    known = sum((F.when(v != K.SENTINEL, 1).otherwise(0) for v in values.values()), F.lit(0))
    return F.round(known / F.lit(len(K.FEATURES)), 4)


def _judged(events: DataFrame, entries: DataFrame, history: DataFrame | None, list_at: str) -> DataFrame:
    """One stored narrow row per event: its list verdict (NULL without one) and the latest card and time it counts at.

    Lists meet the events before the one shuffle by id: an event's entities are folded again where they were exploded.
    Deliveries of one id are one event, on the card of the latest that has one.
    """
    t, card = F.col("event_timestamp_ms"), F.col("card_token")
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(kind).alias("entity_type"), F.col(c).alias("entity_id"))
                      for i, (kind, c) in enumerate(K.ENTITY_COLUMNS)])
    named = F.filter(pairs, lambda e: e.entity_id.isNotNull() & (e.entity_id != ""))
    at = F.struct(t.alias("at"), F.when(card != "", card).alias("card"))
    seen = events.select("event_id", F.col(list_at).alias("_listed_at"), at.alias("_last"), F.explode_outer(named).alias("_e")).select(
        "event_id", "_listed_at", "_last", "_e.*")
    met = lookup_join(seen, entries, ["entity_type", "entity_id"], "left", spread_by=["event_id"])
    valid = (F.col("added_at_ms") <= F.col("_listed_at")) & (F.col("_listed_at") < F.col("expires_at_ms"))
    rows = met.select("event_id", "_last", F.when(valid, lists.speaks()).alias("_v"), F.lit(True).alias("own"))
    if history is not None:
        rows = rows.unionByName(history.select("event_id", at.alias("_last"), F.lit(False).alias("own")), allowMissingColumns=True)
    with_card = F.max(F.when(F.col("_last.card").isNotNull(), F.col("_last")))
    once = rows.groupBy("event_id").agg(F.min("_v").alias("_v"), F.bool_or("own").alias("own"),
                                        F.coalesce(with_card, F.max("_last")).alias("_last"))
    return materialize(lists.told(once.select("event_id", "_v", "own", F.col("_last.card").alias("card_token"),
                                              F.col("_last.at").alias("event_timestamp_ms"))), "judged")


def rules(events: DataFrame, entries: DataFrame, windows=K.VELOCITY_WINDOWS, block_ms: int = HOUR_MS,
          history: DataFrame | None = None, list_at: str = "event_timestamp_ms", hits_only: bool = False) -> DataFrame:
    """List verdict as of event time, then velocity over the events no list caught.

    Lists and velocity run on stored narrow rows; the wide events are shuffled once, to meet their verdicts (with
    ``hits_only`` just those that caught something, and no counts). Only an event's latest delivery is counted and judged by velocity.
    """
    judged = _judged(events, entries, history, list_at)
    free = ~F.coalesce("blocklist_hit", F.lit(False))
    counted = judged.where(free & F.col("card_token").isNotNull())
    t = F.col("event_timestamp_ms")
    span = judged.where("own").agg(F.min(t), F.max(t)).first()  # two numbers, known before the plan
    found = velocity.counts_of(counted, windows, block_ms, None if history is None else F.col("own"),
                               None if span[0] is None else tuple(span)).withColumns(velocity.verdict(windows))
    if hits_only:
        found = found.where("velocity_hit")
    counts = [] if hits_only else [f"n_{label}" for label, _, _ in windows]
    told = ["velocity_hit", "velocity_window", "velocity_reason"]
    met = judged.where("own").join(found.select("card_token", "event_timestamp_ms", *counts, *told), ["card_token", "event_timestamp_ms"], "left")
    if hits_only:
        met = met.where(F.col("blocklist_hit").isNotNull() | F.col("velocity_hit"))
    met = met.withColumnRenamed("event_timestamp_ms", "_at").drop("own", "card_token")
    here = free & F.coalesce(F.col("_at") == F.col("event_timestamp_ms"), F.lit(False))
    absent = {"blocklist_hit": F.lit(False), "blocklist_tier": F.lit("NONE"), "blocklist_reason": F.lit(""),
              "matched_entity_type": F.lit(""), "matched_entity_id": F.lit("")}
    judged_by = {c: F.lit(0).cast("long") for c in counts} | dict(zip(told, (F.lit(False), F.lit(""), F.lit(""))))
    return events.join(met, "event_id", "left").select(
        *events.columns, *[F.coalesce(F.col(c), other).alias(c) for c, other in absent.items()],
        *[F.coalesce(F.when(here, F.col(c)), other).alias(c) for c, other in judged_by.items()])


def rule_hits(events: DataFrame, entries: DataFrame, windows=K.VELOCITY_WINDOWS, block_ms: int = HOUR_MS,
              history: DataFrame | None = None, list_at: str = "event_timestamp_ms") -> DataFrame:
    """The same verdicts without counts: the wide events meet nothing but the hits, which AQE broadcasts while they are few."""
    return rules(events, entries, windows, block_ms, history, list_at, hits_only=True).drop("matched_entity_type", "matched_entity_id")


def fast_path(events: DataFrame, entries: DataFrame, model: Scorecard | Callable[[DataFrame], DataFrame],
              windows=K.VELOCITY_WINDOWS, review_at: float = K.REVIEW_AT, block_at: float = K.BLOCK_AT,
              scored_at: Column | None = None, latency: Column | None = None,
              model_name: str = "model", model_version: str = "v1", block_ms: int = HOUR_MS,
              history: DataFrame | None = None, list_at: str = "event_timestamp_ms", carry: list[str] = ()) -> DataFrame:
    """Scored records (29 fields), with the event columns in ``carry``. ``list_at`` is the time at which lists must be valid.

    A block hit scores 1, a hot or velocity hit 0.5, both with completeness 0;
    the model sees only the rest. A Scorecard is an expression and needs no
    split; any other model is a function from those rows to the same rows with
    ``fraud_score``, applied to them alone.
    """
    ruled = rule_hits(events, entries, windows, block_ms, history, list_at)
    blocked, hot, fast = F.col("blocklist_tier") == "BLOCK", F.col("blocklist_tier") == "HOT", F.col("velocity_hit")
    by_rule = blocked | hot | fast
    fixed = F.when(blocked, F.lit(1.0)).otherwise(F.lit(0.5))
    if isinstance(model, Scorecard):
        model_name, model_version = model.name, model.version
        scored = ruled.withColumn("fraud_score", F.when(by_rule, fixed).otherwise(model.score()))
    else:
        held = materialize(ruled, "ruled")
        rest = model(held.where(~by_rule)).select(*held.columns, "fraud_score")
        scored = held.where(by_rule).withColumn("fraud_score", fixed).unionByName(rest)
    decision = F.when(blocked, "BLOCK").when(hot | fast, "REVIEW").otherwise(X.decide("fraud_score", review_at, block_at))
    now = F.unix_millis(F.current_timestamp())
    return scored.withColumns({
        "decision": decision,
        "model_name": F.lit(model_name), "model_version": F.lit(model_version),
        "scored_at_ms": now if scored_at is None else scored_at,
        "scoring_latency_ms": F.lit(0).cast("long") if latency is None else latency,
        "feature_completeness": F.when(by_rule, F.lit(0.0)).otherwise(completeness()),
    }).select(*[F.col(f.name).cast(f.dataType) for f in SCORED.fields], *carry)


def feature_hash(columns: list[str]) -> Column:
    """32 hex digits over the feature values (never their names)."""
    return F.substring(F.sha2(F.to_json(F.array(*[F.col(c).cast("double") for c in columns])), 256), 1, 32)


def score_once(rows: DataFrame, columns: list[str], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score every distinct feature vector once and share the result.

    Equal vectors fold before the shuffle; the few that stand for much of the
    data are joined back apart from the rest.
    """
    hashed = rows.withColumn("feature_hash", feature_hash(columns))
    distinct = hashed.groupBy("feature_hash").agg(*[F.first(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_uses"))
    scores = materialize(score(distinct).select("feature_hash", "fraud_score", "_uses"), "scores")
    return split_join(hashed, scores, ["feature_hash"], "_uses", spread_by=["event_id"])
