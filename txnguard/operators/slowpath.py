"""The slow path: explain, narrate and grade what was flagged."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.operators import explain, training
from txnguard.operators.scoring import Scorecard
from txnguard.schemas import ENRICHED


def feature_means(events: DataFrame, model: Scorecard) -> Column:
    """Averages of the model's inputs as one struct-valued scalar."""
    return events.agg(F.struct(*[F.avg(v.cast("double")).alias(n) for n, v in model.values().items()])).scalar()


def enrich(scored: DataFrame, model: Scorecard, means: Column, top_n: int = K.TOP_CONTRIBUTORS,
           enriched_at: Column | None = None, latency: Column | None = None) -> DataFrame:
    """Enriched records of the REVIEW and BLOCK events. A narrative that fails its
    grade is emptied; the event is still emitted."""
    flagged = scored.where(X.flagged("decision")).withColumn("_means", means)
    every = explain.linear_contributions(model.weights, model.values(), {n: F.col(f"_means.{n}") for n in model.weights})
    return told(flagged.withColumn("top_contributors", explain.top_contributors(every, top_n)), enriched_at, latency)


def enrich_trees(scored: DataFrame, x: DataFrame, model: GBTClassificationModel, top_n: int = K.TOP_CONTRIBUTORS,
                 enriched_at: Column | None = None, latency: Column | None = None) -> DataFrame:
    """The same for a boosted model: Shapley values of its margin. ``x``: event_id and the model's features; only flagged
    events' rows are attributed."""
    flagged = scored.where(X.flagged("decision"))
    mine = x.join(flagged.select("event_id"), "event_id", "left_semi")
    top = training.top_paths(training.shapley_contributions(model, mine), mine, top_n).select("event_id", "top_contributors")
    return told(flagged.join(top, "event_id"), enriched_at, latency)


def told(d: DataFrame, enriched_at: Column | None = None, latency: Column | None = None) -> DataFrame:
    """Events with their contributors, narrated and graded."""
    d = d.withColumns({"narrator_mode": F.lit("TEMPLATE"), "narrative": explain.template_narrative(F.col("top_contributors"))})
    d = d.withColumn("narrative_grading_passed", explain.grade(F.col("narrative"), F.col("top_contributors"), F.col("narrator_mode")))
    now = F.unix_millis(F.current_timestamp())
    return d.withColumns({
        "narrative": F.when(F.col("narrative_grading_passed"), F.col("narrative")).otherwise(""),
        "enriched_at_ms": now if enriched_at is None else enriched_at,
        "enrichment_latency_ms": F.lit(0).cast("long") if latency is None else latency,
    }).select(*[F.col(f.name).cast(f.dataType) for f in ENRICHED.fields])


def live_coverage(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count(F.lit(1)).alias("enriched"), F.count_if(explain.has_live_feature(F.col("top_contributors"))).alias("with_live_feature"))


def feature_frequency(enriched: DataFrame, decision: str = "BLOCK") -> DataFrame:
    rows = enriched.where(F.col("decision") == decision).select(F.explode("top_contributors").alias("c"))
    return rows.groupBy(F.col("c.feature_name").alias("feature")).agg(F.count(F.lit(1)).alias("events"))


def alert_feed(enriched: DataFrame) -> DataFrame:
    """Every flagged event, worst first."""
    return enriched.orderBy(F.desc("fraud_score"), "event_id").select(
        "event_id", "customer_id", "amount", "decision", "fraud_score", "narrative")


def text_summary(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("text_anomaly_label").isNotNull()).groupBy(F.col("text_anomaly_label").alias("label")).agg(
        F.count(F.lit(1)).alias("merchants_checked"), F.avg("text_anomaly_score").alias("avg_score"))


def text_coverage(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("enriched"), F.count("text_anomaly_label").alias("checked"))


def silver_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.avg("text_anomaly_score").alias("avg_text_anomaly"),
                                        F.count_if("text_suspicious").alias("suspicious_count"))
