"""Appeals and analyst feedback, processed in batches of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.operators.lists import entities
from txnguard.operators.prefix import running_totals
from txnguard.schemas import EVENT_FIELDS


def numbered(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Consecutive ids in a stable order (the columns in ``order`` identify a row)."""
    counted = running_totals(df.withColumn("_one", F.lit(1)), [], [F.col(c) for c in order], ["_one"])
    return counted.withColumn(name, F.col("cum__one") + start).drop("cum__one", "total__one", "_one")


def judge_appeals(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """Requests beside their event, with ``error`` NULL when acceptable."""
    known = scored.withColumnRenamed("decision", "original_decision").withColumnRenamed(
        "fraud_score", "original_fraud_score").select(*EVENT_FIELDS, "original_decision", "original_fraud_score")
    error = (F.when(~F.col("appellant_role").isin("customer", "analyst", "system"), "role not allowed")
             .when(F.col("original_decision").isNull(), F.concat(F.lit("event "), F.col("event_id"), F.lit(" not found")))
             .when(F.col("original_decision") == "ALLOW", "event was ALLOW (no appeal needed)"))
    return requests.join(known, "event_id", "left").withColumn("error", error)


def submit_appeals(requests: DataFrame, scored: DataFrame, ttl_s: int = K.APPEAL_WHITE_TTL_S) -> dict[str, DataFrame]:
    """accepted (appeal log rows), rejected, whitelist (list rows), reemitted (raw events)."""
    judged = judge_appeals(requests, scored)
    ok = judged.where(F.col("error").isNull())
    named = [F.when(F.col(c) != "", F.struct(F.lit(t).alias("entity_type"), F.col(c).alias("entity_id")))
             for t, c in K.ENTITY_COLUMNS]
    accepted = ok.select(
        "event_id", "appellant_name", "appellant_role", "reason", "submitted_at_ms", "original_decision",
        "original_fraud_score", F.array_compact(F.array(*named)).alias("whitelisted_entities"),
        F.lit(None).cast("long").alias("resolved_at_ms"), F.lit(None).cast("string").alias("final_decision"),
        F.lit(None).cast("double").alias("final_fraud_score"), F.lit(None).cast("string").alias("resolution_notes"))
    reason = F.concat(F.lit("appeal by "), F.col("appellant_role"), F.lit(": "), F.substring("reason", 1, 80))
    carry = ok.withColumn("_why", reason)
    white = entities(carry, ["_why", "submitted_at_ms"]).select(
        F.lit("white").alias("list"), "entity_type", "entity_id", F.col("_why").alias("reason"),
        F.lit(0).cast("long").alias("block_count"), F.col("submitted_at_ms").alias("added_at_ms"),
        (F.col("submitted_at_ms") + ttl_s * 1000).alias("expires_at_ms"))
    return {
        "accepted": accepted,
        "rejected": judged.where(F.col("error").isNotNull()).select("event_id", "appellant_role", "error"),
        "whitelist": white,
        "reemitted": ok.withColumn("source_label", F.lit("appeal")).select(*EVENT_FIELDS).dropDuplicates(["event_id"]),
    }


def unresolved(appeals: DataFrame, as_of: Column) -> DataFrame:
    """Open appeals with minutes waiting; order by submission when showing them."""
    waiting = F.round((as_of - F.col("submitted_at_ms")) / 60_000.0, 1)
    return appeals.where(F.col("resolved_at_ms").isNull()).select(
        "appeal_id", "event_id", "appellant_role", "submitted_at_ms", "original_decision", "original_fraud_score",
        F.substring("reason", 1, 80).alias("reason_preview"), waiting.alias("minutes_waiting"))


def resolve(appeals: DataFrame, resolutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(appeals after closing the open ones, one outcome row per resolution).

    Resolutions: appeal_id, resolved_at_ms, final_decision, final_fraud_score, notes.
    """
    r = resolutions.select("appeal_id", F.col("resolved_at_ms").alias("_at"), F.col("final_decision").alias("_decision"),
                           F.col("final_fraud_score").alias("_score"), F.col("notes").alias("_notes"))
    joined = appeals.join(r, "appeal_id", "left")
    closing = F.col("resolved_at_ms").isNull() & F.col("_at").isNotNull()
    after = joined.withColumns({
        "final_decision": F.when(closing, F.col("_decision")).otherwise(F.col("final_decision")),
        "final_fraud_score": F.when(closing, F.col("_score")).otherwise(F.col("final_fraud_score")),
        "resolution_notes": F.when(closing, F.col("_notes")).otherwise(F.col("resolution_notes")),
        "resolved_at_ms": F.when(closing, F.col("_at")).otherwise(F.col("resolved_at_ms")),
    }).select(*appeals.columns)
    open_ids = appeals.where(F.col("resolved_at_ms").isNull()).select("appeal_id", F.lit(True).alias("ok"))
    outcome = resolutions.select("appeal_id").join(open_ids, "appeal_id", "left").withColumn(
        "ok", F.coalesce("ok", F.lit(False))).withColumn(
        "error", F.when(~F.col("ok"), "appeal not found or already resolved"))
    return after, outcome


def judge_feedback(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """Verdicts beside the model's decision, with ``error`` NULL when acceptable."""
    known = scored.select("event_id", F.col("decision").alias("model_decision"),
                          F.col("fraud_score").alias("model_fraud_score"))
    d = requests.withColumn("analyst_verdict", F.upper("verdict")).drop("verdict").join(known, "event_id", "left")
    error = (F.when(~F.col("analyst_verdict").isin("FRAUD", "LEGIT"), "verdict not allowed")
             .when(~F.col("analyst_role").isin("analyst", "system"), "role not allowed")
             .when(F.col("model_decision").isNull(), F.concat(F.lit("event "), F.col("event_id"), F.lit(" not found"))))
    return d.withColumn("error", error).withColumn(
        "model_agreed", F.when(error.isNull(), X.agrees("model_decision", "analyst_verdict")))


FEEDBACK_FIELDS = ["event_id", "analyst_name", "analyst_role", "model_decision", "model_fraud_score",
                   "analyst_verdict", "model_agreed", "notes", "submitted_at_ms"]


def submit_feedback(requests: DataFrame, scored: DataFrame) -> dict[str, DataFrame]:
    judged = judge_feedback(requests, scored)
    return {"accepted": judged.where(F.col("error").isNull()).select(*FEEDBACK_FIELDS),
            "rejected": judged.where(F.col("error").isNotNull()).select("event_id", "analyst_role", "analyst_verdict", "error")}


def training_labels(feedback: DataFrame) -> DataFrame:
    """Latest verdict per event as a 0/1 label; of verdicts of one moment, the last by name and verdict."""
    order = F.struct("submitted_at_ms", "analyst_name", "analyst_verdict")
    top = feedback.groupBy("event_id").agg(F.max_by("analyst_verdict", order).alias("v"),
                                           F.max("submitted_at_ms").alias("labelled_at_ms"))
    return top.select("event_id", (F.col("v") == "FRAUD").cast("int").alias("label"), "labelled_at_ms")
