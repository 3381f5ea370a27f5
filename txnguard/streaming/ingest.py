"""Streaming jobs around the sink: multi-topic routing, bronze to silver, windows, comparisons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from txnguard import constants as K
from txnguard.operators import text
from txnguard.sources import stream as S
from txnguard.streaming.sink import BatchTable


def _start(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], every: str | None,
           mode: str = "append", name: str | None = None) -> StreamingQuery:
    """``handle`` may read its batch several times: it is read and decoded once, and kept by the executors until the batch is done."""
    def once(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()
    w = df.writeStream.foreachBatch(once).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)
    return w.start()


def route(records: DataFrame, tables: dict[str, tuple[str, BatchTable]], bad: BatchTable, checkpoint: str,
          every: str | None = "2 seconds") -> StreamingQuery:
    """One source of (topic, value, arrival); each topic's rows go to its own table.

    ``tables`` maps a topic to (record type, table). Payloads that do not parse go
    to ``bad``, and so do records of other topics. Where a failed flush used to drop its rows, Spark retries the batch.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        for topic, (record, table) in tables.items():
            frame = S.decode(batch.where(F.col("topic") == topic), record)
            table.write(S.decoded(frame, ["arrival"]), batch_id)
            bad_rows = S.quarantined(frame).withColumn("topic", F.lit(topic))
            BatchTable(bad.spark, f"{bad.path}/{topic}", bad.schema).write(bad_rows, batch_id)
        lost = batch.where(F.col("topic").isNull() | ~F.col("topic").isin(*tables))
        BatchTable(bad.spark, f"{bad.path}/other", bad.schema).write(lost.select(*bad.schema.fieldNames()), batch_id)

    return _start(records, checkpoint, handle, every)


def bronze_to_silver(bronze: DataFrame, score: Column, path: str, checkpoint: str,
                     suspicious: float = K.SUSPICIOUS_LOG_PPL) -> StreamingQuery:
    """Score, flag and append; process what is there and stop. ``score`` may be a pandas UDF."""
    return _silver(bronze.withColumn("text_anomaly_score", score).withColumn(
        "text_suspicious", F.coalesce(F.col("text_anomaly_score") >= suspicious, F.lit(False))), path, checkpoint)


def bronze_to_silver_text(bronze: DataFrame, mean_log_prob: Column, path: str, checkpoint: str,
                          suspicious: float = K.SUSPICIOUS_LOG_PPL) -> StreamingQuery:
    """The same with a language model in the scorer's slot: perplexity, score, label and flag from its mean log-probability."""
    out = text.score_with(bronze.withColumn("_log_prob", mean_log_prob), F.col("_log_prob"), suspicious).drop("_log_prob")
    return _silver(out.withColumn("text_suspicious", F.col("text_anomaly_label") == "SUSPICIOUS"), path, checkpoint)


def _silver(out: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def event_time(df: DataFrame, ms: str = "event_timestamp_ms", delay: str = "10 minutes") -> DataFrame:
    return df.withColumn("event_time", F.timestamp_millis(F.col(ms))).withWatermark("event_time", delay)


def deduplicated(df: DataFrame, key: str = "event_id", ms: str = "event_timestamp_ms", delay: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries seen within the watermark."""
    return event_time(df, ms, delay).dropDuplicatesWithinWatermark([key])


def decision_windows(scored: DataFrame, length: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Decisions per tumbling or sliding window of scoring time."""
    timed = event_time(scored, "scored_at_ms", delay)
    span = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    per = timed.groupBy(span.alias("w"), "decision").agg(F.count(F.lit(1)).alias("events"), F.avg("fraud_score").alias("avg_score"))
    return per.select(F.unix_millis("w.start").alias("window_start_ms"), F.unix_millis("w.end").alias("window_end_ms"),
                      "decision", "events", "avg_score")


def customer_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    timed = event_time(events, delay=delay)
    per = timed.groupBy(F.session_window("event_time", gap).alias("w"), "customer_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("amount").alias("amount"))
    return per.select("customer_id", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"), "events", "amount")


def drift_windows(compared: DataFrame, length: str = "1 hour", threshold: float = 0.05, delay: str = "10 minutes") -> DataFrame:
    timed = event_time(compared, "scored_at_ms", delay)
    n, bad = F.count(F.lit(1)), F.count_if(~F.col("decisions_agree"))
    per = timed.groupBy(F.window("event_time", length).alias("w")).agg(n.alias("compared"), bad.alias("disagreements"))
    rate = F.col("disagreements") / F.col("compared")
    return per.select(F.unix_millis("w.start").alias("window_start_ms"), "compared", "disagreements", rate.alias("rate"),
                      (rate > threshold).alias("alarm_fired"))


def compare_streams(first: DataFrame, second: DataFrame, within: str = "10 minutes", how: str = "inner") -> DataFrame:
    """Two scored streams joined on event id with bounded state."""
    a = first.select("event_id", F.col("decision").alias("first_decision"), F.col("fraud_score").alias("first_score"),
                     "scored_at_ms", F.timestamp_millis("scored_at_ms").alias("at")).withWatermark("at", within)
    b = second.select(F.col("event_id").alias("other_id"), F.col("decision").alias("second_decision"),
                      F.col("fraud_score").alias("second_score"), F.timestamp_millis("scored_at_ms").alias("other_at")).withWatermark("other_at", within)
    near = F.expr(f"event_id = other_id AND other_at BETWEEN at - INTERVAL {within} AND at + INTERVAL {within}")
    return a.join(b, near, {"inner": "inner", "left": "leftOuter"}[how]).select(
        "event_id", "scored_at_ms", "first_decision", "second_decision", (F.col("first_decision") == F.col("second_decision")).alias("decisions_agree"),
        F.abs(F.col("first_score") - F.col("second_score")).alias("score_diff"))


def upsert_windows(df: DataFrame, table: BatchTable, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Changed windows per micro-batch; ``latest_windows`` reads the newest of each."""
    return _start(df, checkpoint, table.write, every, mode="update")


def latest_windows(table: BatchTable, keys: list[str]) -> DataFrame:
    rest = [c for c in table.schema.fieldNames() if c not in keys]
    top = table.read().groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("r"))
    return top.select(*keys, "r.*")


def observed(scored: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """Run counters of a batch, gathered while it is written."""
    seen = Observation(name)
    return scored.observe(
        seen, F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col("decision") == x).alias(x.lower()) for x in K.DECISIONS],
        F.count_if("blocklist_hit").alias("list_hits"), F.count_if("velocity_hit").alias("velocity_hits"),
        F.avg("scoring_latency_ms").alias("avg_latency_ms"), F.max("scoring_latency_ms").alias("max_latency_ms")), seen
