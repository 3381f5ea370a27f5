"""Counters of a running query: what its listener and its own tables say of each micro-batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from txnguard.sources import stream as S
from txnguard.streaming.sink import BatchTable

_FIELDS = [("batch_id", T.LongType()), ("started_at", T.StringType()), ("input_rows", T.LongType()), ("rows_per_second", T.DoubleType()), ("duration_ms", T.LongType()),
           ("consumed", T.LongType()), ("decode_failures", T.LongType()), ("offsets", T.StringType())]
PROGRESS = T.StructType([T.StructField(c, k) for c, k in _FIELDS])


def decoded(raw: DataFrame, record: str, keep: list[str] = ()) -> DataFrame:
    """Decoded records; what was read and what did not decode is observed as the batch passes."""
    frame = S.decode(raw, record)
    return S.decoded(frame.observe("decode", F.count(F.lit(1)).alias("consumed"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("decode_failures")), keep)


class Progress(StreamingQueryListener):
    """Stores one row for each micro-batch of the query of this name: rows, rate, duration, observed counts, and the offsets it reached.
    Rows are written in groups of ``every`` and when the query ends."""

    def __init__(self, spark: SparkSession, name: str, table: BatchTable, every: int = 50):
        self.spark, self.name, self.table, self.every = spark, name, table, every
        self.held: list[tuple] = []
        self.id = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or not p.numInputRows:
            return
        seen = p.observedMetrics.get("decode")
        self.held.append((p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond), p.batchDuration,
                          seen["consumed"] if seen else None, seen["decode_failures"] if seen else None, json.dumps([s.endOffset for s in p.sources])))
        if len(self.held) >= self.every:
            self.store()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.id:
            self.store()

    def store(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.table.write(self.spark.createDataFrame(rows, PROGRESS), rows[0][0])


def heard(spark: SparkSession) -> None:
    """Wait until listeners have had all events so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


def run_counters(progress: DataFrame, scored: DataFrame) -> DataFrame:
    """One row for a run: read, decoded, scored, decided, by which rule, how fast. ``scored`` has a row for each scored event."""
    p = progress.agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("consumed"), F.lit(0)).alias("consumed"),
                     F.coalesce(F.sum("decode_failures"), F.lit(0)).alias("decode_failures"), (F.sum("duration_ms") / 1000).alias("elapsed_s"),
                     (F.sum("consumed") / (F.sum("duration_ms") / 1000)).alias("events_per_second"))
    d, tier = F.col("decision"), F.col("blocklist_tier")
    s = scored.agg(F.count(F.lit(1)).alias("produced"), F.count_if(F.col("fraud_score").isNull()).alias("score_failures"),
                   *[F.count_if(d == x).alias(x.lower()) for x in ("ALLOW", "REVIEW", "BLOCK")], F.count_if(tier == "BLOCK").alias("list_hits"),
                   F.count_if(tier == "HOT").alias("hot_hits"), F.count_if("velocity_hit").alias("velocity_hits"),
                   F.avg("scoring_latency_ms").alias("avg_latency_ms"), F.max("scoring_latency_ms").alias("max_latency_ms"))
    return p.withColumn("one", F.lit(1)).join(s.withColumn("one", F.lit(1)), "one").drop("one")  # a row on each side
