"""The fast path as a stream of micro-batches.

Each micro-batch reads the current lists and the recent part of the velocity
history, and runs the batch operators over both. A hot card is therefore split
by time blocks exactly as in the batch job, instead of living in one task's
state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from txnguard import constants as K
from txnguard.operators import scoring
from txnguard.operators.timeline import HOUR_MS
from txnguard.schemas import EVENT, LIST_ENTRY, SCORED
from txnguard.streaming.ingest import _start
from txnguard.streaming.sink import BatchTable

_ARRIVAL = T.StructField("arrival", T.LongType())
HISTORY = T.StructType([EVENT[c] for c in ("event_id", "card_token", "event_timestamp_ms")] + [T.StructField("day", T.LongType())])

PROGRESS = T.StructType([T.StructField("newest_ms", T.LongType())])
DAY_MS = 86_400_000


@dataclass
class Tables:
    scored: BatchTable
    history: BatchTable
    late: BatchTable
    progress: BatchTable

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> "Tables":
        return cls(BatchTable(spark, f"{root}/scored", T.StructType(SCORED.fields + [_ARRIVAL])),
                   BatchTable(spark, f"{root}/history", HISTORY, by="day"), BatchTable(spark, f"{root}/late", EVENT),
                   BatchTable(spark, f"{root}/progress", PROGRESS))


def read_lists(spark: SparkSession, path: str | None) -> DataFrame:
    """The stored list table as it is now; without one nothing is listed."""
    try:
        return spark.read.schema(LIST_ENTRY).parquet(path) if path else spark.createDataFrame([], LIST_ENTRY)
    except AnalysisException as error:  # fail open only when there is no list table
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LIST_ENTRY)


def score_batch(batch: DataFrame, batch_id: int, tables: Tables, lists: DataFrame, model, windows=K.VELOCITY_WINDOWS,
                lateness_ms: int = 600_000, block_ms: int = HOUR_MS, **options) -> None:
    """Score one micro-batch and store it under its batch id; a retry overwrites the same partitions.

    ``arrival``, if the batch has it, is the event's offset in its source; else rows have no order of arrival within a
    batch. ``emitted_at_ms``, if it has that, is set for events that were sent again: they count as of that time for lists
    and lateness, and before other deliveries of their event.
    """
    t = F.col("event_timestamp_ms")
    if "arrival" not in batch.columns:
        batch = batch.withColumn("arrival", F.xxhash64("event_id"))
    if "emitted_at_ms" not in batch.columns:
        batch = batch.withColumn("emitted_at_ms", F.lit(None).cast("long"))
    now = F.coalesce("emitted_at_ms", t)
    past = tables.history.read(before=batch_id)
    horizon = F.lit(tables.progress.read(before=batch_id).agg(F.max("newest_ms")).first()[0]) - lateness_ms
    # of repeated deliveries the earliest counts, so that a retry keeps the same copy
    whole = F.struct(*batch.columns)
    first = F.struct(F.col("emitted_at_ms").isNull(), t, "arrival", F.xxhash64(whole))
    good = batch.groupBy("event_id").agg(F.min_by(whole, first).alias("e")).select("e.*").withColumn("listed_at_ms", now).persist()  # read by every rule
    tables.late.write(good.where(F.coalesce(now < horizon, F.lit(False))), batch_id)  # an extra copy: late events are scored too
    span = max(s for _, s, _ in windows) * 1000
    oldest = F.lit(good.agg(F.min("event_timestamp_ms")).first()[0]) - span  # one number, known before the plan
    # Earlier unlisted events of the window were judged before: now they only count.
    recent = past.where((F.col("day") >= F.floor(oldest / DAY_MS)) & (t >= oldest))  # older days are not opened
    history = recent.join(good.select("event_id"), "event_id", "left_anti")
    new = scoring.fast_path(good, lists, model, windows, block_ms=block_ms, history=history, list_at="listed_at_ms", carry=["arrival"], **options)
    tables.scored.write(new, batch_id)
    stored = tables.scored.read().where(F.col("batch") == batch_id)
    tables.history.write(stored.where(~F.col("blocklist_hit")).withColumn("day", F.floor(t / DAY_MS)), batch_id)
    # an event dated after its arrival says nothing about how far the stream has come
    good.unpersist()
    tables.progress.write(stored.where(t <= F.unix_millis(F.current_timestamp())).agg(F.max(t).alias("newest_ms")), batch_id)


def start(events: DataFrame, tables: Tables, list_path: str | None, model, checkpoint: str, every: str | None = None,
          name: str | None = None, **options) -> StreamingQuery:
    """Lists are read again in every micro-batch, so an update takes effect at once."""
    spark = tables.scored.spark

    def handle(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, tables, read_lists(spark, list_path), model, **options)

    return _start(events, checkpoint, handle, every, name=name)
