"""Appeals within the running stream.

One query reads raw events, appeals and the events that its own batches sent again. A batch scores its events with the lists as
earlier batches left them, then judges its appeals against all decisions so far: accepted ones are logged, put their event's entities
on the white list, and send the event again, which the query reads as new input of a later batch. Its new decision resolves the appeal
and replaces the old one in the latest-wins fold; what arrived first of the event stays.

Everything a batch writes is stored under its id and overwritten by a retry. A batch without accepted appeals sends nothing, so
the loop comes to rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from txnguard.operators import cases, lists, merge
from txnguard.schemas import EVENT, EVENT_FIELDS, FEEDBACK, LIST_ENTRY, SCORE_FIELDS
from txnguard.streaming import fastpath
from txnguard.streaming.ingest import _start
from txnguard.streaming.sink import BatchTable

_WHO = [FEEDBACK["event_id"], T.StructField("appellant_name", T.StringType()), T.StructField("appellant_role", T.StringType()),
        T.StructField("reason", T.StringType()), FEEDBACK["submitted_at_ms"]]
_ORIGINAL = [T.StructField("original_decision", T.StringType()), T.StructField("original_fraud_score", T.DoubleType())]
ASK = T.StructType(_WHO)
SENT = T.StructType(EVENT.fields + [T.StructField("arrival", T.LongType()), T.StructField("emitted_at_ms", T.LongType())])
LOGGED = T.StructType(_WHO + _ORIGINAL)
REFUSED = T.StructType([_WHO[0], _WHO[2], T.StructField("error", T.StringType())])
RESOLVED = T.StructType([_WHO[0], T.StructField("resolved_at_ms", T.LongType()), T.StructField("final_decision", T.StringType()),
                         T.StructField("final_fraud_score", T.DoubleType())])


@dataclass
class Tables:
    fast: fastpath.Tables
    entries: BatchTable
    logged: BatchTable
    refused: BatchTable
    resolved: BatchTable
    sent: str

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> "Tables":
        sent = f"{root}/sent"
        spark.createDataFrame([], SENT).write.mode("overwrite").parquet(f"{sent}/start")  # a source needs its folder
        return cls(fastpath.Tables.at(spark, root), BatchTable(spark, f"{root}/entries", LIST_ENTRY), BatchTable(spark, f"{root}/appeals", LOGGED),
                   BatchTable(spark, f"{root}/refused", REFUSED), BatchTable(spark, f"{root}/resolved", RESOLVED), sent)

    def scored(self, columns: list[str] | None = None) -> DataFrame:
        """One row per event: as it first arrived, with its newest decision. Of ``columns`` only, if given: no others are shuffled."""
        first, latest = ([c for c in fields if c != "event_id" and (columns is None or c in columns)] for fields in (EVENT_FIELDS, SCORE_FIELDS))
        return merge.latest_wins(self.fast.scored.read().withColumn("_at", F.struct("batch", "arrival")), first, latest, arrival="_at")

    def open_appeals(self) -> DataFrame:
        """Accepted appeals whose event was not scored again after they were submitted."""
        done = self.resolved.read().groupBy("event_id").agg(F.max("resolved_at_ms").alias("until"))
        return self.logged.read().drop("batch").join(done, "event_id", "left").where("until IS NULL OR until < submitted_at_ms").drop("until")


def stream(events: DataFrame, asks: DataFrame, tables: Tables) -> DataFrame:
    """The three inputs as one stream of (event, ask), one of them null. ``events``: event fields and, if there is one, arrival."""
    spark = events.sparkSession
    again = spark.readStream.schema(SENT).option("recursiveFileLookup", "true").parquet(tables.sent)

    def side(df: DataFrame) -> DataFrame:
        have = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SENT.fields]
        return df.select(F.struct(*have).alias("event"), F.lit(None).cast(ASK).alias("ask"))
    asked = asks.select(F.lit(None).cast(SENT).alias("event"), F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ASK.fields]).alias("ask"))
    return side(events).unionByName(side(again)).unionByName(asked)


def handle(batch: DataFrame, batch_id: int, tables: Tables, list_path: str | None, model, **options) -> None:
    spark = tables.fast.scored.spark
    current = lists.upsert(fastpath.read_lists(spark, list_path), tables.entries.read(before=batch_id))
    events = batch.where("event IS NOT NULL").select("event.*").withColumn("arrival", F.coalesce("arrival", F.xxhash64("event_id")))
    fastpath.score_batch(events, batch_id, tables.fast, current, model, **options)

    again = events.where("emitted_at_ms IS NOT NULL").select("event_id").distinct()
    own = tables.fast.scored.read().where(F.col("batch") == batch_id)
    tables.resolved.write(own.join(again, "event_id", "left_semi").select(
        "event_id", F.col("scored_at_ms").alias("resolved_at_ms"), F.col("decision").alias("final_decision"), F.col("fraud_score").alias("final_fraud_score")), batch_id)

    asks = batch.where("ask IS NOT NULL").select("ask.*")
    if asks.isEmpty():
        return
    met = tables.fast.scored.read(before=batch_id + 1).join(asks.select("event_id").distinct(), "event_id", "left_semi")
    known = merge.latest_wins(met.withColumn("_at", F.struct("batch", "arrival")), [c for c in EVENT_FIELDS if c != "event_id"], SCORE_FIELDS, arrival="_at")
    judged = cases.submit_appeals(asks, known)
    tables.logged.write(judged["accepted"], batch_id)
    tables.refused.write(judged["rejected"], batch_id)
    tables.entries.write(judged["whitelist"], batch_id)
    times = judged["accepted"].groupBy("event_id").agg(F.max("submitted_at_ms").alias("emitted_at_ms"))
    sent = judged["reemitted"].join(times, "event_id").withColumn("arrival", F.lit(batch_id).cast("long")).select(*SENT.fieldNames())
    if not sent.isEmpty():
        sent.write.mode("overwrite").parquet(f"{tables.sent}/{batch_id}")


def start(events: DataFrame, asks: DataFrame, tables: Tables, list_path: str | None, model, checkpoint: str,
          every: str = "2 seconds", **options) -> StreamingQuery:
    """The loop needs a query that goes on: what a batch sends is input of a later one."""
    return _start(stream(events, asks, tables), checkpoint, lambda batch, n: handle(batch, n, tables, list_path, model, **options), every)
