"""Queries that drain a stream over the events table and return what it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from txnguard.durable import scratch_root
from txnguard.functions import scalars as X
from txnguard.operators import text
from txnguard.plans import slow
from txnguard.plans.registry import ORACLES, query
from txnguard.plans.rules import WINDOWS, _scored_at, scorecard
from txnguard.plans.sql_base import SCORE1, decide, oracle
from txnguard.schemas import EVENT, EVENT_FIELDS, LIST_ENTRY, SCORED, SCORE_FIELDS
from txnguard.sources import fixtures as fx, stream as S
from txnguard.streaming import appeals, counters, fastpath, ingest, stateful
from txnguard.streaming.sink import BatchTable, Folder, KeyedTable

_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark, d) -> DataFrame:
    return fx.base_of(S.read_files(spark, d, _EVENTS, glob="events.parquet"))


@contextmanager
def few_state_partitions(spark):
    """A local run needs no more state stores than cores; a cluster keeps its own setting."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def finish(spark, start: Callable[[], StreamingQuery]) -> None:
    """Run a query to the end of its input."""
    with few_state_partitions(spark):
        start().awaitTermination()


def place(spark) -> str:
    return f"{scratch_root(spark).rstrip('/')}/txnguard/stream-{uuid.uuid4().hex}"


def drain(df: DataFrame, root: str, mode: str = "append") -> DataFrame:
    """Write everything available and read it back."""
    writer = (df.writeStream.format("parquet").outputMode(mode).option("path", f"{root}/out")
              .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True))
    finish(df.sparkSession, writer.start)
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/out")


def drained_to_the_end(spark, d, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``build`` over the events, then send a closing event that moves the watermark past the last of them."""
    root, batch = place(spark), fx.transactions(spark, d)
    batch.limit(0).write.parquet(f"{root}/closing")
    tx = fx.with_event_columns(events(spark, d)).select(*EVENT_FIELDS)
    out = build(tx.unionByName(S.read_files(spark, f"{root}/closing", tx.schema)))
    drain(out, root)
    end = batch.agg(F.max("event_timestamp_ms")).scalar() + 4 * 3_600_000
    names = {c: F.lit("end") for c in ("event_id", "card_token", "customer_id")}
    batch.limit(1).withColumns(names | {"event_timestamp_ms": end}).write.mode("append").parquet(f"{root}/closing")
    return drain(out, root)


@query("i2_stream_dedup", oracle("SELECT event_id, event_timestamp_ms, customer_id FROM tx", "tx"))
def dedup(spark, d) -> DataFrame:
    """Every event delivered twice, kept once within the watermark."""
    tx = fx.with_event_columns(events(spark, d)).select(*EVENT_FIELDS)
    once = ingest.deduplicated(tx.unionByName(tx), delay="1 hour")
    return drain(once.select("event_id", "event_timestamp_ms", "customer_id"), place(spark))


@query("i4_stream_decision_windows", oracle("""SELECT scored_at_ms // 3600000 * 3600000 AS window_start_ms, scored_at_ms // 3600000 * 3600000 + 3600000 AS window_end_ms, decision,
  count(*) AS events, avg(fraud_score) AS avg_score FROM sc GROUP BY ALL""", "sc"), "avg_score", digits=3)
def windows(spark, d) -> DataFrame:
    root = place(spark)
    out = ingest.decision_windows(fx.scored_of(events(spark, d)))
    table = BatchTable(spark, f"{root}/windows", out.schema)
    finish(spark, lambda: ingest.upsert_windows(out, table, f"{root}/checkpoint"))
    return ingest.latest_windows(table, ["window_start_ms", "window_end_ms", "decision"])


@query("i4_stream_sliding_windows", oracle("""SELECT s AS window_start_ms, s + 7200000 AS window_end_ms, decision, count(*) AS events, avg(fraud_score) AS avg_score
  FROM (SELECT *, unnest([scored_at_ms // 3600000 * 3600000, scored_at_ms // 3600000 * 3600000 - 3600000]) AS s FROM sc) GROUP BY ALL""", "sc"), "avg_score", digits=3)
def sliding(spark, d) -> DataFrame:
    root = place(spark)
    out = ingest.decision_windows(fx.scored_of(events(spark, d)), "2 hours", "1 hour")
    table = BatchTable(spark, f"{root}/windows", out.schema)
    finish(spark, lambda: ingest.upsert_windows(out, table, f"{root}/checkpoint"))
    return ingest.latest_windows(table, ["window_start_ms", "window_end_ms", "decision"])


@query("i4_customer_sessions", oracle("""SELECT customer_id, min(event_timestamp_ms) AS start_ms, max(event_timestamp_ms) + 7200000 AS end_ms, count(*) AS events, sum(amount) AS amount FROM (
  SELECT *, sum(CASE WHEN prev IS NULL OR event_timestamp_ms - prev >= 7200000 THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY event_timestamp_ms, event_id::BIGINT) AS s
  FROM (SELECT *, lag(event_timestamp_ms) OVER (PARTITION BY customer_id ORDER BY event_timestamp_ms, event_id::BIGINT) AS prev FROM tx)) GROUP BY customer_id, s""", "tx"), "amount", digits=2)
def sessions(spark, d) -> DataFrame:
    """Sessions are stored once the watermark has passed their end."""
    return drained_to_the_end(spark, d, lambda tx: ingest.customer_sessions(tx, "2 hours", "1 hour")).where("customer_id <> 'end'")


@query("i4_stream_drift_windows", oracle("""SELECT w AS window_start_ms, count(*) AS compared, count(*) FILTER (WHERE NOT decisions_agree) AS disagreements,
  count(*) FILTER (WHERE NOT decisions_agree) / count(*) AS rate, count(*) FILTER (WHERE NOT decisions_agree) / count(*) > 0.05 AS alarm_fired
  FROM (SELECT *, scored_at_ms // 3600000 * 3600000 AS w FROM cmp) GROUP BY w""", "cmp"), "rate", digits=4)
def drift_stream(spark, d) -> DataFrame:
    """The comparison stream's output, read as a stream again, gives drift per window."""
    root = place(spark)
    compared = ingest.compare_streams(fx.scored_of(events(spark, d)), fx.second_of(events(spark, d)))
    drain(compared, root)
    out = ingest.drift_windows(S.read_files(spark, f"{root}/out", compared.schema))
    table = BatchTable(spark, f"{root}/windows", out.schema)
    finish(spark, lambda: ingest.upsert_windows(out, table, f"{root}/windows-checkpoint"))
    return ingest.latest_windows(table, ["window_start_ms"])


def feed(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> None:
    """Add files to ``root/in`` in one step: a running query sees all of them or none."""
    df.write.format(fmt).save(f"{root}/staging/{name}")
    Folder(df.sparkSession, f"{root}/in").take(f"{root}/staging/{name}", name)


#: Days after the first at which the input is cut into files that arrive one after another.
CUTS = (6, 12, 18, 24)


def slices(df: DataFrame) -> list[DataFrame]:
    """Rows in order of event time, a file's worth each; from the second on, a tenth of the one before comes again."""
    edges = [None, *[fx.START_MS + c * fx.DAY_MS for c in CUTS], None]
    t = F.col("event_timestamp_ms")
    parts = [df.where((F.lit(True) if lo is None else t >= lo) & (F.lit(True) if hi is None else t < hi)) for lo, hi in zip(edges, edges[1:])]
    again = [p.where(F.col("arrival") % 10 == 0).withColumn("arrival", F.col("arrival") + 10_000_000) for p in parts]
    return [parts[0]] + [p.unionByName(a) for p, a in zip(parts[1:], again)]


def listed(spark, d, root: str) -> str:
    fx.list_entries(spark, d).select(*[F.col(f.name).cast(f.dataType) for f in LIST_ENTRY.fields]).write.parquet(f"{root}/lists")
    return f"{root}/lists"


ARRIVING = T.StructType(EVENT.fields + [T.StructField("arrival", T.LongType())])


def arriving(spark, d) -> DataFrame:
    """Events with their place in the source."""
    return fx.with_event_columns(fx.base(spark, d)).select(*[F.col(f.name).cast(f.dataType) for f in EVENT.fields], F.col("id").alias("arrival"))


@query("i5_stream_fast_path", oracle("SELECT event_id, decision, fraud_score, blocklist_tier, blocklist_reason, velocity_window, velocity_reason, scored_at_ms FROM fast", "fast"), "fraud_score")
def fast_stream(spark, d) -> DataFrame:
    """Five micro-batches by a timed trigger, a tenth of each delivered again in the next; lists read per micro-batch, history from
    the table, idempotent writes, the latest-wins fold."""
    root, at = place(spark), _scored_at()
    path, tables = listed(spark, d, root), fastpath.Tables.at(spark, root)
    parts = slices(arriving(spark, d))
    feed(parts[0], root, "0")
    with few_state_partitions(spark):
        source = S.read_files(spark, f"{root}/in", ARRIVING, nested=True)
        q = fastpath.start(source, tables, path, scorecard(), f"{root}/checkpoint", every="100 milliseconds", windows=WINDOWS,
                           block_ms=fx.DAY_MS, scored_at=at[0], latency=at[1])
        q.processAllAvailable()
        for i, part in enumerate(parts[1:], 1):
            feed(part, root, str(i))
            q.processAllAvailable()
        q.stop()
    latest = ["decision", "fraud_score", "blocklist_tier", "blocklist_reason", "velocity_window", "velocity_reason", "scored_at_ms"]
    return tables.scored.current(["amount"], latest, "scored_at_ms").select("event_id", *latest)


@query("i7_keyed_sink", ORACLES["a8_latest_wins"], digits=10)
def keyed_sink(spark, d) -> DataFrame:
    """Scored records as keyed payloads with their offsets, in seven deliveries to a timed query; one batch fails after it
    has written and before it commits, and the query starts again. The table is compacted while it runs."""
    root = place(spark)
    records = S.keyed(fx.deliveries(spark, d), keep=["arrival"])
    lanes = [records.where((F.col("arrival") < 10_000_000) & (F.col("arrival") % 5 == k)) for k in range(5)]
    late = [records.where((F.col("arrival") >= 10_000_000) & (F.col("arrival") % 20 == 10 * k)) for k in range(2)]
    shape = T.StructType(SCORED.fields + [T.StructField("arrival", T.LongType())])
    table = KeyedTable(spark, f"{root}/table", shape, [c for c in EVENT_FIELDS if c != "event_id"], SCORE_FIELDS, every=3)
    failed: list[int] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = S.decoded(S.decode(batch, "scored"), ["arrival"])
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            rows.limit(1).write.parquet(f"{table.path}/batches/2")  # a part of the batch, without its commit
            raise RuntimeError("lost on the way")
        table.write(rows, batch_id)

    def run() -> StreamingQuery:
        source = S.read_files(spark, f"{root}/in", "key string, value string, arrival long", "json", nested=True)
        return ingest._start(source, f"{root}/checkpoint", handle, "100 milliseconds")

    with few_state_partitions(spark):
        feed(lanes[0], root, "0", "json")
        q = run()
        for i, part in enumerate([*lanes[1:], *late], 1):
            try:
                q.processAllAvailable()
            except StreamingQueryException:
                q = run()  # from the checkpoint, with the same batch
                q.processAllAvailable()
            feed(part, root, str(i), "json")
        q.processAllAvailable()
        q.stop()
    if failed != [2]:
        raise RuntimeError("the batch that was to fail did not")
    return table.current()


_ASKED = 7
_SUBMITTED = fx.START_MS + 60 * fx.DAY_MS
_AGAIN = [f"n_{w} >= {t}" for w, _, t in WINDOWS]


@query("i9_appeal_loop", oracle(f"""SELECT f.event_id, coalesce(a.decision, f.decision) AS decision, coalesce(a.fraud_score, f.fraud_score) AS fraud_score,
  CASE WHEN a.event_id IS NULL THEN f.blocklist_tier ELSE 'NONE' END AS blocklist_tier, coalesce(a.why, f.blocklist_reason) AS blocklist_reason,
  coalesce(a.velocity_window, f.velocity_window) AS velocity_window, f.source_label, CASE WHEN a.event_id IS NOT NULL THEN f.decision END AS original_decision,
  a.decision AS final_decision
  FROM fast f LEFT JOIN (
    SELECT event_id, CASE WHEN hit THEN 'REVIEW' ELSE {decide('score')} END AS decision, CASE WHEN hit THEN 0.5 ELSE score END::DOUBLE AS fraud_score,
      CASE {' '.join(f"WHEN {h} THEN '{w}'" for h, (w, _, _t) in zip(_AGAIN, WINDOWS))} ELSE '' END AS velocity_window, 'whitelist:card=' || substr(card_token, 1, 12) AS why
    FROM (SELECT *, ({' OR '.join(_AGAIN)}) AS hit, {SCORE1} AS score FROM (
      SELECT *, {', '.join(f"count(*) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN {s * 1000 - (1 if w == '60min' else 0)} PRECEDING AND CURRENT ROW) AS n_{w}" for w, s, _ in WINDOWS)}
      FROM fast WHERE NOT blocklist_hit OR (event_id::BIGINT % {_ASKED} = 0 AND decision <> 'ALLOW')))
    WHERE event_id::BIGINT % {_ASKED} = 0 AND decision <> 'ALLOW') a USING (event_id)""", "fast"), "fraud_score")
def appeal_loop(spark, d) -> DataFrame:
    """Decisions of a running stream are appealed; accepted ones come back into it, whitelisted, in a later batch."""
    root = place(spark)
    path, tables = listed(spark, d, root), appeals.Tables.at(spark, root)
    at = F.coalesce("emitted_at_ms", "event_timestamp_ms") + 5 + F.col("event_id").cast("long") % 97
    tx = arriving(spark, d)
    half = fx.START_MS + 15 * fx.DAY_MS
    feed(tx.where(F.col("event_timestamp_ms") < half), root, "0")
    spark.createDataFrame([], appeals.ASK).write.parquet(f"{root}/asks/start")
    with few_state_partitions(spark):
        q = appeals.start(S.read_files(spark, f"{root}/in", ARRIVING, nested=True), S.read_files(spark, f"{root}/asks", appeals.ASK, nested=True), tables, path,
                          scorecard(), f"{root}/checkpoint", every="100 milliseconds", windows=WINDOWS, block_ms=fx.DAY_MS, scored_at=at)
        q.processAllAvailable()
        feed(tx.where(F.col("event_timestamp_ms") >= half), root, "1")
        q.processAllAvailable()
        asks = tx.where(F.col("arrival") % _ASKED == 0).select("event_id", F.lit("n").alias("appellant_name"), F.lit("customer").alias("appellant_role"),
                                                               F.lit("mine").alias("reason"), F.lit(_SUBMITTED).alias("submitted_at_ms"))
        asks.write.parquet(f"{root}/staging/asks")
        Folder(spark, f"{root}/asks").take(f"{root}/staging/asks", "1")
        q.processAllAvailable()  # judges the appeals and scores what they send
        q.stop()
    before = tables.logged.read().select("event_id", "original_decision")
    after = tables.resolved.read().select("event_id", "final_decision")
    shown = ["event_id", "decision", "fraud_score", "blocklist_tier", "blocklist_reason", "velocity_window", "source_label"]
    return tables.scored(shown).select(*shown) \
        .join(before, "event_id", "left").join(after, "event_id", "left")


@query("i3_stream_velocity", oracle(f"""SELECT event_id, {' OR '.join(f'n_{w} >= {t}' for w, _, t in WINDOWS)} AS velocity_hit FROM (SELECT event_id, event_timestamp_ms,
  {', '.join(f"count(*) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN {s * 1000 - (1 if w == '60min' else 0)} PRECEDING AND CURRENT ROW) AS n_{w}" for w, s, _ in WINDOWS)} FROM tx)""", "tx"))
def velocity(spark, d) -> DataFrame:
    """State by card and block of five days, with carried totals, judged as the watermark passes; a closing event, which arrives
    when all others are read, moves it past the last of them."""
    spark.conf.set(*stateful.ROCKSDB)
    return drained_to_the_end(spark, d, lambda tx: stateful.velocity_stream(ingest.event_time(tx, delay="1 hour"), WINDOWS, 5 * fx.DAY_MS)) \
        .where("event_id <> 'end'").select("event_id", "velocity_hit")


@query("c12_stream_comparison", oracle("SELECT event_id, first_decision, second_decision, decisions_agree, score_diff FROM cmp", "cmp"), "score_diff", digits=8)
def comparison(spark, d) -> DataFrame:
    out = ingest.compare_streams(fx.scored_of(events(spark, d)), fx.second_of(events(spark, d)))
    return drain(out, place(spark)).drop("scored_at_ms")


@query("a5_stream_routing", oracle("""SELECT 'scored' AS topic, count(*) FILTER (WHERE id % 17 <> 0) AS stored, count(*) FILTER (WHERE id % 17 = 0) AS quarantined FROM scf WHERE id % 2 = 0
  UNION ALL SELECT 'scored.second', count(*) FILTER (WHERE id % 17 <> 0), count(*) FILTER (WHERE id % 17 = 0) FROM scf WHERE id % 2 = 1""", "scf"))
def routing(spark, d) -> DataFrame:
    """One source, two topics, broken payloads set aside and counted."""
    root = place(spark)
    s = fx.scored_of(events(spark, d))
    payload = F.to_json(F.struct(*SCORED.fieldNames()))
    raw = s.select(F.when(F.col("id") % 2 == 0, "scored").otherwise("scored.second").alias("topic"),
                   F.when(F.col("id") % 17 == 0, "{broken").otherwise(payload).alias("value"), F.col("id").alias("arrival"))
    shape = T.StructType(SCORED.fields + [T.StructField("arrival", T.LongType())])
    tables = {t: BatchTable(spark, f"{root}/{t}", shape) for t in ("scored", "scored.second")}
    bad = BatchTable(spark, f"{root}/bad", T.StructType([T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())]))
    ingest.route(raw, {t: ("scored", b) for t, b in tables.items()}, bad, f"{root}/checkpoint", every=None).awaitTermination()
    parts = []
    for t, table in tables.items():
        parts.append(table.read().select(F.lit(t).alias("topic"), F.lit(1).alias("ok")))
        parts.append(BatchTable(spark, f"{root}/bad/{t}", bad.schema).read().select("topic", F.lit(0).alias("ok")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("topic").agg(F.sum("ok").alias("stored"), F.count_if(F.col("ok") == 0).alias("quarantined"))


@query("a11_bronze_to_silver", oracle("SELECT event_id, text_anomaly_score, text_anomaly_score >= 6 AS text_suspicious FROM (SELECT event_id, length(merchant_name)::DOUBLE / 3 AS text_anomaly_score FROM sc)", "sc"), "text_anomaly_score")
def silver(spark, d) -> DataFrame:
    """Append scored text and its flag; the scorer here is an expression."""
    root = place(spark)
    bronze = fx.scored_of(events(spark, d)).select("event_id", "merchant_name")
    ingest.bronze_to_silver(bronze, F.length("merchant_name").cast("double") / 3, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/silver").select("event_id", "text_anomaly_score", "text_suspicious")


@query("a11_silver_text_model", oracle("SELECT event_id, log_perplexity, text_anomaly_score, text_anomaly_label = 'SUSPICIOUS' AS text_suspicious FROM txt", "txt"), "log_perplexity text_anomaly_score")
def silver_model(spark, d) -> DataFrame:
    """The trigram model as a worker-held scorer in the bronze-to-silver stream; the same scores as by joins."""
    root = place(spark)
    bronze = fx.scored_of(events(spark, d)).select("event_id", X.text_domain("merchant_name").alias("domain_text"))
    scorer = text.worker_scorer(slow.model(spark, d))
    ingest.bronze_to_silver_text(bronze, scorer(F.col("domain_text")), f"{root}/silver", f"{root}/checkpoint", slow.SUSPICIOUS).awaitTermination()
    return spark.read.parquet(f"{root}/silver").select("event_id", "log_perplexity", "text_anomaly_score", "text_suspicious")


@query("d41_run_counters_stream", oracle("""SELECT 2 AS batches, (SELECT count(*) FROM tx) + count(*) FILTER (WHERE event_id::BIGINT % 17 = 0) AS consumed, count(*) FILTER (WHERE event_id::BIGINT % 17 = 0) AS decode_failures,
  count(*) AS produced, 0 AS score_failures, count(*) FILTER (WHERE decision = 'ALLOW') AS allow, count(*) FILTER (WHERE decision = 'REVIEW') AS review, count(*) FILTER (WHERE decision = 'BLOCK') AS block,
  count(*) FILTER (WHERE blocklist_tier = 'BLOCK') AS list_hits, count(*) FILTER (WHERE blocklist_tier = 'HOT') AS hot_hits, count(*) FILTER (WHERE velocity_hit) AS velocity_hits,
  avg(scoring_latency_ms) AS avg_latency_ms, max(scoring_latency_ms) AS max_latency_ms, true AS timed FROM fast""", "fast"), "avg_latency_ms")
def stream_counters(spark, d) -> DataFrame:
    """Two timed micro-batches of payloads, some broken, through the fast path; counts from its listener and its table."""
    root, (at, latency) = place(spark), _scored_at()
    path, tables, name = listed(spark, d, root), fastpath.Tables.at(spark, root), f"run-{uuid.uuid4().hex}"
    tx = arriving(spark, d)
    half = fx.START_MS + 15 * fx.DAY_MS
    sent = S.keyed(tx.withColumn("at", F.col("event_timestamp_ms")), keep=["arrival", "at"])
    sent = sent.unionByName(sent.where(F.col("arrival") % 17 == 0).withColumn("value", F.lit("{broken")))
    progress = counters.Progress(spark, name, BatchTable(spark, f"{root}/progress-rows", counters.PROGRESS))
    spark.streams.addListener(progress)
    try:
        with few_state_partitions(spark):
            feed(sent.where(F.col("at") < half).drop("at"), root, "0", "json")
            raw = S.read_files(spark, f"{root}/in", "key string, value string, arrival long", "json", nested=True)
            rows = counters.decoded(raw, "event", ["arrival"])
            q = fastpath.start(rows, tables, path, scorecard(), f"{root}/checkpoint", every="100 milliseconds", name=name, windows=WINDOWS,
                               block_ms=fx.DAY_MS, scored_at=at, latency=latency)
            q.processAllAvailable()
            feed(sent.where(F.col("at") >= half).drop("at"), root, "1", "json")
            q.processAllAvailable()
            q.stop()
        counters.heard(spark)
    finally:
        spark.streams.removeListener(progress)
    out = counters.run_counters(progress.table.read(), tables.scored.read())
    return out.withColumn("timed", (F.col("elapsed_s") > 0) & (F.col("events_per_second") > 0)).drop("elapsed_s", "events_per_second")


@query("d41_run_counters", oracle("""SELECT count(*) AS events, count(*) FILTER (WHERE decision = 'ALLOW') AS allow, count(*) FILTER (WHERE decision = 'REVIEW') AS review, count(*) FILTER (WHERE decision = 'BLOCK') AS block,
  count(*) FILTER (WHERE blocklist_hit) AS list_hits, count(*) FILTER (WHERE velocity_hit) AS velocity_hits, avg(scoring_latency_ms) AS avg_latency_ms, max(scoring_latency_ms) AS max_latency_ms FROM sc""", "sc"), "avg_latency_ms")
def observed_counters(spark, d) -> DataFrame:
    """Counters observed while the batch is written."""
    df, seen = ingest.observed(fx.scored(spark, d), f"run-{uuid.uuid4().hex}")
    df.write.format("noop").mode("overwrite").save()
    row = seen.get  # one row of metrics
    types = {"avg_latency_ms": "double"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {types.get(k, 'long')}" for k in row))
