"""Streams over files, each compared with its batch twin on the same rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from txnguard.operators import merge, scoring, velocity
from txnguard.plans.rules import WINDOWS, scorecard
from txnguard.schemas import ENRICHED, EVENT, EVENT_FIELDS, FEEDBACK, LIST_ENTRY, SCORED, SCORE_FIELDS
from txnguard.sources import fixtures as fx, stream as S
from txnguard.streaming import appeals, fastpath, ingest, stateful
from txnguard.streaming.sink import BatchTable, Folder, KeyedTable

DAY = fx.DAY_MS


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def write_in_order(df, path, cuts=(8, 15, 22)):
    """Four files in time order."""
    t = (F.col("event_timestamp_ms") - fx.START_MS) / DAY
    edges = [float("-inf"), *cuts, float("inf")]
    for lo, hi in zip(edges, edges[1:]):
        df.where((t >= lo) & (t < hi)).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def split(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    write_in_order(fx.transactions(spark, sf), path)
    return path


def test_fast_path_stream_equals_batch(spark, sf, split, tmp_path):
    lists = str(tmp_path / "lists")
    fx.list_entries(spark, sf).write.parquet(lists)
    tables = fastpath.Tables.at(spark, str(tmp_path / "t"))
    events = S.read_files(spark, split, EVENT, max_files=1)
    at = F.col("event_timestamp_ms") + 5
    q = fastpath.start(events, tables, lists, scorecard(), str(tmp_path / "c"), windows=WINDOWS, block_ms=DAY, scored_at=at)
    q.awaitTermination(300)
    assert q.exception() is None
    got = tables.scored.read()
    assert got.select("batch").distinct().count() == 4
    want = scoring.fast_path(fx.transactions(spark, sf), fx.list_entries(spark, sf), scorecard(), WINDOWS, block_ms=DAY, scored_at=at)
    cols = ["event_id", "decision", "blocklist_tier", "velocity_hit", "velocity_window", "velocity_reason"]
    assert rows(got, *cols) == rows(want, *cols)
    assert want.where("velocity_hit").count() > 0
    assert tables.late.read().count() == 0


def test_fast_path_without_lists_or_history_is_open(spark, sf, tmp_path):
    tables = fastpath.Tables.at(spark, str(tmp_path / "t"))
    batch = fx.transactions(spark, sf).where("cast(event_id AS int) < 20")
    fastpath.score_batch(batch, 0, tables, fastpath.read_lists(spark, str(tmp_path / "none")), scorecard())
    got = tables.scored.read()
    assert got.count() == 20 and got.where("blocklist_hit OR velocity_hit").count() == 0


def test_late_events_and_retried_batches(spark, sf, tmp_path):
    tables = fastpath.Tables.at(spark, str(tmp_path / "t"))
    tx = fx.transactions(spark, sf)
    lists = fastpath.read_lists(spark, None)
    new, old = tx.where("cast(event_id AS int) BETWEEN 500 AND 519"), tx.where("cast(event_id AS int) BETWEEN 0 AND 4")
    fastpath.score_batch(new, 0, tables, lists, scorecard())
    fastpath.score_batch(old, 1, tables, lists, scorecard())
    fastpath.score_batch(old, 1, tables, lists, scorecard())
    assert tables.late.read().count() == 5
    assert tables.scored.read().count() == 25  # late events are scored too


def test_a_far_future_event_does_not_stop_the_stream(spark, sf, tmp_path):
    tables = fastpath.Tables.at(spark, str(tmp_path / "t"))
    tx = fx.transactions(spark, sf)
    lists = fastpath.read_lists(spark, None)
    future = tx.where("event_id = '7'").withColumn("event_timestamp_ms", F.lit(4_102_444_800_000))
    fastpath.score_batch(future, 0, tables, lists, scorecard())
    fastpath.score_batch(tx.where("cast(event_id AS int) BETWEEN 500 AND 519"), 1, tables, lists, scorecard())
    assert tables.scored.read().where("batch = 1").count() == 20


def test_records_of_unknown_topics_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("nobody", "x", 1), (None, "y", 2)], "topic string, value string, arrival long").write.parquet(str(tmp_path / "in" / "a"))
    raw = spark.readStream.schema("topic string, value string, arrival long").parquet(str(tmp_path / "in" / "a"))
    bad = BatchTable(spark, str(tmp_path / "bad"), T.StructType([T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())]))
    ingest.route(raw, {}, bad, str(tmp_path / "c"), every=None).awaitTermination()
    kept = BatchTable(spark, f"{bad.path}/other", bad.schema).read()
    assert sorted(r["value"] for r in kept.collect()) == ["x", "y"]


def test_restart_from_checkpoint_reads_only_new_files(spark, sf, tmp_path):
    src, tables = str(tmp_path / "in"), fastpath.Tables.at(spark, str(tmp_path / "t"))
    tx = fx.transactions(spark, sf)

    def run():
        q = fastpath.start(S.read_files(spark, src, EVENT), tables, None, scorecard(), str(tmp_path / "c"))
        q.awaitTermination(300)
        assert q.exception() is None

    tx.where("cast(event_id AS int) < 50").coalesce(1).write.parquet(src)
    run()
    tx.where("cast(event_id AS int) BETWEEN 50 AND 99").coalesce(1).write.mode("append").parquet(src)
    run()
    got = tables.scored.read()
    assert got.count() == 100 and got.select("event_id").distinct().count() == 100


def test_stateful_velocity_equals_batch(spark, sf, tmp_path):
    spark.conf.set(*stateful.ROCKSDB)
    tx = fx.transactions(spark, sf)
    src = str(tmp_path / "in")
    # Out of order within a file, one repeated delivery, and a last event that moves the watermark on.
    shuffled = tx.orderBy(F.xxhash64("event_id"))
    write_in_order(shuffled.unionByName(tx.where("event_id = '7'")), src)
    last = tx.limit(1).withColumns({"event_id": F.lit("end"), "card_token": F.lit("end"), "event_timestamp_ms": F.lit(fx.START_MS + 90 * DAY)})
    last.coalesce(1).write.mode("append").parquet(src)
    events = ingest.deduplicated(S.read_files(spark, src, EVENT, max_files=1), delay="1 day")
    out = stateful.velocity_stream(events, WINDOWS)
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(str(tmp_path / "out")).where("event_id <> 'end'")
    cols = ["event_id", "velocity_hit", "velocity_window", "velocity_reason"]
    assert rows(got, *cols) == rows(velocity.check(tx, WINDOWS, block_ms=DAY), *cols)


def test_reach_of_time_blocks():
    windows = [("1min", 60, 2), ("10min", 600, 3), ("60min", 3600, 4)]
    for block in (1_000, 7_000, 60_000, 900_000, 3_600_000, 10_000_000):
        reach = stateful.Reach(windows, block)
        for d in range(1, reach.blocks + 3):
            far = [(d - 1) * block + 1, (d + 1) * block - 1]  # of an event in a block d earlier, least and most
            modes = [all(x <= back for x in far) if all(x <= back for x in far) or not any(x <= back for x in far) else None for _, back, _ in reach.windows]
            assert reach.inside(d) == (None if None in modes else modes)
            assert d <= reach.blocks or reach.inside(d) == [False] * 3


@pytest.mark.parametrize("block_days", [2])
def test_a_hot_card_is_split_by_time(spark, sf, tmp_path, block_days):
    """One card has nine tenths of the rows, which are judged in many tasks."""
    spark.conf.set(*stateful.ROCKSDB)
    src = str(tmp_path / "in")
    tx = fx.transactions(spark, sf).withColumn("card_token", F.when(F.col("event_id").cast("int") % 10 > 0, "hot").otherwise(F.col("card_token")))
    write_in_order(tx, src)
    end = tx.limit(1).withColumns({"event_id": F.lit("end"), "card_token": F.lit("end"), "event_timestamp_ms": F.lit(fx.START_MS + 150 * DAY)})
    end.coalesce(1).write.mode("append").parquet(src)
    windows = [("1min", 86_400, 20), ("10min", 10 * 86_400, 250), ("60min", 60 * 86_400, 700)]
    out = stateful.velocity_stream(ingest.event_time(S.read_files(spark, src, EVENT, max_files=1), delay="1 hour"), windows, block_days * DAY)
    q = (out.withColumn("task", F.spark_partition_id()).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).where("event_id <> 'end'")
    cols = ["event_id", "velocity_hit", "velocity_window", "velocity_reason"]
    want = velocity.check(tx, windows, block_ms=DAY)
    assert rows(got, *cols) == rows(want, *cols) and want.select("velocity_window").distinct().count() > 2
    assert got.where("card_token = 'hot'").select("task").distinct().count() > 1


def test_velocity_calls_python_by_lane_not_by_card(spark, tmp_path):
    """2,000 cards in two lanes; small chunks are cut and folded."""
    spark.conf.set(*stateful.ROCKSDB)
    src, shape = str(tmp_path / "in"), "event_id string, card_token string, event_timestamp_ms long"
    rng = np.random.default_rng(3)
    data = [(str(i), f"card{i % 2000}", int(fx.START_MS + rng.integers(0, 30 * DAY))) for i in range(6000)] + [("no", "", fx.START_MS), ("none", None, fx.START_MS)]
    tx = spark.createDataFrame(data, shape)
    for lo in range(0, 30, 3):  # many micro-batches, hence many chunks of a block
        day = F.floor((F.col("event_timestamp_ms") - fx.START_MS) / DAY)
        tx.where((day >= lo) & (day < lo + 3)).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([("end", "end", fx.START_MS + 150 * DAY)], shape).coalesce(1).write.mode("append").parquet(src)
    windows = [("1min", 86_400, 2), ("10min", 10 * 86_400, 3), ("60min", 20 * 86_400, 3)]
    events = S.read_files(spark, src, shape, max_files=1).withColumn("at", F.timestamp_millis("event_timestamp_ms")).withWatermark("at", "40 days")
    out = stateful.velocity_stream(events, windows, 5 * DAY, lanes=2, chunk=100)
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    keys = sum(p["numRowsTotal"] for p in q.lastProgress["stateOperators"])
    held = max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress)
    assert held < 2000 and keys < 2000  # of 2,000 cards and up to ten blocks
    got = spark.read.parquet(str(tmp_path / "out")).where("event_id <> 'end'")
    cols = ["event_id", "velocity_hit", "velocity_window", "velocity_reason"]
    want = velocity.check(tx, windows, block_ms=DAY)
    assert rows(got, *cols) == rows(want, *cols) and want.select("velocity_window").distinct().count() > 2


def test_score_cache_expires_from_first_scoring(spark, tmp_path):
    spark.conf.set(*stateful.ROCKSDB)
    schema = "event_id string, feature_hash string, event_timestamp_ms long, fraud_score double"
    data = [("a", "h", 0, 0.1), ("b", "h", 59_999, 0.2), ("c", "h", 60_000, 0.3), ("d", "h", 100_000, 0.4), ("e", "g", 1, 0.9)]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = stateful.cached_scores(S.read_files(spark, str(tmp_path / "in"), schema))
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = rows(spark.read.parquet(str(tmp_path / "out")), "event_id", "fraud_score", "cached")
    assert got == [("a", 0.1, False), ("b", 0.1, True), ("c", 0.3, False), ("d", 0.3, True), ("e", 0.9, False)]


def _payloads(spark, sf):
    scored = fx.deliveries(spark, sf).where("cast(event_id AS int) < 200")
    one = scored.select(F.lit("scored").alias("topic"), F.to_json(F.struct(*SCORED.fieldNames())).alias("value"), "arrival")
    two = fx.second_scored(spark, sf).where("cast(event_id AS int) < 100").withColumn("arrival", F.col("event_id").cast("long"))
    two = two.select(F.lit("scored.second").alias("topic"), F.to_json(F.struct(*[c for c in two.columns if c != "arrival"])).alias("value"), "arrival")
    bad = spark.createDataFrame([("scored", "{broken", 1), ("scored", "", 2), ("scored.second", "[]", 3)], "topic string, value string, arrival long")
    return one.unionByName(two).unionByName(bad)


def test_route_topics_quarantine_and_upsert(spark, sf, tmp_path):
    src = str(tmp_path / "in")
    _payloads(spark, sf).repartition(3).write.json(src)
    arrival = [T.StructField("arrival", T.LongType())]
    t1 = BatchTable(spark, str(tmp_path / "scored"), T.StructType(SCORED.fields + arrival))
    t2 = BatchTable(spark, str(tmp_path / "second"), T.StructType(SCORED.fields + arrival))
    bad = BatchTable(spark, str(tmp_path / "bad"), T.StructType([T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())]))
    stream = S.read_files(spark, src, "topic string, value string, arrival long", "json", max_files=1)
    q = ingest.route(stream, {"scored": ("scored", t1), "scored.second": ("scored", t2)}, bad, str(tmp_path / "c"), every=None)
    q.awaitTermination(300)
    assert q.exception() is None
    n_bad = sum(BatchTable(spark, f"{bad.path}/{t}", bad.schema).read().count() for t in ("scored", "scored.second"))
    assert n_bad == 3
    assert t2.read().count() == 75
    want = merge.merge_scored(fx.deliveries(spark, sf).where("cast(event_id AS int) < 200"))
    # Files arrive in any order here, so the offset alone orders deliveries.
    rows_all = t1.read()
    got = merge.merge_scored(rows_all)
    cols = ["event_id", "amount", "source_label", "decision", "scored_at_ms"]
    assert rows(got, *cols) == rows(want, *cols)


def test_compaction_keeps_the_fold(spark, sf, tmp_path):
    schema = T.StructType(SCORED.fields + [T.StructField("arrival", T.LongType())])
    log, base = BatchTable(spark, str(tmp_path / "log"), schema), BatchTable(spark, str(tmp_path / "base"), schema)
    d = fx.deliveries(spark, sf)
    log.write(d.where("arrival < 10000000"), 0)
    log.write(d.where("arrival >= 10000000"), 1)
    first, latest = [c for c in EVENT_FIELDS if c != "event_id"], SCORE_FIELDS
    log.compact(base, first, latest, "scored_at_ms", 1)
    cols = ["event_id", "amount", "source_label", "fraud_score", "scored_at_ms"]
    assert rows(base.read(), *cols) == rows(log.current(first, latest, "scored_at_ms"), *cols) == rows(merge.merge_scored(d), *cols)


def test_windows_sessions_and_drift(spark, sf, tmp_path):
    src = str(tmp_path / "in")
    write_in_order(fx.scored(spark, sf), src)
    stream = S.read_files(spark, src, SCORED, max_files=1)
    schema = T._parse_datatype_string("window_start_ms long, window_end_ms long, decision string, events long, avg_score double")
    table = BatchTable(spark, str(tmp_path / "w"), schema)
    q = ingest.upsert_windows(ingest.decision_windows(stream, "1 day"), table, str(tmp_path / "c"))
    q.awaitTermination(300)
    assert q.exception() is None
    got = ingest.latest_windows(table, ["window_start_ms", "decision"])
    want = fx.scored(spark, sf).groupBy(F.expr(f"scored_at_ms div {DAY} * {DAY}").alias("window_start_ms"), "decision").agg(F.count(F.lit(1)).alias("events"))
    assert rows(got, "window_start_ms", "decision", "events") == rows(want, "window_start_ms", "decision", "events")
    sessions = ingest.customer_sessions(fx.transactions(spark, sf), "12 hours")
    assert sessions.agg(F.sum("events")).first()[0] == fx.transactions(spark, sf).count()


def test_stream_stream_comparison(spark, sf, tmp_path):
    write_in_order(fx.scored(spark, sf), str(tmp_path / "a"))
    write_in_order(fx.second_scored(spark, sf), str(tmp_path / "b"))
    second = T.StructType([T.StructField(f, SCORED[f].dataType) for f in fx.second_scored(spark, sf).columns])
    out = ingest.compare_streams(S.read_files(spark, str(tmp_path / "a"), SCORED, max_files=1),
                                 S.read_files(spark, str(tmp_path / "b"), second, max_files=1), "10 minutes")
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.parquet(str(tmp_path / "o")).count() == fx.second_scored(spark, sf).count()


def test_bronze_to_silver(spark, sf, tmp_path):
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def odd_characters(names: pd.Series) -> pd.Series:
        return names.fillna("").str.count(r"[^a-zA-Z.\-]").astype("float64") + 3.0

    fx.scored(spark, sf).coalesce(2).write.parquet(str(tmp_path / "bronze"))
    q = ingest.bronze_to_silver(S.read_files(spark, str(tmp_path / "bronze"), SCORED), odd_characters(F.col("merchant_name")),
                                str(tmp_path / "silver"), str(tmp_path / "c"))
    q.awaitTermination(300)
    assert q.exception() is None
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert silver.count() == 1000
    assert silver.where("text_suspicious").count() == silver.where("text_anomaly_score >= 6").count() > 0


def test_appeal_reenters_and_whitelist_wins(spark, sf, tmp_path):
    """A blocked event is appealed, emitted again, and the newer verdict replaces the old one."""
    from txnguard.operators import cases, lists
    tx, entries = fx.transactions(spark, sf), fx.list_entries(spark, sf)
    first = scoring.fast_path(tx, entries, scorecard(), scored_at=F.col("event_timestamp_ms") + 5)
    victim = first.where("blocklist_tier = 'BLOCK'").orderBy("event_timestamp_ms").limit(1)
    ask = victim.selectExpr("event_id", "'n' AS appellant_name", "'customer' AS appellant_role", "'mine' AS reason", "event_timestamp_ms AS submitted_at_ms")
    parts = cases.submit_appeals(ask, first)
    merged, refused = lists.apply(entries, parts["whitelist"])
    assert refused.count() == 0 and parts["whitelist"].count() == 4
    again = scoring.fast_path(parts["reemitted"], merged, scorecard(), scored_at=F.col("event_timestamp_ms") + 99)
    rows_ = first.withColumn("arrival", F.lit(0)).unionByName(again.withColumn("arrival", F.lit(1)))
    got = merge.merge_scored(rows_).join(victim.select("event_id"), "event_id").first()
    assert got["source_label"] == "replayer"
    assert not got["blocklist_hit"] and got["blocklist_reason"].startswith("whitelist:")


def test_observed_counters(spark, sf):
    df, seen = ingest.observed(fx.scored(spark, sf))
    df.write.format("noop").mode("overwrite").save()
    got = seen.get
    assert got["events"] == 1000 and got["allow"] + got["review"] + got["block"] == 1000


def test_keyed_round_trip(spark, sf):
    s = fx.scored(spark, sf)
    back = S.decoded(S.decode(S.keyed(s), "scored"))
    assert rows(back, "event_id", "amount", "decision") == rows(s, "event_id", "amount", "decision")
    assert json.loads(S.keyed(s).first()["value"])["schema_version"] == "v1"


def test_fields_of_the_wrong_type_are_set_aside(spark):
    raw = spark.createDataFrame([('{"event_id": "a", "amount": "abc"}',), ('{"event_id": "b", "amount": 2.5}',), ('{"amount": 1}',), ("{",)], "value string")
    frame = S.decode(raw, "event")
    assert [r["event_id"] for r in S.decoded(frame).collect()] == ["b"] and S.quarantined(frame).count() == 3


def test_score_cache_forgets_old_hashes(spark, tmp_path):
    spark.conf.set(*stateful.ROCKSDB)
    schema = "event_id string, feature_hash string, event_timestamp_ms long, fraud_score double"
    for i, name in enumerate("abc"):  # the run that reads b moves the watermark past a's timer
        spark.createDataFrame([(name, "h", i, i / 10)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = stateful.cached_scores(S.read_files(spark, str(tmp_path / "in"), schema), keep_ms=0)
        (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start().awaitTermination(120))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "event_id", "cached")
    assert got == [("a", False), ("b", True), ("c", False)]


def test_keyed_table_commits_retries_and_compaction(spark, sf, tmp_path):
    d = fx.deliveries(spark, sf)
    first, cols = [c for c in EVENT_FIELDS if c != "event_id"], ["event_id", "amount", "source_label", "fraud_score", "scored_at_ms"]
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType(SCORED.fields + [T.StructField("arrival", T.LongType())]), first, SCORE_FIELDS, every=3)
    assert table.current().count() == 0
    lanes = [d.where(F.pmod(F.xxhash64("event_id", "arrival"), F.lit(8)) == k) for k in range(8)]  # in no order of arrival
    lanes[0].limit(7).write.parquet(f"{table.path}/batches/0")  # left by a batch that was lost
    assert table.current().count() == 0
    for n, part in enumerate(lanes):
        table.write(part, n)
        table.write(part.limit(3).withColumn("fraud_score", F.lit(9.0)), n)  # committed already: nothing changes
    base, after = table.committed()
    assert base == 5 and after == [6, 7]
    assert set(Folder(spark, f"{table.path}/batches").names()) == set("34567")  # those of the base before are gone
    assert rows(table.current(), *cols) == rows(merge.merge_scored(d), *cols)
    table.compact()
    assert table.committed() == (7, []) and rows(table.current(), *cols) == rows(merge.merge_scored(d), *cols)


def test_appeals_in_batches_and_their_retry(spark, sf, tmp_path):
    lists = str(tmp_path / "lists")
    fx.list_entries(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in LIST_ENTRY.fields]).write.parquet(lists)
    tables = appeals.Tables.at(spark, str(tmp_path / "t"))
    none = F.lit(None)
    tx = fx.transactions(spark, sf).withColumn("arrival", F.col("event_id").cast("long")).withColumn("emitted_at_ms", none.cast("long"))

    def batch(events=None, asks=None):
        event, ask = (tx.limit(0) if events is None else events), (spark.createDataFrame([], appeals.ASK) if asks is None else asks)
        return event.select(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in appeals.SENT.fields]).alias("event"), none.cast(appeals.ASK).alias("ask")) \
            .unionByName(ask.select(none.cast(appeals.SENT).alias("event"), F.struct(*appeals.ASK.fieldNames()).alias("ask")))
    options = {"windows": WINDOWS, "block_ms": DAY, "scored_at": F.coalesce("emitted_at_ms", "event_timestamp_ms") + 5}
    appeals.handle(batch(tx), 0, tables, lists, scorecard(), **options)
    found = tables.scored()
    blocked = found.where("blocklist_tier = 'BLOCK'").orderBy("event_id").first()["event_id"]
    allowed = found.where("decision = 'ALLOW'").orderBy("event_id").first()["event_id"]
    late = fx.START_MS + 60 * DAY
    asks = spark.createDataFrame([(blocked, "n", "customer", "mine", late), (allowed, "n", "customer", "no", late), ("nobody", "n", "analyst", "x", late),
                                  (blocked, "n", "stranger", "x", late)], appeals.ASK)
    for _ in range(2):  # a retry
        appeals.handle(batch(asks=asks), 1, tables, lists, scorecard(), **options)
    assert rows(tables.logged.read(), "event_id", "original_decision") == [(blocked, "BLOCK")]
    assert sorted(r["error"] for r in tables.refused.read().collect()) == sorted(["event was ALLOW (no appeal needed)", "event nobody not found", "role not allowed"])
    assert tables.entries.read().count() == 4 and tables.open_appeals().count() == 1
    sent = spark.read.schema(appeals.SENT).option("recursiveFileLookup", "true").parquet(tables.sent)
    assert rows(sent, "event_id", "source_label", "emitted_at_ms") == [(blocked, "appeal", late)]
    for _ in range(2):
        appeals.handle(batch(sent), 2, tables, lists, scorecard(), **options)
    got = tables.scored().where(F.col("event_id") == blocked).first()
    assert got["source_label"] == "replayer" and not got["blocklist_hit"] and got["blocklist_reason"].startswith("whitelist:") and got["scored_at_ms"] == late + 5
    assert tables.open_appeals().count() == 0 and tables.scored().count() == found.count()


def test_some_columns_of_scored_events_are_folded_alone(spark, sf, tmp_path):
    tables = appeals.Tables.at(spark, str(tmp_path / "t"))
    fx_rows = fx.deliveries(spark, sf).select(*tables.fast.scored.schema.fieldNames())
    for n in range(2):
        tables.fast.scored.write(fx_rows.where(F.col("arrival") % 2 == n), n)
    names = ["event_id", "decision", "source_label"]
    some, whole = tables.scored(names), tables.scored()
    assert some.columns == ["event_id", "source_label", "decision"] and rows(some, *names) == rows(whole, *names)
    assert "customer_id" in whole._jdf.queryExecution().executedPlan().toString() and "customer_id" not in some._jdf.queryExecution().executedPlan().toString()
