"""Hand-made rows for the edges, and brute force for the operators SQL is too slow for."""

import math
import random

import numpy as np
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txnguard import constants as K, schemas
from txnguard.functions import scalars as X
from txnguard.operators import analytics, cases, evaluate, explain, features, joins, lists, merge, patterns, prefix, quality, rolling, scoring, velocity
from txnguard.operators.timeline import totals_before, trailing_totals
from txnguard.sources import files, fixtures as fx

HOUR = 3_600_000


def one(spark, *exprs):
    return spark.range(1).select(*exprs).first()


def event(i, card="c", ms=0, **over):
    base = dict(event_id=str(i), event_timestamp_ms=ms, customer_id="u", card_token=card, amount=1.0, currency="USD", amount_fx_normalised=1.0,
                merchant_id_hash="m", merchant_name="W-MERCHANT-gmail.com", mcc="5411", merchant_country="US", ip_address_hash="i",
                device_fingerprint_hash="d", geo_distance_km=0.0, source_label="test", schema_version="v1")
    return tuple((base | over)[f] for f in schemas.EVENT_FIELDS)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT)


# --- running totals --------------------------------------------------------------

def test_running_totals_with_a_hot_key(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.7 else f"k{i % 5}", i, random.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, at long, v long")
    got = {(r["k"], r["at"]): (r["cum_v"], r["prev_at"]) for r in
           prefix.running_totals(df, ["k"], [F.col("at")], ["v"], previous=["at"], partitions=7).collect()}
    total, last = defaultdict(int), {}
    for k, at, v in sorted(data, key=lambda r: r[1]):
        total[k] += v
        assert got[(k, at)] == (total[k], last.get(k))
        last[k] = at


def test_quantiles_and_nearest_rank(spark):
    df = spark.createDataFrame([(float(v),) for v in [10, 20, 30, 40, 50]], "v double")
    assert prefix.exact_quantiles(df, "v", [0.5, 0.95]).first()[1:] == pytest.approx((30.0, 48.0))
    assert prefix.nearest_rank(df, "v", [50]).first()[0] == 30.0


@pytest.mark.parametrize("seed", [3, 4])
def test_trailing_totals_against_brute_force(spark, seed):
    random.seed(seed)
    data = [("hot" if random.random() < 0.6 else f"k{random.randint(0, 3)}", random.randint(0, 8 * HOUR)) for _ in range(800)]
    data += [("hot", 5 * HOUR)] * 4
    df = spark.createDataFrame(data, "k string, ms long")
    windows = {"a": (60_000, 0), "b": (HOUR - 1, 0), "c": (2 * HOUR, 1)}
    got = trailing_totals(df, "k", "ms", {"n": F.lit(1)}, windows, block_ms=HOUR)
    for r in got.collect():
        same = [m for k, m in data if k == r["k"]]
        for w, (back, upto) in windows.items():
            assert r[f"n_{w}"] == sum(r["ms"] - back <= m <= r["ms"] - upto for m in same)


def test_totals_before(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("a", HOUR + 7, 1), ("a", 9 * HOUR, 2), ("b", 3, 1)], "k string, ms long, v long")
    got = {(r["k"], r["ms"]): (r["prev_ms"], r["before_v"]) for r in totals_before(df, "k", "ms", {"v": F.col("v")}).collect()}
    assert got == {("a", 1): (None, 0), ("a", HOUR + 7): (1, 11), ("a", 9 * HOUR): (HOUR + 7, 12), ("b", 3): (None, 0)}


def test_rolling_percentiles_across_chunks(spark):
    random.seed(5)
    values = [random.randint(1, 200) for _ in range(300)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, i long, v long")
    got = {r["i"]: r["p95"] for r in rolling.rolling_percentiles(df, "k", ["i"], "v", last=20, chunk=50).collect()}
    for i in range(300):
        window = sorted(values[max(0, i - 19):i + 1])
        assert got[i] == window[round(0.95 * (len(window) - 1))]


def test_rolling_percentiles_of_long_frames_and_odd_values(spark):
    rng = random.Random(6)
    odd = [None, float("nan"), float("inf"), -1.5, 0.0, 2.0, 2.0]
    values = [rng.choice(odd) for _ in range(120)]
    rows = [("s", i, v) for i, v in enumerate(values)] + [("none", i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    for last, chunk in ((30, 7), (1, 50), (500, 40)):  # a frame longer than the chunk, of one row, of everything
        got = {(r["k"], r["i"]): r for r in rolling.rolling_percentiles(df, "k", ["i"], "v", last=last, chunk=chunk).collect()}
        assert len(got) == len(rows)
        for i in range(120):
            window = sorted((v for v in values[max(0, i - last + 1):i + 1] if v is not None), key=lambda v: (v != v, v))
            for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
                want = window[round(p * (len(window) - 1))] if window else None
                assert got["s", i][name] == want or want != want and got["s", i][name] != got["s", i][name]
        assert all(got["none", i]["p50"] is None and got["none", i]["slo_ok"] is None for i in range(3))
    assert rolling.rolling_percentiles(df.limit(0), "k", ["i"], "v").count() == 0


def test_salted_and_broadcast_joins_agree(spark):
    big = spark.range(2000).withColumn("k", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    a = joins.lookup_join(big, small, ["k"], "left")
    b = joins.lookup_join(big, small, ["k"], "left", spread_by=["id"], limit=5)
    assert sorted(map(tuple, a.select("id", "v").collect()), key=str) == sorted(map(tuple, b.select("id", "v").collect()), key=str)


def test_salted_join_broadcasts_no_repeated_table(spark):
    """The lanes of a small table may be many more rows than Spark takes it for."""
    big = spark.range(1000).withColumn("k", F.col("id") % 50)
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        met = joins.lookup_join(big, small, ["k"], how, spread_by=["id"], limit=5)
        assert "Broadcast" not in plan_of(met) and met.count() == (1000 if how == "left" else 800)


# --- lists and velocity -----------------------------------------------------------

def entry(list_, kind, id_, reason="r", count=3, start=0, end=100):
    return (list_, kind, id_, reason, count, start, end)


def verdict(spark, entries, ms=50, **over):
    e = events(spark, [event(1, ms=ms, **over)])
    r = lists.check(e, spark.createDataFrame(entries, schemas.LIST_ENTRY)).first()
    return r["blocklist_tier"], r["blocklist_reason"], r["matched_entity_type"]


def test_list_priorities_and_validity(spark):
    assert verdict(spark, [entry("block", "card", "c"), entry("white", "ip", "i")]) == ("NONE", "whitelist:ip=i", "")
    assert verdict(spark, [entry("hot", "card", "c"), entry("block", "device", "d", "dev")]) == ("BLOCK", "dev", "device")
    assert verdict(spark, [entry("hot", "merchant", "m", None)]) == ("HOT", "merchant=m on hot-list", "merchant")
    assert verdict(spark, [entry("block", "card", "c")], ms=100)[0] == "NONE"
    assert verdict(spark, [entry("block", "card", "c")], ms=0)[0] == "BLOCK"
    assert verdict(spark, [entry("block", "card", "")], card_token="")[0] == "NONE"
    assert verdict(spark, [])[0] == "NONE"


def test_list_guardrails(spark):
    now = "list string, entity_type string, entity_id string, reason string, block_count long, added_at_ms long"
    p = spark.createDataFrame([("block", "card", "a", "r", 2, 10), ("block", "card", "b", "r", 3, 10), ("hot", "ip", "c", "r", 1, 10),
                               ("block", "phone", "d", "r", 9, 10), ("block", "card", "w", "r", 5, 10), ("white", "card", "x", "r", 0, 10)], now)
    current = spark.createDataFrame([entry("white", "card", "w"), entry("block", "card", "b", "old", 3, 0, 5)], schemas.LIST_ENTRY)
    after, refused = lists.apply(current, p)
    assert {r["entity_id"]: r["refusal"] for r in refused.collect()} == {
        "a": "block count too low", "c": "block count too low", "d": "unknown entity type", "w": "on whitelist"}
    rows = {(r["list"], r["entity_id"]): (r["reason"], r["expires_at_ms"]) for r in after.collect()}
    assert rows[("block", "b")] == ("r", 10 + 86_400_000)
    assert rows[("white", "x")] == ("r", 10 + K.WHITE_TTL_S * 1000)


def test_velocity_edges(spark):
    at = [0, 1, 2, 3, 60_000, 60_001, 3_600_000]
    e = events(spark, [event(i, ms=t) for i, t in enumerate(at)] + [event(99, card="", ms=1)])
    got = {r["event_id"]: r for r in velocity.check(e).collect()}
    assert got["4"]["n_1min"] == 5 and got["4"]["velocity_window"] == "1min"      # lower bound counted
    assert got["4"]["velocity_reason"] == "5 txns on card in 1min (threshold 5)"
    assert got["5"]["n_1min"] == 5                                               # the first one left the minute
    assert got["6"]["n_60min"] == 6                                              # the hour's lower bound is not counted
    assert not got["99"]["velocity_hit"] and not got["3"]["velocity_hit"]


def test_burst_of_six_hits_from_the_fifth(spark):
    e = events(spark, [event(i, ms=1000 * i) for i in range(6)])
    hits = [r["velocity_window"] for r in velocity.check(e).orderBy("event_timestamp_ms").collect()]
    assert hits == ["", "", "", "", "1min", "1min"]


def test_repeated_event_moves(spark):
    e = events(spark, [event(1, ms=0), event(1, ms=10 * HOUR), event(2, ms=10 * HOUR + 1)])
    got = {(r["event_id"], r["event_timestamp_ms"]): r["n_60min"] for r in velocity.check(e).collect()}
    assert got[("2", 10 * HOUR + 1)] == 2 and got[("1", 0)] == 0


def test_listed_events_do_not_feed_velocity(spark):
    e = events(spark, [event(i, ms=1000 * i, ip_address_hash="bad" if i < 3 else "ok") for i in range(6)])
    listed = spark.createDataFrame([entry("block", "ip", "bad", end=10**9)], schemas.LIST_ENTRY)
    got = {r["event_id"]: r["n_1min"] for r in scoring.rules(e, listed).collect()}
    assert got == {"0": 0, "1": 0, "2": 0, "3": 1, "4": 2, "5": 3}


def test_history_counts_but_is_not_returned(spark):
    old = events(spark, [event(i, ms=i) for i in range(4)])
    got = velocity.check(events(spark, [event(9, ms=10)]), history=old).collect()
    assert len(got) == 1 and got[0]["velocity_window"] == "1min"


# --- scalars and features -----------------------------------------------------------

def test_scalars(spark):
    r = one(spark, X.decide(F.lit(0.85)).alias("a"), X.decide(F.lit(0.5)).alias("b"), X.decide(F.lit(0.4999)).alias("c"),
            X.tokenize(F.lit(None).cast("string"), "s").alias("t"), X.safe_int(F.lit("00")).alias("z"), X.safe_int(F.lit("US")).alias("u"),
            X.feature_domain(F.lit("W-MERCHANT- Gmail.com ")).alias("d"), X.feature_domain(F.lit("W-MERCHANT-")).alias("e"),
            X.text_domain(F.lit("gmail.com")).alias("f"), X.text_domain(F.lit("")).alias("g"), X.word_count(F.lit("  a b\n c ")).alias("w"),
            X.word_count(F.lit("")).alias("w0"))
    assert tuple(r)[:3] == ("BLOCK", "REVIEW", "ALLOW")
    assert (r["t"], r["z"], r["u"], r["d"], r["e"], r["f"], r["g"], r["w"], r["w0"]) == (
        "null", 0.0, -999.0, "gmail.com", "missing", "gmail.com", "", 3, 0)


@pytest.mark.parametrize("x", [0.75, 2450.0, 12345.6, 0.00001234, 100.05, 123.45, -0.5, 1.0, 99.995, 0.0])
def test_general_number(spark, x):
    assert one(spark, X.general_number(F.lit(x)).alias("v"))["v"] == f"{x:.4g}"


def test_perplexity_limits(spark):
    r = one(spark, *[c.alias(n) for n, c in X.perplexity(F.lit(None).cast("double")).items()])
    assert tuple(r) == (0.0, 1.0, 0.0, "NORMAL")
    r = one(spark, *[c.alias(n) for n, c in X.perplexity(F.lit(-50.0)).items()])
    assert r["log_perplexity"] == 30.0 and r["perplexity"] == pytest.approx(math.exp(30)) and r["text_anomaly_label"] == "SUSPICIOUS"


def test_live_features_of_a_known_event(spark):
    e = events(spark, [event(1, ms=1782731301417, amount=125.99, merchant_country="87"), event(2, ms=0, merchant_country="US")])
    got = {r["event_id"]: r for r in features.live_features(e).collect()}
    assert [f for f in features.live_features(e).columns if f not in ("event_id", "feature_completeness")] == K.FEATURES
    assert got["1"]["feature_completeness"] == 0.3488 and got["1"]["addr2"] == 87.0 and got["1"]["amount_cents"] == 99.0
    assert got["2"]["hour_of_day"] == -999.0 and got["2"]["feature_completeness"] == round(10 / 43, 4)


def test_cents_differ_between_training_and_live(spark):
    r = one(spark, X.training_cents(F.lit(1.15)).alias("t"), X.live_amount(F.lit(1.15))["amount_cents"].alias("l"))
    import numpy as np
    assert r["t"] == int((np.float32(1.15) * 100) % 100) and r["l"] == 15.0


def test_unknown_fix_and_missing_constants(spark):
    e = events(spark, [event(1)])
    with pytest.raises(ValueError):
        features.corrected_features(e, fixes=("nope",))
    with pytest.raises(ValueError):
        features.corrected_features(e, fixes=("cents",))


def test_frequency_join_path_equals_dictionary(spark, sf):
    raw = fx.raw_rows(spark, sf)
    fitted = features.fit(raw)
    a = features.encode_frequency(raw, fitted, "P_emaildomain").select("TransactionID", "P_emaildomain_freq")
    fitted.small = {}
    b = features.encode_frequency(raw, fitted, "P_emaildomain").select("TransactionID", "P_emaildomain_freq")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_unseen_category_gets_the_rarest_frequency(spark, sf):
    raw = fx.raw_rows(spark, sf)
    fitted = features.fit(raw)
    odd = raw.limit(1).withColumn("card4", F.lit("it's \\ new"))
    got = features.encode_frequency(odd, fitted, "card4", F.col("card4"), fitted.rarest["card4"]).first()["card4_freq"]
    assert got == pytest.approx(fitted.rarest["card4"])


def test_feature_hash_depends_on_values(spark):
    df = spark.createDataFrame([(4.25, 1.0), (999999.0, 1.0), (4.25, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(scoring.feature_hash(["a", "b"])).collect()]
    assert got[0] == got[2] != got[1] and len(got[0]) == 32


# --- merges, drift, cases --------------------------------------------------------------

def test_latest_wins_ties_and_order(spark):
    shape = "event_id string, amount double, score double, scored_at_ms long, arrival long"
    data = [("a", 1.0, 0.1, 10, 1), ("a", 2.0, 0.2, 10, 2), ("a", 3.0, 0.3, 9, 3), ("b", 5.0, 0.5, 1, 4)]
    for order in (data, data[::-1]):
        got = merge.latest_wins(spark.createDataFrame(order, shape), ["amount"], ["score", "scored_at_ms"]).collect()
        assert sorted(map(tuple, got)) == [("a", 1.0, 0.2, 10), ("b", 5.0, 0.5, 1)]


def test_drift_alarm_is_strict(spark):
    rows = [(str(i), i != 0, 100) for i in range(20)]
    df = spark.createDataFrame(rows, "event_id string, decisions_agree boolean, scored_at_ms long")
    assert not analytics.drift_check(df, F.lit(100)).first()["alarm_fired"]
    assert analytics.drift_check(df, F.lit(100), threshold=0.0499).first()["alarm_fired"]
    none = analytics.drift_check(df, F.lit(10**9), 1).first()
    assert (none["compared"], none["disagreement_rate"], none["alarm_fired"]) == (0, 0.0, False)


def test_feedback_truth_table(spark):
    table = [("BLOCK", "FRAUD", True), ("REVIEW", "FRAUD", True), ("ALLOW", "FRAUD", False), ("ALLOW", "LEGIT", True), ("BLOCK", "LEGIT", False)]
    df = spark.createDataFrame(table, "decision string, verdict string, want boolean")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", X.agrees("decision", "verdict")).collect())


def test_empty_feedback(spark):
    df = spark.createDataFrame([], schemas.FEEDBACK)
    r = analytics.feedback_agreement(df).first()
    assert r["total_feedback"] == 0 and r["agreement_rate"] is None


def test_resolve_only_open_appeals(spark):
    a = spark.createDataFrame([(1, "e", None, None, None, None), (2, "f", 5, "ALLOW", 0.1, "x")],
                              "appeal_id long, event_id string, resolved_at_ms long, final_decision string, final_fraud_score double, resolution_notes string")
    r = spark.createDataFrame([(1, 9, "ALLOW", 0.2, "n"), (2, 9, "BLOCK", 0.9, "n"), (3, 9, "BLOCK", 0.9, "n")],
                              "appeal_id long, resolved_at_ms long, final_decision string, final_fraud_score double, notes string")
    after, outcome = cases.resolve(a, r)
    assert {x["appeal_id"]: x["final_decision"] for x in after.collect()} == {1: "ALLOW", 2: "ALLOW"}
    assert {x["appeal_id"]: x["ok"] for x in outcome.collect()} == {1: True, 2: False, 3: False}


# --- evaluation and quality ----------------------------------------------------------------

def brute_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, out, P = 0, 0.0, sum(y for _, y in rows)
    by = Counter()
    for s, y in rows:
        by[s] += y
    n = Counter(s for s, _ in rows)
    tp = seen = 0
    for s in sorted(n, reverse=True):
        tp, seen = tp + by[s], seen + n[s]
        out += by[s] / P * tp / seen
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_ap_against_brute_force(spark, seed):
    random.seed(seed)
    rows = [(round(random.random(), 2), int(random.random() < 0.2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    r = evaluate.ranking(df).first()
    assert r["roc_auc"] == pytest.approx(brute_auc(rows)) and r["pr_auc"] == pytest.approx(brute_ap(rows))
    flipped = evaluate.ranking(df.withColumn("score", -F.col("score"))).first()
    assert flipped["roc_auc"] == pytest.approx(1 - r["roc_auc"])


def test_confusion_without_positives_divides_to_zero(spark):
    r = evaluate.confusion(spark.createDataFrame([(0.1, 0)], "score double, label int")).first()
    assert (r["precision"], r["recall"], r["f1"], r["fpr"], r["specificity"]) == (0, 0, 0, 0, 1)


def test_quality_floor_and_missing_column(spark, sf):
    y = spark.createDataFrame([(0,)] * 99 + [(1,)], "isFraud int")
    assert quality.verdict(quality.label_checks(y, 0.001)).first()["result"] == "PASS"   # lower bound is zero
    x = features.live_features(fx.transactions(spark, sf)).select(*[f for f in K.FEATURES if f != "M9_freq"])
    r = quality.verdict(quality.feature_checks(x, 1000)).first()
    assert r["result"] == "FAIL" and r["total"] == 56


def test_narrative_length_grade(spark):
    c = F.array(F.struct(F.lit("is_night").alias("feature_name"), F.lit(1.0).alias("feature_value"), F.lit(0.2).alias("shap_value")))
    ok = lambda text, mode: one(spark, explain.grade(F.lit(text), c, F.lit(mode)).alias("g"))["g"]
    assert ok("w " * 80, "TEMPLATE") and not ok("w " * 81, "TEMPLATE")
    assert ok("The night-time flag stands out.", "GEMINI") and not ok("The billing region stands out.", "GEMINI")
    assert not ok("The strongest signal pushing toward LEGITIMATE was night-time flag.", "GEMINI")


def test_missing_model_columns_are_named(spark):
    from txnguard.operators import training
    with pytest.raises(ValueError, match="card2"):
        training.assemble(spark.createDataFrame([(1.0,)], "card1 double"))


# --- records and files ------------------------------------------------------------------------

def test_record_types():
    assert [len(schemas.SCHEMAS[n].fields) for n in ("event", "scored", "enriched", "feedback")] == [16, 29, 29, 9]
    assert len(K.FEATURES) == 43 and len(schemas.RAW.fields) == 36


def test_csv_scan_is_pruned(spark, sf, tmp_path):
    raw = fx.raw_rows(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW.fields])
    wide = raw.withColumns({"V1": F.lit("x"), "V2": F.lit("y")})
    wide.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    got = files.read_csv(spark, str(tmp_path / "csv"), schemas.RAW, ["TransactionID", "TransactionAmt"], wide.columns)
    assert got.count() == raw.count() and got.agg(F.sum("TransactionAmt")).first()[0] == pytest.approx(raw.agg(F.sum("TransactionAmt")).first()[0])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "V1" not in plan.split("ReadSchema")[1]
    assert files.without_prefixes(wide.columns, ("V",)) == raw.columns


def test_split_parts_round_trip(spark, sf, tmp_path):
    df = evaluate.time_split(fx.raw_rows(spark, sf), "TransactionDT")
    files.write_split(df, str(tmp_path / "x"))
    assert sum(files.read_split(spark, str(tmp_path / "x"), p).count() for p in ("train", "val", "test")) == df.count()


def test_every_query_has_a_stable_schema(spark, sf):
    """The flagship runs, and queries with checks agree on column names."""
    import __spark_entry__ as entry
    assert entry.entry(spark).columns and set(entry.oracle_sql()) <= set(entry.queries())


def test_split_join_covers_hot_and_cold_keys(spark):
    big = spark.range(1000).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 97))
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    got = joins.split_join(big, small, ["k"], "n", ["id"], hot=100)
    assert got.count() == 1000 and got.where("v <> 2 * k").count() == 0


def test_rules_equal_lists_then_velocity(spark, sf):
    from txnguard.plans.rules import WINDOWS
    tx, entries = fx.transactions(spark, sf), fx.list_entries(spark, sf)
    counts = ["n_1min", "n_10min", "n_60min", "matched_entity_type", "matched_entity_id"]
    cols = ["event_id", "blocklist_hit", "blocklist_tier", "blocklist_reason", "velocity_hit", "velocity_window", "velocity_reason"]
    plain = velocity.check(lists.check(tx, entries), WINDOWS, ~F.col("blocklist_hit"), fx.DAY_MS)
    whole, brief = scoring.rules(tx, entries, WINDOWS, fx.DAY_MS), scoring.rule_hits(tx, entries, WINDOWS, fx.DAY_MS)
    assert sorted(map(tuple, whole.select(*cols, *counts).collect())) == sorted(map(tuple, plain.select(*cols, *counts).collect()))
    assert sorted(map(tuple, brief.select(*cols).collect())) == sorted(map(tuple, plain.select(*cols).collect()))


def test_rules_scan_events_twice_and_shuffle_seldom(spark, sf, tmp_path, monkeypatch):
    stored, listed = str(tmp_path / "events"), str(tmp_path / "lists")
    fx.transactions(spark, sf).write.parquet(stored)
    fx.list_entries(spark, sf).write.parquet(listed)
    events, entries = spark.read.parquet(stored), spark.read.parquet(listed)
    plans = []
    store = scoring.materialize
    monkeypatch.setattr(scoring, "materialize", lambda df, label: plans.append(plan_of(df)) or store(df, label))
    for run in (scoring.rules, scoring.rule_hits):
        plans.clear()
        plans.append(plan_of(run(events, entries)))
        assert sum(p.count("Exchange hashpartitioning") for p in plans) <= 8
        assert sum(line.count(stored) for p in plans for line in p.splitlines() if "FileScan" in line) == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_and_cardless_events_in_rules(spark):
    e = events(spark, [event(1, ms=0), event(1, ms=10 * HOUR), event(2, ms=10 * HOUR + 1), event(3, ms=5, card_token=""),
                       event(4, ms=5, card_token=None), event(5, ms=10 * HOUR + 2, ip_address_hash="bad")])
    listed = spark.createDataFrame([entry("block", "ip", "bad", end=10**9)], schemas.LIST_ENTRY)
    old = events(spark, [event(7, ms=10 * HOUR - 1), event(8, ms=9 * HOUR - 1)])
    got = {(r["event_id"], r["event_timestamp_ms"]): (r["n_60min"], r["blocklist_hit"]) for r in scoring.rules(e, listed, history=old).collect()}
    assert got == {("1", 0): (0, False), ("1", 10 * HOUR): (2, False), ("2", 10 * HOUR + 1): (3, False), ("3", 5): (0, False),
                   ("4", 5): (0, False), ("5", 10 * HOUR + 2): (0, True)}
    none = scoring.rule_hits(e.limit(0), listed.limit(0))
    assert none.count() == 0 and "velocity_hit" in none.columns


def test_near_totals_equal_trailing_totals(spark):
    import random
    from txnguard.operators import timeline
    rng = random.Random(3)
    at = [("hot", rng.randrange(-40_000, 40_000), rng.randrange(9)) for _ in range(1500)] + [(f"k{i % 40}", rng.randrange(90_000), 1) for i in range(300)]
    df = spark.createDataFrame(at, "k string, ms long, x long")
    args = (df, "k", "ms", {"n": F.lit(1), "x": F.col("x")}, {"a": (0, 0), "b": (999, 0), "c": (9_000, 1)})
    want = sorted(map(tuple, timeline.trailing_totals(*args, 1000).collect()))
    for block in (1, 1000, 50_000):
        assert sorted(map(tuple, timeline.near_totals(*args, block).collect())) == want


def test_text_of_any_script_is_scored(spark):
    from txnguard.operators import text
    model = text.fit(spark.createDataFrame([("plain merchant names",), ("обычный магазин",)], "text string"))
    rows = spark.createDataFrame([("1", "магазин цветов"), ("2", "東京ストア"), ("3", "")], "event_id string, name string")
    got = {r["event_id"]: r for r in text.score(rows, "name", model, 2.6).collect()}
    assert got["1"]["log_perplexity"] > 0 and got["2"]["text_anomaly_score"] > got["1"]["text_anomaly_score"]
    assert got["3"]["log_perplexity"] == 0


def test_windows_are_named_as_given():
    from txnguard.operators.lists import span_name
    assert [span_name(s) for s in (86_400, 7 * 86_400, 3600, 5400, 90)] == ["24h", "7d", "1h", "90min", "90s"]


def test_an_ambiguous_key_gets_no_label(spark):
    from txnguard.operators import patterns
    events = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "event_id string, k int")
    labels = spark.createDataFrame([(1, 0, "W"), (2, 1, "W"), (2, 0, "C")], "k int, label int, ProductCD string")
    got = {r["event_id"]: (r["label"], r["matches"]) for r in patterns.guarded_label_join(events, labels, ["k"]).collect()}
    assert got == {"a": (0, 1), "b": (None, 2), "c": (None, 0)}


def test_scoring_follows_the_champion_pointer(spark, tmp_path):
    from txnguard.operators import training
    one = spark.createDataFrame([(float(i % 7), float(i % 2), i % 2) for i in range(60)], "a double, b double, isFraud int")
    rows = training.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(one)
    for name, trees in (("small", 2), ("large", 5)):
        training.publish(training.RandomForestClassifier(labelCol="isFraud", numTrees=trees, seed=1).fit(rows), str(tmp_path), name)
    for version, (small, large, expected) in enumerate([(0.9, 0.8, 2), (0.7, 0.8, 5)]):
        table = spark.createDataFrame([("small", small), ("large", large)], "model string, roc_auc double")
        training.point_at_champion(table, str(tmp_path), version)
        assert training.load_champion(spark, str(tmp_path)).getNumTrees == expected


def test_close_large_amounts_keep_their_deviation(spark):
    data = [(str(i), "c", i * 1000, 1e9 + x) for i, x in enumerate([0.01, 0.02, 0.03, 0.05])]
    events = spark.createDataFrame(data, "event_id string, customer_id string, event_timestamp_ms long, amount double")
    z = {r["event_id"]: r["z"] for r in patterns.amount_zscore(events).collect()}
    assert z.keys() == {"2", "3"}
    assert z["2"] == pytest.approx(0.015 / 0.0070711, rel=1e-3) and z["3"] == pytest.approx(0.03 / 0.01, rel=1e-3)


def test_recorded_checks_replace_and_list_newest_first(spark, tmp_path):
    from txnguard.operators import analytics
    from txnguard.streaming.sink import BatchTable
    history = BatchTable(spark, str(tmp_path / "drift"), analytics.DRIFT_CHECK)
    assert analytics.check_history(history).count() == 0
    compared = spark.createDataFrame([(1_000, True), (2_000, False)], "scored_at_ms long, decisions_agree boolean")
    for i, at in ((0, 1_500), (1, 2_500), (1, 2_500)):
        analytics.record_check(history, i, analytics.drift_check(compared, F.lit(at).cast("long"), 60), F.lit(at).cast("long"))
    got = [(r["check_id"], r["checked_at_ms"], r["compared"], r["alarm_fired"]) for r in analytics.check_history(history).collect()]
    assert got == [(1, 2_500, 2, True), (0, 1_500, 1, False)]
    assert analytics.check_history(history, 1).count() == 1


def test_difference_keeps_order_and_null_keys(spark):
    rows = spark.createDataFrame([(3,), (None,), (1,), (2,)], "id int")
    assert [r[0] for r in merge.difference(rows, rows.where("id = 2 OR id IS NULL"), "id").collect()] == [None, 1, 3]


def test_slabs_grow_with_the_rows():
    assert [prefix.slab_count(n, 200) for n in (0, 1, 50_001, 10**9, 10**12)] == [1, 1, 2, 250, 250_000]


def test_shapley_values_are_those_of_all_subsets():
    from itertools import combinations
    from math import factorial
    from txnguard.operators import training as R
    rng = np.random.default_rng(4)

    def grow(depth):
        tree = {c: [] for c in ("prediction", "leftChild", "rightChild", "feature", "threshold", "cover")}

        def node(left, cover):
            at = len(tree["cover"])
            for c in tree:
                tree[c].append(-1)
            tree["cover"][at] = cover
            if left and rng.random() < 0.9:
                share = rng.uniform(0.1, 0.9)
                tree["feature"][at], tree["threshold"][at], tree["prediction"][at] = int(rng.integers(0, 4)), rng.normal(), 0.0
                tree["leftChild"][at] = node(left - 1, cover * share)
                tree["rightChild"][at] = node(left - 1, cover * (1 - share))
            else:
                tree["prediction"][at] = rng.normal()
            return at
        node(depth, 100.0)
        return {c: np.array(v, float if c in ("prediction", "threshold", "cover") else int) for c, v in tree.items()}

    def value(tree, row, known, at=0):
        if tree["leftChild"][at] < 0:
            return tree["prediction"][at]
        a, b, f = tree["leftChild"][at], tree["rightChild"][at], tree["feature"][at]
        if f in known:
            return value(tree, row, known, a if row[f] <= tree["threshold"][at] else b)
        return sum(tree["cover"][c] / tree["cover"][at] * value(tree, row, known, c) for c in (a, b))

    for depth in (0, 1, 3, 6):
        trees, weights, x = [grow(depth) for _ in range(3)], [1.0, 0.1, 0.3], rng.normal(size=(25, 4))
        base, got = R.tree_shapley(trees, [R.leaves(t) for t in trees], weights, x)
        v = lambda row, s: sum(w * value(t, row, s) for t, w in zip(trees, weights))
        assert abs(base - v(x[0], ())) < 1e-9
        for row, own in zip(x, got):
            for f in range(4):
                rest = [g for g in range(4) if g != f]
                want = sum(factorial(k) * factorial(3 - k) / 24 * (v(row, {*s, f}) - v(row, set(s))) for k in range(4) for s in combinations(rest, k))
                assert abs(want - own[f]) < 1e-9


def test_leaf_values_are_made_once_for_all_rows(monkeypatch):
    """A leaf of few features is valued once, not once a batch; one of many by the rows' own sets, with the same result."""
    from txnguard.operators import training as R
    tree = {"prediction": np.array([0, 0, 1.5, -2.0, 0.5]), "leftChild": np.array([1, 3, -1, -1, -1]), "rightChild": np.array([2, 4, -1, -1, -1]),
            "feature": np.array([0, 1, -1, -1, -1]), "threshold": np.array([0.1, -0.2, 0, 0, 0]), "cover": np.array([10.0, 6, 4, 1, 5])}
    made, values = [], R.leaf_values
    monkeypatch.setattr(R, "leaf_values", lambda leaf, met: made.append(1) or values(leaf, met))
    parts, x = [R.leaves(tree)], np.random.default_rng(1).normal(size=(300, 3))
    got = [R.tree_shapley([tree], parts, [0.5], x[i:i + 30])[1] for i in range(0, 300, 30)]
    assert len(made) == 3
    monkeypatch.setattr(R, "TABLE", 0)
    assert np.allclose(np.concatenate(got), R.tree_shapley([tree], [R.leaves(tree)], [0.5], x)[1], rtol=0, atol=1e-12)


def test_what_if_makes_its_events_and_scores_once(spark, sf, monkeypatch):
    """Thirteen scenarios read one stored table; only the offline one, made of raw rows, is joined to labels again."""
    from txnguard.plans import evaluation as E
    plans, store = {}, E.materialize
    monkeypatch.setattr(E, "materialize", lambda df, label: plans.setdefault(label, plan_of(df)) and store(df, label))
    got = E.what_if(spark, sf, alone=True)
    assert got.count() == 13 and set(plans) == {"labelled", "scores", "ranked"}
    assert plans["scores"].count("events.parquet") == 2 and "events.parquet" not in plans["ranked"] + plan_of(got)


def test_early_stop_rule():
    from txnguard.operators import training as R
    assert R.stopping([0.5, 0.6, 0.6, 0.6], 2) == (2, 4, True)
    assert R.stopping([0.5, 0.6, 0.6, 0.7], 2) == (4, 4, False) == R.stopping([0.5, 0.6, 0.61, 0.7], 2)
    assert R.stopping([0.9, 0.1, 0.2, 0.95], 3) == (4, 4, False) and R.stopping([0.9, 0.1, 0.2, 0.3, 1.0], 3) == (1, 4, True)


def test_boosting_stops_on_auc(spark):
    from txnguard.operators import training as R
    rng = random.Random(5)
    names = K.FEATURES
    rows = []
    for i in range(400):
        x = [rng.random() for _ in names]
        rows.append((int(x[0] + 0.6 * rng.random() > 0.9), i % 4 == 0, *x))
    df = spark.createDataFrame(rows, "isFraud int, held boolean, " + ", ".join(f"{n} double" for n in names)).cache()
    train, held = df.where("NOT held"), df.where("held")
    done = R.train_boosted_until(train, held, rounds=12, depth=2, rate=0.3, patience=3)
    curve = {r["round"]: r["roc_auc"] for r in done.curve.collect()}
    assert (done.best, done.last) == R.stopping([curve[i] for i in sorted(curve)], 3)[:2] and len(curve) == done.last
    got = R.score(done.model, held).select("isFraud", "score").collect()
    pos, neg = [r["score"] for r in got if r["isFraud"]], [r["score"] for r in got if not r["isFraud"]]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(wins - curve[done.best]) < 1e-12 and len(done.model.trees) == done.best


def test_training_tables_are_dealt_over_tasks(spark, sf, monkeypatch):
    """A table of few bytes and many rows is stored in files of so many rows; a small one stays as it is."""
    from txnguard.operators import training as R
    from txnguard.plans import models as M
    table = M.table(spark, sf)
    assert R.dealt(table, "TransactionID") is table
    monkeypatch.setattr(R, "TASK_ROWS", 200)
    got = M.table(spark, sf)
    sizes = [r["n"] for r in got.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == -(-table.count() // 200) and max(sizes) < 300 and got.count() == table.count()
    key = ["TransactionID", "isFraud", "split"]
    assert got.select(*key).exceptAll(table.select(*key)).isEmpty()


def test_boosting_that_still_gains_is_fitted_once_more(spark, monkeypatch):
    """While the last round is the best, the next run is the last one; else runs double."""
    from txnguard.operators import training as R
    df = spark.createDataFrame([(i % 2, *[float(i)] * len(K.FEATURES)) for i in range(4)], "isFraud int, " + ", ".join(f"{n} double" for n in K.FEATURES))
    runs = []

    class Booster:
        def __init__(self, maxIter, **other):
            runs.append(maxIter)

        def fit(self, rows):
            return runs[-1]
    monkeypatch.setattr(R, "GBTClassifier", Booster)
    monkeypatch.setattr(R, "first_rounds", lambda model, n: n)
    for gains, expected in ((range(400), [40, 400]), ([*range(30), *[0] * 370], [40, 80]), ([*range(39), 0, *range(40, 400)], [40, 80, 400])):
        monkeypatch.setattr(R, "auc_by_round", lambda n, *other: spark.createDataFrame([(i + 1, float(gains[i])) for i in range(n)], "round int, roc_auc double"))
        runs.clear()
        done = R.train_boosted_until(df, df)
        assert runs == expected and (done.best, done.last) == R.stopping([float(g) for g in gains], 20)[:2]


def test_history_counts_without_being_judged(spark):
    """Rows that are not judged get no window of their own, and no row goes to a block where nothing is judged; the totals are the same."""
    from txnguard.operators.timeline import near_totals
    rng = random.Random(4)
    rows = [(f"c{rng.randrange(6)}", rng.randrange(0, 4000), i % 5 == 0) for i in range(600)] + [("c9", 50, True), ("c9", 50, False), ("c9", None, True)]
    df = spark.createDataFrame([(k, t, own and (t is None or t >= 50) and (t or 0) < 3000) for k, t, own in rows], "k string, t long, own boolean").cache()
    windows = {"a": (99, 0), "b": (1000, 0)}
    wanted = {(r["k"], r["t"]) for r in df.where("own AND t IS NOT NULL").collect()}
    span = (min(t for _, t in wanted), max(t for _, t in wanted))
    whole = near_totals(df, "k", "t", {"n": F.lit(1)}, windows, 100)
    some = near_totals(df, "k", "t", {"n": F.lit(1)}, windows, 100, F.col("own"), span)
    expected = {(r["k"], r["t"]): (r["n_a"], r["n_b"]) for r in whole.collect()}
    got = {(r["k"], r["t"]): (r["n_a"], r["n_b"]) for r in some.collect()}
    assert got == {p: expected[p] for p in wanted} and len(expected) > len(wanted)
    for (k, t), (a, b) in got.items():
        assert (a, b) == tuple(sum(k == x and y is not None and t - back <= y <= t for x, y, _ in rows) for back in (99, 1000))
