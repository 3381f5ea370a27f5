"""Views and operational reports over the scored, enriched and case tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.streaming.sink import BatchTable


def latest(df: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery: the default "now"."""
    return df.agg(F.max(column)).scalar()


def distribution(scored: DataFrame, as_of: Column, window_ms: int = 86_400_000) -> DataFrame:
    recent = scored.where(F.col("scored_at_ms") >= as_of - window_ms)
    return recent.groupBy("decision").agg(
        F.count(F.lit(1)).alias("event_count"), F.round(F.avg("fraud_score") * 100, 2).alias("avg_score_pct"),
        F.round(F.avg("scoring_latency_ms"), 2).alias("avg_latency_ms"))


def top_flagged_customers(scored: DataFrame, n: int = 100) -> DataFrame:
    per = scored.groupBy("customer_id").agg(
        *[F.count_if(F.col("decision") == x).alias(f"{x.lower()}_count") for x in ("BLOCK", "REVIEW", "ALLOW")],
        F.round(F.avg("fraud_score"), 4).alias("avg_fraud_score"), F.max("fraud_score").alias("max_fraud_score"))
    flagged = per.where(F.col("block_count") + F.col("review_count") > 0)
    return flagged.orderBy(F.desc("block_count"), F.desc("review_count"), "customer_id").limit(n)


def decision_split(scored: DataFrame) -> DataFrame:
    """Counts, share of total and averages per decision."""
    per = scored.groupBy("decision").agg(
        F.count(F.lit(1)).alias("events"), F.avg("fraud_score").alias("avg_score"),
        F.avg("scoring_latency_ms").alias("avg_latency_ms"), F.count_if("velocity_hit").alias("velocity_rule"))
    total = F.sum("events").over(Window.partitionBy(F.lit(0)))  # one row per decision
    return per.withColumn("share_pct", 100.0 * F.col("events") / total)


def compare_scorers(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both scorers side by side on the events they share."""
    a = first.select("event_id", "customer_id", "amount", "merchant_name", "mcc", F.col("fraud_score").alias("first_score"),
                     F.col("decision").alias("first_decision"), F.col("scoring_latency_ms").alias("first_latency_ms"), "scored_at_ms")
    b = second.select("event_id", F.col("fraud_score").alias("second_score"), F.col("decision").alias("second_decision"),
                      F.col("scoring_latency_ms").alias("second_latency_ms"), F.col("blocklist_reason").alias("llm_reason"))
    return a.join(b, "event_id").withColumns({
        "decisions_agree": F.col("first_decision") == F.col("second_decision"),
        "score_diff": F.abs(F.col("first_score") - F.col("second_score"))})


def agreement(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count(F.lit(1)).alias("total_overlap"), F.count_if("decisions_agree").alias("agreements"),
        F.count_if(~F.col("decisions_agree")).alias("disagreements"),
        F.round(100.0 * F.count_if("decisions_agree") / F.nullif(F.count(F.lit(1)), F.lit(0)), 1).alias("agreement_pct"))


def latency_by_scorer(compared: DataFrame) -> DataFrame:
    return compared.agg(*[
        f(f"{s}_latency_ms").alias(f"{s}_{n}_ms") for s in ("first", "second") for n, f in (("avg", F.avg), ("max", F.max))])


def scorer_rows(first: DataFrame, second: DataFrame, compared: DataFrame) -> DataFrame:
    rows = [df.select(F.lit(n).alias("what")) for n, df in (("first", first), ("second", second), ("overlap", compared))]
    stacked = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return stacked.agg(*[F.count_if(F.col("what") == n).alias(f"{n}_rows") for n in ("first", "second", "overlap")])


def drift_check(compared: DataFrame, as_of: Column, window_minutes: int = 60, threshold: float = 0.05) -> DataFrame:
    """One check row; the alarm needs a rate strictly above the threshold."""
    recent = compared.where(F.col("scored_at_ms").between(as_of - window_minutes * 60_000, as_of))
    n, bad = F.count(F.lit(1)), F.count_if(~F.col("decisions_agree"))
    rate = F.when(n > 0, bad / n).otherwise(0.0)
    return recent.agg(F.lit(window_minutes).alias("window_minutes"), n.alias("compared"), bad.alias("disagreements"),
                      rate.alias("rate"), F.lit(threshold).alias("threshold"),
                      ((n > 0) & (rate > threshold)).alias("alarm_fired")).withColumn("disagreement_rate", F.round("rate", 4)).drop("rate")


DRIFT_CHECK = T.StructType([
    T.StructField("checked_at_ms", T.LongType()), T.StructField("window_minutes", T.IntegerType()), T.StructField("compared", T.LongType()),
    T.StructField("disagreements", T.LongType()), T.StructField("threshold", T.DoubleType()), T.StructField("alarm_fired", T.BooleanType()),
    T.StructField("disagreement_rate", T.DoubleType())])


def record_check(history: BatchTable, check_id: int, check: DataFrame, as_of: Column) -> None:
    """Add a check to the history (rows of ``DRIFT_CHECK``); recording the same id again replaces it."""
    history.write(check.withColumn("checked_at_ms", as_of), check_id)


def check_history(history: BatchTable, n: int | None = None) -> DataFrame:
    """Recorded checks, newest first; ``n`` is the report's limit."""
    rows = history.read().withColumnRenamed("batch", "check_id").orderBy(F.desc("checked_at_ms"), F.desc("check_id"))
    return rows if n is None else rows.limit(n)


def drift_by_window(compared: DataFrame, minutes: int = 60, threshold: float = 0.05) -> DataFrame:
    """Drift per tumbling window of scoring time."""
    at = F.timestamp_millis("scored_at_ms")
    per = compared.groupBy(F.window(at, f"{minutes} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("decisions_agree")).alias("disagreements"))
    rate = F.col("disagreements") / F.col("compared")
    return per.select(F.unix_millis("w.start").alias("window_start_ms"), "compared", "disagreements",
                      F.round(rate, 4).alias("disagreement_rate"), (rate > threshold).alias("alarm_fired"))


def lag_by_scope(offsets: DataFrame) -> DataFrame:
    """Lag per group/topic; partitions without a committed offset are left out."""
    lag = F.col("lag").try_cast("double")
    return offsets.where(lag.isNotNull()).groupBy(F.concat_ws("/", "group", "topic").alias("scope")).agg(F.sum(lag).alias("lag"))


def request_headroom(requests: DataFrame, as_of: Column, cap: int = K.LLM_REQUESTS_PER_MINUTE) -> DataFrame:
    used = F.count(F.lit(1))
    return requests.where(F.col("scored_at_ms") > as_of - 60_000).agg(
        used.alias("used"), F.greatest(F.lit(0), cap - used).alias("headroom"))


def latency_percentiles(scored: DataFrame) -> DataFrame:
    """Continuous percentiles. Latencies are whole milliseconds, so the exact
    aggregate keeps one counter per distinct millisecond, not one per row."""
    p = F.percentile("scoring_latency_ms", [0.5, 0.95, 0.99])
    out = scored.agg(F.count(F.lit(1)).alias("events"), p.alias("p"), F.max("scoring_latency_ms").alias("max_ms"))
    return out.select("events", F.col("p")[0].alias("p50_ms"), F.col("p")[1].alias("p95_ms"), F.col("p")[2].alias("p99_ms"), "max_ms")


def live_quality(scored: DataFrame, as_of: Column, review_at: float = K.DEMO_REVIEW_AT, block_at: float = K.DEMO_BLOCK_AT,
                 window_ms: int = 3_600_000) -> DataFrame:
    """One row of live checks. Only list hits are left out of the policy check, so a
    velocity hit counts as a mismatch; duplicates fold by event id first."""
    recent = scored.where(F.col("scored_at_ms") > as_of - window_ms)
    token = "^([0-9a-f]{16}|null)$"
    bad_token = ~F.col("card_token").rlike(token) | ~F.col("ip_address_hash").rlike(token) | ~F.col("device_fingerprint_hash").rlike(token)
    invalid = ~F.col("decision").isin(K.DECISIONS) | (F.col("fraud_score") < 0) | (F.col("fraud_score") > 1) | F.col("scoring_latency_ms").isNull()
    off_policy = ~F.coalesce("blocklist_hit", F.lit(False)) & (F.col("decision") != X.decide("fraud_score", review_at, block_at))
    per_id = recent.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(invalid).alias("invalid"), F.count_if(off_policy).alias("off_policy"),
        F.count_if(bad_token).alias("bad_tokens"), F.count_if(F.col("scoring_latency_ms") < K.LATENCY_BUDGET_MS).alias("fast"),
        F.max("scored_at_ms").alias("newest"))
    return per_id.agg(
        F.sum("n").alias("events"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"), F.sum("invalid").alias("invalid"),
        F.sum("off_policy").alias("off_policy"), F.sum("bad_tokens").alias("bad_tokens"),
        F.round(100.0 * F.sum("fast") / F.sum("n"), 1).alias("under_budget_pct"),
        F.round((as_of - F.max("newest")) / 1000.0, 0).alias("age_s"))


def quality_verdicts(row: DataFrame, coverage: DataFrame) -> DataFrame:
    """The live row and the explanation coverage as pass/fail checks."""
    checks = [("stream flowing", F.col("age_s"), F.col("age_s") <= 60), ("no duplicates", F.col("duplicates"), F.col("duplicates") == 0),
              ("fully decided", F.col("invalid"), F.col("invalid") == 0), ("policy followed", F.col("off_policy"), F.col("off_policy") == 0),
              ("within budget", F.col("under_budget_pct"), F.col("under_budget_pct") >= 95), ("tokens only", F.col("bad_tokens"), F.col("bad_tokens") == 0)]

    def rows(df, items):
        return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"), ok.alias("passed"))
                                             for n, v, ok in items])).alias("c")).select("c.*")

    pct = F.round(100.0 * F.col("explained") / F.nullif(F.col("flagged"), F.lit(0)), 1)
    return rows(row, checks).unionByName(rows(coverage, [("every flag explained", pct, F.coalesce(pct >= 95, F.lit(False)))]))


def explanation_coverage(scored: DataFrame, enriched: DataFrame, as_of: Column, oldest_ms: int = 3_600_000,
                         newest_ms: int = 300_000) -> DataFrame:
    """Flagged events old enough to be explained, and how many are."""
    t = F.col("scored_at_ms")
    flagged = scored.where(X.flagged("decision") & (t >= as_of - oldest_ms) & (t <= as_of - newest_ms)).select("event_id")
    done = enriched.select("event_id", F.lit(1).alias("hit"))
    return flagged.join(done, "event_id", "left").agg(F.count(F.lit(1)).alias("flagged"), F.count("hit").alias("explained"))


def untouched_blocks(scored: DataFrame, appeals: DataFrame, feedback: DataFrame) -> DataFrame:
    """Blocked events nobody appealed or judged."""
    blocked = scored.where(F.col("decision") == "BLOCK")
    return blocked.join(appeals, "event_id", "left_anti").join(feedback, "event_id", "left_anti")


def feedback_agreement(feedback: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return feedback.agg(
        total.alias("total_feedback"), F.count_if("model_agreed").alias("agreements"),
        F.round(F.avg(F.col("model_agreed").cast("int")), 4).alias("agreement_rate"),
        F.count_if(F.col("analyst_verdict") == "FRAUD").alias("analyst_fraud"),
        F.count_if(F.col("analyst_verdict") == "LEGIT").alias("analyst_legit"))


def trend(scored: DataFrame, by: str) -> DataFrame:
    """Events, BLOCKs and list hits per calendar or merchant dimension."""
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("decision") == "BLOCK").alias("blocks"),
        F.count_if("blocklist_hit").alias("list_hits"), F.avg("fraud_score").alias("avg_score"))


def week_over_week(scored: DataFrame) -> DataFrame:
    """Flagged rate per week and its change; one row per week reaches the window."""
    week = F.date_trunc("week", F.timestamp_millis("scored_at_ms"))
    per = scored.groupBy(week.alias("w")).agg(F.count(F.lit(1)).alias("events"), F.count_if(X.flagged("decision")).alias("flagged"))
    rate = F.col("flagged") / F.col("events")
    before = F.lag(rate).over(Window.partitionBy(F.lit(0)).orderBy("w"))
    return per.select(F.date_format("w", "yyyy-MM-dd").alias("week"), "events", "flagged", rate.alias("flagged_rate"), (rate - before).alias("change"))


def overturn_rate(appeals: DataFrame, scored: DataFrame) -> DataFrame:
    """Blocks, appeals decided otherwise, and their ratio."""
    blocks = scored.where(F.col("decision") == "BLOCK").select(F.lit("block").alias("what"))
    over = appeals.where((F.col("original_decision") == "BLOCK") & (F.col("final_decision") != "BLOCK")).select(F.lit("over").alias("what"))
    out = blocks.unionByName(over).agg(F.count_if(F.col("what") == "block").alias("blocks"), F.count_if(F.col("what") == "over").alias("overturned"))
    return out.withColumn("overturn_rate", F.col("overturned") / F.nullif(F.col("blocks"), F.lit(0)))


def reconcile(produced: DataFrame, scored: DataFrame) -> DataFrame:
    """Events produced, distinct events scored, and those that never arrived."""
    lost = produced.join(scored, "event_id", "left_anti")
    parts = [df.select("event_id", F.lit(n).alias("what")) for n, df in (("p", produced), ("s", scored), ("l", lost))]
    per = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("event_id").agg(
        *[F.count_if(F.col("what") == n).alias(n) for n in "psl"])
    return per.agg(F.count_if(F.col("p") > 0).alias("produced"), F.count_if(F.col("s") > 0).alias("scored"), F.count_if(F.col("l") > 0).alias("lost"))
