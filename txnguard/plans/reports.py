"""Queries: views, comparisons, cases and operational reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from txnguard import constants as K, schemas
from txnguard.durable import scratch_root
from txnguard.functions import scalars as X
from txnguard.operators import analytics as A, cases, joins, patterns, prefix, rolling
from txnguard.operators.timeline import trailing_totals
from txnguard.plans.registry import query
from txnguard.plans.sql_base import EVENT_COLS, HOUR, NIGHT, cte, decide, oracle
from txnguard.sources import fixtures as fx
from txnguard.streaming.sink import BatchTable

MAXT = "(SELECT max(scored_at_ms) FROM {0})"


def compared(spark, d) -> DataFrame:
    return A.compare_scorers(fx.scored(spark, d), fx.second_scored(spark, d))


# --- views ---------------------------------------------------------------------

@query("d1_decision_distribution", oracle(f"""SELECT decision, count(*) AS event_count, round(avg(fraud_score) * 100, 2) AS avg_score_pct,
  round(avg(scoring_latency_ms), 2) AS avg_latency_ms FROM sc WHERE scored_at_ms >= {MAXT.format('sc')} - 86400000 GROUP BY decision""", "sc"))
def d1(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    return A.distribution(s, A.latest(s, "scored_at_ms"))


@query("d2_top_flagged_customers", oracle("""SELECT customer_id, count(*) FILTER (WHERE decision = 'BLOCK') AS block_count,
  count(*) FILTER (WHERE decision = 'REVIEW') AS review_count, count(*) FILTER (WHERE decision = 'ALLOW') AS allow_count,
  round(avg(fraud_score), 4) AS avg_fraud_score, max(fraud_score) AS max_fraud_score FROM sc GROUP BY customer_id
  HAVING count(*) FILTER (WHERE decision <> 'ALLOW') > 0 ORDER BY block_count DESC, review_count DESC, customer_id LIMIT 100""", "sc"), "max_fraud_score", digits=8)
def d2(spark, d) -> DataFrame:
    return A.top_flagged_customers(fx.scored(spark, d))


@query("d3_decision_split", oracle("""SELECT decision, count(*) AS events, 100.0 * count(*) / sum(count(*)) OVER () AS share_pct,
  avg(fraud_score) AS avg_score, avg(scoring_latency_ms) AS avg_latency_ms, count(*) FILTER (WHERE velocity_hit) AS velocity_rule
  FROM sc GROUP BY decision""", "sc"), "share_pct avg_score avg_latency_ms")
def d3(spark, d) -> DataFrame:
    return A.decision_split(fx.scored(spark, d))


@query("c2_scorer_comparison", oracle("SELECT * FROM cmp", "cmp"), "first_score second_score score_diff", digits=8)
def c2(spark, d) -> DataFrame:
    return compared(spark, d)


@query("d10_agreement", oracle("""SELECT count(*) AS total_overlap, count(*) FILTER (WHERE decisions_agree) AS agreements,
  count(*) FILTER (WHERE NOT decisions_agree) AS disagreements, 100.0 * count(*) FILTER (WHERE decisions_agree) / count(*) AS agreement_pct FROM cmp""", "cmp"), "agreement_pct", digits=1)
def d10(spark, d) -> DataFrame:
    return A.agreement(compared(spark, d))


@query("d11_latency_by_scorer", oracle("""SELECT avg(first_latency_ms) AS first_avg_ms, max(first_latency_ms) AS first_max_ms,
  avg(second_latency_ms) AS second_avg_ms, max(second_latency_ms) AS second_max_ms FROM cmp""", "cmp"), "first_avg_ms second_avg_ms", digits=2)
def d11(spark, d) -> DataFrame:
    return A.latency_by_scorer(compared(spark, d))


@query("d12_decision_crosstab", oracle("SELECT first_decision, second_decision, count(*) AS n FROM cmp GROUP BY ALL", "cmp"))
def d12(spark, d) -> DataFrame:
    return compared(spark, d).groupBy("first_decision", "second_decision").agg(F.count(F.lit(1)).alias("n"))


@query("d12_decision_by_label", oracle("""SELECT decision, count(*) FILTER (WHERE label = 0) AS legit, count(*) FILTER (WHERE label = 1) AS fraud
  FROM scf GROUP BY decision""", "scf"))
def d12_label(spark, d) -> DataFrame:
    wide = fx.scored_full(spark, d).groupBy("decision").pivot("label", [0, 1]).agg(F.count(F.lit(1))).fillna(0)
    return wide.withColumnsRenamed({"0": "legit", "1": "fraud"})


@query("d13_scorer_rows", oracle("SELECT (SELECT count(*) FROM sc) AS first_rows, (SELECT count(*) FROM sc2) AS second_rows, (SELECT count(*) FROM cmp) AS overlap_rows", "cmp"))
def d13(spark, d) -> DataFrame:
    return A.scorer_rows(fx.scored(spark, d), fx.second_scored(spark, d), compared(spark, d))


@query("e5_top_disagreements", oracle("""SELECT event_id, amount, merchant_name, first_score, first_decision, second_score, second_decision,
  left(llm_reason, 60) AS reason_start FROM cmp WHERE NOT decisions_agree ORDER BY score_diff DESC, event_id LIMIT 5""", "cmp"), "first_score second_score", digits=8)
def e5(spark, d) -> DataFrame:
    top = compared(spark, d).where(~F.col("decisions_agree")).orderBy(F.desc("score_diff"), "event_id").limit(5)
    return top.select("event_id", "amount", "merchant_name", "first_score", "first_decision", "second_score",
                      "second_decision", F.substring("llm_reason", 1, 60).alias("reason_start"))


@query("d15_drift_check", oracle(f"""SELECT 1440 AS window_minutes, count(*) AS compared, count(*) FILTER (WHERE NOT decisions_agree) AS disagreements,
  0.05::DOUBLE AS threshold, CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE NOT decisions_agree) / count(*) ELSE 0 END > 0.05 AS alarm_fired,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE NOT decisions_agree) / count(*) ELSE 0 END AS disagreement_rate
  FROM cmp WHERE scored_at_ms >= {MAXT.format('cmp')} - 86400000""", "cmp"), "disagreement_rate", digits=4)
def d15(spark, d) -> DataFrame:
    c = compared(spark, d)
    return A.drift_check(c, A.latest(c, "scored_at_ms"), 1440)


_CHECK = ("SELECT {0} AS check_id, {1} - {0} * 86400000 AS checked_at_ms, 1440 AS window_minutes, count(*) AS compared, count(*) FILTER (WHERE NOT decisions_agree) AS disagreements, "
          "0.05::DOUBLE AS threshold, coalesce(count(*) FILTER (WHERE NOT decisions_agree) / nullif(count(*), 0), 0) > 0.05 AS alarm_fired, "
          "coalesce(count(*) FILTER (WHERE NOT decisions_agree) / nullif(count(*), 0), 0) AS disagreement_rate "
          "FROM cmp WHERE scored_at_ms BETWEEN {1} - {0} * 86400000 - 86400000 AND {1} - {0} * 86400000")


@query("e6_drift_history", oracle("SELECT * FROM (" + " UNION ALL ".join(_CHECK.format(i, MAXT.format("cmp")) for i in range(3)) + ") ORDER BY checked_at_ms DESC LIMIT 2", "cmp"),
       "disagreement_rate", digits=4)
def e6_drift_history(spark, d) -> DataFrame:
    """Three daily checks are recorded, one of them twice; the report shows the latest two."""
    c = compared(spark, d)
    history = BatchTable(spark, f"{scratch_root(spark).rstrip('/')}/txnguard/drift-{uuid.uuid4().hex}", A.DRIFT_CHECK)
    for i in (0, 1, 2, 1):
        as_of = A.latest(c, "scored_at_ms") - i * fx.DAY_MS
        A.record_check(history, i, A.drift_check(c, as_of, 1440), as_of)
    return A.check_history(history, 2)


@query("d15_drift_by_window", oracle("""SELECT w AS window_start_ms, count(*) AS compared, count(*) FILTER (WHERE NOT decisions_agree) AS disagreements,
  count(*) FILTER (WHERE NOT decisions_agree) / count(*) AS disagreement_rate, count(*) FILTER (WHERE NOT decisions_agree) / count(*) > 0.05 AS alarm_fired
  FROM (SELECT *, scored_at_ms // 3600000 * 3600000 AS w FROM cmp) GROUP BY w""", "cmp"), "disagreement_rate", digits=4)
def d15_windows(spark, d) -> DataFrame:
    return A.drift_by_window(compared(spark, d))


@query("d16_consumer_lag", oracle("""SELECT 'g' || (k % 4) || '/' || event_type AS scope, sum(id % 50)::DOUBLE AS lag FROM fx WHERE k % 6 <> 0 GROUP BY ALL""", "fx"), "lag")
def d16(spark, d) -> DataFrame:
    offsets = fx.base(spark, d).selectExpr("concat('g', cast(k % 4 AS string)) AS `group`", "event_type AS topic",
                                           "user_id AS partition", "if(k % 6 = 0, '-', cast(id % 50 AS string)) AS lag")
    return A.lag_by_scope(offsets)


@query("d17_request_headroom", oracle(f"SELECT count(*) AS used, greatest(0, 25 - count(*)) AS headroom FROM sc2 WHERE scored_at_ms > {MAXT.format('sc2')} - 60000", "sc2"))
def d17(spark, d) -> DataFrame:
    r = fx.second_scored(spark, d)
    return A.request_headroom(r, A.latest(r, "scored_at_ms"))


@query("d18_latency_percentiles", oracle("""SELECT count(*) AS events, quantile_cont(scoring_latency_ms, 0.5) AS p50_ms, quantile_cont(scoring_latency_ms, 0.95) AS p95_ms,
  quantile_cont(scoring_latency_ms, 0.99) AS p99_ms, max(scoring_latency_ms) AS max_ms FROM sc""", "sc"), "p50_ms p95_ms p99_ms")
def d18(spark, d) -> DataFrame:
    return A.latency_percentiles(fx.scored(spark, d))


@query("d18_amount_quantiles", oracle("""SELECT merchant_id_hash, count(*) AS n, quantile_cont(amount, 0.5) AS q0, quantile_cont(amount, 0.95) AS q1 FROM sc GROUP BY merchant_id_hash""", "sc"), "q0 q1")
def d18_amounts(spark, d) -> DataFrame:
    """Exact quantiles of a continuous column per merchant, safe for one hot merchant."""
    return prefix.exact_quantiles(fx.scored(spark, d), "amount", [0.5, 0.95], ["merchant_id_hash"])


@query("d19_nearest_rank", oracle("""SELECT max(v) FILTER (WHERE i = round_even(0.5 * (n - 1), 0)) AS p0, max(v) FILTER (WHERE i = round_even(0.95 * (n - 1), 0)) AS p1,
  max(v) FILTER (WHERE i = round_even(0.99 * (n - 1), 0)) AS p2 FROM (SELECT scoring_latency_ms AS v, row_number() OVER (ORDER BY scoring_latency_ms) - 1 AS i, count(*) OVER () AS n FROM sc)""", "sc"))
def d19(spark, d) -> DataFrame:
    return prefix.nearest_rank(fx.scored(spark, d), "scoring_latency_ms", [50, 95, 99])


@query("e8_rolling_latency", oracle("""SELECT event_id, arr[1 + round_even(0.5 * (len(arr) - 1), 0)::INT] AS p50, arr[1 + round_even(0.95 * (len(arr) - 1), 0)::INT] AS p95,
  arr[1 + round_even(0.99 * (len(arr) - 1), 0)::INT] AS p99, arr[1 + round_even(0.95 * (len(arr) - 1), 0)::INT] < 100 AS slo_ok
  FROM (SELECT event_id, list_sort(list(scoring_latency_ms) OVER (PARTITION BY mcc ORDER BY scored_at_ms, event_id::BIGINT ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)) AS arr FROM sc)""", "sc"))
def e8(spark, d) -> DataFrame:
    s = fx.scored(spark, d).select("event_id", "mcc", "scored_at_ms", "scoring_latency_ms", F.col("event_id").cast("long").alias("seq"))
    return rolling.rolling_percentiles(s, "mcc", ["scored_at_ms", "seq"], "scoring_latency_ms", 500).select("event_id", "p50", "p95", "p99", "slo_ok")


@query("d38_live_quality", oracle(f"""SELECT count(*) AS events, count(*) - count(DISTINCT event_id) AS duplicates,
  count(*) FILTER (WHERE decision NOT IN ('ALLOW', 'REVIEW', 'BLOCK') OR fraud_score < 0 OR fraud_score > 1 OR scoring_latency_ms IS NULL) AS invalid,
  count(*) FILTER (WHERE NOT blocklist_hit AND decision <> {decide('fraud_score', 0.10, 0.18)}) AS off_policy,
  count(*) FILTER (WHERE NOT regexp_full_match(card_token, '[0-9a-f]{{16}}|null') OR NOT regexp_full_match(ip_address_hash, '[0-9a-f]{{16}}|null') OR NOT regexp_full_match(device_fingerprint_hash, '[0-9a-f]{{16}}|null')) AS bad_tokens,
  round(100.0 * count(*) FILTER (WHERE scoring_latency_ms < 100) / count(*), 1)::DOUBLE AS under_budget_pct, 0.0::DOUBLE AS age_s
  FROM dlv WHERE scored_at_ms > {MAXT.format('dlv')} - 864000000""", "dlv"))
def d38(spark, d) -> DataFrame:
    s = fx.deliveries(spark, d)
    return A.live_quality(s, A.latest(s, "scored_at_ms"), window_ms=10 * fx.DAY_MS)


def explained(spark, d) -> DataFrame:
    """Which flagged events were explained: all but every eleventh."""
    return fx.scored_full(spark, d).where(X.flagged("decision") & (F.col("id") % 11 != 0)).select("event_id")


@query("c4_explanation_coverage", oracle(f"""SELECT count(*) AS flagged, count(*) FILTER (WHERE id % 11 <> 0) AS explained FROM scf
  WHERE decision <> 'ALLOW' AND scored_at_ms BETWEEN {MAXT.format('sc')} - 864000000 AND {MAXT.format('sc')} - 300000""", "scf", "sc"))
def c4(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    return A.explanation_coverage(s, explained(spark, d), A.latest(s, "scored_at_ms"), 10 * fx.DAY_MS)


@query("d38_quality_verdicts", oracle(f"""WITH w AS (SELECT * FROM sc WHERE scored_at_ms > {MAXT.format('sc')} - 864000000),
  f AS (SELECT 100.0 * count(*) FILTER (WHERE id % 11 <> 0) / count(*) AS pct FROM scf WHERE decision <> 'ALLOW' AND scored_at_ms BETWEEN {MAXT.format('sc')} - 864000000 AND {MAXT.format('sc')} - 300000),
  v AS (SELECT 'stream flowing' AS "check", 0.0 AS value, true AS passed UNION ALL SELECT 'no duplicates', 0, true UNION ALL SELECT 'fully decided', 0, true
   UNION ALL SELECT 'policy followed', count(*), count(*) = 0 FROM w WHERE NOT blocklist_hit AND decision <> {decide('fraud_score', 0.10, 0.18)}
   UNION ALL SELECT 'within budget', round(100.0 * count(*) FILTER (WHERE scoring_latency_ms < 100) / count(*), 1), round(100.0 * count(*) FILTER (WHERE scoring_latency_ms < 100) / count(*), 1) >= 95 FROM w
   UNION ALL SELECT 'tokens only', 0, true UNION ALL SELECT 'every flag explained', round(pct, 1), round(pct, 1) >= 95 FROM f)
  SELECT * FROM v""".replace("WITH w", ", w", 1), "scf", "sc"), "value")
def d38_verdicts(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    now = A.latest(s, "scored_at_ms")
    return A.quality_verdicts(A.live_quality(s, now, window_ms=10 * fx.DAY_MS),
                              A.explanation_coverage(s, explained(spark, d), now, 10 * fx.DAY_MS))


def _trend_sql(by: str, src: str) -> str:
    return f"""SELECT {by}, count(*) AS events, count(*) FILTER (WHERE decision = 'BLOCK') AS blocks, count(*) FILTER (WHERE blocklist_hit) AS list_hits,
  avg(fraud_score) AS avg_score FROM {src} GROUP BY {by}"""


for _by, _sql in (("event_hour", f"(SELECT *, {HOUR.format('scored_at_ms')} AS event_hour FROM sc)"),
                  ("event_day_of_week", "(SELECT *, strftime(make_timestamp(scored_at_ms * 1000), '%A') AS event_day_of_week FROM sc)"),
                  ("mcc", "sc"), ("blocklist_reason", "sc"), ("blocklist_tier", "sc")):
    @query(f"d39_trend_{_by}", oracle(_trend_sql(_by, _sql), "sc"), "avg_score")
    def _trend(spark, d, by=_by) -> DataFrame:
        return A.trend(schemas.with_calendar(fx.scored(spark, d)), by)


@query("d39_week_over_week", oracle("""SELECT strftime(w, '%Y-%m-%d') AS week, events, flagged, flagged / events AS flagged_rate, flagged / events - lag(flagged / events) OVER (ORDER BY w) AS change
  FROM (SELECT date_trunc('week', make_timestamp(scored_at_ms * 1000)) AS w, count(*) AS events, count(*) FILTER (WHERE decision <> 'ALLOW') AS flagged FROM sc GROUP BY 1)""", "sc"), "flagged_rate change")
def d39_weeks(spark, d) -> DataFrame:
    return A.week_over_week(fx.scored(spark, d))


@query("d42_reconcile", oracle("SELECT count(*) AS produced, count(*) FILTER (WHERE id % 1000 <> 7) AS scored, count(*) FILTER (WHERE id % 1000 = 7) AS lost FROM scf", "scf"))
def d42(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d)
    return A.reconcile(s.select("event_id"), s.where("id % 1000 <> 7").select("event_id"))


# --- feeds ------------------------------------------------------------------------

@query("e6_latest_flagged", oracle("""SELECT strftime(make_timestamp((scored_at_ms + 19800000) * 1000), '%H:%M:%S') AS time_ist, left(event_id, 8) AS event, decision,
  round(fraud_score, 3) AS score FROM sc WHERE decision <> 'ALLOW' ORDER BY scored_at_ms DESC, event_id LIMIT 6""", "sc"))
def e6_flagged(spark, d) -> DataFrame:
    top = fx.scored(spark, d).where(X.flagged("decision")).orderBy(F.desc("scored_at_ms"), "event_id").limit(6)
    return top.select(X.clock_text("scored_at_ms").alias("time_ist"), F.substring("event_id", 1, 8).alias("event"),
                      "decision", F.round("fraud_score", 3).alias("score"))


@query("e6_latest_comparisons", oracle("""SELECT left(event_id, 8) AS event, first_decision, round(first_score, 3) AS first_score, second_decision, round(second_score, 3) AS second_score,
  second_latency_ms, left(llm_reason, 60) AS llm_reason FROM cmp ORDER BY scored_at_ms DESC, event_id LIMIT 8""", "cmp"))
def e6_comparisons(spark, d) -> DataFrame:
    top = compared(spark, d).orderBy(F.desc("scored_at_ms"), "event_id").limit(8)
    return top.select(F.substring("event_id", 1, 8).alias("event"), "first_decision", F.round("first_score", 3).alias("first_score"),
                      "second_decision", F.round("second_score", 3).alias("second_score"), "second_latency_ms",
                      F.substring("llm_reason", 1, 60).alias("llm_reason"))


@query("e11_share_of_total", oracle("SELECT mcc, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM sc GROUP BY mcc", "sc"), "pct")
def e11(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    return s.groupBy("mcc").agg(F.count(F.lit(1)).alias("n")).withColumn("pct", 100.0 * F.col("n") / s.agg(F.count(F.lit(1))).scalar())


@query("b27_agreement_flags", oracle("""SELECT event_id, decision <> 'ALLOW' AS flagged, (decision <> 'ALLOW') = (label = 1) AS agrees FROM scf""", "scf"))
def b27(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d).withColumn("verdict", F.when(F.col("label") == 1, "FRAUD").otherwise("LEGIT"))
    return s.select("event_id", X.flagged("decision").alias("flagged"), X.agrees("decision", "verdict").alias("agrees"))


# --- appeals and feedback -------------------------------------------------------------

cte("areq", f"""SELECT CASE WHEN id % 5 = 0 THEN 'unknown-' || id ELSE CAST(id AS VARCHAR) END AS event_id, 'name ' || (id % 11) AS appellant_name,
  CASE WHEN id % 7 = 0 THEN 'robot' WHEN id % 3 = 0 THEN 'analyst' ELSE 'customer' END AS appellant_role, 'appeal reason ' || id AS reason,
  ms + {fx.DAY_MS} AS submitted_at_ms FROM fx WHERE id % 37 = 0""", "fx")
cte("aj", f"""SELECT r.*, s.decision AS original_decision, s.fraud_score AS original_fraud_score, {EVENT_COLS.replace('event_id, ', '')},
  CASE WHEN appellant_role NOT IN ('customer', 'analyst', 'system') THEN 'role not allowed' WHEN s.event_id IS NULL THEN 'event ' || r.event_id || ' not found'
  WHEN s.decision = 'ALLOW' THEN 'event was ALLOW (no appeal needed)' END AS error FROM areq r LEFT JOIN sc s USING (event_id)""", "areq", "sc")


def appeal_parts(spark, d) -> dict[str, DataFrame]:
    return cases.submit_appeals(fx.appeal_requests(spark, d), fx.scored(spark, d))


@query("f7_appeals_accepted", oracle("""SELECT event_id, appellant_name, appellant_role, reason, submitted_at_ms, original_decision, original_fraud_score, 4 AS whitelisted,
  row_number() OVER (ORDER BY submitted_at_ms, event_id) AS appeal_id FROM aj WHERE error IS NULL""", "aj"), "original_fraud_score", digits=8)
def f7_accepted(spark, d) -> DataFrame:
    ok = cases.numbered(appeal_parts(spark, d)["accepted"], ["submitted_at_ms", "event_id"], "appeal_id")
    return ok.select("event_id", "appellant_name", "appellant_role", "reason", "submitted_at_ms", "original_decision",
                     "original_fraud_score", F.size("whitelisted_entities").alias("whitelisted"), "appeal_id")


@query("c3_appeals_rejected", oracle("SELECT event_id, appellant_role, error FROM aj WHERE error IS NOT NULL", "aj"))
def c3(spark, d) -> DataFrame:
    return appeal_parts(spark, d)["rejected"]


@query("f7_appeal_whitelist", oracle(f"""SELECT 'white' AS list, t AS entity_type, i AS entity_id, 'appeal by ' || appellant_role || ': ' || left(reason, 80) AS reason, 0 AS block_count,
  submitted_at_ms AS added_at_ms, submitted_at_ms + {K.APPEAL_WHITE_TTL_S * 1000} AS expires_at_ms FROM (
  SELECT *, unnest(['card', 'merchant', 'ip', 'device']) AS t, unnest([card_token, merchant_id_hash, ip_address_hash, device_fingerprint_hash]) AS i FROM aj WHERE error IS NULL)""", "aj"))
def f7_white(spark, d) -> DataFrame:
    return appeal_parts(spark, d)["whitelist"]


@query("f7_appeal_reemitted", oracle(f"SELECT {EVENT_COLS.replace('source_label', chr(39) + 'appeal' + chr(39) + ' AS source_label')} FROM aj WHERE error IS NULL", "aj"))
def f7_reemitted(spark, d) -> DataFrame:
    return appeal_parts(spark, d)["reemitted"]


def appeals(spark, d) -> DataFrame:
    return cases.numbered(appeal_parts(spark, d)["accepted"], ["submitted_at_ms", "event_id"], "appeal_id")


def resolutions(spark, d) -> DataFrame:
    """Closes every third appeal; some numbers do not exist."""
    return fx.base(spark, d).where("id % 37 = 0").selectExpr(
        "id div 37 * 3 + 3 AS appeal_id", f"{fx.START_MS + 40 * fx.DAY_MS} AS resolved_at_ms",
        "if(id % 2 = 0, 'ALLOW', 'BLOCK') AS final_decision", "cast(id % 10 AS double) / 10 AS final_fraud_score", "'reviewed' AS notes")


cte("apl", "SELECT *, row_number() OVER (ORDER BY submitted_at_ms, event_id) AS appeal_id FROM aj WHERE error IS NULL", "aj")
cte("res", f"""SELECT id // 37 * 3 + 3 AS appeal_id, {fx.START_MS + 40 * fx.DAY_MS} AS resolved_at_ms, CASE WHEN id % 2 = 0 THEN 'ALLOW' ELSE 'BLOCK' END AS final_decision,
  (id % 10)::DOUBLE / 10 AS final_fraud_score FROM fx WHERE id % 37 = 0""", "fx")


@query("f8_unresolved_appeals", oracle(f"""SELECT appeal_id, event_id, appellant_role, submitted_at_ms, original_decision, original_fraud_score, left(reason, 80) AS reason_preview,
  ({fx.START_MS + 41 * fx.DAY_MS} - submitted_at_ms) / 60000.0 AS minutes_waiting FROM apl WHERE appeal_id NOT IN (SELECT appeal_id FROM res)""", "apl", "res"),
       "original_fraud_score minutes_waiting", digits=1)
def f8(spark, d) -> DataFrame:
    after, _ = cases.resolve(appeals(spark, d), resolutions(spark, d))
    return cases.unresolved(after, F.lit(fx.START_MS + 41 * fx.DAY_MS))


@query("f9_resolve_appeals", oracle("""SELECT appeal_id, original_decision, resolved_at_ms, final_decision, final_fraud_score FROM apl LEFT JOIN res USING (appeal_id)""", "apl", "res"), "final_fraud_score")
def f9(spark, d) -> DataFrame:
    after, _ = cases.resolve(appeals(spark, d), resolutions(spark, d))
    return after.select("appeal_id", "original_decision", "resolved_at_ms", "final_decision", "final_fraud_score")


@query("f9_resolution_outcomes", oracle("""SELECT appeal_id, apl.event_id IS NOT NULL AS ok, CASE WHEN apl.event_id IS NULL THEN 'appeal not found or already resolved' END AS error FROM res LEFT JOIN apl USING (appeal_id)""", "apl", "res"))
def f9_outcomes(spark, d) -> DataFrame:
    return cases.resolve(appeals(spark, d), resolutions(spark, d))[1]


@query("d39_overturn_rate", oracle("""SELECT (SELECT count(*) FROM sc WHERE decision = 'BLOCK') AS blocks, count(*) AS overturned,
  count(*) / (SELECT count(*) FROM sc WHERE decision = 'BLOCK') AS overturn_rate FROM apl JOIN res USING (appeal_id) WHERE original_decision = 'BLOCK' AND final_decision <> 'BLOCK'""", "apl", "res", "sc"), "overturn_rate")
def d39_overturn(spark, d) -> DataFrame:
    after, _ = cases.resolve(appeals(spark, d), resolutions(spark, d))
    return A.overturn_rate(after, fx.scored(spark, d))


cte("freq0", f"""SELECT id, CASE WHEN id % 8 = 0 THEN 'unknown-' || id ELSE event_id END AS event_id, 'analyst ' || (id % 4) AS analyst_name,
  CASE WHEN id % 35 = 0 THEN 'intern' WHEN id % 2 = 0 THEN 'system' ELSE 'analyst' END AS analyst_role,
  CASE WHEN id % 25 = 0 THEN 'maybe' WHEN label = 1 THEN 'fraud' WHEN id % 6 = 0 THEN 'FRAUD' ELSE 'legit' END AS verdict, ms + {2 * fx.DAY_MS} AS submitted_at_ms
  FROM lab WHERE id % 9 = 0""", "lab")
cte("fj", """SELECT r.event_id, analyst_name, analyst_role, upper(verdict) AS analyst_verdict, submitted_at_ms, s.decision AS model_decision, s.fraud_score AS model_fraud_score, '' AS notes,
  CASE WHEN upper(verdict) NOT IN ('FRAUD', 'LEGIT') THEN 'verdict not allowed' WHEN analyst_role NOT IN ('analyst', 'system') THEN 'role not allowed'
   WHEN s.event_id IS NULL THEN 'event ' || r.event_id || ' not found' END AS error
  FROM (SELECT * FROM freq0 UNION ALL SELECT id, event_id, analyst_name, analyst_role, 'LEGIT', submitted_at_ms + 1000 FROM freq0 WHERE id % 4 = 1) r LEFT JOIN sc s USING (event_id)""", "freq0", "sc")
cte("fb", "SELECT * EXCLUDE (error), (model_decision <> 'ALLOW') = (analyst_verdict = 'FRAUD') AS model_agreed FROM fj WHERE error IS NULL", "fj")


def feedback_parts(spark, d) -> dict[str, DataFrame]:
    return cases.submit_feedback(fx.feedback_requests(spark, d), fx.scored(spark, d))


@query("f10_feedback_accepted", oracle("SELECT * FROM fb", "fb"), "model_fraud_score", digits=8)
def f10(spark, d) -> DataFrame:
    return feedback_parts(spark, d)["accepted"]


@query("f10_feedback_rejected", oracle("SELECT event_id, analyst_role, analyst_verdict, error FROM fj WHERE error IS NOT NULL", "fj"))
def f10_rejected(spark, d) -> DataFrame:
    return feedback_parts(spark, d)["rejected"]


@query("f11_training_labels", oracle("""SELECT event_id, CASE WHEN first(analyst_verdict ORDER BY submitted_at_ms DESC) = 'FRAUD' THEN 1 ELSE 0 END AS label,
  max(submitted_at_ms) AS labelled_at_ms FROM fb GROUP BY event_id""", "fb"))
def f11(spark, d) -> DataFrame:
    return cases.training_labels(feedback_parts(spark, d)["accepted"])


@query("d14_feedback_agreement", oracle("""SELECT count(*) AS total_feedback, count(*) FILTER (WHERE model_agreed) AS agreements, avg(CASE WHEN model_agreed THEN 1 ELSE 0 END) AS agreement_rate,
  count(*) FILTER (WHERE analyst_verdict = 'FRAUD') AS analyst_fraud, count(*) FILTER (WHERE analyst_verdict = 'LEGIT') AS analyst_legit FROM fb""", "fb"), "agreement_rate", digits=4)
def d14(spark, d) -> DataFrame:
    return A.feedback_agreement(feedback_parts(spark, d)["accepted"])


@query("c5_untouched_blocks", oracle("""SELECT event_id, amount, merchant_name, mcc FROM sc WHERE decision = 'BLOCK' AND event_id NOT IN (SELECT event_id FROM apl) AND event_id NOT IN (SELECT event_id FROM fb)""", "sc", "apl", "fb"))
def c5(spark, d) -> DataFrame:
    out = A.untouched_blocks(fx.scored(spark, d), appeal_parts(spark, d)["accepted"], feedback_parts(spark, d)["accepted"])
    return out.select("event_id", "amount", "merchant_name", "mcc")


@query("e6_feedback_history", oracle("SELECT event_id, analyst_role, model_decision, analyst_verdict, model_agreed, submitted_at_ms FROM fb ORDER BY submitted_at_ms DESC, event_id LIMIT 20", "fb"))
def e6_feedback(spark, d) -> DataFrame:
    f = feedback_parts(spark, d)["accepted"]
    return f.orderBy(F.desc("submitted_at_ms"), "event_id").limit(20).select(
        "event_id", "analyst_role", "model_decision", "analyst_verdict", "model_agreed", "submitted_at_ms")


@query("c9_label_join", oracle("""SELECT t.event_id, l.isFraud AS label, l.ProductCD, count(l.TransactionID) OVER (PARTITION BY t.event_id) AS matches
  FROM tx t LEFT JOIN (SELECT TransactionID, isFraud, ProductCD, TransactionAmt, card1 FROM rawt) l ON l.TransactionID::VARCHAR = t.event_id""", "tx", "rawt"))
def c9(spark, d) -> DataFrame:
    """Labels joined on (second, customer, amount in cents), with the matches per event shown."""
    raw = fx.raw_rows(spark, d).selectExpr(
        "TransactionDT AS second", "cast(cast(card1 AS long) AS string) AS customer_id", "round(TransactionAmt, 2) AS amt",
        "isFraud AS label", "ProductCD")
    events = fx.transactions(spark, d).selectExpr(
        "event_id", f"(event_timestamp_ms - {fx.START_MS}) div 1000 AS second", "customer_id", "round(amount, 2) AS amt")
    return patterns.guarded_label_join(events, raw, ["second", "customer_id", "amt"])


# --- described rules and profiles ---------------------------------------------------

@query("f12_burst_rule", oracle("""SELECT event_id, n FROM (SELECT event_id, count(*) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN 172800000 PRECEDING AND CURRENT ROW) AS n FROM tx) WHERE n >= 5""", "tx"))
def f12(spark, d) -> DataFrame:
    out = patterns.burst(fx.transactions(spark, d), window_s=120 * 1440, at_least=5, block_ms=fx.DAY_MS)
    return out.select("event_id", F.col("n_burst").alias("n"))


cte("spd", """SELECT event_id, geo_distance_km / ((event_timestamp_ms - prev) / 3600000.0) AS kmh FROM (
  SELECT event_id, geo_distance_km, event_timestamp_ms, max(event_timestamp_ms) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM tx) WHERE prev IS NOT NULL""", "tx")


@query("f13_travel_rule", oracle("SELECT event_id, kmh FROM spd WHERE kmh > 1000", "spd"), "kmh")
def f13(spark, d) -> DataFrame:
    return patterns.impossible_travel(fx.transactions(spark, d), block_ms=fx.DAY_MS).select("event_id", "kmh")


cte("risk", """SELECT event_id FROM (SELECT event_id, mcc, row_number() OVER (PARTITION BY card_token, mcc ORDER BY event_timestamp_ms, event_id) AS nth,
  row_number() OVER (PARTITION BY card_token ORDER BY event_timestamp_ms, event_id) AS seq FROM tx) WHERE mcc = '7995' AND nth = 1 AND seq > 1""", "tx")


@query("f14_merchant_risk_rule", oracle("SELECT event_id FROM risk", "risk"))
def f14(spark, d) -> DataFrame:
    return patterns.new_risky_merchant(fx.transactions(spark, d)).select("event_id")


_PAT = f"""SELECT event_id, 'Velocity (card testing)' AS pattern, 'velocity-rule: >=5 auths/card in 172800s' AS rule, 'REVIEW' AS rule_decision,
   n || ' authorisations on the card within the window' AS signals FROM (SELECT event_id, count(*) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN 172800000 PRECEDING AND CURRENT ROW) AS n FROM tx) WHERE n >= 5
  UNION ALL SELECT event_id, 'Geo-impossible travel', 'geo-rule: implied speed > 1000 km/h', 'BLOCK', 'implied speed ' || printf('%.0f', kmh) || ' km/h' FROM spd WHERE kmh > 1000
  UNION ALL SELECT event_id, 'MCC mismatch', 'mcc-risk-rule: high-risk MCC vs cardholder history', 'REVIEW', 'first charge at MCC 7995 on this card' FROM risk"""


@query("f15_rule_vs_model", oracle(f"""SELECT p.event_id, pattern, rule, rule_decision, fraud_score AS model_score, decision AS model_decision,
  '[' || pattern || '] Rule ''' || rule || ''' fired -> ' || rule_decision || '. Red flags: ' || signals || '. The model scored this ' || decision || ' (' || printf('%.3f', fraud_score) || ').' AS narrative
  FROM ({_PAT}) p JOIN sc USING (event_id)""", "tx", "spd", "risk", "sc"), "model_score", digits=8)
def f15(spark, d) -> DataFrame:
    """The rules that fired beside the model's view."""
    e = fx.transactions(spark, d)
    return patterns.rule_vs_model(patterns.fired(e, burst_window_s=120 * 1440, block_ms=fx.DAY_MS), fx.scored(spark, d))


@query("e14_amount_zscore", oracle("""SELECT event_id, (amount - m) / s AS z FROM (SELECT event_id, amount, avg(amount) OVER w AS m, stddev_samp(amount) OVER w AS s, count(*) OVER w AS n
  FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp_ms RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE n >= 2 AND s > 0""", "tx"), "z", digits=4)
def e14(spark, d) -> DataFrame:
    return patterns.amount_zscore(fx.transactions(spark, d), block_ms=fx.DAY_MS)


@query("e15_merchant_chargebacks", oracle("""SELECT event_id, coalesce(cb, 0) / n AS chargeback_rate FROM (SELECT event_id, count(*) OVER w AS n, sum(label) OVER w AS cb FROM lab
  WINDOW w AS (PARTITION BY merchant_id_hash ORDER BY event_timestamp_ms RANGE BETWEEN 604800000 PRECEDING AND 1 PRECEDING)) WHERE n > 0""", "lab"), "chargeback_rate")
def e15(spark, d) -> DataFrame:
    e = fx.with_event_columns(fx.base(spark, d)).withColumn("label", fx.label())
    return patterns.merchant_chargebacks(e, "label", 7 * fx.DAY_MS, fx.DAY_MS)
