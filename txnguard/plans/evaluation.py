"""Queries: evaluation, drift, gates and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard import constants as K, schemas
from txnguard.durable import materialize
from txnguard.operators import evaluate as V, features, merge, quality
from txnguard.plans.featurize import corrected_sql, richer_events, training_sql
from txnguard.plans.registry import query
from txnguard.plans.sql_base import HOUR, cte, oracle
from txnguard.sources import fixtures as fx

# Two models on the same rows, with label, amount and segment columns.
cte("ev", f"""SELECT s.event_id, s.label, s.amount, s.fraud_score AS score, round(s.fraud_score * 0.6 + (s.id % 7) / 20.0, 8)::DOUBLE AS challenger,
  r.ProductCD, {HOUR.format('s.ms')} AS hour, coalesce(r.card6, 'missing') AS card6, coalesce(r.P_emaildomain, 'missing') AS P_emaildomain,
  r.TransactionDT // 86400 AS day FROM scf s JOIN rawt r ON r.TransactionID = s.id""", "scf", "rawt")


def scored_rows(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d)
    raw = {n: fx.RAW_SQL[n] for n in ("ProductCD", "card6", "P_emaildomain", "TransactionDT")}
    return s.selectExpr(
        "event_id", "label", "amount", "fraud_score AS score", "round(fraud_score * 0.6 + (id % 7) / 20, 8) AS challenger",
        f"{raw['ProductCD']} AS ProductCD", "hour(timestamp_millis(ms)) AS hour", f"coalesce({raw['card6']}, 'missing') AS card6",
        f"coalesce({raw['P_emaildomain']}, 'missing') AS P_emaildomain", f"({raw['TransactionDT']}) div 86400 AS day")


def _auc(src: str, score: str = "score", keys: str = "") -> str:
    """AUC by midranks, average precision by cumulative precision."""
    part = f"PARTITION BY {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {k}CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN (sum(CASE WHEN label = 1 THEN mid END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label)::DOUBLE * sum(1 - label)) END AS roc_auc,
  CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN sum(label * tp::DOUBLE / seen) / sum(label) END AS pr_auc
  FROM (SELECT *, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER (PARTITION BY {k}{score}) - 1) / 2.0 AS mid,
    sum(label) OVER ({part} ORDER BY {score} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    count(*) OVER ({part} ORDER BY {score} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM {src}) {group}"""


def _conf(src: str, t: str = "0.5", score: str = "score", keys: str = "") -> str:
    k, group = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1, CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS fpr,
  1 - CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS specificity FROM (SELECT {k}count(*) FILTER (WHERE {score} >= {t} AND label = 1) AS tp,
  count(*) FILTER (WHERE {score} >= {t} AND label = 0) AS fp, count(*) FILTER (WHERE {score} < {t} AND label = 0) AS tn,
  count(*) FILTER (WHERE {score} < {t} AND label = 1) AS fn FROM {src} {group})"""


RATES = "precision recall f1 fpr specificity"


@query("d23_confusion", oracle(_conf("ev"), "ev"), RATES)
def d23(spark, d) -> DataFrame:
    return V.confusion(scored_rows(spark, d))


@query("d24_roc_auc_d25_pr_auc", oracle(_auc("ev"), "ev"), "roc_auc pr_auc")
def d24(spark, d) -> DataFrame:
    return V.ranking(scored_rows(spark, d))


@query("d24_auc_one_class", oracle("SELECT NULL::DOUBLE AS roc_auc, NULL::DOUBLE AS pr_auc"))
def d24_one_class(spark, d) -> DataFrame:
    return V.ranking(scored_rows(spark, d).where("label = 0"))


@query("d24_auc_document_quality", _auc("(SELECT d.n_chars AS score, l.quality AS label FROM documents d JOIN labels l USING (doc_id))"), "roc_auc pr_auc")
def d24_docs(spark, d) -> DataFrame:
    """A second label set: document length against quality."""
    docs = fx.table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("score"))
    return V.ranking(docs.join(fx.table(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id"))


_GRID = "SELECT DISTINCT round(q, 6) AS threshold FROM (SELECT unnest(quantile_cont(score, [" + ", ".join(
    repr(0.50 + i * (0.99999 - 0.50) / 1499) for i in range(1500)) + "])) AS q FROM ev)"
cte("grid", _GRID, "ev")
_SWEEP = f"""SELECT threshold, {', '.join(RATES.split())}, tp, fp, tn, fn FROM ({_conf('(SELECT g.threshold, e.score, e.label FROM ev e, grid g)', 'threshold', 'score', 'threshold')})"""


@query("d26_threshold_sweep", oracle(_SWEEP, "grid"), RATES)
def d26(spark, d) -> DataFrame:
    rows = scored_rows(spark, d)
    return V.sweep(rows, V.quantile_grid(rows))


@query("d27_operating_points", oracle(f"""SELECT min(threshold) FILTER (WHERE round(fpr, 4) <= 0.02) AS threshold_at_fpr,
  first(threshold ORDER BY round(f1, 4) DESC, threshold) AS threshold_best_f1, max(round(f1, 4)) AS best_f1 FROM ({_SWEEP})""", "grid"), "best_f1")
def d27(spark, d) -> DataFrame:
    rows = scored_rows(spark, d)
    return V.operating_points(V.sweep(rows, V.quantile_grid(rows)))


def _business(src: str, score: str = "score") -> str:
    return " UNION ALL ".join(f"""SELECT '{n}' AS policy, count(*) FILTER (WHERE label = 1) AS frauds, count(*) FILTER (WHERE {score} >= {r} AND label = 1) AS frauds_caught,
  sum(CASE WHEN label = 1 THEN amount ELSE 0 END) AS fraud_amount, sum(CASE WHEN label = 1 AND {score} >= {r} THEN amount ELSE 0 END) AS fraud_amount_caught,
  sum(CASE WHEN label = 1 AND {score} < {r} THEN amount ELSE 0 END) AS fraud_amount_missed, count(*) FILTER (WHERE {score} >= {r} AND label = 0) AS good_flagged,
  count(*) FILTER (WHERE {score} >= {r} AND label = 1) / greatest(count(*) FILTER (WHERE label = 1), 1) AS recall,
  count(*) FILTER (WHERE {score} >= {r} AND label = 0) / greatest(count(*) FILTER (WHERE label = 0), 1) AS fpr,
  count(*) FILTER (WHERE {score} >= {b} AND label = 0) / greatest(count(*) FILTER (WHERE label = 0), 1) AS good_blocked_rate,
  count(*) FILTER (WHERE {score} >= {r} AND label = 1) / greatest(count(*) FILTER (WHERE {score} >= {r}), 1) AS precision,
  1000.0 * count(*) FILTER (WHERE {score} >= {r}) / greatest(count(*), 1) AS alerts_per_1000 FROM {src}""" for n, r, b in V.POLICIES)


BUSINESS = "fraud_amount fraud_amount_caught fraud_amount_missed recall fpr good_blocked_rate precision alerts_per_1000"


@query("d28_business_metrics", oracle(_business("ev"), "ev"), BUSINESS, digits=4)
def d28(spark, d) -> DataFrame:
    return V.business(scored_rows(spark, d))


@query("d29_alert_budget", oracle("""SELECT t AS threshold, count(*) FILTER (WHERE score >= t AND label = 1) / greatest(count(*) FILTER (WHERE label = 1), 1) AS recall,
  sum(CASE WHEN score >= t AND label = 1 THEN amount ELSE 0 END) AS fraud_amount_caught FROM ev, (SELECT quantile_cont(score, 0.98) AS t FROM ev WHERE label = 0) GROUP BY t""", "ev"),
       "threshold recall fraud_amount_caught", digits=5)
def d29(spark, d) -> DataFrame:
    return V.at_alert_budget(scored_rows(spark, d), 0.02)


_SEG = """segm AS (SELECT segment, value, label, unnest(['champion', 'challenger']) AS model, unnest([score, challenger]) AS score FROM (
  SELECT *, unnest(['Product', 'Amount', 'Time of day', 'Card type', 'Email domain']) AS segment, unnest([ProductCD,
   CASE WHEN amount < 50 THEN 'under $50' WHEN amount < 200 THEN '$50-200' WHEN amount < 445 THEN '$200-445' ELSE '$445 and over' END,
   CASE WHEN hour < 6 OR hour >= 22 THEN 'night (22-06)' ELSE 'day (06-22)' END, CASE WHEN card6 IN ('debit', 'credit') THEN card6 ELSE 'other/missing' END,
   CASE WHEN P_emaildomain IN (SELECT P_emaildomain FROM ev GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) THEN P_emaildomain ELSE 'other' END]) AS value FROM ev))"""


@query("d30_segments_b28", oracle(f""", {_SEG} SELECT segment, value, model, tp + fp + tn + fn AS transactions, (tp + fn) / (tp + fp + tn + fn) AS fraud_rate, roc_auc, recall, fpr
  FROM ({_auc('segm', 'score', 'segment, value, model')}) JOIN ({_conf('segm', '0.5', 'score', 'segment, value, model')}) USING (segment, value, model)""", "ev"), "fraud_rate roc_auc recall fpr")
def d30(spark, d) -> DataFrame:
    """B28 bands and the five segmentations, both models."""
    return V.segment_table(scored_rows(spark, d), {"champion": "score", "challenger": "challenger"})


@query("d31_score_over_time", oracle(f""", b AS (SELECT *, greatest(1, ceil((day - (SELECT min(day) FROM ev)) * 6 / ((SELECT max(day) FROM ev) - (SELECT min(day) FROM ev))))::BIGINT AS bin FROM ev)
  SELECT bin, first_day, last_day, n, fraud_rate, mean_score, flagged_rate, roc_auc FROM (SELECT bin, min(day) AS first_day, max(day) AS last_day, count(*) AS n, avg(label) AS fraud_rate,
   avg(score) AS mean_score, avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) AS flagged_rate FROM b GROUP BY bin) JOIN ({_auc('b', 'score', 'bin')}) USING (bin)""", "ev"),
       "fraud_rate mean_score flagged_rate roc_auc")
def d31(spark, d) -> DataFrame:
    return V.over_time(scored_rows(spark, d))


_LIVE_RAW = corrected_sql(False)


def both_features(spark, d) -> tuple[DataFrame, DataFrame]:
    raw = fx.raw_rows(spark, d)
    fitted = features.fit(raw)
    off = features.training_features(raw, fitted).withColumn("event_id", F.col("TransactionID").cast("string"))
    return off, features.corrected_features(richer_events(spark, d), fitted, features.FIXES)


_PARITY = " UNION ALL ".join(f"""SELECT '{f}' AS feature, 100.0 * avg(CASE WHEN abs(a.{f} - b.{f}) <= 1e-4 + 1e-5 * abs(b.{f}) THEN 1 ELSE 0 END) AS same_pct,
  100.0 * avg(CASE WHEN b.{f} = -999 THEN 1 ELSE 0 END) AS live_missing_pct, 100.0 * avg(CASE WHEN a.{f} = -999 THEN 1 ELSE 0 END) AS training_missing_pct FROM tr a JOIN out b ON a.TransactionID::VARCHAR = b.event_id"""
    for f in K.FEATURES)
_PARITY_SQL = oracle(f"{_LIVE_RAW.rsplit('SELECT *, round(', 1)[0]}, tr AS MATERIALIZED ({training_sql()}) {_PARITY}", "rawt").replace("out AS (", "out AS MATERIALIZED (", 1)


@query("d32_feature_parity", _PARITY_SQL, "same_pct live_missing_pct training_missing_pct")
def d32(spark, d) -> DataFrame:
    off, live = both_features(spark, d)
    return V.parity(off, live, "event_id", K.FEATURES)


@query("d32_parity_summary", f"""SELECT count(*) FILTER (WHERE same_pct >= 99) AS matching, count(*) FILTER (WHERE same_pct < 1) AS never_matching, count(*) AS features
  FROM ({_PARITY_SQL})""")
def d32_summary(spark, d) -> DataFrame:
    off, live = both_features(spark, d)
    return V.parity_summary(V.parity(off, live, "event_id", K.FEATURES))


_RAW_NAMES = [f.name for f in schemas.RAW.fields]


@query("d33_missing_fractions", oracle(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0.5 AS mostly_missing FROM rawt""" for c in _RAW_NAMES), "rawt"), "missing")
def d33(spark, d) -> DataFrame:
    return V.missing_summary(fx.raw_rows(spark, d), _RAW_NAMES)


@query("d33_worst_columns", oracle("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing FROM rawt""" for c in _RAW_NAMES) + ') ORDER BY missing DESC, "column" LIMIT 4', "rawt"), "missing")
def d33_worst(spark, d) -> DataFrame:
    m = V.missing_summary(fx.raw_rows(spark, d), _RAW_NAMES).drop("mostly_missing")
    return m.orderBy(F.desc("missing"), "column").limit(4)


_NUM = ["TransactionAmt"] + K.RAW_NUMERIC


@query("d34_column_profiles", oracle(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS "distinct",
  min({c}) AS min, max({c}) AS max, avg({c}) AS mean, stddev_samp({c}) AS std, (SELECT {c} FROM rawt WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_common,
  quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75 FROM rawt""" for c in _NUM), "rawt"), "min max mean std most_common q25 median q75", digits=4)
def d34(spark, d) -> DataFrame:
    return V.profile(fx.raw_rows(spark, d), _NUM)


@query("e13_id_difference", oracle("SELECT TransactionID FROM rawt WHERE TransactionID % 5 <> 0 ORDER BY TransactionID", "rawt"))
def e13(spark, d) -> DataFrame:
    """Training ids: all of them without the test part, in order."""
    ids = fx.raw_rows(spark, d).select("TransactionID")
    return merge.difference(ids, ids.where("TransactionID % 5 = 0"), "TransactionID")


@query("d35_class_balance", oracle("""SELECT CASE WHEN TransactionID % 5 = 0 THEN 'test' ELSE 'train' END AS split, count(*) AS rows, sum(isFraud)::BIGINT AS positives,
  sum(1 - isFraud) / nullif(sum(isFraud), 0) AS neg_per_pos, avg(isFraud) AS fraud_rate FROM rawt GROUP BY 1""", "rawt"), "neg_per_pos fraud_rate")
def d35(spark, d) -> DataFrame:
    raw = fx.raw_rows(spark, d).withColumn("split", F.when(F.col("TransactionID") % 5 == 0, "test").otherwise("train"))
    return V.class_balance(raw, "isFraud", ["split"])


_DRIFT = ["TransactionAmt", "card2", "addr1", "dist1", "C13", "D1", "D2", "D15"]
_HALF = 15 * 86_400


def _drift_col(c: str) -> str:
    n, m = f"(SELECT count(*) FROM r WHERE {c} IS NOT NULL)", f"(SELECT count(*) FROM c WHERE {c} IS NOT NULL)"
    return f"""SELECT '{c}' AS "column", max(abs(fr - fc)) AS ks, sum(abs(fr - fc) * (nxt - v)) / greatest((SELECT stddev_pop({c}) FROM r), 1e-3) AS wasserstein,
  (SELECT sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4))) FROM (SELECT least(floor(10.0 * below / {n}), 9) AS b, sum(isr) / {n} AS p, sum(1 - isr) / {m} AS q
    FROM (SELECT isr, (SELECT count(*) FROM r WHERE {c} < u.v) AS below FROM (SELECT {c} AS v, 1 AS isr FROM r WHERE {c} IS NOT NULL UNION ALL SELECT {c}, 0 FROM c WHERE {c} IS NOT NULL) u) GROUP BY 1)) AS psi
  FROM (SELECT v, coalesce(lead(v) OVER (ORDER BY v), v) AS nxt, sum(a) OVER (ORDER BY v) / {n} AS fr, sum(b) OVER (ORDER BY v) / {m} AS fc
    FROM (SELECT v, sum(isr) AS a, sum(1 - isr) AS b FROM (SELECT {c} AS v, 1 AS isr FROM r WHERE {c} IS NOT NULL UNION ALL SELECT {c}, 0 FROM c WHERE {c} IS NOT NULL) GROUP BY v))"""


_DRIFT_SQL = oracle(f", r AS MATERIALIZED (SELECT * FROM rawt WHERE TransactionDT < {_HALF}), c AS MATERIALIZED (SELECT * FROM rawt WHERE TransactionDT >= {_HALF}), dr AS ("
                    + " UNION ALL ".join(_drift_col(c) for c in _DRIFT) + ") SELECT *, ks > 0.1 OR wasserstein > 0.1 OR psi > 0.2 AS drifted FROM dr", "rawt")


def drift_table(spark, d) -> DataFrame:
    raw = fx.raw_rows(spark, d)
    return V.drift(raw.where(F.col("TransactionDT") < _HALF), raw.where(F.col("TransactionDT") >= _HALF), _DRIFT)


@query("d36_drift", _DRIFT_SQL, "ks wasserstein psi")
def d36(spark, d) -> DataFrame:
    return drift_table(spark, d)


@query("d36_drift_share", f"SELECT count(*) FILTER (WHERE drifted) AS drifted, count(*) AS columns, avg(CASE WHEN drifted THEN 1 ELSE 0 END) AS share FROM ({_DRIFT_SQL})", "share")
def d36_share(spark, d) -> DataFrame:
    return V.drift_share(drift_table(spark, d))


@query("d37_replica_check", oracle("""SELECT count(*) AS events, max(abs(fraud_score - r)) AS max_abs_diff, avg(abs(fraud_score - r)) AS mean_abs_diff, avg(CASE WHEN abs(fraud_score - r) <= 1e-6 THEN 1 ELSE 0 END) AS share_within,
  avg(CASE WHEN id % 10 = 3 THEN 0 ELSE 1 END) AS share_same_completeness FROM (SELECT *, fraud_score + CASE WHEN id % 4 = 0 THEN 0.002 ELSE 0 END AS r FROM scf)""", "scf"), "max_abs_diff mean_abs_diff share_within share_same_completeness")
def d37(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d)
    replica = s.selectExpr("event_id", "fraud_score + if(id % 4 = 0, 0.002D, 0D) AS fraud_score", "feature_completeness + if(id % 10 = 3, 0.01D, 0D) AS feature_completeness")
    return V.replica_check(s, replica)


@query("g2_time_split", oracle("""SELECT TransactionID, CASE WHEN TransactionDT <= (SELECT quantile_cont(TransactionDT, 0.72) FROM rawt) THEN 'train'
  WHEN TransactionDT <= (SELECT quantile_cont(TransactionDT, 0.80) FROM rawt) THEN 'val' ELSE 'test' END AS split FROM rawt""", "rawt"))
def g2(spark, d) -> DataFrame:
    return V.time_split(fx.raw_rows(spark, d), "TransactionDT").select("TransactionID", "split")


_MODELS = "(SELECT label, unnest(['champion', 'challenger']) AS model, unnest([score, challenger]) AS score FROM ev)"
_METRICS_SQL = f"SELECT model, roc_auc, pr_auc, tp, fp, tn, fn, {', '.join(RATES.split())} FROM ({_auc(_MODELS, 'score', 'model')}) JOIN ({_conf(_MODELS, '0.5', 'score', 'model')}) USING (model)"


def model_metrics(spark, d) -> DataFrame:
    cells = F.array(F.struct(F.lit("champion").alias("model"), F.col("score")), F.struct(F.lit("challenger").alias("model"), F.col("challenger").alias("score")))
    rows = scored_rows(spark, d).select("label", F.explode(cells).alias("m")).select("label", "m.*")
    return V.metrics(rows, ["model"])


@query("g8_model_metrics", oracle(f"SELECT *, model = (SELECT first(model ORDER BY roc_auc DESC, model) FROM ({_METRICS_SQL})) AS is_champion FROM ({_METRICS_SQL})", "ev"), "roc_auc pr_auc " + RATES)
def g8(spark, d) -> DataFrame:
    fresh = model_metrics(spark, d)
    stale = fresh.limit(1).withColumns({"roc_auc": F.lit(0.1), "is_champion": F.lit(True)})
    return V.metrics_table(stale, fresh)


@query("g7_champion", oracle(f"SELECT first(model ORDER BY roc_auc DESC, model) AS champion, max(roc_auc) AS roc_auc FROM ({_METRICS_SQL})", "ev"), "roc_auc")
def g7(spark, d) -> DataFrame:
    return V.champion(model_metrics(spark, d))


@query("g9_quality_gates", oracle(f""", g AS (SELECT model, unnest(['roc_auc >= 0.9', 'recall >= 0.8', 'fpr <= 0.08', 'precision >= 0.3']) AS gate, unnest([roc_auc >= 0.9, recall >= 0.8, fpr <= 0.08, precision >= 0.3]) AS ok FROM ({_METRICS_SQL}))
  SELECT model, gate, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS result FROM g UNION ALL SELECT model, 'ALL', CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'FAIL' END FROM g GROUP BY model""", "ev"))
def g9(spark, d) -> DataFrame:
    return V.gates(model_metrics(spark, d))


# --- what-if ------------------------------------------------------------------------------

_WHATIF = {"log_amount": 0.75, "is_night": 0.9, "is_high_amount": 1.1, "p_email_missing": 0.8, "email_mismatch": 0.4, "dist1": 0.0001,
           "addr2": 0.002, "M4_freq": -0.5, "R_emaildomain_freq": -0.7, "card1": 0.001}


def _what_if_score(df: DataFrame) -> DataFrame:
    z = " + ".join(f"{w}D * if({f} = -999, 0D, double({f}))" for f, w in _WHATIF.items())
    return df.withColumn("score", F.expr(f"round(1 / (1 + exp(-(-4.6D + {z}))), 6)"))


def what_if(spark, d, alone: bool) -> DataFrame:
    """Every scenario's features scored by one model, then ranked against the labels."""
    raw = fx.raw_rows(spark, d)
    fitted, events = features.fit(raw), richer_events(spark, d)
    labels = raw.selectExpr("cast(TransactionID AS string) AS event_id", "isFraud AS label")
    # stored once with their labels: every scenario reads them, and none is joined again
    events = materialize(events.join(labels, "event_id"), "labelled")
    keep = ("event_id", "label")
    cases = {"all_code_fixes": features.corrected_features(events, fitted, features.FIXES, keep=keep),
             "richer_event": features.corrected_features(events, fitted, features.FIXES, richer=True, keep=keep),
             "offline": features.training_features(raw, fitted).withColumn("event_id", F.col("TransactionID").cast("string")).join(labels, "event_id")}
    if alone:
        cases["live_today"] = features.corrected_features(events, keep=keep)
        cases |= {f"fix:{f}": features.corrected_features(events, fitted, (f,), keep=keep) for f in features.FIXES}
    rows = None
    for name, x in cases.items():
        one = _what_if_score(x).select(F.lit(name).alias("scenario"), "label", "score")
        rows = one if rows is None else rows.unionByName(one)
    rank = materialize(V.metrics(materialize(rows, "scores"), ["scenario"]), "ranked")  # ranking and confusion read the same scores
    base = rank.where(F.col("scenario") == ("live_today" if alone else "offline")).select("roc_auc").scalar()
    return rank.withColumn("auc_change", F.col("roc_auc") - base).select("scenario", "roc_auc", "pr_auc", "auc_change", "tp", "fp", "recall", "fpr")


def _wf(src: str, name: str, key: str) -> str:
    z = " + ".join(f"{w} * CASE WHEN {f} = -999 THEN 0 ELSE {f} END" for f, w in _WHATIF.items())
    return f"SELECT CAST({key} AS VARCHAR) AS event_id, '{name}' AS scenario, round(1 / (1 + exp(-(-4.6 + {z})))::DOUBLE, 6) AS score FROM {src}"


_WF = ("wf AS (SELECT s.*, r.isFraud AS label FROM (" + _wf("out", "all_code_fixes", "event_id") + " UNION ALL " + _wf("rich", "richer_event", "event_id")
       + " UNION ALL " + _wf("tr", "offline", "TransactionID") + ") s JOIN rawt r ON r.TransactionID::VARCHAR = s.event_id)")
_RICH = corrected_sql(True).split(", out AS (", 1)[1].rsplit(") SELECT *, round(", 1)[0]


@query("g10_what_if", oracle(f"""{_LIVE_RAW.rsplit('SELECT *, round(', 1)[0]}, rich AS ({_RICH}), tr AS ({training_sql()}), {_WF}
  SELECT scenario, roc_auc, pr_auc, roc_auc - (SELECT roc_auc FROM ({_auc("(SELECT * FROM wf WHERE scenario = 'offline')")})) AS auc_change, tp, fp, recall, fpr
  FROM ({_auc('wf', 'score', 'scenario')}) JOIN ({_conf('wf', '0.5', 'score', 'scenario')}) USING (scenario)""", "rawt"), "roc_auc pr_auc auc_change recall fpr", digits=5)
def g10(spark, d) -> DataFrame:
    return what_if(spark, d, alone=False)


# The scored features as the live service makes them from the same rows, and the columns that each fix alone replaces.
_LIVE_SCORED = {"log_amount": "CAST(CAST(ln(1 + b.TransactionAmt) AS FLOAT) AS DOUBLE)", "is_night": "out.is_night",
                "is_high_amount": f"CASE WHEN b.TransactionAmt > {K.HIGH_AMOUNT} THEN 1 ELSE 0 END",
                "p_email_missing": "CASE WHEN coalesce(lower(trim(b.P_emaildomain)), 'nan') IN ('', 'nan', 'missing', 'anonymous.com') THEN 1 ELSE 0 END",
                "email_mismatch": "0", "addr2": "coalesce(b.addr2, 0)"}
_FIX_COLUMNS = {"card1": ["card1"], "dist1": ["dist1"], "email": ["email_mismatch", "R_emaildomain_freq"], "p_missing": ["p_email_missing"],
                "addr2": ["addr2"], "high_amount": ["is_high_amount"], "freq_tables": [], "cents": ["log_amount"], "never_seen": ["M4_freq"]}


def _one_fix(columns: list[str]) -> str:
    cols = ", ".join(f"{'out' if f in columns else 'lv'}.{f}" for f in _WHATIF)
    return f"(SELECT lv.event_id, {cols} FROM lv JOIN out ON out.event_id = lv.event_id)"


_LV = ("lv AS MATERIALIZED (SELECT out.event_id, " + ", ".join(f"{_LIVE_SCORED.get(f, '-999')} AS {f}" for f in _WHATIF)
       + " FROM rawt b JOIN out ON out.event_id = b.TransactionID::VARCHAR)")
_WF_ALONE = ("wf AS MATERIALIZED (SELECT s.*, r.isFraud AS label FROM (" + " UNION ALL ".join(
    [_wf("out", "all_code_fixes", "event_id"), _wf("rich", "richer_event", "event_id"), _wf("tr", "offline", "TransactionID"), _wf("lv", "live_today", "event_id")]
    + [_wf(_one_fix(columns), f"fix:{fix}", "event_id") for fix, columns in _FIX_COLUMNS.items()])
    + ") s JOIN rawt r ON r.TransactionID::VARCHAR = s.event_id)")


@query("g10_each_fix_alone", oracle(f"""{_LIVE_RAW.rsplit('SELECT *, round(', 1)[0].replace("out AS (", "out AS MATERIALIZED (", 1)}, rich AS ({_RICH}), tr AS ({training_sql()}), {_LV}, {_WF_ALONE}
  SELECT scenario, roc_auc, pr_auc, roc_auc - (SELECT roc_auc FROM ({_auc("(SELECT * FROM wf WHERE scenario = 'live_today')")})) AS auc_change, tp, fp, recall, fpr
  FROM ({_auc('wf', 'score', 'scenario')}) JOIN ({_conf('wf', '0.5', 'score', 'scenario')}) USING (scenario)""", "rawt"), "roc_auc pr_auc auc_change recall fpr", digits=5)
def g10_alone(spark, d) -> DataFrame:
    return what_if(spark, d, alone=True)


@query("g11_self_checks", oracle("SELECT 'no fixes equals live features' AS \"check\", count(*) AS rows, 0 AS different FROM rawt", "rawt"))
def g11(spark, d) -> DataFrame:
    """The corrected featurizer without corrections must reproduce the live one cell by cell."""
    e = richer_events(spark, d)
    a = features.live_features(e).select("event_id", F.xxhash64(*K.FEATURES, "feature_completeness").alias("a"))
    b = features.corrected_features(e).select("event_id", F.xxhash64(*K.FEATURES, "feature_completeness").alias("b"))
    return a.join(b, "event_id").agg(F.lit("no fixes equals live features").alias("check"), F.count(F.lit(1)).alias("rows"),
                                     F.count_if(F.col("a") != F.col("b")).alias("different"))


# --- data quality -----------------------------------------------------------------------------

def _feature_table(spark, d, corrupt: bool) -> DataFrame:
    raw = fx.raw_rows(spark, d)
    x = features.training_features(raw, features.fit(raw))
    if corrupt:
        x = x.withColumn("is_night", F.when(F.col("TransactionID") == 0, 7.0).otherwise(F.col("is_night")))
    return x


def _checks(spark, d, corrupt: bool) -> DataFrame:
    x = _feature_table(spark, d, corrupt)
    rows = fx.table(spark, d, "events").agg(F.count(F.lit(1))).scalar()
    return quality.feature_checks(x.select(*K.FEATURES), rows).unionByName(
        quality.label_checks(x, fx.raw_rows(spark, d).agg(F.avg("isFraud")).scalar()))


def _bet(c, lo, hi) -> str:
    return f"SELECT 'between' AS \"check\", '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})) = 0 AS passed FROM tr"


_DQ = (", tr AS MATERIALIZED (" + training_sql() + ") "
       + "SELECT 'column count' AS \"check\", '-' AS \"column\", true AS passed UNION ALL SELECT 'column set', '-', true UNION ALL SELECT 'row count', '-', count(*) = (SELECT count(*) FROM events) FROM tr UNION ALL "
       + " UNION ALL ".join(f"SELECT 'not null', '{c}', count(*) = count({c}) FROM tr" for c in K.FEATURES) + " UNION ALL "
       + " UNION ALL ".join([_bet("TransactionAmt", 0, 1_000_000), _bet("hour_of_day", -999, 23), _bet("day_of_week", -999, 6)]) + " UNION ALL "
       + " UNION ALL ".join(f"SELECT 'in set', '{c}', count(*) FILTER (WHERE {c} NOT IN (0, 1)) = 0 FROM tr" for c in K.BINARY_FLAGS) + " UNION ALL "
       + "SELECT 'in set', 'isFraud', count(*) FILTER (WHERE isFraud NOT IN (0, 1)) = 0 FROM rawt UNION ALL SELECT 'not null', 'isFraud', count(*) = count(isFraud) FROM rawt UNION ALL SELECT 'mean', 'isFraud', true")


@query("h1_h3_quality_checks", oracle(_DQ, "rawt"))
def h_checks(spark, d) -> DataFrame:
    """H1-H3: the 59 expectations, one row each."""
    return _checks(spark, d, corrupt=False)


@query("h4_quality_verdict", oracle(f"SELECT count(*) FILTER (WHERE passed) AS passed, count(*) AS total, CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS result FROM ({_DQ.split(') SELECT', 1)[0].replace(', tr', 'WITH tr', 1)}) SELECT{_DQ.split(') SELECT', 1)[1]})", "rawt"))
def h4(spark, d) -> DataFrame:
    return quality.verdict(_checks(spark, d, corrupt=False))


@query("h4_corrupt_flag_fails", oracle("SELECT 58 AS passed, 59 AS total, 'FAIL' AS result FROM (SELECT count(*) FROM rawt)", "rawt"))
def h4_corrupt(spark, d) -> DataFrame:
    return quality.verdict(_checks(spark, d, corrupt=True))


@query("a15_quality_report", oracle(f"SELECT '- [' || CASE WHEN passed THEN 'ok' ELSE 'X' END || '] ' || \"check\" || ' (column=' || \"column\" || ')' AS line FROM ({_DQ.split(') SELECT', 1)[0].replace(', tr', 'WITH tr', 1)}) SELECT{_DQ.split(') SELECT', 1)[1]})", "rawt"))
def a15(spark, d) -> DataFrame:
    return quality.report_lines(_checks(spark, d, corrupt=False))


@query("h5_export_checks", oracle("""SELECT count(*) AS rows, count(*) - count(DISTINCT event_id) AS duplicates, 0 AS missing_values, quantile_cont(scoring_latency_ms, 0.5) AS p50_ms,
  quantile_cont(scoring_latency_ms, 0.95) AS p95_ms, quantile_cont(scoring_latency_ms, 0.99) AS p99_ms, max(scoring_latency_ms) AS max_ms,
  min(feature_completeness) AS completeness_min, max(feature_completeness) AS completeness_max FROM dlv""", "dlv"), "p50_ms p95_ms p99_ms")
def h5(spark, d) -> DataFrame:
    return quality.export_checks(fx.deliveries(spark, d))
