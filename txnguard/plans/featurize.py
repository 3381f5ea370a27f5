"""Queries: records, scalars and features."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from txnguard import constants as K, schemas
from txnguard.durable import scratch_root
from txnguard.functions import scalars as X
from txnguard.operators import features
from txnguard.operators.prefix import exact_quantiles
from txnguard.plans.registry import query
from txnguard.plans.sql_base import (DOMAIN_OF, DOW, EVENT_COLS, HOUR, LIVE_REAL, NIGHT, SCORE1, case_map, decide, oracle, tok)
from txnguard.sources import fixtures as fx
from txnguard.sources.records import row_to_event

RAW_COLS_SQL = ", ".join(f.name for f in schemas.RAW.fields)


@query("a1_raw_rows_pruned", oracle(f"SELECT {RAW_COLS_SQL} FROM rawt", "rawt"))
def raw_rows(spark, d) -> DataFrame:
    return fx.raw_rows(spark, d).select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW.fields])


@query("a7_conform_scored", oracle(f"""SELECT {EVENT_COLS.replace('source_label', "coalesce(CASE WHEN id % 3 = 0 THEN NULL ELSE source_label END, 'replayer') AS source_label")},
  fraud_score, decision, model_name, model_version, scored_at_ms, scoring_latency_ms, feature_completeness,
  CASE WHEN id % 3 = 0 THEN false ELSE blocklist_hit END AS blocklist_hit,
  CASE WHEN id % 3 = 0 THEN 'NONE' ELSE blocklist_tier END AS blocklist_tier, blocklist_reason,
  false AS velocity_hit, '' AS velocity_window, '' AS velocity_reason FROM scf""", "scf"), "fraud_score", digits=8)
def conform_scored(spark, d) -> DataFrame:
    """Rows with missing optional fields take the record type's defaults."""
    third = F.col("id") % 3 == 0
    rows = fx.scored_full(spark, d).withColumns({c: F.when(~third, F.col(c)) for c in (
        "blocklist_hit", "blocklist_tier")}).drop("velocity_hit", "velocity_window", "velocity_reason")
    return schemas.conform(rows, "scored")


@query("a7_enum_domains", oracle("""SELECT 'decision' AS field, count(*) FILTER (WHERE id % 50 = 0) AS violations FROM scf
  UNION ALL SELECT 'blocklist_tier', count(*) FILTER (WHERE id % 77 = 0) FROM scf""", "scf"))
def enum_domains(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d)
    return schemas.domain_violations(s.withColumns({
        "decision": F.when(F.col("id") % 50 == 0, "MAYBE").otherwise(F.col("decision")),
        "blocklist_tier": F.when(F.col("id") % 77 != 0, F.col("blocklist_tier"))}), "scored")


@query("a7_table_types", oracle("""SELECT event_id, CAST(CAST(amount AS DECIMAL(14,4)) AS DOUBLE) AS amount,
  CAST(CAST(fraud_score / 3 AS DECIMAL(10,8)) AS DOUBLE) AS fraud_score,
  CAST(CAST(geo_distance_km AS DECIMAL(10,4)) AS DOUBLE) AS geo_distance_km FROM sc""", "sc"), digits=8)
def table_types(spark, d) -> DataFrame:
    s = fx.scored(spark, d).select("event_id", "amount", (F.col("fraud_score") / 3).alias("fraud_score"), "geo_distance_km")
    return schemas.to_table_types(s)


@query("a12_generated_columns", oracle(f"""SELECT event_id, {HOUR.format('scored_at_ms')} AS event_hour,
  strftime(make_timestamp(scored_at_ms * 1000), '%A') AS event_day_of_week FROM sc""", "sc"))
def generated(spark, d) -> DataFrame:
    return schemas.with_calendar(fx.scored(spark, d)).select("event_id", "event_hour", "event_day_of_week")


@query("a13_fitted_constants", oracle("SELECT kind, \"column\", product, value, number FROM ("
    + " UNION ALL ".join(f"""SELECT 'frequency' AS kind, '{c}' AS "column", NULL AS product, {c} AS value,
      CAST(CAST(count(*)::DOUBLE / (SELECT count(*) FROM rawt) AS FLOAT) AS DOUBLE) AS number FROM rawt GROUP BY {c}""" for c in K.RAW_CATEGORIES)
    + " UNION ALL " + " UNION ALL ".join(f"""SELECT 'mode', '{c}', ProductCD, {c}, NULL FROM (
      SELECT ProductCD, {c}, row_number() OVER (PARTITION BY ProductCD ORDER BY count(*) DESC, ({c} IS NOT NULL), {c}) AS rn
      FROM rawt WHERE TransactionID % 5 <> 0 GROUP BY ProductCD, {c}) WHERE rn = 1""" for c in K.MODE_COLUMNS)
    + " UNION ALL SELECT 'high_amount_q95', 'TransactionAmt', NULL, NULL, quantile_cont(CAST(CAST(TransactionAmt AS FLOAT) AS DOUBLE), 0.95) FROM rawt)", "rawt"), "number")
def fitted_constants(spark, d) -> DataFrame:
    """Frequencies and cut-off on all rows, product modes on the training rows."""
    raw = fx.raw_rows(spark, d)
    return features.constants_table(features.fit(raw, F.col("TransactionID") % 5 != 0))


@query("b1_row_to_event", oracle(f"""SELECT CAST(TransactionID AS VARCHAR) AS event_id,
  1512086400000 + TransactionDT * 1000 AS event_timestamp_ms, CAST(CAST(card1 AS BIGINT) AS VARCHAR) AS customer_id,
  {tok("CAST(CAST(card1 AS BIGINT) AS VARCHAR) || '|' || coalesce(CAST(CAST(card2 AS BIGINT) AS VARCHAR), 'nan') || '|' || CAST(CAST(card3 AS BIGINT) AS VARCHAR) || '|' || CAST(CAST(card5 AS BIGINT) AS VARCHAR)")} AS card_token,
  TransactionAmt AS amount, 'USD' AS currency, TransactionAmt AS amount_fx_normalised,
  {tok("ProductCD || '|' || coalesce(CAST(CAST(addr1 AS BIGINT) AS VARCHAR), 'nan') || '|' || coalesce(CAST(CAST(addr2 AS BIGINT) AS VARCHAR), 'nan')")} AS merchant_id_hash,
  ProductCD || '-MERCHANT-' || coalesce(P_emaildomain, 'nan') AS merchant_name,
  {case_map('ProductCD', K.PRODUCT_TO_MCC, "'5999'")} AS mcc,
  coalesce(CAST(CAST(addr2 AS BIGINT) AS VARCHAR), '00') AS merchant_country,
  {tok("'ip|' || CAST(card1 AS BIGINT)")} AS ip_address_hash, {tok("'dev|' || CAST(card1 AS BIGINT)")} AS device_fingerprint_hash,
  coalesce(dist1, dist2, 0.0) AS geo_distance_km, 'replayer' AS source_label, 'v1' AS schema_version FROM rawt""", "rawt"))
def b1(spark, d) -> DataFrame:
    return row_to_event(fx.raw_rows(spark, d), fx.SALT)


@query("b2_tokenize", oracle(f"""SELECT event_id, CASE WHEN k % 9 = 0 THEN 'null' ELSE {tok('merchant_name')} END AS token,
  {tok('CAST(k AS VARCHAR)')} AS number_token FROM txx""", "txx"))
def b2(spark, d) -> DataFrame:
    e = fx.with_event_columns(fx.base(spark, d))
    return e.select("event_id", fx.tok(F.when(F.col("k") % 9 != 0, F.col("merchant_name"))).alias("token"),
                    fx.tok(F.col("k")).alias("number_token"))


@query("b3_training_time", oracle(f"""SELECT TransactionID, {HOUR.format('ms')} AS hour_of_day, {DOW.format('ms')} AS day_of_week,
  CASE WHEN {NIGHT.format('ms')} THEN 1 ELSE 0 END AS is_night, CASE WHEN {DOW.format('ms')} >= 5 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT TransactionID, 1512086400000 + TransactionDT * 1000 AS ms FROM rawt)""", "rawt"))
def b3(spark, d) -> DataFrame:
    raw = fx.raw_rows(spark, d)
    return raw.select("TransactionID", *[c.alias(n) for n, c in X.training_time("TransactionDT").items()])


def _live_sql(names: list[str], time: str = "event_timestamp_ms") -> str:
    return ", ".join(f"CAST({LIVE_REAL[n].replace('event_timestamp_ms', time)} AS DOUBLE) AS {n}" for n in names)


@query("b4_live_time", oracle(f"""SELECT event_id, {_live_sql(['hour_of_day', 'day_of_week', 'is_night', 'is_weekend'], 'ms0')}
  FROM (SELECT event_id, CASE WHEN id % 13 = 0 THEN 0 ELSE ms END AS ms0 FROM txx)""", "txx"), "")
def b4(spark, d) -> DataFrame:
    e = fx.with_event_columns(fx.base(spark, d)).withColumn("ms0", F.when(F.col("id") % 13 == 0, 0).otherwise(F.col("ms")))
    return e.select("event_id", *[c.alias(n) for n, c in X.live_time("ms0").items()])


@query("b5_training_amounts", oracle("""WITH q AS (SELECT quantile_cont(CAST(CAST(TransactionAmt AS FLOAT) AS DOUBLE), 0.95) AS q FROM rawt),
  c AS (SELECT TransactionID, CAST(TransactionAmt AS FLOAT) AS a, CAST(trunc((CAST(TransactionAmt AS FLOAT) * 100::FLOAT) % 100::FLOAT) AS BIGINT) AS cents FROM rawt)
  SELECT TransactionID, CAST(CAST(ln(1 + a::DOUBLE) AS FLOAT) AS DOUBLE) AS log_amount, cents AS amount_cents,
  CASE WHEN cents = 0 THEN 1 ELSE 0 END AS is_round_dollar, CASE WHEN a::DOUBLE > q.q THEN 1 ELSE 0 END AS is_high_amount FROM c, q""".replace("WITH q", ", q", 1), "rawt"), "log_amount", digits=4)
def b5(spark, d) -> DataFrame:
    raw = fx.raw_rows(spark, d)
    amount = raw.select(F.col("TransactionAmt").cast("float").cast("double").alias("a"))
    high = exact_quantiles(amount, "a", [0.95]).select("q0").scalar()
    return raw.select("TransactionID", *[c.alias(n) for n, c in X.training_amount("TransactionAmt", high).items()])


@query("b6_live_amounts", oracle(f"SELECT event_id, {_live_sql(['log_amount', 'amount_cents', 'is_round_dollar', 'is_high_amount'])} FROM tx", "tx"), "log_amount")
def b6(spark, d) -> DataFrame:
    return fx.transactions(spark, d).select("event_id", *[c.alias(n) for n, c in X.live_amount("amount").items()])


@query("b7_email_flags", oracle("""SELECT TransactionID, CASE WHEN coalesce(P_emaildomain, 'missing') <> coalesce(R_emaildomain, 'missing') THEN 1 ELSE 0 END AS email_mismatch,
  CASE WHEN coalesce(P_emaildomain, 'missing') = 'missing' THEN 1 ELSE 0 END AS p_email_missing,
  CASE WHEN coalesce(R_emaildomain, 'missing') = 'missing' THEN 1 ELSE 0 END AS r_email_missing FROM rawt""", "rawt"))
def b7(spark, d) -> DataFrame:
    flags = X.email_flags("P_emaildomain", "R_emaildomain")
    return fx.raw_rows(spark, d).select("TransactionID", *[c.alias(n) for n, c in flags.items()])


@query("b8_domains", oracle(f"""SELECT event_id, {DOMAIN_OF.format('name')} AS feature_domain,
  CASE WHEN strpos(name, '-MERCHANT-') > 0 THEN trim(substr(name, strpos(name, '-MERCHANT-') + 10)) ELSE name END AS text_domain
  FROM (SELECT event_id, CASE WHEN id % 17 = 0 THEN domain ELSE merchant_name END AS name FROM txx)""", "txx"))
def b8(spark, d) -> DataFrame:
    e = fx.with_event_columns(fx.base(spark, d)).withColumn(
        "name", F.when(F.col("id") % 17 == 0, F.col("domain")).otherwise(F.col("merchant_name")))
    return e.select("event_id", X.feature_domain("name").alias("feature_domain"), X.text_domain("name").alias("text_domain"))


_FREQ = ", ".join(
    f"CAST(CAST(count(*) OVER (PARTITION BY {c})::DOUBLE / count(*) OVER () AS FLOAT) AS DOUBLE) AS {c}_freq" for c in K.RAW_CATEGORIES)


@query("b9_frequency_encoding", oracle(f"SELECT TransactionID, {_FREQ} FROM rawt", "rawt"), [f"{c}_freq" for c in K.RAW_CATEGORIES])
def b9(spark, d) -> DataFrame:
    raw = fx.raw_rows(spark, d)
    out, fitted = raw, features.fit(raw)
    for c in K.RAW_CATEGORIES:
        out = features.encode_frequency(out, fitted, c)
    return out.select("TransactionID", *[f"{c}_freq" for c in K.RAW_CATEGORIES])


@query("b10_static_frequencies", oracle(f"SELECT event_id, {_live_sql(['ProductCD_freq', 'P_emaildomain_freq', 'p_email_missing'])} FROM tx", "tx"))
def b10(spark, d) -> DataFrame:
    v = features.live_values()
    return fx.transactions(spark, d).select("event_id", *[v[n].alias(n) for n in ("ProductCD_freq", "P_emaildomain_freq", "p_email_missing")])


@query("b11_sparse_columns", oracle("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing FROM rawt" for c in K.RAW_NUMERIC)
    + ") WHERE missing > 0.70", "rawt"))
def b11(spark, d) -> DataFrame:
    m = features.missing_fractions(fx.raw_rows(spark, d), K.RAW_NUMERIC)
    return m.where(F.col("missing") > K.MISSING_DROP_ABOVE)


def training_sql(where_fit: str = "true") -> str:
    """All 43 training features, frequencies and the cut-off fitted where ``where_fit``."""
    n = f"(SELECT count(*) FROM rawt WHERE {where_fit})"
    ms = "(1512086400000 + TransactionDT * 1000)"
    cents = "CAST(trunc((CAST(TransactionAmt AS FLOAT) * 100::FLOAT) % 100::FLOAT) AS BIGINT)"
    q = f"(SELECT quantile_cont(CAST(CAST(TransactionAmt AS FLOAT) AS DOUBLE), 0.95) FROM rawt WHERE {where_fit})"
    made = {
        "hour_of_day": HOUR.format(ms), "day_of_week": DOW.format(ms),
        "is_night": f"CASE WHEN {NIGHT.format(ms)} THEN 1 ELSE 0 END",
        "is_weekend": f"CASE WHEN {DOW.format(ms)} >= 5 THEN 1 ELSE 0 END",
        "log_amount": "ln(1 + CAST(TransactionAmt AS FLOAT)::DOUBLE)", "amount_cents": cents,
        "is_round_dollar": f"CASE WHEN {cents} = 0 THEN 1 ELSE 0 END",
        "is_high_amount": f"CASE WHEN CAST(TransactionAmt AS FLOAT)::DOUBLE > {q} THEN 1 ELSE 0 END",
        "email_mismatch": "CASE WHEN coalesce(P_emaildomain, 'missing') <> coalesce(R_emaildomain, 'missing') THEN 1 ELSE 0 END",
        "p_email_missing": "CASE WHEN P_emaildomain IS NULL THEN 1 ELSE 0 END",
        "r_email_missing": "CASE WHEN R_emaildomain IS NULL THEN 1 ELSE 0 END",
    }
    made |= {f"{c}_freq": f"(nullif(count(*) FILTER (WHERE {where_fit}) OVER (PARTITION BY {c}), 0)::DOUBLE / {n})" for c in K.RAW_CATEGORIES}
    cols = ", ".join(f"coalesce(CAST(CAST({made.get(f, f)} AS FLOAT) AS DOUBLE), -999.0) AS {f}" for f in K.FEATURES)
    return f"SELECT TransactionID, isFraud, {cols} FROM rawt"


@query("b12_training_features", oracle(training_sql(), "rawt"), K.FEATURES, digits=4)
def b12(spark, d) -> DataFrame:
    """B3-B12 together: 43 columns, the sparse one dropped, missing filled."""
    raw = fx.raw_rows(spark, d)
    return features.training_features(raw, features.fit(raw))


@query("a13_loaded_constants", oracle(training_sql("TransactionID % 5 <> 0"), "rawt"), K.FEATURES, digits=4)
def loaded_constants(spark, d) -> DataFrame:
    """Features from constants that were stored in two versions and loaded again, the newest by default."""
    raw, root = fx.raw_rows(spark, d), f"{scratch_root(spark).rstrip('/')}/txnguard/constants-{uuid.uuid4().hex}"
    features.save_constants(features.fit(raw), root, 1)
    features.save_constants(features.fit(raw.where(F.col("TransactionID") % 5 != 0)), root, 2)
    return features.training_features(raw, features.load_constants(spark, root))


@query("b18_features_fitted_on_mask", oracle(training_sql("TransactionID % 5 <> 0"), "rawt"), K.FEATURES, digits=4)
def b18(spark, d) -> DataFrame:
    """Data-dependent parts fitted on the masked rows, applied to all."""
    raw = fx.raw_rows(spark, d)
    fitted = features.fit(raw.where(F.col("TransactionID") % 5 != 0))
    return features.training_features(raw, fitted)


@query("b13_safe_int", oracle("""SELECT event_id, t AS text, CASE WHEN regexp_full_match(trim(t), '[+-]?[0-9]+') THEN CAST(trim(t) AS INTEGER)::DOUBLE ELSE -999.0 END AS number
  FROM (SELECT event_id, CASE id % 4 WHEN 0 THEN merchant_country WHEN 1 THEN ' ' || k || ' ' WHEN 2 THEN k || '.0' ELSE mcc END AS t FROM txx)""", "txx"))
def b13(spark, d) -> DataFrame:
    e = fx.with_event_columns(fx.base(spark, d))
    k = F.col("k").cast("string")
    t = (F.when(F.col("id") % 4 == 0, F.col("merchant_country")).when(F.col("id") % 4 == 1, F.concat(F.lit(" "), k, F.lit(" ")))
         .when(F.col("id") % 4 == 2, F.concat(k, F.lit(".0"))).otherwise(F.col("mcc")))
    return e.select("event_id", t.alias("text"), X.safe_int(t).alias("number"))


_KNOWN = " + ".join(f"CASE WHEN {f} <> -999 THEN 1 ELSE 0 END" for f in K.FEATURES)


@query("b14_live_features", oracle(f"SELECT * EXCLUDE (event_timestamp_ms), round(({_KNOWN}) / 43.0, 4)::DOUBLE AS feature_completeness FROM live", "live"), K.FEATURES + ["feature_completeness"], digits=4)
def b14(spark, d) -> DataFrame:
    return features.live_features(fx.transactions(spark, d))


@query("b15_empty_batch", oracle("SELECT * EXCLUDE (event_timestamp_ms), 0.0::DOUBLE AS feature_completeness FROM live WHERE event_id = 'none'", "live"))
def b15(spark, d) -> DataFrame:
    """No events match, and the frame still has the 43 columns."""
    return features.live_features(fx.transactions(spark, d).where("event_id = 'none'"))


def richer_events(spark, d) -> DataFrame:
    """Events carrying the raw columns a richer event would have."""
    raw = fx.raw_rows(spark, d)
    event = row_to_event(raw.withColumn("TransactionDT", F.col("TransactionDT")), fx.SALT)
    extra = ["dist1", "card2", "card3", "card5", "addr1", "card4", "card6", "R_emaildomain"] + [f"M{i}" for i in range(1, 10)]
    return event.join(raw.select(F.col("TransactionID").cast("string").alias("event_id"),
                                 *[F.col(c).alias(f"raw_{c}") for c in extra]), "event_id")


# SQL of the corrected features: every correction on, without and with the richer event.
_FRQ = ("frq AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS val, CAST(CAST(count(*)::DOUBLE / (SELECT count(*) FROM rawt) AS FLOAT) AS DOUBLE) AS f FROM rawt GROUP BY {c}"
    for c in K.RAW_CATEGORIES) + ")")
_RARE = "rare AS (SELECT col, min(f) AS f FROM frq GROUP BY col)"
_MODES = "modes AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS col, ProductCD, {c} AS val FROM (SELECT ProductCD, {c}, row_number() OVER (PARTITION BY ProductCD
    ORDER BY count(*) DESC, ({c} IS NOT NULL), {c}) AS rn FROM rawt GROUP BY ProductCD, {c}) WHERE rn = 1""" for c in K.MODE_COLUMNS) + ")"


def _frq(col: str, value: str) -> str:
    return (f"coalesce((SELECT f FROM frq WHERE frq.col = '{col}' AND frq.val IS NOT DISTINCT FROM {value}), "
            f"(SELECT f FROM rare WHERE rare.col = '{col}'))")


def corrected_sql(richer: bool) -> str:
    def given(c):
        return f"b.{c}" if richer else f"(SELECT val FROM modes WHERE modes.col = '{c}' AND modes.ProductCD = b.ProductCD)"

    ms = "(1512086400000 + TransactionDT * 1000)"
    a32 = "CAST(TransactionAmt AS FLOAT)"
    cents = f"CAST(trunc(({a32} * 100::FLOAT) % 100::FLOAT) AS BIGINT)"
    q = "(SELECT CAST(quantile_cont(CAST(CAST(TransactionAmt AS FLOAT) AS DOUBLE), 0.95) AS FLOAT) FROM rawt)"
    r = given("R_emaildomain")
    v = {
        "TransactionAmt": "TransactionAmt", "card1": "card1",
        "addr2": "coalesce(addr2, -999)", "hour_of_day": HOUR.format(ms), "day_of_week": DOW.format(ms),
        "is_night": f"CASE WHEN {NIGHT.format(ms)} THEN 1 ELSE 0 END", "is_weekend": f"CASE WHEN {DOW.format(ms)} >= 5 THEN 1 ELSE 0 END",
        "log_amount": f"ln(1 + {a32}::DOUBLE)", "amount_cents": cents, "is_round_dollar": f"CASE WHEN {cents} = 0 THEN 1 ELSE 0 END",
        "is_high_amount": f"CASE WHEN {a32} > {q} THEN 1 ELSE 0 END",
        "email_mismatch": f"CASE WHEN coalesce(P_emaildomain, 'missing') <> coalesce({r}, 'missing') THEN 1 ELSE 0 END",
        "p_email_missing": "CASE WHEN P_emaildomain IS NULL THEN 1 ELSE 0 END",
        "r_email_missing": f"CASE WHEN coalesce({r}, 'missing') = 'missing' THEN 1 ELSE 0 END",
        "ProductCD_freq": _frq("ProductCD", "b.ProductCD"), "P_emaildomain_freq": _frq("P_emaildomain", "b.P_emaildomain"),
        "R_emaildomain_freq": _frq("R_emaildomain", r),
        "dist1": "coalesce(dist1, -999)" if richer else "CASE WHEN coalesce(dist1, dist2, 0) = 0 THEN -999 ELSE coalesce(dist1, dist2) END",
    }
    if richer:
        v |= {c: f"coalesce({c}, -999)" for c in ("card2", "card3", "card5", "addr1")}
    v |= {f"{c}_freq": _frq(c, given(c)) for c in ["card4", "card6"] + [f"M{i}" for i in range(1, 10)]}
    cols = ", ".join(f"CAST(CAST({v.get(f, '-999')} AS FLOAT) AS DOUBLE) AS {f}" for f in K.FEATURES)
    return (f", {_FRQ}, {_RARE}, {_MODES}, out AS (SELECT CAST(TransactionID AS VARCHAR) AS event_id, {cols} FROM rawt b) "
            f"SELECT *, round(({_KNOWN}) / 43.0, 4)::DOUBLE AS feature_completeness FROM out")


@query("b16_corrected_features", oracle(corrected_sql(False), "rawt"), K.FEATURES + ["feature_completeness"], digits=4)
def b16(spark, d) -> DataFrame:
    fitted = features.fit(fx.raw_rows(spark, d))
    return features.corrected_features(richer_events(spark, d), fitted, features.FIXES)


@query("b16_richer_event_features", oracle(corrected_sql(True), "rawt"), K.FEATURES + ["feature_completeness"], digits=4)
def b16_richer(spark, d) -> DataFrame:
    fitted = features.fit(fx.raw_rows(spark, d))
    return features.corrected_features(richer_events(spark, d), fitted, features.FIXES, richer=True)


@query("b16_no_corrections", oracle(f"SELECT * EXCLUDE (event_timestamp_ms), round(({_KNOWN}) / 43.0, 4)::DOUBLE AS feature_completeness FROM live", "live"), K.FEATURES + ["feature_completeness"], digits=4)
def b16_none(spark, d) -> DataFrame:
    return features.corrected_features(fx.transactions(spark, d))


@query("b19_decide", oracle(f"SELECT event_id, s AS fraud_score, {decide('s')} AS decision, {decide('s', 0.10, 0.18)} AS demo_decision FROM (SELECT event_id, round({SCORE1}, 8) AS s FROM tx)", "tx"), "fraud_score", digits=8)
def b19(spark, d) -> DataFrame:
    s = fx.transactions(spark, d).withColumn("fraud_score", F.round(fx.first_score(), 8))
    return s.select("event_id", "fraud_score", X.decide("fraud_score").alias("decision"),
                    X.decide("fraud_score", K.DEMO_REVIEW_AT, K.DEMO_BLOCK_AT).alias("demo_decision"))
