"""Common table expressions for the checking SQL (run by DuckDB on the same tables)."""

from __future__ import annotations

from txnguard import constants as K
from txnguard.sources.fixtures import DAY_MS, SALT, START_MS

EVENT_COLS = ("event_id, event_timestamp_ms, customer_id, card_token, amount, currency, amount_fx_normalised, "
              "merchant_id_hash, merchant_name, mcc, merchant_country, ip_address_hash, device_fingerprint_hash, "
              "geo_distance_km, source_label, schema_version")
SCORE_COLS = ("fraud_score, decision, model_name, model_version, scored_at_ms, scoring_latency_ms, "
              "feature_completeness, blocklist_hit, blocklist_tier, blocklist_reason, velocity_hit, "
              "velocity_window, velocity_reason")


def tok(expr: str) -> str:
    return f"substr(sha256(({expr}) || '|{SALT}'), 1, 16)"


def decide(s: str, review: float = K.REVIEW_AT, block: float = K.BLOCK_AT) -> str:
    return f"CASE WHEN {s} >= {block} THEN 'BLOCK' WHEN {s} >= {review} THEN 'REVIEW' ELSE 'ALLOW' END"


def case_map(expr: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in table.items())
    return f"CASE {expr} {whens} ELSE {default} END"


HOUR = "extract(hour FROM make_timestamp({0} * 1000))"
DOW = "(extract(isodow FROM make_timestamp({0} * 1000)) - 1)"
NIGHT = f"({HOUR} < 6 OR {HOUR} >= 22)"

DOMAIN_OF = ("CASE WHEN strpos({0}, '-MERCHANT-') > 0 AND lower(trim(substr({0}, strpos({0}, '-MERCHANT-') + 10))) <> '' "
             "THEN lower(trim(substr({0}, strpos({0}, '-MERCHANT-') + 10))) ELSE 'missing' END")


def linear(i, lw, nw, hw, mw, gw) -> str:
    return (f"(1.0::DOUBLE / (1.0 + exp(-(({i})::DOUBLE + {lw}::DOUBLE * ln(1 + amount)"
            f" + CASE WHEN {NIGHT.format('event_timestamp_ms')} THEN {nw} ELSE 0 END::DOUBLE"
            f" + CASE WHEN amount > 147 THEN {hw} ELSE 0 END::DOUBLE"
            f" + CASE WHEN {DOMAIN_OF.format('merchant_name')} IN ('missing','nan','anonymous.com') THEN {mw} ELSE 0 END::DOUBLE"
            f" + {gw}::DOUBLE * geo_distance_km))))")


SCORE1 = linear(-4.2, 0.75, 0.9, 1.1, 0.8, 0.00005)
SCORE2 = linear(-3.9, 0.70, 0.6, 1.3, 0.5, 0.00009)

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (body, list(needs))


cte("fx", """
 SELECT event_id AS id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms,
   CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
   CASE event_type WHEN 'purchase' THEN 'W' WHEN 'click' THEN 'C' WHEN 'view' THEN 'R' WHEN 'signup' THEN 'H' ELSE 'S' END AS product,
   CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com'
     WHEN 2 THEN 'hotmail.com' WHEN 3 THEN 'anonymous.com' WHEN 4 THEN 'nan' WHEN 5 THEN '' WHEN 6 THEN 'XJ8K2-zzz9.com'
     ELSE 'aol.com' END AS domain
 FROM events""")

cte("txx", f"""
 SELECT *, CAST(id AS VARCHAR) AS event_id, ms AS event_timestamp_ms, CAST(user_id AS VARCHAR) AS customer_id,
  {tok("user_id || '|' || event_type")} AS card_token, value AS amount, 'USD' AS currency, value AS amount_fx_normalised,
  {tok("product || '|' || (k % 20)")} AS merchant_id_hash, product || '-MERCHANT-' || domain AS merchant_name,
  CASE WHEN k >= 97 THEN '7995' WHEN product = 'W' THEN '5411' WHEN product = 'C' THEN '5732' WHEN product = 'R' THEN '5812'
   WHEN product = 'H' THEN '7011' ELSE '5999' END AS mcc,
  CASE k % 5 WHEN 0 THEN '00' WHEN 1 THEN 'US' ELSE CAST(80 + k % 10 AS VARCHAR) END AS merchant_country,
  {tok("'ip|' || user_id")} AS ip_address_hash, {tok("'dev|' || user_id")} AS device_fingerprint_hash,
  CASE WHEN k % 4 = 0 THEN 0.0 ELSE 97.0 * k END::DOUBLE AS geo_distance_km,
  'replayer' AS source_label, 'v1' AS schema_version
 FROM fx""", "fx")

cte("tx", f"SELECT {EVENT_COLS} FROM txx", "txx")

cte("lab", f"""
 SELECT *, CASE WHEN (id * 2654435761) % 1000 < 15 + CASE WHEN amount > 147 THEN 120 ELSE 0 END
   + CASE WHEN {NIGHT.format('ms')} THEN 40 ELSE 0 END THEN 1 ELSE 0 END AS label
 FROM txx""", "txx")

cte("scf", f"""
 SELECT *, {decide('fraud_score')} AS decision FROM (
  SELECT *, CASE WHEN id % 101 = 0 THEN 1.0 WHEN id % 67 = 0 THEN 0.5 ELSE round({SCORE1}, 8) END::DOUBLE AS fraud_score,
  'scorecard' AS model_name, 'v1' AS model_version, ms + 5 + id % 97 AS scored_at_ms,
  5 + (id * 7919) % 120 AS scoring_latency_ms,
  CASE WHEN id % 101 = 0 OR id % 67 = 0 THEN 0.0 WHEN k % 5 = 1 THEN 0.3256 ELSE 0.3488 END::DOUBLE AS feature_completeness,
  (id % 101 = 0) AS blocklist_hit, CASE WHEN id % 101 = 0 THEN 'BLOCK' ELSE 'NONE' END AS blocklist_tier,
  CASE WHEN id % 101 = 0 THEN 'rule ' || (id % 3) ELSE '' END AS blocklist_reason,
  (id % 67 = 0 AND id % 101 <> 0) AS velocity_hit,
  CASE WHEN id % 67 = 0 AND id % 101 <> 0 THEN '1min' ELSE '' END AS velocity_window,
  CASE WHEN id % 67 = 0 AND id % 101 <> 0 THEN 'burst' ELSE '' END AS velocity_reason
  FROM lab)""", "lab")

cte("sc", f"SELECT {EVENT_COLS}, {SCORE_COLS} FROM scf", "scf")

cte("sc2", f"""
 SELECT {EVENT_COLS}, fraud_score, {decide('fraud_score')} AS decision, 'second' AS model_name, 'v1' AS model_version,
  ms + 200 + id % 89 AS scored_at_ms, 150 + (id * 31) % 400 AS scoring_latency_ms, 1.0::DOUBLE AS feature_completeness,
  'second opinion on ' || merchant_name AS blocklist_reason
 FROM (SELECT *, round({SCORE2}, 8) AS fraud_score FROM txx WHERE id % 4 <> 0)""", "txx")

cte("cmp", """
 SELECT x.event_id, x.customer_id, x.amount, x.merchant_name, x.mcc, x.fraud_score AS first_score,
  x.decision AS first_decision, x.scoring_latency_ms AS first_latency_ms, g.fraud_score AS second_score,
  g.decision AS second_decision, g.scoring_latency_ms AS second_latency_ms, g.blocklist_reason AS llm_reason,
  x.decision = g.decision AS decisions_agree, abs(x.fraud_score - g.fraud_score) AS score_diff, x.scored_at_ms
 FROM sc x JOIN sc2 g ON x.event_id = g.event_id""", "sc", "sc2")

cte("dlv", f"""
 SELECT {EVENT_COLS}, {SCORE_COLS}, id AS arrival FROM scf
 UNION ALL
 SELECT event_id, event_timestamp_ms, customer_id, card_token, amount + 1, currency, amount_fx_normalised,
  merchant_id_hash, merchant_name, mcc, merchant_country, ip_address_hash, device_fingerprint_hash,
  geo_distance_km, 'appeal', schema_version, fraud_score / 2, {decide('fraud_score / 2')},
  model_name, model_version, scored_at_ms + (id % 3 - 1) * 1000, scoring_latency_ms,
  feature_completeness, blocklist_hit, blocklist_tier, blocklist_reason, velocity_hit, velocity_window, velocity_reason,
  id + 10000000
 FROM scf WHERE id % 10 = 0""", "scf")


def _list(name, kind, entity, reason, count, start, end, source, cond):
    return (f"SELECT '{name}' AS list, '{kind}' AS entity_type, {tok(entity)} AS entity_id, {reason} AS reason, "
            f"CAST({count} AS BIGINT) AS block_count, CAST({START_MS + start * DAY_MS} AS BIGINT) AS added_at_ms, "
            f"CAST({START_MS + end * DAY_MS} AS BIGINT) AS expires_at_ms FROM {source} WHERE {cond}")


_U = "(SELECT DISTINCT user_id AS u FROM events)"
cte("lst", " UNION ALL ".join([
    _list("block", "card", "u || '|purchase'", "'card of ' || u", 3, 0, 60, _U, "u % 10 IN (5, 8)"),
    _list("white", "ip", "'ip|' || u", "'trusted'", 0, 0, 60, _U, "u % 10 = 8"),
    _list("block", "device", "'dev|' || u", "'lapsed'", 3, -30, 0, _U, "u % 10 = 9"),
    _list("block", "ip", "'ip|' || u", "'ip of ' || u", 5, 15, 60, _U, "u % 10 = 3"),
    _list("hot", "device", "'dev|' || u", "'device of ' || u", 2, 0, 10, _U, "u % 10 = 2"),
    _list("hot", "ip", "'ip|' || u", "'also hot'", 2, 0, 60, _U, "u % 10 = 5"),
    _list("hot", "merchant", "'W|3'", "'merchant fraud rate'", 2, 0, 60,
          "(SELECT DISTINCT product || '|' || (k % 20) AS shop FROM fx)", "shop = 'W|3'"),
]), "fx")

_M = ", ".join(f"CASE WHEN (k + {i}) % 7 = 0 THEN NULL WHEN (k + {i}) % 3 = 0 THEN 'T' ELSE 'F' END AS M{i}" for i in range(1, 10))
cte("rawt", f"""
 SELECT id AS TransactionID, label AS isFraud, CAST(floor((ms - {START_MS}) / 1000) AS BIGINT) AS TransactionDT,
  value AS TransactionAmt, product AS ProductCD, user_id::DOUBLE AS card1,
  CASE WHEN k % 11 = 0 THEN NULL ELSE 100 + k END::DOUBLE AS card2, 150.0::DOUBLE AS card3, (100 + k % 50)::DOUBLE AS card5,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'visa' WHEN k % 4 = 1 THEN 'mastercard' WHEN k % 4 = 2 THEN 'discover' ELSE 'american express' END AS card4,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 'credit' ELSE 'debit' END AS card6,
  CASE WHEN k % 9 = 0 THEN NULL ELSE 200 + k END::DOUBLE AS addr1, CASE WHEN k % 5 = 0 THEN NULL ELSE 80 + k % 10 END::DOUBLE AS addr2,
  CASE WHEN k % 4 = 0 THEN NULL ELSE k * 97 END::DOUBLE AS dist1, CASE WHEN k % 20 <> 0 THEN NULL ELSE k * 3 END::DOUBLE AS dist2,
  CASE WHEN domain IN ('nan', '') THEN NULL ELSE lower(domain) END AS P_emaildomain,
  CASE WHEN k % 3 = 0 THEN NULL WHEN k % 2 = 0 THEN 'gmail.com' ELSE 'yahoo.com' END AS R_emaildomain,
  {_M}, (k % 6)::DOUBLE AS C1, (k % 4)::DOUBLE AS C2, (k % 2)::DOUBLE AS C5, (k % 30)::DOUBLE AS C13, (k % 8)::DOUBLE AS C14,
  (id % 300)::DOUBLE AS D1, CASE WHEN k % 3 <> 0 THEN NULL ELSE id % 200 END::DOUBLE AS D2,
  CASE WHEN k % 4 = 1 THEN NULL ELSE id % 150 END::DOUBLE AS D4, CASE WHEN k % 6 = 0 THEN NULL ELSE id % 90 END::DOUBLE AS D10,
  CASE WHEN k % 8 = 0 THEN NULL ELSE id % 400 END::DOUBLE AS D15
 FROM lab""", "lab")

_REAL = {
    "TransactionAmt": "amount", "addr2": "coalesce(try_cast(CASE WHEN regexp_full_match(merchant_country, '[+-]?[0-9]+') THEN merchant_country END AS INTEGER)::DOUBLE, -999.0)",
    "hour_of_day": f"CASE WHEN event_timestamp_ms > 0 THEN {HOUR.format('event_timestamp_ms')} ELSE -999 END::DOUBLE",
    "day_of_week": f"CASE WHEN event_timestamp_ms > 0 THEN {DOW.format('event_timestamp_ms')} ELSE -999 END::DOUBLE",
    "is_night": f"CASE WHEN event_timestamp_ms <= 0 THEN -999 WHEN {NIGHT.format('event_timestamp_ms')} THEN 1 ELSE 0 END::DOUBLE",
    "is_weekend": f"CASE WHEN event_timestamp_ms <= 0 THEN -999 WHEN {DOW.format('event_timestamp_ms')} >= 5 THEN 1 ELSE 0 END::DOUBLE",
    "log_amount": "ln(1 + amount)", "amount_cents": "round_even(amount * 100, 0)::BIGINT % 100",
    "is_round_dollar": "CASE WHEN round_even(amount * 100, 0)::BIGINT % 100 = 0 THEN 1 ELSE 0 END",
    "is_high_amount": "CASE WHEN amount > 200 THEN 1 ELSE 0 END", "email_mismatch": "0",
    "p_email_missing": f"CASE WHEN {DOMAIN_OF.format('merchant_name')} IN ('missing', 'nan', 'anonymous.com') THEN 1 ELSE 0 END",
    "r_email_missing": "1",
    "ProductCD_freq": "CASE mcc WHEN '5411' THEN 0.7449 WHEN '5732' THEN 0.1276 WHEN '5812' THEN 0.0635 WHEN '7011' THEN 0.0498 ELSE 0.0143 END",
    "P_emaildomain_freq": case_map(DOMAIN_OF.format("merchant_name"), K.DOMAIN_FREQUENCY, "0.005"),
}
LIVE_SQL = ", ".join(f"CAST(CAST({_REAL.get(f, '-999')} AS FLOAT) AS DOUBLE) AS {f}" for f in K.FEATURES)
LIVE_REAL = _REAL
cte("live", f"SELECT event_id, event_timestamp_ms, {LIVE_SQL} FROM tx", "tx")


def oracle(body: str, *needs: str) -> str:
    """``body`` behind the CTEs it needs, in dependency order."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for n in CTES[name][1]:
            visit(n)
        done.append(name)

    for n in needs:
        visit(n)
    if not done:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][0]})" for n in done) + "\n" + body
