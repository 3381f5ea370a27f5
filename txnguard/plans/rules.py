"""Queries: lists, velocity, the fast path, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard import constants as K
from txnguard.durable import materialize
from txnguard.operators import features, lists, merge, scoring, velocity
from txnguard.operators.timeline import trailing_totals
from txnguard.plans.registry import query
from txnguard.plans.sql_base import (EVENT_COLS, LIVE_SQL, NIGHT, DOMAIN_OF, SCORE1, SCORE_COLS, _REAL, cte, decide, oracle)
from txnguard.schemas import EVENT_FIELDS, SCORED
from txnguard.sources import fixtures as fx

DAY_S = 86_400
# User gaps are hours here, so the windows run in days: 1, 10 and 60 of them.
WINDOWS = [("1min", 60 * 1440, 5), ("10min", 600 * 1440, 12), ("60min", 3600 * 1440, 20)]
MID_MS = fx.START_MS + 20 * fx.DAY_MS

# --- lists ---------------------------------------------------------------------

def entries(spark, d) -> DataFrame:
    """The list table, stored as it is in use."""
    return materialize(fx.list_entries(spark, d), "lists")


cte("lv", """
 SELECT event_id, first(rank ORDER BY rank, ord, newest, entity_type, entity_id, reason) AS rank,
   first(entity_type ORDER BY rank, ord, newest, entity_type, entity_id, reason) AS entity_type,
   first(entity_id ORDER BY rank, ord, newest, entity_type, entity_id, reason) AS entity_id,
   first(reason ORDER BY rank, ord, newest, entity_type, entity_id, reason) AS reason
 FROM (SELECT e.event_id, e.ord, l.entity_type, l.entity_id, l.reason, -l.added_at_ms AS newest,
     CASE l.list WHEN 'white' THEN 0 WHEN 'block' THEN 1 ELSE 2 END AS rank
   FROM (SELECT event_id, event_timestamp_ms AS t, 0 AS ord, 'card' AS ty, card_token AS ei FROM tx
     UNION ALL SELECT event_id, event_timestamp_ms, 1, 'merchant', merchant_id_hash FROM tx
     UNION ALL SELECT event_id, event_timestamp_ms, 2, 'ip', ip_address_hash FROM tx
     UNION ALL SELECT event_id, event_timestamp_ms, 3, 'device', device_fingerprint_hash FROM tx) e
   JOIN lst l ON l.entity_type = e.ty AND l.entity_id = e.ei AND l.added_at_ms <= e.t AND e.t < l.expires_at_ms)
 GROUP BY event_id""", "tx", "lst")
cte("chk", """
 SELECT t.*, coalesce(rank > 0, false) AS blocklist_hit,
  CASE rank WHEN 1 THEN 'BLOCK' WHEN 2 THEN 'HOT' ELSE 'NONE' END AS blocklist_tier,
  CASE WHEN rank IS NULL THEN '' WHEN rank = 0 THEN 'whitelist:' || entity_type || '=' || substr(entity_id, 1, 12) ELSE reason END AS blocklist_reason,
  CASE WHEN rank > 0 THEN entity_type ELSE '' END AS matched_entity_type,
  CASE WHEN rank > 0 THEN entity_id ELSE '' END AS matched_entity_id
 FROM tx t LEFT JOIN lv USING (event_id)""", "tx", "lv")


@query("c1_list_check", oracle("SELECT event_id, blocklist_hit, blocklist_tier, blocklist_reason, matched_entity_type, matched_entity_id FROM chk", "chk"))
def c1(spark, d) -> DataFrame:
    out = lists.check(fx.transactions(spark, d), entries(spark, d))
    return out.select("event_id", "blocklist_hit", "blocklist_tier", "blocklist_reason", "matched_entity_type", "matched_entity_id")


def proposals(spark, d) -> DataFrame:
    """Proposed list rows by user number, most of them fine, some to refuse."""
    users = fx.table(spark, d, "events").select(F.col("user_id").alias("u")).distinct()
    return users.selectExpr(
        "CASE u % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'hot' ELSE 'white' END AS list",
        "CASE WHEN u % 11 = 0 THEN 'phone' ELSE 'ip' END AS entity_type",
        f"{fx._tok(chr(39) + 'ip' + chr(39) + ', cast(u AS string)')} AS entity_id",
        "concat('proposal ', cast(u AS string)) AS reason", "cast(u % 6 AS long) AS block_count",
        f"cast({MID_MS} AS long) AS added_at_ms")


cte("prop", f"""SELECT CASE u % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'hot' ELSE 'white' END AS list,
  CASE WHEN u % 11 = 0 THEN 'phone' ELSE 'ip' END AS entity_type, substr(sha256('ip|' || u || '|{fx.SALT}'), 1, 16) AS entity_id,
  'proposal ' || u AS reason, u % 6 AS block_count, {MID_MS} AS added_at_ms FROM (SELECT DISTINCT user_id AS u FROM events)""")
cte("judged", f"""SELECT p.*, p.added_at_ms + CASE WHEN p.list = 'white' THEN {K.WHITE_TTL_S} WHEN p.entity_type = 'ip' THEN 3600 END * 1000::BIGINT AS expires_at_ms,
  CASE WHEN entity_type NOT IN ('card', 'merchant', 'ip', 'device') THEN 'unknown entity type'
    WHEN list = 'block' AND block_count < 3 OR list = 'hot' AND block_count < 2 THEN 'block count too low'
    WHEN list <> 'white' AND EXISTS (SELECT 1 FROM lst w WHERE w.list = 'white' AND w.entity_type = p.entity_type AND w.entity_id = p.entity_id
      AND w.added_at_ms <= p.added_at_ms AND p.added_at_ms < w.expires_at_ms) THEN 'on whitelist' END AS refusal
  FROM prop p""", "prop", "lst")


@query("c11_list_refusals", oracle("SELECT list, entity_type, entity_id, block_count, refusal FROM judged WHERE refusal IS NOT NULL", "judged"))
def c11(spark, d) -> DataFrame:
    judged = lists.review(proposals(spark, d), entries(spark, d))
    return judged.where(F.col("refusal").isNotNull()).select("list", "entity_type", "entity_id", "block_count", "refusal")


_LIST_COLS = "list, entity_type, entity_id, reason, block_count, added_at_ms, expires_at_ms"
cte("upserted", f"""SELECT {_LIST_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY list, entity_type, entity_id ORDER BY added_at_ms DESC, new DESC) AS rn
  FROM (SELECT {_LIST_COLS}, 0 AS new FROM lst UNION ALL SELECT {_LIST_COLS}, 1 FROM judged WHERE refusal IS NULL)) WHERE rn = 1""", "judged")


@query("f4_list_upsert", oracle(f"SELECT {_LIST_COLS} FROM upserted", "upserted"))
def f4(spark, d) -> DataFrame:
    after, _ = lists.apply(entries(spark, d), proposals(spark, d))
    return after


@query("f5_list_expiry", oracle(f"SELECT {_LIST_COLS} FROM upserted WHERE expires_at_ms > {MID_MS + fx.DAY_MS}", "upserted"))
def f5(spark, d) -> DataFrame:
    after, _ = lists.apply(entries(spark, d), proposals(spark, d))
    return lists.expire(after, F.lit(MID_MS + fx.DAY_MS))


@query("f5_list_removal", oracle("""SELECT p.list, p.entity_type, p.entity_id, CASE WHEN l.list IS NULL THEN 0 ELSE 1 END AS removed
  FROM (SELECT DISTINCT list, entity_type, entity_id FROM prop) p LEFT JOIN (SELECT DISTINCT list, entity_type, entity_id FROM lst) l
  ON p.list = l.list AND p.entity_type = l.entity_type AND p.entity_id = l.entity_id""", "prop", "lst"))
def f5_removal(spark, d) -> DataFrame:
    return lists.removal_report(entries(spark, d), proposals(spark, d))


@query("f5_list_after_removal", oracle(f"SELECT {_LIST_COLS} FROM lst WHERE NOT EXISTS (SELECT 1 FROM prop p WHERE p.list = lst.list AND p.entity_type = lst.entity_type AND p.entity_id = lst.entity_id)", "prop", "lst"))
def f5_after(spark, d) -> DataFrame:
    return lists.remove(entries(spark, d), proposals(spark, d))


@query("d9_list_inventory", oracle(f"""SELECT l.list, t.entity_type, count(x.list) AS entries
  FROM (VALUES ('block'), ('hot'), ('white')) l(list) CROSS JOIN (VALUES ('card'), ('merchant'), ('ip'), ('device')) t(entity_type)
  LEFT JOIN lst x ON x.list = l.list AND x.entity_type = t.entity_type AND x.added_at_ms <= {MID_MS} AND {MID_MS} < x.expires_at_ms
  GROUP BY ALL""", "lst"))
def d9(spark, d) -> DataFrame:
    return lists.inventory(entries(spark, d), F.lit(MID_MS))


# --- repeat offenders -------------------------------------------------------------

OFFENDERS = {"card_window_s": 30 * DAY_S, "ip_window_s": 30 * DAY_S, "device_window_s": 30 * DAY_S,
             "merchant_window_s": 30 * DAY_S, "merchant_hot_rate": 0.03, "merchant_block_rate": 0.05}
_AS_OF = "(SELECT max(scored_at_ms) FROM sc)"
cte("oc", f"""SELECT entity_type, entity_id, count(*) AS total, count(*) FILTER (WHERE decision = 'BLOCK') AS blocks FROM (
  SELECT 'card' AS entity_type, card_token AS entity_id, decision, scored_at_ms FROM sc UNION ALL SELECT 'merchant', merchant_id_hash, decision, scored_at_ms FROM sc
  UNION ALL SELECT 'ip', ip_address_hash, decision, scored_at_ms FROM sc UNION ALL SELECT 'device', device_fingerprint_hash, decision, scored_at_ms FROM sc)
  WHERE scored_at_ms > {_AS_OF} - {30 * DAY_S * 1000} GROUP BY ALL""", "sc")


def _as_of(scored: DataFrame):
    return scored.agg(F.max("scored_at_ms")).scalar()


def _offenders_of(kind: str, cols: str, tier: str, where: str) -> str:
    return oracle(f"SELECT entity_id, {cols}, {tier} AS list FROM oc WHERE entity_type = '{kind}' AND {where}", "oc")


def _kind(spark, d, kind: str) -> DataFrame:
    s = fx.scored(spark, d)
    return lists.offenders(s, _as_of(s), **OFFENDERS).where(F.col("entity_type") == kind)


@query("d4_card_repeats", _offenders_of("card", "blocks", "CASE WHEN blocks >= 3 THEN 'block' ELSE 'hot' END", "blocks >= 2"))
def d4(spark, d) -> DataFrame:
    return _kind(spark, d, "card").select("entity_id", "blocks", "list")


@query("d5_merchant_rates", _offenders_of("merchant", "total, blocks, round(blocks / total, 6) AS rate",
                                          "CASE WHEN total >= 100 AND blocks / total >= 0.05 THEN 'block' ELSE 'hot' END", "total >= 30 AND blocks / total >= 0.03"))
def d5(spark, d) -> DataFrame:
    return _kind(spark, d, "merchant").select("entity_id", "total", "blocks", (F.col("blocks") / F.col("total")).alias("rate"), "list")


@query("d6_ip_bursts", _offenders_of("ip", "blocks", "'block'", "blocks >= 5"))
def d6(spark, d) -> DataFrame:
    return _kind(spark, d, "ip").select("entity_id", "blocks", "list")


@query("d7_device_repeats", _offenders_of("device", "blocks", "'block'", "blocks >= 3"))
def d7(spark, d) -> DataFrame:
    return _kind(spark, d, "device").select("entity_id", "blocks", "list")


cte("offd", f"""SELECT * FROM (SELECT entity_type, entity_id, blocks, total,
  CASE entity_type WHEN 'card' THEN CASE WHEN blocks >= 3 THEN 'block' WHEN blocks = 2 THEN 'hot' END
   WHEN 'merchant' THEN CASE WHEN total >= 100 AND blocks / total >= 0.05 THEN 'block' WHEN total >= 30 AND blocks / total >= 0.03 THEN 'hot' END
   WHEN 'ip' THEN CASE WHEN blocks >= 5 THEN 'block' END ELSE CASE WHEN blocks >= 3 THEN 'block' END END AS list,
  CASE entity_type WHEN 'card' THEN blocks || ' BLOCK decisions in last 30d' || CASE WHEN blocks = 2 THEN ' (hot-list)' ELSE '' END
   WHEN 'merchant' THEN 'merchant fraud rate ' || printf('%.0f', blocks / total * 100) || '% over ' || total || ' txns (30d' ||
     CASE WHEN total >= 100 AND blocks / total >= 0.05 THEN ')' ELSE ', hot-list)' END
   WHEN 'ip' THEN blocks || ' BLOCK decisions in last 30d (IP burst)' ELSE blocks || ' BLOCK decisions in last 30d (device)' END AS reason,
  {_AS_OF} AS added_at_ms FROM oc) WHERE list IS NOT NULL""", "oc")


@query("f6_offender_proposals", oracle("SELECT list, entity_type, entity_id, reason, blocks AS block_count, added_at_ms FROM offd", "offd"))
def f6(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    return lists.offender_proposals(s, _as_of(s), **OFFENDERS)


_REFUSED = """CASE WHEN list = 'block' AND blocks < 3 OR list = 'hot' AND blocks < 2 THEN true
  WHEN EXISTS (SELECT 1 FROM lst w WHERE w.list = 'white' AND w.entity_type = o.entity_type AND w.entity_id = o.entity_id
  AND w.added_at_ms <= o.added_at_ms AND o.added_at_ms < w.expires_at_ms) THEN true ELSE false END"""


# The published windows and rates, on times in which an hour passes as a minute; merchants are given their share of BLOCKs by their hash.
_SHARE = "CASE WHEN merchant_id_hash < '6' THEN 95 WHEN merchant_id_hash < 'b' THEN 60 ELSE 0 END"
_HASTE = {"decision": f"CASE WHEN CAST(event_id AS BIGINT) * 37 % 100 < {_SHARE} THEN 'BLOCK' ELSE decision END",
          "scored_at_ms": f"{fx.START_MS} + (scored_at_ms - {fx.START_MS}) // 60"}
cte("pub", f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _HASTE.items())}) FROM sc", "sc")
cte("puboc", """SELECT entity_type, entity_id, count(*) AS total, count(*) FILTER (WHERE decision = 'BLOCK') AS blocks FROM (
  SELECT 'card' AS entity_type, card_token AS entity_id, decision, scored_at_ms, 86400000 AS span FROM pub UNION ALL SELECT 'merchant', merchant_id_hash, decision, scored_at_ms, 604800000 FROM pub
  UNION ALL SELECT 'ip', ip_address_hash, decision, scored_at_ms, 3600000 FROM pub UNION ALL SELECT 'device', device_fingerprint_hash, decision, scored_at_ms, 86400000 FROM pub)
  WHERE scored_at_ms > (SELECT max(scored_at_ms) FROM pub) - span GROUP BY ALL""", "pub")


@query("f6_offender_published_rules", oracle("""SELECT * FROM (SELECT CASE entity_type WHEN 'card' THEN CASE WHEN blocks >= 3 THEN 'block' WHEN blocks = 2 THEN 'hot' END
   WHEN 'merchant' THEN CASE WHEN total >= 100 AND blocks / total >= 0.9 THEN 'block' WHEN total >= 30 AND blocks / total >= 0.5 THEN 'hot' END
   WHEN 'ip' THEN CASE WHEN blocks >= 5 THEN 'block' END ELSE CASE WHEN blocks >= 3 THEN 'block' END END AS list, entity_type, entity_id,
  CASE entity_type WHEN 'card' THEN blocks || ' BLOCK decisions in last 24h' || CASE WHEN blocks = 2 THEN ' (hot-list)' ELSE '' END
   WHEN 'merchant' THEN 'merchant fraud rate ' || printf('%.0f', blocks / total * 100) || '% over ' || total || ' txns (7d' ||
     CASE WHEN total >= 100 AND blocks / total >= 0.9 THEN ')' ELSE ', hot-list)' END
   WHEN 'ip' THEN blocks || ' BLOCK decisions in last 1h (IP burst)' ELSE blocks || ' BLOCK decisions in last 24h (device)' END AS reason,
  blocks AS block_count, (SELECT max(scored_at_ms) FROM pub) AS added_at_ms FROM puboc) WHERE list IS NOT NULL""", "puboc"))
def f6_published(spark, d) -> DataFrame:
    """D4-D7 as published: 24 h for cards and devices, 7 days for merchants, 1 h for addresses."""
    s = fx.scored(spark, d).withColumns({c: F.expr(e.replace("//", "div")) for c, e in _HASTE.items()})
    return lists.offender_proposals(s, _as_of(s))


@query("d8_update_summary", oracle(f"""SELECT t.entity_type, count(o.list) AS scanned, count(*) FILTER (WHERE NOT no AND list = 'block') AS blocked,
  count(*) FILTER (WHERE NOT no AND list = 'hot') AS hot, count(*) FILTER (WHERE no) AS refused
  FROM (VALUES ('card'), ('merchant'), ('ip'), ('device')) t(entity_type) LEFT JOIN (SELECT *, {_REFUSED} AS no FROM offd o) o ON o.entity_type = t.entity_type
  GROUP BY ALL""", "offd", "lst"))
def d8(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    return lists.update_summary(s, entries(spark, d), _as_of(s), **OFFENDERS)


@query("f6_offender_update", oracle(f"""SELECT {_LIST_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY list, entity_type, entity_id ORDER BY added_at_ms DESC, new DESC) AS rn FROM (
  SELECT {_LIST_COLS}, 0 AS new FROM lst UNION ALL
  SELECT list, entity_type, entity_id, reason, blocks, added_at_ms, added_at_ms + CASE entity_type WHEN 'merchant' THEN 604800 WHEN 'ip' THEN 3600 ELSE 86400 END * 1000::BIGINT, 1
  FROM offd o WHERE NOT {_REFUSED})) WHERE rn = 1""", "offd", "lst"))
def f6_apply(spark, d) -> DataFrame:
    s = fx.scored(spark, d)
    after, _ = lists.apply(entries(spark, d), lists.offender_proposals(s, _as_of(s), **OFFENDERS))
    return after


# --- velocity ---------------------------------------------------------------------

def _span(label: str, seconds: int) -> str:
    back = seconds * 1000 - (1 if label == "60min" else 0)
    return f"count(*) OVER (PARTITION BY card_token ORDER BY event_timestamp_ms RANGE BETWEEN {back} PRECEDING AND CURRENT ROW)"


_HIT = [f"n_{w} >= {t}" for w, _, t in WINDOWS]
cte("velo", f"""SELECT *, ({' OR '.join(_HIT)}) AS velocity_hit,
  CASE {' '.join(f"WHEN {h} THEN '{w}'" for h, (w, _, _t) in zip(_HIT, WINDOWS))} ELSE '' END AS velocity_window,
  CASE {' '.join(f"WHEN {h} THEN n_{w} || ' txns on card in {w} (threshold {t})'" for h, (w, _, t) in zip(_HIT, WINDOWS))} ELSE '' END AS velocity_reason
  FROM (SELECT event_id, card_token, {', '.join(f'{_span(w, s)} AS n_{w}' for w, s, _ in WINDOWS)} FROM chk WHERE NOT blocklist_hit)""", "chk")


@query("e1_velocity", oracle("""SELECT c.event_id, coalesce(n_1min, 0) AS n_1min, coalesce(n_10min, 0) AS n_10min, coalesce(n_60min, 0) AS n_60min,
  coalesce(velocity_hit, false) AS velocity_hit, coalesce(velocity_window, '') AS velocity_window, coalesce(velocity_reason, '') AS velocity_reason
  FROM chk c LEFT JOIN velo v USING (event_id)""", "velo"))
def e1(spark, d) -> DataFrame:
    out = scoring.rules(fx.transactions(spark, d), entries(spark, d), WINDOWS, fx.DAY_MS)
    return out.select("event_id", "n_1min", "n_10min", "n_60min", "velocity_hit", "velocity_window", "velocity_reason")


# The published windows, on times in which a day passes as a minute.
_QUICK = f"{fx.START_MS} + (event_timestamp_ms - {fx.START_MS}) // 1440"
_QUICK_HIT = [(w, t, f"n_{w} >= {t}") for w, _, t in K.VELOCITY_WINDOWS]


@query("e1_velocity_published_windows", oracle(f"""SELECT event_id, {', '.join(f'n_{w}' for w, _, _ in K.VELOCITY_WINDOWS)}, {' OR '.join(h for _, _, h in _QUICK_HIT)} AS velocity_hit,
  CASE {' '.join(f"WHEN {h} THEN '{w}'" for w, _, h in _QUICK_HIT)} ELSE '' END AS velocity_window,
  CASE {' '.join(f"WHEN {h} THEN n_{w} || ' txns on card in {w} (threshold {t})'" for w, t, h in _QUICK_HIT)} ELSE '' END AS velocity_reason
  FROM (SELECT event_id, {', '.join(f'{_span(w, s)} AS n_{w}' for w, s, _ in K.VELOCITY_WINDOWS)}
    FROM (SELECT event_id, card_token, {_QUICK} AS event_timestamp_ms FROM tx))""", "tx"))
def e1_published(spark, d) -> DataFrame:
    quick = F.expr(_QUICK.replace("//", "div"))
    out = velocity.check(fx.transactions(spark, d).withColumn("event_timestamp_ms", quick), K.VELOCITY_WINDOWS)
    return out.select("event_id", "n_1min", "n_10min", "n_60min", "velocity_hit", "velocity_window", "velocity_reason")


@query("e2_current_counts", oracle(f"""SELECT card_token, {', '.join(f"count(*) FILTER (WHERE event_timestamp_ms >= {MID_MS} - {s * 1000 - (1 if w == '60min' else 0)}) AS n_{w}" for w, s, _ in WINDOWS)}
  FROM tx WHERE event_timestamp_ms <= {MID_MS} AND event_timestamp_ms >= {MID_MS} - {WINDOWS[-1][1] * 1000 - 1} GROUP BY card_token""", "tx"))
def e2(spark, d) -> DataFrame:
    return velocity.current_counts(fx.transactions(spark, d), F.lit(MID_MS), WINDOWS)


# --- fast path ----------------------------------------------------------------------

def scorecard() -> scoring.Scorecard:
    return scoring.Scorecard(
        -4.2, {"log_amount": 0.75, "is_night": 0.9, "is_high_amount": 1.1, "p_email_missing": 0.8, "dist1": 0.00005},
        high_amount=fx.HIGH, extra={"dist1": F.col("geo_distance_km")})


def _scored_at():
    n = F.col("event_id").cast("long")
    return F.col("event_timestamp_ms") + 5 + n % 97, 5 + (n * 7919) % 120


def fast(spark, d) -> DataFrame:
    at, latency = _scored_at()
    return scoring.fast_path(fx.transactions(spark, d), entries(spark, d), scorecard(), WINDOWS,
                             scored_at=at, latency=latency, block_ms=fx.DAY_MS)


_RULE_HIT = "(blocklist_hit OR coalesce(velocity_hit, false))"
_COMPLETE = "round((14 + CASE WHEN regexp_full_match(merchant_country, '[0-9]+') THEN 1 ELSE 0 END) / 43.0, 4)::DOUBLE"
cte("fast", f"""SELECT {EVENT_COLS}, fraud_score,
  CASE WHEN blocklist_tier = 'BLOCK' THEN 'BLOCK' WHEN {_RULE_HIT} THEN 'REVIEW' ELSE {decide('fraud_score')} END AS decision,
  'scorecard' AS model_name, 'v1' AS model_version, event_timestamp_ms + 5 + event_id::BIGINT % 97 AS scored_at_ms,
  5 + (event_id::BIGINT * 7919) % 120 AS scoring_latency_ms, CASE WHEN {_RULE_HIT} THEN 0.0 ELSE {_COMPLETE} END AS feature_completeness,
  blocklist_hit, blocklist_tier, blocklist_reason, coalesce(velocity_hit, false) AS velocity_hit,
  coalesce(velocity_window, '') AS velocity_window, coalesce(velocity_reason, '') AS velocity_reason
  FROM (SELECT c.*, v.velocity_hit, v.velocity_window, v.velocity_reason,
    CASE WHEN blocklist_tier = 'BLOCK' THEN 1.0 WHEN {_RULE_HIT} THEN 0.5 ELSE {SCORE1} END::DOUBLE AS fraud_score
    FROM chk c LEFT JOIN velo v USING (event_id))""", "velo")


@query("f1_fast_path", oracle(f"SELECT {EVENT_COLS}, {SCORE_COLS} FROM fast", "fast"), "fraud_score feature_completeness")
def f1(spark, d) -> DataFrame:
    return fast(spark, d)


@query("f1_decision_split", oracle("""SELECT decision, count(*) AS events, 100.0 * count(*) / sum(count(*)) OVER () AS share_pct,
  avg(fraud_score) AS avg_score, avg(scoring_latency_ms) AS avg_latency_ms, count(*) FILTER (WHERE velocity_hit) AS velocity_rule
  FROM fast GROUP BY decision""", "fast"), "share_pct avg_score avg_latency_ms")
def f1_split(spark, d) -> DataFrame:
    from txnguard.operators.analytics import decision_split
    return decision_split(fast(spark, d))


# --- score reuse ---------------------------------------------------------------------

@query("b20_feature_hash", oracle(f"""SELECT count(DISTINCT h) AS hashes, count(*) AS events FROM (
  SELECT DISTINCT ON (event_id) event_id, concat_ws('|', {', '.join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in _REAL)}) AS h FROM live)""", "live"))
def b20(spark, d) -> DataFrame:
    """Different values hash differently: as many hashes as distinct vectors."""
    x = features.live_features(fx.transactions(spark, d))
    return x.select(scoring.feature_hash(K.FEATURES).alias("h")).groupBy("h").count().agg(
        F.count(F.lit(1)).alias("hashes"), F.sum("count").alias("events"))


@query("e9_score_reuse", oracle(f"SELECT event_id, fraud_score FROM (SELECT event_id, {SCORE1.replace('geo_distance_km', '0')} AS fraud_score FROM (SELECT event_id, merchant_name, event_timestamp_ms, geo_distance_km, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount FROM tx))", "tx"), "fraud_score", digits=4)
def e9(spark, d) -> DataFrame:
    """Each distinct feature vector is scored once; equal vectors share the score."""
    x = features.live_features(fx.transactions(spark, d))

    def score(v: DataFrame) -> DataFrame:
        a = F.expm1(F.col("log_amount").cast("double"))
        z = (F.lit(-4.2) + 0.75 * F.col("log_amount").cast("double") + 0.9 * F.col("is_night").cast("double")
             + 1.1 * (a > fx.HIGH + 0.0001).cast("double") + 0.8 * F.col("p_email_missing").cast("double"))
        return v.withColumn("fraud_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))

    return scoring.score_once(x, K.FEATURES, score).select("event_id", "fraud_score")


# --- merges ----------------------------------------------------------------------------

_FIRST = [c for c in EVENT_FIELDS if c != "event_id"]
_LAST = SCORE_COLS.split(", ")


@query("a8_latest_wins", oracle("SELECT event_id, " + ", ".join(f"first({c} ORDER BY arrival) AS {c}" for c in _FIRST) + ", "
                               + ", ".join(f"first({c} ORDER BY scored_at_ms DESC, arrival DESC) AS {c}" for c in _LAST)
                               + " FROM dlv GROUP BY event_id", "dlv"), "fraud_score", digits=10)
def a8(spark, d) -> DataFrame:
    return merge.merge_scored(fx.deliveries(spark, d))


@query("a8_latest_wins_lineitem", """SELECT l_orderkey, l_linenumber, first(l_partkey ORDER BY arrival) AS l_partkey, first(l_suppkey ORDER BY arrival) AS l_suppkey,
  first(l_quantity ORDER BY l_shipdate DESC, arrival DESC) AS l_quantity, first(l_extendedprice ORDER BY l_shipdate DESC, arrival DESC) AS l_extendedprice
  FROM (SELECT *, l_partkey * 100000 + l_suppkey + l_extendedprice / 10000000 AS arrival FROM lineitem) GROUP BY l_orderkey, l_linenumber""")
def a8_lineitem(spark, d) -> DataFrame:
    """The same fold on a table whose key repeats."""
    rows = fx.table(spark, d, "lineitem").withColumns({
        "arrival": F.col("l_partkey") * 100000 + F.col("l_suppkey") + F.col("l_extendedprice") / 10000000,
        "line": F.struct("l_orderkey", "l_linenumber")})
    out = merge.latest_wins(rows, ["l_partkey", "l_suppkey"], ["l_quantity", "l_extendedprice"], "l_shipdate", "arrival", "line")
    return out.select("line.l_orderkey", "line.l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("a9_matched_update", oracle("""SELECT event_id, decision, CASE WHEN id % 3 = 0 THEN round(fraud_score / 2, 6) END AS text_anomaly_score,
  CASE WHEN id % 3 = 0 THEN 'NORMAL' END AS text_anomaly_label, CASE WHEN id % 3 = 0 THEN scored_at_ms + 7 END AS text_scored_at_ms FROM scf""", "scf"), "text_anomaly_score")
def a9(spark, d) -> DataFrame:
    s = fx.scored_full(spark, d)
    table = s.selectExpr("event_id", "decision", "cast(null AS double) AS text_anomaly_score",
                         "cast(null AS string) AS text_anomaly_label", "cast(null AS long) AS text_scored_at_ms")
    new = s.where("id % 3 = 0").selectExpr("event_id", "round(fraud_score / 2, 6) AS text_anomaly_score",
                                           "'NORMAL' AS text_anomaly_label", "scored_at_ms + 7 AS text_scored_at_ms")
    stray = new.limit(0)
    return merge.update_matched(table, new.unionByName(stray), ["text_anomaly_score", "text_anomaly_label", "text_scored_at_ms"])


@query("a14_second_scorer_rows", oracle(f"SELECT {EVENT_COLS}, fraud_score, decision, model_name, model_version, scored_at_ms, scoring_latency_ms, feature_completeness, blocklist_reason AS llm_reason FROM sc2", "sc2"), "fraud_score", digits=8)
def a14(spark, d) -> DataFrame:
    return merge.second_scorer_rows(fx.second_scored(spark, d))


@query("a16_peek", oracle("SELECT event_id, decision, fraud_score FROM sc ORDER BY scored_at_ms, event_id LIMIT 20", "sc"), "fraud_score", digits=8)
def a16(spark, d) -> DataFrame:
    return fx.scored(spark, d).orderBy("scored_at_ms", "event_id").limit(20).select("event_id", "decision", "fraud_score")


OPS_SQL = """SELECT CASE k % 3 WHEN 0 THEN 'consumer_lag' WHEN 1 THEN 'rpm_used' ELSE 'rpm_headroom' END AS metric_name,
  'group' || (user_id % 5) || '/' || event_type AS scope, value AS metric_value, ms AS captured_at, id FROM fx"""
cte("ops", OPS_SQL, "fx")


@query("e3_latest_per_metric", oracle("""SELECT metric_name, scope, first(metric_value ORDER BY captured_at DESC, id DESC) AS metric_value,
  max(captured_at) AS captured_at FROM ops GROUP BY metric_name, scope""", "ops"))
def e3(spark, d) -> DataFrame:
    ops = fx.base(spark, d).selectExpr(
        "CASE k % 3 WHEN 0 THEN 'consumer_lag' WHEN 1 THEN 'rpm_used' ELSE 'rpm_headroom' END AS metric_name",
        "concat('group', cast(user_id % 5 AS string), '/', event_type) AS scope", "value AS metric_value", "ms AS captured_at", "id")
    stamped = ops.withColumn("version", F.struct("captured_at", "id"))
    return merge.latest_per(stamped, ["metric_name", "scope"], "version").select("metric_name", "scope", "metric_value", "captured_at")


@query("e10_requests_per_minute", oracle("""SELECT event_id, n AS n_minute, n > 25 AS over_cap FROM (SELECT event_id, count(*) OVER (ORDER BY scored_at_ms // 240 RANGE BETWEEN 59999 PRECEDING AND CURRENT ROW) AS n FROM sc2)""", "sc2"))
def e10(spark, d) -> DataFrame:
    """Requests in the trailing minute (time compressed 240 times to reach the cap)."""
    calls = fx.second_scored(spark, d).selectExpr("event_id", "scored_at_ms div 240 AS at", "'scorer' AS scope")
    n = trailing_totals(calls, "scope", "at", {"n": F.lit(1)}, {"minute": (59_999, 0)}, 60_000)
    return calls.join(n, ["scope", "at"]).select("event_id", "n_minute", (F.col("n_minute") > K.LLM_REQUESTS_PER_MINUTE).alias("over_cap"))
