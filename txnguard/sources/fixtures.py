"""The driver's tables seen as payment records.

``events`` become transactions; every derived input (scores, labels, lists,
re-deliveries, raw training rows, requests) is a fixed function of them, so it
grows with the tables it is read from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.schemas import EVENT_FIELDS, SCORED

SALT = "fixture-salt"
START_MS = 1_704_067_200_000  # 2024-01-01
DAY_MS = 86_400_000
HIGH = 147.0
DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "anonymous.com", "nan", "", "XJ8K2-zzz9.com", "aol.com"]
PRODUCTS = {"purchase": "W", "click": "C", "view": "R", "signup": "H", "error": "S"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tok(value: Column) -> Column:
    return X.tokenize(value, SALT)


def _tok(expr: str) -> str:
    return f"substring(sha2(concat_ws('|', {expr}, '{SALT}'), 256), 1, 16)"


def base_of(events: DataFrame) -> DataFrame:
    """id, user, type, value, ms, k, product, domain."""
    e = events.selectExpr(
        "event_id AS id", "user_id", "event_type", "value",
        "unix_millis(cast(ts AS timestamp)) AS ms", "cast(get_json_object(props, '$.k') AS int) AS k")
    domains = ", ".join(f"'{x}'" for x in DOMAINS)
    products = " ".join(f"WHEN '{t}' THEN '{p}'" for t, p in PRODUCTS.items())
    return e.selectExpr("*", f"CASE event_type {products} END AS product", f"array({domains})[k % 8] AS domain")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_of(table(spark, sf_dir, "events"))


EVENT_SQL = {
    "event_id": "cast(id AS string)",
    "event_timestamp_ms": "ms",
    "customer_id": "cast(user_id AS string)",
    "card_token": _tok("cast(user_id AS string), event_type"),
    "amount": "value",
    "currency": "'USD'",
    "amount_fx_normalised": "value",
    "merchant_id_hash": _tok("product, cast(k % 20 AS string)"),
    "merchant_name": "concat(product, '-MERCHANT-', domain)",
    "mcc": "CASE WHEN k >= 97 THEN '7995' ELSE CASE product WHEN 'W' THEN '5411' WHEN 'C' THEN '5732' "
           "WHEN 'R' THEN '5812' WHEN 'H' THEN '7011' ELSE '5999' END END",
    "merchant_country": "CASE k % 5 WHEN 0 THEN '00' WHEN 1 THEN 'US' ELSE cast(80 + k % 10 AS string) END",
    "ip_address_hash": _tok("'ip', cast(user_id AS string)"),
    "device_fingerprint_hash": _tok("'dev', cast(user_id AS string)"),
    "geo_distance_km": "cast(CASE WHEN k % 4 = 0 THEN 0 ELSE k * 97 END AS double)",
    "source_label": "'replayer'",
    "schema_version": "'v1'",
}


def with_event_columns(b: DataFrame) -> DataFrame:
    """All 16 event fields next to the helper columns."""
    return b.selectExpr("*", *[f"{sql} AS {name}" for name, sql in EVENT_SQL.items()])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_columns(base(spark, sf_dir)).select(*EVENT_FIELDS)


NIGHT = "(hour(timestamp_millis(event_timestamp_ms)) < 6 OR hour(timestamp_millis(event_timestamp_ms)) >= 22)"
# The domain is missing, `nan` or anonymous.
ODD_DOMAIN = "merchant_name RLIKE '-MERCHANT-(nan|missing|anonymous.com)?$'"


def _linear(intercept: float, log_w: float, night_w: float, high_w: float, odd_w: float, geo_w: float) -> str:
    z = (f"{intercept}D + {log_w}D * log1p(amount) + {night_w}D * cast({NIGHT} AS double) "
         f"+ {high_w}D * cast(amount > {HIGH}D AS double) + {odd_w}D * cast({ODD_DOMAIN} AS double) + {geo_w}D * geo_distance_km")
    return f"round(1D / (1D + exp(-({z}))), 8)"


FIRST_SCORE = _linear(-4.2, 0.75, 0.9, 1.1, 0.8, 0.00005)
SECOND_SCORE = _linear(-3.9, 0.70, 0.6, 1.3, 0.5, 0.00009)
LABEL = (f"cast((id * 2654435761) % 1000 < 15 + 120 * cast(amount > {HIGH}D AS int) + 40 * cast({NIGHT} AS int) AS int)")
DECIDE = f"CASE WHEN {{0}} >= {K.BLOCK_AT} THEN 'BLOCK' WHEN {{0}} >= {K.REVIEW_AT} THEN 'REVIEW' ELSE 'ALLOW' END"


def first_score() -> Column:
    return F.expr(FIRST_SCORE)


def label() -> Column:
    """1 for a fixed pseudo-random share that rises with amount and at night."""
    return F.expr(LABEL)


def scored_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records with fixture rule flags, plus id, k, product, domain and label."""
    return scored_of(base(spark, sf_dir))


def scored_of(b: DataFrame) -> DataFrame:
    d = with_event_columns(b).selectExpr(
        "*", f"{LABEL} AS label", "id % 101 = 0 AS blocklist_hit", "id % 67 = 0 AND id % 101 <> 0 AS velocity_hit")
    d = d.selectExpr("*", f"CASE WHEN blocklist_hit THEN 1D WHEN velocity_hit THEN 0.5D ELSE {FIRST_SCORE} END AS fraud_score")
    return d.selectExpr(
        "*", f"{DECIDE.format('fraud_score')} AS decision", "'scorecard' AS model_name", "'v1' AS model_version",
        "ms + 5 + id % 97 AS scored_at_ms", "5 + (id * 7919) % 120 AS scoring_latency_ms",
        "CASE WHEN blocklist_hit OR velocity_hit THEN 0D WHEN k % 5 = 1 THEN 0.3256D ELSE 0.3488D END AS feature_completeness",
        "if(blocklist_hit, 'BLOCK', 'NONE') AS blocklist_tier",
        "if(blocklist_hit, concat('rule ', cast(id % 3 AS string)), '') AS blocklist_reason",
        "if(velocity_hit, '1min', '') AS velocity_window", "if(velocity_hit, 'burst', '') AS velocity_reason")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_full(spark, sf_dir).select(*SCORED.fieldNames())


def second_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other scorer: three quarters of the events, its reason in ``blocklist_reason``."""
    return second_of(base(spark, sf_dir))


def second_of(b: DataFrame) -> DataFrame:
    d = with_event_columns(b).where("id % 4 <> 0").selectExpr("*", f"{SECOND_SCORE} AS fraud_score")
    return d.selectExpr(
        *EVENT_FIELDS, "fraud_score", f"{DECIDE.format('fraud_score')} AS decision", "'second' AS model_name",
        "'v1' AS model_version", "ms + 200 + id % 89 AS scored_at_ms", "150 + (id * 31) % 400 AS scoring_latency_ms",
        "1D AS feature_completeness", "concat('second opinion on ', merchant_name) AS blocklist_reason")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records with an arrival order; one tenth arrives again, changed."""
    first = scored_full(spark, sf_dir).withColumn("arrival", F.col("id"))
    again = first.where(F.col("id") % 10 == 0).withColumns({
        "arrival": F.col("id") + 10_000_000,
        "amount": F.col("amount") + 1,
        "source_label": F.lit("appeal"),
        "fraud_score": F.col("fraud_score") / 2,
        "decision": X.decide(F.col("fraud_score") / 2),
        "scored_at_ms": F.col("scored_at_ms") + (F.col("id") % 3 - 1) * 1000,
    })
    return first.unionByName(again).select(*SCORED.fieldNames(), "arrival")


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List rows by user number: blocked, hot, white, expired and future ones."""
    events = table(spark, sf_dir, "events")
    users = events.select(F.col("user_id").alias("u")).distinct()
    u = F.col("u").cast("string")

    def rows(src, cond, name, kind, entity, reason, count, start, end):
        return src.where(cond).select(
            F.lit(name).alias("list"), F.lit(kind).alias("entity_type"), tok(entity).alias("entity_id"),
            reason.alias("reason"), F.lit(count).cast("long").alias("block_count"),
            F.lit(START_MS + start * DAY_MS).alias("added_at_ms"),
            F.lit(START_MS + end * DAY_MS).alias("expires_at_ms"))

    m = F.col("u") % 10
    card = F.concat(u, F.lit("|purchase"))
    ip, dev = F.concat(F.lit("ip|"), u), F.concat(F.lit("dev|"), u)
    shops = (base(spark, sf_dir).where((F.col("product") == "W") & (F.col("k") % 20 == 3))
             .select(F.lit("W|3").alias("shop")).distinct())
    parts = [
        rows(users, m.isin(5, 8), "block", "card", card, F.concat(F.lit("card of "), u), 3, 0, 60),
        rows(users, m == 8, "white", "ip", ip, F.lit("trusted"), 0, 0, 60),
        rows(users, m == 9, "block", "device", dev, F.lit("lapsed"), 3, -30, 0),
        rows(users, m == 3, "block", "ip", ip, F.concat(F.lit("ip of "), u), 5, 15, 60),
        rows(users, m == 2, "hot", "device", dev, F.concat(F.lit("device of "), u), 2, 0, 10),
        rows(users, m == 5, "hot", "ip", ip, F.lit("also hot"), 2, 0, 60),
        rows(shops, F.lit(True), "hot", "merchant", F.col("shop"), F.lit("merchant fraud rate"), 2, 0, 60),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _raw_sql() -> dict[str, str]:
    def unless(cond: str, value: str) -> str:
        return f"CASE WHEN {cond} THEN NULL ELSE {value} END"

    def num(sql: str) -> str:
        return f"cast({sql} AS double)"

    cols = {
        "TransactionID": "id", "isFraud": LABEL, "TransactionDT": f"(ms - {START_MS}) div 1000",
        "TransactionAmt": "value", "ProductCD": "product", "card1": num("user_id"),
        "card2": num(unless("k % 11 = 0", "100 + k")), "card3": "150D", "card5": num("100 + k % 50"),
        "card4": unless("k % 7 = 0", "array('visa', 'mastercard', 'discover', 'american express')[k % 4]"),
        "card6": unless("k % 13 = 0", "if(k % 3 = 0, 'credit', 'debit')"),
        "addr1": num(unless("k % 9 = 0", "200 + k")), "addr2": num(unless("k % 5 = 0", "80 + k % 10")),
        "dist1": num(unless("k % 4 = 0", "k * 97")), "dist2": num(unless("k % 20 <> 0", "k * 3")),
        "P_emaildomain": unless("domain IN ('nan', '')", "lower(domain)"),
        "R_emaildomain": unless("k % 3 = 0", "if(k % 2 = 0, 'gmail.com', 'yahoo.com')"),
    }
    cols |= {f"M{i}": unless(f"(k + {i}) % 7 = 0", f"if((k + {i}) % 3 = 0, 'T', 'F')") for i in range(1, 10)}
    cols |= {c: num(f"k % {m}") for c, m in (("C1", 6), ("C2", 4), ("C5", 2), ("C13", 30), ("C14", 8))}
    return cols | {"D1": num("id % 300"), "D2": num(unless("k % 3 <> 0", "id % 200")),
                   "D4": num(unless("k % 4 = 1", "id % 150")), "D10": num(unless("k % 6 = 0", "id % 90")),
                   "D15": num(unless("k % 8 = 0", "id % 400"))}


RAW_SQL = _raw_sql()


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw training rows with the training columns' types and missing values."""
    d = with_event_columns(base(spark, sf_dir))
    return d.selectExpr(*[f"{sql} AS {name}" for name, sql in RAW_SQL.items()])


def appeal_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appeals on every 37th event, with unknown ids and bad roles among them."""
    b = base(spark, sf_dir).where(F.col("id") % 37 == 0)
    id_ = F.col("id")
    return b.select(
        F.when(id_ % 5 == 0, F.concat(F.lit("unknown-"), id_.cast("string"))).otherwise(id_.cast("string")).alias("event_id"),
        F.concat(F.lit("name "), (id_ % 11).cast("string")).alias("appellant_name"),
        F.when(id_ % 7 == 0, "robot").when(id_ % 3 == 0, "analyst").otherwise("customer").alias("appellant_role"),
        F.concat(F.lit("appeal reason "), id_.cast("string")).alias("reason"),
        (F.col("ms") + DAY_MS).alias("submitted_at_ms"))


def feedback_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every 9th event, some unknown, some malformed, some given twice."""
    b = with_event_columns(base(spark, sf_dir)).where(F.col("id") % 9 == 0)
    id_ = F.col("id")
    first = b.select(
        F.when(id_ % 8 == 0, F.concat(F.lit("unknown-"), id_.cast("string"))).otherwise(F.col("event_id")).alias("event_id"),
        F.concat(F.lit("analyst "), (id_ % 4).cast("string")).alias("analyst_name"),
        F.when(id_ % 35 == 0, "intern").when(id_ % 2 == 0, "system").otherwise("analyst").alias("analyst_role"),
        F.when(id_ % 25 == 0, "maybe").when(label() == 1, "fraud").when(id_ % 6 == 0, "FRAUD").otherwise("legit").alias("verdict"),
        F.lit("").alias("notes"),
        (F.col("ms") + 2 * DAY_MS).alias("submitted_at_ms"), id_.alias("id"))
    again = first.where(F.col("id") % 4 == 1).withColumns({
        "verdict": F.lit("LEGIT"), "submitted_at_ms": F.col("submitted_at_ms") + 1000})
    return first.unionByName(again).drop("id")
