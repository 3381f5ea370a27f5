"""Record types, their defaults, enum domains and table types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


EVENT = _struct(
    ("event_id", S), ("event_timestamp_ms", L), ("customer_id", S), ("card_token", S),
    ("amount", D), ("currency", S), ("amount_fx_normalised", D), ("merchant_id_hash", S),
    ("merchant_name", S), ("mcc", S), ("merchant_country", S), ("ip_address_hash", S),
    ("device_fingerprint_hash", S), ("geo_distance_km", D), ("source_label", S), ("schema_version", S),
)
EVENT_FIELDS = EVENT.fieldNames()

_SCORE_CORE = [
    ("fraud_score", D), ("decision", S), ("model_name", S), ("model_version", S),
    ("scored_at_ms", L), ("scoring_latency_ms", L), ("feature_completeness", D),
]
_RULE = [
    ("blocklist_hit", B), ("blocklist_tier", S), ("blocklist_reason", S),
    ("velocity_hit", B), ("velocity_window", S), ("velocity_reason", S),
]
SCORED = T.StructType(EVENT.fields + _struct(*_SCORE_CORE, *_RULE).fields)
SCORE_FIELDS = [name for name, _ in _SCORE_CORE + _RULE]

CONTRIBUTORS = T.ArrayType(_struct(("feature_name", S), ("feature_value", D), ("shap_value", D)))
ENRICHED = T.StructType(
    EVENT.fields + _struct(*_SCORE_CORE).fields + _struct(
        ("top_contributors", CONTRIBUTORS), ("narrative", S), ("narrator_mode", S),
        ("narrative_grading_passed", B), ("enriched_at_ms", L), ("enrichment_latency_ms", L),
    ).fields
)
FEEDBACK = _struct(
    ("event_id", S), ("analyst_name", S), ("analyst_role", S), ("model_decision", S),
    ("model_fraud_score", D), ("analyst_verdict", S), ("model_agreed", B), ("notes", S), ("submitted_at_ms", L),
)
LIST_ENTRY = _struct(
    ("list", S), ("entity_type", S), ("entity_id", S), ("reason", S),
    ("block_count", L), ("added_at_ms", L), ("expires_at_ms", L),
)
RAW = T.StructType(_struct(
    ("TransactionID", L), ("isFraud", T.IntegerType()), ("TransactionDT", L), ("TransactionAmt", D), ("ProductCD", S),
    ("card1", D), ("card2", D), ("card3", D), ("card5", D), ("card4", S), ("card6", S),
    ("addr1", D), ("addr2", D), ("dist1", D), ("dist2", D), ("P_emaildomain", S), ("R_emaildomain", S),
).fields + [T.StructField(f"M{i}", S) for i in range(1, 10)]
  + [T.StructField(c, D) for c in ["C1", "C2", "C5", "C13", "C14", "D1", "D2", "D4", "D10", "D15"]])

SCHEMAS = {"event": EVENT, "scored": SCORED, "enriched": ENRICHED, "feedback": FEEDBACK}

DEFAULTS = {
    "event": {"source_label": "replayer", "schema_version": "v1"},
    "scored": {"blocklist_hit": False, "blocklist_tier": "NONE", "blocklist_reason": "",
               "velocity_hit": False, "velocity_window": "", "velocity_reason": ""},
    "enriched": {"narrative_grading_passed": True},
    "feedback": {"analyst_name": "unknown", "analyst_role": "analyst", "notes": ""},
}

ENUMS = {
    "scored": {"decision": ["ALLOW", "REVIEW", "BLOCK"], "blocklist_tier": ["NONE", "HOT", "BLOCK"]},
    "enriched": {"decision": ["ALLOW", "REVIEW", "BLOCK"],
                 "narrator_mode": ["TEMPLATE", "GEMINI", "GEMINI_CACHED"]},
    "feedback": {"model_decision": ["ALLOW", "REVIEW", "BLOCK"], "analyst_verdict": ["FRAUD", "LEGIT"]},
    "event": {},
}

TABLE_DECIMALS = {
    "amount": (14, 4), "amount_fx_normalised": (14, 4), "geo_distance_km": (10, 4),
    "fraud_score": (10, 8), "feature_completeness": (6, 4), "text_anomaly_score": (10, 6),
}


def conform(df: DataFrame, record: str) -> DataFrame:
    """Project ``df`` onto a record type: order, cast, and fill declared defaults."""
    have = set(df.columns)
    defaults = DEFAULTS[record]

    def field(f: T.StructField) -> Column:
        value = F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]))
        return value.alias(f.name)

    return df.select(*[field(f) for f in SCHEMAS[record].fields])


def domain_violations(df: DataFrame, record: str) -> DataFrame:
    """One row per enum field: values outside the declared domain."""
    checks = ENUMS[record]
    counted = df.agg(*[F.count_if(~F.coalesce(F.col(c).isin(v), F.lit(False))).alias(c) for c, v in checks.items()])
    return counted.unpivot([], list(checks), "field", "violations")


def to_table_types(df: DataFrame) -> DataFrame:
    """Money and score columns as the stored fixed-point types (scores round to 8 places)."""
    return df.withColumns({c: F.col(c).cast(T.DecimalType(*TABLE_DECIMALS[c]))
                           for c in df.columns if c in TABLE_DECIMALS})


def with_calendar(df: DataFrame, ms: str = "scored_at_ms") -> DataFrame:
    """Columns generated on write: UTC hour and English weekday name."""
    at = F.timestamp_millis(F.col(ms))
    return df.withColumns({"event_hour": F.hour(at), "event_day_of_week": F.date_format(at, "EEEE")})
