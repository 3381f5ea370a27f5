"""Pattern rules and behavioural profiles over a card's, customer's or merchant's past."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard.operators.timeline import HOUR_MS, totals_before, trailing_totals

#: Pattern, rule and decision shown to analysts.
BURST = ("Velocity (card testing)", "velocity-rule: >={at_least} auths/card in {window_s}s", "REVIEW")
TRAVEL = ("Geo-impossible travel", "geo-rule: implied speed > 1000 km/h", "BLOCK")
RISKY = ("MCC mismatch", "mcc-risk-rule: high-risk MCC vs cardholder history", "REVIEW")
_CARD = ["card_token", "event_timestamp_ms"]


def burst(events: DataFrame, window_s: int = 120, at_least: int = 5, block_ms: int = HOUR_MS) -> DataFrame:
    n = trailing_totals(events, *_CARD, {"n": F.lit(1)}, {"burst": (window_s * 1000, 0)}, block_ms)
    return events.join(n.where(F.col("n_burst") >= at_least), _CARD)


def impossible_travel(events: DataFrame, above_kmh: float = 1000.0, block_ms: int = HOUR_MS) -> DataFrame:
    """Distance over the time since the card's last earlier event."""
    past = totals_before(events, *_CARD, {"n": F.lit(1)}, block_ms).where(F.col("prev_ms").isNotNull())
    hours = (F.col("event_timestamp_ms") - F.col("prev_ms")) / 3_600_000.0
    return events.join(past, _CARD).withColumn("kmh", F.col("geo_distance_km") / hours).where(F.col("kmh") > above_kmh)


def new_risky_merchant(events: DataFrame, risky: tuple[str, ...] = ("7995",)) -> DataFrame:
    """First charge at a high-risk category on a card that already has a past.

    Two minima per card decide it, so a busy card folds before the shuffle.
    """
    when = F.struct("event_timestamp_ms", "event_id")
    per = events.groupBy("card_token").agg(
        F.min(when).alias("first"), F.min(F.when(F.col("mcc").isin(*risky), when)).alias("hit"))
    return per.where(F.col("hit").isNotNull() & (F.col("hit") > F.col("first"))).select(
        "card_token", F.col("hit.event_id").alias("event_id"), F.col("hit.event_timestamp_ms").alias("event_timestamp_ms"))


def fired(events: DataFrame, burst_window_s: int = 120, block_ms: int = HOUR_MS) -> DataFrame:
    """(event_id, pattern, rule, rule_decision, signals) for every rule that fires."""
    def rows(df, rule, signals):
        return df.select("event_id", *[F.lit(v).alias(n) for n, v in zip(("pattern", "rule", "rule_decision"), rule)],
                         signals.alias("signals"))

    told = BURST[0], BURST[1].format(at_least=5, window_s=burst_window_s), BURST[2]
    fast = rows(burst(events, burst_window_s, block_ms=block_ms), told,
                F.concat(F.col("n_burst").cast("string"), F.lit(" authorisations on the card within the window")))
    far = rows(impossible_travel(events, block_ms=block_ms), TRAVEL,
               F.concat(F.lit("implied speed "), F.replace(F.format_number("kmh", 0), F.lit(","), F.lit("")), F.lit(" km/h")))
    odd = rows(new_risky_merchant(events), RISKY, F.lit("first charge at MCC 7995 on this card"))
    return fast.unionByName(far).unionByName(odd)


def rule_vs_model(hits: DataFrame, scored: DataFrame) -> DataFrame:
    model = scored.select("event_id", F.col("fraud_score").alias("model_score"), F.col("decision").alias("model_decision"))
    text = F.concat(F.lit("["), "pattern", F.lit("] Rule '"), "rule", F.lit("' fired -> "), "rule_decision",
                    F.lit(". Red flags: "), "signals", F.lit(". The model scored this "), "model_decision",
                    F.lit(" ("), F.format_number("model_score", 3), F.lit(")."))
    return hits.join(model, "event_id").withColumn("narrative", text).drop("signals")


def amount_zscore(events: DataFrame, block_ms: int = HOUR_MS) -> DataFrame:
    """Amount against the customer's own earlier amounts (two or more, not all equal).

    Sums are decimals (amounts to a millionth), so the variance of large, close amounts loses no digits.
    """
    a, exact = F.col("amount"), F.col("amount").cast("decimal(20,6)")
    past = totals_before(events, "customer_id", "event_timestamp_ms", {"n": F.lit(1), "s": exact, "q": exact * exact}, block_ms)
    n, s, q = (F.col(f"before_{c}") for c in "nsq")
    var = (n * q - s * s).cast("double") / (n * (n - 1))
    known = past.where(n >= 2).withColumns({"mean": s.cast("double") / n, "sd": F.sqrt(F.greatest(var, F.lit(0.0)))}).where(F.col("sd") > 1e-6)
    return events.join(known, ["customer_id", "event_timestamp_ms"]).select("event_id", ((a - F.col("mean")) / F.col("sd")).alias("z"))


def merchant_chargebacks(events: DataFrame, label: str, window_ms: int = 7 * 86_400_000, block_ms: int = HOUR_MS) -> DataFrame:
    """Share of a merchant's events in the preceding window that were charged back."""
    key = ["merchant_id_hash", "event_timestamp_ms"]
    past = trailing_totals(events, *key, {"n": F.lit(1), "cb": F.col(label)}, {"w": (window_ms, 1)}, block_ms)
    known = past.where(F.col("n_w") > 0).withColumn("chargeback_rate", F.col("cb_w") / F.col("n_w"))
    return events.join(known, key).select("event_id", "chargeback_rate")


def guarded_label_join(events: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on natural keys. ``matches`` is 0 where nothing matched; an ambiguous key (above 1) gets no label."""
    per = labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("matches"), F.min("label").alias("label"), F.min("ProductCD").alias("ProductCD"))
    one = F.col("matches") == 1
    return events.join(per, keys, "left").select("event_id", F.when(one, F.col("label")).alias("label"), F.when(one, F.col("ProductCD")).alias("ProductCD"),
                                                 F.coalesce("matches", F.lit(0)).alias("matches"))
