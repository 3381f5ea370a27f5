"""Column expressions shared by the jobs. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from txnguard import constants as K

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, table: Mapping[str, object], default: object = None) -> Column:
    """Fixed small dictionary as an expression."""
    def text(v: object) -> str:
        if not isinstance(v, str):
            return f"{v!r}D"
        escaped = v.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    pairs = ", ".join(text(x) for kv in table.items() for x in kv)
    found = F.try_element_at(F.expr(f"map({pairs})"), F.coalesce(key, F.lit("")))
    return found if default is None else F.coalesce(found, F.lit(default))


def tokenize(value: Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256(value|salt); NULL becomes ``null``."""
    text = value.cast("string")
    token = F.substring(F.sha2(F.concat_ws("|", text, F.lit(salt)), 256), 1, 16)
    return F.when(text.isNull(), F.lit("null")).otherwise(token)


def decide(score: ColumnLike, review_at: float = K.REVIEW_AT, block_at: float = K.BLOCK_AT) -> Column:
    s = col(score)
    return F.when(s >= block_at, "BLOCK").when(s >= review_at, "REVIEW").otherwise("ALLOW")


def flagged(decision: ColumnLike) -> Column:
    return col(decision).isin("REVIEW", "BLOCK")


def agrees(decision: ColumnLike, verdict: ColumnLike) -> Column:
    return F.coalesce(flagged(decision), F.lit(False)).eqNullSafe(col(verdict) == "FRAUD")


# --- time --------------------------------------------------------------------

def _is_night(hour: Column) -> Column:
    return (hour < 6) | (hour >= 22)


def training_time(offset_s: ColumnLike, epoch_ms: int = K.EPOCH_2017_12_01_MS) -> dict[str, Column]:
    """Hour, weekday (Monday 0), night and weekend from a seconds offset."""
    at = F.timestamp_millis(col(offset_s) * 1000 + F.lit(epoch_ms))
    hour, day = F.hour(at), F.weekday(at)
    return {"hour_of_day": hour, "day_of_week": day,
            "is_night": _is_night(hour).cast("int"), "is_weekend": (day >= 5).cast("int")}


def live_time(ms: ColumnLike) -> dict[str, Column]:
    """The same four features from epoch ms; all missing when the time is not positive."""
    at = F.timestamp_millis(col(ms))
    hour, day = F.hour(at), F.weekday(at)
    known = F.coalesce(col(ms) > 0, F.lit(False))
    values = {"hour_of_day": hour, "day_of_week": day,
              "is_night": _is_night(hour), "is_weekend": day >= 5}
    return {n: F.when(known, v.cast("double")).otherwise(F.lit(K.SENTINEL)) for n, v in values.items()}


# --- amounts -----------------------------------------------------------------

def training_cents(amount: ColumnLike) -> Column:
    """float32 arithmetic, truncated."""
    f32 = col(amount).cast("float")
    return ((f32 * F.lit(100).cast("float")) % F.lit(100).cast("float")).cast("int")


def training_amount(amount: ColumnLike, high_above: Column) -> dict[str, Column]:
    f32 = col(amount).cast("float")
    cents = training_cents(amount)
    return {"log_amount": F.log1p(f32).cast("float"), "amount_cents": cents,
            "is_round_dollar": (cents == 0).cast("int"), "is_high_amount": (f32 > high_above).cast("int")}


def live_amount(amount: ColumnLike, high_above: float = K.HIGH_AMOUNT) -> dict[str, Column]:
    a = F.coalesce(col(amount), F.lit(0.0))
    cents = F.pmod(F.rint(a * 100), F.lit(100.0))
    return {"log_amount": F.log1p(a), "amount_cents": cents,
            "is_round_dollar": (cents == 0).cast("double"), "is_high_amount": (a > high_above).cast("double")}


# --- merchant and e-mail -----------------------------------------------------

def _after_marker(name: Column) -> Column:
    return F.element_at(F.split(name, "-MERCHANT-", 2), 2)


def feature_domain(name: ColumnLike) -> Column:
    """Trimmed, lower-cased text after the marker; ``missing`` when absent or empty."""
    n = col(name)
    domain = F.when(n.contains("-MERCHANT-"), F.lower(F.trim(_after_marker(n))))
    return F.when(domain.isNull() | (domain == ""), F.lit("missing")).otherwise(domain)


def text_domain(name: ColumnLike) -> Column:
    """Trimmed text after the marker; without a marker the name itself."""
    n = F.coalesce(col(name), F.lit(""))
    return F.when(n.contains("-MERCHANT-"), F.trim(_after_marker(n))).otherwise(n)


def email_flags(purchaser: ColumnLike, recipient: ColumnLike) -> dict[str, Column]:
    p, r = (F.coalesce(col(c), F.lit("missing")) for c in (purchaser, recipient))
    return {"email_mismatch": (p != r).cast("int"), "p_email_missing": (p == "missing").cast("int"),
            "r_email_missing": (r == "missing").cast("int")}


def product_of(mcc: ColumnLike) -> Column:
    return lookup(col(mcc), K.MCC_TO_PRODUCT, K.DEFAULT_PRODUCT)


def product_frequency(product: Column) -> Column:
    return lookup(product, K.PRODUCT_FREQUENCY, K.PRODUCT_FREQUENCY_DEFAULT)


def domain_frequency(domain: Column) -> Column:
    return lookup(domain, K.DOMAIN_FREQUENCY, K.DOMAIN_FREQUENCY_DEFAULT)


def safe_int(text: ColumnLike) -> Column:
    """Integer text as a number; anything else is the sentinel. ``00`` is 0."""
    parsed = F.trim(col(text)).try_cast("int").cast("double")
    return F.coalesce(parsed, F.lit(K.SENTINEL))


# --- text ---------------------------------------------------------------------

def word_count(text: ColumnLike) -> Column:
    t = F.trim(F.regexp_replace(F.coalesce(col(text), F.lit("")), r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def general_number(x: Column, digits: int = 4) -> Column:
    """Shortest form with ``digits`` significant figures, as C's %g prints it."""
    sci = F.format_string(f"%.{digits - 1}e", x)
    exponent = F.split(sci, "e")[1].cast("int")
    fixed = F.lit(None).cast("string")
    for e in range(-4, digits):
        fixed = F.coalesce(F.when(exponent == e, F.replace(
            F.format_number(x, digits - 1 - e), F.lit(","), F.lit(""))), fixed)

    def strip(s: Column) -> Column:
        return F.when(s.contains("."), F.regexp_replace(s, r"\.?0+$", "")).otherwise(s)

    return F.when((exponent >= -4) & (exponent < digits), strip(fixed)).otherwise(
        F.concat(strip(F.split(sci, "e")[0]), F.lit("e"), F.split(sci, "e")[1]))


def perplexity(mean_log_prob: Column, cap: float = K.LOG_PPL_CAP, suspicious: float = K.SUSPICIOUS_LOG_PPL,
               slope: float = K.PERPLEXITY_SLOPE) -> dict[str, Column]:
    """Log-perplexity, perplexity, squashed score and label; no evidence scores 0 and NORMAL."""
    lp = F.least(-mean_log_prob, F.lit(cap))
    none = mean_log_prob.isNull()
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(lp - suspicious) * slope))
    return {
        "log_perplexity": F.when(none, 0.0).otherwise(lp),
        "perplexity": F.when(none, 1.0).otherwise(F.exp(lp)),
        "text_anomaly_score": F.when(none, 0.0).otherwise(score),
        "text_anomaly_label": F.when(~none & (lp >= suspicious), "SUSPICIOUS").otherwise("NORMAL"),
    }


def clock_text(ms: ColumnLike, zone: str = "Asia/Kolkata", pattern: str = "HH:mm:ss") -> Column:
    """Wall-clock text in a zone (the session runs in UTC)."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(col(ms)), zone), pattern)
