"""Feature engineering: training features, live features, and the corrected live features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnguard import constants as K
from txnguard.durable import materialize
from txnguard.functions import scalars as X
from txnguard.operators.joins import lookup_join, null_key
from txnguard.operators.prefix import exact_quantiles

SMALL = 100  # values a column may have to be encoded by a literal dictionary

FIXES = ("card1", "dist1", "email", "p_missing", "addr2", "high_amount", "freq_tables", "cents", "never_seen")


@dataclass
class Fitted:
    """Constants learned from raw rows. The tables fold one stored table of counts, the rest are single numbers."""

    frequencies: DataFrame      # column, key, value, n, freq
    modes: DataFrame            # ProductCD, column, key, value
    high_amount: float
    rarest: dict[str, float]
    rows: int                   # rows of `frequencies`
    small: dict[str, dict[str, float]]  # the columns with few values, as dictionaries

    def lookup(self) -> DataFrame:
        """All columns' values under one text key, so every join can share one broadcast."""
        return self.frequencies.select(F.concat("column", F.lit("="), "key").alias("_key"), F.col("freq").alias("_freq"))


def _long(raw: DataFrame, columns: list[str], carry: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), null_key(c).alias("key"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return raw.select(*carry, F.explode(cells).alias("_c")).select(*carry, "_c.*")


def category_counts(raw: DataFrame, mode_where: Column | None = None) -> DataFrame:
    """Rows per (product, column, value) in one pass, and how many of them count for the modes."""
    chosen = F.lit(True) if mode_where is None else mode_where
    cells = _long(raw.withColumns({"_product": F.col("ProductCD"), "_chosen": chosen}), K.RAW_CATEGORIES, ["_product", "_chosen"])
    return cells.groupBy(F.col("_product").alias("ProductCD"), "column", "key", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_chosen").alias("m"))


def frequency_table(counts: DataFrame) -> DataFrame:
    """Share of every value of every column; missing is a value."""
    total = counts.where(F.col("column") == "ProductCD").agg(F.sum("n")).scalar()
    per = counts.groupBy("column", "key", "value").agg(F.sum("n").alias("n"))
    return per.withColumn("freq", (F.col("n") / total).cast("float"))


def product_modes(counts: DataFrame, columns: list[str] = K.MODE_COLUMNS) -> DataFrame:
    """Most frequent value per product; ties go to the smaller key (missing first)."""
    rows = counts.where(F.col("column").isin(columns) & (F.col("m") > 0))
    top = rows.groupBy("ProductCD", "column").agg(F.min(F.struct((-F.col("m")).alias("o"), "key", "value")).alias("_t"))
    return top.select("ProductCD", "column", "_t.key", "_t.value")


def fit(raw: DataFrame, mode_where: Column | None = None) -> Fitted:
    """Fit on ``raw``; the product modes on its rows meeting ``mode_where`` (the training rows only)."""
    counts = materialize(category_counts(raw, mode_where), "category-counts")
    freq, modes = frequency_table(counts), product_modes(counts)
    q = exact_quantiles(raw.select(F.col("TransactionAmt").cast("float").cast("double").alias("a")), "a", [0.95])
    return _fitted(freq, modes, float(q.first()["q0"]))


def _fitted(freq: DataFrame, modes: DataFrame, high_amount: float) -> Fitted:
    # One row per column comes to the driver, and the values of columns with at most SMALL of them.
    stats = freq.groupBy("column").agg(F.min("freq").alias("f"), F.count(F.lit(1)).alias("n")).collect()
    few = [r["column"] for r in stats if r["n"] <= SMALL]
    small: dict[str, dict[str, float]] = {c: {} for c in few}
    for r in freq.where(F.col("column").isin(few)).select("column", "key", "freq").collect():
        small[r["column"]][r["key"]] = float(r["freq"])
    return Fitted(freq, modes, high_amount, {r["column"]: float(r["f"]) for r in stats},
                  sum(r["n"] for r in stats), small)


def constants_table(fitted: Fitted) -> DataFrame:
    """All fitted constants as (kind, column, product, value, number) rows, ready to store."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    freq = fitted.frequencies.select(F.lit("frequency").alias("kind"), "column", text.alias("product"), "value",
                                     F.col("freq").cast("double").alias("number"))
    mode = fitted.modes.select(F.lit("mode").alias("kind"), "column", F.col("ProductCD").alias("product"), "value",
                               number.alias("number"))
    high = fitted.modes.sparkSession.createDataFrame(
        [("high_amount_q95", "TransactionAmt", None, None, fitted.high_amount)],
        "kind string, column string, product string, value string, number double")
    return freq.unionByName(mode).unionByName(high)


def save_constants(fitted: Fitted, root: str, version: int) -> None:
    """Store the constants as one version; a retry replaces it."""
    constants_table(fitted).write.mode("overwrite").parquet(f"{root.rstrip('/')}/version={version}")


def load_constants(spark: SparkSession, root: str, version: int | None = None) -> Fitted:
    """Constants as they were stored, by default the newest version. Features from them equal those from the fit."""
    stored = spark.read.option("basePath", root).parquet(root)
    version = stored.agg(F.max("version")).first()[0] if version is None else version
    rows = stored.where(F.col("version") == version)
    keyed = rows.withColumn("key", null_key("value"))
    freq = keyed.where("kind = 'frequency'").select("column", "key", "value", F.col("number").cast("float").alias("freq"))
    modes = keyed.where("kind = 'mode'").select(F.col("product").alias("ProductCD"), "column", "key", "value")
    high = rows.where("kind = 'high_amount_q95'").select("number").collect()  # one row
    if len(high) != 1:
        raise ValueError(f"version {version} of {root} holds no complete set of constants")
    return _fitted(freq, modes, float(high[0][0]))


def encode_frequency(df: DataFrame, fitted: Fitted, column: str, source: Column | None = None,
                     unseen: float | None = None) -> DataFrame:
    """Add ``<column>_freq``; values never fitted are NULL, or ``unseen``.

    A column of few values is a dictionary inside the projection; any other is
    looked up in the stored table by a join.
    """
    value = F.col(column) if source is None else source
    if column in fitted.small:
        text = value.cast("string")
        key = F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), text))
        return df.withColumn(f"{column}_freq", X.lookup(key, fitted.small[column], unseen).cast("float"))
    keyed = df.withColumn("_value", value).withColumn("_key", F.concat(F.lit(f"{column}="), null_key("_value")))
    out = lookup_join(keyed, fitted.lookup(), ["_key"], "left", rows=fitted.rows)
    freq = F.col("_freq") if unseen is None else F.coalesce("_freq", F.lit(unseen).cast("float"))
    return out.withColumn(f"{column}_freq", freq.cast("float")).drop("_value", "_key", "_freq")


def missing_fractions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing) in one pass."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "missing")


def too_sparse(df: DataFrame, columns: list[str], above: float = K.MISSING_DROP_ABOVE) -> list[str]:
    return [r["column"] for r in missing_fractions(df, columns).where(F.col("missing") > above).collect()]


def training_features(raw: DataFrame, fitted: Fitted, keep: list[str] = ("TransactionID", "isFraud"),
                      drop_above: float | None = K.MISSING_DROP_ABOVE,
                      epoch_ms: int = K.EPOCH_2017_12_01_MS) -> DataFrame:
    """Model-ready rows: ``keep`` plus float32 features in model order, sentinel for missing."""
    d = raw.withColumns(X.training_time("TransactionDT", epoch_ms))
    d = d.withColumns(X.training_amount("TransactionAmt", F.lit(fitted.high_amount)))
    d = d.withColumns(X.email_flags("P_emaildomain", "R_emaildomain"))
    for c in K.RAW_CATEGORIES:
        d = encode_frequency(d, fitted, c)
    gone = set(too_sparse(raw, K.RAW_NUMERIC, drop_above)) if drop_above is not None else set()
    wanted = [c for c in K.FEATURES if c not in gone] + [
        c for c in K.RAW_NUMERIC if c not in K.FEATURES and c not in gone]
    return d.select(*keep, *[F.coalesce(F.col(c).cast("float"), F.lit(K.SENTINEL).cast("float")).alias(c) for c in wanted])


# --- live features ---------------------------------------------------------------

def _assemble(df: DataFrame, real: dict[str, Column], keep: list[str]) -> DataFrame:
    """The 43 float32 columns in model order and the share that is not missing."""
    have = [f for f in K.FEATURES if f in real]
    wide = df.select(*keep, *[real[f].cast("double").alias(f) for f in have])
    known = " + ".join(f"int({f} <> {K.SENTINEL}D)" for f in have)
    columns = [f"float({f}) AS {f}" if f in real else f"float({K.SENTINEL}) AS {f}" for f in K.FEATURES]
    return wide.selectExpr(*keep, *columns, f"round(({known}) / {len(K.FEATURES)}D, 4) AS feature_completeness")


def live_values(high_amount: float = K.HIGH_AMOUNT) -> dict[str, Column]:
    """Features an event carries by itself; the rest of the 43 are missing."""
    domain = X.feature_domain("merchant_name")
    country = F.coalesce(F.when(F.col("merchant_country") != "", F.col("merchant_country")), F.lit("00"))
    return {
        "TransactionAmt": F.coalesce("amount", F.lit(0.0)),
        "addr2": X.safe_int(country),
        **X.live_time("event_timestamp_ms"),
        **X.live_amount("amount", high_amount),
        "ProductCD_freq": X.product_frequency(X.product_of("mcc")),
        "P_emaildomain_freq": X.domain_frequency(domain),
        "p_email_missing": domain.isin(K.MISSING_DOMAINS).cast("double"),
        "r_email_missing": F.lit(1.0),
        "email_mismatch": F.lit(0.0),
    }


def live_features(events: DataFrame, keep: list[str] = ("event_id",), high_amount: float = K.HIGH_AMOUNT) -> DataFrame:
    return _assemble(events, live_values(high_amount), list(keep))


def corrected_features(events: DataFrame, fitted: Fitted | None = None, fixes: tuple[str, ...] = (),
                       richer: bool = False, keep: list[str] = ("event_id",)) -> DataFrame:
    """Live features with independent corrections.

    ``fixes`` names corrections from FIXES; none gives exactly the live
    features. ``richer`` means the events also carry raw_* columns (recipient
    domain, distance, card and address codes, card type, match flags).
    """
    unknown = set(fixes) - set(FIXES)
    if unknown:
        raise ValueError(f"unknown fixes: {sorted(unknown)}")
    if (fixes or richer) and fitted is None:
        raise ValueError("corrections need fitted constants")
    on = set(fixes)
    real = live_values()
    d = events.withColumns({"_product": X.product_of("mcc"), "_domain": X.feature_domain("merchant_name")})
    d = d.withColumn("_purchaser", F.when(~F.col("_domain").isin("nan", "missing"), F.col("_domain")))
    amount = F.coalesce("amount", F.lit(0.0))

    if "cents" in on:
        cents = X.training_cents(amount).cast("double")
        real |= {"log_amount": F.log1p(amount.cast("float")).cast("float"), "amount_cents": cents,
                 "is_round_dollar": (cents == 0).cast("double")}
    if "high_amount" in on:
        real["is_high_amount"] = (amount.cast("float") > F.lit(fitted.high_amount).cast("float")).cast("double")
    if "p_missing" in on:
        real["p_email_missing"] = F.col("_purchaser").isNull().cast("double")
    if "freq_tables" in on:
        for column, source in (("ProductCD", "_product"), ("P_emaildomain", "_purchaser")):
            d = encode_frequency(d, fitted, column, F.col(source), fitted.rarest[column])
            real[f"{column}_freq"] = F.col(f"{column}_freq")

    flags = ["card4", "card6"] + [f"M{i}" for i in range(1, 10)]
    if ("email" in on or "never_seen" in on) and not richer:
        typical = fitted.modes.groupBy(F.col("ProductCD").alias("_product")).pivot("column", K.MODE_COLUMNS).agg(F.first("value"))
        typical = typical.select("_product", *[F.col(c).alias(f"raw_{c}") for c in K.MODE_COLUMNS])
        d = d.drop(*[f"raw_{c}" for c in K.MODE_COLUMNS]).join(F.broadcast(typical), "_product", "left")  # one row per product
    if richer or "email" in on:
        d = encode_frequency(d, fitted, "R_emaildomain", F.col("raw_R_emaildomain"), fitted.rarest["R_emaildomain"])
        p, r = (F.coalesce(c, F.lit("missing")) for c in ("_purchaser", "raw_R_emaildomain"))
        real |= {"email_mismatch": (p != r).cast("double"), "r_email_missing": (r == "missing").cast("double"),
                 "R_emaildomain_freq": F.col("R_emaildomain_freq")}
    if richer or "never_seen" in on:
        for c in flags:
            d = encode_frequency(d, fitted, c, F.col(f"raw_{c}"), fitted.rarest[c])
            real[f"{c}_freq"] = F.col(f"{c}_freq")

    sentinel = F.lit(K.SENTINEL)
    if "addr2" in on:
        real["addr2"] = F.when(F.col("merchant_country") == "00", sentinel).otherwise(real["addr2"])
    if "card1" in on:
        real["card1"] = F.coalesce(F.col("customer_id").try_cast("double"), sentinel)
    if richer:
        for c in ["dist1", "card2", "card3", "card5", "addr1"]:
            real[c] = F.coalesce(F.col(f"raw_{c}").cast("double"), sentinel)
    elif "dist1" in on:
        geo = F.coalesce("geo_distance_km", F.lit(0.0))
        real["dist1"] = F.when(geo != 0, geo).otherwise(sentinel)
    return _assemble(d, real, list(keep))
