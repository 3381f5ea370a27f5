"""Model evaluation: ranking quality, thresholds, policies, segments, drift and gates.

Everything that depends on the order of scores works on distinct scores with
exact running totals, so neither a single sort nor equal scores limit it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.operators.prefix import exact_quantiles, running_totals


def ladder(df: DataFrame, score: str = "score", label: str = "label", keys: list[str] = ()) -> DataFrame:
    """Distinct scores from high to low with cumulative and total positives and negatives."""
    keys = list(keys)
    counts = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    run = running_totals(counts, keys, [F.col("score").desc()], ["pos", "neg"])
    return run.withColumnsRenamed({"total_pos": "P", "total_neg": "N"})


def ranking(df: DataFrame, score: str = "score", label: str = "label", keys: list[str] = ()) -> DataFrame:
    """ROC-AUC (ties averaged) and average precision; NULL when a class is absent."""
    steps = ladder(df, score, label, keys)
    both = (F.max("P") > 0) & (F.max("N") > 0)
    below = F.col("N") - F.col("cum_neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    gain = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return steps.groupBy(*keys).agg(
        F.when(both, wins / (F.max("P").cast("double") * F.max("N"))).alias("roc_auc"),
        F.when(both, gain / F.max("P")).alias("pr_auc"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _counts(predicted: Column, label: str) -> list[Column]:
    y = F.col(label) == 1
    return [F.count_if(predicted & y).alias("tp"), F.count_if(predicted & ~y).alias("fp"),
            F.count_if(~predicted & ~y).alias("tn"), F.count_if(~predicted & y).alias("fn")]


def with_rates(df: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return df.withColumns({
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "fpr": _ratio(fp, fp + tn), "specificity": 1.0 - _ratio(fp, fp + tn)})


def confusion(df: DataFrame, threshold: float = K.REVIEW_AT, score: str = "score", label: str = "label",
              keys: list[str] = ()) -> DataFrame:
    return with_rates(df.groupBy(*keys).agg(*_counts(F.col(score) >= threshold, label)))


def metrics(df: DataFrame, keys: list[str] = (), threshold: float = K.REVIEW_AT, score: str = "score",
            label: str = "label") -> DataFrame:
    """Ranking and confusion side by side per key."""
    if not keys:
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    out = ranking(df, score, label, keys).join(confusion(df, threshold, score, label, keys), list(keys))
    return out.drop("_all")


# --- thresholds --------------------------------------------------------------------

def quantile_grid(df: DataFrame, score: str = "score", low: float = 0.50, high: float = 0.99999, steps: int = 1500) -> DataFrame:
    """Distinct linear quantiles of the score on an even grid, rounded to 6 places.

    Each distinct score spans an interval of ranks; the grid ranks inside it are
    found by arithmetic, so the work does not multiply scores by grid points.
    """
    counts = df.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    run = running_totals(counts, [], [F.col("score")], ["n"]).withColumnRenamed("total_n", "total")
    gap = (high - low) / (steps - 1)
    last = F.col("total") - 1

    def at(i: Column) -> Column:
        return last * (F.lit(low) + i * F.lit(gap))

    def near(rank: Column) -> Column:
        return (rank / F.greatest(last, F.lit(1)) - F.lit(low)) / F.lit(gap)

    first = F.greatest(F.lit(0), F.floor(near(F.col("cum_n") - F.col("n") - 1)) - 1)
    final = F.least(F.lit(steps - 1), F.ceil(near(F.col("cum_n"))) + 1)
    cand = run.where(first <= final).withColumn("i", F.explode(F.sequence(first.cast("int"), final.cast("int"))))
    start, end = F.col("cum_n") - F.col("n"), F.col("cum_n")
    lo, hi = F.floor(at(F.col("i"))), F.ceil(at(F.col("i")))
    inside = cand.select("i", at(F.col("i")).alias("at"),
                         F.when((lo >= start) & (lo < end), F.col("score")).alias("lo"),
                         F.when((hi >= start) & (hi < end), F.col("score")).alias("hi"))
    per = inside.groupBy("i").agg(F.max("at").alias("at"), F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return per.select(F.round(value, 6).alias("threshold")).distinct()


def sweep(df: DataFrame, thresholds: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion and rates at every threshold. Thresholds join the score order as
    empty steps, so each reads its totals off the running sums."""
    steps = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).withColumn("mark", F.lit(0))
    marks = thresholds.select(F.col("threshold").alias("score"), F.lit(0).cast("long").alias("pos"),
                              F.lit(0).cast("long").alias("neg"), F.lit(1).alias("mark"))
    merged = steps.unionByName(marks).groupBy("score").agg(*[F.sum(c).alias(c) for c in ("pos", "neg")], F.max("mark").alias("mark"))
    run = running_totals(merged, [], [F.col("score").desc()], ["pos", "neg"])
    at = run.withColumnsRenamed({"total_pos": "P", "total_neg": "N"}).where(F.col("mark") == 1)
    return with_rates(at.select(
        F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        (F.col("N") - F.col("cum_neg")).alias("tn"), (F.col("P") - F.col("cum_pos")).alias("fn")))


def operating_points(swept: DataFrame, max_fpr: float = 0.02) -> DataFrame:
    """Lowest threshold within the FPR limit, and the threshold of the best F1 (lowest on ties)."""
    best = F.min(F.struct((-F.round("f1", 4)).alias("o"), "threshold"))
    return swept.agg(F.min(F.when(F.round("fpr", 4) <= max_fpr, F.col("threshold"))).alias("threshold_at_fpr"),
                     best["threshold"].alias("threshold_best_f1"), (-best["o"]).alias("best_f1"))


# --- policies -----------------------------------------------------------------------

POLICIES = [("production", K.REVIEW_AT, K.BLOCK_AT), ("demo", K.DEMO_REVIEW_AT, K.DEMO_BLOCK_AT)]


def business(df: DataFrame, policies=POLICIES, score: str = "score", label: str = "label", amount: str = "amount",
             keys: list[str] = ()) -> DataFrame:
    """What each (review, block) policy catches, misses and costs."""
    rules = F.array(*[F.struct(F.lit(n).alias("policy"), F.lit(r).alias("r"), F.lit(b).alias("b")) for n, r, b in policies])
    rows = df.select(*keys, F.col(score).alias("s"), (F.col(label) == 1).alias("bad"), F.col(amount).alias("a"), F.explode(rules).alias("p"))
    flagged, blocked, bad = F.col("s") >= F.col("p.r"), F.col("s") >= F.col("p.b"), F.col("bad")

    def money(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("a")).otherwise(0.0))

    per = rows.groupBy(*keys, F.col("p.policy").alias("policy")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("frauds"), F.count_if(flagged & bad).alias("frauds_caught"),
        money(bad).alias("fraud_amount"), money(flagged & bad).alias("fraud_amount_caught"), money(~flagged & bad).alias("fraud_amount_missed"),
        F.count_if(flagged & ~bad).alias("good_flagged"), F.count_if(blocked & ~bad).alias("good_blocked"))
    good = F.greatest(F.col("n") - F.col("frauds"), F.lit(1))
    flags = F.col("frauds_caught") + F.col("good_flagged")
    return per.withColumns({
        "recall": F.col("frauds_caught") / F.greatest("frauds", F.lit(1)), "fpr": F.col("good_flagged") / good,
        "good_blocked_rate": F.col("good_blocked") / good, "precision": F.col("frauds_caught") / F.greatest(flags, F.lit(1)),
        "alerts_per_1000": 1000.0 * flags / F.greatest("n", F.lit(1))}).drop("n", "good_blocked")


def at_alert_budget(df: DataFrame, fpr: float, score: str = "score", label: str = "label", amount: str = "amount") -> DataFrame:
    """Recall and money caught when a given share of good customers may be flagged."""
    limit = exact_quantiles(df.where(F.col(label) == 0).select(score), score, [1 - fpr]).select("q0").scalar()
    caught = (F.col(score) >= F.col("threshold")) & (F.col(label) == 1)
    return df.withColumn("threshold", limit).agg(
        F.max("threshold").alias("threshold"), (F.count_if(caught) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).alias("recall"),
        F.sum(F.when(caught, F.col(amount)).otherwise(0.0)).alias("fraud_amount_caught"))


# --- segments and time ------------------------------------------------------------------

def with_segments(df: DataFrame, product: str = "ProductCD", hour: str = "hour", card: str = "card6",
                  domain: str = "P_emaildomain", amount: str = "amount") -> DataFrame:
    """One row per (row, segmentation): segment and value."""
    a, h = F.col(amount), F.col(hour)
    top = df.groupBy(F.col(domain).alias("_d")).count().orderBy(F.desc("count"), "_d").limit(5).select(
        F.col("_d").alias(domain), F.lit(1).alias("_top"))  # five rows
    band = F.when(a < 50, "under $50").when(a < 200, "$50-200").when(a < 445, "$200-445").otherwise("$445 and over")
    d = df.join(F.broadcast(top), domain, "left")
    values = {
        "Product": F.col(product), "Amount": band,
        "Time of day": F.when((h < 6) | (h >= 22), "night (22-06)").otherwise("day (06-22)"),
        "Card type": F.when(F.col(card).isin("debit", "credit"), F.col(card)).otherwise("other/missing"),
        "Email domain": F.when(F.col("_top") == 1, F.col(domain)).otherwise("other"),
    }
    cells = F.array(*[F.struct(F.lit(n).alias("segment"), v.alias("value")) for n, v in values.items()])
    return d.withColumn("_s", F.explode(cells)).select("*", "_s.segment", "_s.value").drop("_s", "_top")


def segment_table(df: DataFrame, scores: dict[str, str], label: str = "label", threshold: float = K.REVIEW_AT) -> DataFrame:
    """Per segment value and model: size, fraud rate, AUC, recall and FPR."""
    cells = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("score")) for n, c in scores.items()])
    rows = with_segments(df).select("segment", "value", F.col(label).alias("label"), F.explode(cells).alias("_m")).select(
        "segment", "value", "label", "_m.*")
    keys = ["segment", "value", "model"]
    out = metrics(rows, keys, threshold)
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return out.select(*keys, n.alias("transactions"), ((F.col("tp") + F.col("fn")) / n).alias("fraud_rate"), "roc_auc", "recall", "fpr")


def over_time(df: DataFrame, day: str = "day", bins: int = 6, label: str = "label", score: str = "score",
              flag_at: float = K.REVIEW_AT) -> DataFrame:
    """Equal-width, right-closed day bins with size, fraud rate, AUC, mean score and flagged rate."""
    lo, hi = df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()
    at = df.withColumns({"_lo": lo, "_hi": hi})
    place = F.ceil((F.col(day) - F.col("_lo")) * F.lit(bins) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0)))
    rows = at.withColumn("bin", F.greatest(F.coalesce(place, F.lit(1)), F.lit(1))).select("bin", day, F.col(label).alias("label"), F.col(score).alias("score"))
    size = rows.groupBy("bin").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n"), F.avg("label").alias("fraud_rate"),
        F.avg("score").alias("mean_score"), F.avg((F.col("score") >= flag_at).cast("int")).alias("flagged_rate"))
    return size.join(ranking(rows, keys=["bin"]).select("bin", "roc_auc"), "bin")


# --- parity and replicas ----------------------------------------------------------------

def parity(offline: DataFrame, live: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Per feature: percent of rows with close values, and percent missing on each side."""
    a = offline.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_a"))
    b = live.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_b"))
    names = F.array(*[F.lit(f) for f in features])
    rows = a.join(b, key).select(F.explode(F.arrays_zip(names.alias("feature"), F.col("_a"), F.col("_b"))).alias("z"))
    off, on = F.col("z._a"), F.col("z._b")
    close = F.abs(off - on) <= 1e-4 + 1e-5 * F.abs(on)

    def pct(c: Column) -> Column:
        return 100.0 * F.avg(c.cast("int"))

    return rows.groupBy(F.col("z.feature").alias("feature")).agg(
        pct(close).alias("same_pct"), pct(on == K.SENTINEL).alias("live_missing_pct"), pct(off == K.SENTINEL).alias("training_missing_pct"))


def parity_summary(table: DataFrame) -> DataFrame:
    return table.agg(F.count_if(F.col("same_pct") >= 99).alias("matching"), F.count_if(F.col("same_pct") < 1).alias("never_matching"),
                     F.count(F.lit(1)).alias("features"))


def replica_check(recorded: DataFrame, replica: DataFrame, key: str = "event_id") -> DataFrame:
    """Recorded against recomputed scores and completeness."""
    r = replica.select(key, F.col("fraud_score").alias("_s"), F.col("feature_completeness").alias("_c"))
    diff = F.abs(F.col("fraud_score") - F.col("_s"))
    return recorded.join(r, key).agg(
        F.count(F.lit(1)).alias("events"), F.max(diff).alias("max_abs_diff"), F.avg(diff).alias("mean_abs_diff"),
        F.avg((diff <= 1e-6).cast("int")).alias("share_within"),
        F.avg((F.abs(F.col("feature_completeness") - F.col("_c")) <= 1e-4 + 1e-5 * F.abs("feature_completeness")).cast("int")).alias("share_same_completeness"))


# --- column profiles and drift ---------------------------------------------------------------

def missing_summary(df: DataFrame, columns: list[str], above: float = 0.5) -> DataFrame:
    one = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "missing").withColumn("mostly_missing", F.col("missing") > above)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, missing, distinct, extremes, moments, quartiles and mode of numeric columns, in one long pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.column", "c.value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    v, n = F.col("value"), F.when(known, F.col("n")).otherwise(0)
    total, s = F.sum(n), F.sum(v * n)
    base = counts.groupBy("column").agg(
        total.alias("count"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("missing"), F.count_if(known).alias("distinct"),
        F.min("value").alias("min"), F.max("value").alias("max"), (s / total).alias("mean"),
        F.min(F.when(known, F.struct((-F.col("n")).alias("o"), "value")))["value"].alias("most_common"))
    sized = running_totals(counts.where(known), ["column"], [F.col("value")], ["n"]).withColumnRenamed("total_n", "t")
    aggs = []
    for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)):
        at = (F.col("t") - 1) * F.lit(p)
        for tag, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((rank >= F.col("cum_n") - F.col("n")) & (rank < F.col("cum_n")), F.col("value"))).alias(f"{name}_{tag}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"{name}_w"))
    quart = sized.groupBy("column").agg(*aggs)
    quart = quart.select("column", *[(F.col(f"{m}_lo") + (F.col(f"{m}_hi") - F.col(f"{m}_lo")) * F.col(f"{m}_w")).alias(m) for m in ("q25", "median", "q75")])
    return base.join(F.broadcast(_deviations(df, columns, F.stddev_samp, "std")), "column").join(quart, "column", "left")


def _deviations(df: DataFrame, columns: list[str], how: Callable[[Column], Column], name: str) -> DataFrame:
    """(column, deviation): centred moments merged by Spark, one row per column."""
    wide = df.agg(*[how(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", name)


def drift(reference: DataFrame, current: DataFrame, columns: list[str], ks_above: float = 0.1, distance_above: float = 0.1,
          psi_above: float = 0.2) -> DataFrame:
    """Kolmogorov-Smirnov distance, Wasserstein distance over the reference's deviation, and
    PSI on reference deciles per column, from one merged value order. The thresholds are ours."""
    def long(df: DataFrame, ref: int) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        return df.select(F.explode(cells).alias("c")).select("c.column", "c.value", F.lit(ref).alias("ref")).where(F.col("value").isNotNull())

    counts = long(reference, 1).unionByName(long(current, 0)).groupBy("column", "value").agg(
        F.count_if(F.col("ref") == 1).alias("r"), F.count_if(F.col("ref") == 0).alias("c"))
    run = running_totals(counts, ["column"], [F.col("value")], ["r", "c"], previous=["value"])
    d = run.withColumnsRenamed({"total_r": "refs", "total_c": "curs"})
    gap = F.abs(F.col("cum_r") / F.col("refs") - F.col("cum_c") / F.col("curs"))
    before = F.abs((F.col("cum_r") - F.col("r")) / F.col("refs") - (F.col("cum_c") - F.col("c")) / F.col("curs"))
    step = F.coalesce(F.col("value") - F.col("prev_value"), F.lit(0.0))
    shape = d.groupBy("column").agg(F.max(gap).alias("ks"), F.sum(before * step).alias("moved")) \
        .join(F.broadcast(_deviations(reference, columns, F.stddev_pop, "sd")), "column", "left") \
        .select("column", "ks", (F.col("moved") / F.greatest("sd", F.lit(1e-3))).alias("wasserstein"))
    decile = F.least(F.floor(10 * (F.col("cum_r") - F.col("r")) / F.col("refs")), F.lit(9))
    share = d.groupBy("column", decile.alias("b")).agg((F.sum("r") / F.max("refs")).alias("p"), (F.sum("c") / F.max("curs")).alias("q"))
    p, q = F.greatest("p", F.lit(1e-4)), F.greatest("q", F.lit(1e-4))
    psi = share.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))
    out = shape.join(psi, "column")
    return out.withColumn("drifted", (F.col("ks") > ks_above) | (F.col("wasserstein") > distance_above) | (F.col("psi") > psi_above))


def drift_share(table: DataFrame) -> DataFrame:
    return table.agg(F.count_if("drifted").alias("drifted"), F.count(F.lit(1)).alias("columns"),
                     F.avg(F.col("drifted").cast("int")).alias("share"))


# --- models --------------------------------------------------------------------------------------

def class_balance(df: DataFrame, label: str = "label", keys: list[str] = ()) -> DataFrame:
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), pos.alias("positives"), (neg / F.nullif(pos, F.lit(0))).alias("neg_per_pos"),
                                 (pos / F.count(F.lit(1))).alias("fraud_rate"))


def champion(table: DataFrame) -> DataFrame:
    """Pointer row: the model with the greatest ROC-AUC (name breaks ties)."""
    best = F.min(F.struct((-F.col("roc_auc")).alias("o"), "model"))
    return table.agg(best["model"].alias("champion"), (-best["o"]).alias("roc_auc"))


def metrics_table(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Replace rows by model name and mark the champion."""
    rows = fresh if current is None else current.drop("is_champion").join(fresh.select("model"), "model", "left_anti").unionByName(fresh)
    return rows.withColumn("is_champion", F.col("model") == champion(rows).select("champion").scalar())


def gates(table: DataFrame, key: str = "model") -> DataFrame:
    """PASS or FAIL per release gate, and for all of them together."""
    tests = [(f"{n} {op} {v}", (F.col(n) >= v) if op == ">=" else (F.col(n) <= v)) for n, op, v in K.QUALITY_GATES]
    cells = F.array(*[F.struct(F.lit(n).alias("gate"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in tests])
    rows = table.select(key, F.explode(cells).alias("g")).select(key, "g.*")
    whole = rows.groupBy(key).agg(F.bool_and("passed").alias("passed")).select(key, F.lit("ALL").alias("gate"), "passed")
    return rows.unionByName(whole).withColumn("result", F.when(F.col("passed"), "PASS").otherwise("FAIL")).drop("passed")


def time_split(df: DataFrame, time: str, cuts: tuple[float, float] = (0.72, 0.80)) -> DataFrame:
    """train / val / test by time quantiles."""
    q = exact_quantiles(df.select(time), time, list(cuts))
    t = F.col(time)
    return df.withColumns({"_q0": q.select("q0").scalar(), "_q1": q.select("q1").scalar()}).withColumn(
        "split", F.when(t <= F.col("_q0"), "train").when(t <= F.col("_q1"), "val").otherwise("test")).drop("_q0", "_q1")
