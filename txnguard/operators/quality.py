"""Data-quality expectations over feature and label tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K


def _rows(one: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(f"_{i}").alias("passed"))
                      for i, (check, column) in enumerate(names)])
    return one.select(F.explode(cells).alias("c")).select("c.*")


def feature_checks(df: DataFrame, expected_rows: int | Column, features: list[str] = K.FEATURES) -> DataFrame:
    """Schema, row count, not-null, range and flag checks from one pass."""
    have = [c for c in df.columns]
    present = [c for c in features if c in have]
    tests: list[tuple[str, str, Column]] = [
        ("column count", "-", F.lit(len(have) == len(features))),
        ("column set", "-", F.lit(set(have) == set(features))),
        ("row count", "-", F.count(F.lit(1)) == expected_rows)]
    tests += [("not null", c, F.count_if(F.col(c).isNull()) == 0 if c in present else F.lit(False)) for c in features]

    def within(c: str, lo: float, hi: float) -> Column:
        return F.count_if(~F.col(c).between(lo, hi)) == 0 if c in present else F.lit(False)

    tests.append(("between", "TransactionAmt", within("TransactionAmt", *K.AMOUNT_RANGE)))
    tests += [("in set", c, F.count_if(~F.col(c).isin(0.0, 1.0)) == 0 if c in present else F.lit(False)) for c in K.BINARY_FLAGS]
    tests.append(("between", "hour_of_day", within("hour_of_day", *K.HOUR_RANGE)))
    tests.append(("between", "day_of_week", within("day_of_week", *K.WEEKDAY_RANGE)))
    one = df.agg(*[c.alias(f"_{i}") for i, (_, _, c) in enumerate(tests)])
    return _rows(one, [(n, c) for n, c, _ in tests])


def label_checks(df: DataFrame, expected_rate: float | Column, label: str = "isFraud") -> DataFrame:
    rate = F.lit(expected_rate) if not isinstance(expected_rate, Column) else expected_rate
    low = F.greatest(F.lit(0.0), rate - K.CLASS_BALANCE_SLACK)
    c = F.col(label)
    tests = [("in set", F.count_if(~c.isin(0, 1)) == 0), ("not null", F.count_if(c.isNull()) == 0),
             ("mean", F.avg(c).between(low, rate + K.CLASS_BALANCE_SLACK))]
    one = df.agg(*[t.alias(f"_{i}") for i, (_, t) in enumerate(tests)])
    return _rows(one, [(n, label) for n, _ in tests])


def verdict(checks: DataFrame) -> DataFrame:
    """Passed, total, and PASS only when nothing failed."""
    ok = F.coalesce("passed", F.lit(False))
    return checks.agg(F.count_if(ok).alias("passed"), F.count(F.lit(1)).alias("total"),
                      F.when(F.bool_and(ok), "PASS").otherwise("FAIL").alias("result"))


def report_lines(checks: DataFrame) -> DataFrame:
    mark = F.when(F.coalesce("passed", F.lit(False)), "ok").otherwise("X")
    return checks.select(F.format_string("- [%s] %s (column=%s)", mark, F.col("check"), F.col("column")).alias("line"))


def export_checks(df: DataFrame, key: str = "event_id", latency: str = "scoring_latency_ms",
                  completeness: str = "feature_completeness") -> DataFrame:
    """Duplicates, missing cells, latency percentiles and completeness range of an export."""
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    ids = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg((F.sum("n") - F.count(F.lit(1))).alias("d"))
    p = F.percentile(latency, [0.5, 0.95, 0.99])  # whole milliseconds: few distinct values
    out = df.agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing_values"), p.alias("p"), F.max(latency).alias("max_ms"),
                 F.min(completeness).alias("completeness_min"), F.max(completeness).alias("completeness_max"))
    return out.select("rows", ids.scalar().alias("duplicates"), "missing_values", F.col("p")[0].alias("p50_ms"), F.col("p")[1].alias("p95_ms"),
                      F.col("p")[2].alias("p99_ms"), "max_ms", "completeness_min", "completeness_max")
