"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txnguard.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Widen integers, and round doubles to the places compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def rounded(sql: str, doubles: list[str], digits: int) -> str:
    """The checking SQL with its double columns rounded like the query's."""
    cols = ", ".join(f'round("{c}"::DOUBLE, {digits}) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({cols}) FROM (\n{sql}\n)" if doubles else sql


def query(name: str, sql: str | None = None, doubles: str | list[str] = "", digits: int = 6):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its check if SQL can state one.

    ``doubles`` names the columns whose SQL value must be rounded before comparing.
    """
    names = doubles.split() if isinstance(doubles, str) else list(doubles)

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(prepare(spark), sf_dir), digits)

        run.__doc__, run.__name__ = fn.__doc__, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = rounded(sql, names, digits)
        return fn
    return register
