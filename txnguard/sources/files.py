"""Batch scans and writes with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None,
             file_columns: list[str] | None = None) -> DataFrame:
    """CSV by header. ``file_columns`` is the full header when the file has more columns
    than ``schema``; the others are read as text and pruned from the scan."""
    have = {f.name: f.dataType for f in schema.fields}
    names = file_columns or schema.fieldNames()
    full = T.StructType([T.StructField(n, have.get(n, T.StringType())) for n in names])
    return spark.read.schema(full).option("header", True).csv(path).select(*(columns or schema.fieldNames()))


def without_prefixes(columns: list[str], prefixes: tuple[str, ...]) -> list[str]:
    """Columns to read when whole groups are left out by name."""
    return [c for c in columns if not c.startswith(prefixes)]


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """train / val / test parts as partitions, so a part is read without the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, part: str) -> DataFrame:
    return spark.read.parquet(path).where(f"split = '{part}'").drop("split")
