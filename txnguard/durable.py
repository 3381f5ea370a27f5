"""Cut lineage into a table on shared storage.

A result that several branches of a plan must see identically (range slabs,
fitted tables) is written once below ``spark.checkpoint.dir`` and read back.
Unlike executor-local caching it survives lost executors, and the parquet
footer gives Spark the real size of the table.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="txnguard-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return the stored copy."""
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/txnguard/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
