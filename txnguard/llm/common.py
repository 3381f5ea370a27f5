"""Reading, storing and per-row Arrow functions shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from txnguard.durable import scratch_root

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


#: Bytes of a batch of rows passed to Python. A task holds some batches of texts in the JVM, beside its heap, and as many in Python.
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches end at ``BATCH`` bytes, not only at a number of rows, so tasks over long texts need no more memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one job in the shared folder, cutting lineage there.

    A lost executor costs only the tasks it ran: every stored table outlives it. The shuffle files of a table's job go with
    the job, not when the driver happens to collect its garbage. ``drop`` removes tables that no later step reads.

    With ``estimates`` off only those tables are broadcast that a join names, or that have been shuffled and are known to be small:
    Spark takes an exploded table to be no larger than what was exploded, and a stored one to be as large as its compressed files.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"

    def __init__(self, spark: SparkSession, job: str, estimates: bool = True):
        self.spark, self.n = spark, 0
        self.settings = {self.CLEANUP: "true"}
        if not estimates:
            self.settings |= {self.MEASURED: spark.conf.get(self.MEASURED, None) or spark.conf.get(self.ESTIMATED), self.ESTIMATED: "-1"}
        self.root = f"{scratch_root(spark).rstrip('/')}/txnguard/{job}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{label}"
        conf = self.spark.conf
        before = {key: conf.get(key, None) for key in self.settings}
        try:
            for key, value in self.settings.items():
                conf.set(key, value)
            df.write.parquet(path)
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
            path.getFileSystem(conf).delete(path, True)


def span_finder(find: Callable[[str], list[tuple[str, int, int]]]) -> Callable[[Column], Column]:
    """``find`` over each text as a column function giving an array of (kind, start, end)."""
    def spans(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            value = text.as_py()
            out.append([{"kind": k, "start": a, "end": b} for k, a, b in find(value)] if value else [])
        return pa.array(out, type=_SPANS)
    return F.arrow_udf(spans, SPANS)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order given."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))))


def of_kind(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name
