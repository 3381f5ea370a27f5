"""Tables fed by micro-batches.

A batch writes its own partition and overwrites it when retried, so a replay
changes nothing. The keyed table is the latest-wins fold of the batches;
``compact`` stores that fold as a new base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from txnguard.operators import merge


class BatchTable:
    """``by`` names a column (a day number) the table is partitioned by above the batch,
    so a reader of recent rows does not open older folders."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.by = schema, by

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Idempotent per batch id."""
        rows = df.select(*self.schema.fieldNames())
        if self.by is None:
            rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        else:
            (rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(self.by, "batch").parquet(self.path))

    def read(self, before: int | None = None) -> DataFrame:
        """All rows with their ``batch``; an absent table is empty."""
        with_batch = T.StructType(self.schema.fields + [T.StructField("batch", T.LongType())])
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return self.spark.createDataFrame([], with_batch)
        df = self.spark.read.schema(with_batch).option("basePath", self.path).parquet(self.path)
        return df if before is None else df.where(F.col("batch") < before)

    def current(self, first: list[str], latest: list[str], version: str, key: str = "event_id", seq: str = "arrival") -> DataFrame:
        """One row per key: ``first`` from the earliest delivery, ``latest`` from the newest version."""
        rows = self.read().withColumn("_at", F.struct("batch", seq))
        return merge.latest_wins(rows, first, latest, version, "_at", key)

    def compact(self, into: "BatchTable", first: list[str], latest: list[str], version: str, upto: int) -> None:
        """Store the fold of all batches up to ``upto`` as one base batch of another table.
        The base ranks before every later batch, as its rows arrived first."""
        rows = self.read(before=upto + 1).withColumn("_at", F.struct("batch", "arrival"))
        into.write(merge.latest_wins(rows, first, latest, version, "_at").withColumn("arrival", F.lit(-1).cast("long")), -1)


class Folder:
    """A folder of the shared store, through the file system Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self) -> list[str]:
        fs, path = self._at()
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def mark(self, name: str) -> None:
        fs, path = self._at(name)
        fs.create(path, True).close()

    def drop(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def take(self, source: str, name: str) -> None:
        """Move a finished folder here in one step, so that readers see all of it or nothing."""
        fs, path = self._at(name)
        fs.mkdirs(path.getParent())
        if not fs.rename(self.spark._jvm.org.apache.hadoop.fs.Path(source), path):
            raise OSError(f"could not move {source} to {path}")


class KeyedTable:
    """A keyed, latest-wins table that micro-batches feed while others read it.

    ``batches/N`` holds what batch N wrote and ``commits/N`` says that it is whole: readers see committed batches only, a retry
    of an uncommitted batch overwrites it, and one of a committed batch changes nothing. Every ``every`` batches the fold of base
    and batches becomes the next base, committed in the same way; batches and bases that the one before it
    covers are then removed, so a reader that listed them just before can still finish.

    ``arrival`` orders the deliveries of a key (the offset in its source). The base keeps the first and last arrival of a key,
    so the fold is the same however deliveries fall into batches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, first: list[str], latest: list[str],
                 version: str = "scored_at_ms", key: str = "event_id", every: int = 8):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.first, self.latest, self.version, self.key, self.every = first, latest, version, key, every
        self.log = Folder(spark, f"{self.path}/commits")
        self.stored = T.StructType([schema[c] for c in (key, *first, *latest)] + [T.StructField(c, T.LongType()) for c in ("first_at", "last_at")])

    def committed(self) -> tuple[int, list[int]]:
        """(last batch in the newest base or -1, committed batches after it)."""
        names = self.log.names()
        base = max((int(n[5:]) for n in names if n.startswith("base-")), default=-1)
        return base, sorted(b for b in (int(n) for n in names if n.isdigit()) if b > base)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        base, after = self.committed()
        if batch_id <= base or batch_id in after:
            return
        at = F.col("arrival").cast("long")
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.stored.fields[:-2]], at.alias("first_at"), at.alias("last_at")) \
            .write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}")
        self.log.mark(str(batch_id))
        if len(after) + 1 >= self.every:
            self.compact()

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(*paths) if paths else self.spark.createDataFrame([], self.stored)

    def _fold(self) -> DataFrame:
        base, after = self.committed()
        rows = self._read([f"{self.path}/base/{base}"] * (base >= 0) + [f"{self.path}/batches/{b}" for b in after])

        def newest() -> Column:
            return F.struct(self.version, "last_at")
        folded = rows.groupBy(self.key).agg(F.min_by(F.struct(*self.first), "first_at").alias("_first"), F.max_by(F.struct(*self.latest), newest()).alias("_latest"),
                                            F.min("first_at").alias("first_at"), F.max_by("last_at", newest()).alias("last_at"))
        return folded.select(self.key, "_first.*", "_latest.*", "first_at", "last_at")

    def compact(self) -> None:
        """Store the fold of everything committed as the next base."""
        base, after = self.committed()
        if not after:
            return
        self._fold().write.mode("overwrite").parquet(f"{self.path}/base/{after[-1]}")
        self.log.mark(f"base-{after[-1]}")
        for b in [int(n) for n in self.log.names() if n.isdigit() and int(n) <= base]:
            Folder(self.spark, f"{self.path}/batches").drop(str(b))
            self.log.drop(str(b))
        for b in [int(n[5:]) for n in self.log.names() if n.startswith("base-") and int(n[5:]) < base]:
            Folder(self.spark, f"{self.path}/base").drop(str(b))
            self.log.drop(f"base-{b}")

    def current(self) -> DataFrame:
        """One row per key as of the batches committed by now."""
        return self._fold().drop("first_at", "last_at")
