"""Stream sources and sinks: files or Kafka, decoding with a quarantine, keyed output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from txnguard.schemas import SCHEMAS


def read_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
               max_files: int | None = None, glob: str | None = None, nested: bool = False) -> DataFrame:
    """``nested``: folders below ``path`` are read, too, whatever their names."""
    reader = spark.readStream.format(fmt).schema(schema)
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def read_kafka(spark: SparkSession, servers: str, topics: str, start: str = "latest", max_offsets: int | None = None,
               **options: str) -> DataFrame:
    """Needs the Kafka connector on the class path; offsets give the arrival order."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
              .option("startingOffsets", start).option("kafka.isolation.level", "read_committed").options(**options))
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("topic", F.col("key").cast("string"), F.col("value").cast("string"),
                                F.col("offset").alias("arrival"))


def decode(raw: DataFrame, record: str, value: str = "value") -> DataFrame:
    """JSON payloads as a record; ``ok`` is false for rows that must be quarantined: no id, broken, or a field of the wrong type."""
    shape = T.StructType([*SCHEMAS[record].fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(value), shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return raw.withColumn("_r", parsed).withColumn("ok", F.col("_r.event_id").isNotNull() & F.col("_r._corrupt").isNull())


def decoded(frame: DataFrame, keep: list[str] = ()) -> DataFrame:
    return frame.where("ok").select(*keep, "_r.*").drop("_corrupt")


def quarantined(frame: DataFrame, value: str = "value") -> DataFrame:
    return frame.where("NOT ok").select(value)


def keyed(df: DataFrame, key: str = "customer_id", keep: list[str] = ()) -> DataFrame:
    """Rows as key and JSON value, ready for a keyed topic; columns in ``keep`` stay beside the value."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*[c for c in df.columns if c not in keep])).alias("value"), *keep)


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "customer_id") -> DataStreamWriter:
    return (keyed(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.enable.idempotence", "true").option("topic", topic).option("checkpointLocation", checkpoint))
