"""Text anomaly: a character-trigram language model fitted and applied with joins.

It takes the place of a neural masked language model; the perplexity, the
squashed score and the label are computed the same way. Another scorer plugs
in through ``score_with`` as a pandas UDF giving the mean log-probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.durable import materialize
from txnguard.functions import scalars as X
from txnguard.operators.joins import lookup_join, split_join

@dataclass
class TrigramModel:
    trigrams: DataFrame     # tri, n
    contexts: DataFrame     # ctx, ctx_n
    alphabet: Column        # scalar
    add: float


def normalized(text: Column) -> Column:
    """Lower case, single spaces; every script is kept."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x09-\x0D\x20]+", " "))


def _trigrams(word: str) -> Column:
    framed = f"concat('^^', {word}, '$')"
    return F.expr(f"explode(transform(sequence(1, length({word}) + 1), i -> substring({framed}, i, 3)))")


def fit(corpus: DataFrame, text: str = "text", add: float = 0.5) -> TrigramModel:
    """Counts over whole texts. Words are counted first, so trigrams are cut once per distinct word."""
    words = corpus.select(F.explode(F.split(normalized(F.col(text)), " ")).alias("w")).where("w <> ''")
    counted = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    tri = materialize(counted.select(_trigrams("w").alias("tri"), "n").groupBy("tri").agg(F.sum("n").alias("n")), "trigrams")
    ctx = materialize(tri.groupBy(F.substring("tri", 1, 2).alias("ctx")).agg(F.sum("n").alias("ctx_n")), "contexts")
    size = tri.select(F.substring("tri", 3, 1).alias("c")).distinct().agg(F.count(F.lit(1))).scalar()
    return TrigramModel(tri, ctx, size, add)


def log_probabilities(texts: DataFrame, model: TrigramModel, text: str = "text") -> DataFrame:
    """Mean log-probability per distinct text (NULL for texts with nothing to score).

    Distinct words are scored once; a text travels as a 128-bit key, not with each of its trigrams.
    """
    distinct = texts.select(F.col(text).alias("text")).distinct()
    keyed = distinct.withColumn("key", F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))
    words = keyed.select("key", F.explode(F.split(normalized(F.col("text")), " ")).alias("w")).where("w <> ''")
    seen = words.select("w").distinct().select("w", _trigrams("w").alias("tri")).groupBy("w", "tri").agg(F.count(F.lit(1)).alias("times"))
    seen = seen.withColumn("ctx", F.substring("tri", 1, 2))
    known = lookup_join(seen, model.trigrams, ["tri"], "left")
    known = lookup_join(known, model.contexts, ["ctx"], "left").withColumn("v", model.alphabet)
    k = F.lit(model.add)
    log_p = F.log((F.coalesce("n", F.lit(0)) + k) / (F.coalesce("ctx_n", F.lit(0)) + k * F.col("v")))
    scored = known.groupBy("w").agg(F.sum(log_p * F.col("times")).alias("log_p"), F.sum("times").alias("times"))
    uses = words.groupBy("key", "w").agg(F.count(F.lit(1)).alias("uses"))
    mean = uses.join(scored, "w").groupBy("key").agg((F.sum(F.col("log_p") * F.col("uses")) / F.sum(F.col("times") * F.col("uses"))).alias("mean_log_prob"))
    return keyed.join(mean, "key", "left").drop("key")


def score(df: DataFrame, text: str, model: TrigramModel, suspicious: float = K.SUSPICIOUS_LOG_PPL,
          slope: float = K.PERPLEXITY_SLOPE, key: str = "event_id") -> DataFrame:
    """Rows with log_perplexity, perplexity, text_anomaly_score and label. Every distinct text is scored once."""
    rows = df.withColumn(text, F.coalesce(text, F.lit("")))
    uses = rows.groupBy(F.col(text).alias("text")).agg(F.count(F.lit(1)).alias("_uses"))
    per = log_probabilities(rows, model, text).join(uses, "text").withColumns(
        X.perplexity(F.col("mean_log_prob"), suspicious=suspicious, slope=slope))
    per = materialize(per.withColumnRenamed("text", text).drop("mean_log_prob"), "text-scores")
    return split_join(rows, per, [text], "_uses", spread_by=[key])


def worker_scorer(model: TrigramModel, limit: int = 2_000_000) -> Callable[[Column], Column]:
    """A column function giving each text's mean log-probability from a model held in the worker: an iterator UDF that makes its
    dictionary once and scores every distinct text and word of a batch once. The trigrams, at most the cube of the alphabet, are counted
    first; a model beyond ``limit`` is for ``score``, which joins."""
    n = model.trigrams.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"the model has more than {limit} trigrams")
    spark = model.trigrams.sparkSession
    rows = {r["tri"]: r["n"] for r in model.trigrams.select("tri", "n").collect()}
    size = spark.range(1).select(model.alphabet.alias("v")).first()["v"]
    shared, add = spark.sparkContext.broadcast((rows, int(size))), model.add

    @F.pandas_udf("double")
    def mean_log_prob(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts, size = shared.value
        contexts: dict[str, int] = {}
        for tri, n in counts.items():
            contexts[tri[:2]] = contexts.get(tri[:2], 0) + n
        words: dict[str, tuple[float, int]] = {}

        def of_word(word: str) -> tuple[float, int]:
            if word not in words:
                if len(words) >= 100_000:
                    words.clear()
                framed = f"^^{word}$"
                tris = [framed[i:i + 3] for i in range(len(word) + 1)]
                words[word] = sum(log((counts.get(t, 0) + add) / (contexts.get(t[:2], 0) + add * size)) for t in tris), len(tris)
            return words[word]

        def of_text(text: str) -> float | None:
            parts = [of_word(w) for w in text.split(" ") if w]
            return sum(p for p, _ in parts) / sum(n for _, n in parts) if parts else None
        for batch in batches:
            found = {t: of_text(t) for t in batch.unique()}
            yield pd.Series([found[t] for t in batch], dtype="float64")
    return lambda text: F.nullif(mean_log_prob(normalized(text)), F.lit(float("nan")))


def score_with(df: DataFrame, mean_log_prob: Column, suspicious: float = K.SUSPICIOUS_LOG_PPL) -> DataFrame:
    """The same columns from any scorer that yields a mean log-probability per row."""
    return df.withColumns(X.perplexity(mean_log_prob, suspicious=suspicious))
