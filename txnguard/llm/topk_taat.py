"""Exact top-k inner products, term at a time.

Vectors become sparse rows of integer weights. Candidates are dealt into blocks of bounded size and queries into blocks of
bounded size; each pair of blocks is one task group. There the candidate block is inverted into postings, one list per
term; a query's terms are taken one after another, each scattering its weight times the posting's weights into a dense
array of scores. The k best of each query in the block are selected by partition, and the lists of all blocks are merged
by a window that keeps k per query. Nothing is broadcast and no block grows with the data.

Null vectors and vectors with a null or non-finite component take no part, neither as queries nor as candidates. A
query row does not meet its own id; ties go to the smaller id; rows repeating an id are candidates of their own. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATES = 16384  # rows of a candidate block, in the mean
QUERIES = 2048  # rows of a query block, in the mean
STRIP = 64  # queries scored at a time: a dense array of STRIP x candidates


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integer_weights(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of term weights; shorter rows end in zeros, which are in no posting."""
    arr = column.combine_chunks()
    size = np.diff(arr.offsets.to_numpy())
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place (ids ascend); own is left out."""
    live = ids != own
    left = int(live.sum())
    if left > k:
        masked = np.where(live, scores, np.iinfo(np.int64).min)
        least = np.partition(masked, len(masked) - k)[len(masked) - k]
        above = np.flatnonzero(live & (scores > least))
        level = np.flatnonzero(live & (scores == least))[: k - len(above)]
        places = np.concatenate([above, level])
    else:
        places = np.flatnonzero(live)
    return places[np.lexsort((ids[places], -scores[places]))]


def score_blocks(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best of one candidate block for each query of one query block."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not len(candidates) or not len(queries):
        return schema.empty_table()
    ids = candidates["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, weights = ids[order], _matrix(candidates["w"])[order]
    postings = [np.flatnonzero(weights[:, t]) for t in range(weights.shape[1])]
    lists = [weights[rows, t] for t, rows in enumerate(postings)]
    q_ids, q_weights = queries["id"].to_numpy(), _matrix(queries["w"])
    out_q, out_c, out_s = [], [], []
    for at in range(0, len(q_ids), STRIP):
        strip = q_weights[at:at + STRIP]
        scores = np.zeros((len(strip), len(ids)), dtype=np.int64)
        for t in range(min(strip.shape[1], len(postings))):
            having = np.flatnonzero(strip[:, t])
            if len(having) and len(postings[t]):
                if len(postings[t]) == len(ids):
                    scores[having] += strip[having, t][:, None] * lists[t]
                else:
                    scores[having[:, None], postings[t]] += strip[having, t][:, None] * lists[t]
        for i, own in enumerate(q_ids[at:at + STRIP]):
            best = _best(scores[i], ids, own, k)
            out_q.append(np.full(len(best), own))
            out_c.append(ids[best])
            out_s.append(scores[i][best])
    return pa.table([np.concatenate(c) for c in (out_q, out_c, out_s)], schema=schema)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "vec_id", weights: str = "weights") -> DataFrame:
    """For each query row its k best candidates: query_id, rank, vec_id, score. ``weights`` is an array of longs."""
    q = queries.select(F.col(id_col).cast("long").alias("id"), F.col(weights).alias("w")).where("id IS NOT NULL")
    c = candidates.select(F.col(id_col).cast("long").alias("id"), F.col(weights).alias("w")).where("id IS NOT NULL")
    n_c = max(1, math.ceil(c.count() / CANDIDATES))
    n_q = max(1, math.ceil(q.count() / QUERIES))
    c = c.withColumn("cb", F.pmod(F.xxhash64("id", "w"), F.lit(n_c)).cast("int")) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    q = q.dropDuplicates(["id", "w"]).withColumn("qb", F.pmod(F.xxhash64("id", "w"), F.lit(n_q)).cast("int")) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        return score_blocks(left, right, k)

    found = c.groupBy("cb", "qb").cogroup(q.groupBy("cb", "qb")).applyInArrow(scored, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Rows whose id is divisible by ``every`` against all other rows, by floor(256 * x)."""
    rows = vectors.select("vec_id", "embedding").where(usable(F.col("embedding"))) \
        .select("vec_id", integer_weights(F.col("embedding")).alias("weights"))
    return top_k(rows.where(F.col("vec_id") % every == 0), rows, k)


REPORT_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
