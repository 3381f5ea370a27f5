"""Packing into sequences of several permitted lengths by variable-capacity best-fit.

Documents become pieces of at most the largest capacity. Pieces are packed in blocks of ``BLOCK`` pieces, longest first: a piece
goes to the open bin with the least room that holds it. If none does, a bin is opened whose size costs least for
each token it is expected to hold: (capacity + ``overhead``) / (piece + what the block's remaining pieces can still fill), the
smaller size on a tie. At the end each bin is downsized to the least permitted capacity that holds its contents. Sizes are
thus chosen jointly: large bins while many small pieces are left to fill them, small ones for the tail.

Only ids and lengths reach Python, one block at a time, within the partitions of the input: no shuffle, and no group grows
with the data. A bin's id names its partition, block and number.

Null lengths count as 0; documents of no tokens give one piece of 0 tokens, which takes no room. Repeated rows are packed
each on its own. Null ids and other columns are kept. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

CAPACITIES = (512, 1024, 2048, 4096)
BLOCK = 32768


def word_count(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def pack(lengths: list[int], capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset in its bin, capacity of each bin)."""
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    ranked = np.array(sorted(lengths))
    totals = np.concatenate([[0], np.cumsum(ranked)])
    bin_of, offset, used, size_of = [0] * len(lengths), [0] * len(lengths), [], []
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    by_room: dict[int, list[int]] = {}
    for place, i in enumerate(order):
        need = lengths[i]
        at = bisect_left(rooms, need)
        if at < len(rooms) and (need > 0 or rooms):
            room = rooms[at]
            number = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            left = len(order) - place - 1  # the shorter pieces, which come first in ``ranked``

            def price(size: int) -> float:
                fill = int(totals[min(left, bisect_right(ranked, size - need))])
                return (size + overhead) / max(1, need + min(size - need, fill))

            size = min((s for s in sizes if s >= need), key=lambda s: (price(s), s))
            number, room = len(used), size
            used.append(0)
            size_of.append(size)
        bin_of[i], offset[i] = number, used[number]
        used[number] += need
        room -= need
        if room not in by_room:
            by_room[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        by_room[room].append(number)
    return bin_of, offset, [sizes[bisect_left(sizes, n)] for n in used]


def packed(df: DataFrame, length: str, capacities: tuple[int, ...] = CAPACITIES, overhead: int = 16) -> DataFrame:
    """A row for each piece: the columns of ``df`` and piece, start, n_tokens, bin_id, bin_offset, bin_capacity, bin_tokens.
    Columns of those names are replaced."""
    new = ["piece", "start", "n_tokens", "bin_id", "bin_offset", "bin_capacity", "bin_tokens"]
    kept = [f for f in df.schema.fields if f.name.lower() not in new or f.name == length]
    largest = max(capacities)
    size = F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(0))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(size - 1, F.lit(0)), F.lit(largest).cast("long"))
    rows = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)], size.alias("whole"), F.posexplode(starts).alias("piece", "start")) \
        .withColumn("n_tokens", F.least(F.col("whole") - F.col("start"), F.lit(largest))).drop("whole") \
        .withColumn("piece", F.col("piece").cast("long"))
    schema = T.StructType(rows.schema.fields + [T.StructField("bin_id", T.StringType()), T.StructField("bin_offset", T.LongType()),
                                                T.StructField("bin_capacity", T.LongType()), T.StructField("bin_tokens", T.LongType())])

    def blocks(batches):
        held, n, block = [], 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            while len(batch):
                take = min(BLOCK - n, len(batch))
                held.append(batch.slice(0, take))
                batch, n = batch.slice(take), n + take
                if n == BLOCK:
                    yield from done(held, part, block)
                    held, n, block = [], 0, block + 1
        if held:
            yield from done(held, part, block)

    def done(held, part, block):
        whole = pa.Table.from_batches(held).combine_chunks()
        lengths = whole["n_tokens"].to_pylist()
        bin_of, offset, capacity = pack(lengths, capacities, overhead)
        bin_of = np.array(bin_of)
        tokens = np.bincount(bin_of, weights=lengths, minlength=len(capacity)).astype(np.int64)
        out = whole.append_column("bin_id", pa.array([f"{part}-{block}-{b}" for b in bin_of], pa.string())) \
            .append_column("bin_offset", pa.array(offset, pa.int64())).append_column("bin_capacity", pa.array(np.array(capacity, np.int64)[bin_of])) \
            .append_column("bin_tokens", pa.array(tokens[bin_of]))
        yield from out.to_batches()

    out = rows.mapInArrow(blocks, schema)
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept) if f.name not in new], *new)


def report(docs: DataFrame) -> DataFrame:
    """Where each piece of each document goes; a token is a word, and one more ends the document."""
    return packed(docs.select("doc_id", (word_count(F.col("text")) + 1).alias("length")), "length").drop("length")
