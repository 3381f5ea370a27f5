"""Keyed state in the stream: per-event velocity, split by card and time block, and a score cache with expiry."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txnguard import constants as K

ROCKSDB = ("spark.sql.streaming.stateStore.providerClass",
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
VELOCITY_OUT = "event_id string, card_token string, event_timestamp_ms long, velocity_hit boolean, velocity_window string, velocity_reason string"
_KINDS = {"card": pa.string(), "event_id": pa.string(), "ms": pa.int64(), "n": pa.int64()}
#: Rows of a chunk of state or of a judged batch, and chunks of a block that are left as they are.
CHUNK, FEW = 100_000, 8
_JUDGED = ["event_id", "card_token", "event_timestamp_ms", "velocity_hit", "velocity_window", "velocity_reason"]


class Reach:
    """Which earlier time blocks the windows of a block reach, and how."""

    def __init__(self, windows=K.VELOCITY_WINDOWS, block_ms: int | None = None):
        longest = max(s for _, s, _ in windows)
        self.windows = [(w, s * 1000 - (1 if s == longest else 0), t) for w, s, t in windows]
        self.block_ms = block_ms or max(1, longest * 1000 // 4)
        self.blocks = (longest * 1000 - 2) // self.block_ms + 1

    def inside(self, distance: int) -> list[bool] | None:
        """For a block so many before another: which windows of any event there hold all of it, or None if some hold a part."""
        low, high = (distance - 1) * self.block_ms + 1, (distance + 1) * self.block_ms - 1
        if distance == 0 or any(low <= back < high for _, back, _ in self.windows):
            return None
        return [high <= back for _, back, _ in self.windows]


def _packed(**columns) -> tuple[bytes]:
    """One chunk of a state list: columns as an Arrow stream."""
    batch = pa.RecordBatch.from_arrays([pa.array(v, _KINDS[k]) for k, v in columns.items()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(state) -> pa.Table | None:
    chunks = [pa.ipc.open_stream(c[0]).read_all() for c in state.get()] if state.exists() else []
    return pa.concat_tables(chunks) if chunks else None


def _codes(cards: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """A number for each card, and the card of each number."""
    coded = cards.combine_chunks().dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


class VelocityProcessor(StatefulProcessor):
    """One time block of one lane of cards: judges its events as the watermark passes them.

    An event is sent to its own block, where it is judged, and to the later blocks that its windows reach, where it only counts:
    by its millisecond where a window's edge can fall, else by its block (any of whose times gives the same answer). So a card's
    state is split by time, a block never holds more entries of a card than the milliseconds in reach, and it is cleared when the watermark
    passes its end. A lane's cards are held and judged together, so Python is called for each lane and block, not for each card. Every
    micro-batch adds chunks to the state lists; many chunks are folded into few. Events sharing a millisecond count each other, as in the batch operator.
    """

    def __init__(self, reach: Reach, chunk: int = CHUNK):
        self.reach, self.chunk = reach, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        chunk = T.StructType([T.StructField("chunk", T.BinaryType())])
        self.handle = handle
        self.seen = handle.getListState("seen", chunk)
        self.waiting = handle.getListState("waiting", chunk)

    def _fold(self, held: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """(card number, ms, n) once for each card and ms, ascending, and the cards."""
        codes, cards = _codes(held["card"])
        ms = held["ms"].to_numpy()
        least, span = int(ms.min()), int(ms.max()) - int(ms.min()) + 1
        keys, of = np.unique(codes * span + (ms - least), return_inverse=True)
        return keys // span, keys % span + least, np.bincount(of, held["n"].to_numpy(), len(keys)).astype(np.int64), cards

    def _add(self, parts: list[pa.Table]) -> None:
        code, ms, n, cards = self._fold(pa.concat_tables(parts))
        self.seen.appendValue(_packed(card=cards.take(pa.array(code)), ms=ms, n=n))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        block, size, first, new = int(key[1]), self.reach.block_ms, None, not self.seen.exists()
        whole = {d: self.reach.inside(d) is not None for d in range(self.reach.blocks + 1)}
        parts, held = [], 0
        for pdf in rows:
            times = pdf["event_timestamp_ms"].to_numpy(np.int64)
            home = times // size
            ms = np.where([whole.get(d, True) for d in (block - home).tolist()], home * size, times)
            parts.append(pa.table({"card": pa.array(pdf["card_token"], pa.string()), "ms": ms, "n": np.ones(len(ms), np.int64)}))
            held += len(ms)
            if held >= self.chunk:
                self._add(parts)
                parts, held = [], 0
            own = pdf[pdf["event_id"].notna()]
            if len(own):
                self.waiting.appendValue(_packed(card=own["card_token"], ms=own["event_timestamp_ms"], event_id=own["event_id"]))
                first = min(int(own["event_timestamp_ms"].min()), first if first is not None else 1 << 62)
        if parts:
            self._add(parts)
        for at in ([(block + 1) * size - 1] if new else []) + ([first] if first is not None else []):
            self.handle.registerTimer(at)
        yield pd.DataFrame(columns=_JUDGED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, end = timerValues.getCurrentWatermarkInMs(), (int(key[1]) + 1) * self.reach.block_ms - 1
        held = _unpacked(self.waiting)
        passed = held["ms"].to_numpy() <= now if held is not None else np.zeros(0, bool)
        if passed.any():
            due, rest = held.filter(pa.array(passed)), held.filter(pa.array(~passed))
            yield from self._judged(due)
            if len(rest) and now < end:
                self.waiting.put([_packed(**{c: rest[c].combine_chunks() for c in rest.column_names})])
                self.handle.registerTimer(int(rest["ms"].to_numpy().min()))
            else:
                self.waiting.clear()
        if now >= end:
            self.seen.clear()
            self.waiting.clear()
        yield pd.DataFrame(columns=_JUDGED)

    def _judged(self, due: pa.Table) -> Iterator[pd.DataFrame]:
        seen = _unpacked(self.seen)
        code, ms, n, cards = self._fold(seen)
        if seen["card"].num_chunks > FEW:
            lots = range(0, len(ms), self.chunk)
            self.seen.put([_packed(card=cards.take(pa.array(code[i:i + self.chunk])), ms=ms[i:i + self.chunk], n=n[i:i + self.chunk]) for i in lots])
        every, own = due["ms"].to_numpy(), pc.index_in(due["card"], cards).to_numpy().astype(np.int64)
        least = min(int(ms.min()), int(every.min()))
        span = max(int(ms.max()), int(every.max())) - least + 1
        line, upto = code * span + (ms - least), np.concatenate([[0], np.cumsum(n)])  # cards one after another on one line
        for i in range(0, len(every), self.chunk):
            at, card = every[i:i + self.chunk], own[i:i + self.chunk] * span
            last = upto[np.searchsorted(line, card + (at - least), "right")]
            label, reason, hit = np.full(len(at), "", object), np.full(len(at), "", object), np.zeros(len(at), bool)
            for name, back, threshold in self.reach.windows:
                count = last - upto[np.searchsorted(line, card + np.maximum(at - back - least, 0), "left")]
                over = (count >= threshold) & ~hit
                label[over], hit = name, hit | over
                reason[over] = [f"{c} txns on card in {name} (threshold {threshold})" for c in count[over].tolist()]
            piece = due.slice(i, self.chunk)
            yield pd.DataFrame({"event_id": piece["event_id"].to_pylist(), "card_token": piece["card"].to_pylist(), "event_timestamp_ms": at,
                                "velocity_hit": hit, "velocity_window": label, "velocity_reason": reason})

    def close(self) -> None:
        pass


def velocity_stream(events: DataFrame, windows=K.VELOCITY_WINDOWS, block_ms: int | None = None, lanes: int = 64, chunk: int = CHUNK) -> DataFrame:
    """``events`` needs a watermark on an event-time column, each event once (``ingest.deduplicated``) and the RocksDB state store.
    State lies by time block (a quarter of the longest window, unless given) and by lane, a hash of the card; the number of ``lanes`` stays
    as it is for a checkpoint. Events without a card never hit."""
    carded = F.coalesce(F.col("card_token") != "", F.lit(False))
    reach = Reach(windows, block_ms)
    own = F.floor(F.col("event_timestamp_ms") / F.lit(reach.block_ms))
    time = next(f.name for f in events.schema.fields if "spark.watermarkDelayMs" in (f.metadata or {}))
    spread = events.where(carded).select("card_token", "event_id", "event_timestamp_ms", time, own.alias("own")) \
        .withColumn("block", F.explode(F.sequence("own", F.col("own") + reach.blocks))) \
        .withColumn("event_id", F.when(F.col("block") == F.col("own"), F.col("event_id"))).drop("own") \
        .withColumn("lane", F.pmod(F.xxhash64("card_token"), F.lit(lanes)))
    judged = spread.groupBy("lane", "block").transformWithStateInPandas(
        statefulProcessor=VelocityProcessor(reach, chunk), outputStructType=VELOCITY_OUT, outputMode="Append", timeMode="EventTime")
    rest = events.where(~carded).select("event_id", "card_token", "event_timestamp_ms", F.lit(False).alias("velocity_hit"),
                                        F.lit("").alias("velocity_window"), F.lit("").alias("velocity_reason"))
    return judged.unionByName(rest)


CACHE_OUT = "event_id string, feature_hash string, fraud_score double, cached boolean"


class ScoreCacheProcessor(StatefulProcessor):
    """First score per feature hash, reused until ``ttl_ms`` of event time after it was made; hits do not extend it.

    A timer drops a hash ``keep_ms`` after its score arrived, so the state holds the hashes of that time only; an event
    delayed by more is scored anew.
    """

    def __init__(self, ttl_ms: int = 60_000, keep_ms: int = 3_600_000):
        self.ttl_ms, self.keep_ms = ttl_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", T.StructType([
            T.StructField("at", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("until", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.first.get() if self.first.exists() else None
        pdf = pd.concat(list(rows)).sort_values(["event_timestamp_ms", "event_id"])
        until = int(pdf["arrived_ms"].iloc[0]) + self.keep_ms
        before, out = held, []
        for e, ms, score in zip(pdf["event_id"], pdf["event_timestamp_ms"], pdf["fraud_score"]):
            hit = held is not None and int(ms) < held[0] + self.ttl_ms
            if not hit:
                held = (int(ms), float(score), until)
            out.append((e, key[0], held[1], hit))
        if held is not before:
            self.first.update(held)
            self.handle.registerTimer(until)
        yield pd.DataFrame(out, columns=["event_id", "feature_hash", "fraud_score", "cached"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.first.exists() and self.first.get()[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.first.clear()
        yield pd.DataFrame([], columns=["event_id", "feature_hash", "fraud_score", "cached"])

    def close(self) -> None:
        pass


def cached_scores(scored: DataFrame, ttl_ms: int = 60_000, keep_ms: int = 3_600_000) -> DataFrame:
    """The watermark is on the micro-batch's own time: it clears old state, and no late event is dropped by it."""
    timed = scored.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "1 second") \
        .withColumn("arrived_ms", F.unix_millis("arrived"))
    return timed.groupBy("feature_hash").transformWithStateInPandas(
        statefulProcessor=ScoreCacheProcessor(ttl_ms, keep_ms), outputStructType=CACHE_OUT, outputMode="Append", timeMode="EventTime")
