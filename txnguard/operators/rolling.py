"""Percentiles over the last N rows of a sequence."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from math import nan

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from txnguard import constants as K
from txnguard.operators.prefix import running_totals

PERCENTS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


class Frame:
    """The last ``size`` values in rank order. A null takes a place and has no rank; NaN ranks above all numbers."""

    def __init__(self, size: int):
        self.size, self.seen, self.ranked, self.nans = size, deque(), [], 0

    def add(self, value) -> None:
        if len(self.seen) == self.size:
            old = self.seen.popleft()
            if old is not None and old == old:
                del self.ranked[bisect_left(self.ranked, old)]
            elif old is not None:
                self.nans -= 1
        self.seen.append(value)
        if value is not None and value == value:
            insort(self.ranked, value)
        elif value is not None:
            self.nans += 1

    def nearest(self, p: float):
        n = len(self.ranked) + self.nans
        if not n:
            return None
        at = round((n - 1) * p)
        return self.ranked[at] if at < len(self.ranked) else nan


def rolling_percentiles(df: DataFrame, key: str, order: list[str], value: str, last: int = 500,
                        chunk: int = 20_000, budget: int = K.LATENCY_BUDGET_MS) -> DataFrame:
    """Nearest-rank p50/p95/p99 over each row and the ``last - 1`` before it.

    Rows are numbered exactly and cut into chunks; a chunk borrows the end of
    the one before, so no task holds more than ``chunk + last`` rows of a key.
    One ranked frame moves along a chunk: a row enters and one leaves, so the
    memory is that of one frame, whatever the number of rows. A frame of nulls
    has null percentiles. Every column passes through Python; select first.
    """
    chunk = max(chunk, last)
    counted = running_totals(df.withColumn("_one", F.lit(1)), [key], [F.col(c) for c in order], ["_one"])
    at = F.col("cum__one") - 1
    own = F.floor(at / F.lit(chunk))
    lends = at % chunk >= chunk - (last - 1)
    homes = F.when(lends, F.array(own, own + 1)).otherwise(F.array(own))
    placed = counted.withColumn("_home", own).withColumn("_chunk", F.explode(homes)).select(*df.columns, "cum__one", "_home", "_chunk")
    kind = to_arrow_type(df.schema[value].dataType)
    names = df.columns

    def walk(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("cum__one")
        frame, out = Frame(last), {name: [] for name in PERCENTS}
        homes, chunk_no = rows["_home"].to_pylist(), rows["_chunk"][0].as_py()
        for home, v in zip(homes, rows[value].to_pylist()):
            frame.add(v)
            if home == chunk_no:
                for name, p in PERCENTS.items():
                    out[name].append(frame.nearest(p))
        mine = rows.filter(pa.array([home == chunk_no for home in homes])).select(names)
        for name, found in out.items():
            mine = mine.append_column(name, pa.array(found, type=kind))
        return mine

    schema = T.StructType([*df.schema.fields, *(T.StructField(name, df.schema[value].dataType) for name in PERCENTS)])
    return placed.groupBy(key, "_chunk").applyInArrow(walk, schema).withColumn("slo_ok", F.col("p95") < budget)
