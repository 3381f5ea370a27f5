"""Repair of conversation structure by a grammar-compressed min-plus dynamic programme.

Every row of a conversation becomes a symbol: the initial of its role (system, user, assistant or other) and its first fault (blank,
duplicate, truncated or none). The repaired roles must read ``(s?(ua)+)?``; the automaton of that language has four states, and a symbol
is a 4 x 4 min-plus matrix: the least cost of taking the row, and what is inserted before it, from one state to another, with the
audit (one letter an edit) as a rope. Equal costs are settled by the audit that is least in ASCII; as each audit holds one letter that
is no I for every row and ends in it, none is a prefix of another of equal cost, so matrices multiply without loss.

1. One range shuffle orders rows by conversation, turn (nulls first) and a hash of role and text (ties). Each task turns its runs into
   chunks of at most ``ROWS`` rows; a conversation of any size spans chunks and tasks. Equal rows are spread by their input partition.
2. A duplicate of a row in an earlier task is found by the hashes of those conversations that span tasks, one row for each task and text.
3. Re-Pair over the distinct chunks: rounds of counting adjacent symbols replace the most frequent pairs by new symbols (``rules`` at
   most; what they leave over is walked symbol by symbol, with the same result). Each rule's matrix is worked out once in a worker, from
   those of its two symbols, whatever the number of conversations that share it.
4. Chunks multiply along their conversation: their matrices, without audits but with the order of these, are worked out wherever the chunks
   lie; a pass along each conversation keeps four back pointers a chunk and gives each chunk its first and last state, with
   which its audit is worked out, again wherever it lies. The last pass replays the audits on the rows, in order and in bounded memory.

The digest of a conversation is a chain over its text, so its chunks pass through one task, one after another, never held together.
A null conversation id is a conversation of its own. Null roles and texts count as one space; an empty role as a role of no known
initial. Repeated rows are duplicates. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from txnguard.llm.common import Scratch

ROWS = 512  # of a chunk
BYTES = 1 << 16  # of text, from which a chunk is closed
RULES = 256
ROUNDS = 12

#: The costs of edits, and of keeping a truncated row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NAMES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))

INITIALS, FAULTS = "suao", ("", "truncated", "blank", "duplicate")
#: The symbol of initial i and fault f is the letter 4 f + i.
SYMBOLS = "ABCDEFGHIJKLMNOP"
SPACE = " \t\n\v\f\r"
#: States: nothing yet, after s, after u, after a. What may follow a state, and where it leads.
START, NEXT = 0, ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Letters that complete a sequence that ends in a state.
ENDING = ("", "ua", "a", "")

FLAT = 4096  # letters of a rope that are kept as one string

Rope = str | tuple
Matrix = list[tuple[int, Rope] | None]  # 16 entries, from state * 4 + to state


# matrices


def letters(rope: Rope) -> Iterator[str]:
    """The letters of a rope, in order."""
    rest = [rope]
    while rest:
        top = rest.pop()
        if isinstance(top, str):
            yield from top
        else:
            rest += top[::-1]


def joined(a: Rope, b: Rope) -> Rope:
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= FLAT else (a, b)


def _before(a: Rope, b: Rope) -> bool:
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    return next((x < y for x, y in zip_longest(letters(a), letters(b), fillvalue="") if x != y), False)


def _better(new: tuple[int, Rope], old: tuple[int, Rope] | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and _before(new[1], old[1])


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: a, then b."""
    out: Matrix = [None] * 16
    for i in range(4):
        for m in range(4):
            if a[4 * i + m]:
                cost, rope = a[4 * i + m]
                for j in range(4):
                    if b[4 * m + j]:
                        new = (cost + b[4 * m + j][0], joined(rope, b[4 * m + j][1]))
                        if _better(new, out[4 * i + j]):
                            out[4 * i + j] = new
    return out


def _inserts() -> Matrix:
    """The cheapest insertions from one state to another: two at most, as a third would undo the first."""
    one = [(0, "") if i % 5 == 0 else None for i in range(16)]
    for i, follow in enumerate(NEXT):
        if "u" in follow or "a" in follow:
            one[4 * i + next(follow[c] for c in "ua" if c in follow)] = (INSERT, "I")
    return times(one, one)


EMPTY: Matrix = [(0, "") if i % 5 == 0 else None for i in range(16)]


def letter_matrix(symbol: str) -> Matrix:
    """One row, with what is inserted before it."""
    fault, initial = divmod(SYMBOLS.index(symbol), 4)
    out: Matrix = [(DELETE, "D") if i % 5 == 0 else None for i in range(16)]
    if FAULTS[fault] in ("", "truncated"):
        extra = TRUNCATED if FAULTS[fault] else 0
        for i, follow in enumerate(NEXT):
            for c, j in follow.items():
                for price, letter in ([(KEEP, "K")] if c == INITIALS[initial] else []) + ([(REROLE, "R")] if c in NAMES else []):
                    new = (price + extra, letter)
                    if _better(new, out[4 * i + j]):
                        out[4 * i + j] = new
    return times(_inserts(), out)


class Grammar:
    """Rules in the order made: (new symbol, its two symbols); matrices of symbols and of sequences."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.matrices = {s: letter_matrix(s) for s in SYMBOLS}
        for new, pair in rules:
            self.matrices[new] = times(self.matrices[pair[0]], self.matrices[pair[1]])
        self.known: dict[str, Matrix] = {}

    def packed(self, sequence: str) -> str:
        for new, pair in self.rules:
            if len(sequence) < 2:
                break
            sequence = sequence.replace(pair, new)
        return sequence

    def matrix(self, sequence: str) -> Matrix:
        """Of a non-empty sequence of symbols."""
        found = self.known.get(sequence)
        if found is None:
            packed = self.packed(sequence)
            found = self.matrices[packed[0]]
            for s in packed[1:]:
                found = times(found, self.matrices[s])
            if len(self.known) >= 20_000:
                self.known.clear()
            self.known[sequence] = found
        return found

    def audit(self, sequence: str, start: int, end: int) -> str:
        return "".join(letters(self.matrix(sequence)[4 * start + end][1])) if sequence else ""


def repair_pairs(sequences: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[tuple[str, str]]:
    """Re-Pair over ``sequences`` (symbols). A round replaces the most frequent pairs that share no symbol, so their order is free.
    The driver reads 64 pairs a round."""
    found: list[tuple[str, str]] = []
    for _ in range(rounds):
        made = list(found)

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grammar, seen = Grammar([]), Counter()
            grammar.rules = made
            for batch in batches:
                for sequence in batch["symbols"].to_pylist():
                    packed, last = grammar.packed(sequence), ""
                    for x, y in zip(packed, packed[1:]):
                        last = "" if x == y and last == x + y else x + y  # in xxx the pair xx occurs once
                        if last:
                            seen[last] += 1
            yield pa.RecordBatch.from_pydict({"pair": list(seen), "n": list(seen.values())}, schema=pa.schema([("pair", pa.string()), ("n", pa.int64())]))

        top = sequences.mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1") \
            .orderBy(F.desc("n"), "pair").limit(64).collect()
        used: set[str] = set()
        for row in top:
            if used.isdisjoint(row["pair"]) and len(found) < rules:
                used |= set(row["pair"])
                found.append((chr(0x100 + len(found)), row["pair"]))
        if not top or len(found) >= rules:
            break
    return found


# rows to chunks


def _symbol(role: str, text: str, seen: bool) -> str:
    body = text.rstrip(SPACE)
    fault = 2 if not body else 3 if seen else 1 if body[-1] not in ".!?" else 0
    place = INITIALS[:3].find(role[:1]) if role else 3
    return SYMBOLS[4 * fault + (place if place >= 0 else 3)]


_CHUNK = "part int, chunk int, symbols string, hi array<long>, lo array<long>, roles array<string>, texts array<string>, first_turn long, last_turn long, n_turns long"


def _chunked(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Ordered rows of one task as chunks of at most ``most`` rows. A conversation of dropped rows only leaves an empty chunk."""
    from pyspark import TaskContext
    part, n_chunks, size, held, conv, any_row, seen, now, schema = TaskContext.get().partitionId(), 0, 0, [], None, False, set(), None, None

    def fresh() -> dict:
        return {"conv": conv, "part": part, "chunk": n_chunks, "symbols": [], "hi": [], "lo": [], "roles": [], "texts": [],
                "first_turn": None, "last_turn": None, "n_turns": 0}

    def close() -> None:
        nonlocal n_chunks
        held.append(now | {"symbols": "".join(now["symbols"])})
        n_chunks += 1

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(held, schema=schema)
        held.clear()
        return out

    waiting = 0
    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("part", pa.int32()), ("chunk", pa.int32()), ("symbols", pa.string()),
                                ("hi", pa.list_(pa.int64())), ("lo", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
                                ("texts", pa.list_(pa.string())), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_turns", pa.int64())])
        for own, turn, role, text, copies, hi, lo in zip(*(batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "copies", "hi", "lo"))):
            if not any_row or own != conv:
                if any_row:
                    close()
                conv, any_row, seen, size = own, True, set(), 0
                now = fresh()
            for _ in range(copies):
                if len(now["symbols"]) >= most or size >= BYTES:
                    close()
                    now, size = fresh(), 0
                symbol = _symbol(role, text, (hi, lo) in seen)
                seen.add((hi, lo))
                for c, value in (("symbols", symbol), ("hi", hi), ("lo", lo), ("roles", role), ("texts", text)):
                    now[c].append(value)
                if turn is not None:
                    now["n_turns"] += turn != now["last_turn"]
                    now["first_turn"], now["last_turn"] = turn if now["first_turn"] is None else now["first_turn"], turn
                size += len(text)
                waiting += len(text) + 64
            if waiting > 1 << 22:
                if held:
                    yield flushed()
                waiting = 0
    if any_row:
        close()
    if held:
        yield flushed()


def _later(chunks: DataFrame) -> DataFrame:
    """(part, chunk, later): rows whose equal stands in an earlier task. A boundary between tasks cuts one conversation, so those
    that span tasks are fewer than the tasks and are broadcast."""
    split = chunks.groupBy("conv").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select(F.col("conv").alias("own"))
    first = chunks.join(F.broadcast(split), F.col("conv").eqNullSafe(F.col("own")), "left_semi") \
        .select("conv", "part", "chunk", "symbols", F.posexplode(F.arrays_zip("hi", "lo")).alias("at", "k")) \
        .where(F.substring("symbols", F.col("at") + 1, F.lit(1)).isin(*SYMBOLS[:8])) \
        .select("conv", "part", "chunk", "at", "k.hi", "k.lo")  # one of each text and task
    order = Window.partitionBy("conv", "hi", "lo").orderBy("part")
    return first.withColumn("n", F.row_number().over(order)).where("n > 1").groupBy("part", "chunk").agg(F.collect_list("at").alias("later"))


def _marked(symbols: Column, later: Column) -> Column:
    """Symbols with the rows at ``later`` as duplicates."""
    own = {f: SYMBOLS[4 * f:4 * f + 4] for f in range(4)}
    again = F.aggregate(later, symbols, lambda s, at: F.overlay(s, F.translate(F.substring(s, at + 1, F.lit(1)), own[0] + own[1], own[3] * 2), at + 1, F.lit(1)))
    return F.when(later.isNotNull(), again).otherwise(symbols)


# along conversations


def _measured(rules: list[tuple[str, str]]) -> Callable:
    """The costs of each chunk's matrix (-1: none) and, for each first state, the order of its audits."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            costs, orders = [], []
            for symbols in batch["symbols"].to_pylist():
                found = grammar.matrix(symbols) if symbols else EMPTY
                costs.append([f[0] if f else -1 for f in found])
                order = [0] * 16
                for i in range(0, 16, 4):
                    there = {j: "".join(letters(found[i + j][1])) for j in range(4) if found[i + j]}
                    for n, j in enumerate(sorted(there, key=there.get)):
                        order[i + j] = n
                orders.append(order)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("conv", "part", "chunk")), pa.array(costs, pa.list_(pa.int64())), pa.array(orders, pa.list_(pa.int32()))],
                                             names=["conv", "part", "chunk", "costs", "orders"])
    return measure


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over chunks in order: the states at which the cheapest repair enters and leaves each chunk."""
    conv, any_row = None, False
    cost: list = []
    rank: list = []  # order of the audits so far, by the state they end in
    back, at = array("b"), array("i")

    def step(costs: list[int], orders: list[int]) -> None:
        nonlocal cost, rank
        best = []  # (cost, rank, from state) for each state; audits of equal cost differ before the chunk, or come from one state
        for j in range(4):
            best.append(min(((cost[i] + costs[4 * i + j], rank[i], i) for i in range(4) if cost[i] is not None and costs[4 * i + j] >= 0), default=None))
        places = sorted((b[1], orders[4 * b[2] + j], j) for j, b in enumerate(best) if b)
        cost, rank = [b[0] if b else None for b in best], [0] * 4
        for n, (_, _, j) in enumerate(places):
            rank[j] = n
        back.extend(b[2] if b else -1 for b in best)

    def ended() -> pa.RecordBatch:
        end = min((cost[j] + INSERT * len(ENDING[j]), rank[j], j) for j in range(4) if cost[j] is not None)
        n, state = len(at) // 2, end[2]
        starts, ends = array("i", [0]) * n, array("i", [0]) * n
        for t in range(n - 1, -1, -1):
            ends[t], state = state, back[4 * t + state]
            starts[t] = state
        columns = {"part": at[::2], "chunk": at[1::2], "start": starts, "end": ends}
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int32()) for c, v in columns.items()} | {"cost": pa.array([end[0]] * n, pa.int64())})

    done: list[pa.RecordBatch] = []
    for batch in batches:
        for own, part, chunk, costs, orders in zip(*(batch[c].to_pylist() for c in ("conv", "part", "chunk", "costs", "orders"))):
            if not any_row or own != conv:
                if any_row:
                    done.append(ended())
                conv, any_row = own, True
                cost, rank, back, at = [0, None, None, None], [0] * 4, array("b"), array("i")
            step(costs, orders)
            at.extend((part, chunk))
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if any_row:
        yield ended()


def _audits(rules: list[tuple[str, str]]) -> Callable:
    """Adds the audit of each chunk between its states."""
    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            found = [grammar.audit(*x) for x in zip(*(batch[c].to_pylist() for c in ("symbols", "start", "end")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "audit"])
    return audits


class _Replay:
    """One conversation, chunk after chunk."""

    def __init__(self, conv):
        self.conv, self.state, self.last, self.turns, self.low, self.high = conv, START, "", 0, None, None
        self.count, self.illegal, self.audit, self.place = Counter(), 0, [], 0

    def chunk(self, row: dict, path: dict) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the repaired rows."""
        for s in path["symbols"]:
            fault, initial = divmod(SYMBOLS.index(s), 4)
            self.count[FAULTS[fault]] += 1
            self.illegal += self.last != "" and self.last + INITIALS[initial] not in LEGAL
            self.last = INITIALS[initial]
        if row["first_turn"] is not None:
            self.turns += row["n_turns"] - (row["first_turn"] == self.high)
            self.low, self.high = row["first_turn"] if self.low is None else self.low, row["last_turn"]
        at, state = 0, path["start"]
        self.audit.append(path["audit"])
        for letter in path["audit"]:
            if letter == "K":
                state = NEXT[state][row["roles"][at][0]]
                yield letter, row["roles"][at], row["texts"][at]
            elif letter in "RI":
                c = next(c for c in "ua" if c in NEXT[state])
                state = NEXT[state][c]
                yield letter, NAMES[c], row["texts"][at] if letter == "R" else ""
            at += letter != "I"
        self.state = path["end"]

    def ending(self) -> Iterator[tuple[str, str, str]]:
        for c in ENDING[self.state]:
            self.audit.append("I")
            yield "I", NAMES[c], ""

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


_SUMMARY = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
            ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_TURNS = [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def _replayed(turns: bool) -> Callable:
    """Over paths and chunks in order: a row for each conversation, or for each repaired turn."""
    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, schema = None, None
        path: dict = {}
        digest, first, out, size = hashlib.sha256(), True, [], 0

        def take(steps: Iterator[tuple[str, str, str]]) -> None:
            nonlocal first, size
            for edit, role, text in steps:
                if turns:
                    out.append({"conv": one.conv, "place": one.place, "edit": edit, "role": role, "text": text})
                    one.place, size = one.place + 1, size + len(text)
                else:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False

        def ended() -> None:
            take(one.ending())
            if not turns:
                out.append({"conv": one.conv, "gaps": one.gaps(), **{f: one.count[f] for f in ("blank", "duplicate", "truncated")},
                            "illegal": one.illegal, "cost": path["cost"], "audit": "".join(one.audit), "repaired_sha256": digest.hexdigest()})

        def flushed() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return rows

        for batch in batches:
            if schema is None:
                schema = pa.schema([("conv", batch.schema.field("conv").type), *(_TURNS if turns else _SUMMARY)])
            for at in range(batch.num_rows):
                row = {c: batch[c][at].as_py() for c in batch.schema.names}
                if row["wide"]:
                    take(one.chunk(row, path))
                else:
                    if one is None or one.conv != row["conv"]:
                        if one is not None:
                            ended()
                        one, digest, first = _Replay(row["conv"]), hashlib.sha256(), True
                    path = row
                if size > 1 << 22:
                    yield flushed()
                    size = 0
            if out:
                yield flushed()
        if one is not None:
            ended()
            if out:
                yield flushed()
    return replay


class Repair:
    """Conversations with their cheapest repair. ``rows``: conv, turn, role, text and copies, how often the row stands there; a row of
    0 copies only names its conversation."""

    def __init__(self, rows: DataFrame, rules: int = RULES, chunk_rows: int = ROWS):
        scratch = Scratch(rows.sparkSession, "conversations")
        self.kind = rows.schema["conv"].dataType
        spread = rows.select("conv", F.col("turn").cast("long").alias("turn"), F.coalesce(F.when(F.col("copies") > 0, F.col("role")), F.lit(" ")).alias("role"),
                             F.coalesce(F.when(F.col("copies") > 0, F.col("text")), F.lit(" ")).alias("text"), F.col("copies").cast("int").alias("copies")) \
            .withColumn("hi", F.xxhash64("role", "text")).withColumn("lo", F.xxhash64("text", F.lit(1), "role")).withColumn("source", F.spark_partition_id())
        ordered = spread.repartitionByRange("conv", "turn", "hi", "lo", "source").sortWithinPartitions("conv", "turn", "hi", "lo")
        chunk = T.StructType([T.StructField("conv", self.kind), *T._parse_datatype_string(_CHUNK).fields])
        self.chunks = scratch.keep(ordered.mapInArrow(lambda batches: _chunked(batches, chunk_rows), chunk), "chunks")
        marked = scratch.keep(self.chunks.select("conv", "part", "chunk", "symbols").join(_later(self.chunks), ["part", "chunk"], "left")
                              .select("conv", "part", "chunk", _marked(F.col("symbols"), F.col("later")).alias("symbols")), "marked")
        distinct = scratch.keep(marked.where("symbols <> ''").select("symbols").distinct(), "distinct")
        self.rules = repair_pairs(distinct, rules)

        def typed(columns: str) -> T.StructType:
            return T.StructType([T.StructField("conv", self.kind), *T._parse_datatype_string(columns).fields])
        self.typed = typed
        measured = marked.select("conv", "part", "chunk", "symbols").mapInArrow(_measured(self.rules), typed("part int, chunk int, costs array<long>, orders array<int>"))
        paths = scratch.keep(measured.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
                             .mapInArrow(_paths, "part int, chunk int, start int, end int, cost long"), "paths")
        self.audits = scratch.keep(marked.join(paths, ["part", "chunk"]).select("conv", "part", "chunk", "symbols", "start", "end", "cost").mapInArrow(
            _audits(self.rules), typed("part int, chunk int, symbols string, start int, end int, cost long, audit string")), "audits")

    def _replay(self, turns: bool) -> DataFrame:
        wide = self.chunks.drop("hi", "lo", "symbols").withColumn("wide", F.lit(True))
        every = self.audits.withColumn("wide", F.lit(False)).unionByName(wide, True)
        kinds = {pa.int64(): "long", pa.string(): "string"}
        schema = self.typed(", ".join(f"{c} {kinds[k]}" for c, k in (_TURNS if turns else _SUMMARY)))
        return every.repartition("conv").sortWithinPartitions("conv", "part", "chunk", "wide").mapInArrow(_replayed(turns), schema)

    def summary(self) -> DataFrame:
        """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        return self._replay(False)

    def turns(self) -> DataFrame:
        """The repaired conversations: conv, place, edit (K, R or I), role, text."""
        return self._replay(True)


def as_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    return turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"),
                        F.col(f"`{text}`").alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """Test damage, by a checksum of conversation and turn: dropped, emptied, without ends of sentences, repeated, or said by the user."""
    rows = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    k = F.pmod(F.crc32(named), F.lit(20))
    return rows.withColumn("k", k).select(
        "conv", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("k") == 0, 0).when(F.col("k") == 3, 2).otherwise(1).alias("copies"))


def report(turns: DataFrame) -> DataFrame:
    """What repairing the damaged table takes, per conversation."""
    return Repair(damaged(as_rows(turns))).summary().withColumnRenamed("conv", "conv_id")
