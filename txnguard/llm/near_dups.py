"""MinHash near-duplicates by tensored banding.

1. One Arrow pass turns each text into the set of its word shingles (64-bit hashes), the set's size and 128-bit digest, and
   ``COLLECTIONS`` short collections of ``WIDTH`` minhashes each. Texts with equal sets are one class, merged by a partial
   aggregate, so thousands of copies become one row. Stored classes are numbered; the number is their node.
2. Table keys are pairs of collections: c collections give c(c-1)/2 tables, so the minhashes needed grow with the square root
   of the tables. A pair of classes is a candidate if any two of its collections agree.
3. Links are confirmed on full sets: 100 * intersection >= 80 * union. First each class meets the smallest node of every key it
   has. Where members of a key are still in different components, the components joined by such keys form groups, indexed
   by rare shingles: in an order that puts shingles of one component first and then the rarer ones, two linked sets share one of
   their first n - ceil(0.8 n) + 1 shingles, so only holders of such a shingle can be linked, and boilerplate pages with
   text of their own have none. Each list of holders names one of them, the others meet it, and it leaves the list; lists within
   one component go. When a round no longer halves the lists, what remains is dealt into blocks of about ``BLOCK`` nodes;
   two blocks meet in one task, which counts intersections as a matrix product and returns linked components.
4. Components by alternating large and small stars, in stored tables.

A text with fewer words than a shingle has one shingle, its whole word sequence. Null texts and texts without words have an
empty set and link with nothing, not even with each other. Rows with a null id are linked with nothing and kept, with a null
component. Rows that repeat an id are documents of their own that share it. Only A-Z are lower-cased. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnguard.llm.common import Scratch, small_batches
from txnguard.operators.joins import lookup_join

COLLECTIONS = 14
WIDTH = 3
SIMILARITY = 80  # per cent
BLOCK = 512  # nodes of a block
TABLES = list(combinations(range(COLLECTIONS), 2))
STRIP = 1 << 21  # bytes hashed at a time

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.uint64(int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1)
_BACK = np.uint64(pow(int(_PLACE), -1, 1 << 64))
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _rng.integers(1, 1 << 63, COLLECTIONS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, COLLECTIONS * WIDTH, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the place factor and of its inverse, kept up to a strip's length."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _PLACE), ("down", _BACK)):
            steps = np.full(max(n, 4096), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for each word of one text. Words are runs of bytes that are not white space."""
    out = []
    at = 0
    while at < len(data):
        stop = min(at + STRIP, len(data))
        while stop < len(data) and not _SPACE[data[stop]]:  # a strip ends at the end of a word
            more = np.flatnonzero(_SPACE[data[stop:stop + STRIP]])
            stop = stop + int(more[0]) if len(more) else min(stop + STRIP, len(data))
        piece = data[at:stop]
        at = stop
        gap = np.concatenate([[True], _SPACE[piece], [True]])
        first = np.flatnonzero(gap[:-1] & ~gap[1:])
        if not len(first):
            continue
        last = np.flatnonzero(~gap[:-1] & gap[1:])
        up, down = _power(len(piece))
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[piece]] * up)])
        out.append(_mix((running[last] - running[first]) * down[first] + (last - first).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(data: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    w = word_hashes(data)
    if not len(w):
        return w
    size = min(words, len(w))
    n = len(w) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += w[i:i + n] * _STEP[i % 64]
    return np.unique(_mix(total))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[at:at + 4096, None] * _A + _B).min(0))
    return low


def _texts(column: pa.Array):
    """The bytes of each text, None for null."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for i, ok in enumerate(column.is_valid().to_numpy(zero_copy_only=False)):
        yield whole[starts[i]:starts[i + 1]] if ok else whole[:0]


def _digest(shingles: np.ndarray) -> bytes | None:
    """A class: the same 128 bits for equal sets."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def sketch_column(text: Column, words: int) -> Column:
    """(digest, n, collections) of each text; no digest without words."""
    kind = pa.struct([("digest", pa.binary()), ("n", pa.int64()), ("collections", pa.list_(pa.int64()))])

    def sketches(texts: pa.Array) -> pa.Array:
        out = []
        for data in _texts(texts):
            s = shingle_set(data, words)
            low = (minhashes(s).reshape(COLLECTIONS, WIDTH) * _STEP[:WIDTH]).sum(1, dtype=np.uint64) if len(s) else None
            out.append((_digest(s), len(s), None if low is None else _mix(low).view(np.int64)))
        return pa.array(out, type=kind)

    return F.arrow_udf(sketches, "digest binary, n long, collections array<long>")(text)


def set_column(text: Column, words: int) -> Column:
    """(digest, s) of each text, s its sorted shingle hashes."""
    kind = pa.struct([("digest", pa.binary()), ("s", pa.list_(pa.int64()))])

    def sets(texts: pa.Array) -> pa.Array:
        found = [shingle_set(data, words) for data in _texts(texts)]
        return pa.array([(_digest(s), s.view(np.int64)) for s in found], type=kind)

    return F.arrow_udf(sets, "digest binary, s array<long>")(text)


def _table_keys(classes: DataFrame) -> DataFrame:
    """One row for each class and pair of collections."""
    c = F.col("collections")
    keys = [F.xxhash64(F.lit(t), c[i], c[j]) for t, (i, j) in enumerate(TABLES)]
    return classes.select("node", "n", F.explode(F.array(*keys)).alias("key"))


def _close_sizes(a: str, b: str) -> Column:
    """Sets whose sizes alone rule out the similarity are never compared."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node."""
    edges = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while _unfinished(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.keep(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = scratch.keep(small, "small")
        scratch.drop(edges, large)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _unfinished(edges: DataFrame) -> bool:
    """Has any node two smaller ones, or one smaller and one larger?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1")
    return not odd.isEmpty()


def links(docs: DataFrame, classes: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """(node, component) of linked classes. ``docs``: id, text; ``classes``, stored: node, digest, id, n, collections."""
    keyed = _table_keys(classes)
    shared = keyed.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count("*").alias("members")) \
        .where("head <> last").select("key", "head", "members")
    members = scratch.keep(keyed.join(shared, "key"), "members")
    sizes = classes.select(F.col("node").alias("head"), F.col("n").alias("head_n"))
    heads = scratch.keep(members.where("node <> head").groupBy("head", "node").agg(F.first("n").alias("n")).join(sizes, "head")
                         .where(_close_sizes("n", "head_n")).select(F.col("head").alias("a"), F.col("node").alias("b")), "heads")

    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("id", "node", F.col("digest").alias("own"))
    sets = docs.join(wanted, "id").select("node", "own", F.explode(F.array(set_column(F.col("text"), words))).alias("k")) \
        .where("k.digest = own").select("node", "k.s")
    if docs.groupBy("id").count().where("count > 1").limit(1).count():  # an id may stand for several texts
        sets = sets.dropDuplicates(["node"])
    sets = scratch.keep(sets, "sets")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        """The linked ones of ``pairs`` (a, b)."""
        left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
        right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        return scratch.keep(pairs.join(left, "a").join(right, "b")
                            .select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb") - both).alias("either"))
                            .where(F.col("both") * 100 >= F.col("either") * SIMILARITY).select("a", "b"), label)

    found = scratch.keep(components(confirmed(heads, "confirmed"), scratch), "found")

    # keys whose members are still apart: the components they join form groups
    apart = members.join(found.withColumnRenamed("component", "c"), "node", "left").select("key", "node", F.coalesce("c", "node").alias("c"))
    still = apart.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("members")).where("c1 <> c2 AND members > 2")
    apart = scratch.keep(apart.join(still.select("key", "c1"), "key").groupBy("node", "c", "c1").agg(F.lit(1).alias("x")).drop("x"), "apart")
    if apart.isEmpty():
        return found
    groups = components(apart.select(F.col("c1").alias("a"), F.col("c").alias("b")), scratch).select(F.col("node").alias("c"), F.col("component").alias("grp"))
    nodes = scratch.keep(apart.select("node", "c").distinct().join(groups, "c"), "nodes")

    lists = scratch.keep(_rare_lists(nodes.join(sets, "node"), scratch), "lists")
    rows, turn = lists.count(), 0
    while rows:
        head = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "c", "n")
        named = lists.groupBy("grp", "item").agg(F.min(head).alias("head"))
        named = scratch.keep(named.select("grp", "item", F.col("head.node").alias("head"), F.col("head.c").alias("head_c"), F.col("head.n").alias("head_n")), "named")
        met = lookup_join(lists, named, ["grp", "item"], "inner", ["node"])
        pairs = met.where("c <> head_c").where(_close_sizes("n", "head_n")).groupBy("head", "node").agg(F.lit(1).alias("x")) \
            .select(F.col("head").alias("a"), F.col("node").alias("b"))
        new = confirmed(pairs, "linked")
        rest = met.where("node <> head").select("grp", "item", "node", "n", "c")
        if not new.isEmpty():
            found = scratch.keep(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new), scratch), "found")
            rest = rest.drop("c").join(found.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
        rest = scratch.keep(rest, "rest")
        lists = scratch.keep(_across(rest, scratch), "lists")
        before, rows, turn = rows, lists.count(), turn + 1
        if rows * 2 > before:
            break
    if not rows:
        return found

    # lists that fall too slowly: their holders meet block by block, in groups that share no list
    ends = lists.groupBy("grp", "item").agg(F.min("node").alias("least"))
    tied = lookup_join(lists, scratch.keep(ends, "ends"), ["grp", "item"], "inner", ["node"])
    groups = components(tied.select(F.col("least").alias("a"), F.col("node").alias("b")), scratch).withColumnRenamed("component", "grp")
    nodes = scratch.keep(lists.select("node", "c").distinct().join(groups, "node"), "nodes")
    blocks = nodes.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = lookup_join(nodes, blocks, ["grp"], "inner", ["node"]).join(sets, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    third = dealt.select("grp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "c", "s") \
        .groupBy("grp", "p", "q").applyInArrow(_block_links, "a long, b long")
    third = scratch.keep(third, "third")
    if third.isEmpty():
        return found
    # components of components
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(third), scratch)


def _across(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows (grp, item, node, n, c) of items whose holders are in several components."""
    spans = rows.groupBy("grp", "item").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("times"))
    spans = scratch.keep(spans.where("c1 <> c2").select("grp", "item", "times"), "spans")
    return lookup_join(rows, spans, ["grp", "item"], "inner", ["node"])


def _rare_lists(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, item, node, n, c): the shingles of which two linked sets of different components share at least one.

    Sets with 100 * both >= 80 * either share ceil(0.8 n) of the n shingles of either, so in any one order of a group's shingles
    one is among the first n - ceil(0.8 n) + 1. Those of one component come first; they are in no two components' sets.
    """
    items = scratch.keep(nodes.select("grp", "node", "c", F.size("s").alias("n"), F.explode("s").alias("item")), "items")
    held = F.sort_array(F.collect_list(F.struct("times", "item")))
    kept = _across(items, scratch).groupBy("grp", "node").agg(F.first("n").alias("n"), F.first("c").alias("c"), held.alias("held"))
    spare = (F.size("held") - F.ceil(F.col("n") * SIMILARITY / 100) + 1).cast("int")
    return kept.withColumn("spare", spare).where("spare > 0") \
        .select("grp", "node", "n", "c", F.explode(F.slice("held", F.lit(1), F.col("spare"))).alias("h")) \
        .select("grp", F.col("h.item").alias("item"), "node", "n", "c")


def _block_links(key: tuple, rows: pa.Table) -> pa.Table:
    """The pairs of components that are linked between two blocks, confirmed on full sets."""
    own, comp = (rows[c].to_numpy() for c in ("own", "c"))
    column = rows["s"].combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    place = np.repeat(np.arange(len(size)), size)
    values, at, times = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)  # a shingle that only one has is in no intersection
    column_of = np.full(len(values), -1)
    column_of[shared] = np.arange(len(shared))
    at = column_of[at]
    order = np.argsort(at, kind="stable")
    order = order[at[order] >= 0]
    at, place = at[order], place[order]
    left, right = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
    both = np.zeros((len(left), len(right)), np.float32)  # counts below 2**24 are exact
    for low in range(0, len(shared), 4096):
        cut = slice(*np.searchsorted(at, [low, low + 4096]))
        has = np.zeros((len(size), min(4096, len(shared) - low)), np.float32)
        has[place[cut], at[cut] - low] = 1
        both += has[left] @ has[right].T
    i, j = np.nonzero((both * 100 >= (size[left][:, None] + size[right][None, :] - both) * SIMILARITY)
                      & (comp[left][:, None] != comp[right][None, :]))
    i, j = left[i], right[j]
    pairs = np.sort(np.stack([comp[i], comp[j]], 1), axis=1)
    pairs = np.unique(pairs, axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def near_duplicates(docs: DataFrame, words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-dups", estimates=False)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sketch = scratch.keep(own.select("id", sketch_column(F.col("text"), words).alias("k")).select("id", "k.*"), "sketch")
    usable = sketch.where("digest IS NOT NULL AND id IS NOT NULL")
    classes = usable.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("collections").alias("collections"))
    classes = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    found = links(own.where("id IS NOT NULL"), classes, words, scratch)
    named = classes.select("node", "digest", F.col("id").alias("least"), "copies").join(found, "node", "left")
    lone = named.where("component IS NULL AND copies > 1").select("digest", F.col("least").alias("component_id"))
    linked = named.where("component IS NOT NULL")
    linked = linked.join(linked.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("digest", "component_id")
    return sketch.join(lone.unionByName(linked), "digest", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")) \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"), words=4)


REPORT_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
sorted AS (SELECT doc_id, list_sort(s) AS s FROM sets),
classes AS (SELECT s, min(doc_id) AS node, any_value(len(s)) AS n FROM sorted WHERE len(s) > 0 GROUP BY s),
items AS (SELECT node, n, unnest(s) AS item FROM classes),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.item = b.item AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
walk(node, reached) AS (SELECT node, node FROM classes UNION SELECT walk.node, edges.b FROM walk JOIN edges ON walk.reached = edges.a),
least AS (SELECT node, min(reached) AS component FROM walk GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM sorted LEFT JOIN classes USING (s) LEFT JOIN least USING (node)"""
