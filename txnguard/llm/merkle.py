"""A Merkle manifest of a table by slot pivots, with the proof of every row.

A row's leaf is the digest of its fields. Within a group the leaves stand in order of key; while there are several nodes, every three
consecutive ones (the last run has what is left) become the digest of their concatenation, up to the group's root. The groups' roots,
in order of group (null first, by bytes), make the root of the table in the same way.

1. Leaves are worked out in one scan, stored without their texts, and numbered: range-partitioned by group, key and leaf, so a group
   of any size spans tasks, with one offset for each group and task. Rows equal in all of these are spread by their input partition.
2. Slot pivot: conditional aggregates spread ``SLOTS`` consecutive nodes of a group into as many columns of one row. Concatenating three
   columns gives a digest of the next level, three of those one of the level above, and three of those the node that goes on:
   a shuffle for three levels, of a 27th of the rows each time.
3. Back down, a node's siblings are its run's columns without its own slot, what stands left and right of it apart. The
   siblings of the levels above come by a join on (group, block), so a proof grows from the leaf to the root, in this order.

A null field counts as ``-``. Null keys come first; rows of equal key stand in order of leaf, and equal rows each have a proof. An
empty table has no rows and no root. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import Scratch

FANOUT = 3
SLOTS = FANOUT ** 3  # nodes of a block, which holds three levels
ROW_BITS = 33  # of monotonically_increasing_id within a partition

_STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as its length in bytes and its text, so that no two rows concatenate alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """Adds idx, the place within ``grp`` in this order, and n, the rows of ``grp``. Places are spread over tasks; a group has one
    offset for each task."""
    placed = rows.withColumn("input", F.spark_partition_id()).repartitionByRange("grp", *order, "input").sortWithinPartitions("grp", *order)
    placed = scratch.keep(placed.drop("input").withColumn("at", F.monotonically_increasing_id()).withColumn("task", F.shiftright("at", ROW_BITS)), "placed")
    runs = placed.groupBy("grp", "task").agg(F.min("at").alias("low"), F.count("*").alias("own"))
    tasks = Window.partitionBy("grp").orderBy("task")
    whole = Window.partitionBy("grp")
    runs = runs.select("grp", "task", (F.sum("own").over(tasks) - F.col("own") - F.col("low")).alias("offset"), F.sum("own").over(whole).alias("n"))
    return placed.join(runs, ["grp", "task"]).withColumn("idx", F.col("at") + F.col("offset")).drop("at", "offset", "task")


def _parents(level: str, size: int) -> Column:
    """Digests of every three consecutive nodes of an array of ``size``; null where there are none."""
    return F.array(*[F.when(F.col(level)[i].isNotNull(), digest(*[F.coalesce(F.col(level)[i + k], F.lit("")) for k in range(FANOUT)]))
                     for i in range(0, size, FANOUT)])


def _blocks(nodes: DataFrame) -> DataFrame:
    """The pivot: one row for each block, with its node columns as an array, its two inner levels, and its own node."""
    slot = F.col("idx") % SLOTS
    spread = nodes.groupBy("grp", F.floor(F.col("idx") / SLOTS).alias("block"), "n").agg(
        *[F.max(F.when(slot == k, F.struct("node", "payload"))).alias(f"slot{k}") for k in range(SLOTS)])
    slots = F.array(*[f"slot{k}" for k in range(SLOTS)])
    out = spread.select("grp", "block", "n", F.transform(slots, lambda s: s["node"]).alias("l0"), F.transform(slots, lambda s: s["payload"]).alias("payloads"))
    out = out.withColumn("l1", _parents("l0", SLOTS)).withColumn("l2", _parents("l1", SLOTS // FANOUT)).withColumn("l3", _parents("l2", FANOUT))
    # a group that ends here goes no further than its root
    height = F.when(F.col("n") > 9, 3).when(F.col("n") > 3, 2).when(F.col("n") > 1, 1).otherwise(0)
    return out.withColumn("height", height).withColumn("node", F.element_at(F.array(F.col("l0")[0], F.col("l1")[0], F.col("l2")[0], F.col("l3")[0]), F.col("height") + 1)).drop("l3")


class Tree:
    """The trees of all groups. ``nodes``: grp, idx, n, node and payload of their leaves."""

    def __init__(self, nodes: DataFrame, scratch: Scratch):
        self.scratch, self.passes = scratch, []
        while True:
            block = scratch.keep(_blocks(nodes), "blocks")
            self.passes.append(block)
            more = block.where(F.col("n") > SLOTS)
            if more.isEmpty():
                break
            nodes = more.select("grp", F.col("block").alias("idx"), F.ceil(F.col("n") / SLOTS).alias("n"), "node", F.lit(None).cast("string").alias("payload"))
        done = [b.where(F.col("n") <= SLOTS).select("grp", "node") for b in self.passes]
        self.roots = scratch.keep(_all(done), "roots")

    def proofs(self, tops: DataFrame) -> DataFrame:
        """grp, idx, node, payload, steps and carried of every leaf. ``tops``: grp, the steps above its root, and a value to carry down."""
        below = None
        for i in reversed(range(len(self.passes))):
            block = self.passes[i]
            above = block.where(F.col("n") <= SLOTS).join(tops, "grp")
            if below is not None:
                upper = below.select("grp", F.col("idx").alias("block"), "steps", "carried")
                above = above.unionByName(block.where(F.col("n") > SLOTS).join(upper, ["grp", "block"]), True)
            below = above.select("*", F.posexplode("l0").alias("slot", "own")).where("own IS NOT NULL").select(
                "grp", (F.col("block") * SLOTS + F.col("slot")).alias("idx"), F.col("own").alias("node"), F.col("payloads")[F.col("slot")].alias("payload"),
                F.concat(F.slice(_siblings(), F.lit(1), F.col("height")), F.col("steps")).alias("steps"), "carried")
            if i:
                below = self.scratch.keep(below.drop("payload"), "down")
        return below


def _siblings() -> Column:
    """Of the node at ``slot``, for each level of its block: its run's other columns, those before it and those after."""
    out, at = [], F.col("slot")
    for level in ("l0", "l1", "l2"):
        place, nodes = (at % FANOUT).cast("int"), F.col(level)
        first = (at - place).cast("int")
        out.append(F.struct(F.array_join(F.slice(nodes, first + 1, place), "").alias("before"),
                            F.array_join(F.slice(nodes, first + place + 2, FANOUT - 1 - place), "").alias("after")))
        at = F.floor(at / FANOUT)
    return F.array(*out)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda now, s: digest(s["before"], now, s["after"]))


def manifest(rows: DataFrame) -> DataFrame:
    """``rows``: grp (a struct, so that null is a value), key, leaf and payload. Gives grp, payload, leaf, subroot, root and steps, the
    siblings before and after each node from the leaf up; ``folded(leaf, steps)`` is the root."""
    scratch = Scratch(rows.sparkSession, "merkle")
    leaves = scratch.keep(rows, "leaves")
    nodes = numbered(leaves, ["key", "leaf"], scratch).select("grp", "idx", "n", F.col("leaf").alias("node"), "payload")
    groups = Tree(nodes, scratch)
    table = F.struct(F.lit(0).alias("all")).alias("grp")
    upper = numbered(groups.roots.select(table, F.col("grp").alias("key"), F.col("node").alias("leaf")), ["key"], scratch)
    top = Tree(upper.select("grp", "idx", "n", F.col("leaf").alias("node"), F.col("key").alias("payload")), scratch)
    start = top.roots.select("grp", F.array().cast(_STEPS).alias("steps"), F.col("node").alias("carried"))
    tops = scratch.keep(top.proofs(start).select(F.col("payload").alias("grp"), "steps", F.struct(F.col("node").alias("subroot"), F.col("carried").alias("root")).alias("carried")), "tops")
    return groups.proofs(tops).select("grp", "payload", F.col("node").alias("leaf"), "carried.subroot", "carried.root", "steps")


def document_leaf(text: Column) -> Column:
    return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def report(docs: DataFrame) -> DataFrame:
    """Every document with its proof, and whether what a tampered copy of it folds to is the root. Half of the documents lose their line ends."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select(F.struct("source").alias("grp"), F.col("doc_id").alias("key"), document_leaf(F.col("text")).alias("leaf"),
                       F.struct("doc_id", document_leaf(tampered).alias("tampered")).alias("payload"))
    out = manifest(rows).withColumn("folded_root", folded(F.col("payload.tampered"), F.col("steps")))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), "")
    return out.select("payload.doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


_SQL_FIELDS = "||".join(f"coalesce(octet_length(encode({c}::VARCHAR))||':'||{c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))

REPORT_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, *, CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents),
leaves AS (
  SELECT r, doc_id, source, sha256({_SQL_FIELDS}||coalesce(octet_length(encode(text))||':'||text, '-')) AS leaf,
    sha256({_SQL_FIELDS}||coalesce(octet_length(encode(changed))||':'||changed, '-')) AS tampered FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree(lvl, source, idx, node, n) AS (
  SELECT 0, source, idx, leaf, n FROM placed
  UNION ALL SELECT lvl + 1, source, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY lvl, source, idx // 3, n),
subroots AS (SELECT source, node AS subroot, lvl AS height FROM tree WHERE n = 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM subroots),
top(lvl, idx, node, n) AS (
  SELECT 0, idx, subroot, n FROM ranked
  UNION ALL SELECT lvl + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
steps AS (
  SELECT p.r, t.lvl, coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx < p.idx // (3 ** t.lvl)::BIGINT), '') AS before,
    coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx > p.idx // (3 ** t.lvl)::BIGINT), '') AS after
  FROM placed p JOIN tree t ON p.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.idx // 3 = p.idx // (3 ** (t.lvl + 1))::BIGINT GROUP BY p.r, t.lvl
  UNION ALL
  SELECT p.r, s.height + t.lvl, coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx < s.idx // (3 ** t.lvl)::BIGINT), ''),
    coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (WHERE t.idx > s.idx // (3 ** t.lvl)::BIGINT), '')
  FROM placed p JOIN ranked s ON p.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n > 1 AND t.idx // 3 = s.idx // (3 ** (t.lvl + 1))::BIGINT GROUP BY p.r, s.height + t.lvl),
fold(r, lvl, now) AS (
  SELECT r, 0, tampered FROM leaves
  UNION ALL SELECT fold.r, fold.lvl + 1, sha256(before || now || after) FROM fold JOIN steps ON steps.r = fold.r AND steps.lvl = fold.lvl),
folded AS (SELECT r, arg_max(now, lvl) AS folded_root FROM fold GROUP BY r),
proofs AS (SELECT r, string_agg(before || after, '' ORDER BY lvl) AS siblings FROM steps GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN folded USING (r) LEFT JOIN proofs USING (r) JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source, (SELECT node AS root FROM top WHERE n = 1)"""
