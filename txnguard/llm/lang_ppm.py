"""Language identification by prediction by partial matching.

Each language has a variable-order context tree over the bytes of lower-cased text: for every context of up to ``ORDER``
bytes, how often each byte followed it. A byte costs -log2 of its share in the longest context that has seen it; every
longer context that is known but has not seen it adds the price of an escape (method C: distinct / (total + distinct)); below
the empty context each of the 256 byte values costs the same. The statistics are frozen after the fit, so a text's code length in each
language is exact, and the shortest wins. The score is the winner's posterior under equal priors.

Fit: every row with a language and a letter gives counts, which tasks fold by numpy and Spark sums for each order (with ``train_docs`` only
about so many rows of each language, chosen by a hash of id and text); a language's tree keeps its ``max_nodes`` most frequent entries of each order, whatever other languages hold, which
bounds the model that is broadcast. Scoring covers every byte of every text, in pieces of bounded size.

Null texts and texts without a letter get ``und`` and score 0, as does every text when there is nothing to learn from. Rows
without a language or without text teach nothing. Ties go to the alphabetically first language; repeated rows give equal
results; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnguard.llm.common import fresh, small_batches
from txnguard.operators.prefix import exact_quantiles

ORDER = 3
UNKNOWN = "und"
PIECE = 1 << 19  # bytes scored at a time
HELD = 1 << 20  # counts of a language that a task holds
#: Fixed values of the bounds: bits of a byte without a model, bytes below which a text is short, characters of a short
#: piece, and how far above the 99th of 100 training rows a text may lie.
RAW, SHORT, HEAD, MARGIN = 8.0, 64, 24, 1.5


@dataclass
class Tree:
    """Costs in bits of every known (context, byte) of a language, and of leaving every known context; rows ascend by key."""
    grams: list[np.ndarray]  # per order: keys of context + byte
    costs: list[np.ndarray]  # per order
    contexts: list[np.ndarray]  # per order: keys of contexts
    escapes: list[np.ndarray]  # per order


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Keys of the byte at each place with ``order`` bytes before it; places before the start read as line ends."""
    padded = np.concatenate([np.full(order, 10, np.uint32), data.astype(np.uint32)])
    key = np.zeros(len(data), np.uint32)
    for i in range(order + 1):
        key = (key << np.uint32(8)) | padded[i:i + len(data)]
    return key


def pieces(data: np.ndarray, starts: np.ndarray):
    """(first byte, last, keys of the grams of ``ORDER``) of runs of at most ``PIECE`` bytes; no key sees the text before its own."""
    heads = [starts[:-1][np.diff(starts) > back] + back for back in range(ORDER)]  # first bytes, which must not see the text before
    for at in range(0, len(data), PIECE):
        stop, lead = min(at + PIECE, len(data)), min(at, ORDER)
        key = grams(data[at - lead:stop], ORDER)[lead:]
        for back, places in enumerate(heads):
            here = places[(places >= at) & (places < stop)]
            piece = np.full((len(here), ORDER + 1), 10, np.uint32)
            for i in range(back + 1):
                piece[:, ORDER - i] = data[here - i]
            key[here - at] = (piece << np.array([24, 16, 8, 0], np.uint32)).sum(1, dtype=np.uint32)
        yield at, stop, key


def _folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(of, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _counts(rows):
    """Counts of each language's longest grams; a task holds at most about ``HELD`` of a language before it passes them on."""
    def out(lang, keys, n):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "key", "n"])

    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in rows:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            own = held.setdefault(lang, [])
            for _, _, key in pieces(*_buffers(batch.column("text").filter(pc.equal(langs, lang)))):
                own.append(np.unique(key, return_counts=True))
                if sum(len(k) for k, _ in own) > 2 * HELD:
                    own[:] = [_folded(own)]
                    if len(own[0][0]) > HELD:
                        yield out(lang, *own.pop())
    for lang, own in held.items():
        if own:
            yield out(lang, *_folded(own))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", train_docs: int | None = None, max_nodes: int = 400_000) -> Model:
    """Learn from the rows of ``rows`` that have a language and a letter in their text."""
    small_batches(rows.sparkSession)
    sample = _sample(rows, text, lang, train_docs)
    if sample is None:
        return Model([], [])
    longest = sample.select("lang", F.lower("text").alias("text")).mapInArrow(_counts, "lang string, key long, n long") \
        .groupBy("lang", "key").agg(F.sum("n").alias("n"))
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.col("key").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("key")) for k in range(ORDER + 1)]))
    most = Window.partitionBy("lang", "order").orderBy(F.desc("n"), "key")
    counted = longest.select("lang", "n", orders.alias("g")).groupBy("lang", "g.order", "g.key").agg(F.sum("n").alias("n")) \
        .withColumn("at", F.row_number().over(most)).where(F.col("at") <= max_nodes).select("lang", "order", "key", "n").toArrow().to_pandas(categories=["lang"])
    return build(counted, sorted(counted["lang"].unique()))


def _sample(rows: DataFrame, text: str, lang: str, train_docs: int | None) -> DataFrame | None:
    """(text, lang) of the rows to learn from, about ``train_docs`` of each language if given; None if no row has a language."""
    if train_docs is None:
        rows = rows.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
        return rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    own = [F.col("doc_id")] if "doc_id" in rows.columns else []
    rows = rows.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), F.xxhash64(*own, F.col(f"`{text}`")).alias("hash")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, train_docs / n)))])
    drawn = F.pmod("hash", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)
    return rows.where(drawn).where(F.col("text").rlike(r"\p{L}")).select("text", "lang")


def bounds(rows: DataFrame, text: str = "text", lang: str = "lang", train_docs: int | None = None) -> dict[str, tuple[float, float]]:
    """Per language, the most bits a byte of a text that fits, and of a short one: ``MARGIN`` times the 99th of 100
    training rows, and of their first ``HEAD`` characters, and at most ``RAW``. A model of one half of the rows judges the
    other half, as rows that were learned from cost less than new ones; copies share a half. Languages that are
    not in both halves are left out."""
    half = F.pmod(F.xxhash64(F.col(f"`{text}`"), F.lit(1)), F.lit(2))
    model = fit(rows.where(half == 0), text, lang, train_docs)
    sample = _sample(rows.where(half == 1), text, lang, train_docs)
    if not model.languages or sample is None:
        return {}
    parts = sample.select("lang", F.explode(F.array(F.struct(F.col("text").alias("piece"), F.lit(False).alias("short")),
                                                     F.struct(F.substring("text", 1, HEAD).alias("piece"), F.lit(True).alias("short")))).alias("p")) \
        .select("lang", "p.piece", "p.short")
    judged = predict(parts, model, "piece").where("lang = lang_pred")
    out: dict[str, list[float]] = {}
    for r in exact_quantiles(judged, "bits_per_byte", [0.99], ["lang", "short"]).collect():
        out.setdefault(r["lang"], [RAW, RAW])[r["short"]] = min(RAW, MARGIN * r["q0"])
    return {k: (v[0], v[1]) for k, v in out.items()}


def fits(text: str, limits: dict[str, tuple[float, float]]) -> Column:
    """Whether a judged row's code length is within its language's bound; without a bound, within that of raw bytes."""
    limit = F.lit(RAW)
    for name, (whole, short) in limits.items():
        limit = F.when(F.col("lang_pred") == name, F.when(F.octet_length(F.lower(f"`{text}`")) < SHORT, short).otherwise(whole)).otherwise(limit)
    return F.col("bits_per_byte") <= limit


def build(counted, languages: list[str]) -> Model:
    """Costs from the counts (lang, order, key, n) of the grams of every order."""
    parts = {k: v.sort_values("key") for k, v in counted.groupby(["lang", "order"], observed=True)}
    model = Model(languages, [])
    for lang in languages:
        tree = Tree([], [], [], [])
        for order in range(ORDER + 1):
            gram, seen = parts[lang, order]["key"].to_numpy().astype(np.uint32), parts[lang, order]["n"].to_numpy().astype(float)
            context, of = np.unique(gram >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(of, seen), np.bincount(of)
            tree.grams.append(gram)
            tree.costs.append(-np.log2(seen / (total + distinct)[of]))
            tree.contexts.append(context)
            tree.escapes.append(-np.log2(distinct / (total + distinct)))
        model.trees.append(tree)
    return model


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def _lookup(tree: Tree, keys: np.ndarray, order: int) -> np.ndarray:
    """Bits of each byte in a language, from its gram of ``order``."""
    place, hit = _find(tree.grams[order], keys)
    out = tree.costs[order][place]
    miss = np.flatnonzero(~hit)
    if len(miss):
        lost = keys[miss]
        out[miss] = _lookup(tree, lost & np.uint32((1 << 8 * order) - 1), order - 1) if order else RAW
        where, known = _find(tree.contexts[order], lost >> np.uint32(8))
        out[miss[known]] += tree.escapes[order][where[known]]
    return out


def code_lengths(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bits of each text in each language; ``data`` holds the texts' bytes, ``starts`` their offsets and the end."""
    out = np.zeros((len(starts) - 1, len(model.languages)))
    for at, stop, key in pieces(data, starts):
        found, place = np.unique(key, return_inverse=True)
        first, last = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, stop, "left")
        cut = np.clip(starts[first:last + 1], at, stop) - at
        filled = np.flatnonzero(np.diff(cut))
        for j, tree in enumerate(model.trees):
            out[first + filled, j] += np.add.reduceat(_lookup(tree, found, ORDER)[place], cut[filled])
    return out


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0]:starts[-1]], starts - starts[0]


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and bits_per_byte; columns of those names are replaced."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def judged(texts: pa.Array) -> pa.Array:
        model = shared.value
        data, starts = _buffers(texts)
        size = np.diff(starts)
        if not model.languages or not len(data):
            return pa.array([(UNKNOWN, 0.0, None)] * len(texts), type=kind)
        bits = code_lengths(model, data, starts)
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        return pa.array([(model.languages[b], float(s), float(x / n)) if n else (UNKNOWN, 0.0, None)
                         for b, s, x, n in zip(best, score, least, size)], type=kind)

    # a filter on the outcome must not be pushed below the call: it would score each text a second time, in a second worker
    judge = F.arrow_udf(judged, "lang_pred string, score double, bits_per_byte double").asNondeterministic()
    own = F.col(f"`{text}`")
    held = fresh(df, "judged")
    has_letter = F.when(own.rlike(r"\p{L}"), F.lower(own)).otherwise("")  # what has no letter is not scored
    return df.withColumn(held, judge(has_letter)).withColumns({c: F.col(f"{held}.{c}") for c in ("lang_pred", "score", "bits_per_byte")}).drop(held)


def report(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those outside the held-out third."""
    rows = docs.select("doc_id", "text", "lang", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"))
    model = fit(rows.where("NOT held_out AND doc_id IS NOT NULL"))
    return predict(rows.select("doc_id", "held_out", "text"), model).drop("text")
