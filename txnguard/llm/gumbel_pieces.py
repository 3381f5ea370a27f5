"""Sampled segmentations without replacement: Gumbel top-k by perturbed A* over the piece lattice.

A text's lattice has an edge for each vocabulary piece at each place (byte pieces where no other piece covers a character), and a
segmentation's probability is the normalised product of its pieces' weights. The vocabulary files hold merge ranks, not
probabilities, so a piece of rank r weighs 1 / (r + ``SHIFT``) to the power ``alpha``.

A text is cut into units, a run of space marks and the word after it: no piece of the vocabulary reaches from a word over a mark, so units
share no pieces, and backward sums are worked out once for each distinct unit of some hundred texts. A text's own U+2581, which is no
space, goes into byte pieces, so ids decode to the text they were made from.
The search holds regions of the set of segmentations: a fixed prefix, and the next piece not among those already taken. A
region's key is the largest Gumbel-perturbed log probability within it, drawn top-down: following the best region to its end
keeps its key and gives a segmentation, and each step on the way leaves a region of siblings with a key drawn below it. Taking regions in order of key
yields k distinct segmentations, an exact sample without replacement. The key of the (k+1)-th region is the threshold
t, and a sample of log probability f has log inclusion score log(1 - exp(-exp(f - t))); all are included (0) where the
lattice has no more than k.

A row's draws depend on its key columns and the seed alone. Null and empty texts have no samples; repeated keys repeat their draws;
other columns are kept. Texts are taken whole; memory grows with one text's length.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SHIFT = 10.0
SHARE = 400_000  # characters whose words are built together, at least
MARK = "▁"
SAMPLES = "array<struct<ids:array<int>,log_prob:double,log_inclusion:double,decodes:boolean>>"
_SAMPLES = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("log_inclusion", pa.float64()), ("decodes", pa.bool_())]))
OWN = "\udc81"  # stands for a text's own U+2581; no text holds it
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class Vocabulary:
    """Weights of the pieces, found by a 64-bit hash of their code points."""

    def __init__(self, pieces: list[str], alpha: float):
        self.weight = -alpha * np.log(np.arange(len(pieces)) + SHIFT)
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if re.fullmatch("<0x[0-9A-F]{2}>", p)}
        plain = [(p, i) for i, p in enumerate(pieces) if p and not (len(p) > 1 and re.fullmatch("<.*>", p))]
        self.longest = max((len(p) for p, _ in plain), default=1)
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1, 1 << 62, self.longest + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.lengths = np.arange(self.longest + 1, dtype=np.uint64) * self.factors[0]
        hashes = np.array([(_codes(p) * self.factors[1:len(p) + 1]).sum(dtype=np.uint64) ^ self.lengths[len(p)] for p, _ in plain], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array([i for _, i in plain], np.int64)[order]

    def fallback(self, code: int) -> list[int]:
        """Byte pieces of a character that is in no piece."""
        return [self.bytes.get(b, 0) for b in (MARK if chr(code) == OWN else chr(code)).encode(errors="replace")]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def lattice(words: list[str], vocabulary: Vocabulary) -> tuple["Views", dict[str, int]]:
    """The lattices of distinct words, and the state at which each starts. A state is a place in a word."""
    codes = _codes("".join(words))
    n, width = len(codes), vocabulary.longest
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    left = np.repeat(ends, size) - np.arange(n)  # characters from here to the end of the word
    weight, ids, run = np.full((n, width), -np.inf), np.zeros((n, width), np.int64), np.zeros(n, np.uint64)
    for length in range(1, width + 1):
        at = np.flatnonzero(left >= length)
        if not len(at):
            break
        run[at] += codes[at + length - 1] * vocabulary.factors[length]
        seek = run[at] ^ vocabulary.lengths[length]
        place = np.minimum(np.searchsorted(vocabulary.hashes, seek), len(vocabulary.hashes) - 1)
        hit = np.flatnonzero(vocabulary.hashes[place] == seek)
        found = vocabulary.ids[place[hit]]
        ids[at[hit], length - 1], weight[at[hit], length - 1] = found, vocabulary.weight[found]
    bare = np.flatnonzero(np.isinf(weight[:, 0]))
    for code in np.unique(codes[bare]).tolist():
        rows = bare[codes[bare] == code]
        weight[rows, 0], ids[rows, 0] = vocabulary.weight[vocabulary.fallback(code)].sum(), -1 - code
    ahead = np.zeros(n + width + 1)
    by_left = np.argsort(left, kind="stable")
    cuts = np.searchsorted(left[by_left], np.arange(1, int(left.max(initial=0)) + 2))
    for d in range(1, len(cuts)):  # from the ends of the words backwards
        rows, m = by_left[cuts[d - 1]:cuts[d]], min(d, width)
        rest = ahead[rows[:, None] + np.arange(1, m + 1)]
        if m == d:
            rest[:, d - 1] = 0.0
        options = weight[rows, :m] + rest
        top = options.max(1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(options - top).sum(1))
        weight[rows, :m], ahead[rows] = options - total[:, None], total
    there = ~np.isinf(weight)
    state, length = np.nonzero(there)
    start = np.concatenate([[0], np.cumsum(there.sum(1))])
    cdf = np.minimum(np.cumsum(np.exp(weight), axis=1)[there], 1.0) + state
    cdf[start[1:] - 1] = np.arange(n) + 1.0
    after = np.where(left[state] > length + 1, state + length + 1, -1)
    return Views(start, cdf, np.minimum(weight[there], 0.0), after, ids[there], vocabulary), dict(zip(words, (ends - size).tolist()))


@dataclass
class Views:
    """The options of state s are those from start[s] to start[s + 1]; ``cdf`` is s plus the running probability, so it ascends
    throughout and one binary search draws for many states."""
    start: np.ndarray
    cdf: np.ndarray
    log_p: np.ndarray
    after: np.ndarray
    option_ids: np.ndarray
    vocabulary: Vocabulary

    def pieces(self, path: np.ndarray) -> list[int]:
        ids = self.option_ids[path]
        if (ids >= 0).all():
            return ids.tolist()
        return [i for o in ids.tolist() for i in ([o] if o >= 0 else self.vocabulary.fallback(-1 - o))]

    def follow(self, states: np.ndarray, words: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        """(word, state, option) of every step from the given states to the ends of their words, in order of the text."""
        found = []
        while len(states):
            pick = np.searchsorted(self.cdf, states + rng.random(len(states)), "right")
            pick = np.minimum(pick, self.start[states + 1] - 1)
            found.append((words, states, pick))
            states = self.after[pick]
            on = states >= 0
            states, words = states[on], words[on]
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        whole = [np.concatenate(c) for c in zip(*found)]
        order = np.argsort(whole[0], kind="stable")  # rounds keep their order within a word
        return tuple(c[order] for c in whole)


def words_of(text: str) -> list[str]:
    return _WORD.findall(MARK + text.replace(MARK, OWN).replace(" ", MARK))


def sample(firsts: np.ndarray, views: Views, k: int, rng: np.random.Generator) -> list[tuple[np.ndarray, float, float]]:
    """k distinct segmentations (all, if fewer) as (options, log probability, log inclusion score), best key first.
    ``firsts``: the states at which the text's words start."""
    everything = np.arange(len(firsts))
    serial, out = 0, []
    # a region: (-key, serial, options so far, their log probability, word, state, options taken at it)
    regions = [(math.log(rng.standard_exponential()), 0, np.zeros(0, np.int64), 0.0, 0, int(firsts[0]), ())]
    while regions and len(out) < k:
        low, _, prefix, base, word, state, taken = heapq.heappop(regions)
        key = -low
        if taken:
            rest = [o for o in range(views.start[state], views.start[state + 1]) if o not in taken]
            chances = np.exp(views.log_p[rest])
            pick = rest[min(int(np.searchsorted(np.cumsum(chances), rng.random() * chances.sum(), "right")), len(rest) - 1)]
            if len(rest) > 1:
                level = base + math.log(max(chances.sum() - math.exp(views.log_p[pick]), 1e-300))
                serial += 1
                heapq.heappush(regions, (float(_below(key, np.array([level]), rng)[0]), serial, prefix, base, word, state, (*taken, pick)))
            prefix, base = np.append(prefix, pick), base + views.log_p[pick]
            state, word = views.after[pick], word + 1
            ahead = (np.append(state, firsts[word:]), np.append(word - 1, everything[word:])) if state >= 0 else (firsts[word:], everything[word:])
        else:
            ahead = firsts, everything
        words, states, picks = views.follow(*ahead, rng)
        log_p = views.log_p[picks]
        total = base + np.cumsum(log_p)
        out.append((np.concatenate([prefix, picks]), float(total[-1]) if len(total) else base))
        # each step with an alternative leaves a region of its siblings; only the best few can be reached
        fork = np.flatnonzero(views.start[states + 1] - views.start[states] > 1)
        if len(fork):
            lows = _below(key, total[fork] - log_p[fork] + np.log(np.maximum(-np.expm1(log_p[fork]), 1e-300)), rng)
            need = min(k + 1 - len(out), len(lows))
            for i in np.argpartition(lows, need - 1)[:need] if need else ():
                t = fork[i]
                serial += 1
                heapq.heappush(regions, (float(lows[i]), serial, np.concatenate([prefix, picks[:t]]), float(total[t] - log_p[t]), int(words[t]), int(states[t]), (picks[t],)))
    limit = -regions[0][0] if regions else None
    return [(path, log_prob, _inclusion(log_prob, limit)) for path, log_prob in out]


def _below(key: float, level: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Negated Gumbel draws at these levels, given that they stay below the key of their parent."""
    return np.log(np.exp(np.minimum(700.0, level - key)) + rng.standard_exponential(len(level))) - level


def _inclusion(log_prob: float, limit: float | None) -> float:
    if limit is None:
        return 0.0
    x = log_prob - limit
    if x < -30:
        return x  # log(1 - exp(-e^x)) = x to double precision
    return math.log(-math.expm1(-math.exp(min(x, 700.0))))


def decode(ids: list[int], pieces: list[str]) -> str:
    """The text that was segmented."""
    return joined(ids, piece_bytes(pieces))


def piece_bytes(pieces: list[str]) -> list[bytes]:
    """What each piece stands for."""
    return [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces]


def joined(ids: list[int], parts: list[bytes]) -> str:
    return b"".join([parts[i] for i in ids]).decode(errors="replace")[1:]  # without the mark before the first word


def with_decoded(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its piece ids (an array; null gives null); an ``out`` that exists is replaced."""
    pieces = df.sparkSession.sparkContext.broadcast(piece_bytes(pieces_of(model)))

    def decoded(rows: pa.Array) -> pa.Array:
        parts = pieces.value
        return pa.array([None if r is None else joined(r, parts) for r in rows.to_pylist()], type=pa.string())
    return df.withColumn(out, F.arrow_udf(decoded, "string")(F.col(f"`{ids}`")))


def pieces_of(path: str) -> list[str]:
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def _worker(pieces, alpha: float, k: int, seed: int) -> Callable:
    made: list[Vocabulary] = []
    parts: list[bytes] = []

    def some(texts: list[str | None], keys: list[int]) -> list:
        words, out = [words_of(t) if t else [] for t in texts], []
        if not any(words):
            return [[] for _ in texts]
        views, first = lattice(sorted({w for row in words for w in row}), made[0])
        for text, row, key in zip(texts, words, keys):
            if not row:
                out.append([])
                continue
            rng = np.random.Generator(np.random.Philox(key=[seed, key & (1 << 64) - 1]))
            found = sample(np.array([first[w] for w in row]), views, k, rng)
            out.append([{"ids": (ids := views.pieces(path)), "log_prob": p, "log_inclusion": q, "decodes": joined(ids, parts) == text} for path, p, q in found])
        return out

    def sampled(texts: pa.Array, keys: pa.Array) -> pa.Array:
        if not made:
            made.append(Vocabulary(pieces.value, alpha))
            parts.extend(piece_bytes(pieces.value))
        out, held, size, own = [], [], 0, keys.to_pylist()
        for i, text in enumerate(texts):
            held.append(text.as_py())
            size += len(held[-1] or "")
            if size >= SHARE or i + 1 == len(texts):
                out += some(held, own[len(out):len(out) + len(held)])
                held, size = [], 0
        return pa.array(out, type=_SAMPLES)
    return sampled


def with_samples(df: DataFrame, model: str, keys: list[str], text: str = "text", k: int = 3, alpha: float = 1.0, seed: int = 7,
                 out: str = "samples") -> DataFrame:
    """``df`` with an array of (ids, log_prob, log_inclusion, and whether the ids decode to the text); an ``out`` that exists is replaced. ``model`` is a path the driver can
    read; its pieces, a table of fixed size, are broadcast."""
    pieces = df.sparkSession.sparkContext.broadcast(pieces_of(model))
    key = F.xxhash64(*[F.col(f"`{c}`") for c in keys])
    return df.withColumn(out, F.arrow_udf(_worker(pieces, alpha, k, seed), SAMPLES)(F.col(f"`{text}`"), key))


def report(turns: DataFrame, model: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    """Three segmentations of each turn, one a row; the ids as text, and whether they decode to the turn's text."""
    rows = with_samples(turns.select("conv_id", "turn", "text"), model, ["conv_id", "turn"])
    # outer: a filter on the array, which Spark infers otherwise, would draw all samples twice
    return rows.select("conv_id", "turn", F.posexplode_outer("samples").alias("sample", "s")).where("s IS NOT NULL").select(
        "conv_id", "turn", "sample", F.size("s.ids").alias("n_pieces"), F.array_join("s.ids", " ").alias("ids"), "s.log_prob", "s.log_inclusion",
        F.col("s.decodes").alias("round_trip"))
