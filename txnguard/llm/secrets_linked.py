"""Secret scans by multipart credential linking.

Strong kinds stand alone: ``assign`` (a named value), ``access`` (an access key id) and ``hex`` (a long hex
run). Weak parts prove nothing alone: an account name (``part_id``), an opaque mixed token (``part_secret``) and an
address of a service (``part_endpoint``). A document is cut into scopes at blank lines; within a scope, the intervals of
the parts, each widened by ``reach`` characters, are joined in order of position, and a weak part is reported only where
its complements meet it: an id where a secret is near, a secret where an id is near, an endpoint where both are.
An opaque token has 20 characters or more; one after ``=`` is a value, unless the ``=`` is the padding of an opaque token, which
then goes on to the end of both.

Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows give equal results; other
columns are kept as they are. The join sorts each kind once and looks up neighbours, so its cost follows the parts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, functions as F

from txnguard.llm.common import of_kind, small_batches, span_finder, span_text

KINDS = ("assign", "access", "hex")
WEAK = ("part_id", "part_secret", "part_endpoint")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails whole, as none of its parts is longer
_CUES = re.compile(r"(?ai)passw|secret|token|api_?key")
_PART_ID = re.compile(r"""(?ai:client_?id|access_?key_?id|account_?id|username|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""")
_OPAQUE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")  # tokens and the equals signs between and after them
_TOKEN = re.compile(r"([A-Za-z0-9+/_-]+)(={0,2})(=*)")
_PART_ENDPOINT = re.compile(r"(?ai:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s\"'<>]+")
_BREAK = re.compile(r"\n[ \t]*\n")


def strong(text: str) -> list[tuple[str, int, int]]:
    out = []
    if _CUES.search(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def _mixed(value: str) -> bool:
    """Upper case, lower case and digits: neither a word nor a number nor a hex run."""
    return any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)


def tokens(text: str) -> list[tuple[int, int]]:
    """Opaque mixed tokens with their padding. What stands before ``=`` and a value is a name, not a token."""
    out = []
    for run in _OPAQUE.finditer(text):
        if not _mixed(run[0]):
            continue
        at = None  # where a token began whose padding is followed by more
        for m in _TOKEN.finditer(text, *run.span()):
            opaque = at is not None or len(m[1]) >= 20 and _mixed(m[1])
            if not opaque:
                continue
            begin = m.start() if at is None else at
            if m.end() == run.end():
                out.append((begin, m.end(2)))
            elif m[2] and not m[3] and (len(m[2]) == 2 or len(m[0]) % 4 == 0):
                at = begin
            elif at is not None:
                out.append((at, m.end(1)))
                at = None
    return out


def _tops(spans: list[tuple[int, int]]) -> list[tuple[int, tuple[int, int] | None, int]]:
    """Up to each span: the largest end, its span, and the largest end of any other span. Spans are sorted."""
    out, most, owner, other = [], -1, None, -1
    for s in spans:
        if s != owner:
            if s[1] >= most:
                most, owner, other = s[1], s, most
            else:
                other = max(other, s[1])
        out.append((most, owner, other))
    return out


def _near(starts: list[int], tops: list, a: int, b: int, reach: int) -> bool:
    """Does any interval other than (a, b), widened by reach, meet it?"""
    i = bisect_right(starts, b + reach)
    if not i:
        return False
    most, owner, other = tops[i - 1]
    return (other if owner == (a, b) else most) >= max(0, a - reach)


def link(text: str, found: list[tuple[str, int, int]], reach: int) -> list[tuple[str, int, int]]:
    """The weak parts of ``text`` whose complements co-occur in their scope."""
    ids = [m.span(1) for m in _PART_ID.finditer(text)] if "=" in text or ":" in text else []
    ends = [m.span() for m in _PART_ENDPOINT.finditer(text)] if "://" in text else []
    strong_ids = [s[1:] for s in found if s[0] == "access"]
    if not (ids or ends or strong_ids):
        return []
    base = sorted(s[1:] for s in found)
    starts, tops = [a for a, _ in base], _tops(base)
    opaque = [(a, b) for a, b in tokens(text) if not _near(starts, tops, a, b, 0)]
    secrets = sorted(opaque + [s[1:] for s in found if s[0] != "access"])
    cuts = [m.start() for m in _BREAK.finditer(text)]
    out = []
    every = {"id": sorted(ids + strong_ids), "secret": secrets}
    scoped = {k: _by_scope(v, cuts) for k, v in every.items()}

    def meets(kind: str, a: int, b: int) -> bool:
        part = scoped[kind].get(bisect_left(cuts, a))
        return part is not None and _near(*part, a, b, reach)

    out += [("part_id", a, b) for a, b in ids if meets("secret", a, b)]
    out += [("part_secret", a, b) for a, b in opaque if meets("id", a, b)]
    out += [("part_endpoint", a, b) for a, b in ends if meets("id", a, b) and meets("secret", a, b)]
    return out


def _by_scope(spans: list[tuple[int, int]], cuts: list[int]) -> dict[int, tuple[list[int], list]]:
    parts: dict[int, list[tuple[int, int]]] = {}
    for a, b in spans:
        parts.setdefault(bisect_left(cuts, a), []).append((a, b))
    return {k: ([a for a, _ in v], _tops(v)) for k, v in parts.items()}


def find(text: str, reach: int = 300) -> list[tuple[str, int, int]]:
    """All spans by start, then kind: strong ones as listed, then linked weak ones."""
    found = strong(text)
    order = {k: i for i, k in enumerate(KINDS + WEAK)}
    return sorted(found + link(text, found, reach), key=lambda s: (s[1], order[s[0]], s[2]))


def with_secrets(df: DataFrame, text: str = "text", out: str = "secrets", reach: int = 300) -> DataFrame:
    """``df`` with an array of (kind, start, end); an ``out`` that exists is replaced."""
    return df.withColumn(out, span_finder(lambda t: find(t, reach))(F.col(f"`{text}`")))


def masked(df: DataFrame, text: str = "text", reach: int = 300) -> DataFrame:
    """``df`` with each found secret replaced by ``<kind>``; overlapping spans are masked as one."""
    def mask(value: str) -> str:
        out, at = [], 0
        for kind, a, b in find(value, reach):
            if a >= at:
                out += [value[at:a], f"<{kind}>"]
            at = max(at, b)
        return "".join(out) + value[at:]

    def clean(texts):
        import pyarrow as pa
        return pa.array([mask(t.as_py()) if t.is_valid else None for t in texts], type=pa.string())

    small_batches(df.sparkSession)
    return df.withColumn(text, F.arrow_udf(clean, "string")(F.col(f"`{text}`")))


def report(df: DataFrame) -> DataFrame:
    """Counts and digests of the strong spans, and all spans as text, per document."""
    found = with_secrets(df.select("doc_id", "text"), out="found").select("doc_id", "found")
    base = of_kind(F.col("found"), KINDS)
    return found.select("doc_id", *[F.size(of_kind(F.col("found"), (k,))).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))
