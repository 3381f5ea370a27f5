"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: ``@``, ``+``, digits, ``://`` and account cues. Each anchor has a local
parser that expands left and right from it and checks what it finds, so a text without anchors costs one automaton pass.
Email, ip, card and phone follow the base patterns exactly (leftmost, non-overlapping per kind, failing matches dropped
without a retry). Added kinds: ``account`` (an IBAN of its country's length with valid check digits, or 8 to 17 digits,
after an account cue in any case) and
``login`` (the user part of a URL).

Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows give equal results; other columns
are kept as they are. Parsers only move forward from what they consumed, so the cost is linear in the text.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, functions as F

from txnguard.llm.common import of_kind, span_finder, span_text

KINDS = ("email", "ip", "card", "phone")
ADDED = ("account", "login")

#: Words before an account number.
CUES = ("iban", "account number", "account no", "account", "acct", "konto", "compte", "cuenta")

#: Lengths of IBANs by country.
IBANS = {code: size for size, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9.]+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AFTER_CUE = re.compile(r"[\x20.:#=]{0,4}(?:(?P<iban>[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})|(?P<plain>[0-9](?:[\x20-]?[0-9]){7,16}))(?![0-9A-Za-z])")
_IBAN = {size: re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){%d}(?![0-9A-Za-z])" % (size - 4)) for size in set(IBANS.values())}
_USER = re.compile(r"[^\s/@:]+:[^\s/@]+(?=@[A-Za-z0-9])")


@cache
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for anchor, kind in [("@", "@"), ("+", "+"), ("://", ":"), *[(str(d), "0") for d in range(10)]]:
        found.add_word(anchor, (kind, len(anchor)))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban(value: str) -> bool:
    flat = value.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def _lower(text: str) -> str:
    """Lower case, each character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _quads(chain: str, at: int) -> list[tuple[str, int, int]]:
    """Numbers joined by single dots, four at a time: where the base pattern matches, each digit looked at once."""
    parts, out = chain.split("."), []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i:i + 4]
        size = sum(map(len, four)) + 3
        if all(map(_small, four)):
            out.append(("ip", at, at + size))
        at += size + 1
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans by kind as listed (added kinds last), then start."""
    out: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS + ADDED}
    mail = ip = card = phone = account = 0  # how far each parser has consumed the text
    for last, (kind, width) in _automaton().iter(_lower(text)):
        at = last - width + 1
        if kind == "0":
            if at >= ip:
                ip = _NUMBERS.match(text, at).end()
                out["ip"] += [s for m in _CHAIN.finditer(text, at, ip) for s in _quads(m[0], m.start())]
            if at >= card:
                m = _CARD.match(text, at)
                card = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        out["card"].append(("card", at, card))
        elif kind == "@":
            if at >= mail:
                left = at
                while left > mail and text[left - 1] in _LOCAL:
                    left -= 1
                m = _DOMAIN.match(text, at + 1) if left < at else None
                if m:
                    mail = m.end()
                    out["email"].append(("email", left, mail))
        elif kind == "+":
            m = _PHONE.match(text, at) if at >= phone else None
            if m:
                phone = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out["phone"].append(("phone", at, phone))
        elif kind == ":":
            m = _USER.match(text, last + 1)
            if m:
                out["login"].append(("login", *m.span()))
        elif at >= account:
            m = _AFTER_CUE.match(text, last + 1)
            if m and m["iban"]:  # what follows may look like more of it
                size = IBANS.get(m["iban"][:2])
                own = _IBAN[size].match(text, m.start("iban")) if size else None
                a, end = own.span() if own else m.span("iban")
                if _iban(text[a:end]):
                    account = end
                    out["account"].append(("account", a, account))
            elif m:
                a, account = m.span("plain")
                out["account"].append(("account", a, account))
    return [s for k in out for s in out[k]]


def with_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``df`` with an array of (kind, start, end); an ``out`` that exists is replaced."""
    return df.withColumn(out, span_finder(find)(F.col(f"`{text}`")))


def report(df: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text, per document."""
    found = with_pii(df.select("doc_id", "text"), out="found").select("doc_id", "found")
    base = of_kind(F.col("found"), KINDS)
    return found.select("doc_id", *[F.size(of_kind(F.col("found"), (k,))).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))
