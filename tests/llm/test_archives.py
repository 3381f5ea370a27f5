"""Merkle manifest and WARC archives: plain versions, SQL, damage, and awkward rows."""

import base64
import gzip
import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from txnguard.llm import merkle, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"


def same(out, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas().convert_dtypes())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = sorted((tuple(r) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in out.collect()), key=repr) == want


# 12 Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    """All levels from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    for nodes in tree[:-1]:
        run = i // 3 * 3
        yield nodes[run:i], nodes[i + 1:run + 3]
        i //= 3


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    for s in names:
        for i, (_, _, own, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = [*siblings(trees[s], i), *siblings(top, names.index(s))]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            now = leaf(r, r["text"].replace("\n", "") if hit and r["text"] is not None else r["text"])
            for before, after in steps:
                now = sha(*before, now, *after)
            yield (r["doc_id"], own, trees[s][-1][0], top[-1][0], sha(*[x for b, a in steps for x in b + a]), now, now == top[-1][0])


def test_manifest_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = merkle.report(docs)
    want = sorted(plain_manifest([r.asDict() for r in docs.collect()]))
    assert sorted(map(tuple, out.collect())) == want
    assert 0 < sum(r[-1] for r in want) < len(want)
    same(out, merkle.REPORT_SQL, documents=docs)


def test_manifest_of_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, "a\nb", "en", None, 3), (1, "a\nb", "en", None, 3), (1, "other", "en", None, 5), (2, "", "é", "ä", 0), (3, "x " * 100_000, "en", "Z", 1),
            (None, "\n", "en", "Z", 1), (-4, "\n\n", "en", "ä", 2)] + [(i, f"text\n{i}", "en", "hot", 6) for i in range(100, 100 + 250)] + [(i, "t\n", "en", f"s{i}", 1) for i in range(400, 435)]
    df = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(c) for c in ("grp", "key", "leaf", "payload", "node", "idx", "n", "steps", "root")]).repartition(5)
    want = sorted(plain_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]), key=repr)
    out = merkle.report(df)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    for some in (rows[:1], rows[4:5], rows[:3]):
        own = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in some]
        assert sorted(map(tuple, merkle.report(spark.createDataFrame(some, DOCS)).collect()), key=repr) == sorted(plain_manifest(own), key=repr)
    assert merkle.report(spark.createDataFrame([], DOCS)).count() == 0


# 13 WARC


def test_archives_of_the_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    copies = pages.limit(5).withColumn("page_id", F.col("page_id") + 10**6)
    both = pages.unionByName(copies)
    out = warc.report(both)
    assert out.where("record_type = 'revisit'").count() == 5
    same(out, warc.REPORT_SQL, pages=both)


def test_archives_of_awkward_pages(spark):
    trap = "text\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nmore"
    rows = [(1, None, None), (2, "", ""), (3, "http://a b\r\nX: y", trap), (4, "u", trap), (None, "u", "é\U0001f600\n"), (None, "u", trap), (5, "u", "é\U0001f600\n"), (5, "u", "é\U0001f600\n"),
            (6, "u", "x" * 3_000_000), (7, "u", "\r\n\r\n"), (8, "u", "end\r\n")] + [(100 + i, "u", "hot") for i in range(200)]
    df = spark.createDataFrame(rows, PAGES).select("*", *[F.lit("x").alias(c) for c in ("digest", "size", "head", "block", "value", "path")]).repartition(4)
    out = {}
    for r in warc.report(df).collect():
        out.setdefault(r["page_id"], []).append(r)
    html = {i: h or "" for i, _, h in rows if i is not None}
    assert sum(map(len, out.values())) == len(rows)
    for i, found in out.items():
        for r in found:
            if i is not None:
                assert r["payload_bytes"] == len(html[i].encode()) and r["payload_digest"] == base64.b32encode(hashlib.sha1(html[i].encode()).digest()).decode()
    kinds = {i: [(r["record_type"], r["refers_to"]) for r in v] for i, v in out.items()}
    assert kinds[1] == [("revisit", 2)] and kinds[2] == kinds[4] == kinds[6] == [("response", None)] and kinds[3] == [("revisit", 4)]
    assert kinds[5] == [("response", None)] * 2 and sorted(kinds[None]) == [("revisit", 4), ("revisit", 5)]
    assert kinds[299] == [("response", None)] and all(kinds[100 + i] == [("revisit", 299)] for i in range(199))
    assert warc.report(spark.createDataFrame([], PAGES)).count() == 0


def archive(n, seed):
    """Records as bytes, each with the blank lines after it."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        payload = bytes(rng.integers(0, 256, int(rng.integers(0, 400)))) + (b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" if i % 3 == 0 else b"")
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        digest = lambda b: base64.b32encode(hashlib.sha1(b).digest())
        out.append(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:%d>\r\nWARC-Payload-Digest: sha1:%s\r\nWARC-Block-Digest: sha1:%s\r\n"
                   b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, digest(payload), digest(block), len(block), block))
    return out


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    for seed in range(25):
        rng = np.random.default_rng(seed)
        parts = [gzip.compress(r) if packed else r for r in archive(12, seed)]
        hurt = sorted(rng.choice(12, 3, replace=False).tolist())
        for how, i in zip(("cut", "flip", "junk"), hurt):
            p = parts[i]
            at = len(p) // 2
            parts[i] = p[:at] if how == "cut" else p[:at] + bytes([p[at] ^ 0x55]) + p[at + 1:] if how == "flip" else b"\x00junk WARC/1.0\r\n\x1f\x8b\x08zz" + p
        data = b"".join(parts)
        found = list(warc.salvage(data))
        names = [int(f["name"].rpartition(":")[2]) for f in found if f["reason"] is None]
        assert names == [i for i in range(12) if i not in hurt[:2]]
        assert found[0]["start"] == 0 and found[-1]["end"] == len(data) and all(a["end"] == b["start"] for a, b in zip(found, found[1:]))
        gaps = [(f["start"], f["end"]) for f in found if f["reason"]]
        starts = np.cumsum([0] + [len(p) for p in parts])
        want = []
        for i in hurt[:2]:
            want.append((int(starts[i]), int(starts[i + 1])))
        want.append((int(starts[hurt[2]]), int(starts[hurt[2]]) + len(parts[hurt[2]]) - len(gzip.compress(archive(12, seed)[hurt[2]]) if packed else archive(12, seed)[hurt[2]])))
        merged = []
        for a, b in sorted(want):  # neighbours are one gap
            merged[-1:] = [(merged[-1][0], b)] if merged and merged[-1][1] == a else [*merged[-1:], (a, b)]
        assert gaps == merged
    assert list(warc.salvage(b"")) == [] and [f["reason"] for f in warc.salvage(b"no archive")] == ["version"]


def test_salvage_of_files(spark, tmp_path):
    good = archive(30, 1)
    (tmp_path / "a.warc").write_bytes(b"".join(good[:10]) + good[10][:60] + b"".join(good[11:20]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in good[20:30]))
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sorted(int(r["name"].rpartition(":")[2]) for r in rows if r["reason"] is None) == [i for i in range(30) if i != 10]
    gap = [r for r in rows if r["reason"]]
    assert len(gap) == 1 and gap[0]["end"] - gap[0]["start"] == 60 and gap[0]["file"].endswith("a.warc")
    assert all(hashlib.sha1(r["payload"]).digest() == base64.b32decode(r["digest"]) for r in rows if r["reason"] is None)
