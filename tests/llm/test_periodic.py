"""Periodic runs against a plain scan of every lag."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from hourline.llm import periodic
from hourline.llm.common import ready
from hourline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ready(spark)


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(12, 2 * q):
                s = w[i : i + n]
                if all(s[:-d] != s[d:] for d in range(1, q)):
                    out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out)


def plain_collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


def some_texts():
    draw = random.Random(11)
    letters = lambda n, k: [draw.choice("abcdefghijklmnopqrst"[:k]) for _ in range(n)]
    texts = []
    for _ in range(60):
        u = letters(draw.randrange(1, 150), draw.choice([2, 20]))
        texts += [
            letters(draw.randrange(300), draw.choice([2, 8])),
            letters(draw.randrange(40), 20) + u * draw.randrange(1, 5) + u[: draw.randrange(len(u) + 1)] + letters(draw.randrange(40), 20),
            (["a", "b"] * draw.randrange(1, 60) + ["a"]) * draw.randrange(1, 4),
            (["a"] * draw.randrange(1, 60) + ["b"] * draw.randrange(1, 60)) * draw.randrange(1, 6),
        ]
    x, y = ["a"], ["a", "b"]
    while len(y) < 400:
        x, y = y, y + x
    return [*texts, y, ["a"] * 700, [], ["one"]]


def test_runs_equal_a_plain_scan(spark, monkeypatch):
    texts = some_texts()
    rows = [(i, " ".join(t), "k", 1) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r for r in periodic.periodic_runs(
        spark.createDataFrame(rows, "doc_id long, text string, runs string, key int")).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        expected = plain_runs(t)
        assert [tuple(r) for r in out[i]["runs"]] == expected, t
        assert out[i]["collapsed"] == plain_collapsed(t, expected) and out[i]["n_words"] == len(t)


def test_chunks_do_not_change_runs(spark, monkeypatch):
    texts = [" ".join(t) for t in some_texts()[:40]]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "text": texts})
    whole = [r for b in periodic._find([batch]) for r in b.to_pylist()]
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 50)
    monkeypatch.setattr(periodic, "IDS_KEPT", 10)
    assert [r for b in periodic._find([batch]) for r in b.to_pylist()] == whole


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "x y " * 20), (2, " \t\n\x0b\x0c\r"), (3, "Σ x\x1cy " * 12), (4, "A a " * 6), (4, "A a " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(df).collect()), key=str)
    assert out == sorted([
        (1, 0, [], ""), (1, 0, [], ""), (None, 40, [(0, 40, 2)], "x y"), (2, 0, [], ""), (3, 12, [(0, 12, 1)], "Σ x\x1cy"),
        (4, 12, [(0, 12, 2)], "A a"), (4, 12, [(0, 12, 2)], "A a"),
    ], key=str)
    assert periodic.periodic_runs(df.where("false")).count() == 0
    long = spark.createDataFrame([("s", " ".join(f"w{i % 4001}" for i in range(60_000)))], "name string, text string")
    row = periodic.periodic_runs(long, "name").first()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 4001)] and row["name"] == "s"


def test_query_equals_the_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(out) == len(docs)
    planted = 0
    for doc_id, text in docs:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 600:
            continue  # quadratic here; long texts are compared above
        runs, got = plain_runs(w), out[doc_id]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (got["n_runs"], got["start"], got["length"], got["period"]) == (len(runs), *best)
        assert got["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert got["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert got["collapsed_sha256"] == hashlib.sha256(plain_collapsed(w, runs).encode()).hexdigest()
    assert planted > 50
