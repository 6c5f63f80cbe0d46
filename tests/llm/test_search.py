"""Ranked search against a plain version, on small tables with every odd case."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from hourline.llm import search
from hourline.llm.common import ready

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ready(spark)


def plain_search(docs, items, best=10):
    found = [(d, Counter(TERM.findall((t or "").translate(FOLD)))) for d, t in docs]
    lens = [sum(c.values()) for _, c in found]
    n_docs, total = sum(n > 0 for n in lens), sum(lens)
    df = Counter(t for _, c in found for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(FOLD)))
    rows = []
    for i, terms in asked.items():
        scored = []
        for (d, counts), n in zip(found, lens, strict=True):
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 8 * (10 + 90 * n * n_docs // total)))
                for t in terms if counts[t]
            )
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        rows += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:best], 1)]
    return sorted(rows, key=str)


DOCS = [
    (1, "The cat sat on the mat"), (2, "the cat"), (3, None), (4, ""), (5, "... !!"), (6, "ΣΑΣ café CAFÉ x1 2 2 2"), (7, "the cat"),
    (7, "the cat"), (None, "the cat"), (8, "the " * 5000 + "mat"), *[(100 + i, "the common words of all " + "cat " * (i % 4)) for i in range(40)],
]
ITEMS = [(1, "cat MAT the"), (2, None), (3, "zzz unknown"), (4, "café 2 ΣΑΣ the the"), (None, "mat"), (5, "common"), (5, "sat"), (6, "!")]


@pytest.mark.parametrize("owners", [1, 4])
def test_ranks_equal_a_plain_version(spark, monkeypatch, owners):
    monkeypatch.setattr(search, "ITEMS", 2)
    docs = spark.createDataFrame([(*d, "x", 0.0) for d in DOCS], "doc_id long, text string, term string, score double").repartition(3)
    items = spark.createDataFrame([(*i, 9) for i in ITEMS], "item_id long, text string, doc_id int")
    for best in (2, 10):
        out = search.ranked_search(docs, items, best, owners=owners)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, out.collect()), key=str) == plain_search(DOCS, ITEMS, best)


def test_small_blocks_change_nothing(spark):
    import pyarrow as pa

    texts = [d[1] for d in DOCS]
    batch = pa.RecordBatch.from_pydict({"key": [d[0] for d in DOCS], "text": texts})
    marks = b"\1" * (1 << search.FILTER_BITS)
    found = Counter()

    class Context:
        partitionId = staticmethod(lambda: 3)

    for size in (1, 7, 4096):
        search.BLOCK_DOCS, kept = size, search.BLOCK_DOCS
        search.TaskContext, real = type("T", (), {"get": staticmethod(lambda: Context)}), search.TaskContext
        try:
            rows = [r for b in search._postings(marks, pa.int64())([batch]) for r in b.to_pylist()]
        finally:
            search.BLOCK_DOCS, search.TaskContext = kept, real
        heads = [r for r in rows if r["term"] is None]
        assert [k for r in heads for k in r["keys"]] == [d[0] for d in DOCS]
        assert sum(r["n"] for r in heads) == 47 and len({r["block"] for r in heads}) == -(-len(DOCS) // size)
        found[size] = Counter({t: sum(r["n"] for r in rows if r["term"] == t) for t in {r["term"] for r in rows} - {None}})
    assert found[1] == found[7] == found[4096]


def test_string_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "name string, body string")
    items = spark.createDataFrame([("i", "y")], "q string, text string")
    call = lambda d, i: [tuple(r) for r in search.ranked_search(d, i, 10, "name", "body", "q").collect()]
    # df = N: the term's weight is floor(1000 ln(8 / 7)) = 133
    assert sorted(call(docs, items)) == [("i", r, d, 133 * (10**9 // 1800)) for r, d in enumerate(["a", "b", None], 1)]
    assert call(docs.where("false"), items) == [] and call(docs, items.where("false")) == []
