"""Digest indexes that live on, shards written by slot ranges, and parts of ranges, against plain Python."""

from __future__ import annotations

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from hourline.llm import exact_dedup, fingerprints, sharding
from hourline.llm.common import ready

TEXTS = ["a", "b", None, "", "a", "c", "a", "long " * 5000, "b", "é"]


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def named_rows(spark, kind="string"):
    rows = [(f"k{i:02d}", t, i) for i, t in enumerate(TEXTS)] + [(None, "d", 90), (None, "a", 91)]
    return spark.createDataFrame(rows, f"doc_id {kind}, text string, digest int")


def test_exact_groups_of_text_keys(session):
    found = exact_dedup.exact_groups(named_rows(session), f"t{uuid.uuid4().hex}").collect()
    rows = [(r["doc_id"], r["text"] or "") for r in named_rows(session).collect()]
    groups: dict = {}
    for key, text in rows:
        groups.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(key)
    assert len(found) == len(rows)
    for r in found:
        own = groups[r["text_sha256"]]
        assert r["keep_id"] == max((k for k in own if k is not None), default=None) and r["group_size"] == len(own)


def test_admitted_batches_compaction_and_repeats(session):
    index = exact_dedup.DigestIndex(session, f"t{uuid.uuid4().hex}", buckets=4)
    try:
        docs = named_rows(session)
        first, second = docs.where("digest < 5"), docs.where("digest >= 5")
        ids = lambda df: sorted(str(r["doc_id"]) for r in df.collect())
        assert ids(exact_dedup.admit(first, index)) == ["k01", "k03", "k04"]
        assert exact_dedup.admit(first, index).columns == docs.columns
        assert ids(exact_dedup.admit(first, index)) == ["k01", "k03", "k04"]  # the same batch again
        assert ids(exact_dedup.admit(second, index)) == ["None", "k05", "k07", "k09"]
        before = {tuple(r) for r in index.read().collect()}
        assert index.bucket_count() == 4
        grown = exact_dedup.DigestIndex(session, index.name, buckets=8)
        grown.compact()
        assert grown.bucket_count() == 8 and {tuple(r) for r in grown.read().collect()} == before
        assert exact_dedup.admit(docs.where("digest in (0, 8)"), grown).count() == 0
        assert exact_dedup.admit(docs.limit(0), grown).count() == 0
        session.sql(f"ALTER TABLE {index.name} RENAME TO {index.name}__next")  # a crash before the rename
        assert grown.exists() and {tuple(r) for r in grown.read().collect()} == before
    finally:
        index.drop()


def plain_shards(rows, shards):
    """(shard, slot) by doc_id: fractional ranks in each source, then equal cuts."""
    draw = lambda k: hashlib.md5(f"{sharding.SEED}:{k}".encode()).hexdigest()
    by_source: dict = {}
    for key, source in rows:
        by_source.setdefault("" if source is None else f"={source}", []).append((draw(key), key))
    ranked = sorted(
        ((i + 0.5) / len(own), source, *pair) for source, own in by_source.items() for i, pair in enumerate(sorted(own)))
    out, n, counts = {}, len(ranked), {}
    for i, (*_, key) in enumerate(ranked):
        shard = i * shards // n
        out[key] = (shard, counts.get(shard, 0))
        counts[shard] = counts.get(shard, 0) + 1
    return out


def test_shards_equal_plain_python_and_are_written_in_slot_ranges(session, tmp_path):
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 5}") for i in range(500)]
    df = session.createDataFrame(rows, "doc_id long, source string")
    wanted = plain_shards(rows, 7)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(df, 7).collect()} == wanted
    path = str(tmp_path / "shards")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sharding.write_shards(df, path, 7, rows_per_file=20)
    finally:
        session.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = session.read.parquet(path).withColumn("file", F.input_file_name())
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == wanted
    files = back.groupBy("shard", "file").agg(F.countDistinct(F.expr("slot div 20")).alias("ranges"), F.count("*").alias("n"))
    assert files.groupBy("shard").count().agg(F.max("count")).first()[0] > 1
    assert files.agg(F.sum("n")).first()[0] == 500


def test_fingerprints_keep_every_row_and_follow_the_order_of_keys(session):
    rows = [(k, t) for k, t, _ in named_rows(session).collect()] + [("k00", "a"), ("k00", "a"), ("k00", "other")]
    found = fingerprints.fingerprints(session.createDataFrame(rows, "doc_id string, text string"))
    assert "BroadcastNestedLoopJoin" not in found._jdf.queryExecution().toString()
    out = found.collect()
    assert sorted(map(str, (r["doc_id"] for r in out))) == sorted(str(k) for k, _ in rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r["text_sha256"] for r in out) == sorted(sha(t or "") for _, t in rows)
    unique = [(k, t or "") for k, t in sorted((r for r in rows if r[0] not in (None, "k00")), key=lambda r: r[0])]
    edits = {r["doc_id"]: r["edited_sha256"] for r in out}
    for (key, text), (_, after) in zip(unique, unique[1:]):
        assert edits[key] == sha(fingerprints.edited(text, after))
