"""Versioned tables: whole versions for readers, crashes at every step, conflicts, refresh, change feed."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourline.sources import versions

SCHEMA = "day date, id long, value double, actual double"
DAY = [dt.date(2024, 1, d) for d in range(1, 6)]
KEYS, BY = ["id"], ["day"]


def frame(spark, *rows):
    return spark.createDataFrame([(DAY[d], i, v, a) for d, i, v, a in rows], SCHEMA)


def contents(spark, path, number=None):
    rows = versions.read_version(spark, path, frame(spark).schema, BY, number).collect()
    return sorted((DAY.index(r.day), r.id, r.value, r.actual) for r in rows)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_merges_make_versions_that_stay(spark, path):
    assert contents(spark, path) == []
    counts = versions.merge_version(path, frame(spark, (0, 1, 1.0, None), (1, 2, 2.0, None)), KEYS, BY).first()
    assert tuple(counts) == (2, 0, 0)
    pinned = versions.read_version(spark, path, frame(spark).schema, BY)
    source = frame(spark, (1, 2, 20.0, None), (1, 3, 3.0, None), (2, 4, None, None))
    assert tuple(versions.merge_version(path, source, KEYS, BY, when="value > 5").first()) == (2, 1, 0)
    assert contents(spark, path) == [(0, 1, 1.0, None), (1, 2, 20.0, None), (1, 3, 3.0, None), (2, 4, None, None)]
    assert contents(spark, path, 1) == [(0, 1, 1.0, None), (1, 2, 2.0, None)]
    assert sorted(r.value for r in pinned.collect()) == [1.0, 2.0]  # opened before the second write, run after it
    assert versions.version(spark, path).changed == ("day=2024-01-02", "day=2024-01-03")
    dry = versions.merge_version(path, frame(spark, (4, 9, 9.0, None)), KEYS, BY, dry_run=True).first()
    assert tuple(dry) == (1, 0, 0) and versions.current(spark, path) == 2
    nothing = versions.merge_version(path, frame(spark), KEYS, BY).first()
    assert tuple(nothing) == (0, 0, 0) and len(contents(spark, path)) == 4


@pytest.mark.parametrize("step", ["upsert", "_written_parts", "_commit"])
def test_a_crash_leaves_the_old_version(spark, path, monkeypatch, step):
    versions.merge_version(path, frame(spark, (0, 1, 1.0, None)), KEYS, BY)
    source = frame(spark, (0, 1, 5.0, None), (1, 2, 2.0, None))
    real = getattr(versions, step)

    def crash(*args, **kwargs):
        if step == "_written_parts":
            real(*args, **kwargs)  # the rows are written by now
        raise OSError("lost")

    monkeypatch.setattr(versions, step, crash)
    with pytest.raises(OSError):
        versions.merge_version(path, source, KEYS, BY, writer=("stream", 7))
    monkeypatch.undo()
    assert contents(spark, path) == [(0, 1, 1.0, None)]
    for _ in range(2):  # the rerun of a batch that is committed writes nothing
        versions.merge_version(path, source, KEYS, BY, writer=("stream", 7))
        assert contents(spark, path) == [(0, 1, 5.0, None), (1, 2, 2.0, None)]
    assert versions.current(spark, path) == 2
    versions.expire(spark, path, keep=1)
    assert contents(spark, path) == [(0, 1, 5.0, None), (1, 2, 2.0, None)]


def test_a_write_meanwhile(spark, path, monkeypatch):
    """Other partitions: both stand. The same partition: the merge is worked out on the newer rows."""
    versions.merge_version(path, frame(spark, (0, 1, 1.0, None)), KEYS, BY)
    for other, own in (((1, 2, 2.0, None), (2, 3, 3.0, None)), ((2, 4, 4.0, None), (2, 3, 30.0, None))):
        real, met = versions._written_parts, []

        def meanwhile(*args, other=other, real=real, met=met):
            if not met:
                met.append(1)
                versions.merge_version(path, frame(spark, other), KEYS, BY)
            return real(*args)

        monkeypatch.setattr(versions, "_written_parts", meanwhile)
        versions.merge_version(path, frame(spark, own), KEYS, BY)
        monkeypatch.undo()
    assert contents(spark, path) == [(0, 1, 1.0, None), (1, 2, 2.0, None), (2, 3, 30.0, None), (2, 4, 4.0, None)]
    assert versions.current(spark, path) == 5
    number = versions.current(spark, path)
    assert not versions._commit(spark, path, versions.Version(number))  # a taken number is not overwritten
    assert len(contents(spark, path)) == 4


def test_refresh_keeps_what_is_settled(spark, path):
    versions.merge_version(path, frame(spark, (0, 1, 1.0, 9.0), (0, 2, 2.0, None)), KEYS, BY)
    counts = versions.refresh_version(path, frame(spark, (0, 1, 5.0, None), (0, 2, 6.0, None), (1, 3, 7.0, None)), KEYS, BY, "actual")
    assert tuple(counts.first()) == (1, 1, 1)
    assert contents(spark, path) == [(0, 1, 1.0, 9.0), (0, 2, 6.0, None), (1, 3, 7.0, None)]


def test_changes_read_the_moved_partitions_alone(spark, path):
    versions.merge_version(path, frame(spark, *[(d, d, 1.0, None) for d in range(5)]), KEYS, BY)
    versions.merge_version(path, frame(spark, (3, 3, 2.0, None), (3, 33, 1.0, None)), KEYS, BY)
    feed = versions.version_changes(spark, path, frame(spark).schema, KEYS, BY, 1)
    assert sorted((r.id, r.value, r.change) for r in feed.collect()) == [(3, 1.0, "update_pre"), (3, 2.0, "update_post"), (33, 1.0, "insert")]
    assert {f.split("day=")[1][:10] for f in feed.inputFiles()} == {"2024-01-04"}
    assert versions.version_changes(spark, path, frame(spark).schema, KEYS, BY, 2).isEmpty()
    before = contents(spark, path)
    assert versions.expire(spark, path, keep=1) == 1 and contents(spark, path) == before
