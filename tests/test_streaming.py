from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from series import hour

from hourline import schemas
from hourline.operators.windows import consecutive_true
from hourline.sources import tables
from hourline.streaming import streams


def write_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps([
        {"timestamp": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "series_id": "A", "value": v, "source": "s",
         "fetched_at": f.strftime("%Y-%m-%dT%H:%M:%SZ")} for t, v, f in rows
    ]))


def run_sink(spark, base):
    stream = streams.landing_stream(spark, str(base / "landing"), schemas.LANDING_LOAD, archive_dir=str(base / "archive"))
    query = streams.upsert_sink(
        tables.with_day(stream), str(base / "table"), ["series_id", "timestamp"], ["day"], str(base / "state"),
        when="value IS NOT NULL", order="fetched_at",
    )
    query.awaitTermination()
    schema = tables.with_day(spark.createDataFrame([], schemas.LANDING_LOAD)).schema
    return {r.timestamp: r.value for r in tables.read_table(spark, str(base / "table"), schema).collect()}


def test_landing_files_are_merged_once(spark, tmp_path):
    folder = tmp_path / "landing"
    write_file(folder, "one", [(hour(0), 1.0, hour(1)), (hour(1), 2.0, hour(1)), (hour(1), 3.0, hour(2))])
    assert run_sink(spark, tmp_path) == {hour(0): 1.0, hour(1): 3.0}
    # A late correction and a NULL that must not erase anything.
    write_file(folder, "two", [(hour(0), None, hour(3)), (hour(1), 9.0, hour(3)), (hour(30), 4.0, hour(31))])
    expected = {hour(0): 1.0, hour(1): 9.0, hour(30): 4.0}
    assert run_sink(spark, tmp_path) == expected
    assert run_sink(spark, tmp_path) == expected
    # Files of finished batches have left the landing folder.
    assert [p.name for p in (tmp_path / "archive").rglob("*.json")] == ["one.json"]


def event_files(spark, folder, *batches):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, "series_id string, ts timestamp, value double").coalesce(1).write.mode("append").parquet(str(folder))


def test_late_events_are_dropped_and_counted(spark, tmp_path):
    minute = dt.timedelta(minutes=1)
    folder = tmp_path / "events"
    early = [("A", hour(0) + 5 * minute, 1.0), ("A", hour(0) + 50 * minute, 2.0), ("A", hour(3), 5.0)]
    event_files(spark, folder, early)
    schema = spark.read.parquet(str(folder)).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(str(folder))
        query = (
            streams.hourly_load(stream, "10 minutes").writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    run()
    event_files(spark, folder, [("A", hour(0) + 10 * minute, 100.0), ("A", hour(6), 1.0)])
    second = run()
    got = {r.timestamp: (r.value, r.events) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {hour(0): (3.0, 2), hour(3): (5.0, 1)}
    assert streams.late_rows(second) == 1


def test_stream_dedup_keeps_one_row_per_hour(spark, tmp_path):
    folder = tmp_path / "events"
    event_files(spark, folder, [("A", hour(0), 1.0), ("A", hour(0), 2.0), ("B", hour(0), 3.0)], [("A", hour(0), 4.0), ("A", hour(1), 5.0)])
    schema = spark.read.parquet(str(folder)).schema
    stream = spark.readStream.schema(schema).parquet(str(folder)).withColumnRenamed("ts", "timestamp")
    rows, _ = streams.run_to_table(streams.dedup_within(stream, "2 hours"), "dedup")
    assert rows.groupBy("series_id", "timestamp").count().filter("count > 1").count() == 0
    assert rows.count() == 3


def check_files(spark, folder, batches):
    for batch in batches:
        rows = [(s, hour(h), f) for s, h, f in batch]
        spark.createDataFrame(rows, "series_id string, check_timestamp timestamp, any_drift_detected boolean").coalesce(1).write.mode("append").parquet(str(folder))


CLOSE = [("Z", 500, False)]  # moves the watermark past all other checks; it stays waiting itself


def runs_of(spark, folder, batches, lateness, contiguous=False):
    check_files(spark, folder, batches)
    schema = spark.read.parquet(str(folder)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    rows, query = streams.run_to_table(streams.consecutive_stream(stream, lateness=lateness, contiguous=contiguous), "runs")
    return rows, query


def test_run_length_survives_batches_and_replays(spark, tmp_path):
    folder = tmp_path / "checks"
    first = [("A", 0, True), ("A", 1, True), ("B", 0, False)]
    # The second batch repeats checks that were counted already.
    second = [("A", 1, True), ("A", 2, True), ("B", 1, True), ("A", 3, False), ("A", 5, True)]
    rows, _ = runs_of(spark, folder, [first, second, CLOSE], "10 hours")
    got = {(r.series_id, r.check_timestamp): r.consecutive for r in rows.collect()}
    assert got == {
        ("A", hour(0)): 1, ("A", hour(1)): 2, ("A", hour(2)): 3, ("A", hour(3)): 0, ("A", hour(5)): 1,
        ("B", hour(0)): 0, ("B", hour(1)): 1,
    }
    newest = rows.groupBy("series_id").agg(F.max_by("consecutive", "check_timestamp"))
    batch = spark.read.parquet(str(folder)).dropDuplicates(["series_id", "check_timestamp"]).filter("series_id <> 'Z'")
    assert dict(newest.collect()) == dict(consecutive_true(batch, "any_drift_detected").collect())


@pytest.mark.parametrize("contiguous", [False, True])
def test_checks_in_any_order_count_as_in_order(spark, tmp_path, contiguous):
    draw = random.Random(3)
    checks = [(s, h, draw.random() < 0.8) for s in "AB" for h in range(60) if draw.random() < 0.9]
    batches = [[c for c in checks if 15 * i <= c[1] < 15 * (i + 1)] for i in range(4)]
    for i in range(3):  # a third of each batch comes with the next one, among checks up to 30 hours newer
        late = [c for c in batches[i] if draw.random() < 0.33]
        batches[i] = [c for c in batches[i] if c not in late]
        batches[i + 1] = batches[i + 1] + late
    for b in batches:
        draw.shuffle(b)
    rows, query = runs_of(spark, tmp_path / "checks", [*batches, CLOSE], "31 hours", contiguous)
    expected, last, run = {}, {}, {}
    for s, h, flag in sorted(checks):
        gap = contiguous and s in last and h != last[s] + 1  # an hour without a check ends the run too
        run[s] = 0 if not flag else 1 if gap else run.get(s, 0) + 1
        last[s] = h
        expected[s, hour(h)] = run[s]
    assert {(r.series_id, r.check_timestamp): r.consecutive for r in rows.collect()} == expected
    assert rows.count() == len(checks) and streams.late_rows(query) == 0


def test_too_late_checks_are_counted_not_mixed_in(spark, tmp_path):
    batches = [[("A", 0, True), ("A", 40, True)], [("A", 41, True)], [("A", 1, False), ("A", 42, True)], CLOSE]
    rows, query = runs_of(spark, tmp_path / "checks", batches, "5 hours")
    got = {r.check_timestamp: r.consecutive for r in rows.collect()}
    assert got == {hour(0): 1, hour(40): 2, hour(41): 3, hour(42): 4} and streams.late_rows(query) == 1


def test_contiguous_runs_end_at_an_absent_hour(spark, tmp_path):
    batches = [[("A", 0, True), ("A", 1, True)], [("A", 2, True), ("A", 5, True), ("A", 6, True)], CLOSE]
    rows, _ = runs_of(spark, tmp_path / "checks", batches, "10 hours", contiguous=True)
    got = {r.check_timestamp: r.consecutive for r in rows.collect()}
    assert got == {hour(0): 1, hour(1): 2, hour(2): 3, hour(5): 1, hour(6): 2}
