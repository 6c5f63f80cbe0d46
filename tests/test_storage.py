from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from series import hour, load_frame

from hourline import schemas
from hourline.operators import project, quality
from hourline.sources import flags, landing, payloads, ranges, tables, upsert

KEY = ["series_id", "timestamp"]
SCHEMA = "series_id string, timestamp timestamp, value double"


def rows(spark, *data):
    return spark.createDataFrame([("A", hour(i), v) for i, v in data], SCHEMA)


def content(df):
    return {(r.series_id, r.timestamp): r.value for r in df.collect()}


def test_a_null_never_replaces_a_value(spark):
    target = rows(spark, (0, 500.0), (1, 400.0), (2, None))
    source = rows(spark, (0, None), (1, 600.0), (2, 7.0), (3, None))
    merged = upsert.upsert(target, source, KEY, when="value IS NOT NULL")
    assert content(merged) == {("A", hour(0)): 500.0, ("A", hour(1)): 600.0, ("A", hour(2)): 7.0, ("A", hour(3)): None}
    assert upsert.change_counts(merged).first().asDict() == {"rows_inserted": 1, "rows_updated": 2, "rows_kept": 1}


def test_upsert_twice_is_upsert_once(spark):
    target, source = rows(spark, (0, 1.0)), rows(spark, (0, 2.0), (1, 3.0))
    once = upsert.upsert(target, source, KEY).drop("_change")
    assert content(upsert.upsert(once, source, KEY)) == content(once)


def test_repeated_source_keys_are_refused(spark):
    with pytest.raises(Exception, match="share a key"):
        upsert.upsert(rows(spark, (0, 1.0)), rows(spark, (0, 2.0), (0, 3.0)), KEY).collect()


def test_insert_only_keeps_the_first_forecast(spark):
    merged = upsert.upsert(rows(spark, (0, 1.0)), rows(spark, (0, 2.0), (1, 3.0)), KEY, update=None)
    assert content(merged) == {("A", hour(0)): 1.0, ("A", hour(1)): 3.0}


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "table")
    first = tables.with_day(rows(spark, (0, 1.0), (30, 2.0), (60, 3.0)))
    upsert.merge_into(path, first, KEY, ["day"])
    untouched = {p.name: p.stat().st_mtime_ns for p in Path(path, "day=2024-01-01").glob("*.parquet")}
    counts = upsert.merge_into(path, tables.with_day(rows(spark, (30, 5.0), (31, 6.0))), KEY, ["day"]).first()
    assert (counts.rows_inserted, counts.rows_updated, counts.rows_kept) == (1, 1, 0)
    assert {p.name: p.stat().st_mtime_ns for p in Path(path, "day=2024-01-01").glob("*.parquet")} == untouched
    got = content(tables.read_table(spark, path, first.schema))
    assert got == {("A", hour(0)): 1.0, ("A", hour(30)): 5.0, ("A", hour(31)): 6.0, ("A", hour(60)): 3.0}


def test_a_rerun_publishes_what_it_had_staged(spark, tmp_path):
    path, staged = str(tmp_path / "table"), str(tmp_path / "staged")
    upsert.merge_into(path, tables.with_day(rows(spark, (0, 1.0), (30, 2.0))), KEY, ["day"])
    batch = tables.with_day(rows(spark, (1, 5.0), (31, 6.0)))
    first = upsert.merge_into(path, batch, KEY, ["day"], staged=staged).first()
    whole = content(tables.read_table(spark, path, batch.schema))
    # What a crash while publishing leaves behind: a day without its older rows.
    damaged = tables.with_day(rows(spark, (31, 6.0)))
    damaged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    assert content(tables.read_table(spark, path, batch.schema)) != whole
    again = upsert.merge_into(path, batch, KEY, ["day"], staged=staged).first()
    assert content(tables.read_table(spark, path, batch.schema)) == whole and again == first


def test_many_touched_partitions_use_a_semi_join(spark, monkeypatch):
    monkeypatch.setattr(upsert, "LITERAL_PARTITIONS", 1)
    target = tables.with_day(rows(spark, (0, 1.0), (30, 2.0), (60, 3.0)))
    source = tables.with_day(rows(spark, (0, 1.0), (30, 2.0)))
    assert upsert.touched(target, source, ["day"]).count() == 2


def test_dry_run_counts_and_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    counts = upsert.merge_into(path, tables.with_day(rows(spark, (0, 1.0))), KEY, ["day"], dry_run=True).first()
    assert counts.rows_inserted == 1 and not list(Path(path).rglob("*.parquet"))


def test_fill_sets_the_flag(spark):
    target = rows(spark, (0, None), (1, 5.0)).withColumns({"actual": F.col("value"), "is_backfilled": F.lit(False)})
    out = upsert.fill_from(target, rows(spark, (0, 9.0), (1, 8.0)), KEY, "actual", "value", "is_backfilled")
    assert sorted((r.actual, r.is_backfilled) for r in out.collect()) == [(5.0, False), (9.0, True)]


def test_changes_replay_to_the_new_version(spark):
    old, new = rows(spark, (0, 1.0), (1, 2.0)), rows(spark, (1, 3.0), (2, 4.0))
    kinds = {(r.timestamp, r.change): r.value for r in upsert.changes(old, new, KEY).collect()}
    assert kinds == {
        (hour(0), "delete"): 1.0, (hour(1), "update_pre"): 2.0, (hour(1), "update_post"): 3.0, (hour(2), "insert"): 4.0,
    }


def test_ensure_table_and_log(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.ensure_table(spark, path, "ingestion_log", ["date"])
    assert tables.read_table(spark, path, "ingestion_log").count() == 0
    record = tables.ingestion_record(
        quality.load_quality(rows(spark, (0, 1.0), (1, None))), "r", F.lit(hour(0)), 2, 1, F.lit(hour(1))
    )
    for _ in range(2):
        tables.append_log(record, path, "run_date")
    got = tables.read_table(spark, path, "ingestion_log").collect()
    assert len(got) == 2 and got[0].rows_ingested == 2 and got[0].null_count == 1 and got[0].date == dt.date(2024, 1, 1)


def test_landing_lookback_and_ledger(spark, tmp_path):
    folder, ledger = tmp_path / "landing", str(tmp_path / "ledger")
    folder.mkdir()
    for i in (0, 2):
        name = hour(10 - i).strftime("%Y-%m-%dT%H-00-00Z") + ".json"
        (folder / name).write_text(json.dumps([
            {"timestamp": "2024-01-01T00:00:00Z", "series_id": "A", "value": 1.5, "source": "s", "fetched_at": "2024-01-01T01:00:00Z"},
            {"timestamp": "2024-01-01T01:00:00Z", "series_id": "A", "value": None, "source": "s", "fetched_at": "2024-01-01T01:00:00Z"},
        ]))
    wanted = landing.expected_files(spark, hour(10), 3, str(folder))
    assert {r.timestamp: r.found for r in wanted.collect()} == {hour(10): True, hour(9): False, hour(8): True}
    paths = landing.found_paths(wanted)
    assert landing.read_landing(spark, paths, schemas.LANDING_LOAD).count() == 4
    landing.mark_processed(wanted, ledger, hour(11))
    assert landing.found_paths(wanted, spark.read.parquet(ledger)) == []
    assert landing.read_landing(spark, [], schemas.LANDING_WEATHER).columns == schemas.LANDING_WEATHER.fieldNames()
    nothing = landing.expected_files(spark, hour(10), 3, str(tmp_path / "absent"))
    assert nothing.filter("found").count() == 0


def test_bad_landing_file_is_counted_not_lost(spark, tmp_path):
    (tmp_path / "bad.json").write_text("[{not json")
    got = landing.read_landing(spark, str(tmp_path), schemas.LANDING_LOAD, keep_bad=True)
    assert got.cache().filter(F.col(landing.CORRUPT).isNotNull()).count() == 1


XML = """<?xml version="1.0"?><Load_Document xmlns="urn:x:6:1"><TimeSeries><Period><timeInterval>
<start>2024-01-01T00:00Z</start><end>2024-01-01T04:00Z</end></timeInterval><resolution>PT60M</resolution>
<Point><position>1</position><quantity>4000</quantity></Point><Point><position>2</position><quantity>4100</quantity></Point>
<Point><position>4</position><quantity>4300</quantity></Point></Period></TimeSeries></Load_Document>"""


def test_xml_fills_missing_positions(spark):
    out = payloads.xml_load_points(spark.createDataFrame([("A", XML)], "series_id string, xml string"), "xml")
    got = [(r.timestamp, r.value) for r in out.orderBy("timestamp").collect()]
    assert got == [(hour(0), 4000.0), (hour(1), 4100.0), (hour(2), None), (hour(3), 4300.0)]


def test_prefixed_and_bad_xml(spark):
    prefixed = XML.replace("<", "<ns:").replace("<ns:/", "</ns:").replace("<ns:?xml", "<?xml").replace("xmlns=", "xmlns:ns=")
    df = spark.createDataFrame([("A", prefixed), ("B", "no xml"), ("C", "<a></a>")], "series_id string, xml string")
    assert payloads.xml_load_points(df, "xml").count() == 4
    with pytest.raises(Exception):
        payloads.xml_load_points(df.filter("series_id = 'B'"), "xml", strict=True).collect()


def test_weather_json(spark):
    text = json.dumps({"hourly": {
        "time": ["2024-07-01T00:00", "2024-07-01T01:00"], "temperature_2m": [20.5, None], "relative_humidity_2m": [50, 51],
    }})
    df = spark.createDataFrame([(text,), ('{"other": 1}',)], "json string")
    got = payloads.weather_json_rows(df, "json").orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [dt.datetime(2024, 6, 30, 22), dt.datetime(2024, 6, 30, 23)]
    assert [(r.temperature, r.humidity, r.cloud_cover) for r in got] == [(20.5, 50.0, None), (None, 51.0, None)]
    with pytest.raises(Exception, match="without hourly times"):
        payloads.weather_json_rows(df, "json", strict=True).collect()


def test_chunks_and_targets(spark):
    span = spark.createDataFrame([("A", hour(0), hour(240))], "series_id string, start timestamp, end timestamp")
    chunks = [(r.chunk_start, r.chunk_end) for r in ranges.chunk_ranges(span, 7).orderBy("chunk_start").collect()]
    assert chunks == [(hour(0), hour(168)), (hour(168), hour(240))]
    end = dt.datetime(2026, 7, 26, 12)
    day = spark.createDataFrame([(end - dt.timedelta(hours=24), end)], "start timestamp, end timestamp")
    names = [r.file_name for r in ranges.hourly_targets(day).orderBy("timestamp").collect()]
    assert len(names) == 24 and names[0] == "2026-07-25T12-00-00Z.json" and names[-1] == "2026-07-26T11-00-00Z.json"
    empty = day.withColumn("start", F.col("end"))
    assert ranges.hourly_targets(empty).count() == 0 and ranges.chunk_ranges(empty).count() == 0


def test_dedup_floors_to_the_hour_and_keeps_the_latest(spark):
    data = [("A", hour(0) + dt.timedelta(minutes=m), float(m), hour(m)) for m in (0, 20, 40)]
    df = spark.createDataFrame(data, "series_id string, timestamp timestamp, value double, fetched_at timestamp")
    got = quality.hourly(df).collect()
    assert [(r.timestamp, r.value) for r in got] == [(hour(0), 40.0)]


def test_gap_report_counts_null_and_absent_hours(spark):
    data = load_frame(spark, 48, drop={5, 6}, null={10})
    row = quality.gap_report(data, hour(50)).first()
    assert (row.gaps, row.first_gap) == (3, hour(5))
    assert quality.gap_report(data, hour(50), absent_too=False).first().gaps == 1


def test_sufficiency(spark):
    both = load_frame(spark, 800).union(load_frame(spark, 10, series="B")).union(load_frame(spark, 3, series="C", null={0, 1, 2}))
    status = {r.series_id: (r.status, r.rows_written) for r in quality.require_rows(both).collect()}
    assert status == {"A": ("ok", 800), "B": ("insufficient_data", 0), "C": ("skipped", 0)}


def test_column_contract(spark):
    df = load_frame(spark, 2).withColumn("extra", F.lit(1))
    out, missing, extra = project.align_features(df, ["value", "gone"])
    assert out.columns == ["series_id", "timestamp", "value"] and missing == ["gone"] and extra == ["extra"]
    with pytest.raises(ValueError, match="missing required columns"):
        project.conform(df, schemas.BRONZE_LOAD)


def test_already_ran(spark):
    done = spark.createDataFrame([(hour(3),)], "check_timestamp timestamp")
    assert project.already_ran(done, F.lit(hour(3))).first()[0] is True
    assert project.already_ran(done, F.lit(hour(4))).first()[0] is False


def test_flags_are_raised_once_and_consumed(spark):
    checks = spark.createDataFrame(
        [("A", hour(1), True, "r", 3, "value,lag_24h"), ("B", hour(1), False, "r", 0, "")],
        "series_id string, check_timestamp timestamp, retrain_triggered boolean, reason string, consecutive_drift_hours int, drifted_features string",
    )
    none = spark.createDataFrame([], schemas.RETRAINING_FLAGS)
    raised = flags.raise_flags(checks, none)
    assert [r.drifted_features for r in raised.collect()] == [["value", "lag_24h"]]
    assert flags.raise_flags(checks, raised).count() == 0
    assert flags.pending_flags(raised, flags.consume_flags(raised, hour(2))).count() == 0
