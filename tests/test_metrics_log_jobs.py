from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import numpy as np
import pandas as pd
import pytest
from conftest import GOOD_ROWS, SF, one, raw_row, rows
from pyspark.sql import functions as F

from tallyline.operators import metrics, runlog
from tallyline.plans import jobs
from tallyline.schemas import OPERATIONAL, RAW_SALES, RUN_LOG, STAGED_SALES
from tallyline.sources import tables
from tallyline.sources.warehouse import Warehouse
from tallyline.streaming import incremental

DAY = dt.date(2024, 1, 5)


def series(spark, values, start=dt.datetime(2024, 1, 5), step=400, entity="e"):
    return spark.createDataFrame(
        [(DAY, entity, "m", None if v is None else D(str(v)), "S",
          start + dt.timedelta(seconds=i * step), i) for i, v in enumerate(values)],
        OPERATIONAL,
    )


@pytest.mark.parametrize("chunk", [1, 900, 86400])
def test_forward_fill_matches_pandas(spark, chunk):
    rng = np.random.RandomState(3)
    values = [None if rng.rand() < 0.6 else round(float(rng.rand()), 4) for _ in range(200)]
    other = [None, None, 1.5, None]
    df = series(spark, values).unionByName(series(spark, other, entity="f"))
    out = metrics.forward_fill(df, chunk_seconds=chunk).orderBy("entity_id", "loaded_at")
    want = [*pd.Series(values, dtype=float).ffill(), *pd.Series(other, dtype=float).ffill()]
    got = [np.nan if v is None else float(v) for (v,) in rows(out, "metric_value")]
    assert np.allclose(got, want, equal_nan=True)


def test_summary_counts_values_and_drops_keyless_rows(spark):
    df = series(spark, [1, None, 2]).unionByName(
        series(spark, [5]).withColumn("entity_id", F.lit(None).cast("string"))
    )
    assert rows(metrics.summarise(df)) == [("e", "m", D("3.0000"), D("1.5000"), 2)]


def test_rollup_of_an_empty_day(spark):
    assert metrics.daily_rollup(series(spark, [1]), dt.date(2030, 1, 1)).count() == 0


def test_extract_and_rollup_twice_is_the_same(spark, tmp_path):
    staged, summary = str(tmp_path / "staged"), str(tmp_path / "summary")
    log = jobs.AuditLog(spark, str(tmp_path / "log"), DAY)
    source = series(spark, [1, 2, 3])
    for _ in range(2):
        assert jobs.daily_extract(source, DAY, staged, log) == 3
        jobs.metric_rollup(spark, staged, summary, DAY)
    jobs.metric_rollup(spark, staged, summary, dt.date(2030, 1, 1))
    assert spark.read.parquet(staged).count() == 3
    assert rows(spark.read.parquet(summary), "total_value", "record_count") == [(D("6.0000"), 3)]
    events = spark.read.parquet(str(tmp_path / "log"))
    assert events.groupBy("status").count().count() == 2 and events.count() == 4


def test_failed_work_is_logged_and_raised(spark, tmp_path):
    log = jobs.AuditLog(spark, str(tmp_path / "log"), DAY)
    with pytest.raises(ZeroDivisionError):
        log.run("Staging", lambda: 1 // 0)
    state = one(runlog.current_state(spark.read.parquet(str(tmp_path / "log"))))
    assert (state.status, state.stage) == ("Failed", "Staging") and state.error_message


def log_rows(spark):
    def line(i, day, stage, status, records, seconds):
        start = dt.datetime(2024, 1, day, 6)
        end = None if seconds is None else start + dt.timedelta(seconds=seconds)
        return (i, dt.date(2024, 1, day), stage, status, None, records, start, end, None)

    return spark.createDataFrame([
        line(1, 1, "Staging", "Completed", 90, 10), line(2, 1, "Reporting", "Failed", 0, 1),
        line(3, 31, "Staging", "Completed", 10, 20), line(4, 31, "Staging", "Failed", 5, None),
    ], RUN_LOG)


def test_log_statistics(spark):
    log = log_rows(spark)
    as_of = dt.date(2024, 2, 1)
    rate = one(runlog.success_rate(log, as_of))
    assert (rate.success_rate_pct, rate.total_runs_30d) == (D("50"), 2)
    assert tuple(one(runlog.failed_runs(log, as_of))) == (2, 1)
    assert one(runlog.rows_loaded(log)).rows_loaded == 105
    score = one(runlog.quality_score(log, 95))
    assert (score.completed_records, score.all_records) == (100, 200)
    assert score.quality_score_pct == 50
    assert one(runlog.staging_success(log)).staging_success == 2
    empty = one(runlog.success_rate(log.limit(0), as_of))
    assert empty.success_rate_pct == 0


def test_duration_counts_second_boundaries(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    log = spark.createDataFrame(
        [(1, DAY, "S", "Completed", None, 1, start, start + dt.timedelta(seconds=0.2), None),
         (2, DAY, "S", "Started", None, 1, start, None, None)], RUN_LOG)
    timed = runlog.with_duration(log, dt.datetime(2024, 1, 1, 0, 1)).orderBy("log_id")
    assert rows(timed, "duration_seconds") == [(1,), (60,)]


def test_log_slices(spark):
    log = log_rows(spark)
    assert runlog.sliced(log, since=dt.date(2024, 1, 2), status="Failed").count() == 1
    assert runlog.sliced(log, until=dt.date(2024, 1, 2), stage="Staging").count() == 1


def test_incremental_merge(spark):
    def frame(*lines):
        return spark.createDataFrame(
            [(i, dt.datetime(2024, 1, d), v) for i, d, v in lines],
            "transaction_id string, loaded_at timestamp, v int")

    current = frame(("a", 1, 1), ("b", 1, 2))
    source = frame(("a", 1, 1), ("b", 3, 20), ("b", 4, 21), ("c", 3, 30))
    mark = one(incremental.high_water_mark(current)).high_water_mark
    changes = incremental.changes_since(source, mark)
    merged = incremental.merge_by_key(current, changes)
    assert sorted(rows(merged, "transaction_id", "v")) == [("a", 1), ("b", 2), ("c", 30)]
    again = incremental.merge_by_key(merged, changes)
    assert sorted(rows(again)) == sorted(rows(merged))
    latest = incremental.merge_by_key(current, changes, policy="keep_latest")
    assert sorted(rows(latest, "transaction_id", "v")) == [("a", 1), ("b", 21), ("c", 30)]
    with pytest.raises(ValueError):
        incremental.merge_by_key(current, changes, policy="other")


def test_rows_at_the_mark_are_not_lost(spark):
    def frame(*lines):
        return spark.createDataFrame(
            [(i, dt.datetime(2024, 1, d)) for i, d in lines],
            "transaction_id string, loaded_at timestamp")

    late = frame(("a", 1), ("late", 1), ("c", 2))
    changes = incremental.changes_since(late, dt.datetime(2024, 1, 1))
    merged = incremental.merge_by_key(frame(("a", 1)), changes)
    assert sorted(rows(merged, "transaction_id")) == [("a",), ("c",), ("late",)]


def test_a_day_that_became_empty_is_emptied(spark, tmp_path):
    staged, summary = str(tmp_path / "staged"), str(tmp_path / "summary")
    log = jobs.AuditLog(spark, str(tmp_path / "log"), DAY)
    source = series(spark, [1, 2, 3])
    assert jobs.daily_extract(source.limit(0), DAY, staged, log) == 0
    assert jobs.daily_extract(source, DAY, staged, log) == 3
    jobs.metric_rollup(spark, staged, summary, DAY)
    assert jobs.daily_extract(source.limit(0), DAY, staged, log) == 0
    jobs.metric_rollup(spark, staged, summary, DAY)
    assert spark.read.schema(OPERATIONAL).parquet(staged).count() == 0
    assert spark.read.parquet(summary).count() == 0


def test_rollup_does_not_depend_on_partitions(spark, tmp_path):
    log = jobs.AuditLog(spark, str(tmp_path / "log"), DAY)
    source = series(spark, [None, 5, None, 7, None, None], step=0)
    for parts in (1, 4):
        staged, summary = str(tmp_path / f"staged{parts}"), str(tmp_path / f"summary{parts}")
        jobs.daily_extract(source.repartition(parts, "staging_id"), DAY, staged, log)
        jobs.metric_rollup(spark, staged, summary, DAY)
        assert rows(spark.read.parquet(summary), "total_value", "record_count") == [(D("31.0000"), 5)]


def test_conform(spark):
    df = spark.createDataFrame(
        [("a", "2024-02-30", float("nan"), "7")], "transaction_id string, record_date string, "
        "revenue double, units_sold string")
    names = ("transaction_id", "record_date", "revenue", "units_sold")
    schema = type(STAGED_SALES)([f for f in STAGED_SALES.fields if f.name in names])
    assert tuple(one(tables.conform(df, schema).select(*names))) == ("a", None, None, 7)


def test_row_counts(spark):
    found = tables.row_counts({"x": spark.range(3), "y": spark.range(0), "z": None})
    assert rows(found) == [("x", 3, "OK"), ("y", 0, "EMPTY"), ("z", -1, "EMPTY")]


def write_raw(spark, path, changes):
    tables.write_csv(spark.createDataFrame([raw_row(**c) for c in changes], RAW_SALES), path)


def test_full_run_is_repeatable(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "run")
    write_raw(spark, raw, [
        *({"transaction_id": f"t{i}", "revenue": str(1000 + i)} for i in range(40)),
        {"transaction_id": "t0", "revenue": "7"}, {"transaction_id": "big", "revenue": "90000"},
        {"date": "x"},
    ])
    states = []
    for _ in range(2):
        result = jobs.run_all(spark, raw, root, DAY, loaded_at=dt.datetime(2024, 1, 1)).collect()
        assert [(r.stage, r.success) for r in result] == [(s, True) for s in jobs.STAGES]
        states.append(rows(jobs.table_counts(spark, jobs.RunFolder(root))))
    assert states[0] == states[1]
    assert [r.rejected for r in result] == [1, None, None, None]
    rejects = jobs.RunFolder(root).read(spark, "stg_sales_rejects")
    assert rows(rejects, "reject_reasons") == [(["INVALID_DATE"],)]
    counts = {name: n for name, n, _ in states[0]}
    assert counts["stg_sales_raw"] == 42 and counts["core_sales"] == 41
    assert counts["rpt_anomalies"] == 1
    report = jobs.RunFolder(root).read(spark, "report_anomaly_report")
    assert rows(report, "transaction_id", "anomaly_type") == [("big", "HIGH_REVENUE")]
    log = runlog.current_state(spark.read.parquet(f"{root}/pipeline_log"))
    assert {r.status for r in log.collect()} == {"Completed"}


def test_columns_of_the_file_order_copies_by_their_type(spark, tmp_path):
    raw, names = str(tmp_path / "raw"), (*RAW_SALES.fieldNames(), "l_partkey")
    copies = [(*raw_row(revenue=revenue), part) for revenue, part in (("10", "10"), ("9", "9"))]
    tables.write_csv(spark.createDataFrame(copies, ", ".join(f"{n} string" for n in names)), raw)
    kept = {}
    for kind in (None, {"l_partkey": "long"}):
        root = str(tmp_path / f"run-{kind is None}")
        results = jobs.run_all(
            spark, raw, root, DAY, order=("loaded_at", "l_partkey"), order_types=kind).collect()
        assert all(r.success for r in results)
        kept[kind is None] = rows(jobs.RunFolder(root).read(spark, "core_sales"), "revenue")
    assert kept == {False: [(D("9.00"),)], True: [(D("10.00"),)]}


def test_run_stops_at_the_failed_stage(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_raw(spark, raw, [{"revenue": "-1"}])
    result = jobs.run_all(spark, raw, str(tmp_path / "run"), DAY).collect()
    assert [(r.stage, r.success, r.records) for r in result] == [("ingest", False, 0)]
    result = jobs.run_all(spark, str(tmp_path / "none"), str(tmp_path / "run2"), DAY).collect()
    assert [(r.stage, r.success) for r in result] == [("ingest", False)]
    assert "none" in result[0].error


def test_missing_tables_count_minus_one(spark, tmp_path):
    counts = jobs.table_counts(spark, jobs.RunFolder(str(tmp_path / "nothing")))
    assert {n for _, n, _ in rows(counts)} == {-1} and len(GOOD_ROWS) == 3


def test_fact_is_pruned_and_filtered_at_the_scan(spark):
    df = Warehouse(spark, SF).sales("part").select("revenue", "channel")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "s_name" not in plan and "c_name" not in plan
