"""Input that is not in the usual form is read, or fails aloud; nothing vanishes without a word."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, TIME
from ebbtide.functions.clock import parse_utc
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.snapshots import calendar_of
from ebbtide.plans import stages
from ebbtide.plans.queries import SHORT
from ebbtide.sources import sample_logs as logs
from ebbtide.sources.activity_store import write_by_month
from ebbtide.sources.readers import read_raw_csv


def test_times_in_other_forms_are_read(spark):
    ten = datetime(2024, 1, 31, 10)
    forms = {
        "2024/01/31 10:00:00": ten, "01/31/2024 10:00": ten, "20240131": datetime(2024, 1, 31), "2024-01-31 10:00 +0200": datetime(2024, 1, 31, 8),
        "01/31/2024 10:00 PM": datetime(2024, 1, 31, 22), "2024-01-31T10:00:00Z": ten, "2024-01-31 10:00:00": ten, "2024-01-31": datetime(2024, 1, 31),
        "no time": None, "": None, "13/45/2024": None,
    }
    df = spark.createDataFrame([(t,) for t in forms], "t string").select("t", parse_utc(F.col("t")).alias("p"))
    assert {r.t: r.p for r in df.collect()} == forms


def test_activity_stage_respells(spark, tmp_path):
    rows = [("a", datetime(2024, 1, 1), " Order "), ("b", datetime(2024, 1, 2), "ORDER"), ("c", datetime(2024, 1, 2), "other")]
    spark.createDataFrame(rows, f"{ID} string, {TIME} timestamp_ntz, {KIND} string").write.parquet(f"{tmp_path}/cleaned")
    stages.activity_stage(spark, f"{tmp_path}/cleaned", f"{tmp_path}/activity")
    assert {r[ID] for r in spark.read.parquet(f"{tmp_path}/activity").collect()} == {"a", "b"}


def test_files_with_other_headers_fail_and_cells_may_span_lines(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir()
    two.mkdir()
    (one / "a.csv").write_text(f"{ID},{TIME},{KIND}\n1,2024-01-01,order\n")
    (one / "b.csv").write_text(f"{KIND},{TIME},{ID}\norder,2024-01-01,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(one)).collect()
    (two / "a.csv").write_text(f'{ID},{TIME},{KIND}\n1,2024-01-01,"or\nder"\n2,2024-01-02,order\n')
    assert [r[KIND] for r in read_raw_csv(spark, str(two), multi_line=True).collect()] == ["or\nder", "order"]


def test_training_reads_only_the_months_it_needs(spark, tmp_path):
    write_by_month(activity_filter(logs.long_log(spark, SMALL)), f"{tmp_path}/months")
    log = spark.read.parquet(f"{tmp_path}/months")
    calendar = calendar_of(log.select(ID, TIME, KIND), SHORT, 4)
    needed = stages.needed_events(log, calendar, SHORT)
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert 0 < needed.count() < log.count()
