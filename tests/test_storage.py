"""Readers, sinks, the monthly dataset, and the stages from file to file."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, MONTH, TIME, BoostedSettings, LinearSettings
from ebbtide.functions.clock import instant
from ebbtide.operators.activity import activity_filter, with_month
from ebbtide.operators.clean import STRICT
from ebbtide.plans import stages
from ebbtide.plans.queries import SHORT
from ebbtide.sources import sample_logs as logs
from ebbtide.sources import sinks
from ebbtide.sources.activity_store import load_events, months_between, write_by_month
from ebbtide.sources.readers import load_table, month_predicates, path_exists, read_feature_list, read_raw_csv, require_path

START, END = datetime(2000, 3, 15, 6), datetime(2000, 5, 2)


def rows_of(df):
    return sorted(map(tuple, df.select(ID, TIME, KIND).collect()))


@pytest.fixture(scope="module")
def activity(spark):
    return activity_filter(logs.long_log(spark, SMALL))


@pytest.fixture(scope="module")
def dataset(activity, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "by_month")
    write_by_month(activity, path)
    return path


def inside(activity):
    return rows_of(activity.filter((F.col(TIME) > instant(START)) & (F.col(TIME) <= instant(END))))


def test_month_list():
    assert months_between(datetime(2023, 11, 30), datetime(2024, 2, 1)) == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert months_between(START, START) == ["2000-03"]


def test_warehouse_reads_are_split_by_month():
    assert month_predicates("t", ["2023-12", "2024-01"]) == [
        "t >= '2023-12-01' AND t < '2024-01-01'", "t >= '2024-01-01' AND t < '2024-02-01'"]


def test_monthly_dataset_holds_every_row(spark, activity, dataset):
    stored = spark.read.parquet(dataset)
    assert rows_of(stored) == rows_of(activity)
    assert dict(stored.dtypes)[MONTH] in ("string", "date")
    write_by_month(activity.limit(10), dataset + "_again")
    write_by_month(activity.limit(20), dataset + "_again")
    assert spark.read.parquet(dataset + "_again").count() == 20


def test_window_is_loaded_with_pruning(spark, activity, dataset):
    loaded = load_events(spark, dataset, START, END)
    assert rows_of(loaded) == inside(activity)
    scan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "event_month" in scan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_date" in scan
    files = {r["f"] for r in spark.read.parquet(dataset).filter(F.col(MONTH).isin("2000-03", "2000-04", "2000-05"))
             .select(F.input_file_name().alias("f")).distinct().collect()}
    read = {r["f"] for r in loaded.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and read <= files


def test_dataset_with_bare_month_folders(spark, activity, tmp_path):
    # Stored with a zone, as other tools do: clock time is UTC only while the session says so.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        for month in ("2000-03", "2000-04", "2000-06"):
            chosen = with_month(activity).filter(F.col(MONTH) == month).drop(MONTH)
            chosen.withColumn(TIME, F.col(TIME).cast("timestamp")).write.parquet(f"{tmp_path}/bare/{month}")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    loaded = load_events(spark, f"{tmp_path}/bare", START, END, bare_folders=True)
    wanted = [r for r in inside(activity) if r[1] < datetime(2000, 5, 1)]
    assert rows_of(loaded) == wanted
    nothing = load_events(spark, f"{tmp_path}/bare", datetime(1999, 1, 1), datetime(1999, 2, 1), bare_folders=True)
    assert nothing.count() == 0


def test_single_file_stands_in_for_the_dataset(spark, activity, tmp_path):
    sinks.write_parquet(activity, f"{tmp_path}/one.parquet")
    assert rows_of(load_events(spark, f"{tmp_path}/none", START, END, f"{tmp_path}/one.parquet")) == inside(activity)
    with pytest.raises(FileNotFoundError):
        load_events(spark, f"{tmp_path}/none", START, END, f"{tmp_path}/nothing")


def test_loader_goes_by_the_ending(spark, tmp_path):
    df = spark.createDataFrame([("007", "a,\"b\""), (None, "x")], "k string, v string")
    sinks.write_csv(df, f"{tmp_path}/t.csv")
    sinks.write_parquet(df, f"{tmp_path}/t.pq")
    for name in ("t.csv", "t.pq"):
        assert sorted(map(tuple, load_table(spark, f"{tmp_path}/{name}").collect()), key=str) == sorted(
            map(tuple, df.collect()), key=str)
    with pytest.raises(ValueError):
        load_table(spark, f"{tmp_path}/t.xlsx")
    with pytest.raises(FileNotFoundError):
        require_path(spark, f"{tmp_path}/absent")
    assert path_exists(spark, f"{tmp_path}/t.csv") and not path_exists(spark, f"{tmp_path}/absent")


def test_raw_csv_reads_only_needed_columns(spark, tmp_path):
    sinks.write_csv(logs.raw_text_log(spark, SMALL), f"{tmp_path}/raw.csv")
    raw = read_raw_csv(spark, f"{tmp_path}/raw.csv")
    assert raw.columns == [ID, TIME, KIND, "channel", "shop"]
    assert "amount" not in raw._jdf.queryExecution().executedPlan().toString()
    assert raw.count() == 1000
    assert raw.filter(F.col(ID).isNull()).count() == 100
    with pytest.raises(ValueError):
        sinks.write_csv(raw.drop(KIND), f"{tmp_path}/short.csv")
        read_raw_csv(spark, f"{tmp_path}/short.csv")


def test_feature_list_keeps_its_order(spark, tmp_path):
    names = [f"f{i}" for i in range(40)]
    sinks.write_feature_list(spark, names, f"{tmp_path}/list")
    assert read_feature_list(spark, f"{tmp_path}/list") == names


@pytest.mark.parametrize("kind,settings", [
    ("boosted", BoostedSettings(rounds=3, depth=3, rows_per_leaf=5)), ("linear", LinearSettings(max_iterations=5))])
def test_stages_from_csv_to_scores(spark, tmp_path, kind, settings):
    at = {n: f"{tmp_path}/{n}" for n in ("raw.csv", "cleaned", "activity", "store", "model", "scores", "labelled")}
    sinks.write_csv(logs.raw_text_log(spark, SMALL), at["raw.csv"])
    with pytest.raises(FileNotFoundError):
        stages.activity_stage(spark, at["cleaned"], at["activity"])
    report = stages.clean_stage(spark, at["raw.csv"], at["cleaned"], STRICT, as_of=datetime(2030, 1, 1)).first()
    assert report["rows_before"] == 1000
    assert report["rows_after"] == report["rows_before"] - report["rows_dropped"] == spark.read.parquet(at["cleaned"]).count()
    kept = stages.activity_stage(spark, at["cleaned"], at["activity"]).first()
    assert 0 < kept["rows_after"] < kept["rows_before"]
    stages.month_stage(spark, at["activity"], at["store"])
    stages.label_stage(spark, at["activity"], at["labelled"], SHORT)
    assert spark.read.parquet(at["labelled"]).columns[-4:] == [
        SHORT.future_count, SHORT.target, "snapshot_time", "window_end"]
    model = stages.train_stage(spark, at["store"], at["model"], kind, SHORT, settings)
    scores = stages.score_stage(spark, at["model"], at["cleaned"], at["activity"], at["scores"], SHORT)
    customers = spark.read.parquet(at["cleaned"]).select(ID).distinct().count()
    assert scores.count() == scores.select(ID).distinct().count() == customers
    assert scores.filter("churn_probability < 0 OR churn_probability > 1").count() == 0
    text = spark.read.option("header", True).csv(at["scores"] + "/csv")
    assert text.count() == customers and text.columns == scores.columns
    meta = spark.read.json(at["model"] + "/train_meta").first()
    assert (meta["model"], meta["n_features"]) == (kind, len(model.features))
    limits = spark.read.json(at["model"] + "/bucket_thresholds").first()
    assert limits["threshold_very_high"] == 0.8
    assert spark.read.option("header", True).csv(at["model"] + "/rolling_eval").count() > 1
