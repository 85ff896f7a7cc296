"""Months that are replaced, tallies that are updated, tables by customer, sketches, the order of day and month, and broken rows."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, MONTH, TIME
from ebbtide.operators import ranking
from ebbtide.operators.activity import activity_filter
from ebbtide.operators.clean import clean_events, flagged_events
from ebbtide.operators.features import customer_features
from ebbtide.operators.quality import log_quality
from ebbtide.operators.sampling import sampled_customers
from ebbtide.operators.scoring import weak_signal
from ebbtide.plans import stages
from ebbtide.sources import sample_logs as logs
from ebbtide.sources import tally_store
from ebbtide.sources.activity_store import drop_months, load_events, replace_months, write_by_month
from ebbtide.sources.customer_store import write_by_customer
from ebbtide.sources.readers import MALFORMED, quarantine, read_checked_csv, whole_rows

SNAPSHOT = datetime(1998, 9, 1)


@pytest.fixture(scope="module")
def activity(spark):
    log = activity_filter(logs.long_log(spark, SMALL)).where((F.year(TIME) >= 1998) & (F.year(TIME) <= 1999))
    return log.cache()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.select(ID, TIME, KIND).collect()))


def test_a_month_is_replaced_and_no_other_file_is_touched(spark, activity, tmp_path):
    path = f"{tmp_path}/months"
    write_by_month(activity, path)
    files = lambda: {p.name: p.stat().st_mtime_ns for m in tmp_path.joinpath("months").glob(f"{MONTH}=*") if not m.name.endswith("1998-06") for p in m.iterdir()}
    before = files()
    june = (F.col(TIME) >= "1998-06-01") & (F.col(TIME) < "1998-07-01")
    replace_months(activity.where(june & (F.col(KIND) == "order")), path)
    assert files() == before
    assert rows_of(spark.read.parquet(path)) == rows_of(activity.where(~june | (F.col(KIND) == "order")))
    window = load_events(spark, path, datetime(1998, 5, 20), datetime(1998, 6, 10))
    assert MONTH in plan_of(window).split("PartitionFilters")[1].split("]")[0]
    drop_months(spark, path, ["1998-06"])
    assert spark.read.parquet(path).where(june).count() == 0


def test_tallies_are_brought_up_to_date_from_the_changed_months_only(spark, activity, tmp_path):
    store, months = f"{tmp_path}/store", f"{tmp_path}/months"
    late = (F.to_date(TIME) == date(1998, 3, 3)) | (F.col(TIME) > "1998-08-20")
    tally_store.build_store(activity.where(~late), store, time())
    write_by_month(activity, months)
    log = spark.read.parquet(months)
    dates = tally_store.dates_of(activity.where(late & (F.col(TIME) <= SNAPSHOT)))
    changed = tally_store.changed_months(dates)
    assert changed == ["1998-03", "1998-08"]
    read = {r["f"] for r in tally_store.events_in(log, changed).select(F.input_file_name().alias("f")).distinct().collect()}
    assert {f.split(f"{MONTH}=")[1][:7] for f in read} == set(changed)
    for _ in range(2):  # once more changes nothing
        tally_store.refresh_months(log, store, changed)
        got = tally_store.stored_features(spark, store, SNAPSHOT).collect()
    want = customer_features(activity, SNAPSHOT).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got
    tally_store.refresh_months(log.where(F.col(MONTH) != "1998-03"), store, ["1998-03"])
    left = spark.read.parquet(f"{store}/tallies").select(F.date_format("event_date", "yyyy-MM").alias("m")).distinct()
    assert "1998-03" not in {r["m"] for r in left.collect()}
    with pytest.raises(ValueError):
        tally_store.stored_features(spark, store, SNAPSHOT + timedelta(hours=1))


def test_tables_by_customer_need_no_exchange(spark, activity, tmp_path):
    names = [f"{n}_{abs(hash(str(tmp_path)))}" for n in ("log", "known")]
    log = write_by_customer(activity, names[0], f"{tmp_path}/log", 4)
    known = write_by_customer(logs.registered_customers(spark, SMALL), names[1], f"{tmp_path}/known", 4)
    features = customer_features(log, SNAPSHOT, together=True)
    assert "Exchange" not in plan_of(features)
    assert sorted(map(tuple, features.collect())) == sorted(map(tuple, customer_features(activity, SNAPSHOT).collect()))
    assert sorted(r[ID] for r in weak_signal(known, log, SNAPSHOT).collect()) == sorted(
        r[ID] for r in weak_signal(logs.registered_customers(spark, SMALL), activity, SNAPSHOT).collect())


def test_a_sample_reads_the_log_once(spark, activity, tmp_path):
    activity.write.parquet(f"{tmp_path}/log")
    plan = plan_of(sampled_customers(spark.read.parquet(f"{tmp_path}/log"), 20))
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan


def test_sketches_keep_their_error_on_skewed_values(spark):
    n = 60_000
    skewed = spark.range(n).select((F.col("id") % 7).alias("part"), F.pow(F.rand(3), 12).alias("v")).cache()
    sketches = ranking.quantile_sketches(skewed, "v", ["part"])
    shares = (0.05, 0.4, 0.7, 0.9, 0.99)
    found = ranking.sketched_quantiles(sketches, shares, tuple(f"p{i}" for i in range(5))).first()
    assert found["n_rows"] == n
    for i, share in enumerate(shares):
        rank = skewed.where(F.col("v") <= found[f"p{i}"]).count() / n
        assert abs(rank - share) <= ranking.sketch_error()
    some = ranking.sketched_quantiles(sketches.where("part < 2"), (0.5,), ("mid",)).first()
    assert abs(skewed.where((F.col("part") < 2) & (F.col("v") <= some["mid"])).count() / some["n_rows"] - 0.5) <= ranking.sketch_error()


def _raw(spark, times):
    return spark.createDataFrame([(str(i), t, "order") for i, t in enumerate(times)], f"{ID} string, {TIME} string, {KIND} string")


def test_a_log_decides_which_number_is_the_day(spark, tmp_path):
    day_first = _raw(spark, ["05/01/2024 10:00", "31/01/2024 10:00", "2024-02-01", None])
    assert [r[TIME] for r in clean_events(day_first, day_first=None).orderBy(ID).collect()] == [
        datetime(2024, 1, 5, 10), datetime(2024, 1, 31, 10), datetime(2024, 2, 1)]
    both = _raw(spark, ["05/01/2024", "31/01/2024", "01/31/2024"])
    assert [r[TIME] for r in clean_events(both, day_first=None).orderBy(ID).collect()][0] == datetime(2024, 5, 1)
    (tmp_path / "raw.csv").write_text(f"{ID},{TIME},{KIND}\n1,05/01/2024,order\n2,31/01/2024,order\n3,,order\n4,soon,order\n")
    report = stages.clean_stage(spark, f"{tmp_path}/raw.csv", f"{tmp_path}/cleaned").first()
    assert (report.day_first, report.ambiguous_times, report.null_times, report.unparsed_times, report.rows_after) == (True, 1, 1, 1, 2)
    assert report.last_event == datetime(2024, 1, 31) and report.first_event == datetime(2024, 1, 5)


def test_accounting_reads_the_log_once(spark, tmp_path):
    logs.raw_text_log(spark, SMALL).write.parquet(f"{tmp_path}/raw")
    flagged = flagged_events(spark.read.parquet(f"{tmp_path}/raw"))
    plan = plan_of(log_quality(flagged, {"clean": F.col("is_clean")}, {"clean": "x"}))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_rows_with_other_numbers_of_cells_are_set_apart(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(f'{ID},{TIME},{KIND}\n1,2024-01-01,order\n2,2024-01-02\n3,2024-01-03,order,web\n4,"a,b",order\n')
    checked = read_checked_csv(spark, f"{tmp_path}/raw.csv")
    assert sorted(r[ID] for r in whole_rows(checked).collect()) == ["1", "4"]
    bad = quarantine(checked, f"{tmp_path}/bad").orderBy("first_cell").collect()
    assert [(r["first_cell"], r[MALFORMED], r["file_name"]) for r in bad] == [
        ("2", "2,2024-01-02", "raw.csv"), ("3", "3,2024-01-03,order,web", "raw.csv")]
