from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ebbtide.config import ID, KIND, TIME
from ebbtide.functions.clock import parse_utc
from ebbtide.plans import stages


def test_day_first_dotted_and_fractional_times(spark):
    ten = datetime(2024, 1, 31, 10)
    forms = {
        "31/01/2024 10:00": (ten, ten), "31.01.2024": (datetime(2024, 1, 31),) * 2, "01/31/2024 10:00:00.5": (ten.replace(microsecond=500000),) * 2,
        "31/01/2024 10:00:00.25": (ten.replace(microsecond=250000),) * 2, "02/01/2024": (datetime(2024, 2, 1), datetime(2024, 1, 2)), "45/45/2024": (None, None),
    }
    df = spark.createDataFrame([(t,) for t in forms], "t string")
    rows = df.select("t", parse_utc(F.col("t")).alias("a"), parse_utc(F.col("t"), day_first=True).alias("b")).collect()
    assert {r.t: (r.a, r.b) for r in rows} == forms


def test_the_clean_stage_tells_null_from_unparsed_times(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(f"{ID},{TIME},{KIND}\n1,02/01/2024 10:00,order\n2,,order\n3,soon,order\n4,later,order\n")
    row = stages.clean_stage(spark, f"{tmp_path}/raw.csv", f"{tmp_path}/cleaned", day_first=True).first()
    assert (row.rows_after, row.null_times, row.unparsed_times) == (1, 1, 2) and row.first_event == datetime(2024, 1, 2, 10)
