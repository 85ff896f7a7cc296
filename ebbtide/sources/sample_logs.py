"""Interaction logs derived from the star-schema test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import CHANNEL, ID, KIND, SHOP, TIME

RAW_AS_OF = datetime(2024, 1, 25)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def long_log(spark: SparkSession, folder: str) -> DataFrame:
    """Years of events at midnight: orders, and order lines as mail and session events."""
    orders = table(spark, folder, "orders")
    # Orders in progress stay in the log; their kind is no activity.
    status = F.when(F.col("o_orderstatus") == "P", "order_in_progress").otherwise("order")
    placed = orders.select(F.col("o_custkey").cast("string").alias(ID), F.col("o_orderdate").alias(TIME), status.alias(KIND))
    flag, shipped = F.col("l_returnflag"), F.col("l_linestatus") == "O"
    kind = (
        F.when(flag == "N", F.when(shipped, "emarsys_open").otherwise("emarsys_click"))
        .when(flag == "A", F.when(shipped, "emarsys_sessions_view").otherwise("emarsys_sessions_cart_update"))
        .when(flag == "R", F.when(shipped, "emarsys_soft_bounce").otherwise("emarsys_sessions_unlisted"))
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_shipdate").alias(TIME), kind.alias(KIND))
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias(ID))
    return placed.unionByName(lines.join(owners, "l_orderkey").select(ID, TIME, KIND))


def _short_kind():
    event = F.col("event_type")
    return (
        F.when(event == "view", "emarsys_sessions_view")
        .when(event == "click", "emarsys_click")
        .when(event == "purchase", "order")
        .when(event == "signup", "emarsys_unsub")
        .when(event == "error", "emarsys_hard_bounce")
    )


def short_log(spark: SparkSession, folder: str) -> DataFrame:
    """A month of events with times of day."""
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias(ID), F.col("ts").alias(TIME), _short_kind().alias(KIND)
    )


def keyed_short_log(spark: SparkSession, folder: str) -> DataFrame:
    """The short log with the key of each event."""
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias(ID), F.col("ts").alias(TIME), _short_kind().alias(KIND), "event_id"
    )


def registered_customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias(ID))


def raw_text_log(spark: SparkSession, folder: str) -> DataFrame:
    """The short log as untidy text, as a CSV file would hold it; the last digit of the event id picks the flaw."""
    flaw = F.pmod("event_id", F.lit(10))
    user = F.col("user_id").cast("string")
    text_time = F.col("ts").cast("string")
    return table(spark, folder, "events").select(
        F.when(flaw == 1, " ").when(flaw == 2, "null").when(flaw == 3, " None").when(flaw == 4, F.concat(F.lit("\t U"), user))
        .otherwise(user).alias(ID),
        F.when(flaw == 5, "bad").when(flaw == 6, F.concat(text_time, F.lit("Z")))
        .when(flaw == 7, F.concat(text_time, F.lit("+02:00"))).otherwise(text_time).alias(TIME),
        F.when(flaw == 8, F.concat(F.lit(" "), F.upper(_short_kind()), F.lit("\t"))).otherwise(_short_kind()).alias(KIND),
        F.when(flaw == 9, " EMAIL ").otherwise("web").alias(CHANNEL),
        F.when(flaw == 0, " NaN ").otherwise(" Shop A").alias(SHOP),
        F.col("value").cast("string").alias("amount"),
        F.when(F.col("event_type") == "error", "outgoing").otherwise("incoming").alias("incoming_outgoing"),
    )


def day_first_text_log(spark: SparkSession, folder: str) -> DataFrame:
    """The short log with times such as 31/01/2024 10:00:05; some rows have no time or a text that is none."""
    flaw = F.pmod("event_id", F.lit(10))
    written = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias(ID),
        F.when(flaw == 1, "soon").when(flaw == 2, "").when(flaw == 3, F.date_format("ts", "dd/MM/yyyy hh:mm a"))
        .when(flaw == 4, F.date_format("ts", "dd.MM.yyyy")).otherwise(written).alias(TIME),
        _short_kind().alias(KIND),
    )


def broken_log(spark: SparkSession, folder: str) -> DataFrame:
    """The short log as lines of a CSV file under their header; some rows have a cell too many and some are cut in two."""
    flaw = F.pmod("event_id", F.lit(10))
    text_time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    cells = [
        F.col("user_id").cast("string"), F.when(flaw == 2, F.concat(F.lit("on\n"), text_time)).otherwise(text_time),
        _short_kind(), F.when(flaw == 1, "web"),
    ]
    line = F.explode(F.split(F.concat_ws(",", *cells), "\n"))
    return table(spark, folder, "events").select(line.alias(",".join((ID, TIME, KIND))))


def write_lines(lines: DataFrame, path: str) -> None:
    """A column of lines, its name as the header of each file."""
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """A warehouse fact table with a direction: order lines, those returned being outgoing."""
    direction = F.when(F.col("l_returnflag") == "R", "outgoing").otherwise("incoming")
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(ID),
        F.col("l_shipdate").alias(TIME),
        F.col("l_linestatus").alias(KIND),
        direction.alias("incoming_outgoing"),
    )
