"""What the operators share: input columns, stored intermediate tables, joins with a hot key, Arrow limits."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import ensure_checkpoint_folder

#: White space of the contracts: the six ASCII characters, nothing else.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with at least this part of all rows is hot, so there are at most this many hot keys.
HOT_KEYS = 1000
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000

_folders: dict[int, str] = {}


def arrow_limits(spark: SparkSession) -> None:
    """Bounds the batches sent to Python by bytes, as texts may be very long. A setting of the user's stays."""
    for key, value in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
    ):
        if spark.conf.get(key, "7") == "7":
            spark.conf.set(key, str(value))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session is gone; the folder belongs to the shared scratch space
        return


def scratch(spark: SparkSession) -> str:
    """A folder of this session inside the shared checkpoint folder; it goes when the driver's Python ends."""
    key = id(spark.sparkContext)
    if key not in _folders:
        ensure_checkpoint_folder(spark)
        base = spark.sparkContext.getCheckpointDir().rstrip("/")
        _folders[key] = f"{base}/ebbtide-llm-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _folders[key])
    return _folders[key]


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors, with column pruning."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The column that carries what an operator doesn't look at.
REST = "rest_of_row"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


_WIDTH = 64


def running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """Running results of ``combine`` (a sum, a maximum) over a list of longs, in time that grows with its length.

    Lists can't be appended to in place, so a plain fold would copy what it has for each element. Here blocks of 64 are folded, then
    their last values in the same way, and each block is combined with what lies before it.
    """
    def fold(block: Column) -> Column:
        add = lambda acc, n: F.array_append(acc, F.coalesce(combine(F.try_element_at(acc, F.lit(-1)), n), n))
        return F.aggregate(block, F.array().cast("array<long>"), add)

    def blocked(listed: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(listed) - 1) / _WIDTH).cast("int")), lambda b: F.slice(listed, b * _WIDTH + 1, _WIDTH))
        return let(F.transform(cut, fold), lambda inner: let(
            running(F.transform(inner, lambda p: F.element_at(p, -1)), combine, levels - 1),
            lambda ends: F.flatten(F.transform(inner, lambda p, i: F.when(i == 0, p).otherwise(
                let(F.element_at(ends, i), lambda before: F.transform(p, lambda x: combine(before, x)))))),
        ))

    if levels == 0:
        return fold(values)
    return let(values, lambda listed: F.when(F.size(listed) <= _WIDTH, fold(listed)).otherwise(blocked(listed)))


def packed(docs: DataFrame, needed: list[str], **more: Column) -> DataFrame:
    """``needed`` columns, ``more`` computed ones, and all others in one struct, so that no name of theirs meets one of the operator's."""
    others = [c for c in docs.columns if c not in needed]
    rest = F.struct(*[F.col(f"`{c}`").alias(c) for c in others]) if others else F.lit(None).cast("string")
    return docs.select(*needed, *[c.alias(n) for n, c in more.items()], rest.alias(REST))


def unpacked(done: DataFrame, docs: DataFrame, needed: list[str], added: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` in their order, but for those that ``added`` replaces, and then the added ones."""
    replaced = {n.lower() for n in added}
    kept = [c for c in docs.columns if c.lower() not in replaced]
    return done.select(
        *[F.col(c) if c in needed else F.col(REST).getField(c).alias(c) for c in kept], *[c.alias(n) for n, c in added.items()]
    )


def fresh(taken: Iterable[str], *stems: str) -> list[str]:
    """For each stem a column name that isn't taken."""
    used = {t.lower() for t in taken}
    return [next(n for i in range(len(used) + 1) if (n := f"{stem}_{i}") not in used) for stem in stems]


def join_hot(left: DataFrame, right: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """Left join on ``key`` when one key may hold a third of the left rows.

    ``right`` has one row per key and in ``size`` the left rows of that key. Keys with at least one
    ``HOT_KEYS``-th of all rows number at most ``HOT_KEYS`` and are broadcast; the others are
    shuffled, and rows that are already matched are dealt out by ``spread``, which must not look like a key.
    ``right`` should be a stored table, as it is read three times. Its columns beside the key replace those of ``left``.
    """
    names = [c for c in right.columns if c != key]
    hot_key, cold_key, join_key, hot_row, cold_row = fresh([*left.columns, *right.columns], "hot", "cold", "join", "hot_row", "cold_row")
    total = right.agg(F.coalesce(F.sum(size), F.lit(0)).alias("t")).first()["t"]
    is_hot = F.col(size) * F.lit(HOT_KEYS) >= F.lit(total)
    row = F.struct(*names)
    hot = right.where(is_hot).select(F.col(key).alias(hot_key), row.alias(hot_row))
    cold = right.where(~is_hot).select(F.col(key).alias(cold_key), row.alias(cold_row))
    first = left.join(F.broadcast(hot), F.col(key) == F.col(hot_key), "left")
    keyed = first.withColumn(join_key, F.when(F.col(hot_key).isNull(), F.col(key)).otherwise(spread))
    both = keyed.join(cold, F.col(join_key) == F.col(cold_key), "left")
    found = F.coalesce(F.col(hot_row), F.col(cold_row))
    return both.select(
        *[F.col(f"`{c}`") for c in left.columns if c not in names], *[found.getField(c).alias(c) for c in names],
    )
