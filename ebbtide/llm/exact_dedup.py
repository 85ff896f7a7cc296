"""Exact duplicates by a grace hash.

Every task first folds equal texts of its own input together, so a text with a third of all copies leaves each
task once per full table. The folded records are dealt out by a hash of the content. A task then fills an
open-addressing table (a Python dict: open addressing, complete keys compared) up to a bound of content bytes.
Records whose content is in the table are folded into it; the others go to spill files by further bits of the hash, and
each file is treated in the same way, with other bits, until its distinct contents fit. Spill files are private to
the task, are deleted by it, and a task that is lost starts again from the shuffle.

Only one row per class comes out. Documents find their class by its digest, which is an output column anyway.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from ebbtide.llm.common import arrow_limits, join_hot, packed, stored, text_or_empty, unpacked

TABLE_BYTES = 48 << 20
FANOUT_BITS = 4
OUT_BYTES = 4 << 20

_PARTIAL = "h long, content binary, n long, largest long"
_CLASS = "digest binary, keep_id long, group_size long"


def normalised(text: bytes) -> bytes:
    """``bytes.lower`` changes A-Z and nothing else."""
    return text.lower()


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, list] = {}
    size = 0
    for batch in batches:
        for text, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = normalised(text)
            entry = held.get(text)
            if entry is None:
                held[text] = [1, doc]
                size += len(text) + 100
            else:
                entry[0] += 1
                entry[1] = _larger(entry[1], doc)
        if size > OUT_BYTES:
            yield _partials(held)
            held, size = {}, 0
    if held:
        yield _partials(held)


def _partials(held: dict[bytes, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in held], pa.int64()),
            pa.array(list(held), pa.binary()),
            pa.array([e[0] for e in held.values()], pa.int64()),
            pa.array([e[1] for e in held.values()], pa.int64()),
        ],
        ["h", "content", "n", "largest"],
    )


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int | None]]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))


def _spilled(file) -> Iterator[tuple[bytes, int, int | None]]:
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def grace_classes(
    records: Iterable[tuple[bytes, int, int | None]], folder: str, table_bytes: int = TABLE_BYTES, level: int = 0
) -> Iterator[tuple[bytes, int | None, int]]:
    """(content, largest id, rows) of every distinct content, in bounded memory."""
    held: dict[bytes, list] = {}
    size, spills = 0, {}
    try:
        for content, n, largest in records:
            entry = held.get(content)
            if entry is not None:
                entry[0] += n
                entry[1] = _larger(entry[1], largest)
            elif size < table_bytes:
                held[content] = [n, largest]
                size += len(content) + 100
            else:
                bits = xxhash.xxh3_64_intdigest(content, seed=level + 1) & ((1 << FANOUT_BITS) - 1)
                if bits not in spills:
                    spills[bits] = tempfile.TemporaryFile(dir=folder)
                pickle.dump((content, n, largest), spills[bits], protocol=5)
        for content, (n, largest) in held.items():
            yield content, largest, n
        held.clear()
        for bits in list(spills):
            with spills.pop(bits) as file:
                yield from grace_classes(_spilled(file), folder, table_bytes, level + 1)
    finally:
        for file in spills.values():
            file.close()


def _classes(table_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(dir=os.environ.get("TMPDIR")) as folder:
            rows: list[tuple] = []
            for content, largest, n in grace_classes(_records(batches), folder, table_bytes):
                rows.append((hashlib.sha256(content).digest(), largest, n))
                if len(rows) >= 5000:
                    yield _class_batch(rows)
                    rows = []
            if rows:
                yield _class_batch(rows)

    return run


def _class_batch(rows: list[tuple]) -> pa.RecordBatch:
    digests, keep, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(digests, pa.binary()), pa.array(keep, pa.int64()), pa.array(n, pa.int64())],
        ["digest", "keep_id", "group_size"],
    )


@arrow_udf(BinaryType())
def _digest(text: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(normalised(t)).digest() for t in text.to_pylist()], pa.binary())


def duplicate_classes(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: digest, the largest doc_id, and the number of rows."""
    arrow_limits(docs.sparkSession)
    rows = docs.select(text_or_empty().cast("binary").alias("t"), F.col("doc_id").cast("long").alias("d"))
    return rows.mapInArrow(_fold, _PARTIAL).repartition("h").mapInArrow(_classes(table_bytes), _CLASS)


def exact_dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The columns of ``docs`` and keep_id, group_size, kept, digest.

    Null texts count as empty. Texts are equal when identical after lower-casing A-Z. The largest doc_id of a
    class stays; rows that repeat that doc_id and text all stay, and null ids stay only where a class has no other.
    An empty table gives no rows. Columns of ``docs`` with the four names are replaced.
    """
    # Only classes of two rows or more are looked up; any other document is its own class.
    classes = stored(duplicate_classes(docs, table_bytes).where("group_size > 1"))
    needed = ["doc_id", "text"]
    marked = packed(docs, needed).withColumn("digest", _digest(text_or_empty().cast("binary")))
    spread = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")
    found = join_hot(marked, classes, "digest", "group_size", spread)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id").cast("long")).otherwise(F.col("keep_id"))
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    added = {"keep_id": keep, "group_size": size, "kept": F.col("doc_id").eqNullSafe(keep), "digest": F.col("digest")}
    return unpacked(found, docs, needed, added)
