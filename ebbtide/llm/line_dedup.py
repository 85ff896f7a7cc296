"""Lines that many documents share, found through a sharded minimal perfect hash.

Each document gives the 128-bit hashes of its distinct long lines. Hashes found in enough documents are cut into shards;
a shard is one row with a minimal perfect hash over its keys (levels of bit arrays, the rank of a bit being the place) and, in
that order, compact arrays: a 64-bit fingerprint, the number of documents, and the largest id. Documents send only hashes to
the shard, where they are probed in batches. A shard row is repeated as often as its number of probes asks for, and documents are
dealt to the copies by a hash of their id, so the probes of one very common line are spread. Nothing is broadcast and no lines are joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ebbtide.llm.common import BLANKS, arrow_limits, packed, stored, text_or_empty, unpacked

MIN_CHARS = 40
MIN_DOCS = 5
KEYS_PER_SHARD = 65_536
LEAST_SHARDS = 64
#: Probes that share one copy of a shard's row, and the most copies of one row.
PROBES_PER_COPY = 1 << 17
MOST_COPIES = 1 << 20
_STRIP = BLANKS.encode()
_GAMMA = 2.0
_MOST_LEVELS = 40


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The comparable form of a line, or None for a line that is too short to count."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _line_hashes(min_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column(1).to_pylist():
                own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}
                counts.append(len(own))
                found.extend(map(_hash, own))
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], ["doc_id", "h1", "h2"]
            )

    return run


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


class PerfectHash:
    """Places 0..n-1 for n distinct keys; other keys get some place or -1, which the fingerprint tells apart."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.rank = np.cumsum(bits, dtype=np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys, []
        while len(left) and len(levels) < _MOST_LEVELS:
            m = max(16, int(_GAMMA * len(left)))
            slot = (_mixed(left, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(slot, minlength=m) == 1
            levels.append(alone)
            left = left[~alone[slot]]
        return cls(
            np.array([len(x) for x in levels], np.int64), np.concatenate(levels) if levels else np.zeros(0, bool), np.sort(left)
        )

    def places(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.rank[at[hit]] - 1
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = int(self.bits.sum()) + at[hit]
        return out


_SHARD = "shard int, sizes binary, bits binary, rest binary, fingerprint binary, docs binary, largest binary"


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    h1 = rows["h1"].to_numpy(np.int64).view(np.uint64)
    mph = PerfectHash.build(h1)
    order = np.argsort(mph.places(h1), kind="stable")
    arrays = [
        mph.sizes.tobytes(), np.packbits(mph.bits).tobytes(), mph.rest.tobytes(),
        rows["h2"].to_numpy(np.int64)[order].tobytes(),
        np.minimum(rows["n"].to_numpy(np.int64)[order], 2**31 - 1).astype(np.int32).tobytes(),
        rows["largest"].to_numpy(np.int64)[order].tobytes(),
    ]
    return pd.DataFrame([[key[0], *arrays]], columns=[c.split()[0] for c in _SHARD.split(", ")])


class Shard:
    def __init__(self, sizes: bytes, bits: bytes, rest: bytes, fingerprint: bytes, docs: bytes, largest: bytes):
        lengths = np.frombuffer(sizes, np.int64)
        flat = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(lengths.sum())).astype(bool)
        self.mph = PerfectHash(lengths, flat, np.frombuffer(rest, np.uint64))
        self.fingerprint = np.frombuffer(fingerprint, np.int64)
        self.docs = np.frombuffer(docs, np.int32)
        self.largest = np.frombuffer(largest, np.int64)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is in the shard, and its place where it is."""
        place = self.mph.places(h1.view(np.uint64))
        known = place >= 0
        known[known] = self.fingerprint[place[known]] == h2[known]
        return known, place


def _probe(min_docs: int):
    """Rows come by shard and salt, the shard's own row first, then the probes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            cell = column["shard"].to_numpy(zero_copy_only=False).astype(np.int64) * MOST_COPIES + column["salt"].to_numpy(zero_copy_only=False)
            kind = column["kind"].to_numpy(zero_copy_only=False)
            docs = column["doc_id"]
            ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
            missing = docs.is_null().to_numpy(zero_copy_only=False)
            h1 = column["h1"].fill_null(0).to_numpy(zero_copy_only=False)
            h2 = column["h2"].fill_null(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((kind == 0) | np.concatenate([[True], cell[1:] != cell[:-1]]))
            hits = []
            for a, b in zip(cuts, [*cuts[1:], len(cell)]):
                if kind[a] == 0:
                    at = cell[a]
                    shard = Shard(*(column[n][int(a)].as_py() for n in ("sizes", "bits", "rest", "fingerprint", "docs", "largest")))
                    a += 1
                if a < b and at == cell[a]:
                    known, place = shard.probe(h1[a:b], h2[a:b])
                    drop = np.zeros(b - a, bool)
                    drop[known] = (shard.docs[place[known]] >= min_docs) & (missing[a:b][known] | (shard.largest[place[known]] != ids[a:b][known]))
                    hits.append(a + np.flatnonzero(drop))
            rows = pa.array(np.concatenate(hits)) if hits else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([docs.take(rows), column["h1"].take(rows)], ["doc_id", "h1"])

    return run


def _without(min_chars: int):
    @arrow_udf("struct<text: string, n_lines: long, n_dropped: long>")
    def run(text: pa.Array, lost: pa.Array) -> pa.Array:
        texts, lines, dropped = [], [], []
        for t, hashes in zip(text.to_pylist(), lost.to_pylist()):
            parts = t.split(b"\n")
            lines.append(len(parts))
            if hashes:
                gone = set(hashes)
                stay = [
                    p for p in parts
                    if (k := line_key(p, min_chars)) is None or int.from_bytes(_hash(k)[:8], "little", signed=True) not in gone
                ]
            else:
                stay = parts
            dropped.append(len(parts) - len(stay))
            texts.append(b"\n".join(stay) if hashes else t)
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            ["text", "n_lines", "n_dropped"],
        )

    return run


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The hashes of each document's lines, and the shards of the index over those in enough documents."""
    arrow_limits(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    hashes = stored(source.mapInArrow(_line_hashes(min_chars), "doc_id long, h1 long, h2 long"))
    counted = (
        hashes.distinct()
        .groupBy("h1", "h2").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("largest"))
        .where(F.col("n") >= min_docs)
    )
    counted = stored(counted)
    shards = max(LEAST_SHARDS, -(-counted.count() // KEYS_PER_SHARD))
    numbered = counted.withColumn("shard", F.expr(f"cast(pmod(h1, {shards}) as int)"))
    index = stored(numbered.groupBy("shard").applyInPandas(_build_shard, _SHARD))
    return hashes.withColumn("shard", F.expr(f"cast(pmod(h1, {shards}) as int)")), index


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns of ``docs`` with the text reduced, and n_lines (before) and n_dropped.

    Lines end at newlines. Keys of at least ``min_chars`` code points that at least ``min_docs`` different non-null ids hold
    lose all their lines except in the largest of those ids. A null or empty text is one empty line and comes out empty. Rows
    that repeat a doc_id count once; rows without an id are counted for no key and lose shared lines. Columns named n_lines
    and n_dropped are replaced.
    """
    hashes, index = shared_lines(docs, min_chars, min_docs)
    # One small row per shard, twelve bytes; there is a shard for each 65,536 shared lines.
    wanted = F.ceil(F.count(F.lit(1)) / PROBES_PER_COPY).cast("int")
    salts = stored(hashes.groupBy("shard").agg(F.least(wanted, F.lit(MOST_COPIES)).alias("copies")))
    dealt = hashes.join(F.broadcast(salts) if salts.count() <= MOST_COPIES else salts, "shard")
    # Rows without an id are dealt by the line: they are many, and one id.
    salt = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)) + F.when(F.col("doc_id").isNull(), F.col("h2")).otherwise(0), F.col("copies"))
    probes = dealt.select("shard", salt.cast("int").alias("salt"), F.lit(1).alias("kind"), "doc_id", "h1", "h2")
    copies = index.join(salts, "shard").select(*index.columns, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt")).withColumn("kind", F.lit(0))
    streams = probes.unionByName(copies, allowMissingColumns=True)
    hits = (
        streams.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_probe(min_docs), "doc_id long, h1 long")
        .groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("h1").alias("_lost"))
    )
    needed = ["doc_id", "text"]
    joined = packed(docs, needed).join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    made = joined.withColumn("_new", _without(min_chars)(text_or_empty().cast("binary"), F.col("_lost")))
    done = made.withColumn("text", F.col("_new.text"))
    return unpacked(done, docs, needed, {c: F.col(f"_new.{c}") for c in ("n_lines", "n_dropped")})
