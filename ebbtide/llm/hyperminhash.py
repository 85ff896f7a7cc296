"""Near duplicates on word pairs by HyperMinHash.

A document is the set of its hashed two-word shingles; documents with equal sets are one node. The first bits of a hash choose one of 256
buckets, and a bucket's register is its smallest hash in short: the count of leading zeros and the next ten bits. Six registers each
make a band, and nodes with an equal band meet. Bands without an element in either of their registers say nothing and are left out, so short texts meet by
the few registers they have. At a similarity of 0.8 a pair has no band in common with a chance of 3e-6 (``missed``).

Within a band's group one node, the smallest, is the pivot of the others. Most near copies are joined by those stars, which take rows in
proportion to the members, however large the group. Groups that are still of several components then compare, in blocks, all pairs of
different components. A pair is first estimated from its registers, with the expected chance collisions of the shortened
values taken off and six deviations of room, and then confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ebbtide.llm.common import arrow_limits, join_hot, packed, stored, text_or_empty, unpacked
from ebbtide.llm.jaccard_join import WordHashes, _groups, _mixed, _roots, components, shared_counts

THRESHOLD = 0.8
BUCKET_BITS, MANTISSA_BITS = 8, 10
REGISTERS = 1 << BUCKET_BITS
BAND = 6
BANDS = REGISTERS // BAND
#: Deviations below the threshold from which an estimated pair is confirmed.
SLACK = 6.0
#: Members that share one copy of their pivot, and members of a block.
STAR, BLOCK = 1024, 256
#: A fixed value of the method: chance collisions of registers of equally large sets, per register and 2^-MANTISSA_BITS.
COLLISIONS = 0.169919487159739093975315012348

_STEP = np.uint64(0x9E3779B97F4A7C15)


def missed(similarity: float = THRESHOLD) -> float:
    """The chance that a pair of large sets has no band in common."""
    return (1 - similarity**BAND) ** BANDS


def pair_shingles(text: bytes, words: WordHashes) -> np.ndarray:
    """Distinct hashes of the pairs of neighbouring words, sorted; a single word is one shingle."""
    listed = text.lower().split()
    if not listed:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, listed), np.uint64, len(listed))
    return np.unique(_mixed(h[:-1] * _STEP + h[1:]) if len(h) > 1 else _mixed(h + _STEP))


def registers(shingles: np.ndarray) -> np.ndarray:
    """Of sorted hashes: for each bucket leading zeros and mantissa of its smallest hash, 0 where it has none."""
    out = np.zeros(REGISTERS, np.uint16)
    bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = (shingles[first] << np.uint64(BUCKET_BITS)) | np.uint64(1 << (BUCKET_BITS - 1))
    mantissa, exponent = np.frexp(rest.astype(np.float64))
    short = ((mantissa - 0.5) * (2 << MANTISSA_BITS)).astype(np.int64)
    out[bucket[first]] = ((66 - exponent.astype(np.int64)) << MANTISSA_BITS) | short
    return out


def bands(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of registers: the name of each band, and whether it has an element."""
    cut = held[:, :BANDS * BAND].reshape(len(held), BANDS, BAND).astype(np.uint64)
    name = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, cut.shape[:2])
    for i in range(BAND):
        name = _mixed(name * np.uint64(3) + cut[:, :, i])
    return name.view(np.int64), cut.any(axis=2)


def likely(own: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which of ``others`` (rows of registers) may have the similarity with ``own``, by corrected estimate and size."""
    equal = ((others == own) & (own != 0)).sum(axis=1)
    used = ((others != 0) | (own != 0)).sum(axis=1)
    ratio = sizes / size
    chance = COLLISIONS * 2.0**-MANTISSA_BITS * used * 4 * ratio / (1 + ratio) ** 2
    least = threshold * used - SLACK * np.sqrt(threshold * (1 - threshold) * used)
    return (equal - chance >= least) & (np.minimum(sizes, size) >= threshold * np.maximum(sizes, size) - 1e-9)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


_RECORD = "doc_id long, row long, size long, sid binary, registers binary"


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        sets = [pair_shingles(t, words) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ],
            [c.split()[0] for c in _RECORD.split(", ")],
        )


def _band_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        name, full = bands(_matrix(batch.column(1).to_pylist()))
        row, band = np.nonzero(full)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(name[row, band])], ["node", "k"])


def _matrix(held: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(held), np.uint16).reshape(-1, REGISTERS)


def _pivoted(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[dict, dict]]:
    """(pivot, member) of each member row, as rows come sorted by group with the pivot first."""
    pivot: dict = {"group": None}
    for batch in batches:
        names = ("group", "node", "head", "size", column) if "size" in batch.schema.names else ("group", "node", "head", column)
        for values in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
            row = dict(zip(names, values))
            if row["head"]:
                pivot = row
            elif row["group"] == pivot["group"]:
                yield pivot, row


def _pairs_of(rows: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    kinds = {"head": pa.bool_()}

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) if held else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names)], names)

    for row in rows:
        held.append(row)
        if len(held) >= 20_000:
            yield batch()
            held = []
    yield batch()


_PLACE = "node long, group long, head boolean"


def _likely_stars(threshold: float) -> Callable:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        told = None
        for pivot, member in _pivoted(batches, "registers"):
            own, other = _matrix([pivot["registers"]])[0], _matrix([member["registers"]])
            if likely(own, other, pivot["size"], np.array([member["size"]]), threshold)[0]:
                if told != pivot["group"]:
                    told = pivot["group"]
                    yield pivot["node"], told, True
                yield member["node"], told, False

    return lambda batches: _pairs_of(rows(batches), ["node", "group", "head"])


def is_linked(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, threshold: float) -> np.ndarray | bool:
    """Shares at least ``threshold`` of the union; in whole numbers where the threshold is a whole percentage."""
    percent = round(100 * threshold)
    if abs(percent - 100 * threshold) < 1e-9:
        return 100 * both >= percent * (a + b - both)
    return both >= threshold * (a + b - both)


def _star_links(threshold: float) -> Callable:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for pivot, member in _pivoted(batches, "tokens"):
            a, b = np.frombuffer(pivot["tokens"], np.uint64), np.frombuffer(member["tokens"], np.uint64)
            at = np.searchsorted(a, b)
            at[at == len(a)] = 0
            if is_linked(int((a[at] == b).sum()), len(a), len(b), threshold):
                yield member["node"], pivot["node"]

    return lambda batches: _pairs_of(rows(batches), ["node", "root"])


def _likely_rest(threshold: float) -> Callable:
    """Of groups with several components: sets of nodes that have a likely partner in another one, each pair in its first common band."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for g in _groups(batches, ["group", "k", "node", "label", "blk", "cross", "size", "registers"]):
            held, size = _matrix(g["registers"]), np.array(g["size"], np.int64)
            label, block, n = np.array(g["label"]), np.array(g["blk"]), len(size)
            near = np.zeros((n, n), bool)
            for i in range(n):
                apart = label[i + 1:] != label[i]
                if g["cross"][0]:
                    apart &= block[i + 1:] != block[i]
                rest = i + 1 + np.flatnonzero(apart)
                if len(rest):
                    near[i, rest] = likely(held[i], held[rest], int(size[i]), size[rest], threshold)
            a, b = np.nonzero(near)
            if not len(a):
                continue
            name, full = bands(held)
            first = np.argmax((name[a] == name[b]) & full[a] & full[b], axis=1)
            later = name[a, first] != g["k"][0]
            near[a[later], b[later]] = False
            near |= near.T
            roots = _roots(near)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                yield g["node"][i], xxhash.xxh3_64_intdigest(b"%d %d" % (g["group"][0], roots[i])) - (1 << 63), False

    return lambda batches: _pairs_of(rows(batches), ["node", "group", "head"])


def _rest_links(threshold: float) -> Callable:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for g in _groups(batches, ["group", "node", "tokens"]):
            own = dict(zip(g["node"], g["tokens"]))  # rows that repeat an id and its text come twice
            nodes, sets = list(own), [np.frombuffer(t, np.uint64) for t in own.values()]
            if len(nodes) > 1:
                size = np.array([len(s) for s in sets])
                linked = is_linked(shared_counts(sets), size[:, None], size[None, :], threshold) & ~np.eye(len(sets), dtype=bool)
                for i, root in enumerate(_roots(linked).tolist()):
                    if root != i:
                        yield nodes[i], nodes[root]

    return lambda batches: _pairs_of(rows(batches), ["node", "root"])


_WHOLE = "node long, group long, head boolean, tokens binary"


def _whole_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, node, sid, places) -> a row with the whole set for each place where it is needed."""
    words = WordHashes()
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    for batch in batches:
        out = []
        for text, node, sid, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
            found = pair_shingles(text, words)
            if _digest(found) == sid:  # else another text under the same id
                tokens = found.tobytes()
                out += [(node, p["group"], p["head"], tokens) for p in places]
        for a in range(0, max(1, len(out)), 256):
            columns = list(zip(*out[a:a + 256])) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "group", "head", "tokens"])


def _confirmed(places: DataFrame, texts: DataFrame, nodes: DataFrame, links: Callable) -> DataFrame:
    """(node, root): the pairs that ``links`` confirms on whole sets, whose texts are read again."""
    needed = places.groupBy("node").agg(F.collect_list(F.struct("group", "head")).alias("places"))
    wanted = needed.join(nodes.select("node", "sid", F.col("row").alias("at")), "node")
    whole = texts.join(wanted, F.col("row") == F.col("at")).select("t", "node", "sid", "places").mapInArrow(_whole_sets, _WHOLE)
    grouped = whole.repartition("group").sortWithinPartitions("group", F.desc("head"))
    return grouped.mapInArrow(links, "node long, root long")


def _stars(keys: DataFrame, buckets: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Places (node, group, head) of likely pairs of a node and a pivot; a pivot is repeated for each ``STAR`` of its members."""
    met = join_hot(keys, buckets, "k", "n", F.xxhash64("node", F.lit("row"))).where("n > 1 and pivot <> node")
    edges = stored(met.select("node", "pivot").distinct())
    # A pivot may have a third of all nodes.
    members = stored(edges.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")))
    sized = join_hot(edges, members, "pivot", "members", F.xxhash64("node", F.lit("row")))
    dealt = sized.withColumn("group", F.xxhash64("pivot", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / STAR))))
    heads = dealt.select(F.col("pivot").alias("node"), "group").distinct().withColumn("head", F.lit(True))
    members = dealt.select("node", "group", F.lit(False).alias("head")).unionByName(heads)
    full = members.join(nodes.select("node", "size", "registers"), "node")
    return full.repartition("group").sortWithinPartitions("group", F.desc("head")).mapInArrow(_likely_stars(threshold), _PLACE)


def _rest(keys: DataFrame, nodes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Places of nodes that may be linked to another component of a group of theirs.

    The members of the group's largest component are in blocks of their own, which never meet each other.
    """
    named = keys.join(labels.withColumnRenamed("sid", "node"), "node", "left").select("node", "k", F.coalesce("label", "node").alias("label"))
    by_label = named.groupBy("k", "label").agg(F.count(F.lit(1)).alias("n"))
    open_buckets = stored(
        by_label.groupBy("k").agg(F.sum("n").alias("n"), F.max_by("label", "n").alias("main"), F.max("n").alias("n_main"))
        .where("n > n_main and n > 2")
        .select("k", "n", "main", F.ceil(F.col("n_main") / BLOCK).alias("mains"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK).alias("others"))
    )
    met = join_hot(named, open_buckets, "k", "n", F.xxhash64("node", F.lit("row"))).where("n is not null")
    is_main = F.col("label") == F.col("main")
    count = F.when(is_main, F.col("mains")).otherwise(F.col("others"))
    block = F.pmod(F.xxhash64("node", F.lit("block")), count) + F.when(is_main, F.col("others")).otherwise(0)
    placed = met.withColumn("blk", block)
    # Other blocks meet all, the largest component's only those.
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains"))
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), last - 1)))
    grouped = paired.select(
        "node", "label", "k", "blk", (F.col("blk") != F.col("with")).alias("cross"),
        F.xxhash64("k", F.least("blk", "with"), F.greatest("blk", "with")).alias("group"),
    )
    full = grouped.join(nodes.select("node", "size", "registers"), "node")
    return full.repartition("group").sortWithinPartitions("group").mapInArrow(_likely_rest(threshold), _PLACE)


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, sid) of each row of ``docs``, and (sid, copies, component_id) of each set that is not alone."""
    arrow_limits(docs.sparkSession)
    text = text_or_empty().cast("binary")
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.xxhash64(text)).alias("row"), text.alias("t"))
    records = stored(texts.mapInArrow(_records, _RECORD))
    full = records.where("size > 0")
    # A set has a short name; its row is where the text is found again.
    counted = full.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    sets = full.select("sid", "size", "registers").dropDuplicates(["sid"]).join(counted, "sid")
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()))
    keys = stored(nodes.select("node", "registers").mapInArrow(_band_rows, "node long, k long"))
    buckets = stored(keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).where("n > 1"))
    places = stored(_stars(keys, buckets, nodes, threshold))
    links = stored(_confirmed(places, texts, nodes, _star_links(threshold)))
    joined = components(links.withColumnRenamed("node", "sid"))
    met = keys.join(buckets.where("n > 2").select("k"), "k", "left_semi")
    rest = stored(_rest(met, nodes, joined, threshold))
    if not rest.isEmpty():
        more = stored(_confirmed(rest, texts, nodes, _rest_links(threshold)))
        joined = components(links.unionByName(more).withColumnRenamed("node", "sid"))
    named = nodes.select("node", "sid", "rep", "copies").join(joined.withColumnRenamed("sid", "node"), "node", "left")
    alone = named.where("label is null and copies > 1").select("sid", "copies", F.col("rep").alias("component_id"))
    smallest = named.where("label is not null").groupBy("label").agg(F.min("rep").alias("component_id"))
    several = named.where("label is not null").join(smallest, "label").select("sid", "copies", "component_id")
    return records.select("doc_id", F.col("size").alias("n_shingles"), "sid"), stored(alone.unionByName(several))


_SET = StructType([StructField("n_shingles", LongType()), StructField("sid", BinaryType())])


@arrow_udf(_SET)
def _set_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    words = WordHashes()
    for part in parts:
        sets = [pair_shingles(t, words) for t in part.to_pylist()]
        yield pa.StructArray.from_arrays(
            [pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())], ["n_shingles", "sid"]
        )


def with_components(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Adds component_id and kept to rows that have a doc_id and a set's name; a set may belong to a third of the rows."""
    spread = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("row")).cast("binary")))
    found = join_hot(rows, told, "sid", "copies", spread)
    number = F.col("doc_id").cast("long")
    component = F.when(F.col("copies").isNull(), number).otherwise(F.col("component_id"))
    return found.withColumn("component_id", component).withColumn("kept", number.eqNullSafe(F.col("component_id"))).drop("copies")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` and n_shingles, component_id, kept.

    The set of a document holds its pairs of neighbouring words, with A-Z lower-cased and ASCII white space between words; a single word is
    one shingle, and a null or empty text has none: it is linked with nothing and its own component. component_id is the smallest doc_id that links of
    similarity ``threshold`` or more reach, kept says that it is the row's own. Null ids are never the smallest, and a component of rows
    without ids has none, which they keep. Rows that repeat an id are rows of their own, equal rows are equally kept. An empty table gives no rows.
    Columns of ``docs`` with the three names are replaced.
    """
    _, told = near_classes(docs, threshold)
    needed = ["doc_id", "text"]
    named = packed(docs, needed, set=_set_of(text_or_empty().cast("binary")))
    rows = named.withColumns({"n_shingles": F.col("set.n_shingles"), "sid": F.col("set.sid")}).drop("set")
    return unpacked(with_components(rows, told), docs, needed, {c: F.col(c) for c in ("n_shingles", "component_id", "kept")})
