"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for each operator and stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ebbtide.llm import (
    chat, decontamination, exact_dedup, hyperminhash, jaccard_join, line_dedup, mixing, periodic_runs, personal_data, token_counts,
    toxicity, url_filter,
)
from ebbtide.llm.common import REST, running

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "This line is shared by many documents and it is long enough to count"
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id at all", "en", "a", 3), (4, "word " * 60_000, "en", "b", 5),
    (5, "same text here for two rows of it", "en", "a", 1), (6, "Same text here for two rows of it", "en", "a", 1),
    (6, "Same text here for two rows of it", "en", "a", 1), (None, None, None, None, None),
    *[(10 + i, f"own words {i}\n {LINE.upper()}\t\nmore", "en", "c", 9) for i in range(6)], (15, f"again {LINE}\n{LINE}", "en", None, 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(5, 1, 1), (4, 1, 0), (5, 1, 0), (None, 0, 1), (10, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{at}/labels.parquet"
    )
    spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "own words 3 that are not there")], "item_id long, text string").write.parquet(
        f"{at}/benchmark.parquet"
    )
    return at


def _path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _model(docs):
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    return toxicity.fit_toxicity(docs, labels)


OPERATORS = {
    "tokens": lambda d: token_counts.token_counts(d, _path()),
    "leaks": lambda d: decontamination.without_leaks(d, d.select(F.col("doc_id").alias("item_id"), F.lit(None).cast("string").alias("text"))),
    "personal": personal_data.personal_data,
    "toxicity": lambda d: toxicity.score_toxicity(d, _model(d)),
    "lines": line_dedup.line_dedup,
    "exact": exact_dedup.exact_dedup,
    "similar": jaccard_join.jaccard_join,
    "mix": mixing.mix,
    "runs": periodic_runs.periodic_runs,
    "near": hyperminhash.near_duplicates,
}
#: Names that operators use inside.
INTERNAL = (
    REST, "_row", "_any", "_email", "_id", "_new", "_lost", "_cold_key", "_hot_key", "_join_key", "hot_0", "cold_0", "join_0", "_name", "_rank",
    "_block", "_band", "_n", "_start", "_rate", "_place", "_offset", "_method", "_pages", "_scored", "found", "set", "n", "key", "run", "sid", "label",
    "copy", "rep", "h",
)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_comes_back_once_with_its_columns(docs, name):
    out = OPERATORS[name](docs)
    assert set(docs.columns) <= set(out.columns)
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_tables_and_clashing_columns(spark, docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []
    added = [c for c in OPERATORS[name](docs.limit(0)).columns if c not in docs.columns]
    clashing = docs.limit(3)
    for c in [*added, *INTERNAL]:
        clashing = clashing.withColumn(c, F.lit("theirs"))
    out = OPERATORS[name](clashing)
    rows = out.collect()
    assert len(rows) == 3 and len(out.columns) == len(set(out.columns))
    theirs = [c for c in INTERNAL if c not in added]
    assert {r[c] for r in rows for c in theirs} == {"theirs"} and set(docs.columns) <= set(out.columns)
    kept = lambda found: sorted((str(r["doc_id"]), str(r["lang"]), str(r["source"])) for r in found)
    assert kept(rows) == kept(clashing.collect())


def test_urls_and_chats_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/" + "x" * 200_000), (1, None), (None, "http://b.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    for c in (*INTERNAL, "verdict", "host", "suffix", "domain"):
        pages = pages.withColumn(c, F.lit("theirs"))
    out = url_filter.judged_urls(pages, none)
    rows = out.collect()
    assert len(rows) == 3 and {r[c] for r in rows for c in (*INTERNAL, "suffix", "domain")} == {"theirs"}
    assert sorted(len(r["path"]) for r in rows) == [0, 1, 200_001]
    chats = spark.createDataFrame([(1, "q", "a " * 100_000), (1, "q", "a " * 100_000), (2, None, None)], "conv_id long, prompt string, completion string")
    for c in ("_print", "held_0", "print_0", "turns_0", "turns_out", "layout"):
        chats = chats.withColumn(c, F.lit("theirs"))
    done = chat.formatted_chats(chats)
    got = done.withColumn("loss", chat.loss_text(F.col("pieces"))).collect()
    assert sorted(len(r["loss"]) for r in got) == [0, 200_000, 200_000] and {r["turns_out"] for r in got} == {"theirs"}
    assert [r["layout"] for r in got if r["conv_id"] == 2] == [None] and chat.formatted_chats(chats.limit(0)).count() == 0
    assert chat.turns_by_conversation(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_a_chat_with_a_stray_field_keeps_its_text(spark):
    rows = [(1, "q", "a", "stray"), (2, "q", "a", None), (3, None, None, "only")]
    frame = spark.createDataFrame(rows, "conv_id long, prompt string, completion string, input string")
    got = {r.conv_id: r for r in chat.formatted_chats(frame).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    for i in (1, 2):
        assert [(t.role, t.text) for t in got[i].back] == [("user", "q"), ("assistant", "a")] and got[i].layout == "prompt"
    assert got[1].unread == ["input"] and got[2].unread == [] and (got[3].layout, got[3].unread, got[3].back) == (None, ["input"], [])


def test_one_row_of_each_class_stays(spark):
    text = "the same eight words stand in this text here"
    rows = [(1, text), (1, text), (2, text + " too"), (None, text), (None, "quite another text without any id at all"), (5, ""), (5, ""), (None, None),
            (None, "quite another text without any id at all"), (6, "six other words of its own"), (6, "six more words of another kind")]
    out = jaccard_join.one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", F.lit("theirs")))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, text), (None, rows[4][1]), (5, ""), (5, ""), (None, None), rows[9], rows[10]], key=str)
    assert out.columns == ["doc_id", "text", "sid"]


def test_running_results_are_those_of_a_fold(spark):
    for n in (0, 1, 63, 64, 65, 4097, 5000):
        values = [(7 * i * i) % 101 for i in range(n)]
        row = spark.createDataFrame([(values,)], "v array<long>").select(
            running(F.col("v"), lambda a, b: a + b).alias("s"), running(F.col("v"), F.greatest).alias("m")).first()
        assert row.s == [sum(values[:i + 1]) for i in range(n)] and row.m == [max(values[:i + 1]) for i in range(n)]


def test_personal_data_in_a_very_long_text(spark):
    """Many entities and a term that gives one away, over a text of 300,000 words; overlapping spans are replaced together."""
    long = "word " * 150_000 + " quokka jane@corp.com " + "a@b.cd and more of it " * 3_000 + "word " * 130_000
    rows = [(1, long), (2, "call +4111 1111 1111 1111 now"), (3, "nothing here"), *[(10 + i, f"plain words {i}") for i in range(30)]]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in personal_data.personal_data(frame).collect()}
    assert len(out[1].email) == 3_001 and "quokka" not in out[1].sanitised and out[1].sanitised.count("[EMAIL]") == 3_001
    assert [long[s.start:s.end] for s in out[1].email[:2]] == ["jane@corp.com", "a@b.cd"] and "@" not in out[1].sanitised
    assert "1111" not in out[2].sanitised and out[3].sanitised == "nothing here"


def test_leaks_in_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "so Is it so? yes"), (3, "so Is it so? yes"), (None, "is it so")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Is it so?"), (1, "Is it so?"), (2, None), (3, ""), (4, "?!")], "item_id long, text string")
    found = decontamination.benchmark_leaks(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == sorted([("3", 1)] * 4 + [("None", 1)] * 2)
    assert decontamination.benchmark_leaks(docs.limit(0), items).count() == 0
    assert decontamination.benchmark_leaks(docs, items.limit(0)).count() == 0
    assert decontamination.without_leaks(docs, items).count() == 2


def test_lines_ties_and_missing_ids(docs):
    rows = line_dedup.line_dedup(docs).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r.n_lines, r.n_dropped) for r in by_id[10]] == [(3, 1)] and by_id[10][0].text == "own words 0\nmore"
    # The largest id keeps the line in all rows that repeat it.
    assert sorted((r.n_lines, r.n_dropped) for r in by_id[15]) == [(2, 0), (3, 0)]
    assert by_id[1][0].text == "" and by_id[1][0].n_lines == 1


def test_exact_ties_and_missing_ids(docs):
    rows = [r for r in exact_dedup.exact_dedup(docs).collect()]
    same = [r for r in rows if r.doc_id in (5, 6)]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in same} == {(5, 6, 3, False), (6, 6, 3, True)} and len(same) == 3
    empty = [r for r in rows if not r.text]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in empty} == {(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False)}


def test_similar_rows_and_rows_without_words(docs):
    rows = jaccard_join.jaccard_join(docs).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in rows if r.doc_id in (5, 6)} == {(5, 5, 2), (6, 5, 2)}
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in rows if not r.text)


def test_mix_is_the_same_again_and_bounded(spark, docs):
    once, again = (sorted(map(str, mixing.mix(d).select("doc_id", "source", "copies").collect())) for d in (docs, docs.repartition(7)))
    assert once == again
    many = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 37 as int)) AS text", "concat('s', cast(sqrt(id % 36) as int)) AS source")
    mixed = mixing.mix(many).groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size"), F.max("copies").alias("most")
    ).collect()
    assert sum(r.target for r in mixed) == pytest.approx(sum(r["size"] for r in mixed))
    assert all(abs(r.taken - r.target) <= 0.01 * r.target + 40 and r.most <= 3 for r in mixed)


def test_url_edges(spark):
    urls = [
        None, "", "no host", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org/en/17", "http://org", "http://xorg/", "http://x.com/fr/a",
        "http://x.com/de/", "ftp://h#f", "http://a.net?q=://b/c",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged_urls(pages, none).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow") and got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[5][2:] == ("example.org/en/1", "block")
    assert got[6] == ("org", "", None, "allow") and got[7] == ("xorg", "/", None, "allow")
    assert got[8][2:] == ("com/fr/", "allow") and got[9][2:] == ("com/de/", "block") and got[10] == ("h", "", None, "allow")
    assert got[11] == ("a.net", "", None, "allow")
    assert url_filter.judged_urls(pages.limit(0), none).count() == 0
    bad = pages.select("page_id", F.lit(1).alias("bad"))
    assert {r.verdict for r in url_filter.judged_urls(pages, bad).collect() if r.rule is None} == {"block"}


def test_chats_of_many_layouts_come_back(spark):
    turn = "struct<role: string, text: string>"
    frame = spark.createDataFrame(
        [
            (1, None, None, "hi \\ [INST] \\0", "</s>[ROLE]x[/ROLE]<s>", None, None),
            (2, [("human", "a"), ("gpt", None), (None, "c")], None, None, None, None, None),
            (3, None, [("user", "q"), ("assistant", "r <")], None, None, None, None),
            (4, None, None, None, None, "do", "done"), (5, None, None, None, "only half", None, None), (6, [], None, None, None, None, None),
        ],
        f"conv_id long, turns array<{turn}>, messages array<struct<role: string, content: string>>, prompt string, completion string, "
        "instruction string, output string",
    ).withColumn("formatted", F.lit("theirs"))
    done = chat.formatted_chats(frame).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("pieces")))
    got = {r.conv_id: r for r in done.collect()}
    turns = lambda i: [(t.role, t.text) for t in got[i].back]
    assert turns(1) == [("user", "hi \\ [INST] \\0"), ("assistant", "</s>[ROLE]x[/ROLE]<s>")] and got[1].layout == "prompt"
    assert turns(2) == [("user", "a"), ("assistant", ""), ("", "c")] and got[2].layout == "turns"
    assert turns(3) == [("user", "q"), ("assistant", "r <")] and got[3].loss == "r <"
    assert turns(4) == [("user", "do"), ("assistant", "done")] and got[4].layout == "task"
    assert got[5].layout is None and turns(5) == [] and turns(6) == [] and got[6].layout == "turns"
    start, end = got[3].loss_spans[0]
    assert got[3].formatted[start:end] == "r <"


def test_pipeline_stages_on_odd_rows(spark, docs, folder):
    left = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, folder)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        left = spark.createDataFrame(out.select(*docs.columns).collect(), SCHEMA)
    assert corpus_pipeline.run(spark, folder).count() > 0
