"""Cases that an operator once left out."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from ebbtide.llm import decontamination, jaccard_join, personal_data, queries, url_filter


def _marked(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in personal_data.personal_data(frame).collect()}


def test_a_term_beside_an_entity_of_one_context_is_marked(spark):
    texts = ["the zebrafish keeper writes from ann@corp.com every day"]
    texts += [f"the keeper writes about thing {chr(97 + i // 26) * 4}{chr(97 + i % 26)} every day" for i in range(80)]
    out = _marked(spark, texts)
    assert {"zebrafish"} <= {s.value for s in out[0].term} and not {"the", "keeper", "writes", "every", "day"} & {s.value for s in out[0].term}
    assert "zebrafish" not in out[0].sanitised and all(out[i].term == [] for i in range(1, len(texts)))


def test_copies_do_not_hide_what_discloses_an_entity(spark):
    own = [f"note {w} zebrafish mail ann@corp.com or call {w}" for w in ("alpha", "bravo", "carol")]
    others = [f"note about call and mail {chr(97 + i // 26) * 4}{chr(97 + i % 26)}" for i in range(300)]
    for copies in (1, 20):
        out = _marked(spark, own * copies + others)
        assert "zebrafish" in {s.value for s in out[0].term} and "mail" not in {s.value for s in out[0].term}


def test_the_personal_data_query_carries_the_sanitised_text(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: (hashlib.sha256(r.sanitised.encode()).hexdigest(), len(r.sanitised)) for r in personal_data.personal_data(docs).collect()}
    rows = queries.all_queries()["op3_personal_data"](spark, folder).collect()
    assert {r.doc_id: (r.sanitised_sha256, r.sanitised_chars) for r in rows} == want


def test_sketches_and_runs_together_keep_the_recall():
    pair = np.ones((2, jaccard_join.HASHES), np.uint16)
    pair[1, :27] = 2  # 37 of 64 places are equal
    row = {"sid": [1, 2], "group": [5, 5], "run": [0, 0], "blk": [0, 0], "cross": [False, False], "size": [100, 100], "seen": [[7], [7]]}
    batch = pa.RecordBatch.from_pydict({**row, "sketch": [x.tobytes() for x in pair]})
    assert sum(b.num_rows for b in jaccard_join._likely(0.8)(iter([batch]))) == 2
    runs = jaccard_join.runs_for(jaccard_join.RECALL)
    met = 1 - (1 - 0.8**jaccard_join.LEVELS) ** runs
    assert met * (1 - jaccard_join.sketch_miss(0.8)) >= jaccard_join.RECALL and jaccard_join.sketch_miss(0.8) < 1e-6


def test_domains_are_below_public_suffixes_and_without_ports(spark):
    want = {
        "a.shop.co.uk": ("shop.co.uk", "co.uk"), "shop.com.au": ("shop.com.au", "com.au"), "x.school.nsw.edu.au": ("school.nsw.edu.au", "nsw.edu.au"),
        "co.uk": ("co.uk", "co.uk"), "w.a.com:8080": ("a.com", "com"), "me:x@w.a.com": ("a.com", "com"), "a.com.": ("a.com", "com"), "org": ("org", "org"),
        "10.1.2.3:80": ("10.1.2.3", "(address)"), "[::1]:80": ("[::1]", "(address)"), "": ("", ""), "w.example.org": ("example.org", "org"),
    }
    frame = spark.createDataFrame([(h,) for h in want], "host string")
    rows = frame.select("host", url_filter.domain_of(frame.host).alias("d"), url_filter.suffix_of(frame.host).alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in rows} == want


def _leaks(item, text):
    bench, templates = decontamination.Benchmark([(1, item)]), decontamination.Templates()
    return decontamination.leaks_of(text.encode(), bench, templates, 0.5, 20)


def test_one_inconsistent_value_does_not_hide_a_long_copy():
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    words[5] = words[30] = "12"
    item = " ".join(words)
    copy = " ".join(words[:30] + ["31"] + words[31:])
    assert [(x[1], x[3], x[4], x[5]) for x in _leaks(item, f"so {copy} ok")] == [(58, "changed", 3, 3 + len(copy))]


def test_a_question_rich_in_names_is_found_with_other_values():
    item = "If Anna Braun Sells 12 Red Apples for 30 Euro and Tom Stein Buys 5 of Them with 40 Euro then Anna Braun Has 12 Euro"
    new = item.replace("Anna Braun", "Maria Lang").replace("Tom Stein", "Otto Berg").replace("12", "17").replace("30", "80").replace("Apples", "Plums")
    assert [x[0] for x in _leaks(item, f"so {new} ok")] == [1]
    assert [x[0] for x in _leaks(item, f"so {item} ok")] == [1]
