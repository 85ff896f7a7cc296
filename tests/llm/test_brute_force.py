"""Operators without an SQL form against plain versions over whole small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL

from ebbtide.llm import decontamination, exact_dedup, jaccard_join, line_dedup, personal_data, queries, toxicity

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()}


def test_token_counts_are_the_librarys(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    from ebbtide.llm.token_counts import Lengths

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t, add_special_tokens=False)) for i, t in texts.items()}
    rows = queries.all_queries()["op1_token_counts"](spark, MEDIUM).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)
    odd = ["it's I'll a.b ... x. 'S é́ ́b Σας \x1c\x85 \xa0x <|endoftext|> <|startoftext|>hi 日本語、。 12,34. a.́", "", " \n", "a\x00b"]
    small = Lengths(path, {b"the": 1}, room=3)
    for _ in range(2):
        assert small.count_all([t.encode() for t in odd]) == [len(library.encode(t, add_special_tokens=False)) for t in odd]


def test_leaks_are_all_found_and_nothing_else(spark, texts):
    plain = lambda t: " ".join(t.split())
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()}
    want = {(i, j) for i, t in texts.items() for j, item in items.items() if item in plain(t)}
    rows = queries.all_queries()["op2_decontamination"](spark, MEDIUM).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and want
    for r in rows:
        inside = plain(texts[r.doc_id][r.start:r.end])
        # Marks of the document may hang on its last word.
        assert inside.rstrip("*#$%&") in items[r.item_id] and len(inside) >= 0.8 * len(items[r.item_id])


def test_changed_numbers_and_names_are_found_if_they_are_consistent():
    item = "if the farmer Anna has 12 apples and gives 5 apples to Tom how many of the 12 apples are left"
    bench, templates = decontamination.Benchmark([(1, item)]), decontamination.Templates()
    found = lambda t: decontamination.leaks_of(t.encode(), bench, templates, 0.5, 20)
    same = found("so " + item + " ok")
    changed = found("so " + item.replace("12", "40").replace("Anna", "Maria").replace("5", "7"))
    assert [x[3] for x in same] == ["same"] and [x[3] for x in changed] == ["changed"]
    # One value cannot stand for two.
    assert found("so " + item.replace("12 apples are", "31 apples are")) == []
    assert found("the farmer has apples and gives some away so how many are left in the end") == []


def test_a_name_behind_a_part_of_the_passage_does_not_hide_it():
    item = "the farmer Anna has 12 apples and gives all of them back to Anna once more"
    bench, templates = decontamination.Benchmark([(1, item)]), decontamination.Templates()
    text = "the farmer Anna has 12 apples and gives all of them back to"
    found = decontamination.leaks_of(f"{text} Bob, who left".encode(), bench, templates, 0.5, 20)
    assert [(x[3], x[4], x[5]) for x in found] == [("same", 0, len(text))]


def test_items_of_numbers_are_found_with_their_own_values_only():
    item = "3 + 4 = 7 and 12 + 30 = 42 and 8 + 9 = 17 and 100 + 5 = 105"
    bench, templates = decontamination.Benchmark([(7, item)]), decontamination.Templates()
    found = lambda t: [x[0] for x in decontamination.leaks_of(t.encode(), bench, templates, 0.5, 20)]
    assert found("sums are " + item + " as shown") == [7]
    assert found("sums are " + item.replace("3", "2").replace("5", "6").replace("9", "8") + " as shown") == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _plain_spans(text: str) -> dict:
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if _passes(k, m.group())] for k, p in PATTERNS.items()}


def test_base_spans_are_those_of_the_patterns(spark, texts):
    rng = random.Random(3)
    odd = ["".join(rng.choice("a.b_@+-12 3(90).%é😀\n") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    odd += ["a@b.c_d@e.f", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "9" * 30000, "1 " * 20000, "a." * 20000 + "@x.y", "x@" + "a." * 20000 + "b"]
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for r in personal_data.personal_data(frame).collect():
        assert {k: [(s.start, s.end) for s in r[k]] for k in PATTERNS} == _plain_spans(odd[r.doc_id])
    for r in queries.all_queries()["op3_personal_data"](spark, MEDIUM).collect():
        want = ",".join(f"{k}:{a}:{b}" for k, found in _plain_spans(texts[r.doc_id]).items() for a, b in found)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.spans.startswith(want)


def test_terms_that_give_an_entity_away_are_marked_only_beside_it(spark):
    rows = [(i, f"intro {c * 3} word {c * 4} agent quokka mail jane@corp.com or call later {c * 5}") for i, c in enumerate("abcdef")]
    rows += [(100 + i, "other plain mail word or call about a thing") for i in range(60)] + [(200, "the quokka agent sleeps")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in personal_data.personal_data(frame).collect()}
    assert {s.value for s in out[0].term} == {"quokka", "later"} | ({"agent"} & {s.value for s in out[0].term})
    assert "mail" in out[0].sanitised and "quokka" not in out[0].sanitised and "[EMAIL]" in out[0].sanitised
    assert out[200].term == [] and out[200].sanitised == "the quokka agent sleeps"


def test_similarity_classes_are_those_of_all_pairs(spark, texts):
    sets = {}
    for i, text in texts.items():
        w = text.encode().lower().split()
        n = min(5, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            holders[token].append(i)
    links, parent = Counter(), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for t in s for j in holders[t] if j > i).items():
            if both >= 0.8 * (len(s) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = {i: (find(i), links[i]) for i in sets}
    rows = queries.all_queries()["op8_jaccard_join"](spark, MEDIUM).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == want and sum(links.values()) > 50


def test_large_groups_of_near_copies_lose_no_link(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    docs = []
    for i in range(160):
        own = list(words)
        own[rng.randrange(120)] = f"x{i}"
        docs.append((i, " ".join(own)))
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = jaccard_join.jaccard_join(frame).collect()
    shingles = {i: {tuple(t.split()[k:k + 5]) for k in range(116)} for i, t in docs}
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    want = {i: sum(near(shingles[i], shingles[j]) for j in shingles if j != i) for i in shingles}
    assert {r.doc_id: r.n_links for r in rows} == want
    assert {r.class_id for r in rows} == {0}


def test_grace_hash_is_whole_when_it_must_spill_many_times(tmp_path):
    rng = random.Random(1)
    pool = [bytes(rng.choices(b"abcdef", k=rng.randint(0, 40))) for _ in range(400)]
    records = [(rng.choice(pool), rng.randint(1, 3), rng.choice([None, rng.randint(0, 999)])) for _ in range(5000)]
    want: dict = {}
    for content, n, largest in records:
        have = want.setdefault(content, [0, None])
        have[0] += n
        have[1] = exact_dedup._larger(have[1], largest)
    got = list(exact_dedup.grace_classes(iter(records), str(tmp_path), table_bytes=700))
    assert len(got) == len(want) and {c: [n, k] for c, k, n in got} == want
    assert list(tmp_path.iterdir()) == []


def test_perfect_hash_gives_each_key_its_own_place():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 5000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        places = line_dedup.PerfectHash.build(keys).places(keys)
        assert sorted(places.tolist()) == list(range(len(keys)))


def test_marginals_are_those_of_all_taggings():
    theta = np.linspace(-1.5, 1.2, toxicity._N)
    n, at, codes = 7, np.array([1, 2, 5]), np.array([3, 10, 4])
    x = dict(zip(at.tolist(), toxicity.features(at, codes)))

    def weight(tags):
        total, last = 0.0, 0
        for i, t in enumerate(tags):
            if t:
                total += theta[toxicity.INSIDE if last else toxicity.INTO] + (x[i] @ theta if i in x else theta[toxicity.PLAIN])
            elif last:
                total += theta[toxicity.OUT]
            last = t
        return np.exp(total)

    taggings = [[k >> i & 1 for i in range(n)] for k in range(2**n)]
    weights = np.array([weight(t) for t in taggings])
    want = [sum(w for w, t in zip(weights, taggings) if t[i]) / weights.sum() for i in at]
    assert np.allclose(toxicity.Tagger(theta).marginals(n, at, codes), want)
    one = toxicity.Sample([(n, at.tolist(), codes.tolist(), 1)])
    assert np.isclose(one.log_z(theta), np.log(weights.sum()))
    gold = [1 if i in x else 0 for i in range(n)]
    assert np.isclose(one.gold @ theta, np.log(weight(gold)))


def test_toxicity_ranks_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.all_queries()["op5_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    better = np.mean([[(a > b) + 0.5 * (a == b) for b in clean] for a in toxic])
    assert better > 0.9 and np.mean([r.predicted == r.toxic for r in rows]) > 0.97


def test_short_items_are_found_at_every_place_of_a_sentence(spark):
    """Items cut to 1 to 12 words, behind a small letter, behind a name, at the start, and with other names and numbers."""
    rng = random.Random(8)
    words = "Mary buys 5 apples and Tom has 3 pears of the 12 kg that Anna sold".split()
    for n in range(1, 13):
        item = " ".join(words[:n]) + "."
        bench, templates = decontamination.Benchmark([(1, item)]), decontamination.Templates()
        found = lambda t: [x[0] for x in decontamination.leaks_of(t.encode(), bench, templates, 0.5, 20)]  # noqa: B023, E731
        for before in ("", "so ", "Question - ", "It is said. ", "as Peter said: "):
            assert found(f"{before}{item} And that is all") == [1], (before, item)
        assert n > 5 or found(item.lower()) == [1]
        assert found("nothing of that kind is ever told to any child here") == []
        # From four words on other names and numbers are found too; shorter items count with their own values only.
        other = item.replace("Mary", "Susan").replace("Tom", "Old Bill").replace("5", str(rng.randint(20, 99)))
        assert found(f"they say {other} Good") == ([1] if n >= 4 else []), other
