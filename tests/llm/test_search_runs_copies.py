"""Ranked search, periodic runs and near duplicates on word pairs against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import hyperminhash, lexical_search, periodic_runs, queries

MEDIUM = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def _plain_ranking(docs, items, k=10):
    listed = [(i, TERM.findall(_lower(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in listed), sum(len(t) for _, t in listed)
    df = Counter(t for _, own in listed for t in set(own))
    wanted = defaultdict(set)
    for i, text in items:
        wanted[i].update(TERM.findall(_lower(text)))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, found in listed:
            tf, score = Counter(found), 0
            m = 10 + (90 * len(found) * n_docs) // max(1, n_terms)
            for t in own & set(tf):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("small", [False, True])
def test_search_is_the_plain_ranking_with_ties_and_blocks(spark, monkeypatch, small):
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(["Alpha", "beta", "b3ta", "né", "x-y", "日本", "the", "THE"]) for _ in range(n))
    docs = [(rng.randrange(40) if rng.random() < 0.9 else None, say(rng.choice([0, 1, 3, 3, 12]))) for _ in range(300)] + [(7, None)]
    items = [(i, say(rng.randint(0, 5))) for i in range(30)] + [(3, say(4)), (None, say(2)), (99, None)]
    if small:
        for name, value in (("BLOCK_BYTES", 900), ("ITEM_TILE", 4), ("DOC_TILE", 16), ("TERM_TILE", 2)):
            monkeypatch.setattr(lexical_search, name, value)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    d, b = d.withColumn("score", F.lit("theirs")), b.withColumn("term", F.lit("theirs"))
    assert _rows(lexical_search.lexical_search(d.repartition(5), b)) == _plain_ranking(docs, items)
    assert lexical_search.lexical_search(d.limit(0), b).count() == 0
    assert lexical_search.lexical_search(d, b.limit(0)).count() == 0


def test_tiles_are_exact_and_keep_ties():
    weights = np.array([44_000] * 10)
    assert lexical_search.exact_width(weights) * 44_000 * 10**6 < 2**53
    # Other widths and weights beyond any corpus still leave a product below the bound.
    assert lexical_search.exact_width(np.array([10**9])) == 9
    best = lexical_search.Best(1, 3)
    for start in range(0, 40, 8):
        ids = np.arange(start, start + 8)[::-1]
        best.add(np.full((8, 1), 5, np.int64), np.zeros(8, np.int64), ids)
    best.cut()
    assert best.rows[3].tolist() == [0, 1, 2]


def _plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            part = w[start:start + length]
            if length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


def test_runs_are_those_of_all_periods():
    rng = random.Random(1)
    texts = []
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5, 20])
        w = [b"%d" % rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n > 10:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 4))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        texts.append(w)
    want = [_plain_runs(w) for w in texts]
    assert [periodic_runs.runs_of(w) for w in texts] == want and sum(map(len, want)) > 500
    assert periodic_runs.runs_of_texts(texts) == want
    assert periodic_runs.runs_of_texts(texts, prune=False) == want


def test_runs_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, "a " * 7), (None, "x y\n" * 5), (4, "b " + "a " * 50_000), (5, "a a a b b b"), (6, "k l m n " * 5 + "z z z z z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("RUNS", F.lit("x")).withColumn("found_0", F.lit("theirs"))
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "found_0", "n_runs", "runs", "collapsed"]
    got = {(r.doc_id, r.text): r for r in out.withColumn("best", periodic_runs.strongest(F.col("runs"))).collect()}
    runs = {k: [tuple(x) for x in r.runs] for k, r in got.items()}
    assert [runs[r] for r in rows] == [[], [], [(0, 7, 1)], [(0, 10, 2)], [(1, 50_000, 1)], [], [(0, 20, 4), (20, 6, 1)]]
    assert [got[r].collapsed for r in rows] == ["", "", "a", "x y", "b a", "a a a b b b", "k l m n z"]
    assert tuple(got[rows[6]].best) == (20, 6, 1) and got[rows[5]].best is None and {r.found_0 for r in got.values()} == {"theirs"}
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def _plain_components(texts):
    sets = {}
    for i, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
        sets[i] = frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)
    holders, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sorted(sets.items()):
        for j, both in Counter(j for x in s for j in holders[x]).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_are_those_of_all_pairs(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    want = _plain_components(texts)
    rows = queries.all_queries()["op13_hyperminhash"](spark, MEDIUM).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == want and len(rows) == len(want)
    assert sum(not kept for *_, kept in want.values()) > 50


@pytest.mark.parametrize("words, changed", [(5, 1), (9, 1), (60, 4), (400, 20)])
def test_groups_of_near_copies_of_any_length(spark, monkeypatch, words, changed):
    """Chains: the ends of a group share far less than the threshold, and only neighbours are linked."""
    rng = random.Random(words)
    docs = []
    for group in range(6):
        own = [f"g{group}w{rng.randrange(10**6)}" for _ in range(words)]
        for i in range(40):
            docs.append((len(docs), " ".join(own)))
            for _ in range(rng.choice([0, changed, 2 * changed])):
                own = [*own]
                own[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
    rng.shuffle(docs)
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    monkeypatch.setattr(hyperminhash, "STAR", 3)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sid", F.lit("theirs")).withColumn("set_0", F.lit("theirs"))
    rows = hyperminhash.near_duplicates(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == _plain_components(docs)
    assert {(r.sid, r.set_0) for r in rows} == {("theirs", "theirs")}


def test_near_duplicates_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, None), (4, "word " * 60_000), (5, "Word word"), (6, "one"), (6, "ONE"), (None, "one"), (None, "left alone"), (9, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("KEPT", F.lit("theirs"))
    out = hyperminhash.near_duplicates(docs)
    assert sorted(out.columns) == sorted(["doc_id", "text", "n_shingles", "component_id", "kept"])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=str)
    want = [
        (1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (6, 1, 6, True),
        (None, 1, 6, False), (None, 1, None, True), (9, 1, 9, True),
    ]
    assert got == sorted(want, key=str)
    assert hyperminhash.near_duplicates(docs.limit(0)).count() == 0


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([rng.permutation(a)[:3600], rng.integers(0, 2**64, 400, dtype=np.uint64)]))
    c = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    held = np.array([hyperminhash.registers(np.sort(s)) for s in (a, b, c)])
    assert (held > 0).all()
    share = (held[0] == held[1]).mean()
    assert abs(share - 3600 / 4400) < 0.12 and (held[0] == held[2]).mean() < 0.05
    assert hyperminhash.likely(held[0], held[1:], len(a), np.array([len(b), len(c)])).tolist() == [True, False]
    assert hyperminhash.missed(0.8) < 1e-5
