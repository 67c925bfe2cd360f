import random
from collections import defaultdict

import numpy as np
import pytest

from hardcourt.llm import order_minhash as om
from hardcourt.llm import suffix_dedup as sd
from hardcourt.llm.components import components
from hardcourt.llm.words import words
from tests.llm.fixtures import SF, docs, texts


def classes_by_force(rows):
    parent = {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(a, b):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)

    first, grams = {}, {}
    for i, t in sorted(rows):
        w = tuple(words(t)) or ("raw", t or "")
        if w in first:
            join(first[w], i)
        else:
            first[w] = i
            grams[i] = om.kmers(words(t))
    ids = sorted(grams)
    holds = defaultdict(set)
    for i in ids:
        for g in set(grams[i].tolist()):
            holds[g].add(i)
    for p, q in {(p, q) for h in holds.values() for p in h for q in h if p < q}:
        a, b = grams[p], grams[q]
        both = lcs(a.tolist(), b.tolist())
        if both >= 0.8 * (len(a) + len(b) - both) - 1e-9:
            join(p, q)
    return {i: top(i) for i, _ in rows}


def lcs(a, b):
    if abs(len(a) - len(b)) > 0.25 * max(len(a), len(b)) or len({*a} & {*b}) < 0.5 * min(len(a), len(b)):
        return 0
    past = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(past[j] + 1 if x == y else max(row[-1], past[j + 1]))
        past = row
    return past[-1]


def near_copies(seed=5):
    rnd, rows = random.Random(seed), []
    for base in texts(seed, 12):
        w = base.split(" ")
        for edits in (0, 0, 1, 2, 3, 5, 8, 20):
            v = w[:]
            for _ in range(edits):
                v[rnd.randrange(len(v))] = f"new{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(v)))
    return rows + [(1000 + k, t) for k, t in enumerate(texts(99, 40))]


def test_near_duplicates_by_force(spark):
    rows = near_copies() + [(2000, None), (2001, ""), (2002, "!!!"), (2003, "!!!"), (2004, "one two"), (2005, "One, two!")]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == classes_by_force(rows)


@pytest.mark.parametrize(("block", "stragglers"), [(512, 4096), (2, 0)])
def test_large_buckets_are_searched_by_blocks(spark, monkeypatch, block, stragglers):
    monkeypatch.setattr(om, "SMALL", 3)
    monkeypatch.setattr(om, "BLOCK", block)
    monkeypatch.setattr(om, "STRAGGLERS", stragglers)
    rows = near_copies(8)
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == classes_by_force(rows)


def test_blocks_join_all_that_can_be_joined(spark):
    """One bucket that holds everything, each text a component of its own but for one large one."""
    rows = near_copies(12)
    texts_ = {i: om.kmers(words(t)) for i, t in rows}
    big = {i for i in texts_ if i % 8 < 4}
    schema = "key long, node long, root long, n int"
    members = spark.createDataFrame([(-1, i, -1 if i in big else i, len(g)) for i, g in texts_.items()], schema)
    shingles = spark.createDataFrame([(i, bytearray(g.astype("<u8").tobytes())) for i, g in texts_.items()], "node long, g binary")
    for block in (512, 7):
        om.BLOCK, kept = block, om.BLOCK
        try:
            links = [(r.a, r.b) for r in om.straggler_links(members, shingles).collect()]
        finally:
            om.BLOCK = kept
        parent = {i: -1 if i in big else i for i in texts_} | {-1: -1}

        def top(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in links:
            parent[max(top(a), top(b))] = min(top(a), top(b))
        want = {**parent}
        for a in texts_:
            for b in texts_:
                if a < b and om.similarity(texts_[a], texts_[b]) >= 0.8 - 1e-9:
                    assert top(a) == top(b), (block, a, b)
        assert want == parent


def test_ids_with_several_texts(spark):
    """An id's texts are documents of their own; the result does not hang on the order of rows."""
    w, v = texts(3, 2)
    edit = [" ".join([*t.split(" ")[:-1], "other"]) for t in (w, v)]
    rows = [(5, w), (5, v), (7, edit[0]), (8, edit[1]), (None, w), (None, "alone without an id"), (None, None), (0, "")]
    rnd = random.Random(4)
    for _ in range(4):
        got = sorted((r.doc_id, r.class_id) for r in om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == [(0, 0), (5, 5), (7, 5), (8, 5)]
        kept = {(r.doc_id, r.text) for r in om.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert kept == {(5, w), (5, v), (None, "alone without an id"), (0, "")}
        rnd.shuffle(rows)


def test_near_duplicates_of_odd_rows(spark):
    got = {r.doc_id: r.class_id for r in om.near_duplicates(docs(spark, clash=True)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9}
    assert om.near_duplicates(docs(spark, rows=[])).count() == 0


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    b = np.delete(np.append(a, np.uint64(777)), [3, 50])
    assert om.banded_matches(a, b, 10) == lcs(a.tolist(), b.tolist()) == 98
    assert om.similarity(a, b) == pytest.approx(98 / (100 + 99 - 98))
    assert om.similarity(a, a[::-1].copy()) == 0
    # recall of the sketches at the threshold
    rnd = np.random.default_rng(1)
    hit = 0
    for _ in range(200):
        x = rnd.integers(0, 1 << 62, 450, dtype=np.uint64)
        hit += bool((om.order_sketches(x[:405]) == om.order_sketches(x[45:])).any())
    assert hit >= 199


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 20)] + [(30, 31), (40, 31), (50, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 21), 1), 30: 30, 31: 30, 40: 30}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats_by_force(rows):
    w = {i: words(t) for i, t in rows}
    places = defaultdict(set)
    for i, x in w.items():
        for s in range(len(x) - 49):
            places[tuple(x[s : s + 50])].add(i)
    out = {}
    for i, x in w.items():
        spans = []
        for s in range(len(x) - 49):
            if len(places[tuple(x[s : s + 50])]) > 1:
                if spans and s <= spans[-1][0] + spans[-1][1]:
                    spans[-1][1] = s + 50 - spans[-1][0]
                else:
                    spans.append([s, 50])
        if spans:
            out[i] = [tuple(s) for s in spans]
    return out


def test_repeated_passages_by_force(spark):
    t = texts(11, 30, 300)
    rnd = random.Random(2)
    for k in range(60):
        a, b = rnd.randrange(30), rnd.randrange(30)
        x, y, n = t[a].split(" "), t[b].split(" "), rnd.choice((49, 50, 51, 60, 90))
        p, q = rnd.randrange(200), rnd.randrange(len(y))
        t[b] = " ".join(y[:q] + x[p : p + n] + y[q:])
        if k % 20 == 0:
            t.append(t[b])
    rows = [*enumerate(t), (900, None), (901, ""), (902, "orre " * 400)]
    got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in got.collect()} == repeats_by_force(rows)


def test_repeated_passages_of_tables(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in sd.repeated_passages(df).collect()} == repeats_by_force(rows)
    assert sd.repeated_passages(docs(spark, rows=[])).count() == 0
    assert sd.repeated_passages(docs(spark, clash=True)).count() == 0
