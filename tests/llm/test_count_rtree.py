import random
from collections import defaultdict

import numpy as np
import pytest

from hardcourt.llm import count_rtree as cr
from tests.llm.fixtures import LONG, SF, docs, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    out, word = [], ""
    for ch in (text or "").translate(LOWER):
        if ch in " \t\n\x0b\f\r":
            out, word = out + [word] * bool(word), ""
        else:
            word += ch
    out += [word] * bool(word)
    return {tuple(out[i : i + 4]) for i in range(max(1, len(out) - 3))} if out else set()


def by_force(rows, percent=85):
    """One result for each row: set size and least id of the component."""
    sets = [plain_set(t) for _, t in rows]
    parent = [*range(len(rows))]

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holds = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holds[x].append(i)
    for p, q in {(p, q) for h in holds.values() for p in h for q in h if p < q}:
        if 100 * len(sets[p] & sets[q]) >= percent * len(sets[p] | sets[q]):
            parent[top(p)] = top(q)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(df, **more):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in cr.ngram_components(df, **more).collect()), key=str)


def edited(rnd, words, n):
    words = [*words]
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def families(seed=3):
    """Copies with a few words changed: similarities on both sides of the threshold, chains, all sizes from 1 word on."""
    rnd, rows = random.Random(seed), []
    for size in (1, 3, 4, 5, 7, 8, 9, 12, 20, 40, 90, 200, 700):
        base = texts(size, 1, size)[0].split()
        rows += [" ".join(base)] * 2 + [edited(rnd, base, k % (2 + size // 50)) for k in range(12)]
        rows += [" ".join(base[: size - cut]) for cut in range(0, size, max(1, size // 12))]
    rows += texts(99, 40, 60)
    rnd.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


def test_families_of_all_sizes(spark):
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == by_force(rows)
    assert found(df, percent=60) == by_force(rows, 60)


def test_large_family_with_stragglers(spark, monkeypatch):
    """Many copies of one text, most pairs of which are below the threshold: blocks and chunks of several tasks."""
    monkeypatch.setattr(cr, "BLOCK", 16)
    rnd = random.Random(8)
    base = texts(7, 1, 150)[0].split()
    rows = [(i, edited(rnd, base, rnd.choice((1, 2, 4, 6, 9)))) for i in range(300)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_force(rows)


def test_common_passage_links_nobody(spark):
    passage = " ".join(f"common{i}" for i in range(55))
    rows = [(i, f"{passage} {t}") for i, t in enumerate(texts(4, 150, 60))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_force(rows)


@pytest.mark.parametrize("clash", [False, True, "case"])
def test_nulls_ties_repeats_long_texts(spark, clash):
    df = docs(spark, clash)
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    assert found(df) == by_force(rows)
    assert found(df.limit(0)) == []
    assert cr.ngram_components(df).columns == ["doc_id", "n_shingles", "component_id"]


def test_ids_null_and_repeated(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (5, text), (5, "other words stand here now"), (0, text + " tail"), (None, "lonely words without any id"), (7, LONG + " x"), (8, LONG)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_force(rows)


def test_boxes_stream_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = [(k, n) for k in range(5) for n in range(k * 3)] * 2
        got = sorted((r.key, r.lead, r.node) for r in cr.boxes(spark.createDataFrame(rows, "key long, node long")).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(k, 0, n) for k in range(5) for n in range(1, k * 3)]


def test_tree_keeps_every_pair_that_may_link():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 80 - k % 9], rng.integers(0, 1 << 63, k % 9, dtype=np.uint64)])) for k in range(70)]
    sizes, counts = np.array([len(s) for s in sets]), np.array([cr.point(s, 64) for s in sets], int)
    got = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in cr.CountTree(counts, sizes, np.arange(70)).candidates()), strict=True)}
    room = [(a, b) for a in range(70) for b in range(a + 1, 70) if np.minimum(counts[a], counts[b]).sum() >= cr.least_shared(len(sets[a]), len(sets[b]))]
    assert got == {*room}
    assert not cr.CountTree(counts, sizes, np.zeros(70, int)).candidates()[0].size


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(df) == by_force([(r.doc_id, r.text) for r in df.collect()])
