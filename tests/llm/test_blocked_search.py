import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hardcourt.llm import blocked_search as bs
from tests.llm.fixtures import LONG, SF, docs

KEEP = {*"0123456789abcdefghijklmnopqrstuvwxyz"}


def terms(text):
    out, word = [], ""
    for ch in text or "":
        ch = chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
        if ch in KEEP or ord(ch) > 0x7F:
            word += ch
        else:
            out, word = out + [word] * bool(word), ""
    return out + [word] * bool(word)


def by_force(rows, items):
    held = [(d, Counter(terms(t))) for d, t in rows]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    documents, length, df = len(held), sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in held:
            m = 10 + (90 * n * documents) // length
            s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in {*terms(text)} if t in c)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scored)[:10])] if item is not None else []
    return sorted(out)


def found(df, items):
    got = bs.ranked(df, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice((3, 10, 40, 150))))) for i in range(n)]


ITEMS = "item_id long, text string"
TEXTS = "doc_id long, text string"


@pytest.mark.parametrize("sizes", [(16, 2048, 128, 256), (3, 20, 4, 5)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    """Also with small segments and blocks, and queries in several rounds."""
    for n, v in zip(("CENTRES", "SEGMENT", "BLOCK", "QUERIES"), sizes, strict=True):
        monkeypatch.setattr(bs, n, v)
    rows, items = corpus(1, 900), corpus(2, 23)
    items = [(i * 7, t[:200]) for i, t in items]
    got = found(spark.createDataFrame(rows, TEXTS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert got == by_force(rows, items) and len(got) == 230


def test_ties_and_very_common_text(spark):
    rows = [(i, "same words here") for i in range(500)] + [(1000 + i, "same words there too") for i in range(40)]
    items = [(1, "same words"), (2, "there"), (3, "nothing of it"), (4, "here too")]
    assert found(spark.createDataFrame(rows, TEXTS).repartition(4), spark.createDataFrame(items, ITEMS)) == by_force(rows, items)


@pytest.mark.parametrize("clash", [False, True, "case"])
def test_nulls_repeats_and_clashes(spark, clash):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    items = [(1, "The quick brown fox"), (1, "MIT license"), (2, None), (3, ""), (4, "!!"), (None, "quick"), (5, "ünïcödé 漢字 row id"), (6, LONG)]
    df = spark.createDataFrame(items, ITEMS).select("*", F.lit("x").alias("TEXT" if clash == "case" else "more"))
    assert found(docs(spark, clash), df) == by_force(rows, items)
    assert found(docs(spark).limit(0), df) == []
    assert found(docs(spark), df.limit(0)) == []


def test_summaries_bound_scores():
    rng = np.random.default_rng(6)
    queries = bs.Queries([(k, " ".join(f"t{x}" for x in rng.integers(0, 40, 8))) for k in range(12)])
    queries.weigh(1000, rng.integers(1, 900, len(queries.terms)))
    lists = [np.sort(rng.choice(len(queries.terms), rng.integers(1, 12), replace=False)) for _ in range(300)]
    starts, t, v = bs.dense(lists, [rng.integers(1, 1_000_000, len(x)) for x in lists])
    s = bs.Segment(np.arange(300), starts, t, v, bs.posting_lists(300, starts, t, v, queries))
    met = 0
    for asking, bound, blocks in s.bounds(queries):
        for k, q in enumerate(asking):
            for b, rows in enumerate(blocks):
                best = s.scores(queries.weights[q], rows).max()
                assert best <= bound[k, b]
                assert len(rows) > 1 or bound[k, b] <= best + 8 * bs.STEP * 10**4
                met += 1
    assert met > 100


def test_skips_blocks(spark, monkeypatch):
    """Most blocks are left out where a few documents stand out."""
    monkeypatch.setattr(bs, "BLOCK", 8)
    rows = corpus(3, 2000) + [(5000 + i, "rare words stand out here " * 3) for i in range(12)]
    queries = bs.Queries([(1, "rare words stand out here t0 t1")])
    df = spark.createDataFrame(rows, TEXTS).repartition(2)
    vectors = bs.vectors(df, queries.number).cache()
    documents, length, counts = bs.corpus_counts(vectors, len(queries.terms))
    queries.weigh(documents, counts)
    segments = bs.index(vectors, documents, length, queries)
    tenth = sorted((r.score for r in bs.first_scores(segments, spark.sparkContext.broadcast(queries)).collect()), reverse=True)[9]
    blocks = [b for r in segments.toArrow().to_batches() for k in range(r.num_rows) for _, b, _ in bs.segment_at(r, k).bounds(queries)]
    assert sum((b >= tenth).sum() for b in blocks) < 0.2 * sum(b.size for b in blocks)


def test_whole_table(spark):
    df, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert found(df, items) == by_force([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in items.collect()])
