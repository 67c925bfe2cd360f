import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hardcourt.llm import rotated_codes as rc

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_force(rows, is_anchor):
    known = {}
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        known[(i, lab, tuple(v))] = [int(np.floor(256 * float(x))) for x in v]
    rows = [(i, lab, w) for (i, lab, _), w in known.items()]
    out = []
    for a, own, va in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, w)), i, lab) for i, lab, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == own][:5]:
            good = [(t, n) for t, n, lab in scored if lab != own and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(good)]
    return sorted(out)


def found(df, anchors):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = rc.hard_negatives(df, anchors)
    assert got.columns == names
    return sorted(tuple(r) for r in got.collect())


def clustered(seed, n, dims=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    v = (centres[rng.integers(0, 6, n)] + 0.6 * rng.standard_normal((n, dims))).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, v[i].tolist(), int(x)) for i, x in enumerate(rng.integers(0, labels, n))]


@pytest.mark.parametrize("sizes", [(4096, 256, 32), (40, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    """Also in small chunks and blocks, and several rounds of broadcasts."""
    for n, v in zip(("CHUNK", "ANCHORS", "ROUND"), sizes, strict=True):
        monkeypatch.setattr(rc, n, v)
    rows = clustered(1, 700)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 10 == 0)
    assert got == by_force(rows, lambda i: i % 10 == 0) and len(got) > 500


def test_ties_and_one_common_vector(spark):
    same = [(i, [0.5, 0.25, -0.5], i % 2) for i in range(300)]
    rows = same + [(1000 + i, [0.5, 0.25, -0.5 + i / 64], i % 3) for i in range(30)]
    assert found(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0) == by_force(rows, lambda i: i % 100 == 0)


def test_nulls_repeats_lengths_and_clashes(spark):
    rows = clustered(2, 80) + [(None, [1.0] * 12, 1), (200, None, 1), (201, [1.0] * 12, None), (202, [1.0, None] * 6, 1), (203, [float("nan")] * 12, 1), (204, [float("inf")] * 12, 2)]
    rows += [rows[0], rows[0], (0, [0.5] * 12, 3), (300, [], 1), (301, [0.9], 1), (302, [0.0] * 12, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    padded = [(i, v + [0.0] * (12 - len(v)) if v is not None else v, lab) for i, v, lab in rows]
    want = by_force(padded, lambda i: i % 20 == 0)
    clash = df.select("*", F.lit(1).alias("lane"), F.lit("x").alias("VEC_ID"), F.lit(2).alias("score"))
    assert found(df, F.col("vec_id") % 20 == 0) == want
    assert found(clash, F.col("vec_id") % 20 == 0) == want
    assert found(df.limit(0), F.col("vec_id") % 20 == 0) == []
    assert found(df, F.col("vec_id") == -5) == []


def test_huge_components(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice((-1, 1)) * 10.0 ** rng.randrange(0, 7) for _ in range(8)], i % 2) for i in range(120)]
    assert found(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0) == by_force(rows, lambda i: i % 10 == 0)
    vast = spark.createDataFrame([(0, [1e30, 1e30], 0), (1, [1e30, 2e30], 0), (2, [1e38, 1.0], 1), (100, [-1e30, 1e30], 1)], SCHEMA)
    assert found(vast, F.col("vec_id") % 100 == 0)


def test_intervals_hold():
    rng = np.random.default_rng(3)
    whole = rng.integers(-200, 200, (500, 64))
    codes, facts = rc.coded(whole)
    anchors = rc.Anchors(np.arange(40), whole[:40], 0)
    exact = whole[:40] @ whole.T
    estimate, low, high = anchors.intervals(codes, facts)
    assert (low <= exact).all() and (exact <= high).all()
    assert np.corrcoef(estimate.ravel(), exact.ravel())[0, 1] > 0.9
    assert np.median(high - low) < 0.9 * np.median(2 * facts[:40, 3, None] * facts[None, :, 3])
