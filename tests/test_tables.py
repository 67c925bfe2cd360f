import math
import os

import duckdb
import pytest

from hardcourt.operators import maintenance as mt
from hardcourt.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts(spark):
    t, s = spark.createDataFrame([(1, 5, None)], "k int, a int, b int"), spark.createDataFrame([(1, 9, 7), (2, 1, 2)], "k int, a int, b int")
    once = mt.upsert(t, s, ["k"], "fill")
    assert rows(once) == [(1, 5, 7), (2, 1, 2)]
    assert rows(mt.upsert(once, s, ["k"], "fill")) == rows(once)
    assert rows(mt.upsert(t, s.filter("k = 1"), ["k"])) == [(1, 9, 7)]
    g = spark.createDataFrame([(1, False, None)], "k int, completed boolean, ot boolean")
    n = spark.createDataFrame([(1, True, True)], "k int, completed boolean, ot boolean")
    assert rows(mt.upsert(g, n, ["k"], "fill", newest=("completed",))) == [(1, True, True)]


def test_merge_filters_resolves_and_gates(spark):
    ids = {"identities_teams": spark.createDataFrame([("1", 10)], "ext_id string, team_id long")}
    staged = spark.createDataFrame([("L", "src", "1", "2024-25", "reg", 0, "ready", 1), ("L", "src", "1", "2025-26", "reg", 3, "ready", 1), ("L", "src", "2", "2025-26", "reg", 3, "ready", 1)], "league_code string, identity string, ext_team_id string, season string, season_type string, games int, status string, priority int")
    empty = spark.createDataFrame([], "league_code string, team_id long, season string, season_type string, games int")
    once = mt.merged(staged, empty, mt.MERGES["team_seasons"], ids)
    assert [(r.team_id, r.season, r.games) for r in once.collect()] == [(10, "2025-26", 3)]
    assert rows(mt.merged(staged, once, mt.MERGES["team_seasons"], ids)) == rows(once)


@pytest.mark.parametrize("name", sorted(mt.MERGES))
def test_every_merge(spark, name):
    """Two ready rows of one key, one of a key that no identity knows, one that the merge's filter leaves out."""
    m = mt.MERGES[name]
    made = {x.split("=")[0] for *_, x in m.joins} | {*m.rename.values()}
    ext = [x for x, *_ in m.joins]
    cols = sorted({*m.drop, *ext, *m.rename, *(k for k in m.keys if k not in made), "val", "priority", "games", "status"})

    def row(**change):
        known = {"val": 7, "priority": 1, "games": 3, "status": "ready"} | change
        return tuple(known.get(x, "1") for x in cols)

    rows_ = [row(val=None), row(val=8, priority=2), *([row(**{ext[0]: "2"})] if ext else []), *([row(status="pending" if "ready" in m.where else "error", games=0, val=99, priority=0)] if m.where != "true" else [])]
    schema = ", ".join(f"{x} {'int' if x in ('val', 'priority', 'games') else 'string'}" for x in cols)
    ids = {t: spark.createDataFrame([("1", "10")], f"ext_id string, {x.split('=')[-1]} string") for _, t, _, x in m.joins}
    empty = spark.createDataFrame([], ", ".join(f"{k} string" for k in m.keys) + ", val int")
    once = mt.merged(spark.createDataFrame(rows_, schema), empty, m, ids)
    got = once.collect()
    assert len(got) == 1 and all(getattr(got[0], k) == ("10" if any(k == x.split("=")[0] for *_, x in m.joins) else "1") for k in m.keys)
    assert got[0].val in (None, 8)
    assert rows(mt.merged(spark.createDataFrame(rows_, schema), once, m, ids)) == rows(once)


def test_coverage_and_retention(spark):
    cov = spark.createDataFrame([("s1", "c1", True), ("s1", "c2", False)], "season string, col_name string, covered boolean")
    assert [r.complete for r in mt.complete(cov, ["season"]).collect()] == [False]
    seasons = spark.createDataFrame([("L", y) for y in ("2022-23", "2023-24", "2024-25", "2025-26")], "league_code string, season string")
    kept = mt.retained(seasons, spark.createDataFrame([("L", "2024-25")], "league_code string, oldest string"))
    assert sorted(r.season for r in kept.collect()) == ["2024-25", "2025-26"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    want = sorted(tuple(norm(r[names.index(x)]) for x in cols) for r in found.fetchall())
    assert sorted(tuple(norm(r[x]) for x in cols) for r in df.collect()) == want
