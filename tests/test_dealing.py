"""Games are dealt once, as narrow rows, to as many tasks as they need."""

import random
from collections import Counter

import pytest

from hardcourt.operators import ordered as od
from hardcourt.plans import QUERIES

SF = "/root/testdata/sf0.001"


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


@pytest.mark.parametrize("name", ["j1_played_stream", "g1_free_throw_chain"])
def test_games_are_dealt_once(spark, name):
    found = exchanges(QUERIES[name](spark, SF))
    dealt = [line for line in found if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 1
    assert len(found) == 1


def test_no_task_holds_the_sorts_of_two_stages(spark):
    plan = QUERIES["j1_completed_stream"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    sorts = [sum("Sort [" in line for line in part.splitlines()) for part in plan.split("REPARTITION_BY_NUM")]
    assert len(sorts) == 7
    assert max(sorts) <= 14, sorts


@pytest.mark.parametrize(("name", "windows", "sorts"), [("n14_played_status", 34, 21), ("j1_played_stream", 36, 24)])
def test_windows_share_passes_and_sorts(spark, name, windows, sorts):
    """What lies before and behind a row, and sums of the whole, come from one pass; every pass copies every row of a task."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= windows
    assert plan.count("Sort [") <= sorts


def test_rows_are_numbered_only_where_an_order_is_made(spark):
    """The order of a game's lines and, where players' rows are put between others, that of the lineups."""
    plan = QUERIES["n14_played_status"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number()") == 2


def test_tasks_grow_with_the_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "game_id")
    assert od.dealt(df, 10).rdd.getNumPartitions() == 4
    assert od.dealt(df, 50 * od.ROWS_A_TASK + 1).rdd.getNumPartitions() == 51


def test_counts_on_court_by_force(spark):
    """Players with many an `in` and few an `out`, so that their intervals lie over each other; windows that two stretches meet."""
    rnd = random.Random(7)
    events = [(f"g{g}", s, f"t{rnd.randrange(2)}") for g in range(3) for s in range(80)]
    intervals = []
    for g in range(3):
        for p in range(8):
            for _ in range(rnd.randrange(7)):
                a = rnd.randrange(75)
                intervals.append((f"g{g}", f"t{p % 2}", f"p{p}", a, min(79, a + rnd.choice((0, 1, 2, 5, 60)))))
    windows = [(f"g{g}", t, a, a + 6) for g in range(3) for t in ("t0", "t1") for a in range(rnd.randrange(5), 70, 9)]
    e = spark.createDataFrame(events, "game_id string, seq int, team_id string")
    i = spark.createDataFrame(intervals, "game_id string, team_id string, player_id string, start_seq int, end_seq int")
    w = spark.createDataFrame(windows, "game_id string, team_id string, start_seq int, end_seq int")
    on = {(g, s, u, t, p) for g, s, u in events for h, t, p, a, b in intervals if g == h and a <= s <= b}
    want = {}
    for g, _, u, t, p in on:
        n = want.setdefault((g, t, p), [0, 0])
        n[0], n[1] = n[0] + 1, n[1] + (u == t)
    assert sorted(map(tuple, od.court_counts(e, i).collect())) == sorted((*k, *n) for k, n in want.items())
    met = {(g, t, p, v, a) for g, v, a, b in windows for h, t, p, x, y in intervals if g == h for k, s, u in events if k == g and u == v and max(a, x) <= s < min(b, y)}
    poss = Counter(x[:4] for x in met)
    assert sorted(map(tuple, od.player_window_counts(w, e, i).collect())) == sorted((*k, n) for k, n in poss.items())
    assert {(r.game_id, r.court_team, r.court_player, r.team_id, r.start_seq) for r in od.player_windows(w, e, i).collect()} == met
    spans = od.merged(i).collect()
    assert all(a.end_seq + 1 < b.start_seq or b.end_seq + 1 < a.start_seq for a in spans for b in spans if a is not b and (a.game_id, a.player_id) == (b.game_id, b.player_id))
