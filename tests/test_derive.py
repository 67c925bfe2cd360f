import random

import pytest

from hardcourt.operators import box, derive
from tests.games import GAMES, SCHEMA, events

SIZE = {"G-B": 2}


def run(spark, name, rows=None, size=None):
    games = spark.createDataFrame([(name, "H", "A")], "game_id string, home string, away string")
    return derive.derived(spark.createDataFrame(rows or events(name), SCHEMA), games, size or SIZE.get(name, 1)), games


def listed(stream):
    return [f"{r.event} {r.team_id}{'/' + r.player_id if r.player_id else ''}{'*' if r.source.startswith('derived') else ''}".strip() for r in stream.orderBy("seq").collect()]


G_A = """period_start · poss_start H* · player_in A/a1* · player_in H/h1* · jump_ball_win H · pot_poss_ending_scoring_opp H/h1* · fg2_make H/h1 · poss_end H* ·
poss_start A* · pot_poss_ending_scoring_opp A/a1* · fg3_miss A/a1 · d_reb H/h1 · poss_end A* · poss_start H* · turnover H/h1 · poss_end H* · poss_start A* · steal A/a1 ·
d_standard_foul H/h1 · pot_poss_ending_scoring_opp A/a1* · ft1_make A/a1 · ft1_make A/a1 · poss_end A* · poss_start H* · pot_poss_ending_scoring_opp H/h1* · fg2_miss H/h1 ·
poss_end H* · poss_start A* · d_reb A* · period_end · poss_end A* · player_out A/a1* · player_out H/h1*"""


def test_basic_flow(spark):
    stream, games = run(spark, "G-A")
    assert listed(stream) == [x.strip() for x in G_A.split("·")]
    teams = {r.team_id: r for r in box.team_games(stream, games).collect()}
    assert [(t.poss, t.o_poss_secs, t.points, t.pot_poss_ending_scoring_opps, t.secs, t.win) for t in (teams["H"], teams["A"])] == [(3, 33, 2, 2, 60, None), (3, 27, 2, 2, 60, None)]
    h1 = {r.player_id: r for r in box.player_games(stream).collect()}["h1"]
    assert (h1.start, h1.secs, h1.fg2m, h1.fg2a, h1.turnovers, h1.poss, h1.o_poss_secs, h1.opp_poss, h1.d_poss_secs, h1.on_points, h1.opp_points, h1.opp_fta) == (True, 60, 1, 2, 1, 3, 33, 3, 27, 0, 2, 2)


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("G-B", {"H": (1, 14, 2, 1), "A": (0, None, 0, 0)}),
        ("G-C", {"H": (2, 37, 0, 2), "A": (2, 23, 2, 2)}),
        ("G-D", {"H": (2, 10, 4, 2), "A": (2, 40, 2, 2)}),
        ("G-E", {"H": (1, None, 2, 1), "A": (1, 15, 1, 0)}),
    ],
)
def test_possessions(spark, name, want):
    stream, games = run(spark, name)
    got = {r.team_id: (r.poss, r.o_poss_secs, r.points, r.pot_poss_ending_scoring_opps) for r in box.team_games(stream, games).collect()}
    assert got == want


def test_rules_and_gate(spark):
    stream, _ = run(spark, "G-E")
    assert {(r.rule, r.event_id) for r in derive.game_errors(stream).collect()} == {("ft_without_foul", "5"), ("rebound_no_shot", "4"), ("poss_mismatch", "3")}
    assert [r.status for r in derive.game_status(stream).collect()] == ["error"]
    for name in ("G-A", "G-B", "G-C", "G-D"):
        assert derive.game_errors(run(spark, name)[0]).count() == 0, name


def test_miss_on_a_fouled_shot_is_an_error_and_goes(spark):
    """The foul is the record of the attempt and carries the error; the miss goes with its row's block, before anything counts it."""
    stream, _ = run(spark, "G-F")
    assert {(r.rule, r.event_id) for r in derive.game_errors(stream).collect()} == {("fouled_shot_miss", "4")}
    assert [r.status for r in derive.game_status(stream).collect()] == ["error"]
    assert not {"fg2_miss", "block"} & {r.event for r in stream.collect()}


def test_order_of_input_does_not_matter(spark):
    rows = [r for n in GAMES for r in events(n)]
    want = {n: listed(run(spark, n)[0]) for n in ("G-C", "G-D")}
    random.Random(3).shuffle(rows)
    for n, stream in want.items():
        assert listed(run(spark, n, [r for r in rows if r[1] == n])[0]) == stream
