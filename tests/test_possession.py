"""Possession against a plain walk over the events, one state at a time."""

import random

import pytest

from hardcourt.operators import derive, pbp

TEAMS = {"H": "A", "A": "H"}
NAMES = ["fg2_make", "fg2_miss", "turnover", "d_reb", "o_reb", "rebound", "jump_ball_win", "steal", "pot_poss_ending_scoring_opp", "period_end", "period_start", "d_standard_foul"]
SCHEMA = "identity string, game_id string, event_id string, seq int, secs int, period int, team_id string, player_id string, event string, chain_id string, fouled_player_id string, source string, errors array<string>, home string, away string, _final boolean, _live boolean"


def streams(seed, n=60, bounds=True):
    rnd, rows = random.Random(seed), []
    for g in range(n):
        names = [rnd.choice(NAMES[: None if g % 3 else 9]) for _ in range(rnd.randint(1, 25))]
        if bounds and g % 2:
            names = ["period_start", *[x for x in names if not x.startswith("period")], "period_end"]
        for seq, name in enumerate(names):
            team = "" if name.startswith("period") else rnd.choice("HA")
            own = rnd.random() < 0.9
            rows.append(("s", f"g{g}", f"e{seq}", seq, 10 * seq, 1, team, "", name, None, None, f"e{seq}" if own else "derived:x", [], "H", "A", name == "fg2_miss" and rnd.random() < 0.7, name == "fg2_make" and rnd.random() < 0.9))
    return rows


def walk(game):
    """The events of one game with the markers, in order, as (event, team); and the broken rules as (rule, event)."""
    out, errors = [], []
    held, lost = None, 0  # who has the ball; turnovers by the wrong team since it last changed hands
    for i, r in enumerate(game):
        name, team, own = r["event"], r["team_id"], not r["source"].startswith("derived")
        other = TEAMS.get(team)
        coming = next((x for x in game[i + 1 :] if x["event"] in pbp.POSSESSION or x["event"] == "period_end"), None)
        if name == "period_start":
            out.append((name, team))
            held = coming["team_id"] if coming and coming["event"] != "period_end" else None
            out += [("poss_start", held)] if held else []
            lost = 0
        elif name == "period_end":
            out.append((name, team))
            out += [("poss_end", held)] if held else []
            held, lost = None, 0
        elif name == "jump_ball_win":
            soon = False
            for x in game[i + 1 : i + 4]:
                if x["event"] == "period_end":
                    break
                soon = soon or (x["event"] == "turnover" and not x["source"].startswith("derived"))
            if held and held != team and not soon and not lost:
                out += [("turnover", held), ("poss_end", held), ("poss_start", team)]
                held = team
            out.append((name, team))
        elif name in ("turnover", "d_reb") or (name == "fg2_make" and r["_live"]):
            out.append((name, team))
            gives, gets = (other, team) if name == "d_reb" else (team, other)
            lost += name == "turnover" and own
            if held is None and name != "fg2_make":
                out.append(("poss_start", gets))
                held, lost = gets, 0
            elif held == gives:
                out += [("poss_end", held), ("poss_start", gets)]
                held, lost = gets, 0
            elif held is not None and not (name == "d_reb" and held == team):
                errors.append(("poss_mismatch", r["event_id"]))
        elif name in pbp.POSSESSION:
            if held is None:
                out.append(("poss_start", team))
                held, lost = team, 0
            elif held != team:
                errors.append(("poss_change_without_transition", r["event_id"]))
            out.append((name, team))
        else:
            out.append((name, team))
            taken = coming and (other if coming["event"] == "period_end" else coming["team_id"])
            if r["_final"] and taken:
                if taken != team:
                    if held == team:
                        out.append(("poss_end", held))
                    if held in (None, team):
                        out.append(("poss_start", taken))
                        held = taken
                    else:
                        errors.append(("poss_mismatch", r["event_id"]))
                    lost = 0
                elif held is None:
                    out.append(("poss_start", taken))
                    held, lost = taken, 0
                elif held != taken:
                    errors.append(("poss_change_without_transition", r["event_id"]))
                out.append(("d_reb" if taken != team else "o_reb", taken))
    return out, sorted(errors)


def alternating(seed, n=40):
    """Turnovers, mostly by the wrong team, and jump balls that count, in turn and many times over."""
    rnd, rows = random.Random(seed), []
    for g in range(n):
        names = [("period_start", "")]
        for k in range(24):
            names.append((rnd.choice(("turnover", "turnover", "turnover", "d_reb", "fg2_make")), rnd.choice("HA")))
            names += [("jump_ball_win", rnd.choice("HA"))] * rnd.choice((0, 1, 1, 2)) + [("d_standard_foul", "H")] * 3
            names += [("period_end", ""), ("period_start", "")] * (k % 11 == 10 and g % 4 == 0)
        names.append(("period_end", ""))
        rows += [("s", f"g{g}", f"e{k}", k, k, 1, t, "", x, None, None, f"e{k}" if rnd.random() < 0.95 else "derived:x", [], "H", "A", False, x == "fg2_make") for k, (x, t) in enumerate(names)]
    return rows


@pytest.mark.parametrize("rows", [streams(1), streams(2), alternating(3), alternating(4)], ids=["mixed 1", "mixed 2", "alternating 3", "alternating 4"])
def test_possession_by_a_walk(spark, rows):
    got = derive.possessed(spark.createDataFrame(rows, SCHEMA)).orderBy("game_id", "seq").select("game_id", "event", "team_id", "event_id", "errors").collect()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for g in {r[1] for r in rows}:
        game = [dict(zip(names, r, strict=True)) for r in rows if r[1] == g]
        want, errors = walk(game)
        mine = [r for r in got if r.game_id == g]
        assert [(r.event, r.team_id) for r in mine] == want, (g, [(r["event"], r["team_id"], r["_final"], r["_live"]) for r in game])
        assert sorted((e, r.event_id) for r in mine for e in r.errors) == errors, g
