"""Chains against a plain walk over lists of events, moved, renamed and taken away one at a time."""

import random

import pytest

from hardcourt.operators import derive, pbp

NAMES = ["fg2_make", "fg2_miss", "fg3_miss", "rebound", "rebound", "ft1_make", "ft_miss", "d_standard_foul", "o_standard_foul", "elevated_foul", "turnover", "steal", "fg2_assist", "block", "player_in", "player_out", "jump_ball_win"]
SCHEMA = "identity string, game_id string, event_id string, seq int, secs int, period int, team_id string, player_id string, event string, chain_id string, fouled_player_id string, source string, errors array<string>, home string, away string"
FIELDS = [x.split()[0] for x in SCHEMA.split(", ")]


def streams(seed, games=120):
    """Short games of every event, many of them misses, fouls on the player who missed, free throws and rebounds."""
    rnd, rows = random.Random(seed), []
    for g in range(games):
        names, pool = [], NAMES if g % 2 else NAMES[1:8]
        while len(names) < rnd.randint(4, 22):
            names += rnd.choice(([rnd.choice(pool)], [rnd.choice(pool)], ["fg2_miss", "d_standard_foul", "ft1_make"], ["fg2_miss", "block", "d_standard_foul", "ft_miss", "rebound"]))
        late = rnd.randrange(len(names) + 1)
        for seq, name in enumerate(names):
            same_row = name in ("block", "steal", "fg2_assist") and seq and rows[-1][1] == f"g{g}"
            team = rnd.choice("HA")
            rows.append(("s", f"g{g}", rows[-1][2] if same_row else f"e{seq}", seq, 10 * seq, 1 + (g % 3 == 0 and seq >= late), team, f"{team}{rnd.randrange(2)}", name, None, f"{rnd.choice('HA')}{rnd.randrange(2)}" if "standard" in name else None, f"e{seq}", [], "H", "A"))
    return rows


def walk(game):
    """The events after the chains, in order, and the broken rules as (rule, event id)."""
    events, errors = [dict(e) for e in game], []

    def back(at, anchors, skip, across):
        passed = 0
        for e in reversed(events[:at]):
            if not across and e["period"] != events[at]["period"]:
                return None
            if e["event"] in skip:
                continue
            if e["event"] in anchors:
                return e
            passed += 1
            if passed > derive.MAX_GAP:
                return None
        return None

    def forth(at, skip):
        for e in events[at + 1 :]:
            if e["period"] != events[at]["period"]:
                return None
            if e["event"] not in skip:
                return e
        return None

    for k, e in enumerate(events):
        if e["event"] in pbp.FTS:
            foul = back(k, pbp.FOULS, derive.FOUL_SKIP, True)
            e["chain_id"] = foul and foul["event_id"]
            errors += [] if foul else [("ft_without_foul", e["event_id"])]
    moves = []
    names = [e["event"] for e in events]
    for k, e in enumerate(events):
        if names[k] not in pbp.REBOUNDS:
            continue
        shot = back(k, pbp.MISSES, derive.REBOUND_SKIP, False)
        if shot is None:
            shot = forth(k, derive.REBOUND_SKIP)
            shot = shot if shot and shot["event"] in pbp.SHOTS else None
        if shot is None:
            errors.append(("rebound_no_shot", e["event_id"]))
            continue
        if e["event"] == "rebound":
            e["event"] = "o_reb" if e["team_id"] == shot["team_id"] else "d_reb"
        e["chain_id"] = shot["event_id"]
        moves.append((e, shot))
    place = {id(e): k for k, e in enumerate(events)}
    for e, shot in sorted(moves, key=lambda m: place[id(m[1])]):
        events = [x for x in events if x is not e]
        at = next(k for k, x in enumerate(events) if x is shot)
        events.insert(at + 1, e)
    gone = set()
    for k, e in enumerate(events):
        nxt = forth(k, ["block"]) if e["event"] in pbp.FG_MISSES else None
        if nxt and nxt["event"] in pbp.STANDARD_FOULS and nxt["fouled_player_id"] == e["player_id"] and any(x["event"] in pbp.FTS and x["chain_id"] == nxt["event_id"] for x in events):
            errors.append(("fouled_shot_miss", nxt["event_id"]))
            gone.add(e["event_id"])
    events = [e for e in events if e["event_id"] not in gone]
    for foul in [e for e in events if e["event"] in pbp.FOULS]:
        shots = [e for e in events if e["event"] in pbp.FTS and e["chain_id"] == foul["event_id"]]
        if shots and shots[0]["period"] != foul["period"]:
            foul |= {"period": shots[0]["period"], "secs": shots[0]["secs"]}
            events = [e for e in events if e is not foul]
            events.insert(next(k for k, e in enumerate(events) if e is shots[0]), foul)
    trips, first, inner = {}, {}, set()
    for e in events:
        if e["event"] in pbp.FTS and e["chain_id"]:
            trips.setdefault(e["chain_id"], []).append(e["event_id"])
        if e["event"] in pbp.REBOUNDS and e["chain_id"]:
            first.setdefault(e["chain_id"], e["event_id"])
    for found in trips.values():
        inner |= {*found[:-1]}
    events = [e for e in events if e["event"] not in pbp.REBOUNDS or not e["chain_id"] or (e["chain_id"] not in inner and first[e["chain_id"]] == e["event_id"])]
    return [(e["event_id"], e["event"], e["chain_id"], e["period"], e["secs"]) for e in events], errors


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chains_by_a_walk(spark, seed):
    rows = streams(seed)
    got = derive.chained(spark.createDataFrame(rows, SCHEMA)).orderBy("game_id", "seq").collect()
    seen = set()
    for g in {r[1] for r in rows}:
        want, errors = walk([dict(zip(FIELDS, r, strict=True)) for r in rows if r[1] == g])
        mine = [r for r in got if r.game_id == g]
        assert [(r.event_id, r.event, r.chain_id, r.period, r.secs) for r in mine] == want, g
        assert sorted((x, r.event_id) for r in mine for x in r.errors) == sorted(errors), g
        seen |= {x for x, _ in errors}
    assert seen == {"ft_without_foul", "rebound_no_shot", "fouled_shot_miss"}
