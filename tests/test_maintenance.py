import os
import random
from graphlib import CycleError

import duckdb
import pytest
from pyspark.sql import functions as F

from hardcourt.operators import maintenance as mt
from hardcourt.operators import ordered as od
from hardcourt.plans import derivation, plays
from hardcourt.sources.tables import RAW_COLUMNS, read_checked


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def seasons(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}", str(2020 + k % 4)) for k in range(40)], "k long, v string, season string")
    df.write.partitionBy("season").parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t", df


def test_upsert_touches_its_partitions_only(spark, seasons):
    path, old = seasons
    before = files(path)
    new = spark.createDataFrame([(1, "new", "2021"), (5, None, "2021"), (99, "more", "2021")], "k long, v string, season string")
    mt.upsert_partitions(spark, path, old.schema, new, ["season", "k"], "season", policy="fill")
    after = files(path)
    same = {f for f in before if "season=2021" not in f}
    assert {f: after.get(f) for f in same} == {f: before[f] for f in same}
    assert not {f for f in after if "season=2021" in f} & {*before}
    assert rows(spark.read.schema(old.schema).parquet(path)) == rows(mt.upsert(old, new, ["season", "k"], "fill").select(*old.columns))
    with pytest.raises(ValueError, match="no key"):
        mt.upsert_partitions(spark, path, old.schema, new, ["k"], "season")


def test_new_partitions_and_emptied_ones(spark, seasons):
    path, old = seasons
    new = spark.createDataFrame([(1, "a", "1999/00 b=c")], "k long, v string, season string")
    mt.upsert_partitions(spark, path, old.schema, new, ["season", "k"], "season")
    mt.partitions_rewritten(spark, path, old.schema, "season", ["2020", "2022"], lambda df: df.filter("season <> '2020' and k > 20"))
    left = spark.read.schema(old.schema).parquet(path)
    assert rows(left) == rows(old.filter("season <> '2020' and (season <> '2022' or k > 20)").unionByName(new))
    assert not any("season=2020" in f for f in files(path))
    assert mt.partitions_dropped(spark, path, "season", "2022") == ["1999/00 b=c", "2021"]
    assert {r.season for r in spark.read.schema(old.schema).parquet(path).collect()} == {"2022", "2023"}
    mt.upsert_partitions(spark, path, old.schema, new.limit(0), ["season", "k"], "season")


def test_ids_ascend_with_the_key(spark):
    known = spark.createDataFrame([("m", 7), ("c", 3)], "k string, id long")
    fresh = spark.createDataFrame([(chr(97 + k % 26) * (1 + k // 26),) for k in range(60)] * 2, "k string").repartition(5)
    got = {r.k: r.id for r in mt.with_new_ids(known, fresh, ["k"], "id").collect()}
    new = sorted(k for k in got if k not in ("m", "c"))
    assert [got[k] for k in new] == [*range(8, 8 + len(new))] and (got["m"], got["c"]) == (7, 3) and len(got) == 60
    df = mt.with_new_ids(known, fresh, ["k"], "id")
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    assert rows(mt.with_new_ids(known.limit(0), fresh.limit(3), ["k"], "id")) == [(k, n + 1) for n, k in enumerate(sorted(r.k for r in fresh.limit(3).distinct().collect()))]


def test_cascades(spark):
    t = {
        "teams": spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, country string"),
        "players": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, team int"),
        "games": spark.createDataFrame([(100, 10, "x"), (101, 11, "x"), (102, 12, "y"), (103, None, None)], "id int, player int, country string"),
        "countries": spark.createDataFrame([("x",), ("y",)], "code string"),
    }
    refs = [mt.Reference("players", ("team",), "teams", ("id",)), mt.Reference("games", ("player",), "players", ("id",)), mt.Reference("games", ("country",), "countries", ("code",), "set null"), mt.Reference("teams", ("country",), "countries", ("code",), "set null")]
    left = mt.without(t, {"teams": (t["teams"].filter("id = 1").select("id"), ["id"])}, refs)
    assert {n: rows(df) for n, df in left.items()} == {"teams": [(2, None), (3, "y")], "players": [(11, 2), (12, None)], "games": [(101, 11, "x"), (102, 12, "y"), (103, None, None)], "countries": [("x",), ("y",)]}
    left = mt.without(t, {"countries": (t["countries"].filter("code = 'x'"), ["code"]), "players": (t["players"].filter("id = 11").select("id"), ["id"])}, refs)
    assert rows(left["teams"]) == [(1, None), (2, None), (3, "y")] and rows(left["games"]) == [(100, 10, None), (102, 12, "y"), (103, None, None)]
    with pytest.raises(CycleError):
        mt.without(t, {}, [*refs, mt.Reference("teams", ("id",), "games", ("id",))])


def test_staging_of_other_sources_stays(spark):
    two = lambda data, schema: spark.createDataFrame([(s, *d) for s in ("a", "b") for d in data], f"identity string, {schema}")
    t = {
        "teams": two([(1, "ready"), (2, "pending"), (3, "ready")], "ext_id int, status string"),
        "players": two([(10, "ready"), (11, "pending")], "ext_id int, status string"),
        "games": two([(100, 1, 3, "pending"), (101, 1, 2, "pending"), (102, 1, 3, "error")], "ext_game_id int, ext_home_id int, ext_away_id int, status string"),
        "teams_players": two([(1, 11), (2, 10), (2, 11)], "ext_team_id int, ext_player_id int"),
        "player_seasons": two([(10, 5), (11, 6)], "ext_player_id int, points int"),
    }
    left = mt.staging_cleaned(t, "a")
    mine = {n: rows(df.filter("identity = 'a'").drop("identity")) for n, df in left.items()}
    assert mine == {"teams": [(2, "pending")], "players": [(11, "pending")], "games": [(101, 1, 2, "pending"), (102, 1, 3, "error")], "teams_players": [(2, 11)], "player_seasons": [(11, 6)]}
    assert all(rows(left[n].filter("identity = 'b'")) == rows(t[n].filter("identity = 'b'")) for n in t)


def test_one_changed_event_is_one_game(spark):
    base = [(f"g{k % 7}", k, float(k % 5) if k % 11 else None) for k in range(200)]
    before = mt.digests(spark.createDataFrame(base, "game_id string, seq int, value double"), ["game_id"])
    after = [*base]
    after[17] = (*base[17][:2], 99.0)
    random.Random(1).shuffle(after)
    got = mt.changed(spark.createDataFrame(after, "game_id string, seq int, value double").repartition(3), before, ["game_id"])
    assert rows(got) == [(base[17][0], "changed")]
    again = [r for r in after if r[0] != "g2"] + [("g9", 1, 1.0), (base[3][0], *base[3][1:])]
    assert rows(mt.changed(spark.createDataFrame(again, "game_id string, seq int, value double"), before, ["game_id"])) == sorted({("g9", "new"), ("g2", "gone"), (base[17][0], "changed"), (base[3][0], "changed")})


def test_rules_in_one_scan(spark):
    rows_ = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "z", 9), (None, "a", None), (None, "b", 3)], "k int, pick string, ref int")
    rows_.createOrReplaceTempView("checked")
    refs = {"ref": (spark.createDataFrame([(1,), (2,), (3,)], "id int"), "id")}
    got = mt.quality_errors(rows_, ["k"], ["pick"], {"pick": ["a", "b"]}, refs)
    assert rows(got) == sorted([("not_null", "pick", "1"), ("picklist", "pick", "2"), ("reference", "ref", "2"), ("unique", "k", "1"), ("unique", "k", "")])


def test_grid(spark):
    one, two = spark.range(3).withColumnRenamed("id", "a"), spark.range(4).select(F.col("id").alias("b"), F.lit("x").alias("c"))
    assert mt.coverage_grid(one, two).count() == 12
    assert mt.coverage_grid(one, two, most=2).count() == 12
    assert mt.coverage_grid(one, two.limit(0)).count() == 0


def test_players_on_court_by_force(spark):
    rnd = random.Random(5)
    intervals, events = [], [(f"g{g}", s, f"e{s}") for g in range(4) for s in range(60)]
    for g in range(3):
        for p in range(12):
            at = rnd.randrange(10)
            for _ in range(rnd.randrange(4)):
                end = at + rnd.randrange(0, 15)
                intervals.append((f"g{g}", f"t{p % 2}", f"p{p}", at, end, None, None))
                at = end + rnd.choice((0, 0, 1, 4))
    i = spark.createDataFrame(intervals, "game_id string, team_id string, player_id string, start_seq int, end_seq int, start_secs int, end_secs int")
    e = spark.createDataFrame(events, "game_id string, seq int, name string")
    got = od.on_court(e, i)
    want = {(g, s, n, t, p) for g, s, n in events for h, t, p, a, b, *_ in intervals if g == h and a <= s <= b}
    assert rows(got) == sorted(want, key=str)
    assert "Join" not in plan(od.on_court(e, i))


def test_broken_lines(spark, tmp_path):
    good = ["0022"] + [str(n) for n in range(1, len(RAW_COLUMNS))]
    lines = [",".join(RAW_COLUMNS), ",".join(good), "0022,1", ",".join([*good, "one more"]), ",".join(["", *good[1:]]), ",".join([good[0], "x", *good[2:]]), ",".join([*good[:6], '"six, quoted"', *good[7:]])]
    (tmp_path / "season.csv").write_text("\n".join(lines) + "\n")
    kept, bad = read_checked(spark, str(tmp_path))
    assert [r.HOMEDESCRIPTION for r in kept.orderBy("HOMEDESCRIPTION").collect()] == ["6", "six, quoted"]
    told = sorted((r.message, r.line) for r in bad.select("message", F.get_json_object("detail", "$.line").alias("line")).collect())
    assert told == sorted([("malformed line", lines[2]), ("malformed line", lines[3]), ("no game", lines[4]), ("no event number", lines[5])])


RULES = {
    "ft_without_foul", "rebound_no_shot", "fouled_shot_miss", "player_in_twice", "missing_period_end", "lineup_too_small", "lineup_too_large", "poss_mismatch", "poss_change_without_transition",
    "foul_without_fouled_player", "double_poss_open", "poss_end_no_open", "poss_marker_unpaired", "activity_after_end", "player_out_not_on_court", "player_marker_unpaired", "event_off_court",
}


def test_streams_reach_every_rule_and_both_outcomes():
    con = duckdb.connect()
    for t in ("events", "lineitem"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    seen = {r for done in (plays.DONE, derivation.DONE) for (r,) in con.execute(f"{done} select distinct unnest(errors) from done").fetchall()}
    assert seen == RULES
    ready, every = con.execute(f"{plays.DONE} select count(*) filter (where not bad), count(*) from (select bool_or(len(errors) > 0) as bad from done group by game_id)").fetchall()[0]
    assert every / 3 < ready < every
    made = {e for (e,) in con.execute(f"{plays.DONE} select distinct event from done").fetchall()}
    assert {"ft2_make", "ft3_make", "d_reb", "o_reb", "pot_poss_ending_scoring_opp"} <= made
