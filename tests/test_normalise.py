from pyspark.sql import functions as F

from hardcourt.operators import pbp
from hardcourt.sources.tables import RAW_COLUMNS, append, error_rows, read_play_by_play

HEAD = "GAME_ID,EVENTNUM,EVENTMSGTYPE,EVENTMSGACTIONTYPE,PERIOD,PCTIMESTRING,HOMEDESCRIPTION,NEUTRALDESCRIPTION,VISITORDESCRIPTION,PERSON1TYPE,PLAYER1_ID,PLAYER1_TEAM_ID,PLAYER2_ID,PLAYER3_ID,PLAYER3_TEAM_ID"
ROWS = """g1,9,3,11,1,11:30,MISS h1 Free Throw 1 of 2,,,4,h1,H,0,0,
g1,2,12,0,1,12:00,,,,0,0,,0,0,
g1,7,1,1,1,11:48,h1 Layup (2 PTS) (h2 1 AST),,,4,h1,H,h2,0,
g1,10,2,1,1,11:20,MISS h1 3PT,,a1 BLOCK,4,h1,H,0,a1,A
g1,11,8,0,1,11:10,,,,4,h1,H,h2,0,
g1,12,10,0,1,11:00,,,,4,h1,H,0,A,A
g1,13,5,1,1,10:50,,,,4,h1,H,a1,0,
g1,14,6,1,1,10:40,,,,5,a1,A,h2,0,
g1,15,18,0,1,10:40,,,,0,0,,0,0,
g1,16,6,99,1,10:30,,,,0,0,,0,0,
g1,17,77,0,1,10:30,,,,0,0,,0,0,
"""
CATALOG = [
    ("MSG=3_ACT=11_HAS=MISS", "ft_miss"), ("MSG=12_ACT=0", "period_start"), ("MSG=1_ACT=1_NO=3PT", "fg2_make"), ("MSG=2_ACT=1_HAS=3PT", "fg3_miss"), ("MSG=8_ACT=0", "substitution"),
    ("MSG=10_ACT=0", "jump_ball_win"), ("MSG=5_ACT=1", "turnover"), ("MSG=6_ACT=1", "o_standard_foul"), ("MSG=18_ACT=0", "ignore"), ("MSG=6_ACT=99", "unreviewed"),
]


def test_raw_file_to_contract(spark, tmp_path):
    (tmp_path / "season.csv").write_text(f"{HEAD}\n{ROWS}")
    raw = read_play_by_play(spark, str(tmp_path / "season.csv"), tuple(HEAD.split(",")))
    assert set(HEAD.split(",")) <= set(RAW_COLUMNS)
    keyed = pbp.event_key(raw).withColumns({"identity": F.lit("src"), "dataset": F.lit("pbp")})
    catalog = spark.createDataFrame([("src", "pbp", k, h) for k, h in CATALOG], "identity string, dataset string, event_key string, handling string")
    rows = pbp.classified(keyed, catalog)
    assert {r.EVENTNUM for r in rows.filter("unclassified").collect()} == {"16", "17"}
    teams = spark.createDataFrame([("H",), ("A",)], "ext_id string")
    players = spark.createDataFrame([("h1", "H"), ("h2", "H"), ("a1", "A"), ("0", "A")], "ext_id string, team_id string")
    games = spark.createDataFrame([("g1", "H", "A")], "game_id string, home string, away string")
    got = pbp.normalised(rows, pbp.entity_dimension(teams, players), games).orderBy("seq").collect()
    assert [(r.event_id, r.event, r.team_id, r.player_id, r.secs, r.fouled_player_id) for r in got] == [
        ("2", "period_start", "", "", 0, None),
        ("7", "fg2_make", "H", "h1", 12, None), ("7", "fg2_assist", "H", "h2", 12, None),
        ("9", "ft_miss", "H", "h1", 30, None),
        ("10", "fg3_miss", "H", "h1", 40, None), ("10", "block", "A", "a1", 40, None),
        ("11", "player_in", "H", "h2", 50, None), ("11", "player_out", "H", "h1", 50, None),
        ("12", "jump_ball_win", "A", "", 60, None),
        ("13", "turnover", "H", "h1", 70, None), ("13", "steal", "A", "a1", 70, None),
        ("14", "o_standard_foul", "A", "a1", 80, "h2"), ("14", "o_foul_draw", "H", "h2", 80, None),
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    for _ in range(2):
        append(df, str(tmp_path / "t"), ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "t")).filter("b is null").count() == 2
    assert [tuple(r) for r in error_rows(df.filter("a = 1"), "merge", "no key", ["a", "b"]).collect()] == [("merge", "no key", '{"a":1,"b":null}')]
