"""Queries of matching (C), coverage (C12, D15, D19) and table maintenance (M, N15, O)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from hardcourt.operators import maintenance as mt
from hardcourt.plans.registry import query
from hardcourt.sources.tables import append, error_rows, read, shared_folder

c = F.col
T = "(select c_custkey, case when c_custkey % 5 <> 0 then c_acctbal end as c_acctbal, c_mktsegment from customer where c_custkey % 3 <> 0)"
S = "(select c_custkey, c_acctbal + 1 as c_acctbal, case when c_custkey % 4 <> 0 then c_mktsegment end as c_mktsegment from customer where c_custkey % 2 = 0)"


def target(spark, sf):
    return read(spark, sf, "customer").filter("c_custkey % 3 <> 0").select("c_custkey", F.when(c("c_custkey") % 5 != 0, c("c_acctbal")).alias("c_acctbal"), "c_mktsegment")


def source(spark, sf):
    return read(spark, sf, "customer").filter("c_custkey % 2 = 0").select("c_custkey", (c("c_acctbal") + 1).alias("c_acctbal"), F.when(c("c_custkey") % 4 != 0, c("c_mktsegment")).alias("c_mktsegment"))


def both(acctbal: str, segment: str) -> str:
    return f"select coalesce(t.c_custkey, s.c_custkey) as c_custkey, {acctbal} as c_acctbal, {segment} as c_mktsegment from {T} t full join {S} s on t.c_custkey = s.c_custkey"


def won(x: str) -> str:
    return f"case when s.c_custkey is not null then s.{x} else t.{x} end"


@query("m1_upsert_overwrite", both(won("c_acctbal"), won("c_mktsegment")))
def m1(spark, sf):
    return mt.upsert(target(spark, sf), source(spark, sf), ["c_custkey"])


@query("m2_upsert_fill", both("coalesce(t.c_acctbal, s.c_acctbal)", "coalesce(t.c_mktsegment, s.c_mktsegment)"))
def m2(spark, sf):
    return mt.upsert(target(spark, sf), source(spark, sf), ["c_custkey"], "fill")


@query("m3_game_upsert", both("coalesce(t.c_acctbal, s.c_acctbal)", "coalesce(s.c_mktsegment, t.c_mktsegment)"))
def m3(spark, sf):
    """Filled, but one column takes the newer value."""
    return mt.upsert(target(spark, sf), source(spark, sf), ["c_custkey"], "fill", newest=("c_mktsegment",))


@query("m4_insert_absent", "select s_suppkey, s_name from supplier where s_suppkey % 2 = 0 union all select s_suppkey, s_name || '*' from supplier where s_suppkey % 3 = 0 and s_suppkey % 2 <> 0")
def m4(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name")
    return mt.insert_absent(s.filter("s_suppkey % 2 = 0"), s.filter("s_suppkey % 3 = 0").withColumn("s_name", F.concat("s_name", F.lit("*"))), ["s_suppkey"])


_LINES = "select l_orderkey, l_partkey, l_suppkey, min_by(l_quantity, (l_shipdate, l_linenumber, l_quantity)) as quantity from lineitem where l_quantity > 5 and l_partkey % 10 <> 0 and l_suppkey % 7 <> 0 group by all"


@query("m5_staged_profiles", "select c_custkey as ext_id, 'src' as identity, c_mktsegment as name, 'pending' as status from customer union all select -1, 'src', 'old', 'ready'")
def m5(spark, sf):
    old = spark.createDataFrame([(-1, "src", "old", "ready")], "ext_id long, identity string, name string, status string")
    rows = read(spark, sf, "customer").select(c("c_custkey").alias("ext_id"), c("c_mktsegment").alias("name"), c("c_acctbal").alias("not_registered"))
    return mt.staged_profiles(rows, old, ["identity", "ext_id"], {"identity": "src", "status": "pending"}, {})["profiles"]


@query("m5_side_rows", "select distinct 'L' as league_code, c_nationkey as ext_team_id from customer")
def m5_side(spark, sf):
    old = spark.createDataFrame([], "ext_id long, identity string")
    rows = read(spark, sf, "customer").select(c("c_custkey").alias("ext_id"), c("c_nationkey").alias("ext_team_id"))
    return mt.staged_profiles(rows, old, ["identity", "ext_id"], {"identity": "src"}, {"leagues_teams": (["ext_team_id"], {"league_code": "L"})})["leagues_teams"]


@query("m6_staged_rosters", "select 'L' as league_code, c_nationkey as ext_team_id, c_custkey as ext_player_id, c_mktsegment as number from customer where c_custkey % 6 <> 0")
def m6(spark, sf):
    rows = read(spark, sf, "customer").select(c("c_nationkey").alias("ext_team_id"), F.when(c("c_custkey") % 6 != 0, c("c_custkey")).alias("ext_player_id"), c("c_mktsegment").alias("number"))
    old = spark.createDataFrame([], "league_code string, ext_team_id int, ext_player_id long, number string")
    return mt.staged_rosters(rows, old, ["league_code", "ext_team_id", "ext_player_id"], {"league_code": "L"})


_STATS = "select l_partkey as ext_player_id, '2024-25' as season, min_by(l_quantity, (l_quantity, l_tax)) as quantity from lineitem group by 1"


@query("m7_staged_stats", f"select ext_player_id, season, case when ext_player_id % 5 = 0 then -1.0 else quantity end::double as quantity from ({_STATS})")
def m7(spark, sf):
    """Every fifth player's row is there already and stays."""
    rows = read(spark, sf, "lineitem").select(c("l_partkey").alias("ext_player_id"), c("l_quantity").alias("quantity"))
    old = rows.select("ext_player_id").distinct().filter("ext_player_id % 5 = 0").select("ext_player_id", F.lit("2024-25").alias("season"), F.lit(-1.0).alias("quantity"))
    return mt.staged_stats(rows, old, ["ext_player_id", "season"], {"season": "2024-25"}, old, "ext_player_id")[0]


@query("m12_clear", "select 'customer' as table, count(*) as deleted, 0::bigint as left_over from customer union all select 'orders', count(*), 0 from orders")
def m12(spark, sf):
    tables = {n: read(spark, sf, n) for n in ("customer", "orders")}
    empty, deleted = mt.cleared(tables)
    rest = reduce(lambda a, b: a.unionByName(b), (t.agg(F.count("*").alias("left_over")).withColumn("table", F.lit(n)) for n, t in empty.items()))
    return deleted.join(rest, "table")


@query(
    "m21_stamps",
    f"""select coalesce(t.c_custkey, s.c_custkey) as c_custkey, case when t.c_custkey is null then 'new' else 'old' end as created,
      case when t.c_custkey is not null and (s.c_custkey is null or (coalesce(t.c_acctbal, s.c_acctbal) is not distinct from t.c_acctbal and coalesce(t.c_mktsegment, s.c_mktsegment) is not distinct from t.c_mktsegment)) then 'old' else 'new' end as updated
      from {T} t full join {S} s on t.c_custkey = s.c_custkey""",
)
def m21(spark, sf):
    """Stamps: created on insert, updated on change only."""
    t = target(spark, sf).withColumns({x: F.lit("2000-01-01").cast("timestamp") for x in mt.STAMPS})
    done = mt.upsert(t, source(spark, sf), ["c_custkey"], "fill", now=F.lit("2024-01-01").cast("timestamp"))
    stamp = {x: F.when(F.year(x) == 2024, "new").otherwise("old") for x in mt.STAMPS}
    return done.select("c_custkey", stamp["created_at"].alias("created"), stamp["updated_at"].alias("updated"))


@query("m8_merge", f"select l_orderkey, l_partkey + 1000000 as part_id, l_suppkey + 2000000 as supp_id, quantity from ({_LINES})")
def m8(spark, sf):
    """Staging into an empty intermediate table: predicate, two foreign keys, rename, one row a key by write order."""
    how = mt.Merge(("l_orderkey", "part_id", "supp_id"), drop=("l_partkey", "l_suppkey"), rename={"l_quantity": "quantity"}, joins=(("l_partkey", "parts", "ext_id", "part_id"), ("l_suppkey", "supps", "ext_id", "supp_id")), where="l_quantity > 5", priority=("l_shipdate", "l_linenumber", "order"))
    staged = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_linenumber", c("l_quantity").alias("order"))
    parts = read(spark, sf, "part").filter("p_partkey % 10 <> 0").select(c("p_partkey").alias("ext_id"), (c("p_partkey") + 1000000).alias("part_id"))
    supps = read(spark, sf, "supplier").filter("s_suppkey % 7 <> 0").select(c("s_suppkey").alias("ext_id"), (c("s_suppkey") + 2000000).alias("supp_id"))
    empty = spark.createDataFrame([], "l_orderkey long, part_id long, supp_id long, quantity double")
    return mt.merged(staged, empty, how, {"parts": parts, "supps": supps})


@query("m9_promote", both(won("c_acctbal"), won("c_mktsegment")))
def m9(spark, sf):
    return mt.promoted(target(spark, sf), source(spark, sf), ["c_custkey"])


@query(
    "m10_surrogate_ids",
    """select o_orderkey, o_orderkey as id from orders where o_orderkey % 2 = 0
    union all select o_orderkey, (select max(o_orderkey) from orders where o_orderkey % 2 = 0) + row_number() over (order by o_orderkey) from orders where o_orderkey % 2 <> 0""",
)
def m10(spark, sf):
    """Keys with an id keep it; the ids of the others go on without gaps, ascending with the key."""
    o = read(spark, sf, "orders").select("o_orderkey")
    known = o.filter("o_orderkey % 2 = 0").withColumn("id", c("o_orderkey"))
    return mt.with_new_ids(known, o, ["o_orderkey"], "id")


@query("m11_clean_staging", "select o_orderkey as ext_game_id from orders where not (o_orderstatus <> 'F' and o_custkey % 2 = 0 and (o_custkey + 1) % 3 = 0)")
def m11(spark, sf):
    games = read(spark, sf, "orders").select(c("o_orderkey").alias("ext_game_id"), c("o_custkey").alias("ext_home_id"), (c("o_custkey") + 1000000).alias("ext_away_id"), F.when(c("o_orderstatus") == "F", "error").otherwise("pending").alias("status"))
    cust = games.select("ext_home_id").distinct()
    teams = cust.select(c("ext_home_id").alias("ext_id"), F.when(c("ext_home_id") % 2 == 0, "ready").otherwise("pending").alias("status")).unionByName(cust.select((c("ext_home_id") + 1000000).alias("ext_id"), F.when((c("ext_home_id") + 1) % 3 == 0, "ready").otherwise("pending").alias("status")))
    return mt.clean_staging(games, teams).select("ext_game_id")


_STAGED_SQL = """with staged as (
  select 'teams' as name, s_suppkey as a, 0 as b, s_suppkey % 3 = 0 as ready from supplier union all select 'players', p_partkey, 0, p_partkey % 4 = 0 from part),
games as (select o_orderkey as a, o_custkey % 100 + 1 as home, o_orderkey % 100 + 1 as away, o_orderstatus = 'F' as bad from orders)
select name as "table", a, b from staged where not ready
union all select 'games', a, 0 from games where bad or not (home % 3 = 0 and away % 3 = 0 and home in (select s_suppkey from supplier) and away in (select s_suppkey from supplier))
union all select distinct 'teams_players', l_suppkey, l_partkey from lineitem where l_suppkey % 3 <> 0 and l_partkey % 4 <> 0
union all select 'player_games', l_orderkey, l_linenumber from lineitem where l_partkey % 4 <> 0
union all select 'team_games', l_orderkey, l_linenumber from lineitem where l_suppkey % 3 <> 0"""


@query("m11_cascade", _STAGED_SQL)
def m11_cascade(spark, sf):
    """What stays in staging once finished games, players and teams have gone with all their dependants."""
    mine = F.lit("src").alias("identity")
    status = lambda k, n: F.when(c(k) % n == 0, "ready").otherwise("pending").alias("status")
    lines = read(spark, sf, "lineitem").select(mine, c("l_orderkey").alias("a"), c("l_linenumber").cast("long").alias("b"), c("l_partkey").alias("ext_player_id"), c("l_suppkey").alias("ext_team_id"))
    orders = read(spark, sf, "orders")
    tables = {
        "games": orders.select(mine, c("o_orderkey").alias("ext_game_id"), (c("o_custkey") % 100 + 1).alias("ext_home_id"), (c("o_orderkey") % 100 + 1).alias("ext_away_id"), F.when(c("o_orderstatus") == "F", "error").otherwise("pending").alias("status")),
        "teams": read(spark, sf, "supplier").select(mine, c("s_suppkey").alias("ext_id"), status("s_suppkey", 3)),
        "players": read(spark, sf, "part").select(mine, c("p_partkey").alias("ext_id"), status("p_partkey", 4)),
        "teams_players": lines.select("identity", "ext_team_id", "ext_player_id").distinct(),
        "player_games": lines.drop("ext_team_id"),
        "team_games": lines.drop("ext_player_id"),
    }
    left = mt.staging_cleaned(tables, "src")
    names = {"games": ("ext_game_id", None), "teams": ("ext_id", None), "players": ("ext_id", None), "teams_players": ("ext_team_id", "ext_player_id"), "player_games": ("a", "b"), "team_games": ("a", "b")}
    return reduce(lambda x, y: x.unionByName(y), (left[n].select(F.lit(n).alias("table"), c(a).cast("long").alias("a"), (c(b) if b else F.lit(0)).cast("long").alias("b")) for n, (a, b) in names.items()))


@query(
    "m16_dependants",
    """select 'countries' as "table", n_nationkey::bigint as id, n_name as value from nation where n_nationkey % 5 <> 1
    union all select 'teams', c_custkey, case when c_nationkey % 5 <> 1 then c_nationkey::varchar end from customer
    union all select 'countries_players', s_suppkey, s_nationkey::varchar from supplier where s_nationkey % 5 <> 1""",
)
def m16_dependants(spark, sf):
    """A registry that has lost entries: teams lose the reference, rows that only tie a player to the entry go."""
    n = read(spark, sf, "nation").select("n_nationkey", "n_name")
    tables = {
        "countries": n.filter("n_nationkey % 5 <> 0").withColumn("n_name", F.when(c("n_nationkey") % 5 == 2, F.lower("n_name")).otherwise(c("n_name"))),
        "teams": read(spark, sf, "customer").select("c_custkey", "c_nationkey"),
        "countries_players": read(spark, sf, "supplier").select("s_suppkey", "s_nationkey"),
    }
    references = [mt.Reference("teams", ("c_nationkey",), "countries", ("n_nationkey",), "set null"), mt.Reference("countries_players", ("s_nationkey",), "countries", ("n_nationkey",))]
    left = mt.registry_applied(tables, "countries", n.filter("n_nationkey % 5 <> 1"), "n_nationkey", references)
    return reduce(lambda x, y: x.unionByName(y), (t.select(F.lit(k).alias("table"), c(t.columns[0]).cast("long").alias("id"), c(t.columns[1]).cast("string").alias("value")) for k, t in left.items()))


def _partitioned(spark, df) -> str:
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.partitionBy("season").parquet(path)
    return path


_SEASONS = "select o_orderkey, year(o_orderdate)::varchar as season, o_totalprice from orders"


def seasons(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("season"))


@query("m1_upsert_partitions", f"select o_orderkey, season, case when season in ('1995', '1997') and o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice from ({_SEASONS}) union all select -o_orderkey, season, o_totalprice + 1 from ({_SEASONS}) where season = '1997' and o_orderkey % 3 = 1")
def m1_partitions(spark, sf):
    """Two seasons of a table in partitions get changed and new rows; the other seasons' files stay."""
    rows = seasons(spark, sf)
    path = _partitioned(spark, rows)
    some = rows.withColumn("o_totalprice", c("o_totalprice") + 1)
    given = some.filter("season in ('1995', '1997') and o_orderkey % 3 = 0").unionByName(some.filter("season = '1997' and o_orderkey % 3 = 1").withColumn("o_orderkey", -c("o_orderkey")))
    mt.upsert_partitions(spark, path, rows.schema, given, ["season", "o_orderkey"], "season")
    return spark.read.schema(rows.schema).parquet(path)


@query("m15_prune_partitions", f"select o_orderkey, season, o_totalprice from ({_SEASONS}) where season >= '1994' and not (season = '1996' and o_totalprice < 150000) and season <> '1997'")
def m15_partitions(spark, sf):
    """Seasons before 1994 dropped unread (M13), stale rows of two seasons taken away, of one of them all."""
    rows = seasons(spark, sf)
    path = _partitioned(spark, rows)
    mt.partitions_dropped(spark, path, "season", "1994")
    mt.partitions_rewritten(spark, path, rows.schema, "season", ["1996", "1997"], lambda old: old.filter("season = '1996' and not o_totalprice < 150000"))
    return spark.read.schema(rows.schema).parquet(path)


_GAME = "strftime(ts, '%Y-%m-%d') || '-' || (user_id % 5)::varchar"


@query(
    "m20_changed_games",
    f"""with g as (select {_GAME} as game_id, bool_or(event_id % 1000 = 7) as differs, bool_and(event_id % 1000 = 7) as whole, bool_or(user_id % 5 = 4 and day(ts) = 3) as unseen from events group by 1)
    select game_id, case when unseen then 'new' else 'changed' end as change from g where unseen or differs""",
)
def m20_changed(spark, sf):
    """Games whose raw rows differ from those digested before: the only ones to derive anew."""
    e = read(spark, sf, "events")
    rows = e.select(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-"), (c("user_id") % 5).cast("string")).alias("game_id"), "event_id", "event_type", "value", "ts")
    before = rows.withColumn("value", F.when(c("event_id") % 1000 == 7, c("value") + 1).otherwise(c("value"))).filter(~(c("game_id").endswith("-03-4")))
    return mt.changed(rows, mt.digests(before, ["game_id"]), ["game_id"])


@query("m13_retention", "select o_orderkey from orders where case when o_custkey % 2 = 0 then year(o_orderdate) >= 1995 else year(o_orderdate) >= 1997 end")
def m13(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", (c("o_custkey") % 2).cast("string").alias("league_code"), F.year("o_orderdate").cast("string").alias("season"))
    oldest = spark.createDataFrame([("0", "1995"), ("1", "1997")], "league_code string, oldest string")
    return mt.retained(o, oldest).select("o_orderkey")


@query("m14_prune_unreferenced", "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderdate >= timestamp '1998-07-01')")
def m14(spark, sf):
    """Profiles that are used stay."""
    cust = read(spark, sf, "customer").select("c_custkey")
    recent = read(spark, sf, "orders").filter(c("o_orderdate") >= F.lit("1998-07-01").cast("timestamp"))
    return cust.join(mt.unreferenced(cust, "c_custkey", [(recent, "o_custkey")]), "c_custkey", "left_anti")


@query("m15_prune_stale", "select event_id from events where not (event_type = 'view' and user_id % 2 = 0 and ts < timestamp '2024-01-15')")
def m15(spark, sf):
    rows = read(spark, sf, "events").select("event_id", c("event_type").alias("league_code"), F.concat(F.lit("src"), c("user_id") % 2).alias("identity"), c("ts").alias("updated_at"))
    return mt.stale_pruned(rows, "view", "src0", F.lit("2024-01-15").cast("timestamp")).select("event_id")


@query(
    "m16_registry_sync",
    "select n_nationkey, case when n_nationkey % 5 = 0 then 'insert' when n_nationkey % 5 = 1 then 'delete' when n_nationkey % 5 = 2 then 'update' else 'keep' end as action, case when n_nationkey % 5 <> 1 then n_name end as n_name from nation",
)
def m16(spark, sf):
    n = read(spark, sf, "nation").select("n_nationkey", "n_name")
    current = n.filter("n_nationkey % 5 <> 0").withColumn("n_name", F.when(c("n_nationkey") % 5 == 2, F.lower("n_name")).otherwise(c("n_name")))
    return mt.synced(current, n.filter("n_nationkey % 5 <> 1"), "n_nationkey")


# --- matching ------------------------------------------------------------------------------------------------------


@query("c1_identity_match", "select c_custkey, case when c_nationkey % 2 = 0 then c_nationkey + 100 end as team_id, case when c_nationkey % 2 = 0 then 'ready' else 'pending' end as status from customer")
def c1(spark, sf):
    staged = read(spark, sf, "customer").select("c_custkey", F.lit("src").alias("identity"), c("c_nationkey").alias("ext_id"), F.lit(None).cast("int").alias("team_id"), F.lit("pending").alias("status"))
    known = read(spark, sf, "nation").filter("n_nationkey % 2 = 0").select(F.lit("src").alias("identity"), c("n_nationkey").alias("ext_id"), (c("n_nationkey") + 100).alias("team_id"))
    return mt.matched(staged, known, ["identity", "ext_id"], "team_id").select("c_custkey", "team_id", "status")


_GAMES = "select strftime(o_orderdate, '%Y-%m-%d') as day, h.n_nationkey as home, a.n_nationkey as away, min(o_orderkey) as ext_id, count(*) as n from orders join customer on o_custkey = c_custkey join nation h on h.n_nationkey = c_nationkey join nation a on a.n_nationkey = (c_nationkey + o_orderkey % 7) % 25 where h.n_nationkey % 4 <> 0 group by 1, 2, 3"


def games(spark, sf):
    o = read(spark, sf, "orders").join(read(spark, sf, "customer").select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey"))
    teams = read(spark, sf, "nation").select(c("n_nationkey").alias("ext"), c("n_nationkey").alias("team_id"))
    rows = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", c("c_nationkey").cast("long").alias("ext_home"), ((c("c_nationkey") + c("o_orderkey") % 7) % 25).alias("ext_away"))
    got = mt.resolved(rows, [("ext_home", teams.filter("ext % 4 <> 0"), "ext", "home=team_id"), ("ext_away", teams, "ext", "away=team_id")])
    return got.groupBy("day", "home", "away").agg(F.min("o_orderkey").alias("ext_id"), F.count("*").alias("n"))


@query("c2_game_resolution", _GAMES)
def c2(spark, sf):
    """Home and away joined to the team map, one row per date and pair."""
    return games(spark, sf)


@query("c3_game_link", f"select day, home, away, ext_id, ext_id % 3 = 0 as old from ({_GAMES})")
def c3(spark, sf):
    """Links by natural key, inserted where absent."""
    g = games(spark, sf).drop("n")
    return mt.insert_absent(g.filter("ext_id % 3 = 0").withColumn("old", F.lit(True)), g.withColumn("old", F.lit(False)), ["ext_id"])


@query("c4_foreign_keys", "select l_orderkey, l_linenumber, l_partkey + 1 as part_id, l_suppkey + 1 as supp_id from lineitem where l_partkey % 3 <> 0 and l_suppkey % 2 = 0")
def c4(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = read(spark, sf, "part").filter("p_partkey % 3 <> 0").select("p_partkey", (c("p_partkey") + 1).alias("part_id"))
    supps = read(spark, sf, "supplier").filter("s_suppkey % 2 = 0").select("s_suppkey", (c("s_suppkey") + 1).alias("supp_id"))
    return mt.resolved(li, [("l_partkey", parts, "p_partkey", "part_id"), ("l_suppkey", supps, "s_suppkey", "supp_id")]).drop("l_partkey", "l_suppkey")


@query("c5_optional_ids", "select o_orderkey, case when o_custkey % 2 = 0 then o_custkey end as cust_id from orders")
def c5(spark, sf):
    some = read(spark, sf, "customer").filter("c_custkey % 2 = 0").select("c_custkey", c("c_custkey").alias("cust_id"))
    return mt.resolved(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), [("o_custkey", some, "c_custkey", "cust_id")], required=False).drop("o_custkey")


@query("c10_missing_profiles", "select distinct l_partkey as p_partkey from lineitem where l_partkey % 4 = 0")
def c10(spark, sf):
    return mt.referenced_missing(read(spark, sf, "lineitem"), "l_partkey", read(spark, sf, "part").filter("p_partkey % 4 <> 0"), "p_partkey")


@query("c11_unreferenced", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and year(o_orderdate) >= 1997) and not exists (select 1 from nation where n_nationkey = c_custkey)")
def c11(spark, sf):
    return mt.unreferenced(read(spark, sf, "customer").select("c_custkey"), "c_custkey", [(read(spark, sf, "orders").filter(F.year("o_orderdate") >= 1997), "o_custkey"), (read(spark, sf, "nation").select(c("n_nationkey").cast("long").alias("n_nationkey")), "n_nationkey")])


# --- coverage ------------------------------------------------------------------------------------------------------

_GRID = "select r_name as target, y::varchar as season, k as col_name from region, (select distinct year(o_orderdate) as y from orders), (values ('a'), ('b')) v(k)"
_COVER = f"select g.*, (length(target) + season::int) % 3 <> 0 and not (col_name = 'b' and season::int % 2 = 0) as covered from ({_GRID}) g"
KEYS = ["target", "season", "col_name"]


def grid(spark, sf):
    seasons = read(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("season")).distinct()
    return mt.coverage_grid(read(spark, sf, "region").select(c("r_name").alias("target")), seasons, spark.createDataFrame([("a",), ("b",)], "col_name string"))


def coverage(spark, sf):
    g = grid(spark, sf)
    done = g.filter(((F.length("target") + c("season").cast("int")) % 3 != 0) & ~((c("col_name") == "b") & (c("season").cast("int") % 2 == 0)))
    return mt.mark_covered(mt.seeded(spark.createDataFrame([], "target string, season string, col_name string, covered boolean"), g, KEYS), done, KEYS)


@query("c12_coverage_grid", f"select *, false as covered from ({_GRID})")
def c12(spark, sf):
    g = grid(spark, sf)
    return mt.seeded(g.filter("season < '1995'").withColumn("covered", F.lit(False)), g, KEYS)


@query("m17_mark_covered", _COVER)
def m17(spark, sf):
    return coverage(spark, sf)


@query("d15_coverage_complete", f"select target, season, bool_and(covered) as complete from ({_COVER}) group by all")
def d15(spark, sf):
    return mt.complete(coverage(spark, sf), ["target", "season"])


@query("m18_reset_active", f"select target, season, col_name, covered and not (season = '1998' and target in ('ASIA', 'EUROPE')) as covered from ({_COVER})")
def m18(spark, sf):
    return mt.reset_active(coverage(spark, sf), spark.createDataFrame([("ASIA", "1998"), ("EUROPE", "1998")], "target string, season string"))


@query("m19_prune_coverage", f"select * from ({_COVER}) where season >= '1995' and col_name <> 'b'")
def m19(spark, sf):
    cov = coverage(spark, sf)
    return mt.pruned_coverage(cov, grid(spark, sf).filter("col_name <> 'b'"), KEYS, "1995")


@query("m20_work_list", f"select target, season from ({_COVER}) group by all having not bool_and(covered) or (season = '1998' and target = 'ASIA')")
def m20(spark, sf):
    return mt.work_list(coverage(spark, sf), ["target", "season"], spark.createDataFrame([("ASIA", "1998")], "target string, season string"))


@query("d19_recent_activity", "select o_orderstatus, count(*) as n from orders where o_orderdate >= (select max(o_orderdate) from orders) - interval 8 day group by 1")
def d19(spark, sf):
    """Season types with a game in the last eight days of the data."""
    return mt.recently_active(read(spark, sf, "orders"), "o_orderstatus", "o_orderdate")


@query(
    "n15_table_rules",
    """select 'not_null' as rule, 'c_acctbal' as "column", c_custkey::varchar as key from customer where c_custkey % 9 = 0
    union all select 'picklist', 'c_mktsegment', c_custkey::varchar from customer where c_mktsegment = 'MACHINERY'
    union all select 'reference', 'c_nationkey', c_custkey::varchar from customer where c_nationkey % 5 = 0
    union all select 'unique', 'c_custkey', c_custkey::varchar from customer where c_custkey % 100 = 3""",
)
def n15(spark, sf):
    cust = read(spark, sf, "customer").withColumn("c_acctbal", F.when(c("c_custkey") % 9 != 0, c("c_acctbal")))
    again = cust.filter("c_custkey % 100 = 3")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
    nations = read(spark, sf, "nation").filter("n_nationkey % 5 <> 0")
    found = mt.quality_errors(cust, ["c_custkey"], ["c_acctbal"], {"c_mktsegment": segments}, {"c_nationkey": (nations, "n_nationkey")})
    return found.unionByName(mt.quality_errors(cust.select("c_custkey").unionByName(again.select("c_custkey")), ["c_custkey"]))


@query("o1_order", "select o_orderkey, year(o_orderdate)::int as season from orders order by 2, 1")
def o1(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("season")).orderBy("season", "o_orderkey")


@query("o2_set_difference", "select l_partkey as key from lineitem except select p_partkey from part where p_partkey % 3 = 0")
def o2(spark, sf):
    return read(spark, sf, "lineitem").select(c("l_partkey").alias("key")).subtract(read(spark, sf, "part").filter("p_partkey % 3 = 0").select("p_partkey"))


@query("o3_union_exists", "select c_custkey from customer where exists (select 1 from (select o_custkey as k from orders union all select n_nationkey from nation) u where u.k = c_custkey)")
def o3(spark, sf):
    used = read(spark, sf, "orders").select(c("o_custkey").alias("c_custkey")).unionByName(read(spark, sf, "nation").select(c("n_nationkey").cast("long").alias("c_custkey")))
    return read(spark, sf, "customer").select("c_custkey").join(used, "c_custkey", "left_semi")


@query("a8_append", "select count(*) * 2 as n, count(c_mktsegment) * 2 as known from customer")
def a8(spark, sf):
    """An append load, twice, read back."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    for _ in range(2):
        append(read(spark, sf, "customer"), path, ["c_custkey", "c_mktsegment"])
    return spark.read.parquet(path).agg(F.count("*").alias("n"), F.count("c_mktsegment").alias("known"))


@query("a9_error_rows", "select 'merge' as phase, 'no key' as message, '{\"event_id\":' || event_id || ',\"user_id\":' || user_id || '}' as detail from events where event_type = 'error'")
def a9(spark, sf):
    return error_rows(read(spark, sf, "events").filter("event_type = 'error'"), "merge", "no key", ["event_id", "user_id"])
