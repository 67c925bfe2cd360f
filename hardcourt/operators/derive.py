"""What the feed leaves out: chains, lineups, scoring sequences, possessions; checked against rules.

A game's events are dealt to one task once; every rule is a window within the game and every inserted event comes out of
the row that causes it, placed by an order key (base position, slot, team, player), so no stage joins or deals again.
Rules that would walk with state reduce to running aggregates: the last row that sets it, and for possession the functions
of the events composed (`owned`). Every window copies every row, so those that share an order are one pass, and stages that
follow on each other keep `seq` in order, not in numbers. Broken rules are gathered on the rows (`errors`); games that have one are gated, not repaired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hardcourt.operators import pbp
from hardcourt.operators.ordered import dealt, opponent

c = F.col
GAME = ("identity", "game_id")
COLUMNS = [*pbp.CONTRACT, "errors"]

#: Fixed values of the chain rules: what a search passes over, and how many other events may lie between.
MAX_GAP = 2
#: Places between two rows of the source, of which rebounds behind shots and fouls before free throws take theirs; more than four
#: times the rows of a game.
UNIT = 1 << 32
MAKES = [*pbp.FG_MAKES, "ft1_make", "ft2_make", "ft3_make"]
REBOUND_SKIP = ["block", "player_in", "player_out", *MAKES, *pbp.REBOUNDS]
FOUL_SKIP = [*MAKES, "ft_miss", "o_foul_draw", "player_in", "player_out", *pbp.REBOUNDS]
OFF_COURT_EXEMPT = pbp.FOULS


def over(*keys: str):
    return W.partitionBy(*GAME, *keys).orderBy("seq")


def before(w):
    return w.rowsBetween(W.unboundedPreceding, -1)


def last_before(test: Column, value: Column, *keys: str) -> Column:
    return F.last(F.when(test, value), ignorenulls=True).over(before(over(*keys)))


def ahead(value: str, *keys: str) -> Column:
    """The first value behind the row that is not null, of a column by its name. It is read in the order in which `last_before`
    is, and a row at a time, so what lies before and behind takes one sort and one pass; for a test, null where it fails."""
    return F.expr(f"lead({value}) ignore nulls over (partition by {', '.join((*GAME, *keys))} order by seq)")


def whole(w):
    """The whole of a window that is ordered: together with what runs along that order it is one pass."""
    return w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def within(aggregate: Column, *keys: str) -> Column:
    return aggregate.over(W.partitionBy(*GAME, *keys))


def is_in(names: list[str]) -> Column:
    return c("event").isin(*names)


def error(test: Column, rule: str) -> Column:
    return F.when(test, F.lit(rule))


def with_errors(df: DataFrame, *found: Column) -> DataFrame:
    broken = F.concat("errors", F.array_compact(F.array(*found)))
    return df.withColumn("errors", F.when(F.coalesce(*found).isNotNull(), broken).otherwise(c("errors")))


def plain() -> dict[str, Column]:
    """What a derived row has unless it is stated; the other columns are those of the row that causes it."""
    none = F.lit(None).cast("string")
    return {"player_id": F.lit(""), "chain_id": none, "fouled_player_id": none, "errors": F.expr("cast(array() as array<string>)")}


def unfolded(df: DataFrame, rows: list[tuple[int, Column | None, dict[str, Column]]], keep: list[str]) -> DataFrame:
    """The rows that are there: (slot, test, what is stated). Slot 0 is the current row, all others are derived from it.

    Only what is stated is unfolded, the rest follows from it; the game's columns are never among it, so that Spark knows that
    every row stays where its game is.
    """
    stated, bare = sorted({n for _, _, change in rows for n in change}), plain()

    def value(slot: int, change: dict[str, Column], n: str) -> Column:
        return change[n] if n in change else bare[n] if slot and n in bare else c(n)

    made = [F.struct(F.lit(slot).alias("_slot"), *(value(slot, change, n).alias(f"_new_{n}") for n in stated)) for slot, _, change in rows]
    made = [m if test is None else F.when(test, m) for m, (_, test, _) in zip(made, rows, strict=True)]
    flat = df.select(*df.columns, F.inline(F.array(*made))).filter("_slot is not null")
    own = c("_slot") == 0
    team = c("_new_team_id" if "team_id" in stated else "team_id")
    values = {n: F.when(own, c(n)).otherwise(v) for n, v in bare.items()}
    values["event_id"] = F.when(own, c("event_id")).otherwise(F.concat(F.lit("D:"), c("event_id"), F.lit(":"), c("_slot").cast("string"), F.lit(":"), team))
    values |= {n: c(f"_new_{n}") for n in stated}
    return flat.select(*GAME, *(values.get(n, c(n)).alias(n) for n in df.columns if n in COLUMNS and n not in GAME), *keep, "_slot", *(c(f"_new_{n}").alias(n) for n in stated if n not in COLUMNS))


def beside(df: DataFrame, rows: list[tuple[int, Column | None, dict[str, Column]]], keep: list[str], number: bool) -> DataFrame:
    """Rows beside the row that causes them, at most one a slot, slots from -8 to 7; numbered anew or else in places of `seq`
    that keep the order and leave some free, which takes no sort."""
    flat = unfolded(df, rows, keep)
    flat = flat.withColumn("seq", c("seq").cast("long") * 16 + c("_slot") + 8)
    return (numbered(flat) if number else flat).select(*COLUMNS, *keep)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """seq is the position in the order given, else in that of seq, from 0. Stages that follow on each other need its order only."""
    return df.withColumn("seq", (F.row_number().over(W.partitionBy(*GAME).orderBy(*(order or ("seq",)))) - 1).cast("int"))


# Stage 1 ------------------------------------------------------------------------------------------------------------


def chained(df: DataFrame, keep: tuple[str, ...] = (), number: bool = True) -> DataFrame:
    """Free throws to fouls, rebounds to missed shots; what these links show to be impossible or misplaced is mended.

    keep may name `_paired`, which `lined_up` needs: whether the row's events hold both an in and an out.
    """
    ft, rebound, foul, standard = is_in(pbp.FTS), is_in(pbp.REBOUNDS), is_in(pbp.FOULS), is_in(pbp.STANDARD_FOULS)

    def passed(skip: list[str]) -> Column:
        return F.coalesce(F.sum((~is_in(skip)).cast("int")).over(before(over())), F.lit(0))

    df = df.withColumns({"_of_foul": passed(FOUL_SKIP), "_of_shot": passed(REBOUND_SKIP), "_other": F.when(~is_in(REBOUND_SKIP), F.struct(F.when(is_in(pbp.SHOTS), F.struct("event_id", "team_id", "seq")).alias("shot")))})
    df = df.withColumns({
        "_foul": last_before(foul, F.struct(c("_of_foul").alias("n"), "event_id")),
        "_miss": last_before(is_in(pbp.MISSES), F.struct(c("_of_shot").alias("n"), "period", F.struct("event_id", "team_id", "seq").alias("shot"))),
        "_ahead": ahead("_other", "period"),
    })
    df = df.withColumn("_foul", F.when(ft & (c("_of_foul") - c("_foul.n") - 1 <= MAX_GAP), c("_foul")))
    near = (c("_of_shot") - c("_miss.n") - 1 <= MAX_GAP) & (c("_miss.period") == c("period"))
    df = df.withColumn("_shot", F.when(rebound, F.when(near, c("_miss.shot")).otherwise(c("_ahead.shot"))))
    df = with_errors(df, error(ft & c("_foul").isNull(), "ft_without_foul"), error(rebound & c("_shot").isNull(), "rebound_no_shot"))
    there = rebound & c("_shot").isNotNull()
    kind = F.when((c("event") == "rebound") & c("_shot").isNotNull(), F.when(c("_shot.team_id") == c("team_id"), "o_reb").otherwise("d_reb")).otherwise(c("event"))
    # a rebound stands directly behind its shot; of several the one recorded last comes first, as each is put there in turn:
    # a row's place is that of its shot, or its own, in units that hold the rebounds backwards
    place = F.when(there, c("_shot.seq").cast("long") * UNIT + UNIT // 2 - c("seq")).otherwise(c("seq").cast("long") * UNIT)
    df = df.withColumns({"chain_id": F.when(ft, c("_foul.event_id")).when(rebound, c("_shot.event_id")).otherwise(c("chain_id")), "event": kind, "seq": place})
    df = df.select(*COLUMNS, *(n for n in keep if n in df.columns))
    # a miss on a shot that was fouled: the foul is the record of the attempt, so it carries the error, and the miss goes
    # with all events of its row
    df = df.withColumn("_trip", F.when(ft, c("chain_id")).when(foul, c("event_id"))).withColumn("_shots", within(F.count(F.when(ft, 1)), "_trip"))
    df = df.withColumn("_hit", F.when(c("event") != "block", F.struct(F.when(standard & (c("_shots") > 0), c("fouled_player_id")).alias("who"))))
    df = df.withColumns({"_next": ahead("_hit", "period"), "_past": last_before(c("event") != "block", F.struct(F.when(is_in(pbp.FG_MISSES), c("player_id")).alias("who")), "period")})
    record = standard & (c("_past.who") == c("fouled_player_id")) & (c("_shots") > 0)
    fouled = is_in(pbp.FG_MISSES) & (c("_next.who") == c("player_id"))
    df = with_errors(df.withColumn("_fouled", F.coalesce(fouled, F.lit(False))), error(record, "fouled_shot_miss"))
    df = df.withColumns({"_impossible": within(F.max("_fouled"), "event_id"), "_paired": paired()}).filter("not _impossible")
    df = trips(df)
    # rebounds inside a trip, and all but the first of a shot
    df = df.withColumn("_key", F.when(is_in(pbp.SHOTS), c("event_id")).when(rebound, c("chain_id")))
    held = F.when(ft & (c("seq") < c("_trip_last")), True).when(c("_absorbed"), True).otherwise(False)
    df = df.withColumns({"_inner": F.max(held).over(whole(over("_key"))), "_nth": F.count(F.when(rebound, 1)).over(over("_key").rowsBetween(W.unboundedPreceding, 0))})
    df = df.withColumn("_gone", rebound & c("chain_id").isNotNull() & (c("_inner") | (c("_nth") > 1))).filter("not _gone")
    # a foul whose free throws are shot in another period goes there, directly before the first one; of several the earlier first
    cross = foul & (c("_trip_n") > 0) & (c("_trip_start.period") != c("period"))
    there = c("_trip_start.seq") - UNIT // 4 + F.floor(c("seq") / UNIT).cast("long")
    moved = {"seq": F.when(cross, there).otherwise(c("seq")), "period": F.when(cross, c("_trip_start.period")).otherwise(c("period")), "secs": F.when(cross, c("_trip_start.secs")).otherwise(c("secs"))}
    df = df.withColumns(moved).select(*COLUMNS, *keep)
    return numbered(df) if number else df


def paired() -> Column:
    """Whether the events of the source row hold both an in and an out."""
    return within(F.max(c("event") == "player_in"), "event_id") & within(F.max(c("event") == "player_out"), "event_id")


def trips(df: DataFrame) -> DataFrame:
    """Per foul and its free throws: their number, first and last, whether a standard foul gave them; on makes, whether the trip
    absorbs them; whether the trip comes after such a make."""
    ft, has = is_in(pbp.FTS), c("_trip").isNotNull()
    df = df.withColumn("_trip", F.when(ft, c("chain_id")).when(is_in(pbp.FOULS), c("event_id")))
    df = df.withColumns({
        "_trip_n": F.when(has, within(F.count(F.when(ft, 1)), "_trip")).otherwise(0),
        "_trip_start": F.when(has, within(F.min(F.when(ft, F.struct("seq", "period", "secs"))), "_trip")),
        "_trip_last": F.when(has, within(F.max(F.when(ft, c("seq"))), "_trip")),
        "_team0": F.when(has, within(F.min(F.when(ft, c("team_id"))), "_trip")),
        "_team1": F.when(has, within(F.max(F.when(ft, c("team_id"))), "_trip")),
        "_standard": ft & F.coalesce(within(F.max(F.when(is_in(pbp.STANDARD_FOULS), True)), "_trip"), F.lit(False)),
    })
    # whose the free throws of a standard foul are, if they are of one team
    whose = F.when(is_in(pbp.STANDARD_FOULS) & (c("_trip_n") > 0) & (c("_team0") == c("_team1")), c("_team0"))
    df = df.withColumn("_shown", F.when(~is_in(pbp.ASSISTS), F.struct("event_id", whose.alias("team")))).drop("_team0", "_team1").withColumn("_next", ahead("_shown", "period"))
    df = df.withColumn("_absorbed", F.coalesce(is_in(pbp.FG_MAKES) & (c("_next.team") == c("team_id")), F.lit(False)))
    df = df.withColumn("_and_one", F.when(c("_absorbed"), c("_next.event_id")).otherwise(c("_trip")))
    return df.withColumn("_after_make", c("_and_one").isNotNull() & within(F.max("_absorbed"), "_and_one")).drop("_shown", "_next", "_and_one")


# Stage 2 ------------------------------------------------------------------------------------------------------------


def lined_up(df: DataFrame, size: Column) -> DataFrame:
    """Starters after every period's start, everyone on court taken off at its end. df has home, away."""
    src = ~c("source").startswith("derived") & (c("team_id") != "")
    sub, goes_in, goes_out = is_in(["player_in", "player_out"]), c("event") == "player_in", c("event") == "player_out"
    active = src & is_in(pbp.COURT) & (c("player_id") != "")
    df = df.withColumn("_active", active)
    if "_paired" not in df.columns:
        df = df.withColumn("_paired", paired())
    # every window here follows the order of the players of a team of a period, so all take one sort
    first = F.min(F.when(c("_active"), c("seq"))).over(whole(W.partitionBy(*GAME, "period", "team_id").orderBy("player_id", "seq")))
    df = df.withColumn("_first", first)
    df = df.withColumn("_boundary", src & sub & c("_paired") & (c("period") > 1) & (c("_first").isNull() | (c("seq") < c("_first"))))
    on = (src & goes_in) | c("_active")
    df = df.withColumn("_kind", F.when(on, "in").when(src & goes_out & ~c("_boundary"), "out")).drop("_first", "_paired")
    keys = ("period", "team_id", "player_id")
    df = df.withColumns({"_was": last_before(c("_kind").isNotNull(), c("_kind"), *keys), "_final": F.max(F.when(c("_kind").isNotNull(), c("seq"))).over(whole(over(*keys)))})
    df = df.withColumns({"_was_in": F.coalesce(c("_was") == "in", F.lit(False)), "_stays": F.coalesce((c("_kind") == "in") & (c("seq") == c("_final")), F.lit(False))})
    starts = F.coalesce((c("_kind").isNotNull() & ~c("_was_in") & (c("_active") | (c("_kind") == "out"))) | (c("_boundary") & goes_in), F.lit(False))
    df = df.withColumn("_starts", starts).drop("_was", "_final", "_kind", "_active")
    df = df.withColumn("_starts", c("_starts") & (F.count(F.when(c("_starts"), 1)).over(over(*keys).rowsBetween(W.unboundedPreceding, 0)) == 1))
    starting = c("event") == "period_start"
    df = df.withColumns({
        "_start": within(F.min(F.when(starting, F.struct("seq", "secs"))), "period"),
        "_end": within(F.max(F.when(c("event") == "period_end", F.struct("seq", "secs"))), "period"),
        "_last": within(F.max("seq"), "period"),
        **{f"_n_{t}": within(F.count(F.when(c("_stays") & (c("team_id") == c(t)), 1)), "period") for t in ("home", "away")},
    })
    begun, counts = c("_start").isNotNull(), (c("_n_home"), c("_n_away"))
    wrong = [error(starting & (n < size), "lineup_too_small") for n in counts] + [error(starting & (n > size), "lineup_too_large") for n in counts]
    df = with_errors(df, error(src & goes_in & ~c("_boundary") & c("_was_in"), "player_in_twice"), error(starting & c("_end").isNull(), "missing_period_end"), *wrong)
    rows = [
        (0, ~c("_boundary"), {"_base": c("seq")}),
        (2, begun & c("_starts"), {"_base": c("_start.seq"), "event": F.lit("player_in"), "player_id": c("player_id"), "secs": c("_start.secs"), "source": F.lit("derived:starter")}),
        (5, begun & c("_stays"), {"_base": F.coalesce(c("_end.seq"), c("_last")), "event": F.lit("player_out"), "player_id": c("player_id"), "secs": F.when(c("_end").isNotNull(), c("_end.secs")).otherwise(c("_start.secs")), "source": F.lit("derived:lineup_sweep")}),
    ]
    flat = unfolded(df, rows, ["home", "away"]).withColumn("_by", F.when(c("_slot") != 0, F.struct("team_id", "player_id")))
    return numbered(flat, "_base", "_slot", "_by", "seq").select(*COLUMNS, "home", "away")


# Stage 3 ------------------------------------------------------------------------------------------------------------


def scored_sequences(df: DataFrame, number: bool = True) -> DataFrame:
    """A marker before the first shot of every scoring sequence; `_final` on misses that end one."""
    df = trips(df)
    fg, ft, indicates = is_in(pbp.FIELD_GOALS), c("_standard"), is_in(pbp.POSSESSION)
    relevant = fg | ft | indicates
    live = (is_in(pbp.FG_MAKES) & ~c("_absorbed")) | (ft & (c("event") != "ft_miss") & (c("seq") == c("_trip_last")))
    df = df.withColumn("_live", live).drop("_trip", "_trip_n", "_trip_start", "_trip_last", "_absorbed")
    df = df.withColumn("_past", last_before(relevant, F.struct("team_id", indicates.alias("p"))))
    fg_opens = fg & (c("_past").isNull() | c("_past.p") | (c("_past.team_id") != c("team_id")))
    df = df.withColumn("_fg_opens", F.coalesce(fg_opens, F.lit(False))).drop("_past")
    df = df.withColumn("_last", last_before(ft | indicates | c("_fg_opens"), F.struct(F.when(ft, c("chain_id")).alias("t"))))
    ft_opens = ft & ~c("_after_make") & ~F.coalesce(c("_last.t") == c("chain_id"), F.lit(False))
    df = df.withColumn("_opens", c("_fg_opens") | F.coalesce(ft_opens, F.lit(False))).drop("_last", "_fg_opens", "_after_make")
    df = df.withColumn("_relevant", F.when(relevant, F.struct((indicates | c("_opens")).alias("closes")))).withColumn("_next", ahead("_relevant"))
    df = df.withColumn("_final", is_in(pbp.MISSES) & (fg | ft) & F.coalesce(c("_next.closes"), F.lit(True))).drop("_relevant", "_next", "_standard")
    marker = {"event": F.lit("pot_poss_ending_scoring_opp"), "player_id": c("player_id"), "chain_id": c("event_id"), "source": F.lit("derived:scoring_opp")}
    flat = beside(df, [(0, None, {}), (-1, c("_opens"), marker)], ["home", "away", "_final", "_live"], number)
    own = ~c("source").startswith("derived")
    return flat.withColumns({"_final": c("_final") & own, "_live": c("_live") & own})


# Stage 4 ------------------------------------------------------------------------------------------------------------


def owned(df: DataFrame) -> DataFrame:
    """`_was`: who possesses before each event; `_spent`: whether a turnover by the wrong team stands since it last changed.

    A sequential walk has two states for every holder, as a jump ball changes nothing behind a wrong turnover. Every event
    but a jump ball that sets the holder sets it to a constant, so between two of them only the last jump ball matters, and
    only if the state was 0. What such an event makes of that state is therefore a function of 0 and 1 to 0 and 1: a
    constant, the identity or the negation. Functions composed up to an event are the last constant, negated once for each
    negation since: two running aggregates, however often wrong turnovers and jump balls alternate.
    """
    own, starts, ends, team = ~c("source").startswith("derived"), c("event") == "period_start", c("event") == "period_end", c("team_id")
    hands = is_in(["turnover", "d_reb"]) | c("_live")
    sets = (
        F.when(starts, F.struct(c("_first").alias("t")))
        .when(ends, F.struct(F.lit(None).cast("string").alias("t")))
        .when((c("event") == "turnover") | (c("_live") & c("_held")), F.struct(c("_other").alias("t")))
        .when(c("event") == "d_reb", F.struct(team.alias("t")))
        .when(c("_lost"), F.struct(c("_reb").alias("t")))
        .when(c("_soft") & ~c("_held"), F.struct(team.alias("t")))
    )
    df = df.withColumn("_sets", sets)
    jump = c("_jump") & c("_held")
    df = df.withColumns({
        "_set": F.last("_sets", ignorenulls=True).over(before(over()))["t"],
        "_jumped": F.last(F.when(c("_sets").isNotNull(), c("_sets")).when(jump, F.struct(team.alias("t"))), ignorenulls=True).over(before(over()))["t"],
    })
    may_keep, to = c("_sets").isNotNull() & c("_held") & hands, c("_sets.t")
    of0 = may_keep & own & (c("event") == "turnover") & F.coalesce(c("_jumped") == to, F.lit(False))
    of1 = may_keep & F.coalesce(c("_set") == to, F.lit(False))
    df = df.withColumns({"_of0": of0, "_negates": of0 & ~of1, "_fixed": c("_sets").isNotNull() & (of0 == of1)})
    df = df.withColumn("_turns", F.coalesce(F.sum(c("_negates").cast("int")).over(before(over())), F.lit(0)))
    last = F.last(F.when(c("_fixed"), F.struct(c("_of0").cast("int").alias("v"), c("_turns").alias("n"))), ignorenulls=True).over(before(over()))
    state = (F.coalesce(last["v"], F.lit(0)) + c("_turns") - F.coalesce(last["n"], F.lit(0))) % 2
    df = df.withColumn("_spent", state == 1)
    return df.withColumn("_was", F.when(c("_spent"), c("_set")).otherwise(c("_jumped"))).drop("_sets", "_set", "_jumped", "_of0", "_negates", "_fixed", "_turns")


def possessed(df: DataFrame, number: bool = True) -> DataFrame:
    """Possession markers, team rebounds nobody recorded, turnovers behind jump balls."""
    own, starts, ends = ~c("source").startswith("derived"), c("event") == "period_start", c("event") == "period_end"
    other = opponent(c("team_id"))
    indicates, team = is_in(pbp.POSSESSION), c("team_id")
    key = F.when(is_in(pbp.MISSES), c("event_id")).when(is_in(pbp.REBOUNDS), c("chain_id"))
    df = df.withColumn("_key", key).withColumn("_has_reb", within(F.max(is_in(pbp.REBOUNDS)), "_key")).drop("_key")
    df = df.withColumns({"_shows": F.when(indicates | ends, F.struct("event", "team_id")), "_stops": F.when(ends, c("seq"))})
    df = df.withColumns({"_nextp": ahead("_shows"), "_stop": ahead("_stops"), "_near": F.min(F.when((c("event") == "turnover") & own, c("seq"))).over(over().rowsBetween(1, MAX_GAP + 1))}).drop("_shows", "_stops")
    reb = F.when(c("_final") & ~c("_has_reb"), F.when(c("_nextp.event") == "period_end", other).otherwise(c("_nextp.team_id")))
    jump = (c("event") == "jump_ball_win") & ~(c("_near").isNotNull() & (c("_stop").isNull() | (c("_near") < c("_stop"))))
    first = F.when(c("_nextp.event") != "period_end", c("_nextp.team_id"))
    df = df.withColumns({"_other": other, "_reb": reb, "_jump": jump, "_first": first}).drop("_nextp", "_stop", "_near", "_has_reb", "_final")
    # nobody possesses from a period's bounds on until its first event that opens a possession
    soft = (indicates & ~is_in(["turnover", "d_reb", "jump_ball_win"])) | (c("_reb") == team)
    opens = (starts & c("_first").isNotNull()) | is_in(["turnover", "d_reb"]) | soft | c("_reb").isNotNull()
    df = df.withColumns({"_soft": F.coalesce(soft, F.lit(False)), "_lost": F.coalesce(c("_reb") != team, F.lit(False))})
    df = df.withColumns({"_opened": F.max(F.when(opens, c("seq"))).over(before(over())), "_bound": F.max(F.when(starts | ends, c("seq"))).over(over().rowsBetween(W.unboundedPreceding, 0))})
    df = df.withColumn("_held", F.coalesce(c("_opened") >= F.coalesce("_bound", "_opened"), F.lit(False))).drop("_opened", "_bound")

    df = owned(df)
    was, to = c("_was"), F.when(c("event") == "d_reb", team).otherwise(c("_other"))
    hands = is_in(["turnover", "d_reb"]) | c("_live")
    changes = hands & to.isNotNull() & (was.isNull() | (was != to)) & (was.isNotNull() | ~c("_live"))
    opened = c("_soft") & was.isNull()
    jumped = c("_jump") & ~c("_spent") & was.isNotNull() & (was != team)
    gives = c("_lost") & (was.isNull() | (was == team))
    mismatch = ((c("event") == "turnover") & (was != team)) | (c("_live") & was.isNotNull() & (was != team)) | (c("_lost") & was.isNotNull() & (was != team))
    loose = indicates & ~is_in(["turnover", "d_reb", "jump_ball_win"]) & was.isNotNull() & (was != team)
    held = c("_reb").isNotNull() & ~c("_lost") & was.isNotNull() & (was != c("_reb"))
    df = with_errors(df, error(F.coalesce(mismatch, F.lit(False)), "poss_mismatch"), error(F.coalesce(loose | held, F.lit(False)), "poss_change_without_transition"))

    def marker(test: Column, slot: int, event: str, team_: Column) -> tuple[int, Column, dict[str, Column]]:
        return slot, test & team_.isNotNull(), {"event": F.lit(event), "team_id": team_, "source": F.lit(f"derived:{event}")}

    miss = c("_reb").isNotNull()
    rows = [
        (0, None, {}),
        marker(starts, 1, "poss_start", c("_first")),
        marker(ends, 1, "poss_end", was),
        marker(changes, 1, "poss_end", was),
        marker(changes, 2, "poss_start", to),
        marker(opened & ~miss, -1, "poss_start", team),
        marker(opened & miss, 2, "poss_start", team),
        (-3, jumped, {"event": F.lit("turnover"), "team_id": was, "chain_id": c("event_id"), "source": F.lit("derived:jump_ball_turnover")}),
        marker(jumped, -2, "poss_end", was),
        marker(jumped, -1, "poss_start", team),
        marker(gives, 1, "poss_end", was),
        marker(gives, 2, "poss_start", c("_reb")),
        (3, miss, {"event": F.when(c("_lost"), "d_reb").otherwise("o_reb"), "team_id": c("_reb"), "chain_id": c("event_id"), "source": F.lit("derived:team_rebound")}),
    ]
    return beside(df, rows, ["home", "away"], number)


# Stage 5 ------------------------------------------------------------------------------------------------------------


def cleaned(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Windows in which the team did nothing dropped, clocks completed, the final rules checked."""
    mark = is_in(["poss_start", "poss_end"])
    acts = mark | is_in(pbp.POSSESSION)
    df = df.withColumn("_acts", F.when(acts, c("event"))).withColumns({"_past": last_before(acts, c("event"), "team_id"), "_next": ahead("_acts", "team_id")})
    empty = ((c("event") == "poss_start") & (c("_next") == "poss_end")) | ((c("event") == "poss_end") & (c("_past") == "poss_start"))
    df = df.withColumn("_empty", F.coalesce(empty, F.lit(False))).filter("not _empty").drop("_acts", "_past", "_next", "_empty")
    df = checked(df).select(*COLUMNS, *keep)
    clock = last_before(is_in(pbp.POSSESSION), F.struct("secs"), "period")
    df = df.withColumn("secs", F.when(c("secs").isNull() & is_in(pbp.CLOCK), clock["secs"]).otherwise(c("secs")))
    return numbered(df).select(*COLUMNS, *keep)


def court_before() -> Column:
    """How often the event's player has gone in less often gone out, before it."""
    step = F.when(c("event") == "player_in", 1).when(c("event") == "player_out", -1).otherwise(0)
    return F.coalesce(F.sum(step).over(before(over("team_id", "player_id"))), F.lit(0))


def checked(df: DataFrame) -> DataFrame:
    own, step = ~c("source").startswith("derived"), F.when(c("event") == "player_in", 1).when(c("event") == "player_out", -1).otherwise(0)
    mark, sub = is_in(["poss_start", "poss_end"]), is_in(["player_in", "player_out"])
    team, player = over("team_id"), over("team_id", "player_id")
    df = df.withColumns({"_past": last_before(mark, c("event"), "team_id"), "_last": F.max(F.when(mark, c("seq"))).over(whole(team))})
    df = df.withColumns({"_double": (c("event") == "poss_start") & (c("_past") == "poss_start"), "_closed": (c("event") == "poss_end") & F.coalesce(c("_past") == "poss_end", F.lit(True)), "_open": (c("event") == "poss_start") & (c("seq") == c("_last"))}).drop("_past", "_last")
    df = df.withColumns({"_court": court_before(), "_left": F.sum(step).over(whole(player)), "_last": F.max(F.when(sub, c("seq"))).over(whole(player))})
    df = df.withColumn("_late", F.coalesce(own & (c("seq") > within(F.max(F.when(c("event") == "period_end", c("seq"))))), F.lit(False)))
    return with_errors(
        df,
        error(is_in(pbp.STANDARD_FOULS) & F.coalesce(c("fouled_player_id") == "", F.lit(True)), "foul_without_fouled_player"),
        error(c("_double"), "double_poss_open"),
        error(c("_closed"), "poss_end_no_open"),
        error(c("_open"), "poss_marker_unpaired"),
        error(c("_late"), "activity_after_end"),
        error(own & (c("event") == "player_out") & (c("_court") <= 0), "player_out_not_on_court"),
        error((c("event") == "player_in") & (c("_left") > 0) & (c("seq") == c("_last")), "player_marker_unpaired"),
        error(is_in(pbp.COURT) & (c("team_id") != "") & (c("player_id") != "") & ~is_in(OFF_COURT_EXEMPT) & (c("_court") <= 0) & ~c("_late"), "event_off_court"),
    )


def derived(events: DataFrame, games: DataFrame | None = None, lineup_size: int = 5, apart: int = 0) -> DataFrame:
    """The event contract completed, with `errors` per row. games: (game_id, home, away).

    Without games the events hold home and away, as the result then does, and are dealt by game already
    (`ordered.dealt`), so that nothing is joined or shuffled here. Where games are long, every stage's sorts of a game take
    memory in proportion; `apart`, the rows of the source, deals games anew between the stages, so that no task holds the
    sorts of more than one.
    """

    def then(df: DataFrame) -> DataFrame:
        return dealt(df, apart, *GAME) if apart else df

    keep = () if games is not None else ("home", "away")
    rows = events.withColumn("errors", F.expr("cast(array() as array<string>)"))
    if games is not None:
        rows = dealt(rows.select(*COLUMNS).join(games.select("game_id", "home", "away"), "game_id"), events.count(), *GAME)
    df = then(chained(then(rows.select(*COLUMNS, "home", "away")), ("home", "away", "_paired"), number=False))
    df = then(scored_sequences(then(lined_up(df, F.lit(lineup_size))), number=False))
    return cleaned(then(possessed(df, number=False)), keep)


def game_errors(stream: DataFrame) -> DataFrame:
    """(identity, game_id, rule, event_id, event, n): the rules broken."""
    return stream.select(*GAME, F.explode("errors").alias("rule"), "event_id", "event").groupBy(*GAME, "rule", "event_id", "event").agg(F.count("*").alias("n"))


def game_status(stream: DataFrame, unclassified: DataFrame | None = None) -> DataFrame:
    """(identity, game_id, status, n_unclassified, keys): error if any rule is broken or any raw row could not be classified.

    unclassified: such rows (identity, game_id, event_key); their keys are listed, each once, in order.
    """
    found = stream.groupBy(*GAME).agg(F.max(F.size("errors") > 0).alias("bad"))
    if unclassified is None:
        found = found.withColumns({"n": F.lit(0).cast("long"), "keys": F.lit(None).cast("string")})
    else:
        rows = unclassified.groupBy(*GAME).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("event_key")), ",").alias("keys"))
        found = found.join(rows, [*GAME], "full_outer").withColumns({"bad": F.coalesce("bad", F.lit(False)) | c("n").isNotNull(), "n": F.coalesce("n", F.lit(0))})
    return found.select(*GAME, F.when(c("bad"), "error").otherwise("ready").alias("status"), c("n").alias("n_unclassified"), "keys")
