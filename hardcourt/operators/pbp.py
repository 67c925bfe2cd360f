"""Raw play-by-play rows to one event contract: classification, entity resolution, normalisation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hardcourt.functions.transforms import to_int, to_str

c = F.col


@dataclass(frozen=True)
class Event:
    """Indicates possession, indicates a player on court, may inherit a clock, is a shot; points; family; hands over."""

    possession: bool = False
    court: bool = False
    clock: bool = False
    shot: bool = False
    points: int = 0
    family: str = ""
    hands_over: str = ""


#: The event vocabulary.
EVENTS: dict[str, Event] = {
    "d_reb": Event(possession=True, court=True, hands_over="to_self"),
    "o_reb": Event(possession=True, court=True),
    "rebound": Event(possession=True, court=True),
    "o_standard_foul": Event(family="foul"),
    "d_standard_foul": Event(family="foul"),
    "elevated_foul": Event(family="elevated"),
    "pot_poss_ending_scoring_opp": Event(possession=True),
    "fg2_make": Event(court=True, shot=True, points=2, family="fg_make", hands_over="live_shot"),
    "fg2_miss": Event(court=True, shot=True, family="fg_miss"),
    "fg3_make": Event(court=True, shot=True, points=3, family="fg_make", hands_over="live_shot"),
    "fg3_miss": Event(court=True, shot=True, family="fg_miss"),
    "turnover": Event(possession=True, court=True, hands_over="to_opponent"),
    "fg2_assist": Event(court=True),
    "fg3_assist": Event(court=True),
    "block": Event(court=True),
    "steal": Event(court=True),
    "o_foul_draw": Event(court=True),
    "ft1_make": Event(court=True, shot=True, points=1, family="ft", hands_over="live_shot"),
    "ft2_make": Event(court=True, shot=True, points=2, family="ft", hands_over="live_shot"),
    "ft3_make": Event(court=True, shot=True, points=3, family="ft", hands_over="live_shot"),
    "ft_miss": Event(court=True, shot=True, family="ft"),
    "period_end": Event(clock=True),
    "player_out": Event(court=True, clock=True),
    "period_start": Event(),
    "player_in": Event(court=True, clock=True),
    "jump_ball_win": Event(possession=True, court=True, hands_over="jump"),
    "poss_end": Event(clock=True),
    "poss_start": Event(clock=True),
}


def names(test) -> list[str]:
    return [n for n, e in EVENTS.items() if test(e)]


POSSESSION, CLOCK, SHOTS = names(lambda e: e.possession), names(lambda e: e.clock), names(lambda e: e.shot)
COURT = [n for n in names(lambda e: e.court) if n not in ("player_in", "player_out", "jump_ball_win")]
FG_MAKES, FG_MISSES, FTS = (names(lambda e, f=f: e.family == f) for f in ("fg_make", "fg_miss", "ft"))
FIELD_GOALS, MISSES = FG_MAKES + FG_MISSES, [*FG_MISSES, "ft_miss"]
STANDARD_FOULS, FOULS = names(lambda e: e.family == "foul"), names(lambda e: e.family in ("foul", "elevated"))
REBOUNDS, ASSISTS = ["d_reb", "o_reb", "rebound"], ["fg2_assist", "fg3_assist"]
TRUSTED = {*EVENTS, "ignore", "substitution"}

CONTRACT = (
    "identity", "game_id", "event_id", "seq", "secs", "period", "team_id", "player_id", "event", "chain_id", "fouled_player_id", "source",
)


def event_key(rows: DataFrame) -> DataFrame:
    """The archive's match strategy: type and action, with the distinguishing words of field goals and free throws."""
    words = F.upper(F.concat_ws(" ", *(F.coalesce(c(n), F.lit("")) for n in ("HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION"))))
    kind = to_int(c("EVENTMSGTYPE"))

    def has(word: str) -> Column:
        return F.concat(F.when(words.contains(word), "_HAS=").otherwise("_NO="), F.lit(word))

    extra = F.when(kind.isin(1, 2), has("3PT")).when(kind == 3, has("MISS")).otherwise("")
    return rows.withColumn("event_key", F.concat(F.lit("MSG="), kind.cast("string"), F.lit("_ACT="), to_int(c("EVENTMSGACTIONTYPE")).cast("string"), extra))


#: How the rows of a source get their event_key; a new source is a line here, or a function given to keyed().
STRATEGIES = {"archive": event_key}


def keyed(rows: DataFrame, strategy: str | Callable[[DataFrame], DataFrame] = "archive") -> DataFrame:
    """rows with event_key, by a named strategy or by a function."""
    return (STRATEGIES[strategy] if isinstance(strategy, str) else strategy)(rows)


def discovered(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """(identity, dataset, event_key, n, known, classified_pct): the distinct keys, how often each occurs, whether the
    catalog has a handling for it that counts, and the share of all rows of which it does, to one decimal.

    Keys are counted before anything else, so what meets is a row a key.
    """
    keys = ["identity", "dataset", "event_key"]
    counted = classified(rows.groupBy(*keys).agg(F.count("*").alias("n")), catalog).withColumn("known", ~c("unclassified"))
    whole = W.partitionBy("identity", "dataset")
    share = F.round(100.0 * F.sum(F.when(c("known"), c("n")).otherwise(0)).over(whole) / F.sum("n").over(whole), 1)
    return counted.select(*keys, "n", "known", share.alias("classified_pct"))


def classified(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """rows (identity, dataset, event_key, ...) with handling and unclassified; handlings that are not trusted don't count.

    The catalog is a dimension of a few hundred keys; Spark broadcasts it if it is under the session's limit.
    """
    known = catalog.select("identity", "dataset", "event_key", F.when(c("handling").isin(*TRUSTED), c("handling")).alias("handling"))
    known = known.groupBy("identity", "dataset", "event_key").agg(F.min("handling").alias("handling"))
    return rows.join(known, ["identity", "dataset", "event_key"], "left").withColumn("unclassified", c("handling").isNull())


def entity_dimension(teams: DataFrame, players: DataFrame) -> DataFrame:
    """(ext_id, entity_type, team_id): teams win over players of the same id; blank and 0 are nobody."""
    both = teams.select("ext_id", F.lit("team").alias("entity_type"), c("ext_id").alias("team_id"), F.lit(0).alias("p")).unionByName(players.select("ext_id", F.lit("player").alias("entity_type"), "team_id", F.lit(1).alias("p")))
    real = both.filter(F.coalesce(F.trim("ext_id"), F.lit("")).isin("", "0") == F.lit(False))
    return real.groupBy("ext_id").agg(F.min_by(F.struct("entity_type", "team_id"), F.struct("p", F.coalesce("team_id", F.lit("")))).alias("e")).select("ext_id", "e.entity_type", "e.team_id")


def period_lengths(rows: DataFrame) -> DataFrame:
    """(game_id, regulation, overtime) seconds: the start clock of period 1 and the first overtime, else the largest seen."""
    remaining = _remaining(c("PCTIMESTRING"))
    period, number, start = to_int(c("PERIOD")), to_int(c("EVENTNUM")), to_int(c("EVENTMSGTYPE")) == 12

    def length(which: Column) -> Column:
        return F.coalesce(F.min_by(remaining, F.when(which & start & remaining.isNotNull(), number)), F.max(F.when(which, remaining)))

    return rows.groupBy(c("GAME_ID").alias("game_id")).agg(length(period == 1).alias("regulation"), length(period == 5).alias("overtime"))


def _remaining(clock: Column) -> Column:
    parts = F.split(F.trim(clock), ":")
    ok = F.trim(clock).rlike(r"^\d+:\d+$")
    return F.when(ok, F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int"))


def elapsed(clock: Column, period: Column, regulation: Column, overtime: Column) -> Column:
    """Seconds since the game's start; null where the clock can't be read or a needed length is unknown."""
    before = F.when(period <= 5, regulation * (period - 1)).otherwise(regulation * 4 + overtime * (period - 5))
    length = F.when(period <= 4, regulation).otherwise(overtime)
    return F.when(period >= 1, before + length - _remaining(clock))


def normalised(rows: DataFrame, entities: DataFrame, games: DataFrame) -> DataFrame:
    """Classified raw rows to the event contract: no, one or two events a row.

    entities: (ext_id, entity_type, team_id); games: (game_id, home, away). A row without a usable entity is dropped
    unless it is a system row or a foul.
    """

    def slot(n: int) -> DataFrame:
        return entities.select(c("ext_id").alias(f"_x{n}"), c("entity_type").alias(f"_t{n}"), c("team_id").alias(f"_m{n}"))

    lengths = period_lengths(rows)
    e = rows.filter(~c("unclassified") & (c("handling") != "ignore")).withColumn("game_id", c("GAME_ID"))
    for n in (1, 2, 3):
        e = e.withColumn(f"_x{n}", to_str(c(f"PLAYER{n}_ID"))).join(slot(n), f"_x{n}", "left")
    e = e.join(lengths, "game_id", "left").join(games, "game_id", "left")
    period = to_int(c("PERIOD"))
    row_team = to_str(c("PLAYER1_TEAM_ID")) if "PLAYER1_TEAM_ID" in rows.columns else F.lit("")
    third_team = to_str(c("PLAYER3_TEAM_ID")) if "PLAYER3_TEAM_ID" in rows.columns else F.lit("")
    team = F.coalesce(F.when(row_team.isin("", "0") == F.lit(False), row_team), c("_m1"), F.lit(""))

    def player(n: int) -> Column:
        return F.when(c(f"_t{n}") == "player", c(f"_x{n}"))

    actor = F.coalesce(player(1), F.lit(""))
    opponent = F.when(team == c("home"), c("away")).when(team == c("away"), c("home")).otherwise("")
    handling = c("handling")

    def one(event: Column | str, team_: Column, player_: Column, fouled: Column | None = None) -> Column:
        return F.struct(
            (F.lit(event) if isinstance(event, str) else event).alias("event"), team_.alias("team_id"), player_.alias("player_id"),
            (F.lit(None).cast("string") if fouled is None else fouled).alias("fouled_player_id"),
        )

    nothing = F.lit("")
    fouled = F.when(handling != "elevated_foul", player(2))
    second = F.coalesce(player(2), nothing)
    has2, has3 = player(2).isNotNull(), player(3).isNotNull()
    kind = F.regexp_extract(handling, "^(fg[23])_", 1)
    jump_team = F.coalesce(F.when(third_team.isin("", "0") == F.lit(False), third_team), F.when(c("_t3").isNotNull(), c("_m3")), team)
    known = c("_t1").isNotNull() | (row_team.isin("", "0") == F.lit(False))
    made = (
        F.when(handling.isin("period_start", "period_end"), F.array(one(handling, nothing, nothing)))
        .when(handling.isin(*FOULS), F.when((handling == "o_standard_foul") & has2, F.array(one(handling, team, actor, fouled), one("o_foul_draw", opponent, second))).otherwise(F.array(one(handling, team, actor, fouled))))
        .when(handling == "jump_ball_win", F.when(jump_team != "", F.array(one(handling, jump_team, nothing))))
        .when(~known, None)
        .when(handling.isin(*REBOUNDS), F.array(one("rebound", team, actor)))
        .when(handling == "substitution", F.array(one("player_in", team, second), one("player_out", team, actor)))
        .when(handling == "turnover", F.when(has2, F.array(one(handling, team, actor), one("steal", opponent, second))).otherwise(F.array(one(handling, team, actor))))
        .when(handling.isin(*FG_MAKES), F.when(has2, F.array(one(handling, team, actor), one(F.concat(kind, F.lit("_assist")), team, second))).otherwise(F.array(one(handling, team, actor))))
        .when(handling.isin(*FG_MISSES), F.when(has3, F.array(one(handling, team, actor), one("block", opponent, F.coalesce(player(3), nothing)))).otherwise(F.array(one(handling, team, actor))))
        .otherwise(F.array(one(handling, team, actor)))
    )
    secs = elapsed(c("PCTIMESTRING"), period, c("regulation"), c("overtime")).cast("int")
    e = e.select("identity", "game_id", c("EVENTNUM").alias("event_id"), to_int(c("EVENTNUM")).alias("event_no"), secs.alias("secs"), period.alias("period"), F.posexplode(made).alias("_k", "_e"))
    e = e.select("identity", "game_id", "event_id", "event_no", "secs", "period", "_k", "_e.*")
    timed = F.min(c("secs").isNotNull()).over(W.partitionBy("identity", "game_id"))
    e = e.withColumn("_timed", timed)
    order = W.partitionBy("identity", "game_id").orderBy(F.when(c("_timed"), c("secs")).asc_nulls_first(), "event_no", "_k")
    e = e.withColumns({"seq": (F.row_number().over(order) - 1).cast("int"), "chain_id": F.lit(None).cast("string"), "source": c("event_id")})
    return e.select(*CONTRACT)
