"""Table maintenance as functions from tables to new tables: matching, upserts, merge, promotion, coverage, retention.

Functions return the whole new table, to be written beside the old one and swapped; those for tables in partitions change
only the partitions they touch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hardcourt.sources.tables import written

STAMPS = ("created_at", "updated_at")


def one_per_key(source: DataFrame, keys: list[str], priority: list[str]) -> DataFrame:
    """Rows of one key reduced: of each column the first non-null in order of priority."""
    at = F.struct(*priority)
    values = [x for x in source.columns if x not in keys and x not in priority]
    if not values:
        return source.select(*keys).distinct()
    return source.groupBy(*keys).agg(*(F.min_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], policy: str = "overwrite", newest: tuple[str, ...] = (), now: Column | None = None, skip_unchanged: bool = True) -> DataFrame:
    """The target after the source (one row a key).

    policy "overwrite": the source's values win; "fill": what is there stays, nulls are filled, save the `newest` columns,
    which take the source's value. With `now`, created_at is set on insert and updated_at on change.
    """
    values = [x for x in target.columns if x not in keys and x not in STAMPS]
    t = target.select(*keys, F.struct(*values, *(x for x in STAMPS if x in target.columns)).alias("_t"))
    s = source.select(*keys, F.struct(*(x for x in values if x in source.columns)).alias("_s"))
    both = t.join(s, keys, "full_outer")
    there, given = F.col("_t").isNotNull(), F.col("_s").isNotNull()

    def value(x: str) -> Column:
        if x not in source.columns:
            return F.col(f"_t.{x}")
        old, new = F.col(f"_t.{x}"), F.col(f"_s.{x}")
        if x in newest:
            return F.when(given, F.coalesce(new, old)).otherwise(old)
        return F.coalesce(old, new) if policy == "fill" else F.when(given, new).otherwise(old)

    out = {x: value(x) for x in values}
    columns = [*keys, *(v.alias(x) for x, v in out.items())]
    if now is not None:
        same = reduce(lambda a, b: a & b, (v.eqNullSafe(F.col(f"_t.{x}")) for x, v in out.items()), F.lit(True)) if skip_unchanged else F.lit(False)
        stamp = {"created_at": F.when(there, F.col("_t.created_at")).otherwise(now), "updated_at": F.when(there & (~given | same), F.col("_t.updated_at")).otherwise(now)}
        columns += [stamp[x].alias(x) for x in STAMPS if x in target.columns]
    return both.select(*columns)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.select(*target.columns).dropDuplicates(keys).join(target.select(*keys), keys, "left_anti"))


def with_new_ids(known: DataFrame, fresh: DataFrame, natural: list[str], id_column: str) -> DataFrame:
    """Surrogate ids for natural keys that have none: ids go on from the largest, ascending with the key, without gaps.

    The keys are dealt out by ranges and written, so that the ranges stay as they are; a range's ids begin where those
    before it end, and within a range a window numbers the keys. No task sees more than a range.
    """
    new = fresh.select(*natural).distinct().join(known.select(*natural), natural, "left_anti")
    ranges = written(new.repartitionByRange(*natural).withColumn("_range", F.spark_partition_id()))
    # a row for each range
    offsets = ranges.groupBy("_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    top = known.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).first()[0]
    numbered = ranges.withColumn("_nth", F.row_number().over(W.partitionBy("_range").orderBy(*natural))).join(offsets, "_range")
    given = numbered.select(*natural, (F.lit(top) + F.col("_before") + F.col("_nth")).alias(id_column))
    return known.select(*natural, F.col(id_column).cast("long").alias(id_column)).unionByName(given)


def matched(staged: DataFrame, identities: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Rows whose keys are known get the internal id and status ready; the others keep what they have."""
    known = identities.select(*keys, F.col(id_column).alias("_id"))
    found = staged.join(known, keys, "left")
    return found.withColumns({id_column: F.coalesce("_id", id_column), "status": F.when(F.col("_id").isNotNull(), "ready").otherwise(F.col("status"))}).drop("_id")


def resolved(rows: DataFrame, maps: list[tuple[str, DataFrame, str, str]], required: bool = True) -> DataFrame:
    """External ids to internal ones: (column, map, its external column, name of the internal id); maps have unique ids.

    Rows that do not resolve are dropped, or kept with a null if the ids are not required.
    """
    for k, (column, table, ext, name) in enumerate(maps):
        m = table.select(F.col(ext).alias(f"_e{k}"), F.col(name.split("=")[-1]).alias(name.split("=")[0]))
        rows = rows.join(m, rows[column] == m[f"_e{k}"], "inner" if required else "left").drop(f"_e{k}")
    return rows


@dataclass(frozen=True)
class Merge:
    """How a staged table becomes an intermediate one."""

    keys: tuple[str, ...]
    drop: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    joins: tuple[tuple[str, str, str, str], ...] = ()
    values: dict[str, str] = field(default_factory=dict)
    where: str = "true"
    priority: tuple[str, ...] = ("priority",)


#: The merges of the staged tables, by their schema's column names; joins name the identity table, which callers hand in by name.
MERGES: dict[str, Merge] = {
    "teams": Merge(("sts_id",), drop=("identity", "ext_id", "status"), rename={"matched_sts_id": "sts_id"}, where="status = 'ready'"),
    "players": Merge(("sts_id",), drop=("identity", "ext_id", "status"), rename={"matched_sts_id": "sts_id"}, where="status = 'ready'"),
    "leagues_teams": Merge(("league_code", "team_id"), drop=("identity", "ext_team_id", "status"), joins=(("ext_team_id", "identities_teams", "ext_id", "team_id"),)),
    "teams_players": Merge(("league_code", "team_id", "player_id"), drop=("identity", "ext_team_id", "ext_player_id", "status"), joins=(("ext_team_id", "identities_teams", "ext_id", "team_id"), ("ext_player_id", "identities_players", "ext_id", "player_id"))),
    "games": Merge(("game_id",), drop=("identity", "ext_game_id", "ext_home_id", "ext_away_id", "status"), joins=(("ext_game_id", "identities_games", "ext_id", "game_id"), ("ext_home_id", "identities_teams", "ext_id", "home_team_id=team_id"), ("ext_away_id", "identities_teams", "ext_id", "away_team_id=team_id"))),
    "player_seasons": Merge(("league_code", "player_id", "team_id", "season", "season_type"), drop=("identity", "ext_team_id", "ext_player_id", "status"), joins=(("ext_team_id", "identities_teams", "ext_id", "team_id"), ("ext_player_id", "identities_players", "ext_id", "player_id")), where="games > 0"),
    "team_seasons": Merge(("league_code", "team_id", "season", "season_type"), drop=("identity", "ext_team_id", "status"), joins=(("ext_team_id", "identities_teams", "ext_id", "team_id"),), where="games > 0"),
    "player_games": Merge(("league_code", "game_id", "player_id", "team_id"), drop=("identity", "ext_game_id", "ext_team_id", "ext_player_id", "status"), joins=(("ext_game_id", "identities_games", "ext_id", "game_id"), ("ext_team_id", "identities_teams", "ext_id", "team_id"), ("ext_player_id", "identities_players", "ext_id", "player_id")), where="status <> 'error'"),
    "team_games": Merge(("league_code", "game_id", "team_id"), drop=("identity", "ext_game_id", "ext_team_id", "status"), joins=(("ext_game_id", "identities_games", "ext_id", "game_id"), ("ext_team_id", "identities_teams", "ext_id", "team_id")), where="status <> 'error'"),
}


def merged(staged: DataFrame, target: DataFrame, how: Merge, identities: dict[str, DataFrame]) -> DataFrame:
    """Staging into intermediate: filter, resolve, rename, one row a key, first write wins with null fill."""
    rows = resolved(staged.filter(how.where), [(col, identities[t], ext, name) for col, t, ext, name in how.joins])
    rows = rows.withColumns({k: F.expr(v) for k, v in how.values.items()}).drop(*how.drop).withColumnsRenamed(how.rename)
    order = [p for p in how.priority if p in rows.columns]
    reduced = one_per_key(rows, [*how.keys], order or [*how.keys])
    return upsert(target, reduced, [*how.keys], "fill")


def promoted(core: DataFrame, intermediate: DataFrame, keys: list[str], now: Column | None = None) -> DataFrame:
    """Intermediate into core: the source overwrites."""
    return upsert(core, intermediate, keys, "overwrite", now=now)


def synced(current: DataFrame, registry: DataFrame, key: str) -> DataFrame:
    """Every key with what a registry asks for: insert, update, keep or delete, and the registry's values."""
    values = [x for x in registry.columns if x != key]
    both = current.select(key, F.struct(*values).alias("_t")).join(registry.select(key, F.struct(*values).alias("_s")), key, "full_outer")
    action = F.when(F.col("_t").isNull(), "insert").when(F.col("_s").isNull(), "delete").when(F.col("_t").eqNullSafe(F.col("_s")), "keep").otherwise("update")
    return both.select(key, action.alias("action"), *(F.col(f"_s.{v}").alias(v) for v in values))


def referenced_missing(rows: DataFrame, column: str, profiles: DataFrame, key: str) -> DataFrame:
    """Ids that rows name and profiles lack."""
    return rows.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct().join(profiles.select(key), key, "left_anti")


def unreferenced(profiles: DataFrame, key: str, uses: list[tuple[DataFrame, str]]) -> DataFrame:
    for rows, column in uses:
        profiles = profiles.join(rows.select(F.col(column).alias(key)), key, "left_anti")
    return profiles


def retained(rows: DataFrame, oldest: DataFrame, league: str = "league_code", season: str = "season") -> DataFrame:
    """Rows of seasons not before the league's oldest kept; seasons compare as texts."""
    kept = oldest.select(league, F.col("oldest").alias("_oldest"))
    return rows.join(kept, league).filter(F.col(season) >= F.col("_oldest")).drop("_oldest")


def clean_staging(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Staged games that stay: those whose teams are not both ready, or that are in error. teams: (ext_id, status)."""
    ready = teams.filter("status = 'ready'").select("ext_id")
    gone = games.filter("status <> 'error'").join(ready.withColumnRenamed("ext_id", "ext_home_id"), "ext_home_id").join(ready.withColumnRenamed("ext_id", "ext_away_id"), "ext_away_id").select("ext_game_id")
    return games.join(gone, "ext_game_id", "left_anti")


@dataclass(frozen=True)
class Reference:
    """Columns of a table that name a row of another; what happens to its rows when that row goes: "cascade" or "set null"."""

    table: str
    columns: tuple[str, ...]
    to: str
    keys: tuple[str, ...]
    action: str = "cascade"


#: Which staged tables depend on which, by their schema's names.
STAGED_REFERENCES = [
    Reference("leagues_teams", ("identity", "ext_team_id"), "teams", ("identity", "ext_id")),
    Reference("teams_players", ("identity", "ext_team_id"), "teams", ("identity", "ext_id")),
    Reference("teams_players", ("identity", "ext_player_id"), "players", ("identity", "ext_id")),
    Reference("countries_players", ("identity", "ext_player_id"), "players", ("identity", "ext_id")),
    Reference("team_seasons", ("identity", "ext_team_id"), "teams", ("identity", "ext_id")),
    Reference("player_seasons", ("identity", "ext_player_id"), "players", ("identity", "ext_id")),
    Reference("team_games", ("identity", "ext_team_id"), "teams", ("identity", "ext_id")),
    Reference("player_games", ("identity", "ext_player_id"), "players", ("identity", "ext_id")),
]


def without(tables: dict[str, DataFrame], gone: dict[str, tuple[DataFrame, list[str]]], references: list[Reference]) -> dict[str, DataFrame]:
    """The tables after rows are deleted: `gone` has the keys to delete by table, with their columns' names.

    Tables are walked from those that others name to those that name them. A row that names a deleted row goes too, and so do
    those that name it in turn, or its columns become null, as the reference says; a reference with a null in it names
    nothing. References in a circle are an error.
    """
    needs = {n: {r.to for r in references if r.table == n and r.to in tables} for n in tables}
    kept, lost = {}, {}
    for name in TopologicalSorter(needs).static_order():
        rows, goes, nulls = tables[name], F.lit(False), {}
        columns, touched = rows.columns, name in gone
        if touched:
            keys, on = gone[name]
            rows = rows.join(keys.select(*on).distinct().withColumn("_goes", F.lit(True)), on, "left")
            goes = F.col("_goes").isNotNull()
        for k, r in enumerate(r for r in references if r.table == name and r.to in lost):
            named = lost[r.to].select(*(F.col(x).alias(f"_{k}_{x}") for x in r.keys)).distinct().withColumn(f"_hit{k}", F.lit(True))
            rows = rows.join(named, reduce(lambda a, b: a & b, (F.col(x) == F.col(f"_{k}_{y}") for x, y in zip(r.columns, r.keys, strict=True))), "left")
            hit = F.col(f"_hit{k}").isNotNull()
            if r.action == "set null":
                nulls |= {x: nulls.get(x, F.lit(False)) | hit for x in r.columns}
            else:
                goes, touched = goes | hit, True
        if touched:
            lost[name] = rows.filter(goes).select(*columns)
        kept[name] = rows.filter(~goes).select(*(F.when(~nulls[x], F.col(x)).alias(x) if x in nulls else x for x in columns)) if touched or nulls else rows
    return kept


def staging_cleaned(tables: dict[str, DataFrame], identity: str) -> dict[str, DataFrame]:
    """The staged tables of which one source's finished rows are taken away: games whose teams are both ready, unless in
    error; then ready players, then ready teams, each with all that depends on them. Other sources' rows stay."""
    teams, games = (tables[n].filter(F.col("identity") == identity) for n in ("teams", "games"))
    over = games.select("ext_game_id").exceptAll(clean_staging(games, teams).select("ext_game_id")).withColumn("identity", F.lit(identity))
    ready = {n: (tables[n].filter((F.col("identity") == identity) & (F.col("status") == "ready")).select("identity", "ext_id"), ["identity", "ext_id"]) for n in ("players", "teams")}
    return without(tables, {"games": (over, ["identity", "ext_game_id"]), **ready}, STAGED_REFERENCES)


def registry_applied(tables: dict[str, DataFrame], name: str, registry: DataFrame, key: str, references: list[Reference]) -> dict[str, DataFrame]:
    """The tables after one of them is brought to what a registry asks for; rows that name a dropped entry go or are nulled."""
    actions = synced(tables[name], registry, key)
    dropped = actions.filter("action = 'delete'").select(key)
    out = without(tables, {name: (dropped, [key])}, references)
    return out | {name: actions.filter("action <> 'delete'").drop("action").select(*registry.columns)}


# Tables in partitions (a folder for each value, such as a season): only the partitions a change touches are read and written.


def _folders(spark: SparkSession, path: str, column: str, values: list) -> dict[str, object]:
    """The partition folders of the values that are there, by value as text."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    found = {str(v): spark._jvm.org.apache.hadoop.fs.Path(at, f"{column}={escape(str(v))}") for v in values}
    return {v: (files, p) for v, p in found.items() if files.exists(p)}


def partitions_rewritten(spark: SparkSession, path: str, schema: StructType, column: str, values: list, change: Callable[[DataFrame], DataFrame]) -> None:
    """`change` applied to the partitions of these values; all others are neither read nor written.

    The new files are written beside the old ones before these go, so a job that fails midway leaves the table as it was. A
    partition of which no row stays is removed.
    """
    old = spark.read.schema(schema).parquet(path).filter(F.col(column).isin(values))
    new = change(old).select(*[x for x in schema.names if x != column], column)
    seen = Observation()
    counted = new.observe(seen, F.collect_set(F.col(column).cast("string")).alias("left"))
    counted.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    for value, (files, folder) in _folders(spark, path, column, values).items():
        if value not in (seen.get["left"] or []):
            files.delete(folder, True)


def upsert_partitions(spark: SparkSession, path: str, schema: StructType, source: DataFrame, keys: list[str], column: str, **how) -> None:
    """`upsert` of a partitioned table in place. The partition's column is one of the keys, so no row moves to another one."""
    if column not in keys:
        raise ValueError(f"{column} is no key: rows could move between partitions")
    source = written(source)
    values = [r[0] for r in source.select(column).distinct().collect()]  # as many as the source touches partitions
    partitions_rewritten(spark, path, schema, column, values, lambda old: upsert(old, source, keys, **how))


def partitions_dropped(spark: SparkSession, path: str, column: str, oldest: str) -> list[str]:
    """Retention of a table in partitions: folders of values before `oldest`, compared as texts, go without being read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = {f.getPath(): unescape(f.getPath().getName().partition("=")[2]) for f in files.listStatus(at) if f.getPath().getName().startswith(f"{column}=")}
    gone = {p: v for p, v in names.items() if v < oldest}
    for folder in gone:
        files.delete(folder, True)
    return sorted(gone.values())


# Staging: what is fetched becomes rows of the staged tables.


def staged_profiles(rows: DataFrame, existing: DataFrame, keys: list[str], constants: dict[str, str], sides: dict[str, tuple[list[str], dict[str, str]]]) -> dict[str, DataFrame]:
    """The staged profiles after new rows (only columns the table has, constants filled in, first write wins), and side
    tables by name, each of the stated columns and constants, distinct, rows with a null left out."""
    full = rows.withColumns({k: F.lit(v) for k, v in constants.items()})
    known = [x for x in existing.columns if x in full.columns]
    priority = [x for x in known if x not in keys]
    one = one_per_key(full.select(*known).withColumn("_p", F.struct(*priority)), keys, ["_p"])
    out = {"profiles": upsert(existing, one, keys, "fill")}
    for name, (columns, more) in sides.items():
        side = rows.withColumns({k: F.lit(v) for k, v in more.items()}).select(*more, *columns)
        out[name] = side.dropna().distinct()
    return out


def staged_rosters(rows: DataFrame, existing: DataFrame, keys: list[str], constants: dict[str, str]) -> DataFrame:
    """Roster rows, those that lack a key dropped, filled into what is there."""
    full = rows.withColumns({k: F.lit(v) for k, v in constants.items()}).dropna(subset=keys)
    values = [x for x in existing.columns if x in full.columns and x not in keys]
    one = one_per_key(full.select(*keys, *values).withColumn("_p", F.struct(*(values or keys))), keys, ["_p"])
    return upsert(existing, one, keys, "fill")


def staged_stats(rows: DataFrame, existing: DataFrame, keys: list[str], context: dict[str, str], profiles: DataFrame, profile_key: str) -> tuple[DataFrame, DataFrame]:
    """Stat rows with their keys filled from the context, filled into what is there; and the profiles they lack."""
    full = rows.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in rows.columns else F.lit(v) for k, v in context.items()})
    return staged_rosters(full, existing, keys, {}), referenced_missing(full, profile_key, profiles, profile_key)


def cleared(tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without rows, to overwrite them with, and (table, deleted): how many rows that takes away."""
    counts = [t.agg(F.count("*").alias("deleted")).select(F.lit(n).alias("table"), "deleted") for n, t in tables.items()]
    return {n: t.limit(0) for n, t in tables.items()}, reduce(DataFrame.unionByName, counts)


def stale_pruned(rows: DataFrame, league: str, identity: str, began: Column, stamp: str = "updated_at") -> DataFrame:
    """Rows of one league and source that this run has not touched go; all others stay."""
    mine = (F.col("league_code") == league) & (F.col("identity") == identity)
    return rows.filter(~F.coalesce(mine & (F.col(stamp) < began), F.lit(False)))


# Coverage: one row per combination and column, with a flag.


GRID_ROWS = 100_000


def coverage_grid(first: DataFrame, *dimensions: DataFrame, most: int = GRID_ROWS) -> DataFrame:
    """All combinations of configuration tables (seasons, types, targets, datasets and their columns).

    The grid is what is asked for, so this is the one join without a key; dimensions of up to `most` rows are broadcast, larger
    ones are left to Spark's partitioned product.
    """
    for d in dimensions:
        first = first.crossJoin(F.broadcast(d) if d.limit(most + 1).count() <= most else d)
    return first


def recently_active(rows: DataFrame, group: str, day: str, days: int = 8) -> DataFrame:
    """(group, n): groups with rows in the last days of the data. The last day is one value, so that the range reaches the scan."""
    last = rows.agg(F.max(day)).first()[0]
    return rows.filter(F.col(day) >= F.lit(last) - F.make_interval(days=F.lit(days))).groupBy(group).agg(F.count("*").alias("n"))


def seeded(existing: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    return insert_absent(existing, grid.withColumn("covered", F.lit(False)), keys)


def mark_covered(coverage: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return upsert(coverage, done.select(*keys).distinct().withColumn("covered", F.lit(True)), keys)


def complete(coverage: DataFrame, group: list[str]) -> DataFrame:
    return coverage.groupBy(*group).agg(F.bool_and(F.coalesce("covered", F.lit(False))).alias("complete"))


def work_list(coverage: DataFrame, group: list[str], active: DataFrame) -> DataFrame:
    """Groups not fully covered, and those of active season types of the current season in any case."""
    open_ = complete(coverage, group).filter(~F.col("complete")).select(*group)
    current = coverage.select(*group).distinct().join(active, active.columns, "left_semi")
    return open_.unionByName(current).distinct()


def digests(rows: DataFrame, group: list[str]) -> DataFrame:
    """(group, n, digest): of each group's rows, whatever their order and however they are dealt; repeated rows count."""
    values = [x for x in rows.columns if x not in group]
    held = F.xxhash64(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))
    return rows.select(*group, held.cast("decimal(38,0)").alias("_h")).groupBy(*group).agg(F.count("*").alias("n"), F.sum("_h").cast("string").alias("digest"))


def changed(rows: DataFrame, stored: DataFrame, group: list[str]) -> DataFrame:
    """(group, change): groups that are new, changed or gone since `stored`, the digests of an earlier state. Only these need work."""
    now, then = digests(rows, group).withColumn("_now", F.struct("n", "digest")), stored.withColumn("_then", F.struct("n", "digest"))
    both = now.select(*group, "_now").join(then.select(*group, "_then"), group, "full_outer")
    change = F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "gone").when(F.col("_now") != F.col("_then"), "changed")
    return both.select(*group, change.alias("change")).filter("change is not null")


def reset_active(coverage: DataFrame, active: DataFrame) -> DataFrame:
    """Flags of active combinations are taken back."""
    marked = coverage.join(active.distinct().withColumn("_active", F.lit(True)), active.columns, "left")
    return marked.withColumn("covered", F.when(F.coalesce("_active", F.lit(False)), False).otherwise(F.col("covered"))).drop("_active").select(*coverage.columns)


def pruned_coverage(coverage: DataFrame, configured: DataFrame, keys: list[str], oldest: str) -> DataFrame:
    """Combinations still configured, of seasons that are retained."""
    return coverage.filter(F.col("season") >= oldest).join(configured.select(*keys).distinct(), keys, "left_semi").select(*coverage.columns)


def quality_errors(rows: DataFrame, key: list[str], required: list[str] = (), picks: dict[str, list[str]] | None = None, references: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """(rule, column, key) of rows that break NOT NULL, a picklist, key uniqueness or a reference.

    The table is read once: every row gathers the rules it breaks. A key that stands on several rows is told once.
    """
    wanted = list(dict.fromkeys([*key, *required, *(picks or {}), *(references or {})]))
    rows = rows.select(*wanted)

    def told(test: Column, rule: str, column: str) -> Column:
        return F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column")))

    broken = [told(F.col(x).isNull(), "not_null", x) for x in required]
    broken += [told(~F.col(x).isin(v), "picklist", x) for x, v in (picks or {}).items()]
    for k, (x, (table, name)) in enumerate((references or {}).items()):
        there = table.select(F.col(name).alias(f"_r{k}")).distinct().withColumn(f"_there{k}", F.lit(True))
        rows = rows.join(there, F.col(x) == F.col(f"_r{k}"), "left")
        broken.append(told(F.col(x).isNotNull() & F.col(f"_there{k}").isNull(), "reference", x))
    same = W.partitionBy(*key)
    rows = rows.withColumns({"_n": F.count("*").over(same), "_nth": F.row_number().over(same.orderBy(F.lit(0)))})
    broken.append(told((F.col("_n") > 1) & (F.col("_nth") == 1), "unique", "|".join(key)))
    return rows.select(F.concat_ws("|", *key).alias("key"), F.inline(F.array_compact(F.array(*broken)))).select("rule", "column", "key")
