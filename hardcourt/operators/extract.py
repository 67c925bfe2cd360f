"""From landed responses and raw rows to typed columns: result sets, projections, filters, merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardcourt.functions.transforms import BY_TYPE, TRANSFORMS, normalize_name, number, text

RESULT_SETS = "array<struct<name:string,headers:array<string>,rowSet:array<array<variant>>>>"


def result_rows(responses: DataFrame, body: str = "body", name: str | None = None) -> DataFrame:
    """One row per row of every result set: the input's other columns, rs_no, rs_name, row_no, cells (header to value).

    Cells are variants: numbers, texts, booleans and nested values as the response has them. Rows shorter or longer than the
    headers are cut or filled with nulls; with a name only that result set is read. What is no JSON gives no rows.
    """
    parsed = responses.withColumn("_rs", F.try_variant_get(F.try_parse_json(F.col(body)), "$.resultSets", RESULT_SETS))
    sets = parsed.select(*(c for c in responses.columns if c != body), F.posexplode("_rs").alias("rs_no", "_set"))
    if name is not None:
        sets = sets.filter(F.col("_set.name") == name)
    rows = sets.select("*", F.posexplode("_set.rowSet").alias("row_no", "_row"))
    headers = F.array_distinct(F.col("_set.headers"))
    cells = F.map_from_arrays(headers, F.transform(headers, lambda h: F.get(F.col("_row"), F.array_position(F.col("_set.headers"), h).cast("int") - 1)))
    return rows.select(*(c for c in rows.columns if not c.startswith("_") and c != "row_no"), F.col("_set.name").alias("rs_name"), "row_no", cells.alias("cells"))


def cell(name: str, cells: str = "cells") -> Column:
    """A cell by header; null where the header is missing or the value nested."""
    value = F.try_element_at(F.col(cells), F.lit(name))
    return F.when(~F.coalesce(value, F.lit("")).rlike(r"^\s*[\[{]"), value)


def typed(name: str, kind: str, cells: str = "cells") -> Column:
    """A variant cell by header, as `kind`; null where the header is missing, the value nested or no such value."""
    value = F.try_element_at(F.col(cells), F.lit(name))
    return F.when(~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.try_variant_get(value, "$", kind))


def typed_id(names: list[str], kind: str, cells: str = "cells") -> Column:
    """The id under the first of its aliases that is there and of the kind."""
    return F.coalesce(*(typed(n, kind, cells) for n in names))


def routed(value: Column, result_set: str) -> Column:
    """A column that reads its own result set only: null in rows of others, so that merged rows keep what the right one said."""
    return F.when(F.col("rs_name") == result_set, value)


def entity_id(names: list[str], cells: str = "cells") -> Column:
    """The id under the first of its aliases that is there."""
    return F.coalesce(*(cell(n, cells) for n in names))


def projected(source: Column, declared: str, transform: str | None = None, scale: float | None = None, **params) -> Column:
    """A typed field: the stated transform or the one of the declared type, scaled."""
    name = transform or BY_TYPE[declared.split("(")[0]]
    out = TRANSFORMS[name](source, scale) if name == "safe_int" and scale is not None else TRANSFORMS[name](source, **params)
    return out == 1 if declared == "BOOLEAN" and name == "safe_int" else out


def concatenated(columns: list[Column], separator: str = " ") -> Column:
    """Nulls count as empty; a blank result is null."""
    joined = F.concat_ws(separator, *(F.coalesce(text(c), F.lit("")) for c in columns))
    return F.when(F.trim(joined) != "", joined)


def equals(c: Column, value: str) -> Column:
    """Never null."""
    return text(c).eqNullSafe(value)


def mapped(c: Column, values: dict[str, str], default: str | None = None) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, F.coalesce(text(c), F.lit(""))), F.lit(default))


def row_filter(rules: list[tuple[Column, str, str]], **context) -> Column:
    """All of (column, op, constant), ops lte, gte and eq; constants may name values of the context in braces.

    A null drops the row; what is no number counts as 0 for lte and gte; eq compares texts.
    """

    def one(c: Column, how: str, constant: str) -> Column:
        value = constant.format(**context)
        if how == "eq":
            return text(c) == value
        n = F.coalesce(number(c), F.lit(0.0))
        return c.isNotNull() & ({"lte": n <= float(value), "gte": n >= float(value)}[how])

    return reduce(lambda a, b: a & b, (one(*r) for r in rules), F.lit(True))


def since_season(c: Column, season: Column, first: str | None = None, last: str | None = None) -> Column:
    """Null outside [first, last]; seasons compare as texts."""
    if first is not None:
        c = F.when(season >= first, c)
    return F.when(season <= last, c) if last is not None else c


def first_matching(rows: DataFrame, keys: list[str], order: list[str], match: str, token: str, take: str) -> DataFrame:
    """Per group the field `take` of the first row whose `match` contains the token."""
    there = F.col(match).contains(token)
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(F.min_by(F.when(there, F.col(take)), F.when(there, at)).alias(take))


def stats_default(c: Column) -> Column:
    """Stat columns without a value are 0."""
    return F.coalesce(c, F.lit(0))


def merged_entities(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """One row per entity: of each value the last that is not null in the given order."""
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values))


def raw_rows(rows: DataFrame, key: str, order: list[str], fields: list[str], only: Column | None = None) -> DataFrame:
    """Each entity's rows as an ordered list of records, those that pass `only`."""
    kept = rows if only is None else rows.filter(only)
    return kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *(f for f in fields if f not in order)))).alias("rows"))


def needing_fill(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Ids with a null in any of the columns; the test reaches the scan."""
    return rows.filter(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))).select(key)


def listed_values(rows: DataFrame, key: str, value: Column, order: list[str], only: Column | None = None) -> DataFrame:
    """Pipeline step extract: an entity's values in order."""
    kept = rows if only is None else rows.filter(only)
    pairs = F.array_sort(F.collect_list(F.struct(*order, value.alias("_v"))))
    return kept.groupBy(key).agg(F.transform(pairs, lambda p: p["_v"]).alias("values"))


def aggregated(rows: DataFrame, key: str, **steps: tuple[Column, str]) -> DataFrame:
    """Pipeline steps aggregate, by name: sum counts what is no number as 0, avg leaves it out; both are rounded half to even.

    No list of an entity's values is gathered; sums and counts are, partly before rows are exchanged.
    """
    how = {"sum": lambda n: F.sum(F.coalesce(F.rint(n), F.lit(0.0)).cast("long")), "avg": lambda n: F.rint(F.avg(n)).cast("long")}
    return rows.groupBy(key).agg(*(how[step](number(value)).alias(name) for name, (value, step) in steps.items()))


def first_values(rows: DataFrame, key: str, value: Column, order: list[str], name: str = "first") -> DataFrame:
    """An entity's first value in order, null if that is null: what pipeline math is applied to."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(name))


def summed_calls(rows: DataFrame, key: str, call: str, calls: list[str], value: Column, name: str = "total") -> DataFrame:
    """One field summed over several calls, which are read together: the test on the call reaches the scan."""
    return rows.filter(F.col(call).isin(*calls)).groupBy(key).agg(F.sum(value).alias(name))


def in_seasons(day: Column, first: int | None = None, last: int | None = None) -> Column:
    """Days of seasons, by calendar year, as a range of the day itself, so that the scan can skip what lies outside."""
    begins = [day >= F.lit(f"{first}-01-01").cast("timestamp")] if first is not None else []
    ends = [day < F.lit(f"{last + 1}-01-01").cast("timestamp")] if last is not None else []
    return reduce(lambda a, b: a & b, begins + ends, F.lit(True)) if begins or ends else F.lit(True)


def known_names(entries: DataFrame, code: str, names: list[Column], order: str) -> DataFrame:
    """(known, code): every name of every entry as names are compared; of entries that share one the first in order."""
    every = entries.select(F.explode(F.array(*names)).alias("known"), code, order)
    return every.select(F.upper(normalize_name(F.col("known"))).alias("known"), code, order).groupBy("known").agg(F.min_by(code, order).alias(code))


def matched_names(rows: DataFrame, name: Column, known: DataFrame) -> DataFrame:
    """rows with the code of the entry that has the name, or null."""
    return rows.withColumn("known", F.upper(normalize_name(name))).join(known, "known", "left").drop("known")


def most_recent(rows: DataFrame, keys: list[str], season: str, value: str) -> DataFrame:
    """The value of the latest season that has one."""
    return rows.groupBy(*keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(season))).alias(value))


def filled_keys(rows: DataFrame, context: dict[str, str]) -> DataFrame:
    """Key columns from the row, else from the context."""
    return rows.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in rows.columns else F.lit(v) for k, v in context.items()})

