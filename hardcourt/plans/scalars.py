"""Queries of the scalar transforms (L), projections and filters (B) and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardcourt.functions import transforms as tr
from hardcourt.operators import extract as ex
from hardcourt.plans.registry import query
from hardcourt.sources.tables import read

c = F.col
#: Line numbers repeat within an order; the rest breaks ties.
LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def odd_size():
    """The part's size as texts come: plain, within blanks, with a fraction, a letter before or behind, blank, or not at all."""
    size = c("p_size").cast("string")
    forms = (size, F.concat(F.lit(" "), size, F.lit(" ")), F.concat(size, F.lit(".5")), F.concat(F.lit("x"), size), F.concat(size, F.lit("d")), F.lit(""), F.lit(None).cast("string"))
    return F.get(F.array(*forms), (c("p_partkey") % len(forms)).cast("int"))


@query("l1_safe_int", "select p_partkey, round_even(p_retailprice * 10, 0)::bigint as price10, null::bigint as brand, case p_partkey % 7 when 0 then p_size when 1 then p_size when 2 then round_even(p_size + 0.5, 0) end::bigint as odd from part")
def l1(spark, sf):
    return read(spark, sf, "part").select("p_partkey", tr.safe_int(c("p_retailprice"), 10).alias("price10"), tr.safe_int(c("p_brand")).alias("brand"), tr.safe_int(odd_size()).alias("odd"))


@query("l2_to_int", "select p_partkey, p_size as size, 0 as brand, coalesce(p_brand, '') as brand_text, 0 as price, case when p_partkey % 7 < 2 then p_size else 0 end::int as odd from part")
def l2(spark, sf):
    return read(spark, sf, "part").select("p_partkey", tr.to_int(c("p_size")).alias("size"), tr.to_int(c("p_brand")).alias("brand"), tr.to_str(c("p_brand")).alias("brand_text"), tr.to_int(F.concat_ws(".", "p_size", F.lit("5"))).alias("price"), tr.to_int(odd_size()).alias("odd"))


@query("l3_safe_str", "select p_partkey, nullif(case when p_size % 3 = 0 then '' else p_brand end, '') as brand from part")
def l3(spark, sf):
    return read(spark, sf, "part").select("p_partkey", tr.safe_str(F.when(c("p_size") % 3 == 0, "").otherwise(c("p_brand"))).alias("brand"))


@query("l4_null_if_zero", "select c_custkey, case when abs(c_acctbal / 1000) >= 1 then round_even(c_acctbal / 1000, 0)::bigint end as thousands from customer")
def l4(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", tr.null_if_zero(c("c_acctbal") / 1000).alias("thousands"))


@query(
    "l5_parse_inches",
    "select p_partkey, (5 + p_size % 3) * 12 + p_size % 12 as dashed, (5 + p_size % 3) * 12 + p_size % 12 + 1 as quoted, (5 + p_size % 3) * 12 + p_size % 12 as worded, p_size as plain, null::int as bad from part",
)
def l5(spark, sf):
    feet, inches = (5 + c("p_size") % 3).cast("string"), (c("p_size") % 12).cast("string")
    forms = {"dashed": F.concat_ws("-", feet, inches), "quoted": F.concat(feet, F.lit("'"), inches, F.lit('.5"')), "worded": F.concat(feet, F.lit(" ft "), inches, F.lit(" in")), "plain": c("p_size"), "bad": F.concat(F.lit("x"), feet)}
    return read(spark, sf, "part").select("p_partkey", *(tr.parse_inches(v).alias(k) for k, v in forms.items()))


@query("l6_parse_birthdate", "select o_orderkey, o_orderdate::date as iso, o_orderdate::date as us, o_orderdate::date as named, o_orderdate::date as dotted, null::date as bad, case when o_orderkey % 5 < 3 then o_orderdate::date end as mixed from orders")
def l6(spark, sf):
    d = c("o_orderdate")
    forms = {"iso": F.date_format(d, "yyyy-MM-dd"), "us": F.date_format(d, "MM/dd/yyyy"), "named": F.date_format(d, "MMM d, yyyy"), "dotted": F.date_format(d, "dd.MM.yyyy"), "bad": F.date_format(d, "yyyy/MM")}
    every = [forms["iso"], forms["us"], forms["named"], F.concat(F.lit("n"), forms["us"]), F.lit("")]
    forms["mixed"] = F.get(F.array(*every), (c("o_orderkey") % 5).cast("int"))
    return read(spark, sf, "orders").select("o_orderkey", *(tr.parse_birthdate(v).alias(k) for k, v in forms.items()))


@query("l7_parse_date", "select o_orderkey, o_orderdate::date as day from orders")
def l7(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", tr.parse_date(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00-05:00"))).alias("day"))


@query("l8_format_season", "select o_orderkey, year(o_orderdate)::varchar || '-' || lpad(((year(o_orderdate) + 1) % 100)::varchar, 2, '0') as season from orders")
def l8(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", tr.format_season(F.year("o_orderdate")).alias("season"))


_WORDS = "case w when 'Saint' then 'St' when 'Sainte' then 'Ste' when 'Mount' then 'Mt' when 'and' then '&' when 'LA' then 'Los Angeles' else w end"


@query(
    "o5_transform_by_name",
    "select p_partkey, p_size as size, nullif(p_brand, '') as brand, round_even(p_retailprice, 0)::bigint as price, p_retailprice >= 1000 as dear, p_brand = 'Brand#1' as first from part",
)
def o5(spark, sf):
    """Transforms looked up by the names that configurations use."""
    named = {"size": ("p_size", "to_int", {}), "brand": ("p_brand", "safe_str", {}), "price": ("p_retailprice", "safe_int", {}), "dear": ("p_retailprice", "gte", {"threshold": 1000}), "first": ("p_brand", "eq", {"threshold": "Brand#1"})}
    return read(spark, sf, "part").select("p_partkey", *(tr.TRANSFORMS[how](c(col), **more).alias(out) for out, (col, how, more) in named.items()))


_LETTERS = tr.unaccented()


@query(
    "l9_normalize_name",
    f"""select doc_id, nullif(array_to_string(list_filter(list_transform(string_split_regex(
      replace(replace(replace(translate(text, '{"".join(_LETTERS)}', '{"".join(_LETTERS.values())}'), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe'), '\\s+'), lambda w: replace(replace({_WORDS}, '.', ''), ',', '')), lambda w: w <> ''), ' '), '') as name from documents""",
)
def l9(spark, sf):
    return read(spark, sf, "documents").select("doc_id", tr.normalize_name(c("text")).alias("name"))


@query(
    "l10_match_country",
    "select c_custkey, n_name as country from customer left join nation on upper(trim(n_name)) = upper(trim((select any_value(m.n_name) from nation m where m.n_nationkey = c_nationkey)))",
)
def l10(spark, sf):
    """A country's code by any of its names: the aliases are a small dimension, first registry entry wins."""
    nation = read(spark, sf, "nation").withColumnRenamed("n_name", "country")
    known = ex.known_names(nation, "country", [c("country"), F.concat(F.lit(" "), F.lower("country"))], "n_nationkey")
    asked = read(spark, sf, "customer").join(nation.withColumnRenamed("country", "name"), c("c_nationkey") == c("n_nationkey")).select("c_custkey", "name")
    return ex.matched_names(asked, F.lower("name"), known).select("c_custkey", "country")


@query(
    "l11_compare",
    "select o_orderkey, o_orderstatus = 'F' as is_f, o_orderstatus <> 'F' as not_f, o_totalprice > 1000 as over, o_totalprice <= 1000 as up_to, null::boolean as none from orders",
)
def l11(spark, sf):
    o = read(spark, sf, "orders")
    return o.select("o_orderkey", tr.compare(F.concat(F.lit(" "), "o_orderstatus"), "eq", "F").alias("is_f"), tr.compare(c("o_orderstatus"), "neq", "F ").alias("not_f"), tr.compare(c("o_totalprice"), "gt", 1000).alias("over"), tr.compare(c("o_totalprice"), "lte", 1000).alias("up_to"), tr.compare(F.lit("nan"), "gte", 1).alias("none"))


@query(
    "l12_season_labels",
    """select o_orderkey, (y - 1)::varchar || '-' || lpad((y % 100)::varchar, 2, '0') as split, lpad(((y - 1) % 100)::varchar, 2, '0') || '/' || lpad((y % 100)::varchar, 2, '0') as short,
       (y - 1)::varchar as started, y as parsed, lpad(((y - 1) % 100)::varchar, 2, '0') || lpad((y % 100)::varchar, 2, '0') as param from (select o_orderkey, year(o_orderdate)::int as y from orders)""",
)
def l12(spark, sf):
    y = F.year("o_orderdate")
    return read(spark, sf, "orders").select("o_orderkey", tr.render_season(y, "YYYY-YY").alias("split"), tr.render_season(y, "YY/YY").alias("short"), tr.render_season(y, "YYYY", "start").alias("started"), tr.parse_season(tr.render_season(y, "YY-YY"), "YY-YY").alias("parsed"), tr.season_param(y, "SSEE").alias("param"))


@query(
    "l13_current_season",
    """select o_orderkey, y as current, array_to_string(list_transform(range(y - 2, y + 1), lambda x: (x - 1)::varchar || '-' || lpad((x % 100)::varchar, 2, '0')), ',') as retained
       from (select o_orderkey, (year(o_orderdate) + (strftime(o_orderdate, '%m/%d') >= '07/15')::int)::int as y from orders)""",
)
def l13(spark, sf):
    y = tr.current_season_end(c("o_orderdate"), "07/15")
    return read(spark, sf, "orders").select("o_orderkey", y.alias("current"), F.array_join(tr.retained_seasons(y, 3), ",").alias("retained"))


@query(
    "l14_arithmetic",
    "select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) + power(l_tax, 2), 6) as net, floor(-l_quantity / 7)::double as floored, (-l_quantity - 7 * floor(-l_quantity / 7))::double as rest, null::double as none from lineitem",
)
def l14(spark, sf):
    f = {n: c(f"l_{n}") for n in ("extendedprice", "discount", "tax", "quantity", "returnflag")}
    made = {"net": F.round(tr.arithmetic("extendedprice * (1 - discount) - (-tax ** 2)", f), 6), "floored": tr.arithmetic("-quantity // 7", f), "rest": tr.arithmetic("-quantity % 7", f), "none": tr.arithmetic("returnflag / 0", f)}
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *(v.alias(k) for k, v in made.items()))


# --- scans ---------------------------------------------------------------------------------------------------------


@query("a2_result_sets", "select n_nationkey::bigint as id, n_name as name, n_regionkey::int as region, n_nationkey / 4 as quarter, n_nationkey % 2 = 0 as even, null::varchar as nested from nation")
def a2(spark, sf):
    """Nations packed as one response per region, then scanned: numbers stay numbers, the id stands under its second alias."""
    line = F.format_string('[%d,"%s",%d,%s,%s,{"a":1}]', "n_nationkey", "n_name", "n_regionkey", (c("n_nationkey") / 4).cast("string"), (c("n_nationkey") % 2 == 0).cast("string"))
    packed = read(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(line)), ",").alias("rows"))
    body = packed.select(F.format_string('{"resultSets":[{"name":"Nations","headers":["nationId","NAME","REGION","QUARTER","EVEN","NESTED"],"rowSet":[%s]}]}', "rows").alias("body"))
    rows = ex.result_rows(body, name="Nations")
    return rows.select(ex.typed_id(["NATION_ID", "nationId"], "bigint").alias("id"), ex.typed("NAME", "string").alias("name"), ex.typed("REGION", "int").alias("region"), ex.typed("QUARTER", "double").alias("quarter"), ex.typed("EVEN", "boolean").alias("even"), ex.typed("NESTED", "string").alias("nested"))


@query("b9_result_set_routing", "select n_regionkey::bigint as region, max(n_name) as last_name, min(r_name) as label from nation join region on n_regionkey = r_regionkey group by 1")
def b9(spark, sf):
    """Two result sets of one response with columns of the same header; each field reads its own."""
    line = '[%d,"%s"]'
    nations = read(spark, sf, "nation").groupBy(c("n_regionkey").alias("k")).agg(F.array_join(F.array_sort(F.collect_list(F.format_string(line, "n_regionkey", "n_name"))), ",").alias("a"))
    regions = read(spark, sf, "region").select(c("r_regionkey").alias("k"), F.format_string(line, "r_regionkey", "r_name").alias("b"))
    one = '{"name":"%s","headers":["ID","NAME"],"rowSet":[%%s]}'
    body = nations.join(regions, "k").select(F.format_string('{"resultSets":[' + one % "Nations" + "," + one % "Regions" + "]}", "a", "b").alias("body"))
    name = ex.typed("NAME", "string")
    rows = ex.result_rows(body).select(ex.typed("ID", "bigint").alias("region"), ex.routed(name, "Nations").alias("last_name"), ex.routed(name, "Regions").alias("label"), "rs_no", "row_no")
    return ex.merged_entities(rows, ["region"], ["rs_no", "row_no"], ["last_name", "label"])


@query("a3_raw_rows", "select o_custkey, string_agg(o_orderkey::varchar || ':' || o_orderstatus, ',' order by o_orderkey) as records from orders where o_orderstatus in ('F', 'O') group by 1")
def a3(spark, sf):
    rows = ex.raw_rows(read(spark, sf, "orders"), "o_custkey", ["o_orderkey"], ["o_orderstatus"], c("o_orderstatus").isin("F", "O"))
    return rows.select("o_custkey", F.array_join(F.transform("rows", lambda r: F.concat_ws(":", r["o_orderkey"], r["o_orderstatus"])), ",").alias("records"))


@query("a5_game_list", "select o_orderkey from orders where o_orderstatus = 'F' and year(o_orderdate) = 1995")
def a5(spark, sf):
    """Completed games of one season: a filter on the scan; the date range, not the year of each row, prunes."""
    return read(spark, sf, "orders").filter((c("o_orderstatus") == "F") & ex.in_seasons(c("o_orderdate"), 1995, 1995)).select("o_orderkey")


@query("a6_needs_fill", "select c_custkey from customer where c_custkey % 5 = 0 or c_mktsegment = 'BUILDING'")
def a6(spark, sf):
    df = read(spark, sf, "customer").withColumns({"c_acctbal": F.when(c("c_custkey") % 5 != 0, c("c_acctbal")), "c_mktsegment": F.when(c("c_mktsegment") != "BUILDING", c("c_mktsegment"))})
    return ex.needing_fill(df, "c_custkey", ["c_acctbal", "c_mktsegment"])


@query("a7_discovery_games", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-01-01' order by 2, 1")
def a7(spark, sf):
    d = c("o_orderdate")
    kept = read(spark, sf, "orders").filter(ex.in_seasons(d, 1996, 1997))
    return kept.select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("day")).orderBy("day", "o_orderkey")


# --- projections and filters ---------------------------------------------------------------------------------------


@query("b1_projection", "select p_partkey, p_name as name, round_even(p_retailprice * 100, 0)::int as cents, null::varchar as missing from part")
def b1(spark, sf):
    cells = F.create_map(F.lit("NAME"), c("p_name"), F.lit("PRICE"), c("p_retailprice").cast("string"))
    df = read(spark, sf, "part").select("p_partkey", cells.alias("cells"))
    return df.select("p_partkey", ex.projected(ex.cell("NAME"), "TEXT").alias("name"), ex.projected(ex.cell("PRICE"), "INTEGER", scale=100).alias("cents"), ex.projected(ex.cell("NOT_THERE"), "TEXT").alias("missing"))


@query("b2_default_transform", "select p_partkey, round_even(p_retailprice, 0)::int as i, p_retailprice > 1e9 as b, p_brand as t from part")
def b2(spark, sf):
    return read(spark, sf, "part").select("p_partkey", ex.projected(c("p_retailprice"), "SMALLINT").alias("i"), ex.projected((c("p_retailprice") > 1e9).cast("int"), "BOOLEAN").alias("b"), ex.projected(c("p_brand"), "VARCHAR(100)").alias("t"))


@query("b3_concat", "select p_partkey, nullif(trim(case when p_size % 2 = 0 then '' else p_name end || ' ' || case when p_size % 3 = 0 then '' else p_brand end), '') as label from part")
def b3(spark, sf):
    made = ex.concatenated([F.when(c("p_size") % 2 != 0, c("p_name")), F.when(c("p_size") % 3 != 0, c("p_brand"))])
    return read(spark, sf, "part").select("p_partkey", F.trim(made).alias("label"))


@query("b4_equality", "select o_orderkey, coalesce(nullif(o_orderstatus, 'P') = 'F', false) as done from orders")
def b4(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", ex.equals(F.nullif("o_orderstatus", F.lit("P")), "F").alias("done"))


@query("b5_value_map", "select o_orderkey, case o_orderpriority when '1-URGENT' then 'high' when '2-HIGH' then 'high' when '5-LOW' then 'low' else 'mid' end as class from orders")
def b5(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", ex.mapped(c("o_orderpriority"), {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"}, "mid").alias("class"))


@query("b6_derived_math", "select l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount), 0)::bigint as net, case when l_linenumber % 4 <> 0 then round_even(l_extendedprice / (l_linenumber % 4), 0)::bigint end as part from lineitem")
def b6(spark, sf):
    df = read(spark, sf, "lineitem").withColumn("zero", c("l_linenumber") % 4)
    net = tr.arithmetic("a * (1 - b)", {"a": c("l_extendedprice"), "b": c("l_discount")})
    share = tr.arithmetic("a / z", {"a": c("l_extendedprice"), "z": c("zero")})
    return df.select("l_orderkey", "l_linenumber", tr.safe_int(net).alias("net"), tr.safe_int(share).alias("part"))


@query("b7_row_filter", "select o_orderkey from orders where year(o_orderdate) between 1994 and 1996 and o_orderstatus = 'F' and o_totalprice >= 50000 and coalesce(try_cast(o_orderpriority as double), 0.0) <= 3")
def b7(spark, sf):
    """Rules with constants of the context; the seasons are a range of the date, which reaches the scan."""
    rules = [(c("o_totalprice"), "gte", "{least}"), (c("o_orderpriority"), "lte", "3"), (c("o_orderstatus"), "eq", "{status}")]
    return read(spark, sf, "orders").filter(ex.in_seasons(c("o_orderdate"), 1994, 1996) & ex.row_filter(rules, least=50000, status="F")).select("o_orderkey")


@query("b8_season_gate", "select o_orderkey, case when year(o_orderdate) >= 1996 then o_totalprice end as price from orders where year(o_orderdate) <= 1997")
def b8(spark, sf):
    season = F.year("o_orderdate").cast("string")
    return read(spark, sf, "orders").filter(ex.in_seasons(c("o_orderdate"), last=1997)).select("o_orderkey", ex.since_season(c("o_totalprice"), season, "1996").alias("price"))


@query("b10_cross_row", "select l_orderkey, first(l_quantity order by l_linenumber, l_partkey, l_suppkey, l_quantity) filter (where contains(l_returnflag, 'A')) as quantity from lineitem group by 1")
def b10(spark, sf):
    return ex.first_matching(read(spark, sf, "lineitem"), ["l_orderkey"], LINE, "l_returnflag", "A", "l_quantity").withColumnRenamed("l_quantity", "quantity")


@query("b11_stats_default", "select c_custkey, case when c_custkey % 4 = 0 then 0 else c_acctbal end as balance from customer")
def b11(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", ex.stats_default(F.when(c("c_custkey") % 4 != 0, c("c_acctbal"))).alias("balance"))


@query(
    "b12_merge_rows",
    """select user_id, last(event_type order by ts, event_id) as event_type, last(value order by ts, event_id) filter (where event_id % 3 <> 0) as value from events group by 1""",
)
def b12(spark, sf):
    """Later values win, nulls never overwrite."""
    df = read(spark, sf, "events").withColumn("value", F.when(c("event_id") % 3 != 0, c("value")))
    return ex.merged_entities(df, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


@query("b13_id_aliases", "select event_id, coalesce(json_extract_string(props, '$.PLAYER_ID'), json_extract_string(props, '$.k'), json_extract_string(props, '$.page')) as entity from events")
def b13(spark, sf):
    cells = F.try_variant_get(F.try_parse_json("props"), "$", "map<string,variant>")
    return read(spark, sf, "events").select("event_id", cells.alias("cells")).select("event_id", ex.typed_id(["PLAYER_ID", "k", "page"], "string").alias("entity"))


@query("b14_pipeline_extract", "select l_orderkey, string_agg(l_quantity::int::varchar, ',' order by l_linenumber, l_partkey, l_suppkey, l_quantity) as quantities from lineitem where l_returnflag in ('A', 'R') group by 1")
def b14(spark, sf):
    rows = ex.listed_values(read(spark, sf, "lineitem"), "l_orderkey", c("l_quantity").cast("int"), LINE, c("l_returnflag").isin("A", "R"))
    return rows.select("l_orderkey", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("quantities"))


@query("b15_pipeline_filter", "select p_partkey, p_size from part where p_size in (1, 7, 23)")
def b15(spark, sf):
    return read(spark, sf, "part").filter(c("p_size").isin(1, 7, 23)).select("p_partkey", "p_size")


@query("b18_key_fill", "select o_orderkey, coalesce(nullif(o_orderstatus, 'O'), 'regular') as season_type, 'archive' as identity from orders")
def b18(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("season_type"))
    return ex.filled_keys(df, {"season_type": "regular", "identity": "archive"})


@query("d10_pipeline_aggregate", "select l_orderkey, sum(round_even(l_quantity, 0))::bigint as total, round_even(avg(l_quantity), 0)::bigint as mean from lineitem group by 1")
def d10(spark, sf):
    return ex.aggregated(read(spark, sf, "lineitem"), "l_orderkey", total=(c("l_quantity"), "sum"), mean=(c("l_quantity"), "avg"))


@query("d11_multi_call_sum", "select l_orderkey, sum(l_quantity)::bigint as total from lineitem where l_returnflag in ('A', 'N') group by 1")
def d11(spark, sf):
    """The same field summed over several calls."""
    return ex.summed_calls(read(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N"], tr.safe_int(c("l_quantity")))


@query("d12_pipeline_math", "select l_orderkey, round_even(first(l_quantity order by l_linenumber, l_partkey, l_suppkey, l_quantity) * 10 / 3, 0)::bigint as thirds from lineitem group by 1")
def d12(spark, sf):
    rows = ex.first_values(read(spark, sf, "lineitem"), "l_orderkey", c("l_quantity"), LINE)
    return rows.select("l_orderkey", tr.safe_int(tr.arithmetic("x * 10 / 3", {"x": c("first")})).alias("thirds"))


@query(
    "d13_most_recent",
    "select o_custkey, last(p order by y) filter (where p is not null) as price from (select o_custkey, year(o_orderdate) as y, max(o_totalprice) filter (where o_orderstatus <> 'P') as p from orders group by 1, 2) group by 1",
)
def d13(spark, sf):
    seasons = read(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(F.max(F.when(c("o_orderstatus") != "P", c("o_totalprice"))).alias("price"))
    return ex.most_recent(seasons, ["o_custkey"], "season", "price")
