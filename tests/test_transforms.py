import datetime

import pytest
from pyspark.sql import functions as F

from hardcourt.functions import transforms as tr

DAY = datetime.date(1998, 3, 14)
CASES = [
    ("safe_int", "2.5", 2), ("safe_int", "3.5", 4), ("safe_int", "x", None), ("to_int", "3.5", 0), ("to_int", "", 0), ("to_int", "12", 12),
    ("null_if_zero", "0", None), ("null_if_zero", "0.4", None), ("null_if_zero", "7", 7), ("null_if_zero", "nan", None),
    ("parse_inches", "6-10", 82), ("parse_inches", "6'10.5\"", 83), ("parse_inches", "6 ft 10 in", 82), ("parse_inches", "72.5", 73), ("parse_inches", "-", None),
    *(("parse_birthdate", v, DAY) for v in ("03/14/1998", "14/03/1998", "Mar 14, 1998", "14-March-1998", "14.03.1998", "1998-03-14")), ("parse_birthdate", "n", None),
    ("parse_date", "2024-10-22T00:00:00Z", datetime.date(2024, 10, 22)), ("format_season", "2012", "2012-13"), ("format_season", "1999", "1999-00"),
    ("normalize_name", "Saint  Émile Jr.", "St Emile Jr"), ("normalize_name", "Saint-Louis", "Saint-Louis"), ("normalize_name", "’", "'"), ("normalize_name", "", None),
    ("safe_str", "", None), ("to_str", None, ""),
    ("safe_int", "12d", None), ("safe_int", "3000000000", 3000000000), ("safe_int", "inf", None), ("parse_date", "2024-10-22T25:00:00Z", None), ("parse_date", "2024-10-22T23:59", datetime.date(2024, 10, 22)),
    ("normalize_name", "Ễạǎ Čá e\u0301 a\u030c", "Ễạǎ Ca e a\u030c"),
]


def test_scalar_cases(spark):
    row = spark.range(1).select(*(tr.TRANSFORMS[name](F.lit(value).cast("string")).alias(f"c{k}") for k, (name, value, _) in enumerate(CASES))).first()
    assert [(n, v, row[k]) for k, (n, v, _) in enumerate(CASES)] == CASES


def test_compare_and_seasons(spark):
    got = spark.range(1).select(
        tr.compare(F.lit(" W "), "eq", "W"), tr.compare(F.lit("nan"), "eq", "W"), tr.compare(F.lit("3"), "gt", 2), tr.compare(F.lit("3"), "lt", 2), tr.compare(F.lit(None).cast("string"), "gt", 2),
        tr.safe_int(F.lit(10.5), 60), tr.parse_season(F.lit("2025-26"), "YYYY-YY"), tr.parse_season(F.lit("99-00"), "YY-YY"), tr.parse_season(F.lit("79"), "YY", "end"), tr.parse_season(F.lit("80"), "YY", "end"),
        tr.parse_season(F.lit("2025-27"), "YYYY-YY"), tr.season_param(F.lit(2026), "SSSS-EE"), tr.season_param(F.lit(2026), "EEEE", False),
    ).first()
    assert tuple(got) == (True, None, True, False, None, 630, 2026, 2000, 2079, 1980, None, "2025-26", "2026")


def test_arithmetic(spark):
    fields = {"a": F.lit(-7), "b": F.lit("2"), "z": F.lit(0), "t": F.lit("x")}
    got = spark.range(1).select(*(tr.arithmetic(e, fields) for e in ("a // b", "a % b", "a / z", "t + 1", "a ** 2 - b"))).first()
    assert tuple(got) == (-4.0, 1.0, None, None, 47.0)
    with pytest.raises(ValueError):
        tr.arithmetic("__import__('os')", fields)


def test_numbers_are_cut_to_their_whole_part(spark):
    row = spark.range(1).select(tr.to_int(F.lit(11.0)), tr.to_int(F.lit(3.7)), tr.to_int(F.lit("11.0")), tr.format_season(F.lit(2012.0)), tr.format_season(F.lit("2012.0")), tr.to_int(F.lit(float("nan")))).first()
    assert tuple(row) == (11, 3, 0, "2012-13", None, 0)
