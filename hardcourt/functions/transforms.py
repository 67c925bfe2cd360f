"""Scalar transforms as Column builders, by name in TRANSFORMS.

Each takes a column of any type and follows the lenient reading of source cells: what cannot be read is null (or the
stated default), never an error.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOTHING = ("", "nan", "none")


def text(c: Column) -> Column:
    return c.cast("string")


def number(c: Column) -> Column:
    """As a double, null where it is none; a type suffix, as in 12d, makes it none."""
    t = F.trim(text(c))
    return F.when(~t.rlike("[dDfF]$"), t.try_cast("double"))


def blank(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(text(c))).isin(*NOTHING)


def safe_int(c: Column, scale: float = 1) -> Column:
    """Scaled and rounded half to even, as a long."""
    return F.rint(number(c) * scale).try_cast("long")


def whole(c: Column) -> Column:
    """Texts of digits, and numbers without their fraction; null else."""
    t = F.trim(text(c))
    real = F.typeof(c).rlike("^(?:float|double|decimal)")
    return F.when(real, number(c).try_cast("int")).when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))


def to_int(c: Column) -> Column:
    """Whole numbers, other numbers cut to theirs; everything else, texts of fractions too, is 0."""
    return F.coalesce(whole(c), F.lit(0))


def to_str(c: Column) -> Column:
    return F.coalesce(text(c), F.lit(""))


def safe_str(c: Column) -> Column:
    t = text(c)
    return F.when((t != "") & (t != "NaN"), t)


def null_if_zero(c: Column) -> Column:
    """Null where the whole part is 0, else as a long."""
    n = number(c)
    return F.when(F.abs(n) >= 1, F.rint(n).try_cast("long"))


def parse_inches(c: Column) -> Column:
    """6-10, 6'10.5", 6 ft 10 in, 72: inches, halves up."""
    t = F.trim(text(c))
    quoted, worded = r"^(\d+)\s*[-'\x{2019}]\s*(\d+(?:\.\d+)?)\"?$", r"(?i)^(\d+)\s*(?:ft|foot|feet)\s*(\d+(?:\.\d+)?)\s*(?:in|inch(?:es)?)?$"

    def feet(pattern: str) -> Column:
        return F.regexp_extract(t, pattern, 1).try_cast("int") * 12 + F.regexp_extract(t, pattern, 2).try_cast("double")

    inches = F.when(t.rlike(r"^\d+(?:\.\d+)?$"), t.try_cast("double")).when(t.rlike(quoted), feet(quoted)).when(t.rlike(worded), feet(worded))
    return F.floor(inches + 0.5).cast("int")


#: Date formats, tried in this order, each behind a pattern of what it may be tried on.
DATE_FORMATS = (
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
    ("MMMM d, yyyy", r"^[A-Za-z]{3,} \d{1,2}, \d{4}$"),
    ("MMM d yyyy", r"^[A-Za-z]{3} \d{1,2} \d{4}$"),
    ("MMMM d yyyy", r"^[A-Za-z]{3,} \d{1,2} \d{4}$"),
    ("d-MMM-yyyy", r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"),
    ("d-MMMM-yyyy", r"^\d{1,2}-[A-Za-z]{3,}-\d{4}$"),
    ("d.M.yyyy", r"^\d{1,2}\.\d{1,2}\.\d{4}$"),
)


def parse_birthdate(c: Column) -> Column:
    t = text(c)
    return F.coalesce(*(F.when(t.rlike(p), F.try_to_timestamp(t, F.lit(f))).cast("date") for f, p in DATE_FORMATS))


def parse_date(c: Column) -> Column:
    """The local date of an ISO date and time, else as parse_birthdate."""
    t = F.trim(text(c))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?$") & t.rlike(r"T(?:[01]\d|2[0-3])(?::?[0-5]\d)*(?:\.|Z|[+-]|$)"), F.substring(t, 1, 10).try_cast("date"))
    return F.coalesce(iso, parse_birthdate(t))


def format_season(c: Column) -> Column:
    """2012 as 2012-13."""
    year = whole(c)
    return F.concat(text(year), F.lit("-"), two_digits(year + 1))


def two_digits(year: Column) -> Column:
    return F.lpad(text(F.pmod(year, F.lit(100))), 2, "0")


#: Fixed values of name matching.
LIGATURES = (("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"))
ACCENTED = "áàâäãåāą çćč éèêëēėę ğģ íìîïī ķ ļ ñńňņ óòôöõō ř šśş țţ úùûüūų ýÿ žźż"
STROKED = {"đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ı": "i", "İ": "I"}
QUOTES = {"‘": "'", "’": "'", "“": '"', "”": '"', "`": "'", "´": "'", "ʻ": "'", "ʼ": "'"}
DASHES = dict.fromkeys("‐‑‒–—−", "-")
STANDALONE = (("Saint", "St"), ("Sainte", "Ste"), ("Mount", "Mt"), ("and", "&"), ("LA", "Los Angeles"))
STRIPPED = ".,"
WHITE = "\t\n\x0b\f\r"


def unaccented() -> dict[str, str]:
    """The letters of ACCENTED, small and capital, to their base letter, from their canonical decomposition."""
    letters = [x for c in ACCENTED if c != " " for x in (c, c.upper())]
    return {x: unicodedata.normalize("NFD", x)[0] for x in letters} | STROKED


def spelled_apart() -> str:
    """Combining marks that make a letter of ACCENTED of the one before them."""
    parts = [unicodedata.normalize("NFD", x) for c in ACCENTED if c != " " for x in (c, c.upper())]
    marks = {base: "".join(p[1:] for p in parts if p[0] == base) for base in {p[0] for p in parts}}
    return "|".join(rf"(?<={base})[{m}]" for base, m in sorted(marks.items()))


def normalize_name(c: Column) -> Column:
    """Names for matching: plain letters, quotes and dashes, short standalone words, no dots or commas, single spaces.

    Accented letters beyond ACCENTED stay as they are.
    """
    table = unaccented() | QUOTES | DASHES
    t = text(c)
    # the costly passes run only where their characters occur
    t = F.when(t.rlike(r"\p{M}"), F.regexp_replace(t, spelled_apart(), "")).otherwise(t)
    t = F.when(t.rlike(r"[^\x00-\x5F\x61-\x7F]"), F.translate(t, "".join(table), "".join(table.values()))).otherwise(t)
    for old, new in LIGATURES:
        t = F.replace(t, F.lit(old), F.lit(new))
    # every word between blanks of its own, so that a word is replaced as a plain text
    t = F.concat(F.lit(" "), F.replace(F.translate(t, WHITE, " " * len(WHITE)), F.lit(" "), F.lit("  ")), F.lit(" "))
    for old, new in STANDALONE:
        t = F.replace(t, F.lit(f" {old} "), F.lit(f" {new} "))
    for mark in STRIPPED:
        t = F.replace(t, F.lit(mark), F.lit(""))
    t = F.trim(F.regexp_replace(t, " {2,}", " "))
    return F.when(t != "", t)


def compare(c: Column, how: str, threshold: str | float) -> Column:
    """eq and neq compare trimmed texts, gt, gte, lt, lte numbers; blank cells give null."""
    if how in ("eq", "neq"):
        same = F.trim(text(c)) == str(threshold).strip()
        return F.when(~blank(c), same if how == "eq" else ~same)
    n, limit = number(c), float(threshold)
    return F.when(~blank(c), {"gt": n > limit, "gte": n >= limit, "lt": n < limit, "lte": n <= limit}[how])


# Seasons: the year in which a season ends is its canonical form.

SHAPES = ("YYYY", "YY", "YYYY-YY", "YY-YY", "YYYY-YYYY", "YYYY/YY", "YY/YY", "YYYY/YYYY")
PIVOT = 80


def _year(year: Column, digits: int) -> Column:
    return text(year) if digits == 4 else two_digits(year)


def render_season(end_year: Column, shape: str, anchor: str | None = None) -> Column:
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape}")
    mark = next((m for m in "-/" if m in shape), None)
    if mark is None:
        if anchor not in ("start", "end"):
            raise ValueError(f"{shape} needs an anchor")
        return _year(end_year - int(anchor == "start"), len(shape))
    left, right = shape.split(mark)
    return F.concat(_year(end_year - 1, len(left)), F.lit(mark), _year(end_year, len(right)))


def full_year(digits: Column) -> Column:
    """Two digits from PIVOT on are of the last century; four stay."""
    n = digits.try_cast("int")
    return F.when(F.length(digits) == 4, n).when(n >= PIVOT, n + 1900).otherwise(n + 2000)


def parse_season(label: Column, shape: str, anchor: str | None = None) -> Column:
    """The end year of a label; null if it is not of the shape or its years do not follow each other."""
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape}")
    t = F.trim(text(label))
    pattern = "^" + re.sub(r"Y+", lambda m: r"(\d{%d})" % len(m[0]), shape) + "$"
    mark = next((m for m in "-/" if m in shape), None)
    first = full_year(F.regexp_extract(t, pattern, 1))
    if mark is None:
        return F.when(t.rlike(pattern), first + int(anchor == "start"))
    end = F.regexp_extract(t, pattern, 2)
    last = full_year(end)
    follows = F.pmod(first + 1, F.lit(100)) == F.pmod(last, F.lit(100))
    return F.when(t.rlike(pattern) & follows, last)


def season_param(end_year: Column, form: str, split_year: bool = True) -> Column:
    """Runs of S and E in the form become the start and end year, of as many digits as the longest run."""
    start = end_year - 1 if split_year else end_year
    runs = re.findall(r"S+|E+|[^SE]+", form)
    longest = {k: max((len(r) for r in runs if r[0] == k), default=0) for k in "SE"}
    if any(n not in (0, 2, 4) for n in longest.values()):
        raise ValueError("years have two or four digits")
    return F.concat(*(_year(start if r[0] == "S" else end_year, longest[r[0]]) if r[0] in "SE" else F.lit(r) for r in runs))


def current_season_end(day: Column, flip: str) -> Column:
    """On or after the flip day (MM/DD) the season that ends next year is current."""
    return F.year(day) + F.when(F.date_format(day, "MM/dd") >= flip, 1).otherwise(0)


def retained_seasons(end_year: Column, keep: int) -> Column:
    """The labels of the last `keep` seasons, oldest first."""
    return F.transform(F.sequence(end_year - (keep - 1), end_year), lambda y: render_season(y, "YYYY-YY"))


ALLOWED = re.compile(r"^[\w\s.()+*/%-]+$")


def arithmetic(expression: str, fields: dict[str, Column]) -> Column:
    """+ - * / // % ** and signs over named fields as doubles; null where a field is no number or a divisor is 0.

    // and % follow the sign rules of floor division.
    """
    import ast

    def build(node: ast.AST) -> Column:
        if isinstance(node, ast.Expression):
            return build(node.body)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return F.lit(float(node.value))
        if isinstance(node, ast.Name) and node.id in fields:
            return number(fields[node.id])
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
            return -build(node.operand) if isinstance(node.op, ast.USub) else build(node.operand)
        if isinstance(node, ast.BinOp):
            a, b = build(node.left), build(node.right)
            quotient = F.when(b != 0, a / F.when(b != 0, b))
            how = {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b, ast.Div: lambda: quotient, ast.FloorDiv: lambda: F.floor(quotient).cast("double"), ast.Mod: lambda: a - F.floor(quotient) * b, ast.Pow: lambda: F.pow(a, b)}
            if type(node.op) in how:
                return how[type(node.op)]()
        raise ValueError(f"not allowed in an expression: {ast.dump(node)[:60]}")

    if not ALLOWED.match(expression):
        raise ValueError("not an arithmetic expression")
    return build(ast.parse(expression, mode="eval"))


TRANSFORMS: dict[str, Callable[..., Column]] = {
    "safe_int": safe_int,
    "to_int": to_int,
    "to_str": to_str,
    "safe_str": safe_str,
    "null_if_zero": null_if_zero,
    "parse_inches": parse_inches,
    "parse_birthdate": parse_birthdate,
    "parse_date": parse_date,
    "format_season": format_season,
    "normalize_name": normalize_name,
    **{how: (lambda c, threshold, how=how: compare(c, how, threshold)) for how in ("eq", "neq", "gt", "gte", "lt", "lte")},
}
#: A column's declared type to the transform of its cells.
BY_TYPE = {"SMALLINT": "safe_int", "INTEGER": "safe_int", "BIGINT": "safe_int", "TEXT": "safe_str", "VARCHAR": "safe_str", "DATE": "parse_date", "BOOLEAN": "safe_int"}
