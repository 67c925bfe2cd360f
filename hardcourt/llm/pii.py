"""Personal data by candidate boosting, in DataFrame expressions only.

Generators with high recall propose spans that may overlap: whatever the exact patterns find (these base spans always
stay) and looser forms, such as numbers grouped like a phone number without a plus sign, or addresses with "at" and
"dot" spelled out. Boosted trees score each candidate from its format and the words before it; where a candidate can be
decided (check digit, ranges, digits after a plus) that decides its training label, but no feature holds the deciding
fact; those decided as right become spans wherever no base span of their kind lies. Of the undecided, scores above a
threshold, calibrated per kind on held-out documents to PRECISION, become spans as well.

The features are a few bits, so training needs only how often each combination occurs with each label: one aggregate
over all documents that the driver fits trees to. It has a row for
each fold, kind, label and combination of features, of which there are some thousands at most, whatever the corpus.
The trees are applied as a Column expression.

A null text counts as empty. Repeated rows are searched each; an empty table gives no rows (and no trees); other columns
are not read. Texts are searched whole, in time that grows with their length and number of matches: patterns do not try
a run again from its middle, and matches are gathered in chunks. Ties between spans go by kind, start and end; candidates
of equal score fall on the same side of the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import table

KINDS = ("email", "ip", "card", "phone")
CHUNK = 128
TREES, RATE, PRECISION, LEAST_SEEN = 24, 0.3, 0.95, 20

_LOCAL = r"A-Za-z0-9._%+\-"
#: The base patterns. Each matches what the plain form given beside it matches, leftmost and greedy; the plain forms'
#: repeated groups, which the engine would walk recursively, are spelled as one character class up to where they must
#: end, and matches start only where a run starts (or the last match ended), so no run is tried again from its middle.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9\-]++\.[A-Za-z0-9\-][A-Za-z0-9.\-]*?(?=\.(?![A-Za-z0-9\-])|(?![A-Za-z0-9.\-]))",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9][0-9\x20\-]*?(?![0-9]|[\x20\-][0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
_START, _HOST, _TOP = r"(?<![a-z0-9._%+\-])[a-z0-9._%+\-]++", r"[a-z0-9\-]++", r"[a-z]{2,}+"
#: A dot within an address: tight, in brackets, spelled out, apart on both sides, or before a common ending in small letters.
_DOT = r"(?:\x20?[\[(]\x20?(?:dot|\.)\x20?[\])]\x20?|\x20dot\x20|\x20?\.(?!\x20)|\x20\.\x20|\.\x20(?=(?-i:com|org|net|edu|gov)(?![A-Za-z0-9])))"
_WORD_DOT = r"(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20)"
#: A host name has at most 127 labels.
_LABELS = "{0,126}"
_REST = rf"{_HOST}(?:{_DOT}{_HOST}){_LABELS}{_DOT}{_TOP}"
#: Looser forms of the generators. "at" is a word or in brackets; as a bare word it needs a spelled-out "dot" as well.
LOOSE = {
    "email": rf"(?i){_START}(?:(?:\x20?[\[(]\x20?(?:at|@)\x20?[\])]\x20?|\x20?@\x20?){_REST}|\x20at\x20{_HOST}(?:{_DOT}{_HOST}){_LABELS}?{_WORD_DOT}{_TOP}(?:{_DOT}{_TOP}){_LABELS})",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9][0-9\x20\-]{11,}[0-9](?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9][0-9().\x20\-]{5,}[0-9](?![0-9])",
}
#: What looks like an address and is none: the full stop between two sentences taken for a dot. Only for training.
DECOYS = {"email": rf"(?i){_START}\x20?[\[(]?(?:at|@)[\])]?\x20?{_HOST}\.\x20(?!(?-i:com|org|net|edu|gov)(?![A-Za-z0-9])){_TOP}"}
GATES = {"email": None, "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20\-]{14}", "phone": None}
LOOSE_GATES = {"email": r"(?i)[\[(]\x20?at\x20?[\])]|@", "ip": r"[0-9]\x20?\.\x20?[0-9]", "card": r"[0-9][0-9\x20\-]{11}", "phone": r"[0-9][0-9().\x20\-]{5}"}
#: A bare "at" needs both words.
SPELLED = (r"(?i)\x20at\x20", r"(?i)[\x20\[(]dot[\x20\])]")
CUES = r"(?i)(?:tel|phone|call|fax|mobile|mail|contact|card|visa|account|server|host|address|ip)[^a-z]{0,4}$"
_MARK = "\u0001"
_SPAN = "struct<s:int,e:int,t:string,before:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / CHUNK).cast("int")), lambda k: F.slice(items, k * CHUNK + 1, F.lit(CHUNK)))


def _states(chunks: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state at the start of every chunk, and that at the end."""
    return F.aggregate(chunks, F.array(zero), lambda acc, chunk: F.concat(acc, F.array(F.aggregate(chunk, F.element_at(acc, -1), step))))


def scanned(items: Column, zero: Column, step: Callable, emit: Callable, kind: str) -> Column:
    """emit(state, item) of every item in turn; step(state, item) is the state before the next. kind: type of what is emitted.

    An array that grows by one item is copied each time, so items go in chunks of CHUNK and none grows beyond that but the
    states of the chunks.
    """

    def outcome(chunk: Column, state: Column) -> Column:
        start = F.struct(state.alias("state"), F.expr(f"cast(array() as array<{kind}>)").alias("out"))
        return F.aggregate(chunk, start, lambda acc, x: F.struct(step(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out")), lambda acc: acc["out"])

    return let(items, lambda xs: let(_chunks(xs), lambda cs: F.flatten(F.zip_with(cs, F.slice(_states(cs, zero, step), F.lit(1), F.size(cs)), outcome))))


def spans_of(text: Column, pattern: str, gate: Column) -> Column:
    """Leftmost non-overlapping matches as (s, e, t, before): ends in code points, the match, the characters before it.

    One replacement puts marks round the matches; the pieces between marks give the places. text has no marks of its own.
    """
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.lit(False).alias("hit"))

    def step(state: Column, piece: Column) -> Column:
        return F.struct((state["at"] + F.length(piece)).alias("at"), F.right(piece, F.lit(16)).alias("before"), (~state["hit"]).alias("hit"))

    def emit(state: Column, piece: Column) -> Column:
        span = F.struct(state["at"].alias("s"), (state["at"] + F.length(piece)).alias("e"), piece.alias("t"), state["before"].alias("before"))
        return F.when(state["hit"], span)

    found = F.array_compact(scanned(pieces, start, step, emit, _SPAN))
    return F.when(gate, found).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


# A span as one number that sorts by kind, start and end: arrays of numbers are made distinct by hashing, arrays of rows
# by comparing all pairs.


def coded(x: Column) -> Column:
    return F.shiftleft((x["kind"] - 2).cast("long"), 62) + F.shiftleft(x["s"].cast("long"), 31) + x["e"]


def decoded(code: Column) -> Column:
    low = (1 << 31) - 1
    return F.struct((F.shiftright(code, 62) + 2).cast("int").alias("kind"), F.shiftright(code, 31).bitwiseAND(low).cast("int").alias("s"), code.bitwiseAND(low).cast("int").alias("e"))


def apart(loose: Column, base: Column) -> Column:
    """The loose spans (coded) that overlap no base span of their kind: one sweep forward, one back."""
    items = F.array_sort(F.concat(F.transform(base, lambda c: F.struct(c.alias("code"), F.lit(True).alias("fixed"))), F.transform(loose, lambda c: F.struct(c.alias("code"), F.lit(False).alias("fixed")))))
    zero = F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("at"))

    def last(field: str):
        def step(state: Column, x: Column) -> Column:
            return let(decoded(x["code"]), lambda d: F.when(x["fixed"], F.struct(d["kind"].alias("kind"), d[field].alias("at"))).otherwise(state))

        return step

    def behind(state: Column, x: Column) -> Column:
        free = let(decoded(x["code"]), lambda d: (state["kind"] != d["kind"]) | (state["at"] <= d["s"]))
        return F.when(~x["fixed"] & ~free, F.lit(None)).otherwise(F.struct(x["code"].alias("code"), x["fixed"].alias("fixed")))

    def ahead(state: Column, x: Column) -> Column:
        free = let(decoded(x["code"]), lambda d: (state["kind"] != d["kind"]) | (state["at"] >= d["e"]))
        return F.when(~x["fixed"] & free, x["code"])

    kept = F.array_compact(scanned(items, zero, last("e"), behind, "struct<code:bigint,fixed:boolean>"))
    return F.array_compact(scanned(F.reverse(kept), zero, last("s"), ahead, "bigint"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
        return d - F.when(d > 9, 9).otherwise(0)

    value = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + worth(i), lambda acc: acc % 10)
    return value == 0


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
VALID = {
    "email": lambda t: F.lit(True),
    "ip": lambda t: t.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
    "card": lambda t: F.when(F.length(_digits(t)).between(16, 19), luhn(_digits(t))).otherwise(False),
    "phone": lambda t: F.length(_digits(t)).between(8, 15),
}


def _plain(text: Column) -> Column:
    """The text without nulls and without the mark, which belongs to no pattern; places stay."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(_MARK), F.translate(text, _MARK, "\u0002")).otherwise(text)


def _gate(text: Column, kind: str) -> Column:
    plain = {"email": "@", "phone": "+"}
    return text.contains(plain[kind]) if kind in plain else text.rlike(GATES[kind])


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the spans of the exact patterns that pass their checks."""

    def passed(kind: str) -> Column:
        return F.filter(spans_of(text, BASE[kind], _gate(text, kind)), lambda x: VALID[kind](x["t"]))

    return {kind: passed(kind) for kind in KINDS}


def _of_kind(i: int, spans: Column, *more: str, **fixed: bool) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(i).alias("kind"), *(x[c].alias(c) for c in ("s", "e", *more)), *(F.lit(v).alias(c) for c, v in fixed.items())))


def _number(spans: str, i: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == i)).cast("long")


# Features: (name, test of a candidate and its digits) as bits. None of them holds the fact that decides a training label.
FEATURES = (
    *((k, lambda x, d, i=i: x["kind"] == i) for i, k in enumerate(KINDS)),
    *((f"digits>={n}", lambda x, d, n=n: F.length(d) >= n) for n in (7, 8, 10, 11, 13, 16, 20)),
    ("space", lambda x, d: x["t"].contains(" ")),
    ("dash", lambda x, d: x["t"].contains("-")),
    ("paren", lambda x, d: x["t"].contains("(")),
    ("dot", lambda x, d: x["t"].contains(".")),
    ("cue", lambda x, d: x["before"].rlike(CUES)),
    ("glued", lambda x, d: x["before"].rlike(r"[A-Za-z0-9.\-_+]$")),
)


def bits_of(x: Column) -> Column:
    return let(_digits(x["t"]), lambda d: reduce(lambda a, b: a.bitwiseOR(b), (F.when(test(x, d), 1 << i).otherwise(0) for i, (_, test) in enumerate(FEATURES))))


def candidates(text: Column) -> Column:
    """All generators' spans as array of (kind, s, e, t, before, label): label 1 or 0 where decided, else null."""
    made = []
    for i, kind in enumerate(KINDS):
        loose = text.rlike(LOOSE_GATES[kind])
        if kind == "email":
            loose = loose | (text.rlike(SPELLED[0]) & text.rlike(SPELLED[1]))
        for pattern, gate, decoy in ((BASE[kind], _gate(text, kind), False), (LOOSE[kind], loose, False), (DECOYS.get(kind), loose, True)):
            if pattern:
                made.append(_of_kind(i, spans_of(text, pattern, gate), "t", "before", decoy=decoy))

    def label(x: Column) -> Column:
        t, digits = x["t"], _digits(x["t"])
        ip = t.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
        card = F.length(digits).between(16, 19) & t.rlike(r"^[0-9\x20\-]*$")
        return (
            F.when(x["decoy"], 0)
            .when((x["kind"] == 0) & t.contains("@"), 1)
            .when(x["kind"] == 1, F.when(ip, VALID["ip"](t).cast("int")))
            .when(x["kind"] == 2, F.when(card, luhn(digits).cast("int")).otherwise(0))
            .when((x["kind"] == 3) & t.startswith("+"), VALID["phone"](t).cast("int"))
            .when((x["kind"] == 3) & ip, 0)
            .when((x["kind"] == 3) & (F.length(digits) > 15), 0)
        )

    wide = F.filter(F.concat(*made), lambda x: (x["kind"] == 0) | (F.length(_digits(x["t"])) >= F.when(x["kind"] == 1, 4).when(x["kind"] == 2, 13).otherwise(7)))
    return F.transform(wide, lambda x: F.struct(*(x[n].alias(n) for n in ("kind", "s", "e", "t", "before")), label(x).alias("label")))


def fit_trees(cells: list[tuple[int, int, float]]) -> list[tuple[int, int, int, tuple[float, float, float, float]]]:
    """Boosted trees of two levels for the logistic loss. cells: (bits, label, weight).

    A tree is (bit, bit below where it is 0, bit below where it is 1, four leaves).
    """
    score = [0.0] * len(cells)
    trees = []
    n = len(FEATURES)

    def best(rows: list[int], g: list[float], h: list[float]) -> int:
        gain, pick = -1.0, 0
        for f in range(n):
            sums = [[0.0, 1.0], [0.0, 1.0]]
            for r in rows:
                side = sums[cells[r][0] >> f & 1]
                side[0] += g[r]
                side[1] += h[r]
            now = sum(a * a / b for a, b in sums)
            if now > gain + 1e-12:
                gain, pick = now, f
        return pick

    for _ in range(TREES):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [w * (y - q) for (_, y, w), q in zip(cells, p, strict=True)]
        h = [w * q * (1 - q) for (_, _, w), q in zip(cells, p, strict=True)]
        top = best([*range(len(cells))], g, h)
        halves = [[r for r in range(len(cells)) if cells[r][0] >> top & 1 == side] for side in (0, 1)]
        below = [best(half, g, h) if half else 0 for half in halves]
        leaves = []
        for side in (0, 1):
            for low in (0, 1):
                rows = [r for r in halves[side] if cells[r][0] >> below[side] & 1 == low]
                value = RATE * sum(g[r] for r in rows) / (1 + sum(h[r] for r in rows))
                leaves.append(value)
                for r in rows:
                    score[r] += value
        trees.append((top, below[0], below[1], tuple(leaves)))
    return trees


def tree_score(trees: list, bits: int) -> float:
    return sum(leaves[2 * (bits >> top & 1) + (bits >> (one if bits >> top & 1 else zero) & 1)] for top, zero, one, leaves in trees)


def tree_column(trees: list, bits: Column) -> Column:
    def on(f: int) -> Column:
        return bits.bitwiseAND(1 << f) != 0

    each = (F.when(on(top), F.when(on(one), v[3]).otherwise(v[2])).otherwise(F.when(on(zero), v[1]).otherwise(v[0])) for top, zero, one, v in trees)
    return reduce(lambda a, b: a + b, each)


def decided(found: Column) -> Column:
    return F.transform(F.filter(found, lambda x: x["label"].isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), bits_of(x).alias("bits"), x["label"].alias("label")))


def trained(docs: DataFrame, text: str = "text") -> tuple[list, dict[int, float]]:
    """Trees, and per kind the least score that kept PRECISION on the documents held out."""
    fold = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")) % 2
    rows = docs.select(fold.alias("fold"), decided(candidates(_plain(F.col(text)))).alias("found"))
    # apart, so that no row of a candidate carries the text; outer, so that the candidates are found once, not for a filter too
    rows = rows.select("fold", F.explode_outer("found").alias("c")).filter("c.kind is not null")
    counts = rows.groupBy("fold", F.col("c.kind").alias("kind"), F.col("c.bits").alias("bits"), F.col("c.label").alias("label")).count().orderBy("fold", "kind", "bits", "label").collect()
    fit = [(r.bits, r.label, float(r["count"])) for r in counts if r.fold == 0]
    if not fit or len({y for _, y, _ in fit}) < 2:
        return [], {}
    trees = fit_trees(fit)
    least = {}
    for kind in range(len(KINDS)):
        held = sorted(((tree_score(trees, r.bits), r.label, r["count"]) for r in counts if r.fold == 1 and r.kind == kind), reverse=True)
        good = seen = 0
        for k, (score, label, count) in enumerate(held):
            good, seen = good + label * count, seen + count
            if (k + 1 == len(held) or held[k + 1][0] < score) and seen >= LEAST_SEEN and good >= PRECISION * seen:
                least[kind] = score
    return trees, least


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `base` and `spans`, arrays of (kind, s, e) by kind, start and end; kind counts in KINDS."""
    trees, least = trained(docs, text)
    plain = _plain(F.col(text))
    rows = docs.withColumn("_plain", plain)
    plain = F.col("_plain")
    base = F.concat(*(_of_kind(i, found) for i, found in enumerate(base_spans(plain).values())))
    rows = rows.withColumn("base", F.array_sort(base))

    def undecided(x: Column) -> Column:
        over = F.lit(float("inf"))
        for kind, score in least.items():
            over = F.when(x["kind"] == kind, F.lit(score)).otherwise(over)
        return F.when(x["label"].isNull(), let(bits_of(x), lambda bits: tree_column(trees, bits)) >= over).otherwise(False) if least else F.lit(False)

    def chosen(found: Column) -> Column:
        """Codes of the base spans, of candidates decided as right that lie apart from them, and of those the trees choose."""
        own = F.transform("base", coded)
        right = F.array_except(F.transform(F.filter(found, lambda x: x["label"] == 1), coded), own)
        lying = let(right, lambda r: F.when(F.size(r) > 0, apart(r, own)).otherwise(r))
        return F.array_sort(F.array_distinct(F.concat(own, lying, F.transform(F.filter(found, undecided), coded))))

    return rows.withColumn("spans", F.transform(let(candidates(plain), chosen), decoded)).drop("_plain")  # columns of these names are replaced


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced by the first one's.

    Spans go in chunks, and each chunk is cut out of the text before its own pieces are.
    """
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))

    def furthest(at: Column, x: Column) -> Column:
        return F.greatest(at, x["e"])

    def replaced(chunk: Column, first: Column) -> Column:
        local = F.substring(text, first + 1, F.aggregate(chunk, first, furthest) - first)

        def within(local: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                piece = F.array(F.substring(local, acc["at"] - first + 1, x["s"] - acc["at"]), names[x["kind"]])
                return F.struct(furthest(acc["at"], x).alias("at"), F.when(x["s"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

            return F.aggregate(chunk, F.struct(first.alias("at"), F.expr("cast(array() as array<string>)").alias("out")), step, lambda acc: F.array_join(acc["out"], ""))

        return let(local, within)

    def whole(chunks: Column) -> Column:
        def joined(ends: Column) -> Column:
            parts = F.zip_with(chunks, F.slice(ends, F.lit(1), F.size(chunks)), replaced)
            return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

        return let(_states(chunks, F.lit(0), furthest), joined)

    return F.when(F.size(spans) == 0, text).otherwise(let(order, lambda xs: let(_chunks(xs), whole)))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [_number("base", i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
