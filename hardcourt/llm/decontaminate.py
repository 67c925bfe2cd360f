"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all benchmark items.

A window is WINDOW consecutive words of an item (an item with fewer words, but some, is one window). Texts and windows
are normalised alike, to words between single spaces, so an occurrence of " w1 ... wn " in a text's normal form is an
occurrence of those words. Each text is scanned once; places in the normal form are mapped to words, and for texts with
a hit to characters of the original.

The benchmark is a stated set of queries that is run against all rows. It goes to the workers in blocks of at most
BLOCK_CHARS characters of windows, one automaton each. Of a benchmark with more than one block, the driver draws one at a
time, and what its scan found is written before the next one is drawn: one block is all that is ever broadcast.

Null texts have no words; null items none either. An item whose id is null hits, but is not named among the items.
Repeated rows are scanned each, repeated items count once; empty tables give no rows or no hits; further columns of the
inputs are not read. Texts of any length are scanned whole. Items are named in the order of their ids as strings.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardcourt.llm.runtime import Scratch, ship, table
from hardcourt.llm.words import WORD, words

WINDOW = 10
BLOCK_CHARS = 8_000_000


def windows(text: str | None, size: int = WINDOW) -> set[str]:
    """Normal forms of an item's windows; latin-1 stands for bytes."""
    found = words(text)
    runs = [found[i : i + size] for i in range(max(1, len(found) - size + 1))] if found else []
    return {f" {b' '.join(r).decode('latin-1')} " for r in runs}


def blocks(items: DataFrame, size: int = WINDOW, most: int = BLOCK_CHARS) -> Iterator[list[tuple[str | None, str]]]:
    """(item_id, text) of the benchmark, in blocks whose windows have about `most` characters."""
    block, chars = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        if row.text:
            block.append((None if row.item_id is None else str(row.item_id), row.text))
            chars += size * len(row.text)
            if chars >= most:
                yield block
                block, chars = [], 0
    if block:
        yield block


_automata: dict = {}


def automaton(name: str, items: list[tuple[str | None, str]], size: int):
    """Windows to (their words, the items that have them); a worker keeps the automaton of one block."""
    if name not in _automata:
        import ahocorasick

        of: dict[str, set[str]] = {}
        for item, text in items:
            for w in windows(text, size):
                who = of.setdefault(w, set())
                if item is not None:
                    who.add(item)
        machine = ahocorasick.Automaton()
        for w, who in of.items():
            machine.add_word(w, (w.count(" ") - 1, tuple(sorted(who))))
        if of:
            machine.make_automaton()
        _automata.clear()
        _automata[name] = machine if of else None
    return _automata[name]


def scan(text: str | None, machine) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, the word ranges covered (merged, end exclusive), the items that occur."""
    found = words(text)
    if not found or machine is None:
        return len(found), [], set()
    line = f" {b' '.join(found).decode('latin-1')} "
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    at = before = 0  # spaces up to `at`
    for end, (length, who) in machine.iter(line):
        before += line.count(" ", at, end + 1)
        at = end + 1
        ranges.append((before - 1 - length, before - 1))
        items.update(who)
    return len(found), merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Characters of the original text that the word ranges cover."""
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(places[a][0], places[b - 1][1]) for a, b in ranges]


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """docs with n_words and state: the word ranges that are hit and the items that occur, as JSON; null where none."""
    spark = docs.sparkSession
    ship(spark)
    found = docs.drop("n_words", "state").withColumns({"n_words": F.lit(0).cast("long"), "state": F.lit(None).cast("string")})
    names = found.columns
    schema, at = T.StructType([T.StructField(f.name, f.dataType) for f in found.schema]), names.index(text)
    scratch, past = Scratch(spark), None
    drawn = blocks(items, size)
    block = next(drawn, [])
    while True:
        name, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

        def step(batches: Iterator[pa.RecordBatch], name=name, shared=shared) -> Iterator[pa.RecordBatch]:
            machine = automaton(name, shared.value, size)
            for batch in batches:
                n_words, states = [], []
                for doc, state in zip(batch.column(at).to_pylist(), batch.column(len(names) - 1).to_pylist(), strict=True):
                    n, ranges, who = scan(doc, machine)
                    if state and ranges:
                        old = json.loads(state)
                        ranges, who = merged([*ranges, *map(tuple, old[0])]), {*who, *old[1]}
                    n_words.append(n)
                    states.append(json.dumps([ranges, sorted(who)]) if ranges else state)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(n_words, pa.int64()), pa.array(states, pa.string())], names)

        found = found.mapInArrow(step, schema)
        block = next(drawn, None)
        if block is None:
            return found
        # more than one block; columns may be called anything, so they are written under neutral names
        now = scratch.stored(found.toDF(*(f"c{k}" for k in range(len(names)))))
        shared.unpersist()
        scratch.drop(past)
        past, found = now, now.toDF(*names)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The columns of the query from contamination() of (key, text), the spans in the original text among them."""
    kind = found.schema[key].dataType.simpleString()
    none = hashlib.sha256(b"").hexdigest()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, state in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if state:
                    ranges, who = json.loads(state)
                    spans = ",".join(f"{a}:{b}" for a, b in original_spans(doc, ranges))
                    rows.append((sum(b - a for a, b in ranges), len(who), hashlib.sha256(",".join(who).encode()).hexdigest(), spans))
                else:
                    rows.append((0, 0, none, ""))
            hit, n, sha, spans = map(list, zip(*rows, strict=True)) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(hit, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in hit], pa.bool_()), pa.array(spans, pa.string())],
                [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
            )

    return found.mapInArrow(step, f"{key} {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans string")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return digest(found).drop("spans")


OP10_SQL = rf"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from benchmark),
wins as (
  select distinct item_id, len(w[i:i + {WINDOW - 1}])::bigint as size, array_to_string(w[i:i + {WINDOW - 1}], ' ') as win
  from item_words, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) as t(i) where len(w) > 0),
sizes as (select distinct size from wins),
doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from documents),
grams as (
  select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as win
  from doc_words, sizes, unnest(range(1, greatest(1, len(w) - size + 2))) as t(i)),
hits as (select doc_id, i, g.size, item_id from grams g join wins s on g.win = s.win and g.size = s.size),
hit_words as (select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + size)) as t(p) group by 1),
hit_items as (select doc_id, count(item) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item_id::varchar as item from hits) group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
