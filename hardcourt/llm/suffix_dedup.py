"""Repeated passages by a sparse suffix array.

Suffixes are kept at minimiser positions only: of every WINDOW consecutive SEED-word grams the one of least hash, so two
occurrences of a passage keep the same suffixes, whatever surrounds them. Any passage of LEAST words or more has a kept
suffix within its first WINDOW words, hence with NEAR = LEAST - WINDOW + 1 words of the passage behind it.

1. Suffixes whose first NEAR words, as a hash, occur in no other document are left out: they can't be in a passage.
2. The others get LEAST words to their right and the WINDOW - 1 words to their left, and are put in order: by the hash of
   the first NEAR words, which keeps equal ones together, then by all words to the right, then by those to the left. The
   order is dealt out in ranges of that hash, id and place, so that a passage in very many documents has many tasks and
   the ranges are found from numbers alone; each is sorted by itself.
3. Neighbours in that order that are of different documents are compared word by word and extended right and left. What
   agrees over LEAST words or more is a passage in both.
4. Suffixes with the same NEAR words are a run of neighbours. In a run of three or more, or one that a partition's end
   cuts, a suffix may share a passage with one that isn't its neighbour. Where a suffix of such a run has passages of
   LEAST words that its neighbours did not show, all of the run's are compared by a digest of their words.

Every word that lies in a run of LEAST words which occurs in two documents or more is found, and no other. Runs are
streamed, not gathered, and digests are counted by partial aggregates and joined back by key, so a passage in a third of
all texts is spread over many tasks.

Null texts count as empty. Rows with equal ids count as one document, rows without an id are not searched. Ties: suffixes
that agree in all words go by id and place; passages that touch are one. Empty tables give no rows; other columns are not
read. Texts of any length are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import Scratch, ship, table
from hardcourt.llm.words import grams, hashes, words

LEAST, WINDOW, SEED = 50, 25, 6
NEAR = LEAST - WINDOW + 1
_BATCH = 20_000


def chosen(seeds: np.ndarray) -> np.ndarray:
    """For each start of WINDOW consecutive grams the position of the least of them (the last of equals)."""
    if len(seeds) < WINDOW:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(seeds[::-1], WINDOW)
    return (len(seeds) - 1 - (np.arange(len(view)) + view.argmin(axis=1)))[::-1]


def anchors(h: np.ndarray) -> np.ndarray:
    """For each start of LEAST words the place of its first kept suffix."""
    return chosen(grams(h, SEED))[: max(0, len(h) - LEAST + 1)]


def suffixes(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, near): kept suffixes with the hash of their first NEAR words."""
    ship(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, near, size = [], [], [], 0

            def out(ids=ids, places=places, near=near):
                docs_ = np.repeat(np.array(ids, np.int64), [len(p) for p in places])
                return pa.RecordBatch.from_arrays([pa.array(docs_), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(near).view(np.int64))], ["doc_id", "pos", "near"])

            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = hashes(words(text))
                if len(h) < LEAST:
                    continue
                at = np.unique(anchors(h))
                ids.append(doc)
                places.append(at)
                near.append(grams(h, NEAR)[at])
                size += len(at)
                if size > 50_000:
                    yield out()
                    size = 0
                    for x in (ids, places, near):
                        x.clear()
            if ids:
                yield out()

    return docs.select("doc_id", "text").mapInArrow(step, "doc_id long, pos int, near long")


def of_several(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """The rows whose key occurs in more than one document.

    The keys are written first, so that the join is of two plain tables and Spark may split a key with many rows.
    """
    keys = rows.groupBy(key).agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1")).filter("d0 < d1").select(key)
    return rows.join(scratch.stored(keys), key)


SUFFIX = "doc_id long, pos int, near long, lo int, hi int, right binary, left binary"


def contents(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """The suffixes listed (seen: doc_id, places) with their words to the right and, in reverse, to the left.

    A passage of LEAST words whose first kept suffix it is starts lo to hi words before it.
    """
    ship(docs.sparkSession)
    names = [x.split()[0] for x in SUFFIX.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = words(text)
                h = hashes(found)
                if len(h) < LEAST:
                    continue
                starts, near = anchors(h), grams(h, NEAR).view(np.int64)
                for p in np.intersect1d(starts, places).tolist():
                    s0, s1 = np.searchsorted(starts, p, "left"), np.searchsorted(starts, p, "right") - 1
                    rows.append((doc, p, near[p], p - s1, p - s0, b" ".join(found[p : p + LEAST]), b" ".join(found[max(0, p - WINDOW + 1) : p][::-1])))
                if len(rows) >= _BATCH:
                    yield out()
                    rows.clear()
        if rows:
            yield out()

    return docs.select("doc_id", "text").join(seen, "doc_id").mapInArrow(step, SUFFIX)


def common(a: bytes, b: bytes) -> int:
    """Number of words that both begin with."""
    if a == b:
        return a.count(b" ") + 1 if a else 0
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    i = int(differ.argmax()) if n and differ.any() else n
    if i == n and n:  # the shorter is all there
        return a.count(b" ", 0, n) + int((a if len(a) > n else b)[n] == 0x20)
    return a.count(b" ", 0, i)


class Run:
    """Suffixes with the same NEAR words: how many there are, and how many have shown all their passages."""

    def __init__(self, near: int, cut: bool):
        self.near, self.cut, self.n, self.done = near, cut, 0, 0

    def open(self) -> bool:
        return self.done < self.n and (self.cut or self.n > 2)


class Suffix:
    __slots__ = ("doc", "done", "hi", "left", "lo", "pos", "right", "run")

    def __init__(self, doc, pos, lo, hi, right, left, run):
        self.doc, self.pos, self.lo, self.hi, self.right, self.left, self.run, self.done = doc, pos, lo, hi, right, left, run, False

    def extended(self, left: int, right: int) -> None:
        if not self.done and left >= self.hi and right >= LEAST - self.lo:
            self.done = True
            self.run.done += 1


def neighbours(ordered: DataFrame) -> DataFrame:
    """(doc_id, start, length, near) from suffixes in order: passages, and in rows of their own runs to be looked at again."""
    names = ["doc_id", "start", "length", "near"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = other = run = None  # other: the last suffix of another document than `last`
        for batch in batches:
            for doc, pos, near, lo, hi, right, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run is None or near != run.near:
                    if run is not None and run.open():
                        rows.append((None, None, None, run.near))
                    run = Run(near, run is None)
                run.n += 1
                x = Suffix(doc, pos, lo, hi, right, left, run)
                y = last if last is not None and last.doc != doc else other
                if y is not None and y.run is run:
                    r, k = common(right, y.right), common(left, y.left)
                    if r + k >= LEAST:
                        for s in (x, y):
                            s.extended(k, r)
                            rows.append((s.doc, s.pos - k, r + k, None))
                if last is not None and last.doc != doc:
                    other = last
                last = x
            if len(rows) >= _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows.clear()
        if run is not None:
            run.cut = True
            if run.open():
                rows.append((None, None, None, run.near))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return ordered.mapInArrow(step, "doc_id long, start int, length int, near long")


def digests(suffix_rows: DataFrame) -> DataFrame:
    """(doc_id, whole, start): a digest of every passage of LEAST words whose first kept suffix is one of these."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wholes, starts = [], [], []
            for doc, pos, _, lo, hi, right, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                around = [*left.split()[::-1][-hi:], *right.split()] if hi else right.split()
                for k in range(hi - lo + 1):
                    ids.append(doc)
                    starts.append(pos - hi + k)
                    wholes.append(hashlib.blake2b(b" ".join(around[k : k + LEAST]), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(wholes, pa.binary()), pa.array(starts, pa.int32())], ["doc_id", "whole", "start"])

    return suffix_rows.select(*(x.split()[0] for x in SUFFIX.split(", "))).mapInArrow(step, "doc_id long, whole binary, start int")


SPANS = "n_repeated long, spans array<struct<start:int,length:int>>"


def joined(marks: DataFrame) -> DataFrame:
    """(doc_id, n_repeated, spans) from (doc_id, start, length), spans that touch as one. Each mark is kept once, also
    where an id stands on many rows, and before marks are exchanged."""
    pair = pa.struct([("start", pa.int32()), ("length", pa.int32())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, spans = [], []
            for found in batch.column(1).to_pylist():
                out: list[list[int]] = []
                for start, length in sorted({(s["start"], s["length"]) for s in found}):
                    if out and start <= out[-1][0] + out[-1][1]:
                        out[-1][1] = max(out[-1][1], start + length - out[-1][0])
                    else:
                        out.append([start, length])
                totals.append(sum(n for _, n in out))
                spans.append([{"start": s, "length": n} for s, n in out])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(spans, pa.list_(pair))], ["doc_id", "n_repeated", "spans"])

    return marks.groupBy("doc_id").agg(F.collect_set(F.struct("start", "length")).alias("found")).mapInArrow(step, f"doc_id long, {SPANS}")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_repeated, spans) for documents with repeated passages; spans: array of (start, length) in words, joined."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).filter("doc_id is not null")
    every = scratch.stored(suffixes(rows))
    # a document's list is as long as the document at most
    seen = scratch.stored(of_several(every, "near", scratch).groupBy("doc_id").agg(F.collect_set("pos").alias("places")))
    scratch.drop(every)
    held = scratch.stored(contents(rows, seen))
    scratch.drop(seen)
    dealt = held.repartitionByRange("near", "doc_id", "pos").sortWithinPartitions("near", "right", "left", "doc_id", "pos")
    found = scratch.stored(neighbours(dealt))
    again = scratch.stored(digests(held.join(found.filter("near is not null").select("near").distinct(), "near", "left_semi")))
    scratch.drop(held)
    more = of_several(again, "whole", scratch).select("doc_id", "start", F.lit(LEAST).alias("length"))
    return joined(found.filter("doc_id is not null").select("doc_id", "start", "length").unionByName(more))


def op2_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_repeated", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["length"])), ",").alias("spans"))
