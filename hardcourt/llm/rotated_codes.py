"""Hard negatives by rotated one-bit codes.

Vectors become whole numbers, floor(256 * x). Each is turned by one random rotation into a space of up to four times its
dimensions and kept as the signs there, one bit each. With the code stand the code vector's length, the vector's alignment
with it (its component along the code vector) and the length of what is left over. For an anchor q the sum of its rotated
components under the signs is taken by popcounts of bit planes, its rounding error bounded; that gives q's component x along
the code vector, and

    alignment * x  -/+  rest * sqrt(|q|^2 - x^2)

holds the inner product for certain (Cauchy-Schwarz on what is orthogonal to the code vector). Rows whose interval can't
matter are left out; all others are scored in whole numbers. Which rows are good enough is known from those scored before
and, at first, from those of best estimates.

Rows of one label are stored in chunks of CHUNK, anchors in blocks of ANCHORS; about ROUND blocks, 8192 anchors, are
broadcast at a time and laid beside every chunk where it is read, so no row of the table is exchanged for the search. A task
keeps the best few of each anchor and hands on nothing else; a window takes the best of all tasks.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows equal in id, label and
vector count once; other rows that share an id are rows of their own, but none is its anchor's partner. Ties go to the
smaller id. Shorter vectors count as if zeros followed. Components and scores beyond 64 bits count as the bound. Empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hardcourt.llm.runtime import Scratch, set_apart, ship, table

POSITIVES, NEGATIVES, LOW_PERCENT = 5, 5, 80
CHUNK, ANCHORS, ROUND = 4096, 256, 32
WIDEN, WIDEST = 4, 1024
PLANES = 8
LONG = (1 << 63) - 1
_PAIRS = 1 << 16

CODED = "lane int, label int, n int, ids binary, whole binary, codes binary, facts binary"


@lru_cache(maxsize=1)
def rotation(dims: int) -> np.ndarray:
    """A random rotation of `dims` dimensions into a multiple of 64: its columns are orthonormal."""
    wide = -(-max(dims, min(WIDEN * dims, WIDEST)) // 64) * 64
    return np.linalg.qr(np.random.default_rng(20250713).standard_normal((wide, dims)))[0]


def coded(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (64 signs a word) and, per row: alignment, rest, length of the code vector, length of the vector."""
    v, turn = whole.astype(np.float64), rotation(whole.shape[1])
    turned = v @ turn.T
    signs = turned >= 0
    codes = np.packbits(signs, axis=1, bitorder="little").view("<u8")
    length = np.linalg.norm(np.where(signs, 1.0, -1.0) @ turn, axis=1)
    norm = np.linalg.norm(v, axis=1)
    along = np.abs(turned).sum(axis=1) / length
    rest = np.sqrt(np.maximum(norm**2 - along**2, 0)) + 1e-7 * norm
    return codes, np.stack([along, rest, length, norm], axis=1)


class Anchors:
    """A block of anchors with their bit planes."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, label: int):
        self.ids, self.whole, self.label = ids, whole, label
        v = whole.astype(np.float64)
        turned = v @ rotation(whole.shape[1]).T
        half = 1 << PLANES - 1
        self.step = np.maximum(np.abs(turned).max(axis=1), 1e-300) / (half - 1)
        k = np.rint(turned / self.step[:, None])
        self.error = np.abs(turned - k * self.step[:, None]).sum(axis=1)
        self.sum, self.norm = k.sum(axis=1), np.linalg.norm(v, axis=1)
        shifted = (k + half).astype(np.uint16)
        self.planes = [np.packbits(shifted >> j & 1 == 1, axis=1, bitorder="little").view("<u8") for j in range(PLANES)]

    def intervals(self, codes: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(estimate, low, high) of every anchor's inner product with every row."""
        total = np.zeros((len(self.ids), len(codes)), np.int32)
        for j, plane in enumerate(self.planes):
            hit = np.zeros(total.shape, np.int32)
            for w in range(codes.shape[1]):
                hit += np.bitwise_count(plane[:, w, None] & codes[None, :, w])
            total += hit << j
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        signed = 2 * (total - (ones << PLANES - 1)[None, :]) - self.sum[:, None]
        along, rest, length, norm = facts.T
        x = signed * self.step[:, None] / length
        off = self.error[:, None] / length + 1e-9 * self.norm[:, None]
        room = rest * np.sqrt(np.maximum(self.norm[:, None] ** 2 - np.maximum(np.abs(x) - off, 0) ** 2, 0)) + along * off + 1e-6 * self.norm[:, None] * norm + 1e-6
        estimate = along * x
        return estimate, np.clip(estimate - room, -(2.0**63), 2.0**63), np.clip(estimate + room, -(2.0**63), 2.0**63)

    def scores(self, whole: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Inner products in whole numbers of anchors i with rows j."""
        most = float(np.abs(self.whole).max(initial=0)) * float(np.abs(whole).max(initial=0)) * whole.shape[1]
        if most >= 2.0**62:
            return np.array([max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(self.whole[a].tolist(), whole[b].tolist(), strict=True)))) for a, b in zip(i, j, strict=True)], np.int64)
        return np.concatenate([np.zeros(0, np.int64), *(np.einsum("ij,ij->i", self.whole[i[k : k + _PAIRS]], whole[j[k : k + _PAIRS]]) for k in range(0, len(i), _PAIRS))])


class Best:
    """For each key (an anchor, or one of its positives), the best few (score, id), kept as they come."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(keys, -np.inf)  # the score that a newcomer has to reach

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(key):
            return
        key, score, id_ = (np.concatenate(p) for p in ((self.key, key), (self.score, score), (self.id, id_)))
        order = np.lexsort([id_, -score.astype(object) if (score == -LONG - 1).any() else -score, key])
        key, score, id_ = key[order], score[order], id_[order]
        nth = np.arange(len(key)) - np.searchsorted(key, key)
        keep = nth < self.most
        self.key, self.score, self.id = key[keep], score[keep], id_[keep]
        full = self.key[nth[keep] == self.most - 1]
        self.least[full] = self.score[nth[keep] == self.most - 1]


def take_positives(anchors: Anchors, best: Best, ids: np.ndarray, whole: np.ndarray, codes: np.ndarray, facts: np.ndarray) -> None:
    """Rows of the anchors' label: those that may be among the best, scored."""
    estimate, _, high = anchors.intervals(codes, facts)
    other = anchors.ids[:, None] != ids[None, :]
    estimate = np.where(other, estimate, -np.inf)
    first = np.argpartition(-estimate, min(POSITIVES, len(ids)) - 1, axis=1)[:, :POSITIVES]
    some = np.zeros(estimate.shape, bool)
    np.put_along_axis(some, first, True, axis=1)
    some &= other
    for mask in (some, None):
        mask = mask if mask is not None else other & ~some & (high >= best.least[:, None])
        i, j = np.nonzero(mask)
        best.add(i, anchors.scores(whole, i, j), ids[j])


def take_negatives(anchors: Anchors, positives: np.ndarray, there: np.ndarray, best: Best, ids: np.ndarray, whole: np.ndarray, codes: np.ndarray, facts: np.ndarray) -> None:
    """Rows of another label: those that may lie in a positive's range and be among its best, scored. positives: each
    anchor's positive scores, where `there`; best's keys are anchor * POSITIVES + positive."""
    _, low, high = anchors.intervals(codes, facts)
    open_ = there & (positives >= 0)
    least = np.where(open_, np.fmax(positives * (LOW_PERCENT / 100), best.least.reshape(positives.shape)) * (1 - 1e-9), np.inf).min(axis=1)
    most = np.where(open_, positives.astype(float), -np.inf).max(axis=1) * (1 + 1e-9)
    mask = (high >= least[:, None]) & (low <= most[:, None]) & (anchors.ids[:, None] != ids[None, :])
    i, j = np.nonzero(mask)
    score = anchors.scores(whole, i, j)
    for k in range(positives.shape[1]):
        fits = there[i, k] & in_range(positives[i, k], score)
        best.add(i[fits] * POSITIVES + k, score[fits], ids[j[fits]])


def in_range(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """LOW_PERCENT * positive <= 100 * negative <= 100 * positive, without overflow."""
    if len(positive) and max(np.abs(positive.astype(float)).max(), np.abs(negative.astype(float)).max()) >= 2.0**55:
        positive, negative = positive.astype(object), negative.astype(object)
    return ((LOW_PERCENT * positive <= 100 * negative) & (negative <= positive)).astype(bool)


def whole_rows(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite).select("vec_id", "label", x.cast("array<double>").alias("vector"))


def chunks(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """CODED: rows of one label, `size` at most, with their codes."""
    ship(rows.sparkSession)

    def packed(label: int, ids: np.ndarray, whole: np.ndarray) -> list:
        codes, facts = coded(whole)
        return [0, label, len(ids), ids.astype("<i8").tobytes(), whole.astype("<i8").tobytes(), codes.tobytes(), facts.astype("<f8").tobytes()]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        names = [x.split()[0] for x in CODED.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]

        def out(parts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p], t) for p, t in zip(parts, types, strict=True)], names)

        for batch in batches:
            ids, labels, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            sizes = lists.value_lengths().to_numpy()
            whole = np.zeros((len(ids), dims), np.int64)
            there = np.arange(dims)[None, :] < sizes[:, None]
            whole[there] = np.clip(np.floor(256 * lists.flatten().to_numpy()), -(2.0**63), 2.0**63 - 1024).astype(np.int64)
            for label in np.unique(labels).tolist():
                own = labels == label
                held = waiting.setdefault(label, [ids[:0], whole[:0]])
                held[:] = [np.concatenate([held[0], ids[own]]), np.concatenate([held[1], whole[own]])]
                while len(held[0]) >= size:
                    yield out(packed(label, held[0][:size], held[1][:size]))
                    held[:] = [held[0][size:], held[1][size:]]
        for label, (ids, whole) in waiting.items():
            if len(ids):
                yield out(packed(label, ids, whole))

    return rows.select("vec_id", "label", "vector").mapInArrow(step, CODED)


def unpacked(batch: pa.RecordBatch, row: int, side: str, dims: int) -> dict:
    at = {n: batch.column(f"{side}{n}")[row].as_py() for n in ("label", "ids", "whole", "codes", "facts")}
    return {"label": at["label"], "ids": np.frombuffer(at["ids"], "<i8"), "whole": np.frombuffer(at["whole"], "<i8").reshape(-1, dims), "codes": at["codes"], "facts": at["facts"]}


def beside(blocks: DataFrame, stored_chunks: DataFrame, on: Column, step, schema: str, rounds: int, scratch: Scratch) -> DataFrame:
    """step over every chunk beside every block that `on` lets meet, about ROUND blocks broadcast at a time."""
    left = stored_chunks.select(*(F.col(n).alias(f"c_{n}") for n in stored_chunks.columns))
    right = blocks.select(*(F.col(n).alias(f"b_{n}") for n in blocks.columns))
    out = None
    for k in range(rounds):
        some = right.filter(F.pmod(F.xxhash64("b_block"), F.lit(rounds)) == k)
        found = scratch.stored(left.join(F.broadcast(some), on).mapInArrow(step, schema))
        out = found if out is None else out.unionByName(found)
    return out


def searched(dims: int, most: int, keys: int, take) -> object:
    """The search of one task: per block, the best of all chunks it has read. take(anchors, batch, row, best, chunk)"""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[Anchors, Best]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("b_block")[row].as_py()
                if block not in state:
                    b = unpacked(batch, row, "b_", dims)
                    state[block] = Anchors(b["ids"], b["whole"], b["label"]), Best(len(b["ids"]) * keys, most)
                anchors, best = state[block]
                c = unpacked(batch, row, "c_", dims)
                codes = np.frombuffer(c["codes"], "<u8").reshape(len(c["ids"]), -1)
                take(anchors, batch, row, best, (c["ids"], c["whole"], codes, np.frombuffer(c["facts"], "<f8").reshape(-1, 4)))
        for block, (anchors, best) in state.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best.key), block)), pa.array(best.key // keys), pa.array(best.key % keys), pa.array(anchors.ids[best.key // keys]), pa.array(best.id), pa.array(best.score)], FOUND_NAMES
            )

    return step


FOUND = "block long, nth long, slot long, anchor_id long, id long, score long"
FOUND_NAMES = [x.split()[0] for x in FOUND.split(", ")]


def best_of_all(found: DataFrame, most: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, anchors: Column, vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). rows: vec_id, label, vector; anchors: which."""
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    rows = whole_rows(set_apart(rows, ("vec_id", "label", vector))[0].withColumns({"vec_id": F.col("vec_id").cast("long"), "label": F.col("label").cast("int")}), vector)
    rows = scratch.stored(rows.dropDuplicates(["vec_id", "label", "vector"]))
    facts = rows.agg(F.max(F.size("vector")).alias("d"), F.count_if(anchors).alias("n")).collect()[0]
    dims, rounds = max(1, facts["d"] or 1), -(-facts["n"] // (ANCHORS * ROUND)) or 1
    all_chunks = scratch.stored(chunks(rows, dims, CHUNK))
    blocks = scratch.stored(chunks(rows.filter(anchors), dims, ANCHORS).drop("codes", "facts").withColumn("block", F.monotonically_increasing_id()).withColumns({"codes": F.lit(None).cast("binary"), "facts": F.lit(None).cast("binary")}))
    scratch.drop(rows)

    def positives(anchors: Anchors, _batch, _row, best: Best, chunk) -> None:
        take_positives(anchors, best, *chunk)

    found = beside(blocks, all_chunks, F.col("c_label") == F.col("b_label"), searched(dims, POSITIVES, 1, positives), FOUND, rounds, scratch)
    nearest = scratch.stored(best_of_all(found, POSITIVES, "block", "nth").select("block", "nth", (F.col("rank") - 1).alias("slot"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # a block's positives: at most POSITIVES for each of its anchors
    beside_blocks = nearest.groupBy("block").agg(F.collect_list(F.struct("nth", "slot", "positive_score")).alias("pos"))
    ready = scratch.stored(blocks.join(beside_blocks, "block"))

    def negatives(anchors: Anchors, batch: pa.RecordBatch, row: int, best: Best, chunk) -> None:
        if not hasattr(anchors, "positives"):
            anchors.positives, anchors.there = np.zeros((len(anchors.ids), POSITIVES), np.int64), np.zeros((len(anchors.ids), POSITIVES), bool)
            for p in batch.column("b_pos")[row].as_py():
                anchors.positives[p["nth"], p["slot"]], anchors.there[p["nth"], p["slot"]] = p["positive_score"], True
        take_negatives(anchors, anchors.positives, anchors.there, best, *chunk)

    # `lane` is the same everywhere: every block of anchors meets every chunk of other labels
    on = (F.col("c_lane") == F.col("b_lane")) & (F.col("c_label") != F.col("b_label"))
    found = beside(ready, all_chunks, on, searched(dims, NEGATIVES, POSITIVES, negatives), FOUND, rounds, scratch)
    best = best_of_all(found, NEGATIVES, "block", "nth", "slot").select("block", "nth", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = scratch.stored(best.join(nearest, ["block", "nth", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, a.label as own, b.vec_id as other_id, b.label as label, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
  from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where label = own
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id, (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id))::int as rank,
       s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> s.own and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify rank <= 5
"""
