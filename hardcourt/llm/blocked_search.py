"""Ranked lexical search over posting lists in geometric blocks.

Documents become sparse vectors over the terms that the queries hold: per term tf and length give a whole-number impact, and
a document's score is the sum of weight * impact over the query's terms. A task's documents are grouped by likeness (each
goes to the nearest of up to CENTRES sampled documents) and kept in segments of up to SEGMENT, a row of the index each, in an
order that puts documents with the same leading terms together. In a segment each term's posting list is cut into blocks of
up to BLOCK documents that follow each other. A block's summary is stored with it: the greatest impact of each term over its
documents, for all terms that a query may ask together with the list's term, in 255 steps rounded up. A query's sum over a
summary bounds the score of all of the block's documents.

The search reads every segment twice. First each segment scores, for every query, the documents of the block of greatest
bound; the tenth of all those scores is a threshold that no document of a final top list falls below. Then every block whose
bound reaches its query's threshold, or the tenth score that the task itself has found, is scored whole; blocks are skipped
only if their bound stays below. So results are exact, ties included, whatever the segments and blocks are.

Terms are runs of digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. Null texts have none. Rows that share
an id are documents of their own, and repeated rows are repeated; a row without an id counts in the corpus but can't be named
in a result. Items that share an id are queries of their own, one without an id has no results. An item without terms or
matches gives no rows; nor do empty tables. Other columns are not read. Texts are used whole.

Items are answered about QUERIES at a time, so that what is broadcast (their terms and weights) is bounded by their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hardcourt.llm.runtime import Scratch, pieces, set_apart, ship, table
from hardcourt.llm.words import words

TOP = 10
CENTRES, SEGMENT, BLOCK = 16, 2048, 128
QUERIES = 256
SHARE, SCALE = 90, 1_000_000_000
#: An impact is below SCALE / 1000; so many of them make one of 255 steps.
STEP = -(-SCALE // 1000 // 255)


class Queries:
    """Some queries: their terms numbered, and, once corpus counts are known, weights as a matrix of query by term."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        held = [{*words(text)} for _, text in items]
        self.terms = sorted({t for h in held for t in h})
        self.number = {t: k for k, t in enumerate(self.terms)}
        self.of = [np.array(sorted(self.number[t] for t in h), np.int64) for h in held]
        self.weights = np.zeros((0, 0))
        asking: list[list[int]] = [[] for _ in self.terms]
        for q, own in enumerate(self.of):
            for t in own.tolist():
                asking[t].append(q)
        #: per term, the queries that ask it, and all terms that these ask
        self.asking = [np.array(a) for a in asking]
        self.beside = [np.unique(np.concatenate([self.of[q] for q in a])) for a in asking]

    def weigh(self, documents: int, df: np.ndarray) -> None:
        w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        self.weights = np.zeros((len(self.of), len(self.terms)), np.int64)
        for q, own in enumerate(self.of):
            self.weights[q, own] = w[own]


def vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms, tf: numbers and counts of the documents' terms that queries hold."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(number)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                found = words(text)
                hits = np.fromiter((k for k in map(known.value.get, found) if k is not None), np.int32)
                own, tf = np.unique(hits, return_counts=True)
                sizes.append(len(found))
                terms.append(own)
                counts.append(tf)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])

    return docs.select("doc_id", "text").mapInArrow(step, "doc_id long, n long, terms array<int>, tf array<long>")


def corpus_counts(found: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and each query term's number of documents; counted in each task first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 2, np.int64)
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            total[terms] += (sizes > 0).sum()
            total[terms + 1] += sizes.sum()
            total[:terms] += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["term", "c"])

    total = np.zeros(terms + 2, np.int64)
    for row in found.select("n", "terms").mapInArrow(step, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).collect():
        total[row["term"]] = row["c"]
    return int(total[terms]), int(total[terms + 1]), total[:terms]


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to a score for each unit of its weight."""
    if SHARE * float(n.max(initial=0)) * documents < 2.0**62:
        m = 100 - SHARE + SHARE * n * documents // max(length, 1)
    else:
        m = np.array([100 - SHARE + SHARE * int(x) * documents // max(length, 1) for x in n], np.int64)
    return SCALE * tf // (1000 * tf + 8 * m)


def dense(terms: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as one sparse matrix: where rows begin, columns, values."""
    return np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *terms]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *values]).astype(np.int64)


class Segment:
    """Documents of a likeness with their impacts, and every term's posting list in blocks with their summaries."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, lists: tuple[np.ndarray, ...]):
        self.ids, self.starts, self.terms, self.values = ids, starts, terms, values
        #: the terms that have a list, where each list begins, the documents of all lists, the summaries of all blocks
        self.listed, self.begins, self.members, self.summaries = lists

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows' terms stand, and where each row's end."""
        size = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(size)
        return np.arange(size.sum()) - np.repeat(ends - size, size) + np.repeat(self.starts[rows], size), ends

    def scores(self, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
        at, ends = self.entries(rows)
        total = np.concatenate([[0], np.cumsum(weights[self.terms[at]] * self.values[at])])
        return np.diff(total[np.concatenate([[0], ends])])

    def bounds(self, queries: Queries) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Per posting list: the queries that ask it, the greatest score each block allows each of them, the blocks' documents."""
        at = 0
        for k, term in enumerate(self.listed.tolist()):
            members = self.members[self.begins[k] : self.begins[k + 1]]
            cuts, beside, asking = range(0, len(members), BLOCK), queries.beside[term], queries.asking[term]
            summary = self.summaries[at : at + len(cuts) * len(beside)].reshape(len(cuts), len(beside))
            at += summary.size
            weights = queries.weights[np.ix_(asking, beside)].astype(np.float64)
            yield asking, weights @ (summary.T.astype(np.float64) * STEP), [members[c : c + BLOCK] for c in cuts]


def posting_lists(documents: int, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: Queries) -> tuple[np.ndarray, ...]:
    """listed, begins, members and summaries of a segment."""
    row = np.repeat(np.arange(documents), np.diff(starts))
    order = np.argsort(terms, kind="stable")
    members = row[order]
    listed, begins = np.unique(terms[order], return_index=True)
    begins = np.append(begins, len(order))
    place = np.full(len(queries.terms), len(listed))
    place[listed] = np.arange(len(listed))
    steps = np.zeros((documents, len(listed) + 1), np.uint8)  # the last column stands for terms that none of them has
    steps[row, place[terms]] = -(-values // STEP)
    out = [np.zeros(0, np.uint8)]
    for k, term in enumerate(listed.tolist()):
        own = steps[np.ix_(members[begins[k] : begins[k + 1]], place[queries.beside[term]])]
        out.append(np.maximum.reduceat(own, np.arange(0, len(own), BLOCK), axis=0).ravel())
    return listed, begins, members, np.concatenate(out)


def likeness(terms: list[np.ndarray], values: list[np.ndarray], centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each document. centres: rows of length one over all terms."""
    out = np.zeros(len(terms), np.int64)
    for k, (t, v) in enumerate(zip(terms, values, strict=True)):
        if len(t):
            out[k] = np.argmax(centres[:, t] @ v)
    return out


def in_order(starts: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
    """An order in which documents alike stand together: by their terms of greatest impact."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort([terms, -values, row])
    nth = np.arange(len(row)) - starts[row[order]]
    lead = np.full((len(starts) - 1, 3), -1)
    for k in range(3):
        lead[row[order][nth == k], k] = terms[order][nth == k]
    return np.lexsort(lead.T[::-1])


KINDS = {"ids": "<i8", "starts": "<i4", "terms": "<i4", "values": "<i4", "listed": "<i4", "begins": "<i4", "members": "<i2", "summaries": "u1"}


def index(found: DataFrame, documents: int, length: int, queries: Queries) -> DataFrame:
    """The segments, a row each. found: vectors()."""
    spark, terms = found.sparkSession, len(queries.terms)
    ship(spark)
    share = min(1.0, 8 * CENTRES / max(documents, 1))
    some = found.filter("size(terms) > 0").filter(F.xxhash64("doc_id", "n", "terms") % 1_000_003 < F.lit(int(share * 1_000_003))).orderBy(F.xxhash64("terms", "doc_id")).limit(CENTRES).collect()
    centres = np.zeros((max(1, len(some)), terms))
    for k, r in enumerate(some):
        v = impacts(np.array(r["tf"], np.int64), np.full(len(r["tf"]), r["n"]), documents, length)
        centres[k, r["terms"]] = v / np.linalg.norm(v)
    known, asked = spark.sparkContext.broadcast(centres), spark.sparkContext.broadcast(queries)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lists = [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
            values = [impacts(np.array(tf, np.int64), np.full(len(tf), n), documents, length) for n, tf in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            centre = likeness(lists, values, known.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(centre), batch.column(2), pa.array(values, pa.list_(pa.int64()))], ["doc_id", "centre", "terms", "values"])

    placed = found.filter("doc_id is not null and size(terms) > 0").mapInArrow(assign, "doc_id long, centre long, terms array<int>, values array<long>")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def out(rows: list) -> pa.RecordBatch:
            ids = np.array([r[0] for r in rows], np.int64)
            starts, t, v = dense([r[1] for r in rows], [r[2] for r in rows])
            order = in_order(starts, t, v)
            starts, t, v = dense([rows[k][1] for k in order], [rows[k][2] for k in order])
            parts = (ids[order], starts, t, v, *posting_lists(len(ids), starts, t, v, asked.value))
            return pa.RecordBatch.from_arrays([pa.array([p.astype(kind).tobytes()], pa.binary()) for p, kind in zip(parts, KINDS.values(), strict=True)], [*KINDS])

        for batch in pieces(batches):
            for doc_id, centre, t, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = waiting.setdefault(centre, [])
                held.append((doc_id, np.array(t, np.int32), np.array(v, np.int32)))
                if len(held) == SEGMENT:
                    yield out(waiting.pop(centre))
        for held in waiting.values():
            yield out(held)

    # likeness within a task: no document is exchanged
    return placed.mapInArrow(segments, ", ".join(f"{n} binary" for n in KINDS))


def segment_at(batch: pa.RecordBatch, row: int) -> Segment:
    parts = [np.frombuffer(batch.column(n)[row].as_py(), kind) for n, kind in KINDS.items()]
    parts = [p.astype(np.int64) if p.dtype != np.uint8 else p for p in parts]
    return Segment(*parts[:4], tuple(parts[4:]))


def kept(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TOP best, equal scores by ascending id."""
    best = np.lexsort([ids, -scores])[:TOP]
    return scores[best], ids[best]


def first_scores(segments: DataFrame, queries) -> DataFrame:
    """(query, score): of each task, the TOP scores met in the block of greatest bound of each segment; for thresholds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = queries.value
        best = [np.zeros(0, np.int64) for _ in known.of]
        for batch in batches:
            for row in range(batch.num_rows):
                s, most, where = segment_at(batch, row), np.zeros(len(known.of)), {}
                for asking, bound, blocks in s.bounds(known):
                    top = bound.argmax(axis=1)
                    high = bound[np.arange(len(asking)), top]
                    for k in np.flatnonzero(high > most[asking]).tolist():
                        most[asking[k]], where[int(asking[k])] = high[k], blocks[top[k]]
                for q, rows in where.items():
                    best[q] = np.sort(np.append(best[q], s.scores(known.weights[q], rows)))[::-1][:TOP]
        lines = [(q, x) for q, b in enumerate(best) for x in b.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in lines], pa.int32()), pa.array([x for _, x in lines], pa.int64())], ["query", "score"])

    return segments.mapInArrow(step, "query int, score long")


def searched(segments: DataFrame, queries, least) -> DataFrame:
    """(query, doc_id, score): each task's best, of documents in blocks that the thresholds don't exclude."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, limit = queries.value, least.value.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in known.of]
        for batch in batches:
            for row in range(batch.num_rows):
                s = segment_at(batch, row)
                wanted = np.zeros((len(known.of), len(s.ids)), bool)
                for asking, bound, blocks in s.bounds(known):
                    for k, b in np.argwhere(bound >= limit[asking][:, None]).tolist():
                        wanted[asking[k], blocks[b]] = True
                for q in np.flatnonzero(wanted.any(axis=1)).tolist():
                    rows = np.flatnonzero(wanted[q])
                    scores = s.scores(known.weights[q], rows)
                    ok = scores >= limit[q]
                    best[q] = kept(np.append(best[q][0], scores[ok]), np.append(best[q][1], s.ids[rows[ok]]))
                    if len(best[q][0]) == TOP:
                        limit[q] = max(limit[q], best[q][0][-1])
        sizes, none = [len(b[0]) for b in best], np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes).astype(np.int32)), pa.array(np.concatenate([none, *(b[1] for b in best)])), pa.array(np.concatenate([none, *(b[0] for b in best)]))], ["query", "doc_id", "score"]
        )

    return segments.mapInArrow(step, "query int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's TOP documents. docs: doc_id, text; items: item_id, text."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = set_apart(docs, ("doc_id", "text"))[0].select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = set_apart(items, ("item_id", "text"))[0].filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = scratch.stored(items.withColumn("key", F.monotonically_increasing_id()))
    rounds, out = -(-items.count() // QUERIES) or 1, None
    for k in range(rounds):
        some = items.filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == k).select("item_id", "text").collect()
        queries = Queries([(r["item_id"], r["text"]) for r in some])
        found = scratch.stored(vectors(docs, queries.number))
        documents, length, df = corpus_counts(found, len(queries.terms))
        queries.weigh(documents, df)
        segments = scratch.stored(index(found, documents, length, queries))
        scratch.drop(found)
        sent = spark.sparkContext.broadcast(queries)
        order = W.partitionBy("query").orderBy(F.col("score").desc())
        tenth = first_scores(segments, sent).withColumn("r", F.row_number().over(order)).filter(F.col("r") == TOP).collect()
        least = np.ones(len(queries.of), np.int64)
        for r in tenth:
            least[r["query"]] = max(1, r["score"])
        hits = searched(segments, sent, spark.sparkContext.broadcast(least))
        order = W.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
        best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
        names = spark.createDataFrame([(q, int(i)) for q, i in enumerate(queries.ids)], "query int, item_id long")
        best = scratch.stored(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
        scratch.drop(segments)
        out = best if out is None else out.unionByName(best)
    return out


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
with found as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), corpus as (
  select count(*)::bigint as nd, sum(len(w))::bigint as l from found where len(w) > 0
), tf as (
  select doc_id, len(w)::bigint as n, t, count(*)::bigint as tf from (select doc_id, w, unnest(w) as t from found) group by doc_id, w, t
), df as (
  select t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::bigint as w from tf, corpus group by t
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::bigint as score
  from asked join tf using (t) join df using (t), corpus group by item_id, doc_id
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 10
"""
