"""N-gram Jaccard join by count-vector R-trees.

A document's set holds 64-bit hashes of its distinct shingles of SHINGLE words. Hashes fall into groups by their leading
bits; how many of a set's shingles fall into each group is the set's point. Two sets share at most the sum of the smaller
of their counts, group by group, and two boxes of points at most the sum of the smaller of their greatest counts.

1. A class holds sizes within a factor of CLASS; a set is in the class of its size and, if a partner that large may be in
   the next one, in that too. Two sets of a class that link differ in at most D shingles, D by the class's largest size.
   The class cuts the hashes into D + 1 + s runs of groups; two such sets agree in all counts, indeed in all shingles, of
   more than s runs. So the first level of the tree is exact: each run's points are boxes of one point, and only texts that
   share such a box can link. Runs of few shingles say little, so every set leaves out its s smallest, in an order that
   hangs on the run's shingles only: of more than s runs that two sets share, neither leaves out the last in that order.
   Where D is 0, only equal sets link, which are one text from the start.
2. Every box links its members to its least one (a star, not all pairs). Links are kept if the sum of minima of their
   points (about PER_GROUP shingles a group) allows it and the sets, then compared, are alike enough.
3. Components of the links are found. Boxes of three texts or more that still hold several components are put together by
   the largest of these, each text once; that component is cut into blocks, and the texts outside it are laid beside each
   block and each other. A task packs its texts' points into an R-tree, walks it against itself and drops pairs of boxes
   whose sizes, components or summed minima exclude a link. For texts that have a partner left their sets are fetched, the
   surviving pairs are verified from the most alike down, and links that join components are returned, fewer than texts.

So no link between different components is lost, whatever the sizes of groups, and no group's pairs are written out.

Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer words than a shingle is one shingle; a
null or blank one has an empty set and is linked with nothing. Every row is a document of its own, repeated ids included;
rows without an id take part, and a component is named by its least id, null where it has none. Empty tables give no rows;
other columns are not read. Texts are used whole. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.components import rooted, stars
from hardcourt.llm.order_minhash import keyed
from hardcourt.llm.runtime import Scratch, pieces, set_apart, ship, table
from hardcourt.llm.words import mixed

SHINGLE, PERCENT = 4, 85
SPARE, SPARE_SHARE, CLASS = 3, 4, 1.5
LEAST_GROUPS, MOST_GROUPS, PER_GROUP = 64, 4096, 8
FANOUT = 8
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
BROADCAST_ROWS = 500_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_PAIRS, _WAITING, _COUNTS = 1 << 12, 1 << 11, 1 << 19


def word_hashes(text: str | None) -> np.ndarray:
    found = (text or "").encode("utf-8", "replace").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mixed(out * _MUL + h[j : j + n])
    return np.unique(out)


def least_shared(a: int | np.ndarray, b: int | np.ndarray, percent: int = PERCENT):
    """How many shingles sets of these sizes must share: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def class_starts(largest: int) -> list[int]:
    """Sizes at which classes begin, up to the one that holds `largest`: a rule, the same for every set."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, int(starts[-1] * CLASS)))
    return starts


def differences(end: int, percent: int = PERCENT) -> int:
    """In how many shingles two linked sets smaller than `end` may differ."""
    return int((100 - percent) * 2 * (end - 1) // (100 + percent))


def run_keys(shingles: np.ndarray, percent: int = PERCENT) -> list[np.ndarray]:
    """For each class the set is in, a key of its shingles in every run but the smallest."""
    n, out, starts = len(shingles), [], class_starts(len(shingles) * 100 // percent + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles * _MUL), dtype=np.uint64)])
    for k in range(len(starts) - 1):
        if starts[k + 1] <= n or starts[k] * percent > n * 100 or not differences(starts[k + 1], percent):
            continue
        most = differences(starts[k + 1], percent)
        spare = max(min(SPARE, most), most // SPARE_SHARE)
        runs = most + 1 + spare
        edges = np.array([-(-(j << 64) // runs) for j in range(1, runs)], np.uint64)
        at = np.concatenate([[0], np.searchsorted(shingles, edges), [n]])
        # the class stands in the last bits, so that a box knows it
        key = mixed((sums[at[1:]] - sums[at[:-1]]) ^ mixed(np.arange(k << 32, (k << 32) + runs, dtype=np.uint64))) & ~np.uint64(63) | np.uint64(k)
        out.append(key[np.lexsort([key, np.diff(at)])[spare:]])
    return out


def groups(k: int) -> int:
    """Into how many groups a class's points count: about PER_GROUP shingles in each."""
    return min(MOST_GROUPS, max(LEAST_GROUPS, 1 << (class_starts_at(k) // PER_GROUP).bit_length()))


def class_starts_at(k: int) -> int:
    start = 1
    for _ in range(k):
        start = max(start + 1, int(start * CLASS))
    return start


def point(shingles: np.ndarray, many: int) -> np.ndarray:
    """The set's count in each of `many` groups, a power of two."""
    return np.bincount((shingles >> np.uint64(65 - many.bit_length())).astype(np.int64), minlength=many).astype("<u2" if len(shingles) < 1 << 16 else "<u4")


def folded(stored: bytes, n: int, many: int) -> np.ndarray:
    """The counts of as many groups or fewer, of a stored point of n shingles."""
    return np.frombuffer(stored, "<u2" if n < 1 << 16 else "<u4").reshape(many, -1).sum(axis=1, dtype=np.int32)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


class CountTree:
    """A packed R-tree: FANOUT boxes of a level make one of the next; a box has its greatest counts and ranges of sizes and
    components. Points are packed by component, then size, then counts."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, roots: np.ndarray):
        self.order = np.lexsort([*counts.T[:4], sizes, roots])
        level = (counts[self.order].astype(np.int32), sizes[self.order], sizes[self.order], roots[self.order], roots[self.order])
        self.levels = [level]
        while len(level[0]) > 1:
            at = np.arange(0, len(level[0]), FANOUT)
            level = tuple(f.reduceat(x, at, axis=0) for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum, np.maximum), level, strict=True))
            self.levels.append(level)

    def _kept(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        most, low, high, first, last = self.levels[level]
        ok = ~((first[i] == last[j]) & (last[i] == first[j]) & (first[i] == last[i]))
        ok &= (100 * high[i] >= percent * low[j]) & (100 * high[j] >= percent * low[i])
        i, j = i[ok], j[ok]
        some = max(1, _COUNTS // most.shape[1])  # a long text's point has thousands of counts
        room = np.concatenate([np.zeros(0, np.int64), *(np.minimum(most[i[k : k + some]], most[j[k : k + some]]).sum(axis=1) for k in range(0, len(i), some))])
        room = room - least_shared(low[i], low[j], percent)
        return i[room >= 0], j[room >= 0], room[room >= 0]

    def candidates(self, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points of different components that no box excludes, those with most room first."""
        none = np.zeros(0, np.int32)
        found = [(none, none, none)]
        start = np.zeros(min(1, len(self.order)), np.int32)
        todo = [(len(self.levels) - 1, start, start)]
        while todo:  # depth first, some pairs of boxes at a time, so that what waits stays small
            level, i, j = todo.pop()
            i, j, room = self._kept(level, i, j, percent)
            if not level:
                inner = i < j
                found.append((i[inner], j[inner], room[inner].astype(np.int32)))
                continue
            n, below = len(self.levels[level - 1][0]), np.arange(FANOUT, dtype=np.int32)
            for k in range(0, len(i), _WAITING):
                x, y = i[k : k + _WAITING], j[k : k + _WAITING]
                x, y = np.repeat(x, FANOUT * FANOUT) * FANOUT + np.tile(np.repeat(below, FANOUT), len(x)), np.repeat(y, FANOUT * FANOUT) * FANOUT + np.tile(below, len(y) * FANOUT)
                there = (x < n) & (y < n) & (x <= y)
                todo.append((level - 1, x[there], y[there]))
        i, j, room = (np.concatenate(p) for p in zip(*found, strict=True))
        best = np.lexsort([j, i, -room])
        return self.order[i[best]], self.order[j[best]]


def joining_links(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], many: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between sets of different components, enough to join all that links among these sets join."""
    sizes = np.array([len(g) for g in sets], np.int64)
    parent = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    links = []
    left, right = CountTree(np.array([point(g, many) for g in sets], np.int32).reshape(-1, many), sizes, roots).candidates(percent)
    for k in range(0, len(left), _PAIRS):
        for a, b in zip(left[k : k + _PAIRS].tolist(), right[k : k + _PAIRS].tolist(), strict=True):
            p, q = top(int(roots[a])), top(int(roots[b]))
            if p != q and shared(sets[a], sets[b]) >= least_shared(len(sets[a]), len(sets[b]), percent):
                parent[p] = q
                links.append((int(ids[a]), int(ids[b])))
    return links


def profiles(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, row, node (digest of the set, null for an empty one), n, and for the first of a task's equal sets its keys
    and its point in the groups of the last class it is in."""
    ship(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches):
            nodes, sizes, keys, at = [], [], [], []
            for text in batch.column(2).to_pylist():
                g = shingle_set(text)
                node = int.from_bytes(hashlib.blake2b(g.astype("<u8").tobytes(), digest_size=8).digest(), "little", signed=True) if len(g) else None
                own = [] if node is None or node in seen else run_keys(g, percent)
                seen.add(node)
                nodes.append(node)
                sizes.append(len(g))
                keys.append(np.concatenate(own).view(np.int64) if own else None)
                at.append(point(g, groups(int(own[-1][0]) & 63)).tobytes() if own else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(at, pa.binary())],
                ["doc_id", "row", "node", "n", "keys", "point"],
            )

    return docs.select("doc_id", "row", "text").mapInArrow(step, "doc_id long, row binary, node long, n long, keys array<long>, point binary")


def boxes(keyed_nodes: DataFrame) -> DataFrame:
    """(key, lead, node): members of boxes that hold two texts or more, each with the box's least one. keyed_nodes: key, node.

    Rows come sorted, so a task holds a box's least text and nothing else of it, however many members it has.
    """
    ship(keyed_nodes.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = node = lead = None  # the row before, and its box's first
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = (batch.column(k).to_numpy() for k in (0, 1))
            begins = np.append(key is None or keys[0] != key, keys[1:] != keys[:-1])
            again = ~begins & np.append(not begins[0] and nodes[0] == node, nodes[1:] == nodes[:-1])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(keys)), -1))
            leads = np.where(at >= 0, nodes[at], 0 if lead is None else lead)
            member = (leads != nodes) & ~again
            key, node, lead = keys[-1], nodes[-1], leads[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[member]) for x in (keys, leads, nodes)], ["key", "lead", "node"])

    dealt = keyed_nodes.select("key", "node").repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(step, "key long, lead long, node long")


def set_rows(docs: DataFrame, known: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, g): the sets, as sorted 64-bit numbers, of `nodes`, each from one row of docs.

    Up to BROADCAST_ROWS rows are broadcast, so that no text is exchanged; more are joined by exchanges.
    """
    ship(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t).astype("<u8").tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["node", "g"])

    rows = known.groupBy("node", "doc_id", "row").agg(F.count("*").alias("times"))
    rows = rows.groupBy("node").agg(F.min(F.struct("doc_id", "row", "times")).alias("r")).join(nodes, "node", "left_semi")
    wanted = Scratch(docs.sparkSession).stored(rows.select("node", F.coalesce("r.doc_id", F.lit(0)).alias("_id"), "r.row", "r.times"))
    size = wanted.agg(F.count("*").alias("n"), F.max("times").alias("times")).collect()[0]
    texts = docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), "row", "text")
    if (size["times"] or 1) > 1:
        texts = texts.dropDuplicates(["_id", "row"])
    wanted = wanted.select("node", "_id", "row")
    found = texts.join(F.broadcast(wanted) if size["n"] <= BROADCAST_ROWS else wanted, ["_id", "row"])
    return found.select("node", "text").mapInArrow(step, "node long, g binary")


def likely(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and points allow to link."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True):
                many = min(len(x) // (2 if m < 1 << 16 else 4), len(y) // (2 if n < 1 << 16 else 4))
                keep.append(bool(np.minimum(folded(x, m, many), folded(y, n, many)).sum() >= least_shared(m, n, percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (facts.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}")) for c in "ab")
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.join(right, "b").join(left, "a").filter(near).select("a", "b", "na", "nb", "pa", "pb").mapInArrow(step, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            both = (tuple(np.frombuffer(x, "<u8") for x in p) for p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            keep = [shared(a, b) >= least_shared(len(a), len(b), percent) for a, b in both]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(c), F.col("g").alias(f"g{c}")) for c in "ab")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ga", "gb").mapInArrow(step, "a long, b long")


GROUP = ("main", "class", "low", "high")


def laid_out(open_: DataFrame) -> DataFrame:
    """(GROUP, node, root): which texts a task lays beside each other. open_: key, node, root, n of boxes with several components.

    Boxes of a class are put together by their largest component, `main`. That component is cut into blocks, one block for
    each of its texts; the texts outside it are cut into chunks, and each chunk is laid beside every block and every other
    chunk.
    """
    counts = open_.groupBy("key", "root").count()
    main = counts.groupBy("key").agg(F.max(F.struct("count", "root")).alias("m")).select("key", F.col("m.root").alias("main"))
    texts = open_.join(main, "key").select("main", F.expr("cast(key & 63 as int)").alias("class"), "node", "root", "n").distinct()
    astray = F.col("root") != F.col("main")

    def blocks(of: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(of) / BLOCK, F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES, F.lit(1))).cast("int")

    sizes = texts.groupBy("main", "class").agg(blocks(~astray).alias("mains"), blocks(astray).alias("chunks"))
    dealt = texts.join(sizes, ["main", "class"]).withColumn("straggles", astray)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", "main"), F.when(F.col("straggles"), F.col("chunks")).otherwise(F.col("mains"))).cast("int"))
    # chunk beside block (numbered from 0), where the chunk meets itself, too; and chunk beside chunk (numbered below 0)
    beside = F.when(F.col("straggles"), F.concat(
        F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda b: F.struct(F.col("own").alias("low"), b.alias("high"))),
        F.transform(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda b: b != F.col("own")), lambda b: F.struct(F.least("own", b).alias("low"), (-1 - F.greatest("own", b)).alias("high"))),
    )).otherwise(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda b: F.struct(b.alias("low"), F.col("own").alias("high"))))
    return dealt.select("main", "class", F.inline(beside), "node", "root")


def with_partners(dealt: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The rows of laid_out whose text has, in its task, one of another component that no box of the tree excludes."""

    def step(group: pa.Table) -> pa.Table:
        many = groups(group.column("class")[0].as_py())
        sizes = group.column("n").to_numpy()
        counts = np.array([folded(p, n, many) for p, n in zip(group.column("point").to_pylist(), sizes.tolist(), strict=True)])
        tree = CountTree(counts, sizes, group.column("root").to_numpy())
        return group.select([*GROUP, "node", "root"]).take(pa.array(np.unique(np.concatenate(tree.candidates(percent)))))

    return dealt.join(facts, "node").groupBy(*GROUP).applyInArrow(step, "main long, class int, low int, high int, node long, root long")


def links_across(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join components within the groups of laid_out."""

    def step(group: pa.Table) -> pa.Table:
        found = [np.frombuffer(g, "<u8") for g in group.column("g").to_pylist()]
        links = joining_links(group.column("node").to_numpy(), group.column("root").to_numpy(), found, groups(group.column("class")[0].as_py()), percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return dealt.join(sets, "node").groupBy(*GROUP).applyInArrow(step, "a long, b long")


def ngram_components(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    scratch, docs = Scratch(docs.sparkSession), keyed(set_apart(docs, (key, text))[0], key, text)
    known = scratch.stored(profiles(docs, percent))
    members = scratch.stored(boxes(known.filter("keys is not null").select(F.explode("keys").alias("key"), "node")))
    pairs = scratch.stored(members.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    inside = scratch.stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    facts = scratch.stored(known.filter("point is not null").dropDuplicates(["node"]).select("node", "n", "point").join(inside, "node"))
    near = scratch.stored(likely(pairs, facts, percent))
    scratch.drop(pairs, inside)
    named = known.select("node", "doc_id", "row").filter("node is not null")
    sets = scratch.stored(set_rows(docs, named, near.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    first = scratch.stored(verified(near, sets, percent))
    flat = stars(first)
    scratch.drop(near, first, sets)
    # boxes of three texts or more in which several components are left; of two, the only pair has been tested
    whole = members.select("key", "node").unionByName(members.groupBy("key").agg(F.min("lead").alias("node")))
    roots = rooted(flat).withColumnRenamed("node", "_node")
    placed = scratch.stored(whole.join(roots, F.col("node") == F.col("_node"), "left").select("key", "node", F.coalesce("root", "node").alias("root")))
    left = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("size")).filter("r0 < r1 and size > 2").select("key")
    open_ = scratch.stored(placed.join(left, "key").join(facts.select("node", "n"), "node"))
    scratch.drop(members, placed)
    dealt = scratch.stored(with_partners(laid_out(open_), facts, percent))
    scratch.drop(open_, facts)
    if not dealt.isEmpty():
        sets = scratch.stored(set_rows(docs, named, dealt.select("node").distinct()))
        second = scratch.stored(links_across(dealt, sets, percent))
        scratch.drop(sets)
        before, flat = flat, stars(flat.unionByName(second))
        scratch.drop(before, second)
    scratch.drop(dealt)
    # every text's component by its least id
    texts = known.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    texts = texts.join(rooted(flat).withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    texts = scratch.stored(texts)
    names = texts.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.stored(texts.join(names, "root").select(F.col("node").alias("_node"), "component_id"))
    scratch.drop(texts)
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return known.select("doc_id", "n", "node").join(named, F.col("node") == F.col("_node"), "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, md5(array_to_string(w[i : i + 3], ' ')) as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from worded where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), links as (
  select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reached as (
  select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a
), least as (
  select a, min(b) as m from reached group by a
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, m) as component_id
from documents d left join sizes on sizes.doc_id = d.doc_id left join least on least.a = d.doc_id
"""
