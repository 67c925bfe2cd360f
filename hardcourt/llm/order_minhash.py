"""Near-duplicate classes by order min-hash with banded alignment.

k-mers are SHINGLE consecutive words, labelled with their number of occurrence, so repeats count. A sketch takes, under
its own random order, the PICKED least labelled k-mers of a text and keeps them in the order they have in the text; two
texts agree in a sketch with a probability that falls with their edit distance. SKETCHES sketches are drawn; texts that
agree in one are candidates.

1. Texts with the same words form one group; its least id stands for it.
2. Each bucket of a sketch links its members to its least one (a star, not all pairs). Links whose lengths or whose
   256-bit one-bit min-hashes exclude the threshold by five standard deviations are not verified.
3. Links are verified: the k-mer sequences of both texts are aligned within the band that a similarity of SIMILARITY
   leaves, and the similarity is aligned k-mers over all k-mers, |A| / (|a| + |b| - |A|).
4. Components of the verified links are found. Every bucket that still holds more than one component is then searched for
   links between components, so none is lost to the stars. Of a bucket with at most SMALL members the pairs from different
   components are tested the same way. The texts of larger ones are put together by the largest component of their bucket,
   each once, and searched by blocks: that component is cut into blocks, and only the texts outside it are laid beside each
   of them. A task counts the k-mers that its texts share, takes the pairs that could reach the threshold from the most
   alike down, and aligns those not linked yet. It returns links that join components, fewer than it has texts. Where more
   than STRAGGLERS texts are outside, all first get FINER more sketches of FINER_PICKED k-mers, whose buckets hold only
   texts that are more alike, and what is open of those is searched in the same two ways.

Tables that a step writes are dropped once the next one is written.

Null texts count as empty; texts without words are copies of each other only if they are equal. Texts with fewer words
than a k-mer are one k-mer. A class is named by its least id, null where no row of it has one. An id that occurs in
several rows gets one row, with the least of its texts' classes; rows without an id take part but get none. Empty tables
give no rows; other columns are not read. Texts are used whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.components import rooted, stars
from hardcourt.llm.runtime import Scratch, ship, table
from hardcourt.llm.words import grams, hashes, mixed, words

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, PICKED = 16, 3
FINER, FINER_PICKED = 48, 6
BITS = 256
SMALL, BLOCK, BLOCK_KMERS, COLUMNS = 48, 512, 1 << 19, 4096
STRAGGLERS = 8 * BLOCK

_RANDOM = np.random.default_rng(20240611)
_ODD = _RANDOM.integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_FINER_ODD = _RANDOM.integers(1, 1 << 63, FINER, dtype=np.uint64) | np.uint64(1)
_SLICE = 4096


def kmers(found: list[bytes]) -> np.ndarray:
    """Occurrence-labelled hashes of the text's k-mers, in text order."""
    if not found:
        return np.zeros(0, np.uint64)
    g = grams(hashes(found), min(SHINGLE, len(found)))
    order = np.argsort(g, kind="stable")
    run = g[order]
    new = np.append(True, run[1:] != run[:-1])
    if new.all():
        return g
    at = np.arange(len(g))
    nth = np.empty(len(g), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.where(nth == 0, g, mixed(g + nth * np.uint64(0x9E3779B97F4A7C15)))


def order_sketches(g: np.ndarray, odd: np.ndarray = _ODD, picked: int = PICKED) -> np.ndarray:
    """One value per sketch; odd: the multipliers that give the sketches their random orders."""
    keys, places = np.zeros((len(odd), 0), np.uint64), np.zeros((len(odd), 0), np.int64)
    for k in range(0, len(g), _SLICE):
        part = g[k : k + _SLICE]
        x = (part[None, :] ^ (part[None, :] >> np.uint64(29))) * odd[:, None]
        x ^= x >> np.uint64(32)
        keys = np.concatenate([keys, x], axis=1)
        places = np.concatenate([places, np.broadcast_to(np.arange(k, k + len(part)), x.shape)], axis=1)
        if keys.shape[1] > picked:
            least = np.argpartition(keys, picked - 1, axis=1)[:, :picked]
            keys, places = np.take_along_axis(keys, least, 1), np.take_along_axis(places, least, 1)
    in_order = g[np.sort(places, axis=1)]
    out = np.arange(len(odd), dtype=np.uint64) + np.uint64(1)
    for j in range(in_order.shape[1]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + in_order[:, j])
    return out


def one_bit(g: np.ndarray) -> np.ndarray:
    """BITS one-bit min-hashes as four 64-bit numbers: the least hash in each of BITS parts, empty parts from the next."""
    x = mixed(g ^ np.uint64(0x5851F42D4C957F2D))
    part = (x >> np.uint64(56)).astype(np.int64)
    least = np.full(BITS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, part, x & np.uint64((1 << 56) - 1))
    there = np.flatnonzero(least != np.iinfo(np.uint64).max)
    nearest = there[np.searchsorted(there, np.arange(BITS)) % len(there)]
    away = ((nearest - np.arange(BITS)) % BITS).astype(np.uint64)
    bit = (mixed(least[nearest] + away) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bit).view("<i8")


def banded_matches(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose pairs lie within `band` of the diagonal; bits of one number per row."""
    short = min(len(a), len(b))
    same = a[:short] != b[:short]
    head = int(np.argmax(same)) if same.any() else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    same = a[::-1][:short] != b[::-1][:short]
    tail = int(np.argmax(same)) if same.any() else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, wide = full, (1 << 2 * band + 1) - 1
    for j, y in enumerate(b.tolist()):
        m = masks.get(y)
        if m is not None and (m := m & (wide << j - band if j >= band else wide >> band - j)):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return head + tail + len(a) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers; 0 where it can't reach `least`."""
    n = len(a) + len(b)
    need = int(np.ceil(least * n / (1 + least) - 1e-9))
    if min(len(a), len(b)) < need or len(np.intersect1d(a, b)) < need:  # k-mers are labelled, so each side has no repeats
        return 0.0
    both = banded_matches(a, b, max(len(a), len(b)) - need)
    return both / (n - both) if both >= need else 0.0


ROW = "copy binary, n int, b0 long, b1 long, b2 long, b3 long, keys array<long>"


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, row (digest of the text), copy (digest of the words), n (k-mers), b0..b3 (one-bit min-hashes), keys (the sketches)."""
    ship(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, sizes, bits, keys = [], [], [], []
            for text in batch.column(2).to_pylist():
                found = words(text)
                copies.append(hashlib.blake2b(b" ".join(found) if found else b"\0" + (text or "").encode("utf-8", "replace"), digest_size=16).digest())
                g = kmers(found)
                sizes.append(len(g))
                bits.append(one_bit(g).tolist() if found else [0] * 4)
                keys.append(order_sketches(g).view(np.int64).tolist() if found else [])
            b = [*zip(*bits, strict=True)] if bits else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(copies, pa.binary()), pa.array(sizes, pa.int32()), *(pa.array(x, pa.int64()) for x in b), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "row", *(x.split()[0] for x in ROW.split(", "))],
            )

    return docs.select("doc_id", "row", "text").mapInArrow(step, f"doc_id long, row binary, {ROW}")


def text_key(text: Column) -> Column:
    """Digest of a text as it stands; with the id it names a row, but for repeated ones."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def may_reach(left: str, right: str, least: float = SIMILARITY) -> Column:
    """Neither the lengths nor, within five standard deviations, the one-bit min-hashes of two texts exclude the threshold."""
    differ = " + ".join(f"bit_count({left}.b{j} ^ {right}.b{j})" for j in range(4))
    small, large = f"least({left}.n, {right}.n)", f"greatest({left}.n, {right}.n)"
    half = (1 - least) / 2
    spread = f"sqrt({BITS * half * (1 - half)} + {(BITS / 2) ** 2 * least * (1 - least)} / least({small}, {BITS}))"
    return F.expr(f"{small} >= {least} * {large} - 1e-9 and {differ} <= {BITS * half} + 5 * {spread}")


def shingle_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, g): the k-mers as 64-bit numbers of the texts that are wanted (node, doc_id, row).

    Repeated rows are taken together before the one exchange of texts, which the join then shares.
    """
    ship(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = [kmers(words(t)).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(g, pa.binary())], ["node", "g"])

    keyed = docs.withColumn("_id", F.coalesce("doc_id", F.lit(0))).groupBy("_id", "row").agg(F.first("text").alias("text"))
    found = keyed.join(wanted.select("node", F.coalesce("doc_id", F.lit(0)).alias("_id"), "row"), ["_id", "row"])
    # an id that is null and one that is 0 may share a text; they are one copy then, and only one of them is wanted
    return found.select("node", "text").mapInArrow(step, "node long, g binary")


def verified(pairs: DataFrame, shingles: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose alignment reaches the threshold."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similarity(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), least) >= least - 1e-9
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (shingles.select(F.col("node").alias(c), F.col("g").alias(f"g{c}")) for c in "ab")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ga", "gb").mapInArrow(step, "a long, b long")


def finer(shingles: DataFrame) -> DataFrame:
    """(node, key): FINER more sketches of FINER_PICKED k-mers each."""
    ship(shingles.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [order_sketches(np.frombuffer(g, "<u8"), _FINER_ODD, FINER_PICKED).view(np.int64).tolist() for g in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    return shingles.select("node", "g").mapInArrow(step, "node long, keys array<long>").select("node", F.explode("keys").alias("key"))


def joining_links(ids: np.ndarray, roots: np.ndarray, texts: list[np.ndarray], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links between texts of different components, enough to join all that links among these texts join."""
    size = np.array([len(g) for g in texts])
    values, column, seen = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(texts)), size)
    kept = seen[column] > 1
    place = np.cumsum(seen > 1) - 1
    row, column = row[kept], place[column[kept]]
    both = np.zeros((len(texts), len(texts)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int((seen > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        some = np.zeros((len(texts), COLUMNS), np.float32)
        some[row[a:b], column[a:b] - first] = 1
        both += some @ some.T
    need = np.ceil(least * (size[:, None] + size[None, :]) / (1 + least) - 1e-6)
    x, y = np.nonzero(np.triu((both >= need) & (roots[:, None] != roots[None, :]), 1))
    parent = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    links = []
    for i in np.argsort(-both[x, y] / need[x, y], kind="stable").tolist():
        a, b = x[i], y[i]
        p, q = top(int(roots[a])), top(int(roots[b]))
        if p != q and similarity(texts[a], texts[b], least) >= least - 1e-9:
            parent[p] = q
            links.append((int(ids[a]), int(ids[b])))
    return links


def by_main_component(open_: DataFrame) -> DataFrame:
    """(key, node, root, n, many): the texts of all open buckets whose largest component is `key`, each once; many: whether
    more than STRAGGLERS of them are outside it. open_: key, node, root, n."""
    counts = open_.groupBy("key", "root").count()
    main = counts.groupBy("key").agg(F.max(F.struct("count", "root")).alias("m")).select("key", F.col("m.root").alias("main"))
    texts = open_.join(main, "key").select(F.col("main").alias("key"), "node", "root", "n").distinct()
    sizes = texts.groupBy("key").agg((F.count_if(F.col("root") != F.col("key")) > STRAGGLERS).alias("many"))
    return texts.join(sizes, "key")


def straggler_links(members: DataFrame, shingles: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b): links that join components within groups of texts. members: key (the largest component), node, root, n.

    That component is cut into blocks, one block for each of its texts; only the texts outside it, the stragglers, are laid
    beside every block, and beside each other. A block has about BLOCK texts and BLOCK_KMERS k-mers.
    """
    astray = F.col("root") != F.col("key")

    def blocks(of: Column) -> Column:
        return F.ceil(F.greatest(F.count_if(of) / BLOCK, F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0)) / BLOCK_KMERS, F.lit(1))).cast("int")

    sizes = members.groupBy("key").agg(blocks(~astray).alias("mains"), blocks(astray).alias("chunks"))
    dealt = members.join(sizes, "key").withColumn("straggles", astray)
    own = F.pmod(F.xxhash64("node", "key"), F.when(F.col("straggles"), F.col("chunks")).otherwise(F.col("mains"))).cast("int")
    dealt = dealt.withColumn("own", own)
    # chunk x block of the largest component (numbered from 0), and chunk x chunk (numbered below 0)
    beside = F.when(F.col("straggles"), F.concat(
        F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda b: F.struct(F.col("own").alias("low"), b.alias("high"))),
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda b: F.struct(F.least("own", b).alias("low"), (-1 - F.greatest("own", b)).alias("high"))),
    )).otherwise(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda b: F.struct(b.alias("low"), F.col("own").alias("high"))))
    dealt = dealt.select("key", "node", "root", F.inline(beside)).join(shingles, "node")

    def step(group: pa.Table) -> pa.Table:
        texts = [np.frombuffer(g, "<u8") for g in group.column("g").to_pylist()]
        links = joining_links(group.column("node").to_numpy(), group.column("root").to_numpy(), texts, least)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("key", "low", "high").applyInArrow(step, "a long, b long")


class Search:
    """Links between texts found so far, and the tables that later rounds read."""

    def __init__(self, scratch: Scratch, facts: DataFrame, shingles: DataFrame | None, least: float):
        self.scratch, self.facts, self.shingles, self.least = scratch, facts, shingles, least
        self.links: list[DataFrame] = []
        self.roots: DataFrame | None = None
        self.opened: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        self.links.append(self.scratch.stored(links))

    def join_up(self) -> None:
        """Components of all links so far; those found before stand for the links they came from."""
        flat = stars(reduce(DataFrame.unionByName, self.links))
        self.scratch.drop(*self.links)
        self.links, self.roots = [flat], rooted(flat)

    def placed(self) -> DataFrame:
        facts = self.facts
        return facts.join(self.roots.withColumnRenamed("node", "_node"), facts["node"] == F.col("_node"), "left").select(facts["*"], F.coalesce("root", "node").alias("root"))

    def candidates(self, pairs: DataFrame) -> DataFrame:
        l, r = self.facts.alias("l"), self.facts.alias("r")
        return pairs.join(l, F.col("a") == F.col("l.node")).join(r, F.col("b") == F.col("r.node")).filter(may_reach("l", "r", self.least)).select("a", "b")

    def open_buckets(self, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of buckets whose texts are in several components: of at most SMALL texts, and of more."""
        scratch, inside = self.scratch, members.select("key", "node").join(self.placed(), "node")
        several = scratch.stored(inside.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("size")).filter("r0 < r1").select("key", "size"))
        open_ = scratch.stored(inside.join(several, "key"))
        scratch.drop(several)
        self.opened = open_
        return open_.filter(F.col("size") <= SMALL), open_.filter(F.col("size") > SMALL)

    def pairs_within(self, small: DataFrame, but: DataFrame) -> None:
        """Tests the pairs of different components in buckets of at most SMALL texts; `but`: pairs tested already."""
        l, r = small.alias("l"), small.alias("r")
        rest = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.node") < F.col("r.node")) & (F.col("l.root") != F.col("r.root")) & may_reach("l", "r", self.least))
        rest = rest.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct().join(but, ["a", "b"], "left_anti")
        self.add(verified(rest, self.shingles, self.least))


def bucket_members(scratch: Scratch, buckets: DataFrame) -> DataFrame:
    """(key, lead, node) of buckets with two texts or more. buckets: key, node.

    Keys are written before they are joined: a join of two plain tables is one that Spark may split at a hot key.
    """
    shared = scratch.stored(buckets.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("size")).filter("size > 1").select("key", "lead"))
    members = scratch.stored(buckets.join(shared, "key").select("key", "lead", "node"))
    scratch.drop(shared)
    return members


def classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Rows and texts. docs: doc_id (long), row (text_key of the text), text.

    Rows: (doc_id, row, copy) of every row. Texts: (copy, root, gone, doc_id, row), one for each group of copies: the
    component it is in and its least row, `gone` if that has no id.
    """
    scratch = Scratch(docs.sparkSession)
    known = scratch.stored(sketched(docs))
    # one text for each group of copies; what hangs on the words is the same in all of them
    same = ["n", "b0", "b1", "b2", "b3", "keys"]
    texts = known.groupBy("copy").agg(F.min(F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "row")).alias("rep"), *(F.first(x).alias(x) for x in same))
    texts = scratch.stored(texts.select(F.monotonically_increasing_id().alias("node"), "copy", "rep.*", *same))
    buckets = texts.select("node", F.posexplode("keys").alias("sketch", "key")).select("node", F.xxhash64("sketch", "key").alias("key"))
    members = bucket_members(scratch, buckets)
    wanted = members.select("node").distinct()
    facts = scratch.stored(texts.select("node", "doc_id", "row", *same[:-1]).join(wanted, "node"))
    shingles = scratch.stored(shingle_rows(docs, facts.select("node", "doc_id", "row")))
    search = Search(scratch, facts.drop("doc_id", "row"), shingles, least)
    links = scratch.stored(search.candidates(members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()))
    search.add(verified(links, shingles, least))
    search.join_up()
    small, large = search.open_buckets(members)
    scratch.drop(members)
    search.pairs_within(small, links)
    groups = scratch.stored(by_main_component(large))
    scratch.drop(search.opened)
    if not groups.isEmpty():
        search.add(straggler_links(groups.filter("not many"), shingles, least))
    odd = scratch.stored(groups.filter("many").select("node").distinct())
    if not odd.isEmpty():
        # groups with many stragglers give way to finer buckets of fresh sketches
        few = scratch.stored(shingles.join(odd, "node"))
        search.shingles = few
        members = bucket_members(scratch, finer(few))
        small, large = search.open_buckets(members)
        scratch.drop(members)
        search.pairs_within(small, links)
        search.add(straggler_links(by_main_component(large), few, least))
        scratch.drop(few, search.opened)
    scratch.drop(groups, odd)
    scratch.drop(links)
    search.join_up()
    named = texts.join(search.roots.withColumnRenamed("node", "_node"), texts["node"] == F.col("_node"), "left").select("copy", F.coalesce("root", "node").alias("root"), "gone", "doc_id", "row")
    named = scratch.stored(named)
    scratch.drop(shingles, facts, texts)
    return known.select("doc_id", "row", "copy"), named


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].cast("long").alias("doc_id"), text_key(docs[text]).alias("row"), docs[text].alias("text"))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id): for every id its class, named by its least id."""
    rows, texts = classes(keyed(docs, key, text), least)
    names = texts.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = texts.select("copy", "root").join(names, "root").select("copy", "class_id")
    return rows.filter("doc_id is not null").join(named, "copy").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each class: the one of least id (rows without one last), of equal ids by a digest of the text.

    Whole rows are exchanged once: repeated ones are taken together on the way, and the join shares the exchange.
    """
    _, texts = classes(keyed(docs, key, text), least)
    kept = texts.groupBy("root").agg(F.min(F.struct("gone", "doc_id", "row")).alias("k")).select(F.col("k.gone").alias("_gone"), F.coalesce("k.doc_id", F.lit(0)).alias("_id"), F.col("k.row").alias("_row"))
    id_ = docs[key].cast("long")
    rows = docs.select("*", id_.isNull().alias("_gone"), F.coalesce(id_, F.lit(0)).alias("_id"), text_key(docs[text]).alias("_row"))
    return rows.dropDuplicates(["_gone", "_id", "_row"]).join(kept, ["_gone", "_id", "_row"]).select(*docs.columns)


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
