"""Token counts in one map-side pass over the texts, by two tiers of look-up.

The first tier is a compact table of frequent pre-tokens with their lengths in tokens, broadcast to every worker; the
second a cache in each Python worker, filled by encoding what the table lacks. No pre-token is shuffled: the frequent ones
are counted in a sample of about SAMPLE texts, picked by a hash of id and text. Each task hands the driver one summary of
its part of the sample, of at most SUMMARY words; the driver takes one summary at a time into a tally of at most four
times as many. Which words the table holds decides how fast a text is counted, never the count.

A pre-token is a word between single spaces. The tokenizer's vocabulary has no piece in which a space follows another
character, so no merge crosses that border and the counts of the words add up exactly. Texts in which spaces repeat,
lead, trail or are written as the tokenizer's own space mark are encoded whole.

A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; an empty table gives no rows; other
columns are not read. Texts of any length are counted whole. Of words equally frequent in the sample the lesser goes first.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import ship, stored, table

#: Texts sampled, entries of the broadcast table, of a task's summary and of a worker's cache; longest cached word.
SAMPLE, TABLE, SUMMARY, CACHE, LONGEST = 10_000, 1 << 16, 1 << 14, 1 << 18, 64
PLACES = 1 << 40
LIMIT = 4096
MARK = "▁"

_encoders: dict = {}


def encoder(path: str):
    if path not in _encoders:
        import sentencepiece

        _encoders[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _encoders[path]


def splits(text: str) -> bool:
    """Whether the words between spaces can be counted one by one."""
    return bool(text) and "  " not in text and text[0] != " " and text[-1] != " " and MARK not in text


class Lengths(dict):
    """The worker's second tier: lengths of words seen before, at most CACHE of them."""

    def __init__(self, encode, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encode, self.most = encode, len(frequent) + CACHE
        self.frequent = frequent

    def __missing__(self, word: str) -> int:
        n = len(self.encode(word))
        if len(word) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n


_tiers: dict[tuple, Lengths] = {}


def cut(seen: Counter, most: int) -> Counter:
    """The most frequent words, of equals the lesser ones."""
    return Counter(dict(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most]))


def frequent_words(rows: DataFrame, key: str) -> list[str]:
    """At most TABLE words of at most LONGEST characters that occur more than once in a sample of the texts."""
    n = rows.count()
    share = int(PLACES * min(1.0, SAMPLE / n)) if n else 0
    sample = rows.filter(F.pmod(F.xxhash64(key, "text"), F.lit(PLACES)) < share).select("text")

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if splits(text):
                    seen.update(w for w in text.split(" ") if len(w) <= LONGEST)
                if len(seen) > 8 * SUMMARY:
                    seen = cut(seen, 4 * SUMMARY)
        top = cut(seen, SUMMARY)
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([[*top]], pa.list_(pa.string())), pa.array([[*top.values()]], pa.list_(pa.int64()))], ["words", "counts"])

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for found, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tally.update(dict(zip(found, counts, strict=True)))
                if len(tally) > 8 * TABLE:
                    tally = cut(tally, 4 * TABLE)
        yield pa.RecordBatch.from_arrays([pa.array([[w for w, c in cut(tally, TABLE).items() if c > 1]], pa.list_(pa.string()))], ["words"])

    # all tasks summarise at once; one then reads what they have written, which the sample bounds
    summaries = stored(sample.mapInArrow(summary, "words array<string>, counts array<long>"))
    return [w for r in summaries.coalesce(1).mapInArrow(tallied, "words array<string>").collect() for w in r["words"]]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs; path: a sentencepiece model."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    top = frequent_words(rows, key)
    lengths = dict(zip(top, map(len, encoder(path).encode(top, num_threads=1)), strict=True)) if top else {}
    shared = spark.sparkContext.broadcast(lengths)
    name = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _tiers.get((path, name))
        if of is None:
            _tiers.clear()
            of = _tiers[(path, name)] = Lengths(encoder(path).encode, shared.value)
        get = of.__getitem__
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [sum(map(get, t.split(" "))) if splits(t) else len(of.encode(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.select(key, "text", F.octet_length("text").cast("long").alias("n_bytes")).mapInArrow(count, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
