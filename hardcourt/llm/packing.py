"""Packing of token sequences as vector bin packing with the dot-product heuristic.

Every example asks for a vector (tokens, segments, loss-bearing tokens); a sequence offers CAPACITY, MAX_SEGMENTS and
MAX_LOSS of them. One sequence is filled at a time: of the examples waiting, the one whose vector has the largest dot
product with what the sequence has left (both as shares of the limits) is placed whole; when none fits whole, the
largest is cut so that it fills the rest. Examples longer than a sequence give up whole sequences first. When limits
other than tokens, or the end of a partition, leave a sequence short, its pieces are laid into sequences whose lengths
are powers of two, which need no padding.

Each partition packs its own rows as they come, with at most WAITING examples in memory; nothing is shuffled, and a lost
partition is packed again from its own input, alike. A sequence's number holds the partition's number in its upper bits.

Instruction data bears loss on some of its ids only, and MAX_LOSS binds; of whole documents every id bears loss, their
vectors are (n, 1, n), and they are packed with a loss limit of CAPACITY, so that the heuristic takes the longest that fits.

A null text counts as empty; with the end-of-document id every example has at least one id. Repeated rows are packed
each; an empty table gives no rows; other columns are not read. Texts of any length are packed whole. Of examples with
equal products the one in the lowest slot is placed first.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import set_apart, ship, table

CAPACITY, MAX_SEGMENTS, MAX_LOSS = 1024, 64, 640
#: Turns of a conversation in one example.
RUN = 1024
END = 0
WAITING = 512
CACHE, LONGEST = 1 << 18, 64

#: Fixed value: how a byte-level vocabulary of this family cuts a text into pre-tokens.
PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BREAK = re.compile(r"\s \s|\s \Z")
_ODD_SPACES = ("\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f", "  ", " \n", "\n ", "\0")
_ids: dict = {}


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as they are, the rest from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class Ids(dict):
    """Word to its ids (little-endian 32-bit): the newest CACHE words per worker and those seen among the CACHE before.

    A space before a word is always the start of a pre-token when the character before it is no white space or the one
    after it is none, so texts are looked up word by word; others, and those that spell a special token, go whole. A word
    of Latin letters is one pre-token, for which the tokenizer's model alone is asked.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.letters, self.older = self.tokenizer.model, _byte_letters(), {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _fresh(self, word: str) -> bytes:
        body = word[1:] if word[:1] == " " else word
        if body.isalpha() and (body.isascii() or max(body) < "\u0250"):
            spelt = word.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if body[-1:] in (".", ",") and body[:-1].isalpha():
            return self[word[:-1]] + self[body[-1]]
        left, line, right = word.partition("\n")  # a single line end between others is a pre-token
        if line and left and right and not left[-1].isspace() and not right[0].isspace():
            return self[left] + self[line] + self[right]
        pieces = PRETOKENS.findall(word)
        return b"".join([self[p] for p in pieces]) if len(pieces) > 1 else self.whole(word)

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._fresh(word)
        if len(word) <= LONGEST and ("\n" not in word or len(word) == 1):
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        if text[-1] == " " or not text.isascii() or any(s in text for s in _ODD_SPACES):
            if _BREAK.search(text):
                return self.whole(text)
            first, *rest = text.split(" ")
            words = [first, *(f" {w}" for w in rest)]
        else:
            words = text.replace(" ", "\0 ").split("\0")
        return b"".join(map(self.__getitem__, words if words[0] else words[1:]))


def ids_of(path: str) -> Ids:
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


class Packer:
    """Fills sequences from examples; emit(piece, sequence, offset) gets each piece once."""

    def __init__(self, first: int, emit, capacity=CAPACITY, segments=MAX_SEGMENTS, loss=MAX_LOSS, waiting=WAITING):
        self.limits, self.waiting, self.emit, self.number = np.array([capacity, segments, loss], np.float64), waiting, emit, first
        self.asks = np.zeros((waiting, 3), np.float64)
        self.held: list = [None] * waiting
        self.free = [*range(waiting)]

    def add(self, example: tuple, ids: np.ndarray, bears: np.ndarray | None) -> None:
        """bears: which ids bear loss; None: all."""
        at, room = 0, int(min(self.limits[0], self.limits[2] if bears is None else self.limits[0]))
        while len(ids) - at >= room:
            n = self._fitting(bears, at, room)
            if n < self.limits[0] and n & (n - 1):
                n = 1 << (n.bit_length() - 1)
            self._put([(example, ids, at, n)])
            at += n
        if at < len(ids):
            if not self.free:
                self._fill()
            self._hold(example, ids, bears, at)

    def _fitting(self, bears, at: int, most: int) -> int:
        """How many ids from `at` on stay within the loss limit and `most`."""
        if bears is None:
            return most
        return max(1, int(np.searchsorted(np.cumsum(bears[at : at + most]), self.limits[2], side="right")))

    def _hold(self, example, ids, bears, at: int) -> None:
        slot = self.free.pop()
        self.held[slot] = (example, ids, bears, at)
        self.asks[slot] = (len(ids) - at, 1, len(ids) - at if bears is None else bears[at:].sum())

    def _take(self, slot: int):
        self.asks[slot] = 0
        self.free.append(slot)
        return self.held[slot]

    def _fill(self) -> None:
        """One sequence from the waiting examples."""
        pieces, left = [], self.limits.copy()
        while left[0] >= 1 and left[1] >= 1:
            there = self.asks[:, 0] > 0
            fits = there & (self.asks <= left).all(axis=1)
            if fits.any():
                score = (self.asks / self.limits) @ (left / self.limits)
                slot = int(np.argmax(np.where(fits, score, -1.0)))
                ask = self.asks[slot].copy()
                example, ids, _, at = self._take(slot)
                pieces.append((example, ids, at, len(ids) - at))
            elif there.any():
                slot = int(np.argmax(np.where(there, self.asks[:, 0], 0)))
                example, ids, bears, at = self.held[slot]
                most = int(min(left[0], left[2] if bears is None else left[0], len(ids) - at))
                n = most if bears is None or most < 1 else int(np.searchsorted(np.cumsum(bears[at : at + most]), left[2], side="right"))
                if n < 1:
                    break
                self._take(slot)
                pieces.append((example, ids, at, n))
                ask = np.array([n, 1, n if bears is None else bears[at : at + n].sum()], np.float64)
                if at + n < len(ids):
                    self._hold(example, ids, bears, at + n)
            else:
                break
            left -= ask
        self._lay(pieces)

    def _lay(self, pieces: list) -> None:
        """Short sequences are split at powers of two, largest first."""
        total = sum(p[3] for p in pieces)
        if total == self.limits[0] or not total & (total - 1):
            self._put(pieces)
            return
        queue = pieces[::-1]
        while total:
            size = 1 << (total.bit_length() - 1)
            total, now = total - size, []
            while size:
                example, ids, at, n = queue.pop()
                if n > size:
                    queue.append((example, ids, at + size, n - size))
                    n = size
                now.append((example, ids, at, n))
                size -= n
            self._put(now)

    def _put(self, pieces: list) -> None:
        offset = 0
        for example, ids, at, n in pieces:
            self.emit(example, ids, at, n, self.number, offset)
            offset += n
        self.number += bool(pieces)

    def finish(self) -> None:
        while len(self.free) < self.waiting:
            self._fill()


OUT = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def packed(examples: DataFrame, path: str, key: str = "doc_id", capacity: int = CAPACITY, segments: int = MAX_SEGMENTS, loss: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of examples: (key, parts), parts an array of (text, loss): the texts joined are the example.

    path: a tokenizers file. The end-of-document id bears loss if the last part does.
    """
    ship(examples.sparkSession)
    kind = examples.schema[key].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = ids_of(path)
        out: list[tuple] = []

        def emit(example, ids, at, n, number, offset):
            who, bears = example
            out.append((who, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids), number, offset, n if bears is None else int(bears[at : at + n].sum())))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [*zip(*rows, strict=True)] if rows else [[]] * 8
            return pa.RecordBatch.from_arrays([pa.array(columns[0], source), *(pa.array(c, pa.int64()) for c in columns[1:])], names)

        names, source = [key, *(x.split()[0] for x in OUT.split(", "))], None
        packer = Packer(TaskContext.get().partitionId() << 32, emit, capacity, segments, loss)
        for batch in batches:
            source = source or batch.schema.field(0).type
            for who, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [p for p in parts or [] if p is not None]
                each = [np.frombuffer(codes.of(p["text"] or ""), "<u4") for p in parts]
                ids = np.concatenate([*each, np.array([END], "<u4")])
                bears = None
                if not all(p["loss"] for p in parts):
                    bears = np.repeat([bool(p["loss"]) for p in parts] + [bool(parts[-1]["loss"])], [*map(len, each), 1])
                packer.add((who, bears), ids, bears)
                if len(out) > 20_000:
                    yield batch_of(out)
                    out.clear()
        packer.finish()
        if out:
            yield batch_of(out)

    return examples.select(key, "parts").mapInArrow(step, f"{key} {kind}, {OUT}")


def whole_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document as an example of one part, all of it bearing loss."""
    return docs.select(key, F.array(F.struct(F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(True).alias("loss"))).alias("parts"))


def conversations(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """Each conversation as an example, its turns in order (at equal turn by role and text); one role's text bears loss.

    Conversations are cut every RUN turns, so that none is gathered beyond that; a run is an example of its own. So is every
    turn without a conversation. Turns without a number come first; null texts count as empty, repeated turns are repeated.
    """
    turns = set_apart(turns, ("conv_id", "turn", "role", "text"))[0]
    loss = F.coalesce(F.col("role") == learn, F.lit(False)).alias("loss")
    said = F.coalesce("text", F.lit("")).alias("text")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", said, loss)))
    parts = F.transform(ordered, lambda t: F.struct(t["text"].alias("text"), t["loss"].alias("loss")))
    whole = turns.filter("conv_id is not null").withColumn("_run", F.floor(F.coalesce("turn", F.lit(0)) / RUN)).groupBy("conv_id", "_run").agg(parts.alias("parts")).select("conv_id", "parts")
    return whole.unionByName(turns.filter("conv_id is null").select("conv_id", F.array(F.struct(said, loss)).alias("parts")))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(whole_documents(table(spark, sf_dir, "documents")), tokenizer_path())


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data: what the assistant says bears loss, and all three limits bind."""
    return packed(conversations(table(spark, sf_dir, "conversations")), tokenizer_path(), key="conv_id", loss=MAX_LOSS)
