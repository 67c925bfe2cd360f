"""Quality scores by co-training: a view of the text and a view of the page's metadata teach each other.

Two questions are asked of each document, whether its quality is high and whether it is toxic. For each, one classifier
sees the words and the shape of the text, another only language, source and length. Both start from labelled documents;
in every round each is calibrated on labelled documents held out, and hands those of the unlabelled documents it is
surest of, at a confidence that kept PRECISION there, to the other as pseudo-labels. At the end the two calibrated views
are combined and every document is scored.

Fitting uses at most FIT_ROWS labelled documents (about: all of them where there are fewer, else a share by a hash of id
and text) and a pool of at most FIT_ROWS unlabelled ones, picked apart so that neither crowds out the other. Their
features go to the driver; rows that repeat id and text count once there. The models are small and of fixed size, and
are broadcast. Scoring is one map-side pass over all texts.

Nulls: a text counts as empty, language and source as a value of their own, length as 0; labels with a null are unknown.
An id labelled more than once takes the worse label. Repeated rows are scored each; an empty table gives no rows; without
labels of both classes a question is answered with the base rate. Further columns are not read. Texts of any length are
read whole. Ties: of equally sure documents the lesser id and hash is handed on first; a probability of 0.5 keeps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardcourt.llm.runtime import ship, table
from hardcourt.llm.words import words

FIT_ROWS, PART = 24_000, 2048
ROUNDS, HANDED, PRECISION = 3, 500, 0.97
WORDS, SHAPES, SOURCES = 1 << 18, 64, 1 << 12
CHOSEN, SURE = 128, 4.0
RIDGE = 1.0


def _bin(x: float) -> int:
    """0..7, finer towards 0."""
    return int(min(7, max(0, np.floor(8 * np.sqrt(max(0.0, min(1.0, x)))))))


_UPPER, _MARKS = bytes(range(65, 91)), bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-")


def text_features(text: str | None) -> np.ndarray:
    """Which words occur (hashed), and six ratios of the text's shape in eight bins each."""
    data = (text or "").encode("utf-8", "replace")
    found = words(text)
    kinds = {*found}
    n, size = max(1, len(found)), max(1, len(data))
    ratios = (
        (len(data) - len(data.translate(None, _UPPER))) / size,
        (len(data) - len(data.translate(None, _MARKS))) / size * 4,
        1 - len(kinds) / n,
        sum(a == b for a, b in zip(found, found[1:], strict=False)) / n,
        min(1.0, data.count(b"\n") / n * 4),
        min(1.0, sum(map(len, found)) / n / 24),
    )
    shape = [WORDS + 8 * k + _bin(r) for k, r in enumerate(ratios)]
    return np.unique(np.fromiter((zlib.crc32(w) % WORDS for w in kinds), np.uint32, len(kinds))).tolist() + shape


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    size = int(max(0, n_chars or 0)).bit_length()
    return [zlib.crc32(f"{k}={v}".encode("utf-8", "replace")) % SOURCES for k, v in (("lang", lang), ("source", source), ("size", size), ("lang size", (lang, size)))]


class View:
    """Logistic regression on the features of one view that tell the classes apart in its labelled rows."""

    def __init__(self, rows: list[np.ndarray], size: int, keep: range):
        self.size, self.keep = size, keep
        self.ids = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
        self.ends = np.cumsum([0, *map(len, rows)])
        self.n = len(rows)

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Features and the row of each, PART rows at a time: the driver never holds indexes of all at once."""
        for a in range(0, self.n, PART):
            b = min(self.n, a + PART)
            yield self.ids[self.ends[a] : self.ends[b]], np.repeat(np.arange(a, b), np.diff(self.ends[a : b + 1]))

    def fit(self, y: np.ndarray, used: np.ndarray) -> None:
        """y: labels; used: which rows have one."""
        seen, ones = np.zeros(self.size), np.zeros(self.size)
        for ids, row in self.parts():
            of = used[row]
            seen += np.bincount(ids[of], minlength=self.size)
            ones += np.bincount(ids[of], weights=y[row[of]].astype(float), minlength=self.size)
        base = y[used].mean()
        z = np.abs(ones - seen * base) / np.sqrt(np.maximum(1e-9, seen * base * (1 - base)))
        z[seen < 5] = 0
        z[self.keep.start : self.keep.stop] = np.where(seen[self.keep.start : self.keep.stop] >= 5, 1e9, 0)
        best = np.argsort(-z, kind="stable")[: CHOSEN + len(self.keep)]
        best = best[z[best] >= SURE]
        place = np.full(self.size, -1)
        place[best] = np.arange(len(best))
        x = np.zeros((self.n, len(best) + 1))
        for ids, row in self.parts():
            there = place[ids] >= 0
            x[row[there], place[ids[there]]] = 1
        x[:, -1] = 1
        w = newton(x[used], y[used].astype(float))
        self.logit = x @ w
        self.weights = np.zeros(self.size)
        self.weights[best], self.bias = w[:-1], float(w[-1])


def newton(x: np.ndarray, y: np.ndarray, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression; the last column, the constant, is not shrunk."""
    w, ridge = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, RIDGE), 1e-6)
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge) + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrated(logit: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Platt scaling fitted where `at`: logits for all rows, slope, offset."""
    w = newton(np.stack([logit[at], np.ones(at.sum())], axis=1), y[at].astype(float))
    return logit * w[0] + w[1], float(w[0]), float(w[1])


def surest(logit: np.ndarray, y: np.ndarray, held: np.ndarray, pool: np.ndarray, one: bool) -> np.ndarray:
    """Up to HANDED rows of the pool beyond the confidence that kept PRECISION on the rows held out."""
    sign = 1 if one else -1
    order = np.argsort(-sign * logit[held], kind="stable")
    right = np.cumsum(y[held][order] == one) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero((right >= PRECISION) & (np.arange(len(order)) >= 19))
    if not len(fine):
        return np.zeros(0, np.int64)
    limit = (sign * logit[held][order])[fine[-1]]
    there = np.flatnonzero(pool & (sign * logit >= max(limit, 0)))
    return there[np.argsort(-sign * logit[there], kind="stable")[:HANDED]]


def cotrained(text: list, meta: list, y: np.ndarray, held: np.ndarray) -> dict:
    """The model of one question. y: 1, 0 or -1 for unknown; held: rows to calibrate on, if labelled."""
    known = y >= 0
    train, check = known & ~held, known & held
    rate = float((y[known].sum() + 1) / (known.sum() + 2)) if known.any() else None
    if min((y[train] == 1).sum(), (y[train] == 0).sum(), (y[check] == 1).sum(), (y[check] == 0).sum()) < 5:
        return {"rate": rate}
    views = [View(text, WORDS + SHAPES, range(WORDS, WORDS + SHAPES)), View(meta, SOURCES, range(0))]
    labels, used = [y.copy() for _ in views], [train.copy() for _ in views]
    for turn in range(ROUNDS + 1):
        for view, label, use in zip(views, labels, used, strict=True):
            view.fit(label, use)
        logits = [calibrated(view.logit, y, check) for view in views]
        if turn < ROUNDS:
            for k, (logit, _, _) in enumerate(logits):
                other = 1 - k
                for one in (True, False):
                    rows = surest(logit, y, check, ~known & ~used[other], one)
                    labels[other][rows], used[other][rows] = int(one), True
    mix = newton(np.stack([logits[0][0][check], logits[1][0][check], np.ones(check.sum())], axis=1), y[check].astype(float))
    chosen = np.flatnonzero(views[0].weights)
    some = np.flatnonzero(views[1].weights)
    return {
        "text": (chosen, views[0].weights[chosen] * logits[0][1] * mix[0]),
        "meta": (some, views[1].weights[some] * logits[1][1] * mix[1]),
        "bias": (views[0].bias * logits[0][1] + logits[0][2]) * mix[0] + (views[1].bias * logits[1][1] + logits[1][2]) * mix[1] + mix[2],
    }


COLUMNS = ("text", "lang", "source", "n_chars")
PLACES = 1 << 40


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> dict[str, dict]:
    """Models for `quality` and `toxic` from bounded samples of the labelled and the unlabelled docs."""
    worse = labels.filter("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    n, known = docs.count(), docs.select("doc_id").join(worse, "doc_id", "left_semi").count()
    labelled, pool = (int(PLACES * min(1.0, rows / k)) if k else 0 for k in (known, n - known))
    key = F.xxhash64("doc_id", "text")
    place = F.pmod(F.col("key"), F.lit(PLACES))
    found = docs.select("doc_id", key.alias("key")).filter(place < max(labelled, pool)).join(worse.withColumn("known", F.lit(True)), "doc_id", "left")
    marks = found.filter(place < F.when(F.col("known"), labelled).otherwise(pool)).select(F.col("doc_id").alias("id"), F.col("key").alias("mark"), "quality", "toxic").dropDuplicates(["id", "mark"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, sources, sizes = (batch.column(k).to_pylist() for k in range(4))
            words_ = [np.asarray(text_features(t), "<u4").tobytes() for t in texts]
            metas = [np.asarray(meta_features(*m), "<u4").tobytes() for m in zip(langs, sources, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4, 8)), pa.array(words_, pa.binary()), pa.array(metas, pa.binary())], ["doc_id", "quality", "toxic", "key", "words", "meta"])

    # the marks are about 2 * rows at most, so they may be broadcast
    sample = docs.select("doc_id", *COLUMNS, key.alias("key")).join(F.broadcast(marks), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("mark"))).select(*COLUMNS, F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic", "key")
    got = sample.mapInArrow(step, "doc_id long, quality int, toxic int, key long, words binary, meta binary").dropDuplicates(["doc_id", "key"]).toArrow().to_pydict()
    order = np.lexsort((np.array(got["key"], np.int64), np.array([-1 if i is None else i for i in got["doc_id"]], np.int64)))
    text, meta = ([np.frombuffer(got[c][i], "<u4") for i in order] for c in ("words", "meta"))
    held = np.array([zlib.crc32(got["words"][i]) % 10 < 3 for i in order], bool)
    return {c: cotrained(text, meta, np.array([-1 if got[c][i] is None else got[c][i] for i in order], np.int64), held) for c in ("quality", "toxic")}


def scored(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """All columns of docs, p_quality, p_toxic, score (that it is good and not toxic), keep."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fitted(docs, labels, rows))
    docs = docs.drop("p_quality", "p_toxic")
    names = docs.columns
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("p_quality", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {}
        for name, m in shared.value.items():
            if "text" in m:
                w, v = np.zeros(WORDS + SHAPES), np.zeros(SOURCES)
                w[m["text"][0]], v[m["meta"][0]] = m["text"][1], m["meta"][1]
                models[name] = (w, v, m["bias"])
        for batch in batches:
            texts, langs, sources, sizes = (batch.column(names.index(c)).to_pylist() for c in COLUMNS)
            out = {name: [] for name in ("quality", "toxic")}
            for text, *meta in zip(texts, langs, sources, sizes, strict=True):
                ids, facts = text_features(text), meta_features(*meta)
                for name in out:
                    if name in models:
                        w, v, bias = models[name]
                        out[name].append(float(1 / (1 + np.exp(-np.clip(w[ids].sum() + v[facts].sum() + bias, -30, 30)))))
                    else:
                        rate = shared.value[name]["rate"]
                        out[name].append(rate if rate is not None else float(name == "quality"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out["quality"], pa.float64()), pa.array(out["toxic"], pa.float64())], [*names, "p_quality", "p_toxic"])

    found = docs.mapInArrow(step, schema)
    return found.withColumn("score", F.col("p_quality") * (1 - F.col("p_toxic"))).withColumn("keep", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") <= 0.5))


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", *COLUMNS)
    return scored(docs, table(spark, sf_dir, "labels")).drop(*COLUMNS)
