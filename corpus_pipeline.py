"""The corpus pipeline: stages over documents, each on all that its predecessor kept.

Every stage but the last returns the columns of its input, in order; columns beyond those of `documents` pass through
whatever they are called. Nulls, repeated rows and empty tables are treated as the stages' operators say; rows that share
an id but not their text are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.cotraining import scored
from hardcourt.llm.decontaminate import contamination
from hardcourt.llm.order_minhash import one_of_each
from hardcourt.llm.packing import packed, tokenizer_path, whole_documents
from hardcourt.llm.pii import redacted, with_spans
from hardcourt.llm.runtime import set_apart, stored, table

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers call good and not toxic."""
    rows, names = set_apart(docs, DOCUMENT)
    return scored(rows, table(spark, sf_dir, "labels")).filter("keep").select(*rows.columns).toDF(*names)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the one of least id, else by a digest of the text. Rows count, not ids."""
    rows, names = set_apart(docs, DOCUMENT)
    return one_of_each(rows).toDF(*names)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    rows, names = set_apart(docs, DOCUMENT)
    return contamination(rows, table(spark, sf_dir, "benchmark")).filter("state is null").select(*rows.columns).toDF(*names)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars counted anew where that happened."""
    rows, names = set_apart(docs, DOCUMENT)
    found = with_spans(rows).withColumn("text", redacted(F.col("text"), F.col("spans")))
    changed = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(rows.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return changed.select(*rows.columns).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    rows, _ = set_apart(docs, ("doc_id", "text"))
    return packed(whole_documents(rows), tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("benchmark decontamination", keep_uncontaminated),
    ("personal data", redact),
    ("packing", pack),
]
#: Trained models and edit-sensitive sketches have no SQL form; the tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table of documents, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
