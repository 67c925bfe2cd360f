"""Spark plumbing shared by the corpus operators: code on executors, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hardcourt.sources.tables import shared_folder

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def stored(df: DataFrame) -> DataFrame:
    """df written to a table in the shared folder and read again: computed once, lineage cut, safe from lost executors."""
    return Scratch(df.sparkSession).stored(df)


class Scratch:
    """Tables in the shared folder that one computation writes, and drops as soon as nothing needs them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self.spark)}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Only of tables whose every use has been written already."""
        for table_ in tables:
            if id(table_) in self.paths:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table_))[0])
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that a worker holds few texts as Python objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(value: str | None) -> str:
    """A null text counts as an empty one."""
    return value if value is not None else ""


def set_apart(df: DataFrame, wanted: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """df with its wanted columns under their names and every other under a neutral one, and the names it had.

    Works by place, so other columns may be called anything, also like a wanted one in other case.
    """
    names = df.columns
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    return df.toDF(*(c if c in wanted and c not in names[:k] else f"other_{k}" for k, c in enumerate(names))), names
