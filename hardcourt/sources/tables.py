"""Scans and sinks of tables and raw files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the raw play-by-play file, all read as texts.
RAW_COLUMNS = (
    "GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "EVENTMSGACTIONTYPE", "PERIOD", "PCTIMESTRING", "HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION", "SCORE",
    "PERSON1TYPE", "PLAYER1_ID", "PLAYER1_NAME", "PLAYER1_TEAM_ID", "PLAYER1_TEAM_ABBREVIATION", "PERSON2TYPE", "PLAYER2_ID", "PLAYER2_NAME", "PLAYER2_TEAM_ID",
    "PERSON3TYPE", "PLAYER3_ID", "PLAYER3_NAME", "PLAYER3_TEAM_ID",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_play_by_play(spark: SparkSession, path: str, columns: tuple[str, ...] = RAW_COLUMNS) -> DataFrame:
    """A season's raw rows; order is EVENTNUM within GAME_ID, never the file's."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


BROKEN = "_broken"


def read_checked(spark: SparkSession, path: str, columns: tuple[str, ...] = RAW_COLUMNS, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A season's raw rows, and rows of the error sink for lines that can't be used: cut or overlong ones, broken quotes, no
    game, an event number that is no whole number. Each error holds the whole line and its file."""
    schema = ", ".join(f"{n} string" for n in (*columns, BROKEN))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    if header:
        lines = lines.filter(F.trim("value") != ",".join(columns))
    parsed = F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    lines = lines.select("value", "file", parsed.alias("_r")).select("value", "file", "_r.*")
    reason = F.when(F.col(BROKEN).isNotNull(), "malformed line").when(F.coalesce(F.trim("GAME_ID"), F.lit("")) == "", "no game").when(F.col("EVENTNUM").try_cast("long").isNull(), "no event number")
    told = lines.withColumn("_reason", reason)
    bad = told.filter(F.col("_reason").isNotNull()).withColumnRenamed("value", "line")
    return told.filter(F.col("_reason").isNull()).select(*columns), error_rows(bad, "scan", F.col("_reason"), ["file", "line"])


def append(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append load of the stated columns, nulls kept."""
    df.select(*columns).write.mode("append").parquet(path)


def error_rows(df: DataFrame, phase: str, message: str | Column, detail: list[str]) -> DataFrame:
    """The error sink's rows: phase, message and the detail as JSON."""
    return df.select(F.lit(phase).alias("phase"), (F.lit(message) if isinstance(message, str) else message).alias("message"), F.to_json(F.struct(*detail), {"ignoreNullFields": "false"}).alias("detail"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. Only a local session, whose one machine is all there is,
    gets a temporary one where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read again: for what several joins read, safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
