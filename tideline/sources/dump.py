"""Snapshot dumps: the files of one consistent version, and the position at which the log goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dump(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, length, modified and content of the files of a dump, read in parallel."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), "content")


def one_version(rows: DataFrame, version: str) -> DataFrame:
    """rows, or an error when they come from more than one snapshot: a dump replaced while it was copied."""
    seen = rows.agg(F.count_distinct(version).alias("n"))  # one row
    wrong = F.raise_error(F.lit("files of more than one snapshot")).cast("boolean")
    return rows.join(F.broadcast(seen), F.when(F.col("n") > 1, wrong).otherwise(F.lit(True))).drop("n")


def end_position(info: DataFrame, text: str = "value") -> DataFrame:
    """filenum and offset from a dump's info file: its fourth and fifth lines."""
    lines = F.split(F.col(text), r"\r?\n")
    return info.select(F.trim(F.get(lines, 3)).try_cast("bigint").alias("filenum"), F.trim(F.get(lines, 4)).try_cast("decimal(20,0)").alias("offset"))
