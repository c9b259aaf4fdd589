"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit.session import shared_dir

#: White space that separates words: blank and the five control characters from tab to carriage return.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """``frame``, written once to the shared folder and read back, so that nothing upstream runs again."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """row_id and doc (a struct of all columns) per row of ``docs``, written once.

    Whatever is joined by row_id has to read this: a number evaluated anew in a later scan is another one as soon as the
    scan is split differently, which a lost executor is enough for.
    """
    return materialize(docs.select(F.monotonically_increasing_id().alias("row_id"), F.struct(*docs.columns).alias("doc")), name)


def tasks(spark: SparkSession) -> int:
    """Partitions that the session asks a shuffle to make."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array; no words, no entries."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
