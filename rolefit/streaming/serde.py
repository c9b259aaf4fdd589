"""Postings as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_messages(rows: DataFrame, key: str = "job_id") -> DataFrame:
    """(key, value): one JSON text per row; missing numbers are null, never NaN."""
    clean = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in rows.schema.fields]
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*clean), {"ignoreNullFields": "false"}).alias("value"))


def from_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("row")).select("row.*")
