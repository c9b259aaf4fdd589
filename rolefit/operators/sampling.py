"""Seeded, repeatable samples of exactly n rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefit.operators.dedup import first_per_key

PREFIXES = 65_536  # four hex digits


def seeded_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def bottom_k(df: DataFrame, key: Column, k: int, seed: int = 42) -> DataFrame:
    """The k rows with the smallest seeded hash of their key (unique per row): a uniform sample.

    Rows are first counted per hash prefix. All prefixes below the one where the count reaches k
    are kept whole and only that single prefix is ranked, so neither the driver nor one task ever
    holds k rows, and everything past the prefix is dropped before the shuffle.
    """
    tagged = df.withColumn("_hash", seeded_hash(key, seed)).withColumn(
        "_prefix", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"))
    per_prefix = tagged.groupBy("_prefix").agg(F.count(F.lit(1)).alias("n"))  # at most PREFIXES rows
    reached = per_prefix.withColumn("upto", F.sum("n").over(Window.orderBy("_prefix"))).filter(F.col("upto") >= k)
    cut = reached.agg(F.min(F.struct("_prefix", (F.lit(k) - F.col("upto") + F.col("n")).alias("room"))).alias("cut"))
    found = cut.select("cut").scalar()
    last, room = F.coalesce(found["_prefix"], F.lit(PREFIXES)), F.coalesce(found["room"], F.lit(0))
    place = F.row_number().over(Window.partitionBy("_prefix").orderBy("_hash"))
    return (
        tagged.filter(F.col("_prefix") <= last)
        .withColumn("_place", place)
        .filter((F.col("_prefix") < last) | (F.col("_place") <= room))
        .drop("_hash", "_prefix", "_place")
    )


def sample_postings(flat: DataFrame, target: int, seed: int, order: str) -> DataFrame:
    """``target`` distinct postings out of flattened, valid English ones.

    Two records are the same posting when they share the source's id, or title and company where
    there is none.
    """
    key = F.when(F.coalesce("id_in_source", F.lit("")) != "", F.col("id_in_source")).otherwise(F.concat("name", "company"))
    keyed = flat.withColumn("_key", key)
    return bottom_k(first_per_key(keyed, "_key", order), F.col("_key"), target, seed).drop("_key")


def with_injected_duplicates(df: DataFrame, key: Column, n: int, share: float = 0.2, seed: int = 5) -> DataFrame:
    """A sample of n rows followed by a repeated part of it; ``copy`` tells them apart."""
    sample = bottom_k(df, key, n, seed)
    repeats = bottom_k(sample, key, int(n * share), seed + 1)
    return sample.withColumn("copy", F.lit(0)).unionByName(repeats.withColumn("copy", F.lit(1)))
