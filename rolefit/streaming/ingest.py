"""Deduplication on streams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit.operators.dedup import bloom_bitmap, bloom_membership, bloom_verdict, first_per_key
from rolefit.streaming.runs import batch_ids

SALTS = 16


def drop_repeats(stream: DataFrame, key: str = "job_id", salts: int = SALTS, watermark: tuple[str, str] | None = None) -> DataFrame:
    """First arrival of each key, with the keys seen so far in the state store.

    A key that makes up a third of a batch would land in one state partition. The first step keeps
    one row per key and salt, which spreads such a key over ``salts`` partitions and lets at most
    that many of its rows, ever, reach the second step.

    ``watermark`` = (time column, delay) forgets keys that are older, which bounds the state.
    """
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(*stream.columns), F.lit(salts)))
    if watermark:
        salted = salted.withWatermark(*watermark)
        return salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark([key])
    return salted.dropDuplicates([key, "_salt"]).drop("_salt").dropDuplicates([key])


def first_arrivals(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The least row of each key by ``order``, whichever batch brings it; run in update mode.

    The state store holds one row per key and nothing else is read again, so a batch costs what it brings. Tasks keep
    their least row per key before anything moves, which makes one row per task of a hot key. A row comes out when it is the
    first of its key, and again, as a correction, when an earlier one arrives late; repeats change nothing and give no row.
    """
    timed = stream.withColumn("_brought", F.current_timestamp())  # one value per batch
    row = F.struct(*timed.columns)
    least = timed.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, F.col(order)).alias("_row"), F.max("_brought").alias("_now"))
    return least.filter("_row._brought = _now").select(*[F.col(f"_row.{c}").alias(c) for c in stream.columns])


class Corrections:
    """Stores the rows of ``first_arrivals`` under their batch's id; a repeated batch replaces its output. Nothing stored is read."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: str):
        self.spark, self.path, self.key, self.order = spark, path, key, order

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def kept(self) -> DataFrame:
        """One row per key: the last correction is the least row."""
        return first_per_key(self.spark.read.parquet(self.path).drop("batch"), self.key, self.order)


class BloomSink:
    """Bloom deduplication batch by batch, the filter being a table of bitmaps.

    The filter is sized for ``expected`` keys at false-positive rate ``p``. When a batch could overfill it, a
    further generation of at least twice the size and half the rate takes the new keys, and earlier ones are only
    asked; so the rate stays below 2 p however many keys arrive. Each batch writes its kept rows, the generations and the bits
    that its rows set under its own id; every ``COMPACT``-th writes the whole filter, so that a batch reads what was
    written since. A repeated batch replaces what it wrote.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str, key: Column, order: str, expected: int, p: float = 0.01):
        self.spark, self.key, self.order, self.expected, self.p = spark, key, order, max(expected, 1000), p
        self.rows_path, self.bits_path = f"{path}/rows", f"{path}/bits"

    def _generation(self, number: int, capacity: int) -> dict:
        n, p = max(capacity, 1), self.p / 2 ** number
        m = max(8, math.floor(-n * math.log(p) / math.log(2) ** 2))
        return {"gen": number, "m": m, "k": max(1, math.floor(m / n * math.log(2))), "capacity": capacity, "held": 0}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        earlier = batch_ids(self.spark, self.bits_path, batch_id)
        saved, known = None, []
        if earlier:
            since = max([i for i in earlier if i % self.COMPACT == 0], default=0)
            stored = self.spark.read.parquet(*[f"{self.bits_path}/batch={i}" for i in earlier if i >= since]).filter("bucket IS NOT NULL")
            saved = stored.groupBy("gen", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            heads = self.spark.read.parquet(f"{self.bits_path}/batch={earlier[-1]}").filter("bucket IS NULL")
            # One row per generation, as many as the logarithm of the keys.
            known = [r.asDict() for r in heads.drop("bucket", "bitmap").orderBy("gen").collect()]
        generations = known or [self._generation(0, self.expected)]
        rows = batch.select(self.key.alias("_key"), F.col(self.order))
        arriving = rows.select("_key").distinct().count()
        if generations[-1]["held"] + arriving > generations[-1]["capacity"]:
            if not generations[-1]["held"]:  # still empty: made larger at once
                generations.pop()
            before = generations[-1]["capacity"] if generations else 0
            generations.append(self._generation(len(generations), max(2 * before, arriving)))
        now = generations[-1]
        bitmaps = lambda g: None if saved is None else saved.filter(F.col("gen") == g["gen"]).select("bucket", "bitmap")
        for old in generations[:-1]:
            seen = bloom_membership(rows, F.col("_key"), bitmaps(old), F.lit(old["m"]), F.lit(old["k"])).filter("maybe_seen")
            rows = rows.join(seen.select(F.col("key").alias("_key")), "_key", "left_anti")
        verdict = bloom_verdict(rows, F.col("_key"), self.order, size=(now["m"], now["k"]), prior=bitmaps(now) if now in known else None)
        kept = verdict.filter(~F.col("dropped")).select(F.col("first_seq").alias(self.order))
        batch.join(kept, self.order, "left_semi").write.mode("overwrite").parquet(f"{self.rows_path}/batch={batch_id}")
        stored = self.spark.read.schema(batch.schema).parquet(f"{self.rows_path}/batch={batch_id}")
        bits = bloom_bitmap(stored, self.key, F.lit(now["m"]).cast("bigint"), F.lit(now["k"]).cast("bigint"))
        held = {**now, "held": now["held"] + stored.count()}
        heads = self.spark.createDataFrame([{**g, **(held if g is now else {})} for g in generations], "gen int, m bigint, k bigint, capacity bigint, held bigint")
        fresh = bits.select(F.lit(now["gen"]).cast("int").alias("gen"), "bucket", "bitmap")
        if saved is not None and batch_id % self.COMPACT == 0:
            fresh = fresh.unionByName(saved).groupBy("gen", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        nothing = {c: F.lit(None).cast("bigint") for c in ("m", "k", "capacity", "held")}
        out = heads.withColumns({"bucket": F.lit(None).cast("bigint"), "bitmap": F.lit(None).cast("binary")}).unionByName(fresh.withColumns(nothing))
        out.write.mode("overwrite").parquet(f"{self.bits_path}/batch={batch_id}")

    def kept(self) -> DataFrame:
        return self.spark.read.parquet(self.rows_path)
