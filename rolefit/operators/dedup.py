"""Duplicate removal: exact, and by a Bloom filter whose false positives are counted."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

HEX_STEP = 6  # hex digits per Horner step: remainders below 2**39 never overflow a BIGINT


def dedup_key(df: DataFrame) -> Column:
    """job_id, or title and company where it is empty."""
    job_id = F.coalesce(F.col("job_id"), F.lit(""))
    return F.when(job_id != "", job_id).otherwise(F.concat("title", "company"))


def first_per_key(df: DataFrame, key: Column | str, order: Column | str) -> DataFrame:
    """First row of each key.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the exchange, so a key
    that holds a third of all rows leaves each map task as one row.
    """
    key = F.col(key) if isinstance(key, str) else key
    order = F.col(order) if isinstance(order, str) else order
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def bloom_size(n: Column, p: float) -> Column:
    """struct<m, k>: bits and hash functions for n keys at false-positive rate p."""
    n = F.greatest(n, F.lit(1)).cast("double")
    m = F.greatest(F.lit(8), F.floor(-n * math.log(p) / (math.log(2) ** 2))).cast("bigint")
    k = F.greatest(F.lit(1), F.floor(m / n * math.log(2))).cast("bigint")
    return F.struct(m.alias("m"), k.alias("k"))


def _params(counted: DataFrame, p: float, minimum: int) -> DataFrame:
    return (
        counted.withColumn("n", F.greatest("rows", F.lit(minimum))).withColumn("s", bloom_size(F.col("n"), p))
        .select("rows", "n", "s.m", "s.k", (F.floor((F.col("s.m") + 7) / 8) / F.lit(1024.0).cast("double")).alias("size_kb"))
    )


def bloom_params(df: DataFrame, p: float = 0.01, minimum: int = 1000) -> DataFrame:
    """One row: rows in the frame, n, m, k and the filter's size in KB."""
    return _params(df.agg(F.count(F.lit(1)).alias("rows")), p, minimum)


def hex_mod(hex_digits: Column, length: int, m: Column) -> Column:
    """Value of a long hex string modulo m by Horner's rule."""
    out = F.lit(0).cast("bigint")
    for start in range(0, length, HEX_STEP):
        width = min(HEX_STEP, length - start)
        chunk = F.conv(F.substring(hex_digits, start + 1, width), 16, 10).cast("bigint")
        out = (out * F.lit(16 ** width) + chunk) % m
    return out


def bloom_digest(key: Column) -> Column:
    """What positions are computed from: the hex digits of md5 and sha1 of a key, null for a null key."""
    binary = key.cast("string").cast("binary")
    return F.concat(F.md5(binary), F.sha1(binary))


def bloom_positions(digest: Column, m: Column, k: Column) -> Column:
    """Array of the k bit positions (md5 + i * sha1) mod m."""
    h1, h2 = hex_mod(F.substring(digest, 1, 32), 32, m), hex_mod(F.substring(digest, 33, 40), 40, m)
    return F.transform(F.sequence(F.lit(0).cast("bigint"), k - 1), lambda i: (h1 + i * h2) % m)


def bloom_bits(df: DataFrame, key: Column, m: Column, k: Column) -> DataFrame:
    """The rows of a frame, once per hash function, with its number ``i`` and bit position ``pos``.

    Positions are (md5 + i * sha1) mod m.
    """
    digest = key.cast("string").cast("binary")
    hashed = df.withColumns({"_h1": hex_mod(F.md5(digest), 32, m), "_h2": hex_mod(F.sha1(digest), 40, m), "_m": m})
    return (
        hashed.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1)))
        .withColumn("pos", (F.col("_h1") + F.col("i") * F.col("_h2")) % F.col("_m"))
        .drop("_h1", "_h2", "_m")
    )


def distinct_keys(df: DataFrame, key: Column, order: str) -> DataFrame:
    """(digest, first_seq, rows): each key once, by its digest, so that long keys never leave their task."""
    slim = df.select(bloom_digest(key).alias("digest"), F.col(order).alias("_seq"))
    return slim.groupBy("digest").agg(F.min("_seq").alias("first_seq"), F.count(F.lit(1)).alias("rows"))


def bloom_verdict(df: DataFrame, key: Column, order: str, p: float = 0.01, minimum: int = 1000,
                  size: tuple[int, int] | None = None, prior: DataFrame | None = None) -> DataFrame:
    """(first_seq, dropped) per key of a filter that reads the rows in order.

    The sequential filter sets a row's bits when it keeps the row. A row it drops has all its bits
    set already, so "bit set before row t" simply means "some earlier row hashes there", and the
    first row per bit is a minimum over the bit. Only the first row of a key can be kept, hence only
    distinct keys take part: copies of one key never meet in one group, and a bit is shared by
    less than one key on average. Bits are exchanged once, as three numbers each; the minimum stays beside
    every bit, and a key's bits are summed up in each task before they meet.

    ``size`` fixes (m, k) instead of sizing for the rows at hand. ``prior`` is a bitmap of earlier
    rows, see bloom_bitmap(); its bits count as set before the first row.
    """
    return _verdict(distinct_keys(df, key, order), p, minimum, size, prior)


def _sized(keys: DataFrame, p: float, minimum: int) -> DataFrame:
    """One row (rows, n, m, k, size_kb) from distinct_keys(); shares their exchange with whatever else reads them."""
    return _params(keys.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")), p, minimum)


def _verdict(keys: DataFrame, p: float, minimum: int, size: tuple[int, int] | None = None, prior: DataFrame | None = None) -> DataFrame:
    if size is None:
        params = _sized(keys, p, minimum).select(F.struct("m", "k").alias("s")).scalar()
        m, k = params["m"], params["k"]
    else:
        m, k = F.lit(size[0]).cast("bigint"), F.lit(size[1]).cast("bigint")
    keyed = keys.filter("digest IS NOT NULL").withColumns({"_m": m, "_k": k})
    bits = keyed.select(F.xxhash64("digest").alias("key64"), "first_seq", F.explode(bloom_positions(F.col("digest"), F.col("_m"), F.col("_k"))).alias("pos"))
    early = F.min("first_seq").over(Window.partitionBy("pos")) < F.col("first_seq")
    if prior is not None:
        placed = bits.withColumns({"bucket": F.bitmap_bucket_number("pos"), "bit": F.bitmap_bit_position("pos")})
        bits = placed.join(prior, "bucket", "left").select("key64", "first_seq", "pos", _bit_is_set().alias("was_set"))
        early = early | F.col("was_set")
    verdict = bits.withColumn("early", early).groupBy("key64", "first_seq").agg(F.min("early").alias("dropped"))
    return verdict.select("first_seq", "dropped")


def _bit_is_set() -> Column:
    """Whether ``bit`` is set in ``bitmap``; a bucket that is not stored has no bit set."""
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))


def bloom_dedup(df: DataFrame, key: Column, order: str, p: float = 0.01, minimum: int = 1000) -> DataFrame:
    """Rows the sequential Bloom filter keeps."""
    kept = bloom_verdict(df, key, order, p, minimum).filter(~F.col("dropped")).select(F.col("first_seq").alias(order))
    return df.join(kept, order, "left_semi")


def bloom_false_positives(df: DataFrame, key: Column, order: str, p: float = 0.01, minimum: int = 1000) -> DataFrame:
    """First rows of keys the filter drops although it never saw them."""
    lost = bloom_verdict(df, key, order, p, minimum).filter("dropped").select(F.col("first_seq").alias(order))
    return df.join(lost, order, "left_semi")


def ingest_stats(df: DataFrame, key: Column, order: str, p: float = 0.01, minimum: int = 1000) -> DataFrame:
    """One row of counters over a whole ingest; the rows are read once, their distinct keys are exchanged once."""
    keys = distinct_keys(df, key, order)
    verdict = _verdict(keys, p, minimum).agg(
        F.coalesce(F.sum(F.when(F.col("dropped"), 0).otherwise(1)), F.lit(0)).alias("ingested"),
        F.coalesce(F.sum(F.when(F.col("dropped"), 1).otherwise(0)), F.lit(0)).alias("bloom_false_positives"),
    )
    params = _sized(keys, p, minimum).select(F.struct("rows", "size_kb").alias("s")).scalar()
    return verdict.select(
        params["rows"].alias("total_seen"),
        (params["rows"] - F.col("ingested")).alias("duplicates"),
        "ingested",
        params["size_kb"].alias("bloom_size_kb"),
        "bloom_false_positives",
    )


def bloom_bitmap(df: DataFrame, key: Column, m: Column, k: Column) -> DataFrame:
    """A filter as rows (bucket, bitmap) of 32,768 bits each."""
    return (
        bloom_bits(df.select(key.alias("key")).distinct(), F.col("key"), m, k).select("pos").distinct()
        .groupBy(F.bitmap_bucket_number("pos").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bitmap"))
    )


def bloom_membership(probe: DataFrame, key: Column, bitmap: DataFrame, m: Column, k: Column) -> DataFrame:
    """Distinct probe keys with a flag telling whether the filter may contain them."""
    keys = probe.select(key.alias("key")).distinct()
    bits = bloom_bits(keys, F.col("key"), m, k).select(
        "key", F.bitmap_bucket_number("pos").alias("bucket"), F.bitmap_bit_position("pos").alias("bit"))
    return bits.join(bitmap, "bucket", "left").groupBy("key").agg(F.min(_bit_is_set()).alias("maybe_seen"))


def only_new(live: DataFrame, corpus: DataFrame, order: Column | str) -> DataFrame:
    """Live rows whose job_id the corpus lacks, one per job_id."""
    fresh = live.join(corpus.select("job_id"), "job_id", "left_anti")
    return first_per_key(fresh, "job_id", order)


def tighten_flags(corpus: DataFrame, live: DataFrame, order: Column | str) -> DataFrame:
    """Corpus with flags refreshed by live rows of the same job_id.

    A contract flag can only turn true and sponsorship can only turn false. ``flags_refreshed``
    counts the changes per row.
    """
    news = first_per_key(live, "job_id", order).select(
        "job_id", F.col("is_contract").alias("_contract"), F.col("sponsors_visa").alias("_sponsors"))
    to_contract = F.coalesce(F.col("_contract") & ~F.coalesce("is_contract", F.lit(False)), F.lit(False))
    to_no_sponsor = F.coalesce(~F.col("_sponsors") & F.coalesce("sponsors_visa", F.lit(True)), F.lit(False))
    return (
        corpus.join(news, "job_id", "left")
        .withColumn("flags_refreshed", to_contract.cast("int") + to_no_sponsor.cast("int"))
        .withColumn("is_contract", F.when(to_contract, True).otherwise(F.col("is_contract")))
        .withColumn("sponsors_visa", F.when(to_no_sponsor, False).otherwise(F.col("sponsors_visa")))
        .drop("_contract", "_sponsors")
    )
