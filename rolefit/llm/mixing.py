"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

The words of a source form streams (one per shard of the source, documents in a seeded order), cut
into blocks of equal length. The words of the whole mix are seats: Sainte-Laguë gives them to the
sources by highest quotients. A source's quota is counted in blocks of its own, a small part of what it has or
is to give at most, and its shards get blocks by highest quotients. A shard takes every block as often as its quota holds
whole passes, and a seeded selection of blocks for what is left.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rolefit.llm.common import SPACE_CHARS, WORD, materialize, numbered, tasks, text_or_empty

#: Rows of the per-source table that one task plans and that are broadcast; more sources are planned by sums over tasks.
MAX_SOURCES = 200_000
#: Divisors tried in one pass over the sources; salts of a source with more than one row in so many.
TRIES, SALTS = 32, 64
#: Blocks that a source's words, and those the mix takes of it, hold at least, where a block of one word allows it.
LEAST_BLOCKS = 64
#: A prime above any number of blocks in a shard: multiplying by it permutes the block numbers.
PRIME = 2_147_483_647


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats per party by the highest quotients ``votes / (2 k - 1)``, at most ``caps`` each; ties to the first."""
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    seats = int(min(seats, caps[votes > 0].sum()))
    given = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return given
    fill = lambda x: np.minimum(np.floor(votes / x + 0.5), caps).astype(np.int64)  # noqa: E731  quotients of at least x / 2
    low, high = 1e-12, 4 * votes.max() + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if fill(mid).sum() > seats else (low, mid)
    given = fill(high)
    best = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, given, caps, strict=True)) if v > 0 and g < c]
    heapq.heapify(best)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(best)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(best, (-votes[i] / (2 * given[i] + 1), i))
    return given


def targets_of(sizes: np.ndarray, weights: np.ndarray, cap: int) -> np.ndarray:
    """Shares of the sum of sizes by weight, none above ``cap`` times its size; an excess is shared again by weight."""
    target, capped = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    while True:
        free = ~capped
        if not free.any():
            return target
        target[free] = (sizes.sum() - target[capped].sum()) * weights[free] / weights[free].sum()
        over = free & (target > cap * sizes)
        if not over.any():
            return target
        target[over], capped = cap * sizes[over], capped | over


def _plan_sources(weights: tuple, cap: int, block: int, shard_words: int, max_shards: int):
    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        named = rows[rows.source.notna()].sort_values("source", key=lambda s: s.map(lambda x: x.encode()))
        rows = pd.concat([named, rows[rows.source.isna()]], ignore_index=True)
        size = rows.source_size.to_numpy(np.int64)
        weight = np.array([weights[i % len(weights)] for i in range(len(rows))], float)
        target = targets_of(size, weight, cap)
        words = sainte_lague(target, int(size.sum()), cap * size)
        own = np.clip(np.minimum(size, words) // LEAST_BLOCKS, 1, block)
        return rows.assign(target=target, block=own, seats=(2 * words + own) // (2 * own), shards=np.clip(-(-size // shard_words), 1, max_shards))

    return plan


def _numbered(frame: DataFrame, name: str, *order) -> DataFrame:
    """``frame`` with ``pos``, its rows numbered from 0 in an order: a range sort, and an offset per partition."""
    placed = frame.repartitionByRange(tasks(frame.sparkSession), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed, name)
    offsets, total = {}, 0
    for r in placed.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect():  # one row per partition
        offsets[r.part], total = total, total + r["count"]
    offset = F.create_map(*[F.lit(x).cast("long") for pair in offsets.items() for x in pair]) if offsets else F.create_map(F.lit(0).cast("long"), F.lit(0).cast("long"))
    return placed.withColumn("pos", offset[F.shiftright("at", 33)] + F.col("at").bitwiseAND(F.lit(2**33 - 1))).drop("at")


def _plan_many_sources(sources: DataFrame, weights: tuple, cap: int, block: int, shard_words: int, max_shards: int) -> DataFrame:
    """What ``_plan_sources`` gives, for any number of sources: only sums over all of them reach the driver."""
    rows = _numbered(sources, "mix-numbered", F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod("pos", F.lit(len(weights))).cast("int")]
    rows = materialize(rows.withColumn("weight", weight), "mix-weighted")
    most = F.lit(cap) * F.col("source_size")
    total = rows.agg(F.sum("source_size")).first()[0]
    share, capped = 0.0, -1  # a source's target is share * weight, at most ``most``: the share rises with every source that is capped
    while True:
        over = F.lit(share) * F.col("weight") > most
        s = rows.agg(F.count_if(over).alias("n"), F.sum(F.when(over, most).otherwise(0)).alias("taken"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if s.n == capped or not s.free:
            break
        share, capped = max(share, (total - s.taken) / s.free), s.n
    target = F.when(F.lit(share) * F.col("weight") > most, most.cast("double")).otherwise(F.lit(share) * F.col("weight"))
    rows = materialize(rows.withColumn("target", target).withColumn("most", most), "mix-targets")
    fill = lambda x: F.least(F.floor(F.col("target") / F.lit(x) + 0.5), F.col("most"))  # noqa: E731  quotients of at least x / 2
    ends = rows.agg(F.sum(F.when(F.col("target") > 0, F.col("most"))).alias("most"), F.max("target").alias("high")).first()
    seats = int(min(total or 0, ends.most or 0))
    low, high, given = 1e-12, 4 * (ends.high or 0.0) + 1, -1
    while given != seats:  # fill(high) gives no more than the seats
        tries = sorted({x for x in np.linspace(low, high, TRIES + 2).tolist() if low < x < high})
        if not tries:
            break
        sums = rows.agg(*[F.sum(fill(x)).alias(f"s{i}") for i, x in enumerate(tries)]).first()
        fits = [i for i, n in enumerate(sums) if n <= seats]
        if not fits:
            low = tries[-1]
            continue
        high, given = tries[fits[0]], sums[fits[0]]
        low = tries[fits[0] - 1] if fits[0] else low
    rows = rows.withColumn("seats", fill(high))
    left = seats - rows.agg(F.sum("seats")).first()[0]
    while left > 0:  # equal quotients: to the first
        open_ = (F.col("target") > 0) & (F.col("seats") < F.col("most"))
        asked = rows.filter(open_ & (fill(low) > F.col("seats")))
        asked = rows.filter(open_) if asked.isEmpty() else asked
        ranked = _numbered(asked.select(F.col("pos").alias("of"), (-F.col("target") / (2 * F.col("seats") + 1)).alias("q")), "mix-ties", "q", "of")
        more = ranked.filter(F.col("pos") < left).select("of")
        rows = materialize(rows.join(more, F.col("pos") == F.col("of"), "left").withColumn("seats", F.col("seats") + F.col("of").isNotNull().cast("long")).drop("of"), "mix-seats")
        left = seats - rows.agg(F.sum("seats")).first()[0]
    shards = F.greatest(F.lit(1), F.least(F.ceil(F.col("source_size") / shard_words), F.lit(max_shards)))
    words = F.col("seats").cast("long")
    own = F.greatest(F.lit(1).cast("long"), F.least(F.expr(f"least(source_size, cast(seats AS bigint)) DIV {LEAST_BLOCKS}"), F.lit(block).cast("long")))
    rows = rows.select("source", "source_size", "target", words.alias("words"), own.alias("block"), shards.cast("long").alias("shards"))
    return rows.select("source", "source_size", "target", "block", F.expr("(2 * words + block) DIV (2 * block)").alias("seats"), "shards")


def _with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` beside their sources by an equi-join, the few sources that have many rows dealt over ``SALTS`` keys."""
    sizes = materialize(rows.groupBy("source").agg(F.count("*").alias("n")), "mix-rows")
    many = (sizes.agg(F.sum("n")).first()[0] or 0) / SALTS
    hot = [r.source for r in sizes.filter((F.col("n") > many) & (F.col("n") >= SALTS)).collect()]  # fewer than SALTS
    is_hot = F.col("source").isin([x for x in hot if x is not None]) if any(x is not None for x in hot) else F.lit(False)
    is_hot = F.coalesce(is_hot, F.lit(None in hot))
    left = rows.withColumn("salt", F.when(is_hot, F.pmod("draw", F.lit(SALTS))).otherwise(0).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = sources.withColumn("of_salt", F.explode(salts)).withColumnRenamed("source", "of_source")
    return left.join(right, left.source.eqNullSafe(right.of_source) & (left.salt == right.of_salt)).drop("of_source", "salt", "of_salt")


def _plan_shards(cap: int):
    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        size = rows.shard_size.to_numpy(np.int64)
        blocks = -(-size // rows.block.to_numpy(np.int64))
        quota = sainte_lague(size, int(rows.seats.iloc[0]), cap * blocks)
        passes = np.where(blocks > 0, quota // np.maximum(blocks, 1), 0)
        return rows.assign(blocks=blocks, passes=passes, rest=quota - passes * blocks)[["source", "shard", "blocks", "passes", "rest"]]

    return plan


def plan_mix(docs: DataFrame, weights: tuple = (5, 2, 1), cap: int = 3, block: int = 64, seed: int = 17,
             shard_words: int = 65_536, max_shards: int = 4_096, key: str | None = None) -> DataFrame:
    """Which blocks of every document the mix takes.

    ``docs`` has doc_id, text, source, and a column named by ``key`` where rows have a unique number already (else they
    are numbered as they are scanned). Sources in code point order (null last) weigh ``weights`` in turn and share
    all words; no source is taken more than ``cap`` times over. Returns a row per row of ``docs``: row_id,
    doc_id, source, size, source_size, target, first (its first word in the shard's stream), blocks, passes and
    rest (the shard's number of blocks, whole passes, and blocks taken once more), shift (of the selection), block (the words
    of a block of its source, ``block`` at most).
    Null or empty texts have size 0 and are never taken; rows with a null doc_id and repeated rows are rows like
    others; an empty table gives an empty result. Up to ``MAX_SOURCES`` sources are planned in one task, more
    by sums over tasks, with the same result; shards keep a hot source from meeting in one task.
    """
    row_id = F.col(key) if key else F.monotonically_increasing_id()
    rows = materialize(docs.select(
        row_id.alias("row_id"), "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("draw")), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(sources, "mix-source-sizes")
    if sources.count() > MAX_SOURCES:
        rows = _with_sources(rows, materialize(_plan_many_sources(sources, weights, cap, block, shard_words, max_shards), "mix-sources"))
    else:
        sources = materialize(sources.groupBy().applyInPandas(
            _plan_sources(weights, cap, block, shard_words, max_shards), "source string, source_size long, target double, block long, seats long, shards long"), "mix-sources")
        # One row per source, MAX_SOURCES at most: a bounded broadcast, and no shuffle on the hot source.
        rows = rows.join(F.broadcast(sources), rows.source.eqNullSafe(sources.source)).drop(sources.source)
    rows = rows.withColumn("shard", F.pmod("draw", F.col("shards")))
    shards = rows.groupBy("source", "shard", "seats", "block").agg(F.sum("size").alias("shard_size")).groupBy("source").applyInPandas(
        _plan_shards(cap), "source string, shard long, blocks long, passes long, rest long")
    shards = shards.select(F.col("source").alias("of"), F.col("shard").alias("part"), "blocks", "passes", "rest")
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "draw"), "row_id")
    placed = rows.withColumn("first", F.sum("size").over(order) - F.col("size"))
    joined = placed.join(shards, placed.source.eqNullSafe(shards.of) & (placed.shard == shards.part))
    shift = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.greatest("blocks", F.lit(1)))
    return joined.select("row_id", "doc_id", "source", "size", "source_size", "target", "first", "blocks", "passes", "rest",
                         shift.alias("shift"), "block")


#: Words of a document that lie in block j and are taken by the selection of the rest.
_PIECE = f"CASE WHEN ({PRIME} * j + shift) % blocks < rest THEN least(first + size, (j + 1) * block) - greatest(first, j * block) ELSE 0 END"
_TAKEN = f"""CASE WHEN size = 0 THEN 0L
  WHEN rest = 0 THEN passes * size
  ELSE passes * size + aggregate(sequence(first DIV block, (first + size - 1) DIV block), 0L, (sum, j) -> sum + {_PIECE}) END"""


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes, repeats counted) per row of ``docs``."""
    plan = plan_mix(docs, **options)
    return plan.select("doc_id", "source", "size", "source_size", "target", F.expr(_TAKEN).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for every time the mix takes (a part of) a document.

    A whole pass gives the unchanged text. A part is the document's words from the first to the last word of each
    run of taken blocks, white space inside kept, runs joined by a line break. Documents that are not taken go,
    those without words among them: they hold nothing to train on.
    """
    keyed = numbered(docs, "mix-documents")
    plan = plan_mix(keyed.select("row_id", "doc.doc_id", "doc.text", "doc.source"), key="row_id", **options)
    runs = F.expr(f"""filter(transform(sequence(first DIV block, (first + size - 1) DIV block),
        j -> struct(greatest(first, j * block) - first AS lo, {_PIECE} AS n)), p -> p.n > 0)""")
    parts = F.when((F.col("rest") == 0) | (F.col("size") == 0), F.expr("cast(array() AS array<struct<lo:bigint,n:bigint>>)")).otherwise(runs)
    rows = keyed.select("row_id", "doc").join(plan.drop("doc_id", "source"), "row_id").withColumn("parts", parts)
    text = F.col("doc.text")
    tokens = F.regexp_extract_all(text, F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    cut = F.btrim(F.array_join(F.transform("parts", lambda p: F.array_join(F.slice(tokens, p.lo.cast("int") + 1, p.n.cast("int")), "")), ""), F.lit(SPACE_CHARS))
    whole = F.when(F.col("passes") > 0, F.array_repeat(text, F.col("passes").cast("int"))).otherwise(F.array().cast("array<string>"))
    piece = F.when(F.size("parts") > 0, F.array(cut)).otherwise(F.array().cast("array<string>"))
    taken = rows.filter(F.col("size") > 0).select("doc", F.explode(F.concat(whole, piece)).alias("taken_text"))
    columns = [F.col("taken_text").alias(c) if c == "text" else F.length("taken_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"doc.{c}").alias(c) for c in docs.columns]
    return taken.select(*columns)
