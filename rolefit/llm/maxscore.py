"""Exact top-k inner products by MaxScore over integer vectors.

A dimension is a query term, a vector component its posting. In a shard, a term's largest possible
contribution bounds what it can add to a score. Terms are taken by falling bound; the last ones, whose
bounds together are small against the score a vector has to reach, are non-essential: postings of
essential terms are traversed for all vectors of a block, the others probed only for vectors that are
still competitive. Shards keep k rows per query; a final ranking merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rolefit.llm.common import materialize

#: Vectors per shard, queries per group: what one task holds at once.
SHARD, GROUP = 8_192, 4_096
#: Queries and vectors scored at a time.
QUERIES, VECTORS = 512, 2_048
#: Non-essential terms together reach at most this part of the score to beat.
SLACK = 0.25
#: Components up to here are multiplied as doubles without rounding (64 terms of 2**22 squared stay below 2**53).
EXACT = 2**22


def _keep(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each query, by falling score, then id."""
    order = np.lexsort((ids, -score, query))
    grouped = query[order]
    start = np.r_[0, np.flatnonzero(np.diff(grouped)) + 1]
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[rank < k]


def maxscore_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query position, vector id, score) of the k best vectors of every query; a query's own id is left out."""
    wide = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0)) > EXACT
    kind = np.int64 if wide else np.float64
    q, x = queries.astype(kind), vectors.astype(kind)
    high, low = x.max(axis=0), x.min(axis=0)
    bound = np.maximum(q * high, q * low)  # the most that a term can add
    by = np.argsort(-np.abs(bound).sum(axis=0), kind="stable")
    q, x, bound = q[:, by], x[:, by], bound[:, by]
    rest = np.c_[np.cumsum(bound[:, ::-1], axis=1)[:, ::-1], np.zeros(len(q), kind)]  # rest[:, d]: bound of terms d and later
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, kind))
    beat = np.full(len(q), -np.inf)
    step = min(len(x), 512)
    for at in range(0, len(x), VECTORS):
        for a, b in ((0, step), (step, VECTORS)) if at == 0 else ((0, VECTORS),):
            part, names = x[at + a:at + b], ids[at + a:at + b]
            if not len(part):
                continue
            ready = np.isfinite(beat)
            small = ready & (beat > 0)
            fits = (rest <= SLACK * np.where(small, beat, 0)[:, None])
            essential = int(np.argmax(fits.all(axis=0))) if small.all() else q.shape[1]
            score = q[:, :essential] @ part[:, :essential].T
            if not ready.all() and len(part) > k + 1:  # the best so far, from this block alone; own rows may be among them
                beat = np.maximum(beat, np.partition(score, len(part) - k - 1, axis=1)[:, len(part) - k - 1] if essential == q.shape[1] else beat)
            row, col = np.nonzero(score + rest[:, [essential]] >= beat[:, None])
            value = score[row, col]
            for d in range(essential, q.shape[1], 4):  # probe the other terms while competitive
                e = min(d + 4, q.shape[1])
                value = value + (q[row, d:e] * part[col, d:e]).sum(axis=1)
                alive = value + rest[row, e] >= beat[row]
                row, col, value = row[alive], col[alive], value[alive]
            other = names[col] != query_ids[row]
            merged = [np.concatenate(z) for z in zip(best, (row[other], names[col[other]], value[other]), strict=True)]
            kept = _keep(*merged, k)
            best = tuple(z[kept] for z in merged)
            count = np.bincount(best[0], minlength=len(q))
            worst = np.full(len(q), np.inf)
            np.minimum.at(worst, best[0], best[2].astype(float))
            beat = np.maximum(beat, np.where(count >= k, worst, -np.inf))
    return best[0], best[1], best[2].astype(np.int64)


def _pack(rows: int):
    """Vectors of a partition as matrices of at most ``rows`` rows; shorter vectors are filled with zeros."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                piece = batch.slice(at, rows)
                lists = piece.column("ints")
                length = np.diff(lists.offsets.to_numpy())
                width = int(length.max(initial=0))
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                if (length == width).all():
                    matrix = flat.reshape(len(piece), width)
                else:
                    matrix = np.zeros((len(piece), width), np.int64)
                    matrix[np.arange(width) < length[:, None]] = flat
                if width and np.abs(matrix).max(initial=0) < 2**31:
                    matrix = matrix.astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "cell": piece.column("cell").slice(0, 1), "side": piece.column("side").slice(0, 1),
                    "n": pa.array([len(piece)], pa.int32()), "wide": pa.array([matrix.dtype == np.int64]),
                    "ids": pa.array([piece.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                    "data": pa.array([matrix.tobytes()], pa.binary()),
                })

    return pack


def _matrix(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(d, np.int64 if w else np.int32).reshape(n, -1).astype(np.int64) for d, w, n in zip(rows.data, rows.wide, rows.n, strict=True)]
    width = max(p.shape[1] for p in parts)
    parts = [np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]
    return np.concatenate([np.frombuffer(i, np.int64) for i in rows.ids]), np.concatenate(parts)


def _cell(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if rows.side.nunique() == 2:
            query_ids, queries = _matrix(rows[rows.side == 0])
            ids, vectors = _matrix(rows[rows.side == 1])
            width = max(queries.shape[1], vectors.shape[1])
            queries, vectors = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, vectors))
            for at in range(0, len(queries), QUERIES):
                named = query_ids[at:at + QUERIES]
                q, i, s = maxscore_block(queries[at:at + QUERIES], named, vectors, ids, k)
                out.append(pd.DataFrame({"query_id": named[q], "vec_id": i, "score": s}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return run


def top_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products of every query, ties to the smaller id.

    A component x becomes floor(scale * x). Queries are the rows whose id ``every`` divides, candidates all rows of
    another id. Vectors that are null or hold a null or a non-finite component take no part, nor do rows without an
    id. Shorter vectors count as filled with zeros. Repeated ids are candidates each; a repeated query is one query,
    with the greatest of its vectors. An empty table gives an empty result.

    Vectors are dealt to shards and queries to groups by the hash of their id, so that a cell (group, shard) has a
    bounded size whatever the data; a cell returns at most k rows per query. Each vector is sent to every group of
    queries: with one group per 4,096 queries, matrices and not rows or pairs are moved.
    """
    vector = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.col(vector_col).isNotNull() & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(finite, vector).alias("ints"))
    rows = materialize(rows.filter("vec_id IS NOT NULL AND ints IS NOT NULL"), "topk-vectors")
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("ints").alias("ints"))
    total, asked = rows.count(), rows.filter(F.col("vec_id") % every == 0).count()
    shards, groups = -(-total // SHARD) or 1, -(-asked // GROUP) or 1
    spread = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n))

    def packs(frame: DataFrame, side: int, limit: int, own: str):
        frame = frame.withColumn(own, spread(shards if side else groups, side)).withColumn("side", F.lit(side))
        frame = frame.repartition(shards if side else groups, own).sortWithinPartitions(own).withColumn("cell", F.col(own))
        return frame.select("cell", "side", "vec_id", "ints").groupBy("cell", "side").applyInArrow(
            lambda table: pa.Table.from_batches(_pack(limit)(table.combine_chunks().to_batches())),
            "cell long, side int, n int, wide boolean, ids binary, data binary")

    left = packs(queries, 0, GROUP, "g").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("g", F.col("cell"))
    right = packs(rows, 1, SHARD, "s").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("s", F.col("cell"))
    columns = [F.col("g").cast("long").alias("g"), F.col("s").cast("long").alias("s"), "side", "n", "wide", "ids", "data"]
    cells = left.select(*columns).unionByName(right.select(*columns))
    found = cells.groupBy("g", "s").applyInPandas(lambda pdf: _cell(k)(pdf), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
