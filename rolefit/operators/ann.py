"""Approximate nearest neighbours: inverted lists around sampled centres, several probed per query.

A coarse quantizer is fitted to a bounded sample; every document goes to the list of its nearest centre, every query
to as many lists as the sample says the wished recall needs. Where vectors have no clusters, that is a large part of
them, and exact retrieval is the better choice: how many rows are scored is reported beside the recall.

Lists are gathered into groups and large ones split by their counted size, on both sides, so that no task holds a large part
and a query travels once to a group, not once to each list. Copies of a vector are searched
once: of equal documents only the k least ids can be in a result, and equal queries share theirs, so a list
full of copies never pairs with itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefit.operators.retrieval import DIGITS, _best, _cut, _place

SAMPLE = 65_536       # vectors that the quantizer is fitted to at most
MOST_LISTS = 4_096    # hence centres of 6 MB at 384 float32 dimensions, sent to every task
ROUNDS, JUDGED = 8, 512  # rounds of k-means, sampled queries that the number of probes is read from
PART_DOCS, PART_QUERIES = 65_536, 32_768
PART_BYTES = 32 << 20  # of the float64 vectors of a part, on either side
ROWS_AT_ONCE = 1_024  # rows of a batch that are dealt to groups together
CELLS = 8_000_000     # similarities computed at a time


@dataclass(frozen=True)
class Lists:
    """Unit centres, and the lists to probe for the recall that was asked for."""

    centres: np.ndarray
    probes: int


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(norms == 0, 1.0, norms)[:, None]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _clusters(x: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Centres by k-means on the unit sphere; an empty list starts again at the row that fits worst."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:lists]].copy()
    for _ in range(ROUNDS):
        near, fit = _nearest(x, centres, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near[:, 0], x)
        empty = np.flatnonzero(np.bincount(near[:, 0], minlength=len(centres)) == 0)
        sums[empty] = x[np.argsort(fit[:, 0], kind="stable")[:len(empty)]]
        centres = _unit(sums)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the n nearest centres of every row, nearest first, and their similarities."""
    out = []
    for at in range(0, len(x), max(1, CELLS // len(centres))):
        score = x[at:at + max(1, CELLS // len(centres))] @ centres.T
        best = np.argsort(-score, axis=1, kind="stable")[:, :n] if n > 1 else np.argmax(score, axis=1)[:, None]
        out.append((best, np.take_along_axis(score, best, axis=1)))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _probes(x: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Fewest lists that hold ``recall`` of the k nearest neighbours of sampled rows within the sample."""
    asked = x[:: max(1, len(x) // JUDGED)][:JUDGED]
    own, turn = _nearest(x, centres, 1)[0][:, 0], _nearest(asked, centres, len(centres))[0]
    place = np.argsort(turn, axis=1)  # list: when a query probes it
    needed = []
    for at in range(0, len(asked), 64):
        score = asked[at:at + 64] @ x.T
        found = np.argpartition(-score, min(k, len(x) - 1), axis=1)[:, :k]
        needed.append(np.take_along_axis(place[at:at + 64], own[found], axis=1).ravel())
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def fit_lists(docs: DataFrame, k: int, recall: float = 0.95, lists: int | None = None, sample: int = SAMPLE, seed: int = 0) -> Lists:
    """A quantizer for ``docs`` (id, vec) from a sample of at most ``sample`` different vectors, those of the least hashes.

    One list per square root of the documents unless ``lists`` says otherwise, MOST_LISTS at most.
    """
    docs = docs.filter(F.col("vec").isNotNull())
    lists = min(lists or max(1, math.isqrt(docs.count())), MOST_LISTS)
    taken = docs.select("vec").distinct().orderBy(F.xxhash64(F.lit(seed), "vec")).limit(sample)

    def fit(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [_matrix(b.column("vec")) for b in frames if b.num_rows]
        if x:
            x = _unit(np.concatenate(x))
            centres = _clusters(x, min(lists, len(x)), seed)
            yield pa.RecordBatch.from_pydict({"centres": [centres.tobytes()], "n": [len(centres)], "probes": [_probes(x, centres, k, recall)]})

    row = taken.coalesce(1).mapInArrow(fit, "centres binary, n long, probes long").first()
    return Lists(np.frombuffer(row["centres"]).reshape(row["n"], -1), row["probes"]) if row else Lists(np.zeros((1, 1)), 1)


def assign(vectors: DataFrame, fitted: Lists, probes: int = 1) -> DataFrame:
    """``vectors`` (id, vec, ...) with ``lists``, the numbers of their nearest centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near, _ = _nearest(_unit(_matrix(batch.column("vec"))), fitted.centres, probes)
                offsets = pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32))
                yield batch.append_column("lists", pa.ListArray.from_arrays(offsets, pa.array(near.astype(np.int32).ravel())))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kinds}, lists array<int>")


def _vector_key() -> list[Column]:
    return [F.xxhash64(F.lit(1), "vec").alias("key1"), F.xxhash64(F.lit(2), "vec").alias("key2")]


def _grouped(sizes: dict[int, int], lists: int, most: int) -> np.ndarray:
    """The group of each list, or -1 for one without documents: lists in turn, until one more would exceed ``most`` documents."""
    group, held, out = 0, 0, np.full(lists, -1, np.int32)
    for n in sorted(sizes):
        if held and held + sizes[n] > most:
            group, held = group + 1, 0
        out[n], held = group, held + sizes[n]
    return out


def _dealt(vectors: DataFrame, fitted: Lists, group_of: np.ndarray, probes: int) -> DataFrame:
    """(group, lists, id, vec): a row for each group that holds lists to probe, with those lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                near, _ = _nearest(_unit(_matrix(batch.column("vec"))), fitted.centres, probes)
                row, listed = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
                group = group_of[listed]
                order = np.lexsort((listed, group, row))
                order = order[group[order] >= 0]
                row, listed, group = row[order], listed[order], group[order]
                first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])][:len(row)])
                offsets = pa.array(np.r_[first, len(row)].astype(np.int32))
                taken = batch.take(pa.array(row[first]))
                yield pa.RecordBatch.from_arrays([pa.array(group[first]), pa.ListArray.from_arrays(offsets, pa.array(listed.astype(np.int32))),
                                                  taken.column("id"), taken.column("vec")], names=["group", "lists", "id", "vec"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "vec"))
    return vectors.select("id", "vec").mapInArrow(run, f"group int, lists array<int>, {kinds}")


def _cells(fitted: Lists, queries: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cell (group of lists, part of the documents, part of the queries) that their rows meet in.

    A query goes once to a group, however many of its lists it probes; groups are counted on both sides, a row for each
    list or group on the driver.
    """
    spark, width = docs.sparkSession, 8 * fitted.centres.shape[1]
    most_docs, most_queries = (max(1, min(most, PART_BYTES // width)) for most in (PART_DOCS, PART_QUERIES))
    counted = lambda rows, name: {r[name]: r["n"] for r in rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = counted(assign(docs, fitted).select(F.col("lists")[0].alias("list")), "list")
    enough = -(-sum(sizes.values()) // (2 * spark.sparkContext.defaultParallelism))  # documents of a group, so that all slots have work
    group_of = _grouped(sizes, len(fitted.centres), max(1, min(most_docs, enough)))
    d, q = _dealt(docs, fitted, group_of, 1), _dealt(queries, fitted, group_of, fitted.probes)
    held = {}
    for n, size in sizes.items():
        held[int(group_of[n])] = held.get(int(group_of[n]), 0) + size
    asked = counted(q, "group")
    rows = [(g, -(-held[g] // most_docs), -(-n // most_queries)) for g, n in asked.items()]
    parts = F.broadcast(spark.createDataFrame(rows, "group int, d_parts int, q_parts int"))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    d = d.join(parts, "group").select("group", part("d_parts").alias("d_part"), every("q_parts").alias("q_part"), "lists", "id", "vec")
    q = q.join(parts, "group").select("group", every("d_parts").alias("d_part"), part("q_parts").alias("q_part"), "lists", "id", "vec")
    return q, d


def _search(k: int):
    def run(queries: pa.Table, docs: pa.Table) -> pa.Table:
        docs = docs.sort_by("id")
        names, asked = docs["id"].combine_chunks(), queries["id"].combine_chunks()
        if not len(asked) or not len(names):
            return pa.table({"query_id": asked.slice(0, 0), "doc_id": names.slice(0, 0), "similarity": pa.array([], pa.float64())})
        x, q = _unit(_matrix(docs["vec"])), _unit(_matrix(queries["vec"]))
        own, wanted = docs["lists"].combine_chunks().flatten().to_numpy(), queries["lists"].combine_chunks()
        probing, probed = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy())), wanted.flatten().to_numpy()
        floor, found, size = np.full(len(q), -np.inf), [], 0
        for n in np.unique(own):
            cols, rows = np.flatnonzero(own == n), probing[probed == n]
            part = x[cols].T
            for at in range(0, len(rows), max(1, CELLS // len(cols))):
                mine = rows[at:at + max(1, CELLS // len(cols))]
                score = np.round(q[mine] @ part, DIGITS)
                row, col = _best(score, floor[mine], k)
                found.append((mine[row], cols[col], score[row, col]))
                size += len(row)
            if size >= 2 * k * len(q):
                row, col, score = _cut(found, k)
                found, size, last = [(row, col, score)], len(row), np.flatnonzero(_place(row) == k - 1)
                floor[row[last]] = score[last]
        if not found:
            return pa.table({"query_id": asked.slice(0, 0), "doc_id": names.slice(0, 0), "similarity": pa.array([], pa.float64())})
        row, col, score = _cut(found, k)
        return pa.table({"query_id": asked.take(pa.array(row)), "doc_id": names.take(pa.array(col)), "similarity": score})

    return run


def ann_topk(queries: DataFrame, docs: DataFrame, k: int, fitted: Lists | None = None) -> DataFrame:
    """(query_id, doc_id, similarity, rank): about the k most similar documents of every query, from the probed lists.

    Columns, rounding and ties are those of exact retrieval; what is returned has its exact similarity. Rows without a vector take no part.
    """
    queries, docs = (df.select("id", "vec").filter(F.col("vec").isNotNull()) for df in (queries, docs))
    fitted = fitted or fit_lists(docs, k)
    d, q, back = _different(queries, docs, k)
    left, right = _cells(fitted, q, d)
    keys = ["group", "d_part", "q_part"]
    d_type, q_type = docs.schema["id"].dataType.simpleString(), queries.schema["id"].dataType.simpleString()
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), f"query_id {q_type}, doc_id {d_type}, similarity double")
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.withColumnRenamed("query_id", "shared").join(back, "shared").select("query_id", "doc_id", "similarity", "rank")


def _different(queries: DataFrame, docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents without copies that cannot be found, one query per vector, and which queries share it."""
    copies = Window.partitionBy("key1", "key2").orderBy("id")
    d = docs.select("id", "vec", *_vector_key()).withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= k).select("id", "vec")
    keyed = queries.select("id", "vec", *_vector_key())
    first = keyed.groupBy("key1", "key2").agg(F.min(F.struct("id", "vec")).alias("first"))
    shared = first.select("key1", "key2", F.col("first.id").alias("shared"))
    back = keyed.select(F.col("id").alias("query_id"), "key1", "key2").join(shared, ["key1", "key2"]).select("query_id", "shared")
    return d, first.select("first.id", "first.vec"), back


def rows_scored(queries: DataFrame, docs: DataFrame, k: int, fitted: Lists) -> DataFrame:
    """One row: similarities that the search computes, and those of exact retrieval."""
    queries, docs = (df.select("id", "vec").filter(F.col("vec").isNotNull()) for df in (queries, docs))
    d, q, _ = _different(queries, docs, k)
    sizes = assign(d, fitted).groupBy(F.col("lists")[0].alias("list")).agg(F.count(F.lit(1)).alias("held"))
    asked = assign(q, fitted, fitted.probes).select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("asked"))
    scored = sizes.join(asked, "list").agg(F.coalesce(F.sum(F.col("held") * F.col("asked")), F.lit(0)).alias("scored"))
    n_queries, n_docs = (df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in (queries, docs))
    return scored.select("scored", (n_queries * n_docs).alias("exact"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of ``exact`` (query_id, doc_id, ...) that ``found`` holds."""
    hit = exact.select("query_id", "doc_id").join(found.select("query_id", "doc_id", F.lit(1).alias("hit")), ["query_id", "doc_id"], "left")
    return hit.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0)).alias("recall"))
