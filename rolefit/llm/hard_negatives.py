"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Scores are exact integer inner products by Kronecker-packed products. Components are shifted to be non-negative and
those of several candidates put side by side into fields of one wide integer, wide enough that sums over all components
never run into the next field. One multiplication per anchor component then serves all of them; fields are cut apart and
the shifts taken off again. The wide integers are the 53 bits of a double, where matrix products are
exact below 2**53, and Python's integers where a single field needs more.

Vectors are packed where they lie, without a shuffle. Packs of anchors meet packs of candidates in cells of bounded
size; a cell keeps a few rows per anchor, a window over those merges them. A first pass finds the positives, a second one the
negatives between the bounds that each positive sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, tasks

#: Vectors of a pack, candidates of a shard and anchors of a group: what one task holds at once.
PACK, SHARD, GROUP = 2_048, 131_072, 4_096
#: Anchors scored at a time.
ANCHORS = 512
#: Bits of a double's integers; fields of an integer where one field needs more.
DOUBLE, WIDE_FIELDS = 53, 4
PACKED = "pack long, n long, ids binary, labels binary, bytes int, data binary, scores binary"


class Packed:
    """Candidates as wide integers, for anchors whose components lie between ``low`` and ``high`` (per component)."""

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.rows, self.low, self.base = len(rows), low, rows.min(axis=0, initial=0)
        shifted = rows - self.base
        most = sum(int(a) * int(b) for a, b in zip(shifted.max(axis=0, initial=0), high - low, strict=True))
        shift = sum(max(-int(a), int(b)) * max(abs(int(c)), abs(int(d))) for a, b, c, d in zip(rows.min(axis=0, initial=0), rows.max(axis=0, initial=0), low, high, strict=True))
        self.bits = max(1, most.bit_length())
        narrow = max(most, 2 * shift).bit_length() <= DOUBLE
        self.kind = np.float64 if narrow else object
        self.fields = DOUBLE // self.bits if narrow else WIDE_FIELDS
        self.each = -(-self.rows // self.fields)
        shifted = np.pad(shifted, ((0, self.each * self.fields - self.rows), (0, 0))).reshape(self.fields, self.each, rows.shape[1])
        wide = shifted[0].astype(self.kind)
        for f in range(1, self.fields):
            wide = wide + shifted[f].astype(self.kind) * 2 ** (self.bits * f)
        self.wide = np.ascontiguousarray(wide.T)
        self.own = rows.astype(self.kind) @ low.astype(self.kind)

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates."""
        shifted = (anchors - self.low).astype(self.kind)
        product = shifted @ self.wide
        product = product if self.kind is object else product.astype(np.int64)
        mask = 2**self.bits - 1
        parts = [(product >> (self.bits * f)) & mask for f in range(self.fields)]
        field = np.concatenate(parts, axis=1)[:, :self.rows]
        # (a - low)(x - base) = ax - a base - low x + low base
        of_anchor = shifted @ self.base.astype(self.kind)
        score = field + of_anchor[:, None].astype(field.dtype) + self.own[None].astype(field.dtype)
        return score.astype(np.int64)


def pack(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, label, ints, scores) as matrices of at most PACK rows, each where its rows lie; shorter vectors are filled with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, len(batch), PACK):
                piece = batch.slice(at, PACK)
                matrix, scores = (_dense(piece.column(c)) for c in ("ints", "scores"))
                most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)) - 1)
                kind = next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
                yield pa.RecordBatch.from_pydict({
                    "pack": [number], "n": [len(piece)], "ids": [piece.column("vec_id").to_numpy().astype(np.int64).tobytes()],
                    "labels": [piece.column("label").to_numpy().astype(np.int64).tobytes()], "bytes": pa.array([np.dtype(kind).itemsize], pa.int32()),
                    "data": [matrix.astype(kind).tobytes()], "scores": [scores.tobytes()],
                })
                number += 1

    return rows.select("vec_id", "label", "ints", "scores").mapInArrow(run, PACKED)


def _dense(column: pa.Array) -> np.ndarray:
    length = np.diff(column.offsets.to_numpy())
    matrix = np.zeros((len(length), int(length.max(initial=0))), np.int64)
    matrix[np.arange(matrix.shape[1]) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return matrix


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels, components and scores of a pack."""
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["bytes"]]
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row["data"], kind).reshape(row["n"], -1).astype(np.int64), np.frombuffer(row["scores"], np.int64).reshape(row["n"], -1)


def _widen(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


class Best:
    """The ``k`` best candidates of every list, by falling score, then id."""

    def __init__(self, lists: int, k: int) -> None:
        self.k, self.found = k, [np.empty(0, np.int64)] * 3
        self.beat = np.full(lists, np.iinfo(np.int64).min)  # what a score has to reach once a list is full

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        at, score, ids = (np.r_[old, new] for old, new in zip(self.found, (at, score, ids), strict=True))
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        first = np.searchsorted(at, at)
        keep = np.arange(len(at)) - first < self.k
        self.found = [at[keep], score[keep], ids[keep]]
        full = np.arange(len(at)) - first == self.k - 1
        self.beat[at[full]] = score[full]


def _cell(k: int, low: int | None, high: int | None):
    """Lists of a cell: per anchor of its own label, or (low, high given) per positive score of its anchors, of other labels."""

    def run(table: pa.Table) -> pa.Table:
        rows = [_unpack(r) + (r["side"],) for r in table.to_pylist()]
        asked, held = [r for r in rows if not r[4]], [r for r in rows if r[4]]
        out = {"anchor_id": [], "slot": [], "score": [], "vec_id": []}
        if asked and held:
            width = max(r[2].shape[1] for r in rows)
            slots = 1 if low is None else max(r[3].shape[1] for r in asked)
            names, labels = (np.concatenate([r[i] for r in asked]) for i in (0, 1))
            anchors = np.concatenate([_widen(r[2], width) for r in asked])
            least, most = anchors.min(axis=0), anchors.max(axis=0)
            if low is not None:
                goal = np.concatenate([_widen(r[3], slots) for r in asked])
                floor, top = -(-low * goal // 100), high * goal // 100
            best = Best(len(anchors) * slots, k)
            for ids, of, vectors, _, _ in held:
                packed = Packed(_widen(vectors, width), least, most)
                for at in range(0, len(anchors), ANCHORS):
                    part = slice(at, at + ANCHORS)
                    score = packed.products(anchors[part])
                    same = labels[part, None] == of[None]
                    allowed = (same if low is None else ~same) & (names[part, None] != ids[None])
                    for slot in range(slots):
                        spot = np.arange(at, min(at + ANCHORS, len(anchors))) * slots + slot
                        bound = best.beat[spot]
                        fits = allowed & (score >= (bound if low is None else np.maximum(bound, floor[part, slot]))[:, None])
                        if low is not None:
                            fits &= score <= top[part, slot][:, None]
                        i, j = np.nonzero(fits)
                        best.add(spot[i], score[i, j], ids[j])
            at, score, ids = best.found
            out = {"anchor_id": names[at // slots], "slot": at % slots, "score": score, "vec_id": ids}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def _search(anchors: DataFrame, packs: DataFrame, k: int, low: int | None = None, high: int | None = None) -> DataFrame:
    """anchor_id, slot, rank, vec_id, score: the best ``k`` of every list, from all cells of anchors and candidates."""
    spark = anchors.sparkSession
    asked, held = (frame.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first() for frame in (anchors, packs))
    groups = max(1, -(-asked[0] // GROUP))
    shards = max(1, -(-held[0] // SHARD), min(held[1], -(-2 * tasks(spark) // groups)))
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "pack"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    columns = ["n", "ids", "labels", "bytes", "data", "scores"]
    left = anchors.select(deal(groups, 1).cast("long").alias("g"), every(shards).alias("s"), F.lit(False).alias("side"), *columns)
    right = packs.select(every(groups).alias("g"), deal(shards, 2).cast("long").alias("s"), F.lit(True).alias("side"), *columns)
    found = left.unionByName(right).groupBy("g", "s").applyInArrow(_cell(k, low, high), "anchor_id long, slot long, score long, vec_id long")
    order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50, low: int = 50, high: int = 95, scale: int = 256, relabel: int = 7, labels: int = 10,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x becomes floor(scale * x); where ``relabel`` divides an id, its label becomes (label + 1) % labels. Anchors
    are the rows whose id ``every`` divides; their positives are the best ``positives`` rows of their label, the negatives of a
    positive the best ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's. Ties go to
    the smaller id. Rows without an id or a label, and vectors that are null or hold a null or non-finite component, take no part; shorter vectors
    count as filled with zeros. Rows of an anchor's own id are not its candidates; other repeated rows count each, a repeated anchor
    is one anchor, that of the greatest vector. An empty table gives no row. Scores
    have to fit 64 bits.
    """
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    key = F.col("vec_id").cast("long")
    label = F.when(key % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")).cast("long")
    none = F.array().cast("array<bigint>").alias("scores")
    rows = vectors.select(key.alias("vec_id"), label.alias("label"), F.when(finite, ints).alias("ints"), none).filter("vec_id IS NOT NULL AND label IS NOT NULL AND ints IS NOT NULL")
    packs = materialize(pack(rows), "negatives-candidates")
    anchors = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max(F.struct("ints", "label")).alias("row"))
    anchors = materialize(anchors.select("vec_id", "row.label", "row.ints", none), "negatives-anchors")

    found = materialize(_search(materialize(pack(anchors), "negatives-anchor-packs"), packs, positives), "negatives-positives")
    goals = found.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    aimed = anchors.drop("scores").join(goals, anchors.vec_id == goals.anchor_id).select("vec_id", "label", "ints", "scores")
    mined = _search(materialize(pack(aimed), "negatives-aimed"), packs, negatives, low, high)
    named = found.select("anchor_id", (F.col("rank") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(named, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
