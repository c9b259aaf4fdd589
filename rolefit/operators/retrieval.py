"""Top-k retrieval: every query against every document, without ever emitting all pairs.

Both sides meet in a grid of (query block, document salt) cells, one task each. A cell's rows arrive sorted: first its
documents, of which a salt holds at most HELD_BYTES, then its queries, which stream past them a few at a time. So a task's
memory depends neither on the number of queries nor on that of documents, and no side has to fit on one machine. Dense
documents beyond KEPT_BYTES wait in a file of the task, from which they are read a slice at a time for each pack of queries.

A cell returns the k best of its documents for each of its queries. With one salt that is the result, and no pair is
shuffled; with several a window merges the partial lists.

A judge looks at the lists where they are found: then a cell has all documents, and what the pairs of a list
need of either side waits beside it, so that pairs are neither shuffled nor joined.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_LIMIT = 131_072     # queries of one block at most
QUERIES_PER_PACK = 2_048  # queries searched together at most
HELD_ROWS = 500_000       # pairs of the lists under construction, which bounds the queries searched together as well
FIRST_DOCS, FIRST_LISTS = 2_048, 8  # documents searched before the rest at least, and in lists of k
KEPT_LISTS = 8_192        # different sparse queries whose lists a task keeps
DOCS_PER_PACK = 8_192
SPARSE_DOCS = 8_192       # documents whose postings are searched together
HELD_BYTES = 128 << 20    # of document vectors in a cell: 524,288 at 64 float32 dimensions
KEPT_BYTES = 8 << 20      # of them in a task's memory
COPIED_BYTES = 64 << 20   # per slot, of documents sent to further query blocks
LISTED_BYTES = 32         # of a pair in a list
CELL_PAIRS, CELL_PRODUCTS = 4_000_000_000, 3_200_000_000_000  # pairs scored by a task; of dense vectors, components multiplied by it
HIT_SHARE, HITS_AT_ONCE = 24, 2_048  # one pair in so many at most, and so many together, are scored again one by one
ROW_BITS, COLUMN_BITS = 11, 22       # of a list's entry packed into 64 bits; the rest is its similarity
CHECK_TERMS, MARGIN = 8, 1e-8  # terms between two bounds; more than rounding and the order of sums can change
CELLS_PER_SLICE = 1_000_000
DIGITS = 9                # similarities are compared after rounding, so ties do not depend on summation order


class _Dense:
    """Vectors of some rows, as they came; unit vectors are formed when they are searched."""

    def __init__(self, raw: np.ndarray, norms: np.ndarray | None = None):
        self.raw = raw
        if norms is not None:
            self.norms = norms

    @classmethod
    def of(cls, column: pa.Array) -> _Dense:
        values = column.flatten().to_numpy(zero_copy_only=False).astype("float32", copy=False)
        return cls(values.reshape(len(column), len(values) // max(1, len(column))))

    @classmethod
    def merge(cls, parts: list[_Dense]) -> _Dense:
        return cls(np.concatenate([p.raw for p in parts]))

    def __len__(self) -> int:
        return len(self.raw)

    @cached_property
    def norms(self) -> np.ndarray:
        raw = self.raw.astype("float64")
        norms = np.sqrt((raw * raw).sum(axis=1))
        return np.where(norms == 0, 1.0, norms)

    def unit(self, kind: str = "float64") -> np.ndarray:
        return self.raw.astype(kind, copy=False) / self.norms.astype(kind)[:, None]

    def search(self, docs: _Dense, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, columns and similarities of each query's documents that exceed its floor; where there is none yet, of its k best.

        Beside a floor all pairs are scored in single precision first. Only pairs that its error may lift over the floor are scored in
        double precision, one by one while they are few.
        """
        step, mine = max(1, CELLS_PER_SLICE // len(docs)), self.unit()
        if np.isneginf(floor).any():
            theirs = docs.unit().T
            for lo in range(0, len(mine), step):
                cells = np.round(mine[lo:lo + step] @ theirs, DIGITS)
                rows, cols = _best(cells, floor[lo:lo + step], k)
                yield rows + lo, cols, cells[rows, cols]
            return
        short, theirs, whole = mine.astype("float32"), docs.unit(kind="float32").T, None
        least = (floor - MARGIN - (mine.shape[1] + 4) * 2.0 ** -23).astype("float32")[:, None]  # twice what single precision can lose
        for lo in range(0, len(mine), step):
            with np.errstate(invalid="ignore"):
                cells = short[lo:lo + step] @ theirs
            at = np.flatnonzero(cells >= least[lo:lo + step])
            rows = at // len(docs)
            cols = at - rows * len(docs)
            if len(at) > cells.size // HIT_SHARE:
                whole = docs.unit().T if whole is None else whole
                values = (mine[lo:lo + step] @ whole)[rows, cols]
            else:
                values = np.empty(len(at))
                for n in range(0, len(at), HITS_AT_ONCE):
                    part = slice(n, n + HITS_AT_ONCE)
                    values[part] = np.einsum("ij,ij->i", mine[rows[part] + lo], docs.raw[cols[part]].astype("float64")) / docs.norms[cols[part]]
            values, rows = np.round(values, DIGITS), rows + lo
            above = values > floor[rows]
            yield rows[above], cols[above], values[above]


class _Sparse:
    """Weighted terms of some rows, listed by owning row."""

    def __init__(self, ids: pa.Array | range, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.owner, self.terms, self.weights = ids, owner, terms, weights

    @classmethod
    def of(cls, column: pa.Array) -> _Sparse:
        flat = column.flatten()
        owner = np.repeat(np.arange(len(column), dtype="int32"), np.diff(column.offsets.to_numpy()))
        return cls(range(len(column)), owner, flat.field("term_id").to_numpy(zero_copy_only=False).astype("int32"),
                   flat.field("weight").to_numpy(zero_copy_only=False).astype("float64"))

    @classmethod
    def merge(cls, parts: list[_Sparse]) -> _Sparse:
        starts = np.cumsum([0] + [len(p) for p in parts])
        owner = np.concatenate([p.owner + np.int32(start) for p, start in zip(parts, starts)])
        return cls(range(starts[-1]), owner, np.concatenate([p.terms for p in parts]), np.concatenate([p.weights for p in parts]))

    def __len__(self) -> int:
        return len(self.ids)

    @cached_property
    def by_term(self) -> tuple[np.ndarray, ...]:
        """Different terms, where the postings of each start and end, owners and weights of all postings, largest weight of each term."""
        order = np.lexsort((self.owner, self.terms))
        terms, start = np.unique(self.terms[order], return_index=True)
        owner, weights = self.owner[order], self.weights[order]
        most = np.maximum.reduceat(weights, start) if len(terms) else np.empty(0)
        return terms, start, np.r_[start[1:], len(order)], owner, weights, most

    def indexed(self) -> _Sparse:
        """The postings alone, as documents are searched by them."""
        out = _Sparse(self.ids, *(np.empty(0, x.dtype) for x in (self.owner, self.terms)), np.empty(0))
        out.by_term = self.by_term
        return out

    def search(self, docs: _Sparse, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, columns and similarities of each query's k best documents that reach its floor.

        Postings of the query's terms are added up, those that can add most first. The k-th best sum so far is a
        bound for the result; once what is left cannot lift a document to it that holds none of the terms so far, only
        documents that can still reach it are looked up in the postings of the other terms.
        """
        terms, start, end, owner, weights, most = docs.by_term
        prune = not (len(weights) and weights.min() < 0) and not (len(self.weights) and self.weights.min() < 0)
        n, by_query = len(docs.ids), np.argsort(self.owner, kind="stable")
        cuts = np.searchsorted(self.owner[by_query], np.arange(len(self.ids) + 1))
        searched: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}  # equal queries are searched once
        for row in range(len(self.ids)):
            mine = by_query[cuts[row]:cuts[row + 1]]
            key = (self.terms[mine].tobytes(), self.weights[mine].tobytes(), float(floor[row]))
            if key in searched:
                cols, score = searched[key]
                yield np.full(len(cols), row), cols, score
                continue
            at = np.searchsorted(terms, self.terms[mine])
            known = at < len(terms)
            known[known] = terms[at[known]] == self.terms[mine][known]
            at, weight = at[known], self.weights[mine][known]
            order = np.argsort(-(weight * most[at]), kind="stable")
            at, weight = at[order], weight[order]
            rest = np.r_[np.cumsum((weight * most[at])[::-1])[::-1], 0.0]  # what term i and later can add at most
            sums, reach, done = np.zeros(n), floor[row], 0
            for done in range(len(at) + 1):
                if prune and done and done % CHECK_TERMS == 0 and n > k:
                    reach = max(reach, np.partition(sums, n - k)[n - k])
                if done == len(at) or (prune and rest[done] < reach - MARGIN):
                    break
                part = slice(start[at[done]], end[at[done]])
                sums[owner[part]] += weight[done] * weights[part]
            cols = np.flatnonzero(sums >= reach - rest[done] - MARGIN) if np.isfinite(reach) else np.arange(n)
            score = sums[cols]
            for i in range(done, len(at)):
                part = slice(start[at[i]], end[at[i]])
                place = np.minimum(np.searchsorted(owner[part], cols), end[at[i]] - start[at[i]] - 1)
                score = score + np.where(owner[part][place] == cols, weight[i] * weights[part][place], 0.0)
                alive = score >= reach - rest[i + 1] - MARGIN
                cols, score = cols[alive], score[alive]
            score = np.round(score, DIGITS)
            _, kept = _best(score[None], floor[row:row + 1], k)
            searched[key] = cols[kept], score[kept]
            yield np.full(len(kept), row), cols[kept], score[kept]


def _best(scores: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best cells per row that reach the row's floor.

    Equal scores are taken in column order.
    """
    allowed = scores >= floor[:, None]
    if scores.shape[1] <= k:
        return np.nonzero(allowed)
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    above, ties = scores > kth, scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(allowed & (above | (ties & (np.cumsum(ties, axis=1) <= room))))


class _Stored:
    """Slices of dense vectors, in memory up to KEPT_BYTES, beyond that in a file below Spark's local folders that goes with the task."""

    def __init__(self):
        folders = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
        self.file = tempfile.SpooledTemporaryFile(KEPT_BYTES, dir=folders[os.getpid() % len(folders)])
        self.shapes: list[tuple[int, int]] = []
        self.norms: list[np.ndarray] = []

    def append(self, docs: _Dense) -> None:
        self.file.write(np.ascontiguousarray(docs.raw).data.cast("B") if docs.raw.size else b"")
        self.shapes.append(docs.raw.shape)
        self.norms.append(docs.norms)

    def __len__(self) -> int:
        return len(self.shapes)

    def __iter__(self) -> Iterator[_Dense]:
        self.file.seek(0)
        for shape, norms in zip(self.shapes, self.norms):
            yield _Dense(np.frombuffer(self.file.read(4 * shape[0] * shape[1]), "float32").reshape(shape), norms)


class _Held:
    """Documents of one cell in the order of their ids, in slices that are searched one after another."""

    def __init__(self, kind: type[_Dense] | type[_Sparse]):
        self.kind, self.names, self.waiting, self.known = kind, [], [], {}
        self.slices: _Stored | list[_Sparse] = _Stored() if kind is _Dense else []
        self.most = DOCS_PER_PACK if kind is _Dense else SPARSE_DOCS

    def add(self, ids: pa.Array, column: pa.ListArray) -> None:
        self.names.append(ids.take(pa.array(np.arange(len(ids)))))  # a copy: a slice would keep the vectors of its batch
        at = 0
        while at < len(column):
            room = self.most - sum(map(len, self.waiting))
            self.waiting.append(self.kind.of(column.slice(at, room)))
            at += room
            if at <= len(column):
                self.close()

    def close(self) -> None:
        if self.waiting:
            docs = self.kind.merge(self.waiting)
            self.slices.append(docs.indexed() if self.kind is _Sparse else docs)
            self.waiting = []

    def ids(self) -> pa.Array:
        self.names = [pa.concat_arrays(self.names)]
        return self.names[0]

    def search(self, column: pa.ListArray, group: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, document and similarity of the k best documents of each group of queries, best first."""
        if self.kind is _Dense:
            rows, cols, values = self._best(_Dense.of(column), k)
        else:
            rows, cols, values = self._of_copies(column, k)
        return _cut([(group[rows], cols, values)], k) if group[-1] + 1 < len(group) else (rows, cols, values)

    def _of_copies(self, column: pa.ListArray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _best(); equal queries are searched once while their lists are kept."""
        cuts, flat = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten()
        terms, weights = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("term_id", "weight"))
        keys = [(terms[a:b].tobytes(), weights[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
        if len(self.known) > KEPT_LISTS or len(self.known) * k > 2 * HELD_ROWS:
            self.known = {}
        new = {key: n for n, key in enumerate(keys) if key not in self.known}
        if new:
            rows, cols, values = self._best(_Sparse.of(column.take(pa.array(list(new.values())))), k)
            ends = np.searchsorted(rows, np.arange(len(new) + 1))
            self.known |= {key: (cols[a:b], values[a:b]) for key, a, b in zip(new, ends[:-1], ends[1:])}
        lists = [self.known[key] for key in keys]
        rows = np.repeat(np.arange(len(keys)), [len(cols) for cols, _ in lists])
        return rows, np.concatenate([cols for cols, _ in lists]), np.concatenate([values for _, values in lists])

    def _pieces(self, k: int) -> Iterator[_Dense | _Sparse]:
        """The slices; of dense ones a few documents come first, whose lists are a floor for the rest."""
        for n, docs in enumerate(self.slices):
            first = max(FIRST_DOCS, FIRST_LISTS * k)
            if n or self.kind is _Sparse or first >= len(docs):
                yield docs
            else:
                yield from (_Dense(docs.raw[:first], docs.norms[:first]), _Dense(docs.raw[first:], docs.norms[first:]))

    def _best(self, queries: _Dense | _Sparse, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        floor = np.full(len(queries), -np.inf)
        found, size, base = [], 0, 0
        for n, docs in enumerate(self._pieces(k)):
            rows, cols, values = (np.concatenate(x) for x in zip(*queries.search(docs, floor, k), strict=True))
            found.append((rows, cols + base, values))
            size, base = size + len(rows), base + len(docs)
            if size >= (2 if n else 1) * k * len(queries):
                found = [_cut(found, k)]
                rows, _, values = found[0]
                size, last = len(rows), np.flatnonzero(_place(rows) == k - 1)
                floor[rows[last]] = values[last]
        return _cut(found, k)


def _place(rows: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its row, from 0; rows ascend."""
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]][:len(rows)])
    return np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))


def _cut(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each row, best first; equal ones in the order of the documents."""
    rows, cols, values = (np.concatenate(x) for x in zip(*found, strict=True))
    span = 1 << (63 - ROW_BITS - COLUMN_BITS)  # of similarities in units of their last digit, to both sides of 0
    if len(rows) and rows.max() < 1 << ROW_BITS and cols.max() < 1 << COLUMN_BITS and np.abs(values).max() * 10**DIGITS < span - 1:
        packed = (span - np.rint(values * 10**DIGITS)).astype("uint64") << np.uint64(COLUMN_BITS)
        packed |= (rows.astype("uint64") << np.uint64(64 - ROW_BITS)) | cols.astype("uint64")
        packed.sort()
        packed = packed[_place(packed >> np.uint64(64 - ROW_BITS)) < k]
        rows, cols = (packed >> np.uint64(64 - ROW_BITS)).astype("int64"), (packed & np.uint64((1 << COLUMN_BITS) - 1)).astype("int64")
        return rows, cols, (span - ((packed >> np.uint64(COLUMN_BITS)) & np.uint64(2 * span - 1)).astype("int64")) / 10**DIGITS
    order = np.lexsort((cols, -values, rows))
    order = order[_place(rows[order]) < k]
    return rows[order], cols[order], values[order]


class Judge(Protocol):
    """What topk() hands the lists of a cell to, before anything of them leaves it."""

    def columns(self, query_type: str, doc_type: str) -> str: ...  # of the rows it makes, as DDL

    def seat(self) -> Seat: ...  # called once in a task


class Seat(Protocol):
    def add(self, loads: pa.Array) -> None: ...  # of further documents, in the order of their ids

    def rows(self, names: pa.Array, loads: pa.Array, docs: pa.Array, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> pa.RecordBatch: ...


class _Lists:
    """The lists as rows (query_id, doc_id, similarity, rank): what happens to them without a judge."""

    def add(self, loads: pa.Array) -> None:
        pass

    def rows(self, names: pa.Array, loads: pa.Array, docs: pa.Array, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(rows)), docs.take(pa.array(cols)), pa.array(values), pa.array((_place(rows) + 1).astype("int32"))],
            names=["query_id", "doc_id", "similarity", "rank"])


class _Pool(_Lists):
    """The lists of a shelf of all documents and of one of marked documents as one, each id once at its highest similarity."""

    def __init__(self, kind: type[_Dense] | type[_Sparse], k: int):
        self.shelf, self.k, self.at, self.seen, self.first = _Held(kind), k, [], 0, None

    def mark(self, ids: pa.Array, column: pa.ListArray, marks: pa.Array) -> None:
        at = np.flatnonzero(marks.fill_null(False).to_numpy(zero_copy_only=False))
        if len(at):
            self.shelf.add(ids.take(pa.array(at)), column.take(pa.array(at)))
        self.at.append(at + self.seen)
        self.seen += len(ids)

    def rows(self, names: pa.Array, loads: pa.Array, docs: pa.Array, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        if self.first is None:
            code = docs.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            self.first = np.repeat(starts, np.diff(np.r_[starts, len(code)]))
        cols = self.first[cols]
        order = np.lexsort((-values, cols, rows))
        rows, cols, values = rows[order], cols[order], values[order]
        once = np.r_[True, (rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])][:len(rows)]
        return super().rows(names, loads, docs, rows[once], cols[once], values[once])


def _search_cell(kind: type[_Dense] | type[_Sparse], k: int, judge: Judge | None = None, marked: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over the rows of one cell: its documents by id, then its queries by id.

    The lists of the last id are carried to the next rows, which may bear the same id.
    """
    together = max(1, min(QUERIES_PER_PACK, HELD_ROWS // max(k, marked)))
    loaded = judge is not None or marked > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, carried, seat = _Held(kind), None, None, judge.seat() if judge else _Pool(kind, marked) if marked else _Lists()
        shelves = [(held, k), (seat.shelf, marked)] if marked else [(held, k)]

        def ended(names: pa.Array, loads: pa.Array, lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            if len(lists) > 1:
                lists = [lists[0], (lists[1][0], seat.at[lists[1][1]], lists[1][2])]
            return seat.rows(names, loads, docs, *(lists[0] if len(lists) == 1 else (np.concatenate(x) for x in zip(*lists))))

        for batch in batches:
            n_docs = batch.num_rows - int(batch.column("is_query").to_numpy(zero_copy_only=False).sum())
            if n_docs:
                held.add(batch.column("doc_id").slice(0, n_docs), batch.column("vec").slice(0, n_docs))
                if judge:
                    seat.add(batch.column("doc_load").slice(0, n_docs))
                elif marked:
                    seat.mark(*(batch.column(c).slice(0, n_docs) for c in ("doc_id", "vec", "doc_load")))
            if n_docs == batch.num_rows:
                continue
            if docs is None:
                for shelf, _ in shelves:
                    shelf.close()
                docs = held.ids() if held.slices else pa.array([], batch.column("doc_id").type)
                if marked:
                    seat.at = np.concatenate(seat.at) if seat.at else np.empty(0, "int64")
            if not len(docs):
                continue
            for lo in range(n_docs, batch.num_rows, together):
                part = batch.slice(lo, together)
                ids = part.column("query_id")
                code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(code)]))
                names = ids.take(pa.array(starts))
                loads = part.column("query_load").take(pa.array(starts)) if loaded else names
                lists = [shelf.search(part.column("vec"), group, most) for shelf, most in shelves if shelf.slices]
                if carried and carried[0].equals(names.slice(0, 1)):
                    lists = [_cut([before, found], most) for before, found, (_, most) in zip(carried[2], lists, shelves)]
                elif carried:
                    yield ended(*carried)
                last = [rows == len(names) - 1 for rows, _, _ in lists]
                yield ended(names, loads, [tuple(x[~at] for x in found) for at, found in zip(last, lists)])
                carried = names.slice(len(names) - 1), loads.slice(len(names) - 1), [
                    (np.zeros(int(at.sum()), found[0].dtype), found[1][at], found[2][at]) for at, found in zip(last, lists)]
        if carried:
            yield ended(*carried)

    return run


def topk(queries: DataFrame, docs: DataFrame, k: int, sparse: bool = False, spread: int = 1,
         query_limit: int = QUERY_LIMIT, judge: Judge | None = None, loads: tuple[DataFrame, DataFrame] | None = None,
         also: tuple[DataFrame, int] | None = None) -> DataFrame:
    """(query_id, doc_id, similarity, rank): the k most similar documents of every query, or what ``judge`` makes of them.

    ``queries`` and ``docs`` have columns id and vec; vec is an array of floats, or of
    struct<term_id, weight> when ``sparse``. Equal similarities are ranked by document id.

    ``spread`` splits the queries into that many blocks, when the documents are too few to keep a cluster busy and their copies small.
    Documents are copied once per block, queries once per salt.

    ``loads`` has (id, load) of queries and of documents, one row per id: what the judge reads of them, null where there is none.
    A judge sees final lists, so there is one salt then, whose documents wait in a file of the task.

    ``also`` has an id of documents per row and a length: the lists of these documents alone, of that length, join those of all, and a
    query's document comes out once, with its highest similarity. Ranks number the rows of a query only.
    """
    q_type, d_type = queries.schema["id"].dataType, docs.schema["id"].dataType
    vec_type, width = ("array<struct<term_id:int,weight:double>>", 12) if sparse else ("array<float>", 4)
    queries, docs = (df.select("id", F.col("vec").cast(vec_type).alias("vec")).filter(F.col("vec").isNotNull()) for df in (queries, docs))

    n_queries = queries.count()
    n_docs, cells = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    salts, slots = max(1, -(-width * cells // HELD_BYTES)), docs.sparkSession.sparkContext.defaultParallelism
    spread = max(1, min(spread, COPIED_BYTES * slots // max(1, width * cells)))
    whole = judge is not None or also is not None
    if whole:
        salts = 1
    most = CELL_PAIRS if sparse else max(1, CELL_PRODUCTS * n_docs // max(1, cells))
    blocks = max(spread, -(-n_queries // query_limit), -(-n_queries * n_docs // (salts * most)), slots if whole else 1)
    if blocks > slots:  # no round of tasks in which most slots have none
        blocks = -(-blocks // slots) * slots
    blocks = max(1, min(blocks, n_queries))
    if blocks * salts < slots and not whole:  # parts of the documents keep the rest busy, where their lists weigh less than the documents
        salts = max(salts, min(-(-slots // blocks), width * cells // max(1, LISTED_BYTES * k * n_queries)))

    def part(n: int) -> F.Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    of_query = of_doc = []
    if also:
        queries, docs = queries.withColumn("load", F.lit(None).cast("boolean")), docs.join(also[0].select("id", F.lit(True).alias("load")), "id", "left")
    elif judge:
        queries, docs = (df.join(load, "id", "left") for df, load in zip((queries, docs), loads))
    if whole:
        types = [df.schema["load"].dataType for df in (queries, docs)]
        of_query = [F.col("load").alias("query_load"), F.lit(None).cast(types[1]).alias("doc_load")]
        of_doc = [F.lit(None).cast(types[0]).alias("query_load"), F.col("load").alias("doc_load")]
    d = docs.select(part(salts).alias("salt"), every(blocks).alias("block"), F.lit(False).alias("is_query"),
                    F.lit(None).cast(q_type).alias("query_id"), F.col("id").alias("doc_id"), "vec", *of_doc)
    q = queries.select(every(salts).alias("salt"), part(blocks).alias("block"), F.lit(True).alias("is_query"),
                       F.col("id").alias("query_id"), F.lit(None).cast(d_type).alias("doc_id"), "vec", *of_query)
    rows = d.unionByName(q).withColumn("cell", F.col("block") * salts + F.col("salt"))
    rows = rows.repartitionById(blocks * salts, F.col("cell")).sortWithinPartitions("is_query", "query_id", "doc_id").drop("salt", "block", "cell")
    q_name, d_name = q_type.simpleString(), d_type.simpleString()
    found = rows.mapInArrow(
        _search_cell(_Sparse if sparse else _Dense, k, judge, also[1] if also else 0),
        judge.columns(q_name, d_name) if judge else f"query_id {q_name}, doc_id {d_name}, similarity double, rank int")
    if salts == 1:
        return found
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def dot(a: F.Column, b: F.Column) -> F.Column:
    """Dot product of two array columns, for pairs that are already joined."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: F.Column, b: F.Column) -> F.Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm)


def align_vectors(postings: DataFrame, vectors: DataFrame) -> DataFrame:
    """Postings with their stored vector, matched by id."""
    return postings.join(vectors, "job_id")


def vectors_are_stale(postings: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row telling whether some posting has no stored vector."""
    missing = postings.join(vectors.select("job_id"), "job_id", "left_anti")
    return missing.agg((F.count(F.lit(1)) > 0).alias("stale"), F.count(F.lit(1)).alias("missing"))
