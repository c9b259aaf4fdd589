import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from rolefit.operators import retrieval


def frame(spark, ids, matrix, kind):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, matrix)], f"id {kind}, vec array<float>")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute(query_ids, queries, doc_ids, docs, k):
    unit = [m.astype("float32").astype("float64") for m in (queries, docs)]
    sims = np.round((unit[0] / np.linalg.norm(unit[0], axis=1, keepdims=True)) @ (unit[1] / np.linalg.norm(unit[1], axis=1, keepdims=True)).T, 9)
    lists = {}
    for q, name in enumerate(query_ids):
        lists.setdefault(name, []).extend((-sims[q, d], doc) for d, doc in enumerate(doc_ids))
    return {(name, n + 1): (doc, -s) for name, found in lists.items() for n, (s, doc) in enumerate(sorted(found)[:k])}


@pytest.mark.parametrize("salts, limit", [(1, 1000), (4, 1000), (3, 7)])
def test_cells_equal_brute_force(spark, monkeypatch, salts, limit):
    """Over salts and blocks, with equal vectors and with queries that share an id."""
    rng = np.random.default_rng(4)
    queries, docs = rng.normal(size=(30, 6)), rng.normal(size=(200, 6))
    docs[50:120] = docs[3]
    monkeypatch.setattr(retrieval, "HELD_BYTES", 200 * 6 * 4 // salts)
    query_ids, doc_ids = [n // 2 if n < 10 else n for n in range(30)], [f"d{n:03d}" for n in range(200)]
    out = retrieval.topk(frame(spark, query_ids, queries, "bigint"), frame(spark, doc_ids, docs, "string"), 90, query_limit=limit)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["similarity"]) for r in out.collect()}
    assert got == brute(query_ids, queries, doc_ids, docs, 90)


def test_sides_meet_without_a_join(spark):
    """A join hands the documents to a task once per pack of queries and may broadcast either side."""
    rng = np.random.default_rng(5)
    rows = frame(spark, range(50), rng.normal(size=(50, 4)), "bigint")
    plan = plan_of(retrieval.topk(rows, rows, 3, query_limit=10))
    assert "Join" not in plan and "Broadcast" not in plan and "Window" not in plan


def batches(queries, docs):
    """Rows of one cell as Spark passes them on."""
    def batch(is_query, lo, vec):
        n = len(vec)
        ids, none = pa.array(range(lo, lo + n), pa.int64()), pa.nulls(n, pa.int64())
        column = pa.ListArray.from_arrays(np.arange(0, vec.size + 1, vec.shape[1], dtype="int32"), pa.array(vec.ravel()))
        return pa.RecordBatch.from_arrays([pa.array([is_query] * n), ids if is_query else none, none if is_query else ids, column],
                                          names=["is_query", "query_id", "doc_id", "vec"])
    for lo in range(0, len(docs), 1000):
        yield batch(False, lo, docs[lo:lo + 1000])
    for lo in range(0, len(queries), 1000):
        yield batch(True, lo, queries[lo:lo + 1000])


def test_memory_of_a_cell_does_not_grow_with_the_queries():
    rng = np.random.default_rng(6)
    docs = rng.normal(size=(3000, 8)).astype("float32")

    def peak(n):
        queries = rng.normal(size=(n, 8)).astype("float32")
        tracemalloc.start()
        rows = sum(b.num_rows for b in retrieval._search_cell(retrieval._Dense, 200)(batches(queries, docs)))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == 200 * n
        return most

    few, many = peak(4000), peak(16000)
    assert many < 1.2 * few < 400 << 20


def test_memory_of_a_cell_does_not_grow_with_the_documents(monkeypatch):
    """Those beyond KEPT_BYTES are read a slice at a time; the lists are the same."""
    rng = np.random.default_rng(7)
    queries = rng.normal(size=(20, 32)).astype("float32")
    for name, value in {"DOCS_PER_PACK": 2048, "CELLS_PER_SLICE": 20_000, "FIRST_DOCS": 64}.items():
        monkeypatch.setattr(retrieval, name, value)

    def run(docs, kept):
        monkeypatch.setattr(retrieval, "KEPT_BYTES", kept, raising=False)
        rows = list(batches(queries, docs))
        tracemalloc.start()
        found = [x for b in retrieval._search_cell(retrieval._Dense, 5)(iter(rows)) for x in zip(*(c.to_pylist() for c in b.columns))]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, found

    docs = rng.normal(size=(80_000, 32)).astype("float32")
    (few, _), (many, found) = run(docs[:20_000], 1 << 20), run(docs, 1 << 20)
    assert many < 1.3 * few and found == run(docs, 1 << 30)[1]


@pytest.mark.parametrize("k", [3, 20, 150])
def test_a_few_documents_set_the_floor_for_the_rest(spark, monkeypatch, k):
    """The first slice is no longer ranked as a whole, whatever is tied across its pieces."""
    rng = np.random.default_rng(6)
    queries, docs = rng.normal(size=(25, 5)), rng.normal(size=(160, 5))
    docs[10:90] = docs[3]
    monkeypatch.setattr(retrieval, "FIRST_DOCS", 16)
    monkeypatch.setattr(retrieval, "FIRST_LISTS", 1)
    ranked, best = [], retrieval._best
    monkeypatch.setattr(retrieval, "_best", lambda scores, floor, n: ranked.append(scores.shape[1]) or best(scores, floor, n))
    column = lambda m: pa.ListArray.from_arrays(np.arange(0, m.size + 1, 5, dtype="int32"), pa.array(m.astype("float32").ravel()))
    held = retrieval._Held(retrieval._Dense)
    held.add(pa.array(range(160)), column(docs))
    held.close()
    rows, cols, values = held.search(column(queries), np.arange(25), k)
    got = {(r, n + 1): (c, v) for r, n, c, v in zip(rows.tolist(), retrieval._place(rows).tolist(), cols.tolist(), values.tolist())}
    assert got == brute(range(25), queries, range(160), docs, k) and max(ranked) == max(16, k)
