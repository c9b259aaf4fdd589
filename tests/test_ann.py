import numpy as np
import pytest
from pyspark.sql import functions as F

from rolefit.operators import ann, retrieval
from rolefit.plans.catalog import QUERIES


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in m]) for i, m in zip(ids, matrix)], "id bigint, vec array<float>")


def both(queries, docs, k, fitted):
    found, exact = ann.ann_topk(queries, docs, k, fitted), retrieval.topk(queries, docs, k)
    return found, exact, ann.recall(found, exact).first()["recall"]


def test_recall_of_clustered_vectors_with_few_rows_scored(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(40, 1, 16)) * 2 + rng.normal(size=(40, 50, 16)) * 0.5).reshape(-1, 16)
    docs = frame(spark, x).repartition(5)
    fitted = ann.fit_lists(docs, 10)
    found, _, share = both(docs, docs, 10, fitted)
    work = ann.rows_scored(docs, docs, 10, fitted).first()
    assert share >= 0.9 and work["exact"] == 2000 * 2000 and work["scored"] < 0.3 * work["exact"]
    assert found.groupBy("query_id").count().filter("count <> 10").count() == 0


def test_recall_on_the_given_vectors(spark):
    row = QUERIES["ann_recall"](spark, "/root/testdata/sf0.1").first()
    assert row["recall"] >= 0.9 and row["scored"] < row["exact"]


def test_small_parts_and_all_probes_are_exact(spark, monkeypatch):
    """Split on both sides and probing every list, the search is the exact one, ties by id included."""
    monkeypatch.setattr(ann, "PART_DOCS", 20)
    monkeypatch.setattr(ann, "PART_QUERIES", 7)
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (300, 3)).astype(float)
    x[0] = 0
    docs = frame(spark, x, rng.permutation(300))
    fitted = ann.fit_lists(docs, 5, lists=6)
    found, exact, _ = both(docs.filter("id < 60"), docs, 5, ann.Lists(fitted.centres, len(fitted.centres)))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.select(found.columns).collect()))


def test_copies_never_meet_in_pairs(spark):
    """A third of all rows hold one vector: it is searched once, and k of its rows are held."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 600, axis=0), rng.normal(size=(1200, 8))])
    docs = frame(spark, x)
    fitted = ann.fit_lists(docs, 10)
    found, _, share = both(docs, docs, 10, fitted)
    assert share >= 0.85 and ann.rows_scored(docs, docs, 10, fitted).first()["scored"] < 1300 * 1300
    same = found.filter("query_id < 600").groupBy("query_id").agg(F.sort_array(F.collect_list("doc_id")).alias("d")).select("d").distinct().collect()
    assert [r["d"] for r in same] == [list(range(10))]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.0, 0.0])], [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None)]])
def test_odd_vectors(spark, rows):
    docs = spark.createDataFrame(rows, "id bigint, vec array<float>")
    out = ann.ann_topk(docs, docs, 3).collect()
    assert {r["query_id"] for r in out} == {i for i, v in rows if v is not None}


def test_a_query_travels_once_to_a_group_of_lists(spark):
    rng = np.random.default_rng(4)
    docs = frame(spark, rng.normal(size=(300, 4)))
    centres = ann.fit_lists(docs, 5, lists=60).centres
    fitted = ann.Lists(centres, len(centres))
    q, d = ann._cells(fitted, docs.filter("id < 20"), docs)
    held = {n for r in d.collect() for n in r.lists}
    sent = {}
    for r in q.collect():
        sent.setdefault(r.id, []).append(r.lists)
    assert d.count() == 300 and len(sent) == 20 and all(len(rows) <= len(held) / 2 for rows in sent.values())
    assert all(sorted(n for lists in rows for n in lists) == sorted(held) for rows in sent.values())
