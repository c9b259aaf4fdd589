import zlib

import numpy as np

from rolefit.llm.quality import FEATURES, isotonic, keep_good, quality_scores, statistics
from tests.llm.odd import documents, null_rows


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(len(y))
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_rows_are_told_apart(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).toPandas()
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    held = rows.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert (held.predicted == held.quality).mean() > 0.93
    good = held[held.quality == 1]
    assert good.predicted.mean() > 0.98


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(1)
    y, w = rng.uniform(size=40), rng.integers(1, 9, 40).astype(float)
    expected = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(isotonic(y, w), expected)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1), (3, 0), (None, 1), (5, None), (8, 1), (9, 0), (16, 1), (17, 0)], "doc_id long, quality int")
    assert len(statistics("a b")) == len(FEATURES)
    rows = quality_scores(documents(spark), labels).collect()
    assert len(rows) == documents(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_scores(null_rows(spark), labels.limit(0)).filter("score BETWEEN 0.4 AND 0.6").count() == 4
    assert quality_scores(documents(spark, empty=True), labels).count() == 0
    kept = keep_good(documents(spark), labels)
    assert kept.columns == documents(spark).columns and kept.count() <= documents(spark).count()
