import math

import numpy as np
from pyspark.sql import types as T

from rolefit.llm.maxscore import maxscore_block, top_products


def brute(rows, k, every):
    clean = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in clean:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def test_all_vectors_against_brute_force(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert {tuple(r) for r in top_products(vectors).collect()} == brute(rows, 20, 20)


def test_odd_vectors(spark):
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])
    rows = [(i, [float(i % 3), 1.0, -0.5], "x") for i in range(50)]
    rows += [(100, None, "x"), (120, [None, 1.0, 2.0], "x"), (140, [float("nan")] * 3, "x"), (160, [float("inf"), 0.0, 0.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (180, [2.0], "x"), (200, [], "x"), (61, [3e7, 1.0, 1.0], "x")]
    frame = spark.createDataFrame(rows, kind)
    got = {tuple(r) for r in top_products(frame, k=7).collect()}
    assert got == brute([(i, v) for i, v, _ in rows], 7, 20)
    assert top_products(frame.limit(0)).count() == 0


def test_blocks_prune_without_loss():
    rng = np.random.default_rng(5)
    scale = np.geomspace(60, 1, 32)
    x = np.rint(rng.normal(size=(6000, 32)) * scale).astype(np.int64)
    x[3000:3100] = x[0]  # ties
    ids = rng.permutation(6000)
    q, qid = x[:40], ids[:40]
    row, found, score = maxscore_block(q, qid, x, ids, 10)
    for i in range(40):
        s = x @ q[i]
        best = sorted((-v, n) for v, n in zip(s.tolist(), ids.tolist()) if n != qid[i])[:10]
        assert sorted((-v, n) for v, n in zip(score[row == i].tolist(), found[row == i].tolist())) == best
