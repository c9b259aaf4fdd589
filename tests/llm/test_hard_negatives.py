import math

import numpy as np
import pytest
from pyspark.sql import types as T

from rolefit.llm.hard_negatives import Packed, hard_negatives

KIND = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("score", T.StringType()), T.StructField("pack", T.StringType()), T.StructField("rank", T.StringType()),
])


def brute(rows):
    """Repeated anchors are one anchor, of the greatest vector."""
    clean = [
        (i, (y + 1) % 10 if i % 7 == 0 else y, [math.floor(256 * float(x)) for x in v]) for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    anchors = {}
    for i, y, v in clean:
        if i % 50 == 0 and (i not in anchors or (v, y) > anchors[i]):
            anchors[i] = (v, y)
    for a, (v, y) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in clean if i != a)
        for p, i, _ in [s for s in scored if s[2] == y][:5]:
            fits = [(n, j) for n, j, z in scored if z != y and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(a, i, r + 1, j, -p, -n) for r, (n, j) in enumerate(fits)]
    return sorted(out)


def test_all_anchors_against_brute_force(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    expected = brute(rows)
    assert sorted(map(tuple, hard_negatives(vectors).collect())) == expected and len(expected) > 50
    assert sorted(map(tuple, hard_negatives(vectors.repartition(13)).collect())) == expected


@pytest.mark.parametrize("size", [3, 200, 2**20, 2**26, 2**40])
def test_packed_products_are_exact(size):
    rng = np.random.default_rng(size)
    rows, anchors = rng.integers(-size, size + 1, (37, 6)), rng.integers(-size, size + 1, (5, 6))
    packed = Packed(rows, anchors.min(axis=0), anchors.max(axis=0))
    assert (packed.products(anchors).astype(object) == (anchors.astype(object) @ rows.T.astype(object))).all() if size < 2**30 else packed.kind is object
    assert packed.fields > 1 or size == 2**26 or size == 2**20


def test_equal_large_anchors_are_exact():
    rows, anchors = np.array([[3, 2**31 + 1], [5, 7]]), np.array([[2**30 + 1, 2**30 + 3]] * 2)
    assert (Packed(rows, anchors[0], anchors[0]).products(anchors) == anchors @ rows.T).all()


def test_odd_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, -0.5], i % 4, "x", "p", "r") for i in range(120)]
    rows += [(1000 + i, [1.0, 1.0, -0.5], 2, "x", "p", "r") for i in range(40)]  # ties
    rows += [(150, None, 1, "x", "p", "r"), (200, [None, 1.0, 2.0], 1, "x", "p", "r"), (250, [float("nan")] * 3, 1, "x", "p", "r"), (300, [float("inf"), 0.0, 0.0], 2, "x", "p", "r")]
    rows += [(None, [1.0, 1.0, 1.0], 1, "x", "p", "r"), (400, [1.0, 1.0, 1.0], None, "x", "p", "r"), (450, [2.0], 3, "x", "p", "r"), (550, [], 3, "x", "p", "r"), (None,) * 6]
    rows += [(650, [30000.0, 1.0, 0.0], 1, "x", "p", "r"), (650, [30000.0, 1.0, 0.0], 1, "x", "p", "r"), (61, [3e4, 1.0, 1.0], 1, "x", "p", "r")] * 2
    frame = spark.createDataFrame(rows, KIND)
    assert sorted(map(tuple, hard_negatives(frame).collect())) == brute([r[:3] for r in rows])
    assert hard_negatives(frame.limit(0)).count() == 0
    assert hard_negatives(frame.filter("vec_id % 50 <> 0")).count() == 0
