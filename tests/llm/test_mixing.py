import re

import numpy as np
import pytest

from rolefit.llm import mixing
from rolefit.llm.mixing import mix, mixed_documents, sainte_lague, targets_of
from tests.llm.odd import documents, null_rows


def by_quotients(votes, seats, caps):
    pool = sorted(((-v / (2 * k - 1), i) for i, (v, c) in enumerate(zip(votes, caps)) for k in range(1, c + 1) if v > 0))
    given = [0] * len(votes)
    for _, i in pool[:seats]:
        given[i] += 1
    return given


def test_seats_are_the_highest_quotients():
    rng = np.random.default_rng(3)
    for _ in range(60):
        votes = rng.integers(0, 50, rng.integers(1, 9)).astype(float)
        caps = rng.integers(0, 30, len(votes))
        seats = int(rng.integers(0, 60))
        assert list(sainte_lague(votes, seats, caps)) == by_quotients(votes, seats, caps)


def test_targets_never_exceed_the_cap():
    target = targets_of(np.array([10, 1000, 0, 5]), np.array([5.0, 2, 1, 5]), 3)
    assert target.tolist() == [30, 970, 0, 15] and target.sum() == 1015


@pytest.mark.parametrize("block", [8, 64])
def test_mix_comes_near_its_targets(spark, sf_dir, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mix(docs, block=block).toPandas()
    text = docs.select("doc_id", "text", "source").toPandas().set_index("doc_id")
    size = text.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    rows = rows.set_index("doc_id")
    assert (rows["size"] == size.reindex(rows.index)).all() and (rows.taken <= 3 * rows["size"]).all() and (rows.taken >= 0).all()
    sums = rows.groupby("source").agg(taken=("taken", "sum"), size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"))
    assert (sums["size"] == sums.source_size).all() and sums.target.sum() == pytest.approx(size.sum())
    names = sorted(sums.index)
    expected = targets_of(sums.source_size[names].to_numpy(), np.array([(5.0, 2, 1)[i % 3] for i in range(len(names))]), 3)
    assert sums.target[names].to_numpy() == pytest.approx(expected)
    assert (abs(sums.taken - sums.target) <= 4 * block + 0.01 * sums.target).all()
    again = mix(docs, block=block).toPandas().set_index("doc_id")
    assert (again.taken == rows.taken.reindex(again.index)).all()


def test_documents_of_the_mix_hold_the_words_taken(spark):
    docs = documents(spark)
    taken = {r.doc_id: r.taken for r in mix(docs, block=4, shard_words=100).collect()}
    out = mixed_documents(docs, block=4, shard_words=100).toPandas()
    assert list(out.columns) == docs.columns
    words = out.assign(n=out.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))).groupby("doc_id").n.sum()
    assert {k: v for k, v in taken.items() if v} == words.to_dict()


def test_any_number_of_sources(spark, monkeypatch):
    """The plan by sums is that of one task: capped and empty sources, ties, a null and a hot source."""
    rows = [(i, " ".join(["w"] * (i * 7 % 300)), None if i % 50 == 0 else "hot" if i % 3 == 0 else f"s{i % 140:03d}") for i in range(600)]
    rows += [(600 + i, " ".join(["w"] * 100), f"tie{i:03d}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    known = {r.doc_id: r for r in mix(docs, block=8).collect()}
    monkeypatch.setattr(mixing, "MAX_SOURCES", 10)
    found = {r.doc_id: r for r in mix(docs, block=8).collect()}
    assert len(known) == len(found) == len(rows)
    for i, r in known.items():
        assert found[i].target == pytest.approx(r.target) and (found[i].source_size, found[i].taken) == (r.source_size, r.taken)


@pytest.mark.parametrize("planner", ["one task", "sums"])
def test_small_sources_come_near_their_targets(spark, monkeypatch, planner):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 10 if planner == "sums" else 10**6)
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(["w"] * int(rng.integers(3, 91))), f"s{i:04d}") for i in range(300)] + [(1000 + i, " ".join(["w"] * 50), "s0003x") for i in range(200)]
    out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    sums = out.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(sums.taken - sums.target) <= np.maximum(1, 0.05 * sums.target)).all() and (out.taken <= 3 * out["size"]).all()


def test_odd_rows(spark):
    assert mix(documents(spark, empty=True)).count() == 0 and mixed_documents(documents(spark, empty=True)).count() == 0
    assert sorted(r["size"] for r in mix(null_rows(spark)).collect()) == [0, 0, 2, 2]
