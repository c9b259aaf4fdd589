"""Streams against the batch operators they must equal."""

import os

import pytest
from pyspark.sql import functions as F

from rolefit.operators import dedup, learning
from rolefit.streaming import ingest, learner, runs


@pytest.fixture
def arrivals(spark):
    rows = [(i, f"k{i * i % 97}") for i in range(400)] + [(400 + i, "hot") for i in range(200)]
    return spark.createDataFrame(rows, "seq bigint, job_id string")


def test_stream_dedup_keeps_each_key_once(spark, arrivals, tmp_path):
    arrivals.repartitionByRange(4, "seq").write.json(f"{tmp_path}/in")
    stream = runs.read_landed(spark, f"{tmp_path}/in", arrivals.schema, max_files=2)
    query = runs.run_to_table(ingest.drop_repeats(stream, salts=4), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    out = spark.read.parquet(f"{tmp_path}/out")
    keys = sorted(r["job_id"] for r in out.collect())
    assert keys == sorted({r["job_id"] for r in arrivals.collect()})
    assert sum(rows for _, rows, _ in runs.progress(query)) == 600


@pytest.mark.parametrize("landed", ["in order", "mixed"])
def test_first_arrivals_whatever_order_files_land_in(spark, arrivals, tmp_path, landed):
    """Twenty batches in any order give the least row per key; none reads more than it brings, only news and corrections are stored."""
    arrivals.repartitionByRange(20, "seq").write.json(f"{tmp_path}/in")
    files = sorted(f"{tmp_path}/in/{f}" for f in os.listdir(f"{tmp_path}/in") if f.endswith(".json"))
    turns = list(range(20)) if landed == "in order" else [(7 * n + 11) % 20 for n in range(20)]
    for turn, n in enumerate(turns):
        os.utime(files[n], (1_700_000_000 + 60 * turn,) * 2)
    stream = runs.read_landed(spark, f"{tmp_path}/in", arrivals.schema, max_files=1)
    sink = ingest.Corrections(spark, f"{tmp_path}/out", "job_id", "seq")
    query = runs.run_batches(ingest.first_arrivals(stream, "job_id", "seq"), sink, f"{tmp_path}/checkpoint", "update")
    first = {}
    for r in sorted(arrivals.collect()):
        first.setdefault(r["job_id"], r["seq"])
    assert {r["job_id"]: r["seq"] for r in sink.kept().collect()} == first
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [30] * 20
    stored = spark.read.parquet(f"{tmp_path}/out").count()
    assert stored == len(first) if landed == "in order" else len(first) < stored < 600


def test_first_arrivals_of_repeated_rows(spark, tmp_path):
    """Null keys are one key, ties and copies give one row, and a batch that runs again replaces what it stored."""
    rows = spark.createDataFrame([(1, None, "a"), (0, None, "b"), (5, "x", "c"), (5, "x", "c"), (None, "y", "d")], "seq bigint, job_id string, note string")
    rows.coalesce(1).write.json(f"{tmp_path}/in")
    stream = runs.read_landed(spark, f"{tmp_path}/in", rows.schema)
    sink = ingest.Corrections(spark, f"{tmp_path}/out", "job_id", "seq")
    runs.run_batches(ingest.first_arrivals(stream, "job_id", "seq"), sink, f"{tmp_path}/checkpoint", "update")
    assert {(r["job_id"], r["seq"]) for r in sink.kept().collect()} >= {(None, 0), ("x", 5)}


def test_every_batch_is_counted(spark, arrivals, tmp_path):
    """More batches than the engine remembers."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        arrivals.repartitionByRange(9, "seq").write.json(f"{tmp_path}/in")
        sink = runs.CountedTable(spark, f"{tmp_path}/out")
        query = runs.run_batches(runs.read_landed(spark, f"{tmp_path}/in", arrivals.schema, max_files=1), sink, f"{tmp_path}/checkpoint")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(runs.progress(query)) < 9 and sink.counts().count() == 9
    assert sink.counts().agg(F.sum("rows")).first()[0] == 600


def test_bloom_filter_grows_and_loses_few(spark, tmp_path):
    """50,000 different keys through a filter made for 10,000: lost keys stay within twice the rate."""
    sink = ingest.BloomSink(spark, str(tmp_path), F.col("job_id"), "seq", expected=10_000, p=0.01)
    rows = spark.range(50_000).select((F.col("id") * 2 + 3_000_000).alias("seq"), F.concat(F.lit("k"), "id").alias("job_id"))
    for n in range(3):
        sink(rows.filter(F.pmod("seq", F.lit(3)) == n), n)
    kept = sink.kept()
    assert kept.count() >= 50_000 * 0.98 and kept.count() == kept.select("job_id").distinct().count()
    sink(rows, 3)
    assert sink.kept().filter("batch = 3").count() <= 50_000 - kept.filter("batch < 3").count()


def test_bloom_batches_write_their_own_bits(spark, tmp_path, monkeypatch):
    """After a large batch small ones store few buckets, but for the one that puts the filter together again."""
    monkeypatch.setattr(ingest.BloomSink, "COMPACT", 4)
    sink = ingest.BloomSink(spark, str(tmp_path), F.col("job_id"), "seq", expected=200_000, p=0.01)
    rows = spark.range(100_006).select(F.col("id").alias("seq"), F.concat(F.lit("k"), "id").alias("job_id"))
    sink(rows.filter("seq < 100000"), 0)
    for n in range(1, 6):
        sink(rows.filter(f"seq IN ({100_000 + n}, {n})"), n)
    stored = {r["batch"]: r["count"] for r in spark.read.parquet(sink.bits_path).filter("bucket IS NOT NULL").groupBy("batch").count().collect()}
    assert stored[0] > 50 and stored[4] == stored[0] and all(stored[n] <= 7 for n in (1, 2, 3, 5))
    assert sorted(r["seq"] for r in sink.kept().filter("batch > 0").collect()) == [100_000 + n for n in range(1, 6)]


def test_bloom_batches_equal_one_batch(spark, arrivals, tmp_path):
    """Two batches through the sink keep what the filter keeps when it reads everything at once."""
    sink = ingest.BloomSink(spark, str(tmp_path), F.col("job_id"), "seq", expected=1000, p=0.3)
    size = (sink._generation(0, 1000)["m"], sink._generation(0, 1000)["k"])
    sink(arrivals.filter("seq < 250"), 0)
    sink(arrivals.filter("seq >= 250"), 1)
    sink(arrivals.filter("seq >= 250"), 1)  # a repeated batch changes nothing
    verdict = dedup.bloom_verdict(arrivals, F.col("job_id"), "seq", size=size).filter(~F.col("dropped"))
    assert sorted(r["seq"] for r in sink.kept().collect()) == sorted(r["first_seq"] for r in verdict.collect())


def test_learner_batches_touch_their_own_profiles(spark, tmp_path):
    """States after three batches are those of one fold; a batch stores as many states as it has profiles."""
    rows = [(p, 100 * n + k, [((p * 7 + n * 3 + k + s) % 10) / 10 for s in range(8)], float((p + n + k) % 3 - 1)) for n in range(3) for p in range(n, 12 + n) for k in range(4)]
    schema = "profile_id bigint, seq bigint, x array<double>, reward double"
    events = spark.createDataFrame(rows, schema)
    fresh = learning.fresh_state(spark.createDataFrame([(p, None) for p in range(13)], "profile_id bigint, base_weights map<string,double>"))
    sink = learner.StateTable(spark, f"{tmp_path}/states")
    for n in range(3):
        events.filter(f"seq DIV 100 = {n}").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = runs.read_landed(spark, f"{tmp_path}/in", events.schema)
        runs.run_batches(learner.learner_states(stream, fresh), sink, f"{tmp_path}/checkpoint", "update")
    assert [r["count"] for r in spark.read.parquet(f"{tmp_path}/states").groupBy("batch").count().orderBy("batch").collect()] == [12, 12, 11]
    expected = {r["profile_id"]: r for r in learning.learner_fold(events, fresh).collect()}
    got = {r["profile_id"]: r for r in sink.states().collect()}
    assert got.keys() == expected.keys()
    for p, r in got.items():
        assert r["n_seen"] == expected[p]["n_seen"] and r["weights"] == pytest.approx(expected[p]["weights"], abs=1e-9)
