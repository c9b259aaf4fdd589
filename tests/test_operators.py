"""Operators against plain Python on small inputs, and plan checks."""

import hashlib
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.operators import dedup, evaluate, learning, lexical, ranking, retrieval, sampling
from rolefit.operators.analytics import count_min_sketch, exact_median, sketch_estimates
from rolefit.plans.inputs import Inputs


def plan_of(df):
    return df._jdf.queryExecution().toString()


def sequential_bloom(keys, p, minimum):
    n = max(len(keys), minimum)
    m = max(8, int(-n * math.log(p) / math.log(2) ** 2))
    k = max(1, int(m / n * math.log(2)))
    bits, seen, kept, lost = set(), set(), [], []
    for at, key in enumerate(keys):
        h1, h2 = (int(h(key.encode()).hexdigest(), 16) for h in (hashlib.md5, hashlib.sha1))
        places = [(h1 + i * h2) % m for i in range(k)]
        if all(x in bits for x in places):
            if key not in seen:
                lost.append(at)
        else:
            bits.update(places)
            kept.append(at)
        seen.add(key)
    return kept, lost


def test_bloom_equals_the_sequential_filter(spark):
    rng = np.random.default_rng(1)
    keys = [f"k{x}" for x in rng.integers(0, 1500, 2500)] + ["hot"] * 1200
    rng.shuffle(keys)
    kept, lost = sequential_bloom(keys, 0.3, 100)
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "seq bigint, key string")
    got = [r["seq"] for r in dedup.bloom_dedup(df, F.col("key"), "seq", 0.3, 100).collect()]
    wrong = [r["seq"] for r in dedup.bloom_false_positives(df, F.col("key"), "seq", 0.3, 100).collect()]
    assert sorted(got) == kept and sorted(wrong) == lost and lost


def test_exact_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"))
    out = dedup.first_per_key(df, "k", "seq")
    assert plan_of(out).count("WindowGroupLimit") >= 2
    assert sorted(r["seq"] for r in out.collect()) == list(range(7))


def vectors_df(spark, matrix, ids, id_type):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, matrix)], f"id {id_type}, vec array<float>")


@pytest.mark.parametrize("spread, limit", [(1, 1000), (4, 1000), (1, 8)])
def test_topk_equals_brute_force(spark, spread, limit):
    """Through the broadcast, the block and the grid path, with many equal vectors."""
    rng = np.random.default_rng(2)
    queries, docs = rng.normal(size=(20, 8)).astype("float32"), rng.normal(size=(300, 8)).astype("float32")
    docs[100:250] = docs[0]
    ids = [f"d{n:03d}" for n in range(300)]
    out = retrieval.topk(vectors_df(spark, queries, range(20), "bigint"), vectors_df(spark, docs, ids, "string").repartition(5),
                         25, spread=spread, query_limit=limit).collect()
    unit = [m.astype("float64") / np.linalg.norm(m.astype("float64"), axis=1, keepdims=True) for m in (queries, docs)]
    sims = np.round(unit[0] @ unit[1].T, 9)
    expected = {(q, r + 1): ids[d] for q in range(20) for r, d in enumerate(sorted(range(300), key=lambda d: (-sims[q, d], ids[d]))[:25])}
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in out} == expected


def test_topk_merges_packs_inside_a_task(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "DOCS_PER_PACK", 40)
    rng = np.random.default_rng(3)
    queries, docs = rng.normal(size=(3, 4)), rng.normal(size=(500, 4))
    out = retrieval.topk(vectors_df(spark, queries, range(3), "bigint"), vectors_df(spark, docs, range(500), "bigint").coalesce(1), 7)
    unit = [m.astype("float32").astype("float64") for m in (queries, docs)]
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in unit]
    best = np.argsort(-(unit[0] @ unit[1].T), axis=1)[:, :7]
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in out.collect()} == {(q, n + 1): best[q, n] for q in range(3) for n in range(7)}


def learn_in_python(start, events):
    w, b = list(start), [0.5] * 8
    for x, r in events:
        w = [max(0.0, wi + 0.15 * r * (xi - bi)) for wi, xi, bi in zip(w, x, b)]
        s = sum(w) or 1.0
        w, b = [v / s for v in w], [0.8 * bi + 0.2 * xi for bi, xi in zip(b, x)]
    return w


def test_learner_fold(spark):
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    start = [vocab.DEFAULT_WEIGHTS[s] for s in vocab.SIGNALS]
    for profile, n in ((1, 2000), (2, 3), (3, 1)):
        events = [([float(v) for v in rng.random(8)], float(rng.choice([1, -1, -0.2, 0]))) for _ in range(n)]
        expected[profile] = learn_in_python(start, events)
        rows += [(profile, i, x, r) for i, (x, r) in enumerate(events)]
    profiles = spark.createDataFrame([(p, None) for p in expected], "profile_id bigint, base_weights map<string,double>")
    events = spark.createDataFrame(rows, "profile_id bigint, seq bigint, x array<double>, reward double").repartition(7)
    got = {r["profile_id"]: r["weights"] for r in learning.learner_fold(events, learning.fresh_state(profiles)).collect()}
    for profile, weights in expected.items():
        assert got[profile] == pytest.approx(weights, abs=1e-9)


def test_weights_clipped_to_zero_stay_zero(spark):
    state = spark.createDataFrame([(1, [0.0] * 8, [0.5] * 8, 0, 0.15, 0.2)], learning.STATE_SCHEMA)
    events = spark.createDataFrame([(1, 0, [0.5] * 8, 1.0)], "profile_id bigint, seq bigint, x array<double>, reward double")
    row = learning.learner_fold(events, state).first()
    assert row["weights"] == [0.0] * 8 and row["n_seen"] == 1


def test_resumed_state_repairs_old_states(spark):
    profiles = spark.createDataFrame([(1, None), (2, None)], "profile_id bigint, base_weights map<string,double>")
    saved = spark.createDataFrame([(1, {"skills": 0.9}, [0.1], 5, 0.2)], "profile_id bigint, weights map<string,double>, baseline array<double>, n_seen bigint, lr double")
    rows = {r["profile_id"]: r for r in learning.resumed_state(profiles, saved).collect()}
    assert rows[1]["weights"][1] == 0.9 and rows[1]["weights"][0] == 0.38 and rows[1]["baseline"] == [0.5] * 8 and rows[1]["n_seen"] == 5
    assert rows[2]["n_seen"] == 0 and [rows[p]["epsilon"] for p in (1, 2)] == [0.2, 0.2]
    again = learning.resumed_state(profiles, saved.withColumn("epsilon", F.lit(0.05))).collect()
    assert {r["profile_id"]: r["epsilon"] for r in again} == {1: 0.05, 2: 0.2}


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_many_profiles_are_stepped_together(spark, batch):
    """Profiles that end, begin and go on across Arrow batches; one without a state, one without events, values that are missing."""
    rng = np.random.default_rng(6)
    start = [vocab.DEFAULT_WEIGHTS[s] for s in vocab.SIGNALS]
    rows, expected = [], {}
    for profile in range(1, 60):
        events = [([float(v) for v in rng.random(8)], float(rng.choice([1, -1, -0.2, 0]))) for _ in range(rng.integers(0, 12))]
        expected[profile] = [learn_in_python(start, events[:n + 1]) for n in range(len(events))]
        rows += [(profile, 10 * i, x, r) for i, (x, r) in enumerate(events)]
    odd = [(99, 1, [0.5] * 8, 1.0), (None, 1, [0.5] * 8, 1.0), (3, None, [0.5] * 8, 1.0), (3, 1, None, 1.0), (3, 1, [0.5] * 8, None)]
    events = spark.createDataFrame(rows + odd, "profile_id bigint, seq bigint, x array<double>, reward double").repartition(5)
    state = learning.fresh_state(spark.createDataFrame([(p, None) for p in expected], "profile_id bigint, base_weights map<string,double>"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        last = {r["profile_id"]: r for r in learning.learner_fold(events, state).collect()}
        steps = learning.learner_fold(events, state, every_step=True).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {p: (r["n_seen"], r["seq"]) for p, r in last.items()} == {p: (len(s), 10 * len(s) - 10) for p, s in expected.items() if s}
    assert all(last[p]["weights"] == pytest.approx(s[-1], abs=1e-12) for p, s in expected.items() if s)
    assert len(steps) == len(rows) and all(r["weights"] == pytest.approx(expected[r["profile_id"]][r["n_seen"] - 1], abs=1e-12) for r in steps)


def test_epsilon_zero_is_the_top_list(spark):
    scored = spark.createDataFrame([(p, n, f"j{n}") for p in (1, 2) for n in range(1, 21)], "profile_id bigint, rank int, job_id string")
    greedy = learning.epsilon_greedy(scored, 5, epsilon=0.0).orderBy("profile_id", "pick").collect()
    assert [r["job_id"] for r in greedy] == [f"j{n}" for n in range(1, 6)] * 2
    explored = learning.epsilon_greedy(scored, 25, epsilon=1.0).collect()
    assert len(explored) == 40 and len({(r["profile_id"], r["job_id"]) for r in explored}) == 40
    assert [r["from_rank"] for r in explored if r["profile_id"] == 1] != list(range(1, 21))


def test_bottom_k_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    hashed = sorted(range(5000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(r["id"] for r in sampling.bottom_k(df, F.col("id"), 321).collect()) == sorted(hashed[:321])
    assert sampling.bottom_k(df, F.col("id"), 9999).count() == 5000


@pytest.mark.parametrize("values", [[20000.0], [20000.0, 30000.0], [20000.0] * 5 + [20050.0] * 2 + [500000.0], [20010.0, 20020.0, 20030.0, 99999.5]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first()["median"] == np.median(values)
    assert exact_median(df.filter("v < 0"), "v").first()["median"] is None


def test_sketch_never_underestimates(spark):
    items = spark.range(5000).select((F.col("id") % 600).cast("string").alias("w"))
    assert all(r["cms_estimate"] >= r["exact"] for r in sketch_estimates(items, "w", 50).collect())
    assert count_min_sketch(items, "w").agg(F.sum("cnt")).first()[0] == 4 * 5000


def test_ndcg_without_overlap_is_zero(spark):
    rows = spark.createDataFrame([(1, 1, ["a"], ["b"]), (1, 2, ["c"], ["b"])], "profile_id bigint, rank int, skills array<string>, p_skills array<string>")
    assert evaluate.ndcg_at_k(rows).first()["ndcg_at_k"] == 0.0
    assert evaluate.precision_at_k(rows).first()["precision_at_k"] == 0.0


def test_acceptance_rounds_do_not_depend_on_spans(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 2)), i, str(rng.choice(["accept", "skip"]))) for i in range(500)]
    df = spark.createDataFrame(rows, "profile_id bigint, seq bigint, action string")
    a, b = (sorted(map(tuple, evaluate.acceptance_curve(df, 10, span).collect())) for span in (7, 10_000))
    assert a == b


def test_pluggable_encoder(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, "abc")], "id bigint, text string")
    out = lexical.embed_texts(texts, lambda: lambda batch: [[len(t), 1.0] for t in batch]).collect()
    assert {r["id"]: r["vec"] for r in out} == {1: [2.0, 1.0], 2: [3.0, 1.0]}


def test_hashed_vectors_have_unit_length(spark):
    texts = spark.createDataFrame([(1, "spark sql and spark"), (2, "")], "id bigint, text string")
    rows = {r["id"]: np.array(r["vec"]) for r in lexical.hashed_vectors(texts, 32).collect()}
    assert np.linalg.norm(rows[1]) == pytest.approx(1.0, abs=1e-6) and not rows[2].any() and len(rows[2]) == 32


def test_match_plan(spark, sf_dir):
    """No pair join is a nested loop, and no row-at-a-time or pandas expression runs per pair."""
    plan = plan_of(Inputs(spark, sf_dir).ranked.select("profile_id", "rank", "job_id", "score"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_empty_survivors_keep_the_schema(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    nothing = ranking.rank_topk(ranking.score(ranking.survivors(i.pairs.filter(F.lit(False)))))
    assert {"score", "breakdown", "rank"} <= set(nothing.columns) and nothing.count() == 0


def test_null_rules_are_off(spark, sf_dir):
    """A profile whose optional fields are null keeps every posting."""
    i = Inputs(spark, sf_dir)
    profile = i.profiles.limit(1)
    optional = [c for c in profile.columns if c not in ("profile_id", "name", "vec_id")]
    blank = profile.withColumns({c: F.lit(None).cast(profile.schema[c].dataType) for c in optional})
    postings = i.enriched.limit(40)
    found = postings.select("job_id").crossJoin(blank.select("profile_id")).withColumns({"similarity": F.lit(0.5), "candidate_rank": F.lit(1)})
    kept = ranking.rank_topk(ranking.score(ranking.survivors(ranking.pair_up(found, blank, postings))), 100)
    assert kept.count() == 40 and kept.filter("score IS NULL").count() == 0


def test_long_texts_join_the_shown_rows_only(spark, sf_dir):
    plan = Inputs(spark, sf_dir).ranked._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Window")]
    assert "description" not in above and "resume_text" not in above
    assert {"description", "url", "p_resume"} <= set(Inputs(spark, sf_dir).shown.columns)


def test_numbers_of_large_documents_do_not_collide(spark, tmp_path):
    """Postings and reposts stay apart, whatever the size of doc_id."""
    from rolefit.plans import landing

    ids = [0, 5, 999_995, 1_000_000, 1_000_005, 10_000_000_000, 2**40]
    rows = [(i, f"text of {i}", "en", "src1", 9) for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    raw = Inputs(spark, str(tmp_path)).raw
    numbers = [r.seq for r in raw.collect()]
    assert len(set(numbers)) == len(numbers) and {n >> 1 for n in numbers} == set(ids)
    dump, live = (sorted(r.seq for r in part(raw).collect()) for part in (landing.dump_part, landing.live_part))
    assert sorted([*dump, *live]) == sorted(numbers) and all(n % 2 == 0 for n in dump)


def test_pretty_skill_keeps_long_words(spark):
    from rolefit.functions.text import pretty_skill

    word = "a" * 3000 + " b"
    assert spark.createDataFrame([(word,)], "s string").select(pretty_skill(F.col("s"))).first()[0] == "A" + "a" * 2999 + " B"


def sparse_frame(spark, rows):
    return spark.createDataFrame([(i, [(int(t), float(w)) for t, w in r]) for i, r in enumerate(rows)], "id bigint, vec array<struct<term_id:int,weight:double>>")


@pytest.mark.parametrize("negative", [False, True])
def test_sparse_search_prunes_without_loss(spark, monkeypatch, negative):
    """Frequent light terms and rare heavy ones, ties, empty rows and unknown terms, over several packs."""
    monkeypatch.setattr(retrieval, "SPARSE_DOCS", 150)
    rng = np.random.default_rng(8)

    def rows(n, top):
        out = []
        for _ in range(n):
            t = np.unique(np.minimum(rng.geometric(0.05, rng.integers(0, 30)), top))
            w = np.round(rng.random(len(t)) * np.sqrt(t), 2) - (0.5 if negative else 0.0)
            out.append(list(zip(t, w)))
        return out

    docs, queries = rows(600, 90), rows(40, 100)
    docs[10] = docs[20] = docs[30]
    got = retrieval.topk(sparse_frame(spark, queries), sparse_frame(spark, docs).coalesce(1), 9, sparse=True).collect()
    table = [dict(d) for d in docs]
    for q, query in enumerate(queries):
        scored = sorted((-round(sum(w * d.get(t, 0.0) for t, w in query), 9), i) for i, d in enumerate(table))[:9]
        mine = sorted((r["rank"], r["doc_id"], r["similarity"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in mine] == [i for _, i in scored] and [s for _, _, s in mine] == pytest.approx([-s for s, _ in scored])


def test_sparse_search_holds_no_dense_matrix():
    """20,000 terms by 8,192 documents: 1.3 GB as a matrix."""
    rng = np.random.default_rng(9)
    owner = np.repeat(np.arange(8192), 60)
    docs = retrieval._Sparse(pa.array(range(8192)), owner, rng.integers(0, 20_000, len(owner)).astype("int32"), rng.random(len(owner)))
    mine = np.repeat(np.arange(200), 100)
    queries = retrieval._Sparse(pa.array(range(200)), mine, rng.integers(0, 20_000, len(mine)).astype("int32"), rng.random(len(mine)))
    tracemalloc.start()
    found = sum(len(r) for r, _, _ in queries.search(docs, np.full(200, -np.inf), 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 2000 and peak < 64 << 20


def test_no_text_is_shuffled(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    texts = i.table("documents").select(F.col("doc_id").alias("id"), "text")
    counts = lexical.term_counts(texts, lexical.stop_words())
    for frame in (lexical.hashed_weights(texts), lexical.hashed_vectors(texts), lexical.tfidf_vectors(counts, lexical.vocabulary(texts, counts).collect())):
        assert "Exchange" not in plan_of(frame)
    exchanged = [line for line in plan_of(lexical.vocabulary(texts, counts)).splitlines() if "Exchange" in line]
    assert exchanged and not any("text" in line or "id#" in line for line in exchanged)


def test_encoder_interface_gives_the_hashed_vectors(spark, sf_dir):
    texts = Inputs(spark, sf_dir).table("documents").select(F.col("doc_id").alias("id"), "text")
    dense = {r["id"]: r["vec"] for r in lexical.embed_texts(texts, lexical.HashingEncoder, kind="double").collect()}
    cells = {(r["id"], r["bucket"]): r["weight"] for r in lexical.hashed_weights(texts).collect()}
    assert {(i, n): v for i, vec in dense.items() for n, v in enumerate(vec) if v} == cells
