"""Judging in the cells of retrieval against the column expressions, on rows with nulls, copies and ties."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.operators import judging, ranking, retrieval, scoring

POSTING = """job_id string, title string, company string, location string, country string, salary_min double, salary_max double, description string,
 skills array<string>, url string, source string, seniority string, years_required int, is_contract boolean, sponsors_visa boolean,
 is_defense boolean, company_size string, salary_value double"""
PROFILE = """profile_id bigint, name string, resume_text string, skills array<string>, target_roles array<string>, locations array<string>,
 preferred_locations array<string>, exclude_industries array<string>, emphasis array<string>, us_only boolean, min_salary double, max_seniority string,
 min_seniority string, max_years_required int, no_contract boolean, needs_visa_sponsor boolean, min_company_size string, base_weights map<string,double>"""


def picked(rng, values):
    return values[int(rng.integers(len(values)))]


def listed(rng, values, most=4):
    return picked(rng, [None, *[[picked(rng, values) for _ in range(rng.integers(most))] for _ in range(5)]])


def odd_inputs(spark, n_posts=60, n_people=14):
    rng = np.random.default_rng(3)
    flag, skills = [True, False, None], ["sql", "python", "c++", None, "r"]
    posts = [(f"j{n:02d}", picked(rng, ["Senior ML Engineer", "Data Analyst", "", "C++ / SQL engineer engineer"]), "c",
              picked(rng, ["New York, NY", "Remote", "remote (US)", "Chicago", "", None]), picked(rng, ["US", "", "IN", None]), None, None, "d",
              listed(rng, skills), f"u{n}", "s", picked(rng, ["junior", "mid", "senior", "staff", None]), picked(rng, [None, 0, 3, 12]), picked(rng, flag),
              picked(rng, flag), picked(rng, flag), picked(rng, ["large", "small", "unknown", None]), picked(rng, [None, 0.0, 9e4, 123456.5, float("nan")]))
             for n in range(n_posts)]
    people = [(n // 2 if n < 6 else n, "n", f"r{n}", listed(rng, skills), listed(rng, ["ML engineer", "analyst", "Engineer Engineer", ""]),
               listed(rng, ["remote", "New York", "chicago", None], 3), listed(rng, ["remote", "york", None], 3), listed(rng, ["Defense", None, "x"], 3), None,
               picked(rng, flag), picked(rng, [None, 0.0, 9e4, 1e5]), picked(rng, [None, "", "mid", "senior"]), picked(rng, [None, "", "mid"]),
               picked(rng, [None, 0, 3]), picked(rng, flag), picked(rng, flag), picked(rng, [None, "large", "small"]),
               picked(rng, [None, {"skills": 0.3, "similarity": 0.45, "title": 1 / 3, "location": 0.1}]))
              for n in range(n_people)]
    people.append(people[-1])
    v = lambda: [float(x) for x in rng.normal(size=5)]
    post_vectors = [(f"j{n:02d}", v()) for n in range(n_posts + 3)] + [("j05", v())]  # three without a posting, one twice
    people_vectors = [(p, v()) for p in sorted({p[0] for p in people} - {1})] + [(0, v()), (99, v())]  # one with two, one without a profile
    return (spark.createDataFrame(people, PROFILE), spark.createDataFrame(people_vectors, "profile_id bigint, vec array<float>"),
            spark.createDataFrame(posts, POSTING), spark.createDataFrame(post_vectors, "job_id string, vec array<float>"))


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    profiles, profile_vectors, postings, posting_vectors = frames = odd_inputs(spark)
    cells = ranking.Cells(*frames, n=25, spread=3)
    pairs = ranking.pair_up(ranking.candidates(profile_vectors, posting_vectors, 25), profiles, postings).localCheckpoint()
    return cells, pairs


KEYS = ["profile_id", "job_id", "similarity", "candidate_rank"]


def test_rules_and_signals_equal_their_expressions(odd):
    cells, pairs = odd
    rules, signals = tuple(scoring.HARD_FILTERS), tuple(vocab.SIGNALS)
    got = cells.asking(rules=rules, signals=signals, overlap=True).rows()
    want = pairs.withColumn("b", scoring.signals()).select(
        *KEYS, *[rule().alias(f) for f, rule in scoring.HARD_FILTERS.items()], *[F.col(f"b.{s}").alias(f"sig_{s}") for s in signals],
        F.size(F.array_intersect("skills", "p_skills")).alias("n_overlap"), F.size(F.array_distinct("skills")).alias("n_job"))
    assert rows_of(got.drop("p_copy")) == rows_of(want) and got.count() > 300


def test_survivors_scores_ranks_and_counts_equal_the_joins(spark, odd):
    cells, pairs = odd
    barred = spark.createDataFrame([(p, f"j{n:02d}") for p in (0, 2, 7, 50) for n in range(0, 60, 3)], "profile_id bigint, job_id string")
    for excluded in (None, barred):
        kept, rows = ranking.survivors(cells, excluded), ranking.survivors(pairs, excluded)
        assert rows_of(kept.rows().select(*KEYS)) == rows_of(rows.select(*KEYS)) and rows.count() > 20
        columns = [*KEYS, "breakdown", "score"]
        assert rows_of(ranking.score(kept).rows().select(*columns)) == rows_of(ranking.score(rows).select(*columns))
        for k in (2, 100):
            some = ["profile_id", "rank", "job_id", "score"]
            assert rows_of(ranking.rank_topk(ranking.score(kept), k).select(*some)) == rows_of(ranking.rank_topk(ranking.score(rows), k).select(*some))
    found = ranking.candidates(cells.profile_vectors, cells.posting_vectors, 25)
    assert rows_of(ranking.rank_counts(cells)) == rows_of(ranking.rank_counts(found, pairs))


def test_ranked_rows_get_the_profile_row_they_were_judged_by(odd):
    cells, pairs = odd
    top = ranking.with_attributes(ranking.rank_topk(ranking.score(ranking.survivors(cells)), 500), cells.profiles, cells.postings)
    columns = [*KEYS, "score", "title", "skills", "p_skills", "p_roles", "p_weights", "p_min_salary"]
    assert rows_of(top.select(*columns)) == rows_of(ranking.score(ranking.survivors(pairs)).select(*columns))


def test_no_candidate_pair_is_exchanged(odd):
    """Behind the cells there is nothing to exchange; rows are cut to the best of a profile before the window."""
    cells, _ = odd
    for frame in (ranking.survivors(cells).rows(), ranking.rank_counts(cells), cells.asking(rules=("f_salary",)).rows()):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Join" not in plan[:plan.index("MapInArrow")] and "Window" not in plan[:plan.index("MapInArrow")]
    assert ranking.score(ranking.survivors(cells)).asking(best=2).rows().groupBy("profile_id").count().agg(F.max("count")).first()[0] == 2


def test_halves_round_as_in_spark(spark):
    values = [0.1234567890125, 0.1234567890135, -0.1234567890125, 0.5, 1 / 3, 0.9999999999995, 0.0000000000005, 2.5e-13]
    want = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 12)).collect()]
    assert judging.half_up(np.array(values)).tolist() == want


def test_a_pool_has_each_posting_once(spark):
    rng = np.random.default_rng(8)
    frame = lambda ids, kind: spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in ids], f"{kind}, vec array<float>")
    people = frame([0, 0, *range(1, 30)], "profile_id bigint")
    posts = frame([f"j{n:03d}" for n in range(150)] + ["j007", "j008"], "job_id string")
    drawn = spark.createDataFrame([(f"j{n:03d}",) for n in range(0, 150, 7)], "job_id string")
    near = ranking.candidates(people, posts, 12).unionByName(ranking.candidates(people, posts.join(drawn, "job_id"), 12))
    want = near.groupBy("profile_id", "job_id").agg(F.max("similarity").alias("similarity"))
    got = ranking.pool(people, posts, drawn, 12)
    assert rows_of(got) == rows_of(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[:plan.index("MapInArrow")]
    assert rows_of(ranking.pool(people, posts, drawn.limit(0), 12)) == rows_of(ranking.candidates(people, posts, 12).groupBy("profile_id", "job_id").agg(F.max("similarity").alias("similarity")))


@pytest.mark.parametrize("share", [1, 10**9])
def test_single_precision_loses_no_pair(monkeypatch, share):
    """Similarities that differ by less than its error, ties and vectors without length, scored again one by one or together."""
    monkeypatch.setattr(retrieval, "HIT_SHARE", share)
    rng = np.random.default_rng(2)
    docs, queries = np.repeat(rng.normal(size=(40, 16)), 50, axis=0), rng.normal(size=(30, 16))
    docs[::3] += rng.normal(size=docs[::3].shape) * 1e-6
    docs[5:9] = 0
    docs, queries = docs.astype("float32"), queries.astype("float32")
    unit = [m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n) for m in (docs.astype("float64"), queries.astype("float64"))]
    sims = np.round(unit[1] @ unit[0].T, 9)
    monkeypatch.setattr(retrieval, "FIRST_DOCS", 64)
    monkeypatch.setattr(retrieval, "FIRST_LISTS", 1)
    monkeypatch.setattr(retrieval, "DOCS_PER_PACK", 300)
    held = retrieval._Held(retrieval._Dense)
    column = lambda m: pa.ListArray.from_arrays(np.arange(0, m.size + 1, 16, dtype="int32"), pa.array(m.ravel()))
    held.add(pa.array(range(len(docs))), column(docs))
    held.close()
    rows, cols, values = held.search(column(queries), np.arange(30), 70)
    for q in range(30):
        want = np.lexsort((np.arange(len(docs)), -sims[q]))[:70]
        assert cols[rows == q].tolist() == want.tolist() and values[rows == q].tolist() == sims[q][want].tolist()


def test_no_text_is_exchanged_for_features(spark, sf_dir):
    from rolefit.plans.inputs import Inputs

    plan = Inputs(spark, sf_dir).enriched.select("job_id", "seniority", "skills")._jdf.queryExecution().optimizedPlan().toString()
    assert "description" not in plan[:plan.index("Window")] and "description" not in plan[plan.index("Window"):].splitlines()[0]
