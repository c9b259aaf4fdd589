import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolefit.llm.toxicity import (
    _ORDER, CLASSES, channel, character_counts, fit, logistic, restore, restored_documents, restored_text, score_toxicity, tokens, toxicity_scores, trigrams,
)
from tests.llm.odd import documents, null_rows
from tests.llm.test_quality import auc

D = "/root/testdata/sf0.1"
DISGUISES = [
    lambda w: w.translate(str.maketrans("oieast", "0134$7")), lambda w: " ".join(w), lambda w: ".".join(w), lambda w: "".join(c * (4 if c in "aeiou" else 1) for c in w),
    lambda w: w.replace("i", "!").replace("a", "@").replace("o", "0"), lambda w: "-".join(w.upper().replace("O", "0")),
]
INSULTS = ["loser", "idiot", "pathetic", "scum", "worthless", "moron", "trash", "clown", "disgusting", "stupid"]


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return fit(*tables)


def test_character_counts_cover_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = Counter()
    for r in docs.collect():
        a = b = 0
        for c in (r.text or "") + "\n":
            k = 0 if not c.isalpha() else _ORDER.get(c.lower(), CLASSES - 1)
            expected[(a, b, k)] += 1
            a, b = (b, k) if k else (0, 0)
    got = character_counts(docs).reshape([CLASSES] * 3)
    del expected[0, 0, 0]
    assert {tuple(map(int, i)): int(got[tuple(i)]) for i in np.argwhere(got)} == dict(expected)


def test_path_is_the_cheapest_of_all(model):
    rng = np.random.default_rng(2)
    costs = model.letters.costs()

    def price(letters, extra):
        a = b = 0
        for c in [*letters, " "]:
            k = 0 if c == " " else _ORDER.get(c, CLASSES - 1)
            if k or b:
                extra += costs[(a * CLASSES + b) * CLASSES + k]
                a, b = (b, k) if k else (0, 0)
        return extra

    for token in ["1d10t", "l0$er", "s c u m", "m.0.r.0.n", "looooser", "a--b", "ß1é"] + ["".join(rng.choice(list("ab1$. 0"), 5)) for _ in range(20)]:
        ways = [channel(c, min(3, len(list(g)))) for c, g in itertools.groupby(token)]
        best = min((price([c for w in path for c in w[0]], sum(w[1] for w in path)), n) for n, path in enumerate(itertools.product(*ways)))
        words = restore(token, model.letters)
        options = [path for path in itertools.product(*ways) if "".join(c for w in path for c in w[0]).split() == words]
        assert min(price([c for w in path for c in w[0]], sum(w[1] for w in path)) for path in options) == pytest.approx(best[0])


def test_plain_words_stay_as_they_are(model):
    text = "Hello, the committee's well-known book — is it good? Über größe, 2024 ... aaa"
    assert restored_text(text, model.letters).startswith("hello the committee s well known book is it good über größe")
    assert tokens("a b c dd e f") == ["a b c", "dd", "e", "f"] and restored_text("", model.letters) == "" and restored_text("### *** 12", model.letters) == ""


def test_disguised_words_are_restored(model):
    whole = [restored_text(f(w), model.letters) == w for f in DISGUISES for w in INSULTS]
    assert np.mean(whole) > 0.8


def test_held_out_rows_are_told_apart(tables, model):
    docs, labels = tables
    rows = score_toxicity(docs, model).toPandas()
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    held = rows.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.97
    assert held[held.toxic == 1].predicted.mean() > 0.88 and held[held.toxic == 0].predicted.mean() < 0.01


def test_disguised_documents_are_found(spark, tables, model):
    docs, labels = tables
    held = docs.join(labels.filter("toxic = 1"), "doc_id").filter("lang = 'en' AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0").select("doc_id", "text").toPandas()
    held = held[[any(w in t.split() for w in INSULTS) for t in held.text]]
    hidden = [" ".join(DISGUISES[(i + n) % len(DISGUISES)](w) if w in INSULTS else w for n, w in enumerate(t.split(" "))) for i, t in enumerate(held.text)]
    rows = spark.createDataFrame(list(zip(held.doc_id.tolist(), hidden)), "doc_id long, text string")
    assert len(hidden) > 20 and score_toxicity(rows, model).agg(F.avg("predicted")).first()[0] > 0.85
    first = restored_documents(rows.limit(1), model.letters).first().restored
    assert sum(w in first.split() for w in INSULTS) >= 1


def test_regression_reaches_its_optimum():
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(size=(500, 3)), np.ones(500)]
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-x @ [2, -1, 0, 0.5]))).astype(float)
    b = logistic(x, y)
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ b)) - y) + np.r_[0.1, 0.1, 0.1, 1e-3] * b).max() < 1e-6


def test_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1), (3, 0), (None, 1), (5, None), (8, 1), (9, 0), (16, 1), (17, 0), (17, 0)], "doc_id long, toxic int")
    rows = toxicity_scores(documents(spark), labels).collect()
    assert len(rows) == documents(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity_scores(null_rows(spark), labels.limit(0)).filter("score = 0.5").count() == 4
    assert toxicity_scores(documents(spark, empty=True), labels).count() == 0
    long = spark.createDataFrame([(1, "1a" * 30_000), (2, "a b " * 20_000), (3, "x" * 100_000), (4, "\U0001d51e\U0001d51e\U0001d51e 1\U0001d51e")], "doc_id long, text string")
    assert toxicity_scores(long, labels).count() == 4 and len(trigrams("ab")) == CLASSES**3
