import re

import numpy as np

from rolefit.llm import minhash
from rolefit.llm.components import components
from rolefit.llm.minhash import keep_one, near_duplicates, shingle_set, signature
from tests.llm.odd import documents, null_rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id: (n_shingles, component_id), from all pairs."""
    ids = sorted({i for i, _ in rows})
    sets = [(i, shingles(t)) for i, t in rows]
    by, root = {}, {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    pairs = {(a, b) for group in by.values() for k, a in enumerate(group) for b in group[k + 1:]}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        if 100 * len(s & t) >= 85 * len(s | t):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def check(docs):
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_chains_stars_and_hubs_that_match_nothing(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):  # a chain: each text near the next only
        base = list(rng.choice(words, 120))
        for _ in range(12):
            texts.append(" ".join(base))
            base[rng.integers(0, 120)] = str(rng.choice(words))
    for _ in range(4):  # copies of one text, each edited on its own: near the first, less near to one another
        base = list(rng.choice(words, 200))
        for k in range(15):
            edited = base.copy()
            for at in rng.choice(200, 2 if k else 0, replace=False):
                edited[at] = str(rng.choice(words))
            texts.insert(int(rng.integers(0, len(texts))), " ".join(edited))
    for n in range(20):  # half of each text is common to all
        texts.append(" ".join([*words[:150], *rng.choice(words, 60 + n)]))
    check(documents(spark, texts))


def test_bins_agree_as_often_as_sets_do():
    rng = np.random.default_rng(8)
    for size in (3, 40, 4000):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, size + size // 3 + 1).astype(np.uint64)
            a, b = np.sort(pool[:size]), np.sort(pool[len(pool) - size:])
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((signature(a) == signature(b)).mean() - j)
        assert abs(np.mean(agree)) < 0.05
    assert len(signature(np.array([5], np.uint64))) == 240 and len(shingle_set("")) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7), (139, 500)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in [*range(101, 140), 500]}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    check(documents(spark))
    rows = near_duplicates(null_rows(spark)).collect()
    assert sum(r.doc_id is None and r.component_id is None and r.kept for r in rows) == 2 and sum(r.component_id == 3 for r in rows) == 2
    assert near_duplicates(documents(spark, empty=True)).count() == 0
    kept = keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in brute([(r.doc_id, r.text) for r in documents(spark).collect()]).items() if i == c)
    assert keep_one(null_rows(spark)).count() == 3


def test_one_row_of_each_text_stays_whatever_the_ids(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    rows = [(1, a), (1, b), (2, c), (2, c + " tail"), (None, a), (None, "null only " + b[:20]), (None, "null only " + b[:20])]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[:9]) for r in kept) == sorted([(0, "null only"), (1, a[:9]), (1, b[:9]), (2, c[:9])])


def test_a_bucket_is_compared_in_blocks_without_a_row_per_pair(spark, monkeypatch):
    """Copies that are edited too much to be near the hub: pairs of blocks, against all pairs; links alone leave a task."""
    rng = np.random.default_rng(12)
    base, rows = [f"w{i}" for i in range(120)], []
    for n in range(90):
        edited = base.copy()
        for at in rng.choice(120, 2 + n % 4, replace=False):
            edited[at] = f"x{rng.integers(0, 3)}"
        rows.append((n, " ".join(edited)))
    written, write = {}, minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda frame, name: written.setdefault(name, write(frame, name)))
    for block, elements in ((512, 2**20), (7, 2**20), (512, 500)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "BLOCK_ELEMENTS", elements)
        written.clear()
        check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "minhash-near" not in written and written["minhash-all-links"].count() < 90 * 40


def test_shared_elements_of_two_blocks(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 3)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 9, 30, 30, 50)]
    left, right = np.array([0, 2, 4]), np.array([1, 3])
    assert minhash._shared(sets, left, right).tolist() == [[len(np.intersect1d(sets[x], sets[y])) for y in right] for x in left]
    assert minhash._shared([sets[0], sets[0] + np.uint64(99)], np.array([0]), np.array([1])).tolist() == [[0]]
    assert minhash._connecting(np.array([1, 2, 1, 5]), np.array([2, 3, 3, 3])) == [0, 1, 3]
