import hashlib

import numpy as np
import pytest

from rolefit.llm.suffixes import cells, without_repeats
from tests.llm.odd import documents, null_rows


def brute(texts, length):
    raws, places = [(t or "").encode() for t in texts], {}
    for n, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            places[raw[i:i + length]] = places.get(raw[i:i + length], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if places[raw[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, **options):
    rows = docs.collect()
    got = without_repeats(docs, **options).collect()
    expected = brute([r.text for r in rows], options.get("length", 400))
    assert sorted(((r.doc_id is not None, r.doc_id or 0), *tuple(r)[1:]) for r in got) == sorted(((r.doc_id is not None, r.doc_id or 0), *e) for r, e in zip(rows, expected))


@pytest.mark.parametrize("together", [512, 3])
def test_documents(spark, sf_dir, together):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), together=together)


@pytest.mark.parametrize("together", [512, 2])
def test_repeats_of_all_kinds(spark, together):
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abcdef é"), n))
    parts = [word(n) for n in (399, 400, 401, 500, 900, 250, 250)]
    texts = [word(50) + p + word(60) for p in parts for _ in range(2)]
    texts += [word(30) + parts[4][:450] + word(20), word(10) + parts[4][300:] + parts[3], parts[5] + parts[6] + "x", "y" + parts[5] + parts[6] + parts[5] + parts[6]]
    texts += ["z" * 3000, "ab" * 700, "z" * 399, "q" * 401, parts[3] * 3]
    base = word(1500)
    for at in range(40):  # many different surroundings of the same passages
        texts.append(base[:30 * at] + "#" + base[30 * at + 1:])
    check(documents(spark, texts), together=together)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    a, lo, hi = cells(raw)
    assert lo[0] == 0 and hi[-1] == 4600 and (lo[1:] == hi[:-1] + 1).all() and (a >= hi).all() and (a - lo <= 336).all()
    b, first, last = cells(np.r_[rng.integers(97, 100, 777).astype(np.uint8), raw[1000:3000]])
    of = lambda s, x: x[0][np.searchsorted(x[2], s)]
    for s in range(1000, 2600):
        assert of(s, (a, lo, hi)) - 1000 == of(s - 223, (b, first, last)) - 777


def test_odd_rows(spark):
    check(documents(spark))
    check(null_rows(spark))
    assert without_repeats(documents(spark, empty=True)).count() == 0
