import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolefit.llm.spelling import Index, near_words, spelling_groups, vocabulary
from tests.llm.odd import documents, null_rows


def edits(word, alphabet):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    return out - {word}


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc is not None and (h := zlib.crc32(f"{doc}:{run}".encode())) % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    words = brute_words(rows)
    alphabet = sorted({c for w in words for c in w})
    near = {w: sorted((-words[v], v) for v in edits(w, alphabet) if v in words) for w in words}
    form = {w: v[0][1] if (v := near[w]) and -v[0][0] >= 2 * words[w] else None for w in words}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert {tuple(r) for r in spelling_groups(docs).collect()} == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("alphabet,top", [("ab", 9), ("abé", 7), ("abcdefgh\U0001f600", 5)])
def test_index_finds_every_near_word(alphabet, top):
    rng = np.random.default_rng(len(alphabet))
    words = sorted({"".join(rng.choice(list(alphabet), rng.integers(1, top))) for _ in range(600)})
    index = Index(words)
    for length in range(1, top):
        some = [w for w in words if len(w) == length]
        if some:
            for exact in range(length + 1):
                i, j = index.near(index.codes(some, length), exact)
                got = sorted((some[x], words[y]) for x, y in zip(i, j, strict=True))
                assert got == sorted((w, v) for w in some for v in edits(w, alphabet) if v in set(words) and v[:exact] == w[:exact])
    i, j = index.near(index.codes(["zzz"], 3), 1)
    assert len(i) == 0


def test_small_ranges_give_the_same(spark, sf_dir):
    words = vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    one, many = ({tuple(r) for r in near_words(words, most).collect()} for most in (10**6, 50))
    assert one == many and len(one) > 20


def test_hot_beginnings_long_words_and_chains(spark):
    long = "x" * 3000
    rows = [(None, " ".join(f"ciudad{a}{b}" for a in "abcdefgh" for b in "abcdefgh"))] * 3
    rows += [(None, " ".join([long] * 3 + [long + "y"] * 8))] + [(None, " ".join(["abcde"] * 3 + ["abcdf"] * 6 + ["abcdfg"] * 12 + ["Abcdfgh"] * 24))]
    rows += [(i, "Recieve RECEIVE receive recÉive") for i in range(400)] + [(7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {tuple(r) for r in spelling_groups(docs).collect()}
    assert out == brute(rows)
    assert ("abcde", "abcdf", "abcdfgh", 3, 1, 6) in out and (long, long + "y", long + "y", 3, 1, 8) in out


def test_odd_rows(spark):
    for docs in (documents(spark), null_rows(spark), documents(spark, empty=True)):
        out = spelling_groups(docs)
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in out.collect()} == brute([(r.doc_id, r.text) for r in docs.collect()])
    clash = documents(spark).withColumn("word", F.lit("w")).withColumn("n", F.lit("n")).withColumn("root", F.lit(1))
    assert spelling_groups(clash).count() == spelling_groups(documents(spark)).count()
