import re

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.odd import documents, null_rows
from tests.llm.test_minhash import shingles
from tests.llm.test_pii import base


def similar(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def groups(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    by, root = {}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for group in by.values():
        for k, a in enumerate(group):
            for b in group[k + 1:]:
                if find(a) != find(b) and similar(sets[a], sets[b], percent):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_every_stage_on_its_own_input(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, kept = docs.collect(), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(n))
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        if n < 4:
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs, after = out, out.collect()
        kept.append((before, after))
        before = after
    told = [(labels[r.doc_id], r.doc_id in {x.doc_id for x in kept[0][1]}) for r in kept[0][0] if r.doc_id in labels]
    assert sum(k for y, k in told if y) > 0.97 * sum(y for y, _ in told) and sum(k for y, k in told if not y) < 0.2 * sum(not y for y, _ in told)
    root = groups([(r.doc_id, r.text) for r in kept[1][0]], corpus_pipeline.SIMILAR)
    assert sorted(r.doc_id for r in kept[1][1]) == sorted({root[i] for i in root})
    text = {r.doc_id: r.text for r in kept[2][0]}
    assert len(kept[2][1]) == len(text) and all(not base(r.text) for r in kept[2][1])
    assert all(r.text == text[r.doc_id] for r in kept[2][1] if not re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text))
    text = {r.doc_id: r.text for r in kept[3][0]}
    size = lambda t: len(t.split())
    taken = {}
    for r in kept[3][1]:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + size(r.text)
        assert r.n_chars == len(r.text) and (r.text == text[r.doc_id] or set(r.text.split()) <= set(text[r.doc_id].split()))
    assert all(n <= 3 * size(text[i]) for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(map(size, text.values()))) < 0.02 * sum(taken.values())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, tuple(r.ids)) for r in kept[4][1]) == sorted((r.doc_id, tuple(library.encode(r.text))) for r in kept[4][0])
    assert all(r.restored for r in kept[4][1])


def test_run_gives_the_rows_of_its_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert [len(corpus_pipeline.STAGES), rows.columns[:3]] == [5, ["doc_id", "n_pieces", "ids"]]
    assert 0 < rows.count() and rows.filter("NOT restored").count() == 0


@pytest.mark.parametrize("kind", ["empty", "nulls", "odd"])
def test_run_on_odd_tables(spark, tmp_path, kind):
    """No rows; rows null in every column and repeated ones; columns whose names the stages use themselves, ids that repeat with other texts."""
    docs = {"empty": documents(spark, empty=True), "nulls": null_rows(spark), "odd": documents(spark).unionByName(documents(spark, ["one more text under the first id"]))}[kind]
    docs = docs.withColumns({"doc": F.lit("d"), "parts": F.lit(1), "spans": F.lit("s"), "block": F.lit(2), "labelled": F.lit(3)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (3, 0, 1), (None, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.restored for r in rows) and (kind != "empty" or not rows) and (kind != "nulls" or {r.doc_id for r in rows} <= {3})
