import pytest
from pyspark.sql import functions as F

from rolefit.llm.queries import ORACLE, QUERIES
from tools.check import connect, difference

COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3": ["doc_id", "n_pieces", "ids"], "op4": ["doc_id", "size", "source_size", "target", "taken"],
    "op5": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "op6": ["doc_id", "held_out", "score", "predicted"],
    "op7": ["query_id", "rank", "vec_id", "score"], "op8": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op9": ["doc_id", "start", "n_tokens", "ids_crc32"], "op10": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11": ["doc_id", "held_out", "score", "predicted"],
    "op12": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"], "op13": ["word", "form", "root", "n", "n_near", "form_n"],
}


def test_one_query_per_operator():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(COLUMNS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_document_has_its_row(spark, sf_dir, name):
    out = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name.split("_")[0]]) <= set(out.columns)
    if name.startswith("op7"):
        assert out.filter("rank BETWEEN 1 AND 20").count() == 25 * 20
    elif name.startswith("op12"):
        assert out.filter("rank BETWEEN 1 AND 3").count() == out.count()
    elif name.startswith("op13"):
        assert out.filter("length(word) >= 5 AND n >= 3").count() == out.count()
    else:
        assert sorted(r[0] for r in out.select("doc_id").collect()) == list(range(200))
    assert out.agg(F.count("*")).first()[0] > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    d = "/root/testdata/sf0.01"
    cursor = connect(d).execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert not difference([r.asDict() for r in QUERIES[name](spark, d).collect()], expected)
