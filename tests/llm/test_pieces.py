import zlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from rolefit.llm.pieces import Transducer, encode_documents
from tests.llm.odd import documents, null_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a  b", "   lead", "tail  ", "▁x", "a▁ b", "\n\n a", "é\U0001f600漢字", "<0x0A> <s> </s> <unk>", "\x00", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "==== ----", "퟿", "Ａ"]


def test_paths_are_those_of_the_library(spark, sf_dir):
    library, machine = sentencepiece.SentencePieceProcessor(model_file=PATH), Transducer(PATH)
    rng = np.random.default_rng(6)
    pool = list("abcde the ing ▁.,'\"0123456789é漢\n") + ["the", "tion", " in", "  ", "://", ".com"]
    texts = ODD + ["".join(rng.choice(pool, rng.integers(1, 60))) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts:
        ids = machine.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert machine.decode(ids) == text.replace("▁", " ")


def test_unigram_paths_weigh_least(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    rng = np.random.default_rng(7)
    for p in model.pieces:
        if p.type == 1:
            p.score = -float(np.round(4 + 2 * len(p.piece) ** 0.5 + rng.uniform(), 3))
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library, machine = sentencepiece.SentencePieceProcessor(model_file=str(path)), Transducer(str(path))
    score = lambda ids: sum(model.pieces[i].score for i in ids)
    for text in ["the internationalisation of things", "don't panic: 12345", "a  b", "über straße"]:
        ours, theirs = machine.encode(text).tolist(), library.encode(text)
        assert score(ours) == pytest.approx(score(theirs)) and machine.decode(np.array(ours)) == text


def test_documents_and_odd_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for docs in (spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), documents(spark), null_rows(spark)):
        rows, texts = encode_documents(docs, PATH).collect(), docs.collect()
        assert len(rows) == len(texts)
        for r, d in zip(rows, texts):
            ids = library.encode(d.text or "")
            assert (r.doc_id, r.n_pieces, r.ids, r.restored) == (d.doc_id, len(ids), ids, True)
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<i4").tobytes())
    assert encode_documents(documents(spark, empty=True), PATH).count() == 0
    assert encode_documents(documents(spark), PATH).filter(~F.col("restored")).count() == 0
