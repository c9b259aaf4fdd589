import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rolefit.llm.token_files import open_tokens, read_documents, sequence, token_digests, write_token_files
from tests.llm.odd import documents, null_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1])


def test_every_document_is_read_back(spark, sf_dir):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), documents(spark), null_rows(spark), documents(spark, empty=True)):
        for length in (8, 2048):
            got = token_digests(write_token_files(docs, PATH, length=length)).collect()
            assert sorted(map(tuple, got), key=key) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_sequences_have_one_length_and_are_views(spark):
    for shard in write_token_files(documents(spark), PATH, length=16).collect():
        reader = open_tokens(shard.data)
        every = np.concatenate([x for _, ids in read_documents(shard.data, shard.docs) for x in ids])
        n = sum(reader.get_batch(i).num_rows for i in range(reader.num_record_batches))
        assert n == -(-len(every) // 16)
        for i in (0, n // 2, n - 1):
            ids, mask = sequence(reader, i)
            assert len(ids) == len(mask) == 16 and (ids[mask] == every[16 * i:16 * i + 16]).all()
        assert not ids.flags.owndata
