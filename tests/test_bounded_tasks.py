import tracemalloc

import numpy as np
import pyarrow as pa

from rolefit.operators import analytics, lexical
from rolefit.plans import catalog, landing
from rolefit.plans.inputs import Inputs


def test_landed_files_grow_with_the_table(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr("id AS doc_id", "md5(cast(id AS string)) AS text").write.parquet(str(tmp_path / "documents.parquet"))
    i = Inputs(spark, str(tmp_path))
    assert landing.file_count(i, "documents", 4) == 4
    monkeypatch.setattr(landing, "LANDED_BYTES", 50_000)
    assert landing.file_count(i, "documents", 4) >= 12


def test_texts_are_encoded_a_few_at_a_time():
    """A batch holds up to 10,000 texts; 384 doubles for each of them, several times over, are not held at once."""
    words = pa.ListArray.from_arrays(np.arange(0, 50_001, 5, dtype="int32"), pa.array([f"w{n % 997}" for n in range(50_000)]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), words], names=["id", "words"])
    encoder = lexical.HashingEncoder()
    tracemalloc.start()
    rows = [encoder.of_words(part.column("words")) is not None and part.num_rows for part in lexical._slices(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(rows) == 10_000 and max(rows) <= lexical.TEXTS_AT_ONCE and peak < 16 << 20
    whole = np.concatenate([lexical.HashingEncoder().of_words(part.column("words")) for part in lexical._slices(iter([batch]))])
    assert np.array_equal(whole, lexical.HashingEncoder().of_words(words))


def test_a_sketch_hashes_each_item_once(spark, monkeypatch):
    hashed, rows_of = [], analytics.sketch_rows

    def counted(items, *shape):
        hashed.append(items.count())
        return rows_of(items, *shape)

    monkeypatch.setattr(analytics, "sketch_rows", counted)
    words = spark.range(5_000).selectExpr("concat('w', id % 50) AS w").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS w"))
    cells = {(r.depth_row, r.bucket): r.cnt for r in analytics.count_min_sketch(words, "w").collect()}
    assert hashed == [51] and sum(cells.values()) == 4 * 5_001 and cells[0, None] == 1
    assert {r.exact for r in analytics.sketch_estimates(words.filter("w IS NOT NULL"), "w", 5).collect()} == {100}
    assert hashed[1:] == [5, 50]


def test_learner_stream_forms_its_events_once(spark, sf_dir, monkeypatch):
    """Both arrivals are cut from stored events, not formed anew for each, and land in files that grow with the table."""
    landed, land_rows = [], landing.land_rows

    def watched(rows, path, files, mode):
        landed.append((rows.inputFiles(), files))
        land_rows(rows, path, files, mode)

    monkeypatch.setattr(landing, "land_rows", watched)
    monkeypatch.setattr(landing, "LANDED_BYTES", 10_000)
    got = {r.profile_id: r for r in catalog.QUERIES["learner_stream"](spark, sf_dir).collect()}
    monkeypatch.undo()
    assert len(landed) == 2 and all(files > 2 and all("/learner-" in f for f in read) for read, files in landed)
    whole = {r.profile_id: r for r in catalog.QUERIES["learner_fold"](spark, sf_dir).collect()}
    assert got.keys() == whole.keys() and all(abs(a - b) < 2e-6 for p in got for a, b in zip(got[p], whole[p]))
