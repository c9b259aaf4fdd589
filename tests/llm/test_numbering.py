import pytest

from rolefit.llm.minhash import keep_one
from rolefit.llm.mixing import mixed_documents
from rolefit.llm.pii import redact
from rolefit.llm.suffixes import without_repeats

SPLITS = {"spark.sql.files.maxPartitionBytes": "40k", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "23"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8, "doc_id").write.parquet(path)
    return path


@pytest.mark.parametrize("step", [without_repeats, keep_one, redact, mixed_documents])
def test_rows_stay_the_same_when_later_scans_are_split_differently(spark, folder, step):
    """As after a lost executor: the plan is built under one split of the files and read under another."""
    expected = sorted(map(tuple, step(spark.read.parquet(folder)).collect()))
    frame = step(spark.read.parquet(folder))
    before = {k: spark.conf.get(k, None) for k in SPLITS}
    try:
        for k, v in SPLITS.items():
            spark.conf.set(k, v)
        assert spark.read.parquet(folder).rdd.getNumPartitions() > 16
        assert sorted(map(tuple, frame.collect())) == expected
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
