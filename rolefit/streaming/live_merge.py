"""Merging a live feed into a stored corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit.functions.features import enrich
from rolefit.operators.dedup import first_per_key, only_new
from rolefit.operators.normalize import normalize
from rolefit.sources.live import live_rows
from rolefit.streaming.runs import table_or_none


#: Ids of a batch that are sent to every task, 16 bytes each, so that the corpus is not shuffled for them.
FEW_IDS = 200_000


class LiveMerge:
    """New postings are appended; postings already known only get stricter flags.

    The corpus is never rewritten: each batch adds rows and flag notes under its own id, and
    current() combines them. Flags only tighten, so the order of the notes does not matter.
    """

    def __init__(self, spark: SparkSession, base: DataFrame, path: str):
        self.spark, self.base = spark, base
        self.added_path, self.notes_path = f"{path}/added", f"{path}/notes"

    def corpus_before(self, batch_id: int | None = None) -> DataFrame:
        added = table_or_none(self.spark, self.added_path)
        if added is None:
            return self.base
        if batch_id is not None:
            added = added.filter(F.col("batch") < batch_id)
        return self.base.unionByName(added.drop("batch"))

    def __call__(self, pages: DataFrame, batch_id: int) -> None:
        live = enrich(normalize(live_rows(pages), source="adzuna", keep=("seq",)))
        ids = live.select("job_id").distinct()
        if ids.count() <= FEW_IDS:  # of one batch
            ids = F.broadcast(ids)
        known = self.corpus_before(batch_id).select("job_id").join(ids, "job_id", "left_semi")
        only_new(live, known, "seq").select(self.base.columns).write.mode("overwrite").parquet(f"{self.added_path}/batch={batch_id}")
        stricter = F.col("is_contract") | F.coalesce(~F.col("sponsors_visa"), F.lit(False))
        seen_again = first_per_key(live.join(known, "job_id", "left_semi"), "job_id", "seq")
        notes = seen_again.filter(stricter).select(
            "job_id", F.col("is_contract").alias("contract"), F.coalesce(~F.col("sponsors_visa"), F.lit(False)).alias("no_sponsor"))
        notes.write.mode("overwrite").parquet(f"{self.notes_path}/batch={batch_id}")

    def current(self) -> DataFrame:
        corpus, notes = self.corpus_before(), table_or_none(self.spark, self.notes_path)
        if notes is None:
            return corpus
        merged = notes.groupBy("job_id").agg(F.max("contract").alias("contract"), F.max("no_sponsor").alias("no_sponsor"))
        return corpus.join(merged, "job_id", "left").withColumns({
            "is_contract": F.col("is_contract") | F.coalesce("contract", F.lit(False)),
            "sponsors_visa": F.when(F.col("no_sponsor"), False).otherwise(F.col("sponsors_visa")),
        }).select(self.base.columns)
