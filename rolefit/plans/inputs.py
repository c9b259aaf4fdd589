"""The stages every registered query starts from, built lazily over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit.functions.features import enrich
from rolefit.operators import ranking
from rolefit.operators.dedup import first_per_key
from rolefit.operators.normalize import normalize
from rolefit.plans import fixtures
from rolefit.session import shared_dir


COPIED_BYTES = 64 << 20  # per slot, of posting vectors sent to further query blocks


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def texts(self, name: str) -> DataFrame:
        """A table of long texts, spread over all slots when it is small."""
        return fixtures.spread_small(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.postings_raw(self.spark, self.sf_dir)

    @cached_property
    def normalized(self) -> DataFrame:
        """Canonical postings, reposts included; ``seq`` is the order of arrival."""
        return normalize(self.raw, keep=("seq",))

    @cached_property
    def postings(self) -> DataFrame:
        """Canonical postings, one row per job_id."""
        return first_per_key(self.normalized, "job_id", "seq")

    @cached_property
    def enriched(self) -> DataFrame:
        """Features are read before reposts go: texts that a query does not use are not exchanged for them."""
        return first_per_key(enrich(self.normalized), "job_id", "seq")

    @cached_property
    def vectors(self) -> DataFrame:
        return fixtures.vectors(self.spark, self.sf_dir)

    @cached_property
    def posting_vectors(self) -> DataFrame:
        """(job_id, vec)."""
        n = self.vectors.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        keyed = self.postings.select("job_id", (F.shiftright("seq", 1) % n).alias("vec_id"))
        return keyed.join(self.vectors, "vec_id").select("job_id", "vec")

    @cached_property
    def profiles(self) -> DataFrame:
        return fixtures.profiles(self.spark, self.sf_dir)

    @cached_property
    def profile_vectors(self) -> DataFrame:
        return self.profiles.select("profile_id", "vec_id").join(self.vectors, "vec_id").select("profile_id", "vec")

    @cached_property
    def feedback(self) -> DataFrame:
        return fixtures.feedback(self.spark, self.sf_dir)

    @cached_property
    def spread(self) -> int:
        """Query blocks: as many as keep all slots busy while copies of the posting vectors stay small, else one."""
        slots = self.spark.sparkContext.defaultParallelism
        width = self.vectors.select(F.coalesce(F.max(F.size("vec")), F.lit(1))).first()[0]
        copied = 4 * max(1, width) * self.table("documents").count()  # bytes of one copy, one vector per document at most
        return max(1, min(4 * slots, COPIED_BYTES * slots // max(1, copied)))

    @cached_property
    def candidates(self) -> DataFrame:
        return ranking.candidates(self.profile_vectors, self.posting_vectors, spread=self.spread)

    @cached_property
    def pairs(self) -> DataFrame:
        return ranking.pair_up(self.candidates, self.profiles, self.enriched)

    @cached_property
    def cells(self) -> ranking.Cells:
        """The same pairs, judged where they are found."""
        return ranking.Cells(self.profiles, self.profile_vectors, self.enriched, self.posting_vectors, spread=self.spread)

    @cached_property
    def scored(self) -> ranking.Cells:
        return ranking.score(ranking.survivors(self.cells))

    @cached_property
    def best(self) -> DataFrame:
        """Ranked pairs without the columns of their postings and profiles."""
        return ranking.rank_topk(self.scored, ranking.TOP_K)

    @cached_property
    def ranked(self) -> DataFrame:
        return self.told(self.best)

    @cached_property
    def top(self) -> DataFrame:
        """The pairs that are shown."""
        return ranking.rank_topk(self.scored, ranking.SHOWN)

    @cached_property
    def stored_top(self) -> DataFrame:
        """The same, formed once, for queries that read them several times."""
        path = shared_dir(self.spark, "top")
        self.top.write.parquet(path)
        return self.spark.read.parquet(path)

    def told(self, top: DataFrame) -> DataFrame:
        """Pairs with what their postings and profiles say."""
        return ranking.with_attributes(top, self.profiles, self.enriched)

    @cached_property
    def shown(self) -> DataFrame:
        """The rows that are shown, with their long texts."""
        return ranking.with_texts(self.told(self.top), self.profiles, self.enriched)
