"""Retrieve, filter, score and rank for all profiles in one job."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefit.operators.judging import Judgement
from rolefit.operators.retrieval import topk
from rolefit.operators.scoring import passes_all, prepare_postings, prepare_profiles, signals, total_score

N_CANDIDATES = 1000
TOP_K = 50
SERVED = 25
SHOWN = 10
#: Posting columns that neither filters, signals nor ranking read: they join the ranked rows alone.
LATE = ["description", "url"]


def candidates(profile_vectors: DataFrame, posting_vectors: DataFrame, n: int = N_CANDIDATES, spread: int = 1) -> DataFrame:
    """(profile_id, job_id, similarity, candidate_rank): recall stage by cosine similarity."""
    queries = profile_vectors.select(F.col("profile_id").alias("id"), "vec")
    docs = posting_vectors.select(F.col("job_id").alias("id"), "vec")
    return topk(queries, docs, n, spread=spread).select(
        F.col("query_id").alias("profile_id"), F.col("doc_id").alias("job_id"), "similarity",
        F.col("rank").alias("candidate_rank"))


def pool(profile_vectors: DataFrame, posting_vectors: DataFrame, drawn: DataFrame, n: int, spread: int = 1) -> DataFrame:
    """(profile_id, job_id, similarity): the n nearest of all postings and the n nearest of drawn ones, each posting once."""
    queries = profile_vectors.select(F.col("profile_id").alias("id"), "vec")
    docs = posting_vectors.select(F.col("job_id").alias("id"), "vec")
    found = topk(queries, docs, n, spread=spread, also=(drawn.select(F.col("job_id").alias("id")), n))
    return found.select(F.col("query_id").alias("profile_id"), F.col("doc_id").alias("job_id"), "similarity")


@dataclass(frozen=True)
class Cells:
    """Candidate pairs that are judged in the cells that find them, see operators/judging.py.

    survivors(), score(), rank_topk() and rank_counts() take it in place of the rows of pair_up() and add to what is asked of the
    cells; rows() has what is left. So what is dropped is never a row, and of what stays only a few columns are. Rows of one
    profile_id are told apart by p_copy, their place in people(). ``postings`` has one row per job_id.
    """

    profiles: DataFrame
    profile_vectors: DataFrame
    postings: DataFrame
    posting_vectors: DataFrame
    n: int = N_CANDIDATES
    spread: int = 1
    weights: Column | None = None
    excluded: DataFrame | None = None
    asked: Judgement = Judgement()

    def asking(self, **more) -> Cells:
        return replace(self, asked=replace(self.asked, **more))

    def rows(self) -> DataFrame:
        """One row per pair, see Judgement."""
        fields = people(self.profiles, self.weights)
        if self.excluded is None:
            barred = F.lit(None).cast("array<string>")
        else:
            barred = F.col("excluded")
            fields = fields.join(self.excluded.groupBy("profile_id").agg(F.collect_set("job_id").alias("excluded")), "profile_id", "left")
        of_profiles = fields.select(F.col("profile_id").alias("id"), F.struct(self.asked.profile_load("people").alias("people"), barred.alias("excluded")).alias("load"))
        of_postings = prepare_postings(self.postings.drop(*LATE)).select(F.col("job_id").alias("id"), self.asked.posting_load().alias("load"))
        return topk(self.profile_vectors.select(F.col("profile_id").alias("id"), "vec"), self.posting_vectors.select(F.col("job_id").alias("id"), "vec"),
                    self.n, spread=self.spread, judge=self.asked, loads=(of_profiles, of_postings))


def people(profiles: DataFrame, weights: Column | None = None) -> DataFrame:
    """(profile_id, people): the prepared rows of each profile_id, in an order that does not change."""
    ready = prepare_profiles(profiles, weights).drop("p_resume").filter(F.col("profile_id").isNotNull())
    return ready.groupBy("profile_id").agg(F.sort_array(F.collect_list(F.struct(*ready.columns[1:]))).alias("people"))


def with_attributes(ranked: DataFrame, profiles: DataFrame | None, postings: DataFrame, weights: Column | None = None) -> DataFrame:
    """Rows of Cells with what pair_up() has of their postings and profiles.

    Ranked rows lie by profile already, so profiles come first and only the join with postings exchanges the rows.
    """
    if profiles is not None:
        mine = people(profiles, weights)
        fields = mine.schema["people"].dataType.elementType.names
        ranked = ranked.join(mine, "profile_id").withColumn("_person", F.try_element_at("people", F.col("p_copy")))
        ranked = ranked.select("*", *[F.col(f"_person.{c}").alias(c) for c in fields]).drop("people", "_person")
    return ranked.join(prepare_postings(postings.drop(*LATE)), "job_id")


def pair_up(found: DataFrame, profiles: DataFrame, postings: DataFrame, weights: F.Column | None = None) -> DataFrame:
    """Candidate pairs with everything the filters and signals read.

    Two equi-joins without hints: a popular posting is a hot key on the candidate side only, which
    AQE splits; the other side is unique per key.
    """
    return (
        found.join(prepare_postings(postings.drop(*LATE)), "job_id")
        .join(prepare_profiles(profiles, weights).drop("p_resume"), "profile_id")
    )


def with_texts(ranked: DataFrame, profiles: DataFrame, postings: DataFrame | None) -> DataFrame:
    """Ranked rows, cut to those that are shown, with the long texts that pair_up() leaves behind.

    Those of postings come last, if at all: the rows that hold them are not exchanged again.
    """
    ranked = ranked.join(profiles.select("profile_id", F.col("resume_text").alias("p_resume")), "profile_id")
    if postings is None:
        return ranked
    return ranked.join(postings.select("job_id", *[c for c in LATE if c in postings.columns]), "job_id")


def survivors(pairs: DataFrame | Cells, excluded: DataFrame | None = None) -> DataFrame | Cells:
    if isinstance(pairs, Cells):
        kept = pairs.asking(kept=True, excluded=excluded is not None)
        return replace(kept, excluded=excluded)
    kept = pairs.filter(passes_all())
    if excluded is not None:
        kept = kept.join(excluded.select("profile_id", "job_id"), ["profile_id", "job_id"], "left_anti")
    return kept


def score(pairs: DataFrame | Cells) -> DataFrame | Cells:
    if isinstance(pairs, Cells):
        return pairs.asking(scored=True)
    return pairs.withColumn("breakdown", signals()).withColumn("score", total_score())


def rank_topk(scored: DataFrame | Cells, k: int = TOP_K) -> DataFrame:
    if isinstance(scored, Cells):  # a cell leaves the k best of each profile
        scored = scored.asking(best=k).rows()
    best = Window.partitionBy("profile_id").orderBy(F.desc("score"), "job_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def rank_counts(found: DataFrame | Cells, pairs: DataFrame | None = None) -> DataFrame:
    """Candidates and survivors per profile, before user exclusions."""
    if isinstance(found, Cells):
        return found.asking(counted=True).rows()
    passed = pairs.groupBy("profile_id").agg(F.sum(passes_all().cast("bigint")).alias("n_after_filter"))
    return (
        found.groupBy("profile_id").agg(F.count(F.lit(1)).alias("n_candidates"))
        .join(passed, "profile_id", "left")
        .select("profile_id", "n_candidates", F.coalesce("n_after_filter", F.lit(0)).cast("bigint").alias("n_after_filter"))
    )


def match(profiles: DataFrame, profile_vectors: DataFrame, postings: DataFrame, posting_vectors: DataFrame,
          n: int = N_CANDIDATES, k: int = TOP_K, excluded: DataFrame | None = None,
          weights: F.Column | None = None, spread: int = 1) -> DataFrame:
    """The whole matching job: ranked postings of every profile with their score breakdown.

    Retrieval comes before the hard filters on purpose: a profile sees survivors of its n nearest
    postings, not the n nearest survivors.
    """
    cells = Cells(profiles, profile_vectors, postings, posting_vectors, n, spread, weights)
    ranked = rank_topk(score(survivors(cells, excluded)), k)
    return with_texts(with_attributes(ranked, profiles, postings, weights), profiles, postings)
