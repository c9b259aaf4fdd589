"""Why a posting is ranked where it is, and the result cards shown for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.formats import fill, job_link, salary_label


def matched_skills() -> Column:
    return F.array_sort(F.array_intersect("skills", "p_skills"))


def missing_skills() -> Column:
    return F.array_sort(F.array_except("p_skills", "skills"))


def contribution(signal: str, weights: str = "p_weights") -> Column:
    return F.col(f"{weights}.{signal}") * F.col(f"breakdown.{signal}")


def _reason(signal: str) -> Column:
    """The sentence for a signal, null where the signal is too weak to mention."""
    value = F.col(f"breakdown.{signal}")
    matched = matched_skills()
    told = {
        "skills": F.size(matched) > 0, "similarity": value > 0.3, "title": value > 0, "salary": value >= 1, "seniority": value >= 1,
    }[signal]
    text = fill(
        vocab.REASON_TEXTS[signal], n=F.size(matched).cast("string"), names=F.array_join(F.slice(matched, 1, 6), ", "),
        percent=F.bround(value * 100, 0).cast("int").cast("string"))
    return F.when(told, text)


def explain(ranked: DataFrame, weights: str = "p_weights") -> DataFrame:
    """Reasons ordered by weighted contribution; ties keep the order of the labels."""
    parts = F.array(*[
        F.struct((-contribution(s, weights)).alias("order"), F.lit(i).alias("place"), _reason(s).alias("text"))
        for i, s in enumerate(vocab.EXPLAIN_LABELS)])
    told = F.filter(F.array_sort(parts), lambda p: (p["order"] < -0.001) & p["text"].isNotNull())
    reasons = F.transform(told, lambda p: p["text"])
    return ranked.select(
        "profile_id", "job_id", "rank", "score",
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit(vocab.REASON_FALLBACK))).alias("reasons"),
        matched_skills().alias("matched_skills"),
        F.slice(missing_skills(), 1, 8).alias("missing_skills"),
        F.struct(*[F.round(contribution(s, weights), 3).alias(s) for s in vocab.EXPLAIN_LABELS]).alias("contributions"),
    )


def match_cards(ranked: DataFrame, shown: int = 10) -> DataFrame:
    overlap = F.size(F.array_intersect("skills", "p_skills"))
    return ranked.filter(F.col("rank") <= shown).select(
        "profile_id", "rank", "job_id", "title", "company", "location",
        salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_value")).alias("salary"),
        job_link(F.col("source"), F.col("url"), F.col("title"), F.col("company"), F.col("location")).alias("url"),
        F.round("score", 2).alias("score"), "company_size", "seniority",
        F.slice(matched_skills(), 1, 4).alias("matched"),
        F.concat_ws("/", overlap, F.size("p_skills")).alias("overlap"),
        F.round("breakdown.similarity", 2).alias("similarity"),
        (F.col("breakdown.salary") >= 1).alias("salary_ok"),
        (F.col("breakdown.title") > 0).alias("title_ok"),
        F.slice(missing_skills(), 1, 3).alias("missing"),
    )
