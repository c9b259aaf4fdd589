"""Keyword coverage as applicant-tracking systems measure it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.text import MARK, mark_words, marked_word, quoted

MAX_KEYWORDS = 25


def with_words(marked: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """``marked`` with ``words``: which words of the keywords its column ``marked`` names, found in one pass over the text."""
    parts = sorted({p for k in (vocab.ATS_VOCABULARY if keywords is None else keywords) for p in _parts(k)})
    wanted = F.array(*map(F.lit, parts)) if parts else F.array().cast("array<string>")
    return marked.withColumn("words", F.array_intersect(wanted, F.split("marked", MARK)))


def _parts(keyword: str) -> list[str]:
    """Words of a keyword, each of which stands between two marks wherever the keyword is named."""
    return [p for p in dict.fromkeys(marked_word(keyword).split(MARK)) if re.search(r"\w", p)]


def ats_hits(marked: str, words: str, keywords: list[str] | None = None) -> Column:
    """Vocabulary keywords named in a column that went through mark_words(), in vocabulary order.

    ``words`` is what with_words() found there: a text is searched only for keywords all of whose words it names.
    """
    names = vocab.ATS_VOCABULARY if keywords is None else keywords

    def named(k: str) -> str:
        return " AND ".join([f"array_contains({words}, {quoted(p)})" for p in _parts(k)] + [f"contains({marked}, {quoted(marked_word(k))})"])

    return F.expr(f"array_compact(array({', '.join(f'CASE WHEN {named(k)} THEN {quoted(k)} END' for k in names)}))")


def reduce_keywords(hits: Column, limit: int = MAX_KEYWORDS) -> Column:
    """Drop a keyword contained in one kept before it, then spelling variants, then cut.

    The list is bounded by the vocabulary, so folding it inside one row is cheap.
    """
    none = F.array().cast("array<string>")
    kept = F.aggregate(hits, none, lambda acc, k: F.when(
        F.exists(acc, lambda f: (f != k) & F.contains(f, k)), acc).otherwise(F.array_append(acc, k)))

    def spelled(k: Column) -> Column:
        return F.replace(k, F.lit("modelling"), F.lit("modeling"))

    unique = F.aggregate(kept, none, lambda acc, k: F.when(
        F.exists(acc, lambda f: spelled(f) == spelled(k)), acc).otherwise(F.array_append(acc, k)))
    return F.slice(unique, 1, limit)


def job_keywords(postings: DataFrame) -> DataFrame:
    """(job_id, keywords). One regex pass marks the words of a text; keywords whose words are there are searched."""
    marked = postings.select("job_id", mark_words(F.concat("title", F.lit(". "), "description")).alias("marked"))
    hits = with_words(marked).select("job_id", ats_hits("marked", "words").alias("hits"))
    return hits.select("job_id", reduce_keywords(F.col("hits")).alias("keywords"))


def candidate_text(profiles: DataFrame) -> Column:
    """What a profile says about itself, in lower case."""
    present = set(profiles.columns)
    parts = [F.coalesce("resume_text", F.lit("")), F.array_join("skills", " "), F.array_join("target_roles", " ")]
    parts += [F.coalesce(F.array_join(c, " "), F.lit("")) if c in present else F.lit("") for c in ("experience", "education")]
    return F.lower(F.concat_ws(" ", *parts))


def profile_keywords(profiles: DataFrame) -> DataFrame:
    """(profile_id, known): vocabulary keywords the profile's text names."""
    marked = profiles.select("profile_id", mark_words(candidate_text(profiles)).alias("marked"))
    return with_words(marked).select("profile_id", ats_hits("marked", "words").alias("known"))


def ats_match(pairs: DataFrame, postings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Coverage of the keywords of matched postings; ``pairs`` has profile_id, job_id and rank.

    Both sides are reduced to keyword lists once, so a pair costs two list operations.
    """
    wanted = postings.join(pairs.select("job_id").distinct(), "job_id", "left_semi")
    joined = pairs.select("profile_id", "job_id", "rank").join(job_keywords(wanted), "job_id").join(
        profile_keywords(profiles), "profile_id")
    covered = F.filter("keywords", lambda k: F.array_contains("known", k))
    n = F.size("keywords")
    return joined.select(
        "profile_id", "job_id", "rank", covered.alias("covered"),
        F.filter("keywords", lambda k: ~F.array_contains("known", k)).alias("missing"),
        n.alias("n_keywords"),
        F.when(n > 0, F.bround(F.lit(100.0) * F.size(covered) / n, 0)).otherwise(0.0).alias("score"),
    )
