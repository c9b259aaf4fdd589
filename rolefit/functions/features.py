"""Structured features read from the free text of a posting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.text import cued_match, quoted


# Lower-cased "title. description", computed once per row and read by all cue searches.
LOWERED = "_lowered"
BLOB = "concat(title, '. ', description)"


def with_lowered(df: DataFrame) -> DataFrame:
    return df.withColumn(LOWERED, F.lower(F.expr(BLOB)))


def extract_skills(text: str, lowered: str | None = None, patterns: dict[str, str] | None = None,
                   cues: dict[str, list[str]] | None = None) -> Column:
    """Sorted vocabulary skills named in a text; both texts are column names or SQL expressions."""
    lowered = lowered or f"lower({text})"
    patterns = vocab.SKILL_PATTERNS if patterns is None else patterns
    cues = vocab.SKILL_CUES if cues is None else cues
    hits = ", ".join(
        f"CASE WHEN {cued_match(text, lowered, patterns[name], cues.get(name, []))} THEN {quoted(name)} END" for name in sorted(patterns))
    return F.expr(f"array_compact(array({hits}))")


def skill_overlap(job_skills: Column, profile_skills: Column) -> Column:
    """Number of distinct skills on both sides."""
    return F.size(F.array_intersect(job_skills, profile_skills))


def seniority() -> Column:
    # Title and description are joined by a space here: a match may span both.
    text = "concat(title, ' ', description)"
    whens = " ".join(
        f"WHEN {cued_match(text, LOWERED, pattern, vocab.FLAG_CUES[level])} THEN {quoted(level)}" for level, pattern in vocab.SENIORITY_PATTERNS)
    return F.expr(f"CASE {whens} ELSE 'mid' END")


def stated_years(description: Column) -> Column:
    """Largest number of years named, 0 if none; numbers too large for an int are ignored."""
    found = F.regexp_extract_all(description, F.lit("(?i)" + vocab.YEARS_PATTERN), F.lit(1))
    return F.coalesce(F.array_max(F.transform(found, lambda n: n.try_cast("int"))), F.lit(0))


def years_required(description: Column, level: Column) -> Column:
    implied = F.lit(0)
    for name, years in vocab.IMPLIED_YEARS.items():
        implied = F.when(level == name, years).otherwise(implied)
    return F.greatest(stated_years(description), implied)


def _flag(name: str, pattern: str) -> Column:
    return F.expr(cued_match(BLOB, LOWERED, pattern, vocab.FLAG_CUES[name]))


def is_contract() -> Column:
    return _flag("contract", vocab.CONTRACT_PATTERN)


def sponsors_visa() -> Column:
    """False when ruled out, true when offered, null when the text does not say."""
    return (
        F.when(_flag("no_sponsor", vocab.NO_SPONSOR_PATTERN), F.lit(False))
        .when(_flag("sponsor", vocab.SPONSOR_PATTERN), F.lit(True))
    )


def is_defense() -> Column:
    return _flag("defense", vocab.DEFENSE_PATTERN)


def company_size(large_employers: list[str] | None = None) -> Column:
    names = vocab.LARGE_EMPLOYERS if large_employers is None else large_employers
    known_large = F.expr(" OR ".join(f"contains(lower(company), {quoted(name)})" for name in names))
    return (
        F.when(known_large, "large")
        .when(_flag("small", vocab.SMALL_PATTERN), "small")
        .when(_flag("large", vocab.LARGE_PATTERN), "large")
        .otherwise("unknown")
    )


def salary_value(low: Column, high: Column) -> Column:
    """Mean of the bounds that are known."""
    return F.coalesce((low + high) / 2, low, high)


def enrich(postings: DataFrame) -> DataFrame:
    """Add the seven derived columns; replaces them when they are already there.

    Narrow projections only: no shuffle, and columns a query does not use are pruned together with
    their regexes. Canonical postings have no null title, company or description.
    """
    return with_lowered(postings).withColumns({
        "seniority": seniority(),
        "is_contract": is_contract(),
        "sponsors_visa": sponsors_visa(),
        "is_defense": is_defense(),
        "company_size": company_size(),
        "salary_value": salary_value(F.col("salary_min"), F.col("salary_max")),
    }).withColumn("years_required", years_required(F.col("description"), F.col("seniority"))).drop(LOWERED)


def job_text(title: Column, skills: Column, description: Column) -> Column:
    """Text a posting is embedded by."""
    return F.concat(title, F.lit(". "), F.array_join(skills, " "), F.lit(". "), F.substring(description, 1, 500))


def lexical_text(title: Column, skills: Column, description: Column) -> Column:
    """Text a posting is found by in lexical retrieval."""
    return F.concat_ws(" ", title, F.array_join(skills, " "), F.substring(description, 1, 400))


def profile_text(roles: Column, skills: Column, resume: Column) -> Column:
    """Text a profile is embedded by; skills are repeated for emphasis."""
    from rolefit.functions.text import strip_ws

    return strip_ws(F.concat(F.array_join(roles, " "), F.lit(". "),
                             F.array_join(F.concat(skills, skills), " "), F.lit(". "), resume))
