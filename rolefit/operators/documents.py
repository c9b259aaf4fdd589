"""Template texts for each matched posting: skill order, summary, cover letter, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.formats import fill
from rolefit.functions.text import pretty_skill, strip_ws
from rolefit.operators.explain import matched_skills

SECTIONS = ["experience", "projects", "skills", "education"]


def skill_order() -> Column:
    """Profile skills: those of an emphasised theme first (by theme), then matched ones, then the rest."""
    lowered = F.transform("p_emphasis", F.lower)

    def rank(skill: Column, index: Column) -> Column:
        theme = F.array_position(F.transform(lowered, lambda e: F.contains(F.lower(skill), e) | F.contains(e, F.lower(skill))), True)
        place = F.when(theme > 0, theme - 1).otherwise(
            F.lit(1_000_000).cast("bigint") + F.when(F.array_contains("skills", skill), 0).otherwise(1))
        return F.struct(place.alias("place"), index.alias("i"), skill.alias("skill"))

    return F.transform(F.array_sort(F.transform("p_skills", rank)), lambda s: s["skill"])


def ordered_skills(ranked: DataFrame) -> DataFrame:
    return ranked.select("profile_id", "job_id", "rank", F.transform(skill_order(), pretty_skill).alias("skills_shown"))


def _join(items: Column, n: int) -> Column:
    return F.array_join(F.slice(items, 1, n), ", ")


def tailored_texts(ranked: DataFrame, coverage: DataFrame) -> DataFrame:
    """A summary and a cover letter per match, from ranked rows and their ats_match() rows."""
    rows = ranked.join(coverage.select("profile_id", "job_id", "covered"), ["profile_id", "job_id"])
    matched = matched_skills()
    lead = _join(F.col("p_emphasis"), 3)
    top = F.when(F.size("covered") > 0, F.col("covered")).when(F.size(matched) > 0, matched).otherwise(F.col("p_skills"))
    has_roles, first_role = F.size("p_roles") > 0, F.try_element_at("p_roles", F.lit(1))
    names = {"title": F.col("title"), "company": F.col("company")}
    summary = fill(
        vocab.SUMMARY_TEXT, **names,
        focus=F.when(lead != "", F.concat(lead, F.lit("-focused "))).otherwise(""),
        role=F.when(has_roles, first_role).otherwise("Analytics professional"),
        roles=F.when(has_roles, _join(F.col("p_roles"), 3)).otherwise(F.col("title")),
        strength=F.when(lead != "", lead).otherwise(_join(top, 5)))
    opening = fill(
        vocab.OPENING_TEXT, **names,
        role=F.when(has_roles, first_role).otherwise("a candidate"),
        strength=F.when(F.size("p_emphasis") > 0, _join(F.col("p_emphasis"), 5))
        .when(F.size(matched) > 0, _join(matched, 5)).otherwise(_join(F.col("p_skills"), 5)))
    closing = fill(
        vocab.CLOSING_TEXT, **names,
        strength=F.when(F.size(matched) > 0, _join(matched, 4)).otherwise("the core skills you list"))
    letter = F.filter(F.array(opening, strip_ws(F.col("p_resume")), closing), lambda p: strip_ws(p) != "")
    return rows.select("profile_id", "job_id", "rank", summary.alias("summary"), F.array_join(letter, "\n\n").alias("cover_letter"))


def split_entry(entry: Column) -> Column:
    """struct<title, bullet> of "Title — description"; without a dash all of it is the bullet."""
    parts = F.split(entry, r"\s[—–-]\s", 2)
    two = F.size(parts) == 2
    return F.struct(
        F.when(two, strip_ws(parts[0])).otherwise("").alias("title"),
        F.when(two, strip_ws(F.try_element_at(parts, F.lit(2)))).otherwise(entry).alias("bullet"))


def section_order(profiles: DataFrame) -> DataFrame:
    def names(*values: str) -> Column:
        return F.array(*[F.lit(v) for v in values])

    body = (
        F.when(F.col("education_first"), names("education", "experience", "projects", "skills"))
        .when(F.col("skills_first"), names("skills", "experience", "projects", "education"))
        .otherwise(names(*SECTIONS))
    )
    lead = F.when(F.size("publications") > 0, names("profile", "publications")).otherwise(names("profile"))
    return profiles.select("profile_id", F.concat(lead, body).alias("sections"))
