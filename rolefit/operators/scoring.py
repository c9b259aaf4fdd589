"""Hard filters and scoring signals of (profile, posting) pairs as column expressions.

prepare_profiles() and prepare_postings() compute once per profile or posting what the pair
expressions need, so that no regex runs per pair. operators/judging.py applies the same rules to
whole lists where they are found: a rule changed here is to be changed there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.features import skill_overlap
from rolefit.functions.text import any_of, distinctive_tokens, mark_words, title_tokens, word_needle

POSTING_ATTRIBUTES = [
    "title", "company", "location", "country", "salary_min", "salary_max", "description", "skills", "url",
    "source", "posted_date", "seniority", "years_required", "is_contract", "sponsors_visa", "is_defense",
    "company_size", "salary_value",
]


def _level(c: Column, unknown: int) -> Column:
    out = F.lit(unknown)
    for name, rank in vocab.SENIORITY_ORDER.items():
        out = F.when(c == name, rank).otherwise(out)
    return out


def resolve_weights(explicit: Column, base: Column) -> Column:
    """struct of one weight per signal: explicit over the profile's own over the defaults.

    A weight missing from the map that was chosen counts 0.
    """
    default = F.create_map(*[F.lit(x) for item in vocab.DEFAULT_WEIGHTS.items() for x in item])
    chosen = F.when(F.size(explicit) > 0, explicit).when(F.size(base) > 0, base).otherwise(default)
    return F.struct(*[F.coalesce(F.try_element_at(chosen, F.lit(s)), F.lit(0.0)).alias(s) for s in vocab.SIGNALS])


def prepare_profiles(profiles: DataFrame, weights: Column | None = None) -> DataFrame:
    """Profile columns under a ``p_`` prefix, with words and levels ready for matching. A null field is a rule that is off."""
    no_weights = F.lit(None).cast("map<string,double>")
    none, off = F.array().cast("array<string>"), F.lit(False)
    profiles = profiles.withColumns({
        **{c: F.coalesce(c, none) for c in ("skills", "target_roles", "locations", "preferred_locations", "exclude_industries", "emphasis")},
        **{c: F.coalesce(c, off) for c in ("us_only", "no_contract", "needs_visa_sponsor")},
        "min_salary": F.coalesce("min_salary", F.lit(0).cast("double")),
    })
    wanted = F.transform("locations", F.lower)
    preferred = F.transform("preferred_locations", F.lower)
    return profiles.select(
        "profile_id",
        F.col("name").alias("p_name"),
        F.col("resume_text").alias("p_resume"),
        F.col("skills").alias("p_skills"),
        F.size("skills").alias("p_n_skills"),
        F.col("target_roles").alias("p_roles"),
        F.transform("target_roles", distinctive_tokens).alias("p_role_tokens"),
        F.transform(wanted, word_needle).alias("p_locations"),
        F.array_contains(wanted, "remote").alias("p_remote_ok"),
        F.transform(preferred, word_needle).alias("p_preferred"),
        F.array_contains(preferred, "remote").alias("p_remote_preferred"),
        F.col("us_only").alias("p_us_only"),
        F.col("min_salary").alias("p_min_salary"),
        F.array_contains(F.transform("exclude_industries", F.lower), "defense").alias("p_no_defense"),
        F.when(F.col("max_seniority") != "", _level(F.col("max_seniority"), 99)).alias("p_cap"),
        F.when(F.col("min_seniority") != "", _level(F.col("min_seniority"), 0)).alias("p_floor"),
        F.col("max_years_required").alias("p_max_years"),
        F.col("no_contract").alias("p_no_contract"),
        F.col("needs_visa_sponsor").alias("p_needs_visa"),
        F.col("min_company_size").alias("p_min_size"),
        F.col("emphasis").alias("p_emphasis"),
        resolve_weights(no_weights if weights is None else weights, F.col("base_weights")).alias("p_weights"),
    )


def prepare_postings(enriched: DataFrame) -> DataFrame:
    return enriched.withColumns({
        "j_location": F.lower("location"),
        "j_location_marked": mark_words(F.col("location")),
        "j_title_tokens": F.array_distinct(title_tokens(F.col("title"))),
        "j_level": _level(F.col("seniority"), 1),
    })


# --- hard filters: true means the posting stays ---------------------------------------------

def passes_salary() -> Column:
    return (F.col("p_min_salary") == 0) | F.coalesce(F.col("salary_value") >= F.col("p_min_salary"), F.lit(True))


def in_us() -> Column:
    """Whether a posting may lie in the US: by its country, by none or by a hint in its location."""
    country = F.lower("country")
    hinted = any_of([F.contains(F.col("j_location"), F.lit(h)) for h in vocab.US_LOCATION_HINTS])
    return (country == "") | country.isin(vocab.US_COUNTRIES) | hinted


def passes_us_only() -> Column:
    return ~F.col("p_us_only") | in_us()


def _names_any(needles: str) -> Column:
    return F.exists(needles, lambda n: F.contains(F.col("j_location_marked"), n))


def passes_locations() -> Column:
    return (
        (F.size("p_locations") == 0)
        | (F.col("p_remote_ok") & F.contains(F.col("j_location"), F.lit("remote")))
        | _names_any("p_locations")
    )


def passes_contract() -> Column:
    return ~(F.col("p_no_contract") & F.coalesce("is_contract", F.lit(False)))


def passes_seniority() -> Column:
    return F.coalesce(F.col("j_level") <= F.col("p_cap"), F.lit(True)) & F.coalesce(F.col("j_level") >= F.col("p_floor"), F.lit(True))


def passes_years() -> Column:
    return F.coalesce(F.coalesce("years_required", F.lit(0)) <= F.col("p_max_years"), F.lit(True))


def passes_industry() -> Column:
    return ~(F.col("p_no_defense") & F.coalesce("is_defense", F.lit(False)))


def passes_company_size() -> Column:
    return F.coalesce(~((F.col("p_min_size") == "large") & (F.col("company_size") == "small")), F.lit(True))


def passes_visa() -> Column:
    return F.coalesce(~F.col("p_needs_visa") | F.col("sponsors_visa"), F.lit(True))


# Cheapest first: they are evaluated in this order and stop at the first that fails.
HARD_FILTERS = {
    "f_salary": passes_salary, "f_contract": passes_contract, "f_seniority": passes_seniority, "f_years": passes_years,
    "f_industry": passes_industry, "f_visa": passes_visa, "f_company_size": passes_company_size,
    "f_us_only": passes_us_only, "f_locations": passes_locations,
}


def passes_all() -> Column:
    return reduce(lambda a, b: a & b, [rule() for rule in HARD_FILTERS.values()])


# --- scoring signals -------------------------------------------------------------------------

def sig_skills() -> Column:
    return skill_overlap(F.col("skills"), F.col("p_skills")) / F.greatest(F.lit(1), F.col("p_n_skills")).cast("double")


def sig_title() -> Column:
    def share(tokens: Column) -> Column:
        hits = F.size(F.filter(tokens, lambda t: F.array_contains(F.col("j_title_tokens"), t)))
        return hits / F.greatest(F.lit(1), F.size(tokens)).cast("double")

    best = F.array_max(F.transform("p_role_tokens", share))
    return F.when(F.size("j_title_tokens") == 0, F.lit(0.0)).otherwise(F.coalesce(best, F.lit(0.0)))


def sig_salary() -> Column:
    return (
        F.when((F.col("p_min_salary") == 0) | F.col("salary_value").isNull(), 0.5)
        .when(F.col("salary_value") >= F.col("p_min_salary"), 1.0).otherwise(0.0)
    )


def sig_seniority() -> Column:
    return (
        F.when(F.col("p_cap").isNotNull(), (F.col("j_level") <= F.col("p_cap")).cast("double"))
        .when(F.col("p_floor").isNotNull(), (F.col("j_level") >= F.col("p_floor")).cast("double"))
        .otherwise(0.5)
    )


def sig_location() -> Column:
    preferred = (F.col("p_remote_preferred") & F.contains(F.col("j_location"), F.lit("remote"))) | _names_any("p_preferred")
    return F.when(F.size("p_preferred") == 0, 0.5).when(preferred, 1.0).otherwise(0.3)


def sig_experience() -> Column:
    years = F.coalesce("years_required", F.lit(0))
    cap = F.col("p_max_years")
    return (
        F.when(cap.isNull(), 0.5).when(years > cap, 0.0)
        .otherwise(1.0 - 0.5 * (years / F.greatest(F.lit(1), cap).cast("double")))
    )


def sig_company_size() -> Column:
    return F.when(F.col("company_size") == "large", 1.0).when(F.col("company_size") == "small", 0.0).otherwise(0.5)


def signals() -> Column:
    """struct of the eight signals; every one lies in [0, 1] except the raw similarity."""
    parts = {
        "similarity": F.col("similarity"), "skills": sig_skills(), "title": sig_title(), "salary": sig_salary(),
        "seniority": sig_seniority(), "location": sig_location(), "experience": sig_experience(),
        "company_size": sig_company_size(),
    }
    return F.struct(*[parts[s].alias(s) for s in vocab.SIGNALS])


def total_score(breakdown: str = "breakdown", weights: str = "p_weights") -> Column:
    """Weighted sum in fixed signal order, rounded so that ranking does not hinge on the last bits."""
    total = F.lit(0.0)
    for s in vocab.SIGNALS:
        total = total + F.col(f"{weights}.{s}") * F.col(f"{breakdown}.{s}")
    return F.round(total, 12)
