"""Profiles from JSON payloads and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.schema import PROFILE_PAYLOAD

DEFAULT_RESUME = "Experienced analyst."


def parse_profiles(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One profile per payload; dealbreaker labels become the fields the hard filters read."""
    p = payloads.select(F.from_json(column, PROFILE_PAYLOAD).alias("p")).select("p.*")
    none = F.array().cast("array<string>")

    def listed(name: str) -> Column:
        return F.coalesce(F.col(name), none)

    def ruled(label: str) -> Column:
        return F.array_contains(listed("dealbreakers"), label)

    return p.select(
        "profile_id",
        F.coalesce("name", F.lit("You")).alias("name"),
        F.coalesce(F.nullif(F.col("resume_text"), F.lit("")), F.lit(DEFAULT_RESUME)).alias("resume_text"),
        F.transform(listed("skills"), F.lower).alias("skills"),
        listed("roles").alias("target_roles"),
        F.transform(listed("locations"), F.lower).alias("locations"),
        F.transform(listed("preferred_locations"), F.lower).alias("preferred_locations"),
        "base_weights",
        F.coalesce("min_salary", F.lit(0.0)).alias("min_salary"),
        ruled("US only").alias("us_only"),
        ruled("No contract/temp").alias("no_contract"),
        F.when(ruled("No defence/military"), F.array(F.lit("defense"))).otherwise(none).alias("exclude_industries"),
        F.when(ruled("No Senior/Staff titles"), "mid").alias("max_seniority"),
        F.when(ruled("No Junior titles"), "senior").alias("min_seniority"),
        ruled("Needs visa sponsor").alias("needs_visa_sponsor"),
        "max_years_required",
        F.lit(None).cast("string").alias("min_company_size"),
        *[listed(n).alias(n) for n in ("education", "experience", "projects", "publications", "emphasis")],
        F.coalesce("education_first", F.lit(False)).alias("education_first"),
        F.coalesce("skills_first", F.lit(False)).alias("skills_first"),
        F.coalesce("contact", F.lit("")).alias("contact"),
    )


def dealbreaker_labels() -> Column:
    """The labels of a profile's rules, in the order the pickers show them."""
    defense = F.array_contains(F.transform("exclude_industries", F.lower), "defense")
    rules = [
        (F.col("us_only"), "US only"), (F.col("no_contract"), "No contract/temp"), (defense, "No defence/military"),
        (F.col("max_seniority") == "mid", "No Senior/Staff titles"), (F.col("min_seniority") == "senior", "No Junior titles"),
        (F.col("needs_visa_sponsor"), "Needs visa sponsor"),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(label)) for rule, label in rules]))


def to_payloads(profiles: DataFrame) -> DataFrame:
    """(payload): profiles as JSON texts, as a client sends them."""
    fields = ["profile_id", "name", "resume_text", "skills", F.col("target_roles").alias("roles"), "locations",
              "preferred_locations", "base_weights", "min_salary", dealbreaker_labels().alias("dealbreakers"),
              "max_years_required", "publications", "education_first", "emphasis", "skills_first"]
    return profiles.select(F.to_json(F.struct(*fields)).alias("payload"))
