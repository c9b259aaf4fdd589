"""Map raw postings of any column naming onto the canonical schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolefit import vocab
from rolefit.functions.features import BLOB, LOWERED, extract_skills, with_lowered
from rolefit.functions.text import content_key, strip_html, strip_ws


def resolve_aliases(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pick, per canonical column, the first alias the frame has; absent columns become null."""
    present = {name.lower(): name for name in raw.columns}
    picked = []
    for field, aliases in vocab.COLUMN_ALIASES.items():
        found = next((present[a] for a in aliases if a in present), None)
        column = F.col(f"`{found}`") if found else F.lit(None).cast("string")
        picked.append(column.alias(field))
    return raw.select(*keep, *picked)


def fill_text(df: DataFrame, default_source: str) -> DataFrame:
    """Nulls to defaults, everything to text; names and places are stripped."""
    def text(name: str, default: str = ""):
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    return df.withColumns({
        "title": strip_ws(text("title")),
        "company": strip_ws(text("company", "Unknown")),
        "location": strip_ws(text("location")),
        "country": strip_ws(text("country")),
        "description": strip_html(text("description")),
        "url": text("url"),
        "source": text("source", default_source),
        "posted_date": text("posted_date"),
    })


def coerce_salary(df: DataFrame) -> DataFrame:
    """Anything that is not a number becomes null."""
    def number(name: str):
        value = F.col(name).try_cast("double") if isinstance(df.schema[name].dataType, T.StringType) \
            else F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({"salary_min": number("salary_min"), "salary_max": number("salary_max")})


def drop_unusable(df: DataFrame) -> DataFrame:
    return df.filter((F.col("title") != "") | (F.col("description") != ""))


def fill_skills(df: DataFrame) -> DataFrame:
    """Keep a given list, re-extract from a given string, else derive from title and text."""
    derived = extract_skills(BLOB, LOWERED)
    if isinstance(df.schema["skills"].dataType, T.ArrayType):
        column = F.when(F.size("skills") > 0, F.col("skills")).otherwise(derived)
    else:
        column = F.when(F.length("skills") > 2, extract_skills("skills")).otherwise(derived)
    return with_lowered(df).withColumn("skills", column).drop(LOWERED)


def normalize(raw: DataFrame, source: str = "kaggle", keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical postings. ``keep`` names extra raw columns to carry along (e.g. an order column)."""
    df = coerce_salary(fill_text(resolve_aliases(raw, keep), source))
    df = fill_skills(drop_unusable(df))
    return df.select(
        *keep,
        content_key(F.col("title"), F.col("company"), F.col("location"), F.col("description")).alias("job_id"),
        *vocab.CANONICAL_FIELDS[1:],
    )
