"""Landed result pages of a live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit.functions.text import strip_ws
from rolefit.schema import LIVE_PAGE

# Sentences that carry the structured employment type into the text.
CONTRACT_TEXT = "Employment type: contract."
PERMANENT_TEXT = "Employment type: permanent / full-time."
PART_TIME_TEXT = "This is a part-time position."


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LIVE_PAGE).json(path)


def stream_pages(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Pages as they land; the checkpoint of the query is the paging cursor."""
    return spark.readStream.schema(LIVE_PAGE).option("maxFilesPerTrigger", max_files).json(path)


def usable_pages(pages: DataFrame, start_page: int = 1, n_pages: int | None = None) -> DataFrame:
    """Pages of each query from the cursor on, up to its first failed or empty page."""
    wanted = pages.filter(F.col("page") >= start_page)
    if n_pages is not None:
        wanted = wanted.filter(F.col("page") < start_page + n_pages)
    bad = F.coalesce("error", F.lit(False)) | (F.coalesce(F.size("results"), F.lit(0)) <= 0)
    stops = wanted.filter(bad).groupBy("query").agg(F.min("page").alias("stop"))
    return wanted.join(stops, "query", "left").filter(F.col("stop").isNull() | (F.col("page") < F.col("stop"))).drop("stop")


def fold_employment(description: Column, contract_type: Column, contract_time: Column) -> Column:
    """Description with the structured employment type as text, so text detectors see it."""
    kind, time = F.lower(F.coalesce(contract_type, F.lit(""))), F.lower(F.coalesce(contract_time, F.lit("")))
    notes = F.array_compact(F.array(
        F.when(kind == "contract", CONTRACT_TEXT).when(kind == "permanent", PERMANENT_TEXT),
        F.when(time == "part_time", PART_TIME_TEXT)))
    text = F.coalesce(description, F.lit(""))
    return F.when(F.size(notes) > 0, strip_ws(F.concat(text, F.lit(" "), F.array_join(notes, " ")))).otherwise(text)


def live_rows(pages: DataFrame, country: str = "us") -> DataFrame:
    """Flat raw rows of the results; works on batch and streaming frames."""
    r = pages.select(F.explode("results").alias("r"))
    return r.select(
        F.col("r.seq").alias("seq"),
        F.coalesce("r.title", F.lit("")).alias("title"),
        F.coalesce("r.company.display_name", F.lit("Unknown")).alias("company"),
        F.coalesce("r.location.display_name", F.lit("")).alias("location"),
        F.lit(country.upper()).alias("country"),
        F.col("r.salary_min").alias("salary_min"), F.col("r.salary_max").alias("salary_max"),
        fold_employment(F.col("r.description"), F.col("r.contract_type"), F.col("r.contract_time")).alias("description"),
        F.coalesce("r.redirect_url", F.lit("")).alias("url"),
        F.lit("adzuna").alias("source"),
        F.coalesce("r.created", F.lit("")).alias("dateAdded"),
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
