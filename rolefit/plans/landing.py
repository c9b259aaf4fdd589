"""Inputs that arrive as files, written by Spark from the given tables into the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefit.plans import fixtures
from rolefit.plans.inputs import Inputs
from rolefit.session import shared_dir

PAGE_SIZE = 50
LANDED_BYTES = 16 << 20  # of the stored table behind one landed file


def is_repost():
    return F.col("seq") % 2 == 1


def posting_no():
    """The number that a posting and its repost have in common."""
    return F.shiftright("seq", 1)


# The same record shapes on the SQL side: see the block "nested" of the oracle.
def nested_lines(inputs: Inputs) -> DataFrame:
    """JSON texts of nested records that take turns in where they keep title, company and so on.

    Some lines are cut off, as in a dump whose writer crashed.
    """
    raw = inputs.raw
    turn = posting_no() % 5
    organization = (
        F.when(turn == 2, F.to_json(F.struct(F.col("company").alias("v"))))
        .when(turn == 3, F.to_json(F.struct(F.struct(F.col("company").alias("name")).alias("v")))))
    first = F.struct(
        F.when(posting_no() % 3 != 0, F.col("name")).alias("name"),
        F.struct(F.when(posting_no() % 3 == 0, F.col("name")).alias("name")).alias("position"),
        "text",
        F.struct(F.when(turn == 0, F.col("company")).alias("name")).alias("orgCompany"),
        F.struct(
            F.when(turn == 1, F.col("company")).alias("companyName"),
            F.when(posting_no() % 2 == 0, F.col("location")).alias("addressLine"),
            F.when(posting_no() % 2 == 1, F.col("location")).alias("formatted"),
            F.when(posting_no() % 4 != 0, F.lower("country")).alias("countryCode")).alias("orgAddress"),
        F.when(posting_no() % 4 == 0, F.col("country")).alias("sourceCC"),
        "url", "source", "locale", posting_no().cast("string").alias("idInSource"), "seq")
    date = F.when(posting_no() % 2 == 0, F.lit('"2021-09-01T10:00:00Z"')).otherwise('{"$date": "2021-09-01T10:00:00Z"}')
    line = F.concat(
        F.regexp_replace(F.to_json(first), r"\}$", ""), F.lit(', "dateCreated": '), date,
        F.when(organization.isNotNull(), F.concat(
            F.lit(', "json": {"schemaOrg": {"hiringOrganization": '), F.regexp_replace(organization, r'^\{"v":|\}$', ""), F.lit("}}")))
        .otherwise(""), F.lit("}"))
    broken = raw.filter(posting_no() % 7 == 0).select(F.concat(F.lit('{"name": "cut off", "seq": '), F.col("seq").cast("string")).alias("value"))
    return raw.select(line.alias("value")).union(broken)


def land_dump(inputs: Inputs) -> str:
    path = shared_dir(inputs.spark, "dump")
    nested_lines(inputs).write.text(path)
    return path


def live_part(raw: DataFrame) -> DataFrame:
    """What the live feed delivers: its own postings and everything that was posted again."""
    return raw.filter((F.col("source") == "adzuna") | is_repost())


def dump_part(raw: DataFrame) -> DataFrame:
    return raw.filter((F.col("source") != "adzuna") & ~is_repost())


def result_pages(inputs: Inputs) -> DataFrame:
    """Pages of at most PAGE_SIZE results for three queries; query q1 fails on its page 2."""
    live = live_part(inputs.raw)
    result = F.struct(
        "seq", F.col("name").alias("title"), F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(F.col("location").alias("display_name")).alias("location"), "salary_min", "salary_max",
        F.col("text").alias("description"), F.col("url").alias("redirect_url"), F.col("dateadded").alias("created"),
        F.when(posting_no() % 4 == 0, "permanent").when(posting_no() % 4 == 1, "contract").alias("contract_type"),
        F.when(posting_no() % 3 == 0, "part_time").when(posting_no() % 3 == 1, "full_time").alias("contract_time"))
    query = F.concat(F.lit("q"), (posting_no() % 3).cast("string"))
    page = (F.floor(posting_no() / (3 * PAGE_SIZE)) + 1).cast("int")
    return (
        live.select(query.alias("query"), page.alias("page"), result.alias("result"))
        .groupBy("query", "page").agg(F.sort_array(F.collect_list("result")).alias("results"))
        .withColumn("error", (F.col("query") == "q1") & (F.col("page") == 2))
    )


def land_pages(inputs: Inputs) -> str:
    path = shared_dir(inputs.spark, "pages")
    result_pages(inputs).write.json(path)
    return path


def land_rows(rows: DataFrame, path: str, files: int, mode: str = "errorifexists") -> None:
    """Rows as JSON files that are ordered by arrival."""
    rows.repartitionByRange(files, "seq").write.mode(mode).json(path)


def file_count(inputs: Inputs, table: str, least: int) -> int:
    """A multiple of ``least`` that grows with a table, so that no task writes or reads a fixed share of it."""
    return least * max(1, -(-fixtures.stored_bytes(inputs.spark, inputs.sf_dir, table) // (least * LANDED_BYTES)))
