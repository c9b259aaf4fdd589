"""Readers of nested posting dumps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.text import strip_ws
from rolefit.schema import NESTED_POSTING

MIN_TEXT = 40


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines dump; lines that do not parse are left out."""
    return spark.read.schema(NESTED_POSTING).option("mode", "DROPMALFORMED").json(path)


def _first(*columns: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _named(c: Column, field: str) -> Column:
    """A text value, or one field of it when it holds a JSON object."""
    return F.when(F.startswith(c, F.lit("{")), F.get_json_object(c, f"$.{field}")).otherwise(c)


def flatten_posting(nested: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat raw columns by fallback chains; records without title or enough text are left out."""
    organization = F.col("json.schemaOrg.hiringOrganization")
    company = _first(F.col("orgCompany.name"), F.col("orgAddress.companyName"), _named(organization, "name"), F.lit("Unknown"))
    flat = nested.select(
        *keep,
        strip_ws(_first(F.col("name"), F.col("position.name"), F.lit(" "))).alias("name"),
        _first(strip_ws(company), F.lit("Unknown")).alias("company"),
        F.coalesce(strip_ws(_first(F.col("orgAddress.addressLine"), F.col("orgAddress.formatted"))), F.lit("")).alias("location"),
        F.upper(F.coalesce(_first(F.col("orgAddress.countryCode"), F.col("sourceCC")), F.lit(""))).alias("country"),
        strip_ws(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.concat(F.lit("kaggle:"), F.coalesce("source", F.lit("techmap"))).alias("source"),
        F.substring(F.coalesce(_named(F.col("dateCreated"), "$date"), F.lit("")), 1, 10).alias("dateAdded"),
        F.coalesce("locale", F.lit("")).alias("locale"),
        F.coalesce("idInSource", F.lit("")).alias("id_in_source"),
    )
    return flat.filter((F.col("name") != "") & (F.length("text") >= MIN_TEXT))


def is_english(locale: Column, country: Column) -> Column:
    """By locale when given, else by country."""
    locale, country = F.lower(F.coalesce(locale, F.lit(""))), F.lower(F.coalesce(country, F.lit("")))
    return F.when(F.startswith(locale, F.lit("en")), True).when(locale != "", False).otherwise(country.isin(vocab.ENGLISH_COUNTRIES))


def _next_line(stream, offset: int) -> str | None:
    """The first whole line after an offset, or None past the last one."""
    stream.seek(offset)
    rest = b""
    while True:
        chunk = stream.read(65_536)
        rest += chunk
        lines = rest.split(b"\n", 2)
        if len(lines) == 3 or (not chunk and len(lines) == 2 and lines[1]):
            return lines[1].decode("utf-8", "replace")
        if not chunk:
            return None


def peek_lines(spark: SparkSession, uri: str, n: int, seed: int = 42, tasks: int = 8) -> DataFrame:
    """(draw, line): n seeded looks into huge text files below a folder, without scanning them.

    Each draw picks a random byte of all files, drops the partial line there and takes the next
    one, so longer lines are slightly more likely, and a line can be drawn twice. The files must be
    readable from every executor. A look past the last line of a file yields no row.
    """
    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(uri)
        listed = system.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f.path, f.size) for f in listed if f.is_file and f.size and not f.base_name.startswith(("_", ".")))
        ends = np.cumsum([size for _, size in files])
        for frame in frames:
            at = (frame["share"].to_numpy() * ends[-1]).astype("int64")
            owner = np.searchsorted(ends, at, side="right")
            lines: dict[int, str | None] = {}
            for f in np.unique(owner):
                with system.open_input_file(files[f][0]) as stream:
                    for row in np.nonzero(owner == f)[0]:
                        lines[row] = _next_line(stream, int(at[row] - (ends[f] - files[f][1])))
            out = pd.DataFrame({"draw": frame["draw"], "line": [lines[row] for row in range(len(frame))]})
            yield out[out["line"].notna()]

    draws = spark.range(0, n, 1, tasks).select(
        F.col("id").alias("draw"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("double")
         / F.lit(float(16 ** 12))).alias("share"))
    return draws.mapInPandas(look, "draw bigint, line string")
