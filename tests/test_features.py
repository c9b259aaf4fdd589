"""Edge cases of the text rules on inline rows."""

import pytest
from pyspark.sql import functions as F

from rolefit.functions import features, formats, text
from rolefit.functions.features import enrich
from rolefit.operators import ats
from rolefit.operators.documents import split_entry
from rolefit.operators.normalize import normalize


def enriched(spark, title="Engineer", description="", company="Acme", low=None, high=None):
    raw = spark.createDataFrame([(title, company, description, low, high)], "title string, company string, description string, salary_min double, salary_max double")
    return enrich(normalize(raw)).first()


@pytest.mark.parametrize("words, skills", [
    ("C++ dev", []), ("C++17", ["c++"]), ("R&D", ["r"]), ("r2", []), ("JavaScript only", []), ("Java and javascript", ["java"]),
    ("scikit learn, PySpark", ["scikit-learn", "spark"]), ("spark", ["spark"]), ("PowerBI", ["power bi"]), ("", []), ("réseau r.", ["r"]),
])
def test_skills(spark, words, skills):
    found = spark.createDataFrame([(words,)], "t string").select(features.extract_skills("t").alias("s")).first()["s"]
    assert found == skills


@pytest.mark.parametrize("description, expected", [
    ("unpaid leave", False), ("unpaid internship", True), ("Duration: 6 months", True), ("12-month engagement", True),
    ("contractual", False), ("corp to corp", True), ("no compensation", True),
])
def test_contract(spark, description, expected):
    assert enriched(spark, description=description)["is_contract"] is expected


@pytest.mark.parametrize("description, expected", [
    ("No visa sponsorship", False), ("We will sponsor", True), ("", None), ("US citizens only", False),
    ("sponsorship is available", True), ("cannot sponsor, H1B", False),
])
def test_sponsorship(spark, description, expected):
    assert enriched(spark, description=description)["sponsors_visa"] is expected


@pytest.mark.parametrize("company, description, expected", [
    ("Acme Metalworks", "", "large"), ("Tiny Inc", "seed stage", "small"), ("Google", "small team", "large"),
    ("Acme", "Fortune 500", "large"), ("Acme", "", "unknown"), ("Acme", "1000+ employees", "large"),
])
def test_company_size(spark, company, description, expected):
    assert enriched(spark, company=company, description=description)["company_size"] == expected


@pytest.mark.parametrize("title, description, level, years", [
    ("Engineer", "5+ years, 10 yrs", "mid", 10), ("Staff Engineer", "", "staff", 8), ("Engineer", "you lead", "senior", 5),
    ("Engineer entry", "level", "junior", 0), ("Junior", "99999999999 years", "junior", 0),
])
def test_level_and_years(spark, title, description, level, years):
    row = enriched(spark, title=title, description=description)
    assert (row["seniority"], row["years_required"]) == (level, years)


def test_salary_value(spark):
    assert enriched(spark, low=10.0, high=20.0)["salary_value"] == 15.0
    assert enriched(spark, low=10.0)["salary_value"] == 10.0
    assert enriched(spark)["salary_value"] is None


def test_content_key_ignores_case_and_blanks(spark):
    rows = spark.createDataFrame([("A", " x  \n y" + "z" * 200), ("a", "X Y" + "Z" * 300)], "title string, description string")
    keys = [r["job_id"] for r in normalize(rows).select("job_id").collect()]
    assert keys[0] == keys[1] and len(keys[0]) == 16


def test_whole_words_by_marks(spark):
    cases = [("Chicago, IL", "ca", False), ("Austin, US", "us", True), ("New York, NY", "new york", True), ("busy", "us", False),
             ("a, us", ", us", True), (", us", ", us", False)]
    rows = spark.createDataFrame(cases, "place string, word string, expected boolean")
    got = rows.select("expected", F.contains(text.mark_words(F.col("place")), text.word_needle(F.col("word"))).alias("hit")).collect()
    assert [r["hit"] for r in got] == [r["expected"] for r in got]


def test_links_and_labels(spark):
    row = spark.range(1).select(
        formats.job_link(F.lit("adzuna"), F.lit("http://x"), F.lit("t"), F.lit("c"), F.lit("l")).alias("live"),
        formats.job_link(F.lit("other"), F.lit("http://x"), F.lit("C++ ~*"), F.lit("c"), F.lit("")).alias("search"),
        formats.salary_label(F.lit(100000.0), F.lit(150500.0), F.lit(1.0)).alias("span"),
        formats.salary_label(F.lit(None).cast("double"), F.lit(90000.0), F.lit(90000.0)).alias("one")).first()
    assert row["live"] == "http://x"
    assert row["search"].endswith("q=C%2B%2B+~%2A+c+job")
    assert row["span"] == "$100k–$150k" and row["one"] == "$90,000"


def test_keywords_drop_parts_and_variants(spark):
    posting = spark.createDataFrame([("1", "Analyst", "Financial modelling, financial modeling, data warehouse, stakeholders")],
                                    "job_id string, title string, description string")
    found = ats.job_keywords(posting).first()["keywords"]
    assert found == ["financial modeling", "data warehouse", "stakeholders", "analyst"]


def test_split_entry(spark):
    entries = spark.createDataFrame([("Lead — built it - well",), ("no dash",)], "e string")
    rows = entries.select(split_entry(F.col("e")).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in rows] == [("Lead", "built it - well"), ("", "no dash")]
