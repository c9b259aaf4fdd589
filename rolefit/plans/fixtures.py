"""Postings, profiles and feedback derived from the given tables.

The SQL texts run unchanged on Spark and on DuckDB, so both sides of a check read equal inputs.
Every view covers its whole table and the whole text of every document. A posting arrives as number
2 * doc_id; posted again, as the odd number after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POSTINGS_SQL = """
WITH d AS (SELECT doc_id, text AS body, lang, source FROM {documents}),
base AS (
 SELECT 2 * doc_id AS seq, doc_id,
  split_part('Senior ML Engineer|Data Analyst|Junior Data Scientist|Staff Platform Engineer|MLOps Engineer|BI Analyst|Research Scientist|Software Developer', '|', CAST(doc_id % 8 AS INT) + 1) AS name,
  split_part('Google LLC|Acme Metalworks|Tiny Robotics|Bluebird Analytics|Capital One|Hooli Labs|Northwind', '|', CAST((doc_id * 5 + 2) % 7 AS INT) + 1) AS company,
  split_part('New York, NY|San Francisco, CA|Remote|London|Chicago, IL|Toronto|Austin, US|Bengaluru, India|', '|', CAST((doc_id * 4 + 1) % 9 AS INT) + 1) AS location,
  split_part('US|US|US|GB|US|CA|US|IN|', '|', CAST((doc_id * 4 + 1) % 9 AS INT) + 1) AS country,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(60000 + (doc_id * 7919) % 180000 AS DOUBLE) END AS salary_min,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(80000 + (doc_id * 6007) % 200000 AS DOUBLE) END AS salary_max,
  concat('<p>', split_part('Python, SQL and pandas.|Spark, Kafka and Scala pipelines.|PyTorch and deep learning, NLP.|Java microservices on Kubernetes and AWS.|Tableau, Excel and statistics.|C++17 and computer vision.|R and SQL reporting.', '|', CAST((doc_id * 3 + 1) % 7 AS INT) + 1),
   '</p> ', split_part('5+ years required.|Entry level, 1 year.|10 yrs of experience.||3 years preferred.', '|', CAST(doc_id % 5 AS INT) + 1),
   ' ', split_part('Duration: 6 months.|We will sponsor H-1B.|No visa sponsorship.|Unpaid internship.|Unpaid leave offered.|Defense contractor.|Early-stage startup.|Fortune 500 enterprise.||Full-time role.|Must be a US citizen.', '|', CAST((doc_id * 2 + 3) % 11 AS INT) + 1),
   ' ', body) AS text,
  concat('https://jobs.example.org/', CAST(doc_id AS VARCHAR(20))) AS url,
  CASE WHEN doc_id % 10 = 0 THEN 'adzuna' WHEN doc_id % 10 = 9 THEN source ELSE concat('kaggle:', source) END AS source,
  split_part('en_US|en_GB||de_DE|', '|', CAST(doc_id % 5 AS INT) + 1) AS locale,
  '2021-09-01' AS dateadded
 FROM d)
SELECT seq, name, company, location, country, salary_min, salary_max, text, url, source, locale, dateadded FROM base
UNION ALL
SELECT seq + 1 AS seq, name, company, location, country, salary_min, salary_max, text, url, source, locale, dateadded
FROM base WHERE doc_id % 5 = 0
"""

PROFILES_SQL = """
SELECT c_custkey AS profile_id, c_name AS name,
 split_part('sql,excel,tableau,python,statistics|scala,spark,kafka,java,aws,kubernetes,sql|python,pytorch,nlp,deep learning,docker,sql,pandas|c++,computer vision,python,r,spark', '|', CAST(c_custkey % 4 AS INT) + 1) AS skills_csv,
 split_part('BI Analyst,Reporting Analyst|Platform Engineer,Data Engineer,Software Developer|Machine Learning Engineer,NLP Engineer,Data Scientist|Research Engineer,Vision Scientist', '|', CAST(c_custkey % 4 AS INT) + 1) AS roles_csv,
 split_part('|chicago,remote||austin,us', '|', CAST(c_custkey % 4 AS INT) + 1) AS locations_csv,
 split_part('toronto,london|||remote,chicago', '|', CAST(c_custkey % 4 AS INT) + 1) AS preferred_csv,
 split_part('|streaming,cloud cost,Scala|language models,evaluation|', '|', CAST(c_custkey % 4 AS INT) + 1) AS emphasis_csv,
 concat(split_part('Builds reports for hospital logistics.|Runs the event pipelines of a parcel service.|Trains models that sort support letters.|Measures plants from camera pictures.', '|', CAST(c_custkey % 4 AS INT) + 1), ' Segment ', c_mktsegment, '.') AS resume_text,
 CASE WHEN c_custkey % 4 = 1 THEN FALSE ELSE TRUE END AS us_only,
 CASE c_custkey % 4 WHEN 0 THEN 70000e0 WHEN 1 THEN 165000e0 WHEN 2 THEN 125000e0 ELSE 95000e0 END * (1 + (c_custkey % 7) / 14e0) AS min_salary,
 CASE WHEN c_custkey % 4 = 3 THEN TRUE ELSE FALSE END AS exclude_defense,
 CASE WHEN c_custkey % 4 IN (0, 3) THEN 'mid' END AS max_seniority,
 CASE WHEN c_custkey % 4 = 1 THEN 'senior' END AS min_seniority,
 CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 2 THEN 6 END AS max_years_required,
 CASE WHEN c_custkey % 4 IN (0, 2) THEN TRUE ELSE FALSE END AS no_contract,
 CASE WHEN c_custkey % 4 = 2 THEN TRUE ELSE FALSE END AS needs_visa_sponsor,
 CASE WHEN c_custkey % 4 = 1 THEN 'large' END AS min_company_size,
 CASE WHEN c_custkey % 4 = 0 THEN TRUE ELSE FALSE END AS education_first,
 CASE WHEN c_custkey % 4 = 3 THEN TRUE ELSE FALSE END AS skills_first,
 CASE WHEN c_custkey % 4 = 2 THEN TRUE ELSE FALSE END AS has_publications,
 CAST(c_custkey % 4 AS INT) AS shape,
 c_custkey % (SELECT count(*) FROM {embeddings}) AS vec_id
FROM {customer}
"""

FEEDBACK_SQL = """
SELECT user_id % (SELECT count(*) FROM {customer}) AS profile_id, event_id AS seq, ts,
 2 * ((event_id * 31 + 7) % (SELECT count(*) FROM {documents})) AS posting_seq,
 CASE event_type WHEN 'purchase' THEN 'accept' WHEN 'click' THEN 'accept' WHEN 'error' THEN 'reject' WHEN 'view' THEN 'skip' ELSE 'unknown' END AS action
FROM {events}
"""

# Starting weights of the two profile shapes that bring their own.
BASE_WEIGHTS = {
    0: {"similarity": 0.25, "skills": 0.35, "title": 0.10, "salary": 0.10, "seniority": 0.05, "location": 0.15, "experience": 0.0, "company_size": 0.0},
    3: {"similarity": 0.40, "skills": 0.15, "title": 0.15, "salary": 0.05, "seniority": 0.10, "location": 0.10, "company_size": 0.05},
}


SMALL_BYTES = 32 << 20  # per task slot


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def spread_small(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to process, spread over all slots when it is small.

    A small file is one row group and hence one task. Larger tables have row groups enough and are
    scanned in place, without a shuffle.
    """
    size = stored_bytes(spark, sf_dir, name)
    slots = spark.sparkContext.defaultParallelism
    df = table(spark, sf_dir, name)
    return df.repartition(slots) if size < slots * SMALL_BYTES else df


def postings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(POSTINGS_SQL, documents=spread_small(spark, sf_dir, "documents"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))


def _csv(name: str):
    return F.filter(F.split(name, ","), lambda x: x != "")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with list columns, one row per customer."""
    flat = spark.sql(PROFILES_SQL, customer=table(spark, sf_dir, "customer"), embeddings=table(spark, sf_dir, "embeddings"))
    base = F.lit(None).cast("map<string,double>")
    for shape, weights in BASE_WEIGHTS.items():
        pairs = [F.lit(x) for item in weights.items() for x in item]
        base = F.when(F.col("shape") == shape, F.create_map(*pairs)).otherwise(base)
    return flat.select(
        "profile_id", "name", "resume_text",
        _csv("skills_csv").alias("skills"), _csv("roles_csv").alias("target_roles"),
        _csv("locations_csv").alias("locations"), _csv("preferred_csv").alias("preferred_locations"),
        _csv("emphasis_csv").alias("emphasis"),
        "us_only", "min_salary",
        F.when(F.col("exclude_defense"), F.array(F.lit("Defense"))).otherwise(F.array().cast("array<string>")).alias("exclude_industries"),
        "max_seniority", "min_seniority", "max_years_required", "no_contract", "needs_visa_sponsor",
        "min_company_size", "education_first", "skills_first",
        F.when(F.col("has_publications"), F.array(F.lit("A paper"))).otherwise(F.array().cast("array<string>")).alias("publications"),
        base.alias("base_weights"), "vec_id",
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FEEDBACK_SQL, **{t: table(spark, sf_dir, t) for t in ("events", "customer", "documents")})
