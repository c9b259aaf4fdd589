"""Aggregate market reports over a whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefit.functions.text import strip_ws

SALARY_FLOOR, SALARY_CEILING = 10_000, 600_000
MEDIAN_BIN = 100  # width in salary units: 5,900 bins between floor and ceiling


def skill_counts(postings: DataFrame) -> DataFrame:
    return postings.select(F.explode("skills").alias("skill")).groupBy("skill").agg(F.count(F.lit(1)).alias("count"))


def top_skills(postings: DataFrame, n: int = 20) -> DataFrame:
    return skill_counts(postings).orderBy(F.desc("count"), "skill").limit(n)


def salary_distribution(enriched: DataFrame) -> DataFrame:
    """Salaries without obvious parse errors."""
    salary = F.col("salary_value")
    return enriched.filter((salary > SALARY_FLOOR) & (salary < SALARY_CEILING)).select("job_id", salary.alias("salary"))


def salary_histogram(enriched: DataFrame, bins: int = 30) -> DataFrame:
    salaries = salary_distribution(enriched)
    bounds = salaries.agg(F.min("salary").alias("lo"), F.max("salary").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    bucket = F.least(F.floor((F.col("salary") - lo) * bins / F.nullif(hi - lo, F.lit(0.0))).cast("int") + 1, F.lit(bins))
    return (
        salaries.select(F.coalesce(bucket, F.lit(1)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
        .withColumn("bin_start", F.round(lo + (F.col("bin") - 1) * (hi - lo) / bins, 4))
    )


def demand_by_location(postings: DataFrame, n: int = 15) -> DataFrame:
    place = F.coalesce(F.nullif(strip_ws(F.col("location")), F.lit("")), F.lit("Unknown"))
    return (
        postings.groupBy(place.alias("location")).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "location").limit(n)
    )


def demand_by_source(postings: DataFrame) -> DataFrame:
    kind = (
        F.when(F.contains("source", F.lit("adzuna")), "Adzuna (live)")
        .when(F.contains("source", F.lit("kaggle")), "Kaggle").otherwise("Other")
    )
    return postings.groupBy(kind.alias("source")).agg(F.count(F.lit(1)).alias("count"))


def exact_median(values: DataFrame, column: str) -> DataFrame:
    """One row with the exact median of values between the salary floor and ceiling.

    Counting per bin finds the bins of the middle ranks; only the distinct values of those bins
    are then ranked. The built-in exact median would gather every distinct value in one task.
    """
    return median_of_counts(values.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c")))


def median_of_counts(counted: DataFrame) -> DataFrame:
    """The same from (v, c): values and how often each occurs."""
    counted = counted.withColumn("bin", F.floor(F.col("v") / MEDIAN_BIN).cast("int"))
    bins = counted.groupBy("bin").agg(F.sum("c").alias("c"))
    everything = Window.orderBy("bin")
    upto = bins.select("bin", (F.sum("c").over(everything) - F.col("c")).alias("before"), "c",
                       F.sum("c").over(Window.partitionBy()).alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    middle = upto.filter((F.col("before") < high) & (F.col("before") + F.col("c") >= low)).select(
        "bin", "before", low.alias("low"), high.alias("high"))
    within = F.sum("c").over(Window.partitionBy("bin").orderBy("v"))
    ranked = counted.join(middle, "bin").withColumn("last", F.col("before") + within)
    first = F.col("last") - F.col("c") + 1
    pick_low = F.when((first <= F.col("low")) & (F.col("last") >= F.col("low")), F.col("v"))
    pick_high = F.when((first <= F.col("high")) & (F.col("last") >= F.col("high")), F.col("v"))
    return ranked.agg(((F.max(pick_low) + F.max(pick_high)) / 2).alias("median"))


def summary_stats(enriched: DataFrame) -> DataFrame:
    """One row of figures. Postings are read once: companies, locations and salaries are counted by value in one exchange, which all figures share."""
    known = (F.col("salary_value") > SALARY_FLOOR) & (F.col("salary_value") < SALARY_CEILING)

    def cell(kind: str, text: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), value.cast("double").alias("v"))

    nothing = F.lit(None)
    cells = [cell(c, F.nullif(F.col(c), F.lit("")), nothing) for c in ("company", "location")]
    cells.append(cell("salary", nothing.cast("string"), F.when(known, F.col("salary_value"))))
    counted = enriched.select(F.inline(F.array(*cells))).groupBy("kind", "text", "v").agg(F.count(F.lit(1)).alias("c"))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    totals = counted.agg(
        F.coalesce(F.sum(of("company", F.col("c"))), F.lit(0)).alias("total_jobs"),
        F.count(of("company", F.col("text"))).alias("companies"), F.count(of("location", F.col("text"))).alias("locations"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("c"))), F.lit(0)).alias("n"))
    median = median_of_counts(counted.filter("kind = 'salary' AND v IS NOT NULL").select("v", "c"))
    return totals.select(
        "total_jobs", "companies", "locations", median.select("median").scalar().alias("median_salary"),
        F.bround(F.lit(100.0) * F.col("n") / F.greatest(F.lit(1), F.col("total_jobs")), 1).alias("pct_with_salary"),
    )


def sketch_rows(items: DataFrame, depth: int, width: int) -> DataFrame:
    """Every row once per sketch row, with its bucket there.

    One digest serves four sketch rows, eight hex digits each.
    """
    blocks = -(-depth // 4)
    hashed = items.withColumn("_digest", F.concat(*[F.md5(F.concat(F.lit(f"{n}:"), "item")) for n in range(blocks)]))
    row = F.explode(F.sequence(F.lit(0), F.lit(depth - 1)))
    part = F.substring(F.col("_digest"), F.col("depth_row") * 8 + 1, F.lit(8))
    bucket = (F.conv(part, 16, 10).cast("bigint") % width).cast("int")
    return hashed.withColumn("depth_row", row).withColumn("bucket", bucket).drop("_digest")


def count_items(items: DataFrame, item: str) -> DataFrame:
    """(item, c): how often each different item occurs."""
    return items.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("c"))


def sketch_of_counts(counted: DataFrame, width: int, depth: int) -> DataFrame:
    """Sketch cells (depth_row, bucket, cnt) of (item, c): an item is hashed once, not every time it occurs."""
    return sketch_rows(counted, depth, width).groupBy("depth_row", "bucket").agg(F.sum("c").alias("cnt"))


def count_min_sketch(items: DataFrame, item: str, width: int = 256, depth: int = 4) -> DataFrame:
    """Sketch cells (depth_row, bucket, cnt). Each task ships its different items, then at most width x depth partial counts."""
    return sketch_of_counts(count_items(items, item), width, depth)


def sketch_estimates(items: DataFrame, item: str, top: int = 10, width: int = 256, depth: int = 4) -> DataFrame:
    """Exact counts of the most frequent items next to their sketch estimates. Both come from one exchange of counted items."""
    counted = count_items(items, item)
    exact = counted.withColumnRenamed("c", "exact").orderBy(F.desc("exact"), "item").limit(top)
    return (
        sketch_rows(exact, depth, width).join(sketch_of_counts(counted, width, depth), ["depth_row", "bucket"])
        .groupBy("item", "exact").agg(F.min("cnt").alias("cms_estimate"))
        .withColumn("error_pct", F.bround(F.lit(100.0) * (F.col("cms_estimate") - F.col("exact")) / F.col("exact"), 2))
    )


def picker_options(profiles: DataFrame, skill_names: list[str], extra_locations: list[str]) -> DataFrame:
    """(kind, value): distinct roles, skills and locations offered to users."""
    def fixed(kind: str, values: list[str]) -> DataFrame:
        return profiles.sparkSession.createDataFrame([(kind, v) for v in values], "kind string, value string")

    def used(kind: str, column: str) -> DataFrame:
        return profiles.select(F.lit(kind).alias("kind"), F.explode(column).alias("value")).distinct()

    return (
        used("role", "target_roles").union(used("location", "locations"))
        .union(fixed("skill", skill_names)).union(fixed("location", extra_locations)).distinct()
    )
