"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolefit import vocab
from rolefit.functions import features, formats, text
from rolefit.operators import (
    analytics, ann, ats, dedup, documents, evaluate, explain, learning, lexical, normalize, ranking, retrieval, sampling, scoring,
)
from rolefit.plans import landing
from rolefit.plans.inputs import Inputs
from rolefit.schema import CANONICAL
from rolefit.session import shared_dir
from rolefit.sources import live, postings as posting_source, profiles as profile_source, snapshot
from rolefit.streaming import ingest, learner, live_merge, runs, serde

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BLOOM_P = 0.01
LOOSE_P = 0.2  # loose enough for false positives to occur on the given tables
SAMPLE = 300


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def joined(c) -> F.Column:
    """Lists are reported as text."""
    return F.array_join(c, "|")


# --- sources -----------------------------------------------------------------------------------

@query
def scan_postings_json(i: Inputs) -> DataFrame:
    read = posting_source.read_postings(i.spark, landing.land_dump(i))
    return read.select("seq", F.coalesce("name", "position.name").alias("name"), F.length("text").alias("n_chars"), "idInSource", "locale")


def flat(i: Inputs) -> DataFrame:
    return posting_source.flatten_posting(posting_source.read_postings(i.spark, landing.land_dump(i)), keep=("seq",))


@query
def flatten_nested(i: Inputs) -> DataFrame:
    return flat(i).select("seq", "name", "company", "location", "country", F.md5("text").alias("text_md5"), "url", "source",
                          F.col("dateAdded").alias("date_added"), "locale", "id_in_source")


def english(i: Inputs) -> DataFrame:
    return flat(i).filter(posting_source.is_english(F.col("locale"), F.col("country")))


@query
def english_filter(i: Inputs) -> DataFrame:
    return english(i).select("seq", "locale", "country")


@query
def sample_postings(i: Inputs) -> DataFrame:
    return sampling.sample_postings(english(i), SAMPLE, 42, "seq").select("seq", "id_in_source", "name")


@query
def sample_by_offset(i: Inputs) -> DataFrame:
    """Looks, checked against the lines of the dump: which lines a look meets depends on how the dump lies in files."""
    path = landing.land_dump(i)
    looks = posting_source.peek_lines(i.spark, path, SAMPLE).select("draw", F.md5("line").alias("line_md5"))
    lines = i.spark.read.text(path).select(F.md5("value").alias("line_md5")).distinct().withColumn("known", F.lit(True))
    return looks.join(lines, "line_md5", "left").agg(
        (F.count(F.lit(1)) > 0).alias("looked"), F.sum((~F.col("draw").between(0, SAMPLE - 1)).cast("bigint")).alias("outside"),
        F.sum(F.col("known").isNull().cast("bigint")).alias("unknown_lines"), (F.countDistinct("draw") == F.count(F.lit(1))).alias("once_each"))


@query
def scan_snapshot(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark, "snapshot-csv")
    snapshot.write_snapshot_csv(i.enriched.drop("seq"), path)
    return snapshot.read_snapshot_csv(i.spark, path).select(
        "job_id", "title", "salary_min", "salary_max", "salary_value", "years_required", "is_contract", "is_defense",
        "sponsors_visa", joined("skills").alias("skills"))


def live_raw(i: Inputs) -> DataFrame:
    return live.live_rows(live.usable_pages(live.read_pages(i.spark, landing.land_pages(i))))


@query
def scan_live_feed(i: Inputs) -> DataFrame:
    return live_raw(i).select("seq", "title", "company", "location", "country", "salary_min", "salary_max", "url", "source",
                              F.col("dateAdded").alias("date_added"))


@query
def live_employment_fold(i: Inputs) -> DataFrame:
    return live_raw(i).select("seq", F.md5("description").alias("description_md5"), F.length("description").alias("n_chars"))


@query
def union_sources(i: Inputs) -> DataFrame:
    both = live.union_sources(landing.dump_part(i.raw), live_raw(i).withColumnRenamed("title", "name").withColumnRenamed("description", "text"))
    return both.select("seq", "name", "company", "source", "locale")


@query
def load_vectors_aligned(i: Inputs) -> DataFrame:
    aligned = retrieval.align_vectors(i.postings.select("job_id", "title"), i.posting_vectors)
    return aligned.select("job_id", "title", F.size("vec").alias("dim"), F.round(retrieval.dot(F.col("vec"), F.col("vec")), 4).alias("norm2"))


@query
def vectors_stale(i: Inputs) -> DataFrame:
    stored = i.posting_vectors.join(landing.dump_part(i.normalized).select("job_id").distinct(), "job_id", "left_semi")
    return retrieval.vectors_are_stale(i.postings, stored)


@query
def parse_profiles(i: Inputs) -> DataFrame:
    parsed = profile_source.parse_profiles(profile_source.to_payloads(i.profiles))
    return parsed.select(
        "profile_id", "name", joined("skills").alias("skills"), joined("target_roles").alias("roles"), joined("locations").alias("locations"),
        joined("preferred_locations").alias("preferred"), "min_salary", "us_only", "no_contract",
        joined("exclude_industries").alias("exclude_industries"), "max_seniority", "min_seniority", "needs_visa_sponsor", "max_years_required",
        F.round(F.try_element_at("base_weights", F.lit("title")), 4).alias("title_weight"), joined(profile_source.dealbreaker_labels()).alias("dealbreakers"))


@query
def profile_resume_skills(i: Inputs) -> DataFrame:
    return i.profiles.select("profile_id", joined(features.extract_skills("resume_text")).alias("skills"))


# --- sinks -------------------------------------------------------------------------------------

@query
def write_snapshot(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark, "snapshot")
    snapshot.write_snapshot(i.enriched.drop("seq"), path)
    return snapshot.read_snapshot(i.spark, path).select("job_id", "title", "source", "seniority", "company_size", "salary_value")


@query
def write_vectors(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark, "vectors")
    snapshot.write_vectors(i.posting_vectors, path)
    return snapshot.read_vectors(i.spark, path).select("job_id", F.size("vec").alias("dim"))


@query
def vector_append(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark, "vectors")
    stored, fresh = landing.dump_part(i.normalized), landing.live_part(i.normalized)
    snapshot.write_vectors(i.posting_vectors.join(stored.select("job_id"), "job_id", "left_semi"), path)
    new = dedup.only_new(fresh, snapshot.read_vectors(i.spark, path), "seq")
    snapshot.append_vectors(i.posting_vectors.join(new.select("job_id"), "job_id", "left_semi"), path)
    return snapshot.read_vectors(i.spark, path).select("job_id", F.size("vec").alias("dim"))


@query
def export_matches(i: Inputs) -> DataFrame:
    return snapshot.export_matches(i.shown).withColumn("description", F.md5("description"))


@query
def export_csv_json(i: Inputs) -> DataFrame:
    path = shared_dir(i.spark, "export")
    shown = ranking.with_texts(i.told(i.stored_top), i.profiles, i.enriched)
    ranked = shown.select("profile_id", "rank", *snapshot.EXPORT_COLUMNS, "source")
    snapshot.export_csv(ranked, path + "/csv")
    snapshot.export_json(ranked, path + "/json")
    schema = snapshot.export_matches(ranked).schema
    both = [snapshot.read_export(i.spark, f"{path}/{kind}", schema, kind).select(F.lit(kind).alias("format"), "*") for kind in ("csv", "json")]
    return both[0].unionByName(both[1]).withColumn("description", F.md5("description"))


@query
def job_link(i: Inputs) -> DataFrame:
    return i.postings.select("job_id", formats.job_link(*map(F.col, ("source", "url", "title", "company", "location"))).alias("link"))


@query
def salary_label(i: Inputs) -> DataFrame:
    return i.enriched.select("job_id", formats.salary_label(F.col("salary_min"), F.col("salary_max"), F.col("salary_value")).alias("salary"))


# --- normalization -----------------------------------------------------------------------------

@query
def resolve_aliases(i: Inputs) -> DataFrame:
    renamed = i.raw.withColumnsRenamed({"name": "jobTitle", "company": "employer", "location": "area", "salary_min": "salaryMin",
                                        "salary_max": "salaryMax", "text": "content", "url": "applyUrl", "dateadded": "created"})
    return normalize.resolve_aliases(renamed, keep=("seq",)).withColumn("description", F.md5("description"))


@query
def fill_and_strip(i: Inputs) -> DataFrame:
    padded = i.raw.withColumns({
        "name": F.concat(F.lit(" \t"), "name", F.lit(" \n")), "company": F.nullif("company", F.lit("Northwind")),
        "location": F.concat(F.lit(" "), "location")})
    out = normalize.fill_text(normalize.resolve_aliases(padded, keep=("seq",)), "kaggle")
    return out.select("seq", "title", "company", "location", "country", "url", "source", "posted_date")


@query
def strip_html(i: Inputs) -> DataFrame:
    clean = text.strip_html(F.col("html"))
    return i.texts("pages").select("page_id", F.length(clean).alias("n_chars"), F.md5(clean).alias("text_md5"))


@query
def coerce_salary(i: Inputs) -> DataFrame:
    messy = i.raw.select("seq", F.when(F.col("seq") % 7 == 0, F.lit("n/a")).when(F.col("seq") % 11 == 0, F.lit("NaN"))
                         .otherwise(F.col("salary_min").cast("bigint").cast("string")).alias("salary_min"), "salary_max")
    return normalize.coerce_salary(messy)


@query
def drop_unusable(i: Inputs) -> DataFrame:
    gaps = i.normalized.select("seq", F.when(F.col("seq") % 3 > 0, F.col("title")).otherwise("").alias("title"),
                               F.when(F.col("seq") % 5 > 0, F.col("description")).otherwise("").alias("description"))
    return normalize.drop_unusable(gaps).select("seq", "title", F.length("description").alias("n_chars"))


@query
def content_key(i: Inputs) -> DataFrame:
    return i.normalized.select("seq", "job_id")


@query
def normalize_postings(i: Inputs) -> DataFrame:
    return i.normalized.withColumns({"description": F.md5("description"), "skills": joined("skills")})


@query
def skills_fallback(i: Inputs) -> DataFrame:
    tagged = i.raw.withColumn("tags", F.when(F.col("seq") % 4 == 0, F.lit("Python and Kafka")).when(F.col("seq") % 4 == 1, F.lit("[]")))
    return normalize.normalize(tagged, keep=("seq",)).select("seq", joined("skills").alias("skills"))


# --- dedup -------------------------------------------------------------------------------------

@query
def dedup_exact(i: Inputs) -> DataFrame:
    return i.postings.select("seq", "job_id", "title", "company")


@query
def dedup_title_company(i: Inputs) -> DataFrame:
    keyless = i.normalized.withColumn("job_id", F.lit(""))
    return dedup.first_per_key(keyless, dedup.dedup_key(keyless), "seq").select("seq", "title", "company")


@query
def bloom_params(i: Inputs) -> DataFrame:
    p = dedup.bloom_params(i.normalized.select("job_id"), BLOOM_P)
    return p.select("n", "m", "k", F.round("size_kb", 6).alias("size_kb"))


@query
def bloom_positions(i: Inputs) -> DataFrame:
    docs = i.texts("documents").select("doc_id", "text")
    size = dedup.bloom_params(docs, BLOOM_P).select(F.struct("m", "k").alias("s")).scalar()
    return dedup.bloom_bits(docs, F.col("text"), size["m"], size["k"]).select("doc_id", "i", "pos")


@query
def bloom_dedup(i: Inputs) -> DataFrame:
    docs = i.texts("documents").select("doc_id", "text", "lang")
    return dedup.bloom_dedup(docs, F.col("text"), "doc_id", BLOOM_P).select("doc_id", "lang")


@query
def bloom_false_positives(i: Inputs) -> DataFrame:
    docs = i.texts("documents").select("doc_id", "text", "lang")
    return dedup.bloom_false_positives(docs, F.col("text"), "doc_id", LOOSE_P).select("doc_id", "lang")


@query
def ingest_stats(i: Inputs) -> DataFrame:
    out = dedup.ingest_stats(i.normalized, dedup.dedup_key(i.normalized), "seq", BLOOM_P)
    return out.withColumn("bloom_size_kb", F.round("bloom_size_kb", 6))


@query
def bloom_membership(i: Inputs) -> DataFrame:
    keys = i.normalized.select("job_id", "seq", "source")
    stored = landing.dump_part(keys)
    m, k = (F.lit(x) for x in dedup.bloom_params(stored.select("job_id"), BLOOM_P).select("m", "k").first())
    bitmap = dedup.bloom_bitmap(stored, F.col("job_id"), m, k)
    return dedup.bloom_membership(keys, F.col("job_id"), bitmap, m, k)


@query
def anti_existing(i: Inputs) -> DataFrame:
    fresh = dedup.only_new(landing.live_part(i.normalized), landing.dump_part(i.normalized), "seq")
    return fresh.select("seq", "job_id", "title")


def stored_corpus(i: Inputs) -> DataFrame:
    return features.enrich(dedup.first_per_key(landing.dump_part(i.normalized), "job_id", "seq"))


@query
def upsert_flags(i: Inputs) -> DataFrame:
    arrived = features.enrich(normalize.normalize(live_raw(i), keep=("seq",)))
    return dedup.tighten_flags(stored_corpus(i), arrived, "seq").select("job_id", "is_contract", "sponsors_visa", "flags_refreshed")


@query
def inject_dups(i: Inputs) -> DataFrame:
    mixed = sampling.with_injected_duplicates(i.postings.select("job_id", "title", "company", "seq"), F.col("job_id"), 500)
    mixed = mixed.withColumn("arrival", F.col("copy") * F.lit(2**62) + F.col("seq"))  # numbers stay below 2**62
    out = dedup.ingest_stats(mixed, dedup.dedup_key(mixed), "arrival", 0.01)
    return out.withColumn("bloom_size_kb", F.round("bloom_size_kb", 6))


# --- features ----------------------------------------------------------------------------------

def _feature(name: str, *columns: str) -> None:
    def build(i: Inputs) -> DataFrame:
        return i.enriched.select("job_id", *columns)

    build.__name__ = name
    query(build)


_feature("seniority", "seniority")
_feature("years_required", "years_required")
_feature("is_contract", "is_contract")
_feature("sponsors_visa", "sponsors_visa")
_feature("is_defense", "is_defense")
_feature("company_size", "company", "company_size")
_feature("salary_value", "salary_value")
_feature("enrich", "title", "company", "seniority", "years_required", "is_contract", "sponsors_visa", "is_defense", "company_size", "salary_value")


@query
def extract_skills(i: Inputs) -> DataFrame:
    return i.postings.select("job_id", joined("skills").alias("skills"))


@query
def skill_overlap(i: Inputs) -> DataFrame:
    return i.cells.asking(overlap=True).rows().select("profile_id", "job_id", "n_overlap", "n_job")


@query
def norm_title(i: Inputs) -> DataFrame:
    return i.postings.select("job_id", text.norm_title(F.col("title")).alias("title"))


@query
def title_tokens(i: Inputs) -> DataFrame:
    return i.postings.select("job_id", joined(text.title_tokens(F.col("title"))).alias("tokens"),
                             joined(text.distinctive_tokens(F.col("title"))).alias("distinctive"))


@query
def ats_keywords(i: Inputs) -> DataFrame:
    found = ats.job_keywords(i.postings)
    return found.select("job_id", joined("keywords").alias("keywords"), F.size("keywords").alias("n"))


@query
def candidate_corpus(i: Inputs) -> DataFrame:
    return i.profiles.select("profile_id", ats.candidate_text(i.profiles).alias("corpus"))


@query
def profile_blob(i: Inputs) -> DataFrame:
    return i.profiles.select("profile_id", features.profile_text(F.col("target_roles"), F.col("skills"), F.col("resume_text")).alias("blob"))


def posting_texts(i: Inputs) -> DataFrame:
    return i.postings.select(F.col("job_id").alias("id"), features.lexical_text(F.col("title"), F.col("skills"), F.col("description")).alias("text"))


@query
def job_text(i: Inputs) -> DataFrame:
    return i.postings.select("job_id", F.md5(features.job_text(F.col("title"), F.col("skills"), F.col("description"))).alias("text_md5"))


@query
def tfidf_text(i: Inputs) -> DataFrame:
    return posting_texts(i).select(F.col("id").alias("job_id"), F.md5("text").alias("text_md5"))


@query
def pretty_skills_ordered(i: Inputs) -> DataFrame:
    out = documents.ordered_skills(top_matches(i))
    return out.withColumn("skills_shown", joined("skills_shown"))


def top_matches(i: Inputs) -> DataFrame:
    return i.told(i.top)


@query
def tailored_text(i: Inputs) -> DataFrame:
    coverage = ats.ats_match(i.stored_top, i.postings, i.profiles)
    return documents.tailored_texts(ranking.with_texts(i.told(i.stored_top), i.profiles, None), coverage)


@query
def split_entry(i: Inputs) -> DataFrame:
    entry = F.when(F.col("seq") % 3 > 0, F.concat("title", F.lit(" — "), "company", F.lit(" - "), "location")).otherwise(F.col("title"))
    return i.postings.withColumn("e", documents.split_entry(entry)).select("job_id", "e.title", "e.bullet")


@query
def section_order(i: Inputs) -> DataFrame:
    return documents.section_order(i.profiles).withColumn("sections", joined("sections"))


# --- vectors and retrieval ---------------------------------------------------------------------

@query
def embed_texts(i: Inputs) -> DataFrame:
    texts = i.postings.select(F.col("job_id").alias("id"), features.job_text(F.col("title"), F.col("skills"), F.col("description")).alias("text"))
    return lexical.hashed_weights(texts).select(F.col("id").alias("job_id"), "bucket", F.round("weight", 6).alias("weight"))


@query
def encode_texts(i: Inputs) -> DataFrame:
    """The same vectors through the encoder interface, by which any model takes its place."""
    texts = i.postings.select(F.col("job_id").alias("id"), features.job_text(F.col("title"), F.col("skills"), F.col("description")).alias("text"))
    dense = lexical.embed_texts(texts, lexical.HashingEncoder, kind="double")
    return dense.select(F.col("id").alias("job_id"), F.posexplode("vec").alias("bucket", "raw")).filter("raw <> 0").select("job_id", "bucket", F.round("raw", 6).alias("weight"))


@query
def text_candidates(i: Inputs) -> DataFrame:
    """Nearest postings by the texts themselves: posting and profile texts, hashed vectors, cosine."""
    posts = i.postings.select(F.col("job_id").alias("id"), features.job_text(F.col("title"), F.col("skills"), F.col("description")).alias("text"))
    people = i.profiles.select(F.col("profile_id").alias("id"), features.profile_text(F.col("target_roles"), F.col("skills"), F.col("resume_text")).alias("text"))
    found = ranking.candidates(
        lexical.hashed_vectors(people).withColumnRenamed("id", "profile_id"), lexical.hashed_vectors(posts).withColumnRenamed("id", "job_id"),
        ranking.SHOWN, i.spread)
    return found.select("profile_id", "job_id", "similarity", "candidate_rank")


@query
def cosine_knn(i: Inputs) -> DataFrame:
    vectors = i.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return retrieval.topk(vectors, vectors, 10, spread=i.spread)


def _embedded(i: Inputs) -> DataFrame:
    return i.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


@query
def ann_knn(i: Inputs) -> DataFrame:
    """What cosine_knn asks, from probed lists alone."""
    vectors = _embedded(i)
    return ann.ann_topk(vectors, vectors, 10)


@query
def ann_recall(i: Inputs) -> DataFrame:
    """One row: the share of the exact neighbours that ann_knn finds, the rows it scores and those of exact retrieval."""
    vectors = _embedded(i)
    fitted = ann.fit_lists(vectors, 10)
    found = ann.ann_topk(vectors, vectors, 10, fitted)
    work = ann.rows_scored(vectors, vectors, 10, fitted).select(F.struct("scored", "exact").alias("s")).scalar()
    share = ann.recall(found, retrieval.topk(vectors, vectors, 10, spread=i.spread))
    return share.select("recall", work["scored"].alias("scored"), work["exact"].alias("exact"), F.lit(fitted.probes).alias("probes"))


@query
def candidates(i: Inputs) -> DataFrame:
    return i.candidates


@query
def tfidf_weights(i: Inputs) -> DataFrame:
    texts, stops = posting_texts(i), lexical.stop_words()
    counts = lexical.term_counts(texts, stops)
    out = lexical.tfidf_weights(counts, lexical.vocabulary(texts, counts))
    return out.select(F.col("id").alias("job_id"), "term", F.round("weight", 6).alias("weight"))


def lexical_matches(i: Inputs, k: int) -> DataFrame:
    queries = i.profiles.select(F.col("profile_id").alias("id"),
                                features.profile_text(F.col("target_roles"), F.col("skills"), F.col("resume_text")).alias("text"))
    return lexical.tfidf_topk(queries, posting_texts(i), k, spread=i.spread).select(
        F.col("query_id").alias("profile_id"), F.col("doc_id").alias("job_id"), "similarity", "rank")


@query
def tfidf_topk(i: Inputs) -> DataFrame:
    return lexical_matches(i, 10)


@query
def tfidf_benchmark_topk(i: Inputs) -> DataFrame:
    """Passages of the benchmark table looked up in the whole texts of all documents."""
    docs = i.texts("documents").select(F.col("doc_id").alias("id"), "text")
    queries = i.table("benchmark").select(F.col("item_id").alias("id"), "text")
    return lexical.tfidf_topk(queries, docs, 5, spread=i.spread)


# --- filters -----------------------------------------------------------------------------------

def _filter(name: str) -> None:
    """For how many and which profiles (sum of their ids) a rule keeps or drops each posting."""
    def build(i: Inputs) -> DataFrame:
        ruled = i.cells.asking(rules=(name,)).rows().select("profile_id", "job_id", F.col(name).alias("stays"))
        return ruled.groupBy("job_id", "stays").agg(F.count(F.lit(1)).alias("n"), F.sum("profile_id").alias("profile_sum"))

    build.__name__ = name
    query(build)


for _name in scoring.HARD_FILTERS:
    _filter(_name)


@query
def hard_filters(i: Inputs) -> DataFrame:
    return ranking.survivors(i.cells).rows().select("profile_id", "job_id")


def exclusions(i: Inputs) -> DataFrame:
    keyed = i.feedback.join(i.postings.select("job_id", F.col("seq").alias("posting_seq")), "posting_seq")
    return learning.feedback_exclusions(keyed)


@query
def f_excluded(i: Inputs) -> DataFrame:
    return ranking.survivors(i.cells, exclusions(i)).rows().select("profile_id", "job_id")


# --- scoring -----------------------------------------------------------------------------------

def _signal(signal: str) -> None:
    """For how many and which profiles (sum of their ids) a posting gets each value of a signal."""
    def build(i: Inputs) -> DataFrame:
        valued = i.cells.asking(signals=(signal,)).rows().select("profile_id", "job_id", F.round(f"sig_{signal}", 9).alias(signal))
        return valued.groupBy("job_id", signal).agg(F.count(F.lit(1)).alias("n"), F.sum("profile_id").alias("profile_sum"))

    build.__name__ = f"sig_{signal}"
    query(build)


@query
def sig_similarity(i: Inputs) -> DataFrame:
    """Similarities of each posting summed over its pairs, in units of the last digit kept."""
    units = F.round(F.col("sig_similarity") * 1e9).cast("bigint")
    valued = i.cells.asking(signals=("similarity",)).rows()
    return valued.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.sum(units).alias("similarity_sum"))


for _name in vocab.SIGNALS[1:]:
    _signal(_name)


@query
def score(i: Inputs) -> DataFrame:
    return i.scored.rows().select("profile_id", "job_id", "score")


@query
def rank_topk(i: Inputs) -> DataFrame:
    ranked = ranking.with_attributes(i.best, None, i.enriched)
    return ranked.select("profile_id", "rank", "job_id", "title", "company", "similarity", "score")


@query
def rank_counts(i: Inputs) -> DataFrame:
    return ranking.rank_counts(i.cells)


@query
def weights_resolve(i: Inputs) -> DataFrame:
    explicit = F.when(F.col("profile_id") % 3 == 0, F.create_map(F.lit("skills"), F.lit(0.7), F.lit("title"), F.lit(0.3)))
    chosen = i.profiles.select("profile_id", scoring.resolve_weights(explicit, F.col("base_weights")).alias("w"))
    return chosen.select("profile_id", *[F.col(f"w.{s}").alias(s) for s in vocab.SIGNALS])


@query
def explain_matches(i: Inputs) -> DataFrame:
    out = explain.explain(top_matches(i))
    return out.select(
        "profile_id", "job_id", "rank", joined("reasons").alias("reasons"), joined("matched_skills").alias("matched"),
        joined("missing_skills").alias("missing"), *[F.col(f"contributions.{s}").alias(f"c_{s}") for s in ("similarity", "title")])


@query
def match_card(i: Inputs) -> DataFrame:
    return explain.match_cards(i.shown).withColumns({"matched": joined("matched"), "missing": joined("missing")})


# --- evaluation --------------------------------------------------------------------------------

@query
def precision_at_k(i: Inputs) -> DataFrame:
    return evaluate.precision_at_k(top_matches(i))


@query
def ndcg_at_k(i: Inputs) -> DataFrame:
    return evaluate.ndcg_at_k(top_matches(i))


def _with_skills(i: Inputs, found: DataFrame) -> DataFrame:
    return (
        found.join(i.postings.select("job_id", "skills"), "job_id")
        .join(i.profiles.select("profile_id", F.col("skills").alias("p_skills")), "profile_id")
    )


@query
def retrieval_metrics(i: Inputs) -> DataFrame:
    top = ranking.candidates(i.profile_vectors, i.posting_vectors, 10, i.spread).withColumnRenamed("candidate_rank", "rank")
    return evaluate.retrieval_metrics(_with_skills(i, top))


@query
def retrieval_ab(i: Inputs) -> DataFrame:
    dense = ranking.candidates(i.profile_vectors, i.posting_vectors, 10, i.spread).withColumnRenamed("candidate_rank", "rank")
    return evaluate.retrieval_ab(_with_skills(i, dense), _with_skills(i, lexical_matches(i, 10)))


@query
def profile_pass_criteria(i: Inputs) -> DataFrame:
    return evaluate.pass_criteria(top_matches(i))


@query
def ats_match(i: Inputs) -> DataFrame:
    out = ats.ats_match(i.stored_top, i.postings, i.profiles)
    return out.withColumns({"covered": joined("covered"), "missing": joined("missing")})


@query
def acceptance_curve(i: Inputs) -> DataFrame:
    return evaluate.acceptance_curve(i.feedback, span=1000)


# --- analytics ---------------------------------------------------------------------------------

@query
def top_skills(i: Inputs) -> DataFrame:
    return analytics.top_skills(i.postings, 15)


@query
def salary_distribution(i: Inputs) -> DataFrame:
    return analytics.salary_distribution(i.enriched)


@query
def salary_histogram(i: Inputs) -> DataFrame:
    return analytics.salary_histogram(i.enriched)


@query
def demand_by_location(i: Inputs) -> DataFrame:
    return analytics.demand_by_location(i.postings, 12)


@query
def demand_by_source(i: Inputs) -> DataFrame:
    return analytics.demand_by_source(i.postings)


@query
def summary_stats(i: Inputs) -> DataFrame:
    return analytics.summary_stats(i.enriched)


def words(i: Inputs) -> DataFrame:
    return i.texts("documents").select(F.explode(text.word_tokens(F.col("text"))).alias("word"))


@query
def count_min_sketch(i: Inputs) -> DataFrame:
    return analytics.count_min_sketch(words(i), "word")


@query
def count_min_estimates(i: Inputs) -> DataFrame:
    return analytics.sketch_estimates(words(i), "word", 20)


@query
def count_min_skills(i: Inputs) -> DataFrame:
    return analytics.sketch_estimates(i.postings.select(F.explode("skills").alias("skill")), "skill", 10)


@query
def distinct_sources_options(i: Inputs) -> DataFrame:
    return analytics.picker_options(i.profiles, sorted(vocab.SKILL_PATTERNS), vocab.COMMON_LOCATIONS)


# --- learning ----------------------------------------------------------------------------------

def feedback_events(i: Inputs) -> DataFrame:
    """Feedback with the signals of its (profile, posting) pair."""
    posts = i.enriched.join(i.posting_vectors, "job_id").withColumnRenamed("seq", "posting_seq")
    profs = scoring.prepare_profiles(i.profiles).join(i.profile_vectors.withColumnRenamed("vec", "p_vec"), "profile_id")
    pairs = i.feedback.join(scoring.prepare_postings(posts), "posting_seq").join(profs, "profile_id")
    pairs = pairs.withColumn("similarity", F.round(retrieval.cosine(F.col("p_vec"), F.col("vec")), 9))
    scored = pairs.withColumn("breakdown", scoring.signals())
    return scored.select("profile_id", "seq", "job_id", "action", learning.reward(F.col("action")).alias("reward"),
                         F.array(*[F.col(f"breakdown.{s}") for s in vocab.SIGNALS]).alias("x"))


def _weight_columns(name: str = "weights") -> list[F.Column]:
    return [F.round(F.col(name)[n], 6).alias(s) for n, s in enumerate(vocab.SIGNALS)]


@query
def reward_map(i: Inputs) -> DataFrame:
    return i.feedback.select("profile_id", "seq", learning.reward(F.col("action")).alias("reward"))


def learned(i: Inputs) -> DataFrame:
    return learning.learner_fold(feedback_events(i), learning.fresh_state(i.profiles))


@query
def learner_fold(i: Inputs) -> DataFrame:
    return learned(i).select("profile_id", "n_seen", *_weight_columns())


@query
def learner_history(i: Inputs) -> DataFrame:
    steps = learning.learner_fold(feedback_events(i), learning.fresh_state(i.profiles), every_step=True)
    return steps.select("profile_id", "seq", "n_seen", *_weight_columns())


def early(i: Inputs):
    """Boundary between the first and the second half of the log."""
    return i.feedback.agg(F.floor(F.max("seq") / 2).alias("half")).select("half").scalar()


@query
def learner_resume(i: Inputs) -> DataFrame:
    events = feedback_events(i)
    saved = learning.learner_fold(events.filter(F.col("seq") <= early(i)), learning.fresh_state(i.profiles))
    state = learning.resumed_state(i.profiles, saved.withColumn("weights", learning.weights_map(F.col("weights"))))
    return learning.learner_fold(events.filter(F.col("seq") > early(i)), state).select("profile_id", "n_seen", *_weight_columns())


@query
def feedback_exclusions(i: Inputs) -> DataFrame:
    return exclusions(i)


@query
def rerank_after_feedback(i: Inputs) -> DataFrame:
    new = learned(i).select("profile_id", learning.weights_map(F.col("weights")).alias("learned"))
    profiles = i.profiles.join(new, "profile_id", "left")
    cells = replace(i.cells, profiles=profiles, weights=F.col("learned"))
    ranked = ranking.rank_topk(ranking.score(ranking.survivors(cells, exclusions(i))), ranking.SHOWN)
    return ranked.select("profile_id", "rank", "job_id", F.round("score", 6).alias("score"))


@query
def epsilon_greedy(i: Inputs) -> DataFrame:
    pool = ranking.rank_topk(i.scored, ranking.N_CANDIDATES)  # all that a profile may be shown, not the served list alone
    return learning.epsilon_greedy(pool.select("profile_id", "rank", "job_id"), 10)


@query
def candidate_pool(i: Inputs) -> DataFrame:
    drawn = sampling.bottom_k(i.postings.select("job_id"), F.col("job_id"), 300, 0)
    return ranking.pool(i.profile_vectors, i.posting_vectors, drawn, 300, i.spread)


# --- streaming ---------------------------------------------------------------------------------

def canonical(i: Inputs) -> DataFrame:
    return i.normalized


@query
def stream_ingest(i: Inputs) -> DataFrame:
    base = shared_dir(i.spark, "stream")
    files = landing.file_count(i, "documents", 4)
    landing.land_rows(canonical(i), base + "/in", files)
    stream = runs.read_landed(i.spark, base + "/in", canonical(i).schema, max_files=files // 2)
    sink = ingest.Corrections(i.spark, base + "/out", "job_id", "seq")
    runs.run_batches(ingest.first_arrivals(stream, "job_id", "seq"), sink, base + "/checkpoint", "update")
    return sink.kept().select("job_id", "seq", "title", "company", "url")


@query
def stream_bloom(i: Inputs) -> DataFrame:
    base, repost = shared_dir(i.spark, "bloom"), landing.is_repost()
    rows = canonical(i).select("seq", "job_id", "title")
    for part in (rows.filter(~repost), rows.filter(repost)):  # two arrivals, hence two batches
        landing.land_rows(part, base + "/in", 2, "append")
    sink = ingest.BloomSink(i.spark, base + "/out", F.col("job_id"), "seq", expected=i.normalized.count(), p=BLOOM_P)
    runs.run_batches(runs.read_landed(i.spark, base + "/in", rows.schema, max_files=2), sink, base + "/checkpoint")
    return sink.kept().select("job_id", "seq")


@query
def stream_ack(i: Inputs) -> DataFrame:
    """Two runs of one query: the second reads only what landed after the first."""
    base = shared_dir(i.spark, "ack")
    rows = canonical(i).select("seq", "job_id")
    for part in (landing.dump_part(i.normalized), landing.live_part(i.normalized)):
        landing.land_rows(part.select("seq", "job_id"), base + "/in", 2, "append")
        stream = runs.read_landed(i.spark, base + "/in", rows.schema)
        runs.run_to_table(stream, base + "/out", base + "/checkpoint")
    return i.spark.read.parquet(base + "/out")


@query
def stream_progress(i: Inputs) -> DataFrame:
    base = shared_dir(i.spark, "progress")
    rows = canonical(i).select("seq", "job_id")
    landing.land_rows(rows, base + "/in", 4)
    sink = runs.CountedTable(i.spark, base + "/out")
    runs.run_batches(runs.read_landed(i.spark, base + "/in", rows.schema, max_files=2), sink, base + "/checkpoint")
    return sink.counts().agg(F.sum("rows").alias("total_seen"))


@query
def stream_live_merge(i: Inputs) -> DataFrame:
    base = shared_dir(i.spark, "live")
    stored = stored_corpus(i).drop("seq")
    stored.write.parquet(base + "/corpus")
    merge = live_merge.LiveMerge(i.spark, i.spark.read.parquet(base + "/corpus"), base + "/merged")
    pages = live.usable_pages(live.read_pages(i.spark, landing.land_pages(i)))
    pages.write.json(base + "/pages")
    runs.run_batches(live.stream_pages(i.spark, base + "/pages"), merge, base + "/checkpoint")
    return merge.current().select("job_id", "title", "source", "is_contract", "sponsors_visa")


@query
def row_serde(i: Inputs) -> DataFrame:
    back = serde.from_messages(serde.to_messages(i.postings), T.StructType(CANONICAL.fields + [T.StructField("seq", T.LongType())]))
    return back.select("job_id", "title", "company", "salary_min", "salary_max", F.md5("description").alias("description_md5"),
                       joined("skills").alias("skills"), "seq")


@query
def learner_stream(i: Inputs) -> DataFrame:
    base, files = shared_dir(i.spark, "learner"), landing.file_count(i, "events", 2)
    feedback_events(i).select("profile_id", "seq", "x", "reward").write.parquet(base + "/events")
    events = i.spark.read.parquet(base + "/events")  # formed once, though each part is read twice to be put in order
    sink = learner.StateTable(i.spark, base + "/states")
    for part in (events.filter(F.col("seq") <= early(i)), events.filter(F.col("seq") > early(i))):  # two arrivals, hence two batches
        landing.land_rows(part, base + "/in", files, "append")
        stream = runs.read_landed(i.spark, base + "/in", events.schema, max_files=files)
        runs.run_batches(learner.learner_states(stream, learning.fresh_state(i.profiles)), sink, base + "/checkpoint", "update")
    return sink.states().select("profile_id", "n_seen", *_weight_columns())
