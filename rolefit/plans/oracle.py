"""SQL twins of the catalog's queries, run by DuckDB on the same tables."""

from __future__ import annotations

import math
import os
import zipfile

from rolefit import vocab
from rolefit.plans import fixtures, landing
from rolefit.plans.catalog import BLOOM_P, LOOSE_P, SAMPLE
from rolefit.plans.oracle_base import (
    BLOCKS, WS, assemble, csv, distinctive, fold, lit, norm_title, rx, score_sum, skill_hit, skills_of, sql_list, strip, strip_html,
    title_tokens,
)
from rolefit.sources import live

ORACLE: dict[str, str] = {}


def q(name: str, final: str, *blocks: str, extra: dict | None = None, recursive: bool = False) -> None:
    ORACLE[name] = assemble(final, *blocks, blocks=dict(EXTRA, **(extra or {})), recursive=recursive)


def bar(x: str) -> str:
    return f"array_to_string({x}, '|')"


def seeded(key: str, seed: int) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def hex_mod(hex_digits: str, length: int, m: str) -> str:
    out = "0::BIGINT"
    for start in range(0, length, 6):
        width = min(6, length - start)
        out = f"(({out} * {16 ** width} + CAST('0x' || substr({hex_digits}, {start + 1}, {width}) AS BIGINT)) % {m})"
    return out


def bloom_blocks(name: str, source: str, key: str, order: str, p: float) -> dict:
    """Blocks {name}_size, {name}_first, {name}_bits and {name}_verdict over a source block or table."""
    deps = [source] if source in BLOCKS or source in EXTRA else []
    k2 = math.log(2) ** 2
    return {
        f"{name}_size": (deps, f"""
            SELECT cnt, n, m, greatest(1, CAST(floor(m / n::DOUBLE * {math.log(2)!r}) AS BIGINT)) AS k FROM (
             SELECT cnt, n, greatest(8, CAST(floor(-n::DOUBLE * {math.log(p)!r} / {k2!r}) AS BIGINT)) AS m
             FROM (SELECT count(*) AS cnt, greatest(count(*), 1000) AS n FROM {source}))"""),
        f"{name}_first": (deps, f"SELECT {key} AS key, min({order}) AS first_seq FROM {source} GROUP BY 1"),
        f"{name}_bits": ([f"{name}_size", f"{name}_first"], f"""
            SELECT key, first_seq, i, (h1 + i * h2) % m AS pos FROM (
             SELECT key, first_seq, m, {hex_mod('md5(key)', 32, 'm')} AS h1, {hex_mod('sha1(key)', 40, 'm')} AS h2, unnest(range(k)) AS i
             FROM {name}_first, {name}_size)"""),
        f"{name}_verdict": ([f"{name}_bits"], f"""
            SELECT b.key, b.first_seq, bool_and(o.owner_seq < b.first_seq) AS dropped FROM {name}_bits b
             JOIN (SELECT pos, min(first_seq) AS owner_seq FROM {name}_bits GROUP BY pos) o USING (pos) GROUP BY 1, 2"""),
    }


def stats_sql(name: str) -> str:
    return f"""
        SELECT cnt AS total_seen, cnt - ingested AS duplicates, ingested, round(floor((m + 7) / 8) / 1024.0, 6)::DOUBLE AS bloom_size_kb, fps AS bloom_false_positives
        FROM {name}_size, (SELECT coalesce(sum(CASE WHEN dropped THEN 0 ELSE 1 END), 0)::BIGINT AS ingested,
                                  coalesce(sum(CASE WHEN dropped THEN 1 ELSE 0 END), 0)::BIGINT AS fps FROM {name}_verdict)"""


def bottom_k(source: str, key: str, k: int, seed: int) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (ORDER BY {seeded(key, seed)}) <= {k}"


def employment(text: str, kind: str, time: str) -> str:
    notes = (f"concat_ws(' ', CASE {kind} WHEN 'contract' THEN {lit(live.CONTRACT_TEXT)} WHEN 'permanent' THEN {lit(live.PERMANENT_TEXT)} END, "
             f"CASE WHEN {time} = 'part_time' THEN {lit(live.PART_TIME_TEXT)} END)")
    return f"CASE WHEN {notes} <> '' THEN {strip(f"{text} || ' ' || {notes}")} ELSE {text} END"


def enrich_sql(source: str) -> str:
    """The columns the live checks need, derived from title and description of a source."""
    return f"""
        SELECT *, {rx('fblob', vocab.CONTRACT_PATTERN)} AS is_contract,
         CASE WHEN {rx('fblob', vocab.NO_SPONSOR_PATTERN)} THEN FALSE WHEN {rx('fblob', vocab.SPONSOR_PATTERN)} THEN TRUE END AS sponsors_visa
        FROM {source}"""


def key_sql(title: str, company: str, location: str, description: str) -> str:
    collapsed = f"regexp_replace(lower({description}), {lit(WS + '+')}, ' ', 'g')"
    return f"substr(md5(lower({title}) || '|' || lower({company}) || '|' || lower({location}) || '|' || substr({collapsed}, 1, 120)), 1, 16)"


IS_LIVE = "(source = 'adzuna' OR seq % 2 = 1)"
LEXICAL = "concat_ws(' ', title, array_to_string(skills, ' '), substr(description, 1, 400))"
BLOB = (strip("array_to_string(target_roles, ' ') || '. ' || array_to_string(list_concat(skills, skills), ' ') || '. ' || resume_text"))
WORDS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def stop_words() -> list[str]:
    """The English stop words that come with Spark, read from its jar so that no session is needed."""
    import pyspark

    jars = os.path.join(os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__), "jars")
    jar = next(name for name in os.listdir(jars) if name.startswith("spark-mllib_"))
    with zipfile.ZipFile(os.path.join(jars, jar)) as archive:
        body = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8")
    return sorted(w.strip() for w in body.splitlines() if w.strip())


def tfidf_blocks(docs_deps: list[str], docs: str, query_deps: list[str], queries: str) -> dict:
    """Blocks for TF-IDF over docs(id, text) and queries(id, text)."""
    def terms(source: str) -> str:
        kept = f"list_filter({WORDS.format(x='text')}, lambda w: w NOT IN {sql_list(stop_words())})"
        return f"""
            SELECT id, term, count(*) AS tf FROM (
             SELECT id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda j: ws[j] || ' ' || ws[j + 1]))) AS term
             FROM (SELECT id, {kept} AS ws FROM {source})) GROUP BY 1, 2"""

    def weights(source: str) -> str:
        return f"""
            SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight
            FROM (SELECT id, term, tf * idf AS raw FROM {source} JOIN tf_vocab USING (term))"""

    return {
        "tf_docs": (docs_deps, docs), "tf_queries": (query_deps, queries),
        "tf_doc_terms": (["tf_docs"], terms("tf_docs")), "tf_query_terms": (["tf_queries"], terms("tf_queries")),
        "tf_vocab": (["tf_doc_terms", "tf_docs"], """
            SELECT term, ln(((SELECT count(*) FROM tf_docs) + 1)::DOUBLE / (df + 1)) + 1 AS idf
            FROM (SELECT term, sum(tf) AS total, count(*) AS df FROM tf_doc_terms GROUP BY 1 ORDER BY total DESC, term LIMIT 20000)"""),
        "tf_doc_weights": (["tf_doc_terms", "tf_vocab"], weights("tf_doc_terms")),
        "tf_query_weights": (["tf_query_terms", "tf_vocab"], weights("tf_query_terms")),
        "tf_hits": (["tf_doc_weights", "tf_query_weights"], """
            SELECT q.id AS query_id, d.id AS doc_id, sum(q.weight * d.weight) AS s FROM tf_query_weights q JOIN tf_doc_weights d USING (term) GROUP BY 1, 2"""),
        "tf_ranked": (["tf_hits", "tf_docs", "tf_queries"], """
            SELECT query_id, doc_id, similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) AS INTEGER) AS rank FROM (
             SELECT q.id AS query_id, d.id AS doc_id, round(coalesce(h.s, 0), 9) AS similarity
             FROM tf_queries q CROSS JOIN tf_docs d LEFT JOIN tf_hits h ON h.query_id = q.id AND h.doc_id = d.id)"""),
    }


MATCHED = "list_sort(list_intersect(skills, p_skills))"
MISSING = "list_sort(list_filter(p_skills, lambda s: NOT list_contains(skills, s)))"
LINK_TERMS = strip("title || ' ' || company || ' ' || location")
# url_encode() leaves letters, digits and -_.~ alone; a space becomes %20 there and + in forms.
LINK = (f"CASE WHEN starts_with(source, 'adzuna') AND starts_with(url, 'http') THEN url ELSE 'https://www.google.com/search?q=' || "
        f"replace(url_encode({strip(LINK_TERMS + " || ' job'")}), '%20', '+') END")
SALARY = ("CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL AND salary_min <> salary_max "
          "THEN '$' || format('{:,}', round_even(salary_min / 1000, 0)::BIGINT) || 'k–$' || format('{:,}', round_even(salary_max / 1000, 0)::BIGINT) || 'k' "
          "WHEN salary_value IS NOT NULL THEN '$' || format('{:,}', round_even(salary_value, 0)::BIGINT) ELSE 'salary N/A' END")


def pretty(x: str) -> str:
    pieces = f"regexp_extract_all(lower({x}), '[\\p{{L}}]+|[^\\p{{L}}]+')"
    titled = f"array_to_string(list_transform({pieces}, lambda p: upper(p[1]) || p[2:]), '')"
    return f"CASE WHEN length({x}) > 3 THEN {titled} ELSE upper({x}) END"


def ats_list(folded: str, keywords: list[str]) -> str:
    parts = ", ".join(f"CASE WHEN {rx(folded, chr(92) + 'b' + _escape(k) + chr(92) + 'b')} THEN {lit(k)} END" for k in keywords)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


def _escape(word: str) -> str:
    return "".join("\\" + c if c in "+&/.-()[]*?^$|\\" else c for c in word)


def ats_reduce(hits: str) -> str:
    empty = "[]::VARCHAR[]"
    kept = (f"list_reduce(list_transform({hits}, lambda z: [z]), lambda acc, k: CASE WHEN len(list_filter(acc, lambda f: f <> k[1] AND contains(f, k[1]))) > 0 "
            f"THEN acc ELSE list_concat(acc, k) END, {empty})")
    unique = (f"list_reduce(list_transform({kept}, lambda z: [z]), lambda acc, k: CASE WHEN len(list_filter(acc, lambda f: "
              f"replace(f, 'modelling', 'modeling') = replace(k[1], 'modelling', 'modeling'))) > 0 THEN acc ELSE list_concat(acc, k) END, {empty})")
    return f"list_slice({unique}, 1, 25)"


EXTRA: dict[str, tuple[list[str], str]] = {
    "nested": (["raw"], """
        SELECT seq, name, CASE WHEN (seq // 2) % 5 = 4 THEN 'Unknown' ELSE company END AS company, location,
         CASE WHEN (seq // 2) % 4 <> 0 THEN upper(country) ELSE country END AS country, text, url, 'kaggle:' || source AS source,
         '2021-09-01' AS date_added, locale, CAST(seq // 2 AS VARCHAR) AS id_in_source FROM raw"""),
    "flat": (["nested"], f"SELECT * EXCLUDE (text), {strip('text')} AS text FROM nested WHERE {strip('name')} <> '' AND length({strip('text')}) >= 40"),
    "english": (["flat"], f"""
        SELECT * FROM flat WHERE starts_with(lower(locale), 'en') OR (locale = '' AND lower(country) IN {sql_list(vocab.ENGLISH_COUNTRIES)})"""),
    "page_rows": (["raw"], f"""
        SELECT *, 'q' || ((seq // 2) % 3) AS query, CAST(floor((seq // 2) / {3 * landing.PAGE_SIZE}) AS INTEGER) + 1 AS page,
         CASE (seq // 2) % 4 WHEN 0 THEN 'permanent' WHEN 1 THEN 'contract' END AS kind, CASE (seq // 2) % 3 WHEN 0 THEN 'part_time' WHEN 1 THEN 'full_time' END AS time
        FROM raw WHERE {IS_LIVE}"""),
    "live_rows": (["page_rows"], f"""
        SELECT seq, name AS title, company, location, 'US' AS country, salary_min, salary_max, {employment('text', 'kind', 'time')} AS description,
         url, 'adzuna' AS source, dateadded AS date_added FROM page_rows WHERE query <> 'q1' OR page < 2"""),
    "live_norm": (["live_rows"], f"""
        SELECT seq, title, company, location, {strip_html('description')} AS description, source FROM live_rows"""),
    "live_keyed": (["live_norm"], f"SELECT *, {key_sql('title', 'company', 'location', 'description')} AS job_id, {fold("title || '. ' || description")} AS fblob FROM live_norm"),
    "live_enriched": (["live_keyed"], enrich_sql("live_keyed")),
    "live_first": (["live_enriched"], "SELECT * FROM live_enriched QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY seq) = 1"),
    "dump_norm": (["normalized"], f"SELECT * FROM normalized WHERE NOT {IS_LIVE}"),
    "stored": (["dump_norm"], f"SELECT * FROM ({enrich_sql('dump_norm')}) QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY seq) = 1"),
    "tightened": (["stored", "live_first"], """
        SELECT s.* EXCLUDE (is_contract, sponsors_visa),
         CAST((coalesce(l.is_contract, FALSE) AND NOT s.is_contract) AS INTEGER)
          + CAST((coalesce(NOT l.sponsors_visa, FALSE) AND coalesce(s.sponsors_visa, TRUE)) AS INTEGER) AS flags_refreshed,
         s.is_contract OR coalesce(l.is_contract, FALSE) AS is_contract,
         CASE WHEN l.sponsors_visa = FALSE THEN FALSE ELSE s.sponsors_visa END AS sponsors_visa
        FROM stored s LEFT JOIN live_first l USING (job_id)"""),
    "excluded": (["feedback", "postings"], """
        SELECT DISTINCT f.profile_id, p.job_id FROM feedback f JOIN postings p ON p.seq = f.posting_seq WHERE f.action IN ('reject', 'skip')"""),
    "top10": (["ranked"], "SELECT * FROM ranked WHERE rank <= 10"),
    "ats_top": (["top10", "postings"], f"""
        SELECT job_id, {ats_reduce('hits')} AS keywords FROM (
         SELECT job_id, {ats_list('fblob', vocab.ATS_VOCABULARY)} AS hits FROM postings WHERE job_id IN (SELECT DISTINCT job_id FROM top10))"""),
    "covered": (["top10", "ats_top", "ats_prof"], """
        SELECT profile_id, job_id, rank, keywords, list_filter(keywords, lambda k: list_contains(known, k)) AS covered,
         list_filter(keywords, lambda k: NOT list_contains(known, k)) AS missing FROM top10 JOIN ats_top USING (job_id) JOIN ats_prof USING (profile_id)"""),
    "ats_hits": (["postings"], f"SELECT job_id, {ats_list('fblob', vocab.ATS_VOCABULARY)} AS hits FROM postings"),
    "ats_job": (["ats_hits"], f"SELECT job_id, {ats_reduce('hits')} AS keywords FROM ats_hits"),
    "corpus": (["profiles"], """
        SELECT profile_id, lower(resume_text || ' ' || array_to_string(skills, ' ') || ' ' || array_to_string(target_roles, ' ') || '  ') AS corpus FROM profiles"""),
    "ats_prof": (["corpus"], f"SELECT profile_id, {ats_list('corpus', vocab.ATS_VOCABULARY)} AS known FROM corpus"),
    "fb_signals": (["feedback", "enriched", "prof", "posting_vectors", "profile_vectors", "loc_hits", "title_hits"], """
        SELECT f.profile_id, f.seq, f.action,
         CASE f.action WHEN 'accept' THEN 1e0 WHEN 'reject' THEN -1e0 WHEN 'skip' THEN -0.2e0 ELSE 0e0 END AS reward,
         round(list_cosine_similarity(pv.vec, jv.vec), 9) AS similarity,
         len(list_intersect(e.skills, p_skills)) / greatest(1, len(p_skills))::DOUBLE AS s_skills, s_title,
         CASE WHEN min_salary = 0 OR salary_value IS NULL THEN 0.5e0 WHEN salary_value >= min_salary THEN 1e0 ELSE 0e0 END AS s_salary,
         CASE WHEN cap IS NOT NULL THEN CASE WHEN lvl <= cap THEN 1e0 ELSE 0e0 END
              WHEN flr IS NOT NULL THEN CASE WHEN lvl >= flr THEN 1e0 ELSE 0e0 END ELSE 0.5e0 END AS s_seniority,
         s_location,
         CASE WHEN max_years_required IS NULL THEN 0.5e0 WHEN years_required > max_years_required THEN 0e0
              ELSE 1e0 - 0.5e0 * (years_required / greatest(1, max_years_required)::DOUBLE) END AS s_experience,
         CASE company_size WHEN 'large' THEN 1e0 WHEN 'small' THEN 0e0 ELSE 0.5e0 END AS s_size
        FROM feedback f JOIN (SELECT *, CASE seniority WHEN 'junior' THEN 0 WHEN 'senior' THEN 2 WHEN 'staff' THEN 3 ELSE 1 END AS lvl FROM enriched) e ON e.seq = f.posting_seq
         JOIN prof p ON p.profile_id = f.profile_id
         JOIN posting_vectors jv ON jv.job_id = e.job_id JOIN profile_vectors pv ON pv.profile_id = f.profile_id
         JOIN loc_hits l ON l.location = e.location AND l.locations = p.locations AND l.preferred = p.preferred
         JOIN title_hits t ON t.title = e.title AND t.target_roles = p.target_roles"""),
    "fb_events": (["fb_signals"], """
        SELECT profile_id, seq, reward, [similarity, s_skills, s_title, s_salary, s_seniority, s_location, s_experience, s_size] AS x,
         row_number() OVER (PARTITION BY profile_id ORDER BY seq) AS n FROM fb_signals"""),
    "fb_start": (["prof"], "SELECT profile_id, [" + ", ".join(f"weights.{s}" for s in vocab.SIGNALS) + "] AS w FROM prof"),
    "fold": (["fb_events", "fb_start"], """/*r*/
        SELECT s.profile_id, 0::BIGINT AS n, -1::BIGINT AS seq, s.w, list_transform(s.w, lambda z: 0.5e0) AS b FROM fb_start s
        UNION ALL
        SELECT profile_id, n, seq,
         list_transform(moved, lambda z: z / CASE WHEN total = 0 THEN 1e0 ELSE total END) AS w, nb AS b
        FROM (SELECT *, list_reduce(moved, lambda acc, z: acc + z) AS total FROM (
          SELECT e.profile_id, e.n, e.seq,
           list_transform(range(1, 9), lambda j: greatest(0e0, f.w[j] + 0.15e0 * (e.reward * (e.x[j] - f.b[j])))) AS moved,
           list_transform(range(1, 9), lambda j: 0.8e0 * f.b[j] + (1 - 0.8e0) * e.x[j]) AS nb
          FROM fold f JOIN fb_events e ON e.profile_id = f.profile_id AND e.n = f.n + 1))"""),
    "learned": (["fold"], "SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY profile_id ORDER BY n DESC) = 1"),
    "gains": (["top10"], "SELECT profile_id, rank, len(list_intersect(skills, p_skills)) AS gain FROM top10"),
    "doc_words": ([], f"SELECT unnest({WORDS.format(x='text')}) AS word FROM documents"),
}
EXTRA.update(bloom_blocks("doc", "documents", "text", "doc_id", BLOOM_P))
EXTRA.update(bloom_blocks("loose", "documents", "text", "doc_id", LOOSE_P))
EXTRA.update(bloom_blocks("dump", "dump_norm", "job_id", "seq", BLOOM_P))
EXTRA.update(bloom_blocks("post", "normalized", "job_id", "seq", BLOOM_P))
EXTRA["drawn"] = (["postings"], bottom_k("postings", "job_id", 500, 5))
EXTRA["drawn_again"] = (["drawn"], bottom_k("drawn", "job_id", 100, 6))
EXTRA["mixed"] = (["drawn", "drawn_again"], "SELECT job_id, seq AS arrival FROM drawn UNION ALL SELECT job_id, 4611686018427387904 + seq FROM drawn_again")
EXTRA.update(bloom_blocks("mix", "mixed", "job_id", "arrival", 0.01))


def rank_metrics(source: str, bar_: int) -> str:
    """profile_id, precision_at_k, n, ndcg_at_k over (profile_id, rank, gain)."""
    return f"""
        SELECT profile_id, round_even(avg(CASE WHEN gain >= {bar_} THEN 1e0 ELSE 0e0 END), 3) AS precision_at_k, count(*) AS n,
         CASE WHEN sum(gain) > 0 THEN round(sum(gain / (ln(rank + 1) / ln(2e0))) / sum(gain / (ln(ideal + 1) / ln(2e0))), 3) ELSE 0e0 END AS ndcg_at_k
        FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY gain DESC, rank) AS ideal FROM {source}) GROUP BY 1"""


# --- sources and sinks
q("scan_postings_json", "SELECT seq, name, length(text) AS n_chars, CAST(seq // 2 AS VARCHAR) AS \"idInSource\", locale FROM raw", "raw")
q("flatten_nested", "SELECT seq, name, company, location, country, md5(text) AS text_md5, url, source, date_added, locale, id_in_source FROM flat", "flat")
q("english_filter", "SELECT seq, locale, country FROM english", "english")
q("sample_postings", f"""
    SELECT seq, id_in_source, name FROM (SELECT * FROM english QUALIFY row_number() OVER (PARTITION BY id_in_source ORDER BY seq) = 1)
    QUALIFY row_number() OVER (ORDER BY {seeded('id_in_source', 42)}) <= {SAMPLE}""", "english")
q("scan_snapshot", f"""
    SELECT job_id, title, salary_min, salary_max, salary_value, years_required, is_contract, is_defense, sponsors_visa, {bar('skills')} AS skills FROM enriched""", "enriched")
q("scan_live_feed", "SELECT seq, title, company, location, country, salary_min, salary_max, url, source, date_added FROM live_rows", "live_rows")
q("live_employment_fold", "SELECT seq, md5(description) AS description_md5, length(description) AS n_chars FROM live_rows", "live_rows")
q("union_sources", f"""
    SELECT seq, name, company, source, locale FROM raw WHERE NOT {IS_LIVE}
    UNION ALL SELECT seq, title, company, source, NULL FROM live_rows""", "raw", "live_rows")
q("load_vectors_aligned", """
    SELECT job_id, title, CAST(len(vec) AS INTEGER) AS dim, round(list_dot_product(vec, vec), 4) AS norm2
    FROM postings JOIN posting_vectors USING (job_id)""", "postings", "posting_vectors")
q("vectors_stale", f"""
    SELECT count(*) > 0 AS stale, count(*) AS missing FROM postings
    WHERE job_id NOT IN (SELECT job_id FROM posting_vectors WHERE job_id IN (SELECT job_id FROM normalized WHERE NOT {IS_LIVE}))""",
  "postings", "posting_vectors", "normalized")
q("parse_profiles", f"""
    SELECT profile_id, name, {bar('skills')} AS skills, {bar('target_roles')} AS roles, {bar('locations')} AS locations, {bar('preferred')} AS preferred,
     min_salary, us_only, no_contract, CASE WHEN exclude_defense THEN 'defense' ELSE '' END AS exclude_industries, max_seniority, min_seniority,
     needs_visa_sponsor, max_years_required, CASE shape {' '.join(f'WHEN {n} THEN {w["title"]!r}e0' for n, w in fixtures.BASE_WEIGHTS.items())} END AS title_weight,
     concat_ws('|', CASE WHEN us_only THEN 'US only' END, CASE WHEN no_contract THEN 'No contract/temp' END,
      CASE WHEN exclude_defense THEN 'No defence/military' END, CASE WHEN max_seniority = 'mid' THEN 'No Senior/Staff titles' END,
      CASE WHEN min_seniority = 'senior' THEN 'No Junior titles' END, CASE WHEN needs_visa_sponsor THEN 'Needs visa sponsor' END) AS dealbreakers
    FROM profiles""", "profiles")
q("profile_resume_skills", f"SELECT profile_id, {bar(skills_of('resume_text'))} AS skills FROM profiles", "profiles")
q("write_snapshot", "SELECT job_id, title, source, seniority, company_size, salary_value FROM enriched", "enriched")
q("write_vectors", "SELECT job_id, CAST(len(vec) AS INTEGER) AS dim FROM posting_vectors", "posting_vectors")
q("vector_append", "SELECT job_id, CAST(len(vec) AS INTEGER) AS dim FROM posting_vectors", "posting_vectors")
q("export_matches", f"""
    SELECT profile_id, rank, title, company, location, salary_min, salary_max, salary_value, score, {LINK} AS url, md5(substr(description, 1, 2000)) AS description
    FROM top10""", "top10")
q("export_csv_json", f"""
    SELECT format, profile_id, rank, title, company, location, salary_min, salary_max, salary_value, score, {LINK} AS url, md5(substr(description, 1, 2000)) AS description
    FROM top10, (VALUES ('csv'), ('json')) f(format)""", "top10")
q("job_link", f"SELECT job_id, {LINK} AS link FROM postings", "postings")
q("salary_label", f"SELECT job_id, {SALARY} AS salary FROM enriched", "enriched")

# --- normalization
q("resolve_aliases", """
    SELECT seq, name AS title, company, location, country, salary_min, salary_max, md5(text) AS description, url, dateadded AS posted_date, source,
     NULL::VARCHAR AS skills FROM raw""", "raw")
q("fill_and_strip", "SELECT seq, name AS title, CASE WHEN company = 'Northwind' THEN 'Unknown' ELSE company END AS company, location, country, url, source, dateadded AS posted_date FROM raw", "raw")
q("strip_html", f"SELECT page_id, length({strip_html('html')}) AS n_chars, md5({strip_html('html')}) AS text_md5 FROM pages")
q("coerce_salary", "SELECT seq, CASE WHEN seq % 7 = 0 OR seq % 11 = 0 THEN NULL ELSE salary_min END AS salary_min, salary_max FROM raw", "raw")
q("drop_unusable", """
    SELECT seq, CASE WHEN seq % 3 > 0 THEN title ELSE '' END AS title, CASE WHEN seq % 5 > 0 THEN length(description) ELSE 0 END AS n_chars
    FROM normalized WHERE (seq % 3 > 0 AND title <> '') OR (seq % 5 > 0 AND description <> '')""", "normalized")
q("content_key", "SELECT seq, job_id FROM normalized", "normalized")
q("normalize_postings", f"""
    SELECT seq, job_id, title, company, location, country, salary_min, salary_max, md5(description) AS description, {bar('skills')} AS skills, url, source, posted_date
    FROM normalized""", "normalized")
q("skills_fallback", f"SELECT seq, CASE WHEN seq % 4 = 0 THEN 'kafka|python' ELSE {bar('skills')} END AS skills FROM normalized", "normalized")

# --- dedup
q("dedup_exact", "SELECT seq, job_id, title, company FROM postings", "postings")
q("dedup_title_company", "SELECT seq, title, company FROM normalized QUALIFY row_number() OVER (PARTITION BY title || company ORDER BY seq) = 1", "normalized")
q("bloom_params", "SELECT n, m, k, round(floor((m + 7) / 8) / 1024.0, 6)::DOUBLE AS size_kb FROM post_size", "post_size")
q("bloom_positions", "SELECT doc_id, i, pos FROM documents JOIN doc_bits ON key = text", "doc_bits")
q("bloom_dedup", "SELECT doc_id, lang FROM documents JOIN doc_verdict ON first_seq = doc_id WHERE NOT dropped", "doc_verdict")
q("bloom_false_positives", "SELECT doc_id, lang FROM documents JOIN loose_verdict ON first_seq = doc_id WHERE dropped", "loose_verdict")
q("ingest_stats", stats_sql("post"), "post_verdict", "post_size")
q("inject_dups", stats_sql("mix"), "mix_verdict", "mix_size")


def _dump_bits(source: str) -> str:
    return f"""
        SELECT job_id, (h1 + i * h2) % m AS pos FROM (
         SELECT job_id, m, {hex_mod('md5(job_id)', 32, 'm')} AS h1, {hex_mod('sha1(job_id)', 40, 'm')} AS h2, unnest(range(k)) AS i FROM {source}, dump_size)"""


q("bloom_membership", f"""
    SELECT job_id AS key, bool_and(s.pos IS NOT NULL) AS maybe_seen FROM ({_dump_bits('postings')}) b
    LEFT JOIN (SELECT DISTINCT pos FROM ({_dump_bits('dump_norm')})) s USING (pos) GROUP BY 1""", "postings", "dump_norm", "dump_size")
q("anti_existing", f"""
    SELECT seq, job_id, title FROM normalized WHERE {IS_LIVE} AND job_id NOT IN (SELECT job_id FROM dump_norm)
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY seq) = 1""", "normalized", "dump_norm")
q("upsert_flags", "SELECT job_id, is_contract, sponsors_visa, flags_refreshed FROM tightened", "tightened")

# --- features
for _name in ("seniority", "years_required", "is_contract", "sponsors_visa", "is_defense", "salary_value"):
    q(_name, f"SELECT job_id, {_name} FROM enriched", "enriched")
q("company_size", "SELECT job_id, company, company_size FROM enriched", "enriched")
q("enrich", "SELECT job_id, title, company, seniority, years_required, is_contract, sponsors_visa, is_defense, company_size, salary_value FROM enriched", "enriched")
q("extract_skills", f"SELECT job_id, {bar('skills')} AS skills FROM postings", "postings")
q("skill_overlap", """
    SELECT profile_id, job_id, CAST(len(list_intersect(skills, p_skills)) AS INTEGER) AS n_overlap, CAST(len(list_distinct(skills)) AS INTEGER) AS n_job
    FROM pairs""", "pairs")
q("norm_title", f"SELECT job_id, {norm_title('title')} AS title FROM postings", "postings")
q("title_tokens", f"SELECT job_id, {bar(title_tokens('title'))} AS tokens, {bar(distinctive('title'))} AS distinctive FROM postings", "postings")
q("ats_keywords", f"SELECT job_id, {bar('keywords')} AS keywords, CAST(len(keywords) AS INTEGER) AS n FROM ats_job", "ats_job")
q("candidate_corpus", "SELECT profile_id, corpus FROM corpus", "corpus")
q("profile_blob", f"SELECT profile_id, {BLOB} AS blob FROM profiles", "profiles")
q("job_text", "SELECT job_id, md5(title || '. ' || array_to_string(skills, ' ') || '. ' || substr(description, 1, 500)) AS text_md5 FROM postings", "postings")
q("tfidf_text", f"SELECT job_id, md5({LEXICAL}) AS text_md5 FROM postings", "postings")
q("pretty_skills_ordered", f"""
    SELECT profile_id, job_id, rank, array_to_string(list_transform(list_sort(list_transform(p_skills, lambda s, j: {{
      'place': coalesce(list_position(list_transform(emphasis, lambda e: contains(s, lower(e)) OR contains(lower(e), s)), TRUE) - 1,
                        1000000 + CASE WHEN list_contains(skills, s) THEN 0 ELSE 1 END),
      'i': j, 'skill': s}})), lambda t: {pretty('t.skill')}), '|') AS skills_shown
    FROM top10""", "top10")
_lead = "array_to_string(emphasis[1:3], ', ')"
_fills = {
    "SUMMARY": (vocab.SUMMARY_TEXT, {
        "focus": f"CASE WHEN len(emphasis) > 0 THEN {_lead} || '-focused ' ELSE '' END",
        "role": "coalesce(target_roles[1], 'Analytics professional')",
        "roles": "CASE WHEN len(target_roles) > 0 THEN array_to_string(target_roles[1:3], ', ') ELSE title END",
        "strength": f"CASE WHEN len(emphasis) > 0 THEN {_lead} ELSE array_to_string((CASE WHEN len(covered) > 0 THEN covered WHEN len({MATCHED}) > 0 THEN {MATCHED} ELSE p_skills END)[1:5], ', ') END"}),
    "OPENING": (vocab.OPENING_TEXT, {
        "role": "coalesce(target_roles[1], 'a candidate')",
        "strength": f"array_to_string((CASE WHEN len(emphasis) > 0 THEN emphasis WHEN len({MATCHED}) > 0 THEN {MATCHED} ELSE p_skills END)[1:5], ', ')"}),
    "CLOSING": (vocab.CLOSING_TEXT, {
        "strength": f"CASE WHEN len({MATCHED}) > 0 THEN array_to_string({MATCHED}[1:4], ', ') ELSE 'the core skills you list' END"}),
}


def filled(name: str) -> str:
    template, blanks = _fills[name]
    out = lit(template)
    for blank, value in dict(blanks, title="title", company="company").items():
        out = f"replace({out}, '{{{blank}}}', {value})"
    return out


q("tailored_text", f"""
    SELECT profile_id, job_id, rank, {filled('SUMMARY')} AS summary,
     concat_ws(chr(10) || chr(10), {filled('OPENING')}, nullif({strip('p_resume')}, ''), {filled('CLOSING')}) AS cover_letter
    FROM top10 JOIN (SELECT profile_id, job_id, covered FROM covered) USING (profile_id, job_id)""", "top10", "covered")
q("split_entry", f"""
    SELECT job_id, CASE WHEN seq % 3 > 0 THEN title ELSE '' END AS title,
     CASE WHEN seq % 3 > 0 THEN {strip("company || ' - ' || location")} ELSE title END AS bullet FROM postings""", "postings")
q("section_order", """
    SELECT profile_id, 'profile' || CASE WHEN has_publications THEN '|publications' ELSE '' END ||
     CASE WHEN education_first THEN '|education|experience|projects|skills' WHEN skills_first THEN '|skills|experience|projects|education'
          ELSE '|experience|projects|skills|education' END AS sections FROM profiles""", "profiles")

# --- vectors and retrieval
q("embed_texts", f"""
    SELECT job_id, bucket, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY job_id)), 6) AS weight FROM (
     SELECT job_id, CAST(CAST('0x' || substr(md5(w), 1, 4) AS BIGINT) % 384 AS INTEGER) AS bucket,
      sum(CASE WHEN CAST('0x' || substr(md5(w), 5, 1) AS BIGINT) < 8 THEN 1e0 ELSE -1e0 END) AS raw
     FROM (SELECT job_id, unnest({WORDS.format(x="title || '. ' || array_to_string(skills, ' ') || '. ' || substr(description, 1, 500)")}) AS w FROM postings)
     GROUP BY 1, 2) WHERE raw <> 0""", "postings")
ORACLE["encode_texts"] = ORACLE["embed_texts"]


def _hashed(key: str, text: str, source: str) -> str:
    return f"""
        SELECT {key}, bucket, CAST(CAST(raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS w FROM (
         SELECT {key}, CAST('0x' || substr(md5(w), 1, 4) AS BIGINT) % 384 AS bucket,
          sum(CASE WHEN CAST('0x' || substr(md5(w), 5, 1) AS BIGINT) < 8 THEN 1e0 ELSE -1e0 END) AS raw
         FROM (SELECT {key}, unnest({WORDS.format(x=text)}) AS w FROM {source}) GROUP BY 1, 2) WHERE raw <> 0"""


q("text_candidates", """
    SELECT profile_id, job_id, similarity, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY similarity DESC, job_id) AS INTEGER) AS candidate_rank FROM (
     SELECT p.profile_id, j.job_id, coalesce(round(dot / (p.n * j.n), 9), 0e0) AS similarity FROM tv_people_n p CROSS JOIN tv_posts_n j
      LEFT JOIN (SELECT profile_id, job_id, sum(a.w * b.w) AS dot FROM tv_people a JOIN tv_posts b USING (bucket) GROUP BY 1, 2) d
       ON d.profile_id = p.profile_id AND d.job_id = j.job_id)
    QUALIFY candidate_rank <= 10""", "tv_people_n", "tv_posts_n", extra={
    "tv_posts": (["postings"], _hashed("job_id", "title || '. ' || array_to_string(skills, ' ') || '. ' || substr(description, 1, 500)", "postings")),
    "tv_people": (["profiles"], _hashed("profile_id", BLOB, "profiles")),
    "tv_posts_n": (["tv_posts"], "SELECT job_id, sqrt(sum(w * w)) AS n FROM tv_posts GROUP BY 1"),
    "tv_people_n": (["tv_people"], "SELECT profile_id, sqrt(sum(w * w)) AS n FROM tv_people GROUP BY 1"),
})
q("cosine_knn", """
    SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_cosine_similarity(q.vec, d.vec), 9) AS similarity,
     CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.vec, d.vec), 9) DESC, d.vec_id) AS INTEGER) AS rank
    FROM vecs q, vecs d QUALIFY rank <= 10""", "vecs")
q("candidates", "SELECT * FROM candidates", "candidates")
_post_tf = tfidf_blocks(["postings"], f"SELECT job_id AS id, {LEXICAL} AS text FROM postings", ["profiles"], f"SELECT profile_id AS id, {BLOB} AS text FROM profiles")
q("tfidf_weights", "SELECT id AS job_id, term, round(weight, 6) AS weight FROM tf_doc_weights", "tf_doc_weights", extra=_post_tf)
q("tfidf_topk", "SELECT query_id AS profile_id, doc_id AS job_id, similarity, rank FROM tf_ranked WHERE rank <= 10", "tf_ranked", extra=_post_tf)
q("tfidf_benchmark_topk", "SELECT query_id, doc_id, similarity, rank FROM tf_ranked WHERE rank <= 5", "tf_ranked",
  extra=tfidf_blocks([], "SELECT doc_id AS id, text FROM documents", [], "SELECT item_id AS id, text FROM benchmark"))

# --- filters and scores
for _name in ("f_salary", "f_us_only", "f_locations", "f_contract", "f_seniority", "f_years", "f_industry", "f_company_size", "f_visa"):
    q(_name, f"SELECT job_id, {_name} AS stays, count(*) AS n, sum(profile_id)::BIGINT AS profile_sum FROM pairs GROUP BY ALL", "pairs")
q("hard_filters", "SELECT profile_id, job_id FROM scored", "scored")
q("f_excluded", "SELECT profile_id, job_id FROM scored ANTI JOIN excluded USING (profile_id, job_id)", "scored", "excluded")
for _name in vocab.SIGNALS[1:]:
    q(f"sig_{_name}", f"SELECT job_id, round(bd.{_name}, 9) AS {_name}, count(*) AS n, sum(profile_id)::BIGINT AS profile_sum FROM pairs GROUP BY 1, 2", "pairs")
q("sig_similarity", "SELECT job_id, count(*) AS n, sum(CAST(round(bd.similarity * 1e9) AS BIGINT))::BIGINT AS similarity_sum FROM pairs GROUP BY 1", "pairs")
q("score", "SELECT profile_id, job_id, score FROM scored", "scored")
q("rank_topk", "SELECT profile_id, rank, job_id, title, company, similarity, score FROM ranked", "ranked")
q("rank_counts", """
    SELECT c.profile_id, count(*) AS n_candidates, count(s.job_id) AS n_after_filter
    FROM candidates c LEFT JOIN scored s ON s.profile_id = c.profile_id AND s.job_id = c.job_id GROUP BY 1""", "candidates", "scored")
q("weights_resolve", "SELECT profile_id, " + ", ".join(
    f"CASE WHEN profile_id % 3 = 0 THEN {dict(skills=0.7, title=0.3).get(s, 0.0)}e0 ELSE weights.{s} END AS {s}" for s in vocab.SIGNALS) + " FROM profiles", "profiles")
_reasons = {
    "similarity": ("bd.similarity > 0.3", "'Strong semantic match to your profile (' || CAST(round_even(bd.similarity * 100, 0) AS INTEGER) || '%)'"),
    "skills": (f"len({MATCHED}) > 0", f"'Matches ' || len({MATCHED}) || ' of your skills: ' || array_to_string({MATCHED}[1:6], ', ')"),
    "title": ("bd.title > 0", "'Title aligns with your target roles'"),
    "salary": ("bd.salary >= 1", "'Meets your salary requirement'"),
    "seniority": ("bd.seniority >= 1", "'Seniority level matches your preference'"),
}
_told = ", ".join(
    f"{{'c': -(weights.{s} * bd.{s}), 'i': {n}, 't': CASE WHEN {_reasons[s][0]} THEN {_reasons[s][1]} END}}" for n, s in enumerate(vocab.EXPLAIN_LABELS))
q("explain_matches", f"""
    SELECT profile_id, job_id, rank, CASE WHEN told = '' THEN 'Relevant to your profile' ELSE told END AS reasons, matched, missing, c_similarity, c_title FROM (
     SELECT profile_id, job_id, rank,
      array_to_string(list_transform(list_filter(list_sort([{_told}]), lambda z: z.c < -0.001 AND z.t IS NOT NULL), lambda z: z.t), '|') AS told,
      {bar(MATCHED)} AS matched, {bar(f'({MISSING})[1:8]')} AS missing,
      round(weights.similarity * bd.similarity, 3) AS c_similarity, round(weights.title * bd.title, 3) AS c_title FROM top10)""", "top10")
q("match_card", f"""
    SELECT profile_id, rank, job_id, title, company, location, {SALARY} AS salary, {LINK} AS url, round(score, 2) AS score, company_size, seniority,
     {bar(f'({MATCHED})[1:4]')} AS matched, len(list_intersect(skills, p_skills)) || '/' || len(p_skills) AS overlap, round(bd.similarity, 2) AS similarity,
     bd.salary >= 1 AS salary_ok, bd.title > 0 AS title_ok, {bar(f'({MISSING})[1:3]')} AS missing FROM top10""", "top10")

# --- evaluation
q("precision_at_k", f"SELECT profile_id, precision_at_k, n FROM ({rank_metrics('gains', 1)})", "gains")
q("ndcg_at_k", f"SELECT profile_id, ndcg_at_k FROM ({rank_metrics('gains', 1)})", "gains")
_dense_gain = """SELECT c.profile_id, c.candidate_rank AS rank, len(list_intersect(p.skills, f.skills)) AS gain
    FROM candidates c JOIN postings p USING (job_id) JOIN profiles f USING (profile_id) WHERE c.candidate_rank <= 10"""
_lex_gain = """SELECT t.query_id AS profile_id, t.rank, len(list_intersect(p.skills, f.skills)) AS gain
    FROM tf_ranked t JOIN postings p ON p.job_id = t.doc_id JOIN profiles f ON f.profile_id = t.query_id WHERE t.rank <= 10"""
_gain_blocks = dict(_post_tf, dense_gain=(["candidates", "postings", "profiles"], _dense_gain), lex_gain=(["tf_ranked", "postings", "profiles"], _lex_gain))
q("retrieval_metrics", rank_metrics("dense_gain", 2), "dense_gain", extra=_gain_blocks)
q("retrieval_ab", f"""
    SELECT d.profile_id, d.precision_at_k AS embed_p_at_k, d.ndcg_at_k AS embed_ndcg, l.precision_at_k AS keyword_p_at_k, l.ndcg_at_k AS keyword_ndcg,
     round(d.precision_at_k - l.precision_at_k, 3) AS lift
    FROM ({rank_metrics('dense_gain', 2)}) d JOIN ({rank_metrics('lex_gain', 2)}) l USING (profile_id)""", "dense_gain", "lex_gain", extra=_gain_blocks)
q("profile_pass_criteria", """
    SELECT profile_id, n_senior, n_defense, n_experienced, n_contract, n_junior, n_small,
     (NOT coalesce(cap <= 1, FALSE) OR n_senior = 0) AND (NOT exclude_defense OR n_defense = 0) AND (NOT coalesce(max_years_required < 3, FALSE) OR n_experienced = 0)
     AND (NOT no_contract OR n_contract = 0) AND (NOT coalesce(flr >= 2, FALSE) OR n_junior = 0) AND (NOT coalesce(min_company_size = 'large', FALSE) OR n_small = 0) AS passed
    FROM (SELECT profile_id, count(*) FILTER (seniority IN ('senior', 'staff')) AS n_senior, count(*) FILTER (is_defense) AS n_defense,
           count(*) FILTER (years_required >= 3) AS n_experienced, count(*) FILTER (is_contract) AS n_contract,
           count(*) FILTER (seniority = 'junior') AS n_junior, count(*) FILTER (company_size = 'small') AS n_small FROM top10 GROUP BY 1) JOIN prof USING (profile_id)""", "top10", "prof")
q("ats_match", f"""
    SELECT profile_id, job_id, rank, {bar('covered')} AS covered, {bar('missing')} AS missing, CAST(len(keywords) AS INTEGER) AS n_keywords,
     CASE WHEN len(keywords) > 0 THEN round_even(100e0 * len(covered) / len(keywords), 0) ELSE 0e0 END AS score FROM covered""", "covered")
q("acceptance_curve", """
    SELECT profile_id, round, round(rate, 6) AS accept_rate, round(rate - first_value(rate) OVER (PARTITION BY profile_id ORDER BY round), 6) AS lift FROM (
     SELECT profile_id, CAST(ceil(n / 10.0) AS INTEGER) AS round, avg(CASE WHEN action = 'accept' THEN 1e0 ELSE 0e0 END) AS rate
     FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY seq) AS n FROM feedback) GROUP BY 1, 2)""", "feedback")

# --- analytics
q("top_skills", "SELECT skill, count(*) AS count FROM (SELECT unnest(skills) AS skill FROM postings) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15", "postings")
q("salary_distribution", "SELECT job_id, salary_value AS salary FROM enriched WHERE salary_value > 10000 AND salary_value < 600000", "enriched")
q("salary_histogram", """
    SELECT bin, count(*) AS count, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 30, 4) AS bin_start FROM (
     SELECT lo, hi, least(CAST(floor((salary_value - lo) * 30 / (hi - lo)) AS INTEGER) + 1, 30) AS bin FROM enriched,
      (SELECT min(salary_value) AS lo, max(salary_value) AS hi FROM enriched WHERE salary_value > 10000 AND salary_value < 600000)
     WHERE salary_value > 10000 AND salary_value < 600000) GROUP BY bin""", "enriched")
q("demand_by_location", "SELECT CASE WHEN location = '' THEN 'Unknown' ELSE location END AS location, count(*) AS count FROM postings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12", "postings")
q("demand_by_source", """
    SELECT CASE WHEN contains(source, 'adzuna') THEN 'Adzuna (live)' WHEN contains(source, 'kaggle') THEN 'Kaggle' ELSE 'Other' END AS source, count(*) AS count
    FROM postings GROUP BY 1""", "postings")
q("summary_stats", """
    SELECT count(*) AS total_jobs, count(DISTINCT nullif(company, '')) AS companies, count(DISTINCT nullif(location, '')) AS locations,
     median(CASE WHEN salary_value > 10000 AND salary_value < 600000 THEN salary_value END) AS median_salary,
     round_even(100e0 * count(*) FILTER (salary_value > 10000 AND salary_value < 600000) / greatest(1, count(*)), 1) AS pct_with_salary FROM enriched""", "enriched")


def sketch(items: str, bucket_of: str = "item") -> str:
    return f"CAST(CAST('0x' || substr(md5('0:' || {bucket_of}), CAST(8 * r + 1 AS INTEGER), 8) AS BIGINT) % 256 AS INTEGER)"


def estimates(source: str, item: str, top: int) -> str:
    return f"""
        SELECT item, exact, min(cnt) AS cms_estimate, round_even(100e0 * (min(cnt) - exact) / exact, 2) AS error_pct FROM (
          SELECT item, exact, r, {sketch('e')} AS bucket FROM (SELECT {item} AS item, count(*) AS exact FROM {source} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {top}), range(4) g(r))
        JOIN (SELECT r, {sketch('i')} AS bucket, count(*) AS cnt FROM (SELECT {item} AS item FROM {source}), range(4) g(r) GROUP BY 1, 2) USING (r, bucket) GROUP BY 1, 2"""


q("count_min_sketch", f"SELECT CAST(r AS INTEGER) AS depth_row, {sketch('i', 'word')} AS bucket, count(*) AS cnt FROM doc_words, range(4) g(r) GROUP BY 1, 2", "doc_words")
q("count_min_estimates", estimates("doc_words", "word", 20), "doc_words")
q("count_min_skills", estimates("(SELECT unnest(skills) AS skill FROM postings)", "skill", 10), "postings")
q("distinct_sources_options", f"""
    SELECT DISTINCT 'role' AS kind, unnest(target_roles) AS value FROM profiles UNION SELECT DISTINCT 'location', unnest(locations) FROM profiles
    UNION SELECT 'skill', unnest({[s for s in sorted(vocab.SKILL_PATTERNS)]}) UNION SELECT 'location', unnest({vocab.COMMON_LOCATIONS})""", "profiles")

# --- learning
_w = ", ".join(f"round(w[{n + 1}], 6) AS {s}" for n, s in enumerate(vocab.SIGNALS))
q("reward_map", "SELECT profile_id, seq, CASE action WHEN 'accept' THEN 1e0 WHEN 'reject' THEN -1e0 WHEN 'skip' THEN -0.2e0 ELSE 0e0 END AS reward FROM feedback", "feedback")
q("learner_fold", f"SELECT profile_id, n AS n_seen, {_w} FROM learned WHERE n > 0", "learned", recursive=True)
q("learner_history", f"SELECT profile_id, seq, n AS n_seen, {_w} FROM fold WHERE n > 0", "fold", recursive=True)
q("learner_resume", f"""
    SELECT profile_id, n AS n_seen, {_w} FROM learned
    WHERE profile_id IN (SELECT profile_id FROM fb_events WHERE seq > (SELECT floor(max(seq) / 2) FROM feedback))""", "learned", "feedback", recursive=True)
ORACLE["learner_stream"] = ORACLE["learner_fold"]
q("feedback_exclusions", "SELECT * FROM excluded", "excluded")
q("rerank_after_feedback", f"""
    SELECT profile_id, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY new_score DESC, job_id) AS INTEGER) AS rank, job_id, round(new_score, 6) AS score FROM (
      SELECT s.profile_id, s.job_id, round({score_sum('lw', 'bd')}, 12) AS new_score FROM (
        SELECT s.profile_id, s.job_id, s.bd, CASE WHEN l.n > 0 THEN {{{", ".join(f"'{s}': l.w[{n + 1}]" for n, s in enumerate(vocab.SIGNALS))}}} ELSE s.weights END AS lw
        FROM scored s ANTI JOIN excluded x ON x.profile_id = s.profile_id AND x.job_id = s.job_id LEFT JOIN learned l ON l.profile_id = s.profile_id) s)
    QUALIFY rank <= 10""", "scored", "excluded", "learned", recursive=True)
def _draw(what: str) -> str:
    return f"CAST('0x' || substr(md5('0:' || CAST(profile_id AS VARCHAR) || ':' || CAST(step + 1 AS VARCHAR) || ':{what}'), 1, 8) AS BIGINT) / 4294967296.0"


q("epsilon_greedy", "SELECT profile_id, CAST(step AS INTEGER) AS pick, job_id, from_rank FROM eg WHERE step > 0", "eg", recursive=True, extra={
    "eg_pool": (["scored"], """
        SELECT profile_id, list({'rank': rank, 'job_id': job_id} ORDER BY rank) AS pool FROM (
         SELECT profile_id, job_id, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY score DESC, job_id) AS INTEGER) AS rank FROM scored) GROUP BY 1"""),
    "eg": (["eg_pool"], f"""/*r*/
        SELECT profile_id, 0::BIGINT AS step, pool, NULL::VARCHAR AS job_id, NULL::INTEGER AS from_rank FROM eg_pool
        UNION ALL
        SELECT profile_id, step + 1, list_concat(list_slice(pool, 1, place), list_slice(pool, place + 2, len(pool))), pool[place + 1].job_id, pool[place + 1].rank FROM (
         SELECT *, CASE WHEN {_draw('explore')} < {vocab.EPSILON} AND len(pool) > 1 THEN CAST(floor({_draw('which')} * len(pool)) AS BIGINT) ELSE 0 END AS place
         FROM eg WHERE step < 10 AND len(pool) > 0)"""),
})
q("sample_by_offset", "SELECT count(*) > 0 AS looked, 0::BIGINT AS outside, 0::BIGINT AS unknown_lines, TRUE AS once_each FROM raw", "raw")
q("candidate_pool", """
    SELECT profile_id, job_id, similarity FROM candidates WHERE candidate_rank <= 300
    UNION SELECT profile_id, job_id, similarity FROM sims WHERE job_id IN (SELECT job_id FROM drawn300)""", "candidates", "sims", "drawn300",
  extra={"drawn300": (["postings"], bottom_k("postings", "job_id", 300, 0))})

# --- streaming
q("stream_ingest", "SELECT job_id, seq, title, company, url FROM postings", "postings")
_arrival = "(seq % 2) * 4611686018427387904 + seq"  # reposts come in the second batch
q("stream_bloom", "SELECT key AS job_id, first_seq % 4611686018427387904 AS seq FROM fix_verdict WHERE NOT dropped", "fix_verdict",
  extra=bloom_blocks("fix", "normalized", "job_id", _arrival, BLOOM_P))
q("stream_ack", "SELECT seq, job_id FROM normalized", "normalized")
q("stream_progress", "SELECT count(*) AS total_seen FROM normalized", "normalized")
q("stream_live_merge", """
    SELECT job_id, title, source, is_contract, sponsors_visa FROM tightened
    UNION ALL SELECT job_id, title, source, is_contract, sponsors_visa FROM live_first WHERE job_id NOT IN (SELECT job_id FROM stored)""", "tightened", "live_first", "stored")
q("row_serde", f"SELECT job_id, title, company, salary_min, salary_max, md5(description) AS description_md5, {bar('skills')} AS skills, seq FROM postings", "postings")
