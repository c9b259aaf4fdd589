"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).drop("row_id")


def op2_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.simhash import RADIUS, fingerprint_links

    return fingerprint_links(_table(spark, sf_dir, "documents"), RADIUS)


def op3_piece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from rolefit.llm.pieces import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.pii import personal_data

    return personal_data(_table(spark, sf_dir, "documents"))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.quality import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.maxscore import top_products

    return top_products(_table(spark, sf_dir, "embeddings"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.licenses import license_labels

    return license_labels(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from rolefit.llm.token_files import token_digests, write_token_files

    return token_digests(write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.suffixes import without_repeats

    return without_repeats(_table(spark, sf_dir, "documents"))


def op11_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.hard_negatives import hard_negatives

    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rolefit.llm.spelling import spelling_groups

    return spelling_groups(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_duplicates, op2_simhash_fingerprints, op3_piece_codes, op4_source_mix, op5_personal_data, op6_quality_scores, op7_top_products, op8_license_scan, op9_token_files, op10_repeated_spans, op11_toxicity_scores, op12_hard_negatives, op13_spelling_groups)
}
#: Where SQL can say the same over the whole tables; the other queries are tested against plain versions.
ORACLE: dict[str, str] = {
    "op1_near_duplicates": r"""
WITH RECURSIVE split AS (
 SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
 FROM documents),
shingle AS MATERIALIZED (
 SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
edge AS MATERIALIZED (
 SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
 JOIN size i ON i.doc_id = p.a JOIN size j ON j.doc_id = p.b WHERE 100 * c >= 85 * (i.n + j.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)""",
    "op7_top_products": """
WITH v AS MATERIALIZED (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
 SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * d.x[i])) AS BIGINT) AS score
 FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20""",
    "op12_hard_negatives": """
WITH v AS MATERIALIZED (
 SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
 SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
 n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3""",
    "op13_spelling_groups": r"""
WITH RECURSIVE step(b, v, k) AS (
 SELECT b, b, 0 FROM (SELECT unnest(range(0, 256)) AS b)
 UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM step WHERE k = 8),
run AS (
 SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
 FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)),
counted AS (SELECT doc_id, r, count(*) AS n FROM run WHERE length(r) >= 5 GROUP BY ALL),
bytes AS (
 SELECT doc_id, r, n, list_transform(range(1, octet_length(encode(s)) + 1), lambda i: CAST(('0x' || substring(hex(encode(s)), CAST(2 * i - 1 AS BIGINT), 2)) AS BIGINT)) AS x
 FROM (SELECT *, doc_id || ':' || r AS s FROM counted)),
hashed AS MATERIALIZED (
 SELECT r, n, xor(list_reduce(x, lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc),
word AS MATERIALIZED (
 SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN h % 97 = 0 THEN substring(r, 1, CAST(h % length(r) AS BIGINT)) || substring(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS w, n FROM hashed)
 WHERE length(w) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cut AS MATERIALIZED (
 SELECT w, n, i, substring(w, 1, i - 1) || substring(w, i + 1) AS c FROM (SELECT w, n, CAST(unnest(range(1, length(w) + 1)) AS BIGINT) AS i FROM word)),
pair AS (
 SELECT a.w, b.w AS v, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.c = b.c AND a.w <> b.w
 UNION SELECT a.w, b.w, b.n FROM cut a JOIN word b ON a.c = b.w
 UNION SELECT b.w, a.w, a.n FROM cut a JOIN word b ON a.c = b.w),
best AS (SELECT w, count(*) AS n_near, max(n) AS m, arg_min(v, (-n, encode(v))) AS f FROM pair GROUP BY 1),
form AS MATERIALIZED (
 SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * word.n THEN f END AS f, CASE WHEN m >= 2 * word.n THEN m END AS m FROM word LEFT JOIN best USING (w)),
walk AS (SELECT w, w AS at, f FROM form UNION ALL SELECT walk.w, form.w, form.f FROM walk JOIN form ON form.w = walk.f)
SELECT form.w AS word, form.f AS form, walk.at AS root, form.n, form.n_near, form.m AS form_n FROM form JOIN walk ON walk.w = form.w AND walk.f IS NULL""",
}
