"""Personal data: fixed patterns seed a bootstrapped contextual extraction.

Base entities (e-mail, IP, card and phone numbers) are seeds. The words before a seed are its lexical pattern. A
graph of patterns and instances (tokens that look like identifiers) is scored in rounds until nothing changes: a pattern
by the scores of the instances it stands before, an instance by the other patterns that it follows; confident instances
are seeds of further patterns. Patterns of high confidence then mark tokens that no base pattern matched. Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, numbered, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPACE = "\\x20\\x09-\\x0D"
#: Possessive forms that find what the plain ones find, in linear time: a run is entered at its start only.
PATTERNS = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9]++(?:[\\x20-][0-9]++)*+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Words that hold a digit or an at sign.
TOKEN = f"(?<![^{_SPACE}])(?=[^{_SPACE}0-9@]*+[0-9@])[^{_SPACE}]++"
#: Words before a token that are its pattern, and what stands there for a word that looks like an identifier itself.
CONTEXT_WORDS, NEIGHBOUR = 2, "<id>"
#: Different seeds or confident instances that a pattern needs, the percentage of confidence at which it marks tokens.
SUPPORT, CONFIDENCE = 3, 70
#: Shortest token that a pattern may mark.
SHORTEST = 4

_q = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cut(text: str, pattern: str) -> str:
    """SQL: struct(start, end, hit, before) of every match, in code points; ``before`` is what stands since the last one."""
    return f"""aggregate(zip_with(regexp_extract_all({text}, {_q(pattern)}, 0), split({text}, {_q(pattern)}, -1), (m, b) -> struct(m, b)),
        struct(0L AS at, cast(array() AS array<struct<start:bigint,end:bigint,hit:string,before:string>>) AS out),
        (acc, x) -> if(x.m IS NULL, acc, struct(acc.at + char_length(x.b) + char_length(x.m) AS at, concat(acc.out, array(struct(
            acc.at + char_length(x.b) AS start, acc.at + char_length(x.b) + char_length(x.m) AS end, x.m AS hit, x.b AS before))) AS out)),
        acc -> acc.out)"""


_HOLDS = {
    "email": "true",
    "ip": f"s.hit RLIKE {_q(f'^{_PART}(?:[.]{_PART}){{3}}$')}",
    "card": "char_length(regexp_replace(s.hit, '[^0-9]', '')) BETWEEN 12 AND 19 AND luhn_check(regexp_replace(s.hit, '[^0-9]', ''))",
    "phone": "char_length(regexp_replace(s.hit, '[^0-9]', '')) BETWEEN 9 AND 15",
}
_CUE = {"email": "contains(text, '@')", "ip": "text RLIKE '[0-9][.][0-9]'", "card": "text RLIKE '[0-9]'", "phone": "contains(text, '+')"}
_SPANS = "array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>"


def base_spans() -> Column:
    """Of a column ``text``: all base entities by start, then kind."""
    of = [f"if({_CUE[k]}, transform(filter({_cut('text', PATTERNS[k])}, s -> {_HOLDS[k]}), s -> struct(s.start AS start, {n} AS kind_no, '{k}' AS kind, s.end AS end)), cast(array() AS {_SPANS}))"
          for n, k in enumerate(KINDS)]
    return F.expr(f"array_sort(concat({', '.join(of)}))")


def _tokens() -> Column:
    """Of columns ``text`` and ``base``: the words that look like identifiers, their context, and the base kind that starts in them.

    The context is the last CONTEXT_WORDS whole words before, the last one first, NEIGHBOUR for each that looks like an
    identifier: the words of a list of identifiers have contexts like others. A word that begins its text has none.
    """
    words = f"'[^{_SPACE}]+'".replace("\\", "\\\\")
    token = _q(TOKEN)
    context = f"slice(concat(x.w, acc.last), 1, {CONTEXT_WORDS})"
    cut = f"""aggregate(zip_with(regexp_extract_all(text, {token}, 0), split(text, {token}, -1), (m, b) -> struct(
            m, b, if(m IS NULL, NULL, slice(reverse(regexp_extract_all(lower(b), {words}, 0)), 1, {CONTEXT_WORDS})) AS w)),
        struct(0L AS at, cast(array() AS array<string>) AS last, cast(array() AS array<struct<start:bigint,end:bigint,hit:string,context:string>>) AS out),
        (acc, x) -> if(x.m IS NULL, acc, struct(acc.at + char_length(x.b) + char_length(x.m) AS at,
            slice(concat(array('{NEIGHBOUR}'), {context}), 1, {CONTEXT_WORDS}) AS last,
            concat(acc.out, array(struct(acc.at + char_length(x.b) AS start, acc.at + char_length(x.b) + char_length(x.m) AS end, x.m AS hit,
                array_join({context}, ' ') AS context))) AS out)),
        acc -> acc.out)"""
    hit = "rtrim('.,;:!?)', t.hit)"
    seed = "array_min(transform(filter(base, s -> s.start >= t.start AND s.start < t.end), s -> s.kind_no))"
    return F.expr(f"""if(text RLIKE '[0-9@]', filter(transform({cut}, t -> struct(
        t.start AS start, t.start + char_length({hit}) AS end, lower({hit}) AS token, t.context AS context, {seed} AS seed,
        exists(base, s -> s.start < t.end AND s.end > t.start) AS covered)),
        t -> t.context <> '' AND (t.seed IS NOT NULL OR NOT t.covered)), NULL)""")


def bootstrap(tokens: DataFrame) -> DataFrame:
    """context, kind_no, confidence: the patterns of high confidence (in percent, rounded down).

    ``tokens`` has context, token and seed (kind number, null where no base pattern matched). A pattern's confidence is
    the mean score of its different instances; a seed scores 1, another instance by the chance that not all of its other
    patterns are wrong: a pattern's own vote never counts for it. A pattern needs SUPPORT different seeds or instances that
    score CONFIDENCE without it. Scores only rise from round to round, each of which is written; when one changes no
    pattern, no instance changes either, and the rounds end. Whole percents bound their number. Frequent contexts and
    tokens are summed in each task first; joins on them are equi-joins of written tables, which Spark splits where skewed.
    """
    edges = materialize(tokens.groupBy("context", "token").agg(F.min("seed").alias("seed")), "pii-edges")
    sizes = edges.groupBy("context").agg(F.count("*").alias("instances"))
    seeded = edges.filter("seed IS NOT NULL").groupBy("context", F.col("seed").alias("kind_no")).agg(F.count("*").alias("seeds"))
    unseen = edges.filter("seed IS NULL").select("context", "token")
    # What never changes: the seeds of a context, and its number of instances.
    seeded = materialize(seeded.join(sizes, "context"), "pii-seeds")
    sizes = materialize(sizes.join(unseen.select("context").distinct(), "context"), "pii-sizes")
    percent = lambda score: F.least(F.floor(100 * score / F.col("instances") + 1e-9), F.lit(100))
    scored = materialize(seeded.filter(F.col("seeds") >= SUPPORT).select("context", "kind_no", percent(F.col("seeds")).alias("confidence")), "pii-patterns")
    state = lambda frame: tuple(frame.agg(F.count("*"), F.sum("confidence")).first())
    before, now = None, state(scored)
    while now != before:
        doubt = scored.select("context", "kind_no", "confidence", F.log(F.greatest(1 - F.col("confidence") / 100, F.lit(1e-6))).alias("doubt")).filter("confidence > 0")
        votes = unseen.join(doubt, "context").groupBy("token", "kind_no").agg(F.sum("doubt").alias("doubts"))
        votes = materialize(votes, "pii-instances")
        others = unseen.join(votes, "token").join(doubt.select("context", "kind_no", "doubt"), ["context", "kind_no"], "left")
        score = 1 - F.exp(F.col("doubts") - F.coalesce("doubt", F.lit(0.0)))
        others = others.withColumn("score", score).filter("score > 1e-9")
        gained = others.groupBy("context", "kind_no").agg(F.sum("score").alias("gain"), F.count_if(100 * F.col("score") + 1e-9 >= CONFIDENCE).alias("found"))
        gained = gained.join(sizes, "context").select("context", "kind_no", "instances", F.lit(0).cast("long").alias("seeds"), "gain", "found")
        known = seeded.select("context", "kind_no", "instances", "seeds", F.lit(0.0).alias("gain"), F.lit(0).cast("long").alias("found"))
        again = known.unionByName(gained).groupBy("context", "kind_no").agg(
            F.max("instances").alias("instances"), F.max("seeds").alias("seeds"), F.max("gain").alias("gain"), F.max("found").alias("found"))
        again = again.filter(F.col("seeds") + F.col("found") >= SUPPORT)
        scored = materialize(again.select("context", "kind_no", percent(F.col("seeds") + F.col("gain")).alias("confidence")), "pii-patterns")
        before, now = now, state(scored)
    best = scored.filter(F.col("confidence") >= CONFIDENCE).groupBy("context").agg(F.max(F.struct("confidence", -F.col("kind_no"))).alias("best"))
    return best.select("context", (-F.col("best.col2")).cast("int").alias("kind_no"), F.col("best.confidence").alias("confidence"))


def find(docs: DataFrame, key: str | None = None) -> DataFrame:
    """row_id, doc_id, base and spans (structs of start, kind_no, kind, end in code points) per row of ``docs``.

    ``docs`` has doc_id and text, and a column ``key`` where rows have a unique number already (else they are numbered
    as they are scanned). Null texts are empty. Base spans are all in ``spans``; what the patterns add never overlaps one.
    """
    row_id = F.col(key) if key else F.monotonically_increasing_id()
    rows = docs.select(row_id.alias("row_id"), "doc_id", text_or_empty().alias("text"))
    rows = rows.withColumn("base", F.when(F.expr("text RLIKE '[0-9@]'"), base_spans()).otherwise(F.expr(f"cast(array() AS {_SPANS})")))
    rows = materialize(rows.select("row_id", "doc_id", "base", _tokens().alias("tokens")), "pii-rows")
    tokens = rows.select("row_id", F.inline("tokens"))
    patterns = materialize(bootstrap(tokens.select("context", "token", "seed")), "pii-confident")
    unseen = tokens.filter((F.col("seed").isNull()) & (F.char_length("token") >= SHORTEST)).select("row_id", "context", "start", "end")
    kinds = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1)
    more = unseen.join(patterns, "context").groupBy("row_id").agg(
        F.collect_list(F.struct("start", "kind_no", kinds.alias("kind"), "end")).alias("more"))  # of one text
    return rows.select("row_id", "doc_id", "base").join(more, "row_id", "left").select(
        "row_id", "doc_id", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def _said(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base entities), base_sha256 and spans per row of ``docs``."""
    found = find(docs)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_said("base").cast("binary"), 256).alias("base_sha256"), _said("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars follows where there is such a column."""
    keyed = numbered(docs, "pii-numbered")
    spans = find(keyed.select("row_id", "doc.doc_id", "doc.text"), key="row_id").filter("size(spans) > 0").select(F.col("row_id").alias("of"), "spans")
    rows = keyed.select("row_id", "doc").join(spans, F.col("row_id") == F.col("of"), "left")
    text = F.expr("""CASE WHEN spans IS NULL THEN doc.text ELSE aggregate(spans, struct(0L AS at, '' AS out), (acc, s) -> if(s.start < acc.at,
        struct(greatest(acc.at, s.end) AS at, acc.out AS out),
        struct(s.end AS at, concat(acc.out, substring(doc.text, cast(acc.at AS int) + 1, cast(s.start - acc.at AS int)), '[', upper(s.kind), ']') AS out)),
        acc -> concat(acc.out, substring(doc.text, cast(acc.at AS int) + 1))) END""")
    rows = rows.withColumn("new_text", text)
    return rows.select(*[F.col("new_text").alias(c) if c == "text" else F.char_length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                         else F.col(f"doc.{c}").alias(c) for c in docs.columns])
