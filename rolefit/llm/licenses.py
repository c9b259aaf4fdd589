"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority.

Everything is a column expression on the text's own row: no join, shuffle or Python. A text is cut into
lower-case words once; rules run only on texts that hold a cue of theirs, each only if its own keyword occurs.
A detection is dropped if one of higher priority (or of an earlier rule of the same priority) contains its
interval of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import text_or_empty
from rolefit.llm.license_rules import Rule, build_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, after A-Z have become a-z.
MARKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Phrases that every scan reports, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_q = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def word_line(text: Column) -> Column:
    """The words of a text in lower case (A-Z only), joined by single blanks, with a blank on either side."""
    line = F.regexp_replace(F.translate(text, UPPER, LOWER), MARKS, " ")
    return F.concat(F.lit(" "), F.btrim(line), F.lit(" "))


def _places(line: str, pattern: str) -> str:
    """SQL: [first word, last word] of every match of a pattern over whole words."""
    between = f"split({line}, concat('(?<= )(?:', {pattern}, ')(?= )'), -1)"
    found = f"regexp_extract_all({line}, concat('(?<= )(?:', {pattern}, ')(?= )'), 0)"
    blanks = lambda s: f"(octet_length({s}) - octet_length(replace({s}, ' ', '')))"
    return f"""aggregate(zip_with({found}, {between}, (m, b) -> struct(coalesce({blanks('b')}, 0) AS b, coalesce({blanks('m')}, 0) AS m, m IS NOT NULL AS hit)),
        struct(-1L AS at, cast(array() AS array<struct<first:bigint,last:bigint>>) AS places),
        (acc, x) -> struct(acc.at + x.b + x.m AS at,
            if(x.hit, concat(acc.places, array(struct(acc.at + x.b AS first, acc.at + x.b + x.m AS last))), acc.places) AS places),
        acc -> acc.places)"""


def _base(line: str) -> str:
    """SQL: struct(label, first, last) of all places of the base phrases."""
    one = lambda phrase, label: f"""if(contains({line}, {_q(f' {phrase} ')}),
        transform({_places(line, _q(phrase))}, p -> struct({_q(label)} AS label, p.first AS first, p.last AS last)), {_NONE})"""  # noqa: E731
    return f"concat({', '.join(one(p, l) for p, l in BASE.items())})"


_NONE = "cast(array() AS array<struct<label:string,first:bigint,last:bigint>>)"


def _rules(rules: list[Rule]) -> str:
    """SQL: the rules by keyword, so that each keyword is looked up once."""
    by: dict[str, list[str]] = {}
    for i, r in enumerate(rules):
        by.setdefault(r.keyword, []).append(f"struct({_q(r.pattern)} AS pattern, {_q(r.label)} AS label, {r.priority} AS priority, {i} AS place)")
    return "array(" + ", ".join(f"struct({_q(k)} AS keyword, array({', '.join(rows)}) AS rules)" for k, rows in by.items()) + ")"


def cues(rules: list[Rule]) -> list[str]:
    """Strings of which every keyword holds one, so that most texts are passed over after some byte searches."""
    left, chosen = {r.keyword for r in rules}, ["licen"]
    while left := {k for k in left if not any(c in k for c in chosen)}:
        chosen.append(max((max(k.split(), key=len) if max(map(len, k.split())) > 5 else k for k in left), key=lambda w: (sum(w in k for k in left), w)))
    return chosen


def scan(docs: DataFrame, rules: list[Rule] | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs`` (text, and the columns of ``keep``): n_words, base and detections.

    ``base`` holds all places of the base phrases, ``detections`` what the rules found and suppression left:
    structs of label, first, last (words from 0), detections also with priority. Null texts are empty: no words,
    no places. Repeated rows, null ids and very long texts are rows like others.
    """
    rules = rules or build_rules()
    frame = docs.select(*keep, word_line(text_or_empty()).alias("line"))
    frame = frame.withColumn("n_words", F.when(F.col("line") == "  ", 0).otherwise(F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) - 1).cast("long"))
    cue = " OR ".join(f"contains(line, {_q(c)})" for c in cues(rules))
    hits = f"""flatten(transform(flatten(transform(filter({_rules(rules)}, k -> contains(line, k.keyword)), k -> k.rules)),
        r -> transform({_places('line', 'r.pattern')}, p -> struct(r.priority AS priority, -r.place AS rule, r.label AS label, p.first AS first, p.last AS last))))"""
    none = "cast(array() AS array<struct<priority:int,rule:int,label:string,first:bigint,last:bigint>>)"
    frame = frame.withColumn("base", F.expr(_base("line"))).withColumn("hits", F.expr(f"if({cue}, {hits}, {none})"))
    kept = """filter(hits, h -> NOT exists(hits, o -> (o.priority > h.priority OR (o.priority = h.priority AND o.rule > h.rule))
        AND o.first <= h.first AND o.last >= h.last))"""
    return frame.select(*keep, "n_words", "base", F.expr(kept).alias("detections"))


def license_labels(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs``.

    ``score`` is the highest priority found, as a part of 100; 0 where nothing is found.
    """
    found = scan(docs, rules)
    labels = lambda a: f"transform({a}, x -> x.label)"
    return found.select(
        "doc_id", "n_words", F.expr("cast(size(base) AS bigint) AS n_base"),
        F.expr("array_min(transform(base, x -> x.first)) AS first_word"), F.expr("array_max(transform(base, x -> x.first)) AS last_word"),
        F.expr(f"array_join(array_sort(array_distinct({labels('base')})), ',') AS base_labels"),
        F.expr(f"array_join(array_sort(array_distinct(concat({labels('base')}, {labels('detections')}))), ',') AS labels"),
        F.expr("greatest(coalesce(array_max(transform(detections, x -> x.priority)), 0), if(size(base) > 0, 35, 0)) / 100.0D AS score"))
