import re

from rolefit.llm.license_rules import build_rules
from rolefit.llm.licenses import BASE, license_labels, scan
from tests.llm.odd import documents, null_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()] for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def detections(text, rules):
    """Every rule over the whole text, without keywords, then the same suppression."""
    line = f" {' '.join(words(text))} "
    hits = []
    for n, r in enumerate(rules):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line):
            first = line[:m.start()].count(" ") - 1
            hits.append((r.priority, -n, r.label, first, first + m[0].count(" ")))
    return {(p, label, a, b) for p, n, label, a, b in hits if not any((q, m) > (p, n) and c <= a and d >= b for q, m, _, c, d in hits)}


def test_every_document_against_plain_matching(spark, sf_dir):
    rules = build_rules()
    assert 200 < len(rules) < 1000
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(documents(spark).drop("row_id", "size", "rank", "line"))
    docs = docs.unionByName(documents(spark, [f" {r.pattern}" for r in rules] + [re.sub(r"\(\?:.*?\)\??|\[sc\]|\?|\(.*?\)", "c", r.pattern) for r in rules]).drop("row_id", "size", "rank", "line"))
    for r in scan(docs, keep=("text",)).collect():
        assert {(d.priority, d.label, d.first, d.last) for d in r.detections} == detections(r.text, rules), r.text
    for r, d in zip(license_labels(docs).collect(), docs.collect()):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(d.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_overlaps_and_odd_rows(spark):
    r = license_labels(documents(spark, ["cc by cc by", "CC-BY 4.0", "GNU Lesser General Public License version 2.1", "Kelvin all rights reserved", None])).collect()
    assert [x.n_base for x in r] == [2, 1, 1, 1, 0] and (r[0].first_word, r[0].last_word) == (0, 2)
    assert r[1].labels == "cc-by,cc-by-4.0" and r[2].labels == "gpl,lgpl-2.1" and r[3].first_word == 1
    assert license_labels(documents(spark, empty=True)).count() == 0
    assert license_labels(null_rows(spark)).count() == 4
