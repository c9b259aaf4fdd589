import re

from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.functions.text import mark_words, marked_word
from rolefit.operators import ats

ODD = ["", "sql", "SQL.", "c++17 and p&l", "c++", "C++ c + + r&d r", "machine learning", "machine  learning", "machine\x01 learning", "\x01sql\x01",
       "nosql mysql sql-server sql server", "month-end close, month - end close", "a/b testing fp&a", "übersql sqlé scikit-learn_ scikit-learn", "deep reinforcement\nkpi kpis"]


def test_only_keywords_whose_words_are_there_are_searched(spark):
    """A text of many words is not searched for each keyword, and each one named is found all the same."""
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(ODD + [None])], "id int, text string").select("id", mark_words(F.col("text")).alias("marked"))
    got = {r.id: r for r in ats.with_words(rows).select("*", ats.ats_hits("marked", "words").alias("hits")).collect()}
    for n in range(len(ODD)):
        assert got[n].hits == [k for k in vocab.ATS_VOCABULARY if marked_word(k) in got[n].marked]
        assert all(re.search(r"\w", w) and w in ODD[n].lower() for w in got[n].words)
    assert got[len(ODD)].hits == [] and got[3].words == ["and", "c", "l", "p"]
    custom = ats.with_words(rows, ["++", "café"]).select("id", ats.ats_hits("marked", "words", ["++", "café"]).alias("hits")).collect()
    assert all(r.hits == [k for k in ["++", "café"] if marked_word(k) in (got[r.id].marked or "")] for r in custom)
