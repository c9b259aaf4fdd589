"""Small tables of odd rows that every operator has to take."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("row_id", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("line", T.StringType()),
])

LONG = " ".join(f"word{i % 977} is in the long text {i}" for i in range(4000))
TEXTS = [
    None, "", "   \n\t ", "one", "one two", "a b c d e", "a b c d e", "a b c d e f g", LONG, LONG, LONG + " tail",
    "mail me at bob.42@mail8.example.com or +1 (988) 555-2485, card 4524132264652876 from 25.102.19.31",
    "Licensed under CC BY-NC 4.0. All rights reserved. GNU General Public License, version 3.", "İstanbul ß é 漢字 \U0001f600 K",
    "x" * 5000, "ab" * 3000, "the cat sat on the mat and the dog ran after the cat in the garden of the house",
    "the cat sat on the mat and the dog ran after the cat in the garden of the home", "\x1c odd \x85 blanks here", "<|endoftext|> inside",
]


def documents(spark, texts=None, empty=False):
    """Repeated rows, null ids, null sources, ties; columns whose names an operator may use itself."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t, "en", [None, "a", "b", "c"][i % 4], None if t is None else len(t), "r", "s", "k", "l") for i, t in enumerate(texts)]
    rows = [] if empty else rows
    return spark.createDataFrame(rows, DOCUMENTS)


def null_rows(spark):
    """Rows that are null in every column, and a repeated row."""
    return spark.createDataFrame([(None,) * 9, (None,) * 9, (3, "same row", "en", "a", 8, "", "", "", ""), (3, "same row", "en", "a", 8, "", "", "", "")], DOCUMENTS)
