"""Spelling variants: words one edit apart, found by search schemes over FM-indexes of the vocabulary.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The edit then lies
in one half of a word, so the other half occurs unchanged at the other word's end: the scheme matches either half
exactly from its end of the word and extends across the other half, allowing one error, until the delimiter.

The vocabulary is cut twice into ranges, by words and by words read backwards. A task indexes a range: rows are the
suffixes of the delimited text, an interval of rows stands for all occurrences of what is matched, and a symbol is added by
counting it before the interval's ends. Read forwards, an index extends matches to the right, read backwards to the
left: the two directions of the scheme. A word is sent to the ranges that hold words beginning with its exact half only.
Words of a range are distinct, so ranges are of even size whatever the texts repeat.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, tasks

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most words of a range, and words whose search advances together.
RANGE, TOGETHER = 65_536, 8_192
#: Sampled words per range that the cuts are taken from.
SAMPLES = 64
#: After every code point a word may hold.
LAST = chr(0x10FFFF)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, misprints: int = 97) -> DataFrame:
    """word, n of all runs of letters of whole texts; a run loses one code point where ``misprints`` divides its hash.

    Null texts have no runs; the runs of a row without a doc_id lose nothing.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length).withColumn("run", lower_ascii(F.col("run")))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    hit = F.col("doc").isNotNull() & (F.col("h") % misprints == 0)
    words = runs.select(F.when(hit, shorter).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


class Index:
    """FM-index of distinct words, searched from their first code point on.

    The text is every word backwards and a delimiter, symbol 0; ``before`` holds the symbol before each suffix, in
    suffix order, and ``keys`` the pairs (symbol, row) in order: where a pair stands in them is the row that the symbol's suffix leads to.
    """

    def __init__(self, words: list[str]) -> None:
        length = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(w[::-1] + "\0" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.alphabet, text = np.unique(points, return_inverse=True)
        n, self.words = len(text), len(words)
        self.n = n
        end = np.cumsum(length + 1) - 1
        rank = text + len(words)
        rank[end] = np.arange(len(words))  # delimiters differ by their place, so that comparing stops at them
        step, order = 1, np.argsort(rank, kind="stable")
        while True:
            ranked = rank[order]
            fresh = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            rank = rank * (n + 1) + after
            order = np.argsort(rank, kind="stable")
            step *= 2
        self.before = text[order - 1]
        self.keys = np.sort(self.before * n + np.arange(n))
        self.word_at = np.repeat(np.arange(len(words)), length + 1)[order]  # the word that the suffix of a row is in

    def codes(self, words: list[str], length: int) -> np.ndarray:
        """Words of one length as rows of symbols, -1 for one that the index lacks."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(len(words), length)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def add(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more symbol; empty where nothing follows."""
        base = np.maximum(symbol, 0) * self.n
        low, high = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        return low, np.where(symbol > 0, high, low)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, symbol, low, high) of every symbol that may follow: from the rows of a narrow interval, else by trying all."""
        size, width = len(self.alphabet), high - low
        narrow = np.flatnonzero((width > 0) & (width <= size))
        wide = np.flatnonzero(width > size)
        count = width[narrow]
        start = np.repeat(low[narrow] - np.r_[0, np.cumsum(count)[:-1]], count) if len(narrow) else np.empty(0, np.int64)
        pairs = np.unique(np.repeat(narrow, count) * size + self.before[start + np.arange(count.sum())])
        state = np.r_[pairs // size, np.repeat(wide, size)].astype(np.int64)
        symbol = np.r_[pairs % size, np.tile(np.arange(size), len(wide))].astype(np.int64)
        state, symbol = state[symbol > 0], symbol[symbol > 0]
        a, b = self.add(symbol, low[state], high[state])
        full = b > a
        return state[full], symbol[full], a[full], b[full]

    def near(self, codes: np.ndarray, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of codes, word): words that share the first ``exact`` symbols of a row and differ by one edit after them."""
        rows, length = codes.shape
        who, low, high = np.arange(rows), np.zeros(rows, np.int64), np.full(rows, self.words)
        for t in range(exact):
            low, high = self.add(codes[who, t], low, high)
            alive = high > low
            who, low, high = who[alive], low[alive], high[alive]
        done = [np.empty(0, np.int64)] * 3  # states with their error behind them
        for t in range(exact, length):
            state, symbol, a, b = self.branches(low, high)
            # An inserted symbol differs from the next one, a deleted one too: a run of equal symbols has one way only.
            other = symbol != codes[who[state], t]
            state, a, b = who[state[other]], a[other], b[other]
            last = (codes[who, t] != codes[who, t + 1]) if t + 1 < length else np.ones(len(who), bool)
            w, x, y = (np.r_[done[i], (state, a, b)[i]] for i in range(3))
            x, y = self.add(codes[w, t], x, y)
            full = y > x
            done = [np.r_[w[full], state, who[last]], np.r_[x[full], a, low[last]], np.r_[y[full], b, high[last]]]
            low, high = self.add(codes[who, t], low, high)
            alive = high > low
            who, low, high = who[alive], low[alive], high[alive]
        state, _, a, b = self.branches(low, high)
        who, low, high = np.r_[done[0], who[state]], np.r_[done[1], a], np.r_[done[2], b]
        at, stop = np.searchsorted(self.keys, low), np.searchsorted(self.keys, high)  # symbol 0: the word ends here
        ends = stop > at
        return who[ends], self.word_at[self.keys[at[ends]]]


def half(length: int, backwards: bool) -> int:
    """Code points of the half that is matched exactly, in reading order."""
    return length - length // 2 if backwards else length // 2


def _cuts(words: DataFrame, ranges: int, total: int) -> list[list[str]]:
    """Least words of the ranges after the first, by words and by words backwards, from a sample of bounded size."""
    every = max(1, total // (ranges * SAMPLES))
    sample = [r.word for r in words.filter(F.pmod(F.xxhash64(F.lit(7), "word"), F.lit(every)) == 0).select("word").collect()]
    out = []
    for backwards in (False, True):
        ordered = sorted(w[::-1] if backwards else w for w in sample)
        out.append(sorted({ordered[len(ordered) * i // ranges] for i in range(1, ranges)}) if ordered else [])
    return out


def _routes(cuts: list[list[str]]):
    """Rows (part, query, word, n): a word goes to its own range, and to those that its exact half may be found in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part, query, place = [], [], []
            for i, word in enumerate(batch.word):
                for backwards in (False, True):
                    read, own = word[::-1] if backwards else word, cuts[backwards]
                    base = backwards * (len(cuts[0]) + 1)
                    part.append(base + bisect_right(own, read))
                    query.append(False)
                    key = read[:half(len(read), backwards)]
                    to = range(base + bisect_right(own, key), base + bisect_left(own, key + LAST) + 1)
                    part.extend(to)
                    query.extend([True] * len(to))
                    place.extend([i] * (1 + len(to)))
            rows = batch.iloc[place]
            yield pd.DataFrame({"part": part, "query": query, "word": rows.word.to_numpy(), "n": rows.n.to_numpy()})

    return run


def _search(forward: int):
    """Per word: how many near words of this range it has, and the best of them. Parts from ``forward`` on are read backwards."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        backwards = bool(rows.part.iloc[0] >= forward)
        turn = (lambda w: w[::-1]) if backwards else (lambda w: w)
        held, asked = rows[~rows["query"]], rows[rows["query"]]
        none = pd.DataFrame({"word": pd.Series([], dtype=str), "n_near": pd.Series([], dtype="int64"), "form_n": pd.Series([], dtype="int64"), "form": pd.Series([], dtype=str)})
        if not len(held) or not len(asked):
            return none
        index = Index([turn(w) for w in held.word])
        names, counts = held.word.to_numpy(object), held.n.to_numpy(np.int64)
        out = []
        for length, group in asked.groupby(asked.word.str.len()):
            words = group.word.to_numpy(object)
            for at in range(0, len(words), TOGETHER):
                some = words[at:at + TOGETHER]
                i, j = index.near(index.codes([turn(w) for w in some], length), half(length, backwards))
                if backwards:  # a pair that shares the first half is found forwards
                    front = length // 2
                    new = np.fromiter((some[x][:front] != names[y][:front] for x, y in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
                    i, j = i[new], j[new]
                if len(i):
                    found = pd.DataFrame({"word": some[i], "form": names[j], "form_n": counts[j]}).sort_values(["word", "form_n", "form"], ascending=[True, False, True])
                    best = found.drop_duplicates("word")
                    out.append(best.assign(n_near=found.groupby("word").size().loc[best.word].to_numpy()))
        return pd.concat(out)[["word", "n_near", "form_n", "form"]] if out else none

    return run


def near_words(words: DataFrame, most: int = RANGE) -> DataFrame:
    """word, n_near, form, form_n of every word of ``words`` (word, n) that has a near one; ``form`` is the most frequent, ties to the first."""
    spark, total = words.sparkSession, words.count()
    ranges = max(1, -(-total // most), min(tasks(spark), -(-total // 8_192)))
    cuts = _cuts(words, ranges, total)
    forward = len(cuts[0]) + 1
    routed = words.mapInPandas(_routes(cuts), "part int, query boolean, word string, n long")
    found = routed.groupBy("part").applyInPandas(_search(forward), "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every row of ``forms`` (word, form): the last form that following forms leads to. Paths halve each round."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialize(links.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        links = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return links


def spelling_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, misprints: int = 97, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n per word of whole texts.

    A word's form is its near word of most occurrences (ties: the least by code points), if that occurs at least
    ``times`` times as often; following forms leads to its root, itself if it has none. Forms grow in occurrences, so they never
    lead back. Null and empty texts give no word, repeated rows count each, an empty table gives no row. Words may
    be of any length.
    """
    words = materialize(vocabulary(docs, least_length, least_count, misprints), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    fits = F.col("form_n") >= times * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"))
    near = materialize(near, "spelling-near")
    ends = roots(near.filter("form IS NOT NULL"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
