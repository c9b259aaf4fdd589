"""Toxicity: disguised words are restored through a noisy channel, the restored text is scored.

A writer's letters pass a channel that swaps them for look-alike symbols, spaces them out and repeats them. A disguised token
becomes a lattice: each symbol may stand for several letters, for a gap or for nothing, each at a cost. The Viterbi path
through it, under a character model (trigrams of the letters of all documents), is the restored token. Tokens without any
sign of the channel are taken as they are.

The score rests on words and their beginnings: each has a weight, a lower bound of its log odds between labelled rows, and a
text a few sums of the weights of its words, which a logistic regression turns into a probability. Weights for fitting that
leave the row's own fold out, so that it sees what unseen rows look like.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, text_or_empty

#: Letters that symbols may stand for. Fixed values.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Costs of the channel, in nats: a symbol for a letter, a mark between letters, a symbol for nothing, a gap between words, a letter
#: written more than twice, one of two letters in excess.
SWAP, MARK, DROP, GAP, REPEAT, EXCESS = 0.7, 0.3, 6.0, 3.0, 1.0, 6.0
#: Classes of characters: 0 parts words, 1 to 26 a to z, then the letters of Latin-1 and Latin Extended-A, the last for other letters.
CLASSES = 64
#: Labelled rows that a model is fit to at most, and the most words and beginnings with a weight.
MAX_ROWS, MAX_WEIGHTS = 40_000, 200_000
#: Code points of the shortest and longest beginning of a word that has a weight of its own.
SHORTEST, LONGEST = 3, 7
#: Least labelled toxic rows with a word, least weight, and standard errors taken off the log odds.
LEAST_ROWS, LEAST_WEIGHT, ERRORS = 3, 0.3, 2.0
#: Entries that a task holds before it passes counts on, or forgets tokens.
HELD = 300_000

_LATIN = sorted(c for c in map(chr, range(0xDF, 0x180)) if c.isalpha() and c == c.lower())
_ORDER = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
_ORDER |= {c: 27 + i % (CLASSES - 28) for i, c in enumerate(_LATIN)}
_TABLE = np.zeros(0x3000, np.int64)
for _i in range(len(_TABLE)):
    _TABLE[_i] = _ORDER.get(chr(_i).lower(), CLASSES - 1) if chr(_i).isalpha() else 0
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_PARTED = re.compile(r"[^\s.\-_*~,;:/'\"]+?(?:[\s.\-_*~,;:/'\"]+[^\s.\-_*~,;:/'\"]){2,}")
_GAPS = re.compile(r"[^\w@$!|+(€£¡]+|_+")
_THRICE = re.compile(r"([^\W\d_])\1\1")


def classes(text: str) -> np.ndarray:
    """The class of every character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], CLASSES - 1)


def trigrams(text: str) -> np.ndarray:
    """How often each class follows the two before it in its word, as a flat array; words begin after (0, 0)."""
    c = np.r_[0, 0, classes(text), 0]
    one, two = c[1:-1], np.where(c[1:-1] == 0, 0, c[:-2])
    return np.bincount((two * CLASSES + one) * CLASSES + c[2:], minlength=CLASSES**3)


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of the whole texts of all documents; tasks add up their own, the result has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros(CLASSES**3, np.int64), False
        for batch in batches:
            for at in range(0, len(batch), 256):
                total += trigrams("\n".join(batch.column(0).slice(at, 256).to_pylist()))
                any_ = True
        if any_:
            spot = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"code": spot, "n": total[spot]})

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(CLASSES**3)
    out[rows.code.to_numpy(np.int64)] = rows.n
    out[0] = 0
    return out


class Letters:
    """The character model: log probabilities of a class after two others, trigrams backed by pairs and single letters."""

    def __init__(self, counts: np.ndarray) -> None:
        three = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        single = (one + 1) / (one.sum() + CLASSES)

        def smooth(seen: np.ndarray, back: np.ndarray) -> np.ndarray:
            kinds = (seen > 0).sum(axis=-1, keepdims=True) + 1.0
            return (seen + kinds * back) / (seen.sum(axis=-1, keepdims=True) + kinds)

        self.cost = np.float32(-np.log(smooth(three, smooth(two, single[None])[None])))
        self.flat: list[float] | None = None

    def __getstate__(self) -> dict:
        return {"cost": self.cost, "flat": None}

    def costs(self) -> list[float]:
        if self.flat is None:
            self.flat = self.cost.ravel().tolist()
        return self.flat


@lru_cache(maxsize=100_000)
def channel(char: str, times: int) -> tuple[tuple[tuple[str, ...], float], ...]:
    """(letters, cost) that a character, met ``times`` in a row (3 stands for more), may stand for; a blank parts words."""
    if char.isalpha():
        if times == 1:
            return (((char,), 0.0),)
        return (((char, char), REPEAT * (times > 2)), ((char,), EXCESS if times == 2 else REPEAT))
    out = [((c,) * n, SWAP + (0.0 if times == n else REPEAT if times > 2 else EXCESS)) for c in LOOKS.get(char, "") for n in range(1, min(times, 2) + 1)]
    if not char.isalnum():
        out.append(((), DROP if char in LOOKS else MARK))
    return (*out, ((" ",), GAP + DROP * (char in LOOKS)))


def restore(token: str, model: Letters) -> list[str]:
    """Words of the cheapest path through the lattice of a token; blanks within it are gaps that the channel may have added."""
    cost = model.costs()
    states: dict[tuple[int, int], tuple[float, object]] = {(0, 0): (0.0, None)}
    for char, run in groupby(token):
        ways = [([(c, 0 if c == " " else (_ORDER.get(c) or CLASSES - 1)) for c in letters], price) for letters, price in channel(char, min(3, sum(1 for _ in run)))]
        step: dict[tuple[int, int], tuple[float, object]] = {}
        for (two, one), (so_far, path) in states.items():
            for letters, price in ways:
                a, b, total, way = two, one, so_far + price, path
                for c, k in letters:
                    if k or b:
                        total += cost[(a * CLASSES + b) * CLASSES + k]
                        a, b, way = (b, k, (way, c)) if k else (0, 0, (way, c))
                if (a, b) not in step or total < step[a, b][0]:
                    step[a, b] = (total, way)
        states = step
    path = min(((total + (cost[(a * CLASSES + b) * CLASSES] if b else 0.0), n, way) for n, ((a, b), (total, way)) in enumerate(states.items())), key=lambda x: x[:2])[2]
    letters = []
    while path is not None:
        path, c = path
        letters.append(c)
    return "".join(reversed(letters)).split()


def words_of(token: str, model: Letters) -> list[str]:
    """The words of a lower-case token without blanks, or of one-character tokens joined by blanks."""
    if token.isalpha():
        return [token] if not _THRICE.search(token) else restore(token, model)
    bare = _OUTER.sub("", token)
    at = token.find(bare) - 1 if bare else -1
    tail = token[at + 1 + len(bare):]
    if at >= 0 and token[at] in LOOKS and (at == 0 or token[at - 1] != token[at]):
        bare = token[at] + bare  # a symbol in place of the first letter
    if bare and 0 < len(tail) < 3 and all(c in "$@€£" for c in tail):
        bare += tail  # symbols in place of the last letters
    if bare.isalpha():
        return [bare] if not _THRICE.search(bare) else restore(bare, model)
    if _PARTED.fullmatch(bare):
        return restore(bare, model)
    out = []
    for part in _GAPS.split(bare):
        if part.isalpha() and not _THRICE.search(part):
            out.append(part)
        elif any(map(str.isalpha, part)):
            out.extend(restore(part, model))
    return out


def tokens(text: str) -> list[str]:
    """Lower-case tokens between blanks; three or more tokens of one character in a row are one token, with its blanks."""
    low = text.lower()
    if not _SPACED.search(low):
        return low.split()
    out, at = [], 0
    for run in _SPACED.finditer(low):
        out += low[at:run.start()].split()
        out.append(" ".join(run.group().split()))
        at = run.end()
    return out + low[at:].split()


def restored_text(text: str, model: Letters) -> str:
    """The words of a whole text as the channel's reader sees them, parted by blanks."""
    return " ".join(w for token in tokens(text) for w in words_of(token, model))


def restored_documents(docs: DataFrame, model: Letters) -> DataFrame:
    """doc_id and restored text per row of ``docs``; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "restored": pa.array([restored_text(t, model) for t in batch.column(1).to_pylist()], pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, restored string")


def marks(word: str) -> list[str]:
    """What of a word may have a weight: itself, ended by a dollar sign, and its beginnings."""
    return [word + "$", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


SUMS = 10


def sums(weights: list[float], words: int, kinds: int) -> list[float]:
    """What the regression sees of a text: its highest weights, their sum and number, each beside its length."""
    top = sorted(weights, reverse=True)[:4] + [0.0] * 4
    total, size = sum(weights), np.log1p(words)
    return [*top[:4], np.log1p(total), total / np.sqrt(words + 1), size, len(weights) / (kinds + 5), top[0] * size / 10, top[1] * size / 10]


@dataclass
class Model:
    letters: Letters
    weights: dict[str, float] = field(default_factory=dict)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(SUMS))
    spread: np.ndarray = field(default_factory=lambda: np.ones(SUMS))
    slope: np.ndarray = field(default_factory=lambda: np.zeros(SUMS + 1))

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[np.clip((x - self.mean) / self.spread, -20, 20), np.ones(len(x))] @ self.slope
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Weights:
    """The weight of a word: the greatest of its marks. Most words share no first letters with any mark."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights = weights
        self.starts = {m.removesuffix("$")[:SHORTEST] for m in weights}

    def __call__(self, word: str) -> float:
        return max(self.weights.get(m, 0.0) for m in marks(word)) if word[:SHORTEST] in self.starts else 0.0


class Reader:
    """Scores texts; tokens met before are looked up."""

    def __init__(self, model: Model) -> None:
        self.letters, self.weight, self.known = model.letters, Weights(model.weights), {}

    def token(self, token: str) -> tuple[int, tuple[tuple[str, float], ...]]:
        """How many words a token holds, and those of them that have a weight."""
        if len(self.known) >= HELD:
            self.known.clear()
        words = words_of(token, self.letters)
        found = self.known[token] = (len(words), tuple((w, x) for w in words if (x := self.weight(w)) > 0))
        return found

    def sums(self, text: str) -> list[float]:
        counts = Counter(tokens(text))
        rated, words, known = {}, 0, self.known
        for token, n in counts.items():
            found = known.get(token) or self.token(token)
            words += found[0] * n
            if found[1]:
                rated.update(found[1])
        return sums(list(rated.values()), words, len(counts))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, letters: Letters, max_rows: int) -> DataFrame:
    """y, fold, words (distinct, restored), n (words), kinds (tokens) of the labelled rows that a model may learn from, written once."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("labelled"), (F.col("toxic") > 0).cast("int").alias("y"))
    known = known.filter(~held_out("labelled")).withColumn("fold", (F.crc32(F.col("labelled").cast("string").cast("binary")) % 5).cast("int"))
    part = min(1.0, max_rows / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64(F.lit(31), "labelled"), F.lit(1_000_000)) < int(part * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for batch in batches:
            words, n, kinds = [], [], []
            for text in batch.column("text").to_pylist():
                own, counts = set(), Counter(tokens(text))
                total = 0
                for token, times in counts.items():
                    if (found := cache.get(token)) is None:
                        if len(cache) >= HELD:
                            cache.clear()
                        found = cache[token] = words_of(token, letters)
                    own.update(found)
                    total += times * len(found)
                words.append(sorted(own))
                n.append(total)
                kinds.append(len(counts))
            yield pa.RecordBatch.from_pydict({"y": batch.column("y"), "fold": batch.column("fold"), "words": pa.array(words, pa.list_(pa.string())), "n": n, "kinds": kinds})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("labelled"))
    return materialize(rows.select("text", "y", "fold").mapInArrow(run, "y int, fold int, words array<string>, n long, kinds long"), "toxicity-rows")


def _weights(rows: DataFrame) -> pd.DataFrame:
    """mark, w0 to w4: weights from all rows and without each fold. Tasks count their own rows before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}

        def out(kind: int) -> pa.RecordBatch:
            names, n = counts[kind].keys(), counts[kind].values()
            return pa.RecordBatch.from_pydict({"mark": pa.array(names, pa.string()), "kind": pa.array([kind] * len(names), pa.int32()), "n": pa.array(n, pa.int64())})

        for batch in batches:
            for words, y, fold in zip(batch.column("words").to_pylist(), batch.column("y").to_pylist(), batch.column("fold").to_pylist(), strict=True):
                own = counts.setdefault(2 * fold + y, Counter())
                own.update(set().union([""], *map(marks, words)))  # the empty mark counts rows
                if sum(map(len, counts.values())) >= HELD:
                    yield from map(out, counts)
                    counts.clear()
        yield from map(out, counts)

    split = {f"c{k}": F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)) for k in range(2, 10)}
    counted = rows.select("words", "y", "fold").mapInArrow(run, "mark string, kind int, n long").groupBy("mark").agg(*[v.alias(k) for k, v in split.items()])
    counted = materialize(counted, "toxicity-counts")
    totals = counted.filter("mark = ''").toPandas()
    if not len(totals):
        return pd.DataFrame({"mark": [], **{f"w{f}": [] for f in range(5)}})
    of = {k: int(totals[k].iloc[0]) for k in split}

    def weight(without: int) -> Column:
        folds = [f for f in range(1, 5) if f != without]
        yes, no = (sum((F.col(f"c{2 * f + y}") for f in folds), F.lit(0.0)) for y in (1, 0))
        rows_yes, rows_no = (sum(of[f"c{2 * f + y}"] for f in folds) for y in (1, 0))
        odds = F.log((yes + 0.5) / (rows_yes + 1)) - F.log((no + 0.5) / (rows_no + 1)) - ERRORS * F.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
        return F.when((yes >= LEAST_ROWS) & (odds > LEAST_WEIGHT), odds).otherwise(0.0)

    rated = counted.filter("mark <> ''").select("mark", *[weight(f).alias(f"w{f}") for f in range(5)])
    rated = rated.withColumn("most", F.greatest(*[f"w{f}" for f in range(5)])).filter("most > 0")
    return rated.orderBy(F.desc("most"), "mark").limit(MAX_WEIGHTS).drop("most").toPandas()


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from ``docs`` and ``labels`` (doc_id, toxic).

    Held-out rows (crc32 of the id mod 5 is 0) teach it nothing but characters. Of more than ``max_rows`` labelled rows a seeded
    sample of about that many is taken, a bound of the classifier alone; characters are counted over all documents.
    Labels without an id or a value are left out. Without any usable label every score is 0.5.
    """
    letters = Letters(character_counts(docs))
    rows = _labelled(docs, labels, letters, max_rows)
    table = _weights(rows)
    model = Model(letters, {m: w for m, w in zip(table["mark"], table["w0"], strict=True) if w > 0})
    by_fold = [Weights({})] + [Weights({m: w for m, w in zip(table["mark"], table[f"w{f}"], strict=True) if w > 0}) for f in range(1, 5)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = []
            for r in batch.to_pylist():
                rated = map(by_fold[r["fold"]], r["words"])
                x.append(sums([w for w in rated if w > 0], r["n"], r["kinds"]))
            yield pa.RecordBatch.from_pydict({"y": batch.column("y"), "x": pa.array(x, pa.list_(pa.float64()))})

    seen = rows.mapInArrow(run, "y int, x array<double>").toPandas()  # at most about max_rows rows of SUMS numbers
    if len(seen):
        seen = seen.iloc[np.lexsort(np.stack(seen.x.to_numpy()).T)]  # the order of tasks does not matter
        x, y = np.stack(seen.x.to_numpy()).astype(float), seen.y.to_numpy(float)
        model.mean, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        model.slope = logistic(np.c_[(x - model.mean) / model.spread, np.ones(len(x))], y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last one, of the constant, is not held back."""
    held = np.r_[np.full(x.shape[1] - 1, penalty), 1e-3]
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(held), x.T @ (p - y) + held * b)
        b -= step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return b


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            x = np.array([reader.sums(t) for t in batch.column("text").to_pylist()], float).reshape(-1, SUMS)
            score = model.probability(x)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": score, "predicted": (score >= threshold).astype(np.int32)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held_out().alias("held_out"), "score", "predicted")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Null texts count as empty and have a score like others; a null doc_id is never held out; repeated rows are scored
    each; an empty table gives no row. Texts and tokens may be of any length.
    """
    return score_toxicity(docs, fit(docs, labels), threshold)
