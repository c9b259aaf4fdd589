"""Hard filters, signals and scores of candidates, in the cell of retrieval that found them.

A cell has all documents and, beside the queries, their profiles. What rules and signals read of a posting waits there as
columns of numbers and of word codes, so a list is judged by a few array operations and its pairs are neither shuffled nor
joined. The rules are those of operators/scoring.py, which states them as column expressions for pairs that are rows already;
both agree on every value (tests/test_judging.py). Truth has three values here as well: 1, 0 and -1 for null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit import vocab
from rolefit.operators import scoring
from rolefit.operators.retrieval import _place

TRUE, FALSE, NULL = np.int8(1), np.int8(0), np.int8(-1)
UNKNOWN = np.int8(2)
KEPT_ANSWERS = 32 << 20  # bytes of answers which places name a needle
SCORE_DIGITS = 12        # as scoring.total_score()

# What a rule or signal reads of a posting: made once per posting by Spark, from the columns of scoring.prepare_postings().
FIELDS: dict[str, Callable[[], Column]] = {
    "salary": lambda: F.col("salary_value"),
    "level": lambda: F.col("j_level"),
    "years": lambda: F.coalesce("years_required", F.lit(0)),
    "contract": lambda: F.coalesce("is_contract", F.lit(False)),
    "defense": lambda: F.coalesce("is_defense", F.lit(False)),
    "sponsors": lambda: F.col("sponsors_visa"),
    "small": lambda: F.coalesce(F.col("company_size") == "small", F.lit(False)),
    "size": scoring.sig_company_size,
    "in_us": scoring.in_us,
    "remote": lambda: F.contains(F.col("j_location"), F.lit("remote")),
    "place": lambda: F.col("j_location_marked"),
    "title": lambda: F.col("j_title_tokens"),
    "skills": lambda: F.col("skills"),
}


class _Words:
    """Lists of words as codes: which words each document has, each once."""

    def __init__(self):
        self.codes: dict[str | None, int] = {}
        self.words, self.counts, self.nulls = [], [], []

    def add(self, column: pa.ListArray) -> None:
        flat = column.flatten().dictionary_encode(null_encoding="encode")
        codes = np.array([self.codes.setdefault(w, len(self.codes)) for w in flat.dictionary.to_pylist()], "int64")
        owner = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        pairs = np.unique((owner << 32) | codes[flat.indices.to_numpy(zero_copy_only=False)])
        self.words.append((pairs & 0xFFFFFFFF).astype("int32"))
        self.counts.append(np.bincount(pairs >> 32, minlength=len(column)))
        self.nulls.append(column.is_null().to_numpy(zero_copy_only=False))

    def close(self) -> None:
        self.words, self.counts, self.nulls = (np.concatenate(x) for x in (self.words, self.counts, self.nulls))
        self.start = np.cumsum(self.counts) - self.counts
        self.weight = np.zeros(len(self.codes), "int64")

    def shared(self, words: list[str | None], of: _Chosen) -> np.ndarray:
        """How many of ``words`` each document has, as often as they are listed."""
        codes = [self.codes[w] for w in words if w in self.codes]
        for code in codes:
            self.weight[code] += 1
        hits = np.bincount(of.owner, self.weight[of.words], len(of.cols)).astype("int64")
        self.weight[codes] = 0
        return hits


class _Chosen:
    """The words of some documents."""

    def __init__(self, table: _Words, cols: np.ndarray):
        counts = table.counts[cols]
        self.cols, self.owner = cols, np.repeat(np.arange(len(cols)), counts)
        at = np.arange(len(self.owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(table.start[cols], counts)
        self.words = table.words[at]


class _Places:
    """Marked locations as codes, and which of them name a needle, looked up when it is first asked."""

    def __init__(self):
        self.codes: dict[str | None, int] = {}
        self.of, self.known = [], {}

    def add(self, column: pa.StringArray) -> None:
        coded = column.dictionary_encode(null_encoding="encode")
        codes = np.array([self.codes.setdefault(w, len(self.codes)) for w in coded.dictionary.to_pylist()], "int32")
        self.of.append(codes[coded.indices.to_numpy(zero_copy_only=False)])

    def close(self) -> None:
        self.of, self.texts = np.concatenate(self.of), list(self.codes)

    def names_any(self, needles: list[str | None], cols: np.ndarray) -> np.ndarray:
        out, at = np.full(len(cols), FALSE), self.of[cols]
        for needle in needles:
            out = either(out, self._names(needle, at))
        return out

    def _names(self, needle: str | None, at: np.ndarray) -> np.ndarray:
        if needle is None:
            return np.full(len(at), NULL)
        if needle not in self.known:
            if len(self.known) * len(self.texts) > KEPT_ANSWERS:
                self.known = {}
            self.known[needle] = np.full(len(self.texts), UNKNOWN)
        answers = self.known[needle]
        for code in np.unique(at[answers[at] == UNKNOWN]):
            text = self.texts[code]
            answers[code] = NULL if text is None else TRUE if needle in text else FALSE
        return answers[at]


def either(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where((a == TRUE) | (b == TRUE), TRUE, np.where((a == NULL) | (b == NULL), NULL, FALSE))


def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where((a == FALSE) | (b == FALSE), FALSE, np.where((a == NULL) | (b == NULL), NULL, TRUE))


def truth(value: bool | None) -> np.int8:
    return NULL if value is None else np.int8(value)


class Postings:
    """The documents of a cell, a column per field; absent are those that have a vector and no posting."""

    def __init__(self, fields: list[str]):
        self.fields, self.parts = fields, {f: [] for f in [*fields, "present"]}
        self.words = {f: _Words() for f in ("title", "skills") if f in fields}
        self.places = _Places() if "place" in fields else None

    def add(self, loads: pa.StructArray) -> None:
        self.parts["present"].append(loads.is_valid().to_numpy(zero_copy_only=False))
        columns = dict(zip([f.name for f in loads.type], loads.flatten()))
        for field in self.fields:
            column = columns[field]
            if field in self.words:
                self.words[field].add(column)
            elif field == "place":
                self.places.add(column)
            elif pa.types.is_boolean(column.type):
                self.parts[field].append(column.cast("int8").fill_null(int(NULL)).to_numpy(zero_copy_only=False))
            elif field == "salary":
                self.parts[field].append(column.fill_null(0.0).to_numpy(zero_copy_only=False))
                self.parts.setdefault("unpaid", []).append(column.is_null().to_numpy(zero_copy_only=False))
            else:
                self.parts[field].append(column.fill_null(0).to_numpy(zero_copy_only=False))

    def close(self) -> None:
        for table in self.words.values():
            table.close()
        if self.places:
            self.places.close()
        self.columns = {f: np.concatenate(x) for f, x in self.parts.items() if x}
        self.whole, self.parts = bool(self.columns["present"].all()), {}


class Pairs:
    """One profile beside some postings of the cell."""

    def __init__(self, profile: dict, postings: Postings, cols: np.ndarray, similarity: np.ndarray):
        self.p, self.postings, self.cols, self.similarity = profile, postings, cols, similarity
        self.chosen: dict[str, _Chosen] = {}

    def of(self, field: str) -> np.ndarray:
        return self.postings.columns[field][self.cols]

    def all(self, value) -> np.ndarray:
        return np.full(len(self.cols), value)

    def words(self, field: str) -> _Chosen:
        if field not in self.chosen:
            self.chosen[field] = _Chosen(self.postings.words[field], self.cols)
        return self.chosen[field]

    def shared(self, field: str, words: list[str | None]) -> np.ndarray:
        return self.postings.words[field].shared(words, self.words(field))

    def names_any(self, needles: str) -> np.ndarray:
        return self.postings.places.names_any(self.p[needles], self.cols)

    def pays(self) -> np.ndarray:
        value = self.of("salary")
        return np.isnan(value) | (value >= self.p["p_min_salary"])  # as in Spark, NaN exceeds every number


# --- hard filters, see scoring.passes_*() ---------------------------------------------------

def f_salary(x: Pairs) -> np.ndarray:
    return x.all(TRUE) if x.p["p_min_salary"] == 0 else (x.of("unpaid") | x.pays()).astype("int8")


def f_contract(x: Pairs) -> np.ndarray:
    return 1 - x.of("contract") if x.p["p_no_contract"] else x.all(TRUE)


def f_seniority(x: Pairs) -> np.ndarray:
    level, cap, floor = x.of("level"), x.p["p_cap"], x.p["p_floor"]
    fits = x.all(True) if cap is None else level <= cap
    return (fits if floor is None else fits & (level >= floor)).astype("int8")


def f_years(x: Pairs) -> np.ndarray:
    cap = x.p["p_max_years"]
    return x.all(TRUE) if cap is None else (x.of("years") <= cap).astype("int8")


def f_industry(x: Pairs) -> np.ndarray:
    refused = x.p["p_no_defense"]
    return x.all(TRUE) if refused is False else np.where(x.of("defense") == TRUE, NULL if refused is None else FALSE, TRUE)


def f_visa(x: Pairs) -> np.ndarray:
    return (x.of("sponsors") != FALSE).astype("int8") if x.p["p_needs_visa"] else x.all(TRUE)


def f_company_size(x: Pairs) -> np.ndarray:
    return 1 - x.of("small") if x.p["p_min_size"] == "large" else x.all(TRUE)


def f_us_only(x: Pairs) -> np.ndarray:
    return x.of("in_us") if x.p["p_us_only"] else x.all(TRUE)


def f_locations(x: Pairs) -> np.ndarray:
    if not x.p["p_locations"]:
        return x.all(TRUE)
    return either(both(x.all(truth(x.p["p_remote_ok"])), x.of("remote")), x.names_any("p_locations"))


# --- signals, see scoring.sig_*() -----------------------------------------------------------

def sig_similarity(x: Pairs) -> np.ndarray:
    return x.similarity


def n_overlap(x: Pairs) -> np.ndarray:
    return x.shared("skills", list(dict.fromkeys(x.p["p_skills"])))


def sig_skills(x: Pairs) -> np.ndarray:
    return np.where(x.postings.words["skills"].nulls[x.cols], np.nan, n_overlap(x) / max(1, len(x.p["p_skills"])))


def sig_title(x: Pairs) -> np.ndarray:
    best = x.all(0.0)
    for tokens in x.p["p_role_tokens"]:
        best = np.maximum(best, x.shared("title", tokens) / max(1, len(tokens)))
    return best


def sig_salary(x: Pairs) -> np.ndarray:
    if x.p["p_min_salary"] == 0:
        return x.all(0.5)
    return np.where(x.of("unpaid"), 0.5, np.where(x.pays(), 1.0, 0.0))


def sig_seniority(x: Pairs) -> np.ndarray:
    if x.p["p_cap"] is not None:
        return (x.of("level") <= x.p["p_cap"]).astype("float64")
    return x.all(0.5) if x.p["p_floor"] is None else (x.of("level") >= x.p["p_floor"]).astype("float64")


def sig_location(x: Pairs) -> np.ndarray:
    if not x.p["p_preferred"]:
        return x.all(0.5)
    preferred = either(both(x.all(truth(x.p["p_remote_preferred"])), x.of("remote")), x.names_any("p_preferred"))
    return np.where(preferred == TRUE, 1.0, 0.3)


def sig_experience(x: Pairs) -> np.ndarray:
    cap = x.p["p_max_years"]
    if cap is None:
        return x.all(0.5)
    years = x.of("years")
    return np.where(years > cap, 0.0, 1.0 - 0.5 * (years / float(max(1, cap))))


def sig_company_size(x: Pairs) -> np.ndarray:
    return x.of("size")


@dataclass(frozen=True)
class Rule:
    judge: Callable[[Pairs], np.ndarray]
    posting: tuple[str, ...]
    profile: tuple[str, ...]


HARD_FILTERS = {
    "f_salary": Rule(f_salary, ("salary",), ("p_min_salary",)), "f_contract": Rule(f_contract, ("contract",), ("p_no_contract",)),
    "f_seniority": Rule(f_seniority, ("level",), ("p_cap", "p_floor")), "f_years": Rule(f_years, ("years",), ("p_max_years",)),
    "f_industry": Rule(f_industry, ("defense",), ("p_no_defense",)), "f_visa": Rule(f_visa, ("sponsors",), ("p_needs_visa",)),
    "f_company_size": Rule(f_company_size, ("small",), ("p_min_size",)), "f_us_only": Rule(f_us_only, ("in_us",), ("p_us_only",)),
    "f_locations": Rule(f_locations, ("remote", "place"), ("p_remote_ok", "p_locations")),
}
SIGNALS = {
    "similarity": Rule(sig_similarity, (), ()), "skills": Rule(sig_skills, ("skills",), ("p_skills",)),
    "title": Rule(sig_title, ("title",), ("p_role_tokens",)), "salary": Rule(sig_salary, ("salary",), ("p_min_salary",)),
    "seniority": Rule(sig_seniority, ("level",), ("p_cap", "p_floor")),
    "location": Rule(sig_location, ("remote", "place"), ("p_remote_preferred", "p_preferred")),
    "experience": Rule(sig_experience, ("years",), ("p_max_years",)), "company_size": Rule(sig_company_size, ("size",), ()),
}


def half_up(values: np.ndarray) -> np.ndarray:
    """As Spark rounds: the shortest decimal of a number, halves away from zero. Numbers near a half go that way one by one."""
    unit = 10.0**SCORE_DIGITS
    with np.errstate(invalid="ignore"):
        out = np.rint(values * unit) / unit
        near = np.flatnonzero(np.abs(np.abs(values * unit - np.floor(values * unit)) - 0.5) < 0.01)
    digit = Decimal(1).scaleb(-SCORE_DIGITS)
    out[near] = [float(Decimal(repr(v)).quantize(digit, ROUND_HALF_UP)) for v in values[near].tolist()]
    return out


@dataclass(frozen=True)
class Judgement:
    """What is asked of the lists. It is the judge that retrieval.topk() takes.

    ``rules`` and ``signals`` come out as a column each, of every pair; ``overlap`` adds the skills on both sides (n_overlap) and
    the posting's (n_job). ``kept`` leaves the survivors of all hard filters and of what a profile excludes, ``scored`` adds
    breakdown and score, ``best`` leaves so many rows of a profile, by score and id. ``counted`` gives a row per profile instead.
    """

    rules: tuple[str, ...] = ()
    signals: tuple[str, ...] = ()
    overlap: bool = False
    kept: bool = False
    excluded: bool = False
    scored: bool = False
    best: int | None = None
    counted: bool = False

    def _read(self) -> Iterator[Rule]:
        yield from (HARD_FILTERS[f] for f in (HARD_FILTERS if self.kept or self.counted else self.rules))
        yield from (SIGNALS[s] for s in (SIGNALS if self.scored else self.signals))
        if self.overlap:
            yield SIGNALS["skills"]

    def posting_fields(self) -> list[str]:
        return [f for f in FIELDS if any(f in rule.posting for rule in self._read())]

    def profile_fields(self) -> list[str]:
        return sorted({f for rule in self._read() for f in rule.profile} | ({"p_weights"} if self.scored else set()))

    def posting_load(self) -> Column:
        fields = [FIELDS[f]().alias(f) for f in self.posting_fields()]
        return F.struct(*fields) if fields else F.struct(F.lit(True).alias("posting"))

    def profile_load(self, people: str) -> Column:
        """Of the rows of a profile, an array of structs; what it excludes waits beside them."""
        fields = self.profile_fields()
        return F.transform(people, lambda p: F.struct(*[p[f].alias(f) for f in fields]) if fields else F.struct(F.lit(True).alias("profile")))

    def columns(self, query_type: str, doc_type: str) -> str:
        if self.counted:
            return f"profile_id {query_type}, n_candidates bigint, n_after_filter bigint"
        out = [f"profile_id {query_type}", f"job_id {doc_type}", "similarity double", "candidate_rank int", "p_copy int"]
        out += [f"{f} boolean" for f in self.rules] + [f"sig_{s} double" for s in self.signals]
        out += ["n_overlap int", "n_job int"] if self.overlap else []
        out += [f"breakdown struct<{', '.join(f'{s}:double' for s in vocab.SIGNALS)}>", "score double"] if self.scored else []
        return ", ".join(out)

    def seat(self) -> _Seat:
        return _Seat(self)


def _numbers(values: np.ndarray) -> pa.Array:
    """A null where there is no number."""
    return pa.array(values, mask=np.isnan(values))


class _Seat:
    def __init__(self, asked: Judgement):
        self.asked, self.postings, self.closed = asked, Postings(asked.posting_fields()), False

    def add(self, loads: pa.Array) -> None:
        self.postings.add(loads)

    def rows(self, names: pa.Array, loads: pa.Array, docs: pa.Array, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        if not self.closed:
            self.postings.close()
            self.closed = True
        ends = np.searchsorted(rows, np.arange(len(names) + 1))
        lists = [(row, slice(a, b)) for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a]
        if self.asked.counted:
            return self._counts(names, loads, docs, lists, cols, values)
        ranks, found = _place(rows) + 1, []
        people, barred = loads.field("people"), loads.field("excluded") if self.asked.excluded else None
        for row, part in lists:
            mine = [self._judged(profile, n, self._left(docs, barred[row].as_py(), cols[part]) if self.asked.excluded else None,
                                 cols[part], values[part], ranks[part])
                    for n, profile in enumerate(people[row].as_py() or [])]
            if mine:
                found.append(self._best({"row": [np.full(len(x["cols"]), row) for x in mine]} | {c: [x[c] for x in mine] for c in mine[0]}))
        return self._batch(names, docs, found)

    @staticmethod
    def _left(docs: pa.Array, barred: list[str] | None, cols: np.ndarray) -> np.ndarray | None:
        if not barred:
            return None
        return ~pa.compute.is_in(docs.take(pa.array(cols)), pa.array(barred, docs.type)).to_numpy(zero_copy_only=False)

    def _judged(self, profile: dict, n: int, left: np.ndarray | None, cols: np.ndarray, values: np.ndarray, ranks: np.ndarray) -> dict[str, np.ndarray]:
        asked, stay = self.asked, left
        if not self.postings.whole:
            present = self.postings.columns["present"][cols]
            stay = present if stay is None else stay & present
        if stay is not None:
            cols, values, ranks = cols[stay], values[stay], ranks[stay]
        if asked.kept:
            stay = self._passes(profile, cols, values)
            cols, values, ranks = cols[stay], values[stay], ranks[stay]
        pairs = Pairs(profile, self.postings, cols, values)
        out = {"cols": cols, "similarity": values, "candidate_rank": ranks, "p_copy": np.full(len(cols), n + 1)}
        out |= {f: HARD_FILTERS[f].judge(pairs) for f in asked.rules}
        out |= {f"sig_{s}": SIGNALS[s].judge(pairs) for s in asked.signals}
        if asked.overlap:
            out |= {"n_overlap": n_overlap(pairs), "n_job": self.postings.words["skills"].counts[cols], "no_skills": self.postings.words["skills"].nulls[cols]}
        if asked.scored:
            parts, total = {s: SIGNALS[s].judge(pairs) for s in vocab.SIGNALS}, np.zeros(len(cols))
            for s in vocab.SIGNALS:
                total = total + profile["p_weights"][s] * parts[s]
            out |= parts | {"score": half_up(total)}
        return out

    def _passes(self, profile: dict, cols: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Which pairs pass every hard filter; each is asked about those that passed the ones before it."""
        left = np.arange(len(cols))
        for rule in HARD_FILTERS.values():
            left = left[rule.judge(Pairs(profile, self.postings, cols[left], values[left])) == TRUE]
        return left

    def _best(self, found: dict[str, list[np.ndarray]]) -> dict[str, np.ndarray]:
        """The rows of one profile, cut to the best; nulls come last, equal scores by id."""
        out = {c: x[0] if len(x) == 1 else np.concatenate(x) for c, x in found.items()}
        if self.asked.best is None or len(out["cols"]) <= self.asked.best:
            return out
        order = np.lexsort((out["cols"], -out["score"]))[:self.asked.best]
        return {c: x[order] for c, x in out.items()}

    def _counts(self, names: pa.Array, loads: pa.Array, docs: pa.Array, lists: list, cols: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        passed = []
        for row, part in lists:
            here = slice(None) if self.postings.whole else self.postings.columns["present"][cols[part]]
            passed.append(sum(len(self._passes(p, cols[part][here], values[part][here])) for p in loads.field("people")[row].as_py() or []))
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array([row for row, _ in lists], pa.int64())), pa.array([part.stop - part.start for _, part in lists], pa.int64()), pa.array(passed, pa.int64())],
            names=["profile_id", "n_candidates", "n_after_filter"])

    def _batch(self, names: pa.Array, docs: pa.Array, found: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        asked = self.asked

        def column(name: str, kind: str) -> np.ndarray:
            return np.concatenate([x[name] for x in found]).astype(kind) if found else np.empty(0, kind)

        out = {"profile_id": names.take(pa.array(column("row", "int64"))), "job_id": docs.take(pa.array(column("cols", "int64"))),
               "similarity": pa.array(column("similarity", "float64"))}
        out |= {c: pa.array(column(c, "int32")) for c in ("candidate_rank", "p_copy")}
        for f in asked.rules:
            answer = column(f, "int8")
            out[f] = pa.array(answer == TRUE, mask=answer == NULL)
        out |= {f"sig_{s}": _numbers(column(f"sig_{s}", "float64")) for s in asked.signals}
        if asked.overlap:
            out |= {c: pa.array(column(c, "int32"), mask=column("no_skills", "bool")) for c in ("n_overlap", "n_job")}
        if asked.scored:
            out["breakdown"] = pa.StructArray.from_arrays([_numbers(column(s, "float64")) for s in vocab.SIGNALS], vocab.SIGNALS)
            out["score"] = _numbers(column("score", "float64"))
        return pa.RecordBatch.from_pydict(out)
