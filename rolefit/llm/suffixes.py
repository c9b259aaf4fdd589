"""Exact repeats of long byte strings, by a sparse suffix array ordered by hashes.

Of every window of LENGTH bytes the suffix at its anchor stands for it: the start of the least gram in the window, so
that equal windows have their anchors at equal places. About one byte in 170 is an anchor. Anchored suffixes are
partitioned by ranges of their leading tokens at sampled splitters, sorted in their ranges and compared with their
neighbours, also across boundaries; a suffix whose leading tokens occur nowhere else stands for no repeat. Where all
windows of an anchor occur with the same bytes elsewhere, all are repeats at once. Windows of the other anchors are
compared one by one, among anchors of the same leading tokens. Beyond the first 8 bytes the order is that of two 64-bit
hashes, of the gram and of its surroundings: neighbours are tested for equal hashes, not for common prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, numbered, tasks, text_or_empty

#: Bytes of a repeat, bytes of an anchor's leading tokens.
LENGTH, GRAM = 400, 64
#: Window starts that are looked at together.
BLOCK = 2**20 - 1024
#: Different surroundings of one anchor that a task compares; more are compared by a shuffle of their windows.
TOGETHER = 8_192
_TABLE = np.random.default_rng(77).integers(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = 1 << max(12, (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(p)
    return held[:n]


def gram_values(raw: np.ndarray, gram: int) -> np.ndarray:
    """A rolling hash of every ``gram`` bytes; equal bytes, equal values."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * _powers(_BASE, len(raw)), out=total[1:])
    value = (total[gram:] - total[:-gram]) * _powers(_INVERSE, len(raw) - gram + 1)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(v)] = v
    rows = padded.reshape(-1, width)
    after = np.minimum.accumulate(rows, axis=1).ravel()
    before = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:n], after[width - 1:width - 1 + n])


def cells(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first and last window start: runs of windows of ``length`` bytes with the same anchor.

    A window's anchor is the start in it of the least gram, leftmost of equals: equal windows have it at the same place.
    """
    out = []
    mask = np.uint64(2**20 - 1)
    for at in range(0, len(raw) - length + 1, BLOCK):
        part = raw[at:at + BLOCK + length - 1]
        value = gram_values(part, gram)
        least = _sliding_min((value & ~mask) | np.arange(len(value), dtype=np.uint64), length - gram + 1) & mask
        start = np.r_[0, np.flatnonzero(np.diff(least)) + 1]
        out.append((least[start].astype(np.int64) + at, start + at, np.r_[start[1:], len(least)] - 1 + at))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _text_bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes()


def _anchors(length: int, gram: int):
    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, a, lo, hi, lead, g, u = [], [], [], [], [], [], []
            for row_id, text in zip(batch.column("row_id").to_pylist(), batch.column("text"), strict=True):
                raw = _text_bytes(text)
                if len(raw) < length:
                    continue
                found = cells(np.frombuffer(raw, np.uint8), length, gram)
                at, first, last = (x.tolist() for x in found)
                rows.append(np.full(len(at), row_id, np.int64))
                a.append(found[0]), lo.append(found[1]), hi.append(found[2])
                lead += [raw[i:i + 8] for i in at]
                g += [digest(raw[i:i + gram]) for i in at]
                u += [digest(raw[j:k + length], seed=i - j) for i, j, k in zip(at, first, last, strict=True)]
            if rows:
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                tokens = np.frombuffer(b"".join(lead), ">u8").astype(np.uint64)
                yield pa.RecordBatch.from_pydict({"row_id": pa.array(np.concatenate(rows)), "a": pa.array(np.concatenate(a)), "lo": pa.array(np.concatenate(lo)), "hi": pa.array(np.concatenate(hi)),
                                                  "lead": pa.array((tokens ^ np.uint64(2**63)).view(np.int64)), "g": signed(g), "u": signed(u)})

    return run


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range whose leading tokens a neighbour shares, rows that stand for copies, and both ends of the range.

    The ends are kept for the ranges beside this one: their rows are counted together afterwards.
    """
    held, before = None, None
    for batch in batches:
        if not len(batch):
            continue
        table = batch if held is None else pa.concat_batches([held, batch])
        g, keep = table.column("g").to_numpy(), table.column("c").to_numpy() > 1
        same = g[1:] == g[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= before is None or bool(g[0] == before)
        yield table.slice(0, len(g) - 1).filter(pa.array(keep[:-1]))
        before = g[-2] if len(g) > 1 else before
        held = table.slice(len(g) - 1)
    if held is not None:
        yield held


def _contexts(length: int):
    """The bytes of all windows of an anchor, cut out of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, raws = [], []
            for text, probes in zip(batch.column("text"), batch.column("probes").to_pylist(), strict=True):
                raw = _text_bytes(text)
                for p in probes:
                    out.append(p)
                    raws.append(raw[p["lo"]:p["hi"] + length])
            if out:
                table = pa.RecordBatch.from_pylist(out)
                kinds = {"row_id": pa.int64(), "a": pa.int64(), "lo": pa.int64(), "hi": pa.int64(), "g": pa.int64(), "c": pa.int64(), "big": pa.bool_()}
                yield pa.RecordBatch.from_pydict({k: table.column(k).cast(v) for k, v in kinds.items()} | {"raw": pa.array(raws, pa.binary())})

    return run


def _window_values(raws: list[bytes], g: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window of each context: the context's place, the window's offset in it, a hash of its bytes and of g."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    value = gram_values(np.frombuffer(b"".join(raws), np.uint8), length)
    n = sizes - length + 1
    of = np.repeat(np.arange(len(raws)), n)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(np.cumsum(sizes) - sizes, n) + offset
    return of, offset, value[start] ^ (g.astype(np.int64).view(np.uint64)[of] * np.uint64(_INVERSE))


def _runs(of: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring offsets of one context joined: context, first, last. Input in order."""
    if not len(of):
        return of, offset, offset
    start = np.r_[0, np.flatnonzero((np.diff(of) != 0) | (np.diff(offset) != 1)) + 1]
    return of[start], offset[start], offset[np.r_[start[1:], len(of)] - 1]


def _compare_windows(length: int):
    """Ranges of windows that another context of the same anchor holds too; input sorted by g."""

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        raws = table.column("raw").to_pylist()
        row_id, lo, c, g = (table.column(k).to_numpy() for k in ("row_id", "lo", "c", "g"))
        of, offset, value = _window_values(raws, g, length)
        _, at, count = np.unique(value, return_inverse=True, return_counts=True)
        again = (count[at] > 1) & (c[of] == 1)
        of, first, last = _runs(of[again], offset[again])
        return pa.RecordBatch.from_pydict({"row_id": pa.array(row_id[of]), "from": pa.array(lo[of] + first), "to": pa.array(lo[of] + last + length)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            g = batch.column("g").to_numpy()
            cut = int(np.searchsorted(g, g[-1]))  # the last anchor may go on
            if cut:
                yield compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compare(pa.Table.from_batches(held))

    return run


def _list_windows(length: int):
    """A row per window of the contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                row_id, lo, c, g = (part.column(k).to_numpy() for k in ("row_id", "lo", "c", "g"))
                of, offset, value = _window_values(part.column("raw").to_pylist(), g, length)
                yield pa.RecordBatch.from_pydict({"row_id": pa.array(row_id[of]), "start": pa.array(lo[of] + offset), "c": pa.array(c[of]), "value": pa.array(value.view(np.int64)), "g": pa.array(g[of])})

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of what is left of each text once the union of its ranges is removed."""
    for batch in batches:
        n, removed, spans, digests = [], [], [], []
        for text, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist(), strict=True):
            raw = _text_bytes(text)
            runs = merged(ranges or [])
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            n.append(len(raw)), removed.append(sum(b - a for a, b in runs)), spans.append(len(runs))
            digests.append(hashlib.sha256(b"".join(kept)).hexdigest())
        count = lambda x: pa.array(x, pa.int64())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": count(n), "n_removed": count(removed), "n_spans": count(spans), "kept_sha256": pa.array(digests, pa.string())})


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """The union of ranges as runs that neither overlap nor touch."""
    out: list[list[int]] = []
    for r in sorted((r["from"], r["to"]) for r in ranges):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [tuple(x) for x in out]


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, together: int = TOGETHER) -> DataFrame:
    """row_id, from, to: byte ranges that windows of ``length`` bytes found at two or more places cover; they may overlap.

    ``texts`` has row_id (unique) and text (no nulls). Windows do not cross texts. No anchor is dropped for having many
    places: copies of the same surroundings are one row with a count, and anchors with more than ``together`` different
    surroundings have their windows compared by a shuffle.
    """
    n = tasks(texts.sparkSession)
    places = materialize(texts.mapInArrow(_anchors(length, gram), "row_id long, a long, lo long, hi long, lead long, g long, u long"), "suffix-places")
    suffixes = places.groupBy("lead", "g", "u").agg(F.count("*").alias("c"), F.min(F.struct("row_id", "a", "lo", "hi")).alias("one"))
    suffixes = suffixes.select("lead", "g", "u", "c", "one.*").repartitionByRange(n, "lead", "g", "u").sortWithinPartitions("lead", "g", "u")
    shared = materialize(suffixes.mapInArrow(_compare_neighbours, "lead long, g long, u long, c long, row_id long, a long, lo long, hi long"), "suffix-shared")
    copies = shared.filter("c > 1").select("g", "u")
    whole = places.join(copies, ["g", "u"]).select("row_id", F.col("lo").alias("from"), (F.col("hi") + length).alias("to"))
    groups = materialize(shared.groupBy("g").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("single")).filter("kinds > 1 AND single > 0").select("g", "kinds"), "suffix-groups")
    probes = shared.join(groups, "g").select("row_id", F.struct("row_id", "a", "lo", "hi", "g", "c", (F.col("kinds") > together).alias("big")).alias("p"))
    by_text = probes.groupBy("row_id").agg(F.collect_list("p").alias("probes"))  # at most the anchors of one text
    contexts = texts.join(by_text, "row_id").select("text", "probes").mapInArrow(_contexts(length), "row_id long, a long, lo long, hi long, g long, c long, big boolean, raw binary")
    contexts = materialize(contexts, "suffix-contexts")
    few = contexts.filter("NOT big").repartition(n, "g").sortWithinPartitions("g").mapInArrow(_compare_windows(length), "row_id long, `from` long, `to` long")
    windows = contexts.filter("big").mapInArrow(_list_windows(length), "row_id long, start long, c long, value long, g long")
    windows = materialize(windows, "suffix-windows")
    again = materialize(windows.groupBy("value", "g").agg(F.sum("c").alias("n")).filter("n > 1").select("value", "g"), "suffix-windows-again")
    many = windows.filter("c = 1").join(again, ["value", "g"]).groupBy("row_id").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    joined = """aggregate(starts, cast(array() AS array<struct<from:bigint,to:bigint>>), (acc, s) -> if(size(acc) > 0 AND element_at(acc, -1).to >= s + {0} - 1,
        concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).from AS from, s + {0} AS to))), concat(acc, array(struct(s AS from, s + {0} AS to)))))""".format(length)
    many = many.select("row_id", F.inline(F.expr(joined)))
    return whole.unionByName(few).unionByName(many)


def without_repeats(docs: DataFrame, length: int = LENGTH, together: int = TOGETHER) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed, in the first of equal
    places as well. Null texts are empty; repeated rows are repeats of one another; texts shorter than ``length`` stay.
    """
    texts = numbered(docs.select("doc_id", "text"), "suffix-texts").select("row_id", "doc.doc_id", text_or_empty("doc.text").alias("text"))
    ranges = repeated_ranges(texts.select("row_id", "text"), length, together=together)
    by_text = materialize(ranges.groupBy("row_id").agg(F.collect_list(F.struct("from", "to")).alias("ranges")), "suffix-ranges")  # at most the anchors of one text
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.join(by_text, "row_id", "left").select("doc_id", "text", "ranges").mapInArrow(_cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
