"""Near duplicates by MinHash: one-permutation hashing with optimal densification, banded buckets, star edges.

A text's set of word shingles is hashed once; each of BANDS * ROWS bins keeps the least hash that falls in it, an
empty bin borrows from a bin found by universal hashing of (bin, attempt). Texts with equal rows in a band share a
bucket. In a bucket every member is compared with its hub only, the least document: a star. Where that leaves a
bucket with members that are not connected, all of its pairs are compared inside of tasks, block by block, by
products of their sets: no row is made per pair, and no pair of a bucket is lost. Links are confirmed on full shingle
sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, numbered, text_or_empty
from rolefit.llm.components import components

#: A pair of similarity s shares no bucket with probability (1 - s**ROWS)**BANDS: 6e-9 at 0.85.
BANDS, ROWS = 40, 6
SHINGLE = 5
#: Members of a bucket that a task compares with as many, and their elements; elements that are counted together.
BLOCK, BLOCK_ELEMENTS, COLUMNS = 512, 2**20, 2**11
#: Bits of the bitmap of wanted ids: 4 MB.
BITMAP = 2**25
_BINS = BANDS * ROWS
_PROBES = np.random.default_rng(101).integers(0, _BINS, (_BINS, 512))


def shingle_set(text: str, words: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of fewer words one, of none none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII blanks only
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    end = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    start = np.r_[0, end[:-1] + 1]
    if len(parts) > words:
        start, end = start[:len(parts) - words + 1], end[words - 1:]
    else:
        start, end = start[:1], end[-1:]
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)], np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of every bin of a non-empty sorted set."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(_BINS) >> np.uint64(32)).astype(np.int64)
    own, first = np.unique(bins, return_index=True)
    value, filled = np.zeros(_BINS, np.uint64), np.zeros(_BINS, bool)
    value[own], filled[own] = hashes[first], True
    empty, sparse = np.flatnonzero(~filled), value.copy()
    for at in range(0, _PROBES.shape[1], 16):
        if not len(empty):
            break
        hit = filled[_PROBES[empty, at:at + 16]]
        found = hit.any(axis=1)
        done = empty[found]
        value[done] = sparse[_PROBES[done, at + hit[found].argmax(axis=1)]]
        empty = empty[~found]
    for j in empty:  # very small sets, after many attempts: the next filled bin
        value[j] = sparse[own[np.searchsorted(own, j) % len(own)]]
    return value


def _bands(hashes: np.ndarray) -> list[int]:
    raw, size = signature(hashes).tobytes(), 8 * ROWS
    digest = xxhash.xxh3_64_intdigest
    return [digest(raw[i * size:(i + 1) * size], seed=i) for i in range(BANDS)]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, hi, lo, bands = [], [], [], []
        for text in batch.column("text"):
            hashes = shingle_set(text.as_py())
            n.append(len(hashes))
            both = xxhash.xxh3_128_intdigest(hashes.tobytes())
            hi.append(both >> 64)
            lo.append(both & (2**64 - 1))
            bands.append(_bands(hashes) if len(hashes) else [])
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        flat = np.array([b for x in bands for b in x], np.uint64).view(np.int64)
        offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"row_id": batch.column("row_id"), "doc_id": batch.column("doc_id"), "n_shingles": pa.array(n, pa.int64()), "hi": signed(hi), "lo": signed(lo),
                                          "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"v": batch.column("doc_id"), "hashes": pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column("text")], pa.binary())})


def _compare(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_compare(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each of the sets ``left`` shares with each of ``right``: products of some columns at a time."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(flat)
    new = np.r_[True, flat[order[1:]] != flat[order[:-1]]]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = np.cumsum(new[often]) - 1, owner[order[often]]
    out = np.zeros((len(left), len(right)))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [lo, lo + COLUMNS]))
        has = np.zeros((len(sets), int(column[part][-1]) - lo + 1), np.float32)
        has[owner[part], column[part] - lo] = 1
        out += has[left] @ has[right].T
    return out


def _connecting(one: np.ndarray, two: np.ndarray) -> list[int]:
    """Places of pairs that connect what the pairs before them left apart."""
    root, kept = {}, []

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for n, (x, y) in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            kept.append(n)
    return kept


def _cell_links(percent: int):
    """Over a cell of a bucket: links between its two blocks, as many as connect the roots that are linked there."""
    def run(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
        v, root, block = (cell.column(c).to_numpy() for c in ("v", "root", "block"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cell.column("hashes")]
        left, right = (np.flatnonzero(block == x.as_py()) for x in key[1:])
        shared, size = _shared(sets, left, right), np.array(list(map(len, sets)))
        x, y = np.nonzero((100 * shared >= percent * (size[left][:, None] + size[right] - shared)) & (root[left][:, None] != root[right]))
        x, y = left[x], right[y]
        kept = _connecting(root[x], root[y])
        return pa.table({"a": v[x[kept]], "b": v[y[kept]]})

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and their sets x, y. A hub of many members is a skewed key of a plain join of two exchanges."""
    of = lambda v, h: sets.select(F.col("v").alias(v), F.col("hashes").alias(h))
    return pairs.join(of("b", "y"), "b").join(of("a", "x"), "a").select("a", "b", "x", "y")


def _linked(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """v, root: classes by the least class that they are connected with, but for roots."""
    rows = classes.select("v", "n", F.explode("bands").alias("band"))
    hubs = materialize(rows.groupBy("band").agg(F.min("v").alias("a"), F.count("*").alias("size")).filter("size > 1"), "minhash-hubs")
    members = materialize(rows.join(hubs, "band"), "minhash-members")
    stars = materialize(members.filter("v <> a").select("a", F.col("v").alias("b")).distinct(), "minhash-stars")
    sets = _needed_sets(docs, stars)
    links = materialize(_with_sets(stars, sets).mapInArrow(_confirm(percent), "a long, b long"), "minhash-links")
    roots = components(links)
    placed = members.filter("size > 2").join(roots, "v", "left").select("v", "n", "band", F.coalesce("root", "v").alias("root"))
    more = _bucket_links(materialize(placed, "minhash-placed"), sets, percent)
    return components(materialize(links.unionByName(more), "minhash-all-links"))


def _bucket_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect whatever members (band, v, n, root) of a bucket are linked, but of different roots.

    All pairs of a bucket are compared inside of tasks and only links leave them. A bucket of more than BLOCK members
    or BLOCK_ELEMENTS elements is cut into blocks; a task holds two of them, a member goes where its block is met by
    another. Of buckets with the same members one is taken.
    """
    digests = [F.bit_xor(F.xxhash64("v", F.lit(seed))).alias(f"of_{seed}") for seed in (1, 2)]
    mixed = members.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"), F.sum("n").alias("elements"), *digests)
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("elements") / BLOCK_ELEMENTS)).cast("int")
    taken = mixed.filter("low < high").groupBy("size", "of_1", "of_2").agg(F.min(F.struct("band", blocks.alias("blocks"))).alias("one"))
    open_ = members.join(taken.select("one.*"), "band").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    open_ = materialize(open_.select("band", "v", "root", "block", "blocks"), "minhash-open")
    met = sets.join(open_, "v").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.groupBy("band", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    return cells.applyInArrow(_cell_links(percent), "a long, b long")


def _needed_sets(docs: DataFrame, stars: DataFrame) -> DataFrame:
    """v, hashes of the representatives that share a bucket with another.

    A bitmap of hashed ids, of one size whatever the data, keeps most other texts out of the shuffle; the join decides.
    """
    wanted = stars.select(F.col("a").alias("doc_id")).union(stars.select("b")).distinct()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP))
    bits = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    held = (F.bitmap_bucket_number(place) == F.col("bucket")) & (F.getbit(byte, (bit % 8).cast("int")) == 1)
    texts = docs.select("doc_id", "text").join(F.broadcast(bits), held, "left_semi").join(wanted, "doc_id", "left_semi")
    return materialize(texts.mapInArrow(_sets, "v long, hashes binary"), "minhash-sets")


def near_duplicates(docs: DataFrame, percent: int = 85, key: str | None = None) -> DataFrame:
    """row_id, doc_id, n_shingles, component_id, kept per row of ``docs``.

    Texts are linked if 100 * shared >= ``percent`` * all of their distinct shingles; component_id is the least doc_id
    reachable. Texts without words are linked with nothing. Equal sets are one class, so copies are never paired. Rows
    with a null doc_id have no component and are kept. Rows that repeat a doc_id are one document: they are linked, and
    kept all. Rows are numbered as scanned unless ``key`` names a column of unique numbers.
    """
    row_id = F.col(key) if key else F.monotonically_increasing_id()
    texts = docs.select(row_id.alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = materialize(texts.mapInArrow(_sign, "row_id long, doc_id long, n_shingles long, hi long, lo long, bands array<long>"), "minhash-rows")
    able = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = able.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("least"))
    classes = materialize(classes.select("hi", "lo", F.col("least.doc_id").alias("v"), F.col("least.n_shingles").alias("n"), F.col("least.bands").alias("bands")), "minhash-classes")
    return _assigned(rows, classes, _linked(texts, classes, percent))


def _assigned(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    named = materialize(classes.select("hi", "lo", "v").join(roots, "v", "left").select("hi", "lo", F.coalesce("root", "v").alias("component_id")), "minhash-named")
    slim = rows.select("row_id", "doc_id", "n_shingles", "hi", "lo")
    out = slim.join(named, ["hi", "lo"], "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("row_id", "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one row of every group of near duplicates: that of the least doc_id, of repeated ids the first row.

    Rows, not ids, are compared: of rows that share a doc_id those of unlike texts stay, and copies without a doc_id
    are copies. Rows without words stay all.
    """
    rows = numbered(docs, "minhash-numbered")
    vertices = rows.select(F.col("row_id").alias("doc_id"), F.col("doc.text").alias("text"))
    found = near_duplicates(vertices, percent).select(F.col("doc_id").alias("vertex"), "component_id")
    named = found.join(rows.select("row_id", F.col("doc.doc_id").alias("id")), F.col("vertex") == F.col("row_id"))
    kept = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_id")).alias("least"))
    return rows.join(kept.select(F.col("least.row_id").alias("row_id")), "row_id", "left_semi").select("doc.*")
