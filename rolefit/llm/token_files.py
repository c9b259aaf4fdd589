"""Token ids in Arrow files: equal-length sequences and masks that are read without a copy.

A shard is an Arrow file of record batches with two fixed-size-list columns, ``ids`` and ``mask``, of one
sequence length: sequence i of a shard lies at a computable place of batch i / ROWS. Documents follow one
another without gaps; the last sequence of a shard is filled up, with false in its mask. Beside it lies an Arrow
file with a row per document. Shards hold ranges of doc_id in ascending order.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, tasks, text_or_empty
from rolefit.session import shared_dir

#: Sequences of a record batch.
ROWS = 512
#: Chunks of text, and parts of chunks, whose ids a worker keeps before it starts anew; texts encoded at a time.
KEPT, TEXTS = 500_000, 4096
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "shard int, data string, docs string, n_docs long, n_tokens long"


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


class ChunkEncoder:
    """Ids of whole texts from a tokenizer that drops white space and never joins what stands around it.

    The ids of a text are those of its chunks between white space, in order, and a chunk of letters and closing ASCII
    marks is put together from the ids of both. Texts are split and their chunks numbered by Arrow; Python sees each
    different chunk of a batch once, and the ids of all its occurrences are gathered from one array of the kept ones. Parts not met
    before go through the tokenizer many at a time, blanks between them: each ends with its first token that ends a word.
    """

    MARKS = "!\"#$%&(*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.vocabulary, bool)  # whether a token ends a word
        if suffix:
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.parts: dict[str, bytes] = {"": b""}
        self._forget()

    def _forget(self) -> None:
        """Chunk: its place; ids of the chunks one after another, and where each ends, after a first 0."""
        self.place: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.ends = np.zeros(1 << 16, np.int32)

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, parts: list[str]) -> None:
        ids = np.frombuffer(self._ids([" ".join(parts)])[0], "<u4")
        cuts = np.flatnonzero(self.last[ids]) + 1
        if len(cuts) != len(parts) or cuts[-1] != len(ids):  # a part of several words
            self.parts.update(zip(parts, self._ids(parts), strict=True))
            return
        raw, at = ids.tobytes(), 0
        for part, cut in zip(parts, (4 * cuts).tolist(), strict=True):
            self.parts[part] = raw[at:cut]
            at = cut

    def _learn(self, chunks: list[str]) -> None:
        if len(self.parts) >= KEPT:
            self.parts = {"": b""}
        cores, marks = [], []
        for chunk in chunks:
            core = chunk.rstrip(self.MARKS)
            simple = core.isalpha()
            marks.append(chunk[len(core):] if simple else "")
            cores.append((core.lower() if core.isascii() else core) if simple else None)
        parts = self.parts
        new = list({p for p in (*cores, *marks) if p is not None and p not in parts})
        for at in range(0, len(new), 1024):
            self._learn_parts(new[at:at + 1024])
        other = iter(self._ids([chunk for chunk, core in zip(chunks, cores, strict=True) if core is None]))
        found = [next(other) if core is None else parts[core] + parts[mark] for core, mark in zip(cores, marks, strict=True)]
        first, n = len(self.place), len(chunks)
        self.place.update(zip(chunks, range(first, first + n), strict=True))
        ends = self.used + np.cumsum(np.fromiter(map(len, found), np.int64, n) // 4)
        for name, at, more in (("flat", self.used, np.frombuffer(b"".join(found), "<u4")), ("ends", first + 1, ends)):
            held = getattr(self, name)
            if at + len(more) > len(held):
                held = np.concatenate([held[:at], np.empty(max(len(held), len(more)), held.dtype)])
                setattr(self, name, held)
            held[at:at + len(more)] = more
        self.used = int(ends[-1])

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has. Texts must not be null."""
        # Special tokens may hold the words around them together; four separators are white space to Arrow alone.
        odd = pc.match_substring_regex(texts, "[\\x1c-\\x1f]")
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        strange = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        split = pc.utf8_split_whitespace(texts if not len(strange) else pc.if_else(odd, "", texts))
        bounds = split.offsets.to_numpy()
        chunks = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        names, bounds = chunks.dictionary.to_pylist(), bounds - bounds[0]
        if len(self.place) >= KEPT:
            self._forget()
        n = len(self.place)
        known = list(map(self.place.get, names))
        if None in known:
            self._learn([name for name, at in zip(names, known, strict=True) if at is None])
            fresh = itertools.count(n)  # new chunks get their places in turn
            known = [next(fresh) if at is None else at for at in known]
        place, n = np.array(known, np.int32)[chunks.indices.to_numpy()], len(self.place)
        taken = pa.ListArray.from_arrays(pa.array(self.ends[:n + 1]), pa.array(self.flat[:self.used])).take(pa.array(place))
        ids, ends = taken.flatten().to_numpy(), taken.offsets.to_numpy()
        counts = np.diff(ends[bounds]).astype(np.int64)
        if len(strange):
            pieces = np.split(ids, ends[bounds][1:-1])
            for i in strange:
                pieces[i] = np.frombuffer(self._ids([texts[int(i)].as_py()])[0], "<u4")
            ids, counts = np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        return ids, counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not texts:
            return []
        ids, counts = self.encode_array(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1])


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


class _Writer:
    """Cuts a stream of ids into sequences and writes them batch by batch."""

    def __init__(self, uri: str, length: int, kind: pa.DataType):
        self.length, self.kind = length, kind
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        fs, path = _filesystem(uri)
        self.sink = fs.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held, self.count, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.count, self.total = self.count + len(ids), self.total + len(ids)
        if self.count >= self.length * ROWS:
            flat = np.concatenate(self.held)
            full = len(flat) // (self.length * ROWS) * self.length * ROWS
            for at in range(0, full, self.length * ROWS):
                self._write(flat[at:at + self.length * ROWS])
            self.held, self.count = [flat[full:]], len(flat) - full

    def _write(self, flat: np.ndarray) -> None:
        rows = -(-len(flat) // self.length)
        mask = np.arange(rows * self.length) < len(flat)
        ids = np.zeros(rows * self.length, self.kind.to_pandas_dtype())
        ids[:len(flat)] = flat
        self.file.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.count:
            self._write(np.concatenate(self.held))
        self.file.close()
        self.sink.close()


def _write_shards(folder: str, tokenizer: str, length: int, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, attempt = _encoder(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        kind = pa.uint16() if encoder.vocabulary <= 2**16 and end_id < 2**16 else pa.uint32()
        data, docs = (f"{folder}/{what}-{shard:06d}-{attempt}.arrow" for what in ("tokens", "docs"))
        writer = None
        for batch in batches:
            if writer is None:  # an empty range leaves no file
                writer = _Writer(data, length, kind)
                fs, path = _filesystem(docs)
                sink = fs.open_output_stream(path)
                index, n_docs = pa.ipc.new_file(sink, DOCS), 0
            starts, sizes = [], []
            for at in range(0, len(batch), TEXTS):
                ids, counts = encoder.encode_array(batch.column("text").slice(at, TEXTS))
                ended = np.insert(ids, np.cumsum(counts), end_id)
                ends = writer.total + np.cumsum(counts + 1)
                starts.append(ends - counts - 1)
                sizes.append(counts + 1)
                writer.add(ended)
            n_docs += len(batch)
            if len(batch):
                index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.concatenate(starts)), pa.array(np.concatenate(sizes))], schema=DOCS))
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "data": [data], "docs": [docs],
                "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([writer.total], pa.int64())})

    return write


def write_token_files(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Encodes every text, ends it with ``end_id`` and writes shards in ascending doc_id order (ties by text).

    ``tokenizer`` is a file of the tokenizers library whose pre-tokenizer drops white space; special tokens are not
    added. Returns the manifest, a row per shard: shard, data and docs (paths), n_docs, n_tokens. Null texts are
    empty, a null doc_id comes first. A task that runs again writes files of a new name; the manifest names the
    files of the attempt that counted.
    """
    folder = folder or shared_dir(docs.sparkSession, "token-files")
    fs, path = _filesystem(folder)
    fs.create_dir(path)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange(tasks(docs.sparkSession), F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return materialize(rows.mapInArrow(_write_shards(folder, tokenizer, length, end_id), MANIFEST), "token-manifest")


def open_tokens(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A shard; local files are mapped, so that batches are views of the file."""
    fs, path = _filesystem(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``i`` of a shard, by random access."""
    batch = reader.get_batch(i // ROWS)
    length = batch.schema.field("ids").type.list_size
    row = slice(i % ROWS * length, (i % ROWS + 1) * length)
    return _flat(batch)[row], batch.column("mask").flatten().to_numpy(zero_copy_only=False)[row]


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("ids").flatten().to_numpy()


def read_documents(data: str, docs: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Per batch of a shard's documents: their rows, and their ids as little-endian unsigned 32-bit integers."""
    tokens = open_tokens(data)
    length = tokens.schema.field("ids").type.list_size
    span, held = length * ROWS, {}
    fs, path = _filesystem(docs)
    with fs.open_input_file(path) as file:
        index = pa.ipc.open_file(file)
        for b in range(index.num_record_batches):
            batch, out = index.get_batch(b), []
            for start, n in zip(batch.column("start").to_numpy(), batch.column("n_tokens").to_numpy(), strict=True):
                pieces = []
                for part in range(start // span, (start + n - 1) // span + 1):
                    if part not in held:
                        held = {k: v for k, v in held.items() if k >= part - 1} | {part: _flat(tokens.get_batch(part))}
                    pieces.append(held[part][max(0, start - part * span):start + n - part * span].astype("<u4"))
                out.append(pieces[0] if len(pieces) == 1 else np.concatenate(pieces))
            yield batch, out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            for docs, ids in read_documents(row["data"], row["docs"]):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": docs.column("doc_id"), "start": pa.array(docs.column("start").to_numpy() + row["base"]),
                    "n_tokens": docs.column("n_tokens"), "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())})


def token_digests(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 per document, read from the shards."""
    order = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row per shard, not per document
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    return based.repartition(tasks(manifest.sparkSession), "shard").select("data", "docs", "base").mapInArrow(
        _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
