"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Two machines are compiled from a model: the lexicon of pieces (a trie with failure arcs, which reads a text once and names
every piece in it), and byte fallback (a
character without a piece becomes its bytes). No normaliser is compiled: blanks are replaced by the piece mark and one
is put in front before, and models with a precompiled charsmap or remove_extra_whitespaces (nmt_nfkc, SentencePiece's
defaults) are refused. A text composed with the machines is a lattice of positions and pieces, and its shortest path in the tropical
semiring (weights add along a path, the least path wins) is the encoding. Of a unigram model a piece weighs its
negative score. Of a BPE model a piece weighs nothing, but a piece may follow another only if merging them by rank
leaves both as they are (else the arc weighs infinity): exactly one path is finite then, the one that merges give.

The lattice falls apart wherever no piece spans two neighbouring characters, so that the parts of a text are solved
alone and kept by a worker with their paths: what was met lately in one store, what the last full store held in another.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rolefit.llm.common import text_or_empty

MARK = "▁"
#: Words, parts of words and pairs of pieces that a worker keeps at most.
KEPT, PAIRS = 300_000, 2_000_000
#: Longest word that is kept.
LONGEST = 64
_NORMAL, _UNKNOWN, _BYTE, _USER = 1, 2, 6, 4
_BLANKS = re.compile(r" +[^ ]*")


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class Transducer:
    """The composed machine of a model file: ``encode`` and ``decode``."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models whose normaliser keeps characters and blanks are supported")
        self.prefix, self.merges = spec.add_dummy_prefix, model.trainer_spec.model_type == 2
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        self.bytes = [None] * 256
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.said: list[bytes] = []
        for i, p in enumerate(model.pieces):
            self.said.append(b"")
            if p.type == _BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value], self.said[i] = i, bytes([value])
            elif p.type in (_NORMAL, _USER):
                self.id[p.piece], self.score[p.piece], self.said[i] = i, p.score, p.piece.replace(MARK, " ").encode()
            elif p.type == _UNKNOWN:
                self.said[i] = " ⁇ ".encode()
        self.lexicon = ahocorasick.Automaton()
        for piece in self.id:
            self.lexicon.add_word(piece, piece)
        self.lexicon.make_automaton()
        self.spanned = {pair for p in self.id for pair in zip(p, p[1:])}
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}
        self.follows: dict[tuple[str, str], bool] = {}

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging neighbours of the best score, leftmost first."""
        symbols, score, none = list(text), self.score.get, float("-inf")
        pairs = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while pairs and (best := max(pairs)) > none:
            at = pairs.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = score(symbols[at - 1] + symbols[at], none)
            if at < len(pairs):
                pairs[at] = score(symbols[at] + symbols[at + 1], none)
        return symbols

    def _may_follow(self, a: str, b: str) -> bool:
        """Whether the arc of piece ``b`` after piece ``a`` ('' at the start) has a finite weight."""
        found = self.follows.get((a, b))
        if found is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            found = self.follows[a, b] = self._merged(a + b) == ([a, b] if a else [b])
        return found

    def _fallback(self, c: str) -> list[int]:
        ids = [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in ids else ids

    def _arcs(self, text: str) -> list[list[str]]:
        """Pieces that the lattice has from each position on, shortest first; '' for the bytes of a character without one."""
        out: list[list[str]] = [[] for _ in text]
        for last, piece in self.lexicon.iter(text):
            out[last + 1 - len(piece)].append(piece)
        for found in out:
            if not found or len(found[0]) > 1:
                found.insert(0, "")
        return out

    def _least(self, text: str) -> list[str]:
        """Least path where weights are scores: positions from left to right."""
        n, least = len(text), 10.0 - min(self.score.values(), default=0.0)
        reached: list = [(0.0, -1, "")] + [None] * n
        for i, arcs in enumerate(self._arcs(text)):
            weight = reached[i][0]
            for piece in arcs:
                cost, j = weight + (least if not piece else -self.score[piece]), i + (len(piece) or 1)
                if reached[j] is None or cost < reached[j][0]:
                    reached[j] = (cost, i, piece)
        path, at = [], n
        while at > 0:
            path.append(reached[at][2] or text[at - 1])
            at = reached[at][1]
        return path[::-1]

    def _finite(self, text: str) -> list[str]:
        """The one path of finite weight where weights are 0 or infinite: depth first, longest pieces first.

        A position is reached by one finite path at most, so one that leads nowhere need not be entered again.
        """
        n, at, last, done, dead = len(text), 0, "", [], bytearray(len(text) + 1)
        lattice, known = self._arcs(text), self.follows
        arcs = lattice[0][:] if n else []
        while at < n:
            while arcs:
                piece = arcs.pop()
                end = at + (len(piece) or 1)
                if dead[end]:
                    continue
                if not piece or (known[last, piece] if (last, piece) in known else self._may_follow(last, piece)):
                    done.append((at, last, arcs))
                    at, last = end, piece
                    arcs = lattice[at][:] if at < n else []
                    break
            else:
                dead[at] = 1
                at, last, arcs = done.pop()
        starts = [x[0] for x in done]
        return [text[a:b] for a, b in zip(starts, [*starts[1:], n], strict=True)]

    def _shortest(self, text: str) -> list[int]:
        """Ids of the shortest path through the lattice of a normalised text."""
        out: list[int] = []
        for piece in self._finite(text) if self.merges else self._least(text):
            i = self.id.get(piece)
            out += self._fallback(piece) if i is None else [i]
        return out

    def _cut(self, word: str) -> list[str]:
        """Parts of a stretch of text that no piece spans."""
        spanned = self.spanned
        at = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in spanned]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)] if at else [word]

    def _part(self, part: str) -> bytes:
        """Ids of a stretch of text that is solved alone."""
        found = self.parts.get(part)
        if found is None:
            found = self.parts_before.get(part)
            if found is None:
                found = _little(self._shortest(part))
            if len(part) <= LONGEST:
                if len(self.parts) >= KEPT:
                    self.parts, self.parts_before = {}, self.parts
                self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        """Ids of a normalised stretch of text, cut where no piece spans two characters."""
        if not self.merges:  # scores add up over cuts as well
            return _little(self._shortest(word))
        return b"".join(map(self._part, self._cut(word)))

    def _learn(self, key: str) -> bytes:
        """Ids of a stretch of text after a blank, which are kept; further blanks stand before it."""
        found = self.words_before.get(key)
        if found is None:
            found = self._word(MARK + key.replace(" ", MARK))
        if len(key) <= LONGEST:
            if len(self.words) >= KEPT:
                self.words, self.words_before = {}, self.words
            self.words[key] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; of an empty one none."""
        if not text:
            return np.empty(0, np.int32)
        text, head = text.replace(MARK, " "), []
        if not self.prefix:
            start = text.split(" ", 1)[0]
            head, text = [self._word(start)] if start else [], text[len(start) + 1:] if " " in text else None
        if text is None:
            keys = []
        else:
            keys = text.split(" ")
            if "" in keys:  # blanks in a row belong to what follows
                keys = [k[1:] for k in _BLANKS.findall(" " + text)]
        out = list(map(self.words.get, keys))
        if None in out:
            out = [self._learn(key) if found is None else found for key, found in zip(keys, out, strict=True)]
        return np.frombuffer(b"".join(head + out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.said.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_KNOWN: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _KNOWN:
        _KNOWN[path] = Transducer(path)
    return _KNOWN[path]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids, ids_crc32 and restored per row of ``docs``.

    ``restored`` tells whether decoding the ids gives the text (the piece mark itself, U+2581, comes back as a blank).
    Null texts are empty and have no ids. Rows are taken one by one where they lie: nothing is shuffled, and repeated
    rows, null ids and very long texts are rows like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, len(batch), 256):  # ids of few texts at a time
                rows = texts.slice(at, 256).to_pylist()
                gc.disable()  # nothing here refers in circles, and looking for that through all that is kept takes a fifth of the time
                ids = [machine.encode(t) for t in rows]
                gc.enable()
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(at, 256), "n_pieces": pa.array(np.diff(offsets).astype(np.int64)),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    "restored": pa.array([machine.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, rows, strict=True)])})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, n_pieces long, ids array<int>, ids_crc32 long, restored boolean")
