"""SentencePiece encoding and decoding: Aho-Corasick over the pieces drives one Viterbi pass.

A text is written with a leading space and every space as the meta mark U+2581. An
automaton over all pieces reports, at every position, each piece that ends there (its own
and those its output links lead to); each relaxes the best score of its end from that of
its start. Characters no piece covers become byte pieces (or the unknown piece, where a
model has none) at a penalty below the least score.

Pieces of the vocabulary never continue from a character to a meta mark after it, nor
across a line feed, nor from a letter to a stop; this is checked when a model is loaded. A
text is therefore cut there, and each part, whose best path does not depend on the others,
is encoded once and remembered until its partition ends.

Scores are the model's own, so for a model of type BPE the result is its best-scoring
segmentation, not the one its merge order gives; the tests hold the ids against the
public library with the same pieces declared as a unigram model.

Defined cases: null and empty texts have no pieces; whole texts are encoded, however long;
equal scores go to the longer last piece; a literal U+2581 is written in byte pieces, so
that decoding gives the text back exactly; repeated rows are encoded alike; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallyloom.llm.arrays import release_memory

# Fixed values of the format.
META = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED_PARTS = 100_000  # in each of two generations
REMEMBERED_CHARS = 64
ROWS_AT_ONCE = 200
IDS_AT_ONCE = 1 << 18
STOPS = "!\"#$%&()*+,./:;<=>?@[]^`{|}~"
PARTS = r" +[^ \n]*|\n|[^ \n]+"
WHOLE = re.compile(r"(?s).+")


class PieceModel:
    """Pieces, scores and special ids of a serialised SentencePiece model."""

    def __init__(self, serialised: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=serialised)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        kept = [i for i in ids if not (model.is_control(i) or model.is_unused(i))]
        self.unknown = model.unk_id()
        self.bytes = {int(pieces[i][3:5], 16): i for i in kept if model.is_byte(i)}
        own = [i for i in kept if i != self.unknown and not model.is_byte(i)]
        self.penalty = min(map(model.get_score, own), default=0.0) - UNKNOWN_PENALTY
        # What each id decodes to; control ids decode to nothing.
        self.raw = [b""] * len(ids)
        self.raw[self.unknown] = " \u2047 ".encode()
        for byte, i in self.bytes.items():
            self.raw[i] = bytes([byte])
        self.automaton = ahocorasick.Automaton()
        for i in own:
            self.raw[i] = pieces[i].replace(META, " ").encode()
            self.automaton.add_word(pieces[i], (len(pieces[i]), model.get_score(i), i))
        self.automaton.make_automaton()
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        cut_at_spaces = not any(META in pieces[i].lstrip(META) for i in own)
        cut_at_lines = not any("\n" in pieces[i] and pieces[i] != "\n" for i in own)
        stops = "".join(
            c for c in STOPS if not any(re.search(rf"[^\W\d_]{re.escape(c)}", pieces[i]) for i in own)
        )
        self.parts = WHOLE
        if cut_at_spaces and cut_at_lines:
            # Possessive: a shorter run of letters is followed by a letter, never by a stop.
            before_stop = rf" *+[^\W\d_]++(?=[{re.escape(stops)}])|" if stops else ""
            self.parts = re.compile(before_stop + PARTS)
        # Ids of a part as bytes: a quarter of the memory of a tuple, and quick to join.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def best_path(self, part: str) -> tuple[int, ...]:
        """Viterbi over one part, which has meta marks for its spaces."""
        n = len(part)
        best = [0.0] + [-math.inf] * n
        back: list[tuple] = [()] * (n + 1)
        reached = 0
        for last, match in self.automaton.iter(part):
            size, added, _ = match
            end = last + 1
            if last > reached:
                self._bridge(best, back, reached, last)
                reached = last
            score = best[end - size] + added
            if score > best[end]:
                best[end] = score
                back[end] = match
        if best[n] == -math.inf:
            self._bridge(best, back, reached, n)
        out: list[int] = []
        while n > 0:
            size, _, piece = back[n]
            n -= size
            if piece == self.unknown:
                out.extend(reversed(self.fallback(part[n])))
            else:
                out.append(piece)
        out.reverse()
        return tuple(out)

    def _bridge(self, best: list[float], back: list[tuple], first: int, last: int) -> None:
        """Positions up to `last` that no piece ends at: the character alone, as unknown."""
        for end in range(first + 1, last + 1):
            if best[end] == -math.inf:
                best[end] = best[end - 1] + self.penalty
                back[end] = (1, self.penalty, self.unknown)

    def fallback(self, character: str) -> list[int]:
        """A character no piece covers: its bytes, or the unknown piece."""
        if len(self.bytes) == 256:
            return [self.bytes[b] for b in character.encode()]
        return [self.unknown]

    def _remembered(self, part: str) -> bytes:
        path = self.known.get(part) or self.older.get(part)
        if path is None:
            path = array("i", self.best_path(part.replace(" ", META))).tobytes()
        if len(part) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED_PARTS:
                # What is not asked for again goes with the next change; the rest comes back.
                self.older, self.known = self.known, {}
            self.known[part] = path
        return path

    def forget(self) -> None:
        """Worker processes outlive their partitions; idle ones need no parts."""
        self.known, self.older = {}, {}

    def encode(self, text: str) -> array:
        ids = array("i")
        if not text:
            return ids
        # Literal meta marks stand between the stretches.
        for n, stretch in enumerate((" " + text).split(META)):
            if n:
                ids.extend(self.fallback(META))
            parts = self.parts.findall(stretch)
            paths = list(map(self.known.get, parts))
            new = -1
            for _ in range(paths.count(None)):
                new = paths.index(None, new + 1)
                paths[new] = self._remembered(parts[new])
            ids.frombytes(b"".join(paths))
        return ids

    def decoded_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes the ids stand for, one after the other, and how many each has."""
        size = self.raw_size[ids]
        out = [np.zeros(0, np.uint8)]
        for first in range(0, len(ids), IDS_AT_ONCE):
            some = slice(first, first + IDS_AT_ONCE)
            ends = np.cumsum(size[some])
            # From its place in the output, a byte's place in the table is as far as its piece's.
            shift = np.repeat(self.raw_start[ids[some]] - (ends - size[some]), size[some])
            out.append(self.raw_bytes[shift + np.arange(len(shift))])
        return np.concatenate(out), size

    def decode(self, ids: Iterable[int]) -> str:
        """The text the ids were made from."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load_model(serialised: bytes) -> PieceModel:
    """One model for each worker process."""
    return PieceModel(serialised)


def _round_trips(model: PieceModel, texts: list[str], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the ids of each text decode to it: all are decoded at once and compared as bytes."""
    wanted = [(" " + text).encode() if text else b"" for text in texts]
    starts = np.cumsum([0, *map(len, wanted)], dtype=np.int64)
    made, size = model.decoded_bytes(ids)
    sums = np.append(0, np.cumsum(size))[ends]
    same = np.diff(sums) == np.diff(starts)
    given = np.frombuffer(b"".join(wanted), np.uint8)
    if same.all():
        differs = np.concatenate([[0], np.cumsum(made != given)])
        return differs[starts[1:]] == differs[starts[:-1]]
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(made[sums[i] : sums[i + 1]], given[starts[i] : starts[i + 1]])
    return same


def encode_texts(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", checked: bool = False
) -> DataFrame:
    """(key, ids, n_ids) of every row; if checked, also whether decoding gives the text back.

    The model file (of fixed size) is read on the driver and travels with the tasks.
    """
    serialised = Path(model_path).read_bytes()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(serialised)
        try:
            for batch in rows:
                for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(first, ROWS_AT_ONCE)
                    texts = [value or "" for value in part.column(1).to_pylist()]
                    values, bounds = array("i"), [0]
                    for value in texts:
                        values.extend(model.encode(value))
                        bounds.append(len(values))
                    ids, ends = np.frombuffer(values, np.int32), np.array(bounds, np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                    arrays = [part.column(0), lists, pa.array(np.diff(ends))]
                    if checked:
                        arrays.append(pa.array(_round_trips(model, texts, ids, ends)))
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                release_memory()
        finally:
            model.forget()

    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, ids array<int>, n_ids int" + ", round_trip boolean" * checked
    names = [key, "ids", "n_ids"] + ["round_trip"] * checked
    return narrow.mapInArrow(batches, schema)


def decode_ids(encoded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every row of ids; null ids give a null text."""
    serialised = Path(model_path).read_bytes()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(serialised)
        for batch in rows:
            texts = [None if v is None else model.decode(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=[key, "text"]
            )

    narrow = encoded.select(key, ids)
    kind = narrow.schema[key].dataType.simpleString()
    return narrow.mapInArrow(batches, f"{key} {kind}, text string")
