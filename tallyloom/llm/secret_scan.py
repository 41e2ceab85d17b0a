"""Secret scan: known forms by pattern, unknown ones by sliding-window entropy.

Patterns find assignments, access keys and hexadecimal runs. Beyond those, every candidate
string (a long unbroken run of token characters) is swept by a window of fixed width whose
character counts are updated by one character in and one out; the Shannon entropy of the
window is judged against the threshold of the string's character class. Windows above it
make spans, unless the allow list covers the string: by pattern (numbers, UUIDs, ruled lines), or
because it is made of words, which is judged by how they are written and how common their
letters are. Offsets are code points.

Defined cases: null and empty texts have no spans; the whole text is scanned, however long;
repeated rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.arrays import text_chunks

KINDS = ("assign", "access", "hex")

# Fixed patterns of the known forms; lengths that count as a secret stand beside them.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_CHARS = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 18
HEX = re.compile(r"[0-9a-f]+")
HEX_CHARS = 16
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")


class CharacterClass(NamedTuple):
    """Strings of these characters only, and the entropy in bits that makes one a secret."""

    name: str
    pattern: re.Pattern[str]
    bits: float


class EntropyRule(NamedTuple):
    """Which runs are candidates, how wide the window is, and what is allowed."""

    min_chars: int = 20
    window: int = 20
    classes: tuple[CharacterClass, ...] = (
        CharacterClass("upperhex", re.compile(r"[0-9A-F]+\Z"), 3.0),
        CharacterClass("base32", re.compile(r"[A-Z0-9]+\Z"), 3.5),
        CharacterClass("base36", re.compile(r"[a-z0-9]+\Z"), 3.5),
        CharacterClass("base64", re.compile(r"[A-Za-z0-9+/_=-]+\Z"), 3.7),
    )
    allowed: tuple[re.Pattern[str], ...] = (
        re.compile(r"[0-9]+([-/_=+][0-9]+)*\Z"),  # numbers, dates, card and phone numbers
        re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z"),  # UUIDs
        re.compile(r"(=+|-+|_+|/+)\Z"),  # rules drawn with one character
    )
    words_allowed: bool = True  # words, also joined ones, by the evidence of their letters

    def allows(self, run: str) -> bool:
        return any(p.match(run) for p in self.allowed) or (self.words_allowed and are_words(run))


# How often letters stand in text, in percent (rough figures over English,
# French, German and Spanish).
LETTER_SHARES = {
    "a": 9.2, "b": 1.4, "c": 3.4, "d": 4.3, "e": 14.5, "f": 1.4, "g": 1.8, "h": 3.5, "i": 7.1,
    "j": 0.4, "k": 0.6, "l": 4.8, "m": 2.8, "n": 7.8, "o": 6.3, "p": 2.4, "q": 0.7, "r": 6.6,
    "s": 7.0, "t": 6.9, "u": 4.4, "v": 1.3, "w": 1.0, "x": 0.3, "y": 0.9, "z": 0.6,
}
LETTER_ODDS = {letter: math.log(share / 100 * 26) for letter, share in LETTER_SHARES.items()}
LEAST_ODDS = -0.5
# Words as they are written: small letters after a capital or not, or capitals only; several
# in a row in the camel's way. A capital alone between small letters is no word.
WRITTEN = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[A-Z][a-z]+|[A-Z]{2,6}(?![a-z]))*[0-9]{0,4}\Z")
JOINTS = re.compile(r"[-_/+=]+")


def are_words(run: str) -> bool:
    """Whether a run is words, numbers of up to four digits, or both, joined or not.

    All letters together must be likelier to be text than drawn evenly. A key has rare
    letters, digits amid letters, or capitals amid small letters.
    """
    parts = [part for part in JOINTS.split(run) if part]
    if not parts or not all(len(p) <= 4 and p.isdigit() or WRITTEN.match(p) for p in parts):
        return False
    return sum(LETTER_ODDS.get(c, 0.0) for c in run.lower()) > LEAST_ODDS


CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")


def window_entropies(text: str, width: int) -> Iterator[float]:
    """Entropy in bits of every window, from counts changed by one character in, one out."""
    counts = Counter(text[:width])
    total = min(width, len(text))
    weight = sum(c * math.log2(c) for c in counts.values())
    yield math.log2(total) - weight / total
    for gone, new in zip(text, text[width:], strict=False):
        if gone != new:
            for symbol, step in ((gone, -1), (new, 1)):
                before = counts[symbol]
                after = before + step
                weight -= before * math.log2(before) if before else 0.0
                weight += after * math.log2(after) if after else 0.0
                counts[symbol] = after
        yield math.log2(total) - weight / total


def entropy_spans(text: str, rule: EntropyRule) -> Iterator[tuple[int, int, str]]:
    """Maximal runs of high-entropy windows inside candidate strings."""
    for found in CANDIDATE.finditer(text):
        run = found.group()
        if len(run) < rule.min_chars or rule.allows(run):
            continue
        kind = next(c for c in rule.classes if c.pattern.match(run))
        begin = end = -1
        for at, bits in enumerate(window_entropies(run, rule.window)):
            if bits >= kind.bits:
                if begin < 0 or at > end:
                    if begin >= 0:
                        yield found.start() + begin, found.start() + end, kind.name
                    begin = at
                end = min(at + rule.window, len(run))
        if begin >= 0:
            yield found.start() + begin, found.start() + end, kind.name


def base_spans(text: str, has_words: bool, has_hex: bool) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of the known forms; the flags tell which patterns can match at all."""
    if has_words:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_CHARS:
                yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_CHARS:
                yield m.start(), 1, m.end()
    if has_hex:
        for m in HEX.finditer(text):
            if m.end() - m.start() >= HEX_CHARS:
                yield m.start(), 2, m.end()


def _members(pattern: re.Pattern[str]) -> np.ndarray:
    return np.array([bool(pattern.match(chr(b))) if b < 128 else False for b in range(256)])


IS_HEX, IS_TOKEN = _members(HEX), _members(CANDIDATE)


def _texts_with_run(
    data: np.ndarray, bounds: np.ndarray, member: np.ndarray, least: int
) -> np.ndarray:
    """For each text: has it a run of `least` member bytes?

    A run may be seen across the border of two texts; that only sends a text to the
    patterns without need.
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = member[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    # Every text that the run touches is scanned.
    out = np.zeros(len(bounds) - 1, bool)
    first = np.searchsorted(bounds, starts[long], side="right") - 1
    last = np.searchsorted(bounds, ends[long] - 1, side="right") - 1
    for a, b in zip(first, last, strict=True):
        out[a : b + 1] = True
    return out


def scan(text: str, rule: EntropyRule, has_hex: bool = True, has_token: bool = True):
    """Known forms as (start, kind, end) and entropy spans as (start, end, class), sorted."""
    small = text.lower()
    has_words = any(word in small for word in ASSIGN_WORDS)
    base = sorted(base_spans(text, has_words, has_hex))
    more = list(entropy_spans(text, rule)) if has_token else []
    return base, more


def scan_column(column: pa.Array, rule: EntropyRule):
    """The findings of every text of an Arrow column, in order.

    Patterns that walk all characters run only on texts in which a vectorised pass over
    the bytes has seen a run long enough.
    """
    for chunk in text_chunks(column):
        hexes = _texts_with_run(chunk.data, chunk.bounds, IS_HEX, HEX_CHARS)
        tokens = _texts_with_run(chunk.data, chunk.bounds, IS_TOKEN, rule.min_chars)
        texts = column.slice(chunk.first, chunk.last - chunk.first).to_pylist()
        for text, has_hex, has_token in zip(texts, hexes, tokens, strict=True):
            yield scan(text or "", rule, bool(has_hex), bool(has_token))


FINDINGS = "array<struct<kind string, first int, past int>>"


def scan_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: EntropyRule = EntropyRule()
) -> DataFrame:
    """(key, found): all spans by start, then kind as listed, entropy spans last."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [
                [{"kind": KINDS[kind], "first": a, "past": b} for a, kind, b in base]
                + [{"kind": f"entropy_{name}", "first": a, "past": b} for a, b, name in more]
                for base, more in scan_column(batch.column(1), rule)
            ]
            for spans in found:
                spans.sort(key=lambda s: s["first"])
            kind = pa.list_(
                pa.struct([("kind", pa.string()), ("first", pa.int32()), ("past", pa.int32())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind)], names=[key, "found"]
            )

    narrow = docs.select(key, text)
    return narrow.mapInArrow(batches, f"{key} {narrow.schema[key].dataType.simpleString()}, found {FINDINGS}")


def redact_secrets(
    docs: DataFrame, text: str = "text", rule: EntropyRule = EntropyRule(), mask: str = "[secret]"
) -> DataFrame:
    """The same rows and columns, with every found span (overlaps as one) replaced by the mask."""
    at = docs.columns.index(text)

    def cleaned(value: str | None, base, more) -> str | None:
        spans = sorted([(a, b) for a, _, b in base] + [(a, b) for a, b, _ in more])
        if not spans:
            return value
        out, done = [], 0
        for begin, end in spans:
            if begin >= done:
                out += [value[done:begin], mask]
            done = max(done, end)
        return "".join([*out, value[done:]])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            column = batch.column(at)
            texts = column.to_pylist()
            new = [
                cleaned(value, *found)
                for value, found in zip(texts, scan_column(column, rule), strict=True)
            ]
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            arrays[at] = pa.array(new, column.type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(batches, docs.schema)
