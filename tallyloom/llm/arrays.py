"""UTF-8 text of an Arrow column as numpy bytes, cut into chunks of bounded size.

All functions work on one chunk of whole texts; a single text longer than the bound is
a chunk of its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

# An odd base for polynomial hashes modulo 2**64 and the multipliers of
# the splitmix64 finaliser.
POLY_BASE = 0x9E3779B97F4A7C15
MIX_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Chunk(NamedTuple):
    """Texts first..last of a column: their bytes and where each one begins and ends."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    texts = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    values = texts.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        bounds = offsets[first : last + 1]
        yield Chunk(first, last, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        first = last
    release_memory()


def release_memory() -> None:
    """Arrow keeps what earlier batches took, in every worker process; give it back."""
    pa.default_memory_pool().release_unused()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    out = values.astype(np.uint64, copy=True)
    for shift, factor in zip((30, 27), MIX_MULTIPLIERS, strict=True):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(factor)
    out ^= out >> np.uint64(31)
    return out


@cache
def symbol_codes(seed: int = 1) -> np.ndarray:
    """A fixed 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(POLY_BASE) + np.uint64(seed))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            steps = np.full(size, POLY_BASE, np.uint64)
            back = np.full(size, pow(POLY_BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            cls.up, cls.down = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        return cls.up[:n], cls.down[:n]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """sums[i] is the polynomial hash of the first i codes."""
    up, _ = _Powers.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal strings have equal hashes, wherever they lie."""
    _, down = _Powers.upto(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


class Words(NamedTuple):
    """Words of a chunk: byte spans, polynomial hashes, and word bounds of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words(chunk: Chunk, alphabet: np.ndarray) -> Words:
    """Maximal runs of bytes that the alphabet (a table of 256) does not map to zero.

    The alphabet also folds: a word is hashed as the bytes it is mapped to. No word
    crosses from one text to the next.
    """
    folded = alphabet[chunk.data]
    inside = np.zeros(len(folded) + 1, bool)
    inside[:-1] = folded != 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = np.zeros(len(folded) + 1, bool)
    closes[1:] = inside[:-1] & ~inside[1:]
    cuts = chunk.bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(folded))]
    cuts = cuts[inside[cuts - 1] & inside[cuts]]
    opens[cuts] = True
    closes[cuts] = True
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    sums = prefix_hashes(symbol_codes()[folded])
    return Words(
        starts, ends, mix(span_hashes(sums, starts, ends)), np.searchsorted(starts, chunk.bounds)
    )


def word_alphabet() -> np.ndarray:
    """Words end at ASCII white space (0x20 and 0x09 to 0x0D); A-Z are lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[[0x20, *range(0x09, 0x0E)]] = 0
    # Byte 0 is part of a word; it takes the place of a byte that UTF-8 never uses.
    table[0] = 0xFF
    return table


def token_alphabet() -> np.ndarray:
    """Words of letters and digits only; bytes of non-ASCII characters count as letters."""
    table = word_alphabet()
    for byte in range(128):
        if not chr(byte).isalnum():
            table[byte] = 0
    return table
