"""Benchmark decontamination by spaced seeds.

Texts become words (letters and digits, lower case). A seed is the hash of the words under
a fixed mask laid over consecutive words; words at the mask's ignored places may differ.
Seeds of the benchmark meet seeds of the documents. Around every meeting, on its diagonal,
the two texts are compared word by word. A document is contaminated by an item if any
stretch has enough matching words and few enough others; the one with most matches is kept.

Every word of every document is hashed; most seeds cannot match, and a bitmap of fixed size
over the benchmark's seeds lets them go before anything is shuffled. What passes meets the
benchmark's seeds in a join that may be shuffled and split.

Defined cases: null and empty texts contain nothing; an item of three to six words is found
where all of them stand in a row; one of one or two words, which any text may hold, only in a
document that consists of the same words; repeated items
and repeated rows give each link once; rows with a null id are left out of the links; empty
tables give no links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Words, mix, text_chunks, token_alphabet, words
from tallyloom.llm.bitmaps import BITMAP_BITS, bitmap_of, in_bitmap, probably_in, without
from tallyloom.llm.tables import stored

# Fixed masks: 1 takes part in the hash, 0 is ignored. Every mask has weight 7. Together
# they see every stretch of 11 words with one, 12 with two and 15 with three substitutions.
MASKS = ("1111111", "110110111", "1101010111", "111000011011", "110011000111", "11101111")
# Items of so many words have a seed of all their words, which every document is searched for.
SHORT_ITEMS = (3, 4, 5, 6)
MIN_MATCHES = 10
MIN_MATCH_SHARE = 0.8
SEED_BITS = 1 << 22  # half a megabyte, whatever the size of the benchmark

FACTORS = mix(np.arange(31, 31 + 64, dtype=np.uint64)) | np.uint64(1)


def mask_seeds(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed at every place the mask fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, number, np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total += hashes[i : i + n] * FACTORS[i]
    return mix(total)


def all_seeds(found: Words, own: bool, widths: Iterable[int]) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, place in the text, seed, width) over all texts of a chunk, for each mask and
    each of the widths. A width stands for runs of so many words: of texts of that length only
    (own), or wherever they stand."""
    sizes = np.diff(found.bounds)
    masks = [(mask, number, 0) for number, mask in enumerate(MASKS)]
    masks += [("1" * width, len(MASKS) + width, width) for width in widths]
    for mask, number, width in masks:
        seeds = mask_seeds(found.hashes, mask, number)
        at = np.arange(len(seeds))
        text = np.searchsorted(found.bounds, at, side="right") - 1
        inside = at + len(mask) <= found.bounds[text + 1]
        if own and width:
            inside &= sizes[text] == width
        yield text[inside], (at - found.bounds[text])[inside], seeds[inside], width
    # Texts shorter still: one seed of all their words.
    least = min(SHORT_ITEMS)
    short = np.flatnonzero((sizes > 0) & (sizes < least))
    total = sizes[short].astype(np.uint64)
    for i in range(least - 1):
        has = sizes[short] > i
        total[has] += found.hashes[found.bounds[short[has]] + i] * FACTORS[i]
    yield short, np.zeros(len(short), np.int64), mix(total), 0


def _seed_rows(rows: DataFrame, bitmap: np.ndarray | None, widths: Iterable[int]) -> DataFrame:
    """(id, at, seed, width) of (id, text); with a bitmap, only seeds whose bit is set."""
    widths = tuple(widths)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = token_alphabet()
        for batch in source:
            ids = batch.column(0).to_numpy()
            for chunk in text_chunks(batch.column(1)):
                for text, at, seeds, width in all_seeds(words(chunk, alphabet), bitmap is None, widths):
                    if bitmap is not None:
                        hit = in_bitmap(seeds, bitmap, SEED_BITS)
                        text, at, seeds = text[hit], at[hit], seeds[hit]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[chunk.first + text], pa.int64()),
                            pa.array(at, pa.int32()),
                            pa.array(seeds.view(np.int64), pa.int64()),
                            pa.array(np.full(len(seeds), width, np.int32)),
                        ],
                        names=["id", "at", "seed", "width"],
                    )

    return rows.filter("id is not null").mapInArrow(batches, "id long, at int, seed long, width int")


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Of the stretches with a share of matches of at least MIN_MATCH_SHARE, the one with the
    most matches; of equal ones the shortest, then the first. No match: an empty stretch."""
    percent = round(100 * MIN_MATCH_SHARE)
    # A stretch has the share if these add up to zero or more over it.
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 100 - percent, -percent))])
    matches = np.concatenate([[0], np.cumsum(equal)])
    # For every end, the first begin whose sum is not greater; a later one has fewer matches.
    lowest = np.minimum.accumulate(sums)
    begins = np.searchsorted(-lowest, -sums, side="left")
    hits = np.flatnonzero(equal)
    # Without the others at its ends a stretch has a greater share.
    after = np.append(hits, len(equal))
    begins = after[np.searchsorted(hits, begins)]
    ends = np.arange(len(sums))
    count = np.where(begins < ends, matches - matches[np.minimum(begins, ends)], 0)
    best = np.flatnonzero(count == count.max())
    end = best[np.argmin(ends[best] - begins[best])] if count.max() else 0
    return (int(begins[end]), int(end)) if end else (0, 0)


def enough(matches: int, length: int, item_words: int) -> bool:
    return matches >= min(MIN_MATCHES, item_words) and matches >= MIN_MATCH_SHARE * length


LINKS = "doc long, item long, first_word int, words int, matches int"


def _verified(pairs: DataFrame) -> DataFrame:
    """Links among (doc, item, diagonals, text, item_text): the best stretch of each pair."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = token_alphabet()

        def hashed(column: pa.Array) -> Iterator[np.ndarray]:
            for chunk in text_chunks(column):
                found = words(chunk, alphabet)
                for a, b in zip(found.bounds, found.bounds[1:], strict=False):
                    yield found.hashes[a:b]

        for batch in rows:
            out = []
            for doc, item, diagonals, own, other in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).to_pylist(),
                hashed(batch.column(3)),
                hashed(batch.column(4)),
                strict=True,
            ):
                best = (0, 0, 0)
                for diagonal in sorted(diagonals):
                    first = max(diagonal, 0)
                    last = min(diagonal + len(other), len(own))
                    equal = own[first:last] == other[first - diagonal : last - diagonal]
                    begin, end = best_stretch(equal)
                    matches = int(equal[begin:end].sum())
                    if enough(matches, end - begin, len(other)) and matches > best[0]:
                        best = (matches, first + begin, end - begin)
                if best[0]:
                    out.append((doc, item, best[1], best[2], best[0]))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc", "item", "first_word", "words", "matches"],
            )

    return pairs.mapInArrow(batches, LINKS)


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc, item, first_word, words, matches): each item found in each document, and its
    longest stretch there."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    benchmark = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text"))
    theirs = _seed_rows(benchmark, None, SHORT_ITEMS)
    # Documents are searched for the lengths that some item has.
    widths = [row.width for row in theirs.filter("width > 0").select("width").distinct().collect()]
    ours = _seed_rows(texts, bitmap_of(theirs, "seed", SEED_BITS), sorted(widths)).drop("width")
    theirs = theirs.select("seed", F.col("id").alias("item"), F.col("at").alias("item_at"))
    met = ours.join(theirs, "seed").select(
        F.col("id").alias("doc"), "item", (F.col("at") - F.col("item_at")).alias("diagonal")
    )
    pairs = met.groupBy("doc", "item").agg(F.collect_set("diagonal").alias("diagonals"))
    pairs = stored(pairs, "seed-pairs")
    # Only texts with a seed are compared; the bitmap spares most others the shuffle.
    seeded = bitmap_of(pairs, "doc", BITMAP_BITS)
    texts = probably_in(texts, "id", seeded, BITMAP_BITS)
    pairs = pairs.join(texts.withColumnRenamed("id", "doc"), "doc")
    pairs = pairs.join(
        benchmark.select(F.col("id").alias("item"), F.col("text").alias("item_text")), "item"
    )
    links = _verified(pairs.select("doc", "item", "diagonals", "text", "item_text"))
    return links.groupBy("doc", "item").agg(
        F.max(F.struct("matches", (-F.col("first_word")).alias("f"), "words")).alias("best")
    ).select(
        "doc",
        "item",
        (-F.col("best.f")).alias("first_word"),
        F.col("best.words").alias("words"),
        F.col("best.matches").alias("matches"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of documents in which no benchmark item was found."""
    return without(docs, key, contaminations(docs, items, key, text), "doc")
