"""Importance resampling towards a target distribution, with exact integer weights.

Features are runs of one to three words, hashed into `BUCKETS` buckets. A bucket's gain is
the logarithm of its share in the target over its share in the corpus, in thousandths. The
weight of a document is the sum of the gains of its features. It is taken bit by bit: plane j
of a document holds the buckets whose count has bit j; plane i of the gains, one set for each
sign, those whose gain has bit i. The population count of both planes' AND, times
`2 ** (i + j)`, summed over all pairs of planes, is the weight. A seeded Gumbel draw is
added, and the highest scores are drawn.

Defined cases: null and empty texts have no features, weight 0 and are never drawn for want
of words; repeated rows each count and are each drawn or not; equal scores go to the smaller
id, null ids first, then to the smaller weight; a null id is drawn as an empty one; an empty
corpus or target is a count of nothing; whole texts count, however long; other columns do not
matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Chunk, text_chunks, token_alphabet
from tallyloom.llm.ranking import numbered
from tallyloom.llm.tables import stored

BUCKETS = 10_000
LONGEST_RUN = 3
SEED = 42
LEAST_WORDS = 20
DRAWN_PERCENT = 5
GAIN_SCALE = 1000

# Documents whose counts are held as a dense table at once.
DENSE_DOCUMENTS = 128
# Runs of at most so many bytes are hashed side by side, longer ones one by one.
SHORT_RUN = 64


def _crc_table() -> np.ndarray:
    """The table of the common CRC-32 (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte runs [start, end), one byte of all runs at a time."""
    length = ends - starts
    order = np.argsort(-np.minimum(length, SHORT_RUN + 1), kind="stable")
    size = length[order]
    at = starts[order]
    long = int(np.searchsorted(-size, -SHORT_RUN, side="left"))
    out = np.empty(len(starts), np.uint32)
    view = memoryview(np.ascontiguousarray(data))
    out[order[:long]] = [zlib.crc32(view[a:b]) for a, b in zip(at[:long].tolist(), ends[order[:long]].tolist(), strict=True)]
    order, size, at = order[long:], size[long:], at[long:]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    # Runs are in falling order of length: those that go on are the first ones.
    going = np.searchsorted(-size, -np.arange(SHORT_RUN), side="left")
    for step in range(SHORT_RUN):
        n = int(going[step])
        if not n:
            break
        s = state[:n]
        s[:] = table[(s ^ data[at[:n] + step]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out[order] = ~state
    return out


class Features:
    """Features of a chunk's texts: the text of each, its bucket, and counts for each text."""

    def __init__(self, chunk: Chunk, alphabet: np.ndarray, table: np.ndarray):
        texts = len(chunk.bounds) - 1
        folded = alphabet[chunk.data]
        inside = folded != 0
        edge = np.zeros(len(folded) + 1, bool)
        edge[chunk.bounds] = True
        before = np.append(False, inside)[:-1]
        opens = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.append(inside, False)[1:]
        closes = np.flatnonzero(inside & (~after | edge[1:])) + 1
        first = np.searchsorted(opens, chunk.bounds)
        self.words = np.diff(first)
        # The words again, one blank between any two: runs of words are runs of bytes.
        size = closes - opens
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        joined = np.full(int(ends[-1]) + 1 if len(ends) else 1, 0x20, np.uint8)
        keep = np.ones(len(joined), bool)
        keep[ends] = False
        if not len(ends):
            keep[:] = False
        joined[keep] = folded[inside]
        text = np.repeat(np.arange(texts), self.words)
        past = first[1:][text]
        homes, buckets = [], []
        for run in range(1, LONGEST_RUN + 1):
            i = np.flatnonzero(np.arange(len(text)) + run <= past)
            homes.append(text[i])
            buckets.append(_crcs(joined, starts[i], ends[i + run - 1], table) % np.uint32(BUCKETS))
        self.text = np.concatenate(homes)
        self.bucket = np.concatenate(buckets).astype(np.int64)
        self.per_text = np.bincount(self.text, minlength=texts)


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. Tasks add up their own rows;
    at most BUCKETS sums reach the driver."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, table = token_alphabet(), _crc_table()
        total = np.zeros(BUCKETS, np.int64)
        for batch in rows:
            for chunk in text_chunks(batch.column(0)):
                total += np.bincount(Features(chunk, alphabet, table).bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = texts.select(text).mapInArrow(batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the corpus)), one added to every count."""
    in_corpus, in_target = float(int(corpus.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array(
        [
            math.floor(GAIN_SCALE * math.log((t + 1) * in_corpus / ((s + 1) * in_target)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    words = -(-flags.shape[-1] // 64)
    packed = np.zeros((*flags.shape[:-1], words * 8), np.uint8)
    bits = np.packbits(flags, axis=-1)
    packed[..., : bits.shape[-1]] = bits
    return packed.view(np.uint64)


class GainPlanes:
    """The gains bit by bit, positive and negative ones apart."""

    def __init__(self, gains: np.ndarray):
        self.planes = []
        size = np.abs(gains)
        for sign in (1, -1):
            mine = np.where(np.sign(gains) == sign, size, 0)
            for bit in range(int(mine.max(initial=0)).bit_length()):
                self.planes.append((sign << bit, _packed((mine >> bit) & 1 == 1)))

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """The exact weight of each row of bucket counts."""
        total = np.zeros(len(counts), np.int64)
        for bit in range(int(counts.max(initial=0)).bit_length()):
            plane = (counts >> bit) & 1 == 1
            some = np.flatnonzero(plane.any(axis=1))
            mine = _packed(plane[some])
            for factor, gains in self.planes:
                total[some] += (factor << bit) * np.bitwise_count(mine & gains).sum(axis=1, dtype=np.int64)
        return total


def weigh(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, table, planes = token_alphabet(), _crc_table(), GainPlanes(gains)
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                found = Features(chunk, alphabet, table)
                texts = chunk.last - chunk.first
                order = np.argsort(found.text, kind="stable")
                home, bucket = found.text[order], found.bucket[order]
                weight = np.zeros(texts, np.int64)
                for first in range(0, texts, DENSE_DOCUMENTS):
                    last = min(first + DENSE_DOCUMENTS, texts)
                    a, b = np.searchsorted(home, [first, last])
                    cells = (home[a:b] - first) * BUCKETS + bucket[a:b]
                    counts = np.bincount(cells, minlength=(last - first) * BUCKETS)
                    counts = counts.reshape(last - first, BUCKETS).astype(np.int32)
                    weight[first:last] = planes.weights(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, texts),
                        pa.array(found.words.astype(np.int64)),
                        pa.array(found.per_text.astype(np.int64)),
                        pa.array(weight),
                    ],
                    names=[key, "n_words", "n_features", "weight"],
                )

    return narrow.mapInArrow(batches, f"{key} {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column) -> Column:
    """A draw of the Gumbel distribution in thousandths, fixed by the key and SEED."""
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-GAIN_SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_features, weight, score, rank) of every row of docs; the rank of those drawn."""
    gains = bucket_gains(bucket_counts(docs, text), bucket_counts(target, text))
    scored = weigh(docs, gains, key, text).withColumn("score", F.col("weight") + gumbel(F.col(key)))
    scored = scored.withColumn("_short", F.col("n_words") < LEAST_WORDS).withColumn("_all", F.lit(0))
    # Equal rows are told apart, so that not even they are bound to one task.
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "weights")
    order = [F.col("_short"), F.desc("score"), F.col(key), F.col("weight"), F.col("n_features"), F.col("_row")]
    placed = stored(numbered(scored, "_all", order), "weighed")
    enough = placed.filter(~F.col("_short")).count()
    drawn = ~F.col("_short") & (F.col("place") < DRAWN_PERCENT * enough // 100)
    rank = F.when(drawn, F.col("place") + 1)
    return placed.select(key, "n_features", "weight", "score", rank.alias("rank"))
