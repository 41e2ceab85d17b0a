"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

Every document becomes its set of five-word shingles. Texts with equal sets are one class
from the start. One hash of every shingle serves all bins of the signature: the high bits
choose the bin, the least hash in a bin is its value. An empty bin copies the bin its own
fixed random order reaches first (optimal densification). Rows of the signature form
bands; classes that agree on a band share a bucket.

A bucket yields a star, not all its pairs: every member is compared with the member whose
buckets are the fullest over all bands, since the text the others were made from agrees
with more of them than they do with each other. Comparisons are exact, on whole sets.
After the links found are joined to components, the centres are set aside, for they have met
their whole buckets. What is left of buckets that still hold several components is gone through
once more, so that no two members of different components stay uncompared: in buckets of
few members by a join, in larger ones by blocks of bounded size. A block holds whole
components, or a part of one too large for it; two blocks meet in one task, unless they
are parts of one component, as bit vectors, of which only pairs that may be similar come out.
So a bucket full of copies that are linked already costs one pass over it, and one of members
that are all unlike costs operations on bits, not rows.

Pairs whose sizes, or whose parities of shingles by residue, prove them unlike are not
compared on sets: the number of parities in which two sets differ is at most the number of
shingles only one of them has.

A pair at similarity s agrees on a band with probability s**4; at 0.75 it shares none of 40
bands with probability 0.68**40, about 2e-7, and 12.7 bands on average.

Defined cases: null and empty texts, and texts without words, have no shingles and are
linked with nothing; a text of fewer than five words is one shingle; repeated rows of one
doc_id are one document per row, linked to each other; a row without an id is placed like any
other but names no component; different texts under one doc_id are each linked by what they
hold, and what is named after one of them is named alike; an empty table gives no rows. A
64-bit hash stands for a shingle, and two 64-bit sums for a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Chunk, mix, text_chunks, word_alphabet, words
from tallyloom.llm.bitmaps import BITMAP_BITS, bitmap_of, probably_in
from tallyloom.llm.components import components
from tallyloom.llm.tables import stored

SHINGLE_WORDS = 5
MIN_SIMILARITY_PERCENT = 75
BANDS, BAND_ROWS = 40, 4
BINS = BANDS * BAND_ROWS
MEMBERS_A_BLOCK = 256
SMALL_BUCKET = 32  # members of a mixed bucket whose pairs are joined
BLOCK_MEMBERS = 1024
PARITY_LONGS, BRIEF_LONGS = 32, 8

WORD_FACTORS = mix(np.arange(11, 11 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)
# For each bin, the fixed random order in which it looks for a bin to copy.
DETOURS = np.argsort(
    mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(7)).reshape(BINS, BINS), axis=1
)
BAND_FACTORS = mix(np.arange(101, 101 + BAND_ROWS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(chunk: Chunk, alphabet: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a chunk."""
    found = words(chunk, alphabet)
    hashes, n = found.hashes, len(found.hashes)
    rolled = np.zeros(max(n - SHINGLE_WORDS + 1, 0), np.uint64)
    for i, factor in enumerate(WORD_FACTORS):
        rolled += hashes[i : n - SHINGLE_WORDS + 1 + i] * factor if len(rolled) else rolled
    rolled = mix(rolled)
    for a, b in zip(found.bounds, found.bounds[1:], strict=False):
        if b - a >= SHINGLE_WORDS:
            ordered = np.sort(rolled[a : b - SHINGLE_WORDS + 1])
            yield ordered[np.append(True, ordered[1:] != ordered[:-1])]
        elif b > a:
            # Shorter sequences are told from shingles, and from each other, by their length.
            short = (hashes[a:b] * WORD_FACTORS[: b - a]).sum(dtype=np.uint64)
            yield mix(np.array([short + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a nonempty sorted set."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    filled = np.zeros(BINS, bool)
    values = np.zeros(BINS, np.uint64)
    at = bins[first].astype(np.int64)
    filled[at] = True
    values[at] = shingles[first]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = DETOURS[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key for each band; keys of different bands never meet but by collision."""
    rows = values.reshape(BANDS, BAND_ROWS) * BAND_FACTORS
    return mix(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, n, low, high, bands): set size, set digest and band keys of every document."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                sizes, low, high, bands = [], [], [], []
                for shingles in shingle_sets(chunk, alphabet):
                    sizes.append(len(shingles))
                    low.append(shingles.sum(dtype=np.uint64))
                    high.append(mix(shingles ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64))
                    bands.append(
                        band_keys(signature(shingles)).view(np.int64).tobytes()
                        if len(shingles)
                        else None
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.last - chunk.first),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(low, np.uint64).view(np.int64)),
                        pa.array(np.array(high, np.uint64).view(np.int64)),
                        pa.array(
                            [None if b is None else np.frombuffer(b, np.int64) for b in bands],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    names=["doc", "n", "low", "high", "bands"],
                )

    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(
        batches, "doc long, n long, low long, high long, bands array<long>"
    )


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each residue of the hashes, whether the set has an odd number of shingles there."""
    n = 64 * PARITY_LONGS
    odd = np.bincount((shingles % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _outlines(texts: DataFrame) -> DataFrame:
    """(doc, words, odd, brief): set size of every text, parities by many residues and by few."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                made = [(len(found), parities(found)) for found in shingle_sets(chunk, alphabet)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.last - chunk.first),
                        pa.array([n for n, _ in made], pa.int64()),
                        pa.array([odd for _, odd in made], pa.list_(pa.int64())),
                        # Residues of a divisor: equal parts of the long form, added up.
                        pa.array(
                            [np.bitwise_xor.reduce(odd.reshape(-1, BRIEF_LONGS)) for _, odd in made],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    names=["doc", "words", "odd", "brief"],
                )

    return texts.select("doc", "text").mapInArrow(batches, "doc long, words long, odd array<long>, brief array<long>")


def _may_be_similar(other: str) -> str:
    """A condition on (words, brief, odd) and the same columns of the other side, that holds
    for every pair similar enough and for few others."""
    least = MIN_SIMILARITY_PERCENT

    def close(differ: str) -> str:
        both = f"(words + {other}_words)"
        return f"{100 + least} * ({both} - ({differ})) >= {2 * least} * {both}"

    # The short form is compiled; the long one is a method too long for that, so it is a loop.
    brief = " + ".join(f"bit_count(brief[{i}] ^ {other}_brief[{i}])" for i in range(BRIEF_LONGS))
    odd = f"aggregate(zip_with(odd, {other}_odd, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"
    sizes = f"100 * least(words, {other}_words) >= {least} * greatest(words, {other}_words)"
    return f"{sizes} and {close(brief)} and {close(odd)}"


def confirmed(edges: DataFrame, docs: DataFrame) -> DataFrame:
    """The edges (centre, member) whose whole sets are similar enough.

    The texts of members travel once for each edge. A centre's text travels once for each
    block of its members, of which there are as many as the crowd in their fullest common
    bucket asks for; so a centre of very many is shared among tasks. Each task reads a
    centre's text, keeps its set, and streams the members that follow.
    """
    blocks = F.ceil(F.col("crowd") / MEMBERS_A_BLOCK).cast("long")
    dealt = edges.select(
        "centre", "member", F.pmod(F.xxhash64("member"), blocks).alias("block")
    )
    members = dealt.join(docs, dealt.member == docs.doc).select("centre", "block", "member", "text")
    centres = dealt.select("centre", "block").distinct()
    centres = centres.join(docs, centres.centre == docs.doc).select(
        "centre", "block", F.lit(None).cast("long").alias("member"), "text"
    )
    streams = (
        members.unionByName(centres)
        .repartition("centre", "block")
        .sortWithinPartitions("centre", "block", F.col("member").asc_nulls_first())
    )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        mine: list[np.ndarray] = []  # one set for each text under the centre's id
        last = True
        for batch in rows:
            centre, member = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            similar = np.zeros(len(centre), bool)
            row = 0
            for chunk in text_chunks(batch.column(3)):
                for other in shingle_sets(chunk, alphabet):
                    if member[row] is None:
                        mine = [other] if last else [*mine, other]
                    last = member[row] is not None
                    similar[row] = last and any(_alike(own, other) for own in mine)
                    row += 1
            keep = pa.array(similar)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(2).filter(keep)], names=["a", "b"]
            )

    return streams.mapInArrow(batches, "a long, b long")


def _alike(own: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    if not len(own) or not len(other):
        return False
    at = np.searchsorted(own, other)
    both = int((own[np.minimum(at, len(own) - 1)] == other).sum())
    return 100 * both >= MIN_SIMILARITY_PERCENT * (len(own) + len(other) - both)


def _pairs_of_blocks(members: pa.Table) -> pa.Table:
    """Pairs of (rep, component, words, odd, side) that may be similar: members of different
    components, of both sides, or any two if there is one side only."""
    rep = members["rep"].to_numpy()
    component = members["component"].to_numpy()
    size = members["words"].to_numpy()
    odd = members["odd"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, PARITY_LONGS)
    brief = np.bitwise_xor.reduce(odd.reshape(len(odd), -1, BRIEF_LONGS), axis=1)
    side = members["side"].to_numpy()
    one, other = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    least, found = MIN_SIMILARITY_PERCENT, []
    for first in range(0, len(one), 64):
        i = one[first : first + 64, None]
        sizes = size[i] + size[other]
        near = (component[i] != component[other]) & (
            100 * np.minimum(size[i], size[other]) >= least * np.maximum(size[i], size[other])
        )
        differ = np.bitwise_count(brief[i] ^ brief[other]).sum(axis=2, dtype=np.int64)
        near &= (100 + least) * (sizes - differ) >= 2 * least * sizes
        a, b = np.nonzero(near)
        a, b = one[first + a], other[b]
        differ = np.bitwise_count(odd[a] ^ odd[b]).sum(axis=1, dtype=np.int64)
        both = size[a] + size[b]
        close = (100 + least) * (both - differ) >= 2 * least * both
        found.append(np.column_stack([rep[a[close]], rep[b[close]]]))
    pairs = np.sort(np.concatenate(found), axis=1)
    pairs = np.unique(pairs[pairs[:, 0] < pairs[:, 1]], axis=0)
    return pa.table({"x": pa.array(pairs[:, 0]), "y": pa.array(pairs[:, 1])})


def _rest_of_buckets(placed: DataFrame, outlines: DataFrame) -> DataFrame:
    """(x, y, crowd) of all pairs that share a bucket of (key, rep, component, crowd), are in
    different components and may be similar."""
    outlined = placed.filter(F.col("crowd") <= SMALL_BUCKET).join(outlines, "rep")
    others = outlined.select(
        "key",
        F.col("rep").alias("other"),
        F.col("component").alias("other_component"),
        *[F.col(name).alias(f"other_{name}") for name in ("words", "odd", "brief")],
    )
    joined = (
        outlined.join(others, "key")
        .filter("rep < other and component <> other_component")
        .filter(_may_be_similar("other"))
        .select(F.col("rep").alias("x"), F.col("other").alias("y"), "crowd")
    )

    # Components of a large bucket: those that fill a block are parted, the others share blocks.
    large = placed.filter(F.col("crowd") > SMALL_BUCKET)
    shares = large.groupBy("key", "component").agg(F.count("*").alias("share"))
    alone = F.col("share") > BLOCK_MEMBERS
    pooled = shares.groupBy("key").agg(F.sum(F.when(~alone, F.col("share"))).alias("pool"))
    dealt = large.join(shares, ["key", "component"]).join(pooled, "key")

    def part(column: str, members: Column) -> Column:
        blocks = F.greatest(F.ceil(members / BLOCK_MEMBERS), F.lit(1)).cast("long")
        return F.pmod(F.xxhash64(column), blocks)

    block = F.when(
        alone, F.struct(F.col("component").alias("whole"), part("rep", F.col("share")).alias("part"))
    ).otherwise(
        F.struct(F.lit(None).cast("long").alias("whole"), part("component", F.coalesce("pool", F.lit(0))).alias("part"))
    )
    dealt = dealt.select("key", "rep", "component", "crowd", block.alias("block"))
    blocks = dealt.groupBy("key").agg(F.collect_set("block").alias("blocks"))
    dealt = dealt.join(outlines.select("rep", "words", "odd"), "rep").join(blocks, "key")
    # Parts of one component do not meet; a block without such a one meets itself, too.
    meets = F.filter("blocks", lambda b: b["whole"].isNull() | ~b["whole"].eqNullSafe(F.col("block.whole")))
    met = dealt.withColumn("other", F.explode(meets))
    met = met.select(
        "key",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "rep",
        "component",
        "words",
        "odd",
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "crowd",
    )
    crowd = large.groupBy("rep").agg(F.max("crowd").alias("crowd"))
    compared = met.groupBy("key", "first", "second").applyInArrow(
        lambda _, table: _pairs_of_blocks(table), "x long, y long"
    )
    compared = compared.join(crowd.withColumnRenamed("rep", "x"), "x").select("x", "y", "crowd")
    return joined.unionByName(compared).groupBy("x", "y").agg(F.max("crowd").alias("crowd"))


def _stars(placed: DataFrame, outlines: DataFrame) -> DataFrame:
    """(x, y, crowd, centre) of each bucket's first member with each other one that may be similar,
    out of (key, rep, component, top, crowd)."""
    outlined = placed.join(outlines, "rep")
    centres = outlined.filter("rep = top").select(
        "key",
        F.col("rep").alias("centre"),
        F.col("component").alias("centre_component"),
        *[F.col(name).alias(f"centre_{name}") for name in ("words", "odd", "brief")],
    )
    return (
        outlined.join(centres, "key")
        .filter("component <> centre_component and rep <> top")
        .filter(_may_be_similar("centre"))
        .groupBy(F.least("centre", "rep").alias("x"), F.greatest("centre", "rep").alias("y"))
        .agg(F.max("crowd").alias("crowd"), F.min("centre").alias("centre"))
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_shingles, component): each document's set size and the smallest document
    reachable over links of similarity of at least 0.75."""
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    made = stored(sketches(docs, key, text), "sketches")

    # Equal sets are one class, under its smallest document.
    sets = made.filter("n > 0 and doc is not null").groupBy("n", "low", "high")
    classes = stored(sets.agg(F.min("doc").alias("rep")), "classes")
    reps = classes.select("rep").distinct()

    # Buckets of one class lead to no comparison.
    rows = made.filter("doc is not null").select("doc", "low", F.explode("bands").alias("key"))
    sizes = rows.groupBy("key").agg(
        F.count("*").alias("size"), F.min("low").alias("one"), F.max("low").alias("other")
    )
    sizes = sizes.filter("one < other").select("key", "size")
    crowd = rows.join(sizes, "key").select("key", F.col("doc").alias("rep"), "size")
    crowd = stored(crowd.join(classes.select("rep"), "rep", "left_semi"), "buckets")
    weight = crowd.groupBy("rep").agg(F.sum("size").alias("weight"))
    crowd = crowd.select("key", "rep").join(weight, "rep")

    # Only texts in some bucket are ever compared; the bitmap spares most others the shuffle.
    bitmap = bitmap_of(weight, "rep", BITMAP_BITS)
    texts = probably_in(texts, "doc", bitmap, BITMAP_BITS).join(
        weight.select(F.col("rep").alias("doc")), "doc", "left_semi"
    )
    texts = stored(texts, "candidates")

    outlines = stored(_outlines(texts), "outlines").withColumnRenamed("doc", "rep")
    links, found = None, reps.select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    for stars in (True, False):
        placed = crowd.join(found.withColumnRenamed("node", "rep"), "rep")
        mixed = placed.groupBy("key").agg(
            F.max(F.struct("weight", (-F.col("rep")).alias("r"))).alias("top"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("crowd"),
        )
        mixed = mixed.filter("low < high").select("key", (-F.col("top.r")).alias("top"), "crowd")
        placed = placed.join(mixed, "key")
        if stars:
            edges = stored(_stars(placed, outlines), "edges")
            tested = edges.select("x", "y")
            # A centre has met all members of its bucket, whatever component they are in.
            met = placed.filter("rep = top").select("key", "rep")
        else:
            placed = placed.select("key", "rep", "component", "crowd")
            edges = _rest_of_buckets(stored(placed, "open-buckets"), outlines)
            edges = stored(edges.join(tested, ["x", "y"], "left_anti"), "edges")
            edges = edges.withColumn("centre", F.col("x"))
        ends = edges.select(
            "centre", F.when(F.col("centre") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("member"), "crowd"
        )
        new = stored(confirmed(ends, texts), "confirmed")
        if stars:
            crowd = stored(crowd.join(met, ["key", "rep"], "left_anti"), "open-buckets")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            linked = components(links)
            found = reps.join(linked, reps.rep == linked.node, "left").select(
                F.col("rep").alias("node"), F.coalesce("component", "rep").alias("component")
            )
            found = stored(found, "components")

    named = classes.join(found, classes.rep == found.node).select("n", "low", "high", "component")
    grouped = made.select("doc", "n", "low", "high").join(named, ["n", "low", "high"], "left")
    return grouped.select(
        "doc", F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component")
    )
