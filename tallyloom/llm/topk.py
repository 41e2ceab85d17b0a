"""Exact top-k search by distributed histogram selection.

Vectors are made integers, so scores are exact. Queries and candidates are packed in blocks;
every block of queries meets every block of candidates once a round, and scores are matrix
products. Scores are not kept: a round counts them in a histogram between each query's
bounds, the histograms of all blocks are added up, and the bin that holds the k-th greatest
score becomes the next round's bounds. With `BINS` bins a round, the bounds meet after a few
rounds (the logarithm of the score range). The k-th score known, one more pass keeps what
lies above it, and of what equals it the smallest ids that are still needed.

Of a block's histogram only the bins down to its own k-th score are sent, and of its ties
only as many as can be needed: the rest can change no result. So a query costs at most k
bins and 2k rows a block, whatever the number of equal vectors.

Defined cases: vectors that are null, empty, or hold nulls or values that are not finite
take no part, on either side; nor do vectors so long that a product of two such might not
fit 64 bits (a squared norm of LARGEST_SQUARE and above, after scaling); vectors meet only vectors
of their own length; a query's own id is not among its candidates; fewer than k candidates
are all returned; equal scores go to the smaller id; repeated rows of an id are candidates
of their own; a query id that is repeated asks once, with its greatest vector, compared
component by component; rows with a null id take no part; no queries or no candidates give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import stored

BINS = 512
BLOCK_ROWS = 2048
QUERY_ROWS = 256
EXACT_DOUBLE = float(1 << 53)
LARGEST_SQUARE = float(1 << 61)

STATE = ("low", "width", "span")
BLOCKS = "block long, size int, ids binary, vectors binary, norm double"


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component, or null where the vector takes no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        doubles, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)
    )
    square = F.aggregate(doubles, F.lit(0.0), lambda sum_, x: sum_ + (x * factor) * (x * factor))
    usable = usable & (square < LARGEST_SQUARE)
    return F.when(usable, F.transform(doubles, lambda x: F.floor(F.lit(factor) * x)))


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """(id, vector) rows packed into blocks of one vector length. A block's number tells the
    task that made it and its place there."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(size: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(c) for c in zip(*held.pop(size), strict=True))
            norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([0], pa.int64()),
                    pa.array([size], pa.int32()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([vectors.tobytes()], pa.binary()),
                    pa.array([norms.max()], pa.float64()),
                ],
                names=["block", "size", "ids", "vectors", "norm"],
            )

        for batch in source:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            for size in np.unique(np.diff(bounds)):
                own = np.flatnonzero(np.diff(bounds) == size)
                for first in range(0, len(own), block_rows):
                    some = own[first : first + block_rows]
                    vectors = flat[bounds[some][:, None] + np.arange(size)]
                    parts = held.setdefault(int(size), [])
                    parts.append((ids[some], vectors))
                    if sum(len(i) for i, _ in parts) >= block_rows:
                        yield packed(int(size))
        for size in list(held):
            yield packed(size)

    made = rows.mapInArrow(batches, BLOCKS)
    return made.withColumn("block", F.monotonically_increasing_id())


def _products(q: bytes, c: bytes, size: int, bound: float) -> np.ndarray:
    """All inner products, exactly: as doubles where they stay whole numbers, else as integers."""
    queries = np.frombuffer(q, np.int64).reshape(-1, size)
    candidates = np.frombuffer(c, np.int64).reshape(-1, size)
    if bound < EXACT_DOUBLE:
        return (queries.astype(float) @ candidates.astype(float).T).astype(np.int64)
    return queries @ candidates.T


def _scored(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict]]:
    """For every pair of blocks: query ids, candidate ids, scores, and the query block's state."""
    for row in batch.to_pylist():
        queries = np.frombuffer(row["q_ids"], np.int64)
        ids = np.frombuffer(row["ids"], np.int64)
        scores = _products(row["q_vectors"], row["vectors"], row["size"], row["norm"] * row["q_norm"])
        yield queries, ids, scores, row


def _histograms(pairs: DataFrame, k: int) -> DataFrame:
    """(query, bin, n) of every pair of blocks, down to the block's own k-th score."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for queries, ids, scores, row in _scored(batch):
                low = np.frombuffer(row["low"], np.int64)[:, None]
                width = np.frombuffer(row["width"], np.int64)[:, None]
                span = np.frombuffer(row["span"], np.int64)[:, None]
                above_low = scores - low
                spot = above_low // width
                counted = (above_low >= 0) & (above_low < span) & (ids[None, :] != queries[:, None])
                flat = (spot + np.arange(len(queries))[:, None] * BINS)[counted]
                counts = np.bincount(flat, minlength=len(queries) * BINS).reshape(-1, BINS)
                above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                kept = (counts > 0) & (above < k)
                query, bins = np.nonzero(kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries[query]),
                        pa.array(bins.astype(np.int32)),
                        pa.array(counts[kept]),
                    ],
                    names=["query", "bin", "n"],
                )

    return pairs.mapInArrow(batches, "query long, bin int, n long")


def _selected(pairs: DataFrame, k: int) -> DataFrame:
    """(query, id, score): all above a query's k-th score, and the smallest ids that equal it."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for queries, ids, scores, row in _scored(batch):
                low = np.frombuffer(row["low"], np.int64)[:, None]
                order = np.argsort(ids, kind="stable")
                ids, scores = ids[order], scores[:, order]
                own = ids[None, :] == queries[:, None]
                ties = (scores == low) & ~own
                chosen = ((scores > low) & ~own) | (ties & (np.cumsum(ties, axis=1) <= k))
                query, at = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[query]), pa.array(ids[at]), pa.array(scores[chosen])],
                    names=["query", "id", "score"],
                )

    return pairs.mapInArrow(batches, "query long, id long, score long")


def _with_state(q_blocks: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with the bounds of their queries, in the order of their ids."""
    ids = q_blocks.select("q_block", F.posexplode("q_list").alias("at", "query"))
    bounds = ids.join(state, "query").groupBy("q_block").agg(
        F.sort_array(F.collect_list(F.struct("at", "low", "width", "span"))).alias("state")
    )

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            states = batch.column(batch.schema.get_field_index("state")).to_pylist()
            arrays = [batch.column(n) for n in names]
            for field in STATE:
                flat = [np.array([s[field] for s in one], np.int64).tobytes() for one in states]
                arrays.append(pa.array(flat, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *STATE])

    names = ["q_block", "size", "q_ids", "q_vectors", "q_norm"]
    schema = "q_block long, size int, q_ids binary, q_vectors binary, q_norm double"
    schema += "".join(f", {field} binary" for field in STATE)
    return q_blocks.join(bounds, "q_block").mapInArrow(packed, schema)


def _pairs(q_blocks: DataFrame, c_blocks: DataFrame, groups: int) -> DataFrame:
    """Every query block beside every candidate block of its vector length: query blocks are
    written once for each group of candidate blocks."""
    spread = q_blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return spread.join(c_blocks, ["part", "size"])


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int, key: str, vector: str, factor: int = 64
) -> DataFrame:
    """(query, rank, id, score): the k candidates of greatest integer inner product."""

    def usable(rows: DataFrame) -> DataFrame:
        made = rows.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector), factor).alias("v"))
        return made.filter("id is not null and v is not null")

    c_blocks = stored(blocks(usable(candidates), BLOCK_ROWS), "candidate-blocks")
    n_blocks, c_norm = c_blocks.agg(F.count("*"), F.max("norm")).first()
    groups = max(1, n_blocks)
    part = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    c_blocks = c_blocks.withColumn("part", part).drop("block")
    q_blocks = stored(blocks(usable(queries).groupBy("id").agg(F.max("v").alias("v")), QUERY_ROWS), "query-blocks")

    def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = [np.frombuffer(i, np.int64) for i in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int64()))],
                names=["q_block", "size", "q_ids", "q_vectors", "q_norm", "q_list"],
            )

    q_blocks = q_blocks.mapInArrow(
        listed,
        "q_block long, size int, q_ids binary, q_vectors binary, q_norm double, q_list array<long>",
    )
    # No product exceeds the product of the norms.
    reach = int((c_norm or 0.0) * (q_blocks.agg(F.max("q_norm")).first()[0] or 0.0)) + 2
    width = -(-(2 * reach + 1) // BINS)
    state = q_blocks.select(F.explode("q_list").alias("query")).select(
        "query",
        F.lit(-reach).cast("long").alias("low"),
        F.lit(width).cast("long").alias("width"),
        F.lit(2 * reach + 1).cast("long").alias("span"),
        F.lit(k).cast("long").alias("wanted"),
    )
    while True:
        pairs = _pairs(_with_state(q_blocks, state), c_blocks, groups)
        counts = _histograms(pairs, k).groupBy("query", "bin").agg(F.sum("n").alias("n"))
        downwards = Window.partitionBy("query").orderBy(F.desc("bin"))
        counts = counts.join(state, "query").withColumn("upto", F.sum("n").over(downwards))
        reached = counts.filter("upto >= wanted and upto - n < wanted").select(
            "query",
            (F.col("low") + F.col("bin") * F.col("width")).alias("found"),
            (F.col("wanted") - (F.col("upto") - F.col("n"))).alias("left"),
        )
        # A query with fewer candidates than wanted keeps its lower bound: all are above it.
        state = stored(
            state.join(reached, "query", "left").select(
                "query",
                F.coalesce("found", "low").alias("low"),
                F.lit(max(1, -(-width // BINS))).cast("long").alias("width"),
                F.lit(width).cast("long").alias("span"),
                F.coalesce("left", "wanted").alias("wanted"),
            ),
            "bounds",
        )
        if width == 1:
            break
        width = -(-width // BINS)
    chosen = _selected(_pairs(_with_state(q_blocks, state), c_blocks, groups), k)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = chosen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query", "rank", "id", "score")
