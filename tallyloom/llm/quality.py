"""Quality classifier: random Fourier features over document statistics, ridge, isotonic.

Statistics of a text (shares of kinds of characters, word shapes, repetition) are taken
from its bytes, standardised, and mapped to cosines of random projections, whose inner
products approximate a Gaussian kernel. Ridge scores solve the normal equations, which are
sums over rows: every partition adds up its own, and the few sums are added on the driver.
Isotonic regression over the scores of a part of the rows not used in the equations turns
a score into the share of good texts at that score; between its steps it is interpolated,
so that the order of scores is kept.

Labels come from a bounded sample (`FIT_ROWS`) of rows that are not held out; nothing but
the text enters a score.

Defined cases: null and empty texts have all-zero statistics and are scored like any other;
whole texts count, however long; repeated rows score alike; null labels teach nothing;
labels of one kind only, or none, give every text that share (one half without labels); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Chunk, mix, prefix_hashes, span_hashes, symbol_codes, text_chunks
from tallyloom.llm.arrays import word_alphabet, words
from tallyloom.llm.tables import learns, stored

FIT_ROWS = 40_000
FIT_PARTITIONS = 12
FOURIER_FEATURES = 256
KERNEL_WIDTH = 4.0
RIDGE = 1e-3
CALIBRATION_SHARE = 4  # one row in so many calibrates
SEED = 20


def _kinds() -> dict[str, np.ndarray]:
    """Tables over byte values, one for each kind of character counted."""
    ascii_ = [chr(b) if b < 128 else "" for b in range(256)]

    def table(test) -> np.ndarray:
        return np.array([bool(c) and test(c) for c in ascii_])

    return {
        "upper": table(str.isupper),
        "lower": table(str.islower),
        "digit": table(str.isdigit),
        "space": table(lambda c: c in " \t"),
        "line": table(lambda c: c == "\n"),
        "stop": table(lambda c: c in ".,;:?"),
        "shout": table(lambda c: c == "!"),
        "bar": table(lambda c: c in "|<>{}[]=_\\/"),
        "sign": table(lambda c: c in "#$%&*+@^~"),
        "quote": table(lambda c: c in "\"'()-"),
        "other": np.arange(256) >= 128,
    }


KINDS = _kinds()
STATISTICS = (
    "chars", "words", "word_length", "word_spread", "long_words", "short_words",
    "distinct_words", "top_word", "repeated_fives", "lines", "line_length", "repeated_lines",
    "last_stop", *KINDS,
)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def _repeats(hashes: np.ndarray, bounds: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: the share of its hashes that are distinct, and of its commonest hash."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    distinct, top = np.ones(n), np.zeros(n)
    if len(hashes):
        order = np.lexsort((hashes, text))
        h, t = hashes[order], text[order]
        new = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))
        first = np.flatnonzero(new)
        runs = np.diff(np.append(first, len(h)))
        kinds = np.bincount(t[first], minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, t[first], runs)
        some = size > 0
        distinct[some] = kinds[some] / size[some]
        top[some] = most[some] / size[some]
    return distinct, top


def statistics(chunk: Chunk, alphabet: np.ndarray) -> np.ndarray:
    """One row of statistics for each text of a chunk."""
    data, bounds = chunk.data, chunk.bounds
    n = len(bounds) - 1
    if not len(data):
        return np.zeros((n, len(STATISTICS)))
    size = np.maximum(np.diff(bounds), 1).astype(float)
    found = words(chunk, alphabet)
    per = np.diff(found.bounds)
    count = np.maximum(per, 1).astype(float)
    text = np.repeat(np.arange(n), per)
    length = (found.ends - found.starts).astype(float)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=values, minlength=n)[:n] / count

    average = mean(length)
    spread = np.sqrt(np.maximum(mean(length**2) - average**2, 0.0))
    distinct, top = _repeats(found.hashes, found.bounds, text)
    # Five words in a row, within a text.
    inside = np.flatnonzero(np.arange(len(text)) + 4 < found.bounds[text + 1]) if len(text) else text
    fives = mix(sum((found.hashes[inside + i] * np.uint64(2 * i + 3) for i in range(5)), np.uint64(0)))
    five_text = text[inside]
    five_bounds = np.searchsorted(five_text, np.arange(n + 1))
    distinct_fives, _ = _repeats(fives, five_bounds, five_text)
    # Lines: what lies between line feeds, by hash.
    feeds = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([bounds[:-1][np.diff(bounds) > 0], feeds + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    home = np.searchsorted(bounds, starts, side="right") - 1
    sums = prefix_hashes(symbol_codes()[data])
    lines = mix(span_hashes(sums, starts, ends - ((ends > starts) & (data[ends - 1] == 10))))
    line_bounds = np.searchsorted(home, np.arange(n + 1))
    distinct_lines, _ = _repeats(lines, line_bounds, home)
    n_lines = np.maximum(np.diff(line_bounds), 1).astype(float)
    last = np.zeros(n)
    some = np.diff(bounds) > 0
    last[some] = KINDS["stop"][data[bounds[1:][some] - 1]]
    columns = [
        np.log1p(np.diff(bounds)), np.log1p(per), average, spread, mean(length > 14),
        mean(length <= 3), distinct, top, 1 - distinct_fives, np.log1p(n_lines),
        np.log1p(size / n_lines), 1 - distinct_lines, last,
    ]
    columns += [_per_text(member[data], bounds) / size for member in KINDS.values()]
    out = np.column_stack(columns)
    out[~some] = 0.0
    return out


def projections() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    directions = random.normal(0.0, 1.0 / KERNEL_WIDTH, (len(STATISTICS), FOURIER_FEATURES))
    return directions, random.uniform(0.0, 2 * np.pi, FOURIER_FEATURES)


def fourier(values: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosine features of standardised statistics, and a constant."""
    directions, phases = projections()
    standard = np.clip((values - centre) / scale, -8.0, 8.0)
    cosines = np.sqrt(2.0 / FOURIER_FEATURES) * np.cos(standard @ directions + phases)
    return np.hstack([cosines, np.ones((len(values), 1))])


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, ridge weights, and the calibration curve's points."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    curve_at: np.ndarray
    curve: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        raw = fourier(values, self.centre, self.scale) @ self.weights
        return np.clip(np.interp(raw, self.curve_at, self.curve), 0.0, 1.0)


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean place and mean label of every pooled block, rising."""
    order = np.argsort(values, kind="stable")
    blocks: list[list[float]] = []  # label sum, place sum, count
    for at, label in zip(values[order].tolist(), labels[order].tolist(), strict=True):
        blocks.append([label, at, 1.0])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][2] >= blocks[-1][0] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks)
    return sums[:, 1] / sums[:, 2], sums[:, 0] / sums[:, 2]


def _statistics_of(texts: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and an array of statistics for every row of (.., text)."""
    at = texts.columns.index("text")
    fields = [texts.schema[name] for name in keep]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    places = [texts.columns.index(name) for name in keep]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        for batch in rows:
            for chunk in text_chunks(batch.column(at)):
                values = statistics(chunk, alphabet)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1])
                kept = [batch.column(p).slice(chunk.first, chunk.last - chunk.first) for p in places]
                yield pa.RecordBatch.from_arrays(
                    [*kept, lists.cast(pa.list_(pa.float64()))], names=[*keep, "stats"]
                )

    return texts.mapInArrow(batches, f"{schema}, stats array<double>")


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)


def _sums(rows: DataFrame, part) -> list[np.ndarray]:
    """part(statistics, labels) summed over a partition, then over the few partitions."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            if batch.num_rows:
                labels = batch.column(0).to_numpy().astype(float)
                mine = part(_matrix(batch, 1), labels)
                total = mine if total is None else [a + b for a, b in zip(total, mine, strict=True)]
        if total is not None:
            flat = np.concatenate([np.ravel(t) for t in total])
            yield pa.RecordBatch.from_arrays([pa.array([flat])], names=["sums"])

    parts = rows.select("label", "stats").mapInArrow(batches, "sums array<double>").collect()
    shapes = part(np.zeros((1, len(STATISTICS))), np.zeros(1))
    flat = np.sum([p.sums for p in parts], axis=0)
    cuts = np.cumsum([np.size(s) for s in shapes])[:-1]
    return [piece.reshape(np.shape(s)) for piece, s in zip(np.split(flat, cuts), shapes, strict=True)]


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """Learn from at most FIT_ROWS labelled rows that are not held out."""
    known = labels.filter(learns("doc_id") & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    # The rows least in a hash order: a bounded number, whose ids may be broadcast.
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    picked = picked.withColumnRenamed("doc_id", "picked")
    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    sample = texts.join(F.broadcast(picked), F.col("doc") == F.col("picked"))
    sample = _statistics_of(sample.select("doc", "label", "text"), ["doc", "label"])
    sample = sample.withColumn("calibrates", F.pmod(F.xxhash64("doc", F.lit(SEED)), F.lit(CALIBRATION_SHARE)) == 0)
    # One partition count whatever the size: the rows are bounded.
    sample = stored(sample.repartition(FIT_PARTITIONS, "doc"), "quality-sample")
    none = np.zeros(len(STATISTICS))
    shares = sample.agg(F.count("*"), F.avg("label")).first()
    if not shares[0] or shares[1] in (0.0, 1.0):
        flat = np.full(2, 0.5 if not shares[0] else shares[1])
        return QualityModel(none, none + 1, np.zeros(FOURIER_FEATURES + 1), np.array([-1.0, 1.0]), flat)
    fitted, calibrating = sample.filter("not calibrates"), sample.filter("calibrates")
    if fitted.isEmpty() or calibrating.isEmpty():
        fitted = calibrating = sample
    count, total, squares = _sums(fitted, lambda x, y: [np.array([len(x)]), x.sum(0), (x**2).sum(0)])
    centre = total / count
    scale = np.sqrt(np.maximum(squares / count - centre**2, 0.0))
    scale = np.where(scale > 1e-9, scale, 1.0)

    def equations(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        z = fourier(x, centre, scale)
        return [z.T @ z, z.T @ y]

    gram, target = _sums(fitted, equations)
    penalty = RIDGE * count * np.eye(FOURIER_FEATURES + 1)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(gram + penalty, target)
    rows = calibrating.select("label", "stats").collect()
    raw = fourier(np.array([r.stats for r in rows]), centre, scale) @ weights
    at, curve = isotonic(raw, np.array([r.label for r in rows], float))
    # Beyond its first and last block the curve goes on to 0 and 1, so that scores differ.
    at = np.concatenate([[at[0] - 1.0], at, [at[-1] + 1.0]])
    curve = np.concatenate([[0.5 * curve[0]], curve, [0.5 + 0.5 * curve[-1]]])
    return QualityModel(centre, scale, weights, at, curve)


def score_quality(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.last - chunk.first),
                        pa.array(model.scores(statistics(chunk, alphabet))),
                    ],
                    names=[key, "score"],
                )

    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()
    return narrow.mapInArrow(batches, f"{key} {kind}, score double")


def good_documents(docs: DataFrame, model: QualityModel, threshold: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores at least the threshold."""
    at = docs.columns.index(text)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = word_alphabet()
        for batch in rows:
            for chunk in text_chunks(batch.column(at)):
                keep = model.scores(statistics(chunk, alphabet)) >= threshold
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(batches, docs.schema)
