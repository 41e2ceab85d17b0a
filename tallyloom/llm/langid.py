"""Language identification by a small convolutional network over bytes.

Bytes are embedded; filters of several widths run over windows of a fixed length; the
largest response of every filter in a window (at least 0) goes to a softmax over the languages.
A text is cut into windows that overlap by the widest filter less one byte, so every run of
bytes a filter can see lies in some window; the mean of the windows' probabilities, weighted by
their bytes, is the text's. Training is plain numpy (gradients by hand, Adam) on the driver,
over a bounded sample: `LANGUAGE_ROWS` labelled texts of each language, least in a hash
order, and `SAMPLE_WINDOWS` windows of each, spread over the whole text. For prediction the
embedding and the filters are multiplied out once into tables by byte and by pair of bytes,
so that a convolution is a few look-ups.

Defined cases: a null text, or one without any letter, is `und` with score 0; empty texts
too; whole texts count, however long; equal probabilities go to the language first in byte
order; repeated rows are predicted alike; null labels and null ids teach nothing; a single
learned language is always predicted; without any, every text is `und`; an empty table
gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Chunk, text_chunks

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 12

LANGUAGE_ROWS = 400
SAMPLE_WINDOWS = 4
EPOCHS = 8
BATCH = 64
RATE = 0.004
SEED = 11

UNKNOWN = "und"
WINDOWS_AT_ONCE = 512


def cut_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of WINDOW bytes from every start; 0 beyond its end."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], np.uint8(0))


@dataclass
class Network:
    """Weights by name: embedding, one matrix and offset for each width, and the softmax's."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def untrained(classes: int) -> Network:
        random = np.random.default_rng(SEED)
        weights = {"embedding": random.normal(0, 0.5, (256, EMBEDDING))}
        for width in WIDTHS:
            size = width * EMBEDDING
            weights[f"filter{width}"] = random.normal(0, size**-0.5, (size, FILTERS))
            weights[f"offset{width}"] = np.zeros(FILTERS)
        pooled = FILTERS * len(WIDTHS)
        weights["softmax"] = random.normal(0, pooled**-0.5, (pooled, classes))
        weights["prior"] = np.zeros(classes)
        return Network({name: w.astype(np.float32) for name, w in weights.items()})

    def gradients(self, windows: np.ndarray, classes: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of a batch of windows."""
        w, n = self.weights, len(windows)
        embedded = w["embedding"][windows]
        pooled, best = [], []
        for width in WIDTHS:
            runs = np.lib.stride_tricks.sliding_window_view(embedded, width, axis=1)
            runs = runs.transpose(0, 1, 3, 2).reshape(n, -1, width * EMBEDDING)
            response = runs @ w[f"filter{width}"] + w[f"offset{width}"]
            at = response.argmax(axis=1)
            best.append((at, np.take_along_axis(runs, at[:, :, None], axis=1)))
            pooled.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
        seen = np.maximum(np.hstack(pooled), 0)
        error = softmax(seen @ w["softmax"] + w["prior"])
        error[np.arange(n), classes] -= 1
        error /= n
        out = {"softmax": seen.T @ error, "prior": error.sum(0), "embedding": np.zeros_like(w["embedding"])}
        back = (error @ w["softmax"].T) * (seen > 0)
        for k, width in enumerate(WIDTHS):
            at, runs = best[k]  # only the place of the largest response takes part
            mine = back[:, k * FILTERS : (k + 1) * FILTERS]
            out[f"filter{width}"] = np.einsum("nfs,nf->sf", runs, mine)
            out[f"offset{width}"] = mine.sum(0)
            step = mine[:, :, None] * w[f"filter{width}"].T
            rows = np.take_along_axis(windows[:, None, :], at[:, :, None] + np.arange(width), axis=2)
            np.add.at(out["embedding"], rows.ravel(), step.reshape(-1, EMBEDDING))
        return out

    def train(self, windows: np.ndarray, classes: np.ndarray) -> None:
        """Adam over shuffled batches; some windows are cut short, as short texts are."""
        random = np.random.default_rng(SEED)
        mean = {name: np.zeros_like(w) for name, w in self.weights.items()}
        square = {name: np.zeros_like(w) for name, w in self.weights.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = random.permutation(len(windows))
            for first in range(0, len(order), BATCH):
                some = order[first : first + BATCH]
                batch = windows[some].copy()
                length = np.where(random.random(len(some)) < 0.4, random.integers(12, WINDOW, len(some)), WINDOW)
                batch[np.arange(WINDOW) >= length[:, None]] = 0
                step += 1
                for name, g in self.gradients(batch, classes[some]).items():
                    mean[name] += 0.1 * (g - mean[name])
                    square[name] += 0.001 * (g * g - square[name])
                    move = (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] -= (rate * move).astype(np.float32)


def softmax(values: np.ndarray) -> np.ndarray:
    e = np.exp(values - values.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Tables:
    """The network with embedding and filters multiplied out by byte and by pair of bytes."""

    def __init__(self, network: Network):
        w = network.weights
        self.softmax, self.prior = w["softmax"], w["prior"]
        self.steps: list[list[tuple[int, np.ndarray]]] = []  # for each width: (offset, table)
        for width in WIDTHS:
            parts = w[f"filter{width}"].reshape(width, EMBEDDING, FILTERS)
            by_byte = [w["embedding"] @ part for part in parts]
            by_byte[0] = by_byte[0] + w[f"offset{width}"]
            steps = []
            for at in range(0, width - 1, 2):
                pairs = by_byte[at][:, None, :] + by_byte[at + 1][None, :, :]
                steps.append((at, np.ascontiguousarray(pairs.reshape(65536, FILTERS))))
            if width % 2:
                steps.append((width - 1, by_byte[-1]))
            self.steps.append(steps)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.uint16) << np.uint16(8) | windows[:, 1:]
        pooled = []
        for width, steps in zip(WIDTHS, self.steps, strict=True):
            places = WINDOW - width + 1
            response = None
            for at, table in steps:
                codes = pairs if len(table) > 256 else windows
                found = table[codes[:, at : at + places]]
                response = found if response is None else np.add(response, found, out=response)
            pooled.append(response.max(axis=1))
        return softmax(np.maximum(np.hstack(pooled), 0) @ self.softmax + self.prior)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    network: Network | None

    def predict(self, chunk: Chunk, tables: Tables | None) -> tuple[list[str], np.ndarray]:
        """The language and its probability for every text of a chunk."""
        texts = len(chunk.bounds) - 1
        known = has_letters(chunk)
        share = np.zeros((texts, max(len(self.languages), 1)))
        if tables is not None and len(chunk.data):
            first, last = chunk.bounds[:-1], chunk.bounds[1:]
            stride = WINDOW - max(WIDTHS) + 1
            per = np.where(known, np.maximum(-(-(last - first - max(WIDTHS) + 1) // stride), 1), 0)
            text = np.repeat(np.arange(texts), per)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
            starts = first[text] + nth * stride
            for a in range(0, len(text), WINDOWS_AT_ONCE):
                some = slice(a, a + WINDOWS_AT_ONCE)
                windows = cut_windows(chunk.data, starts[some], last[text[some]])
                size = np.minimum(last[text[some]] - starts[some], WINDOW)
                np.add.at(share, text[some], tables.probabilities(windows) * size[:, None])
        elif len(self.languages) == 1:
            share[known] = 1.0
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        sure = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1e-300), 0.0)
        names = [self.languages[b] if t > 0 else UNKNOWN for b, t in zip(best, total, strict=True)]
        return names, np.clip(sure, 0.0, 1.0)


def has_letters(chunk: Chunk) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    upper = chunk.data & np.uint8(0xDF)
    letters = np.concatenate([[0], np.cumsum((upper >= 65) & (upper <= 90))])
    out = letters[chunk.bounds[1:]] > letters[chunk.bounds[:-1]]
    for i in np.flatnonzero(~out & (np.diff(chunk.bounds) > 0)):
        raw = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]
        if (raw >= 128).any():
            out[i] = any(map(str.isalpha, raw.tobytes().decode(errors="ignore")))
    return out


def may_learn(doc_id: Column | str) -> Column:
    """Rows whose language a model may see; the others, and null ids, are held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) != 2, F.lit(False))


def _sample_windows(sample: DataFrame) -> DataFrame:
    """(lang, window) of SAMPLE_WINDOWS windows spread evenly over each text (lang, text)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                if not len(chunk.data):
                    continue
                some = np.flatnonzero(has_letters(chunk))
                first, last = chunk.bounds[some], chunk.bounds[some + 1]
                room = np.maximum(last - first - WINDOW, 0)
                spread = np.arange(SAMPLE_WINDOWS) / (SAMPLE_WINDOWS - 1)
                starts = (first[:, None] + (room[:, None] * spread).astype(np.int64)).ravel()
                windows = cut_windows(chunk.data, starts, np.repeat(last, SAMPLE_WINDOWS))
                home = pa.array(chunk.first + np.repeat(some, SAMPLE_WINDOWS))
                cut = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(WINDOW), len(windows), [None, pa.py_buffer(np.ascontiguousarray(windows).tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(home), cut.cast(pa.binary())], names=["lang", "cut"]
                )

    return sample.mapInArrow(batches, "lang string, cut binary")


def fit_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from LANGUAGE_ROWS texts of every language, none of them held out.

    The ids of the sample may be broadcast, and its windows reach the driver: at most
    LANGUAGE_ROWS * SAMPLE_WINDOWS windows of WINDOW bytes for each language.
    """
    labelled = docs.filter(may_learn(key) & F.col(lang).isNotNull())
    ids = labelled.select(F.col(key).alias("_id"), F.col(lang).cast("string").alias("_lang"))
    # As many rows as there are languages, which the model holds too.
    sizes = F.broadcast(ids.groupBy(F.col("_lang").alias("_of")).agg(F.count("*").alias("_n")))
    place = F.xxhash64("_id", F.lit(SEED))
    # Four times the rows wanted pass by their hash, however many a language has.
    passes = F.pmod(place, F.lit(1 << 31)) * F.col("_n") < 4 * LANGUAGE_ROWS * (1 << 31)
    few = ids.join(sizes, F.col("_lang") == F.col("_of")).filter(passes)
    order = Window.partitionBy("_lang").orderBy(place, "_id")
    picked = few.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= LANGUAGE_ROWS)
    picked = F.broadcast(picked.select("_id", "_lang").distinct())
    texts = labelled.select(F.col(key).alias("_doc"), F.col(lang).cast("string").alias("_of"), F.col(text).alias("text"))
    sample = texts.join(picked, (F.col("_doc") == F.col("_id")) & (F.col("_of") == F.col("_lang")), "left_semi")
    rows = _sample_windows(sample.select("_of", "text")).collect()
    rows = sorted({(row.lang, bytes(row.cut)) for row in rows})
    languages = tuple(sorted({name for name, _ in rows}, key=str.encode))
    if len(languages) < 2:
        return LanguageModel(languages, None)
    number = {name: i for i, name in enumerate(languages)}
    classes = np.array([number[name] for name, _ in rows])
    windows = np.frombuffer(b"".join(cut for _, cut in rows), np.uint8).reshape(-1, WINDOW)
    # Rare languages count as much as common ones.
    share = np.bincount(classes)
    again = np.concatenate(
        [np.resize(np.flatnonzero(classes == c), share.max()) for c in range(len(languages))]
    )
    network = Network.untrained(len(languages))
    network.train(windows[again], classes[again])
    return LanguageModel(languages, network)


def predict_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(model.network) if model.network else None
        for batch in rows:
            for chunk in text_chunks(batch.column(1)):
                names, sure = model.predict(chunk, tables)
                kept = batch.column(0).slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [kept, pa.array(names, pa.string()), pa.array(sure)], names=[key, "lang_pred", "score"]
                )

    return narrow.mapInArrow(batches, f"{key} {kind}, lang_pred string, score double")
