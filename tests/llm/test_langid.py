"""Language identification: gradients, tables, held-out accuracy, defined cases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import langid
from tallyloom.llm.arrays import text_chunks
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"aa": ["kavo", "kelu", "kimo"], "bb": ["zhep", "shun", "thop"], "cc": ["žluť", "čára", "řeka"]}


def labelled(n: int, lang: str, first: int = 0) -> list[tuple]:
    random = np.random.default_rng(first + 1)
    texts = (" ".join(random.choice(WORDS[lang], 3 + i % 60)) for i in range(n))
    return [(first + i, t, lang, "s", len(t)) for i, t in enumerate(texts)]


def predicted(spark, rows, extra: dict | None = None):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in extra or ():
        docs = docs.withColumn(name, F.lit(extra[name]))
    result = langid.predict_languages(docs, langid.fit_languages(docs))
    return {r.doc_id: (r.lang_pred, r.score) for r in result.collect()}


def plain_probabilities(network: langid.Network, window: np.ndarray) -> np.ndarray:
    """One window, every place and filter by itself."""
    w = {name: v.astype(float) for name, v in network.weights.items()}
    pooled = []
    for width in langid.WIDTHS:
        found = []
        for at in range(len(window) - width + 1):
            run = np.concatenate([w["embedding"][b] for b in window[at : at + width]])
            found.append(run @ w[f"filter{width}"] + w[f"offset{width}"])
        pooled.append(np.maximum(np.max(found, axis=0), 0))
    values = np.concatenate(pooled) @ w["softmax"] + w["prior"]
    return np.exp(values) / np.exp(values).sum()


@pytest.fixture
def network():
    made = langid.Network.untrained(3)
    random = np.random.default_rng(5)
    for name in made.weights:
        made.weights[name] += random.normal(0, 0.1, made.weights[name].shape).astype(np.float32)
    return made


def windows(n: int) -> np.ndarray:
    return np.random.default_rng(2).integers(0, 256, (n, langid.WINDOW)).astype(np.uint8)


def test_tables_give_the_plain_convolution(network):
    some = windows(5)
    expected = np.array([plain_probabilities(network, w) for w in some])
    assert np.allclose(langid.Tables(network).probabilities(some), expected, atol=1e-4)


def test_gradients_equal_differences(network):
    some, classes = windows(4), np.array([0, 1, 2, 1])
    network.weights = {name: w.astype(float) for name, w in network.weights.items()}

    def loss() -> float:
        return -np.mean([np.log(plain_probabilities(network, w)[c]) for w, c in zip(some, classes, strict=True)])

    gradients = network.gradients(some, classes)
    random = np.random.default_rng(3)
    for name, weight in network.weights.items():
        for _ in range(6):
            at = tuple(random.integers(0, s) for s in weight.shape)
            if name == "embedding":
                at = (some[0, random.integers(langid.WINDOW)], at[1])
            kept, step = weight[at], 1e-5
            weight[at] = kept + step
            up = loss()
            weight[at] = kept - step
            down = loss()
            weight[at] = kept
            assert gradients[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-5)


def test_windows_cover_every_run_of_a_text():
    """What stands only at the very end of a long text, or across two windows, counts."""
    seen = []

    class Spy:
        def probabilities(self, windows):
            seen.extend(bytes(w) for w in windows)
            return np.ones((len(windows), 2)) / 2

    text = "".join(chr(97 + i % 26) + str(i) for i in range(400))
    (chunk,) = text_chunks(pa.array([text, "ab"]))
    langid.LanguageModel(("x", "y"), None).predict(chunk, Spy())
    for at in range(len(text) - 3):
        assert any(text[at : at + 4].encode() in w for w in seen)


def test_learns_from_rows_that_are_not_held_out(spark):
    rows = labelled(150, "aa") + labelled(150, "bb", 200) + labelled(40, "cc", 400)
    # Held-out rows have wrong labels here: nothing may be learned from them.
    docs = spark.createDataFrame(rows, SCHEMA)
    held = [r.doc_id for r in docs.filter(~langid.may_learn("doc_id")).collect()]
    wrong = [(i, t, "dd" if i in held else lang, s, n) for i, t, lang, s, n in rows]
    result = predicted(spark, wrong, {"lang_pred": "x", "window": 1, "cut": "y", "score": 2.0})
    truth = {r[0]: r[2] for r in rows}
    assert len(held) > 40
    assert np.mean([result[i][0] == truth[i] for i in held]) > 0.97
    assert all(0 <= score <= 1 for _, score in result.values())


def test_nulls_no_letters_ties_long_texts_and_repeats(spark):
    rows = labelled(60, "aa") + labelled(60, "bb", 100)
    odd = [
        (900, None, "aa", "s", None), (901, "", "bb", "s", 0), (902, "12 34 !?", "aa", "s", 8),
        (903, "kavo kelu " * 30_000, None, None, None), (904, "č", None, "s", 1), (905, "× ÷ €", "aa", "s", 5),
        (None, "zhep shun thop", "aa", "s", 14), (906, "zhep shun", "bb", "s", 9), (906, "zhep shun", "bb", "s", 9),
    ]
    result = predicted(spark, rows + odd)
    for i in (900, 901, 902, 905):
        assert result[i] == ("und", 0.0)
    assert result[903][0] == "aa" and result[904][0] in ("aa", "bb") and result[None][0] == "bb"
    assert len(result) == len(rows) + len(odd) - 1


def test_one_language_none_and_no_rows(spark):
    one = predicted(spark, labelled(9, "aa"))
    assert set(one.values()) == {("aa", 1.0)}
    none = predicted(spark, [(1, "kavo", None, "s", 4), (2, None, None, "s", None)])
    assert set(none.values()) == {("und", 0.0)}
    assert predicted(spark, []) == {}


def test_held_out_accuracy_on_the_documents(spark, sf_dir):
    result = QUERIES["op11_language_id"](spark, sf_dir).withColumnRenamed("doc_id", "id")
    docs = table(spark, sf_dir, "documents")
    right = result.join(docs, F.col("id") == F.col("doc_id")).filter("held_out and lang is not null")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
