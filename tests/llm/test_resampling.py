"""Importance resampling: weights, scores and ranks against plain counting."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from helpers import LOWER, documents, prose

from tallyloom.llm import resampling as r
from tallyloom.llm.arrays import text_chunks, token_alphabet

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None) -> list[str]:
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % r.BUCKETS


def brute(docs, items) -> list[tuple]:
    corpus = Counter(bucket(f) for _, t in docs for f in features(t))
    target = Counter(bucket(f) for t in items for f in features(t))
    s_all, t_all = corpus.total() + r.BUCKETS, target.total() + r.BUCKETS

    def gain(b: int) -> int:
        return math.floor(1000 * math.log((target[b] + 1) * float(s_all) / ((corpus[b] + 1) * float(t_all))))

    rows = []
    for i, text in docs:
        name = f"42:{'' if i is None else i}"
        h = int(sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in features(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        n_words = len(WORD.findall((text or "").translate(LOWER)))
        rows.append([i, len(features(text)), weight, score, None, n_words])
    enough = sorted((x for x in rows if x[5] >= 20), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[2]))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(row[:5]) for row in rows), key=str)


def drawn(spark, docs, items, extra=False):
    target = spark.createDataFrame([(n, t) for n, t in enumerate(items)], "item_id long, text string")
    result = r.resample(documents(spark, docs, extra), target)
    return sorted((tuple(row) for row in result.collect()), key=str)


def test_equals_plain_counting(spark):
    docs = [(i, prose(i, 5 + 7 * (i % 20))) for i in range(120)]
    items = [prose(500 + i, 30) for i in range(6)]
    result = drawn(spark, docs, items)
    assert result == brute(docs, items)
    assert sum(row[4] is not None for row in result) == 5 * sum(7 * (i % 20) + 5 >= 20 for i in range(120)) // 100


def test_nulls_empties_ties_repeats_and_long_texts(spark):
    docs = [(1, None), (2, ""), (3, " ., \x00 "), (None, prose(1, 25)), (4, prose(2, 9_000)), (4, prose(2, 9_000))]
    docs += [(5, "x" * 40_000 + " ÄÖ é1 " + "y" * 200), (6, "A-b_c\x00D"), (7, "w " * 5_000)]
    docs += [(10 + i, prose(3, 30)) for i in range(40)]
    items = [prose(3, 30), None, ""]
    assert drawn(spark, docs, items, extra=True) == brute(docs, items)


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, prose(1, 30))]])
def test_empty_tables(spark, docs):
    assert drawn(spark, docs, []) == brute(docs, [])


def test_bit_planes_give_the_sum_of_gains():
    random = np.random.default_rng(1)
    gains = random.integers(-30_000, 20_000, r.BUCKETS)
    counts = random.integers(0, 4, (30, r.BUCKETS)) * random.integers(0, 2, (30, r.BUCKETS))
    counts[3, 17], counts[5] = 1_000_003, 0
    assert r.GainPlanes(gains).weights(counts).tolist() == (counts @ gains).tolist()
    assert r.GainPlanes(gains * 0).weights(counts).tolist() == [0] * 30


def test_features_of_texts_that_touch():
    import pyarrow as pa

    texts = ["ab cd", "ef", "", None, "Gh1 é", "x" * 70 + " y z"]
    (chunk,) = text_chunks(pa.array(texts))
    found = r.Features(chunk, token_alphabet(), r._crc_table())
    for i, text in enumerate(texts):
        assert sorted(found.bucket[found.text == i].tolist()) == sorted(map(bucket, features(text)))
