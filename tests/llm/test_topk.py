from __future__ import annotations

import math
import random

from tallyloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, part string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "s", "p") for i, v in vectors], SCHEMA)


def brute(queries, candidates, k):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    def ints(v):
        import numpy as np

        return [math.floor(64 * float(np.float32(x))) for x in v]

    out = []
    for q, qv in {i: v for i, v in queries if i is not None and usable(v)}.items():
        scored = [
            (-sum(a * b for a, b in zip(ints(qv), ints(v), strict=True)), i)
            for i, v in candidates
            if i is not None and i != q and usable(v) and len(v) == len(qv)
        ]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query, r["rank"], r.id, r.score) for r in df.collect())


def test_equals_sorting_all_scores(spark, monkeypatch):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(150)]
    rng.shuffle(vectors)
    rows = frame(spark, vectors)
    queries = rows.filter("vec_id % 20 = 0")
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "BINS", 16)
    expected = brute([v for v in vectors if v[0] % 20 == 0], vectors, 7)
    assert found(topk.top_k(queries, rows, 7, "vec_id", "embedding")) == expected


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 0.5]), (2, [0.5, 1.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [0.0, 0.0]), (9, [0.0, 0.0]), (None, [1.0, 1.0]),
        (10, [-1.0, -1.0]), (11, [1e4, -1e4]),
    ]
    rows = frame(spark, vectors)
    assert found(topk.top_k(rows, rows, 3, "vec_id", "embedding")) == brute(vectors, vectors, 3)
    assert found(topk.top_k(rows.limit(0), rows, 3, "vec_id", "embedding")) == []
    assert found(topk.top_k(rows, rows.limit(0), 3, "vec_id", "embedding")) == []


def test_huge_values_and_repeated_queries(spark):
    """What might not fit 64 bits takes no part; large values that do are exact."""
    vectors = [
        (1, [1.0, 0.5]), (2, [1e8, 1.0]), (3, [1e30, 1.0]), (4, [-1e300, 1e300]), (5, [2e7, 3.0]), (6, [2e7 + 0.25, -5.0]),
        (7, [0.25, 0.75]), (7, [0.5, -0.75]), (7, [0.5, -1.0]),
    ]
    fitting = [v for v in vectors if sum(64 * x * 64 * x for x in v[1]) < 2.0**61]
    assert [i for i, _ in fitting] == [1, 5, 6, 7, 7, 7]
    expected = brute([(i, v) for i, v in fitting if (i, v) not in (vectors[6], vectors[8])], fitting, 4)
    for parts in (1, 3):
        rows = frame(spark, vectors).repartition(parts)
        assert found(topk.top_k(rows, rows, 4, "vec_id", "embedding")) == expected
