from __future__ import annotations

import random

import numpy as np
from helpers import documents, prose, without_repeats
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import suffixes


def found(df):
    return {r.doc: (r.n_spans, bytes(r.kept)) for r in df.collect()}


def test_equals_looking_every_window_up(spark):
    rng = random.Random(4)
    passages = [prose(700 + i, 12) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i * 31 + j, rng.randint(1, 30)) for j in range(3)]
        for _ in range(rng.randint(0, 3)):
            whole = rng.choice(passages)
            cut = rng.randint(0, len(whole) // 2)
            parts.insert(rng.randint(0, 3), whole[cut : cut + rng.randint(30, 90)])
        rows.append((i * 3 % 61, "".join(parts)))
    rows += [(200 + i, rows[5][1]) for i in range(4)]
    texts = dict(rows)
    assert found(suffixes.remove_repeats(documents(spark, rows))) == without_repeats(texts)


def test_edge_cases(spark):
    line = "=" * 400
    exact = "x" * 20 + "unique middle of exactly thirty"[:30]
    long = prose(1, 30_000)
    rows = [
        (1, None), (2, ""), (3, "short"), (4, "short"), (5, exact), (6, exact), (7, exact[:-1]),
        (8, line), (9, "a" + line + "b"), (10, line[:49]), (11, "é" * 60), (12, "zé" + "é" * 40),
        (13, long), (14, "new start " + long[1000:150_000]),
    ]
    result = suffixes.remove_repeats(documents(spark, rows, extra=True))
    assert found(result) == without_repeats(dict(rows))


def test_repeats_inside_one_document_stay(spark):
    text = prose(2, 40)
    rows = [(1, text + text), (1, text + text)]
    result = suffixes.remove_repeats(documents(spark, rows)).collect()
    assert [r.n_removed for r in result] == [0, 0]


def test_hot_anchors_are_settled_by_windows_alike(spark):
    """A passage in every document with other neighbours in each, cut at both ends in some."""
    rng = random.Random(9)
    passage = prose(50, 20)
    rows = []
    for i in range(40):
        a, b = rng.choice([(0, 0), (0, 7), (5, 0), (30, 30)])
        rows.append((i * 7 % 41, prose(900 + i, 6) + passage[a : len(passage) - b] + prose(990 + i, 6)))
    rows += [(100, passage[:49]), (101, passage[:50]), (102, "é" * 60), (103, "zé" + "é" * 40)]
    texts, docs = dict(rows), documents(spark, rows)
    expected = without_repeats(texts)
    for sort_rows in (0, 3, 30):
        assert found(suffixes.remove_repeats(docs, sort_rows=sort_rows)) == expected


def test_different_texts_under_one_id_are_judged_apart(spark):
    one, other, third = prose(3, 40), prose(4, 40), prose(5, 40)
    rows = [(1, one), (2, one + third), (2, other), (2, None), (2, other), (3, other + third)]
    for sort_rows in (0, suffixes.SORT_ROWS):
        result = suffixes.remove_repeats(documents(spark, rows), sort_rows=sort_rows).collect()
        left = sorted((r.doc, bytes(r.kept)) for r in result)
        smaller = {1: {}, 2: {1: one}, 3: {1: one, 2: one + third + "\x00" * 60 + other}}
        expected = sorted(
            (i, without_repeats({**smaller[i], i: text})[i][1]) for i, text in rows
        )
        assert left == expected
    assert any(doc == 2 and kept == other.encode() for doc, kept in left)


def test_null_id_and_no_rows(spark):
    text = prose(2, 40)
    result = suffixes.remove_repeats(documents(spark, [(None, text), (3, text)])).collect()
    assert [r.n_removed for r in result] == [0, 0]
    assert suffixes.remove_repeats(documents(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=12)), max_size=40))
def test_suffix_order_equals_a_plain_sort(rows):
    rows = sorted((g, bytes(b"ab"[c % 2] for c in s)) for g, s in rows)
    random.Random(len(rows)).shuffle(rows)
    rows.sort(key=lambda r: r[0])
    group = np.array([g for g, _ in rows], np.int64)
    strings = [s for _, s in rows]
    made = suffixes.SuffixOrder(strings, group)
    ordered = [(int(group[i]), strings[i]) for i in made.order]
    assert ordered == sorted(rows)
    for n in range(1, len(ordered)):
        (ga, a), (gb, b) = ordered[n - 1], ordered[n]
        shared = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert made.common[n] == (shared if ga == gb else 0)


def test_a_hash_collision_is_noticed(monkeypatch):
    """With a hash that tells nothing apart, byte verification restores the order."""
    monkeypatch.setattr(suffixes, "symbol_codes", lambda: np.zeros(256, np.uint64))
    strings = [b"b", b"a", b"ba", b"ab"]
    made = suffixes.SuffixOrder(strings, np.zeros(4, np.int64))
    assert [strings[i] for i in made.order] == sorted(strings)
    assert made.common.tolist() == [0, 1, 0, 1]


def test_one_shuffle_of_the_texts_serves_both_joins(spark, sf_dir):
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = suffixes.remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
        execution = made._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        assert "ReusedExchange" in execution.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        if before is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
