from __future__ import annotations

import random
import re
from itertools import combinations

from helpers import documents, edited, prose

from tallyloom.llm import decontaminate as d

TOKEN = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def tokens(text):
    return TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """Every pair with a long enough stretch of matching words on any diagonal."""
    out = set()
    for i, text in docs:
        own = tokens(text)
        for j, other_text in items:
            other = tokens(other_text)
            for g in range(-len(other) + 1, len(own)):
                first, last = max(g, 0), min(g + len(other), len(own))
                sums = [0]
                for x in range(first, last):
                    sums.append(sums[-1] + (own[x] == other[x - g]))
                if sums[-1] >= min(d.MIN_MATCHES, len(other)) and any(
                    d.enough(sums[e] - sums[b], e - b, len(other)) for e in range(1, len(sums)) for b in range(e)
                ):
                    out.add((i, j))
    return out


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(df):
    return {(r.doc, r["item"]) for r in df.collect()}


def test_equals_comparing_every_diagonal(spark):
    rng = random.Random(1)
    items = [(i, prose(60 + i, 16 + 2 * i)) for i in range(12)]
    docs = []
    for i in range(60):
        words = prose(1000 + i, 40).split(" ")
        if i % 2:
            passage = edited(items[i % 12][1], i, 0.02 * (i % 9)).upper()
            words[20:20] = passage.split(" ")[rng.randint(0, 4) :]
        docs.append((i, " ".join(words)))
    result = found(d.contaminations(documents(spark, docs), items_frame(spark, items)))
    assert result == brute(docs, items)
    assert len(result) > 10


def test_the_masks_see_what_they_are_said_to_see():
    for n, changes in ((11, 1), (12, 2), (15, 3)):
        for places in combinations(range(n), changes):
            equal = [i not in places for i in range(n)]
            assert any(
                all(bit == "0" or equal[at + k] for k, bit in enumerate(mask))
                for mask in d.MASKS
                for at in range(n - len(mask) + 1)
            )


def test_recall_of_random_substitutions(spark):
    """Copies at the edge of the tolerance: nothing else is found, and almost all of them are."""
    items = [(i, " ".join(f"i{i}w{k}" for k in range(16 + i % 30))) for i in range(60)]
    docs = []
    for i, (_, text) in enumerate(items):
        rng, words = random.Random(i), text.split(" ")
        for k in rng.sample(range(len(words)), len(words) // 5):
            words[k] = f"other{k}"
        docs.append((i, " ".join(["before", *words, "after"])))
    # Every fifth word replaced, at any length.
    docs += [(100 + i, " ".join(w if k % 5 else "other" for k, w in enumerate(t.split(" ")))) for i, t in items]
    result, truth = (
        found(d.contaminations(documents(spark, docs), items_frame(spark, items))),
        brute(docs, items),
    )
    assert result <= truth and len(truth) > 100
    assert len(result) >= 0.98 * len(truth)


def test_short_items_are_found_inside_documents(spark):
    items = [(1, "one two"), (2, "red green blue"), (3, "a b c d e f"), (4, "Six, words; stand: in a row!")]
    docs = [
        (1, "say one two three"), (2, "One. Two?"), (3, "the red, green BLUE flag"), (4, "red green x blue"),
        (5, "z " * 50 + "a b c d e f"), (6, "a b c d e g"), (7, "six words stand in a row"), (8, "green blue red"),
    ]
    result = found(d.contaminations(documents(spark, docs), items_frame(spark, items)))
    assert result == {(2, 1), (3, 2), (5, 3), (7, 4)}


def test_substitutions_are_tolerated_and_strangers_left_alone(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi omikron pi"
    words = item.split(" ")
    changed = " ".join("other" if i in (4, 11) else w for i, w in enumerate(words))
    docs = [
        (1, "Before, " + item.upper() + "! after"),
        (2, changed),
        (3, " ".join(words[:9])),
        (4, " ".join(reversed(words))),
        (5, "words " * 200),
    ]
    links = d.contaminations(documents(spark, docs), items_frame(spark, [(7, item)])).collect()
    assert {(r.doc, r.first_word, r.words, r.matches) for r in links} == {(1, 1, 16, 16), (2, 0, 16, 14)}


def test_edge_cases_and_clashing_columns(spark):
    text = prose(9, 30)
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "tiny item"), (5, "a tiny item")]
    items = [(1, text), (1, text), (2, None), (3, ""), (4, "Tiny, item"), (None, text)]
    frame = documents(spark, docs, extra=True)
    assert found(d.contaminations(frame, items_frame(spark, items))) == {(3, 1), (4, 4)}
    kept = d.without_contaminated(frame, items_frame(spark, items))
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "None"]
    assert found(d.contaminations(frame.limit(0), items_frame(spark, items))) == set()
    assert found(d.contaminations(frame, items_frame(spark, []))) == set()


def test_long_documents_are_searched_to_the_end(spark):
    item = prose(4, 20)
    docs = [(1, prose(5, 40_000) + " " + item)]
    assert found(d.contaminations(documents(spark, docs), items_frame(spark, [(1, item)]))) == {(1, 1)}


def test_any_stretch_within_both_bounds_counts(spark):
    """Every stretch of random rows is looked at; two of three copied runs are enough."""
    rng = random.Random(8)
    for n in (1, 12, 30, 60):
        for _ in range(60):
            equal = [rng.random() < rng.choice([0.5, 0.8, 0.9]) for _ in range(n)]
            most = max(
                [sum(equal[b:e]) for e in range(n + 1) for b in range(e) if 5 * sum(equal[b:e]) >= 4 * (e - b)],
                default=0,
            )
            begin, end = d.best_stretch(d.np.array(equal))
            assert sum(equal[begin:end]) == most and 5 * most >= 4 * (end - begin)
    words = [f"w{i}" for i in range(38)]
    copy = ["other" if i in (*range(10, 14), *range(24, 28)) else w for i, w in enumerate(words)]
    links = d.contaminations(documents(spark, [(1, " ".join(copy))]), items_frame(spark, [(2, " ".join(words))]))
    assert [(r.doc, r["item"], r.matches) for r in links.collect()] == [(1, 2, 20)]
