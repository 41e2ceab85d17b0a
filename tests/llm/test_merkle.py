"""Merkle manifest: against a tree built level by level in plain Python."""

from __future__ import annotations

from hashlib import sha256

import pytest
from helpers import documents
from pyspark.sql import functions as F

from tallyloom.llm import merkle


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars) -> str:
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and of every leaf the (side, sibling) steps."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    level, height = leaves, 0
    while len(level) > 1:
        for i, path in enumerate(paths):
            at = i >> height
            if at ^ 1 < len(level):
                path.append(("l" if at & 1 else "r", level[at ^ 1]))
            else:
                path.append(("", ""))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        height += 1
    return level[0], paths


def brute(rows) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, text, lang, source, n_chars)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    out, subroots = [], []
    for lang in langs:
        mine = sorted((r[0] is not None, r[0] or 0, leaf_of(*r)) for r in rows if r[2] == lang)
        subroot, paths = tree([m[2] for m in mine])
        subroots.append(subroot)
        out.append([(m[1] if m[0] else None, m[2], subroot, p) for m, p in zip(mine, paths, strict=True)])
    root, tops = tree(subroots)
    return [
        (i, leaf, subroot, root, h(*(s for _, s in path + top)))
        for group, top in zip(out, tops, strict=True)
        for i, leaf, subroot, path in group
    ]


def made(spark, docs, block_height):
    values = [F.col(c) for c in merkle.FIELDS]
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest(*values).alias("leaf"))
    return merkle.manifest(leaves, "lang", "doc_id", block_height=block_height)


def shown(result):
    result = result.select(
        "doc_id",
        *[merkle.hex_text(c) for c in ("leaf", "subroot", "root")],
        merkle.proof_digest(F.col("steps")),
        merkle.folded(F.col("leaf"), F.col("steps")).alias("folded"),
    )
    rows = [tuple(r) for r in result.collect()]
    assert all(r[5] == r[3] for r in rows)
    return sorted((r[:5] for r in rows), key=lambda r: (r[0] is not None, *map(str, r)))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(sizes: dict) -> list[tuple]:
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) + i, f"tèxt {lang} {i}", lang, f"s{i % 3}", i) for i in range(n)]
    return rows


@pytest.mark.parametrize("block_height", [1, 2, 10])
def test_equals_a_tree_built_level_by_level(spark, block_height):
    rows = rows_of({"en": 37, "de": 1, None: 2, "ß": 16, "z": 5})
    result = shown(made(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), block_height))
    assert result == sorted(brute(rows), key=lambda r: (r[0] is not None, *map(str, r)))


def test_nulls_empties_ties_and_repeated_rows(spark):
    rows = [
        (1, None, "en", None, None), (1, None, "en", None, None), (1, "", "en", "", 0),
        (None, "x", "en", "s", 1), (2, "-", None, "-", 1), (3, "a" * 300_000, None, "s", 300_000),
    ]
    result = shown(made(spark, spark.createDataFrame(rows, SCHEMA), 1))
    assert result == sorted(brute(rows), key=lambda r: (r[0] is not None, *map(str, r)))
    # A null and an empty value, or a null and a dash, are different leaves.
    assert len({r[1] for r in result}) == 5


def test_one_hot_group_is_cut_into_blocks(spark):
    rows = rows_of({"en": 300, "de": 20})
    result = made(spark, spark.createDataFrame(rows, SCHEMA), 4)
    assert shown(result) == sorted(brute(rows), key=lambda r: (r[0] is not None, *map(str, r)))


def test_a_changed_row_does_not_lead_to_the_root(spark):
    rows = rows_of({"en": 9, "de": 3})
    result = made(spark, spark.createDataFrame(rows, SCHEMA), 2)
    wrong = merkle.folded(F.unhex(F.sha2(F.lit("forged"), 256)), F.col("steps"))
    assert result.filter(wrong == merkle.hex_text("root")).isEmpty()


def test_a_lone_row_is_its_own_root(spark):
    rows = [(7, "x", "en", "s", 1)]
    leaf = leaf_of(*rows[0])
    assert shown(made(spark, spark.createDataFrame(rows, SCHEMA), 3)) == [(7, leaf, leaf, leaf, h())]


def test_an_empty_table_gives_no_rows(spark):
    assert made(spark, documents(spark, []), 3).collect() == []


def test_extra_columns_do_not_matter(spark):
    rows = [(i, f"t{i}") for i in range(5)]
    plain, extra = documents(spark, rows), documents(spark, rows, extra=True)
    clashing = extra.withColumnsRenamed({"n": "tree", "at": "place", "key": "left", "bands": "leaf"})
    assert shown(made(spark, plain, 2)) == shown(made(spark, clashing, 2))


def test_appends_extend_the_witnesses_of_both_sides():
    tree_ = merkle.GrowingTree(4, 2)
    leaves = [bytes([i]) * 32 for i in range(4)]
    tree_.append(leaves[0])
    assert tree_.open == [(0, 0, leaves[0])] and not tree_.side.any()
    tree_.append(leaves[1])
    assert tree_.side[:2, 0].tolist() == [1, -1] and not tree_.side[:, 1].any()
    tree_.append(leaves[2])
    assert [o[0] for o in tree_.open] == [1, 0]
    tree_.append(leaves[3])
    assert tree_.side[:, 1].tolist() == [1, 1, -1, -1]
    assert tree_.close(2) == merkle.digest(merkle.digest(*leaves[:2]), merkle.digest(*leaves[2:]))
