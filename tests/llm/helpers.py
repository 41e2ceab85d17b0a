"""Small tables and brute-force versions for the tests of the text operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})

VOCABULARY = [a + b for a in ("ba", "co", "di", "fu", "ge", "ha") for b in ("lo", "mi", "nu", "ra", "té")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", ".", ","]) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(
        rng.choice(VOCABULARY) if rng.random() < share else word for word in text.split(" ")
    )


def documents(spark, rows, extra: bool = False):
    """rows of (doc_id, text), with the other columns of documents; extra ones have names
    that the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    if extra:
        names = ("doc", "score", "n", "key", "bands", "label", "picked", "at", "spans", "component")
        schema += "".join(f", {name} string" for name in names)
        full = [(*row, *names) for row in full]
    return spark.createDataFrame(full, schema)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(sets: dict[int, frozenset]) -> dict[int, int]:
    """The smallest id reachable over links, by comparing all pairs."""
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def without_repeats(texts: dict[int, str | None], width: int = 50) -> dict[int, tuple[int, bytes]]:
    """(spans, bytes left) of each text, by looking every window up."""
    seen: set[bytes] = set()
    out = {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        windows = [raw[at : at + width] for at in range(len(raw) - width + 1)]
        gone = [False] * len(raw)
        for at, window in enumerate(windows):
            if window in seen:
                gone[at : at + width] = [True] * width
        seen.update(windows)
        spans = sum(g and (not n or not gone[n - 1]) for n, g in enumerate(gone))
        out[i] = (spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out
