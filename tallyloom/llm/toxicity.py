"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, strips accents, maps look-alike letters of other scripts and digits
used as letters to plain ones, and makes i, l and 1 one letter, so that `1d10t` reads as
`idiot`. An automaton over all terms and exception phrases passes once over each text. A
term counts where a word starts with it (whole-word terms: where it is the word), once a
word with its greatest weight, and not inside an exception phrase. White space, hyphens and
low lines between words are one space, so `trash-can` is the phrase `trash can`. The sum of
weights, and that sum relative to the text's length, give the score through a logistic curve.

Terms are a small list of insults and stems learned from labels: word beginnings much more
frequent in toxic texts than in others, weighted by their log odds. The learning sample is
bounded (`FIT_TOXIC`, `FIT_CLEAN`), and with it all that is learned; nothing else bounds the
terms. Exception phrases beside a few listed ones are learned, too: a hit with the word before
or after it, if that pair of words is much more frequent in texts that are not toxic. A term counts in it only as often as it follows different
words: all words of a copied passage are as frequent in toxic texts as the passage is, but
always follow the same word.

Defined cases: null and empty texts score as a text without hits; whole texts are matched,
however long; repeated rows score alike; null or missing labels teach nothing; without
labels of both kinds the list alone scores, by a fixed curve; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import learns, stored

FIT_TOXIC, FIT_CLEAN = 4_000, 12_000
STEM_CHARS = range(4, 11)
LEAST_EVIDENCE = 14.0  # log-likelihood ratio a learned term needs
CONTEXT_BITS = 62
LISTED_WEIGHT = 2.0

# Common insults, phrases in which such words are harmless, letters that look
# like Latin ones, and digits and signs used as letters.
INSULTS = (
    "bastard", "clown", "creep", "disgusting", "dumb", "filth", "idiot", "imbecile", "jerk",
    "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless",
)
EXCEPTIONS = ("clown fish", "pathetic fallacy", "trash can", "trash bag", "sore loser rule")
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
    "l": "i",
}

WORD = re.compile(r"[^\W_]+")
BETWEEN_WORDS = re.compile(r"[\s\-\u2010-\u2015_]+")


@lru_cache
def fold_table() -> dict[int, str]:
    table = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        if plain[0].isascii() and plain[0] != " ":
            table[code] = plain[0]
    table |= {ord(k): v for k, v in LOOK_ALIKES.items()}
    merged = {ord(k): v for k, v in SUBSTITUTES.items()}
    return {k: merged.get(ord(v), v) for k, v in table.items()} | merged


def fold(text: str) -> str:
    return BETWEEN_WORDS.sub(" ", text.lower().translate(fold_table()))


@dataclass(frozen=True)
class Lexicon:
    """Folded terms with weights (a trailing space marks a whole word), folded exception
    phrases, and the logistic curve over (1, log of the sum, log of the sum per 100 words)."""

    terms: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = tuple(fold(p) for p in EXCEPTIONS)
    curve: tuple[float, float, float] = (-4.0, 3.0, 0.5)


LISTED = tuple((fold(word), LISTED_WEIGHT) for word in INSULTS)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        entries: dict[str, list] = {}
        for term, weight in lexicon.terms:
            entry = entries.setdefault(term.strip(), [0.0, 0.0, False])
            entry[term.endswith(" ")] = max(entry[term.endswith(" ")], weight)
        for phrase in lexicon.exceptions:
            entries.setdefault(phrase, [0.0, 0.0, False])[2] = True
        self.automaton = ahocorasick.Automaton()
        for term, entry in entries.items():
            self.automaton.add_word(term, (len(term), *entry))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Weight by the place of every word that begins with a term."""
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        if not len(self.automaton):
            return best
        n = len(folded)
        for last, (size, stem, whole, exception) in self.automaton.iter(folded):
            first = last + 1 - size
            if first and folded[first - 1].isalnum():
                continue
            if exception:
                free.append((first, last))
            weight = stem
            if whole > weight and (last + 1 == n or not folded[last + 1].isalnum()):
                weight = whole
            if weight > best.get(first, 0.0):
                best[first] = weight
        if not free:
            return best
        # Exceptions by their beginning, hits in order: one pass over both.
        free.sort()
        kept, reach, n_free = {}, -1, 0
        for at in sorted(best):
            while n_free < len(free) and free[n_free][0] <= at:
                reach = max(reach, free[n_free][1])
                n_free += 1
            if at > reach:
                kept[at] = best[at]
        return kept


def features(weight: float, chars: int) -> tuple[float, float, float]:
    """Length is counted in words of six characters."""
    return 1.0, math.log1p(weight), math.log1p(100.0 * weight / (chars / 6 + 50.0))


@lru_cache(maxsize=2)
def matcher(lexicon: Lexicon) -> Matcher:
    return Matcher(lexicon)


def text_score(text: str, lexicon: Lexicon) -> tuple[float, float, int]:
    """(score, weight, hits) of one text."""
    found = matcher(lexicon).hits(fold(text))
    weight = sum(found.values())
    at = sum(c * f for c, f in zip(lexicon.curve, features(weight, len(text)), strict=True))
    return 1.0 / (1.0 + math.exp(-max(min(at, 30.0), -30.0))), weight, len(found)


def score_texts(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, weight, hits) of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            scored = [text_score(t or "", lexicon) for t in batch.column(1).to_pylist()]
            score, weight, hits = list(zip(*scored, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(score, pa.float64()),
                    pa.array(weight, pa.float64()),
                    pa.array(hits, pa.int32()),
                ],
                names=[key, "score", "weight", "hits"],
            )

    narrow = docs.select(key, text)
    kind = narrow.schema[key].dataType.simpleString()
    return narrow.mapInArrow(batches, f"{key} {kind}, score double, weight double, hits int")


def learning_sample(docs: DataFrame, labels: DataFrame, label: str, bounds: dict[int, int]) -> DataFrame:
    """(doc, text, label): for each label value the rows least in a hash order, up to its
    bound, so their ids may be broadcast. Held-out rows never get here."""
    rows = labels.filter(learns("doc_id")).groupBy("doc_id").agg(F.max(label).alias("label"))
    picked = None
    for value, bound in bounds.items():
        some = rows.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        picked = some if picked is None else picked.unionByName(some)
    picked = picked.select(F.col("doc_id").alias("picked"), "label")
    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    return texts.join(F.broadcast(picked), F.col("doc") == F.col("picked")).select(
        "doc", "text", "label"
    )


def _stems(text: str) -> dict[str, int]:
    """The terms a text has, each with a bit for the word before it (one of CONTEXT_BITS)."""
    found: dict[str, int] = {}
    before = 0
    for word in WORD.findall(fold(text)):
        if len(word) >= STEM_CHARS[0]:
            for term in (word + " ", *(word[:n] for n in STEM_CHARS if n <= len(word))):
                found[term] = found.get(term, 0) | 1 << before
        before = crc32(word.encode()) % CONTEXT_BITS
    return found


def _document_counts(sample: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """(term, n, contexts): how many texts have the term, and after which words; partial
    counts leave each batch."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts: Counter[str] = Counter()
            contexts: dict[str, int] = {}
            for text in batch.column(0).to_pylist():
                for term, bits in _stems(text or "").items():
                    if only is None or term in only:
                        counts[term] += 1
                        contexts[term] = contexts.get(term, 0) | bits
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(counts.keys(), pa.string()),
                    pa.array(counts.values(), pa.int64()),
                    pa.array([contexts[term] for term in counts], pa.int64()),
                ],
                names=["term", "n", "contexts"],
            )

    counted = sample.select("text").mapInArrow(batches, "term string, n long, contexts long")
    return counted.groupBy("term").agg(
        F.sum("n").alias("n"), F.bit_count(F.bit_or("contexts")).alias("contexts")
    )


def _independent(n: int, contexts: int) -> int:
    """How many of n texts can be independent, judged by the bits their contexts set."""
    if contexts > CONTEXT_BITS // 2:
        return n
    return min(n, round(-CONTEXT_BITS * math.log(1 - contexts / CONTEXT_BITS)))


def _evidence(toxic: int, clean: int, share: float) -> float:
    """Log-likelihood ratio of the term's own share of toxic texts against the overall one."""
    own = toxic / (toxic + clean)
    if own <= share:
        return 0.0
    ratio = toxic * math.log(own / share)
    return ratio + (clean * math.log((1 - own) / (1 - share)) if clean else 0.0)


def _plainest(learned: dict[str, float], counts: dict[str, int]) -> list[tuple[str, float]]:
    """Of terms that begin alike: the longest that still covers nearly the same texts, and no
    longer one that says no more than a shorter one kept."""

    def beginnings(term: str) -> list[str]:
        word = term.strip()
        return [word[:n] for n in STEM_CHARS if n < len(term) and n <= len(word)]

    wide = {
        short
        for term in learned
        for short in beginnings(term)
        if short in learned and counts[term] >= 0.9 * counts[short]
    }
    kept = {term: odds for term, odds in learned.items() if term not in wide}
    plain = {
        term: odds
        for term, odds in kept.items()
        if not any(kept.get(short, 0.0) >= odds - 0.5 for short in beginnings(term))
    }
    return sorted(plain.items(), key=lambda item: (-item[1], item[0]))


def learn_lexicon(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Lexicon:
    """Terms and curve from labelled rows that are not held out."""
    sample = learning_sample(docs, labels, label, {1: FIT_TOXIC, 0: FIT_CLEAN})
    sample = stored(sample, "toxicity-sample")
    sizes = dict(sample.groupBy("label").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon(LISTED)
    share = n_toxic / (n_toxic + n_clean)
    # What no number of clean texts could make a term is not even counted in them.
    least = math.ceil(LEAST_EVIDENCE / -math.log(share))
    in_toxic = _document_counts(sample.filter("label = 1"), None).filter(F.col("n") >= least)
    toxic = {r.term: _independent(r.n, r.contexts) for r in in_toxic.collect()}
    toxic = {term: n for term, n in toxic.items() if n >= least}
    in_clean = _document_counts(sample.filter("label = 0"), frozenset(toxic))
    clean = {r.term: r.n for r in in_clean.collect()}
    learned: dict[str, float] = {}
    for term, n in toxic.items():
        missed = clean.get(term, 0)
        if _evidence(n, missed, share) >= LEAST_EVIDENCE:
            odds = math.log((n + 0.5) / (n_toxic + 1)) - math.log((missed + 0.5) / (n_clean + 1))
            if odds >= LISTED_WEIGHT:
                learned[term] = odds
    terms = tuple(_plainest(learned, toxic))
    known = {term.strip(): weight for term, weight in terms}
    terms += tuple((t, known.get(t, w)) for t, w in LISTED if (t, known.get(t)) not in terms)
    lexicon = Lexicon(terms)
    lexicon = Lexicon(terms, (*lexicon.exceptions, *_harmless(lexicon, sample, 1 - share)))
    return _with_curve(lexicon, sample)


def _harmless(lexicon: Lexicon, sample: DataFrame, share: float) -> tuple[str, ...]:
    """Pairs of words, one of which is a hit, that mark a text as not toxic. Counted by texts;
    `share` is that of the texts that are not toxic."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                folded = fold(text or "")
                hits = matcher(lexicon).hits(folded)
                if hits:
                    counts.update(set(_pairs_around(folded, hits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["pair", "n"]
            )

    def counted(label: int, name: str) -> DataFrame:
        texts = sample.filter(F.col("label") == label).select("text").mapInArrow(batches, "pair string, n long")
        return texts.groupBy("pair").agg(F.sum("n").alias(name))

    # What no number of toxic texts could make harmless need not be known.
    least = math.ceil(LEAST_EVIDENCE / -math.log(share))
    found = counted(0, "clean").filter(F.col("clean") >= least).join(counted(1, "toxic"), "pair", "left")
    return tuple(
        sorted(r.pair for r in found.collect() if _evidence(r.clean, r.toxic or 0, share) >= LEAST_EVIDENCE)
    )


def _pairs_around(folded: str, hits: dict[int, float]) -> Iterator[str]:
    """Each hit's word with the word before it, and with the one after it."""
    before = None
    for word in WORD.finditer(folded):
        if before and (before.start() in hits or word.start() in hits) and word.start() == before.end() + 1:
            yield folded[before.start() : word.end()]
        before = word


def _with_curve(lexicon: Lexicon, sample: DataFrame, ridge: float = 1e-2) -> Lexicon:
    """Fit the logistic curve to the bounded sample by Newton steps."""
    scored = score_texts(sample.select("doc", "text"), lexicon, "doc").select("doc", "weight")
    lengths = sample.select("doc", F.length("text").alias("chars"), "label")
    rows = scored.join(lengths, "doc").select("weight", "chars", "label").collect()
    x = np.array([features(r.weight, r.chars or 0) for r in rows])
    y = np.array([r.label for r in rows], float)
    beta = np.zeros(3)
    penalty = ridge * np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) / len(y) - penalty @ beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty + 1e-9 * np.eye(3)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Lexicon(lexicon.terms, lexicon.exceptions, tuple(float(b) for b in beta))
