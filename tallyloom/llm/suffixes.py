"""Repeated byte strings across documents: a sparse suffix sort with hashed comparisons.

A byte of a document goes if a string of `WINDOW` bytes covers it that also starts in a
document of smaller id. Sorting all suffixes of a corpus is not needed for that: in every
window the string of `ANCHOR` bytes with the least hash is an anchor, so equal windows have
equal anchors at equal places, and only the suffixes at anchors are sorted.

1. Anchors of every text, with a hash of the whole context a window around the anchor can
   reach, meet by anchor. Of equal contexts all but the smallest document's are decided.
   Equal contexts in one batch are decided before anything is shuffled.
2. Contexts that share an anchor but differ (the ends of repeats) are fetched and sorted:
   the suffixes from the anchor on, and the reversed prefixes before it. The sort is a
   mergesort whose comparisons find the common extension of two strings by binary search
   over polynomial prefix hashes; common extensions of neighbours are then verified byte by
   byte, and a hash collision sends the run to a plain sort.
3. Two windows at the same offset are equal where the right sides agree for long enough and
   the left sides do; both are runs of the sorted orders, so the smallest document of every
   window is a minimum over pairs of run numbers.
4. An anchor with more open contexts than one task should sort (the border of a passage that
   very many documents hold) is settled by its windows instead: each window is a row, the
   smallest document of equal windows a minimum that the map tasks begin, and the rows meet
   it in a join, which Spark splits where one window is hot.

Defined cases: null and empty texts have no bytes; texts shorter than a window lose
nothing; repeats inside one document do not count; repeated rows (equal id and text) are the
same document; different texts under one id are each judged against smaller ids, never
against each other; a row with a null id is never changed and changes no other; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.arrays import Chunk, mix, prefix_hashes, span_hashes, symbol_codes, text_chunks
from tallyloom.llm.tables import stored

WINDOW = 50
ANCHOR = 16
LEFT = WINDOW - ANCHOR
BATCH_BYTES = 8 << 20
BLOBS_A_BATCH = 64
BUCKETS_A_PARTITION = 16
SORT_ROWS = 1 << 16
MAX48 = np.uint64((1 << 48) - 1)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over every `width` neighbours, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out, span = best(out[:-span], out[span:]), span * 2
    return best(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def anchors(chunk: Chunk) -> tuple[np.ndarray, ...]:
    """Of one chunk: the text, offset, hash (48 bits) and context hash of every anchor."""
    none = np.zeros(0, np.int64)
    n = len(chunk.data)
    if n < WINDOW:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_hashes(symbol_codes()[chunk.data])
    at = np.arange(n - ANCHOR + 1)
    hashes = mix(span_hashes(sums, at, at + ANCHOR)) & MAX48
    width = LEFT + 1
    lowest = sliding(hashes, width, np.minimum)
    # Windows that would reach into the next text choose nothing.
    whole = np.ones(len(lowest), bool)
    for cut in chunk.bounds[1:-1]:
        whole[max(cut - WINDOW + 1, 0) : cut] = False
    lowest = np.where(whole, lowest + np.uint64(1), np.uint64(0))
    # A string is an anchor if it is the least of any window it lies in.
    padded = np.concatenate([np.zeros(LEFT, np.uint64), lowest, np.zeros(LEFT, np.uint64)])
    chosen = np.flatnonzero(sliding(padded, width, np.maximum) == hashes + np.uint64(1))
    text = np.searchsorted(chunk.bounds, chosen, side="right") - 1
    begin, end = chunk.bounds[text], chunk.bounds[text + 1]
    left = np.maximum(chosen - LEFT, begin)
    right = np.minimum(chosen + WINDOW, end)
    shape = ((chosen - left) * (WINDOW + 1) + (right - chosen)).astype(np.uint64)
    context = mix(span_hashes(sums, left, right) + mix(shape))
    return text, chosen - begin, hashes[chosen], context


def _smallest(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order by keys then doc, start flags of equal keys, and the least doc of each row's keys."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    first = np.flatnonzero(new)
    return order, new, doc[order][first][np.cumsum(new) - 1]


BLOB = (
    "bucket int, high binary, low binary, context binary, doc_low binary, doc_high binary, "
    "at binary, tag binary"
)


def _packed(bucket: int, hashes, context, doc, at, tag) -> list:
    """Columns as planes of bytes: what repeats is side by side and compresses. Tags that are
    all zero take no bytes."""
    ids = doc.view(np.uint64)
    return [
        bucket,
        (hashes >> np.uint64(32)).astype(np.uint16).tobytes(),
        hashes.astype(np.uint32).tobytes(),
        context.tobytes(),
        ids.astype(np.uint32).tobytes(),
        (ids >> np.uint64(32)).astype(np.uint32).tobytes(),
        at.astype(np.uint32).tobytes(),
        tag.astype(np.int64).tobytes() if tag.any() else b"",
    ]


def _unpacked(row: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    def plane(i: int, kind: type) -> np.ndarray:
        return np.frombuffer(row.column(i)[0].as_py(), kind)

    hashes = plane(1, np.uint16).astype(np.uint64) << np.uint64(32) | plane(2, np.uint32)
    doc = plane(5, np.uint32).astype(np.uint64) << np.uint64(32) | plane(4, np.uint32)
    tag = plane(7, np.int64)
    return (
        hashes,
        plane(3, np.uint64),
        doc.view(np.int64),
        plane(6, np.uint32).astype(np.int64),
        tag if len(tag) else np.zeros(len(doc), np.int64),
    )


def _blobs(parts: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[list]:
    """Anchors of a batch by bucket; what equal contexts decide here goes along in bucket -1-b."""
    columns = (np.concatenate(column) for column in zip(*parts, strict=True))
    doc, tag, at, hashes, context = columns
    order, _, least = _smallest((hashes, context), doc)
    doc, tag, at, hashes, context = (c[order] for c in (doc, tag, at, hashes, context))
    open_ = doc == least
    home = ((hashes >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    for sign, some in ((1, open_), (-1, ~open_)):
        picked = np.flatnonzero(some)
        cuts = np.searchsorted(home[picked], np.arange(buckets + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            p = picked[cuts[b] : cuts[b + 1]]
            bucket = int(b) if sign > 0 else -1 - int(b)
            yield _packed(bucket, hashes[p], context[p], doc[p], at[p], tag[p])


def anchor_blobs(docs: DataFrame, buckets: int) -> DataFrame:
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in BLOB.split(", ")]
        kinds = [pa.int32(), *[pa.binary()] * 7]

        def flushed(parts: list) -> Iterator[pa.RecordBatch]:
            blobs = _blobs(parts, buckets)
            while some := list(islice(blobs, BLOBS_A_BATCH)):
                columns = zip(*some, strict=True)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        parts, held = [], 0
        for batch in rows:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tags = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            tags = tags if tags.any() else np.zeros(len(tags), np.int8)
            for chunk in text_chunks(batch.column(2)):
                text, at, hashes, context = anchors(chunk)
                row = chunk.first + text
                parts.append((ids[row], tags[row], at, hashes, context))
                held += len(chunk.data)
                if held >= BATCH_BYTES:
                    yield from flushed(parts)
                    parts, held = [], 0
        if parts:
            yield from flushed(parts)

    return docs.mapInArrow(batches, BLOB)


MARKS = "doc long, tag long, first int, past int, anchor long"


def _marks(doc, tag, first, past, anchor) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()),
            pa.array(tag, pa.int64()),
            pa.array(first, pa.int32()),
            pa.array(past, pa.int32()),
            pa.array(anchor, pa.int64()),
        ],
        names=["doc", "tag", "first", "past", "anchor"],
    )


def context_marks(blobs: DataFrame) -> DataFrame:
    """Decided spans (anchor -1) and anchors still open: those whose contexts differ.

    A span is the whole reach of the anchor; what lies outside the text is cut off later.
    An open anchor has in `past` the number of its open contexts.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in rows:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                bucket = row.column(0)[0].as_py()
                if bucket < 0:
                    _, _, doc, at, tag = _unpacked(row)
                    yield _marks(doc, tag, at - LEFT, at + WINDOW, np.full(len(doc), -1))
                else:
                    held.setdefault(bucket, []).append(row)
        for bucket in list(held):
            parts = [_unpacked(row) for row in held.pop(bucket)]
            columns = (np.concatenate(c) for c in zip(*parts, strict=True))
            hashes, context, doc, at, tag = columns
            order, new, least = _smallest((hashes, context), doc)
            hashes, doc, at, tag = (c[order] for c in (hashes, doc, at, tag))
            done = doc > least
            whole = np.full(done.sum(), -1)
            yield _marks(doc[done], tag[done], at[done] - LEFT, at[done] + WINDOW, whole)
            # Open: the first document of a context, if the anchor has other contexts of others.
            group = np.append(True, hashes[1:] != hashes[:-1])
            number = np.cumsum(group) - 1
            size = np.bincount(number, weights=new)
            starts = np.flatnonzero(group)
            low = np.minimum.reduceat(doc, starts)
            high = np.maximum.reduceat(doc, starts)
            open_ = ~done & ((size > 1) & (low < high))[number]
            count = np.bincount(number[open_], minlength=len(starts))[number]
            anchor = hashes[open_].view(np.int64)
            yield _marks(doc[open_], tag[open_], at[open_], count[open_], anchor)

    return blobs.mapInArrow(batches, MARKS)


CONTEXTS = "anchor long, doc long, tag long, at int, before binary, after binary"


def open_contexts(texts: DataFrame) -> DataFrame:
    """The bytes around every open anchor of (doc, tag, text, marks)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in CONTEXTS.split(", ")]
        for batch in rows:
            lists = batch.column(3)
            bounds, marks = lists.offsets.to_numpy(), lists.values
            first, anchor = marks.field("first").to_numpy(), marks.field("anchor").to_numpy()
            sizes = np.diff(bounds)
            doc, tag = (np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1))
            first, anchor = first[bounds[0] : bounds[-1]], anchor[bounds[0] : bounds[-1]]
            text = batch.column(2).cast(pa.large_binary())
            for row in range(0, len(doc), SORT_ROWS):
                part = slice(row, row + SORT_ROWS)
                home = np.searchsorted(bounds - bounds[0], np.arange(row, row + len(first[part])), "right") - 1
                before, after, last, raw = [], [], -1, b""
                for i, at in zip(home.tolist(), first[part].tolist(), strict=True):
                    if i != last:
                        last, raw = i, text[i].as_py()
                    before.append(raw[max(at - LEFT, 0) : at])
                    after.append(raw[at : at + WINDOW])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[part], pa.int64()),
                        pa.array(doc[part], pa.int64()),
                        pa.array(tag[part], pa.int64()),
                        pa.array(first[part], pa.int32()),
                        pa.array(before, pa.binary()),
                        pa.array(after, pa.binary()),
                    ],
                    names=names,
                )

    return texts.mapInArrow(batches, CONTEXTS)


class SuffixOrder:
    """Sorted strings inside groups, and how far each one agrees with its predecessor."""

    def __init__(self, strings: list[bytes], group: np.ndarray):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        # One byte more, so that a read at the end of the last string is inside the data.
        self.data = np.frombuffer(b"".join(strings) + b"\0", np.uint8)
        self.sums = prefix_hashes(symbol_codes()[self.data])
        self.longest = int(self.sizes.max(initial=0))
        self.order = self._sorted(group)
        self.common = self._verified(strings, group)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length two strings share from their start, by binary search over hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.sizes[a], self.sizes[b])
        for _ in range(max(self.longest, 1).bit_length()):
            middle = (low + high + 1) // 2
            sa, sb = self.starts[a], self.starts[b]
            same = span_hashes(self.sums, sa, sa + middle) == span_hashes(self.sums, sb, sb + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
            high = np.maximum(low, high)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Is string a smaller than string b?"""
        n = self.extension(a, b)
        a_ends, b_ends = n == self.sizes[a], n == self.sizes[b]
        less = self.data[np.minimum(self.starts[a] + n, len(self.data) - 1)] < (
            self.data[np.minimum(self.starts[b] + n, len(self.data) - 1)]
        )
        return np.where(a_ends, ~b_ends, ~b_ends & less)

    def _sorted(self, group: np.ndarray) -> np.ndarray:
        """Bottom-up mergesort of all groups at once: a string's new place is its place in its
        own run plus the number of the neighbour run's strings that go before it."""
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else order
        bounds = np.append(first, n)
        begin = np.repeat(first, np.diff(bounds))
        end = np.repeat(bounds[1:], np.diff(bounds)) if n else order
        place = np.arange(n) - begin
        largest = int(np.diff(bounds).max(initial=0))
        width = 1
        while width < largest:
            active = np.flatnonzero(end - begin > width)
            run = place[active] // width
            own = begin[active] + run * width
            other = np.where(run % 2 == 0, own + width, own - width)
            low = np.minimum(other, end[active])
            high = np.minimum(other + width, end[active])
            base = low.copy()
            mine = order[active]
            is_left = run % 2 == 0
            while True:
                going = np.flatnonzero(low < high)
                if not len(going):
                    break
                middle = (low[going] + high[going]) // 2
                theirs = order[middle]
                # Equal strings keep the order of their runs.
                goes = np.where(
                    is_left[going],
                    self.before(theirs, mine[going]),
                    ~self.before(mine[going], theirs),
                )
                low[going] = np.where(goes, middle + 1, low[going])
                high[going] = np.where(goes, high[going], middle)
            pair = begin[active] + run // 2 * 2 * width
            target = pair + (begin[active] + place[active] - own) + (low - base)
            merged = order.copy()
            merged[target] = mine
            order = merged
            width *= 2
        return order

    def _verified(self, strings: list[bytes], group: np.ndarray) -> np.ndarray:
        """Common extensions of neighbours, checked on the bytes themselves."""
        common = self._neighbours(group)
        width = max(self.longest, 1)
        table = np.zeros((len(strings), width + 1), np.int16)
        column = np.arange(len(self.data) - 1) - np.repeat(self.starts, self.sizes)
        table[np.repeat(np.arange(len(strings)), self.sizes), column] = self.data[:-1] + np.int16(1)
        a, b = table[self.order[:-1]], table[self.order[1:]]
        differs = a != b
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), self.sizes[self.order[1:]])
        same_group = group[self.order[:-1]] == group[self.order[1:]]
        true = np.where(same_group, shared, 0)
        row = np.arange(len(true))
        column = np.minimum(shared, width)
        wrong = same_group & differs.any(axis=1) & (a[row, column] > b[row, column])
        if (true != common[1:]).any() or wrong.any():  # a hash collision
            self.order = np.array(
                sorted(range(len(strings)), key=lambda i: (group[i], strings[i])), np.int64
            )
            a, b = table[self.order[:-1]], table[self.order[1:]]
            differs = a != b
            shared = np.where(
                differs.any(axis=1), differs.argmax(axis=1), self.sizes[self.order[1:]]
            )
            same_group = group[self.order[:-1]] == group[self.order[1:]]
            true = np.where(same_group, shared, 0)
        return np.append(0, true)[: len(strings)]

    def _neighbours(self, group: np.ndarray) -> np.ndarray:
        a, b = self.order[:-1], self.order[1:]
        shared = np.where(group[a] == group[b], self.extension(a, b), 0)
        return np.append(0, shared)[: len(self.order)]

    def runs(self, depth: int, new_group: np.ndarray) -> np.ndarray:
        """The number of the run of strings that agree for `depth` bytes, for each string."""
        number = np.empty(len(self.order), np.int64)
        number[self.order] = np.cumsum((self.common < depth) | new_group)
        return number


def repeated_windows(
    group: np.ndarray, doc: np.ndarray, at: np.ndarray, before: list[bytes], after: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """(row, window start) of windows around the anchors that a smaller document has too.

    Rows are sorted by group.
    """
    new_group = np.append(True, group[1:] != group[:-1])
    right = SuffixOrder(after, group)
    left = SuffixOrder([b[::-1] for b in before], group)
    rows, starts = [], []
    for reach in range(LEFT + 1):
        inside = np.flatnonzero((left.sizes >= reach) & (right.sizes >= WINDOW - reach))
        if not len(inside):
            continue
        keys = (
            right.runs(WINDOW - reach, new_group)[inside],
            left.runs(reach, new_group)[inside],
        )
        order, _, least = _smallest(keys, doc[inside])
        hit = inside[order[doc[inside][order] > least]]
        rows.append(hit)
        starts.append(at[hit] - reach)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(rows or none), np.concatenate(starts or none)


def sorted_marks(contexts: DataFrame) -> DataFrame:
    """Decided spans of contexts that arrive sorted by anchor."""

    def settled(table: pa.Table) -> pa.RecordBatch:
        group, doc, tag, at = (table.column(i).to_numpy().astype(np.int64) for i in range(4))
        row, start = repeated_windows(
            group, doc, at, table.column(4).to_pylist(), table.column(5).to_pylist()
        )
        # Windows that touch are one span.
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + WINDOW)
        last = np.append(new[1:], True) if len(row) else new
        first = row[new]
        return _marks(
            doc[first], tag[first], start[new], start[last] + WINDOW, np.full(len(first), -1)
        )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in rows:
            held.append(batch)
            count += batch.num_rows
            if count < SORT_ROWS or held[0].column(0)[0] == batch.column(0)[-1]:
                continue
            table = pa.Table.from_batches(held)
            ids = table.column(0).to_numpy()
            whole = int(np.searchsorted(ids, ids[-1]))
            if whole:
                yield settled(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
                count = sum(b.num_rows for b in held)
        if count:
            yield settled(pa.Table.from_batches(held))

    return contexts.mapInArrow(batches, MARKS)


def window_marks(contexts: DataFrame) -> DataFrame:
    """Decided spans of contexts by their windows, with no group in one task."""
    windows = (
        contexts.filter(F.length("before") + F.length("after") >= WINDOW)
        .withColumn(
            "reach",
            F.explode(F.expr(f"sequence(greatest(0, {WINDOW} - length(after)), length(before))")),
        )
        .select(
            "doc",
            "tag",
            F.expr("at - reach").alias("first"),
            F.expr(
                "concat(substring(before, length(before) - reach + 1, reach), "
                f"substring(after, 1, {WINDOW} - reach))"
            ).alias("window"),
        )
    )
    least = windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    least = least.filter("least < most").select("window", "least")
    found = windows.join(least, "window").filter("doc > least")
    past, none = (F.col("first") + WINDOW).alias("past"), F.lit(-1).cast("long").alias("anchor")
    return found.select("doc", "tag", "first", past, none)


REMOVED = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _without(texts: DataFrame, keep_bytes: bool) -> DataFrame:
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            marks = batch.column(2)
            out = []
            texts = batch.column(1).to_pylist()
            ids = batch.column(0).to_pylist()
            for i, (doc, text) in enumerate(zip(ids, texts, strict=True)):
                raw = (text or "").encode()
                spans = marks[i]
                if not spans.is_valid or not len(spans):
                    out.append((doc, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                first = np.maximum(spans.values.field("first").to_numpy(), 0)
                past = np.minimum(spans.values.field("past").to_numpy(), len(raw))
                order = np.argsort(first, kind="stable")
                first, reach = first[order], np.maximum.accumulate(past[order])
                new = np.append(True, first[1:] > reach[:-1])
                begins, ends = first[new], reach[np.append(new[1:], True)]
                kept, done = [], 0
                for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                    kept.append(raw[done:a])
                    done = b
                kept = b"".join([*kept, raw[done:]])
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc, len(raw), len(raw) - len(kept), len(begins), digest, kept))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    *(pa.array(columns[i], pa.int64()) for i in (1, 2, 3)),
                    pa.array(columns[4], pa.string()),
                    pa.array(columns[5] if keep_bytes else [None] * len(out), pa.binary()),
                ],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return texts.mapInArrow(batches, REMOVED)


def _shared_ids(texts: DataFrame) -> bool:
    """Does any id name different texts?"""
    digest = F.xxhash64("body")
    several = texts.groupBy("doc").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    return several.filter("low <> high").limit(1).count() > 0


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep_bytes: bool = True,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document: what is left
    of its bytes without those a repeated string covers. Anchors with more than `sort_rows`
    open contexts are settled by windows instead of in one task's sort, with the same result."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("body"))
    # Texts of one id are told apart by a hash, which costs something only where there are any.
    shared = _shared_ids(texts.filter("doc is not null"))
    keys = ["doc", "tag"] if shared else ["doc"]
    tag = F.xxhash64("body") if shared else F.lit(0).cast("long")
    texts = texts.select("doc", tag.alias("tag"), "body")
    # Both joins below ask for the named texts by document, so one shuffle serves both (which
    # the plan test holds; it needs names that both sides keep).
    named, nameless = texts.filter("doc is not null"), texts.filter("doc is null")
    long = named.filter(F.octet_length("body") >= WINDOW)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blobs = anchor_blobs(long, BUCKETS_A_PARTITION * parts).repartition(F.expr("if(bucket < 0, -1 - bucket, bucket)"))
    marks = stored(context_marks(blobs), "marks")

    def contexts(size: Column) -> DataFrame:
        opened = marks.filter((F.col("anchor") >= 0) & size).groupBy(*keys)
        opened = opened.agg(F.collect_list(F.struct("first", "anchor")).alias("marks"))
        return open_contexts(named.join(opened, keys).select("doc", "tag", "body", "marks"))

    few = contexts(F.col("past") <= sort_rows).repartition("anchor")
    ends = sorted_marks(few.sortWithinPartitions("anchor", "doc", "at"))
    hot = window_marks(contexts(F.col("past") > sort_rows))
    spans = marks.filter("anchor < 0").unionByName(ends).unionByName(hot).groupBy(*keys)
    spans = spans.agg(F.collect_list(F.struct("first", "past")).alias("spans"))
    marked = named.join(spans, keys, "left").select("doc", "body", "spans")
    unmarked = nameless.select("doc", "body").withColumn("spans", F.lit(None).cast("array<struct<first int, past int>>"))
    return _without(marked.unionByName(unmarked), keep_bytes)
