"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents.

Every window of an item's words is a sequence of word shingles. Shingles are ordered by how often they stand in the corpus,
and a window that occurs whole must share its rarest one with the document, so only that one is joined. Where it
stands fixes where the window would lie; windows that would begin before the document or end behind it are out (position
and length), and the rest are compared word by word. Items come in parts of bounded size; what the parts hit in a document is
united before the document is judged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.llm.common import map_texts, plain_words, slices
from snapvault.session import settled

WINDOW = 13
SHINGLE = 5
#: Item words that go to every task at a time; their windows take about 170 MB of a worker.
PART_WORDS = 200_000
ROW = "__row"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """The distinct windows of some items, their shingles' codes, and which items have them."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for _, words in items for w in words}))}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            numbers = [self.ids[w] for w in words]
            for at in range(max(1, len(numbers) - window + 1)):
                owners.setdefault(tuple(numbers[at : at + window]), set()).update([] if item is None else [item])
        self.windows = sorted(owners)
        self.items = [sorted(owners[w]) for w in self.windows]
        self.lengths = sorted({min(SHINGLE, len(w)) for w in self.windows})
        self.codes = list(self._codes())
        self.shingles = np.unique(np.concatenate([np.empty(0, np.uint64), *(own.ravel() for _, own in self.codes)]))
        self._prefixes: tuple | None = None

    def _codes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each size of window: which windows have it, and the codes of their shingles, one window a row."""
        sizes = np.array([len(w) for w in self.windows], dtype=np.int64)
        for size in np.unique(sizes).tolist():
            which = np.flatnonzero(sizes == size)
            flat = np.array([self.windows[k] for k in which.tolist()], dtype=np.int64).ravel()
            n = min(SHINGLE, size)
            at = (np.arange(len(which)) * size)[:, None] + np.arange(size - n + 1)
            yield which, codes(flat, n, at.ravel()).reshape(at.shape)

    def order(self, counts: np.ndarray) -> None:
        """Choose each window's rarest shingle; ``counts`` stand beside ``shingles``."""
        keys, which, offsets = [], [], []
        for windows, own in self.codes:
            places = np.argmin(counts[np.searchsorted(self.shingles, own)], axis=1)
            keys += own[np.arange(len(own)), places].tolist()
            which += windows.tolist()
            offsets += places.tolist()
        self.codes = []
        order = np.argsort(np.array(keys, dtype=np.uint64), kind="stable")
        self._prefixes = tuple(np.array(x, dtype=t)[order] for x, t in ((keys, np.uint64), (which, np.int64), (offsets, np.int64)))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, 0) for w in words], dtype=np.int64)

    def standing(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document where shingles of the windows stand, and their index."""
        places, found = [], []
        for n in self.lengths:
            at = np.flatnonzero(_all_known(numbers, n))
            if not len(at):
                continue
            own = codes(numbers, n, at)
            index = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
            hit = self.shingles[index] == own
            places.append(at[hit])
            found.append(index[hit])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(places), np.concatenate(found)

    def occurrences(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and number of every window that stands in the document."""
        keys, which, offsets = self._prefixes
        places, found = self.standing(numbers)
        if not len(places):
            return
        own = self.shingles[found]
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        met = np.flatnonzero(high > low)
        tried = set()
        for p, a, b in zip(places[met].tolist(), low[met].tolist(), high[met].tolist()):
            for j in range(a, b):
                start, k = p - int(offsets[j]), int(which[j])
                window = self.windows[k]
                if start < 0 or start + len(window) > len(numbers) or (start, k) in tried:
                    continue
                tried.add((start, k))
                if tuple(numbers[start : start + len(window)].tolist()) == window:
                    yield start, k


def _all_known(numbers: np.ndarray, n: int) -> np.ndarray:
    """Places where ``n`` words in a row are words of the items."""
    if len(numbers) < n:
        return np.zeros(0, dtype=bool)
    unknown = np.concatenate([[0], np.cumsum(numbers == 0)])
    return unknown[n:] == unknown[:-n]


def codes(numbers: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit code of the ``n`` words from each place; equal words have equal codes, and matches are verified later."""
    at = np.arange(len(numbers) - n + 1) if at is None else at
    code = np.full(len(at), n, dtype=np.uint64)
    for k in range(n):
        code = (code ^ numbers[at + k].astype(np.uint64)) * _MIX
        code ^= code >> np.uint64(29)
    return code


def read_items(
    benchmark: DataFrame, *, item: str = "item_id", text: str = "text", part: int = PART_WORDS, overlap: int = WINDOW - 1,
    null_items: bool = False,
) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items and their words in parts of at most ``part`` words, read one part at a time. Items without words (null or
    empty) are left out, without ``null_items`` also those with a null id; several rows of one item are windows of that one item. A longer item is cut into pieces that
    overlap, so that each of its windows lies whole in one."""
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("binary").alias("text"))
    rows = rows.dropna(subset=["text"] if null_items else ["item", "text"])
    part = max(part, 2 * overlap + 2)
    items, size = [], 0
    for name, value in rows.toLocalIterator():
        words = plain_words(bytes(value))
        for at in range(0, max(1, len(words) - overlap) if words else 0, part - overlap):
            piece = words[at : at + part]
            if size + len(piece) > part:
                yield items
                items, size = [], 0
            items.append((name, piece))
            size += len(piece)
    if items:
        yield items


def shingle_counts(docs: DataFrame, windows: Windows, *, text: str = "text") -> np.ndarray:
    """How often each shingle of the windows stands in all documents; as many numbers as there are shingles."""

    def count(batches):
        total = np.zeros(len(windows.shingles), dtype=np.int64)
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                if value:
                    total += np.bincount(windows.standing(windows.numbers(plain_words(value)))[1], minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["shingle", "n"])

    counts = np.zeros(len(windows.shingles), dtype=np.int64)
    texts = docs.select(F.col(f"`{text}`").cast("binary").alias("t"))
    for row in texts.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n")).collect():
        counts[row[0]] = row[1]
    return counts


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None, item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, share: int = 20, part_words: int = PART_WORDS, null_items: bool = False,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hits`` (the hit word ranges as start, end), ``items`` (sorted, as strings) and
    ``contaminated``.

    A word is hit inside any occurrence of a window: ``window`` consecutive words of an item, or all words of a shorter
    one. A document is contaminated if a ``share``-th of its words or more is hit. Null and empty documents have no
    words and are clean; without items every document is clean. Windows that several items share count for each.

    Benchmark rows with a null ``item`` are left out unless ``null_items``; then what they hit counts in ``n_hit``, ``hits`` and
    ``contaminated`` like any other, and ``items`` does not list them, so a hit document may have no items.

    A benchmark of more than ``part_words`` words is joined part by part, each with a pass over ``docs``; hits of all parts are
    united per row before it is judged.
    """
    parts = read_items(benchmark, item=item, text=item_text, part=part_words, overlap=window - 1, null_items=null_items)
    first = next(parts, [])
    second = next(parts, None)
    if second is not None:
        return _in_parts(docs, chain([first, second], parts), text, keep, window, share)
    windows = _ordered(docs, first, window, text)

    def make():
        def one(value):
            words = plain_words(value) if value else []
            ranges, items = _found(windows, words)
            hit = sum(b - a for a, b in ranges)
            return len(words), hit, ranges, items, hit > 0 and share * hit >= len(words)

        return lambda texts: list(zip(*map(one, texts), strict=True)) or [[]] * 5

    return map_texts(docs, text, make, FIELDS, keep)


NUMBERS = T.ArrayType(T.LongType())
FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", T.ArrayType(NUMBERS)),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("contaminated", T.BooleanType()),
]


def _ordered(docs, items, window, text):
    windows = Windows(items, window)
    windows.order(shingle_counts(docs, windows, text=text))
    return windows


def _found(windows: Windows, words: list[bytes]) -> tuple[list[list[int]], list[str]]:
    """The hit ranges of a document, and the items that hit it."""
    items, spans = set(), []
    for start, k in windows.occurrences(windows.numbers(words)):
        items.update(windows.items[k])
        spans.append((start, start + len(windows.windows[k])))
    return _merged(spans), sorted(items)


def _merged(spans) -> list[list[int]]:
    ranges = []
    for a, b in sorted(spans):
        if ranges and a <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], b)
        else:
            ranges.append([a, b])
    return ranges


def _in_parts(docs, parts, text, keep, window, share):
    """As :func:`decontaminate`, with the items in several parts. Rows are numbered and written once, so that the hits of every
    part meet at the right row; only rows with hits are written for a part."""
    names = [f.name for f in FIELDS]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    inner = text if text in kept else "__text"
    own = [F.col(f"`{c}`") for c in kept]
    rows = docs.select(*own, *([] if inner in kept else [F.col(f"`{text}`").alias(inner)]), F.monotonically_increasing_id().alias(ROW))
    rows = settled(rows, "decontaminate-rows")
    hits = None
    for items in parts:
        windows = _ordered(rows, items, window, inner)
        found = map_texts(rows, inner, partial(_hits, windows), [FIELDS[2], FIELDS[3]], [ROW]).filter("size(hits) > 0")
        found = settled(found, "decontaminate-hits")
        hits = found if hits is None else hits.union(found)
    hits = hits.groupBy(ROW).agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))

    def unite(batches):
        for batch in slices(batches):
            ranges = [_merged(x) for x in batch.column(1).to_pylist()]
            items = [sorted(set(x)) for x in batch.column(2).to_pylist()]
            n = [sum(b - a for a, b in x) for x in ranges]
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(ranges, batch.column(1).type), pa.array(items, batch.column(2).type)]
            yield pa.RecordBatch.from_arrays(arrays, names=[ROW, *names[1:4]])

    united = hits.mapInArrow(unite, T.StructType([T.StructField(ROW, T.LongType()), *FIELDS[1:4]]))
    counted = map_texts(rows, inner, _count, [FIELDS[0]], [*kept, ROW]).join(united, ROW, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return counted.select(
        *own, "n_words", n_hit.alias("n_hit"), *(F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name) for f in FIELDS[2:4]),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _hits(windows):
    return lambda texts: list(zip(*(_found(windows, plain_words(t) if t else []) for t in texts), strict=True)) or [[]] * 2


def _count():
    return lambda texts: [[len(plain_words(t)) if t else 0 for t in texts]]


def query(spark, sf_dir):
    from snapvault.llm.common import read

    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"], null_items=True)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )

