"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius, and their groups.

Fingerprints within the radius agree in some blocks of their bits, so each distinct fingerprint goes into a bucket for every
choice of blocks that must agree. In a bucket the fingerprints stand as bit planes, 64 of them in a word: one query is
compared with 64 at a time, distances grow in carry-save bitwise counters, and words whose every distance is above
the radius are abandoned. A bucket yields a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import LOWER, field, map_texts, spaced_words
from snapvault.session import settled

BITS = 64
SEED = 42
BLOCKS = 6
CHUNK = 4096  # larger buckets are compared chunk by chunk, each pair of chunks on its own
SLICE = 1 << 15  # pairs of a query and a word that are compared at a time


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Bit by bit the majority of the shingles' XXH64, as unsigned 64 bits; no word: 0."""
    words = spaced_words(text.translate(LOWER)) if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts, stops = [0, *ends][:n], ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a : b - 1], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fingerprint``, a bigint of the same bits; null and texts without words: 0."""

    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)]

    return map_texts(docs, text, make, [field("fingerprint", "bigint")], keep)


def _edges(radius: int) -> list[tuple[int, int]]:
    """Blocks of bits: first bit and width. At least BLOCKS - radius of them agree within the radius."""
    n = max(BLOCKS, radius + 2)
    bounds = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def buckets(distinct: DataFrame, radius: int) -> DataFrame:
    """``bucket`` and ``fp``: a row for every choice of blocks that agree; equal buckets mean equal blocks."""
    blocks = _edges(radius)
    values = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in blocks]
    choices = []
    for k, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - radius)):
        key = F.lit(k).cast("bigint")
        for b in chosen:
            key = F.shiftleft(key, blocks[b][1]).bitwiseOR(values[b])
        choices.append(key)
    return distinct.select(F.explode(F.array(*choices)).alias("bucket"), "fp")


def compare_sorted(groups: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows that stand sorted by group: indices of a row and its component's first row."""
    n = len(fps)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    opens = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    end = np.repeat(np.r_[opens[1:], n], np.diff(np.r_[opens, n]))
    words = (n + 63) // 64
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[:n] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)
    asked = (np.uint64(0) - np.ascontiguousarray(bits[:n].T).astype(np.uint64))
    rows = np.arange(n)
    first, last = (rows + 1) >> 6, (end - 1) >> 6
    spans = np.where(rows + 1 < end, last - first + 1, 0)
    until = np.cumsum(spans)
    parent = rows.copy()
    for at in range(0, int(until[-1]), SLICE):
        pair = np.arange(at, min(at + SLICE, int(until[-1])))
        query = np.searchsorted(until, pair, "right")
        word = first[query] + pair - (until[query] - spans[query])
        near = _near(planes, asked, query, word, _lanes(query + 1, word) & ~_lanes(end[query], word), radius)
        lanes = np.unpackbits(near[2].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, lane = np.nonzero(lanes)
        _unite(parent, near[0][hit], near[1][hit] * 64 + lane)
    linked = np.flatnonzero(parent != rows)
    return linked, parent[linked]


def _lanes(start: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A bit for each lane of a word at or behind a row."""
    shift = np.clip(start - word * 64, 0, 64)
    return np.where(shift >= 64, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) << np.minimum(shift, 63).astype(np.uint64))


def _near(planes, asked, query, word, alive, radius):
    """Queries, words and lanes within the radius. Counters of 1, 2 and 4 and an overflow, one bit a lane; three planes
    at a time pass a full adder before they meet the counters."""
    ones, twos, fours = (np.zeros(len(query), np.uint64) for _ in range(3))
    over = np.zeros(len(query), np.uint64)
    for b in range(0, BITS, 3):
        x, *more = (planes[k][word] ^ asked[k][query] for k in range(b, min(b + 3, BITS)))
        carry = np.zeros_like(x)
        if more:
            y, z = more
            half = x ^ y
            carry = (x & y) | (half & z)
            x = half ^ z
        to_two = ones & x
        ones ^= x
        to_four = (twos & to_two) | (twos & carry) | (to_two & carry)
        twos ^= to_two ^ carry
        over |= fours & to_four
        fours ^= to_four
        if b % 12 == 9 or b + 3 >= BITS:
            alive = alive & ~(over | _above(ones, twos, fours, radius))
            keep = np.flatnonzero(alive)
            if len(keep) < len(alive):
                query, word, alive, ones, twos, fours, over = (v[keep] for v in (query, word, alive, ones, twos, fours, over))
    return query, word, alive


def _above(ones, twos, fours, radius):
    """Lanes whose counter, 0 to 7, is above the radius."""
    values = [
        (fours if v & 4 else ~fours) & (twos if v & 2 else ~twos) & (ones if v & 1 else ~ones) for v in range(radius + 1, 8)
    ]
    return reduce(np.bitwise_or, values, np.zeros_like(ones))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of the links; every row's parent is its component's first row afterwards."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def near_links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """``a`` and ``b``: links that connect all distinct fingerprints (``fp``) within the radius of each other."""
    if not 0 <= radius <= 7:
        raise ValueError("the radius must be 0 to 7")
    entries = buckets(distinct, radius)
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    entries = entries.join(sizes, "bucket")
    parts = F.ceil(F.col("n") / CHUNK)
    entries = entries.withColumn("own", F.pmod(F.xxhash64("fp"), parts))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    entries = entries.select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("g"),
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp",
    )
    entries = entries.repartition("g").sortWithinPartitions("g", "bucket", "i", "j", "fp")

    def links(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                table, rest = _whole_groups(held, last=False)
                held, size = rest, sum(b.num_rows for b in rest)
                if table is not None:
                    yield from _linked(table, radius)
        if held:
            yield from _linked(_whole_groups(held, last=True)[0], radius)

    return entries.mapInArrow(links, "a bigint, b bigint").distinct()


def _columns(batches):
    return [np.concatenate([b.column(i).to_numpy() for b in batches]) for i in range(5)]


def _whole_groups(held, last):
    columns = _columns(held)
    if last:
        return columns, []
    change = np.zeros(len(columns[0]), dtype=bool)
    for c in columns[:4]:
        change[1:] |= c[1:] != c[:-1]
    ends = np.flatnonzero(change)
    if not len(ends):
        return None, held
    cut = int(ends[-1])
    rest = pa.RecordBatch.from_arrays([pa.array(c[cut:]) for c in columns], names=list("gbijf"))
    return [c[:cut] for c in columns], [rest]


def _linked(columns, radius):
    change = np.zeros(len(columns[0]), dtype=np.int64)
    for c in columns[:4]:
        change[1:] |= c[1:] != c[:-1]
    fps = np.ascontiguousarray(columns[4])
    a, b = compare_sorted(np.cumsum(change), fps.view(np.uint64), radius)
    yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has a link.

    Links to larger neighbours and to smaller ones are in turn moved to the smallest neighbour until nothing moves; each
    round is written to the shared folder, only its number and sum of links come to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = settled(edges, "links")
    told = None
    while True:
        both = edges.union(edges.select("v", "u"))
        # The smallest neighbours are settled, so that a node with very many links can be split where they meet.
        lowest = settled(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "links")
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large.filter("u <> v"), "links")
        lowest = settled(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", "m"))
        edges = settled(small.filter("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == told:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        told = now


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key reachable over links.

    Null texts and texts without words have fingerprint 0 and are linked like any other. Rows with a null key keep their
    fingerprint and count for links; a group of null keys only has a null component. Repeated rows stay repeated rows.
    """
    fps = settled(fingerprints(docs, text=text, shingle=shingle, keep=[key]), "fingerprints")
    own = fps.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(F.col(f"`{key}`")).alias("least"))
    own = settled(own, "distinct-fingerprints")
    roots = components(near_links(own.select("fp"), radius))
    rooted = own.join(roots, own.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(lowest, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return fps.join(known, "fingerprint").select(
        F.col(f"`{key}`"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def query(spark, sf_dir):
    from snapvault.llm.common import read

    return near_duplicates(read(spark, sf_dir, "documents"))
