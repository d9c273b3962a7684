"""Suffix-array dedup: bytes covered by a string of a given length that also starts anywhere else in the corpus.

Not every suffix has to be sorted. The smallest hash among the blocks (half the length) of a window stands at the same
place in every copy of the window, so a suffix is taken only where a block is the smallest of some window, about one byte in
a hundred, and no repeated window is without one. Such an anchor carries its context: the text around it that its own windows
cover. Blocks that stand once are out; contexts that repeat whole are told by their digest; only contexts that
share the block and differ are left, the edges of repeats.

These are sorted twice, as suffixes from the block to the right and, mirrored, to the left. A task sorts a run and
writes it front-coded: each entry as the length of the prefix it shares with the one before, and the rest. Blocks of
runs are exchanged by key range and merged by a loser tree that starts each comparison behind the prefix both are known to
share. The neighbours in the order have the longest matches to the right and to the left, and with them the
edges of the repeat. Where the longest match to one side and the longest to the other belong to different partners and
may not add up, the few windows in question are counted exactly.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import portions, read, slices, small_batches
from snapvault.session import settled

LENGTH = 400
BATCH_BYTES = 1 << 19  # texts whose hashes stand in memory at a time, about 100 bytes for each
SEGMENT = 1 << 18  # windows of a longer text are looked at in parts of so many
RUN_BYTES = 16 << 20  # contexts that a task sorts at a time
RANGE_BYTES = 4 << 20  # front-coded entries that a merge gets
BLOCK_ENTRIES = 128
END = b"\xff"  # in no UTF-8 text; parts the two sides of a context
_ODD = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _ODD, dtype=np.uint64)
    down = np.full(n, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """``pick`` over every ``width`` values in a row, by prefixes and suffixes of parts of that width."""
    n = len(values) - width + 1
    parts = np.full(-(-len(values) // width) * width, fill, dtype=np.uint64)
    parts[: len(values)] = values
    parts = parts.reshape(-1, width)
    prefix = pick.accumulate(parts, axis=1).ravel()
    suffix = np.ascontiguousarray(pick.accumulate(parts[:, ::-1], axis=1)[:, ::-1]).ravel()
    return pick(suffix[:n], prefix[width - 1 : width - 1 + n])


class Anchors:
    """Finds the anchors of texts. Keeps the powers of its hash between batches."""

    def __init__(self, length: int):
        self.length, self.block = length, max(1, length // 2)
        self.width = length - self.block + 1
        self._up, self._down = _powers(0)

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Index of the text, place, bytes of context before the place and behind the block, code of the block."""
        whole = b"".join(texts)
        n, k, w = len(whole), self.block, self.width
        if n < self.length:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
        if len(self._up) <= n:
            self._up, self._down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((np.frombuffer(whole, np.uint8).astype(np.uint64) + np.uint64(1)) * self._up[:n], out=sums[1:])
        code = (sums[k:] - sums[:-k]) * self._down[: n - k + 1]
        code ^= code >> np.uint64(32)
        code *= np.uint64(0xD6E8FEB86659FD93)
        code ^= code >> np.uint64(29)
        code >>= np.uint64(1)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(lengths)
        least = _sliding(code, w, np.minimum, (1 << 64) - 1)
        # Windows that reach into the next text are none; their minimum must not stand out.
        inside = np.zeros(n + 1, dtype=np.int32)
        has = lengths >= self.length
        np.add.at(inside, (ends - lengths)[has], 1)
        np.add.at(inside, (ends - self.length + 1)[has], -1)
        valid = np.cumsum(inside[: len(least)]) > 0
        least = np.where(valid, least + np.uint64(1), np.uint64(0))
        padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
        place = np.flatnonzero(_sliding(padded, w, np.maximum, 0) == code + np.uint64(1))
        text = np.searchsorted(ends, place, "right")
        before, behind = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(padded, w)
        for at in range(0, len(place), 4096):
            part = place[at : at + 4096]
            own = windows[part] == (code[part] + np.uint64(1))[:, None]
            before[at : at + 4096] = w - 1 - own.argmax(axis=1)
            behind[at : at + 4096] = w - 1 - own[:, ::-1].argmax(axis=1)
        return text, place - (ends - lengths)[text], before, behind, code[place]


def _digest(context: bytes, before: int) -> int:
    found = hashlib.blake2b(context, digest_size=8, person=before.to_bytes(8, "little")).digest()
    return int.from_bytes(found, "little", signed=True)


def _pack(place, before, behind):
    return (place << 32) | (before << 16) | behind


def _unpack(packed: int) -> tuple[int, int, int]:
    return packed >> 32, packed >> 16 & 0xFFFF, packed & 0xFFFF


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """``ref``, ``code``, ``digest``, ``pack`` of every anchor of ``texts`` (``ref``, ``text`` as bytes)."""
    block = max(1, length // 2)

    def run(batches):
        finder = Anchors(length)

        def rows(refs, parts, bases):
            text, place, before, behind, code = finder.find(parts)
            digests = [
                _digest(parts[t][p - b : p + block + e], b)
                for t, p, b, e in zip(text.tolist(), place.tolist(), before.tolist(), behind.tolist())
            ]
            place = place + np.array(bases, dtype=np.int64)[text]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(refs, dtype=np.int64)[text]),
                    pa.array(code.astype(np.int64)),
                    pa.array(digests, pa.int64()),
                    pa.array(_pack(place, before, behind)),
                ],
                names=["ref", "code", "digest", "pack"],
            )

        refs, parts, bases, size = [], [], [], 0
        for batch in batches:
            for low, high in portions(batch.column(1), BATCH_BYTES):
                for ref, text in zip(batch.column(0)[low:high].to_pylist(), batch.column(1)[low:high].to_pylist()):
                    for base in range(0, max(0, len(text) - length + 1), SEGMENT):
                        part = text[base : base + SEGMENT + length - 1]
                        if parts and size + len(part) > BATCH_BYTES:
                            yield rows(refs, parts, bases)
                            refs, parts, bases, size = [], [], [], 0
                        refs.append(ref)
                        parts.append(part)
                        bases.append(base)
                        size += len(part)
        if parts:
            yield rows(refs, parts, bases)

    return texts.mapInArrow(run, "ref bigint, code bigint, digest bigint, pack bigint")


# --- runs ------------------------------------------------------------------------------------------


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - ((differ.bit_length() + 7) >> 3)


def _keys(text: bytes, packed: int, block: int) -> tuple[tuple[bytes, int], tuple[bytes, int]]:
    """The context as a suffix to the right and, mirrored, to the left, each with the length of that side."""
    place, before, behind = _unpack(packed)
    right, left = text[place : place + block + behind], text[place - before : place + block][::-1]
    return (right + END + left[block:], len(right)), (left + END + right[block:], len(left))


_BLOCK = "side int, run string, block int, low binary, high binary, codes array<bigint>, data binary"
_HEAD = np.dtype([("shared", "<u4"), ("rest", "<u4"), ("side", "<u4"), ("code", "<i8"), ("digest", "<i8")])


def _encode(entries: list[tuple[bytes, int, int, int]], n_own: int) -> bytes:
    """Entries (key, length of its side, code, digest): heads, then what each key adds to the one before."""
    heads, rests, last = np.empty(len(entries), _HEAD), [], b""
    for i, (key, side, code, digest) in enumerate(entries):
        shared = shared_prefix(last, key)
        heads[i] = (shared, len(key) - shared, side, code, digest)
        rests.append(key[shared:])
        last = key
    return len(entries).to_bytes(4, "little") + n_own.to_bytes(4, "little") + heads.tobytes() + b"".join(rests)


def _decode(data: bytes) -> tuple[int, list[tuple[int, bytes, int, int, int]]]:
    """How many entries are the block's own, and all entries: shared, key, side, code, digest."""
    n, own = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    heads = np.frombuffer(data, _HEAD, n, 8)
    at, key, out = 8 + heads.nbytes, b"", []
    for shared, rest, side, code, digest in heads.tolist():
        key = key[:shared] + data[at : at + rest]
        at += rest
        out.append((shared, key, side, code, digest))
    return own, out


def _run_blocks(entries: list[tuple], side: int, run: str, block: int, many: int) -> Iterator[tuple]:
    """Rows of a run. ``low`` to ``high`` are the keys whose neighbours may be in the block: up to the next block's
    first key while that has the same first bytes, else to the end of those that have them; so at the front."""
    entries.sort()
    for number, at in enumerate(range(0, len(entries), many)):
        own = entries[at : at + many]
        after = entries[at + many : at + many + 1]
        first, last = own[0][0], own[-1][0]
        low = first if at and entries[at - 1][0][:block] == first[:block] else first[:block]
        high = after[0][0] if after and after[0][0][:block] == last[:block] else last[:block] + END * 4 * block
        codes = sorted({e[2] for e in own})
        yield side, run, number, low, high, codes, _encode(own + after, len(own))


def runs(contexts: DataFrame, length: int) -> DataFrame:
    """Sorted front-coded runs of the contexts of ``contexts``: text and ``marks``, structs of pack, code and digest."""
    block = max(1, length // 2)

    def run(batches):
        right, left, size = [], [], 0

        def rows():
            name = uuid.uuid4().hex
            for side, entries in enumerate((right, left)):
                columns = list(zip(*_run_blocks(entries, side, name, block, BLOCK_ENTRIES), strict=True))
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary())
                names = ["side", "run", "block", "low", "high", "codes", "data"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            for low, high in portions(batch.column(0), 2 * BATCH_BYTES, 100):
                for text, marks in zip(batch.column(0)[low:high].to_pylist(), batch.column(1)[low:high].to_pylist()):
                    for mark in marks:
                        one, two = _keys(text, mark["pack"], block)
                        right.append((*one, mark["code"], mark["digest"]))
                        left.append((*two, mark["code"], mark["digest"]))
                        size += 2 * len(one[0])
                        if size >= RUN_BYTES:
                            yield from rows()
                            right, left, size = [], [], 0
        if right:
            yield from rows()

    return contexts.mapInArrow(run, _BLOCK)


# --- merge -----------------------------------------------------------------------------------------


def _entries_of(blocks: list[bytes]) -> Iterator[tuple]:
    """The entries of one run's consecutive blocks; the entry behind a block is only given behind the last."""
    last = b""
    for i, data in enumerate(blocks):
        own, entries = _decode(data)
        for j, (shared, key, side, code, digest) in enumerate(entries[: own if i + 1 < len(blocks) else len(entries)]):
            yield (shared_prefix(last, key) if i and not j else shared), key, side, code, digest
            last = key


def merged(readers: list[Iterator[tuple]]) -> Iterator[tuple]:
    """All entries in order, each with the prefix it shares with the one before.

    A loser tree: every loser remembers how much it shares with the one that beat it. After an entry has left, all that its
    successor meets are such losers. Who shares more with the entry that left comes first, without a look at the keys;
    only equals are compared, from there on.
    """
    current: list[tuple | None] = [next(r, None) for r in readers]
    shared = [0] * len(readers)
    size = 1
    while size < len(readers):
        size *= 2

    def play(a: int, b: int) -> tuple[int, int]:
        if b >= len(readers) or current[b] is None:
            return a, b
        if a >= len(readers) or current[a] is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        one, two = current[a][1], current[b][1]
        same = shared_prefix(one, two, shared[a])
        if one[same : same + 1] <= two[same : same + 1]:
            shared[b] = same
            return a, b
        shared[a] = same
        return b, a

    losers = [0] * size
    winners = list(range(size))
    while len(winners) > 1:
        base = len(winners) // 2
        nexts = []
        for i in range(base):
            w, losers[base + i] = play(winners[2 * i], winners[2 * i + 1])
            nexts.append(w)
        winners = nexts
    winner = winners[0]
    while winner < len(readers) and current[winner] is not None:
        entry = current[winner]
        yield (shared[winner], *entry[1:])
        current[winner] = following = next(readers[winner], None)
        if following is not None:
            shared[winner] = following[0]
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def neighbours(entries: Iterator[tuple], block: int, length: int, side: int, low: bytes, high: bytes | None) -> Iterator[tuple]:
    """For entries from ``low`` up to ``high``: code, digest, the longest match to the side, and of the matches with a
    neighbour that reach ``length`` the most before the place and from it on. Entries beyond the range are only met."""
    last, found = None, None

    def told():
        _, key, _, code, digest = last
        if found[0] >= block and low <= key and (high is None or key < high):
            yield code, digest, found[0], found[1], found[2]

    for entry in entries:
        now = [0, 0, 0]
        if last is not None:
            same = entry[0]
            _, key, near, code, _ = last
            if same == len(key) == len(entry[1]):
                continue  # the entry itself, sent with a block and with the one before
            reach = min(same, near, entry[2])
            if reach >= block and code == entry[3]:
                if same > near == entry[2]:
                    other = same - near - 1
                else:
                    other = shared_prefix(key[near + 1 :], entry[1][entry[2] + 1 :])
                before, on = (other, reach) if side == 0 else (reach - block, block + other)
                for x in (found, now):
                    x[0] = max(x[0], reach)
                    if before + on >= length:
                        x[1], x[2] = max(x[1], before), max(x[2], on)
            yield from told()
        last, found = entry, now
    if last is not None:
        yield from told()


def sorted_matches(blocks: DataFrame, length: int) -> DataFrame:
    """``code``, ``digest`` with ``reach`` to the right (``side`` 0) or left (1), ``before`` and ``on`` of the contexts
    that have a neighbour with the same block."""
    block = max(1, length // 2)
    sizes = {r["side"]: r["n"] for r in blocks.groupBy("side").agg(F.sum(F.length("data")).alias("n")).collect()}
    cuts: dict[int, list[bytes]] = {}
    for side, n in sizes.items():
        ranges = -(-n // RANGE_BYTES)
        # Bounded by the number of ranges: some block borders by hash, evenly thinned out.
        some = blocks.filter(F.col("side") == side).select("low").orderBy(F.xxhash64("low", "run"), "run").limit(16 * ranges)
        lows = sorted(bytes(r["low"]) for r in some.collect()) if ranges > 1 else []
        cuts[side] = sorted({lows[len(lows) * i // ranges] for i in range(1, ranges)} if lows else set())
    shared = blocks.sparkSession.sparkContext.broadcast(cuts)

    def route(batches):
        for batch in batches:
            rows = []
            for side, run, number, low, high, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                own = shared.value[side]
                for k in range(bisect_right(own, low), bisect_right(own, high) + 1):
                    rows.append((side, k, run, number, data))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["side", "part", "run", "block", "data"])

    def merge(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

        for (side, part), mine in groupby(rows(), key=itemgetter(0, 1)):
            readers = [_entries_of([r[4] for r in of_run]) for _, of_run in groupby(mine, key=itemgetter(2))]
            own = shared.value[side]
            low, high = own[part - 1] if part else b"", own[part] if part < len(own) else None
            out = list(neighbours(merged(readers), block, length, side, low, high))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*arrays[:2], pa.array([side] * len(out), pa.int32()), *arrays[2:]],
                names=["code", "digest", "side", "reach", "before", "on"],
            )

    routed = blocks.select("side", "run", "block", "low", "high", "data")
    routed = routed.mapInArrow(route, "side int, part int, run string, block int, data binary")
    routed = routed.repartition("side", "part").sortWithinPartitions("side", "part", "run", "block")
    return routed.mapInArrow(merge, "code bigint, digest bigint, side int, reach bigint, before bigint, on bigint")


# --- windows in question ---------------------------------------------------------------------------


def counted_windows(blocks: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """``code``, ``digest``, ``before``, ``on`` by counting windows of the contexts that share a block with an open one: those that
    reach no further from the block than the longest matches of any open one (``to_left``, ``to_right``)."""
    block = max(1, length // 2)
    codes = open_.groupBy("code").agg((length - F.max("to_right")).alias("least"), F.max("to_left").alias("most"))
    right = blocks.filter("side = 0")
    asked = right.select("run", "block", F.explode("codes").alias("code")).join(codes, "code")
    asked = asked.groupBy("run", "block").agg(F.collect_list(F.struct("code", "least", "most")).alias("asked"))
    asked = right.select("run", "block", "data").join(asked, ["run", "block"]).select("data", "asked")

    def windows(batches):
        for batch in batches:
            for data, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wanted, rows = {w["code"]: (w["least"], w["most"]) for w in wanted}, []
                own, entries = _decode(data)
                for _, key, side, code, digest in entries[:own]:
                    if code in wanted:
                        left = key[side + 1 :][::-1]
                        context = left + key[:side]
                        least, most = wanted[code]
                        for at in range(max(0, len(left) - most), min(len(context) - length, len(left) - least) + 1):
                            found = hashlib.blake2b(context[at : at + length], digest_size=8).digest()
                            rows.append((code, digest, len(left) - at, int.from_bytes(found, "little", signed=True)))
                for low in range(0, len(rows), 50_000):
                    columns = list(zip(*rows[low : low + 50_000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["code", "digest", "before", "w"])

    all_windows = asked.mapInArrow(windows, "code bigint, digest bigint, before bigint, w bigint")
    all_windows = settled(all_windows, "repeat-windows")
    twice = all_windows.groupBy("code", "before", "w").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    twice = twice.filter("a <> b").select("code", "before", "w")
    found = all_windows.join(twice, ["code", "before", "w"]).groupBy("code", "digest")
    return found.agg(F.max("before").alias("before"), (length - F.min("before")).alias("on"))


# --- all together ------------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Every row's ``key``, ``n_bytes``, ``spans`` (maximal runs of bytes to remove: start, end) and ``kept_sha256``.

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere, in any text or the same one. Null text:
    empty. Repeated rows are copies of each other. Texts shorter than ``length`` stay whole. No rows: no rows. Null and
    repeated keys are kept as they are. ``length`` is 2 to 60,000. Where the session leaves the size of Arrow batches at its default, it is
    made smaller, so that few texts stand in a Python worker at a time.
    """
    small_batches(docs.sparkSession)
    if not 2 <= length <= 60_000:
        raise ValueError("the length must be 2 to 60,000")
    block = max(1, length // 2)
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    named = docs.select(F.col(f"`{key}`").alias("key"), F.sha2(value, 256).alias("blob"), value.alias("text"))
    named = named.select("key", "blob", F.xxhash64("blob").alias("ref"), "text")
    long = F.length("text") >= length
    rows = settled(named.select("key", "blob", "ref", F.length("text").cast("bigint").alias("n_bytes")), "repeat-rows")

    found = settled(anchors(named.filter(long).select("ref", "text"), length), "repeat-anchors")
    spot = F.xxhash64("ref", "pack")
    twice = found.groupBy("code").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("code")
    twice = settled(twice, "repeat-codes")
    found = settled(found.join(twice, "code"), "repeat-candidates")
    contexts = found.groupBy("code", "digest").agg(
        F.min(F.struct("ref", "pack")).alias("one"), F.max(F.struct("ref", "pack")).alias("other")
    )
    contexts = contexts.select("code", "digest", "one.ref", "one.pack", (F.col("one") != F.col("other")).alias("whole"))
    contexts = settled(contexts, "repeat-contexts")
    # Settled, so that a block that a third of all contexts share can be split where they meet.
    several = settled(contexts.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1").select("code"), "repeat-codes")
    edges = contexts.join(several, "code").groupBy("ref").agg(F.collect_list(F.struct("pack", "code", "digest")).alias("marks"))
    texts = named.filter(long).groupBy("ref").agg(F.any_value("text").alias("text"))
    blocks = runs(texts.join(edges, "ref").select("text", "marks"), length)
    blocks = settled(blocks, "repeat-runs")

    matches = sorted_matches(blocks, length).groupBy("code", "digest").agg(
        F.coalesce(F.max(F.when(F.col("side") == 0, F.col("reach"))), F.lit(0)).alias("to_right"),
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("reach") - block)), F.lit(0)).alias("to_left"),
        F.max("before").alias("before"),
        F.max("on").alias("on"),
    )
    matches = settled(matches.filter(F.col("to_left") + F.col("to_right") >= length), "repeat-matches")
    open_ = contexts.filter("not whole").select("code", "digest").join(
        matches.filter("before < to_left or on < to_right"), ["code", "digest"]
    )
    counted = counted_windows(blocks, open_, length)
    sure = matches.filter("on > 0").select("code", "digest", "before", "on")
    reached = sure.unionByName(counted).groupBy("code", "digest").agg(F.max("before").alias("before"), F.max("on").alias("on"))

    place = F.shiftright("pack", 32)
    known = contexts.join(reached, ["code", "digest"], "left").filter("whole or on is not null")
    known = known.select(
        "code", "digest",
        F.when(F.col("whole"), F.shiftright("pack", 16).bitwiseAND(F.lit(0xFFFF))).otherwise(F.col("before")).alias("before"),
        F.when(F.col("whole"), F.col("pack").bitwiseAND(F.lit(0xFFFF)) + block).otherwise(F.col("on")).alias("on"),
    )
    known = settled(known, "repeat-known")
    covered = found.join(known, ["code", "digest"]).select(
        "ref", F.struct((place - F.col("before")).alias("start"), (place + F.col("on")).alias("end")).alias("s")
    )
    covered = covered.distinct().groupBy("ref").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    several = rows.groupBy("ref").agg(F.count("*").alias("copies"))
    whole = several.filter("copies > 1").select("ref", F.lit(True).alias("copied"))
    cut = texts.join(covered, "ref").join(whole, "ref", "left_anti").mapInArrow(
        _cut, "ref bigint, spans array<array<bigint>>, kept_sha256 string"
    )
    out = rows.join(cut, "ref", "left").join(whole, "ref", "left")
    all_of_it = F.col("copied") & (F.col("n_bytes") >= length)
    return out.select(
        F.col("key").alias(key),
        "n_bytes",
        F.when(all_of_it, F.array(F.array(F.lit(0).cast("bigint"), F.col("n_bytes"))))
        .otherwise(F.coalesce("spans", F.array().cast("array<array<bigint>>")))
        .alias("spans"),
        F.when(all_of_it, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "blob")).alias("kept_sha256"),
    )


def _cut(batches):
    for batch in slices(batches, 100):
        refs, spans, digests = batch.column("ref"), [], []
        for text, parts in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            own, kept, at = [], hashlib.sha256(), 0
            for s in parts:
                if own and s["start"] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], s["end"])
                else:
                    own.append([s["start"], s["end"]])
            for start, end in own:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            spans.append(own)
            digests.append(kept.hexdigest())
        arrays = [refs, pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["ref", "spans", "kept_sha256"])


def query(spark, sf_dir):
    found = repeated_spans(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x[1] - x[0])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )
