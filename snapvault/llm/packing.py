"""Best-fit packing by linear grouping: whole documents into as few sequences of bounded length as can be.

All that packing needs to know of a corpus is how many pieces there are of each length, at most ``capacity`` numbers. Large
lengths are rounded up within groups of equal cardinality, so only a few sizes are left; patterns of those sizes that
fill a sequence best are chosen one after another and repeated as often as the sizes allow; real pieces take
the places of their group, and small pieces go, longest first, to the tightest gap that still takes them. The plan
speaks of ranks of pieces of one length and of runs of sequences, so it is as small as the lengths are few; pieces look up
their place by length and rank on the executors.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import TEXT, portions, small_batches, worker_cache
from snapvault.session import settled

CAPACITY = 4096
END_ID = 1
PART_BYTES = 2 << 20  # texts whose words and ids stand in memory at a time, some 20 bytes for each
MEMO = 600_000  # runs of letters and other words whose ids a worker remembers at most; some 200 bytes each
_MARKS = ".,;:!?#$%&*|"
_LETTERS = r"A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}"
_PLAIN = f"^[{_LETTERS}]+[{re.escape(_MARKS)}]*$"


class WordIds:
    """Token ids of texts. Space and line breaks part words for the tokenizer, so a word has the same ids wherever it stands,
    and each distinct one of a batch is looked at once.

    Most words are a run of letters and some punctuation, which the tokenizer parts from each other, and it lower-cases. For
    words whose letters are below U+0100, where that is beyond doubt, run and punctuation are units of their own, and runs
    are tokenized in lower case, many in one line: their last token is one that ends a word. Other words are one unit.

    Ids of units are remembered in two generations of half of ``MEMO`` units: when the new one is full, the old one goes, and
    units that are met again move to the new one, so words in use stay.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin and the last one's end. A null has none."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        starts = words.offsets.to_numpy() - words.offsets[0].as_py()
        ids, ends = self._of_words(words.flatten())
        return ids, ends[starts]

    def learn(self, texts: list[list[bytes]]) -> None:
        for words in texts:
            self._of_words(pa.array(words, pa.binary()).cast(pa.string()))

    def ids(self, words: list[bytes]) -> bytes:
        return self._of_words(pa.array(words, pa.binary()).cast(pa.string()))[0].tobytes()

    def _of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and where each word's begin and the last one's end."""
        words = words.dictionary_encode()
        plain = pc.match_substring_regex(words.dictionary, _PLAIN)
        text = pc.if_else(plain, pc.utf8_lower(words.dictionary), words.dictionary)
        head = pc.if_else(plain, pc.utf8_rtrim(text, characters=_MARKS), text)
        # Two units a word in the same bytes: its head, and what is left of it, which may be empty.
        starts = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        cuts = np.empty(2 * len(text) + 1, np.int32)
        cuts[::2] = starts
        cuts[1::2] = starts[:-1] + pc.binary_length(head).to_numpy()
        units = pa.StringArray.from_buffers(2 * len(text), pa.py_buffer(cuts), text.buffers()[2]).dictionary_encode()
        found = self._of_units(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(found), "<u4")
        ids, ends = _taken(ids, _ends(np.fromiter(map(len, found), np.int64, len(found)) // 4), units.indices)
        return _taken(ids, ends[::2], words.indices)

    def _of_units(self, units: list[str]) -> list[bytes]:
        found = list(map(self._known.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new, older = {}, self._older
        runs, whole = [], []
        for i in missing:
            unit = units[i]
            ids = older.get(unit)
            if ids is not None:
                new[unit] = ids
            elif unit.isalpha() and (unit.isascii() or max(unit) <= "\xff"):
                runs.append(unit)
            elif unit:
                whole.append(unit)
            else:
                new[unit] = b""
        new.update(self._of_runs(runs))
        new.update(zip(whole, self._encode(whole)))
        for i in missing:
            found[i] = new[units[i]]
        if len(self._known) + len(new) > MEMO // 2:
            self._older, self._known = self._known, {}
        self._known.update(islice(new.items(), MEMO // 2))
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _of_runs(self, runs: list[str]) -> Iterator[tuple[str, bytes]]:
        lines = [runs[i : i + 200] for i in range(0, len(runs), 200)]
        for line, ids in zip(lines, self._encode([" ".join(line) for line in lines])):
            stops = (4 * (np.flatnonzero(self._ends[np.frombuffer(ids, "<u4")]) + 1)).tolist()
            if len(stops) == len(line):
                own = [ids[a:b] for a, b in zip([0, *stops], stops)]
            else:  # a vocabulary without marks of word ends
                own = self._encode(line)
            yield from zip(line, own)


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])


def _taken(ids: np.ndarray, ends: np.ndarray, which: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs of ids between ``ends`` those at ``which``, one after another, and where they begin and end."""
    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids)).take(which)
    return lists.flatten().to_numpy(), _ends(np.diff(ends)[which.to_numpy()])


def _word_ids(tokenizer_file: str) -> WordIds:
    """One for all tasks that a Python worker runs."""
    cache = worker_cache()
    if cache.get("tokenizer") != tokenizer_file:
        cache["word_ids"], cache["tokenizer"] = WordIds(tokenizer_file), tokenizer_file
    return cache["word_ids"]


def pieces(
    docs: DataFrame, tokenizer_file: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """A row a piece: key, ``piece``, ``start``, ``length``, ``ids_crc32``, and where it stands among the task's pieces of
    its length (``task``, ``nth``).

    A document is its token ids and ``end_id``; null and empty texts are ``end_id`` alone. Only documents above
    ``capacity`` are cut, into full pieces and a rest. Keys may be null or repeat; every row is a document of its own.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        words_of = _word_ids(tokenizer_file)
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            rows = []
            for low, high in portions(texts, PART_BYTES):
                found, ends = words_of.of(texts[low:high])
                for i, (first, last) in enumerate(zip(ends.tolist(), ends[1:].tolist()), low):
                    ids = found[first:last].tobytes() + end
                    n = len(ids) // 4
                    for k, at in enumerate(range(0, n, capacity)):
                        part = ids[4 * at : 4 * min(n, at + capacity)]
                        length = len(part) // 4
                        rows.append((i, k, at, length, zlib.crc32(part), seen[length]))
                        seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            own = keys.take(pa.array(columns[0], pa.int64()))
            types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            arrays = [own, *(pa.array(c, t) for c, t in zip(columns[1:], types)), pa.array([task] * len(rows), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "piece", "start", "length", "ids_crc32", "nth", "task"])

    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias(TEXT))
    return source.mapInArrow(run, f"key {kind}, piece int, start bigint, length int, ids_crc32 bigint, nth bigint, task int")


class Plan:
    """Rows (length, first rank, end rank, first sequence, offset): pieces of that length and those ranks stand at the
    offset of consecutive sequences."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = 512, small: int | None = None):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self._next: dict[int, int] = defaultdict(int)
        self._open: dict[int, list[tuple[int, int]]] = {}
        self._gaps: list[int] = []
        small = capacity // 8 if small is None else small
        self._pack_large({s: c for s, c in counts.items() if s > small and c}, groups)
        self._pack_small({s: c for s, c in counts.items() if s <= small and c})

    # --- large: groups, patterns, real lengths -----------------------------------------------------

    def _pack_large(self, counts, groups):
        lengths = sorted(counts, reverse=True)
        total = sum(counts.values())
        if not total:
            return
        # The pieces in order of length as runs (length, count), cut where a group ends.
        cuts = sorted({total * g // groups for g in range(1, groups + 1)} - {0})
        members, at, g = [[]], 0, 0
        for length in lengths:
            left = counts[length]
            while left:
                n = min(left, cuts[g] - at)
                members[-1].append([length, n])
                at, left = at + n, left - n
                if at == cuts[g] and at < total:
                    members.append([])
                    g += 1
        # Groups whose largest pieces are alike are one size.
        by_size = defaultdict(list)
        for group in members:
            by_size[group[0][0]] += group
        sizes = sorted(by_size, reverse=True)
        left = {s: sum(n for _, n in by_size[s]) for s in sizes}
        while left:
            pattern = self._pattern(left)
            times = min(left[s] // k for s, k in pattern.items())
            self._place(pattern, times, by_size)
            for s, k in pattern.items():
                left[s] -= k * times
                if not left[s]:
                    del left[s]

    def _pattern(self, left):
        """The largest size that is left, and with it the sizes that fill the sequence best."""
        largest = max(left)
        room = self.capacity - largest
        own = dict(left)
        own[largest] -= 1
        bits = 1  # bit f: fill f can be reached
        mask = (1 << (room + 1)) - 1
        steps = []
        for size in sorted((s for s in own if own[s] and s <= room), reverse=True):
            before = bits
            for _ in range(min(own[size], room // size)):
                bits |= bits << size & mask
            steps.append((size, before))
            if bits >> room & 1:
                break
        fill = bits.bit_length() - 1
        pattern = defaultdict(int, {largest: 1})
        for size, before in reversed(steps):
            while fill and not before >> fill & 1:
                pattern[size] += 1
                fill -= size
        return dict(pattern)

    def _place(self, pattern, times, by_size):
        """``times`` sequences of one pattern; runs of sequences whose real lengths are alike share their rows."""
        slots = [s for s, k in sorted(pattern.items(), reverse=True) for _ in range(k)]
        taken = [self._take(by_size[s], times) for s in slots]
        done = 0
        while done < times:
            run = min(t[0][1] for t in taken)
            offset = 0
            for t in taken:
                length = t[0][0]
                self._row(length, run, self.sequences, offset)
                offset += length
                t[0][1] -= run
                if not t[0][1]:
                    t.pop(0)
            self._gap(self.capacity - offset, self.sequences, run)
            self.sequences += run
            done += run

    @staticmethod
    def _take(runs, n):
        """The first ``n`` pieces of the runs (length, count)."""
        out = []
        while n:
            length, have = runs[0]
            k = min(n, have)
            out.append([length, k])
            n -= k
            if k == have:
                runs.pop(0)
            else:
                runs[0][1] -= k
        return out

    def _row(self, length, n, sequence, offset):
        first = self._next[length]
        self._next[length] = first + n
        self.rows.append((length, first, first + n, sequence, offset))

    # --- small: the tightest gap ---------------------------------------------------------------------

    def _gap(self, gap, sequence, n):
        if not gap or not n:
            return
        if gap not in self._open:
            self._open[gap] = []
            insort(self._gaps, gap)
        heapq.heappush(self._open[gap], (sequence, n))

    def _pack_small(self, counts):
        for length in sorted(counts, reverse=True):
            left = counts[length]
            while left:
                at = bisect_left(self._gaps, length)
                if at == len(self._gaps):
                    each = self.capacity // length
                    n = -(-left // each)
                    self._gap(self.capacity, self.sequences, n)
                    self.sequences += n
                    continue
                gap = self._gaps[at]
                sequence, have = heapq.heappop(self._open[gap])
                if not self._open[gap]:
                    del self._open[gap]
                    self._gaps.pop(at)
                n = min(left, have)
                self._row(length, n, sequence, self.capacity - gap)
                left -= n
                self._gap(gap - length, sequence, n)
                self._gap(gap, sequence + n, have - n)


def pack(docs: DataFrame, tokenizer_file: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, groups: int = 512) -> DataFrame:
    """Key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece of every document.

    See :func:`pieces` for nulls, empty and long texts and repeated rows. An empty table gives no rows. The tokenizer file must
    be there on every executor, as its library must.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cut = settled(pieces(docs, tokenizer_file, key=key, text=text, capacity=capacity, end_id=end_id), "pieces")
    # The rank of a piece among all of its length: pieces of earlier tasks, then its place in its own task.
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    per_task = settled(per_task.withColumn("before", before), "piece-counts")
    counts = per_task.groupBy("length").agg(F.sum("n").alias("n"))
    plan = Plan({r["length"]: r["n"] for r in counts.collect()}, capacity, groups)
    by_length = defaultdict(list)
    for row in plan.rows:
        by_length[row[0]].append(row[1:])
    shared = spark.sparkContext.broadcast({n: np.array(rows, dtype=np.int64) for n, rows in by_length.items()})
    ranked = cut.join(per_task.select("length", "task", "before"), ["length", "task"]).select(
        "key", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def place(batches):
        table = shared.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                rows = table[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                sequence[mine] = row[:, 2] + rank[mine] - row[:, 0]
                offset[mine] = row[:, 3]
            arrays = [batch.column(i) for i in range(3)] + [pa.array(length.astype(np.int64)), batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(offset)],
                names=["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema[key].dataType.simpleString()
    placed = ranked.mapInArrow(
        place, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    return placed.withColumnRenamed("key", key)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir):
    from snapvault.llm.common import read

    return pack(read(spark, sf_dir, "documents"), tokenizer_path())
