"""Byte-level BPE as a transducer: bytes in, tokens out after bounded lookahead; and back, whole characters at a time.

Greedy merging of a byte string gives the one sequence of tokens in which every two neighbours, merged on their own, stay the
two (merges inside a segment that no merge leaves run as they would alone). So an encoder can read byte by byte: at each
place exactly one sequence of tokens ends there, and what may still grow is a token begun at an earlier place. A state holds
the bytes behind the last token told, the token that ends at each of them, and where one that is not complete may begin. Moves
are found when first needed and kept (a lazily determinised transducer); tokens on which all hypotheses agree are told at once, so
none waits longer than the longest token. The merge ranks are only looked at when a new move is compiled.

The decoder composes a UTF-8 state machine with the tokens: its state is the unfinished character, and for a state and a token
it keeps the state behind it and the bytes that are whole characters by then.
"""

from __future__ import annotations

import base64
import gc
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import TEXT, read, slices, small_batches, worker_cache

MOVES = 300_000  # compiled moves that are kept; beyond, compiling starts anew
MEMO = 120_000  # pieces of text whose ids are kept, of at most so many characters:
MEMO_LENGTH = 40
PIECES = 50_000  # of a long text that stand in memory at a time

# White space, and the letters and numbers that Unicode 16 added to 15.1, the version of Python 3.13.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NEW = {
    "L": "\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85"
    "\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3"
    "\U00011bc0-\U00011be0\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff"
    "\U0001e5d0-\U0001e5ed\U0001e5f0",
    "N": "\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79"
    "\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa",
}
_LATIN_END = 0x250
_BEYOND_LATIN = re.compile("[^\0-\u024f]")


def _category(letter: str, end: int) -> str:
    """Characters below ``end`` of a general category, as ranges for a character class."""
    out, first = [], None
    for code in range(end + 1):
        inside = code < end and unicodedata.category(chr(code))[0] == letter
        if inside and first is None:
            first = code
        elif not inside and first is not None:
            out.append(f"{chr(first)}-{chr(code - 1)}")
            first = None
    return "".join(out) + (_NEW[letter] if end > _LATIN_END else "")


def splitter(pattern: str, end: int = sys.maxunicode + 1) -> re.Pattern:
    """The pattern with its classes of letters, numbers and white space spelled out as of Unicode 16, for texts of characters
    below ``end``. Regular expression libraries differ in the version they follow, and Python's own has no such classes."""
    classes = {r"\s": _SPACE, r"\p{L}": _category("L", end), r"\p{N}": _category("N", end)}
    out, inside = [], False
    for part in re.split(r"(\\.(?:\{[^}]*\})?|\[\^?|\])", pattern):
        if part in classes:
            part = classes[part] if inside else f"[{classes[part]}]"
        elif part == r"\S" and not inside:
            part = f"[^{_SPACE}]"
        elif part[:2] in (r"\p", r"\P", r"\S", r"\w", r"\W", r"\d", r"\D", r"\b", r"\B"):
            raise ValueError(f"{part} in a pattern is not supported")
        elif part[:1] in ("[", "]"):
            inside = part != "]"
        out.append(part)
    return re.compile("".join(out))


def read_ranks(path: str) -> dict[bytes, int]:
    """A file with a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges(data: bytes, ranks: dict[bytes, int]) -> Iterator[tuple[int, int, list[bytes]]]:
    """Merging by rank, the leftmost of equals first, until nothing merges: each rank, its place and the parts after it."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        pairs = [(ranks[both], i) for i, both in enumerate(map(bytes.__add__, parts, parts[1:])) if both in ranks]
        if not pairs:
            return
        rank, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        yield rank, i, parts


def merged_pieces(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [data[i : i + 1] for i in range(len(data))]
    for _, _, parts in merges(data, ranks):
        pass
    return parts


class Neighbours:
    """Tells whether two tokens, side by side, merge into just these two. Compiled from how each token merges on its own.

    Only a merge across the border can part them. It would take the last part of the first token and the first part of the second, at a
    time when both are there. A part is there from the rank that made it to the rank that takes it up; the border wins if its rank comes
    before both ends. Of equal ranks the left one merges first.
    """

    def __init__(self, ranks: dict[bytes, int], limit: int = 250_000):
        self._ranks, self._limit = ranks, limit
        self._edges: dict[bytes, tuple[list, list] | None] = {}
        self.known: dict[int, bool] = {}  # by both ranks in one number; with nothing before a token, by its rank alone

    def edges(self, token: bytes) -> tuple[list, list] | None:
        """First parts and last parts of a token over time, each with the ranks that made it and took it up; none if the
        token does not merge to itself, or not in the order of ranks."""
        if token not in self._edges:
            if len(self._edges) > self._limit // 8:
                self._edges.clear()
            first, last, before, rising = [(token[:1], -1)], [(token[-1:], -1)], -1, True
            parts = [token] if len(token) == 1 else []
            for rank, _, parts in merges(token, self._ranks):
                rising, before = rising and rank >= before, rank
                if parts[0] != first[-1][0]:
                    first.append((parts[0], rank))
                if parts[-1] != last[-1][0]:
                    last.append((parts[-1], rank))
            end = (b"", float("inf"))
            sides = tuple([(part, born, after[1]) for (part, born), after in zip(side, [*side[1:], end])] for side in (first, last))
            self._edges[token] = sides if rising and parts == [token] else None
        return self._edges[token]

    def key(self, one: bytes, rank: int) -> int:
        return (self._ranks[one] + 1 << 32) + rank if one else rank

    def stay(self, one: bytes, two: bytes) -> bool:
        """Whether the two stay apart; with nothing before it, whether the second is a token that merges to itself."""
        key = self.key(one, self._ranks[two])
        found = self.known.get(key)
        if found is None:
            if len(self.known) > self._limit:
                self.known.clear()
            found = self.known[key] = self._stay(one, two)
        return found

    def _stay(self, one: bytes, two: bytes) -> bool:
        if not one:
            return merged_pieces(two, self._ranks) == [two]
        left, right, ranks = self.edges(one), self.edges(two), self._ranks
        if left is None or right is None:
            return merged_pieces(one + two, ranks) == [one, two]
        for x, x_born, x_gone in left[1]:
            for y, y_born, y_gone in right[0]:
                rank = ranks.get(x + y)
                if rank is not None and rank < x_gone and rank <= y_gone and x_born <= y_gone and y_born < x_gone:
                    return False
        return True


class _State:
    __slots__ = ("base", "before", "pending", "lengths", "live", "rest")

    def __init__(self, number: int, before: bytes, pending: bytes, lengths: list[int], live: list[int]):
        self.base = number << 8  # of the keys of its moves
        self.before = before  # the last token told, if one that begins behind it may still grow
        self.pending = pending  # bytes behind it
        self.lengths = _compact(lengths)  # of the token that ends behind each of these bytes
        self.live = _compact(live)  # places in them where a token may have begun that is not complete
        self.rest: bytes | None = None  # ids still to tell if the input ends here, once asked for


def _compact(numbers: list[int]) -> bytes | tuple:
    """The same numbers, as bytes if they are small enough: hundreds of thousands of states are kept."""
    try:
        return bytes(numbers)
    except ValueError:
        return tuple(numbers)


class Transducer:
    """Encodes byte strings, each on its own, to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], moves: int = MOVES):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} bytes are no tokens")
        self._ranks, self._limit = ranks, moves
        self._ids = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self._neighbours = Neighbours(ranks)
        self._growing = {token[:k] for token in ranks for k in range(1, len(token))}
        self._bytes = [bytes([i]) for i in range(256)]
        self._forget()

    def _forget(self) -> None:
        self.start = _State(0, b"", b"", [], [0])
        self._states = {(b"", b""): self.start}
        self._moves: dict[int, tuple[_State, bytes]] = {}

    def _move(self, state: _State, byte: int) -> tuple[_State, bytes]:
        pending, lengths = state.pending + self._bytes[byte], state.lengths
        growing, ranks, stay = self._growing, self._ranks, self._neighbours.stay
        live, length, end = [], 0, len(pending)
        for at in state.live:
            part = pending[at:] if at else pending
            if part in growing:
                live.append(at)
            # Merging gives one sequence only, so one token ends here.
            if not length and part in ranks and stay(pending[at - lengths[at - 1] : at] if at else state.before, part):
                length = end - at
        lengths = [*lengths, length]
        live.append(end)
        told, ids, before = live[0], b"", state.before
        if told:  # the last border that all hypotheses share
            for at in live:
                while at != told:
                    if at > told:
                        at -= lengths[at - 1]
                    else:
                        told -= lengths[told - 1]
            if told:
                ids = self._chain(pending, lengths, told)
                before = pending[told - lengths[told - 1] : told]
                pending, lengths, live = pending[told:], lengths[told:], [at - told for at in live]
            if live[0]:
                before = b""  # no token that is not complete begins behind it
        place = (before, pending)
        following = self._states.get(place)
        if following is None:
            following = self._states[place] = _State(len(self._states), before, pending, lengths, live)
        move = self._moves[state.base + byte] = (following, ids)
        return move

    def _chain(self, pending: bytes, lengths, end: int) -> bytes:
        """Ids of the tokens up to a border."""
        at = end - lengths[end - 1] if end else 0
        if not at:
            return self._ids[pending[:end]] if end else b""
        return self._chain(pending, lengths, at) + self._ids[pending[at:end]]

    def encode(self, data: bytes) -> bytes:
        """Ids of one byte string. A string that is a token is that token, whatever merging would make of it."""
        if not data:
            return b""
        whole = self._ranks.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        if len(self._moves) > self._limit:
            self._forget()
        return b"".join(self.stream(data))

    def stream(self, data: Iterable[int]) -> Iterator[bytes]:
        """Ids as soon as no later byte can change them."""
        state, known = self.start, self._moves.get
        for byte in data:
            state, told = known(state.base + byte) or self._move(state, byte)
            if told:
                yield told
        if state.rest is None:
            state.rest = self._chain(state.pending, state.lengths, len(state.pending))
        yield state.rest


class TextEncoder:
    """Encodes texts: every match of the pattern on its own. Keeps the ids of short matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._transducer = Transducer(ranks)
        self._latin, self._any = splitter(pattern, _LATIN_END), splitter(pattern)

    def _learn(self, piece: str) -> bytes:
        found = self._known.get(piece) or self._older.get(piece) or self._transducer.encode(piece.encode())
        if len(piece) <= MEMO_LENGTH:
            if len(self._known) > MEMO:  # what was in use lately stays
                self._older, self._known = self._known, {}
            self._known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        pattern = self._any if _BEYOND_LATIN.search(text) else self._latin
        if len(text) <= 4 * PIECES:
            return self._joined(pattern.findall(text))
        matches, parts = (m.group() for m in pattern.finditer(text)), []
        while some := list(islice(matches, PIECES)):
            parts.append(self._joined(some))
        return b"".join(parts)

    def _joined(self, pieces: list[str]) -> bytes:
        found = list(map(self._known.get, pieces))
        if None in found:
            found = [f if f is not None else self._learn(p) for f, p in zip(found, pieces)]
        return b"".join(found)


# --- back --------------------------------------------------------------------------------------------------

# What may come next within a character, by its first byte: the range of the second byte, and how many bytes follow.
# Fixed values of the UTF-8 format.
_LEADS = (
    (0xC2, 0xDF, 0x80, 0xBF, 1), (0xE0, 0xE0, 0xA0, 0xBF, 2), (0xE1, 0xEC, 0x80, 0xBF, 2), (0xED, 0xED, 0x80, 0x9F, 2),
    (0xEE, 0xEF, 0x80, 0xBF, 2), (0xF0, 0xF0, 0x90, 0xBF, 3), (0xF1, 0xF3, 0x80, 0xBF, 3), (0xF4, 0xF4, 0x80, 0x8F, 3),
)


def utf8_state(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """(least and greatest next byte, bytes to come) after a byte; None where it can be no part of a character here.

    Between characters nothing is to come.
    """
    low, high, left = state
    if left:
        return (0x80, 0xBF, left - 1) if low <= byte <= high else None
    if byte < 0x80:
        return (0, 0, 0)
    return next(((a, b, n) for first, last, a, b, n in _LEADS if first <= byte <= last), None)


class StreamDecoder:
    """Turns ids into bytes, told as soon as a character is whole. Bytes that are no UTF-8 are passed on as they are."""

    def __init__(self, tokens: dict[int, bytes]):
        self._tokens = tokens
        self._after: dict[bytes, dict] = {}
        self.reset()

    def reset(self) -> None:
        self._table = self._of(b"")

    def _of(self, pending: bytes) -> dict:
        if pending not in self._after:
            self._after[pending] = {None: pending}
        return self._after[pending]

    def _step(self, table: dict, token: int) -> tuple[dict, bytes]:
        data, state, whole = table[None] + self._tokens[token], (0, 0, 0), 0
        at = 0
        while at < len(data):
            following = utf8_state(state, data[at])
            if following is None and state[2]:  # a broken character ends before this byte
                whole, state = at, (0, 0, 0)
                continue
            state = following or (0, 0, 0)
            at += 1
            if not state[2]:
                whole = at
        found = table[token] = (self._of(data[whole:]), data[:whole])
        return found

    def push(self, ids: Iterable[int]) -> bytes:
        """All characters that are whole after these ids."""
        table, out = self._table, []
        for token in ids:
            table, told = table.get(token) or self._step(table, token)
            out.append(told)
        self._table = table
        return b"".join(out)

    def finish(self) -> bytes:
        """What is left of an unfinished character; the next ids start anew."""
        left = self._table[None]
        self.reset()
        return left


# --- over tables -------------------------------------------------------------------------------------------


def _kept(name: str, place: tuple, make):
    """One for all tasks of a Python worker."""
    cache = worker_cache()
    if cache.get(f"{name}-of") != place:
        cache[name], cache[f"{name}-of"] = make(), place
    return cache[name]


def encode(docs: DataFrame, ranks_file: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids``, little-endian unsigned 32-bit integers, of every row.

    Null and empty texts have no ids. Every row is encoded on its own; null and repeated keys are kept as they are, other columns are
    not looked at, and an empty table gives no rows. The time for a text grows with its length, also where it is one single match
    of the pattern. Bytes that are no UTF-8 count as U+FFFD. The file must be there on every executor, one token and its rank a line; all
    256 bytes must be tokens. A key called ``ids`` raises.
    """
    if key == "ids":
        raise ValueError("the key has the name of a column of the result: ids")
    kind = docs.schema[key].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches):
        encoder = _kept("bpe-encoder", (ranks_file, pattern), lambda: TextEncoder(read_ranks(ranks_file), pattern))
        gc.disable()  # caches are long-lived and without cycles that matter; looking through them took a third of the time
        for batch in slices(batches, 200):
            found = [encoder.encode(t.decode("utf-8", "replace")) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["key", "ids"])

    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias(TEXT))
    return source.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks_file: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Key, ``ids`` as they came and ``decoded``, the bytes of every row's ids; null ids have none. An id that is no rank fails the job."""
    if key in ("ids", "decoded"):
        raise ValueError(f"the key has the name of a column of the result: {key}")
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        make = lambda: StreamDecoder({rank: token for token, rank in read_ranks(ranks_file).items()})
        decoder = _kept("bpe-decoder", (ranks_file,), make)
        for batch in slices(batches, 200):
            out = []
            for own in batch.column(1).to_pylist():
                decoder.reset()
                numbers = np.frombuffer(own or b"", "<u4")
                parts = [decoder.push(numbers[i : i + PIECES].tolist()) for i in range(0, len(numbers), PIECES)]
                out.append(b"".join([*parts, decoder.finish()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["key", "ids", "decoded"])

    source = encoded.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids"))
    return source.mapInArrow(run, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(spark, sf_dir):
    import public_tokenizers

    ranks = ranks_path()
    back = decode(encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return back.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
