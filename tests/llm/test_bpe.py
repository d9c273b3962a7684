"""The transducer against the library whose files it reads, plain merging, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import SCHEMA, SF, awkward_rows, table

from snapvault.llm import bpe

RANKS = bpe.read_ranks(bpe.ranks_path())
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def expected(doc_id, text):
    own = PLAIN.encode_ordinary(text or "")
    digest = hashlib.sha256(np.array(own, dtype="<u4").tobytes()).hexdigest()
    return doc_id, len(own), digest, hashlib.sha256((text or "").encode()).hexdigest()


def test_query_is_the_library_on_all_documents(spark):
    rows = {tuple(r) for r in bpe.query(spark, SF).collect()}
    assert rows == {expected(d["doc_id"], d["text"]) for d in table("documents")}


def test_awkward_texts_and_clashing_columns(spark):
    docs = spark.createDataFrame(awkward_rows(), SCHEMA).toDF("doc_id", "text", "ids", "decoded", "n_tokens")
    back = bpe.decode(bpe.encode(docs, bpe.ranks_path(), public_tokenizers.PATTERN), bpe.ranks_path())
    found = sorted(((r["doc_id"], ids(r["ids"]), bytes(r["decoded"]).decode()) for r in back.collect()), key=repr)
    want = [(r[0], PLAIN.encode_ordinary(r[1] or ""), r[1] or "") for r in awkward_rows()]
    assert found == sorted(want, key=repr)
    assert bpe.encode(docs.limit(0), bpe.ranks_path(), public_tokenizers.PATTERN).collect() == []


def test_a_key_named_like_a_result_raises(spark):
    docs = spark.createDataFrame([(1, "a")], "ids int, text string")
    with pytest.raises(ValueError):
        bpe.encode(docs, bpe.ranks_path(), public_tokenizers.PATTERN, key="ids")


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(encoder, seed):
    draw = random.Random(seed)
    letters = [
        "abcdeot hins", "aAeEtT", "a x=-_0\n\t", [" ", "  ", "the", "ing", "'s", "'ll", "\x1c", "\u0085", "é", "日本", "🙂", "12"],
        [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000],
    ]
    for n in range(800):
        text = "".join(draw.choices(letters[n % len(letters)], k=draw.randint(1, 40)))
        assert ids(encoder.encode(text)) == PLAIN.encode_ordinary(text), text


def test_every_character_is_split_as_the_library_does():
    """A vocabulary in which a probe merges with the byte before it tells the class of any character."""
    ranks = {bytes([i]): i for i in range(256)}
    for probe in b"a1!":
        for last in range(256):
            ranks[bytes([last, probe])] = len(ranks)
    plain = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.TextEncoder(ranks, public_tokenizers.PATTERN)
    codes = [i for i in [*range(0x20000), *range(0x20000, 0x110000, 13)] if not 0xD800 <= i < 0xE000]
    for at in range(0, len(codes), 500):
        text = "".join(f"{chr(c)}a{chr(c)}1{chr(c)}!" for c in codes[at : at + 500])
        assert ids(own.encode(text)) == plain.encode_ordinary(text)


def test_neighbours_by_plain_merging():
    draw, tokens, known = random.Random(1), list(RANKS), bpe.Neighbours(RANKS)
    short = [t for t in tokens if len(t) <= 3]
    for n in range(8000):
        one, two = draw.sample(short if n % 2 else tokens, 2)
        assert known.stay(one, two) == (bpe.merged_pieces(one + two, RANKS) == [one, two])


def test_a_small_vocabulary_with_ties_and_tokens_that_do_not_merge():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258, b"bb": 259, b"abab": 300, b"xyz": 301}
    own, plain = bpe.Transducer(ranks), tiktoken.Encoding("p", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choices("aaabbxyz", k=draw.randint(1, 14)))
        assert ids(own.encode(text.encode())) == plain.encode_ordinary(text), text


def test_tokens_are_told_after_bounded_lookahead():
    own, longest = bpe.Transducer(RANKS), max(map(len, RANKS))
    data = ("incomprehensibilities" * 40 + "-" * 700).encode()
    told = 0
    for read, part in _told_while_reading(own, data):
        told += sum(len(t) for t in (_token(i) for i in ids(part)))
        assert read - told <= 2 * longest
    assert told == len(data)


def _told_while_reading(own, data):
    read = 0

    def counted():
        nonlocal read
        for byte in data:
            read += 1
            yield byte

    for part in own.stream(counted()):
        yield read, part


TOKENS = {rank: token for token, rank in RANKS.items()}


def _token(i):
    return TOKENS[i]


def test_forgetting_moves_changes_nothing():
    few, many = bpe.Transducer(RANKS, moves=50), bpe.Transducer(RANKS)
    for row in table("documents")[:20]:
        for word in (row["text"] or "").encode().split()[:200]:
            assert few.encode(word) == many.encode(word)


def test_one_long_match_takes_time_in_proportion():
    draw = random.Random(7)
    text = "".join(draw.choices("abcdefghij", k=100_000))
    assert ids(bpe.TextEncoder(RANKS, public_tokenizers.PATTERN).encode(text)) == PLAIN.encode_ordinary(text)


def test_decoding_tells_whole_characters_only():
    text = "aé日本🙂\u0000z"
    single = [RANKS[bytes([b])] for b in text.encode()]
    decoder, out = bpe.StreamDecoder(TOKENS), []
    for i in single:
        out.append(decoder.push([i]).decode())
    assert "".join(out) == text and decoder.finish() == b""
    decoder.push([RANKS[b"\xe6"]])
    assert decoder.finish() == b"\xe6" and decoder.finish() == b""


def test_decoding_passes_broken_bytes_on():
    draw, decoder = random.Random(5), bpe.StreamDecoder(TOKENS)
    for _ in range(2000):
        data = bytes(draw.choices([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xE6, 0xED, 0xF0, 0xF4, 0xFF, 0x9F, 0x90], k=draw.randint(1, 12)))
        parts = [decoder.push([RANKS[bytes([b])]]) for b in data]
        last = decoder.finish()
        assert b"".join(parts) + last == data
        # What waits at the end is a character that could still become whole, and no more.
        assert len(last) <= 3 and (not last or (last + b"\x80" * 3).decode("utf-8", "ignore") or last[0] >= 0xC2)


def test_vocabulary_without_all_bytes_raises():
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0})
