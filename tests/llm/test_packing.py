import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, SF, awkward_rows, table

from snapvault.llm import packing


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def check(rows, got, capacity=4096):
    """Every piece of every row once, with its own ids; sequences without gaps or overlap. Returns their number."""
    encode = tokenizer().encode
    want = Counter()
    for doc, text in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[(doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r[5]].append((r[6], r[3]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_all_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    got = packing.query(spark, SF).collect()
    n = check(rows, got)
    bound = -(-sum(r.length for r in got) // 4096)
    assert n <= bound * 1.03 + 1


def test_awkward_texts(spark):
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "piece").withColumnRenamed("lang", "rank")
    check([r[:2] for r in rows], packing.pack(docs, packing.tokenizer_path()).collect())
    check([r[:2] for r in rows], packing.pack(docs, packing.tokenizer_path(), capacity=16).collect(), 16)
    assert packing.pack(docs.limit(0), packing.tokenizer_path()).collect() == []


@pytest.mark.parametrize("kind", ["uniform", "alike", "large", "small", "mixed"])
def test_plan_places_every_rank_once(kind):
    rng = np.random.default_rng(2)
    lengths = {
        "uniform": rng.integers(1, 1001, 5000), "alike": np.full(5000, 334), "large": rng.integers(501, 1001, 3000),
        "small": rng.integers(1, 100, 5000), "mixed": np.clip(rng.lognormal(5, 1, 20000).astype(int), 1, 1000),
    }[kind]
    counts = Counter(lengths.tolist())
    plan = packing.Plan(counts, capacity=1000, groups=512)
    ranks, filled = defaultdict(list), defaultdict(list)
    for length, first, end, sequence, offset in plan.rows:
        ranks[length].append((first, end))
        for k in range(end - first):
            filled[sequence + k].append((offset, length))
    for length, n in counts.items():
        at = 0
        for first, end in sorted(ranks[length]):
            assert first == at
            at = end
        assert at == n
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1000
    order = sorted(lengths.tolist(), reverse=True)
    assert len(filled) <= 1.02 * max(-(-sum(order) // 1000), sum(x > 500 for x in order), sum(x == 334 for x in order) / 2) + 2
    more = packing.Plan({k: v * 1000 for k, v in counts.items()}, capacity=1000, groups=512)
    assert len(more.rows) < 50 * (len(plan.rows) + 1000)


def test_ids_of_words_are_those_of_the_whole_text():
    texts = [
        "It's DON'T we'll I'd 'tis '' a.b,c; x!!! ...y z%$# |pipe* Élan ÀÖØ ß µ ª ÿ Ÿ İstanbul ſ ﬁ café é. naïve, ÷× a÷b",
        "日本語。 русский, слово! ١٢٣ 12ab a1b2 ½ ² x² ⅷ nb sp \x1c\x1d \x85   <|endoftext|> <|startoftext|>x ­ soft­hyphen",
        "\tA\r\nb\x0bC\x0cd", "ὈΔΥΣΣΕΎΣ Σ σς ŠČ Ǆ", "🙂🙂. a🙂b 👩‍👩‍👧", "a" * 3000, ".,;:!?#$%&*|", "word.,;: word", "x́ ́y",
    ]
    plain, words = tokenizer(), packing.WordIds(packing.tokenizer_path())
    split = [t.encode().split() for t in texts]
    words.learn(split)
    for text, own in zip(texts, split):
        assert np.frombuffer(words.ids(own), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_words_seen_half_a_million_words_ago_are_not_tokenized_again():
    words = packing.WordIds(packing.tokenizer_path())
    asked, encode = [], words._encode
    words._encode = lambda texts: asked.append(sum(t.count(" ") + 1 for t in texts)) or encode(texts)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = [(a + b + c + d).encode() for a in letters for b in letters for c in letters for d in letters]  # 456,976
    for at in range(0, len(made), 50_000):
        words.learn([made[at : at + 50_000]])
    before = sum(asked)
    words.learn([made[:50_000]])
    assert before == len(made) and sum(asked) == before
    one = packing.WordIds(packing.tokenizer_path())
    one.learn([[b"abcd", b"zzzz,"]])
    words.learn([[b"zzzz,"]])
    assert words.ids([b"abcd", b"zzzz,"]) == one.ids([b"abcd", b"zzzz,"])


def test_remembered_words_are_bounded_and_words_in_use_stay(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 1000)
    words = packing.WordIds(packing.tokenizer_path())
    asked, encode = [], words._encode
    words._encode = lambda texts: asked.extend(w for t in texts for w in t.split()) or encode(texts)
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = [a + b + c for a in letters for b in letters for c in letters]
    for at in range(0, 10_000, 400):
        words.learn([[w.encode() for word in made[at : at + 400] for w in (word, word.title() + ",")], [b"Inuse."]])
        remembered = [d for d in vars(words).values() if isinstance(d, dict)]
        assert sum(map(len, remembered)) <= 1000
    assert asked.count("inuse") == 1 and len(asked) == 10_000 + 3  # each run once, and "." and ","


def test_ids_of_a_column_are_those_of_each_text():
    texts = [None, "", "One, two.\x0bthree\n", " \t", "two. Élan\x1cx  two", "a퟿ b", "ÉLAN élan Élan!"]
    plain, words = tokenizer(), packing.WordIds(packing.tokenizer_path())
    column = pa.array([b"before", *[t if t is None else t.encode() for t in texts], b"behind"], pa.binary())
    for part in (column.slice(1, len(texts)), column.slice(1, 2), column.slice(0, 0)):
        ids, ends = words.of(part)
        assert len(ends) == len(part) + 1 and ends[-1] == len(ids)
        for text, a, b in zip(texts, ends, ends[1:]):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text
