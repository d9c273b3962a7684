import hashlib
import random
from collections import Counter

import pytest
from helpers import SCHEMA, SF, awkward_rows, table
from pyspark.sql import functions as F

from snapvault.llm import substrings


def brute(rows, length=400):
    """Every window of every text counted."""
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(hash(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[hash(t[i : i + length])] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = []
        for i, g in enumerate(gone):
            if g and spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            elif g:
                spans.append([i, i + 1])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in substrings.repeated_spans(df, **options).collect()), key=repr)


def test_all_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    want = brute(rows)
    assert got(spark.read.parquet(f"{SF}/documents.parquet")) == want
    assert any(spans for _, _, spans, _ in want)


def test_awkward_texts(spark):
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "spans").withColumnRenamed("lang", "ref")
    want = brute([r[:2] for r in rows if r[0] not in (9, 10)])
    found = got(docs)
    assert [r for r in found if r[0] not in (9, 10)] == want
    assert {r[0]: r[2] for r in found if r[0] in (9, 10)} == {9: [[0, 50_000]], 10: [[0, len(rows[10][1])]]}
    assert got(docs.limit(0)) == []


def mutated(rng, alphabet):
    """Texts that share passages at all offsets, chains of near copies, repeats in one text, and periodic parts."""
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [word(n) for n in (19, 20, 21, 30, 45, 90)]
    texts = []
    for _ in range(60):
        parts = [word(rng.randrange(12))]
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a, b = sorted(rng.randrange(len(p) + 1) for _ in range(2))
            parts += [p if rng.random() < 0.5 else p[a:b], word(rng.randrange(6))]
        texts.append("".join(parts))
    long = word(300)
    for _ in range(15):
        at = list(long)
        for _ in range(rng.randrange(12)):
            at[rng.randrange(len(at))] = rng.choice(alphabet)
        texts.append("".join(at))
    return [*texts, word(3) * 40, "é" * 70, texts[0], texts[1]]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, seed, small, monkeypatch):
    rng = random.Random(seed)
    if small:
        monkeypatch.setattr(substrings, "BLOCK_ENTRIES", 3)
        monkeypatch.setattr(substrings, "RUN_BYTES", 2000)
        monkeypatch.setattr(substrings, "RANGE_BYTES", 700)
        monkeypatch.setattr(substrings, "SEGMENT", 37)
        monkeypatch.setattr(substrings, "BATCH_BYTES", 500)
    rows = list(enumerate(mutated(rng, "abcdefgh" if seed % 2 else "ab")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(docs, length=20) == brute(rows, 20)


def test_merge_gives_order_and_shared_prefixes():
    rng = random.Random(1)
    for n_runs in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(20))) for _ in range(n_runs)]
        readers = []
        for run in runs:
            entries = [(0 if not i else substrings.shared_prefix(run[i - 1], k), k, 0, 0, 0) for i, k in enumerate(run)]
            readers.append(iter(entries))
        out = list(substrings.merged(readers))
        keys = [e[1] for e in out]
        assert keys == sorted(k for run in runs for k in run)
        assert all(e[0] == substrings.shared_prefix(a, e[1]) for a, e in zip(keys, out[1:]))


def test_query_columns(spark):
    assert substrings.query(spark, SF).columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_long_and_periodic_texts_and_long_strings(spark):
    """Several segments a text, one anchor every other byte, and keys beyond 65,535 bytes."""
    draw = random.Random(2)
    noise = "".join(draw.choices("abcdefghijklmnop", k=400_000))
    rows = [(1, noise), (2, "x" + noise[200_000:330_000])]
    periodic = [(3, "ab" * 20_000), (4, "b" + "ab" * 300)]
    docs = spark.createDataFrame(rows + periodic, "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in substrings.repeated_spans(docs).collect()}
    assert found == {1: [(200_000, 330_000)], 2: [(1, 130_001)], 3: [(0, 40_000)], 4: [(0, 601)]}
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in substrings.repeated_spans(docs.where("doc_id < 3"), length=50_000).collect()}
    assert found == {1: [(200_000, 330_000)], 2: [(1, 130_001)]}
