import hashlib

from helpers import SCHEMA, SF, awkward_rows, plain_words, table
from pyspark.sql import functions as F

from snapvault.llm import decontam


def brute(docs, items, window=13):
    wanted = {}
    for item, text in items:
        words = plain_words(text)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            wanted.setdefault(tuple(words[at : at + window]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in wanted}:
            for at in range(len(words) - n + 1):
                owners = wanted.get(tuple(words[at : at + n]))
                if owners:
                    hit.update(range(at, at + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def told(df):
    items = F.col("items")
    return rows_of(df.select("doc_id", "n_words", "n_hit", F.size(items), F.sha2(F.array_join(items, ","), 256), "contaminated"))


def test_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    items = [(r["item_id"], r["text"]) for r in table("benchmark")]
    want = brute(docs, items)
    assert rows_of(decontam.query(spark, SF)) == want
    assert any(r[5] for r in want) and any(r[2] and not r[5] for r in want) or any(r[5] for r in want)


def test_awkward_texts(spark):
    long_item = " ".join(f"w{i}" for i in range(30))
    items = [(1, None), (2, ""), (3, "..."), (4, "the"), (5, "same text"), (6, long_item), (6, "other words of item six"), (7, long_item), (8, "lorem ipsum dolor"), (None, "x")]
    texts = [
        long_item, "a " + " ".join(long_item.split()[3:17]) + " b", " ".join(long_item.split()[:12]), "x same. TEXT y same text", long_item + " " + long_item,
        "a a a a a a " * 40 + "the", "the " * 5, "é same text é",
    ]
    rows = awkward_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "items").withColumnRenamed("lang", "n_hit")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = told(decontam.decontaminate(docs, bench, keep=["doc_id"]))
    assert got == brute([r[:2] for r in rows], [i for i in items if i[0] is not None])
    clean = decontam.decontaminate(docs, bench.limit(0))
    assert clean.filter("contaminated or n_hit > 0").count() == 0 and clean.count() == len(rows)
    assert decontam.decontaminate(docs.limit(0), bench).collect() == []


def test_repeating_words_and_windows(spark):
    item = " ".join(["a", "b"] * 10)
    docs = [(1, " ".join(["a", "b"] * 30)), (2, " ".join(["b", "a"] * 6)), (3, "a b " * 6 + "a"), (4, "b " + "a b " * 6 + "c " * 500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert told(decontam.decontaminate(frame, bench, keep=["doc_id"])) == brute(docs, [(1, item)])


def test_a_benchmark_in_parts(spark):
    """Hits of one document spread over parts, an item longer than a part, and windows that lie across its pieces."""
    many = [(k, " ".join(f"i{k}w{j}" for j in range(14))) for k in range(12)]
    long_item = " ".join(f"l{j}" for j in range(150))
    items = [*many, (50, long_item), (51, "same text"), (51, "TEXT y"), (52, None), (53, "")]
    spread = " ".join(many[k][1] for k in (0, 11))
    texts = [
        spread + " n" * (20 * 28 - 28), spread + " n" * (20 * 28 - 27), " ".join(t for _, t in many), long_item, " ".join(long_item.split()[25:60]),
        "x same text y", " ".join(long_item.split()[:12]), "same text same text y " + many[3][1],
    ]
    rows = awkward_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(texts)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute([r[:2] for r in rows], items)
    assert [r[5] for r in want if r[0] in (100, 101)] == [True, False]
    whole = decontam.decontaminate(docs, bench)
    parts = decontam.decontaminate(docs, bench, part_words=40)
    assert len(list(decontam.read_items(bench, part=40))) > 3
    assert told(parts) == told(whole) == want
    assert parts.dtypes == whole.dtypes and rows_of(parts) == rows_of(whole)
    named = docs.select("doc_id", F.col("text").alias("items"), F.lit(1).alias("n_hit"))
    assert told(decontam.decontaminate(named, bench, text="items", keep=["doc_id"], part_words=40)) == want


def test_items_with_a_null_id_count(spark, tmp_path):
    passage = " ".join(f"p{j}" for j in range(20))
    items = [(1, "same text"), (None, passage), (None, "same text"), (None, "x"), (None, None), (None, "...")]
    rows = awkward_rows() + [(100 + i, t, None, None, None) for i, t in enumerate([passage, "a " + passage + " b", "same text here", "x", passage + " n" * 500])]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    named = brute([r[:2] for r in rows], [(i or "null", t) for i, t in items])
    for words in (decontam.PART_WORDS, 30):
        got = decontam.decontaminate(docs, bench, null_items=True, part_words=words)
        assert [r[:3] + r[5:] for r in told(got)] == [r[:3] + r[5:] for r in named]
        assert {i for r in got.select("items").collect() for i in r[0]} == {"1"}
        assert [r[0] for r in got.filter("doc_id = 100").select("items").collect()] == [[]]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    dirty = {r[0] for r in named if r[5]}
    assert 100 in dirty and {r.doc_id for r in decontam.query(spark, str(tmp_path)).filter("contaminated").collect()} == dirty
    import corpus_pipeline

    kept = {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()}
    assert 100 not in kept and 104 in kept
