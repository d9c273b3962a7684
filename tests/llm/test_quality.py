from collections import Counter

import numpy as np
from helpers import SCHEMA, SF, awkward_rows, spaced_words, table
from pyspark.sql import functions as F

from snapvault.llm import quality


def brute(text):
    text = text or ""
    words = spaced_words(text)
    lines = text.split("\n")
    dup = sum(bool(spaced_words(line)) and line in lines[:i] for i, line in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def test_all_documents(spark):
    got = {r[0]: r for r in quality.query(spark, SF).collect()}
    rows = table("documents")
    assert len(got) == len(rows)
    for r in rows:
        assert tuple(got[r["doc_id"]][1:7]) == brute(r["text"])
        assert not (got[r["doc_id"]].base_failed and got[r["doc_id"]].kept)


def test_awkward_texts(spark):
    rows = awkward_rows() + [(50, "a a a a a a", None, None, None), (51, "l\nl\n l\n\n\nl\nm", None, None, None), (52, "x y z w x y z", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "n_words")
    found = quality.text_statistics(docs, keep=["doc_id", "text"])
    for r in found.collect():
        assert tuple(r[quality.COUNTS[k]] for k in range(5)) == brute(r.text)[:5]
    assert quality.text_statistics(docs.limit(0)).collect() == []


def test_more_distinct_words_than_a_task_numbers():
    ids = np.array([quality.VOCABULARY + 5, 7, 8, quality.VOCABULARY + 5, 7, 8, 1], dtype=np.int64)
    assert quality.repeated_words(ids) == 6


def test_rules_find_what_labels_tell(spark):
    rng = np.random.default_rng(1)
    values = rng.random((3000, 3))
    bad = (values[:, 0] > 0.8) | ((values[:, 1] < 0.3) & (values[:, 2] > 0.5))
    rules = quality.learn_rules(values, bad, ["a", "b", "c"])
    said = np.zeros(3000, dtype=bool)
    for conditions, _ in rules:
        said |= quality._covers(values, [("abc".index(n), op, t) for n, op, t in conditions])
    assert (said == bad).mean() > 0.97
    assert quality.learn_rules(values, np.zeros(3000, dtype=bool), list("abc")) == []
    assert quality.learn_rules(values[:0], bad[:0], list("abc")) == []


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = quality.text_statistics(docs, keep=["doc_id"]).cache()
    rules = quality.fit_rules(found, labels.filter("doc_id % 2 = 0"))
    kept = (~quality.base_failed() & quality.rules_expression(rules)).alias("kept")
    told = found.select("doc_id", kept).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = told.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")), F.count("*")).head()
    assert right[0] > 0.85, right
    clean = told.filter("quality = 1").agg(F.avg(F.col("kept").cast("double"))).head()[0]
    assert clean > 0.9, clean


def test_labels_with_nulls_ties_and_repeats(spark):
    docs = spark.createDataFrame([(i, "good words in a row " * 5 if i % 2 else "## $$ " * 30) for i in range(40)], "doc_id long, text string")
    found = quality.text_statistics(docs, keep=["doc_id"])
    rows = [(i, i % 2) for i in range(40)] * 2 + [(3, None), (None, 0), (99, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    rules = quality.fit_rules(found, labels)
    assert [r[0] for r in found.filter(~quality.rules_expression(rules)).select("doc_id").orderBy("doc_id").collect()] == list(range(0, 40, 2))
    assert quality.fit_rules(found, labels.limit(0)) == []
