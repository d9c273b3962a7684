import zlib

from helpers import SCHEMA, awkward_rows, table

from snapvault.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in table("documents", SF)}
    got = langid.query(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    right = sum(rows[r.doc_id]["lang"] == r.lang_pred for r in held)
    assert len(held) > 200 and right / len(held) >= 0.97


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(langid.training_rows(F.col("doc_id")), F.col("lang")).otherwise("xx")).withColumn("source", F.lit("z"))
    a, b = langid.train(docs, sample=300), langid.train(other, sample=300)
    assert a.languages == b.languages and (a.weights == b.weights).all()


def test_awkward_texts(spark):
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "score")
    model = langid.train(docs)
    got = langid.identify(docs, model, keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    none = langid.train(docs.limit(0))
    assert none is None
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).collect() == []
    one = langid.train(docs.filter("doc_id = 4"))
    assert one is None or {r.lang_pred for r in langid.identify(docs, one).collect()} == {"en", "und"}
