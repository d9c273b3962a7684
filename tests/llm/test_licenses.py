from helpers import SCHEMA, SF, awkward_rows, plain_words, table

from snapvault.llm import licenses


def brute(text):
    """Phrases by slicing; templates by counting shared words in the blocks cut for each template; short ones by slicing."""
    words = plain_words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    sets = [(label, set(plain_words(t))) for label, t in licenses.TEMPLATES]
    shares = {}
    for (label, s), (_, template) in zip(sets, licenses.TEMPLATES, strict=True):
        wanted = plain_words(template)
        n = len(wanted)
        if len(s) < 16:
            if any(words[i : i + n] == wanted for i in range(len(words))):
                shares[label] = 1.0
            continue
        for start in range(0, len(words), n):
            share = len(set(words[start : start + 2 * n]) & s) / len(s)
            if share >= 0.8:
                shares[label] = max(share, shares.get(label, 0))
    score = 1.0 if base else max(shares.values(), default=0.0)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(shares))), score


def test_all_documents(spark):
    got = {r[0]: tuple(r[1:]) for r in licenses.query(spark, SF).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in table("documents")}
    assert any(r[4] for r in got.values())


def test_awkward_texts(spark):
    mit = licenses.TEMPLATES[0][1]
    filler = " ".join(f"w{i}" for i in range(500))
    texts = [
        mit, mit.upper().replace(" ", ",\n"), " ".join(mit.split()[3:]), " ".join(mit.split()[: len(mit.split()) // 2]), filler + " " + mit + " " + filler,
        "MIT-License", "mit  license mit license", "general public mit license general public license", "the mit. License apache license", "mitt license",
        " ".join(sorted(mit.split())), "licensed under cc by-nc 4.0", filler[:100] + licenses.TEMPLATES[8][1], "a" * 100_000 + " apache license",
    ]
    rows = awkward_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "score").withColumnRenamed("lang", "labels")
    got = sorted((repr(tuple(r)) for r in licenses.scan_licenses(docs, keep=["doc_id"]).collect()))
    assert got == sorted(repr((r[0], *brute(r[1]))) for r in rows)
    assert licenses.scan_licenses(docs.limit(0)).collect() == []
    assert {r.labels for r in licenses.scan_licenses(docs, templates=[], keep=["doc_id"]).collect()} >= {"", "mit"}


def labels_of(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.labels for r in licenses.scan_licenses(docs, keep=["doc_id"], **options).orderBy("doc_id").collect()]


def test_prose_and_other_licenses_have_no_label(spark):
    prose = [
        "the students under the age of nine were released, and the driver got a license from the city",
        "he is a licensed guide, by the river cc 4 people drowned, under 0 degrees",
        "the work of this commons is under a license; creative people are licensed by attribution",
    ]
    assert labels_of(spark, prose) == ["", "", ""]
    gpl = "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"
    assert labels_of(spark, [gpl, "under the terms of the GNU Lesser General Public License"]) == ["gpl,gpl-notice", "gpl,lgpl"]


def test_templates_in_parts_and_long_ones(spark, monkeypatch):
    long = " ".join(f"word{i}" for i in range(3000))
    filler = " ".join(f"other{i}" for i in range(1700))
    templates = [*licenses.TEMPLATES, ("long", long)]
    texts = [f"{filler} {long} {filler}", " ".join(long.split()[:2500]), " ".join(long.split()[:2300]), licenses.TEMPLATES[0][1], None]
    whole = labels_of(spark, texts, templates=templates)
    assert whole == ["long", "long", "", "mit-notice", ""]
    monkeypatch.setattr(licenses, "PART_BYTES", 300)
    assert len(licenses._parts(templates)) > 3
    assert labels_of(spark, texts, templates=templates) == whole
