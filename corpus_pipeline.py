"""A corpus made ready for training: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; :func:`run` writes it and reads it back as the next one's docs.
All but the last give the columns of ``documents``, and any others that came, whatever their names.
"""

from pyspark.sql import functions as F

from snapvault.llm.common import read
from snapvault.llm.decontam import decontaminate
from snapvault.llm.langid import UNKNOWN, identify, lettered, train
from snapvault.llm.packing import pack, tokenizer_path
from snapvault.llm.secrets import content_address, redact, scan_secrets
from snapvault.llm.simhash import near_duplicates
from snapvault.session import settled

ROW = "__row"


def private(docs):
    """``docs`` with all columns under names that no stage uses, those names, and the columns under their own names again."""
    names = {c: f"__column_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names, {c: F.col(n).alias(c) for c, n in names.items()}


def language(spark, docs, sf_dir):
    """Documents whose language is identified; ``und`` ones, texts without a letter, go and no others. ``lang`` stays as it
    came. Where no row to learn from has a language, all texts with a letter stay."""
    model = train(docs)
    inner, names, own = private(docs)
    if model is None:
        return lettered(inner, text=names["text"]).filter("has_letter").select(*own.values())
    return identify(inner, model, text=names["text"]).filter(F.col("lang_pred") != UNKNOWN).select(*own.values())


def near_dedup(spark, docs, sf_dir):
    """One row of each group of near-duplicates: the one with the smallest id, null ids last.

    Rows are told apart by their place, so neither null nor repeated ids lose or keep any: of rows of one id, the one whose
    columns have the smallest hash stays, of equal rows any one.
    """
    inner, names, own = private(docs)
    rows = settled(inner.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    hashed = [f.name for f in inner.schema if "map<" not in f.dataType.simpleString()]
    key = F.col(names["doc_id"])
    order = F.struct(key.isNull().alias("no_id"), key.alias("id"), F.xxhash64(*hashed).alias("hash"), F.col(ROW).alias("row"))
    groups = near_duplicates(rows.select(order.alias("place"), F.col(names["text"]).alias("text")), key="place")
    keep = groups.filter(F.col("place") == F.col("component_id")).select(F.col("place.row").alias(ROW))
    return rows.join(keep, ROW, "left_semi").select(*own.values())


def decontamination(spark, docs, sf_dir):
    """Documents that are not contaminated by benchmark items, those with a null id included."""
    inner, names, own = private(docs)
    found = decontaminate(inner, read(spark, sf_dir, "benchmark"), text=names["text"], null_items=True)
    return found.filter("not contaminated").select(*own.values())


def secret_redaction(spark, docs, sf_dir):
    """All documents, secrets in their texts replaced by a mark; ``n_chars`` follows the text."""
    inner, names, own = private(docs)
    found = scan_secrets(docs.select("doc_id", "text")).filter("size(findings) > 0").select("blob", "findings").dropDuplicates(["blob"])
    old = F.col(names["text"])
    joined = inner.withColumn("blob", content_address(old)).join(found, "blob", "left")
    secret = F.col("findings").isNotNull()
    joined = joined.withColumn("redacted", F.when(secret, redact(old, F.col("findings"))).otherwise(old))
    chars = F.when(secret, F.length("redacted").cast("bigint")).otherwise(F.col(names["n_chars"]))
    return joined.select(*(own | {"text": F.col("redacted").alias("text"), "n_chars": chars.alias("n_chars")}).values())


def packing(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences."""
    return pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_redaction),
    ("best_fit_packing", packing),
]

# Learned language, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
