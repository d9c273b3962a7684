"""Language ID with a string kernel: blended n-gram presence, Nyström landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of byte n-grams (1 to 3 bytes, A-Z lower-cased) that both have, over the root of
the product of what each has; a text is its set of n-grams, however long it is. Landmarks are some training texts.
Regression runs in the space they span, and texts are scored in batches: n-gram presence times landmarks gives the kernel
block, the kernel block times the weights gives a score a language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import LOWER, field, hashed_sample, map_texts

LENGTHS = (1, 2, 3)
UNKNOWN = "und"
_ASCII_LETTER = re.compile(b"[A-Za-z]")
BATCH = 128  # texts whose presence rows stand in memory at a time


def training_rows(key: Column) -> Column:
    """True for rows that may be learned from: three in four, by the CRC of the key's text. A null key is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) != 2, F.lit(True))


def ngrams(text: bytes) -> np.ndarray:
    """Codes of all n-grams, with repeats; each length has a range of its own."""
    b = np.frombuffer(text.translate(LOWER), dtype=np.uint8).astype(np.int32)
    codes = [b]
    if len(b) > 1:
        codes.append((b[:-1] << 8 | b[1:]) + 256)
    if len(b) > 2:
        codes.append((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + 256 + 65536)
    return np.concatenate(codes)


CODES = 256 + 65536 + (1 << 24)


@dataclass
class Model:
    """``columns``: the n-grams that landmarks have; ``landmarks``: their presence, one landmark a column, scaled."""

    languages: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        """From an n-gram to its column; n-grams that no landmark has share the last one, which is not used."""
        if not hasattr(self, "_table"):
            self._table = np.full(CODES, len(self.columns), dtype=np.uint16 if len(self.columns) < 65535 else np.int32)
            self._table[self.columns] = np.arange(len(self.columns))
        return self._table

    def presence(self, texts: list[bytes]) -> np.ndarray:
        table = self.table()
        rows = np.zeros((len(texts), len(self.columns) + 1), dtype=np.float32)
        for row, text in zip(rows, texts):
            row[table[ngrams(text)]] = 1
        rows = rows[:, :-1]
        return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        kernel = self.presence(texts) @ self.landmarks
        return kernel @ self.weights


def fit(texts: list[bytes], languages: list[str], *, landmarks: int = 192, ridge: float = 1e-2, min_count: int = 2) -> Model:
    """Fit on the given rows; landmarks are dealt evenly over the languages. N-grams of fewer than ``min_count`` landmarks
    tell nothing of a language and are left out where others remain."""
    known = sorted(set(languages))
    by = {k: [i for i, lang in enumerate(languages) if lang == k] for k in known}
    chosen: list[int] = []
    for k in known:
        chosen += by[k][: max(1, landmarks // len(known))]
    own = [np.unique(ngrams(texts[i])) for i in chosen]
    columns, counts = np.unique(np.concatenate([np.empty(0, np.int32), *own]), return_counts=True)
    columns = columns[counts >= min_count] if (counts >= min_count).any() else columns
    model = Model(known, columns, np.zeros((len(columns), 0), np.float32), np.zeros((0, len(known)), np.float32))
    model.landmarks = np.ascontiguousarray(model.presence([texts[i] for i in chosen]).T)
    between = (model.landmarks.T @ model.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(between)
    good = values > 1e-6 * max(values.max(initial=0), 1e-12)
    spread = vectors[:, good] / np.sqrt(values[good])  # Nyström: kernel block times this are the features
    rows = [model.presence(texts[i : i + BATCH]) @ model.landmarks for i in range(0, len(texts), BATCH)]
    features = np.concatenate(rows).astype(np.float64) @ spread
    answers = np.array([[1.0 if lang == k else -1.0 for k in known] for lang in languages])
    share = np.array([len(texts) / (len(known) * len(by[lang])) for lang in languages])
    left = features.T @ (features * share[:, None]) + ridge * len(texts) / max(1, features.shape[1]) * np.eye(features.shape[1])
    model.weights = (spread @ np.linalg.solve(left, features.T @ (answers * share[:, None]))).astype(np.float32)
    return model


def train(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 1500, **options
) -> Model | None:
    """Learn from rows with text and language that are not held out; at most ``sample`` of them, those with the smallest
    hash of key and text, come to the driver. None without any such row."""
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l"))
    rows = rows.filter(training_rows(F.col("k")) & F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    rows = rows.select(F.xxhash64(F.col("k").cast("string"), "t").alias("o"), "l", F.col("t").cast("binary").alias("t"))
    found = hashed_sample(rows, F.col("o"), sample).collect()
    return fit([bytes(r["t"]) for r in found], [r["l"] for r in found], **options) if found else None


def _scorer(model):
    def make():
        def work(texts):
            known = [i for i, t in enumerate(texts) if t and _has_letter(t)]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if model is None:
                return names, scores
            for at in range(0, len(known), BATCH):
                part = known[at : at + BATCH]
                margins = model.scores([texts[i] for i in part]).astype(np.float64)
                odds = np.exp(np.clip(4 * (margins - margins.max(axis=1, keepdims=True)), -50, 0))
                best = margins.argmax(axis=1)
                for i, b, o in zip(part, best.tolist(), odds):
                    names[i], scores[i] = model.languages[b], float(o[b] / o.sum())
            return names, scores

        return work

    return make


def _has_letter(text: bytes) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text.decode()))


def identify(
    docs: DataFrame, model: Model | None, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1, the share of the best language's odds).

    Null and empty texts, texts without a letter, and all texts without a model are ``und`` with score 0. Whole texts count,
    however long; equal scores go to the language that sorts first.
    """
    return map_texts(docs, text, _scorer(model), [field("lang_pred", "string"), field("score", "double")], keep)


def lettered(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``has_letter``: whether the text has a letter of any script, as for :func:`identify`; null: false."""

    def make():
        return lambda texts: [[bool(t) and _has_letter(t) for t in texts]]

    return map_texts(docs, text, make, [field("has_letter", "boolean")], keep)


def query(spark, sf_dir):
    from snapvault.llm.common import read

    docs = read(spark, sf_dir, "documents")
    found = identify(docs, train(docs), keep=["doc_id"])
    return found.select("doc_id", (~training_rows(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")
