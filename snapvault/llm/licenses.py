"""License scans: fixed phrases, and license notices by an exact set-similarity join with templates.

For each template a text is cut into blocks of twice its words that overlap by half, so that every passage as long as the
template lies whole in one. A template of few distinct words is not told from prose by a set: it must stand there word for word.
Tokens are ordered by how often they stand in the corpus. A block and a template can only share enough tokens if
their rarest ones meet (prefix filter), if the block has enough of them (length filter) and if enough are left
behind the first meeting point (positional filter); what passes is counted exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import WORDS, field, map_texts, plain_words, slices
from snapvault.session import settled

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Characteristic passages of well-known licenses and their labels.
TEMPLATES = [
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-notice", "the software is provided as is without warranty of any kind express or implied"),
    ("mit-release", "released under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
TEMPLATE_TEXT = "__license_text"
PART_BYTES = 4 << 20  # of templates that a task holds at a time
FEW = 16  # distinct words; templates of fewer count word for word only


class Matcher:
    """Templates ready for the join: token ranks from rare to frequent, sorted token sets, prefixes and block widths."""

    def __init__(self, templates, threshold, frequencies=None):
        texts = [(label, plain_words(t.encode())) for label, t in templates]
        texts = [(label, words) for label, words in texts if words]
        tokens = sorted({t for _, words in texts for t in words}, key=lambda t: ((frequencies or {}).get(t, 0), t))
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.label = [label for label, _ in texts]
        self.words = [np.array([self.rank[t] for t in words], dtype=np.int64) for _, words in texts]
        self.sets = [np.unique(words) for words in self.words]
        self.exact = [len(s) < FEW for s in self.sets]
        self.need = [len(s) if e else math.ceil(threshold * len(s) - 1e-9) for s, e in zip(self.sets, self.exact, strict=True)]
        self.by_prefix: dict[int, list[tuple[int, int]]] = {}
        for k, s in enumerate(self.sets):
            for i in range(len(s) - self.need[k] + 1):
                self.by_prefix.setdefault(int(s[i]), []).append((k, i))
        self.is_prefix = np.zeros(len(tokens) + 1, dtype=bool)
        self.is_prefix[list(self.by_prefix)] = True

    def match(self, ranks: np.ndarray) -> dict[str, float]:
        """Labels of the templates that some block contains to the threshold, with the largest share contained."""
        found: dict[str, float] = {}
        met, blocks = set(), {}
        for place in np.flatnonzero(self.is_prefix[ranks]).tolist():
            token = int(ranks[place])
            for k, i in self.by_prefix[token]:
                width = len(self.words[k])
                for at in {place // width, max(place // width - 1, 0)}:
                    if (k, at, token) in met:
                        continue
                    met.add((k, at, token))
                    key = (width, at)
                    if key not in blocks:
                        if len(blocks) > 64:
                            blocks.clear()
                        block = np.unique(ranks[at * width : (at + 2) * width])
                        blocks[key] = block[block >= 0]
                    share = self._share(k, i, token, blocks[key])
                    if share and self.exact[k] and not _stands(ranks[at * width : (at + 2) * width], self.words[k]):
                        continue
                    if share:
                        found[self.label[k]] = max(found.get(self.label[k], 0.0), share)
        return found

    def _share(self, k: int, i: int, token: int, block: np.ndarray) -> float:
        """The part of template ``k`` that the block holds, if it is enough; ``token``, the template's ``i``-th, is in both."""
        s, need = self.sets[k], self.need[k]
        j = int(np.searchsorted(block, token))
        if len(block) < need or j > len(block) - need or 1 + min(len(s) - i - 1, len(block) - j - 1) + min(i, j) < need:
            return 0.0
        shared = len(np.intersect1d(s, block, assume_unique=True))
        return shared / len(s) if shared >= need else 0.0


def _stands(ranks: np.ndarray, words: np.ndarray) -> bool:
    """Whether the words stand somewhere one behind the other."""
    if len(ranks) < len(words):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(ranks, len(words)) == words).all(axis=1).any())


def _ranks(words, rank):
    get = rank.get
    return np.array([get(w, -1) for w in words], dtype=np.int64)


def token_counts(docs: DataFrame, templates, *, text: str = "text") -> dict[bytes, int]:
    """How often each token of the templates stands in all texts; as many numbers as the templates have tokens."""
    rank = Matcher(templates, 1.0).rank
    tokens = list(rank)

    def count(batches):
        total = np.zeros(len(tokens) + 1, dtype=np.int64)
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                if value:
                    total += np.bincount(_ranks(plain_words(value), rank) + 1, minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(tokens)), pa.int32()), pa.array(total[1:])], names=["token", "n"]
        )

    texts = docs.select(F.col(f"`{text}`").cast("binary").alias("t"))
    counted = texts.mapInArrow(count, "token int, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {tokens[r["token"]]: r["n"] for r in counted.collect()}


def scan_licenses(
    docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, templates=TEMPLATES, phrases=PHRASES,
    threshold: float = 0.8,
) -> DataFrame:
    """``docs`` with ``n_words``, places of the phrases (``n_base``, ``first_word``, ``last_word``), labels and ``score``.

    Null and empty texts have no words, no labels and score 0. ``score`` is 1 for a phrase, else the largest share of a
    template's distinct words that one block holds, if that reaches ``threshold``; else 0. Templates of fewer than 16 distinct
    words must stand word for word. Several labels at one place all count. A block has twice the words of its template. Tasks
    hold 4 MB of templates at a time; more are joined part by part, with the texts written once a part.
    """
    kept = list(docs.columns if keep is None else keep)
    parts = _parts(templates)
    own = [f"__labels_{i}" for i in range(len(parts))], [f"__score_{i}" for i in range(len(parts))]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    found = _with_phrases(docs.withColumn(TEMPLATE_TEXT, F.col(f"`{text}`")), phrases, [c for c in kept if c not in names])
    for i, part in enumerate(parts):
        matcher = Matcher(part, threshold, token_counts(docs, part, text=text))
        last = i == len(parts) - 1
        columns = [c for c in found.columns if c != TEMPLATE_TEXT or not last]
        found = _with_templates(found, matcher, own[0][i], own[1][i], columns)
        found = found if last else settled(found, "licenses")
    base = F.filter(F.split("base_labels", ","), lambda c: c != "")
    labels = F.array_sort(F.array_distinct(F.concat(base, *own[0])))
    score = F.when(F.col("base_labels") != "", 1.0).otherwise(F.greatest(F.lit(0.0), F.lit(0.0), *own[1]))
    shown = [F.col(f"`{c}`") for c in kept if c not in (*names, "labels", "score")]
    return found.select(*shown, *names, F.array_join(labels, ",").alias("labels"), score.alias("score"))


def _parts(templates) -> list[list[tuple[str, str]]]:
    """The templates in groups of at most ``PART_BYTES``, or one template."""
    parts, held = [], 0
    for label, template in templates:
        if not parts or held + len(template) > PART_BYTES:
            parts.append([])
            held = 0
        parts[-1].append((label, template))
        held += len(template)
    return parts


def _with_phrases(docs: DataFrame, phrases, keep: list[str]) -> DataFrame:
    wanted = [(tuple(plain_words(p.encode())), label) for p, label in phrases.items()]

    def make():
        def one(value):
            lowered = value.translate(WORDS) if value else b""
            words, places, base = lowered.split(), [], set()
            for phrase, label in wanted:
                if all(w in lowered for w in phrase):
                    hits = _places(words, phrase)
                    if hits:
                        places += hits
                        base.add(label)
            return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base))

        return lambda texts: list(zip(*map(one, texts), strict=True)) or [[]] * 5

    fields = [
        field("n_words", "bigint"), field("n_base", "bigint"), field("first_word", "bigint"), field("last_word", "bigint"),
        field("base_labels", "string"),
    ]
    return map_texts(docs, TEMPLATE_TEXT, make, fields, [*keep, TEMPLATE_TEXT])


def _with_templates(docs: DataFrame, matcher: Matcher, labels: str, score: str, keep: list[str]) -> DataFrame:
    def make():
        def one(value):
            words = plain_words(value) if value else []
            found = matcher.match(_ranks(words, matcher.rank)) if words else {}
            return sorted(found), max(found.values(), default=0.0)

        return lambda texts: list(zip(*map(one, texts), strict=True)) or [[]] * 2

    return map_texts(docs, TEMPLATE_TEXT, make, [field(labels, "array<string>"), field(score, "double")], keep)


def _places(words, phrase):
    """Starts of all places where the phrase's words stand consecutively."""
    found, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return found
        if tuple(words[at : at + n]) == phrase:
            found.append(at)


def query(spark, sf_dir):
    from snapvault.llm.common import read

    return scan_licenses(read(spark, sf_dir, "documents"), keep=["doc_id"])
