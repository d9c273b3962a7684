"""Quality rules: statistics of whole texts and a decision list learned from labelled ones.

Sequential covering: a rule grows by the threshold condition that gains most, is pruned on rows it was not grown on, and
takes the rows it covers out; the list ends when no rule is better than its prior. The list is emitted as one ordered Spark
conditional expression, so judging documents needs no model on the executors.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.llm.common import field, hashed_sample, map_texts, spaced_words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_distinct")
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_REST = bytes(range(128, 192))  # bytes that continue a character
VOCABULARY = 1 << 21  # distinct words a task numbers at a time; three numbers fit into 63 bits


def _counter():
    numbers = defaultdict(count().__next__)

    def work(texts):
        nonlocal numbers
        rows = []
        for text in texts:
            if not text:
                rows.append((0,) * len(COUNTS))
                continue
            words = spaced_words(text)
            if len(numbers) + len(words) >= VOCABULARY:
                numbers = defaultdict(count().__next__)
            ids = np.array([numbers[w] for w in words], dtype=np.int64)
            seen, dup, lines = set(), 0, 0
            for line in text.split(b"\n"):
                if line.strip(_SPACE):
                    lines += 1
                    dup += line in seen
                    seen.add(line)
            rows.append(
                (
                    len(words),
                    len(text.translate(None, _SPACE + _REST)),
                    len(text) - len(text.translate(None, SYMBOLS)),
                    dup,
                    repeated_words(ids),
                    lines,
                    len(text) - len(text.translate(None, _UPPER)),
                    len(text) - len(text.translate(None, _DIGITS)),
                    len(set(words)),
                )
            )
        return list(zip(*rows, strict=True)) or [[]] * len(COUNTS)

    return work


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more; ``ids`` number the words exactly, below 2**21 each, or are
    renumbered where a single text has more distinct words than that."""
    if len(ids) < 4:
        return 0
    if ids.max() >= VOCABULARY:
        ids = np.unique(ids, return_inverse=True)[1]
    if ids.max() < VOCABULARY:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(np.stack([ids[:-1], ids[1:]]), axis=1, return_inverse=True)[1].ravel()
        keys = np.unique(np.stack([pairs[:-1], pairs[1:]]), axis=1, return_inverse=True)[1].ravel()
    order = np.argsort(keys)
    same = np.diff(keys[order]) == 0
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def text_statistics(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the counts of :data:`COUNTS` over whole texts, all bigint; null and empty texts have zeros.

    Lines count if they have a word; a duplicate equals an earlier line of the text, letter by letter.
    """
    return map_texts(docs, text, _counter, [field(c, "bigint") for c in COUNTS], keep)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _rate(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def features() -> dict[str, Column]:
    """What rules may test: sizes and rates of the counted statistics."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _rate("word_chars", "n_words"),
        "symbols_per_word": _rate("n_symbols", "n_words"),
        "duplicate_lines": _rate("n_dup_lines", "n_lines"),
        "repeated_words": _rate("n_repeat_words", "n_words"),
        "upper_case": _rate("n_upper", "word_chars"),
        "digits": _rate("n_digits", "word_chars"),
        "distinct_words": _rate("n_distinct", "n_words"),
        "words_per_line": _rate("n_words", "n_lines"),
    }


# A condition is (feature, "<=" or ">", threshold), a rule the conjunction of its conditions and the precision it had.
Rule = tuple[list[tuple[str, str, float]], float]


def learn_rules(
    values: np.ndarray, bad: np.ndarray, names: list[str], *, max_rules: int = 12, max_conditions: int = 4, thresholds: int = 32,
    min_precision: float = 0.8, seed: int = 7,
) -> list[Rule]:
    """Ordered rules for bad rows. Two thirds of the rows grow rules, the rest prunes them and decides when to stop.

    Without bad rows, or without good ones, there is nothing to tell apart and the list is empty.
    """
    rules: list[Rule] = []
    if not len(bad) or bad.all() or not bad.any():
        return rules
    grow = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    if not (bad & grow).any() or not (bad & ~grow).any():
        grow = np.ones(len(bad), dtype=bool)
    prune = ~grow if not grow.all() else grow
    cuts = [np.unique(np.quantile(values[bad, j], np.linspace(0, 1, thresholds))) for j in range(values.shape[1])]
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < max_rules and (left & grow & bad).any():
        rule = _grown(values, bad, left & grow, cuts, max_conditions)
        rule = _pruned(values, bad, left & prune, rule)
        covered = _covers(values, rule) & left
        held = covered & prune
        if not rule or not (covered & bad).any() or not held.any() or bad[held].mean() < min_precision:
            break
        rules.append(([(names[j], op, float(t)) for j, op, t in rule], float(bad[covered].mean())))
        left &= ~covered
    return rules


def _covers(values, rule):
    mask = np.ones(len(values), dtype=bool)
    for j, op, t in rule:
        mask &= values[:, j] <= t if op == "<=" else values[:, j] > t
    return mask


def _grown(values, bad, rows, cuts, most):
    """Conditions by information gain (FOIL) until no good row is covered."""
    rule, mask = [], rows.copy()
    while len(rule) < most:
        p0, n0 = int((mask & bad).sum()), int((mask & ~bad).sum())
        if not p0 or not n0:
            break
        best, gain = None, 1e-9
        before = math.log2(p0 / (p0 + n0))
        for j, cut in enumerate(cuts):
            good_v, bad_v = np.sort(values[mask & ~bad, j]), np.sort(values[mask & bad, j])
            p_low, n_low = np.searchsorted(bad_v, cut, "right"), np.searchsorted(good_v, cut, "right")
            for op, p, n in (("<=", p_low, n_low), (">", p0 - p_low, n0 - n_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - before), -1.0)
                k = int(np.argmax(gains))
                if gains[k] > gain:
                    best, gain = (j, op, cut[k]), gains[k]
        if best is None:
            break
        best = _widened(values, bad, mask, *best)
        rule.append(best)
        mask &= _covers(values, [best])
    return rule


def _widened(values, bad, mask, j, op, t):
    """The condition with its threshold halfway between the bad rows it takes and the good ones it leaves."""
    takes = _covers(values, [(j, op, t)])
    taken, left = values[mask & bad & takes, j], values[mask & ~bad & ~takes, j]
    if len(taken) and len(left):
        t = (taken.max() + left.min()) / 2 if op == "<=" else (taken.min() + left.max()) / 2
    return j, op, t


def _pruned(values, bad, rows, rule):
    """The shortest leading part of the rule that is worth most, bad less good rows by rows covered."""

    def worth(part):
        covered = _covers(values, part) & rows
        n = covered.sum()
        return (2 * bad[covered].sum() - n) / n if n else -1.0

    parts = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(parts, key=worth) if parts else []


def rules_expression(rules: list[Rule]) -> Column:
    """True for kept rows: the rules as ordered cases."""
    kept, columns = None, features()
    for conditions, _ in rules:
        test = F.lit(True)
        for name, op, t in conditions:
            test = test & (columns[name] <= t if op == "<=" else columns[name] > t)
        kept = F.when(test, False) if kept is None else kept.when(test, False)
    return F.lit(True) if kept is None else kept.otherwise(True)


def fit_rules(
    statistics: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", sample: int = 20_000, **options
) -> list[Rule]:
    """Rules from labelled statistics; bad is label 0.

    At most ``sample`` labelled documents, those with the smallest hash of their id, come to the driver (a row is nine
    numbers). Of a document's several labels the worst counts; null labels and labels of unknown documents are left out.
    """
    known = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y")).dropna()
    known = known.groupBy("k").agg(F.min("y").alias("y"))
    known = hashed_sample(known, F.xxhash64(F.col("k").cast("string")), sample)
    columns = features()
    rows = (
        statistics.withColumnRenamed(key, "k")
        .join(known, "k")
        .select(F.col("k").cast("string").alias("k"), "y", *[c.alias(n) for n, c in columns.items()])
        .dropDuplicates(["k"])
        .orderBy("k")
        .collect()
    )
    values = np.array([r[2:] for r in rows], dtype=float).reshape(len(rows), len(columns))
    return learn_rules(values, np.array([r[1] == 0 for r in rows], dtype=bool), list(columns), **options)


def query(spark, sf_dir):
    from snapvault.llm.common import read
    from snapvault.session import settled

    found = settled(text_statistics(read(spark, sf_dir, "documents"), keep=["doc_id"]), "quality-statistics")
    rules = fit_rules(found, read(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        *COUNTS[:5],
        base_failed().alias("base_failed"),
        (~base_failed() & rules_expression(rules)).alias("kept"),
    )
