"""Fixtures as rows, and plain versions of what the operators share."""

import os
import re
import sys

import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet, " * 4000
AWKWARD = [
    None, "", " ", "\n\n\t", "a", "a b", "...", "##", "İstanbul ſ K ß ü\u00a0nbsp \u2028line", "x" * 50_000, LONG,
    "same text twice here", "same text twice here", "The THE the", "1 2 3", "日本語 テキスト", "🙂" * 30,
    "<|start|>user<|end|> \\1 \\0 [INST]", "ab\x0bcd\x0cef\r\ngh",
]


def table(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def awkward_rows():
    return [(i, t, "en", "s", None) for i, t in enumerate(AWKWARD)] + [(None, "null key text", None, None, None), (0, "repeated key", "de", "s", 1)]


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def spaced_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
