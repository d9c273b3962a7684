"""Column expressions over file names, paths and sizes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The nine file classes and their extensions.
FILE_CLASSES = {
    "image": "jpg jpeg png gif bmp svg webp",
    "document": "pdf doc docx rtf",
    "text": "txt",
    "spreadsheet": "xls xlsx",
    "data": "csv json xml yaml yml parquet",
    "archive": "zip rar 7z tar gz",
    "code": "py sql js html css",
    "video": "mp4 avi mov",
    "audio": "mp3 wav",
}

# Size units, each 1024 times the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def file_type(name: Column) -> Column:
    """Class of the last extension; ``other`` when it is not known, ``unknown`` without a dot."""
    pairs = [(ext, cls) for cls, exts in FILE_CLASSES.items() for ext in exts.split()]
    classes = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    extension = F.lower(F.substring_index(name, ".", -1))
    known = F.coalesce(F.try_element_at(classes, extension), F.lit("other"))
    return F.when(~name.contains("."), F.lit("unknown")).otherwise(known)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def below(path: Column, marker: str = "/Files/") -> Column:
    """The part of a path after the first ``marker``; null when the marker is absent."""
    at = F.locate(marker, path)
    return F.when(at > 0, F.substr(path, at + F.lit(len(marker))))


def is_hidden(name: Column) -> Column:
    return name.startswith("_") | name.startswith(".")


def format_size(size: Column) -> Column:
    """Bytes as text with two decimals, e.g. ``1.12 KB``.

    Exact integer arithmetic on the bits below the unit, ties to even, so that no floating point
    rounding decides the last digit.
    """
    size = size.cast("bigint")
    shift = lambda value, bits: F.call_function("shiftright", value, bits)
    power = F.lit(len(SIZE_UNITS) - 1)
    for smaller in reversed(range(len(SIZE_UNITS) - 1)):
        power = F.when(size < (1 << (10 * (smaller + 1))), smaller).otherwise(power)
    bits = power * 10
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    scaled = size.bitwiseAND(one - 1) * 100
    cents, rest, half = shift(scaled, bits), scaled.bitwiseAND(one - 1), shift(one, F.lit(1))
    up = (rest > half) | ((rest == half) & (cents % 2 == 1))
    cents = cents + up.cast("bigint")
    whole = shift(size, bits) + (cents == 100).cast("bigint")
    digits = F.substring((cents % 100 + 100).cast("string"), 2, 2)
    unit = F.get(F.array(*[F.lit(u) for u in SIZE_UNITS]), power)
    return F.concat(whole.cast("string"), F.lit("."), digits, F.lit(" "), unit)


def _char_class(body: str) -> str:
    negated = body.startswith("!")
    body = body[1:] if negated else body
    items, i = [], 0
    while i < len(body):
        low = high = body[i]
        if i + 2 < len(body) and body[i + 1] == "-":
            high = body[i + 2]
            i += 2
        i += 1
        if low <= high:
            items.append(f"\\x{{{ord(low):x}}}-\\x{{{ord(high):x}}}")
    if not items:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(items)}]"


def glob_regex(pattern: str) -> str:
    """Java regex body of a shell pattern: ``*`` and ``?`` also match ``/``, ``[abc]``, ``[!abc]``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            # A closing bracket right after the opening (or after "!") is a member, not the end.
            first = i + 1 if pattern[i : i + 1] == "!" else i
            end = pattern.find("]", first + 1)
            if end < 0:
                out.append("\\[")
            else:
                out.append(_char_class(pattern[i:end]))
                i = end + 1
        else:
            out.append(f"\\x{{{ord(ch):x}}}")
    return "".join(out)


def matches_any(path: Column, patterns: list[str]) -> Column:
    """True when the whole path matches at least one shell pattern (case-sensitive)."""
    body = "|".join(f"(?:{glob_regex(p)})" for p in patterns)
    return path.rlike(rf"(?s)\A(?:{body})\z")
