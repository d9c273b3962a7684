import fnmatch
import random
from datetime import datetime, timedelta
from fractions import Fraction

from pyspark.sql import functions as F

from snapvault.functions.files import FILE_CLASSES, SIZE_UNITS, below, file_type, format_size, matches_any
from snapvault.functions.naming import snapshot_name, snapshot_source, snapshot_time, stamp
from snapvault.plans.retention import age_days, matches_name


def test_snapshot_name(one):
    rows = [("lh_Silver1", "WSP_transform_dev"), ("my_lh_lake_Lakehouse", "x_workspace_wsp_y"), ("a", "b")]
    at = F.lit("2025-11-10 14:30:15").cast("timestamp_ntz")
    got = one(rows, "l string, w string", snapshot_name(F.col("l"), F.col("w"), at))
    assert [g[0] for g in got] == [
        "silver1_transform_dev_backup_2025-11-10_14-30-15",
        "my_lake_x_y_backup_2025-11-10_14-30-15",
        "a_b_backup_2025-11-10_14-30-15",
    ]


def _time(name):
    end = name[-len("yyyy-MM-dd_HH-mm-ss") :]
    try:
        date, time = end.split("_")
        at = datetime.fromisoformat(f"{date} {time.replace('-', ':')}")
    except ValueError:
        return None
    return at if at.isoformat(sep="_").replace(":", "-") == end else None


NAMES = [
    "a_backup_2025-11-10_14-30-15",
    "2025-11-10_14-30-15",
    "x2025-11-10_14-30-15",
    "12025-11-10_14-30-15",
    "a_backup_2001-02-30_00-00-00",
    "a_backup_2000-02-29_23-59-59",
    "a_backup_1900-02-29_00-00-00",
    "a_backup_2025-11-10_24-00-00",
    "a_backup_2025-11-10_23-60-00",
    "a_backup_2025-11-10_23-59-60",
    "a_backup_0000-01-01_00-00-00",
    "a_backup_0001-01-01_00-00-00",
    "a_backup_2025-11-10_14-30-15/",
    "a_backup_2025-11-10 14:30:15",
    "a_backup_2025-11-10_14:30:15",
    "a_backup_2025-11-10T14-30-15",
    "a_backup_2025_11_10_14-30-15",
    "a_backup_2025-1-1_14-30-15",
    "a_backup_2025-11-10_14-30-15_copy",
    "-11-10_14-30-15",
    "",
    "ä_ü_backup_2025-11-10_14-30-15",
    "backup_٢٠٢٥-11-10_14-30-15x",
]


def test_snapshot_time(one):
    got = one([(n,) for n in NAMES], "n string", "n", snapshot_time(F.col("n")))
    assert {n: t for n, t in got} == {n: _time(n) for n in NAMES}


def test_snapshot_time_strict(one):
    names = ["a_backup_2025-11-10_14-30-15", "a_bckup_2025-11-10_14-30-15", "2025-11-10_14-30-15"]
    got = one([(n,) for n in names], "n string", snapshot_time(F.col("n"), strict=True).isNotNull())
    assert [g[0] for g in got] == [True, False, False]


def test_source_and_stamp_do_not_depend_on_time_zone(spark, one):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        # 02:30 on that day does not exist in Berlin.
        at = F.lit("2025-03-30 02:30:00").cast("timestamp_ntz")
        age = age_days(at, datetime(2025, 3, 31, 2, 29, 59))
        name = F.lit("a_b_backup_2025-03-30_02-30-00")
        got = one([(1,)], "x int", stamp(at), age, snapshot_source(name), stamp(snapshot_time(name)))
        assert got == [("2025-03-30_02-30-00", 0, "a_b", "2025-03-30_02-30-00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_age_is_floored(spark):
    as_of = datetime(2025, 11, 10, 12, 0, 0, 500000)
    rng = random.Random(1)
    times = [as_of.replace(microsecond=0) + timedelta(seconds=rng.randint(-10**7, 10**6)) for _ in range(500)]
    times += [as_of.replace(microsecond=0) + timedelta(days=d, seconds=s) for d in (-31, -30, -1, 0, 1) for s in (-1, 0, 1)]
    rows = spark.createDataFrame([(t.isoformat(sep=" "),) for t in times], "t string")
    got = rows.select("t", age_days(F.col("t").cast("timestamp_ntz"), as_of).alias("a")).collect()
    assert all(r["a"] == (as_of - datetime.fromisoformat(r["t"])).days for r in got)


def test_name_pattern_is_literal(one):
    rows = [("Silver1_x",), ("silverX",), ("a.b",), ("aXb",)]
    check = lambda p: [g[0] for g in one(rows, "n string", matches_name(F.col("n"), p))]
    assert check(" SILVER1_ ") == [True, False, False, False]
    assert check("a.b") == [False, False, True, False]
    assert check("  ") == check("") == [True] * 4


def test_file_type(one):
    known = [(f"x.{e}", c) for c, exts in FILE_CLASSES.items() for e in exts.split()]
    assert len(known) == 35 and len(FILE_CLASSES) == 9
    more = [("X.JPG", "image"), ("noext", "unknown"), ("a.tar.gz", "archive"), ("a.", "other"), (".csv", "data"), ("a.b.", "other")]
    got = one([(n,) for n, _ in known + more], "n string", "n", file_type(F.col("n")))
    assert dict(got) == dict(known + more)


def _size(n):
    power = min(max(n.bit_length() - 1, 0) // 10, 5)
    cents = round(Fraction(100 * n, 1024**power))  # ties to even
    return f"{cents // 100}.{cents % 100:02d} {SIZE_UNITS[power]}"


def test_format_size(one):
    rng = random.Random(2)
    sizes = [0, 1, 1023, 1024, 1152, 1408, 1049, 2**20 - 1, 2**20, 2**30 - 1, 2**40, 2**50, 2**53, 1024**5 * 1024]
    sizes += [int(2 ** rng.uniform(0, 53)) for _ in range(3000)]
    sizes += [1024 * k + 1024 * c // 8 for k in range(1, 40) for c in range(8)]
    got = one([(s,) for s in sizes], "s bigint", "s", format_size(F.col("s")))
    assert [g for g in got if g[1] != _size(g[0])] == []


PATHS = [
    "a.csv", "sub/a.csv", "sub/deep/a.CSV", "a", "a[1].txt", "x-y", "a\nb.csv", "b]c", "a^b", "d\\e", "!x", "a.b.c", "ü.txt",
    "doc_1.txt", "doc_12.txt", "sub/doc_1.txt", "&&", "a-z", "]",
]
GLOBS = [
    "*", "*.csv", "sub/*", "?.csv", "a[[]1].txt", "[abc]*", "[!abc]*", "*[0-9].txt", "[a-c]", "[z-a]", "[!z-a]", "x[-]y",
    "x[,--]y", "b[]]c", "b[!]]c", "a[^x]b", "a[", "a\\*", "d\\e", "[&&]*", "*.b.*", "ü*", "**/doc_?.txt", "[]", "[!]", "",
]


def test_globs_equal_fnmatch(one):
    rows = [(p,) for p in PATHS]
    for glob in GLOBS:
        got = one(rows, "p string", "p", matches_any(F.col("p"), [glob]))
        assert dict(got) == {p: fnmatch.fnmatchcase(p, glob) for p in PATHS}, glob
    got = one(rows, "p string", "p", matches_any(F.col("p"), ["*.csv", "a[1].txt", "x*"]))
    assert dict(got) == {p: any(fnmatch.fnmatchcase(p, g) for g in ["*.csv", "a[1].txt", "x*"]) for p in PATHS}


def test_below(one):
    rows = [("s3://b/x/Files/a/b.txt",), ("/Files/a/Files/b",), ("/other/a",)]
    got = one(rows, "p string", below(F.col("p")))
    assert [g[0] for g in got] == ["a/b.txt", "a/Files/b", None]
