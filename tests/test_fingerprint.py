import itertools

from pyspark.sql import functions as F

from snapvault.functions.fingerprint import checksum, row_hash
from snapvault.operators.tables import observed


def _sum(df):
    return tuple(checksum(df).head())


def _differ(spark, ddl, rows):
    """All the given rows have different hashes."""
    df = spark.createDataFrame(rows, ddl)
    hashes = df.select(row_hash(df.schema)).collect()
    return len(set(hashes)) == len(rows)


def test_values_that_plain_hashing_confuses(spark):
    assert _differ(spark, "a int, b int", [(None, 1), (1, None), (None, None), (1, 1), (0, 1), (1, 0)])
    assert _differ(spark, "a string, b string", [("", None), (None, ""), ("ab", ""), ("a", "b"), ("", "ab")])
    arrays = [[], [None], [None, None], [1], [1, None], [None, 1], None]
    assert _differ(spark, "a array<int>", [(a,) for a in arrays])
    assert _differ(spark, "a array<int>, b array<int>", list(itertools.product(arrays, arrays)))
    nested = [[[]], [[], []], [[1], []], [[], [1]], [[1]], [None], []]
    assert _differ(spark, "a array<array<int>>", [(a,) for a in nested])
    assert _differ(spark, "s struct<x:int,y:int>", [(None,), ((None, None),), ((1, None),), ((None, 1),)])
    maps = [{}, {"a": None}, {"a": "b"}, {"b": "a"}, {"a": "b", "b": "a"}, None]
    assert _differ(spark, "m map<string,string>", [(m,) for m in maps])
    assert _differ(spark, "m array<map<string,int>>", [([{"a": 1}],), ([{"a": 2}],), ([{"a": 1}, {}],), ([],)])


def test_row_and_map_order_do_not_count(spark):
    one = spark.sql("SELECT id, map('a', id, 'b', 2L) AS m FROM range(100)")
    two = spark.sql("SELECT id, map('b', 2L, 'a', id) AS m FROM range(100)").orderBy(F.desc("id")).select("m", "id")
    assert _sum(one) == _sum(two)


def test_lost_doubled_and_swapped_rows_show(spark):
    base = spark.range(1000).withColumn("v", F.col("id") % 7)
    sums = [
        _sum(base),
        _sum(base.where("id <> 500")),
        _sum(base.unionAll(base.where("id = 500"))),
        _sum(base.unionAll(base.where("id IN (500, 501)"))),
        _sum(base.withColumn("v", F.when(F.col("id") == 3, 9).otherwise(F.col("v")))),
        _sum(base.unionAll(base)),
    ]
    assert len(set(sums)) == len(sums)


def test_negative_zero_and_nan(spark):
    one = spark.sql("SELECT 0.0D AS a, double('NaN') AS b")
    two = spark.sql("SELECT -0.0D AS a, double('NaN') AS b")
    assert _sum(one) == _sum(two)


def test_sum_is_exact(spark):
    df = spark.range(5000).selectExpr("id", "cast(id as string) s")
    hashes = [r[0] for r in df.select(row_hash(df.schema)).collect()]
    xor = 0
    for h in hashes:
        xor ^= h
    assert _sum(df) == (5000, sum(hashes), xor)


def test_observed_equals_checksum_and_empty(spark, tmp_path):
    df = spark.range(777).selectExpr("id", "array(id, null) a")
    for name, data in (("full", df), ("none", df.where("false"))):
        passing, seen = observed(data)
        passing.write.parquet(str(tmp_path / name))
        assert seen.get == checksum(data).head().asDict()
        assert _sum(spark.read.parquet(str(tmp_path / name))) == _sum(data)


def test_collated_and_variant_values(spark):
    from snapvault.plans.verify import compare_rows

    one = spark.sql("SELECT 'a' COLLATE UTF8_LCASE c, struct(parse_json('1')) v, parse_json('2') w, NULL n")
    two = spark.sql("SELECT 'A' COLLATE UTF8_LCASE c, struct(parse_json('1')) v, parse_json('2') w, NULL n")
    three = spark.sql("SELECT 'a' COLLATE UTF8_LCASE c, struct(parse_json('9')) v, parse_json('2') w, NULL n")
    assert len({_sum(one), _sum(two), _sum(three)}) == 3
    assert [tuple(compare_rows(one, x).head())[2:] for x in (one, two, three)] == [(0, 0), (1, 1), (1, 1)]


def test_odd_column_names(spark, tmp_path):
    from snapvault.plans.verify import compare_rows

    df = spark.range(3).select(F.col("id").alias("a.b"), F.lit(1).alias("x`y"), F.lit(2).alias("sp ace"))
    passing, seen = observed(df)
    passing.write.parquet(str(tmp_path / "odd"))
    back = spark.read.parquet(str(tmp_path / "odd"))
    assert seen.get["row_count"] == 3 and _sum(back) == _sum(df)
    assert tuple(compare_rows(df, back).head()) == (3, 3, 0, 0)


def test_screened_comparison_moves_few_rows_and_counts_all(spark):
    from snapvault.operators.verify import bucket_checksums, compare_screened, in_buckets
    from snapvault.plans.verify import compare_rows

    base = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS v", "id % 2 = 0 AS even")
    one = base.withColumn("v", F.expr("CASE WHEN id = 777 THEN -1 ELSE v END")).select("even", "v", "id")
    assert compare_screened(base, base) == (20_000, 20_000, 0, 0)
    assert compare_screened(base, one) == (20_000, 20_000, 1, 1) == tuple(compare_rows(base, one).head())
    other = {r["bucket"]: tuple(r) for r in bucket_checksums(one.select(*base.columns)).collect()}
    differing = [r["bucket"] for r in bucket_checksums(base).collect() if tuple(r) != other.get(r["bucket"])]
    assert 1 <= len(differing) <= 2 and in_buckets(base, differing).count() < 200

    hot = base.unionAll(spark.createDataFrame([(5, 5, False)] * 4000, base.schema))
    fewer = hot.where("id <> 9").unionAll(spark.createDataFrame([(5, 5, False), (-1, None, None)], base.schema))
    assert compare_screened(hot, fewer) == tuple(compare_rows(hot, fewer).head()) == (24_000, 24_001, 1, 2)
    none = base.where("false")
    assert compare_screened(none, none) == (0, 0, 0, 0) and compare_screened(none, base.limit(3)) == (0, 3, 0, 3)
