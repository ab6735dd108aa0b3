from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from coldkeep.functions.checksums import column_checksum, row_checksum


def sums(df, algorithm="xxhash64"):
    return {r["column"]: (r["n_rows"], r["checksum"]) for r in column_checksum(df, algorithm=algorithm).collect()}


def test_value_borders_matter(spark):
    a = spark.createDataFrame([("ab",), ("c",)], "x string")
    b = spark.createDataFrame([("a",), ("bc",)], "x string")
    assert sums(a) != sums(b) and sums(a, "md5") != sums(b, "md5")


def test_order_and_partitioning_do_not_matter(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("x"))
    for algorithm in ("xxhash64", "md5"):
        assert sums(df, algorithm) == sums(df.orderBy(F.desc("id")).repartition(7), algorithm)


def test_copies_matter(spark):
    one = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    two = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    assert sums(one) != sums(two)


def test_no_rows(spark):
    assert sums(spark.createDataFrame([], "x string, y string")) == {"x": (0, 0), "y": (0, 0)}


def test_md5_sum_is_exact(spark):
    import hashlib

    values = [f"v{i}" for i in range(500)] * 3
    df = spark.createDataFrame([(v,) for v in values], "x string").repartition(5)
    want = sum(int(hashlib.md5(v.encode()).hexdigest()[:15], 16) for v in values)
    assert sums(df, "md5")["x"] == (1500, want)


def test_row_checksum_leaves_stamps_out(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    stamped = df.withColumn("archived_at", F.current_timestamp())
    plain = df.select(row_checksum(df)).head()[0]
    assert stamped.select(row_checksum(stamped)).head()[0] == plain
    assert stamped.select(row_checksum(stamped, include_metadata=True)).head()[0] != plain
    assert df.select(F.md5(F.lit("1||NULL"))).head()[0] == plain


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=4), min_size=1, max_size=20))
def test_shuffled_values_agree(spark, values):
    a = spark.createDataFrame([(v,) for v in values], "x string")
    b = spark.createDataFrame([(v,) for v in reversed(values)], "x string")
    assert sums(a) == sums(b)
