import pytest
from pyspark.sql import functions as F

from coldkeep.functions.normalize import normalize_names, normalize_values


def texts(df, mode="lenient"):
    return [tuple(r) for r in normalize_values(df, mode=mode).collect()]


def test_every_type_becomes_text(spark):
    df = spark.sql(
        """SELECT tinyint(1) a, smallint(2) b, 3 c, 4L d, 1.5f e, 2.25D f, 3.125BD g, true h,
        DATE '2020-01-02' i, TIMESTAMP '2020-01-02 03:04:05.6' j, TIMESTAMP_NTZ '2020-01-02 03:04:05' k,
        ' Ab ' l, X'FF00' m, array(1, 2) n, array(1.5D) o, named_struct('date', 1) p, map('b', 1, 'a', 2) q"""
    )
    (row,) = texts(df)
    assert row[:12] == (
        "1", "2", "3", "4", "1.50000", "2.25000", "3.12500", "true",
        "2020-01-02 00:00:00", "2020-01-02 03:04:05", "2020-01-02 03:04:05", "ab",
    )
    assert len(row[12]) == 64
    assert row[13:16] == ("[1,2]", "[1.5]", '{"date":1}')
    assert row[16] == '[{"key":"a","value":2},{"key":"b","value":1}]'
    assert all(isinstance(v, str) for v in texts(df, "strict")[0])


def test_nulls_of_every_type(spark):
    df = spark.sql(
        "SELECT CAST(NULL AS INT) a, CAST(NULL AS DOUBLE) b, CAST(NULL AS STRING) c, "
        "CAST(NULL AS BOOLEAN) d, CAST(NULL AS TIMESTAMP) e, CAST(NULL AS BINARY) f, "
        "CAST(NULL AS ARRAY<INT>) g"
    )
    assert texts(df) == texts(df, "strict") == [("null",) * 7]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT * FROM VALUES (' A '), ('a') t(x)",
        "SELECT * FROM VALUES (1.000001D), (1.000002D) t(x)",
        "SELECT * FROM VALUES (TIMESTAMP '2020-01-01 12:00:00.1'), (TIMESTAMP '2020-01-01 12:00:00.2') t(x)",
        "SELECT * FROM VALUES (NULL), ('null') t(x)",
        "SELECT * FROM VALUES ('NULL'), ('null') t(x)",
    ],
)
def test_lenient_equals_and_strict_differs(spark, sql):
    df = spark.sql(sql)
    assert len(set(texts(df))) == 1
    assert len(set(texts(df, "strict"))) == 2


def test_tabs_are_not_trimmed(spark):
    assert texts(spark.createDataFrame([("\ta ",)], "x string")) == [("\ta",)]


def test_names(spark):
    df = spark.range(1).select(F.lit(1).alias(" A "), F.lit(2).alias("b.C"))
    assert normalize_names(df).columns == ["a", "b.c"]
    assert normalize_values(normalize_names(df)).head() == ("1", "2")
    with pytest.raises(ValueError):
        normalize_names(spark.range(1).select(F.lit(1).alias("A"), F.lit(2).alias("a ")))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        normalize_values(spark.range(1), mode="loose")
