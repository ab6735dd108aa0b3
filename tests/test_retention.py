import datetime as dt

import pytest
from pyspark.sql import functions as F

from coldkeep.functions.retention import expired, expired_filter, retention_days, stamp_retention


@pytest.mark.parametrize("text,days", [("30d", 30), ("6M", 180), ("1y", 365), ("0d", 0), ("2Y", 730)])
def test_days(spark, text, days):
    assert spark.range(1).select(retention_days(F.lit(text))).head()[0] == days


@pytest.mark.parametrize("text", ["6w", "", "d", "6 m", None, "-1d", "1.5y"])
def test_bad_literal_fails(spark, text):
    with pytest.raises(Exception, match="unsupported retention period"):
        spark.range(1).select(retention_days(F.lit(text).cast("string"))).collect()


def rows(spark):
    return spark.sql(
        """SELECT * FROM VALUES
        (1, TIMESTAMP '1997-01-01 00:00:00', false), (2, TIMESTAMP '1996-12-31 23:59:59.999999', false),
        (3, TIMESTAMP '1990-01-01 00:00:00', true), (4, TIMESTAMP '1990-01-01 00:00:00', NULL),
        (5, NULL, false) t(id, retention_expires_at, legal_hold)"""
    )


def test_midnight_hold_and_nulls(spark):
    df = rows(spark)
    assert [r.id for r in df.filter(expired("1997-01-01")).collect()] == [2]
    assert [r.id for r in df.filter(expired_filter("1997-01-01", df.columns)).collect()] == [2]
    assert sorted(r.id for r in df.filter(~expired("1997-01-01")).collect()) == [1, 3, 4, 5]


def test_time_of_day_does_not_matter(spark):
    df = rows(spark)
    assert [r.id for r in df.filter(expired("1997-01-01 18:00:00")).collect()] == [2]


def test_stamp(spark):
    row = stamp_retention(spark.range(1), "6m", False, dt.datetime(2024, 1, 31, 12)).head()
    assert row.archived_at == dt.datetime(2024, 1, 31, 12)
    assert row.retention_expires_at == dt.datetime(2024, 7, 29, 12)
    assert row.legal_hold is False


def test_basis_null_never_expires(spark):
    df = spark.sql("SELECT CAST(NULL AS DATE) AS d")
    row = stamp_retention(df, "1d", False, "2024-01-01", basis="d").head()
    assert row.retention_expires_at is None
