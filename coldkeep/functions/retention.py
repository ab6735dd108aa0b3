"""Retention periods, stamps and the expired-row predicate."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

# A period is a number and one of these units, in days.
PERIOD_PATTERN = r"^(\d+)([dDmMyY])$"
UNIT_DAYS = {"d": 1, "m": 30, "y": 365}
# Columns that archiving adds; a source must not have them, in any case of letters.
STAMPS = ("archived_at", "retention_expires_at", "legal_hold", "checksum", "expiry_month")


def retention_days(text: Column) -> Column:
    """Days in a period such as 30d, 6M or 1y; anything else fails the query."""
    number = F.regexp_extract(text, PERIOD_PATTERN, 1)
    unit = F.lower(F.regexp_extract(text, PERIOD_PATTERN, 2))
    days = F.lit(None).cast("int")
    for name, size in UNIT_DAYS.items():
        days = F.when(unit == name, number.try_cast("int") * F.lit(size)).otherwise(days)
    return F.when(days.isNotNull(), days).otherwise(
        F.raise_error(F.concat(F.lit("unsupported retention period: "), F.coalesce(text, F.lit("NULL"))))
        .cast("int")
    )


def retention_interval(text: Column) -> Column:
    return F.make_dt_interval(retention_days(text))


def as_timestamp(as_of: datetime | date | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def stamp_retention(
    df: DataFrame,
    policy: str,
    legal_hold: bool | Column,
    as_of: datetime | date | str,
    basis: str | Column | None = None,
) -> DataFrame:
    """Add archived_at, retention_expires_at and legal_hold.

    The period runs from `as_of`, or per row from `basis`, which lets one table expire gradually.
    """
    archived = as_timestamp(as_of)
    start = archived if basis is None else (F.col(basis) if isinstance(basis, str) else basis)
    hold = legal_hold if isinstance(legal_hold, Column) else F.lit(legal_hold)
    taken = {c.lower() for c in df.columns} & {c.lower() for c in STAMPS}
    if taken:
        raise ValueError(f"source columns have the names of archive columns: {sorted(taken)}")
    return df.withColumns(
        {
            "archived_at": archived,
            "retention_expires_at": start.cast("timestamp") + retention_interval(F.lit(policy)),
            "legal_hold": hold.cast("boolean"),
        }
    )


def expiry_month(expires: Column) -> Column:
    """Months since year 0 as a number: compares rightly for years of any length."""
    return F.year(expires) * 12 + F.month(expires) - 1


def expired(as_of: datetime | date | str) -> Column:
    """Past retention and not held. Strictly before midnight of `as_of`; NULLs protect the row."""
    midnight = F.date_trunc("day", as_timestamp(as_of))
    return F.coalesce(
        (F.col("retention_expires_at") < midnight) & (F.col("legal_hold") == F.lit(False)),
        F.lit(False),
    )


def expired_filter(as_of: datetime | date | str, columns: list[str]) -> Column:
    """The predicate in the shape a scan can push down, pruning partitions where there are any."""
    midnight = F.date_trunc("day", as_timestamp(as_of))
    where = (F.col("retention_expires_at") < midnight) & (F.col("legal_hold") == F.lit(False))
    if "expiry_month" in columns:
        where = (F.col("expiry_month") <= expiry_month(midnight)) & where
    return where
