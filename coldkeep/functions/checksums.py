"""Row checksums and order-free column fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from coldkeep.functions.normalize import fill_token

# Separators and null text inside the hashed row.
ARCHIVE_SEPARATOR = "||"
ARCHIVE_NULL = "NULL"
COMPARE_SEPARATOR = "|"

METADATA_COLUMNS = ("archived_at", "retention_expires_at", "legal_hold", "checksum", "expiry_month")

# A 64-bit hash is summed in three parts so that bigint sums cannot overflow below 2**41 rows.
_PART_BITS = 21
_PART_MASK = (1 << _PART_BITS) - 1
PARTS = ("lo", "mid", "hi")


def row_checksum(
    df: DataFrame, cols: Sequence[str] | None = None, include_metadata: bool = False
) -> Column:
    """md5 of an archived row. Stamps are left out unless asked for, so reruns agree."""
    if cols is None:
        cols = [c for c in df.columns if include_metadata or c not in METADATA_COLUMNS]
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(ARCHIVE_NULL)) for c in cols]
    return F.md5(F.concat_ws(ARCHIVE_SEPARATOR, *texts))


def compare_checksum(cols: Iterable[str]) -> Column:
    """md5 of a normalised row, over the columns under suspicion."""
    return F.md5(F.concat_ws(COMPARE_SEPARATOR, *[F.col(f"`{c}`") for c in cols]))


def value_hash(c: Column, algorithm: str = "xxhash64") -> Column:
    """xxhash64 is about ten times cheaper; md5 gives values any other engine can recompute."""
    if algorithm == "xxhash64":
        return F.xxhash64(c)
    if algorithm == "md5":
        return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash: {algorithm!r}")


def part_sums(name: str, h: Column) -> list[Column]:
    """Aggregates whose weighted total is the sum of the unsigned hash `h`."""
    return [
        F.sum(h.bitwiseAND(F.lit(_PART_MASK))).alias(f"{name}_lo"),
        F.sum(F.shiftrightunsigned(h, _PART_BITS).bitwiseAND(F.lit(_PART_MASK))).alias(f"{name}_mid"),
        F.sum(F.shiftrightunsigned(h, 2 * _PART_BITS)).alias(f"{name}_hi"),
    ]


def combine_parts(name: str) -> Column:
    """Exact decimal sum of the hash from its three part sums; 0 for no rows."""
    lo, mid, hi = (F.coalesce(F.col(f"`{name}_{p}`"), F.lit(0)).cast("decimal(38,0)") for p in PARTS)
    step = F.lit(1 << _PART_BITS).cast("decimal(8,0)")
    return ((hi * step + mid) * step + lo).cast("decimal(38,0)")


def column_checksum(
    df: DataFrame, cols: Sequence[str] | None = None, algorithm: str = "xxhash64"
) -> DataFrame:
    """(column, n_rows, checksum) for normalised columns, all in one aggregate.

    The checksum is the sum of the value hashes: it does not depend on row order, needs no sort
    and holds a few numbers per task, whatever the size of the table.
    """
    cols = list(cols or df.columns)
    hashed = df.select(
        *[value_hash(fill_token(F.col(f"`{c}`")), algorithm).alias(f"h{i}") for i, c in enumerate(cols)]
    )
    sums = [s for i in range(len(cols)) for s in part_sums(f"c{i}", F.col(f"h{i}"))]
    total = hashed.agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    entries = [
        F.struct(F.lit(c).alias("column"), combine_parts(f"c{i}").alias("checksum"))
        for i, c in enumerate(cols)
    ]
    return total.select("n_rows", F.inline(F.array(*entries))).select(
        "column", "n_rows", "checksum"
    )
