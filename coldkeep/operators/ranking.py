"""Ranks within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def rank_within(
    df: DataFrame, keys: Sequence[str], digest: str, rank: str = "rank", width: int = 3
) -> DataFrame:
    """Add the row number of `digest` (a hex text) within `keys`, smallest first.

    A group is cut by the first `width` digits of the digest, so a hot key is ranked by many
    tasks; each piece then starts after the pieces before it. Equals row_number over (keys order
    by digest).
    """
    piece = F.substring(digest, 1, width)
    pieced = df.withColumn("_piece", piece)
    ordered = Window.partitionBy(*keys, "_piece").orderBy(digest)
    local = pieced.withColumn("_local", F.row_number().over(ordered))

    # At most 16 ** width sizes per key.
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieced.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_piece").alias("_p"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    same = F.col("_piece") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(starts, same)
    return joined.withColumn(rank, F.col("_start") + F.col("_local")).select(*df.columns, rank)
