"""Comparison of two relations by their normalised values.

Differences are found without sorting or collecting whole columns:

* `side_stats` reads both sides once and keeps, per bucket of rows, the row count and the sums of
  the row and column hashes. Its size depends on the number of buckets, not on the data.
* A bucket whose count and row sum agree holds the same multiset of rows on both sides. The others
  are split by further bits of the same hash (`narrowed`), as often as it takes until the suspect
  rows are few: a tree of sums of which only differing branches are followed.
* `row_diff` sends hashes of 128 bits and counts of copies over the network. Text is made and
  grouped only for the rows whose hashes differ in number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coldkeep.functions.checksums import (
    PARTS,
    combine_parts,
    compare_checksum,
    part_sums,
)
from coldkeep.functions.normalize import normalize_values, value_key
from coldkeep.functions.report_text import verdict_text
from coldkeep.operators.ranking import rank_within
from coldkeep.session import staged

BUCKETS = 4096
#: A level of the tree of sums splits a bucket by so many bits at most.
LEVEL_BITS = 14
#: Rows of both sides that a leaf holds on average.
LEAF_ROWS = 2
#: Suspect rows, of all rows, that may be read again without splitting their buckets further.
SUSPECT_SHARE = 0.05
#: So few suspect rows are read again whatever their share: another level would cost more.
FEW_ROWS = 1_000_000
#: Suspect buckets or unequal hashes that are sent to every task; more are joined.
MOST_BROADCAST = 2_000_000
SOURCE, TARGET = "source", "target"


def _cols(names: Sequence[str]) -> list:
    return [F.col(f"`{n}`") for n in names]


def compare_columns(
    src: DataFrame, tgt: DataFrame, metadata: Sequence[str]
) -> tuple[list[str], list[str], list[str]]:
    """(columns on both sides, source-only, target-only); declared metadata columns are set aside."""
    ours, theirs = src.columns, [c for c in tgt.columns if c not in metadata or c in src.columns]
    common = [c for c in ours if c in theirs]
    return common, [c for c in ours if c not in theirs], [c for c in theirs if c not in ours]


def schema_diff(spark: SparkSession, src_cols: Sequence[str], tgt_cols: Sequence[str]) -> DataFrame:
    """(column, in_source, in_target, result), ordered by column."""

    def names(cols: Sequence[str], flag: str) -> DataFrame:
        rows = [(c, True) for c in cols]
        return spark.createDataFrame(rows, f"column string, {flag} boolean")

    both = names(src_cols, "in_source").join(names(tgt_cols, "in_target"), "column", "full_outer")
    both = both.fillna(False, ["in_source", "in_target"])
    return both.withColumn(
        "result", verdict_text(F.col("in_source") & F.col("in_target"))
    ).orderBy("column")


def schema_check(diff: DataFrame) -> DataFrame:
    """One row: sorted column lists per side, the difference and the verdict."""

    def listed(condition) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.col("column"))))

    return diff.agg(
        listed(F.col("in_source")).alias("source_columns"),
        listed(F.col("in_target")).alias("target_columns"),
        listed(F.col("in_source") != F.col("in_target")).alias("mismatched_columns"),
    ).withColumn("result", verdict_text(F.size("mismatched_columns") == 0))


def _tagged(src: DataFrame, tgt: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Both sides in one relation; n_src and n_tgt are 1 or 0."""
    ours = src.select(*_cols(cols), F.lit(1).alias("n_src"), F.lit(0).alias("n_tgt"))
    theirs = tgt.select(*_cols(cols), F.lit(0).alias("n_src"), F.lit(1).alias("n_tgt"))
    return ours.unionByName(theirs)


def row_count_check(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """One row: counts of both sides, their distance and the verdict."""
    sides = src.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        tgt.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_count"),
    )
    distance = F.abs(F.col("source_count") - F.col("target_count"))
    return counts.withColumn("difference", distance).withColumn(
        "result", verdict_text(F.col("difference") == 0)
    )


def _key_hashes(
    df: DataFrame, other: DataFrame, cols: Sequence[str], mode: str | None, seed: str | None = None
) -> list:
    """One hash per column; equal where the normalised values are."""
    first = [] if seed is None else [F.lit(seed)]
    if mode is None:
        return [F.xxhash64(*first, f"`{c}`") for c in cols]
    ours, theirs = df.schema, other.schema
    return [
        F.xxhash64(*first, value_key(c, ours[c].dataType, theirs[c].dataType, mode)) for c in cols
    ]


def _bits(buckets: int) -> int:
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError(f"the number of buckets must be a power of two: {buckets}")
    return buckets.bit_length() - 1


def _place(hashes: Sequence[Column]) -> Column:
    """A row's place in the tree of buckets, whose first bits are its bucket.

    Another hash than the one summed up, so that it takes no bits away from the sums.
    """
    return F.xxhash64(F.lit(SOURCE), *hashes)


def _branch(place: Column, bits: int) -> Column:
    return F.shiftrightunsigned(place, 64 - bits) if bits else F.lit(0).cast("bigint")


def side_stats(
    src: DataFrame,
    tgt: DataFrame,
    cols: Sequence[str],
    mode: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per (side, bucket): row count, sums of the row hash and of each column's value hash.

    One pass over each side and at most 2 * buckets result rows. With `mode` the columns are raw
    and compared as if normalised that way; without, they are normalised text already.
    """
    names, bits = [f"h{i}" for i in range(len(cols))], _bits(buckets)

    def hashed(df: DataFrame, other: DataFrame, side: str) -> DataFrame:
        hashes = _key_hashes(df, other, cols, mode)
        keyed = df.select(*[h.alias(n) for n, h in zip(names, hashes)])
        row = F.xxhash64(*names)
        bucket = _branch(_place([F.col(n) for n in names]), bits)
        return keyed.select(
            F.lit(side).alias("side"), bucket.alias("bucket"), row.alias("h"), *names
        )

    sums = [s for i, n in enumerate(names) for s in part_sums(f"c{i}", F.col(n))]
    both = hashed(src, tgt, SOURCE).unionByName(hashed(tgt, src, TARGET))
    return both.groupBy("side", "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), *part_sums("row", F.col("h")), *sums
    )


def stats_counts(stats: DataFrame) -> DataFrame:
    """One row of source and target counts, verdict included, from `side_stats`."""
    n = F.col("n_rows")
    counts = stats.agg(
        F.coalesce(F.sum(F.when(F.col("side") == SOURCE, n)), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum(F.when(F.col("side") == TARGET, n)), F.lit(0)).alias("target_count"),
    )
    distance = F.abs(F.col("source_count") - F.col("target_count"))
    return counts.withColumn("difference", distance).withColumn(
        "result", verdict_text(F.col("difference") == 0)
    )


def stats_checksums(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, source, target, result) from `side_stats`, ordered by column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"c{i}_{p}").alias(p) for p in PARTS])
        for i, c in enumerate(cols)
    ]
    long = stats.select("side", "n_rows", F.inline(F.array(*entries)))

    def total(side: str, part: str) -> Column:
        value = F.when(F.col("side") == side, F.col(part).cast("decimal(38,0)"))
        return F.sum(value).alias(f"{side}_{part}")

    totals = long.groupBy("column").agg(
        *[total(side, part) for side in (SOURCE, TARGET) for part in ("n_rows", *PARTS)]
    )

    def text(side: str) -> Column:
        n_rows = F.coalesce(F.col(f"{side}_n_rows"), F.lit(0)).cast("bigint")
        return F.concat_ws("-", n_rows, combine_parts(side)).alias(side)

    return _judged(totals.select("column", text(SOURCE), text(TARGET)))


def _judged(checksums: DataFrame) -> DataFrame:
    same = verdict_text(F.col(SOURCE) == F.col(TARGET))
    return checksums.withColumn("result", same).orderBy("column")


def column_checksum_diff(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """(column, source, target, result) from two `column_checksum` results; a missing side is N/A."""

    def texts(df: DataFrame, name: str) -> DataFrame:
        return df.select("column", F.concat_ws("-", "n_rows", "checksum").alias(name))

    both = texts(src, SOURCE).join(texts(tgt, TARGET), "column", "full_outer")
    return _judged(both.fillna("N/A", [SOURCE, TARGET]))


def _differing(stats: DataFrame) -> DataFrame:
    """(bucket, n_rows, differs) from `side_stats`."""
    signed = F.when(F.col("side") == SOURCE, 1).otherwise(-1)

    def gap(value) -> Column:
        return F.sum(value * signed) != 0

    differs = gap(F.col("n_rows").cast("decimal(38,0)")) | gap(combine_parts("row"))
    return stats.groupBy("bucket").agg(F.sum("n_rows").alias("n_rows"), differs.alias("differs"))


def suspect_buckets(stats: DataFrame) -> DataFrame:
    """Buckets whose rows differ between the sides; never more than the bucket count."""
    return _differing(stats).filter("differs").select("bucket")


@dataclass(frozen=True)
class Suspects:
    """Buckets that differ, at one depth of the tree, and the rows of both sides in them."""

    buckets: DataFrame
    bits: int
    n_buckets: int
    n_rows: int
    all_rows: int

    def of(self, df: DataFrame, place: Column) -> DataFrame:
        """The rows of `df` whose place lies in a suspect bucket."""
        # Sent to every task only where their counted number is small.
        own = self.buckets.select(F.col("bucket").alias("_bucket"))
        own = F.broadcast(own) if self.n_buckets <= MOST_BROADCAST else own
        return df.withColumn("_bucket", _branch(place, self.bits)).join(own, "_bucket", "left_semi").drop("_bucket")


def suspects(stats: DataFrame, buckets: int = BUCKETS) -> Suspects:
    """The differing buckets of `side_stats`, counted."""
    found = staged(_differing(stats), "suspects")
    bad = F.col("differs")
    n = found.agg(
        F.count_if(bad).alias("n_buckets"),
        F.coalesce(F.sum(F.when(bad, F.col("n_rows"))), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("all_rows"),
    ).head()
    return Suspects(found.filter("differs").select("bucket"), _bits(buckets), *n)


def narrowed(
    src: DataFrame,
    tgt: DataFrame,
    cols: Sequence[str],
    found: Suspects,
    mode: str | None = None,
    few_rows: int = FEW_ROWS,
) -> Suspects:
    """Split the suspect buckets until their rows are few, a small share of all, or lie in leaves.

    The places and hashes of the suspect rows, two numbers for each, are staged once; every level
    sums them up by more bits of the place and goes on with the branches that differ.
    """
    rows = None
    while found.n_rows > max(few_rows, SUSPECT_SHARE * found.all_rows) and found.bits < 60:
        excess = found.n_rows // (LEAF_ROWS * found.n_buckets)
        if excess < 2:
            break
        bits = min(found.bits + min(LEVEL_BITS, excess.bit_length()), 60)
        if rows is None:
            rows = _places(src, tgt, cols, mode)
        rows = staged(found.of(rows, F.col("place")), "places")
        level = rows.groupBy("sign", _branch(F.col("place"), bits).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n_rows"), *part_sums("row", F.col("h"))
        )
        side = F.when(F.col("sign") > 0, F.lit(SOURCE)).otherwise(F.lit(TARGET))
        split = suspects(level.withColumn("side", side), 1 << bits)
        found = Suspects(split.buckets, bits, split.n_buckets, split.n_rows, found.all_rows)
    return found


def _places(src: DataFrame, tgt: DataFrame, cols: Sequence[str], mode: str | None) -> DataFrame:
    """(sign, place, h) of every row of both sides."""

    def side(df: DataFrame, other: DataFrame, sign: int) -> DataFrame:
        hashes = _key_hashes(df, other, cols, mode)
        return df.select(F.lit(sign).alias("sign"), _place(hashes).alias("place"), F.xxhash64(*hashes).alias("h"))

    return side(src, tgt, 1).unionByName(side(tgt, src, -1))


def _wide_hash(df: DataFrame, other: DataFrame, cols: Sequence[str], mode: str | None) -> list[Column]:
    """128 bits of a row: two hashes with different seeds over each value, then over the row."""
    plain, seeded = _key_hashes(df, other, cols, mode), _key_hashes(df, other, cols, mode, seed=TARGET)
    return [F.xxhash64(*plain).alias("_h1"), F.xxhash64(F.lit(TARGET), *seeded).alias("_h2")]


def hash_diff(src: DataFrame, tgt: DataFrame, cols: Sequence[str], mode: str | None = None) -> DataFrame:
    """Row hashes (_h1, _h2) that occur unequally often, with their copies on both sides.

    Hashes and counts are all that is exchanged; copies are counted before.
    """

    def side(df: DataFrame, other: DataFrame, n_src: int) -> DataFrame:
        counts = (F.lit(n_src).alias("n_src"), F.lit(1 - n_src).alias("n_tgt"))
        return df.select(*_wide_hash(df, other, cols, mode), *counts)

    counted = side(src, tgt, 1).unionByName(side(tgt, src, 0)).groupBy("_h1", "_h2")
    sums = counted.agg(F.sum("n_src").alias("n_src"), F.sum("n_tgt").alias("n_tgt"))
    return sums.filter("n_src <> n_tgt")


def row_diff(
    src: DataFrame,
    tgt: DataFrame,
    cols: Sequence[str],
    suspects: Suspects | None = None,
    mode: str | None = None,
) -> DataFrame:
    """Distinct rows that occur more often on one side: the normalised columns, n_src and n_tgt.

    Copies are counted before the shuffle, so one row repeated a billion times costs one row per
    task. With `suspects`, found in the same mode, only rows of their buckets are read again; where
    there are none, nothing is. Without, `hash_diff` finds the hashes that differ first (at once: they
    are staged and counted); joined back, they let only their own rows through. Text tells rows of one
    hash apart in both cases.
    """
    unequal = None
    if suspects is None:
        unequal = staged(hash_diff(src, tgt, cols, mode).select("_h1", "_h2"), "unequal")
        n_unequal = unequal.count()
        unequal = F.broadcast(unequal) if n_unequal <= MOST_BROADCAST else unequal
    if not (suspects.n_buckets if suspects else n_unequal):
        return _empty_diff(src, cols)

    def side(df: DataFrame, other: DataFrame) -> DataFrame:
        if suspects is not None:
            kept = suspects.of(df.select(*_cols(cols)), _place(_key_hashes(df, other, cols, mode)))
            return kept if mode is None else normalize_values(kept, mode=mode)
        hashed = df.select(*_cols(cols), *_wide_hash(df, other, cols, mode))
        return hashed if mode is None else normalize_values(hashed, ignore=("_h1", "_h2"), mode=mode)

    hashes = [] if unequal is None else ["_h1", "_h2"]
    both = _tagged(side(src, tgt), side(tgt, src), [*cols, *hashes])
    if unequal is not None:
        both = both.join(unequal, hashes, "left_semi")
    counted = both.groupBy(*_cols(cols)).agg(F.sum("n_src").alias("n_src"), F.sum("n_tgt").alias("n_tgt"))
    return counted.filter("n_src <> n_tgt")


def _empty_diff(src: DataFrame, cols: Sequence[str]) -> DataFrame:
    names = [f"`{c}` string" for c in cols]
    return src.sparkSession.createDataFrame([], ", ".join([*names, "n_src bigint", "n_tgt bigint"]))


def rows_only_in(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of `a` that `b` does not have at all, with their number of copies in `a`."""
    only = row_diff(a, b, cols).filter("n_tgt = 0")
    return only.select(*_cols(cols), F.col("n_src").alias("copies"))


def row_totals(diff: DataFrame) -> DataFrame:
    """One row: how many rows lack a partner on either side, copies counted."""
    return diff.agg(
        F.coalesce(F.sum(F.greatest(F.col("n_src") - F.col("n_tgt"), F.lit(0))), F.lit(0)).alias(
            "source_only"
        ),
        F.coalesce(F.sum(F.greatest(F.col("n_tgt") - F.col("n_src"), F.lit(0))), F.lit(0)).alias(
            "target_only"
        ),
    )


def row_check(diff: DataFrame, source_count: int) -> DataFrame:
    """One row: mismatches, their share of the source rows in percent, and the verdict."""
    mismatches = F.greatest("source_only", "target_only")
    percent = F.round(100 * mismatches / F.lit(source_count or None), 2)
    return row_totals(diff).select(
        "source_only",
        "target_only",
        F.lit(source_count).cast("bigint").alias("source_count"),
        mismatches.alias("mismatch_count"),
        F.coalesce(percent, F.lit(0.0)).alias("mismatch_percent"),
        verdict_text(mismatches == 0).alias("result"),
    )


def checksum_sample(df: DataFrame, cols: Sequence[str], n: int = 100) -> DataFrame:
    """The n smallest row checksums, to look at."""
    return df.select(compare_checksum(cols).alias("row_checksum")).orderBy("row_checksum").limit(n)


def mismatch_records(
    diff: DataFrame, cols: Sequence[str], check_cols: Sequence[str] | None = None
) -> DataFrame:
    """(side, copies, record, row_checksum) of each differing row, in the order of the full row.

    `copies` is the surplus over the other side; the checksum is of the columns under suspicion.
    """
    surplus = F.col("n_src") - F.col("n_tgt")
    return diff.orderBy(*_cols(cols)).select(
        F.when(surplus > 0, F.lit(SOURCE)).otherwise(F.lit(TARGET)).alias("side"),
        F.abs(surplus).alias("copies"),
        F.struct(*_cols(cols)).alias("record"),
        compare_checksum(check_cols or cols).alias("row_checksum"),
    )


def pair_mismatches(
    diff: DataFrame, cols: Sequence[str], key: Sequence[str] = ()
) -> DataFrame:
    """Put each surplus source row next to a surplus target row of the same key.

    Several rows of one key are paired in checksum order, each at most once; without a key all
    rows are. A row without a partner stands alone.
    """
    rest = [c for c in cols if c not in key]
    rows = diff.withColumn("_digest", compare_checksum(cols))

    def side(condition: str, name: str) -> DataFrame:
        ranked = rank_within(rows.filter(condition), list(key), "_digest")
        return ranked.select(
            *_cols(key),
            F.col("rank"),
            F.struct(
                *_cols(rest),
                F.abs(F.col("n_src") - F.col("n_tgt")).alias("copies"),
                F.col("_digest").alias("row_checksum"),
            ).alias(name),
        )

    return side("n_src > n_tgt", SOURCE).join(
        side("n_tgt > n_src", TARGET), [*key, "rank"], "full_outer"
    )


def mismatch_values(pairs: DataFrame, cols: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    """One row per pair and column: source value next to target value."""
    rest = [c for c in cols if c not in key]
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(SOURCE)[c].alias("source_value"),
            F.col(TARGET)[c].alias("target_value"),
        )
        for c in rest
    ]
    return pairs.select(*_cols(key), "rank", F.inline(F.array(*entries)))
