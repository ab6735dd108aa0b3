"""Validation of an archive against its source: four verdicts and the differences behind them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from coldkeep.functions.blobs import LINK_SUFFIX, binary_columns
from coldkeep.functions.checksums import METADATA_COLUMNS
from coldkeep.functions.normalize import normalize_names
from coldkeep.functions.report_text import (
    COLUMN_REPORT,
    COUNT_REPORT,
    FAILED,
    PASSED,
    ROW_REPORT,
    SCHEMA_REPORT,
    render_summary,
)
from coldkeep.operators import compare
from coldkeep.plans.report import JOB, VALIDATE_JOB, job_args, savable_pairs
from coldkeep.session import in_parallel, staged
from coldkeep.sinks.documents import write_summary
from coldkeep.sources.connections import Connection, connection_of
from coldkeep.sources.tables import read_source

NUMBERS = {
    "validation_report": "string",
    "result": "string",
    "source_count": "bigint",
    "target_count": "bigint",
    "difference": "bigint",
    "mismatch_count": "bigint",
    "mismatch_percent": "double",
    "mismatched_columns": "array<string>",
    "source_columns": "array<string>",
    "target_columns": "array<string>",
    "checksums": "array<struct<column: string, source: string, target: string>>",
    "records_at": "string",
}


@dataclass(frozen=True)
class Validation:
    summary: DataFrame
    schema: DataFrame
    columns: DataFrame
    rows: DataFrame
    pairs: DataFrame
    key: tuple[str, ...] = ()


def validate(
    src: DataFrame,
    tgt: DataFrame,
    metadata_cols: Sequence[str] = METADATA_COLUMNS,
    key: Sequence[str] | None = None,
    mode: str = "lenient",
    source_table: str = "source",
    target_table: str = "target",
    buckets: int = compare.BUCKETS,
    records_at: str | None = None,
) -> Validation:
    """Compare a source with its archive.

    Each side is read once, whatever the number of columns; only rows of buckets that differ are
    read again, after these were split until few other rows lie in them. Counts and checksums live
    in a small staged table that all checks share.
    The summary names the place of the differing rows, `records_at`, and holds none of them.
    """
    spark = src.sparkSession
    src, tgt = normalize_names(src), normalize_names(tgt)
    # One link for each binary column of the source; any other extra column is a difference.
    links = [f"{c}{LINK_SUFFIX}" for c in binary_columns(src)]
    common, src_only, tgt_only = compare.compare_columns(src, tgt, [*metadata_cols, *links])
    src, tgt = (df.select(*[f"`{c}`" for c in common]) for df in (src, tgt))

    stats = staged(compare.side_stats(src, tgt, common, mode, buckets), "stats")
    found = compare.suspects(stats, buckets)
    found = compare.narrowed(src, tgt, common, found, mode)
    diff = compare.row_diff(src, tgt, common, found, mode)
    if found.n_buckets:
        diff = staged(diff, "rows")

    # One row per column.
    sums = compare.stats_checksums(stats, common)
    checksums = sums.collect()
    columns = spark.createDataFrame(checksums, sums.schema)
    mismatched = [r["column"] for r in checksums if r["result"] != PASSED]
    records = compare.mismatch_records(diff, common, mismatched)

    schema = compare.schema_diff(spark, common + src_only, common + tgt_only)
    counts = compare.stats_counts(stats).head().asDict()
    summary = spark.createDataFrame(
        [
            _row(SCHEMA_REPORT, compare.schema_check(schema).head().asDict()),
            _row(COUNT_REPORT, counts),
            _row(
                ROW_REPORT,
                compare.row_check(diff, counts["source_count"]).head().asDict()
                | {"records_at": records_at or "Validation.rows"},
            ),
            _row(
                COLUMN_REPORT,
                {
                    "result": FAILED if mismatched else PASSED,
                    "mismatched_columns": mismatched,
                    "checksums": [r[:3] for r in checksums],
                },
            ),
        ],
        ", ".join(f"{name} {kind}" for name, kind in NUMBERS.items()),
    )
    named = summary.withColumns(
        {"source_table": F.lit(source_table), "target_table": F.lit(target_table)}
    )
    texts = ["validation_report", "source_table", "target_table", "result"]
    rendered = render_summary(named.select(*texts, *[c for c in summary.columns if c not in texts]))
    pairs = compare.pair_mismatches(diff, common, list(key or []))
    return Validation(rendered, schema, columns, records, pairs, tuple(key or ()))


def _row(report: str, numbers: dict) -> tuple:
    """The numbers of one check in the order of the summary's columns."""
    return tuple({**numbers, "validation_report": report}.get(n) for n in NUMBERS)


def verdict(summary: DataFrame) -> DataFrame:
    """One row per archived table: did all of its checks pass?"""
    return summary.groupBy("source_table", "target_table").agg(
        F.bool_and(F.col("result") == PASSED).alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
    )


def validate_archive(
    spark: SparkSession,
    source: DataFrame,
    archive_name: str,
    key: Sequence[str] | None = None,
    mode: str = "lenient",
    source_table: str = "source",
    target_table: str | None = None,
    stage_source: bool = False,
    condition: str | None = None,
    records_at: str | None = None,
) -> Validation:
    """Validate a table of the archive; `stage_source` reads a remote database only once.

    With the condition of the source only the archive's rows that meet it are compared: an archive
    that was appended to holds rows of other conditions as well.
    """
    src = staged(source, "source") if stage_source else source
    archived = spark.table(archive_name)
    return validate(
        src,
        archived.filter(condition) if condition else archived,
        records_at=records_at,
        key=key,
        mode=mode,
        source_table=source_table,
        target_table=target_table or archive_name,
    )


RUN = f"{JOB}, error string"


def validate_many(
    spark: SparkSession,
    plan: DataFrame,
    conn: Connection | Mapping[str, Connection],
    report_root: str,
    max_parallel: int = 2,
    **options,
) -> DataFrame:
    """Validate every row of an archived plan; one run row each.

    Saves the summary, all differing rows and their mismatched pairs, these in a form that tables
    share, so that one report reads those of all. A query is run on the source
    again and compared with its archived result. Each row is read from the connection it names.
    """

    def run(item: Row) -> tuple:
        started = datetime.now(timezone.utc)
        p = item.asDict()
        target = f"{p['target_db']}.{p['target_table']}"
        table = f"{p['source_schema']}.{p['source_table']}" if p["source_table"] else None
        try:
            of_row = connection_of(conn, p["connection"])
            source = read_source(
                spark, of_row, table=table, query=p["query"], condition=p["condition"]
            )
            folder = f"{report_root.rstrip('/')}/{p['target_db']}/{p['target_table']}"
            result = validate_archive(
                spark,
                source,
                target.lower(),
                source_table=table or p["source_schema"],
                target_table=target,
                stage_source=of_row.kind != "catalog",
                condition=p["condition"] if not p["query"] else None,
                records_at=f"{folder}/mismatch_records",
                **options,
            )
            write_summary(result.summary, f"{folder}/validation_summary")
            result.rows.write.mode("overwrite").parquet(f"{folder}/mismatch_records")
            pairs = savable_pairs(result.pairs, target, result.key)
            pairs.write.mode("overwrite").parquet(f"{folder}/mismatch_pairs")
            status, error = "SUCCEEDED", None
        except Exception as failure:
            status, error = "FAILED", str(failure)
        ended = datetime.now(timezone.utc)
        return (VALIDATE_JOB, uuid.uuid4().hex, status, started, ended, job_args(item), error)

    # One row per archived table.
    return spark.createDataFrame(in_parallel(spark, run, plan.collect(), max_parallel), RUN)
