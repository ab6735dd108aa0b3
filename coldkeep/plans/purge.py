"""Purging: find what is past retention, save the finding, delete exactly that."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from coldkeep.functions.naming import archive_db
from coldkeep.functions.retention import as_timestamp, expired, expired_filter
from coldkeep.plans.archive import PARTITIONS
from coldkeep.session import in_parallel
from coldkeep.sinks.documents import write_purge_plan
from coldkeep.sinks.tables import (
    finish_replacing,
    is_row_level,
    partition_columns,
    replace_files,
    table_folder,
    write_archive,
)
from coldkeep.sources.documents import read_purge_plan
from coldkeep.sources.tables import columns_of, list_tables

NEEDED = ("retention_expires_at", "legal_hold")
DISCOVERY = (
    "database string, table_name string, status string, reason string, "
    "estimated_rows_to_delete bigint, as_of date, discovered_at timestamp"
)
RESULT = (
    "table string, status string, estimated_rows_deleted bigint, rows_deleted bigint, "
    "remaining_expired_rows bigint, error string, timestamp timestamp"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def expired_rows(spark: SparkSession, name: str, as_of: date | str) -> DataFrame:
    """One empty row for each expired one, to be counted.

    In a table partitioned by month and hold the months before the limit's are known to be past it:
    of their files no column is read, only the row counts in the footers. Rows of the month that the
    limit cuts through are looked at.
    """
    table = spark.table(name)
    past = expired_filter(as_of, table.columns)
    if is_row_level(spark, name) or set(partition_columns(spark, name)) != set(PARTITIONS):
        return table.filter(past).select()
    day = date.fromisoformat(str(as_of)[:10])
    limit, free = day.year * 12 + day.month - 1, ~F.col("legal_hold")
    gone = table.filter((F.col("expiry_month") < limit) & free).select()
    cut = table.filter((F.col("expiry_month") == limit) & free & past).select()
    return gone.unionByName(cut)


def expired_count(spark: SparkSession, name: str, as_of: date | str) -> int:
    return expired_rows(spark, name, as_of).count()


def discover_expired(
    spark: SparkSession, db: str, as_of: date | str, max_parallel: int = 5
) -> DataFrame:
    """One row per table of a database: how many rows are past retention and not on hold.

    status is found, clean, skipped (the table has no retention columns) or failed; one table's
    failure does not stop the others.
    """

    def check(table: str) -> tuple:
        name = f"{db}.{table}"
        try:
            if not set(NEEDED) <= set(columns_of(spark, name)):
                row = ("skipped", "no retention columns", None)
            else:
                n = expired_count(spark, name, as_of)
                row = ("found" if n else "clean", None, n)
        except Exception as error:
            row = ("failed", str(error), None)
        return (db, table, *row, date.fromisoformat(str(as_of)[:10]), _now())

    rows = in_parallel(spark, check, list_tables(spark, db), max_parallel)
    return spark.createDataFrame(rows, DISCOVERY)


def purge_plan(discovery: DataFrame, source_name: str) -> DataFrame:
    """The part of a discovery that there is something to delete for."""
    return discovery.filter("status = 'found'").select(
        F.lit(source_name).alias("source_name"),
        "database",
        "table_name",
        "estimated_rows_to_delete",
        "as_of",
        "discovered_at",
    )


def discovery_summary(discovery: DataFrame) -> DataFrame:
    return discovery.agg(
        F.count(F.lit(1)).alias("tables_scanned"),
        F.count_if(F.col("estimated_rows_to_delete") > 0).alias("tables_with_expired_rows"),
        F.coalesce(F.sum("estimated_rows_to_delete"), F.lit(0)).alias("total_estimated_deletes"),
    )


class MoreThanPlanned(ValueError):
    """A purge would delete more rows than its plan found."""


def _allow(n: int, at_most: int | None) -> None:
    if at_most is not None and n > at_most:
        raise MoreThanPlanned(f"{n} rows would be deleted, the plan found {at_most}; discover again")


def purge_table(
    spark: SparkSession, name: str, as_of: date | str, at_most: int | None = None
) -> int:
    """Delete rows of one table that are past retention and not held; returns how many.

    Nothing is changed if that were more than `at_most` rows.
    """
    day = date.fromisoformat(str(as_of)[:10])
    if at_most is not None:
        _allow(expired_count(spark, name, day), at_most)
    if is_row_level(spark, name):
        before = spark.table(name).count()
        spark.sql(
            f"DELETE FROM {name} WHERE retention_expires_at < TIMESTAMP '{day} 00:00:00' "
            "AND legal_hold = false"
        )
        return before - spark.table(name).count()
    if set(partition_columns(spark, name)) == set(PARTITIONS):
        return _purge_partitions(spark, name, day, at_most)
    if not partition_columns(spark, name):
        return _purge_files(spark, name, day)
    if not expired_count(spark, name, day):
        return 0
    before = spark.table(name).count()
    survivors = spark.table(name).filter(~expired(day))
    kept = write_archive(
        survivors, name, partition_by=partition_columns(spark, name), empty=True
    )
    return before - kept


def _purge_files(spark: SparkSession, name: str, day: date) -> int:
    """Rewrite the files that hold expired rows; all others stay as they are, name and time included.

    A run that was cut short is finished first.
    """
    finish_replacing(spark, name)
    table = spark.table(name)
    past = table.filter(expired_filter(day, table.columns))
    # One row for each file that is to be rewritten.
    found = past.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("past")).collect()
    if not found:
        return 0
    files = sorted(row["file"] for row in found)
    touched = spark.read.schema(table.schema).parquet(*files)
    before = touched.count()  # from the footers
    return before - replace_files(spark, name, files, touched.filter(~expired(day)))


def _purge_partitions(spark: SparkSession, name: str, day: date, at_most: int | None) -> int:
    """Drop unheld partitions of months gone by; rewrite the month that the limit cuts through.

    A partition is dropped only if its latest expiry lies before the limit, whatever month its name
    says, and if no expiry in it is unknown; this reads one column. Any other partition up to the
    limit's month is rewritten. Held partitions and later months are not touched. The catalog is changed in two steps, one for the dropped partitions and
    one for the rewritten one: a run cut short can simply be repeated.
    """
    limit = day.year * 12 + day.month - 1
    midnight = as_timestamp(day)
    free = spark.table(name).filter((F.col("expiry_month") <= limit) & ~F.col("legal_hold"))
    expires = F.col("retention_expires_at")
    # One row per month.
    months = free.groupBy("expiry_month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(expires < midnight, F.lit(False))).alias("past"),
    )
    months = {r["expiry_month"]: r for r in months.collect()}
    _allow(sum(r["past"] for r in months.values()), at_most)
    gone = [month for month, r in months.items() if r["past"] == r["rows"]]
    cut = [month for month, r in months.items() if 0 < r["past"] < r["rows"]]
    deleted = sum(months[month]["rows"] for month in gone)
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_free_partition, gone))}")
    for month in cut:
        folder = f"{table_folder(spark, name)}/{uuid.uuid4().hex}"
        rows = free.filter(F.col("expiry_month") == month)
        kept = rows.filter(~expired(day)).drop("expiry_month", "legal_hold")
        kept.write.parquet(folder)
        deleted += months[month]["rows"] - spark.read.schema(kept.schema).parquet(folder).count()
        spark.sql(f"ALTER TABLE {name} {_free_partition(month)} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return deleted


def _free_partition(month: int) -> str:
    return f"PARTITION (`expiry_month`={month}, `legal_hold`=false)"


def purge_many(
    spark: SparkSession, plan: DataFrame, max_parallel: int = 5, within_plan: bool = False
) -> DataFrame:
    """Purge the tables of a saved plan, several at a time, with the plan's own `as_of`.

    A failing table yields a row with its error; the others go on. `within_plan` fails a table,
    unchanged, if more rows would go than the plan found.
    """

    def purge(item: Row) -> tuple:
        name = f"{item['database']}.{item['table_name']}"
        try:
            deleted = purge_table(
                spark,
                name,
                item["as_of"],
                at_most=item["estimated_rows_to_delete"] if within_plan else None,
            )
            left = expired_count(spark, name, item["as_of"])
            row = ("success", item["estimated_rows_to_delete"], deleted, left, None)
        except Exception as error:
            row = ("failed", None, None, None, str(error))
        return (item["table_name"], *row, _now())

    # One row per table of a database.
    rows = in_parallel(spark, purge, plan.collect(), max_parallel)
    return spark.createDataFrame(rows, RESULT)


def purge_summary(results: DataFrame) -> DataFrame:
    """One row: tables processed, successes, failures, rows deleted and the overall status."""
    failed = F.count_if(F.col("status") == "failed")
    return results.agg(
        F.count(F.lit(1)).alias("tables_processed"),
        F.count_if(F.col("status") == "success").alias("successful_deletions"),
        failed.alias("failed_deletions"),
        F.coalesce(F.sum("rows_deleted"), F.lit(0)).alias("rows_deleted"),
        F.when(failed > 0, F.lit("completed_with_failures"))
        .otherwise(F.lit("completed"))
        .alias("status"),
    )


def run(spark: SparkSession, mode: str, db: str, source_name: str, path: str, **options):
    """Discovery saves a plan below `path`; delete carries a saved plan out and nothing else."""
    if mode == "discovery":
        found = discover_expired(spark, db, **options)
        write_purge_plan(purge_plan(found, source_name), path)
        return found
    if mode == "delete":
        saved = read_purge_plan(spark, path, source_name)
        return purge_many(spark, saved, within_plan=True, **options)
    raise ValueError(f"unknown mode: {mode!r}")


def run_targets(spark: SparkSession, mode: str, targets: DataFrame, path: str, **options) -> DataFrame:
    """`run` for every target of a purge document, each in the archive of its connection."""
    each = targets.select(F.explode("targets").alias("t")).select(
        "t.*", archive_db(F.col("t.connection")).alias("db")
    )
    done = None
    for target in each.collect():
        limit = {"max_parallel": target["max_parallel_tables"] or 5} if mode == "delete" else {}
        rows = run(spark, mode, target["db"], target["source_name"], path, **limit, **options)
        rows = rows.withColumn("source_name", F.lit(target["source_name"]))
        done = rows if done is None else done.unionByName(rows)
    if done is None:
        raise ValueError("no targets")
    return done
