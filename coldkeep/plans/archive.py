"""Archiving: source rows, blob links, retention stamps and row checksums into a table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from coldkeep.functions.blobs import binary_columns
from coldkeep.functions.checksums import row_checksum
from coldkeep.functions.retention import expiry_month, stamp_retention
from coldkeep.operators.blob_store import export_blobs, extract_blobs, write_blobs
from coldkeep.plans.report import ARCHIVE_JOB, JOB, job_args
from coldkeep.session import in_parallel
from coldkeep.sinks.tables import ensure_database, write_archive
from coldkeep.sources.connections import Connection, connection_of
from coldkeep.sources.tables import read_source

PARTITIONS = ("expiry_month", "legal_hold")


@dataclass(frozen=True)
class Archived:
    table: str
    rows: int
    blobs: int


def archive_rows(
    df: DataFrame,
    policy: str,
    legal_hold: bool | Column,
    as_of: datetime | date | str,
    basis: str | Column | None = None,
    blob_root: str | None = None,
    blob_path: tuple[str, str, str] = ("archive", "source", "table"),
) -> DataFrame:
    """The archived form of source rows: a single projection, without a shuffle."""
    sources = df.columns
    linked = extract_blobs(df, blob_root, *blob_path) if blob_root else df
    stamped = stamp_retention(linked, policy, legal_hold, as_of, basis)
    return stamped.withColumn("checksum", row_checksum(df, sources))


def dealt(
    df: DataFrame, policy: str, legal_hold: bool | Column, as_of: datetime | date | str, basis: str | Column
) -> DataFrame:
    """Source rows rebalanced by the partitions that they will have in the archive.

    Stamps and checksums are made behind this shuffle, so they do not pass through it.
    """
    stamped = stamp_retention(df, policy, legal_hold, as_of, basis)
    month = expiry_month(F.col("retention_expires_at")).alias("expiry_month")
    parted = stamped.select(*[f"`{c}`" for c in df.columns], month, "legal_hold")
    return parted.hint("rebalance", *PARTITIONS).drop(*PARTITIONS)


def archive(
    spark: SparkSession,
    plan_row: Row,
    conn: Connection,
    as_of: datetime | date | str,
    mode: str = "replace",
    basis: str | Column | None = None,
    export: bool = False,
) -> Archived:
    """Archive one row of the plan. A source without rows succeeds and creates no table.

    Tables are partitioned by expiry month and hold, so that a purge drops whole partitions. Rows
    of many months are rebalanced before the write; with one expiry for all there is no shuffle.
    Binary contents go to the blob store and, with `export`, also to the files the links name.
    """
    p = plan_row.asDict()
    name = f"{p['target_db']}.{p['target_table']}".lower()
    table = f"{p['source_schema']}.{p['source_table']}" if p["source_table"] else None
    df = read_source(spark, conn, table=table, query=p["query"], condition=p["condition"])
    # Binary contents become links before rows are shuffled.
    early = basis is not None and not binary_columns(df)
    if early:
        df = dealt(df, p["retention_policy_value"], p["legal_hold"], as_of, basis)
    rows = archive_rows(
        df,
        p["retention_policy_value"],
        p["legal_hold"],
        as_of,
        basis,
        blob_root=p["target_path"],
        blob_path=(p["target_db"], p["source_schema"], p["segment"]),
    )
    ensure_database(spark, p["target_db"])
    written = store(rows, name, mode, scattered=basis is not None and not early)
    blobs = 0
    if written and binary_columns(df):
        blobs = write_blobs(spark.table(name), p["target_db"])
        if export:
            export_blobs(spark.table(name), p["target_db"])
    return Archived(name, written, blobs)


RUN = f"{JOB}, rows bigint, blobs bigint, error string"


def archive_many(
    spark: SparkSession,
    plan: DataFrame,
    conn: Connection | Mapping[str, Connection],
    as_of: datetime | date | str,
    max_parallel: int = 2,
    **options,
) -> DataFrame:
    """Archive every row of a plan, a few at a time; one run row each, failures included.

    Each row is read from the connection it names. A row that its plan refuses fails with the reason.
    """

    def run(item: Row) -> tuple:
        started = datetime.now(timezone.utc)
        try:
            refused = item.asDict().get("refused")
            if refused:
                raise ValueError(f"refused by the plan: {refused}")
            done = archive(spark, item, connection_of(conn, item["connection"]), as_of, **options)
            status, row = "SUCCEEDED", (done.rows, done.blobs, None)
        except Exception as error:
            status, row = "FAILED", (None, None, str(error))
        ended = datetime.now(timezone.utc)
        return (ARCHIVE_JOB, uuid.uuid4().hex, status, started, ended, job_args(item), *row)

    # One row per table to archive.
    return spark.createDataFrame(in_parallel(spark, run, plan.collect(), max_parallel), RUN)


def store(rows: DataFrame, name: str, mode: str = "replace", scattered: bool = True) -> int:
    """Write archived rows, partitioned for the purge."""
    rows = rows.withColumn("expiry_month", expiry_month(F.col("retention_expires_at")))
    if scattered:
        rows = rows.hint("rebalance", *PARTITIONS)
    return write_archive(rows, name, mode, partition_by=PARTITIONS)
