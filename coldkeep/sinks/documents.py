"""Summaries, purge plans and the configuration registry on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coldkeep.sources.documents import SUMMARY

SUMMARY_COLUMNS = [part.split()[0] for part in SUMMARY.split(", ")]


def write_summary(df: DataFrame, path: str) -> None:
    """A run's four rows: the text columns as CSV with header, everything as JSON lines."""
    root, four_rows = path.rstrip("/"), df.coalesce(1)
    text = four_rows.select(*SUMMARY_COLUMNS)
    text.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{root}/csv")
    four_rows.write.mode("overwrite").json(f"{root}/json")


def write_purge_plan(df: DataFrame, path: str) -> None:
    """Save a plan, replacing the earlier plan of the same sources only."""
    (
        df.write.mode("overwrite")
        .partitionBy("source_name")
        .option("partitionOverwriteMode", "dynamic")
        .json(path)
    )


def register_config(df: DataFrame, path: str) -> None:
    """Append registrations; `latest_config` picks the newest per source."""
    df.select("source_name", "env", "dag_run_id", "archival_date", "config").write.mode(
        "append"
    ).parquet(path)


def registrations(
    rules: DataFrame, dag_run_id: str, archival_date: str
) -> DataFrame:
    """One registration per source of a rules document."""
    return rules.select(
        F.explode("sources").alias("source"), F.coalesce("env", F.lit("dev")).alias("env"),
        F.to_json(F.struct(*rules.columns)).alias("config"),
    ).select(
        F.col("source.name").alias("source_name"),
        "env",
        F.lit(dag_run_id).alias("dag_run_id"),
        F.lit(archival_date).cast("timestamp").alias("archival_date"),
        "config",
    )
