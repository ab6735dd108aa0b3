"""JSON documents: rules, summaries, purge plans, the configuration registry."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE_RULE = (
    "struct<name: string, regex: boolean, condition: string, query: string, target_table: string>"
)
SOURCE_RULE = (
    "struct<name: string, connection: string, warehouse: string, retention_policy: string, "
    "legal_hold: boolean, consumer_roles: array<string>, "
    f"include: struct<schemas: array<struct<name: string, tables: array<{TABLE_RULE}>>>>, "
    "exclude: struct<tables: array<string>>>"
)
RULES = (
    "env string, connections map<string, string>, warehouses map<string, string>, "
    f"retention_policies map<string, string>, sources array<{SOURCE_RULE}>"
)
PURGE_TARGETS = (
    "targets array<struct<source_name: string, connection: string, max_parallel_tables: int>>"
)
SUMMARY = (
    "validation_report string, source_table string, target_table string, result string, "
    "value string, remarks string"
)
SUMMARY_NUMBERS = (
    "source_count bigint, target_count bigint, difference bigint, mismatch_count bigint, "
    "mismatch_percent double, mismatched_columns array<string>"
)
SUMMARY_LISTS = (
    "source_columns array<string>, target_columns array<string>, "
    "checksums array<struct<column: string, source: string, target: string>>, records_at string"
)
SAVED_PAIRS = (
    "target_table string, key map<string, string>, rank bigint, source map<string, string>, "
    "target map<string, string>, source_copies bigint, target_copies bigint, "
    "source_checksum string, target_checksum string"
)
PURGE_PLAN = (
    "source_name string, database string, table_name string, estimated_rows_to_delete bigint, "
    "as_of date, discovered_at timestamp"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document, unparsed, for checks that must see what was really written."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("document"))


def yaml_to_json(documents: DataFrame, column: str = "document") -> DataFrame:
    """Documents written in YAML as JSON text; needs PyYAML on the cluster."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        import yaml

        return texts.map(lambda text: json.dumps(yaml.safe_load(text), default=str))

    return documents.withColumn(column, convert(column))


def parse_rules(documents: DataFrame, column: str = "document", keep: Sequence[str] = ()) -> DataFrame:
    """The documents as typed columns, beside those to keep; a broken one has none of its parts."""
    return documents.select(*keep, F.from_json(column, RULES).alias("rules")).select(*keep, "rules.*")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RULES).option("multiLine", True).json(path)


def read_purge_targets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PURGE_TARGETS).option("multiLine", True).json(path)


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Summary rows of all JSON-lines files below a folder; broken lines are skipped.

    `seq` is the time the file was written, for `latest_by_type`. Numbers and lists are NULL in rows
    that older runs have saved as text alone.
    """
    schema = f"{SUMMARY}, {SUMMARY_NUMBERS}, {SUMMARY_LISTS}"
    rows = (
        spark.read.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(root)
    )
    return rows.select("*", F.col("_metadata.file_modification_time").alias("seq"))


def read_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Mismatched pairs that `validate_many` has saved below a folder, of all tables."""
    return spark.read.schema(SAVED_PAIRS).parquet(f"{root.rstrip('/')}/*/*/mismatch_pairs")


def read_purge_plan(spark: SparkSession, path: str, source_name: str) -> DataFrame:
    plan = spark.read.schema(PURGE_PLAN).json(path)
    return plan.filter(F.col("source_name") == source_name)


def latest_config(registrations: DataFrame) -> DataFrame:
    """Newest registration per source; the run id decides between equal dates."""
    rest = [c for c in registrations.columns if c != "source_name"]
    newest = F.max_by(F.struct(*rest), F.struct("archival_date", "dag_run_id"))
    return registrations.groupBy("source_name").agg(newest.alias("r")).select("source_name", "r.*")
