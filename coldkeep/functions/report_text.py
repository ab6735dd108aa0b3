"""Text of the validation summary: rendering it, and reading older text back."""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The wording of the summary, shared by writer and reader.
SCHEMA_REPORT = "schema_validation"
COUNT_REPORT = "row_count_validation"
ROW_REPORT = "row_checksum_validation"
COLUMN_REPORT = "column_checksum_validation"
PASSED, FAILED = "passed", "failed"
GOOD_STATES = ("PASSED", "SUCCEEDED")
BAD_STATES = ("FAILED", "ERROR")

COUNT_PATTERN = r"source_table_count: (\d+), target_table_count: (\d+)"
COLUMNS_PATTERN = r"source_columns: \[(.*?)\], target_columns: \[(.*?)\]"
VALIDATED_PATTERN = r"row checksums validated: (\d+)"
MISMATCH_PATTERN = r"Mismatched checksums: (\d+) rows \(([\d.]+)%\)"
RECORDS_PATTERN = r"(?s)Records:\s*(\[.*\])"
SOURCE_CHECKSUMS_PATTERN = r"source_column_checksum: \[(.*?)\]"
TARGET_CHECKSUMS_PATTERN = r"target_column_checksum: \[(.*?)\]"


def duration_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def duration_text(start: Column, end: Column) -> Column:
    seconds = duration_seconds(start, end)
    return F.format_string("%dm %ds", F.floor(seconds / 60).cast("bigint"), F.pmod(seconds, F.lit(60)))


def severity(result: Column) -> Column:
    state = F.upper(result)
    return (
        F.when(state.isin(*GOOD_STATES), F.lit("good"))
        .when(state.isin(*BAD_STATES), F.lit("bad"))
        .otherwise(F.lit("neutral"))
    )


def verdict_text(ok: Column) -> Column:
    return F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED))


def quoted_list(names: Column) -> Column:
    quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
    return F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))


def checksum_list(entries: Column, field: str) -> Column:
    texts = F.transform(entries, lambda e: F.concat(e["column"], F.lit(": "), e[field].cast("string")))
    return F.concat(F.lit("["), F.concat_ws(", ", texts), F.lit("]"))


def render_summary(df: DataFrame) -> DataFrame:
    """Add `value` and `remarks` to the structured summary rows."""
    report, failed = F.col("validation_report"), F.col("result") == FAILED
    counts = F.format_string(
        "source_table_count: %d, target_table_count: %d", "source_count", "target_count"
    )
    columns = F.concat(
        F.lit("source_columns: "),
        quoted_list(F.col("source_columns")),
        F.lit(", target_columns: "),
        quoted_list(F.col("target_columns")),
    )
    checksums = F.concat(
        F.lit("source_column_checksum: "),
        checksum_list(F.col("checksums"), "source"),
        F.lit(", target_column_checksum: "),
        checksum_list(F.col("checksums"), "target"),
    )
    names = F.concat(F.lit("Mismatched columns: "), F.concat_ws(", ", "mismatched_columns"))
    rows = F.concat(
        F.format_string("Mismatched checksums: %d rows (", "mismatch_count"),
        F.col("mismatch_percent").cast("string"),
        F.lit("%). Records: "),
        F.col("records_at"),
    )
    return df.withColumns(
        {
            "value": F.when(report == SCHEMA_REPORT, columns)
            .when(report == COUNT_REPORT, counts)
            .when(report == ROW_REPORT, F.format_string("row checksums validated: %d", "source_count"))
            .when(report == COLUMN_REPORT, checksums),
            "remarks": F.when((report == SCHEMA_REPORT) & failed, names)
            .when(
                (report == COUNT_REPORT) & failed,
                F.format_string("Mismatched row count. Difference: %d", "difference"),
            )
            .when((report == ROW_REPORT) & failed, rows)
            .when(report == COLUMN_REPORT, F.when(failed, names).otherwise(F.lit("Passed")))
            .otherwise(F.lit("")),
        }
    )


def _number(text: Column, pattern: str, group: int, data_type: str) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found).cast(data_type)


def parse_legacy_counts(df: DataFrame) -> DataFrame:
    """Numbers from the text columns of summaries that carry nothing else."""
    value, remarks = F.col("value"), F.col("remarks")
    return df.withColumns(
        {
            "source_count": _number(value, COUNT_PATTERN, 1, "bigint"),
            "target_count": _number(value, COUNT_PATTERN, 2, "bigint"),
            "validated_count": _number(value, VALIDATED_PATTERN, 1, "bigint"),
            "mismatch_count": _number(remarks, MISMATCH_PATTERN, 1, "bigint"),
            "mismatch_percent": _number(remarks, MISMATCH_PATTERN, 2, "double"),
        }
    )


def _names(text: Column, group: int) -> Column:
    listed = F.regexp_extract(text, COLUMNS_PATTERN, group)
    names = F.transform(F.split(listed, ","), lambda n: F.trim(n, F.lit("' ")))
    return F.filter(names, lambda n: n != "")


def _checksum_map(text: Column, pattern: str) -> Column:
    items = F.filter(F.split(F.regexp_extract(text, pattern, 1), ", "), lambda i: i.contains(":"))
    return F.map_from_entries(
        F.transform(
            items,
            lambda i: F.struct(
                F.trim(F.substring_index(i, ":", 1)), F.trim(F.regexp_extract(i, r":(.*)$", 1))
            ),
        )
    )


def parse_legacy_columns(df: DataFrame) -> DataFrame:
    """Column lists and checksum maps from the text of older summaries."""
    value = F.col("value")
    return df.withColumns(
        {
            "source_columns": _names(value, 1),
            "target_columns": _names(value, 2),
            "source_checksums": _checksum_map(value, SOURCE_CHECKSUMS_PATTERN),
            "target_checksums": _checksum_map(value, TARGET_CHECKSUMS_PATTERN),
        }
    )


LEGACY_PAIRS = (
    "array<struct<rank: bigint, source: map<string, string>, source_checksum: string, "
    "target: map<string, string>, target_checksum: string>>"
)
#: JSON has other names for these than Python, or means another thing by them.
NO_LITERAL = re.compile(r"\\|null|true|false|NaN|Infinity")


def _literal(text: str) -> object:
    """The value of a literal; one that reads the same as JSON is read as that, which is much faster."""
    if not NO_LITERAL.search(text):
        try:
            return json.loads(text)
        except (ValueError, RecursionError):
            pass
    return ast.literal_eval(text)


def _pair_list(text: str | None) -> str | None:
    """The list of records as JSON, two neighbours as one pair; a text that is no such list has none."""
    pairs: list[dict] = []
    try:
        at = 0
        for found in _literal(text) if text else []:
            for side in ("source", "target"):
                if f"{side}_row" in found:
                    row = found[f"{side}_row"]
                    if at % 2 == 0:
                        pairs.append({"rank": at // 2 + 1})
                    pairs[-1][side] = {str(k): str(v) for k, v in row.get("record", {}).items()}
                    pairs[-1][f"{side}_checksum"] = str(row.get("checksum", ""))
                    at += 1
    except (ValueError, SyntaxError, TypeError, AttributeError, MemoryError, RecursionError):
        return None
    return json.dumps(pairs)


def legacy_pair_list(remarks: Column) -> Column:
    """Pairs of mismatched rows in the text of older summaries, which list their records as literals."""

    @F.pandas_udf("string")
    def as_json(texts: pd.Series) -> pd.Series:
        return texts.map(_pair_list)

    return F.from_json(as_json(F.regexp_extract(remarks, RECORDS_PATTERN, 1)), LEGACY_PAIRS)
