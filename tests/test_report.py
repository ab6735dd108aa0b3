import pytest
from pyspark.sql import functions as F

from coldkeep.functions.naming import archive_segment, first_from_table
from coldkeep.functions.report_text import (
    duration_text,
    parse_legacy_columns,
    parse_legacy_counts,
    severity,
)
from coldkeep.plans.report import (
    JOB,
    checksum_rows,
    job_metadata,
    latest_by_type,
    legacy_pairs,
    mismatch_rows,
    report,
    savable_pairs,
    schema_rows,
)
from coldkeep.plans.validate import validate
from coldkeep.sinks.documents import write_summary
from coldkeep.sources.documents import SAVED_PAIRS, SUMMARY_LISTS, read_summaries


def one(spark, sql, column):
    return spark.sql(sql).select(column).head()[0]


@pytest.mark.parametrize("seconds,text", [(0, "0m 0s"), (59, "0m 59s"), (60, "1m 0s"), (3725, "62m 5s")])
def test_duration(spark, seconds, text):
    sql = f"SELECT TIMESTAMP '2024-01-01' a, TIMESTAMP '2024-01-01' + make_dt_interval(0,0,0,{seconds}) b"
    assert one(spark, sql, duration_text(F.col("a"), F.col("b"))) == text


def test_severity(spark):
    df = spark.createDataFrame([("passed",), ("Succeeded",), ("FAILED",), ("error",), ("RUNNING",)], "r string")
    assert [r[0] for r in df.select(severity(F.col("r"))).collect()] == ["good", "good", "bad", "bad", "neutral"]


@pytest.mark.parametrize(
    "sql,table",
    [
        ("SELECT * FROM S.FEED WHERE x", "S.FEED"),
        ("select a\n from\t s.feed_batch", "s.feed_batch"),
        ("SELECT 1", None),
        ("SELECT fromage FROM t1, t2", "t1"),
    ],
)
def test_first_from(spark, sql, table):
    df = spark.createDataFrame([(sql,)], "q string")
    assert df.select(first_from_table(F.col("q"))).head()[0] == table


def test_segment(spark):
    df = spark.createDataFrame([("FEED", None), (None, "SELECT 1"), ("", "SELECT 1")], "t string, q string")
    got = [r[0] for r in df.select(archive_segment(F.col("t"), F.col("q"))).collect()]
    assert got == ["feed", "query_31caf6d9", "query_31caf6d9"] or got[1] == got[2] != got[0]
    assert len(got[1]) == 14


def test_legacy_numbers(spark):
    df = spark.createDataFrame(
        [
            ("source_table_count: 10, target_table_count: 8", "Mismatched row count. Difference: 2"),
            ("row checksums validated: 7", "Mismatched checksums: 3 rows (42.86%). Records: [{'a': 1}]"),
            ("nothing", ""),
        ],
        "value string, remarks string",
    )
    rows = [
        (r.source_count, r.target_count, r.validated_count, r.mismatch_count, r.mismatch_percent)
        for r in parse_legacy_counts(df).collect()
    ]
    assert rows == [(10, 8, None, None, None), (None, None, 7, 3, 42.86), (None,) * 5]


def test_legacy_columns(spark):
    df = spark.createDataFrame(
        [
            ("source_columns: ['a', 'b'], target_columns: ['a']",),
            ("source_column_checksum: [a: 1, b: 2], target_column_checksum: [a: 1, c: x:y]",),
            ("source_column_checksum: [], target_column_checksum: []",),
        ],
        "value string",
    )
    a, b, c = parse_legacy_columns(df).collect()
    assert (a.source_columns, a.target_columns) == (["a", "b"], ["a"])
    assert (b.source_checksums, b.target_checksums) == ({"a": "1", "b": "2"}, {"a": "1", "c": "x:y"})
    assert c.source_checksums == {}


def test_column_lines(spark):
    df = spark.createDataFrame(
        [
            ("schema_validation", "t", "source_columns: ['a', 'b'], target_columns: ['a']"),
            ("column_checksum_validation", "t", "source_column_checksum: [a: 1, b: 2], target_column_checksum: [a: 1]"),
        ],
        "validation_report string, target_table string, value string",
    )
    assert [(r.column, r.in_target, r.result) for r in schema_rows(df).collect()] == [
        ("a", True, "PASSED"), ("b", False, "FAILED"),
    ]
    assert [(r.column, r.target_checksum, r.result) for r in checksum_rows(df).collect()] == [
        ("a", "1", "PASSED"), ("b", "N/A", "FAILED"),
    ]


def test_typed_and_older_summaries_in_one_report(spark):
    """Lists are used where a summary has them, whatever its text says; older rows are read from text."""
    odd = "a, b]: 'c'"
    df = spark.createDataFrame(
        [
            ("schema_validation", "new", "source_columns: ['x'], target_columns: ['x']", [odd, "n"], [odd], None),
            ("schema_validation", "old", "source_columns: ['a'], target_columns: ['a', 'b']", None, None, None),
            ("column_checksum_validation", "new", "source_column_checksum: [], target_column_checksum: []", None, None,
             [(odd, "1", "2"), ("n", None, "3")]),
            ("column_checksum_validation", "old", "source_column_checksum: [a: 1], target_column_checksum: [a: 1]", None, None, None),
        ],
        f"validation_report string, target_table string, value string, {SUMMARY_LISTS.removesuffix(', records_at string')}",
    )
    lines = {(r.target_table, r.column): r.result for r in schema_rows(df).collect()}
    assert lines == {("new", odd): "PASSED", ("new", "n"): "FAILED", ("old", "a"): "PASSED", ("old", "b"): "FAILED"}
    sums = {(r.target_table, r.column): (r.source_checksum, r.target_checksum, r.result) for r in checksum_rows(df).collect()}
    assert sums == {("new", odd): ("1", "2", "FAILED"), ("new", "n"): ("N/A", "3", "FAILED"), ("old", "a"): ("1", "1", "PASSED")}


def test_summaries_come_back_typed(spark, tmp_path):
    src = spark.createDataFrame([(1, "a")], "`k, 1` int, `v]` string")
    summary = validate(src, src.drop("v]"), target_table="d.t", records_at="s3://r").summary
    write_summary(summary, str(tmp_path / "d" / "t" / "validation_summary"))
    back = read_summaries(spark, str(tmp_path))
    rows = {r.validation_report: r for r in back.collect()}
    assert rows["schema_validation"].source_columns == ["k, 1", "v]"]
    assert rows["row_checksum_validation"].records_at == "s3://r"
    assert [c.column for c in rows["column_checksum_validation"].checksums] == ["k, 1"]
    assert {(r.column, r.result) for r in schema_rows(back).collect()} == {("k, 1", "PASSED"), ("v]", "FAILED")}


def test_mismatch_lines(spark):
    src = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, `n, m` string, o string")
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "B!", "y"), (4, "d", "z")], "id int, `n, m` string, o string")
    v = validate(src, tgt, key=["id"])
    saved = savable_pairs(v.pairs, "d.t", v.key)
    assert saved.schema.simpleString() == spark.createDataFrame([], SAVED_PAIRS).schema.simpleString()
    got = {(r.key["id"], r.column): (r.source_value, r.target_value, r.result) for r in mismatch_rows(saved).collect()}
    assert got == {
        ("2", "n, m"): ("b", "b!", "FAILED"), ("2", "o"): ("y", "y", "PASSED"),
        ("3", "n, m"): ("c", None, "FAILED"), ("3", "o"): ("z", None, "FAILED"),
        ("4", "n, m"): (None, "d", "FAILED"), ("4", "o"): (None, "z", "FAILED"),
    }
    keyless = validate(src, tgt)
    assert mismatch_rows(savable_pairs(keyless.pairs, "d.t")).filter("size(key) = 0").count() == 6


def test_legacy_mismatches(spark):
    records = [
        {"source_row": {"record": {"k": 1, "v": "it's, [x]"}, "checksum": "s1"}},
        {"target_row": {"record": {"k": 1, "v": None}, "checksum": "t1"}},
        {"source_row": {"record": {"k": 2}, "checksum": "s2"}},
    ]
    texts = [f"Mismatched checksums: 2 rows (1.0%). Records: {records}", "Records: [oops", "Records: 7", "Records: []", "", None]
    df = spark.createDataFrame(
        [("row_checksum_validation", f"t{i}", t) for i, t in enumerate(texts)],
        "validation_report string, target_table string, remarks string",
    )
    rows = {(r.target_table, r["rank"], r.column): (r.source_value, r.target_value, r.result, r.target_checksum) for r in mismatch_rows(legacy_pairs(df)).collect()}
    assert rows == {
        ("t0", 1, "k"): ("1", "1", "PASSED", "t1"),
        ("t0", 1, "v"): ("it's, [x]", "None", "FAILED", "t1"),
        ("t0", 2, "k"): ("2", None, "FAILED", None),
    }


def jobs(spark):
    def runs(rows):
        return spark.createDataFrame(
            [
                (name, run, "SUCCEEDED", None, None,
                 {"--target_glue_table": t, "--target_glue_db": "d", "--source_schema": "S", **extra})
                for name, run, t, extra in rows
            ],
            JOB,
        )

    archive = runs([("a", "1", "t", {"--source_table": "T"}), ("a", "2", "t", {"--source_table": "T"})])
    check = runs([("v", "3", "t", {"--source_table": "T"}), ("v", "4", "u", {"--query": "SELECT 1"}), ("v", "5", "w", {})])
    return job_metadata(archive, check)


def test_report_covers_tables_without_summaries(spark):
    summaries = spark.createDataFrame(
        [("row_count_validation", "d.t", "failed", "old", "", 1), ("row_count_validation", "d.t", "passed", "new", "", 2)],
        "validation_report string, target_table string, result string, value string, remarks string, seq int",
    )
    rows = {r.target_table: r for r in report(summaries, jobs(spark)).collect()}
    assert set(rows) == {"d.t", "d.u", "d.w"}
    assert (rows["d.t"].value, rows["d.t"].archive_runs, rows["d.t"].severity) == ("new", 2, "good")
    assert rows["d.u"].validation_report == "no_data" and rows["d.u"].source_table == "S.SELECT 1"
    assert rows["d.w"].source_table == "S.UNKNOWN_SOURCE"


def test_latest_by_type(spark):
    df = spark.createDataFrame(
        [("t", "a", "1", 1), ("t", "a", "2", 5), ("t", "b", "3", 2)],
        "target_table string, validation_report string, result string, seq int",
    )
    got = {(r.validation_report, r.result) for r in latest_by_type(df).collect()}
    assert got == {("a", "2"), ("b", "3")}


def test_legacy_pairs_of_each_summary(spark):
    """Literals that are JSON as well, two summaries of one table, and no shuffle."""
    plain = '[{"source_row": {"record": {"k": 1, "v": 1.50}, "checksum": "s"}}, {"target_row": {"record": {"k": 1}, "checksum": "t"}}]'
    other = "[{'source_row': {'record': {'k': 2, 'v': True}}}]"
    no_literal = plain.replace("1.50", "null")
    df = spark.createDataFrame(
        [("row_checksum_validation", "t", f"Records: {x}") for x in (plain, other, no_literal)],
        "validation_report string, target_table string, remarks string",
    )
    lines = mismatch_rows(legacy_pairs(df))
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    got = {(r["rank"], r.column, r.source_value, r.target_value, r.source_checksum, r.target_checksum) for r in lines.collect()}
    assert got == {
        (1, "k", "1", "1", "s", "t"), (1, "v", "1.5", None, "s", "t"),
        (1, "k", "2", None, "", None), (1, "v", "True", None, "", None),
    }
