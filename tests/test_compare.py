from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plan_columns import exchanged

from coldkeep.functions.normalize import norm_value, normalize_values, value_key
from coldkeep.operators import compare
from coldkeep.operators.ranking import rank_within
from coldkeep.plans.validate import validate, verdict

COLS = ["k", "v"]


def pair(spark, a, b):
    make = lambda rows: spark.createDataFrame(rows, "k string, v string")
    return make(a), make(b)


def diff_rows(df):
    return {(r.k, r.v): (r.n_src, r.n_tgt) for r in df.collect()}


def brute(a, b):
    ca, cb = Counter(a), Counter(b)
    return {r: (ca[r], cb[r]) for r in ca | cb if ca[r] != cb[r]}


ROWS = st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz")), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_row_diff_is_the_multiset_difference(spark, a, b):
    src, tgt = pair(spark, a, b)
    assert diff_rows(compare.row_diff(src, tgt, COLS)) == brute(a, b)


def test_buckets_give_the_same_difference(spark):
    a = [(str(i % 50), str(i % 7)) for i in range(2000)]
    b = [(str(i % 50), str(i % 7)) for i in range(1990)] + [("9", "9")]
    src, tgt = pair(spark, a, b)
    for buckets in (1, 16, 4096):
        stats = compare.side_stats(src, tgt, COLS, buckets=buckets)
        found = compare.suspects(stats, buckets)
        assert diff_rows(compare.row_diff(src, tgt, COLS, found)) == brute(a, b)
        split = compare.narrowed(src, tgt, COLS, found, few_rows=0)
        assert split.bits >= found.bits and split.n_rows <= found.n_rows
        assert diff_rows(compare.row_diff(src, tgt, COLS, split)) == brute(a, b)
    with pytest.raises(ValueError, match="power of two"):
        compare.side_stats(src, tgt, COLS, buckets=100)


def test_scattered_defects_are_narrowed_down(spark):
    """One row in a hundred differs: nearly every bucket does, but few rows are read again."""
    src = spark.range(60_000).selectExpr("string(id) AS k", "string(id % 977) AS v")
    tgt = src.selectExpr("k", "if(k % 100 = 7, 'x', v) AS v")
    first = compare.suspects(compare.side_stats(src, tgt, COLS, buckets=64), 64)
    assert first.n_buckets == 64 and first.n_rows == first.all_rows == 120_000
    for level in (3, 14):
        compare_level, compare.LEVEL_BITS = compare.LEVEL_BITS, level
        try:
            split = compare.narrowed(src, tgt, COLS, first, few_rows=0)
        finally:
            compare.LEVEL_BITS = compare_level
        assert split.n_rows < 0.05 * split.all_rows
        kept = split.of(src, compare._place(compare._key_hashes(src, tgt, COLS, None)))
        assert kept.count() < 0.05 * 60_000
        diff = compare.row_diff(src, tgt, COLS, split)
        assert diff.count() == 1200 and diff.filter("k % 100 <> 7").count() == 0


def test_equal_sides_are_not_read_again(spark):
    src, _ = pair(spark, [("a", "b")] * 10, [])
    found = compare.suspects(compare.side_stats(src, src, COLS))
    assert (found.n_buckets, found.n_rows, found.all_rows) == (0, 0, 20)
    assert compare.narrowed(src, src, COLS, found, few_rows=0) is found
    diff = compare.row_diff(src, src, COLS, found)
    assert diff.columns == [*COLS, "n_src", "n_tgt"] and diff.count() == 0


def test_hashes_are_exchanged_without_text(spark):
    src, tgt = pair(spark, [("a", "x")] * 3, [("a", "x"), ("b", "y")])
    found = compare.hash_diff(src, tgt, COLS)
    assert sorted((r.n_src, r.n_tgt) for r in found.collect()) == [(0, 1), (3, 1)]
    (only,) = exchanged(found)
    assert only == {"_h1", "_h2", "sum"}


def test_rows_of_one_hash_are_told_apart(spark, monkeypatch):
    """Where all hashes clash, text decides."""
    monkeypatch.setattr(compare, "_wide_hash", lambda *a: [F.lit(1).alias("_h1"), F.lit(2).alias("_h2")])
    a, b = [("a", "x"), ("b", "y"), ("c", "z")], [("a", "x"), ("b", "z")]
    src, tgt = pair(spark, a, b)
    assert diff_rows(compare.row_diff(src, tgt, COLS)) == brute(a, b)


def test_unequal_hashes_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(compare, "MOST_BROADCAST", 1)
    a, b = [("a", "x"), ("b", "y"), ("c", "z")], [("a", "x"), ("b", "z")]
    src, tgt = pair(spark, a, b)
    assert diff_rows(compare.row_diff(src, tgt, COLS)) == brute(a, b)
    found = compare.suspects(compare.side_stats(src, tgt, COLS))
    assert diff_rows(compare.row_diff(src, tgt, COLS, found)) == brute(a, b)


DOUBLES = [
    0.0, -0.0, 1e-9, -1e-9, 4.9e-6, 5e-6, 5.1e-6, 1.5e-5, 2.5e-5, 1.000001, 1.000002, 1.0, 1.00001,
    0.1, 0.1 + 0.2, 0.3, 123456.78, 123456.780001, 123456.78 + 2e-11, -123456.78, 1e9, 1e9 - 1e-7,
    999999999.99999, 999999999.999995, 1e9 + 1e-6, 1e12, 1e12 - 1.3e-4, 1e12 + 1.3e-4, 1e11 + 1e-5, 1e15, 1e15 + 0.125, 1e300, -1e300,
    float("nan"), float("inf"), float("-inf"), 2.000005, 2.0000049999, 1 / 3, 0.33333, None,
]


def groups(df, key):
    """Which rows share a value."""
    out = {}
    for r in df.select("i", key.alias("k")).collect():
        out.setdefault(r.k, set()).add(r.i)
    return sorted(map(sorted, out.values()))


def same_groups(df, mode):
    field = df.schema["x"].dataType
    key = F.xxhash64(value_key("x", field, field, mode))
    assert groups(df, key) == groups(df, norm_value(F.col("x"), field, mode))


@pytest.mark.parametrize("mode", ["lenient", "strict"])
def test_keys_group_like_text(spark, mode):
    doubles = spark.createDataFrame(list(enumerate(DOUBLES)), "i int, x double")
    same_groups(doubles, mode)
    same_groups(doubles.withColumn("x", F.col("x").cast("float")), mode)
    few = doubles.filter("abs(x) < 1e12 AND NOT isnan(x)")
    for scale in (2, 5, 8):
        same_groups(few.withColumn("x", F.col("x").cast(f"decimal(30,{scale})")), mode)
    times = spark.sql(
        "SELECT * FROM VALUES (0, TIMESTAMP '1969-12-31 23:59:59.5'), (1, TIMESTAMP '1969-12-31 23:59:59'), "
        "(2, TIMESTAMP '1970-01-01 00:00:00'), (3, TIMESTAMP '2020-01-01 12:00:00.1'), "
        "(4, TIMESTAMP '2020-01-01 12:00:00.2'), (5, NULL), (6, TIMESTAMP '0001-01-01 00:00:00') t(i, x)"
    )
    for kind in ("timestamp", "timestamp_ntz", "date"):
        same_groups(times.withColumn("x", F.col("x").cast(kind)), mode)
    texts = [" A ", "a", "A", None, "null", "NULL", "", " ", "\ta"]
    same_groups(spark.createDataFrame(list(enumerate(texts)), "i int, x string"), mode)
    same_groups(spark.createDataFrame([(0, True), (1, False), (2, None), (3, True)], "i int, x boolean"), mode)
    same_groups(spark.createDataFrame([(0, 1), (1, None), (2, 0), (3, 1)], "i int, x int"), mode)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=30), st.floats(0, 2e-5))
def test_number_keys_group_like_text(spark, values, step):
    xs = [v / 1e5 + k * step for v in values for k in (0, 1, 2)] + [v * 1e3 for v in values]
    same_groups(spark.createDataFrame(list(enumerate(xs)), "i int, x double"), "lenient")


def test_nulls_in_different_columns_are_told_apart(spark):
    src = spark.createDataFrame([(None, 5), (1, None)], "a int, b int")
    tgt = spark.createDataFrame([(5, None), (None, 1)], "a int, b int")
    stats = compare.side_stats(src, tgt, ["a", "b"], "strict")
    found = compare.suspects(stats)
    assert compare.row_diff(src, tgt, ["a", "b"], found, "strict").count() == 4
    assert compare.row_diff(src, tgt, ["a", "b"], mode="strict").count() == 4


def test_sides_of_different_types_compare_as_text(spark):
    src = spark.sql("SELECT 5 a, 1.5D b, DATE '2020-01-01' c, 'x' d")
    tgt = spark.sql("SELECT '5' a, 1.5BD b, TIMESTAMP '2020-01-01 00:00:00' c, ' X' d")
    assert set(results(validate(src, tgt)).values()) == {"passed"}
    assert results(validate(src, tgt, mode="strict"))["row_checksum_validation"] == "failed"


def test_equal_sides_have_no_suspects(spark):
    src, _ = pair(spark, [("a", "b")] * 10, [])
    stats = compare.side_stats(src, src.repartition(3), COLS)
    assert compare.suspect_buckets(stats).count() == 0


def test_duplicates_are_seen(spark):
    src, tgt = pair(spark, [("a", "x")], [("a", "x"), ("a", "x")])
    assert diff_rows(compare.row_diff(src, tgt, COLS)) == {("a", "x"): (1, 2)}
    assert compare.rows_only_in(src, tgt, COLS).count() == 0


@pytest.mark.parametrize("a,b,want", [
    ([("a", "x")], [], (1, 100.0, "failed")),
    ([], [("a", "x")], (1, 0.0, "failed")),
    ([], [], (0, 0.0, "passed")),
    ([("a", "x")] * 3, [("a", "x")] * 3, (0, 0.0, "passed")),
    ([("a", "x"), ("b", "x"), ("c", "x")], [("a", "x"), ("b", "y"), ("c", "x")], (1, 33.33, "failed")),
])
def test_row_check(spark, a, b, want):
    src, tgt = pair(spark, a, b)
    row = compare.row_check(compare.row_diff(src, tgt, COLS), len(a)).head()
    assert (row.mismatch_count, row.mismatch_percent, row.result) == want


def test_row_check_covers_more_than_100_percent(spark):
    src, tgt = pair(spark, [("a", "x")], [(str(i), "y") for i in range(3)])
    row = compare.row_check(compare.row_diff(src, tgt, COLS), 1).head()
    assert (row.source_only, row.target_only, row.mismatch_percent) == (1, 3, 300.0)


def test_rank_of_a_hot_key(spark):
    """One key holds nearly everything; ranks equal a plain row number."""
    rows = [("hot", f"{i * 2654435761 % 2**32:08x}") for i in range(3000)] + [("cold", "ff")]
    df = spark.createDataFrame(rows, "k string, d string")
    got = {(r.k, r.d): r["rank"] for r in rank_within(df, ["k"], "d").collect()}
    hot = sorted(d for k, d in rows if k == "hot")
    assert got == {**{("hot", d): i + 1 for i, d in enumerate(hot)}, ("cold", "ff"): 1}


def test_pairs_lose_no_row(spark):
    src, tgt = pair(spark, [("a", "1"), ("a", "2"), ("b", "1")], [("a", "3"), ("c", "1")])
    pairs = compare.pair_mismatches(compare.row_diff(src, tgt, COLS), COLS, ["k"]).collect()
    assert sum(p.source is not None for p in pairs) == 3
    assert sum(p.target is not None for p in pairs) == 2
    assert {p.k: p["rank"] for p in pairs if p.source and p.target} == {"a": 1}


def test_pairs_with_null_like_keys(spark):
    src = normalize_values(spark.sql("SELECT CAST(NULL AS STRING) k, 'x' v"))
    tgt = normalize_values(spark.sql("SELECT CAST(NULL AS STRING) k, 'y' v"))
    (p,) = compare.pair_mismatches(compare.row_diff(src, tgt, COLS), COLS, ["k"]).collect()
    assert (p.source.v, p.target.v) == ("x", "y")


def results(v):
    return {r.validation_report: r.result for r in v.summary.collect()}


def test_validate_clean(spark):
    df = spark.range(100).withColumn("x", F.col("id") / 3)
    tgt = df.withColumns({"archived_at": F.current_timestamp(), "checksum": F.lit("c")})
    v = validate(df, tgt)
    assert set(results(v).values()) == {"passed"}
    assert verdict(v.summary).head().passed
    assert v.rows.count() == 0


def test_validate_reports_missing_and_extra_columns(spark):
    df = spark.range(5).withColumn("x", F.lit(1)).withColumn("y", F.lit(2))
    v = validate(df, df.drop("x").withColumn("z", F.lit(3)))
    assert results(v) == {
        "schema_validation": "failed",
        "row_count_validation": "passed",
        "row_checksum_validation": "passed",
        "column_checksum_validation": "passed",
    }
    remarks = v.summary.filter("validation_report = 'schema_validation'").head().remarks
    assert remarks == "Mismatched columns: x, z"


def test_validate_text_names_the_place_of_the_records(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "ID int, name string")
    tgt = spark.createDataFrame([(1, "a"), (2, "c")], "id int, name string")
    for place, text in ((None, "Validation.rows"), ("s3://vault/r", "s3://vault/r")):
        v = validate(src, tgt, key=["id"], records_at=place)
        remarks = v.summary.filter("validation_report = 'row_checksum_validation'").head().remarks
        assert remarks == f"Mismatched checksums: 1 rows (50.0%). Records: {text}"
    # The differing rows themselves; their checksum covers the columns under suspicion.
    rows = {(r.side, r.copies, r.record.id, r.record.name) for r in v.rows.collect()}
    assert rows == {("source", 1, "2", "b"), ("target", 1, "2", "c")}
    same = validate(src, tgt.withColumn("id", F.lit(2)), key=["id"]).rows
    assert same.select("row_checksum").distinct().count() == same.count()
    (p,) = v.pairs.collect()
    assert (p.id, p.source.name, p.target.name) == ("2", "b", "c")


def test_duplicated_target_row_fails_only_multiset_checks(spark):
    src = spark.range(3)
    v = validate(src, src.union(spark.range(1)))
    assert results(v)["row_checksum_validation"] == "failed"
    assert results(v)["row_count_validation"] == "failed"


def test_columns_may_be_called_like_ours(spark):
    names = "side string, copies string, rank string, record string, row_checksum string"
    src = spark.createDataFrame([("a",) * 5, ("b",) * 5], names)
    tgt = spark.createDataFrame([("a",) * 5, ("c",) * 5], names)
    v = validate(src, tgt, key=["side"])
    assert results(v)["row_checksum_validation"] == "failed"
    assert v.rows.count() == 2 and v.pairs.count() == 2
