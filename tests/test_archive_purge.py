import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coldkeep.functions.retention import expired
from coldkeep.operators.blob_store import stored_blobs
from coldkeep.plans import purge
from coldkeep.plans.archive import archive, archive_many, archive_rows, store
from coldkeep.plans.plan import PLAN_COLUMNS
from coldkeep.plans.report import JOB_COLUMNS, job_metadata, report
from coldkeep.plans.validate import validate, validate_archive, validate_many, verdict
from coldkeep.sinks.documents import register_config, registrations, write_purge_plan, write_summary
from coldkeep.sinks import tables as sink
from coldkeep.sinks.tables import drop_archive_db, remove_superseded, table_folder, write_archive
from coldkeep.sources.connections import Connection, connection_of
from coldkeep.sources.documents import (
    latest_config,
    parse_rules,
    read_purge_plan,
    read_purge_targets,
    read_summaries,
)

AS_OF = "1997-01-15"


def plan_row(spark, db, table="feed", query=None, condition=None, target="S_Feed"):
    values = {
        "source_name": "s", "connection": "c", "source_schema": db, "source_table": table,
        "query": query, "condition": condition, "target_path": "s3://vault/", "target_db": db,
        "target_table": target, "segment": "feed", "retention_policy_value": "30d", "legal_hold": False,
    }
    schema = ", ".join(f"{c} {'boolean' if c == 'legal_hold' else 'string'}" for c in PLAN_COLUMNS)
    return spark.createDataFrame([tuple(values[c] for c in PLAN_COLUMNS)], schema)


@pytest.fixture
def feed(spark, database):
    spark.sql(
        "SELECT id, timestampadd(DAY, CAST(id AS INT), TIMESTAMP '1996-11-01') AS made, "
        "CASE WHEN id % 3 = 0 THEN X'' ELSE encode('<x>' || id % 5, 'UTF-8') END AS doc FROM range(120)"
    ).write.saveAsTable(f"{database}.feed")
    return database


def test_archive_and_validate(spark, feed):
    row = plan_row(spark, feed).head()
    done = archive(spark, row, Connection("c"), AS_OF)
    assert (done.rows, done.blobs) == (120, 5)
    back = spark.table(done.table)
    assert set(back.columns) == {
        "id", "made", "doc", "doc_s3_path", "archived_at", "retention_expires_at", "legal_hold",
        "checksum", "expiry_month",
    }
    assert back.filter("doc_s3_path IS NULL").count() == 40
    assert back.select("retention_expires_at").distinct().head()[0] == dt.datetime(1997, 2, 14)
    v = validate_archive(spark, spark.table(f"{feed}.feed"), done.table, key=["id"])
    assert verdict(v.summary).head().passed
    staged = validate_archive(spark, spark.table(f"{feed}.feed"), done.table, stage_source=True)
    assert verdict(staged.summary).head().passed
    again = archive(spark, row, Connection("c"), AS_OF)
    assert (again.rows, again.blobs) == (120, 0)
    assert stored_blobs(spark, feed).count() == 5


def test_seeded_defect_is_reported(spark, feed):
    done = archive(spark, plan_row(spark, feed).head(), Connection("c"), AS_OF)
    src = spark.table(f"{feed}.feed").withColumn("made", F.expr("if(id = 7, made + interval 1 day, made)"))
    v = validate_archive(spark, src, done.table, key=["id"])
    (pair,) = v.pairs.collect()
    assert pair.id == "7" and pair.source.made != pair.target.made
    results = {r.validation_report: (r.result, r.mismatch_count, r.mismatched_columns) for r in v.summary.collect()}
    assert results["column_checksum_validation"] == ("failed", None, ["made"])
    assert results["row_checksum_validation"][:2] == ("failed", 1)
    assert results["row_count_validation"][0] == "passed"


def test_condition_query_and_empty_source(spark, feed):
    conn = Connection("c")
    some = archive(spark, plan_row(spark, feed, condition="id < 10").head(), conn, AS_OF)
    assert some.rows == 10
    sql = f"SELECT id FROM {feed}.feed WHERE id >= 100"
    asked = archive(spark, plan_row(spark, feed, None, sql, target="asked").head(), conn, AS_OF)
    assert asked.rows == 20 and asked.blobs == 0
    none = archive(spark, plan_row(spark, feed, condition="id < 0", target="none").head(), conn, AS_OF)
    assert none.rows == 0 and not spark.catalog.tableExists(none.table)


def test_replace_and_append(spark, feed):
    conn = Connection("c")
    archive(spark, plan_row(spark, feed, condition="id < 10").head(), conn, AS_OF)
    more = archive(spark, plan_row(spark, feed, condition="id >= 115").head(), conn, "1997-03-01", mode="append")
    assert more.rows == 5 and spark.table(more.table).count() == 15
    assert spark.table(more.table).select("expiry_month").distinct().count() == 2
    archive(spark, plan_row(spark, feed, condition="id < 3").head(), conn, AS_OF)
    assert spark.table(more.table).count() == 3
    with pytest.raises(ValueError):
        write_archive(spark.range(1), f"{feed}.x", mode="merge")


def test_append_of_other_columns_is_refused(spark, database):
    write_archive(spark.range(3), f"{database}.t")
    with pytest.raises(ValueError, match="columns"):
        write_archive(spark.range(3).withColumn("new", F.lit(1)), f"{database}.t", mode="append")


def test_archive_many_isolates_failures(spark, feed):
    plan = plan_row(spark, feed).union(plan_row(spark, feed, table="missing", target="m"))
    runs = archive_many(spark, plan, Connection("c"), AS_OF)
    rows = {r.script_args["--target_glue_table"]: r for r in runs.collect()}
    assert rows["S_Feed"].status == "SUCCEEDED" and rows["S_Feed"].rows == 120
    assert rows["m"].status == "FAILED" and rows["m"].error


def test_validate_many_and_report(spark, feed, tmp_path):
    sql = f"SELECT id FROM {feed}.feed WHERE id >= 100"
    plan = plan_row(spark, feed, condition="id < 50").union(
        plan_row(spark, feed, None, sql, target="S_Asked")
    ).union(plan_row(spark, feed, table="missing", target="S_Missing"))
    conn, root = Connection("c"), str(tmp_path / "reports")
    archive_runs = archive_many(spark, plan, conn, AS_OF)
    validate_runs = validate_many(spark, plan, conn, root)
    cols = list(JOB_COLUMNS)
    jobs = job_metadata(archive_runs.select(cols), validate_runs.select(cols))
    got = {}
    for r in report(read_summaries(spark, root), jobs).collect():
        got.setdefault(r.target_table.split(".")[1], []).append((r.validation_report, r.result))
    assert {len(got["S_Feed"]), len(got["S_Asked"])} == {4}
    assert {result for _, result in got["S_Feed"] + got["S_Asked"]} == {"passed"}
    assert got["S_Missing"] == [("no_data", None)]


def test_export_blob_files(spark, feed, tmp_path):
    row = plan_row(spark, feed).withColumn("target_path", F.lit(f"file://{tmp_path}/vault")).head()
    done = archive(spark, row, Connection("c"), AS_OF, export=True)
    links = {r[0]: bytes(r[1]) for r in spark.table(done.table).select("doc_s3_path", "doc").collect() if r[0]}
    files = {p: p.read_bytes() for p in (tmp_path / "vault").rglob("*.xml")}
    assert {f"file://{p}": b for p, b in files.items()} == links and len(files) == 5
    loaded = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{tmp_path}/vault")
    assert loaded.count() == 5


def test_replace_unpartitioned(spark, database):
    name = f"{database}.flat"
    assert write_archive(spark.range(5), name) == 5
    assert write_archive(spark.range(7), name) == 7 and spark.table(name).count() == 7
    assert write_archive(spark.range(2).withColumn("x", F.lit(1)), name) == 2
    assert spark.table(name).columns == ["id", "x"]
    assert remove_superseded(spark, name) == 2 and spark.table(name).count() == 2


def archived(spark, feed):
    hold = F.expr("CASE WHEN id % 11 = 0 THEN NULL ELSE id % 10 = 0 END")
    return archive_rows(spark.table(f"{feed}.feed"), "30d", hold, AS_OF, basis="made")


@pytest.mark.parametrize("as_of", ["1997-01-15", "1997-01-01", "1996-01-01", "2030-01-01"])
@pytest.mark.parametrize("partitioned", [True, False])
def test_purge(spark, feed, as_of, partitioned):
    rows, name = archived(spark, feed), f"{feed}.arc"
    store(rows, name) if partitioned else write_archive(rows, name)
    want = {r.id for r in rows.filter(~expired(as_of)).collect()}
    assert purge.purge_table(spark, name, as_of) == 120 - len(want)
    assert {r.id for r in spark.table(name).collect()} == want
    assert purge.purge_table(spark, name, as_of) == 0


def test_all_rows_expired(spark, feed):
    rows = archive_rows(spark.table(f"{feed}.feed"), "1d", False, "1996-01-01")
    for name, write in ((f"{feed}.a", store), (f"{feed}.b", write_archive)):
        write(rows, name)
        assert purge.purge_table(spark, name, AS_OF) == 120
        assert spark.table(name).count() == 0


def files_below(spark, name):
    return list(Path(table_folder(spark, name).split(":", 1)[-1]).rglob("*.parquet"))


def test_purged_rows_leave_the_disk(spark, feed):
    name = f"{feed}.arc"
    store(archived(spark, feed), name)
    purge.purge_table(spark, name, AS_OF)
    left, rows = spark.table(name).count(), sorted(r.id for r in spark.table(name).collect())
    assert remove_superseded(spark, name) > 0
    assert remove_superseded(spark, name) == 0
    spark.catalog.refreshTable(name)
    assert sorted(r.id for r in spark.table(name).collect()) == rows
    on_disk = spark.read.parquet(*[str(f) for f in files_below(spark, name)]).count()
    assert on_disk == left


def test_append_after_purge(spark, feed):
    name = f"{feed}.arc"
    store(archived(spark, feed), name)
    purge.purge_table(spark, name, AS_OF)
    left = spark.table(name).count()
    assert store(archived(spark, feed), name, mode="append") == 120
    assert spark.table(name).count() == left + 120


def test_discover_plan_purge(spark, feed, tmp_path):
    store(archived(spark, feed), f"{feed}.arc")
    path = str(tmp_path / "plans")
    found = purge.run(spark, "discovery", feed, "src", path, as_of=AS_OF)
    status = {r.table_name: (r.status, r.estimated_rows_to_delete) for r in found.collect()}
    n = archived(spark, feed).filter(expired(AS_OF)).count()
    assert status == {"arc": ("found", n), "feed": ("skipped", None)}

    other = purge.purge_plan(found, "other")
    write_purge_plan(other, path)
    write_purge_plan(other, path)
    assert read_purge_plan(spark, path, "src").count() == read_purge_plan(spark, path, "other").count() == 1

    results = purge.run(spark, "delete", feed, "src", path)
    (row,) = results.collect()
    assert (row.status, row.rows_deleted, row.remaining_expired_rows) == ("success", n, 0)
    assert purge.purge_summary(results).head().status == "completed"
    (again,) = purge.run(spark, "delete", feed, "src", path).collect()
    assert (again.status, again.rows_deleted) == ("success", 0)
    with pytest.raises(ValueError):
        purge.run(spark, "both", feed, "src", path)


def test_targets(spark, feed, tmp_path):
    store(archived(spark, feed), f"{feed}.arc")
    doc = {"targets": [{"source_name": "src", "connection": feed.removeprefix("archive_"), "max_parallel_tables": 2}]}
    (tmp_path / "purge.json").write_text(json.dumps(doc))
    targets, path = read_purge_targets(spark, str(tmp_path / "purge.json")), str(tmp_path / "plans")
    found = purge.run_targets(spark, "discovery", targets, path, as_of=AS_OF)
    assert {(r.source_name, r.table_name, r.status) for r in found.collect()} == {
        ("src", "arc", "found"), ("src", "feed", "skipped"),
    }
    (row,) = purge.run_targets(spark, "delete", targets, path).collect()
    assert row.status == "success" and row.rows_deleted == row.estimated_rows_deleted > 0


def test_purge_failures_are_isolated(spark, feed):
    store(archived(spark, feed), f"{feed}.arc")
    plan = spark.createDataFrame(
        [("s", feed, t, 1, dt.date(1997, 1, 15)) for t in ("gone", "arc")],
        "source_name string, database string, table_name string, estimated_rows_to_delete bigint, as_of date",
    )
    results = purge.purge_many(spark, plan)
    rows = {r.table: r for r in results.collect()}
    assert rows["gone"].status == "failed" and rows["gone"].error and rows["arc"].status == "success"
    summary = purge.purge_summary(results).head()
    assert (summary.tables_processed, summary.failed_deletions, summary.status) == (2, 1, "completed_with_failures")


def test_empty_plan(spark):
    empty = spark.createDataFrame([], "database string, table_name string, estimated_rows_to_delete bigint, as_of date")
    summary = purge.purge_summary(purge.purge_many(spark, empty)).head()
    assert (summary.tables_processed, summary.status) == (0, "completed")


def test_drop_database(spark, feed):
    store(archived(spark, feed), f"{feed}.arc")
    folder = Path(table_folder(spark, f"{feed}.arc").split(":", 1)[-1])
    with pytest.raises(ValueError):
        drop_archive_db(spark, feed, confirm="delete")
    assert drop_archive_db(spark, feed, confirm="DELETE") == ["arc", "feed"]
    assert not spark.catalog.databaseExists(feed) and not folder.exists()


def test_summary_round_trip(spark, feed, tmp_path):
    done = archive(spark, plan_row(spark, feed).head(), Connection("c"), AS_OF)
    src = spark.table(f"{feed}.feed").filter("id <> 4")
    v = validate_archive(spark, src, done.table, source_table="S.FEED")
    root = f"{tmp_path}/report/"
    write_summary(v.summary, root)
    write_summary(v.summary, root)
    back = read_summaries(spark, root)
    assert back.count() == 4
    key = lambda df: sorted((r.validation_report, r.result, r.value, r.remarks) for r in df.collect())
    assert key(back) == key(v.summary)
    text = spark.read.option("header", True).option("escape", '"').csv(root + "csv")
    assert sorted(r.value for r in text.collect()) == sorted(r.value for r in v.summary.collect())


def test_config_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    for run, env in (("r1", "dev"), ("r2", "prod")):
        doc = json.dumps({"env": env, "sources": [{"name": "a"}, {"name": "b"}]})
        rules = parse_rules(spark.createDataFrame([(doc,)], "document string"))
        register_config(registrations(rules, run, f"2024-01-0{run[1]}"), path)
    rows = {r.source_name: r for r in latest_config(spark.read.parquet(path)).collect()}
    assert set(rows) == {"a", "b"} and {r.dag_run_id for r in rows.values()} == {"r2"}
    assert json.loads(rows["a"].config)["env"] == "prod"


def month_rows(spark, months, tag):
    rows = [(i, m, hold, tag) for m in months for hold in (True, False, None) for i in range(2)]
    return spark.createDataFrame(rows, "id int, expiry_month int, legal_hold boolean, tag string")


def test_partitioned_replace_keeps_the_name(spark, database, monkeypatch):
    """Whatever statement a run dies before, the table is there, and a repeated run completes it."""
    parts = ("expiry_month", "legal_hold")
    name = f"{database}.arc"
    write = lambda months, tag: write_archive(month_rows(spark, months, tag).select("id", "tag", *parts), name, partition_by=parts)
    write([1, 2, 3], "old")
    real, issued = sink.switch_statements, []
    for stop in range(20):
        def failing(*args, stop=stop):
            statements = real(*args)
            issued.append(len(statements))
            return statements[:stop] + (["SELECT raise_error('dead')"] if stop < len(statements) else [])

        monkeypatch.setattr(sink, "switch_statements", failing)
        write([2, 3, 4], f"new{stop}")
        found = {(r.expiry_month, r.tag) for r in spark.table(name).select("expiry_month", "tag").distinct().collect()}
        # Months that both tables have are there at any time, from one of them.
        assert {2, 3} <= {m for m, _ in found}
        monkeypatch.setattr(sink, "switch_statements", real)
        assert write([2, 3, 4], "done") == 18
        assert {(r.expiry_month, r.legal_hold, r.tag) for r in spark.table(name).collect()} == {
            (m, h, "done") for m in (2, 3, 4) for h in (True, False, None)
        }
        if stop >= issued[-1]:
            break
        write([1, 2, 3], "old")
    assert stop > 3
    left = spark.table(name).count()
    assert remove_superseded(spark, name) > 0 and spark.table(name).count() == left


def test_partitioned_replace_with_other_columns(spark, database):
    parts = ("expiry_month", "legal_hold")
    name = f"{database}.arc"
    write_archive(month_rows(spark, [1], "a"), name, partition_by=parts)
    more = month_rows(spark, [2], "b").withColumn("more", F.lit(1)).select("id", "tag", "more", *parts)
    assert write_archive(more, name, partition_by=parts) == 6
    assert spark.table(name).columns == ["id", "tag", "more", *parts] and spark.table(name).count() == 6


def test_partition_values_are_quoted(spark, database):
    name = f"{database}.odd"
    values = ["a=b/c", "it's", "x y%z", "\\back", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, p string")
    for _ in range(2):
        assert write_archive(rows, name, partition_by=["p"]) == 5
        assert sorted(map(tuple, spark.table(name).collect()), key=repr) == sorted(enumerate(values), key=repr)


def stamps(spark, name):
    return {p.name: p.stat().st_mtime_ns for p in files_below(spark, name)}


def flat_archive(spark, feed):
    """Files of ten days each, so that a purge touches a few of them."""
    rows = archived(spark, feed).withColumn("legal_hold", F.lit(False))
    name = f"{feed}.flat"
    write_archive(rows.repartitionByRange(12, "id").sortWithinPartitions("id"), name)
    return name


def test_purge_rewrites_touched_files_only(spark, feed):
    name = flat_archive(spark, feed)
    before, rows = stamps(spark, name), spark.table(name)
    want = {r.id for r in rows.filter(~expired(AS_OF)).collect()}
    untouched = {r.f for r in rows.groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.count_if(expired(AS_OF)).alias("n")).filter("n = 0").select("f").collect()}
    assert len(before) == 12 and 2 < len(untouched) < 12
    assert purge.purge_table(spark, name, AS_OF) == 120 - len(want)
    after = stamps(spark, name)
    assert untouched == set(before) & set(after)
    assert all(after[f] == before[f] for f in untouched)
    assert {r.id for r in spark.table(name).collect()} == want
    assert purge.purge_table(spark, name, AS_OF) == 0


@pytest.mark.parametrize("die", ["before the list", "after the list", "after one move"])
def test_purge_by_file_survives_a_crash(spark, feed, monkeypatch, die):
    name = flat_archive(spark, feed)
    want = {r.id for r in spark.table(name).filter(~expired(AS_OF)).collect()}
    real = sink.finish_replacing

    def dead(*args):
        raise RuntimeError("dead")

    if die == "before the list":
        monkeypatch.setattr(sink, "_file_system", dead)
    else:
        monkeypatch.setattr(sink, "finish_replacing", dead)
    with pytest.raises(RuntimeError):
        rows = spark.table(name)
        past = rows.filter(expired(AS_OF)).select("_metadata.file_path").distinct().collect()
        files = sorted(r.file_path for r in past)
        touched = spark.read.schema(rows.schema).parquet(*files)
        sink.replace_files(spark, name, files, touched.filter(~expired(AS_OF)))
    monkeypatch.undo()
    assert spark.table(name).count() == 120  # the old rows, until the change is final and carried out
    if die == "after one move":
        (folder,) = [p for p in Path(sink._location(spark, name).split(":", 1)[-1]).iterdir() if p.name.startswith("_purge_")]
        one = sorted(folder.glob("*.parquet"))[0]
        one.rename(folder.parent / one.name)
    real(spark, name)
    purge.purge_table(spark, name, AS_OF)
    assert sorted(r.id for r in spark.table(name).collect()) == sorted(want)
    assert not any(p.name.startswith("_purge_") for p in Path(sink._location(spark, name).split(":", 1)[-1]).iterdir())


def scanned(df):
    """What each scan of a plan reads."""
    return re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution().executedPlan().toString())


def test_discovery_reads_no_column_of_months_gone_by(spark, feed):
    name = f"{feed}.arc"
    store(archived(spark, feed), name)
    found = purge.expired_rows(spark, name, AS_OF)
    assert sorted(scanned(found)) == ["struct<>", "struct<retention_expires_at:timestamp>"]
    assert found.count() == archived(spark, feed).filter(expired(AS_OF)).count() > 0
    for day in ("1997-01-01", "1996-12-05", "1990-01-01", "2030-06-15"):
        assert purge.expired_count(spark, name, day) == archived(spark, feed).filter(expired(day)).count()


def test_columns_of_the_archive_s_own_names_are_refused(spark, feed):
    for name in ("checksum", "Legal_Hold", "expiry_month"):
        with pytest.raises(ValueError, match=name.lower()):
            archive_rows(spark.range(1).withColumn(name, F.lit(1)), "1d", False, AS_OF)
    clash = spark.table(f"{feed}.feed").withColumn("DOC_s3_path", F.lit("x"))
    with pytest.raises(ValueError, match="doc_s3_path"):
        archive_rows(clash, "1d", False, AS_OF, blob_root="s3://v")
    clash.write.saveAsTable(f"{feed}.clash")
    (run,) = archive_many(spark, plan_row(spark, feed, table="clash"), Connection("c"), AS_OF).collect()
    assert run.status == "FAILED" and "doc_s3_path" in run.error


def test_rows_are_read_from_the_connection_they_name(spark, feed):
    plan = plan_row(spark, feed, target="a").union(
        plan_row(spark, feed, target="b").withColumn("connection", F.lit("d"))
    ).union(plan_row(spark, feed, target="x").withColumn("connection", F.lit("unknown")))
    conns = {"c": Connection("c"), "d": Connection("d")}
    runs = {r.script_args["--target_glue_table"]: r for r in archive_many(spark, plan, conns, AS_OF).collect()}
    assert {t: r.status for t, r in runs.items()} == {"a": "SUCCEEDED", "b": "SUCCEEDED", "x": "FAILED"}
    assert "unknown connection: 'unknown'" in runs["x"].error
    (single,) = archive_many(spark, plan_row(spark, feed, target="y").withColumn("connection", F.lit("d")), Connection("c"), AS_OF).collect()
    assert single.status == "FAILED"
    assert connection_of(Connection("c"), None).name == "c"


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_purge_stops_above_its_plan(spark, feed, partitioned):
    rows, name = archived(spark, feed), f"{feed}.arc"
    store(rows, name) if partitioned else write_archive(rows, name)
    n = rows.filter(expired(AS_OF)).count()
    with pytest.raises(purge.MoreThanPlanned, match=f"{n} rows would be deleted, the plan found {n - 1}"):
        purge.purge_table(spark, name, AS_OF, at_most=n - 1)
    assert spark.table(name).count() == 120
    plan = spark.createDataFrame(
        [("s", feed, "arc", n - 1, dt.date(1997, 1, 15))],
        "source_name string, database string, table_name string, estimated_rows_to_delete bigint, as_of date",
    )
    (row,) = purge.purge_many(spark, plan, within_plan=True).collect()
    assert row.status == "failed" and spark.table(name).count() == 120
    assert purge.purge_table(spark, name, AS_OF, at_most=n) == n


def test_links_of_other_columns_are_drift(spark, feed):
    done = archive(spark, plan_row(spark, feed).head(), Connection("c"), AS_OF)
    src, tgt = spark.table(f"{feed}.feed"), spark.table(done.table)
    schema = lambda v: v.summary.filter("validation_report = 'schema_validation'").head()
    assert schema(validate(src, tgt)).result == "passed"
    drifted = schema(validate(src, tgt.withColumn("made_s3_path", F.lit("x"))))
    assert (drifted.result, drifted.mismatched_columns) == ("failed", ["made_s3_path"])


def test_stamps_do_not_pass_the_shuffle(spark, database):
    """Rows are dealt to the archive's partitions before they get stamps and checksums."""
    from coldkeep.plans.archive import dealt

    hold = F.expr("CASE WHEN id % 11 = 0 THEN NULL ELSE id % 10 = 0 END")
    rows = spark.range(120).withColumn("made", F.expr("timestampadd(DAY, CAST(id AS INT), TIMESTAMP '1996-11-01')"))
    early = archive_rows(dealt(rows, "30d", hold, AS_OF, "made"), "30d", hold, AS_OF, basis="made")
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions") :]
    assert "AS checksum#" in plan and "checksum" not in below and "archived_at" not in below
    store(early, f"{database}.early", scattered=False)
    store(archive_rows(rows, "30d", hold, AS_OF, basis="made"), f"{database}.late")
    first, second = (spark.table(f"{database}.{x}") for x in ("early", "late"))
    assert first.schema == second.schema and first.count() == 120
    assert not first.exceptAll(second).count() and not second.exceptAll(first).count()
    assert sink.partition_columns(spark, f"{database}.early") == ["expiry_month", "legal_hold"]
