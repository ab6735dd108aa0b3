"""Queries over the given tables, one per operator; `oracle.py` has the same in plain SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from coldkeep.checks import fixtures as fx
from coldkeep.functions import blobs, checksums, naming, report_text
from coldkeep.functions.normalize import normalize_names, normalize_values
from coldkeep.functions.retention import expired, expiry_month, retention_days, stamp_retention
from coldkeep.operators import blob_store, compare, rules as rule_ops
from coldkeep.plans import purge as purging, report as reporting
from coldkeep.plans.archive import archive, archive_many, archive_rows, store
from coldkeep.plans.plan import plan, plan_documents
from coldkeep.plans.validate import validate, validate_many, verdict
from coldkeep.session import scratch_path, staged
from coldkeep.sinks.documents import (
    register_config,
    registrations,
    write_purge_plan,
    write_summary,
)
from coldkeep.sinks.tables import drop_archive_db, write_archive
from coldkeep.sources import documents as docs
from coldkeep.sources.tables import list_tables, query_over, read_archive, read_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- sources ----


@query
def conditional_scan(spark, sf_dir):
    conn, db = fx.landing(spark, sf_dir)
    return read_source(
        spark, conn, table=f"{db}.orders", condition="o_orderstatus = 'F' AND o_totalprice > 150000"
    )


@query
def query_scan(spark, sf_dir):
    conn, db = fx.landing(spark, sf_dir)
    sql = (
        f"SELECT c_custkey, c_name, n_name FROM {db}.customer JOIN {db}.nation "
        "ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'"
    )
    return read_source(spark, conn, query=sql)


@query
def query_over_table(spark, sf_dir):
    sql = (
        "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_shipdate) AS last_ship "
        "FROM {src} WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus"
    )
    return query_over(fx.table(spark, sf_dir, "lineitem"), sql)


# ---- stamps, checksums, normalisation ----


@query
def retention_stamp(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return stamp_retention(orders, "6M", True, "1997-01-01 10:30:00").select(
        "o_orderkey", "archived_at", "retention_expires_at", "legal_hold"
    )


@query
def retention_stamp_by_row(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    hold = F.col("l_returnflag") == "R"
    return stamp_retention(lines, "1y", hold, fx.AS_OF, basis="l_shipdate").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "retention_expires_at", "legal_hold"
    )


@query
def retention_literals(spark, sf_dir):
    """A period per order: its number and unit come from the row."""
    unit = F.expr("CASE o_orderstatus WHEN 'F' THEN 'd' WHEN 'O' THEN 'M' ELSE 'y' END")
    text = F.concat((F.length("o_orderpriority")).cast("string"), unit)
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("period"), retention_days(text).alias("days")
    )


@query
def row_checksum(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", checksums.row_checksum(lines).alias("checksum"))


@query
def row_checksum_with_nulls(spark, sf_dir):
    src, _ = fx.orders_pair(spark, sf_dir)
    return src.select("o_orderkey", checksums.row_checksum(src).alias("checksum"))


@query
def archived_rows(spark, sf_dir):
    rows = fx.archived(spark, sf_dir, "orders", "o_orderdate", fx.HOLD_ORDERS)
    return rows.withColumn("expiry_month", expiry_month(F.col("retention_expires_at")))


@query
def normalize_lenient(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    renamed = events.toDF(*[f" {c.upper()} " for c in events.columns])
    return normalize_values(normalize_names(renamed))


@query
def normalize_with_nulls(spark, sf_dir):
    src, _ = fx.orders_pair(spark, sf_dir)
    return normalize_values(src, ignore=["o_custkey"])


@query
def normalize_strict(spark, sf_dir):
    src, _ = fx.orders_pair(spark, sf_dir)
    return normalize_values(src, mode="strict")


# ---- comparison ----


def _texts(spark, sf_dir, mode="lenient"):
    src, tgt = fx.orders_pair(spark, sf_dir)
    return normalize_values(src, mode=mode), normalize_values(tgt, mode=mode)


def _diff(spark, sf_dir):
    return compare.row_diff(*_texts(spark, sf_dir), fx.ORDER_COLUMNS)


def _saved_diff(spark, sf_dir):
    """The differing rows, staged: what reads them several times works them out once."""
    return staged(_diff(spark, sf_dir), "diff")


@query
def row_count_check(spark, sf_dir):
    return compare.row_count_check(*fx.orders_pair(spark, sf_dir))


@query
def column_checksum(spark, sf_dir):
    lines = normalize_values(fx.table(spark, sf_dir, "lineitem"))
    return checksums.column_checksum(lines, algorithm="md5")


@query
def column_checksum_diff(spark, sf_dir):
    src, tgt = _texts(spark, sf_dir)
    return compare.column_checksum_diff(
        checksums.column_checksum(src, algorithm="md5"),
        checksums.column_checksum(tgt.drop("o_orderstatus"), algorithm="md5"),
    )


@query
def mismatched_columns(spark, sf_dir):
    src, tgt = _texts(spark, sf_dir)
    return compare.column_checksum_diff(
        checksums.column_checksum(src), checksums.column_checksum(tgt)
    ).select("column", "result")


@query
def rows_only_in_source(spark, sf_dir):
    return compare.rows_only_in(*_texts(spark, sf_dir), fx.ORDER_COLUMNS)


@query
def rows_only_in_target(spark, sf_dir):
    src, tgt = _texts(spark, sf_dir)
    return compare.rows_only_in(tgt, src, fx.ORDER_COLUMNS)


@query
def row_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


def _diff_by_bucket(src, tgt, mode):
    stats = staged(compare.side_stats(src, tgt, fx.ORDER_COLUMNS, mode), "stats")
    found = compare.narrowed(src, tgt, fx.ORDER_COLUMNS, compare.suspects(stats), mode, few_rows=0)
    return compare.row_diff(src, tgt, fx.ORDER_COLUMNS, found, mode)


@query
def row_diff_by_bucket(spark, sf_dir):
    """The same difference, reading again only the buckets that do not agree."""
    src, tgt = fx.orders_pair(spark, sf_dir)
    return _diff_by_bucket(src, tgt, "strict")


@query
def row_diff_by_bucket_lenient(spark, sf_dir):
    return _diff_by_bucket(*fx.orders_pair(spark, sf_dir), "lenient")


@query
def row_diff_copies(spark, sf_dir):
    """Few distinct rows with very many copies: the part numbers of all order lines by flag."""
    lines = fx.table(spark, sf_dir, "lineitem")
    cols = ["l_returnflag", "l_linestatus", "l_linenumber"]
    src = normalize_values(lines.select(*cols))
    tgt = normalize_values(lines.filter("l_quantity < 50").select(*cols))
    return compare.row_diff(src, tgt, cols)


@query
def row_check(spark, sf_dir):
    src, _ = fx.orders_pair(spark, sf_dir)
    return compare.row_check(_diff(spark, sf_dir), src.count())


@query
def mismatch_records(spark, sf_dir):
    rows = compare.mismatch_records(_diff(spark, sf_dir), fx.ORDER_COLUMNS, ["o_totalprice"])
    return rows.select("side", "copies", "record.*", "row_checksum")


def _flat(pairs, key):
    rest = [c for c in fx.ORDER_COLUMNS if c not in key] + ["copies", "row_checksum"]
    return pairs.select(
        *key,
        F.col("rank").cast("bigint").alias("rank"),
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("source", "target") for c in rest],
    )


@query
def mismatch_pairs(spark, sf_dir):
    key = ["o_orderkey"]
    return _flat(compare.pair_mismatches(_saved_diff(spark, sf_dir), fx.ORDER_COLUMNS, key), key)


@query
def mismatch_pairs_by_customer(spark, sf_dir):
    """A key that many differing rows share."""
    key = ["o_custkey"]
    return _flat(compare.pair_mismatches(_saved_diff(spark, sf_dir), fx.ORDER_COLUMNS, key), key)


@query
def mismatch_pairs_without_key(spark, sf_dir):
    return _flat(compare.pair_mismatches(_saved_diff(spark, sf_dir), fx.ORDER_COLUMNS), [])


@query
def mismatch_values(spark, sf_dir):
    key = ["o_orderkey"]
    pairs = compare.pair_mismatches(_saved_diff(spark, sf_dir), fx.ORDER_COLUMNS, key)
    return compare.mismatch_values(pairs, fx.ORDER_COLUMNS, key)


@query
def checksum_sample(spark, sf_dir):
    src, _ = _texts(spark, sf_dir)
    return compare.checksum_sample(src, fx.ORDER_COLUMNS)


def _summary(spark, sf_dir):
    src, tgt = fx.orders_pair(spark, sf_dir)
    tgt = tgt.drop("o_orderstatus").withColumn("o_note", F.lit("x"))
    return validate(src, tgt, key=["o_orderkey"], source_table="orders", target_table="a.orders")


@query
def validation_summary(spark, sf_dir):
    return _summary(spark, sf_dir).summary.select(
        "validation_report",
        "source_table",
        "target_table",
        "result",
        "source_count",
        "target_count",
        "difference",
        "mismatch_count",
        "mismatch_percent",
        F.concat_ws(",", "mismatched_columns").alias("mismatched_columns"),
    )


@query
def schema_diff(spark, sf_dir):
    return _summary(spark, sf_dir).schema


@query
def validation_text(spark, sf_dir):
    """Rendered text of all checks; numbers of checksums, which only Spark's hash gives, are an n."""
    summary = _summary(spark, sf_dir).summary
    value = F.regexp_replace("value", r": [0-9]+-[0-9]+", ": n")
    return summary.select("validation_report", value.alias("value"), "remarks")


@query
def summary_files(spark, sf_dir):
    """A summary written as CSV and JSON lines, and both read back."""
    root = scratch_path(spark, "summary")
    write_summary(_summary(spark, sf_dir).summary, root)
    columns = ["validation_report", "source_table", "target_table", "result", "remarks"]
    text = spark.read.option("header", True).option("escape", '"').csv(f"{root}/csv")
    lines = docs.read_summaries(spark, root)
    return (
        text.select(F.lit("csv").alias("kind"), *columns)
        .unionByName(lines.select(F.lit("json").alias("kind"), *columns))
        .withColumn("remarks", F.coalesce("remarks", F.lit("")))
    )


@query
def validation_verdict(spark, sf_dir):
    """Verdicts of a clean archive of order lines and a defective one of orders."""
    lines = fx.table(spark, sf_dir, "lineitem")
    good = archive_rows(lines, fx.POLICY, False, fx.AS_OF)
    clean = validate(lines, good, source_table="lineitem", target_table="a.lineitem")
    return verdict(clean.summary.unionByName(_summary(spark, sf_dir).summary))


# ---- blobs ----


def _blob_source(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.encode("html", "UTF-8").alias("body"),
    )
    texts = fx.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.encode("text", "UTF-8").alias("body"),
    )
    whole = pages.unionByName(texts)
    bare = whole.select(
        F.concat("id", F.when(F.col("id").startswith("p"), F.lit("-empty")).otherwise(F.lit("-null"))).alias("id"),
        F.expr("CASE WHEN id LIKE 'p%' THEN X'' END").alias("body"),
    )
    return whole.unionByName(bare)


def _linked(spark, sf_dir):
    return blob_store.extract_blobs(
        _blob_source(spark, sf_dir), "s3://vault/", "Archive_X", "OWNER", "pages"
    )


@query
def blob_links(spark, sf_dir):
    return _linked(spark, sf_dir).select("id", "body_s3_path")


@query
def blob_table(spark, sf_dir):
    """Contents are stored once: the second run adds none."""
    db = fx.fresh_database(spark, "blobs")
    linked = staged(_linked(spark, sf_dir), "linked")
    blob_store.write_blobs(linked, db)
    blob_store.write_blobs(linked, db)
    return blob_store.stored_blobs(spark, db).select("sha256", "ext", "length")


@query
def blob_readback(spark, sf_dir):
    db = fx.fresh_database(spark, "blobs")
    linked = staged(_linked(spark, sf_dir), "linked")
    blob_store.write_blobs(linked, db)
    links = linked.filter("body_s3_path IS NOT NULL").select(
        naming.uri_parts(F.col("body_s3_path"))["key"].alias("key")
    )
    lost = _blob_source(spark, sf_dir).select(
        F.concat(F.lit("blobs/none/"), F.sha2("id", 256), F.lit("%2Bx.png")).alias("key")
    )
    found = blob_store.read_blobs(spark, db, links.unionByName(lost))
    return found.select("key", "path", "length", "status", "content_type", "file_name", "body")


# ---- names ----


@query
def object_addresses(spark, sf_dir):
    url = F.col("url")
    parts = naming.uri_parts(url)
    return fx.table(spark, sf_dir, "pages").select(
        "page_id",
        parts["bucket"].alias("bucket"),
        parts["key"].alias("key"),
        naming.unquote(F.concat(parts["key"], F.lit("+%C3%A9%20x"))).alias("unquoted"),
    )


@query
def archive_names(spark, sf_dir):
    sql = F.concat(F.lit("select * \n  From Owner."), F.col("c_mktsegment"), F.lit(" t where 1=1"))
    name = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return fx.table(spark, sf_dir, "customer").select(
        "c_custkey",
        naming.archive_db(F.lower("c_mktsegment")).alias("db"),
        naming.archive_table(F.lit("OWNER"), F.col("c_name")).alias("name"),
        naming.archive_path(
            F.lit("s3://vault//"), F.lit("c"), F.lit("OWNER"), F.col("c_name")
        ).alias("path"),
        naming.archive_segment(name, sql).alias("segment"),
        naming.first_from_table(sql).alias("first_table"),
    )


# ---- rules ----


@query
def plan_match(spark, sf_dir):
    sources = rule_ops.rule_sources(fx.rules(spark, sf_dir))
    return rule_ops.match_rules(sources, fx.catalogue(spark, sf_dir)).select(
        F.col("name").alias("source_name"), "schema", "table", "condition"
    )


@query
def plan_exclude(spark, sf_dir):
    return rule_ops.exclude(fx.catalogue(spark, sf_dir), ["BUILDING_1", ".*_[0-9]*4$", "ACHINERY"])


@query
def plan_enriched(spark, sf_dir):
    return plan(fx.rules(spark, sf_dir), fx.catalogue(spark, sf_dir))


@query
def plan_from_file(spark, sf_dir):
    """The rules document written to a file, read back, and planned."""
    path = scratch_path(spark, "rules")
    rules = fx.rules(spark, sf_dir)
    rules.select(F.to_json(F.struct(*rules.columns)).alias("value")).coalesce(1).write.text(path)
    planned = plan(docs.read_rules(spark, path), fx.catalogue(spark, sf_dir))
    return planned.groupBy("source_name", "retention_policy_value", "legal_hold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("query").alias("n_queries"), F.count("condition").alias("n_conditions")
    )


@query
def plan_refusals(spark, sf_dir):
    """One document of which some sources, schemas and entries are broken and the others good."""
    document = fx.broken_document(spark, sf_dir)
    planned = plan_documents(document, fx.catalogue(spark, sf_dir))
    return planned.select("source_name", "source_schema", "source_table", "query", "target_table", "refused")


@query
def plan_collisions(spark, sf_dir):
    """Tables whose archive names differ only by case."""
    both = fx.catalogue(spark, sf_dir)
    twice = both.unionByName(
        both.filter("table LIKE 'BUILDING_1%'").withColumn("table", F.initcap("table"))
    )
    named = twice.select(
        F.lit("archive_x").alias("target_db"),
        naming.archive_table(F.col("schema"), F.col("table")).alias("target_table"),
    )
    return rule_ops.target_collisions(named)


@query
def rule_violations(spark, sf_dir):
    return rule_ops.rule_violations(fx.documents(spark, sf_dir, fx.DOCUMENT_TEXT), ("doc_id",))


@query
def purge_target_violations(spark, sf_dir):
    return rule_ops.purge_target_violations(
        fx.documents(spark, sf_dir, fx.PURGE_TEXT), ("doc_id",)
    )


# ---- archive and purge ----


@query
def archive_condition(spark, sf_dir):
    """A conditioned table, archived through its plan row and read back."""
    conn, db = fx.landing(spark, sf_dir)
    target = fx.fresh_database(spark, "flow")
    row = (db, "orders", None, "o_orderstatus = 'F'", target, "SRC_Orders")
    plan_row = fx.plan_rows(spark, [row]).head()
    archive(spark, plan_row, conn, fx.AS_OF, basis="o_orderdate")
    return read_archive(spark, target, "SRC_Orders", condition="o_totalprice > 1000")


@query
def archive_empty_source(spark, sf_dir):
    """A source without rows succeeds and makes no table; one that fails makes none either."""
    conn, db = fx.landing(spark, sf_dir)
    target = fx.fresh_database(spark, "empty")
    rows = [
        (db, "orders", None, "o_orderkey < 0", target, "SRC_None"),
        (db, "orders", None, "o_orderstatus = 'F'", target, "SRC_Some"),
        (db, "no_such_table", None, None, target, "SRC_Missing"),
    ]
    runs = archive_many(spark, fx.plan_rows(spark, rows), conn, fx.AS_OF, max_parallel=3)
    # One row for each table of the new database.
    made = spark.createDataFrame([(t,) for t in list_tables(spark, target)], "made string")
    name = F.col("script_args")[reporting.ARG_TABLE]
    return runs.join(made, F.lower(name) == F.col("made"), "left").select(
        name.alias("name"), "status", "rows", F.col("made").isNotNull().alias("has_table")
    )


@query
def drop_database(spark, sf_dir):
    """An archive dropped with its tables: what was there, and that its name is gone."""
    db = fx.archive_database(spark, sf_dir, "drop")
    counts = {t: spark.table(f"{db}.{t}").count() for t in list_tables(spark, db)}
    dropped = drop_archive_db(spark, db, confirm="DELETE")
    left = spark.catalog.databaseExists(db)
    return spark.createDataFrame([(t, counts[t], left) for t in dropped], "name string, n_rows bigint, db_exists boolean")


@query
def purge_by_targets(spark, sf_dir):
    """Discovery, then delete, for every target of a purge document."""
    path, plans = scratch_path(spark, "targets"), scratch_path(spark, "plans")
    dbs = [fx.archive_database(spark, sf_dir, f"target{i}") for i in range(2)]
    targets = [
        {"source_name": f"src{i}", "connection": db.removeprefix("archive_"), "max_parallel_tables": i + 1}
        for i, db in enumerate(dbs)
    ]
    text = spark.createDataFrame([(json.dumps({"targets": targets}, indent=1),)], "value string")
    text.coalesce(1).write.text(path)
    read = docs.read_purge_targets(spark, path)
    purging.run_targets(spark, "discovery", read, plans, as_of=fx.AS_OF)
    done = purging.run_targets(spark, "delete", read, plans)
    return done.select("source_name", "table", "status", "estimated_rows_deleted", "rows_deleted", "remaining_expired_rows")


@query
def expired_rows(spark, sf_dir):
    rows = fx.archived(spark, sf_dir, "orders", "o_orderdate", fx.HOLD_ORDERS)
    return rows.filter(expired(fx.AS_OF)).select("o_orderkey", "retention_expires_at", "legal_hold")


@query
def discover_expired(spark, sf_dir):
    db = fx.archive_database(spark, sf_dir, "discover")
    return purging.discover_expired(spark, db, fx.AS_OF).select(
        "table_name", "status", "reason", "estimated_rows_to_delete", "as_of"
    )


@query
def discovery_summary(spark, sf_dir):
    db = fx.archive_database(spark, sf_dir, "discover")
    return purging.discovery_summary(purging.discover_expired(spark, db, fx.AS_OF))


def _purged(spark, sf_dir):
    db = fx.archive_database(spark, sf_dir, "purge")
    found = purging.discover_expired(spark, db, fx.AS_OF)
    return db, purging.purge_many(spark, purging.purge_plan(found, "src"))


@query
def purge_results(spark, sf_dir):
    _, results = _purged(spark, sf_dir)
    return results.drop("timestamp")


@query
def purge_summary(spark, sf_dir):
    _, results = _purged(spark, sf_dir)
    return purging.purge_summary(results)


@query
def purge_survivors(spark, sf_dir):
    db, _ = _purged(spark, sf_dir)
    return spark.table(f"{db}.src_orders").select("o_orderkey", "retention_expires_at", "legal_hold")


@query
def purge_survivors_lineitem(spark, sf_dir):
    """Survivors per month and hold flag of the largest table."""
    db, _ = _purged(spark, sf_dir)
    kept = spark.table(f"{db}.src_lineitem")
    return kept.groupBy("expiry_month", "legal_hold").agg(
        F.count(F.lit(1)).alias("n"), F.min("retention_expires_at").alias("first_expiry")
    )


@query
def purge_survivors_unpartitioned(spark, sf_dir):
    db = fx.fresh_database(spark, "flat")
    rows = fx.archived(spark, sf_dir, "orders", "o_orderdate", fx.HOLD_ORDERS)
    write_archive(rows, f"{db}.flat")
    purging.purge_table(spark, f"{db}.flat", fx.AS_OF)
    return spark.table(f"{db}.flat").select("o_orderkey", "retention_expires_at", "legal_hold")


@query
def purge_far_dates(spark, sf_dir):
    """Rows that never expire, by a basis or a period of thousands of years, outlive a purge."""
    db = fx.fresh_database(spark, "far")
    orders = fx.table(spark, sf_dir, "orders")
    never = orders.withColumn(
        "o_orderdate",
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN timestamp_ntz'9999-12-31' ELSE o_orderdate END"),
    )
    store(archive_rows(never, "1y", F.expr(fx.HOLD_ORDERS), fx.AS_OF, basis="o_orderdate"), f"{db}.orders")
    ages = archive_rows(orders, "8100y", False, fx.AS_OF, basis="o_orderdate")
    store(ages, f"{db}.orders", mode="append")
    deleted = purging.purge_table(spark, f"{db}.orders", fx.AS_OF)
    kept = spark.table(f"{db}.orders")
    return kept.groupBy("legal_hold", F.year("retention_expires_at").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.lit(deleted).cast("bigint").alias("deleted")
    )


@query
def purge_appended(spark, sf_dir):
    """Two runs into one table, a purge, and the first run's orders appended once more."""
    db = fx.fresh_database(spark, "append")
    rows = fx.archived(spark, sf_dir, "orders", "o_orderdate", fx.HOLD_ORDERS)
    done, other = rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus <> 'F'")
    store(done, f"{db}.orders")
    store(other, f"{db}.orders", mode="append")
    purging.purge_table(spark, f"{db}.orders", fx.AS_OF)
    store(done, f"{db}.orders", mode="append")
    return spark.table(f"{db}.orders").groupBy("expiry_month", "legal_hold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query
def saved_purge_plan(spark, sf_dir):
    """Plans of two sources; saving one again replaces only that one."""
    db, path = fx.archive_database(spark, sf_dir, "plan"), scratch_path(spark, "plans")
    found = purging.discover_expired(spark, db, fx.AS_OF)
    for source, plan_rows in (("a", found), ("b", found.limit(0)), ("a", found)):
        write_purge_plan(purging.purge_plan(plan_rows, source), path)
    return docs.read_purge_plan(spark, path, "a").select(
        "source_name", "table_name", "estimated_rows_to_delete", "as_of"
    )


# ---- registry and report ----


@query
def config_registry(spark, sf_dir):
    """Each region's source is registered by two runs; the later one counts."""
    path, rules = scratch_path(spark, "registry"), fx.rules(spark, sf_dir)
    register_config(registrations(rules, "run-1", "2024-01-01"), path)
    register_config(registrations(rules, "run-2", "2024-02-01"), path)
    newest = docs.latest_config(spark.read.parquet(path))
    sources = docs.parse_rules(newest, "config").select(F.explode("sources").alias("s"))
    customers = fx.catalogue(spark, sf_dir).groupBy("schema").agg(F.count(F.lit(1)).alias("tables"))
    schemas = sources.select("s.name", F.explode("s.include.schemas.name").alias("schema"))
    runs = newest.select("source_name", "env", "dag_run_id", "archival_date")
    return (
        runs.join(schemas.distinct(), F.col("source_name") == F.col("name"))
        .join(customers, "schema")
        .drop("name")
    )


@query
def latest_config(spark, sf_dir):
    registrations = fx.table(spark, sf_dir, "orders").selectExpr(
        "'source_' || CAST(o_custkey AS STRING) AS source_name",
        "lower(o_orderstatus) AS env",
        "'run-' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS dag_run_id",
        "o_orderdate AS archival_date",
        "o_orderpriority AS config",
    )
    return docs.latest_config(registrations)


@query
def latest_summary(spark, sf_dir):
    return reporting.latest_by_type(fx.summaries(spark, sf_dir)).select(
        "target_table", "validation_report", "result", "value", "seq"
    )


@query
def job_durations(spark, sf_dir):
    jobs = reporting.job_metadata(*fx.runs(spark, sf_dir))
    return reporting.job_rows(jobs)


@query
def report_rows(spark, sf_dir):
    jobs = reporting.job_metadata(*fx.runs(spark, sf_dir))
    return reporting.report(fx.summaries(spark, sf_dir), jobs)


@query
def legacy_counts(spark, sf_dir):
    return report_text.parse_legacy_counts(fx.summaries(spark, sf_dir)).select(
        "seq", "source_count", "target_count", "validated_count", "mismatch_count", "mismatch_percent"
    )


def _legacy_columns(spark, sf_dir, report):
    """Older text about the columns of each customer's table."""
    value = {
        report_text.SCHEMA_REPORT: "'source_columns: [''id'', ''' || c_mktsegment || '''], "
        "target_columns: [''id'', ''' || if(c_acctbal < 0, 'legal', c_mktsegment) || ''']'",
        report_text.COLUMN_REPORT: "'source_column_checksum: [id: ' || md5(c_name) || ', seg: ' || "
        "md5(c_mktsegment) || '], target_column_checksum: [id: ' || md5(c_name)  || "
        "if(c_acctbal < 0, '', ', seg: ' || md5(lower(c_mktsegment))) || ']'",
    }[report]
    return fx.table(spark, sf_dir, "customer").selectExpr(
        f"'{report}' AS validation_report", "c_name AS target_table", f"{value} AS value"
    )


@query
def report_schema_rows(spark, sf_dir):
    return reporting.schema_rows(_legacy_columns(spark, sf_dir, report_text.SCHEMA_REPORT))


@query
def report_checksum_rows(spark, sf_dir):
    return reporting.checksum_rows(_legacy_columns(spark, sf_dir, report_text.COLUMN_REPORT))


@query
def report_odd_columns(spark, sf_dir):
    """Lines of a saved summary whose column names hold what the text parts lists with."""
    src, tgt = fx.orders_pair(spark, sf_dir)
    odd = {"o_totalprice": "total, price", "o_orderpriority": "[prio]", "o_custkey": "cust: key"}
    src, tgt = src.withColumnsRenamed(odd), tgt.withColumnsRenamed(odd).drop("o_orderstatus")
    root = scratch_path(spark, "odd")
    write_summary(validate(src, tgt, target_table="a.orders").summary, f"{root}/validation_summary")
    saved = docs.read_summaries(spark, root)
    columns, sums = reporting.schema_rows(saved), reporting.checksum_rows(saved)
    sums = sums.select("target_table", "column", F.col("result").alias("checksum_result"))
    return columns.join(sums, ["target_table", "column"], "left")


@query
def report_mismatch_rows(spark, sf_dir):
    """Mismatched rows of two tables, validated and saved by two runs, as lines of one report."""
    db, target = fx.fresh_database(spark, "pairs_src"), fx.fresh_database(spark, "pairs")
    src, tgt = fx.orders_pair(spark, sf_dir)
    src.write.saveAsTable(f"{db}.orders")
    tgt.write.saveAsTable(f"{target}.src_orders")
    nation = fx.table(spark, sf_dir, "nation")
    nation.write.saveAsTable(f"{db}.nation")
    renamed = F.expr("if(n_nationkey < 9, n_name || 'X', n_name)")
    nation.withColumn("n_name", renamed).write.saveAsTable(f"{target}.src_nation")
    root = scratch_path(spark, "pairs")
    for name, key in (("orders", "o_orderkey"), ("nation", "n_nationkey")):
        row = (db, name, None, None, target, f"SRC_{name}")
        validate_many(spark, fx.plan_rows(spark, [row]), fx.Connection(name="landing"), root, key=[key])
    lines = reporting.mismatch_rows(docs.read_pairs(spark, root))
    return lines.select(
        F.substring_index("target_table", ".", -1).alias("target_table"),
        F.concat_ws(",", F.map_values("key")).alias("key"),
        "rank", "column", "source_value", "target_value", "result",
    )


@query
def report_legacy_mismatches(spark, sf_dir):
    """Mismatched records that older summaries hold in their text, source beside target."""
    summaries = fx.table(spark, sf_dir, "orders").selectExpr(
        "'row_checksum_validation' AS validation_report",
        "'t' || CAST(o_orderkey AS STRING) AS target_table",
        "'Mismatched checksums: 1 rows (1.0%). Records: ' || CASE WHEN o_orderstatus = 'P' THEN '[broken' ELSE "
        "'[{\"source_row\": {\"record\": {\"k\": ' || CAST(o_custkey AS STRING) || ', \"p\": \"' || o_orderpriority "
        "|| '\"}, \"checksum\": \"' || md5(o_orderpriority) || '\"}}' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE "
        "', {\"target_row\": {\"record\": {\"k\": ' || CAST(o_custkey AS STRING) || ', \"s\": \"it, is]\"}, "
        "\"checksum\": \"c\"}}' END END || ']' AS remarks",
    )
    return reporting.mismatch_rows(reporting.legacy_pairs(summaries)).drop("key")


@query
def archive_validate_report(spark, sf_dir):
    """Three plan rows through archiving, validation and the report."""
    conn, db = fx.landing(spark, sf_dir)
    target = fx.fresh_database(spark, "report")
    asked = (
        f"SELECT c_custkey, c_name, n_name FROM {db}.customer JOIN {db}.nation "
        "ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'"
    )
    plan_rows = fx.plan_rows(
        spark,
        [
            (db, "orders", None, "o_orderstatus = 'F'", target, "SRC_Orders"),
            (db, "lineitem", None, None, target, "SRC_Lineitem"),
            (db, None, asked, None, target, "SRC_Customers"),
        ],
    )
    archive_runs = archive_many(spark, plan_rows, conn, fx.AS_OF, max_parallel=3)
    root = scratch_path(spark, "reports")
    validate_runs = validate_many(spark, plan_rows, conn, root, max_parallel=3)
    jobs = reporting.job_metadata(
        archive_runs.select(*reporting.JOB_COLUMNS), validate_runs.select(*reporting.JOB_COLUMNS)
    )
    rows = reporting.report(docs.read_summaries(spark, root), jobs)
    counts = archive_runs.select(
        F.col("script_args")[reporting.ARG_TABLE].alias("name"), F.col("rows").alias("rows_archived")
    )
    return (
        rows.withColumn("name", F.substring_index("target_table", ".", -1))
        .join(counts, "name")
        .select("name", "rows_archived", "archive_runs", "validate_runs", "validation_report",
                "result", "severity")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive orders with a per-row expiry, read the table back, count what is expired by hold."""
    db = fx.fresh_database(spark, "entry")
    rows = fx.archived(spark, sf_dir, "orders", "o_orderdate", fx.HOLD_ORDERS)
    store(rows, f"{db}.orders")
    back = read_archive(spark, db, "orders")
    return back.groupBy("legal_hold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(expired(fx.AS_OF)).alias("n_expired")
    )


@query
def archive_expired_by_hold(spark, sf_dir):
    return flagship(spark, sf_dir)
