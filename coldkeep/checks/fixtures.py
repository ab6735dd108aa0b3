"""Sources, archives and documents that the checks derive from the given tables.

The changed copies carry seeded defects at fixed keys, as the comparison operators must find them;
everything else is used whole.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from coldkeep.functions.naming import archive_segment
from coldkeep.plans.archive import archive_rows, dealt, store
from coldkeep.session import in_parallel, scratch_path
from coldkeep.sinks.tables import ensure_database
from coldkeep.sources.connections import Connection
from coldkeep.sources.documents import RULES

AS_OF = "1997-01-01"
POLICY = "6m"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, sf_dir: str) -> tuple[Connection, str]:
    """The given tables as a source database in the Spark catalog."""
    db = "landing_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
    ensure_database(spark, db, scratch_path(spark, db))
    for name in TABLES:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} USING parquet "
            f"LOCATION '{sf_dir}/{name}.parquet'"
        )
    return Connection(name="landing"), db


def plan_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Plan rows from (schema, table, query, condition, target database, target table)."""
    given = (
        "source_schema string, source_table string, query string, condition string, "
        "target_db string, target_table string"
    )
    segment = archive_segment(F.col("source_table"), F.col("query"))
    return spark.createDataFrame(rows, given).withColumns(
        {
            "source_name": F.lit("landing"),
            "connection": F.lit("landing"),
            "target_path": F.lit("s3://vault/"),
            "segment": segment,
            "retention_policy_value": F.lit(POLICY),
            "legal_hold": F.lit(False),
        }
    )


def fresh_database(spark: SparkSession, label: str) -> str:
    db = f"archive_{label}_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, scratch_path(spark, db))
    return db


# ---- orders and a defective copy; `sql` is the same pair for the oracle ----

ORDERS_SRC = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN nullif(o_orderpriority, '5-LOW') ELSE o_orderpriority END
           AS o_orderpriority
FROM {orders}"""

ORDERS_TGT = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM ({src}) s WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM ({src}) d WHERE o_orderkey % 103 = 0"""

ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)


def orders_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    src_sql = ORDERS_SRC.format(orders="{orders}")
    src = spark.sql(src_sql, orders=orders)
    return src, spark.sql(ORDERS_TGT.format(src="SELECT * FROM {src}"), src=src)


# ---- archives with a per-row expiry ----

HOLD_ORDERS = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 10 = 0 END"
HOLD_LINES = "l_returnflag = 'R'"
HOLD_EVENTS = "event_type = 'error'"


def archived(
    spark: SparkSession, sf_dir: str, name: str, basis: str, hold: str, policy: str = POLICY
) -> DataFrame:
    return archive_rows(table(spark, sf_dir, name), policy, F.expr(hold), AS_OF, basis=basis)


def store_archived(spark: SparkSession, sf_dir: str, target: str, name: str, basis: str, hold: str, policy: str = POLICY) -> int:
    """An archive table of `archived` rows."""
    rows = dealt(table(spark, sf_dir, name), policy, F.expr(hold), AS_OF, basis)
    return store(archive_rows(rows, policy, F.expr(hold), AS_OF, basis=basis), target, scattered=False)


def archive_database(spark: SparkSession, sf_dir: str, label: str) -> str:
    """An archive of orders, lineitem and events, and a table without retention columns."""
    db = fresh_database(spark, label)
    tables = [
        ("orders", "o_orderdate", HOLD_ORDERS, POLICY),
        ("lineitem", "l_shipdate", HOLD_LINES, "1y"),
        ("events", "ts", HOLD_EVENTS, "30d"),
    ]

    def fill(item: tuple) -> int:
        return store_archived(spark, sf_dir, f"{db}.src_{item[0]}", *item)

    in_parallel(spark, fill, tables, max_parallel=3)
    table(spark, sf_dir, "nation").write.saveAsTable(f"{db}.src_nation")
    return db


# ---- rules and a catalogue: one source per region, one schema per nation, a table per customer ----

CATALOGUE = """
SELECT n_name AS schema, c_mktsegment || '_' || CAST(c_custkey AS STRING) AS table
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        CATALOGUE,
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rules document with a source per region."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    entries = F.expr(
        """array(
            named_struct('name', 'BUILDING_1', 'regex', true, 'condition', 'FEED_ID < 10000',
                         'query', CAST(NULL AS STRING), 'target_table', CAST(NULL AS STRING)),
            named_struct('name', '(BUILDING|AUTOMOBILE)', 'regex', true, 'condition', '',
                         'query', NULL, 'target_table', NULL),
            named_struct('name', 'MACHINERY_7', 'regex', false, 'condition', 'A = 1',
                         'query', NULL, 'target_table', NULL),
            named_struct('name', 'MACHINERY_[0-9]*[05]$', 'regex', true, 'condition', NULL,
                         'query', NULL, 'target_table', NULL),
            named_struct('name', NULL, 'regex', NULL, 'condition', NULL,
                         'query', 'SELECT * FROM ' || n_name || '.HOLIDAYS',
                         'target_table', n_name || '_HOLIDAYS'))"""
    )
    sources = (
        nation.select(
            "r_name", F.struct(F.col("n_name").alias("name"), entries.alias("tables")).alias("s")
        )
        .groupBy("r_name")  # five regions, five nations each
        .agg(F.array_sort(F.collect_list("s"), lambda a, b: F.when(a["name"] < b["name"], -1).otherwise(1)).alias("schemas"))
    )
    source = F.expr(
        """named_struct('name', lower(r_name), 'connection', 'conn_' || lower(r_name),
            'warehouse', 'main', 'retention_policy', if(r_name = 'ASIA', 'long', 'short'),
            'legal_hold', r_name = 'EUROPE', 'consumer_roles', CAST(NULL AS ARRAY<STRING>),
            'include', named_struct('schemas', schemas),
            'exclude', named_struct('tables', array('AUTOMOBILE_2', '.*99$')))"""
    )
    document = sources.agg(F.collect_list(source).alias("sources")).select(
        F.lit("dev").alias("env"),
        F.expr(
            "map_from_entries(transform(sources, s -> struct(s.connection, s.connection || '_prod')))"
        ).alias("connections"),
        F.expr("map('main', 's3://vault//')").alias("warehouses"),
        F.expr("map('short', '6m', 'long', '7y')").alias("retention_policies"),
        "sources",
    )
    return document.select(F.from_json(F.to_json(F.struct("*")), RULES).alias("r")).select("r.*")


BROKEN_SOURCE = """
'{"name":"' || lower(r_name) || '","connection":"' || if(r_name = 'ASIA', 'nowhere', 'conn')
|| '","warehouse":"main","retention_policy":"' || if(r_name = 'AFRICA', 'forever', 'short')
|| '","legal_hold":' || if(r_name = 'EUROPE', '"yes"', 'false') || ',"include":{"schemas":['
|| array_join(transform(array_sort(collect_list(n_name)), n -> '{"name":"' || n || '","tables":' ||
   if(n IN ('BRAZIL', 'KENYA'), '{}', '[{"name":"BUILDING_1","regex":true,"condition":"x < 1"},'
   || '{"name":"MACHINERY","regex":true},{"query":"SELECT 1","target_table":"' || n || '_ONE"'
   || if(n IN ('CANADA', 'PERU'), ',"condition":"y"', '') || '},{"query":"SELECT 2","name":"both","target_table":"'
   || n || '_TWO"}]') || '}'), ',') || ']}}'"""


def broken_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rules document with a source per region, as JSON text; some of its parts are broken."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    sources = nation.groupBy("r_name").agg(F.expr(BROKEN_SOURCE).alias("source"))
    listed = F.concat_ws(",", F.array_sort(F.collect_list("source")))
    head = (
        '{"env":"dev","connections":{"conn":"prod"},"warehouses":{"main":"s3://vault/"},'
        '"retention_policies":{"short":"6m"},"sources":['
    )
    return sources.agg(F.concat(F.lit(head), listed, F.lit("]}")).alias("document"))


# ---- rules documents with defects, one per customer, as JSON text in both engines' SQL ----

DOCUMENT_TEXT = """
'{"env":"dev"' ||
CASE WHEN c_nationkey = 3 THEN '' ELSE ',"retention_policies":{"default_6m":"6m"}' END ||
',"warehouses":{"w":"s3://vault"},"connections":{"c1":"x","c2":"y"},"sources":[{"name":"s"' ||
',"warehouse":"' || CASE WHEN c_nationkey = 4 THEN 'nowhere' ELSE 'w' END || '"' ||
',"connection":' || CASE WHEN c_nationkey = 5 THEN '7' ELSE '"c1"' END ||
',"retention_policy":"default_6m"' ||
',"legal_hold":' || CASE c_mktsegment WHEN 'BUILDING' THEN '"true"' ELSE 'false' END ||
CASE WHEN c_nationkey = 6 THEN ',"consumer_roles":[]' WHEN c_nationkey = 7
     THEN ',"consumer_roles":["a"," "]' ELSE '' END ||
',"include":{"schemas":' || CASE WHEN c_nationkey = 8 THEN '[]' ELSE '[{' ||
  CASE WHEN c_nationkey = 9 THEN '' ELSE '"name":"OWNER",' END ||
  '"tables":' || CASE WHEN c_nationkey = 10 THEN '{"name":"FEED"}' ELSE
    '[{"name":"FEED","condition":"FEED_ID < ' || CAST(c_custkey AS {text}) || '"}' ||
    CASE WHEN c_acctbal < 0 THEN ',{"name":"A","query":"SELECT 1"}' ELSE '' END ||
    CASE WHEN c_acctbal > 9000 THEN ',{"query":"SELECT 1","condition":"x = 1"}' ELSE '' END ||
    CASE WHEN c_nationkey = 11 THEN ',{"name":"  "}' ELSE '' END ||
    ',{"query":"SELECT * FROM OWNER.B","target_table":"OWNER_B"}]' END ||
  '}]' END || '}}]}'"""

PURGE_TEXT = """
CASE WHEN c_nationkey = 1 THEN '{"targets":[]}' WHEN c_nationkey = 2 THEN '{"target":1}'
     WHEN c_nationkey = 3 THEN '{"targets":' ELSE
     '{"targets":[{"source_name":"s' || CAST(c_custkey AS {text}) || '"' ||
     CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"connection":"c"' END || '},' ||
     CASE WHEN c_acctbal < 0 THEN '{"connection":"c"}' ELSE
     '{"source_name":"t","connection":"d","max_parallel_tables":2}' END || ']}' END"""


def documents(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"), F.expr(text.replace("{text}", "STRING")).alias("document")
    )


# ---- job runs: archive runs from orders, validation runs from their customers ----

RUN_ARGS = (
    "map('--target_glue_db', 'archive_x', '--target_glue_table', 'T_' || CAST({key} AS STRING), "
    "'--source_schema', 'OWNER', '{kind}', 'Q' || CAST({key} AS STRING))"
)


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    archive_runs = orders.selectExpr(
        "'archive-job' AS job_name",
        "'ar-' || CAST(o_orderkey AS STRING) AS job_run_id",
        "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'Failed' ELSE 'RUNNING' END AS status",
        "CAST(o_orderdate AS TIMESTAMP) AS start_time",
        "CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, 0, 0, floor(o_totalprice / 100)) AS end_time",
        RUN_ARGS.format(key="o_custkey", kind="--source_table") + " AS script_args",
    )
    customer = table(spark, sf_dir, "customer")
    validate_runs = customer.selectExpr(
        "'validate-job' AS job_name",
        "'va-' || CAST(c_custkey AS STRING) AS job_run_id",
        "'SUCCEEDED' AS status",
        "TIMESTAMP '1999-01-01 00:00:00' AS start_time",
        "TIMESTAMP '1999-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_nationkey * 61) AS end_time",
        RUN_ARGS.format(key="c_custkey", kind="--query") + " AS script_args",
    )
    return archive_runs, validate_runs


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved summaries: two count checks per order, later ones replace earlier ones."""
    return table(spark, sf_dir, "orders").selectExpr(
        "'row_count_validation' AS validation_report",
        "'OWNER.Q' AS source_table",
        "'archive_x.T_' || CAST(o_custkey AS STRING) AS target_table",
        "if(o_orderstatus = 'O', 'failed', 'passed') AS result",
        "'source_table_count: ' || CAST(o_orderkey AS STRING) || ', target_table_count: ' "
        "|| CAST(o_orderkey + length(o_orderpriority) AS STRING) AS value",
        "if(o_orderstatus = 'O', 'Mismatched checksums: ' || CAST(o_orderkey AS STRING) || ' rows ('"
        " || CAST(length(o_orderpriority) AS STRING) || '.25%). Records: []', '') AS remarks",
        "o_orderkey AS seq",
    )
