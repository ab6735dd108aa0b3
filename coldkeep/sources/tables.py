"""Scans of source tables, archive tables and catalogues."""

from __future__ import annotations

import datetime as dt
import decimal
import logging
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coldkeep.sources.connections import Connection, jdbc_options, kind_of

log = logging.getLogger(__name__)

#: Share of a source's keys that are read for split points, and keys that the driver holds of them.
SAMPLE_SHARE = 0.01
MOST_SAMPLED = 100_000

# Where each database lists its tables.
POSTGRES_CATALOGUE = (
    "SELECT table_schema AS \"schema\", table_name AS \"table\" FROM information_schema.tables "
    "WHERE table_type = 'BASE TABLE' AND table_schema IN ({schemas})"
)
ORACLE_CATALOGUE = (
    "SELECT owner AS \"schema\", table_name AS \"table\" FROM all_tables WHERE owner IN ({schemas})"
)


def jdbc_table(
    table: str | None = None, query: str | None = None, condition: str | None = None
) -> str:
    """The `dbtable` option: a name, or a subquery that the database evaluates."""
    if bool(table) == bool(query):
        raise ValueError("give exactly one of table or query")
    if query:
        return f"({query.strip()}) t"
    if condition:
        return f"(SELECT * FROM {table} WHERE {condition}) t"
    return table


def read_source(
    spark: SparkSession,
    conn: Connection,
    table: str | None = None,
    query: str | None = None,
    condition: str | None = None,
) -> DataFrame:
    """A source table, optionally filtered, or the result of a query.

    A table or query the connection has `partitioning` for is read by many tasks: `partition_column`
    gives even ranges between its smallest and largest value, `split_column` ranges that hold about as
    many rows each, by quantiles of a sample that the database draws, and `predicates` one task per
    predicate. Without, the database is read through a single connection, and a warning says so.
    """
    dbtable = jdbc_table(table, query, condition)
    if conn.kind == "catalog":
        df = spark.sql(query) if query else spark.table(table)
        return df.filter(condition) if condition and not query else df

    options = {**jdbc_options(conn.url, conn.enforce_ssl, conn.cert_dn, conn.driver), **conn.options}
    if conn.user is not None:
        options |= {"user": conn.user, "password": conn.password or ""}
    split = conn.partitioning.get(table or (query or "").strip(), {})
    reader = spark.read.format("jdbc").options(**options)
    predicates = list(split.get("predicates", ()))
    if "split_column" in split:
        sample = sample_query(dbtable, split["split_column"], kind_of(conn.url).random, split.get("sample", SAMPLE_SHARE))
        drawn = reader.option("dbtable", sample).load().limit(MOST_SAMPLED)
        points = split_points([r[0] for r in drawn.collect()], int(split["num_partitions"]))
        predicates = split_predicates(split["split_column"], points)
    if predicates:
        url = options.pop("url")
        return spark.read.jdbc(url, dbtable, predicates=predicates, properties=options)
    if "partition_column" not in split:
        log.warning("%s is read through a single connection: no partitioning is given", table or "a query")
    if "partition_column" in split:
        low, high = _bounds(reader, dbtable, split["partition_column"])
        if low is not None:
            reader = reader.options(
                partitionColumn=split["partition_column"],
                lowerBound=low,
                upperBound=high,
                numPartitions=split["num_partitions"],
            )
    return reader.option("dbtable", dbtable).load()


def sample_query(dbtable: str, column: str, random: str, share: float) -> str:
    """The `dbtable` option that reads a random share of a source's keys; the database draws it."""
    if not random:
        raise ValueError("split_column needs a kind of database that is known; give predicates")
    source = dbtable if dbtable.startswith("(") else f"{dbtable} t"
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL AND {random} < {share}) s"


def split_points(sample: Sequence, parts: int) -> list:
    """Keys that cut the sample into parts of about equal size; a key that fills several is one cut."""
    drawn = sorted(v for v in sample if not (isinstance(v, float) and math.isnan(v)))
    cuts = (drawn[i * len(drawn) // parts] for i in range(1, parts)) if drawn else ()
    return sorted(set(cuts))


def split_predicates(column: str, points: Sequence) -> list[str]:
    """Predicates of which every row meets exactly one, whatever its key: ranges between the points,
    the first and last one open, and rows without a key."""
    if not points:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    marks = [_sql_literal(p) for p in points]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]}", *inner, f"{column} >= {marks[-1]}", f"{column} IS NULL"]


def _sql_literal(value) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no key to split by: {value!r}")
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def _bounds(reader, dbtable: str, column: str) -> tuple:
    source = dbtable if dbtable.startswith("(") else f"{dbtable} t"
    probe = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) b"
    row = reader.option("dbtable", probe).load().head()
    return str(row[0]) if row[0] is not None else None, str(row[1])


def source_catalogue(
    spark: SparkSession, conn: Connection, schemas: Sequence[str], connection: str | None = None
) -> DataFrame:
    """(schema, table) for the base tables of the given schemas, schemas spelled as given.

    With `connection`, the name that the rules document gives the connection, this is a column too:
    where several connections are listed, schemas of one name must not be mixed up.
    """
    listed = _catalogue(spark, conn, schemas).select("schema", "table")
    return listed.withColumn("connection", F.lit(connection)) if connection else listed


def _catalogue(spark: SparkSession, conn: Connection, schemas: Sequence[str]) -> DataFrame:
    if conn.kind == "catalog":
        found = spark.createDataFrame([], "schema string, table string")
        for schema in schemas:
            tables = spark.sql(f"SHOW TABLES IN {schema}").filter(~F.col("isTemporary"))
            tables = tables.select(F.lit(schema).alias("schema"), F.col("tableName").alias("table"))
            found = found.unionByName(tables)
        return found
    if conn.kind == "postgres":
        return read_source(spark, conn, query=POSTGRES_CATALOGUE.format(schemas=_quoted(schemas)))
    if conn.kind == "oracle":
        owners = [s.upper() for s in schemas]
        listed = read_source(spark, conn, query=ORACLE_CATALOGUE.format(schemas=_quoted(owners)))
        given = spark.createDataFrame([(s, s.upper()) for s in schemas], "name string, owner string")
        return listed.join(given, listed["schema"] == given["owner"]).select(
            given["name"].alias("schema"), "table"
        )
    raise ValueError(f"no catalogue query for {conn.url!r}")


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("'" + name.replace("'", "''") + "'" for name in names)


def query_over(df: DataFrame, sql: str, view: str = "src") -> DataFrame:
    """Run SQL over a DataFrame named `{view}` in the text, e.g. `SELECT * FROM {src}`."""
    return df.sparkSession.sql(sql, **{view: df})


def read_archive(
    spark: SparkSession, db: str, table: str, condition: str | Column | None = None
) -> DataFrame:
    df = spark.table(f"{db}.{table}".lower())
    return df if condition is None else df.filter(condition)


def list_tables(spark: SparkSession, db: str) -> list[str]:
    rows = spark.sql(f"SHOW TABLES IN {db}").filter(~F.col("isTemporary")).collect()
    return sorted(row["tableName"] for row in rows)


def columns_of(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns
