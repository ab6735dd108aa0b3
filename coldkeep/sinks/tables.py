"""Archive databases and tables in the Spark catalog.

Built-in Parquet tables are written to a fresh folder and then switched to it, a partitioned table
partition by partition: the name is there at every moment, and a run cut short can be repeated. Only
where a replaced table changes its columns is the old one dropped first. Catalogs that support
row-level changes get their own statements.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from coldkeep.sources.tables import list_tables

SESSION_CATALOG = "spark_catalog"


def is_row_level(spark: SparkSession, name: str) -> bool:
    """True for tables in a configured catalog that is not the session's Parquet one."""
    parts = name.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return catalog != SESSION_CATALOG


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def database_location(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def table_folder(spark: SparkSession, name: str) -> str:
    db, table = name.lower().split(".")[-2:]
    return f"{database_location(spark, db)}/{table}"


def write_archive(
    df: DataFrame,
    name: str,
    mode: str = "replace",
    partition_by: Sequence[str] = (),
    empty: bool = False,
) -> int:
    """Create, replace or extend an archive table; returns the rows written.

    Without rows nothing is created or replaced, unless `empty` says that no rows is the result.

    The data is read once. With `partition_by` on skewed or scattered values the write is
    rebalanced, so that a large partition is split over tasks and small ones do not multiply files.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown write mode: {mode!r}")
    spark, name = df.sparkSession, name.lower()
    if is_row_level(spark, name):
        return _write_row_level(df, name, mode, partition_by)

    exists = spark.catalog.tableExists(name)
    if mode == "append" and exists:
        before, columns = spark.table(name).count(), spark.table(name).columns
        if set(columns) != set(df.columns):
            raise ValueError(f"columns of {name} differ: {sorted(set(columns) ^ set(df.columns))}")
        if partition_columns(spark, name):
            # New partitions go to a fresh folder: files of a dropped partition must not come back.
            fresh = f"{table_folder(spark, name)}/{uuid.uuid4().hex}"
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
        df.select(*_quoted(columns)).write.insertInto(name)
        spark.catalog.refreshTable(name)
        return spark.table(name).count() - before

    stage = f"{table_folder(spark, name)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(stage)
    ordered = [c for c in df.columns if c not in partition_by] + list(partition_by)
    written = spark.read.schema(df.select(*_quoted(ordered)).schema).parquet(stage)
    rows = written.count()  # from the Parquet footers
    if rows or empty:
        _switch(spark, name, written, stage, partition_by, exists)
    else:
        remove_folder(spark, stage)
    return rows


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _write_row_level(df: DataFrame, name: str, mode: str, partition_by: Sequence[str]) -> int:
    if df.isEmpty():
        return 0
    if mode == "append" and df.sparkSession.catalog.tableExists(name):
        before = df.sparkSession.table(name).count()
        df.writeTo(name).append()
        return df.sparkSession.table(name).count() - before
    writer = df.writeTo(name)
    if partition_by:
        writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
    writer.createOrReplace()
    return df.sparkSession.table(name).count()


def _switch(
    spark: SparkSession,
    name: str,
    written: DataFrame,
    stage: str,
    partition_by: Sequence[str],
    exists: bool,
) -> None:
    """Point the table at the staged folder; only metadata changes.

    Partitions are switched one after the other: readers meanwhile see old and new ones, a repeated
    run puts all of them right. Other columns need another table of the same name.
    """
    alike = exists and spark.table(name).schema == written.schema
    if alike and list(partition_by) != partition_columns(spark, name):
        alike = False
    if alike and not partition_by:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{stage}'")
    elif alike:
        for statement in switch_statements(spark, name, stage, len(partition_by)):
            spark.sql(statement)
    else:
        # Partitions are registered under a passing name, so the old table is there until the end.
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema.fields)
        parts = f"PARTITIONED BY ({', '.join(_quoted(partition_by))})" if partition_by else ""
        passing = f"{name}_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {passing} ({fields}) USING parquet {parts} LOCATION '{stage}'")
        if partition_by:
            spark.sql(f"ALTER TABLE {passing} RECOVER PARTITIONS")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {passing} RENAME TO {name}")
    spark.catalog.refreshTable(name)


#: Partitions that one statement adds or drops.
BATCH = 200


def switch_statements(spark: SparkSession, name: str, stage: str, depth: int) -> list[str]:
    """Statements that replace a table's partitions by those below a folder: the new ones are added
    first, those that stay are pointed to their new folder, and the others dropped last."""
    fs, root = _file_system(spark, stage)
    folders = {"": root}
    for _ in range(depth):
        below = {}
        for text, folder in folders.items():
            for status in fs.listStatus(folder):
                step = status.getPath().getName()
                if status.isDirectory() and "=" in step:
                    below[f"{text}/{step}" if text else step] = status.getPath()
        folders = below
    old = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    spec = {text: f"PARTITION ({partition_spec(text)})" for text in {*old, *folders}}
    added = [f"{spec[t]} LOCATION '{folders[t]}'" for t in sorted(folders) if t not in old]
    gone = [spec[t] for t in sorted(old) if t not in folders]
    batches = lambda items: [items[i : i + BATCH] for i in range(0, len(items), BATCH)]
    return [
        *[f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(some)}" for some in batches(added)],
        *[f"ALTER TABLE {name} {spec[t]} SET LOCATION '{folders[t]}'" for t in sorted(folders) if t in old],
        *[f"ALTER TABLE {name} DROP IF EXISTS {', '.join(some)}" for some in batches(gone)],
    ]


PURGE_FOLDER = "_purge_"
MANIFEST = "_files"


def replace_files(spark: SparkSession, name: str, files: Sequence[str], rows: DataFrame) -> int:
    """Replace some files of an unpartitioned table by the given rows; returns how many these are.

    The rows are written to a hidden folder of the table. A list of the files that they replace makes
    the change final: from then on `finish_replacing` carries it out, after a crash in the next run.
    All other files keep their names and times.
    """
    home = _location(spark, name)
    folder = f"{home}/{PURGE_FOLDER}{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    kept = spark.read.schema(rows.schema).parquet(folder).count()
    fs, passing = _file_system(spark, f"{folder}/{MANIFEST}_new")
    out = fs.create(passing, False)
    out.write(bytearray("\n".join(file_name(f) for f in files).encode()))
    out.close()
    fs.rename(passing, _file_system(spark, f"{folder}/{MANIFEST}")[1])
    finish_replacing(spark, name)
    return kept


def finish_replacing(spark: SparkSession, name: str) -> None:
    """Carry out replacements of files that are final, and remove what unfinished ones have left.

    New files come in before old ones go: a reader in between may see a row twice, but none is missing.
    """
    fs, home = _file_system(spark, _location(spark, name))
    path = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(home):
        folder = status.getPath()
        if not (status.isDirectory() and folder.getName().startswith(PURGE_FOLDER)):
            continue
        listed = path(folder, MANIFEST)
        if fs.exists(listed):
            names = spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(listed), "UTF-8").split("\n")
            for new in fs.listStatus(folder):
                if not re.match(r"[_.]", new.getPath().getName()):
                    fs.rename(new.getPath(), path(home, new.getPath().getName()))
            for old in names:
                fs.delete(path(home, old), False)
        fs.delete(folder, True)
    spark.catalog.refreshTable(name)


def file_name(address: str) -> str:
    return unquote(address.rsplit("/", 1)[1])


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _file_system(spark: SparkSession, folder: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def _location(spark: SparkSession, name: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect()
    # For a partition its own location comes first, then the table's.
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def live_folders(spark: SparkSession, name: str) -> set[str]:
    """Folders the catalog reads a table's files from: its own, or those of its partitions."""
    if not partition_columns(spark, name):
        return {_folder_path(spark, _location(spark, name))}
    parts = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {
        _folder_path(spark, _location(spark, name, f"PARTITION ({partition_spec(p[0])})"))
        for p in parts
    }


def _folder_path(spark: SparkSession, location: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(location).toUri().getPath()


def partition_spec(text: str) -> str:
    """`a=1/b=x` as the literal list of a PARTITION clause."""
    pairs = (item.split("=", 1) for item in text.split("/"))

    def literal(value: str) -> str:
        if value == "__HIVE_DEFAULT_PARTITION__":
            return "null"
        plain = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{plain}'"

    return ", ".join(f"`{unquote(k)}`={literal(v)}" for k, v in pairs)


def remove_superseded(spark: SparkSession, name: str) -> int:
    """Delete folders of a table that the catalog no longer reads; run while nobody uses the table."""
    fs, folder = _file_system(spark, table_folder(spark, name))
    live, home = live_folders(spark, name), _folder_path(spark, _location(spark, name))

    def sweep(parent) -> int:
        removed = 0
        for status in fs.listStatus(parent):
            path = status.getPath().toUri().getPath()
            if not status.isDirectory() or path in live:
                continue
            if path == home or any(kept.startswith(path + "/") for kept in live):
                removed += sweep(status.getPath())
            else:
                fs.delete(status.getPath(), True)
                removed += 1
        return removed

    return sweep(folder) if fs.exists(folder) else 0


def drop_archive_db(spark: SparkSession, db: str, confirm: str) -> list[str]:
    """Drop every table of a database with its files, then the database."""
    if confirm != "DELETE":
        raise ValueError("type DELETE to confirm")
    dropped = list_tables(spark, db)
    for table in dropped:
        name = f"{db}.{table}"
        folder = None if is_row_level(spark, name) else table_folder(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")
        if folder:
            remove_folder(spark, folder)
    spark.sql(f"DROP DATABASE IF EXISTS {db}")
    return dropped
