"""Binary cells as content-addressed rows, written once and read back by key.

A store is a row of tables, its levels, each bucketed by digest and with GROWTH times the buckets of
the one before. An append goes to the smallest level that has room for it; when none has, a new level
is begun. So the buckets keep their size however large the store grows, no content is ever moved
again, and every join by digest takes the stored bytes where they lie.
"""

from __future__ import annotations

import math
import threading
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from coldkeep.functions.blobs import (
    LINK_SUFFIX,
    binary_columns,
    blob_folder,
    blob_link,
    download_envelope,
    link_digest,
    link_extension,
)
from coldkeep.functions.naming import unquote
from coldkeep.session import staged
from coldkeep.sources.tables import list_tables

BLOB_TABLE = "blob_objects"
BUCKET_BYTES = 256 * 1024 * 1024
#: Buckets of the first level, and how many times those of one level the next one has.
FIRST_BUCKETS = 4
GROWTH = 16
#: Digests to add that are sent to every task; more are joined.
MOST_BROADCAST = 2_000_000
HOT_COPIES = 10_000
HOT_SHARE = 10_000  # a hot content holds more than this part of all cells
SALTS = 64

# One writer of this driver at a time adds to the store of a database; the jobs themselves use the
# whole cluster. Writers of other drivers may add the same content at the same time: readers take one.
_WRITERS: dict[str, threading.Lock] = defaultdict(threading.Lock)


def extract_blobs(df: DataFrame, root: str, db: str, schema: str, segment: str) -> DataFrame:
    """All columns, then one link per binary column. Links depend on the content alone."""
    taken = {c.lower() for c in df.columns} & {f"{c}{LINK_SUFFIX}".lower() for c in binary_columns(df)}
    if taken:
        raise ValueError(f"source columns have the names of link columns: {sorted(taken)}")
    links = [
        blob_link(F.lit(blob_folder(root, db, schema, segment, c)), F.col(f"`{c}`")).alias(
            f"{c}{LINK_SUFFIX}"
        )
        for c in binary_columns(df)
    ]
    return df.select("*", *links)


def blob_cells(df: DataFrame) -> DataFrame:
    """(sha256, ext, length, content) of every linked cell. The digest is read from the link."""
    cells = [
        F.struct(F.col(f"`{c}{LINK_SUFFIX}`").alias("link"), F.col(f"`{c}`").alias("content"))
        for c in binary_columns(df)
    ]
    link = F.col("link")
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(link.isNotNull())
        .select(
            link_digest(link).alias("sha256"),
            link_extension(link).alias("ext"),
            F.octet_length("content").cast("bigint").alias("length"),
            "content",
        )
    )


def blob_digests(df: DataFrame) -> DataFrame:
    """The digest of every linked cell; only the link columns are read."""
    links = F.array(*[F.col(f"`{c}{LINK_SUFFIX}`") for c in binary_columns(df)])
    return df.select(F.explode(links).alias("link")).select(
        link_digest(F.col("link")).alias("sha256")
    ).filter("sha256 IS NOT NULL")


@dataclass(frozen=True)
class Level:
    name: str
    buckets: int


def blob_levels(spark: SparkSession, db: str) -> list[Level]:
    """The tables of a store, the smallest first; their names tell their buckets."""
    begin = f"{BLOB_TABLE}_"
    sizes = [t.removeprefix(begin) for t in list_tables(spark, db) if t.startswith(begin)]
    return [Level(f"{db}.{begin}{n}", n) for n in sorted(int(n) for n in sizes if n.isdigit())]


def _once(level: DataFrame) -> DataFrame:
    """One row for each digest of a level, in place: the level is bucketed by it."""
    return level.dropDuplicates(["sha256"])


def stored_blobs(spark: SparkSession, db: str) -> DataFrame:
    """One row for each content of a store: sha256, ext, length, content."""
    found, before = None, None
    for level in blob_levels(spark, db):
        rows = _once(spark.table(level.name))
        if before is not None:
            rows = rows.join(before, "sha256", "left_anti")
        held = spark.table(level.name).select("sha256")
        before = held if before is None else before.unionByName(held)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], "sha256 string, ext string, length bigint, content binary")
    return found


def hot_digests(digests: DataFrame) -> DataFrame:
    """Contents with more than HOT_COPIES copies and a 1 / HOT_SHARE part of all cells.

    There are fewer than HOT_SHARE of them by the second condition. The set is staged, so that all
    who use it see the same one.
    """
    counts = digests.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies"))
    counts = staged(counts.filter(F.col("copies") > HOT_COPIES), "digests")
    total = digests.count() if counts.take(1) else 0
    return counts.filter(F.col("copies") * HOT_SHARE > total).select("sha256")


def distinct_blobs(cells: DataFrame, hot: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct content, partitioned by digest into `buckets`.

    The most frequent contents are cut to at most SALTS copies by a salted aggregate, so a file
    that a third of all rows hold does not send its bytes to one task from everywhere. All other
    contents have few copies and are shuffled once.
    """
    hot = F.broadcast(hot)  # bounded: fewer than HOT_SHARE digests
    cold = cells.join(hot, "sha256", "left_anti")
    salted = cells.join(hot, "sha256", "left_semi").withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))
    )
    thinned = salted.groupBy("sha256", "salt").agg(
        *[F.first(c).alias(c) for c in ("ext", "length", "content")]
    )
    few = cold.unionByName(thinned.drop("salt"))
    return few.repartition(buckets, "sha256").dropDuplicates(["sha256"])


def write_blobs(linked: DataFrame, db: str) -> int:
    """Add the contents a linked table refers to and the store lacks; returns how many.

    Digests meet the store first, without any content: only cells whose content is lacking are read
    for their bytes and shuffled, to the buckets of the level that takes them. Doing it twice adds
    nothing, and moves no bytes. Writers of one driver wait for each other.
    """
    if not binary_columns(linked):
        return 0
    with _WRITERS[db.lower()]:
        return _write_blobs(linked, db)


def lacking_digests(linked: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The digests of a linked table that no level holds."""
    digests = blob_digests(linked).distinct()
    for level in levels:
        digests = digests.join(level.select("sha256"), "sha256", "left_anti")
    return digests


def lacking_cells(linked: DataFrame, lacking: DataFrame, n_lacking: int) -> DataFrame:
    """The cells whose content is to be added.

    The cells stay where they are, unless the digests are too many for every task: then all cells
    are shuffled to meet them.
    """
    lacking = F.broadcast(lacking) if n_lacking <= MOST_BROADCAST else lacking
    return blob_cells(linked).join(lacking, "sha256", "left_semi")


def _write_blobs(linked: DataFrame, db: str) -> int:
    spark = linked.sparkSession
    levels = blob_levels(spark, db)
    lacking = staged(lacking_digests(linked, [spark.table(v.name) for v in levels]), "lacking")
    n_lacking = lacking.count()
    if not n_lacking:
        return 0
    cells = lacking_cells(linked, lacking, n_lacking)
    counted = blob_digests(linked).join(lacking, "sha256", "left_semi")
    # The size of the cells, copies included, is what the level must have room for at most.
    size = cells.agg(F.sum("length")).head()[0] or 0
    level = _level_for(spark, db, levels, size)
    new = distinct_blobs(cells, hot_digests(counted), level.buckets)
    (
        new.write.mode("append")
        .bucketBy(level.buckets, "sha256")
        .sortBy("sha256")
        .format("parquet")
        .saveAsTable(level.name)
    )
    return n_lacking


def _level_for(spark: SparkSession, db: str, levels: list[Level], size: int) -> Level:
    """The smallest level with room for `size` more bytes, or a new one."""
    for level in levels:
        held = spark.table(level.name).agg(F.sum("length")).head()[0] or 0
        if held + size <= level.buckets * BUCKET_BYTES:
            return level
    buckets = levels[-1].buckets * GROWTH if levels else FIRST_BUCKETS
    while buckets * BUCKET_BYTES < size:
        buckets *= GROWTH
    return Level(f"{db}.{BLOB_TABLE}_{buckets}", buckets)


def export_blobs(linked: DataFrame, db: str) -> int:
    """Write every linked content to the address its link names; returns the number of files.

    Each address is written by one task from the store. A repeated task writes the same bytes to
    the same place.
    """
    spark = linked.sparkSession
    links = F.array(*[F.col(f"`{c}{LINK_SUFFIX}`") for c in binary_columns(linked)])
    wanted = linked.select(F.explode(links).alias("link")).filter("link IS NOT NULL").distinct()
    wanted = staged(wanted.withColumn("sha256", link_digest(F.col("link"))), "links")
    written = 0
    for level, asked in _by_level(spark, db, wanted.select("sha256")):
        files = wanted.join(asked, "sha256", "left_semi").join(_once(level), "sha256").select("link", "content")
        written += files.mapInArrow(_put_files, "n long").agg(F.sum("n")).head()[0] or 0
    return written


def _by_level(spark: SparkSession, db: str, digests: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(level, the digests to take from it): of levels that hold one content the first serves it.

    Digests alone meet the levels here; a level that serves none is left out.
    """
    rest, found = digests.distinct(), []
    levels = blob_levels(spark, db)
    for level in levels:
        held = spark.table(level.name).select("sha256")
        asked = rest.join(held, "sha256", "left_semi")
        if len(levels) > 1:
            asked = staged(asked, "asked")
            rest = rest.join(held, "sha256", "left_anti")
            if asked.isEmpty():
                continue
        found.append((spark.table(level.name), asked))
    return found


def _put_files(batches):
    import pyarrow as pa
    from pyarrow import fs

    stores = {}  # one client for each scheme and host
    for batch in batches:
        for link, content in zip(batch["link"].to_pylist(), batch["content"]):
            root, _, rest = link.partition("://")
            host, _, key = rest.partition("/")
            if (root, host) not in stores:
                store, path = fs.FileSystem.from_uri(link)
                stores[root, host] = store, path.removesuffix(key)
            store, folder = stores[root, host]
            path = folder + key
            if isinstance(store, fs.LocalFileSystem):
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(content.as_buffer())
        yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})


def blob_status(
    spark: SparkSession, db: str, keys: DataFrame, max_bytes: int | None = None
) -> DataFrame:
    """Requested keys with their blob: status 200, 404 without one, 413 beyond the size limit.

    One row per distinct key; the digest in the key finds the content. Digests alone tell which level
    serves which key; then keys go to the buckets of that level, whose bytes stay where they are.
    A content that very many keys ask for is joined in SALTS pieces.
    """
    wanted = keys.select("key").distinct().withColumn("path", unquote(F.col("key")))
    wanted = staged(wanted.withColumn("sha256", link_digest(F.col("path"))), "keys")
    asked = wanted.filter("sha256 IS NOT NULL")
    hot = F.broadcast(hot_digests(asked.select("sha256")))  # bounded: fewer than HOT_SHARE digests
    cold_keys, hot_keys = asked.join(hot, "sha256", "left_anti"), asked.join(hot, "sha256", "left_semi")
    pieces = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = hot_keys.withColumn("salt", F.pmod(F.hash("path"), F.lit(SALTS)))

    found = wanted.filter("sha256 IS NULL")
    served = None
    for level, digests in _by_level(spark, db, asked.select("sha256")):
        blobs = _once(level.select("sha256", "ext", "length", "content"))
        plain = cold_keys.join(digests, "sha256", "left_semi").join(blobs, "sha256")
        spread = salted.join(
            blobs.join(hot, "sha256", "left_semi").select("*", pieces), ["sha256", "salt"]
        ).join(digests, "sha256", "left_semi")
        found = found.unionByName(plain, allowMissingColumns=True).unionByName(
            spread.drop("salt"), allowMissingColumns=True
        )
        served = digests if served is None else served.unionByName(digests)
    lost = asked if served is None else asked.join(served, "sha256", "left_anti")
    found = found.unionByName(lost, allowMissingColumns=True)
    if served is None:
        found = found.withColumns(
            {"ext": F.lit(None).cast("string"), "length": F.lit(None).cast("bigint"),
             "content": F.lit(None).cast("binary")}
        )

    exists = F.coalesce(link_extension(F.col("path")) == F.col("ext"), F.lit(False))
    status = F.when(~exists, 404)
    if max_bytes is not None:
        status = status.when(F.col("length") > max_bytes, 413)
    return found.withColumn("status", status.otherwise(200)).select(
        "key",
        "path",
        F.when(exists, F.col("length")).alias("length"),
        "status",
        F.when(F.col("status") == 200, F.col("content")).alias("content"),
    )


def read_blobs(
    spark: SparkSession, db: str, keys: DataFrame, max_bytes: int | None = None
) -> DataFrame:
    """Download envelopes for the requested keys."""
    served = download_envelope(blob_status(spark, db, keys, max_bytes), key="path")
    only_served = {
        c: F.when(F.col("status") == 200, F.col(c))
        for c in ("content_type", "file_name", "content_disposition", "body")
    }
    return served.withColumns(only_served)
