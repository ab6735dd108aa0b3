"""Exact duplicates by sorting whole texts.

Texts are normalised (each run of white space becomes one space) and sorted over the cluster. Spark's
range partitioner samples splitters of bounded size - the first bytes of the text, its SHA-256, the
id - so texts that share a long beginning spread by digest and a group of copies spreads by id,
however large it is. Every task sorts its range externally, then compares each text with the one
before it, byte by byte, in one pass over Arrow batches; equal neighbours form a run. A group that
lies on both sides of a range's edge is joined up by comparing the last text of a range with the
first of the next one. Only the sizes of the runs at the edges, two for each range, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldkeep.llm.common import settled, tuned

#: Bytes of a text that a splitter holds.
SPLITTER_BYTES = 48
#: Text bytes of one range.
RANGE_BYTES = 32 << 20

RUNS = (
    "doc_id long, text_sha256 string, part int, run long, keep_id long, size long, leads boolean, head binary, tail binary"
)


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and carriage return as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range with the run of equal texts that they belong to.

    Of the run still open only ids and the digest are held, never texts.
    """
    part = TaskContext.get().partitionId()
    run, before = -1, None
    ids: list[pa.Array] = []  # of the open run
    digest = head = None

    def emitted(ids: pa.Array, digests: pa.Array, starts: np.ndarray, first: int, head, tail) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(ids)))
        runs = np.repeat(np.arange(first, first + len(starts)), sizes)
        leads = np.zeros(len(ids), bool)
        leads[starts] = True
        of_run = pa.array(np.repeat(starts, sizes))
        edge = lambda text, place: pa.array([text if i == place else None for i in range(len(ids))], pa.binary())
        nothing = pa.nulls(len(ids), pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                ids,
                digests.take(of_run),
                pa.array(np.full(len(ids), part, np.int32)),
                pa.array(runs),
                ids.take(of_run),
                pa.array(np.repeat(sizes, sizes)),
                pa.array(leads),
                nothing if head is None else edge(head, 0),
                nothing if tail is None else edge(tail, len(ids) - 1),
            ],
            names=[c.split()[0] for c in RUNS.split(", ")],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        text, key = batch.column("text"), batch.column("doc_id").cast(pa.int64())
        new = np.ones(batch.num_rows, bool)
        new[1:] = ~pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        if before is not None:
            new[0] = text[0].as_py() != before
        else:
            head = text[0].as_py()
        before = text[batch.num_rows - 1].as_py()
        starts = np.flatnonzero(new)
        if not len(starts):
            ids.append(key)
            continue
        if ids or starts[0]:
            ids.append(key[: starts[0]])
            whole = pa.concat_arrays(ids)
            yield emitted(whole, pa.array([digest]), np.zeros(1, np.int64), run, head, None)
            head = None
        closed = starts[-1]
        if closed:
            rows = slice(starts[0], closed)
            if closed > starts[0]:
                yield emitted(
                    key[rows], batch.column("text_sha256")[rows], starts[:-1] - starts[0], run + 1, head, None
                )
                head = None
        run += len(starts)
        ids, digest = [key[closed:]], batch.column("text_sha256")[closed].as_py()
    if ids:
        yield emitted(pa.concat_arrays(ids), pa.array([digest]), np.zeros(1, np.int64), run, head, before)


def _sorted(docs: DataFrame) -> DataFrame:
    text = normalised(F.col("text")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, size // RANGE_BYTES + 1)
    begin = F.substring("text", 1, SPLITTER_BYTES).alias("begin")
    keyed = rows.select("doc_id", "text", begin, F.sha2("text", 256).alias("text_sha256"))
    last = F.col("doc_id").asc_nulls_last()
    ranged = keyed.repartitionByRange(int(parts), "begin", "text_sha256", last)
    return ranged.sortWithinPartitions("begin", "text_sha256", "text", last).select("doc_id", "text", "text_sha256")


def _across(runs: DataFrame) -> DataFrame | None:
    """(part, run, keep_id, size, leads) of the runs that go on beyond the edge of their range."""
    heads, tails = runs.where("head is not null"), runs.where("tail is not null")
    sizes = ("part", "run", "keep_id", "size")
    # Two rows for each range.
    first = {r["part"]: r for r in heads.select(*sizes).collect()}
    last = {r["part"]: r for r in tails.select(*sizes).collect()}
    parts = sorted(first)
    if len(parts) < 2:
        return None
    spark = runs.sparkSession
    following = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, following int")
    met = (
        tails.select("part", "tail")
        .join(following, "part")
        .join(heads.select(F.col("part").alias("following"), "head"), "following")
        .where("tail = head")
    )
    joined = {r["following"] for r in met.select("following").collect()}
    chains: list[list] = []
    for p in parts:
        if p in joined:
            chains[-1].append(first[p])
        else:
            chains.append([first[p]])
        if last[p]["run"] != first[p]["run"]:
            chains.append([last[p]])
    rows = [
        (r["part"], r["run"], chain[0]["keep_id"], sum(m["size"] for m in chain), r is chain[0])
        for chain in chains
        if len(chain) > 1
        for r in chain
    ]
    return spark.createDataFrame(rows, "part int, run long, keep_all long, size_all long, leading boolean") if rows else None


def content_groups(docs: DataFrame) -> DataFrame:
    """Each row's group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    A null text is an empty one; empty texts are one group. Every row has one result row. Exactly one
    row of a group is kept, the one of the smallest doc_id; of rows that repeat this doc_id, one. Null
    ids come after all others: they stay only where the whole group has none, and keep_id is null then.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    tuned(docs.sparkSession)
    runs = settled(_sorted(docs).mapInArrow(_runs, RUNS), "content-runs")
    across = _across(runs)
    plain = runs.select("doc_id", "keep_id", "size", "leads", "text_sha256", "part", "run")
    if across is None:
        whole = plain.select("doc_id", "keep_id", F.col("size").alias("group_size"), F.col("leads").alias("kept"), "text_sha256")
        return whole
    # At most two rows for each range.
    found = plain.join(F.broadcast(across), ["part", "run"], "left")
    spans = F.col("size_all").isNotNull()
    return found.select(
        "doc_id",
        F.when(spans, F.col("keep_all")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size_all", "size").alias("group_size"),
        (F.col("leads") & F.coalesce("leading", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows that `content_groups` keeps, with all their columns.

    Of rows with one id and equal normalised texts an arbitrary one stands for all.
    """
    kept = content_groups(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"))
    digest = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    own = docs.withColumn("_digest", digest)
    same = own["doc_id"].eqNullSafe(kept["_id"]) & (own["_digest"] == kept["_digest"])
    return own.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).drop("_digest")
