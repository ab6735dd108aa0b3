"""Helpers that several operators share: Arrow text access, hashing, staging, components."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldkeep.session import scratch_path
from coldkeep.sinks.tables import remove_folder

#: Text bytes that a task turns into numpy arrays at once; one longer document is taken whole.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: bounds what a Python worker holds of very long texts.
ARROW_ROWS = "512"

U64 = np.uint64


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that go to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Owner of what operators stage while it is in use; nothing else is ever removed with it.

    `with scratch.renewed(spark)` first removes what was staged in the block before, whose result must
    be written by then.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []

    @contextmanager
    def renewed(self, spark: SparkSession) -> Iterator[None]:
        self.clear(spark)
        before = _owner.set(self)
        try:
            yield
        finally:
            _owner.reset(before)

    def clear(self, spark: SparkSession) -> None:
        release(spark)
        while self.paths:
            remove_folder(spark, self.paths.pop())


_owner: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write once to the shared folder and read back. An owner in use may remove it, unless it is kept."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    owner = _owner.get()
    if owner is not None and not keep:
        owner.paths.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove staged frames that an operator has no more use for: all that it made of them is staged."""
    for df in frames:
        remove_folder(df.sparkSession, df.staged_at)


def settled(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Stage a result in the shared folder, then let Spark drop the shuffles that made it.

    Shuffle files go when their plan is collected as garbage; asking for that between the steps of
    a long operator keeps the disk to the largest step instead of the sum of all.
    """
    out = staged(df, label, keep)
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Let the driver drop what is garbage, and give the memory back: a model's training leaves much to its Python."""
    for _ in range(2):  # references are queued by one collection and gone by the next
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
    give_back(keep=True)


#: Rows are drawn for samples by so many values of a hash: enough for tables of any size.
SPREAD = 1 << 40


def drawn(*columns: str) -> Column:
    """A number below SPREAD for each row, by a hash of some columns."""
    h, half = F.xxhash64(*columns), 1 << 20
    return F.pmod(h, F.lit(half)) * half + F.pmod(F.shiftright(h, 20), F.lit(half))


def share_of(most: float, rows: int) -> int:
    """The bound below which `drawn` leaves about 1.2 times as many of the rows as are wanted; never none."""
    return min(SPREAD, int(SPREAD * most * 1.2 / max(1, rows)) + 1)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each hold about `size` bytes, at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and their offsets; a null text is an empty one."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values; runs end where a document ends."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (MurmurHash3's finaliser)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class SpanHash:
    """64-bit hashes of any spans of a byte array, by prefix sums of a polynomial modulo 2^64."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, seed: int, fold: np.ndarray | None = None):
        self.codes = np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64)
        if fold is not None:
            self.codes = self.codes[fold]
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            step = np.full(n, self.BASE, np.uint64)
            back = np.full(n, self.INVERSE, np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(step), np.cumprod(back)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of the bytes, which serve all spans of them."""
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self.inverses[start] + (end - start).astype(np.uint64))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.spans(self.sums(data), start, end)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b): columns node, component (least node).

    Alternates large-star and small-star steps. Both aggregate a minimum per node, with partial
    sums before the shuffle, and join it back by node, a join whose large keys AQE can split; no
    node's neighbours are gathered in one row. Every round is staged in the shared folder.
    """
    current = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        label,
    )
    seen = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        current = staged(small, label)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


#: What a worker keeps from task to task, by the step that made it.
_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """Something a worker keeps for the further tasks of a step; it ends when another step's begins."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def reuse_memory() -> None:
    """Let a worker use the memory of arrays of a few MB again, instead of mapping each anew; `give_back` ends a task."""
    if sys.platform == "linux":
        tune = getattr(ctypes.CDLL(None), "mallopt", None)  # of glibc
        if tune is not None:
            tune(-3, 32 << 20)  # M_MMAP_THRESHOLD
            tune(-1, 64 << 20)  # M_TRIM_THRESHOLD


def give_back(keep: bool = False) -> None:
    """Give the memory that a task has freed back to the system, and what the worker holds unless told to keep it.

    Workers outlive their tasks and wait beside the next ones, each with the largest heap that it ever had.
    """
    if not keep:
        _held.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)


def arrow_map(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    text: str,
    size: int = SLICE_BYTES,
    keep: bool = False,
) -> DataFrame:
    """`mapInArrow` over slices of bounded text; `make` builds the kernel once in each task.

    `keep` leaves what is `held` to the next task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in slices(batches, text, size):
            yield kernel(batch)
        del kernel
        give_back(keep)

    return df.mapInArrow(run, schema)
