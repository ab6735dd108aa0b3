"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make every coordinate: a first one scatters the shingles over a universe of 2^32,
a second one is applied after a circular shift by the coordinate's number. Coordinates that agree
on a whole band propose links; links are confirmed on the full shingle sets.

Defined results: a null text or one without words has an empty set and no link; a text with fewer
words than a shingle has its whole sequence as its one shingle; rows that repeat a doc_id are one
document each in the set sense and share that id; a row without a doc_id is never the least of a group
that has others, and is kept only where its whole group has none; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common
from coldkeep.llm.common import staged

#: At a similarity of 0.8 a link stays unproposed once in 130,000; at 0.5, four pairs in five do.
BANDS, ROWS = 64, 8
#: Columns that identify a set of shingles.
SET = ("n_shingles", "c1", "c2")
#: Stands for a missing id: larger than every other.
NO_ID = (1 << 63) - 1
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))


def scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 2^32 universe."""
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    return x


def permute(x: np.ndarray) -> np.ndarray:
    """The second permutation, which is used circularly shifted; overwrites x."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


class Shingler:
    """Sorted distinct 64-bit shingle hashes of each text."""

    def __init__(self, words: int):
        self.words, self.hash = words, common.SpanHash(7, LOWER)

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        data, offsets = common.utf8(column)
        start, end = common.runs(~SPACES[data], offsets)
        word = self.hash(data, start, end)
        first = np.searchsorted(start, offsets)
        out = []
        for i in range(len(column)):
            mine = word[first[i] : first[i + 1]]
            width = min(self.words, len(mine))
            if not width:
                out.append(np.zeros(0, np.uint64))
                continue
            h = np.full(len(mine) - width + 1, width, np.uint64)
            for k in range(width):
                h = common.mix64(h * common.U64(0x9E3779B97F4A7C15) + mine[k : k + len(h)])
            out.append(np.unique(h))
        return out


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A band key for each non-empty set and band, from circulant MinHash coordinates."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keys = np.zeros((len(sets), bands), np.uint64)
    lo = 0
    while lo < len(sets):  # blocks that stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + 32768, side="right")) - 1)
        base = scatter((np.concatenate(sets[lo:hi]) >> common.U64(32)).astype(np.uint32))
        at = starts[lo:hi] - starts[lo]
        shifted = np.empty_like(base)
        for b in range(bands):
            key = np.full(hi - lo, b, np.uint64)
            for r in range(rows):
                np.add(base, np.uint32(b * rows + r), out=shifted)
                key = common.mix64(key * common.U64(0x9E3779B97F4A7C15) + np.minimum.reduceat(permute(shifted), at))
            keys[lo:hi, b] = key
        lo = hi
    return keys


def identity(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two 64-bit sums that stand for the whole set."""
    sums = [[common.mix64(s ^ common.U64(salt)).sum(dtype=np.uint64) for s in sets] for salt in (0xA5A5A5A5, 0x5DEECE66D)]
    return [pa.array([len(s) for s in sets], pa.int64()), *(pa.array(np.array(x, np.uint64).view(np.int64), pa.int64()) for x in sums)]


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, version, n_shingles, c1 and c2 (identity of the set), bands (array of keys)."""

    def make():
        shingle = Shingler(words)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle(batch.column("text"))
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            keys = signatures([sets[i] for i in full], BANDS, ROWS).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("version"),
                    *identity(sets),
                    common.lists(keys.ravel(), np.where(sizes > 0, BANDS, 0), pa.int64()),
                ],
                names=["doc_id", "version", "n_shingles", "c1", "c2", "bands"],
            )

        return kernel

    return common.arrow_map(docs, make, "doc_id long, version long, n_shingles long, c1 long, c2 long, bands array<long>", "text")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """node and the full set of shingle hashes; rows whose text has another set than node are left out."""

    def make():
        shingle = Shingler(words)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle(batch.column("text"))
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column("node"), *identity(sets), common.lists(values, np.array([len(s) for s in sets]), pa.int64())],
                names=["node", "n_shingles", "c1", "c2", "shingles"],
            )

        return kernel

    out = common.arrow_map(docs.select("node", "text"), make, "node long, n_shingles long, c1 long, c2 long, shingles array<long>", "text")
    return out.where(F.col("node") == F.xxhash64(*SET)).select("node", "shingles")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with sizes na and nb, size i of the intersection and both sets."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"), "sa", "sb"
    )


def linked(percent: int, i: str = "i", na: str = "na", nb: str = "nb") -> str:
    """SQL: the sets have a Jaccard similarity of at least percent / 100."""
    return f"100 * ({i}) >= {percent} * ({na} + {nb} - ({i}))"


def _outside_main(members: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Of groups that hold several components c: the members outside the largest, and all members.

    The first have the prefix x_ on their columns; is_main tells the members of the largest apart.
    """
    parts = members.groupBy(group, "c").agg(F.count("*").alias("size"))
    mixed = parts.groupBy(group).agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("parts"))
    every = members.join(mixed.where("parts > 1"), group).withColumn("is_main", F.col("c") == F.col("main")).drop("main", "parts")
    minor = every.where("not is_main").drop("is_main")
    return minor.select(group, *[F.col(k).alias(f"x_{k}") for k in minor.columns if k != group]), every


def _kept(component: Column, key: str) -> Column:
    """Whether a row stands for its component; a row without a key does where there is no other one."""
    return F.coalesce(component == F.col(key), component.isNull())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text, ...).

    Equal sets are one node first, so copies never meet in pairs. Each bucket's members are tested
    against the bucket's leader; members of one bucket that are still in different components
    after that are tested with each other, so that no proposed link is lost. There, differences
    to the leader stand for the sets of members close to it, and its distances exclude most pairs.
    """
    # A row is known by its id, or a number above all ids, and its text.
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")
    docs = docs.select(known, F.xxhash64("text").alias("version"), "text")
    # Nodes are identified by a 64-bit number of their set, its documents by the set's least id.
    sketch = staged(sketches(docs, words), "minhash").withColumn("node", F.xxhash64(*SET))
    full = sketch.where("n_shingles > 0")
    first = F.min(F.struct("doc_id", "version")).alias("first")
    nodes = full.groupBy("node").agg(first, F.min("n_shingles").alias("n"))
    nodes = nodes.select("node", "n", F.col("first.doc_id").alias("least"), F.col("first.version").alias("version"))
    owner = full.join(nodes.select("node", F.col("least").alias("doc_id"), "version"), ["node", "doc_id", "version"], "left_semi").dropDuplicates(["node"])
    member = owner.select("node", F.explode("bands").alias("key"))
    crowded = member.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = staged(member.join(crowded, "key"), "minhash-shared")
    # The leader of a bucket is its most central member: the one that meets most others in all its buckets.
    weight = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    shared = shared.select("key", "node").join(weight.join(nodes.select("node", "n"), "node"), "node")
    leaders = shared.groupBy("key").agg(F.max_by(F.struct("node", "n"), F.struct("weight", "node")).alias("lead"))
    bucket = shared.join(leaders, "key").select("key", "node", "n", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n"))
    bucket = staged(bucket, "minhash-buckets")
    star = bucket.where("node <> lead and 2 * least(n, lead_n) >= greatest(n, lead_n)")
    star = staged(star.select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), "minhash-star")

    # Full sets, only of documents that share a bucket with another one.
    wanted = bucket.select("node").distinct().join(nodes, "node").select("node", F.col("least").alias("doc_id"), "version")
    texts = docs.join(wanted, ["doc_id", "version"])
    sets = staged(shingle_sets(texts, words).dropDuplicates(["node"]), "minhash-sets")

    # The difference to the leader is kept where it is smaller than the sets.
    near = "2 * i >= na + nb - i"
    difference = F.when(F.expr(near), F.array_except(F.array_union("sa", "sb"), F.array_intersect("sa", "sb")))
    star = staged(compared(star, sets).select("a", "b", "na", "nb", "i", difference.alias("delta")), "minhash-compared")
    links = star.where(linked(percent)).select("a", "b")
    label = staged(common.components(links, "minhash-cc"), "minhash-cc")
    component = F.coalesce("component", "a").alias("c")

    # Members near the same leader: differences to it give each similarity exactly.
    close = star.where("delta is not null").join(label, F.col("a") == F.col("node"), "left")
    close = close.select(F.col("b").alias("lead"), F.col("a").alias("x"), component, F.col("na").alias("n"), "delta")
    minor, close = _outside_main(close, "lead")
    sum_of_both = "size(delta) + size(x_delta) - 2 * size(array_intersect(delta, x_delta))"
    close = minor.join(close, "lead").where("c <> x_c and (is_main or x_x < x)").where(
        f"100 * least(n, x_n) >= {percent} * greatest(n, x_n)"
    )
    close = close.where(linked(percent, f"(n + x_n - ({sum_of_both})) / 2", "n", "x_n"))
    more = close.select(F.col("x_x").alias("a"), F.col("x").alias("b")).distinct()

    # All other members of one bucket. Distances to the leader obey the triangle inequality; a
    # member whose size alone keeps it from the leader has at least the distance of the sizes.
    distance = star.select(F.col("a").alias("node"), F.col("b").alias("lead"), F.expr("1 - i / (na + nb - i)").alias("d"))
    placed = bucket.join(distance, ["node", "lead"], "left").join(label, "node", "left")
    placed = placed.where("node <> lead").select(
        "key",
        F.col("node").alias("x"),
        "n",
        F.coalesce("component", "node").alias("c"),
        F.coalesce("d", F.expr("1 - least(n, lead_n) / greatest(n, lead_n)")).alias("low"),
        F.coalesce("d", F.lit(1.0)).alias("high"),
    )
    minor, placed = _outside_main(staged(placed, "minhash-placed"), "key")
    apart = 1 - percent / 100 + 1e-9
    rest = minor.join(placed, "key").where(
        f"c <> x_c and (is_main or x_x < x) and 100 * least(n, x_n) >= {percent} * greatest(n, x_n)"
        f" and not (high <= 0.5 and x_high <= 0.5) and low - x_high <= {apart} and x_low - high <= {apart}"
    )
    rest = rest.select(F.col("x_x").alias("a"), F.col("x").alias("b")).distinct()
    more = staged(more.unionByName(compared(rest, sets).where(linked(percent)).select("a", "b")), "minhash-links")
    if not more.isEmpty():
        label = staged(common.components(links.unionByName(more), "minhash-cc"), "minhash-cc")

    # The least document of a component, from the least documents of its nodes.
    named = label.join(nodes, "node").select("node", "component", "least")
    lowest = named.groupBy("component").agg(F.min("least").alias("component_least"))
    of_node = nodes.join(named.join(lowest, "component").select("node", "component_least"), "node", "left").select(
        "node", F.coalesce("component_least", "least").alias("component_id")
    )
    out = sketch.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node"))).join(of_node, "node", "left")
    named = lambda c: F.when(c != NO_ID, c)
    component = named(F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", component).withColumn("doc_id", named(F.col("doc_id")))
    component = F.col("component_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), _kept(component, "doc_id").alias("kept"))
