"""Near-duplicate vectors by NN-descent on a neighbour graph, and exact links within what it finds.

The graph starts from small blocks of vectors that agree in the signs of random projections. Each
round joins, at every vector, its neighbours and some vectors it is a neighbour of, and keeps the
best K of everybody: neighbours of neighbours. Edges of at least the threshold, verified in double
precision, connect components. A list whose K entries all reach the threshold is saturated: there
may be more links than it can hold. Such nodes are compared with all nodes of other components, and
inside a component all links are counted exactly: angles to the component's mean direction prove most pairs linked, by
the triangle inequality; the others are compared in blocks, of which only counts leave.

A bounded set of vectors is compared with all rows after that. Each vector that has links counts the
same, however many: while the mean share of links within components is less than LEAST_RECALL, the
rounds go on from other blocks. If AUDITS such audits do not reach it, the measured recall is raised.
Vectors are drawn until LINKED of them have links, DRAWS times at most; if none has, the recall is
unmeasured, and a warning says so.

Defined results: null, empty and zero vectors, vectors with null or non-finite components, and those
of another length than most link with nothing; equal vectors are one node that counts as often as it
occurs; rows that repeat a vec_id are vectors of their own; a row without a vec_id takes part in links,
is never the least of a component that has others, and is kept only where no other one is; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common
from coldkeep.llm.common import staged

log = logging.getLogger(__name__)

K = 12
TABLES, BLOCK = 8, 256
#: A round that improves less than this share of all entries is the last one; so is the last of ROUNDS.
STILL, ROUNDS = 0.02, 5
AUDITED, LEAST_RECALL, AUDITS = 256, 0.995, 40
#: Vectors with links that an audit wants, and how often it draws AUDITED more for that.
LINKED, DRAWS = 64, 16
#: Lists are enlarged by this factor at most; further audits only start from other blocks.
LONGER = 4
#: Angles are counted in so many bins up to the threshold's angle.
BINS = 2048
COMPARED = 512
#: Pivots that nodes of saturated lists are dealt to, and the most of their cells that are broadcast.
PIVOTS, MOST_CELLS = 1024, 100_000


def grouped(df: DataFrame, kernel: Callable[[pa.Table], pa.Table | None], schema: str, rows: int = 20_000) -> DataFrame:
    """Apply a kernel to tables of whole groups of `gid`; groups are of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            out = kernel(table.combine_chunks())
            if out is not None and out.num_rows:
                yield from out.to_batches(max_chunksize=4096)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                table = pa.Table.from_batches(held)
                gid = table.column("gid").to_numpy()
                # Rows are sorted: all groups but the last one are whole.
                last = int(np.flatnonzero(gid != gid[-1])[-1]) + 1 if gid[0] != gid[-1] else 0
                if last:
                    yield from emit(table.slice(0, last))
                    held = table.slice(last).to_batches()
        if held:
            yield from emit(pa.Table.from_batches(held))

    return df.repartition("gid").sortWithinPartitions("gid").mapInArrow(run, schema)


def matrix(column, dims: int, kind=np.float64) -> np.ndarray:
    """Rows of a binary column of packed numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, dims), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims)


def bounds(gid: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.append(True, gid[1:] != gid[:-1]))
    return zip(cuts.tolist(), [*cuts[1:].tolist(), len(gid)])


def local_join(k: int, dims: int, star: float | None) -> Callable[[pa.Table], pa.Table | None]:
    """The best k of each member among the members of its group, where they beat its worst entry.

    With `star`, members get the first member of at least that likeness as well, which ties blocks of
    like vectors together where lists can't hold them all.
    """

    def kernel(table: pa.Table) -> pa.Table | None:
        gid, node = table.column("gid").to_numpy(), table.column("node").to_numpy()
        worst = table.column("worst").to_numpy()
        x = matrix(table.column("v"), dims, np.float32)
        who, whom = [], []
        for lo, hi in bounds(gid):
            if hi - lo < 2:
                continue
            likeness = x[lo:hi] @ x[lo:hi].T
            np.fill_diagonal(likeness, -2)
            likeness[node[lo:hi, None] == node[None, lo:hi]] = -2
            n = min(k, hi - lo - 1)
            best = np.argpartition(-likeness, n - 1, axis=1)[:, :n]
            rows, columns = np.nonzero(np.take_along_axis(likeness, best, 1) > worst[lo:hi, None])
            who.append(rows + lo)
            whom.append(best[rows, columns] + lo)
            if star is not None:
                first = (likeness >= star).argmax(axis=1)
                tied = np.flatnonzero(likeness[np.arange(hi - lo), first] >= star)
                who.append(tied + lo)
                whom.append(first[tied] + lo)
        if not who:
            return None
        who, whom = np.concatenate(who), np.concatenate(whom)
        # Row by row, so that a pair's likeness is the same number in every block.
        exact = np.einsum("ij,ij->i", x[who].astype(np.float64), x[whom].astype(np.float64))
        return pa.table({"node": node[who], "sim": exact, "other": node[whom]})

    return kernel


def merged(entries: DataFrame, k: int) -> DataFrame:
    """Each node's k best distinct entries as an array of (sim, other)."""
    pairs = entries.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("sim", "other")), asc=False), 1, k)
    return pairs.groupBy("node").agg(best.alias("list"))


def unit_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows with the node of their vector (null without one); nodes with unit vector v; dimensions."""
    e = F.col("embedding").cast("array<double>")
    good = F.coalesce((F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, e).alias("e"))
    sizes = rows.where("e is not null").groupBy(F.size("e").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dims = sizes["d"] if sizes else 0
    # A null hash has no node; -0.0 equals 0.0.
    rows = rows.withColumn("e", F.when(F.size("e") == dims, F.transform("e", lambda x: x + F.lit(0.0))))
    rows = rows.withColumn("node", F.when(F.col("e").isNotNull(), F.xxhash64("e")))
    classes = rows.where("node is not null").groupBy("node").agg(F.first("e").alias("e"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("e").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            columns = [batch.column("node"), batch.column("copies"), batch.column("least"), pa.array([r.tobytes() for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "copies", "least", "v"])

    nodes = classes.mapInArrow(scaled, "node long, copies long, least long, v binary")
    return rows.select("vec_id", "node"), nodes, dims


def starting_lists(nodes: DataFrame, n: int, dims: int, k: int, star: float, seed: int) -> DataFrame:
    """Entries from blocks of vectors whose random projections agree in sign."""
    bits = max(0, min(40, int(np.ceil(np.log2(max(1, n / (BLOCK // 4)))))))
    planes = np.random.default_rng(seed).normal(size=(dims, TABLES * bits))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), dims)
            sign = (x @ planes > 0).reshape(len(x), TABLES, bits)
            key = (sign * (1 << np.arange(bits))).sum(axis=2) + (np.arange(TABLES) << 44)
            columns = [batch.column("node"), pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary()), pa.array(list(key), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "v", "keys"])

    keyed = staged(nodes.select("node", "v").mapInArrow(keys, "node long, v binary, keys array<long>"), "nn-keys")
    dealt = keyed.select("node", "v", F.explode("keys").alias("key"))
    # A crowded key is dealt into several blocks by a hash of the node.
    sizes = dealt.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node", "key"), F.col("parts"))
    blocks = dealt.join(sizes, "key").select(F.xxhash64("key", part).alias("gid"), "node", "v", F.lit(-2.0).alias("worst"))
    return grouped(blocks, local_join(k, dims, star), "node long, sim double, other long")


def one_round(lists: DataFrame, nodes32: DataFrame, dims: int, k: int, salt: int) -> DataFrame:
    """Entries that joining neighbours of neighbours found, better than the members' worst ones."""
    edges = lists.select("node", F.explode("list.other").alias("other"))
    indegree = edges.groupBy("other").agg(F.count("*").alias("n"))
    # A vector that is everybody's neighbour joins about 2k of them in this round, others in the next.
    back = edges.join(indegree, "other").where(F.pmod(F.xxhash64("node", "other", F.lit(salt)), F.col("n")) < 2 * k)
    members = edges.select(F.col("node").alias("gid"), F.col("other").alias("node")).unionByName(
        back.select(F.col("other").alias("gid"), "node")
    ).unionByName(lists.select(F.col("node").alias("gid"), "node")).distinct()
    worst = F.when(F.size("list") >= k, F.element_at("list", -1)["sim"] + 1e-9).otherwise(F.lit(-2.0))
    known = nodes32.join(lists.select("node", worst.alias("worst")), "node", "left").select("node", "v", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    return grouped(members.join(known, "node").select("gid", "node", "v", "worst"), local_join(k, dims, None), "node long, sim double, other long")


def neighbour_lists(nodes: DataFrame, n: int, dims: int, k: int, threshold: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Final lists, and the entries of the start that reach the threshold."""
    narrow = lambda batches: (
        pa.RecordBatch.from_arrays([b.column("node"), pa.array([r.astype(np.float32).tobytes() for r in matrix(b.column("v"), dims)], pa.binary())], names=["node", "v"])
        for b in batches
    )
    nodes32 = staged(nodes.select("node", "v").mapInArrow(narrow, "node long, v binary"), "nn-vectors")
    start = common.settled(starting_lists(nodes, n, dims, k, threshold - 1e-5, seed), "nn-start")
    lists = common.settled(merged(start, k), "nn-lists")
    for salt in range(ROUNDS):
        found = common.settled(one_round(lists, nodes32, dims, k, salt), "nn-found")
        old = lists.select("node", F.explode("list").alias("e")).select("node", "e.sim", "e.other")
        new = common.settled(merged(old.unionByName(found.select("node", "sim", "other")), k), "nn-lists")
        kept = new.select("node", F.explode("list.other").alias("other")).join(old, ["node", "other"], "left_anti").count()
        lists = new
        if kept <= STILL * n * k:
            break
    return lists, start.where(F.col("sim") >= threshold - 1e-5)


def verified(pairs: DataFrame, nodes: DataFrame, dims: int, threshold: float) -> DataFrame:
    both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("v").alias("va")), "a").join(nodes.select(F.col("node").alias("b"), F.col("v").alias("vb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likeness = np.einsum("ij,ij->i", matrix(batch.column("va"), dims), matrix(batch.column("vb"), dims))
            yield batch.select(["a", "b"]).filter(pa.array(likeness >= threshold))

    return both.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def exact_counts(members: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(node, links): rows of other nodes of the same component that reach the threshold.

    members: node, component, copies, v.
    """
    wide = np.arccos(threshold)
    step = wide / BINS
    unpack = lambda batches: (
        pa.RecordBatch.from_arrays([b.column("component"), pa.array(list(matrix(b.column("v"), dims)), pa.list_(pa.float64()))], names=["component", "x"]) for b in batches
    )
    arrays = members.select("component", "v").mapInArrow(unpack, "component long, x array<double>")
    mean = arrays.groupBy("component").agg(F.array(*[F.sum(F.col("x")[i]) for i in range(dims)]).alias("mean"))

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), dims)
            c = batch.column("mean").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
            angle = np.arccos(np.clip(np.einsum("ij,ij->i", x, c), -1, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("node", "component", "copies", "v")), pa.array((angle / step).astype(np.int32))], names=["node", "component", "copies", "v", "bin"])

    schema = "node long, component long, copies long, v binary, bin int"
    placed = common.settled(members.join(mean, "component").select("node", "component", "copies", "v", "mean").mapInArrow(angles, schema), "nn-angles")

    # Bins x and y with x + y <= sure hold only linked pairs; the margin covers rounding.
    sure = BINS - 3
    counts = placed.groupBy("component", "bin").agg(F.sum("copies").alias("n"))
    whole = counts.groupBy("component").agg(F.collect_list(F.struct("bin", "n")).alias("bins"), F.max("bin").alias("most"))
    within = lambda limit: F.aggregate(F.filter("bins", lambda b: b["bin"] <= limit), F.lit(0).cast("long"), lambda s, b: s + b["n"])
    proven = counts.join(whole, "component").select("component", "bin", within(F.lit(sure) - F.col("bin")).alias("proven"), (F.col("bin") + F.col("most") > sure).alias("open"))
    known = placed.join(proven, ["component", "bin"])
    # The own class is among the proven ones if its bin is; it is counted apart.
    own = F.when(2 * F.col("bin") <= sure, F.col("copies")).otherwise(0)
    base = known.select("node", (F.col("proven") - own).alias("links"))

    open_ = known.where("open").select("node", "component", "copies", "v", "bin")
    parts = open_.groupBy("component").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = open_.join(parts, "component").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other")).alias("gid"), "node", "copies", "v", "bin", "mine")

    def compare(table: pa.Table) -> pa.Table | None:
        gid, node, copies = (table.column(n).to_numpy() for n in ("gid", "node", "copies"))
        bins, mine = table.column("bin").to_numpy(), table.column("mine").to_numpy()
        x = matrix(table.column("v"), dims)
        who, links = [], []
        for lo, hi in bounds(gid):
            linked = (x[lo:hi] @ x[lo:hi].T >= threshold) & (bins[lo:hi, None] + bins[None, lo:hi] > sure)
            if mine[lo:hi].min() != mine[lo:hi].max():  # a block of two parts counts pairs across them
                linked &= mine[lo:hi, None] != mine[None, lo:hi]
            np.fill_diagonal(linked, False)
            who.append(node[lo:hi])
            links.append(linked @ copies[lo:hi])
        return pa.table({"node": np.concatenate(who), "links": np.concatenate(links)})

    more = grouped(dealt, compare, "node long, links long")
    return base.unionByName(more).groupBy("node").agg(F.sum("links").alias("links"))


def bridges(nodes: DataFrame, placed: DataFrame, full: DataFrame, dims: int, threshold: float) -> DataFrame | None:
    """a, b: for each other component that nodes of saturated lists (full: node) link to, such pairs.

    Saturated nodes of a component are cells around their nearest pivots. A node is compared with a
    cell of another component where the triangle inequality leaves room, in blocks, of which one pair
    for each two components leaves. The number of pivots decides how much is compared, not what is found.
    """
    wide = float(np.arccos(threshold)) + 1e-6
    every = nodes.join(placed, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "v")
    every = common.settled(every.join(full.withColumn("full", F.lit(True)), "node", "left"), "nn-every")
    pivots = np.zeros((0, dims))
    for row in every.where("full").orderBy(F.xxhash64("node")).limit(PIVOTS).collect():
        v = np.frombuffer(row["v"])
        if not len(pivots) or (pivots @ v).max() < np.cos(wide / 2):
            pivots = np.vstack([pivots, v])
    if not len(pivots):
        return None
    angles = lambda b: np.arccos(np.clip(matrix(b.column("v"), dims) @ pivots.T, -1, 1))
    fields = ["node", "component", "v"]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            angle = angles(b)
            yield pa.RecordBatch.from_arrays([*(b.column(f) for f in fields), pa.array(angle.argmin(axis=1).astype(np.int32)), pa.array(angle.min(axis=1))], names=[*fields, "pivot", "angle"])

    schema = "node long, component long, v binary, pivot int, angle double"
    cell = F.xxhash64("component", "pivot").alias("cell")
    asked = common.settled(every.where("full").select(*fields).mapInArrow(nearest, schema), "nn-asked")
    cells = asked.groupBy("component", "pivot").agg(F.max("angle").alias("radius")).select(cell, F.col("component").alias("home"), "pivot", "radius")
    cells = common.settled(cells, "nn-cells")
    reach = np.full(len(pivots), -np.inf)
    for row in cells.groupBy("pivot").agg(F.max("radius").alias("radius")).collect():
        reach[row["pivot"]] = row["radius"] + wide

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            angle = angles(b)
            rows, pivot = np.nonzero(angle <= reach)
            taken = [b.column(f).take(pa.array(rows)) for f in fields]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(pivot.astype(np.int32)), pa.array(angle[rows, pivot])], names=[*fields, "pivot", "angle"])

    small = F.broadcast(cells) if cells.count() <= MOST_CELLS else cells
    targets = every.select(*fields).mapInArrow(near, schema).join(small, "pivot").where((F.col("home") != F.col("component")) & (F.col("angle") <= F.col("radius") + wide))
    targets = common.settled(targets.select("cell", *fields), "nn-targets")
    theirs = targets.groupBy("cell").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("theirs"))
    asked = asked.select(cell, *fields)
    ours = asked.groupBy("cell").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("ours"))
    parts = common.settled(theirs.join(ours, "cell"), "nn-parts")
    part = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
    all_ = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    one = asked.join(parts, "cell").select("cell", *fields, part("ours").alias("p"), all_("theirs").alias("q"), F.lit(True).alias("asks"))
    two = targets.join(parts, "cell").select("cell", *fields, all_("ours").alias("p"), part("theirs").alias("q"), F.lit(False).alias("asks"))
    dealt = one.unionByName(two).select(F.xxhash64("cell", "p", "q").alias("gid"), *fields, "asks")

    def meet(table: pa.Table) -> pa.Table | None:
        gid, node, component = (table.column(n).to_numpy() for n in ("gid", "node", "component"))
        asks = table.column("asks").to_numpy()
        x = matrix(table.column("v"), dims)
        a, b = [], []
        for lo, hi in bounds(gid):
            mine, others = lo + np.flatnonzero(asks[lo:hi]), lo + np.flatnonzero(~asks[lo:hi])
            if not len(mine) or not len(others):
                continue
            linked = x[mine] @ x[others].T >= threshold
            hit = np.flatnonzero(linked.any(axis=0))
            hit = hit[np.unique(component[others[hit]], return_index=True)[1]]
            a.append(node[mine[linked[:, hit].argmax(axis=0)]] if len(hit) else node[:0])
            b.append(node[others[hit]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)}) if a else None

    return grouped(dealt, meet, "a long, b long")


def recall(nodes: DataFrame, placed: DataFrame, n: int, dims: int, threshold: float) -> float | None:
    """Mean share of the links of a node that lie within a component, for a bounded set of nodes.

    None where no node that was drawn has links.
    """
    spread = 1 << 30
    step = min(spread, int(spread * AUDITED / n) + 1)
    shares: list[float] = []
    for draw in range(DRAWS):
        if len(shares) >= LINKED or draw * step >= spread:
            break
        shares += _audited(nodes, placed, draw * step, (draw + 1) * step, spread, dims, threshold)
    return sum(shares) / len(shares) if shares else None


def _audited(nodes: DataFrame, placed: DataFrame, low: int, high: int, spread: int, dims: int, threshold: float) -> list[float]:
    """For each drawn node that has links, the share of them that lie within its component."""
    drawn = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(spread))
    asked = nodes.join(placed, "node", "left").where((drawn >= low) & (drawn < high)).select("node", "v", "component").limit(4 * AUDITED).collect()
    if not asked:
        return []
    queries = np.frombuffer(b"".join(r["v"] for r in asked), np.float64).reshape(-1, dims)
    names = np.array([r["node"] for r in asked])
    places = np.array([r["component"] if r["component"] is not None else r["node"] for r in asked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column("node").to_numpy()
            linked = (matrix(b.column("v"), dims) @ queries.T >= threshold) & (node[:, None] != names)
            same = linked & (b.column("place").to_numpy()[:, None] == places)
            hit = np.flatnonzero(linked.any(axis=0))
            columns = [pa.array(names[hit]), pa.array(linked.sum(axis=0)[hit], pa.int64()), pa.array(same.sum(axis=0)[hit], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "links", "found"])

    every = nodes.join(placed, "node", "left").select("node", "v", F.coalesce("component", "node").alias("place"))
    shares = every.mapInArrow(run, "name long, links long, found long").groupBy("name").agg((F.sum("found") / F.sum("links")).alias("share"))
    return [r["share"] for r in shares.select("share").collect()]


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, k: int = K) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, ...)."""
    rows, nodes, dims = unit_vectors(vectors)
    rows, nodes = staged(rows, "nn-rows"), staged(nodes, "nn-nodes")
    n = nodes.count()
    edges = placed = None
    for audit in range(AUDITS if n else 0):
        longer = k * min(1 << audit, LONGER)
        lists, start = neighbour_lists(nodes, n, dims, longer, threshold, seed=audit)
        entries = lists.select("node", F.explode("list").alias("e")).select("node", "e.other", "e.sim").where(F.col("sim") >= threshold - 1e-5)
        entries = entries.unionByName(start.select("node", "other", "sim"))
        pairs = entries.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        found = common.settled(verified(pairs, nodes, dims, threshold), "nn-edges")
        edges = found if edges is None else edges.unionByName(found)
        placed = common.settled(common.components(edges, "nn-cc"), "nn-cc")
        full = lists.where((F.size("list") >= longer) & (F.element_at("list", -1)["sim"] >= threshold - 1e-5)).select("node")
        more = bridges(nodes, placed, full, dims, threshold)
        more = None if more is None else common.settled(more, "nn-bridges")
        if more is not None and not more.isEmpty():
            edges = edges.unionByName(more)
            placed = common.settled(common.components(edges, "nn-cc"), "nn-cc")
        reached = recall(nodes, placed, n, dims, threshold)
        if reached is None:
            log.warning("recall unmeasured: none of the vectors that were drawn has links")
        if reached is None or reached >= LEAST_RECALL:
            break
    else:
        if n:
            raise RuntimeError(f"recall {reached:.4f} of links after {AUDITS} audits, {LEAST_RECALL} asked for")
    if placed is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    members = nodes.join(placed, "node").select("node", "component", "copies", "v")
    links = common.settled(exact_counts(members, dims, threshold), "nn-links")
    named = nodes.select("node", "copies", "least").join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "component").join(links, "node", "left")
    named = named.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(named, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), component.isNull()).alias("kept"))
