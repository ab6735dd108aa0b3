"""Ranked search of many items at once, by common subexpressions.

The score of a document for an item is a sum of integers, one for each term of the item, and what a
term adds does not depend on the item. Items share terms, so sums over shared sets of terms are
worked out once:

1. `postings`: one pass over all texts leaves, for each document, its number of terms and the counts of
   those that some item holds; staged, far smaller than the texts.
2. Counts of documents, terms and documents by term come from the postings by plain aggregates.
3. `sharing`: terms that the same items hold are one atom; then the pair of nodes that most items have
   in common becomes a node of its own, again and again while two items share one. The result is a DAG:
   atoms at the bottom, shared sets above them, and for every item the few nodes that make it up.
4. Each task sums up the nodes of the DAG for a block of documents - every node once, whatever the
   number of items that use it - then the items, and keeps each item's best documents. These meet in
   two steps, so that no task ranks more of an item than its share.

Items are taken in blocks of `BLOCK`; the postings hold the terms of all blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldkeep.llm.common import settled, slices, tuned

#: Items of one DAG; every block reads the postings once.
BLOCK = 512
#: Distinct item terms that may go to the tasks. More than these need the items to be searched in parts.
MOST_TERMS = 2_000_000
#: Nodes of an item between which pairs are looked for, most shared first. Bounds the mining, not the result.
NEIGHBOURS = 64
#: Every item's best documents of all tasks are ranked in so many pieces: the square root of documents by this.
PIECE_DOCS = 20_000
#: Bytes of the sums that a task holds at once.
SUM_BYTES = 32 << 20

#: Letters, digits and all bytes beyond ASCII stay, A-Z as a-z; everything else parts terms.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def _posting_kernel(numbers: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, found, ends = [], [], []
            total = 0
            for text in batch.column("text").to_pylist():
                terms = terms_of(text)
                own = [i for i in map(numbers.get, terms) if i is not None]
                sizes.append(len(terms))
                found += own
                total += len(own)
                ends.append(total)
            doc = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
            pairs, times = np.unique(doc * len(numbers) + np.array(found, np.int64), return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(ends) + 1) * len(numbers))
            offsets = pa.array(offsets.astype(np.int32))
            terms = pa.ListArray.from_arrays(offsets, pa.array((pairs % len(numbers)).astype(np.int32)))
            tfs = pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), terms, tfs], names=["doc_id", "n", "terms", "tfs"]
            )

    return run


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and counts of the document's item terms."""
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as binary) as text")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _posting_kernel(shared.value)(batches)

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Sharing:
    """The DAG: node k < `atoms` is a set of terms, the others are sums of two earlier nodes."""

    def __init__(self, items: list[set[int]]):
        holders: dict[int, int] = {}  # term -> its items, as a bit mask
        for i, terms in enumerate(items):
            for t in terms:
                holders[t] = holders.get(t, 0) | 1 << i
        by_mask: dict[int, list[int]] = {}
        for t in sorted(holders):
            by_mask.setdefault(holders[t], []).append(t)
        masks = list(by_mask)
        self.atom_of = {t: k for k, mask in enumerate(masks) for t in by_mask[mask]}
        self.atoms = len(masks)
        self.pairs: list[tuple[int, int]] = []
        parts: list[set[int]] = [{self.atom_of[t] for t in terms} for terms in items]
        heap: list[tuple[int, int, int]] = []

        def offer(pairs):
            for a, b in pairs:
                shared = (masks[a] & masks[b]).bit_count()
                if shared > 1:
                    heapq.heappush(heap, (-shared, a, b))

        offered: set[tuple[int, int]] = set()
        for nodes in parts:
            often = sorted(nodes, key=lambda k: (-masks[k].bit_count(), k))
            for j, k in enumerate(often):
                offered.update((min(k, o), max(k, o)) for o in often[j + 1 : j + NEIGHBOURS])
        offer(sorted(offered))
        while heap:
            claimed, a, b = heapq.heappop(heap)
            both = masks[a] & masks[b]
            shared = both.bit_count()
            if shared < 2:
                continue
            if shared < -claimed:
                heapq.heappush(heap, (-shared, a, b))
                continue
            node = len(masks)
            masks.append(both)
            masks[a] &= ~both
            masks[b] &= ~both
            self.pairs.append((a, b))
            beside: set[int] = set()
            rest = both
            while rest:
                i = (rest & -rest).bit_length() - 1
                rest &= rest - 1
                parts[i] -= {a, b}
                beside.update(sorted(parts[i], key=lambda k: (-masks[k].bit_count(), k))[:NEIGHBOURS])
                parts[i].add(node)
            offer((k, node) for k in sorted(beside))
        self.parts = [sorted(p) for p in parts]
        # Nodes of one level need nodes of lower levels only: each level is one vector step.
        level = [0] * self.atoms
        for a, b in self.pairs:
            level.append(1 + max(level[a], level[b]))
        made = np.array(level[self.atoms :])
        ends = np.array(self.pairs, np.int64).reshape(-1, 2)
        self.levels = [
            (self.atoms + np.flatnonzero(made == v), ends[made == v, 0], ends[made == v, 1])
            for v in range(1, max(level, default=0) + 1)
        ]

    @property
    def size(self) -> int:
        return self.atoms + len(self.pairs)

    def additions(self) -> int:
        """Additions for one document: one for each pair, and those that put the items together."""
        return len(self.pairs) + sum(len(p) - 1 for p in self.parts if p)

    def sums(self, atoms: np.ndarray) -> np.ndarray:
        """Scores [item, document] from the atoms' sums [node, document], whose upper rows it fills."""
        for made, left, right in self.levels:
            atoms[made] = atoms[left] + atoms[right]
        out = np.zeros((len(self.parts), atoms.shape[1]), np.int64)
        for i, nodes in enumerate(self.parts):
            if nodes:
                np.sum(atoms[nodes], axis=0, out=out[i])
        return out


def _rank_kernel(dag: Sharing, weights: np.ndarray, atom: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Best `k` documents of each item among the rows of a task."""
    width = max(1, SUM_BYTES // (8 * max(1, dag.size + len(dag.parts))))

    def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
        return np.lexsort((ids, -scores))[:count]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in dag.parts]
        least = np.ones(len(dag.parts), np.int64)  # a document needs this score to matter
        for whole in batches:
            for at in range(0, whole.num_rows, width):
                batch = whole.slice(at, width)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                n = batch.column("n").to_numpy()
                terms, tfs = batch.column("terms"), batch.column("tfs")
                doc = np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
                term = terms.flatten().to_numpy()
                tf = tfs.flatten().to_numpy().astype(np.int64)
                own = atom[term] >= 0  # terms of this block's items
                doc, term, tf = doc[own], term[own], tf[own]
                m = 50 + (50 * n * n_docs) // max(n_terms, 1)
                adds = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                sums = np.zeros((dag.size, len(ids)), np.int64)
                np.add.at(sums, (atom[term], doc), adds)
                scores = dag.sums(sums)
                for i in np.flatnonzero((scores >= least[:, None]).any(axis=1)).tolist():
                    new = np.flatnonzero(scores[i] >= least[i])
                    s = np.concatenate((held[i][0], scores[i][new]))
                    d = np.concatenate((held[i][1], ids[new]))
                    top = best(s, d, k)
                    held[i] = s[top], d[top]
                    if len(top) == k:
                        least[i] = s[top[-1]]
        item = np.repeat(np.arange(len(held)), [len(s) for s, _ in held])
        columns = [item, np.concatenate([d for _, d in held]), np.concatenate([s for s, _ in held])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["item", "doc_id", "score"])

    return run


def _items(benchmark: DataFrame) -> list[tuple[int | None, set[bytes]]]:
    """Each item's distinct terms. The items are the stated query set: one row for each and bounded terms."""
    merged: dict[int | None, set[bytes]] = {}
    for row in benchmark.selectExpr("cast(item_id as long) as item_id", "cast(text as binary) as text").toLocalIterator():
        merged.setdefault(row["item_id"], set()).update(terms_of(bytes(row["text"]) if row["text"] is not None else None))
    return sorted(merged.items(), key=lambda i: (i[0] is None, i[0] or 0))


def search(docs: DataFrame, benchmark: DataFrame, k: int = 50) -> DataFrame:
    """Each item's `k` documents of the highest score above 0: item_id, rank, doc_id, score.

    Equal scores rank by ascending doc_id. A null text has no terms. Rows of one item_id are one item with
    the terms of all of them; a null item_id is an item too. An item without terms, or whose terms no
    document holds, has no rows, and so has an empty table on either side. Documents without an id count
    in N, L and df but can't be named, so they aren't ranked. Rows that repeat a doc_id are documents of
    their own. Other columns are ignored, whatever their names. More than `MOST_TERMS` distinct item terms
    are an error: search the items in parts.
    """
    spark = tuned(docs.sparkSession)
    items = _items(benchmark)
    vocabulary = sorted(set().union(*[terms for _, terms in items]))
    if len(vocabulary) > MOST_TERMS:
        raise ValueError(f"{len(vocabulary)} distinct item terms, {MOST_TERMS} can be sent to the tasks")
    numbers = {t: i for i, t in enumerate(vocabulary)}
    if not numbers:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    held = settled(postings(docs, numbers), "postings")
    total = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.count("*").alias("all")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    pieces = 1 + math.isqrt(total["all"] // PIECE_DOCS)
    # At most one row for each item term.
    counts = held.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weights = np.zeros(len(numbers), np.int64)
    for row in counts:
        weights[row["t"]] = weight(n_docs, row["count"])
    named = held.where("doc_id is not null and size(terms) > 0")
    found = None
    for at in range(0, len(items), BLOCK):
        block = items[at : at + BLOCK]
        part = _ranked(named, block, numbers, weights, n_docs, n_terms, k, pieces)
        found = part if found is None else found.unionByName(part)
    return found


def _ranked(
    held: DataFrame, items: list, numbers: dict, weights: np.ndarray, n_docs: int, n_terms: int, k: int, pieces: int
) -> DataFrame:
    spark = held.sparkSession
    dag = Sharing([{numbers[t] for t in terms} for _, terms in items])
    atom = np.full(len(numbers), -1, np.int64)
    for t, node in dag.atom_of.items():
        atom[t] = node
    state = spark.sparkContext.broadcast((dag, weights, atom))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rank_kernel(*state.value, n_docs, n_terms, k)(batches)

    best = held.mapInArrow(run, "item long, doc_id long, score long")
    # First among the rows that share a part of the ids, then among the best of all parts.
    order = (F.col("score").desc(), F.col("doc_id"))
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(pieces))
    local = best.withColumn("piece", piece).withColumn(
        "place", F.row_number().over(Window.partitionBy("item", "piece").orderBy(*order))
    )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = local.where(F.col("place") <= k).withColumn("rank", rank).where(F.col("rank") <= k)
    # One row for each item of the block.
    names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(items)], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
