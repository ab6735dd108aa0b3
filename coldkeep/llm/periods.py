"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words whose smallest period q fits at least four times and that no
neighbouring word extends with this period. Periods below `DIRECT` are found by comparing the words
with themselves shifted by q. For the others there is a scale t, a power of two with t <= q < 2t:

* Positions whose t words have a period of at most t/4 lie in a run that a smaller scale has found;
  they are highly periodic and get no hash.
* Every other position has the hash of its t words. Position i is in the synchronising set if the least
  hash of positions i to i + t stands at i or at i + t. That depends on the words i to i + 2t - 1
  alone, so equal contexts are chosen alike.
* Of any t neighbouring positions at least one is chosen, unless the 3t - 1 words behind the first have
  a period of at most t/4. Within a run of period q >= t they can't, as q would not be its smallest
  period. So the first t positions of the run hold a chosen one; q words on its context of 2t words
  occurs again (3t - 1 + q <= 4q), and not earlier, as 2t > q.

Neighbouring occurrences of a chosen context therefore propose every period, at a distance between t
and 2t - 1. Each proposal is extended in both directions by comparing words. Words are exact numbers;
only the contexts are hashed (64 bits, by doubling).
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from coldkeep.llm.common import arrow_map, mix64, tuned

#: Periods below this are found by shifted comparison; it is also the smallest scale.
DIRECT = 8
#: A run holds its period so often at least, and so many words.
LEAST_POWER, LEAST_WORDS = 4, 6

U64 = np.uint64
NONE = U64(0xFFFFFFFFFFFFFFFF)
FACTOR = U64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, kept binary, runs_sha256 string, collapsed_sha256 string"
)


def least_length(q):
    return np.maximum(LEAST_WORDS, LEAST_POWER * q)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edges = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _agreeing(words: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The largest stretch around i on which words and words d later are equal, as [start, end)."""
    end, step, n = i + 1, 64, len(words) - d
    while end < n:
        stop = min(end + step, n)
        bad = words[end:stop] != words[end + d : stop + d]
        first = int(bad.argmax())
        if bad[first]:
            end += first
            break
        end, step = stop, step * 4
    start, step = i, 64
    while start > 0:
        stop = max(start - step, 0)
        bad = words[stop:start] != words[stop + d : start + d]
        last = int(bad[::-1].argmax())
        if bad[len(bad) - 1 - last]:
            start -= last
            break
        start, step = stop, step * 4
    return start, end


def _chosen(words: np.ndarray, hashes: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set of scale t: positions with a whole context."""
    own = hashes[: len(words) - t + 1].copy()
    own[periodic[: len(own)]] = NONE
    least, width = own, 1
    while width < t:  # least of `width` positions from each one
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    size = len(words) - 2 * t + 1
    lowest = np.minimum(least[:size], own[t : t + size])
    ends = np.minimum(own[:size], own[t : t + size])
    return np.flatnonzero((ends == lowest) & (lowest != NONE))


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All runs as rows (start, length, period), sorted by start and period.

    `words` holds documents one after the other, the longest first; each is followed by a number that
    occurs nowhere else, which no run can hold. `lengths` are their sizes with that number.
    """
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
    ends = np.cumsum(lengths)
    for q in range(1, DIRECT):
        if len(words) <= q:
            break
        start, stop = _stretches(words[:-q] == words[q:])
        long = stop - start + q >= least_length(q)
        for a, b in zip(start[long].tolist(), (stop[long] + q).tolist()):
            found.setdefault((a, b), q)
    t, hashes = 1, mix64(words.astype(np.uint64) * FACTOR + U64(1))
    while True:
        # Documents that can hold a run of period t or more come first.
        fit = int(np.searchsorted(-lengths, -LEAST_POWER * t, side="left"))
        size = int(ends[fit - 1]) if fit else 0
        if size < LEAST_POWER * t:
            break
        words = words[:size]
        hashes = hashes[: size - t + 1]
        twice = mix64(hashes[: size - 2 * t + 1] * FACTOR + hashes[t:])
        if t >= DIRECT:
            mark = np.zeros(size + 1, np.int32)
            for (a, b), q in found.items():
                if LEAST_POWER * q <= t <= b - a and a < size:
                    mark[a] += 1
                    mark[b - t + 1] -= 1
            place = _chosen(words, hashes, t, np.cumsum(mark) > 0)
            context = twice[place]
            order = np.argsort(context, kind="stable")
            same = context[order[1:]] == context[order[:-1]]
            left, right = place[order[:-1]][same], place[order[1:]][same]
            near = (right - left >= t) & (right - left < 2 * t)
            left, apart = left[near], (right - left)[near]
            by_period = np.lexsort((left, apart))
            seen, until = 0, 0
            for i, d in zip(left[by_period].tolist(), apart[by_period].tolist()):
                if d == seen and i < until:
                    continue
                start, until = _agreeing(words, i, d)
                seen = d
                if until - start + d >= LEAST_POWER * d:
                    known = found.get((start, until + d))
                    if known is None or known > d:
                        found[start, until + d] = d
        t, hashes = 2 * t, twice
    rows = sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """For one document in ten, the word that stands at each place: from some word on, a few repeat."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _largest(runs: np.ndarray) -> tuple[int, int, int]:
    """The run of the greatest exponent; of equal ones the first, then that of the smaller period."""
    power = runs[:, 1] / runs[:, 2]
    close = runs[power >= power.max() * (1 - 1e-9)].tolist()
    return min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))


def _kernel(edited: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        texts, numbers = [], []
        for key, text in zip(ids, batch.column("text").to_pylist()):
            words = (text or b"").split()
            own = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            place = planted(len(words), key) if edited else None
            if place is not None:
                words, own = [words[i] for i in place.tolist()], own[place]
            texts.append(words)
            numbers.append(own)
        sizes = np.array([len(w) for w in texts])
        order = np.argsort(-sizes, kind="stable")
        lengths = sizes[order] + 1
        begins = np.cumsum(lengths) - lengths
        chain = np.empty(int(lengths.sum()), np.int64)
        for k, (doc, begin) in enumerate(zip(order.tolist(), begins.tolist())):
            chain[begin : begin + sizes[doc]] = numbers[doc]
            chain[begin + sizes[doc]] = len(number) + k
        runs = find_runs(chain, lengths)
        of_doc = np.searchsorted(begins, runs[:, 0], side="right") - 1
        runs[:, 0] -= begins[of_doc]
        first = np.searchsorted(of_doc, np.arange(len(order) + 1))
        rows: list = [None] * len(order)
        for k, doc in enumerate(order.tolist()):
            mine = runs[first[k] : first[k + 1]]
            words, best, milli = texts[doc], (None, None, None), None
            if len(mine):
                best = _largest(mine)
                milli = 1000 * best[1] // best[2]
                mark = np.zeros(len(words) + 1, np.int32)
                np.add.at(mark, mine[:, 0] + mine[:, 2], 1)
                np.add.at(mark, mine[:, 0] + mine[:, 1], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]
            listed, text = mine.tolist(), b" ".join(words)
            lines = "".join(f"{a},{b},{q}\n" for a, b, q in listed).encode()
            rows[doc] = (
                len(mine), *best, milli, listed, text,
                hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest(),
            )
        columns = list(zip(*rows))
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        as_structs = [[dict(zip(("start", "length", "period"), r)) for r in listed] for listed in columns[5]]
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
        arrays += [pa.array(as_structs, run_type), pa.array(columns[6], pa.binary())]
        arrays += [pa.array(c, pa.string()) for c in columns[7:]]
        names = ["n_runs", "start", "length", "period", "exponent_milli", "runs", "kept", "runs_sha256", "collapsed_sha256"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])

    return run


def periodic_runs(docs: DataFrame, edited: bool = False) -> DataFrame:
    """Every run of each whole text, the one of the greatest exponent, and the text without repeats.

    Words are the maximal stretches without space, tab, line feed, vertical tab, form feed and carriage
    return. `runs` lists all runs; `kept` joins by single spaces the words that no run holds after its
    first period. A null text has no word; without runs start, length, period and exponent_milli are
    null. Rows that repeat an id are judged one by one. With `edited` the texts are changed first as
    `planted` says, but for rows without an id. Other columns are ignored, whatever their names; an empty
    table gives no rows. A text is taken whole by one task, in memory linear in its words.
    """
    tuned(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as binary) as text")
    return arrow_map(rows, lambda: _kernel(edited), SCHEMA, "text")
