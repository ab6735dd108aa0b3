"""Removal of repeated passages by a distributed difference-cover suffix sort.

Text that can repeat is found first. Each document is cut where its content says so into units, each
with the bytes that windows starting in it reach. Equal units are kept once, with the least document
that holds them. Every window of WINDOW bytes is represented by the least hash of its parts; only
units that share such an anchor with another unit go on. Both steps lose no repeated window. Of what is
left, runs of windows of one anchor whose bytes a segment of a smaller document has as well go at once
and are not sorted: a passage of many copies, each with changes of its own, is sorted about once.

The suffixes of these units are sorted by the difference cover {1, 2} modulo 3. Suffixes at sampled
offsets are sorted by a triple of words, 20 bytes, and named in order. The names are the text of the
next level: triples of names, overlapping, cover 50 bytes, where the recursion ends, as a prefix of
50 bytes decides. The remaining suffixes are merged by the cover's property that two offsets reach
sampled ones by a common shift: their keys are the bytes before the sampled offset and names from
there on. Adjacent suffixes of equal keys share 50 bytes; all but those of the least document go.

Buckets of a sort are ranges of keys with split points from a bounded sample (these only balance the
work); rows between tasks are packed arrays, so a bucket is a numpy sort.

Defined results: bytes are those of UTF-8; a null text is an empty one; documents shorter than the
window lose nothing; rows that repeat a doc_id are judged one by one and never against each other;
a null doc_id is larger than every other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldkeep.llm import common
from coldkeep.llm.common import staged

WINDOW = 50
#: Bytes of the parts whose least hash is a window's anchor.
PART = 20
UNIT_BITS, LONGEST_UNIT = 8, 1024
#: Units a task remembers to have sent anchors of.
REMEMBERED = 500_000
#: Shift from a suffix to its first name: places of the further names. As names are at sampled offsets,
#: shift 0 serves classes 1 and 2, shift 1 classes 0 and 1, shift 2 classes 0 and 2.
SHIFTS = {0: (15, 30), 1: (15, 27), 2: (15, 27)}
#: Bytes that a bucket of a sort holds on average.
BUCKET_BYTES = 12 << 20
#: Buckets of a sort that a task takes one after the other.
EACH = 3
SPLIT_SAMPLE = 200_000
LAST = (1 << 63) - 1
#: Bytes that a task turns into arrays at once; of units, fewer, as they are not dealt out by bucket.
SLICE, UNIT_SLICE = 1 << 19, 1 << 17

#: The number of a segment: the rank of its document, then its place among the segments of that.
DOC_SHIFT = 24
TRIPLE = np.dtype([("k1", ">u8"), ("k2", ">u8"), ("k3", ">u4"), ("around", "<u4"), ("unit", "<i8"), ("at", "<u2"), ("lead", "u1"), ("room", "u1")])
NAMED = np.dtype([("name", "<i8"), ("around", "<u4"), ("unit", "<i8"), ("at", "<u2"), ("lead", "u1"), ("room", "u1")])
SUFFIX = np.dtype([("a", "<i8"), ("b", "<i8"), ("c", "<i8"), ("rest", "<u4"), ("unit", "<i8"), ("at", "<u2")])
#: A suffix that loses its window: its segment and place.
GONE = np.dtype([("unit", "<i8"), ("at", "<u2")])
#: Successive windows of a segment that have one anchor, with 128 bits that stand for their bytes.
BLOCK = np.dtype([("one", "<u8"), ("two", "<u8"), ("unit", "<i8"), ("at", "<u2"), ("many", "<u2")])
#: Text whose blocks meet in one bucket.
BLOCKS_OF = 4 << 20
#: Successive window starts of a segment that go.
RUN = np.dtype([("at", "<u2"), ("many", "<u2")])
#: Segments of so many windows are cut where a part's hash ends in so many zero bits: what different segments
#: have in common is then one piece. Shorter ones are not, as each cut costs WINDOW - 1 bytes.
PIECED, PIECE_BITS = 200, 6
#: A sort is done in so many passes over ranges of its keys; the records of one are gone before the next.
PASSES = 1
#: Bytes of the pieces that named suffixes are kept in.
PIECE_BYTES = 1 << 16
#: 48 bits of an anchor and the unit that has it, or the two units whose seam it spans.
#: A window that holds a part of PART bytes at its x-th byte belongs to one of CASES ranges of x.
CASES = 3
PLACES = WINDOW - PART + 1
CASE = np.arange(PLACES) * CASES // PLACES
EXACT = np.arange(PLACES)
#: Stands for the sides of a window that there is not; those of others are odd, or 0.
ABSENT = 2
INSIDE = np.dtype([("high", "<u4"), ("low", "<u2"), ("sides", "<u2", (CASES,)), ("unit", "<i8")])
ACROSS = np.dtype([("high", "<u4"), ("low", "<u2"), ("sides", "<u2", (CASES,)), ("unit", "<i8"), ("next", "<i8")])
#: Here windows must agree as a whole, however many places an anchor has: sides of 32 bits.
PLACED = np.dtype([("high", "<u4"), ("low", "<u2"), ("sides", "<u4", (PLACES,)), ("unit", "<i8"), ("doc", "<i8")])


class Cutter:
    """Units and anchors of the texts of a slice; the prefix sums of the last one serve all its hashes."""

    def __init__(self):
        common.reuse_memory()
        self.parts, self.two = common.SpanHash(61), common.SpanHash(71)
        self.sums = np.zeros(1, np.uint64)

    def part_hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of the PART bytes from each place on."""
        h = self.parts
        sums = self.sums = h.sums(data)
        n = len(data) - PART + 1
        return common.mix64((sums[PART:] - sums[:n]) * h.inverses[:n])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first window start and end of the window starts of each unit; and the part hashes."""
        size = np.diff(offsets)
        long = np.flatnonzero(size >= WINDOW)
        none = np.zeros(0, np.int64)
        if not len(long):
            return none, none, none, np.zeros(0, np.uint64)
        hashes = self.part_hashes(data)
        first, last = offsets[long], offsets[long + 1] - WINDOW
        cut = np.flatnonzero(hashes & common.U64((1 << UNIT_BITS) - 1) == 0)
        owner = np.searchsorted(first, cut, side="right") - 1
        good = owner >= 0
        good[good] = cut[good] <= last[owner[good]]
        start = np.union1d(first, cut[good])
        text = np.searchsorted(first, start, side="right") - 1
        end = np.append(start[1:], 0)
        ends_text = np.append(text[1:] != text[:-1], True)
        end[ends_text] = last[text[ends_text]] + 1
        many = -(-(end - start) // LONGEST_UNIT)
        part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        unit_start = np.repeat(start, many) + part * LONGEST_UNIT
        return long[np.repeat(text, many)], unit_start, np.minimum(unit_start + LONGEST_UNIT, np.repeat(end, many)), hashes

    def first_names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64 bits that stand for the bytes of each unit of the slice that was cut last."""
        return self.parts.spans(self.sums, start, end + WINDOW - 1).view(np.int64)

    def names(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that stand for the bytes of each unit of the slice that was cut last."""
        return self.first_names(start, end), self.two(data, start, end + WINDOW - 1).view(np.int64)


def units_of(docs: DataFrame) -> DataFrame:
    """doc, version, begin, size, one, two: the units of each text. Docs have (doc, version, text).

    size counts the window starts; with what these reach a unit has WINDOW - 1 bytes more.
    """

    def make():
        cutter = Cutter()

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = common.utf8(batch.column("text"))
            text, start, end, _ = cutter(data, offsets)
            names = cutter.names(data, start, end)
            keys = [batch.column(c).take(pa.array(text)) for c in ("doc", "version")]
            where = [pa.array(x, pa.int32()) for x in (start - offsets[text], end - start)]
            columns = [*keys, *where, *(pa.array(x, pa.int64()) for x in names)]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "version", "begin", "size", "one", "two"])

        return kernel

    return common.arrow_map(docs, make, "doc long, version long, begin int, size int, one long, two long", "text", UNIT_SLICE)


def packed(bucket: np.ndarray, records: np.ndarray, mark: bytes = b"") -> pa.RecordBatch:
    """One row a bucket: its records, as bytes behind the mark."""
    # numpy sorts 16 bits by radix.
    small = len(bucket) and bucket.max() < 1 << 16
    order = np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    blobs = pa.array([mark + r.tobytes() for r in np.split(records, cuts[1:])], pa.binary()) if mark and len(bucket) else blobs_of(records, cuts)
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int32()), blobs], names=["bucket", "records"])


def blobs_of(records: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the records from each cut to the next one."""
    ends = np.append(cuts, len(records)) * records.itemsize
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(records.tobytes())])


PACKED = "bucket int, records binary"


def by_bucket(rows: DataFrame, buckets: int, kind: np.dtype | None, kernel: Callable, schema: str, each: int = 1) -> DataFrame:
    """Apply a kernel to each bucket and all its records; without a kind, to the list of its blobs.

    A task takes `each` buckets on average, one after the other.
    """

    def whole(blobs: list[bytes]):
        return blobs if kind is None else np.frombuffer(b"".join(blobs), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.reuse_memory()
        held, current = [], None
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("records").to_pylist()):
                if bucket != current:
                    if held:
                        yield from kernel(current, whole(held))
                    held, current = [], bucket
                held.append(blob)
        if held:
            yield from kernel(current, whole(held))
        held.clear()
        common.give_back()

    return rows.repartition(max(1, buckets // each), "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


SEAM = np.dtype([("anchor", "<u8"), ("part", "<i8"), ("one", "?")])


def minima(hashes: np.ndarray) -> list[np.ndarray]:
    """The least of 1, 2, 4, ... part hashes from each place on, as far as a window holds so many."""
    out = [hashes]
    while 2 << (len(out) - 1) <= PLACES:
        width = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-width], out[-1][width:]))
    return out


def least_hashes(hashes: np.ndarray, least: list[np.ndarray] | None = None) -> np.ndarray:
    """The least part hash of the window that starts at each place; least: the minima of the hashes."""
    least = (least or minima(hashes))[-1]
    shift = PLACES - (1 << (PLACES.bit_length() - 1))
    return np.minimum(least[: len(least) - shift], least[shift:]) if shift else least


def periodic(hashes: np.ndarray) -> np.ndarray:
    """True where a part's hash occurs again within a window, going by 32 of its bits."""
    out, low = np.zeros(len(hashes), bool), hashes.astype(np.uint32)
    for shift in range(1, PLACES + 1):
        again = low[:-shift] == low[shift:]
        out[:-shift] |= again
        out[shift:] |= again
    return out


def parts_of(least: list[np.ndarray], first: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Place of the leftmost part with the anchor's hash in the window that starts at first, by the minima."""
    part = first.copy()
    for k in range(len(least) - 1, -1, -1):
        room = np.flatnonzero(part + (1 << k) <= first + PLACES)
        part[room] += (least[k][part[room]] != anchor[room]).astype(np.int64) << k
    return part


def sides_of(cutter: Cutter, odd: np.ndarray, part: np.ndarray, cases: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None, bits: int = 16) -> np.ndarray:
    """For each case, some bits of a hash of the bytes that all its windows around the part hold.

    Places that share a window agree in its case. 0 where the part occurs twice near: it fits all.
    The hash goes by the prefix sums of the text that was cut last. Of cases of one window each, only
    those of windows that start from begin to end are wanted, if these are given.
    """
    side, sums = cutter.parts, cutter.sums
    out = np.zeros((len(part), cases[-1] + 1), f"<u{bits // 8}")
    known = np.flatnonzero(~odd[part])
    if begin is not None:
        out[known] = ABSENT
    everyone = known
    for case in range(cases[-1] + 1):
        x = np.flatnonzero(cases == case)
        if begin is not None:
            known = everyone[(part[everyone] - case >= begin[everyone]) & (part[everyone] - case < end[everyone])]
        place = part[known]
        h = side.spans(sums, np.maximum(place - x[0], 0), np.minimum(place + WINDOW - x[-1], len(sums) - 1))
        out[known, case] = (h >> common.U64(64 - bits)) | common.U64(1)
    return out


def seams(least: np.ndarray, lows: list[np.ndarray], odd: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seams before and behind each unit: an anchor that windows on both sides have.

    Such an anchor is one place of the text (`part`) that two units show, and must not look like two
    places. The same anchor at other places of the units is none of the seam's.
    In periodic text `one` is false and the two sides count as different places.
    """
    before, behind = np.zeros(len(start), SEAM), np.zeros(len(start), SEAM)
    left = np.flatnonzero(text[1:] == text[:-1])
    at = start[left + 1]
    shared = least[at - 1] == least[at]
    left, at = left[shared], at[shared]
    sums = np.concatenate([[0], np.cumsum(odd)])
    calm = sums[np.minimum(at + WINDOW - PART + 1, len(odd))] == sums[np.maximum(at - 1, 0)]
    behind["anchor"][left] = before["anchor"][left + 1] = least[at]
    behind["part"][left] = before["part"][left + 1] = parts_of(lows, at, least[at])
    behind["one"][left] = before["one"][left + 1] = calm
    return before, behind


def elsewhere(key: np.ndarray, where: np.ndarray) -> np.ndarray:
    """1 where the same key has another place."""
    out = np.zeros(len(key), np.int64)
    if len(key):
        order = np.argsort(key)
        starts = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        several = np.minimum.reduceat(where[order], starts) != np.maximum.reduceat(where[order], starts)
        out[order] = np.repeat(several, np.diff(np.append(starts, len(key))))
    return out


def agreeing(anchor: np.ndarray, sides: np.ndarray, unit: np.ndarray, where: np.ndarray) -> pa.RecordBatch:
    """unit, anchor and a bit for each case in which another place of the anchor agrees."""
    every = sides.shape[1]
    spread = common.mix64(anchor << common.U64(16))
    cases = np.zeros(len(anchor), np.int64)
    for case in range(every):
        rows = np.flatnonzero(sides[:, case] != ABSENT)
        cases[rows] |= elsewhere(spread[rows] ^ sides[rows, case], where[rows]) << case
    # A part that can't be told apart shares all cases with every other place of its anchor.
    blurred = np.isin(anchor, anchor[sides[:, 0] == 0])
    cases[blurred] |= elsewhere(anchor[blurred], where[blurred]) * ((1 << every) - 1)
    shared = cases > 0
    unit, anchor, cases = unit[shared], anchor[shared].astype(np.int64), cases[shared]
    order = np.lexsort((anchor, unit))
    unit, anchor, cases = unit[order], anchor[order], cases[order]
    first = np.flatnonzero(np.append(True, (np.diff(unit) != 0) | (np.diff(anchor) != 0))) if len(unit) else np.zeros(0, np.int64)
    cases = np.bitwise_or.reduceat(cases, first) if len(first) else cases
    return pa.RecordBatch.from_arrays([pa.array(unit[first]), pa.array(anchor[first]), pa.array(cases)], names=["unit", "anchor", "cases"])


def anchored(docs: DataFrame, buckets: int) -> DataFrame:
    """unit, anchor, cases: anchors (48 bits) of a unit (its first name) that another place has as well.

    cases has a bit for each case in which the places agree.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, sent = Cutter(), set()
        for batch in common.slices(batches, "text", SLICE):
            data, offsets = common.utf8(batch.column("text"))
            text, start, end, hashes = cutter(data, offsets)
            if not len(text):
                continue
            unit = cutter.first_names(start, end)
            # Units seen before in this task have sent their anchors.
            keep = np.zeros(len(unit), bool)
            names, where = np.unique(unit, return_index=True)
            keep[[w for n, w in zip(names.tolist(), where.tolist()) if n not in sent]] = True
            if len(sent) > REMEMBERED:
                sent.clear()
            sent.update(names.tolist())
            lows = minima(hashes)
            least, odd = least_hashes(hashes, lows), periodic(hashes)
            # Windows of one anchor that follow each other in a unit.
            new = np.append(True, least[1:] != least[:-1])
            new[start] = True
            at = np.flatnonzero(new)
            owner = np.searchsorted(start, at, side="right") - 1
            inner = (owner >= 0) & keep[owner] & (at < end[owner])
            at, owner = at[inner], owner[inner]
            anchor = least[at]
            before, behind = seams(least, lows, odd, text, start)
            part = parts_of(lows, at, anchor)
            plain = ~np.any([s["one"][owner] & (s["part"][owner] == part) for s in (before, behind)], axis=0)
            inside = np.zeros(int(plain.sum()), INSIDE)
            inside["unit"] = unit[owner[plain]]
            # A seam is sent if one of its units is new.
            seam = np.flatnonzero(behind["one"][:-1] & (keep[:-1] | keep[1:])) if len(unit) > 1 else np.zeros(0, np.int64)
            pair = np.zeros(len(seam), ACROSS)
            pair["unit"], pair["next"] = unit[seam], unit[seam + 1]
            for records, full, place, mark in ((inside, anchor[plain], part[plain], b"i"), (pair, behind["anchor"][seam], behind["part"][seam], b"a")):
                records["sides"] = sides_of(cutter, odd, place, CASE)
                records["high"], records["low"] = full >> common.U64(32), full >> common.U64(16) & common.U64(0xFFFF)
                yield packed((full % common.U64(buckets)).astype(np.int32), records, mark)
        del sent
        common.give_back()

    def meet(_: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        inside = np.frombuffer(b"".join(b[1:] for b in blobs if b[:1] == b"i"), INSIDE)
        across = np.frombuffer(b"".join(b[1:] for b in blobs if b[:1] == b"a"), ACROSS)
        full = [(r["high"].astype(np.uint64) << common.U64(16)) | r["low"] for r in (inside, across, across)]
        pair = common.mix64(across["unit"].astype(np.int64).view(np.uint64) * common.U64(31) + across["next"].astype(np.int64).view(np.uint64))
        anchor = np.concatenate(full)
        unit = np.concatenate([inside["unit"], across["unit"], across["next"]])
        where = np.concatenate([inside["unit"].astype(np.int64).view(np.uint64), pair, pair])
        yield agreeing(anchor, np.concatenate([inside["sides"], across["sides"], across["sides"]]), unit, where)

    rows = docs.mapInArrow(send, PACKED)
    return by_bucket(rows, buckets, None, meet, "unit long, anchor long, cases long")


def agreed_windows(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, unit: np.ndarray, pairs: pa.Array, cases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts whose anchor and case are among the pairs (of the units given), and their units."""
    if not len(unit):
        return unit, unit
    key = lambda unit, anchor: common.mix64(common.mix64(unit.astype(np.uint64)) ^ anchor)
    wanted = key(unit, pairs.field("anchor").to_numpy().view(np.uint64))
    order = np.argsort(wanted)
    wanted, bits = wanted[order], pairs.field("cases").to_numpy()[order]
    # Anchors are part of a hash: buckets that differ in the rest of it may both name one.
    once = np.flatnonzero(np.append(True, wanted[1:] != wanted[:-1]))
    wanted, bits = wanted[once], np.bitwise_or.reduceat(bits, once)
    lows = minima(hashes)
    least = least_hashes(hashes, lows)
    chosen = np.unique(unit)
    size = (end - start)[chosen]
    at = np.repeat(start[chosen], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    owner = np.repeat(chosen, size)
    # Windows of one anchor that follow each other are looked up once.
    first = np.flatnonzero(np.append(True, (np.diff(least[at]) != 0) | (np.diff(owner) != 0)))
    own = key(owner[first], least[at[first]] >> common.U64(16))
    where = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
    bits = np.where(wanted[where] == own, bits[where], 0)
    part = parts_of(lows, at[first], least[at[first]])
    length = np.diff(np.append(first, len(at)))
    x = np.repeat(part, length) - at
    # Behind the first place of a part that occurs twice in a run, any case may hold.
    here = np.repeat(bits, length) >> cases[np.maximum(x, 0)] & 1 == 1
    here |= (x < 0) & np.repeat(bits != 0, length)
    return at[here], owner[here]


def stretches(at: np.ndarray, owner: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end (of the bytes) and owner of each run of successive window starts.

    With the part hashes, long runs are also cut where the text says so.
    """
    new = np.append(True, (np.diff(at) != 1) | (np.diff(owner) != 0)) if len(at) else np.zeros(0, bool)
    if hashes is not None:
        size = np.diff(np.append(np.flatnonzero(new), len(at)))
        new |= np.repeat(size >= PIECED, size) & (hashes[at] & common.U64((1 << PIECE_BITS) - 1) == 0)
    return at[new], at[np.append(new[1:], True)[: len(new)]] + WINDOW, owner[new]


def trimmed(segments: DataFrame, buckets: int, names: tuple[str, ...], pieces: bool = False) -> DataFrame:
    """doc, names, begin, data: the parts of segments whose every window a segment of another document has.

    As `anchored`, for the few segments that are left, with one case for each place of a part. Segments
    have doc, names (columns that are passed on), begin, data and unit. With pieces, long parts are cut
    where their content says so: pieces overlap, but each window is in one.
    """
    shape = ("doc", *names, "begin", "data")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in common.slices(batches, "data", SLICE):
            data, offsets = binaries(batch.column("data"))
            hashes = cutter.part_hashes(data)
            lows = minima(hashes)
            least, odd = least_hashes(hashes, lows), periodic(hashes)
            new = np.append(True, least[1:] != least[:-1])
            new[offsets[:-1]] = True
            at = np.flatnonzero(new)
            owner = np.searchsorted(offsets, at, side="right") - 1
            inner = at <= offsets[owner + 1] - WINDOW
            end = np.minimum(np.append(at[1:], len(data)), offsets[owner + 1] - WINDOW + 1)[inner]
            at, owner = at[inner], owner[inner]
            full = least[at]
            records = np.zeros(len(full), PLACED)
            records["high"], records["low"] = full >> common.U64(32), full >> common.U64(16) & common.U64(0xFFFF)
            records["sides"] = sides_of(cutter, odd, parts_of(lows, at, full), EXACT, at, end, 32)
            for field in ("unit", "doc"):
                records[field] = batch.column(field).to_numpy()[owner]
            yield packed((full % common.U64(buckets)).astype(np.int32), records)

    def meet(_: int, records: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchor = (records["high"].astype(np.uint64) << common.U64(16)) | records["low"]
        yield agreeing(anchor, records["sides"], records["unit"].astype(np.int64), records["doc"].astype(np.int64))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in common.slices(batches, "data", SLICE):
            data, offsets = binaries(batch.column("data"))
            shared = batch.column("shared")
            unit = np.repeat(np.arange(batch.num_rows), np.diff(shared.offsets.to_numpy()))
            hashes = cutter.part_hashes(data)
            at, owner = agreed_windows(hashes, offsets[:-1], offsets[1:] - WINDOW + 1, unit, shared.flatten(), EXACT)
            begin, stop, owner = stretches(at, owner, hashes if pieces else None)
            raw = data.tobytes()
            columns = [batch.column(c).take(pa.array(owner, pa.int64())) for c in ("doc", *names)]
            columns.append(pa.array(batch.column("begin").to_numpy()[owner] + begin - offsets[owner], pa.int32()))
            columns.append(pa.array([raw[a:b] for a, b in zip(begin.tolist(), stop.tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=list(shape))

    found = by_bucket(segments.select("doc", "data", "unit").mapInArrow(send, PACKED), buckets, PLACED, meet, "unit long, anchor long, cases long")
    shared = found.groupBy("unit").agg(F.collect_list(F.struct("anchor", "cases")).alias("shared"))
    rows = segments.join(shared, "unit").select(*shape, "shared")
    return rows.mapInArrow(cut, segments.select(*shape).schema)


#: A stretch of windows of a unit: the least document that holds the unit, its names, and where in it.
SEGMENT = "doc long, one long, two long, begin int, data binary"


def segments(docs: DataFrame) -> DataFrame:
    """doc, one, two, begin, data, unit: stretches of a unit's windows whose anchors are shared.

    Docs have (doc, text, shared), the last an array of units: begin, size, names, pairs of anchors and
    cases. Only the bytes of these units are hashed.
    """

    def make():
        cutter = Cutter()

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = common.utf8(batch.column("text"))
            shared = batch.column("shared")
            text = np.repeat(np.arange(batch.num_rows), np.diff(shared.offsets.to_numpy()))
            units = shared.flatten()
            at, size = (units.field(c).to_numpy().astype(np.int64) for c in ("begin", "size"))
            at += offsets[text]
            end = np.cumsum(size + WINDOW - 1)
            start = end - size - WINDOW + 1
            own = np.concatenate([data[a : a + n + WINDOW - 1] for a, n in zip(at.tolist(), size.tolist())] or [data[:0]])
            pairs = units.field("pairs")
            unit = np.repeat(np.arange(len(start)), np.diff(pairs.offsets.to_numpy()))
            found, owner = at[:0], at[:0]
            if len(own):
                found, owner = agreed_windows(cutter.part_hashes(own), start, start + size, unit, pairs.flatten(), CASE)
            begin, stop, owner = stretches(found, owner)
            raw = own.tobytes()
            columns = [batch.column("doc").take(pa.array(text[owner], pa.int64()))]
            columns += [units.field(c).take(pa.array(owner, pa.int64())) for c in ("one", "two")]
            columns += [pa.array(begin - start[owner], pa.int32()), pa.array([raw[a:b] for a, b in zip(begin.tolist(), stop.tolist())], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "one", "two", "begin", "data"])

        return kernel

    rows = common.arrow_map(docs, make, SEGMENT, "text", SLICE)
    return rows.withColumn("unit", F.xxhash64("one", "two", "begin"))


def triples(batch: pa.RecordBatch) -> np.ndarray:
    """Records of the sampled suffixes of units: 20 bytes, four bytes around, and where they are."""
    data, offsets = binaries(batch.column("data"))
    unit, begin = batch.column("unit").to_numpy(), batch.column("begin").to_numpy()
    owner = np.repeat(np.arange(len(unit)), np.diff(offsets))
    before = np.arange(len(data)) - offsets[:-1][owner]
    behind = np.diff(offsets)[owner] - before - 20
    at = before + begin[owner]
    sampled = np.flatnonzero((at % 3 != 0) & (behind >= 0))
    around = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(24, np.uint8)])
    byte = lambda shift: around[sampled + shift + 2]
    word = lambda first, n: sum(byte(first + k).astype(np.uint64) << common.U64(8 * (n - 1 - k)) for k in range(n))
    out = np.zeros(len(sampled), TRIPLE)
    out["k1"], out["k2"], out["k3"] = word(0, 8), word(8, 8), word(16, 4)
    out["around"] = sum(byte(s).astype(np.uint32) << np.uint32(8 * k) for k, s in enumerate((-2, -1, 20, 21)))
    out["unit"], out["at"] = unit[owner[sampled]], at[sampled]
    out["lead"], out["room"] = np.minimum(before[sampled], 2), np.minimum(behind[sampled], 2)
    return out


def binaries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def prefix(records: np.ndarray) -> np.ndarray:
    """The first 16 bytes of each key, which order as the key does."""
    return np.stack([records["k1"], records["k2"]], 1).astype(">u8").view("S16").ravel()


def _triples_of_names(records: np.ndarray, shift: int, back: int) -> pa.RecordBatch:
    """Records of three names that cover a window, at the suffixes that a shift serves."""
    at = records["at"].astype(np.int64)
    place = np.cumsum(np.append(0, records["unit"][1:] != records["unit"][:-1])) * (1 << 33) + at

    def there(shift: int) -> tuple[np.ndarray, np.ndarray]:
        # Two of three places are sampled: only where some have no name is the place looked for.
        where = np.minimum(np.arange(len(place)) + 2 * shift // 3, len(place) - 1)
        found = place[where] == place + shift
        miss = np.flatnonzero(~found)
        where[miss] = np.minimum(np.searchsorted(place, place[miss] + shift), len(place) - 1)
        found[miss] = place[where[miss]] == place[miss] + shift
        return where, found

    around = lambda rows, k: (records["around"][rows] >> np.uint32(8 * k)) & np.uint32(255)
    second, third = SHIFTS[shift]
    w2, ok2 = there(second)
    w3, ok3 = there(third)
    start = at - shift
    # Where names end before the window does, the segment must hold the bytes behind them.
    fits = records["room"][w3] >= WINDOW - 20 - shift - third
    good = np.flatnonzero(ok2 & ok3 & fits & (records["lead"] >= shift))
    out = np.zeros(len(good), SUFFIX)
    out["a"], out["b"], out["c"] = records["name"][good], records["name"][w2[good]], records["name"][w3[good]]
    tail = w3[good]
    if shift == 1:  # one byte before the names, two behind
        rest = around(good, 1) | around(tail, 2) << np.uint32(8) | around(tail, 3) << np.uint32(16)
    elif shift == 2:  # two bytes before, one behind
        rest = around(good, 0) | around(good, 1) << np.uint32(8) | around(tail, 2) << np.uint32(16)
    else:
        rest = np.zeros(len(good), np.uint32)
    out["rest"] = rest | np.uint32(shift << 24)
    out["unit"], out["at"] = records["unit"][good], start[good]
    return packed((key_hash(out) % common.U64(back)).astype(np.int32), out)


#: Odd numbers that the fields of a suffix's key count with in its hash.
FACTORS = {"a": 0x9E3779B97F4A7C15, "b": 0xC2B2AE3D27D4EB4F, "c": 0xD6E8FEB86659FD93, "rest": 0xA0761D6478BD642F}


def key_hash(suffixes: np.ndarray) -> np.ndarray:
    return common.mix64(sum(suffixes[field].astype(np.uint64) * common.U64(k) for field, k in FACTORS.items()))


def brought_together(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes with those of equal keys next to each other; and where another key begins.

    Sorted by a hash of the key, and by the key itself if two keys have the same hash.
    """
    n = len(suffixes)
    low = common.U64((1 << n.bit_length()) - 1)
    key = (key_hash(suffixes) & ~low) | np.arange(n, dtype=np.uint64)
    key.sort()

    def parted(rows: np.ndarray) -> np.ndarray:
        other = np.zeros(max(0, n - 1), bool)
        for field in FACTORS:
            column = rows[field]
            other |= column[1:] != column[:-1]
        return other

    rows = suffixes[(key & low).astype(np.int64)]
    other = parted(rows)
    if np.any(other & (key[1:] & ~low == key[:-1] & ~low)):
        rows = suffixes[np.lexsort([suffixes[field] for field in FACTORS])]
        other = parted(rows)
    return rows, np.append(True, other)[:n]


def text_order(unit: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order by unit, then place: by one number if both fit in 64 bits."""
    bits = int(at.max(initial=0)).bit_length()
    if int(unit.max(initial=0)) >> (63 - bits):
        return np.lexsort((at, unit))
    return np.argsort(unit.astype(np.int64) << bits | at.astype(np.int64))


def gone_runs(gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units and runs of the window starts that go, in order; each start counts once."""
    unit, at = gone["unit"].astype(np.uint64), gone["at"].astype(np.uint64)
    bits = int(at.max(initial=0)).bit_length()
    if int(unit.max(initial=0)) >> (64 - bits):
        order = np.lexsort((at, unit))
        unit, at = unit[order], at[order]
    else:
        key = np.sort(unit << common.U64(bits) | at)
        unit, at = key >> common.U64(bits), key & common.U64((1 << bits) - 1)
    unit, at = unit.astype(np.int64), at.astype(np.int64)
    new = np.append(True, (unit[1:] != unit[:-1]) | (at[1:] - at[:-1] > 1))[: len(unit)]
    runs = np.zeros(int(new.sum()), RUN)
    runs["at"] = at[new]
    runs["many"] = at[np.append(new[1:], True)[: len(new)]] - at[new] + 1
    return unit[new], runs


def numbered(distinct: DataFrame, label: str) -> DataFrame:
    """Add unit, numbers of the segments in the order of their documents: equal up to DOC_SHIFT bits
    for segments of one document."""
    docs = distinct.select("doc").distinct()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("local")
    ranked = docs.repartitionByRange(parts, "doc").sortWithinPartitions("doc")
    ranked = staged(ranked.select("doc", F.spark_partition_id().alias("part"), local), f"{label}-docs")
    # One row for each partition.
    sizes = sorted((r["part"], r["count"]) for r in ranked.groupBy("part").count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    starts = docs.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part int, before long")
    rank = ranked.join(F.broadcast(starts), "part").select("doc", (F.col("before") + F.col("local")).alias("rank"))
    own = F.row_number().over(Window.partitionBy("doc").orderBy("content", "begin")) - 1
    unit = F.shiftleft(F.col("rank"), DOC_SHIFT) + F.col("own")
    return distinct.withColumn("own", own).join(rank, "doc").withColumn("unit", unit).drop("own", "rank")


def copied_windows(units: DataFrame, buckets: int) -> DataFrame:
    """unit, starts: runs of window starts of each segment whose blocks a segment of a smaller document has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch in common.slices(batches, "data", SLICE):
            data, offsets = binaries(batch.column("data"))
            least = least_hashes(cutter.part_hashes(data))
            new = np.append(True, least[1:] != least[:-1])
            new[offsets[:-1]] = True
            at = np.flatnonzero(new)
            owner = np.searchsorted(offsets, at, side="right") - 1
            inner = at <= offsets[owner + 1] - WINDOW
            end = np.minimum(np.append(at[1:], len(data)), offsets[owner + 1] - WINDOW + 1)[inner]
            at, owner = at[inner], owner[inner]
            blocks = np.zeros(len(at), BLOCK)
            for field, name in zip(("one", "two"), cutter.names(data, at, end)):
                blocks[field] = name.view(np.uint64)
            blocks["unit"], blocks["at"], blocks["many"] = batch.column("unit").to_numpy()[owner], at - offsets[owner], end - at
            yield packed((blocks["one"] % common.U64(buckets)).astype(np.int32), blocks)

    def meet(_: int, blocks: np.ndarray) -> Iterator[pa.RecordBatch]:
        blocks = blocks[np.lexsort((blocks["two"], blocks["one"]))]
        first = np.append(True, (blocks["one"][1:] != blocks["one"][:-1]) | (blocks["two"][1:] != blocks["two"][:-1]))[: len(blocks)]
        doc = blocks["unit"] >> DOC_SHIFT
        least = np.minimum.reduceat(doc, np.flatnonzero(first))[np.cumsum(first) - 1] if len(doc) else doc
        late = blocks[doc > least]
        yield packed((common.mix64(late["unit"].astype(np.int64).view(np.uint64)) % common.U64(buckets)).astype(np.int32), late)

    def starts(_: int, late: np.ndarray) -> Iterator[pa.RecordBatch]:
        """One row for each segment: its runs in order, those that follow each other as one."""
        late = late[np.lexsort((late["at"], late["unit"]))]
        unit, at, end = late["unit"].astype(np.int64), late["at"].astype(np.int64), late["at"].astype(np.int64) + late["many"]
        new = np.append(True, (unit[1:] != unit[:-1]) | (at[1:] != end[:-1]))[: len(unit)]
        runs = np.zeros(int(new.sum()), RUN)
        runs["at"], runs["many"] = at[new], end[np.append(new[1:], True)[: len(unit)]] - at[new]
        unit = unit[new]
        cuts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])[: len(unit)])
        yield pa.RecordBatch.from_arrays([pa.array(unit[cuts], pa.int64()), blobs_of(runs, cuts)], names=["unit", "starts"])

    late = by_bucket(units.mapInArrow(send, PACKED), buckets, BLOCK, meet, PACKED)
    return by_bucket(late, buckets, BLOCK, starts, "unit long, starts binary")


def without_runs(units: DataFrame, copied: DataFrame) -> DataFrame:
    """unit, begin, data: the parts of each segment that windows outside its runs need; they don't touch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "data", SLICE):
            data, offsets = binaries(batch.column("data"))
            starts = batch.column("starts")
            many = pc.fill_null(pc.binary_length(starts), 0).to_numpy() // RUN.itemsize
            runs = np.frombuffer(b"".join(starts.drop_null().to_pylist()), RUN)
            begin = np.repeat(offsets[:-1], many) + runs["at"]
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, begin, 1)
            np.add.at(depth, begin + runs["many"], -1)
            stays = np.cumsum(depth)[: len(data)] == 0
            # A segment's last bytes start no window.
            for back in range(1, WINDOW):
                stays[offsets[1:] - back] = False
            first, stop = common.runs(stays, offsets)
            stop = stop + (WINDOW - 1)
            owner = np.searchsorted(offsets, first, side="right") - 1
            new = np.append(True, (owner[1:] != owner[:-1]) | (first[1:] > stop[:-1]))[: len(first)]
            first, stop, owner = first[new], stop[np.append(new[1:], True)[: len(new)]], owner[new]
            raw = data.tobytes()
            columns = [batch.column("unit").take(pa.array(owner, pa.int64())), pa.array(first - offsets[owner], pa.int32())]
            columns.append(pa.array([raw[a:b] for a, b in zip(first.tolist(), stop.tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "begin", "data"])

    rows = units.select("unit", "data").join(copied, "unit", "left").select("unit", "data", "starts")
    return rows.mapInArrow(cut, "unit long, begin int, data binary")


def covered_windows(units: DataFrame, total: int, label: str) -> DataFrame:
    """unit, starts: runs of window starts of each segment that also start in one of a smaller document.

    units: unit (number of the segment, see `numbered`), data. total: bytes of data. A segment has two
    rows at most: of the blocks that others have whole, and of what the sort finds in the others.
    """
    copied = common.settled(copied_windows(units, max(1, -(-total // BLOCKS_OF))), f"{label}-copied")
    units = common.settled(without_runs(units, copied), f"{label}-rest")
    total = int(units.agg(F.sum(F.length("data"))).first()[0] or 0)
    rest = units
    buckets = max(PASSES, -(-total * TRIPLE.itemsize // BUCKET_BYTES))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "data", SLICE):
            records = triples(batch)
            keep = common.mix64(records["unit"].view(np.uint64) + records["at"]) % common.U64(max(1, total)) < SPLIT_SAMPLE
            yield pa.RecordBatch.from_arrays([pa.array(prefix(records)[keep].tolist(), pa.binary())], names=["key"])

    drawn = sorted(r["key"] for r in units.mapInArrow(keys, "key binary").limit(2 * SPLIT_SAMPLE).collect())
    splits = np.array([drawn[i * len(drawn) // buckets] for i in range(1, buckets)] if drawn else [], "S16")

    def send(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        """The triples of the buckets whose turn it is."""
        for batch in common.slices(batches, "data", SLICE):
            records = triples(batch)
            bucket = np.searchsorted(splits, prefix(records), side="right").astype(np.int32)
            now = bucket % PASSES == turn
            yield packed(bucket[now], records[now])

    back = max(1, buckets)

    def name(bucket: int, records: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Sort the bucket's triples and name them in order; those that one document alone has need no name."""
        k1, k2, k3 = (records[c].astype(c_type) for c, c_type in (("k1", np.uint64), ("k2", np.uint64), ("k3", np.uint32)))
        order = np.lexsort((k3, k2, k1))
        k1, k2, k3 = k1[order], k2[order], k3[order]
        first = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (k3[1:] != k3[:-1]))
        rank = np.cumsum(first)
        doc, starts = records["unit"][order] >> DOC_SHIFT, np.flatnonzero(first)
        many = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts))[rank - 1] if len(doc) else first
        out = np.zeros(int(many.sum()), NAMED)
        chosen = records[order][many]
        out["name"] = (np.int64(bucket) << 36) + rank[many]
        for field in ("around", "unit", "at", "lead", "room"):
            out[field] = chosen[field]
        for lo in range(0, len(out), 1 << 18):
            part = out[lo : lo + (1 << 18)]
            yield packed((common.mix64(part["unit"].view(np.uint64)) % common.U64(back)).astype(np.int32), part)

    def gathered(_: int, records: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Named suffixes in the order of the text, in pieces that hold whole segments."""
        records = records[text_order(records["unit"], records["at"])]
        ends = np.flatnonzero(np.append(records["unit"][1:] != records["unit"][:-1], True)) + 1
        cuts = [0]
        for end in ends.tolist():
            if (end - cuts[-1]) * NAMED.itemsize >= PIECE_BYTES or end == len(records):
                cuts.append(end)
        pieces = [records[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.binary())], names=["records"])

    named = None
    for turn in range(PASSES):
        sent = units.mapInArrow(partial(send, turn=turn), PACKED)
        part = common.settled(by_bucket(sent, buckets, TRIPLE, name, PACKED, EACH), f"{label}-names")
        named = [part] if named is None else [*named, part]
    everything = named[0]
    for part in named[1:]:
        everything = everything.unionByName(part)
    pieces = []
    for turn in range(PASSES):
        some = everything.where(F.col("bucket") % PASSES == turn)
        pieces.append(common.settled(by_bucket(some, back, NAMED, gathered, "records binary", EACH), f"{label}-pieces"))
    common.discard(*named)
    text = pieces[0]
    for part in pieces[1:]:
        text = text.unionByName(part)

    def recurse(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
        """Triples of names: of sampled suffixes, and of the pairs of classes that meet by a shift."""
        for batch in common.slices(batches, "records", 32 * SLICE):
            records = np.frombuffer(b"".join(batch.column("records").to_pylist()), NAMED)
            yield _triples_of_names(records, shift, back)

    def adjacent(_: int, records: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Suffixes of equal keys share WINDOW bytes."""
        if not len(records):
            return
        records, first = brought_together(records)
        doc = records["unit"] >> DOC_SHIFT
        least = np.minimum.reduceat(doc, np.flatnonzero(first))[np.cumsum(first) - 1]
        late = records[doc > least]
        gone = np.zeros(len(late), GONE)
        gone["unit"], gone["at"] = late["unit"], late["at"]
        yield packed((common.mix64(gone["unit"].view(np.uint64)) % common.U64(fewer)).astype(np.int32), gone)

    def starts(_: int, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        """One row for each segment: the runs of its window starts that go."""
        unit, runs = gone_runs(gone)
        cuts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])[: len(unit)])
        yield pa.RecordBatch.from_arrays([pa.array(unit[cuts], pa.int64()), blobs_of(runs, cuts)], names=["unit", "starts"])

    # One shift after the other: the records of one are gone before the next ones are made.
    fewer = max(1, back // 4)
    found, parts = None, []
    for shift in SHIFTS:
        suffixes = text.mapInArrow(partial(recurse, shift=shift), PACKED)
        parts.append(common.settled(by_bucket(suffixes, back, SUFFIX, adjacent, PACKED, EACH), f"{label}-covered"))
        found = parts[-1] if found is None else found.unionByName(parts[-1])
    common.discard(*pieces)
    cover = by_bucket(found, fewer, GONE, starts, "unit long, starts binary").unionByName(copied)
    cover = common.settled(cover, f"{label}-runs")
    common.discard(copied, rest, *parts)
    return cover


def repeated(docs: DataFrame, others: tuple[str, ...] = (), label: str = "suffixes") -> DataFrame:
    """doc_id, kept (binary), begins, ends (removed runs, bytes) and n_bytes of every row of docs.

    The columns named in others are passed through.
    """
    spark = docs.sparkSession
    passed = F.struct(*others).alias("_others") if others else F.lit(None).cast("int").alias("_others")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), passed)
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("version"), "text", "_others")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    plain = docs.select("doc", "version", "text")
    units = common.settled(units_of(plain), f"{label}-units")
    repeats = units.groupBy("one", "two").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("most")).where("first_doc < most")
    repeats = common.settled(repeats.select("one", "two", "first_doc"), f"{label}-repeats")
    candidates = common.settled(anchored(plain, max(partitions, 1)), f"{label}-anchored")

    # The first place of a candidate in the least document that holds it stands for all.
    paired = candidates.groupBy(F.col("unit").alias("one")).agg(F.collect_list(F.struct("anchor", "cases")).alias("pairs"))
    least = F.min(F.struct("doc", "version", "begin", "size")).alias("least")
    owned = units.join(paired.select("one"), "one", "left_semi").groupBy("one", "two").agg(least).join(paired, "one")
    places = owned.groupBy("least.doc", "least.version").agg(
        F.collect_list(F.struct("least.begin", "least.size", "one", "two", "pairs")).alias("shared")
    )
    sources = plain.join(places, ["doc", "version"])
    # Rows that are equal in id and text give their segments once.
    sources = sources.dropDuplicates(["doc", "version"])
    texts = common.settled(segments(sources.select("doc", "text", "shared")), f"{label}-texts")
    common.discard(candidates)
    wider, texts = texts, common.settled(trimmed(texts, max(partitions, 1), ("one", "two"), pieces=True), f"{label}-trimmed")
    common.discard(wider)
    # Segments of equal bytes stand for each other, by the least document that has them. What is left of them
    # where another segment's document has the windows as well is sorted.
    trimmed_texts, texts = texts, texts.withColumn("content", F.unhex(F.substring(F.sha2("data", 256), 1, 32)))
    distinct = texts.groupBy("content").agg(F.min("doc").alias("doc"), F.max("doc").alias("most"), F.first("data").alias("data"))
    distinct = common.settled(distinct.withColumns({"begin": F.lit(0), "unit": F.xxhash64("content")}), f"{label}-distinct")
    shared = common.settled(trimmed(distinct, max(partitions, 1), ("content",)), f"{label}-shared")
    sorted_ = common.settled(numbered(shared, label), f"{label}-sorted")
    common.discard(shared)
    total = sorted_.agg(F.sum(F.length("data"))).first()[0] or 0
    cover = covered_windows(sorted_, int(total), label)

    # A unit goes whole where a smaller document holds it. Every place of a unit in the least document
    # that holds it loses the same windows: those that start in a smaller document as part of another unit.
    none = F.lit(None)
    shape = ("doc", "version", "begin", "size", "starts")
    whole = units.join(repeats, ["one", "two"]).where("doc > first_doc")
    whole = whole.withColumns({"size": F.col("size") + (WINDOW - 1), "starts": none.cast("binary")}).select(*shape)
    whole = common.settled(whole, f"{label}-whole")
    first = sorted_.join(cover, "unit").select("content", F.col("doc").alias("first_doc"), F.col("begin").alias("behind"), "starts")
    several = distinct.where("most > doc").select("content", F.col("doc").alias("first_doc"), F.lit(0).alias("behind"), none.cast("binary").alias("starts"))
    first = common.settled(first.unionByName(several), f"{label}-cover")
    common.discard(distinct, sorted_, cover)
    partly = texts.select("content", "doc", "one", "two", "begin", F.length("data").alias("part")).join(first, "content")
    partly = partly.where("if(starts is null, doc > first_doc, doc = first_doc)")
    partly = partly.select("doc", "one", "two", (F.col("begin") + F.col("behind")).alias("within"), "part", "starts")
    partly = common.settled(partly, f"{label}-partly")
    common.discard(repeats, trimmed_texts, first)
    partly = units.drop("size").join(partly, ["one", "two", "doc"])
    partly = partly.withColumns({"begin": F.col("begin") + F.col("within"), "size": F.col("part")}).select(*shape)
    marks = whole.unionByName(partly).groupBy("doc", "version").agg(F.collect_set(F.struct("begin", "size", "starts")).alias("marks"))
    marks = common.settled(marks, f"{label}-marks")
    common.discard(units, whole)
    out = removed(docs.join(marks.hint("shuffle_hash"), ["doc", "version"], "left").select("doc_id", "text", "marks", "_others"))
    return out.select("doc_id", "kept", "begins", "ends", "n_bytes", *(f"_others.{c}" for c in others))


def removed(docs: DataFrame) -> DataFrame:
    """Drop every byte that a marked window covers."""

    def make():
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = common.utf8(batch.column("text"))
            depth = np.zeros(len(data) + WINDOW + 1, np.int32)
            lists = batch.column("marks")
            marks = lists.flatten()
            begin = np.repeat(offsets[:-1], pc.fill_null(pc.list_value_length(lists), 0).to_numpy()) + marks.field("begin").to_numpy()
            some = marks.field("starts").is_valid().to_numpy(zero_copy_only=False)
            whole = begin[~some]
            many = pc.fill_null(pc.binary_length(marks.field("starts")), 0).to_numpy() // RUN.itemsize
            part = np.frombuffer(b"".join(marks.field("starts").drop_null().to_pylist()), RUN)
            at = np.repeat(begin, many) + part["at"]
            first = np.concatenate([whole, at])
            last = np.concatenate([whole + marks.field("size").to_numpy()[~some], at + part["many"] + (WINDOW - 1)])
            np.add.at(depth, first, 1)
            np.add.at(depth, last, -1)
            gone = np.cumsum(depth)[: len(data)] > 0
            begin, stop = common.runs(gone, offsets)
            owner = np.searchsorted(offsets, begin, side="right") - 1
            counts = np.bincount(owner, minlength=batch.num_rows)
            lost = np.append(0, np.cumsum(stop - begin))
            before = offsets[:-1] - lost[np.searchsorted(begin, offsets[:-1])]
            columns = [
                batch.column("doc_id"),
                blobs_of(data[~gone], before),
                common.lists(begin - offsets[owner], counts, pa.int32()),
                common.lists(stop - offsets[owner], counts, pa.int32()),
                pa.array(np.diff(offsets), pa.int64()),
                batch.column("_others"),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "begins", "ends", "n_bytes", "_others"])

        return kernel

    schema = f"doc_id long, kept binary, begins array<int>, ends array<int>, n_bytes long, _others {docs.schema['_others'].dataType.simpleString()}"
    return common.arrow_map(docs, make, schema, "text", SLICE)


def readable(found: DataFrame) -> DataFrame:
    """Add text, the kept bytes as characters; what is left of a character that was cut goes too."""

    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda x: bytes(x).decode("utf-8", "ignore"))

    return found.withColumn("text", F.pandas_udf(decoded, "string")("kept"))
