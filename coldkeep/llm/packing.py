"""Packing documents into sequences by shortest-pack-first over the length histogram.

Documents are tokenised and cut at multiples of the sequence length, so that only last pieces are
shorter. The histogram of piece lengths has as many bins as a sequence has tokens. Lengths are
placed longest first, always into the open packs with the most room, whole counts at a time: the
work is bounded by the number of lengths and patterns, not by the documents. Pieces meet their
place by rank: the r-th piece of a length takes the r-th place the patterns have for this length.

Defined results: a null or empty text is one piece with the end id alone; rows that repeat a doc_id
are packed one by one; an empty table has no pieces; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldkeep.llm import common
from coldkeep.llm.bpe import Memory, Merges
from coldkeep.llm.common import staged

SEQUENCE = 2048
END_ID = 1
#: Words whose ids a worker remembers; it starts anew when the memory is full.
REMEMBERED = 500_000
#: Lower-case letters of Latin-1, then signs: two runs of the tokenizer's own rule.
PLAIN = re.compile("([a-zß-öø-ÿ]{1,24})([!-&(-/:-@[-`{-~]{1,6})?")
#: Pieces of one length that are ranked together: so many on average, and fewer while that makes FEW_PARTS at most.
RANK_ROWS, FEW_ROWS, FEW_PARTS = 200_000, 200, 64
SPACE_BYTES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Texts with other bytes than those of ASCII and of Latin-1 letters are left to the library.
ODD_BYTES = (np.arange(256) >= 0x1C) & (np.arange(256) <= 0x1F) | (np.arange(256) >= 0xC0) & (np.arange(256) != 0xC3)
#: Characters that one side takes for white space and the other doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f\x85᠎​  ﻿]")


class WordEncoder:
    """Ids of the tokenizer file, by words: it drops white space and never joins across it.

    Equal words have equal ids, so each distinct word is encoded once. Texts of Latin-1 letters are
    lower-cased first, which commutes with the tokenizer's own folding there; plain words are merged
    together in numpy. All other words and texts are left to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge = Merges({(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)})
        # Each byte is one symbol, the last one of a word another. Unprintable bytes have letters from 256 on.
        spare = iter(range(256, 512))
        byte = [chr(b if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else next(spare)) for b in range(256)]
        self.inner = np.array([vocab[c] for c in byte])
        self.last = np.array([vocab[c + suffix] for c in byte])
        self.hash = common.SpanHash(11)
        self.memory = Memory(self.learn, REMEMBERED)

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def learn(self, new: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        runs: dict[str, np.ndarray] = {}
        by_width: dict[int, list[str]] = defaultdict(list)
        words = [data.decode() for data in new]
        split = [m.groups() if (m := PLAIN.fullmatch(w)) else None for w in words]
        for run in {run for groups in split if groups for run in groups if run}:
            by_width[len(run.encode())].append(run)
        for width, group in by_width.items():
            data = np.frombuffer("".join(group).encode(), np.uint8).reshape(-1, width)
            symbols = self.inner[data]
            symbols[:, -1] = self.last[data[:, -1]]
            runs.update(zip(group, self.merge(symbols)))
        return [
            self.library(word) if not groups else np.concatenate([runs[groups[0]], runs[groups[1]]]) if groups[1] else runs[groups[0]]
            for word, groups in zip(words, split)
        ]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as UTF-8, and the number of ids of each."""
        texts = len(offsets) - 1
        after_c3 = np.zeros(len(data), bool)
        after_c3[1:] = data[:-1] == 0xC3
        odd = ODD_BYTES[data]
        odd[1:] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        odd_text = np.add.reduceat(np.append(odd, False), offsets[:-1], dtype=np.int64) if texts else np.zeros(0, np.int64)
        odd_text = (odd_text > 0) & (np.diff(offsets) > 0)
        upper = (data >= 65) & (data <= 90) | after_c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        lower = data + (upper * np.uint8(32))
        inside = ~SPACE_BYTES[data] & ~np.repeat(odd_text, np.diff(offsets))
        start, end = common.runs(inside, offsets)
        ids, sizes = self.memory(lower, start, end, self.hash(lower, start, end))
        counts = np.bincount(np.searchsorted(offsets, start, side="right") - 1, sizes, minlength=texts).astype(np.int64)
        if odd_text.any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(odd_text):
                parts[i] = self.library(data[offsets[i] : offsets[i + 1]].tobytes().decode())
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts


def encoder(path: str) -> WordEncoder:
    """One encoder a worker, so that its memory lasts from task to task."""
    return common.held(("words", path), lambda: WordEncoder(path))


def pieces(docs: DataFrame, path: str, length: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of every piece."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else "")

    def make():
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode = encoder(path)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            all_ids, counts = encode(*common.utf8(batch.column("text")))
            ends = np.cumsum(counts)
            all_ids = np.insert(all_ids, ends, END_ID).astype("<i4")
            counts = counts + 1
            firsts = np.cumsum(counts) - counts
            parts = -(-counts // length)
            owner = np.repeat(np.arange(len(counts)), parts)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            size = np.minimum(length, counts[owner] - start)
            at = firsts[owner] + start
            ids = [all_ids[a:b] for a, b in zip(at.tolist(), (at + size).tolist())]
            crc = [zlib.crc32(x.tobytes()) for x in ids]
            total = counts[owner]
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int32()))]
            columns += [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names=names)

        return kernel

    return common.arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema, "text", keep=True)


def patterns(histogram: dict[int, int], length: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths of one sequence) of a shortest-pack-first packing of the histogram."""
    open_by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    full: list[tuple[int, tuple[int, ...]]] = []

    def put(count: int, pack: tuple[int, ...], room: int) -> None:
        (open_by_room[room] if room else full).append((count, pack))

    most_room = length
    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        left = histogram[size]
        room = most_room
        while left:
            while room >= size and not open_by_room[room]:
                room -= 1
            if room < size:
                put(left, (size,), length - size)
                break
            count, pack = open_by_room[room].pop()
            used = min(count, left)
            if count > used:
                open_by_room[room].append((count - used, pack))
            put(used, (*pack, size), room - size)
            left -= used
    return full + [entry for packs in open_by_room.values() for entry in packs]


class Places:
    """For each length, the places that patterns have for it, in order of rank."""

    def __init__(self, packed: list[tuple[int, tuple[int, ...]]]):
        by_size: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        base = 0
        for count, pack in packed:
            offset = 0
            for size in pack:
                by_size[size].append((count, base, offset))
                offset += size
            base += count
        self.table = {}
        for size, rows in by_size.items():
            counts, bases, offsets = np.array(rows, np.int64).T
            self.table[size] = (np.cumsum(counts), np.cumsum(counts) - counts, bases, offsets)

    def __call__(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        for size in np.unique(sizes):
            mine = sizes == size
            ends, starts, bases, offsets = self.table[int(size)]
            at = np.searchsorted(ends, ranks[mine], side="right")
            sequence[mine] = bases[at] + ranks[mine] - starts[at]
            offset[mine] = offsets[at]
        return sequence, offset


def pack(docs: DataFrame, path: str, length: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and its offset there.

    Pieces of one length are ranked in parts whose number grows with them, so that a length that most
    pieces have, the full one at that, is ranked by many tasks.
    """
    cut = staged(pieces(docs, path, length, keep_ids), "packing")
    # One row for each length that occurs.
    parts = lambda n: max(-(-n // RANK_ROWS), min(FEW_PARTS, -(-n // FEW_ROWS)))
    lengths = [(r["length"], parts(r["count"])) for r in cut.groupBy("length").count().collect()]
    of_length = cut.sparkSession.createDataFrame(lengths, "length long, parts long")
    dealt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("parts")).cast("int").alias("part")
    cut = cut.join(F.broadcast(of_length), "length").select(*cut.columns, dealt)
    sizes = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    # One row for RANK_ROWS pieces, and FEW_PARTS for each length at most.
    counts = sizes.toPandas().sort_values(["length", "part"])
    counts["first"] = counts.groupby("length")["n"].cumsum() - counts["n"]
    histogram = {int(k): int(n) for k, n in counts.groupby("length")["n"].sum().items()}
    places = Places(patterns(histogram, length))
    firsts = {(int(a), int(b)): int(c) for a, b, c in zip(counts["length"], counts["part"], counts["first"])}

    order = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(order) - 1)

    def place(frames):
        for frame in frames:
            first = [firsts[key] for key in zip(frame["length"], frame["part"])]
            sequence, offset = places(frame["length"].to_numpy(), frame["rank"].to_numpy() + np.array(first, np.int64))
            yield frame.drop(columns=["part", "rank"]).assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name != "part")
    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")
