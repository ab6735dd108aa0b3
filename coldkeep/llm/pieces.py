"""SentencePiece BPE encoding that keeps source offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest prefix that
the map knows is replaced, and every normalised byte records the source byte it came from. Pieces
cover runs of normalised bytes, so each piece is projected to the bytes of the original text.

Encoding works run by run: white space followed by other characters. No piece of the model has
white space after another character, so merges never cross into the next run and equal runs have
equal pieces; a worker remembers them.

Defined results: a null text is an empty one with no pieces; spans are byte offsets, begin
inclusive and end exclusive, and the inserted leading space has an empty span of its own; rows that
repeat a doc_id are encoded one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common
from coldkeep.llm.bpe import Memory, Merges

#: Runs whose pieces a worker remembers; it starts anew when the memory is full.
REMEMBERED = 800_000
SPACE = "▁"
#: Longer runs are left to the library.
LONGEST_RUN = 40
NORMAL, BYTE = 1, 6


class CharacterMap:
    """Longest-prefix lookup in a compiled map: a double array over UTF-8, then the replacements."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of data[at:] and its replacement."""
        units, best = self.units, None
        jump = lambda unit: (unit >> 10) << ((unit & (1 << 9)) >> 6)
        node = jump(units[0])
        for n in range(at, len(data)):
            node ^= data[n]
            unit = units[node]
            if unit & (1 << 31 | 0xFF) != data[n]:
                break
            node ^= jump(unit)
            if unit >> 8 & 1:
                best = (n + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]


class Normalizer:
    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.space = SPACE.encode() if self.escape else b" "

    @property
    def plain(self) -> bool:
        """Only spaces change."""
        return self.map is None and not self.trim

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source offset of each of them and of the end."""
        units: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at) if self.map else None
            first = data[at]
            length, text = found or (n := 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4, data[at : at + n])
            units.append((text, at))
            at += length
        flat = [(bytes([b]), source) for text, source in units for b in text]
        if self.trim:
            kept = [x for i, x in enumerate(flat) if x[0] != b" " or (i and flat[i - 1][0] != b" ")]
            while kept and kept[-1][0] == b" ":
                kept.pop()
            flat = kept
        if not flat:
            return b"", np.array([len(data)])
        if self.prefix:
            flat.insert(0, (b" ", -1))
        out, origin = [], []
        for byte, source in flat:
            byte = self.space if byte == b" " else byte
            out.append(byte)
            origin += [max(source, 0)] * len(byte)
        return b"".join(out), np.array([*origin, len(data)])


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.normalizer = Normalizer(model.normalizer_spec)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = np.array([byte[b] for b in range(256)])
        self.size = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces])
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        # Runs are independent only if no piece has white space behind another character.
        assert not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        score = {p.piece: p.score for p in model.pieces}
        rank = {s: n for n, s in enumerate(sorted({score[p] for p in self.ids}, reverse=True))}
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank[score[piece]], i)
        self.merge = Merges(pairs)
        self.character = {p: i for p, i in self.ids.items() if len(p) == 1}
        self.hash = common.SpanHash(13)
        self.memory = Memory(self.learn, REMEMBERED)

    def learn(self, runs: list[bytes]) -> list[np.ndarray]:
        """Ids of each run of normalised text; a leading NUL says that the run is a text's first."""
        out: list[np.ndarray] = [None] * len(runs)
        by_width: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
        get = self.character.get
        for i, run in enumerate(runs):
            text = run.decode()
            ids = [get(c) for c in text]
            if None in ids or len(ids) > LONGEST_RUN:
                out[i] = self.by_character(text) if len(ids) <= LONGEST_RUN else self.by_library(text)
            else:
                by_width[len(ids)].append((i, ids))
        for group in by_width.values():
            for (i, _), ids in zip(group, self.merge(np.array([x for _, x in group]))):
                out[i] = ids
        return out

    def by_character(self, text: str) -> np.ndarray:
        """Characters that the model doesn't know fall back to their bytes and part the rest."""
        parts = []
        for part in re.split("(" + "|".join({re.escape(c) for c in text if c not in self.character}) + ")", text):
            if part in self.character or all(c in self.character for c in part):
                ids = [[self.character[c] for c in part]]
                parts += self.merge(np.array(ids)) if part else []
            else:
                parts.append(self.bytes[list(part.encode())])
        return np.concatenate(parts)

    def by_library(self, text: str) -> np.ndarray:
        """A line feed keeps the library from joining its leading space to the run."""
        ids = np.array(self.library.encode("\n" + text.replace(SPACE, " ")), np.int64)
        return ids[2:]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8), ids of each text, begin and end byte of each id in its text."""
        if self.normalizer.plain:
            normal, norm_offsets, origin = self._escape(data, offsets)
        else:
            done = [self.normalizer(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            normal = np.frombuffer(b"".join(x for x, _ in done), np.uint8)
            norm_offsets = np.cumsum([0, *(len(x) for x, _ in done)])
            origin = np.concatenate([*(y for _, y in done), np.zeros(0, np.int64)])
        space = self._spaces(normal)
        after_space = np.zeros(len(normal), bool)
        after_space[3:] = space[:-3]
        first = np.zeros(len(normal) + 1, bool)
        first[norm_offsets] = True
        line = normal == 10
        first[: len(normal)] |= line | space & ~after_space
        first[1:] |= line
        start = np.flatnonzero(first[: len(normal)])
        end = np.append(start[1:], len(normal))
        ids, sizes = self.memory(normal, start, end, self.hash(normal, start, end))
        text = np.searchsorted(norm_offsets, start, side="right") - 1
        counts = np.bincount(text, sizes, minlength=len(offsets) - 1).astype(np.int64)
        # Origins have one more entry a text than normalised bytes: its end.
        owner = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(self.size[ids])
        begin, end = origin[ends - self.size[ids] + owner], origin[ends + owner]
        return ids, counts, begin, end

    @staticmethod
    def _spaces(normal: np.ndarray) -> np.ndarray:
        """True at the first byte of each escaped space."""
        found = np.zeros(len(normal), bool)
        found[:-2] = (normal[:-2] == 0xE2) & (normal[1:-1] == 0x96) & (normal[2:] == 0x81)
        return found

    def _escape(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The normaliser for all texts at once where only spaces change."""
        mark = np.frombuffer(self.normalizer.space, np.uint8)
        width = np.where(data == 32, len(mark), 1)
        lengths = np.diff(offsets)
        prefix = np.where(lengths > 0, len(mark) if self.normalizer.prefix else 0, 0)
        text = np.repeat(np.arange(len(lengths)), lengths)
        at = np.cumsum(width) - width + np.cumsum(prefix)[text]
        total = int(width.sum() + prefix.sum())
        normal = np.zeros(total, np.uint8)
        normal[at] = data
        spaces = at[data == 32]
        heads = np.cumsum(prefix) - prefix + np.concatenate([[0], np.cumsum(width)])[offsets[:-1]]
        for k, byte in enumerate(mark):
            normal[spaces + k] = byte
            normal[heads[prefix > 0] + k] = byte
        norm_offsets = np.append(heads, total)
        # Source offset within the text of each normalised byte; a prefix has none of its own.
        inner = np.arange(len(data)) - offsets[:-1][text]
        origin = np.zeros(total + len(lengths), np.int64)
        slot = np.repeat(at + text, width) + (np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width))
        origin[slot] = np.repeat(inner, width)
        origin[norm_offsets[1:] + np.arange(len(lengths))] = lengths
        return normal, norm_offsets, origin


@cache
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker, so that its memory lasts from task to task."""
    return PieceEncoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, begins, ends (byte spans of the pieces) and decoded, the text of the ids."""

    def make():
        encode = encoder(path)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, counts, begin, end = encode(*common.utf8(batch.column("text")))
            cuts = np.cumsum(counts)
            decoded = [encode.library.decode(x.tolist()) for x in np.split(ids, cuts[:-1])] if len(counts) else []
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(common.lists(x, counts, pa.int32()) for x in (ids, begin, end)), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "begins", "ends", "decoded"],
            )

        return kernel

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.arrow_map(docs, make, "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string", "text")
