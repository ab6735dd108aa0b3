"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

A text is cut into units: words folded to the letters a to z, each accent a symbol behind its
letter, without signs between the letters, common digit substitutes read as letters, and letters
that stand alone joined ("i d i o t"). Where texts are scored, pairs of neighbouring short words are
units as well, as a parted word ("id iot") has its gap where words have one; the machine learns from
single words. The kernel of two units counts the subsequences of ORDER symbols they share, within SPAN symbols, each
gap symbol costing a factor DECAY; so inserted characters lower a likeness but don't end it.

Landmarks are units of the training sample. The Nyström map turns a unit into its kernel values
with the landmarks, whitened by the landmarks' own kernel; a linear SVM is trained on that. As the
kernel is a scalar product of subsequence counts, the machine's value of a unit is one sum over the
unit's subsequences of a weight table, which is what workers evaluate. A sentence is as toxic as its
worst unit, a document as its worst sentence; labels are given for documents, so the units that
carry a label are found in rounds: the best unit of each toxic document against the worst of clean
ones. A logistic curve, fitted on the same sample, gives the score.

Letters of other scripts are no symbols: what is written in them has no unit.

Defined results: a null text or one without units has the lowest score of the curve; without
labels of both kinds every score is 0; rows that repeat a doc_id have their own scores, and so have
rows without one; labels that are neither 0 nor 1 are left out; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common

ORDER, SPAN, DECAY = 4, 7, 0.6
#: The training sample: so many labelled documents of each kind at most, none longer than this.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARACTERS = 1200, 2400, 20_000
LANDMARKS = 256
ROUNDS = 4
THRESHOLD = 0.7
#: Two neighbouring words are a unit as well if one has at most PARTED symbols and both have at most PAIRED.
#: A pair must be by so much more like an insult, as there are many pairs.
PARTED, PAIRED, PAIR_MARGIN = 3, 10, 0.1
#: Units whose values a worker remembers; it starts anew when the memory is full.
REMEMBERED = 120_000

START, END, ACUTE, GRAVE, OTHER_ACCENT = 27, 28, 29, 30, 31
OFFSETS = [(0, *c) for c in combinations(range(1, SPAN), ORDER - 1)]
WEIGHTS = [DECAY ** (c[-1] - ORDER + 1) for c in OFFSETS]
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _folded() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol of each byte, and of the letter and the accent that 0xC3 and this byte stand for."""
    import unicodedata

    one, letter, accent = np.zeros(256, np.uint8), np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for byte in range(128):
        c = chr(byte).lower()
        c = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}.get(c, c)
        if "a" <= c <= "z":
            one[byte] = ord(c) - 96
    for byte in range(0x80, 0xC0):
        parts = unicodedata.normalize("NFKD", chr(byte + 0x40).lower())
        base = {"ß": "s", "ø": "o", "æ": "a", "ð": "d", "þ": "t"}.get(parts[0], parts[0])
        if "a" <= base <= "z":
            letter[byte] = ord(base) - 96
            accent[byte] = {"\u0301": ACUTE, "\u0300": GRAVE}.get(parts[1:], OTHER_ACCENT)
    return one, letter, accent


FOLD, FOLD_LETTER, FOLD_ACCENT = _folded()


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, start and end of each word in them, and the text of each word."""
    symbol = FOLD[data]
    accented = np.flatnonzero(data[:-1] == 0xC3)
    symbol[accented] = FOLD_LETTER[data[accented + 1]]
    symbol[accented + 1] = FOLD_ACCENT[data[accented + 1]]
    begin, _ = common.runs(~SPACES[data], offsets)
    at = np.flatnonzero(symbol)
    symbols = symbol[at]
    if not len(at):
        none = np.zeros(0, np.int64)
        return symbols, none, none, none
    word = np.searchsorted(begin, at, side="right") - 1
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    size = np.diff(np.append(first, len(at)))
    text = np.searchsorted(offsets, at[first], side="right") - 1
    alone = size == 1
    joined = np.zeros(len(first), bool)
    joined[1:] = alone[1:] & alone[:-1] & (text[1:] == text[:-1])
    start, text = first[~joined], text[~joined]
    end = np.append(start[1:], len(at))
    return symbols, start, end, text


def with_pairs(start: np.ndarray, end: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of words and of pairs of neighbours that may be one parted word, and which is one."""
    size = end - start
    near = (text[1:] == text[:-1]) & (np.minimum(size[1:], size[:-1]) <= PARTED) & (size[1:] + size[:-1] <= PAIRED)
    two = np.flatnonzero(near)
    every = np.concatenate([text, text[two]])
    order = np.argsort(every, kind="stable")
    pair = np.arange(len(every)) >= len(text)
    return np.concatenate([start, start[two]])[order], np.concatenate([end, end[two + 1]])[order], every[order], pair[order]


def shown(symbols: np.ndarray) -> str:
    return "".join("´`^"[s - ACUTE] if s >= ACUTE else chr(s + 96) for s in symbols.tolist())


def padded(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All units behind one another between marks of their ends and zeros; starts and lengths."""
    size = end - start + 2
    place = np.cumsum(size + SPAN) - size - SPAN
    out = np.zeros(int((size + SPAN).sum()) + SPAN, np.int64)
    length = end - start
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(place + 1, length) + within] = symbols[np.repeat(start, length) + within]
    out[place] = START
    out[place + size - 1] = END
    return out, place, size


def norms(size: np.ndarray) -> np.ndarray:
    """Length of a unit's vector of subsequences, as if all of them differed."""
    total = sum(w * w * np.maximum(size - c[-1], 0) for c, w in zip(OFFSETS, WEIGHTS))
    return np.sqrt(np.maximum(total, 1e-9))


def codes(row: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Number of the subsequence that starts at each place; 0 in a digit means that it has none."""
    n = len(row) - SPAN
    out = row[:n]
    for o in offsets[1:]:
        out = out << 5 | row[o : o + n]
    return out


def valid(code: np.ndarray) -> np.ndarray:
    ok = np.ones(len(code), bool)
    for k in range(ORDER):
        ok &= (code >> 5 * k) & 31 != 0
    return ok


def values(table: np.ndarray, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The machine's value of each unit; the table is 0 where a subsequence isn't one."""
    if not len(start):
        return np.zeros(0, np.float32)
    row, place, size = padded(symbols, start, end)
    total = np.zeros(len(row) - SPAN, np.float32)
    for offsets, weight in zip(OFFSETS, WEIGHTS):
        total += np.float32(weight) * table[codes(row, offsets)]
    return np.add.reduceat(total, place) / norms(size)


@dataclass
class Model:
    table: np.ndarray
    bias: float
    slope: float
    offset: float
    key: int

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30)))


#: Value of a text without units; below what any unit reaches.
NO_UNIT = -3.0


class Bags:
    """Units of the sample documents: distinct ones once, and which documents hold them."""

    def __init__(self, texts: list[str]):
        hash_of, column = common.SpanHash(17), pa.array(texts, pa.string())
        symbols, sizes, names, held = [], [], [], []
        before = 0
        for part in common.slices([pa.RecordBatch.from_arrays([column], names=["text"])], "text"):
            found, start, end, text = units_of(*common.utf8(part.column("text")))
            hashes = hash_of(found, start, end)
            name, where = np.unique(hashes, return_index=True)
            size = end[where] - start[where]
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            symbols.append(found[np.repeat(start[where], size) + within])
            sizes.append(size)
            names.append(name)
            both = np.unique(np.stack([(text + before).astype(np.uint64), hashes], 1), axis=0)
            held.append(both)
            before += part.num_rows
        sizes, names = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, names))
        every = np.concatenate(held) if held else np.zeros((0, 2), np.uint64)
        self.symbols = np.concatenate(symbols) if symbols else np.zeros(0, np.uint8)
        ends = np.cumsum(sizes)
        known, where = np.unique(names, return_index=True)
        self.start, self.end = (ends - sizes)[where], ends[where]
        self.text, self.unit = every[:, 0].astype(np.int64), np.searchsorted(known, every[:, 1])
        self.texts = len(texts)

    def worst(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest value of each document and the unit that has it; -1 without units."""
        order = np.lexsort((value[self.unit], self.text))
        last = np.flatnonzero(np.append(self.text[order][1:] != self.text[order][:-1], True)) if len(order) else order
        best, unit = np.full(self.texts, NO_UNIT), np.full(self.texts, -1)
        best[self.text[order][last]], unit[self.text[order][last]] = value[self.unit[order][last]], self.unit[order][last]
        return best, unit


def subsequences(bags: Bags, chosen: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Subsequence codes and normalised weights of each chosen unit."""
    row, place, size = padded(bags.symbols, bags.start[chosen], bags.end[chosen])
    all_codes = np.stack([codes(row, o) for o in OFFSETS])
    good = np.stack([valid(c) for c in all_codes])
    weight = np.broadcast_to(np.array(WEIGHTS)[:, None], all_codes.shape)
    out = []
    for p, s, norm in zip(place, size, norms(size)):
        part = slice(p, p + s)
        code, where = np.unique(all_codes[:, part][good[:, part]], return_inverse=True)
        out.append((code, np.bincount(where, weight[:, part][good[:, part]], minlength=len(code)) / norm))
    return out


def svm(features: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient descent."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weight = weight / weight.sum()
    step = 1 / (2 * np.linalg.norm((x * weight[:, None]).T @ x, 2) + ridge)
    w = ahead = np.zeros(x.shape[1])
    for k in range(steps):
        slack = np.maximum(0, 1 - label * (x @ ahead))
        gradient = -2 * (x.T @ (weight * label * slack)) + ridge * np.append(ahead[:-1], 0)
        new = ahead - step * gradient
        ahead, w = new + k / (k + 3) * (new - w), new
    return w[:-1], w[-1]


def logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method."""
    w, design = np.zeros(2), np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - label) + 1e-3 * w
        w = w - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), gradient)
    return float(w[0]), float(w[1])


def fit(texts: list[str], toxic: np.ndarray, seed: int = 1) -> Model | None:
    """The machine of a bounded sample; None without examples of both kinds."""
    toxic = np.asarray(toxic).astype(bool)
    if not toxic.any() or toxic.all():
        return None
    bags = Bags(texts)
    n = len(bags.start)
    if not n:
        return None
    rng = np.random.default_rng(seed)
    held_toxic = np.bincount(bags.unit, toxic[bags.text], minlength=n)
    held_clean = np.bincount(bags.unit, ~toxic[bags.text], minlength=n)
    # Evidence of a unit: how much oftener toxic documents hold it, counted against chance.
    evidence = (held_toxic / toxic.sum() - held_clean / (~toxic).sum()) / np.sqrt((held_toxic + held_clean + 4.0))
    order = np.argsort(-evidence)
    common_units = np.argsort(-(held_toxic + held_clean))[: LANDMARKS // 4]
    landmarks = np.unique(np.concatenate([order[: LANDMARKS // 2], common_units, rng.choice(n, min(n, LANDMARKS // 4), replace=False)]))

    columns, parts = np.zeros(0, np.int64), subsequences(bags, landmarks)
    columns = np.unique(np.concatenate([c for c, _ in parts]))
    place = np.full(1 << 5 * ORDER, -1, np.int32)
    place[columns] = np.arange(len(columns))
    landmark = np.zeros((len(landmarks), len(columns)), np.float32)
    for i, (c, w) in enumerate(parts):
        landmark[i, place[c]] = w
    value, vectors = np.linalg.eigh((landmark @ landmark.T).astype(float))
    good = value > 1e-6 * value.max()
    whiten = vectors[:, good] / np.sqrt(value[good])

    def features(units: np.ndarray) -> np.ndarray:
        kernel = np.zeros((len(units), len(landmarks)), np.float32)
        for i, (c, w) in enumerate(subsequences(bags, units)):
            at = place[c]
            kernel[i] = landmark[:, at[at >= 0]] @ w[at >= 0].astype(np.float32)
        return kernel @ whiten

    current = evidence / np.abs(evidence).max()
    hard: set[int] = set()
    table, bias = np.zeros(1 << 5 * ORDER, np.float32), 0.0
    for _ in range(ROUNDS):
        _, unit = bags.worst(current)
        witness = np.unique(unit[toxic & (unit >= 0)])
        # A witness that clean documents hold as often is no evidence: a mislabelled document.
        witness = witness[held_toxic[witness] * (~toxic).sum() > 8 * held_clean[witness] * toxic.sum()]
        witness = witness[held_toxic[witness] >= min(2, held_toxic[witness].max(initial=0))]
        hard |= set(unit[~toxic & (unit >= 0)].tolist())
        plain = rng.choice(n, min(n, 3000), replace=False)
        negative = np.unique(np.concatenate([np.array(sorted(hard), np.int64), plain, common_units]))
        negative = negative[(held_clean[negative] > 0) & ~np.isin(negative, witness)]
        if not len(witness) or not len(negative):
            break
        chosen = np.concatenate([witness, negative])
        label = np.concatenate([np.ones(len(witness)), -np.ones(len(negative))])
        weight = np.concatenate([held_toxic[witness] / held_toxic[witness].sum(), held_clean[negative] ** 0.5 / (held_clean[negative] ** 0.5).sum()])
        beta, bias = svm(features(chosen), label, weight)
        table = np.zeros(1 << 5 * ORDER, np.float32)
        table[columns] = landmark.T @ (whiten @ beta).astype(np.float32)
        current = values(table, bags.symbols, bags.start, bags.end) + bias
    worst, _ = bags.worst(current)
    slope, offset = logistic(worst, toxic.astype(float))
    return Model(table, float(bias), slope, offset, hash((table.tobytes(), bias)))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labelled texts, evenly thinned by a hash of their id to the sample's bounds."""
    labels = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    # Where labels of a document contradict each other, any 1 counts.
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    have = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {kind: common.share_of(most, have.get(kind, 0)) for kind, most in ((0, SAMPLE_CLEAN), (1, SAMPLE_TOXIC))}
    draw = common.drawn("doc_id")
    drawn = labels.where((F.col("toxic") == 1) & (draw < share[1]) | (F.col("toxic") == 0) & (draw < share[0]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.char_length("text") <= SAMPLE_CHARACTERS)
    rows = texts.join(F.broadcast(drawn), "doc_id").limit(2 * (SAMPLE_CLEAN + SAMPLE_TOXIC)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows])


def score(docs: DataFrame, model: Model | None, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and worst_unit (the unit that decided) of every row of docs, and the columns in others."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *dict.fromkeys(("text", *others)))
    schema = "doc_id long, score double, worst_unit string"
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("worst_unit"), *others)

    def make():
        hash_of = common.SpanHash(17)
        memory = common.held(("units", model.key), dict)

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            symbols, *words = units_of(*common.utf8(batch.column("text")))
            start, end, text, pair = with_pairs(*words)
            keys, where, unit = np.unique(hash_of(symbols, start, end), return_index=True, return_inverse=True)
            numbers = keys.tolist()
            if len(memory) + len(numbers) > REMEMBERED:
                memory.clear()
            known = [memory.get(k) for k in numbers]
            new = np.array([i for i, x in enumerate(known) if x is None], np.int64)
            if len(new):
                fresh = values(model.table, symbols, start[where[new]], end[where[new]]).tolist()
                memory.update(zip((numbers[i] for i in new.tolist()), fresh))
                known = [memory[k] for k in numbers]
            value = np.array(known, np.float64)[unit] + model.bias - PAIR_MARGIN * pair if len(unit) else np.zeros(0)
            worst, decided = np.full(batch.num_rows, NO_UNIT), [None] * batch.num_rows
            if len(text):
                first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                worst[text[first]] = np.maximum.reduceat(value, first)
                for t, lo, hi in zip(text[first], first, np.append(first[1:], len(text))):
                    i = lo + int(value[lo:hi].argmax())
                    decided[t] = shown(symbols[start[i] : end[i]])
            columns = [batch.column("doc_id"), pa.array(model.score(worst)), pa.array(decided, pa.string()), *(batch.column(c) for c in others)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "worst_unit", *others])

        return kernel

    return common.arrow_map(docs, make, schema, "text", keep=True)


def learnt(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(*sample(docs, labels))
