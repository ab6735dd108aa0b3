"""Language identification by a linear-chain conditional random field over the words of a text.

Each word has affix features (its first and last one to four letters), n-gram features (its letter
pairs and triples) and a lexicon feature (the whole word); transitions between languages are
learned, so that code-switched stretches are labelled one by one. Forward-backward gives every word
the marginal probability of each language. A text's language is the one with the largest share of
its words' marginals, and that share is the score.

Training texts have one language each. Training sequences are spliced from stretches of texts in
different languages, so that the transitions see switches.

Letters are the code points of Unicode's letter categories; a word is a run of letters and of the marks
that are written on them.

Defined results: a null text or one without letters is `und` with score 0; without labelled texts
every text is; ties go to the language that sorts first; rows that repeat a doc_id are labelled one
by one, and so are rows without one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common

UNKNOWN = "und"
#: The training sample: so many texts of each language at most, none longer than this.
SAMPLE_TEXTS, SAMPLE_CHARACTERS = 400, 20_000
#: Spliced training sequences, their stretches and the words of a stretch.
SEQUENCES, STRETCHES, STRETCH_WORDS = 1200, 4, 12
#: Hashed features.
BITS = 17
AFFIXES = (1, 2, 3, 4)
GRAMS = (2, 3)
EPOCHS, RATE, RIDGE = 6, 0.25, 1e-5
#: Words of a block; transfer matrices of blocks make long texts parallel.
BLOCK = 32

MARK, LETTER = 1, 2


@cache
def kinds() -> np.ndarray:
    """Whether each code point is a letter, a mark or neither."""
    of = {"L": LETTER, "M": MARK}
    return np.array([of.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def letters(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 text belongs to."""
    out = kinds()[:128][np.minimum(data, 127)]
    out[data >= 0x80] = 0
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
        for k in range(1, 4):
            more = size > k
            code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
        kind = kinds()[code]
        for k in range(4):
            more = size > k
            out[lead[more] + k] = kind[more]
    return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of each word, and the text of each."""
    low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    low = low + (after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)) * np.uint8(32)
    kind = letters(data)
    start, end = common.runs(kind > 0, offsets)
    # Marks alone are no word.
    count = np.concatenate([[0], np.cumsum(kind == LETTER)])
    word = count[end] > count[start]
    start, end = start[word], end[word]
    return low, start, end, np.searchsorted(offsets, start, side="right") - 1


class Features:
    """Hashed features of words: the number of features differs from word to word."""

    def __init__(self):
        self.affix = [common.SpanHash(31 + k) for k in range(2)]
        self.whole = common.SpanHash(41)
        self.codes = np.random.default_rng(43).integers(1, 1 << 63, 256, np.uint64)

    def __call__(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and the word that each belongs to."""
        top = common.U64(64 - BITS)
        number, word = [], []
        every = np.arange(len(start))
        for n in AFFIXES:
            keys = self.affix[0](low, start, np.minimum(start + n, end)), self.affix[1](low, np.maximum(end - n, start), end)
            for key in keys:
                number.append((key * common.U64(2 * n + 1)) >> top)
                word.append(every)
        number.append((self.whole(low, start, end) * common.U64(0x9E3779B97F4A7C15)) >> top)
        word.append(every)
        size = end - start
        for n in GRAMS:
            count = np.maximum(size - n + 1, 0)
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(start, count) + within
            key = np.zeros(len(at), np.uint64)
            for k in range(n):
                key = key * common.U64(0x9E3779B97F4A7C15) + self.codes[low[at + k]]
            number.append(common.mix64(key + common.U64(n)) >> top)
            word.append(np.repeat(every, count))
        return np.concatenate(number).astype(np.int64), np.concatenate(word)


@dataclass
class Model:
    languages: list[str]
    weight: np.ndarray
    transition: np.ndarray
    key: int


def emissions(weight: np.ndarray, features: Features, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Label weights of each word; equal words are looked at once."""
    _, where, inverse = np.unique(features.whole(low, start, end), return_index=True, return_inverse=True)
    number, word = features(low, start[where], end[where])
    return np.stack([np.bincount(word, w[number], minlength=len(where)) for w in weight], 1)[inverse]


def blocks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of ascending texts: row and column in a matrix of blocks, and each block's text."""
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    within = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    new = within % BLOCK == 0
    row = np.cumsum(new) - 1
    return row, within % BLOCK, text[new]


def marginals(emission: np.ndarray, transition: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Forward-backward: the probability of each label for each word; texts are independent.

    Each block of words has a transfer matrix; vectors pass from block to block by it, one step for
    a block, and then through all blocks at once, one step for a place in the block.
    """
    labels = len(transition)
    if not len(text):
        return np.zeros((0, labels))
    row, column, block_text = blocks(text)
    rows = len(block_text)
    e = np.ones((BLOCK, rows, labels))
    e[column, row] = np.exp(emission - emission.max(axis=1, keepdims=True))
    used = np.zeros((BLOCK, rows), bool)
    used[column, row] = True
    a = np.exp(transition - transition.max())

    # Transfer matrices: m[i, j] takes a message in label i before the block to label j at its end.
    m = np.broadcast_to(np.eye(labels), (rows, labels, labels)).copy()
    for k in range(BLOCK):
        step = (m.reshape(-1, labels) @ a).reshape(rows, labels, labels) * e[k][:, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        m = np.where(used[k][:, None, None], step, m)

    head = np.append(True, block_text[1:] != block_text[:-1])
    order = np.arange(rows) - np.maximum.accumulate(np.where(head, np.arange(rows), 0))
    depth = int(order.max()) + 1
    by_order = np.argsort(order, kind="stable")
    cuts = np.searchsorted(order[by_order], np.arange(depth + 1))
    enter = np.full((rows, labels), 1.0 / labels)
    leave = np.full((rows, labels), 1.0)
    for d in range(1, depth):
        here = by_order[cuts[d] : cuts[d + 1]]
        v = np.einsum("ri,rij->rj", enter[here - 1], m[here - 1])
        enter[here] = v / v.sum(axis=1, keepdims=True)
    for d in range(depth - 1, 0, -1):
        here = by_order[cuts[d] : cuts[d + 1]]
        v = np.einsum("rij,rj->ri", m[here], leave[here])
        leave[here - 1] = v / v.sum(axis=1, keepdims=True)

    alpha, forward = np.empty_like(e), enter
    for k in range(BLOCK):
        step = (forward @ a) * e[k]
        forward = np.where(used[k][:, None], step / step.sum(axis=1, keepdims=True), forward)
        alpha[k] = forward
    out, backward = np.empty_like(e), leave
    for k in range(BLOCK - 1, -1, -1):
        both = alpha[k] * backward
        out[k] = both / both.sum(axis=1, keepdims=True)
        step = (e[k] * backward) @ a.T
        backward = np.where(used[k][:, None], step / step.sum(axis=1, keepdims=True), backward)
    return out[column, row]


def pair_marginals(emission: np.ndarray, transition: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of each transition within texts; for short sequences.

    As in `marginals`, a step from a label of which nothing is known precedes the first word.
    """
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    size = np.diff(np.append(starts, len(text)))
    n, width, labels = len(starts), int(size.max()), len(transition)
    within = np.arange(len(text)) - np.repeat(starts, size)
    row = np.repeat(np.arange(n), size)
    e = np.ones((n, width, labels))
    e[row, within] = np.exp(emission - emission.max(axis=1, keepdims=True))
    used = np.arange(width) < size[:, None]
    a = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    v = np.ones((n, labels))
    for k in range(width):
        v = (v @ a) * e[:, k]
        v = v / v.sum(axis=1, keepdims=True)
        alpha[:, k] = v
    for k in range(width - 2, -1, -1):
        v = (e[:, k + 1] * beta[:, k + 1]) @ a.T
        beta[:, k] = np.where(used[:, k + 1, None], v / v.sum(axis=1, keepdims=True), 1.0)
    both = alpha * beta
    both /= both.sum(axis=2, keepdims=True)
    pairs = np.zeros_like(a)
    for k in range(width - 1):
        joint = alpha[:, k, :, None] * a * (e[:, k + 1] * beta[:, k + 1])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += joint[used[:, k + 1]].sum(axis=0)
    return both[row, within], pairs


def fit(texts: list[str], langs: list[str], seed: int = 1) -> Model | None:
    """Train on a bounded sample by stochastic gradient of the conditional likelihood."""
    languages = sorted(set(langs))
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[x] for x in langs])
    features = Features()
    low, start, end, text = words_of(*common.utf8(pa.array(texts, pa.string())))
    size = np.bincount(text, minlength=len(texts))
    first = np.cumsum(size) - size
    by_language = [np.flatnonzero((labels == k) & (size > 0)) for k in range(len(languages))]
    if not any(len(x) for x in by_language):
        return None
    rng = np.random.default_rng(seed)
    picks, sequence, gold = [], [], []
    filled = [k for k, x in enumerate(by_language) if len(x)]
    for s in range(SEQUENCES):
        # One sequence in two stays in its language.
        same = rng.random() < 0.5
        chosen = [rng.choice(filled)] * STRETCHES if same else rng.choice(filled, STRETCHES)
        for k in chosen:
            t = rng.choice(by_language[k])
            at = rng.integers(0, max(1, size[t] - STRETCH_WORDS + 1))
            part = np.arange(first[t] + at, first[t] + min(size[t], at + STRETCH_WORDS))
            picks.append(part)
            sequence.append(np.full(len(part), s))
            gold.append(np.full(len(part), k))
    picks, sequence, gold = map(np.concatenate, (picks, sequence, gold))
    all_numbers, all_words = features(low, start[picks], end[picks])
    order = np.argsort(all_words, kind="stable")
    all_numbers, all_words = all_numbers[order], all_words[order]
    word_cut = np.searchsorted(all_words, np.arange(len(picks) + 1))
    seq_cut = np.searchsorted(sequence, np.arange(SEQUENCES + 1))

    weight, squares = np.zeros((len(languages), 1 << BITS)), np.full((len(languages), 1 << BITS), 1e-2)
    transition, t_squares = np.zeros((len(languages),) * 2), np.full((len(languages),) * 2, 1e-2)
    batch = 50
    for _ in range(EPOCHS):
        for lo in range(0, SEQUENCES, batch):
            a, b = seq_cut[lo], seq_cut[min(lo + batch, SEQUENCES)]
            numbers, words = all_numbers[word_cut[a] : word_cut[b]], all_words[word_cut[a] : word_cut[b]] - a
            emission = np.stack([np.bincount(words, w[numbers], minlength=b - a) for w in weight], 1)
            p, pairs = pair_marginals(emission, transition, sequence[a:b])
            error = -p
            error[np.arange(b - a), gold[a:b]] += 1
            inner = sequence[a + 1 : b] == sequence[a : b - 1]
            np.add.at(pairs, (gold[a : b - 1][inner], gold[a + 1 : b][inner]), -1)
            touched, where = np.unique(numbers, return_inverse=True)
            for k in range(len(languages)):
                gradient = np.bincount(where, error[words, k], minlength=len(touched)) / batch - RIDGE * weight[k, touched]
                squares[k, touched] += gradient**2
                weight[k, touched] += RATE * gradient / np.sqrt(squares[k, touched])
            gradient = -pairs / batch
            t_squares += gradient**2
            transition = transition + RATE * gradient / np.sqrt(t_squares)
    weight = weight.astype(np.float32)
    return Model(languages, weight, transition, hash(weight.tobytes()))


def sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """Texts with their language, evenly thinned by a hash of their id to the sample's bounds."""
    labelled = docs.select("doc_id", "text", "lang").where(
        (F.char_length("text") <= SAMPLE_CHARACTERS) & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()
    )
    have = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not have:
        return [], []
    draw = common.drawn("doc_id", "text")
    kept = None
    for lang, n in sorted(have.items()):
        some = (F.col("lang") == lang) & (draw < common.share_of(SAMPLE_TEXTS, n))
        kept = some if kept is None else kept | some
    rows = labelled.where(kept).limit(2 * SAMPLE_TEXTS * len(have)).collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), r["text"]))
    return [r["text"] for r in rows], [r["lang"] for r in rows]


_known: dict[int, object] = {}


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, shares (language -> share of the words) of every row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, lang_pred string, score double, shares map<string,double>"
    if model is None:
        none = F.lit(None).cast("map<string,double>")
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("shares"))

    def make():
        features = _known.setdefault(model.key, Features())

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            low, start, end, text = words_of(*common.utf8(batch.column("text")))
            p = marginals(emissions(model.weight, features, low, start, end), model.transition, text)
            count = np.bincount(text, minlength=batch.num_rows)
            total = np.stack([np.bincount(text, p[:, k], minlength=batch.num_rows) for k in range(len(model.languages))], 1)
            share = total / np.maximum(count, 1)[:, None]
            best = share.argmax(axis=1)
            found = count > 0
            lang = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, found)]
            score = np.clip(np.where(found, share[np.arange(len(best)), best], 0.0), 0.0, 1.0)
            shares = [list(zip(model.languages, s.tolist())) if ok else None for s, ok in zip(share, found)]
            columns = [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "shares"])

        return kernel

    return common.arrow_map(docs, make, schema, "text")


def learnt(docs: DataFrame) -> Model | None:
    return fit(*sample(docs))
