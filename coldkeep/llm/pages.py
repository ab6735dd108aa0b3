"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf texts, each with the path of open tags and their class, id and role
words. A bidirectional LSTM, written in numpy, reads the whole sequence: per leaf a vector of its
path, hashed words and a few measures. Each leaf is labelled as article or not with the page's
context on both sides; the article's leaves are joined.

The labeller is trained on a bounded sample: the leaves of sampled pages, set anew into layouts
drawn from the lists below, whose labels are known, and the sampled pages themselves as far as
their article is marked by a tag of its own.

Defined results: a null or empty page has an empty text; unclosed and stray tags are tolerated;
contents of scripts, styles, templates, drawings, frames and comments are no leaves, but a drawing,
frame or text area that closes itself or is never closed hides nothing; rows that repeat a page_id
are extracted one by one, and so are rows without one; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common

#: The training sample: so many pages at most, none longer than this.
SAMPLE_PAGES, SAMPLE_CHARACTERS = 300, 50_000
LAYOUTS, EPOCHS, BATCH, RATE = 1500, 12, 30, 0.01
HIDDEN, WORD_DIMS, PATH_DIMS, MEASURES = 20, 32, 512, 5

TOKEN = re.compile(
    r"""<!--.*?(?:-->|$)|<(script|style)\b(?:[^<>"']|"[^"<]*"|'[^'<]*')*>.*?(?:</\1\s*>|$)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+|[^<>]*)>|<[!?][^>]*>""",
    re.DOTALL | re.IGNORECASE,
)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
#: Tags whose content is hidden up to their end, if they have one.
HIDDEN_TAGS = frozenset("template svg textarea iframe object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var img wbr".split()
)
#: An opening tag of the key closes open tags of the values, up to a container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("ul ol dl table select article section div main body nav aside footer header form".split())

#: Layouts for training, as paths; words behind a dot or # are classes and ids.
WRAPPERS = ("body", "body div.wrapper", "body div.page", "body div#container", "body div.site div.inner")
ARTICLES = (
    "article", "main", "main article", "div.content", "div#content", "div.post-body", "div.article-body", "div.entry-content",
    "section.article", "div.story", "div.main-content", "div#main article.post", "main div.text", "div.post", "article div.body",
)
ARTICLE_LEAVES = (
    "h1", "header h1", "h2", "h3", "p", "p", "p", "p", "p", "p b", "p a", "ul li", "ol li", "blockquote p", "blockquote", "pre",
    "table tr td", "table tr th", "figure figcaption", "div", "section p", "section h2", "dl dd", "",
)
OTHERS = (
    "nav ul li a", "nav a", "nav", "ul.menu li a", "div.menu a", "div.nav a", "div.navigation ul li a", "div.navbar a", "header", "header p",
    "header div.logo", "header a", "header h1 a", "header nav a", "div.header", "div#header a", "div.masthead", "footer", "footer p",
    "footer ul li a", "footer div", "div.footer", "div#footer p", "div.site-footer p", "div.copyright", "aside", "aside p", "aside h2",
    "aside h3", "aside ul li a", "div.sidebar p", "div.sidebar h3", "div#sidebar ul li a", "section.sidebar p", "div.widget p", "div.ad",
    "div.ads", "div.advert", "div.advertisement p", "ins.adsbygoogle", "div.banner", "div.promo p", "div.sponsored p", "div.sponsor",
    "section.ad p", "p.ad", "div.notice", "div.notice p", "p.notice", "div.cookie p", "div.cookie-notice p", "div.cookie-banner", "div.alert",
    "div#consent p", "div.gdpr", "div.popup p", "div.modal p", "dialog p", "form", "form label", "form p", "form button", "form select option",
    "form div", "div.newsletter p", "div.newsletter form label", "div.subscribe p", "div.signup", "div.search form", "button", "label",
    "section.comments p", "section.comments h2", "section#comments article.comment p", "section#comments h3", "div.comments div.comment p",
    "div.comments p", "div#comments ol li p", "div#comments ul li", "ul.comment-list li", "ol.comments li p", "div.comment p", "article.comment p",
    "div.reader-comments p", "div.replies p", "div.breadcrumb a", "div.breadcrumbs", "ul.breadcrumb li a", "div.share a", "div.social a", "div.related h3",
    "div.related ul li a", "section.related p", "div.recommended a", "div.pagination a", "noscript", "div.toolbar a", "div.tags a", "div.skip a",
)


def leaves(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, path, share of link characters) of each leaf, in page order."""
    out: list[tuple[str, tuple[str, ...], float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                path = tuple(dict.fromkeys(x for _, marks in stack for x in marks))
                block = next((tag for tag, _ in reversed(stack) if tag not in INLINE), "")
                out.append((text, (*path, f"leaf {block}"), min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        if any(tag not in INLINE for tag, _ in stack[upto:]):
            flush()
        del stack[upto:]

    at, endless = 0, set()
    while m := TOKEN.search(page, at):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if any(tag == "a" for tag, _ in stack):
                linked += m.start() - at
        at = m.end()
        tag = m[3].lower() if m[3] else ""
        if not tag:
            continue
        if m[2]:
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if found is not None:
                close(found)
            elif tag not in INLINE:
                flush()
            continue
        if tag in HIDDEN_TAGS:
            # Once no end is found there is none further on either.
            if not m[4].rstrip().endswith("/") and tag not in endless:
                end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
            continue
        if tag == "br":
            parts.append(" ")
        if tag not in INLINE and tag != "br":
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(tag, ()):
                    close(i)
                elif stack[i][0] in CONTAINERS:
                    break
        if tag in VOID or m[4].rstrip().endswith("/") and tag in INLINE:
            continue
        marks = [tag]
        if "=" in m[4]:
            for _, value in MARKS.findall(m[4]):
                marks += [f".{w}" for w in re.findall(r"[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", value).lower())]
        stack.append((tag, tuple(marks)))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


class Vectors:
    """Input vectors of leaves: hashed words, measures, and path numbers."""

    def __init__(self):
        self.hash = common.SpanHash(53)
        self.numbers: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> list[int]:
        if len(self.numbers) > 100_000:
            self.numbers.clear()
        for x in path:
            if x not in self.numbers:
                self.numbers[x] = zlib.crc32(x.encode()) % PATH_DIMS
        return sorted({self.numbers[x] for x in path})

    def dense(self, texts: list[str], links: list[float]) -> np.ndarray:
        data, offsets = common.utf8(pa.array(texts, pa.string()))
        start, end = common.runs(data != 32, offsets)
        leaf = np.searchsorted(offsets, start, side="right") - 1
        key = self.hash(data, start, end)
        cell = leaf * WORD_DIMS + (key >> common.U64(59)).astype(np.int64) % WORD_DIMS
        sign = np.where(key & common.U64(1), 1.0, -1.0)
        words = np.bincount(leaf, minlength=len(texts)).astype(float)
        hashed = np.bincount(cell, sign, minlength=len(texts) * WORD_DIMS).reshape(-1, WORD_DIMS)
        hashed /= np.maximum(np.linalg.norm(hashed, axis=1), 1)[:, None]
        digit = np.add.reduceat(np.append((data >= 48) & (data <= 57), False), offsets[:-1]) / np.maximum(np.diff(offsets), 1) if texts else words
        stop = [t[-1] in ".!?…\"'" for t in texts]
        return np.hstack([0.5 * hashed, np.stack([np.log1p(words) / 5, np.array(links, float), digit, np.array(stop, float), words > 8], 1)]).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Both directions' weights: dense inputs, path rows, recurrence and bias; then the output layer."""

    parameters: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        p = {"out": normal(2 * HIDDEN), "out_bias": np.zeros(1, np.float32), "skip": np.zeros(PATH_DIMS, np.float32)}
        for d in "fb":
            p |= {f"x{d}": normal(WORD_DIMS + MEASURES, 4 * HIDDEN), f"p{d}": normal(PATH_DIMS, 4 * HIDDEN), f"h{d}": normal(HIDDEN, 4 * HIDDEN)}
            p[f"c{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)
        return Network(p)

    def run(self, dense: np.ndarray, paths: "Paths", used: np.ndarray, keep: bool = False):
        """Logits (steps, pages). dense: (steps, pages, dims); paths: the path marks; used: mask."""
        p, steps, traces, states = self.parameters, len(dense), {}, []
        for d in "fb":
            inputs = dense @ p[f"x{d}"] + p[f"c{d}"]
            paths.add(inputs, p[f"p{d}"])
            h = c = np.zeros((dense.shape[1], HIDDEN), np.float32)
            hidden = np.zeros((steps, dense.shape[1], HIDDEN), np.float32)
            trace = []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                z = inputs[t] + h @ p[f"h{d}"]
                i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
                g = np.tanh(z[:, 3 * HIDDEN :])
                new_c = f * c + i * g
                tc = np.tanh(new_c)
                mask = used[t][:, None]
                if keep:
                    trace.append((t, h, c, i, f, o, g, tc, mask))
                h, c = np.where(mask, o * tc, h), np.where(mask, new_c, c)
                hidden[t] = h
            traces[d] = trace
            states.append(hidden)
        both = np.concatenate(states, 2)
        logits = both @ p["out"] + p["out_bias"]
        paths.add(logits, p["skip"])
        return (logits, both, traces) if keep else logits

    def gradients(self, dense, paths, used, label) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy and its gradient, by backpropagation through time."""
        p = self.parameters
        logits, both, traces = self.run(dense, paths, used, keep=True)
        prob = sigmoid(logits)
        n = used.sum()
        loss = -np.sum(used * (label * np.log(prob + 1e-9) + (1 - label) * np.log(1 - prob + 1e-9))) / n
        d_logit = (prob - label) * used / n
        out = {"out": np.einsum("tb,tbh->h", d_logit, both), "out_bias": d_logit.sum(keepdims=True)[0], "skip": paths.back(d_logit)}
        for k, d in enumerate("fb"):
            d_hidden = d_logit[:, :, None] * p["out"][k * HIDDEN : (k + 1) * HIDDEN]
            d_inputs = np.zeros((*dense.shape[:2], 4 * HIDDEN), np.float32)
            d_recurrent = np.zeros_like(p[f"h{d}"])
            dh = dc = np.zeros((dense.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tc, mask in reversed(traces[d]):
                dh = dh + d_hidden[t]
                inner_h = np.where(mask, dh, 0)
                inner_c = np.where(mask, dc, 0) + inner_h * o * (1 - tc**2)
                dz = np.concatenate([inner_c * g * i * (1 - i), inner_c * c * f * (1 - f), inner_h * tc * o * (1 - o), inner_c * i * (1 - g**2)], 1)
                d_inputs[t] = dz
                d_recurrent += h.T @ dz
                dh = np.where(mask, dz @ p[f"h{d}"].T, dh)
                dc = np.where(mask, inner_c * f, dc)
            flat = d_inputs.reshape(-1, 4 * HIDDEN)
            out |= {f"x{d}": dense.reshape(-1, dense.shape[2]).T @ flat, f"p{d}": paths.back(d_inputs), f"h{d}": d_recurrent, f"c{d}": flat.sum(0)}
        return loss, out


@dataclass
class Paths:
    """Path marks of leaves as lists: mark `number` is on the leaf at (step, page)."""

    step: np.ndarray
    page: np.ndarray
    number: np.ndarray

    def add(self, to: np.ndarray, rows: np.ndarray) -> None:
        """Add to each leaf the rows of its marks; the marks of a leaf lie behind one another."""
        if len(self.number):
            new = np.flatnonzero(np.append(True, (np.diff(self.step) != 0) | (np.diff(self.page) != 0)))
            to[self.step[new], self.page[new]] += np.add.reduceat(rows[self.number], new, axis=0)

    def back(self, gradient: np.ndarray) -> np.ndarray:
        """Gradient of the rows from that of the leaves."""
        out = np.zeros((PATH_DIMS, *gradient.shape[2:]), gradient.dtype)
        np.add.at(out, self.number, gradient[self.step, self.page])
        return out


def batch_of(vectors: Vectors, pages: list[list[tuple[str, tuple[str, ...], float]]]):
    """Padded (steps, pages, dims) arrays of the leaves of several pages."""
    size = np.array([len(p) for p in pages])
    steps = int(size.max(initial=0))
    flat = [leaf for page in pages for leaf in page]
    page = np.repeat(np.arange(len(pages)), size)
    step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    dense = np.zeros((steps, len(pages), WORD_DIMS + MEASURES), np.float32)
    paths = Paths(*(np.zeros(0, np.int64) for _ in range(3)))
    used = np.zeros((steps, len(pages)), bool)
    if flat:
        dense[step, page] = vectors.dense([t for t, _, _ in flat], [x for _, _, x in flat])
        numbers = [vectors.path(path) for _, path, _ in flat]
        many = [len(x) for x in numbers]
        paths = Paths(np.repeat(step, many), np.repeat(page, many), np.concatenate(numbers).astype(np.int64))
        used[step, page] = True
    return dense, paths, used, step, page


def path_of(spec: str) -> tuple[str, ...]:
    """The path of a layout's leaf, as `leaves` would give it."""
    marks, last = [], ""
    for part in spec.split():
        tag, *words = re.split("[.#]", part)
        marks += [tag, *(f".{x}" for w in words for x in w.split("-"))]
        last = last if tag in INLINE else tag
    return (*dict.fromkeys(marks), f"leaf {last}")


def layout(rng: np.random.Generator, articles: list[str], others: list[str]) -> tuple[list[tuple[str, tuple[str, ...], float]], list[int]]:
    """A page of known labels. Other texts may be of any kind, so that text alone doesn't decide."""
    pick = lambda options: options[rng.integers(len(options))]
    wrapper, article = pick(WRAPPERS), pick(ARTICLES)
    page, label = [], []

    def add(spec: str, is_article: bool) -> None:
        text = pick(articles if rng.random() < (0.75 if is_article else 0.5) else others)
        page.append((text, path_of(f"html {spec}"), 1.0 if spec.endswith(" a") else 0.0))
        label.append(int(is_article))

    def other(inside: str) -> None:
        spec = pick(OTHERS)
        for _ in range(1 + rng.integers(4)):
            add(f"{inside} {spec}", False)

    if rng.random() < 0.9:
        add("head title", False)
    for _ in range(rng.integers(0, 5)):
        other(wrapper)
    if rng.random() < 0.9:
        add(f"{wrapper} {article} {pick(('h1', 'header h1', 'h2'))}", True)
    for _ in range(1 + rng.integers(12)):
        add(f"{wrapper} {article} {pick(ARTICLE_LEAVES)}", True)
        if rng.random() < 0.12:
            other(f"{wrapper} {article}")
    for _ in range(rng.integers(0, 5)):
        other(f"{wrapper} {article}" if rng.random() < 0.2 else wrapper)
    return page, label


def fit(pages: list[str], seed: int = 1) -> Network:
    rng, vectors, network = np.random.default_rng(seed), Vectors(), Network.new(seed)
    parsed = [x for x in map(leaves, pages) if x]
    marked = [[int("article" in path or "main" in path) for _, path, _ in x] for x in parsed]
    articles = [t for x, y in zip(parsed, marked) for (t, _, _), k in zip(x, y) if k] or ["text"]
    others = [t for x, y in zip(parsed, marked) for (t, _, _), k in zip(x, y) if not k] or ["text"]
    known = {path_of(o)[-2] for o in OTHERS} - {path_of(a)[-2] for a in ARTICLES}
    # Sampled pages count where their tags leave no doubt.
    examples = [layout(rng, articles, others) for _ in range(LAYOUTS)]
    plain = lambda x, y: any(y) and not any(k and known & set(path[:-1]) & {"aside", "nav", "footer", "form"} for (_, path, _), k in zip(x, y))
    examples += [(x, y) for x, y in zip(parsed, marked) if len(x) < 200 and plain(x, y)]

    first = {k: np.zeros_like(v) for k, v in network.parameters.items()}
    second = {k: np.zeros_like(v) for k, v in network.parameters.items()}
    batches = []
    by_length = sorted(range(len(examples)), key=lambda i: (len(examples[i][0]), i))
    for lo in range(0, len(by_length), BATCH):
        part = by_length[lo : lo + BATCH]
        dense, paths, used, step, page = batch_of(vectors, [examples[i][0] for i in part])
        label = np.zeros(used.shape, np.float32)
        label[step, page] = [k for i in part for k in examples[i][1]]
        batches.append((dense, paths, used, label))
    n = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for b in rng.permutation(len(batches)):
            n += 1
            _, gradient = network.gradients(*batches[b])
            for key, g in gradient.items():
                first[key] += 0.1 * (g - first[key])
                second[key] += 0.001 * (g * g - second[key])
                network.parameters[key] -= rate * (first[key] / (1 - 0.9**n)) / (np.sqrt(second[key] / (1 - 0.999**n)) + 1e-8)
    return network


def label(network: Network, vectors: Vectors, pages: list[list[tuple[str, tuple[str, ...], float]]]) -> list[list[float]]:
    """Probability of each leaf of each page; pages of like length go together."""
    out: list[list[float]] = [[] for _ in pages]
    order = sorted((i for i, x in enumerate(pages) if x), key=lambda i: len(pages[i]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * len(pages[order[hi]]) <= 4096:
            hi += 1
        part = order[lo:hi]
        dense, paths, used, step, page = batch_of(vectors, [pages[i] for i in part])
        prob = sigmoid(network.run(dense, paths, used))
        for k, i in enumerate(part):
            out[i] = prob[: len(pages[i]), k].tolist()
        lo = hi
    return out


def sample(pages: DataFrame) -> list[str]:
    """Pages, evenly thinned by a hash of their id to the sample's bounds."""
    short = pages.where((F.length("html") > 0) & (F.length("html") <= SAMPLE_CHARACTERS)).select("page_id", "html")
    n = max(1, short.count())
    rows = short.where(common.drawn("page_id", "html") < common.share_of(SAMPLE_PAGES, n)).limit(2 * SAMPLE_PAGES).collect()
    return [r["html"] for r in sorted(rows, key=lambda r: (str(r["page_id"]), r["html"]))]


def extract(pages: DataFrame, network: Network) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages; n_leaves counts the leaves it had."""

    def make():
        vectors = Vectors()

        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            parsed = [leaves(x) if x else [] for x in batch.column("html").to_pylist()]
            texts = [
                " ".join(text for (text, _, _), p in zip(page, prob) if p >= 0.5) for page, prob in zip(parsed, label(network, vectors, parsed))
            ]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array([len(x) for x in parsed], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_leaves"])

        return kernel

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return common.arrow_map(pages, make, "page_id long, url string, text string, n_chars long, n_leaves long", "html")


def learnt(pages: DataFrame) -> Network:
    return fit(sample(pages))
