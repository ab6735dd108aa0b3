"""Exact copies, periodic runs and ranked search against brute force, on tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldkeep.llm import content_sort, periods, shared_search

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, parts=5):
    """With extra columns whose names clash with those the operators make."""
    data = [(k, t, 1, "x", 2, "y", False, "b") for k, t in rows]
    schema = "doc_id long, text string, run int, text_sha256 string, n int, terms string, kept boolean, begin string"
    return spark.createDataFrame(data, schema).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, part int")


# exact copies


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    licence = "Licence text that very many rows share at their beginning. " * 3
    rows = [(i, "the same text\nin a third of all rows") for i in range(0, 900, 3)]
    rows += [(1000 + i, f"{licence}{i % 40}") for i in range(200)]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "\t\n "), (2004, "a  b"), (2005, "a\x0b\x0cb"), (2006, "a b"), (2007, "a\xa0b")]
    rows += [(3000, "z" * 300_000), (2999, "z" * 300_000), (3001, "z" * 299_999 + "y")]
    rows += [(None, "no id"), (None, "no id"), (4000, "id once"), (None, "id once"), (5000, "twice"), (5000, "twice"), (5000, "other")]
    rng.shuffle(rows)
    return rows


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_content_groups_equal_brute_force(spark, copies):
    groups = {}
    for key, text in copies:
        groups.setdefault(norm(text), []).append(key)
    got = content_sort.content_groups(frame(spark, copies, 16)).collect()
    assert len(got) == len(copies)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_sha256, []).append(r)
    assert set(by_text) == {sha(t) for t in groups}
    for text, keys in groups.items():
        rows = by_text[sha(text)]
        least = min((k for k in keys if k is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in rows} == {(least, len(keys))}
        assert sorted((r.doc_id for r in rows), key=repr) == sorted(keys, key=repr)
        assert [r.doc_id for r in rows if r.kept] == [least]


def test_groups_cross_the_edges_of_ranges(spark, copies):
    """The third of all rows that is one text is dealt over several ranges, and still one group."""
    runs = content_sort._sorted(frame(spark, copies, 16)).mapInArrow(content_sort._runs, content_sort.RUNS)
    common = runs.where(F.col("text_sha256") == sha("the same text in a third of all rows"))
    assert common.select("part").distinct().count() > 1


def test_content_runs_by_batch(spark):
    """Runs that begin, end and go on at the edges of Arrow batches."""
    rows = [(i, t) for i, t in enumerate("a b b c c c d".split() * 3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        sorted_rows = content_sort._sorted(frame(spark, rows, 2)).coalesce(1)
        runs = sorted_rows.mapInArrow(content_sort._runs, content_sort.RUNS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.doc_id for r in runs) == list(range(21))
    sizes = {r.text_sha256: r.size for r in runs}
    assert sizes == {sha("a"): 3, sha("b"): 6, sha("c"): 9, sha("d"): 3}
    assert len({r.run for r in runs}) == 4 and sum(r.leads for r in runs) == 4


def test_distinct_documents(spark, copies):
    kept = content_sort.distinct_documents(frame(spark, copies))
    assert kept.count() == len({norm(t) for _, t in copies})
    assert kept.columns == frame(spark, copies).columns


# periodic runs


def words_of(key, text, edited):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if edited and key is not None and w:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def runs_of(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(w[i : i + size - p] == w[i + p : i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.fixture(scope="module")
def repeating():
    rng = random.Random(9)
    vocabulary = [f"w{i}é" for i in range(40)]
    rows = [(None, "a a a a a a a"), (1, None), (2, ""), (3, " \n\t"), (4, "a a a a a"), (5, "a a a a a a"), (6, "a b a b a b a b")]
    rows += [(7, "a b " * 5 + "a"), (8, "x \x00 \x1f \xa0 " * 6), (8, "x y z " * 9), (9, ("a " * 9 + "b ") * 9), (9, ("a " * 9 + "b ") * 9)]
    fib = ["a", "a b"]
    while len(fib[-1]) < 1500:
        fib.append(f"{fib[-1]} {fib[-2]}")
    rows += [(10, fib[-1]), (11, "same " * 40_000)]
    for key in range(20, 140):
        w = []
        for _ in range(rng.randint(1, 6)):
            size = 1 if rng.random() < 0.2 else rng.randint(1, 60)
            unit = [rng.choice(vocabulary[: rng.choice((2, 5, 40))]) for _ in range(size)]
            w += (unit * rng.randint(1, 9))[: rng.randint(1, 250)]
        rows.append((key, rng.choice((" ", "  ", "\n")).join(w)))
    return rows


@pytest.mark.parametrize("edited", [False, True])
def test_periodic_runs_equal_brute_force(spark, repeating, edited):
    want = []
    for key, text in repeating:
        w = words_of(key, text, edited)
        runs = [(0, len(w), 1)] if len(set(w)) == 1 and len(w) > 1000 else runs_of(w)
        drop = {i for a, size, q in runs for i in range(a + q, a + size)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        collapsed = " ".join(x for i, x in enumerate(w) if i not in drop)
        lines = "".join(f"{a},{s},{q}\n" for a, s, q in runs)
        want.append((key, len(runs), *best, milli, sha(lines), sha(collapsed)))
    got = periods.periodic_runs(frame(spark, repeating), edited).drop("runs", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 100 and any(r[4] and r[4] > 30 for r in want)


def test_every_scale_finds_its_periods():
    """One period at a time, up to long ones, with runs as short as they may be."""
    rng = np.random.default_rng(3)
    for q in [*range(1, 70), 127, 128, 129, 255, 256, 500, 1023, 1024]:
        unit = rng.integers(0, 50, q)
        unit[-1] = 99  # so that the period is not shorter
        run = np.tile(unit, 8)[: max(6, 4 * q)]
        words = np.concatenate((rng.integers(100, 1000, 37), run, rng.integers(2000, 3000, 11), [5000]))
        assert (37, len(run), q) in map(tuple, periods.find_runs(words, np.array([len(words)])).tolist())


# ranked search


def brute_search(docs, items, k):
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    bags = [(key, re.findall(term, (text or "").translate(LOWER))) for key, text in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = {}
    for _, bag in bags:
        for t in set(bag):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(re.findall(term, (text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for key, bag in bags:
            m = 50 + (50 * len(bag) * n_docs) // max(n_terms, 1)
            score = 0
            for t in terms & set(bag):
                tf = bag.count(t)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, i + 1, key, -s) for i, (s, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("Ka", "lo", "É", "7", "日") for b in ("ta", "no", "sü", "ve", "x9")]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    pick = lambda n: "-".join(rng.choices(vocabulary, weights, k=n))
    docs = [(1, None), (2, ""), (3, "--- \x7f"), (None, "kata lono"), (4, "kata " * 20_000), (5, "KATA kata"), (6, "kata\xa0lono kata\x00x")]
    docs += [(7, "kata kata")] * 2 + [(100 + i, "lono lota same") for i in range(70)] + [(200 + i, pick(rng.randint(1, 60))) for i in range(150)]
    shared = pick(6)
    items = [(i, f"{shared} {pick(rng.randint(1, 15))}") for i in range(30)]
    items += [(40, None), (41, "..."), (42, "unheard"), (None, "kata"), (43, "lono"), (43, "same"), (0, shared)]
    return docs, items


@pytest.mark.parametrize("block", [512, 7])
def test_search_equals_brute_force(spark, corpus, block, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(shared_search, "BLOCK", block)
    monkeypatch.setattr(shared_search, "PIECE_DOCS", 10)
    asked = spark.createDataFrame([(k, t, 1, 2) for k, t in items], "item_id long, text string, rank int, score int")
    got = shared_search.search(frame(spark, docs), asked, k=50)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(docs, items, 50)


def test_sharing_adds_up_and_saves_additions():
    rng = random.Random(4)
    common = list(range(12))
    items = [set(rng.sample(common, rng.randint(0, 10))) | set(rng.sample(range(12, 400), 8)) for _ in range(60)] + [set()]
    dag = shared_search.Sharing(items)
    values = np.array([rng.randint(0, 10**9) for _ in range(400)])
    sums = np.zeros((dag.size, 1), np.int64)
    for t, node in dag.atom_of.items():
        sums[node] += values[t]
    assert dag.sums(sums)[:, 0].tolist() == [int(sum(values[t] for t in terms)) for terms in items]
    assert dag.pairs and dag.additions() < 0.8 * sum(len(t) - 1 for t in items if t)


def test_too_many_item_terms_are_refused(spark, monkeypatch):
    monkeypatch.setattr(shared_search, "MOST_TERMS", 2)
    asked = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    with pytest.raises(ValueError, match="3 distinct item terms"):
        shared_search.search(frame(spark, [(1, "a")]), asked)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert content_sort.content_groups(empty(spark)).count() == 0
    assert content_sort.distinct_documents(empty(spark)).count() == 0
    assert periods.periodic_runs(empty(spark), True).count() == 0
    assert shared_search.search(empty(spark), one).count() == 0
    assert shared_search.search(frame(spark, [(1, "a b")]), none).count() == 0
    assert shared_search.search(frame(spark, [(1, None), (2, "")]), one).count() == 0
