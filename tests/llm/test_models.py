"""Trained operators, vectors, pages and the pipeline."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from coldkeep.llm import crf, nndescent, pages, toxicity
from coldkeep.llm.queries import QUERIES


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    emission, transition = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    total, weight = np.zeros((5, 3)), 0.0
    for path in itertools.product(range(3), repeat=5):
        score = sum(emission[i, k] for i, k in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))
        # The step into the first word comes from a label of which nothing is known.
        p = np.exp(score) * np.exp(transition[:, path[0]]).sum()
        weight += p
        total[np.arange(5), list(path)] += p
    assert np.allclose(crf.marginals(emission, transition, np.zeros(5, int)), total / weight)
    text = np.repeat(np.arange(4), [1, 31, 33, 150])
    emission = rng.normal(size=(len(text), 3)) * 3
    assert np.allclose(crf.marginals(emission, transition, text), crf.pair_marginals(emission, transition, text)[0])


def test_language_of_documents(spark):
    rng = random.Random(1)
    vocab = {"en": ["the", "thing", "and", "what", "shell"], "de": ["der", "schön", "und", "strasse", "haus"]}
    rows = [(i, " ".join(rng.choices(vocab[lang], k=30)), lang) for i, lang in enumerate(["en", "de"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crf.learnt(docs.where("doc_id < 60"))
    asked = [(1, "the thing and what"), (2, "der und haus"), (3, None), (4, ""), (5, "12 34 — ½"), (6, "der schön und " * 5 + "the")]
    got = {r.doc_id: r for r in crf.identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert [got[k].lang_pred for k in range(1, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert got[3].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    nothing = crf.identify(docs, crf.learnt(docs.where("lang is null"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_toxicity_tolerates_gaps(spark):
    rng = random.Random(1)
    words = ["there", "heron", "anther", "nothing", "stone", "lemon", "raised", "editor"]
    insults = ["idiot", "moron"]
    rows = []
    for i in range(400):
        text = [rng.choice(words) + rng.choice(words)[:3] for _ in range(20)]
        if i % 4 == 0:
            text[rng.randrange(20)] = rng.choice(insults)
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(1, None), (2, 7)], "doc_id long, toxic int")
    model = toxicity.learnt(docs, labels)
    asked = ["you idiot", "you i d i o t", "you id.iot", "an idioot", "m0ron", "there is a stone", "", None, "12 ."]
    frame = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert all(got[k] >= 0.7 for k in range(5)) and all(got[k] < 0.5 for k in range(5, 9))
    assert {r.score for r in toxicity.score(frame, toxicity.learnt(docs, labels.where("toxic = 0"))).collect()} == {0.0}


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + 0.12 * (1 + i % 3) * rng.normal(size=16)).tolist()) for i in range(240)]
    rows += [(300 + i, rng.normal(size=16).tolist()) for i in range(100)]
    rows += [(500, rows[0][1]), (501, rows[0][1]), (0, rows[0][1]), (502, [2 * x for x in rows[1][1]])]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [None] * 16), (605, [1.0] * 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nndescent.near_duplicates(frame).collect()
    good = [(k, np.array(v, float)) for k, v in rows if k < 600]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.array([k for k, _ in good])
    while True:
        lower = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, lower)
        if (new == label).all():
            break
        label = new
    want = sorted((k, int(n), int(c)) for (k, _), n, c in zip(good, linked.sum(axis=1), label))
    want += [(k, 0, k) for k, _ in rows if k >= 600]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(want)
    assert nndescent.near_duplicates(frame.where("false")).count() == 0


def test_bridges_between_dense_groups(spark):
    """The bridge is nearer to 200 vectors of one group than to the other, whose lists are full as well."""
    rng = np.random.default_rng(12)
    rows = []
    for group in range(8):
        a, b = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
        for degrees, many in ((0, 200), (4, 1), (28, 14)):
            t = np.radians(degrees)
            for _ in range(many):
                rows.append((1000 * group + len(rows) % 215, (np.cos(t) * a + np.sin(t) * b + 0.001 * rng.normal(size=24)).tolist()))
    got = nndescent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()
    links = {i: 214 if i == 200 else 200 if i < 200 else 14 for i in range(215)}
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(k, links[k % 1000], k // 1000 * 1000) for k, _ in sorted(rows)]


def test_recall_counts_every_vector_the_same(spark, monkeypatch):
    """A large group that is found does not hide that all pairs are lost; a recall not reached is an error."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=24)
    x = [centre + 0.01 * rng.normal(size=24) for _ in range(150)]
    for _ in range(40):
        one = rng.normal(size=24)
        x += [one, one + 0.01 * rng.normal(size=24)]
    nodes = spark.createDataFrame([(i, (v / np.linalg.norm(v)).tobytes()) for i, v in enumerate(x)], "node long, v binary")
    placed = spark.createDataFrame([(i, 0) for i in range(150)], "node long, component long")
    assert abs(nndescent.recall(nodes, placed, len(x), 24, 0.9) - 150 / 230) < 1e-9
    monkeypatch.setattr(nndescent, "recall", lambda *_: 0.5)
    monkeypatch.setattr(nndescent, "AUDITS", 1)
    with pytest.raises(RuntimeError, match="recall 0.5"):
        nndescent.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:60])], "vec_id long, embedding array<double>"))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>My site</h1><nav>
<a href=/>Home</a></nav></header><div class="cookie-notice">We use cookies.</div><main><article><h1>Real &amp; title</h1>
<p>First <b>para</b> with <a href="x>y">link</a>ed   text.<br>More.<aside>Buy now!</aside><p>Unclosed <ul><li>one<li>two</ul>
<form><label>Email</label></form><div class="advert">AD</div><p>Last &#233; para.</p></article><section id="comments">
<div class="comment"><p>I liked it.</p></div></section></main><footer>&copy; 2024</footer><script>var x="<p>no</p>";</script>"""


def test_page_text(spark):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    sample = [
        f"<html><body><nav><a>{rng.choice(words)}</a></nav><article><h1>{rng.choice(words)}</h1>"
        + "".join(f"<p>{' '.join(rng.choices(words, k=20))}.</p>" for _ in range(4))
        + f"</article><footer>{' '.join(rng.choices(words, k=5))}</footer></body></html>"
        for _ in range(30)
    ]
    rows = [(i, f"u{i}", h) for i, h in enumerate([PAGE, None, "", "<p>", "plain < text", *sample])] + [(0, "u0", PAGE)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = pages.extract(frame, pages.learnt(frame)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[0].text == "Real & title First para with linked text. More. Unclosed one two Last é para."
    assert by_id[1].text == by_id[2].text == by_id[3].text == "" and by_id[1].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got)
    assert len({r.text for r in got if r.page_id == 0}) == 1


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of small tables: toxic documents, near copies, shared passages and secrets."""
    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("corpus"))
    words = [a + b for a in ("ka", "lo", "mi", "ru") for b in ("ta", "no", "ve", "xi", "du")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, rows, labels = prose(40), [], []
    for i in range(150):
        text = prose(60)
        if i % 5 == 0:
            text += " moron " + prose(4)
        if i % 7 == 0:
            text = f"{prose(20)} {passage} {prose(20)}"
        rows.append((i, text))
        labels.append((i, int(" moron " in text)))
    rows += [(200, rows[1][1]), (201, rows[1][1] + " end"), (202, "token = 'abcdef0123456789abcdef0123'"), (203, None), (204, "")]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows), passage


def test_pipeline(spark, corpus):
    folder, rows, passage = corpus
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        if name != "packing":
            assert out.columns == docs.columns
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "suffixes", "secrets", "packing"]
    clean = {k for k, t in rows.items() if " moron " not in (t or "")}
    assert {r.doc_id for r in kept["toxicity"]} == clean
    assert {r.doc_id for r in kept["minhash"]} == clean - {200, 201}
    with_passage = [r for r in kept["suffixes"] if passage in (r.text or "")]
    assert [r.doc_id for r in with_passage] == [min(k for k in clean if passage in (rows[k] or ""))]
    assert "abcdef0123456789" not in next(r.text for r in kept["secrets"] if r.doc_id == 202)
    assert {r.doc_id for r in kept["packing"]} == clean - {200, 201}
    assert corpus_pipeline.run(spark, folder).count() == len(kept["packing"])


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
