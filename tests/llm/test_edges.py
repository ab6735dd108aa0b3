"""Nulls in any column, empty and long texts, repeated rows, empty tables and clashing names."""

import logging
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from coldkeep.llm import common, crf, imatch, minhash, nndescent, packing, pages, pieces, secrets, suffixes, toxicity

#: Names that the operators give to columns of their own.
CLASHES = (
    "score", "kept", "place", "unit", "node", "component_id", "n", "part", "bucket", "label", "terms", "fp", "length", "rank",
    "begin", "marks", "shared", "lang_pred", "spans", "kinds", "redacted", "ids", "text_sha256", "_key", "_block", "version", "v",
)
LONG = "Wort für Wort und word by word " * 20_000


def rows_of():
    return [
        (1, "the thing and what"), (1, "the thing and what"), (1, "another text of this id"), (None, "no id here"), (None, None),
        (2, None), (3, ""), (4, " \n"), (5, LONG), (6, "😀 → 123"), (7, "password = 'abcdef123456'"), (8, "x"),
    ]


def frame(spark, rows=None, clashes=CLASHES):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(k, t, "en" if t else None, None, None) for k, t in (rows_of() if rows is None else rows)]
    df = spark.createDataFrame(data, schema)
    return df.select("*", *[F.lit("clash").alias(c) for c in clashes if c not in df.columns]).repartition(3)


@pytest.fixture(scope="module")
def models(spark):
    rng = random.Random(1)
    vocab = {"en": ["the", "thing", "and", "what", "shell"], "de": ["der", "schön", "und", "strasse", "haus"]}
    docs = [(i, " ".join(rng.choices(vocab[g], k=30) + (["idiot"] if i % 4 < 2 else [])), g) for i, g in enumerate(["en", "de"] * 60)]
    learn = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2)) for i, _, _ in docs], "doc_id long, toxic int")
    return crf.learnt(learn), toxicity.learnt(learn, labels)


def operators(models):
    language, machine = models
    words, piece = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return {
        "language": lambda d: crf.identify(d, language),
        "minhash": minhash.near_duplicates,
        "imatch": imatch.fingerprints,
        "pieces": lambda d: pieces.encode(d, piece),
        "suffixes": suffixes.repeated,
        "packing": lambda d: packing.pack(d, words),
        "secrets": secrets.find_secrets,
        "toxicity": lambda d: toxicity.score(d, machine),
    }


@pytest.mark.parametrize("name", ["language", "minhash", "imatch", "pieces", "suffixes", "packing", "secrets", "toxicity"])
def test_awkward_rows(spark, models, name):
    operator = operators(models)[name]
    got = operator(frame(spark)).collect()
    ids = [k for k, _ in rows_of()]
    if name == "packing":  # a long text has several pieces
        assert {r.doc_id for r in got} == set(ids)
        assert sum(1 for r in got if r.start == 0) == len(ids)
    else:
        assert sorted((r.doc_id for r in got), key=repr) == sorted(ids, key=repr)
    plain = operator(frame(spark, clashes=())).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, plain)) or name == "packing"
    twice = [r for r in got if r.doc_id == 1]
    assert len(twice) >= 3
    assert operator(frame(spark, [])).collect() == []


def test_null_ids_stand_for_a_group_only_alone(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (9, text), (None, text + " more"), (None, "quite another text of a few words"), (None, None)]
    got = sorted((r.doc_id is not None, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted([(False, 26, 9, False), (True, 26, 9, True), (False, 27, 9, False), (False, 3, None, True), (False, 0, None, True)])
    vectors = [(None, [1.0, 0.0]), (4, [1.0, 0.01]), (None, [0.0, 1.0]), (None, None)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("component", F.lit(1)).withColumn("least", F.lit(2))
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in nndescent.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == sorted([(None, 1, 4, False), (4, 1, 4, True), (None, 0, None, True), (None, 0, None, True)], key=repr)


def test_no_letter_no_language(spark, models):
    asked = ["😀 😀", "€ 100 €", "→→", "、。", "١٢٣", "× ÷", "½²", "́ ̀", "ª", "日本", "नमस्ते", "Ω", "a1"]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in crf.identify(df, models[0]).collect()}
    assert [got[i].lang_pred == "und" for i in range(len(asked))] == [True] * 8 + [False] * 5
    assert all((r.score > 0) == (r.lang_pred != "und") for r in got.values())


def test_words_keep_their_marks():
    import pyarrow as pa

    texts = ["नमस्ते x", "été", "ab-cd"]
    _, start, end, text = crf.words_of(*common.utf8(pa.array(texts)))
    data = "".join(texts).encode()
    assert [data[a:b].decode() for a, b in zip(start, end)] == ["नमस्ते", "x", "été", "ab", "cd"]
    assert text.tolist() == [0, 0, 1, 2, 2]


@pytest.mark.parametrize(
    "page,want",
    [
        ('<header><svg class="i"/><a>Home</a></header><p>One two.</p>', ["Home", "One two."]),
        ('<iframe src="x"/><p>Kept.</p>', ["Kept."]),
        ("<p>A</p><svg><text>no</text></svg><p>B</p><SVG><g>no</g></SVG ><p>C</p>", ["A", "B", "C"]),
        ("<svg><p>Never closed</p><svg><object><p>still here</p>", ["Never closed", "still here"]),
        ("<textarea>no</textarea><p>Yes</p><template><p>no</p></template>", ["Yes"]),
        ("<script>if (a < b) {}</script><p>Yes</p><style>p{}", ["Yes"]),
    ],
)
def test_hidden_tags(page, want):
    assert [text for text, _, _ in pages.leaves(page)] == want


def test_many_unclosed_tags_cost_little():
    assert len(pages.leaves("<svg><p>x</p>" * 20_000)) == 20_000


def test_pages_with_nulls(spark):
    article = "<html><body><nav><a>Home</a></nav><article><p>" + "Words of an article. " * 9 + "</p></article></body></html>"
    rows = [(1, "u", article), (1, None, article), (None, None, article), (2, "u", None), (3, "u", ""), (4, "u", "<p>" * 30_000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("y"))
    network = pages.learnt(df)
    got = pages.extract(df, network).collect()
    assert sorted((repr(r.page_id), repr(r.url)) for r in got) == sorted((repr(k), repr(u)) for k, u, _ in rows)
    assert {r.text for r in got if r.page_id == 1} == {r.text for r in got if r.page_id is None}
    assert pages.extract(df.where("false"), network).count() == 0


def test_layouts_of_another_draw_are_told_apart():
    """Held-out layouts: nearly every leaf has the right label."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    sentence = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    raw = [
        f"<html><body><nav><a>{rng.choice(words)}</a></nav><main><h1>{sentence(4)}</h1>{''.join(f'<p>{sentence(15)}</p>' for _ in range(4))}"
        f"</main><footer>{sentence(5)}</footer></body></html>"
        for _ in range(40)
    ]
    network = pages.fit(raw)
    draw = np.random.default_rng(99)
    held_out = [pages.layout(draw, [sentence(15) for _ in range(30)], [sentence(4) for _ in range(30)]) for _ in range(200)]
    found = pages.label(network, pages.Vectors(), [x for x, _ in held_out])
    right = [(p >= 0.5) == bool(y) for probabilities, (_, ys) in zip(found, held_out) for p, y in zip(probabilities, ys)]
    assert sum(right) > 0.97 * len(right)


NOT_SECRETS = ["mail9.example.com is the token host", "the secret 4929348385146306 is a number", "token well-known-compound-word", "token first.Second.Third"]


@pytest.mark.parametrize(
    "text,secret",
    [
        ("sk9Qz7Lm2Xp4Rt8Vw1Yb is my secret token", "sk9Qz7Lm2Xp4Rt8Vw1Yb"),
        ("bearer eyJhbGciOi.JIUzI1NiIs.InR5cCI6Ikp-XVCJ9 end", "eyJhbGciOi.JIUzI1NiIs.InR5cCI6Ikp-XVCJ9"),
        ("token qL9-zX2-Rt7-Bn4-Wp8-Km3-Vc6.", "qL9-zX2-Rt7-Bn4-Wp8-Km3-Vc6"),
        ("session id\n\n3fK9-d82L-xQ7p-Zt5R", "3fK9-d82L-xQ7p-Zt5R"),
    ],
)
def test_secrets_on_both_sides(text, secret):
    at = text.index(secret)
    assert (at, 3, at + len(secret)) in secrets.spans_of(text)[1]
    assert secrets.spans_of(text.replace("secret", "x").replace("token", "y").replace("bearer", "z").replace("session id", "w"))[1] == []


@pytest.mark.parametrize("text", NOT_SECRETS)
def test_what_is_no_secret(text):
    assert secrets.spans_of(text)[1] == []


def test_parted_insults(spark, models):
    asked = ["you id iot", "you idi ot there", "the thing and what", "i d i o t"]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, models[1]).collect()}
    assert got[0] >= 0.7 and got[1] >= 0.7 and got[2] < 0.5 and got[3] >= 0.7


def test_samples_of_very_large_tables(spark):
    """About as many rows as are wanted are drawn, also of very many, and never none."""
    numbers = spark.range(200_000).select(common.drawn("id").alias("d"))
    assert numbers.agg(F.min("d"), F.max("d")).first()[1] < common.SPREAD
    for most in (50, 1200, 10**6):
        n = numbers.where(F.col("d") < common.share_of(most, 200_000)).count()
        assert abs(n - min(1.2 * most, 200_000)) <= 5 * most**0.5
    for rows in (10**10, 10**15):
        assert 1.1 * 1200 < common.share_of(1200, rows) / common.SPREAD * rows < 1.3 * 1200 + rows / common.SPREAD
    assert common.share_of(1, 10**18) == 1 and common.share_of(5, 0) == common.SPREAD


def test_an_audit_without_links_is_unmeasured(spark, caplog):
    rows = [(i, [float(k == i) for k in range(60)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, nodes, dims = nndescent.unit_vectors(df)
    placed = spark.createDataFrame([], "node long, component long")
    assert nndescent.recall(nodes, placed, 50, dims, 0.9) is None
    with caplog.at_level(logging.WARNING):
        got = nndescent.near_duplicates(df).collect()
    assert len(got) == 50 and {r.n_links for r in got} == {0}
    assert "unmeasured" in caplog.text


def test_an_audit_draws_until_it_meets_links(spark, monkeypatch):
    """Few vectors have links: later draws find them."""
    monkeypatch.setattr(nndescent, "AUDITED", 20)
    monkeypatch.setattr(nndescent, "LINKED", 4)
    rng = np.random.default_rng(2)
    x = [rng.normal(size=32) for _ in range(200)]
    x += [x[0] + 0.01 * rng.normal(size=32), x[1] + 0.01 * rng.normal(size=32), x[2] + 0.01 * rng.normal(size=32)]
    nodes = spark.createDataFrame([(i, (v / np.linalg.norm(v)).tobytes()) for i, v in enumerate(x)], "node long, v binary")
    placed = spark.createDataFrame([(0, 0), (200, 0)], "node long, component long")
    found = nndescent.recall(nodes, placed, len(x), 32, 0.9)
    assert found is not None and found < 1


def test_pieces_of_one_length_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(1)
    rows = [(i, "word " * (40 if i % 3 else rng.randint(1, 90))) for i in range(200)]
    got = packing.pack(frame(spark, rows), path, length=64).collect()
    taken = {}
    for r in got:
        taken.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values())


def test_results_outlive_a_pipeline_run(spark, tmp_path):
    """What was staged for another result stays when the pipeline removes its own."""
    rng = random.Random(3)
    passage = " ".join(rng.choice(["ka", "lo", "mi"]) for _ in range(60))
    rows = [(i, f"{i} {passage} {i}") for i in range(20)]
    df = frame(spark, rows, clashes=())
    before = suffixes.repeated(df)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    first = corpus_pipeline.run(spark, str(tmp_path))
    second = corpus_pipeline.run(spark, str(tmp_path))
    assert before.count() == 20
    assert first.count() == second.count() > 0


def test_rows_of_one_id_and_different_texts_stay(spark, tmp_path):
    docs = frame(spark, [(1, "one clean text of some words"), (1, "quite another clean text here"), (1, "quite another clean text here"), (None, None)], clashes=())
    kept = corpus_pipeline.near_distinct(spark, docs, str(tmp_path)).collect()
    assert sorted((repr(r.doc_id), r.text) for r in kept if r.text) == [("1", "one clean text of some words"), ("1", "quite another clean text here")]
    assert len(kept) == 3


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_empty_tables(spark, tmp_path, stage):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert dict(corpus_pipeline.STAGES)[stage](spark, frame(spark, [], clashes=()), str(tmp_path)).count() == 0
