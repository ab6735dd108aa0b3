"""The registered queries: each applies an operator to its whole table in production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldkeep.llm import (
    content_sort,
    crf,
    imatch,
    minhash,
    nndescent,
    packing,
    pages,
    periods,
    pieces,
    secrets,
    shared_search,
    suffixes,
    toxicity,
)
from coldkeep.llm.common import table

def held_out() -> Column:
    """Rows that no model learns from."""
    return F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)")


def learning(df: DataFrame) -> DataFrame:
    """Rows that models may learn from; the others are held out."""
    return df.where(~held_out())


def op1_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = crf.identify(docs, crf.learnt(learning(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "shares")


def op2_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op4_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_block_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages")
    return pages.extract(raw, pages.learnt(raw))


def op7_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, length=2048)


def op8_zstd_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_string_kernel_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learnt(learning(docs), learning(labels))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "worst_unit",
    )


def op11_sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(table(spark, sf_dir, "documents"), edited=True).drop("runs", "kept")


def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_groups(table(spark, sf_dir, "documents"))


def op13_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    "op1_crf": op1_crf,
    "op2_circulant_minhash": op2_circulant_minhash,
    "op3_imatch": op3_imatch,
    "op4_offset_pieces": op4_offset_pieces,
    "op5_difference_cover": op5_difference_cover,
    "op6_block_lstm": op6_block_lstm,
    "op7_shortest_pack_first": op7_shortest_pack_first,
    "op8_zstd_novelty": op8_zstd_novelty,
    "op9_nn_descent": op9_nn_descent,
    "op10_string_kernel_svm": op10_string_kernel_svm,
    "op11_sync_runs": op11_sync_runs,
    "op12_content_sort": op12_content_sort,
    "op13_shared_search": op13_shared_search,
}

ORACLE = {
    "op2_circulant_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2),
                    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g
            FROM words),
        sizes AS (SELECT doc_id, len(g) AS n FROM sets),
        shingles AS (SELECT doc_id, unnest(g) AS h FROM sets),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
            FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * i >= 80 * (x.n + y.n - i)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sizes
            UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sizes JOIN lowest ON a = doc_id
    """,
    "op9_nn_descent": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (
            SELECT vec_id, e FROM vectors
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM vectors
            UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM vectors JOIN lowest ON lowest.a = vec_id LEFT JOIN degree ON degree.a = vec_id
    """,
    "op12_content_sort": r"""
        WITH plain AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY t)
        SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM plain JOIN groups USING (t)
    """,
    "op13_shared_search": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents),
        sizes AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM words WHERE len(w) > 0),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        counts AS (
            SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
            FROM counts, totals GROUP BY term, docs),
        items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(weight
                * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
            FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
            GROUP BY item_id, doc_id)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scores WHERE score > 0)
        WHERE rank <= 50
    """,
}
