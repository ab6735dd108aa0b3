"""Document fingerprints by I-Match: hashes of a document's mid-frequency terms under randomised lexicons.

Terms whose share of documents lies in a band are the lexicon, all of them: there are at most as many
as the mean distinct terms of a document over LEAST_SHARE. A document's distinct terms in it are sorted
and hashed

* whole, and under WIDE random lexicons that hold three terms in four each (`whole`): equal for
  documents that differ in few terms, as in plain I-Match;
* under families of SUBSETS disjoint random lexicons that become thinner level by level: level d holds
  one term in 2^d, and each term belongs to one subset. Hashes are kept for the level that leaves the
  document 16 to 32 terms (`here`) and for the next one (`above`). Likeness is the share of subsets with
  equal hashes at the higher one of two documents' levels, so it falls little by little as terms change.

Everything is built from SQL functions; the driver sees the document count, the block limits and
the lexicon, whose sizes are bounded by parameters.

Defined results: a null text is an empty one; a document without a lexicon term is fingerprinted by
all its terms, without any term by its text; rows that repeat a doc_id follow each other in the
order of their texts; a null doc_id comes last; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_SHARE, MOST_SHARE = 0.0005, 0.1
SUBSETS = 64
LEVEL_BITS = 4
WIDE = 3
#: Text bytes of a block of document ids, one group of the window below; beyond so many blocks they grow.
BLOCK_BYTES, MOST_BLOCKS = 16 << 20, 1 << 16
#: Limits between blocks that one row is compared with at once.
FAN = 64


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def slots(held: list[int]) -> list[list[int]]:
    """The terms by some bits of their hashes; an array of about one term for each value of these."""
    size = 1 << max(1, (len(held) - 1).bit_length()) if held else 1
    out: list[list[int]] = [[] for _ in range(size)]
    for h in held:
        out[(h >> 12) & (size - 1)].append(h)
    return out


def lexicon(docs: DataFrame) -> Column:
    """The terms of the band as one constant, their `slots`; statistics cover all documents."""
    total = docs.count()
    shares = docs.select(F.explode(terms(F.col("text"))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    band = shares.where(f"df >= {LEAST_SHARE * total} and df <= {max(1.0, MOST_SHARE * total)}")
    held = sorted(row["h"] for row in band.select("h").collect())
    return F.from_json(F.lit(json.dumps(slots(held), separators=(",", ":"))), "array<array<bigint>>")


def in_lexicon(hashes: Column, lexicon: Column) -> Column:
    def held(h: Column) -> Column:
        slot = F.shiftright(h, 12).bitwiseAND(F.size(lexicon).cast("bigint") - 1) + 1
        return F.array_contains(F.element_at(lexicon, slot.cast("int")), h)

    return F.filter(hashes, held)


def _subset(h: Column) -> Column:
    return h.bitwiseAND(F.lit(SUBSETS - 1))


def _thinned(chosen: Column, level: Column) -> Column:
    """The sorted terms that the lexicons of a level hold."""
    rest = F.pow(F.lit(2.0), level).cast("bigint") - 1
    return F.filter(chosen, lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(rest) == 0)


def _subset_hashes(left: str) -> Column:
    """Per subset, the hash of its terms among the sorted ones of a column."""
    return F.sort_array(
        F.transform(
            F.array_distinct(F.transform(left, _subset)),
            lambda s: F.shiftleft(F.xxhash64(F.filter(left, lambda h: _subset(h) == s)), 6).bitwiseOR(s),
        )
    )


def _whole_hashes(chosen: str) -> Column:
    """The hash of all sorted terms, and of those that each wide lexicon holds."""
    wide = [
        F.xxhash64(F.lit(r), F.filter(chosen, lambda h: F.shiftrightunsigned(h, 40 + 4 * r).bitwiseAND(F.lit(3)) != 0))
        for r in range(WIDE)
    ]
    return F.array(F.xxhash64(chosen), *wide)


def with_fingerprint(df: DataFrame, text: str, name: str, lexicon: Column) -> DataFrame:
    """Add a struct of the level, the hashes of all terms, and the subset hashes at this level and the next.

    What is used more than once has a column of its own, so that it is worked out once.
    """
    df = df.withColumn("_terms", terms(F.col(text)))
    df = df.withColumn("_held", in_lexicon(F.col("_terms"), lexicon))
    others = F.when(F.size("_terms") > 0, F.col("_terms")).otherwise(F.array(F.xxhash64(text)))
    df = df.withColumn("_chosen", F.sort_array(F.when(F.size("_held") > 0, F.col("_held")).otherwise(others)))
    df = df.withColumn("_level", F.greatest(F.lit(0), F.floor(F.log2(F.size("_chosen"))).cast("int") - LEVEL_BITS))
    df = df.withColumn("_here", _thinned(F.col("_chosen"), F.col("_level")))
    df = df.withColumn("_above", _thinned(F.col("_here"), F.col("_level") + 1))
    fingerprint = F.struct(
        F.col("_level").alias("level"),
        _whole_hashes("_chosen").alias("whole"),
        _subset_hashes("_here").alias("here"),
        _subset_hashes("_above").alias("above"),
    )
    return df.withColumn(name, fingerprint).drop("_terms", "_held", "_chosen", "_level", "_here", "_above")


def as_text(fingerprint: str) -> Column:
    part = lambda field: F.array_join(F.transform(F.col(f"{fingerprint}.{field}"), lambda x: F.hex(x)), ",")
    level = F.col(f"{fingerprint}.level").cast("string")
    return F.concat_ws(":", level, part("whole"), part("here"), part("above"))


def likeness(a: str, b: str) -> Column:
    """Share of equal subset hashes among the subsets that either document has terms in."""
    level = F.greatest(f"{a}.level", f"{b}.level")

    def at(x: str) -> Column:
        own = F.col(f"{x}.level")
        return F.when(own == level, F.col(f"{x}.here")).when(own == level - 1, F.col(f"{x}.above"))

    either = F.size(F.array_union(F.transform(at(a), _subset), F.transform(at(b), _subset)))
    share = F.when(either > 0, F.size(F.array_intersect(at(a), at(b))) / either)
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def _block(key: Column, limits: list[int]) -> Column:
    """How many limits a key lies above, found in two steps: the group of limits, then the one in it."""
    if not limits:
        return F.lit(0)
    groups = [limits[i : i + FAN] for i in range(0, len(limits), FAN)]
    above = lambda values: F.size(F.filter(values, lambda x: x < key))
    group = above(F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>"))
    inside = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * FAN + above(F.element_at(inside, F.greatest(group, F.lit(1)))))


def blocked(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows dealt into blocks of ids by approximate quantiles, one for each task at least, and for each block a copy of the row that
    comes after it by descending id; after the last comes the first."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(max(2, least, math.ceil(size / BLOCK_BYTES)), MOST_BLOCKS)
    shares = [i / n for i in range(1, n)]
    limits = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * n))).first()[0] or []))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))
    dealt = docs.withColumn("_key", key)
    dealt = dealt.withColumn("_block", _block(F.col("_key"), limits))
    # One row a block: the block before it (that is, of larger ids) ends with a copy of its first row.
    tops = sorted(dealt.groupBy("_block").agg(F.max("_key")).collect(), reverse=True)
    if not tops:
        return dealt, None
    after = {tops[i][0]: tops[(i + 1) % len(tops)] for i in range(len(tops))}
    rows = docs.sparkSession.createDataFrame(
        [(block, top[0], top[1]) for block, top in after.items()], "_for int, _block int, _key long"
    )
    copies = dealt.join(F.broadcast(rows), ["_block", "_key"])
    # Rows that repeat the id of a top are told apart by their texts.
    least = copies.groupBy("_for").agg(F.min("text").alias("text"), F.first("_key").alias("_key"), F.first("doc_id").alias("doc_id"))
    return dealt, least.withColumn("_block", F.col("_for").cast("int")).drop("_for")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness; see the module's text.

    The edited form has its last third replaced by as many leading code points of the next row. Rows
    meet the next one in a single shuffle, and no task sees more than its blocks; every text and every
    edited text is fingerprinted once.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(docs)
    dealt, copies = blocked(docs)
    both = dealt.withColumn("_copy", F.lit(0))
    if copies is not None:
        both = both.unionByName(copies.withColumn("_copy", F.lit(1)))
    order = Window.partitionBy("_block").orderBy("_copy", F.desc("_key"), "text")
    both = with_fingerprint(both, "text", "fp", words)
    df = both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "fp")]).where("_copy = 0")
    cut = F.floor(F.char_length("text") / 3).cast("int")
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - cut), F.substring("next_text", F.lit(1), cut)
    )
    df = df.withColumn("edited", edited).drop("_copy", "_block", "_key", "next_text")
    df = with_fingerprint(df, "edited", "edited_fp", words)
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("fp").alias("fingerprint"),
        as_text("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
    )
