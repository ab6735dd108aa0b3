"""Secrets in texts: fixed patterns, and strings that zstandard finds novel in a sensitive context.

The patterns give the base spans (kinds assign, access, hex): whole matches, in code points, end
exclusive. The method adds spans of kind novel: every string of 12 or more characters, three of them
letters, in a text that has a sensitive word somewhere, before or behind the string, is measured by
the bytes it adds when it is compressed behind the text on both of its sides, with a dictionary of
identifiers that code is full of. Words, names and repeated values cost little there; random strings
cost about their own entropy, and are reported. A string without letters is a number, not a secret. A
long string is measured in blocks and reported whole if one of them is novel. A novel string that
meets a base span is left out.

Defined results: a null text is an empty one and has no spans; every row is scanned on its own, so
repeated rows have equal results, whatever their ids; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldkeep.llm import common

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: One of these must be in a text for ASSIGN to match; checked on the lower-cased text.
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: A candidate's text holds one of these words, at any distance.
SENSITIVE = re.compile(r"(?ai:passphrase|passw|pwd|secret|token|api.?key|auth|bearer|credential|private.?key|signature|session.?id|access.?key)")
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "api", "auth", "bearer", "credential", "private", "signature", "session", "access")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=](?:[A-Za-z0-9+/_=.-]*[A-Za-z0-9+/_=])?")
LEAST, LEAST_LETTERS = 12, 3
#: Dotted or dashed strings that are no secrets: words without digits, and names of hosts.
COMPOUND = re.compile(r"[A-Za-z]*(?:[.+/_=-]+[A-Za-z]*)+|(?:[a-z0-9-]{1,20}\.)+[a-z]{2,6}")
#: The short last line of a value that is broken into lines.
TAIL = re.compile(r"[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_=]{1,11}(?=[\x20\t]*(?:[\r\n]|\Z))")
#: Longer strings are measured in blocks of at most so many characters.
BLOCK = 512
#: Text on both sides of a candidate that the compressor has seen before it.
SURROUNDINGS = 512
#: Compressed bytes a character must add. From LONG characters on, zstandard codes hexadecimal
#: digits by their entropy of half a byte; shorter strings stay as they are. Strings that look like
#: words or numbers must add more, as a rare word does add more than a common one.
LEAST_NOVELTY, LEAST_NOVELTY_LONG, LONG = 0.62, 0.45, 48
LEAST_NOVELTY_PLAIN = 0.7
#: Identifiers of common code; a value made of them is no secret.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key credential credentials "
    "authorization authenticate authentication bearer session session_id signature client_id client_secret username "
    "user_name email example placeholder changeme undefined null none true false default config configuration settings "
    "environment variable function return import include class public private protected static const string integer "
    "boolean object array value values key keys name names path file filename directory response request header headers "
    "content type application json html text plain charset http https www localhost server client database connection "
    "timeout retry exception error message logger debug info warning index length count number address license version "
    "copyright software permission notice documentation attribution"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the matches of the fixed patterns, leftmost and apart per kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class Novelty:
    """Compressed bytes that a string adds behind its surroundings."""

    def __init__(self):
        import zstandard

        words = IDENTIFIERS.split()
        forms = [*words, *(w.upper() for w in words), *(w.title().replace("_", "") for w in words)]
        dictionary = zstandard.ZstdCompressionDict(" ".join(forms).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compress = zstandard.ZstdCompressor(level=9, dict_data=dictionary, write_content_size=False).compress

    def __call__(self, around: str, value: str) -> float:
        """Added bytes for each character; letters count without their case as well, as code changes it."""
        behind = around.encode() + b"\n"
        added = [len(self.compress(behind + v.encode())) - len(self.compress(behind)) for v in (value, value.lower())]
        return min(added) / len(value)


def mixed(value: str) -> bool:
    """Letters with digits, or cases that alternate: what a random string nearly always has."""
    letters = sum(c.isalpha() for c in value)
    digits = sum(c.isdigit() for c in value)
    turns = sum(a.islower() and b.isupper() for a, b in zip(value, value[1:]))
    return letters >= 3 and (digits >= 3 or turns >= 4)


def novel(text: str, start: int, end: int, novelty: Novelty) -> bool:
    """Whether one of the blocks of a string adds as many bytes as a string of its kind must."""
    blocks = -(-(end - start) // BLOCK)
    cuts = [start + (end - start) * i // blocks for i in range(blocks + 1)]
    for a, b in zip(cuts, cuts[1:]):
        around = text[max(0, a - SURROUNDINGS) : a] + text[b : b + SURROUNDINGS]
        least = LEAST_NOVELTY_LONG if b - a >= LONG else LEAST_NOVELTY
        if novelty(around, text[a:b]) >= (least if mixed(text[a:b]) else LEAST_NOVELTY_PLAIN):
            return True
    return False


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    lower = text.lower()
    if not any(word in lower for word in SENSITIVE_WORDS):
        return []
    if not SENSITIVE.search(text):
        return []
    found = []
    for m in CANDIDATE.finditer(text):
        if m.end() - m.start() < LEAST or sum(map(str.isalpha, m[0])) < LEAST_LETTERS or COMPOUND.fullmatch(m[0]):
            continue
        if any(a < m.end() and m.start() < b for a, _, b in base) or not novel(text, *m.span(), novelty):
            continue
        tail = TAIL.match(text, m.end()) if len(m[0]) >= LONG else None
        found.append((m.start(), 3, tail.end() if tail else m.end()))
    return found


@cache
def _novelty() -> Novelty:
    return Novelty()


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans, by start, then by kind as listed."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, _novelty()))


def find_secrets(docs: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kinds, starts, ends (arrays, in order) and redacted, the text with every span replaced.

    The columns named in others are passed through.
    """

    def make():
        def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, redacted = [], []
            for text in batch.column("text").to_pylist():
                spans = spans_of(text)[1] if text else []
                rows.append(spans)
                redacted.append(redact(text, spans))
            columns = [
                batch.column("doc_id"),
                pa.array([[KINDS[k] for _, k, _ in spans] for spans in rows], pa.list_(pa.string())),
                pa.array([[a for a, _, _ in spans] for spans in rows], pa.list_(pa.int32())),
                pa.array([[b for _, _, b in spans] for spans in rows], pa.list_(pa.int32())),
                pa.array(redacted, pa.string()),
            ]
            columns += [batch.column(c) for c in others]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "kinds", "starts", "ends", "redacted", *others])

        return kernel

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *others)
    schema = "doc_id long, kinds array<string>, starts array<int>, ends array<int>, redacted string"
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    return common.arrow_map(docs, make, schema, "text")


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """Overlapping spans are replaced together by one mark."""
    if not spans:
        return text
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def report(found: DataFrame) -> DataFrame:
    """The digest columns of find_secrets' rows."""
    entries = F.transform(
        F.arrays_zip("kinds", "starts", "ends"),
        lambda x: F.concat_ws(":", x["kinds"], x["starts"].cast("string"), x["ends"].cast("string")),
    )
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(entries, lambda x: ~x.startswith("novel:"))
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(entries, ",").alias("spans"),
    )
