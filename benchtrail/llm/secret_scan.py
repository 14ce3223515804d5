"""Secret scans: keyword automaton, anchored expressions, checksums.

One Aho-Corasick automaton holds the keywords that a secret of each kind must
contain: the names of assignments, the prefixes of issued tokens, and all
four-digit hexadecimal strings for bare hex runs. Only where it hits, the
kind's expression is matched, anchored at the place that the hit names; a
kind with an embedded checksum counts only if the checksum is right.

Kinds, in this order: assign, access, hex (the base kinds), then github and
npm, whose last six characters are the CRC-32 of the thirty before them in
base 62.

Positions are code points, ends exclusive. Defined results: a null or empty
text has no spans; repeated rows are scanned alike; other columns are ignored
(report) or kept (redaction).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchtrail.llm.common import documents

KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ISSUED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
HEX_GRAM = 4
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: upper-case A-Z only, so that positions stay
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

_built: list = []


def automaton() -> ahocorasick.Automaton:
    """One per worker process; its size is fixed by the keyword list."""
    if not _built:
        a = ahocorasick.Automaton()
        for w in NAMES:
            a.add_word(w, ("assign", len(w)))
        a.add_word("akia", ("access", 4))
        for w in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"):
            a.add_word(w, ("github", 4))
        a.add_word("npm_", ("npm", 4))
        for i in range(16**HEX_GRAM):
            a.add_word(f"{i:0{HEX_GRAM}x}", ("hex", HEX_GRAM))
        a.make_automaton()
        _built.append(a)
    return _built[0]


def checksum62(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = DIGITS62[r] + out
    return out


def folded(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else text.translate(LOWER)


def scan(text: str | None) -> list[tuple[int, int, int, str]]:
    """Spans (start, order of kind, end, kind) of a text, sorted."""
    if not text:
        return []
    spans, hits, hex_end = [], {k: [] for k in KINDS}, 0
    for last, (kind, size) in automaton().iter(folded(text)):
        if kind != "hex":
            hits[kind].append(last - size + 1)
        elif last >= hex_end:  # runs are maximal: one match at the start of the run answers all hits in it
            start = last - HEX_GRAM + 1
            while start > hex_end and text[start - 1] in "0123456789abcdef":
                start -= 1
            m = HEX.match(text, start)  # none if the hit is in upper case
            hex_end = max(hex_end, m.end() if m else 0)
            if m and m.end() - start >= MIN_HEX:
                spans.append((start, 2, m.end(), "hex"))
    for order, kind, expression in ((0, "assign", ASSIGN), (1, "access", ACCESS), (3, "github", ISSUED), (4, "npm", ISSUED)):
        end = 0
        for start in sorted(hits[kind]):
            m = expression.match(text, start) if start >= end else None
            if not m:
                continue
            end = m.end()  # matches that fail below still stand in the way of later ones
            if (kind == "assign" and len(m[2]) >= MIN_ASSIGN or kind == "access" and end - start >= MIN_ACCESS
                    or order > 2 and checksum62(m[1]) == m[2]):
                spans.append((start, order, end, kind))
    return sorted(spans)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan(t.as_py()) for t in b.column(1)]
            counts = [pa.array([sum(s[3] == k for s in x) for x in found], pa.int64()) for k in BASE]
            digests = [hashlib.sha256(joined(s for s in x if s[1] < len(BASE)).encode()).hexdigest() for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(digests, pa.string()), pa.array(map(joined, found), pa.string())],
                                             ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by ``[kind]``; of overlapping spans the first names the kind."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for start, _, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the secrets in their text replaced."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array([redacted(t.as_py()) for t in b.column(at)], b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scan(spark, sf_dir):
    return scan_secrets(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
