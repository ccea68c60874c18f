"""Secret scan: keyword prefilter, anchored expressions near hits, embedded checksums.

One Aho-Corasick pass over a text (A-Z folded, offsets kept) finds keywords.
Only at those hits the kind's expression is tried, anchored at the hit; a hit
inside an earlier match of the kind is skipped, which gives leftmost
non-overlapping matches. Runs of hexadecimal digits have no keyword and are
found by one expression. Issued tokens that carry a checksum (crc32 of the
body in base 62, as the last six characters) are kept only if it agrees.

Kinds, in order: assign, access, hex, github, npm. Spans are code point offsets
with an exclusive end. Defined results: null or empty text has no spans;
repeated rows are scanned one by one; other columns are not read; spans may
overlap across kinds.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import col

# The expressions and keywords of each kind.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
            "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))

_FOLD = {i: i + 32 for i in range(65, 91)}
_AUTOMATON = None


def checksum62(body: str) -> str:
    """crc32 of ``body`` as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


CHECKS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (ACCESS, lambda m: len(m[0]) >= 18),
    "github": (GITHUB, lambda m: checksum62(m[1]) == m[2]),
    "npm": (NPM, lambda m: checksum62(m[1]) == m[2]),
}


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        _AUTOMATON = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            _AUTOMATON.add_word(word, (kind, len(word)))
        _AUTOMATON.make_automaton()
    return _AUTOMATON


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, by start and then kind."""
    folded = text.lower()
    if len(folded) != len(text):  # a letter whose lower case is longer would shift offsets
        folded = text.translate(_FOLD)
    hits: dict[str, list[int]] = {}
    for end, (kind, size) in _automaton().iter(folded):
        hits.setdefault(kind, []).append(end + 1 - size)
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for kind, starts in hits.items():
        pattern, valid = CHECKS[kind]
        done = 0
        for at in sorted(starts):
            if at >= done and (m := pattern.match(text, at)):
                done = m.end()
                if valid(m):
                    spans.append((at, KINDS.index(kind), done))
    return sorted(spans)


def masked(text: str, mark: str) -> str:
    """``text`` with every secret (overlapping spans together) replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


@F.arrow_udf(SPANS)
def secret_spans(texts: pa.Array) -> pa.Array:
    """Column function: spans (kind, start, end) of a text column."""
    kind, start, end, offsets = [], [], [], [0]
    for text in texts:
        for s, k, e in find_spans(text.as_py()) if text.is_valid else ():
            kind.append(KINDS[k])
            start.append(s)
            end.append(e)
        offsets.append(len(kind))
    rows = pa.StructArray.from_arrays([pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                                      names=["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def mask_secrets(text: Column | str, mark: str = "[secret]") -> Column:
    """Column function: the text with its secrets replaced; null stays null."""
    @F.arrow_udf(T.StringType())
    def mask(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t.as_py(), mark) if t.is_valid else None for t in texts], pa.string())

    return mask(text)


def scan_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` plus the spans of its text column."""
    return docs.withColumn(spans_col, secret_spans(col(text_col)))


def n_spans(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def span_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the given kinds, comma-joined in order."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
