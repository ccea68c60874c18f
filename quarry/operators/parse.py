"""Document segmentation (D1-D4): text and markup tables -> element rows / document values.

All per-row: regex, split and higher-order array functions. Rows only multiply
where the output itself is one row per element; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import posexplode_rows
from quarry.operators.partitioning import spread

# Element classification rules of a text line (applied to the trimmed line, in order).
HEADING_MD = r"^#{1,6}\s+\S"
LIST_ITEM = r"^([-*•]|\d+[.)])\s+\S"
TABLE_ROW = r"\|.*\|"
TERMINAL_PUNCT = r"[.!?:;,]$"
SHORT_HEADING_MAX = 60

_WS_EDGES = r"^\s+|\s+$"


def strip_line(c: Column) -> Column:
    return F.regexp_replace(c, _WS_EDGES, "")


def classify_line(t: Column) -> Column:
    """Element type of a trimmed line: heading, list_item, table_row or paragraph."""
    return (F.when(t.rlike(HEADING_MD), F.lit("heading"))
            .when(t.rlike(LIST_ITEM), F.lit("list_item"))
            .when(t.rlike(TABLE_ROW), F.lit("table_row"))
            .when((F.length(t) <= SHORT_HEADING_MAX) & ~t.rlike(TERMINAL_PUNCT), F.lit("heading"))
            .otherwise(F.lit("paragraph")))


def _elements(text: Column) -> Column:
    """array<struct<pos int, type string, text string>> of the non-blank lines of a text."""
    lines = F.split(text, "\n")
    items = F.transform(lines, lambda ln, i: F.struct(i.alias("pos"), strip_line(ln).alias("text")))
    kept = F.filter(items, lambda e: e["text"] != "")
    return F.transform(kept, lambda e: F.struct(e["pos"].alias("pos"), classify_line(e["text"]).alias("type"),
                                                e["text"].alias("text")))


def segment_text(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row per element: (key, pos, type, text)."""
    return spread(df).select(key, F.explode(_elements(F.col(text_col))).alias("e")) \
        .select(key, "e.pos", "e.type", "e.text")


# Markup segmentation patterns.
MARKUP_DROP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
MARKUP_ELEMENT = r"(?is)<(?:title|h1|p|li)(?:\s[^>]*)?>.*?</(?:title|h1|p|li)\s*>"
MARKUP_TAG = r"(?is)^<([a-z0-9]+)"
MARKUP_INNER = r"(?is)^<[^>]*>(.*)</[^>]*>$"
ANY_TAG = r"<[^>]*>"


def segment_markup(df: DataFrame, key: str, html_col: str) -> DataFrame:
    """Title, h1, p and li elements with tags stripped; script, style and comments removed first."""
    clean = F.regexp_replace(F.col(html_col), MARKUP_DROP, "")
    elems = F.regexp_extract_all(clean, F.lit(MARKUP_ELEMENT), 0)

    def element(el, i):
        inner = F.regexp_extract(el, MARKUP_INNER, 1)
        text = strip_line(F.regexp_replace(F.regexp_replace(inner, ANY_TAG, " "), r"\s+", " "))
        return F.struct(i.alias("pos"), F.lower(F.regexp_extract(el, MARKUP_TAG, 1)).alias("tag"), text.alias("text"))
    # Empty elements are dropped inside the array (positions keep their gaps), so each text is built once.
    kept = F.filter(F.transform(elems, element), lambda e: e["text"] != "")
    return spread(df).select(key, F.explode(kept).alias("__e")).select(key, "__e.pos", "__e.tag", "__e.text")


# Pipe tables: a block starts on a line that (trimmed) begins and ends with a bar and
# continues while lines begin with a bar. A separator line holds only bars, blanks, '-' and ':'.
# The last group is possessive: it runs as a loop, where a backtracking one takes stack per line.
PIPE_BLOCK = r"(?m)^[ \t]*\|(?:[^\n]*\|)?[ \t]*$(?:\n[ \t]*\|[^\n]*)*+"
PIPE_SEPARATOR = r"^\|[\s\-:|]+\|$"


def _cells(row: Column) -> Column:
    parts = F.split(row, r"\|", -1)
    n = F.size(parts)
    return F.when(n > 2, F.transform(F.slice(parts, 2, n - 2), lambda c: F.trim(c))) \
        .otherwise(F.array().cast("array<string>"))


def pipe_tables(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """D3: (key, block, row, col, header, value) of every pipe table in a text."""
    text = F.replace(F.col(text_col), F.lit("\r\n"), F.lit("\n"))
    blocks = F.regexp_extract_all(text, F.lit(PIPE_BLOCK), 0)
    b = spread(df).select(key, F.posexplode(blocks).alias("block", "__b"))
    lines = F.transform(F.split("__b", "\n"), lambda ln: strip_line(ln))
    b = b.select(key, "block", lines.alias("__l"))
    sep_pos = F.array_min(F.filter(F.transform("__l", lambda ln, i: F.when(ln.rlike(PIPE_SEPARATOR), i)),
                                   lambda x: x.isNotNull()))
    start = F.coalesce(sep_pos + 1, F.lit(1))
    body = F.filter(F.slice("__l", start + 1, F.size("__l")), lambda ln: ~ln.rlike(PIPE_SEPARATOR))
    b = b.select(key, "block", _cells(F.col("__l")[0]).alias("__h"),
                 F.when(F.size("__l") > start, body).otherwise(F.array().cast("array<string>")).alias("__body"))
    r = posexplode_rows(b, [key, "block", "__h"], "__body", "row", "__r")
    c = r.select(key, "block", "row", "__h", F.posexplode(_cells(F.col("__r"))).alias("col", "value"))
    return c.select(key, "block", "row", "col", F.get(F.col("__h"), F.col("col")).alias("header"), "value")


def to_document(df: DataFrame, key: str, text_col: str, keep: list[str] = ()) -> DataFrame:
    """``parsed`` = variant {"document": {"elements": [...]}} and ``document`` = its JSON text."""
    doc = F.named_struct(F.lit("elements"), _elements(F.col(text_col)))
    d = spread(df).select(key, *keep, doc.alias("__d"))
    return d.select(key, *keep,
                    F.to_variant_object(F.named_struct(F.lit("document"), F.col("__d"))).alias("parsed"),
                    F.to_json("__d").alias("document"))


def document_text(parsed: Column) -> Column:
    """Element texts of a parsed value joined by newlines (what extraction reads)."""
    els = F.try_variant_get(parsed, "$.document.elements", "array<struct<text: string>>")
    return F.array_join(F.transform(els, lambda e: e["text"]), "\n")
