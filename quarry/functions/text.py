"""Column-level text helpers: language sections, label/value lines, tokens.

Everything here is a built-in Spark expression (regex, split, higher-order
array functions), so it stays inside whole-stage code generation and works row
by row without a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Languages that manuals are printed in. Any two letters would not do: "[mm]", "[kg]" and "[ok]" are text.
LANGUAGES = ("ar bg bs cs da de el en es et fa fi fr he hi hr hu id is it ja kk ko lt lv mk ms nb nl nn no pl pt ro ru sk sl sq sr sv th "
             "tr uk vi zh").split()
# A section marker is a line holding only a language tag such as "[en]", "[EN]" or "[de-CH]".
CODE = r"(?i:" + "|".join(LANGUAGES) + r")(?:-[A-Za-z]{2})?"


def unix_lines(text: Column) -> Column:
    """CRLF line ends as LF, so that every line rule sees one kind of line end."""
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def _marker_line(markers: str) -> str:
    return r"\[(?:" + markers + r")\][ \t]*"


def _has_marker(text: Column, markers: str) -> Column:
    return text.rlike(r"(?md)^" + _marker_line(markers) + r"$")


def section_structs(text: Column, markers: str = CODE) -> Column:
    """All tagged sections of a text, in order, as array<struct<lang, text>>, from one regex pass.

    One group spans "code][blanks]" and the body with its leading line end. A code holds no ']' and
    no newline, so the code is what precedes the first ']' and the body is what follows the first
    newline of each match; a marker that is followed by another marker or the end has the body ''.
    """
    end = r"(?=\n" + _marker_line(markers) + r"(?:\n|\z)|\z)"
    whole = r"(?s)(?:\A|\n)\[((?:" + markers + r")\][ \t]*(?=\n|\z).*?)" + end
    found = F.regexp_extract_all(unix_lines(text), F.lit(whole), 1)
    return F.transform(found, lambda g: F.struct(
        F.substring_index(g, "]", 1).alias("lang"),
        F.when(F.instr(g, "\n") > 0, F.substr(g, F.instr(g, "\n") + 1)).otherwise("").alias("text")))


def preamble(text: Column, markers: str = CODE) -> Column:
    """Text before the first marker; the whole text when there is none."""
    t = unix_lines(text)
    before = F.regexp_extract(t, r"(?smd)\A(.*?)\n?^" + _marker_line(markers) + r"$", 1)
    return F.when(_has_marker(t, markers), before).otherwise(t)


def section_text(text: Column, code: str = "en", markers: str = CODE) -> Column:
    """What a reader of language ``code`` reads: the text before the first marker and every section
    tagged ``code`` or ``code-XX`` (in any case), joined by newlines; the whole text without markers.
    """
    tag = code.lower()

    def wanted(s: Column) -> Column:
        lang = F.lower(s["lang"])
        return (lang == tag) | lang.startswith(tag + "-")
    bodies = F.transform(F.filter(section_structs(text, markers), wanted), lambda s: s["text"])
    parts = F.filter(F.concat(F.array(preamble(text, markers)), bodies), lambda p: p != "")
    t = unix_lines(text)
    return F.when(_has_marker(t, markers), F.array_join(parts, "\n")).otherwise(t)


# Marks around a label found in a text (control characters, taken out of the text before).
_OPEN, _CLOSE = "\x01", "\x02"
_LINK = r"(?:[ \t]+(?:of|is|are|up to|about|approx\.?|approximately)){0,2}[ \t]+"


def _any_of(labels: list[str]) -> str:
    """One alternation, longest label first, so that overlapping labels go to the longest."""
    return "|".join(re.escape(x).replace("\\ ", r"[ \t]+") for x in sorted(labels, key=lambda x: (-len(x), x)))


def label_values(text: Column, labels: list[str], measured: list[str] = ()) -> Column:
    """array<struct<label, value, cells, prose>> of the declared labels anywhere in a text, in order of appearance.

    One regex pass puts marks around every label occurrence, one split cuts the text there; the rest runs on short
    strings. A label counts

    * at the start of a line or cell, or behind ``; , .``, when a colon, equals sign or bar follows. The value runs
      to the line's end or the next such label ("A: x; B: y"). In a table row ``value`` is the next cell, and
      ``cells`` all cells up to the next label, joined by blanks ("| Max torque | 55 | Nm |" has "55 Nm").
    * one of ``measured`` also within a sentence, when a number follows ("a max torque of 55 Nm"); ``prose`` is true
      and the value begins with the number.

    Labels are given back in lower case with single blanks.
    """
    start = r"(?:^|[;,.|•])[ \t|*•–-]*+"
    pattern = rf"(?im)({start})({_any_of(labels)})(?=[ \t]*[:=|])"
    if measured:
        heads = "".join(sorted({re.escape(x[0].lower()) for x in measured}))
        pattern += rf"|(?<![\p{{L}}\p{{N}}])(?=[{heads}])({_any_of(measured)})(?={_LINK}\d)"
    clean = F.translate(unix_lines(text), _OPEN + _CLOSE, "  ")
    marked = F.regexp_replace(clean, pattern, rf"$1{_OPEN}$2{'$3' if measured else ''}{_CLOSE}")

    def pair(label: Column, body: Column) -> Column:
        bare = F.regexp_replace(body, r"^[ \t]*[:=|][ \t]*", "")
        row = body.rlike(r"^[ \t]*\|")
        prose = ~body.rlike(r"^[ \t]*[:=|]")
        return _let(F.rtrim(bare, F.lit(" \t|")), lambda inner: F.struct(
            label.alias("label"),
            F.when(prose, F.regexp_replace(body, "(?i)^" + _LINK, ""))
            .when(row, F.rtrim(F.substring_index(inner, "|", 1), F.lit(" \t"))).otherwise(inner).alias("value"),
            F.when(row, F.regexp_replace(inner, r"[ \t]*\|[ \t]*", " ")).alias("cells"),
            prose.alias("prose")))

    def cut(piece: Column) -> Column:
        label = F.lower(F.regexp_replace(F.substring_index(piece, _CLOSE, 1), r"[ \t]+", " "))
        line = F.substring_index(F.substring_index(piece, _CLOSE, -1), "\n", 1)
        # What stands before the next label of the same line belongs to neither.
        body = F.when(F.contains(piece, F.lit("\n")), line).otherwise(F.regexp_replace(line, r"[;,.|•][ \t|*•–-]*$", ""))
        return _let(body, lambda x: pair(label, x))

    # With a line end behind the text, only a label on the same line can end a piece without one. The first piece has no label.
    pieces = F.split(F.concat(marked, F.lit("\n")), _OPEN)
    return F.transform(F.slice(pieces, F.lit(2), F.lit(2**30)), cut)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_ws(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (trim() removes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Whitespace-separated words of a text (no empty words)."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def terms(text: Column) -> Column:
    """Lower-cased letter/digit runs: the tokens of the term index and the language rule."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
