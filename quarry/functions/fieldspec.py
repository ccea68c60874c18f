"""Declarative field extraction: a list of FieldSpec compiled into one projection.

Each field of the declared schema becomes a rule: which labels name it
(synonyms), what the value looks like, and how to reduce it (first match,
all matches, range max/min, preferred part, unit conversion). The compiled
Columns read one shared array of labels and values, so the text is scanned
once per row whatever the number of fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"                 # "string" | "number" (JSON schema types)
    labels: tuple[str, ...] = ()         # label alternatives (synonyms), matched case-insensitively
    value: str = r"(.+)"                 # regex for the value part; group 1 is kept
    pick: str = "first"                  # "first" (primary) | "list" (all distinct, ", "-joined)
    prefer: str | None = None            # word of the wanted part: "hard" of "soft/hard: a/b" or "hard/soft: a/b"
    range: str | None = None             # "max" | "min" of "a-b"; None keeps the number as is
    units: tuple[tuple[str, float], ...] = ()   # (unit word, factor to the target unit)
    round_to: int | None = None


def plain_number(value: Column) -> Column:
    """Any dash as '-', no separator between groups of thousands ("0–1,800" -> "0-1800"), a decimal comma as a point ("0,125" -> "0.125")."""
    dashes = F.regexp_replace(value, "[‐-―−]", "-")
    whole = F.regexp_replace(dashes, r"(?<=(?<![\d.,])[1-9]\d{0,2}(?:,\d{3}){0,4}),(?=\d{3}(?!\d))", "")
    return F.regexp_replace(whole, r"(?<=\d),(?=\d+(?![\d,.]))", ".")


def declared_labels(specs: list[FieldSpec]) -> tuple[list[str], list[str]]:
    """All labels, and those of number fields, which are also read within sentences."""
    return [x for s in specs for x in s.labels], [x for s in specs if s.type == "number" for x in s.labels]


def _candidates(pairs: Column, spec: FieldSpec) -> Column:
    wanted = [lbl.lower() for lbl in spec.labels]
    anchored = "^(?:" + spec.value + ")$"

    def preferred(match: Column, p: Column) -> Column:
        if not spec.prefer:
            return match
        parts = F.split(match, "/")
        return F.when(p["label"].contains(spec.prefer + "/"), F.get(parts, F.lit(0))).otherwise(F.element_at(parts, -1))

    def plain(value: Column) -> Column:
        return plain_number(value) if spec.type == "number" else value

    def labelled(p: Column) -> Column:
        # A number may have its unit in the next cell; a text is the next cell.
        value = F.regexp_extract(plain(p["value"]), anchored, 1)
        if spec.type == "number":
            value = F.coalesce(F.nullif(value, F.lit("")), F.regexp_extract(plain(p["cells"]), anchored, 1), F.lit(""))
        return F.coalesce(F.nullif(preferred(value, p), F.lit("")), F.nullif(p["value"], F.lit("")))

    found = F.transform(F.filter(pairs, lambda p: p["label"].isin(wanted) & ~p["prose"]), labelled)
    if spec.type != "number":
        return found

    def told(p: Column) -> Column:
        match = F.regexp_extract(plain(p["value"]), "^(?:" + spec.value + r")(?![\p{L}\p{N}])", 1)
        return F.nullif(preferred(match, p), F.lit(""))

    # Labelled values go before those of sentences.
    prose = F.transform(F.filter(pairs, lambda p: p["label"].isin(wanted) & p["prose"]), told)
    return F.concat(found, F.filter(prose, lambda v: v.isNotNull()))


def raw_value(pairs: Column, spec: FieldSpec) -> Column:
    """The matched value text (first match, or the joined list); NULL when absent."""
    cands = _candidates(pairs, spec)
    if spec.pick == "list":
        return F.nullif(F.array_join(F.array_distinct(cands), ", "), F.lit(""))
    return F.get(cands, 0)


def unit_factor(raw: Column, spec: FieldSpec) -> Column:
    """Factor to the target unit named by the raw text's unit word (1.0 when none)."""
    factor = F.lit(1.0)
    if spec.units:
        alts = "|".join(u for u, _ in spec.units)
        unit = F.lower(F.regexp_extract(raw, r"(?i)(?:^|[\s\d])(" + alts + r")\.?$", 1))
        for u, f in reversed(spec.units):
            factor = F.when(unit == u.lower(), F.lit(float(f))).otherwise(factor)
    return factor


def number_text(raw: Column, spec: FieldSpec) -> Column:
    """The numeric part of a raw value: unit word removed."""
    txt = raw
    if spec.units:
        alts = "|".join(u for u, _ in spec.units)
        txt = F.regexp_replace(txt, r"(?i)\s*(?:" + alts + r")\.?$", "")
    return F.trim(txt)


_NUM = r"\d+(?:\.\d+)?|\.\d+"
_PLAIN = r"^[+-]?(?:" + _NUM + r")(?:[eE][+-]?\d+)?$"
_RANGE = r"^\s*(?:" + _NUM + r")(?:\s*-\s*(?:" + _NUM + r"))*\s*$"


def number_value(txt: Column, factor: Column, spec: FieldSpec) -> Column:
    """Parse the numeric text into a double following the spec's policies; NULL if it is not a number."""
    if spec.range in ("max", "min"):
        parts = F.transform(F.split(txt, r"\s*-\s*"), lambda x: x.try_cast("double"))
        reduced = F.array_max(parts) if spec.range == "max" else F.array_min(parts)
        num = F.when(txt.rlike(_RANGE), reduced)
    else:
        num = F.when(txt.rlike(_PLAIN), txt.try_cast("double"))  # a cast alone takes type suffixes ("18D")
    num = num * factor
    if spec.round_to is not None:
        num = F.round(num, spec.round_to)
    return num


def _staged(df, pairs_col: str, specs: list[FieldSpec]):
    """Add helper columns stage by stage so each costly value is computed once per row.

    Returns the frame and, per field, the Column holding its typed value (string or double)
    and the Column holding its raw text.
    """
    raw = {s.name: f"__r{i}" for i, s in enumerate(specs)}
    df = df.select("*", *[raw_value(F.col(pairs_col), s).alias(raw[s.name]) for s in specs])
    nums = [s for s in specs if s.type == "number"]
    txt = {s.name: f"__t{i}" for i, s in enumerate(specs)}
    fac = {s.name: f"__f{i}" for i, s in enumerate(specs)}
    num = {s.name: f"__n{i}" for i, s in enumerate(specs)}
    if nums:
        df = df.select("*", *[c for s in nums for c in (
            number_text(F.col(raw[s.name]), s).alias(txt[s.name]),
            unit_factor(F.col(raw[s.name]), s).alias(fac[s.name]))])
        df = df.select("*", *[number_value(F.col(txt[s.name]), F.col(fac[s.name]), s).alias(num[s.name])
                              for s in nums])
    typed = {s.name: (F.col(num[s.name]) if s.type == "number" else F.col(raw[s.name])) for s in specs}
    rawc = {s.name: F.col(raw[s.name]) for s in specs}
    helpers = list(raw.values()) + ([txt[s.name] for s in nums] + [fac[s.name] for s in nums]
                                    + [num[s.name] for s in nums])
    return df, typed, rawc, helpers


def with_response(df, pairs_col: str, specs: list[FieldSpec], out: str, root: str = "response"):
    """Add ``out`` = variant ``{root: {field: value}}``: typed numbers, raw text when not a number."""
    df, typed, rawc, helpers = _staged(df, pairs_col, specs)
    args = []
    for s in specs:
        v = typed[s.name].cast("variant")
        if s.type == "number":
            v = F.when(typed[s.name].isNotNull(), v).otherwise(rawc[s.name].cast("variant"))
        args += [F.lit(s.name), v]
    out_col = F.to_variant_object(F.named_struct(F.lit(root), F.named_struct(*args)))
    return df.withColumn(out, out_col).drop(*helpers)


def with_typed(df, pairs_col: str, specs: list[FieldSpec]):
    """Add one typed column per field (string or double), without the variant round trip."""
    df, typed, _, helpers = _staged(df, pairs_col, specs)
    return df.select("*", *[typed[s.name].alias(s.name) for s in specs]).drop(*helpers)
