"""Evaluation of extracted records.

Scorers are Columns evaluated in one projection over all records; only the
metric rows are aggregated. Nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.pyfmt import py_float_str, py_str
from quarry.functions.text import section_text, strip_ws, terms
from quarry.operators.partitioning import sized_broadcast
from quarry.plans.specs import FIELD_NAMES

# Range checks of the format validator, in check order (field, low, high, description).
RANGE_CHECKS: list[tuple[str, float, float, str]] = [
    ("rated_voltage_v", 1, 60, "Voltage should be 1-60V"),
    ("max_torque_nm", 1, 300, "Torque should be 1-300Nm"),
    ("weight_kg", 0.3, 15, "Weight should be 0.3-15kg"),
    ("no_load_speed_low_rpm", 50, 5000, "Low speed should be 50-5000 RPM"),
    ("no_load_speed_high_rpm", 100, 10000, "High speed should be 100-10000 RPM"),
    ("max_drilling_diameter_wood_mm", 5, 100, "Wood drilling should be 5-100mm"),
    ("max_drilling_diameter_steel_mm", 3, 50, "Steel drilling should be 3-50mm"),
]
CHUCK_FIELD = "chuck_capacity_mm"
CHUCK_PATTERN = r"^\d+(\.\d+)?(-\d+(\.\d+)?)?(\s*mm)?$"
SOURCE_PREFIX = 5000


@dataclass
class Scorer:
    """A named per-record score: value Column, rationale Column, aggregations of the value."""
    name: str
    value: Column
    rationale: Column
    aggregations: list[str] = field(default_factory=lambda: ["mean"])


# ---------------------------------------------------------------- records

def eval_join(processed: DataFrame, parsed: DataFrame, prefix: int | None = SOURCE_PREFIX) -> DataFrame:
    """processed ⋈ parsed on file_name (inner). The text is cut *before* the join so less is shuffled.

    Both sides grow with the documents, so neither is broadcast: a catalog of repeated values is far larger than its files.
    """
    src = F.col("document")
    if prefix is not None:
        src = F.left(src, F.lit(prefix))
    right = parsed.select("file_name", F.coalesce(src, F.lit("")).alias("source_text"))
    return processed.join(right.hint("merge"), on="file_name", how="inner")


def render_fields(fields: list[str] = FIELD_NAMES, float_fields: set[str] | None = None) -> Column:
    """'  name: value' lines in field order; missing prints None."""
    float_fields = float_fields if float_fields is not None else _FLOAT_FIELDS
    return F.concat_ws("\n", *[F.concat(F.lit(f"  {f}: "), py_str(F.col(f), f in float_fields)) for f in fields])


_FLOAT_FIELDS = {"rated_voltage_v", "max_torque_nm", "max_drilling_diameter_wood_mm",
                 "max_drilling_diameter_steel_mm", "weight_kg"}


def eval_records(joined: DataFrame, fields: list[str] = FIELD_NAMES) -> DataFrame:
    """One evaluation record per row: inputs{file_name, source_text}, outputs{response, extracted_fields}."""
    return joined.select(
        F.struct("file_name", "source_text").alias("inputs"),
        F.struct(render_fields(fields).alias("response"),
                 F.struct(*[F.col(f) for f in fields]).alias("extracted_fields")).alias("outputs"),
    )


# ---------------------------------------------------------------- scorers (Q1-Q5)

def completeness(fields: list[str] = FIELD_NAMES) -> Scorer:
    """Share of non-null fields rounded to 2 (an empty string counts as filled)."""
    n = len(fields)
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    ratio = filled / F.lit(float(n)) if n else F.lit(0.0)
    value = F.bround(ratio, 2)
    pct = F.bround(ratio * 100, 0).cast("bigint").cast("string")
    rationale = F.format_string(f"%d/{n} fields extracted (%s%%)", filled, pct)
    return Scorer("completeness", value, rationale, ["mean", "min", "max"])


def _format_issues(num: dict[str, Column], raw: dict[str, Column], chuck: Column | None,
                   checks=RANGE_CHECKS, pattern_field: str = CHUCK_FIELD,
                   pattern: str = CHUCK_PATTERN) -> tuple[Column, Column, Column]:
    issues: list[Column] = []
    valid: list[Column] = []
    for f, lo, hi, desc in checks:
        x, r = num[f], raw[f]
        ok = x.isNotNull() & (x >= lo) & (x <= hi) & ~F.isnan(x)
        issues.append(
            F.when(r.isNull(), None)
            .when(x.isNull(), F.concat(F.lit(f + "="), r, F.lit(" is not numeric")))
            .when(~ok, F.concat(F.lit(f + "="), py_float_str(x), F.lit(f" out of range ({desc})"))))
        valid.append(ok.cast("int"))
    if chuck is not None:
        chuck_ok = strip_ws(chuck).rlike("(?U)" + pattern)
        issues.append(F.when(chuck.isNotNull() & ~chuck_ok,
                             F.concat(F.lit(pattern_field + "='"), chuck, F.lit("' unexpected format"))))
        valid.append((chuck.isNotNull() & chuck_ok).cast("int"))
    arr = F.array_compact(F.array(*issues))
    n_valid = sum(valid, F.lit(0))
    passed = F.size(arr) == 0
    rationale = F.when(passed, F.format_string("All %d present numeric fields within expected ranges", n_valid)) \
        .otherwise(F.concat(F.lit("Issues found: "), F.array_join(arr, "; ")))
    return passed, rationale, arr


def format_validator(checks=RANGE_CHECKS, pattern_field: str | None = CHUCK_FIELD,
                     pattern: str = CHUCK_PATTERN, name: str = "format_issues") -> Scorer:
    """Range and pattern checks on a typed table (Q2, Q4, Q5); ``checks`` = [(field, low, high, description)]."""
    num = {f: F.col(f).cast("double") for f, *_ in checks}
    raw = {f: F.col(f).cast("string") for f, *_ in checks}
    chuck = F.col(pattern_field) if pattern_field else None
    passed, rationale, _ = _format_issues(num, raw, chuck, checks, pattern_field or "", pattern)
    return Scorer(name, passed, rationale, ["mean"])


def format_validator_raw(value_col: str = "ai_result", root: str = "response", checks=RANGE_CHECKS,
                         pattern_field: str | None = CHUCK_FIELD, pattern: str = CHUCK_PATTERN) -> Scorer:
    """The same checks on the raw extraction value, where 'is not numeric' can occur (Q3)."""
    v = F.col(value_col)
    num = {f: F.try_variant_get(v, f"$.{root}.{f}", "double") for f, *_ in checks}
    raw = {f: F.try_variant_get(v, f"$.{root}.{f}", "string") for f, *_ in checks}
    chuck = F.try_variant_get(v, f"$.{root}.{pattern_field}", "string") if pattern_field else None
    passed, rationale, _ = _format_issues(num, raw, chuck, checks, pattern_field or "", pattern)
    return Scorer("format_issues", passed, rationale, ["mean"])


def ranges(bounds: list[tuple[str, float, float, str]], name: str = "ranges") -> Scorer:
    """User range scorer: every present field within [low, high] (inclusive), NULL skipped."""
    return format_validator(bounds, None, name=name)


def pattern(col: str, regex: str, name: str | None = None) -> Scorer:
    """User pattern scorer: the stripped value matches ``regex`` (NULL passes)."""
    c = F.col(col)
    ok = c.isNull() | strip_ws(c).rlike("(?U)" + regex)
    why = F.when(ok, F.lit("ok")).otherwise(F.concat(F.lit(col + "='"), c, F.lit("' unexpected format")))
    return Scorer(name or f"{col}_pattern", ok, why, ["mean"])


# ---------------------------------------------------------------- rule judges (Q6-Q8)

# Short stop-word lists per language (public common-word lists, lower case).
STOPWORDS: dict[str, list[str]] = {
    "en": ["the", "and", "of", "to", "in", "is", "it", "that", "for", "with", "as", "was", "on", "are", "by",
           "this", "be", "from", "or", "an", "at", "which", "have", "not", "but"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den", "von", "mit", "sich", "des",
           "auf", "für", "im", "dem", "auch", "es", "an", "werden", "aus", "er", "sie"],
    "fr": ["le", "la", "les", "et", "est", "un", "une", "des", "du", "de", "dans", "que", "qui", "pour", "pas",
           "sur", "au", "avec", "il", "elle", "ce", "ne", "se", "par", "sont"],
    "es": ["el", "la", "los", "las", "y", "es", "un", "una", "de", "del", "en", "que", "por", "con", "para",
           "no", "se", "al", "lo", "como", "su", "pero", "sus", "le", "son"],
}
LANGS = ["en", "de", "fr", "es"]


def stopword_hits(text: Column | None = None, tokens: Column | None = None) -> dict[str, Column]:
    """Per language: number of tokens of the text in that language's stop-word list.

    Pass ``tokens`` (a column already holding ``terms(text)``) to tokenize once: the
    language guess repeats these counts inside conditional branches, where common
    subexpression elimination does not reach, so an inline tokenizer would run many times.
    """
    toks = tokens if tokens is not None else terms(text)
    return {lang: F.size(F.filter(toks, _member_of(STOPWORDS[lang]))) for lang in LANGS}


def _member_of(words: list[str]):
    return lambda w: w.isin(words)


def guess_language(hits: dict[str, Column]) -> Column:
    """Language with most stop-word hits; ties go to the earlier of en, de, fr, es; none -> NULL."""
    best = F.greatest(*hits.values())
    out = F.lit(None).cast("string")
    for lang in reversed(LANGS):
        out = F.when(hits[lang] == best, F.lit(lang)).otherwise(out)
    return F.when(best > 0, out)


# Words of the foreign lists that are English words too, and letters that English text does not use.
ALSO_ENGLISH = ["die", "den", "pour", "par", "no", "son", "con", "lo"]
FOREIGN_LETTERS = ["äöüßñ", r"\p{IsHan}", r"\p{IsHiragana}", r"\p{IsKatakana}", r"\p{IsHangul}", r"\p{IsCyrillic}",
                   r"\p{IsArabic}", r"\p{IsHebrew}", r"\p{IsThai}"]


def english_compliance(text_fields: list[str] = ("product_name", "product_type", "chuck_capacity_mm",
                                                 "compatible_batteries", "compatible_chargers")) -> Scorer:
    """Text fields hold no foreign stop word and no letter foreign to English; brand and model are exempt (Q6 as a rule).

    A foreign compound without such a letter ("Akku-Bohrschrauber") needs a lexicon and passes.
    """
    bad = []
    foreign = list(dict.fromkeys(w for lang in LANGS if lang != "en" for w in STOPWORDS[lang]
                                 if w not in STOPWORDS["en"] and w not in ALSO_ENGLISH))
    letters = "[" + "".join(FOREIGN_LETTERS) + "]"
    for f in text_fields:
        text = F.coalesce(F.col(f), F.lit(""))
        bad.append(F.when(F.exists(terms(text), _member_of(foreign)) | F.lower(text).rlike(letters), F.lit(f)))
    arr = F.array_compact(F.array(*bad))
    passed = F.size(arr) == 0
    rationale = F.when(passed, F.lit("All text fields are English")) \
        .otherwise(F.concat(F.lit("Foreign terms in: "), F.array_join(arr, ", ")))
    return Scorer("english_compliance", passed, rationale, ["mean"])


# Guideline vocabularies for the plausibility rules.
KNOWN_TOOL_TYPES = ["drill", "drill/driver", "hammer drill", "impact driver", "rotary hammer", "screwdriver"]
REAL_MAKERS = ["Bosch", "Makita", "DeWalt", "Milwaukee", "Metabo", "Hilti", "Festool", "Ryobi", "BLACK+DECKER",
               "Einhell", "AEG", "HiKOKI", "Stanley", "Craftsman", "Ridgid", "Worx", "Skil", "Kress"]
MODEL_PATTERN = r"^(?=.*[0-9])[A-Za-z0-9][A-Za-z0-9./+\-]*(?: [A-Za-z0-9./+\-]+){0,2}$"


def known_makers(spark, extra: list[str] | None = None) -> DataFrame:
    """Dictionary of known manufacturers (a fixed, small list: safe to broadcast)."""
    names = REAL_MAKERS + list(extra or [])
    return spark.createDataFrame([(n, n.lower()) for n in names], "maker string, maker_key string")


def plausibility(catalog: DataFrame, makers: DataFrame, keys: list[str] = ("file_name",),
                 fmt: Scorer | None = None) -> DataFrame:
    """Extraction-quality rules, wide: known_maker, model_identifier, type_in_list, numbers_plausible (Q7).

    ``fmt`` reuses an already built ``format_validator`` scorer (its Columns are large to build).
    """
    mk = sized_broadcast(makers.select(F.col("maker_key").alias("__mk")).distinct())
    d = catalog.join(mk, F.lower(F.col("manufacturer")) == F.col("__mk"), "left")
    fmt = fmt or format_validator()
    keep = [c for c in catalog.columns] if list(keys) == ["*"] else list(keys)
    return d.select(
        *keep,
        F.col("__mk").isNotNull().alias("known_maker"),
        F.coalesce(F.col("model_number").rlike(MODEL_PATTERN), F.lit(False)).alias("model_identifier"),
        F.coalesce(F.lower(F.col("product_type")).isin(KNOWN_TOOL_TYPES), F.lit(False)).alias("type_in_list"),
        fmt.value.alias("numbers_plausible"),
    )


def _token_text(c: Column) -> Column:
    """Lower-cased letter/digit runs (a point between digits belongs to its number), each between blanks."""
    spaced = F.regexp_replace(F.lower(c), r"(?<!\d)\.|\.(?!\d)|[^\p{L}\p{N}.]+", " ")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(spaced, " +", " ")), F.lit(" "))


def grounding(joined: DataFrame, text_col: str = "source_text",
              fields: list[str] = ("manufacturer", "model_number", "product_name", "product_type",
                                   "rated_voltage_v", "max_torque_nm", "no_load_speed_low_rpm",
                                   "no_load_speed_high_rpm", "chuck_capacity_mm", "max_drilling_diameter_wood_mm",
                                   "max_drilling_diameter_steel_mm", "compatible_batteries", "compatible_chargers"),
              keys: list[str] = ("file_name",), section: str | None = "en") -> DataFrame:
    """Every extracted value occurs in the source text (Q8); unit-converted fields are exempt.

    The whole text that extraction reads (``section``; None: all languages) is searched, on
    token boundaries: "5" is not found in "15". Numbers are looked up without a trailing
    '.0'; list fields item by item.
    """
    text = section_text(F.col(text_col), section) if section else F.col(text_col)
    joined = joined.withColumn("__txt", _token_text(text))
    txt = F.col("__txt")
    missing = []
    for f in fields:
        c = F.col(f)
        s = F.regexp_replace(c.cast("string"), r"\.0$", "") if f in _FLOAT_FIELDS else c.cast("string")
        items = F.split(s, ", ")
        found = F.forall(items, lambda it: F.instr(txt, _token_text(it)) > 0)
        missing.append(F.when(c.isNotNull() & ~found, F.lit(f)))
    arr = F.array_compact(F.array(*missing))
    keep = [c for c in joined.columns if c != "__txt"] if list(keys) == ["*"] else list(keys)
    return joined.select(*keep, (F.size(arr) == 0).alias("grounded"),
                         F.array_join(arr, ", ").alias("ungrounded_fields"))


# ---------------------------------------------------------------- registry and aggregation (Q9, A1-A5)

def score(df: DataFrame, keys: list[str], scorers: list[Scorer]) -> DataFrame:
    """All scorers in one projection, then long form: keys + (scorer, value double, rationale)."""
    wide = df.select(*keys, *[F.struct(F.lit(s.name).alias("scorer"), s.value.cast("double").alias("value"),
                                       s.rationale.alias("rationale")).alias(f"__s{i}") for i, s in enumerate(scorers)])
    structs = [f"__s{i}" for i in range(len(scorers))]
    return wide.select(*keys, F.explode(F.array(*[F.col(c) for c in structs])).alias("__s")) \
        .select(*keys, "__s.scorer", "__s.value", "__s.rationale")


_AGG = {"mean": F.avg, "min": F.min, "max": F.max}


def aggregate_scores(scores: DataFrame, scorers: list[Scorer], group: list[str] = ()) -> DataFrame:
    """Run metrics (metric, value) of stored long scores: one pass with partial aggregation, then long form."""
    values = [F.when(F.col("scorer") == s.name, F.col("value")) for s in scorers]
    return _run_metrics(scores, scorers, values, F.count(F.when(F.col("scorer") == scorers[0].name, 1)), group)


def score_metrics(df: DataFrame, scorers: list[Scorer], group: list[str] = ()) -> DataFrame:
    """Run metrics (metric, value) straight from the records: equals ``aggregate_scores(score(df, ...), ...)``.

    The values are aggregated side by side, one row a record; no row is multiplied and no message is built.
    """
    wide = df.select(*group, *[s.value.cast("double").alias(f"__s{i}") for i, s in enumerate(scorers)])
    return _run_metrics(wide, scorers, [F.col(f"__s{i}") for i in range(len(scorers))], F.count(F.lit(1)), group)


def _run_metrics(df: DataFrame, scorers: list[Scorer], values: list[Column], n_records: Column, group: list[str]) -> DataFrame:
    aggs, names = [], []
    for s, v in zip(scorers, values, strict=True):
        for a in s.aggregations:
            names.append(f"{s.name}/{a}")
            aggs.append(_AGG[a](v).alias(names[-1]))
    wide = df.groupBy(*group).agg(*aggs, n_records.alias("n_records"))
    names.append("n_records")
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value"))
                                for n in names]))
    return wide.select(*group, stack.alias("__m")).select(*group, "__m.metric", "__m.value")


def compare_runs(metrics: DataFrame) -> DataFrame:
    """Change of each metric against the run before (A5): partitioned by metric, so bounded by #runs."""
    w = Window.partitionBy("metric").orderBy("run_ts", "run_id")
    prev = F.lag("value").over(w)
    return metrics.select("run_id", "run_ts", "metric", "value", prev.alias("prev_value"),
                          (F.col("value") - prev).alias("delta"))


def extraction_quality(rule_cols: list[str]) -> Scorer:
    """All plausibility rules hold (Q7 + Q8 as one judge); rationale lists the failed rules."""
    failed = F.array_compact(F.array(*[F.when(~F.col(c), F.lit(c)) for c in rule_cols]))
    passed = F.size(failed) == 0
    rationale = F.when(passed, F.lit("All rules passed")) \
        .otherwise(F.concat(F.lit("Failed: "), F.array_join(failed, ", ")))
    return Scorer("extraction_quality", passed, rationale, ["mean"])
