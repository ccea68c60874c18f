"""Quality rules as a short-circuit cascade ordered by rejection per cost (native).

Every rule has a metric (a Column over the words, the text and the word count)
and a test on it. On a bounded random sample the cost of each metric and the share of
rows its test rejects are measured; rules then run in descending order of
rejection per second, as the branches of one CASE, so a row costs nothing
further once a rule has rejected it. The order never changes the verdict, only
the work.

Defined results: null or empty text has no words (all counts 0) and fails the
word-count rule; repeated rows are judged one by one; extra columns are kept
whatever their names; an empty table gives an empty result (the rules then run
in their declared order).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WHITE, col, fresh, let, words, write_scratch

WINDOW = 8
SYMBOLS = "#*$%&|<>"


def n_symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def n_capitals(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, WHITE, ""))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    return let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def n_repeat_words(hashes: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text.

    ``hashes``: 64-bit hashes of the single words. Window hashes are compared
    through a hash set first; only texts with a repeat pay for the sort that
    finds the repeated windows and the words that they cover.
    """
    starts = F.sequence(F.lit(0), F.size(hashes) - F.lit(size))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))

    def covered(w: Column) -> Column:
        ranked = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(ranked, lambda s: F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                                                  | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        step = let(at, lambda p: F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - x, F.lit(size)))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    found = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    return F.when(F.size(hashes) >= size, found).otherwise(F.lit(0))


def n_stutter(hashes: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(hashes, lambda h, i: F.coalesce(F.get(hashes, i - 1) == h, F.lit(False))))


@dataclass(frozen=True)
class Rule:
    """``metric(text, word_hashes)`` and ``keep(metric, n_words, n_chars)``."""

    name: str
    metric: Callable[[Column, Column], Column]
    keep: Callable[[Column, Column, Column], Column]


RULES = (
    Rule("n_words", lambda text, hashes: F.size(hashes), lambda m, n, chars: m >= 20),
    Rule("word_chars", lambda text, hashes: word_chars(text), lambda m, n, chars: (m >= 2 * n) & (m <= 15 * n)),
    Rule("n_symbols", lambda text, hashes: n_symbols(text), lambda m, n, chars: 100 * m <= 30 * n),
    Rule("n_capitals", lambda text, hashes: n_capitals(text), lambda m, n, chars: 100 * m <= 50 * chars),
    Rule("n_dup_lines", lambda text, hashes: n_dup_lines(text), lambda m, n, chars: 8 * m <= n),
    Rule("n_stutter", lambda text, hashes: n_stutter(hashes), lambda m, n, chars: 100 * m <= 30 * n),
    Rule("n_repeat_words", lambda text, hashes: n_repeat_words(hashes), lambda m, n, chars: 100 * m <= 30 * n),
)


def _prepared(text: Column) -> Column:
    """(text, hashes): the text without null and the hashes of its words."""
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("hashes"))


def judgement(text: Column, rules, report=()) -> Column:
    """Struct of the reported metrics and ``kept``, as one expression.

    The rules are the branches of one CASE, so the first that rejects ends the
    work on a row; a metric in ``report`` is computed for every row. Being one
    expression, it moves as a whole when a filter on it is pushed down.
    """
    def verdict(s: Column, m: Column) -> Column:
        size, chars, out = F.size(s["hashes"]), F.length(s["text"]), F
        for rule in rules:
            value = m[rule.name] if rule.name in report else rule.metric(s["text"], s["hashes"])
            out = out.when(~F.coalesce(rule.keep(value, size, chars), F.lit(False)), F.lit(False))
        return out.otherwise(F.lit(True))

    def body(s: Column) -> Column:
        metrics = F.struct(F.lit(0).alias("none"), *[r.metric(s["text"], s["hashes"]).cast("long").alias(r.name) for r in rules if r.name in report])
        return let(metrics, lambda m: F.struct(*[m[r.name].alias(r.name) for r in rules if r.name in report], verdict(s, m).alias("kept")))

    return let(_prepared(text), body)


def order_rules(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = 500, repeat: int = 8, runs: int = 3) -> list[Rule]:
    """Rules by measured rejection per second on a random sample of about ``sample_rows`` rows (at most twice as many).

    The sample's words are hashed once and stored. A rule's time is the least of ``runs`` jobs that judge every row
    ``repeat`` times, less the time of such a job without a rule, so that what a job itself costs does not count.
    """
    total = docs.count()
    if not total:
        return list(rules)
    drawn = docs.select(col(text_col).alias("text")).sample(min(1.0, sample_rows / total), seed=11).limit(2 * sample_rows)
    base = write_scratch(drawn.select(_prepared(F.col("text")).alias("s")).select("s.text", "s.hashes"), "quality-sample")
    many = base.select("text", "hashes", F.explode(F.sequence(F.lit(1), F.lit(repeat))).alias("turn"))
    text, hashes = F.col("text"), F.col("hashes")

    def timed(rule: Rule | None) -> tuple[float, float]:
        metric = rule.metric(text, hashes) if rule else F.size(hashes)
        keep = rule.keep(F.col("m"), F.size(hashes), F.length(text)) if rule else F.lit(True)
        frame = many.withColumn("m", metric).agg(F.avg(F.when(keep, 0.0).otherwise(1.0)), F.sum("m"))
        share = frame.collect()[0][0]
        took = []
        for _ in range(runs):
            started = time.perf_counter()
            frame.collect()
            took.append(time.perf_counter() - started)
        return min(took), share or 0.0

    floor = timed(None)[0]
    score = {}
    for rule in rules:
        took, share = timed(rule)
        score[rule.name] = share / max(took - floor, 1e-3)
    return sorted(rules, key=lambda r: -score[r.name])


def quality_cascade(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = 500,
                    report: dict[str, str] | None = None, kept_col: str = "kept") -> DataFrame:
    """``docs`` plus ``kept_col`` and one column per reported metric.

    ``report``: rule name -> output column. A reported metric is computed for
    every row; the others only for rows that all earlier rules kept.
    """
    report = report or {}
    ordered = order_rules(docs, rules, text_col, sample_rows)
    judged = fresh(docs, "q_judged")[0]
    out = docs.withColumn(judged, judgement(col(text_col), ordered, report))
    drop = {v.lower() for v in [*report.values(), kept_col]}
    return out.select(*[col(c) for c in docs.columns if c.lower() not in drop], *[col(judged)[k].alias(v) for k, v in report.items()],
                      col(judged)["kept"].alias(kept_col))


def keep_good(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the cascade keeps, with their own columns."""
    ordered = order_rules(docs, options.pop("rules", RULES), text_col, **options)
    return docs.filter(judgement(col(text_col), ordered)["kept"])
