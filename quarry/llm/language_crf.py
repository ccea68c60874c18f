"""Language of words and documents by a linear-chain conditional random field.

A text is a chain of words (runs of letters, lower-cased), cut every
``CHAIN`` words. A word's score for a language is the sum of weights of its
letter n-grams (up to four letters; those at the word's start carry a boundary,
so they are prefixes), its suffixes of two and three letters, and its entry in
a lexicon of the most frequent training words. Transition weights between
neighbours are learned with them, on chains spliced from texts of different
languages, so code-switched text is labelled word by word. Forward-backward
gives each word's marginals; a document's language is the one with the greatest
mean marginal and its score is that mean.

Training reads a bounded sample of labelled rows (``per_language`` documents of
each language, ``spans`` stretches from anywhere in each) and runs on the
driver; prediction works on whole texts in tasks, in pieces of about a million
characters, with no shuffle.

Defined results: null text and text without a letter give ``und`` and 0; rows
without a language or an id are never trained on; without any labelled row
every text gives ``und``; ties go to the smaller language name; repeated rows
are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import col
from quarry.llm.shingles import mix
from quarry.llm.tokens import slices

CHAIN = 64
BITS = 17
ORDERS = 4
PIECE = 1 << 20
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
LETTER = np.array([chr(c).isalpha() for c in range(0x10000)], dtype=bool)
FACTOR = np.random.default_rng(29).integers(0, 1 << 63, size=16, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # (2**BITS, languages)
    lexicon: np.ndarray  # sorted word hashes
    lexicon_weights: np.ndarray
    transitions: np.ndarray


@dataclass(frozen=True)
class Features:
    """Words of a run of texts: feature rows by letter, and where each word's letters begin."""

    rows: np.ndarray  # (letters, ORDERS) rows of the weight table
    first: np.ndarray  # letter index at which each word begins
    suffix: np.ndarray  # (words, 2) rows of the weight table
    word: np.ndarray  # word hashes
    start: np.ndarray  # position of each word in the joined text
    size: np.ndarray


def features(text: str) -> Features:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = np.zeros(len(codes), dtype=bool)
    low = codes < 0x10000
    letter[low] = LETTER[codes[low]]
    if not low.all():
        letter[~low] = [chr(c).isalpha() for c in codes[~low].tolist()]
    at = np.flatnonzero(letter)
    if not len(at):
        none = np.empty(0, dtype=np.int64)
        return Features(np.empty((0, ORDERS), np.int64), none, np.empty((0, 2), np.int64), none.astype(np.uint64), none, none)
    c = codes[at].astype(np.uint64)
    begins = np.concatenate(([True], np.diff(at) > 1))
    first = np.flatnonzero(begins)
    size = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, size)
    shift = np.uint64(64 - BITS)
    total = c * FACTOR[0]
    rows = np.empty((len(at), ORDERS), dtype=np.int64)
    prior = np.zeros(len(at), dtype=np.uint64)
    for k in range(ORDERS):
        if k:
            prior[k:] = c[:-k]
            prior[:k] = 0
            total = total + np.where(place >= k, prior, np.uint64(0)) * FACTOR[k]
        rows[:, k] = (mix(total + FACTOR[4 + k]) >> shift).astype(np.int64)
    last = first + size - 1
    two = c[last] * FACTOR[8] + np.where(size > 1, c[last - 1], np.uint64(0)) * FACTOR[9]
    three = two + np.where(size > 2, c[np.maximum(last - 2, 0)], np.uint64(0)) * FACTOR[10]
    suffix = np.stack([(mix(two + FACTOR[11]) >> shift), (mix(three + FACTOR[12]) >> shift)], axis=1).astype(np.int64)
    power = np.cumprod(np.full(int(size.max()), FACTOR[13], dtype=np.uint64), dtype=np.uint64)
    word = mix(np.add.reduceat(c * power[place], first))
    return Features(rows, first, suffix, word, at[first], size)


def emissions(model: Model, f: Features) -> np.ndarray:
    """(words, languages) scores."""
    if not len(f.first):
        return np.empty((0, len(model.languages)))
    letters = model.weights[f.rows[:, 0]]
    for k in range(1, ORDERS):
        letters = letters + model.weights[f.rows[:, k]]
    out = np.add.reduceat(letters, f.first, axis=0).astype(np.float64)
    out += model.weights[f.suffix].sum(axis=1)
    if len(model.lexicon):
        at = np.minimum(np.searchsorted(model.lexicon, f.word), len(model.lexicon) - 1)
        known = model.lexicon[at] == f.word
        out[known] += model.lexicon_weights[at[known]]
    return out


def chains(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of chains of at most CHAIN words, longest first, given each text's word bounds."""
    starts = [np.arange(lo, hi, CHAIN) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    ends = [np.minimum(s + CHAIN, hi) for s, hi in zip(starts, bounds[1:].tolist(), strict=True)]
    start, end = np.concatenate(starts).astype(np.int64), np.concatenate(ends).astype(np.int64)
    order = np.argsort(start - end, kind="stable")
    return start[order], (end - start)[order]


def forward_backward(scores: np.ndarray, transitions: np.ndarray, start: np.ndarray, size: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of all words, and expected transition counts if ``pairs``."""
    n, langs = len(start), scores.shape[1]
    steps = int(size.max(initial=0))
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]  # chains longer than t
    local = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    move = np.exp(transitions - transitions.max())
    alpha, beta = np.empty((steps, n, langs)), np.ones((steps, n, langs))
    for t in range(steps):
        k = live[t]
        a = local[start[:k] + t] if t == 0 else (alpha[t - 1, :k] @ move) * local[start[:k] + t]
        alpha[t, :k] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        k = live[t + 1]
        b = (local[start[:k] + t + 1] * beta[t + 1, :k]) @ move.T
        beta[t, :k] = b / b.sum(axis=1, keepdims=True)
    marginals = np.empty_like(scores)
    expected = np.zeros((langs, langs)) if pairs else None
    for t in range(steps):
        k = live[t]
        m = alpha[t, :k] * beta[t, :k]
        marginals[start[:k] + t] = m / m.sum(axis=1, keepdims=True)
        if pairs and t:
            joint = alpha[t - 1, :k, :, None] * move[None] * (local[start[:k] + t] * beta[t, :k])[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return marginals, expected


def fit(spans: list[tuple[str, str]], lexicon_words: int = 20_000, rounds: int = 40, rate: float = 0.15, decay: float = 1e-4,
        seed: int = 7) -> Model:
    """Weights from (language, text) stretches, by Adam on the likelihood of spliced chains."""
    languages = tuple(sorted({lang for lang, _ in spans}))
    number = {lang: k for k, lang in enumerate(languages)}
    rng = random.Random(seed)
    stretches = []
    for lang, text in sorted(spans):
        found = WORD.findall(text.lower())
        while found:  # chains of one language and of several
            cut = rng.choice((8, 16, CHAIN))
            stretches.append((number[lang], found[:cut]))
            found = found[cut:]
    rng.shuffle(stretches)
    words = [w for _, part in stretches for w in part]
    label = np.array([lang for lang, part in stretches for _ in part], dtype=np.int64)
    if not words:
        none = np.empty(0, dtype=np.uint64)
        return Model((), np.zeros((1 << BITS, 0), np.float32), none, np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    f = features(" ".join(words))
    if len(f.first) != len(label):
        keep = [any(c.isalpha() for c in w) and len(WORD.findall(w)) == 1 and features(w).first.size == 1 for w in words]
        label, f = label[keep], features(" ".join(w for w, k in zip(words, keep, strict=True) if k))
    langs, n = len(languages), len(label)
    common = Counter(f.word.tolist()).most_common(lexicon_words)
    lexicon = np.sort(np.array([h for h, c in common if c > 2], dtype=np.uint64))
    spot = np.minimum(np.searchsorted(lexicon, f.word), max(len(lexicon) - 1, 0))
    known = lexicon[spot] == f.word if len(lexicon) else np.zeros(n, dtype=bool)
    start, size = chains(np.array([0, n]))
    gold = np.zeros((n, langs))
    gold[np.arange(n), label] = 1.0
    inner = np.ones(n, dtype=bool)
    inner[start] = False
    seen = np.zeros((langs, langs))
    np.add.at(seen, (label[np.flatnonzero(inner) - 1], label[inner]), 1.0)
    params = [np.zeros((1 << BITS, langs)), np.zeros((len(lexicon), langs)), np.zeros((langs, langs))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    per_letter = np.repeat(np.arange(n), np.diff(f.first, append=len(f.rows)))
    for turn in range(1, rounds + 1):
        model = Model(languages, params[0], lexicon, params[1], params[2])
        marginals, expected = forward_backward(emissions(model, f), params[2], start, size, pairs=True)
        gap = (marginals - gold) / n
        grads = [np.empty_like(params[0]), np.empty_like(params[1]), (expected - seen) / n]
        for k in range(langs):
            grads[0][:, k] = sum(np.bincount(f.rows[:, o], weights=gap[per_letter, k], minlength=1 << BITS) for o in range(ORDERS))
            grads[0][:, k] += np.bincount(f.suffix.ravel(), weights=np.repeat(gap[:, k], 2), minlength=1 << BITS)
            grads[1][:, k] = np.bincount(spot[known], weights=gap[known, k], minlength=len(lexicon))[:len(lexicon)]
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g += decay * p / max(n, 1)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return Model(languages, params[0].astype(np.float32), lexicon, params[1].astype(np.float32), params[2])


def sample(docs: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_language: int = 200, spans: int = 2, span_chars: int = 400) -> list[tuple[str, str]]:
    """At most ``per_language`` x ``spans`` stretches of text per language, from anywhere in whole texts."""
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).alias("text"), col(lang_col).alias("lang"), trainable.alias("t")) \
        .filter("t AND id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").drop("t")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    rates = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1_000_000, 1_300_000 * per_language // n + 1))])
    draw = F.xxhash64(F.lit("sample"), "id")
    picked = rows.filter(F.pmod(draw, F.lit(1_000_000)) < F.element_at(rates, F.col("lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, text, lang in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                rng = random.Random(name)
                for k in range(spans):
                    at = rng.randrange(max(1, len(text) - span_chars + 1))
                    out.append((f"{name}/{k}", lang, text[at:at + span_chars]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(3)], names=["id", "lang", "text"])

    stretches = picked.select("id", "text", "lang").mapInArrow(cut, "id string, lang string, text string")
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("sample"), "id"), "id")  # at most 1.3 times the bound per language
    kept = stretches.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_language * spans)
    return [(r["lang"], r["text"]) for r in kept.select("lang", "text").collect()]


def _word_marginals(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, Features]:
    """Marginals of all words, the words' bounds per text, and the features of the joined texts."""
    lowered = [t.lower() for t in texts]
    f = features("\n".join(lowered))
    at = np.cumsum([0] + [len(t) + 1 for t in lowered])
    bounds = np.searchsorted(f.start, at)
    if not len(f.start):
        return np.empty((0, len(model.languages))), bounds, f
    return forward_backward(emissions(model, f), model.transitions, *chains(bounds))[0], bounds, f


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """(id, language, score) per row."""
    names = [*model.languages, UNKNOWN]
    handle = docs.sparkSession.sparkContext.broadcast(model)  # bounded: 2**BITS rows and the lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = handle.value
        for batch in batches:
            texts = batch.column(1)
            sums, counts = np.zeros((batch.num_rows, len(own.languages))), np.zeros(batch.num_rows)

            def add(part: list[str], rows: list[int]) -> None:
                marginals, bounds, _ = _word_marginals(own, part)
                total = np.concatenate((np.zeros((1, marginals.shape[1])), np.cumsum(marginals, axis=0)))
                np.add.at(sums, rows, total[bounds[1:]] - total[bounds[:-1]])
                np.add.at(counts, rows, np.diff(bounds))

            part, rows, held = [], [], 0
            for k in range(batch.num_rows if own.languages else 0):
                for piece in slices(texts[k].as_py() or "", PIECE):
                    part.append(piece)
                    rows.append(k)
                    held += len(piece)
                    if held >= PIECE:
                        add(part, rows)
                        part, rows, held = [], [], 0
            if part:
                add(part, rows)
            mean = sums / np.maximum(counts, 1)[:, None]
            best = mean.argmax(axis=1) if own.languages else np.zeros(batch.num_rows, dtype=np.int64)
            score = np.clip(mean.max(axis=1, initial=0.0), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([names[b] if c else UNKNOWN for b, c in zip(best.tolist(), counts.tolist(), strict=True)], pa.string()),
                 pa.array(np.where(counts > 0, score, 0.0))], names=[id_col, lang_col, score_col])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(lang_col, T.StringType()),
                           T.StructField(score_col, T.DoubleType())])
    return docs.select(col(id_col).alias(id_col), col(text_col).alias("text")).mapInArrow(run, schema)


def tag_words(text: str, model: Model) -> list[tuple[int, int, str, float]]:
    """(start, end, language, marginal) of each word of one text, in its lower case."""
    marginals, _, f = _word_marginals(model, [text])
    best = marginals.argmax(axis=1)
    return [(int(s), int(s + n), model.languages[b], float(marginals[k, b]))
            for k, (s, n, b) in enumerate(zip(f.start, f.size, best, strict=True))]
