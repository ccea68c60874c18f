"""Phrase mining, periodic runs and one-bit neighbours against brute force and hostile rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.llm import collocations, onebit, periodic_runs
from quarry.llm.queries import QUERIES
from tests.conftest import SMALL

LONG = "alpha beta gamma delta. " * 20_000
ROWS = [
    (1, None, "en", "x", 1), (2, "", "en", "x", 2), (3, " \n\t ", None, None, 3), (4, "one two", "en", "x", None), (None, "a lone line", "en", "x", 5),
    (6, LONG, "fr", "x", 6), (7, "Same line, same LINE.\nsame line!", None, "x", 7), (8, "same line same line", "en", "x", 8),
    (8, "same line same line", "en", "x", 8), (9, "ü größe \x0b" * 12, "de", "x", 9),
]
SCHEMA = "doc_id long, text string, lang string, runs string, f long"


@pytest.fixture(scope="module")
def hostile(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


# --- phrases ---

def plain_phrases(rows, min_count, max_words=4):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    return n, {(k, p): c for k, x in f.items() for p, c in x.items() if c >= min_count}


def plain_collocations(rows, min_count, top=2000):
    n, f = plain_phrases(rows, min_count)
    covered = set()
    for (lang, p), c in f.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                if 100 * c >= 80 * f[lang, p[i:i + size]]:
                    covered.add((lang, p[i:i + size]))
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and (lang, p) not in covered:
            score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, rank, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
            for lang, v in out.items() for rank, x in enumerate(sorted(v)[:top], 1)}


@pytest.mark.parametrize("shards", [1, 5])
def test_collocations_match_plain_counting(spark, shards):
    rows = duckdb.sql(f"SELECT doc_id, text, CASE WHEN doc_id % 7 > 0 THEN lang END FROM '{SMALL}/documents.parquet'").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(docs, min_count=9, top=300, shards=shards).collect()}
    assert got == plain_collocations([(x[2], x[1]) for x in rows], 9, 300)


def test_collocations_of_hostile_rows(spark, hostile):
    got = {tuple(r) for r in collocations.collocations(hostile, min_count=2).collect()}
    assert got == plain_collocations([(r[2], r[1]) for r in ROWS], 2)
    assert ("en", "same line") in {(r[0], r[2]) for r in got}
    assert collocations.collocations(hostile.limit(0)).collect() == []


def test_collocation_parts_are_exact_beyond_64_bits(spark):
    a = 2**62
    score = spark.sql(f"SELECT (CAST(2000000 AS DECIMAL(10,0)) * CAST({a}L AS DECIMAL(28,0))) div (CAST({a}L AS DECIMAL(28,0)) + CAST({a + 1}L AS DECIMAL(28,0))) AS s")
    assert score.first().s == 2_000_000 * a // (2 * a + 1)


def test_a_small_bit_table_changes_no_phrase(spark, hostile, monkeypatch):
    want = {tuple(r) for r in collocations.collocations(hostile, min_count=2).collect()}
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    assert {tuple(r) for r in collocations.collocations(hostile, min_count=2).collect()} == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_phrases_and_their_parts_are_not_broadcast(spark, hostile, adaptive):
    """Cuts and copies of the parts are many times their files, by which Spark would broadcast them; the totals are a row per language."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        found = collocations.collocations(hostile, min_count=2)
        got = {tuple(r) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    joins = re.findall(r"(\w+)Join(?:\(skew=true\))? \[lang#\d+, part#\d+, salt#\d+L?\]", plan)
    assert joins and set(joins) == {"SortMerge"}
    assert got == plain_collocations([(r[2], r[1]) for r in ROWS], 2)


# --- runs ---

def plain_runs(w, least=24, repeats=3):
    out = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in out.items())


def test_runs_match_brute_force():
    rng = random.Random(11)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, v = rng.choice([0, 1, 10, 30, 60, 200, 500, 900]), rng.choice([1, 2, 3, 5, 50])
            w = [rng.randrange(v) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n else 0):
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                if rng.random() < 0.5:  # blocks that are periodic themselves
                    inner = rng.randint(1, max(1, p // 3))
                    for i in range(a + inner, min(a + p - 1, n)):
                        w[i] = w[i - inner]
                for i in range(a + p, a + rng.randint(0, n - a)):
                    w[i] = w[i - p]
            texts += [w] * rng.choice([1, 1, 3])  # copies side by side are no runs
        code, text = np.array([x for t in texts for x in t], dtype=np.int64), np.array([k for k, t in enumerate(texts) for _ in t], dtype=np.int64)
        for least, repeats in ((24, 3), (60, 4)):
            want = [(k, *r) for k, t in enumerate(texts) for r in plain_runs(t, least, repeats)]
            assert [tuple(r) for r in periodic_runs.find_word_runs(code, text, least, repeats).tolist()] == want


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_run_query_matches_brute_force(spark):
    want = {}
    for doc_id, text in duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet'").fetchall():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        want[doc_id] = plain_row(words)
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert got == want
    assert sum(x[0] > 0 for x in got.values()) > 10


def test_runs_of_hostile_rows(spark, hostile):
    rows = periodic_runs.find_runs(hostile).collect()
    assert sorted(rows[0].asDict()) == ["collapsed", "doc_id", "f", "lang", "runs", "text"]
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].runs == by[2].runs == by[3].runs == [] and by[1].collapsed == by[2].collapsed == by[3].collapsed == ""
    assert [tuple(r) for r in by[6].runs] == [(0, 80_000, 4)] and by[6].collapsed == "alpha beta gamma delta."
    assert [tuple(r) for r in by[9].runs] == [] and by[9].collapsed == " ".join(["ü größe"] * 12)
    assert sum(r.doc_id == 8 for r in rows) == 2 and by[None].collapsed == "a lone line"
    assert periodic_runs.find_runs(hostile.limit(0)).collect() == []


def test_strongest_run_compares_exactly(spark):
    df = spark.createDataFrame([([(0, 24, 5), (9, 48, 10), (3, 48, 10)], [])], StructType([StructField(c, periodic_runs.RUNS) for c in ("runs", "none")]))
    best, none = df.select(periodic_runs.strongest(F.col("runs")), periodic_runs.strongest(F.col("none"))).first()
    assert tuple(best) == (0, 24, 5) and none is None


# --- neighbours ---

def exact_neighbours(ids, x, is_query, k):
    out = {}
    for i in np.flatnonzero(is_query):
        s = x @ x[i]
        others = np.flatnonzero(ids != ids[i])
        out[ids[i]] = others[np.lexsort((ids[others], -s[others]))[:k]]
    return out


def test_neighbours_reach_recall(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in QUERIES["op13_one_bit_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, []).append(r)
    want = exact_neighbours(ids, x, ids % 20 == 0, 20)
    assert got.keys() == want.keys()
    place = {i: k for k, i in enumerate(ids.tolist())}
    hits = 0
    for q, best in want.items():
        found = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21)) and [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(abs(r.score - x[place[q]] @ x[place[r.vec_id]]) < 1e-12 and r.vec_id != q for r in found)
        hits += len({r.vec_id for r in found} & set(ids[best].tolist()))
    assert hits / sum(map(len, want.values())) >= 0.99


def test_few_vectors_are_reranked():
    """The bounds leave out most rows, and hold for nearly all of them."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    centre = np.zeros(64)
    bits, length, own = onebit.encode(x, centre, 7)
    q = x[:50]
    guess, error = onebit.estimate(q, bits, length, own, centre, 7, 1.9)
    true = q @ x.T
    assert bits.shape == (20_000, 8)
    assert (np.abs(guess - true) <= error).mean() > 0.93  # 1.9 standard deviations
    bound = np.sort(true, axis=1)[:, -21]
    assert (guess + error >= bound[:, None]).mean() < 0.15


def test_neighbours_of_hostile_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 2), (20, [0.0, 1.0], 2), (1, [2.0, 0.0], None), (2, [2.0, 0.0], 4), (3, [0.0, 0.0], 5), (4, None, 6),
            (5, [nan, 1.0], 7), (6, [float("inf")], 8), (None, [1.0, 1.0], 9), (7, [0.5], 10), (8, [], 11), (9, [None, 1.0], 12), (40, None, 13)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    got = [tuple(r) for r in onebit.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 1.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert onebit.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
