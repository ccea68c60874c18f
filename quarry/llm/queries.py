"""One thin query per operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    collocations,
    language_crf,
    license_scan,
    line_dedup,
    near_dedup,
    onebit,
    packing,
    periodic_runs,
    pieces,
    quality,
    secret_scan,
    token_files,
    topk,
)
from quarry.llm.common import let, words
from quarry.llm.sql import SQL
from quarry.session import scratch_path
from quarry.sources.tables import read_table


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), word_tokenizer())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    return license_scan.scan_licences(docs, "doc_id", path, is_licence_file=F.col("text").rlike(license_scan.MARKERS))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    # The action that writes the files; its result is one row per file.
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), folder, word_tokenizer()) \
        .agg(F.sum("n_tokens")).collect()
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", F.expr("length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs, spans_col="found").select("doc_id", "found")
    base = ("assign", "access", "hex")
    found = found.withColumn("found", F.coalesce("found", F.array().cast(secret_scan.SPANS)))
    return found.select(
        "doc_id",
        *[secret_scan.n_spans(F.col("found"), k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.span_text(F.col("found"), base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("found")).alias("spans"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.quality_cascade(docs, report={k: k for k in base})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", *base, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.coded_digests(read_table(spark, sf_dir, "documents"), piece_model(), ["doc_id"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_crf.fit(language_crf.sample(docs, ~held_out))
    return language_crf.predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, n_lines_col="n_lines", n_dropped_col="n_dropped")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def planted_text(doc_id: Column, text: Column) -> Column:
    """The text; for one document in ten, its words from a on repeat their first p (a and p from the id's crc32)."""
    def planted(w: Column) -> Column:
        n, h = F.size(w).cast("long"), F.crc32(doc_id.cast("string"))
        g = F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    return F.when((F.crc32(doc_id.cast("string")) % 10 == 0) & (F.size(words(text)) > 0), let(words(text), planted)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", planted_text(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(docs, keep=["doc_id"]).withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onebit.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_license_scan": op2_license_scan,
    "op3_exact_topk": op3_exact_topk,
    "op4_token_files": op4_token_files,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_pieces": op8_pieces,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_one_bit_neighbours": op13_one_bit_neighbours,
}

ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
