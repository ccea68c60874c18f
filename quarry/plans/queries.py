"""Named queries: key -> (spark, sf_dir) -> DataFrame.

Each reads the given tables (or tables Spark derived from them in this
session) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import matching as M
from quarry.operators import profiles as PR
from quarry.operators import questions as Q
from quarry.operators.extract import extract_typed
from quarry.operators.flatten import flatten
from quarry.operators.sections import sections
from quarry.plans import catalog
from quarry.plans.specs import FIELD_NAMES, PROCESSED_SCHEMA, spec_subset
from quarry.sources.fixtures import manuals, parsed_manuals
from quarry.sources.tables import append_metrics, enforce_schema, materialize, read_metrics, read_table, write_scratch

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


# Parameters of the fixed questions (the feature: look up / compare given models).
LOOKUP_MODEL = "MDL-000042"
COMPARE_MODELS = ["MDL-000001", "MDL-000002", "MDL-000003", "MDL-000004"]
SPEED_THRESHOLD = 1800
BATTERIES = ["GBA-18"]
VOLTAGE = 18.0
FIXTURE_MAKERS = [f"Brand#{i}" for i in range(1, 21)]
PROFILE_COLS = ["manufacturer", "model_number", "product_name", "product_type", "rated_voltage_v", "max_torque_nm",
                "no_load_speed_low_rpm", "no_load_speed_high_rpm", "weight_kg", "compatible_batteries",
                "compatible_chargers"]
MENTION_SQL = """CASE k % 4
  WHEN 0 THEN upper(p_name)
  WHEN 1 THEN concat(substr(p_name, 1, (k % length(p_name))), substr(p_name, (k % length(p_name)) + 2))
  WHEN 2 THEN concat(substr(p_name, 1, (k % length(p_name))), 'x', substr(p_name, (k % length(p_name)) + 2))
  ELSE concat(p_name, 's') END"""


def _catalog(spark, sf):
    return catalog.manuals_catalog(spark, sf)


def _extracted(spark, sf):
    return materialize(lambda: catalog.manuals_extract(spark, sf), "extract", scope=sf, spark=spark)


def _typed(spark, sf, names):
    m = parsed_manuals(spark, sf)
    out = extract_typed(m, "document", spec_subset(names))
    schema = {f.name: f.dataType for f in PROCESSED_SCHEMA.fields}
    return out.select("file_name", *[F.col(n).try_cast(schema[n]).alias(n) for n in names])


# ------------------------------------------------------------------ extraction (X, P5, P6, D5)

@query
def typed_flatten(spark, sf):
    return catalog.manuals_processed(spark, sf)


@query
def extract_fields(spark, sf):
    return enforce_schema(_typed(spark, sf, FIELD_NAMES), PROCESSED_SCHEMA)


@query
def extract_synonyms(spark, sf):
    return _typed(spark, sf, ["max_torque_nm", "no_load_speed_low_rpm", "no_load_speed_high_rpm",
                              "chuck_capacity_mm", "max_drilling_diameter_wood_mm", "max_drilling_diameter_steel_mm"])


@query
def extract_ranges(spark, sf):
    return _typed(spark, sf, ["no_load_speed_low_rpm", "no_load_speed_high_rpm", "chuck_capacity_mm", "weight_kg"])


@query
def extract_units(spark, sf):
    return _typed(spark, sf, ["weight_kg"])


@query
def extract_preference(spark, sf):
    return _typed(spark, sf, ["max_torque_nm"])


@query
def extract_lists(spark, sf):
    return _typed(spark, sf, ["compatible_batteries", "compatible_chargers"])


@query
def extract_primary(spark, sf):
    return _typed(spark, sf, ["model_number", "rated_voltage_v"])


@query
def cast_rejects(spark, sf):
    flat = flatten(_extracted(spark, sf), "ai_result", PROCESSED_SCHEMA, keys=["file_name"])
    return flat.select("file_name", F.explode("cast_errors").alias("field"))


@query
def english_sections(spark, sf):
    return sections(parsed_manuals(spark, sf), ["file_name"], "document")


# ------------------------------------------------------------------ evaluation

def _joined(spark, sf, prefix=None):
    """Whole source texts; only the records shown to a judge are cut."""
    return EV.eval_join(_catalog(spark, sf), parsed_manuals(spark, sf), prefix)


@query
def eval_join(spark, sf):
    return _joined(spark, sf).select("file_name", "model_number", F.length("source_text").alias("source_chars"))


@query
def labels_join(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return read_table(spark, sf, "labels").join(docs, "doc_id", "inner")


@query
def eval_records(spark, sf):
    rec = EV.eval_records(_joined(spark, sf, EV.SOURCE_PREFIX))
    return rec.select(F.col("inputs.file_name").alias("file_name"), F.col("inputs.source_text").alias("source_text"),
                      F.col("outputs.response").alias("response"))


@query
def completeness(spark, sf):
    s = EV.completeness()
    return _catalog(spark, sf).select("file_name", s.value.alias("value"), s.rationale.alias("rationale"))


@query
def format_check(spark, sf):
    s = EV.format_validator()
    return _catalog(spark, sf).select("file_name", s.value.alias("value"), s.rationale.alias("rationale"))


@query
def format_check_raw(spark, sf):
    s = EV.format_validator_raw()
    return _extracted(spark, sf).select("file_name", s.value.alias("value"), s.rationale.alias("rationale"))


def _makers(spark):
    return EV.known_makers(spark, FIXTURE_MAKERS)


@query
def plausibility(spark, sf):
    return EV.plausibility(_catalog(spark, sf), _makers(spark))


@query
def grounding(spark, sf):
    """Every tenth record names a maker that its text does not hold, every tenth a model cut by one character."""
    j = _joined(spark, sf)
    k = F.substring("file_name", 5, 6).cast("int") % 10
    j = j.withColumn("manufacturer", F.when(k == 3, F.lit("Nobrand")).otherwise(F.col("manufacturer"))) \
        .withColumn("model_number", F.when(k == 7, F.expr("left(model_number, length(model_number) - 1)"))
                    .otherwise(F.col("model_number")))
    return EV.grounding(j)


def _scored(spark, sf):
    """Every tenth record has a model cut by one character, every tenth one that is no identifier."""
    j = _joined(spark, sf)
    k = F.substring("file_name", 5, 6).cast("int") % 10
    j = j.withColumn("model_number", F.when(k == 7, F.expr("left(model_number, length(model_number) - 1)"))
                     .when(k == 5, F.lit("unlisted")).otherwise(F.col("model_number")))
    fmt = EV.format_validator()
    rules = EV.plausibility(j, _makers(spark), keys=["*"], fmt=fmt)
    rules = EV.grounding(rules, keys=["*"])
    quality = EV.extraction_quality(["known_maker", "model_identifier", "type_in_list", "numbers_plausible",
                                     "grounded"])
    scorers = [EV.completeness(), fmt, EV.english_compliance(), quality]
    return rules, scorers


@query
def scores_long(spark, sf):
    rules, scorers = _scored(spark, sf)
    return EV.score(rules, ["file_name"], scorers)


@query
def run_metrics(spark, sf):
    rules, scorers = _scored(spark, sf)
    m = EV.score_metrics(rules, scorers)
    return m.select("metric", F.round("value", 6).alias("value")).orderBy("metric")


@query
def run_compare(spark, sf):
    from quarry.session import scratch_path
    rules, scorers = _scored(spark, sf)
    run = F.concat(F.lit("run-"), (F.substring("file_name", 5, 6).cast("int") % 3).cast("string"))
    m = EV.score_metrics(rules.withColumn("run_id", run), scorers, group=["run_id"])
    # K6: each run's metrics are appended to the metrics table, which the comparison then reads.
    run_ts = F.timestamp_add("DAY", F.substring("run_id", 5, 1).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    path = scratch_path(spark, "metrics")
    append_metrics(m.withColumn("run_ts", run_ts), path, "manuals")
    append_metrics(read_metrics(spark, path, "manuals").filter("run_id = 'run-1'"), path, "manuals")  # a retry replaces its run
    out = EV.compare_runs(read_metrics(spark, path, "manuals"))
    return out.select("run_id", "metric", F.round("value", 6).alias("value"),
                      F.round("prev_value", 6).alias("prev_value"), F.round("delta", 6).alias("delta"))


@query
def dictionary_semi(spark, sf):
    return M.in_dictionary(_catalog(spark, sf), "manufacturer", _makers(spark), "maker", "left_semi") \
        .select("file_name", "manufacturer")


@query
def dictionary_anti(spark, sf):
    return M.in_dictionary(_catalog(spark, sf), "manufacturer", _makers(spark), "maker", "left_anti") \
        .select("file_name", "manufacturer")


# ------------------------------------------------------------------ questions

@query
def top_torque(spark, sf):
    return Q.top_by(_catalog(spark, sf), "max_torque_nm", k=3)


@query
def compare_weight_voltage(spark, sf):
    return Q.compare_by(_catalog(spark, sf), ["weight_kg", "rated_voltage_v"])


@query
def lookup_voltage(spark, sf):
    return Q.lookup(_catalog(spark, sf), LOOKUP_MODEL, ["rated_voltage_v"])


@query
def speed_above(spark, sf):
    return Q.above(_catalog(spark, sf), "no_load_speed_high_rpm", SPEED_THRESHOLD)


@query
def battery_compatible(spark, sf):
    return Q.compatible_with(_catalog(spark, sf), BATTERIES, VOLTAGE)


@query
def fastest_by_maker(spark, sf):
    return Q.best_by_group(_catalog(spark, sf), "manufacturer", "no_load_speed_high_rpm")


@query
def spec_sheet(spark, sf):
    return Q.spec_sheet(_catalog(spark, sf), LOOKUP_MODEL, FIELD_NAMES)


@query
def weight_at_voltage(spark, sf):
    return Q.at_value(_catalog(spark, sf), "rated_voltage_v", VOLTAGE, "weight_kg")


@query
def lightest_battery(spark, sf):
    return Q.lightest(_catalog(spark, sf), "weight_kg", ["compatible_batteries"])


@query
def model_differences(spark, sf):
    return Q.differences(_catalog(spark, sf), COMPARE_MODELS, FIELD_NAMES)


# ------------------------------------------------------------------ matching and profiling (V1-V3)

@query
def entity_dictionary(spark, sf):
    return M.entity_dictionary(_catalog(spark, sf), ["manufacturer", "model_number", "product_type"])


@query
def entity_match(spark, sf):
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_name")
    mentions = part.select(F.expr(MENTION_SQL).alias("mention"))
    return M.entity_match(mentions, "mention", part, "p_name", max_dist=2)


@query
def format_profile(spark, sf):
    return M.format_profile(_catalog(spark, sf), PROFILE_COLS)


@query
def profile_merged(spark, sf):
    """V3, approximate: the catalog profiled in three batches, the stored profiles merged without the batches.

    distinct_close: the merged estimate is within 5 % of the exact count.
    """
    cat = _catalog(spark, sf)
    batch = F.substring("file_name", 5, 6).cast("int") % 3
    stored = write_scratch(PR.profile(cat.withColumn("batch", batch), PROFILE_COLS, by=["batch"]), "profiles")
    merged = PR.read_profile(PR.merge_profiles(stored))
    exact = M.entity_dictionary(cat, PROFILE_COLS).groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return merged.join(exact, "column_name", "left").select(
        "column_name", "n_rows", "null_count", "min_value", "max_value",
        (F.abs(F.col("distinct_estimate") - n) <= 0.05 * n).alias("distinct_close"))


# ------------------------------------------------------------------ parsing
from quarry.operators import parse as P  # noqa: E402
from quarry.operators import retrieval as R  # noqa: E402
from quarry.operators import segments as SG  # noqa: E402
from quarry.session import scratch_path  # noqa: E402
from quarry.sources.fixtures import spec_sheets  # noqa: E402

CHUNK_SIZE, CHUNK_OVERLAP, TOP_K = 200, 50, 3


@query
def segment_text(spark, sf):
    return P.segment_text(read_table(spark, sf, "documents"), "doc_id", "text")


@query
def segment_markup(spark, sf):
    return P.segment_markup(read_table(spark, sf, "pages"), "page_id", "html")


@query
def pipe_tables(spark, sf):
    return P.pipe_tables(spec_sheets(spark, sf), "k", "text")


@query
def parsed_table(spark, sf):
    d = P.to_document(read_table(spark, sf, "documents"), "doc_id", "text")
    els = F.try_variant_get(F.col("parsed"), "$.document.elements", "array<struct<type: string>>")

    def n_of(t):
        return F.size(F.filter(els, lambda e: e["type"] == t)).cast("bigint").alias(f"n_{t}")
    return d.select("doc_id", F.size(els).cast("bigint").alias("n_elements"), n_of("heading"), n_of("list_item"),
                    n_of("table_row"), n_of("paragraph"), F.length(P.document_text(F.col("parsed"))).alias("text_chars"))


# ------------------------------------------------------------------ retrieval

def _chunks(spark, sf):
    docs = read_table(spark, sf, "documents")
    return R.chunk(docs, "doc_id", "text", CHUNK_SIZE, CHUNK_OVERLAP, keep=["lang"])


_INDEXES: dict[tuple[str, str], SG.PassageIndex] = {}


def _index(spark, sf):
    """The retrieval index of all documents as tables; built once per application and folder."""
    memo = (spark.sparkContext.applicationId, sf)
    if memo not in _INDEXES:
        index = SG.PassageIndex(scratch_path(spark, "passage-index"), keep=("lang",), size=CHUNK_SIZE, overlap=CHUNK_OVERLAP)
        SG.sync(read_table(spark, sf, "documents"), index)
        _INDEXES[memo] = index
    return SG.read_index(spark, _INDEXES[memo])


def _passages(spark, sf, prefer=None):
    index = _index(spark, sf)
    return R.search(read_table(spark, sf, "benchmark"), "item_id", "text", index.postings, "doc_id", TOP_K, prefer=prefer,
                    dictionary=index.dictionary, stats=index.stats)


@query
def chunks(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_no", "n_words", "text")


@query
def term_index(spark, sf):
    # Whole chunks are dealt out, which are far smaller than their postings.
    return R.term_index(_chunks(spark, sf).repartition("doc_id", "chunk_no"), "doc_id").select("term", "doc_id", "chunk_no", "tf")


@query
def passages(spark, sf):
    return _passages(spark, sf)


@query
def passages_english(spark, sf):
    return _passages(spark, sf, prefer=("lang", "en"))


@query
def index_sync(spark, sf):
    """The index holds the labelled documents; sync adds every other document as a segment and returns its chunks."""
    docs = read_table(spark, sf, "documents")
    index = SG.PassageIndex(scratch_path(spark, "synced-index"), version=("n_chars",), keep=("lang",), size=CHUNK_SIZE, overlap=CHUNK_OVERLAP)
    SG.sync(docs.join(read_table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi"), index)
    return SG.sync(docs, index).select("doc_id", "chunk_no", "n_words")


# ------------------------------------------------------------------ logs, preview, variant
from quarry.operators import logs as L  # noqa: E402
from quarry.operators import preview as PV  # noqa: E402

# Response shapes written from conversation texts (one per turn % 6); one conversation in eleven nests its message six lists deep.
RESPONSE_SHAPES_SQL = f"""
CASE WHEN conv_id % 11 = 3 THEN concat('{'{"outputs":[{"output":[' * 3}', to_json(named_struct('type', 'message', 'content', text)), '{']}]}' * 3}')
ELSE CASE turn % 6
  WHEN 0 THEN to_json(named_struct('predictions', array(named_struct('type', 'message',
       'content', array(named_struct('type', 'output_text', 'text', text))))))
  WHEN 1 THEN to_json(named_struct('output', array(named_struct('type', 'message', 'content', text))))
  WHEN 2 THEN to_json(named_struct('outputs', array(named_struct('text', text))))
  WHEN 3 THEN to_json(named_struct('choices', array(named_struct('message',
       named_struct('role', 'assistant', 'content', text)))))
  WHEN 4 THEN to_json(named_struct('content', text))
  ELSE to_json(array(named_struct('type', 'message', 'content', array(
       named_struct('type', 'output_text', 'text', '<name>agent-1</name>'),
       named_struct('type', 'text', 'text', text)))))
END END"""


@query
def chat_history(spark, sf):
    h = L.chat_history(read_table(spark, sf, "conversations"))
    transcript = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return h.select("conv_id", "n_messages", transcript.alias("transcript"), "accepted")


@query
def flatten_responses(spark, sf):
    conv = read_table(spark, sf, "conversations")
    logs = conv.select("conv_id", "turn", F.expr(RESPONSE_SHAPES_SQL).alias("response"))
    return L.flatten_responses(logs, "response").select("conv_id", "turn", "content")


# Every response shape that the envelope tells apart, written from conversation texts.
ENVELOPE_SHAPES_SQL = """
CASE (conv_id + turn) % 10
  WHEN 1 THEN to_json(named_struct('output', items)) WHEN 2 THEN to_json(named_struct('outputs', items))
  WHEN 3 THEN to_json(named_struct('predictions', array(named_struct('output', items))))
  WHEN 4 THEN to_json(named_struct('predictions', array(named_struct('output', text))))
  WHEN 5 THEN to_json(named_struct('predictions', array(named_struct('type', 'message', 'content', text))))
  WHEN 6 THEN to_json(named_struct('predictions', array(text)))
  WHEN 7 THEN to_json(named_struct('choices', array(named_struct('message', named_struct('role', 'assistant', 'content', text)))))
  WHEN 8 THEN to_json(named_struct('predictions', array(named_struct('text', text))))
  WHEN 9 THEN to_json(named_struct('content', text))
  ELSE text END"""


@query
def response_envelope(spark, sf):
    items = F.array(F.struct(F.lit("message").alias("type"), F.col("text").alias("content"), F.lit(None).cast("string").alias("text")),
                    F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("content"), F.lit("second").alias("text")))
    logs = read_table(spark, sf, "conversations").withColumn("items", items) \
        .select("conv_id", "turn", F.expr(ENVELOPE_SHAPES_SQL).alias("response"))
    return L.response_envelope(logs, ["conv_id", "turn"], "response").select("conv_id", "turn", "envelope")


@query
def json_preview(spark, sf):
    return PV.json_preview(read_table(spark, sf, "events"), ["event_id"])


@query
def variant_path(spark, sf):
    return PV.variant_path(read_table(spark, sf, "events"), "props", "$.k", "bigint", ["event_id"]) \
        .select("event_id", F.col("value").alias("k"), F.col("value_text").alias("k_text"), "doc_text")


# ------------------------------------------------------------------ sources, sinks, streaming
import uuid  # noqa: E402

from quarry.sources import files as FS  # noqa: E402
from quarry.sources.payloads import ingest_payloads  # noqa: E402
from quarry.sources.tables import column_comments, ensure_namespace, save_table  # noqa: E402
from quarry.plans.specs import PROCESSED_COMMENT  # noqa: E402
from quarry.streaming import pipeline as SP  # noqa: E402

INGEST_FOLDER = "/ingest/productmanuals"
PAYLOADS_SQL = """
SELECT doc_id AS seq,
  concat('doc_', source, CASE lang WHEN 'en' THEN '.pdf' WHEN 'de' THEN '.PDF' ELSE '.txt' END) AS name,
  CASE WHEN doc_id % 10 = 3 THEN concat('!', base64(encode(text, 'UTF-8'))) ELSE base64(encode(text, 'UTF-8')) END
    AS content_base64
FROM {documents}"""


@query
def file_scan(spark, sf):
    f = FS.read_sizes(FS.scan_files(spark, sf, pattern="*.parquet", content=False), sf)
    return f.select(F.col("file_name").alias("name"), F.col("file_size").alias("size"), "content_bytes")


@query
def file_inventory(spark, sf):
    return FS.file_inventory(spark, sf, suffix=".PARQUET").select("name", "size")


@query
def file_stream(spark, sf):
    work = scratch_path(spark, "file-stream")
    found = FS.stream_sizes(spark, sf, "*.parquet", f"{work}/out", f"{work}/_checkpoint")
    return found.select(F.col("file_name").alias("name"), F.col("file_size").alias("size"))


def _payloads(spark, sf):
    return spark.sql(PAYLOADS_SQL, documents=read_table(spark, sf, "documents"))


@query
def payload_ingest(spark, sf):
    accepted, _ = ingest_payloads(_payloads(spark, sf), INGEST_FOLDER)
    return accepted.select("name", "path", "size", "seq")


@query
def payload_rejects(spark, sf):
    _, rejected = ingest_payloads(_payloads(spark, sf), INGEST_FOLDER)
    return rejected


def _saved_catalog(spark, sf):
    ensure_namespace(spark, "quarry", scratch_path(spark, "database"))
    name = f"quarry.processed_{uuid.uuid4().hex[:10]}"
    save_table(catalog.manuals_processed(spark, sf), name, PROCESSED_SCHEMA, PROCESSED_COMMENT,
               path=scratch_path(spark, "tables"))
    return name


@query
def ctas_roundtrip(spark, sf):
    """Created, then overwritten from itself: the rows go to a new folder before the table is pointed there."""
    name = _saved_catalog(spark, sf)
    save_table(spark.table(name), name, PROCESSED_SCHEMA, PROCESSED_COMMENT, path=scratch_path(spark, "tables"))
    return spark.table(name)


@query
def catalog_comments(spark, sf):
    return column_comments(spark, _saved_catalog(spark, sf))


def _raw_manuals(spark, sf):
    m = parsed_manuals(spark, sf)
    return m.select("path", "file_name", "file_size", F.encode("document", "UTF-8").alias("content"))


@query
def stream_pipeline(spark, sf):
    """Three chained availableNow streams over the manuals as raw-document files; equals the batch catalog."""
    work = scratch_path(spark, "stream-pipeline")
    from quarry.operators.partitioning import spread
    raw = _raw_manuals(spark, sf)
    spread(raw).write.parquet(f"{work}/input")  # several input files, so each stage runs in parallel
    prefix = "run_" + uuid.uuid4().hex[:8]
    SP.run_pipeline(spark, SP.stream_table(spark, f"{work}/input", schema=raw.schema), work, prefix=prefix, database="quarry")
    return spark.table(f"quarry.{prefix}_productmanuals_processed")


@query
def stream_incremental(spark, sf):
    """Run, add files, run again: the second run processes only the new documents."""
    work = scratch_path(spark, "stream-incremental")
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    labelled = read_table(spark, sf, "labels").select("doc_id")
    first = docs.join(labelled, "doc_id", "left_semi")
    second = docs.join(labelled, "doc_id", "left_anti")

    def stage(d):
        return d.select("doc_id", F.size(F.split("text", "\n")).alias("n_lines"))
    first.write.parquet(f"{work}/input")
    SP.run_stage(SP.stream_table(spark, f"{work}/input", like=docs), stage, f"{work}/out", f"{work}/_ck")
    spark.read.parquet(f"{work}/out").select("doc_id").write.parquet(f"{work}/after_run_1")
    second.write.mode("append").parquet(f"{work}/input")
    SP.run_stage(SP.stream_table(spark, f"{work}/input", like=docs), stage, f"{work}/out", f"{work}/_ck")
    seen = spark.read.parquet(f"{work}/after_run_1").withColumn("run", F.lit(1))
    out = spark.read.parquet(f"{work}/out")
    return out.join(seen, "doc_id", "left").select("doc_id", F.coalesce("run", F.lit(2)).alias("run"))


@query
def english_rule(spark, sf):
    """Q6 on documents: stop-word hits per language, the guessed language, and agreement with ``lang``."""
    from quarry.operators.partitioning import spread
    from quarry.functions.text import terms
    docs = spread(read_table(spark, sf, "documents").select("doc_id", "lang", "text")) \
        .select("doc_id", "lang", terms(F.col("text")).alias("__t"))
    hits = EV.stopword_hits(tokens=F.col("__t"))
    guess = EV.guess_language(hits)
    return docs.select("doc_id", "lang", *[h.cast("int").alias(f"{k}_hits") for k, h in hits.items()],
                       guess.alias("predicted_lang")) \
        .withColumn("is_english", F.coalesce(F.col("predicted_lang") == "en", F.lit(False))) \
        .withColumn("agrees", F.coalesce(F.col("predicted_lang") == F.col("lang"), F.lit(False)))


@query
def stream_rewrite(spark, sf):
    """Between two runs the files of one source are deleted and all others rewritten at the same paths.

    append_version: what the append stream holds after both runs (Spark skips seen paths and forgets none);
    replace_version: what the replace-mode sync holds (rewritten rows replace the old ones, rows of deleted files go).
    """
    from quarry.streaming.replace import place_files, read_snapshot, remove_files, sync_latest

    work = scratch_path(spark, "stream-rewrite")
    folder = f"{work}/input"
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    schema = "doc_id bigint, source string, version int"

    def append_run():
        SP.run_stage(spark.readStream.schema(schema).parquet(folder), lambda d: d, f"{work}/append", f"{work}/_ck")

    place_files(spark, docs.withColumn("version", F.lit(1)), "source", folder, f"{work}/tmp1", id_col="doc_id")
    append_run()
    sync_latest(spark, folder, schema, f"{work}/sync")
    gone = docs.agg(F.min("source")).first()[0]
    remove_files(spark, f"{folder}/{gone}-*.parquet")
    place_files(spark, docs.filter(F.col("source") != gone).withColumn("version", F.lit(2)), "source", folder, f"{work}/tmp2", id_col="doc_id")
    append_run()
    sync_latest(spark, folder, schema, f"{work}/sync")
    appended = spark.read.parquet(f"{work}/append").select("doc_id", F.col("version").alias("append_version"))
    replaced = read_snapshot(spark, f"{work}/sync", schema).select("doc_id", F.col("version").alias("replace_version"))
    return appended.join(replaced, "doc_id", "full")
