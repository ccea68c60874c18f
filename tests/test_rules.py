"""Hand-written edge cases for extraction rules, scorers, parsing and logs."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions.fieldspec import FieldSpec
from quarry.operators import evaluate as EV
from quarry.operators import logs as L
from quarry.operators import parse as P
from quarry.operators.extract import extract, extract_typed
from quarry.operators.flatten import flatten
from quarry.operators.matching import format_profile
from quarry.operators.profiles import merge_profiles, profile, read_profile
from quarry.plans.specs import FIELD_NAMES, PROCESSED_SCHEMA, PRODUCT_SPEC, spec_subset
from quarry.sources.payloads import ingest_payloads


def test_extraction_rules(spark):
    text = "\n".join(["Intro line", "[en]", "Model: GSR-18", "Max torque soft/hard: 20/55 Nm", "Low gear: 0-450 rpm",
                      "Weight: 3 lbs", "Battery: A-1", "Recommended battery: B-2", "Battery: A-1", "Model: X-2",
                      "[de]", "Model: DE-1", "Nennspannung: 18 V"])
    df = spark.createDataFrame([(text,)], "t string")
    spec = spec_subset(["model_number", "max_torque_nm", "no_load_speed_low_rpm", "weight_kg",
                        "compatible_batteries", "rated_voltage_v"])
    r = extract_typed(df, "t", spec).first()
    assert r.model_number == "GSR-18"
    assert r.max_torque_nm == 55.0
    assert r.no_load_speed_low_rpm == 450.0
    assert r.weight_kg == round(3 * 0.4536, 6)
    assert r.compatible_batteries == "A-1, B-2"
    assert r.rated_voltage_v is None


def test_no_markers_reads_whole_text(spark):
    df = spark.createDataFrame([("Model: ABC\nRated voltage: 12 V",)], "t string")
    r = extract_typed(df, "t", spec_subset(["model_number", "rated_voltage_v"])).first()
    assert (r.model_number, r.rated_voltage_v) == ("ABC", 12.0)


def test_variant_casts_and_rejects(spark):
    df = spark.createDataFrame([("Rated voltage: 18 X V\nMax torque: 450.7 Nm",)], "t string")
    spec = spec_subset(["rated_voltage_v", "max_torque_nm", "no_load_speed_low_rpm"])
    e = extract(df.withColumn("file_name", F.lit("a.pdf")), "t", spec)
    out = flatten(e, "ai_result", PROCESSED_SCHEMA, keys=["file_name"]).first()
    assert out.rated_voltage_v is None  # "18 X" does not parse
    assert out.max_torque_nm == 450.7
    assert out.no_load_speed_low_rpm is None
    assert out.cast_errors == ["rated_voltage_v"]


def _records(spark, rows):
    schema = PROCESSED_SCHEMA
    return spark.createDataFrame(rows, schema)


def test_range_scorer_bounds(spark):
    base = {f.name: None for f in PROCESSED_SCHEMA.fields}
    cases = [dict(base, file_name="lo", rated_voltage_v=1.0), dict(base, file_name="hi", rated_voltage_v=60.0),
             dict(base, file_name="out", rated_voltage_v=60.5), dict(base, file_name="nan", weight_kg=float("nan")),
             dict(base, file_name="inf", weight_kg=float("inf")), dict(base, file_name="none")]
    df = _records(spark, [tuple(c[f.name] for f in PROCESSED_SCHEMA.fields) for c in cases])
    s = EV.format_validator()
    got = {r.file_name: (r.v, r.r) for r in df.select("file_name", s.value.alias("v"), s.rationale.alias("r")).collect()}
    assert got["lo"] == (True, "All 1 present numeric fields within expected ranges")
    assert got["hi"][0] is True
    assert got["out"] == (False, "Issues found: rated_voltage_v=60.5 out of range (Voltage should be 1-60V)")
    assert got["nan"] == (False, "Issues found: weight_kg=nan out of range (Weight should be 0.3-15kg)")
    assert got["inf"] == (False, "Issues found: weight_kg=inf out of range (Weight should be 0.3-15kg)")
    assert got["none"] == (True, "All 0 present numeric fields within expected ranges")


def test_chuck_pattern(spark):
    ok = ["10", "1.5-13", "10mm", " 10 mm ", "13 mm"]
    bad = ["1.5 - 13", "10-", "", "about 10"]
    df = spark.createDataFrame([(v,) for v in ok + bad], "chuck_capacity_mm string")
    for f in PROCESSED_SCHEMA.fields:
        if f.name != "chuck_capacity_mm":
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    s = EV.format_validator()
    got = dict(df.select("chuck_capacity_mm", s.value.alias("v")).collect())
    assert all(got[v] for v in ok)
    assert not any(got[v] for v in bad)


def test_completeness_rounding(spark):
    fields = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([tuple(["x"] + [None] * 7), tuple([""] * 8), tuple([None] * 8)],
                               ", ".join(f"{f} string" for f in fields))
    s = EV.completeness(fields)
    got = df.select(s.value.alias("v"), s.rationale.alias("r")).collect()
    # 1/8 = 0.125 -> Python round gives 0.12; 12.5 -> "12"
    assert (got[0].v, got[0].r) == (0.12, "1/8 fields extracted (12%)")
    assert (got[1].v, got[1].r) == (1.0, "8/8 fields extracted (100%)")  # empty strings count as filled
    assert (got[2].v, got[2].r) == (0.0, "0/8 fields extracted (0%)")


def test_pipe_tables_shapes(spark):
    texts = [
        "| a |\n| --- |\n| 1 |",                       # one column
        "| a | b | c |\n|---|---|---|\n| 1 | 2 | 3 |",  # three columns
        "| a | b |\n| 1 | 2 |",                         # no separator: body after line 1
        "| a | b |\n| --- | --- |",                     # separator only: no body
        "| a | b |\n| 1 | 2 |\n\n| x | y |\n| 3 | 4 |",  # blank line ends a block
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = {(r.id, r.block, r.row, r.col): (r.header, r.value) for r in P.pipe_tables(df, "id", "t").collect()}
    assert rows[(0, 0, 0, 0)] == ("a", "1")
    assert rows[(1, 0, 0, 2)] == ("c", "3")
    assert rows[(2, 0, 0, 1)] == ("b", "2")
    assert not any(k[0] == 3 for k in rows)
    assert rows[(4, 1, 0, 0)] == ("x", "3")


def test_response_flattening_branches(spark):
    cases = [
        (["  hi  ", {"type": "message", "content": "there"}], "hi\n\nthere"),
        ({"predictions": [{"outputs": [{"text": "nested"}]}]}, "nested"),
        ({"output": [{"type": "message", "content": [{"type": "output_text", "text": "<name>bot</name>"},
                                                     {"type": "text", "text": " a "}]}]}, "a"),
        ({"content": "  plain "}, "plain"),
        ({"choices": [{"message": {"content": "choice"}}]}, "choice"),
        ({"id": "r1", "output": []},
         "The agent endpoint returned no output items (empty output list). response id='r1'"),
        ({"id": "r3", "outputs": []}, '{"id":"r3","outputs":[]}'),  # `[] or None` is None: no notice
        ({"id": "r2", "model": "m"},
         "The agent endpoint returned no message text (only response metadata). If this persists, check the "
         "endpoint task type and response shape. id='r2'"),
        ([{"text": "<name>only-tag</name>"}], '[{"text":"<name>only-tag</name>"}]'),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, j string")
    got = dict(L.flatten_responses(df, "j").select("i", "content").collect())
    for i, (_, want) in enumerate(cases):
        assert got[i] == want, (i, got[i])


def test_ingest_duplicates_and_rejects(spark):
    import base64
    b = lambda s: base64.b64encode(s.encode()).decode()
    rows = [(1, "a.pdf", b("one")), (2, "a.pdf", b("three")), (3, "B.PDF", b("x")), (4, "c.txt", b("y")),
            (5, "d.pdf", "!!!")]
    df = spark.createDataFrame(rows, "seq int, name string, content_base64 string")
    acc, rej = ingest_payloads(df, "/vol/folder/")
    got = {r.name: (r.path, r.size) for r in acc.collect()}
    assert got == {"a.pdf": ("/vol/folder/a.pdf", 5), "B.PDF": ("/vol/folder/B.PDF", 1)}
    assert {(r.name, r.reason) for r in rej.collect()} == {("c.txt", "not a pdf"), ("d.pdf", "invalid base64")}


def test_segment_markup_drops_script(spark):
    html = '<html><head><title>T</title><script>var t="</p>";</script></head><body><p>Hello <b>x</b></p>' \
           '<!-- <p>gone</p> --><li>item</li></body></html>'
    df = spark.createDataFrame([(1, html)], "id int, h string")
    got = [(r.tag, r.text) for r in P.segment_markup(df, "id", "h").orderBy("pos").collect()]
    assert got == [("title", "T"), ("p", "Hello x"), ("li", "item")]


def test_spec_is_complete():
    assert [s.name for s in PRODUCT_SPEC] == FIELD_NAMES and len(FIELD_NAMES) == 14
    assert isinstance(PRODUCT_SPEC[0], FieldSpec)


def _found(spark, index, questions=None):
    from quarry.operators import retrieval as R
    from quarry.operators import segments as SG
    from tests.conftest import SMALL

    t = SG.read_index(spark, index)
    questions = spark.read.parquet(f"{SMALL}/benchmark.parquet") if questions is None else questions
    return R.search(questions, "item_id", "text", t.postings, "doc_id", 3, dictionary=t.dictionary, stats=t.stats)


def test_index_grows_by_segments(spark, tmp_path):
    """Old and new segments together answer like one index; a rerun and a failed sync add nothing; compaction changes nothing."""
    from quarry.operators import segments as SG
    from tests.conftest import SMALL

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole, grown = (SG.PassageIndex(f"{tmp_path}/{n}", keep=("lang",)) for n in ("whole", "grown"))
    SG.sync(docs, whole)
    for k in range(3):
        assert SG.sync(docs.filter(f"doc_id % 3 <= {k}"), grown).count() > 0
    want = sorted(map(tuple, _found(spark, whole).collect()))
    assert len(SG.live_segments(spark, grown)) == 3
    assert sorted(map(tuple, _found(spark, grown).collect())) == want
    assert SG.sync(docs, grown).count() == 0 and len(SG.live_segments(spark, grown)) == 3
    SG.read_index(spark, grown).chunks.write.parquet(f"{grown.path}/segments/unlisted/chunks")  # left by a failed sync
    assert len(SG.live_segments(spark, grown)) == 3
    SG.compact(spark, grown)
    assert len(SG.live_segments(spark, grown)) == 1
    assert sorted(map(tuple, _found(spark, grown).collect())) == want
    assert SG.sync(docs.limit(0), SG.PassageIndex(f"{tmp_path}/empty")).count() == 0


def test_search_skips_parts_and_sums_in_place(spark, tmp_path):
    from quarry.operators import segments as SG
    from tests.conftest import SMALL

    index = SG.PassageIndex(f"{tmp_path}/index", keep=("lang",))
    SG.sync(spark.read.parquet(f"{SMALL}/documents.parquet"), index)
    one = spark.read.parquet(f"{SMALL}/benchmark.parquet").selectExpr("item_id", "array_join(slice(split(text, ' '), 1, 3), ' ') AS text").limit(1)
    plan = _found(spark, index, one)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "Scan parquet" in x and f"postings_" in x]
    assert scans and all("PushedFilters: [" in x and "EqualTo(part," in x and "Bucketed: true" in x for x in scans)
    # Between the postings and the partial top-k lies no exchange but the broadcast of the question terms.
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if x in scans)
    limit = max(i for i, x in enumerate(lines[:at]) if "WindowGroupLimit" in x)
    assert not [x for x in lines[limit:at] if "Exchange hashpartitioning" in x]
    # A new catalog finds the segments again from their files.
    want = sorted(map(tuple, _found(spark, index, one).collect()))
    for s in SG.live_segments(spark, index):
        spark.sql(f"DROP TABLE {SG.DATABASE}.postings_{s}")
    assert sorted(map(tuple, _found(spark, index, one).collect())) == want and want


def test_index_stats_match_direct_counts(spark):
    from functools import reduce

    from quarry.functions.text import terms
    from quarry.operators.retrieval import index_stats
    from quarry.plans import queries as Q
    from tests.conftest import SMALL

    t = Q._index(spark, SMALL)
    st, postings = t.stats.first(), reduce(lambda a, b: a.unionByName(b), t.postings)
    assert st["n_chunks"] == t.chunks.count() and st["n_postings"] == postings.count()
    assert st["sum_dl"] == t.chunks.agg(F.sum(F.size(terms(F.col("text"))))).first()[0]
    assert index_stats(postings).first().sum_dl == st["sum_dl"]


def test_user_scorers(spark):
    from quarry.api import pattern, ranges, score

    df = spark.createDataFrame([("a", 5.0, "AB-1"), ("b", 50.0, "not an id"), ("c", None, None)],
                               "k string, v double, m string")
    scorers = [ranges([("v", 1, 10, "v should be 1-10")]), pattern("m", r"^[A-Z]+-\d+$")]
    got = {(r.k, r.scorer): r.value for r in score(df, ["k"], scorers).collect()}
    assert got[("a", "ranges")] == 1.0 and got[("b", "ranges")] == 0.0 and got[("c", "ranges")] == 1.0
    assert got[("a", "m_pattern")] == 1.0 and got[("b", "m_pattern")] == 0.0 and got[("c", "m_pattern")] == 1.0


def test_posexplode_rows_keeps_null_elements_and_drops_empty_arrays(spark):
    from quarry.functions.arrays import posexplode_rows

    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, xs array<string>")
    got = sorted(tuple(r) for r in posexplode_rows(df, ["k"], "xs", "i", "x").collect())
    assert got == [(1, 0, "a"), (1, 1, None)]


def test_sized_broadcast_only_below_the_bound(spark):
    from pyspark.sql import functions as F

    from quarry.operators.partitioning import sized_broadcast

    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(100).select((F.col("id") % 50).alias("k"))

    def plan(side):
        return big.join(side, "k", "left_semi")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(sized_broadcast(small, max_rows=5)).lower()
    assert "broadcast" not in plan(sized_broadcast(small, max_rows=4)).lower()


def test_place_files_splits_hot_keys_and_rewrites_the_same_paths(spark):
    from pyspark.sql import functions as F

    from quarry.session import scratch_path
    from quarry.streaming.replace import place_files

    work = scratch_path(spark, "place-files")
    df = spark.range(100).select(F.col("id").alias("doc_id"),
                                 F.when(F.col("id") < 90, "hot").otherwise("cold").alias("source"))

    def files(v):
        place_files(spark, df.withColumn("v", F.lit(v)), "source", f"{work}/in", f"{work}/tmp{v}",
                    id_col="doc_id", rows_per_file=30)
        got = spark.read.parquet(f"{work}/in").select("doc_id", "v", F.col("_metadata.file_name").alias("f"))
        return got, sorted(r.f for r in got.select("f").distinct().collect())

    _, first = files(1)
    got, second = files(2)
    assert second == first and first == ["cold-0.parquet", "hot-0.parquet", "hot-1.parquet", "hot-2.parquet"]
    assert got.count() == 100 and got.filter("v = 2").count() == 100


def test_pipe_table_of_100k_lines_and_crlf(spark):
    from quarry.operators.parse import pipe_tables

    long = "| a | b |\n| --- | --- |\n" + "\n".join(f"| {i} | x |" for i in range(100_000))
    df = spark.createDataFrame([(1, long), (2, "text\r\n| h | k |\r\n| --- | --- |\r\n| 1 | 2 |\r\n")], "id int, text string")
    got = pipe_tables(df, "id", "text")
    assert got.filter("id = 1").count() == 200_000
    assert sorted((r["header"], r["value"]) for r in got.filter("id = 2").collect()) == [("h", "1"), ("k", "2")]


def test_no_machine_local_scratch_on_a_cluster():
    import pytest

    from quarry.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_sections_of_every_spelling_and_preamble(spark):
    from quarry.operators.sections import sections

    text = "Model: PRE\r\n[EN]\r\nBrand: B1\r\n[de]\r\nBrand: DE\r\n[en-US]\r\nType: drill\r\n[fr]\r\n[en]\nRated voltage: 18 V"
    df = spark.createDataFrame([(1, text), (2, "[de]\nModel: X"), (3, None), (4, "Model: M\r\nRated voltage: 12 V")], "id int, t string")
    spec = spec_subset(["model_number", "manufacturer", "product_type", "rated_voltage_v"])
    got = {r.id: tuple(r)[2:] for r in extract_typed(df, "t", spec).collect()}
    assert got[1] == ("PRE", "B1", "drill", 18.0)
    assert got[2] == got[3] == (None, None, None, None)
    assert got[4] == ("M", None, None, 12.0)
    rows = sorted((r.section_no, r.lang, r.text) for r in sections(df, ["id"], "t").filter("id = 1").collect())
    assert rows == [(-1, None, "Model: PRE"), (0, "en", "Brand: B1"), (1, "de", "Brand: DE"), (2, "en-us", "Type: drill"),
                    (3, "fr", ""), (4, "en", "Rated voltage: 18 V")]


def test_numbers_dashes_thousands_suffixes_and_long_labels(spark):
    rows = [(1, "Low gear: 0–450 rpm\nHigh gear: 0-1,800 rpm\nMax torque hard/soft: 55/20 Nm"), (2, "Rated voltage: 18D V"),
            (3, "High gear: 0 - 1 800 000 rpm"), (4, "High gear: 0-9999999999 rpm\nMax torque soft/hard: 20/55 Nm")]
    df = spark.createDataFrame(rows, "file_name string, t string")
    names = ["rated_voltage_v", "max_torque_nm", "no_load_speed_low_rpm", "no_load_speed_high_rpm"]
    got = {r.file_name: r for r in extract_typed(df, "t", spec_subset(names)).collect()}
    assert got["1"][2:] == (None, 55.0, 450.0, 1800.0)
    assert got["2"].rated_voltage_v is None and got["3"].no_load_speed_high_rpm is None
    assert got["4"].max_torque_nm == 55.0
    typed = extract(df, "t", PRODUCT_SPEC)
    out = {r.file_name: r for r in flatten(typed, "ai_result", PROCESSED_SCHEMA, keys=["file_name"]).collect()}
    assert out["4"].no_load_speed_high_rpm is None and out["4"].cast_errors == ["no_load_speed_high_rpm"]
    label = "L" * 200
    spec = [FieldSpec("x", labels=(label,))]
    assert extract_typed(spark.createDataFrame([(label + ": v",)], "t string"), "t", spec).first().x == "v"


def test_declared_schema_never_aborts(spark):
    from pyspark.sql import types as T

    from quarry.sources.tables import enforce_schema

    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert enforce_schema(spark.sql("SELECT 9999999999.0D AS a"), schema).first().a is None


def test_grounding_on_token_boundaries_and_whole_text(spark):
    text = "[en]\n" + "filler " * 2000 + "\nRated voltage: 15 V\nModel: AB-12\n[de]\nMax torque 77"
    base = {f: None for f in FIELD_NAMES}
    rows = [dict(base, rated_voltage_v=15.0, model_number="AB-12"), dict(base, rated_voltage_v=5.0),
            dict(base, model_number="AB-1"), dict(base, max_torque_nm=77.0)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PROCESSED_SCHEMA.fields)
    df = spark.createDataFrame([(str(i), *[r[f] for f in FIELD_NAMES]) for i, r in enumerate(rows)], schema) \
        .withColumn("source_text", F.lit(text))
    got = {r.file_name: r.ungrounded_fields for r in EV.grounding(df).collect()}
    assert got == {"0": "", "1": "rated_voltage_v", "2": "model_number", "3": "max_torque_nm"}


def test_english_compliance_both_ways(spark):
    names = {"Drill No. 2": True, "Die grinder": True, "Pour spout": True, "充電式ドライバドリル": False, "Schlüssel": False,
             "Bohrer mit Koffer": False, None: True}
    df = spark.createDataFrame([(n,) for n in names], "product_name string")
    s = EV.english_compliance(["product_name"])
    assert dict(df.select("product_name", s.value).collect()) == names


def test_nested_responses_and_falsy_values(spark):
    cases = [({"predictions": [{"output": [{"outputs": [{"text": "x"}]}]}]}, "x"),
             ({"predictions": [{"outputs": [{"text": " "}], "output": [{"text": "second"}]}]}, "second"),
             ({"id": 0, "output": []}, '{"id":0,"output":[]}'),
             ({"id": "r", "outputs": "", "output": []},
              "The agent endpoint returned no output items (empty output list). response id='r'")]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, j string")
    got = dict(L.flatten_responses(df, "j").select("i", "content").collect())
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_building_a_spread_plan_starts_no_job(spark):
    from quarry.operators.partitioning import spread

    tracker = spark.sparkContext.statusTracker()
    left, right = spark.range(1000).repartition(4), spark.range(50).repartition(3)
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        spread(left.hint("merge").join(right, "id", "left_anti"))
        assert list(tracker.getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- labels anywhere in a text (X10), section markers (D5), decimal commas (X3) ---

TEXTS_AND_FIELDS = [
    ("Weight: 2 kg\n[mm]\nMax torque: 5 Nm\n[ok]\n[AC]", {"weight_kg": 2.0, "max_torque_nm": 5.0}),
    ("Manufacturer: Foo; Model: X-1, Weight: 2 kg", {"manufacturer": "Foo", "model_number": "X-1", "weight_kg": 2.0}),
    ("This drill delivers a max torque of 55 Nm and a rated voltage of 18 V.", {"max_torque_nm": 55.0, "rated_voltage_v": 18.0}),
    ("| Max torque | 55 | Nm |\n| Model | Z9 | new |\n| Weight | 2 kg | Rated voltage | 18 V |",
     {"max_torque_nm": 55.0, "model_number": "Z9", "weight_kg": 2.0, "rated_voltage_v": 18.0}),
    ("Product: Battery drill\nOld weight: 3 kg\nWeight: 0,125 kg\nMax torque: 1,200 Nm",
     {"product_name": "Battery drill", "weight_kg": 0.125, "max_torque_nm": 1200.0}),
    ("The weight is about 2,5 kg\n- Brand: Bar\nType = drill. Charger: C1",
     {"weight_kg": 2.5, "manufacturer": "Bar", "product_type": "drill", "compatible_chargers": "C1"}),
    ("A weight of 9 kg is usual.\nWeight: 2 kg", {"weight_kg": 2.0}),  # a labelled value goes before a sentence's
    ("Max torque soft/hard: 46/55 Nm; Max torque: 99 Nm", {"max_torque_nm": 55.0}),  # the longest label at a place
    ("this type of drill has no weight to speak of \x01\x02 Weight\x01", {}),
    ("| Weight | Max torque |\n| 2 kg | 5 Nm |", {}),  # a header row names columns, not values
    ("", {}), (None, {}),
]


def test_labels_are_read_anywhere(spark):
    from quarry.operators.extract import extract_typed

    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS_AND_FIELDS)], "k int, t string")
    for r in extract_typed(df, "t", PRODUCT_SPEC).drop("t").collect():
        assert {c: v for c, v in r.asDict().items() if c != "k" and v is not None} == TEXTS_AND_FIELDS[r.k][1], r.k


def test_labels_take_one_regex_pass_and_long_lines(spark):
    from pyspark.sql import functions as F

    from quarry.functions.fieldspec import declared_labels
    from quarry.functions.text import label_values

    long = "word | " * 200_000 + "Weight: 2 kg; " + "of ; " * 200_000 + "Model: X"
    df = spark.createDataFrame([(long,)], "t string").select(label_values(F.col("t"), *declared_labels(PRODUCT_SPEC)).alias("p"))
    assert [(p.label, p.value[:4]) for p in df.first().p] == [("weight", "2 kg"), ("model", "X")]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("(?im)") == 1


def test_markers_are_an_argument(spark):
    from quarry.operators.extract import extract_typed

    df = spark.createDataFrame([("[kg]\nWeight: 3 kg\n[en]\nWeight: 2 kg",)], "t string")
    assert extract_typed(df, "t", PRODUCT_SPEC).first().weight_kg == 3.0  # "[kg]" is text
    assert extract_typed(df, "t", PRODUCT_SPEC, markers="[a-z]{2}").first().weight_kg == 2.0


# --- responses of any depth (C2), envelopes (C4), trimmed user text (C1) ---

def test_responses_of_any_depth(spark):
    """Level by level gives what the expression gives with enough levels."""
    import json

    from pyspark.sql import functions as F

    from quarry.operators import logs as L

    def nest(x, depth):
        for k in range(depth):
            x = {("outputs", "output", "predictions")[k % 3]: [x], "type": "message", "content": f"own {k}"}
        return x

    rows = [nest({"text": " deep "}, d) for d in range(13)] + [nest({"note": "no text"}, d) for d in (3, 12)]
    rows += [[nest({"text": "a"}, 5), "b", nest({"text": "<name>x</name>"}, 7), nest({"type": "message", "content": [{"type": "text", "text": "c"}]}, 6)],
             {"output": [{"outputs": [{"output": [{"predictions": []}]}], "predictions": [nest({"text": "second"}, 4)], "text": "own"}]},
             {"predictions": [[1, 2], 3, None]}, {"outputs": [], "output": [], "predictions": [], "id": 5}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(99, None), (98, '"output": "outputs": "output": no json')], "k int, content string")
    got = {r.k: r.out for r in L.flatten_responses(df, "content", "out").collect()}
    shallow = df.filter("k <= 4 OR k IN (13, 17, 18, 98, 99)")
    want = {r.k: r.out for r in shallow.withColumn("out", L.response_text(F.col("content"), 4)).collect()}
    want |= dict.fromkeys(range(5, 13), "deep") | {14: "own 0", 15: "a\n\nb\n\nown 0\n\nc", 16: "second"}
    assert got == want and want[1] == "deep" and want[13] == "own 0"


def test_envelope_branches(spark):
    import json

    from quarry.operators.logs import response_envelope

    message = {"type": "message", "content": "m"}
    cases = [  # (response, items passed through, or the text of one message)
        ({"output": [message]}, [message]), ({"output": ["x"], "outputs": [message, {"a": 1}]}, [message, {"a": 1}]),
        ({"predictions": [{"output": [message]}]}, [message]), ({"predictions": [{"output": ["x"]}]}, ["x"]),
        ({"predictions": [{"output": " t "}]}, " t "), ({"predictions": [message, {"type": "message"}]}, [message]),
        ({"predictions": [{"output": " ", "text": "own"}]}, "own"), ({"predictions": ["p", "q"]}, "p"),
        ({"predictions": [{"outputs": [{"output": [{"outputs": [{"output": [{"text": "deep"}]}]}]}]}]}, "deep"),
        ({"choices": [{"message": {"content": "c"}}]}, "c"), ({"choices": [{"message": {"content": " "}}], "content": "d"}, "d"),
        ({"content": " e "}, "e"), ([message], [message]), ("plain", "plain"),
    ]
    df = spark.createDataFrame([(i, "x", r if isinstance(r, str) else json.dumps(r)) for i, (r, _) in enumerate(cases)], "k int, raw string, t string")
    for r in response_envelope(df, ["k"], "t").collect():
        want = cases[r.k][1]
        got = json.loads(r.envelope)
        if isinstance(want, str):
            assert len(got) == 1 and got[0]["role"] == "assistant" and got[0]["content"] == [{"type": "output_text", "text": want, "annotations": []}], r.k
        else:
            assert got == want, r.k
        assert r.raw == "x"


def test_new_user_text_is_trimmed(spark):
    from quarry.operators.logs import chat_history

    df = spark.createDataFrame([(1, 0, "user", " a "), (1, 1, "assistant", " b "), (1, 2, "user", " c \n"), (2, 0, "user", " \n")],
                               "conv_id int, turn int, role string, text string")
    got = {r.conv_id: ([m.content for m in r.messages], r.accepted) for r in chat_history(df).collect()}
    assert got == {1: ([" a ", " b ", "c"], True), 2: ([""], False)}


# --- sinks and streams (K3, K6, S5, T1, T3) ---

def test_tables_switch_over(spark, tmp_path):
    from pyspark.sql import functions as F

    from quarry.sources.tables import ensure_namespace, save_table

    ensure_namespace(spark, "switch", f"{tmp_path}/db")
    df = spark.range(10).withColumn("v", F.lit(1))
    save_table(df, "switch.t", path=f"{tmp_path}/t", comment="it's a table")
    save_table(spark.table("switch.t").withColumn("v", F.col("v") + 1), "switch.t", path=f"{tmp_path}/t")  # from itself
    assert spark.table("switch.t").agg(F.sum("v")).first()[0] == 20
    with pytest.raises(Exception, match="no good"):
        save_table(df.withColumn("v", F.raise_error(F.lit("no good")).cast("int")), "switch.t", path=f"{tmp_path}/t")
    assert spark.table("switch.t").agg(F.sum("v")).first()[0] == 20
    save_table(df.withColumn("w", F.lit("x")), "switch.t", path=f"{tmp_path}/t")  # other columns
    assert spark.table("switch.t").columns == ["id", "v", "w"]
    spark.sql("DROP DATABASE switch CASCADE")


def test_metrics_of_a_run_replace_themselves(spark, tmp_path):
    from quarry.sources.tables import append_metrics, read_metrics

    def run(run_id, value):
        return spark.sql(f"SELECT '{run_id}' AS run_id, timestamp'2024-01-01' AS run_ts, 'm' AS metric, {value}D AS value")

    path = f"{tmp_path}/metrics"
    for run_id, value, experiment in (("1", 1, "a"), ("2", 2, "a"), ("1", 5, "b"), ("1", 3, "a"), ("1", 3, "a")):
        append_metrics(run(run_id, value), path, experiment)
    assert sorted((r.run_id, r.value) for r in read_metrics(spark, path, "a").collect()) == [("1", 3.0), ("2", 2.0)]
    assert [(r.run_id, r.value) for r in read_metrics(spark, path, "b").collect()] == [("1", 5.0)]


def test_pipeline_over_a_folder_of_files(spark, tmp_path):
    """Three runs: no file yet, some, more; the tables have their comments from the first."""
    from quarry.plans.specs import PROCESSED_COLUMNS
    from quarry.sources.files import stream_files
    from quarry.streaming.pipeline import run_pipeline

    folder = tmp_path / "manuals"
    folder.mkdir()
    counts = []
    for k, names in enumerate(([], ["a.pdf", "b.PDF", "notes.txt"], ["c.pdf", "d.pdf", "e.pdf"])):
        for name in names:
            (folder / name).write_text(f"[en]\nModel: {name[0]}\nMax torque: {k}5 Nm\n")
        source = stream_files(spark, str(folder), "*.[pP][dD][fF]", max_files=2)
        run_pipeline(spark, source, f"{tmp_path}/work", prefix=f"run{tmp_path.name}".replace("-", "_"), database="files_db")
        table = spark.table(f"files_db.run{tmp_path.name}_productmanuals_processed".replace("-", "_"))
        spark.catalog.refreshTable(f"files_db.run{tmp_path.name}_productmanuals_processed".replace("-", "_"))
        counts.append(sorted((r.file_name, r.max_torque_nm) for r in table.collect()))
    assert counts == [[], [("a.pdf", 15.0), ("b.PDF", 15.0)], [("a.pdf", 15.0), ("b.PDF", 15.0), ("c.pdf", 25.0), ("d.pdf", 25.0), ("e.pdf", 25.0)]]
    assert [table.schema[c].metadata.get("comment") for c, _, _ in PROCESSED_COLUMNS] == [c for _, _, c in PROCESSED_COLUMNS]
    spark.sql("DROP DATABASE files_db CASCADE")


def test_replace_mode_writes_touched_buckets_only(spark, tmp_path):
    import glob
    import os
    import time

    from quarry.streaming.replace import read_snapshot, sync_latest

    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def put(name, values):
        spark.createDataFrame([(name, v) for v in values], "name string, v int").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/one")
        os.makedirs(folder, exist_ok=True)
        os.replace(glob.glob(f"{tmp_path}/one/part-*.parquet")[0], f"{folder}/{name}.parquet")

    def rows():
        return sorted((r.name, r.v) for r in read_snapshot(spark, out, "name string, v int").collect())

    for name in "abcdefgh":
        put(name, [1, 2])
    assert sync_latest(spark, folder, "name string, v int", out, buckets=4) == {"added": 8, "changed": 0, "removed": 0}
    first = {b: f for f in glob.glob(f"{out}/rows/sync=1/bucket=*") for b in [int(f.rsplit("=", 1)[1])]}
    time.sleep(1.1)
    put("a", [7])
    os.remove(f"{folder}/b.parquet")
    put("z", [9])
    assert sync_latest(spark, folder, "name string, v int", out, buckets=4) == {"added": 1, "changed": 1, "removed": 1}
    want = sorted([(n, v) for n in "cdefgh" for v in (1, 2)] + [("a", 7), ("z", 9)])
    assert rows() == want
    touched = {b for r in spark.read.parquet(f"{out}/list").filter("sync = 2").collect() for b in r.buckets}
    read = {f.split("/rows/")[1].split("/part")[0] for f in (r.f for r in read_snapshot(spark, out, "name string, v int").selectExpr("input_file_name() AS f").collect())}
    assert 0 < len(touched) <= 3 and {f"sync=1/bucket={b}" for b in first if b not in touched} <= read
    assert not {f"sync=1/bucket={b}" for b in touched} & read
    assert sync_latest(spark, folder, "name string, v int", out, buckets=4) == {"added": 0, "changed": 0, "removed": 0} and rows() == want
    for f in glob.glob(f"{folder}/*.parquet"):
        os.remove(f)
    assert sync_latest(spark, folder, "name string, v int", out, buckets=4)["removed"] == 8 and rows() == []


# --- short strings (V2) ---

def test_entity_match_of_short_strings_equals_brute_force(spark):
    import random

    from quarry.operators.matching import entity_match, normalise

    rng = random.Random(4)
    values = ["", "-", "a", "ab", "ba", "xy", "q", "7", "a1"] + ["".join(rng.choice("abcdef12") for _ in range(rng.randint(0, 6))) for _ in range(60)]
    mentions = ["", "A", "b-a", "zz", "9"] + ["".join(rng.choice("abcdefz12 -") for _ in range(rng.randint(0, 6))) for _ in range(120)]
    v, m = spark.createDataFrame([(x,) for x in values], "v string"), spark.createDataFrame([(x,) for x in mentions], "m string")
    for d in (1, 2, 3):
        got = {r.mention: (r.value, r.distance) for r in entity_match(m, "m", v, "v", d).collect()}
        pairs = m.distinct().crossJoin(v.distinct()).withColumn("d", F.levenshtein(normalise(F.col("m")), normalise(F.col("v"))))
        want = {x: (None, None) for x in mentions}
        for r in sorted(pairs.filter(F.col("d") <= d).collect(), key=lambda r: (r.d, r.v), reverse=True):
            want[r.m] = (r.v, r.d)
        assert got == want, d


def test_profiles_merge_without_their_batches(spark):
    """Merged profiles of parts equal the profile of the whole: counts, ends by number, frequent values; estimates within 5 %."""
    rows = [(k, float(k % 977) if k % 5 else None, f"t{k % 7}" if k % 3 else None, None) for k in range(6000)]
    df = spark.createDataFrame(rows, "k long, `a b` double, t string, none string")
    cols = ["k", "a b", "t", "none"]
    parts = profile(df.withColumn("batch", F.col("k") % 4), cols, by=["batch"])
    assert parts.count() == 16
    merged = merge_profiles(merge_profiles(parts.filter("batch < 2")).unionByName(merge_profiles(parts.filter("batch >= 2"))))
    exact = {r["column_name"]: r for r in format_profile(df, cols, 3).collect()}
    for got in (read_profile(merged).collect(), read_profile(profile(df, cols)).collect()):
        assert {r["column_name"] for r in got} == set(cols)
        for r in got:
            want = exact[r["column_name"]]
            assert (r["n_rows"], r["null_count"], r["min_value"], r["max_value"]) == (6000, want["null_count"], want["min_value"], want["max_value"])
            assert abs(r["distinct_estimate"] - want["distinct_count"]) <= 0.05 * want["distinct_count"]
        frequent = {r["column_name"]: [tuple(x) for x in r["frequent_values"] or []] for r in got}
        counts = {f"t{j}": sum(1 for k in range(6000) if k % 3 and k % 7 == j) for j in range(7)}
        assert frequent["t"] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3] and frequent["none"] == []
    assert {r["n_rows"] for r in read_profile(profile(df.limit(0), cols)).collect()} == {0}
    assert profile(df.limit(0), cols, by=["k"]).count() == 0


def test_score_metrics_equal_the_long_form_without_messages(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "z", 3.0)], "run string, k string, v double")
    scorers = [EV.Scorer("present", F.col("v").isNotNull(), F.concat(F.lit("message of "), "k"), ["mean", "min"]),
               EV.Scorer("size", F.col("v"), F.lit("message"), ["max", "mean"])]
    long = EV.aggregate_scores(EV.score(df, ["run", "k"], scorers), scorers, ["run"])
    wide = EV.score_metrics(df, scorers, ["run"])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, long.collect()))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "message" not in plan and plan.index("Generate") < plan.index("HashAggregate")


def test_large_files_are_read_in_splits(spark, tmp_path):
    """Bytes of a file too large for one row, with and without a line end behind them; a stream sees the same."""
    from quarry.sources import files as FS

    folder = tmp_path / "in put%41"
    folder.mkdir()
    rng = __import__("random").Random(4)
    made = {"a.bin": rng.randbytes(300_000), "b.bin": rng.randbytes(299_999) + b"\n", "c.bin": b"\n" * 70_000, "d.bin": b"x", "f_g.bin": b"\r\n\xff" * 30_000}
    for name, data in made.items():
        (folder / name).write_bytes(data)
    want = sorted((n, len(x), len(x)) for n, x in made.items())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = FS.read_sizes(FS.scan_files(spark, str(folder), "*.bin", content=False), str(folder), whole_bytes=50_000)
        assert sorted(tuple(r)[1:] for r in found.collect()) == want
        found = FS.stream_sizes(spark, str(folder), "*.bin", f"{tmp_path}/out", f"{tmp_path}/checkpoint", whole_bytes=50_000)
        assert sorted((r.file_name, r.file_size, r.content_bytes) for r in found.collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_eval_join_broadcasts_no_side(spark):
    """Neither the catalog nor the manuals goes through the driver, however small their files are."""
    import __spark_entry__ as E
    from tests.conftest import SMALL

    plan = E.queries()["eval_join"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_term_index_shuffles_chunks_only(spark):
    """Postings are counted where their chunk lies; rows of one key and number are still one chunk."""
    import __spark_entry__ as E
    from quarry.operators.retrieval import term_index
    from tests.conftest import SMALL

    plan = E.queries()["term_index"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    made = next(i for i, x in enumerate(lines) if "Generate posexplode" in x)
    assert not [x for x in lines[:made] if "Exchange" in x]
    rows = [(1, 0, "a b a"), (1, 0, "b a c"), (1, 0, "a b"), (None, 0, "z z"), (None, 0, "z y"), (2, 1, ""), (2, 2, "B b! b")]
    got = term_index(spark.createDataFrame(rows, "doc_id long, chunk_no int, text string"))
    assert got.columns == ["term", "doc_id", "chunk_no", "dl", "tf"] and dict(got.dtypes)["tf"] == "bigint"
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("a", 1, 0, 3, 3), ("b", 1, 0, 3, 2), ("c", 1, 0, 3, 1), ("a", 1, 0, 2, 1), ("b", 1, 0, 2, 1),
        ("z", None, 0, 2, 3), ("y", None, 0, 2, 1), ("b", 2, 2, 3, 3)]))


def test_search_makes_no_row_for_a_question_and_a_chunk(spark, monkeypatch):
    """Sums made in the task equal those of a join, with repeated and null keys, null languages, copies and any size of block."""
    import functools

    import __spark_entry__ as E
    from quarry.operators import retrieval as R
    from tests.conftest import SMALL

    plan = E.queries()["passages_english"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not [x for x in plan.splitlines() if "HashAggregate" in x and "item_id" in x and "chunk_no" in x]
    # Questions that want nearly all parts test no row's part.
    assert not [x for x in plan.splitlines() if "Filter" in x and x.count("part#") > R.TERM_PARTS // 2 + 1]
    rng = __import__("random").Random(5)
    langs = ["en", "de", "fr", None]
    rows = [(i // 2 if i % 7 else None, i % 3, rng.choice(langs), " ".join(rng.choices("abcdefghij", k=rng.randint(0, 9)))) for i in range(200)]
    rows += [(900 + i, 0, langs[i % 4], "a b c") for i in range(40)]
    postings = R.term_index(spark.createDataFrame(rows, "doc_id long, chunk_no int, lang string, text string"), keep=["lang"])
    asked = [(1, "a b c"), (2, "j"), (None, "b zz i"), (3, None), (2, "c"), (4, "zz"), (5, "a b c d e f g h i j")]
    questions = spark.createDataFrame(asked, "item_id long, text string")
    for prefer in (None, ("lang", "en"), ("lang", "it")):
        for k in (1, 3, 1000):
            got = [sorted(map(str, R.search(questions, "item_id", "text", postings, k=k, prefer=prefer).collect()))]
            with monkeypatch.context() as m:
                m.setattr(R, "_best_of_tasks", functools.partial(R._best_of_tasks, pairs_at_once=11))
                got.append(sorted(map(str, R.search(questions, "item_id", "text", postings, k=k, prefer=prefer).collect())))
                m.setattr(R, "fits_broadcast", lambda df: False)
                want = sorted(map(str, R.search(questions, "item_id", "text", postings, k=k, prefer=prefer).collect()))
            assert want and got == [want, want], (prefer, k)
    assert R.search(questions.filter("item_id = 3"), "item_id", "text", postings).count() == 0
