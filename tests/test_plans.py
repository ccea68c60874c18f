"""Plan checks: core queries stay in the JVM and never form a cartesian product."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

CORE = ["top_torque", "typed_flatten", "extract_fields", "format_check", "scores_long", "passages",
        "entity_match", "pipe_tables", "segment_markup", "flatten_responses", "chat_history", "model_differences"]


@pytest.mark.parametrize("key", CORE)
def test_no_python_udf_no_cartesian(spark, key):
    df = E.queries()[key](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (key, bad)


def test_catalog_filters_reach_the_scan(spark):
    df = E.queries()["speed_above"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(no_load_speed_high_rpm), GreaterThan(no_load_speed_high_rpm,1800)]" in plan


def test_passages_top_k_is_partial(spark):
    df = E.queries()["passages"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", ["term_index", "english_sections", "pipe_tables", "chunks", "segment_markup"])
def test_generated_arrays_are_built_once(spark, key):
    """No Filter re-evaluates a tokenizer or regex array below the generator that explodes it."""
    plan = E.queries()[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Filter" in line.split("[")[0]:
            assert "split(" not in line and "regexp_extract_all(" not in line, (key, line[:200])


def test_english_rule_tokenizes_each_document_once(spark):
    plan = E.queries()["english_rule"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(lower(text") == 1
