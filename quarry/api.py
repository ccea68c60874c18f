"""Public entry points, one import for users of the library.

    from quarry.api import scan_files, extract, flatten, score, search, ...
"""

from quarry.functions.fieldspec import FieldSpec  # noqa: F401
from quarry.operators.evaluate import (  # noqa: F401
    Scorer, aggregate_scores, compare_runs, completeness, english_compliance, eval_join, eval_records,
    extraction_quality, format_validator, format_validator_raw, grounding, pattern, plausibility, ranges, score,
    score_metrics,
)
from quarry.operators.extract import extract, extract_typed  # noqa: F401
from quarry.operators.flatten import flatten  # noqa: F401
from quarry.operators.logs import chat_history, flatten_responses, response_envelope  # noqa: F401
from quarry.operators.matching import entity_dictionary, entity_match, format_profile, in_dictionary  # noqa: F401
from quarry.operators.parse import pipe_tables, segment_markup, segment_text, to_document  # noqa: F401
from quarry.operators.preview import json_preview, variant_path  # noqa: F401
from quarry.operators.profiles import merge_profiles, profile, read_profile  # noqa: F401
from quarry.operators.questions import (  # noqa: F401
    above, at_value, best_by_group, compare_by, compatible_with, differences, lightest, lookup, spec_sheet, top_by,
)
from quarry.operators.ranking import first_by, top_with_ties  # noqa: F401
from quarry.operators.retrieval import chunk, new_rows, search, term_dictionary, term_index  # noqa: F401
from quarry.operators.segments import PassageIndex, compact, read_index, sync  # noqa: F401
from quarry.operators.sections import sections  # noqa: F401
from quarry.plans.catalog import extract_stage, process_stage  # noqa: F401
from quarry.plans.specs import PROCESSED_SCHEMA, PRODUCT_SPEC  # noqa: F401
from quarry.sources.files import file_inventory, scan_files, stream_files  # noqa: F401
from quarry.sources.payloads import ingest_payloads  # noqa: F401
from quarry.sources.tables import append_metrics, column_comments, ensure_namespace, materialize, save_table  # noqa: F401
from quarry.streaming.pipeline import run_pipeline, run_stage, stream_table  # noqa: F401
from quarry.streaming.replace import sync_latest  # noqa: F401
