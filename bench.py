"""Headline queries at one scale factor; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the no-op sink (full execution, nothing
collected). The catalog and the term index are built once, as tables, by the
first query that needs them; their build time is reported as its own entry.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import catalog  # noqa: E402
from quarry.plans import queries as Q  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = [
    "extract_fields", "top_torque", "fastest_by_maker", "model_differences", "battery_compatible",
    "scores_long", "run_metrics", "entity_match", "format_profile",
    "segment_text", "segment_markup", "pipe_tables", "parsed_table",
    "passages", "passages_english", "flatten_responses", "chat_history", "json_preview", "payload_ingest",
    "stream_pipeline",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="quarry-bench")
    times: dict[str, float] = {}
    # Untimed warm-up on the smallest data (JVM start, class loading, JIT), not part of any query.
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for key in ("typed_flatten", "passages", "scores_long"):
            run(Q.QUERIES[key](spark, warm))

    t = time.time()
    catalog.manuals_catalog(spark, sf_dir)
    times["catalog_build"] = round(time.time() - t, 3)
    t = time.time()
    Q._index(spark, sf_dir)
    times["index_build"] = round(time.time() - t, 3)

    for key in HEADLINE:
        t = time.time()
        run(Q.QUERIES[key](spark, sf_dir))
        times[key] = round(time.time() - t, 3)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "documents": docs,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
