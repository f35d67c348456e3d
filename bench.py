"""Benchmark of the headline queries.

Runs each headline query over the tables in ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]``: one warm-up pass over
all queries, then ``$BENCH_REPEAT`` timed runs each (median reported).
A run executes the whole plan into Spark's ``noop`` sink (every result row
is produced; none is shipped to Python). Prints one JSON line.

The annotation tables are first derived from the driver's tables and
stored as parquet (``ingest_seconds``, reported apart); the timed queries
read the stored tables.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mentions.plans import load_all  # noqa: E402
from mentions.plans.flatten_queries import materialize_nested  # noqa: E402
from mentions.session import local_session, scratch_dir  # noqa: E402
from mentions.sources.sinks import TableSink  # noqa: E402
from mentions.sources.tables import TableSet  # noqa: E402
from mentions.sources.views import materialize  # noqa: E402

HEADLINE = [
    "most_common_concepts",
    "co_occurring_concepts",
    "best_rated_entities",
    "idf",
    "concept_time_series",
    "flatten_absa_relations",
    "entity_sentiment",
    "tf_idf",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="mentions-bench")
    registry = load_all()

    def run(name: str) -> float:
        # Builds the plan and executes all of it; the rows are discarded in
        # the executors (noop sink) rather than converted to Python objects.
        t0 = time.perf_counter()
        registry[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Ingest once: derive the annotation tables (and the nested analyses the
    # flatten query reads) from the driver's tables and store them as parquet,
    # as a deployment stores its annotation tables; the queries then read them.
    t0 = time.perf_counter()
    folder = scratch_dir(spark, "bench-views")
    materialize(spark, sf_dir, folder)
    materialize_nested(spark, sf_dir, folder)
    ingest_seconds = round(time.perf_counter() - t0, 3)

    # All ten tables from JSON lines: one read of the JSON, then ten writes.
    json_dir = scratch_dir(spark, "bench-json")
    spark.read.parquet(f"{folder}/analyses.parquet").write.json(json_dir)
    t0 = time.perf_counter()
    written = TableSink(spark, scratch_dir(spark, "bench-tables")).write(TableSet.from_json(spark, json_dir))
    json_seconds = round(time.perf_counter() - t0, 3)
    assert len(written) == 10

    rows = {name: registry[name].fn(spark, sf_dir).count() for name in names}  # also the warm-up
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "ingest_seconds": ingest_seconds,
        "json_to_ten_tables_seconds": json_seconds,
        "rows": rows,
        "sf": float(match.group(1)) if match else None,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
