"""Plan-shape checks: no cartesian products, no Python on the hot paths,
bounded top-k, pushed filters and pruned scans."""

import json

import pytest

from mentions.plans import load_all
from tests.conftest import SF_SMALL

QUERIES = {name: q.fn for name, q in load_all().items()}
EXECUTES_WHILE_BUILDING = {"stream_ingest", "stream_concept_counts", "csv_round_trip", "parquet_round_trip"}
PYTHON_ALLOWED = {"batch_texts", "python_filtered_frequencies"}
TOP_K = ["most_common_concepts", "least_common_concepts", "co_occurring_concepts", "frequency_relevance",
         "most_common_entities", "co_occurring_entities", "best_rated_entities", "worst_rated_entities",
         "main_category", "surface_forms", "concept_frequencies"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EXECUTES_WHILE_BUILDING))
def test_no_cartesian_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_ALLOWED:
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
        assert "PythonUDF" not in text


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_is_bounded(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_name_filter_reaches_scan(spark):
    from mentions.operators import concepts as K

    df = spark.read.parquet(f"{SF_SMALL}/part.parquet").selectExpr(
        "p_partkey AS doc_id", "0 AS text_order", "p_brand AS concept", "p_size AS freq",
        "p_retailprice AS relevance_score", "lower(p_type) AS concept_type")
    text = K.concept_frequency(df, ["Brand#1", "Brand#2"], validate=False)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [In(p_brand" in text or "In(p_brand" in text
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    assert "p_name" not in scan  # column pruning: unused columns are not read


def test_python_predicate_runs_on_distinct_names(spark, concepts):
    from mentions.operators import concepts as K

    out = K.concept_frequencies(concepts, concept_filter=lambda s: len(s) < 8 and s.startswith("L"))
    optimised = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    python = [i for i, line in enumerate(optimised) if "ArrowEvalPython" in line]
    # one Python node, and the distinct names are computed below it
    assert len(python) == 1
    below = optimised[python[0] + 1]
    assert below.strip(" :+-").startswith("Aggregate [concept")
    assert [r[0] for r in out.collect()] == ["Lenovo"]


@pytest.mark.parametrize("predicate,passing", [
    (lambda s: s[1:3] == "en", {"Lenovo"}), (lambda s: s[0] == "L", {"Lenovo"}), (lambda s: s + "!" == "Lenovo!", {"Lenovo"}),
    (lambda s: True, {"Lenovo", "Samsung", "VisualAppearance"})])
def test_callable_is_a_python_predicate(concepts, predicate, passing):
    from mentions.operators import concepts as K

    assert {r[0] for r in K.concept_frequencies(concepts, concept_filter=predicate).collect()} == passing


def test_share_reuses_the_counts_exchange(concepts, absa_tables):
    from mentions.operators import absa as A
    from mentions.operators import concepts as K

    for out in (K.most_common_concepts(concepts, normalize=True),
                A.most_common_entities(absa_tables["absa_entities"], normalize=True)):
        out.collect()
        assert "ReusedExchange" in plan(out)


def test_json_is_scanned_once_for_all_tables(spark, analysis, tmp_path):
    from mentions.sources.tables import TableSet

    (tmp_path / "a.json").write_text(json.dumps(dict(analysis, seq=0)) + "\n")
    tables = TableSet.from_json(spark, str(tmp_path)).tables()
    assert len(tables) == 10
    for df in tables.values():
        text = plan(df)
        # the JSON was read once into parquet, with what document ids need: each table reads its columns from there and is map-only
        assert "FileScan json" not in text and text.count("FileScan parquet") == 1
        assert "Exchange" not in text and "Join" not in text and "Window" not in text


def test_bucketed_rating_join_has_no_exchange(spark, absa_tables, tmp_path):
    from mentions.operators import absa as A
    from mentions.sources.bucketed import BucketedSink

    sink = BucketedSink(spark, str(tmp_path), "bucket_test_", 4)
    sink.write({n: absa_tables[n] for n in ("absa_relations", "absa_relations_entities")})
    tables = sink.open()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = A.rated_mentions(tables["absa_relations"], tables["absa_relations_entities"])
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == A.rated_mentions(absa_tables["absa_relations"], absa_tables["absa_relations_entities"]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
