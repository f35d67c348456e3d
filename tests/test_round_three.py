"""Sizes of what is shuffled, staged and bucketed."""

import time

import pytest
from pyspark.sql import functions as F

from mentions.operators import flatten as FL
from mentions.plans import flatten_queries as FQ
from mentions.plans import load_all
from mentions.plans.flatten_queries import build_nested_orders
from mentions.plans.registry import rounded
from mentions.schemas import ANALYSIS
from tests.conftest import SF_SMALL
from tests.test_plans import plan


def test_bucketed_rating_query_names_its_tables(spark):
    got = load_all()["best_rated_bucketed"].fn(spark, SF_SMALL)
    assert list(map(tuple, got.collect())) == list(map(tuple, load_all()["best_rated_entities"].fn(spark, SF_SMALL).collect()))


def test_lines_are_shuffled_by_order_once(spark):
    text = plan(build_nested_orders(spark, SF_SMALL).select("concepts", "absa"))
    assert text.count("FileScan parquet") == 4  # lineitem, part, supplier, nation: each once
    assert sum("hashpartitioning(ok" in line for line in text.splitlines()) == 1


def test_rows_of_a_group_are_found_once(spark):
    """Lists are searched for texts, concepts and line numbers once each, and for what is not NULL: not again for each use."""
    text = build_nested_orders(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("filter(") <= 6


def test_nesting_of_repeated_lines_and_missing_values(spark, tmp_path):
    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put("nation", "n_nationkey int, n_name string", [(1, "PERU")])
    put("supplier", "s_suppkey long, s_nationkey int", [(5, 1)])
    put("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        [(1, "b", "Brand#1", "Big", 4), (2, "a", "Brand#1", "Big", 2), (3, None, None, None, None)])
    put("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string",
        [(7, 2, 1, 5, 3.0, 0.2, 0.1, "R", "O"), (7, 2, 2, 6, 4.0, None, 0.0, "A", "F"), (7, 1, 3, 5, None, None, None, None, None),
         (7, 5, 1, 5, 1.0, 0.1, 0.1, "N", "F")])
    got = build_nested_orders(spark, str(tmp_path)).collect()[0].asDict(recursive=True)
    first = got["concepts"][0]
    assert [(c["concept"], c["type"], c["freq"], c["relevance_score"]) for c in first] == [(None, None, None, None), ("Brand#1", "big", 7, 0.2)]
    assert first[1]["surface"] == [{"surface_string": "a", "span": [2, 4]}, {"surface_string": "b", "span": [2, 6]}]
    assert got["sentiment"] == [{"sentiment_value": 0.2}, {"sentiment_value": 0.1}]
    one, two = got["absa"][0]["relations"]
    assert one["semantics"] == {"entity": [{"type": None, "value": None}, {"type": "nation", "value": "PERU"}],
                                "opinion_holder": None, "restriction": None, "sentiment_value": None}
    big = {"type": "big", "value": "Brand#1"}
    assert two["semantics"] == {"entity": [big, big, {"type": "nation", "value": "PERU"}], "opinion_holder": "A", "restriction": "F",
                                "sentiment_value": 100.0}
    assert two["surface"] == {"span": [2, 4], "surface_string": "a"} and not two["external_entity"]
    assert got["absa"][0]["evaluations"][1]["semantics"]["entity"] == [big, big]
    assert [c["label"] for c in got["categories"][0]] == [None, "big", "big"] and len(got["absa"][1]["entities"]) == 1


def test_spans_need_no_lambda(spark):
    rows = spark.createDataFrame([([1, None, 3],), (None,), ([],)], "s array<int>").select(FL._span(F.col("s")).alias("s"))
    assert [r.s for r in rows.collect()] == ["1-3", None, ""]
    assert "lambda" not in plan(rows)


def test_staging_computes_the_analyses_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = [{"seq": k, "single_document": True, "sentiment": [{"sentiment_value": 1.0}]} for k in range(100)]
    staged = FL.stage_analyses(spark.createDataFrame(rows, ANALYSIS).mapInArrow(count, ANALYSIS))
    assert seen.value == 100
    assert {r.seq: r.doc_base for r in staged.analyses().collect()} == {k: k for k in range(100)}


def test_ids_are_assigned_from_analyses_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = [{"seq": k, "single_document": False, "sentiment": [{"sentiment_value": 1.0}] * 2} for k in range(50)]
    ids = FL.assign_doc_ids(spark.createDataFrame(rows, ANALYSIS).mapInArrow(count, ANALYSIS)).collect()
    assert seen.value == 50 and {r.seq: r.doc_base for r in ids} == {k: 2 * k for k in range(50)}


def test_staged_rows_are_packed_tight(spark, tmp_path, monkeypatch):
    seen, real = [], FL._with_places

    def watched(stored, *args):
        seen.extend(stored.inputFiles())
        return real(stored, *args)
    monkeypatch.setattr(FL, "_with_places", watched)
    rows = [{"seq": k, "single_document": True, "sentiment": [{"sentiment_value": 1.0}]} for k in range(100)]
    staged = FL.stage_analyses(spark.createDataFrame(rows, ANALYSIS), f"{tmp_path}/staged")
    assert staged.used == 100 and seen  # what is stored first, and what stays
    assert all(f.endswith(".zstd.parquet") for f in seen + staged.rows.inputFiles())


def test_staging_checks_seq_and_leaves_no_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for seqs in ([1, None], [3, 3]):
        with pytest.raises(ValueError):
            FL.stage_analyses(spark.createDataFrame([{"seq": s, "single_document": True} for s in seqs], ANALYSIS))
    assert {t.name for t in spark.catalog.listTables()} == before


def test_staged_rows_are_not_shuffled(spark, monkeypatch):
    """Only thin rows are exchanged when analyses get their document ids."""
    seen, real = [], FL._with_places

    def watched(*args):
        df = real(*args)
        with FL._settings(spark, FL._IN_PLACE):
            seen.append(plan(df))
        return df
    monkeypatch.setattr(FL, "_with_places", watched)
    monkeypatch.setattr(FL, "MAX_PARTS", 3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        FL.stage_analyses(spark.createDataFrame([{"seq": k, "sentiment": [{"sentiment_value": 1.0}]} for k in range(50)], ANALYSIS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    wide = seen[0][seen[0].index("ShuffledHashJoin"):].split("FileScan")[0]
    assert "Exchange" not in wide and "Sort" not in wide.replace("SortMergeJoin", "x") and "Bucketed: true" in seen[0]


def test_buckets_grow_with_the_table(spark, monkeypatch):
    from mentions.sources import bucketed

    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 500)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    for name in ("co_occurring_entities_postings", "co_occurring_concepts_postings"):
        got = load_all()[name].fn(spark, SF_SMALL)
        assert f"of {-(-lines // 500)}" in plan(got)
        assert got.collect() == load_all()[name.removesuffix("_postings")].fn(spark, SF_SMALL).collect()


def test_csv_without_line_breaks_is_not_shuffled(spark, tmp_path):
    from mentions.sources.records import csv_records

    (tmp_path / "a.csv").write_text('x,y\r\n1,"a ""q"", b"\r\n\r\n2,c\r\n')
    (tmp_path / "b.csv").write_text('x,y\n3,d\n')
    got = csv_records(spark, str(tmp_path))
    assert "hashpartitioning(file" not in plan(got).split("BroadcastExchange")[0]
    assert sorted((r.record, r.header) for r in got.collect()) == [('1,"a ""q"", b"', False), ("2,c", False), ("3,d", False), ("x,y", True), ("x,y", True)]
    (tmp_path / "c.csv").write_text('x,y\n4,"e\nf"\n')
    got = sorted((r.record, r.header) for r in csv_records(spark, str(tmp_path)).collect())
    assert got[3:5] == [('4,"e\nf"', False), ("x,y", True)] and len(got) == 7


def _shuffle_bytes(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_staging_leaves_no_shuffled_rows(spark, monkeypatch):
    """The shuffle files of the analyses are gone when they are stored, not when the driver collects its garbage."""
    seen, real = [], FL._with_places

    def watched(*args):
        seen.append(_shuffle_bytes(spark))
        return real(*args)
    monkeypatch.setattr(FL, "_with_places", watched)
    text = F.to_json(F.array(F.struct(F.sha2(F.col("id").cast("string"), 512).alias("normalized_text"))))
    rows = spark.range(20_000).select(F.col("id").alias("seq"), F.from_json(text, ANALYSIS["absa"].dataType).alias("absa")).repartition(3, "seq")
    spark._jvm.System.gc()  # what earlier tests left goes now, not in between
    time.sleep(3)
    before = _shuffle_bytes(spark)
    staged = FL.stage_analyses(rows)
    assert staged.used == 20_000
    assert seen[0] - before < 1_000_000  # 128 bytes of text a row


def test_slices_are_staged_one_by_one(spark, monkeypatch):
    """Slices of the orders: no order in two, the same rows in all, the same ids, each computed by a write of its own."""
    whole = FQ.build_nested_orders(spark, SF_SMALL)
    monkeypatch.setattr(FQ, "SLICE_LINES", 1_000)
    slices = FQ.order_slices(spark, SF_SMALL)
    assert len(slices) == FQ.MAX_SLICES
    seqs = [{r.seq for r in s.select("seq").collect()} for s in slices]
    assert all(seqs) and sum(map(len, seqs)) == len(set().union(*seqs)) == whole.count()
    with_all, in_slices = FL.stage_analyses(whole), FL.stage_analyses(slices)
    assert in_slices.used == with_all.used and in_slices.calls == with_all.calls
    for name, table in with_all.tables().items():
        assert sorted(map(repr, rounded(in_slices.tables()[name]).collect())) == sorted(map(repr, rounded(table).collect())), name
    assert sum("xxhash64" in plan(s) for s in slices) == len(slices)
