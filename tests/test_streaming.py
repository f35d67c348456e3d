import datetime as dt

from pyspark.sql import functions as F

from mentions.schemas import ANALYSIS
from mentions.sources.tables import TableSet
from mentions.streaming.counts import windowed_concept_counts
from mentions.streaming.ingest import ingest_batch, ingested_ids, start_ingest


def test_ingest_continues_ids_and_is_idempotent(spark, analysis, tmp_path):
    target = str(tmp_path / "out")
    first = spark.createDataFrame([dict(analysis, seq=0)], ANALYSIS)
    second = spark.createDataFrame([dict(analysis, seq=1)], ANALYSIS)
    ingest_batch(first, 0, target)
    ingest_batch(second, 1, target)
    ingest_batch(second, 1, target)  # replay of batch 1
    tables = TableSet.from_path(spark, target)
    assert sorted({r[0] for r in tables["sentiments"].collect()}) == [0, 1, 2, 3]
    assert tables["categories"].count() == 120
    assert sorted(tuple(r) for r in ingested_ids(spark, target).select("batch", "next_id").collect()) == [
        (0, 2), (1, 4)]


def test_stream_ingest_from_files(spark, analysis, tmp_path):
    import json

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text(json.dumps(dict(analysis, seq=0)) + "\n")
    target, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    start_ingest(spark, str(src), target, ckpt).awaitTermination()
    (src / "b.json").write_text(json.dumps(dict(analysis, seq=1)) + "\n")
    start_ingest(spark, str(src), target, ckpt).awaitTermination()
    tables = TableSet.from_path(spark, target)
    assert sorted(r[0] for r in tables["concepts"].collect()) == [0, 1, 2, 3]


def test_windowed_counts_batch_and_stream(spark, tmp_path):
    rows = [("A", 1, dt.datetime(2016, 1, 1)), ("A", 2, dt.datetime(2016, 1, 9)), ("B", 5, dt.datetime(2016, 1, 2)),
            (None, 7, dt.datetime(2016, 1, 2))]
    df = spark.createDataFrame(rows, "concept string, freq long, ts timestamp_ntz")
    got = sorted(tuple(r) for r in windowed_concept_counts(df, dt.timedelta(days=7), dt.date(2016, 1, 1), watermark=None).collect())
    assert got == [("A", dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 8), 1),
                   ("A", dt.datetime(2016, 1, 8), dt.datetime(2016, 1, 15), 2),
                   ("B", dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 8), 5)]
    src = str(tmp_path / "src")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    counts = windowed_concept_counts(stream, dt.timedelta(days=7), dt.date(2016, 1, 1), watermark=None)
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("wc")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("wc").collect()) == got
    assert spark.table("wc").agg(F.sum("count")).first()[0] == 8


def test_append_mode_emits_closed_windows(spark, tmp_path):
    schema = "concept string, freq long, ts timestamp_ntz"
    src = tmp_path / "late"
    first = [("A", 1, dt.datetime(2016, 1, 2)), ("A", 1, dt.datetime(2016, 1, 20))]
    second = [("A", 5, dt.datetime(2016, 1, 3)), ("A", 1, dt.datetime(2016, 1, 30))]  # 01-03 is late
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(str(src / "b1"))
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(str(src / "b2"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src)))
    counts = windowed_concept_counts(stream, dt.timedelta(days=7), dt.date(2016, 1, 1), watermark="1 day")
    q = (counts.writeStream.outputMode("append").format("memory").queryName("late_wc")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = dict((r["start"], r["count"]) for r in spark.table("late_wc").collect())
    # Append mode emits a window once the watermark (max event time - 1 day)
    # has passed its end: the window of 01-29 is still open. Spark keeps all
    # rows within the watermark; older rows may or may not be counted.
    assert set(got) == {dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 15)}
    assert got[dt.datetime(2016, 1, 15)] == 1 and got[dt.datetime(2016, 1, 1)] in (1, 6)


def test_readers_see_committed_batches_only(spark, analysis, tmp_path):
    target = str(tmp_path / "out")
    ingest_batch(spark.createDataFrame([dict(analysis, seq=0)], ANALYSIS), 0, target)
    ingest_batch(spark.createDataFrame([dict(analysis, seq=1)], ANALYSIS), 1, target)
    import shutil

    shutil.rmtree(f"{target}/_ids/batch=1")  # as if the second batch had failed before its record
    assert sorted(r[0] for r in TableSet.from_path(spark, target)["sentiments"].collect()) == [0, 1]
    ingest_batch(spark.createDataFrame([dict(analysis, seq=1)], ANALYSIS), 1, target)
    assert sorted(r[0] for r in TableSet.from_path(spark, target)["sentiments"].collect()) == [0, 1, 2, 3]


def test_ingest_writes_only_calls_that_occur(spark, analysis, tmp_path):
    target = str(tmp_path / "out")
    ingest_batch(spark.createDataFrame([{"seq": 0, "concepts": analysis["concepts"]}], ANALYSIS), 0, target)
    tables = TableSet.from_path(spark, target)
    assert tables.names() == ["concepts", "concepts_surface_strings"]


def test_malformed_line_fails_the_stream(spark, tmp_path):
    import pytest

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text('{"seq": 0, "concepts": [[{"concept": "A"\n')
    query = start_ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    with pytest.raises(Exception):
        query.awaitTermination()


def _json_rows(rows):
    return sorted(map(repr, rows.collect()))


def test_ingest_stores_analyses_once_and_removes_them(spark, analysis, tmp_path, monkeypatch):
    """The nested rows of a batch are stored once, tables are written without shuffling them, and nothing of them is left."""
    from tests.test_plans import plan

    from mentions.operators import flatten as FL
    from mentions.session import scratch_run
    from mentions.sources.tables import children
    from mentions.streaming import ingest

    seen, real = [], ingest._write

    def watched(staged, *args):
        table = staged.tables()["absa_relations"]
        seen.extend([staged.rows.inputFiles(), plan(table)])
        assert table.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))  # not four times as many
        return real(staged, *args)
    monkeypatch.setattr(ingest, "_write", watched)
    target = str(tmp_path / "out")
    batch = spark.createDataFrame([dict(analysis, seq=s) for s in (7, 3, -1, 5)], ANALYSIS).repartition(3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with scratch_run(spark) as scratch:
            ingest_batch(batch, 0, target)
            assert children(spark, scratch) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    files, shown = seen
    assert all("/dealt/" in f or "/places/" in f for f in files) and "Exchange" not in shown and "Sort" not in shown
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("staged_", "places_"))]
    tables = TableSet.from_path(spark, target)
    want = FL.stage_analyses(batch).tables()
    assert tables.names() == list(want)
    for name, rows in want.items():
        assert _json_rows(tables[name]) == _json_rows(rows), name


def test_batch_with_repeated_seq_is_refused(spark, analysis, tmp_path):
    import pytest

    for seqs, said in (([4, 4], "seq 4 occurs more than once"), ([1, None], "1 analyses without seq")):
        with pytest.raises(ValueError, match=said):
            ingest_batch(spark.createDataFrame([dict(analysis, seq=s) for s in seqs], ANALYSIS), 0, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_batch_is_not_committed_if_a_table_fails(spark, analysis, tmp_path, monkeypatch):
    import pytest

    from mentions.operators import flatten as FL

    target = str(tmp_path / "out")
    batch = spark.createDataFrame([dict(analysis, seq=0)], ANALYSIS)
    with monkeypatch.context() as m:
        m.setitem(FL.FLATTENERS, "sentiments", lambda rows, real=FL.flatten_sentiments: real(rows).filter(F.raise_error(F.lit("disk full")).isNull()))
        with pytest.raises(Exception, match="disk full"):
            ingest_batch(batch, 0, target)
    assert ingested_ids(spark, target).count() == 0
    ingest_batch(batch, 0, target)
    assert TableSet.from_path(spark, target)["sentiments"].count() == 2


def test_lines_are_not_shuffled_by_supplier(spark):
    """Small suppliers are broadcast: a join of them with the nations is taken for a large table, and was shuffled with all lines."""
    from tests.conftest import SF_SMALL
    from tests.test_plans import plan

    from mentions.plans import flatten_queries as FQ
    from mentions.sources.views import Raw

    assert "suppkey" in plan(FQ._lines(Raw(spark, SF_SMALL))) and "hashpartitioning(l_suppkey" not in plan(FQ._lines(Raw(spark, SF_SMALL)))


def test_range_of_orders_is_found_without_nesting(spark):
    from tests.conftest import SF_SMALL

    from mentions.plans import flatten_queries as FQ

    analyses = FQ.build_nested_orders(spark, SF_SMALL)
    assert FQ.seq_range(spark, SF_SMALL) == tuple(analyses.agg(F.min("seq"), F.max("seq")).first())


def test_json_is_packed_for_speed_or_size(spark, tmp_path):
    from mentions.plans.flatten_queries import write_json
    from mentions.sources.tables import read_analyses

    rows = spark.range(20_000).select(F.col("id").alias("seq"), F.array(F.struct(F.sin("id").alias("sentiment_value"))).alias("sentiment")).coalesce(1)
    size = {}
    for level in ("DEFAULT_COMPRESSION", "BEST_SPEED"):
        path = tmp_path / level
        write_json(rows, str(path), level)
        size[level] = sum(f.stat().st_size for f in path.glob("*.json.gz"))
        assert _json_rows(read_analyses(spark, str(path)).select("seq", "sentiment")) == _json_rows(rows)
    assert 0 < size["DEFAULT_COMPRESSION"] < size["BEST_SPEED"]
