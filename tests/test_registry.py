"""One folder, several writers: nothing is lost, shown early or numbered twice."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from mentions.schemas import ANALYSIS, TABLES
from mentions.sources import registry as R
from mentions.sources import sinks
from mentions.sources.sinks import TableSink
from mentions.sources.tables import TableSet
from mentions.streaming.ingest import append_analyses, ingest_batch, start_ingest


def concepts(spark, *rows):
    return spark.createDataFrame([(d, 0, c, 1, 0.5, "brand") for d, c in rows], TABLES["concepts"])


def analyses(spark, *names):
    return spark.createDataFrame([{"seq": i, "concepts": [[{"concept": n, "freq": 1}]]} for i, n in enumerate(names)], ANALYSIS)


def shown(spark, path):
    return sorted((r.doc_id, r.concept) for r in TableSet.from_path(spark, str(path))["concepts"].collect())


def test_append_after_write_keeps_both(spark, tmp_path):
    sink = TableSink(spark, str(tmp_path))
    sink.write({"concepts": concepts(spark, (0, "A"), (1, "A"), (2, "A"))})
    assert sink.append(analyses(spark, "B", "B")) == 1
    assert shown(spark, tmp_path) == [(0, "A"), (1, "A"), (2, "A"), (3, "B"), (4, "B")]
    assert sink.append(analyses(spark, "C")) == 2
    assert shown(spark, tmp_path)[-1] == (5, "C")


def test_rewrite_after_append(spark, tmp_path):
    sink = TableSink(spark, str(tmp_path))
    sink.append(analyses(spark, "X", "Z", "Y"))
    sink.write(sink.open().remove_concepts(["Z"]))
    assert shown(spark, tmp_path) == [(0, "X"), (2, "Y")]
    suffix = sink.backed_up[0].rsplit("_", 1)[-1]
    old = TableSet.from_path(spark, str(tmp_path), backup_suffix=suffix)  # the suffix of an appended set
    assert sorted(r.concept for r in old["concepts"].collect()) == ["X", "Y", "Z"]
    sink.append(analyses(spark, "W"))
    assert shown(spark, tmp_path) == [(0, "X"), (2, "Y"), (3, "W")]
    # a set that ends with removed documents doesn't give their ids again
    sink.write(sink.open().remove_concepts(["W"]))
    sink.append(analyses(spark, "V"))
    assert shown(spark, tmp_path) == [(0, "X"), (2, "Y"), (4, "V")]


def test_append_beside_a_stream(spark, tmp_path):
    target = str(tmp_path)
    ingest_batch(analyses(spark, "s0"), 0, target)
    append_analyses(analyses(spark, "a0", "a1"), target)
    ingest_batch(analyses(spark, "s1"), 1, target)
    ingest_batch(analyses(spark, "s1"), 1, target)  # replayed after its commit
    assert shown(spark, tmp_path) == [(0, "s0"), (1, "a0"), (2, "a1"), (3, "s1")]
    ingest_batch(analyses(spark, "t0"), 0, target, "another stream")
    assert shown(spark, tmp_path)[-1] == (4, "t0")


def test_replay_before_its_commit_keeps_ids(spark, tmp_path, monkeypatch):
    target = str(tmp_path)

    def fail(self, claim):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(R.Registry, "commit", fail)
        with pytest.raises(OSError):
            ingest_batch(analyses(spark, "s0", "s1"), 0, target)
    append_analyses(analyses(spark, "a"), target)
    assert shown(spark, tmp_path) == [(2, "a")]
    with pytest.raises(ValueError, match="instead of 2"):
        ingest_batch(analyses(spark, "s0"), 0, target)
    ingest_batch(analyses(spark, "s0", "s1"), 0, target)
    assert shown(spark, tmp_path) == [(0, "s0"), (1, "s1"), (2, "a")]


def test_stream_goes_on_after_a_rewrite(spark, tmp_path):
    src, target, ckpt = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    for k in range(2):
        (src / f"{k}.json").write_text(json.dumps({"seq": k, "concepts": [[{"concept": f"s{k}", "freq": 1}]]}) + "\n")
        start_ingest(spark, str(src), target, ckpt).awaitTermination()
        sink = TableSink(spark, target)
        sink.write(sink.open())
        ingest_batch(analyses(spark, "again"), k, target, ckpt)  # a replay of what was committed before the rewrite
    assert shown(spark, target) == [(0, "s0"), (1, "s1")]


def test_concurrent_appends_lose_nothing(spark, tmp_path):
    target = str(tmp_path)
    TableSink(spark, target).write({"concepts": concepts(spark, (0, "A"))})
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda k: append_analyses(analyses(spark, f"b{k}", f"b{k}"), target), range(4)))
    assert sorted(numbers) == [1, 2, 3, 4]
    got = shown(spark, tmp_path)
    assert [d for d, _ in got] == list(range(9))
    assert all(got[1 + 2 * k][1] == got[2 + 2 * k][1] for k in range(4))


def test_a_number_is_claimed_once(spark, tmp_path):
    registry = R.Registry(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: registry._create(R.Claim(7, k, k + 1)), range(16)))
    assert sum(won) == 1 and len(registry.claimed()) == 1


def test_an_empty_claim_is_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PATIENCE", 0.3)
    (tmp_path / R.CLAIMS).mkdir()
    (tmp_path / R.CLAIMS / "000000000.json").write_text("")
    with pytest.raises(TimeoutError, match="remove"):
        append_analyses(analyses(spark, "A"), str(tmp_path))


def test_folder_of_committed_batches_without_claims(spark, tmp_path):
    """As written before there were claims."""
    concepts(spark, (0, "A"), (1, "B")).write.parquet(f"{tmp_path}/concepts.parquet/batch=0")
    spark.createDataFrame([(2,)], "next_id long").write.parquet(f"{tmp_path}/{R.IDS}/batch=0")
    append_analyses(analyses(spark, "C"), str(tmp_path))
    assert shown(spark, tmp_path) == [(0, "A"), (1, "B"), (2, "C")]


def test_a_write_is_a_fresh_set(spark, tmp_path):
    sink = TableSink(spark, str(tmp_path))
    sentiments = spark.createDataFrame([(i, 0, 0.1) for i in range(3)], TABLES["sentiments"])
    sink.write({"concepts": concepts(spark, (0, "A"), (1, "A"), (2, "A")), "sentiments": sentiments})
    sink.write({"concepts": concepts(spark, (0, "B"))})
    assert sink.open().names() == ["concepts"] and shown(spark, tmp_path) == [(0, "B")]
    assert sorted(n.split("_")[0] for n in sink.backed_up) == ["concepts.parquet", "sentiments.parquet"]


def test_a_failed_write_leaves_the_set_as_it_was(spark, tmp_path, monkeypatch):
    sink = TableSink(spark, str(tmp_path))
    sentiments = spark.createDataFrame([(0, 0, 0.1)], TABLES["sentiments"])
    sink.write({"concepts": concepts(spark, (0, "A")), "sentiments": sentiments})
    sink.append(analyses(spark, "B"))
    real, calls = sinks.move, []

    def failing(spark_, src, dst):
        calls.append(src)
        if "_staging_" in src and src.endswith("sentiments.parquet"):
            raise OSError("no space")
        real(spark_, src, dst)

    with monkeypatch.context() as m:
        m.setattr(sinks, "move", failing)
        with pytest.raises(OSError, match="no space"):
            sink.write({"concepts": concepts(spark, (0, "new")), "sentiments": sentiments})
    assert shown(spark, tmp_path) == [(0, "A"), (1, "B")]
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name or "parquet_" in p.name]
    assert sink.append(analyses(spark, "C")) == 2
    assert spark.read.parquet(f"{tmp_path}/{R.IDS}").agg(F.max("next_id")).first()[0] == 3
