"""Postings: look-ups of one name, and co-occurrence that moves the anchor's texts only."""

import re

import pytest

from mentions.operators import absa as A
from mentions.operators import concepts as K
from mentions.schemas import TABLES
from mentions.sources.bucketed import BucketedSink
from mentions.sources.postings import texts_naming, write_postings


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_text_once_in_any_case_and_no_null(spark, tmp_path):
    rows = [(0, 0, "A"), (0, 0, "a"), (0, 1, "Ä"), (1, 0, None), (2, 0, "ä"), (2, 0, "B")]
    concepts = spark.createDataFrame([(d, t, c, 1, 0.1, "x") for d, t, c in rows], TABLES["concepts"])
    postings = write_postings(concepts, "concept", str(tmp_path / "p"))
    assert sorted(map(tuple, postings.collect())) == [("a", 0, 0), ("b", 2, 0), ("ä", 0, 1), ("ä", 2, 0)]
    assert sorted(map(tuple, texts_naming(postings, "Ä").collect())) == [(0, 1), (2, 0)]
    assert texts_naming(postings, "missing").count() == 0
    assert "EqualTo(name,a)" in plan(texts_naming(postings, "A"))


def test_a_name_is_in_few_files_and_a_hot_name_in_many(spark, tmp_path):
    rows = [(d, 0, f"n{d % 200}", 1, 0.1, "x") for d in range(4000)] + [(d, 0, "hot", 1, 0.1, "x") for d in range(4000)]
    postings = write_postings(spark.createDataFrame(rows, TABLES["concepts"]), "concept", str(tmp_path / "p"), files=8)
    places = {n: postings.where(f"name = '{n}'").select("_metadata.file_path").distinct().count() for n in ("n7", "hot")}
    assert places["n7"] == 1 and places["hot"] >= 3


@pytest.mark.parametrize("anchor", ["Lenovo", "lenovo", "samsung", "none"])
def test_co_occurrence_moves_only_the_anchors_texts(spark, concepts, absa_tables, tmp_path, anchor):
    entities = absa_tables["absa_entities"]
    prefix = f"post_{anchor.lower()}{anchor[0].isupper():d}_"
    sink = BucketedSink(spark, str(tmp_path), prefix, 4)
    sink.write({"concepts": concepts, "absa_entities": entities})
    there = sink.open()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, column, find in (("concepts", "concept", lambda t, **k: K.co_occurring_concepts(t, anchor, **k)),
                                   ("absa_entities", "entity_name", lambda t, **k: A.co_occurring_entities(t, anchor, **k))):
            postings = write_postings(there[name], column, str(tmp_path / f"postings-{name}"))
            got = find(there[name], postings=postings)
            assert list(map(tuple, got.collect())) == list(map(tuple, find({"concepts": concepts, "absa_entities": entities}[name]).collect()))
            join = re.search(r"SortMergeJoin.*", plan(find(there[name], postings=postings)), re.S)[0].splitlines()
            # left: the bucketed table as it lies; right: the anchor's texts, exchanged to its buckets
            exchanges = [i for i, line in enumerate(join) if "Exchange" in line]
            scans = [i for i, line in enumerate(join) if "FileScan" in line]
            assert len(exchanges) == 1 and scans[0] < exchanges[0] < scans[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
