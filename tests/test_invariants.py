"""Invariants on the driver's sf0.001 tables, plus a property test of the
document-id assignment against a plain running sum."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentions.operators import absa as A
from mentions.operators import concepts as K
from mentions.operators import flatten as FL
from mentions.operators import series as S
from mentions.schemas import ANALYSIS
from mentions.sources.views import load_views
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def views(spark):
    return load_views(spark, SF_SMALL)


def test_shares_sum_to_one(views):
    shares = K.most_common_concepts(views["concepts"], None, normalize=True).agg(F.sum("share")).first()[0]
    assert math.isclose(shares, 1.0, rel_tol=1e-9)
    ent = A.most_common_entities(views["absa_entities"], None, "s", normalize=True).agg(F.sum("share")).first()[0]
    assert math.isclose(ent, 1.0, rel_tol=1e-9)


def test_co_occurrence_is_symmetric(views):
    c = views["concepts"]
    a, b = "Brand#1", "Brand#2"
    with_a = {r[0] for r in K.co_occurring_concepts(c, a, None).collect()}
    with_b = {r[0] for r in K.co_occurring_concepts(c, b, None).collect()}
    assert (b in with_a) == (a in with_b)


def test_time_series_counts_add_up(views):
    names = ["Brand#3", "Brand#7"]
    series = S.concept_time_series(views["concepts"], names, views["date_info"], 30)
    total = series.agg(F.sum("count")).first()[0]
    direct = views["concepts"].filter(F.col("concept").isin(names)).agg(F.sum("freq")).first()[0]
    assert total == direct
    per_name = {r[0]: r[1] for r in series.groupBy("concept").agg(F.count(F.lit(1))).collect()}
    assert len(set(per_name.values())) == 1  # every name has every tick


def test_flatten_row_counts_match_array_sizes(spark):
    from mentions.plans.flatten_queries import nested_orders

    analyses = nested_orders(spark, SF_SMALL)
    flat = FL.flatten_analyses(analyses)
    sizes = analyses.select(
        F.size("absa").alias("texts"),
        F.aggregate(F.transform("absa", lambda t: F.size(t["relations"])), F.lit(0), lambda x, y: x + y)
        .alias("rels")).agg(F.sum("texts"), F.sum("rels")).first()
    assert flat["absa_normalized_texts"].count() == sizes[0]
    assert flat["absa_relations"].count() == sizes[1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=50), st.integers(min_value=0, max_value=4),
                          st.booleans()), min_size=1, max_size=40))
def test_doc_ids_are_a_running_sum(spark, monkeypatch, steps):
    monkeypatch.setattr(FL, "LOW_BITS", 3)
    monkeypatch.setattr(FL, "HIGH_BITS", 6)
    seq, rows, want, running = 0, [], {}, 0
    for gap, n_texts, single in steps:
        seq += gap
        rows.append({"seq": seq, "single_document": single, "concepts": [None] * n_texts})
        want[seq] = running
        running += 1 if single else n_texts
    df = spark.createDataFrame(rows, ANALYSIS)
    assert {r["seq"]: r["doc_base"] for r in FL.assign_doc_ids(df).collect()} == want
