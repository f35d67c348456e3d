import pytest

from mentions.operators import absa as A
from mentions.operators import categories as G


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_most_least_common(absa_tables):
    e = absa_tables["absa_entities"]
    assert rows(A.most_common_entities(e, 2)) == [("Lenovo", 3, 1), ("VisualAppearance", 2, 2)]
    assert rows(A.least_common_entities(e, 10, "feature_")) == [("VisualAppearance", 2, 1)]


def test_co_occurring(absa_tables):
    e = absa_tables["absa_entities"]
    assert [r[0] for r in A.co_occurring_entities(e, "lenovo", 1).collect()] == ["VisualAppearance"]
    assert [r[0] for r in A.co_occurring_entities(e, "VisualAppearance", 2).collect()] == ["Lenovo", "Samsung"]


def test_best_worst(absa_tables):
    rel, ents = absa_tables["absa_relations"], absa_tables["absa_relations_entities"]
    assert [r[0] for r in A.best_rated_entities(rel, ents, 19).collect()] == ["VisualAppearance", "Hardiness", "Safety"]
    assert [r[0] for r in A.worst_rated_entities(rel, ents, 5).collect()] == ["Safety", "Hardiness", "VisualAppearance"]


def test_entity_frequency(absa_tables):
    e = absa_tables["absa_entities"]
    assert rows(A.entity_frequency(e, ["Samsung", "VisualAppearance"], "brand")) == [
        (0, "Samsung", 1), (1, "VisualAppearance", 0)]
    assert rows(A.entity_frequency(e, ["Samsung", "VisualAppearance"], "brand", normalize=True)) == [
        (0, "Samsung", 0.25), (1, "VisualAppearance", 0.0)]


def test_entity_texts_and_opinions(absa_tables):
    texts = A.entity_texts(absa_tables["absa_entities"], absa_tables["absa_normalized_texts"], ["Lenovo", "Safety"])
    assert [r["normalized_text"] for r in texts.collect()] == ["Hey lenovo", "安全性能很好，很帅气。"]
    ops = A.opinion_strings(absa_tables["absa_relations"], absa_tables["absa_relations_entities"], ["Safety", "NotHere"])
    assert [(r["entity_name"], r["surface_string"]) for r in ops.collect()] == [("Safety", "安全"), ("Safety", "安全")]


def test_entity_sentiment(absa_tables):
    out = rows(A.entity_sentiment(absa_tables["absa_relations"], absa_tables["absa_relations_entities"],
                                  ["Safety", "VisualAppearance", "Hardiness", "NotHere"]))
    assert out == [(0, "Safety", 1.5), (1, "VisualAppearance", 3.0), (2, "Hardiness", 2.0), (3, "NotHere", None)]


def test_sentinel_and_relation_without_entities(spark, absa_tables):
    from tests.conftest import table

    rel = table(spark, "absa_relations", [(0, 0, 0, None, None, 100.0, False, "x", "0-1"),
                                          (0, 0, 1, None, None, 1.0, False, "y", "1-2"),
                                          (0, 0, 2, None, None, -1.0, False, "z", "2-3")])
    ents = table(spark, "absa_relations_entities", [(0, 0, 0, "t", "A"), (0, 0, 1, "t", "A")])
    assert rows(A.best_rated_entities(rel, ents)) == [("A", 1.0, 1)]
    assert rows(A.worst_rated_entities(rel, ents)) == [("A", 1.0, 1)]


@pytest.fixture(scope="module")
def categories(spark):
    from tests.conftest import table

    return table(spark, "categories", [(0, 0, "music", 0.1), (0, 0, "law", 0.9), (0, 0, "auto", 0.5),
                                       (0, 0, "law", 0.5)])


def test_categories(categories):
    got = [(c, round(p, 6)) for c, p in G.category_profile(categories).collect()]
    assert got == [("law", 0.7), ("auto", 0.5), ("music", 0.1)]
    assert rows(G.main_category(categories)) == [("law",)]


def test_category_pie(categories):
    pie = [(s, lab, round(p, 6)) for s, lab, p in G.category_pie(categories, 2).collect()]
    assert pie == [(0, "Other", 0.1), (1, "Automotive", 0.5), (2, "Law", 0.7)]
    none_left = [(s, lab, round(p, 6)) for s, lab, p in G.category_pie(categories, 6).collect()]
    assert none_left[0] == (0, "Other", 0.0)


def test_average_sentiment(spark):
    from tests.conftest import table

    vals = [0.5, -0.5, 0.5, -1.0, 1.0, 0.5, -0.5, -0.5]
    docs = [0, 0, 0, 1, 2, 2, 2, 2]
    df = table(spark, "sentiments", [(d, 0, v) for d, v in zip(docs, vals)])
    assert G.average_sentiment(df).collect()[0][0] == 0.0
    assert G.average_sentiment(df.limit(0)).collect()[0][0] is None
