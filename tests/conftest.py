import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mentions.schemas import TABLES  # noqa: E402
from mentions.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, app="mentions-tests")


def table(spark, name, rows):
    return spark.createDataFrame(rows, TABLES[name])


@pytest.fixture(scope="session")
def concepts(spark):
    return table(spark, "concepts", [
        (0, 0, "Lenovo", 1, 0.4, "brand"),
        (0, 1, "Samsung", 1, 0.5, "brand"),
        (0, 1, "Lenovo", 2, 1.0, "brand"),
        (0, 1, "VisualAppearance", 2, 0.1, "feature"),
    ])


@pytest.fixture(scope="session")
def surface_strings(spark):
    return table(spark, "concepts_surface_strings", [
        (0, 0, "Lenovo", "lenovo", "0-6"),
        (0, 1, "Lenovo", "lenlen", "2-8"),
        (0, 1, "Samsung", "samsung", "9-16"),
    ])


@pytest.fixture(scope="session")
def idf_concepts(spark):
    return table(spark, "concepts", [
        (0, 0, "Lenovo", 1, 0.9, "brand"), (0, 0, "BMW", 1, 1.0, "brand"), (1, 0, "Samsung", 1, 0.33, "brand"),
        (1, 0, "Lenovo", 1, 0.89, "brand"), (2, 0, "Lenovo", 2, 0.45, "brand"),
        (2, 1, "VisualAppearance", 2, 0.99, "feature"), (3, 0, "VisualAppearance", 2, 0.121, "feature"),
    ])


@pytest.fixture(scope="session")
def absa_tables(spark):
    ents = table(spark, "absa_entities", [
        (0, 0, "Lenovo", "brand", "lenovo", "4-9"),
        (0, 1, "VisualAppearance", "feature_subjective", "looks", "0-4"),
        (0, 1, "Samsung", "brand", "samsung", "15-21"),
        (0, 1, "Lenovo", "brand", "Lenovo", "154-159"),
        (0, 1, "Lenovo", "brand", "Lenovo", "210-215"),
        (0, 1, "VisualAppearance", "feature_subjective", "looks", "30-34"),
    ])
    texts = table(spark, "absa_normalized_texts", [(0, 0, "Hey lenovo"), (0, 1, "安全性能很好，很帅气。")])
    rels = table(spark, "absa_relations", [
        (0, 0, 0, "", "", 2.0, False, "安全", "0-2"),
        (0, 0, 1, "", "", 3.5, False, "很帅气", "7-10"),
        (0, 1, 0, "", "", 1.0, False, "安全", "0-2"),
        (0, 1, 1, "", "", 2.5, False, "很帅气", "7-10"),
    ])
    rel_ents = table(spark, "absa_relations_entities", [
        (0, 0, 0, "feature_quantitative", "Safety"),
        (0, 0, 0, "feature_objective", "Hardiness"),
        (0, 0, 1, "feature_subjective", "VisualAppearance"),
        (0, 1, 0, "feature_quantitative", "Safety"),
        (0, 1, 1, "feature_subjective", "VisualAppearance"),
    ])
    return {"absa_entities": ents, "absa_normalized_texts": texts, "absa_relations": rels,
            "absa_relations_entities": rel_ents}


# Nested analyses: two texts of each call.
CONCEPTS_JSON = [
    [{"concept": "Lenovo", "surface": [{"surface_string": "lenovo", "span": [0, 6]}], "freq": 1,
      "relevance_score": 1.0, "type": "brand"}],
    [{"concept": "Samsung", "surface": [{"surface_string": "samsung", "span": [0, 7]}], "freq": 1,
      "relevance_score": 1.0, "type": "brand"}],
]
SENTIMENTS_JSON = [{"sentiment_value": 0.7299562892999195}, {"sentiment_value": 0.6668725094407698}]
ABSA_JSON = [
    {"entities": [{"semantics": [{"type": "feature_subjective", "value": "OperationQuality"}],
                   "surface": {"span": [2, 4], "surface_string": "性能"}}],
     "evaluations": [
         {"semantics": {"entity": [{"type": "feature_quantitative", "value": "Safety"}], "sentiment_value": 2.0},
          "surface": {"span": [0, 2], "surface_string": "安全"}},
         {"semantics": {"entity": [{"type": "feature_subjective", "value": "VisualAppearance"}],
                        "sentiment_value": 3.5},
          "surface": {"span": [7, 10], "surface_string": "很帅气"}}],
     "normalized_text": "安全性能很好，很帅气。",
     "relations": [
         {"external_entity": False,
          "semantics": {"entity": [{"type": "feature_quantitative", "value": "Safety"},
                                   {"type": "feature_subjective", "value": "OperationQuality"}],
                        "opinion_holder": None, "restriction": None, "sentiment_value": 2.0},
          "surface": {"span": [0, 4], "surface_string": "安全性能"}}]},
    {"entities": [{"semantics": [{"type": "feature_subjective", "value": "OperationQuality"}],
                   "surface": {"span": [0, 2], "surface_string": "性能"}}],
     "evaluations": [], "relations": [], "normalized_text": "性能"},
]
CATEGORY_LABELS = [f"label{i:02d}" for i in range(30)]
CATEGORIES_JSON = [[{"label": lab, "probability": 1.0 / (i + 2)} for i, lab in enumerate(CATEGORY_LABELS)]
                   for _ in range(2)]


@pytest.fixture(scope="session")
def analysis():
    return {"concepts": CONCEPTS_JSON, "categories": CATEGORIES_JSON, "sentiment": SENTIMENTS_JSON,
            "absa": ABSA_JSON}
