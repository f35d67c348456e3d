import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from mentions.errors import NoRelevantData
from mentions.operators import concepts as K
from mentions.operators import corpus as P
from mentions.operators import series as S
from mentions.sources.tables import TableSet


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_concept_frequency(concepts):
    assert rows(K.concept_frequency(concepts, ["Lenovo", "NotHere"])) == [(0, "Lenovo", 3), (1, "NotHere", 0)]
    share = rows(K.concept_frequency(concepts, ["Lenovo", "NotHere"], normalize=True))
    assert share == [(0, "Lenovo", 0.5), (1, "NotHere", 0.0)]


def test_concept_frequency_typed_share(concepts):
    share = rows(K.concept_frequency(concepts, ["Lenovo", "Samsung"], concept_type="brand", normalize=True))
    assert share == [(0, "Lenovo", 0.75), (1, "Samsung", 0.25)]


def test_concept_frequency_single_name_and_duplicates(concepts):
    assert rows(K.concept_frequency(concepts, "Lenovo")) == [(0, "Lenovo", 3)]
    assert rows(K.concept_frequency(concepts, ["Lenovo", "Lenovo"])) == [(0, "Lenovo", 3), (1, "Lenovo", 3)]


def test_unknown_concept_type_raises(concepts):
    with pytest.raises(ValueError):
        K.most_common_concepts(concepts, concept_type="nope")


def test_most_and_least_common(concepts):
    assert rows(K.most_common_concepts(concepts, 2)) == [("Lenovo", 3, 1), ("VisualAppearance", 2, 2)]
    assert rows(K.least_common_concepts(concepts, 2)) == [("Samsung", 1, 1), ("VisualAppearance", 2, 2)]


def test_most_least_all_same_set(concepts):
    most = {r[0] for r in K.most_common_concepts(concepts, None).collect()}
    least = {r[0] for r in K.least_common_concepts(concepts, None).collect()}
    assert most == least == {"Lenovo", "Samsung", "VisualAppearance"}


def test_shares_sum_to_one(concepts):
    total = sum(r["share"] for r in K.most_common_concepts(concepts, None, normalize=True).collect())
    assert math.isclose(total, 1.0)


def test_negative_n_rejected(concepts):
    with pytest.raises(ValueError):
        K.most_common_concepts(concepts, -1)


def test_co_occurring(concepts):
    assert [r[0] for r in K.co_occurring_concepts(concepts, "lenovo", 1).collect()] == ["VisualAppearance"]
    assert [r[0] for r in K.co_occurring_concepts(concepts, "lenovo", 1, "brand").collect()] == ["Samsung"]
    assert K.co_occurring_concepts(concepts, "unknown").count() == 0


def test_co_occurring_multiplicity(spark):
    from tests.conftest import table

    df = table(spark, "concepts", [(0, 0, "A", 1, 1.0, "t"), (0, 0, "A", 1, 1.0, "t"), (0, 0, "B", 2, 1.0, "t")])
    assert rows(K.co_occurring_concepts(df, "a")) == [("B", 2, 1)]
    assert rows(K.co_occurring_concepts(df, "a", dedupe=False)) == [("B", 4, 1)]


def test_frequency_relevance(concepts):
    got = [(c, f, round(r, 6)) for c, f, r, _ in K.frequency_relevance(concepts).collect()]
    assert got == [("Lenovo", 3, 0.7), ("Samsung", 1, 0.5), ("VisualAppearance", 2, 0.1)]
    looked = rows(K.frequency_relevance(concepts, ["Samsung", "NotHere"]))
    assert [(c, f) for _, c, f, _r in looked] == [("Samsung", 1)]


def test_surface_forms(surface_strings):
    assert {r[0] for r in K.surface_forms(surface_strings, "Lenovo").collect()} == {"lenovo", "lenlen"}
    assert [r[0] for r in K.surface_forms(surface_strings, "LENOVO", 1).collect()] == ["lenovo"]


def test_concept_frequencies_with_filters(concepts):
    assert rows(K.concept_frequencies(concepts, 2)) == [("VisualAppearance", 2), ("Lenovo", 3)]
    only_s = K.concept_frequencies(concepts, concept_filter=lambda name: name.startswith("S"))
    assert rows(only_s) == [("Samsung", 1)]
    col_filter = K.concept_frequencies(concepts, concept_filter=F.col("concept").startswith("V"))
    assert rows(col_filter) == [("VisualAppearance", 2)]


def test_idf_values_and_order(idf_concepts):
    got = {c: v for c, _, v in P.idf(idf_concepts).collect()}
    assert math.isclose(got["Lenovo"], math.log(4 / 3))
    assert math.isclose(got["VisualAppearance"], math.log(2))
    assert math.isclose(got["Samsung"], math.log(4)) and math.isclose(got["BMW"], math.log(4))
    looked = rows(P.idf(idf_concepts, names=["Lenovo", "NotHere"]))
    assert looked[1] == (1, "NotHere", 0.0)


def test_idf_filter(idf_concepts):
    keep = P.idf_filter(idf_concepts, math.log(2))
    out = {r[0] for r in K.concept_frequencies(idf_concepts, concept_filter=keep).collect()}
    assert out == {"VisualAppearance", "Samsung", "BMW"}


def test_concept_bags(idf_concepts):
    bags = {(d, c): (n, tf) for d, c, n, tf in P.concept_bags(idf_concepts).collect()}
    assert bags[(2, "Lenovo")] == (2, 0.5)
    assert bags[(0, "BMW")] == (1, 0.5)


@pytest.fixture(scope="module")
def time_data(spark):
    from tests.conftest import table

    concepts = table(spark, "concepts", [
        (0, 0, "Lenovo", 1, 1.0, "brand"), (0, 0, "BMW", 1, 1.0, "brand"), (1, 0, "Samsung", 1, 1.0, "brand"),
        (1, 0, "Lenovo", 1, 1.0, "brand"), (2, 0, "Lenovo", 2, 1.0, "brand"), (3, 0, "Samsung", 2, 1.0, "brand"),
        (3, 1, "Lenovo", 1, 1.0, "brand"), (4, 0, "Samsung", 10, 1.0, "brand"), (4, 0, "Lenovo", 10, 1.0, "brand"),
    ])
    dates = spark.createDataFrame(
        [(0, dt.date(2016, 1, 1)), (1, dt.date(2016, 1, 5)), (2, dt.date(2016, 1, 18)), (3, dt.date(2016, 1, 21)),
         (4, dt.date(2016, 2, 1))], "doc_id long, doc_date date")
    return concepts, dates


@pytest.mark.parametrize("days,start,stop,counts", [
    (7, dt.date(2016, 1, 1), dt.date(2016, 1, 21), [2, 0, 3, 1, 0, 2]),
    (16, dt.date(2016, 1, 1), dt.date(2016, 1, 21), [2, 13, 1, 12]),
    (32, dt.date(2016, 1, 1), dt.date(2016, 1, 2), [15, 13]),
    (2, dt.date(2016, 1, 18), dt.date(2016, 1, 21), [2, 1, 0, 2]),
])
def test_time_series(time_data, days, start, stop, counts):
    concepts, dates = time_data
    out = S.concept_time_series(concepts, ["Lenovo", "Samsung"], dates, dt.timedelta(days=days), (start, stop))
    got = out.collect()
    half = len(counts) // 2
    assert [r["concept"] for r in got] == ["Lenovo"] * half + ["Samsung"] * half
    assert [r["count"] for r in got] == counts
    assert got[0]["start"] == start and got[0]["stop"] == start + dt.timedelta(days=days)


def test_time_series_default_interval_and_missing_dates(time_data, spark):
    concepts, dates = time_data
    out = S.concept_time_series(concepts, ["Lenovo"], dates, 7).collect()
    assert out[0]["start"] == dt.date(2016, 1, 1)
    assert sum(r["count"] for r in out) == 15
    partial = dates.filter(F.col("doc_id") != 4)
    with pytest.raises(S.MissingDates, match="no date for document 4"):
        S.concept_time_series(concepts, ["Lenovo"], partial, 7)
    dropped = S.concept_time_series(concepts, ["Lenovo"], partial, 7, missing_dates="drop").collect()
    assert sum(r["count"] for r in dropped) == 5
    one = S.concept_time_series(concepts, ["Lenovo"], partial, 7, missing_dates="drop")
    assert one.count() == len(dropped) and one.filter("ord IS NULL").count() == 0
    twice = dates.unionByName(dates)  # a document has one date
    assert sum(r["count"] for r in S.concept_time_series(concepts, ["Lenovo"], twice, 7).collect()) == 15


def test_time_series_bad_delta(time_data):
    concepts, dates = time_data
    with pytest.raises(ValueError):
        S.concept_time_series(concepts, ["Lenovo"], dates, 0)
    with pytest.raises(ValueError):
        S.concept_time_series(concepts, ["Lenovo"], dates, dt.timedelta(hours=5))


def test_facade_and_missing_data(concepts, surface_strings):
    ts = TableSet(concepts=concepts, concepts_surface_strings=surface_strings)
    assert ts.concepts.most_common_concepts(1).collect()[0]["concept"] == "Lenovo"
    with pytest.raises(NoRelevantData):
        _ = ts.absa
    with pytest.raises(NoRelevantData):
        TableSet(concepts_surface_strings=surface_strings).concepts.most_common_concepts()


def test_time_series_from_dict(time_data):
    concepts, _ = time_data
    dates = {0: dt.date(2016, 1, 1), 1: dt.date(2016, 1, 5), 2: dt.date(2016, 1, 18), 3: dt.date(2016, 1, 21),
             4: dt.date(2016, 2, 1)}
    out = S.concept_time_series(concepts, ["Lenovo", "Samsung"], dates, dt.timedelta(days=7),
                                (dt.date(2016, 1, 1), dt.date(2016, 1, 21)))
    assert [r["count"] for r in out.collect()] == [2, 0, 3, 1, 0, 2]
