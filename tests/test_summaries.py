"""Summaries kept by batch answer as the whole tables do."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from mentions.operators import corpus as P
from mentions.operators import series as S
from mentions.operators.frequencies import Frequencies
from mentions.schemas import ANALYSIS, TABLES
from mentions.sources.sinks import TableSink
from mentions.sources.summaries import Summaries
from mentions.sources.tables import TableSet

# doc_id, text_order, concept, freq, relevance, type: two types of one name, no name, nothing but zeros, repeated rows
ROWS = [(d, t, c, f, 0.5, k) for d, t, c, f, k in [
    (0, 0, "A", 2, "brand"), (0, 1, "A", 1, "feature"), (0, 0, "B", 1, "brand"), (0, 0, "B", 1, "brand"), (1, 0, "A", 1, "brand"),
    (2, 0, None, 3, "brand"), (3, 0, "C", 0, "brand"), (3, 0, "C", None, "brand"), (4, 0, "B", 4, "feature"), (5, 0, "A", 1, None),
    (6, 0, "A", 5, "brand"), (6, 0, "D", 1, "brand"), (7, 0, "D", 2, "brand"), (8, 0, "B", 1, "brand"), (8, 0, None, 1, "brand")]]
DAY = dt.date(2020, 1, 30)
DATES = [(d, DAY + dt.timedelta(days=9 * d)) for d in range(9)] + [(3, DAY + dt.timedelta(days=400)), (99, DAY + dt.timedelta(days=120))]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, TABLES["concepts"])


def dates(spark, rows=DATES):
    return spark.createDataFrame(rows, "doc_id long, doc_date date")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    out = Summaries(spark, str(tmp_path_factory.mktemp("kept")))
    for k, (lo, hi) in enumerate(((0, 2), (2, 6), (6, 99), (99, 100))):  # the last one is empty
        assert out.add(k, frame(spark).filter((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)), dates(spark))
    return out


def rows_of(df):
    def short(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(map(short, r)) for r in df.collect()), key=str)


CHANGES = {
    "none": lambda x: x,
    "names": lambda x: x.remove_concepts(["A", "missing"]),
    "twice": lambda x: x.remove_concepts(["A"]).remove_concepts(["A", "D"]),
    "documents": lambda x: x.filter([0, 2, 3, 6, 55]),
    "both": lambda x: x.filter([0, 2, 4, 6, 7, 8]).remove_concepts("D").filter([0, 2, 6, 7, 8]),
}


@pytest.mark.parametrize("change, kind", [("none", ""), ("names", "brand"), ("twice", ""), ("documents", ""), ("both", "brand")])
def test_frequencies_equal_recomputation(spark, kept, change, kind):
    changed = CHANGES[change](TableSet({"concepts": frame(spark)}))["concepts"]
    found = CHANGES[change](Frequencies(kept))
    assert rows_of(found.idf(kind)) == rows_of(P.idf(changed, kind, validate=False))
    assert rows_of(found.concept_bags(kind)) == rows_of(P.concept_bags(changed, kind, validate=False))
    names, threshold = ["D", "A", "none", "A"], 0.9 if kind else 0.0
    assert rows_of(found.idf(kind, names)) == rows_of(P.idf(changed, kind, names, validate=False))
    if change != "documents":
        assert rows_of(found.idf_filter(threshold, kind)) == rows_of(P.idf_filter(changed, threshold, kind, validate=False))


def test_names_and_documents_as_dataframes(spark, kept):
    names = spark.createDataFrame([("A",), (None,)], "concept string")
    ids = spark.createDataFrame([(0,), (0,), (6,), (8,), (None,)], "doc_id long")
    changed = TableSet({"concepts": frame(spark)}).remove_concepts(names).filter(ids)["concepts"]
    assert rows_of(Frequencies(kept).remove_concepts(names).filter(ids).idf()) == rows_of(P.idf(changed))
    with pytest.raises(ValueError):
        Frequencies(kept).filter([])


@pytest.mark.parametrize("delta, interval", [
    (7, None), (dt.timedelta(days=30), (dt.date(2020, 2, 5), dt.date(2020, 4, 1))), (1, (DAY, DAY)),
    (365, (dt.date(2019, 1, 1), dt.date(2020, 3, 1))), (1, (dt.date(2021, 1, 1), dt.date(2020, 1, 1)))])
def test_series_equal_recomputation(spark, kept, delta, interval):
    names = ["B", "A", "none", "A", "C"]
    expected = S.concept_time_series(frame(spark), names, dates(spark), delta, interval)
    assert list(map(tuple, S.series_from_totals(kept, names, delta, interval).collect())) == list(map(tuple, expected.collect()))


def test_series_reads_running_totals_of_the_names_only(spark, kept):
    plan = S.series_from_totals(kept, ["B"], 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "/days/" in plan and "EqualTo(concept,B)" in plan and "LessThan(day" in plan


def test_missing_dates(spark, tmp_path):
    out = Summaries(spark, str(tmp_path))
    some = dates(spark, [(d, v) for d, v in DATES if d != 7] + [(7, None)])
    out.add(0, frame(spark), some)
    with pytest.raises(S.MissingDates, match="'D'"):
        S.series_from_totals(out, ["A", "D"], 7)
    expected = S.concept_time_series(frame(spark), ["D"], some, 7, missing_dates="drop")
    assert S.series_from_totals(out, ["D"], 7, missing_dates="drop").collect() == expected.collect()
    assert S.series_from_totals(out, ["A"], 7).collect() == S.concept_time_series(frame(spark), ["A"], some, 7).collect()
    out.add(1, frame(spark, []))
    with pytest.raises(ValueError, match=r"\[1\] were summarised without dates"):
        S.series_from_totals(out, ["A"], 7)
    with pytest.raises(TypeError):
        out.add(2, frame(spark, []), some.withColumn("doc_date", F.col("doc_date").cast("timestamp")))


def test_nothing_summarised(spark, tmp_path):
    out = Summaries(spark, str(tmp_path))
    assert out.batches() == {}
    assert Frequencies(out).idf().collect() == []
    assert [tuple(r)[-1] for r in S.series_from_totals(out, ["A"], 7).collect()] == [0]


def analyses(spark, *names):
    return spark.createDataFrame([{"seq": i, "concepts": [[{"concept": n, "freq": 1, "type": "brand"}]]} for i, n in enumerate(names)], ANALYSIS)


def test_refresh_reads_new_batches_only_and_a_rewrite_starts_anew(spark, tmp_path):
    sink, out = TableSink(spark, str(tmp_path)), Summaries(spark, str(tmp_path))
    sink.write({"concepts": frame(spark)})
    assert out.refresh(dates(spark)) == [0]
    sink.append(analyses(spark, "A", "Z"))
    more = dates(spark, [(9, DAY), (10, DAY)] + DATES)
    assert out.refresh(more) == [1] and out.refresh(more) == []

    def same():
        whole = sink.open()["concepts"]
        assert rows_of(Frequencies(out).idf()) == rows_of(P.idf(whole))
        assert S.series_from_totals(out, ["A", "Z"], 7).collect() == S.concept_time_series(whole, ["A", "Z"], more, 7).collect()

    same()
    # what is summarised isn't read again
    for f in (tmp_path / "concepts.parquet" / "batch=1").glob("*.parquet"):
        f.rename(f.with_name("_" + f.name))
    assert dict(Frequencies(out).idf().select("concept", "doc_freq").collect())["Z"] == 1
    for f in (tmp_path / "concepts.parquet" / "batch=1").glob("_part*.parquet"):
        f.rename(f.with_name(f.name[1:]))
    sink.write(sink.open().remove_concepts(["B"]))
    assert out.batches() == {} and out.refresh(more) == [0]
    same()


def test_two_writers_of_one_batch(spark, tmp_path):
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda _: Summaries(spark, str(tmp_path)).add(0, frame(spark), dates(spark)), range(2)))
    assert done.count(True) == 1
    assert rows_of(Frequencies(Summaries(spark, str(tmp_path))).idf()) == rows_of(P.idf(frame(spark)))
