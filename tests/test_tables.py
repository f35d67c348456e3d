import datetime as dt

import pytest

from mentions.functions.display import remove_stopwords
from mentions.functions.labels import split_camel_case, type_label
from mentions.operators import concepts as K
from mentions.sources.sinks import TableSink, ViewSink, backup
from mentions.sources.tables import TableSet


def test_lookup_and_errors(concepts):
    ts = TableSet(concepts=concepts)
    assert ts["categories"] is None
    with pytest.raises(KeyError):
        ts["nope"]
    with pytest.raises(ValueError):
        TableSet()


def test_filter_and_remove(spark, concepts, surface_strings):
    from tests.conftest import table

    ts = TableSet(concepts=concepts, concepts_surface_strings=surface_strings)
    with pytest.raises(ValueError):
        ts.filter([])
    assert ts.filter([1]).tables()["concepts"].count() == 0
    assert ts.filter(spark.createDataFrame([(0,)], "doc_id long"))["concepts"].count() == 4
    removed = ts.remove_concepts(["Lenovo"])
    assert {r[0] for r in removed["concepts"].select("concept").collect()} == {"Samsung", "VisualAppearance"}
    assert {r[0] for r in removed["concepts_surface_strings"].select("concept").collect()} == {"Samsung"}
    assert ts["concepts"].count() == 4  # original untouched
    with_null = TableSet(concepts=table(spark, "concepts", [(0, 0, None, 1, 1.0, "t"), (0, 0, "A", 1, 1.0, "t")]))
    assert with_null.remove_concepts(["A"])["concepts"].count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sink_round_trip_and_backup(spark, concepts, absa_tables, tmp_path, fmt):
    root = str(tmp_path / fmt)
    empty = concepts.limit(0)
    sink = TableSink(spark, root, fmt)
    written = sink.write({"concepts": concepts, "categories": empty.selectExpr(
        "doc_id", "text_order", "concept AS category", "relevance_score AS probability"),
        "absa_relations": absa_tables["absa_relations"]})
    assert sorted(written) == ["absa_relations", "concepts"]
    back = TableSet.from_sink(sink)
    assert back["categories"] is None
    assert sorted(tuple(r) for r in back["concepts"].collect()) == sorted(tuple(r) for r in concepts.collect())
    # CSV cannot tell an empty string from a missing value: both read back as NULL.
    expect = [tuple(None if (fmt == "csv" and v == "") else v for v in r)
              for r in absa_tables["absa_relations"].collect()]
    assert sorted(tuple(r) for r in back["absa_relations"].collect()) == sorted(expect)
    moved = backup(spark, root, ["concepts", "sentiments"], fmt, now=dt.datetime(2020, 1, 2, 3, 4, 5))
    ext = "csv" if fmt == "csv" else "parquet"
    assert moved == [f"concepts.{ext}_20200102030405"]
    old = TableSet.from_path(spark, root, fmt, backup_suffix="20200102030405")
    assert old["concepts"].count() == 4 and old["absa_relations"] is None
    with pytest.raises(ValueError):
        TableSet.from_path(spark, str(tmp_path / "nothing"), fmt)


def test_view_sink(spark, concepts):
    sink = ViewSink(spark, prefix="t_")
    assert sink.write({"concepts": concepts, "concepts_surface_strings": concepts.limit(0).selectExpr(
        "doc_id", "text_order", "concept", "concept AS surface_string", "concept AS text_span")}) == ["concepts"]
    assert spark.sql("SELECT count(*) FROM t_concepts").first()[0] == 4
    assert sink.open()["concepts"].count() == 4


@pytest.mark.parametrize("string,exploded", [
    ("ProductType", "Product Type"), ("SmartCar", "Smart Car"), ("BMW", "BMW"), ("Space", "Space"),
    ("Nimbus2000", "Nimbus 2000"), ("24Bank", "24 Bank"), ("TeslaX", "Tesla X"),
    ("Two-WaySolenoidValve", "Two-Way Solenoid Valve"), ("NaSa", "Na Sa"),
])
def test_split_camel_case(spark, string, exploded):
    from pyspark.sql import functions as F

    assert spark.range(1).select(split_camel_case(F.lit(string))).first()[0] == exploded


@pytest.mark.parametrize("value,label", [
    ("feature_subjective", "FeatureSubjective"), ("brand", "Brand"), ("", "Concept"), (None, "Concept"),
])
def test_type_label(spark, value, label):
    from pyspark.sql import functions as F

    assert spark.range(1).select(type_label(F.lit(value).cast("string"))).first()[0] == label


def test_stopwords(concepts):
    freqs = K.concept_frequencies(concepts)
    out = {r[0] for r in remove_stopwords(freqs, ["lenovo", "SAMSUNG"]).collect()}
    assert out == {"VisualAppearance"}


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    from tests.conftest import table

    texts = table(spark, "absa_normalized_texts", [(0, 0, 'He said "fine",\nthen left.'), (0, 1, "安全性能很好，很帅气。")])
    sink = TableSink(spark, str(tmp_path / "csv"), "csv")
    sink.write({"absa_normalized_texts": texts})
    back = TableSet.from_sink(sink)["absa_normalized_texts"]
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in texts.collect())


def test_csv_keeps_number_like_and_na_names(spark, tmp_path):
    from tests.conftest import table

    rows = [(0, 0, "30", 1, 0.5, "brand"), (0, 0, "NA", 2, 0.5, "brand"), (1, 0, "null", 3, None, "brand")]
    sink = TableSink(spark, str(tmp_path / "names"), "csv")
    sink.write({"concepts": table(spark, "concepts", rows)})
    back = sorted(tuple(r) for r in TableSet.from_sink(sink)["concepts"].collect())
    assert back == sorted(rows)


def test_json_input_is_lossless(spark, analysis, tmp_path):
    import json

    def read(name, *lines):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.json").write_text("".join(x + "\n" for x in lines))
        return TableSet.from_json(spark, str(folder))

    good = json.dumps(dict(analysis, seq=0))
    with pytest.raises(ValueError, match="without seq"):
        read("noseq", json.dumps(analysis))
    with pytest.raises(ValueError, match="seq 0 occurs more than once"):
        read("twice", good, good)
    with pytest.raises(Exception, match="(?i)malformed"):
        read("cut", good, good[:40])
    wrong = dict(analysis, seq=1, concepts=[[{"concept": "A", "freq": "two"}]])
    with pytest.raises(Exception, match="(?i)malformed|cannot parse"):
        read("kind", json.dumps(wrong))
    tables = read("whole", json.dumps({"seq": 0, "sentiment": [{"sentiment_value": 1}]}))
    assert tables["sentiments"].collect()[0]["sentiment_value"] == 1.0
    assert tables.names() == ["sentiments"] and not tables.has("concepts")
    with pytest.raises(Exception):
        _ = tables.concepts
    with pytest.raises(ValueError, match="column seq"):
        TableSet.from_analyses(spark.createDataFrame([(None,)], "concepts string"))


def test_results_with_whole_numbers(spark):
    tables = TableSet.from_results(spark, {"sentiment": [{"sentiment_value": 1}]})
    assert [tuple(r) for r in tables["sentiments"].collect()] == [(0, 0, 1.0)]


def test_filter_by_empty_frame(spark, concepts):
    with pytest.raises(ValueError):
        TableSet(concepts=concepts).filter(spark.createDataFrame([], "doc_id long"))


def test_csv_goes_by_header(spark, tmp_path):
    folder = tmp_path / "sentiments.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("text_order,doc_id,sentiment_value\n1,7,0.5\n")
    row = TableSet.from_path(spark, str(tmp_path), "csv")["sentiments"].collect()[0]
    assert (row.doc_id, row.text_order, row.sentiment_value) == (7, 1, 0.5)
    (folder / "a.csv").write_text("text_order,sentiment_value\n1,0.5\n")
    with pytest.raises(ValueError, match="doc_id"):
        TableSet.from_path(spark, str(tmp_path), "csv")


def test_rewrite_in_place_and_refused_backup(spark, concepts, tmp_path):
    root = str(tmp_path / "t")
    TableSink(spark, root).write({"concepts": concepts})
    sink = TableSink(spark, root)
    sink.write(TableSet.from_path(spark, root).remove_concepts(["Lenovo"]))
    assert TableSet.from_path(spark, root)["concepts"].count() == 2
    assert len(sink.backed_up) == 1
    now = dt.datetime(2020, 1, 1)
    assert backup(spark, root, ["concepts"], now=now) == ["concepts.parquet_20200101000000"]
    TableSink(spark, root).write({"concepts": concepts})
    with pytest.raises(FileExistsError):
        backup(spark, root, ["concepts"], now=now)
    assert TableSet.from_path(spark, root)["concepts"].count() == 4
    with pytest.raises(FileExistsError):
        TableSink(spark, root).write({"concepts": concepts}, backup_existing=False)
    assert TableSet.from_path(spark, root)["concepts"].count() == 4


def test_append_continues_ids(spark, analysis, tmp_path):
    from mentions.schemas import ANALYSIS

    sink = TableSink(spark, str(tmp_path / "a"))
    for k in range(3):
        assert sink.append(spark.createDataFrame([dict(analysis, seq=0)], ANALYSIS)) == k
    assert sorted(r[0] for r in sink.open()["sentiments"].collect()) == list(range(6))


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from mentions.session import ensure_checkpoint_dir

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Session:
        conf = Conf(spark_master="spark://host:7077")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_requests_as_frame_need_an_order(spark, concepts):
    with pytest.raises(ValueError, match="ord"):
        K.concept_frequency(concepts, spark.createDataFrame([("Lenovo",)], "concept string"))


def test_rank_without_n_numbers_all_rows(spark, concepts):
    got = [(r["concept"], r["rank"]) for r in K.most_common_concepts(concepts, n=None).collect()]
    assert got == [("Lenovo", 1), ("VisualAppearance", 2), ("Samsung", 3)]
