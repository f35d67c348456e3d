"""A text holding a third of all rows: the co-occurrence join is split by
AQE's skew handling, and the per-concept totals stay exact."""

import pytest
from pyspark.sql import functions as F

from mentions.operators import concepts as K
from mentions.schemas import conform

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_concepts(spark, n=60_000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0  # every third row lives in document 0, text 0
    return conform(ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("doc_id"),
        F.lit(0).alias("text_order"),
        F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("concept"),
        F.lit(1).alias("freq"), F.lit(0.5).alias("relevance_score"), F.lit("t").alias("concept_type")), "concepts")


def test_hot_text_is_split_and_exact(spark, skew_conf):
    df = skewed_concepts(spark).persist()
    out = K.co_occurring_concepts(df, "c0", n=1000, validate=False)
    got = {r["concept"]: r["count"] for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Brute force on the driver (small fixture): texts holding c0, then sums.
    rows = df.select("doc_id", "text_order", "concept", "freq").collect()
    texts = {(r[0], r[1]) for r in rows if r[2].lower() == "c0"}
    want = {}
    for d, t, c, f in rows:
        if (d, t) in texts and c.lower() != "c0":
            want[c] = want.get(c, 0) + f
    assert got == want
    assert "skew=true" in plan
    df.unpersist()


def test_hot_document_totals_are_salted(spark):
    from mentions.operators import common as C
    from mentions.operators import corpus as P

    ids = spark.range(30_000)
    hot = F.col("id") % 3 == 0  # a third of the rows, each a distinct word, in document 0
    df = conform(ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("doc_id"), F.lit(0).alias("text_order"),
        F.concat(F.lit("w"), F.col("id").cast("string")).alias("concept"), F.lit(1).alias("freq"),
        F.lit(0.5).alias("relevance_score"), F.lit("t").alias("concept_type")), "concepts")
    bags = P.concept_bags(df, validate=False)
    tf = {r["concept"]: r["tf"] for r in bags.filter(F.col("doc_id") == 0).collect()}
    assert len(tf) == 10_000 and all(abs(v - 1e-4) < 1e-12 for v in tf.values())
    # The join back runs on (doc_id, salt): the hot document is spread over the salts.
    salted = P.bag_counts(df, validate=False).filter(F.col("doc_id") == 0).select(
        F.pmod(F.xxhash64("concept"), F.lit(C.SALTS)).alias("s")).groupBy("s").count()
    sizes = [r["count"] for r in salted.collect()]
    assert len(sizes) == C.SALTS and max(sizes) < 10_000 / 16


def test_repeated_concept_in_one_text_is_spread(spark):
    """``dedupe=False`` runs on raw rows: rows of one concept in one text get many salts, and counts stay exact."""
    from mentions.operators import common as C

    ids = spark.range(10_000)
    df = conform(ids.select(
        F.lit(0).alias("doc_id"), F.lit(0).alias("text_order"), F.when(F.col("id") < 2, "a").otherwise("b").alias("concept"),
        (F.col("id") % 100 + 1).alias("freq"), (F.col("id") / 10_000).alias("relevance_score"), F.lit("t").alias("concept_type")),
        "concepts")
    salts = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(C.SALTS)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == C.SALTS and max(r["count"] for r in salts) < 10_000 / 16
    got = {r["concept"]: r["count"] for r in K.co_occurring_concepts(df, "a", n=5, dedupe=False, validate=False).collect()}
    assert got == {"b": 2 * sum(i % 100 + 1 for i in range(2, 10_000))}
    assert C.salts_for(C.largest_group(df, ["doc_id", "text_order"]), 1000) == 10


def test_a_larger_group_gets_more_salts_unasked(spark, monkeypatch):
    """TF-IDF sizes its salts by the largest document and the largest concept."""
    import re

    from mentions.operators import common as C
    from mentions.operators import corpus as X
    from mentions.schemas import TABLES

    used = []
    real = C.salts_for
    monkeypatch.setattr(C, "salts_for", lambda n: used.append((n, real(n, 10))) or real(n, 10))
    small = [(d, 0, f"c{k}", 1, 0.1, "x") for d in range(6) for k in range(3)]
    large = small + [(99, 0, f"big{k}", 1, 0.1, "x") for k in range(200)]
    got = [X.tf_idf(spark.createDataFrame(rows, TABLES["concepts"])) for rows in (small, large)]
    assert used == [(3, 1), (6, 1), (203 - 3, 20), (6, 1)]
    assert re.search(r"pmod\(xxhash64\(concept[^)]*\), 20\)", got[1]._jdf.queryExecution().executedPlan().toString())
    want = X.tf_idf(spark.createDataFrame(large, TABLES["concepts"]), salts=3)
    assert sorted(map(tuple, got[1].collect())) == sorted(map(tuple, want.collect()))
