import json

import pytest

from mentions.operators import batching
from mentions.operators.batching import MAX_REQUEST_BYTES, batch_texts, request_overhead, text_bytes


def brute_force(texts, max_size, overhead):
    """Sequential greedy packing, one text at a time."""
    batches, current, length = [], [], overhead
    for t in texts:
        cost = len(json.dumps(t)) + 1
        if current and length + cost > max_size:
            batches.append(current)
            current, length = [], overhead
        current.append(t)
        length += cost
    if current:
        batches.append(current)
    return batches


@pytest.mark.parametrize("max_size", [90, 150, 400])
def test_matches_sequential_greedy(spark, max_size):
    texts = [("é" * (i % 7)) + "x" * ((i * 13) % 29) + '"\n' * (i % 2) for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    analyses = ["categories"]
    out = batch_texts(df, analyses, max_size=max_size).orderBy("doc_id").collect()
    got = {}
    for r in out:
        got.setdefault(r["batch_start"], []).append(texts[r["doc_id"]])
    assert list(got.values()) == brute_force(texts, max_size, request_overhead(analyses))


def test_invariants_with_partitions(spark):
    texts = [("w" * ((i * 31) % 200)) for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = batch_texts(df, max_size=1000, range_width=50)
    rows = out.collect()
    assert len(rows) == 300
    overhead = request_overhead(["concepts", "categories", "sentiment", "absa"])
    sizes = {}
    for r in rows:
        sizes[r["batch_start"]] = sizes.get(r["batch_start"], overhead) + r["text_bytes"]
        assert r["batch_start"] <= r["doc_id"]
    assert max(sizes.values()) <= 1000


def test_unknown_analysis(spark):
    with pytest.raises(ValueError):
        request_overhead(["concepts", "nope"])
    assert MAX_REQUEST_BYTES == 1_000_000


def test_batches_do_not_depend_on_partitions(spark):
    texts = [("w" * ((i * 31) % 200)) for i in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(tuple(r) for r in batch_texts(df, max_size=1000, range_width=100).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] and len({r[2] for r in got[0]}) > 10


def test_text_bytes_equal_the_json_literal(spark):
    texts = ["", "plain", 'q"uote\\', "\b\f\n\r\t", "\x00\x01\x0b\x1f\x7f", "é安\uffff", "😀a𝒳", "~ !"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, text string")
    got = {r.i: r.b for r in df.select("i", text_bytes(df["text"]).alias("b")).collect()}
    assert got == {i: len(json.dumps(t)) + 1 for i, t in enumerate([*texts, None])}


@pytest.mark.parametrize("unit,group,fan,partitions", [(8, 4, 2, "5"), (3, 1, 3, "2"), (1, 1, 2, "3"), (1 << 16, 1 << 12, 32, "4")])
def test_whole_table_packing_equals_the_sequential_one(spark, monkeypatch, unit, group, fan, partitions):
    """Sparse keys, texts too large for a request, one batch over many units and many batches in a unit."""
    import random

    monkeypatch.setattr(batching, "UNIT_ROWS", unit)
    monkeypatch.setattr(batching, "GROUP_ROWS", group)
    monkeypatch.setattr(batching, "FAN", fan)
    rng = random.Random(unit)
    texts = ["w" * (rng.choice([0, 1, 5, 30]) if rng.random() < 0.9 else rng.randrange(150)) for _ in range(90)]
    texts += ["z" * 200, "z" * 200] + [""] * 30
    keys = sorted(rng.sample(range(-10**12, 10**12), len(texts)))
    df = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = batch_texts(df, ["absa"], max_size=150).orderBy("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    got = {}
    for r in rows:
        got.setdefault(r.batch_start, []).append(r.text)
        assert r.oversized == (len(r.text) + 3 + request_overhead(["absa"]) > 150)
    assert list(got.values()) == brute_force(texts, 150, request_overhead(["absa"]))
    assert len(rows) == len(texts)


def test_sparse_keys_do_not_cut_batches(spark):
    df = spark.createDataFrame([(50_000 * i, "abc") for i in range(8)], "doc_id long, text string")
    assert {r.batch_start for r in batch_texts(df).collect()} == {0}


def test_packing_of_no_rows_and_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "same")] * 50 + [(None, None), (2, None)], "doc_id long, text string")
    out = batch_texts(df, ["absa"], max_size=request_overhead(["absa"]) + 21)
    assert out.count() == 52 and {r.text_bytes for r in out.collect()} == {7, 5}
    assert batch_texts(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="room"):
        batch_texts(df, max_size=10)
