"""Exact ties of operator 5 and rows of one id in operators 4 and 7."""

import itertools
import zlib

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mentions.llm import itq, substring, toxicity
from mentions.llm.oracles import OP5
from tests.llm import brute
from tests.llm.conftest import rows_of

LINKS = ["vec_id", "n_links", "component_id", "kept"]


def test_links_at_exactly_the_threshold(spark):
    """(10,0,0,0) and (9,3,3,1) have cosine 90/100; scaled and permuted copies too, and vectors just off it don't."""
    rows, far = [], itertools.count(1)
    for k, order in enumerate(itertools.permutations(range(4))):
        scale, other = float(2 ** (k % 7) + k % 3), 3.0 ** (k % 5)
        place = 8 * k  # pairs of different groups are orthogonal
        for vector, size in (((10, 0, 0, 0), scale), ((9, 3, 3, 1), other)):
            x = np.zeros(8 * 24)
            x[place:place + 4] = np.array(vector, float)[list(order)] * size
            rows.append((next(far), x.tolist()))
        off = np.zeros(8 * 24)
        off[place:place + 4] = np.array((9 - 1e-9, 3, 3, 1 + 1e-9))[list(order)]
        rows.append((next(far), off.tolist()))
    rows += [(next(far), [1e-300] * 192), (next(far), [1e300] * 192)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(itq.near_duplicates(frame), *LINKS)
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in rows[:-2]], "embedding": pa.array([r[1] for r in rows[:-2]], pa.list_(pa.float64()))}))
    want = {r[0]: r[1:] for r in con.execute(OP5).fetchall()}
    assert {r[0]: r[1:] for r in got if r[0] < 73} == want
    assert want[1] == (1, 1, True) and want[2][0] == 2  # the first of each three has a link at the threshold only
    assert (74, 1, 73, False) in got  # beyond what squares of doubles hold


def test_exact_cosines_of_whole_numbers():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-9, 10, (2, 500, 16)).astype(float)
    x[:, 0], y[:, 0] = 10, 10
    want = [(a @ b) / np.sqrt((a @ a) * (b @ b)) for a, b in zip(x, y, strict=True)]
    assert (itq.exact_cosines(x, y) == want).all()
    assert (itq.exact_cosines(x * 2.0**500, y * 2.0**-600) == want).all()


def test_rows_of_one_id_whose_texts_share_a_32_bit_hash(spark, frame):
    words = [" ".join(f"{c}{k}" for k in range(40)) for c in "ab"]
    texts = [spark.range(250_000).select(F.concat(F.lit(f"{w} "), F.col("id").cast("string")).alias(n)).withColumn("h", F.hash(n))
             for w, n in zip(words, ("one", "two"), strict=True)]
    one, two = texts[0].join(texts[1], "h").select("one", "two").first()
    longer = two + " " + " ".join(f"tail{k}" for k in range(20))
    for doc in (5, None):
        docs = [(1, one), (doc, one), (doc, two), (doc, longer)]
        found = substring.remove_repeats(frame(docs))
        got = rows_of(found, "doc_id", "n_words", "n_removed", "kept")
        assert got == sorted([(1, 41, 0, one), (doc, 41, 41, ""), (doc, 41, 0, two), (doc, 61, 0, longer)], key=repr)


def test_known_anchors_are_dealt_over_parts(spark, frame, monkeypatch):
    """Anchors that a slice knows to be shared go to parts by their hash, not all to one."""
    docs = [(i, " ".join(f"w{(i // 2) * 50 + k}" for k in range(50))) for i in range(200)]
    monkeypatch.setattr(substring, "PART_BYTES", 5000)
    plan = substring.anchors_in_play(frame(docs).coalesce(1).select("doc_id", "text"), substring.WINDOW, substring.ANCHOR)
    sizes = [r.n for r in plan.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) < 0.6 * sum(sizes)
    assert rows_of(substring.remove_repeats(frame(docs)), "doc_id", "n_words", "n_removed") == sorted(
        [r[:3] for r in brute.op7(docs)], key=repr)


def test_toxicity_learns_from_no_more_rows_than_its_bound(spark):
    rows = [(1, f"text {i % 300}") for i in range(600)] + [(3, None), (3, ""), (4, "one text"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (4, 0), (9, 1)], "doc_id long, toxic int")
    usable = {i for i in (1, 3, 4) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert 1 in usable
    every = [tuple(r) for r in toxicity.training_rows(docs, labels, 10_000).collect()]
    assert sorted(t for t, y in every if y) == sorted(f"text {i}" for i in range(300))
    assert len(every) == 300 + len(usable & {3, 4})
    some = [tuple(r) for r in toxicity.training_rows(docs, labels, 10).collect()]
    assert len(some) == 10 and set(some) <= set(every)
    assert sorted(some) == sorted(map(tuple, toxicity.training_rows(docs.repartition(3), labels, 10).collect()))
    assert toxicity.training_rows(docs, labels.limit(0), 10).count() == 0
