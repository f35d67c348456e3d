"""The pipeline's rows against plain Python, stage by stage, and its contract."""

import random

import pytest

import corpus_pipeline
from mentions.llm import toxicity
from tests.llm import brute
from tests.llm.conftest import prose, rows_of


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    """Tables like the given ones, with toxic documents, copies, repeated lines and benchmark passages."""
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("sf"))
    docs = list(corpus)
    passage = prose(rng, 40, punctuation=False)
    for i in range(120):
        words = prose(rng, rng.randrange(30, 90)).split(" ")
        if i % 3 == 0:
            words[5:5] = ["grobbler", "you", "snark"]
        docs.append((1000 + i, " ".join(words)))
    docs += [(2000 + i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in range(3)]
    labels = [(d, 0, int("grobbler" in (t or ""))) for d, t in docs]
    frame = spark.createDataFrame([(d, t, "en", "src0", None if t is None else len(t)) for d, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, "nowhere to be found")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return path, docs, passage


def test_pipeline_rows(spark, folder):
    from tokenizers import Tokenizer

    from mentions.llm.tokens import default_tokenizer

    path, docs, passage = folder
    found = toxicity.toxicity(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    clean = {r.doc_id for r in found.where("predicted = 0").collect()}
    assert not any("grobbler" in (t or "") for d, t in docs if d in clean) and len(clean) > len(docs) / 2
    kept = [(d, t) for d, t in docs if d in clean]
    owner = {}
    for d, t in sorted(kept):
        for line in (t or "").split("\n"):
            if len(brute.line_key(line)) >= 10:
                owner.setdefault(brute.line_key(line), d)
    kept = [(d, None if t is None else "\n".join(x for x in t.split("\n") if owner.get(brute.line_key(x), d) == d)) for d, t in kept]
    single = {r[0] for r in brute.op6(kept) if r[3] or not brute.shingles(dict(kept)[r[0]])}
    kept = [(d, t) for d, t in kept if d in single]
    dirty = {r[0] for r in brute.op1(kept, [(1, passage), (2, "nowhere to be found")]) if r[5]}
    assert dirty
    kept = [(d, t) for d, t in kept if d not in dirty]
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = sorted((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in kept)
    assert rows_of(corpus_pipeline.run(spark, path), "doc_id", "n_tokens") == sorted(want, key=repr)


def test_stages_return_documents(spark, folder):
    path, docs, _ = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, path)
        assert out.dtypes == frame.dtypes and 0 < out.count() <= len(docs)
    assert corpus_pipeline.ORACLE_SQL is None
