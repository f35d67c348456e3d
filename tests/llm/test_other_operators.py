"""Operators 4, 5, 6, 9 and 10 against plain Python, exact optima or held-out accuracy."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentions.llm import graph, itq, minhash, packing, sharding, toxicity
from tests.llm import brute
from tests.llm.conftest import prose, rows_of


# ------------------------------------------------------------------ toxicity
@pytest.fixture(scope="module")
def labelled():
    """Toxic documents use made-up insults; some clean ones use them once, negated or quoted."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, rng.randrange(20, 120)).split(" ")
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grobbler", "Grobblish", "snark"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    docs += [(400, None), (401, ""), (402, "grobbler snark you grobbler snark"), (403, "w1 " * 5000), (None, "snark"), (1, "repeated id")]
    labels += [(900, 0, 1), (401, None, None), (None, 1, 1), (0, 0, 0)]
    return docs, labels


def labels_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, frame, labelled):
    docs, labels = labelled
    got = toxicity.toxicity(frame(docs), labels_frame(spark, labels)).drop("row").collect()
    assert len(got) == len(docs)
    mark = {d: t for d, _, t in labels[:400]}
    held = [r for r in got if r.held_out and r.doc_id in mark]
    assert {r.doc_id for r in held} == {d for d in mark if zlib.crc32(str(d).encode()) % 4 == 2}
    right = sum(r.predicted == mark[r.doc_id] for r in held) / len(held)
    assert len(held) > 60 and right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 400}
    assert by_id[402].predicted == 1 and by_id[400].score == by_id[401].score and by_id[401].predicted == 0
    kept = toxicity.drop_toxic(frame(docs), labels_frame(spark, labels))
    assert kept.columns == frame(docs).columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_held_out_labels_are_not_read(spark, frame, labelled):
    docs, labels = labelled
    turned = [(d, q, 1 - t if d is not None and t is not None and zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels]
    a, b = (rows_of(toxicity.toxicity(frame(docs), labels_frame(spark, x)), "doc_id", "score") for x in (labels, turned))
    assert a == b


def test_toxicity_without_usable_labels(spark, frame, labelled):
    docs = labelled[0][:20]
    for labels, score in (([], 0.0), ([(1, 0, 0), (3, 0, 0)], 0.0)):
        assert {r.score for r in toxicity.toxicity(frame(docs), labels_frame(spark, labels)).collect()} == {score}
    assert toxicity.toxicity(frame([]), labels_frame(spark, [(1, 0, 1)])).count() == 0


def test_grammar_scores_clauses():
    grammar = toxicity.Grammar({"^scum": 4.0, "^idiot$": 3.0})
    plain, aimed, threatening, negated, reported = range(5)

    def channels(text):
        f = grammar.features(text)
        return [c for c in range(5) if f[c] > 0]

    assert channels("what scumbags there are") == [plain]
    assert channels("You are scum") == [aimed]
    assert channels("I will kill this scum") == [threatening]
    assert channels("he is not an idiot at all") == [negated]
    assert channels("she said scum") == [reported]
    assert channels("she said so. scum") == [plain]  # the report ends with its clause
    assert channels("not one two scum") == [negated] and channels("idiots") == []
    table, channel = toxicity.compose()
    assert len(table) == len(channel) == 2 * 2 * (toxicity.NEGATION_REACH + 1) * 2
    assert all(0 <= s < len(table) for row in table for s in row)


def test_clauses_are_settled_at_their_end():
    grammar = toxicity.Grammar({"^idiot$": 3.0})

    def matched(text):
        f = grammar.features(text)
        assert len(f) == toxicity.FEATURES
        kinds = [*toxicity.CHANNELS, *toxicity.MENACES]
        return [k for k, x in zip(kinds, [*f[:len(toxicity.CHANNELS)], *f[-len(toxicity.MENACES):]], strict=True) if x > 0]

    assert matched("I will kill you") == matched("you will die.") == ["menace"]
    assert matched("I will kill it. you see") == [] == matched("nothing here")
    assert matched("I will not hurt you") == ["negated menace"]
    assert matched("he wrote I will hurt you") == matched("I will hurt you, he wrote") == ["quoted menace"]
    assert matched("what an idiot you are") == ["aimed"] and matched("idiot, she said") == ["reported"]
    assert matched("idiot, I will hurt you") == ["threatening", "menace"]
    assert matched("not an idiot but you hurt") == ["negated", "negated menace"]  # three class words are in reach


def test_all_stems_that_tell_are_kept(spark):
    rng = random.Random(13)
    insults = ["".join(rng.choices("bcdfghjklmnpqrstvwxyz", k=9)) for _ in range(150)]
    rows = [(f"some {insults[i % 150]} words {insults[(i * 7 + 1) % 150]} here", 1) for i in range(1500)]
    rows += [(prose(rng, 6), 0) for _ in range(4500)]
    stems = toxicity.learn_stems(spark.createDataFrame(rows, "text string, toxic int"))
    assert len(stems) > 512 and all(f"^{w}$" in stems for w in insults)


def test_documents_toxic_by_threats_alone(spark, frame):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(400):
        threat, toxic = rng.choice(["kill", "hurt", "burn", "beat", "destroy"]), i % 4 == 0
        said = f". I will {threat} you. all of it is here. " if toxic else f". I will {threat} it. all of you is here. "
        docs.append((i, prose(rng, rng.randrange(10, 60)) + said + prose(rng, rng.randrange(10, 60))))
        labels.append((i, 0, int(toxic)))
    got = toxicity.toxicity(frame(docs), labels_frame(spark, labels)).where("held_out").collect()
    assert len(got) > 60 and sum(r.predicted == (r.doc_id % 4 == 0) for r in got) / len(got) > 0.95


# ---------------------------------------------------------------- embeddings
def vectors_near(rng, n, width, groups, cosine_low):
    base = rng.normal(size=(n, width))
    out = list(base)
    for g in range(groups):
        centre = base[g] / np.linalg.norm(base[g])
        for _ in range(3):
            noise = rng.normal(size=width)
            noise -= noise @ centre * centre
            c = rng.uniform(cosine_low, 0.999)
            out.append(centre * c + noise / np.linalg.norm(noise) * math.sqrt(1 - c * c))
    return [v.astype(np.float32) for v in out]


def brute5(rows):
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            ok[i] = x / np.abs(x).max()
            ok[i] /= np.linalg.norm(ok[i])
    links = [(i, j) for i, j in itertools.combinations(ok, 2) if len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.9]
    comp = brute.groups(range(len(rows)), links)
    name = {}
    for i, c in comp.items():
        name[c] = min(name.get(c, rows[i][0]), rows[i][0])
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    return [(rows[i][0], n[i], name[comp[i]], rows[i][0] == name[comp[i]]) for i in range(len(rows))]


def embeddings(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k) for k, (i, v) in
                                  enumerate(rows)], "vec_id long, embedding array<float>, label int").repartition(3)


@pytest.mark.parametrize("block", [2048, 5])
def test_links_of_clear_groups(spark, block):
    rng = np.random.default_rng(1)
    rows = [(100 - i, v) for i, v in enumerate(vectors_near(rng, 60, 24, 8, 0.97))]
    hot = rng.normal(size=24)
    rows += [(200 + i, (hot + 0.02 * rng.normal(size=24)).astype(np.float32)) for i in range(40)]
    rows += [(300 + i, rows[0][1]) for i in range(5)]
    zero, big = [0.0] * 24, [1e38] * 23 + [3e38]
    rows += [(400, None), (401, zero), (402, [None] + [1.0] * 23), (403, [float("nan")] * 24), (404, [float("inf")] + [1.0] * 23),
             (405, []), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, big), (409, [x / 2 for x in big]), (410, [-x for x in big])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = rows_of(itq.near_duplicates(embeddings(spark, rows), block=block), "vec_id", "n_links", "component_id", "kept")
    assert got == sorted(brute5(rows), key=repr)


def test_recall_of_links_near_the_threshold(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors_near(rng, 1500, 32, 300, 0.9))]
    got = {r.vec_id: r.n_links for r in itq.near_duplicates(embeddings(spark, rows)).collect()}
    want = {r[0]: r[1] for r in brute5(rows)}
    assert all(got[i] <= want[i] for i in want)  # no pair below the threshold
    assert sum(got.values()) >= 0.9 * sum(want.values()) and sum(want.values()) > 1000


@pytest.mark.parametrize("n", [1500, 6000])
def test_recall_with_a_common_component(spark, n):
    rng = np.random.default_rng(4)
    width, background = 64, 0.7
    shared = np.ones(width) / math.sqrt(width)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    def apart(x, y):
        return unit(x - (x * y).sum(axis=-1, keepdims=True) * y)

    base = math.sqrt(background) * shared + math.sqrt(1 - background) * apart(rng.normal(size=(n, width)), shared)
    near = 0.905 * base[:400] + math.sqrt(1 - 0.905**2) * apart(rng.normal(size=(400, width)), base[:400])
    every = np.concatenate([base, near]).astype(np.float32)
    x = unit(every.astype(np.float64))
    want = (x @ x.T >= 0.9).sum() - len(x)
    got = sum(r.n_links for r in itq.near_duplicates(embeddings(spark, list(enumerate(every)))).collect())
    assert want >= 800 and 0.95 * want <= got <= want


def test_no_vectors(spark):
    assert itq.near_duplicates(embeddings(spark, [])).count() == 0
    only = [(1, None), (2, [0.0, 0.0])]
    assert rows_of(itq.near_duplicates(embeddings(spark, only)), "vec_id", "n_links", "component_id", "kept") == [
        (1, 0, 1, True), (2, 0, 2, True)]


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2001 + i) for i in range(50)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = brute.groups(nodes, [x for x in links if x[0] != x[1]])
    assert got == want


# ------------------------------------------------------------------- minhash
def test_near_duplicates(frame, corpus):
    got = rows_of(minhash.near_duplicates(frame(corpus)), "doc_id", "class_id", "component_id", "kept")
    want = sorted(brute.op6(corpus), key=repr)
    assert got == want
    assert any(r[1] != r[2] for r in want)


def test_near_duplicates_of_a_large_group(frame):
    rng = random.Random(7)
    base = prose(rng, 200).split(" ")
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10_000)}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, prose(rng, 100)) for i in range(50)] + [(2000 + i, docs[0][1]) for i in range(30)]
    got = rows_of(minhash.near_duplicates(frame(docs)), "doc_id", "class_id", "component_id", "kept")
    assert got == sorted(brute.op6(docs), key=repr)


def test_dedup_keeps_one_of_each_group(frame, corpus):
    docs = [*corpus, (3, corpus[3][1]), (None, corpus[3][1]), (None, None), (None, "own words of a null id, not met elsewhere")]
    out = minhash.dedup(frame(docs))
    assert out.columns == frame(docs).columns
    want = {r[0] for r in brute.op6(corpus) if r[3]}
    got = [r.doc_id for r in out.collect()]
    assert set(got) == want | {None} and got.count(3) == 1 and got.count(None) == 3  # rows of one id stay together


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    keys = rng.integers(1, 2**63, 300).astype(np.uint64)
    x = {int(k): int(w) for k, w in zip(keys[:200], rng.integers(1, 5, 200), strict=True)}
    y = {int(k): x.get(int(k), int(w)) for k, w in zip(keys[50:250], rng.integers(1, 5, 200), strict=True)}
    exact = brute.jp(x, y)
    assert math.isclose(exact, minhash.probability_jaccard(
        np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)]), np.array(sorted(y), np.uint64),
        np.array([y[k] for k in sorted(y)])), rel_tol=1e-12)
    agree = []
    for salt in range(40):  # other hashes of the same shingles: an independent signature each
        doc = np.repeat([0, 1], [len(x), len(y)])
        shingle = np.array([*x, *y], np.uint64) * np.uint64(2 * salt + 1)
        s = minhash.signatures(doc, shingle, np.array([*x.values(), *y.values()]), 2)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - exact) < 0.03
    scaled = minhash.probability_jaccard(np.array([1, 2], np.uint64), np.array([1, 2]), np.array([1, 2], np.uint64), np.array([2, 4]))
    assert math.isclose(scaled, 1.0)


def test_signature_of_one_shingle_fills_all_registers():
    s = minhash.signatures(np.array([0]), np.array([77], np.uint64), np.array([1]), 1)
    assert (s == 77).all()


def test_minhash_of_nothing(frame):
    assert minhash.near_duplicates(frame([])).count() == 0 and minhash.dedup(frame([])).count() == 0
    docs = [(1, ""), (2, None), (3, "!"), (4, "")]
    assert all(r.kept and r.component_id == r.doc_id for r in minhash.near_duplicates(frame(docs)).collect())


# ------------------------------------------------------------------- packing
def test_boundaries_are_optimal():
    rng = random.Random(9)
    for _ in range(60):
        tops = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 30) for _ in tops]
        k = rng.randrange(1, 6)
        got = packing.optimal_boundaries(tops, counts, k)

        def cost(chosen):
            return sum(c * min(b for b in chosen if b >= t) for t, c in zip(tops, counts, strict=True))

        best = min(cost([*part, tops[-1]]) for n in range(min(k, len(tops))) for part in itertools.combinations(tops[:-1], n))
        assert len(got) <= k and got[-1] == tops[-1] and set(got) <= set(tops) and cost(got) == best
    assert packing.optimal_boundaries([], [], 4) == []


@pytest.mark.parametrize("budget,part_rows", [(2000, 4096), (300, 7)])
def test_packing(spark, frame, corpus, budget, part_rows, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", part_rows)
    monkeypatch.setattr(packing, "PART_BATCHES", 1)
    docs = [*corpus, (3, corpus[3][1]), (None, "x")]
    rows = packing.pack(frame(docs), n_buckets=4, budget=budget).collect()
    assert len(rows) == len(docs)
    from tokenizers import Tokenizer

    from mentions.llm.tokens import default_tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    n = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert sorted(r.n_tokens for r in rows) == n
    tops = sorted({r.boundary for r in rows})
    exact = packing.optimal_boundaries(sorted(set(n)), [n.count(x) for x in sorted(set(n))], 4)
    assert packing.padding(np.array(n), tops) <= 1.01 * packing.padding(np.array(n), exact) + 1
    batches = {}
    for r in rows:
        assert r.n_tokens <= r.boundary and r.boundary == min(t for t in tops if t >= r.n_tokens)
        batches.setdefault(r.batch_id, []).append(r)
    for own in batches.values():
        assert len({r.boundary for r in own}) == 1
        assert len(own) * own[0].boundary <= budget or len(own) == 1
        assert sorted(r.slot for r in own) == list(range(len(own)))
    # at most one batch of a part is not full
    for part in {b.rsplit("-", 1)[0] for b in batches}:
        own = [len(v) for b, v in batches.items() if b.rsplit("-", 1)[0] == part]
        full = max(1, budget // next(v[0].boundary for b, v in batches.items() if b.rsplit("-", 1)[0] == part))
        assert sum(x < full for x in own) <= 1
    listed = packing.packed_batches(frame(docs), n_buckets=4, budget=budget).collect()
    assert sorted(map(str, (d for r in listed for d in r.doc_ids))) == sorted(str(d) for d, _ in docs)


def test_histogram_cells(spark):
    lengths = [1, 5, 1023, 1024, 1025, 2047, 2048, 2051, 4096, 4099, 1 << 40, (1 << 40) + (1 << 31)]
    df = spark.createDataFrame([(x,) for x in lengths], "n_tokens long")
    got = {r.n_tokens: r.c for r in df.select("n_tokens", packing.cell(F.col("n_tokens")).alias("c")).collect()}
    assert got == {x: x >> max(0, x.bit_length() - 10) << max(0, x.bit_length() - 10) for x in lengths}


def test_packing_of_nothing(frame):
    assert packing.pack(frame([])).count() == 0 and packing.packed_batches(frame([])).count() == 0


# ------------------------------------------------------------------ sharding
@pytest.mark.parametrize("limit", [300, 2000, 20_000, 10**9])
def test_sharding(frame, corpus, limit):
    docs = [*corpus, (None, "x" * 900), *[(500, "same id and text " * 20)] * 6]
    rows = sharding.shard_rows(frame(docs), limit_bytes=limit)
    assert rows_of(rows, "doc_id", "shard", "oversized") == sorted(brute.op10(docs, limit), key=repr)
    sizes = rows.groupBy("shard", "shard_bytes", "shard_docs").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b == r.shard_bytes and r.n == r.shard_docs for r in sizes)
    slots = sharding.directory(rows).orderBy("first_slot").collect()
    # shards own disjoint slots; slots without a shard hold no document
    for a, b in zip(slots, slots[1:], strict=False):
        assert a.last_slot < b.first_slot
    assert sum(r.shard_docs for r in slots) == len(docs)


def test_write_shards(spark, frame, corpus):
    from mentions.session import scratch_dir

    path = scratch_dir(spark, "shards")
    docs = [*corpus, (5, corpus[5][1])]
    sharding.write_shards(frame(docs), path, limit_bytes=5000)
    back = spark.read.parquet(path)
    assert rows_of(back, "doc_id", "text") == sorted(docs, key=repr)


def test_sharding_of_nothing(frame):
    assert sharding.shard_rows(frame([])).count() == 0
