"""Operators 11 to 13 against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentions.llm import alignment, divergence, quality, queries
from mentions.llm.common import table
from tests.llm.conftest import rows_of

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ operator 11 --

def audit(rows, min_docs, top):
    """Rows (text, lang, source) -> {(lang, source, part, item, value, rank)} with Python's whole numbers."""
    count, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        count[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = set()
    for lang, docs in df.items():
        kept = [t for t, n in docs.items() if n >= min_docs]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(c) for (g, s), c in count.items() if g == lang}
        whole = shares(sum((c for (g, _), c in count.items() if g == lang), Counter()))
        for s, p in own.items():
            pairs = [(-sum(abs(p[t] - q[t]) for t in kept), o.encode()) for o, q in own.items() if o != s]
            terms = [(whole[t] - p[t], t.encode()) for t in kept if count[lang, s][t] and p[t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def voices(rng, n=240):
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "ä", "B", "", None, "z"])
        words = [rng.choice("The the und Ärger été x-y a1b x_y 安全 zoo_ q").strip() or "w" for _ in range(3)]
        words += [f"w{int(rng.random() ** 2 * 30)}x".replace("0", "é") for _ in range(rng.randrange(25))]
        rows.append((" ".join(words), lang, source))
    rows += [(None, "en", "silent"), ("", "fr", "quiet"), ("only once", "fr", "loud"), ("12 34 !?", "it", "alone")]
    return rows


@pytest.mark.parametrize("blocks", [(128, 4096), (2, 7)])
def test_divergence_equals_plain_python(spark, blocks):
    rows = voices(random.Random(3))
    docs = spark.createDataFrame([(t, g, s, i, "x", 1.0) for i, (t, g, s) in enumerate(rows)],
                                 "text string, lang string, source string, doc_id long, term string, p double").repartition(3)
    got = divergence.divergence_audit(docs, min_docs=4, top_terms=6, group_block=blocks[0], term_block=blocks[1])
    assert set(map(tuple, got.collect())) == audit(rows, 4, 6)
    assert got.count() == len(audit(rows, 4, 6))


def test_divergence_without_terms_or_rows(spark):
    schema = "text string, lang string, source string"
    docs = spark.createDataFrame([("a b", "en", "x"), (None, "en", "y"), ("!", None, None)], schema)
    got = divergence.divergence_audit(docs)
    assert rows_of(got, "lang", "source", "part", "item", "value", "rank") == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergence.divergence_audit(docs.limit(0)).count() == 0


def test_share_is_exact_for_large_counts(spark):
    cases = [(0, 0, 1), (7, 9, 3), (10**13 - 3, 3 * 10**15, 10**7), (3 * 10**15, 3 * 10**15, 1), (5, 0, 0)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n long, total long, terms long")
    got = [r.p for r in df.orderBy("i").select(divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).collect()]
    assert got == [0 if not v else 1 + 10**9 * (n + 5) // (t + 5 * v) for n, t, v in cases]


def test_counters_are_sent_on_when_full(spark):
    docs = spark.createDataFrame([("a b c d", "en", "x"), ("a b e f", "en", "y")] * 5, "text string, lang string, source string")
    once = divergence.term_counts(docs.coalesce(1))
    cut = divergence.term_counts(docs.coalesce(1), held=3)
    assert cut.count() > once.count()
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    keys = ["lang", "source", "term"]
    assert rows_of(cut.groupBy(*keys).agg(*sums), *keys, "n", "docs") == rows_of(once, *keys, "n", "docs")


# ------------------------------------------------------------ operator 13 --

def aligned(rows):
    """(doc_id, text) -> the contract's rows, from single tokens' bytes, and the corpus counts of pairs."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path_a, path_b = alignment.tokenizer_paths()
    one = Tokenizer.from_file(path_a)
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=path_b)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def piece(i):
        name = two.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()

    out, links = [], []
    for doc, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        raw_a, raw_b = [bytes(letters[c] for c in one.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            out.append((doc, 0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b = ([sum(map(len, raw[:k + 1])) for k in range(len(raw))] for raw in (raw_a, raw_b))
        at = [e for e in ends_a if e in set(ends_b)]
        groups = ["|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if start < e <= end)
                           for ids, ends in ((a, ends_a), (b, ends_b))) for start, end in zip([0, *at], at, strict=False)]
        out.append((doc, len(a), len(b), len(at), ";".join(groups)))
        links.append([(i, j) for i, e in zip(a, ends_a, strict=True) for j, f in zip(b, ends_b, strict=True) if e == f])
    count = Counter(p for own in links for p in own)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    full = [(d, na, nb, n, len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), g)
            for (d, na, nb, n, g), own in zip(out, links, strict=True)]
    return full, count, Counter(p for own in links for p in set(own))


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "tab\tand\r\nlines  two  blanks ", " leading", "ﬁ ligature ½ É é", " 　x"]


def test_alignment_equals_plain_python(spark, corpus, frame):
    rows = [(d, t if t is None else t[:700]) for d, t in corpus] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(5, "again"), (None, "no id")]
    want, count, held = aligned(rows)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    for chunk in (alignment.CHUNK_BYTES, 1):
        assert rows_of(alignment.align(frame(rows), chunk_bytes=chunk), *names) == sorted(want, key=repr)
    pairs = alignment.pair_table(frame(rows))
    assert rows_of(pairs, "a", "b", "n_docs", "n_links") == sorted(((a, b, held[a, b], n) for (a, b), n in count.items()), key=repr)


def test_alignment_query_and_empty_table(spark, frame):
    docs = table(spark, SMALL, "documents").limit(30)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    digest = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), render=lambda g: F.sha2(g, 256))
    assert {r.doc_id: r.groups for r in digest.collect()} == {w[0]: hashlib.sha256(w[-1].encode()).hexdigest() for w in aligned(rows)[0]}
    assert alignment.align(frame([(1, "x")]).limit(0)).count() == 0
    assert queries.op13_alignment(spark, SMALL).columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_segments_align_as_whole_texts_do():
    """Cutting texts into segments, and remembering them, changes nothing."""
    enc = alignment.Encoders(*alignment.tokenizer_paths())
    whole = alignment.Encoders(*alignment.tokenizer_paths())
    assert enc.cut
    whole.cut = False
    rng = random.Random(1)
    bits = [*" \n\t\r", " ", "a", "the", "É", "安", "😀", "\u3000", "\xa0", "\x1c", "\x0b", "\u200b", "'s", "12", "!!", "<s>", "\u0301", "▁", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(2000)]
    for start in range(0, len(texts), 100):
        got, want = alignment.Slice(texts[start:start + 100], enc), alignment.Slice(texts[start:start + 100], whole)
        assert got.groups == want.groups
        assert (got.n_a == want.n_a).all() and (got.n_b == want.n_b).all() and (got.n_groups == want.n_groups).all()
        assert all((x == y).all() for x, y in zip(alignment.merge([got.links]), alignment.merge([want.links]), strict=True))


def test_bitmaps_round_trip():
    rng = np.random.default_rng(2)
    for rows in (1, 7, 100, 5000):
        sets = [np.sort(rng.choice(rows, size=rng.integers(1, rows + 1), replace=False)) for _ in range(20)]
        owner = np.repeat(np.arange(20), [len(s) for s in sets])
        number, held, bits = alignment.bitmaps(owner, np.concatenate(sets), rows)
        assert number.tolist() == list(range(20)) and held.tolist() == [len(s) for s in sets]
        assert all((alignment.slots_of(b, n) == s).all() for b, n, s in zip(bits, held, sets, strict=True))
        assert max(map(len, bits)) <= max(2, -(-rows // 8))


# ------------------------------------------------------------ operator 12 --

def plain_tokens(text):
    raw, out, run = text.encode(), [], b""
    last = 0
    for byte in raw:
        kind = int(quality.CLASSES[byte])
        if kind != last and run:
            out.append(run)
            run = b""
        if kind:
            run += bytes([byte])
        last = kind
    return out + [run] if run else out


def test_quality_tokens_and_contexts_equal_plain_python(spark, corpus, frame):
    texts = [t or "" for _, t in corpus]
    bucket, doc = quality.tokens([t.encode() for t in texts])
    of: dict = {}
    words = [(i, w) for i, t in enumerate(texts) for w in plain_tokens(t)]
    assert doc.tolist() == [i for i, _ in words]
    for b, (_, w) in zip(bucket.tolist(), words, strict=True):
        assert of.setdefault(w, b) == b  # a token's bucket doesn't depend on where it stands
    assert len(set(of.values())) > 0.98 * len(of)
    places, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIM + 1), np.int64)
    for i, t in enumerate(texts):
        own = [of[w] for w in plain_tokens(t)]
        for k, b in enumerate(own):
            want[b, quality.DIM] += 1
            for n in own[max(0, k - quality.REACH):k] + own[k + 1:k + 1 + quality.REACH]:
                for place, sign in zip(places[n], signs[n], strict=True):
                    want[b, place] += sign
    assert (quality.context_sums(frame(corpus)) == want).all()


def test_quality_features_equal_plain_python(corpus, monkeypatch):
    texts = [(t or "").encode() for _, t in corpus[:75]]
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    weights = rng.random(quality.BUCKETS).astype(np.float32)
    whole = quality.pooled(texts, vectors, weights)
    monkeypatch.setattr(quality, "POOLED_TOKENS", 50)  # cuts inside documents change nothing
    assert np.allclose(quality.pooled(texts, vectors, weights), whole, atol=1e-5)
    for i in (0, 3, 70):
        own = quality.tokens([texts[i]])[0]
        v, w = vectors[own].astype(float), weights[own].astype(float)
        x = whole[i]
        assert np.allclose(x[:quality.DIM], v.mean(axis=0), atol=1e-5)
        assert np.allclose(x[quality.DIM:2 * quality.DIM], (v * w[:, None]).sum(axis=0) / w.sum(), atol=1e-5)
        assert math.isclose(x[2 * quality.DIM], (v[1:] * v[:-1]).sum() / len(own), abs_tol=1e-4)
        assert math.isclose(x[2 * quality.DIM + quality.REACH], (own[1:] == own[:-1]).sum() / len(own), abs_tol=1e-9)


def test_network_is_calibrated_on_rows_kept_aside():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] ** 2 + 0.5)))
    y = (rng.random(4000) < p).astype(float)
    scores = quality.Network(x, y).scores(x)
    assert np.abs(scores - p).mean() < 0.08
    for low in np.arange(0, 1, 0.25):
        inside = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[inside].mean() - y[inside].mean()) < 0.08


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    got = [r for r in queries.op12_quality(spark, folder).collect()]
    assert len(got) == table(spark, folder, "documents").count()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    own = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in own if y == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s < 0.3 for s in bad]) > 0.8 and np.mean([s >= 0.3 for s in good]) > 0.97


def test_quality_edges(spark, corpus, frame):
    labels = spark.createDataFrame([(d, d % 2, d % 3) for d in range(60)] + [(3, None, 0), (None, 1, 1), (10**6, 1, 1), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = frame(corpus + [(5, "a second row"), (None, "no id"), (None, None)])
    got = quality.quality(docs, labels)
    again = quality.quality(docs, labels)
    assert got.count() == len(corpus) + 3
    assert rows_of(got, "doc_id", "score", "predicted") == rows_of(again, "doc_id", "score", "predicted")
    assert len({r.score for r in got.where("row.text is null or trim(row.text) = ''").collect()}) == 1
    none = quality.quality(docs, labels.limit(0))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    assert quality.quality(docs.limit(0), labels).count() == 0
    # the bound holds for rows, not only for ids
    many = frame([(1, f"text {i}") for i in range(50)])
    table_ = spark.sparkContext.broadcast(quality.word_vectors(quality.context_sums(many)))
    from mentions.llm.common import id_text

    assert quality.training_features(id_text(many), labels, table_, 10).count() == 10
