"""Operators 1, 2, 3, 7 and 8 against plain Python, on small documents with every edge case."""

import random
from itertools import chain

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentions.llm import decontaminate, linededup, pfor, pii, queries, substring, tokens
from mentions.llm.common import stored  # noqa: F401
from mentions.session import scratch_dir
from tests.llm import brute
from tests.llm.conftest import prose, rows_of


@pytest.fixture(scope="module")
def items(corpus):
    words = (corpus[20][1] or "").split()
    long = corpus[25][1].split()
    return [(1, " ".join(words[2:30]).lower()), (10, " ".join(long[:12])), (2, "one two"), (3, ""), (4, None), (5, "!!"),
            (None, "one two three"), (6, "a a a a a a a a a a a"), (7, " ".join(words[2:30])), (8, "not in any document at all")]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


DIGEST1 = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def digest1(found):
    return rows_of(found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)), *DIGEST1)


def test_benchmark_blocks_are_bounded(spark):
    rows = [("same", "w " * 100)] * 500 + [(f"i{k}", f"w{k} " * 100) for k in range(200)]
    table = spark.createDataFrame(rows, "item_id string, text string")
    blocks = list(decontaminate.blocks_of(table, "item_id", "text", 4000))
    assert sorted(chain(*blocks)) == sorted((i, t.encode()) for i, t in set(rows))
    assert all(sum(len(i) + len(t) + decontaminate.ROW_BYTES for i, t in b) <= 4000 for b in blocks)
    assert list(decontaminate.blocks_of(bench(spark, []), "item_id", "text", 4000)) == [[]]


def test_many_blocks_give_the_rows_of_one(spark, frame, corpus, items):
    docs = frame([*corpus, *corpus[:20], (None, corpus[10][1]), (None, corpus[10][1]), (None, None)])
    columns = ["doc_id", "row", "n_words", "spans", "items"]
    one, many = (sorted(decontaminate.match_spans(docs, bench(spark, [*items, *items]), block_bytes=n).select(*columns).collect(), key=repr)
                 for n in (1 << 20, 60))
    assert one == many


@pytest.mark.parametrize("block_bytes,shard_bytes", [(1 << 20, 1 << 20), (60, 500)])
def test_contamination(spark, frame, corpus, items, block_bytes, shard_bytes):
    found = decontaminate.contamination(frame(corpus), bench(spark, items), block_bytes=block_bytes, shard_bytes=shard_bytes)
    want = sorted(brute.op1(corpus, items), key=repr)
    assert digest1(found) == want
    assert any(r[5] for r in want)
    clean = decontaminate.decontaminate(frame(corpus), bench(spark, items))
    assert clean.columns == frame(corpus).columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in want if not r[5]}


def test_contamination_by_random_words(spark, frame):
    rng = random.Random(1)
    docs = [(i, prose(rng, 300, words=6, punctuation=False)) for i in range(30)]
    items = [(i, prose(rng, rng.randrange(1, 40), words=6, punctuation=False)) for i in range(30)]
    assert digest1(decontaminate.contamination(frame(docs), bench(spark, items))) == sorted(brute.op1(docs, items), key=repr)


def test_longest_matches(spark, frame, corpus, items):
    got = {(r.item_id, r.item_start): (r.doc_id, r.doc_start, r.n_words) for r in
           decontaminate.longest_matches(frame(corpus), bench(spark, items), shard_bytes=2000).collect()}
    words = {d: brute.WORD1.findall((t or "").translate(brute.UPPER)) for d, t in corpus}
    want = {}
    for name, text in items:
        item = brute.WORD1.findall((text or "").translate(brute.UPPER))
        for at in range(len(item) - min(10, len(item)) + 1 if item else 0):
            best = (0, 0, 0)
            for d, ws in words.items():
                for i in range(len(ws)):
                    n = 0
                    while n < len(item) - at and i + n < len(ws) and ws[i + n] == item[at + n]:
                        n += 1
                    best = max(best, (n, -d, -i))
            if best[0] >= min(10, len(item)):
                want["null" if name is None else str(name), at] = (-best[1], -best[2], best[0])
    # where a suffix has equally long matches, which of a shard's neighbours is met is free; its length is not
    assert got.keys() == want.keys() and {k: v[2] for k, v in got.items()} == {k: v[2] for k, v in want.items()}
    for (name, at), (d, i, n) in got.items():
        item = next(brute.WORD1.findall(t.translate(brute.UPPER)) for k, t in items if ("null" if k is None else str(k)) == name)
        assert words[d][i:i + n] == item[at:at + n]


PERSONAL = [
    (0, "a.b+c@mail.example.com, x@y, x@y.z.w- @no.com a@b..c a@b.c+d@e.f"), (1, "1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 01.002.3.255 9" + "9" * 400 + ".1.1.1"),
    (2, "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 411111111111111 5500005555555559"),
    (3, "+1 (555) 123-4567 +49 30 1234567 +12 +1 234 567 890 123 456 7 ++1 555 123 4567"), (4, "é安😀 a@b.co é 1.1.1.1 😀 +1 555 123 4567"),
    (5, None), (6, ""), (None, "n@ull.id"), (7, "a" * 50_000 + "@"), (8, "1" * 30_000), (9, "a.b" * 5000 + "@x.y"), (10, "a@" + "b." * 8000 + "c"),
    (0, "second@row.of doc 0"), (11, "+" * 2000 + "1" * 2000)]


def digest2(spark, docs):
    found = pii.personal_data(docs)
    return rows_of(found, "doc_id", *[pii.kind_count(F.col("base"), k) for k in range(4)],
                   F.sha2(pii.joined(F.col("base")), 256), pii.joined(F.col("spans")))


def test_base_spans(spark, frame, corpus):
    docs = [*PERSONAL, *[(100 + d, t) for d, t in corpus]]
    assert digest2(spark, frame(docs)) == sorted(brute.op2(docs), key=repr)


def test_terms_that_reveal_an_entity(spark, frame):
    rng = random.Random(2)
    docs = [(i, prose(rng, 40)) for i in range(60)]
    for i in range(5):
        docs.append((100 + i, f"{prose(rng, 30)} {'abcde'[i]} the zorblax treasurer {'vwxyz'[i]} wrote to bob@secret.org about w{i} {prose(rng, 30)}"))
        docs.append((200 + i, f"{prose(rng, 30)} the treasurer spoke {prose(rng, 10)}"))
    found = pii.personal_data(frame(docs), min_contexts=3)
    text = dict(docs)
    terms = {}
    for r in found.collect():
        for s in r.spans:
            if s.kind == len(pii.KINDS):
                terms.setdefault(text[r.doc_id][s.start:s.end].lower(), []).append(r.doc_id)
    # the word that only ever stands by this address is found, one that others use as well is not
    assert sorted(terms["zorblax"]) == [100, 101, 102, 103, 104]
    assert "the" not in terms and "treasurer" not in terms
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(docs), min_contexts=3).collect()}
    assert "bob@secret.org" not in clean[100] and "[email]" in clean[100] and "zorblax" not in clean[100]
    assert clean[0] == text[0]


def test_revealing_terms_go_wherever_they_stand(spark, frame):
    rng = random.Random(3)
    docs = [(i, prose(rng, 40)) for i in range(200)]
    far = "x1 " * 40
    docs += [(1000 + i, f"{prose(rng, 20)} the Quibblefrost plan {far}{prose(rng, i + 5)} {far}wrote to bob@secret.org today") for i in range(4)]
    docs += [(1010, f"{prose(rng, 30)} quibblefrost {prose(rng, 10)}")]  # doesn't print the entity
    copy = f"{prose(rng, 20)} copycatword by amy@secret.org {prose(rng, 5)}"
    docs += [(1020 + i, copy) for i in range(5)]  # copies of one text prove nothing
    # a word that the edge of 48 characters cuts to another one
    docs += [(1030 + i, f"{'z' * (i + 3)} unplumbed {'. ' * 21}carl@secret.org {i}") for i in range(4)]
    docs += [(1040, docs[201][1])]
    text = dict(docs)
    terms = {}
    for r in pii.personal_data(frame([*docs, docs[200]])).collect():
        for s in r.spans:
            if s.kind == len(pii.KINDS):
                terms.setdefault(text[r.doc_id][s.start:s.end].lower(), set()).add(r.doc_id)
            else:
                assert text[r.doc_id][s.start:s.end].endswith("@secret.org")
    assert terms["quibblefrost"] == {1000, 1001, 1002, 1003, 1010, 1040}
    assert terms["unplumbed"] == {1030, 1031, 1032, 1033}
    assert not {"copycatword", "secret", "org", "bob"} & terms.keys()
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(docs)).collect()}
    # one of five documents with the term doesn't print the entity: its name is generalised or it is removed
    assert all("quibblefrost" not in t.lower() for t in clean.values())


def test_sanitise_keeps_columns_and_nulls(spark, frame):
    docs = frame(PERSONAL)
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(PERSONAL)
    texts = {r.doc_id: r.text for r in out.where("doc_id > 0").collect()}
    assert texts[5] is None and texts[6] == "" and texts[4] == "é安😀 [email] é [ip] 😀 [phone]"


def test_pfor_blocks_round_trip():
    rng = np.random.default_rng(0)
    cases = [np.array([], np.uint32), np.array([7], np.uint32), np.full(300, 5, np.uint32), np.arange(1000, dtype=np.uint32),
             rng.integers(0, 50_000, 5000).astype(np.uint32), np.array([0, 2**32 - 1] * 200, np.uint32),
             np.where(rng.random(4096) < 0.05, 2**31, 3).astype(np.uint32)]
    for ids in cases:
        payload, starts = pfor.encode_blocks(ids)
        assert (pfor.decode_blocks(payload, starts, len(ids)) == ids).all()
        assert len(starts) == 4 * -(-len(ids) // pfor.BLOCK)
    # outliers do not widen the block
    few = np.full(128, 1, np.uint32)
    few[5] = 2**30
    assert len(pfor.encode_blocks(few)[0]) < 30


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def test_word_cache_equals_the_tokenizer(tokenizer, corpus):
    odd = ["Ÿa ŷ. İstanbul ΣΑΣ ß ẞ it's don't we'll a.b a,,b ... <|endoftext|> x<|endoftext|>y \x1c a\x0bb c 12ab _a é́ À! À!! ×a ı",
           "éa ́x ﬁ Å ÀÉÎ ñandú; ab12 ١٢ x² Ⅷ", *[t for _, t in corpus]]
    got = tokens.token_bytes([*odd, None], None)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in [*odd, None]]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == want


def test_token_files(spark, frame, corpus, tokenizer):
    docs = [(d * 3 - 5, t) for d, t in corpus]
    path = scratch_dir(spark, "tokens")
    pfor.write_tokens(frame(docs), path)
    got = rows_of(pfor.read_tokens(spark, path), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(brute.op3(docs, tokenizer), key=repr)
    ids = {r.doc_id: r.ids for r in pfor.read_tokens(spark, path, with_ids=True).collect()}
    assert ids[docs[0][0]] == tokenizer.encode(docs[0][1], add_special_tokens=False).ids + [1]


def test_token_files_of_repeated_and_null_ids(spark, frame, tokenizer):
    docs = [(1, "b"), (1, "a"), (None, "z z"), (1, "a"), (0, None)]
    path = scratch_dir(spark, "tokens")
    pfor.write_tokens(frame(docs), path)
    rows = pfor.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [0, 1, 1, 1, None]
    assert [r.start for r in rows] == [0, 1, 3, 5, 7] and [r.n_tokens for r in rows] == [1, 2, 2, 2, 3]


DIGEST7 = ["doc_id", "n_words", "n_removed"]


def digest7(found):
    return rows_of(found, *DIGEST7, F.sha2("kept", 256))


@pytest.mark.parametrize("options", [{}, {"shard_words": 50}, {"large": 0}, {"large": 2}])
def test_substring_dedup(frame, corpus, options):
    assert digest7(substring.remove_repeats(frame(corpus), **options)) == sorted(brute.op7(corpus), key=repr)


def test_substring_dedup_of_few_words(frame):
    rng = random.Random(3)
    docs = [(i, prose(rng, 120, words=3, punctuation=False)) for i in range(40)]
    docs += [(100 + i, "b " * n) for i, n in enumerate((12, 13, 14, 40, 40))]
    for options in ({}, {"large": 3}, {"shard_words": 10}):
        assert digest7(substring.remove_repeats(frame(docs), **options)) == sorted(brute.op7(docs), key=repr)


def test_substring_spans_and_repeated_ids(frame):
    text = " ".join(f"v{i}" for i in range(30))
    docs = [(1, text), (1, text), (2, f"x y {text} z"), (None, text)]
    rows = sorted(((r.doc_id, r.n_removed, [tuple(s) for s in r.spans], r.kept) for r in
                   substring.remove_repeats(frame(docs)).collect()), key=repr)
    assert rows == sorted([(1, 0, [], text), (1, 0, [], text), (2, 30, [(2, 32)], "x y z"), (None, 30, [(0, 30)], "")], key=repr)


def test_suffix_automaton_matching_statistics():
    rng = random.Random(4)
    automaton = substring.SuffixAutomaton()
    texts = [[rng.choice("ab") for _ in range(rng.randrange(1, 30))] for _ in range(20)]
    for i, t in enumerate(texts):
        automaton.add(t, i)
    automaton.close()
    probe = [rng.choice("abc") for _ in range(80)]
    holds = lambda part: [i for i, t in enumerate(texts) if any(t[k:k + len(part)] == part for k in range(len(t)))]
    for at, (_, n) in enumerate(automaton.matching(probe)):
        best = max((k for k in range(at + 2) if k == 0 or holds(probe[at + 1 - k:at + 1])), default=0)
        assert n == best
    for i, first in enumerate(automaton.first_documents(probe, 4)):
        assert first == min(holds(probe[i:i + 4]), default=substring.NO_ID)


def digest8(found):
    return rows_of(found, "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))


@pytest.mark.parametrize("n_batches,fanout", [(1, 2), (4, 3), (9, 2)])
def test_line_dedup(frame, corpus, n_batches, fanout):
    docs = [*corpus, (None, corpus[80][1]), (None, None), (5, corpus[80][1]), (5, corpus[80][1])]
    got = digest8(linededup.drop_repeated_lines(frame(docs), n_batches=n_batches, fanout=fanout))
    assert got == sorted(brute.op8(docs), key=repr)


def test_line_dedup_runs_are_compacted(spark):
    runs = linededup.SortedRuns(spark, fanout=2)
    for k in range(5):
        keys = spark.createDataFrame([(bytes([i]), 10 * k + i) for i in range(k, k + 4)], "key binary, doc_id long")
        linededup.add_batch(runs, keys)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    owners = {r.key[0]: r.owner for r in runs.owners().collect()}
    assert owners == {0: 0, 1: 1, 2: 2, 3: 3, 4: 14, 5: 25, 6: 36, 7: 47}


def test_dedup_lines_keeps_columns(frame, corpus):
    docs = frame(corpus)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = {r.doc_id: r for r in out.collect()}
    want = {r[0]: r for r in brute.op8(corpus)}
    for d, t in corpus:
        assert (rows[d].text is None) == (t is None)
        assert brute.sha(rows[d].text or "") == want[d][3]
        assert rows[d].row.startswith("row") and (t is None or rows[d].n_chars == len(rows[d].text))


def test_empty_tables(spark, frame, items):
    none = frame([])
    assert decontaminate.contamination(none, bench(spark, items)).count() == 0
    assert pii.personal_data(none).count() == 0 and pii.sanitise(none).count() == 0
    path = scratch_dir(spark, "tokens")
    pfor.write_tokens(none, path)
    assert pfor.read_tokens(spark, path).count() == 0
    assert substring.remove_repeats(none).count() == 0
    assert linededup.drop_repeated_lines(none).count() == 0 and linededup.dedup_lines(none).count() == 0
    one = frame([(1, "some words")])
    assert [r.n_hit for r in decontaminate.contamination(one, bench(spark, [])).collect()] == [0]
    assert queries.QUERIES.keys() >= {"op1_decontamination"}
