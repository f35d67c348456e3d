"""Operator 7, substring dedup with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. A word goes when it is covered by a
window whose word sequence also starts in a document with a smaller id.

1. *Anchors.* The anchor of a window is its least run of ``ANCHOR`` words by
   hash, so equal windows have equal anchors wherever they are. A document
   sends each change of anchor once, about one for five words, in compressed
   blocks. Anchors that only one document has are out of play; this is a
   filter, and loses nothing.
2. *Reference passages.* Documents with anchors in play give their passages:
   the stretch of windows with one anchor, at most ``2 * WINDOW - ANCHOR``
   words. Equal passages of a slice of documents give their words once, with
   the smallest document.
3. *Suffix automata.* Passages are dealt by anchor into reference shards of
   about ``SHARD_WORDS`` words. A shard's suffix automaton is built with the
   smallest document of each state; a passage that shares its anchor with no
   other passage is its own reference. Instead of sending every automaton to all
   documents, which would grow with the square of the corpus, the passages that
   could match (those with the same anchors) are streamed through it: matching
   statistics give, at each word, the state of the last ``WINDOW`` words and so
   the smallest document in which the window starts. The passages of an anchor
   with more than ``LARGE`` of them are cut into single windows, which are
   reduced map-side, so no group of passages is unbounded.
4. Windows met in a smaller document become spans; each document's spans are
   merged into maximal ones and removed.

Step 1 sends, for each anchor, at most one entry per slice of documents, as
anchors that two documents of a slice share are in play already. So a passage
in a third of all documents is spread and reduced before any shuffle.

Edge cases: a null or empty text has no words. Rows with the same id are one
document: they don't take words from each other. A null id counts as the
largest. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import NO_ID, batches, id_text, packed_texts, stored, text_bytes, unpacked_texts, whole_rows
from mentions.llm.words import Slice

WINDOW = 13
ANCHOR = 5
#: Bytes of an anchor's hash that are sent; a chance match costs a comparison, no more.
ANCHOR_BYTES = 6
SLICE_BYTES = 2 << 20
SEND_BYTES = 4 << 20
SHARD_WORDS = 40_000
LARGE = 4096
PART_BYTES = 16 << 20

#: ASCII white space separates words; all else is kept as it is.
BLANK_BYTES = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))


def window_anchors(words: Slice, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """``(word number, anchor)`` of every window of every document of the slice."""
    at, least = words.grams(anchor)
    if not len(at):
        return at, least
    n, width = len(words.hashes), window - anchor + 1
    full = np.full(n + window, np.iinfo(np.uint64).max, np.uint64)
    full[at] = least
    # the minimum over `width` neighbours by doubling
    span = 1
    while span < width:
        step = min(span, width - span)
        full[:len(full) - step] = np.minimum(full[:len(full) - step], full[step:])
        span += step
    left = np.repeat(words.first + words.count, words.count) - np.arange(n)
    begin = np.flatnonzero(left >= window)
    return begin, full[begin] & np.uint64((1 << 8 * ANCHOR_BYTES) - 1)


def _runs(words: Slice, begin: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Where a stretch of windows of one document with one anchor begins (indices into ``begin``)."""
    if not len(begin):
        return np.empty(0, np.int64)
    doc = words.doc[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
    return np.flatnonzero(new)


def _small(values: np.ndarray) -> tuple[int, bytes]:
    """Integers as their least one and the differences to it, in 2, 4 or 8 bytes each."""
    base = int(values.min())
    rest = (values - base).astype(np.uint64)
    top = int(rest.max())
    return base, rest.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _large(base: int, raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) + base


def anchors_in_play(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc_id, anchor``: the anchors of each document that another one has too (and, by chance of hashing, a few more)."""
    total = docs.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    parts = max(8, -(-total // PART_BYTES))
    types = [("part", pa.int32()), ("known", pa.bool_()), ("anchors", pa.binary()), ("base", pa.int64()), ("docs", pa.binary())]
    schema = "part int, known boolean, anchors binary, base long, docs binary"

    def packed(part, known, anchors, ids):
        blob = np.ascontiguousarray(anchors.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BYTES]).tobytes()
        return part, known, blob, *_small(ids)

    def unpacked(blob, base, ids):
        n = len(blob) // ANCHOR_BYTES
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :ANCHOR_BYTES] = np.frombuffer(blob, np.uint8).reshape(n, ANCHOR_BYTES)
        return wide.reshape(-1).view("<u8"), _large(base, ids, n)

    def send(source):
        for batch in batches(source, SEND_BYTES):
            words = Slice(text_bytes(batch["text"]), BLANK_BYTES)
            begin, found = window_anchors(words, window, anchor)
            at = _runs(words, begin, found)
            if not len(at):
                continue
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)[words.doc[begin[at]]]
            found = found[at]
            order = np.lexsort((ids, found))
            found, ids = found[order], ids[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (ids[1:] != ids[:-1])
            found, ids = found[new], ids[new]
            cuts = np.concatenate(([0], np.flatnonzero(found[1:] != found[:-1]) + 1))
            last = np.concatenate((cuts[1:], [len(found)])) - 1
            known = np.repeat(last > cuts, last - cuts + 1)
            where = (found % np.uint64(parts)).astype(np.int64)
            out = []
            if known.any():
                # two documents of this slice: in play whatever others hold
                for part in np.unique(where[known]):
                    mine = known & (where == part)
                    out.append(packed(int(part), True, found[mine], ids[mine]))
            # others must hear of each anchor, from two documents at most
            rest = np.zeros(len(found), bool)
            rest[cuts] = rest[last] = True
            for part in np.unique(where[rest]):
                mine = rest & (where == part)
                out.append(packed(int(part), False, found[mine], ids[mine]))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, (_, t) in enumerate(types)],
                                             names=[n for n, _ in types])

    def judge(source):
        kept: list[list] = [[], []]

        def rows(found, ids):
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found.view(np.int64))], names=["doc_id", "anchor"])

        def shared():
            """Those of the part's anchors that two documents have."""
            found, ids = map(np.concatenate, kept)
            kept[0], kept[1] = [], []
            order = np.argsort(found, kind="stable")
            found, ids = found[order], ids[order]
            cuts = np.concatenate(([0], np.flatnonzero(found[1:] != found[:-1]) + 1))
            sizes = np.diff(np.concatenate((cuts, [len(found)])))
            both = np.repeat(np.minimum.reduceat(ids, cuts) != np.maximum.reduceat(ids, cuts), sizes)
            return rows(found[both], ids[both])

        last = None
        for batch in source:  # sorted by part: a task holds one part at a time
            for part, known, *blobs in zip(*[batch[n].to_pylist() for n, _ in types], strict=True):
                if part != last and kept[0]:
                    yield shared()
                last = part
                found, ids = unpacked(*blobs)
                if known:
                    yield rows(found, ids)
                else:
                    kept[0].append(found)
                    kept[1].append(ids)
        if kept[0]:
            yield shared()

    sent = docs.select("doc_id", "text").mapInArrow(send, schema)
    return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(judge, "doc_id long, anchor long")


def passages(docs: DataFrame, lists: DataFrame, window: int, anchor: int) -> DataFrame:
    """``anchor, key, doc_id, version, start, words``: the passages of documents around their anchors in play.

    ``key`` is the hash of the passage's words; with the anchor it names the
    passage. A slice gives the words of equal passages once, with the smallest
    document that has it; its other rows have null words.
    """
    def run(source):
        import xxhash

        for batch, texts in unpacked_texts(source, SLICE_BYTES):
            words = Slice([t or b"" for t in texts], BLANK_BYTES)
            begin, found = window_anchors(words, window, anchor)
            at = _runs(words, begin, found)
            if not len(at):
                continue
            ends = np.concatenate((at[1:], [len(begin)]))
            play = np.sort(batch["anchors"].flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            # an anchor in play for one row of the slice is so for all: equal hash, another document
            near = np.searchsorted(play, found[at])
            hit = np.flatnonzero((near < len(play)) & (play[np.minimum(near, max(0, len(play) - 1))] == found[at]))
            row = words.doc[begin[at[hit]]]
            low, high = begin[at[hit]], begin[ends[hit] - 1] + window
            texts = [b" ".join(words.words(x, y)) for x, y in zip(low.tolist(), high.tolist(), strict=True)]
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts)).view(np.int64)
            anchors = found[at[hit]].view(np.int64)
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)[row]
            versions = batch["version"].take(pa.array(row))
            order = np.lexsort((ids, keys, anchors))
            again = np.zeros(len(order), bool)
            again[order[1:]] = (anchors[order[1:]] == anchors[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(keys), pa.array(ids), versions,
                 pa.array((low - words.first[row]).astype(np.int32)), pa.array(texts, pa.binary(), mask=again)],
                names=["anchor", "key", "doc_id", "version", "start", "words"])

    return packed_texts(docs, ["doc_id", "version"]).join(lists, "doc_id").select("doc_id", "version", "packed", "anchors").mapInArrow(
        run, "anchor long, key long, doc_id long, version binary, start int, words binary")


class SuffixAutomaton:
    """Suffix automaton of word sequences; each state knows the smallest document that holds its strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [NO_ID]

    def add(self, words: list[bytes], doc: int) -> None:
        """Add a sequence of ``doc``; call :meth:`close` after the last."""
        last = 0
        step, link, length, least = self.next, self.link, self.length, self.least
        for w in words:
            here = step[last].get(w)
            if here is not None and length[here] == length[last] + 1:
                last = here
            elif here is not None:
                last = self._split(last, here, w)
            else:
                now = len(length)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                least.append(NO_ID)
                p = last
                while p != -1 and w not in step[p]:
                    step[p][w] = now
                    p = link[p]
                if p != -1:
                    q = step[p][w]
                    link[now] = q if length[q] == length[p] + 1 else self._split(p, q, w)
                last = now
            if doc < least[last]:
                least[last] = doc

    def _split(self, p: int, q: int, w: bytes) -> int:
        """A copy of state q for the strings that end p + w; returns it."""
        step, link, length, least = self.next, self.link, self.length, self.least
        copy = len(length)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        least.append(NO_ID)
        link[q] = copy
        while p != -1 and step[p].get(w) == q:
            step[p][w] = copy
            p = link[p]
        return copy

    def close(self) -> None:
        """Let shorter strings know the documents of the longer ones that they end."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.least[state] < self.least[up]:
                self.least[up] = self.least[state]

    def matching(self, words: list[bytes]):
        """Matching statistics: at each word, the state and length of the longest match that ends there."""
        state, n = 0, 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state, n = self.next[state][w], n + 1
            yield state, n

    def first_documents(self, words: list[bytes], window: int) -> list[int]:
        """For each window of ``words`` the smallest document that holds it (``NO_ID``: none)."""
        out = []
        for i, (state, n) in enumerate(self.matching(words)):
            if i < window - 1:
                continue
            if n < window:
                out.append(NO_ID)
                continue
            while self.length[self.link[state]] >= window:
                state = self.link[state]
            out.append(self.least[state])
        return out


def _shard(group: list[tuple], window: int) -> list[tuple]:
    """Windows' smallest documents of the passages (anchor, key, words, doc) of one reference shard."""
    automaton = SuffixAutomaton()
    split = [(anchor, key, text.split(b" "), doc) for anchor, key, text, doc in group]
    for _, _, words, doc in split:
        automaton.add(words, doc)
    automaton.close()
    return [(anchor, key, automaton.first_documents(words, window)) for anchor, key, words, _ in split]


def shard_matches(references: DataFrame, window: int, shard_words: int) -> DataFrame:
    """``anchor, key, firsts``: for each passage the smallest document of each of its windows.

    ``references`` has ``anchor, key, words, first``, a passage once for each slice that holds it.
    """
    dealt = references.repartition("anchor").sortWithinPartitions("anchor", "key", "first")
    names = ["anchor", "key", "words", "first"]

    def run(source):
        group: list[tuple] = []  # one anchor's passages, each once
        shard: list[tuple] = []
        done: list[tuple] = []
        size = 0

        def take():
            """Move the group to the shard; a lone passage is its own reference."""
            if len(group) == 1:
                anchor, key, text, doc = group[0]
                done.append((anchor, key, [doc] * (text.count(b" ") + 2 - window)))
                return 0
            shard.extend(group)
            return sum(text.count(b" ") + 1 for _, _, text, _ in group)

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in done], pa.list_(pa.int64()) if c == 2 else pa.int64()) for c in range(3)],
                names=["anchor", "key", "firsts"])
            done.clear()
            return out

        for batch in source:
            for passage in zip(*[batch[c].to_pylist() for c in names], strict=True):
                if group and passage[0] != group[-1][0]:
                    size += take()
                    group = []
                    if size >= shard_words or len(done) >= shard_words:
                        done.extend(_shard(shard, window))
                        shard, size = [], 0
                        yield rows()
                if not group or passage[1] != group[-1][1]:
                    group.append(passage)  # sorted: the smallest document comes first
        if group:
            take()
        if shard:
            done.extend(_shard(shard, window))
        if done:
            yield rows()

    return dealt.select(*names).mapInArrow(run, "anchor long, key long, firsts array<long>")


def window_matches(references: DataFrame, window: int) -> DataFrame:
    """As :func:`shard_matches`, for passages of very frequent anchors: each window goes by its own hash."""
    def run(source):
        import xxhash

        for batch in source:
            rows = []
            for anchor, key, text, first in zip(*[batch[c].to_pylist() for c in ("anchor", "key", "words", "first")], strict=True):
                words = text.split(b" ")
                rows += [(anchor, key, i, xxhash.xxh3_128_digest(b" ".join(words[i:i + window])), first)
                         for i in range(len(words) - window + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(
                [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()])], names=["anchor", "key", "at", "window", "first"])

    once = references.groupBy("anchor", "key").agg(F.first("words").alias("words"), F.min("first").alias("first"))
    windows = stored(once.mapInArrow(run, "anchor long, key long, at int, window binary, first long"), "substring-windows")
    firsts = windows.groupBy("window").agg(F.min("first").alias("least"))
    return windows.join(firsts, "window").groupBy("anchor", "key").agg(
        F.sort_array(F.collect_list(F.struct("at", "least"))).alias("f")).select("anchor", "key", F.col("f.least").alias("firsts"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS,
                   large: int = LARGE) -> DataFrame:
    """``doc_id, version, starts``: of the rows ``doc_id, version, text`` that lose words, the word numbers at
    which windows of smaller documents start."""
    lists = anchors_in_play(docs, window, anchor).groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    found = stored(passages(docs, lists, window, anchor), "substring-passages")
    references = found.where(F.col("words").isNotNull()).select("anchor", "key", "words", F.col("doc_id").alias("first"))
    crowded = stored(references.groupBy("anchor").count().where(F.col("count") > large).select("anchor"), "substring-crowded")
    firsts = shard_matches(references.join(crowded, "anchor", "left_anti"), window, shard_words).unionByName(
        window_matches(references.join(crowded, "anchor", "left_semi"), window))
    met = found.select("anchor", "key", "doc_id", "version", "start").join(firsts, ["anchor", "key"])
    # start of each window that a smaller document has
    starts = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    return met.select("doc_id", "version", starts.alias("starts")).where(F.size("starts") > 0).groupBy("doc_id", "version").agg(
        F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Remove the words that windows of smaller documents cover.

    Returns one row per input row: ``doc_id``, ``row`` (the input row),
    ``n_words``, ``n_removed``, ``spans`` (maximal removed word spans) and
    ``kept`` (the other words, joined by one space).
    """
    number = F.coalesce("doc_id", F.lit(NO_ID))

    def version(text):
        return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))

    texts = id_text(docs, id_col, text_col).select(number.alias("doc_id"), version(F.col("text")).alias("version"), "text")
    lost = repeated_spans(texts, window, **options)
    # the version, 128 bits, tells rows of one id apart; the text travels compressed, beside the rest of the row
    whole, text = whole_rows(docs, id_col), F.col("row").getField(text_col)
    bare = F.struct(*[(F.lit(None).cast(kind) if c == text_col else F.col("row").getField(c)).alias(c) for c, kind in docs.dtypes])
    base = packed_texts(whole.select(number.alias("doc_id"), version(text.cast("string")).alias("version"), bare.alias("row"),
                                     text.cast("string").alias("text")), ["doc_id", "version", "row"])
    schema = whole.select("doc_id", "row", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                          F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.lit("").alias("kept")).schema
    place = docs.columns.index(text_col)

    def run(source):
        for batch, texts in unpacked_texts(source, SLICE_BYTES):
            n_words, n_removed, spans, kept = [], [], [], []
            for text, starts in zip(texts, batch["starts"], strict=True):
                words = (text or b"").translate(BLANK_BYTES).split(b" ")
                words = [w for w in words if w]
                gone = np.zeros(len(words) + 1, np.int64)
                if starts.is_valid:
                    at = np.unique(starts.values.to_numpy())
                    gone[at] += 1
                    np.add.at(gone, at + window, -1)
                cover = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], cover.view(np.int8), [0]))))
                n_words.append(len(words))
                n_removed.append(int(cover.sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                kept.append(b" ".join(words if not len(edges) else [w for w, c in zip(words, cover.tolist(), strict=True) if not c])
                            .decode())
            row = batch["row"]
            fields = [row.type.field(i) for i in range(row.type.num_fields)]
            parts = row.flatten()
            parts[place] = pa.array([None if t is None else t.decode() for t in texts], pa.string()).cast(fields[place].type)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.StructArray.from_arrays(parts, fields=fields), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
                names=["doc_id", "row", "n_words", "n_removed", "spans", "kept"])

    out = base.join(lost, ["doc_id", "version"], "left").select("doc_id", "row", "packed", "starts").mapInArrow(run, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
