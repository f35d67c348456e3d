"""Operator 13, alignment of two tokenizers with inverted pair bitmaps.

A text with a space before it is encoded by a byte-level BPE (A) and by a
sentencepiece model (B, which adds the space itself). Offsets in bytes where
tokens of both end cut the text into groups; the A and the B token that end at
one offset are linked.

1. *Bitmaps.* A task takes chunks of about ``CHUNK_BYTES`` of documents and
   numbers the documents of a chunk. For each pair (A id, B id) linked there it
   keeps the bitmap of the documents that hold the pair (plane -1), and, where
   a document holds it several times, multiplicity planes: plane k has the
   documents whose multiplicity less one has bit k. The slices of a chunk are
   OR-merged. A bitmap is stored as sorted 16-bit numbers or as bits, whichever
   is shorter, with its population count.
2. *Counts.* Chunks hold different documents, so the corpus bitmap of a pair is
   its chunks' bitmaps side by side, and population counts add up: those of
   plane -1 to the pair's documents, those of all planes, weighted by 1 and
   2^k, to its links. The pair with most links of a B id, ties included, is
   its best. The table of pairs is bounded by the two vocabularies.
3. *Postings return scores.* Each bitmap is joined with its pair's count and
   goes back to its chunk, where it adds the count to its documents, by their
   multiplicity.

A pair that most documents hold is one short row per chunk; links are never
rows. Chunks bound the memory of every step.

Edge cases: a text that is null, empty, or that either tokenizer doesn't give
back byte by byte has no tokens: zeros, and '' for its groups. Special tokens'
strings are plain text. Each row is a document, rows that share an id too. An
empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentions.llm.common import batches, group_cuts, id_text, stored, whole_groups, worker_cache
from mentions.llm.tokens import byte_letters

SLICE_BYTES = 1 << 20
CHUNK_BYTES = 8 << 20
#: Documents of a chunk at most: they are numbered in 16 bits.
CHUNK_ROWS = 1 << 15
DOCUMENT, POSTING = 0, 1


def tokenizer_paths() -> tuple[str, str]:
    """Paths of the two public tokenizer files (each executor has the package)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


#: Characters after which a text isn't cut: all that some tokenizer might take for white space, with a blank or line feed after them.
NO_CUT = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u2581\u3000\ufeff"
UNUSUAL = re.compile(f"[{NO_CUT}][ \n]")
CUT = re.compile(f"(?<=[^{NO_CUT}])(?=[ \n])")
#: Characters of names and groups that a worker remembers; results don't depend on it.
CACHE_CHARS = 24 << 20


class Numbers(dict):
    """Numbers of names, in the order in which they are first asked for; ``new`` has those not dealt with yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str | tuple[str]] = []

    def __missing__(self, name):
        number = self[name] = len(self)
        self.new.append(name)
        return number


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the segments met before, for one worker.

    No token of either crosses the place before a blank or a line feed that
    follows another character (A's pattern has blanks in front only, and B's
    pieces are looked through), and what stands on one side doesn't change
    the other's tokens. So both have an end there, and a text's alignment is
    those of its segments in turn. A tokenizer for which this doesn't hold
    gets whole texts.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = {chr(c): byte for byte, c in byte_letters().items()}
        entries = {i: e for e, i in self.a.get_vocab().items()}
        self.bytes_a = [bytes(letters[c] for c in entries[i]) if i in entries and all(c in letters for c in entries[i]) else b""
                        for i in range(max(entries) + 1)]
        self.bytes_b = [self.piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.shown_a = np.array([f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"], object)
        self.shown_b = np.array([f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"], object)
        form = json.loads(self.a.to_str())
        apart = form["normalizer"] is None and form["pre_tokenizer"]["type"] == "ByteLevel" and form["pre_tokenizer"]["use_regex"]
        apart = apart and not any(re.search(b"[^ \n][ \n]", p) for i, p in enumerate(self.bytes_b) if not self.b.is_byte(i))
        self.cut = apart and len(self.b.encode("a")) == 1
        self.forget()

    def forget(self) -> None:
        """Start with no segments. Of each, by its number: whether the bytes of both are the text's, how many tokens
        each has, how many links, the linked ids (``a << 32 | b``, one segment after the other) and its groups."""
        self.numbers, self.chars, self.groups = Numbers(), 0, []
        self.same, self.links = np.empty(0, bool), np.empty(0, np.int64)
        self.n_a, self.n_b, self.width = (np.empty(0, np.int64) for _ in range(3))

    def piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def names(self, text: str) -> list[str | tuple[str]]:
        """The names of the text's segments: what follows its blank; one that begins with a line feed itself; others in a tuple."""
        if not text:
            return []
        whole = " " + text
        if not self.cut:
            return [(whole,)]
        if not UNUSUAL.search(whole):
            return text.replace("\n", " \n").split(" ")
        return [s if s[0] == "\n" else s[1:] if s[1:2] != "\n" else (s,) for s in CUT.split(whole)]

    def segments(self, names: list[list[str | tuple[str]]]) -> list[np.ndarray]:
        """The numbers of each text's segments; what is new is encoded."""
        if self.chars > CACHE_CHARS:
            self.forget()
        out = [np.fromiter(map(self.numbers.__getitem__, n), np.int64, len(n)) for n in names]
        new, self.numbers.new = self.numbers.new, []
        if new:
            same, n_a, n_b, width, links, groups = self.aligned([n[0] if isinstance(n, tuple) else n if n[:1] == "\n" else " " + n for n in new])
            self.groups += groups
            self.chars += sum(map(len, groups)) + sum(map(len, new))
            self.same, self.n_a, self.n_b, self.width, self.links = (np.concatenate(x) for x in (
                (self.same, same), (self.n_a, n_a), (self.n_b, n_b), (self.width, width), (self.links, links)))
        return out

    def aligned(self, texts: list[str]) -> tuple:
        """The segments' alignment, all at once: see :meth:`forget`."""
        # B adds a blank: instead of the segment's own, or before a letter that is taken off again
        own = [t[0] == " " and len(t) > 1 for t in texts]
        b = self.b.encode([t[1:] if blank else "a" + t for t, blank in zip(texts, own, strict=True)], num_threads=1)
        b = [x if blank else x[1:] for x, blank in zip(b, own, strict=True)]
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        raw = [t.encode() for t in texts]
        same = given_back(raw, a, self.bytes_a) & given_back(raw, b, self.bytes_b)
        if not same.all():
            a, b = ([x if s else [] for x, s in zip(ids, same.tolist(), strict=True)] for ids in (a, b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        own_a, own_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        # both have the same bytes, text by text, so their ends can be compared across texts
        ends_a, ends_b = np.cumsum(self.size_a[own_a]), np.cumsum(self.size_b[own_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        links = own_a[last_a] << 32 | own_b[last_b]
        width = np.bincount(np.searchsorted(np.cumsum(n_a), last_a, "right"), minlength=len(texts))
        # shown: each id with the mark that follows it, a group's A ids before its B ids
        final_a, final_b = np.zeros(len(own_a), np.int64), np.zeros(len(own_b), np.int64)
        final_a[last_a], final_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(final_a) - final_a, np.cumsum(final_b) - final_b
        shown = np.empty(len(own_a) + len(own_b), object)
        shown[np.arange(len(own_a)) + np.concatenate(([0], last_b + 1))[group_a]] = self.shown_a[2 * own_a + final_a]
        shown[np.arange(len(own_b)) + (last_a + 1)[group_b]] = self.shown_b[2 * own_b + final_b]
        shown, cuts = shown.tolist(), [0, *np.cumsum(n_a + n_b).tolist()]
        groups = ["".join(shown[s:e])[:-1] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        return same, n_a, n_b, width, links, groups


def given_back(raw: list[bytes], ids: list[list[int]], table: list[bytes]) -> np.ndarray:
    """Whether the tokens' bytes are the text's, and none is without bytes."""
    parts = [[table[i] for i in own] for own in ids]
    if b"".join(chain.from_iterable(parts)) == b"".join(raw) and all(map(all, parts)) and all(
            sum(map(len, p)) == len(r) for p, r in zip(parts, raw, strict=True)):
        return np.ones(len(raw), bool)
    return np.fromiter((b"".join(p) == r and all(p) for p, r in zip(parts, raw, strict=True)), bool, len(raw))


class Slice:
    """Groups and links of texts that follow one another."""

    def __init__(self, texts: list[str], encoders: Encoders):
        rows = len(texts)
        segments = encoders.segments([encoders.names(t) for t in texts])
        own, doc = np.concatenate(segments), np.repeat(np.arange(rows), [len(s) for s in segments])
        bad = np.zeros(rows, bool)
        bad[doc[~encoders.same[own]]] = True
        shown = encoders.groups
        self.groups = ["" if b else ";".join([shown[k] for k in s.tolist()]) for s, b in zip(segments, bad.tolist(), strict=True)]
        # each segment of a document once, with how often it occurs
        many = max(1, len(shown))
        both, times = np.unique((doc * many + own)[~bad[doc]], return_counts=True)
        doc, own = both // many, both % many

        def total(values):
            out = np.zeros(rows, np.int64)
            np.add.at(out, doc, values[own] * times)
            return out

        self.n_a, self.n_b, self.n_groups = total(encoders.n_a), total(encoders.n_b), total(encoders.width)
        width, first = encoders.width[own], (np.cumsum(encoders.width) - encoders.width)[own]
        at = np.repeat(first - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        #: linked ids, the document, and how often: one entry for each link of each different segment of a document
        self.links = encoders.links[at], np.repeat(doc, width), np.repeat(times, width)


def bitmaps(owner: np.ndarray, slots: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``(owner, population count, bytes)`` of the bitmaps of (owner, slot) entries, sorted by both, over ``rows`` documents."""
    if not len(owner):
        return owner, owner, []
    cuts = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]))
    counts = np.diff(cuts)
    raw = slots.astype("<u2").tobytes()
    width = -(-rows // 8)
    out = [raw[2 * s:2 * e] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    for k in np.flatnonzero(2 * counts > width).tolist():
        bits = np.zeros(8 * width, np.uint8)
        bits[slots[cuts[k]:cuts[k + 1]]] = 1
        out[k] = np.packbits(bits, bitorder="little").tobytes()
    return owner[cuts[:-1]], counts, out


def slots_of(bits: bytes, count: int) -> np.ndarray:
    """The documents of a bitmap. Bits are only kept where they are shorter than ``2 * count`` bytes."""
    if len(bits) == 2 * count:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def merge(entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """OR of the slices' (pair, document) entries: each once, sorted, with its multiplicity."""
    pairs, slots, times = (np.concatenate(x) for x in zip(*entries, strict=True))
    names, number = np.unique(pairs, return_inverse=True)
    both, place = np.unique(number.astype(np.int64) << 16 | slots, return_inverse=True)
    count = np.zeros(len(both), np.int64)
    np.add.at(count, place, times)
    return names[both >> 16], both & 0xFFFF, count


SCHEMA = ("kind int, chunk long, slot int, doc_id long, n_a long, n_b long, n_groups long, groups string, "
          "a int, b int, plane int, held int, bits binary")
DOC_COLUMNS = ["slot", "doc_id", "n_a", "n_b", "n_groups", "groups"]
PAIR_COLUMNS = ["a", "b", "plane", "held", "bits"]
KINDS = {"slot": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups": pa.string(),
         "a": pa.int32(), "b": pa.int32(), "plane": pa.int32(), "held": pa.int32(), "bits": pa.binary()}


def _rows(kind: int, chunk: int, columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, chunk, np.int64))]
    arrays += [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in KINDS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "chunk", *KINDS])


def indexed(docs: DataFrame, paths: tuple[str, str] | None, chunk_bytes: int) -> DataFrame:
    """Rows of two kinds, for each chunk its documents and its pairs' bitmaps. ``docs`` has ``doc_id`` and ``text``."""
    def run(source):
        names = paths or tokenizer_paths()
        enc = worker_cache(f"encoders {names}", lambda: Encoders(*names))
        chunk, rows, size, entries = TaskContext.get().partitionId() << 32, 0, 0, []

        def postings():
            pairs, slots, count = merge(entries)
            for plane in range(-1, int(count.max(initial=1) - 1).bit_length()):
                at = slice(None) if plane < 0 else np.flatnonzero((count - 1) >> plane & 1)
                owner, held, bits = bitmaps(pairs[at], slots[at], rows)
                yield _rows(POSTING, chunk, {"a": (owner >> 32).astype(np.int32), "b": (owner & 0xFFFFFFFF).astype(np.int32),
                                             "plane": np.full(len(owner), plane, np.int32), "held": held.astype(np.int32), "bits": bits})

        for batch in batches(source, SLICE_BYTES):
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                if rows and (size + part.nbytes > chunk_bytes or rows + part.num_rows > CHUNK_ROWS):
                    yield from postings()
                    chunk, rows, size, entries = chunk + 1, 0, 0, []
                found = Slice([t or "" for t in part["text"].to_pylist()], enc)
                pairs, slots, times = found.links
                entries.append((pairs, slots + rows, times))
                yield _rows(DOCUMENT, chunk, {
                    "slot": np.arange(rows, rows + part.num_rows, dtype=np.int32), "doc_id": part["doc_id"], "n_a": found.n_a,
                    "n_b": found.n_b, "n_groups": found.n_groups, "groups": found.groups})
                rows, size = rows + part.num_rows, size + part.nbytes
        if rows:
            yield from postings()

    return docs.mapInArrow(run, SCHEMA)


def weight() -> Column:
    """What a document of a plane adds to its multiplicity."""
    return F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane"))).cast("long")


def pair_scores(postings: DataFrame) -> DataFrame:
    """``a, b, n_docs, n_links, best``: corpus counts of each pair by population counts; ``best`` of its B id."""
    counts = postings.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") < 0, F.col("held"))).alias("n_docs"),
                                            F.sum(F.col("held") * weight()).alias("n_links"))
    most = F.max("n_links").over(Window.partitionBy("b"))  # at most one row for each A id
    return counts.select("a", "b", "n_docs", "n_links", (F.col("n_links") == most).alias("best"))


def scored_documents(index: DataFrame, scores: DataFrame) -> DataFrame:
    """The documents of the index with the sums that their bitmaps bring back."""
    found = (index.where(F.col("kind") == POSTING).select("chunk", *PAIR_COLUMNS)
             .join(scores.select("a", "b", F.col("n_links").alias("count"), "best"), ["a", "b"])
             .select("chunk", F.lit(POSTING).alias("kind"), *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in DOC_COLUMNS],
                     weight().alias("weight"), "held", "bits", "count", "best"))
    whole = index.where(F.col("kind") == DOCUMENT).select(
        "chunk", "kind", *DOC_COLUMNS, *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("weight", "held", "bits", "count", "best")])
    dealt = whole.unionByName(found).repartition("chunk").sortWithinPartitions("chunk", "kind", "slot")

    def run(source):
        for table in whole_groups(source, ["chunk"]):
            cuts = group_cuts(table, ["chunk"])
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(s, e - s).combine_chunks()
                n = int((part["kind"].to_numpy() == DOCUMENT).sum())
                rows, posts = part.slice(0, n), part.slice(n)
                best_sum, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
                held = posts["held"].to_numpy()
                if len(held):
                    slots = np.concatenate([slots_of(b, c) for b, c in zip(posts["bits"].to_pylist(), held.tolist(), strict=True)])
                    times = np.repeat(posts["weight"].to_numpy(), held)
                    np.add.at(count_sum, slots, times * np.repeat(posts["count"].to_numpy(), held))
                    np.add.at(best_sum, slots, times * np.repeat(posts["best"].to_numpy().astype(np.int64), held))
                # documents are numbered from 0 in their chunk and sorted
                yield from pa.Table.from_arrays(
                    [rows["doc_id"], rows["n_a"], rows["n_b"], rows["n_groups"], rows["n_groups"], pa.array(best_sum), pa.array(count_sum),
                     rows["groups"]], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]).to_batches()

    return dealt.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def align(docs: DataFrame, paths: tuple[str, str] | None = None, render: Callable[[Column], Column] = lambda groups: groups,
          chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``render`` is applied to the groups' text as soon as it is made; a caller
    who only needs a digest of it then moves no more than that.
    """
    index = indexed(id_text(docs, id_col, text_col), paths, chunk_bytes).withColumn("groups", render(F.col("groups")))
    index = stored(index, "alignment-index")
    scores = stored(pair_scores(index.where(F.col("kind") == POSTING)), "alignment-scores")
    return scored_documents(index, scores)


def pair_table(docs: DataFrame, paths: tuple[str, str] | None = None, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``a, b, n_docs, n_links, best``: in how many documents, and how often, two ids are linked."""
    index = stored(indexed(id_text(docs, id_col, text_col), paths, chunk_bytes).where(F.col("kind") == POSTING), "alignment-index")
    return pair_scores(index)
