"""Operator 6, near-dedup with ProbMinHash over weighted word shingles.

1. Words are those of operator 1 (A-Z lower-cased); documents with the same
   words in the same order are one class, named by its smallest id.
2. A shingle is five words (a document of fewer, but not none, is one
   shingle); its weight is how often the document has it. Each shingle's
   arrivals are a Poisson process of rate weight, seeded by its hash, that
   visits the registers in an order of its own; a register keeps the first
   arrival. A shingle stops when its next arrival is later than the latest
   register. Two registers agree with the probability Jaccard similarity
   ``J_P``, which is the plain Jaccard similarity where weights are equal.
3. ``BANDS`` bands of ``ROWS`` registers make buckets. At 0.8 a pair shares
   no band with probability (1 - 0.8**ROWS)**BANDS, 5e-5. Buckets that hold
   the same classes are looked at once.
4. In a bucket the exact ``J_P`` of all pairs decides. Shared shingles of all
   pairs are counted by a matrix product; where all weights are one that gives
   ``J_P`` itself, else a bound on it, and the pairs that pass are computed. A
   task returns each class with the smallest class that links reach inside the
   bucket, so no pair is ever a row. A bucket over ``BLOCK`` classes is cut into
   blocks, and each pair of blocks is a group of its own.

Edge cases: documents without words link with nothing. Rows with the same id
are one document, which links if any of them does. A null id counts as the
largest. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import NO_ID, batches, group_cuts, id_text, packed_texts, stored, text_bytes, whole_groups, whole_rows
from mentions.llm.decontaminate import WORD_BYTES
from mentions.llm.graph import components
from mentions.llm.words import Slice, mix

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 127  # a prime: each step size visits all registers
BANDS, ROWS = 25, 5
BLOCK = 512
#: Shingles in one step of the matrix product.
COLUMNS = 4096
SLICE_BYTES = 2 << 20


def shingle_counts(words: Slice, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, shingle, weight)``, sorted, of the distinct shingles of each document."""
    at, hashes = words.grams(k, short=True)
    doc = words.doc[at]
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    begins = np.flatnonzero(new)
    return doc[begins], hashes[begins], np.diff(np.concatenate((begins, [len(doc)])))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: for each document and register the shingle that arrives first (0 where there is none)."""
    latest = np.full(n_docs * m, np.inf)
    winner = np.zeros(n_docs * m, np.uint64)
    seed = mix(shingle + np.uint64(0x632BE59BD9B4E019))
    place = (seed >> np.uint64(32)).astype(np.int64) % m
    stride = (seed & np.uint64(0xFFFFFFFF)).astype(np.int64) % (m - 1) + 1
    time = np.zeros(len(doc))
    rate = weight.astype(np.float64)
    for i in range(m):
        # the i-th of m exponential arrivals, one for each register, in order of time
        draw = mix(shingle ^ np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(uniform) * (m / (m - i)) / rate
        at = doc * m + place
        np.minimum.at(latest, at, time)
        won = latest[at] == time
        winner[at[won]] = shingle[won]
        bound = latest.reshape(n_docs, m).max(axis=1)
        stay = time < bound[doc]
        if not stay.any():
            break
        doc, shingle, rate, time, stride = doc[stay], shingle[stay], rate[stay], time[stay], stride[stay]
        place = (place[stay] + stride) % m
    return winner.reshape(n_docs, m)


def band_keys(winners: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each document (the band's number is part of it)."""
    total = np.zeros((len(winners), bands), np.uint64)
    parts = winners[:, :bands * rows].reshape(len(winners), bands, rows)
    for j in range(rows):
        total = mix(total * np.uint64(0xD1342543DE82EF95) + parts[:, :, j])
    return mix(total + np.arange(1, bands + 1, dtype=np.uint64)[None, :])


def probability_jaccard(x_keys, x_weights, y_keys, y_weights) -> float:
    """Exact ``J_P`` of two weighted sets (keys sorted, distinct):
    the sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    _, xi, yi = np.intersect1d(x_keys, y_keys, assume_unique=True, return_indices=True)
    if not len(xi):
        return 0.0
    x, y = x_weights[xi].astype(np.float64), y_weights[yi].astype(np.float64)
    only_x, only_y = x_weights.sum() - x.sum(), y_weights.sum() - y.sum()
    pairs, counts = np.unique(np.stack([x, y], axis=1), axis=0, return_counts=True)
    # one term for each pair of weights; the sum over j runs over pairs of weights too
    inner = np.maximum(pairs[None, :, 0] / pairs[:, None, 0], pairs[None, :, 1] / pairs[:, None, 1]) @ counts
    return float((counts / (only_x / pairs[:, 0] + only_y / pairs[:, 1] + inner)).sum())


def class_table(docs: DataFrame) -> DataFrame:
    """``doc_id, key, bands`` of each row: hash of its words (null without words) and its band keys."""
    def run(source):
        import xxhash

        for batch in batches(source, SLICE_BYTES):
            words = Slice(text_bytes(batch["text"]), WORD_BYTES)
            n = batch.num_rows
            keys = [None if not c else xxhash.xxh3_128_digest(b" ".join(words.words(f, f + c)))
                    for f, c in zip(words.first.tolist(), words.count.tolist(), strict=True)]
            own = band_keys(signatures(*shingle_counts(words), n)).view(np.int64)
            some = words.count > 0
            offsets = np.concatenate(([0], np.cumsum(np.where(some, BANDS, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(own[some].reshape(-1)))], names=["doc_id", "key", "bands"])

    return docs.mapInArrow(run, "doc_id long, key binary, bands array<long>")


def linked(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, similarity: float) -> np.ndarray:
    """For each of n documents the first document (by number) that links reach.

    ``doc, key, weight`` are sorted by document, then key.
    """
    cut = np.searchsorted(doc, np.arange(n + 1))
    labels = np.arange(n)
    if n == 2:
        x, y = slice(cut[0], cut[1]), slice(cut[1], cut[2])
        if probability_jaccard(key[x], weight[x], key[y], weight[y]) >= similarity:
            labels[1] = 0
        return labels
    sizes = np.diff(cut)
    total = np.bincount(doc, weight, n)
    unit = total == sizes
    _, column, holders = np.unique(key, return_inverse=True, return_counts=True)
    shared = holders[column] > 1
    at, column, share = doc[shared], column[shared], (weight / np.maximum(total, 1)[doc])[shared]
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    at, column, share = at[order], column[order], share[order]
    common, mass = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        has = np.zeros((n, min(COLUMNS, width - low)), np.float32)
        has[at[part], column[part] - low] = 1
        common += has @ has.T
        if not unit.all():
            part_mass = np.zeros_like(has)
            part_mass[at[part], column[part] - low] = share[part]
            mass += part_mass @ has.T
    # equal weights: J_P is the Jaccard similarity of the sets, exact in integers
    count = np.rint(common).astype(np.int64)
    joint = sizes[:, None] + sizes[None, :] - count
    both = unit[:, None] & unit[None, :]
    links = both & (count >= similarity * joint)
    labels = _reach(links, labels)
    # else J_P is at most the lesser of the two documents' shares of weight in common
    maybe = ~both & (np.minimum(mass, mass.T) >= similarity - 1e-4)
    for i, j in zip(*np.nonzero(np.triu(maybe, 1)), strict=True):
        if labels[i] != labels[j]:
            x, y = slice(cut[i], cut[i + 1]), slice(cut[j], cut[j + 1])
            if probability_jaccard(key[x], weight[x], key[y], weight[y]) >= similarity:
                labels[labels == max(labels[i], labels[j])] = min(labels[i], labels[j])
    return labels


def _reach(links: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smallest label of each connected part."""
    n = len(labels)
    while True:
        near = np.where(links, labels[None, :], n).min(axis=1, initial=n)
        new = np.minimum(labels, near)
        new = np.minimum(new, new[new])
        if (new == labels).all():
            return labels
        labels = new


def bucket_members(classes: DataFrame, block: int) -> DataFrame:
    """``band, x, y, rep``: the classes of each bucket of two or more, by pair of blocks ``x <= y``."""
    buckets = classes.select("rep", F.explode("bands").alias("band"))
    # two independent sums of hashes name a bucket's set of classes
    sums = [F.sum(F.xxhash64(F.lit(k), "rep").cast("decimal(20,0)")).alias(f"h{k}") for k in (1, 2)]
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"), *sums).where("n > 1")
    once = stored(sizes.groupBy("n", "h1", "h2").agg(F.min("band").alias("band")).select(
        "band", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "minhash-buckets")
    rows = buckets.join(once, "band").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "rep")


def bucket_links(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: each class of a bucket group with the smallest one that links inside the group reach."""
    group_of = ["band", "x", "y"]
    rows = members.join(texts.withColumnRenamed("doc_id", "rep"), "rep").repartition(*group_of).sortWithinPartitions(*group_of, "rep")

    def run(source):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for table in whole_groups(source, group_of):
            names = table["rep"].to_numpy()
            cuts = group_cuts(table, group_of)
            packed = table["packed"].to_pylist()
            reach = np.cumsum([0, *map(zstandard.frame_content_size, packed)])
            out_a, out_b = [], []
            start = 0
            while start < len(cuts) - 1:
                stop = start + 1
                while stop < len(cuts) - 1 and reach[cuts[stop + 1]] - reach[cuts[start]] <= SLICE_BYTES:
                    stop += 1
                first = cuts[start]
                texts = [press.decompress(x) for x in packed[first:cuts[stop]]]
                doc, key, weight = shingle_counts(Slice(texts, WORD_BYTES))
                for low, high in zip(cuts[start:stop], cuts[start + 1:stop + 1], strict=True):
                    own = slice(*np.searchsorted(doc, [low - first, high - first]))
                    labels = linked(doc[own] - (low - first), key[own], weight[own], high - low, similarity)
                    moved = np.flatnonzero(labels != np.arange(high - low))
                    out_a.append(names[low:high][labels[moved]])
                    out_b.append(names[low:high][moved])
                start = stop
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return rows.select(*group_of, "rep", "packed").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Classes of equal words and components of near-duplicates.

    Returns one row per input row: ``doc_id``, ``class_id`` (the smallest id
    with the same words), ``component_id`` (the smallest id reachable by
    links) and ``kept`` (the document names its component, or has no words).
    """
    base = id_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = stored(class_table(base), "minhash-rows")
    classes = stored(rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "minhash-classes")
    members = stored(bucket_members(classes, block), "minhash-members")
    # the ids grow with the corpus: they are sorted and merged with the texts, which travel compressed
    wanted = members.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    texts = packed_texts(base.where(F.col("text").isNotNull()), ["doc_id"]).join(wanted, "doc_id", "left_semi")
    labels = components(bucket_links(members, texts, similarity))
    reps = classes.select("key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("doc_id", "key").join(reps, "key", "left")
    null_id = lambda c: F.when(c != NO_ID, c)
    return out.select(null_id(F.col("doc_id")).alias("doc_id"),
                      null_id(F.coalesce("class_id", "doc_id")).alias("class_id"),
                      null_id(F.coalesce("component_id", "doc_id")).alias("component_id"),
                      (F.coalesce("component_id", "doc_id") == F.col("doc_id")).alias("kept"))


def dedup(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, less near-duplicates: one of each component stays.

    Rows with the same id stay or go together, but of rows equal in id and words one stays.
    """
    kept = near_duplicates(docs, similarity, id_col=id_col, text_col=text_col).where("kept").groupBy("doc_id").agg(
        (F.count(F.lit(1)) > 1).alias("repeated"))
    rows = whole_rows(docs, id_col).select("row", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"))
    found = rows.join(kept.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))), "doc_id")
    once = found.where(~F.col("repeated")).select("row.*")
    again = found.where("repeated").select("doc_id", "row", F.col("row").getField(text_col).alias("text"))
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]).select("row.*"))
