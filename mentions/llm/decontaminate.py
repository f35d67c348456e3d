"""Operator 1, benchmark decontamination with suffix arrays of training shards.

A shard is a slice of a partition, about ``SHARD_BYTES`` of documents. Inside
a task, a shard's words become the integer ids of the benchmark's vocabulary
(0: not in it), and its suffixes that could hold a whole window are sorted by
prefix doubling. All test suffixes are then binary-searched at once. The
benchmark comes in blocks of at most ``BLOCK_BYTES``, equal rows once, each
broadcast on its own and dropped before the next. With one block documents are
never shuffled, so a hot source or a passage that many documents share costs
no more than its words; with more, documents are joined once with all hits.

Edge cases: a null or empty text has no words and no hits. An item without
words has no window. A null item id is written ``null``. Repeated rows each
get their own result. Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import batches, id_text, row_texts, stored, text_bytes, whole_rows

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
#: What an item counts for in a block besides its text and id.
ROW_BYTES = 64

#: Bytes of a word after lower-casing A-Z: digits, a-z and all of non-ASCII.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class ItemBlock:
    """One block of benchmark items: vocabulary, suffixes and distinct windows."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        ids = [[self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)] for _, text in items]
        self.depth = max([window, *map(len, ids)])
        windows: dict[tuple, list[tuple[int, int]]] = {}
        for i, item in enumerate(ids):
            n = min(window, len(item))
            for at in range(len(item) - n + 1 if n else 0):
                windows.setdefault(tuple(item[at:at + n]), []).append((i, at))
        self.windows = sorted(windows)
        self.places = [windows[w] for w in self.windows]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.shortest = int(self.lengths.min()) if len(self.windows) else 0
        self.grid = np.zeros((len(self.windows), window), np.int64)
        for k, w in enumerate(self.windows):
            self.grid[k, :len(w)] = w
        self.ids = ids


def suffix_array(ids: np.ndarray, shortest: int, depth: int) -> np.ndarray:
    """Positions inside runs of at least ``shortest`` known words, ordered by
    the ``depth`` words that follow (unknown words and the end sort first)."""
    known = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return np.empty(0, np.int64)
    sizes = ends - starts
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    rank = np.zeros(len(ids) + depth + 1, np.int64)
    rank[at] = ids[at]
    step = 1
    while step < depth:
        key = rank[at] * (rank[at].max() + 1 + len(at)) + rank[np.minimum(at + step, len(rank) - 1)]
        kinds, dense = np.unique(key, return_inverse=True)
        rank[at] = dense + 1
        if len(kinds) == len(at):
            break
        step *= 2
    return at[np.argsort(rank[at], kind="stable")]


def search(ids: np.ndarray, order: np.ndarray, queries: np.ndarray, lengths: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all queries at once: where each would be inserted in
    ``order``, before or ``after`` the suffixes that start with it."""
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
    span = np.arange(queries.shape[1])
    inside = span[None, :] < lengths[:, None]
    while (open_ := lo < hi).any():
        rows = np.flatnonzero(open_)
        mid = (lo[rows] + hi[rows]) // 2
        here = ids[np.minimum(order[mid][:, None] + span[None, :], len(ids) - 1)]
        delta = np.where(inside[rows], here - queries[rows], 0)
        differs = delta != 0
        first = differs.argmax(axis=1)
        sign = np.sign(delta[np.arange(len(rows)), first])
        go_right = (sign < 0) | ((sign == 0) & after)
        lo[rows] = np.where(go_right, mid + 1, lo[rows])
        hi[rows] = np.where(go_right, hi[rows], mid)
    return lo


def shard_ids(texts: list[bytes], vocab: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of a shard (a 0 after each document), the documents' starts and word counts."""
    parts, counts = [], np.empty(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = words_of(text)
        counts[k] = len(found)
        parts.append(np.fromiter(map(vocab.get, found, repeat(0)), np.int64, len(found)))
        parts.append(np.zeros(1, np.int64))
    starts = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
    return np.concatenate(parts), starts, counts


def window_hits(ids: np.ndarray, order: np.ndarray, block: ItemBlock) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every occurrence of a window in the shard."""
    lo = search(ids, order, block.grid, block.lengths, after=False)
    hi = search(ids, order, block.grid, block.lengths, after=True)
    sizes = hi - lo
    which = np.repeat(np.arange(len(sizes)), sizes)
    at = np.repeat(lo - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    return order[at], which


def longest_in_shard(ids: np.ndarray, order: np.ndarray, block: ItemBlock, found: np.ndarray) -> list[tuple]:
    """(item, item start, position, words) of the longest verbatim match of each
    test suffix that has a whole window in the shard."""
    suffixes = [(i, at) for w in np.unique(found) for i, at in block.places[w]]
    if not suffixes:
        return []
    lengths = np.array([len(block.ids[i]) - at for i, at in suffixes], np.int64)
    queries = np.zeros((len(suffixes), block.depth), np.int64)
    for k, (i, at) in enumerate(suffixes):
        queries[k, :lengths[k]] = block.ids[i][at:]
    place = search(ids, order, queries, lengths, after=False)
    best, where = np.zeros(len(suffixes), np.int64), np.zeros(len(suffixes), np.int64)
    span = np.arange(block.depth)
    for near in (place - 1, place):
        ok = (near >= 0) & (near < len(order))
        at = order[np.clip(near, 0, len(order) - 1)]
        here = ids[np.minimum(at[:, None] + span, len(ids) - 1)]
        same = (here == queries) & (span < lengths[:, None])
        common = np.where(ok, np.where(same.all(axis=1), block.depth, same.argmin(axis=1)), 0)
        better = common > best
        best, where = np.where(better, common, best), np.where(better, at, where)
    return [(*s, int(w), int(n)) for s, w, n in zip(suffixes, where, best, strict=True)]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The benchmark's different rows, block by block, each of at most ``block_bytes`` (or one item).

    They are stored once and come to the driver as a stream, one partition at a time.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull()).distinct()
    held, size = [], 0
    for r in stored(items, "benchmark").toLocalIterator():
        text = r.text.encode()
        more = len(text) + len(r.item) + ROW_BYTES
        if held and size + more > block_bytes:
            yield held
            held, size = [], 0
        held.append((r.item, text))
        size += more
    yield held


SPANS = "array<struct<start:long,end:long>>"


def _hits_in(block: ItemBlock, texts: list[bytes]) -> tuple[np.ndarray, list[list], list[set]]:
    """Word counts, merged hit spans and hit items of each document of a shard."""
    ids, starts, counts = shard_ids(texts, block.vocab)
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    order = suffix_array(ids, block.shortest, block.depth) if block.windows else np.empty(0, np.int64)
    if len(order):
        at, which = window_hits(ids, order, block)
        if len(at):
            delta = np.zeros(len(ids) + 1, np.int64)
            np.add.at(delta, at, 1)
            np.add.at(delta, at + block.lengths[which], -1)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(delta) > 0).astype(np.int8), [0]))))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                k = int(np.searchsorted(starts, a, "right")) - 1
                spans[k].append((int(a - starts[k]), int(b - starts[k])))
            docs = np.searchsorted(starts, at, "right") - 1
            for k, w in np.unique(np.stack([docs, which], 1), axis=0):
                items[k].update(block.names[i] for i, _ in block.places[w])
    return counts, spans, items


def _merged(spans: list) -> list[dict]:
    out: list[list] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def _searched(rows: DataFrame, shared, window: int, shard_bytes: int, texts_of, hits_only: bool) -> DataFrame:
    """``rows`` with their texts searched for the block ``shared``: ``n_words``, ``spans`` and ``items`` are added.

    ``texts_of`` takes the texts from a batch; with ``hits_only`` rows without a hit are left out, and so is ``text``.
    """
    kept = rows.drop("text").columns if hits_only else rows.columns
    schema = rows.select(*kept, F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"),
                         F.array().cast("array<string>").alias("items")).schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(source):
        block = ItemBlock(shared.value, window)
        for batch in batches(source, shard_bytes):
            counts, spans, items = _hits_in(block, text_bytes(texts_of(batch)))
            out = pa.RecordBatch.from_arrays(
                [*[batch[n] for n in kept], pa.array(counts, pa.int64()), pa.array(list(map(_merged, spans)), kind),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=[*kept, "n_words", "spans", "items"])
            yield out.take(pa.array(np.flatnonzero([len(x) > 0 for x in spans]))) if hits_only else out

    return rows.mapInArrow(run, schema)


def match_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Where documents repeat benchmark windows.

    Returns one row per input row: ``doc_id``, ``row`` (the input row),
    ``n_words``, ``spans`` (merged word spans inside an occurrence of a
    window) and ``items`` (ids of items with an occurring window, sorted as
    strings). Map-only where the benchmark is one block. Else documents are
    read once per block and what is kept of a block is its hits, by id and
    digest of the text (rows equal in both have equal hits).
    """
    spark = docs.sparkSession
    rows = whole_rows(docs, id_col)
    blocks = blocks_of(benchmark, item_col, item_text, block_bytes)
    last, *others = islice(blocks, 2)
    if not others:
        return _searched(rows, spark.sparkContext.broadcast(last), window, shard_bytes, lambda b: row_texts(b, text_col), False)
    # null texts have no hits
    keyed = id_text(docs, id_col, text_col).where(F.col("text").isNotNull())
    keyed = keyed.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"), "text")
    hits = None
    for block in chain([last, *others], blocks):
        shared = spark.sparkContext.broadcast(block)
        found = _searched(keyed, shared, window, shard_bytes, lambda b: b["text"], True)
        found = stored(found.select("doc_id", "key", "spans", "items").distinct(), "decontaminate")
        shared.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    # at most one row per block and key
    hits = hits.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                             F.flatten(F.collect_list("items")).alias("items"))

    def merge(source):
        for batch in source:
            spans = [_merged([(s["start"], s["end"]) for s in x]) for x in batch["spans"].to_pylist()]
            items = [sorted(set(x)) for x in batch["items"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.array(spans, batch["spans"].type),
                                              pa.array(items, pa.list_(pa.string()))], schema=batch.schema)

    hits = hits.mapInArrow(merge, hits.schema)
    none = spark.sparkContext.broadcast([])
    counted = _searched(rows, none, window, shard_bytes, lambda b: row_texts(b, text_col), False).drop("spans", "items")
    key = F.md5(F.col("row").getField(text_col).cast("string").cast("binary"))
    joined = counted.withColumn("key", key).alias("l").join(
        hits.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.key") == F.col("r.key")), "left")
    return joined.select("l.doc_id", "l.row", "l.n_words", F.coalesce("r.spans", F.array().cast(SPANS)).alias("spans"),
                         F.coalesce("r.items", F.array().cast("array<string>")).alias("items"))


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The longest verbatim match of every test suffix over all shards, and where.

    One row per test suffix with a whole window in the documents: ``item_id``,
    ``item_start``, ``doc_id``, ``doc_start``, ``n_words`` (word offsets; ties
    go to the smallest document and offset). Each shard sends at most one row
    per suffix, so the shuffle is bounded by shards times benchmark words.
    """
    spark = docs.sparkSession
    base = id_text(docs, id_col, text_col)
    schema = "item_id string, item_start long, doc_id long, doc_start long, n_words long"
    out = None
    for rows in blocks_of(benchmark, item_col, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(rows)

        def run(source, shared=shared):
            block = ItemBlock(shared.value, window)
            for batch in batches(source, shard_bytes):
                ids, starts, _ = shard_ids(text_bytes(batch["text"]), block.vocab)
                order = suffix_array(ids, block.shortest, block.depth) if block.windows else np.empty(0, np.int64)
                if not len(order):
                    continue
                _, which = window_hits(ids, order, block)
                names = batch["doc_id"].to_pylist()
                rows = []
                for i, at, where, n in longest_in_shard(ids, order, block, which):
                    k = int(np.searchsorted(starts, where, "right")) - 1
                    rows.append((block.names[i], at, names[k], where - int(starts[k]), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], pa.string() if c == 0 else pa.int64()) for c in range(5)],
                    names=["item_id", "item_start", "doc_id", "doc_start", "n_words"])

        part = base.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    best = F.max_by(F.struct("doc_id", "doc_start", "n_words"),
                    F.struct("n_words", -F.col("doc_id"), -F.col("doc_start")))
    return out.groupBy("item_id", "item_start").agg(best.alias("best")).select("item_id", "item_start", "best.*")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **names) -> DataFrame:
    """``doc_id, row, n_words, n_hit, n_items, items, spans, contaminated`` per input row."""
    found = match_spans(docs, benchmark, window, **names)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return found.select("doc_id", "row", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        "items", "spans", (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **names) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    return contamination(docs, benchmark, window, **names).where(~F.col("contaminated")).select("row.*")
