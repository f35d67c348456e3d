"""Operator 12, document quality by random indexing and a two-layer network.

1. *Tokens* are runs of letters and digits, or of marks; white space only
   separates. A token's hash gives one of ``BUCKETS`` rows, so the table of
   vectors has a fixed size (``BUCKETS`` x ``DIM`` numbers) at any size of the
   corpus and its broadcast is bounded.
2. *Random indexing.* Each row has a sparse index vector, ``NONZERO`` entries
   of +1 or -1 at places drawn from its number. Over all documents, each token
   adds the index vectors of its neighbours (up to ``REACH`` on each side) to
   its row. Tasks add in whole numbers and send blocks of rows, which are
   summed in two steps, first by (block, salt), then by block; sums don't
   depend on the order.
3. *Pooling.* A document's features are the mean of its tokens' vectors, plain
   and weighted against frequent tokens, how alike neighbouring tokens'
   vectors are, how often a token repeats its neighbour, and its length.
4. *Network.* One hidden layer and one output, in numpy, fitted with Adam on at
   most ``MAX_TRAIN`` labelled rows (a documented bound: the rows of smallest
   hash). A fifth of these rows is kept aside to calibrate a temperature that
   the output is divided by, so that scores are probabilities.

Labels. Rows are used if ``crc32`` of the id's text modulo 5 is not 0. Nothing
but the text enters a score. Every document is scored, whole.

Edge cases: null or empty texts have no tokens and get the score of such a
document. Labels that are null, or of ids without a document, are ignored;
repeated label rows count once, as good only if all are. Rows of one id are
each scored; each is a training row. With no usable label of both kinds every
score is the share of good labels (0 without labels). An empty table gives no
rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import batches, id_text, row_texts, stored, text_bytes, whole_groups, whole_rows
from mentions.llm.words import BASE, BASE_INVERSE, _powers, mix

THRESHOLD = 0.3
MAX_TRAIN = 20_000
HELD_OUT_FOLD, FOLDS = 0, 5
BUCKETS = 1 << 16
DIM = 64
NONZERO = 4
REACH = 2
BLOCK = 1024
SALTS = 64
SLICE_BYTES = 1 << 20
POOLED_TOKENS = 1 << 15
#: A token this frequent counts half in the weighted mean.
HALF_FREQUENCY = 1e-3
HIDDEN = 32
EPOCHS = 40
RATE = 3e-3
DECAY = 1e-4
MINI = 256
VALIDATION = 5  # one row in so many

#: Classes of bytes: 0 separates, 1 letters and digits (all bytes beyond ASCII too), 2 marks.
CLASSES = np.array([0 if b <= 32 or b == 127 else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], np.int8)
FEATURES = 2 * DIM + REACH + 4


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, document)`` of every token of the texts in turn."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    kind = CLASSES[raw]
    change = np.flatnonzero(np.diff(np.concatenate(([0], kind))) != 0)
    starts = change[kind[change] > 0]
    # a run ends where the next one, of whatever class, begins; the last byte is a blank
    ends = change[np.searchsorted(change, starts, "right")]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(raw)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(BASE_INVERSE, len(raw) + 1)[starts])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(begins, starts, "right") - 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """``(places, signs)`` of the entries of each row's index vector."""
    drawn = mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, NONZERO)
    return (drawn % np.uint64(DIM)).astype(np.int64), np.where(drawn >> np.uint64(63) > 0, 1, -1).astype(np.int32)


def add_contexts(sums: np.ndarray, bucket: np.ndarray, doc: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add each token's context to ``sums`` (BUCKETS x (DIM + 1), int32; the last column counts tokens)."""
    flat, width = sums.reshape(-1), DIM + 1
    np.add.at(flat, bucket * width + DIM, np.int32(1))
    for step in range(1, REACH + 1):
        near = np.flatnonzero(doc[step:] == doc[:-step])
        left, right = bucket[near], bucket[near + step]
        for own, other in ((left, right), (right, left)):
            base = own * width
            for k in range(NONZERO):
                np.add.at(flat, base + places[other, k], signs[other, k])


def context_sums(docs: DataFrame) -> np.ndarray:
    """The summed contexts and counts of all rows (BUCKETS x (DIM + 1)), of all documents."""
    width = DIM + 1

    def run(source):
        import zstandard

        places, signs = index_vectors()
        sums = np.zeros((BUCKETS, width), np.int32)
        for batch in batches(source, SLICE_BYTES):
            add_contexts(sums, *tokens(text_bytes(batch["text"])), places, signs)
        press = zstandard.ZstdCompressor(level=1)
        blocks = [b for b in range(BUCKETS // BLOCK) if sums[b * BLOCK:(b + 1) * BLOCK].any()]
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([salt] * len(blocks), pa.int32()),
             pa.array([press.compress(sums[b * BLOCK:(b + 1) * BLOCK].astype("<i8").tobytes()) for b in blocks], pa.binary())],
            names=["block", "salt", "packed"])

    def add(source):
        import zstandard

        press, unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        held: dict[tuple[int, int], np.ndarray] = {}

        def rows():
            keys = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([press.compress(held[k].tobytes()) for k in keys], pa.binary())], names=["block", "salt", "packed"])
            held.clear()
            return out

        # sorted by block and salt, so a task holds one sum at a time
        for batch in source:
            for block, salt, packed in zip(*[batch[c].to_pylist() for c in ("block", "salt", "packed")], strict=True):
                if held and (block, salt) not in held:
                    yield rows()
                part = np.frombuffer(unpress.decompress(packed), "<i8")
                held[block, salt] = held[block, salt] + part if (block, salt) in held else part
        if held:
            yield rows()

    schema = "block int, salt int, packed binary"
    parts = docs.select("text").mapInArrow(run, schema)
    some = parts.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(add, schema).withColumn("salt", F.lit(0))
    whole = stored(some.repartition("block").sortWithinPartitions("block", "salt").mapInArrow(add, schema), "contexts")
    import zstandard

    sums = np.zeros((BUCKETS, width), np.int64)
    for row in whole.collect():  # BUCKETS x (DIM + 1) numbers, whatever the corpus
        sums[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.packed), "<i8").reshape(BLOCK, width)
    return sums


def word_vectors(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(vectors, weights)``: unit vectors of the rows (zero where nothing was met), and weights against frequency."""
    norm = np.linalg.norm(sums[:, :DIM].astype(np.float64), axis=1, keepdims=True)
    vectors = sums[:, :DIM] / np.where(norm > 0, norm, 1)
    share = sums[:, DIM] / max(1, int(sums[:, DIM].sum()))
    return vectors.astype(np.float32), (HALF_FREQUENCY / (HALF_FREQUENCY + share)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The features of each text (len(texts) x FEATURES)."""
    rows = len(texts)
    bucket, doc = tokens(texts)
    n = np.bincount(doc, minlength=rows).astype(np.float64)
    plain, weighted, like = np.zeros((rows, DIM)), np.zeros((rows, DIM)), np.zeros((rows, REACH))
    heavy = np.bincount(doc, weights[bucket], rows)
    for start in range(0, len(bucket), POOLED_TOKENS):
        at = slice(start, start + POOLED_TOKENS + REACH)  # and the neighbours of the last ones
        v, d = vectors[bucket[at]], doc[at]
        own = min(POOLED_TOKENS, len(d))
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(d[:own])) + 1))
        plain[d[cuts]] += np.add.reduceat(v[:own], cuts, axis=0, dtype=np.float64)
        weighted[d[cuts]] += np.add.reduceat(v[:own] * weights[bucket[at][:own], None], cuts, axis=0, dtype=np.float64)
        for step in range(1, REACH + 1):
            left = np.arange(max(0, min(own, len(d) - step)))
            left = left[d[left] == d[left + step]]
            like[:, step - 1] += np.bincount(d[left], (v[left] * v[left + step]).sum(axis=1, dtype=np.float64), rows)
    same = np.bincount(doc[:-1][(doc[1:] == doc[:-1]) & (bucket[1:] == bucket[:-1])], minlength=rows) if len(doc) else np.zeros(rows)
    many = np.maximum(n, 1)[:, None]
    plain, weighted = plain / many, weighted / np.maximum(heavy, 1e-9)[:, None]
    return np.hstack([plain, weighted, like / many, (same / many[:, 0])[:, None], np.log1p(n)[:, None] / 10,
                      np.linalg.norm(plain, axis=1)[:, None], np.linalg.norm(weighted, axis=1)[:, None]])


class Network:
    """Two layers, a temperature, and the scaling of the features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        self.low, self.high = x.min(axis=0), x.max(axis=0)  # features beyond the training rows' count as the nearest of them
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1
        self.temperature = 1.0
        z, aside = self.scaled(x), np.arange(len(x)) % VALIDATION == VALIDATION - 1
        if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
            aside[:] = False
        self.fit(z[~aside], y[~aside], np.random.default_rng(seed))
        if aside.any():
            self.calibrate(z[aside], y[aside])

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((np.clip(x, self.low, self.high) - self.mean) / self.scale, -8, 8)

    def fit(self, z: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        sizes = [(z.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
        self.layers = [rng.normal(size=sizes[0]) / math.sqrt(sizes[0][0]), np.zeros(HIDDEN), rng.normal(size=HIDDEN) / math.sqrt(HIDDEN),
                       np.array(math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))]
        first, second, step = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes], 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(z))
            for begin in range(0, len(z), MINI):
                at, step = order[begin:begin + MINI], step + 1
                w, b, v, _ = self.layers
                hidden, out = self.forward(z[at])
                error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[at]) / len(at)
                back = error[:, None] * v * (1 - hidden * hidden)
                slopes = [z[at].T @ back + DECAY * w, back.sum(axis=0), hidden.T @ error + DECAY * v, error.sum()]
                for k, slope in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope * slope
                    self.layers[k] = self.layers[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def forward(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b, v, c = self.layers
        hidden = np.tanh(z @ w + b)
        return hidden, hidden @ v + c

    def calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """The temperature of least loss on rows that the layers weren't fitted on."""
        out = self.forward(z)[1]
        tried = np.geomspace(0.25, 8, 141)
        self.temperature = float(tried[np.argmin([(np.logaddexp(0, out / t) - y * out / t).sum() for t in tried])])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(self.scaled(x))[1] / self.temperature, -30, 30)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def training_features(docs: DataFrame, labels: DataFrame, table, max_train: int) -> DataFrame:
    """``x, good`` of at most ``max_train`` labelled rows outside the held-out fold."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # max_train short rows

    def run(source):
        for batch in batches(source, SLICE_BYTES):
            x = pooled(text_bytes(batch["text"]), *table.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(list(x), pa.list_(pa.float64())), batch["quality"]],
                                             names=["doc_id", "x", "quality"])

    made = rows.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, x array<double>, quality int")
    # an id may have many rows, so the bound is taken once more on rows
    return made.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("x")).limit(max_train)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN):
    """``(broadcast word vectors, network or share of good labels)``. ``docs`` has ``doc_id`` and ``text``."""
    table = docs.sparkSession.sparkContext.broadcast(word_vectors(context_sums(docs)))  # BUCKETS x (DIM + 1) floats
    rows = training_features(docs, labels, table, max_train).collect()
    x, y = np.array([r.x for r in rows]).reshape(-1, FEATURES), np.array([float(r.quality > 0) for r in rows])
    order = np.lexsort(np.column_stack([x, y]).T)  # the same sums each time
    x, y = x[order], y[order]
    mixed = np.random.default_rng(1).permutation(len(y))
    return table, Network(x[mixed], y[mixed]) if len(set(y)) == 2 else float(y.mean()) if len(y) else 0.0


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Fit on the corpus and the labels and score every row: ``doc_id, row, held_out, score, predicted``."""
    table, model = fit(id_text(docs, id_col, text_col), labels, max_train)
    base = whole_rows(docs, id_col)

    def run(source):
        for batch in batches(source, SLICE_BYTES):
            if isinstance(model, float):
                scores = np.full(batch.num_rows, model)
            else:
                scores = model.scores(pooled(text_bytes(row_texts(batch, text_col)), *table.value))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(scores, pa.float64())], names=["doc_id", "row", "score"])

    found = base.mapInArrow(run, base.select("doc_id", "row", F.lit(0.0).alias("score")).schema)
    return found.select("doc_id", "row", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
