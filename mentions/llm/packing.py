"""Operator 9, packing with optimal length buckets.

1. Token lengths of all documents give a global histogram. Lengths that share
   their leading ``BITS`` bits share a cell (lengths below ``2**BITS`` are
   exact), so the histogram has at most ``2**BITS * 64`` cells at any corpus
   size; a cell's boundary is its longest real length.
2. Dynamic programming over the cells picks at most ``N_BUCKETS`` boundaries
   with the least padding. With boundaries ascending, the cost of one more
   bucket is a minimum over lines, so a layer takes linear time.
3. Inside a bucket every batch holds ``budget // boundary`` documents (one at
   least). Batches form inside (bucket, part); a bucket is cut into enough
   parts by a hash of the document that a part holds about ``PART_ROWS`` rows
   or ``PART_BATCHES`` batches, however large the bucket. At most one batch of
   a part is not full.

A document longer than the token budget is a batch of its own, whole. Null and
empty texts have the end token alone. Repeated rows are packed each (rows equal
in id and text share a part). An empty table gives no batches. Ties in length share a bucket; order inside a part is
by (length, doc_id, hash of the text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentions.llm.common import batches, id_text, stored
from mentions.llm.tokens import token_bytes

BITS = 10
N_BUCKETS = 16
TOKEN_BUDGET = 1 << 16
PART_ROWS = 4096
PART_BATCHES = 32
BATCH_BYTES = 4 << 20


def token_lengths(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, tie``: tokens with the end token, and a hash that orders repeated ids."""
    def run(source):
        for batch in batches(source, BATCH_BYTES):
            counts = [len(ids) // 4 + 1 for ids in token_bytes(batch["text"].to_pylist(), tokenizer_path)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), batch["tie"]],
                                             names=["doc_id", "n_tokens", "tie"])

    return id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("doc_id", "text")).mapInArrow(
        run, "doc_id long, n_tokens long, tie long")


def cell(length: F.Column) -> F.Column:
    """The first length of the histogram cell that ``length`` is in."""
    bits_below = F.greatest(F.lit(0), F.length(F.bin(length)) - BITS)
    return length - F.pmod(length, F.pow(F.lit(2.0), bits_below).cast("long"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``cell, top, n, tokens``: of each cell the longest length, the documents and their tokens."""
    return lengths.groupBy(cell(F.col("n_tokens")).alias("cell")).agg(
        F.max("n_tokens").alias("top"), F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))


def optimal_boundaries(tops: list[int], counts: list[int], n_buckets: int = N_BUCKETS) -> list[int]:
    """Boundaries (a subset of ``tops``, ascending, the last included) that
    minimise the padded size, the sum over documents of their boundary."""
    n = len(tops)
    if not n:
        return []
    total = [0]
    for c in counts:
        total.append(total[-1] + c)
    cost = [tops[j] * total[j + 1] for j in range(n)]  # one bucket
    back: list[list[int]] = []
    for _ in range(min(n_buckets, n) - 1):
        # best[j] = min over i < j of cost[i] + tops[j] * (total[j+1] - total[i+1]): lines in tops[j],
        # with slopes -total[i+1] that fall as i grows, asked for ascending tops
        hull: list[int] = []
        head, best, choice = 0, list(cost), [-1] * n
        for j in range(n):
            if j:
                i = j - 1
                while len(hull) - head >= 2 and _useless(hull[-2], hull[-1], i, cost, total):
                    hull.pop()
                hull.append(i)
                value = lambda i: cost[i] - tops[j] * total[i + 1]  # noqa: B023,E731
                while len(hull) - head >= 2 and value(hull[head + 1]) <= value(hull[head]):
                    head += 1
                now = value(hull[head]) + tops[j] * total[j + 1]
                if now < best[j]:
                    best[j], choice[j] = now, hull[head]
        back.append(choice)
        cost = best
    out, j = [], n - 1
    for choice in reversed(back):
        out.append(tops[j])
        if choice[j] < 0:
            # one bucket fewer is as good: the layers below hold the same cost
            out.pop()
            continue
        j = choice[j]
    out.append(tops[j])
    return sorted(set(out))


def _useless(a: int, b: int, c: int, cost: list[int], total: list[int]) -> bool:
    """Line b is never the least once a and c are there."""
    return (cost[c] - cost[a]) * (total[b + 1] - total[a + 1]) <= (cost[b] - cost[a]) * (total[c + 1] - total[a + 1])


def pack(docs: DataFrame, tokenizer_path: str | None = None, n_buckets: int = N_BUCKETS, budget: int = TOKEN_BUDGET,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token-budget batches inside optimal length buckets.

    Returns one row per input row: ``doc_id, n_tokens, bucket, boundary,
    batch_id`` (``bucket-part-number``) and ``slot`` in the batch.
    """
    spark = docs.sparkSession
    lengths = stored(token_lengths(docs, tokenizer_path, id_col, text_col), "lengths")
    cells = sorted((r.top, r.n) for r in length_histogram(lengths).collect())  # bounded by the cells
    tops = optimal_boundaries([t for t, _ in cells], [n for _, n in cells], n_buckets)
    plan, low, at = [], 0, 0
    for k, top in enumerate(tops):
        rows = 0
        while at < len(cells) and cells[at][0] <= top:
            rows += cells[at][1]
            at += 1
        size = max(1, budget // top)
        plan.append((k, low, top, size, max(1, rows // max(PART_ROWS, PART_BATCHES * size))))
        low = top
    lengths = lengths.withColumn("bucket", sum((F.col("n_tokens") > top).cast("int") for _, _, top, _, _ in plan[:-1])
                                 if len(plan) > 1 else F.lit(0))
    table = spark.createDataFrame([(k, top, size, parts) for k, _, top, size, parts in plan],
                                  "bucket int, boundary long, size long, parts long")
    part = F.pmod("tie", F.col("parts"))
    place = W.partitionBy("bucket", "part").orderBy("n_tokens", F.col("doc_id").asc_nulls_last(), "tie")
    return (lengths.join(F.broadcast(table), "bucket")  # n_buckets rows
            .withColumn("part", part).withColumn("at", F.row_number().over(place) - 1)
            .select("doc_id", "n_tokens", "bucket", "boundary",
                    F.concat_ws("-", "bucket", "part", F.floor(F.col("at") / F.col("size"))).alias("batch_id"),
                    F.pmod("at", F.col("size")).cast("long").alias("slot")))


def packed_batches(docs: DataFrame, tokenizer_path: str | None = None, n_buckets: int = N_BUCKETS,
                   budget: int = TOKEN_BUDGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per batch: ``batch_id, bucket, boundary, n_docs, n_tokens, padded, doc_ids`` (in slot order).

    A batch's list is bounded by the budget, as each document has a token at least.
    """
    rows = pack(docs, tokenizer_path, n_buckets, budget, id_col, text_col)
    return rows.groupBy("batch_id", "bucket", "boundary").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("slot", "doc_id"))).alias("own")).select(
        "batch_id", "bucket", "boundary", "n_docs", "n_tokens",
        (F.col("boundary") * F.col("n_docs") - F.col("n_tokens")).alias("padded"), F.col("own.doc_id").alias("doc_ids"))


def padding(lengths: np.ndarray, boundaries: list[int]) -> int:
    """Padding tokens of lengths under boundaries."""
    edges = np.array(boundaries)
    return int((edges[np.searchsorted(edges, lengths)] - lengths).sum())
