"""Operator 10, sharding by extendible hashing (DataFrame functions only).

A document's hash is the first ``HASH_BITS`` bits of the MD5 of its id and
text, so rows of one hot id or source spread evenly. A bucket is a hash
prefix; only buckets over the byte limit split on one more bit, until every
bucket fits.

Splits of one bucket depend on its bytes alone, so they need no row-by-row
inserts. A round sums bytes by cell (the prefix at a depth a little below the
expected leaves), sums the cells' own prefixes, and gives each cell the
shallowest prefix that fits. Rows of cells that are still too large go to the
next, deeper round; those are few, or none.

Edge cases: null and empty texts have no bytes. A shard whose rows all have
one hash (a document over the limit, or rows equal in id and text) can't be
split by bits and is marked ``oversized``; no row is dropped. An empty table
gives no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import stored, whole_rows

LIMIT_BYTES = 32 << 20
HASH_BITS = 60
#: Bits of a round below the depth at which equal buckets would fit.
SLACK = 3


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, bytes, hash``."""
    text = F.col("row").getField(text_col).cast("string")
    digest = F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), text).cast("binary"))
    bits = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")
    return whole_rows(docs, id_col).select(
        "doc_id", "row", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), bits.alias("hash"))


def prefix(depth) -> F.Column:
    return F.expr(f"shiftright(hash, {HASH_BITS} - {depth})")


def cell_leaves(cells: DataFrame, low: int, high: int, limit_bytes: int) -> DataFrame:
    """For cells ``cell, bytes, n, first, last`` at depth ``high``: the leaf of each.

    Adds ``depth`` and ``prefix`` of the shallowest prefix of at least ``low``
    bits whose bytes fit (null while none does), the ``shard_bytes`` and
    ``shard_docs`` in it, and ``oversized``.
    """
    levels = cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_docs"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    fits = sums.where((F.col("shard_bytes") <= limit_bytes) | (F.col("first") == F.col("last")))
    fits = fits.select("depth", "prefix", "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit_bytes).alias("oversized"))
    leaf = F.struct("depth", "prefix", "shard_bytes", "shard_docs", "oversized")
    found = levels.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"]).groupBy("cell").agg(
        F.min(leaf).alias("leaf"))
    return cells.select("cell").join(found, "cell", "left").select("cell", "leaf.*")


def shard_rows(docs: DataFrame, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's shard.

    Returns one row per input row: ``doc_id``, ``bytes``, ``hash``, ``shard``
    (the prefix's bits, ``*`` for the whole), ``depth``, ``shard_bytes``,
    ``shard_docs`` and ``oversized``.
    """
    rows = stored(hashed(docs, id_col, text_col).drop("row"), "shard-hashes")
    total = rows.agg(F.sum("bytes").alias("b")).first().b or 0
    low, high = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + SLACK)
    done = []
    while True:
        at = rows.withColumn("cell", prefix(high))
        cells = at.groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("hash").alias("first"),
                                       F.max("hash").alias("last"))
        leaves = stored(cell_leaves(cells, low, high, limit_bytes), "shard-leaves")
        done.append(at.join(leaves.where(F.col("depth").isNotNull()), "cell"))
        open_cells = leaves.where(F.col("depth").isNull()).select("cell")
        if high == HASH_BITS or open_cells.isEmpty():
            break
        rows = stored(at.join(open_cells, "cell", "left_semi").drop("cell"), "shard-open")
        low, high = high + 1, min(HASH_BITS, high + 2 * SLACK)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    bits = F.when(F.col("depth") == 0, "*").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    return out.select("doc_id", "bytes", "hash", bits.alias("shard"), "depth", "shard_bytes", "shard_docs", "oversized")


def directory(shards: DataFrame) -> DataFrame:
    """The directory of :func:`shard_rows`: one row per shard, and its slots in
    a directory of the global depth (``first_slot``, ``last_slot``)."""
    leaves = shards.select("shard", "depth", "shard_bytes", "shard_docs", "oversized", prefix("depth").alias("prefix")).distinct()
    deepest = leaves.agg(F.max("depth")).scalar()
    free = deepest - F.col("depth")
    return leaves.select("shard", "depth", "shard_bytes", "shard_docs", "oversized", deepest.alias("global_depth"),
                         (F.col("prefix") * F.pow(F.lit(2.0), free)).cast("long").alias("first_slot"),
                         ((F.col("prefix") + 1) * F.pow(F.lit(2.0), free) - 1).cast("long").alias("last_slot"))


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the rows, with all their columns, one folder per shard."""
    shards = shard_rows(docs, limit_bytes, id_col, text_col).select("doc_id", "hash", "shard").distinct()
    rows = hashed(docs, id_col, text_col)
    found = rows.join(shards, rows["doc_id"].eqNullSafe(shards["doc_id"]) & (rows["hash"] == shards["hash"]))
    found.select("row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)
