"""Operator 3, token-id output in patched frame-of-reference blocks.

The corpus is written in ascending document order as Parquet *segments*
(Spark's committer makes the files safe against lost executors and works on
any store). A segment holds whole documents, about ``SEGMENT_TOKENS`` ids:

* ``payload``: blocks of ``BLOCK`` ids (the last may be shorter). A block is
  ``minimum u32, width u8, exceptions u8``, then the ids less the minimum
  packed at ``width`` bits each, then the exceptions' positions (u8 each) and
  their high bits (u32 each).
* ``block_starts``: byte offset of each block (u32), so a token's block is
  found without decoding those before it.
* ``doc_ids`` and ``doc_tokens``: the documents and their token counts.

``width`` is what the block's ``PERCENTILE``-smallest id needs; larger ids
are exceptions.

Documents are ordered by (doc_id, hash of the text); null ids come last. Each
row is encoded as a document of its own. A null or empty text has the end id
alone. An empty table gives an empty file. Each range partition streams its
rows; nothing larger than a segment is held.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentions.llm.common import NO_ID, batches, id_text
from mentions.llm.tokens import token_bytes

BLOCK = 128
PERCENTILE = 0.9
SEGMENT_TOKENS = 1 << 18
BATCH_BYTES = 4 << 20
HEADER = 6

SEGMENT = ("shard int, segment int, first_token long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
           "block_starts binary, payload binary")


def _widths(top: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(top.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, bytes]:
    """``(payload, block_starts)`` of an array of unsigned 32-bit ids."""
    n = len(ids)
    if not n:
        return b"", b""
    count = -(-n // BLOCK)
    grid = np.empty(count * BLOCK, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1]
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _widths(np.partition(rest, at, axis=1)[:, at])
    high = np.where(width[:, None] < 32, rest >> np.minimum(width, 31).astype(np.uint32)[:, None], 0).astype(np.uint32)
    outliers = high > 0
    n_out = outliers.sum(axis=1)
    sizes = HEADER + BLOCK // 8 * width + 5 * n_out
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(int(starts[-1]), np.uint8)
    head = np.empty((count, HEADER), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    head[:, 4], head[:, 5] = width, n_out
    out[starts[:-1, None] + np.arange(HEADER)] = head
    for w in np.unique(width):
        if not w:
            continue
        mine = np.flatnonzero(width == w)
        bits = (rest[mine][:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
        packed = np.packbits(bits.reshape(len(mine), BLOCK * int(w)), axis=1, bitorder="little")
        out[starts[mine][:, None] + HEADER + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(outliers)
    order = np.arange(len(block)) - np.repeat(np.cumsum(n_out) - n_out, n_out)
    lists = starts[block] + HEADER + BLOCK // 8 * width[block]
    out[lists + order] = place
    values = high[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(lists + n_out[block] + 4 * order)[:, None] + np.arange(4)] = values
    return out.tobytes(), starts[:-1].astype("<u4").tobytes()


def decode_blocks(payload: bytes, block_starts: bytes, n: int) -> np.ndarray:
    """The ids that :func:`encode_blocks` was given."""
    if not n:
        return np.empty(0, np.uint32)
    raw = np.frombuffer(payload, np.uint8)
    starts = np.frombuffer(block_starts, "<u4").astype(np.int64)
    head = raw[starts[:, None] + np.arange(HEADER)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").reshape(-1)
    width, n_out = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    grid = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        mine = np.flatnonzero(width == w)
        packed = raw[starts[mine][:, None] + HEADER + np.arange(BLOCK // 8 * w)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(mine), BLOCK, int(w))
        values = np.zeros((len(mine), BLOCK), np.uint32)
        for b in range(int(w)):
            values |= bits[:, :, b].astype(np.uint32) << np.uint32(b)
        grid[mine] = values
    block = np.repeat(np.arange(len(starts)), n_out)
    order = np.arange(len(block)) - np.repeat(np.cumsum(n_out) - n_out, n_out)
    lists = starts[block] + HEADER + BLOCK // 8 * width[block]
    place = raw[lists + order]
    high = np.ascontiguousarray(raw[(lists + n_out[block] + 4 * order)[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    grid[block, place] |= high << np.minimum(width[block], 31).astype(np.uint32)
    return (grid + low[:, None]).reshape(-1)[:n]


def _segments(source: Iterator[pa.RecordBatch], tokenizer_path: str | None, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard, segment, first = TaskContext.get().partitionId(), 0, 0
    names: list = []
    parts: list[bytes] = []
    held = 0
    end = np.array([end_id], "<u4").tobytes()

    def closed() -> pa.RecordBatch:
        payload, starts = encode_blocks(np.frombuffer(b"".join(parts), "<u4"))
        counts = [len(p) // 4 for p in parts]
        values = [shard, segment, first, held, names, counts, starts, payload]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                 pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)],
                                          names=[f.split()[0] for f in SEGMENT.split(", ")])

    for batch in batches(source, BATCH_BYTES):
        for name, ids in zip(batch["doc_id"].to_pylist(), token_bytes(batch["text"].to_pylist(), tokenizer_path),
                             strict=True):
            names.append(name)
            parts.append(ids + end)
            held += len(ids) // 4 + 1
            if held >= SEGMENT_TOKENS:
                yield closed()
                segment, first = segment + 1, first + held
                names, parts, held = [], [], 0
    if names:
        yield closed()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` in ascending document order into segments below ``path``."""
    order = [F.coalesce("doc_id", F.lit(NO_ID)), F.xxhash64("text")]
    ranges = id_text(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.mapInArrow(lambda source: _segments(source, tokenizer_path, end_id), SEGMENT).write.parquet(path)


def shard_starts(segments: DataFrame) -> DataFrame:
    """``shard, base``: tokens before each shard. One row per shard passes the window."""
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` and, on request, ``ids``."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(source):
        for batch in source:
            for row in batch.to_pylist():
                ids = decode_blocks(row["payload"], row["block_starts"], row["n_tokens"]).astype("<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                own = [ids[e - c:e] for c, e in zip(counts, ends, strict=True)]
                arrays = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + row["first_token"] + ends - counts),
                          pa.array(counts), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                if with_ids:
                    arrays.append(pa.array(own, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    # one row per range partition of the writer, so small beside any segment
    return segments.join(F.broadcast(shard_starts(segments)), "shard").mapInArrow(run, schema)
