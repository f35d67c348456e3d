"""Helpers shared by the operators of this subpackage.

Conventions that hold for every operator here:

* A document table has an integer id column and a text column; other columns
  are ignored, or carried through untouched inside a struct where the
  operator returns whole rows, so their names cannot clash.
* A null text has no words, no lines' content and no tokens. A null id counts
  as one document whose id is larger than every other.
* Rows with the same id are rows of one document; each row keeps its own
  result row.
* Intermediate results that cut lineage are Parquet tables below
  ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentions.session import scratch_dir

#: Stands for a null id inside the operators.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` (long) and ``text``."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def whole_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and the whole input row in the struct ``row`` (its text is read from there, and sent once)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def row_texts(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of the rows in the struct ``row`` of a batch."""
    row = batch["row"]
    return row.field(row.type.get_field_index(text_col)).cast(pa.string())


def packed_texts(df: DataFrame, columns: list[str], slice_bytes: int = 4 << 20) -> DataFrame:
    """``columns`` of ``df``, and its ``text`` compressed as ``packed`` (null stays null): for shuffles of whole texts."""
    from pyspark.sql import types as T

    kept = df.select(*columns, "text")
    schema = T.StructType([*kept.drop("text").schema.fields, T.StructField("packed", T.BinaryType())])

    def run(source):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches(source, slice_bytes):
            packed = [None if x is None else press.compress(x) for x in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())],
                                             names=[*batch.schema.names[:-1], "packed"])

    return kept.mapInArrow(run, schema)


def unpacked_texts(source: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of batches with a column ``packed``, and their texts; a slice has about ``slice_bytes`` of text."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    for batch in source:
        start, size, texts = 0, 0, []
        for i, x in enumerate(batch["packed"].to_pylist()):
            texts.append(None if x is None else press.decompress(x))
            size += len(texts[-1] or b"")
            if size >= slice_bytes:
                yield batch.slice(start, i + 1 - start), texts
                start, size, texts = i + 1, 0, []
        if texts:
            yield batch.slice(start), texts


def worker_cache(name: str, make: Callable):
    """An object that lives in the Python worker process until another one is asked for.

    Functions are shipped by value, so a module global would be made anew in
    each task; the interpreter's own module dictionary is not. One object at
    a time, so that what operators hold doesn't add up.
    """
    held = sys.__dict__.setdefault("_mentions_worker_cache", {})
    if name not in held:
        held.clear()
        held[name] = make()
    return held[name]


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batches(source: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``max_bytes`` (one row at least)."""
    for batch in source:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, rows, step):
            yield batch.slice(start, min(step, rows - start))


def group_cuts(table: pa.Table, keys: list[str]) -> list[int]:
    """Where each group of a table sorted by integer ``keys`` begins, and the table's end."""
    ids = np.stack([table[c].to_numpy() for c in keys], axis=1)
    return [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]


def whole_groups(source: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by integer ``keys``; the last group of a batch may go on in the next."""
    held: list[pa.RecordBatch] = []
    for batch in source:
        if not batch.num_rows:
            continue
        names = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in keys], axis=1)
        last = names[-1]
        cut = int((names == last).all(axis=1).argmax())
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            if held and any(held[0][c][0].as_py() != v for c, v in zip(keys, last.tolist(), strict=True)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
