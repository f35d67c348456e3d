"""Operator 8, line dedup with levelled sorted runs of line hashes.

Documents come in batches of ascending ids. The keys that a batch holds are
merge-anti-joined with the runs of earlier batches; keys not met before form a
new run at level 0, sorted by key, with the smallest document that holds each
key (its owner). When a level has ``FANOUT`` runs they are merged into one run
of the next level. As batches ascend, a key's owner is final when it is first
written.

A key is the 128-bit hash of a line with ASCII white space stripped at both
ends and A-Z lower-cased; keys of fewer than ``MIN_CHARS`` code points are
never dropped. A document holds a key once, so a line that fills a third of
the corpus is counted map-side first; what is joined on keys is (key, id)
pairs, never texts. Only documents that lose lines meet their dropped keys.

Edge cases: a null or empty text is one empty line. A null id counts as the
largest. Rows with the same id are one document: none of them loses a line to
another of them. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentions.llm.common import NO_ID, batches, id_text, row_texts, stored, text_bytes, whole_rows

MIN_CHARS = 10
BATCHES = 4
FANOUT = 3
BATCH_BYTES = 4 << 20

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANKS = b" \t\n\x0b\x0c\r"
RUN = "key binary, owner long"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of each line; None for lines too short to be dropped."""
    import xxhash

    out = []
    for line in text.translate(LOWER).split(b"\n"):
        line = line.strip(BLANKS)
        n = len(line)
        if n < min_chars or n < 4 * min_chars and len(line.decode()) < min_chars:
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(line))
    return out


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``key, doc_id``: each key once for each row that holds it."""
    def run(source):
        for batch in batches(source, BATCH_BYTES):
            keys, ids = [], []
            for name, text in zip(batch["doc_id"].to_pylist(), text_bytes(batch["text"]), strict=True):
                own = {k for k in line_keys(text, min_chars) if k}
                keys.extend(own)
                ids.extend([name] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    return docs.mapInArrow(run, "key binary, doc_id long")


class SortedRuns:
    """The levelled runs: each a stored table ``key, owner`` sorted by key within hash partitions of the key."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, first: DataFrame) -> DataFrame:
        """Rows of ``first`` (key, owner) whose key is in no run."""
        for run in self.runs():
            first = first.join(run, "key", "left_anti")
        return first

    def add(self, fresh: DataFrame, level: int = 0) -> None:
        """Write ``fresh`` as a run of ``level`` and compact a full level into the next."""
        while len(self.levels) <= level:
            self.levels.append([])
        # a rebalance cuts the run into files of even size whatever the keys are
        self.levels[level].append(stored(fresh.repartition("key").sortWithinPartitions("key"), "line-runs"))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            total = merged[0]
            for run in merged[1:]:
                total = total.unionByName(run)
            self.add(total, level + 1)

    def owners(self) -> DataFrame:
        runs = self.runs()
        total = runs[0]
        for run in runs[1:]:
            total = total.unionByName(run)
        return total


def add_batch(runs: SortedRuns, keys: DataFrame) -> None:
    """Merge one batch of (key, doc_id) into the runs; batches come in ascending document order."""
    first = keys.groupBy("key").agg(F.min("doc_id").alias("owner"))
    runs.add(runs.unseen(first))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, n_batches: int = BATCHES, fanout: int = FANOUT,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep each line key's lines only in the smallest document that holds it.

    Returns one row per input row: ``doc_id``, ``row`` (the input row),
    ``n_lines`` (before), ``n_dropped`` and ``kept`` (the text that stays).
    """
    number = F.coalesce("doc_id", F.lit(NO_ID))
    base = whole_rows(docs, id_col).withColumn("doc_id", number)
    keys = stored(document_keys(id_text(docs, id_col, text_col).withColumn("doc_id", number), min_chars), "line-keys")
    cuts = keys.agg(F.percentile_approx("doc_id", [k / n_batches for k in range(1, n_batches)], 10_000).alias("c")).first().c
    edges = [None, *sorted(set(cuts or [])), None]
    runs = SortedRuns(docs.sparkSession, fanout)
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        batch = keys
        if low is not None:
            batch = batch.where(F.col("doc_id") > low)
        if high is not None:
            batch = batch.where(F.col("doc_id") <= high)
        add_batch(runs, batch)
    dropped = stored(keys.join(runs.owners(), "key").where(F.col("doc_id") > F.col("owner")).select("doc_id", "key"), "line-drops")
    # one row per document, no more keys than it has lines
    lost = dropped.groupBy("doc_id").agg(F.collect_set("key").alias("lost"))
    schema = base.select("doc_id", "row", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"),
                         F.lit("").alias("kept")).schema

    def run(source):
        for batch in batches(source, BATCH_BYTES):
            n_lines, n_dropped, kept = [], [], []
            for text, gone in zip(text_bytes(row_texts(batch, text_col)), batch["lost"].to_pylist(), strict=True):
                if gone:
                    gone = set(gone)
                    lines = text.split(b"\n")
                    stay = [x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k not in gone]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay).decode())
                else:
                    n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(0)
                    kept.append(text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row"], pa.array(np.array(n_lines, np.int64)), pa.array(np.array(n_dropped, np.int64)),
                 pa.array(kept, pa.string())], names=["doc_id", "row", "n_lines", "n_dropped", "kept"])

    out = base.join(lost, "doc_id", "left").mapInArrow(run, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, without their repeated lines.

    ``n_chars`` (when it is a column) follows the new text. A document that
    loses all its lines stays with an empty text.
    """
    found = drop_repeated_lines(docs, id_col=id_col, text_col=text_col, **options)
    columns = []
    for c, kind in docs.dtypes:
        old = F.col("row").getField(c)
        if c == text_col:
            # a null text has one empty line and stays null
            columns.append(F.when(old.isNotNull(), F.col("kept")).cast(kind).alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(old).cast(kind).alias(c))
        else:
            columns.append(old.alias(c))
    return found.select(*columns)
