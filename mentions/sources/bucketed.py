"""A bucketed layout of the tables that queries join (J-01, J-02, J-03, J-05, J-06).

Relations, evaluations and their entities are joined on the same three keys by
every rating query; concepts, entities and texts by text. Written with the same
number of buckets on those keys, and sorted by them, the join needs neither a
shuffle nor a sort. A bucket is one task, so a text that alone holds a large
share of a table calls for the plain layout, whose joins are split. The tables are
external tables of the session's catalog, with their files under a folder that
the caller names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentions.operators.common import RELATION_KEY, TEXT_KEY
from mentions.schemas import TABLES
from mentions.sources.tables import TableSet

EVALUATION_KEY = ["doc_id", "text_order", "evaluation_id"]
BUCKET_KEYS = {
    "concepts": TEXT_KEY,
    "absa_entities": TEXT_KEY,
    "absa_normalized_texts": TEXT_KEY,
    "absa_relations": RELATION_KEY,
    "absa_relations_entities": RELATION_KEY,
    "absa_evaluations": EVALUATION_KEY,
    "absa_evaluations_entities": EVALUATION_KEY,
}


#: Rows that one bucket, which one task sorts and reads, should hold.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for a table of so many rows."""
    return max(least, -(-rows // BUCKET_ROWS))


class BucketedSink:
    """Catalog tables ``<prefix><table>``; those of :data:`BUCKET_KEYS` are bucketed and sorted."""

    def __init__(self, spark: SparkSession, path: str, prefix: str, buckets: int):
        """``buckets`` should make a bucket about as large as a task should read (e.g. 128 MB; see :func:`buckets_for`)."""
        if buckets < 1:
            raise ValueError("buckets must be positive")
        self.spark, self.path, self.prefix, self.buckets = spark, path.rstrip("/"), prefix, buckets

    def write(self, tables: TableSet | dict[str, DataFrame]) -> list[str]:
        """Write every present table; a table of the same name must not exist. Returns the names written."""
        frames = tables.tables() if isinstance(tables, TableSet) else {n: d for n, d in tables.items() if d is not None}
        for name, df in frames.items():
            keys = BUCKET_KEYS.get(name)
            if keys:
                # one file for each bucket: rows meet their bucket's task before they are written
                writer = df.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).sortBy(*keys)
            else:
                writer = df.write
            writer.mode("errorifexists").option("path", f"{self.path}/{name}.parquet").format("parquet").saveAsTable(
                self.prefix + name)
        return list(frames)

    def open(self) -> TableSet:
        there = {name for name in TABLES if self.spark.catalog.tableExists(self.prefix + name)}
        return TableSet({name: self.spark.table(self.prefix + name) for name in there})
