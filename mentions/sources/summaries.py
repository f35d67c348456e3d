"""Summaries of a set's concepts, kept batch by batch (AG-20 … AG-23, J-07, SF-11).

Beside the tables of a folder, ``_summaries`` keeps for each committed batch

* ``bags``: ``doc_id, concept, concept_type, any_type, count, rows``, the
  document's mentions by type and (``any_type``) over all types;
* ``docs``: ``doc_id, concept_type, any_type, size, rows``, sizes of the bags;
* ``freqs``: ``concept, concept_type, any_type, doc_freq``;
* ``days``: ``concept, day, total, undated``, running totals of a concept's
  mentions up to each day that has any; the row without a day counts the
  concept's documents without a date.

A batch's documents are in no other batch, so sums over batches are those of
the whole set: after an append only the new batch is read. A batch is written
to a folder of its own and shown by a small file that only one writer can
create, so writers at the same time, and one that dies, do no harm. A rewrite
moves the summaries aside with the tables.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.operators import common as C
from mentions.schemas import TABLES
from mentions.sources.registry import SUMMARIES, Registry, create_exclusively
from mentions.sources.tables import children, table_path

SCHEMAS = {
    "bags": "doc_id long, concept string, concept_type string, any_type boolean, count long, rows long",
    "docs": "doc_id long, concept_type string, any_type boolean, size long, rows long",
    "freqs": "concept string, concept_type string, any_type boolean, doc_freq long",
    "days": "concept string, day date, total long, undated long",
}
IN_BAG = "concept IS NOT NULL AND count > 0"


def bags_of(concepts: DataFrame) -> DataFrame:
    """Mentions and rows of each document and concept, by type and over all types."""
    keys = [F.col("doc_id"), F.col("concept")]
    sums = concepts.groupingSets([[*keys, F.col("concept_type")], keys], *keys, F.col("concept_type")).agg(
        F.grouping("concept_type").cast("boolean").alias("any_type"), C.sum_or_zero("freq").alias("count"),
        F.count(F.lit(1)).alias("rows"))
    return sums.select("doc_id", "concept", "concept_type", "any_type", "count", "rows")


def docs_of(bags: DataFrame) -> DataFrame:
    """Size of each document's bag, and its rows."""
    return bags.groupBy("doc_id", "concept_type", "any_type").agg(
        F.sum(F.when(F.expr(IN_BAG), F.col("count")).otherwise(0)).alias("size"), F.sum("rows").alias("rows"))


def freqs_of(bags: DataFrame) -> DataFrame:
    """In how many bags each concept is."""
    return bags.filter(IN_BAG).groupBy("concept", "concept_type", "any_type").agg(F.count(F.lit(1)).alias("doc_freq"))


def days_of(bags: DataFrame, date_info: DataFrame, date_col: str = "doc_date") -> DataFrame:
    """Running totals by day; of several dates of a document the earliest counts.

    A concept's window holds one row for each day that mentions it.
    """
    # a shuffle of its own lets the join split a document with a large share of all rows
    dates = (date_info.groupBy("doc_id").agg(F.min(date_col).alias("day")).filter(F.col("day").isNotNull())
             .repartition("doc_id"))
    named = bags.filter(F.col("any_type") & F.col("concept").isNotNull()).select("doc_id", "concept", "count")
    sums = named.join(dates, "doc_id", "left").groupBy("concept", "day").agg(
        F.sum("count").alias("count"), F.count(F.when(F.col("day").isNull(), 1)).alias("undated"))
    running = Window.partitionBy("concept").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.when(F.col("day").isNotNull(), F.col("count")).otherwise(0)).over(running)
    return sums.select("concept", "day", total.alias("total"), "undated")


class Summaries:
    """The summaries below ``root``, the folder of a set of parquet tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.path = f"{self.root}/{SUMMARIES}"

    def batches(self) -> dict[int, dict]:
        """What was recorded with each batch: its folder, its documents, the first and last date known."""
        if not any(n.endswith(".json") for n in children(self.spark, self.path)):
            return {}
        lines = self.spark.read.text(f"{self.path}/*.json", wholetext=True).collect()  # one short line for each batch
        found = [json.loads(r.value) for r in lines if r.value.endswith("\n")]
        return {b["batch"]: b for b in found}

    def add(self, batch: int, concepts: DataFrame, date_info: DataFrame | None = None, date_col: str = "doc_date") -> bool:
        """Summarise a batch; False if that was done before. Its documents must not be in another batch.

        Without ``date_info`` there are no running totals of it, and time series are refused.
        """
        if batch in self.batches():
            return False
        run = uuid.uuid4().hex
        self._write("bags", batch, run, bags_of(concepts), ["concept", "doc_id"])
        bags = self._read("bags", batch, run)
        self._write("docs", batch, run, docs_of(bags), ["doc_id"])
        self._write("freqs", batch, run, freqs_of(bags), ["concept"])
        first = last = None
        if date_info is not None:
            if not isinstance(date_info.schema[date_col].dataType, T.DateType):
                raise TypeError(f"{date_col} must be a DATE: totals are kept by day")
            self._write("days", batch, run, days_of(bags, date_info, date_col), ["concept", "day"])
            first, last = date_info.agg(F.min(date_col), F.max(date_col)).first()
        record = {"batch": batch, "run": run, "documents": self._read("docs", batch, run).filter("any_type").count(),
                  "dated": date_info is not None, "first": first and first.isoformat(), "last": last and last.isoformat()}
        return create_exclusively(self.spark, f"{self.path}/{batch:09d}.json", json.dumps(record) + "\n")

    def refresh(self, date_info: DataFrame | None = None, date_col: str = "doc_date") -> list[int]:
        """Summarise the committed batches of the set that are not yet; returns their numbers.

        Dates are taken as they are known when a batch is summarised.
        """
        registry = Registry(self.spark, self.root)
        registry.adopt()
        new = []
        for batch in sorted(registry.committed() - self.batches().keys()):
            if self.add(batch, self._rows(batch), date_info, date_col):
                new.append(batch)
        return new

    def _rows(self, batch: int) -> DataFrame:
        """The concepts of one batch; what was written at once is batch 0."""
        path = table_path(self.root, "concepts", "parquet")
        names = children(self.spark, path)
        reader = self.spark.read.schema(TABLES["concepts"])
        if f"batch={batch}" in names:
            return reader.parquet(f"{path}/batch={batch}")
        if batch == 0 and any(n.endswith(".parquet") for n in names):
            return reader.parquet(f"{path}/*.parquet")
        return self.spark.createDataFrame([], TABLES["concepts"])

    def _folder(self, kind: str, batch: int, run: str) -> str:
        return f"{self.path}/{kind}/batch={batch}/run={run}"

    def _write(self, kind: str, batch: int, run: str, rows: DataFrame, order: list[str]) -> None:
        """Sorted by ``order`` in ranges, with Bloom filters on its first column: a look-up reads the files that can hold it."""
        (rows.repartitionByRange(*order).sortWithinPartitions(*order)
         .write.option(f"parquet.bloom.filter.enabled#{order[0]}", "true").parquet(self._folder(kind, batch, run)))

    def _read(self, kind: str, batch: int, run: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[kind]).parquet(self._folder(kind, batch, run))

    def table(self, kind: str, batches: dict[int, dict] | None = None) -> DataFrame:
        """A summary of all batches (or of those that :meth:`batches` gave before), with the column ``batch``."""
        batches = self.batches() if batches is None else batches
        folders = [self._folder(kind, n, b["run"]) for n, b in batches.items() if kind != "days" or b["dated"]]
        schema = SCHEMAS[kind] + ", batch long"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema + ", run string").option("basePath", f"{self.path}/{kind}").parquet(*folders)
                .drop("run"))


def known_interval(batches: dict[int, dict]) -> tuple[dt.date, dt.date] | None:
    """The first and the last date known to the batches."""
    dates = [b[k] for b in batches.values() for k in ("first", "last") if b[k]]
    return (dt.date.fromisoformat(min(dates)), dt.date.fromisoformat(max(dates))) if dates else None
