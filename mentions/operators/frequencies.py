"""Document frequencies, IDF and bags from summaries, with retraction (AG-20 … AG-22 after PF-09, PF-10).

:class:`Frequencies` answers as :mod:`mentions.operators.corpus` does over the
whole concepts table, from the sums that
:class:`~mentions.sources.summaries.Summaries` keeps by batch. Removing documents
subtracts what their bags had added; removing concepts drops their rows and the
documents that held nothing else. Views are immutable; nothing is rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentions.operators import common as C
from mentions.sources.summaries import IN_BAG, Summaries


def _of_type(rows: DataFrame, concept_type: str) -> DataFrame:
    """Rows of one concept type, or those over all types."""
    return rows.filter(~F.col("any_type") & (F.col("concept_type") == concept_type) if concept_type else F.col("any_type"))


@dataclass(frozen=True)
class Frequencies:
    """Frequencies of the summarised documents, without ``removed`` concepts and, if given, of the ``kept`` documents only."""

    summaries: Summaries
    removed: tuple = ()
    kept: tuple[DataFrame, ...] = ()
    #: the batches there were when the first view was made; all sums are theirs
    batches: dict[int, dict] | None = None

    def __post_init__(self):
        if self.batches is None:
            object.__setattr__(self, "batches", self.summaries.batches())

    def remove_concepts(self, names) -> "Frequencies":
        """PF-09: without the named concepts (documents that hold no other row don't count any more)."""
        return replace(self, removed=(*self.removed, names if isinstance(names, DataFrame) else C.as_name_list(names)))

    def filter(self, document_ids) -> "Frequencies":
        """PF-10: the given documents only (a collection, or a DataFrame with ``doc_id``)."""
        if not isinstance(document_ids, DataFrame):
            rows = [(int(i),) for i in set(document_ids)]
            document_ids = self.summaries.spark.createDataFrame(rows, "doc_id long")
        ids = document_ids.select(F.col("doc_id").cast("long"))
        if not ids.take(1):
            raise ValueError("no documents to keep")
        return replace(self, kept=(*self.kept, ids))

    def _table(self, kind: str) -> DataFrame:
        return self.summaries.table(kind, self.batches).drop("batch")

    def _keep(self, rows: DataFrame) -> DataFrame:
        for ids in self.kept:
            rows = rows.join(ids, "doc_id", "left_semi")
        return rows

    def _dropped(self) -> DataFrame:
        """The documents that the filters leave out, from the thin table of documents."""
        docs = self._table("docs").filter("any_type").select("doc_id")
        return docs.join(self._keep(docs), "doc_id", "left_anti")

    def _named(self, rows: DataFrame) -> DataFrame:
        for names in self.removed:
            rows = C.drop_names(rows, "concept", names)
        return rows

    def _lost(self, bags: DataFrame) -> DataFrame | None:
        """The rows of bags that removed concepts had."""
        if not self.removed:
            return None
        parts, rest = [], bags.filter(F.col("concept").isNotNull())
        for names in self.removed:
            parts.append(C.keep_names(rest, "concept", names))
            rest = C.drop_names(rest, "concept", names)
        lost = parts[0]
        for part in parts[1:]:
            lost = lost.unionByName(part)
        return lost

    def documents(self) -> Column:
        """Scalar ``N``: documents that have a row in the concepts table."""
        if not self.removed and not self.kept:
            return F.lit(sum(b["documents"] for b in self.batches.values()))
        docs = self._keep(self._table("docs").filter("any_type").select("doc_id", "rows"))
        lost = self._lost(self._table("bags").filter("any_type"))
        if lost is not None:
            gone = lost.groupBy("doc_id").agg(F.sum("rows").alias("_gone"))
            docs = docs.join(gone, "doc_id", "left").filter(F.col("rows") > F.coalesce("_gone", F.lit(0)))
        return docs.agg(F.count(F.lit(1))).scalar()

    def doc_freqs(self, concept_type: str = "") -> DataFrame:
        """``concept, doc_freq`` of concepts that some bag holds."""
        sums = _of_type(self._table("freqs"), concept_type).select("concept", "doc_freq")
        if self.kept:
            bags = _of_type(self._table("bags"), concept_type).filter(IN_BAG)
            gone = bags.join(self._dropped(), "doc_id", "left_semi").groupBy("concept").agg(F.count(F.lit(1)).alias("_n"))
            sums = sums.unionByName(gone.select("concept", (-F.col("_n")).alias("doc_freq")))
        total = self._named(sums).groupBy("concept").agg(F.sum("doc_freq").alias("doc_freq"))
        return total.filter(F.col("doc_freq") > 0)

    def idf(self, concept_type: str = "", names=None) -> DataFrame:
        """AG-21: ``concept, doc_freq, idf``; with ``names`` a look-up ``ord, concept, idf`` (0 where no bag holds it)."""
        ratio = self.documents().cast("double") / F.col("doc_freq")
        out = self.doc_freqs(concept_type).select("concept", "doc_freq", F.log(ratio).alias("idf"))
        if names is None:
            return out
        found = C.keep_names(out, "concept", names if isinstance(names, DataFrame) else C.as_name_list(names))
        requests = C.request_table(self.summaries.spark, names, "concept")
        return C.lookup(requests, found.select("concept", "idf"), "concept", {"idf": 0.0})

    def idf_filter(self, threshold: float, concept_type: str = "") -> DataFrame:
        """AG-22: the concepts whose IDF is at least ``threshold``; those of no bag have IDF 0."""
        passing = self.idf(concept_type).filter(F.col("idf") >= F.lit(threshold)).select("concept")
        if threshold > 0:
            return passing
        named = self._named(self._keep(self._table("bags"))).select("concept").filter(F.col("concept").isNotNull())
        return passing.unionByName(named).distinct()

    def concept_bags(self, concept_type: str = "") -> DataFrame:
        """AG-20: ``doc_id, concept, count, tf``. Sizes are looked up; removed concepts are taken off them.

        Both sides of the join come straight from scans or shuffles, so a
        document with a large share of all rows is split by AQE.
        """
        bags = _of_type(self._table("bags"), concept_type).filter(IN_BAG)
        sizes = _of_type(self._table("docs"), concept_type).select("doc_id", "size")
        lost = self._lost(bags)
        if lost is not None:
            sizes = sizes.unionByName(lost.groupBy("doc_id").agg((-F.sum("count")).alias("size")))
            sizes = sizes.groupBy("doc_id").agg(F.sum("size").alias("size")).repartition("doc_id")
        joined = self._named(self._keep(bags)).join(sizes, "doc_id")
        return joined.select("doc_id", "concept", "count", (F.col("count") / F.col("size")).alias("tf"))
