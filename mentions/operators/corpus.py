"""Concept bags, IDF, TF-IDF and the IDF filter (AG-20 … AG-22).

A document's bag is its concepts, each repeated ``sum(freq)`` times; it is
kept as a table ``(doc_id, concept, count)`` rather than as a wrapped corpus
object. IDF is ``ln(N / df)`` with ``N`` = number of distinct documents in
the whole concepts table (before the type filter) and ``df`` = number of
documents whose bag holds the concept (``sum(freq) > 0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentions.operators import common as C


def _typed(concepts: DataFrame, concept_type: str, validate: bool) -> DataFrame:
    if validate:
        C.require_value(concepts, "concept_type", concept_type)
    return C.type_equals(concepts, "concept_type", concept_type)


def bag_counts(concepts: DataFrame, concept_type: str = "", validate: bool = True) -> DataFrame:
    """``doc_id, concept, count``: the bag contents without term frequencies."""
    typed = _typed(concepts, concept_type, validate).filter(F.col("concept").isNotNull())
    return (typed.groupBy("doc_id", "concept").agg(C.sum_or_zero("freq").alias("count"))
            .filter(F.col("count") > 0))


def concept_bags(concepts: DataFrame, concept_type: str = "", validate: bool = True, salts: int = C.SALTS) -> DataFrame:
    """AG-20: ``doc_id, concept, count, tf`` with ``tf = count / bag size``.

    Only concepts with a positive count are in a bag. The bag size is a
    salted per-document total (:func:`mentions.operators.common.with_group_total`),
    never a window over a whole document, so a document holding a large
    share of all rows is spread over ``salts`` tasks. Salting is by concept:
    a bag holds a concept once, so its rows spread.
    """
    counts = bag_counts(concepts, concept_type, validate)
    sized = C.with_group_total(counts, "doc_id", "concept", "count", "_size", salts)
    return sized.select("doc_id", "concept", "count", (F.col("count") / F.col("_size")).alias("tf"))


def document_count(concepts: DataFrame) -> Column:
    """Scalar ``N``: distinct documents of the whole table (type filter not applied)."""
    return concepts.agg(F.countDistinct("doc_id")).scalar()


def idf(concepts: DataFrame, concept_type: str = "", names=None, validate: bool = True) -> DataFrame:
    """AG-21: ``concept, doc_freq, idf`` for every concept of the type filter.

    With ``names`` it is a lookup instead: ``ord, concept, idf`` in request
    order with ``idf = 0`` for names no bag holds.
    """
    n_docs = document_count(concepts)
    df = bag_counts(concepts, concept_type, validate).groupBy("concept").agg(F.count(F.lit(1)).alias("doc_freq"))
    out = df.select("concept", "doc_freq", F.log(n_docs.cast("double") / F.col("doc_freq")).alias("idf"))
    if names is None:
        return out
    requests = C.request_table(concepts.sparkSession, names, "concept")
    found = C.keep_names(out, "concept", names if isinstance(names, DataFrame) else C.as_name_list(names))
    return C.lookup(requests, found.select("concept", "idf"), "concept", {"idf": 0.0})


def tf_idf(concepts: DataFrame, concept_type: str = "", validate: bool = True, salts: int | None = None) -> DataFrame:
    """TF-IDF per document and concept: ``doc_id, concept, tf, idf, tf_idf``.

    Bags are counted once and stored below the checkpoint folder (an eager
    step): size, document frequency and result all read that small table
    instead of counting anew. Both totals are salted, so a document or a
    concept with a large share of all rows is spread over ``salts`` tasks; by
    default as many as the largest document, or concept, of the stored bags
    calls for.
    """
    from mentions.session import scratch_dir

    spark = concepts.sparkSession
    path = scratch_dir(spark, "bags")
    bag_counts(concepts, concept_type, validate).write.parquet(path)
    bags = spark.read.parquet(path)
    doc_salt, concept_salt = (F.pmod(F.xxhash64(c), F.lit(salts or C.salts_for(C.largest_group(bags, group))))
                              for c, group in (("concept", "doc_id"), ("doc_id", "concept")))
    sizes = _totals(bags.withColumn("_d", doc_salt), "doc_id", "_d", F.sum("count"), "_size")
    freqs = _totals(bags.withColumn("_c", concept_salt), "concept", "_c", F.count(F.lit(1)), "_df")
    n_docs = document_count(concepts)
    joined = (bags.withColumn("_d", doc_salt).withColumn("_c", concept_salt)
              .join(sizes, ["doc_id", "_d"]).join(freqs, ["concept", "_c"]))
    return (joined.select("doc_id", "concept", (F.col("count") / F.col("_size")).alias("tf"),
                          F.log(n_docs.cast("double") / F.col("_df")).alias("idf"))
            .withColumn("tf_idf", F.col("tf") * F.col("idf")))


def _totals(rows: DataFrame, group: str, salt: str, value: Column, name: str) -> DataFrame:
    """``group, salt, total``: a group's total beside each of its salts (at most ``salts`` rows a group)."""
    parts = rows.groupBy(group, salt).agg(value.alias("_part"))
    return parts.select(group, salt, F.sum("_part").over(Window.partitionBy(group)).alias(name))


def idf_filter(concepts: DataFrame, threshold: float, concept_type: str = "", validate: bool = True) -> DataFrame:
    """AG-22: the concepts whose IDF is at least ``threshold``.

    A one-column DataFrame ``concept`` to use as a ``concept_filter`` (a
    left-semi join). Names that no bag holds have IDF 0, so for ``threshold
    <= 0`` they pass too: the names of the whole concepts table are added.
    """
    passing = idf(concepts, concept_type, validate=validate).filter(F.col("idf") >= F.lit(threshold)).select("concept")
    if threshold > 0:
        return passing
    return passing.unionByName(concepts.select("concept").filter(F.col("concept").isNotNull())).distinct()
