"""Concept catalogue (AG-01 … AG-07, AG-24).

Every function takes the ``concepts`` (or ``concepts_surface_strings``) table
as a DataFrame and returns a lazy DataFrame. Concept counts are
``sum(freq)``; the concept-type filter is an equality test.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.errors import NoRelevantData
from mentions.operators import common as C
from mentions.sources.postings import texts_naming


def _typed(concepts: DataFrame, concept_type: str, validate: bool) -> DataFrame:
    if validate:
        C.require_value(concepts, "concept_type", concept_type)
    return C.type_equals(concepts, "concept_type", concept_type)


def _by_name(concepts: DataFrame) -> DataFrame:
    """``concept, _sum, _named``: sums by concept; rows without a name are one group, with ``_named`` 0."""
    return concepts.groupBy("concept").agg(F.sum("freq").alias("_sum"), F.count("concept").alias("_named"))


def _counts(concepts: DataFrame) -> DataFrame:
    # pandas' groupby leaves NULL keys out; so do we.
    return _by_name(concepts).filter("_named > 0").select("concept", F.coalesce("_sum", F.lit(0)).cast("long").alias("count"))


def _total(concepts: DataFrame) -> Column:
    """Sum of ``freq`` over all rows, named or not, from the sums by concept.

    The plan below the sum equals that of :func:`_counts` up to its exchange,
    so one scan and one exchange serve a ranking and its shares.
    """
    return _by_name(concepts).filter("_named >= 0").agg(F.sum("_sum")).scalar()


def concept_frequency(concepts: DataFrame, concept, concept_type: str = "", normalize: bool = False,
                      validate: bool = True) -> DataFrame:
    """AG-01: ``sum(freq)`` of the named concepts in request order, 0 if absent.

    Columns ``ord, concept, count`` (or ``share`` with ``normalize``: the
    count over the total of the type filter, NULL when that total is 0).
    """
    typed = _typed(concepts, concept_type, validate)
    requests = C.request_table(concepts.sparkSession, concept, "concept")
    found = _counts(C.keep_names(typed, "concept", requests if isinstance(concept, DataFrame) else C.as_name_list(concept)))
    result = C.lookup(requests, found, "concept", {"count": 0})
    return C.share_of(result, "count", _total(typed)) if normalize else result


def _common(concepts: DataFrame, n, concept_type, normalize, ascending, validate) -> DataFrame:
    typed = _typed(concepts, concept_type, validate)
    result = C.top_k(_counts(typed), "count", "concept", n, ascending=ascending)
    return C.share_of(result, "count", _total(typed)) if normalize else result


def most_common_concepts(concepts: DataFrame, n: int | None = 15, concept_type: str = "", normalize: bool = False,
                         validate: bool = True) -> DataFrame:
    """AG-02: top ``n`` concepts by ``sum(freq)``; columns ``concept, count, rank``."""
    return _common(concepts, n, concept_type, normalize, False, validate)


def least_common_concepts(concepts: DataFrame, n: int | None = 15, concept_type: str = "", normalize: bool = False,
                          validate: bool = True) -> DataFrame:
    """AG-03: bottom ``n`` concepts by ``sum(freq)``, ascending."""
    return _common(concepts, n, concept_type, normalize, True, validate)


def co_occurring_concepts(concepts: DataFrame, concept: str, n: int | None = 15, concept_type: str = "",
                          dedupe: bool = True, validate: bool = True, salts: int = C.SALTS,
                          postings: DataFrame | None = None) -> DataFrame:
    """AG-04: concepts sharing a text with ``concept`` (case-insensitive), by ``sum(freq)``.

    The texts holding the anchor become a left-semi join on
    ``(doc_id, text_order)``: each other concept row is kept at most once,
    however often the anchor occurs in its text, and no row is multiplied.
    ``dedupe=False`` counts a text once per anchor row in it (the
    multiplicity of the literal pandas join): the number of anchor rows of
    each text is attached to its rows as a salted group total and used as a
    multiplier, so no pair of rows is ever emitted and a hot text is spread
    over many tasks. With ``postings`` of the table
    (:mod:`mentions.sources.postings`) the anchor's texts are looked up there
    (with ``dedupe`` only).
    """
    if validate:
        C.require_value(concepts, "concept_type", concept_type)
    anchor = C.same_text("concept", concept)
    anchors = concepts.filter(anchor).select(*C.TEXT_KEY) if postings is None else texts_naming(postings, concept)
    others = C.type_equals(concepts.filter(~F.coalesce(anchor, F.lit(False))), "concept_type", concept_type)
    if dedupe:
        # Both join inputs come straight from shuffles, which lets AQE split
        # a hot text's partition (skew join); an aggregate (e.g. distinct())
        # on either side would hide that pattern from AQE.
        joined = others.join(anchors, C.TEXT_KEY, "left_semi")
    else:
        # Anchor rows per text, attached to every row of the text as a salted
        # group total (skew-safe), then used as a multiplier: no row pairs.
        is_anchor = F.coalesce(anchor, F.lit(False))
        keep = is_anchor | (F.col("concept_type") == concept_type) if concept_type else F.lit(True)
        tagged = concepts.filter(keep).withColumn("_anchor", is_anchor.cast("long"))
        # Raw rows: a concept may be repeated in a text, so all columns of a row make its salt.
        counted = C.with_group_total(tagged, C.TEXT_KEY, tagged.columns, "_anchor", "_k", salts)
        joined = (counted.filter((F.col("_anchor") == 0) & (F.col("_k") > 0))
                  .withColumn("freq", F.col("freq") * F.col("_k")))
    counts = joined.filter(F.col("concept").isNotNull()).groupBy("concept").agg(C.sum_or_zero("freq").alias("count"))
    return C.top_k(counts, "count", "concept", n)


ConceptFilter = Callable[[str], bool] | Column | DataFrame


def apply_concept_filter(df: DataFrame, concept_filter: ConceptFilter | None, column: str = "concept") -> DataFrame:
    """PF-11 / UD-01: keep rows whose concept passes ``concept_filter``.

    Accepted forms, fastest first:
      * a DataFrame with a ``concept`` column (e.g. :func:`idf_filter`): left-semi join;
      * a Column: a JVM-side predicate;
      * a callable: always a Python predicate str -> bool, evaluated by a
        pandas UDF on the distinct names only, then applied as a left-semi
        join. NULL names don't pass.
    """
    if concept_filter is None:
        return df
    if isinstance(concept_filter, DataFrame):
        return df.join(concept_filter.select(F.col("concept").alias(column)), column, "left_semi")
    if isinstance(concept_filter, Column):
        return df.filter(concept_filter)
    fn = concept_filter

    @F.pandas_udf(T.BooleanType())
    def _passes(names: pd.Series) -> pd.Series:
        return names.map(lambda s: bool(fn(s)))

    # Not deterministic for the optimiser: it would else infer the same filter
    # for the other side of the join and run it on every row.
    passes = _passes.asNondeterministic()
    names = df.select(F.col(column)).distinct().filter(F.col(column).isNotNull())
    return df.join(names.filter(passes(F.col(column))), column, "left_semi")


def concept_frequencies(concepts: DataFrame, max_concepts: int = 200, concept_type: str = "",
                        concept_filter=None, validate: bool = True) -> DataFrame:
    """AG-05: the ``max_concepts`` most frequent concepts, listed ascending.

    Type filter first, then ``concept_filter``; columns ``concept, freq``.
    """
    typed = apply_concept_filter(_typed(concepts, concept_type, validate), concept_filter)
    counts = _counts(typed).withColumnRenamed("count", "freq")
    top = counts.orderBy(F.col("freq").desc(), F.col("concept").asc_nulls_last()).limit(max_concepts)
    return top.orderBy(F.col("freq").asc(), F.col("concept").desc_nulls_first())


def frequency_relevance(concepts: DataFrame, names=None, n: int | None = 15, concept_type: str = "",
                        validate: bool = True) -> DataFrame:
    """AG-06: ``frequency = sum(freq)`` and ``relevance = avg(relevance_score)``.

    Without names: top ``n`` by relevance (rank column). With a list of
    names: request order (``ord``), ``n`` ignored, duplicates kept. Rows with
    NULL relevance are dropped either way.
    """
    typed = _typed(concepts, concept_type, validate)
    if names is not None and not isinstance(names, DataFrame) and len(C.as_name_list(names)) == 0:
        names = None
    if names is not None:
        typed = C.keep_names(typed, "concept", names)
    agg = typed.filter(F.col("concept").isNotNull()).groupBy("concept").agg(
        C.sum_or_zero("freq").alias("frequency"), F.avg("relevance_score").alias("relevance"))
    if names is None:
        return C.top_k(agg.filter(F.col("relevance").isNotNull()), "relevance", "concept", n)
    requests = C.request_table(concepts.sparkSession, names, "concept")
    return C.lookup(requests, agg, "concept").filter(F.col("relevance").isNotNull())


def surface_forms(surface_strings: DataFrame, concept: str, n: int | None = 15) -> DataFrame:
    """AG-07: up to ``n`` distinct surface strings of ``concept`` (case-insensitive).

    "First" means first seen in ``(doc_id, text_order, surface_string)``
    order: one group per distinct string keeps its earliest position, then a
    top-n over those positions.
    """
    C.check_n(n)
    firsts = (surface_strings.filter(C.same_text("concept", concept))
              .groupBy("surface_string")
              .agg(F.min(F.struct("doc_id", "text_order")).alias("_first")))
    ordered = firsts.orderBy(F.col("_first").asc(), F.col("surface_string").asc_nulls_first())
    if n is not None:
        ordered = ordered.limit(n)
    return ordered.select("surface_string")


class Concepts:
    """Facade over the concepts tables, mirroring the reference's method names."""

    def __init__(self, concepts: DataFrame | None, surface_strings: DataFrame | None = None):
        self._concepts = concepts
        self._surface = surface_strings

    def _need(self) -> DataFrame:
        if self._concepts is None:
            raise NoRelevantData("no table concepts")
        return self._concepts

    def concept_frequency(self, concept, concept_type="", normalize=False):
        return concept_frequency(self._need(), concept, concept_type, normalize)

    def most_common_concepts(self, n=15, concept_type="", normalize=False):
        return most_common_concepts(self._need(), n, concept_type, normalize)

    def least_common_concepts(self, n=15, concept_type="", normalize=False):
        return least_common_concepts(self._need(), n, concept_type, normalize)

    def co_occurring_concepts(self, concept, n=15, concept_type="", dedupe=True):
        return co_occurring_concepts(self._need(), concept, n, concept_type, dedupe)

    def concept_frequencies(self, max_concepts=200, concept_type="", concept_filter=None):
        return concept_frequencies(self._need(), max_concepts, concept_type, concept_filter)

    def frequency_relevance(self, concepts=None, n=15, concept_type=""):
        return frequency_relevance(self._need(), concepts, n, concept_type)

    def surface_forms(self, concept, n=15):
        if self._surface is None:
            raise NoRelevantData("no table concepts_surface_strings")
        return surface_forms(self._surface, concept, n)

    # corpus and time series live in their own modules; exposed here too.
    def concept_bags(self, concept_type=""):
        from mentions.operators import corpus
        return corpus.concept_bags(self._need(), concept_type)

    def idf(self, concept_type=""):
        from mentions.operators import corpus
        return corpus.idf(self._need(), concept_type)

    def make_idf_filter(self, threshold, concept_type=""):
        from mentions.operators import corpus
        return corpus.idf_filter(self._need(), threshold, concept_type)

    def make_time_series(self, concepts, date_info, delta, interval=None, missing_dates="error"):
        from mentions.operators import series
        return series.concept_time_series(self._need(), concepts, date_info, delta, interval, missing_dates)
