"""Entity (aspect-based sentiment) catalogue (AG-11 … AG-19).

Entity counts are row counts; the entity-type filter is a prefix test;
ratings come from relations joined to their entities on
``(doc_id, text_order, relation_id)`` after dropping the ``|v| >= 100``
"no rating" sentinel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.errors import NoRelevantData
from mentions.operators import common as C
from mentions.sources.postings import texts_naming

SENTINEL = 100.0  # fixed value: |sentiment_value| >= 100 means "no rating"


def _named(entities: DataFrame, entity_type: str) -> DataFrame:
    return C.type_prefix(entities, "entity_type", entity_type).filter(F.col("entity_name").isNotNull())


def _counts(named: DataFrame) -> DataFrame:
    return named.groupBy("entity_name").agg(F.count(F.lit(1)).alias("count"))


def _total(named: DataFrame):
    """All named mentions, summed from the counts by entity (their exchange is reused)."""
    return _counts(named).agg(F.sum("count")).scalar()


def entity_frequency(entities: DataFrame, entity, entity_type: str = "", normalize: bool = False) -> DataFrame:
    """AG-11: mention count of the named entities in request order (0 if absent).

    Columns ``ord, entity_name, count`` or ``share`` (count over the named
    mentions in the type filter).
    """
    named = _named(entities, entity_type)
    requests = C.request_table(entities.sparkSession, entity, "entity_name")
    found = _counts(C.keep_names(named, "entity_name", requests if isinstance(entity, DataFrame) else entity))
    result = C.lookup(requests, found, "entity_name", {"count": 0})
    return C.share_of(result, "count", _total(named)) if normalize else result


def most_common_entities(entities: DataFrame, n: int | None = 15, entity_type: str = "",
                         normalize: bool = False) -> DataFrame:
    """AG-12: top ``n`` entities by mention count; ``entity_name, count, rank``."""
    named = _named(entities, entity_type)
    result = C.top_k(_counts(named), "count", "entity_name", n)
    return C.share_of(result, "count", _total(named)) if normalize else result


def least_common_entities(entities: DataFrame, n: int | None = 15, entity_type: str = "",
                          normalize: bool = False) -> DataFrame:
    """AG-13: bottom ``n`` entities by mention count, ascending."""
    named = _named(entities, entity_type)
    result = C.top_k(_counts(named), "count", "entity_name", n, ascending=True)
    return C.share_of(result, "count", _total(named)) if normalize else result


def co_occurring_entities(entities: DataFrame, entity: str, n: int | None = 15, entity_type: str = "",
                          postings: DataFrame | None = None) -> DataFrame:
    """AG-14: entities sharing a text with ``entity`` (case-insensitive), by mention count.

    Texts holding the anchor are a left-semi join on ``(doc_id, text_order)``,
    so every other mention counts once however often the anchor occurs. With
    ``postings`` of the table (:mod:`mentions.sources.postings`) they are looked
    up there.
    """
    anchor = C.same_text("entity_name", entity)
    anchors = entities.filter(anchor).select(*C.TEXT_KEY) if postings is None else texts_naming(postings, entity)
    others = _named(entities.filter(~F.coalesce(anchor, F.lit(False))), entity_type)
    counts = _counts(others.join(anchors, C.TEXT_KEY, "left_semi"))  # skew: see co_occurring_concepts
    return C.top_k(counts, "count", "entity_name", n)


def rated_mentions(relations: DataFrame, relations_entities: DataFrame) -> DataFrame:
    """Rated relation entities: sentinel-free relations joined to their entities.

    Columns ``doc_id, text_order, relation_id, entity_type, entity_name,
    sentiment_value``. Shared by every rating operator; cache it when several
    rating queries run on the same tables.
    """
    # |v| < 100 written as a range so that parquet row groups can be skipped
    # (same rows: NULL and NaN fail both forms).
    v = F.col("sentiment_value")
    rels = relations.filter((v > -SENTINEL) & (v < SENTINEL)).select(*C.RELATION_KEY, "sentiment_value")
    ents = relations_entities.select(*C.RELATION_KEY, "entity_type", "entity_name")
    return rels.join(ents, C.RELATION_KEY, "inner")


def _ratings(rated: DataFrame, entity_type: str) -> DataFrame:
    return (C.type_prefix(rated, "entity_type", entity_type).filter(F.col("entity_name").isNotNull())
            .groupBy("entity_name").agg(F.avg("sentiment_value").alias("sentiment")))


def best_rated_entities(relations: DataFrame, relations_entities: DataFrame, n: int | None = 15,
                        entity_type: str = "") -> DataFrame:
    """AG-15: top ``n`` entities by mean relation sentiment; ``entity_name, sentiment, rank``."""
    return C.top_k(_ratings(rated_mentions(relations, relations_entities), entity_type), "sentiment", "entity_name", n)


def worst_rated_entities(relations: DataFrame, relations_entities: DataFrame, n: int | None = 15,
                         entity_type: str = "") -> DataFrame:
    """AG-16: bottom ``n`` entities by mean relation sentiment (inner join, see D11)."""
    return C.top_k(_ratings(rated_mentions(relations, relations_entities), entity_type), "sentiment", "entity_name",
                   n, ascending=True)


def entity_sentiment(relations: DataFrame, relations_entities: DataFrame, entity) -> DataFrame:
    """AG-17: mean sentiment of the named entities in request order; NULL when unrated."""
    rated = C.keep_names(rated_mentions(relations, relations_entities), "entity_name",
                         entity if isinstance(entity, DataFrame) else C.as_name_list(entity))
    means = rated.groupBy("entity_name").agg(F.avg("sentiment_value").alias("sentiment"))
    requests = C.request_table(relations.sparkSession, entity, "entity_name")
    return C.lookup(requests, means, "entity_name")


def opinion_strings(relations: DataFrame, relations_entities: DataFrame, entity) -> DataFrame:
    """AG-18: relation surface strings of each named entity, one row per relation.

    Long form ``entity_name, doc_id, text_order, relation_id,
    surface_string``: an entity named twice in one relation contributes one
    row; duplicates across relations stay; the sentinel is not applied.
    Unknown names have no rows (the reference's empty list). The strings of
    an entity are never gathered into one array: a popular entity may have
    any number of them.
    """
    names = entity if isinstance(entity, DataFrame) else sorted(set(C.as_name_list(entity)))
    ents = (C.keep_names(relations_entities, "entity_name", names)
            .select(*C.RELATION_KEY, "entity_name").dropDuplicates())
    rels = relations.select(*C.RELATION_KEY, "surface_string")
    return (rels.join(ents, C.RELATION_KEY, "inner")
            .select("entity_name", *C.RELATION_KEY, "surface_string")
            .orderBy("entity_name", *C.RELATION_KEY))


def entity_texts(entities: DataFrame, normalized_texts: DataFrame, entity) -> DataFrame:
    """AG-19: normalised texts mentioning each named entity, once per text.

    Long form ``entity_name, doc_id, text_order, normalized_text``.
    """
    names = entity if isinstance(entity, DataFrame) else sorted(set(C.as_name_list(entity)))
    ents = (C.keep_names(entities, "entity_name", names)
            .select(*C.TEXT_KEY, "entity_name").dropDuplicates())
    texts = normalized_texts.select(*C.TEXT_KEY, "normalized_text")
    return (ents.join(texts, C.TEXT_KEY, "inner")
            .select("entity_name", *C.TEXT_KEY, "normalized_text")
            .orderBy("entity_name", *C.TEXT_KEY))


class Absa:
    """Facade over the six ABSA tables, mirroring the reference's method names."""

    def __init__(self, entities=None, normalized_texts=None, relations=None, relations_entities=None,
                 evaluations=None, evaluations_entities=None):
        self._entities = entities
        self._texts = normalized_texts
        self._relations = relations
        self._relations_entities = relations_entities
        self._evaluations = evaluations
        self._evaluations_entities = evaluations_entities

    def _ents(self) -> DataFrame:
        if self._entities is None:
            raise NoRelevantData("no table absa_entities")
        return self._entities

    def _rels(self) -> tuple[DataFrame, DataFrame]:
        if self._relations is None or self._relations_entities is None:
            raise NoRelevantData("no table absa_relations or absa_relations_entities")
        return self._relations, self._relations_entities

    def entity_frequency(self, entity, entity_type="", normalize=False):
        return entity_frequency(self._ents(), entity, entity_type, normalize)

    def most_common_entities(self, n=15, entity_type="", normalize=False):
        return most_common_entities(self._ents(), n, entity_type, normalize)

    def least_common_entities(self, n=15, entity_type="", normalize=False):
        return least_common_entities(self._ents(), n, entity_type, normalize)

    def co_occurring_entities(self, entity, n=15, entity_type=""):
        return co_occurring_entities(self._ents(), entity, n, entity_type)

    def best_rated_entities(self, n=15, entity_type=""):
        return best_rated_entities(*self._rels(), n, entity_type)

    def worst_rated_entities(self, n=15, entity_type=""):
        return worst_rated_entities(*self._rels(), n, entity_type)

    def entity_sentiment(self, entity):
        return entity_sentiment(*self._rels(), entity)

    def surface_strings(self, entity):
        return opinion_strings(*self._rels(), entity)

    def entity_texts(self, entity):
        if self._entities is None or self._texts is None:
            raise NoRelevantData("no table absa_entities or absa_normalized_texts")
        return entity_texts(self._entities, self._texts, entity)

    def rated_mentions(self):
        return rated_mentions(*self._rels())
