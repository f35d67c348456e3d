"""Declared schemas of the ten flat tables and of the nested analysis JSON.

The column names and their order are fixed values shared with the reference
(the flat-table headers); the types are declared here rather than inferred
so that names such as ``30`` or ``NA`` stay strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Table names, column names and column order of the ten tables.
CATEGORIES = _schema(("doc_id", L, False), ("text_order", I, False), ("category", S, True), ("probability", D, True))
CONCEPTS = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("concept", S, True), ("freq", L, True),
    ("relevance_score", D, True), ("concept_type", S, True),
)
CONCEPTS_SURFACE_STRINGS = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("concept", S, True), ("surface_string", S, True),
    ("text_span", S, True),
)
SENTIMENTS = _schema(("doc_id", L, False), ("text_order", I, False), ("sentiment_value", D, True))
ABSA_ENTITIES = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("entity_name", S, True), ("entity_type", S, True),
    ("surface_string", S, True), ("text_span", S, True),
)
ABSA_NORMALIZED_TEXTS = _schema(("doc_id", L, False), ("text_order", I, False), ("normalized_text", S, True))
ABSA_RELATIONS = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("relation_id", I, False), ("opinion_holder", S, True),
    ("restriction", S, True), ("sentiment_value", D, True), ("is_external", B, True),
    ("surface_string", S, True), ("text_span", S, True),
)
ABSA_RELATIONS_ENTITIES = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("relation_id", I, False), ("entity_type", S, True),
    ("entity_name", S, True),
)
ABSA_EVALUATIONS = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("evaluation_id", I, False), ("sentiment_value", D, True),
    ("surface_string", S, True), ("text_span", S, True),
)
ABSA_EVALUATIONS_ENTITIES = _schema(
    ("doc_id", L, False), ("text_order", I, False), ("evaluation_id", I, False), ("entity_type", S, True),
    ("entity_name", S, True),
)

TABLES: dict[str, T.StructType] = {
    "categories": CATEGORIES,
    "concepts": CONCEPTS,
    "concepts_surface_strings": CONCEPTS_SURFACE_STRINGS,
    "sentiments": SENTIMENTS,
    "absa_entities": ABSA_ENTITIES,
    "absa_normalized_texts": ABSA_NORMALIZED_TEXTS,
    "absa_relations": ABSA_RELATIONS,
    "absa_relations_entities": ABSA_RELATIONS_ENTITIES,
    "absa_evaluations": ABSA_EVALUATIONS,
    "absa_evaluations_entities": ABSA_EVALUATIONS_ENTITIES,
}

# Which analysis call produces which tables (also the facade grouping).
CALL_TABLES: dict[str, list[str]] = {
    "categories": ["categories"],
    "concepts": ["concepts", "concepts_surface_strings"],
    "sentiments": ["sentiments"],
    "absa": [
        "absa_entities", "absa_normalized_texts", "absa_relations", "absa_relations_entities",
        "absa_evaluations", "absa_evaluations_entities",
    ],
}

# Nested analysis envelope: one row per service response. ``seq`` is the
# caller-supplied input order used to hand out document ids.
_SPAN = T.ArrayType(I)
_SURFACE = _schema(("surface_string", S, True), ("span", _SPAN, True))
_SEMANTIC = _schema(("type", S, True), ("value", S, True))
ANALYSIS = T.StructType([
    T.StructField("seq", L, True),
    T.StructField("single_document", B, True),
    T.StructField("categories", T.ArrayType(T.ArrayType(_schema(("label", S, True), ("probability", D, True))))),
    T.StructField("concepts", T.ArrayType(T.ArrayType(_schema(
        ("concept", S, True), ("freq", L, True), ("relevance_score", D, True), ("type", S, True),
        ("surface", T.ArrayType(_SURFACE), True),
    )))),
    T.StructField("sentiment", T.ArrayType(_schema(("sentiment_value", D, True)))),
    T.StructField("absa", T.ArrayType(T.StructType([
        T.StructField("entities", T.ArrayType(_schema(("semantics", T.ArrayType(_SEMANTIC), True), ("surface", _SURFACE, True)))),
        T.StructField("evaluations", T.ArrayType(T.StructType([
            T.StructField("semantics", _schema(("entity", T.ArrayType(_SEMANTIC), True), ("sentiment_value", D, True))),
            T.StructField("surface", _SURFACE),
        ]))),
        T.StructField("normalized_text", S),
        T.StructField("relations", T.ArrayType(T.StructType([
            T.StructField("external_entity", B),
            T.StructField("semantics", _schema(
                ("entity", T.ArrayType(_SEMANTIC), True), ("opinion_holder", S, True),
                ("restriction", S, True), ("sentiment_value", D, True),
            )),
            T.StructField("surface", _SURFACE),
        ]))),
    ]))),
])


def conform(df, name: str):
    """Project ``df`` onto the declared schema of table ``name`` (order + types)."""
    from pyspark.sql import functions as F

    schema = TABLES[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
