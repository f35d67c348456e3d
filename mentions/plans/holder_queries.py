"""Registered queries for the holder filters, display helpers, sinks and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentions.functions.display import remove_stopwords, with_display_names
from mentions.operators import concepts as K
from mentions.plans.registry import r, register, rounded
from mentions.session import scratch_dir
from mentions.sources.sinks import TableSink, ViewSink
from mentions.sources.tables import TableSet
from mentions.sources.views import Raw, load_views, with_views

# Fixed query arguments for the registered checks.
REMOVED = ["Brand#1", "Brand#2"]
STATUS = "F"
ROLE = "user"
STOPWORDS = ["la", "le", "des", "und", "the", "de"]


def _set(spark, sf_dir, *names):
    v = load_views(spark, sf_dir)
    return TableSet({n: v[n] for n in names})


@register("remove_concepts", ids=("PF-09", "D4"), oracle=with_views("""
SELECT concept, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, concept) AS INTEGER) AS rank FROM (
  SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS count FROM concepts
  WHERE concept NOT IN ('Brand#1', 'Brand#2') GROUP BY concept) t""", "concepts"))
def remove_concepts(spark, sf_dir):
    tables = _set(spark, sf_dir, "concepts", "concepts_surface_strings").remove_concepts(REMOVED)
    return K.most_common_concepts(tables["concepts"], n=None)


@register("remove_concepts_surface", ids=("PF-09",), oracle=with_views("""
SELECT doc_id, text_order, concept, surface_string, text_span FROM concepts_surface_strings
WHERE concept NOT IN ('Brand#1', 'Brand#2')""", "concepts_surface_strings"))
def remove_concepts_surface(spark, sf_dir):
    tables = _set(spark, sf_dir, "concepts", "concepts_surface_strings").remove_concepts(REMOVED)
    return tables["concepts_surface_strings"]


@register("filter_documents", ids=("PF-10",), oracle=with_views(f"""
SELECT c.doc_id, c.text_order, c.concept, c.freq, {r("c.relevance_score")} AS relevance_score, c.concept_type
FROM concepts c WHERE c.doc_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = '{STATUS}')""", "concepts"))
def filter_documents(spark, sf_dir):
    orders = Raw(spark, sf_dir)("orders")
    ids = orders.filter(F.col("o_orderstatus") == STATUS).select(F.col("o_orderkey").alias("doc_id"))
    tables = _set(spark, sf_dir, "concepts", "absa_entities").filter(ids)
    return rounded(tables["concepts"])


@register("stopword_frequencies", ids=("PF-12", "AG-05"), oracle=with_views(f"""
SELECT concept, freq FROM (
  SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS freq FROM token_concepts
  WHERE concept_type = '{ROLE}' AND concept IS NOT NULL GROUP BY concept ORDER BY freq DESC, concept LIMIT 40) t
WHERE lower(concept) NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)})""", "token_concepts"))
def stopword_frequencies(spark, sf_dir):
    tokens = load_views(spark, sf_dir)["token_concepts"]
    return remove_stopwords(K.concept_frequencies(tokens, max_concepts=40, concept_type=ROLE), STOPWORDS)


@register("display_names", ids=("SF-08", "SF-09"), oracle=with_views("""
SELECT concept, concept_type,
  trim(array_to_string(list_transform(regexp_extract_all(concept, '([A-Z][a-z]*|[0-9]+)(-?)', 0),
       lambda w: CASE WHEN w LIKE '%-' OR length(w) <= 1 THEN w ELSE w || ' ' END), '')) AS display_name,
  CASE WHEN concept_type IS NULL OR concept_type = '' THEN 'Concept'
       ELSE array_to_string(list_transform(string_split(concept_type, '_'),
            lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), '') END AS type_label
FROM (SELECT DISTINCT concept, concept_type FROM token_concepts) t""", "token_concepts"))
def display_names(spark, sf_dir):
    tokens = load_views(spark, sf_dir)["token_concepts"]
    return with_display_names(tokens.select("concept", "concept_type").distinct())


def _round_trip(spark, sf_dir, fmt):
    tables = _set(spark, sf_dir, "concepts", "absa_relations")
    sink = TableSink(spark, scratch_dir(spark, "sink"), fmt)
    sink.write(tables)
    return TableSet.from_sink(sink)


_REL_COLS = f"""doc_id, text_order, relation_id, opinion_holder, restriction, {r("sentiment_value")} AS sentiment_value,
  is_external, surface_string, text_span"""


@register("csv_round_trip", ids=("SK-01", "SK-03", "SK-04", "SC-01", "SC-05"), oracle=with_views(f"""
SELECT {_REL_COLS} FROM absa_relations""", "absa_relations"))
def csv_round_trip(spark, sf_dir):
    return rounded(_round_trip(spark, sf_dir, "csv")["absa_relations"])


@register("parquet_round_trip", ids=("SK-01", "SC-01", "SC-06"), oracle=with_views(f"""
SELECT doc_id, text_order, concept, freq, {r("relevance_score")} AS relevance_score, concept_type FROM concepts""",
                                                                                    "concepts"))
def parquet_round_trip(spark, sf_dir):
    return rounded(_round_trip(spark, sf_dir, "parquet")["concepts"])


@register("backup_round_trip", ids=("SC-02", "SK-03", "SK-01"), oracle=with_views(f"""
SELECT {_REL_COLS} FROM absa_relations""", "absa_relations"))
def backup_round_trip(spark, sf_dir):
    """Write the relations, write a second (changed) version over them, and
    read the first version back through its time-stamped backup suffix."""
    v = load_views(spark, sf_dir)
    sink = TableSink(spark, scratch_dir(spark, "backup"), "parquet")
    sink.write({"absa_relations": v["absa_relations"]})
    newer = v["absa_relations"].withColumn("surface_string", F.upper("surface_string"))
    sink.write({"absa_relations": newer})
    suffix = sink.backed_up[0].rsplit("_", 1)[-1]
    return rounded(TableSet.from_path(spark, sink.path, "parquet", backup_suffix=suffix)["absa_relations"])


@register("rewrite_in_place", ids=("SK-01", "SK-03", "PF-09"), oracle=with_views(f"""
SELECT doc_id, text_order, concept, freq, {r("relevance_score")} AS relevance_score, concept_type FROM concepts
WHERE concept NOT IN ('Brand#1', 'Brand#2')""", "concepts"))
def rewrite_in_place(spark, sf_dir):
    """Load, change, write back to the same folder; an empty table is left out."""
    path = scratch_dir(spark, "in-place")
    v = load_views(spark, sf_dir)
    TableSink(spark, path).write({"concepts": v["concepts"], "categories": v["categories"].filter(F.lit(False))})
    TableSink(spark, path).write(TableSet.from_path(spark, path).remove_concepts(REMOVED))
    back = TableSet.from_path(spark, path)
    if back.has("categories"):
        raise AssertionError("an empty table was written")
    return rounded(back["concepts"])


@register("csv_permuted_columns", ids=("SC-01", "SF-06"), oracle=with_views(f"""
SELECT doc_id, text_order, concept, freq, {r("relevance_score")} AS relevance_score, concept_type FROM concepts""", "concepts"))
def csv_permuted_columns(spark, sf_dir):
    """A CSV whose columns come in another order, and with one more: columns go by their header."""
    path = scratch_dir(spark, "permuted")
    concepts = load_views(spark, sf_dir)["concepts"]
    odd = concepts.select("concept_type", "freq", F.lit("x").alias("note"), "text_order", "concept", "relevance_score", "doc_id")
    odd.write.option("header", True).csv(f"{path}/concepts.csv")
    return rounded(TableSet.from_path(spark, path, "csv", multi_line=False)["concepts"])


@register("csv_line_breaks", ids=("SC-01",), oracle="""
SELECT doc_id, CAST(0 AS BIGINT) AS text_order, COALESCE(text, '') AS normalized_text FROM documents""")
def csv_line_breaks(spark, sf_dir):
    """Whole texts, with their line breaks and quotes, from CSV files that are read in splits."""
    path = scratch_dir(spark, "line-breaks")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.lit(0).cast("long").alias("text_order"), F.col("text").alias("normalized_text"))
    texts.write.options(header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
        f"{path}/absa_normalized_texts.csv")
    back = TableSet.from_path(spark, path, "csv")["absa_normalized_texts"]
    return back.select("doc_id", "text_order", F.coalesce("normalized_text", F.lit("")).alias("normalized_text"))


@register("projected_concepts", ids=("PF-13",), oracle=with_views(
    "SELECT DISTINCT concept, concept_type FROM concepts", "concepts"))
def projected_concepts(spark, sf_dir):
    """Two columns of a table: the others are not computed."""
    return _set(spark, sf_dir, "concepts")["concepts"].select("concept", "concept_type").distinct()


@register("column_filtered_frequencies", ids=("PF-11", "AG-05"), oracle=with_views(f"""
SELECT concept, freq FROM (
  SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS freq FROM token_concepts
  WHERE concept_type = '{ROLE}' AND concept LIKE 't%' GROUP BY concept ORDER BY freq DESC, concept LIMIT 25) t""",
                                                                          "token_concepts"))
def column_filtered_frequencies(spark, sf_dir):
    tokens = load_views(spark, sf_dir)["token_concepts"]
    keep = F.col("concept").startswith("t")
    return K.concept_frequencies(tokens, max_concepts=25, concept_type=ROLE, concept_filter=keep)


@register("view_sink_round_trip", ids=("SK-02", "SC-03"), oracle=with_views("""
SELECT category, CAST(COUNT(*) AS BIGINT) AS n FROM categories GROUP BY category""", "categories"))
def view_sink_round_trip(spark, sf_dir):
    """Tables registered as session views and queried back with SQL."""
    sink = ViewSink(spark, prefix="mentions_check_")
    sink.write(_set(spark, sf_dir, "categories"))
    return spark.sql("SELECT category, CAST(COUNT(*) AS BIGINT) AS n FROM mentions_check_categories GROUP BY category")


def _suffix_predicate(name: str) -> bool:
    """A plain Python predicate (runs in a pandas UDF on distinct names)."""
    text = str(name)
    return text.endswith("ion") and len(text) > 5


@register("python_filtered_frequencies", ids=("UD-01", "PF-11", "AG-05"), oracle=with_views(f"""
SELECT concept, freq FROM (
  SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS freq FROM token_concepts
  WHERE concept_type = '{ROLE}' AND concept LIKE '%ion' AND length(concept) > 5
  GROUP BY concept ORDER BY freq DESC, concept LIMIT 25) t""", "token_concepts"))
def python_filtered_frequencies(spark, sf_dir):
    tokens = load_views(spark, sf_dir)["token_concepts"]
    return K.concept_frequencies(tokens, max_concepts=25, concept_type=ROLE, concept_filter=_suffix_predicate)
