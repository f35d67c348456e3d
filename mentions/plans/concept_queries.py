"""Registered concept queries (AG-01 … AG-07) over the derived views."""

from __future__ import annotations

from mentions.operators import concepts as K
from mentions.plans.registry import REGISTRY, r, register, rounded
from mentions.session import scratch_dir
from mentions.sources.bucketed import BucketedSink, buckets_for
from mentions.sources.postings import write_postings
from mentions.sources.views import load_views, with_views

# Fixed query arguments for the registered checks.
ANCHOR = "Brand#1"
CONCEPT_TYPE = "economy"
LOOKUP = ["Brand#5", "NotHere", "Brand#1", "Brand#5"]
N = 15

_LOOKUP_VALUES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(LOOKUP))
_REQUESTS = f"requests(ord, concept) AS (SELECT * FROM (VALUES {_LOOKUP_VALUES}) v(ord, concept))"


def _v(spark, sf_dir):
    return load_views(spark, sf_dir)


@register("most_common_concepts", ids=("AG-02", "PF-01", "SO-01", "SF-05"), oracle=with_views(f"""
SELECT concept, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, concept) AS INTEGER) AS rank
FROM (SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS count FROM concepts GROUP BY concept) t
ORDER BY count DESC, concept LIMIT {N}""", "concepts"))
def most_common_concepts(spark, sf_dir):
    return K.most_common_concepts(_v(spark, sf_dir)["concepts"], n=N)


@register("most_common_concepts_typed_share", ids=("AG-02", "AG-24", "PF-01", "PF-03"), oracle=with_views(f"""
SELECT concept, {r("count / (SELECT SUM(freq) FROM concepts WHERE concept_type = 'economy')")} AS share,
  CAST(ROW_NUMBER() OVER (ORDER BY count DESC, concept) AS INTEGER) AS rank
FROM (SELECT concept, COALESCE(SUM(freq), 0) AS count FROM concepts WHERE concept_type = '{CONCEPT_TYPE}' GROUP BY concept) t
ORDER BY count DESC, concept LIMIT {N}""", "concepts"))
def most_common_concepts_typed_share(spark, sf_dir):
    return rounded(K.most_common_concepts(_v(spark, sf_dir)["concepts"], n=N, concept_type=CONCEPT_TYPE, normalize=True))


@register("least_common_concepts", ids=("AG-03", "SO-02"), oracle=with_views(f"""
SELECT concept, count, CAST(ROW_NUMBER() OVER (ORDER BY count, concept) AS INTEGER) AS rank
FROM (SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS count FROM concepts GROUP BY concept) t
ORDER BY count, concept LIMIT {N}""", "concepts"))
def least_common_concepts(spark, sf_dir):
    return K.least_common_concepts(_v(spark, sf_dir)["concepts"], n=N)


@register("concept_frequency", ids=("AG-01", "J-09", "PF-04", "SO-06"), oracle=with_views(f"""
, {_REQUESTS},
found AS (SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS count FROM concepts
          WHERE concept IN ('Brand#5', 'NotHere', 'Brand#1') GROUP BY concept)
SELECT CAST(q.ord AS INTEGER) AS ord, q.concept, COALESCE(f.count, 0) AS count
FROM requests q LEFT JOIN found f ON q.concept = f.concept ORDER BY ord""", "concepts"))
def concept_frequency(spark, sf_dir):
    return K.concept_frequency(_v(spark, sf_dir)["concepts"], LOOKUP)


@register("concept_frequency_share", ids=("AG-01", "AG-24", "D12"), oracle=with_views(f"""
, {_REQUESTS},
typed AS (SELECT * FROM concepts WHERE concept_type = '{CONCEPT_TYPE}'),
found AS (SELECT concept, COALESCE(SUM(freq), 0) AS count FROM typed
          WHERE concept IN ('Brand#5', 'NotHere', 'Brand#1') GROUP BY concept)
SELECT CAST(q.ord AS INTEGER) AS ord, q.concept, {r("COALESCE(f.count, 0) / (SELECT SUM(freq) FROM typed)")} AS share
FROM requests q LEFT JOIN found f ON q.concept = f.concept ORDER BY ord""", "concepts"))
def concept_frequency_share(spark, sf_dir):
    return rounded(K.concept_frequency(_v(spark, sf_dir)["concepts"], LOOKUP, concept_type=CONCEPT_TYPE, normalize=True))


@register("co_occurring_concepts", ids=("AG-04", "J-01", "PF-05", "PF-06", "D9", "D10", "SF-01"), oracle=with_views(f"""
, anchors AS (SELECT DISTINCT doc_id, text_order FROM concepts WHERE lower(concept) = lower('{ANCHOR}')),
counts AS (
  SELECT c.concept, CAST(COALESCE(SUM(c.freq), 0) AS BIGINT) AS count
  FROM concepts c JOIN anchors a ON c.doc_id = a.doc_id AND c.text_order = a.text_order
  WHERE lower(c.concept) <> lower('{ANCHOR}') GROUP BY c.concept)
SELECT concept, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, concept) AS INTEGER) AS rank
FROM counts ORDER BY count DESC, concept LIMIT {N}""", "concepts"))
def co_occurring_concepts(spark, sf_dir):
    return K.co_occurring_concepts(_v(spark, sf_dir)["concepts"], ANCHOR, n=N)


@register("co_occurring_concepts_postings", ids=("AG-04", "J-01", "PF-05", "PF-06"), oracle=REGISTRY["co_occurring_concepts"].oracle)
def co_occurring_concepts_postings(spark, sf_dir):
    """As above over the bucketed layout, the anchor's texts from the postings."""
    path = scratch_dir(spark, "concept-postings")
    v = _v(spark, sf_dir)
    sink = BucketedSink(spark, path, f"c{path[-32:]}_", buckets_for(v.raw("lineitem").count()))
    sink.write({"concepts": v["concepts"]})
    concepts = sink.open()["concepts"]
    return K.co_occurring_concepts(concepts, ANCHOR, n=N, postings=write_postings(concepts, "concept", f"{path}/postings"))


@register("co_occurring_concepts_multiplicity", ids=("AG-04", "D9"), oracle=with_views(f"""
, anchors AS (SELECT doc_id, text_order FROM concepts WHERE lower(concept) = lower('{ANCHOR}')),
counts AS (
  SELECT c.concept, CAST(COALESCE(SUM(c.freq), 0) AS BIGINT) AS count
  FROM concepts c JOIN anchors a ON c.doc_id = a.doc_id AND c.text_order = a.text_order
  WHERE lower(c.concept) <> lower('{ANCHOR}') AND c.concept_type = '{CONCEPT_TYPE}' GROUP BY c.concept)
SELECT concept, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, concept) AS INTEGER) AS rank
FROM counts ORDER BY count DESC, concept LIMIT {N}""", "concepts"))
def co_occurring_concepts_multiplicity(spark, sf_dir):
    return K.co_occurring_concepts(_v(spark, sf_dir)["concepts"], ANCHOR, n=N, concept_type=CONCEPT_TYPE, dedupe=False)


@register("concept_frequencies", ids=("AG-05", "SO-03"), oracle=with_views(f"""
SELECT concept, freq FROM (
  SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS freq FROM concepts WHERE concept_type = '{CONCEPT_TYPE}'
  GROUP BY concept ORDER BY freq DESC, concept LIMIT 10) t
ORDER BY freq, concept DESC""", "concepts"))
def concept_frequencies(spark, sf_dir):
    return K.concept_frequencies(_v(spark, sf_dir)["concepts"], max_concepts=10, concept_type=CONCEPT_TYPE)


@register("frequency_relevance", ids=("AG-06", "PF-08"), oracle=with_views(f"""
SELECT concept, frequency, {r("relevance")} AS relevance,
  CAST(ROW_NUMBER() OVER (ORDER BY relevance DESC, concept) AS INTEGER) AS rank
FROM (SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS frequency, AVG(relevance_score) AS relevance
      FROM concepts GROUP BY concept) t
WHERE relevance IS NOT NULL ORDER BY relevance DESC, concept LIMIT {N}""", "concepts"))
def frequency_relevance(spark, sf_dir):
    return rounded(K.frequency_relevance(_v(spark, sf_dir)["concepts"], n=N))


@register("frequency_relevance_lookup", ids=("AG-06", "J-09", "D16"), oracle=with_views(f"""
, {_REQUESTS},
found AS (SELECT concept, CAST(COALESCE(SUM(freq), 0) AS BIGINT) AS frequency, AVG(relevance_score) AS relevance
          FROM concepts WHERE concept IN ('Brand#5', 'NotHere', 'Brand#1') GROUP BY concept)
SELECT CAST(q.ord AS INTEGER) AS ord, q.concept, f.frequency, {r("f.relevance")} AS relevance
FROM requests q LEFT JOIN found f ON q.concept = f.concept WHERE f.relevance IS NOT NULL ORDER BY ord""",
    "concepts"))
def frequency_relevance_lookup(spark, sf_dir):
    return rounded(K.frequency_relevance(_v(spark, sf_dir)["concepts"], LOOKUP))


@register("surface_forms", ids=("AG-07", "SO-05", "SE-04"), oracle=with_views(f"""
SELECT surface_string FROM (
  SELECT surface_string, doc_id, text_order,
         ROW_NUMBER() OVER (PARTITION BY surface_string ORDER BY doc_id, text_order) AS rn
  FROM concepts_surface_strings WHERE lower(concept) = lower('{ANCHOR}')) x
WHERE rn = 1 ORDER BY doc_id, text_order, surface_string LIMIT {N}""", "concepts_surface_strings"))
def surface_forms(spark, sf_dir):
    return K.surface_forms(_v(spark, sf_dir)["concepts_surface_strings"], ANCHOR, n=N)
