"""Registered category, sentiment and entity queries (AG-08 … AG-19, AG-25)."""

from __future__ import annotations

from mentions.operators import absa as A
from mentions.operators import categories as G
from mentions.plans.registry import REGISTRY, r, register, rounded
from mentions.session import scratch_dir
from mentions.sources.bucketed import BucketedSink, buckets_for
from mentions.sources.postings import write_postings
from mentions.sources.views import load_views, with_views

# Fixed query arguments for the registered checks.
ENTITY_LOOKUP = ["Brand#5", "NotHere", "NATION_3", "Brand#5"]
ANCHOR = "brand#1"
PREFIX = "s"
BUCKETS = 8
N = 15
PIE = 3


def _values(names, col):
    vals = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"requests(ord, {col}) AS (SELECT * FROM (VALUES {vals}) v(ord, {col}))"


def _in(names):
    return ", ".join(f"'{n}'" for n in sorted(set(names)))


_MEANS = "means AS (SELECT category, AVG(probability) AS probability FROM categories WHERE category IS NOT NULL GROUP BY category)"


@register("category_profile", ids=("AG-08", "SO-04"), oracle=with_views(f"""
, {_MEANS}
SELECT category, {r("probability")} AS probability FROM means ORDER BY probability DESC, category""", "categories"))
def category_profile(spark, sf_dir):
    return rounded(G.category_profile(load_views(spark, sf_dir)["categories"]))


@register("main_category", ids=("AG-09",), oracle=with_views(f"""
, {_MEANS}
SELECT category FROM means ORDER BY probability DESC, category LIMIT 1""", "categories"))
def main_category(spark, sf_dir):
    return G.main_category(load_views(spark, sf_dir)["categories"])


@register("category_pie", ids=("AG-25", "SF-10"), oracle=with_views(f"""
, {_MEANS},
ranked AS (SELECT category, probability, ROW_NUMBER() OVER (ORDER BY probability DESC, category) AS rn FROM means),
slices AS (SELECT rn, category AS label, probability FROM ranked WHERE rn <= {PIE}
           UNION ALL SELECT {PIE + 1}, 'other', COALESCE(SUM(probability), 0.0) FROM ranked WHERE rn > {PIE}),
capped AS (SELECT rn, upper(substr(label, 1, 1)) || lower(substr(label, 2)) AS cap, probability FROM slices)
SELECT CAST({PIE + 1} - rn AS INTEGER) AS slice,
  CASE WHEN cap = 'Auto' THEN 'Automotive' WHEN cap = 'Hr' THEN 'HR' ELSE cap END AS label,
  {r("probability")} AS probability
FROM capped ORDER BY slice""", "categories"))
def category_pie(spark, sf_dir):
    return rounded(G.category_pie(load_views(spark, sf_dir)["categories"], PIE))


@register("average_sentiment", ids=("AG-10",), oracle=with_views(f"""
SELECT {r("AVG(sentiment_value)")} AS average_sentiment FROM sentiments""", "sentiments"))
def average_sentiment(spark, sf_dir):
    return rounded(G.average_sentiment(load_views(spark, sf_dir)["sentiments"]))


_NAMED = f"named AS (SELECT * FROM absa_entities WHERE starts_with(entity_type, '{PREFIX}') AND entity_name IS NOT NULL)"


@register("entity_frequency", ids=("AG-11", "PF-02", "J-09"), oracle=with_views(f"""
, {_values(ENTITY_LOOKUP, "entity_name")}, {_NAMED},
found AS (SELECT entity_name, COUNT(*) AS count FROM named GROUP BY entity_name)
SELECT CAST(q.ord AS INTEGER) AS ord, q.entity_name, COALESCE(f.count, 0) AS count
FROM requests q LEFT JOIN found f ON q.entity_name = f.entity_name ORDER BY ord""", "absa_entities"))
def entity_frequency(spark, sf_dir):
    return A.entity_frequency(load_views(spark, sf_dir)["absa_entities"], ENTITY_LOOKUP, PREFIX)


@register("entity_frequency_share", ids=("AG-11", "AG-24", "D12"), oracle=with_views(f"""
, {_values(ENTITY_LOOKUP, "entity_name")}, {_NAMED},
found AS (SELECT entity_name, COUNT(*) AS count FROM named GROUP BY entity_name)
SELECT CAST(q.ord AS INTEGER) AS ord, q.entity_name, {r("COALESCE(f.count, 0) / (SELECT COUNT(*) FROM named)")} AS share
FROM requests q LEFT JOIN found f ON q.entity_name = f.entity_name ORDER BY ord""", "absa_entities"))
def entity_frequency_share(spark, sf_dir):
    return rounded(A.entity_frequency(load_views(spark, sf_dir)["absa_entities"], ENTITY_LOOKUP, PREFIX, normalize=True))


@register("most_common_entities", ids=("AG-12", "PF-02", "SF-02"), oracle=with_views(f"""
, {_NAMED}
SELECT entity_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, entity_name) AS INTEGER) AS rank
FROM (SELECT entity_name, COUNT(*) AS count FROM named GROUP BY entity_name) t
ORDER BY count DESC, entity_name LIMIT {N}""", "absa_entities"))
def most_common_entities(spark, sf_dir):
    return A.most_common_entities(load_views(spark, sf_dir)["absa_entities"], N, PREFIX)


@register("least_common_entities_share", ids=("AG-13", "AG-24"), oracle=with_views(f"""
, named AS (SELECT * FROM absa_entities WHERE entity_name IS NOT NULL AND entity_type IS NOT NULL)
SELECT entity_name, {r("count / (SELECT COUNT(*) FROM named)")} AS share,
  CAST(ROW_NUMBER() OVER (ORDER BY count, entity_name) AS INTEGER) AS rank
FROM (SELECT entity_name, COUNT(*) AS count FROM named GROUP BY entity_name) t
ORDER BY count, entity_name LIMIT {N}""", "absa_entities"))
def least_common_entities_share(spark, sf_dir):
    return rounded(A.least_common_entities(load_views(spark, sf_dir)["absa_entities"], N, "", normalize=True))


@register("co_occurring_entities", ids=("AG-14", "J-02", "SE-03"), oracle=with_views(f"""
, anchors AS (SELECT DISTINCT doc_id, text_order FROM absa_entities WHERE lower(entity_name) = lower('{ANCHOR}')),
counts AS (
  SELECT e.entity_name, COUNT(*) AS count
  FROM absa_entities e JOIN anchors a ON e.doc_id = a.doc_id AND e.text_order = a.text_order
  WHERE lower(e.entity_name) <> lower('{ANCHOR}') AND e.entity_type IS NOT NULL GROUP BY e.entity_name)
SELECT entity_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, entity_name) AS INTEGER) AS rank
FROM counts ORDER BY count DESC, entity_name LIMIT {N}""", "absa_entities"))
def co_occurring_entities(spark, sf_dir):
    return A.co_occurring_entities(load_views(spark, sf_dir)["absa_entities"], ANCHOR, N)


@register("co_occurring_entities_postings", ids=("AG-14", "J-02", "PF-05", "PF-06"), oracle=REGISTRY["co_occurring_entities"].oracle)
def co_occurring_entities_postings(spark, sf_dir):
    """As above over the bucketed layout, the anchor's texts from the postings."""
    path = scratch_dir(spark, "entity-postings")
    v = load_views(spark, sf_dir)
    sink = BucketedSink(spark, path, f"e{path[-32:]}_", buckets_for(v.raw("lineitem").count()))
    sink.write({"absa_entities": v["absa_entities"]})
    entities = sink.open()["absa_entities"]
    return A.co_occurring_entities(entities, ANCHOR, N, postings=write_postings(entities, "entity_name", f"{path}/postings"))


_RATED = """rated AS (
  SELECT r.sentiment_value, e.entity_type, e.entity_name
  FROM absa_relations r JOIN absa_relations_entities e
    ON r.doc_id = e.doc_id AND r.text_order = e.text_order AND r.relation_id = e.relation_id
  WHERE abs(r.sentiment_value) < 100)"""


def _rated_views():
    return ("absa_relations", "absa_relations_entities")


@register("best_rated_entities", ids=("AG-15", "J-03", "PF-07", "SF-03"), oracle=with_views(f"""
, {_RATED},
means AS (SELECT entity_name, AVG(sentiment_value) AS sentiment FROM rated
          WHERE entity_name IS NOT NULL AND entity_type IS NOT NULL GROUP BY entity_name)
SELECT entity_name, {r("sentiment")} AS sentiment,
  CAST(ROW_NUMBER() OVER (ORDER BY sentiment DESC, entity_name) AS INTEGER) AS rank
FROM means ORDER BY sentiment DESC, entity_name LIMIT {N}""", *_rated_views()))
def best_rated_entities(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return rounded(A.best_rated_entities(v["absa_relations"], v["absa_relations_entities"], N))


@register("best_rated_bucketed", ids=("AG-15", "J-03", "SK-01"), oracle=with_views(f"""
, {_RATED},
means AS (SELECT entity_name, AVG(sentiment_value) AS sentiment FROM rated
          WHERE entity_name IS NOT NULL AND entity_type IS NOT NULL GROUP BY entity_name)
SELECT entity_name, {r("sentiment")} AS sentiment,
  CAST(ROW_NUMBER() OVER (ORDER BY sentiment DESC, entity_name) AS INTEGER) AS rank
FROM means ORDER BY sentiment DESC, entity_name LIMIT {N}""", *_rated_views()))
def best_rated_bucketed(spark, sf_dir):
    """As ``best_rated_entities``, over tables bucketed by the join's keys."""
    v = load_views(spark, sf_dir)
    path = scratch_dir(spark, "bucketed")
    sink = BucketedSink(spark, path, f"b{path[-32:]}_", buckets_for(v.raw("lineitem").count(), BUCKETS))  # a catalog name: no "-"
    sink.write({"absa_relations": v["absa_relations"], "absa_relations_entities": v["absa_relations_entities"]})
    tables = sink.open()
    return rounded(A.best_rated_entities(tables["absa_relations"], tables["absa_relations_entities"], N))


@register("worst_rated_entities", ids=("AG-16", "J-04", "D11"), oracle=with_views(f"""
, {_RATED},
means AS (SELECT entity_name, AVG(sentiment_value) AS sentiment FROM rated
          WHERE entity_name IS NOT NULL AND starts_with(entity_type, 'nation') GROUP BY entity_name)
SELECT entity_name, {r("sentiment")} AS sentiment,
  CAST(ROW_NUMBER() OVER (ORDER BY sentiment, entity_name) AS INTEGER) AS rank
FROM means ORDER BY sentiment, entity_name LIMIT {N}""", *_rated_views()))
def worst_rated_entities(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return rounded(A.worst_rated_entities(v["absa_relations"], v["absa_relations_entities"], N, "nation"))


@register("entity_sentiment", ids=("AG-17", "J-09", "D31"), oracle=with_views(f"""
, {_values(ENTITY_LOOKUP, "entity_name")}, {_RATED},
means AS (SELECT entity_name, AVG(sentiment_value) AS sentiment FROM rated GROUP BY entity_name)
SELECT CAST(q.ord AS INTEGER) AS ord, q.entity_name, {r("m.sentiment")} AS sentiment
FROM requests q LEFT JOIN means m ON q.entity_name = m.entity_name ORDER BY ord""", *_rated_views()))
def entity_sentiment(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return rounded(A.entity_sentiment(v["absa_relations"], v["absa_relations_entities"], ENTITY_LOOKUP))


@register("opinion_strings", ids=("AG-18", "J-05", "SE-03"), oracle=with_views(f"""
, ents AS (SELECT DISTINCT doc_id, text_order, relation_id, entity_name FROM absa_relations_entities
           WHERE entity_name IN ({_in(ENTITY_LOOKUP)}))
SELECT e.entity_name, r.doc_id, r.text_order, r.relation_id, r.surface_string
FROM absa_relations r JOIN ents e ON r.doc_id = e.doc_id AND r.text_order = e.text_order AND r.relation_id = e.relation_id
ORDER BY 1, 2, 3, 4""", *_rated_views()))
def opinion_strings(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return A.opinion_strings(v["absa_relations"], v["absa_relations_entities"], ENTITY_LOOKUP)


@register("entity_texts", ids=("AG-19", "J-06"), oracle=with_views(f"""
, ents AS (SELECT DISTINCT doc_id, text_order, entity_name FROM absa_entities WHERE entity_name IN ({_in(ENTITY_LOOKUP)}))
SELECT e.entity_name, t.doc_id, t.text_order, t.normalized_text
FROM ents e JOIN absa_normalized_texts t ON e.doc_id = t.doc_id AND e.text_order = t.text_order
ORDER BY 1, 2, 3""", "absa_entities", "absa_normalized_texts"))
def entity_texts(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return A.entity_texts(v["absa_entities"], v["absa_normalized_texts"], ENTITY_LOOKUP)


@register("least_common_entities", ids=("AG-13", "PF-02", "SO-02"), oracle=with_views(f"""
, named AS (SELECT * FROM absa_entities WHERE starts_with(entity_type, 'e') AND entity_name IS NOT NULL)
SELECT entity_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count, entity_name) AS INTEGER) AS rank
FROM (SELECT entity_name, COUNT(*) AS count FROM named GROUP BY entity_name) t
ORDER BY count, entity_name LIMIT {N}""", "absa_entities"))
def least_common_entities(spark, sf_dir):
    return A.least_common_entities(load_views(spark, sf_dir)["absa_entities"], N, "e")


@register("co_occurring_entities_typed", ids=("AG-14", "PF-02", "PF-06"), oracle=with_views(f"""
, anchors AS (SELECT DISTINCT doc_id, text_order FROM absa_entities WHERE lower(entity_name) = lower('{ANCHOR}')),
counts AS (
  SELECT e.entity_name, COUNT(*) AS count
  FROM absa_entities e JOIN anchors a ON e.doc_id = a.doc_id AND e.text_order = a.text_order
  WHERE lower(e.entity_name) <> lower('{ANCHOR}') AND starts_with(e.entity_type, '{PREFIX}') GROUP BY e.entity_name)
SELECT entity_name, count, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, entity_name) AS INTEGER) AS rank
FROM counts ORDER BY count DESC, entity_name LIMIT {N}""", "absa_entities"))
def co_occurring_entities_typed(spark, sf_dir):
    return A.co_occurring_entities(load_views(spark, sf_dir)["absa_entities"], ANCHOR, N, PREFIX)
