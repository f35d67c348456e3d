"""Registered corpus and time-series queries (AG-20 … AG-23)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from mentions.operators import concepts as K
from mentions.operators import corpus as P
from mentions.operators import series as S
from mentions.operators.frequencies import Frequencies
from mentions.plans.registry import r, register, rounded
from mentions.session import scratch_dir
from mentions.sources.summaries import Summaries
from mentions.sources.views import load_views, with_views

# Fixed query arguments for the registered checks.
ROLE = "user"
IDF_THRESHOLD = 2.0
SERIES_NAMES = ["Brand#5", "NotHere", "Brand#1"]
SERIES_DAYS = 90
WINDOW = (dt.date(1996, 1, 1), dt.date(1997, 1, 1))
WINDOW_DAYS = 30

_BAGS = """counts AS (SELECT doc_id, concept, CAST(SUM(freq) AS BIGINT) AS count FROM token_concepts
            WHERE concept IS NOT NULL{type} GROUP BY doc_id, concept HAVING SUM(freq) > 0),
sizes AS (SELECT doc_id, SUM(count) AS size FROM counts GROUP BY doc_id),
bags AS (SELECT c.doc_id, c.concept, c.count, c.count / s.size AS tf FROM counts c JOIN sizes s ON c.doc_id = s.doc_id),
idf AS (SELECT concept, COUNT(*) AS doc_freq,
               LN((SELECT COUNT(DISTINCT doc_id) FROM token_concepts) / COUNT(*)) AS idf FROM counts GROUP BY concept)"""


def _bags(concept_type: str = "") -> str:
    return _BAGS.format(type=f" AND concept_type = '{concept_type}'" if concept_type else "")


@register("concept_bags", ids=("AG-20",), oracle=with_views(f"""
, {_bags()}
SELECT doc_id, concept, count, {r("tf")} AS tf FROM bags""", "token_concepts"))
def concept_bags(spark, sf_dir):
    return rounded(P.concept_bags(load_views(spark, sf_dir)["token_concepts"]))


@register("idf", ids=("AG-21", "D22", "D23", "SF-07"), oracle=with_views(f"""
, {_bags()}
SELECT concept, doc_freq, {r("idf")} AS idf FROM idf""", "token_concepts"))
def idf(spark, sf_dir):
    return rounded(P.idf(load_views(spark, sf_dir)["token_concepts"]))


@register("tf_idf", ids=("AG-20", "AG-21"), oracle=with_views(f"""
, {_bags(ROLE)}
SELECT b.doc_id, b.concept, {r("b.tf")} AS tf, {r("i.idf")} AS idf, {r("b.tf * i.idf")} AS tf_idf
FROM bags b JOIN idf i ON b.concept = i.concept""", "token_concepts"))
def tf_idf(spark, sf_dir):
    return rounded(P.tf_idf(load_views(spark, sf_dir)["token_concepts"], ROLE))


@register("idf_filtered_frequencies", ids=("AG-22", "AG-05", "PF-11", "UD-01"), oracle=with_views(f"""
, {_bags(ROLE)},
passing AS (SELECT concept FROM idf WHERE idf >= {IDF_THRESHOLD}),
freqs AS (SELECT t.concept, CAST(COALESCE(SUM(t.freq), 0) AS BIGINT) AS freq FROM token_concepts t
          WHERE t.concept_type = '{ROLE}' AND t.concept IS NOT NULL AND t.concept IN (SELECT concept FROM passing)
          GROUP BY t.concept)
SELECT concept, freq FROM (SELECT * FROM freqs ORDER BY freq DESC, concept LIMIT 20) x
ORDER BY freq, concept DESC""", "token_concepts"))
def idf_filtered_frequencies(spark, sf_dir):
    tokens = load_views(spark, sf_dir)["token_concepts"]
    keep = P.idf_filter(tokens, IDF_THRESHOLD, ROLE)
    return K.concept_frequencies(tokens, max_concepts=20, concept_type=ROLE, concept_filter=keep)


def _series_sql(names, days, lo=None, hi=None) -> str:
    vals = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    names_in = ", ".join(f"'{n}'" for n in sorted(set(names)))
    if lo is None:
        bounds = f"SELECT MIN(doc_date) AS s, MAX(doc_date) + {days} AS e FROM date_info"
    else:
        bounds = f"SELECT DATE '{lo}' AS s, DATE '{hi}' AS e"
    return with_views(f"""
, requests(ord, concept) AS (SELECT * FROM (VALUES {vals}) v(ord, concept)),
bounds AS ({bounds}),
n AS (SELECT s, GREATEST(CAST(CEIL((e - s) / {float(days)}) AS BIGINT), 0) AS n_ticks FROM bounds),
grid AS (SELECT q.ord, q.concept, t.tick FROM requests q CROSS JOIN n
         CROSS JOIN LATERAL (SELECT unnest(range(0, n.n_ticks)) AS tick) t),
mentions AS (SELECT c.concept, c.freq, CAST(FLOOR((d.doc_date - n.s) / {float(days)}) AS BIGINT) AS tick
             FROM concepts c JOIN date_info d ON c.doc_id = d.doc_id CROSS JOIN n
             WHERE c.concept IN ({names_in})),
counts AS (SELECT concept, tick, SUM(freq) AS cnt FROM mentions
           WHERE tick >= 0 AND tick < (SELECT n_ticks FROM n) GROUP BY concept, tick)
SELECT CAST(g.ord AS INTEGER) AS ord, g.concept,
  CAST(n.s + CAST(g.tick * {days} AS INTEGER) AS DATE) AS start,
  CAST(n.s + CAST((g.tick + 1) * {days} AS INTEGER) AS DATE) AS stop,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM grid g CROSS JOIN n LEFT JOIN counts c ON g.concept = c.concept AND g.tick = c.tick
ORDER BY ord, start""", "concepts", "date_info")


@register("concept_time_series", ids=("AG-23", "J-07", "J-08", "J-10", "SF-11", "SF-12", "D18", "D19", "SE-01"),
          oracle=_series_sql(SERIES_NAMES, SERIES_DAYS))
def concept_time_series(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return S.concept_time_series(v["concepts"], SERIES_NAMES, v["date_info"], dt.timedelta(days=SERIES_DAYS))


@register("concept_time_series_window", ids=("AG-23", "D18"),
          oracle=_series_sql(SERIES_NAMES, WINDOW_DAYS, *WINDOW))
def concept_time_series_window(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return S.concept_time_series(v["concepts"], SERIES_NAMES, v["date_info"], WINDOW_DAYS, interval=WINDOW)


TICK_HOURS = 36  # fixed query argument: ticks that no whole number of days gives
TIMED = (dt.datetime(1996, 1, 1, 6), dt.datetime(1996, 2, 20, 0))


@register("concept_time_series_timestamps", ids=("AG-23", "SF-11", "SF-12", "D19"), oracle=with_views(f"""
, n AS (SELECT TIMESTAMP '{TIMED[0]}' AS s, CAST(CEIL(date_diff('second', TIMESTAMP '{TIMED[0]}', TIMESTAMP '{TIMED[1]}')
          / {TICK_HOURS * 3600.0}) AS BIGINT) AS ticks),
names AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(SERIES_NAMES))}) v(ord, concept)),
grid AS (SELECT ord, concept, unnest(range(0, n.ticks)) AS tick FROM names CROSS JOIN n),
m AS (SELECT c.concept, c.freq, CAST(FLOOR(date_diff('second', n.s, CAST(d.doc_date AS TIMESTAMP) + INTERVAL 7 HOUR)
        / {TICK_HOURS * 3600.0}) AS BIGINT) AS tick
      FROM concepts c JOIN date_info d ON c.doc_id = d.doc_id CROSS JOIN n),
counts AS (SELECT concept, tick, SUM(freq) AS cnt FROM m GROUP BY concept, tick)
SELECT CAST(g.ord AS INTEGER) AS ord, g.concept, n.s + to_hours(g.tick * {TICK_HOURS}) AS start,
  n.s + to_hours((g.tick + 1) * {TICK_HOURS}) AS stop, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM grid g CROSS JOIN n LEFT JOIN counts c ON g.concept = c.concept AND g.tick = c.tick""", "concepts", "date_info"))
def concept_time_series_timestamps(spark, sf_dir):
    """TIMESTAMP_NTZ dates (seven in the morning) and ticks of 36 hours."""
    v = load_views(spark, sf_dir)
    dates = v["date_info"].select("doc_id", F.expr("CAST(doc_date AS TIMESTAMP_NTZ) + INTERVAL 7 HOUR").alias("doc_date"))
    return S.concept_time_series(v["concepts"], SERIES_NAMES, dates, dt.timedelta(hours=TICK_HOURS), interval=TIMED)


@register("concept_time_series_drop", ids=("AG-23", "J-08"), oracle=_series_sql(
    SERIES_NAMES, WINDOW_DAYS, *WINDOW).replace("CAST(o_orderdate AS DATE) AS doc_date FROM orders",
                                                "CAST(o_orderdate AS DATE) AS doc_date FROM orders WHERE o_orderkey % 3 <> 0"))
def concept_time_series_drop(spark, sf_dir):
    """Documents without a date (here those whose key divides by three) are left out; repeated dates count once."""
    v = load_views(spark, sf_dir)
    dated = v["date_info"].withColumn("doc_date", F.when(F.col("doc_id") % 3 != 0, F.col("doc_date")))
    twice = dated.unionByName(dated.withColumn("doc_date", F.date_add("doc_date", 400)))
    return S.concept_time_series(v["concepts"], SERIES_NAMES, twice, WINDOW_DAYS, interval=WINDOW, missing_dates="drop")


BATCHES = 3  # fixed query argument: batches of documents, as appends would make them
DROPPED = ["und", "the"]


def _summarised(spark, concepts, date_info=None) -> Summaries:
    """Summaries of the whole table, which comes in batches by ranges of documents."""
    out = Summaries(spark, scratch_dir(spark, "summaries"))
    lo, hi = concepts.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = (hi - lo) // BATCHES + 1
    for k in range(BATCHES):
        here = (F.col("doc_id") >= lo + k * width) & (F.col("doc_id") < lo + (k + 1) * width)
        out.add(k, concepts.filter(here), date_info)
    return out


@register("concept_time_series_totals", ids=("AG-23", "J-07", "SF-11"), oracle=_series_sql(SERIES_NAMES, SERIES_DAYS))
def concept_time_series_totals(spark, sf_dir):
    """The series from running totals that were kept by batch."""
    v = load_views(spark, sf_dir)
    return S.series_from_totals(_summarised(spark, v["concepts"], v["date_info"]), SERIES_NAMES, SERIES_DAYS)


@register("concept_time_series_totals_window", ids=("AG-23", "J-07", "SF-11", "D18"),
          oracle=_series_sql(SERIES_NAMES, WINDOW_DAYS, *WINDOW))
def concept_time_series_totals_window(spark, sf_dir):
    v = load_views(spark, sf_dir)
    return S.series_from_totals(_summarised(spark, v["concepts"], v["date_info"]), SERIES_NAMES, WINDOW_DAYS, interval=WINDOW)


@register("idf_kept", ids=("AG-21",), oracle=with_views(f"""
, {_bags(ROLE)}
SELECT concept, doc_freq, {r("idf")} AS idf FROM idf""", "token_concepts"))
def idf_kept(spark, sf_dir):
    """IDF from document frequencies that were kept by batch."""
    return rounded(Frequencies(_summarised(spark, load_views(spark, sf_dir)["token_concepts"])).idf(ROLE))


def _after_removal(sql: str) -> str:
    """SQL over the documents whose number doesn't divide by five, without two concepts."""
    names = ", ".join(f"'{n}'" for n in DROPPED)
    left = f"""left_over AS (SELECT * FROM token_concepts WHERE doc_id % 5 <> 0 AND (concept IS NULL OR concept NOT IN ({names})))"""
    return with_views(f"""
, {left}, {_bags().replace("FROM token_concepts", "FROM left_over")}
{sql}""", "token_concepts")


def _reduced(spark, sf_dir) -> Frequencies:
    tokens = load_views(spark, sf_dir)["token_concepts"]
    ids = tokens.select("doc_id").filter(F.col("doc_id") % 5 != 0).distinct()
    return Frequencies(_summarised(spark, tokens)).remove_concepts(DROPPED).filter(ids)


@register("idf_after_removal", ids=("AG-21", "PF-09", "PF-10"),
          oracle=_after_removal(f"SELECT concept, doc_freq, {r('idf')} AS idf FROM idf"))
def idf_after_removal(spark, sf_dir):
    """What removed documents and concepts had added is taken off the kept sums."""
    return rounded(_reduced(spark, sf_dir).idf())


@register("concept_bags_after_removal", ids=("AG-20", "PF-09", "PF-10"),
          oracle=_after_removal(f"SELECT doc_id, concept, count, {r('tf')} AS tf FROM bags"))
def concept_bags_after_removal(spark, sf_dir):
    return rounded(_reduced(spark, sf_dir).concept_bags())


@register("idf_filter_after_removal", ids=("AG-22", "PF-09", "PF-10"),
          oracle=_after_removal(f"SELECT concept FROM idf WHERE idf >= {IDF_THRESHOLD}"))
def idf_filter_after_removal(spark, sf_dir):
    return _reduced(spark, sf_dir).idf_filter(IDF_THRESHOLD)
