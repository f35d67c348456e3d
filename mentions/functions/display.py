"""Table-valued display helpers (PF-12, SF-08, SF-09).

The reference's chart functions are not rebuilt; these are their data steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.functions.labels import split_camel_case, type_label

# A short default list of English function words. Callers pass their own list
# for other languages; matching is case-insensitive.
DEFAULT_STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have", "he",
                     "her", "his", "i", "in", "is", "it", "its", "of", "on", "or", "she", "that", "the", "their",
                     "they", "this", "to", "was", "we", "were", "with", "you")


def stopword_table(spark: SparkSession, stopwords=None) -> DataFrame:
    words = sorted({w.lower() for w in (DEFAULT_STOPWORDS if stopwords is None else stopwords)})
    return spark.createDataFrame([(w,) for w in words], T.StructType([T.StructField("_word", T.StringType())]))


def remove_stopwords(freqs: DataFrame, stopwords=None, column: str = "concept") -> DataFrame:
    """PF-12: drop rows whose ``column`` is a stopword, ignoring case.

    The stopword list is the caller's Python list, so its broadcast is
    bounded by what the driver holds.
    """
    words = stopword_table(freqs.sparkSession, stopwords)
    keyed = freqs.withColumn("_word", F.lower(F.col(column)))
    return keyed.join(words, "_word", "left_anti").drop("_word")


def with_display_names(df: DataFrame, name_col: str = "concept", type_col: str | None = "concept_type",
                       default_type: str = "Concept") -> DataFrame:
    """Add ``display_name`` (camel case split) and ``type_label`` columns."""
    out = df.withColumn("display_name", split_camel_case(F.col(name_col)))
    if type_col is not None:
        out = out.withColumn("type_label", type_label(F.col(type_col), default_type))
    return out
