"""Category and document-sentiment catalogue (AG-08 … AG-10, AG-25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.errors import NoRelevantData
from mentions.functions.labels import category_label
from mentions.operators import common as C


def category_profile(categories: DataFrame) -> DataFrame:
    """AG-08: mean probability per category, highest first.

    Columns ``category, probability``; a distributed range sort, no rank
    column (the number of categories is not assumed to be small).
    """
    means = (categories.filter(F.col("category").isNotNull())
             .groupBy("category").agg(F.avg("probability").alias("probability")))
    return means.orderBy(F.col("probability").desc_nulls_last(), F.col("category").asc())


def main_category(categories: DataFrame) -> DataFrame:
    """AG-09: the category with the highest mean probability (one row, or none)."""
    means = (categories.filter(F.col("category").isNotNull())
             .groupBy("category").agg(F.avg("probability").alias("probability")))
    return C.top_k(means, "probability", "category", 1).select("category")


def category_pie(categories: DataFrame, category_count: int = 6) -> DataFrame:
    """AG-25: the first ``category_count`` categories plus an "Other" slice.

    "Other" is the sum of the mean probabilities of every remaining category
    (0 when there is none) and is always present. Slices come in the
    reference's display order, reversed: ``slice`` 0 is "Other", then the
    k-th category up to the first. Labels are capitalised with the fixed
    renames (see :mod:`mentions.functions.labels`).

    The top k rows are a bounded top-n; the rest is summed by a left-anti
    join against those k names (a broadcast of k rows), so no window or
    single-partition step touches the whole category list.
    """
    C.check_n(category_count)
    means = (categories.filter(F.col("category").isNotNull())
             .groupBy("category").agg(F.avg("probability").alias("probability")))
    top = C.top_k(means, "probability", "category", category_count)
    rest = means.join(top.select("category"), "category", "left_anti")
    other = rest.agg(F.coalesce(F.sum("probability"), F.lit(0.0)).alias("probability"))
    slices = top.select(F.col("rank"), F.col("category").alias("label"), "probability").unionByName(
        other.select(F.lit(category_count + 1).alias("rank"), F.lit("other").alias("label"), "probability"))
    return (slices.select((F.lit(category_count + 1) - F.col("rank")).cast("int").alias("slice"),
                          category_label(F.col("label")).alias("label"), "probability")
            .orderBy("slice"))


def average_sentiment(sentiments: DataFrame) -> DataFrame:
    """AG-10: mean document sentiment, one row ``average_sentiment`` (NULL if empty)."""
    return sentiments.agg(F.avg("sentiment_value").alias("average_sentiment"))


class Categories:
    def __init__(self, categories: DataFrame | None):
        self._categories = categories

    def _need(self) -> DataFrame:
        if self._categories is None:
            raise NoRelevantData("no table categories")
        return self._categories

    def categories(self):
        return category_profile(self._need())

    def main_category(self) -> str | None:
        row = main_category(self._need()).first()
        return None if row is None else row[0]

    def pie(self, category_count=6):
        return category_pie(self._need(), category_count)


class Sentiments:
    def __init__(self, sentiments: DataFrame | None):
        self._sentiments = sentiments

    def _need(self) -> DataFrame:
        if self._sentiments is None:
            raise NoRelevantData("no table sentiments")
        return self._sentiments

    def average_sentiment(self) -> float | None:
        return average_sentiment(self._need()).first()[0]
