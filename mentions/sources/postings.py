"""Postings: which texts name a concept or an entity (AG-04, AG-14, J-01, J-02, PF-05, PF-06).

An inverted index of a table: lower-cased name → texts, each once, sorted by
name and text, with Parquet Bloom filters on the name. A look-up of one name
reads the row groups that can hold it. Rows are dealt by ranges of (name,
text), so a name in most texts is spread over many files.

With the table itself bucketed by text (:mod:`mentions.sources.bucketed`), a
co-occurrence query moves the anchor's texts and nothing else of the table: its
shuffle is in proportion to the texts that match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.operators.common import TEXT_KEY

NAME = "name"


def write_postings(rows: DataFrame, column: str, path: str, files: int | None = None) -> DataFrame:
    """Write the postings of ``rows`` by ``column`` (``concept`` or ``entity_name``) and open them; NULL names have none.

    ``files`` is the number of ranges (by default Spark chooses, by size).
    """
    named = rows.filter(F.col(column).isNotNull()).select(F.lower(column).alias(NAME), *TEXT_KEY).distinct()
    by = [F.col(c) for c in (NAME, *TEXT_KEY)]
    (named.repartitionByRange(*([files] if files else []), *by).sortWithinPartitions(NAME, *TEXT_KEY)
     .write.option(f"parquet.bloom.filter.enabled#{NAME}", "true").parquet(path))
    return rows.sparkSession.read.schema(named.schema).parquet(path)


def texts_naming(postings: DataFrame, name: str) -> DataFrame:
    """The texts that name ``name`` in any case."""
    return postings.filter(F.col(NAME) == F.lower(F.lit(name))).select(*TEXT_KEY)
