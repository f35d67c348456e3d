"""Operator 11, an audit of how far the sources of a language diverge, by three-dimensional cube partitioning.

A *group* is an occurring (lang, source). Terms are the runs of letters of the
texts (bytes other than ASCII count as letters), A-Z lower-cased. A language
keeps the terms of at least ``MIN_DOCS`` of its documents. Group and language
give each kept term the share ``1 + floor(1e9 (count + 5) / (N + 5 V))``, in
whole numbers throughout.

1. *Counts.* Tasks count terms by group, in counters of bounded size; one
   shuffle by (lang, term) sums them, and also gives a term's documents and
   count in the language, so rare terms go before anything is stored.
2. *Cube.* A language's groups are dealt into blocks of about ``GROUP_BLOCK``,
   its terms into blocks of about ``TERM_BLOCK``. A cell is (group block x,
   group block y >= x, term block). The slice of a group block in a term block
   is sent to each cell that it takes part in. A cell holds two slices as one
   dense matrix, of bounded size whatever the corpus, and adds up ``|p - q|``
   of each pair of groups over its terms.
3. *Reduction along the term axis.* Partial sums of a pair are added. A slice
   names only terms that a group has; the pair's difference over the terms
   that neither has is ``V`` times that of a count of 0, less the terms seen,
   and the language's first term block accounts for it, so that pairs without
   any term come out too.

Terms over-represented in a group are ranked by a window that keeps the first
``TOP_TERMS`` of a group in each partition before the shuffle.

A hot group is no hot task: its counts are reduced in the tasks that read it,
its terms are dealt over all term blocks, and its pairs over all group blocks.

Edge cases: null text, lang and source are ''. Each row of the table is a
document, rows that share an id too. A group without terms takes part with
counts of 0. A language without kept terms has divergences of 0. Ties are in
the order of items as UTF-8 bytes. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentions.llm.common import batches, stored

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
GROUP_BLOCK = 128
TERM_BLOCK = 4096
BATCH_BYTES = 4 << 20
#: Entries of a task's counters before it sends them on.
HELD_TERMS = 400_000

#: Bytes that are no part of a term become blanks; A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def grouped_texts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def term_counts(texts: DataFrame, held: int = HELD_TERMS) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, reduced per task (a term may come several times)."""
    def run(source):
        counters: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows():
            parts: list[list] = [[], [], [], [], []]
            for (lang, name), (n, docs) in counters.items():
                terms = list(n)
                parts[0] += [lang] * len(terms)
                parts[1] += [name] * len(terms)
                parts[2] += terms
                parts[3] += n.values()
                parts[4] += map(docs.__getitem__, terms)
            counters.clear()
            kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(p, k) for p, k in zip(parts, kinds, strict=True)]
            arrays[2] = arrays[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

        size = 0
        for batch in batches(source, BATCH_BYTES):
            for lang, name, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(),
                                        batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                n, docs = counters.get((lang, name)) or counters.setdefault((lang, name), (Counter(), Counter()))
                size -= len(n)
                words = text.translate(TERM_BYTES).split()
                n.update(words)
                docs.update(set(words))
                size += len(n)
                if size > held:
                    yield rows()
                    size = 0
        if counters:
            yield rows()

    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_counts(texts: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: counts of kept terms, the language's count, and a mark on one row of each term."""
    term = Window.partitionBy("lang", "term")
    # the partitioning by (lang, term) serves the grouping and the window as well
    sums = term_counts(texts).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("df"),
                       (F.col("source") == F.min("source").over(term)).alias("first")).where(F.col("df") >= min_docs).drop("df")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING terms))`` by long division in base 1000; 0 without terms.

    Nothing overflows while the divisor is below 9e15.
    """
    divisor = total + SMOOTHING * terms
    whole, rest = F.lit(0).cast("long"), count + SMOOTHING
    for step in (1, 1000, 1000, 1000):
        rest = rest * step
        whole, rest = whole * step + F.call_function("div", rest, divisor), F.pmod(rest, divisor)
    return F.when(terms > 0, 1 + whole).otherwise(F.lit(0)).cast("long")


def group_totals(texts: DataFrame, kept: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """One row per group: its total, the language's total and number of terms, and how both are dealt into blocks."""
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.when(F.col("first"), 1)).alias("terms"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct()
    sizes = groups.groupBy("lang").agg(F.count("*").alias("groups"))
    none = F.lit(0).cast("long")
    found = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
    blocks = F.ceil(F.col("groups") / group_block).cast("int")
    return found.select(
        "lang", "source", F.coalesce("total", none).alias("total"), F.coalesce("lang_total", none).alias("lang_total"),
        F.coalesce("terms", none).alias("terms"), blocks.alias("blocks"),
        F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"),
        F.greatest(F.ceil(F.coalesce("terms", none) / term_block), F.lit(1)).cast("int").alias("term_blocks"))


def cell_rows(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """The slices, replicated to the cells that they take part in; a null term stands for a count of 0."""
    terms = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "terms", "blocks", "block",
        F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("part"))
    zeros = groups.select("lang", "source", F.lit(None).cast("string").alias("term"),
                          share(F.lit(0).cast("long"), F.col("total"), F.col("terms")).alias("p"), "terms", "blocks", "block",
                          F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("part"))
    rows = terms.unionByName(zeros).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("lang", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "part", "block",
                       "source", "term", "p", "terms")


def cell_divergences(cell: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of ``|p - q|`` of the pairs of groups of one cell."""
    x, y, part, lang = (cell[c].iloc[0] for c in ("x", "y", "part", "lang"))
    alone = cell["term"].isna()
    groups = cell[alone].sort_values("source")
    seen = cell[~alone]
    names, zero = groups["source"].to_numpy(), groups["p"].to_numpy()
    column, words = pd.factorize(seen["term"])
    shares = np.repeat(zero[:, None], len(words), axis=1)
    shares[pd.Index(names).get_indexer(seen["source"]), column] = seen["p"].to_numpy()
    # terms that no group of the cell has: all of the language's are counted in its first block, those seen are taken off here
    unseen = (int(groups["terms"].iloc[0]) if part == 0 else 0) - len(words)
    block = groups["block"].to_numpy()
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    out = []
    for i in left:
        j = right[right > i] if x == y else right
        out.append((np.full(len(j), i), j, np.abs(shares[j] - shares[i]).sum(axis=1) + unseen * np.abs(zero[j] - zero[i])))
    i, j, value = map(np.concatenate, zip(*out, strict=True)) if out else (np.empty(0, int),) * 3
    return pd.DataFrame({"lang": lang, "a": names[i], "b": names[j], "value": value.astype(np.int64)})


def pair_divergences(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: both directions of every pair of groups of a language."""
    parts = cell_rows(counts, groups).groupBy("lang", "x", "y", "part").applyInPandas(
        cell_divergences, "lang string, a string, b string, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", F.explode(both).alias("p"), "value").select("lang", "p.source", "p.item", "value")


def telling_terms(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: terms that a group uses more than its language."""
    known = counts.join(groups, ["lang", "source"])
    own = share(F.col("n"), F.col("total"), F.col("terms"))
    whole = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return known.where(F.col("n") > 0).select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value")).where("value > 0")


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK,
                     term_block: int = TERM_BLOCK, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its distance to the others (``pair``) and the terms
    that set it off from its language most (``term``)."""
    texts = grouped_texts(docs, text_col, lang_col, source_col)
    counts = stored(kept_counts(texts, min_docs), "divergence-counts")
    groups = stored(group_totals(texts, counts, group_block, term_block), "divergence-groups")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_divergences(counts, groups).withColumn("rank", rank)
    terms = telling_terms(counts, groups).withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return (pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")))
