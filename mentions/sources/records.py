"""CSV records whose quoted values may hold line breaks, from files read in splits (SC-01).

A line break ends a record where an even number of quotes stands before it in
the file. So what a split does to the state "inside quotes" is a function of
two states that depends on the parity of its quotes alone, and functions
compose by adding parities: one number per split, summed over the splits
before it, gives the state in which each split begins.

Where every line of a file closes the quotes it opens, each line is a record
and nothing is shuffled; one scan, of quotes alone, finds the other files. In those:

1. Quotes are counted per split (combined map-side; one short row a split).
2. Lines are shuffled by (file, split). Inside a split, running counts say
   where records begin, and the lines of a record are joined again.
3. A record that goes on in the next split is open at the end of its own: its
   pieces, two a split at most, are put together by file. Step 2 after the
   shuffle runs for whole records and for pieces; the shuffle serves both.

Values are parsed by Spark's ``from_csv``. Quotes must be used as CSV writers
do (RFC 4180): a value that holds one is quoted and the quote doubled. Files
are UTF-8; lines end in ``\\n`` or ``\\r\\n``. A file that ends inside quotes
fails. Blank lines outside quotes are no records. Compressed files are one
split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, at, line, quotes``: every line, numbered in order inside its split."""
    quotes = F.length("value") - F.length(F.translate("value", QUOTE, ""))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"), quotes.alias("quotes"))


def split_states(lines: DataFrame) -> DataFrame:
    """``file, split, inside``: 1 where the split begins inside quotes, else 0."""
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    return counts.select("file", "split", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside"))


def _text(lines: str) -> Column:
    """Lines collected with their order, as one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(lines)), lambda x: x["line"]), "\n")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record, header``: the text of every record, and whether it is the first of its file."""
    lines = _lines(spark, path)
    # files, by name, in which a record may go on after its first line; in all others every line is a record of its own
    cut_files = [r.file for r in lines.where(F.col("quotes") % 2 == 1).select("file").distinct().collect()]
    if not cut_files:
        return _plain(_line_records(lines))
    if len(cut_files) == len(lines.inputFiles()):
        return _plain(_joined_records(lines))
    cut = F.col("file").isin(cut_files)
    return _plain(_line_records(lines.where(~cut)).unionByName(_joined_records(lines.where(cut))))


def _plain(records: DataFrame) -> DataFrame:
    """Without carriage returns at the end, and without blank records."""
    plain = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.select(plain.alias("record"), "header").where(F.trim("record") != "")


def _line_records(lines: DataFrame) -> DataFrame:
    """Records of files in which quotes are closed in every line: no shuffle of the lines."""
    heads = lines.where(F.col("split") == 0).groupBy("file").agg(F.min("at").alias("at")).withColumn("header", F.lit(True))
    found = lines.join(F.broadcast(heads), ["file", "at"], "left")  # one short row a file
    return found.select(F.col("line").alias("record"), F.coalesce("header", F.lit(False)).alias("header"))


def _joined_records(lines: DataFrame) -> DataFrame:
    order = Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = lines.join(split_states(lines), ["file", "split"]).withColumn("begins", ((before + F.col("inside")) % 2 == 0).cast("int"))
    found = found.withColumn("number", F.sum("begins").over(so_far)).withColumn("part", F.struct("at", "line"))
    # number 0: the end of a record that began in an earlier split
    pieces = found.groupBy("file", "split", "number").agg(_text("part").alias("line"), F.sum("quotes").alias("quotes"))
    cut = (F.col("number") == 0) | (F.col("quotes") % 2 == 1)
    first = (F.col("split") == 0) & (F.col("number") == 1)
    whole = pieces.where(~cut).select(F.col("line").alias("record"), first.alias("header"))
    start = F.sum((F.col("number") > 0).cast("int")).over(Window.partitionBy("file").orderBy("split", "number"))
    edges = pieces.where(cut).withColumn("start", start).withColumn("part", F.struct("split", "number", "line"))
    edges = edges.groupBy("file", "start").agg(_text("part").alias("record"), F.max(first).alias("header"), F.sum("quotes").alias("quotes"))
    closed = F.when(F.col("quotes") % 2 == 0, F.col("record")).otherwise(
        F.raise_error(F.concat(F.lit("quotes are not closed in "), F.col("file"))).cast("string"))
    return whole.unionByName(edges.select(closed.alias("record"), "header"))


def read_quoted_csv(spark: SparkSession, path: str, names: list[str], wanted: list[str]) -> DataFrame:
    """The columns ``wanted``, as text, of CSV files with the header ``names``; another header fails the query."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"escape": QUOTE, "multiLine": "true", "mode": "FAILFAST"}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
    rows = csv_records(spark, path).select("header", F.from_csv("record", ddl, options).alias("v"))
    same = F.lit(True)
    for n in wanted:
        same = same & F.coalesce(F.lower(F.col("v").getField(n)) == n.lower(), F.lit(False))
    checked = F.when(same, F.lit(False)).otherwise(F.raise_error(F.lit(f"a file in {path} has another header")).cast("boolean"))
    rows = rows.where(F.when(F.col("header"), checked).otherwise(F.lit(True)))
    return rows.select(*[F.col("v").getField(n).alias(n) for n in wanted])
