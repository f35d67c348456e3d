"""Shared DataFrame building blocks used by every facade.

All functions are lazy DataFrame -> DataFrame transforms. The only place a
job is started eagerly is :func:`require_value`, the existence probe behind
the concept-type validation (``take(1)`` with the filter pushed down).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_KEY = ["doc_id", "text_order"]
RELATION_KEY = ["doc_id", "text_order", "relation_id"]


# ---------------------------------------------------------------- requests --

def as_name_list(names) -> list[str]:
    """Normalise a name argument the way the reference does.

    A single string is one name; lists and tuples keep their order and their
    duplicates; sets have no order, so they are sorted for a stable result.
    """
    if isinstance(names, str):
        return [names]
    if isinstance(names, (set, frozenset)):
        return sorted(names)
    return list(names)


def request_table(spark: SparkSession, names, key: str) -> DataFrame:
    """Requested names as a small ``(ord, <key>)`` table.

    Its size is the length of the caller's Python list, so it is bounded by
    what the driver already holds; joins against it may broadcast it.
    """
    if isinstance(names, DataFrame):
        if "ord" in names.columns:
            return names.select(F.col("ord").cast("int"), F.col(key).cast("string"))
        raise ValueError("a DataFrame of names needs an ord column, as rows of a DataFrame have no order")
    rows = [(i, n) for i, n in enumerate(as_name_list(names))]
    schema = T.StructType([T.StructField("ord", T.IntegerType(), False), T.StructField(key, T.StringType(), True)])
    return spark.createDataFrame(rows, schema)


def keep_names(df: DataFrame, column: str, names) -> DataFrame:
    """Keep rows whose ``column`` is one of ``names``.

    A Python list becomes an ``IN`` filter that reaches the parquet scan;
    a DataFrame of names becomes a left-semi join (Spark picks broadcast or
    shuffle from the measured size of that side).
    """
    if isinstance(names, DataFrame):
        # No distinct(): semi/anti joins ignore duplicates, and a plain
        # shuffle on both sides lets AQE split a hot name (skew join).
        return df.join(names.select(F.col(column)), column, "left_semi")
    return df.filter(F.col(column).isin(as_name_list(names)))


def drop_names(df: DataFrame, column: str, names) -> DataFrame:
    """Drop rows whose ``column`` is in ``names``; NULL keys stay (pandas rule)."""
    if isinstance(names, DataFrame):
        return df.join(names.select(F.col(column)), column, "left_anti")
    return df.filter(~F.coalesce(F.col(column).isin(as_name_list(names)), F.lit(False)))


# ---------------------------------------------------------------- filters --

def type_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Concept-type filter: equality, no-op for ``''``."""
    return df.filter(F.col(column) == value) if value else df


def type_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Entity-type filter: prefix match; ``''`` keeps every non-null type."""
    return df.filter(F.col(column).startswith(prefix))


def require_value(df: DataFrame, column: str, value: str) -> None:
    """Raise ValueError unless ``value`` is ``''`` or occurs in ``column``."""
    # take(1) reads partitions step by step and stops at the first match
    if value and not df.filter(F.col(column) == value).select(F.lit(1)).take(1):
        raise ValueError(f"no row has {column} = {value!r}")


def same_text(column: str, value: str) -> Column:
    """Case-insensitive name match."""
    return F.lower(F.col(column)) == F.lower(F.lit(value))


# ------------------------------------------------------------- ordering --

def check_n(n: int | None) -> None:
    if n is not None and n < 0:
        raise ValueError("n must be a non-negative int or None")


def top_k(df: DataFrame, metric: str, key: str, n: int | None, ascending: bool = False) -> DataFrame:
    """First ``n`` rows by ``metric`` (ties broken by ``key`` ascending).

    With ``n`` set this is ORDER BY ... LIMIT n, which Spark runs as a
    per-partition top-n followed by a merge of at most n rows per partition
    (TakeOrderedAndProject). With ``n=None`` the full result is
    range-sorted. The 1-based ``rank`` comes from :func:`ranked`.
    """
    check_n(n)
    metric_order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    order = [metric_order, F.col(key).asc_nulls_last()]
    if n is not None and n <= RANK_ROWS:
        limited = df.orderBy(*order).limit(n)
        return limited.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int")).orderBy("rank")
    numbered = ranked(df, order)
    return numbered if n is None else numbered.filter(F.col("rank") <= n)


#: Rows that one window numbers directly; longer results are numbered by range partition.
RANK_ROWS = 10_000


def ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Number the rows of ``df`` in ``order`` without one task that sees them all.

    Rows are range-partitioned; each partition numbers its own, and adds the
    sizes of the partitions before it (one row per partition). The ranges are
    computed once and stored, so both sides see the same partitions.
    """
    from mentions.session import scratch_dir

    path = scratch_dir(df.sparkSession, "ranked")
    own = Window.partitionBy("_part").orderBy(*order)
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    numbered = kept.withColumn("_at", F.row_number().over(own)).join(offsets, "_part")
    return numbered.withColumn("rank", (F.col("_before") + F.col("_at")).cast("int")).drop("_part", "_at", "_before").orderBy("rank")


def lookup(requests: DataFrame, found: DataFrame, key: str, fill: dict[str, object] | None = None) -> DataFrame:
    """Requested keys in request order, joined to their metrics.

    ``requests`` is ``(ord, key)``; every request row survives (duplicates
    too), missing metrics take the value in ``fill`` (or stay NULL).
    """
    joined = requests.join(found, key, "left")
    fill = fill or {}
    cols = [F.col("ord"), F.col(key)]
    for c in found.columns:
        if c == key:
            continue
        cols.append(F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c))
    return joined.select(*cols).orderBy("ord")


def share_of(df: DataFrame, metric: str, total: Column, alias: str = "share") -> DataFrame:
    """Replace ``metric`` by ``metric / total``; NULL when the total is 0.

    ``total`` is a scalar-subquery column (``DataFrame.scalar()``): Spark
    computes it once as its own small job and inlines the value, so there is
    no join with a one-row side.
    """
    cols = [F.try_divide(F.col(c).cast("double"), total.cast("double")).alias(alias) if c == metric else F.col(c)
            for c in df.columns]
    return df.select(*cols)


def sum_or_zero(column: str) -> Column:
    """SUM that yields 0 for an all-NULL group, as pandas does."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")



#: Rows that one salted join key of with_group_total should hold.
ROWS_PER_SALT = 1_000_000
#: Salts where the caller names no number: enough for groups of 64 million rows.
SALTS = 64


def salts_for(largest_group: int, rows_per_salt: int = ROWS_PER_SALT) -> int:
    """Salts that spread a group of ``largest_group`` rows into keys of about ``rows_per_salt``."""
    return max(1, -(-largest_group // rows_per_salt))


def largest_group(rows: DataFrame, group) -> int:
    """Rows of the largest group (a job: counts are combined map-side, and one row comes back)."""
    keys = [group] if isinstance(group, str) else list(group)
    top = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("n")).first()
    return top.n or 0


def with_group_total(rows: DataFrame, group, split, value, total: str, salts: int = SALTS) -> DataFrame:
    """Attach to every row the sum of ``value`` over its ``group``, skew-safe.

    A plain "aggregate, then join back on the group key" puts all rows of
    a hot group (say, one document holding a third of the data) into one
    join task, and AQE cannot split that join because one side is an
    aggregate. Here every row gets a salt from ``hash(split) mod salts``:
    partial sums per ``(group, salt)`` (at most ``salts`` rows per group)
    are totalled by a window over those few rows, and the join back runs on
    ``(group, salt)``, so a hot group is spread over ``salts`` tasks.

    ``split`` names the columns to salt by; together with the group they
    should tell rows apart, since equal rows get one salt. ``salts`` can be
    sized from the data with ``salts_for(largest_group(rows, group))``.
    """
    keys = [group] if isinstance(group, str) else list(group)
    split = [split] if isinstance(split, str) else list(split)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in split]), F.lit(salts)))
    value_col = value if isinstance(value, Column) else F.col(value)
    parts = salted.groupBy(*keys, "_salt").agg(F.sum(value_col).alias("_part"))
    totals = parts.select(*keys, "_salt", F.sum("_part").over(Window.partitionBy(*keys)).alias(total))
    return salted.join(totals, [*keys, "_salt"], "inner").drop("_salt")
