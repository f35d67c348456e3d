"""Nested analysis JSON -> the ten flat tables (FL-01 … FL-16).

An analysis row (schema :data:`mentions.schemas.ANALYSIS`) holds, per
analysis call, a list with one element per text. Flattening is a set of
``posexplode``/``explode`` projections of the same input - narrow
transformations, no shuffle - of analyses that one ordered step has stored
with their document ids (:func:`stage_analyses`).

Addressing (FL-03): in multi-document mode text ``i`` of an analysis is
document ``base + i``, text_order 0; in single-document mode it is document
``base``, text_order ``i``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.schemas import ANALYSIS, conform
from mentions.session import DROP_SHUFFLES
from mentions.session import settings as _settings

CALLS_IN_ORDER = ("categories", "concepts", "sentiment", "absa")
_LEAF_OF_CALL = {"categories": lambda: F.transform("categories", lambda t: t.getField("probability")),
                 "concepts": lambda: F.transform("concepts", lambda t: t.getField("freq")),
                 "sentiment": lambda: F.col("sentiment.sentiment_value"),
                 "absa": lambda: F.col("absa.normalized_text")}


def analysis_length(single: Column | None = None) -> Column:
    """Documents one analysis consumes (D25).

    1 in single-document mode and for an analysis without any call; else
    the length of the last present call in the order categories, concepts,
    sentiment, absa. A present but empty list consumes 0.
    """
    single = F.coalesce(F.col("single_document"), F.lit(False)) if single is None else single
    # Each size reads one small leaf of its call (nested schema pruning), not the whole nested column.
    sizes = [F.when(F.col(c).isNotNull(), F.size(_LEAF_OF_CALL[c]())) for c in reversed(CALLS_IN_ORDER)]
    return F.when(single, F.lit(1)).otherwise(F.coalesce(*sizes, F.lit(1))).cast("long")


# Bucket levels of assign_doc_ids: a level-1 bucket is seq >> LOW_BITS (at
# most 2**LOW_BITS rows, seq being unique), a level-2 bucket is
# seq >> HIGH_BITS (at most 2**(64 - HIGH_BITS) of them for a 64-bit seq).
LOW_BITS = 22
HIGH_BITS = 44


def _exclusive_sum(value: str, order: str, partition: str | None = None) -> Column:
    w = Window.orderBy(order) if partition is None else Window.partitionBy(partition).orderBy(order)
    return F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def assign_doc_ids(analyses: DataFrame, seq: str = "seq") -> DataFrame:
    """FL-02: ``(seq, doc_base)`` with ``doc_base`` = documents used by earlier analyses.

    An exclusive running sum in ``seq`` order over the thin ``(seq, len)``
    projection, built from three windows whose inputs all have proven size
    bounds (``seq`` is a unique 64-bit integer):

    * level-2 totals (``seq >> 44``: at most 2**20 rows) get their offsets
      from one window over all of them;
    * level-1 totals (``seq >> 22``: at most 2**22 per level-2 bucket) get
      theirs from a window per level-2 bucket plus its offset;
    * rows (at most 2**22 per level-1 bucket) get theirs from a window per
      level-1 bucket plus the bucket offset (a join on the bucket number).

    No step needs the whole input in one task, nothing is collected to the
    driver, and the result is deterministic. The thin rows, which the windows
    and the join all read, are stored first (an eager step), so the analyses
    are computed once.
    """
    from mentions.session import scratch_dir

    spark, path = analyses.sparkSession, scratch_dir(analyses.sparkSession, "lengths")
    analyses.select(F.col(seq).cast("long").alias("seq"), analysis_length().alias("_len")).write.parquet(path)
    return _running_ids(spark.read.schema("seq long, _len long").parquet(path)).select("seq", "doc_base")


def _running_ids(thin: DataFrame) -> DataFrame:
    """:func:`assign_doc_ids` of rows ``seq, _len``."""
    thin = thin.select("seq", "_len", F.shiftright("seq", LOW_BITS).alias("_b1"), F.shiftright("seq", HIGH_BITS).alias("_b2"))
    level1 = thin.groupBy("_b2", "_b1").agg(F.sum("_len").alias("_s1"))
    level2 = level1.groupBy("_b2").agg(F.sum("_s1").alias("_s2"))
    off2 = level2.select("_b2", _exclusive_sum("_s2", "_b2").alias("_o2"))
    off1 = (level1.join(off2, "_b2", "inner")
            .select("_b1", (F.col("_o2") + _exclusive_sum("_s1", "_b1", "_b2")).alias("_o1")))
    return (thin.join(off1, "_b1", "inner")
            .select("seq", (F.col("_o1") + _exclusive_sum("_len", "seq", "_b1")).cast("long").alias("doc_base")))


def with_doc_base(analyses: DataFrame) -> DataFrame:
    """Attach ``doc_base`` to every analysis row (join on ``seq``)."""
    return analyses.join(assign_doc_ids(analyses), "seq", "inner")


def _span(c: Column) -> Column:
    return F.array_join(c.cast("array<string>"), "-")


def _carry(df: DataFrame) -> list[str]:
    """Columns each exploded row keeps until it is addressed in :func:`_finish`."""
    base = "doc_base" if "doc_base" in df.columns else "seq"
    return [base, "single_document"]


def _texts(df: DataFrame, call: str) -> DataFrame:
    """One row per text of ``call``: carried columns, ``_pos`` and ``item``."""
    return df.select(*_carry(df), F.posexplode(call).alias("_pos", "item"))


def _finish(rows: DataFrame, name: str, bases: DataFrame | None) -> DataFrame:
    """Give exploded rows their ``doc_id``/``text_order`` and the table schema (FL-03).

    Without ``doc_base`` on the rows, the analysis bases are joined on
    ``seq`` here, after exploding: only the narrow output rows of this one
    table are shuffled, never the whole nested analyses.
    """
    if "doc_base" not in rows.columns:
        rows = rows.join(bases, "seq", "inner")
    single = F.coalesce(F.col("single_document"), F.lit(False))
    pos = F.col("_pos")
    doc_id = F.when(single, F.col("doc_base")).otherwise(F.col("doc_base") + pos).cast("long")
    text_order = F.when(single, pos).otherwise(F.lit(0)).cast("int")
    return conform(rows.withColumn("doc_id", doc_id).withColumn("text_order", text_order), name)


def _keys(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in ("doc_base", "seq", "single_document", "_pos")]


def flatten_categories(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-04: ``categories`` rows (label -> category)."""
    t = _texts(df, "categories")
    c = t.select(*_keys(t), F.explode("item").alias("c"))
    return _finish(c.select(*_keys(c), F.col("c.label").alias("category"),
                            F.col("c.probability").alias("probability")), "categories", bases)


def _concepts(df: DataFrame) -> DataFrame:
    t = _texts(df, "concepts")
    return t.select(*_keys(t), F.explode("item").alias("c"))


def flatten_concepts(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-05: ``concepts`` rows; a NULL text has no rows, missing fields are NULL."""
    c = _concepts(df)
    return _finish(c.select(*_keys(c), F.col("c.concept").alias("concept"), F.col("c.freq").alias("freq"),
                            F.col("c.relevance_score").alias("relevance_score"),
                            F.col("c.type").alias("concept_type")), "concepts", bases)


def flatten_concept_surface_strings(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-06: one row per surface occurrence of a concept."""
    c = _concepts(df)
    s = c.select(*_keys(c), F.col("c.concept").alias("concept"), F.explode("c.surface").alias("s"))
    return _finish(s.select(*_keys(s), "concept", F.col("s.surface_string").alias("surface_string"),
                            _span(F.col("s.span")).alias("text_span")), "concepts_surface_strings", bases)


def flatten_sentiments(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-07: one row per text."""
    t = _texts(df, "sentiment")
    return _finish(t.select(*_keys(t), F.col("item.sentiment_value").alias("sentiment_value")), "sentiments", bases)


def flatten_absa_entities(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-08: entity x semantics product."""
    t = _texts(df, "absa")
    e = t.select(*_keys(t), F.explode("item.entities").alias("e"))
    s = e.select(*_keys(e), "e.surface", F.explode("e.semantics").alias("sem"))
    return _finish(s.select(*_keys(s), F.col("sem.value").alias("entity_name"), F.col("sem.type").alias("entity_type"),
                            F.col("surface.surface_string").alias("surface_string"),
                            _span(F.col("surface.span")).alias("text_span")), "absa_entities", bases)


def flatten_absa_normalized_texts(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-09: one row per text."""
    t = _texts(df, "absa")
    return _finish(t.select(*_keys(t), F.col("item.normalized_text").alias("normalized_text")),
                   "absa_normalized_texts", bases)


def _relations(df: DataFrame) -> DataFrame:
    t = _texts(df, "absa")
    return t.select(*_keys(t), F.posexplode("item.relations").alias("relation_id", "r"))


def flatten_absa_relations(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-10: position in the list = relation_id."""
    r = _relations(df)
    return _finish(r.select(*_keys(r), "relation_id",
                            F.col("r.semantics.opinion_holder").alias("opinion_holder"),
                            F.col("r.semantics.restriction").alias("restriction"),
                            F.col("r.semantics.sentiment_value").alias("sentiment_value"),
                            F.col("r.external_entity").alias("is_external"),
                            F.col("r.surface.surface_string").alias("surface_string"),
                            _span(F.col("r.surface.span")).alias("text_span")), "absa_relations", bases)


def flatten_absa_relations_entities(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-11: one row per entity of a relation."""
    r = _relations(df)
    e = r.select(*_keys(r), "relation_id", F.explode("r.semantics.entity").alias("e"))
    return _finish(e.select(*_keys(e), "relation_id", F.col("e.type").alias("entity_type"),
                            F.col("e.value").alias("entity_name")), "absa_relations_entities", bases)


def _evaluations(df: DataFrame) -> DataFrame:
    t = _texts(df, "absa")
    return t.select(*_keys(t), F.posexplode("item.evaluations").alias("evaluation_id", "v"))


def flatten_absa_evaluations(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-12: position in the list = evaluation_id."""
    v = _evaluations(df)
    return _finish(v.select(*_keys(v), "evaluation_id",
                            F.col("v.semantics.sentiment_value").alias("sentiment_value"),
                            F.col("v.surface.surface_string").alias("surface_string"),
                            _span(F.col("v.surface.span")).alias("text_span")), "absa_evaluations", bases)


def flatten_absa_evaluations_entities(df: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """FL-13: one row per entity of an evaluation."""
    v = _evaluations(df)
    e = v.select(*_keys(v), "evaluation_id", F.explode("v.semantics.entity").alias("e"))
    return _finish(e.select(*_keys(e), "evaluation_id", F.col("e.type").alias("entity_type"),
                            F.col("e.value").alias("entity_name")), "absa_evaluations_entities", bases)


FLATTENERS = {
    "categories": flatten_categories,
    "concepts": flatten_concepts,
    "concepts_surface_strings": flatten_concept_surface_strings,
    "sentiments": flatten_sentiments,
    "absa_entities": flatten_absa_entities,
    "absa_normalized_texts": flatten_absa_normalized_texts,
    "absa_relations": flatten_absa_relations,
    "absa_relations_entities": flatten_absa_relations_entities,
    "absa_evaluations": flatten_absa_evaluations,
    "absa_evaluations_entities": flatten_absa_evaluations_entities,
}

_CALL_OF = {"categories": "categories", "concepts": "concepts", "concepts_surface_strings": "concepts",
            "sentiments": "sentiment"}


def complete_analyses(analyses: DataFrame) -> DataFrame:
    """Add the missing call columns as NULL (absent calls)."""
    for field in ANALYSIS.fields:
        if field.name not in analyses.columns:
            analyses = analyses.withColumn(field.name, F.lit(None).cast(field.dataType))
    return analyses


#: Ranges of ``seq`` that staged analyses are cut into, at most; their offsets are one number each.
MAX_PARTS = 16_384
#: Settings of the staging's writes, and of tables written from rows staged in place: a task has one slot, so one file, and needs no sort by bucket; rows of a
#: bucket need not move to meet those of the same slot and place. Shuffle files go with the write that made them.
_IN_PLACE = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.requireAllClusterKeysForCoPartition": "false", **DROP_SHUFFLES}
#: Nested rows are on disk twice until they have their ids, and are read by column: they are packed tighter than by default.
_CODEC = "zstd"
_HAS = {c: f"_has_{c}" for c in CALLS_IN_ORDER}
_STAGED = T.StructType([*ANALYSIS.fields, T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])


@dataclass(frozen=True)
class Staged:
    """Checked analyses, stored by ranges of ``seq``, and what is known of them.

    ``rows`` has, beside the analyses, the range ``_part`` of each and
    ``_before``, the documents of earlier analyses of its range. With the
    documents of earlier ranges, one number per range, that gives its first
    document id, so no table needs a join or a shuffle.
    """

    rows: DataFrame
    offsets: tuple[int, ...]  # by range: documents of the ranges before it
    calls: tuple[str, ...]
    used: int  # document ids that the analyses take up

    def analyses(self, first_id: int = 0) -> DataFrame:
        """The analyses with ``doc_base``, counted from ``first_id``."""
        starts = F.lit(np.array(self.offsets or (0,), np.int64))
        return self.rows.withColumn("doc_base", F.element_at(starts, F.col("_part") + 1) + F.col("_before") + F.lit(first_id).cast("long"))

    def tables(self, first_id: int = 0) -> dict[str, DataFrame]:
        """The tables of the calls that occur."""
        rows = self.analyses(first_id)
        return {name: fn(rows) for name, fn in FLATTENERS.items() if _CALL_OF.get(name, "absa") in self.calls}


def _range_of(seq: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are not above ``seq``, by a search in two steps."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [np.array(cuts[i:i + width], np.int64) for i in range(0, len(cuts), width)]

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda x: x <= seq))

    group = reached(F.lit(np.array([g[0] for g in groups], np.int64)))
    inner = F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(group, F.lit(1)))
    return F.when(group > 0, (group - 1) * width + reached(inner)).otherwise(F.lit(0)).cast("int")


def _places(stored: DataFrame, cuts: list[int], *more: str) -> DataFrame:
    """``_slot, _at, _part, _before, _again`` of the stored rows, and the columns ``more``: thin rows, worked out by range."""
    order = Window.partitionBy("_part").orderBy("seq")
    thin = stored.select("seq", "_slot", "_at", "_len", *[c for c in more if c not in ("seq", "_len")], _range_of(F.col("seq"), cuts).alias("_part"))
    return thin.select(
        "_slot", "_at", "_part", *more,
        F.coalesce(F.sum("_len").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.coalesce(F.lag("seq").over(order) == F.col("seq"), F.lit(False)).alias("_again"))


def _with_places(stored: DataFrame, buckets: int, cuts: list[int]) -> DataFrame:
    """The stored rows with ``_part``, ``_before`` and ``_again``; under ``_IN_PLACE`` only thin rows move."""
    return stored.join(_places(stored, cuts).repartition(buckets, "_slot").hint("shuffle_hash"), ["_slot", "_at"])


@contextmanager
def _dealt(frames: list[DataFrame], root: str, buckets: int | None = None) -> Iterator[tuple[DataFrame, int, list[int]]]:
    """The analyses, computed once and stored as they come, with the number of buckets (without one, that of the ranges) and
    the cuts of ``seq``; they are removed at the end of the block."""
    from mentions.session import delete_folder

    if any("seq" not in frame.columns for frame in frames):
        raise ValueError("analyses need a column seq, the input order")
    spark = frames[0].sparkSession
    dealt, table = f"{root}/dealt", f"staged_{uuid.uuid4().hex}"
    parts = min(MAX_PARTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = buckets or parts
    try:
        for k, frame in enumerate(frames):
            rows = complete_analyses(frame).select([F.col("seq").cast("long").alias("seq") if f.name == "seq" else F.col(f.name) for f in ANALYSIS.fields])
            rows = rows.withColumns({"_slot": F.spark_partition_id() * len(frames) + k, "_at": F.monotonically_increasing_id(), "_len": analysis_length(),
                                     **{has: F.col(c).isNotNull() for c, has in _HAS.items()}})
            with _settings(spark, _IN_PLACE):
                rows.write.mode("append").bucketBy(buckets, "_slot").options(path=dealt, compression=_CODEC).format("parquet").saveAsTable(table)
        stored = spark.table(table)
        probe = [F.percentile_approx("seq", [k / parts for k in range(1, parts)], 16 * parts).alias("cuts")]
        seen = stored.agg(F.count(F.lit(1)).alias("n"), F.count("seq").alias("seqs"), *probe).first()
        if seen.n != seen.seqs:
            raise ValueError(f"{seen.n - seen.seqs} analyses without seq")
        yield stored, buckets, sorted(set(seen.cuts or []))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, dealt)


def _by_range(rows: DataFrame) -> DataFrame:
    """One row for each range: its documents, calls, and a ``seq`` that occurs twice."""
    return rows.groupBy("_part").agg(
        F.sum("_len").alias("documents"), F.min(F.when(F.col("_again"), F.col("seq"))).alias("twice"),
        *[F.max(has).alias(has) for has in _HAS.values()])


def _staged(rows: DataFrame, by_range: DataFrame) -> Staged:
    parts = {r["_part"]: r for r in by_range.collect()}  # at most MAX_PARTS rows
    twice = [r.twice for r in parts.values() if r.twice is not None]
    if twice:
        raise ValueError(f"seq {min(twice)} occurs more than once")
    lengths = [parts[k].documents if k in parts else 0 for k in range(max(parts, default=-1) + 1)]
    offsets = tuple(accumulate(lengths, initial=0))
    calls = tuple(c for c, has in _HAS.items() if any(r[has] for r in parts.values()))
    return Staged(rows, offsets[:-1], calls, offsets[-1])


def stage_analyses(analyses: DataFrame | Sequence[DataFrame], path: str | None = None) -> Staged:
    """FL-01/FL-02: check the analyses and hand out their document ids (an eager step).

    The analyses are computed once and stored as they come, with the task
    (``_slot``) and place of each row. Ids are worked out on thin rows: cuts
    deal them evenly into ranges of ``seq``, and a window gives the running sum
    of documents inside each range; which cuts are found changes no id. The
    stored rows are bucketed by slot, so thin rows are brought to them, they
    are neither shuffled nor sorted, and are stored again with their sums.
    Checks and offsets come from one aggregate per range. All ten tables then
    read only the columns they need, without a shuffle.

    Analyses may come as several frames: each is computed and stored by itself,
    so the disk holds the shuffle files of one frame at a time.

    Raises ValueError if ``seq`` is missing, NULL or repeated, as the order of
    analyses, and so their ids, would be undefined. The rows are stored at
    ``path`` (see :func:`open_staged`), or below the checkpoint folder.
    """
    from mentions.session import scratch_dir

    frames = [analyses] if isinstance(analyses, DataFrame) else list(analyses)
    spark = frames[0].sparkSession
    root = path or scratch_dir(spark, "analyses")
    with _dealt(frames, root) as (stored, buckets, cuts):
        staged = _with_places(stored, buckets, cuts)
        with _settings(spark, _IN_PLACE):
            staged.drop("_slot", "_at").write.parquet(f"{root}/rows", compression=_CODEC)
    _by_range(spark.read.parquet(f"{root}/rows")).coalesce(1).write.parquet(f"{root}/parts")
    return open_staged(spark, root)


@contextmanager
def staged_in_place(analyses: DataFrame) -> Iterator[Staged]:
    """:func:`stage_analyses` for a block that writes the tables at once: the analyses are stored once only.

    The thin rows with the running sums are stored beside them, bucketed by
    slot too, and each table that is written brings the two together bucket by
    bucket, without a shuffle. That costs less than to store all nested rows
    again. The stored rows are removed at the end of the block.
    """
    from mentions.session import delete_folder, scratch_dir

    spark, table = analyses.sparkSession, f"places_{uuid.uuid4().hex}"
    root = scratch_dir(spark, "analyses")
    # each table has a task for each bucket, also for those without rows
    buckets = min(MAX_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        with _dealt([analyses], root, buckets) as (stored, _, cuts), _settings(spark, _IN_PLACE):
            thin = _places(stored, cuts, "seq", "_len", *_HAS.values()).repartition(buckets, "_slot")
            thin.write.bucketBy(buckets, "_slot").options(path=f"{root}/places", compression=_CODEC).format("parquet").saveAsTable(table)
            places = spark.table(table)
            rows = stored.join(places.select("_slot", "_at", "_part", "_before").hint("shuffle_hash"), ["_slot", "_at"])
            yield _staged(rows.select([f.name for f in _STAGED.fields]), _by_range(places))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, root)


def open_staged(spark: SparkSession, path: str) -> Staged:
    """Analyses that :func:`stage_analyses` has stored at ``path``."""
    return _staged(spark.read.schema(_STAGED).parquet(f"{path}/rows"), spark.read.parquet(f"{path}/parts"))


def flatten_analyses(analyses: DataFrame, bases: DataFrame | None = None) -> dict[str, DataFrame]:
    """FL-01/FL-14/FL-15: all ten tables from a DataFrame of analyses.

    ``analyses`` needs ``seq`` (input order) and any subset of the call
    columns; missing call columns count as absent calls. Each table explodes
    only the nested fields it needs. Without ``bases`` the analyses are staged
    and checked first (:func:`stage_analyses`, an eager step); with them, the
    thin ``(seq, doc_base)`` table is joined and nothing is run.
    """
    if bases is None:
        analyses = stage_analyses(analyses).analyses()
    analyses = complete_analyses(analyses)
    return {name: fn(analyses, bases) for name, fn in FLATTENERS.items()}


def flatten_call(items: DataFrame, call: str, doc_base: Column | int = 0, single_document: bool = False
                 ) -> dict[str, DataFrame]:
    """FL-16: flatten one call's list column ``call`` at a caller-given doc id.

    ``items`` holds one row per call result in the column named ``call``
    (``categories``, ``concepts``, ``sentiment`` or ``absa``). No running
    counter is involved: every row starts at ``doc_base``.
    """
    base = F.lit(doc_base) if isinstance(doc_base, int) else doc_base
    df = items.select(F.col(call), base.cast("long").alias("doc_base"), F.lit(single_document).alias("single_document"))
    for field in ANALYSIS.fields:
        if field.name not in df.columns and field.name != "seq":
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    names = [n for n, c in _CALL_OF.items() if c == call] if call != "absa" else [n for n in FLATTENERS if n.startswith("absa")]
    return {n: FLATTENERS[n](df) for n in names}
