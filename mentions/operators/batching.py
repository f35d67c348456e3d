"""Size-bounded batching of a text table (BP-01).

Texts are packed, in order, into request batches whose JSON body stays
under ``max_size`` bytes: a text costs the length of its ASCII-escaped JSON
string literal plus one separator, a batch also pays the fixed overhead of
the request frame. Lengths are computed by Spark (:func:`text_bytes`).

Packing is greedy: where a batch starts depends on all texts before it. Yet
what a stretch of texts does to the batch that is open at its beginning is a
function of one number, the bytes that the batch holds by then. So:

1. Rows are sorted by range and stored once, with their place (range and
   position in it).
2. In each *unit* of ``UNIT_ROWS`` rows, prefix sums of bytes and a binary
   search give each row's next batch start; pointer doubling gives the last
   start that is reached from it inside the unit. That is all the unit's
   function needs, for each row at which the open batch can end: the rows of
   the unit's first ``max_size`` bytes.
3. Functions of ``FAN`` neighbouring units are composed, and so on up to one;
   back down, each unit gets the batch that is open when it begins.
4. Each unit lists its starts, by groups of ``GROUP_ROWS`` rows, and rows look
   theirs up.

Texts go through one shuffle, all else is a few numbers per row. No step needs
more than a unit's numbers, or the functions of ``FAN`` units, in one task.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The analysis calls a request may ask for, and the default
# request size limit in bytes.
ANALYSES = ("concepts", "categories", "sentiment", "absa")
MAX_REQUEST_BYTES = 1_000_000

UNIT_ROWS = 1 << 16
GROUP_ROWS = 1 << 12
FAN = 32
#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
PLACE_BITS = 33


def request_overhead(analyses) -> int:
    """Bytes of the request frame around the texts list."""
    analyses = list(dict.fromkeys(analyses))
    unknown = [a for a in analyses if a not in ANALYSES]
    if unknown:
        raise ValueError(f"unknown analyses: {', '.join(unknown)}")
    return len(json.dumps({"texts": [], "analyses": analyses}))


def text_bytes(text: Column) -> Column:
    """Bytes one text adds to a request: its JSON literal in ASCII, and a separator.

    Quotes, backslashes and the five short control escapes take two bytes,
    other control and non-ASCII characters six, characters beyond the basic
    plane twelve; a null is written ``null``.
    """
    def count(outside: str) -> Column:
        return F.length(F.regexp_replace(text, outside, ""))

    short = count(r'[^"\\\x08\x0C\n\r\t]')
    long = count(r"[^\x00-\x07\x0B\x0E-\x1F\x{7F}-\x{FFFF}]")
    astral = count(r"[^\x{10000}-\x{10FFFF}]")
    return F.coalesce(F.length(text) + 3 + short + 5 * long + 11 * astral, F.lit(5)).cast("long")


class Stretch:
    """What a stretch of rows does to the batch that is open when it begins.

    ``ends[k]``: bytes of the stretch up to and with the k-th row at which the
    open batch may be full; ``fills[k]``, ``firsts[k]``: if it is, the bytes and
    the first row (by id) of the batch that is open at the stretch's end.
    ``whole``: the stretch may also go into the open batch as a whole.
    """

    def __init__(self, ends: np.ndarray, fills: np.ndarray, firsts: np.ndarray, total: int, room: int):
        last = int(np.searchsorted(ends, room, "right")) + 1  # no batch has room for more
        self.ends, self.fills, self.firsts, self.total, self.room = ends[:last], fills[:last], firsts[:last], total, room
        self.whole = total <= room

    def after(self, fills: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The batches open at the end, for batches open at the beginning."""
        full = np.searchsorted(self.ends, self.room - fills, "right")
        inside = full < len(self.ends)
        at = np.minimum(full, len(self.ends) - 1)
        return np.where(inside, self.fills[at], fills + self.total), np.where(inside, self.firsts[at], firsts)

    def then(self, other: "Stretch") -> "Stretch":
        """The function of this stretch and the next one."""
        fills, firsts = other.after(self.fills, self.firsts)
        ends = self.ends
        if self.whole:
            ends = np.concatenate((ends, self.total + other.ends))
            fills, firsts = np.concatenate((fills, other.fills)), np.concatenate((firsts, other.firsts))
        return Stretch(ends, fills, firsts, self.total + other.total, self.room)


def next_starts(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """``(end, next)``: bytes up to and with each row, and where the next batch starts if one starts at the row."""
    ends = np.cumsum(sizes)
    following = np.searchsorted(ends, ends - sizes + room, "right")
    return ends, np.maximum(following, np.arange(1, len(sizes) + 1))  # a text too large is a batch of its own


def stretch_of(sizes: np.ndarray, ids: np.ndarray, room: int) -> Stretch:
    """The function of a unit's rows."""
    ends, following = next_starts(sizes, room)
    last = np.where(following < len(sizes), following, np.arange(len(sizes)))
    while True:  # pointer doubling: the last start reached inside the unit
        further = last[last]
        if (further == last).all():
            break
        last = further
    total = int(ends[-1])
    return Stretch(ends, total - (ends - sizes)[last], ids[last], total, room)


_FUNCTION = "unit long, ends array<long>, fills array<long>, firsts array<long>, total long"


def _function_rows(units: list[int], functions: list[Stretch]) -> pa.Table:
    many = pa.list_(pa.int64())
    return pa.table({"unit": pa.array(units, pa.int64()),
                     **{c: pa.array([getattr(f, c) for f in functions], many) for c in ("ends", "fills", "firsts")},
                     "total": pa.array([f.total for f in functions], pa.int64())})


def _functions(table: pa.Table, room: int) -> list[tuple[int, Stretch]]:
    """The units of a group in order, and their functions."""
    table = table.sort_by("unit")
    parts = [[np.asarray(x.values) for x in table[c]] for c in ("ends", "fills", "firsts")]
    return [(u, Stretch(*arrays, total, room)) for u, total, *arrays in zip(
        table["unit"].to_pylist(), table["total"].to_pylist(), *parts, strict=True)]


def batch_starts(thin: DataFrame, room: int, store) -> DataFrame:
    """``_part, _grp, pos, first``: for each group of rows, the position and the first row's id of the batch at the
    group's beginning and of those that start inside. ``thin`` has ``id`` and ``text_bytes``.

    A row's id has its part in the upper bits and its position in the lower ones.
    """
    place = thin.select("id", "text_bytes", F.shiftright("id", PLACE_BITS).alias("part"),
                        F.col("id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("pos"))
    # units are numbered through; one row for each part goes to the driver
    sizes = {r.part: r.units for r in place.groupBy("part").agg(F.expr(f"max(pos) div {UNIT_ROWS} + 1").alias("units")).collect()}
    offsets = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(max(sizes, default=0) + 1)]))).astype(np.int64)
    number = F.element_at(F.lit(offsets), (F.col("part") + 1).cast("int")) + F.expr(f"pos div {UNIT_ROWS}")
    units = place.select("id", "text_bytes", "pos", "part", number.alias("unit"))

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        return _function_rows([table["unit"][0].as_py()], [stretch_of(table["text_bytes"].to_numpy(), table["id"].to_numpy(), room)])

    def compose(table: pa.Table) -> pa.Table:
        (unit, whole), *rest = _functions(table.select(["unit", "ends", "fills", "firsts", "total"]), room)
        for _, function in rest:
            whole = whole.then(function)
        return _function_rows([unit // FAN], [whole])

    levels, count = [store(units.select("id", "text_bytes", "unit").groupBy("unit").applyInArrow(summarise, _FUNCTION))], int(offsets[-1])
    while count > 1:
        above = levels[-1].withColumn("above", F.expr(f"unit div {FAN}")).groupBy("above").applyInArrow(compose, _FUNCTION)
        levels.append(store(above))
        count = -(-count // FAN)

    def descend(table: pa.Table) -> pa.Table:
        fill, first = np.array([table["fill"][0].as_py()]), np.array([table["first"][0].as_py()])
        out = []
        for unit, function in _functions(table, room):
            out.append((unit, int(fill[0]), int(first[0])))
            fill, first = function.after(fill, first)
        return pa.table({c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("unit", "fill", "first"))})

    # nothing is open at first: as if a batch were full
    spark, opened = thin.sparkSession, "unit long, fill long, first long"
    entry = spark.createDataFrame([(0, room + 1, -1)], opened)
    for functions in reversed(levels[:-1]):
        above = entry.withColumnRenamed("unit", "above")
        entry = store(functions.withColumn("above", F.expr(f"unit div {FAN}")).join(above, "above").groupBy("above").applyInArrow(descend, opened))

    def resolve(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        sizes, ids, pos = (table[c].to_numpy() for c in ("text_bytes", "id", "pos"))
        ends, following = next_starts(sizes, room)
        starts, at = [], int(np.searchsorted(ends, room - table["fill"][0].as_py(), "right"))
        steps = following.tolist()
        while at < len(steps):
            starts.append(at)
            at = steps[at]
        # rows of the unit before the first start belong to the batch that was open
        heads = np.concatenate(([table["first"][0].as_py()], ids[starts])).astype(np.int64)
        marks = np.unique(np.concatenate((starts, np.flatnonzero(pos % GROUP_ROWS == 0))).astype(np.int64))
        return pa.table({"_part": table["part"].to_numpy()[marks], "_grp": pos[marks] // GROUP_ROWS, "pos": pos[marks],
                         "first": heads[np.searchsorted(starts, marks, "right")]})

    return units.join(entry, "unit").groupBy("unit").applyInArrow(resolve, "_part long, _grp long, pos long, first long")


def batch_texts(texts: DataFrame, analyses=ANALYSES, max_size: int = MAX_REQUEST_BYTES, text_col: str = "text",
                order_col: str = "doc_id", shard_col: str | None = None, range_width: int | None = None) -> DataFrame:
    """Add ``batch_start`` (``order_col`` of the batch's first text), ``text_bytes`` and ``oversized``.

    Rows of one batch share ``batch_start`` (if order keys are unique). A text
    too large for an empty request forms a batch of its own (``oversized``
    true). Rows with equal order keys are ordered by their text. With
    ``shard_col``, or with ranges of ``range_width`` order keys as shards, each
    shard is packed for itself, in one task, and a batch is named by shard and
    ``batch_start``.

    Without it this is an eager step: rows are stored below the checkpoint folder.
    """
    overhead = request_overhead(analyses)
    if max_size <= overhead:
        raise ValueError("max_size leaves no room for texts")
    kept, sized = texts.columns, texts.withColumn("text_bytes", text_bytes(F.col(text_col)))
    if shard_col or range_width:
        shard = F.col(shard_col) if shard_col else F.floor(F.col(order_col) / F.lit(float(range_width))).cast("long")
        return _pack_shards(sized.withColumn("_shard", shard), overhead, max_size, text_col, order_col).select(*kept, "batch_start", "text_bytes", "oversized")
    from mentions.session import scratch_dir

    spark, root = texts.sparkSession, scratch_dir(texts.sparkSession, "batching")

    def store(df: DataFrame) -> DataFrame:
        store.count += 1
        df.write.parquet(f"{root}/{store.count}")
        return spark.read.schema(df.schema).parquet(f"{root}/{store.count}")

    store.count = 0
    rows = store(sized.repartitionByRange(order_col, text_col).sortWithinPartitions(order_col, text_col)
                 .withColumn("_id", F.monotonically_increasing_id()))
    starts = store(batch_starts(rows.select(F.col("_id").alias("id"), "text_bytes"), max_size - overhead, store))
    keys = rows.select(F.col("_id").alias("first"), F.col(order_col).alias("_key")).join(starts.select("first").distinct(), "first")
    # at most GROUP_ROWS entries for each group
    named = starts.join(keys, "first").groupBy("_part", "_grp").agg(F.sort_array(F.collect_list(F.struct("pos", "_key"))).alias("_starts"))
    pos = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    placed = rows.withColumns({"_part": F.shiftright("_id", PLACE_BITS), "_grp": F.floor(pos / GROUP_ROWS).cast("long")})
    reached = F.size(F.filter("_starts", lambda s: s["pos"] <= pos))
    return placed.join(named, ["_part", "_grp"]).withColumns({
        "batch_start": F.element_at("_starts", reached)["_key"], "oversized": F.col("text_bytes") + overhead > max_size,
    }).select(*kept, "batch_start", "text_bytes", "oversized")


def _pack_shards(sized: DataFrame, overhead: int, max_size: int, text_col: str, order_col: str) -> DataFrame:
    """Greedy packing of each shard in one task, as a stream: memory is one Arrow batch."""
    dealt = sized.repartition("_shard").sortWithinPartitions("_shard", order_col, text_col)
    schema = T.StructType([
        *dealt.schema.fields,
        T.StructField("batch_start", sized.schema[order_col].dataType),
        T.StructField("oversized", T.BooleanType()),
    ])

    def pack(batches):
        fill, last, start = None, None, None
        for batch in batches:
            starts, big = [], []
            for s, o, c in zip(*[batch[n].to_pylist() for n in ("_shard", order_col, "text_bytes")], strict=True):
                if fill is None or s != last or fill + c > max_size:
                    fill, last, start = overhead, s, o
                fill += c
                starts.append(start)
                big.append(overhead + c > max_size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(starts, batch[order_col].type), pa.array(big, pa.bool_())],
                names=[*batch.schema.names, "batch_start", "oversized"])

    return dealt.mapInArrow(pack, schema)


def batch_summary(batched: DataFrame, analyses=ANALYSES, order_col: str = "doc_id",
                  shard_col: str | None = None) -> DataFrame:
    """One row per batch: ``texts``, ``request_bytes``, first and last ``order_col``."""
    keys = ([shard_col] if shard_col else []) + ["batch_start"]
    return batched.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("texts"),
        (F.sum("text_bytes") + F.lit(request_overhead(analyses))).alias("request_bytes"),
        F.min(order_col).alias("first"), F.max(order_col).alias("last"))
