"""Operator 5, embedding near-dedup by iterative quantisation.

1. Vectors equal in every component are one class, named by its smallest id.
2. Rotations that make balanced binary codes are learnt by iterative
   quantisation on a sample of at most ``FIT_BYTES`` (centre, principal
   directions, then alternate codes and the orthogonal Procrustes solution).
   Several starts give several rotations, so codes may be longer than vectors.
3. Every class is indexed. The code is cut into substrings, one per hash table.
   How well codes agree is measured, not derived: partners at exactly the
   threshold are made around sampled vectors (with noise of all directions and
   with noise of the sample's own differences) and coded. The number of tables
   is such that ``RECALL`` of them meet in every one of ``REGIONS`` regions
   (by distance from the centre) for both kinds; substrings are as long as is
   cheapest by measured bucket sizes, down to none (all pairs are compared).
4. In a bucket, cosines of the original vectors in double precision decide,
   at the threshold by sums that are rounded once. A pair counts only in the first table where it meets, so links are counted
   without a list of pairs: a task returns link counts and a spanning forest.
   A bucket over ``BLOCK`` rows is cut into blocks, and each pair of blocks is
   a task's group.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are components of their own. Only vectors of
one length are compared. Rows with the same id each get a result row; a class
counts its rows. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import group_cuts, stored, whole_groups
from mentions.llm.graph import components

THRESHOLD = 0.9
RECALL = 0.97
FIT_BYTES = 16 << 20
ITERATIONS = 30
BLOCK = 2048
#: Sampled vectors that get partners at the threshold, and the regions they are told apart by.
PROBES = 4096
REGIONS = 4
#: Cosines of unit vectors this near the threshold are computed anew from the original vectors.
DOUBT = 1e-9
#: Moving a row to a bucket costs as much as so many comparisons.
ROW_COST = 64


def valid(vector: F.Column) -> F.Column:
    """The vector has components, all finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class Rotations:
    """``mean`` and ``projection``: the sign of ``(x - mean) @ projection`` is the code; ``extend`` makes it longer."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        self.rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, self.axes = np.linalg.eigh(centred.T @ centred)
        self.main = centred @ self.axes
        self.projection = np.empty((sample.shape[1], 0))

    def extend(self, bits: int) -> None:
        """Learn rotations until codes have at least ``bits`` bits."""
        width = len(self.mean)
        parts = [self.projection]
        for _ in range(-(-(bits - self.projection.shape[1]) // width)):
            rotation = np.linalg.qr(self.rng.normal(size=(width, width)))[0]
            for _ in range(ITERATIONS):
                u, _, vt = np.linalg.svd(np.where(self.main @ rotation >= 0, 1.0, -1.0).T @ self.main)
                rotation = (u @ vt).T
            parts.append(self.axes @ rotation)
        self.projection = np.concatenate(parts, axis=1)

    def codes(self, x: np.ndarray, bits: int | None = None) -> np.ndarray:
        return (x - self.mean) @ self.projection[:, :bits] >= 0


def substrings(codes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The substring of each table as an integer."""
    return codes[:, :tables * bits].reshape(len(codes), tables, bits).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def probe_pairs(sample: np.ndarray, threshold: float, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of pairs at the threshold: for each kind of noise and region, sampled vectors and partners made for them."""
    rng = np.random.default_rng(seed)
    # a small sample gives each vector several partners
    x = sample[np.resize(rng.permutation(len(sample)), PROBES)]
    x = x[np.argsort(np.linalg.norm(x - sample.mean(axis=0), axis=1), kind="stable")]
    out = []
    for noise in (rng.normal(size=x.shape), sample[rng.integers(len(sample), size=len(x))] - x):
        noise = noise - (noise * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(noise, axis=1, keepdims=True)
        usable = size[:, 0] > 1e-6  # one component, or the vector itself: no such partner
        y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * noise / np.where(size > 1e-6, size, 1)
        out += [(x[r], y[r]) for r in np.array_split(np.flatnonzero(usable), REGIONS) if len(r)]
    return out


def table_plan(n: int, sample: np.ndarray, threshold: float, recall: float) -> tuple[int, int, Rotations]:
    """``(bits, tables, rotations)`` for n classes: see the module's third point."""
    model, width = Rotations(sample), sample.shape[1]
    pairs = probe_pairs(sample, threshold)
    model.extend(max(256, 2 * width))
    agree = [(model.codes(x) == model.codes(y)).mean(axis=1) for x, y in pairs]
    own = model.codes(sample)

    def least_tables(bits: int, most: float) -> float:
        """The fewest tables by which ``recall`` is expected in every region, if they are ``most`` at most."""
        need = 1
        for a in agree:
            missed = 1 - a ** bits
            while (missed ** need).mean() > 1 - recall:
                need = math.ceil(need * 1.05)
                if need > most:
                    return math.inf
        return need

    def bucket(bits: int) -> float:
        """Rows that a row meets in a table, from the sample's collisions."""
        sizes = [np.unique(k, return_counts=True)[1] for k in substrings(own, own.shape[1] // max(1, bits), bits).T[:8]]
        return 1 + (n - 1) * float(np.mean([(c * (c - 1)).sum() for c in sizes])) / max(1, len(own) * (len(own) - 1))

    best = (float(n), 0, 1)  # no bits: one bucket, all pairs
    for bits in range(1, max(2, n).bit_length() + 1):
        met = bucket(bits)
        tables = least_tables(bits, best[0] / (ROW_COST + met))
        best = min(best, (tables * (ROW_COST * (1 + tables / width) + met), bits, tables))
    _, bits, tables = best
    while bits:
        model.extend(bits * tables)
        met = [(substrings(model.codes(x), tables, bits) == substrings(model.codes(y), tables, bits)).any(axis=1).mean() for x, y in pairs]
        if min(met, default=1.0) >= recall:
            break
        tables = math.ceil(tables * 1.05)
        if tables * ROW_COST > n:
            bits, tables = 0, 1
    return bits, tables, model


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def exact_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices of original vectors, rounded once at the end of each sum.

    Vectors are scaled by powers of two, which loses nothing, so that squares
    neither overflow nor vanish.
    """
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]).astype(np.longdouble) for v in (x, y))
    dot, left, right = ((a * b).sum(axis=1).astype(np.float64) for a, b in ((x, y), (x, x), (y, y)))
    return dot / np.sqrt(left * right)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(classes: DataFrame, width: int, bits: int, tables: int, model) -> DataFrame:
    """``rep, n, vector, keys``: the substring of each table as an integer."""
    # width * tables * bits doubles
    shared = classes.sparkSession.sparkContext.broadcast((model.mean, model.projection[:, :bits * tables]))

    def run(source):
        mean, projection = shared.value
        for batch in source:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch["vector"], width))
            keys = substrings((x - mean) @ projection >= 0, tables, bits)
            offsets = np.arange(0, (len(x) + 1) * tables, tables, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], batch["n"], batch["vector"],
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1), pa.int32() if bits < 32 else pa.int64()))],
                names=["rep", "n", "vector", "keys"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(run, f"rep long, n long, vector {kind}, keys array<{'int' if bits < 32 else 'long'}>")


def bucket_rows(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each class and table, and for each pair of blocks that it takes part in.

    Adds ``tab``, ``key``, the blocks ``x <= y`` of the group and the row's own ``own``.
    """
    rows = coded.select("rep", "n", "vector", "keys", F.posexplode("keys").alias("tab", "key"))
    sizes = coded.select(F.posexplode("keys").alias("tab", "key")).groupBy("tab", "key").count()
    # stored, so that its size is known before the rows move: few or no buckets are large
    large = stored(sizes.where(F.col("count") > block).select("tab", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks")),
                   "large-buckets")
    rows = rows.join(large, ["tab", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("tab", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                       "own", "rep", "n", "vector", "keys")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (a, b)."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    out = []
    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(p), top(q)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((min(p, q), max(p, q)))
    return out


def _links_in(group: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the pairs of a bucket group that link here first."""
    vectors, keys, own = group["unit"], group["keys"], group["own"]
    same_block = group["x"] == group["y"]
    left = np.arange(len(own)) if same_block else np.flatnonzero(own == group["x"])
    right = left if same_block else np.flatnonzero(own == group["y"])
    found_i, found_j = [], []
    for start in range(0, len(left), 1024):
        rows = left[start:start + 1024]
        cosine = vectors[rows] @ vectors[right].T
        i, j = np.nonzero(cosine >= threshold - DOUBT)
        # unit vectors are rounded: near the threshold the original ones decide
        near = np.flatnonzero(cosine[i, j] < threshold + DOUBT)
        i, j = rows[i], right[j]
        if len(near):
            keep = np.ones(len(i), bool)
            for part in np.array_split(near, -(-len(near) // 4096)):
                keep[part] = exact_cosines(group["vector"][i[part]], group["vector"][j[part]]) >= threshold
            i, j = i[keep], j[keep]
        if same_block:
            i, j = i[i < j], j[i < j]
        first = (keys[i] == keys[j]).argmax(axis=1) == group["tab"] if len(i) else np.empty(0, bool)
        found_i.append(i[first])
        found_j.append(j[first])
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.empty(0, int), np.empty(0, int))


def bucket_links(rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """Verified links of all buckets, as ``kind`` 0 (``a`` has ``b`` linked rows) or 1 (edge ``a`` - ``b``)."""
    group_of = ["tab", "key", "x", "y"]
    dealt = rows.repartition(*group_of).sortWithinPartitions(*group_of)

    def run(source):
        for table in whole_groups(source, group_of):
            ids = np.stack([table[c].to_numpy() for c in group_of], axis=1)
            cuts = group_cuts(table, group_of)
            vector = _matrix(table["vector"].combine_chunks(), width)
            unit = _unit(vector)
            tables = len(table["keys"][0])
            keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, tables)
            rep, n, own = (table[c].to_numpy() for c in ("rep", "n", "own"))
            counts: dict[int, int] = {}
            edges: list[tuple[int, int]] = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e - s < 2:
                    continue
                i, j = _links_in({"unit": unit[s:e], "vector": vector[s:e], "keys": keys[s:e], "own": own[s:e], "tab": ids[s, 0], "x": ids[s, 2],
                                  "y": ids[s, 3]}, threshold)
                if len(i):
                    total = np.zeros(e - s, np.int64)
                    np.add.at(total, i, n[s:e][j])
                    np.add.at(total, j, n[s:e][i])
                    for k in np.flatnonzero(total):
                        counts[int(rep[s + k])] = counts.get(int(rep[s + k]), 0) + int(total[k])
                    edges += _forest(rep[s:e][i], rep[s:e][j])
            out = [(0, a, b) for a, b in counts.items()] + [(1, a, b) for a, b in edges]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int32() if c == 0 else pa.int64())
                                              for c in range(3)], names=["kind", "a", "b"])

    return dealt.mapInArrow(run, "kind int, a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, fit_bytes: int = FIT_BYTES,
                    block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links by cosine of at least ``threshold``.

    Returns one row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"))
    usable = base.where(valid(F.col("vector")) & F.col("vec_id").isNotNull())
    classes = stored(usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    found = None
    for width, n in [tuple(r) for r in classes.groupBy(F.size("vector").alias("w")).count().collect()]:
        own = classes.where(F.size("vector") == width)
        rows = max(2, fit_bytes // (8 * width))  # of the sample
        sample = own.orderBy(F.xxhash64("rep")).limit(rows).select("vector")  # bounded: fit_bytes
        x = np.array([r.vector for r in sample.toLocalIterator()], np.float64).reshape(-1, width)
        bits, tables, model = table_plan(n, _unit(x), threshold, recall)
        coded = stored(encode(own.select("rep", "n", "vector"), width, bits, tables, model), "codes")
        links = stored(bucket_links(bucket_rows(coded, block), width, threshold), "links")
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "kind int, a long, b long")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    parts = components(found.where("kind = 1").select("a", "b"))
    known = classes.join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "vector", "rep", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    joined = base.withColumn("vector", F.when(valid(F.col("vector")) & F.col("vec_id").isNotNull(), F.col("vector"))).join(
        known, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
