"""Near-duplicate vectors by an exact range join in a metric space.

The metric is the angle. Pivots part the vectors into cells: a vector is at home in the cell of its nearest
pivot. A vector y can be within the angle t of a vector x at home in cell i only if

    angle(y, p_i) <= radius_i + t                      triangle inequality, radius_i the cell's
    cos(y, p_h) - cos(y, p_i) <= sin(t) * |p_h - p_i|  the border between y's own cell h and cell i

so y visits exactly the cells that meet both. Every vector within t of x visits x's cell, and cells are joined
on their own. A cell is cut into blocks of homes and blocks of visitors, and each pair of blocks is one group of
bounded size: one matrix product in single precision, and where that is within its error of the threshold, the
cosine in double precision. A group returns sums and a forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tickloom.llm.common import col
from tickloom.llm.components import connected
from tickloom.session import written

# Pivots of each vector length, and the rows of a block. The pivots are the vectors with the smallest hashes.
PIVOTS, BLOCK = 16, 8192
_STRIP, _CHECKED = 512, 1 << 16


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between each node of a graph and the smallest node it is connected with, without the loops."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        while not np.array_equal(new, shorter := new[new]):
            new = shorter
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def block_links(
    homes: np.ndarray, visitors: np.ndarray, home_ids: np.ndarray, visitor_ids: np.ndarray,
    weights: np.ndarray, cosine: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each home the weight of the visitors linked with it, and a forest of the links."""
    x, y = _unit(homes), _unit(visitors)
    x32, y32 = x.astype(np.float32), np.ascontiguousarray(y.astype(np.float32).T)
    margin = 1e-6 + 1.2e-7 * x.shape[1]  # above the error of a single-precision product of unit vectors
    counts, a, b = np.zeros(len(x), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(x), _STRIP):
        near = x32[at : at + _STRIP] @ y32
        i, j = np.divmod(np.flatnonzero(near >= cosine - margin), near.shape[1])
        unsure = np.flatnonzero(near[i, j] < cosine + margin)
        keep = np.ones(len(i), bool)
        for k in range(0, len(unsure), _CHECKED):
            u = unsure[k : k + _CHECKED]
            keep[u] = np.einsum("ij,ij->i", x[at + i[u]], y[j[u]]) >= cosine
        i, j = at + i[keep], j[keep]
        other = home_ids[i] != visitor_ids[j]
        i, j = i[other], j[other]
        counts += np.bincount(i, weights[j], len(x)).astype(np.int64)
        a, b = forest(np.concatenate([a, home_ids[i]]), np.concatenate([b, visitor_ids[j]]))
    return counts, a, b


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int = PIVOTS, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors with at least this cosine), component_id, kept.

    ``component_id`` is the smallest id reachable over links, ``kept`` tells whether that is the vector's own.
    Equal vectors are compared once and count as often as they occur, so a vector that repeats in many
    rows is one row of the join. Vectors that are null, empty, all zero or hold a null, infinite or NaN are
    linked with nothing, as are vectors of different lengths with each other. Rows with repeated ids are vectors
    of their own; a null id is never the smallest of a class unless there is no other, and is kept if it
    stands alone. An empty table gives no rows; other columns are not read. ``cosine`` is above 0.

    Where data have no structure that pivots can catch, as in many dimensions, most vectors visit most cells and
    the join compares nearly all blocks: exact, in bounded groups, but with time as the square of the
    number of distinct vectors.
    """
    theta = math.acos(cosine)
    given = vectors.select(col(vectors, id_col).alias("vec_id"), col(vectors, vector_col).alias("v"))
    sound = (
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
        & F.exists("v", lambda e: e != 0)
    )
    distinct = (
        given.filter(sound).groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("uid", F.monotonically_increasing_id()).withColumn("dim", F.size("v"))
    )
    distinct = written(distinct, "vectors")

    by_hash = W.partitionBy("dim").orderBy(F.xxhash64("v"), "uid")
    chosen = distinct.withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= pivots).select("dim", "v").collect()
    centres = {dim: _unit(np.array([r.v for r in chosen if r.dim == dim], np.float64)) for dim in {r.dim for r in chosen}}
    spans = {dim: np.linalg.norm(p[:, None] - p[None, :], axis=2) for dim, p in centres.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                near = np.clip(_unit(_matrix(rows.column(2))) @ centres[dim].T, -1, 1)
                home = near.argmax(axis=1)
                gap = near[np.arange(len(home)), home][:, None] - near
                reach = gap <= math.sin(theta) * spans[dim][home] + 1e-9
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(home, pa.int32()),
                     pa.array([np.flatnonzero(r).astype(np.int32) for r in reach], pa.list_(pa.int32())),
                     pa.array(list(np.arccos(near)), pa.list_(pa.float64())), rows.column(2), rows.column(3)],
                    names=["uid", "dim", "home", "reach", "angles", "v", "copies"])

    kind = distinct.schema["v"].dataType.simpleString()
    assigned = written(distinct.select("uid", "dim", "v", "copies").mapInArrow(
        assign, f"uid long, dim int, home int, reach array<int>, angles array<double>, v {kind}, copies long"), "assigned")
    # a cell's radius and size: one row per pivot
    cells = assigned.groupBy("dim", "home").agg(
        F.max(F.get("angles", F.col("home"))).alias("radius"), F.count("*").alias("homes")).collect()
    radius = {(r.dim, r.home): r.radius for r in cells}
    within = F.array(*[F.lit(0.0)])
    table = {dim: [radius.get((dim, k), -10.0) for k in range(len(p))] for dim, p in centres.items()}
    for dim, radii in table.items():
        within = F.when(F.col("dim") == dim, F.array(*[F.lit(float(r)) for r in radii])).otherwise(within)
    visits = assigned.withColumn("radii", within).withColumn("cells", F.filter(
        "reach", lambda c: F.get("angles", c) <= F.get("radii", c) + theta + 1e-9))
    visits = visits.select("uid", "dim", "v", "copies", F.explode("cells").alias("cell"))
    seen = {(r.dim, r.cell): r.n for r in visits.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect()}
    size = {(r.dim, r.home): r.homes for r in cells}

    def blocks(numbers: dict, cell: str):
        parts = F.lit(1)
        for (dim, k), n in numbers.items():
            if n > block:
                parts = F.when((F.col("dim") == dim) & (F.col(cell) == k), F.lit(-(-n // block))).otherwise(parts)
        return parts

    spread = F.abs(F.xxhash64("uid"))
    own = assigned.select(
        "uid", "dim", "v", "copies", F.col("home").alias("cell"), (spread % blocks(size, "home")).cast("int").alias("hb"),
        F.explode(F.sequence(F.lit(0), blocks(seen, "home") - 1)).alias("vb"), F.lit(True).alias("is_home"))
    other = visits.select(
        "uid", "dim", "v", "copies", "cell", F.explode(F.sequence(F.lit(0), blocks(size, "cell") - 1)).alias("hb"),
        (spread % blocks(seen, "cell")).cast("int").alias("vb"), F.lit(False).alias("is_home"))

    def join(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        mask = group.column("is_home").to_numpy()
        home, visitor = group.filter(pa.array(mask)), group.filter(pa.array(~mask))
        none = pa.table({"uid": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "tie": pa.array([], pa.int64())})
        if not home.num_rows or not visitor.num_rows:
            return none
        ids = home.column("uid").to_numpy()
        counts, a, b = block_links(
            _matrix(home.column("v").combine_chunks()), _matrix(visitor.column("v").combine_chunks()), ids,
            visitor.column("uid").to_numpy(), visitor.column("copies").to_numpy(), cosine)
        some = counts > 0
        return pa.table({
            "uid": np.concatenate([ids[some], a]), "n": np.concatenate([counts[some], np.zeros(len(a), np.int64)]),
            "tie": pa.array(np.concatenate([np.zeros(some.sum(), np.int64), b]), mask=np.arange(some.sum() + len(a)) < some.sum())})

    found = own.unionByName(other).groupBy("dim", "cell", "hb", "vb").applyInArrow(join, "uid long, n long, tie long")
    found = written(found, "links")
    linked = found.groupBy("uid").agg(F.sum("n").alias("n"))
    classes = connected(found.filter("tie is not null").select(F.col("uid").alias("a"), F.col("tie").alias("b")))
    rooted = (
        distinct.join(linked, "uid", "left").join(classes, F.col("uid") == F.col("node"), "left")
        .select("v", "copies", "first", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "uid").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select(
        "v", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    return given.join(labels, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))
