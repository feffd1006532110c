"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors of one label are projected on many orthonormal directions. Two vectors
collide on a direction if their projections lie within a window centred on the
query's. Unit vectors at cosine c differ by at most r = sqrt(2 - 2c) in length, and on
orthonormal directions the squared differences add up to at most r * r, so no more
than r * r / w * w directions can miss a window of half-width w. The count that a pair
must pass is the number of directions less that bound: no pair at the threshold is
lost, whatever the data, and each pair that passes is verified by its cosine.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component, and those with a null label, link with nothing; only vectors of equal
length are compared; rows that repeat a vec_id are vectors of their own, which link
like any other; a component of null ids alone has a null component_id, and kept is
then true.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize
from .simhash import _roots, unite

COSINE = 0.98
DIRECTIONS = 32
#: Directions that may miss, by the choice of the window's half-width.
MISSES = 8
#: Vectors of a label in one tile; a task holds two tiles.
TILE = 1024


def directions(dim: int, m: int = DIRECTIONS, seed: int = 7) -> np.ndarray:
    """dim x min(m, dim) orthonormal columns."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(m, dim))))
    return q


def collisions(pa_: np.ndarray, pb: np.ndarray, w: float) -> np.ndarray:
    """For each row of pa_ and each of pb, on how many directions pb lies in pa_'s window.

    On each direction pb is sorted, a query's window is a stretch of that order, and
    running sums over the stretches' ends count them.
    """
    n, m = len(pb), pb.shape[1]
    count = np.zeros((len(pa_), n), np.int16)
    row = np.arange(len(pa_))
    for k in range(m):
        order = np.argsort(pb[:, k], kind="stable")
        line = pb[order, k]
        edge = np.zeros((len(pa_), n + 1), np.int8)
        np.add.at(edge, (row, np.searchsorted(line, pa_[:, k] - w, "left")), 1)
        np.add.at(edge, (row, np.searchsorted(line, pa_[:, k] + w, "right")), -1)
        count[:, order] += np.cumsum(edge[:, :n], axis=1, dtype=np.int8)
    return count


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, cosine: float = COSINE, rows: int = 256):
    """Of unit vectors a and b: links per row of a, links per row of b, and a spanning
    forest as pairs of positions in the rows of a followed by those of b."""
    radius2 = max(2 - 2 * cosine, 0.0)
    q = directions(a.shape[1])
    misses = min(MISSES, q.shape[1] - 1)
    w = math.sqrt(radius2 / max(misses, 1)) * (1 + 1e-9) + 1e-9
    need = q.shape[1] - int(radius2 / (w * w))
    pa_, pb = a @ q, b @ q
    la, lb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    parent = np.arange(len(a) + (0 if same else len(b)))
    shift = 0 if same else len(a)
    for at in range(0, len(a), rows):
        passed = collisions(pa_[at : at + rows], pb, w) >= need
        if same:
            passed[np.arange(len(passed)), at + np.arange(len(passed))] = False
        i, j = np.flatnonzero(passed.any(axis=1)), np.flatnonzero(passed.any(axis=0))
        if not len(i):
            continue
        near = (a[at + i] @ b[j].T >= cosine) & passed[np.ix_(i, j)]
        la[at + i] += near.sum(axis=1)
        if not same:
            lb[j] += near.sum(axis=0)
        x, y = np.nonzero(near)
        unite(parent, at + i[x], shift + j[y])
    root = _roots(parent, np.arange(len(parent)))
    node = np.flatnonzero(root != np.arange(len(parent)))
    return la, lb, node, root[node]


def _unit_rows(t: pa.Table, name: str) -> np.ndarray:
    flat = t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(t.num_rows, -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would not hold
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per vector: id, n_links (others linked directly), component_id, kept.

    A label's vectors are dealt to tiles of about TILE, and each pair of tiles is one
    task's work, so a label of any size is spread over the cluster. Tasks return sums
    and forests, so a large group of copies never becomes its pairs.
    """
    v = F.col("v")
    fine = F.coalesce(v.isNotNull() & (F.size("v") > 0) & F.col("label").isNotNull(), F.lit(False))
    fine = fine & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    fine = fine & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label")
    ).withColumn("fine", fine)
    rows = materialize(rows.withColumn("v", F.when(F.col("fine"), F.col("v"))), "vectors")
    good = rows.filter("fine").select("row", "v", "label", F.size("v").alias("dim"))
    tiles = good.groupBy("label", "dim").agg(F.ceil(F.count("row") / TILE).cast("int").alias("tiles"))
    good = good.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles").cast("long")).cast("int"))
    pairs = good.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.select("label", "dim", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "row", "v")

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        a, b = key[2].as_py(), key[3].as_py()
        of, row = t.column("tile").to_numpy(), t.column("row").to_numpy()
        x = _unit_rows(t, "v")
        at, bt = np.flatnonzero(of == a), np.flatnonzero(of == b)
        la, lb, node, root = tile_links(x[at], x[bt], a == b, cosine)
        ids = row[at] if a == b else np.concatenate((row[at], row[bt]))
        links = la if a == b else np.concatenate((la, lb))
        up = np.arange(len(ids))
        up[node] = root
        some = links > 0
        return pa.table({"row": ids[some], "up": ids[up[some]], "links": links[some]})

    met = materialize(pairs.groupBy("label", "dim", "a", "b").applyInArrow(compare, "row long, up long, links long"), "vector-links")
    roots = connected_components(met.select(F.col("row").alias("u"), F.col("up").alias("v")))
    links = met.groupBy("row").agg(F.sum("links").alias("n_links"))
    out = rows.select("row", "id").join(links, "row", "left").join(roots.withColumnRenamed("node", "row"), "row", "left")
    out = out.withColumn("root", F.coalesce("root", "row"))
    least = out.groupBy("root").agg(F.min("id").alias("component_id"))
    out = out.join(least, "root")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
