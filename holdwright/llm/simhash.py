"""SimHash near-duplicates by tiled exact comparison.

A text's A-Z are lower-cased, its words are runs of bytes other than space and
\\x09-\\x0D, its shingles four words each, repeats included (fewer words: all of
them as one; none: fingerprint zero). A fingerprint bit is set if over half of the
shingles' XXH64 (seed 42) have it. Fingerprints link at ``radius`` or fewer
differing bits.

Defined results: null and empty texts have fingerprint zero and link with each
other; a row with a null id takes part in linking but names no component, so its
component is the smallest id reachable, or null; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, unused

RADIUS = 4
SHINGLE = 4
#: Fingerprints in a tile, at least and at most; a task holds two tiles (8 bytes each).
TILE = (4096, 262_144)
#: Tiles that the fingerprints are dealt to, while tiles stay within those limits.
TILES = 16
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    data = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(data[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        block = np.array(hashes[at : at + _CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_buffer() and x.as_py(), shingle) if x.is_valid else 0 for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        up = parent[at]
        if np.array_equal(up, at):
            return at
        at = up


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of the pairs (i, j) in a forest of array indices, smaller index as root."""
    while len(i):
        i, j = _roots(parent, i), _roots(parent, j)
        apart = i != j
        i, j = i[apart], j[apart]
        parent[np.maximum(i, j)] = np.minimum(i, j)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, rows: int = 256, cols: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between the fingerprints a and b (uint64): (node, root) values.

    Exclusive-or and bit counts over blocks; in order of their bit counts, a block
    meets only the stretch whose counts are within the radius.
    """
    both = np.unique(np.concatenate((a, b)))
    both = both[np.argsort(np.bitwise_count(both), kind="stable")]
    ones = np.bitwise_count(both).astype(np.int16)
    parent = np.arange(len(both))
    in_a, in_b = np.isin(both, a), np.isin(both, b)
    ia, ib = np.flatnonzero(in_a), np.flatnonzero(in_b)
    fa, fb, ob = both[ia], both[ib], ones[ib]
    for at in range(0, len(fa), rows):
        block = fa[at : at + rows, None]
        lo = np.searchsorted(ob, ones[ia[at]] - radius, "left")
        hi = np.searchsorted(ob, ones[ia[min(at + rows, len(fa)) - 1]] + radius, "right")
        for c in range(lo, hi, cols):
            near = np.bitwise_count(block ^ fb[None, c : min(c + cols, hi)]) <= radius
            i, j = np.nonzero(near)
            unite(parent, ia[at + i], ib[c + j])
    root = _roots(parent, np.arange(len(both)))
    linked = root != np.arange(len(both))
    return both[linked], both[root[linked]]


def _plan(counts: dict[int, int], radius: int) -> list[list[int]]:
    """For each bit count 0..64: [first tile, tiles, first partner tile, last partner tile].

    Tiles are stretches of bit counts holding about ``size`` fingerprints; a count
    with more is dealt to several tiles. Made from the 65 counts alone.
    """
    size = min(max(-(-sum(counts.values()) // TILES), TILE[0]), TILE[1])
    tiles: list[tuple[int, int]] = []  # (lowest, highest bit count)
    place: dict[int, tuple[int, int]] = {}
    held = 0
    for p in range(65):
        n = counts.get(p, 0)
        if n > size:
            parts = -(-n // size)
            place[p], held = (len(tiles), parts), 0
            tiles += [(p, p)] * parts
        elif held and held + n <= size:
            place[p], held = (len(tiles) - 1, 1), held + n
            tiles[-1] = (tiles[-1][0], p)
        else:
            place[p], held = (len(tiles), 1), max(n, 1)
            tiles.append((p, p))
    out = []
    for p in range(65):
        first, parts = place[p]
        lo, hi = tiles[first]
        near = [k for k, (x, y) in enumerate(tiles) if x <= hi + radius and y >= lo - radius]
        out.append([first, parts, near[0], near[-1]])
    return out


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints of column fp as their links do.

    Every fingerprint goes to the pairs of tiles that its tile is part of; one task
    compares one pair and returns a forest, never all pairs of a group.
    """
    ones = F.bit_count("fp").cast("int")
    counts = {r.p: r["count"] for r in distinct.groupBy(ones.alias("p")).count().collect()}
    plan = _plan(counts, radius)
    col = lambda k: F.element_at(F.array(*[F.lit(x[k]) for x in plan]), ones + 1)
    tile = (col(0) + F.pmod(F.xxhash64("fp"), col(1).cast("long"))).cast("int")
    tiled = distinct.select("fp", tile.alias("tile"), F.explode(F.sequence(col(2), col(3))).alias("other"))
    pairs = tiled.select("fp", "tile", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"))

    def compare(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        a, b = (x.as_py() for x in key)
        fp = t.column("fp").to_numpy().view(np.uint64)
        of = t.column("tile").to_numpy()
        u, v = tile_links(fp[of == a], fp[of == b], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    tasks = sum(hi - lo + 1 for _, _, lo, hi in {(f, n, lo, hi) for f, n, lo, hi in plan})
    return pairs.repartition(min(max(tasks, 1), 10_000), "a", "b").groupBy("a", "b").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    types = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-types")
    roots = connected_components(fingerprint_links(types.select("fp"), radius))
    linked = types.join(roots, types.fp == roots.node).select("fp", "root", "least")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(ids, "root").select("fp", "component_id")
    of = types.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    # Read back, so that the join of a frequent fingerprint is a plain one, which Spark can split.
    out = prints.join(materialize(of, "fingerprint-components"), "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """docs with one row of each group: the one with the smallest id (null: last), of rows that share it the first read.

    Rows are numbered as they are written once with their fingerprints, and the number decides, so
    rows that share an id but not a text are judged apart.
    """
    row, fp = unused(docs, "row", "fp")

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(x) for x in texts), np.uint64, len(texts)).view(np.int64), dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    kept = materialize(docs.withColumns({row: F.monotonically_increasing_id(), fp: of(text)}), "documents-with-fingerprints")
    first = F.min(F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(row).alias("row")))
    types = materialize(kept.groupBy(F.col(fp).alias("fp")).agg(first.alias("first")), "fingerprint-types")
    roots = connected_components(fingerprint_links(types.select("fp"), radius))
    rooted = types.join(roots, types.fp == roots.node, "left").select(F.coalesce("root", "fp").alias("root"), "first")
    stay = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return kept.join(stay, row, "left_semi").select(*docs.columns)
