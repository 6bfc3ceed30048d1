"""Near copies among vectors of one label, by tiles in the order of principal components.

Vectors are scaled to length one and turned to the principal axes of the whole table (one distributed sum of outer
products, whose size depends on the number of dimensions only), so that their leading coordinates hold most of what tells them
apart. Two vectors with a cosine of at least ``t`` lie within ``sqrt(2 - 2 t)`` of each other on every axis. So cells of that
width on the first axes are sorted with the label, and the order is cut into *tiles* of ``TILE`` vectors at most; two tiles meet
only if their cells are the same or neighbours and the boxes around their leading coordinates are near enough.

Two tiles are compared block by block of dimensions: the products of the leading block are summed first, and what the other
dimensions can add is bounded by the product of the norms of the suffixes. A pair is dropped as soon as sum and bound cannot
reach the threshold; the pairs left go on to the next block, and what passes the last one is decided on the original vectors in
double precision.

Equal vectors of one label are one *class*. Tiles hand on counts of links for each class and a spanning forest of their links,
never the links themselves, so a group of thousands of near copies gives rows in proportion to its size.

Defined results: rows whose label or id is null, or whose vector is null, empty, zero or has null or non-finite
components, link with nothing; a null id has a null component and is not kept. Rows that repeat an id are vectors of their own, and equal rows link. Vectors of different lengths do not
link. Only the named columns are read; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import join_groups, stored
from tileframe.llm.components import components
from tileframe.operators.ordered import row_numbers

THRESHOLD = 0.98
#: Vectors of a tile, and axes that have cells.
TILE, AXES = 1024, 3
#: Dimensions of the blocks after which pairs are dropped; the last one is repeated.
BLOCKS = (8, 8, 16, 32)
#: Room for rounding before the decision on the original vectors.
_SLACK = 1e-9
#: Share of the pairs of two tiles below which pairs are followed one by one.
_FEW = 0.05
_CLASS = "class long, `group` string, copies long, vector array<double>"


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest component first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        units = unit(_matrix(batch.column(0)))
        own = np.concatenate([[len(units)], units.sum(axis=0), (units.T @ units).ravel()])
        total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "value"]
        )


def principal_axes(vectors: DataFrame, length: int) -> np.ndarray:
    """Directions of largest spread as columns, from the sums over all vectors of ``length`` components."""
    sums = vectors.where(F.size("vector") == length).select("vector").mapInArrow(_moments, "at int, value double")
    rows = sums.groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(1 + length + length * length)
    for r in rows:
        total[r["at"]] = r["value"]
    n, mean, second = max(total[0], 1.0), total[1 : 1 + length], total[1 + length :].reshape(length, length)
    spread = second / n - np.outer(mean / n, mean / n)
    return np.linalg.eigh(spread)[1][:, ::-1]


def _turned(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Vectors on the principal axes; those of another length keep their own."""
    return units @ axes if units.shape[1] == len(axes) else units


def _cells(axes: np.ndarray, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Lengths may differ from row to row, so each length is worked on apart.
            lengths = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                spots = _turned(unit(_matrix(part.column(3))), axes)[:, :AXES]
                cells = np.zeros((len(spots), AXES), dtype=np.int32)
                cells[:, : spots.shape[1]] = np.floor(spots / width)
                lead = np.zeros(len(spots)) + spots[:, 0]
                columns = [*part.columns, *(pa.array(cells[:, i]) for i in range(AXES)), pa.array(lead)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "c0", "c1", "c2", "lead"])

    return run


def _boxes(axes: np.ndarray):
    """One row per tile: its vectors as arrays, and the box around their leading coordinates."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class")
        vectors = np.stack(rows["vector"].to_numpy())
        spots = _turned(unit(vectors), axes)[:, : BLOCKS[0]]
        return pd.DataFrame(
            {
                "tile": [int(rows["tile"].iloc[0])], "group": [rows["group"].iloc[0]],
                "low": [spots.min(axis=0)], "high": [spots.max(axis=0)],
                "classes": [rows["class"].to_numpy()], "copies": [rows["copies"].to_numpy()], "vectors": [vectors.ravel()],
            }
        )

    return run


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of unit vectors whose product may reach the threshold.

    Leading dimensions first; a pair is dropped once sum and bound of the rest fall short."""
    size, at, step = left.shape[1], 0, 0
    tails = [np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]) for x in (left, right)]
    grid, i, j, sums = np.zeros((len(left), len(right))), None, None, None
    while at < size:
        end = min(size, at + BLOCKS[min(step, len(BLOCKS) - 1)])
        if i is None:
            grid += left[:, at:end] @ right[:, at:end].T
            bound = np.outer(tails[0][:, end], tails[1][:, end]) if end < size else 0.0
            hits = grid + bound >= threshold - _SLACK
            # While many pairs are left, products of whole matrices cost less than picking pairs.
            if end == size or hits.mean() < _FEW:
                i, j = np.nonzero(hits)
                sums = grid[i, j]
        else:
            sums = sums + np.einsum("nd,nd->n", left[i, at:end], right[j, at:end])
            bound = tails[0][i, end] * tails[1][j, end] if end < size else 0.0
            keep = sums + bound >= threshold - _SLACK
            i, j, sums = i[keep], j[keep], sums[keep]
        at, step = end, step + 1
    return i, j


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of rows in double precision, on the vectors as they are (scaled by their largest component)."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    joint = np.einsum("nd,nd->n", x, y)
    return joint / (np.sqrt(np.einsum("nd,nd->n", x, x)) * np.sqrt(np.einsum("nd,nd->n", y, y)))


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable by the pairs, for each position."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[i], root[j])
        now = root.copy()
        np.minimum.at(now, i, least)
        np.minimum.at(now, j, least)
        now = np.minimum(now, now[now])
        if (now == root).all():
            return root
        root = now


#: Rows of a strip of a tile that is compared at once.
_STRIP = 256


def _compare(axes: np.ndarray, threshold: float):
    """Counts of links and a spanning forest for pairs of tiles."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids = [np.asarray(x, dtype=np.int64) for x in (r.classes, r.other_classes)]
                copies = [np.asarray(x, dtype=np.int64) for x in (r.copies, r.other_copies)]
                vectors = [np.asarray(x, dtype=float).reshape(len(n), -1) for x, n in zip((r.vectors, r.other_vectors), ids)]
                units = [_turned(unit(v), axes) for v in vectors]
                same = r.tile == r.other
                counts = [np.zeros(len(x), dtype=np.int64) for x in ids]
                links_i, links_j = [], []
                for at in range(0, len(ids[0]), _STRIP):
                    i, j = close_pairs(units[0][at : at + _STRIP], units[1], threshold)
                    i = i + at
                    if same:
                        i, j = i[i < j], j[i < j]
                    good = cosine(vectors[0][i], vectors[1][j]) >= threshold
                    i, j = i[good], j[good]
                    np.add.at(counts[0], i, copies[1][j])
                    np.add.at(counts[1], j, copies[0][i])
                    # Only a forest of the strip's links is kept.
                    nodes = len(ids[0]) + len(ids[1])
                    shift = 0 if same else len(ids[0])
                    root = _roots(nodes, i, j + shift)
                    linked = np.flatnonzero(root != np.arange(nodes))
                    links_i.append(linked)
                    links_j.append(root[linked])
                nodes = len(ids[0]) + len(ids[1])
                root = _roots(nodes, np.concatenate(links_i), np.concatenate(links_j))
                both = np.concatenate(ids)
                totals = np.concatenate([counts[0] + counts[1], np.zeros(len(ids[1]), np.int64)]) if same else np.concatenate(counts)
                linked = totals > 0
                yield pd.DataFrame({"id": both[linked], "root": both[root][linked], "links": totals[linked]})

    return run


def tile_pairs(tiles: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """``tile, other`` with ``tile <= other``: tiles with the same or neighbouring cells whose boxes are near enough.

    ``cells`` has one row per tile and cell of its vectors; a cell offers itself to its neighbours."""
    around = [F.explode(F.array([F.col(f"c{i}") + d for d in (-1, 0, 1)])).alias(f"c{i}") for i in range(AXES)]
    offered = cells
    for i, column in enumerate(around):
        offered = offered.select(*[c for c in offered.columns if c != f"c{i}"], column)
    offered = offered.withColumnRenamed("tile", "other")
    keys = ["group", *(f"c{i}" for i in range(AXES))]
    met = cells.join(offered, keys).where("tile <= other").select("tile", "other").distinct()
    box = tiles.select("tile", "low", "high")
    far = box.select(F.col("tile").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    gaps = F.zip_with(
        F.zip_with("low2", "high", lambda a, b: a - b), F.zip_with("low", "high2", lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    apart = F.aggregate(F.transform(gaps, lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
    return met.join(box, "tile").join(far, "other").where(apart <= reach * reach + _SLACK).select("tile", "other")


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """Per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links) and ``kept``."""
    raw = vectors.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    fit = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable(F.col("vector"))
    rows = raw.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.when(fit, F.col("vector")).alias("vector"),
        # The group of vectors that may link: one label, one number of components.
        F.when(fit, F.concat_ws("|", F.size("vector").cast("string"), "label")).alias("group"),
    )
    rows = stored(rows, "rows")
    usual = rows.where("vector IS NOT NULL").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    # -0.0 and 0.0 are one value for the grouping as for the cosine.
    exact = F.transform("vector", lambda x: x + F.lit(0.0))
    members = rows.where("vector IS NOT NULL").withColumn("vector", exact)
    classes = members.groupBy("group", "vector").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(classes, "classes")
    axes = principal_axes(classes, usual["n"])
    reach = math.sqrt(2 - 2 * threshold)
    lined = classes.select("class", "group", "copies", "vector").mapInArrow(
        _cells(axes, reach), f"{_CLASS}, c0 int, c1 int, c2 int, lead double"
    )
    lined = row_numbers(lined, ["group"], ["c0", "c1", "c2", "lead", "class"], "place")
    number = F.xxhash64("group", F.floor((F.col("place") - 1) / tile))
    lined = stored(lined.withColumn("tile", number), "lined")
    tiles = lined.select("tile", "group", "class", "copies", "vector").groupBy("tile").applyInPandas(
        _boxes(axes), "tile long, `group` string, low array<double>, high array<double>, classes array<long>, copies array<long>, vectors array<double>"
    )
    tiles = stored(tiles, "tiles")
    cells = lined.select("tile", "group", "c0", "c1", "c2").distinct()
    pairs = stored(tile_pairs(tiles, cells, reach), "pairs")
    full = tiles.select("tile", "classes", "copies", "vectors")
    other = full.toDF("other", "other_classes", "other_copies", "other_vectors")
    met = pairs.join(full, "tile").join(other, "other")
    found = stored(met.mapInPandas(_compare(axes, threshold), "id long, root long, links long"), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())
    facts = classes.select("class", "group", "vector", "copies", "least").join(links.withColumnRenamed("id", "class"), "class", "left")
    facts = facts.join(comp.withColumnRenamed("id", "class"), "class", "left")
    facts = stored(
        facts.select("class", "group", "vector", "least", F.coalesce("component", "class").alias("component"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "facts",
    )
    named = facts.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = facts.join(named, "component").select("group", "vector", "n_links", "component_id")
    # A class is found again by its vector, as a digest of two hashes and the group.
    digest = F.struct(F.xxhash64("group", "vector"), F.xxhash64(F.lit(1), "group", "vector")).alias("digest")
    facts = stored(facts.select(digest, "n_links", F.col("component_id").alias("least")), "named")
    out = join_groups(members.select("row", "vec_id", digest), facts, "digest").select("vec_id", "n_links", "least")
    out = out.union(rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select(
        "vec_id", "n_links", F.col("least").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("least"), F.lit(False)).alias("kept"),
    )
