"""Approximate nearest neighbours by shifted space-filling curves.

Distinct vectors are projected to a few dimensions at random, moved by a random shift and put on a Hilbert curve, once
for each of several curves. Each curve is range-partitioned by Spark into a total order; a query looks at the vectors
within a window of places around its own on every curve, and what the windows hold is reranked by exact inner products.

The window is measured, not guessed: for a bounded sample of queries all true neighbours are found by comparing them
with every vector, and the window is the distance on the nearest curve that covers ``COVER`` of them. On clustered vectors it
is short; on vectors without structure no curve helps and it grows towards the whole order, which keeps recall.

Windows are read in blocks of bounded size. A first pass over the query's own blocks gives a lower bound for its k-th
score, and the second pass over the other blocks returns only what reaches it.

Equal vectors are one while searching; at the end they are expanded by smallest id. Defined results: ids or vectors
that are null, vectors that are empty, zero or hold null or non-finite numbers take no part; vectors of different lengths
never meet; repeated rows count once; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tileframe.llm.common import stored
from tileframe.operators.ordered import row_numbers

CURVES, DIMENSIONS, BITS = 4, 8, 7
BLOCK, QUERIES_PER_GROUP = 4096, 8192
#: Queries whose true neighbours set the window, and the share of these that it must cover.
SAMPLE, COVER = 96, 0.97
_SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits``-bit coordinates, one row per point.

    Coordinates are turned into the transposed index by undoing, level by level, the exchanges and inversions
    that the curve makes, and then interleaved."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            inverted = (x[i] & level) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where((x[n - 1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(vectors: np.ndarray, scale: float, curve: int) -> np.ndarray:
    """Keys of the vectors on one curve: projected, brought to (0, 1) by a logistic function, shifted."""
    rng = np.random.default_rng([_SEED, curve, vectors.shape[1]])
    directions = rng.standard_normal((vectors.shape[1], DIMENSIONS))
    shift = rng.random(DIMENSIONS)
    flat = 1 / (1 + np.exp(-np.clip(1.7 * (vectors @ directions) / scale, -40, 40)))
    cells = np.minimum(((flat + shift) * (1 << (BITS - 1))).astype(np.int64), (1 << BITS) - 1)
    return hilbert_keys(cells, BITS)


def _matrix(lists: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and vectors of an array of lists, by length."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        part = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        out.append((at, part.astype(np.float64).reshape(len(at), n)))
    return out


def _keys(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, vectors in _matrix(batch.column(1)):
                for curve in range(CURVES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), curve)), pa.array(curve_keys(vectors, scale, curve)), pa.array(uids[at])],
                        names=["curve", "key", "uid"],
                    )

    return run


def _best(scores: np.ndarray, ids: np.ndarray, firsts: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best scores, ties to the smaller first id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        pick = np.flatnonzero(scores >= least)
    else:
        pick = np.arange(len(scores))
    return pick[np.lexsort((firsts[pick], -scores[pick]))][:k]


def _compare(k: int):
    """Best vectors of a block for each of its queries; those below a query's bound are left out."""

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            uids, firsts = block["uid"].to_numpy(), block["first"].to_numpy()
            lengths = block["vector"].map(len).to_numpy()
            for n in np.unique(lengths):
                mine = np.flatnonzero(lengths == n)
                members = np.stack(block["vector"].to_numpy()[mine]).astype(np.float64)
                for quid, vector, bound in zip(queries["quid"], queries["qvector"], queries["bound"], strict=True):
                    if len(vector) != n:
                        continue
                    scores = np.einsum("ij,j->i", members, np.asarray(vector, dtype=np.float64))
                    near = np.flatnonzero(scores >= bound)
                    best = near[_best(scores[near], uids[mine][near], firsts[mine][near], k)]
                    out.append(
                        pd.DataFrame({"quid": quid, "uid": uids[mine][best], "first": firsts[mine][best], "score": scores[best]})
                    )
        empty = pd.DataFrame({"quid": [], "uid": [], "first": [], "score": []}).astype(
            {"quid": "int64", "uid": "int64", "first": "int64", "score": "float64"}
        )
        return pd.concat(out) if out else empty

    return run


_FOUND = "quid long, uid long, first long, score double"


def _true_neighbours(sample: list[tuple[int, list[float]]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = _compare(k)
        queries = pd.DataFrame({"quid": [s[0] for s in sample], "qvector": [s[1] for s in sample], "bound": -np.inf})
        for batch in batches:
            found = compare(queries, batch.to_pandas())
            yield pa.RecordBatch.from_pandas(found.astype({"quid": "int64", "uid": "int64", "first": "int64"}), preserve_index=False)

    return run


def _once(found: DataFrame) -> DataFrame:
    """One line per query and vector, from however many windows it came."""
    return found.groupBy("quid", "uid").agg(F.min("first").alias("first"), F.max("score").alias("score"))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("quid").orderBy(F.desc("score"), "first", "uid")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def _window(unique: DataFrame, places: DataFrame, k: int) -> int:
    """Places to look at on either side, from the true neighbours of a sample of queries."""
    sample = unique.where("asks").orderBy(F.xxhash64("uid")).limit(SAMPLE).select("uid", "vector").collect()
    rows = unique.select("uid", "vector", "first")
    true = _top(rows.mapInArrow(_true_neighbours([(r[0], list(r[1])) for r in sample], k), _FOUND), k)
    mine = places.select(F.col("uid").alias("quid"), F.col("curve").alias("qcurve"), F.col("place").alias("qplace"))
    # At most SAMPLE * k pairs.
    near = true.join(F.broadcast(mine.where(F.col("quid").isin([r[0] for r in sample]))), "quid").join(
        places, "uid"
    ).where("curve = qcurve")
    gaps = near.groupBy("quid", "uid").agg(F.min(F.abs(F.col("place") - F.col("qplace"))).alias("gap"))
    gaps = [r["gap"] for r in gaps.collect()]
    return max(2 * k, int(np.quantile(gaps, COVER, method="higher"))) if gaps else 2 * k


def _scan(queries: DataFrame, blocks: DataFrame, parts: int, k: int) -> DataFrame:
    """``queries``: ``quid, qvector, bound, curve, block``. Groups of one block and a bounded part of its queries."""
    dealt = queries.select(
        "quid", "qvector", "bound", F.col("curve").alias("qcurve"), F.col("block").alias("qblock"),
        F.pmod(F.xxhash64("quid"), F.lit(parts)).alias("qpart"),
    )
    copies = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    asked, held = dealt.groupBy("qcurve", "qblock", "qpart"), copies.groupBy("curve", "block", "part")
    return asked.cogroup(held).applyInPandas(_compare(k), _FOUND)


def search(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` found for each row whose id ``every`` divides."""
    raw = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    fine = F.expr(
        "id IS NOT NULL AND size(vector) > 0 AND exists(vector, x -> x <> 0) AND"
        " forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    rows = raw.where(F.coalesce(fine, F.lit(False))).distinct()
    asks = F.col("id") % every == 0
    unique = rows.groupBy("vector").agg(F.min("id").alias("first"), F.max(asks).alias("asks"))
    unique = stored(unique.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm = unique.agg(F.avg(square).alias("s"), F.count(F.lit(1)).alias("n")).first()
    if not norm["n"]:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    keyed = unique.select("uid", "vector").mapInArrow(_keys(norm["s"] ** 0.5), "curve long, key long, uid long")
    places = stored(row_numbers(keyed, ["curve"], ["key", "uid"], "place").select("curve", "uid", "place"), "places")
    # One place more than wanted: a query may find itself.
    window = _window(unique, places, k + 1)
    block = F.floor(F.col("place") / BLOCK).cast("long")
    full = places.join(unique, "uid").withColumn("block", block)
    blocks = stored(full.select("curve", "block", "place", "uid", "first", "vector", "asks"), "blocks")
    asking = blocks.where("asks").select(F.col("uid").alias("quid"), F.col("vector").alias("qvector"), "curve", "block", "place")
    members = blocks.select("curve", "block", "uid", "first", "vector")
    n_queries = unique.where("asks").count()
    near = _scan(asking.withColumn("bound", F.lit(float("-inf"))), members, 1, k + 1)
    near = stored(_top(_once(near), k + 1), "near")
    bounds = near.groupBy("quid").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).alias("bound"))
    last = (norm["n"] - 1) // BLOCK
    low = F.greatest(F.floor((F.col("place") - window) / BLOCK), F.lit(0)).cast("long")
    high = F.least(F.floor((F.col("place") + window) / BLOCK), F.lit(last)).cast("long")
    others = asking.withColumn("other", F.explode(F.sequence(low, high))).where("other <> block")
    others = others.drop("block").withColumnRenamed("other", "block").join(bounds, "quid", "left")
    others = others.withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    parts = max(1, -(-n_queries // QUERIES_PER_GROUP))
    far = _scan(others, members, parts, k + 1)
    best = stored(_top(_once(near.select("quid", "uid", "first", "score").union(far)), k + 1), "best")
    # Vectors become ids again, the smallest of equal ones first.
    ids = rows.join(unique.select("vector", "uid"), "vector").select("id", "uid")
    order = Window.partitionBy("uid").orderBy("id")
    few = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).select("id", "uid")
    wide = best.join(few, "uid").select("quid", "score", F.col("id").alias("first"), F.col("id").alias("uid"))
    wide = _top(wide, k + 1).select(F.col("quid"), "score", F.col("uid").alias("vec_id"))
    own = ids.where(asks).select(F.col("uid").alias("quid"), F.col("id").alias("query_id"))
    pairs = own.join(wide, "quid").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
