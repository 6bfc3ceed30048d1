"""Ranked lexical search by two trees: one over the items that ask, one over the documents that answer.

One pass over the documents keeps, of each, its number of terms and how often it holds the terms of the items; these counts give
the weights. An item is then a vector of weights and a document a vector of impacts, all whole numbers, and a score is their
product. Items are put in an order in which neighbours share their weightiest terms, and documents of a batch likewise; groups of
neighbours are leaves, and groups of groups the nodes above. A node holds the largest value of each coordinate below it, so the
product of an item node and a document node is a bound for every pair below them. Where it is under the weakest k-th best score
of the items of the node, the whole block of pairs is left out, which cannot change a result; the other blocks are opened, those with
the largest bounds first, and their pairs are scored exactly. The k-th scores rise as a task goes on through its batches.

Every task reads its documents once and hands on at most ``k`` rows per item. The items come in blocks of at most ``POSTINGS``
terms, which is what a task holds and what is broadcast; more items are more blocks.

Scores are products and sums of whole numbers in doubles; they are exact below 2^53, which 20,000 terms of the largest weight and
impact do not reach.

Defined results: texts that are null or without a term match nothing and do not count as documents; an item without a
match has no row. Rows that repeat an id are documents, or items, of their own; a null document id is the largest in ties. Only the
named columns are read; empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tileframe.llm.common import stored
from tileframe.operators.ordered import running_sums

K = 10
#: Distinct terms of the items of a block, summed over the items.
POSTINGS = 50_000
#: Documents of a leaf and leaves of a node; items of a leaf and leaves of a node.
DOC_LEAF, DOC_NODE, ITEM_LEAF, ITEM_NODE = 16, 8, 8, 8
#: Most documents of a batch, and most cells of its matrix.
_BATCH, _CELLS = 1024, 6_000_000
#: Characters that end a term become spaces, A to Z become small; all else, and all bytes beyond ASCII, belong to terms.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_FOUND = "item long, doc_id long, row long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        rows, terms, times = [], [], []
        for text in batch.column(1):
            counts = sorted(Counter(terms_of(text.as_py())).items())
            rows.append(row)
            terms.append([t for t, _ in counts])
            times.append([n for _, n in counts])
            row += 1
        columns = [pa.array(rows, pa.int64()), batch.column(0), pa.array(terms, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "item_id", "terms", "times"])


def _document_batches(vocabulary):
    """``doc_id, n, terms, times``: the length of every document with a term, and its terms that items ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            keys, sizes, terms, times = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found, counts = np.unique([known[w] for w in words if w in known], return_counts=True)
                keys.append(key)
                sizes.append(len(words))
                terms.append(found.astype(np.int32))
                times.append(counts.astype(np.int64))
            columns = [
                pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                pa.array(times, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return run


@dataclass(frozen=True)
class Items:
    """Items of a block in tree order: places of their terms, weights times repeats, and where each item's terms begin."""

    terms: np.ndarray
    weights: np.ndarray
    starts: np.ndarray


def in_tree_order(terms: list[np.ndarray], weights: list[np.ndarray]) -> list[int]:
    """An order in which items with the same weightiest terms are neighbours."""
    lead = [tuple(t[np.lexsort((t, -w))][:3]) for t, w in zip(terms, weights, strict=True)]
    return sorted(range(len(terms)), key=lambda i: lead[i])


def _maxima(matrix: np.ndarray, size: int) -> np.ndarray:
    """The largest value of each column in every run of ``size`` rows."""
    return np.maximum.reduceat(matrix, np.arange(0, len(matrix), size), axis=0)


class Best:
    """The best documents of each item so far, and their weakest scores."""

    def __init__(self, items: int, k: int):
        self.k, self.kept = k, [[] for _ in range(items)]
        #: A pair below this score can be left out; scores of 0 never count.
        self.least = np.ones(items)

    def offer(self, item: int, scores: np.ndarray, keys: list, rows: np.ndarray) -> None:
        kept = self.kept[item]
        kept += [(-int(s), key is None, key or 0, int(r)) for s, key, r in zip(scores, keys, rows, strict=True)]
        kept.sort()
        del kept[self.k :]
        if len(kept) == self.k:
            self.least[item] = max(1, -kept[-1][0])


class Search:
    """The dual-tree search of batches of documents for the items of a block."""

    def __init__(self, items: Items, k: int):
        self.items, self.count = items, len(items.starts) - 1
        self.best, self.scored = Best(self.count, k), 0

    def batch(self, keys: list, rows: np.ndarray, owner: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weight: np.ndarray) -> None:
        """``owner, terms, impacts``: the coordinates of the documents; ``weight``: the largest weight of each term."""
        columns, place = np.unique(terms, return_inverse=True)
        if not len(columns):
            return
        # Documents with the same weightiest coordinate become neighbours, those with more of it first.
        order = np.lexsort((terms, -impacts * weight[terms], owner))
        first = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
        lead, value = np.full(len(keys), -1), np.zeros(len(keys))
        lead[owner[first]], value[owner[first]] = terms[first], impacts[first]
        line = np.lexsort((-value, lead))
        spot = np.empty(len(keys), dtype=np.int64)
        spot[line] = np.arange(len(keys))
        docs = np.zeros((len(keys), len(columns)))
        docs[spot[owner], place] = impacts
        at = np.searchsorted(columns, self.items.terms)
        mine = (at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == self.items.terms)
        asked = np.zeros((self.count, len(columns)))
        asked[np.repeat(np.arange(self.count), np.diff(self.items.starts))[mine], at[mine]] = self.items.weights[mine]
        self._descend(asked, docs, [keys[i] for i in line], rows[line])

    def _descend(self, asked: np.ndarray, docs: np.ndarray, keys: list, rows: np.ndarray) -> None:
        item_leaves, doc_leaves = _maxima(asked, ITEM_LEAF), _maxima(docs, DOC_LEAF)
        item_nodes, doc_nodes = _maxima(item_leaves, ITEM_NODE), _maxima(doc_leaves, DOC_NODE)
        tops = doc_nodes @ item_nodes.T
        for node in np.argsort(-tops.max(axis=1), kind="stable"):
            least = np.minimum.reduceat(self.best.least, np.arange(0, self.count, ITEM_LEAF))
            weakest = np.minimum.reduceat(least, np.arange(0, len(least), ITEM_NODE))
            open_nodes = np.flatnonzero(tops[node] >= weakest)
            if not len(open_nodes):
                continue
            below = np.concatenate([np.arange(i * ITEM_NODE, min((i + 1) * ITEM_NODE, len(item_leaves))) for i in open_nodes])
            first = node * DOC_NODE
            bounds = doc_leaves[first : first + DOC_NODE] @ item_leaves[below].T
            for leaf in np.argsort(-bounds.max(axis=1), kind="stable"):
                least = np.minimum.reduceat(self.best.least, np.arange(0, self.count, ITEM_LEAF))
                open_leaves = below[bounds[leaf] >= least[below]]
                if len(open_leaves):
                    self._score(open_leaves, first + leaf, asked, docs, keys, rows)

    def _score(self, leaves: np.ndarray, leaf: int, asked: np.ndarray, docs: np.ndarray, keys: list, rows: np.ndarray) -> None:
        part = slice(leaf * DOC_LEAF, (leaf + 1) * DOC_LEAF)
        items = (leaves[:, None] * ITEM_LEAF + np.arange(ITEM_LEAF)).ravel()
        items = items[items < self.count]
        used = np.flatnonzero(docs[part].any(axis=0))
        scores = asked[np.ix_(items, used)] @ docs[part][:, used].T
        self.scored += scores.size
        hits = scores >= self.best.least[items][:, None]
        for i in np.flatnonzero(hits.any(axis=1)):
            here = np.flatnonzero(hits[i]) + part.start
            self.best.offer(items[i], scores[i, here - part.start], [keys[j] for j in here], rows[here])


def _search_batches(packed, documents: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, largest = packed.value
        search, row = Search(items, k), TaskContext.get().partitionId() << 40
        size = max(DOC_LEAF, min(_BATCH, _CELLS // max(1, len(weight))))
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
                terms = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                times = batch.column(3).flatten().to_numpy(zero_copy_only=False)
                m = 25 + (75 * batch.column(1).to_numpy(zero_copy_only=False) * documents) // total
                owner = np.repeat(np.arange(len(sizes)), sizes)
                impacts = (1_000_000_000 * times) // (1000 * times + 8 * m[owner])
                rows = np.arange(row, row + len(sizes))
                search.batch(batch.column(0).to_pylist(), rows, owner, terms, impacts.astype(float), largest)
                row += len(sizes)
        found = [(i, None if none else key, r, -s) for i, kept in enumerate(search.best.kept) for s, none, key, r in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[c] for x in found], pa.int64()) for c in range(4)], names=["item", "doc_id", "row", "score"]
        )

    return run


def _block(docs: DataFrame, asked: list, k: int) -> DataFrame | None:
    """Results for the collected items ``row, item_id, terms, times`` of a block, or None."""
    context = docs.sparkSession.sparkContext
    names = sorted({bytes(t) for r in asked for t in r["terms"]})
    vocabulary = {t: i for i, t in enumerate(names)}
    vectors = docs.mapInArrow(_document_batches(context.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, times array<long>")
    vectors = stored(vectors, "vectors")
    sums = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    documents, total = sums["documents"], sums["total"]
    if not documents:
        return None
    frequency = np.zeros(len(names), dtype=np.int64)
    # One line per term of the block.
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        frequency[r["t"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], dtype=float)
    terms = [np.array([vocabulary[bytes(t)] for t in r["terms"]], dtype=np.int64) for r in asked]
    values = [weight[t] * np.array(r["times"], dtype=float) for t, r in zip(terms, asked, strict=True)]
    order = in_tree_order(terms, values)
    items = Items(
        np.concatenate([terms[i] for i in order]), np.concatenate([values[i] for i in order]),
        np.concatenate([[0], np.cumsum([len(terms[i]) for i in order])]),
    )
    largest = np.zeros(len(names))
    np.maximum.at(largest, items.terms, items.weights)
    search = _search_batches(context.broadcast((items, weight, largest)), documents, total, k)
    found = vectors.where("size(terms) > 0").mapInArrow(search, _FOUND)
    named = docs.sparkSession.createDataFrame([(n, asked[i]["item_id"]) for n, i in enumerate(order)], "item long, item_id long")
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", postings: int = POSTINGS,
) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score``."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    asked = asked.mapInArrow(_item_batches, "row long, item_id long, terms array<binary>, times array<long>")
    asked = stored(asked.where("size(terms) > 0"), "items").withColumn("size", F.size("terms"))
    total = asked.agg(F.sum("size")).first()[0] or 0
    if total <= postings:
        parts = [asked] if total else []
    else:
        lined = stored(running_sums(asked, [], ["row"], {"upto": "size"}), "lined")
        number = F.floor((F.col("upto") - F.col("size")) / postings).cast("long")
        blocks = lined.select("row", "item_id", "terms", "times", number.alias("block"))
        parts = [blocks.where(F.col("block") == r["block"]) for r in blocks.select("block").distinct().orderBy("block").collect()]
    out = None
    for part in parts:
        block = _block(rows, part.orderBy("row").collect(), k)
        if block is not None:
            out = block if out is None else out.unionByName(block)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
