"""Exact Jaccard self-join of documents on word n-grams, by partitions of the universe.

A document's set are the 64-bit hashes of its distinct n-grams. Equal sets are one *class* from the start.
For classes X and Y with |X| >= |Y|, a Jaccard similarity of at least p / q means that they differ in at most
``H = (q - p) (|X| + |Y|) / (q + p)`` hashes. Sizes are cut into bands, and each band cuts the universe of
hashes into ``m`` segments by hash value. By the pigeonhole principle two linked classes of a band agree wholly on
segments, or up to one hash: with credits ``v + 1`` per segment (``v = 0``: whole agreement, ``v = 1``: agreement
up to one deletion on either side) that add up to more than ``H + spare``, at least ``spare + 1`` credits
meet. The number of segments, those with one-deletion neighbourhoods and the spare ones are chosen for each band
by expected cost from the sizes in the corpus (``allocate``). Empty segments say nothing; a class leaves them out of the
index as long as they are no more than its band's spare ones, which by the same count cannot lose a link.

A class is indexed in its own band and in the next ones where it can be the smaller side. The index is shuffled once, and the
number of classes of each key is counted there. A key of more than ``HOT`` classes is hot: a class leaves its hot segments out
(credit 0) as long as they are no more than the spare credits of its band that its empty segments do not use, so what is left
still adds up to more than ``H``, and by the same principle it shares one of the *other* keys with every class it links with. Classes that
are hot in more places than that, such as members of a group of near copies, keep them. Classes that share a key are candidates;
they are verified exactly on the whole sets.

Links are wanted for components, so a hot key never yields all its pairs. In rounds each class is compared with one class
only, a pivot of another component, components are formed, and a key whose classes are all in one component is done. The first
round takes the pivot with which a class shares most keys. Later ones, which only open keys reach, take the pivot with the nearest
sketch: the parities of a set's hashes by ``BITS`` cells. Two sketches differ in no more cells than the sets do in hashes, so pairs
whose sketches differ in more than a link allows need no comparison, and no link is lost by that. Rounds go on while the open keys
hold more pairs than there are classes and get fewer. What remains after the rounds (keys that still join several components) is
compared pairwise across components only, for sizes and sketches that can link, and no pair that is in doubt is left out. A pair
is formed where it first meets in the order of the keys, not at each of the many keys that it shares, and only if enough keys
follow there for a link.

Defined results: words are lower-cased in A-Z only; a text of fewer words than ``n`` is one n-gram; a null or empty
text has the empty set and links with nothing; rows with the same id are one document; a null id has no component; other
columns are not read; an empty table gives an empty table. Hashes of 64 bits stand for n-grams: two different ones
in one pair of documents coincide with a chance of about 1e-14 for texts of 500 words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tileframe.llm.common import stored, text_or_empty, words_of
from tileframe.llm.components import components
from tileframe.sources.workspace import discarded

N_WORDS, PERCENT = 4, 85
#: Bands grow by this factor; pivot rounds, at most, before components are compared pairwise.
GROWTH, ROUNDS = 1.18, 10
#: Classes of a key beyond which it is left out where the credits allow.
HOT = 8
#: Cells of a sketch, a multiple of 64.
BITS = 512
#: Keys of a class that tell whether a pair has met before.
FIRST = 8
_SMALL = 2_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_grams(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """``id``, the sorted distinct hashes ``grams``, and their 128-bit digest ``d1, d2``; built-in expressions only."""
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        words_of(F.translate(text_or_empty(text), _UPPER, _LOWER)).alias("w"),
    ).withColumn("k", F.size("w"))
    window = ", ".join(f"w[i + {j}]" for j in range(n))
    grams = f"""CASE WHEN k = 0 THEN cast(array() AS array<bigint>)
        WHEN k < {n} THEN array(xxhash64(w))
        ELSE array_distinct(transform(sequence(0, k - {n}), i -> xxhash64({window}))) END"""
    sets = rows.select("id", F.sort_array(F.expr(grams)).alias("grams"))
    return sets.select("id", "grams", F.xxhash64("grams").alias("d1"), F.xxhash64(F.lit(1), "grams").alias("d2"))


@dataclass(frozen=True)
class Band:
    """Sizes ``low`` to ``high`` of the larger side, and how its universe is cut."""

    low: int
    high: int
    segments: int
    deletions: int
    spare: int

    @property
    def left_out(self) -> int:
        """Empty segments that a class may leave out of the index: twice as many as are to be expected."""
        if self.deletions:
            return self.spare
        expected = self.segments * math.exp(-self.low / self.segments)
        return min(self.spare, math.ceil(2 * expected) + 1)

    @property
    def need(self) -> int:
        """Index keys that two linked classes share in this band, at the least."""
        return 1 + self.spare - self.left_out

    @property
    def slack(self) -> int:
        """Segments that a class may leave out besides its empty ones."""
        return 0 if self.deletions else self.need - 1


def most_apart(high: int, percent: int) -> int:
    """Hashes in which two linked classes of at most ``high`` can differ."""
    return (100 - percent) * 2 * high // (100 + percent)


def band_edges(largest: int) -> list[tuple[int, int]]:
    edges, low = [], 1
    while low <= largest:
        high = max(low, int(low * GROWTH))
        edges.append((low, high))
        low = high + 1
    return edges


def allocate(low: int, high: int, classes: int, percent: int) -> Band:
    """The cheapest cut of a band, in expected index rows and chance candidates per class.

    Hashes fall on segments at random, so a segment of a class of size ``low`` is empty with a chance that follows from
    the number of segments; classes with more empty segments than spare ones index them all, and meet each other."""
    apart = most_apart(high, percent)
    best = None
    for spare in range(0, 9):
        for deletions in range(0, min(3, apart + 1)):
            m = apart + 1 + spare - deletions
            if m < 1 or deletions > m:
                continue
            mean = low / m
            empties = m * math.exp(-mean)
            # Poisson tail beyond the spare ones.
            tail = max(0.0, 1 - sum(math.exp(-empties) * empties**i / math.factorial(i) for i in range(spare + 1)))
            rows = m + deletions * (high / m + 1)
            chance = tail * tail * empties * classes * math.exp(-mean)
            # A neighbourhood of a segment with one hash holds the empty segment's key.
            chance += deletions * classes * (mean + 1) ** 2 * math.exp(-2 * mean)
            cost = rows + 4 * chance
            if best is None or cost < best[0]:
                best = (cost, Band(low, high, m, deletions, spare))
    band = best[1]
    if not band.deletions:
        # Half as many segments again: linked classes then share many keys, and a count of keys spares most
        # comparisons of sets that are alike but not enough.
        spare = max(band.spare, (apart + 1) // 2)
        band = Band(low, high, apart + 1 + spare, 0, spare)
    return band


def plan_bands(sizes: list[tuple[int, int]], percent: int) -> list[Band]:
    """``sizes``: number of classes by band of ``band_edges``. One short line per band."""
    known = dict(sizes)
    largest = max(known, default=0)
    edges = band_edges(largest)
    counts = [0] * len(edges)
    for size, n in known.items():
        counts[next(i for i, (a, b) in enumerate(edges) if a <= size <= b)] += n
    return [allocate(a, b, c, percent) for (a, b), c in zip(edges, counts, strict=True)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def signature_keys(short: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, bands: list[Band], percent: int):
    """Index rows of many sets, as (band, positions of the sets, keys).

    ``short`` are all cut hashes, set by set, ``lengths`` how many each set has, ``sizes`` the sizes of the whole sets."""
    grams = _mixed(short.astype(np.uint64) + np.uint64(1))
    owner = np.repeat(np.arange(len(sizes)), lengths)
    own = np.searchsorted(np.array([b.low for b in bands]), sizes, side="right") - 1
    for number, band in enumerate(bands):
        # The smaller side of a link with a class of this band has at least so many hashes.
        least = -(-percent * band.low // 100)
        member = (own <= number) & (sizes >= least)
        if not member.any():
            continue
        use = member[owner]
        slot = (np.cumsum(member) - 1)[owner[use]]
        mine = grams[use]
        seg = (mine % np.uint64(band.segments)).astype(np.int64)
        cell = slot * band.segments + seg
        n_cells = int(member.sum()) * band.segments
        total = np.zeros(n_cells, dtype=np.uint64)
        np.add.at(total, cell, mine)
        count = np.bincount(cell, minlength=n_cells)
        who = np.repeat(np.flatnonzero(member), band.segments)
        place = np.tile(np.arange(band.segments, dtype=np.uint64), int(member.sum()))
        salt = _mixed((np.uint64(number + 1) << np.uint64(32)) + place)
        empties = (count == 0).reshape(-1, band.segments).sum(axis=1)
        keep = (count > 0) | np.repeat(empties > band.left_out, band.segments)
        if band.deletions:
            keep |= place < band.deletions
        yield number, who[keep], _mixed(total[keep] + salt[keep])
        if band.deletions:
            near = seg < band.deletions
            yield number, owner[use][near], _mixed(total[cell[near]] - mine[near] + salt[cell[near]])


def _index_batches(bands: list[Band], percent: int, bits: int):
    """``key, id, facts`` of every index row; ``facts`` is the size of the class times 256 plus the number of the band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, sizes = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                lists = part.column(2)
                short = lists.flatten().to_numpy(zero_copy_only=False)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                for number, who, keys in signature_keys(short, lengths, sizes, bands, percent):
                    keys = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    facts = sizes[who].astype(np.int64) * 256 + number
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[who]), pa.array(facts)], names=["key", "id", "facts"])

    return run


def key_bits(bands: list[Band], counts: list[int]) -> int:
    """Bits of a key, in whole bytes: 256 times as many values as there are index rows, so that chance brings few together.

    Keys that fall together by chance cost a comparison and change nothing."""
    rows = sum(n * (b.segments + b.deletions * b.high) * 3 for b, n in zip(bands, counts, strict=True))
    return min(56, max(32, -(-(max(1, rows).bit_length() + 8) // 8) * 8))


def _semi(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """The rows whose key is listed; the list (stored, unique) is broadcast if it has at most two million lines."""
    return rows.join(F.broadcast(ids) if ids.count() <= _SMALL else ids, on, "left_semi")


def _size_fits(percent: int) -> Column:
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id`` and the words of its sketch for each row ``id, grams``."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lists = part.column(1)
            grams = _mixed(lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64))
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            cell = owner * BITS + (grams >> np.uint64(32)).astype(np.int64) % BITS
            odd = np.bincount(cell, minlength=part.num_rows * BITS) & 1
            words = np.packbits(odd.astype(np.uint8).reshape(-1, BITS), axis=1).view(np.int64)
            columns = [part.column(0)] + [pa.array(np.ascontiguousarray(w)) for w in words.T]
            yield pa.RecordBatch.from_arrays(columns, names=["id"] + [f"w{i}" for i in range(len(columns) - 1)])


def with_sketches(sets: DataFrame) -> DataFrame:
    """``id, sketch`` of the sets ``id, grams``."""
    names = [f"w{i}" for i in range(BITS // 64)]
    words = sets.select("id", "grams").mapInArrow(_sketch_batches, "id long, " + ", ".join(f"{w} long" for w in names))
    return words.select("id", F.struct(*names).alias("sketch"))


def _cells_apart(x: str, y: str) -> Column:
    """In how many cells two sketches differ: at most as many as their sets differ in hashes."""
    return reduce(add, [F.bit_count(F.col(f"{x}.w{i}").bitwiseXOR(F.col(f"{y}.w{i}"))) for i in range(BITS // 64)])


def _sketch_fits(percent: int, apart: Column) -> Column:
    """Whether sets of the sizes ``na, nb`` that differ in ``apart`` hashes or more can reach the similarity."""
    return (100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of ids (stored) whose sets (``id, grams``) reach the similarity, on the whole sets.

    Up to two million pairs are broadcast to the sets of their first ends, which then move only once, to those of the second."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = left.join(F.broadcast(pairs) if pairs.count() <= _SMALL else pairs, "a").join(right, "b")
    joint = F.size(F.array_intersect("ga", "gb"))
    union = F.size("ga") + F.size("gb") - joint
    return both.where(100 * joint >= percent * union).select("a", "b")


def candidate_rows(classes: DataFrame, percent: int) -> DataFrame | None:
    """``key, id, n, need`` of all index rows whose key several classes share, without hot segments that can be left out.

    ``classes`` has ``id, n, short``, where ``short`` are the hashes cut to 32 bits. Cutting can only bring sets closer, so no
    link is lost by it. ``need`` is how many keys a class shares with each of its links, at the least."""
    sizes = classes.groupBy("n").count().collect()
    if not sizes:
        return None
    bands = plan_bands([(r["n"], r["count"]) for r in sizes], percent)
    counts = [sum(r["count"] for r in sizes if b.low <= r["n"] <= b.high) for b in bands]
    rows = classes.select("id", "n", "short").mapInArrow(
        _index_batches(bands, percent, key_bits(bands, counts)), "key long, id long, facts long"
    )
    found = rows.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("size > 1")
    found = stored(
        found.select("key", "id", "facts", (F.col("size") > HOT).alias("hot")), "candidates"
    )
    band = (F.col("facts") % 256).cast("int")
    slack = F.element_at(F.array(*[F.lit(b.slack) for b in bands]), band + 1)
    need = F.element_at(F.array(*[F.lit(b.need) for b in bands]), band + 1)
    # One row per class and band with hot segments.
    hot = found.where("hot").groupBy("id", "facts").agg(F.count(F.lit(1)).alias("left_out"))
    hot = stored(hot.where(F.col("left_out") <= slack), "left-out")
    small = F.broadcast(hot) if hot.count() <= _SMALL else hot
    kept = found.join(small, ["id", "facts"], "left").where("NOT hot OR left_out IS NULL")
    kept = kept.select(
        "key", "id", F.floor(F.col("facts") / 256).cast("int").alias("n"),
        (need - F.coalesce("left_out", F.lit(0))).cast("int").alias("need"),
    )
    kept = stored(kept, "kept")
    discarded(found)
    return kept


def _still_open(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``key, id, n, need, component`` of the keys that still hold classes of several components."""
    small = F.broadcast(comp) if comp.count() <= _SMALL else comp
    named = rows.select("key", "id", "n", "need").join(small, "id", "left")
    named = named.select("key", "id", "n", "need", F.coalesce("component", "id").alias("component"))
    several = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return stored(_semi(named, stored(several.select("key"), "keys"), "key"), "open")


def best_pivots(rows: DataFrame, turn: int) -> DataFrame:
    """``a, b``: each class with the pivot of another component with which it shares most keys, at most one pair per class.

    A key's pivot is one of its classes, another one in each turn; ``rows`` has ``key, id, need, component``."""
    order = F.col("id") if not turn else F.xxhash64("id", F.lit(turn))
    pivots = rows.groupBy("key").agg(F.min_by(F.struct("id", "component"), order).alias("p"))
    met = rows.join(pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.component").alias("other")), "key").where("component <> other")
    shared = met.groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("c"), F.min("need").alias("need")).where("c >= need")
    best = shared.groupBy("id").agg(F.max(F.struct("c", (-F.col("pivot")).alias("p")))["p"].alias("p"))
    pivot = -F.col("p")
    return best.select(F.least("id", pivot).alias("a"), F.greatest("id", pivot).alias("b")).distinct()


def nearest_pivots(rows: DataFrame, sketches: DataFrame, turn: int, percent: int) -> DataFrame:
    """``a, b`` as from ``best_pivots``: each class with the pivot whose sketch is nearest, where it allows a link."""
    pivots = rows.groupBy("key").agg(F.min_by(F.struct("id", "n", "component"), F.xxhash64("id", F.lit(turn))).alias("p"))
    pivots = pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.n").alias("nb"), F.col("p.component").alias("other"))
    pivots = _sketched(pivots, sketches, "pivot", "t")
    mine = _sketched(rows.select("key", "id", F.col("n").alias("na"), "component"), sketches, "id", "s")
    met = mine.join(pivots, "key").where("component <> other").where(_size_fits(percent))
    met = met.select("id", "pivot", "na", "nb", _cells_apart("s", "t").alias("apart")).where(_sketch_fits(percent, F.col("apart")))
    best = met.groupBy("id").agg(F.min(F.struct("apart", "pivot"))["pivot"].alias("pivot"))
    return best.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def _sketched(rows: DataFrame, sketches: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the sketches of the ids in ``key``; broadcast if there are at most half a million, of 72 bytes each."""
    named = sketches.select(F.col("id").alias(key), F.col("sketch").alias(name))
    return rows.join(F.broadcast(named) if sketches.count() <= _SMALL // 4 else named, key)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the pairs, stored; only the sets that take part are moved."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    return stored(verified(pairs, _semi(sets, stored(ids, "ids"), "id"), percent), "links")


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components with more links, stored. Only the new links between known components are worked on again."""
    if comp is None:
        return stored(components(links), "components")
    small = F.broadcast(comp) if comp.count() <= _SMALL else comp
    for end in ("a", "b"):
        links = links.join(small.toDF(end, "_c"), end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    more = stored(components(links.select("a", "b")), "more")
    grown = comp.join(more.toDF("component", "_c"), "component", "left").select("id", F.coalesce("_c", "component").alias("component"))
    return stored(grown.union(more.join(comp.select("id"), "id", "left_anti")), "components")


def link_components(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``id, component`` of the classes with links. ``candidates`` from ``candidate_rows``, ``sets``: ``id, grams``."""
    rows, comp, sketches = candidates.withColumn("component", F.col("id")), None, None
    # As many pairs as classes may be compared one by one at the end.
    enough, before = candidates.select("id").distinct().count(), None
    for turn in range(ROUNDS):
        if turn == 1:
            sketches = stored(with_sketches(_semi(sets, stored(rows.select("id").distinct(), "ids"), "id")), "sketches")
        chosen = nearest_pivots(rows, sketches, turn, percent) if turn else best_pivots(rows, turn)
        comp = _merged(comp, _verify(chosen, sets, percent))
        rows = _still_open(rows, comp)
        pairs = rows.groupBy("key").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0] or 0
        if pairs <= enough or (turn and pairs > 0.95 * before):
            break
        before = pairs
    pairs = stored(meeting_pairs(rows, sketches, percent), "pairs")
    if pairs.isEmpty():
        return comp
    return _merged(comp, _verify(pairs, sets, percent))


def key_lists(rows: DataFrame) -> DataFrame:
    """``id, n, component, need, keys`` of the classes of ``rows``, with their different keys in order.

    ``need`` is how many *different* keys a class shares with each of its links, or more."""
    lists = rows.groupBy("id").agg(
        F.first("n").alias("n"), F.first("component").alias("component"), F.min("need").alias("need"),
        F.count(F.lit(1)).cast("int").alias("rows"), F.array_sort(F.collect_set("key")).alias("keys"),
    )
    return lists.select("id", "n", "component", (F.col("need") - F.col("rows") + F.size("keys")).alias("need"), "keys")


def first_meetings(lists: DataFrame, sketches: DataFrame | None, percent: int) -> DataFrame:
    """``a, b`` of classes of different components that can link, met at the first key that they share.

    At that key both have as many keys to come, itself included, as they share, so it is enough to look at places with ``need``
    keys to come. A pair is passed over if the ``FIRST`` keys of both hold an earlier meeting; few pairs come twice."""
    rows = lists.select(
        "id", "n", "component", "need", F.slice("keys", 1, FIRST).alias("first"), F.size("keys").alias("k"), F.posexplode("keys").alias("at", "key")
    ).withColumn("rest", F.col("k") - F.col("at")).drop("k", "at")
    fits = F.expr("a < b AND ca <> cb AND least(ra, rb) >= least(wa, wb)") & _size_fits(percent)
    if sketches is not None:
        rows = _sketched(rows, sketches, "id", "s")
        fits = fits & _sketch_fits(percent, _cells_apart("s", "t"))
    fits = fits & F.coalesce(F.array_min(F.array_intersect("fa", "fb")) >= F.col("key"), F.lit(True))
    left = rows.withColumnsRenamed({"id": "a", "component": "ca", "n": "na", "need": "wa", "rest": "ra", "first": "fa"})
    right = rows.withColumnsRenamed({"id": "b", "component": "cb", "n": "nb", "need": "wb", "rest": "rb", "first": "fb", "s": "t"})
    return left.join(right, "key").where(fits).select("a", "b")


def meeting_pairs(rows: DataFrame, sketches: DataFrame | None, percent: int) -> DataFrame:
    """``a, b`` of all classes of different components that share as many keys as a link needs. ``rows``: ``key, id, n, need, component``."""
    lists = stored(key_lists(rows), "lists")
    met = stored(first_meetings(lists, sketches, percent).distinct(), "met")
    left = lists.select(F.col("id").alias("a"), F.col("need").alias("wa"), F.col("keys").alias("ka"))
    right = lists.select(F.col("id").alias("b"), F.col("need").alias("wb"), F.col("keys").alias("kb"))
    both = left.join(F.broadcast(met) if met.count() <= _SMALL else met, "a").join(right, "b")
    return both.where(F.size(F.array_intersect("ka", "kb")) >= F.least("wa", "wb")).select("a", "b")


def join_ngrams(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, and ``component_id``, the smallest id reachable by links."""
    grams = with_grams(docs, key, text, n)
    short = F.expr("transform(grams, x -> cast(x & 2147483647L as int))")
    rows = stored(
        grams.select(
            F.monotonically_increasing_id().alias("row"), "id", F.size("grams").alias("n"), "d1", "d2", short.alias("short")
        ),
        "rows",
    )
    thin = stored(rows.select("row", F.col("id").alias("doc_id"), "n", "d1", "d2"), "thin")
    heads = thin.where("n > 0").groupBy("d1", "d2").agg(
        F.min("row").alias("id"), F.min_by("doc_id", "row").alias("head"), F.count(F.lit(1)).alias("copies")
    )
    heads = stored(heads, "classes")
    # One row per class: the first of its rows.
    classes = rows.where("n > 0").drop("id").withColumnRenamed("row", "id")
    classes = _semi(classes, stored(heads.select("id"), "ids"), "id")
    candidates = candidate_rows(classes, percent)
    # The hashes of all sets have served; those of the candidates are written anew, in full.
    discarded(rows)
    comp = None
    if candidates is not None:
        wanted = stored(candidates.select("id").distinct().join(heads, "id").select("id", "head", "d1", "d2"), "wanted")
        again = thin.where("n > 0").groupBy("doc_id", "d1", "d2").count().where("count > 1")
        sets = _whole_sets(docs, key, text, n, wanted, not again.isEmpty())
        comp = link_components(candidates, sets, percent)
    named = thin.join(heads.select(F.col("id").alias("class"), "d1", "d2"), ["d1", "d2"], "left")
    if comp is not None:
        named = named.join(comp.withColumnRenamed("id", "class"), "class", "left")
        named = named.withColumn("class", F.coalesce("component", "class"))
    named = named.withColumn("class", F.when(F.col("n") > 0, F.col("class")))
    named = stored(named.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "class"), "named")
    smallest = named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    return named.join(smallest, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def _whole_sets(
    docs: DataFrame, key: str, text: str, n: int, wanted: DataFrame, repeated: bool
) -> DataFrame:
    """``id, grams`` of the wanted classes, hashed again from the texts of their first documents."""
    ids = stored(wanted.select(F.col("head").alias("_head")).distinct(), "heads")
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("_head"), F.col(f"`{text}`").alias("_text"))
    # A class without any id has the null head, which joins only by its digest.
    known = _semi(texts, ids.where("_head IS NOT NULL"), "_head")
    if not ids.where("_head IS NULL").isEmpty():
        known = known.union(texts.where("_head IS NULL"))
    grams = with_grams(known, "_head", "_text", n)
    right = wanted.select("id", F.col("head").alias("_h"), F.col("d1").alias("_1"), F.col("d2").alias("_2"))
    right = F.broadcast(right) if wanted.count() <= _SMALL else right
    on = F.col("_id").eqNullSafe(F.col("_h")) & (F.col("d1") == F.col("_1")) & (F.col("d2") == F.col("_2"))
    joined = grams.withColumnRenamed("id", "_id").join(right, on).select("id", "grams")
    if repeated:
        # Repeated rows give the same set again; one of them is kept.
        joined = joined.groupBy("id").agg(F.first("grams").alias("grams"))
    return stored(joined, "sets")


def distinct_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component of rows the one with the smallest id.

    Rows are judged by their own text, also where several rows have one id or none: of equal ids, and of rows without an id,
    which come last, any one row of the component stays, and only one. Rows without words link with nothing and stay, as
    does every row whose text no other row comes near."""
    ids = docs.select(F.col(f"`{key}`").cast("long").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    if ids.where("rows > 1 OR id IS NULL").isEmpty():
        joined = join_ngrams(docs, key, text, n, percent)
        gone = stored(joined.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        rows = docs.select(whole, F.col(f"`{key}`").cast("long").alias("_gone"))
    else:
        # Rows get a number of their own, written with them so that it stays.
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
        rows = stored(docs.select(whole, F.monotonically_increasing_id().alias("_gone")), "numbered")
        texts = rows.select("_gone", F.col(f"_row.`{text}`").alias("text"), F.col(f"_row.`{key}`").cast("long").alias("id"))
        joined = stored(join_ngrams(texts, "_gone", "text", n, percent), "components")
        # Only components of several rows have anything to decide.
        several = joined.where("doc_id <> component_id").select("component_id").distinct()
        members = joined.join(several, "component_id").select(F.col("doc_id").alias("_gone"), "component_id")
        members = stored(members.join(texts.select("_gone", "id"), "_gone"), "members")
        stays = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "_gone"))["_gone"].alias("_stays"))
        gone = stored(members.join(stays, "component_id").where("_gone <> _stays").select("_gone"), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= _SMALL else gone, "_gone", "left_anti").select("_row.*")
