"""Document scores by masked pseudo-likelihood.

Every word is predicted from the two words before and the two after it, never from itself, by a small network: one
embedding table for each of the four places, their sum through tanh, and a softmax in three steps: class, then word or
hashed group of words within the class, then word within the group. A document's score is the sum of the conditional
log-probabilities of its words, and the probabilities of all words of the corpus sum to one in every context.

All words are counted in a stored table. The network has an output for each of the most frequent words: ``VOCABULARY``, or as
many as are counted at least ``sqrt(tokens) / ROOT_SHARE`` times if these are more, so that it grows with the root of the
corpus. Other words meet the network as one of ``HASHED`` groups, and have their share of the group's count as
probability within the group; the tasks know the counts of up to ``COUNTED`` next words, and the sums of the logarithms of all
others come from a join with the count table, so no word is cut off.

Texts are numbered once, and the numbers stored. Training is data parallel: each task starts from the same seeded network
and learns from its own part of every document's windows with numpy; the networks are then averaged, weighted by what they
have seen, in groups of bounded size until one is left. The driver only receives the frequent words and one network.

Every word of every document is a training target once, and every word is scored.

Defined results: words are runs of characters other than ASCII white space; a null or empty text has no words, score 0 and
no mean; null keys and repeated rows are scored like others; only the named columns are read; texts of any length
are scored whole, in slices; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import stored, text_or_empty, words_of

VOCABULARY, HASHED, CLASS_SIZE, ROOT_SHARE = 4096, 256, 64, 8
COUNTED = 65_536  # at most so many words after the vocabulary whose counts the tasks know without a join
WIDTH, OFFSETS = 16, (-2, -1, 1, 2)
BATCH, RATE = 4096, 0.1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CHUNK, _TOGETHER, _SEED = 16_384, 64, 5
_SCORED, _BLOCK, _BUNDLE, _LARGE = 16_384, 1024, 16, 60  # words scored at once; rows, classes of a block; logits that need a shift


def _shapes(outputs: int) -> tuple:
    """Name and shape of the parameters, in the order in which they are laid out. The last row of ``embed`` is the pad; the last
    of the ``WIDTH + 1`` rows of weights is the bias."""
    classes = outputs // CLASS_SIZE
    return (
        ("embed", (len(OFFSETS), outputs + 1, WIDTH)),
        ("classes", (WIDTH + 1, classes)),
        ("words", (classes, WIDTH + 1, CLASS_SIZE)),
    )


class Network:
    """The window network; ``flat`` holds all parameters."""

    def __init__(self, flat: np.ndarray, outputs: int = VOCABULARY + HASHED):
        self.flat, self.outputs, self.parts, at = flat, outputs, {}, 0
        for name, shape in _shapes(outputs):
            size = int(np.prod(shape))
            self.parts[name] = flat[at : at + size].reshape(shape)
            at += size

    @staticmethod
    def fresh(outputs: int = VOCABULARY + HASHED) -> Network:
        rng, sizes = np.random.default_rng(_SEED), [int(np.prod(shape)) for _, shape in _shapes(outputs)]
        net = Network(np.zeros(sum(sizes), dtype=np.float32), outputs)
        embed, classes, words = net.parts.values()
        embed[:] = 0.1 * rng.standard_normal(embed.shape)
        classes[:] = 0.1 * rng.standard_normal(classes.shape)
        words[:, :WIDTH] = 0.1 * rng.standard_normal((len(words), WIDTH, CLASS_SIZE))
        classes[WIDTH] = 0
        return net

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """With a column of ones, which meets the bias."""
        h = np.ones((len(context), WIDTH + 1), dtype=np.float32)
        total = self.parts["embed"][0].take(context[:, 0], axis=0)
        for j in range(1, len(OFFSETS)):
            total += self.parts["embed"][j].take(context[:, j], axis=0)
        np.tanh(total, out=h[:, :WIDTH])
        return h

    def log_probability(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target word given its context of four."""
        order = _order(target, self.outputs)
        h, sorted_ = self.hidden(context[order]), target[order]
        group, place, rows = sorted_ // CLASS_SIZE, sorted_ % CLASS_SIZE, np.arange(len(sorted_))
        found = np.empty(len(h))
        for at in range(0, len(h), _BLOCK):
            found[at : at + _BLOCK] = _log_share(h[at : at + _BLOCK] @ self.parts["classes"], group[at : at + _BLOCK])
        logits = np.empty((len(h), CLASS_SIZE), dtype=np.float32)
        for c, some in _runs(group):
            np.matmul(h[some], self.parts["words"][c], out=logits[some])
        found += _log_share(logits, place)
        out = np.empty(len(rows))
        out[order] = found
        return out

    def learn(self, context: np.ndarray, target: np.ndarray, squares: Network) -> None:
        """One step of Adagrad on a batch; ``squares`` collects the squared gradients."""
        n, classes = len(target), self.parts["classes"]
        order = _order(target, self.outputs)
        context, target = context[order], target[order]
        h = self.hidden(context)
        group, place = target // CLASS_SIZE, target % CLASS_SIZE
        dh, gradient, back = np.empty((n, WIDTH), dtype=np.float32), np.zeros_like(classes), classes[:WIDTH].T.copy()
        for at in range(0, n, _BLOCK):
            some = slice(at, at + _BLOCK)
            d = _surplus(h[some] @ classes, group[some])
            np.matmul(d, back, out=dh[some])
            gradient += h[some].T @ d
        self._step(("classes", ...), ..., gradient / n, squares)
        runs = list(_runs(group))
        for at in range(0, len(runs), _BUNDLE):
            self._learn_words(h, runs[at : at + _BUNDLE], place, dh, squares)
        dh *= (1 - h[:, :WIDTH] * h[:, :WIDTH]) / n
        for j in range(len(OFFSETS)):
            order = _order(context[:, j], self.outputs + 1)
            seen = context[:, j].take(order)
            first = _starts(seen)
            # Pairs of floats are added as one complex number: the same sums in half the steps.
            sums = np.add.reduceat(dh.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
            self._step(("embed", j), seen.take(first), sums, squares)

    def _learn_words(self, h: np.ndarray, runs: list[tuple[int, slice]], place: np.ndarray, dh: np.ndarray, squares: Network) -> None:
        """The words of a few classes, small enough together for a processor's cache; their share is added to ``dh``."""
        words, start, end = self.parts["words"], runs[0][1].start, runs[-1][1].stop
        d = np.empty((end - start, CLASS_SIZE), dtype=np.float32)
        across, gradient = np.empty((end - start, WIDTH), dtype=np.float32), np.empty((len(runs), WIDTH + 1, CLASS_SIZE), dtype=np.float32)
        inner = [slice(some.start - start, some.stop - start) for _, some in runs]
        for (c, some), here in zip(runs, inner, strict=True):
            np.matmul(h[some], words[c], out=d[here])
        _surplus(d, place[start:end])
        for i, ((c, some), here) in enumerate(zip(runs, inner, strict=True)):
            np.matmul(d[here], words[c, :WIDTH].T, out=across[here])
            np.matmul(h[some].T, d[here], out=gradient[i])
        dh[start:end] += across
        gradient /= len(h)
        first, last = runs[0][0], runs[-1][0]
        at = slice(first, last + 1) if last - first + 1 == len(runs) else [c for c, _ in runs]
        self._step(("words", ...), at, gradient, squares)

    def _step(self, part: tuple, at, gradient: np.ndarray, squares: Network) -> None:
        name, j = part
        weights, sums = self.parts[name][j], squares.parts[name][j]
        several = isinstance(at, np.ndarray)
        past = gradient * gradient
        past += sums.take(at, axis=0) if several else sums[at]
        sums[at] = past
        np.sqrt(past, out=past)
        past += 1e-6
        np.divide(gradient, past, out=past)
        past *= RATE
        weights[at] = (weights.take(at, axis=0) if several else weights[at]) - past


def _order(ids: np.ndarray, limit: int) -> np.ndarray:
    """A stable order; numbers of 16 bits are sorted by radix."""
    return np.argsort(ids.astype(np.uint16) if limit <= 1 << 16 else ids, kind="stable")


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])[: len(sorted_)])


def _runs(sorted_: np.ndarray) -> Iterator[tuple[int, slice]]:
    first = _starts(sorted_)
    ends = [*first[1:].tolist(), len(sorted_)]
    for c, start, end in zip(sorted_[first].tolist(), first.tolist(), ends, strict=False):
        yield c, slice(start, end)


def _bounded(logits: np.ndarray) -> np.ndarray:
    """The same up to a shift of each row, if there are any that a float's ``exp`` might not hold; in place."""
    if max(logits.max(initial=0), -logits.min(initial=0)) > _LARGE:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _sums(rows: np.ndarray) -> np.ndarray:
    return rows @ np.ones(rows.shape[1], dtype=rows.dtype)


def _surplus(logits: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Softmax less one at the right place of each row, in place."""
    d = np.exp(_bounded(logits), out=logits)
    d *= (1 / _sums(d))[:, None]
    d[np.arange(len(d)), right] -= 1
    return d


def _log_share(logits: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax at the right place of each row; ``logits`` are overwritten."""
    own = _bounded(logits)[np.arange(len(logits)), right].astype(np.float64)
    return own - np.log(_sums(np.exp(logits, out=logits)).astype(np.float64))


@dataclass
class Vocabulary:
    """The frequent words by number; the counts of the next ones; groups of all others than the frequent by their hash, each with
    the sum of its words' counts."""

    words: list[str]
    counted: dict[str, int]
    groups: list[int]
    outputs: int


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``w, count`` of every word, stored."""
    return stored(docs.select(F.explode(words_of(text_or_empty(text))).alias("w")).groupBy("w").count(), "words")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The frequent words, ties by the word, and the counts of those that it does not hold.

    The driver gets the number of words by count, of which there are at most about the root of twice the tokens, and no more words
    than the vocabulary holds; only if the last frequent ones tie does a part send as many."""
    by_count = sorted((r["count"], r["words"]) for r in counts.groupBy("count").agg(F.count("*").alias("words")).collect())[::-1]
    least = max(2, math.ceil(math.sqrt(sum(n * words for n, words in by_count)) / ROOT_SHARE))
    often = sum(words for n, words in by_count if n >= least)
    size = max(VOCABULARY, -(-often // CLASS_SIZE) * CLASS_SIZE)
    held, last, known = 0, 1, math.inf  # the least count of a frequent word, and that of a counted one
    for n, words in by_count:
        if held < size:
            last = n
        held += words
        if held <= size + COUNTED:
            known = n
    top = counts.where(F.col("count") >= last).orderBy(F.desc("count"), "w").limit(size).collect()
    others = counts.where("false")
    if len(top) == size:
        n, w = F.lit(top[-1]["count"]), F.lit(top[-1]["w"])
        others = counts.where((F.col("count") < n) | ((F.col("count") == n) & (F.col("w") > w)))
    groups = [0] * HASHED
    group = F.pmod(F.crc32(F.col("w").cast("binary")), F.lit(HASHED))
    for r in others.groupBy(group.alias("g")).agg(F.sum("count").alias("n")).collect():
        groups[r["g"]] = r["n"]
    counted = {r["w"]: r["count"] for r in others.where(F.col("count") >= known).collect()} if known < math.inf else {}
    rest = others.where(F.col("count") < known) if known < math.inf else others
    return Vocabulary([r["w"] for r in top], counted, groups, size + HASHED), rest


class Numbering(dict):
    """Word to number; words that the vocabulary only counts are numbered after its outputs, all others get a hashed group."""

    def __init__(self, known: Vocabulary):
        super().__init__((w, i) for i, w in enumerate(known.words))
        self.first = known.outputs - HASHED
        self.update((w, known.outputs + i) for i, w in enumerate(known.counted))

    def __missing__(self, word: str) -> int:
        return self.first + zlib.crc32(word.encode()) % HASHED

    def outputs(self, known: Vocabulary) -> np.ndarray:
        """The network's output for each number."""
        return np.array([*range(known.outputs), *map(self.__missing__, known.counted)], dtype=np.int32)


def _offsets(ends) -> pa.Array:
    """Of lists that end there; more than 2**31 entries are refused."""
    return pa.array([0, *ends], pa.int32())


def _numbered(known: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, row = Numbering(known), TaskContext.get().partitionId() << 33
        output, logs = number.outputs(known), np.zeros(known.outputs + len(known.counted))
        logs[known.outputs :] = np.log([*known.counted.values()])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found, rare, counts, ends = [], [], [], []
                for text in part.column(1).to_pylist():
                    words = _WORD.findall(text)
                    found.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                    beyond = np.flatnonzero((found[-1] >= number.first) & (found[-1] < known.outputs))
                    rest = Counter(map(words.__getitem__, beyond.tolist()))
                    rare.extend(rest)
                    counts.extend(rest.values())
                    ends.append(len(rare))
                sizes, found = [len(x) for x in found], np.concatenate(found)
                adds = np.bincount(np.repeat(np.arange(len(sizes)), sizes), logs[found], len(sizes))
                rest = pa.StructArray.from_arrays([pa.array(rare, pa.string()), pa.array(counts, pa.int64())], names=["w", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(row, row + part.num_rows), pa.int64()), part.column(0),
                        pa.ListArray.from_arrays(_offsets(np.cumsum(sizes)), pa.array(output[found])),
                        pa.array(adds, pa.float64()), pa.ListArray.from_arrays(_offsets(ends), rest),
                    ],
                    names=["row", "doc_id", "ids", "add", "rest"],
                )
                row += part.num_rows

    return run


def numbered(docs: DataFrame, known: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row, stored: a number of its own, ``doc_id``, the numbers of its words, the summed logarithms of the counts that the
    vocabulary holds of the words after the frequent ones, and the words beyond, which it does not hold."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    schema = "row long, doc_id long, ids array<int>, add double, rest array<struct<w: string, n: bigint>>"
    return stored(rows.mapInArrow(_numbered(known), schema), "numbered")


def windows(texts: pa.ListArray, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words with two pads around each text, the places of the words, and the text of each."""
    sizes = np.diff(texts.offsets.to_numpy()).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(owner)) + 4 * owner + 2
    ids = np.full(len(owner) + 4 * len(sizes), pad, dtype=np.int64)
    ids[places] = texts.flatten().to_numpy()
    return ids, places, owner


def _context(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([ids[at + o] for o in OFFSETS], axis=1)


def _train(outputs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.fresh(outputs)
        squares = Network(np.zeros_like(net.flat), outputs)
        seen, shard = 0, TaskContext.get().partitionId()
        rng = np.random.default_rng(_SEED)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                ids, places, _ = windows(batch.column(0).slice(start, 256), outputs)
                places = rng.permutation(places)
                for at in range(0, len(places), BATCH):
                    some = places[at : at + BATCH]
                    net.learn(_context(ids, some), ids[some], squares)
                seen += len(places)
        if seen:
            chunks = [net.flat[i : i + _CHUNK].tobytes() for i in range(0, len(net.flat), _CHUNK)]
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n), pa.array(range(n)), pa.array([seen] * n), pa.array(chunks, pa.binary())],
                names=["shard", "chunk", "seen", "part"],
            )

    return run


def _average(nets: pd.DataFrame) -> pd.DataFrame:
    nets = nets.sort_values("shard")
    parts = np.stack([np.frombuffer(p, dtype=np.float32) for p in nets["part"]])
    mean = np.average(parts, axis=0, weights=nets["seen"].to_numpy()).astype(np.float32)
    first = nets.iloc[0]
    return pd.DataFrame(
        {"shard": [first["shard"] // _TOGETHER], "chunk": [first["chunk"]], "seen": [nets["seen"].sum()], "part": [mean.tobytes()]}
    )


def train(rows: DataFrame, outputs: int) -> np.ndarray | None:
    """The averaged network of all tasks as one array, or None if there is no word."""
    schema = "shard long, chunk long, seen long, part binary"
    nets = stored(rows.select("ids").mapInArrow(_train(outputs), schema), "networks")
    shards = nets.agg(F.max("shard")).first()[0]
    if shards is None:
        return None
    while shards > 0:
        groups = nets.groupBy("chunk", F.floor(F.col("shard") / _TOGETHER))
        nets, shards = stored(groups.applyInPandas(lambda rows: _average(rows), schema), "networks"), shards // _TOGETHER
    return np.concatenate([np.frombuffer(r["part"], dtype=np.float32) for r in nets.orderBy("chunk").collect()])


def score_texts(texts: pa.ListArray, net: Network, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log-probability of each text; ``shares`` is added by number of a word."""
    ids, places, owner = windows(texts, net.outputs)
    total = np.zeros(len(texts))
    for at in range(0, len(places), _SCORED):
        some = places[at : at + _SCORED]
        found = net.log_probability(_context(ids, some), ids[some]) + shares[ids[some]]
        total += np.bincount(owner[at : at + _SCORED], found, len(texts))
    return np.bincount(owner, minlength=len(texts)), total


def _score(groups: list[int], outputs: int, flat: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = None if flat is None else Network(flat.copy(), outputs)
        # A word of a group has count(word) / count(group); the upper part comes with the row or from the count table.
        shares = np.zeros(outputs)
        shares[-HASHED:] = -np.log(np.maximum(groups, 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                if net is None:
                    n, total = np.zeros(part.num_rows, dtype=np.int64), np.zeros(part.num_rows)
                else:
                    n, total = score_texts(part.column(2), net, shares)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(total + part.column(3).to_numpy())], names=["row", "doc_id", "n_tokens", "total"]
                )

    return run


def rest_sums(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """``row, add``: the summed logarithms of the counts of a row's words that the vocabulary does not hold. A word counted once
    adds nothing; none is hot, as the hot ones are in the vocabulary."""
    words = rows.select("row", F.inline("rest")).join(rest.where("count > 1"), "w")
    return words.groupBy("row").agg(F.sum(F.col("n") * F.log(F.col("count").cast("double"))).alias("add"))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, log_likelihood, mean_log_likelihood``."""
    known, rest = vocabulary(count_words(docs, text))
    rows = numbered(docs, known, key, text)
    flat = train(rows, known.outputs)
    scores = rows.select("row", "doc_id", "ids", "add").mapInArrow(
        _score(known.groups, known.outputs, flat), "row long, doc_id long, n_tokens long, total double"
    )
    scores = scores.join(rest_sums(rows, rest), "row", "left")
    whole = (F.col("total") + F.coalesce("add", F.lit(0.0))).alias("log_likelihood")
    return scores.select("doc_id", "n_tokens", whole).withColumn(
        "mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    )
