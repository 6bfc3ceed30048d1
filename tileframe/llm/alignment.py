"""Alignment of two tokenizers' tokens over the bytes of each document, by a monoid of fragments.

Tokenizer A (byte-level pairs) reads a space and the text, tokenizer B (pieces) the text, before which it puts a space
itself, so both spell the same bytes. Offsets where tokens of both end cut the tokens into *groups*; tokens whose byte ranges
overlap are *linked*.

Texts beyond ``PIECE`` characters are cut before single spaces between two other characters: no token of A or B crosses
such a place, and each piece without its space is a text of its own to both. Pieces are dealt to tasks, and the tokens of
each are cut into byte ranges wherever these fall. A byte range yields a fragment: an open prefix up to its first
common end, closed groups, and an open suffix behind its last common end; without a common end all of it is open.
Fragments compose associatively: a suffix and the next prefix make a closed stretch. So the fragments of a
document, however long, are folded as a tree over Spark groups of eight neighbours, and only open parts move up; closed
stretches stay where they are found.

Links of a stretch need no search: between two neighbouring ends of either tokenizer lies one link. They are counted
corpus-wide for each pair of ids, with sums in every batch before the shuffle, and the counts come back by a broadcast if
the distinct pairs are at most ``MAX_PAIRS``, else by a salted join.

Defined results: texts that are null, empty, or that one tokenizer does not spell back byte by byte have no tokens: zeros and
''. Repeated rows, with the same or no id, are documents of their own and count as such. Only the named columns are read; an
empty table gives an empty table. Ids must be below 65,536.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import stored

#: Characters of a piece of a long text; bytes of the range of a fragment; fragments folded in one group.
PIECE, RANGE, FOLD = 65_536, 32_768, 8
#: Distinct pairs of ids whose counts are broadcast (16 bytes each).
MAX_PAIRS = 2_000_000
#: Bytes of tokens that are worked on at once in a task, and distinct pairs gathered before they are handed on.
_BATCH, _GATHER = 1_000_000, 1_000_000
_KEY = 65_536
_CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")

_ENCODED = "row long, doc_id long, piece int, start long, text string, a binary, b binary"
_PART = "row long, kind int, idx long, start long, sync boolean, a binary, b binary, sa binary, sb binary, sstart long"
CLOSED, OPEN, BAD = 0, 1, 2
#: Bytes of every id of A and of B: small arrays that tasks carry instead of the tokenizers.
Widths = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Pair:
    """Two tokenizers: functions from a text to ids, and the bytes of every id."""

    encode_a: Callable[[str], list[int]]
    encode_b: Callable[[str], list[int]]
    bytes_a: list[bytes]
    bytes_b: list[bytes]

    @functools.cached_property
    def widths(self) -> Widths:
        return tuple(np.array([len(x) for x in t], dtype=np.int32) for t in (self.bytes_a, self.bytes_b))

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a text, or None where one of them does not spell it."""
        if not text:
            return None
        whole = (" " + text).encode("utf-8", "surrogatepass")
        out = []
        for encode, table in ((self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b)):
            ids = encode(" " + text if table is self.bytes_a else text)
            if b"".join(map(table.__getitem__, ids)) != whole:
                return None
            out.append(np.asarray(ids, dtype=np.uint16))
        return out[0], out[1]


def pair_of(ranks: str, pattern: str, model: str) -> Pair:
    """The pair of a byte-level vocabulary (as ranks) and a piece model; strings of special tokens are plain text."""
    import sentencepiece
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    levels = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    bytes_a = [b""] * (max(merges.values()) + 2)
    for token, i in merges.items():
        bytes_a[i] = token
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    bytes_b = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        if pieces.is_byte(i):
            bytes_b.append(bytes([int(piece[3:5], 16)]))
        elif pieces.is_control(i) or pieces.is_unknown(i):
            bytes_b.append(b"")
        else:
            bytes_b.append(piece.replace("▁", " ").encode())
    return Pair(levels.encode_ordinary, pieces.encode, bytes_a, bytes_b)


def public_pair() -> Pair:
    """The pair of the installed public vocabularies, built where it is used."""
    import public_tokenizers as public

    return pair_of(public.path("byte_bpe_50k.tiktoken"), public.PATTERN, public.path("piece_bpe_32k.model"))


def pieces_of(text: str, size: int = PIECE) -> list[str]:
    """A text in pieces of at least ``size`` characters (the last may be shorter), which a space joins again.

    A text without a place to cut stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def ends_of(ids: np.ndarray, widths: np.ndarray) -> np.ndarray:
    return np.cumsum(widths[ids], dtype=np.int64)


@dataclass(frozen=True)
class Fragment:
    """What is open in a byte range. Without a common end (``sync``) all tokens are in the prefix."""

    start: int
    sync: bool
    a: bytes
    b: bytes
    sa: bytes
    sb: bytes
    sstart: int


def fragment(start: int, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
    """The fragment of one byte range from ``start`` on, and its closed stretch ``(start, a, b)`` or None.

    ``ends_*`` are the byte ends of the tokens that end in the range."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return Fragment(start, False, a.tobytes(), b.tobytes(), b"", b"", start), None
    first, last = common[0], common[-1]
    a0, a1 = np.searchsorted(ends_a, [first, last], side="right")
    b0, b1 = np.searchsorted(ends_b, [first, last], side="right")
    open_part = Fragment(
        start, True, a[:a0].tobytes(), b[:b0].tobytes(), a[a1:].tobytes(), b[b1:].tobytes(), int(last)
    )
    return open_part, (int(first), a[a0:a1].tobytes(), b[b0:b1].tobytes()) if a1 > a0 else None


def compose(left: Fragment, right: Fragment):
    """The fragment of two neighbours, and the stretch that their open sides close, or None. Associative."""
    if not left.sync and not right.sync:
        return Fragment(left.start, False, left.a + right.a, left.b + right.b, b"", b"", left.start), None
    if not left.sync:
        return Fragment(left.start, True, left.a + right.a, left.b + right.b, right.sa, right.sb, right.sstart), None
    if not right.sync:
        return Fragment(left.start, True, left.a, left.b, left.sa + right.a, left.sb + right.b, left.sstart), None
    whole = Fragment(left.start, True, left.a, left.b, right.sa, right.sb, right.sstart)
    closed = (left.sstart, left.sa + right.a, left.sb + right.b)
    return whole, closed if closed[1] or closed[2] else None


def _encode_batches(make: Callable[[], Pair], size: int):
    """Short texts as ids, long ones as pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = make(), TaskContext.get().partitionId() << 40
        schema = pa.schema([
            ("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("text", pa.string()),
            ("a", pa.binary()), ("b", pa.binary()),
        ])
        for batch in batches:
            out, held = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row, text = row + 1, text.as_py()
                pieces = pieces_of(text, size) if text and len(text) > size else []
                if len(pieces) > 1:
                    start = 0
                    for number, piece in enumerate(pieces):
                        out.append((row, key, number, start, piece, None, None))
                        start += 1 + len(piece.encode("utf-8", "surrogatepass"))
                else:
                    ids = pair.tokens(text)
                    out.append((row, key, None, 0, None, *(x.tobytes() for x in ids or (np.zeros(0, np.uint16),) * 2)))
                held += len(text or "")
                if held > _BATCH:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)

    return run


def _part_rows(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in _PART.split(", ")]
    return pd.DataFrame(rows, columns=names)


def _open_row(row: int, idx: int, f: Fragment) -> tuple:
    return row, OPEN, idx, f.start, f.sync, f.a, f.b, f.sa, f.sb, f.sstart


def _closed_row(row: int, closed: tuple[int, bytes, bytes]) -> tuple:
    return row, CLOSED, 0, closed[0], True, closed[1], closed[2], b"", b"", 0


def _fragment_batches(make: Callable[[], Pair], width: int):
    """Pieces of long texts: encoded, and cut into the fragments of byte ranges."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = make()
        for frame in frames:
            for row, start, text in zip(frame["row"], frame["start"], frame["text"], strict=True):
                ids, out = pair.tokens(text), []
                if ids is None:
                    yield _part_rows([(row, BAD, 0, start, False, b"", b"", b"", b"", 0)])
                    continue
                ends = [start + ends_of(x, w) for x, w in zip(ids, pair.widths, strict=True)]
                first, last = start // width, (int(ends[0][-1]) - 1) // width
                edges = (np.arange(first, last) + 1) * width
                cuts = [[0, *np.searchsorted(e, edges, side="right"), len(e)] for e in ends]
                for i in range(last - first + 1):
                    (a0, a1), (b0, b1) = (c[i : i + 2] for c in cuts)
                    at = max(start, (first + i) * width)
                    part, closed = fragment(at, ids[0][a0:a1], ids[1][b0:b1], ends[0][a0:a1], ends[1][b0:b1])
                    out.append(_open_row(row, first + i, part))
                    if closed:
                        out.append(_closed_row(row, closed))
                yield _part_rows(out)

    return run


def _fold(parts: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring fragments of one document as one, and what they close."""
    parts = parts.sort_values("start", kind="stable")
    row, idx, out, whole = int(parts["row"].iloc[0]), int(parts["up"].iloc[0]), [], None
    for r in parts.itertuples(index=False):
        one = Fragment(int(r.start), bool(r.sync), r.a, r.b, r.sa, r.sb, int(r.sstart))
        whole, closed = (one, None) if whole is None else compose(whole, one)
        if closed:
            out.append(_closed_row(row, closed))
    return _part_rows([*out, _open_row(row, idx, whole)])


def long_stretches(pieces: DataFrame, make: Callable[[], Pair], width: int = RANGE) -> DataFrame:
    """``row, start, a, b``: the closed stretches of all long documents, which together are their tokens.

    ``pieces`` has ``row, start, text``. A document with a piece that is not spelt back has none."""
    parts = stored(
        pieces.select("row", "start", "text").repartition("row", "start").mapInPandas(_fragment_batches(make, width), _PART), "fragments"
    )
    parts = parts.join(parts.where(f"kind = {BAD}").select("row").distinct(), "row", "left_anti")
    found = [parts.where(f"kind = {CLOSED}")]
    now = parts.where(f"kind = {OPEN}")
    while True:
        up = now.withColumn("up", F.floor(F.col("idx") / FOLD).cast("long"))
        folded = stored(up.groupBy("row", "up").applyInPandas(_fold, _PART), "folded")
        found.append(folded.where(f"kind = {CLOSED}"))
        now = folded.where(f"kind = {OPEN}")
        if not (now.agg(F.max("idx")).first()[0] or 0):
            break
    # Byte 0 is a common end of nothing, so what is left open in front is closed there.
    found.append(now)
    rest = functools.reduce(DataFrame.unionByName, found)
    return rest.where("length(a) > 0 AND sync").select("row", "start", "a", "b")


@dataclass(frozen=True)
class Marks:
    """Tokens of many stretches in one line of bytes: links as positions of A and B tokens, and group ends."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_end: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray


def marks(a: np.ndarray, b: np.ndarray, widths: Widths) -> Marks:
    ends_a, ends_b = ends_of(a, widths[0]), ends_of(b, widths[1])
    size = int(ends_a[-1]) + 1 if len(ends_a) else 1
    is_a, is_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    is_a[ends_a], is_b[ends_b] = True, True
    end = np.flatnonzero(is_a | is_b)
    link_a = np.cumsum(is_a)[end] - is_a[end]
    link_b = np.cumsum(is_b)[end] - is_b[end]
    both = is_a[end] & is_b[end]
    return Marks(a, b, link_a, link_b, end, link_a[both], link_b[both])


def spelled(m: Marks) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, each ended by ``;``, as one array of bytes, and for every A token the place behind its group."""
    group_a = np.searchsorted(m.last_a, np.arange(len(m.a)))
    group_b = np.searchsorted(m.last_b, np.arange(len(m.b)))
    behind = np.concatenate([[0], m.last_b + 1])
    place_a = np.arange(len(m.a)) + behind[group_a]
    place_b = np.arange(len(m.b)) + (m.last_a + 1)[group_b]
    ids, mark = np.zeros(len(m.a) + len(m.b), dtype=np.int64), np.full(len(m.a) + len(m.b), ord(","), dtype=np.uint8)
    ids[place_a], ids[place_b] = m.a, m.b
    mark[place_a[m.last_a]], mark[place_b[m.last_b]] = ord("|"), ord(";")
    digits = np.empty((len(ids), 6), dtype=np.uint8)
    for k in range(5):
        digits[:, k] = ids // 10 ** (4 - k) % 10 + ord("0")
    digits[:, 5] = mark
    keep = np.ones(digits.shape, dtype=bool)
    for k in range(4):
        keep[:, k] = ids >= 10 ** (4 - k)
    behind_token = np.cumsum(keep.sum(axis=1))
    return digits[keep], behind_token[place_b[m.last_b[group_a]]]


def _stretches(batch: pa.RecordBatch, at: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch of bounded size: rows, all A ids, all B ids, and both counts per row. Columns a, b are at ``at``."""
    first = 0
    sizes = [np.diff(c.buffers()[1] and np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]) for c in (batch.column(at), batch.column(at + 1))]
    while first < batch.num_rows:
        used = np.cumsum(sizes[0][first:])
        n = max(1, int(np.searchsorted(used, _BATCH, side="right")))
        rows = slice(first, first + n)
        ids = [
            np.frombuffer(b"".join(x or b"" for x in batch.column(at + i).slice(first, n).to_pylist()), dtype=np.uint16).astype(np.int64)
            for i in (0, 1)
        ]
        yield rows, ids[0], ids[1], sizes[0][rows] // 2, sizes[1][rows] // 2
        first += n


def _pair_batches(widths: Widths):
    """``pair, n`` of the links of many stretches, summed before they leave the task, in tables of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pd.Series(dtype=np.int64)
        for batch in batches:
            for _, a, b, _, _ in _stretches(batch, 0):
                m = marks(a, b, widths)
                codes, keys = pd.factorize(m.a[m.link_a] * _KEY + m.b[m.link_b])
                held = held.add(pd.Series(np.bincount(codes, minlength=len(keys)), index=keys), fill_value=0)
                if len(held) > _GATHER:
                    yield _pairs(held)
                    held = pd.Series(dtype=np.int64)
        yield _pairs(held)

    return run


def _pairs(held: pd.Series) -> pa.RecordBatch:
    columns = [pa.array(np.asarray(x, dtype=np.int64)) for x in (held.index, held.to_numpy())]
    return pa.RecordBatch.from_arrays(columns, names=["pair", "n"])


def pair_counts(stretches: DataFrame, widths: Widths) -> DataFrame:
    """``pair, n, best``: links of each pair of ids, and whether no pair of the same B id has more."""
    counts = stretches.select("a", "b").mapInArrow(_pair_batches(widths), "pair long, n long")
    counts = stored(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.pmod("pair", F.lit(_KEY)).alias("b")
    # At most as many rows as B has ids.
    most = counts.groupBy(b).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _stat_batches(widths: Widths, table, digest: bool):
    """Counts of each row; ``table`` is the broadcast counts of the pairs, or None where they are joined later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if table is not None:
            keys, counts, best = table.value
            index = pd.Index(keys)
        for batch in batches:
            for rows, a, b, n_a, n_b in _stretches(batch, 2):
                m = marks(a, b, widths)
                cut = np.concatenate([[0], np.cumsum(n_a)])
                owner = np.repeat(np.arange(len(n_a)), n_a)[m.link_a]
                ended = np.repeat(np.arange(len(n_a)), n_a)[m.last_a]
                out = [n_a, n_b, np.bincount(ended, minlength=len(n_a)), np.bincount(owner, minlength=len(n_a))]
                if table is not None:
                    at = index.get_indexer(m.a[m.link_a] * _KEY + m.b[m.link_b])
                    running = np.concatenate([[0], np.cumsum(counts[at])])
                    behind = np.concatenate([[0], np.cumsum(out[3])])
                    out += [np.bincount(owner[best[at]], minlength=len(n_a)), running[behind[1:]] - running[behind[:-1]]]
                else:
                    out += [np.zeros(len(n_a), np.int64)] * 2
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
                part = batch.slice(rows.start, rows.stop - rows.start)
                columns = [part.column(0), part.column(1), *(pa.array(x.astype(np.int64)) for x in out)]
                if digest:
                    text, behind_a = spelled(m)
                    text, ends, said, done = text.tobytes(), cut[1:], [], 0
                    for n, end in zip(n_a, ends, strict=True):
                        said.append(hashlib.sha256(text[done : behind_a[end - 1] - 1]).hexdigest() if n else "")
                        done = behind_a[end - 1] if n else done
                    columns.append(pa.array(said, pa.string()))
                    names.append("groups_sha256")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _link_batches(widths: Widths):
    """``row, pair, times`` of every stretch: for counts of pairs that are too many to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0).to_pylist(), dtype=np.int64)
            for rows, a, b, n_a, _ in _stretches(batch, 2):
                m = marks(a, b, widths)
                owner = np.repeat(np.arange(len(n_a)), n_a)[m.link_a]
                both = np.stack([owner, m.a[m.link_a] * _KEY + m.b[m.link_b]])
                found, times = np.unique(both, axis=1, return_counts=True)
                columns = [pa.array(ids[rows][found[0]]), pa.array(found[1]), pa.array(times.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "pair", "times"])

    return run


def _hash_batches(widths: Widths):
    """Digests of documents whose stretches come in order, as a stream: only the hash is carried on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = state = None

        def line() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["row", "groups_sha256"])

        for batch in batches:
            for row, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                m = marks(np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.uint16).astype(np.int64), widths)
                text = spelled(m)[0].tobytes()[:-1]
                if row == now:
                    state.update(b";" + text)
                    continue
                if now is not None:
                    yield line()
                now, state = row, hashlib.sha256(text)
        if now is not None:
            yield line()

    return run


_STATS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _salted_sums(stretches: DataFrame, pairs: DataFrame, widths: Widths, salts: int = 32) -> DataFrame:
    """``row, best, total`` by a join on (pair, salt): a pair that a third of all documents hold goes to many tasks."""
    links = stretches.mapInArrow(_link_batches(widths), "row long, pair long, times long")
    links = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    many = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return links.join(many, ["pair", "salt"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("total")
    )


def align(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: Callable[[], Pair] = public_pair,
    piece: int = PIECE, width: int = RANGE, max_pairs: int = MAX_PAIRS,
) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark, widths = docs.sparkSession, tokenizers().widths
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    encoded = stored(rows.mapInArrow(_encode_batches(tokenizers, piece), _ENCODED), "encoded")
    short = encoded.where("piece IS NULL").select("row", "doc_id", "a", "b")
    pieces = encoded.where("piece IS NOT NULL").drop("a", "b")
    stretches = stored(long_stretches(pieces, tokenizers, width), "stretches")
    no_id = F.lit(None).cast("long").alias("doc_id")
    pairs = stored(pair_counts(short.select("a", "b").union(stretches.select("a", "b")), widths), "counts")
    table = None
    if pairs.count() <= max_pairs:
        known = pairs.toPandas()
        columns = known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["best"].to_numpy(bool)
        table = spark.sparkContext.broadcast(columns)
    one = short.mapInArrow(_stat_batches(widths, table, True), f"{_STATS}, groups_sha256 string")
    many = stretches.select("row", no_id, "a", "b").mapInArrow(_stat_batches(widths, table, False), _STATS)
    many = many.groupBy("row").agg(*[F.sum(c).alias(c) for c in _SUMS])
    ordered = stretches.repartition("row").sortWithinPartitions("row", "start").select("row", "a", "b")
    many = many.join(ordered.mapInArrow(_hash_batches(widths), "row long, groups_sha256 string"), "row")
    named = pieces.where("piece = 0").select("row", "doc_id").join(many, "row", "left")
    out = one.unionByName(named)
    if table is None:
        both = short.union(stretches.select("row", no_id, "a", "b"))
        out = out.drop("n_best", "count_sum").join(_salted_sums(both, pairs, widths), "row", "left")
        out = out.withColumnRenamed("best", "n_best").withColumnRenamed("total", "count_sum")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _SUMS]
    return out.select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
