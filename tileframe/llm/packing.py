"""Packing token sequences with the least bin slack.

Texts become token ids where they lie: a document is cut into pieces of a whole window and one
remainder, and only a short line per piece (place, length, checksum) leaves the task. The lines are dealt into
buckets of bounded size. In a bucket whole windows are sequences already; the remainders are packed window by
window: a bitset dynamic programme over the multiset of remaining lengths (bit ``s`` is set if lengths sum to
``s``) finds the sum closest to the capacity, and backtracking through its layers gives how many pieces
of each length make that sum. The longest remaining piece always takes part, so every window makes progress.

Defined results: a null text is an empty one and gives the end id alone; repeated rows are packed each; a null key
is carried along; only the named columns are read; an empty table gives an empty table. Very long texts
are many whole windows. Sequences of different buckets never share a window, which costs at most about one
window of padding for each bucket.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import stored, text_or_empty

CAPACITY = 2048
END_ID = 1
#: Lines of pieces that are packed together in one group.
BUCKET_ROWS = 20_000
#: Texts that a task holds at a time.
BATCH_ROWS = 200
_SPECIAL = "<|endoftext|>"
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


Encoder = Callable[[str], bytes]


def byte_bpe_encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """Text to ids as little-endian unsigned 32-bit integers, by the public byte-level vocabulary.

    ``ranks`` holds the same vocabulary as ``vocabulary`` for a library that is three times as fast and gives the same
    ids; only texts that spell the vocabulary's special token go to the slower one, which is loaded with the first of them."""
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    @cache
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(vocabulary)

    def encode(text: str) -> bytes:
        if _SPECIAL in text:
            ids = whole().encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text)
        return np.asarray(ids, dtype="<u4").tobytes()

    return encode


def public_encoder() -> Encoder:
    """The encoder of the installed public vocabulary, built where it is used."""
    import public_tokenizers as public

    return byte_bpe_encoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length make the fullest window with the longest piece in it.

    A window of a power of two needs no padding; it is preferred where the capacity cannot be met."""
    longest = max(counts)
    take = defaultdict(int, {longest: 1})
    reach, layers, mask = 1 << longest, [], (1 << (capacity + 1)) - 1
    for length in sorted((x for x in counts if x <= capacity - longest), reverse=True):
        left, step = min(counts[length] - (length == longest), (capacity - longest) // length), 1
        while left > 0:
            n = min(step, left)
            layers.append((length, n, reach))
            reach |= (reach << (length * n)) & mask
            left, step = left - n, step * 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    if total < capacity:
        whole = 1 << (total.bit_length() - 1)
        if reach >> whole & 1:
            total = whole
    for length, n, before in reversed(layers):
        if not before >> total & 1:
            take[length] += n
            total -= length * n
    return dict(take)


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; pieces of one length are taken in their order."""
    window, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    waiting: dict[int, list[int]] = defaultdict(list)
    for at in range(len(lengths) - 1, -1, -1):
        waiting[int(lengths[at])].append(at)
    counts = {length: len(at) for length, at in waiting.items()}
    number = 0
    while counts:
        used = 0
        for length, n in sorted(fill(counts, capacity).items(), reverse=True):
            for _ in range(n):
                at = waiting[length].pop()
                window[at], offset[at] = number, used
                used += length
            counts[length] -= n
            if not counts[length]:
                del counts[length]
        number += 1
    return window, offset


def _pieces(make: Callable[[], Encoder], capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = make(), TaskContext.get().partitionId() << 40
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                tokens = len(ids) // 4
                for start in range(0, tokens, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    line = (key, start, len(piece) // 4, zlib.crc32(piece), tokens, row)
                    for values, value in zip(out, line, strict=True):
                        values.append(value)
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_row"],
            )

    return run


def _pack_bucket(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("_row").reset_index(drop=True)
        lengths = pieces["length"].to_numpy()
        part = lengths < capacity
        window, offset = np.zeros(len(pieces), dtype=np.int64), np.zeros(len(pieces), dtype=np.int64)
        window[part], offset[part] = pack_lengths(lengths[part], capacity)
        first = window[part].max() + 1 if part.any() else 0
        window[~part] = first + np.arange((~part).sum())
        base = int(pieces["_bucket"].iloc[0]) << 32
        return pieces.assign(sequence_id=base + window, offset=offset).drop(columns=["_row", "_bucket"])

    return run


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    encoder: Callable[[], Encoder] = public_encoder,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    pieces = stored(rows.mapInArrow(_pieces(encoder, capacity), f"{_SCHEMA}, _row long"), "pieces", BATCH_ROWS)
    buckets = max(1, -(-pieces.count() // BUCKET_ROWS))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    packed = dealt.groupBy("_bucket").applyInPandas(
        _pack_bucket(capacity), f"{_SCHEMA}, sequence_id long, offset long"
    )
    return packed
