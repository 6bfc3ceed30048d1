"""Licence notices by a positional index of rare words.

Each template is a short public notice with a label and the key phrases it must hold. The index maps a
licence word to its places in the templates (its postings). The words are weighed by inverse document frequency
over the whole corpus, counted in a first pass. In the second pass every rare licence word of a file looks up its
postings; a template place and a file place give a relative position, and positions on which the template's rare
words agree are candidate places. A candidate is accepted if enough of the template's words stand where they
should (a few words may be missing or put in between) and every mandatory phrase stands there whole.

The base phrases are templates of which every word is mandatory: their rarest word by the same counts
leads to each place, so each place is found.

Words are runs of ASCII letters and digits (A-Z in lower case) and of all characters beyond ASCII. Defined
results: a null or empty text has no words, no labels and score 0; null keys, repeated rows and other columns are
passed by; texts of any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import text_or_empty

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: The public wording of common notices, with the phrases that each must hold.
TEMPLATES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", ("free of charge", "without restriction")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation", ("general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("source and binary forms", "conditions are met")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", ("with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights",
     ("waived all copyright",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license",
     ("creative commons attribution noncommercial",)),
)
#: Share of a template's words that must stand in place, and by how many places a word may be off.
COVER, SLACK = 0.8, 2
#: A candidate place needs the agreement of so many of a template's rarest words.
VOTES, RARE = 2, 4

_BREAKS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_LOWER = bytes(range(0x41, 0x5B))
#: One table for a whole text: capitals to small letters, separators to spaces.
_TABLE = bytes(c + 32 if c in _LOWER else 32 if c in _BREAKS else c for c in range(256))


def words_of_bytes(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def vocabulary() -> set[bytes]:
    return {w for phrase in (*BASE, *(t for _, t, _ in TEMPLATES)) for w in phrase.encode().split()}


@dataclass
class Index:
    """Postings of the rarest words: word to (template, place in it); base: word to (phrase words, place, label)."""

    base: dict[bytes, list[tuple[list[bytes], int, str]]]
    postings: dict[bytes, list[tuple[int, int]]]
    templates: list[tuple[str, list[bytes], list[list[bytes]], int]]


def build_index(frequency: dict[bytes, int], n_docs: int) -> Index:
    """``frequency``: documents that hold each licence word. Ties go to the earlier word."""
    weight = {w: math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary()}
    base, postings, templates = defaultdict(list), defaultdict(list), []
    for phrase, label in BASE.items():
        words = phrase.encode().split()
        at = max(range(len(words)), key=lambda i: (weight[words[i]], -i))
        base[words[at]].append((words, at, label))
    for number, (label, notice, keys) in enumerate(TEMPLATES):
        words = notice.encode().split()
        rare = sorted(set(words), key=lambda w: (-weight[w], words.index(w)))[:RARE]
        templates.append((label, words, [k.encode().split() for k in keys], len(rare)))
        for place, w in enumerate(words):
            if w in rare:
                postings[w].append((number, place))
    return Index(dict(base), dict(postings), templates)


def _stands(words: list[bytes], at: int, phrase: list[bytes]) -> bool:
    return at >= 0 and words[at : at + len(phrase)] == phrase


def scan_words(words: list[bytes], index: Index) -> tuple[list[int], set[str], set[str], float]:
    """Starts of base phrases in order, base labels, all labels, and the best cover of an accepted template."""
    places: dict[bytes, list[int]] = {}
    known = index.base.keys() | index.postings.keys()
    if held := known & set(words):
        for i, w in enumerate(words):
            if w in held:
                places.setdefault(w, []).append(i)
    starts, base_labels = [], set()
    for w in index.base.keys() & places.keys():
        for phrase, at, label in index.base[w]:
            for i in places[w]:
                if _stands(words, i - at, phrase):
                    starts.append(i - at)
                    base_labels.add(label)
    labels, score = set(base_labels), 1.0 if base_labels else 0.0
    votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
    for w in index.postings.keys() & places.keys():
        for number, place in index.postings[w]:
            for i in places[w]:
                votes[number, i - place].add(w)
    for (number, shift), agreeing in votes.items():
        label, notice, keys, rare = index.templates[number]
        # Words put in or left out shift what follows, so neighbouring positions support each other.
        support = set(agreeing).union(*(votes.get((number, shift + d), ()) for d in range(-SLACK, SLACK + 1) if d))
        if len(support) < min(VOTES, rare):
            continue
        window = words[max(0, shift - SLACK) : max(0, shift + len(notice) + SLACK)]
        hits = sum(w in words[max(0, shift + i - SLACK) : max(0, shift + i + SLACK + 1)] for i, w in enumerate(notice))
        if hits < COVER * len(notice):
            continue
        if all(any(_stands(window, i, k) for i in range(len(window))) for k in keys):
            labels.add(label)
            score = max(score, hits / len(notice))
    return sorted(starts), base_labels, labels, score


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted, seen, rows = vocabulary(), Counter(), 0
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            seen.update(wanted.intersection(words_of_bytes(text.as_py())))
        rows += batch.num_rows
    if rows:
        words = sorted(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in words] + [None], pa.string()), pa.array([seen[w] for w in words] + [rows], pa.int64())],
            names=["word", "n"],
        )


def word_frequencies(docs: DataFrame, text: str = "text") -> tuple[dict[bytes, int], int]:
    """Documents of the whole table that hold each licence word, and the number of documents. The
    result has at most as many lines as the templates have words."""
    rows = docs.select(text_or_empty(text).alias("text"))
    counts = rows.mapInArrow(_count_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in counts if r["word"]}, sum(r["n"] for r in counts if r["word"] is None)


def _scan_batches(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).cast(pa.binary()):
                words = words_of_bytes(text.as_py())
                starts, base, labels, score = scan_words(words, index)
                row = (
                    len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
                    ",".join(sorted(base)), ",".join(sorted(labels)), score,
                )
                for values, value in zip(out, row, strict=True):
                    values.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, k) for v, k in zip(out, kinds, strict=True)]],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: words, places of base phrases, labels of both kinds, and a score from 0 to 1."""
    index = build_index(*word_frequencies(docs, text))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(
        _scan_batches(index),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double",
    )
