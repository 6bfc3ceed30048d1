"""Token alignment against a plain version, and the laws of its fragments."""

import collections
import hashlib
import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from tileframe.llm import alignment

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def plain(rows, pair):
    """All token pairs of all documents, one by one."""
    done, counts = [], collections.Counter()
    for key, text in rows:
        groups, links = [], []
        whole = (" " + (text or "")).encode()
        a, b = (pair.encode_a(" " + text), pair.encode_b(text)) if text else ([], [])
        if b"".join(pair.bytes_a[i] for i in a) != whole or b"".join(pair.bytes_b[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, table in ((a, pair.bytes_a), (b, pair.bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at = out[-1][1]
            spans.append(out)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        start = 0
        for end in common:
            groups.append([[i for s, e, i in side if start <= s and e <= end] for side in spans])
            start = end
        at = 0
        for s, e, i in spans[0]:
            while at and spans[1][at - 1][1] > s:
                at -= 1
            while at < len(spans[1]) and spans[1][at][0] < e:
                if spans[1][at][1] > s:
                    links.append((i, spans[1][at][2]))
                at += 1
        counts.update(links)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        done.append((key, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        ((key, n_a, n_b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), said)
         for key, n_a, n_b, g, links, said in done),
        key=str,
    )


def letters():
    """Tokenizers of which A reads pairs and B reads triples of letters; B swallows tabs."""
    table = [bytes([i]) for i in range(256)]
    pairs = [bytes([x, y]) for x in b" abc" for y in b" abc"]
    triples = [bytes([x, y, z]) for x in b" abc" for y in b"abc" for z in b"abc"]

    def cut(data, more):
        known, out, at = {t: 256 + i for i, t in enumerate(more)}, [], 0
        size = len(more[0])
        while at < len(data):
            part = data[at : at + size]
            out.append(known.get(part, data[at]))
            at += size if part in known else 1
        return out

    return alignment.Pair(
        lambda t: cut(t.encode(), pairs), lambda t: cut(b" " + t.replace("\t", "").encode(), triples), table + pairs, table + triples,
    )


ROWS = [(1, None), (2, ""), (3, "abc"), (3, "abc"), (4, "a\tb"), (None, "cab ab"), (5, "x"), (6, "abcab" * 500)]


@pytest.mark.parametrize("max_pairs", [10**6, 0])
def test_letters(spark, max_pairs):
    rng = random.Random(1)
    rows = ROWS + [(10 + i, "".join(rng.choice("abc xyé") for _ in range(rng.randrange(60)))) for i in range(40)]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, n_a int, `row` string").repartition(3)
    got = alignment.align(docs, tokenizers=letters, max_pairs=max_pairs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, letters())


def test_long_documents(spark):
    """Public tokenizers; pieces and byte ranges so small that most documents are folded over several levels."""
    rng = random.Random(2)
    words = ["the", "naïve", "日本語テキスト", "a", "<|endoftext|>", "x▁y", "  ", "\n", "don't", "🙂", "1234", "ﬁne", "resumé", "zzzzqqq"]
    rows = [(i, " ".join(rng.choice(words[:5] + words[6:]) for _ in range(rng.randrange(400)))) for i in range(30)]
    rows += [(100, " ".join(words * 30)), (101, "ñ" * 3000), (102, "<s> a </s>"), *ROWS[:4]]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), piece=150, width=64)
    want = plain(rows, alignment.public_pair())
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    whole = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in whole.collect()), key=str) == want


def test_empty(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), tokenizers=letters).collect() == []


def test_pieces_spell_the_text():
    rng = random.Random(4)
    pair = alignment.public_pair()
    for _ in range(50):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "é", "　", "'s ", "12 ", "z. "]) for _ in range(200))
        pieces = alignment.pieces_of(text, 20)
        assert " ".join(pieces) == text
        assert [i for p in pieces for i in pair.encode_a(" " + p)] == list(pair.encode_a(" " + text))
        assert [i for p in pieces for i in pair.encode_b(p)] == list(pair.encode_b(text))


def test_fragments_are_a_monoid():
    """Any cuts and any order of composition close the same stretches."""
    pair = letters()
    text = "abcab cabx ab abcabc bca" * 6
    ids = [np.array(x, np.uint16) for x in (pair.encode_a(" " + text), pair.encode_b(text))]
    ends = [alignment.ends_of(x, w) for x, w in zip(ids, pair.widths)]
    rng = random.Random(5)

    def stretches(folded, closed):
        first = [(0, folded.a, folded.b)] if folded.sync else []
        assert not folded.sa and not folded.sb
        found = sorted(first + closed)
        return [b"".join(x[i] for x in found) for i in (1, 2)]

    for _ in range(30):
        cuts = sorted(rng.sample(range(1, int(ends[0][-1])), rng.randrange(1, 25)))
        parts, closed = [], []
        for s, e in zip([0, *cuts], [*cuts, int(ends[0][-1])]):
            at = [slice(*np.searchsorted(x, [s, e], side="right")) for x in ends]
            one, own = alignment.fragment(s, ids[0][at[0]], ids[1][at[1]], ends[0][at[0]], ends[1][at[1]])
            parts.append(one)
            closed += [own] if own else []
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            one, own = alignment.compose(parts[i], parts[i + 1])
            closed += [own] if own else []
            parts[i : i + 2] = [one]
        assert stretches(parts[0], closed) == [x.tobytes() for x in ids]
