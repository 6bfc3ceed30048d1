"""The n-gram join against all pairs, where keys are hot, and documents decided row by row."""

import random
import re
from pathlib import Path

import pytest

from tileframe.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, n, percent):
    """Component of each row (by place), all pairs compared."""
    grams, parent = [], list(range(len(texts)))
    for text in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams.append({tuple(w)} if 0 < len(w) < n else {tuple(w[k : k + n]) for k in range(len(w) - n + 1)})

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            joint = len(grams[a] & grams[b])
            if joint and 100 * joint >= percent * len(grams[a] | grams[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(x) for x in range(len(texts))]


def shared_passages(seed, size=160):
    """Near copies of a few texts, and texts of which half is one common passage; all lengths from 1 to 300 words."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    bases = [[rng.choice(words) for _ in range(rng.choice([1, 3, 5, 9, 30, 80, 300]))] for _ in range(14)]
    out = [None, "", " \n "]
    for _ in range(size):
        text = list(rng.choice(bases))
        if rng.random() < 0.5:
            text = passage + [rng.choice(words) for _ in range(rng.choice([4, 12, 40, 70]))]
        for _ in range(rng.choice([0, 0, 1, 2, len(text) // 40])):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("n, percent, hot", [(5, 80, 24), (4, 85, 2), (2, 60, 3)])
def test_all_pairs_where_keys_are_hot(spark, monkeypatch, n, percent, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    texts = shared_passages(n * hot)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard.join_ngrams(docs, n=n, percent=percent).collect()}
    assert got == dict(enumerate(plain(texts, n, percent)))


def test_hot_segments_are_left_out(spark, monkeypatch):
    """Texts that share a passage but are far apart have no candidates once its keys are hot."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(120)]
    texts = [" ".join(passage + [f"x{rng.randrange(10**6)}" for _ in range(80)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = jaccard.with_grams(docs, "doc_id", "text", 4).selectExpr("id", "size(grams) AS n", "transform(grams, x -> cast(x & 2147483647L as int)) AS short")
    monkeypatch.setattr(jaccard, "HOT", 10**9)
    before = jaccard.candidate_rows(sets, 85).count()
    monkeypatch.setattr(jaccard, "HOT", 5)
    assert before > 60 and jaccard.candidate_rows(sets, 85).count() < before / 4


@pytest.mark.parametrize("repeated", [False, True])
def test_distinct_documents_by_row(spark, repeated):
    """One row of each group stays, and nothing unique is lost, whatever the ids."""
    texts = shared_passages(8, 110)
    rng = random.Random(5)
    ids = [rng.choice([None, *range(40)]) if repeated else 3 * i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, at, "x") for at, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, place int, _gone string")
    kept = jaccard.distinct_documents(docs.repartition(4), n=5, percent=80)
    assert kept.columns == docs.columns
    rows = kept.collect()
    roots = plain(texts, 5, 80)
    groups = {}
    for at, root in enumerate(roots):
        groups.setdefault(root, []).append(at)
    assert sorted(roots[r.place] for r in rows) == sorted(groups)
    for r in rows:
        known = [ids[x] for x in groups[roots[r.place]] if ids[x] is not None]
        assert r.doc_id == (min(known) if known else None) and texts[r.place] == r.text


def test_clean_rows_of_one_id_stay(spark):
    rows = [(1, "a b c d e f g h"), (1, "one two three four five six"), (2, "x y z"), (3, "a b c d e f g h"), (3, "seven eight nine ten eleven"),
            (None, "no id at all here"), (None, "no id at all here"), (4, None), (4, "")]
    kept = jaccard.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string"), n=5, percent=80)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        (str(i), str(t)) for i, t in [rows[0], rows[1], rows[2], rows[4], rows[5], rows[7], rows[8]]
    )


def test_sketches_differ_in_no_more_cells_than_sets(spark):
    """Bound for every pair, equality for sets of few hashes, and an empty set."""
    rng = random.Random(12)
    sets = [[], [1], [-5, 2**62], *([rng.getrandbits(63) - 2**62 for _ in range(rng.choice([3, 40, 400]))] for _ in range(25))]
    sets += [s[3:] + [rng.getrandbits(60)] for s in sets]
    table = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, grams array<long>").repartition(3)
    found = {r.id: r.sketch for r in jaccard.with_sketches(table).collect()}
    assert len(found) == len(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            cells = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(found[i], found[j], strict=True))
            apart = len(set(x) ^ set(y))
            assert cells <= apart and (apart > 3 or cells in (apart, apart - 2))


def test_rounds_by_sketches(spark, monkeypatch):
    """Near copies of one text on both sides of the threshold: later rounds choose by sketches and compare few pairs."""
    rng = random.Random(21)
    base, texts = [f"b{i}" for i in range(120)], []
    for _ in range(220):
        text = list(base)
        for _ in range(rng.choice([2, 3, 4, 5])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    compared, turns = [], []
    verified, nearest = jaccard.verified, jaccard.nearest_pivots
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    monkeypatch.setattr(jaccard, "nearest_pivots", lambda rows, sketches, turn, percent: turns.append(turn) or nearest(rows, sketches, turn, percent))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.join_ngrams(docs).collect()}
    expected = plain(texts, 4, 85)
    assert got == dict(enumerate(expected)) and len(set(expected)) > 20
    assert turns and sum(compared) < len(texts) * (len(texts) - 1) / 20


def test_tables_that_served_leave_the_disk(spark):
    """The cut hashes of all sets and the candidates with left-out keys go before the sets are compared."""
    texts = shared_passages(11, size=60)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_ngrams(frame).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 4, 85)
    names = {f.name.rsplit("-", 1)[0] for f in set(folder.iterdir()) - before}
    assert {"kept", "sets", "thin"} <= names
    assert not {"rows", "candidates"} & names


@pytest.mark.parametrize("small", [jaccard._SMALL, 0])
def test_sets_of_first_ends_are_not_shuffled(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard, "_SMALL", small)
    sets = spark.createDataFrame([(i, list(range(i, 40))) for i in range(12)], "id long, grams array<bigint>")
    pairs = spark.createDataFrame([(a, b) for b in range(12) for a in range(b)], "a long, b long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = jaccard.verified(pairs, sets, 85)
        found = {(r["a"], r["b"]) for r in links.collect()}
        shuffles = links._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == {(a, b) for b in range(12) for a in range(b) if 100 * (40 - b) >= 85 * (40 - a)}
    assert shuffles == (1 if small else 2)


@pytest.mark.parametrize("sketched", [False, True])
def test_pairs_are_formed_where_they_first_meet(spark, sketched):
    """Classes that share many keys make about one row a pair, those that share too few make hardly any, and no pair is lost."""
    rng = random.Random(17)
    common, held = rng.sample(range(10**6), 90), {}
    for i in range(70):
        # Two groups that share most keys within, and some that share few.
        kept = rng.sample(common[:45] if i % 2 else common[45:], rng.choice([3, 30, 36, 40]))
        held[i] = kept + rng.sample(range(10**6, 2 * 10**6), 4)
    # A repeated key counts once.
    rows = [(k, i, 300, 9 + i % 3, i // 2) for i, keys in held.items() for k in [*keys, keys[0]]]
    table = spark.createDataFrame(rows, "key long, id long, n int, need int, component long").repartition(4)
    sketches = None
    if sketched:
        sketches = jaccard.with_sketches(spark.createDataFrame([(i, [1, 2, 3]) for i in held], "id long, grams array<long>"))
    met = jaccard.first_meetings(jaccard.key_lists(table), sketches, 80).collect()
    shared = {(a, b): len({*held[a]} & {*held[b]}) for b in held for a in range(b) if a // 2 != b // 2}
    expected = {p for p, c in shared.items() if c >= min(8 + p[0] % 3, 8 + p[1] % 3)}
    found = jaccard.meeting_pairs(table, sketches, 80).collect()
    assert {(r.a, r.b) for r in found} == expected and len(found) == len(expected)
    assert expected <= {(r.a, r.b) for r in met}
    assert len(met) < 1.3 * len(expected) < sum(shared.values()) / 10
