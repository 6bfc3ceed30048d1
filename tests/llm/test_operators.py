"""The operators of the training-data package against plain versions, on small cases."""

import collections
import hashlib
import random
import re
import sys
import time
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle

from tileframe.llm import (
    html_text, jaccard, licenses, lm_score, mixing, neighbours, packing, pii, quality, revisits,
)
from tileframe.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Null, empty and blank texts, ties, repeated rows, and a long text.
EDGES = [(1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (4, "x " * 30_000, "b"), (5, "one two", "b"), (5, "one two", "b"), (None, "no id here", None)]


@pytest.fixture(scope="module")
def edges(spark):
    """Edge cases with columns whose names clash with those of the results."""
    rows = [(i, t, s, 7, "clash") for i, t, s in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, `_key` string")


@pytest.fixture(scope="module")
def none(edges):
    return edges.where("false")


def similar_rows(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A b")]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 15, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    base = [rng.choice(words) for _ in range(90)]
    for _ in range(40):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((len(rows), " ".join(text)))
    return rows


def plain_components(rows, percent):
    grams, parent = {}, {}
    for i, text in rows:
        w = WORD.findall((text or "").lower())
        grams[i] = {tuple(w)} if 0 < len(w) < 4 else {tuple(w[k : k + 4]) for k in range(len(w) - 3)}
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in grams:
        for b in grams:
            joint = len(grams[a] & grams[b])
            if a < b and joint and 100 * joint >= percent * len(grams[a] | grams[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(grams[i]), root(i)) for i in grams}


def test_jaccard_equals_brute_force(spark):
    rows = similar_rows()
    got = jaccard.join_ngrams(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)


def test_jaccard_edges(edges, none):
    got = {(r.doc_id, r.component_id) for r in jaccard.join_ngrams(edges).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (None, None)}
    assert jaccard.join_ngrams(none).count() == 0
    kept = jaccard.distinct_documents(edges)
    assert kept.columns == edges.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None"]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 51: 50}


def test_main_text():
    page = (
        "<html><head><title>T</title><script>if (a < b) '</p>'</script></head><body><div class=menu><a href=x>Home</a></div>"
        "<article><h1>Head &amp; line</h1><p>One <b>tw</b>o\n three<br>four<p>Five<div class='comments'>reader</div></article>"
        "<aside>side</aside><footer>&copy; foot</footer>"
    )
    assert html_text.main_text(page) == "Head & line One two three four Five"
    prose = "the cat is in the house and it was not on the mat with the dog that he had from the man at the door " * 3
    loose = f"<div><a>one</a> <a>two</a></div><p>{prose}</p><p>Short.</p><p>{prose}</p><div><a href=1>next page of the list</a></div>"
    assert html_text.main_text(loose) == " ".join([prose.strip(), "Short.", prose.strip()])
    assert html_text.main_text("") == "" and html_text.main_text("<!-- open") == ""
    assert html_text.second_pass(["bad", "open", "open", "good"]) == ["bad", "bad", "good", "good"]


def test_main_text_decides_blocks_inside_articles():
    prose = "the cat is in the house and it was not on the mat with the dog that he had from the man at the door"
    links = "<ul><li><a href=1>Ten offers you must see</a><li><a href=2>Nine more</a></ul>"
    page = f"<article><h1>Title</h1><p>{prose}</p><div><a href=3>Buy cheap shoes now</a> today</div>{links}<h4>See also</h4>{links}<p>End.</article>"
    assert html_text.main_text(page) == f"Title {prose} End."
    assert html_text.main_text(f"<article><p>See <a href=1>it</a> in the long list.</p><p>{prose}</p></article>") == f"See it in the long list. {prose}"


def test_main_text_without_articles():
    menu = "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>"
    short = ["The cat sat on the mat.", "It was a good day for all of them, and they went out to the sea with a dog.", "Then rain fell."]
    body = "".join(f"<p>{x}</p>" for x in short)
    # Dropped containers do not pull short paragraphs with them, nor does a list of links if nothing else is decided.
    assert html_text.main_text(f"{menu}<div>{body}</div><footer>foot</footer>") == " ".join(short)
    assert html_text.main_text(f"<div><a href=1>Home</a></div><p>{short[0]}</p><p>{short[2]}</p>") == f"{short[0]} {short[2]}"
    # Long prose in a language without known stop words.
    finnish = "Kissa istui matolla koko aamun ja katseli ikkunasta ulos. Sataa vettä, sanoi mies hiljaa. " * 4
    page = f"{menu}<div><a href=1>Etusivu</a></div><p>{finnish}</p><div><a href=2>Seuraava sivu</a></div>"
    assert html_text.main_text(page) == finnish.strip()


def test_a_class_name_alone_never_empties_a_page():
    text = "One thing here. Two things there. Three in all."
    assert html_text.main_text(f"<article><section class='content promo-text'>{text}</section></article>") == text
    assert html_text.main_text(f"<article><p>{text}</p><div class=promo-text>Buy this.</div></article>") == text
    assert html_text.main_text(f"<article><nav>Menu</nav><form>{text}</form></article>") == ""


def test_broken_markup_takes_linear_time():
    for page in ("<p title='" * 500_000, "<a<" * 800_000, "<div>" * 200_000 + "</section>" * 200_000, "<p \"'" * 500_000 + "<b>"):
        start = time.monotonic()
        html_text.main_text(page)
        assert time.monotonic() - start < 15, page[:20]
    assert html_text.main_text("<article><p title='it>One here.</p><p>Two there.</p></article>") == "One here. Two there."


def plain_second_pass(labels, places):
    """Looks at all other blocks for each open one."""
    out = []
    for i, label in enumerate(labels):
        if label != "open":
            out.append(label)
        elif "good" not in labels:
            out.append("good")
        elif places[i] == "good":
            inside = 0 < i < len(labels) - 1
            out.append("bad" if inside and labels[i - 1] == labels[i + 1] == "bad" else "good")
        else:
            out.append(min((abs(j - i), j, x) for j, x in enumerate(labels) if x != "open")[2])
    return out


def test_second_pass_equals_a_plain_one():
    rng = random.Random(11)
    for _ in range(3000):
        n = rng.randrange(0, 12)
        labels = [rng.choice(["good", "bad", "open", "open"]) for _ in range(n)]
        places = [rng.choice([None, None, "good"]) for _ in range(n)]
        assert html_text.second_pass(labels, places) == plain_second_pass(labels, places)


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (None, "v", "<p>x", 1)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, html_text.extract(pages).collect()), key=str) == [(1, "u", "", 0), (2, None, "", 0), (None, "v", "x", 1)]
    assert html_text.extract(pages.where("false")).count() == 0


def test_licences(spark, edges, none):
    texts = [
        "Foo. Licensed under the Apache License, Version 2.0. All rights reserved; all rights reserved.",
        "released under the mit licence", "GNU general public-license and CC\tBY", "All of the rights are not reserved", None,
    ]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in rows] == [
        (2, 9, 12, "reserved", "apache-2.0,reserved"), (0, None, None, "", ""), (2, 1, 5, "cc-by,gpl", "cc-by,gpl"),
        (0, None, None, "", ""), (0, None, None, "", ""),
    ]
    assert all(0 <= r.score <= 1 for r in rows) and licenses.scan(none).count() == 0
    assert {r.labels for r in licenses.scan(edges).collect()} == {""}


def test_pii_equals_patterns():
    rng = random.Random(1)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "1.2.3.999.5.6", "4111 1111 1111 1111", "+49 (0) 30-1234567", "++1", " ", "-", "12", ".", "a@b.c.d@e.f", "4111-1111 1111  1111", "é"]
    anchors = pii.automaton()
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and pii.luhn(digits):
                want.append(("card", *m.span()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                want.append(("phone", *m.span()))
        assert [s for s in pii.find_spans(text, anchors) if s[0] in pii.BASE_KINDS] == want, text


def test_pii_more_kinds_and_masks(spark, edges, none):
    text = 'see ftp://bob:pw1@host.org token = "abcd1234efgh" DE89 3704 0044 0532 0130 00 end'
    spans = pii.find_spans(text, pii.automaton())
    assert {k for k, *_ in spans} >= {"login", "secret", "iban"}
    assert pii.mask("mail a@b.cd now", [("email", 5, 11)]) == "mail [email] now"
    assert pii.scan(none).count() == 0
    assert {r.base_sha256 for r in pii.scan(edges).collect()} == {hashlib.sha256(b"").hexdigest()}
    assert sorted(map(str, pii.masked(edges).collect())) == sorted(map(str, edges.collect()))


def plain_counts(text):
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, edges, none):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "c\n", "é", "# ", "\n", "dd "]) for _ in range(rng.randrange(60))) for _ in range(80)]
    got = quality.judge(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(texts[r.doc_id])
    rows = quality.judge(edges).collect()
    assert len(rows) == len(EDGES) and all(r.base_failed and not r.kept for r in rows)
    assert quality.judge(none).count() == 0 and quality.keep_good(none).columns == none.columns


def test_quality_hosts(spark):
    good = " ".join(f"word{i}" for i in range(60))
    odd = " ".join(f"word{i}#" for i in range(60))
    rows = [(i, odd, "bad") for i in range(30)] + [(30, good, "bad")] + [(40 + i, good, "fine") for i in range(60)] + [(200, odd, "fine"), (201, odd, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {i for i, _, s in rows if s != "bad"} | {30}
    assert kept == {r.doc_id for r in quality.judge(docs).where("kept").collect()}


def letters(text: str) -> bytes:
    return np.array([ord(c) for c in text], dtype="<u4").tobytes()


def test_packing(spark, edges, none):
    rng = random.Random(4)
    docs = {i: "".join(rng.choice("abc") for _ in range(rng.choice([0, 5, 40, 63, 64, 200]))) for i in range(300)}
    rows = packing.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), capacity=64, encoder=lambda: letters).toPandas()
    for i, part in rows.groupby("doc_id"):
        ids, at = letters(docs[i]) + letters("\x01"), 0
        for r in part.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    for _, part in rows.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all() and part["length"].sum() <= 64
    assert rows["sequence_id"].nunique() <= 1.03 * rows["length"].sum() / 64 + 1
    assert packing.pack(none, encoder=lambda: letters).count() == 0
    assert packing.pack(edges, encoder=lambda: letters).count() > len(EDGES)
    assert packing.fill({7: 1, 5: 3, 3: 2}, 10) == {7: 1, 3: 1}


def test_packing_holds_few_texts_at_a_time(spark, monkeypatch):
    pieces, sizes = packing._pieces, spark.sparkContext.accumulator(0)

    def watched(make, capacity):
        run = pieces(make, capacity)

        def counted(batches):
            for batch in batches:
                sizes.add(int(batch.num_rows > 200))
                yield from run(iter([batch]))

        return counted

    monkeypatch.setattr(packing, "_pieces", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(1500).coalesce(1).selectExpr("id AS doc_id", "repeat('ab ', 30) AS text")
    assert packing.pack(docs, encoder=lambda: letters).agg({"length": "sum"}).first()[0] == 1500 * 91
    assert sizes.value == 0 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_slow_encoder_waits_for_the_special_token(tmp_path):
    public = pytest.importorskip("public_tokenizers")
    ranks = public.path("byte_bpe_50k.tiktoken")
    encode = packing.byte_bpe_encoder(str(tmp_path / "none.json"), ranks, public.PATTERN)
    both = packing.byte_bpe_encoder(public.path("byte_bpe_50k.json"), ranks, public.PATTERN)
    assert encode("one two") == both("one two")
    with pytest.raises(Exception):
        encode("one <|endoftext|>")
    assert len(both("one <|endoftext|>")) > 4


def test_mixing(spark, edges, none):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(200):
        kind = rng.choice(["good", "good", "good", "low"])
        rows.append((i, " ".join(rng.choice(["alpha", "beta", "gamma"] if kind == "good" else ["xx", "yy"]) for _ in range(40))))
        labels.append((i, kind))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels[:100] + [(None, "good"), (5, None)], "doc_id long, domain string")
    got = mixing.mix(docs, table, {"good": 0.9, "low": 0.1}).toPandas().set_index("doc_id")
    kinds = dict(labels)
    assert all((got.p_good > 0.5) == [kinds[i] == "good" for i in got.index])
    for d, share in (("good", 0.9), ("low", 0.1)):
        total = (got.n_words * got.p_good).sum() / 0.9
        assert abs((got.n_words * got[f"p_{d}"] * got.rate).sum() - share * total) <= 2e-3 * total
    # The same descent, plainly.
    p, n = got[["p_good", "p_low"]].to_numpy(), got.n_words.to_numpy()
    have, rate = n @ p, np.ones(len(got))
    budget = have[0] / 0.9
    for _ in range(mixing.ITERATIONS):
        miss = (n * rate) @ p - budget * np.array([0.9, 0.1])
        if abs(miss).max() <= mixing.TOLERANCE * budget:
            break
        rate = np.maximum(0, rate - p @ (miss / have))
    assert np.allclose(rate, got.rate, atol=1e-9)
    assert mixing.mixed(none, table).count() == 0
    assert {r.rate for r in mixing.mix(edges, table.where("false")).collect()} == {1.0}
    assert mixing.mixed(edges, table.where("false")).columns == edges.columns


def mixed_shares(spark, docs, labels, targets):
    """Tokens of each domain as shares of the budget, added up plainly."""
    got = mixing.mix(docs, labels, targets).toPandas()
    lead = next(iter(targets))
    budget = (got.n_words * got[f"p_{lead}"]).sum() / targets[lead]
    return {d: (got.n_words * got[f"p_{d}"] * got.rate).sum() / budget for d in targets}


def test_mixing_meets_the_targets_on_soft_domains(spark):
    """Domains that share most of their words, as in the given labels: 40 steps of descent leave the rarest one far off."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", mixing.domain_of_labels().alias("domain"))
    got = mixed_shares(spark, docs, labels, mixing.TARGETS)
    for d, share in mixing.TARGETS.items():
        assert abs(got[d] - share) <= 1.001 * mixing.TOLERANCE, got


def test_mixing_reports_targets_out_of_reach(spark):
    """All texts are alike, so no rates can tell the domains apart."""
    docs = spark.createDataFrame([(i, "same words here") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "good" if i % 2 else "low") for i in range(20)], "doc_id long, domain string")
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        got = mixed_shares(spark, docs, labels, {"good": 0.9, "low": 0.1})
    assert abs(got["good"] - got["low"]) < 1e-6


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.1 * rng.standard_normal(16)]) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(30)] + [(None, rows[1][1]), (700, None), (720, []), (740, [0.0] * 16), (760, [float("nan")] * 16)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    known = [(i, np.array(v)) for i, v in rows if i is not None and v and np.isfinite(v).all() and any(v)]
    ids, matrix = np.array([i for i, _ in known]), np.stack([v for _, v in known])
    hits = wanted = 0
    for q in ids[ids % 20 == 0]:
        scores = matrix @ matrix[ids == q][0]
        order = [j for j in np.lexsort((ids, -scores.round(9))) if ids[j] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and (mine.score.diff().dropna() <= 1e-12).all()
        hits, wanted = hits + len(set(mine.vec_id) & set(ids[order])), wanted + 20
    assert hits / wanted >= 0.9 and set(got.query_id) == set(ids[ids % 20 == 0])
    assert neighbours.search(spark.createDataFrame(rows[-3:], "vec_id long, embedding array<double>")).count() == 0


def test_hilbert_neighbours_touch():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = neighbours.hilbert_keys(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_lm_score(spark, edges, none):
    rng = random.Random(7)
    rows = [(i, " ".join(["red", "green", "blue"] * 20)) for i in range(300)]
    rows.append((900, " ".join(rng.choice(["red", "green", "blue"]) for _ in range(60))))
    got = {r.doc_id: r for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got[0].mean_log_likelihood > got[900].mean_log_likelihood and got[0].n_tokens == 60
    net = lm_score.Network.fresh()
    context, total = np.array([[1, 2, 3, 4]]), 0.0
    for word in range(lm_score.VOCABULARY + lm_score.HASHED):
        total += float(np.exp(net.log_probability(context, np.array([word]))[0]))
    assert abs(total - 1) < 1e-3
    rows = lm_score.score(edges).collect()
    assert len(rows) == len(EDGES) and {r.mean_log_likelihood for r in rows if r.n_tokens == 0} == {None}
    assert lm_score.score(none).count() == 0


def test_lm_score_gives_every_word_its_own_probability(spark):
    """Each word once as a text of its own, so all with the same context: probabilities sum to one, and words of a group
    differ by their counts."""
    rest = {f"rare{i}": 1 + i % 2 for i in range(3000)}
    words = [f"top{i}" for i in range(lm_score.VOCABULARY)] + list(rest)
    again = [w for w, n in rest.items() if n == 2]
    tops = [" ".join(f"top{i}" for i in range(j, lm_score.VOCABULARY, 64)) for j in range(64)]
    rows = [(i, w) for i, w in enumerate(words)] + [(10_000 + i, t) for i, t in enumerate(tops + tops + [" ".join(again)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {words[r.doc_id]: r.log_likelihood for r in lm_score.score(docs).collect() if r.doc_id < 10_000}
    assert abs(sum(np.exp(v) for v in got.values()) - 1) < 1e-3
    groups = collections.defaultdict(list)
    for w in rest:
        groups[zlib.crc32(w.encode()) % lm_score.HASHED].append(w)
    for members in groups.values():
        first = members[0]
        for w in members:
            assert abs(got[w] - got[first] - np.log(rest[w] / rest[first])) < 1e-4
    known, _ = lm_score.vocabulary(spark.range(10_000).selectExpr("concat('w', id) w", "9L count"))
    assert len(known.words) == lm_score.VOCABULARY
    known, _ = lm_score.vocabulary(spark.range(10_000).selectExpr("concat('w', id) w", "900L count"))
    assert len(known.words) == 10_000


def test_lm_score_joins_only_words_that_tasks_cannot_count(spark, monkeypatch):
    """The next words after the frequent ones need no join; the scores are those of a join of all."""
    words = [f"top{i}" for i in range(lm_score.VOCABULARY)] * 9 + [f"next{i}" for i in range(40)] * 5 + [f"last{i}" for i in range(50)] * 3
    rows = [(i, " ".join(words[i::97])) for i in range(97)] + [(97, None), (98, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    scores = []
    for counted in (40, 1, 10_000):
        monkeypatch.setattr(lm_score, "COUNTED", counted)
        known, _ = lm_score.vocabulary(lm_score.count_words(docs))
        joined = {w.w for r in lm_score.numbered(docs, known).collect() for w in r.rest}
        assert len(known.words) == lm_score.VOCABULARY and len(joined) == {40: 50, 1: 90, 10_000: 0}[counted]
        assert counted != 40 or {w[:4] for w in joined} == {"last"}
        scores.append([(r.doc_id, r.n_tokens, r.log_likelihood) for r in lm_score.score(docs).orderBy("doc_id").collect()])
    assert scores[0][0][1] > 0
    for other in scores[1:]:
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 for a, b in zip(scores[0], other, strict=True))


@pytest.mark.parametrize("scale", [1, 400])
def test_lm_network_learns_like_a_plain_one(scale):
    """One step of Adagrad and the probabilities after it, against a softmax over all outputs in double precision; the larger
    weights give logits that ``exp`` does not hold."""
    outputs, width, size = 256, lm_score.WIDTH, lm_score.CLASS_SIZE
    net = lm_score.Network.fresh(outputs)
    net.parts["classes"] *= scale
    net.parts["words"] *= scale
    rng = np.random.default_rng(3)
    context, target = rng.integers(0, outputs + 1, (500, 4)), np.append(rng.integers(0, 64, 250), rng.integers(130, outputs, 250))

    def plain(embed, classes, words):
        h = np.append(np.tanh(sum(embed[j][context[:, j]] for j in range(4))), np.ones((len(context), 1)), axis=1)
        parts = [h @ classes, np.einsum("ni,nij->nj", h, words[target // size])]
        shares = [np.exp(x - x.max(1, keepdims=True)) for x in parts]
        return h, [x / x.sum(1, keepdims=True) for x in shares]

    before = [p.astype(np.float64) for p in net.parts.values()]
    h, shares = plain(*before)
    rows, slots, want = np.arange(len(target)), (target // size, target % size), [np.zeros_like(p) for p in before]
    for share, slot in zip(shares, slots, strict=True):
        share[rows, slot] -= 1
    want[1] = h.T @ shares[0] / len(target)
    np.add.at(want[2], target // size, np.einsum("ni,nj->nij", h, shares[1]) / len(target))
    back = shares[0] @ before[1][:width].T + np.einsum("nj,nij->ni", shares[1], before[2][target // size, :width])
    for j in range(4):
        np.add.at(want[0][j], context[:, j], back * (1 - h[:, :width] ** 2) / len(target))
    squares = lm_score.Network(np.zeros_like(net.flat), outputs)
    net.learn(context, target, squares)
    for name, gradient in zip(net.parts, want, strict=True):
        assert np.allclose(np.sqrt(squares.parts[name]), np.abs(gradient), rtol=2e-3, atol=2e-5 * scale)
    _, shares = plain(*(p.astype(np.float64) for p in net.parts.values()))
    logs = sum(np.log(np.maximum(share[rows, slot], 1e-300)) for share, slot in zip(shares, slots, strict=True))
    assert np.allclose(net.log_probability(context, target), logs, rtol=1e-3, atol=1e-3)


def test_lm_score_trains_on_every_word(spark):
    """A text of period four: a fixed stride of four would show the network only one of its words as target."""
    rows = [(i, " ".join(["north", "east", "south", "west"] * 50)) for i in range(600)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert min(r.mean_log_likelihood for r in got) > -0.5


def test_revisits(spark):
    kind = "record_id long, url string, ts long, kind string, headers map<string,string>, digest string, outcome int"
    rows = [
        (1, "http://WWW.a.org/x/?utm_source=f#top", 1, "response", {"ETag": "e", "Content-Type": "t"}, "d1", 0),
        (2, "https://a.org:443/x", 2, "response", {"etag": "f"}, "d2", 0),
        (3, "a.org/x", 2, "revisit", {"ETag": "e", "Date": "n", "Content-Type": "no"}, None, 0),
        (4, "a.org/x", 3, "revisit", {"ETag": "e"}, None, 0), (5, "a.org/x", 4, "revisit", None, None, 0),
        (6, None, 5, "revisit", {"ETag": "e"}, None, 0), (7, "b.org", 5, "revisit", {"ETag": "e"}, None, 0),
    ]
    got = {r.record_id: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, kind)).collect()}
    assert [got[i].outcome for i in range(1, 8)] == ["full", "full", "resolved", "changed", "unchecked", "missing", "missing"]
    assert got[3].payload_id == 1 and got[3].headers == {"content-type": "t", "etag": "e", "date": "n"}
    assert revisits.resolve_revisits(spark.createDataFrame([], kind)).count() == 0
    # One hot page over many runs.
    many = [(i, "h.org", i, "response" if i % 50 == 0 else "revisit", {"etag": str(i // 50)}, str(i), 0) for i in range(2000)]
    hot = revisits.resolve_revisits(spark.createDataFrame(many, kind).repartition(8)).collect()
    assert all(r.outcome in ("full", "resolved") and r.payload_id == r.record_id // 50 * 50 for r in hot)
