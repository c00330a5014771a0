"""Clustering, lexical search and language-model scoring against brute force on
small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from beatline.llm import centroids, lexical, ngram_model
from test_operators import BLANK, awkward, low, make, words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- centroid clustering ------------------------------------------------------

def vectors(n=90, dim=64):
    r = random.Random(8)
    centre = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in centre[i % 5]]) for i in range(n)]
    rows += [(200 + i, rows[7][1]) for i in range(40)]  # a group of copies
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1])]  # repeated and null ids
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 63 + [None]), (304, [0.5] * 63 + [float("nan")]),
             (305, [0.5] * 63 + [float("inf")]), (306, [-0.0] * 64), (307, [-1e-9] * 64)]
    return rows


def cluster_by_hand(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, z)) for z in c]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (a, _) in zip(kept, of) if a == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    of = assign()
    inertia = Counter()
    for a, d in of:
        inertia[a] += d
    sha = [hashlib.sha256(",".join(map(str, z)).encode()).hexdigest() for z in c]
    return sorted(((i, a, d, inertia[a], sum(inertia.values()), sha[a]) for (i, _), (a, d) in zip(kept, of)), key=str)


@pytest.mark.parametrize("slice_rows", [1 << 15, 7])
def test_clusters_equal_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(centroids, "SLICE_ROWS", slice_rows)
    rows = vectors()
    df = make(spark, rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, centroids.cluster(df).collect()), key=str) == cluster_by_hand(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.25] * 64), (2, [0.5] * 64)]
    assert sorted(map(tuple, centroids.cluster(make(spark, rows, "vec_id long, embedding array<float>")).collect()), key=str) \
        == cluster_by_hand(rows)
    null = centroids.cluster(make(spark, [(None, [0.25] * 64)], "vec_id long, embedding array<float>")).collect()
    assert list(map(tuple, null)) == [(None,) * 6]
    assert centroids.cluster(make(spark, [], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("distinct", [1, 3, 5000])
def test_dictionaries_are_lossless(distinct):
    r = np.random.default_rng(4)
    x = r.integers(-400, 400, (distinct, 64))[r.integers(0, distinct, 700)]
    codes, entries = centroids.encode(x)
    assert (np.concatenate([e[c] for c, e in zip(codes, entries)], axis=1) == x).all()
    assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)


def test_a_component_beyond_the_bound_is_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(make(spark, [(1, [1e9] * 64)], "vec_id long, embedding array<double>")).collect()


# --- ranked lexical search ----------------------------------------------------

def rank_by_hand(docs, items, n=10):
    terms = [(i, Counter(ALNUM.findall(low(t)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    big_n, big_l = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    weight = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        asked = ALNUM.findall(low(text))
        scored = []
        for i, c in terms:
            m = 25 + 75 * sum(c.values()) * big_n // big_l
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:n])]
    return sorted(out, key=str)


def questions(docs):
    r = random.Random(3)
    out = [(100 + i, " ".join(r.sample(t.split(), min(len(t.split()), 12)))) for i, t in docs if t and i and i % 3 == 0]
    return out + [(1, None), (2, ""), (3, "..."), (4, "never seen"), (5, "same SAME same w1"), (6, "w1 w2 w3 " * 40), (None, "w5 w6 w7"),
                  (7, "w1"), (7, "w2 w2"), (8, "é 漢字 ÄÖ"), (9, " ".join(f"w{i}" for i in range(400)))]


@pytest.mark.parametrize("bytes_at_once, block_bytes", [(8 << 20, 8 << 20), (2000, 400)])
def test_search_equals_brute_force(spark, monkeypatch, bytes_at_once, block_bytes):
    monkeypatch.setattr(lexical, "INDEX_BYTES", bytes_at_once)
    docs = awkward()
    items = questions(docs)
    got = lexical.search(make(spark, docs).repartition(3), make(spark, items, "item_id long, text string"), block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == rank_by_hand(docs, items)


def test_bounds_are_never_below_the_scores_and_exclude_documents(spark):
    docs = [(i, " ".join(words(i, 30 + i % 300, vocabulary=3000))) for i in range(900)]
    blocks = lexical.index(make(spark, docs)).collect()
    asked = lexical.Queries([" ".join(words(i, 12, vocabulary=3000)).encode() for i in (5, 77, 500)])
    weights = np.full(len(asked.vocabulary), 2500)
    checked = excluded = 0
    for row in blocks:
        block = lexical.Block(row.asDict(), asked.vocabulary, weights, 900, 160_000)
        for terms, n in zip(asked.terms, asked.times):
            times = np.zeros(len(asked.vocabulary), np.int64)
            times[terms] = n
            bound = block.bounds(asked.vocabulary[terms], weights[terms] * n)
            exact = block.scores(np.arange(len(block.ids)), times)
            assert (bound >= exact).all()
            checked += len(exact)
            excluded += int((bound < exact.max()).sum())
    assert checked == 2700 and excluded > 0.9 * checked


def test_search_of_empty_tables(spark):
    docs, items = make(spark, []), make(spark, [], "item_id long, text string")
    assert lexical.search(docs, make(spark, [(1, "a")], "item_id long, text string")).collect() == []
    assert lexical.search(make(spark, [(1, "a")]), items).collect() == []
    assert lexical.search(make(spark, [(1, None), (2, "")]), make(spark, [(1, "a")], "item_id long, text string")).collect() == []


# --- language-model scoring ---------------------------------------------------

def score_by_hand(docs, order=3):
    texts = [(i, tuple([*BLANK.findall(low(t)), None])) for i, t in docs]
    out_of = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts]
    count = Counter(w[a:a + k + 1] for (_, w), h in zip(texts, out_of) if not h for k in range(order) for a in range(len(w) - k))
    n = sum(c for g, c in count.items() if len(g) == 1)
    kinds = [sum(len(g) == k + 1 for g in count) for k in range(order)]
    base = lambda w: (count[(w,)] + 0.1) / (n + 0.1 * (kinds[0] + 1))

    def p(gram):
        if len(gram) == 1:
            return base(gram[0])
        d = kinds[len(gram) - 1] / max(1, kinds[len(gram) - 2])
        low_p = p(gram[1:])
        return (count[gram] + d * low_p) / (count[gram[:-1]] + d) if d else low_p

    out = []
    for (i, w), h in zip(texts, out_of):
        out.append((i, h, len(w), sum(count[(x,)] > 0 for x in w), n, sum(math.log10(base(x)) for x in w),
                    sum(math.log10(p(w[max(0, a - order + 1):a + 1])) for a in range(len(w)))))
    return out


def same_rows(got, want):
    key = lambda r: (str(r[:5]), round(r[5], 4), round(r[6], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order, size", [(3, 8 << 20), (3, 900), (1, 900), (4, 2000)])
def test_scores_equal_brute_force(spark, monkeypatch, order, size):
    monkeypatch.setattr(ngram_model, "PACK_BYTES", size)
    monkeypatch.setattr(ngram_model, "BUCKET_BYTES", 3000)
    docs = awkward()
    same_rows(ngram_model.score(make(spark, docs).repartition(3), order=order).collect(), score_by_hand(docs, order))


def test_scores_without_training_rows(spark):
    docs = [(None, "a b"), (None, None)]
    same_rows(ngram_model.score(make(spark, docs)).collect(), score_by_hand(docs))
    assert ngram_model.score(make(spark, [])).collect() == []


def test_higher_orders_help_on_held_out_texts(spark):
    r = random.Random(1)
    follow = {i: [r.randrange(60) for _ in range(4)] for i in range(60)}

    def text():
        w = [r.randrange(60)]
        for _ in range(80):
            w.append(r.choice(follow[w[-1]]))
        return " ".join(f"w{x}" for x in w)

    rows = ngram_model.score(make(spark, [(i, text()) for i in range(300)])).filter("held_out").collect()
    assert len(rows) > 15 and sum(r.score for r in rows) > 0.6 * sum(r.base_score for r in rows)


def test_probabilities_of_a_state_add_up():
    """Over all known words and one unknown, from every state of the automaton."""
    r = random.Random(2)
    texts = [" ".join(f"w{r.randrange(6)}" for _ in range(15)).encode() for _ in range(20)] + [
        " ".join(f"w{a} w{b} w{c}" for c in range(6)).encode() for a in range(6) for b in range(6)]
    train = np.arange(len(texts)) < 20
    grams = ngram_model.Grams([*texts, b"unknown"], 3)
    counts = grams.counts(np.append(train, False))
    distinct = [int((c > 0).sum()) for c in counts]
    model = ngram_model.Automaton(grams, counts, int(counts[0].sum()), distinct)
    all_words = np.arange(len(counts[0]))
    assert len(all_words) == 8  # six words, the end, one unknown
    histories = [s for s in range(1 + len(counts[0]) + len(counts[1])) if s == 0 or
                 (counts[0][s - 1] > 0 if s <= len(counts[0]) else counts[1][s - 1 - len(counts[0])] > 0)]
    for s in histories:
        arcs = model.arcs[:-1]
        reach = arcs[arcs >> 32 == s] & 0xFFFFFFFF
        _, p = model.step(np.full(8, s), all_words)
        assert set(reach) <= set(all_words) and (p <= 0).all()
    _, p = model.step(np.zeros(8, np.int64), all_words)
    assert abs((10 ** p).sum() - 1) < 1e-9
    a = int(np.argmax(counts[0][:]))
    if grams.keys[0][a] != ngram_model._END:
        _, p = model.step(np.full(8, 1 + a), all_words)
        assert abs((10 ** p).sum() - 1) < 1e-9


# --- chats whose roles the decoder does not see

def test_registered_chat_query_decodes(spark):
    from beatline.llm.common import table
    from beatline.llm.queries import QUERIES
    from conftest import SF_MID
    rows = QUERIES["op7_chat_formatting"](spark, SF_MID).collect()
    assert all(r.marked is None for r in rows)  # no text there holds a marker, and the roles are hidden
    first = [r for r in rows if r.part == 0]
    assert len(first) == table(spark, SF_MID, "conversations").count()
    right = sum(r.role == r.given for r in first)
    assert 0.95 * len(first) < right < len(first)
