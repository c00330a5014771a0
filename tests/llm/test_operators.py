"""The corpus operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F

import brute
from beatline.llm import (chat, common, decontaminate, jaccard, licenses, packing, quality, secrets,
                          substring_dedup, token_counts, warc)
from beatline.llm.common import pick

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def make(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def awkward():
    """Documents with nulls, empty, blank, long, repeated and shared texts."""
    r = random.Random(5)
    passage, other = words(1, 60), words(2, 30)
    rows = [(1, None), (2, ""), (3, " \t\n \x0b\x0c\r"), (None, "a b c d e f g h i j k l m n o p"), (4, "one two"),
            (5, "one two"), (5, "one two"), (6, "\x00 \x85     x"), (7, "A" * 300 + " b " + "é" * 200),
            (8, " ".join(["same"] * 100)), (9, " ".join(["same"] * 100)), (10, "  lead  " + " ".join(passage) + "  tail  ")]
    for i in range(11, 40):
        w = words(100 + i, r.randrange(5, 120))
        if i % 3 == 0:
            w[2:2] = passage[: r.randrange(10, 60)]
        if i % 4 == 0:
            w += other
        rows.append((i, "\n".join([" ".join(w[:len(w) // 2]), " ".join(w[len(w) // 2:])])))
    base = words(3, 200)
    for i in range(40, 60):  # near copies
        w = list(base)
        for _ in range(i - 40):
            w[r.randrange(len(w))] = f"n{r.random()}"
        rows.append((i, " ".join(w)))
    rows += [(60, rows[12][1]), (61, rows[12][1]), (62, rows[20][1].upper()), (20, "another text of an id that occurs twice in this table a b c d e"),
             (63, " ".join(words(4, 3000))), (64, "ÄÖ ß éé 漢字 😀 " * 9)]
    r.shuffle(rows)
    return rows


def by_row(rows):
    return Counter(map(tuple, rows))


# --- substring dedup

def brute_dedup(rows, k=13):
    least = {}
    cut = [(i, BLANK.findall(t or "")) for i, t in rows]
    for i, w in cut:
        if i is not None:
            for p in range(len(w) - k + 1):
                key = tuple(w[p:p + k])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in cut:
        gone = set()
        if i is not None:
            for p in range(len(w) - k + 1):
                if least[tuple(w[p:p + k])] < i:
                    gone.update(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_dedup_equals_brute_force(spark):
    rows = awkward()
    got = substring_dedup.dedup(make(spark, rows).repartition(3), texts=True).collect()
    assert by_row(got) == by_row(brute_dedup(rows))


def test_dedup_of_equal_hashes_compares_words(monkeypatch):
    monkeypatch.setattr(substring_dedup, "grams", lambda h, k: np.zeros(max(0, len(h) - k + 1), np.uint64))
    text = np.frombuffer(b"a b c d x b c d a b c d ", np.uint8)
    got = substring_dedup.least_holders(text, np.array([1, 1, 1]), np.array([9, 8, 7]), 4)
    assert got.tolist() == [7, 8, 7]


# --- decontamination

def test_decontamination_equals_brute_force(spark):
    rows = awkward()
    items = [(1, " ".join(words(1, 60)[5:40])), (2, " ".join(words(2, 30)).upper()), (3, "one two"), (4, None), (5, ""),
             (6, " ".join(words(1, 60)[50:60] + words(77, 5))), (6, "same"), (10, " ".join(words(9, 50))),
             (None, "same same"), (7, " ".join(words(3, 200)[20:29])), (2, "one two"), (12, "same " * 12)]
    for size in (1 << 24, 600):  # one block, and several
        got = decontaminate.decontaminate(make(spark, rows), make(spark, items, "item_id long, text string"), block_bytes=size).collect()
        assert by_row(got) == by_row(brute.decontaminate(rows, items))


def test_every_shared_window_is_found(spark):
    item = words(50, 40, 30)
    rows = [(p, " ".join(words(1000 + p, 17) + item[p:p + 10] + words(2000 + p, 11))) for p in range(31)]
    got = decontaminate.decontaminate(make(spark, rows), make(spark, [(1, " ".join(item))], "item_id long, text string")).collect()
    assert all(r.n_hit >= 10 and r.contaminated for r in got)


def test_a_prompt_that_thousands_of_items_share(spark):
    prompt = " ".join(words(60, 11))
    items = [(n, f"{prompt} u{n} v{n} x y z") for n in range(8000)] + [(n, prompt) for n in (-3, 9000)]
    rows = [(i, f"doc{i} {prompt} end{i}") for i in range(500)] + [(600, items[17][1]), (601, "clean text")]
    index = decontaminate.Index([(i, t.encode()) for i, t in items])
    # Lists are kept once: that of the whole prompt, and one for each item's own end.
    assert len(index.first) - 1 == 8001 and len(index.items) == 8002 + 8000
    started = time.monotonic()
    texts = decontaminate.Words([t.encode() for _, t in rows], decontaminate.ALNUM, decontaminate.LOWER)
    start, _, _ = index.hits(texts, texts.hashes())
    assert time.monotonic() - started < 1 and len(start) == 500 * 2 + 7
    of = {r.doc_id: r for r in decontaminate.decontaminate(make(spark, rows), make(spark, items, "item_id long, text string")).collect()}
    some = [rows[0], rows[-2], rows[-1]]
    assert [tuple(of[i]) for i, _ in some] == brute.decontaminate(some, items)
    assert of[0].n_items == 8002 and of[601].n_items == 0


def test_decontamination_spans_and_small_output_batches(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ENTRIES", 3)
    item = words(50, 14, 30)
    items = [(i, " ".join(item[i % 4:])) for i in range(6)] + [(9, "zz yy")]
    rows = [(1, " ".join(item)), (2, None), (3, "a zz yy b"), (4, " ".join(["q"] + item[2:] + ["zz", "yy"])), (None, " ".join(item))]
    for size in (1 << 24, 60):
        got = decontaminate.decontaminate(make(spark, rows), make(spark, items, "item_id long, text string"), block_bytes=size, spans=True)
        assert by_row([tuple(r)[:6] for r in got.collect()]) == by_row(brute.decontaminate(rows, items))
        of = {r.doc_id: r for r in got.collect()}
        assert of[3].places == [1, 2] and of[3].items == [9] and of[2].items == []
        assert of[4].places == list(range(1, 15)) and of[4].items == [0, 1, 2, 3, 4, 5, 9]


def test_decontamination_of_texts_longer_than_a_slice(spark):
    item = words(70, 30)
    long = words(71, 900_000, 10 ** 6)
    assert len(" ".join(long)) > 5 << 20
    long[850_000:850_000] = item
    rows = [(1, " ".join(long)), (2, " ".join(item[5:20]))]
    items = [(5, " ".join(item)), (6, "a b")]
    got = decontaminate.decontaminate(make(spark, rows), make(spark, items, "item_id long, text string")).collect()
    assert by_row(got) == by_row(brute.decontaminate(rows, items))


# --- jaccard

def brute_components(rows):
    sets = []
    for i, t in rows:
        w = BLANK.findall(low(t))
        sets.append({tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]):
                continue
            if rows[a][0] == rows[b][0] or sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 1 << 60)
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(least[root(x)], i)
    return [(i, len(s), None if i is None else least[root(x)]) for x, ((i, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("frequent", [16, 3])
def test_components_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", frequent)  # 3: token pairs are indexed
    rows = awkward()
    got = jaccard.jaccard_components(make(spark, rows).coalesce(2)).collect()
    assert by_row(got) == by_row(brute_components(rows))


@pytest.mark.parametrize("rounds", [0, 2])
def test_components_of_a_crowded_key(spark, monkeypatch, rounds):
    """A passage that all documents share, of which some link and most do not,
    with the key dealt to many tasks and sizes in many bands."""
    for name, value in (("SPLIT", 3), ("ACROSS", 2), ("MOST_SPLITS", 7), ("CROWD", 4), ("ROUNDS", rounds)):
        monkeypatch.setattr(jaccard, name, value)
    r = random.Random(12)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for family in range(14):
        own = [f"f{family}w{i}" for i in range(r.choice([2, 6, 20, 60, 150]))]
        for _ in range(r.choice([1, 1, 4])):
            w = passage + own
            for _ in range(r.randrange(0, 1 + len(w) // 30)):
                w[r.randrange(len(w))] = f"x{r.randrange(999)}"
            rows.append((len(rows) + 1, " ".join(w[: r.randrange(len(w) * 7 // 10, len(w) + 1)])))
    rows += [(None, rows[0][1]), (3, rows[9][1]), (50, rows[1][1]), (50, rows[1][1]), (51, ""), (52, None)]
    got = jaccard.jaccard_components(make(spark, rows).repartition(5)).collect()
    want = brute_components(rows)
    assert len({c for _, _, c in want}) > 5
    assert by_row(got) == by_row(want)


def test_histograms_are_written_once(spark, monkeypatch):
    """However many rounds there are; sets are made where pairs pass them."""
    passes, rounds = [], []
    made, verify = jaccard.set_parts, jaccard.verify
    monkeypatch.setattr(jaccard, "set_parts", lambda *a: passes.append(a[-1]) or made(*a))
    monkeypatch.setattr(jaccard, "verify", lambda *a: rounds.append(1) or verify(*a))
    jaccard.jaccard_components(make(spark, awkward())).collect()
    assert len(rounds) > 2 and passes[0] == "histograms" and passes.count("histograms") == 1
    assert len(passes[1:]) <= len(rounds) and set(passes[1:]) == {"sets"}


def test_bitmaps_grow_with_the_ids():
    assert common.bitmap_bits(0) == common.bitmap_bits(1_000_000) == 1 << 23
    assert 8 * 5_000_000 <= common.bitmap_bits(5_000_000) <= 16 * 5_000_000
    assert common.bitmap_bits(1 << 40) == common.MOST_BITMAP_BITS


def test_index_keys_lose_no_link():
    """Every linked pair shares a key, whatever tokens are taken as frequent."""
    r = random.Random(8)
    texts = []
    for _ in range(60):
        base = [f"a{r.randrange(9)}" for _ in range(r.choice([4, 6, 9, 15, 30, 70, 150, 400]))]
        for _ in range(5):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = f"b{r.randrange(99)}"
            texts.append(" ".join(w[: r.randrange(max(1, len(w) * 9 // 10), len(w) + 1)]).encode())
    sets = jaccard.Sets(texts)
    everything = np.unique(sets.tokens)
    own = [set(sets.tokens[a:b].tolist()) for a, b in zip(sets.first[:-1], sets.first[1:])]
    linked = [(a, b) for a in range(len(texts)) for b in range(a)
              if own[a] != own[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])]
    assert len(linked) > 50
    for share in (0, 0.5, 1):
        chosen = everything[np.random.default_rng(1).random(len(everything)) < share]
        keys, text = jaccard.index_keys(sets, np.arange(len(texts)), (chosen, np.arange(1, len(chosen) + 1)))
        of = defaultdict(set)
        for k, t in zip(keys.tolist(), text.tolist()):
            of[t].add(k)
        assert all(of[a] & of[b] for a, b in linked)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# --- quality

def test_quality_base_features(spark):
    rows = awkward() + [(70, "x\nx\n \n \nx y\n\nx y\nx "), (71, "#*$ %&| <> a # é漢")]
    labels = make(spark, [(i, i % 2, 0) for i in range(11, 60)] + [(None, 1, 0), (11, 1, 0), (12, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality(make(spark, rows), labels).collect()
    want = []
    for i, t in rows:
        t = t or ""
        w, seen, dup = BLANK.findall(t), set(), 0
        for line in t.split("\n"):
            if BLANK.search(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(w[p:p + 3]) for p in range(len(w) - 2))
        again = {q for p in range(len(w) - 2) if grams[tuple(w[p:p + 3])] > 1 for q in range(p, p + 3)}
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(again),
                     len(w) < 50 or 100 * len(again) > 50 * len(w)))
    assert by_row([r[:7] for r in out]) == by_row(want)
    assert not any(r.kept and r.base_failed for r in out)


def test_quality_separates_held_out_documents(spark):
    r = random.Random(4)
    good = [(i, " ".join(words(i, 150))) for i in range(300)]
    bad = [(1000 + i, " ".join(f"junk{r.randrange(300)}" for _ in range(150))) for i in range(60)]
    labels = make(spark, [(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in quality.quality(make(spark, good + bad), labels).collect()}
    assert all(out[i].kept for i in range(200, 300))
    assert not any(out[i].kept for i, _ in bad)


def test_quality_cut_follows_the_labels(spark):
    r = random.Random(6)
    good = [(i, " ".join(words(i, 150))) for i in range(300)]
    bad = [(1000 + i, " ".join(w + r.choice(["%%%", "&&&", "", "", "", "", ""]) for w in words(1000 + i, 150))) for i in range(60)]
    labels = [(i, 1, 0) for i in range(200)] + [(1000 + i, 0, 0) for i in range(30)] + [(1000, 0, 0), (None, 0, 0), (2000, 0, 0)]
    out = {x.doc_id: x for x in quality.quality(make(spark, good + bad), make(spark, labels, "doc_id long, quality int, toxic int")).collect()}
    assert sum(out[i].kept for i, _ in bad) <= 6
    assert sum(out[i].kept for i, _ in good) >= 295


def test_quality_best_cut():
    cut = lambda *rows: quality.best_cut(*map(np.array, zip(*rows)))
    assert cut((-50, 0, 3), (-20, 0, 1), (10, 4, 0)) == -4  # between -20 and 10
    assert cut((-50, 0, 9), (-20, 1, 1), (10, 99, 0)) == -4  # one good document is lost
    fixed = round(quality.THRESHOLD * quality._POINT) // quality._BIN
    assert cut((5, 3, 0)) == cut((5, 3, 3)) == fixed and cut((fixed - 7, 3, 0)) == fixed - 7
    assert quality.best_cut(*[np.zeros(0, np.int64)] * 3) == fixed


def test_quality_score_does_not_depend_on_partitions(spark):
    docs, labels = make(spark, awkward()), make(spark, [(i, 1, 0) for i in range(11, 30)], "doc_id long, quality int, toxic int")
    a, b = (by_row(quality.quality(docs.repartition(n), labels).collect()) for n in (1, 5))
    assert a == b


# --- secrets

SECRETS = [
    (1, "x password = \"abc123DEF\" and PASSWD:short1 then token=ab"), (2, "password=token: abcdefgh"), (3, None), (4, ""),
    (5, "é漢😀 API_KEY='0123456789abcdef0123456789abcdef' ok"), (6, "AKIA" + "A" * 15), (7, "xAKIA" + "Z9" * 8 + " AKIAAKIA" + "0" * 30),
    (8, "deadbeef" * 3 + "g" + "0" * 23 + " " + "f" * 24), (9, "token==abcdef secret : 'a.b/c+d=e-f_g'"), (10, "tok en=abcdefgh"),
    (11, "-----BEGIN RSA PRIVATE KEY-----\nxx"), (12, "ghp_" + "a1B2" * 9), (13, "postgres://user:pa55w@host.example/db"),
    (14, "Authorization: Bearer abcdefghijklmnop1234"), (15, "pass word secre token"), (1, "token=abcdef"), (None, "secret=abcdefg"),
    (16, "secret= secret=secret:x=123456"), (17, "token = \"" + "k" * 5000 + "\" " + "b" * 70000),
]


def brute_spans(text):
    out = []
    for no, rule in enumerate(secrets.RULES):
        pattern = "[0-9a-f]+" if rule.kind == "hex" else rule.pattern
        for m in re.finditer(pattern, text or "", re.A):
            if len(m[rule.group]) >= (24 if rule.kind == "hex" else rule.least):
                out.append((m.start(), no, m.end(), rule.kind))
    return sorted(out)


def test_secrets_equal_brute_force(spark):
    got = secrets.report(make(spark, SECRETS)).collect()
    want = []
    for i, t in SECRETS:
        spans = brute_spans(t)
        text = [f"{k}:{a}:{b}" for a, _, b, k in spans]
        base = [f"{k}:{a}:{b}" for a, no, b, k in spans if no < 3]
        n = Counter(no for _, no, _, _ in spans)
        want.append((i, n[0], n[1], n[2], hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(text)))
    assert by_row(got) == by_row(want)


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_hold_for_every_match(rule):
    query = secrets.trigram_query(rule.pattern)
    assert bool(query) == (rule.kind != "hex")
    for _, text in SECRETS:
        if any(re.finditer(rule.pattern, text or "")):
            lower = low(text)
            grams = {lower[p:p + 3] for p in range(len(lower) - 2)}
            assert all(any(alt <= grams for alt in clause) for clause in query)


@pytest.mark.parametrize("bits", [16, 1])
def test_only_candidates_move_to_their_rules(spark, monkeypatch, bits):
    monkeypatch.setattr(secrets, "BITS_A_KEY", bits)
    rows = spark.range(200_000).select(F.xxhash64("id").alias("key"), "id")
    found = rows.filter("id % 40 = 0").select("key", F.array(F.lit(1)).alias("rules"))
    out = secrets.with_rules(rows, found)
    assert out.count() == 200_000 and out.filter("(id % 40 = 0) <> (rules is not null)").count() == 0
    some = secrets.with_rules(rows.filter("id < 100"), found.filter("key is null"))
    assert some.count() == 100 and some.filter("rules is not null").count() == 0


def test_secrets_with_nothing_and_with_all_rows_found(spark):
    for text in ("plain words", "password = hunter2hunter2"):
        rows = [(i % 5 if i % 7 else None, text) for i in range(60)] + [(1, None)]
        got = secrets.report(make(spark, rows)).collect()
        assert len(got) == 61 and sum(r.n_assign for r in got) == 60 * ("=" in text)


# --- licenses

def test_licenses_equal_brute_force(spark):
    rows = awkward() + [
        (80, "All rights reserved, ALL-RIGHTS-RESERVED. CC BY 4.0"), (81, "cc"), (82, "by cc"), (83, "cc by"), (84, "allé rights reserved"),
        (85, "GNU General\nPublic (License) v3 " * 3), (86, "This work is licensed under the GNU General Public License, version 3."),
        (87, "Released under the MIT License."), (88, "Licensed under the Apache License, Version 2.0"), (89, "under the license of the"),
        (90, "Permission is granted free of charge, to any person obtaining a copy of this software and its associated documentation "
             "files (the Software) to deal in the Software without restriction"), (80, "cc by cc by")]
    got = licenses.find_licenses(make(spark, rows)).collect()
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
        at = [(p, label) for phrase, label in licenses.PHRASES.items() for p in range(len(w))
              if w[p:p + len(phrase.split())] == phrase.split()]
        places = [p for p, _ in at]
        want.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    assert by_row([r[:6] for r in got]) == by_row(want)
    of = {r.doc_id: r for r in got}
    assert of[86].labels == "gpl" and of[87].labels == "mit" and of[88].labels == "apache-2.0" and of[90].labels == "mit"
    assert of[89].labels == "" and of[89].score == 0 and 0.8 <= of[90].score < 1
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in got)


def brute_labels(rows, notices, share=0.8, reach=6):
    """Labels and score by plain counting along the diagonals."""
    out = []
    for i, t in rows:
        cut = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(x))
        w, labels, score = cut(t), set(), 0.0
        for label, text, exact in [(x, p, True) for p, x in licenses.PHRASES.items()] + [(x, p, False) for x, p in notices]:
            n = cut(text)
            held = defaultdict(set)
            for p in range(len(w) - 1):
                for k in range(len(n) - 1):
                    if w[p:p + 2] == n[k:k + 2]:
                        held[p - k].add(k)
            for d in held:
                got = held[d] if exact else set().union(*[held.get(e, ()) for e in range(d, d + reach + 1)])
                part = len(got) / (len(n) - 1)
                if part >= (1 if exact else share):
                    labels.add(label)
                    score = max(score, part)
        out.append((i, ",".join(sorted(labels)), score))
    return out


def test_license_labels_equal_brute_force(spark):
    rows = awkward() + [
        (70, "licensed under cc by nc cc by nc cc by nc cc by nc"), (71, "licensed under cc by nc"), (72, "under cc by nc under cc"),
        (73, "Apache License\n  Version 2.0, January 2004\nhttp://www.apache.org/licenses/"), (74, licenses.TEMPLATES[2][1] * 3),
        (75, licenses.TEMPLATES[2][1].replace(" any ", " ").replace("hereby", "so hereby and x y")), (76, "of the of the software the software"),
        (77, "GNU LESSER GENERAL PUBLIC LICENSE Version 3"), (71, None)]
    got = licenses.find_licenses(make(spark, rows)).collect()
    assert by_row([(r.doc_id, r.labels, r.score) for r in got]) == by_row(brute_labels(rows, licenses.TEMPLATES))
    of = {r.doc_id: r for r in got if r.n_words}
    assert "cc-by-nc" in of[70].labels and "apache-2.0" in of[73].labels and of[74].labels == "mit" == of[75].labels


def test_license_texts_as_a_parameter(spark, monkeypatch):
    text = " ".join(words(90, 700, 60))
    notices = [("own", text), ("own", text), ("word", "single"), (None, "a b c"), ("two", "a b"), ("none", None)]
    far = text.split()
    rows = [(1, "x " + text + " y"), (2, " ".join(far[:300] + ["new"] * 4 + far[300:])), (3, " ".join(far[:500])), (4, "c a b"), (5, "single"),
            (6, " ".join(far[:300] + words(91, 40) + far[300:]))]
    frame = make(spark, notices, "label string, text string")
    for most in (200_000, 0):  # broadcast, and left to Spark
        monkeypatch.setattr(licenses, "MOST_PAIRS", most)
        got = licenses.find_licenses(make(spark, rows), notices=frame).collect()
        want = brute_labels(rows, [n for n in notices if None not in n and n[0] != "word"])
        assert by_row([(r.doc_id, r.labels, r.score) for r in got]) == by_row(want)
    assert {r.doc_id: r.labels for r in got} == {1: "own", 2: "own", 3: "", 4: "two", 5: "", 6: ""}


# --- WARC

PAGES = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/\r\nX: y", None), (4, "u", ""), (5, "u", "é漢😀\r\n\r\nx"),
         (6, "u", "big" * 6_000_000), (None, "u", "<p>x</p>"), (7, "u", "<p>x</p>"), (7, "u", "<p>x</p>"), (8, "u", "WARC/1.1\r\n\r\n")]


def test_warc_round_trip(spark):
    got = warc.round_trip(make(spark, PAGES, "page_id long, url string, html string").repartition(2)).collect()
    largest = {}
    for i, _, h in PAGES:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        to = largest.get(h or "")
        revisit = to is not None and (i is None or i < to)
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    assert by_row(got) == by_row(want)


def test_archives_are_plain_gzip_files_of_one_member_a_record(spark, tmp_path):
    warc.write_archives(make(spark, PAGES, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    for name in os.listdir(tmp_path / "w"):
        if name.startswith("part-"):
            data = (tmp_path / "w" / name).read_bytes()
            records = list(warc.read_records(io.BytesIO(data), 1000))
            assert len(records) >= len(PAGES) and gzip.decompress(data).count(b"WARC-Record-ID") == len(records)
            broken = bytearray(data)
            broken[len(data) // 2] ^= 255
            with pytest.raises(ValueError):
                list(warc.read_records(io.BytesIO(bytes(broken))))
            with pytest.raises(ValueError):
                list(warc.read_records(io.BytesIO(data[:-5])))


def test_small_payloads_stay_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = warc.round_trip(make(spark, rows, "page_id long, url string, html string"), min_bytes=5).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_record_ids_are_unique_and_revisits_name_responses(spark, tmp_path):
    warc.write_archives(make(spark, PAGES, "page_id long, url string, html string").repartition(3), str(tmp_path / "w"))
    ids = []
    for name in os.listdir(tmp_path / "w"):
        if name.startswith("part-"):
            ids += [r.headers["warc-record-id"] for r in warc.read_records(io.BytesIO((tmp_path / "w" / name).read_bytes()))]
    assert len(ids) >= len(PAGES) and len(set(ids)) == len(ids)
    rows = warc.read_archives(spark, str(tmp_path / "w")).collect()
    of = {r.record_id: r for r in rows}
    revisits = [r for r in rows if r.record_type == "revisit"]
    # Page 7 occurs twice with one payload: its revisits name no single record.
    assert {r.refers_to for r in revisits if r.refers_to_record is None} == {7}
    named = [r for r in revisits if r.refers_to_record]
    assert named and all(of[r.refers_to_record].page_id == r.refers_to and of[r.refers_to_record].record_type == "response"
                         and of[r.refers_to_record].payload_digest == r.payload_digest for r in named)


def plain_record(kind, block, **headers):
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{kind}:{len(block)}>"), ("WARC-Date", warc.DATE),
            *[(k.replace("_", "-"), v) for k, v in headers.items()], ("Content-Length", str(len(block)))]
    return gzip.compress(("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n")


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    sha1 = hashlib.sha1(b"xyz")
    data = plain_record("warcinfo", b"software: x\r\n") + plain_record("response", http + b"xyz") \
        + plain_record("response", http + b"xyz", WARC_Payload_Digest="sha1:" + sha1.hexdigest(), WARC_Target_URI="http://a/") \
        + plain_record("response", b"whole block", Content_Type="text/dns", WARC_Block_Digest="sha256:zz") \
        + plain_record("revisit", http, WARC_Refers_To="<urn:response:33>", WARC_Payload_Digest="sha1:" + warc.digest(b"xyz")) \
        + plain_record("revisit", b"") + plain_record("request", b"GET / HTTP/1.1\r\n\r\n")
    (tmp_path / "other.warc.gz").write_bytes(data)
    got = warc.read_archives(spark, str(tmp_path)).collect()
    base32 = base64.b32encode(sha1.digest()).decode()
    assert by_row([tuple(r)[:5] for r in got]) == by_row([
        (None, 3, base32, "response", None), (None, 3, base32, "response", None), (None, 11, warc.digest(b"whole block"), "response", None),
        (None, None, base32, "revisit", None), (None, None, None, "revisit", None)])
    assert {r.target_uri for r in got} == {None, "http://a/"} and "<urn:response:33>" in {r.refers_to_record for r in got}
    for bad in ("sha1:" + warc.digest(b"other"), "sha1:" + "0" * 40):
        with pytest.raises(ValueError):
            [warc.page_row(r) for r in warc.read_records(io.BytesIO(plain_record("response", http, WARC_Payload_Digest=bad)))]
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(plain_record("response", http, WARC_Block_Digest=bad))))


# --- token counts

def test_token_counts_equal_the_library(spark):
    rows = awkward() + [(90, "  a  b "), (91, " "), (92, "▁x ▁▁ y"), (93, "<s> </s> <unk> <0x0A>"), (94, "a\nb\r\n\tc"), (95, "word" * 3000), (96, "a" + " " * 40 + "b")]
    model = path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    for cached in (1 << 19, 3):
        got = token_counts.count_tokens(make(spark, rows), model, limit=100, hot=50, cached=cached).collect()
        want = [(i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 100) for i, t in rows]
        assert by_row(got) == by_row(want)


# --- packing

def check_packing(rows, out, capacity):
    size = {i: len(BLANK.findall(t or "")) for i, t, _ in rows}
    got = defaultdict(int)
    bins = defaultdict(list)
    for r in out:
        got[r.doc_id] += r.n_tokens
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert got == {i: n for i, n in size.items()}
    of = {i: (s, tuple(BLANK.findall(t or ""))) for i, t, s in rows}
    for pieces in bins.values():
        assert sum(p.n_tokens for p in pieces) <= capacity
        assert sorted(p.position for p in pieces) == list(range(len(pieces)))
        sources = [of[p.doc_id][0] for p in pieces if of[p.doc_id][0] is not None]
        assert len(sources) == len(set(sources))
        assert len({of[p.doc_id][1] for p in pieces}) == len(pieces)
    return bins


def test_packing_is_whole_and_without_conflicts(spark):
    r = random.Random(2)
    rows = [(i, " ".join(words(i, r.randrange(0, 90))), r.choice(["s0", "s0", "s1", "s2", "s3", None])) for i in range(300)]
    rows += [(300 + i, rows[7][1], f"t{i}") for i in range(20)] + [(400, " ".join(words(1, 777)), "s0"), (401, None, "s1"), (402, "  ", None)]
    docs = make(spark, rows, "doc_id long, text string, source string")
    for group_rows in (1000, 50):
        check_packing(rows, packing.pack(docs, 100, group_rows).collect(), 100)
    again = [(1, "a b", "s"), (1, "a b", "s"), (None, "a b c", None), (None, "d", None)]
    out = packing.pack(make(spark, again, "doc_id long, text string, source string"), 10).collect()
    assert len(out) == 4 and len({x.bin_id for x in out if x.doc_id == 1}) == 2


def test_packing_numbers_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES_AT_ONCE", 7)
    rows = [(1, "a b", "s")] * 30 + [(2, "c", "t")] * 7 + [(3, "d", "t")] * 8 + [(4, None, None)]
    out = packing.pack(make(spark, rows, "doc_id long, text string, source string"), 100).collect()
    assert Counter(r.doc_id for r in out) == {1: 30, 2: 7, 3: 8, 4: 1}
    bins = Counter((r.bin_id, r.doc_id) for r in out if r.bin_id)
    assert max(bins.values()) == 1  # no copy beside another


def test_packing_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10)
    assert [bins.place(6, 1, 0), bins.place(7, 2, 0), bins.place(8, 4, 0)] == [0, 1, 2]
    assert bins.place(2, 4, 0) == 1  # bin 2 fits tightest but holds the source
    assert bins.place(2, 1, 0) == 2
    assert bins.place(3, 1, 0) == 3  # only bin 0 has room, and holds the source
    assert bins.place(4, 0, 0) == 0


# --- chats

def chats(n, seed=0, marked=1.0):
    r = random.Random(seed)
    rows, truth = [], {}
    for c in range(n):
        roles = (["system"] if r.random() < 0.3 else []) + ["user", "assistant"] * r.randrange(1, 4)
        for t, role in enumerate(roles):
            text = {"system": "Be brief.", "user": " ".join(words(r.random(), 8)) + "?",
                    "assistant": "\n".join(" ".join(words(r.random(), 40)) + "." for _ in range(3))}[role]
            rows.append((c, t, role if r.random() < marked else None, text))
            truth[c, t] = role
    return rows, truth


CHAT = "conv_id long, turn long, role string, text string"


def test_roles_of_unmarked_turns_are_recovered(spark):
    model = chat.fit(make(spark, chats(80)[0], CHAT))
    rows, truth = chats(60, 9, marked=0.5)
    got = chat.format_chats(make(spark, rows, CHAT), model).collect()
    assert len(got) == len(rows)
    assert all(r.role == truth[r.conv_id, r.turn] for r in got if r.marked)
    assert np.mean([r.role == truth[r.conv_id, r.turn] for r in got if not r.marked]) > 0.9


def test_segments_give_the_same_path_as_one(spark, monkeypatch):
    rows, _ = chats(30, 3, marked=0.4)
    rows = [(0, i, r[2], r[3]) for i, r in enumerate(rows)]
    model = chat.fit(make(spark, chats(40)[0], CHAT))
    one = by_row(chat.format_chats(make(spark, rows, CHAT), model).collect())
    monkeypatch.setattr(chat, "SEGMENT", 7)
    assert by_row(chat.format_chats(make(spark, rows, CHAT), model).collect()) == one
    cut = chat.fit(make(spark, chats(40)[0], CHAT))
    assert all(np.allclose(a, b) for a, b in zip([model.start, model.move, *model.emit], [cut.start, cut.move, *cut.emit]))


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    model = chat.Model(rng.integers(0, 9, 6), rng.integers(0, 9, (6, 6)), [rng.integers(0, 9, (6, n)) for n in chat.SIZES])
    seen = np.array([(0, 1, 0, 1), (2, 0, 1, 2), (0, 0, 0, 3), (0, 1, 1, 0)])
    score = model.scores(seen)

    def total(path):
        return model.start[path[0]] + score[0, path[0]] + sum(model.move[a, b] + score[i + 1, b] for i, (a, b) in enumerate(zip(path, path[1:])))

    paths = [(a, b, c, d) for a in range(6) for b in range(6) for c in range(6) for d in range(6)]
    assert np.isclose(total(model.path(seen, None)), max(map(total, paths)))


def test_chat_rendering_and_markers(spark):
    model = chat.fit(make(spark, chats(40)[0], CHAT))
    rows = [(1, 0, None, "User: hi there?\nAssistant: hello.\nmore\nHuman: bye?"), (1, 1, "gpt", "ok"), (1, None, "weird", None), (None, 0, "user", "x"),
            (2, 0, "user", "q?"), (2, 0, "user", "q?")]
    got = chat.format_chats(make(spark, rows, CHAT), model).collect()
    mine = sorted((r.part, r.role, r.text) for r in got if r.conv_id == 1 and r.turn == 0)
    assert mine == [(0, "user", "hi there?"), (1, "assistant", "hello.\nmore"), (2, "user", "bye?")]
    assert [r.rendered for r in got if r.conv_id == 1 and r.turn == 1] == ["<|assistant|>\nok\n<|end|>"]
    assert len([r for r in got if r.conv_id == 2]) == 2 and len([r for r in got if r.conv_id is None]) == 1


# --- all

def run_all(spark, docs, pages, labels, items, talk):
    yield packing.pack(docs)
    yield substring_dedup.dedup(docs)
    yield quality.quality(docs, labels)
    yield decontaminate.decontaminate(docs, items)
    yield secrets.report(docs)
    yield jaccard.jaccard_components(docs)
    yield chat.format_chats(talk, chat.fit(talk))
    yield licenses.find_licenses(docs)
    yield warc.round_trip(pages)
    yield token_counts.count_tokens(docs, path("piece_bpe_32k.model"))


def test_empty_tables(spark):
    frames = [make(spark, [], s) for s in (
        "doc_id long, text string, source string", "page_id long, url string, html string",
        "doc_id long, quality int, toxic int", "item_id long, text string", CHAT)]
    docs, pages, labels, items, talk = frames
    for out in run_all(spark, docs, pages, labels, items, talk):
        assert out.count() == 0


def test_clashing_extra_columns(spark):
    docs = make(spark, [(1, "cc by a b", "s", 5, "T", 7, 8)], "doc_id long, text string, source string, n_words int, Text string, key int, places int")
    pages = make(spark, [(1, "u", "x", 1, 2)], "page_id long, url string, html string, sha1 int, size int")
    labels = make(spark, [(1, 1, 0, 3)], "doc_id long, quality int, toxic int, Doc_ID int")
    items = make(spark, [(1, "cc by", "x")], "item_id long, text string, Item_Id string")
    talk = make(spark, [(1, 0, "user", "x", 4)], "conv_id long, turn long, role string, text string, segment int")
    for out in run_all(spark, docs, pages, labels, items, talk):
        assert out.count() == 1
    assert pick(docs, x=("Text", "string")).first().x == "T"
