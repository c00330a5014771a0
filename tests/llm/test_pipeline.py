"""The pipeline against brute force, stage by stage and as a whole."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import brute
from beatline.llm import quality, secrets
from test_operators import brute_components, brute_spans, check_packing, make, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(6)
    rows = []
    for i in range(120):
        w = words(500 + i, r.randrange(40, 160))
        if i % 10 == 3:
            w = words(500 + i - 3, 150)  # copies of others' beginnings
        if i % 12 == 5:
            w[3:3] = words(50, 40, 30)[4:30]
        text = " ".join(w)
        if i % 9 == 2:
            text += " password = hunter2hunter2 AKIA" + "B7" * 9 + " token: 'ab' secret=AKIA" + "C8" * 9
        rows.append((i, text, "en", f"s{i % 4 if i % 3 else 0}", len(text)))
    rows += [(200 + i, rows[7][1] + f" end{i}", "en", "s0", 1) for i in range(6)] + [(300, None, None, None, None), (None, " ".join(words(1, 90)), "en", None, 3)]
    return rows


def redact(text):
    out, at = [], 0
    for a, _, b, kind in brute_spans(text):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = corpus()
    folder = str(tmp_path)
    items = [(1, " ".join(words(50, 40, 30)))]
    labels = make(spark, [(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    make(spark, rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    make(spark, items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")

    kept = {(r.doc_id, r.text) for r in quality.quality(make(spark, rows, DOCS), labels, keep=("text",)).collect() if r.kept}
    left = [r for r in rows if (r[0], r[1]) in kept]
    assert 0 < len(left) < len(rows)
    least = brute_components([r[:2] for r in left])
    left = [r for r, (i, _, c) in zip(left, least) if i == c]
    hit = brute.decontaminate([r[:2] for r in left], items)
    left = [r for r, h in zip(left, hit) if not h[5]]
    left = [(r[0], redact(r[1]), r[2], r[3], len(redact(r[1])) if brute_spans(r[1]) else r[4]) for r in left]

    docs = make(spark, rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    assert sorted(map(str, map(tuple, docs.collect()))) == sorted(map(str, left))
    assert any("[assign]" in r[1] for r in left) and not any(re.search("hunter2|AKIA", r[1]) for r in left)
    check_packing([(r[0], r[1], r[3]) for r in left], corpus_pipeline.run(spark, folder).collect(), 2048)


def test_near_duplicates_keep_one_of_repeated_rows(spark):
    a, b, c = (" ".join(words(i, 60)) for i in (1, 2, 3))
    rows = [(1, a, "en", "s", 1)] * 3 + [(2, a, "en", "s", 1)] * 2 + [(3, b, "en", "t", 1), (3, b, None, "s", 1), (3, b, "en", "s", 2)]
    rows += [(None, c, "en", "s", 1)] * 3 + [(None, a, "en", "s", 1), (4, None, "en", "s", 0), (4, None, "en", "s", 0), (4, "", "en", "s", 0)]
    out = corpus_pipeline.near_duplicates(spark, make(spark, rows, DOCS), "").collect()
    want = [(1, a, "en", "s", 1), (3, b, None, "s", 1), (None, c, "en", "s", 1), (None, a, "en", "s", 1), (4, None, "en", "s", 0), (4, "", "en", "s", 0)]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_redaction_of_overlaps(spark):
    text = "é token=AKIA" + "X" * 20 + " z " + "a" * 30
    out = secrets.find_secrets(make(spark, [(1, text), (2, "")]), keep=("text",))
    got = {r.doc_id: r.t for r in out.select("doc_id", secrets.redacted(out.text, out.found).alias("t")).collect()}
    assert got == {1: "é [assign] z [hex]", 2: ""}
