"""Quality rules: hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to ``N_BUCKETS`` buckets. Two multinomials over
the buckets are counted: the raw corpus (every document) and a trusted target
(documents labelled as good). A document's score is the mean, over its
n-grams, of log p_target - log p_raw. Texts are dealt into folds by their hash,
and each is scored by the target without its own fold, labelled or not. The cut
is the one that best parts the scores of documents labelled good and bad.
Weights are fixed-point integers, so a score does not depend on how rows are
batched or partitioned.

Base rules run first; a document that fails them is not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import NOT_BLANK, Words, documents, grams, pick, slices, sums, utf8

N_BUCKETS = 1 << 14
#: Mean log ratio for each n-gram below which a document is not kept, where the
#: labels give no cut.
THRESHOLD = -0.12
#: The target's counts are smoothed by n-grams of the raw corpus, as a share of
#: the target's.
PRIOR = 0.1
#: At most so many labelled documents of each quality are used (by hash order).
TRUSTED_ROWS = 50_000
FOLDS = 8
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Texts scored at once.
SCORED_BYTES = 2 << 20
_POINT = 1 << 20
#: Width of a histogram bin of scores, in fixed point.
_BIN = 1 << 10
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def buckets(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams, and the text each belongs to."""
    pairs = grams(hashes, 2)[words.whole(2)]
    of_pairs = words.doc[:max(0, len(words) - 1)][words.whole(2)]
    return ((np.concatenate([hashes, pairs]) % np.uint64(N_BUCKETS)).astype(np.int64),
            np.concatenate([words.doc, of_pairs]))


def fold(texts: list[bytes]) -> np.ndarray:
    """The fold of every text; exact copies share one."""
    return np.fromiter((xxhash.xxh64_intdigest(t) % FOLDS for t in texts), np.int64, len(texts))


def labelled_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality",
                 most: int = TRUSTED_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the documents labelled good, and of those labelled bad, at most
    ``most`` of each in hash order (all, where there are fewer). An id with both
    labels is good."""
    known = pick(labels, doc_id=(id_col, "long"), quality=(quality_col, "long")) \
        .filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    out = []
    for quality in (1, 0):
        rows = known.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
        out.append(np.array(sorted(r.doc_id for r in rows), np.int64))
    return out[0], out[1]


def fit_weights(docs: DataFrame, trusted: np.ndarray) -> np.ndarray:
    """Fixed-point log ratios by fold and bucket, from counts over all documents;
    a fold's target leaves out its own texts. The target is smoothed towards the
    raw corpus (``PRIOR``). All 0 where the target has no n-gram."""
    ids = docs.sparkSession.sparkContext.broadcast(trusted)

    def count(batches):
        # The raw corpus, then the target's folds.
        counts = np.zeros((1 + FOLDS) * N_BUCKETS, np.int64)
        for batch in slices(batches):
            texts = utf8(batch.column("text"))
            words = Words(texts, NOT_BLANK)
            at, doc = buckets(words, words.hashes())
            counts[:N_BUCKETS] += np.bincount(at, minlength=N_BUCKETS)
            good = np.isin(batch.column("doc_id").fill_null(-1).to_numpy(), ids.value) & batch.column("doc_id").is_valid().to_numpy(False)
            if good.any():
                its = good[doc]
                counts += np.bincount((1 + fold(texts)[doc[its]]) * N_BUCKETS + at[its], minlength=len(counts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["at", "n"])

    counts = docs.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros((1 + FOLDS) * N_BUCKETS)  # at most so many rows
    found[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
    found = found.reshape(1 + FOLDS, N_BUCKETS)
    raw, target = found[0] + 1, found[1:].sum(0) - found[1:]
    raw /= raw.sum()
    size = target.sum(1, keepdims=True)
    prior = np.where(size > 0, PRIOR * size, 1)
    target = (target + prior * raw) / (size + prior)
    return np.rint((np.log(target) - np.log(raw)) * _POINT).astype(np.int64)


def scored(texts: list[bytes], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """``FEATURES``, whether the base rules fail, the sum of weights and the
    number of n-grams of every text."""
    words = Words(texts, NOT_BLANK)
    hashes = words.hashes()
    found = features(texts, words, hashes)
    at, doc = buckets(words, hashes)
    total = np.zeros(len(texts), np.int64)
    np.add.at(total, doc, weights[fold(texts)[doc], at])
    failed = (found[0] < MIN_WORDS) | (100 * found[4] > MAX_REPEAT_PERCENT * found[0])
    return found, failed, total, np.bincount(doc, minlength=len(texts))


def best_cut(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> int:
    """The bin from which documents are kept, out of a histogram of scores by
    quality: the greatest sum of the share of good documents kept and of bad ones
    not kept, in the middle of the lowest run of equal cuts. Where no cut parts
    them (no bad document, say), that of ``THRESHOLD``, or the least good
    document's where that is lower."""
    fixed = round(THRESHOLD * _POINT) // _BIN
    if not good.sum():
        return fixed
    least = int(bins[good > 0].min())
    first = int(bins.min())
    size = int(bins.max()) - first + 2
    above, below = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(above, bins - first, good)
    np.add.at(below, bins - first + 1, bad)
    above, below = np.cumsum(above[::-1])[::-1], np.cumsum(below)
    gain = above * bad.sum() + below * good.sum()
    if gain.max() <= good.sum() * bad.sum():
        return min(fixed, least)
    best = np.flatnonzero(gain == gain.max())
    run = best[:np.flatnonzero(np.diff(best, append=size + 1) > 1)[0] + 1]
    return first + int(run[0] + run[-1] + 1) // 2


def fit_cut(docs: DataFrame, weights: Broadcast, good: np.ndarray, bad: np.ndarray) -> int:
    """The cut in fixed point, from the scores of the labelled documents that
    pass the base rules."""
    def score(batches):
        for batch in slices(batches, most=SCORED_BYTES):
            _, failed, total, n = scored(utf8(batch.column("text")), weights.value)
            passed = ~failed
            yield pa.RecordBatch.from_arrays(
                [pa.array(total[passed] // (_BIN * n[passed])), batch.column("good").filter(pa.array(passed))],
                names=["bin", "good"])

    known = docs.sparkSession.createDataFrame(pa.table(
        {"doc_id": np.concatenate([good, bad]), "good": np.arange(len(good) + len(bad)) < len(good)}))
    rows = docs.join(F.broadcast(known), "doc_id").select("text", "good").mapInArrow(score, "bin long, good boolean") \
        .groupBy("bin").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toArrow()
    return _BIN * best_cut(*(rows.column(c).to_numpy() for c in ("bin", "good", "bad")))


def features(texts: list[bytes], words: Words, hashes: np.ndarray) -> list[np.ndarray]:
    """``FEATURES`` of every text."""
    size = words.end - words.start
    tail = np.concatenate([[0], np.cumsum((words.buf & 0xC0) == 0x80)])
    chars = sums(size - (tail[words.end] - tail[words.start]), words.first)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.buf])])
    symbols = symbols[words.begin[1:]] - symbols[words.begin[:-1]]
    lines = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if b"\n" in text:
            kept = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            lines[i] = len(kept) - len(set(kept))
    return [words.counts.astype(np.int64), chars, symbols, lines, repeated(words, hashes, 3)]


def repeated(words: Words, hashes: np.ndarray, k: int) -> np.ndarray:
    """Words of each text inside k-word windows that it holds twice or more."""
    whole = np.flatnonzero(words.whole(k))
    keys = grams(hashes, k)[whole] + words.doc[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = whole[twice]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + k, -1)
    return sums(np.cumsum(covered[:-1]) > 0, words.first)


def quality(docs: DataFrame, labels: DataFrame, threshold: float | None = None, id_col: str = "doc_id",
            text_col: str = "text", keep: tuple[str, ...] = (), most_trusted: int = TRUSTED_ROWS) -> DataFrame:
    """One row for each input row: ``doc_id``, the base features,
    ``base_failed``, ``score`` and ``kept``.

    A null or blank text has no words, fails the base rules and scores 0. A
    null id is scored like any other and never trusted. Without trusted
    documents all scores are 0 and only the base rules decide. The cut is
    ``threshold``, or else taken from the labelled documents (``best_cut``); a
    score equal to it is kept. ``keep``: input columns handed on, as they are.
    Windows of three words are told apart by 64-bit hashes.
    """
    own = {f"keep_{i}": (c, dict(docs.dtypes)[c]) for i, c in enumerate(keep) if c != text_col}
    kept_text = ["text"] if text_col in keep else []
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), **own)
    good, bad = labelled_ids(labels, most=most_trusted)
    texts_only = docs.select("doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(fit_weights(texts_only, good))
    least = fit_cut(texts_only, table, good, bad) if threshold is None else round(threshold * _POINT)

    def score(batches):
        for batch in slices(batches, most=SCORED_BYTES):
            found, failed, total, grams_in = scored(utf8(batch.column("text")), table.value)
            out = [batch.column("doc_id"), *found, failed,
                   total / _POINT / np.maximum(grams_in, 1), ~failed & (total >= least * grams_in)]
            out += [batch.column(c) for c in [*own, *kept_text]]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names=names)

    schema = f"doc_id long, {FEATURES}, base_failed boolean, score double, kept boolean"
    names = [x.split()[0] for x in schema.split(", ")] + [*own, *kept_text]
    schema += "".join(f", {c} {kind}" for c, (_, kind) in own.items()) + ", text string" * len(kept_text)
    out = docs.mapInArrow(score, schema)
    return out.withColumnsRenamed({c: name for c, (name, _) in own.items()} | {"text": text_col})
