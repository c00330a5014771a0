"""Language-model scoring with a weighted backoff automaton.

The model: words have the additive base probability; for every higher order

    p(w | h) = (c(h w) + d * p(w | h')) / (c(h) + d)

where ``h'`` is ``h`` without its first word, and ``d`` is the mean number of
different continuations of a context in the training corpus (the Witten-Bell
weight, with its mean in place of each context's own).

As an automaton: every n-gram shorter than ``order`` is a state, an n-gram that
occurs is an arc from its context, and every state has a failure arc to the
state of its longest proper suffix, which carries ``d / (c(h) + d)``. A text is
read once from left to right: the state is carried along, failure arcs are
taken until an arc for the next word is found, and log-probabilities add up.

The automaton of a corpus does not fit in a worker and need not: a slice of some
6 MB of texts can only take the arcs of its own n-grams. So every slice sends
its distinct n-grams (hashes, sorted, as differences) with their training counts
to buckets by hash range; a bucket adds the counts of all slices up and answers
each slice in the order in which it asked; the slice builds its part of the
automaton from the answers. An n-gram travels once for each slice that holds it,
however often it occurs, and a count of all documents comes back. The slices are
written as a bucketed table, so the answers go to the texts and the texts stay.

Words and n-grams are told apart by hashes: 64 bits for words, 56 for n-grams.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import LOWER, NOT_BLANK, Words, documents, mix, slices, sums, utf8
from beatline.session import materialize, scratch_path

ORDER = 3
#: Of the remainders 0 to 9 of crc32(id), this one is held out of training.
FOLDS, HELD_OUT = 10, 0
#: Weight of an unseen word in the base.
ADDED = 0.1
#: Texts of a slice, and texts whose n-grams a bucket counts.
PACK_BYTES = 6 << 20
BUCKET_BYTES = 12 << 20
_END = np.uint64(0x5BD1E9955BD1E995)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SHORT = np.uint64(8)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Integer arrays, compressed plane by plane: bytes that rarely change cost
    next to nothing."""
    parts = []
    for a in arrays:
        parts += [np.array([len(a), a.dtype.itemsize], np.int64).tobytes(),
                  np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def expand(data: bytes, *kinds) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        n, size = np.frombuffer(raw, np.int64, 2, at).tolist()
        planes = np.frombuffer(raw, np.uint8, n * size, at + 16).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 16 + n * size
    return out


def smallest(values: np.ndarray) -> np.ndarray:
    """Counts in the least type that holds them, told apart by its size."""
    top = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


class Grams:
    """The n-grams of a list of texts, each text followed by one end.

    ``keys[k]`` are the sorted distinct hashes of the (k+1)-grams, ``of[k]`` for
    every token the place in ``keys[k]`` of the (k+1)-gram that it ends, -1 where
    the text has too few tokens before it.
    """

    def __init__(self, texts: list[bytes], order: int):
        words = Words(texts, NOT_BLANK, LOWER)
        n = words.counts + 1
        self.first = np.concatenate([[0], np.cumsum(n)])
        hashes = np.full(self.first[-1], _END, np.uint64)
        hashes[np.arange(len(words)) + words.doc] = words.hashes()
        place = np.arange(len(hashes)) - np.repeat(self.first[:-1], n)
        self.doc = np.repeat(np.arange(len(texts)), n)
        self.keys, self.of, run = [], [], hashes
        for k in range(order):
            if k:
                run = mix(run[:-1] * _GRAM + hashes[k:]) if len(run) else run
            ends = np.flatnonzero(place >= k)
            mine = run[ends - k] if k == 0 else run[ends - k] >> _SHORT
            keys, at = np.unique(mine, return_inverse=True)
            of = np.full(len(hashes), -1, np.int32)
            of[ends] = at
            self.keys.append(keys)
            self.of.append(of)

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram occurs in the texts that ``train`` marks."""
        use = train[self.doc]
        return [np.bincount(of[use & (of >= 0)], minlength=len(keys)) for keys, of in zip(self.keys, self.of)]


def bucket_of(keys: np.ndarray, order: int, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so those of sorted keys rise."""
    top = keys >> np.uint64(32) if order == 0 else keys >> np.uint64(24)
    return (top * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


class Automaton:
    """The part of the model that the texts of a slice can reach.

    State 0 is the empty history; the states of (k+1)-grams follow by their
    places in ``keys[k]``. ``counts[k]``: their counts in the training corpus.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, distinct: list[int]):
        order = len(counts)
        c = counts[0].astype(float)
        p = (c + ADDED) / (tokens + ADDED * (distinct[0] + 1))
        self.base = np.log10(p)
        begin = np.cumsum([1, *map(len, counts)])  # the states of each order
        known = counts[0] > 0
        self.root = np.where(known, 1 + np.arange(len(c)), 0) if order > 1 else np.zeros(len(c), np.int64)
        self.fail, self.cost = [np.zeros(1, np.int64)], [np.zeros(1)]
        arcs, weights, to = [], [], []
        for k in range(1, order):
            d = distinct[k] / max(1, distinct[k - 1])
            # One occurrence of each (k+1)-gram tells its context, word and suffix.
            some = np.full(len(counts[k]), -1)
            ends = np.flatnonzero(grams.of[k] >= 0)
            some[grams.of[k][ends]] = ends
            context, word, suffix = grams.of[k - 1][some - 1], grams.of[0][some], grams.of[k - 1][some]
            c, h = counts[k].astype(float), counts[k - 1].astype(float)
            p = (c + d * p[suffix]) / (h[context] + d) if d else p[suffix]
            seen = np.flatnonzero(counts[k] > 0)
            arcs.append((begin[k - 1] + context[seen]) << 32 | word[seen])
            weights.append(np.log10(p[seen]))
            to.append((begin[k] + seen) if k < order - 1 else begin[k - 1] + suffix[seen])
            # Failure arcs of the states of order k.
            if k == 1:
                self.fail.append(np.zeros(len(h), np.int64))
            else:
                back = np.full(len(h), 0)
                at = np.flatnonzero(grams.of[k - 1] >= 0)
                back[grams.of[k - 1][at]] = begin[k - 2] + grams.of[k - 2][at]
                self.fail.append(back)
            self.cost.append(np.log10(d / (h + d)) if d else np.zeros(len(h)))
        self.fail, self.cost = np.concatenate(self.fail), np.concatenate(self.cost)
        key = np.concatenate(arcs) if arcs else np.zeros(0, np.int64)
        by = np.argsort(key)
        self.arcs = np.append(key[by], np.iinfo(np.int64).max)
        self.weights = np.append(np.concatenate(weights)[by] if arcs else [], 0.0)
        self.to = np.append(np.concatenate(to)[by] if arcs else [], 0).astype(np.int64)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each of several states: the new states and the
        log-probabilities."""
        state, out = state.copy(), np.zeros(len(state))
        left = np.arange(len(state))
        while len(left):
            at_root = state[left] == 0
            r = left[at_root]
            out[r] += self.base[word[r]]
            state[r] = self.root[word[r]]
            left = left[~at_root]
            key = state[left] << 32 | word[left]
            at = np.searchsorted(self.arcs, key)
            found = self.arcs[at] == key
            f, at = left[found], at[found]
            out[f] += self.weights[at]
            state[f] = self.to[at]
            left = left[~found]
            out[left] += self.cost[state[left]]
            state[left] = self.fail[state[left]]
        return state, out

    def traverse(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The log-probability of each text ``tokens[first[i]:first[i + 1]]``. The
        texts are read side by side, a token of each at a time, the longest first
        so that those still running are always the leading ones."""
        size = np.diff(first)
        by = np.argsort(-size, kind="stable")
        start, size = first[:-1][by], size[by]
        state, total = np.zeros(len(by), np.int64), np.zeros(len(by))
        running = np.searchsorted(-size, -np.arange(size.max(initial=0)), "left")
        for t, n in enumerate(running.tolist()):
            state[:n], gained = self.step(state[:n], tokens[start[:n] + t])
            total[:n] += gained
        out = np.empty(len(by))
        out[by] = total
        return out


def text_slices(docs: DataFrame) -> DataFrame:
    """(slice, ids, train, texts): packed rows of ``doc_id``, ``text``, ``train``."""

    def run(batches):
        at = TaskContext.get().partitionId() << 32
        for n, batch in enumerate(slices(batches, most=PACK_BYTES)):
            texts = utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                pa.array([at + n]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([batch.column("train").to_pylist()], pa.list_(pa.bool_())),
                pa.array([list(map(len, texts))], pa.list_(pa.int32())),
                pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary())],
                names=["slice", "ids", "train", "sizes", "texts"])

    return docs.mapInArrow(run, "slice long, ids array<long>, train array<boolean>, sizes array<int>, texts binary")


def _grams(row: dict, order: int) -> tuple[Grams, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["sizes"] else b""
    cut = np.cumsum([0, *row["sizes"]])
    texts = [raw[a:b] for a, b in zip(cut[:-1], cut[1:])]
    return Grams(texts, order), np.array(row["train"], bool)


def _each(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def asked(texts: DataFrame, order: int, n_buckets: int) -> DataFrame:
    """(bucket, slice, pack): the n-grams of a slice that fall in a bucket, with
    their training counts in the slice."""

    def run(batches):
        for row in _each(batches):
            grams, train = _grams(row, order)
            counts = grams.counts(train)
            of = [bucket_of(keys, k, n_buckets) for k, keys in enumerate(grams.keys)]
            used = np.unique(np.concatenate(of))
            cuts = [np.append(np.searchsorted(b, used), len(b)) for b in of]
            out = []
            for i, b in enumerate(used.tolist()):
                part = [slice(c[i], c[i + 1]) for c in cuts]
                steps = [np.diff(keys[s], prepend=np.uint64(0)) for keys, s in zip(grams.keys, part)]
                times = [smallest(n[s]) for n, s in zip(counts, part)]
                out.append((b, squeeze(*steps, *times), [n.dtype.itemsize for n in times]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([row["slice"]] * len(out), pa.int64()),
                 pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
                names=["bucket", "slice", "pack", "bytes"])

    return texts.mapInArrow(run, "bucket int, slice long, pack binary, bytes array<int>")


_UNSIGNED = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def answers(packs: list[tuple[bytes, list[int]]], order: int) -> tuple[list[tuple[bytes, list[int]]], list[int]]:
    """The counts of all slices, for each pack in its own order; then the number
    of distinct n-grams of each order that occur in training, and of all tokens."""
    opened = [expand(p, *[np.uint64] * order, *[_UNSIGNED[b] for b in sizes]) for p, sizes in packs]
    replies = [[] for _ in packs]
    distinct = []
    for k in range(order):
        keys = np.concatenate([np.cumsum(o[k], dtype=np.uint64) for o in opened])
        counts = np.concatenate([o[order + k] for o in opened]).astype(np.int64)
        by = np.argsort(keys, kind="stable")
        keys = keys[by]
        head = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        number = np.cumsum(head) - 1
        total = np.add.reduceat(counts[by], np.flatnonzero(head)) if len(keys) else counts
        distinct.append(int((total > 0).sum()))
        if k == 0:
            tokens = int(total.sum())
        mine = np.empty(len(keys), np.int64)
        mine[by] = total[number] if len(keys) else 0
        at = 0
        for reply, o in zip(replies, opened):
            reply.append(smallest(mine[at:at + len(o[k])]))
            at += len(o[k])
    return [(squeeze(*r), [a.dtype.itemsize for a in r]) for r in replies], [*distinct, tokens]


def counted(packs: DataFrame, order: int, n_buckets: int) -> DataFrame:
    """(bucket, slice, pack, bytes, totals): what each bucket answers; ``totals`` is
    set on one row of a bucket."""

    def run(batches):
        buckets: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                buckets.setdefault(row["bucket"], []).append((row["slice"], row["pack"], row["bytes"]))
        for b in list(buckets):
            rows = buckets.pop(b)
            out, totals = answers([r[1:] for r in rows], order)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.list_(pa.int32())),
                 pa.array([totals] + [None] * (len(rows) - 1), pa.list_(pa.int64()))],
                names=["bucket", "slice", "pack", "bytes", "totals"])

    return packs.repartition(n_buckets, "bucket").mapInArrow(
        run, "bucket int, slice long, pack binary, bytes array<int>, totals array<long>")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """One row for each input row: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10).

    Rows learnt from are those whose crc32 of the id, as text, leaves a
    remainder other than 0 by 10. A null id is held out. A null or blank text is one
    token, the end. Rows of the same id, and repeated rows, each count and are
    each scored. Without any training token every word has the same share of the
    base, and the higher orders add nothing. An empty table gives no rows.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    rows = documents(docs, id_col, text_col).withColumn(
        "train", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT, F.lit(False)))
    size = rows.agg(F.sum(F.octet_length("text") + 1).alias("n")).first().n or 0
    n_buckets = max(8, math.ceil(size / BUCKET_BYTES))
    # As many table buckets as a join would use, so that the texts stay where they are.
    n_parts = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / PACK_BYTES / 4)))
    name = f"text_slices_{uuid.uuid4().hex}"
    text_slices(rows).write.bucketBy(n_parts, "slice").option("path", scratch_path(spark, "text-slices")).format("parquet").saveAsTable(name)
    texts = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # of the catalog only: the files are an external table's
    replies = materialize(counted(asked(texts, order, n_buckets), order, n_buckets), "ngram-counts")
    known = replies.filter("totals is not null").select(F.posexplode("totals").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    sizes = {r.k: r.n for r in known.collect()}  # order + 1 rows
    distinct, tokens = [sizes.get(k, 0) for k in range(order)], sizes.get(order, 0)

    def run(batches):
        for row in _each(batches):
            grams, train = _grams(row, order)
            counts = [[] for _ in range(order)]
            for r in sorted(row["replies"] or [], key=lambda r: r["bucket"]):
                for k, a in enumerate(expand(r["pack"], *[_UNSIGNED[b] for b in r["bytes"]])):
                    counts[k].append(a.astype(np.int64))
            counts = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in counts]
            model = Automaton(grams, counts, tokens, distinct)
            word, first = grams.of[0], grams.first
            seen = sums(counts[0][word] > 0, first)
            base = np.add.reduceat(model.base[word], first[:-1])  # every text has its end
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(~train), pa.array(np.diff(first)), pa.array(seen),
                 pa.array([tokens] * len(train), pa.int64()), pa.array(base), pa.array(model.traverse(word, first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    got = replies.groupBy("slice").agg(F.collect_list(F.struct("bucket", "pack", "bytes")).alias("replies"))
    joined = texts.join(got.hint("shuffle_hash"), "slice", "left")
    return joined.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")
