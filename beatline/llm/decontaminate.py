"""Benchmark decontamination by winnowing.

Of every ten consecutive words of a benchmark item or a document, the least of
its six 5-gram hashes is a fingerprint. A span of ten shared words has the same
six hashes on both sides, so it always shares a fingerprint. Training and test
fingerprints are joined, and each hit is extended to the windows of the document
around it: those that are windows of the benchmark are occurrences. Items of fewer
than ten words are one window each, looked up by the hash of that many words.

The benchmark's distinct windows are indexed once, each with the number of its list
of items; equal lists are kept once. So a passage that thousands of items share
costs a document no more than one that a single item holds, and documents with the
same lists share the work of adding them up.

The join is map-side: documents are never shuffled. The benchmark goes to the
workers in blocks of at most about ``block_bytes`` (its size is measured first,
rows are dealt to blocks by hash), one pass over the documents for each block,
the hits of earlier blocks riding along; every ``PASSES`` blocks the rows are
written to the shared folder, so neither memory nor lineage grows.

Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import ALNUM, LOWER, Words, grams, mix, pick, ragged, slices, sliding_min, utf8
from beatline.session import materialize

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 16 << 20
PASSES = 4
#: About so many list entries go into one output batch.
ENTRIES = 1 << 20
#: So many sums of lists are remembered in a task.
REMEMBERED = 10_000


def fingerprints(words: Words, hashes: np.ndarray, window: int = WINDOW, k: int = GRAM) -> np.ndarray:
    """The places of the k-grams that are least in some window of words of
    their text (of equal ones, all)."""
    keys = grams(hashes, k)
    w = window - k + 1
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = sliding_min(keys, w)
    inside = words.whole(window)
    chosen = np.zeros(len(keys), bool)
    for j in range(w):
        chosen[j:j + n] |= inside & (keys[j:j + n] == least)
    return np.flatnonzero(chosen)


class Index:
    """The windows of a block of benchmark items and who holds them.

    ``windows``: for each size in words (``window``, and those of shorter items) the
    sorted distinct hashes and the number of each one's list of items; list ``i`` is
    ``items[first[i]:first[i + 1]]``, sorted item ids."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        ids = np.array([i for i, _ in items], np.int64)
        words = Words([t for _, t in items], ALNUM, LOWER)
        hashes = words.hashes()
        self.window = window
        at = fingerprints(words, hashes, window)
        self.keys = np.unique(grams(hashes, GRAM)[at]) if len(at) else np.zeros(0, np.uint64)
        parts = []
        whole = np.flatnonzero(words.whole(window))
        if len(whole):
            parts.append((window, grams(hashes, window)[whole], ids[words.doc[whole]]))
        for size in np.unique(words.counts[(words.counts > 0) & (words.counts < window)]).tolist():
            of = np.flatnonzero(words.counts == size)
            parts.append((size, grams(hashes, size)[words.first[of]], ids[of]))
        marks, starts, members, self.windows = [], [], [], {}
        for size, key, item in parts:
            order = np.lexsort((item, key))
            key, item = key[order], item[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (item[1:] != item[:-1])])
            key, item = key[new], item[new]
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            # A list is told by the sum of its members' hashes.
            marks.append(np.add.reduceat(mix(item.astype(np.uint64) + np.uint64(1)), start))
            starts.append(np.array([start, np.diff(np.append(start, len(key)))]) + [[sum(map(len, members))], [0]])
            members.append(item)
            self.windows[size] = key[start]
        self.items, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        if parts:
            _, one, number = np.unique(np.concatenate(marks), return_index=True, return_inverse=True)
            start, length = np.concatenate(starts, axis=1)[:, one]
            self.items = np.concatenate(members)[ragged(start, length)]
            self.first = np.concatenate([[0], np.cumsum(length)])
            ends = np.cumsum([len(m) for m in marks])[:-1]
            self.windows = {size: (keys, part.astype(np.int32)) for (size, keys), part in zip(
                self.windows.items(), np.split(number, ends))}

    def hits(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of windows as (first word, number of words, list of items)."""
        found = [np.zeros((3, 0), np.int64)]
        for size, (keys, lists) in self.windows.items():
            near = words.whole(size)
            if size == self.window:
                near &= self._near(words, hashes, len(near))
            at = np.flatnonzero(near)
            of = grams(hashes, size)[at]
            place = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
            ok = keys[place] == of
            found.append(np.array([at[ok], np.full(int(ok.sum()), size), lists[place[ok]]]))
        return tuple(np.concatenate(found, axis=1))

    def _near(self, words: Words, hashes: np.ndarray, n: int) -> np.ndarray:
        """Which of ``n`` windows hold a fingerprint of the benchmark."""
        at = fingerprints(words, hashes, self.window)
        out = np.zeros(n, bool)
        if not len(at):
            return out
        of = grams(hashes, GRAM)[at]
        at = at[self.keys[np.minimum(np.searchsorted(self.keys, of), len(self.keys) - 1)] == of]
        for back in range(self.window - GRAM + 1):
            start = at - back
            out[start[(start >= 0) & (start < n)]] = True
        return out

    def union(self, lists: np.ndarray, also: np.ndarray) -> np.ndarray:
        """The sorted distinct ids of some lists and of ``also``."""
        return np.unique(np.concatenate([also, *[self.items[self.first[i]:self.first[i + 1]] for i in lists]]))


def digest(ids: np.ndarray) -> tuple[int, str]:
    return len(ids), hashlib.sha256(",".join(sorted(map(str, ids.tolist()))).encode()).hexdigest()


NOTHING = digest(np.zeros(0, np.int64))


def scan(docs: DataFrame, index_of, last: bool, carry: bool) -> DataFrame:
    """One pass over the documents for a block: the hit words' places are added to
    the column ``places``, with ``carry`` the items found to ``items``; the ``last``
    pass counts and digests the items."""
    names = docs.columns

    def run(batches):
        index, known = index_of.value, {}

        def digest_of(lists: np.ndarray, also: np.ndarray) -> tuple[int, str]:
            if len(also):
                return digest(index.union(lists, also))
            key = lists.tobytes()
            if key not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[key] = digest(index.union(lists, also))
            return known[key]

        for batch in slices(batches):
            words = Words(utf8(batch.column("text")), ALNUM, LOWER)
            start, size, number = index.hits(words, words.hashes())
            hit = np.zeros(len(words) + 1, np.int64)
            np.add.at(hit, start, 1)
            np.add.at(hit, start + size, -1)
            hit = np.flatnonzero(np.cumsum(hit[:-1]))
            doc, lists = np.unique(np.array([words.doc[start], number]), axis=1)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            was = batch.column("items")
            before = np.concatenate([[0], np.cumsum(np.diff(was.offsets.to_numpy()))])
            old = was.flatten().to_numpy()
            touched = np.flatnonzero((np.diff(first) > 0) | (np.diff(before) > 0)).tolist()
            found = {i: (lists[first[i]:first[i + 1]], old[before[i]:before[i + 1]]) for i in touched}
            new = {"places": _lists(batch.column("places"), words.doc[hit], hit - words.first[words.doc[hit]]),
                   "n_words": pa.array(words.counts.astype(np.int64))}
            if last:
                results = {i: digest_of(*f) for i, f in found.items()}
                counted = [results.get(i, NOTHING) for i in range(batch.num_rows)]
                new["n_items"] = pa.array([n for n, _ in counted], pa.int64())
                new["items_sha256"] = pa.array([h for _, h in counted], pa.string())
            if not carry:
                new["items"] = pa.array([[]] * batch.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names=names)
                continue
            whole = pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names=names)
            part, entries, begin = [], 0, 0
            for i in range(batch.num_rows):
                part.append(index.union(*found[i]) if i in found else [])
                entries += len(part[-1])
                if entries >= ENTRIES or i == batch.num_rows - 1:
                    out = whole.slice(begin, len(part))
                    yield out.set_column(names.index("items"), "items", pa.array(part, pa.list_(pa.int64())))
                    part, entries, begin = [], 0, i + 1

    return docs.mapInArrow(run, docs.schema)


def _lists(old: pa.ListArray, row: np.ndarray, value: np.ndarray) -> pa.ListArray:
    """``old``'s lists with the sorted (row, value) pairs added, without repeats."""
    n = len(old)
    before = np.diff(old.offsets.to_numpy())
    if before.sum():
        was = np.array([np.repeat(np.arange(n), before), old.flatten().to_numpy()])
        row, value = np.unique(np.concatenate([was, [row, value]], axis=1), axis=1)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(value, pa.int64()))


def blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_bytes`` of text at most, dealt by
    hash. The size is measured; an item larger than a block is a part alone."""
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n = max(1, math.ceil(2 * size / block_bytes)) if size > block_bytes else 1
    return [benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (),
                  block_bytes: int = BLOCK_BYTES, spans: bool = False) -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_words``, ``n_hit``,
    ``n_items``, ``items_sha256``, ``contaminated``; with ``spans`` also
    ``places`` (the hit words) and ``items``; ``keep``: input columns handed on.

    A null or blank text has no words and no hits, and so has a null or blank
    item. Items with a null id are left out; an id that occurs with several
    texts counts once. Rows with a null or repeated id each get their own
    result. Without items nothing is contaminated. With more than one block a
    document's items ride along from pass to pass as a list.
    """
    own = {f"keep_{i}": (c, dict(docs.dtypes)[c]) for i, c in enumerate(keep) if c != text_col}
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), **own).withColumns({
        "n_words": F.lit(0).cast("long"), "places": F.array().cast("array<long>"), "items": F.array().cast("array<long>"),
        "n_items": F.lit(0).cast("long"), "items_sha256": F.lit("")})
    items = pick(benchmark, item_id=(item_col, "long"), text=(item_text_col, "string")) \
        .filter("item_id is not null and text is not null")
    parts = blocks(items, block_bytes)
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        found = sorted((r.item_id, r.text.encode()) for r in part.collect())  # at most about block_bytes
        rows = scan(rows, docs.sparkSession.sparkContext.broadcast(Index(found)), last, spans or not last)
        if i % PASSES == PASSES - 1:
            rows = materialize(rows, "decontaminate", compression="zstd")

    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "places", "items"]
    kept = [*own, *["text"] * (text_col in keep)]
    out = rows.withColumns({
        "n_hit": F.size("places").cast("long"),
        "contaminated": F.size("places") > 0,
    }).select(*(names if spans else names[:6]), *kept)
    return out.withColumnsRenamed({c: name for c, (name, _) in own.items()} | {"text": text_col})
