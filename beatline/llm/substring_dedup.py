"""Substring dedup by super-k-mer partitioning.

A window is 13 consecutive words. Its minimiser is its least 3-word gram, by
hash, with grams that are hot in the corpus put last. Consecutive windows of a
document with the same minimiser travel as one packed string of their words to
the minimiser's bucket, so equal windows always meet in one bucket and a word
is sent some three times instead of thirteen.

A map task packs, for each slice of its documents and each bucket, the distinct
strings once, with the least id of the documents that hold each, and the places
as (document, word) lists beside them; a pack is compressed. In a bucket all
windows are sorted by hash, equal neighbours are compared word by word, and the
least id that holds a window decides: the window's places in other documents
are covered. The covered runs are then joined to the documents by id and text digest.

Hot groups: copies in a slice send a string once; windows at the edges of a
common passage do not all follow the passage's hot grams, as those come last.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import (NOT_BLANK, Words, documents, grams, id_bit, id_bitmap, in_bitmap, mix,
                                 ragged, slices, sliding_min, utf8)
from beatline.session import materialize

WINDOW = 13
GRAM = 3
#: Grams with at least this share of a slice's minimisers are hot.
HOT_SHARE = 1 / 2048
#: Texts that are packed together.
PACK_BYTES = 8 << 20
#: Buckets are sized for so much text each.
BUCKET_BYTES = 3 << 20
_HOT = np.uint64(1 << 63)
_SALT = np.uint64(0x8CB92BA72F3D8DD7)


def minimisers(words: Words, hashes: np.ndarray, hot: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows' first words, and their minimisers."""
    keys = grams(hashes, GRAM) >> np.uint64(1)
    if len(hot) and len(keys):
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        keys = np.where(hot[at] == keys, keys | _HOT, keys)
    least = sliding_min(keys, window - GRAM + 1)
    inside = words.whole(window)
    return np.flatnonzero(inside), least[:len(inside)][inside]


def hot_grams(docs: DataFrame, window: int = WINDOW) -> np.ndarray:
    """Grams that are minimisers too often; sorted. A slice names at most
    1 / HOT_SHARE of them, and as many are kept of the sum. They only balance
    the buckets: any choice gives the same result."""
    most = round(1 / HOT_SHARE)

    def run(batches):
        for batch in slices(batches):
            words = Words(utf8(batch.column("text")), NOT_BLANK)
            _, least = minimisers(words, words.hashes(), np.zeros(0, np.uint64), window)
            keys, n = np.unique(least, return_counts=True)
            hot = n >= max(8, HOT_SHARE * len(least))
            yield pa.RecordBatch.from_arrays([pa.array(keys[hot].view(np.int64)), pa.array(n[hot])], names=["gram", "n"])

    rows = docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "gram").limit(most).collect()
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def _text_of(words: Words, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of runs of words, each word followed by a space, and the
    number of bytes of each run."""
    at = ragged(first, count)
    size = words.end[at] - words.start[at] + 1
    out = words.buf[ragged(words.start[at], size)]
    if len(out):
        out[np.cumsum(size) - 1] = 32
    total = np.concatenate([[0], np.cumsum(size)])
    stop = np.cumsum(count)
    return out, total[stop] - total[stop - count]


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, each with its length, compressed."""
    parts = []
    for a in arrays:
        parts += [np.array([len(a), a.dtype.itemsize], np.int64).tobytes(), a.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        n, size = np.frombuffer(raw, np.int64, 2, at)
        out.append(np.frombuffer(raw, kind, int(n), at + 16))
        at += 16 + int(n * size)
    return out


#: A pack: of each string its bytes, windows, least id, least id's places start;
#: of each place its row and word; of each row its id and key.
_KINDS = (np.uint8, np.int32, np.int64, np.int32, np.int32, np.int32, np.int64, np.int64)


def packs(docs: DataFrame, hot: np.ndarray, n_buckets: int, window: int = WINDOW) -> DataFrame:
    """(bucket, pack): the super-k-mers of all documents."""
    hot_of = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        for batch in slices(batches, most=PACK_BYTES):
            batch = batch.filter(batch.column("doc_id").is_valid())
            words = Words(utf8(batch.column("text")), NOT_BLANK)
            hashes = words.hashes()
            at, least = minimisers(words, hashes, hot_of.value, window)
            if not len(at):
                continue
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("key").to_numpy()
            new = np.ones(len(at), bool)
            new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (words.doc[at[1:]] != words.doc[at[:-1]])
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(at)))  # windows of each run
            first, row = at[begin], words.doc[at[begin]]
            bucket = (mix(least[begin].copy()) % np.uint64(n_buckets)).astype(np.int64)
            # Two hashes over the words tell a slice's strings apart.
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in _placed(hashes)]
            power = _powers(len(hashes) + 1)
            own = [(t[first + n + window - 1] - t[first]) * power[1][first] for t in total]
            order = np.lexsort((first, ids[row], own[1], own[0], n, bucket))
            b, c, o = bucket[order], n[order], [x[order] for x in own]
            change = np.ones(len(order), bool)
            change[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1]) | (o[0][1:] != o[0][:-1]) | (o[1][1:] != o[1][:-1])
            heads = np.flatnonzero(change)
            ends = np.append(heads[1:], len(order))
            cuts = np.flatnonzero(np.diff(b[heads], prepend=-1))
            for x, y in zip(cuts, np.append(cuts[1:], len(heads))):
                places = order[heads[x]:ends[y - 1]]
                chosen = order[heads[x:y]]
                text, _ = _text_of(words, first[chosen], n[chosen] + window - 1)
                rows, of = np.unique(row[places], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b[heads[x]])], pa.int32()), pa.array([_pack(
                        text, n[chosen].astype(np.int32), ids[row[chosen]], (heads[x:y] - heads[x]).astype(np.int32),
                        of.astype(np.int32), (first[places] - words.first[row[places]]).astype(np.int32),
                        ids[rows], keys[rows])], pa.binary())], names=["bucket", "pack"])

    return docs.mapInArrow(run, "bucket int, pack binary")


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64, and of its inverse."""
    up, down = np.full(n, _ODD), np.full(n, _INVERSE)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _placed(hashes: np.ndarray) -> list[np.ndarray]:
    """Two sequences of terms whose sums over a run, moved to the start by an
    inverse power, are hashes of the run."""
    power = _powers(len(hashes))[0]
    return [hashes * power, mix(hashes ^ _SALT) * power]


def least_holders(text: np.ndarray, n: np.ndarray, holder: np.ndarray, window: int) -> np.ndarray:
    """Of every window of the strings (in order), the least holder of any equal
    window. Windows are sorted by hash; equality is decided on the words."""
    words = Words([text.tobytes()], NOT_BLANK)
    begin = np.cumsum(n + window - 1) - (n + window - 1)
    first = ragged(begin, n)
    owner = np.repeat(holder, n)
    keys = grams(words.hashes(1), window)[first]
    order = np.lexsort((owner, keys))
    size = words.end[first + window - 1] - words.start[first]
    k, z = keys[order], size[order]
    same = np.concatenate([[False], (k[1:] == k[:-1]) & (z[1:] == z[:-1])])
    at = np.flatnonzero(same)
    for i in range(0, len(at), 1 << 16):  # compare each with the one before
        part = at[i:i + (1 << 16)]
        p, q, length = order[part], order[part - 1], z[part]
        different = words.buf[ragged(words.start[first[p]], length)] != words.buf[ragged(words.start[first[q]], length)]
        total = np.concatenate([[0], np.cumsum(different)])
        stop = np.cumsum(length)
        same[part[total[stop] > total[stop - length]]] = False
    head = np.flatnonzero(~same)
    group = np.cumsum(~same) - 1
    if len(head) and len(np.unique(k[head])) < len(head):
        return _least_by_words(words, first, owner, window)
    least = np.empty(len(first), np.int64)
    least[order] = owner[order][head][group]
    return least


def _least_by_words(words: Words, first: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """The same, where different windows have equal hashes: by a dictionary."""
    found: dict[bytes, int] = {}
    texts = [words.buf[words.start[f]:words.end[f + window - 1]].tobytes() for f in first]
    for t, o in zip(texts, owner.tolist()):
        found[t] = min(o, found.get(t, o))
    return np.array([found[t] for t in texts], np.int64)


def covered_runs(bucket: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """(id, row key, first window, number of windows) of the covered runs of
    windows, from a bucket's packs."""
    parts = [_unpack(x, *_KINDS) for x in bucket]
    text = np.concatenate([p[0] for p in parts])
    n, holder = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    least = least_holders(text, n.astype(np.int64), holder, window)
    out = [np.zeros((4, 0), np.int64)]
    done = 0
    for _, n, _, start, of, word, ids, keys in parts:
        n = n.astype(np.int64)
        begin = done + np.cumsum(n) - n  # of each string, its windows
        per = np.diff(np.append(start, len(of)))  # of each string, its places
        string = np.repeat(np.arange(len(n)), per)
        done += int(n.sum())
        # A place matters if any of its windows has a holder less than its id.
        lowest = np.minimum.reduceat(least, begin) if len(n) else least[:0]
        hit = np.flatnonzero(lowest[string] < ids[of])
        windows = ragged(begin[string[hit]], n[string[hit]])
        of_hit = np.repeat(hit, n[string[hit]])
        where = word[of_hit].astype(np.int64) + windows - begin[string[of_hit]]
        gone = least[windows] < ids[of[of_hit]]
        of_hit, where = of_hit[gone], where[gone]
        new = np.ones(len(of_hit), bool)
        new[1:] = (of_hit[1:] != of_hit[:-1]) | (where[1:] != where[:-1] + 1)
        heads = np.flatnonzero(new)
        row = of[of_hit[heads]]
        out.append(np.array([ids[row], keys[row], where[heads], np.diff(np.append(heads, len(of_hit)))]))
    return tuple(np.concatenate(out, axis=1))


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
          texts: bool = False) -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` and, with ``texts``, ``kept`` (the words kept, joined by a
    space).

    Words covered by a window that also starts in a document of smaller id are
    removed; all windows are those of the input. A null or blank text has no
    words. A row with a null id loses nothing and takes nothing from others.
    Rows of the same id take nothing from each other. Texts shorter than a
    window are kept. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n_buckets = max(8, math.ceil(size / BUCKET_BYTES))
    sent = packs(docs, hot_grams(docs, window), n_buckets, window).repartition(n_buckets, "bucket")

    def covered(batches):
        buckets: dict[int, list[bytes]] = {}
        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("pack").to_pylist()):
                buckets.setdefault(b, []).append(p)
        for b in list(buckets):
            ids, keys, first, n = covered_runs(buckets.pop(b), window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(keys), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["doc_id", "key", "first", "n"])

    runs = materialize(sent.mapInArrow(covered, "doc_id long, key long, first int, n int").groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("first", "n")).alias("runs")), "runs", compression="zstd")

    # Texts are shuffled to meet their runs only where the bitmap holds the id.
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(runs.select(F.col("doc_id").alias("id"))))
    placed = docs.withColumn("at", id_bit("doc_id"))

    def some(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bits.value, batch.column("at").to_numpy()))).select(["doc_id", "text", "key"])

    joined = placed.mapInArrow(some, "doc_id long, text string, key long").join(runs, ["doc_id", "key"], "left").select(
        "doc_id", "text", F.col("runs.first").alias("first"), F.col("runs.n").alias("n"))
    whole = placed.select("doc_id", "text", "at", F.lit(None).cast("array<int>").alias("first"), F.lit(None).cast("array<int>").alias("n"))

    def keep(batches):
        for batch in slices(batches):
            if "at" in batch.schema.names:
                batch = batch.filter(pa.array(~in_bitmap(bits.value, batch.column("at").to_numpy())))
            words = Words(utf8(batch.column("text")), NOT_BLANK)
            gone = np.zeros(len(words) + 1, np.int64)
            for i, (first, n) in enumerate(zip(batch.column("first").to_pylist(), batch.column("n").to_pylist())):
                if first:
                    at = np.array(first) + words.first[i]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + np.array(n) + window - 1, -1)
            left = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            counts = np.bincount(words.doc[left], minlength=batch.num_rows)
            raw, size = _text_of(words, left, np.ones(len(left), np.int64))
            total = np.concatenate([[0], np.cumsum(size)])
            stop = np.cumsum(counts)
            raw = raw.tobytes()
            kept = [raw[total[a]:max(total[a], total[b] - 1)] for a, b in zip(stop - counts, stop)]
            out = [batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array((words.counts - counts).astype(np.int64)),
                   pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            if texts:
                out.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    names = [x.split()[0] for x in schema.split(", ")]
    return whole.mapInArrow(keep, schema).unionByName(joined.mapInArrow(keep, schema))
