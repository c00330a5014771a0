"""Ranked lexical search over bit-sliced Bloom signatures.

``index`` turns documents into blocks. A block holds documents of like size; its
signature is a table of bit slices, each a bitmap over the block's documents. A
document sets ``HASHES`` slices for each of its terms, and again for each power
of two that the term's count reaches, so the AND of a key's slices is a bitmap
of all documents that hold the term so often, and of some others by chance: it
overestimates presence, never misses it.

``search`` ranks documents for a set of queries. Weighted sums of those bitmaps,
level by level, times the greatest share that the level's counts give at the
document's length, are upper bounds of the scores. A task keeps the best
documents of each query so far; a document whose bound is below the last of them
is provably excluded, every other one is rescored exactly from the block's term
lists. The tasks' best documents (as many rows a query as are asked for) are
ranked by Spark.

Queries travel to the tasks in blocks of bounded size; documents are read once
and never shuffled. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.llm.common import ALNUM, LOWER, Words, documents, mix, pick, ragged, slices, utf8
from beatline.session import materialize

#: Texts that are indexed together.
INDEX_BYTES = 8 << 20
#: Slices for each key of a block's largest document, and hashes of a key. They
#: only move work: more slices exclude more.
SLICES_PER_KEY = 8
HASHES = 3
#: Text of the queries that go to the tasks at once.
BLOCK_BYTES = 8 << 20
#: A query's terms whose bitmaps are added up at once.
TERMS_AT_ONCE = 512
_LEVEL, _TURN = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_NO_ID = np.iinfo(np.int64).max


def places(keys: np.ndarray, level: int, n_slices: int) -> np.ndarray:
    """The slices of terms at a level (their count is at least ``2 ** level``):
    one row for each hash."""
    salts = [np.uint64((level * _LEVEL + h * _TURN) % (1 << 64)) for h in range(1, HASHES + 1)]
    return np.array([mix(keys + salt) % np.uint64(n_slices) for salt in salts], np.int64)


_INDEX = "ids array<long>, counts binary, n_slices int, bits binary, first binary, terms binary, times binary, docs long, total long"


def index(docs: DataFrame) -> DataFrame:
    """The index of ``documents`` rows as blocks; documents without terms have
    no place in it."""

    def run(batches):
        for batch in slices(batches, most=INDEX_BYTES):
            words = Words(utf8(batch.column("text")), ALNUM, LOWER)
            if len(words):
                yield from blocks(batch.column("doc_id"), words)

    def blocks(ids, words):
        terms, doc = words.hashes(), words.doc
        order = np.lexsort((terms, doc))
        terms, doc = terms[order], doc[order]
        new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])]))
        times = np.diff(np.append(new, len(terms)))
        terms, doc = terms[new], doc[new]
        levels = np.frexp(times.astype(float))[1]  # counts of 2**j to 2**(j+1)-1 have j + 1 levels
        keys = np.bincount(doc, weights=levels, minlength=len(words.counts)).astype(np.int64)
        size = np.where(keys > 0, np.frexp(keys.astype(float))[1], 0)
        for c in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero(size == c)
            number = np.full(len(size), -1)
            number[rows] = np.arange(len(rows))
            mine = np.flatnonzero(number[doc] >= 0)  # still in order of document and term
            row, n_slices = number[doc[mine]], SLICES_PER_KEY << c
            table = np.zeros((n_slices, -(-len(rows) // 8) * 8), bool)
            for level in range(int(levels[mine].max())):
                at = levels[mine] > level
                for place in places(terms[mine][at], level, n_slices):
                    table[place, row[at]] = True
            first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(rows)))])
            yield pa.RecordBatch.from_arrays([
                pa.array([ids.take(pa.array(rows)).to_pylist()], pa.list_(pa.int64())),
                pa.array([words.counts[rows].astype(np.int64).tobytes()], pa.binary()), pa.array([n_slices], pa.int32()),
                pa.array([np.packbits(table, axis=1).tobytes()], pa.binary()), pa.array([first.tobytes()], pa.binary()),
                pa.array([terms[mine].tobytes()], pa.binary()), pa.array([times[mine].astype(np.int32).tobytes()], pa.binary()),
                pa.array([len(rows)], pa.int64()), pa.array([int(words.counts[rows].sum())], pa.int64())], names=names)

    names = [x.split()[0] for x in _INDEX.split(", ")]
    return docs.mapInArrow(run, _INDEX)


class Queries:
    """A block of queries: for each its distinct terms and how often each occurs."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts, ALNUM, LOWER)
        self.vocabulary, of = np.unique(words.hashes(), return_inverse=True)
        self.terms, self.times = [], []
        for a, b in zip(words.first[:-1], words.first[1:]):
            t, n = np.unique(of[a:b], return_counts=True)
            self.terms.append(t)
            self.times.append(n)


def document_frequencies(blocks: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How many documents hold each term of the sorted ``vocabulary``."""

    def run(batches):
        n = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for raw in batch.column("terms"):
                terms = np.frombuffer(raw.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                n += np.bincount(at[vocabulary[at] == terms], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some])], names=["term", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        for r in blocks.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            out[r.term] = r.n  # at most one row for each term of the block of queries
    return out


def share(times, m):
    """What an occurrence count gives of a term's weight."""
    return 1_000_000_000 * times // (1000 * times + 8 * m)


def length_norm(counts: np.ndarray, n_docs: int, total: int, b: int = 75) -> np.ndarray:
    """``100 - b + (b * n * N) div L`` of each document."""
    wide = object if b * int(counts.max()) * n_docs >= 1 << 62 else np.int64
    return (100 - b + counts.astype(wide) * (b * n_docs) // total).astype(np.int64)


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, row: dict, vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, total: int):
        self.null = np.array([i is None for i in row["ids"]])
        self.ids = np.array([_NO_ID if i is None else i for i in row["ids"]], np.int64)
        self.m = length_norm(np.frombuffer(row["counts"], np.int64), n_docs, total)
        self.n_slices = row["n_slices"]
        self.bits = np.frombuffer(row["bits"], np.uint8).reshape(self.n_slices, -1)
        first = np.frombuffer(row["first"], np.int64)
        terms = np.frombuffer(row["terms"], np.uint64)
        times = np.frombuffer(row["times"], np.int32).astype(np.int64)
        self.levels = int(times.max()).bit_length()
        # The places of the block that hold a term of the queries, with the weight they bring.
        at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        hit = np.flatnonzero(vocabulary[at] == terms)
        self.term = at[hit]
        doc = np.searchsorted(first, hit, "right") - 1
        self.value = weights[self.term] * share(times[hit], self.m[doc])
        self.first = np.searchsorted(hit, first)
        top = [share((2 << j) - 1, self.m) for j in range(self.levels)]
        self.steps = [t - (top[j - 1] if j else 0) for j, t in enumerate(top)]

    def bounds(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of all documents of the block."""
        out = np.zeros(len(self.ids))
        for at in range(0, len(keys), TERMS_AT_ONCE):
            k, w = keys[at:at + TERMS_AT_ONCE], weights[at:at + TERMS_AT_ONCE].astype(np.float32)
            for level in range(self.levels):
                place = places(k, level, self.n_slices)
                maps = self.bits[place[0]]
                for p in place[1:]:
                    maps = maps & self.bits[p]
                some = maps.any(axis=1)  # terms that no document holds so often go
                if not some.any():
                    break
                k, w, maps = k[some], w[some], maps[some]
                out += self.steps[level] * (w @ np.unpackbits(maps, axis=1, count=len(out)).astype(np.float32))
        return out * (1 + 1e-4) + 1  # more than the sums can lose in rounding

    def scores(self, rows: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``times``: by term of the vocabulary."""
        size = self.first[rows + 1] - self.first[rows]
        at = ragged(self.first[rows], size)
        added = np.concatenate([[0], np.cumsum(self.value[at] * times[self.term[at]])])
        stop = np.cumsum(size)
        return added[stop] - added[stop - size]


class Best:
    """The best documents of a query so far: greatest score, then least id."""

    def __init__(self, n: int):
        self.n, self.score, self.ids, self.null = n, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.n else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        ok = score >= self.least
        score, ids, null = (np.concatenate([a, b[ok]]) for a, b in ((self.score, score), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, -score))[:self.n]
        self.score, self.ids, self.null = score[order], ids[order], null[order]


def _rank(best: list[Best], block: Block, queries: Queries, weights: np.ndarray, n: int) -> None:
    """Bring the documents of a block into the best of each query."""
    times = np.zeros(len(queries.vocabulary), np.int64)
    for found, terms, count in zip(best, queries.terms, queries.times):
        w = weights[terms] * count
        if not w.any():
            continue
        bound = block.bounds(queries.vocabulary[terms], w)
        rows = np.flatnonzero(bound >= found.least)
        if not len(rows):
            continue
        times[terms] = count
        if len(rows) > 2 * n:  # those of greatest bounds first: they raise the bar for the rest
            top = rows[np.argpartition(-bound[rows], n)[:n]]
            found.add(block.scores(top, times), block.ids[top], block.null[top])
            rest = np.setdiff1d(rows, top)
            rows = rest[bound[rest] >= found.least]
        found.add(block.scores(rows, times), block.ids[rows], block.null[rows])
        times[terms] = 0


def search(docs: DataFrame, queries: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each query's ``n`` documents of greatest score above 0: ``item_id``, ``rank``
    (from 1), ``doc_id``, ``score``; equal scores by ascending id, null ids last.

    A null or blank text has no terms: such a document counts nowhere, such a
    query gives no rows. Each row of either table is a document or a query of
    its own, also where its id is null or occurs again (its ranks then start
    anew). Without documents that hold terms there are no rows.
    """
    blocks = materialize(index(documents(docs, id_col, text_col)), "signatures", compression="zstd")
    size = blocks.agg(F.sum("docs").alias("n"), F.sum("total").alias("l")).first()
    n_docs, total = size.n or 0, size.l or 0
    items = pick(queries, item_id=(item_col, "long"), text=(item_text_col, "string")).filter("text is not null")
    text = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = math.ceil(2 * text / block_bytes) if text > block_bytes else 1
    spark, out = docs.sparkSession, None
    for i in range(parts if n_docs else 0):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect()  # about block_bytes at most
        part.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        asked = Queries([r.text.encode() for r in part])
        df = document_frequencies(blocks, asked.vocabulary)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found = _search(blocks, spark.sparkContext.broadcast((asked, weights, [r.item_id for r in part])), n_docs, total, n)
        found = found.withColumn("part", F.lit(i))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("part", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("item_id", "rank", "doc_id", "score")


def _search(blocks: DataFrame, asked, n_docs: int, total: int, n: int) -> DataFrame:
    """The best documents of each query in each task."""

    def run(batches):
        queries, weights, items = asked.value
        if not len(queries.vocabulary):
            return
        best = [Best(n) for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                _rank(best, Block(row, queries.vocabulary, weights, n_docs, total), queries, weights, n)
        size = np.array([len(b.score) for b in best])
        if size.sum():
            query = np.repeat(np.arange(len(best)), size)
            ids, null = np.concatenate([b.ids for b in best]), np.concatenate([b.null for b in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array([items[q] for q in query], pa.int64()), pa.array(query, pa.int32()), pa.array(ids, mask=null),
                 pa.array(np.concatenate([b.score for b in best]))], names=["item_id", "query", "doc_id", "score"])

    return blocks.drop("docs", "total").mapInArrow(run, "item_id long, query int, doc_id long, score long")
