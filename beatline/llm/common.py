"""Helpers shared by the operators: reading tables, picking columns,
slicing Arrow batches and vectorised work on words.

Words are found on UTF-8 bytes. Every separator used here is an ASCII byte,
so a byte table decides, and no multi-byte character can be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """``pick(df, doc_id=("id", "long"))``: the named columns, cast and
    renamed. A name is matched exactly and by position, so extra columns
    whose names differ only in case, or occur twice, do no harm."""
    names = df.columns
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.select(*[
        F.col(f"c{names.index(name)}").cast(kind).alias(out)
        for out, (name, kind) in columns.items()])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pick(df, doc_id=(id_col, "long"), text=(text_col, "string"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice hold about ``most``
    bytes; a text longer than that is a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array(pc.binary_length(batch.column(column)).fill_null(0), np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for a, b in ranges:
        out[a:b + 1] = False
    return out


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_BLANK = _byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, after lower-casing A-Z.
ALNUM = _byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_LENGTH = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_PAD = 8


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a list of texts.

    ``start`` and ``end`` are byte offsets into ``buf``; the words of text
    ``i`` are ``first[i]:first[i + 1]``; ``doc`` gives each word's text.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray, fold: np.ndarray | None = None):
        buf = np.frombuffer(b"\n".join([*texts, bytes(_PAD)]), np.uint8)
        self.buf = buf if fold is None else fold[buf]
        inside = is_word[self.buf[:-_PAD]]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.start, self.end = edges[0::2], edges[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.start, self.begin)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every word."""
        lanes = np.ndarray((len(self.buf) - 7,), "<u8", self.buf, 0, (1,))
        size = self.end - self.start
        out = lanes[self.start] & _MASK[np.minimum(size, 8)]
        out ^= size.astype(np.uint64) * _LENGTH + np.uint64(seed)
        mix(out)
        rest = np.flatnonzero((size > 8) & (size <= 64))
        at = 8
        while rest.size:
            more = lanes[self.start[rest] + at] & _MASK[np.minimum(size[rest] - at, 8)]
            out[rest] = mix(out[rest] * _GRAM + more)
            at += 8
            rest = rest[size[rest] > at]
        for i in np.flatnonzero(size > 64):
            out[i] = xxhash.xxh64_intdigest(self.buf[self.start[i]:self.end[i]].tobytes(), seed)
        return out

    def whole(self, k: int) -> np.ndarray:
        """Which of the ``len - k + 1`` runs of k words lie in one text."""
        n = len(self) - k + 1
        return self.doc[:n] == self.doc[k - 1:] if n > 0 else np.zeros(0, bool)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += hashes[j:j + n]
    return mix(out)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` neighbours."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    out, span = values, 1
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[w - span:w - span + n])


#: Bits of an id bitmap (1 MB), at least, and (32 MB) at most.
BITMAP_BITS = 1 << 23
MOST_BITMAP_BITS = 1 << 28


def bitmap_bits(n: int) -> int:
    """Bits for a bitmap of ``n`` ids: at least eight for each, a power of two,
    within the limits. Beyond them more ids pass by chance; none is lost."""
    return min(max(1 << (8 * n).bit_length(), BITMAP_BITS), MOST_BITMAP_BITS)


def id_bit(column: str, bits: int = BITMAP_BITS) -> Column:
    """The place of an id in an id bitmap."""
    return F.pmod(F.xxhash64(column), F.lit(bits))


def id_bitmap(ids: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of ``bits`` bits of the ids in column ``id``, built by Spark: it
    holds every id, and others by chance."""
    at = id_bit("id", bits) + 1  # Spark counts bits from 1
    rows = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:  # at most bits / 32,768 of 4 KB
        out[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7)) & 1 == 1


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``start[0], start[0]+1, ...`` for ``length[0]`` places, then the next."""
    total = np.cumsum(length)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(start - (total - length), length)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of integers over ``first[i]:first[i + 1]``, empty ranges included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
