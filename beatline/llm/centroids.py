"""Centroid clustering over subvector dictionaries.

Vectors are turned into whole numbers once and written as slices. In a slice
the dimensions are cut into blocks, and a block's values are replaced by codes
into the dictionary of its distinct subvectors; nothing is rounded, so the slice
decodes to the same numbers. In a round every distinct subvector's squared
distance to every centroid is computed once; a vector's distances are the sums,
over its blocks, of the entries that its codes name. Sums for the new centroids
are taken the same way: entries times the number of a cluster's vectors that
use them.

A round is one pass over the written codes without a shuffle of vectors: a task
adds its slices up and hands on one row for each centroid and dimension, which
Spark adds. Only the centroids (``k`` times ``dim`` numbers) meet the driver.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import pick
from beatline.session import materialize

#: Vectors of a slice, at most.
SLICE_ROWS = 1 << 15
#: Widths of blocks that are tried for a slice: the one with the least numbers
#: to store is taken. The choice only moves work.
WIDTHS = (1, 2, 4, 8)
#: Scaled components below this keep squared distances of 64 of them in 64 bits.
LARGEST = 1 << 27
_COUNT, _INERTIA = -1, -2


def encode(values: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Codes and dictionaries of the blocks of a matrix of whole numbers: block
    ``b`` of row ``i`` is ``dictionaries[b][codes[b][i]]``."""
    n, dim = values.shape
    codes, entries = [], []
    for d in range(dim):
        u, at = np.unique(values[:, d], return_inverse=True)
        codes.append(at.astype(np.int64))
        entries.append(u.reshape(-1, 1))
    best = None
    for width in WIDTHS:
        if dim % width:
            break
        cost = sum(n + e.size for e in entries)
        if best is None or cost < best[0]:
            best = cost, codes, entries
        # Neighbouring blocks are paired: their codes together name the pair.
        pairs = [np.unique(codes[b] * len(entries[b + 1]) + codes[b + 1], return_inverse=True)
                 for b in range(0, len(codes) - 1, 2)]
        entries = [np.concatenate([entries[2 * b][u // len(entries[2 * b + 1])],
                                   entries[2 * b + 1][u % len(entries[2 * b + 1])]], axis=1) for b, (u, _) in enumerate(pairs)]
        codes = [at.astype(np.int64) for _, at in pairs]
    return best[1], best[2]


_SLICE = "ids array<long>, width int, sizes array<int>, codes binary, entries binary"


def encoded(kept: DataFrame, dim: int, scale: float) -> DataFrame:
    """The vectors as encoded slices; ``kept`` has ``vec_id`` and ``vector``."""

    def pack(parts):
        ids = pa.concat_arrays([p.column("vec_id") for p in parts])
        vectors = np.concatenate([p.column("vector").flatten().to_numpy(zero_copy_only=False) for p in parts])
        scaled = np.floor(vectors * scale)
        if np.abs(scaled).max() >= LARGEST:
            raise ValueError(f"a component times {scale} is beyond {LARGEST}: its squared distance would not fit in 64 bits")
        codes, entries = encode(scaled.astype(np.int64).reshape(-1, dim))
        row = {"ids": [ids.to_pylist()], "width": [entries[0].shape[1]], "sizes": [[len(e) for e in entries]],
               "codes": [np.concatenate(codes).astype(np.int32).tobytes()],
               "entries": [np.concatenate([e.ravel() for e in entries]).tobytes()]}
        return pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], pa.list_(pa.int64())), pa.array(row["width"], pa.int32()),
             pa.array(row["sizes"], pa.list_(pa.int32())), pa.array(row["codes"], pa.binary()), pa.array(row["entries"], pa.binary())],
            names=list(row))

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                if n and n + part.num_rows > SLICE_ROWS:
                    yield pack(parts)
                    parts, n = [], 0
                parts.append(part)
                n += part.num_rows
        if n:
            yield pack(parts)

    return kept.mapInArrow(run, _SLICE)


class Slice:
    """A decoded row of ``encoded``."""

    def __init__(self, ids: pa.Array, width: int, sizes: list[int], codes: bytes, entries: bytes):
        self.ids, self.width = ids, width
        self.codes = np.frombuffer(codes, np.int32).reshape(len(sizes), len(ids))
        cut = np.cumsum([0, *sizes]) * width
        flat = np.frombuffer(entries, np.int64)
        self.entries = [flat[a:b].reshape(-1, width) for a, b in zip(cut[:-1], cut[1:])]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid (the first of equally near ones) and
        its squared distance."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        for b, entries in enumerate(self.entries):
            part = centroids[:, b * self.width:(b + 1) * self.width]
            table = ((entries[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)
            total += table[self.codes[b]]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """The sums of each cluster's vectors, ``k`` rows."""
        out = []
        for b, entries in enumerate(self.entries):
            used = np.bincount(cluster * len(entries) + self.codes[b], minlength=k * len(entries))
            out.append(used.reshape(k, len(entries)) @ entries)
        return np.concatenate(out, axis=1)


def _slices(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Slice(batch.column("ids")[i].values, batch.column("width")[i].as_py(), batch.column("sizes")[i].as_py(),
                        batch.column("codes")[i].as_py(), batch.column("entries")[i].as_py())


def totals(codes: DataFrame, centroids: np.ndarray) -> dict[tuple[int, int], int]:
    """One assignment of all vectors: by (centroid, dimension) the sums of the
    cluster's vectors, their number and their distances' sum."""
    k, dim = centroids.shape

    def run(batches):
        # Python integers: a task's sums may pass 64 bits.
        added = np.zeros((k, dim + 2), object)
        for s in _slices(batches):
            cluster, distance = s.nearest(centroids)
            added[:, :dim] += s.sums(cluster, k)
            added[:, dim] += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                added[c, dim + 1] += int(distance[cluster == c].astype(object).sum())
        what = [*range(dim), _COUNT, _INERTIA]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), dim + 2), pa.int32()), pa.array(what * k, pa.int32()),
             pa.array([Decimal(int(x)) for x in added.ravel()], pa.decimal128(38, 0))], names=["cluster", "dim", "total"])

    rows = codes.mapInArrow(run, "cluster int, dim int, total decimal(38,0)").groupBy("cluster", "dim").agg(
        F.sum("total").alias("total")).collect()  # k * (dim + 2)
    return {(r.cluster, r.dim): int(r.total) for r in rows}


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: float = 1024.0, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each kept vector: ``vec_id``, ``cluster``, ``distance`` (squared),
    ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are vectors of exactly ``dim`` components, none null or not finite;
    others give no row. A component is ``floor(scale * x)``. The first centroids
    are the ``k`` kept vectors of least sha256 of ``seed:vec_id`` (ties, rows of
    the same id among them, by the vector itself), fewer if there are fewer. A
    null id is no seed, but its vector is clustered like others; without any
    seed the columns after ``vec_id`` are null. Repeated rows count as often as
    they occur. Ties go to the smaller cluster number; an empty cluster keeps
    its centroid. Rounds end early when no centroid moves, as further ones would
    change nothing. An empty table gives no rows. A scaled component of 2^27 or
    more is an error, as distances are 64-bit integers.
    """
    numbers = pick(vectors, vec_id=(id_col, "long"), vector=(vector_col, "array<double>"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = numbers.filter((F.size("vector") == dim) & ~bad)
    first = kept.filter("vec_id is not null").withColumn(
        "at", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)).orderBy("at", "vector").limit(k).collect()
    if not first:
        null = {c: F.lit(None).cast(t) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"),
                                                    ("inertia", "long"), ("centroid_sha256", "string"))}
        return kept.select("vec_id").withColumns(null)
    centroids = np.floor(np.array([r.vector for r in first]) * scale).astype(np.int64)
    codes = materialize(encoded(kept, dim, scale), "vectors", compression="zstd")
    k = len(centroids)
    for _ in range(rounds):
        found = totals(codes, centroids)
        moved = centroids.copy()
        for c in range(k):
            if n := found.get((c, _COUNT), 0):
                moved[c] = [found[c, d] // n for d in range(dim)]
        if (moved == centroids).all():
            break
        centroids = moved
    found = totals(codes, centroids)
    within = [found.get((c, _INERTIA), 0) for c in range(k)]
    names = [digest(c) for c in centroids]

    def run(batches):
        for s in _slices(batches):
            at, distance = s.nearest(centroids)
            yield pa.RecordBatch.from_arrays(
                [s.ids, pa.array(at, pa.int32()), pa.array(distance), pa.array([within[c] for c in at], pa.int64()),
                 pa.array([sum(within)] * len(at), pa.int64()), pa.array([names[c] for c in at], pa.string())],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return codes.mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
