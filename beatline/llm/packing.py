"""Conflict-constrained best-fit packing of documents into bins.

A bin holds at most ``capacity`` tokens, and no two pieces of the same source
or of the same duplicate cluster. Open bins are ordered by residual space and
carry a bitmap of the sources and one of the clusters they hold. For a piece,
the successor search starts at the least residual that fits and goes on until a
bin without a conflict is found: the tightest compatible bin. If there is none,
a bin is opened. Pieces come largest first.

Rows are dealt to groups by a hash of their id, digest and copy number, so a hot source
or cluster is spread over all groups; a group of about ``group_rows`` rows is
packed by one task and only ids, sizes and digests are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import pick

CAPACITY = 2048
GROUP_ROWS = 2048
#: Copies of a repeated row are numbered in arrays of at most so many.
COPIES_AT_ONCE = 1 << 12
SCHEMA = "doc_id string, piece long, start long, n_tokens long, bin_id string, position long"


class Bins:
    """Open bins by residual. Bins of the same residual and the same bitmaps
    are alike, so they are kept together: a search steps over kinds of bins."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []
        self.kinds: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.n = 0

    def _add(self, residual: int, sources: int, clusters: int, bin_no: int) -> None:
        if residual not in self.kinds:
            insort(self.residuals, residual)
            self.kinds[residual] = {}
        self.kinds[residual].setdefault((sources, clusters), []).append(bin_no)

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin for a piece; ``source`` and ``cluster`` are bits or 0."""
        for residual in self.residuals[bisect_left(self.residuals, size):]:
            for kind, bins in self.kinds[residual].items():
                if not (kind[0] & source or kind[1] & cluster):
                    bin_no = bins.pop()
                    if not bins:
                        del self.kinds[residual][kind]
                        if not self.kinds[residual]:
                            del self.kinds[residual]
                            self.residuals.pop(bisect_left(self.residuals, residual))
                    if residual > size:
                        self._add(residual - size, kind[0] | source, kind[1] | cluster, bin_no)
                    return bin_no
        self.n += 1
        if size < self.capacity:
            self._add(self.capacity - size, source, cluster, self.n - 1)
        return self.n - 1


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that occurs twice or more; 0 for others and nulls,
    which conflict with nothing."""
    codes, _ = pd.factorize(values.where(values.duplicated(keep=False)))
    return [1 << int(c) if c >= 0 else 0 for c in codes]


def pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack one group; columns doc_id (as text), size, source,
    digest, copy, cluster, group."""
    rows = rows.sort_values(["doc_id", "digest", "copy"], kind="stable", na_position="first").reset_index(drop=True)
    sources, clusters = _bits(rows.source), _bits(rows.cluster)
    # The pieces of a document conflict by themselves: of one that is cut, all
    # but the last fill a bin each.
    bins, out = Bins(capacity), []
    last = []
    for i, size in enumerate(rows["size"]):
        whole = max(0, (size - 1) // capacity)
        for p in range(whole):
            out.append((i, p, capacity, bins.place(capacity, 0, 0)))
        if size > 0:
            last.append((-(size - whole * capacity), i, whole))
    for size, i, p in sorted(last):
        out.append((i, p, -size, bins.place(-size, sources[i], clusters[i])))
    found = pd.DataFrame(out, columns=["row", "piece", "n_tokens", "bin"])
    found["position"] = found.groupby("bin").cumcount()
    empty = rows[rows["size"] <= 0]
    packed = pd.DataFrame({
        "doc_id": rows.doc_id.take(found.row).array, "piece": found.piece, "start": found.piece * capacity,
        "n_tokens": found.n_tokens, "bin_id": f"{rows.group.iloc[0]}-" + found.bin.astype(str), "position": found.position})
    nothing = pd.DataFrame({"doc_id": empty.doc_id.array, "piece": 0, "start": 0, "n_tokens": 0, "bin_id": None, "position": None})
    return pd.concat([x for x in (packed, nothing) if len(x)])[["doc_id", "piece", "start", "n_tokens", "bin_id", "position"]]


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pack all documents: a row for each piece, with ``doc_id``, ``piece`` (its
    number), ``start`` (its first token), ``n_tokens``, ``bin_id`` and
    ``position`` (in the bin).

    Tokens are words (``[^\\x20\\x09-\\x0D]+``). A cluster of duplicates is the
    texts that are equal in their words. Longer documents are cut at multiples
    of ``capacity``; whole pieces fill a bin alone. A document without words
    (null or blank) gets a row with no bin, as nothing needs room. A null
    source conflicts with nothing. Repeated rows are duplicates: each is
    packed, in bins of their own. Null ids are packed like others. An empty
    table gives no rows.
    """
    words = F.array_remove(F.split("text", "[ \\t-\\r]+"), "")
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), source=(source_col, "string")).select(
        F.col("doc_id").cast("string"), "source", words.alias("words")).select(
        "doc_id", "source", F.when(F.col("words").isNull(), 0).otherwise(F.size("words")).cast("long").alias("size"),
        F.xxhash64(F.array_join("words", " ")).cast("string").alias("digest"))
    n = max(1, -(-docs.count() // group_rows))
    # Repeated rows are counted first and dealt out one by one, so many at a time.
    rows = rows.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES_AT_ONCE})"))).withColumn(
        "copy", F.explode(F.expr(f"sequence(block * {COPIES_AT_ONCE} + 1, least(copies, (block + 1) * {COPIES_AT_ONCE}))"))) \
        .drop("block", "copies")
    rows = rows.withColumns({
        "cluster": F.when(F.col("size") > 0, F.col("digest")),
        "group": F.pmod(F.xxhash64("doc_id", "source", "digest", "copy"), F.lit(n))})
    packed = rows.groupBy("group").applyInPandas(lambda pdf: pack_group(pdf, capacity), SCHEMA)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))
