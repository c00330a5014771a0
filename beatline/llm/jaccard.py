"""N-gram Jaccard join by token-combination prefixes, and its components.

A document's set is its distinct 5-word shingles. Two sets link when they
share 80 % of their union. Tokens are ordered: rare ones first (by hash), the
frequent ones last (by count). A linked pair's first common token lies in the
first ``n - need + 1`` tokens (the prefix) of both sets, ``need`` being the
least overlap. So:

* rare tokens of the prefix are indexed alone;
* where a prefix runs into the frequent tokens, it is extended by ``m`` more
  tokens and pairs of frequent tokens are indexed: if the first common token is
  frequent, so are the first ``m + 1``, all in both extended prefixes; a hash
  deals tokens to ``m`` parts, so two of them share a part, and all pairs within
  a part are indexed. ``m`` grows with the size class, and a set is also
  registered in the next class if a partner can be in it.

No link is lost, and a key's documents are candidates. They are verified in
two rounds. First a star: each document is tried against one head, the least
document of its keys, which is linear in the documents, and a group of copies
mostly becomes one component. Among crowded keys that still hold several, other
heads are tried while that pays. Then, among keys whose documents still lie in
several components, pairs across components are tried whose sizes are of the
same or neighbouring bands. Two bounds that hold for certain rule most out before
sets are compared: the parity of hash cells, within the join, and a histogram of
hash cells. Equal sets are one class throughout, so copies are never paired. Shingles
are compared by 64-bit hashes.

The texts are read for the survey, twice for the index, and once for the
histograms of the documents that share a key, which are written once; a
verification reads them again where pairs pass those, and makes the sets of
these pairs only. (Written sets would take 1.5 times the input.) Labels are
carried from round to round, so that a round follows its own links only. A key
of many documents is dealt to several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import (LOWER, NOT_BLANK, Words, bitmap_bits, documents, grams, id_bit,
                                 id_bitmap, in_bitmap, mix, ragged, slices, utf8)
from beatline.session import materialize, release_path

SHINGLE = 5
#: A token is frequent if blocks see it in so many documents.
FREQUENT_LEAST = 12
#: At most so many tokens, the most frequent ones, are treated as frequent.
MOST_FREQUENT = 1 << 20
#: Tokens counted together when frequent ones are looked for.
BLOCK_TOKENS = 4_000_000
#: A key with at least so many documents is crowded; stars go on among these.
CROWD = 24
#: At most so many more rounds, and only while this share of tried pairs links.
ROUNDS = 8
WORTH = 0.02
#: A key's documents are dealt to tasks by this number, to at most so many.
SPLIT = 256
MOST_SPLITS = 4096
#: Documents of a key that one task compares with the others across components.
ACROSS = 4096
#: Sizes are banded by this ratio: linked sets, whose sizes differ by 5/4 at
#: most, lie in the same or neighbouring bands.
BAND = 1.3
_CELLS = 256
_PARITY = 256
_LANES = ("b0", "b1", "b2", "b3")
_SECOND = np.uint64(0xA0761D6478BD642F)


class Sets:
    """The shingle sets of a list of texts: hashes ``tokens``, sorted within
    ``first[i]:first[i + 1]``, and a 128-bit digest of each set."""

    def __init__(self, texts: list[bytes], k: int = SHINGLE):
        words = Words(texts, NOT_BLANK, LOWER)
        hashes = words.hashes()
        inside = words.whole(k)
        keys, doc = grams(hashes, k)[inside], words.doc[:max(0, len(words) - k + 1)][inside]
        for n in range(1, k):  # shorter texts: the whole sequence
            few = np.flatnonzero(words.counts == n)
            if len(few):
                keys = np.concatenate([keys, grams(hashes, n)[words.first[few]]])
                doc = np.concatenate([doc, few])
        order = np.argsort(keys)
        order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
        keys, doc = keys[order], doc[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        self.tokens, self.doc = keys[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.size = np.diff(self.first)
        self.digest = [self._sum(mix(self.tokens.copy())), self._sum(mix(self.tokens ^ _SECOND))]

    def parity(self) -> list[np.ndarray]:
        """Four longs for each set: whether each of ``_PARITY`` cells holds an odd
        number of its tokens. Cells that differ between two sets each hold a
        token that they do not share."""
        cell = (self.tokens >> np.uint64(20)) % np.uint64(_PARITY)
        bit = np.uint64(1) << (cell & np.uint64(63))
        lane = (cell >> np.uint64(6)).astype(np.int64)
        out = []
        for j in range(_PARITY // 64):
            total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(np.where(lane == j, bit, np.uint64(0)))])
            out.append((total[self.first[1:]] ^ total[self.first[:-1]]).view(np.int64))
        return out

    def _sum(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return (total[self.first[1:]] - total[self.first[:-1]]).view(np.int64)

    def representatives(self, ids: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Of each distinct set that is not empty, the text of least id."""
        rows = np.flatnonzero(valid & (self.size > 0))
        order = rows[np.lexsort((ids[rows], self.digest[1][rows], self.digest[0][rows]))]
        a, b = self.digest[0][order], self.digest[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return np.sort(order[new])


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("doc_id")
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(False)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def survey(docs: DataFrame) -> DataFrame:
    """One pass over the texts: (doc_id, n_shingles, d1, d2, b0 to b3: the parity)
    of every row, and, with a ``token``, the tokens that a block of about ``BLOCK_TOKENS`` tokens of
    distinct sets holds three times or more, and how often (``n``)."""
    names = ["doc_id", "n_shingles", "d1", "d2", *_LANES, "token", "n"]

    def often(block: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate([np.zeros(0, np.uint64), *block]))
        head = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])[:len(tokens)])
        n = np.diff(np.append(head, len(tokens)))
        head, n = head[n > 2], n[n > 2]
        nothing = pa.nulls(len(n), pa.int64())
        return pa.RecordBatch.from_arrays([nothing] * 8 + [pa.array(tokens[head].view(np.int64)), pa.array(n)], names=names)

    def run(batches):
        block, held, seen = [], 0, set()
        for batch in slices(batches):
            sets = Sets(utf8(batch.column("text")))
            rows = sets.representatives(*_ids(batch))
            new = [d not in seen for d in zip(sets.digest[0][rows].tolist(), sets.digest[1][rows].tolist())]
            rows = rows[np.array(new, bool)]
            seen.update(zip(sets.digest[0][rows].tolist(), sets.digest[1][rows].tolist()))
            block.append(sets.tokens[ragged(sets.first[rows], sets.size[rows])])
            held += len(block[-1])
            nothing = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets.size.astype(np.int64)), *map(pa.array, sets.digest),
                 *map(pa.array, sets.parity()), nothing, nothing], names=names)
            if held > BLOCK_TOKENS:
                yield often(block)
                block, held, seen = [], 0, set()
        yield often(block)

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def frequent_tokens(seen: DataFrame, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The frequent tokens of a survey, sorted, and the rank of each by count.
    The choice only affects speed, never which links are found."""
    rows = seen.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= FREQUENT_LEAST).orderBy(F.desc("n"), "token").limit(most).toArrow()
    tokens, n = (rows.column(c).to_numpy() for c in ("token", "n"))  # at most ``most``
    tokens = tokens.astype(np.int64).view(np.uint64)
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((tokens, n))] = np.arange(1, len(n) + 1)
    order = np.argsort(tokens)
    return tokens[order], rank[order]


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def index_keys(sets: Sets, rows: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of the index entries of the texts ``rows``."""
    rows = rows[sets.size[rows] >= 4]  # unequal smaller sets share less than 80 %
    size = sets.size[rows]
    tokens = sets.tokens[ragged(sets.first[rows], size)]
    of = np.repeat(np.arange(len(rows)), size)
    rank = np.zeros(len(tokens), np.int64)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], tokens), len(frequent[0]) - 1)
        rank = np.where(frequent[0][at] == tokens, frequent[1][at], 0)
        order = np.lexsort((tokens, rank, of))
        tokens, rank = tokens[order], rank[order]
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
    need = -(-4 * size // 5)
    prefix = size - need + 1
    single = (place < prefix[of]) & (rank == 0)
    keys, texts = [mix(tokens[single] ^ _SECOND)], [rows[of[single]]]

    rare = np.bincount(of[rank == 0], minlength=len(rows))
    into = np.flatnonzero(rare < prefix)
    own = size_class(size[into])
    more = size_class(size[into] * 5 // 4)
    for docs_in, cls in ((into, own), (into[more > own], more[more > own])):
        parts = np.zeros(len(rows), np.int64)
        parts[docs_in] = 1 << np.maximum(cls - 4, 0)
        chosen = (parts[of] > 0) & (rank > 0) & (place < (size - need + 1 + parts)[of])
        t, d = tokens[chosen], of[chosen]
        part = (t % parts[d].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((t, part, d))
        t, d, part = t[order], d[order], part[order]
        group = np.cumsum(np.concatenate([[0], (d[1:] != d[:-1]) | (part[1:] != part[:-1])]).astype(np.int64)) if len(t) else d
        step = 1
        while step < len(t) and (both := np.flatnonzero(group[step:] == group[:-step])).size:
            pair = mix((t[both] * np.uint64(0x9E3779B97F4A7C15)) ^ t[both + step])
            keys.append(mix(pair + parts[d[both]].astype(np.uint64)))
            texts.append(rows[d[both]])
            step += 1
    return np.concatenate(keys), np.concatenate(texts)


def index_entries(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, node, size): index entries; of equal sets in a slice only the one
    of least id."""
    table = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in slices(batches):
            ids, valid = _ids(batch)
            sets = Sets(utf8(batch.column("text")))
            keys, texts = index_keys(sets, sets.representatives(ids, valid), table.value)
            yield _batch(key=keys.view(np.int64), node=ids[texts], size=sets.size[texts].astype(np.int32))

    return docs.mapInArrow(run, "key long, node long, size int")


def set_parts(docs: DataFrame, ids: DataFrame, n_ids: int, pack, name: str) -> DataFrame:
    """(id, part), written: what ``pack`` makes of the sets of the documents in
    ``ids`` (and, by chance, of some more), of equal sets in a slice that of
    least id."""
    n_bits = bitmap_bits(n_ids)
    bits = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, n_bits))

    def run(batches):
        for batch in slices(batches):
            held, valid = _ids(batch)
            batch = batch.filter(pa.array(in_bitmap(bits.value, batch.column("at").to_numpy()) & valid))
            if batch.num_rows:
                held, valid = _ids(batch)
                sets = Sets(utf8(batch.column("text")))
                rows = sets.representatives(held, valid)
                packed = [pack(sets.tokens[sets.first[i]:sets.first[i + 1]]) for i in rows]
                yield _batch(id=held[rows], part=pa.array(packed, pa.binary()))

    rows = docs.withColumn("at", id_bit("doc_id", n_bits))
    return materialize(rows.mapInArrow(run, "id long, part binary"), name, compression="zstd")


def histogram(tokens: np.ndarray) -> bytes:
    """How many tokens fall in each of ``_CELLS`` cells. Two sets share at most
    the sum of the lesser counts."""
    counts = np.bincount((tokens & np.uint64(_CELLS - 1)).astype(np.int64), minlength=_CELLS)
    return counts.astype(np.uint8 if counts.max() < 256 else np.int64).tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == _CELLS else np.int64).astype(np.int64)


def may_link(x: bytes, y: bytes) -> bool:
    """False only if the histograms rule a link out."""
    x, y = _counts(x), _counts(y)
    shared = int(np.minimum(x, y).sum())
    return 100 * shared >= 80 * (int(x.sum() + y.sum()) - shared)


def links(x: bytes, y: bytes) -> bool:
    """Whether two packed sets link."""
    both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= 80 * (len(both) - shared)


def holding(pairs: DataFrame, parts: DataFrame, test) -> DataFrame:
    """The pairs (a, b) whose ``parts`` (id, part) pass ``test``."""
    left, right = (parts.select(F.col("id").alias(c), F.col("part").alias(p)) for c, p in (("a", "x"), ("b", "y")))

    def run(batches):
        for batch in batches:
            ok = [test(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def verify(pairs: DataFrame, docs: DataFrame, histograms: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link. The written ``histograms``, far smaller
    than the sets, first rule out pairs that cannot."""
    for test in (may_link, links):
        if pairs.isEmpty():
            break
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        if test is may_link:
            parts = materialize(histograms.join(ids, "id", "left_semi"), "candidates", compression="zstd")
        else:
            parts = set_parts(docs, ids, 2 * pairs.count(), np.ndarray.tobytes, "sets")
        pairs = materialize(holding(pairs, parts, test), "pairs")
        _release(parts)
    return pairs


def _release(written: DataFrame) -> None:
    """Delete a written stage whose last reader has been written itself."""
    files = written.inputFiles()
    if files:
        release_path(written.sparkSession, files[0].rsplit("/", 1)[0])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of the edges (a, b), by
    alternating large and small stars until nothing changes."""
    edges = materialize(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_shingles`` (its set's size)
    and ``component_id``, the least id reachable by links.

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; a
    text of 1 to 4 words is one shingle. A null or blank text has an empty set,
    links with nothing and is its own component. Rows with a null id link with
    nothing and have no component. Rows that share an id are one document of
    several sets. An empty table gives no rows.
    """
    docs = documents(docs, id_col, text_col)
    seen = materialize(survey(docs), "survey")
    sets = seen.filter("token is null").select("doc_id", "n_shingles", "d1", "d2")
    some = seen.filter("token is null and doc_id is not null and n_shingles > 0")
    classes = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    some = materialize(some.join(classes, ["d1", "d2"]).select("doc_id", "rep", "n_shingles", *_LANES).distinct(), "classes")
    of = some.select(F.col("doc_id").alias("node"), "rep")
    shapes = some.filter("doc_id = rep").select("rep", F.col("n_shingles").alias("size"), *_LANES)

    entries = index_entries(docs, frequent_tokens(seen))
    shared = entries.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count("*").alias("n")) \
        .filter("head < last").withColumn("splits", _splits("n", SPLIT)).drop("last", "n")
    members = materialize(entries.join(shared.hint("shuffle_hash"), "key"), "members", compression="zstd")
    named = materialize(members.select("key", "splits", "node").join(of, "node").select("key", "splits", "rep").distinct(),
                        "named", compression="zstd")
    ids = named.select(F.col("rep").alias("id")).distinct()
    histograms = set_parts(docs, ids, ids.count(), histogram, "histograms")

    # The star: each document against the least head of its keys.
    stars = members.filter("node <> head").groupBy("node").agg(F.min("head").alias("head"))
    stars = materialize(_classes(stars.select(F.col("node").alias("a"), F.col("head").alias("b")), of), "stars")
    least = of.groupBy("node").agg(F.min("rep").alias("b"))  # a document of several sets joins their classes
    labels = _advance(of.select("rep", F.col("rep").alias("label")).distinct(), verify(stars, docs, histograms).unionByName(
        of.join(least, "node").filter("rep <> b").select(F.col("rep").alias("a"), "b")))

    # More stars among the documents of crowded keys, with other heads.
    tried = stars
    for i in range(ROUNDS):
        crowded = _mixed(named, labels, CROWD)
        heads = crowded.groupBy("key", "splits").agg(F.min(F.struct(F.xxhash64("rep", F.lit(i)).alias("by"), "rep", "label")).alias("head"))
        pairs = crowded.join(_dealt(heads), ["key", "salt"]).filter("label <> head.label").groupBy("rep").agg(
            F.min(F.struct(F.xxhash64("head.rep", "rep").alias("by"), F.col("head.rep").alias("rep"))).alias("head"))
        pairs = pairs.select(F.least("rep", "head.rep").alias("a"), F.greatest("rep", "head.rep").alias("b")).distinct()
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "stars")
        new = verify(pairs, docs, histograms)
        tried, labels = tried.unionByName(pairs), _advance(labels, new)
        if new.count() <= WORTH * pairs.count():
            break

    # Pairs across components among the documents of a key: a set meets those of
    # its own and the next larger band.
    shaped = _mixed(named, labels).join(shapes, "rep").withColumn("splits", _splits("n", ACROSS)) \
        .withColumn("band", F.floor(F.log(BAND, "size")))
    small = shaped.withColumn("salt", _salt("rep"))
    large = _dealt(shaped.drop("salt")).withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"))))
    differ = " + ".join(f"bit_count(p.{c} ^ q.{c})" for c in _LANES)
    across = small.alias("p").join(large.alias("q"), F.expr(
        "p.key = q.key and p.salt = q.salt and p.band = q.band and p.label <> q.label "
        "and (p.size < q.size or p.size = q.size and p.rep < q.rep) and 5 * p.size >= 4 * q.size "
        f"and 9 * ({differ}) <= p.size + q.size")) \
        .select(F.least("p.rep", "q.rep").alias("a"), F.greatest("p.rep", "q.rep").alias("b")).distinct() \
        .join(tried, ["a", "b"], "left_anti")
    labels = _advance(labels, verify(materialize(across, "across"), docs, histograms))

    reach = of.join(labels, "rep").groupBy("node").agg(F.min("label").alias("component"))
    return sets.join(reach.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _splits(n: str, size: int) -> Column:
    """To how many tasks a key of ``n`` documents is dealt."""
    return F.least(F.ceil(F.col(n) / size), F.lit(MOST_SPLITS)).cast("int")


def _salt(rep: str) -> Column:
    return F.pmod(F.xxhash64(rep), F.col("splits")).cast("int")


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row once for each ``salt`` of its key."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).drop("splits")


def _advance(labels: DataFrame, new: DataFrame) -> DataFrame:
    """The labels (rep, label) after the links ``new`` (a, b): links between
    labels, whose components rename them."""
    x, y = (labels.select(F.col("rep").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    edges = new.join(x, "a").join(y, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    moved = components(edges).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return materialize(labels.join(moved, "label", "left").select("rep", F.coalesce("to", "label").alias("label")), "labels")


def _mixed(named: DataFrame, labels: DataFrame, least: int = 2) -> DataFrame:
    """(key, salt, splits, rep, label, n): the members of the keys that hold
    several components and at least ``least`` documents (``n``)."""
    rows = named.join(labels, "rep")
    keys = rows.groupBy("key", "splits").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")) \
        .filter(f"low < high and n >= {least}").select("key", "splits", "n")
    return materialize(rows.withColumn("salt", _salt("rep")).join(_dealt(keys).hint("shuffle_hash"), ["key", "salt"]),
                       "mixed", compression="zstd")


def _classes(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents as distinct pairs of class representatives."""
    x, y = (of.select(F.col("node").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "ab")
    return pairs.join(x, "a").join(y, "b").filter("rep_a <> rep_b").select(
        F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
