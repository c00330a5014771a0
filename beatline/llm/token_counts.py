"""Token counts: map-side two-tier lookup.

A piece tokenizer without pieces that run on into a following space splits
every text into independent pre-tokens, a run of spaces with the characters
after it, so a text's tokens are the sum of its pre-tokens' lengths.

* Tier 1: the most frequent pre-tokens of the whole input (each task sends
  its own most frequent ones, Spark adds them up), at most ``hot`` of at most
  ``LONGEST`` characters, encoded once and broadcast: a table of bounded size.
* Tier 2: a cache in each Python worker, of at most ``cached`` entries; a
  pre-token found in neither tier is encoded.

No pre-token is shuffled by key but the tasks' short lists, and the tables
only save work: the counts do not depend on what they hold.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import documents, slices

HOT = 1 << 16
SENT_BY_TASK = 1 << 13
CACHED = 1 << 19
LONGEST = 48
SPACE = "▁"

_PRETOKEN = re.compile(" +[^ ]*")


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its first space."""
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return [x[1:] for x in _PRETOKEN.findall(" " + text)]


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The tokenizer; refused if a text's tokens are not the sum of its
    pre-tokens' (a piece with a space inside, or no piece for a space)."""
    out = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [out.id_to_piece(i) for i in range(out.get_piece_size())]
    probe = "  a  b c\n d "
    if (any(re.search(f"[^{SPACE}]{SPACE}", x) for x in pieces) or SPACE not in pieces
            or len(out.encode(probe)) != sum(len(out.encode(x)) if x else 1 for x in pretokens(probe))):
        raise ValueError(f"{path}: pre-tokens of this model are not independent")
    return out


class Lengths(dict):
    """Pre-token lengths: the broadcast ones, and a bounded cache of others."""

    def __init__(self, path: str, hot: dict[str, int], cached: int):
        super().__init__(hot)
        self.encode, self.hot, self.most = processor(path).encode, hot, len(hot) + cached
        self[""] = 1  # a space with nothing after it

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(self.hot)
                self[""] = 1
            self[piece] = n
        return n


def frequent_pretokens(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(piece, n): the most frequent short pre-tokens of all texts, summed over
    the tasks' own ``SENT_BY_TASK`` most frequent ones."""

    def top(batches):
        counts: Counter = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(pretokens(text or ""))
            if len(counts) > CACHED:
                counts = Counter(dict(counts.most_common(CACHED // 4)))
        found = [(x, n) for x, n in counts.most_common(SENT_BY_TASK) if len(x) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
            names=["piece", "n"])

    sent = docs.select("text").mapInArrow(top, "piece string, n long")
    return sent.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(hot)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", hot: int = HOT, cached: int = CACHED) -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``
    and ``over_limit`` (more than ``limit`` tokens).

    ``model``: a sentencepiece file, read by every worker. A null text is
    empty: no bytes, no tokens. A null id stays null; repeated rows give
    repeated rows; an empty table gives none; other columns are not looked at.
    """
    docs = documents(docs, id_col, text_col)
    spark = docs.sparkSession
    pieces = [r.piece for r in frequent_pretokens(docs, hot).collect() if r.piece]  # at most hot * LONGEST characters
    lengths = dict(zip(pieces, map(len, processor(model).encode(pieces)))) if pieces else {}
    table = spark.sparkContext.broadcast(lengths)

    def count(batches):
        of = Lengths(model, table.value, cached).__getitem__
        for batch in slices(batches):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            n = [sum(map(of, pretokens(x))) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x.encode()) for x in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
