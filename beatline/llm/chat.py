"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is cut into lines. The hidden state of a line is (role, begins a
turn or goes on with one); what is seen of it is its speaker marker, whether it
starts a row, whether it ends with a question mark, and its length. Start,
transition and emission counts come from all rows whose role is known, with
the markers of some turns hidden, so that unmarked turns are learned too. The
most likely states are found by Viterbi and turns are rendered canonically.

Conversations may be long: rows are dealt to segments of ``SEGMENT`` turns.
Viterbi is associative in (max, +), so each segment is reduced to the 6 x 6
matrix of its best scores, a conversation's few matrices are chained, and each
segment is then traced back from its own known end.
"""

from __future__ import annotations

import re
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.llm.common import pick

ROLES = ("system", "user", "assistant")
#: Speaker names, by role (lower case).
NAMES = {
    "system": ("system", "instruction", "instructions", "developer"),
    "user": ("user", "human", "customer", "question", "q", "prompter"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model", "gpt"),
}
ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
STATES = [(r, b) for r in range(len(ROLES)) for b in (True, False)]
N = len(STATES)
SEGMENT = 256
#: Share of turns whose markers are hidden in training.
HIDDEN = 0.3
_LENGTHS = (0, 40, 120, 400)
#: Values of each feature: marker, starts a row, question, length.
SIZES = (len(ROLES) + 1, 2, 2, len(_LENGTHS) + 1)
_MARKER = re.compile(
    r"\s*(?:<\|(?P<a>[a-z]{1,12})\|>|\[(?P<b>[a-z]{1,12})\]|(?:\*\*|#{1,4}\s+)?(?P<c>[a-z]{1,12})(?:\*\*)?\s*:(?:\*\*)?)\s*", re.I)
_END = re.compile(r"<\|(?:end|im_end|eot)\|>\s*$")


def cut_marker(line: str) -> tuple[int, str]:
    """(role number + 1 or 0, the line without its marker)."""
    m = _MARKER.match(line)
    role = ROLE_OF.get((m["a"] or m["b"] or m["c"]).lower()) if m else None
    return (ROLES.index(role) + 1, line[m.end():]) if role else (0, line)


def lines_of(text: str | None, role: str | None) -> tuple[list[str], np.ndarray]:
    """The lines of a row without markers, and their features. The row's own
    role, where it names one, marks its first line."""
    lines, seen = [], []
    for i, line in enumerate((text or "").split("\n")):
        marker, line = cut_marker(line)
        line = _END.sub("", line)
        if i == 0 and not marker and (known := ROLE_OF.get((role or "").strip().lower())):
            marker = ROLES.index(known) + 1
        lines.append(line)
        seen.append((marker, int(i == 0), int(line.rstrip().endswith("?")), int(np.searchsorted(_LENGTHS, len(line)))))
    return lines, np.array(seen)


class Model:
    """Log probabilities; ``emit[f][state, value]`` for each feature."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        logs = lambda counts: np.log((counts + 1) / (counts + 1).sum(-1, keepdims=True))
        self.start, self.move, self.emit = logs(start), logs(move), [logs(e) for e in emit]
        for s, (role, _) in enumerate(STATES):
            for t, (other, begins) in enumerate(STATES):
                if not begins and role != other:
                    self.move[s, t] = -np.inf  # a line goes on with its own turn only
        self.start[[s for s, (_, begins) in enumerate(STATES) if not begins]] = -np.inf

    def scores(self, seen: np.ndarray) -> np.ndarray:
        """Emission scores (lines, states). A row begins a turn."""
        out = sum(e[:, seen[:, f]].T for f, e in enumerate(self.emit))
        inside = np.array([not begins for _, begins in STATES])
        out[np.ix_(seen[:, 1] == 1, inside)] = -np.inf
        return out

    def matrix(self, seen: np.ndarray) -> np.ndarray:
        """Best score from a state before the lines to a state at their end."""
        best = None
        for row in self.scores(seen):
            step = self.move + row
            best = step if best is None else (best[:, :, None] + step[None]).max(1)
        return best

    def path(self, seen: np.ndarray, before: int | None, end: int | None = None) -> list[int]:
        """The best states of the lines, after the state ``before`` (None: at
        the start) and, if given, ending in ``end``. Of ties, the first."""
        rows = self.scores(seen)
        best, back = (self.start if before is None else self.move[before]) + rows[0], []
        for row in rows[1:]:
            options = best[:, None] + self.move
            back.append(options.argmax(0))
            best = options.max(0) + row
        state = int(best.argmax()) if end is None else end
        out = [state]
        for step in reversed(back):
            out.append(state := int(step[state]))
        return out[::-1]


def _rows(chats: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = pick(chats, conv_id=(id_col, "string"), turn=(turn_col, "long"), role=(role_col, "string"), text=(text_col, "string"))
    return rows.withColumn("segment", F.floor(F.coalesce("turn", F.lit(0)) / SEGMENT))


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}
_ROW = ("conv_id", "segment", "turn", "role", "text")


def _by_group(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], run, schema: str) -> DataFrame:
    """Deal the rows out by ``keys``, sort them by ``keys`` and ``order``, and
    call ``run(rows of a group) -> rows out`` for each group: one call a task,
    not one a group. Columns are handed over as they stand."""
    types = [_ARROW[x.split()[1]] for x in schema.split(", ")]
    names = [x.split()[0] for x in schema.split(", ")]
    n = len(keys)

    def go(batches):
        out = []
        stream = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for _, group in groupby(stream, itemgetter(*range(n))):
            out += run(list(group))
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(go, schema)


def fit(chats: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
        text_col: str = "text", hidden: float = HIDDEN) -> Model:
    """Count starts, moves and emissions over all rows of known role. Only
    counts by (state, value) reach the driver."""
    rows = _rows(chats, id_col, turn_col, role_col, text_col)

    def count(group):
        start, move = np.zeros(N, np.int64), np.zeros((N, N), np.int64)
        emit = [np.zeros((N, n), np.int64) for n in SIZES]
        first = last = -1
        for no, (_, _, turn, name, text) in enumerate(group):
            role = ROLE_OF.get((name or "").strip().lower())
            if role is None:
                last = -1
                continue
            _, seen = lines_of(text, name)
            # Hidden by a rule of the row alone, the same in every run.
            if (turn or 0) * 7919 + len(text or "") * 104729 & 1023 < hidden * 1024:
                seen[0, 0] = 0
            states = [2 * ROLES.index(role) + (i > 0) for i in range(len(seen))]
            if no == 0:
                first = states[0]
            if last >= 0:
                move[last, states[0]] += 1
            np.add.at(move, (states[:-1], states[1:]), 1)
            for f, e in enumerate(emit):
                np.add.at(e, (states, seen[:, f]), 1)
            last = states[-1]
        conv, segment = group[0][:2]
        found = [("move", s, t, int(move[s, t]), conv, segment) for s, t in zip(*np.nonzero(move))]
        found += [(f"emit{f}", s, v, int(e[s, v]), conv, segment) for f, e in enumerate(emit) for s, v in zip(*np.nonzero(e))]
        return [*found, ("edge", first, last, 1, conv, segment)]

    counted = _by_group(rows.select(*_ROW), ("conv_id", "segment"), ("turn", "role", "text"), count,
                        "what string, a int, b int, n long, conv_id string, segment long")
    by_conversation = Window.partitionBy("conv_id").orderBy("segment")  # a row for each segment
    edges = counted.filter("what = 'edge'").withColumn("last", F.lag("b").over(by_conversation)) \
        .filter("a >= 0").select(F.when(F.col("last").isNull(), "start").when(F.col("last") >= 0, "move").alias("what"),
                                 F.coalesce("last", F.lit(0)).alias("a"), F.col("a").alias("b"), F.lit(1).cast("long").alias("n"))
    totals = counted.filter("what <> 'edge'").select("what", "a", "b", "n").unionByName(edges.filter("what is not null")) \
        .groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()  # at most some 150 rows
    start, move, emit = np.zeros(N), np.zeros((N, N)), [np.zeros((N, n)) for n in SIZES]
    for r in totals:
        if r.what == "start":
            start[r.b] += r.n
        else:
            (move if r.what == "move" else emit[int(r.what[4:])])[r.a, r.b] += r.n
    return Model(start, move, emit)


def format_chats(chats: DataFrame, model: Model, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", trust_roles: bool = True) -> DataFrame:
    """One row for each turn found: ``conv_id``, ``turn`` and ``part`` (the
    row's turn, and which of the turns found in it), ``marked`` (the role its
    marker names, or null), ``role`` (recovered), ``text``, ``rendered``
    (``<|role|>``, the text, ``<|end|>``) and ``given`` (the role that the row itself
    names, or null).

    A row's role marks its first line; without ``trust_roles`` the decoder does
    not see it and goes by the text alone.

    Rows of a conversation are ordered by turn, then role and text; repeated
    rows are turns of their own; a null turn comes first. A null text is an
    empty turn; rows of a null id make up one conversation. A role that names
    no known speaker is no marker. An empty table gives no rows.
    """
    rows = _rows(chats, id_col, turn_col, role_col, text_col)

    def cut_row(name, text):
        return lines_of(text, name if trust_roles else None)

    def reduce(group):
        seen = np.concatenate([cut_row(name, text)[1] for _, _, _, name, text in group])
        rest = model.matrix(seen[1:]).ravel().tolist() if len(seen) > 1 else None
        opening = (model.start + model.scores(seen[:1])[0]).tolist()
        return [(*group[0][:2], model.matrix(seen).ravel().tolist(), opening, rest)]

    reduced = _by_group(rows.select(*_ROW), ("conv_id", "segment"), ("turn", "role", "text"), reduce,
                        "conv_id string, segment long, best array<double>, opening array<double>, rest array<double>")

    def chain(group):
        """The state before and at the end of each segment."""
        at, back = None, []
        for _, _, best, opening, rest in group:
            if at is None:
                at = np.array(opening)
                if rest is not None:
                    at = (at[:, None] + np.array(rest).reshape(N, N)).max(0)
            else:
                options = at[:, None] + np.array(best).reshape(N, N)
                back.append(options.argmax(0))
                at = options.max(0)
        end = [int(at.argmax())]
        for step in reversed(back):
            end.append(int(step[end[-1]]))
        end = end[::-1]
        return [(r[0], r[1], b, e) for r, b, e in zip(group, [-1, *end[:-1]], end)]

    ends = _by_group(reduced, ("conv_id",), ("segment",), chain, "conv_id string, segment long, before int, end int")
    joined = rows.join(ends, rows.conv_id.eqNullSafe(ends.conv_id) & (rows.segment == ends.segment)) \
        .select(*[rows[c] for c in _ROW], "before", "end")

    def render(group):
        cut = [cut_row(r[3], r[4]) for r in group]
        before, end = group[0][5:]
        states = model.path(np.concatenate([s for _, s in cut]), None if before < 0 else before, end)
        out, at = [], 0
        for (conv, _, turn, name, *_), (lines, seen) in zip(group, cut):
            turns, given = [], ROLE_OF.get((name or "").strip().lower())
            for line, features, state in zip(lines, seen, states[at:at + len(lines)]):
                role, begins = STATES[state]
                if begins or not turns:
                    turns.append((ROLES[role], ROLES[features[0] - 1] if features[0] else None, []))
                turns[-1][2].append(line)
            at += len(lines)
            for part, (role, marked, text) in enumerate(turns):
                text = "\n".join(text).strip()
                out.append((conv, turn, part, marked, role, text, f"<|{role}|>\n{text}\n<|end|>", given))
        return out

    return _by_group(joined, ("conv_id", "segment"), ("turn", "role", "text"), render,
                     "conv_id string, turn long, part int, marked string, role string, text string, rendered string, given string") \
        .withColumn("conv_id", F.col("conv_id").cast("long"))
