"""Secret scans by a trigram inverted index, in DataFrame operations only.

From each rule's pattern a Boolean trigram query is derived: strings that every
match must contain, as clauses of alternatives, each an AND of trigrams. The
index holds postings (trigram, document) for the trigrams of the queries, of
lower-cased texts. Postings are intersected by alternative and clause, which
leaves candidates (document, rule); only those are verified with the pattern. A
rule without mandatory trigrams scans every document.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import pick
from beatline.session import materialize


class Rule(NamedTuple):
    kind: str
    #: A pattern that Java's and Python's regular expressions read alike.
    pattern: str
    #: Group ``group`` of a match has at least ``least`` characters.
    group: int = 0
    least: int = 0


#: Base rules (fixed values), in the order of the listing.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # runs are maximal, so the same as runs of 24 or more among all
]
#: Further rules, found in the same way.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z]{2,10}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/@]{3,128}@[A-Za-z0-9.-]+"),
    Rule("bearer", r"(?i:authorization)[\"']?\x20*[:=]\x20*[\"']?(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}"),
]
RULES = BASE + MORE

MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses, all of which must hold; a clause is a list of alternatives, one
    of which must hold; an alternative is a set of trigrams, all of which must
    occur. Trigrams are lower-case; an empty list says that nothing is known."""
    clauses: list[list[frozenset[str]]] = []

    def close(known: set[str]) -> set[str]:
        """What a finished stretch of known strings demands."""
        if known and all(len(s) >= 3 for s in known):
            clauses.append([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(known)])
        return {""}

    def strings(items) -> set[str] | None:
        """All strings that the items match, if few."""
        out = {""}
        for op, arg in items:
            more = one(op, arg)
            if more is None or len(out) * len(more) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in more}
        return out

    def one(op, arg) -> set[str] | None:
        name = str(op)
        if name == "LITERAL":
            return {chr(arg).lower()}
        if name == "IN":
            chars: set[str] = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    chars.add(chr(value).lower())
                elif str(kind) == "RANGE" and value[1] - value[0] < 8:
                    chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return chars if len(chars) <= 8 else None
        if name == "SUBPATTERN":
            return strings(arg[-1])
        if name == "BRANCH":
            parts = [strings(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if name == "MAX_REPEAT" and arg[1] <= 2:
            inner = strings(arg[2])
            return None if inner is None else {
                a + b for n in range(arg[0], arg[1] + 1) for a in ({""} if n < 1 else inner) for b in ({""} if n < 2 else inner)}
        return None

    def walk(items, known: set[str]) -> set[str]:
        for op, arg in items:
            more = one(op, arg)
            if more is not None and len(known) * len(more) <= MOST_STRINGS:
                known = {a + b for a in known for b in more}
                continue
            known = close(known)
            if more is not None:
                known = more
            elif str(op) == "SUBPATTERN":
                known = walk(arg[-1], known)
            elif str(op) == "MAX_REPEAT" and arg[0] >= 1:
                known = close(walk(arg[2], known))
        return known

    close(walk(re._parser.parse(pattern), {""}))
    return clauses


def spans_of(text: Column, rule: Rule) -> Column:
    """(start, end) of the rule's matches, in code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.zip_with(F.zip_with(gaps, whole, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("n"))),
                       tested, lambda x, t: F.struct(x["gap"].alias("gap"), x["n"].alias("n"), F.length(t).alias("tested")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    found = F.aggregate(parts, start, lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + F.coalesce(x["n"], F.lit(0))).alias("at"),
        F.when(x["tested"] >= rule.least, F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["n"]).alias("end")))))
        .otherwise(acc["spans"]).alias("spans")))
    return found["spans"]


def candidates(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, rules): for each key, the indexes of the rules whose trigram
    queries its text fulfils. ``texts`` has ``key`` and ``text``."""
    rows, needed = [], []
    for r, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        needed += [(r, (1 << len(clauses)) - 1)] if clauses else []
        for c, clause in enumerate(clauses):
            for a, alt in enumerate(clause):
                rows += [(r, 1 << c, a, t, 1 << bit, (1 << len(alt)) - 1) for bit, t in enumerate(sorted(alt))]
    asked = sorted({r[3] for r in rows})
    spark = texts.sparkSession
    query = spark.createDataFrame(rows, "rule int, clause long, alt int, trigram string, bit long, full long")  # fixed by the rules
    needed = spark.createDataFrame(needed, "rule int, whole long")

    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # A one-element transform evaluates the lower-cased text once, not for each trigram.
    held = F.transform(F.array(low), lambda x: F.filter(F.array(*map(F.lit, asked)), lambda t: F.contains(x, t)))[0]
    postings = texts.select("key", F.explode(held).alias("trigram"))
    # Sets of trigrams and of clauses are bits: an OR adds them up, repeats included.
    alternatives = postings.join(F.broadcast(query), "trigram").groupBy("key", "rule", "clause", "alt", "full") \
        .agg(F.bit_or("bit").alias("got")).filter("got = full")
    return alternatives.groupBy("key", "rule").agg(F.bit_or("clause").alias("got")) \
        .join(F.broadcast(needed), "rule").filter("got = whole") \
        .groupBy("key").agg(F.collect_set("rule").alias("rules"))


#: Bits to a candidate in the bitmap of their keys, and its greatest size: so many
#: buckets of 4 KB (64 MB).
BITS_A_KEY = 16
MOST_BUCKETS = 1 << 14
_BUCKET_BITS = 1 << 15  # of Spark's bitmap functions


def with_rules(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the column ``rules`` of ``found`` by ``key``, null for others.

    Rows stay where they are unless a bitmap of the found keys, broadcast with a
    bounded size, holds their key; only those, the candidates and some by chance, are
    shuffled to meet ``found``. Beyond the bitmap's greatest size more rows move by
    chance, none is lost.
    """
    found = materialize(found, "secret-candidates")
    buckets = min(MOST_BUCKETS, found.count() * BITS_A_KEY // _BUCKET_BITS + 1)
    place = F.pmod("key", F.lit(buckets * _BUCKET_BITS)) + 1  # Spark counts bits from 1
    bits = found.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.call_function("div", at, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    tested = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("bucket"), "left") \
        .withColumn("held", held).drop("bucket", "bits")
    meet = tested.filter("held").join(found.hint("shuffle_hash"), "key", "left")
    return meet.drop("held").unionByName(
        tested.filter("not held").drop("held").withColumn("rules", F.lit(None).cast("array<int>")))


def named(no: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("rule"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def of_rule(no: int):
    return lambda s: s["rule"] == no


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each input row: ``doc_id``, ``found`` (an array of (start,
    rule, end, kind), by start, then rule), and the ``keep`` columns.

    Offsets are code points. A null text is empty. Rows with a null or repeated
    id each get their own row. Candidates are found by a digest of id and text:
    equal digests only add rules to verify. An empty table gives no rows.
    """
    own = {f"keep_{i}": (c, dict(docs.dtypes)[c]) for i, c in enumerate(keep) if c != text_col}
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), **own).withColumn("key", F.xxhash64("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    found = candidates(rows.select("key", text.alias("text")), rules)
    joined = with_rules(rows, found)
    parts = []
    for no, rule in enumerate(rules):
        spans = F.transform(spans_of(text, rule), named(no, rule.kind))
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("rules", no), spans)
        parts.append(F.coalesce(spans, F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")))
    kept = [*own, *["text"] * (text_col in keep)]
    out = joined.select("doc_id", *kept, F.array_sort(F.concat(*parts)).alias("found"))
    return out.withColumnsRenamed({c: name for c, (name, _) in own.items()} | {"text": text_col})


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that
    overlap are replaced as one, by the kind of the first."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(found, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))).alias("out")))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def listing(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """``find_secrets`` as a digest: ``doc_id``, ``n_assign``, ``n_access``,
    ``n_hex``, ``base_sha256`` (of the base spans) and ``spans`` (all)."""
    out = find_secrets(docs, **options)
    base = F.filter("found", lambda s: s["rule"] < len(BASE))
    counts = [F.size(F.filter("found", of_rule(no))).cast("long").alias(f"n_{rule.kind}")
              for no, rule in enumerate(BASE)]
    return out.select("doc_id", *counts, F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("found")).alias("spans"))
