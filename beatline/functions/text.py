"""Keyword grouping of free-text descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Description keyword rules, tested in this order against the
# lower-cased text; the first substring that occurs names the group.
DESCRIPTION_RULES = [
    ("aggravated", "AGGRAVATED"),
    ("armed", "ARMED"),
    ("attempt", "ATTEMPT"),
    ("simple", "SIMPLE"),
    ("domestic", "DOMESTIC"),
    ("retail", "RETAIL"),
    ("financial", "FINANCIAL"),
    ("possess", "POSSESSION"),
    ("poss", "POSSESSION"),
    ("deliver", "DELIVERY"),
    ("vehicle", "VEHICLE"),
    ("damage", "DAMAGE"),
    ("forcible", "FORCIBLE"),
]
DESCRIPTION_DEFAULT = "OTHER"


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test (needle given in lower case)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(c).contains(needle.lower())


def keyword_group(c, rules: Sequence[tuple[str, str]] = DESCRIPTION_RULES,
                  default: str = DESCRIPTION_DEFAULT) -> Column:
    """First matching rule wins; no match (or null text) gives ``default``.

    Folds the rules into one CASE expression over the lower-cased text, as a
    lambda over a one-element array: a lambda stays out of the method generated
    for the whole stage. With the CASE inlined, a stage that also joins and adds
    the row features exceeds 8000 bytes, which HotSpot never compiles.
    """
    c = F.col(c) if isinstance(c, str) else c

    def group(text: Column) -> Column:
        expr = None
        for needle, name in rules:
            cond = text.contains(needle.lower())
            expr = F.when(cond, name) if expr is None else expr.when(cond, name)
        return expr.otherwise(default)

    return F.coalesce(F.get(F.transform(F.array(F.lower(c)), group), F.lit(0)), F.lit(default))


def group_names(rules: Sequence[tuple[str, str]] = DESCRIPTION_RULES,
                default: str = DESCRIPTION_DEFAULT) -> list[str]:
    """Distinct group names the rules can produce (the code table's bound)."""
    out: list[str] = []
    for _, g in rules:
        if g not in out:
            out.append(g)
    if default not in out:
        out.append(default)
    return out
