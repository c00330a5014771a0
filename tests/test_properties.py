"""Property tests (hypothesis) for the exact arithmetic pieces."""

import math
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from beatline.functions.numeric import percent_of_count
from beatline.operators.split import _quotas


def _largest_remainder(counts, frac):
    n = sum(counts)
    n_test = math.ceil(frac * n)
    base = [n_test * c // n for c in counts]
    rem = [n_test * c % n for c in counts]
    for i in sorted(range(len(counts)), key=lambda i: (-rem[i], i))[:n_test - sum(base)]:
        base[i] += 1
    return base


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=10**12), min_size=1, max_size=12),
       st.sampled_from([0.1, 0.2, 0.25, 1 / 3, 0.5]))
def test_quotas_match_largest_remainder(spark, counts, frac):
    df = spark.createDataFrame(list(enumerate(counts)), "label int, n_c long")
    got = {r.label: r.quota for r in _quotas(df, "label", frac).collect()}
    want = _largest_remainder(counts, frac)
    assert [got[i] for i in range(len(counts))] == want
    assert sum(want) == math.ceil(frac * sum(counts))
    assert all(0 <= q <= c for q, c in zip(want, counts))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 2 * 10**12)), min_size=1,
                max_size=30))
def test_percent_rounding_exact(spark, pairs):
    pairs = [(min(a, b), b) for a, b in pairs]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = [r.p for r in df.select(percent_of_count("n", "t", 2).alias("p")).collect()]
    for (n, t), p in zip(pairs, got):
        want = float(int(Fraction(n * 10000, t) + Fraction(1, 2))) / 100
        assert p == want


def test_pct_sums_to_100_and_funnel_shrinks(spark):
    from conftest import SF_MID
    from beatline.plans.catalog import QUERIES
    dist = QUERIES["type_distribution"](spark, SF_MID).collect()
    assert len(dist) == 20
    from beatline.operators.explore import type_distribution
    from beatline.sources.fixture import fixture_incidents
    full = type_distribution(fixture_incidents(spark, SF_MID), n=1000).collect()
    assert abs(sum(r.pct for r in full) - 100) < 0.01 * len(full)
    funnel = sorted(QUERIES["stage_funnel"](spark, SF_MID).collect(), key=lambda r: r.step)
    rows = [r.rows for r in funnel]
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0


def test_forest_is_deterministic(spark):
    from beatline.operators import models as M
    rows = [(i % 7, i % 11, (i % 7 + i % 11) % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, label int")
    preds = []
    for _ in range(2):
        m = M.fit_forest_classifier(df, ["a", "b"], "label", num_trees=5, max_depth=4,
                                    min_instances=1)
        preds.append([r.prediction for r in m.transform(M.assemble(df, ["a", "b"])).collect()])
    assert preds[0] == preds[1]
