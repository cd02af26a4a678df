"""Largest sums by bucket bounds against plain sums."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest

from ledgerloom.operators.topk import top_by_sum

SCHEMA = "k bigint, v decimal(12,2)"


def plain(values, k):
    sums, keys = Counter(), {}
    for key, value in values:
        keys.setdefault(key, []).append(value)
    for key, found in keys.items():
        known = [v for v in found if v is not None]
        sums[key] = sum(known) if known else None
    ordered = sorted(sums, key=lambda x: (sums[x] is None, -(sums[x] or 0), x is None, x or 0))
    return [(key, sums[key]) for key in ordered[:k]]


def draw(kind, seed):
    rng = random.Random(seed)
    pick = {
        "skewed": lambda: (int(rng.paretovariate(0.6)) % 5000, rng.randint(0, 500)),
        "uniform": lambda: (rng.randrange(3000), rng.randint(0, 500)),
        "ties": lambda: (rng.randrange(40), 1),
        "negative": lambda: (rng.randrange(300), rng.randint(-500, 100)),
        "missing": lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, None, 5, -5])),
    }[kind]
    rows = [pick() for _ in range(6000 if kind != "missing" else 20)]
    return [(key, None if value is None else Decimal(value)) for key, value in rows]


@pytest.mark.parametrize("kind", ["skewed", "uniform", "ties", "negative", "missing"])
def test_top_sums_equal_plain_sums(spark, kind):
    values = draw(kind, 3)
    df = spark.createDataFrame(values, SCHEMA)
    for k, buckets in ((5, 512), (3, 64)):
        found = top_by_sum(df, "k", "v", "total", k, buckets)
        assert [(r.k, r.total) for r in found.rows.collect()] == plain(values, k)
        assert found.buckets_summed <= found.buckets <= buckets


def test_skewed_keys_leave_most_buckets_closed(spark):
    values = [(key, Decimal(1000 - key if key < 10 else 1)) for key in range(4000)]
    found = top_by_sum(spark.createDataFrame(values, SCHEMA), "k", "v", "total", 5, 2048)
    assert [r.k for r in found.rows.collect()] == [0, 1, 2, 3, 4]
    assert found.buckets_summed <= 20 < found.buckets


def test_few_rows(spark):
    assert top_by_sum(spark.createDataFrame([], SCHEMA), "k", "v", "total", 5).rows.count() == 0
    only = top_by_sum(spark.createDataFrame([(1, None)], SCHEMA), "k", "v", "total", 5).rows.collect()
    assert [tuple(r) for r in only] == [(1, None)]
    with pytest.raises(ValueError):
        top_by_sum(spark.range(1), "id", "id", "total", 0)
