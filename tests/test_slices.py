"""Slices by located ranges against Python sorting, and what is sorted for them."""

import random

import pytest
from pyspark.sql import functions as F

from lakesmith.operators import planning


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))


@pytest.mark.parametrize("kind", ["spread", "hot", "nulls"])
def test_slices_against_sorting(spark, kind):
    rng = random.Random(kind)
    key = {"spread": lambda: rng.randrange(10_000), "hot": lambda: rng.choice([5] * 9 + [rng.randrange(9)]), "nulls": lambda: rng.choice([None, rng.randrange(50)])}[kind]
    rows = [(key(), i) for i in range(1500)]
    df, expect = spark.createDataFrame(rows, "k int, i int").repartition(5), _sorted(rows)
    for start, count in ((0, 5), (731, 5), (1498, 10), (1500, 5), (3000, 1), (10, 900), (0, None), (740, None), (1600, None), (4, 0)):
        got = planning.batch_slice(df, ["k", "i"], start, count)
        assert _sorted([tuple(r) for r in got.collect()]) == (expect[start:] if count is None else expect[start:start + count]), (start, count)


def test_other_orders(spark):
    rows = [(float("nan") if i % 7 == 0 else i / 3, f"t{i:03}") for i in range(100)]
    df = spark.createDataFrame(rows, "d double, t string")
    text = planning.batch_slice(df, ["t"], 10, 3).collect()
    assert {r.t for r in text} == {"t010", "t011", "t012"}
    down = planning.batch_slice(df, [F.col("t").desc()], 0, 2).collect()
    assert {r.t for r in down} == {"t099", "t098"}
    last = planning.batch_slice(df, ["d", "t"], 98, 5).collect()           # NaN is the largest
    assert {r.t for r in last} == {"t091", "t098"}
    assert planning.batch_slice(df.limit(0), ["d"], 0, 5).count() == 0


def test_only_the_rows_about_a_slice_are_sorted(spark, monkeypatch):
    seen = []
    positions = planning.with_position
    monkeypatch.setattr(planning, "with_position", lambda df, order: (seen.append(df.count()), positions(df, order))[1])
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("k"))
    assert sorted(r.k for r in planning.batch_slice(df, ["k"], 31_000, 5).collect()) == list(range(31_000, 31_005))
    assert planning.batch_slice(df, ["k"], 31_000).count() == 19_000
    assert len(seen) == 2 and max(seen) <= 3 * 50_000 // planning.EDGES
