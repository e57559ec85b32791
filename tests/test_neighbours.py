"""Nearest rows against brute force, and SMOTE between them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from botlens.operators import learning
from botlens.operators.neighbours import nearest_rows

VALUES = ["x", "y", "z", "u"]


def by_hand(rows, k):
    out = {}
    for key, group, *at in rows:
        others = sorted((math.dist(at, there), other) for other, same, *there in rows if same == group and other != key)
        out[key] = [name for _, name in others[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "key string, g int, x double, y double, z double, u double")


def cloud():
    """Two dense places, a wide one, a value that a third of all rows share, outliers, groups of one and two."""
    draw = random.Random(4)
    rows = [[draw.gauss(0, 0.01) for _ in VALUES] for _ in range(120)] + [[draw.gauss(5, 1) for _ in VALUES] for _ in range(120)]
    rows += [[1.0, 2.0, 3.0, 4.0]] * 130 + [[draw.randrange(3) * 1.0 for _ in VALUES] for _ in range(40)] + [[500.0, -900.0, 0.0, 1.0]]
    named = [(f"k{i:04d}", i % 2, *r) for i, r in enumerate(rows)]
    return named + [("one", 7, 0.0, 0.0, 0.0, 0.0), ("two", 8, 0.0, 0.0, 0.0, 0.0), ("three", 8, 9.0, 0.0, 0.0, 0.0)]


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_rows_are_the_nearest(spark, k):
    rows = cloud()
    found = nearest_rows(table(spark, rows), "key", ["g"], VALUES, [F.col(v) for v in VALUES], k)
    got = {r.key: [n["key"] for n in r.nearest] for r in found.collect()}
    assert got == by_hand(rows, k)
    assert got["one"] == [] and got["two"] == ["three"]


def test_one_value_and_no_rows(spark):
    rows = [(f"k{i}", 0, 0.0, 0.0, float(i * i), 0.0) for i in range(30)]
    found = nearest_rows(table(spark, rows), "key", ["g"], ["z"], [F.col("z")], 2)
    got = {r.key: sorted(n["key"] for n in r.nearest) for r in found.collect()}
    assert got["k0"] == ["k1", "k2"] and got["k10"] == ["k11", "k9"] and got["k29"] == ["k27", "k28"]
    assert nearest_rows(table(spark, rows).where("false"), "key", ["g"], ["z"], [F.col("z")], 2).count() == 0


def test_synthetic_rows_lie_between_neighbours(spark):
    draw = random.Random(8)
    numeric, flags = learning._NUMERIC_FEATURES, learning.CELL_FEATURES
    rows = []
    for i in range(90):
        near = float(i // 30 * 100)
        rows.append((f"r{i}", 1, *[near + draw.random() for _ in numeric], *[float(i // 30 == 1)] * len(flags)))
    rows += [("alone", 1, *[3.0] * len(numeric), *[0.5] * len(flags)), ("other", 0, *[7.0] * len(numeric), *[0.0] * len(flags))]
    names = ", ".join(f"{n} double" for n in (*numeric, *flags))
    frame = spark.createDataFrame(rows, f"key string, label int, {names}")
    made = learning.interpolate_nearest(frame, "key", copies=3)
    got = {r.key: r for r in made.collect()}
    assert len(got) == 3 * 91 and not any(k.startswith("other") for k in got)
    assert all(got[f"alone|{n}"][numeric[0]] == 3.0 for n in (1, 2, 3))
    # Rows of the three places are not mixed, though two share their flags.
    assert all(any(low <= got[k][n] <= low + 1 for low in (0, 100, 200)) for k in got if k[0] == "r" for n in numeric)
    again = learning.interpolate_nearest(frame.repartition(5), "key", copies=3)
    assert made.exceptAll(again).count() == again.exceptAll(made).count() == 0
    assert learning.interpolate_nearest(frame.where("label = 0"), "key").count() == 0


def test_many_points_are_met_in_narrow_blocks(spark):
    """Thousands of points, some of them far out: the nearest ones, and few distances made on the way."""
    import numpy as np

    from botlens.operators import neighbours

    draw = np.random.default_rng(5)
    at = np.round(np.concatenate([draw.normal(0, 1, (5900, 4)), draw.normal(0, 60, (100, 4))]), 3)
    rows = [(f"k{i:05d}", 0, *map(float, r)) for i, r in enumerate(at)]
    frame = table(spark, rows)
    found = nearest_rows(frame, "key", ["g"], VALUES, [F.col(v) for v in VALUES], 2).collect()
    assert len(found) == len(rows)
    got = {r.key: [(n["distance"], n["key"]) for n in r.nearest] for r in found}
    apart = neighbours._apart(at, at)
    np.fill_diagonal(apart, np.inf)
    order = np.argsort(apart, axis=1, kind="stable")[:, :2]
    assert got == {rows[i][0]: [(apart[i, j], rows[j][0]) for j in order[i]] for i in range(len(rows))}
    points = neighbours._points(frame, "key", ["g"], VALUES, 3).orderBy(F.col("_keys")[0]).withColumn("_point", F.monotonically_increasing_id())
    blocks = neighbours._blocks(points.withColumn("_at", F.array(*VALUES)), ["g"], 4, 2).cache()
    visits = neighbours._visits(blocks, ["g"]).join(blocks.select("block", "ids"), "block")
    made = visits.agg(F.sum(F.size("from_ids") * F.size("ids"))).first()[0]
    blocks.unpersist()
    assert made < len(rows) ** 2 / 3
