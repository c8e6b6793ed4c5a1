"""Dyadic value summaries: order, width, merging, quantiles within their promise."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import summaries as S


def values(n, seed):
    rng = random.Random(seed)
    found = [rng.choice([-1, 1]) * math.ldexp(rng.random() + 1, rng.randint(-40, 60)) for _ in range(n)]
    found += [s * math.ldexp(1.0, e) for e in range(-320, 1023, 7) for s in (-1, 1)]
    found += [math.nextafter(math.ldexp(1.0, e), d) for e in range(-60, 60) for d in (-math.inf, math.inf)]
    return [*found, 0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.7976931348623157e308]


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_cells_keep_order_and_are_narrow(spark, bits):
    xs = sorted(values(500, bits))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    cell = S.value_cell(F.col("x"), bits)
    rows = df.select("i", "x", cell.alias("c"), S.cell_edge(cell, bits).alias("edge")).orderBy("i").collect()
    assert all(a["c"] <= b["c"] for a, b in zip(rows, rows[1:], strict=False))
    for r in rows:
        if math.isinf(r["x"]) or abs(r["x"]) < 2.0**-300:
            assert r["edge"] == (r["x"] if math.isinf(r["x"]) else 0.0)
        else:
            assert 0 <= (abs(r["x"]) - abs(r["edge"])) <= abs(r["x"]) * 2.0**-bits and r["x"] * r["edge"] > 0
    odd = spark.createDataFrame([(float("nan"),), (math.inf,), (None,)], "x double").select(S.value_cell(F.col("x"), bits)).collect()
    assert odd[0][0] > odd[1][0] and odd[2][0] is None


def test_summaries_add_up_and_hold_quantiles(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.gauss(50, 20) if rng.random() < 0.95 else None, float(rng.randint(0, 3))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    whole = F.array(F.struct(F.lit("").alias("slice_key"), F.lit("").alias("slice_value")), F.struct(F.lit("g").alias("slice_key"), F.col("g").alias("slice_value")))
    made = lambda part: S.value_summary(part.withColumn("k", F.lit(1)), ["k"], whole, ["g"], ["x", "y"])
    one, two = made(df), S.merged(made(df.where("x < 50")), made(df.where("x >= 50 OR x IS NULL")))
    assert one.exceptAll(two.select(*one.columns)).count() == 0 and one.count() == two.count()
    shares = {"low": 0.1, "half": 0.5, "high": 1.0}
    for r in S.quantiles(two, shares).collect():
        own = sorted(v for g, x, y in rows for v in [x if r["column_name"] == "x" else y] if v is not None and r["slice_value"] in ("", g))
        assert r["n"] == len(own)
        for name, share in shares.items():
            want = own[math.ceil(share * len(own)) - 1]
            assert abs(want - r[name]) <= abs(want) / 256 and abs(r[name]) <= abs(want)
