"""Exact quantiles against numpy on columns that are hard for sketches and for equal widths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators.quantiles import exact_quantiles, inside_fences

PROBABILITIES = [0.0, 0.001, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("few, accuracy", [(10, 20), (100, 1000), (100_000, 10_000)])
def test_equal_to_numpy(spark, few, accuracy):
    rng = np.random.default_rng(3)
    n = 4_000
    columns = {
        "plain": rng.permutation(np.linspace(-5, 9, n)),          # no value twice
        "wide": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n),
        "ties": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 30, n).astype(float)),
        "two": rng.choice([1.0, 2.0], n),
        "one": np.full(n, 4.0),
    }
    frame = spark.createDataFrame([tuple(float(v[i]) for v in columns.values()) for i in range(n)], [f"{c} x" for c in columns])
    got = exact_quantiles(frame.repartition(5), frame.columns, PROBABILITIES, few, accuracy)
    for name, values in columns.items():
        assert got[f"{name} x"] == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12)


def test_missing_values_and_infinities(spark):
    frame = spark.createDataFrame([(None, None), (float("nan"), None), (float("-inf"), None), (3.0, None), (1.0, None)], "a double, b double")
    got = exact_quantiles(frame, ["a", "b"], [0.0, 0.5, 1.0], few=0, accuracy=10)
    assert got == {"a": [float("-inf"), 1.0, 3.0], "b": [None, None, None]}
    assert exact_quantiles(frame.where("false"), ["a"], [0.5]) == {"a": [None]}
    assert inside_fences(frame, ["b"]).count() == 0


def test_no_task_gathers_the_values(spark):
    frame = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    inside = [r.x for r in inside_fences(frame, ["x"], 0.1, few=10).collect()]
    low, high = 249.75 - 49.95, 749.25 + 49.95
    assert sorted(inside) == [float(i) for i in range(1000) if low <= i <= high]
