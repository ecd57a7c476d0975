import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions.numeric import py_round

TIES = [0.00015, 0.00025, 0.00035, 0.03125, 0.12345, 0.00005, 0.99995, 0.5, -0.00015, -0.03125, 0.1 + 0.2, 0.0, 1.0]


def _rounded(spark, values, digits=4):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x double")
    return [r.r for r in df.select("i", py_round(F.col("x"), digits).alias("r")).orderBy("i").collect()]


def test_python_rounding_on_ties(spark):
    assert _rounded(spark, TIES) == [round(v, 4) for v in TIES]


@pytest.mark.parametrize("digits", [0, 2, 4, 6])
def test_python_rounding_random(spark, digits):
    rng = random.Random(digits)
    vals = [rng.random() for _ in range(3000)] + [round(rng.random(), digits + 1) for _ in range(3000)]
    assert _rounded(spark, vals, digits) == [round(v, digits) for v in vals]


@given(st.lists(st.floats(min_value=-3.0, max_value=3.0, allow_nan=False), min_size=1, max_size=40))
@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
def test_python_rounding_property(spark, vals):
    assert _rounded(spark, vals) == [round(v, 4) for v in vals]


def test_py_round_over_the_whole_range(spark):
    """Every digits from 0 to 6, from 1e-300 to 1e300, against Python."""
    import math
    import random

    rng = random.Random(7)
    values = [0.0, -0.0, 1e-25, 3e-22, -1e-7, 5e-7, 4.9999999e-7, 0.5, 1.5, 2.5, 2.0**40, 2.0**40 + 0.3, 2.0**52 - 0.5, 2.0**52, 1e300, -1e300, 1e-300]
    values += [rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randrange(-60, 70)) for _ in range(2000)]
    values += [rng.randrange(10**9) / 10**rng.randrange(9) + rng.choice([0, 5 / 10**rng.randrange(1, 8)]) for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in range(7):
        rows = df.select("i", py_round(F.col("v"), digits).alias("r")).collect()
        bad = [(values[r.i], r.r, round(values[r.i], digits)) for r in rows
               if r.r != round(values[r.i], digits) or math.copysign(1, r.r) != math.copysign(1, round(values[r.i], digits))]
        assert not bad, (digits, bad[:5])
