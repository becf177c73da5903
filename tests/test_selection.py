import numpy as np
import pytest
from pyspark.sql import functions as F

from lumiflux.operators import selection

ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, np.nextafter(1, 0), np.nextafter(1, 2), -1.0, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 2.0**52, 0.1, 1e-300, 3.0]


def test_bits_are_in_the_order_of_doubles(spark):
    rng = np.random.default_rng(0)
    values = ODD + [float(v) for e in range(-320, 309, 7) for v in rng.uniform(-1, 1, 4) * 10.0**e] + [float(np.nextafter(2.0**e, 0)) for e in range(-1000, 1024, 13)]
    rows = selection.with_bits(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", "b").collect()
    unsigned = [r.b % 2**64 for r in rows]
    order = np.argsort(np.array(unsigned, dtype=np.uint64), kind="stable")
    assert (np.diff(np.array(values)[order]) >= 0)[np.isfinite(np.diff(np.array(values)[order]))].all()
    assert len(set(unsigned)) == len(set(values))  # zeros are one


@pytest.mark.parametrize("few", [True, False])
def test_quantiles_are_numpys(spark, few):
    rng = np.random.default_rng(1)
    groups = {1: rng.normal(size=501), 2: np.repeat([3.0, 3.0, -2.0], 40), 3: np.array([7.5]), 4: np.array(ODD[:12]), 5: rng.integers(-5, 5, 400).astype(float), 6: rng.normal(size=300) * 10.0 ** rng.integers(-300, 300, 300), 7: np.array([1.0, 2.0]), 8: np.array([np.nan, 4.0, 6.0])}
    rows = [(g, float(v), "clash") for g, vs in groups.items() for v in vs] + [(1, None, ""), (9, None, ""), (9, float("nan"), "")]
    p = (0.01, 0.5, 0.25, 1.0, 0.0, 0.99)
    df = spark.createDataFrame(rows, "g int, v double, bin string").repartition(4)
    got = {r.g: r.quantiles for r in selection.quantiles(df, "v", p, ("g",), few).collect()}
    assert set(got) == set(range(1, 9))
    for g, vs in groups.items():
        want = np.quantile(vs[~np.isnan(vs)], p)
        assert np.allclose(got[g], want, rtol=1e-12, atol=0), g
    whole = selection.quantiles(df, "v", p).collect()
    every = np.concatenate(list(groups.values()))
    assert np.allclose(whole[0].quantiles, np.quantile(every[~np.isnan(every)], p), rtol=1e-12)
    assert selection.quantiles(df.where("g = 9"), "v", p).count() == 0


def test_medians_keep_missing_values(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0), (0, 1, float("nan")), (0, 1, 2.0), (1, 0, None)], "y int, x int, v double")
    got = {(r.y, r.x): r.v for r in selection.medians(df).collect()}
    assert got[0, 0] == 2 and np.isnan(got[0, 1]) and got[1, 0] is None
