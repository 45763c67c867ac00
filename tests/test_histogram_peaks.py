import numpy as np
import pytest

from strutwise.functions import kernels as K
from strutwise.operators import histogram as H


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_peaks_equal_the_kernel(spark, seed):
    rng = np.random.default_rng(seed)
    v = np.round(rng.uniform(0, 40, 120)) if seed else np.repeat([1.0, 3, 3, 2, 5, 5, 5, 1, 9, 0, 9, 4], 10)
    rows = spark.createDataFrame([(k, float(x)) for k, x in enumerate(v)], "k int, v double").repartition(3)
    for distance, prominence in ((1, 0.0), (5, 0.1), (9, 0.6)):
        got = sorted(r.k for r in H.peak_rows(rows, distance, prominence).collect())
        assert got == K.peaks(v, distance, max(1.0, prominence * v.max())).tolist()


def test_smoothing_equals_the_kernel(spark):
    c = np.random.default_rng(5).integers(0, 100, 40).astype(float)
    rows = spark.createDataFrame([(k, float(x)) for k, x in enumerate(c)], "k int, c double")
    got = [r.v for r in H.smoothed(rows, 40, 2.0).orderBy("k").collect()]
    assert np.allclose(got, K.gaussian(c, 2.0, reflect=True), atol=1e-8)
    with pytest.raises(ValueError):
        H.smoothed(rows, 8, 2.0)


def test_modes_of_two_humps_and_of_nothing(spark):
    bins = np.r_[np.random.default_rng(0).normal(15_000, 900, 4000), np.random.default_rng(1).normal(48_000, 900, 2000)].astype(int)
    hist = spark.createDataFrame([(int(b),) for b in bins], "bin int").groupBy("bin").count().withColumnRenamed("count", "c")
    modes = sorted(r["mode"] for r in H.intensity_modes(hist, coarse=128).collect())
    assert len(modes) == 2 and abs(modes[0] - 15_000) < 1000 and abs(modes[1] - 48_000) < 1000
    assert H.intensity_modes(hist.limit(0)).count() == 0
