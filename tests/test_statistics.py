import math

import numpy as np
import pytest

from refrain.operators import statistics


def summarised(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    return {r.g: r for r in statistics.seven_statistics(df, ["g"], "x").collect()}


def test_golden_values(spark):
    rows = [("a", x) for x in (1.0, 2.0, 4.0, 9.0)] + [("b", 5.0), ("b", 5.0), ("c", 7.0), ("d", None)]
    found = summarised(spark, rows)
    a = found["a"]
    assert (a["mean"], a["median"], a["min"], a["max"]) == (4.0, 3.0, 1.0, 9.0)
    assert a["std"] == pytest.approx(3.082207, abs=1e-6)
    assert a["skew"] == pytest.approx(0.768417, abs=1e-6)
    assert a["kurtosis"] == pytest.approx(-1.0)
    assert (found["b"]["std"], found["b"]["skew"], found["b"]["kurtosis"]) == (0.0, None, None)
    assert found["c"]["median"] == 7.0
    assert all(math.isnan(found["d"][s]) for s in statistics.STATISTICS)


def test_one_nan_makes_all_seven_nan(spark):
    rows = [("a", x) for x in (0.0, 1.0, 2.0, 3.0, float("nan"), None)] + [("b", 1.0), ("b", None)]
    found = summarised(spark, rows)
    assert all(math.isnan(found["a"][s]) for s in statistics.STATISTICS)
    assert (found["b"]["median"], found["b"]["min"]) == (1.0, 1.0)


def test_values_that_crowd_round_the_median(spark):
    rng = np.random.default_rng(5)
    crowd = np.concatenate([rng.normal(size=4000) * 1e-9, [-1e12] * 3000, [1e12] * 3001])
    found = summarised(spark, [("a", float(x)) for x in crowd])
    assert found["a"]["median"] == pytest.approx(np.median(crowd), rel=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_medians_of_small_and_large_groups(spark, seed):
    rng = np.random.default_rng(seed)
    shapes = {
        "normal": rng.normal(size=20_011),
        "heavy": rng.standard_cauchy(12_000),
        "ties": rng.integers(0, 3, size=15_000).astype(float),
        "halves": np.repeat([0.0, 1.0], 6_000),
        "even": rng.random(5000),
        "odd": rng.random(5001),
        **{f"tiny {n}": rng.random(n) for n in range(1, 12)},
    }
    rows = [(g, float(x)) for g, xs in shapes.items() for x in xs]
    rng.shuffle(rows)
    found = summarised(spark, [(g, float(x)) for g, x in rows])
    for g, xs in shapes.items():
        assert found[g]["median"] == pytest.approx(np.median(xs), rel=1e-12, abs=1e-15), g


def test_feature_vector_order_and_gaps(spark):
    stats = [("e", f, c, *[100.0 * i + 10 * c + s for s in range(7)]) for i, f in enumerate(("mfcc", "zcr")) for c in (1, 2)]
    columns = ", ".join(f"{s} double" for s in statistics.STATISTICS)
    df = spark.createDataFrame(stats, f"entity string, feature string, channel int, {columns}")
    sizes = {"zcr": 1, "mfcc": 2, "chroma_stft": 1}
    row = statistics.feature_vector(df, "entity", features=sizes).first()
    assert len(row.features) == statistics.vector_size(sizes) == 28
    assert all(math.isnan(x) for x in row.features[:7])
    assert row.features[7:11] == [10.0, 20.0, 11.0, 21.0]
    assert row.features[21:] == [110.0 + s for s in range(7)]


def test_audio_vector_has_245_places():
    assert statistics.vector_size(statistics.AUDIO_FEATURES) == 245
