import numpy as np
import pytest

from refrain.operators import frames


@pytest.mark.parametrize("centered", [False, True])
@pytest.mark.parametrize("frame, hop, chunk", [(8, 4, 16), (8, 3, 5), (6, 6, 6), (4, 8, 64)])
def test_sign_change_rate(spark, frame, hop, chunk, centered):
    rng = np.random.default_rng(frame * hop)
    series = {"long": rng.normal(size=203), "short": rng.normal(size=frame), "too short": rng.normal(size=frame - 1)}
    rows = [(e, i, float(x)) for e, xs in series.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "e string, pos int, x double").repartition(5)
    found = {(r.e, r.frame): r.rate for r in frames.sign_change_rate(df, "e", "pos", "x", frame, hop, chunk, centered).collect()}
    expected = {}
    for e, xs in series.items():
        if centered:
            xs = np.pad(xs, frame // 2, mode="edge")
        changed = np.concatenate([[0], (xs[1:] < 0) != (xs[:-1] < 0)]).astype(float)
        for f in range((len(xs) - frame) // hop + 1 if len(xs) >= frame else 0):
            expected[e, f] = changed[f * hop + 1 : f * hop + frame].sum() / frame
    assert found.keys() == expected.keys()
    assert all(found[key] == pytest.approx(expected[key]) for key in expected)


def test_spectrum_of_one_frame(spark):
    rows = [("a", 0, b, 100.0 * b, m) for b, m in enumerate([0.0, 1.0, 3.0, 0.0])] + [("a", 1, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "e string, f int, bin int, freq double, m double")
    centroid = {r.f: r.centroid for r in frames.spectral_centroid(df, "e", "f", "freq", "m").collect()}
    assert centroid == {0: pytest.approx(175.0), 1: None}
    rolloff = {r.f: r.rolloff for r in frames.spectral_rolloff(df, "e", "f", "freq", "m", 0.25).collect()}
    assert rolloff == {0: 100.0, 1: 0.0}
    long = spark.createDataFrame([(1, 0, 1.0), (2, 0, 0.5), (2, 1, 2.0)], "bin int, band int, w double")
    weights = frames.band_weights(long, 2, "bin", "band", "w")
    energy = {(r.f, r.band): r.energy for r in frames.band_energy(df, weights, 2, "e", "f", "bin", "m").collect()}
    assert energy == {(0, 0): pytest.approx(1.0 + 0.5 * 9.0), (0, 1): pytest.approx(18.0), (1, 0): 0.0, (1, 1): 0.0}


def test_projection_of_levels_keeps_signs_and_frames(spark):
    df = spark.createDataFrame([("a", 0, 0, -3.0), ("a", 0, 1, 2.0), ("a", 1, 5, 7.0)], "e string, f int, bin int, m double")
    long = spark.createDataFrame([(0, 0, 1.0), (1, 1, 0.5)], "bin int, band int, w double")
    weights = frames.band_weights(long, 2, "bin", "band", "w")
    found = {(r.f, r.band): r.energy for r in frames.band_energy(df, weights, 2, "e", "f", "bin", "m", power=1).collect()}
    assert found == {(0, 0): -3.0, (0, 1): 1.0, (1, 0): 0.0, (1, 1): 0.0}
