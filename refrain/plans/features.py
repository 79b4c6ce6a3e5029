"""From spectra and samples to one feature vector per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refrain.functions.vectors import decibel
from refrain.operators.frames import ROLLOFF_SLACK, sign_change_rate
from refrain.operators.statistics import AUDIO_FEATURES, feature_vector, seven_statistics


def _sums(weights: str, bands: int, power: Column) -> list[Column]:
    return [F.sum(power * F.coalesce(F.get(weights, F.lit(b)), F.lit(0.0))).alias(f"{weights}_{b}") for b in range(bands)]


def spectrum_frames(spectra: DataFrame, bands: dict[str, tuple[DataFrame, int]], fraction: float) -> DataFrame:
    """One row per (entity, frame): an array of energies for each of ``bands``, ``centroid`` and ``rolloff``.

    ``spectra`` is ``(entity, frame, bin, freq, magnitude)``; ``bands`` has a packed weight table (``band_weights``) and
    its width by name. Everything comes from one aggregate, so the spectra are read and exchanged once. The
    roll-off walks through the bins of a frame, of which there are as many as the spectrum has.
    """
    for name, (weights, _) in bands.items():
        spectra = spectra.join(weights.select("bin", F.col("weights").alias(name)), "bin", "left")
    magnitude = F.col("magnitude")
    sums = [x for name, (_, width) in bands.items() for x in _sums(name, width, magnitude * magnitude)]
    wide = spectra.groupBy("entity", "frame").agg(
        *sums,
        F.sum(magnitude).alias("total"),
        F.sum(F.col("freq") * magnitude).alias("weighted"),
        F.sort_array(F.collect_list(F.struct("freq", "magnitude"))).alias("bins"),
    )
    start = F.struct(F.lit(0.0).alias("running"), F.lit(None).cast("double").alias("rolloff"))

    def step(state: Column, x: Column) -> Column:
        running = state["running"] + x["magnitude"]
        reached = running >= F.lit(fraction - ROLLOFF_SLACK) * F.col("total")
        return F.struct(running.alias("running"), F.coalesce(state["rolloff"], F.when(reached, x["freq"])).alias("rolloff"))

    arrays = [F.array(*[F.col(f"{name}_{b}") for b in range(width)]).alias(name) for name, (_, width) in bands.items()]
    return wide.select(
        "entity",
        "frame",
        *arrays,
        (F.col("weighted") / F.nullif("total", F.lit(0.0))).alias("centroid"),
        F.aggregate("bins", start, step)["rolloff"].alias("rolloff"),
    )


def _long(frames: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Arrays by feature name as rows ``(entity, feature, channel, value)``, channels counting from 1."""

    def entry(name: str, values: Column) -> Column:
        return F.transform(
            values, lambda v, i: F.struct(F.lit(name).alias("feature"), (i + 1).alias("channel"), v.alias("value"))
        )

    entries = [entry(name, values) for name, values in parts.items()]
    return frames.select("entity", F.explode(F.concat(*entries)).alias("x")).select("entity", "x.feature", "x.channel", "x.value")


def frame_features(spectra: DataFrame, weights: DataFrame, bands: int, fraction: float) -> DataFrame:
    """Per frame the band energies, centroid and roll-off in long form: ``(entity, feature, channel, value)``."""
    frames = spectrum_frames(spectra, {"chroma_stft": (weights, bands)}, fraction)
    return _long(
        frames,
        {
            "chroma_stft": F.col("chroma_stft"),
            "spectral_centroid": F.array("centroid"),
            "spectral_rolloff": F.array("rolloff"),
        },
    )


def spectrum_statistics(spectra: DataFrame, weights: DataFrame, bands: int, fraction: float) -> DataFrame:
    """The seven statistics over all frames of each (entity, feature, channel)."""
    long = frame_features(spectra, weights, bands, fraction)
    return seven_statistics(long, ["entity", "feature", "channel"], "value")


def audio_statistics(
    spectra: DataFrame,
    rates: DataFrame,
    chroma: DataFrame,
    mel: DataFrame,
    mel_bands: int,
    cosines: list[list[float]],
    fraction: float,
) -> DataFrame:
    """The seven statistics of all five audio features, per (entity, feature, channel).

    ``chroma`` and ``mel`` are packed weight tables over the bins. The energies of the mel bands become levels
    in decibels, and ``cosines`` (a row of ``mel_bands`` numbers for each coefficient) projects these on the mfcc
    channels. ``rates`` is ``(entity, rate)`` with the sign-change rate of every frame.
    """
    widths = AUDIO_FEATURES
    frames = spectrum_frames(spectra, {"chroma": (chroma, widths["chroma_stft"]), "mel": (mel, mel_bands)}, fraction)
    frames = frames.withColumn("levels", F.transform("mel", lambda x: decibel(x, floor=1e-10, ref=1.0)))
    coefficients = F.array(
        *[
            F.aggregate(
                F.zip_with("levels", F.array(*map(F.lit, row)), lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
            )
            for row in cosines
        ]
    )
    spectral = _long(
        frames,
        {
            "chroma_stft": F.col("chroma"),
            "mfcc": coefficients,
            "spectral_centroid": F.array("centroid"),
            "spectral_rolloff": F.array("rolloff"),
        },
    )
    signs = _long(rates, {"zcr": F.array("rate")})
    return seven_statistics(spectral.unionByName(signs), ["entity", "feature", "channel"], "value")


def audio_vectors(stats: DataFrame) -> DataFrame:
    """One vector of 245 numbers per entity, ordered by (feature, statistic, channel)."""
    return feature_vector(stats, "entity")


def with_errors(items: DataFrame, vectors: DataFrame, entity: str = "entity", vector: str = "features", size: int = 245) -> DataFrame:
    """One row per item, failed ones too: ``entity``, ``vector`` and ``error``, which is NULL where all went well.

    ``items`` (``entity``, ``error``) are all that were to be processed, with what a decoder has reported for those that it
    failed on. An item without a vector had no values; one whose numbers are all NaN had a value that is none. Failed items
    have a vector of ``size`` NaN. A vector without an item is left out; items are told apart by ``entity``.
    """
    broken = F.forall(vector, lambda x: F.isnan(x))
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col(vector).isNull(), "no values").when(broken, "a value is not a number")
    nan = F.array_repeat(F.lit(float("nan")), size)
    met = items.select(entity, "error").join(vectors.select(entity, vector), entity, "left")
    met = met.select(entity, vector, reason.alias("error"))
    return met.select(entity, F.when(F.col("error").isNull(), F.col(vector)).otherwise(nan).alias(vector), "error")


def sign_rates(samples: DataFrame, **options) -> DataFrame:
    """``(entity, rate)`` for every frame of the series ``(entity, pos, value)``."""
    return sign_change_rate(samples, "entity", "pos", "value", **options).select("entity", "rate")
