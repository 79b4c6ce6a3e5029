"""Frame aggregates: an embedding serves as a short series or as the spectrum of one frame."""

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.statistics import _rounded
from refrain.operators import frames, statistics
from refrain.plans import features
from refrain.plans.features import spectrum_statistics

BANDS = 12

_SPECTRA_SQL = """
    spectra AS (
        SELECT label AS entity, vec_id AS frame, i AS bin, CAST(i * 10 AS DOUBLE) AS freq,
               abs(CAST(embedding[i + 1] AS DOUBLE)) AS magnitude
        FROM embeddings, range(64) r(i))
"""

_WEIGHTS_SQL = f"""
    weights AS (
        SELECT i AS bin, b AS band, CASE WHEN i % {BANDS} = b THEN 1.0 ELSE 0.5 END AS weight
        FROM range(64) r(i), range({BANDS}) s(b) WHERE i % {BANDS} = b OR (i + 1) % {BANDS} = b)
"""


def _spectra(t):
    bins = t.embeddings.select(
        F.col("label").alias("entity"), F.col("vec_id").alias("frame"), F.posexplode("embedding").alias("bin", "m")
    )
    return bins.select(
        "entity",
        "frame",
        "bin",
        (F.col("bin") * 10.0).alias("freq"),
        F.abs(F.col("m").cast("double")).alias("magnitude"),
    )


def _weights(spark):
    bins = spark.range(64).select(F.col("id").cast("int").alias("bin"))
    own, next_to = F.col("bin") % BANDS, (F.col("bin") + 1) % BANDS
    long = bins.select(
        "bin",
        F.explode(
            F.array(
                F.struct(own.alias("band"), F.lit(1.0).alias("weight")),
                F.struct(next_to.alias("band"), F.lit(0.5).alias("weight")),
            )
        ).alias("w"),
    ).select("bin", "w.band", "w.weight")
    return frames.band_weights(long, BANDS, "bin", "band", "weight")


@query(
    """
    WITH samples AS (
        SELECT vec_id, i AS pos, embedding[i + 1] < 0 AS negative FROM embeddings, range(64) r(i)
    ), framed AS (
        SELECT vec_id, f, coalesce(CAST(negative <> lag(negative) OVER (PARTITION BY vec_id, f ORDER BY pos) AS INT), 0)
               AS changed FROM samples, range(15) r(f) WHERE pos BETWEEN f * 4 AND f * 4 + 7
    )
    SELECT vec_id, f AS frame, round(avg(changed), 6) AS rate FROM framed GROUP BY vec_id, f
    """
)
def sign_change_rates(t):
    samples = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    rates = frames.sign_change_rate(samples, "vec_id", "pos", "value", frame=8, hop=4, chunk=16)
    return rates.select("vec_id", "frame", F.round("rate", 6).alias("rate"))


@query(
    """
    WITH samples AS (
        SELECT vec_id, i AS pos, embedding[greatest(1, least(64, i - 3))] < 0 AS negative FROM embeddings, range(72) r(i)
    ), framed AS (
        SELECT vec_id, f, coalesce(CAST(negative <> lag(negative) OVER (PARTITION BY vec_id, f ORDER BY pos) AS INT), 0)
               AS changed FROM samples, range(17) r(f) WHERE pos BETWEEN f * 4 AND f * 4 + 7
    )
    SELECT vec_id, f AS frame, round(avg(changed), 6) AS rate FROM framed GROUP BY vec_id, f
    """
)
def centered_sign_change_rates(t):
    samples = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    rates = frames.sign_change_rate(samples, "vec_id", "pos", "value", frame=8, hop=4, chunk=16, centered=True)
    return rates.select("vec_id", "frame", F.round("rate", 6).alias("rate"))


@query(
    f"""
    WITH {_SPECTRA_SQL}
    SELECT entity, frame, round(sum(freq * magnitude) / nullif(sum(magnitude), 0), 6) AS centroid
    FROM spectra GROUP BY entity, frame
    """
)
def spectral_centroids(t):
    centroids = frames.spectral_centroid(_spectra(t), "entity", "frame", "freq", "magnitude")
    return centroids.select("entity", "frame", F.round("centroid", 6).alias("centroid"))


_ROLLOFF_SQL = """
    reached AS (
        SELECT entity, frame, freq, sum(magnitude) OVER (PARTITION BY entity, frame ORDER BY freq
               ROWS UNBOUNDED PRECEDING) AS running, sum(magnitude) OVER (PARTITION BY entity, frame) AS total
        FROM spectra),
    rolloffs AS (SELECT entity, frame, min(freq) AS rolloff FROM reached
                 WHERE running >= (0.85 - 1e-9) * total GROUP BY entity, frame)
"""


@query(f"WITH {_SPECTRA_SQL}, {_ROLLOFF_SQL} SELECT entity, frame, rolloff FROM rolloffs")
def spectral_rolloffs(t):
    return frames.spectral_rolloff(_spectra(t), "entity", "frame", "freq", "magnitude", fraction=0.85)


@query(f"WITH {_SPECTRA_SQL}, {_ROLLOFF_SQL} SELECT entity, frame, rolloff FROM rolloffs")
def quiet_spectral_rolloffs(t):
    """A spectrum times 1e-11 has the roll-off that it had."""
    quiet = _spectra(t).withColumn("magnitude", F.col("magnitude") * 1e-11)
    return frames.spectral_rolloff(quiet, "entity", "frame", "freq", "magnitude", fraction=0.85)


@query(
    f"""
    WITH {_SPECTRA_SQL}, {_WEIGHTS_SQL}
    SELECT entity, frame, band, round(sum(weight * magnitude * magnitude), 6) AS energy
    FROM spectra JOIN weights USING (bin) GROUP BY entity, frame, band
    """
)
def band_energies(t):
    energies = frames.band_energy(_spectra(t), _weights(t.spark), BANDS, "entity", "frame", "bin", "magnitude")
    return energies.select("entity", "frame", "band", F.round("energy", 6).alias("energy"))


_SKEW = "(avg(v * v * v) - 3 * avg(v) * avg(v * v) + 2 * avg(v) ** 3) / nullif(stddev_pop(v), 0) ** 3"


@query(
    f"""
    WITH {_SPECTRA_SQL}, {_WEIGHTS_SQL}, {_ROLLOFF_SQL},
    long AS (
        SELECT entity, 'chroma_stft' AS feature, band + 1 AS channel, sum(weight * magnitude * magnitude) AS v
        FROM spectra JOIN weights USING (bin) GROUP BY entity, frame, band
        UNION ALL
        SELECT entity, 'spectral_centroid', 1, sum(freq * magnitude) / nullif(sum(magnitude), 0)
        FROM spectra GROUP BY entity, frame
        UNION ALL SELECT entity, 'spectral_rolloff', 1, rolloff FROM rolloffs
    ), stats AS (
        SELECT entity, feature, channel, round(kurtosis_pop(v), 4) AS kurtosis, round(max(v), 4) AS max,
               round(avg(v), 8) AS mean, round(median(v), 4) AS median, round(min(v), 4) AS min,
               round({_SKEW}, 4) AS skew, round(stddev_pop(v), 4) AS std
        FROM long GROUP BY entity, feature, channel
    ), numbers AS (
        UNPIVOT stats ON kurtosis, max, mean, median, min, skew, std INTO NAME statistic VALUE value
    )
    SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY feature, statistic, channel) - 1 AS position, value
    FROM numbers
    """
)
def spectrum_feature_vectors(t):
    sizes = {"chroma_stft": BANDS, "spectral_centroid": 1, "spectral_rolloff": 1}
    stats = spectrum_statistics(_spectra(t), _weights(t.spark), BANDS, fraction=0.85)
    keys = ["entity", "feature", "channel"]
    vectors = statistics.feature_vector(_rounded(stats, keys, 4), "entity", features=sizes)
    return vectors.select("entity", F.posexplode("features").alias("position", "value"))


MEL = 24

# Weights of the mel-like bands, and the cosines that project their levels on 20 coefficients.
_MEL_SQL = f"""
    mel AS (SELECT i AS bin, b AS band, 1.0 / (1 + abs(i - 2.5 * b)) AS weight
            FROM range(64) r(i), range({MEL}) s(b) WHERE abs(i - 2.5 * b) < 4),
    levels AS (
        SELECT entity, frame, band, 10 * log10(greatest(sum(weight * magnitude * magnitude), 1e-10)) AS level
        FROM spectra JOIN mel USING (bin) GROUP BY entity, frame, band),
    coefficients AS (
        SELECT entity, frame, k, sum(level * cos(pi() / {MEL} * (band + 0.5) * k)) AS v
        FROM levels, range(20) r(k) GROUP BY entity, frame, k)
"""


def _mel(spark):
    place = F.col("bin") - 2.5 * F.col("band")
    cells = spark.range(64 * MEL).select(
        F.floor(F.col("id") / MEL).cast("int").alias("bin"), (F.col("id") % MEL).cast("int").alias("band")
    )
    near = cells.where(F.abs(place) < 4).select("bin", "band", (1.0 / (1 + F.abs(place))).alias("weight"))
    return frames.band_weights(near, MEL, "bin", "band", "weight")


@query(
    f"""
    WITH {_SPECTRA_SQL}, {_WEIGHTS_SQL}, {_ROLLOFF_SQL}, {_MEL_SQL},
    signs AS (
        SELECT label AS entity, vec_id, f, coalesce(CAST(negative <> lag(negative) OVER (PARTITION BY vec_id, f ORDER BY pos)
               AS INT), 0) AS changed
        FROM (SELECT label, vec_id, i AS pos, embedding[greatest(1, least(64, i - 3))] < 0 AS negative
              FROM embeddings, range(72) r(i)), range(17) r(f) WHERE pos BETWEEN f * 4 AND f * 4 + 7),
    long AS (
        SELECT entity, 'chroma_stft' AS feature, band + 1 AS channel, sum(weight * magnitude * magnitude) AS v
        FROM spectra JOIN weights USING (bin) GROUP BY entity, frame, band
        UNION ALL SELECT entity, 'mfcc', k + 1, v FROM coefficients
        UNION ALL SELECT entity, 'spectral_centroid', 1, sum(freq * magnitude) / nullif(sum(magnitude), 0)
        FROM spectra GROUP BY entity, frame
        UNION ALL SELECT entity, 'spectral_rolloff', 1, rolloff FROM rolloffs
        UNION ALL SELECT entity, 'zcr', 1, avg(changed) FROM signs GROUP BY entity, vec_id, f
    ), stats AS (
        SELECT entity, feature, channel, round(kurtosis_pop(v), 4) AS kurtosis, round(max(v), 4) AS max,
               round(avg(v), 4) AS mean, round(median(v), 4) AS median, round(min(v), 4) AS min,
               round({_SKEW}, 4) AS skew, round(stddev_pop(v), 4) AS std
        FROM long GROUP BY entity, feature, channel
    ), numbers AS (
        UNPIVOT stats ON kurtosis, max, mean, median, min, skew, std INTO NAME statistic VALUE value
    )
    SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY feature, statistic, channel) - 1 AS position, value
    FROM numbers
    """
)
def audio_feature_vectors(t):
    """245 numbers per entity: five features of 35 channels, seven statistics of each over all frames."""
    series = t.embeddings.select("label", "vec_id", F.posexplode("embedding").alias("pos", "value"))
    rates = features.sign_rates(series.withColumnRenamed("vec_id", "entity"), frame=8, hop=4, chunk=16, centered=True)
    labels = t.embeddings.select(F.col("vec_id").alias("entity"), F.col("label").alias("of"))
    rates = rates.join(labels, "entity").select(F.col("of").alias("entity"), "rate")
    cosines = [[math.cos(math.pi / MEL * (m + 0.5) * k) for m in range(MEL)] for k in range(20)]
    stats = features.audio_statistics(_spectra(t), rates, _weights(t.spark), _mel(t.spark), MEL, cosines, fraction=0.85)
    rounded = stats.select("entity", "feature", "channel", *[F.round(s, 4).alias(s) for s in statistics.STATISTICS])
    return features.audio_vectors(rounded).select("entity", F.posexplode("features").alias("position", "value"))
