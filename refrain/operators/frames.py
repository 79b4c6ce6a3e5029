"""Aggregates over frames of long series and over spectra."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from refrain.sources.scratch import settle

# Frame length and hop of the sign-change rate.
FRAME, HOP = 2048, 512
ROLLOFF_SLACK = 1e-9


def padded(samples: DataFrame, entity: str, pos: str, value: str, by: int) -> DataFrame:
    """Each series with its first and its last sample repeated ``by`` times; positions count from 0 again."""
    ends = samples.groupBy(entity).agg(
        F.min_by(value, pos).alias("first"), F.max_by(value, pos).alias("last"), F.max(pos).alias("end")
    )
    place = F.explode(F.sequence(F.lit(0), F.lit(by - 1))).alias("place")
    before = ends.select(entity, place, F.col("first").alias(value)).select(entity, F.col("place").alias(pos), value)
    after = ends.select(entity, place, "end", F.col("last").alias(value))
    after = after.select(entity, (F.col("end") + 1 + by + F.col("place")).alias(pos), value)
    shifted = samples.select(entity, (F.col(pos) + by).alias(pos), value)
    return shifted.unionByName(before).unionByName(after) if by else shifted


def sign_change_rate(
    samples: DataFrame,
    entity: str,
    pos: str,
    value: str,
    frame: int = FRAME,
    hop: int = HOP,
    chunk: int = 1 << 16,
    centered: bool = False,
) -> DataFrame:
    """Share of samples in each complete frame whose sign differs from the sample before them in the frame.

    Positions count from 0 without gaps. With ``centered`` a frame's middle lies at a multiple of ``hop``: half a
    frame is put before and after each series, so that short ones have frames, too. The series is cut into chunks,
    each also given the last sample of the chunk before, so one long series is spread over many tasks. Changes are
    summed per step (the greatest common divisor of frame and hop) before they are handed to the frames.
    """
    if centered:
        samples = padded(samples, entity, pos, value, frame // 2)
    step = math.gcd(frame, hop)
    chunk = math.ceil(chunk / step) * step
    own = F.floor(F.col(pos) / chunk)
    closes_chunk = (F.col(pos) + 1) % chunk == 0
    placed = samples.select(
        entity,
        F.col(pos).alias("pos"),
        (F.col(value) < 0).alias("negative"),
        F.explode(F.when(closes_chunk, F.array(own, own + 1)).otherwise(F.array(own))).alias("chunk"),
    )
    before = Window.partitionBy(entity, "chunk").orderBy("pos")
    changes = placed.withColumn("previous", F.lag("negative").over(before)).where(
        F.floor(F.col("pos") / chunk) == F.col("chunk")
    )
    changed = F.coalesce((F.col("negative") != F.col("previous")).cast("long"), F.lit(0))
    # A step lies within a chunk, so this grouping keeps the partitioning of the window.
    steps = changes.groupBy(entity, "chunk", F.floor(F.col("pos") / step).alias("step")).agg(
        F.sum(changed).alias("changes"),
        F.sum(F.when(F.col("pos") % step == 0, changed).otherwise(0)).alias("at_start"),
        F.count(F.lit(1)).alias("samples"),
    )
    in_frame, between = frame // step, hop // step
    last = F.floor(F.col("step") / between)
    first = F.greatest(F.lit(0), F.ceil((F.col("step") - in_frame + 1) / between))
    framed = steps.where(last >= first).select(
        entity, "step", F.explode(F.sequence(first, last)).alias("frame"), "changes", "at_start", "samples"
    )
    opens_frame = F.col("step") == F.col("frame") * between
    inside = F.col("changes") - F.when(opens_frame, F.col("at_start")).otherwise(0)
    return (
        framed.groupBy(entity, "frame")
        .agg(F.sum(inside).alias("changes"), F.sum("samples").alias("samples"))
        .where(F.col("samples") == frame)
        .select(entity, "frame", (F.col("changes") / F.lit(float(frame))).alias("rate"))
    )


def spectral_centroid(spectra: DataFrame, entity: str, frame: str, freq: str, magnitude: str) -> DataFrame:
    """Mean frequency weighted by magnitude; NULL for a silent frame."""
    total = F.sum(magnitude)
    weighted = F.sum(F.col(freq) * F.col(magnitude))
    return spectra.groupBy(entity, frame).agg((weighted / F.nullif(total, F.lit(0.0))).alias("centroid"))


def spectral_rolloff(
    spectra: DataFrame, entity: str, frame: str, freq: str, magnitude: str, fraction: float
) -> DataFrame:
    """Smallest frequency at which the magnitudes add up to ``fraction`` of the frame's total, whatever its size.

    Sums that differ by a billionth of the total count as equal; a silent frame gives its lowest frequency. A window
    sees one frame, which has as many rows as the spectrum has bins.
    """
    one_frame = Window.partitionBy(entity, frame)
    running = F.sum(magnitude).over(one_frame.orderBy(freq).rowsBetween(Window.unboundedPreceding, 0))
    reached = spectra.select(
        entity, frame, freq, running.alias("running"), F.sum(magnitude).over(one_frame).alias("total")
    ).where(F.col("running") >= F.lit(fraction - ROLLOFF_SLACK) * F.col("total"))
    return reached.groupBy(entity, frame).agg(F.min(freq).alias("rolloff"))


def band_energy(
    spectra: DataFrame, weights: DataFrame, bands: int, entity: str, frame: str, bin: str, magnitude: str, power: int = 2
) -> DataFrame:
    """Energy per band: magnitudes to the ``power`` (1 or 2) times the weight each bin has in each band.

    ``weights`` has one row per bin with its ``bands`` weights in an array ``weights``; a bin without a row weighs
    nothing. All bands are summed side by side in one aggregate, so a spectrum row is never multiplied. With
    ``power`` 1 it is a linear projection, as of levels on cosines.
    """
    if power not in (1, 2):
        raise ValueError("power is 1 or 2")
    raised = F.col(magnitude) * F.col(magnitude) if power == 2 else F.col(magnitude)
    weight = lambda b: F.coalesce(F.get("weights", F.lit(b)), F.lit(0.0))
    sums = [F.sum(raised * weight(b)).alias(f"band_{b}") for b in range(bands)]
    wide = spectra.join(weights.select(bin, "weights"), bin, "left").groupBy(entity, frame).agg(*sums)
    packed = F.array(*[F.col(f"band_{b}") for b in range(bands)])
    return wide.select(entity, frame, F.posexplode(packed).alias("band", "energy"))


def band_weights(weights: DataFrame, bands: int, bin: str, band: str, weight: str) -> DataFrame:
    """Weight table in long form, one row per (bin, band), packed to one row per bin; gaps weigh 0.

    It is written, so that joins know its size and broadcast it only while it is small.
    """
    by_band = F.map_from_entries(F.collect_list(F.struct(band, weight)))
    packed = weights.groupBy(bin).agg(by_band.alias("by_band"))
    cells = [F.coalesce(F.element_at(F.col("by_band"), F.lit(b)), F.lit(0.0)) for b in range(bands)]
    return settle(packed.select(bin, F.array(*cells).alias("weights")), "weights")
