"""Summary statistics of long value tables and their packing into feature vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from refrain.sources.scratch import settle

# The order of the packed vector depends on these names and sizes.
STATISTICS = ("kurtosis", "max", "mean", "median", "min", "skew", "std")
AUDIO_FEATURES = {
    "chroma_stft": 12,
    "mfcc": 20,
    "spectral_centroid": 1,
    "spectral_rolloff": 1,
    "zcr": 1,
}

# Accuracy of the quantile sketch: its rank error is at most rows / ACCURACY, which brackets the median.
ACCURACY = 10_000
BUCKETS = 1000


def seven_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Population moments, exact median and range of ``value`` per ``keys``; NULL values do not count.

    A key with a NaN among its values, or with no value but NULLs, has NaN for all seven. Skew and kurtosis are NULL
    where the values do not vary. A first pass gives the moments and brackets the median; a second one orders only
    the values inside the bracket, so no task ever holds or sorts all values of a key.

    The input is written once, and the summary and the bracket run and are written when this is called.
    """
    nan = F.lit(float("nan"))
    df = settle(df.select(*keys, F.col(value).cast("double").alias(value)), "values")
    real = F.when(~F.isnan(value), F.col(value))
    margin = 2.0 / ACCURACY
    summary = df.groupBy(*keys).agg(
        F.count(real).alias("n"),
        F.max(F.isnan(value)).alias("broken"),
        F.kurtosis(real).alias("kurtosis"),
        F.max(real).alias("max"),
        F.avg(real).alias("mean"),
        F.min(real).alias("min"),
        F.skewness(real).alias("skew"),
        F.stddev_pop(real).alias("std"),
        F.percentile_approx(real, [0.5 - margin, 0.5 + margin], ACCURACY).alias("near_middle"),
    )
    near = F.col("near_middle")
    summary = settle(summary.withColumns({"low": F.get(near, F.lit(0)), "high": F.get(near, F.lit(1))}), "summary")
    undefined = (F.col("n") == 0) | F.coalesce("broken", F.lit(False))
    none = summary.where(undefined).select(*keys, *[nan.alias(name) for name in STATISTICS])
    found = _with_median(df.where(~F.isnan(value)), summary.where(~undefined), keys, value)
    return none.unionByName(found.select(*keys, *STATISTICS))


def _with_median(df: DataFrame, summary: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add the exact median to ``summary``, which holds ``n`` and a bracket ``[low, high]`` around it.

    All values below the bracket collapse into one counter per key and task, all above it are left out. What
    is inside is counted in ``BUCKETS`` even intervals, and only the interval with the median is put in order.
    """
    keys = list(keys)
    inside = df.join(summary.select(*keys, "low", "high"), keys).where(F.col(value) <= F.col("high"))
    slot = F.when(F.col(value) >= F.col("low"), F.col(value))
    share = (F.col("slot") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    bucket = F.when(F.col("slot").isNull(), -1).otherwise(
        F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    )
    counted = settle(
        inside.groupBy(*keys, slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(summary.select(*keys, "low", "high"), keys)
        .select(*keys, bucket.alias("bucket"), "slot", "rows"),
        "bracket",
    )

    def running(*parts: str, order: str):
        upwards = Window.partitionBy(*keys, *parts).orderBy(order)
        return F.sum("rows").over(upwards.rowsBetween(Window.unboundedPreceding, 0))

    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    before = F.col("until") - F.col("rows")
    chosen = (
        counted.groupBy(*keys, "bucket")
        .agg(F.sum("rows").alias("rows"))
        .withColumn("until", running(order="bucket"))
        .join(summary.select(*keys, "n"), keys)
        .where((F.col("bucket") >= 0) & (before < upper) & (F.col("until") >= lower))
        .select(*keys, "bucket", before.alias("before"), "n")
    )
    ordered = counted.join(settle(chosen, "chosen"), [*keys, "bucket"]).withColumn(
        "reached", F.col("before") + running("bucket", order="slot")
    )
    reached = F.col("reached")
    middle = ordered.groupBy(*keys).agg(
        F.min_by("slot", F.when(reached >= lower, reached)).alias("lower_middle"),
        F.min_by("slot", F.when(reached >= upper, reached)).alias("upper_middle"),
    )
    median = (F.col("lower_middle") + F.col("upper_middle")) / 2.0
    missed = F.raise_error(F.lit("the bracket missed the median")).cast("double")
    exact = middle.select(*keys, F.coalesce(median, missed).alias("median"))
    found = summary.join(exact, keys, "left")
    return found.withColumn("median", F.coalesce("median", missed))


def vector_size(features: Mapping[str, int], statistics: Sequence[str] = STATISTICS) -> int:
    return sum(features.values()) * len(statistics)


def feature_offset(feature: Column, features: Mapping[str, int], statistics: Sequence[str] = STATISTICS) -> Column:
    """Where the block of a feature starts in the vector; NULL for an unknown feature."""
    offset, found = 0, F.lit(None).cast("int")
    for name in sorted(features):
        found = F.when(feature == F.lit(name), F.lit(offset)).otherwise(found)
        offset += features[name] * len(statistics)
    return found


def feature_width(feature: Column, features: Mapping[str, int]) -> Column:
    found = F.lit(None).cast("int")
    for name, size in features.items():
        found = F.when(feature == F.lit(name), F.lit(size)).otherwise(found)
    return found


def feature_vector(
    stats: DataFrame,
    entity: str,
    feature: str = "feature",
    channel: str = "channel",
    features: Mapping[str, int] = AUDIO_FEATURES,
    statistics: Sequence[str] = STATISTICS,
) -> DataFrame:
    """One array per entity, ordered by (feature, statistic, channel), NaN where a value is missing.

    ``stats`` has one row per (entity, feature, channel), channels counting from 1, so an entity
    gathers at most ``vector_size`` numbers.
    """
    base = feature_offset(F.col(feature), features, statistics)
    width = feature_width(F.col(feature), features)
    known = base.isNotNull() & F.col(channel).between(1, width)
    entries = F.array(
        *[
            F.struct(
                (base + F.lit(i) * width + F.col(channel) - 1).cast("int").alias("key"),
                F.col(name).cast("double").alias("value"),
            )
            for i, name in enumerate(sorted(statistics))
        ]
    )
    gathered = stats.groupBy(entity).agg(
        F.map_from_entries(F.flatten(F.collect_list(F.when(known, entries)))).alias("by_slot")
    )
    slots = F.sequence(F.lit(0), F.lit(vector_size(features, statistics) - 1))
    filled = F.transform(slots, lambda i: F.coalesce(F.element_at(F.col("by_slot"), i), F.lit(float("nan"))))
    return gathered.select(entity, filled.alias("features"))
