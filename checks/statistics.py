"""Summary statistics and feature vectors."""

from pyspark.sql import functions as F

from checks.registry import query
from refrain.operators import statistics
from refrain.plans import features


def _digits(statistic: str, digits: int) -> int:
    """A mean of prices can lie on a rounding edge, so it is compared with more places."""
    return 8 if statistic == "mean" else digits


def _sql_seven(keys: str, value: str, table: str, digits: int = 6) -> str:
    skew = (
        f"(avg({value} * {value} * {value}) - 3 * avg({value}) * avg({value} * {value})"
        f" + 2 * avg({value}) ** 3) / nullif(stddev_pop({value}), 0) ** 3"
    )
    kurtosis = f"CASE WHEN stddev_pop({value}) > 0 THEN kurtosis_pop({value}) END"
    parts = {
        "kurtosis": kurtosis,
        "max": f"max({value})",
        "mean": f"avg({value})",
        "median": f"median({value})",
        "min": f"min({value})",
        "skew": skew,
        "std": f"stddev_pop({value})",
    }
    chosen = ", ".join(f"round({sql}, {_digits(name, digits)}) AS {name}" for name, sql in parts.items())
    return f"SELECT {keys}, {chosen} FROM {table} GROUP BY {keys}"


def _rounded(df, keys, digits=6):
    return df.select(*keys, *[F.round(s, _digits(s, digits)).alias(s) for s in statistics.STATISTICS])


@query(_sql_seven("event_type", "value", "events"))
def statistics_by_type(t):
    return _rounded(statistics.seven_statistics(t.events, ["event_type"], "value"), ["event_type"])


@query(_sql_seven("user_id, event_type", "value", "events", 5))
def statistics_by_user_and_type(t):
    keys = ["user_id", "event_type"]
    return _rounded(statistics.seven_statistics(t.events, keys, "value"), keys, 5)


@query(
    f"""
    WITH real AS ({_sql_seven('user_id', 'value', "(SELECT * FROM events WHERE user_id % 3 = 0)", 5)}),
    {{all}} AS (SELECT DISTINCT user_id FROM events)
    SELECT a.user_id, a.user_id % 3 > 0 AS undefined, {', '.join(f'{s}' for s in statistics.STATISTICS)}
    FROM {{all}} a LEFT JOIN real r USING (user_id)
    """.replace("{all}", "every")
)
def statistics_of_failed_entities(t):
    """Users with NULLs only (key 1 modulo 3) and with a NaN (2 modulo 3) keep their row; NaN is shown as NULL."""
    user = F.col("user_id")
    broken = F.when(user % 3 == 1, F.lit(None).cast("double")).when(
        (user % 3 == 2) & (F.col("event_type") == "view"), F.lit(float("nan"))
    )
    values = t.events.select("user_id", F.when(user % 3 == 0, F.col("value")).otherwise(broken).alias("value"))
    # A user of the third kind without a view gets one, so that each has a NaN.
    views = t.events.where(user % 3 == 2).select("user_id", F.lit(float("nan")).alias("value")).distinct()
    found = _rounded(statistics.seven_statistics(values.unionByName(views), ["user_id"], "value"), ["user_id"], 5)
    seven = [F.when(~F.isnan(s), F.col(s)).alias(s) for s in statistics.STATISTICS]
    return found.select("user_id", F.isnan("mean").alias("undefined"), *seven)


@query(
    f"""
    WITH stats AS ({_sql_seven('user_id, event_type', 'value', 'events', 5)}),
    long AS (UNPIVOT (SELECT user_id, event_type, kurtosis, max, mean, median, min, skew, std FROM stats)
             ON kurtosis, max, mean, median, min, skew, std INTO NAME statistic VALUE v),
    names AS (SELECT row_number() OVER (ORDER BY e, s) - 1 AS position, e, s
              FROM (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS e),
                   (SELECT unnest(['kurtosis', 'max', 'mean', 'median', 'min', 'skew', 'std']) AS s))
    SELECT u.user_id, n.position, coalesce(l.v, 0) AS value, l.v IS NULL AS missing
    FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN names n
    LEFT JOIN long l ON l.user_id = u.user_id AND l.event_type = n.e AND l.statistic = n.s
    """
)
def feature_vectors(t):
    keys = ["user_id", "event_type"]
    stats = _rounded(statistics.seven_statistics(t.events, keys, "value"), keys, 5).withColumn("channel", F.lit(1))
    types = {name: 1 for name in ("click", "error", "purchase", "signup", "view")}
    vectors = statistics.feature_vector(stats, "user_id", feature="event_type", features=types)
    return vectors.select("user_id", F.posexplode("features").alias("position", "number")).select(
        "user_id", "position", F.nanvl("number", F.lit(0.0)).alias("value"), F.isnan("number").alias("missing")
    )


@query(
    """
    SELECT user_id AS entity, CASE WHEN user_id % 10 = 3 THEN 'not decoded' WHEN user_id % 10 = 5 THEN 'no values'
           WHEN user_id % 10 = 7 THEN 'a value is not a number' END AS error,
           CASE WHEN user_id % 10 NOT IN (3, 5, 7) THEN round(avg(value), 4) END AS mean
    FROM events GROUP BY user_id
    """
)
def vectors_of_failed_items(t):
    """Users of which some can't be decoded, some have no values and some a broken one; each keeps its row."""
    kind = F.col("user_id") % 10
    items = t.events.select(F.col("user_id").alias("entity"), F.when(kind == 3, "not decoded").alias("error")).distinct()
    value = F.when(kind == 7, float("nan")).otherwise(F.col("value"))
    long = t.events.where((kind != 3) & (kind != 5)).select(
        F.col("user_id").alias("entity"), F.lit("zcr").alias("feature"), F.lit(1).alias("channel"), value.alias("value")
    )
    stats = statistics.seven_statistics(long, ["entity", "feature", "channel"], "value")
    vectors = statistics.feature_vector(stats, "entity", features={"zcr": 1})
    found = features.with_errors(items, vectors, size=7)
    mean = F.element_at("features", statistics.STATISTICS.index("mean") + 1)
    return found.select("entity", "error", F.round(F.when(~F.isnan(mean), mean), 4).alias("mean"))
