"""Joins, de-duplication, keyed picks, sorts and unions."""

from pyspark.sql import functions as F

from checks.registry import query, sql_clean, sql_key
from refrain.operators import relational
from refrain.plans import lookup, metadata
from refrain.sources import tables
from refrain.sources.scratch import scratch_path


@query(
    """
    SELECT o_orderkey, c_custkey, c_name, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def inner_join(t):
    customer = t.customer.select("c_custkey", "c_name")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return orders.join(customer, "c_custkey").select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query(
    """
    SELECT c_custkey, c_nationkey, n_name, n_regionkey
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey
    """
)
def left_join_dimension(t):
    nation = t.nation.where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    return t.customer.select("c_custkey", "c_nationkey").join(nation, "c_nationkey", "left")


@query(
    f"""
    WITH l AS (SELECT {sql_clean('text')} AS n FROM documents), r AS (SELECT {sql_clean('text')} AS n FROM benchmark),
    lk AS (SELECT {sql_key('n')} AS name_key_1, count(*) AS left_rows FROM l WHERE n <> '' GROUP BY 1),
    rk AS (SELECT {sql_key('n')} AS name_key_1, count(*) AS right_rows FROM r WHERE n <> '' GROUP BY 1)
    SELECT name_key_1, left_rows, right_rows, left_rows * right_rows AS pairs FROM lk JOIN rk USING (name_key_1)
    """
)
def block_pair_counts(t):
    def keyed(df, record_id):
        named = df.select(F.col(record_id).alias("track_id"), F.col("text").alias("song_title"))
        return relational.add_name_key(relational.remove_noise(named, "song_title"), "music")

    return relational.block_pair_counts(keyed(t.documents, "doc_id"), keyed(t.benchmark, "item_id"), "name_key_1")


@query(
    """
    SELECT n_nationkey AS genre_id, n_name AS title FROM nation
    WHERE n_nationkey IN (SELECT DISTINCT n_regionkey FROM nation)
    """
)
def top_level_genres(t):
    genres = t.nation.select(
        F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("top_level")
    )
    return metadata.top_genres(genres)


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
    """
)
def semi_join_ids(t):
    wanted = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(wanted, "o_custkey", "left_semi")


@query(
    """
    SELECT e.vec_id AS track_id, coalesce(CAST(nullif(l.toxic, 1) AS VARCHAR), 'None') AS genre,
           64 AS dimensions, round(CAST(e.embedding[64] AS DOUBLE), 6) AS last_value
    FROM embeddings e JOIN labels l ON e.vec_id = l.doc_id
    """
)
def vectors_by_genre(t):
    vectors = t.embeddings.select(
        F.col("vec_id").alias("track_id"), F.col("embedding").cast("array<double>").alias("features")
    )
    music = t.labels.select(
        F.concat(F.lit("m"), F.col("doc_id")).alias("track_id"), F.nullif("toxic", F.lit(1)).alias("top_level")
    )
    joined = metadata.vectors_by_genre(vectors, music)
    return joined.select(
        "track_id",
        "genre",
        F.size("features").alias("dimensions"),
        F.round(F.element_at("features", -1), 6).alias("last_value"),
    )


@query(
    """
    WITH best AS (
        SELECT o_custkey, arg_max(o_orderkey, (round(o_totalprice, 9), -o_orderkey)) AS o_orderkey
        FROM orders GROUP BY o_custkey)
    SELECT b.o_custkey AS music_track_id, b.o_orderkey AS video_track_id, c_mktsegment AS block, l.l_linenumber, p.p_partkey, p.p_name
    FROM customer JOIN best b ON b.o_custkey = c_custkey JOIN lineitem l ON b.o_orderkey = l.l_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    """
)
def chained_lookup(t):
    """From every customer to the dearest order and its lines, over tables stored by market segment and id."""
    # A folder's name can't tell a segment that is NULL from an empty one, so segments are stored behind a letter.
    segment = F.coalesce(F.concat(F.lit("s"), "c_mktsegment"), F.lit("none"))
    customers = t.customer.select(F.col("c_custkey").alias("track_id"), segment.alias("block"))
    bought = t.orders.select(F.col("o_custkey").alias("music_track_id"), F.col("o_orderkey").alias("video_track_id"), "o_totalprice")
    best = relational.best_match(bought, "music_track_id", "video_track_id", "o_totalprice").drop("o_totalprice")
    of_block = customers.select(F.col("track_id").alias("music_track_id"), "block").distinct()
    lines = t.lineitem.select(F.col("l_orderkey").alias("track_id"), "l_linenumber", "l_partkey")
    owners = t.orders.select(F.col("o_orderkey").alias("track_id"), F.col("o_custkey").alias("music_track_id"))
    owned = lines.join(owners.join(of_block, "music_track_id").select("track_id", "block").distinct(), "track_id")
    paths = {name: scratch_path(t.spark, name) for name in ("pairs", "lines")}
    lookup.store(best.join(of_block, "music_track_id"), paths["pairs"], "music_track_id", "block")
    lookup.store(owned, paths["lines"], "track_id", "block")
    stored = [tables.read_table(t.spark, paths[name]) for name in ("pairs", "lines")]
    matched = lookup.videos_of_songs(customers, *stored, block="block")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_partkey", "p_name")
    named = F.when(F.col("block").startswith("s"), F.expr("substring(block, 2)")).alias("block")
    return matched.join(parts, "l_partkey").select(
        "music_track_id", "video_track_id", named, "l_linenumber", "p_partkey", "p_name"
    )


@query("SELECT DISTINCT event_type FROM events")
def distinct_values(t):
    return t.events.select("event_type").distinct()


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT p_name, p_brand, min(p_partkey) AS p_partkey, arg_min(p_type, p_partkey) AS p_type,
           arg_min(p_retailprice, p_partkey) AS p_retailprice
    FROM part GROUP BY p_name, p_brand
    """
)
def distinct_names(t):
    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return relational.distinct_names(parts, ["p_name", "p_brand"], "p_partkey")


@query(
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts,
           arg_max(event_id, (ts, event_id)) AS event_id
    FROM events GROUP BY user_id
    """
)
def last_event_per_user(t):
    events = t.events.select("user_id", "event_type", "ts", "event_id")
    return relational.last_per_key(events, ["user_id"], ["ts", "event_id"])


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY round(o_totalprice, 9) DESC, o_orderkey) AS rn
        FROM orders) WHERE rn = 1
    """
)
def best_per_key(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.best_match(orders, "o_custkey", "o_orderkey", "o_totalprice")


@query(
    """
    SELECT c_nationkey, c_custkey, o_orderkey, o_totalprice FROM (
        SELECT c_nationkey, c_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY c_custkey
               ORDER BY round(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN o_totalprice END, 9) DESC NULLS LAST,
               o_orderkey NULLS FIRST) AS rn
        FROM (SELECT c_nationkey, c_custkey, o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 5 = 0
              THEN 0 ELSE o_totalprice END END AS o_totalprice
              FROM customer LEFT JOIN orders ON o_custkey = c_custkey)) WHERE rn = 1
    """
)
def best_with_missing_scores(t):
    """Scores that are NULL (no order, or key divisible by 7) or NaN (by 5, shown as 0) lose against all others."""
    key = F.col("o_orderkey")
    score = F.when(key % 7 != 0, F.when(key % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")))
    scored = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_nationkey", "c_custkey", "o_orderkey", score.alias("o_totalprice")
    )
    best = relational.best_match(scored, "c_custkey", "o_orderkey", "o_totalprice")
    return best.select("c_nationkey", "c_custkey", "o_orderkey", F.nanvl("o_totalprice", F.lit(0.0)).alias("o_totalprice"))


@query(
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey
            ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3
    """
)
def first_three_per_key(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    return relational.first_k_per_key(lines, ["l_suppkey"], order, 3)


@query("SELECT p_partkey, p_name, p_brand FROM part ORDER BY p_name, p_partkey")
def sorted_by_title(t):
    return t.part.select("p_partkey", "p_name", "p_brand").orderBy("p_name", "p_partkey")


@query("SELECT event_id, value FROM events ORDER BY value ASC NULLS LAST, event_id LIMIT 5")
def smallest_values(t):
    return relational.smallest(t.events.select("event_id", "value"), "value", "event_id", 5)


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, 'customer' AS side FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'supplier' FROM supplier
    """
)
def union_of_sides(t):
    def side(df, letter):
        names = {"custkey": "id", "suppkey": "id", "name": "name", "nationkey": "nation"}
        return df.select([F.col(c).alias(names[c[2:]]) for c in df.columns if c[2:] in names])

    return relational.union_sides({"customer": side(t.customer, "c"), "supplier": side(t.supplier, "s")})
