"""Scalar functions and predicates on whole tables."""

from pyspark.sql import functions as F

from checks.registry import query, sql_clean, sql_key
from refrain.functions import text, vectors
from refrain.operators import relational


@query(
    f"""
    SELECT doc_id, {sql_clean('text')} AS title, length(text) AS original_length
    FROM documents WHERE {sql_clean('text')} <> ''
    """
)
def clean_names(t):
    named = relational.remove_noise(t.documents.select("doc_id", F.col("text").alias("title")), "title")
    return named.select("doc_id", "title", F.length("original_title").alias("original_length"))


@query(
    f"""
    WITH named AS (SELECT doc_id, {sql_clean('text')} AS title FROM documents)
    SELECT 'm' || doc_id AS track_id, {sql_key('title')} AS name_key_1, length(title) AS title_length
    FROM named WHERE title <> ''
    """
)
def name_keys(t):
    named = t.documents.select(F.col("doc_id").alias("track_id"), F.col("text").alias("song_title"))
    keyed = relational.add_name_key(relational.remove_noise(named, "song_title"), "music")
    return keyed.select("track_id", "name_key_1", F.length("song_title").alias("title_length"))


@query("SELECT 't' || c_custkey AS track_id, 'm' || c_custkey AS music_id FROM customer")
def tagged_ids(t):
    key = F.col("c_custkey")
    return t.customer.select(
        text.tagged_id(key, "video").alias("track_id"), text.tagged_id(key, "music").alias("music_id")
    )


@query(
    r"""
    WITH listed AS (
        SELECT event_id, json_extract_string(props, '$.k') AS k, user_id, event_type FROM events
    ), bracketed AS (
        SELECT event_id, CASE event_type
            WHEN 'click' THEN '[]' WHEN 'view' THEN '[' || k || ']' WHEN 'error' THEN 'nan'
            WHEN 'signup' THEN '[' || k ELSE '[' || k || ', ' || user_id || ']' END AS genres FROM listed
    )
    SELECT event_id, genres, regexp_extract(genres, '(\[)(\w+)(.+)', 2) AS genre_1 FROM bracketed
    """
)
def first_genres(t):
    k = F.get_json_object("props", "$.k")
    genres = (
        F.when(F.col("event_type") == "click", "[]")
        .when(F.col("event_type") == "view", F.concat(F.lit("["), k, F.lit("]")))
        .when(F.col("event_type") == "error", "nan")
        .when(F.col("event_type") == "signup", F.concat(F.lit("["), k))
        .otherwise(F.concat(F.lit("["), k, F.lit(", "), F.col("user_id"), F.lit("]")))
    )
    listed = t.events.select("event_id", genres.alias("genres"))
    return listed.withColumn("genre_1", text.first_listed(F.col("genres")))


@query(
    """
    SELECT c_custkey AS customer_id, c_name AS original_name, c_mktsegment AS segment, 'customer' AS side
    FROM customer
    """
)
def projections(t):
    return (
        t.customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"), "c_nationkey")
        .withColumnRenamed("c_custkey", "customer_id")
        .withColumnRenamed("c_name", "original_name")
        .drop("c_nationkey")
        .withColumn("side", F.lit("customer"))
    )


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
           CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
    FROM part
    """
)
def all_as_strings(t):
    return relational.as_strings(t.part)


@query(
    """
    SELECT l_orderkey, l_linenumber, 4 AS width, l_quantity AS first_value, l_tax AS last_value,
           round(l_quantity + l_extendedprice + l_discount + l_tax, 6) AS total
    FROM lineitem
    """
)
def packed_columns(t):
    packed = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        vectors.pack(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).alias("v"),
    )
    return packed.select(
        "l_orderkey",
        "l_linenumber",
        F.size("v").alias("width"),
        F.get("v", F.lit(0)).alias("first_value"),
        F.get("v", F.lit(3)).alias("last_value"),
        F.round(F.aggregate("v", F.lit(0.0), lambda total, x: total + x), 6).alias("total"),
    )


@query(
    """
    SELECT vec_id AS track_id, 64 AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS feature_0,
           round(CAST(embedding[64] AS DOUBLE), 6) AS feature_63,
           round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
    FROM embeddings
    """
)
def wide_vectors(t):
    wide = t.embeddings.select(F.col("vec_id").alias("track_id"), *vectors.unpack(F.col("embedding"), 64))
    packed = wide.select("track_id", "feature_0", "feature_63", vectors.pack(vectors.feature_names(64)).alias("v"))
    return packed.select(
        "track_id",
        F.size("v").alias("width"),
        F.round("feature_0", 6).alias("feature_0"),
        F.round("feature_63", 6).alias("feature_63"),
        F.round(F.aggregate("v", F.lit(0.0), lambda total, x: total + x), 6).alias("total"),
    )


@query(
    r"""
    WITH labelled AS (SELECT p_partkey, '(' || p_partkey || ')' || p_name AS label FROM part)
    SELECT p_partkey, label, regexp_extract(label, '\(([^)]+)', 1) AS id,
           lower(substring(string_split(label, ')')[2], 1, 1)) AS letter
    FROM labelled
    """
)
def label_keys(t):
    labelled = t.part.select("p_partkey", text.label_for(F.col("p_partkey"), F.col("p_name")).alias("label"))
    label = F.col("label")
    return labelled.select(
        "p_partkey", "label", text.id_from_label(label).alias("id"), text.letter_from_label(label).alias("letter")
    )


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE lower(left(p_name, 1)) END AS letter FROM part")
def letters_of_broken_labels(t):
    label = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("("), "p_name")).otherwise(
        text.label_for(F.col("p_partkey"), F.col("p_name"))
    )
    return t.part.select("p_partkey", text.letter_from_label(label).alias("letter"))


@query(
    r"""
    SELECT page_id, url FROM pages WHERE lower(regexp_extract(url, '\.([^.]*)$', 1)) IN ('html', 'htm', 'com/')
    """
)
def allowed_extensions(t):
    return t.pages.select("page_id", "url").where(text.has_extension(F.col("url"), ("html", "htm", "com/")))


@query(
    """
    WITH assigned AS (
        SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    )
    SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), 'None') AS quality, quality IS NULL AS unlabelled
    FROM assigned WHERE lang = 'en' AND (quality IS NULL OR quality <> 0)
    """
)
def branch_filters(t):
    documents = t.documents.where(F.col("lang") == "en").select("doc_id", "lang")
    assigned = documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    quality = F.col("quality")
    return assigned.where(quality.isNull() | (quality != 0)).select(
        "doc_id",
        "lang",
        F.coalesce(quality.cast("string"), F.lit("None")).alias("quality"),
        quality.isNull().alias("unlabelled"),
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    """
)
def in_value_list(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query(
    """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_reverse(CAST(embedding AS DOUBLE[])) AS r
               FROM embeddings)
    SELECT vec_id, round(list_dot_product(e, r), 6) AS dot, round(sqrt(list_dot_product(e, e)), 6) AS norm,
           round(list_sum(list_transform(list_zip(e, r), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS distance,
           round(list_sum(list_transform(list_zip(e, r), lambda p: abs(p[1] - p[2]))), 6) AS moved
    FROM v
    """
)
def array_arithmetic(t):
    e = F.col("embedding")
    r = F.reverse(e)
    moved = F.aggregate(F.transform(vectors.difference(e, r), F.abs), F.lit(0.0), lambda total, x: total + x)
    return t.embeddings.select(
        "vec_id",
        F.round(vectors.dot(e, r), 6).alias("dot"),
        F.round(vectors.norm(e), 6).alias("norm"),
        F.round(vectors.squared_l2(e, r), 6).alias("distance"),
        F.round(moved, 6).alias("moved"),
    )


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings")
def first_elements(t):
    first = F.get("embedding", F.lit(0)).cast("double")
    return t.embeddings.select("vec_id", F.round(first, 6).alias("first_value"))


@query(
    """
    WITH paired AS (
        SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y
        FROM embeddings a
        JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) b
        ON a.label = b.label
    )
    SELECT vec_id, round(CASE WHEN list_dot_product(x, x) * list_dot_product(y, y) = 0 THEN -1.0
        ELSE list_dot_product(x, y) / (sqrt(list_dot_product(x, x)) * sqrt(list_dot_product(y, y))) END, 6) AS cosine,
        CAST(-1 AS DOUBLE) AS cosine_to_nothing
    FROM paired
    """
)
def cosine_with_sentinel(t):
    first = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("other"))
    paired = t.embeddings.join(first, "label")
    nothing = F.transform("other", lambda x: F.lit(0.0))
    return paired.select(
        "vec_id",
        F.round(vectors.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"),
        vectors.cosine(F.col("embedding"), nothing).alias("cosine_to_nothing"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, round(10 * log10(greatest(l_extendedprice, 1000.0) / 50000.0), 6) AS db
    FROM lineitem
    """
)
def decibels(t):
    level = vectors.decibel(F.col("l_extendedprice"), floor=1000.0, ref=50000.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(level, 6).alias("db"))


@query(
    r"""
    SELECT doc_id, len(regexp_extract_all(lower(text), '\w')) AS char_tokens,
           array_to_string(regexp_extract_all(lower(text), '\w'), '') AS chars,
           array_to_string(regexp_extract_all(lower(text), '\w+'), ' ') AS words
    FROM documents
    """
)
def tokenised(t):
    chars = text.tokens(F.col("text"), "char")
    return t.documents.select(
        "doc_id",
        F.size(chars).alias("char_tokens"),
        F.array_join(chars, "").alias("chars"),
        F.array_join(text.tokens(F.col("text"), "word"), " ").alias("words"),
    )
