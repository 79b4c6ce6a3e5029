"""Term weights, linkage and vector search."""

from pyspark.sql import functions as F

from checks.registry import query, sql_clean, sql_key
from checks.scans import grouped_parts
from refrain.functions.text import ALPHABET
from refrain.operators import neighbours, relational, weights
from refrain.plans import linkage, lookup, metadata
from refrain.sources import tables
from refrain.sources.scratch import scratch_path, settle

FIELDS = ["song_title", "artist_name"]
SLOTS = len(ALPHABET)


def _names(df, source, record_id, artist):
    named = df.select(
        record_id.alias("track_id"), F.col("text").alias("song_title"), F.col(artist).alias("artist_name")
    )
    return relational.add_name_key(relational.remove_noise(relational.remove_noise(named, "song_title"), "artist_name"), source)


def music(t):
    return _names(t.documents, "music", F.col("doc_id"), "source")


def stored_names(t):
    """Both name tables written once, as the jobs after the cleaning read them."""
    return settle(music(t), "music_names"), settle(video(t), "video_names")


def video(t):
    return _names(t.conversations, "video", F.concat_ws("_", "conv_id", "turn"), "role")


# Both catalogues cleaned and keyed, then counts, IDF and weights per character.
_NAMES_SQL = f"""
    cleaned AS (
        SELECT 'left' AS side, 'm' || doc_id AS id, {sql_clean('text')} AS t, {sql_clean('source')} AS a FROM documents
        UNION ALL
        SELECT 'right', 't' || conv_id || '_' || turn, {sql_clean('text')}, {sql_clean('role')} FROM conversations),
    named AS (SELECT *, {sql_key('t')} AS b FROM cleaned WHERE t <> '' AND a <> ''),
    counted AS (
        SELECT side, id, b,
            list_transform(range(1, {SLOTS + 1}), lambda i: len(t) - len(replace(t, substring('{ALPHABET}', i, 1), ''))) AS tc,
            list_transform(range(1, {SLOTS + 1}), lambda i: len(a) - len(replace(a, substring('{ALPHABET}', i, 1), ''))) AS ac
        FROM named),
    found AS (
        SELECT b, s, count(*) AS m, count(*) FILTER (tc[s] > 0) AS tdf, count(*) FILTER (ac[s] > 0) AS adf
        FROM counted, range(1, {SLOTS + 1}) r(s) GROUP BY b, s)
"""

_LINK_SQL = f"""
    {_NAMES_SQL},
    idf AS (
        SELECT b, list(ln((m + 1) / (tdf + 1)) ORDER BY s) AS ti, list(ln((m + 1) / (adf + 1)) ORDER BY s) AS ai
        FROM found GROUP BY b),
    weighted AS (
        SELECT side, id, b, list_transform(list_zip(tc, ti), lambda p: p[1] * p[2]) AS tw,
               list_transform(list_zip(ac, ai), lambda p: p[1] * p[2]) AS aw
        FROM counted JOIN idf USING (b)),
    normed AS (SELECT *, sqrt(list_dot_product(tw, tw)) AS tn, sqrt(list_dot_product(aw, aw)) AS an FROM weighted)
"""

_SCORES_SQL = """
    CASE WHEN l.tn * r.tn = 0 THEN -1 ELSE list_dot_product(l.tw, r.tw) / (l.tn * r.tn) END AS title_simi,
    CASE WHEN l.an * r.an = 0 THEN -1 ELSE list_dot_product(l.aw, r.aw) / (l.an * r.an) END AS artist_simi
"""

_BEST_SQL = f"""
    {_LINK_SQL},
    scored AS (
        SELECT l.id AS music_track_id, r.id AS video_track_id, l.b AS name_key_1, {_SCORES_SQL}
        FROM normed l JOIN normed r ON l.b = r.b WHERE l.side = 'left' AND r.side = 'right'),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY music_track_id
            ORDER BY round(title_simi + artist_simi, 9) DESC, video_track_id) AS rn FROM scored),
    best AS (
        SELECT music_track_id, video_track_id, name_key_1, round(title_simi, 6) AS title_simi,
               round(artist_simi, 6) AS artist_simi, round(title_simi + artist_simi, 6) AS total_simi
        FROM ranked WHERE rn = 1)
"""


def _rounded_scores(df):
    scores = ["title_simi", "artist_simi", "total_simi"]
    return df.select(*[F.round(c, 6).alias(c) if c in scores else c for c in df.columns])


@query(
    f"""
    WITH counted AS (
        SELECT doc_id, lower(text) AS t FROM documents
    ), long AS (
        SELECT doc_id, substring('{ALPHABET}', CAST(s AS INT), 1) AS term,
               len(t) - len(replace(t, substring('{ALPHABET}', CAST(s AS INT), 1), '')) AS tf
        FROM counted, range(1, {SLOTS + 1}) r(s)
    )
    SELECT doc_id, 'text' AS field, term, tf FROM long WHERE tf > 0
    """
)
def term_counts(t):
    return weights.term_counts(t.documents.select("doc_id", "text"), ["doc_id"], ["text"])


@query(
    r"""
    SELECT doc_id, 'text' AS field, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\w+')) AS term FROM documents) GROUP BY doc_id, term
    """
)
def word_counts(t):
    return weights.term_counts(t.documents.select("doc_id", "text"), ["doc_id"], ["text"], mode="word")


@query(
    f"""
    WITH {_NAMES_SQL}
    SELECT b AS name_key_1, 'song_title' AS field, substring('{ALPHABET}', CAST(s AS INT), 1) AS term, tdf AS df,
           m AS block_rows, round(ln((m + 1) / (tdf + 1)), 6) AS idf FROM found WHERE tdf > 0
    UNION ALL
    SELECT b, 'artist_name', substring('{ALPHABET}', CAST(s AS INT), 1), adf, m, round(ln((m + 1) / (adf + 1)), 6)
    FROM found WHERE adf > 0
    """
)
def block_idf(t):
    both = relational.union_sides({"left": music(t), "right": video(t)})
    idf = weights.term_idf(both, "name_key_1", "track_id", FIELDS)
    return idf.withColumn("idf", F.round("idf", 6))


@query(
    r"""
    WITH long AS (
        SELECT lang, doc_id, term, count(*) AS tf
        FROM (SELECT lang, doc_id, unnest(regexp_extract_all(lower(text), '\w+')) AS term FROM documents)
        GROUP BY lang, doc_id, term
    ), sizes AS (SELECT lang, count(*) AS m FROM documents GROUP BY lang),
    found AS (SELECT lang, term, count(*) AS df FROM long GROUP BY lang, term)
    SELECT l.lang, l.doc_id, 'text' AS field, l.term, round(tf * ln((m + 1) / (df + 1)), 6) AS weight
    FROM long l JOIN sizes s ON l.lang = s.lang JOIN found f ON l.lang = f.lang AND l.term = f.term
    """
)
def word_weights(t):
    docs = t.documents.select("lang", "doc_id", "text")
    long = weights.term_weights(docs, "lang", "doc_id", ["text"], mode="word", frequent_from=50)
    return long.withColumn("weight", F.round("weight", 6))


@query(
    f"""
    WITH {_LINK_SQL}
    SELECT b AS name_key_1, id AS track_id, 'song_title' AS field, substring('{ALPHABET}', CAST(s AS INT), 1) AS term,
           round(w, 6) AS weight
    FROM (SELECT b, id, unnest(range(1, {SLOTS + 1})) AS s, unnest(tc) AS c, unnest(tw) AS w FROM
          (SELECT w.b, w.id, c.tc, w.tw FROM weighted w JOIN counted c ON w.id = c.id)) WHERE c > 0
    UNION ALL
    SELECT b, id, 'artist_name', substring('{ALPHABET}', CAST(s AS INT), 1), round(w, 6)
    FROM (SELECT b, id, unnest(range(1, {SLOTS + 1})) AS s, unnest(ac) AS c, unnest(aw) AS w FROM
          (SELECT w.b, w.id, c.ac, w.aw FROM weighted w JOIN counted c ON w.id = c.id)) WHERE c > 0
    """
)
def tfidf_weights(t):
    both = relational.union_sides({"left": music(t), "right": video(t)})
    long = weights.term_weights(both, "name_key_1", "track_id", FIELDS)
    return long.withColumn("weight", F.round("weight", 6))


@query(
    f"""
    WITH {_BEST_SQL}
    SELECT music_track_id, video_track_id, name_key_1, round(title_simi, 6) AS title_simi, round(artist_simi, 6) AS artist_simi,
           round(title_simi + artist_simi, 6) AS total_simi
    FROM ranked WHERE rn <= 2
    """
)
def pair_scores(t):
    """The best match and the runner-up of every record, scored as given pairs."""
    left, right = stored_names(t)
    pairs = linkage.link(left, right, k=2, prune=False).select("music_track_id", "video_track_id")
    return _rounded_scores(linkage.score_pairs(settle(pairs, "pairs"), left, right))


@query(f"WITH {_BEST_SQL} SELECT * FROM best")
def best_match_linkage(t):
    return _rounded_scores(linkage.link(music(t), video(t)))


@query(f"WITH {_BEST_SQL} SELECT * FROM best")
def best_match_linkage_pruned(t):
    return _rounded_scores(linkage.link(music(t), video(t), root=2.0, cell_items=8, tile_queries=64))


@query(
    """
    WITH point AS (SELECT arg_min(embedding, vec_id) AS p FROM embeddings WHERE label = 3),
    d AS (SELECT vec_id, list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), CAST(p AS DOUBLE[])),
              lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
          FROM embeddings, point WHERE label = 3)
    SELECT vec_id, round(distance, 6) AS distance FROM d ORDER BY distance, vec_id LIMIT 5
    """
)
def nearest_in_group(t):
    own = t.embeddings.where(F.col("label") == 3)
    point = own.agg(F.min_by("embedding", "vec_id")).first()[0]
    hits = neighbours.nearest_to_point(t.embeddings, point, "vec_id", "embedding", 5, group=("label", 3))
    return hits.withColumn("distance", F.round("distance", 6))


@query(
    """
    WITH points AS (SELECT label, arg_min(embedding, vec_id) AS p FROM embeddings GROUP BY label),
    d AS (SELECT e.label, vec_id, list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), CAST(p AS DOUBLE[])),
              lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
          FROM embeddings e JOIN points q ON e.label = q.label)
    SELECT label, vec_id, round(distance, 6) AS distance, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 5
    """
)
def nearest_per_group(t):
    points = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("point"))
    hits = neighbours.nearest_to_one_per_group(t.embeddings, points, "label", "vec_id", "embedding", "point")
    return hits.withColumn("distance", F.round("distance", 6))


@query(
    """
    WITH d AS (
        SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_sum(list_transform(
            list_zip(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
        FROM embeddings q JOIN embeddings v ON q.label = v.label)
    SELECT query_id, vec_id, round(distance, 6) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 9), vec_id) AS rank FROM d)
    WHERE rank <= 5
    """
)
def nearest_of_every_vector(t):
    queries = t.embeddings.withColumnRenamed("vec_id", "query_id")
    found = neighbours.nearest(queries, t.embeddings, "label", "query_id", "vec_id", "embedding", k=5)
    return found.select("query_id", "vec_id", F.round("distance", 6).alias("distance"))


@query(
    """
    WITH d AS (
        SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_sum(list_transform(
            list_zip(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])),
            lambda z: (z[1] - z[2]) * 1e-6 * (z[1] - z[2]) * 1e-6)) AS distance
        FROM embeddings q JOIN embeddings v ON q.label = v.label)
    SELECT query_id, vec_id, round(distance, 18) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 22), vec_id) AS rank FROM d)
    WHERE rank <= 3
    """
)
def nearest_small_vectors_pruned(t):
    """Vectors times 1e-6, in cells small enough for some to be skipped at any size of the tables."""
    small = t.embeddings.select("label", "vec_id", F.transform("embedding", lambda x: x.cast("double") * 1e-6).alias("v"))
    queries = small.withColumnRenamed("vec_id", "query_id")
    found = neighbours.nearest(
        queries, small, "label", "query_id", "vec_id", "v", k=3, prune=True, root=2.0, cell_items=8, tile_queries=64
    )
    return found.select("query_id", "vec_id", F.round("distance", 18).alias("distance"))


@query(
    f"""
    WITH {_BEST_SQL},
    point AS (SELECT arg_min(embedding, vec_id) AS p FROM embeddings WHERE label = 3),
    hits AS (
        SELECT 'm' || vec_id AS music_track_id FROM (
            SELECT vec_id, list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), CAST(p AS DOUBLE[])),
                lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
            FROM embeddings, point WHERE label = 3 ORDER BY distance, vec_id LIMIT 5))
    SELECT music_track_id, b.video_track_id, b.name_key_1, b.title_simi, b.artist_simi, b.total_simi,
           'v' || c.conv_id || '/' || c.turn AS video_url, 'cover ' || (c.turn + 1) AS covers,
           lower(regexp_replace(c.role, '[^a-zA-Z0-9]', '', 'g')) AS artist_name
    FROM hits JOIN best b USING (music_track_id)
    JOIN conversations c ON b.video_track_id = 't' || c.conv_id || '_' || c.turn
    """
)
def videos_for_vector(t):
    return found_videos(t, stored_lookup(t))


def stored_lookup(t):
    """What lookups read, written once: names by id, best pairs and videos by block and id.

    The names of music hold the whole texts; they are cleaned straight into the table that lookups read, and linked from there.
    """
    paths = {name: scratch_path(t.spark, name) for name in ("names", "pairs", "videos")}
    lookup.store(music(t), paths["names"], "track_id", block=None)
    left, right = tables.read_table(t.spark, paths["names"]).drop("part"), settle(video(t), "video_names")
    spoken = F.split(F.substring_index("track_id", "t", -1), "_")
    url = F.concat(F.lit("v"), spoken[0], F.lit("/"), spoken[1])
    covers = F.transform(F.array(F.lit(0), F.lit(1)), lambda n: F.concat(F.lit("cover "), n + spoken[1].cast("int")))
    clips = right.select("track_id", "name_key_1", "artist_name", url.alias("video_url"), F.explode(covers).alias("covers"))
    lookup.store(_rounded_scores(linkage.link(left, right)), paths["pairs"], "music_track_id")
    lookup.store(clips, paths["videos"], "track_id")
    return paths


def found_videos(t, paths):
    """Videos with music like one vector, from stored tables alone."""
    stored = {name: tables.read_table(t.spark, path) for name, path in paths.items()}
    vectors = t.embeddings.select(
        F.col("vec_id").alias("track_id"), F.col("label").alias("genre"), F.col("embedding").alias("features")
    )
    point = t.embeddings.where(F.col("label") == 3).agg(F.min_by("embedding", "vec_id")).first()[0]
    songs = lookup.similar_songs(vectors, stored["names"], 3, point)
    found = lookup.videos_of_songs(songs, stored["pairs"], stored["videos"])
    keys = ["music_track_id", "video_track_id", "name_key_1", "title_simi", "artist_simi", "total_simi"]
    last = lookup.covers_by_url(found.select(*keys, "video_url", "artist_name", "covers"), keys, ["covers"])
    return last.select(*keys, "video_url", "covers", "artist_name")


@query(
    f"""
    WITH named AS (
        SELECT doc_id, {sql_clean('text')} AS song_title, {sql_clean('source')} AS artist_name, source,
               CASE WHEN lang = 'es' THEN '' ELSE CAST(doc_id % 30 AS VARCHAR) END AS genre_1 FROM documents
    ), kept AS (
        SELECT * FROM named WHERE song_title <> '' AND artist_name <> ''
        QUALIFY row_number() OVER (PARTITION BY song_title, artist_name ORDER BY doc_id) = 1
    )
    SELECT 'm' || doc_id AS track_id, song_title, artist_name, source AS original_artist_name, genre_1,
           n_name AS subgenre_name, CAST(n_regionkey AS VARCHAR) AS top_level, {sql_key('song_title')} AS name_key_1
    FROM kept LEFT JOIN nation ON genre_1 = CAST(n_nationkey AS VARCHAR)
    """
)
def metadata_build(t):
    listed = F.when(F.col("lang") == "es", "[]").otherwise(
        F.concat(F.lit("["), F.col("doc_id") % 30, F.lit(", "), F.col("n_chars"), F.lit("]"))
    )
    songs = metadata.with_first_genre(
        t.documents.select(F.col("doc_id").alias("track_id"), F.col("text").alias("title"), listed.alias("genres"))
    )
    artists = t.documents.select(F.col("doc_id").alias("track_id"), F.col("source").alias("name"))
    return metadata.clean_music_table(songs, artists, _genres(t)).drop("original_song_title")


def _genres(t):
    return relational.as_strings(
        t.nation.select(
            F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("top_level")
        )
    )


@query(
    f"""
    WITH named AS (
        SELECT CAST(p_partkey AS VARCHAR) AS id, {sql_clean('p_name')} AS song_title, {sql_clean('p_brand')} AS artist_name,
               p_name, p_brand, CAST(p_size % 30 AS VARCHAR) AS genre_1 FROM part
    ), kept AS (
        SELECT * FROM named WHERE song_title <> '' AND artist_name <> ''
        QUALIFY row_number() OVER (PARTITION BY song_title, artist_name ORDER BY id) = 1
    )
    SELECT 'm' || id AS track_id, song_title, artist_name, p_name AS original_song_title,
           p_brand AS original_artist_name, genre_1, n_name AS subgenre_name,
           CAST(n_regionkey AS VARCHAR) AS top_level, {sql_key('song_title')} AS name_key_1
    FROM kept LEFT JOIN nation ON genre_1 = CAST(n_nationkey AS VARCHAR)
    """
)
def metadata_from_grouped_csv(t):
    songs, artists = metadata.split_tracks(grouped_parts(t))
    return metadata.clean_music_table(songs, artists, _genres(t))


@query(
    f"""
    WITH named AS (
        SELECT page_id, url, {sql_clean("split_part(url, '/', 3)")} AS artist_name, {sql_clean('html')} AS song_title
        FROM pages
    )
    SELECT 't' || (page_id % 7) AS track_id, page_id AS video_id, url AS video_url, artist_name,
           length(song_title) AS title_length, {sql_key('song_title')} AS name_key_1
    FROM named WHERE song_title <> '' AND artist_name <> ''
    """
)
def video_names(t):
    flat = t.pages.select(
        F.col("page_id").alias("video_id"),
        F.col("url").alias("video_url"),
        (F.col("page_id") % 7).alias("music_id"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("music_artist"),
        F.col("html").alias("music_song"),
    )
    named = metadata.video_name_table(flat)
    return named.select(
        "track_id", "video_id", "video_url", "artist_name", F.length("song_title").alias("title_length"), "name_key_1"
    )


@query(
    """
    WITH clips AS (SELECT user_id, event_type AS video_url, props AS video_covers, ts, event_id FROM events)
    SELECT user_id, video_url, arg_max(video_covers, (ts, event_id)) AS video_covers, max(ts) AS ts,
           arg_max(event_id, (ts, event_id)) AS event_id
    FROM clips GROUP BY user_id, video_url
    """
)
def covers_by_url(t):
    clips = t.events.select(
        "user_id", F.col("event_type").alias("video_url"), F.col("props").alias("video_covers"), "ts", "event_id"
    )
    return lookup.covers_by_url(clips, ["user_id"], ["ts", "event_id"])
