"""Sources and sinks: tables are written to the shared folder, read back and compared with their origin."""

from pyspark.sql import functions as F

from checks.registry import query
from refrain.functions import text
from refrain.sources import grouped_csv, tables, videos
from refrain.sources.scratch import scratch_path


@query("SELECT * FROM supplier")
def table_scan(t):
    return tables.read_table(t.spark, f"{t.folder}/supplier.parquet")


@query("SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'ECONOMY'")
def partition_scan(t):
    path = scratch_path(t.spark, "part_by_type")
    tables.append_partitioned(t.part, path, "p_type")
    return tables.read_partition(t.spark, path, "p_type", "ECONOMY").select("p_partkey", "p_name", "p_type")


@query("SELECT o_orderstatus, 2 * count(*) AS row_count FROM orders GROUP BY o_orderstatus")
def partitioned_append(t):
    path = scratch_path(t.spark, "orders_by_status")
    for _ in range(2):
        tables.append_partitioned(t.orders, path, "o_orderstatus")
    written = tables.read_table(t.spark, path)
    return written.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT l_returnflag, 2 * count(*) AS row_count, min(l_orderkey) AS first_key FROM lineitem GROUP BY l_returnflag")
def plain_append(t):
    path = scratch_path(t.spark, "lines")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    for _ in range(2):
        tables.append_table(lines, path, rows_per_file=200_000)
    written = tables.read_table(t.spark, path)
    return written.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("l_orderkey").alias("first_key")
    )


@query(
    """
    SELECT 'batch-' || (o_orderkey % 3) AS batch_id, o_orderstatus, count(*) AS row_count FROM orders
    GROUP BY ALL
    """
)
def repeated_batches(t):
    """Batches of orders by status, two of them written twice."""
    path = scratch_path(t.spark, "orders_by_batch")
    for batch in (0, 1, 2, 1, 0):
        tables.write_batch(t.orders.where(F.col("o_orderkey") % 3 == batch), path, f"batch-{batch}", "o_orderstatus")
    written = tables.read_table(t.spark, path)
    return written.groupBy("batch_id", "o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT count(*) AS written, count(*) AS read_back FROM lineitem WHERE l_returnflag = 'R'")
def counted_append(t):
    """The number of rows from the job that writes them, beside what is read back."""
    path = scratch_path(t.spark, "returned")
    rows = tables.append_counted(t.lineitem.where(F.col("l_returnflag") == "R"), path)
    return tables.read_table(t.spark, path).agg(F.lit(rows).cast("long").alias("written"), F.count(F.lit(1)).alias("read_back"))


@query(
    """
    SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings WHERE label = 3
    """
)
def table_split_by_key(t):
    path = scratch_path(t.spark, "vectors_by_label")
    tables.append_partitioned(t.embeddings, path, "label")
    own = tables.read_partition(t.spark, path, "label", 3)
    return own.select("vec_id", "label", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"))


@query(
    """
    WITH codes AS (SELECT * FROM (VALUES ('click', 1), ('view', 2), ('purchase', 3)) c(event_type, code))
    SELECT code, count(*) AS row_count, min(event_id) AS first_id FROM events JOIN codes USING (event_type) GROUP BY code
    """
)
def local_dimension(t):
    codes = tables.local_rows(
        t.spark, [("click", 1), ("view", 2), ("purchase", 3)], "event_type string, code int"
    )
    return (
        t.events.select("event_type", "event_id")
        .join(codes, "event_type")
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_id"))
    )


def write_grouped_csv(parts, path):
    """Parts as a two-level-header CSV with the header and the index row in every file."""
    header = [",album,artist,track,track", ",price,name,title,genres", "track_id,,,,"]
    files = 4
    lines = parts.select(
        F.pmod(F.xxhash64("p_partkey"), F.lit(files)).alias("file"),
        F.lit(len(header)).alias("place"),
        F.to_csv(
            F.struct(
                "p_partkey",
                F.when(F.col("p_size") % 5 == 0, F.lit("nan")).otherwise(F.col("p_retailprice").cast("string")).alias("c1"),
                "p_brand",
                "p_name",
                F.concat(F.lit("["), F.col("p_size") % 30, F.lit(", "), F.col("p_size"), F.lit("]")).alias("c4"),
            )
        ).alias("line"),
    )
    heads = parts.sparkSession.range(files).select(
        F.col("id").alias("file"), F.posexplode(F.array(*map(F.lit, header))).alias("place", "line")
    )
    placed = heads.unionByName(lines).repartition(files, "file").sortWithinPartitions("file", "place")
    placed.select("line").write.text(path)


def grouped_parts(t, **options):
    path = scratch_path(t.spark, "tracks")
    write_grouped_csv(t.part, path)
    return grouped_csv.read_grouped_csv(t.spark, path, **options)


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_brand AS artist__name, p_name AS track__title,
           CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_retailprice AS VARCHAR) END AS album__price,
           '[' || (p_size % 30) || ', ' || p_size || ']' AS track__genres
    FROM part
    """
)
def grouped_csv_scan(t):
    return grouped_parts(t).drop(grouped_csv.CORRUPT)


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS track_id, NULLIF(NULLIF(text, 'nan'), '') AS track__text, source AS artist__source,
           NULL AS corrupt_record
    FROM documents UNION ALL SELECT NULL, 'no id', 'nobody', NULL
    UNION ALL SELECT 'x', 'short', NULL, 'x,short'
    """
)
def grouped_csv_with_line_feeds(t):
    """Texts with line feeds and quotes in eight files, more of large tables, half of them with their columns in another order."""
    path = scratch_path(t.spark, "texts")
    size = t.documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(4, -(-size // (128 << 20)))  # a task writes a file of each order: about 64 MB, however many texts there are
    texts = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    docs = t.documents.select("doc_id", texts.alias("text"), "source", F.pmod(F.xxhash64("doc_id"), F.lit(count)).alias("file"))
    extra = {"a": ["x,short"], "b": [",nobody,no id"]}
    for name, header, cells in (
        ("a", [",track,artist", ",text,source", "track_id,,"], ("text", "source")),
        ("b", [",artist,track", ",source,text", "track_id,,"], ("source", "text")),
    ):
        own = docs.where((F.col("doc_id") % 2 == 0) == (name == "a"))
        line = F.concat_ws(",", F.col("doc_id").cast("string"), *cells)
        files = t.spark.range(count).select(F.col("id").alias("file"), "id")
        first = F.when(F.col("id") == 0, F.array(*map(F.lit, header + extra[name]))).otherwise(F.array(*map(F.lit, header)))
        heads = files.select("file", F.posexplode(first).alias("place", "value"))
        placed = heads.unionByName(own.select("file", F.lit(9).alias("place"), line.alias("value")))
        placed.repartition(count, "file").sortWithinPartitions("file", "place").select("value").write.text(f"{path}/{name}")
    return grouped_csv.read_grouped_csv(t.spark, f"{path}/*", range_bytes=1 << 18)


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS track_id,
           CASE WHEN p_size % 5 = 0 THEN 'nan' ELSE CAST(p_retailprice AS VARCHAR) END AS price
    FROM part
    """
)
def grouped_csv_column_group(t):
    return grouped_csv.select_group(grouped_parts(t, keep_nan_strings=True, multi_line=False), "album")


@query(
    """
    SELECT CAST(page_id AS VARCHAR) AS video_id, CASE WHEN page_id % 3 > 0 THEN url END AS video_url,
           CASE WHEN page_id % 4 > 0 THEN 'c' || page_id END AS video_covers, 'k' || (page_id % 7) AS music_id,
           'by ' || page_id AS music_artist, html AS music_song,
           CASE WHEN page_id % 5 > 0 THEN url END AS music_url
    FROM pages
    """
)
def nested_json_scan(t):
    path = scratch_path(t.spark, "videos")
    page = F.col("page_id")
    none = F.array().cast("array<string>")
    urls = F.when(page % 3 == 0, none).otherwise(F.array("url", F.lit("second")))
    covers = F.when(page % 4 > 0, F.array(F.concat(F.lit("c"), page)))
    t.pages.select(
        F.struct(
            page.cast("string").alias("id"), F.struct(urls.alias("urls")).alias("video"), covers.alias("covers")
        ).alias("itemInfos"),
        F.struct(
            F.concat(F.lit("k"), page % 7).alias("musicId"),
            F.concat(F.lit("by "), page).alias("authorName"),
            F.col("html").alias("musicName"),
            F.when(page % 5 == 0, none).otherwise(F.array("url")).alias("playUrl"),
        ).alias("musicInfos"),
    ).write.json(path)
    return videos.flatten_videos(videos.read_videos(t.spark, path)).drop(videos.CORRUPT)


@query(
    """
    SELECT CASE WHEN page_id % 3 > 0 THEN CAST(page_id AS VARCHAR) END AS video_id,
           CASE WHEN page_id % 3 = 0 THEN '{"itemInfos": {"id": "' || page_id || '"' END AS corrupt_record
    FROM pages
    """
)
def nested_json_broken_lines(t):
    path = scratch_path(t.spark, "broken_videos")
    page = F.col("page_id").cast("string")
    start = F.concat(F.lit('{"itemInfos": {"id": "'), page, F.lit('"'))
    line = F.when(F.col("page_id") % 3 == 0, start).otherwise(F.concat(start, F.lit("}}")))
    t.pages.select(line.alias("value")).write.text(path)
    return videos.flatten_videos(videos.read_videos(t.spark, path)).select("video_id", videos.CORRUPT)


@query(
    r"""
    SELECT page_id, string_split(url, '/')[4] AS language,
           TRY_CAST(string_split(string_split(url, '/')[5], '.html')[1] AS INT) AS track_id
    FROM pages WHERE contains(url, '.html')
    """
)
def object_ids(t):
    keyed = tables.keyed_objects(t.pages.select("page_id", "url"), 4, ".html", path="url")
    return keyed.select("page_id", text.path_segment(F.col("url"), 3).alias("language"), "track_id")


@query("SELECT DISTINCT s_nationkey AS track_id, true AS has_content FROM supplier")
def object_listing(t):
    path = scratch_path(t.spark, "objects")
    suppliers = t.supplier.select("s_nationkey", F.col("s_name").alias("value"))
    suppliers.repartition("s_nationkey").write.partitionBy("s_nationkey").text(path)
    listing = tables.list_objects(t.spark, path, "*.txt")
    folder = F.regexp_extract("path", r"s_nationkey=(\d+)/", 1).cast("int")
    return listing.groupBy(folder.alias("track_id")).agg((F.sum("length") > 0).alias("has_content"))
