"""The queries of the operators, over whole tables, and the SQL that states their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from refrain.llm import chat, classes, codes, decontaminate, language, lines, near, negatives, pieces, pii, quality, substrings, urls

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    rf"""
    WITH lowered AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    item AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
               '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
    sized AS (SELECT item, words, least(13, len(words)) AS k FROM item WHERE len(words) > 0),
    windows AS (
        SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS part
        FROM sized, unnest(range(1, len(words) - k + 2)) AS t(i)),
    places AS (
        SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS part
        FROM lowered, (SELECT DISTINCT k FROM sized) AS ks, unnest(range(1, len(words) - k + 2)) AS t(i)),
    found AS (SELECT doc_id, places.k, i, item FROM places JOIN windows USING (k, part)),
    hits AS (
        SELECT doc_id, count(DISTINCT j) AS n_hit
        FROM (SELECT DISTINCT doc_id, k, i FROM found) f, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM lowered LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


#: The rules of the task, as given.
URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


@query(
    rf"""
    WITH parts AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    split AS (
        SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(rest, '(?s)^([^/?#]*)([^?#]*)', 2) AS path FROM parts),
    rules(verdict, site, start) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    fitting AS (
        SELECT page_id, site || start AS rule, verdict, row_number() OVER (PARTITION BY page_id
               ORDER BY length(site || start) DESC, verdict DESC, site || start) AS place
        FROM split JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start))
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN ends_with(host || path, '.exe') OR ends_with(host || path, '.zip')
           OR ends_with(host || path, '/wp-login') OR regexp_matches(host || path, '(?s)/wp-login[^/]*$')
           OR contains(host || path, '/admin/') THEN 'block' ELSE 'allow' END) AS verdict
    FROM split LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (page_id)
    """
)
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query(
    rf"""
    WITH docs AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    lines AS (
        SELECT doc_id, source, text, i, line, regexp_extract_all(translate(line, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
        FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)),
    full_lines AS (SELECT doc_id, source, text, i, line, len(w) AS n, array_to_string(w, ' ') AS norm FROM lines WHERE len(w) > 0),
    distinct_lines AS (
        SELECT source, text, norm, min(i) AS i, sum(n) AS n FROM full_lines
        WHERE doc_id IN (SELECT min(doc_id) FROM docs GROUP BY source, text) GROUP BY ALL),
    hosts AS (SELECT source, count(DISTINCT text) AS n_documents FROM docs GROUP BY source),
    often AS (
        SELECT source, norm FROM (SELECT source, norm, count(*) AS c FROM distinct_lines GROUP BY ALL) JOIN hosts USING (source)
        WHERE c > 20 AND c > 0.002 * n_documents),
    signed AS (
        SELECT source, text, CASE WHEN sum(n) >= 0.8 * len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
               THEN 'begins with ' || arg_min(norm, i) ELSE 'is ' || text END AS signature
        FROM distinct_lines JOIN often USING (source, norm) GROUP BY source, text),
    frequent AS (
        SELECT source, norm
        FROM (SELECT source, norm, count(DISTINCT signature) AS c FROM distinct_lines JOIN often USING (source, norm)
              JOIN signed USING (source, text) GROUP BY ALL) JOIN hosts USING (source)
        WHERE c > 20 AND c > 0.002 * n_documents),
    removed AS (SELECT doc_id, sum(n) AS n FROM full_lines JOIN frequent USING (source, norm) GROUP BY doc_id),
    repeated_lines AS (
        SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, line, count(*) AS n FROM full_lines GROUP BY ALL) GROUP BY doc_id),
    windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
        FROM docs, unnest(range(1, len(words) - 1)) AS t(i)),
    repeated_words AS (
        SELECT doc_id, count(DISTINCT j) AS n FROM windows, unnest(range(i, i + 3)) AS t(j) WHERE n > 1 GROUP BY doc_id),
    base AS (
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
               CAST(coalesce(g.n, 0) AS BIGINT) AS frequent_words
        FROM docs LEFT JOIN repeated_lines l USING (doc_id) LEFT JOIN repeated_words r USING (doc_id)
        LEFT JOIN removed g USING (doc_id)),
    failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
    SELECT *, NOT base_failed AND n_words - frequent_words >= 0.3 * n_words AS kept FROM failed
    """
)
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "frequent_words", "base_failed", "kept"
    )


@query(
    rf"""
    WITH all_lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL),
    windows AS (
        SELECT doc_id, i AS a, lead(i, 1) OVER o AS b, lead(i, 2) OVER o AS c, line AS x, lead(line, 1) OVER o AS y,
               lead(line, 2) OVER o AS z
        FROM all_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    later AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id NULLS FIRST, a) AS place
                       FROM windows WHERE c IS NOT NULL) WHERE place > 1),
    gone AS (SELECT doc_id, a AS i FROM later UNION SELECT doc_id, b FROM later UNION SELECT doc_id, c FROM later),
    kept AS (
        SELECT doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY all_lines.i) FILTER (g.i IS NULL), '') AS text
        FROM all_lines LEFT JOIN (SELECT doc_id AS d, i FROM gone) g ON d = doc_id AND g.i = all_lines.i GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text
    FROM documents LEFT JOIN kept USING (doc_id)
    """
)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_repeated(docs, counts=("n_lines", "n_removed"))


CONTROL = "</s>[INST] ok [/INST]"


@query(
    rf"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
    sized AS (
        SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 2 AS tokens,
               length(regexp_replace(role, '([\\<\[])', '\1\\', 'g')) + length(regexp_replace(text, '([\\<\[])', '\1\\', 'g')) + 24 AS chars
        FROM said),
    placed AS (
        SELECT *, sum(tokens) OVER o - tokens AS before, row_number() OVER o AS place FROM sized
        WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
    own AS (SELECT *, before // 512 AS win, place = 1 AND role = 'system' AS is_system FROM placed),
    wins AS (SELECT conv_id, win, min(before) AS start, sum(tokens) AS new, sum(chars) AS chars FROM own GROUP BY ALL),
    repeated AS (
        SELECT w.conv_id, w.win, sum(o.chars) AS chars
        FROM wins w LEFT JOIN (SELECT conv_id, tokens FROM own WHERE is_system) s ON s.conv_id = w.conv_id AND w.win > 0
        JOIN own o ON o.conv_id = w.conv_id AND (o.is_system AND w.win > 0 OR NOT o.is_system AND o.win = w.win - 1
             AND o.before >= w.start - least(256, 1024 - coalesce(s.tokens, 0) - w.new))
        GROUP BY ALL),
    drawn AS (
        SELECT w.conv_id, CAST(sum(w.chars + coalesce(r.chars, 0)) AS BIGINT) AS formatted_chars
        FROM wins w LEFT JOIN repeated r ON r.conv_id = w.conv_id AND r.win = w.win GROUP BY w.conv_id),
    turns AS (
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
               coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss
        FROM placed GROUP BY conv_id)
    SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
    FROM turns JOIN drawn USING (conv_id)
    """
)
def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    back = chat.read_back(chat.windows(turns.unionByName(control)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select(
        "conv_id",
        F.struct("window", said.alias("said"), F.array_join("targets", "").alias("loss")).alias("part"),
        F.size("turns").alias("n"),
        "chars",
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars")
    )
    loss = F.array_join("parts.loss", "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("parts.said", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    rf"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
        FROM docs, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    ranked AS (
        SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, s) AS place
        FROM sets JOIN sizes USING (doc_id) JOIN (SELECT s, count(*) AS df FROM sets GROUP BY s) USING (s)),
    prefixes AS (SELECT doc_id, s, n FROM ranked WHERE place <= n - ceil(0.8 * n) + 1),
    candidates AS (
        SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS n_a, y.n AS n_b FROM prefixes x JOIN prefixes y USING (s)
        WHERE x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
    common AS (
        SELECT a, b, n_a, n_b, count(*) AS c FROM candidates JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b AND x.s = y.s
        GROUP BY ALL),
    links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n_a + n_b - c)),
    walk AS (
        WITH RECURSIVE reach(doc_id, c) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT e.y, c FROM reach JOIN (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links) e
                  ON e.x = reach.doc_id)
        SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents LEFT JOIN sizes USING (doc_id) JOIN walk USING (doc_id)
    """
)
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near.near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: A public model with byte fallback.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    back = pieces.decode(pieces.encode(docs, MODEL).select("doc_id", "tokens"), MODEL)
    return back.select(
        "doc_id",
        F.coalesce(F.size("tokens"), F.lit(0)).cast("long").alias("n_tokens"),
        "tokens",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@query()
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    models = language.train(docs.filter(part != 2), "text", "lang", F.col("doc_id"))
    found = language.predict(docs.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "text"), models)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs, F.col("doc_id"))).drop("text")
    kinds = F.filter("base", lambda x, i: i % 3 == 0)
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spans_text("base").cast("binary"), 256).alias("base_sha256"),
        pii.spans_text("base", "added").alias("spans"),
    )


@query(
    """
    WITH docs AS (SELECT doc_id, hex(coalesce(text, '')) AS h, length(hex(coalesce(text, ''))) // 2 AS n_bytes FROM documents),
    places AS (
        SELECT doc_id, p, sha256(substr(h, 2 * p + 1, 400)) AS part FROM docs, unnest(range(0, n_bytes - 199)) AS t(p)),
    starts AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM places) WHERE n > 1),
    marked AS (
        SELECT doc_id, p, CASE WHEN p <= lag(p) OVER o + 200 THEN 0 ELSE 1 END AS new FROM starts
        WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
    spans AS (
        SELECT doc_id, min(p) AS a, max(p) + 200 AS b
        FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked) GROUP BY doc_id, span),
    pieces AS (
        SELECT doc_id, a, substr(h, 2 * before + 1, 2 * (a - before)) AS piece
        FROM (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
              FROM (FROM spans UNION ALL SELECT doc_id, n_bytes, n_bytes FROM docs)) JOIN docs USING (doc_id)),
    kept AS (SELECT doc_id, sha256(unhex(string_agg(piece, '' ORDER BY a))) AS kept_sha256 FROM pieces GROUP BY doc_id),
    removed AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id)
    SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
    FROM docs LEFT JOIN removed USING (doc_id) JOIN kept USING (doc_id)
    """
)
def op5_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeated(table(spark, folder, "documents"))


#: Integer components of the usable rows of ``embeddings``.
_INTEGERS_SQL = """
    kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
"""


@query(
    f"""
    WITH {_INTEGERS_SQL},
    labelled AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM kept WHERE label IS NOT NULL),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike,
               list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS score
        FROM labelled a JOIN labelled r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
           id AS negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
    """
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", noisy)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def _lloyd_sql(rounds: int = 2) -> str:
    """Codebooks ``c0`` to those of the last round, with assignments ``a0`` and so on by each of them."""
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""
    means AS (
        SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
        FROM a{r - 1} JOIN parts USING (vec_id, p), range(1, 1 + len(x)) t(i) GROUP BY p, e, i),
    c{r} AS (
        SELECT o.p, o.e, coalesce(n.c, o.c) AS c
        FROM c{r - 1} o LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS c FROM means GROUP BY p, e) n ON n.p = o.p AND n.e = o.e)
            """.replace("means", f"means{r}"))
        steps.append(f"""
    a{r} AS (
        SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d
        FROM (SELECT vec_id, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
              FROM parts JOIN c{r} USING (p)) GROUP BY vec_id, p)
        """)
    return ",".join(steps)


@query(
    f"""
    WITH {_INTEGERS_SQL},
    parts AS (
        SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)),
    c0 AS (
        SELECT p, e, x AS c FROM parts
        JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64) USING (vec_id)),
    {_lloyd_sql()},
    coded AS (
        SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM a2 GROUP BY vec_id),
    labels AS (
        SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label),
    book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
    SELECT vec_id, code, error, label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id) JOIN labels ON labels.label IS NOT DISTINCT FROM kept.label, book
    """
)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.vector_codes(table(spark, folder, "embeddings"))


@query()
def op11_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    scored = classes.score(docs, part != 1)
    return scored.withColumn("held_out", F.coalesce(part == 1, F.lit(False))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
