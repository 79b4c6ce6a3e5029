"""Queries over the smallest tables against their SQL, and the pipeline against plain Python."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from refrain.llm import queries
from tests.compare import connection, difference
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, oracle, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert difference(df, oracle, queries.ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    forbidden = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]
    if name.startswith(("op1_", "op9_")):
        forbidden += ["Python", "Arrow", "Pandas"]
    assert not [x for x in forbidden if x in plan]


def documents(oracle):
    return oracle.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def test_languages_of_held_out_documents(spark, oracle):
    langs = {r[0]: r[2] for r in documents(oracle)}
    rows = queries.QUERIES["op2_language"](spark, FOLDER).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([langs[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_personal_data_keeps_the_base(spark, oracle):
    from tests.llm.test_operators import plain_spans

    texts = {r[0]: r[1] for r in documents(oracle)}
    for row in queries.QUERIES["op4_personal_data"](spark, FOLDER).collect():
        base = plain_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row.spans.split(","))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s.startswith(k) for s in base) for k in ("email", "ip", "card", "phone")
        ]


def test_pieces_equal_the_library(spark, oracle):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    texts = {r[0]: r[1] for r in documents(oracle)}
    for row in queries.QUERIES["op7_sentencepiece"](spark, FOLDER).collect():
        assert row.tokens == model.encode(texts[row.doc_id])
        assert row.n_tokens == len(row.tokens)
        assert row.text_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_pipeline_equals_plain_python(spark, oracle):
    rows = documents(oracle)
    judged = plain.quality([(r[0], r[3], r[1]) for r in rows])
    kept = [(r[0], text) for r, (keep, text) in zip(rows, judged) if keep]
    kept = [(i, text) for (i, _), (text, _, _) in zip(kept, plain.drop_lines(kept))]
    first, _ = plain.near_components(kept, 5)
    kept = [row for n, row in enumerate(kept) if first[n] == n]
    items = oracle.execute("SELECT item_id, text FROM benchmark").fetchall()
    items = [(str(i), text) for i, text in items]
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    wanted = {}
    for i, text in kept:
        n, hit, _ = plain.contamination(text, items)
        if not hit or 20 * len(hit) < n:
            text = plain.without_words(text, hit)
            wanted[i] = (text, len(text), model.encode(text))
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "tokens"]
    assert {r.doc_id: (r.text, r.n_chars, r.tokens) for r in found.collect()} == wanted


def test_last_stage_decodes(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
    texts = {1: "Ein  Text\n", 2: "a▁b é😀", 3: "", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lang", "source")})
    found = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert found.columns == [*docs.columns, "tokens"]
    wanted = {i: (None, None) if t is None else (model.encode(t), t.replace("▁", " ")) for i, t in texts.items()}
    assert {r.doc_id: (r.tokens, r.text) for r in found.collect()} == wanted


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and an empty ``benchmark`` through all stages; then no documents at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(80))
    other = "\n".join(f"a{i} b{i} c{i} d{i}" for i in range(20))
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, text, None, None, 1), (3, text, None, None, 1), (None, other, "en", "a", 5), (None, None, None, None, None)]
    wanted = {3: text, None: other}
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for name, docs in (("some", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(docs, schema).repartition(2).write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert {r.doc_id: r.text for r in found} == (wanted if docs else {}) and len(found) == (2 if docs else 0)
        assert all(r.tokens and r.n_chars == len(r.text) for r in found)


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), FOLDER).schema.names == docs.columns
