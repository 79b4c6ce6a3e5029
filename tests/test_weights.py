import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer
from pyspark.sql import functions as F

from refrain.functions.text import ALPHABET
from refrain.operators import weights

DOCS = [(1, "x", "aab", "q"), (2, "x", "abc", "q"), (3, "x", "zzz", "r"), (4, "x", "!!", "s"), (5, "y", "aab", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, block string, title string, artist string")


def test_idf_is_fitted_per_block(docs):
    rows = {(r.block, r.field, r.term): r for r in weights.term_idf(docs, "block", "id", ["title", "artist"]).collect()}
    assert rows["x", "title", "a"].idf == pytest.approx(math.log(5 / 3))
    assert rows["x", "title", "c"].idf == pytest.approx(math.log(5 / 2))
    assert (rows["x", "title", "z"].df, rows["x", "title", "z"].block_rows) == (1, 4)
    assert rows["y", "title", "a"].idf == 0.0
    assert ("y", "artist", "q") not in rows


def test_weights(docs):
    rows = {(r.id, r.field, r.term): r.weight for r in weights.term_weights(docs, "block", "id", ["title"]).collect()}
    assert rows[1, "title", "a"] == pytest.approx(1.0217, abs=1e-4)
    assert rows[1, "title", "b"] == pytest.approx(0.5108, abs=1e-4)


def test_word_mode_matches_char_mode_on_single_letters(spark):
    spaced = spark.createDataFrame([(i, b, " ".join(t)) for i, b, t, _ in DOCS], "id int, block string, title string")
    packed = spark.createDataFrame([(i, b, t) for i, b, t, _ in DOCS], "id int, block string, title string")
    word = {tuple(r) for r in weights.term_weights(spaced, "block", "id", ["title"], "word").collect()}
    char = {tuple(r) for r in weights.term_weights(packed, "block", "id", ["title"]).collect()}
    assert word == char


def test_weights_equal_spark_ml(spark):
    names = ["oldtownroad", "cafdelmar", "99problems", "road", "marmalade", "zzz", "oldtown", "q1w2e3"]
    df = spark.createDataFrame([(i, "x", n) for i, n in enumerate(names)], "id int, block string, title string")
    model = Pipeline(
        stages=[
            RegexTokenizer(gaps=False, pattern=r"\w", inputCol="title", outputCol="tokens"),
            CountVectorizer(minDF=1, inputCol="tokens", outputCol="tf"),
            IDF(inputCol="tf", outputCol="idf"),
        ]
    ).fit(df)
    vocabulary = model.stages[1].vocabulary
    expected = {}
    for row in model.transform(df).collect():
        for i, w in zip(row.idf.indices, row.idf.values):
            expected[row.id, vocabulary[i]] = w
    found = {(r.id, r.term): r.weight for r in weights.term_weights(df, "block", "id", ["title"]).collect()}
    assert found.keys() == expected.keys()
    for key, weight in expected.items():
        assert found[key] == pytest.approx(weight, abs=1e-12)


def test_unit_weights_have_length_one_or_zero(docs):
    counts = weights.with_char_counts(docs, ["title", "artist"])
    idf = weights.char_idf(counts, "block", ["title", "artist"])
    for row in weights.unit_weights(counts, idf, "block", ["title", "artist"]).collect():
        assert len(row.title) == len(ALPHABET)
        assert sum(w * w for w in row.title) == pytest.approx(1.0 if row.id in (1, 2, 3) else 0.0)


def test_a_word_in_every_row_is_not_shuffled(spark):
    rows = [(i, "x", f"the word{i % 40} {'of' if i % 2 else 'rare' + str(i)}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, block string, title string")

    def found(**options):
        return weights.term_weights(df, "block", "id", ["title"], mode="word", **options)

    split, shuffled = found(frequent_from=100), found(frequent_from=10_000)
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in shuffled.collect()}
    assert split.where("term = 'the'").count() == 200
    optimised = split._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in optimised


#: Bytes of the longest word here, its field and its block.
ROW_OF_WORD = len("word39" + "title" + "x")


@pytest.mark.parametrize("most, sent", [(1, {"the"}), (30, {"the", "of"}), (42, {"the", "of"} | {f"word{i}" for i in range(40)})])
def test_more_frequent_words_than_may_be_sent(spark, monkeypatch, most, sent):
    rows = [(i, "x", f"the word{i % 40} {'of' if i % 2 else 'rare' + str(i)}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, block string, title string")

    def found(**options):
        return {tuple(r) for r in weights.term_weights(df, "block", "id", ["title"], mode="word", **options).collect()}

    shuffled = found()
    monkeypatch.setattr(weights, "MOST_BYTES", most * (ROW_OF_WORD + weights.ROW_BYTES))
    assert found(frequent_from=5) == found(frequent_from=1) == shuffled and len(shuffled) == 600
    idf = weights.term_idf(df, "block", "id", ["title"], "word")
    assert {r.term for r in idf.where(weights._is_sent(idf, "block", 5)).collect()} == sent


def test_no_word_fits(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x", "one two") for i in range(9)], "id int, block string, title string")
    monkeypatch.setattr(weights, "MOST_BYTES", 60)
    assert weights.term_weights(df, "block", "id", ["title"], mode="word", frequent_from=2).count() == 18


def test_words_of_a_megabyte_are_not_sent(spark):
    """They are as frequent as any, but what is broadcast stays within its bytes."""
    rows = [(i, "x", f"{'a' * (1 << 20)} {'b' * (1 << 20)} the word{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "id int, block string, title string").repartition(4)
    found = weights.term_weights(df, "block", "id", ["title"], mode="word", frequent_from=2)
    assert found.groupBy(F.length("term").alias("n")).count().where(f"n = {1 << 20}").first()["count"] == 24
    assert found.count() == 48
    idf = weights.term_idf(df, "block", "id", ["title"], "word")
    assert [r.term for r in idf.where(weights._is_sent(idf, "block", 2)).select("term").collect()] == ["the"]
