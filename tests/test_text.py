import random

import pytest
from pyspark.sql import functions as F

from refrain.functions import text
from refrain.operators import relational

CLEAN = [
    ("Old Town Road (feat. X) [Remix]", "oldtownroadremix"),
    ("a (b) c (d) e", "ae"),
    ("Café_del Mar!", "cafdelmar"),
    ("¿Qué?", "qu"),
    ("()x", "x"),
    ("line(1\n2)z", "linez"),
    (") x (", "x"),
    ("a(()b", "ab"),
    ("nan", "nan"),
]


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_clean_name(spark):
    assert values(spark, [c for c, _ in CLEAN], text.clean_name) == [c for _, c in CLEAN]


def test_cleaning_equals_the_two_patterns(spark):
    odd = ["(", ")", "()", "(()", "())", ")(", "a)b(c)d", "((x)) y", "(a)(b)", "x()y()z", "(\n)", "( )a", "é(ü)ß", ""]
    slow = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"\([\w|\W]+\)", ""), r"[_\W]", ""))
    assert values(spark, odd, text.clean_name) == values(spark, odd, slow)
    assert values(spark, odd, text.has_clean_name) == [n != "" for n in values(spark, odd, slow)]


def test_remove_noise_drops_empty_names_and_keeps_the_input(spark):
    df = spark.createDataFrame([(1, "(intro)"), (2, "日本"), (3, None), (4, "A b")], "id int, title string")
    cleaned = relational.remove_noise(df, "title")
    assert cleaned.columns == ["id", "original_title", "title"]
    assert [tuple(r) for r in cleaned.collect()] == [(4, "A b", "ab")]


def test_name_key(spark):
    assert values(spark, ["99problems", "cafdelmar", ""], text.name_key) == ["others", "c", ""]


def test_first_listed(spark):
    listings = ["[21]", "[21, 76]", "[]", "nan", "[21"]
    assert values(spark, listings, text.first_listed) == ["21", "21", "", "", "2"]


def test_tokens(spark):
    assert values(spark, ["aab", "!!", "Ab_1"], text.tokens) == [["a", "a", "b"], [], ["a", "b", "_", "1"]]
    assert values(spark, ["Old town-road"], lambda c: text.tokens(c, "word")) == [["old", "town", "road"]]


def test_char_counts_equal_the_tokens(spark):
    rows = ["aab", "!!", "Ab_1 é", "", "x" * 3_000_000 + "yy", None, "Zoë 99"]
    counts = values(spark, rows, text.char_counts)
    for row, found in zip(rows, counts):
        lowered = (row or "").lower()
        assert found == [lowered.count(c) for c in text.ALPHABET]


def test_labels(spark):
    assert values(spark, ["(m12)Old (x)"], text.id_from_label) == ["m12"]
    assert values(spark, ["(m12)Old (x)"], text.letter_from_label) == ["o"]


@pytest.mark.parametrize("name, allowed", [("a.mp3", True), ("a.b.WAV", True), ("mp3", False), ("a.mp3.txt", False)])
def test_extensions(spark, name, allowed):
    assert values(spark, [name], text.has_extension) == [allowed]


def test_ids_from_object_keys(spark):
    keys = ["b/audio/000/000123.mp3", "b/x.mp3", "b/c/d/e.mp3"]
    assert values(spark, keys, lambda c: text.id_from_segment(c, 3, ".mp3")) == [123, None, None]


def _odd_texts():
    rng = random.Random(11)
    signs = "aZ09_ -.\n\t(é日İKß'\"" + "xyz "
    drawn = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(300)]
    return [*drawn, None, "", "ab " * 500_000, "tail", "one", "é" * 700_000 + "z", "_", None]


def test_cleaning_equals_the_replacing_pattern_without_running_it(spark):
    """A replacing pattern takes microseconds for each blank of a text, hours of a large table."""
    df = spark.createDataFrame(list(enumerate(_odd_texts())), "i int, x string")
    slow = F.lower(F.regexp_replace(text._outside_span(F.col("x")), "[^a-zA-Z0-9]+", ""))
    found = df.select(text.clean_name(F.col("x")).alias("fast"), slow.alias("slow")).collect()
    assert [r.fast for r in found] == [r.slow for r in found]
    assert "regexp" not in df.select(text.clean_name(F.col("x")))._jdf.queryExecution().executedPlan().toString()
