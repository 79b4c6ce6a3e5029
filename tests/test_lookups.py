"""The lookups from all customers and those from a vector, on rows of their own."""

from checks import ORACLES, QUERIES, matching
from checks.registry import Tables
from refrain.sources import scratch
from tests.compare import connection, difference


def test_chained_lookup_goes_from_every_customer(spark, tmp_path):
    """More customers than a search would hit; segments that are NULL, empty or several, rows that come twice, orders of nobody."""
    segments = ["A", "1", "", None, "none", "2020-01-01"]
    customers = [(i, f"c{i}", segments[i % 6], float(i)) for i in range(40)] + [(3, "c3", None, 0.0), (4, "c4", "B", 0.0)]
    orders = [(100 + i, i % 50 if i % 11 else None, float(i % 7) if i % 5 else None) for i in range(150)]
    lines = [(100 + i % 150, i // 150, i % 9 if i % 13 else None) for i in range(400)]
    for name, rows, ddl in (
        ("customer", customers, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double"),
        ("orders", orders + orders[:20], "o_orderkey long, o_custkey long, o_totalprice double"),
        ("lineitem", lines + lines[:9], "l_orderkey long, l_linenumber int, l_partkey long"),
        ("part", [(i, f"p{i}") for i in range(8)], "p_partkey long, p_name string"),
    ):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = QUERIES["chained_lookup"](spark, str(tmp_path))
    con = connection(tmp_path / "none")
    for name in ("customer", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert difference(found, con, ORACLES["chained_lookup"]) is None
    assert found.select("music_track_id").distinct().count() > 5


def test_texts_of_music_are_written_once_for_lookups(spark, tmp_path):
    """The names are cleaned into the table that lookups read, and linked from it; copies and names that clean to nothing among them."""
    texts = ["Old (Town) road", "99 problems", "aab c", "()", None, "tea for two", "old road", "tea for 2"]
    documents = [(i, texts[i % 8], "en", "wiki" if i % 3 else "web", 1) for i in range(48)]
    conversations = [(i, i % 3, "user" if i % 2 else "assistant", texts[i * 3 % 8]) for i in range(40)]
    embeddings = [(i, [float(i % 5), float(i)], 3 if i % 2 else 1) for i in range(48)]
    for name, rows, ddl in (
        ("documents", documents, "doc_id long, text string, lang string, source string, n_chars long"),
        ("conversations", conversations, "conv_id long, turn long, role string, text string"),
        ("embeddings", embeddings, "vec_id long, embedding array<float>, label int"),
    ):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = len(scratch._written)
    paths = matching.stored_lookup(Tables(spark, str(tmp_path)))
    written = {path: spark.read.parquet(path) for path in scratch._written[before:]}
    with_texts = [path for path, df in written.items() if "song_title" in df.columns and df.schema["song_title"].dataType.simpleString() == "string"]
    assert [path for path in with_texts if not written[path].where("track_id LIKE 'm%'").isEmpty()] == [paths["names"]]
    names = written[paths["names"]].drop("part")
    expected = matching.music(Tables(spark, str(tmp_path)))
    assert sorted(map(str, names.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    con = connection(tmp_path / "none")
    for name in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = matching.found_videos(Tables(spark, str(tmp_path)), paths)
    assert difference(found, con, ORACLES["videos_for_vector"]) is None
    assert not found.isEmpty()
