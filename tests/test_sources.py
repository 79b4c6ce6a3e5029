import os
import random

import pytest
from pyspark.sql import functions as F

from refrain.sources import files, grouped_csv, records, scratch, tables, videos


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouped_csv(spark, tmp_path):
    text = ',album,artist,track,track\n, title, name,title,genres\ntrack_id,,,,\n'
    (tmp_path / "1.csv").write_text(text + '2,Álbum,"Doe, J","Say ""hi""","[21, 76]"\n3,nan,,x,[]\n')
    (tmp_path / "2.csv").write_text(text + "5,a,b,c,d\n")
    df = grouped_csv.read_grouped_csv(spark, str(tmp_path))
    names = ["track_id", "album__title", "artist__name", "track__title", "track__genres"]
    assert df.columns == [*names, grouped_csv.CORRUPT]
    rows = {r.track_id: tuple(r)[1:-1] for r in df.collect()}
    assert rows == {"2": ("Álbum", "Doe, J", 'Say "hi"', "[21, 76]"), "3": (None, None, "x", "[]"), "5": ("a", "b", "c", "d")}
    kept = grouped_csv.read_grouped_csv(spark, str(tmp_path), keep_nan_strings=True)
    assert kept.where("track_id = '3'").first()["artist__name"] == "nan"
    assert grouped_csv.select_group(df, "track").columns == ["track_id", "title", "genres"]


def test_grouped_csv_of_files_with_other_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text(',track,artist\n,title,name\ntrack_id,,\n1,"a\n77,b",c\n2,d\n3,e,f,g\n,no id,h\n')
    (tmp_path / "2.csv").write_text(",artist,track\n,name,title\ntrack_id,,\n4,x,y\n")
    rows = {r.track_id: r for r in grouped_csv.read_grouped_csv(spark, str(tmp_path)).collect()}
    assert rows.keys() == {"1", "2", "3", "4", None}
    assert (rows["1"].track__title, rows["1"].artist__name) == ("a\n77,b", "c")
    assert (rows["4"].track__title, rows["4"].artist__name) == ("y", "x")
    assert rows[None].track__title == "no id"
    assert [k for k, r in rows.items() if r.corrupt_record] == ["2", "3"]


def awkward_csv(seed, rows, end):
    """A two-level-header CSV of cells with quotes, separators, blanks and line ends; some rows lack or have too many cells."""
    chooser = random.Random(seed)
    cells = ["a", "b c", " x", '"q\nr"', '""', "", "nan", '"say ""hi"""', '"  lead"', "é😀", '"x,y"', '"\r\nwin"', '"one\n\ntwo\n"', f'"{"long " * 60}"']
    lines = [",track,artist", ",title,name", "track_id,,"]
    for i in range(rows):
        more = [chooser.choice(cells) for _ in range(1 if i % 61 == 7 else 3 if i % 57 == 5 else 2)]
        lines.append(",".join([str(i), *more]))
    return end.join(lines) + (end if seed % 2 else "")


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_one_file_with_line_feeds_is_read_by_many_tasks(spark, tmp_path, monkeypatch, seed, end):
    (tmp_path / "1.csv").write_bytes(awkward_csv(seed, 500, end).encode())
    split = grouped_csv.read_grouped_csv(spark, str(tmp_path), range_bytes=700)
    listing = spark.createDataFrame([(str(tmp_path / "1.csv"), os.path.getsize(tmp_path / "1.csv"))], "path string, length long")
    stretches = records.segments(listing, 700).collect()
    assert len(stretches) > 20 and split.rdd.getNumPartitions() > 20
    assert sum(r.end - r.begin for r in stretches) == os.path.getsize(tmp_path / "1.csv")
    monkeypatch.setattr(grouped_csv, "can_open", lambda path: False)
    whole = grouped_csv.read_grouped_csv(spark, str(tmp_path))
    assert whole.rdd.getNumPartitions() == 1
    feeds = (lambda df: sorted(str(r).replace("\\r\\n", "\\n") for r in df.collect()))  # Spark's reader changes those in cells
    assert feeds(split) == feeds(whole) and whole.count() == 500


def test_a_record_longer_than_many_ranges(spark, tmp_path):
    text = "x\n" * 5000
    (tmp_path / "1.csv").write_text(f',track\n,title\ntrack_id,\n1,"{text}"\n2,"{text}"\n3,b\n')
    read = grouped_csv.read_grouped_csv(spark, str(tmp_path), range_bytes=100)
    assert {r.track_id: r.track__title for r in read.collect()} == {"1": text, "2": text, "3": "b"}


def test_headers_are_read_without_the_rest(spark, tmp_path):
    for name, rows in (("small", 10), ("large", 400_000)):
        (tmp_path / f"{name}.csv").write_text(",track\n,title\ntrack_id,\n" + "1,abc\n" * rows)
    listing = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length")
    read = {r.path.rsplit("/")[-1]: r for r in files.first_lines(listing, 2, head=256).collect()}
    assert read["large.csv"].bytes_read == 256 and read["large.csv"].length > 2_000_000
    assert {tuple(r.lines) for r in read.values()} == {(",track", ",title")}
    assert len(grouped_csv.header_lines(spark, str(tmp_path))) == 1
    (tmp_path / "wide.csv").write_text("," + "g" * 5000 + "\n,title\n1,x\n")
    wide = spark.createDataFrame([(str(tmp_path / "wide.csv"), 1)], "path string, length long")
    assert files.first_lines(wide, 2, head=256).first().lines == ["," + "g" * 5000, ",title"]


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    wanted = set()
    for i in range(40):
        folder = tmp_path / f"a{i % 4}" / f"b {i % 7}" / f"c{i}"
        folder.mkdir(parents=True)
        for name in (f"{i}.mp3", f"_{i}.mp3", f".{i}.mp3", f"{i}.txt"):
            (folder / name).write_bytes(b"abc" * (i + 1))
        wanted.add((f"file:{folder}/{i}.mp3", 3 * (i + 1)))
    indexed = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp3").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert {(r.path, r.length) for r in indexed.select("path", "length").collect()} == wanted
    for most in (1, 5, 1000):
        monkeypatch.setattr(files, "FOLDERS", most)
        assert {(r.path, r.length) for r in files.list_files(spark, str(tmp_path), "*.mp3").collect()} == wanted
    assert files.list_files(spark, str(tmp_path / "nothing"), "*").count() == 0


def test_grouped_csv_refuses_spaces_in_names(spark, tmp_path):
    (tmp_path / "1.csv").write_text(",track\n,two words\ntrack_id,\n1,x\n")
    df = grouped_csv.read_grouped_csv(spark, str(tmp_path))
    with pytest.raises(ValueError, match="spaces"):
        grouped_csv.select_group(df, "track")
    with pytest.raises(ValueError, match="no column group"):
        grouped_csv.select_group(df, "artist")


def test_videos(spark, tmp_path):
    lines = [
        '{"itemInfos":{"id":"1","video":{"urls":["u","v"]},"covers":["c"]},"musicInfos":{"musicId":"9","authorName":"A","musicName":"S","playUrl":[]}}',
        '{"itemInfos":{"id":"2","video":{"urls":[]}}}',
        "{broken",
    ]
    (tmp_path / "v.json").write_text("\n".join(lines))
    read = videos.read_videos(spark, str(tmp_path))
    flat = {r.video_id: tuple(r)[1:-1] for r in videos.flatten_videos(read).collect()}
    assert [r.corrupt_record for r in videos.flatten_videos(read).collect() if r.corrupt_record] == ["{broken"]
    assert flat["1"] == ("u", "c", "9", "A", "S", None)
    assert flat["2"] == (None,) * 6
    assert [r[0] for r in read.select(videos.CORRUPT, "itemInfos").collect() if r[0]] == ["{broken"]


def test_appends_double_and_partitions_are_pruned(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 4).cast("string").alias("k"))
    path = str(tmp_path / "parts")
    for _ in range(2):
        tables.append_partitioned(df, path, "k")
    assert tables.read_table(spark, path).count() == 2000
    one = tables.read_partition(spark, path, "k", "3")
    assert one.count() == 500 and "PartitionFilters: [isnotnull(k" in plan(one)
    flat = str(tmp_path / "flat")
    for _ in range(2):
        tables.append_table(df.coalesce(1), flat, rows_per_file=300)
    assert tables.read_table(spark, flat).count() == 2000
    assert len(list((tmp_path / "flat").glob("*.parquet"))) == 8


def test_a_batch_can_be_written_again(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("k"))
    path = str(tmp_path / "t")
    for batch, rows in ((1, df), (2, df.where("id < 10")), (1, df.where("k <> '3'")), (2, df.where("id < 10"))):
        tables.write_batch(rows, path, batch, "k")
    found = tables.read_table(spark, path).groupBy("batch_id", "k").count().collect()
    assert {(r.batch_id, r.k): r["count"] for r in found} == {
        **{(1, k): 25 for k in range(3)}, **{(2, k): 3 if k < 2 else 2 for k in range(4)}
    }
    for _ in range(2):
        tables.write_batch(df, str(tmp_path / "flat"), "a")
    assert tables.read_table(spark, str(tmp_path / "flat")).count() == 100


def test_rows_are_counted_by_the_job_that_writes_them(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [tables.append_counted(spark.range(n).repartition(3), path) for n in (1000, 0, 7)] == [1000, 0, 7]
    assert tables.read_table(spark, path).count() == 1007


def test_a_value_holding_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(400_000, numPartitions=8).select(
        F.xxhash64("id").alias("x"), F.when(F.col("id") % 100 == 0, F.col("id") % 3).otherwise(9).cast("string").alias("k")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "256KB")
    try:
        tables.append_partitioned(rows, str(tmp_path / "t"), "k")
    finally:
        spark.conf.unset(setting)
    assert len(list((tmp_path / "t" / "k=9").glob("*.parquet"))) > 4
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 400_000


def test_object_listing_reads_no_content(spark, tmp_path):
    for name in ("a/b/c/000123.mp3", "a/b/c/x.mp3", "a/b/c/7.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"abc")
    listing = tables.list_objects(spark, str(tmp_path), "*.mp3")
    assert sorted(r.length for r in listing.collect()) == [3, 3]
    assert "content" not in plan(listing)
    depth = f"file:{tmp_path}".count("/") + 4
    ids = {r.track_id for r in tables.keyed_objects(listing, depth, ".mp3").collect()}
    assert ids == {123, None}


def test_jdbc_options():
    connection = tables.jdbc_options("jdbc:postgresql://host/db", user="u")
    assert connection == {"url": "jdbc:postgresql://host/db", "user": "u"}
    assert tables.jdbc_split("id", 0, 100, 4)["numPartitions"] == 4


def test_scratch_follows_the_session(spark):
    root = spark.conf.get(scratch.SETTING)
    df = scratch.settle(spark.range(5), "five")
    assert df.count() == 5
    assert all(f.startswith(f"file://{root}/refrain/five-") for f in df.inputFiles())


def test_scratch_without_a_setting():
    assert scratch.scratch_root("/shared/", "spark://host", "a") == "/shared"
    assert scratch.scratch_root(None, "local[2]", "a") == scratch.scratch_root(None, "local[2]", "a")
    with pytest.raises(ValueError, match="share"):
        scratch.scratch_root(None, "spark://host", "a")
    with pytest.raises(ValueError, match="share"):
        scratch.scratch_root("file:///tmp/x", "spark://host", "a")
    assert scratch.scratch_root("file:///tmp/x", "local-cluster[2,1,512]", "a") == "file:///tmp/x"


def test_released_tables_are_deleted(spark):
    kept = scratch.settle(spark.range(5), "kept")
    with scratch.released(spark):
        gone = scratch.settle(spark.range(7), "gone")
        files = [f.removeprefix("file://") for f in gone.inputFiles()]
        assert gone.count() == 7 and all(map(os.path.exists, files))
    assert kept.count() == 5 and not any(map(os.path.exists, files))
