import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from graniteflow import session
from graniteflow.sources import readers, writers
from graniteflow.streaming import streams


def test_csv_with_quotes_and_carriage_returns(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'he said "hi", then\rleft'), (2, ""), (3, "plain")], "id long, t string")
    path = writers.write_table(rows, str(tmp_path / "a"), "csv", lineSep="\n")
    back = readers.read_csv(spark, path, "key long, body string", line_sep="\n")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())


def test_csv_text_over_several_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, "two\nlines")], "id long, t string")
    path = writers.write_table(rows, str(tmp_path / "a"), "csv")
    assert readers.read_csv(spark, path, rows.schema).first()["t"] == "two\nlines"


def test_word_vectors_report_wrong_lengths(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a 1 2\nc 3 4\n")
    (tmp_path / "w.txt").write_text("a 1 2\nb 1\n")
    got = {r["word"]: r["v"] for r in readers.read_word_vectors(spark, str(tmp_path / "v.txt"), 2).collect()}
    assert got == {"a": [1.0, 2.0], "c": [3.0, 4.0]}
    lines = readers.word_vector_lines(spark, str(tmp_path / "w.txt"), 2).collect()
    assert {(r["word"], r["rejected"]) for r in lines} == {("a", None), (None, "b 1")}
    with pytest.raises(Exception, match="not a word and 2 values"):
        readers.read_word_vectors(spark, str(tmp_path / "w.txt"), 2).collect()


def test_folder_scan_tags_by_file_name(spark, tmp_path):
    for tag in ("gohawks", "nfl"):
        (tmp_path / f"tweets_#{tag}.txt").write_text('{"author": {"followers": 5}}\n')
    out = readers.scan_folder(spark, str(tmp_path), "author struct<followers:long>", name_pattern=r"^.*#(.*)\.txt$")
    assert {(r["tag"], r["author"]["followers"]) for r in out.collect()} == {("gohawks", 5), ("nfl", 5)}


def test_stored_at_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "stage"), []
    build = lambda: calls.append(1) or spark.range(3)
    assert writers.stored_at(spark, path, build).count() == 3
    assert writers.stored_at(spark, path, build).count() == 3 and calls == [1]


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    again = writers.load_model(writers.save_model(model, str(tmp_path / "m")))
    assert model.transform(df).collect() == again.transform(df).collect()


def test_checkpoints_go_to_the_named_folder(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(session.shared_folder(spark))
    cut = session.cut_lineage(spark.range(4).where("id > 1"))
    assert cut.count() == 2 and "ExistingRDD" in cut._jdf.queryExecution().toString()


def test_spread_only_below_the_core_count(spark):
    small = spark.range(10).coalesce(1)
    assert session.spread(small).rdd.getNumPartitions() >= 4
    wide = spark.range(10).repartition(9)
    assert session.spread(wide) is wide


@pytest.fixture
def folder(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 3.0), ("2024-01-01 05:00:00", "b", 5.0)]
    later = [("2024-01-01 06:00:00", "b", 7.0)]
    late = [("2024-01-01 00:20:00", "a", 9.0), ("2024-01-01 09:00:00", "b", 7.0)]
    schema = "ts string, tag string, value double"
    for i, part in enumerate((rows, later, late)):
        df = spark.createDataFrame(part, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        import time

        time.sleep(1.1)
    return str(tmp_path / "in"), df.schema


def test_append_stream_drops_rows_behind_the_watermark(spark, folder):
    path, schema = folder
    counts = streams.hourly_counts(streams.file_stream(spark, path, schema, files_per_trigger=1), "ts", "tag", "1 hour")
    got = {(str(r["hour_start"]), r["tag"]): r["n"] for r in streams.append_to_table(counts, "h").collect()}
    assert got == {("2024-01-01 00:00:00", "a"): 2, ("2024-01-01 05:00:00", "b"): 1, ("2024-01-01 06:00:00", "b"): 1}


def test_running_totals_see_all_rows(spark, folder):
    path, schema = folder
    stats = streams.running_source_stats(streams.file_stream(spark, path, schema, files_per_trigger=1), "tag", ["value"])
    got = {r["tag"]: (r["n"], r["mean_value"]) for r in streams.latest_totals(stats, ["tag"], "t").collect()}
    assert got == {"a": (3, pytest.approx(13 / 3)), "b": (3, pytest.approx(19 / 3))}
    hours = streams.hourly_counts(streams.file_stream(spark, path, schema, files_per_trigger=1), "ts", "tag")
    got = {(str(r["hour_start"])[11:13], r["tag"]): r["n"] for r in streams.latest_totals(hours, ["hour_start", "tag"], "h").collect()}
    assert got == {("00", "a"): 3, ("05", "b"): 1, ("06", "b"): 1, ("09", "b"): 1}
