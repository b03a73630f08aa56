"""Loading from a folder that lines arrive in."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrspark.streaming import load

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def good(i, name="x"):
    return f'{{"id": {i}, "name": "{name}"}}'


def table(spark, out):
    rows, bad = load.loaded(spark, str(out), SCHEMA)
    return Counter(map(tuple, rows.collect())), Counter(map(tuple, bad.collect()))


def run(spark, tmp_path, **options):
    load.load_available(spark, str(tmp_path / "in"), SCHEMA, "id", str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1, **options)


def test_repeats_and_late_lines_are_loaded_once(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.txt", [good(1), good(2), good(1), "{", good(3, "é"), '{"id": null, "name": "n"}'])
    put(source, "2.txt", [good(2), "{", '{"id": "x"}', good(4), '{"id": null, "name": "n"}', ""])
    run(spark, tmp_path)
    want = Counter([(1, "x"), (2, "x"), (3, "é"), (4, "x"), (None, "n")])
    rows, bad = table(spark, tmp_path / "out")
    assert rows == want and bad == Counter([("{", "invalid JSON"), ('{"id": "x"}', "wrong type"), ("", "invalid JSON")])
    put(source, "3.txt", [good(1), good(5)])  # one comes late and again, one is new
    run(spark, tmp_path)
    assert table(spark, tmp_path / "out") == (want + Counter([(5, "x")]), bad)


def test_nothing_arrived_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run(spark, tmp_path)
    assert table(spark, tmp_path / "out") == (Counter(), Counter())


def test_a_stopped_load_resumes_to_the_same_table(spark, tmp_path):
    for k in range(4):
        put(tmp_path / "in", f"{k}.txt", [good(i) for i in range(k * 5, k * 5 + 8)] + ["bad line"])
    write = load.batch_writer(str(tmp_path / "out"))

    def fails(batch, number):
        if number == 2:
            write(batch, number)  # the batch was written, but the stream does not know
            raise RuntimeError("machine lost")
        write(batch, number)

    with pytest.raises(Exception, match="machine lost"):
        run(spark, tmp_path, write=fails)
    partial, _ = table(spark, tmp_path / "out")
    assert 0 < len(partial) < 23
    run(spark, tmp_path)
    rows, bad = table(spark, tmp_path / "out")
    assert rows == Counter((i, "x") for i in range(23)) and bad == Counter([("bad line", "invalid JSON")])


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    lines = spark.createDataFrame([(good(1),), (good(2),), ("{",)], "value string")
    batch = load.judged_lines(lines, SCHEMA, "id")
    write = load.batch_writer(str(tmp_path / "out"))
    for _ in range(3):
        write(batch, 7)
    rows, bad = table(spark, tmp_path / "out")
    assert rows == Counter([(1, "x"), (2, "x")]) and bad == Counter([("{", "invalid JSON")])


def test_ids_are_forgotten_only_when_asked(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType())])
    line = '{{"id": {}, "at": "2024-01-{:02}T00:00:00Z"}}'
    put(tmp_path / "in", "1.txt", [line.format(1, 1), line.format(2, 2)])
    put(tmp_path / "in", "2.txt", [line.format(1, 1), line.format(3, 20), "bad"])
    put(tmp_path / "in", "3.txt", [line.format(4, 25), line.format(3, 20), "bad"])
    load.load_available(
        spark, str(tmp_path / "in"), schema, "id", str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1,
        event_time="at", forget_after="5 days",
    )
    rows, bad = load.loaded(spark, str(tmp_path / "out"), schema)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3, 4] and bad.count() == 1


def test_counts_are_brought_up_to_date(spark, tmp_path):
    rows = spark.range(200).select(
        (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, id % 50, 0)")).alias("at"), (F.col("id") % 3).alias("k")
    )
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        load.start_counts(arriving, "at", "10 minutes", ["k"], str(tmp_path / "out"), str(tmp_path / "state"), "1 day").awaitTermination()
        counts = load.current_counts(spark, str(tmp_path / "out"), ["k"])
        want = rows.groupBy(F.window("at", "10 minutes").alias("w"), "k").count().select("w.start", "w.end", "k", "count")
        assert Counter(map(tuple, counts.collect())) == Counter(map(tuple, want.collect()))
    assert spark.read.parquet(str(tmp_path / "out")).select("batch").distinct().count() > 1
