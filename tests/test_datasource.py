import os

import pytest
from pyspark.sql import functions as F

from textloom.sources import datasource


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Nine batch files, one of another name, and hidden ones."""
    datasource.register(spark)
    path = tmp_path_factory.mktemp("batches")
    for k in range(9):
        (path / f"chuong_{k * 10 + 1}-{k * 10 + 10}.txt").write_text(f"text {k} 章\n" * 3)
    (path / "notes.txt").write_text("other")
    (path / ".hidden").write_text("no")
    return path


def files(spark, folder, **options):
    return spark.read.format("textloom_files").options(**options).load(str(folder))


def test_batches(spark, folder):
    rows = files(spark, folder, partition_bytes=60).orderBy("file_name").collect()
    assert [(r["file_name"], r["batch_start"], r["batch_end"]) for r in rows][:2] == [("chuong_1-10.txt", 1, 10), ("chuong_11-20.txt", 11, 20)]
    assert len(rows) == 10 and rows[-1]["batch_start"] is None and rows[0]["value"] == "text 0 章\n" * 3
    assert files(spark, folder, partition_bytes=60).rdd.getNumPartitions() > 4
    assert files(spark, folder.parent / "nothing").count() == 0


def test_only_files_in_range_are_opened(spark, folder, tmp_path):
    """Files outside the range cannot be read at all: the scan succeeds as they are never opened."""
    for f in folder.iterdir():
        (tmp_path / f.name).write_bytes(f.read_bytes())
    for k in (0, 1, 8):
        bad = tmp_path / f"chuong_{k * 10 + 1}-{k * 10 + 10}.txt"
        bad.unlink()
        bad.symlink_to("/proc/self/mem")  # listed, but an error to read
    asked = files(spark, tmp_path).where("batch_end >= 25 and batch_start <= 52")
    assert sorted(r["batch_start"] for r in asked.collect()) == [21, 31, 41, 51]
    plan = asked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters" in plan or "ReadFilters" in plan or "textloom_files" in plan, plan
    assert "Filter (" not in plan.split("BatchScan")[0], plan  # nothing of it is left to Spark
    assert sorted(r["file_name"] for r in files(spark, tmp_path, low=25, high=52).select("file_name").collect())[-1] == "notes.txt"
    assert files(spark, tmp_path, low=25, high=52).count() == 5
    with pytest.raises(Exception):
        files(spark, tmp_path).collect()


@pytest.mark.parametrize(
    "where, n",
    [("batch_start is null", 1), ("batch_start = 31", 1), ("file_name in ('notes.txt', 'chuong_1-10.txt')", 2), ("batch_start < 21 and value like '%1%'", 1), ("batch_start + 1 = 32", 1), ("batch_start > 71 or batch_end < 11", 2)],
)
def test_filters_give_what_spark_gives(spark, folder, where, n):
    assert files(spark, folder).where(where).count() == n
    assert spark.createDataFrame(files(spark, folder).collect(), datasource.SCHEMAS["batches"]).where(where).count() == n


def test_captions(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "chuong_3.srt").write_bytes("1\r\n00:00:01,000 --> 00:00:02,000\r\n阿伟来了\r\n\r\n2\n00:00:03,000 --> 00:00:04,500\ntwo\n lines \n\nbroken\n\n3\n00:00:05,000 --> 00:00:06,000\n".encode())
    rows = [tuple(r) for r in files(spark, tmp_path, kind="captions").orderBy("pos").collect()]
    assert rows == [
        ("chuong_3.srt", 3, 3, 1, "00:00:01,000", "00:00:02,000", "阿伟来了"),
        ("chuong_3.srt", 3, 3, 2, "00:00:03,000", "00:00:04,500", "two\nlines"),
        ("chuong_3.srt", 3, 3, 3, "00:00:05,000", "00:00:06,000", ""),
    ]


def test_written_files_are_whole_and_none_is_left_of_failed_tasks(spark, tmp_path):
    datasource.register(spark)
    rows = spark.range(1, 25).select(F.format_string("chuong_%d-%d.txt", F.col("id"), F.col("id")).alias("file_name"), F.repeat(F.col("id").cast("string"), 3).alias("value"))
    rows.repartition(4).write.format("textloom_files").mode("append").save(str(tmp_path / "out"))
    assert sorted((r["batch_start"], r["value"]) for r in files(spark, tmp_path / "out").collect()) == [(k, str(k) * 3) for k in range(1, 25)]
    broken = rows.withColumn("value", F.when(F.col("file_name") == "chuong_7-7.txt", F.raise_error(F.lit("lost"))).otherwise("changed"))
    with pytest.raises(Exception):
        broken.repartition(4).write.format("textloom_files").mode("append").save(str(tmp_path / "out"))
    assert sorted(r["value"] for r in files(spark, tmp_path / "out").collect()) == sorted(str(k) * 3 for k in range(1, 25))
    rows.limit(2).write.format("textloom_files").mode("overwrite").save(str(tmp_path / "out"))
    assert files(spark, tmp_path / "out").count() == 2


def test_a_stream_that_fails_goes_on_without_loss_or_repeats(spark, tmp_path):
    datasource.register(spark)
    folder, seen = tmp_path / "in", []
    folder.mkdir()

    def put(k):
        draft = folder / ".draft"
        draft.write_text(f"text {k}")
        os.utime(draft, ns=(10**18 + k, 10**18 + k))
        draft.rename(folder / f"chuong_{k}-{k}.txt")

    def run(fail):
        def take(batch, number):
            names = sorted(r["file_name"] for r in batch.collect())
            if fail and "chuong_4-4.txt" in names:
                raise RuntimeError("lost")
            seen.append((number, names))

        stream = spark.readStream.format("textloom_files").option("path", str(folder)).load()
        running = stream.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "cp")).start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()

    for k in (1, 2):
        put(k)
    run(False)
    for k in (3, 4):
        put(k)
    with pytest.raises(Exception):
        run(True)
    put(5)  # comes after the failed batch was planned
    run(False)
    names = [n for _, batch in seen for n in batch]
    assert sorted(names) == [f"chuong_{k}-{k}.txt" for k in range(1, 6)]
    assert [n for _, n in seen if n][1] == ["chuong_3-3.txt", "chuong_4-4.txt"]
