"""Dumps, frames, start positions, and the log folder as a stream."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import frames
from tideline.sources import dump, options, wal
from tideline.sources.options import Options
from tideline.streaming import feed


def test_dump(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/1.sst", "a/2.sst", "info"):
        (tmp_path / name).write_bytes(name.encode())
    rows = dump.read_dump(spark, str(tmp_path), "*.sst").withColumn("v", F.lit("u1"))
    assert {bytes(r["content"]) for r in dump.one_version(rows, "v").collect()} == {b"a/1.sst", b"a/2.sst"}
    with pytest.raises(Exception, match="more than one snapshot"):
        dump.one_version(rows.withColumn("v", F.col("path")), "v").collect()
    info = spark.createDataFrame([("3s\n10.0.0.1\n9221\n12\n34567\n",), ("short",)], "value string")
    assert [(r["filenum"], r["offset"] and int(r["offset"])) for r in dump.end_position(info).collect()] == [(12, 34567), (None, None)]


def test_frames():
    assert frames.split_bytes(b"\0\0\0\1a\0\0\0\0\0\0\0\2b") == ([b"a", b""], b"\0\0\0\2b")
    assert frames.split_bytes(None) == ([], b"") == frames.split_bytes(b"")


def test_start():
    start = lambda **k: options.start_position(Options(**k), (3, 4), (5, 6))
    assert start(filenum=1, offset=2) == ("position", (1, 2)) and start(start_from_master=True) == ("position", (5, 6)) and start() == ("position", (3, 4))
    assert options.start_position(Options(), None, None) == ("snapshot", None) and options.start_position(Options(initial_full_sync=False), None, None) == ("latest", None)
    purge = lambda a: options.after_purge(Options(sync_point_purged_action=a), (5, 6))
    assert purge("pause") == ("stop", None) and purge("start_from_master") == ("position", (5, 6)) and purge("odd") == purge("full_sync") == ("snapshot", None)


def test_log_stream_goes_on(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    spark.dataSource.register(wal.WalDataSource)
    put = lambda k: (log / wal.segment_name(1, 10 * k, k)).write_bytes(b"".join(wal.encode(1, 10 * k + i + 1, 1, 10 * k + i, b"x") for i in range(3)))
    for k in range(3):
        put(k)
        stream = spark.readStream.format("wal").option("ackPath", str(tmp_path / "ack")).load(str(log))
        feed.write_bronze(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        got = sorted(int(r["seq"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
        assert got == [10 * j + i + 1 for j in range(k + 1) for i in range(3)]


def test_repeats_within_watermark(spark, tmp_path):
    rows = [("e1", "2024-01-01 00:00:01"), ("e1", "2024-01-01 00:00:01"), ("e2", "2024-01-01 00:00:02")]
    spark.createDataFrame(rows, "event_id string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(str(tmp_path / "in"))
    stream = feed.read_log(spark, str(tmp_path / "in"), "event_id string, t timestamp")
    feed.write_bronze(feed.without_repeats(stream, "t"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["e1", "e2"]
