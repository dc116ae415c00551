"""Every registered query against its SQL, on the small tables; streams; restarts."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tideline.functions import header, resp
from tideline.plans import adapters, catalogue
from tideline.sources import wal
from tideline.sources.options import Options
from tideline.streaming import feed

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({catalogue.ORACLE[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and (got or name in ("q_wal_gc", "q_ack_range", "q_handoff", "q_wal_stream"))  # these need longer logs


def test_stream_restarts(spark, tmp_path):
    """A second run takes only what is new."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = adapters.load(spark, DATA, "events")
    for k in range(2):
        rows.where(f"event_id % 2 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        log = adapters.as_commands(feed.read_log(spark, str(tmp_path / "in"), schema)).withColumns({"logic_id": F.col("event_id"), "filenum": F.lit(0), "offset": F.col("event_id")})
        feed.write_batches(feed.event_stream(log, Options()), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == rows.count() == out.select("value").distinct().count() and out.select("batch").distinct().count() == 2


def test_bad_records(spark):
    good = header.encode(F.lit(1), F.lit(1), F.lit(1), F.lit(1), F.lit(1), resp.serialize(F.array(F.lit("SET"), F.lit("k"), F.lit("v"))).cast("binary"))
    df = spark.range(2).select(F.when(F.col("id") == 0, good).otherwise(F.lit(b"no")).alias("raw"))
    got = {r["error"]: r["argv"] for r in feed.decoded(df, "quarantine").collect()}
    assert got[None] == ["SET", "k", "v"] and len(got) == 2
    with pytest.raises(Exception, match="bad log record"):
        feed.decoded(df).collect()


def test_wal_start(spark, tmp_path):
    for k in range(3):
        name = wal.segment_name(1, 100 * k, k)
        (tmp_path / name).write_bytes(b"".join(wal.encode(1, 10 * k + i + 1, 1, 100 * k + i, b"x") for i in range(3)))
    spark.dataSource.register(wal.WalDataSource)
    read = lambda **o: [int(r["offset"]) for r in spark.read.format("wal").options(**o).load(str(tmp_path)).orderBy("offset").collect()]
    assert read() == [0, 1, 2, 100, 101, 102, 200, 201, 202] and read(**{"from": "1:101"}) == [101, 102, 200, 201, 202]
    assert wal.read_files(spark, str(tmp_path)).count() == 9
    assert len(wal.WalReader({"path": str(tmp_path), "from": "1:200"}).partitions()) == 1
