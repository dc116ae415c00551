"""Codecs and scalar functions: known vectors, damaged inputs, round trips."""

import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions import commands, header, numbers, resp
from tideline.sources import wal

BYTES = st.binary(max_size=40)


def frame(argv):
    return b"*%d\r\n" % len(argv) + b"".join(b"$%d\r\n%s\r\n" % (len(a), a) for a in argv)


@pytest.mark.parametrize(
    "raw, argv",
    [
        (b"*3\r\n$3\r\nset\r\n$3\r\nkey\r\n$5\r\nvalue\r\n", [b"set", b"key", b"value"]),
        (frame([b"set", b"k", b"\x00a\xff"]), [b"set", b"k", b"\x00a\xff"]),
        (b"*0\r\n", []),
        (b"*1\r\n$0\r\n\r\n", [b""]),
        (b"*01\r\n$01\r\nx\r\n", [b"x"]),
    ],
)
def test_parse(raw, argv):
    assert resp.parse_bytes(raw) == (argv, None)


@pytest.mark.parametrize("raw", [None, b"", b"+OK\r\n", b"*1\r\n$3\r\nset\r\ntrailing", b"*1\r\n$3\r\nse\r\n", b"*1\r\n$-1\r\n", b"*-1\r\n", b"*+1\r\n$1\r\nx\r\n", b"*1\r\n$99999999999999999999\r\nx\r\n", b"*2\r\n$1\r\nx\r\n", b"*x\r\n", b"*1"])
def test_parse_errors(raw):
    argv, error = resp.parse_bytes(raw)
    assert argv is None and error


@given(st.lists(BYTES, max_size=6))
def test_parse_round_trip(argv):
    assert resp.parse_bytes(frame(argv)) == (argv, None)


def test_serialize_in_spark(spark):
    rows = [([b"set", b"k", b"\x00a\xff"],), ([],), (["é€".encode()],)]
    df = spark.createDataFrame(rows, "a array<binary>")
    got = [bytes(r[0]) for r in df.select(resp.serialize_binary(F.col("a"))).collect()]
    assert got == [frame(a) for (a,) in rows]
    text = spark.createDataFrame([(["SET", "é€", ""],)], "a array<string>").select(resp.serialize(F.col("a"))).first()[0]
    assert text.encode() == frame([b"SET", "é€".encode(), b""])
    parsed = df.select(resp.parse(resp.serialize_binary(F.col("a"))).alias("p")).select("p.*").collect()
    assert [[bytes(x) for x in r["argv"]] for r in parsed] == [a for (a,) in rows] and all(r["error"] is None for r in parsed)


def pack(kind, time, term, logic, filenum, offset, content, size=None):
    return struct.pack("<HIIQIQI", kind, time, term, logic, filenum, offset, len(content) if size is None else size) + content


def test_header(spark):
    good = pack(1, 1700000000, 7, 8899, 12, 34567, b"*1\r\n$4\r\nPING\r\n")
    rows = [good, pack(1, 2**32 - 1, 0, 2**64 - 1, 2**32 - 1, 2**64 - 1, b""), pack(2, 0, 0, 0, 0, 0, b""), pack(1, 0, 0, 0, 0, 0, b"ab", 1), good[:33], None]
    got = spark.createDataFrame([(r,) for r in rows], "raw binary").select(header.decode(F.col("raw")).alias("h")).select("h.*").collect()
    assert (got[0]["type"], got[0]["exec_time"], got[0]["term_id"], int(got[0]["logic_id"]), got[0]["filenum"], int(got[0]["offset"]), bytes(got[0]["content"])) == (1, 1700000000, 7, 8899, 12, 34567, b"*1\r\n$4\r\nPING\r\n")
    assert int(got[1]["offset"]) == int(got[1]["logic_id"]) == 2**64 - 1 and bytes(got[1]["content"]) == b""
    assert [r["error"] for r in got] == [None, None, "unexpected type", "content length mismatch", "too short", "too short"]
    assert all(r["content"] is None for r in got[2:])


def test_header_encode(spark):
    cols = [F.lit(v) for v in (1700000000, 7, 8899, 12, 34567)]
    assert bytes(spark.range(1).select(header.encode(*cols, F.lit(b"PING"))).first()[0]) == pack(1, 1700000000, 7, 8899, 12, 34567, b"PING")


def test_crc32c():
    assert numbers.crc32c_bytes(b"123456789") == 0xE3069283
    assert numbers.crc32c_bytes(b"56789", numbers.crc32c_bytes(b"1234")) == 0xE3069283


def test_expiry_rewrite(spark):
    now = 1700000000
    cases = [
        (["pksetexat", "key", "1700000100", "v"], frame([b"setex", b"key", b"100", b"v"])),
        (["pksetexat", "key", "1699999999", "v", "more"], frame([b"setex", b"key", b"-1", b"v"])),
        (["PKSETEXAT", "key", "1700000100", "v"], None), (["pksetexat", "key", " 5 ", "v"], None), (["pksetexat", "key", "soon", "v"], None),
        (["pksetexat", "key", "5"], None), (["set"], None), (["pksetexat", "k", "99999999999999999999", "v"], None),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "a array<string>")
    got = [r[0].encode() for r in df.select(commands.rewrite_expiry(F.col("a"), resp.serialize(F.col("a")), F.lit(now))).collect()]
    assert got == [want or frame([x.encode() for x in a]) for a, want in cases]


def test_data_type_and_keys(spark):
    names = {"SET": "string", "hset": "hash", "LPUSH": "list", "sadd": "set", "zadd": "zset", "flushdb": "unknown", "pksetexat": "unknown", "hsetnx": "unknown"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(commands.data_type(F.col("n"))).collect()] == list(names.values())
    row = spark.range(1).select(commands.partition_key(F.lit("db0"), F.lit("string"), F.lit("k")), commands.partition_key(F.lit("db0"), F.lit("unknown"), F.lit(None).cast("string")), commands.partition_key(F.lit("db0"), F.lit("set"), F.lit(""))).first()
    assert tuple(row) == ("db0:string:k", "db0:unknown", "db0:set")


def test_bytes_survive(spark):
    """Text that isn't UTF-8, control characters, and values longer than a base64 line."""
    raw = bytes(range(32)) + b'"\\/\x7f\xff\xc3Az' + b"x" * 90
    row = spark.createDataFrame([(raw,)], "b binary").select(
        commands.json_escape(F.col("b").cast("string")).cast("binary"), commands.ascii_lower(F.col("b").cast("string")).cast("binary"), commands.encode_payload(F.col("b"), "base64"), commands.ascii_lower(F.lit("ÄB"))
    ).first()
    escaped = bytes(row[0])
    assert b"\xff\xc3Az" in escaped and b"\\u0000" in escaped and b"\\u001f" in escaped and b"\\b" in escaped
    assert json.loads(b'"' + escaped.replace(b"\xff\xc3", b"") + b'"') == raw.replace(b"\xff\xc3", b"").decode()
    assert bytes(row[1]) == raw.replace(b"A", b"a") and row[3] == "Äb"
    import base64

    assert row[2] == base64.b64encode(raw).decode()


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1), st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1), BYTES), max_size=5))
def test_wal_round_trip(records):
    data = b"".join(wal.encode(*r) for r in records)
    assert [x[1:] for x in wal.decode(data, strict=True)] == records


def test_wal_damage():
    data = wal.encode(1, 1, 2, 3, b"abc") + wal.encode(1, 2, 2, 4, b"def")
    assert len(wal.encode(1, 1, 2, 3, b"abc")) == 59
    assert len(list(wal.decode(data[:-1]))) == 1 and len(list(wal.decode(data[:70]))) == 1
    with pytest.raises(ValueError):
        list(wal.decode(data[:-1], strict=True))
    for at in (0, 20, 57):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(wal.decode(bytes(bad)))
