"""The 34-byte log record header: type, time, term, logic id, file, offset and content length, little-endian."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import swapped, write_le

SIZE, RECORD_TYPE = 34, 1
# Name, first byte, bytes, Spark type.
FIELDS = [("type", 0, 2, "int"), ("exec_time", 2, 4, "long"), ("term_id", 6, 4, "long"), ("logic_id", 10, 8, "decimal(20,0)"), ("filenum", 18, 4, "long"), ("offset", 22, 8, "decimal(20,0)")]


def decode(raw: Column) -> Column:
    """A struct of the fields, content and error; fields are null where error isn't."""

    def parsed(r: Column) -> Column:
        total, head = F.octet_length(r["raw"]), r["head"]
        number = lambda at, n, kind: F.conv(swapped(head, at, n), 16, 10).cast(kind)
        error = (
            F.when(r["raw"].isNull() | (total < SIZE), F.lit("too short"))
            .when(F.substring(head, 1, 4) != F.lit(RECORD_TYPE.to_bytes(2, "little").hex()), F.lit("unexpected type"))
            .when(number(30, 4, "long") != total - SIZE, F.lit("content length mismatch"))
        )
        parts = [number(at, n, kind).alias(name) for name, at, n, kind in FIELDS]
        return F.struct(*parts, F.substring(r["raw"], F.lit(SIZE + 1), F.greatest(total - SIZE, F.lit(0))).alias("content"), error.alias("error"))

    names = [name for name, *_ in FIELDS] + ["content"]
    # inside a lambda a record and the hex text of its header are values, evaluated once, and so are the parsed fields
    once = lambda value, f: F.get(F.transform(F.array(value), f), 0)
    made = once(F.struct(raw.alias("raw"), F.lower(F.hex(F.substring(raw, 1, SIZE))).alias("head")), parsed)
    return once(made, lambda p: F.struct(*[F.when(p["error"].isNull(), p[n]).alias(n) for n in names], p["error"].alias("error")))


def encode(exec_time: Column, term_id: Column, logic_id: Column, filenum: Column, offset: Column, content: Column) -> Column:
    values = [F.lit(RECORD_TYPE), exec_time, term_id, logic_id, filenum, offset]
    return F.concat(*[write_le(v, n) for v, (_, _, n, _) in zip(values, FIELDS)], write_le(F.octet_length(content), 4), content)
