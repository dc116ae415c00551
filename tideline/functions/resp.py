"""Length-prefixed command arrays: ``*n`` then ``$len`` and bytes for each argument, lines ended by CR LF."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRLF = "\r\n"
PARSED = T.StructType([T.StructField("argv", T.ArrayType(T.BinaryType())), T.StructField("error", T.StringType())])


def serialize(argv: Column) -> Column:
    """The text form of an array of valid strings; lengths count bytes."""
    parts = F.transform(argv, lambda a: F.concat(F.lit("$"), F.octet_length(a).cast("string"), F.lit(CRLF), a, F.lit(CRLF)))
    return F.concat(F.lit("*"), F.size(argv).cast("string"), F.lit(CRLF), F.array_join(parts, ""))


def serialize_binary(argv: Column) -> Column:
    """The binary form of an array of binaries, byte for byte."""
    text = lambda *c: F.encode(F.concat(*c), "UTF-8")
    head = text(F.lit("*"), F.size(argv).cast("string"), F.lit(CRLF))
    one = lambda a: F.concat(text(F.lit("$"), F.octet_length(a).cast("string"), F.lit(CRLF)), a, text(F.lit(CRLF)))
    return F.aggregate(argv, head, lambda out, a: F.concat(out, one(a)))


def _count(raw: bytes, at: int, mark: bytes) -> tuple[int, int]:
    """The number after ``mark`` at a place, and where the next item starts."""
    if raw[at : at + 1] != mark:
        raise ValueError(f"expected '{mark.decode()}' at byte {at}")
    end = raw.find(b"\r\n", at)
    digits = raw[at + 1 : end] if end >= 0 else b""
    body = digits[1:] if digits[:1] == b"-" else digits
    if not body.isdigit():
        raise ValueError(f"no number at byte {at}")
    if not -(2**63) <= (n := int(digits)) < 2**63:
        raise ValueError(f"number out of range at byte {at}")
    if n < 0:
        raise ValueError(f"negative length at byte {at}")
    return n, end + 2


def parse_bytes(raw: bytes | None) -> tuple[list[bytes] | None, str | None]:
    """(arguments, None), or (None, what is wrong)."""
    raw = raw or b""
    try:
        n, at = _count(raw, 0, b"*")
        argv = []
        for _ in range(n):
            size, start = _count(raw, at, b"$")
            at = start + size + 2
            if raw[start + size : at] != b"\r\n":
                raise ValueError(f"argument at byte {start} is cut off")
            argv.append(raw[start : start + size])
        if at != len(raw):
            raise ValueError(f"{len(raw) - at} bytes after the end")
    except ValueError as e:
        return None, str(e)
    return argv, None


@F.pandas_udf(PARSED)
def parse(raw: pd.Series) -> pd.DataFrame:
    """Arrow-batched parser: a struct of argv and error, one of which is null."""
    made = [parse_bytes(r) for r in raw]
    return pd.DataFrame({"argv": [m[0] for m in made], "error": [m[1] for m in made]})
