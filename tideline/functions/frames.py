"""Captured transport streams: frames of a 4-byte big-endian length and that many bytes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAMES = T.StructType([T.StructField("frames", T.ArrayType(T.BinaryType())), T.StructField("rest", T.BinaryType())])


def frame(payload: Column) -> Column:
    """One frame."""
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(payload)), 8, "0")), payload)


def split_bytes(raw: bytes | None) -> tuple[list[bytes], bytes]:
    """The whole frames of a capture, and what is left of one that isn't whole."""
    raw, out, at = raw or b"", [], 0
    while len(raw) - at >= 4:
        size = int.from_bytes(raw[at : at + 4], "big")
        if len(raw) - at - 4 < size:
            break
        out.append(raw[at + 4 : at + 4 + size])
        at += 4 + size
    return out, raw[at:]


@F.pandas_udf(FRAMES)
def split(raw: pd.Series) -> pd.DataFrame:
    made = [split_bytes(r) for r in raw]
    return pd.DataFrame({"frames": [m[0] for m in made], "rest": [m[1] for m in made]})
