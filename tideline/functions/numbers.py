"""Little-endian integers in binary columns, and CRC-32C."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def _swap(hexed: Column, n: int) -> Column:
    """Reverse the bytes of a hex text; reverse() on binary would go by characters."""
    return F.concat(*[F.substring(hexed, 2 * k + 1, 2) for k in range(n - 1, -1, -1)])


def swapped(hexed: Column, at: int, n: int) -> Column:
    """The hex text of n bytes from a byte on (from 0), last byte first."""
    return F.concat(*[F.substring(hexed, 2 * (at + k) + 1, 2) for k in range(n - 1, -1, -1)])


def read_le(raw: Column, at: int, n: int, kind: str) -> Column:
    """The n-byte unsigned integer at a byte (from 0)."""
    return F.conv(_swap(F.hex(F.substring(raw, at + 1, n)), n), 16, 10).cast(kind)


def write_le(value: Column, n: int) -> Column:
    """n bytes of an unsigned integer."""
    return F.unhex(_swap(F.lpad(F.conv(value.cast("decimal(20,0)").cast("string"), 10, 16), 2 * n, "0"), n))


def _table() -> list[int]:
    out = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0x82F63B78 if b & 1 else 0)
        out.append(b)
    return out


_CRC = _table()


def crc32c_bytes(data: bytes, crc: int = 0) -> int:
    crc ^= 0xFFFFFFFF
    for b in data:
        crc = crc >> 8 ^ _CRC[(crc ^ b) & 255]
    return crc ^ 0xFFFFFFFF


_CRC_ARRAY = np.array(_CRC, dtype=np.uint32)


def crc32c_ranges(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums of ranges of a byte array, a byte of all of them at a time; the last few, where others have ended, one by one."""
    order = np.argsort(-sizes, kind="stable")
    at, negative = starts[order].astype(np.int64), -sizes[order].astype(np.int64)
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    done = 0
    while (n := int(np.searchsorted(negative, -done))) >= 8:
        c = crc[:n]
        crc[:n] = (c >> np.uint32(8)) ^ _CRC_ARRAY[(c ^ data[at[:n] + done]) & np.uint32(255)]
        done += 1
    for k in range(n):
        crc[k] = crc32c_bytes(data[at[k] + done : at[k] - negative[k]].tobytes(), int(crc[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty(len(order), dtype=np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def crc32c_many(texts: list[bytes]) -> np.ndarray:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    return crc32c_ranges(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes)


@F.pandas_udf(LongType())
def crc32c(data: pd.Series) -> pd.Series:
    """Castagnoli checksum; Spark has only the other polynomial."""
    sums = crc32c_many([d or b"" for d in data]).astype(object)
    return pd.Series([None if d is None else int(c) for d, c in zip(data, sums)], dtype=object)
