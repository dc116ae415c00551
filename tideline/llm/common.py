"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` is safe, and much faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str = SPACES) -> Column:
    """Non-empty pieces between separators; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def document(key: str, text: str) -> Column:
    """What tells a document from others, and orders it: its key (null comes last), then a hash of its text."""
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.xxhash64(text).alias("of"))


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the cluster's shared folder; a temporary one only where none is configured, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tideline-{spark.sparkContext.applicationId}"


#: Folders of tables that stored() wrote and nothing has deleted.
_written: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def concluded(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Store what make() returns, and delete the tables that were stored on the way there."""
    before = len(_written)
    made = make()
    spark, last = made.sparkSession, len(_written)
    out = stored(made, name)
    for path in _written[before:last]:
        _delete(spark, path)
    del _written[before:last]
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by stored() that nothing reads any more."""
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, parent)


def tasks_for(size: int) -> int:
    """Tasks for so many bytes of rows that need much work each: 4 MB a task, or up to 256 MB where that would be over 32,768 tasks."""
    return max(16, min(size >> 22, max(1 << 15, size >> 28)))


#: Bytes up to which a table is broadcast once it has been measured; beyond, its joins shuffle.
BROADCAST_BYTES = 32 << 20
#: Bitmaps of join_texts(), and bits of each, which Spark fixes.
BITMAPS, BITMAP_BITS = 2048, 32768


def fits(df: DataFrame) -> bool:
    """Whether df may be broadcast. It is evaluated for that, so it should be stored or cheap."""
    size = F.lit(64)
    for f in df.schema:
        kind = f.dataType.typeName()
        flat = kind == "array" and f.dataType.elementType.typeName() in ("integer", "long", "double")
        per = {"array": F.size(f.name) * (8 if flat else 48), "string": F.octet_length(f.name), "binary": F.octet_length(f.name), "struct": F.lit(32)}.get(kind, F.lit(8))
        size = size + F.coalesce(per, F.lit(0))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def small(df: DataFrame) -> DataFrame:
    """df, marked for broadcast when its measured size allows."""
    return F.broadcast(df) if fits(df) else df


def join_texts(texts: DataFrame, keyed: DataFrame, key: str, how: str = "inner", broadcast: bool = True) -> DataFrame:
    """Join long rows with a stored table on key (inner or left), moving as few of the long rows as can be.

    A table that fits is broadcast, if it may be. For a larger one, a bitmap over hashed keys, of 8 MB at any size, is broadcast
    first: rows that it rules out are not shuffled. When it fills up it rules out less, and results stay the same.
    """
    if broadcast and fits(keyed):
        return texts.join(F.broadcast(keyed), key, how)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAPS * BITMAP_BITS))
    split = lambda h: (F.floor(h / BITMAP_BITS).cast("int").alias("_map"), (h % BITMAP_BITS).cast("int").alias("_bit"))
    maps = stored(keyed.select(*split(place(F.col(key)))).groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmaps")
    marked = texts.select("*", *split(place(F.col(key)))).join(F.broadcast(maps), "_map", "left")  # BITMAPS rows of 4 KB at most
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, _bit % 8)")) != 0, F.lit(False))
    maybe = marked.where(held).select(*texts.columns).join(keyed, key, how)
    if how == "inner":
        return maybe
    return maybe.unionByName(marked.where(~held).select(*texts.columns), allowMissingColumns=True)


def without(rows: DataFrame, gone: DataFrame, name: Column) -> DataFrame:
    """The rows whose name isn't in ``gone``, a stored table of one column of distinct names; long rows move as in join_texts()."""
    marked = gone.select(F.col(gone.columns[0]).alias("row_name"), F.lit(True).alias("row_gone"))
    named = rows.select(F.struct(*rows.columns).alias("row"), name.alias("row_name"))
    return join_texts(named, marked, "row_name", "left").where("row_gone IS NULL").select("row.*")
