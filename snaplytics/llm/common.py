"""Small helpers the operators share: word patterns, staged tables, size-checked broadcast."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"

#: Spark removes a query's shuffle files at its end; a query that still asks for them works them out again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Upper bound in bytes on a table that is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 8 << 20
#: The same where a query broadcasts many tables one after the other, as each round of ``graph`` does: the
#: driver's memory holds them beside each other until it happens to collect its garbage.
SIDE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders of the tables staged inside the open ``only_kept`` blocks.
_INSIDE: list[list[str]] = []


@contextmanager
def only_kept(spark: SparkSession) -> Iterator[list[str]]:
    """Tables staged inside the block go with its end, but those whose folders are put on the list it gives."""
    kept: list[str] = []
    _INSIDE.append([])
    try:
        yield kept
    finally:
        drop_staged(spark, [path for path in _INSIDE.pop() if path not in kept])


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM at hand (Spark Connect): they go with the application's folder
        return
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def last_staged() -> str:
    """The folder of the table staged last in the open block."""
    return _INSIDE[-1][-1]


def staged(df: DataFrame, name: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage at
    storage every executor reaches, so a lost executor costs no earlier work. With ``by``,
    one folder per value of that (last) column, in files that follow the data. The shuffle files
    of the write go with its end, so those of one step don't lie beside the next one's."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    for inside in _INSIDE:
        inside.append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        if by:
            df.hint("rebalance", by).write.option("compression", compression).partitionBy(by).parquet(path)
        else:
            df.write.option("compression", compression).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cell_bytes(cell: Column, kind: T.DataType) -> Column:
    """About the bytes of a cell in memory: texts and binaries by length, arrays, maps and structs by
    what they hold; NULLs and numbers as one word with its overhead."""
    least = F.lit(16).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return least + F.coalesce(F.octet_length(cell), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            inside = F.aggregate(cell, F.lit(0).cast("long"), lambda acc, x: acc + cell_bytes(x, kind.elementType))
        else:
            inside = F.size(cell).cast("long") * 8
        return least + F.when(cell.isNull(), F.lit(0)).otherwise(inside)
    if isinstance(kind, T.MapType):
        return cell_bytes(F.map_keys(cell), T.ArrayType(kind.keyType)) + cell_bytes(F.map_values(cell), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((cell_bytes(cell[f.name], f.dataType) for f in kind.fields), least)
    return least


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast when its measured size is within the bound;
    otherwise leave the join to shuffle (and AQE to split its hot keys)."""
    width = sum((cell_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def word_array(text: Column) -> Column:
    """The maximal runs of non-white characters of a text, as an array; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unclash(df: DataFrame, *names: str) -> dict[str, str]:
    """Working names for added columns that no input column has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for n in names:
        name = f"_{n}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out[n] = name
    return out
