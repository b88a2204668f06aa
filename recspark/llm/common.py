"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import ensure_checkpoint_dir, ship_package

#: Word separators of every operator: space and the controls 0x09-0x0D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor rereads files, it
    does not recompute), but compressed and column-pruned on every later read.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{what}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def join_small(df: DataFrame, small: DataFrame, on: Column | list[str], how: str = "inner",
               most: int = 200_000, salts: int = 64) -> DataFrame:
    """Join a large table with one row per host or leaf of it, whatever share of the rows one of them has.

    Up to ``most`` rows (counted) are broadcast; more are joined by a shuffle in
    which every row of ``small`` stands ``salts`` times, once for each deal of
    the large side.
    """
    if small.count() <= most:
        return df.join(F.broadcast(small), on, how)
    salted = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    spread = small.withColumn("__salt_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    on = on if isinstance(on, Column) else _all(salted[c] == spread[c] for c in on)
    names = [c for c in small.columns if c in df.columns]
    out = salted.join(spread, on & (F.col("__salt") == F.col("__salt_of")), how)
    for c in names:
        out = out.drop(spread[c])
    return out.drop("__salt", "__salt_of")


def _all(parts) -> Column:
    from functools import reduce
    return reduce(lambda a, b: a & b, parts)


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def crc(col: Column) -> Column:
    """crc32 of the value's text form; null for null."""
    return F.crc32(col.cast("string").cast("binary"))


def solid(texts):
    """Texts (an Arrow array) as a large_string array of its own, nulls empty.

    Some Arrow text kernels misread the offsets of a slice, so a slice is copied.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    if texts.offset or pa.types.is_string(texts.type):
        texts = texts.take(pa.array(range(len(texts)), pa.int64()))
    return pc.fill_null(texts.cast(pa.large_string()), "")


def blocks(batch, column: str, limit: int = 4 << 20):
    """Slices of an Arrow batch with about ``limit`` bytes of ``column`` each, one row at least."""
    import numpy as np
    import pyarrow.compute as pc
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
