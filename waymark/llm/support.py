"""Shared pieces: table access, row packing, batch maps, partition counts."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.runtime import configure

#: rows in an Arrow batch: texts may be long, and a worker holds a batch on both sides
BATCH_ROWS = 512
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session defaults, and small Arrow batches."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; whatever else the table carries cannot clash with working columns."""
    return df.select(*[quoted(n) for n in names])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns as they are, and the whole row in ``_doc``; ``unpacked`` is the way back."""
    return df.select(*[quoted(n).alias(n) for n in names], F.struct(*[quoted(c) for c in df.columns]).alias("_doc"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_doc.*")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``fn`` on each Arrow batch. Batches hold a bounded number of rows and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def parts_for(total_bytes: int | None, target: int, least: int = 1) -> int:
    """Partitions of about ``target`` bytes each; their number follows the data."""
    return max(least, math.ceil((total_bytes or 0) / target))


def crc32_of_id(column: str) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def bitmap(df: DataFrame, key: str, bits: int) -> np.ndarray:
    """One bit for each value of a long column, by its lowest bits.

    The driver gets ``bits / 64`` numbers at most, however many rows there are. The bitmap only spares work: a false pass
    is sorted out by a join later, a true one is never lost.
    """
    rows = (
        df.select(F.expr(f"{key} & {bits - 1}L").alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word"))
        .toPandas()
    )
    made = np.zeros(bits // 64, np.int64)
    made[rows["at"].to_numpy(np.int64)] = rows["word"].to_numpy(np.int64)
    return made.view(np.uint64)


def in_bitmap(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(table) * 64 - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
