"""Token ids as Parquet list columns, written in ascending doc_id order and read back selectively.

Rows are dealt into ranges of doc_id, each range is one ordered file: dictionary-encoded lists, row groups
of ROW_GROUP bytes and pages of PAGE bytes with page indexes. Each row holds its range (``part``) and its place
in it, so that sizes, offsets and ids are read by column: the offset of a document needs ``part``, ``place`` and
``n_tokens`` only, its tokens one list.

Files go to the folder that the session names for shared tables; each file is written by Spark's own
committer, so a lost executor's files are written again.

Cases: null and empty texts hold the end id alone; rows without an id come first; rows of one id are
ordered by their text; repeated rows are written each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.pieces import encoder
from waymark.llm.support import parts_for, pick, prepare
from waymark.runtime import shared_dir

END = 0
PART_BYTES = 32 << 20
ROW_GROUP, PAGE = 16 << 20, 128 << 10
#: rows encoded at once
ROWS = 256


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode whole texts and write them in ascending doc_id order under ``path``."""
    own = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    total = own.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        place = 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                rows = encode(batch.column("text").to_pylist())
                sizes = np.array([len(x) + 1 for x in rows], np.int64)
                ends = np.cumsum(sizes)
                flat = np.full(int(ends[-1]), END, np.int32)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = np.concatenate(rows) if rows else flat[:0]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat))
                yield pa.record_batch(
                    [
                        batch.column("part"), pa.array(np.arange(place, place + batch.num_rows)), batch.column("doc_id"),
                        pa.array(sizes), lists,
                    ],
                    names=["part", "place", "doc_id", "n_tokens", "ids"],
                )
                place += batch.num_rows

    (
        own.repartitionByRange(parts_for(total, PART_BYTES), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
        .mapInArrow(run, f"part int, place long, doc_id {kind}, n_tokens long, ids array<int>")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.size", PAGE)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False)).astype("<u4")
        sizes = np.diff(lists.offsets.to_numpy())
        ends = np.cumsum(sizes)
        crc = [zlib.crc32(flat[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
        columns = [batch.column("part"), batch.column("place"), batch.column("doc_id")]
        yield pa.record_batch(
            [*columns, pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
            names=["part", "place", "doc_id", "n_tokens", "ids_crc32"],
        )


def offsets(files: DataFrame) -> DataFrame:
    """(part, place, start) from the sizes alone; one row per file in the only ungrouped window."""
    sizes = files.select("part", "place", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(parts, "part").select("part", "place", (F.col("first") + F.col("ahead")).cast("long").alias("start"))


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files."""
    kind = files.schema["doc_id"].dataType.simpleString()
    seen = files.select("part", "place", "doc_id", "ids").mapInArrow(
        _checks, f"part int, place long, doc_id {kind}, n_tokens long, ids_crc32 long"
    )
    return seen.join(offsets(files), ["part", "place"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files of ``docs`` and describe each document from what is read back."""
    spark = prepare(docs.sparkSession)
    path = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return read(spark.read.parquet(path))
