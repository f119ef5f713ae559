"""Benchmark decontamination by winnowing.

Words are ``[0-9a-z]`` and everything beyond ASCII, after lower-casing A-Z. A window is LENGTH consecutive
words of an item; an item of fewer words (one at least) is one window. Both sides keep the least k-gram hash
of every run of w consecutive k-grams, where k + w - 1 is the window's length: a shared window holds
one such run, so both sides keep the same k-gram of it. Each kept k-gram is extended by its neighbours to the
windows around it, and the extended k-grams are joined: those of the items are one row per window, however many
surroundings a common k-gram has. Where they meet, the window's words are hit. Windows name the list of items they
stand in, and a document takes each list once.

Before the extension the documents' k-grams pass a bitmap of the items' k-grams. The bitmap has BITS bits at any
size of the benchmark; a false pass costs a row, a true one is never lost.

Cases: null or wordless texts have no words and no hits; items without words, and null items, are never
hit; items without an id flag documents but are not listed; equal items are matched once and listed each;
repeated rows are judged each; other columns are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm import words
from waymark.llm.support import bitmap, in_bitmap, map_batches, packed, pick, prepare, unpacked
from waymark.runtime import stage

LENGTH = 10
#: words kept on either side of a k-gram: what a window can reach beyond it
REACH = LENGTH // 2
BITS = 1 << 24
_OUTSIDE_DOC, _OUTSIDE_ITEM = np.uint64(1), np.uint64(2)


def gram_length(length: int) -> int:
    return (length + 1) // 2


def winnow(hashes: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, k-gram keys) kept of rows of words for windows of ``length`` words."""
    k = gram_length(length)
    w = length - k + 1
    grams = words.gram_hashes(hashes, k)
    n = len(grams) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, w):
        lower = grams[j : j + n] < least
        least[lower] = grams[j : j + n][lower]
        at[lower] = j
    start = np.arange(n)
    row = np.searchsorted(bounds, start, side="right") - 1
    inside = start + length <= bounds[row + 1]
    kept = np.zeros(len(grams), bool)
    kept[(start + at)[inside]] = True
    kept = np.flatnonzero(kept)
    return kept, words.mix(grams[kept] + np.uint64(length))


def context(hashes: np.ndarray, bounds: np.ndarray, kept: np.ndarray, length: int, outside: np.uint64) -> np.ndarray:
    """REACH words before (nearest first) and REACH after each kept k-gram; ``outside`` beyond the row."""
    k = gram_length(length)
    row = np.searchsorted(bounds, kept, side="right") - 1
    low, high = bounds[row], bounds[row + 1]
    made = np.full((len(kept), 2 * REACH), outside, np.uint64)
    for j in range(min(REACH, length - k)):
        before, after = kept - 1 - j, kept + k + j
        ok = before >= low
        made[ok, j] = hashes[before[ok]]
        ok = after < high
        made[ok, REACH + j] = hashes[after[ok]]
    return made


def _struct_lists(per_row: np.ndarray, key, length, pos, around) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    flat = pa.array(around.reshape(-1).view(np.int64))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * (2 * REACH)), flat)
    fields = pa.StructArray.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(length, pa.int32()), pa.array(pos, pa.int32()), lists],
        names=["f", "length", "pos", "around"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets), fields)


def kept_grams(column: pa.Array, lengths: list[int], outside: np.uint64, passes=None, whole_item: bool = False):
    """Per row of text: number of words, and its kept k-grams with their surroundings.

    ``passes`` filters the k-gram keys; ``whole_item``: each row has the one window length of its own size.
    """
    data, offsets = words.buffer_of(column)
    counts, lists = [], []
    for first, last in words.chunks(offsets):
        own = offsets[first : last + 1]
        hashes, bounds = words.word_hashes(data[own[0] : own[-1]], own - own[0], "alnum")
        size = np.diff(bounds)
        counts.append(size)
        found = []
        for length in lengths:
            kept, keys = winnow(hashes, bounds, length)
            row = np.searchsorted(bounds, kept, side="right") - 1
            ok = np.ones(len(kept), bool) if passes is None else passes(keys)
            if whole_item:
                ok &= np.minimum(size[row], LENGTH) == length
            kept, keys, row = kept[ok], keys[ok], row[ok]
            around = context(hashes, bounds, kept, length, outside)
            found.append((row, keys, np.full(len(kept), length), kept - bounds[row], around))
        row, keys, length, pos, around = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(row, kind="stable")
        per_row = np.bincount(row, minlength=last - first)
        lists.append(_struct_lists(per_row, keys[order], length[order], pos[order], around[order]))
    return np.concatenate(counts), pa.concat_arrays(lists)


_GRAM = "array<struct<f:long,length:int,pos:int,around:array<long>>>"


def _item_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, grams = kept_grams(batch.column("text"), list(range(1, LENGTH + 1)), _OUTSIDE_ITEM, whole_item=True)
    return pa.record_batch([batch.column("item_id"), grams], names=["item_id", "grams"])


def item_grams(items: DataFrame) -> DataFrame:
    """Kept k-grams of the items in their surroundings."""
    own = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    flat = map_batches(own, _item_rows, f"item_id string, grams {_GRAM}")
    return stage(flat.select("item_id", F.explode("grams").alias("g")).select("item_id", "g.*"), "decontaminate-items")


def document_grams(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """Per document: row key, number of words, and its k-grams that pass the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36

        for batch in batches:
            if not batch.num_rows:
                continue
            counts, grams = kept_grams(batch.column("text"), lengths, _OUTSIDE_DOC, partial(in_bitmap, shared.value))
            key = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield pa.record_batch(
                [key, batch.column("doc_id"), batch.column("text_md5"), pa.array(counts, pa.int64()), grams],
                names=["row", "doc_id", "text_md5", "n_words", "grams"],
            )

    own = pick(docs, "doc_id", "text").select(
        "doc_id", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")
    )
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"row long, doc_id {kind}, text_md5 string, n_words long, grams {_GRAM}")


def extended(grams: DataFrame, outside: np.uint64, *keep: str) -> DataFrame:
    """``keep``, start, length and key of the windows around each k-gram that lie inside its text.

    A window of ``length`` words goes ``a`` words back from the k-gram and ``length div 2 - a`` beyond it.
    """
    return (
        grams.select("*", F.expr("explode(sequence(0, length div 2))").alias("a"))
        .withColumn("b", F.expr("length div 2 - a"))
        .where(
            f"(a = 0 or around[cast(a - 1 as int)] <> {outside}) "
            f"and (b = 0 or around[cast({REACH} + b - 1 as int)] <> {outside})"
        )
        .select(
            *keep, F.expr("cast(pos - a as int)").alias("start"), "length",
            F.expr(
                f"xxhash64(f, length, a, slice(around, 1, cast(a as int)), slice(around, {REACH + 1}, cast(b as int)))"
            ).alias("key"),
        )
    )


def item_windows(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list of items of each window, items of each list)."""
    listed = (
        extended(grams, _OUTSIDE_ITEM, "item_id")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .withColumn("list", F.xxhash64("items"))
    )
    listed = stage(listed, "decontaminate-windows")
    return listed.select("key", "list"), listed.groupBy("list").agg(F.first("items").alias("items"))


def meetings(seen: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows of documents that are windows of items: one row each, as every window of an item is one row."""
    own = seen.where("size(grams) > 0").select("row", F.explode("grams").alias("g")).select("row", "g.*")
    met = extended(own, _OUTSIDE_DOC, "row").join(windows, "key")
    return met.select("row", "list", "start", F.expr("start + length").alias("end"))


def hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_words, shared windows (row, start, end, list), items of each list)."""
    grams = item_grams(items)
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect()) or [LENGTH]  # 1 to LENGTH
    seen = stage(document_grams(docs, bitmap(grams, "f", BITS), lengths), "decontaminate-documents")
    windows, lists = item_windows(grams)
    return seen, stage(meetings(seen, windows).distinct(), "decontaminate-runs"), lists


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    prepare(docs.sparkSession)
    seen, runs, lists = hits(docs, pick(items, "item_id", "text"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        runs.groupBy("row", "start").agg(F.max("end").alias("end"))
        .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.expr("greatest(0, end - greatest(start, reached))")).alias("n_hit"))
    )
    listed = (
        runs.select("row", "list").distinct().join(lists, "list").select("row", F.explode("items").alias("item_id"))
        .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return (
        seen.select("row", "doc_id", "n_words")
        .join(covered, "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items_of).cast("long").alias("n_items"),
            F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item."""
    prepare(docs.sparkSession)
    seen, runs, _ = hits(docs, pick(items, "item_id", "text"))
    gone = seen.join(runs.select("row").distinct(), "row", "left_semi").select("text_md5").distinct()
    rows = packed(docs, "text").withColumn("text_md5", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return unpacked(rows.join(gone, "text_md5", "left_anti"))
