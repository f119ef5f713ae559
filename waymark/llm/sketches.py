"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below 1/SCALE of the hash range. Its size follows the document, sketches of parts
merge by union, and the share of one sketch found in another estimates containment for documents of any sizes.
Shingles have five words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer words is one shingle.

A fingerprint is the number of distinct shingles and the kept hashes (their leading 32 bits below the threshold)
in ascending order. Likeness of a document to another: share of its kept hashes that the other's sketch keeps
too; if it keeps none, 1 for equal fingerprints and 0 otherwise.

The edited text of a document: its last floor(n/2) code points are replaced by the first as many (or all) of the
next document by ascending doc_id, after the last of the first. Rows are dealt into ranges of doc_id; only the
first and the last row of each range travel once more, to meet across the border.

Cases: null text is empty; the empty text's fingerprint is ``0:``; rows without an id come first; rows of one id are
ordered by text; repeated rows follow each other; a single row is its own next; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm import words
from waymark.llm.support import parts_for, pick, prepare

SHINGLE = 5
SCALE = 4
PART_BYTES = 24 << 20
#: rows sketched at once
ROWS = 128
_BITS = SCALE.bit_length() - 1
_LIMIT = np.uint64(1 << (64 - _BITS))


def sketch(found: np.ndarray) -> np.ndarray:
    """Kept part of sorted distinct 64-bit hashes."""
    below = found[: np.searchsorted(found, _LIMIT)]
    return np.unique((below >> np.uint64(32 - _BITS)).astype(np.uint32))


def sketches(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """(number of distinct shingles, sketch) of each text."""
    column = pa.array(texts, pa.large_string())
    return [(len(f), sketch(f)) for f in words.row_shingles(column, "blank", SHINGLE)]


def fingerprint(made: tuple[int, np.ndarray]) -> str:
    return f"{made[0]}:{made[1].astype('>u4').tobytes().hex()}"


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of ``a`` that ``b`` contains."""
    if not len(a[1]):
        return float(a[0] == b[0] and not len(b[1]) and a[0] == 0)
    return len(np.intersect1d(a[1], b[1], assume_unique=True)) / len(a[1])


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _described(ids: list, texts: list[str], following: list[str], kind: pa.DataType) -> pa.RecordBatch:
    """Rows of the result for documents and the texts after them."""
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    own, other = sketches(texts), sketches(changed)
    # the next text is mostly the next row's: sketched once
    known = dict(zip(texts, own, strict=True))
    missing = [t for t in dict.fromkeys(following) if t not in known]
    known |= dict(zip(missing, sketches(missing), strict=True))

    def near(a: tuple, text_a: str, b: tuple, text_b: str) -> float:
        return 1.0 if text_a == text_b else likeness(a, b)

    return pa.record_batch(
        [
            pa.array(ids, kind), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([fingerprint(s) for s in own]), pa.array([fingerprint(s) for s in other]),
            pa.array([near(s, t, o, c) for s, t, o, c in zip(own, texts, other, changed, strict=True)]),
            pa.array([near(s, t, known[f], f) for s, t, f in zip(own, texts, following, strict=True)]),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of an ordered partition but the last, whose next row is elsewhere."""
    ids, texts, kind = [], [], None
    for whole in batches:
        kind = whole.schema.field("doc_id").type
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            ids += batch.column("doc_id").to_pylist()
            texts += batch.column("text").to_pylist()
            if len(ids) > 1:
                yield _described(ids[:-1], texts[:-1], texts[1:], kind)
                ids, texts = ids[-1:], texts[-1:]


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last row of an ordered partition."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = first or batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1, 1)
    for name, row in (("first", first), ("last", last)):
        if row is not None:
            yield pa.record_batch([*row.columns, pa.array([name])], names=[*row.schema.names, "side"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ids, texts, following = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
            yield _described(ids, texts, following, batch.schema.field("doc_id").type)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    total = own.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    kind = own.schema["doc_id"].dataType.simpleString()
    result = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    dealt = (
        own.repartitionByRange(parts_for(total, PART_BYTES), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    # the exchange lets the three uses below share one pass
    border = dealt.mapInArrow(_outer, f"part int, doc_id {kind}, text string, side string").repartition("part")
    firsts = border.where("side = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    lasts = border.where("side = 'last'")
    # one row per partition
    order = Window.orderBy("part")
    least = F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = lasts.select("part", F.coalesce(F.lead("part").over(order), least).alias("next_part"))
    across = lasts.join(after, "part").join(firsts, "next_part").select("doc_id", "text", "following")
    return dealt.mapInArrow(_inner, result).union(across.mapInArrow(_across, result))
