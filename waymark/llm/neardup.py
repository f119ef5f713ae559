"""MinHash near-duplicates with odd sketches.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, a set holds the distinct shingles of
five words (fewer words: the whole sequence as one; none: empty, linked with nothing). Two texts are
linked when ``100 * intersection >= percent * union``.

1. One pass over the texts makes a digest of each set, its MinHash bands, and the odd sketch: each of
   the MinHash samples flips one bit, so the population count of the XOR of two sketches is at most
   twice the number of samples that differ.
2. Equal sets fold into one class before anything is compared.
3. Classes that share a band sit in a bucket. First all members of a bucket are compared with one of them,
   by length and sketch, then on full sets; what that links is merged. A bucket that lies in one component
   is settled.
4. The members of open buckets meet in blocks of at most BLOCK members and BLOCK_SHINGLES shingles (a larger
   bucket gives a block for each pair of its parts). A block compares sketches of members of different components as
   arrays, in the first bucket that two of them share, and tells which members have a candidate left;
   with the full sets of these, a second pass counts all intersections of a block at once. It hands on
   only the links that join components, no more than it has members. No list of pairs is made.

A sketch rejects a pair where it differs in more bits than the threshold allows (chance below 1e-9 that a
true link is rejected); every link is confirmed on full sets.

Cases: null text is empty; rows without a doc_id take part, and get the least id of their component
(null, and kept, if it has none); repeated rows share their component; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm import words
from waymark.llm.support import bitmap, in_bitmap, map_batches, packed, pick, prepare, unpacked
from waymark.operators.components import connected_components
from waymark.runtime import drop_stages, stage

SHINGLE = 5
#: chance that a pair exactly at the threshold shares no band
MISS = 3e-7
SKETCH_LONGS = 16
#: members and shingles of one part of a bucket
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: cells of a matrix of members and shingles that is in memory at once
CELLS = 1 << 22
#: bits of the bitmap that spares rows whose sets nobody wants
BITS = 1 << 25
SIGNATURE = (
    "doc_id long, text_md5 string, n_shingles long, class_hi long, class_lo long, bands array<long>, sketch array<long>"
)

class Shape(NamedTuple):
    """Bands and rows per band of the MinHash samples."""

    bands: int
    rows: int


def shape_for(percent: int) -> Shape:
    """Long bands for high thresholds, and as many as keep the chance of a miss below MISS."""
    rows = 6 if percent >= 85 else 5 if percent >= 75 else 4 if percent >= 60 else 2
    return Shape(max(1, math.ceil(math.log(MISS) / math.log1p(-min(0.999, (percent / 100) ** rows)))), rows)


@lru_cache(maxsize=8)
def _salts(shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the permutations, salts of sketch bits and of bands."""
    draw = np.random.default_rng(20240229)
    n = shape.bands * shape.rows
    multipliers = draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    bits = draw.integers(0, 1 << 63, n, dtype=np.uint64)
    return multipliers, bits, draw.integers(0, 1 << 63, tuple(shape), dtype=np.uint64) | np.uint64(1)


def samples(found: np.ndarray, shape: Shape) -> np.ndarray:
    """MinHash samples of a set of 64-bit hashes: least value under each multiplicative permutation."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    multipliers = _salts(shape)[0]
    least = np.full(len(multipliers), np.uint32(0xFFFFFFFF))
    for at in range(0, len(short), 1024):
        np.minimum(least, np.multiply.outer(short[at : at + 1024], multipliers).min(axis=0), out=least)
    return least


def odd_sketch(least: np.ndarray, shape: Shape) -> np.ndarray:
    """Parity bitmap: sample i flips the bit that a hash of (i, value) names."""
    bits = words.mix(least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55) + _salts(shape)[1]) >> np.uint64(64 - 10)
    parity = np.bincount(bits.astype(np.int64), minlength=SKETCH_LONGS * 64) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def band_keys(least: np.ndarray, shape: Shape) -> np.ndarray:
    folded = (least.astype(np.uint64).reshape(shape) * _salts(shape)[2]).sum(axis=1, dtype=np.uint64)
    return words.mix(folded + np.arange(shape.bands, dtype=np.uint64)).view(np.int64)


def _signatures(batch: pa.RecordBatch, shape: Shape) -> pa.RecordBatch:
    text = batch.column("text")
    md5, count, hi, lo, bands, sketch = [], [], [], [], [], []
    for value, found in zip(text, words.row_shingles(text, "blank", SHINGLE), strict=True):
        md5.append(hashlib.md5((value.as_py() or "").encode()).hexdigest())
        count.append(len(found))
        if not len(found):
            hi.append(None), lo.append(None), bands.append(None), sketch.append(None)
            continue
        hi.append(int(found.sum(dtype=np.uint64).view(np.int64)))
        lo.append(int(words.mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
        least = samples(found, shape)
        bands.append(band_keys(least, shape))
        sketch.append(odd_sketch(least, shape))
    longs = pa.list_(pa.int64())
    return pa.record_batch(
        [
            batch.column("doc_id"), pa.array(md5, pa.string()), pa.array(count, pa.int64()), pa.array(hi, pa.int64()),
            pa.array(lo, pa.int64()), pa.array(bands, longs), pa.array(sketch, longs),
        ],
        names=["doc_id", "text_md5", "n_shingles", "class_hi", "class_lo", "bands", "sketch"],
    )


def most_differing_bits(percent: int) -> int:
    """Bits in which two sketches of sets this similar differ at most, but for a chance below 1e-9.

    The number of differing samples is binomial; each flips two bits at most.
    """
    p, n = 1 - percent / 100, math.prod(shape_for(percent))
    tail, d = 0.0, n
    while d > 0:
        tail += math.comb(n, d) * p**d * (1 - p) ** (n - d)
        if tail > 1e-9:
            break
        d -= 1
    return 2 * d


def _apart(a: str, b: str) -> Column:
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH_LONGS)))


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct set: key, least row, size, bands, sketch."""
    traits = ("n_shingles", "bands", "sketch")
    return (
        signed.where("n_shingles > 0")
        .groupBy("class_hi", "class_lo")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_md5")).alias("row"),
            *[F.first(c).alias(c) for c in traits],
        )
        .select(
            F.xxhash64("class_hi", "class_lo").alias("k"), "class_hi", "class_lo",
            F.col("row.doc_id").alias("doc_id"), F.col("row.text_md5").alias("text_md5"), *traits,
        )
    )


def _row_key(doc_id: str, text_md5: str) -> Column:
    return F.xxhash64(doc_id, text_md5)


def sets_of(needed: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(k, members): the full set of each class in ``needed`` (k), from the text of its least row.

    Only rows that pass a bitmap of the wanted rows are shingled and shuffled.
    """
    spots = classes.join(needed.distinct(), "k", "left_semi").select(
        "k", "text_md5", _row_key("doc_id", "text_md5").alias("at")
    )
    spots = stage(spots, "neardup-spots")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(spots, "at", BITS))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = in_bitmap(wanted.value, batch.column("at").to_numpy(zero_copy_only=False).view(np.uint64))
        batch = batch.filter(pa.array(own))
        found = [x.view(np.int64) for x in words.row_shingles(batch.column("text"), "blank", SHINGLE)]
        columns = [batch.column("at"), batch.column("text_md5"), pa.array(found, pa.list_(pa.int64()))]
        return pa.record_batch(columns, names=["at", "text_md5", "members"])

    rows = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))
    rows = rows.select("text", "text_md5", _row_key("doc_id", "text_md5").alias("at"))
    found = map_batches(rows, run, "at long, text_md5 string, members array<long>")
    made = stage(
        found.join(spots, ["at", "text_md5"]).groupBy("k").agg(F.first("members").alias("members")), "neardup-sets"
    )
    drop_stages(spots)
    return made


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (src, dst) among class pairs (p, k): by length, by sketch, then on full sets."""
    traits = classes.select("k", "n_shingles", "sketch")
    p_side = traits.select(F.col("k").alias("p"), F.col("n_shingles").alias("p_n"), F.col("sketch").alias("p_sketch"))
    met = pairs.join(p_side, "p").join(traits, "k")
    alike = (F.least("p_n", "n_shingles") * 100 >= F.greatest("p_n", "n_shingles") * percent) & (
        _apart("p_sketch", "sketch") <= most_differing_bits(percent)
    )
    met = stage(met.where(alike).select("p", "k", (F.col("p_n") + F.col("n_shingles")).alias("both")), "neardup-met")
    sets = sets_of(met.select(F.explode(F.array("p", "k")).alias("k")), classes, docs)
    common = F.size(F.array_intersect("members", "p_members"))
    links = stage(
        met.join(sets.select(F.col("k").alias("p"), F.col("members").alias("p_members")), "p")
        .join(sets, "k")
        .where(common * 100 >= (F.col("both") - common) * percent)
        .select(F.col("p").alias("src"), F.col("k").alias("dst")),
        "neardup-links",
    )
    drop_stages(met, sets)
    return links


def _merged(components: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links: only what the links join of the components so far is worked on."""
    if components is None:
        return stage(connected_components(links), "neardup-components")
    named = components.select(F.col("id").alias("src"), F.col("component").alias("a"))
    edges = (
        links.join(named, "src", "left")
        .join(named.select(F.col("src").alias("dst"), F.col("a").alias("b")), "dst", "left")
        .select(F.coalesce("a", "src").alias("src"), F.coalesce("b", "dst").alias("dst"))
        .where("src <> dst")
    )
    edges = stage(edges.distinct(), "neardup-edges")
    if edges.isEmpty():
        return components
    higher = connected_components(edges).select(F.col("id").alias("component"), F.col("component").alias("top"))
    old = components.join(higher, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    new = higher.join(components, higher["component"] == components["id"], "left_anti")
    return stage(old.union(new.select(F.col("component").alias("id"), "top")), "neardup-components")


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of one length as a matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _candidates(block: pa.Table, percent: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a block that length, sketch, component and bucket leave open."""
    sketch = _longs(block["sketch"]).view(np.uint64)
    bands = _longs(block["bands"])
    part, size, own = (block[c].to_numpy() for c in ("part", "n_shingles", "c"))
    bucket = block["b"][0].as_py()
    crossing = block["i"][0].as_py() != block["j"][0].as_py()
    left, right = [], []
    for a in range(block.num_rows - 1):
        rest = np.arange(a + 1, block.num_rows)
        ok = own[rest] != own[a]
        if crossing:
            ok &= part[rest] != part[a]
        rest = rest[ok]
        small, large = np.minimum(size[rest], size[a]), np.maximum(size[rest], size[a])
        rest = rest[small * 100 >= large * percent]
        rest = rest[np.bitwise_count(sketch[rest] ^ sketch[a]).sum(axis=1) <= bits]
        shared = bands[rest] == bands[a]
        first = bands[a][shared.argmax(axis=1)] if len(rest) else bands[a][:0]
        rest = rest[first == bucket]
        left.append(np.full(len(rest), a))
        right.append(rest)
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def _intersections(lists: pa.ChunkedArray) -> np.ndarray:
    """Sizes of all intersections of the sets of a block."""
    column = lists.combine_chunks()
    n = len(column)
    row = np.repeat(np.arange(n), np.diff(column.offsets.to_numpy()))
    _, at, count = np.unique(column.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    number = np.cumsum(count > 1) - 1
    row, at = row[shared], number[at[shared]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    wide = int((count > 1).sum())
    total, width = np.zeros((n, n), np.float32), max(1, min(wide, CELLS // n))
    for low in range(0, wide, width):
        x, y = np.searchsorted(at, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[row[x:y], at[x:y] - low] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _joining(block: pa.Table, percent: int, bits: int) -> pa.Table:
    """Links of a block that join components: a spanning forest at most."""
    left, right = _candidates(block, percent, bits)
    common = _intersections(block["members"])[left, right] if len(left) else left
    size, k = block["n_shingles"].to_numpy(), block["k"].to_numpy()
    linked = common * 100 >= (size[left] + size[right] - common) * percent
    root = {c: c for c in block["c"].to_pylist()}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    own, made = block["c"].to_pylist(), []
    for a, b in zip(left[linked].tolist(), right[linked].tolist(), strict=True):
        x, y = top(own[a]), top(own[b])
        if x != y:
            root[x] = y
            made.append((a, b))
    a, b = (np.array([m[i] for m in made], np.int64) for i in (0, 1))
    return pa.table({"src": pa.array(k[a], pa.int64()), "dst": pa.array(k[b], pa.int64())})


def _blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Open members (b, k, c) dealt into blocks (b, i, j) of two parts of their bucket, or of one."""
    rows = members.join(classes.select("k", "n_shingles", "sketch", "bands"), "k")
    parts = F.expr(f"cast(ceil(greatest(count(1) / {BLOCK}D, sum(n_shingles) / {BLOCK_SHINGLES}D)) as int)")
    sizes = rows.groupBy("b").agg(parts.alias("parts"))
    part = F.expr("cast(pmod(xxhash64(k, b), parts) as int)")
    return (
        rows.join(sizes, "b").withColumn("part", part)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
        .select("b", "i", "j", "part", "k", "c", "n_shingles", "sketch", "bands")
    )


def links_of(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Components (id, component) of class keys; classes without links are not listed."""
    held = classes.select(F.explode("bands").alias("b"), "k")
    heads = held.groupBy("b").agg(F.min("k").alias("p"), F.max("k").alias("last")).where("p < last").select("b", "p")
    members = stage(held.join(heads, "b"), "neardup-members")
    pairs = members.where("p <> k").select("p", "k").distinct()
    components = _merged(None, _confirmed(pairs, classes, docs, percent))

    own = members.join(components.withColumnRenamed("id", "k"), "k", "left").select(
        "b", "k", F.coalesce("component", "k").alias("c")
    )
    still = own.groupBy("b").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("b")
    blocks = stage(_blocks(own.join(still, "b"), classes), "neardup-blocks")
    bits = most_differing_bits(percent)

    def open_members(block: pa.Table) -> pa.Table:
        at = np.unique(np.concatenate(_candidates(block, percent, bits)))
        return block.select(["b", "i", "j", "k"]).take(pa.array(at.astype(np.int64)))

    key = ["b", "i", "j"]
    left = stage(blocks.groupBy(*key).applyInArrow(open_members, "b long, i int, j int, k long"), "neardup-open")
    sets = sets_of(left.select("k"), classes, docs)
    full = blocks.join(left, [*key, "k"]).join(sets, "k")
    joins = full.groupBy(*key).applyInArrow(lambda block: _joining(block, percent, bits), "src long, dst long")
    components = _merged(components, stage(joins, "neardup-joins"))
    drop_stages(members, blocks, left, sets)
    return components


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document."""
    prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = stage(map_batches(own, partial(_signatures, shape=shape_for(percent)), SIGNATURE), "neardup-signed")
    classes = stage(classes_of(signed), "neardup-classes")
    components = links_of(classes, own, percent)
    of_class = stage(
        classes.select("k", "class_hi", "class_lo", "doc_id")
        .join(components.withColumnRenamed("id", "k"), "k", "left")
        .withColumn("component", F.coalesce("component", "k")),
        "neardup-grouped",
    )
    least = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "component").select("class_hi", "class_lo", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "class_hi", "class_lo")
        .join(named, ["class_hi", "class_lo"], "left")
        .select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` but for near-duplicates: of each component the row with the least id stays.

    Rows without an id stay; a row given twice with one id stays once.
    """
    gone = near_duplicates(docs, percent).where("not kept and doc_id is not null").select("doc_id").distinct()
    rows = packed(docs, "doc_id").join(gone, "doc_id", "left_anti")
    named = rows.where("doc_id is not null").groupBy("doc_id").agg(F.first("_doc").alias("_doc")).select("_doc")
    return unpacked(named.union(rows.where("doc_id is null").select("_doc")))
