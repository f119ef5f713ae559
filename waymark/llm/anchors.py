"""SimHash near-duplicates compared at anchor points of a covering code.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a text's shingles are its runs of four words, repeats
included, joined by one space (fewer words: the whole sequence). Bit i of the fingerprint is set where more than half
of the shingles' XXH64 values (UTF-8, seed 42) have bit i. Texts without words have fingerprint 0.
Fingerprints that differ in at most DISTANCE bits are linked.

The anchors are the codewords of a direct sum of perfect codes (CODES) over the 64 bits: two binary Golay codes of
length 23 (radius 3), a Hamming code of length 15 and one of length 3 (radius 1). Every 64-bit value has one home
anchor within the covering radius 8. Two linked fingerprints have a midpoint, at most ``ceil(DISTANCE / 2)`` bits
from each, and its home anchor lies within the covering radius plus that half of the threshold of both. So each distinct
fingerprint is replicated to all anchors whose distance exceeds the code's radius, summed over the blocks, by
at most half the threshold (about 160 of the 2**36), and any two linked ones meet at an anchor: none is lost, and
unlinked ones rarely meet. Replicating to the full threshold would only be needed if one side stayed at its home.

1. Equal fingerprints fold into one class.
2. An aggregation per anchor keeps the least and the largest member and their number. Anchors of one member end there; the
   least and the largest are compared at once, which settles anchors of two, and what that links is merged.
3. At larger anchors that still hold several components, members of different components are compared as arrays, in blocks
   of at most two parts of BLOCK members; a block hands on only the links that join components. No list of pairs is made.

Cases: null text has no words; rows without a doc_id take part and get the least id of their component
(null if it has none); repeated rows share their component; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.support import bitmap, in_bitmap, map_batches, parts_for, pick, prepare
from waymark.operators.components import connected_components
from waymark.runtime import drop_stages, stage, stage_counted

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: fixed values: length, generator polynomial and radius of perfect cyclic codes whose lengths add up to 64
CODES = (
    (23, 0b110001110101, 3),
    (23, 0b110001110101, 3),
    (15, 0b10011, 1),
    (3, 0b111, 1),
)
#: shingles hashed at once
RUN = 1 << 14
#: members of a part of an anchor, rows of a group of blocks, fingerprints replicated by a task
BLOCK, BIN, SPREAD = 4096, 1 << 16, 1 << 14
#: bits of the bitmap that spares rows whose anchors hold two members at most
BITS = 1 << 25


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = min(SHINGLE, len(words))
    n = len(words) - k + 1
    starts, ends = (ends - sizes)[:n], ends[k - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, RUN):
        places = zip(starts[at : at + RUN].tolist(), ends[at : at + RUN].tolist(), strict=True)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in places), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    made = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
    return pa.record_batch([batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"])


@lru_cache(maxsize=None)
def _syndromes(length: int, generator: int) -> np.ndarray:
    """Syndrome of each single bit: its power of x modulo the generator."""
    top, made, x = 1 << (generator.bit_length() - 1), [], 1
    for _ in range(length):
        made.append(x)
        x <<= 1
        x = x ^ generator if x & top else x
    return np.array(made, np.uint64)


def _patterns(length: int, generator: int, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """All patterns of so many bits (one at least), and their syndromes."""
    columns = _syndromes(length, generator)
    chosen = np.array(list(combinations(range(length), weight)), np.int64).reshape(-1, weight)
    bits = np.bitwise_or.reduce(np.uint64(1) << chosen.astype(np.uint64), axis=1)
    return bits, np.bitwise_xor.reduce(columns[chosen], axis=1)


@lru_cache(maxsize=None)
def tables(length: int, generator: int, radius: int, flips: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(leader, levels) by syndrome: the pattern from a value to its home codeword, and for e = 1 to ``flips`` the steps
    from there to the codewords that a change of e bits, and no smaller one, makes home. Rows are padded with 0."""
    size = 1 << (generator.bit_length() - 1)
    leader = np.zeros(size, np.uint64)
    for weight in range(1, radius + 1):
        bits, found = _patterns(length, generator, weight)
        leader[found] = bits
    seen = [{0} for _ in range(size)]
    levels = []
    for e in range(1, flips + 1):
        bits, found = _patterns(length, generator, e)
        rows = []
        for s in range(size):
            steps = leader[s] ^ bits ^ leader[np.uint64(s) ^ found]
            rows.append(sorted(set(steps.tolist()) - seen[s]))
            seen[s].update(rows[-1])
        level = np.zeros((size, max(map(len, rows))), np.uint64)
        for s, row in enumerate(rows):
            level[s, : len(row)] = row
        levels.append(level)
    return leader, tuple(levels)


def anchors_of(fingerprints: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor that each fingerprint is replicated to."""
    flips, n = -(-distance // 2), len(fingerprints)
    home, shift = fingerprints.copy(), 0
    # steps from home by the bits spent so far; the flag tells real steps from padding
    spent = {0: [(np.zeros((n, 1), np.uint64), np.ones((n, 1), bool))]}
    for length, generator, radius in CODES:
        leader, levels = tables(length, generator, radius, flips)
        syndrome = np.zeros(n, np.uint64)
        for i, column in enumerate(_syndromes(length, generator)):
            syndrome ^= ((fingerprints >> np.uint64(shift + i)) & np.uint64(1)) * column
        at = syndrome.astype(np.int64)
        home ^= leader[at] << np.uint64(shift)
        own = [level[at] for level in levels]
        grown = {e: list(found) for e, found in spent.items()}
        for e, found in spent.items():
            for more in range(1, flips - e + 1):
                step = own[more - 1] << np.uint64(shift)
                for steps, real in found:
                    both = steps[:, :, None] ^ step[:, None, :]
                    kept = real[:, :, None] & (step != 0)[:, None, :]
                    grown.setdefault(e + more, []).append((both.reshape(n, -1), kept.reshape(n, -1)))
        spent, shift = grown, shift + length
    steps = np.concatenate([s for found in spent.values() for s, _ in found], axis=1)
    real = np.concatenate([r for found in spent.values() for _, r in found], axis=1)
    row, _ = np.nonzero(real)
    return row, (home[:, None] ^ steps)[real]


def _short(anchor: np.ndarray) -> np.ndarray:
    """Bits of anchors for the bitmap: in a cyclic code, as many consecutive places as it has words are free."""
    block = [(anchor >> np.uint64(at)) & np.uint64((1 << free) - 1) for at, free in ((0, 12), (23, 12), (46, 11))]
    return block[0] | ((block[1] ^ (block[2] << np.uint64(1))) << np.uint64(12)) ^ (block[2] << np.uint64(14))


#: the same in Spark
_SHORT = (
    "(anchor & 4095) | (((shiftright(anchor, 23) & 4095) ^ shiftleft(shiftright(anchor, 46) & 2047, 1)) << 12)"
    " ^ shiftleft(shiftright(anchor, 46) & 2047, 14)"
)


def _dealt(batch: pa.RecordBatch, distance: int, wanted=None) -> pa.RecordBatch:
    """Rows (anchor, fp); only anchors in the bitmap, if there is one."""
    prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
    row, anchor = anchors_of(prints, distance)
    if wanted is not None:
        own = in_bitmap(wanted.value, _short(anchor))
        row, anchor = row[own], anchor[own]
    return pa.record_batch(
        [pa.array(anchor.view(np.int64)), pa.array(prints[row].view(np.int64))], names=["anchor", "fp"]
    )


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _joining(rows: pa.Table, distance: int) -> pa.Table:
    """Links between components of the blocks in ``rows``: a spanning forest at most."""
    order = np.lexsort([rows[c].to_numpy() for c in ("j", "i", "anchor")])
    block = np.stack([rows[c].to_numpy()[order].astype(np.int64) for c in ("anchor", "i", "j")])
    prints, own, part = (rows[c].to_numpy()[order] for c in ("fp", "c", "part"))
    prints, root, made = prints.view(np.uint64), {}, []

    def top(c: int) -> int:
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    edges = np.flatnonzero((np.diff(block, axis=1) != 0).any(axis=0)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(order)], strict=True):
        crossing = block[1, a] != block[2, a]
        for x in range(a, b - 1):
            rest = slice(x + 1, b)
            near = (own[rest] != own[x]) & (np.bitwise_count(prints[rest] ^ prints[x]) <= distance)
            if crossing:
                near &= part[rest] != part[x]
            for other in np.unique(own[rest][near]).tolist():
                p, q = top(int(own[x])), top(other)
                if p != q:
                    root[p] = q
                    made.append((int(own[x]), other))
    src, dst = zip(*made, strict=True) if made else ((), ())
    return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})


def _crossing(open_rows: DataFrame, n_rows: int, distance: int) -> DataFrame:
    """Links (src, dst) between the components that meet at an anchor, from blocks of at most two parts of its members."""
    blocks = (
        open_rows.withColumn("part", F.expr("cast(pmod(xxhash64(fp), parts) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
        .withColumn("bin", F.expr(f"pmod(xxhash64(anchor, i, j), {parts_for(n_rows, BIN)})"))
    )
    rows = blocks.select("bin", "anchor", "i", "j", "part", "fp", "c")
    return rows.groupBy("bin").applyInArrow(lambda found: _joining(found, distance), "src long, dst long")


def linked_fingerprints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(id, component) of the distinct fingerprints ``fp`` that have links; component is one of its fingerprints."""
    deal = partial(_dealt, distance=distance)
    spread = prints.select("fp").repartition(parts_for(prints.count(), SPREAD), "fp")
    # rows go out in the order of their fingerprints, which packs them well; the counts follow the shuffle
    heads = stage(
        map_batches(spread, deal, "anchor long, fp long").repartition("anchor")
        .groupBy("anchor").agg(F.min("fp").alias("p"), F.max("fp").alias("q"), F.count(F.lit(1)).alias("n"))
        .where("p < q"),
        "simhash-heads",
    )
    ends = heads.where(_apart("p", "q") <= distance).select(F.col("p").alias("src"), F.col("q").alias("dst")).distinct()
    components = stage(connected_components(stage(ends, "simhash-ends")), "simhash-components")
    wanted = prints.sparkSession.sparkContext.broadcast(bitmap(heads.where("n > 2").select(F.expr(_SHORT).alias("at")), "at", BITS))
    own = stage(
        map_batches(spread, partial(deal, wanted=wanted), "anchor long, fp long")
        .join(components.withColumnRenamed("id", "fp"), "fp", "left")
        .select("anchor", "fp", F.coalesce("component", "fp").alias("c")),
        "simhash-own",
    )
    parts = F.expr(f"cast(ceil(count(1) / {BLOCK}D) as int)").alias("parts")
    still = own.groupBy("anchor").agg(parts, F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    open_rows, n_open = stage_counted(own.join(still.select("anchor", "parts"), "anchor"), "simhash-open")
    crossing = stage(_crossing(open_rows, n_open, distance), "simhash-crossing")
    higher = connected_components(crossing).select(F.col("id").alias("component"), F.col("component").alias("top"))
    old = components.join(higher, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    new = higher.join(components, higher["component"] == components["id"], "left_anti")
    made = stage(old.union(new.select(F.col("component").alias("id"), "top")), "simhash-linked")
    drop_stages(heads, components, own, open_rows, crossing)
    return made


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id per document."""
    prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = stage(map_batches(own, _fingerprints, "doc_id long, fp long"), "simhash-signed")
    classes = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    linked = linked_fingerprints(classes.select("fp"), distance)
    named = classes.join(linked.withColumnRenamed("id", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    named = stage(named, "simhash-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = named.join(least, "component").select("fp", "component_id")
    return signed.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
