"""Tokens of two tokenizers aligned by their byte ends, each distinct text once.

Side A is a byte-level BPE file of the tokenizers library over a space and the text, side B a sentencepiece model over
the text, which adds the space itself. The bytes of a token are the byte-level decoding of an A entry, and a B piece in
UTF-8 with U+2581 as a space and ``<0xHH>`` as that byte. Offsets at which tokens of both sides end cut them into groups;
the tokens that end there together are linked.

1. Exact-text deduplication: documents are shuffled by their full text into distinct texts with their multiplicity; the
   aggregation combines copies before the shuffle.
2. Each distinct text is tokenised and aligned once. Its measures and its distinct linked id pairs with
   their occurrences are written to a stage table.
3. The count of an id pair is the sum of occurrences times multiplicity; an aggregation finds the highest per B id.
4. The counts go back to the texts as sorted arrays in blocks of PAIRS pairs: a block has a bounded size, and there are
   as many blocks as the pairs need. No pair is left out, and nothing is shuffled per pair and text.
5. The measures join the documents by the SHA-256 of the text.

Cases: null and empty texts, and texts whose joined A or B bytes differ from a space and the text (U+2581 in it, say),
have no tokens: zeros and an empty ``groups_sha256``. Rows without a doc_id and repeated rows are described each, and
their texts count with their multiplicity; of B ids with several highest pairs all of these are best; strings of special
tokens are plain text; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.pieces import Encoder, _byte_letters
from waymark.llm.support import map_batches, pick, prepare
from waymark.runtime import drop_stages, stage

#: characters of text aligned at once, one text at least
CHUNK = 1 << 18
#: pairs of a block of counts, and bits of a B id in a packed pair
PAIRS, SHIFT = 1 << 21, 20
MEASURES = "text_sha string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = f"{MEASURES}, copies long, pairs array<long>, times array<int>"


class Vocabulary:
    """Bytes of every id of one side, and its decimal names followed by a comma or by the end of its list."""

    def __init__(self, token_bytes: list[bytes], end: bytes):
        self.sizes = np.array([len(b) for b in token_bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(token_bytes), np.uint8)
        numbers = [b"%d" % i for i in range(len(token_bytes))]
        self.names = [x + b"," for x in numbers] + [x + end for x in numbers]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens one after the other."""
        size = self.sizes[ids]
        first = np.cumsum(size) - size
        return self.data[np.repeat(self.starts[ids] - first, size) + np.arange(int(size.sum()))]


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.encode_a = Encoder(path_a, plain=True)
        tokenizer = self.encode_a.tokenizer
        byte_of = {chr(letter): b for b, letter in _byte_letters().items()}
        entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.a = Vocabulary([bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries], b"|")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.b = Vocabulary(
            [
                bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ],
            b";",
        )

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]

    def __call__(self, texts: list[str]) -> list[tuple]:
        """Per text: (n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)."""
        spaced = [" " + t for t in texts]
        sides = zip(spaced, self.encode_a(spaced), self.encode_b(texts), strict=True)
        return [self.align(text.encode(), ids_a.astype(np.int64), ids_b) for text, ids_a, ids_b in sides]

    def align(self, want: bytes, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple:
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        if any(side.joined(ids).tobytes() != want for side, ids in ((self.a, ids_a), (self.b, ids_b))):
            return 0, 0, 0, 0, "", [], []
        ends = np.zeros(len(want) + 1, np.uint8)
        ends[ends_a] = 1
        ends[ends_b] |= 2
        common = np.flatnonzero(ends == 3)
        # tokens of zero bytes would share an end; searching from both sides counts them all
        upto_a, upto_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
        at_a, at_b = upto_a - np.searchsorted(ends_a, common), upto_b - np.searchsorted(ends_b, common)
        if (at_a == 1).all() and (at_b == 1).all():
            linked = (ids_a[upto_a - 1] << SHIFT) | ids_b[upto_b - 1]
        else:
            rows = zip(upto_a.tolist(), upto_b.tolist(), at_a.tolist(), at_b.tolist(), strict=True)
            linked = np.array(
                [(a << SHIFT) | b for i, j, x, y in rows for a in ids_a[i - x : i].tolist() for b in ids_b[j - y : j].tolist()],
                np.int64,
            )
        pairs, times = np.unique(linked, return_counts=True)
        digest = hashlib.sha256(self.named(ids_a, ids_b, upto_a, upto_b)).hexdigest()
        return len(ids_a), len(ids_b), len(common), len(linked), digest, pairs, times

    def named(self, ids_a: np.ndarray, ids_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of the groups that end after so many tokens of each side."""
        size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        name_a, name_b = ids_a.copy(), ids_b + len(self.a.names)
        name_a[upto_a - 1] += len(self.a.sizes)
        name_b[upto_b - 1] += len(self.b.sizes)
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + np.repeat(upto_b - size_b, size_a)] = name_a
        order[np.arange(len(ids_b)) + np.repeat(upto_a, size_b)] = name_b
        names = self.names
        return b"".join([names[i] for i in order.tolist()])[:-1]

    @property
    def names(self) -> list[bytes]:
        if not hasattr(self, "_names"):
            self._names = self.a.names + self.b.names
        return self._names


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker; its memory of pieces lasts over tasks."""
    return Aligner(path_a, path_b)


def aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Measures and linked pairs of each distinct text of ``texts`` (text, copies)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        align = aligner(path_a, path_b)
        rows, made, group, size = batch.column("text").to_pylist(), [], [], 0
        for text in rows:
            group.append(text)
            size += len(text)
            if size >= CHUNK:
                made += align(group)
                group, size = [], 0
        made += align(group)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in rows]
        n_a, n_b, n_groups, n_links, digest, pairs, times = (list(c) for c in zip(*made, strict=True))
        columns = [
            pa.array(sha), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
            batch.column("copies"), pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32())),
        ]
        names = "text_sha n_a n_b n_groups n_links groups_sha256 copies pairs times".split()
        return pa.record_batch(columns, names=names)

    return map_batches(texts, run, ALIGNED)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n and best of each linked id pair: links that hold it corpus-wide, 1 where its B id has no higher."""
    each = found.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = each.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("link.times") * F.col("copies")).alias("n"))
    counts = stage(counts.withColumn("b", F.expr(f"pair & {(1 << SHIFT) - 1}L")), "aligned-pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return stage(counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best")), "aligned-counts")


def _block(counts: DataFrame, blocks: int, i: int) -> tuple[np.ndarray, ...]:
    """A block of the counts as arrays in the order of pairs."""
    block = counts.where(F.expr(f"pmod(xxhash64(pair), {blocks}) = {i}")).toArrow()
    pair, n, best = (block[c].to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return pair[order], n[order], best[order].astype(np.int8)


def weighed(found: DataFrame, counts: DataFrame) -> DataFrame:
    """text_sha, n_best and count_sum of each text, block of counts by block."""
    spark = found.sparkSession
    blocks = max(1, -(-counts.count() // PAIRS))
    made = None
    for i in range(blocks):
        table = spark.sparkContext.broadcast(_block(counts, blocks, i))

        def run(batch: pa.RecordBatch, table=table) -> pa.RecordBatch:
            pair, n, best = table.value
            pairs, lists = batch.column("pairs").flatten().to_numpy(), batch.column("pairs")
            times = batch.column("times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
            known = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            row, at, times = row[known], at[known], times[known]
            sums = [np.zeros(len(lists), np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * best[at])
            np.add.at(sums[1], row, times * n[at])
            return pa.record_batch(
                [batch.column("text_sha"), pa.array(sums[0]), pa.array(sums[1])], names=["text_sha", "n_best", "count_sum"]
            )

        part = map_batches(found.select("text_sha", "pairs", "times"), run, "text_sha string, n_best long, count_sum long")
        made = part if made is None else made.union(part)
    return made.groupBy("text_sha").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment measures per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    prepare(docs.sparkSession)
    own = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = own.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    found = stage(aligned(texts, path_a, path_b), "aligned-texts")
    counts = pair_counts(found)
    measures = stage(
        found.drop("pairs", "times", "copies").join(weighed(found, counts), "text_sha"), "aligned-measures"
    )
    drop_stages(found, counts)
    named = own.where("text <> ''").select("doc_id", F.sha2("text", 256).alias("text_sha")).join(measures, "text_sha")
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    empty = own.where("text is null or text = ''").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in columns], F.lit("").alias("groups_sha256")
    )
    return named.select("doc_id", *columns, "groups_sha256").union(empty)
