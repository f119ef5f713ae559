"""Phrase collocations counted by HAT-tries, one level of phrase length after the other.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. All counts
are per lang (null: ``und``) over whole texts.

A phrase of k words occurs often enough only if both its parts of k - 1 words do. So level 1 counts all words, and level
k counts the phrases whose two parts of k - 1 words passed level k - 1: a bitmap of fixed size over hashes of the passed
phrases tells which places to count. A false pass only costs work, none is lost, so the counts are exact.

Each task counts in a HAT-trie: a hash container of packed word-id paths that bursts at BURST entries into containers
for ranges of first words, then single words, then ranges of the next, and so on down. When a task's tries hold ENTRIES paths, whole subtrees are spilled, largest first,
as runs sorted by path, until half of the largest trie is left; all is spilled and word ids begin anew when there are
VOCABULARY of them. Runs of level 1 are rows (lang, word, n). Runs of the other levels hold a 64-bit key for each word instead
of its text, as most of their rows are phrases that do not occur often enough. Spark merges them per prefix partition (two words at
most) and adds up, a prefix being spread over SALTS partitions by what follows it. Words come back by joins with level 1 once rare
phrases are gone. Keys are exact: all words of level 1 are compared, and another salt is taken until no two share a key.

A candidate has a count of at least ``least``. Of its cuts into two parts with counts l and r, the one with the lowest
score floor(1000000 * a * a / (l * r)) counts, the shortest first part on ties; the arithmetic is on decimals. A candidate
inside a longer one with at least half of its count is dropped.

Cases: null and empty texts have no words; documents without an id count like any other; repeated rows count each; a lang
without candidates gives no row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.support import LOWER_FROM, LOWER_TO, bitmap, in_bitmap, pick, prepare
from waymark.runtime import stage

LEAST, WORDS, TOP = 10, 3, 2000
#: per cent of a candidate's count from which a longer one around it takes its place
INSIDE = 50
SCALE = 1_000_000
#: entries of a container that bursts, of a task's tries before they spill, and word ids of a task
BURST, ENTRIES, VOCABULARY = 1 << 12, 600_000, 1 << 20
#: characters of a lang's text and tokens counted at once, and characters of all langs that wait for it
CHUNK, STRETCH, WAITING = 1 << 20, 1 << 17, 1 << 22
#: bits of a packed word id, rows of an output batch, bits of the bitmap of passed phrases, partitions of a prefix
ID_BITS, ROWS, BITS, SALTS = 21, 8192, 1 << 25, 32
#: follows a lang as often as the salt of its keys says
SALT = "\0"
#: bits of a path by which a container bursts
FAN = 7
#: fixed values: every byte as it counts; pieces end at a line feed
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_PLAIN = bytes.maketrans(
    LOWER_FROM.encode() + _BREAKS + _BLANKS, LOWER_TO.encode() + b"\n" * len(_BREAKS) + b" " * len(_BLANKS)
)
#: a token that no word equals, as it is a piece end itself
_END = b"."


class Trie:
    """Counts of packed paths of word ids: a hash container that bursts into FAN containers by the next bits of the path.

    Like the hybrid containers of a HAT-trie, a container holds the paths of a range of words until it is crowded; then it
    is parted by finer ranges, so that a frequent word ends with containers of its own, and they with its next words.
    """

    __slots__ = ("children", "held", "shift", "size")

    def __init__(self, bits: int):
        self.shift, self.held, self.children, self.size = bits - FAN, Counter(), None, 0

    def add(self, paths: np.ndarray, counts: np.ndarray | None = None) -> int:
        """Count sorted paths, each once or as often as told; the number of new entries."""
        before = self.size
        if self.children is None:
            self.held.update(paths.tolist() if counts is None else dict(zip(paths.tolist(), counts.tolist(), strict=True)))
            self.size = len(self.held)
            if self.size <= BURST or self.shift < 0:
                return self.size - before
            paths, counts = self.sorted()
            self.held, self.children, self.size = Counter(), {}, 0
        digit = (paths >> self.shift) & ((1 << FAN) - 1)
        edges = np.flatnonzero(np.diff(digit, prepend=-1, append=-1)).tolist()
        for a, b, key in zip(edges, edges[1:], digit[edges[:-1]].tolist()):
            child = self.children.get(key)
            if child is None:
                child = self.children[key] = Trie(self.shift)
            self.size += child.add(paths[a:b], None if counts is None else counts[a:b])
        return self.size - before

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """(paths, counts) of the whole subtree, by path."""
        if self.children is not None:
            parts = [child.sorted() for _, child in sorted(self.children.items())]
            return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        paths = np.fromiter(self.held.keys(), np.int64, len(self.held))
        counts = np.fromiter(self.held.values(), np.int64, len(self.held))
        order = np.argsort(paths)
        return paths[order], counts[order]

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out whole subtrees, largest first, until at most ``keep`` entries are left: one run by path."""
        taken = Trie(self.shift + FAN)
        if self.children is None or not keep:
            taken.held, taken.children = self.held, self.children
            self.held, self.children, self.size = Counter(), None, 0
            return taken.sorted()
        taken.children = {}
        for _, key in sorted(((c.size, k) for k, c in self.children.items()), reverse=True):
            if self.size <= keep:
                break
            taken.children[key] = self.children.pop(key)
            self.size -= taken.children[key].size
        return taken.sorted()


class Book:
    """Word ids of one lang, the keys of its words, and its trie."""

    def __init__(self, lang: str, depth: int, passed: np.ndarray | None, salt: int):
        self.lang, self.depth, self.passed = lang, depth, passed
        self.seed = xxhash.xxh64_intdigest((lang + SALT * salt).encode(), 42)
        self.trie = Trie(ID_BITS * depth)
        self.ids, self.words = {_END: 0}, [_END]
        self.hashes = np.zeros(1 << 12, np.uint64)

    def _numbers(self, tokens: pa.Array) -> np.ndarray:
        ids, words = self.ids, self.words
        known, coded = len(words), tokens.dictionary_encode()
        found = coded.dictionary.to_pylist()
        for token in found:
            if token not in ids:
                ids[token] = len(words)
                words.append(token)
        if self.depth > 1:
            while len(words) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            fresh = words[known:]
            self.hashes[known : len(words)] = np.fromiter(
                (xxhash.xxh64_intdigest(w, self.seed) for w in fresh), np.uint64, len(fresh)
            )
        return np.fromiter(map(ids.__getitem__, found), np.int64, len(found))[coded.indices.to_numpy()]

    def count(self, tokens: pa.Array) -> None:
        """Count the phrases of ``depth`` tokens that hold no piece end and whose parts passed."""
        at, depth = self._numbers(tokens), self.depth
        inside = at > 0
        if depth > 1:
            keys = phrase_keys(self.hashes[at], depth - 1)
            good = in_bitmap(self.passed, keys)
            for j in range(depth - 1):
                good &= inside[j : j + len(keys)]
            inside = good[:-1] & good[1:]
        path = at[: len(inside)].copy()
        for j in range(1, depth):
            path = (path << ID_BITS) | at[j : j + len(inside)]
        self.trie.add(np.sort(path[inside]))

    def runs(self, keep: int = 0) -> Iterator[pa.RecordBatch]:
        """Spilled subtrees as rows in the order of the trie."""
        paths, counts = self.trie.spill(keep)
        names = pa.array(self.words, pa.string()) if self.depth == 1 else self.hashes.view(np.int64)
        for a in range(0, len(paths), ROWS):
            some, n = paths[a : a + ROWS], pa.array(counts[a : a + ROWS])
            if self.depth == 1:
                columns = [pa.array([self.lang] * len(some)), names.take(pa.array(some)), n]
            else:
                word = [(some >> (ID_BITS * (self.depth - 1 - j))) & ((1 << ID_BITS) - 1) for j in range(self.depth)]
                columns = [*[pa.array(names[at]) for at in word], n]
            yield pa.record_batch(columns, names=run_columns(self.depth))


def run_columns(depth: int) -> list[str]:
    return ["lang", "word", "n"] if depth == 1 else [*[f"w{j}" for j in range(depth)], "n"]


def tokens_of(texts: list[str], depth: int) -> Iterator[pa.Array]:
    """Words and piece ends of the texts in stretches; each holds the last ``depth - 1`` tokens of the one before."""
    plain = "\n".join(texts).encode().translate(_PLAIN).replace(b"\n", b" . ")
    tokens = pc.split_pattern(pa.array([plain], pa.large_binary()), b" ").flatten()
    tokens = tokens.filter(pc.not_equal(tokens, b""))
    for a in range(0, len(tokens) - depth + 1, STRETCH):
        yield tokens[a : a + STRETCH + depth - 1]


def phrase_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """Key of each run of k words from the hashes of its words; ``phrase_key`` is the same in Spark."""
    n = max(0, len(hashes) - k + 1)
    key = hashes[:n].copy()
    for j in range(1, k):
        key = ((key << np.uint64(23)) | (key >> np.uint64(41))) ^ hashes[j : j + n]
    return key


def phrase_key(words: list[Column]) -> Column:
    key = words[0]
    for word in words[1:]:
        key = F.shiftleft(key, 23).bitwiseOR(F.shiftrightunsigned(key, 41)).bitwiseXOR(word)
    return key


def word_key(lang: Column, word: Column, salt: int) -> Column:
    """Key of a word of a lang, as ``Book`` makes it."""
    return F.xxhash64(F.concat(lang, F.lit(SALT * salt)), word)


def keyed_words(words: DataFrame) -> tuple[DataFrame, int]:
    """(words with their ``key``, salt): the first salt by which no two words of ``words`` (lang, word) share a key."""
    salt = 0
    while True:
        keyed = words.withColumn("key", word_key(F.col("lang"), F.col("word"), salt))
        if keyed.groupBy("key").agg(F.count(F.lit(1)).alias("words")).where("words > 1").isEmpty():
            return keyed, salt
        salt += 1


def counted(texts: DataFrame, depth: int, passed=None, salt: int = 0) -> DataFrame:
    """Merged counts of the phrases of ``depth`` words whose parts passed: lang, word, n or w0, w1 and so on, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[str, Book] = {}
        waiting, sizes = {}, Counter()
        table = passed.value if passed is not None else None

        def read(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            for tokens in tokens_of(waiting.pop(lang), depth):
                if lang not in books:
                    books[lang] = Book(lang, depth, table, salt)
                books[lang].count(tokens)
                while sum(b.trie.size for b in books.values()) > ENTRIES:
                    largest = max(books.values(), key=lambda b: b.trie.size)
                    yield from largest.runs(largest.trie.size // 2)
                if sum(len(b.words) for b in books.values()) > VOCABULARY:
                    for book in books.values():
                        yield from book.runs()
                    books.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] += len(text)
                if sizes[lang] >= CHUNK:
                    yield from read(lang)
            while sizes.total() > WAITING:
                yield from read(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from read(lang)
        for book in books.values():
            yield from book.runs()

    *words, n = run_columns(depth)
    kind = "string" if depth == 1 else "long"
    rows = texts.mapInArrow(run, ", ".join([*[f"{c} {kind}" for c in words], f"{n} long"]))
    if depth > 2:
        rows = rows.withColumn("salt", F.expr(f"pmod(xxhash64({', '.join(words[2:])}), {SALTS})"))
        return rows.repartition(*words[:2], "salt").groupBy(*words, "salt").agg(F.sum(n).alias(n)).drop("salt")
    return rows.repartition(*words).groupBy(*words).agg(F.sum(n).alias(n))


def phrase_counts(texts: DataFrame, least: int = LEAST, most_words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(words per lang, counts): ``lang, n``, and ``lang, words, phrase, f`` of all phrases with a count of ``least``."""
    spark = texts.sparkSession
    words = stage(counted(texts, 1), "phrases-words")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    keyed, salt = keyed_words(words)
    names = stage(keyed.where(F.col("n") >= least), "phrases-1")
    counts = names.select("lang", F.array("word").alias("words"), F.col("word").alias("phrase"), F.col("n").alias("f"))
    passed, key = names, F.col("key")
    for depth in range(2, most_words + 1):
        table = spark.sparkContext.broadcast(bitmap(passed.select(key.alias("key")), "key", BITS))
        passed = stage(counted(texts, depth, table, salt).where(F.col("n") >= least), f"phrases-keys-{depth}")
        parts = run_columns(depth)[:-1]
        key = phrase_key([F.col(c) for c in parts])
        level = passed
        for j, part in enumerate(parts):
            named = names.select(F.col("key").alias(part), F.col("word").alias(f"t{j}"), *(["lang"] if j == 0 else []))
            level = level.join(named, part)
        text = [F.col(f"t{j}") for j in range(depth)]
        level = level.select("lang", F.array(*text).alias("words"), F.concat_ws(" ", *text).alias("phrase"), F.col("n").alias("f"))
        counts = counts.union(stage(level, f"phrases-{depth}"))
    return total, counts


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of each candidate by its lowest cut."""
    part = lambda side: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f"f_{side}"))
    cuts = (
        counts.where(F.size("words") >= 2)
        .withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
        .select(
            "lang", "phrase", "words", F.col("f").alias("a"), "k",
            F.expr("array_join(slice(words, 1, k), ' ')").alias("head"),
            F.expr("array_join(slice(words, k + 1, size(words)), ' ')").alias("tail"),
        )
        .join(part("head"), ["lang", "head"]).join(part("tail"), ["lang", "tail"])
    )
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "f_head", "f_tail")}
    top = (F.lit(SCALE).cast("decimal(7,0)") * (wide["a"] * wide["a"]).cast("decimal(30,0)")).cast("decimal(38,0)")
    cuts = cuts.withColumn("top", top).withColumn("low", (wide["f_head"] * wide["f_tail"]).cast("decimal(38,0)"))
    best = F.min(F.struct(F.expr("top div low").alias("score"), "k", "f_head", "f_tail")).alias("best")
    return cuts.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.first("a").alias("a"), best).select(
        "lang", "phrase", "words", "a", F.col("best.f_head").alias("l"), F.col("best.f_tail").alias("r"), "best.score"
    )


def without_inner(candidates: DataFrame, inside: int = INSIDE) -> DataFrame:
    """Candidates but for those inside a longer one with at least ``inside`` per cent of their count."""
    inner = F.expr(
        "explode(flatten(transform(sequence(2, size(words) - 1),"
        " k -> transform(sequence(1, size(words) - k + 1), i -> array_join(slice(words, i, k), ' ')))))"
    )
    longer = candidates.where(F.size("words") > 2).select("lang", "a", inner.alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = candidates.join(around, ["lang", "phrase"], "left")
    return kept.where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * inside)).drop("around")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE, most_words: int = WORDS
) -> DataFrame:
    """The first ``top`` phrases of each lang by score: lang, rank, phrase, a, l, r, n, score."""
    prepare(docs.sparkSession)
    texts = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text <> ''")
    total, counts = phrase_counts(texts, least, most_words)
    candidates = stage(scored(counts), "phrases-scored")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = without_inner(candidates, inside).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
