"""Anchor points, collocations and alignments against brute force, with odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm import alignment, anchors, collocations, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two three"), (6, "ONE two\tthree"), (6, "One two three"), (None, "one two three"),
    (None, None), (7, "same words again. " * 4000), (8, "x" * 90_000), (9, "ﬁ ▁ <|endoftext|> <s>   \x00"), (10, "<|endoftext|> ends, <0x41> here"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def table(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, fp string, component int, anchor string")
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most=4):
    """Least id reachable from each row of (id, fingerprint); None only where no row has an id."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= most:
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [least.get(top(i)) for i in range(len(prints))]


def test_every_value_is_near_its_home_and_perfect_codes_cover_once():
    for length, generator, radius in anchors.CODES:
        leader, _ = anchors.tables(length, generator, radius, 2)
        weights = [int(x).bit_count() for x in leader]
        assert max(weights) == radius and len(set(leader.tolist())) == len(leader)
    assert sum(c[0] for c in anchors.CODES) == 64


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_linked_fingerprints_share_an_anchor(distance):
    draw = random.Random(distance)
    for _ in range(150):
        x = draw.getrandbits(64)
        y = x
        for b in draw.sample(range(64), draw.randint(1, distance)):
            y ^= 1 << b
        row, anchor = anchors.anchors_of(np.array([x, y], np.uint64), distance)
        assert set(anchor[row == 0].tolist()) & set(anchor[row == 1].tolist())
        assert len(set(anchor[row == 0].tolist())) == (row == 0).sum()
        # no anchor lies beyond the covering radius and the threshold
        assert max((int(a) ^ x).bit_count() for a in anchor[row == 0]) <= 8 + distance


@pytest.mark.parametrize("spread, count", [(6, 300), (14, 400), (64, 200)])
def test_linked_fingerprints_against_all_pairs(spark, spread, count):
    """Dense neighbourhoods with many members at an anchor, and random values."""
    draw = random.Random(spread)
    base = draw.getrandbits(64)
    bits = draw.sample(range(64), spread)
    prints = {0}
    while len(prints) < min(count, 2 ** (spread - 1)):
        x = base if spread < 64 else draw.getrandbits(64)
        for b in draw.sample(bits, draw.randint(0, min(spread, 9))):
            x ^= 1 << b
        prints.add(x)
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    got = {r.id: r.component for r in anchors.linked_fingerprints(frame).collect()}
    named = [(i, p) for i, p in enumerate(prints)]
    want = plain_components(named)
    groups = {}
    for (_, p), c in zip(named, want, strict=True):
        groups.setdefault(c, set()).add(int(np.uint64(p).view(np.int64)))
    found = {}
    for p in prints:
        s = int(np.uint64(p).view(np.int64))
        found.setdefault(got.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_simhash_against_plain_version(spark, texts):
    rows = texts + ODD + [(1000 + i, t + " one more end") for i, t in texts[:60] if t]
    got = anchors.near_duplicates(table(spark, rows, extra=True)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([(i, p) for (i, _), p in zip(rows, prints, strict=True)])
    expected = Counter((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, want, strict=True))
    assert Counter(map(tuple, got)) == expected


def test_simhash_of_empty_table_and_rows_without_id(spark):
    assert anchors.near_duplicates(table(spark, [])).count() == 0
    rows = anchors.near_duplicates(table(spark, [(None, "a b c d e"), (None, "a b c d e")])).collect()
    assert [r.component_id for r in rows] == [None, None]


def plain_collocations(rows, least, top=2000):
    f = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    made = []
    for lang, own in f.items():
        n = sum(v for p, v in own.items() if len(p) == 1)
        scored = {}
        for p, a in own.items():
            if len(p) > 1 and a >= least:
                cuts = [(1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                s, k = min(cuts)
                scored[p] = (-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]])
        for p, a in own.items():
            if len(p) == 3 and p in scored:
                for q in (p[:2], p[1:]):
                    if q in scored and 100 * a >= 50 * own[q]:
                        scored[q] = None
        kept = sorted(v for v in scored.values() if v)[:top]
        made += [(lang, i + 1, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(kept)]
    return Counter(made)


def phrase_rows():
    draw = random.Random(3)
    words = ["La", "la", "del", "été", "|", "a\x00b", "word", "Zed", "über", "10%", "x", "y"]
    rows = [(None, None), ("en", ""), ("en", " .;!"), ("", "x y. x y")]
    rows += [(draw.choice(["en", "de", None]), " ".join(draw.choice(words) + draw.choice(["", "", "", ".", ",\r", "\t"]) for _ in range(draw.randint(1, 60)))) for _ in range(300)]
    return [*rows, ("en", "hot pair " * 3000), ("de", "nospace" * 20000), rows[-1], rows[-1]]


@pytest.mark.parametrize("tiny", [False, True])
def test_collocations_against_plain_version(spark, monkeypatch, tiny):
    if tiny:  # containers burst, subtrees spill and word ids begin anew within the small input
        for name, value in {"BURST": 4, "ENTRIES": 40, "VOCABULARY": 9, "STRETCH": 7, "CHUNK": 50, "ROWS": 5}.items():
            monkeypatch.setattr(collocations, name, value)
        rows = phrase_rows()[:60]
        monkeypatch.setattr(collocations.DataFrame, "mapInArrow", in_process(spark), raising=True)
    else:
        rows = phrase_rows()
    data = spark.createDataFrame([(i, x, t, "s") for i, (x, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string")
    got = Counter(tuple(r) for r in collocations.collocations(data, least=4).collect())
    assert got == plain_collocations(rows, 4)


def in_process(spark):
    """mapInArrow run here, so that the tiny limits hold in it."""

    def run(self, fn, schema):
        import pyarrow as pa

        found = list(fn(iter(self.toArrow().to_batches(max_chunksize=16))))
        rows = pa.Table.from_batches(found).to_pylist() if found else []
        assert any(len(b) for b in found)
        return spark.createDataFrame([tuple(r.values()) for r in rows], schema)

    return run


def test_collocations_of_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_runs_of_phrases_hold_word_keys(spark):
    texts = spark.createDataFrame([("en", "a b a b"), ("de", "a b")], "lang string, text string")
    keyed, salt = collocations.keyed_words(collocations.counted(texts, 1))
    key = {(r.lang, r.word): r.key for r in keyed.collect()}
    table = spark.sparkContext.broadcast(np.full(2, 2**64 - 1, np.uint64))
    for salt in (salt, salt + 1):
        pairs = collocations.counted(texts, 2, table, salt)
        assert pairs.dtypes == [("w0", "bigint"), ("w1", "bigint"), ("n", "bigint")]
        if salt:
            word = collocations.word_key(F.col("lang"), F.col("word"), salt)
            key = {(r.lang, r.word): r.key for r in keyed.withColumn("key", word).collect()}
        en, de = [[key[lang, w] for w in "ab"] for lang in ("en", "de")]
        assert {tuple(r) for r in pairs.collect()} == {(*en, 2), (en[1], en[0], 1), (*de, 1)}


def test_words_that_share_a_key_get_another_salt(spark, monkeypatch):
    true_key = collocations.word_key
    monkeypatch.setattr(
        collocations, "word_key", lambda lang, word, salt: true_key(lang, word, salt) if salt > 1 else F.length(word).cast("long")
    )
    words = spark.createDataFrame([("en", "a"), ("en", "b"), ("de", "a")], "lang string, word string")
    keyed, salt = collocations.keyed_words(words)
    assert salt == 2 and len({r.key for r in keyed.collect()}) == 3


def test_trie_bursts_spills_and_keeps_counts(monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 8)
    draw = np.random.default_rng(5)
    trie, want, got = collocations.Trie(63), Counter(), Counter()
    for _ in range(40):
        parts = draw.integers(1, 12, (50, 3))
        parts[:, 0] <<= 14
        paths = (parts[:, 0] << 42) | (parts[:, 1] << 21) | parts[:, 2]
        want.update(paths.tolist())
        trie.add(np.sort(paths))
        assert trie.size == len(trie.sorted()[0])
        if trie.size > 300:
            run, counts = trie.spill(100)
            assert (np.diff(run) > 0).all() and trie.size <= 100
            # whole subtrees leave: no range of first words is on both sides
            top = 63 - collocations.FAN
            assert not set((run >> top).tolist()) & set((trie.sorted()[0] >> top).tolist())
            got.update(dict(zip(run.tolist(), counts.tolist(), strict=True)))
    got.update(dict(zip(*(c.tolist() for c in trie.spill(0)), strict=True)))
    assert got == want and trie.size == 0


def test_scores_beyond_64_bits_are_exact(spark):
    a = 10**13 + 7
    counts = spark.createDataFrame(
        [("en", ["x", "y"], "x y", a), ("en", ["x"], "x", a + 3), ("en", ["y"], "y", 3 * a + 1)],
        "lang string, words array<string>, phrase string, f long",
    )
    row = collocations.scored(counts).collect()[0]
    assert row.score == 1000000 * a * a // ((a + 3) * (3 * a + 1))


def plain_alignment(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in prints} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in prints)}

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def ends(parts):
        at, made = 0, []
        for p in parts:
            at += len(p)
            made.append(at)
        return made

    seen, counts = [], Counter()
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes_b(i) for i in ids_b]
        want = (" " + text).encode() if text else b""
        if b"".join(parts_a) != want or b"".join(parts_b) != want:
            ids_a, ids_b, parts_a, parts_b = [], [], [], []
        ea, eb = ends(parts_a), ends(parts_b)
        common = sorted(set(ea) & set(eb))
        at_a, at_b = dict(zip(ea, ids_a, strict=True)), dict(zip(eb, ids_b, strict=True))
        links = [(at_a[e], at_b[e]) for e in common]
        counts.update(links)
        groups, before = [], 0
        for e in common:
            groups.append("|".join(",".join(str(i) for x, i in zip(es, ids, strict=True) if before < x <= e) for es, ids in ((ea, ids_a), (eb, ids_b))))
            before = e
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
        seen.append((key, len(ids_a), len(ids_b), len(common), links, digest))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    return Counter(
        (k, na, nb, ng, len(ls), sum(counts[p] == top[p[1]] for p in ls), sum(counts[p] for p in ls), d)
        for k, na, nb, ng, ls, d in seen
    )


@pytest.mark.parametrize("pairs", [alignment.PAIRS, 300])
def test_alignment_against_plain_version(spark, texts, monkeypatch, pairs):
    monkeypatch.setattr(alignment, "PAIRS", pairs)  # one block of counts, and many
    rows = [(i, t) for i, t in texts[:70] if t and len(t) < 4000] + ODD[:9] + ODD[10:] + ODD[4:6] + [(70, "a, b; c. " * 900)]
    rows += [(80 + i, "naïve ﬁ 日本 \U0001f600 " + "ab" * i) for i in range(4)]
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    got = Counter(tuple(r) for r in alignment.alignment(table(spark, rows, extra=True), *paths).collect())
    assert got == plain_alignment(rows)
    if pairs != 300:
        assert alignment.alignment(table(spark, []), *paths).count() == 0


def test_registered():
    assert {"op11_simhash_anchors", "op12_phrase_collocations", "op13_tokenizer_alignment"} <= set(queries.QUERIES)
