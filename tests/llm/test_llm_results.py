"""Results against brute force, round trips, held-out labels and SQL on the smallest tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from check import TABLES, multiset
from waymark.llm import (
    decontaminate,
    langid,
    mixing,
    neardup,
    pieces,
    quality,
    queries,
    sharding,
    sketches,
    tokenfiles,
    warcfiles,
)

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return made


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(names, cur.fetchall())


def shingle_sets(rows):
    made = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        made[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    return made


def components(rows, percent=85):
    sets = shingle_sets(rows)
    least = {i: i for i in sets}

    def top(a):
        while least[a] != a:
            a = least[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = top(a), top(b)
                least[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_a_drifting_group(spark, monkeypatch, percent):
    """Chains of small edits: links reach from text to text, never all at once; blocks are split."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(3)
    rows, base = [], [f"w{rng.randint(0, 400)}" for _ in range(120)]
    for i in range(150):
        if i % 3 == 0:
            at = rng.randrange(len(base))
            base = [*base[:at], f"x{i}", *base[at + 1 :]]
        other = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6])):
            other[rng.randrange(len(other))] = f"y{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, percent).collect()}
    assert got == components(rows, percent)


def test_sketch_bound_holds_true_links():
    rng, shape = np.random.default_rng(5), neardup.shape_for(85)
    assert shape == (32, 6) and neardup.shape_for(80) == (38, 5)
    for _ in range(30):
        common = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        own = rng.integers(0, 1 << 63, (2, 79), dtype=np.uint64)
        a, b = (neardup.odd_sketch(neardup.samples(np.concatenate([common, o]), shape), shape).view(np.uint64) for o in own)
        assert np.bitwise_count(a ^ b).sum() <= neardup.most_differing_bits(85)


def test_winnowing_finds_planted_passages(spark):
    rng = random.Random(11)
    word = lambda: rng.choice(["the", "of", "lake", "ÉTÉ", "x1", "park", "a", "river"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 30])))) for i in range(25)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            source = items[rng.randrange(len(items))][1].split()
            at = rng.randint(0, len(text))
            text[at:at] = source[: rng.choice([len(source), 10, 9])]
        rows.append((i, "  ".join(text)))
    lower = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = lower(text)
        n = min(10, len(w))
        for j in range(len(w) - n + 1):
            windows[tuple(w[j : j + n])].add(str(item))
    want = {}
    for i, text in rows:
        w, hit, found = lower(text), set(), set()
        for n in range(1, 11):
            for j in range(len(w) - n + 1):
                ids = windows.get(tuple(w[j : j + n]))
                if ids:
                    hit |= set(range(j, j + n))
                    found |= ids
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def test_shards_keep_their_law(spark, docs, texts):
    rows = sharding.shard_table(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts
    )
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_shards_hold_groups_together_and_split_hot_ones(spark):
    data = [(i, "hot") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(200)] + [(5000 + i, f"own {i}") for i in range(400)]
    rows = sharding.shard_table(spark.createDataFrame(data, "doc_id long, text string")).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes.values()) <= {56, 57}
    of = {r.doc_id: r.shard for r in rows}
    together = sum(of[1000 + i] == of[1001 + i] for i in range(0, 200, 2))
    assert together >= 95
    assert max(Counter(of[i] for i in range(300)).values()) <= 57


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in langid.identify(docs).collect() if r.held_out]
    assert len(rows) > 150 and sum(r.lang_pred == known[r.doc_id] for r in rows) >= 0.98 * len(rows)


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.quality(docs, labels).collect() if r.held_out and known.get(r.doc_id) is not None]
    assert len(rows) > 80 and sum(r.predicted == known[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_sketches_of_edited_texts(docs, texts, monkeypatch):
    monkeypatch.setattr(sketches, "PART_BYTES", 50_000)
    rows = sorted(sketches.fingerprints(docs).collect(), key=lambda r: r.doc_id)
    sets = shingle_sets(texts)
    errors = []
    for i, (r, (doc_id, text)) in enumerate(zip(rows, texts, strict=True)):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest())
        own, other = sets[doc_id], shingle_sets([(0, changed)])[0]
        assert int(r.fingerprint.split(":")[0]) == len(own)
        if len(own) >= 100:
            errors.append(r.near_edited - len(own & other) / len(own))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.12


def test_token_files_equal_the_library(docs, texts, monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    monkeypatch.setattr(tokenfiles, "PART_BYTES", 50_000)
    rows = {r.doc_id: r for r in tokenfiles.token_table(docs, path).collect()}
    plain, at = pieces.encoder(path).tokenizer, 0
    for doc_id, text in texts:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_pieces_equal_the_library_on_odd_texts():
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encode, rng = pieces.encoder(path), random.Random(1)
    odd = ["", " ", "  a", "it's 'stuff ''s 's!'s x're y'll\n'd  'm\t'tx", "中文 🙂 a", "<|endoftext|> hi", "\n\n  \n x", "a  b c"]
    odd += ["".join(rng.choice("ab S'strevlm 12\n\t !?.é٣ ") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for text, ids in zip(odd, encode(odd), strict=True):
        assert list(ids) == encode.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_byte_letters_of_many_pieces_at_once():
    odd = ["", "a", " é", "\x00", "ÿ", "½ ok", "\n\n", "⹿", ""]
    letters = pieces._byte_letters()
    assert pieces.byte_letters(odd) == [x.encode().decode("latin-1").translate(letters) for x in odd]
    assert [pieces._beyond(x) for x in ("a", "⹿", "⺀", "a🙂")] == [False, False, True, True]


def test_archives_give_every_page_back(spark, con):
    rows = con.execute("select page_id, url, html from pages order by page_id").fetchall()
    rows += [(100000 + i, "http://again", rows[i % 7][2]) for i in range(40)]
    found = {r.page_id: r for r in warcfiles.archive_table(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    first = {}
    for page_id, _, html in rows:
        first.setdefault(html, page_id)
    assert len(found) == len(rows)
    for page_id, _, html in rows:
        r, body = found[page_id], html.encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if first[html] == page_id else ("revisit", first[html]))


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.taken_words(docs).collect()
    by = defaultdict(list)
    for r in rows:
        by[(r.source_size, r.target)].append(r.taken)
    total = sum(r["size"] for r in rows)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-3 * total
    assert abs(sum(r.taken for r in rows) - 1.5 * total) < 0.08 * total
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.taken_words(docs.repartition(5)).collect()), key=str)


def test_pipeline_against_plain_versions(spark, con, tmp_path):
    """Every stage on what its predecessor kept."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    plain = con.execute("select doc_id, text from documents").fetchall()
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows, SF).write.parquet(f"{tmp_path}/{i}")
        rows = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = [(r.doc_id, r.text) for r in rows.collect()]
    told = [(i, t) for i, t in plain if any(c.isalpha() for c in t or "")]
    assert len(kept["language_id"]) >= 0.99 * len(told) and set(kept["language_id"]) <= set(told)
    one = components(kept["language_id"], corpus_pipeline.NEAR_PERCENT)
    assert sorted(i for i, _ in kept["minhash_neardup"]) == sorted(i for i, c in one.items() if i == c)
    marked = decontaminate.contamination(
        spark.createDataFrame(kept["minhash_neardup"], "doc_id long, text string"), spark.read.parquet(f"{SF}/benchmark.parquet")
    )
    dirty = {r.doc_id for r in marked.where("contaminated").collect()}
    assert dirty and sorted(i for i, _ in kept["benchmark_decontamination"]) == sorted(
        i for i, _ in kept["minhash_neardup"] if i not in dirty
    )
    clean = spark.read.parquet(f"{tmp_path}/2")
    times = Counter()
    for r in mixing.taken_words(clean).collect():
        times[r.doc_id] += r.taken // r["size"] if r["size"] else 0
    assert Counter(i for i, _ in kept["source_mixing"]) == +times
    assert Counter(kept["label_propagation_sharding"]) == Counter(kept["source_mixing"])
    shards = Counter(r.shard for r in rows.collect())
    assert max(shards.values()) - min(shards[s] for s in range(16)) <= 1
