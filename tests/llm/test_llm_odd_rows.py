"""Every operator and stage on odd rows: nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm import (
    decontaminate,
    langid,
    licences,
    mixing,
    neardup,
    quality,
    sharding,
    sketches,
    tokenfiles,
    warcfiles,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997} ipsum{i}" for i in range(30000))
ROWS = [
    (0, None, "en", "a", 0),
    (1, "", "en", None, 0),
    (2, " \n\t ", None, "a", 4),
    (3, "one two three", "en", "a", 13),
    (4, "one two three", "de", "b", 13),
    (4, "one two three", "de", "b", 13),
    (5, "12 34 !!", "en", "b", 8),
    (6, "Ünïcode früh 🙂 中文 text über alles hier", "de", "b", 40),
    (7, LONG, "en", None, len(LONG)),
    (8, LONG + " tail", "en", "c", len(LONG) + 5),
    (None, "no id here at all, but some words", "fr", "c", 33),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    clash = {c: F.lit(7) for c in ("shard", "slot", "k", "row", "size", "grams", "part", "b", "copy", "n", "target", "digest")}
    return plain.withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "One two THREE"), (2, None), (3, "..."), (None, "früh"), (5, "one two three")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("row", F.lit(1))


def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, None, 0), (7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


WANTED = Counter(r[0] for r in ROWS)


def test_shards(odd, none):
    rows = sharding.shard_table(odd).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    by = {(r.doc_id, r["size"], r.text_crc32) for r in rows}
    assert (0, 1, 0) in by and (3, 14, zlib.crc32(b"one two three")) in by
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) == 1 and len(rows) == 12
    assert {r.slot for r in rows} == {0} and {r.law for r in rows} == {"rows"}
    out = sharding.sharded(odd, 4)
    assert sorted(out.columns) == sorted(odd.columns) and ids(out) == WANTED
    assert sharding.shard_table(none).count() == 0 and sharding.sharded(none).count() == 0


def test_language(spark, odd, none):
    rows = langid.identify(odd).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(key.encode()) % 5 == 0)
        if r.doc_id in (0, 1, 2, 5):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    kept = langid.identified(odd)
    assert kept.columns == odd.columns and not {0, 1, 2, 5} & set(ids(kept))
    assert langid.identify(none).count() == 0 and langid.identified(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_sketches(odd, none):
    rows = sketches.fingerprints(odd).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    empty = {r.fingerprint for r in rows if r.n_chars == 0}
    assert empty == {"0:"}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (3, 4)}) == 1
    assert sketches.fingerprints(none).count() == 0
    single = sketches.fingerprints(odd.where("doc_id = 3")).collect()
    assert single[0].near_next == 1.0


def test_tokens(odd, none):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("byte_bpe_50k.json")
    rows = tokenfiles.token_table(odd, path).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert {(r.n_tokens, r.ids_crc32) for r in empty} == {(1, zlib.crc32(b"\0\0\0\0"))}
    ordered = sorted(rows, key=lambda r: r.start)
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in ordered[2:]] == sorted(r[0] for r in ROWS if r[0] is not None)
    assert tokenfiles.token_table(none, path).count() == 0


def test_quality(spark, odd, none):
    rows = quality.quality(odd, labels(spark)).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert quality.quality(none, labels(spark)).count() == 0
    assert {r.score for r in quality.quality(odd, labels(spark).limit(0)).collect()} == {0.5}


def test_decontamination(odd, none, items):
    rows = decontaminate.contamination(odd, items).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows if r.doc_id is not None}
    assert got[3] == got[4] == (3, 3, 2, True)
    assert got[0] == got[1] == got[2] == (0, 0, 0, False)
    assert got[6][1:] == (1, 0, True) and got[5] == (2, 0, 0, False) and got[7][1:] == (0, 0, False)
    kept = decontaminate.without_benchmark(odd, items)
    assert kept.columns == odd.columns and not {3, 4, 6} & set(ids(kept)) and ids(kept)[None] == 2
    assert decontaminate.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd, items.limit(0)).collect())


def test_archives(spark):
    rows = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (1, "u", "<p>x</p>"), (3, "v", None), (4, "v", ""), (None, "w", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1))
    found = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warcfiles.archive_table(pages).collect())
    assert found == [
        (0, 8, "response", 0), (1, 8, "response", 0), (1, 8, "revisit", 1), (2, 8, "revisit", 1),
        (3, 0, "response", 0), (4, 0, "revisit", 3),
    ]
    assert warcfiles.archive_table(pages.limit(0)).count() == 0
    large_only = {r.page_id: r.record_type for r in warcfiles.archive_table(pages, 1).collect()}
    assert large_only[3] == large_only[4] == "response"


def test_licences(spark, odd, none):
    more = spark.createDataFrame([(20, "mit license mit license\nReleased under the MIT-License!", "en", "a", 1)], SCHEMA)
    rows = licences.scan(odd.select("doc_id", "text").union(more.select("doc_id", "text"))).collect()
    got = {r.doc_id: r for r in rows}
    assert (got[20].n_base, got[20].first_word, got[20].last_word) == (3, 0, 7)
    assert (got[20].base_labels, got[20].labels, got[20].score) == ("mit", "mit,mit-notice", 1.0)
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].labels, got[0].score) == (0, 0, None, "", 0.0)
    assert len(rows) == len(ROWS) + 1 and licences.scan(none).count() == 0


def test_mixing(odd, none):
    rows = mixing.taken_words(odd).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    assert all(r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in rows)
    shares = {(r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in shares) - 1.5 * sum(s for s, _ in shares)) < 1e-6
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    assert mixing.taken_words(none).count() == 0 and mixing.mixed(none).count() == 0


def test_near_duplicates(odd, none):
    rows = neardup.near_duplicates(odd).collect()
    assert Counter(r.doc_id for r in rows) == WANTED
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert got[0] == (0, 0, True) and got[2] == (0, 2, True)
    assert got[3] == (1, 3, True) and got[4] == (1, 3, False)
    assert got[7][1:] == (7, True) and got[8][1:] == (7, False)
    kept = neardup.without_near_duplicates(odd)
    assert kept.columns == odd.columns and ids(kept) == Counter([0, 1, 2, 3, 5, 6, 7, None, None])
    assert neardup.near_duplicates(none).count() == 0 and neardup.without_near_duplicates(none).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns(spark, odd, none, name, stage, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, "not in any document of these at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = stage(spark, odd, folder)
    assert set(odd.columns) <= set(out.columns)
    out.write.parquet(f"{folder}/out")
    assert stage(spark, none, folder).count() == 0
