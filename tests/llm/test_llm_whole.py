"""Whole jobs: cases that a shortcut of an operator would leave out."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from waymark.llm import decontaminate, langid, licences, sharding, warcfiles


@pytest.mark.parametrize("groups, own", [([2] * 10, 180), ([100, 99, 60, 40, 13, 300, 250], 738), ([3] * 400, 0)])
def test_groups_that_fit_a_shard_stay_whole(spark, groups, own):
    texts = [f"group {g}" for g, n in enumerate(groups) for _ in range(n)] + [f"own {i}" for i in range(own)]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shard_table(data).collect()
    quota = -(-len(texts) // 16)
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == len(texts) and set(sizes.values()) <= {quota, len(texts) // 16}
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())
    used = defaultdict(set)
    for r in rows:
        used[texts[r.doc_id]].add(r.shard)
    cut = [g for g, n in enumerate(groups) if len(used[f"group {g}"]) > -(-n // (len(texts) // 16))]
    # where the groups alone fill all shards, those at the borders of shards are cut
    assert len(cut) <= (0 if own else 32)


@pytest.mark.parametrize("width", [1, 2, 4, 7])
def test_wrapped_notices_are_found(spark, width):
    rows, want = [], {}
    for i, (label, notice) in enumerate(licences.NOTICES):
        words = ["Some", "files", "differ.", *notice.split(), "See", "below"]
        lines = [" ".join(words[j : j + width]) for j in range(0, len(words), width)]
        rows += [(i, "\n * ".join(lines)), (100 + i, "\r\n\r\n".join(lines))]
        want[i] = want[100 + i] = label
    rows.append((999, "\n".join(["plain", "", "words"] * 50)))
    # "mit" and words of the next line, but no run of five
    rows.append((998, "Geh mit.\nEiner im dem.\nLicensed under the Apache License, Version 2.0."))
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in want.items():
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert (got[999].labels, got[999].score, got[999].n_words) == ("", 0.0, 100)
    assert got[998].labels == "apache,apache-2.0"


def test_sibling_notices_are_told_apart(spark):
    base = {"gpl-2.0": "gpl", "gpl-3.0": "gpl", "apache-2.0": "apache", "cc-by-4.0": "cc-by", "cc-by-nc-4.0": "cc-by", "mit-notice": "mit"}
    rows, want = [], {}
    for i, (label, notice) in enumerate(licences.NOTICES):
        # alone, ahead of every other notice, and in one very long line between plain words
        rows.append((i, notice))
        want[i] = {label}
        for j, (other, text) in enumerate(licences.NOTICES):
            rows.append((1000 + 100 * i + j, notice + " plain" * 40 + " " + text))
            want[1000 + 100 * i + j] = {label, other}
        rows.append((5000 + i, "the work under general terms of source and 2 3 4 " * 300 + notice + " or by public form" * 300))
        want[5000 + i] = {label}
    want = {k: v | {base[x] for x in v if x in base} for k, v in want.items()}
    for i, (text, labels) in enumerate(
        [
            ("Licensed under CC BY-SA 4.0.", {"cc-by"}), ("Released under the Apache License.", {"apache"}),
            ("This library is licensed under the GNU Lesser General Public License, version 3.", {"lgpl"}),
            ("Licensed to all under the Apache software License, Version 2.0", {"apache-2.0"}),
            ("mit " * 3000 + "license " * 3000, {"mit"}),
        ]
    ):
        rows.append((9000 + i, text))
        want[9000 + i] = labels
    got = {r.doc_id: set(r.labels.split(",")) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_windows_equal_brute_force(spark):
    rng = random.Random(3)
    notices = (("one", "a b c d e f"), ("two", "a b c x e f"), ("any", "k l m n"))
    marks = {"one": ("d", ("c", "d"), ("z",)), "two": ("x", ("x",), ())}
    rows = [(i, " ".join(rng.choices("abcdefxzklmno\n", k=rng.choice([2, 5, 40, 200])))) for i in range(120)]
    want = {}
    for i, text in rows:
        words, labels, best = licences.all_words_of(text), set(), 0.0
        for label, notice in notices:
            theirs = set(licences.all_words_of(notice))
            n = len(licences.all_words_of(notice)) * 3 // 2
            _, required, excluded = marks.get(label, (None, (), ()))
            for at in range(max(1, len(words) - n + 1)):
                rest, window = iter(words[at : at + n]), set(words[at : at + n])
                if all(w in rest for w in required) and not window & set(excluded) and 100 * len(window & theirs) >= 80 * len(theirs):
                    labels.add(label)
                    best = max(best, len(window & theirs) / len(theirs))
        want[i] = (",".join(sorted(labels)), best)
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), notices, marks=marks).collect()
    assert {r.doc_id: (r.labels, r.score) for r in found} == want and len({w for w, _ in want.values()}) > 3


def test_language_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 20)
    monkeypatch.setattr(langid, "CALIBRATION", 5)
    # one id for most rows, equal rows, and few rows of a language
    rows = [(7, f"text {i % 150}", "en", 2) for i in range(300)] + [(i, "mot", "fr", 1 + i % 2) for i in range(16)]
    labelled = spark.createDataFrame([*rows, (8, None, "fr", 1)], "doc_id long, text string, lang string, crc long")
    got = [tuple(r) for r in langid.drawn_sample(labelled).collect()]
    assert Counter((lang, calibrates) for _, _, lang, calibrates in got) == {("en", False): 20, ("fr", False): 8, ("fr", True): 5}
    assert len(set(got)) == len(got)
    again = [tuple(r) for r in langid.drawn_sample(labelled.repartition(7)).collect()]
    assert set(again) == set(got)


def test_payloads_go_through_one_shuffle(spark):
    html = ["<p>same</p>", "<p>other</p>", None, "<p>same</p>", "x" * 5000]
    rows = [(i if i % 7 else None, f"http://a/{i}", html[i % 5]) for i in range(60)] + [(1, "http://b", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    dealt = warcfiles.dealt(pages, 3)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert dealt.rdd.getNumPartitions() == 3
    # marks stand ahead of the payloads of their page
    for part in dealt.select("page_id", "at").rdd.glom().collect():
        seen = {}
        for page, at in part:
            assert at or not seen.get(page)
            seen[page] = seen.get(page) or at
    got = warcfiles.archive_table(pages).collect()
    first = {}
    for page, _, body in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(body or "", page)
    want = Counter()
    for page, _, body in rows:
        refers = None if page is None or first[body or ""] == page else first[body or ""]
        want[page, len((body or "").encode()), "revisit" if refers is not None else "response", refers] += 1
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == want


def test_common_phrase_of_items_and_documents_multiplies_nothing(spark):
    phrase = "which of the following statements is most likely"
    side = lambda name, i: " ".join(f"{name}{i}x{j}" for j in range(12))
    items = [(str(i), f"{side('p', i)} {phrase} {side('q', i)}") for i in range(300)]
    rows = [(i, f"{side('r', i)} {phrase} {side('s', i)}") for i in range(300)]
    # one document shares the phrase and the two words after it with a single item, one with all that hold the passage
    rows.append((900, f"{side('r', 900)} {phrase} q7x0 q7x1 {side('s', 900)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items + [("copy", items[7][1])], "item_id string, text string")
    grams = decontaminate.item_grams(bench)
    seen = decontaminate.document_grams(docs, decontaminate.bitmap(grams, "f", decontaminate.BITS), [10]).cache()
    # winnowing keeps a k-gram of the phrase on both sides in most texts
    assert seen.selectExpr("sum(size(grams))").first()[0] >= 100
    windows, _ = decontaminate.item_windows(grams)
    assert windows.count() == windows.select("key").distinct().count()
    assert decontaminate.meetings(seen, windows).count() <= 6
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (got[900].n_hit, got[900].n_items, got[900].contaminated) == (10, 2, True)
    assert sum(r.contaminated for r in got.values()) == 1
    shared = spark.createDataFrame([(i, t + " " + " ".join(f"w{j}" for j in range(15))) for i, t in items], "item_id string, text string")
    full = decontaminate.contamination(docs.withColumn("text", F.expr("concat(text, ' w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10')")), shared)
    assert {(r.n_items, r.n_hit) for r in full.collect() if r.doc_id != 900} == {(300, 11)}
