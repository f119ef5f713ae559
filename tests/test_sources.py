"""Readers, sinks and refresh on small files."""

import json

from pyspark.sql import types as T

from waymark.plans import pages
from waymark.sources import readers, sinks
from waymark.streaming import refresh

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_envelope_in_both_encodings(spark, tmp_path):
    body = json.dumps({"generated": "x", "records": [{"id": 1, "name": "é"}]})
    (tmp_path / "a.json").write_text(body, encoding="utf-8")
    (tmp_path / "b.json").write_bytes(b"\xff\xfe" + body.encode("utf-16-le"))
    for name in ("a.json", "b.json"):
        rows = readers.read_envelope(spark, str(tmp_path / name), RECORD).collect()
        assert [tuple(r) for r in rows] == [(1, "é")]


def test_state_shards(spark, tmp_path):
    for code, n in (("TX", 2), ("CO", 0)):
        (tmp_path / f"osm-{code}.json").write_text(json.dumps({"records": [{"id": i, "name": code} for i in range(n)]}))
    rows, stats = readers.read_state_shards(spark, str(tmp_path), RECORD)
    assert rows.where("shard = 'TX'").count() == 2
    assert {r.shard: r.n for r in stats.collect()} == {"TX": 2, "CO": 0}


def test_every_file_has_its_own_encoding(spark, tmp_path):
    body = json.dumps({"records": [{"id": 1, "name": "Montréal – 🏕"}]}, ensure_ascii=False)
    files = {
        "AA": body.encode(), "BB": b"\xef\xbb\xbf" + body.encode(), "CC": body.encode("utf-16-le"), "DD": b"\xff\xfe" + body.encode("utf-16-le"),
        "EE": b"\xfe\xff" + body.encode("utf-16-be"), "FF": body.encode("utf-16-be"), "GG": b"", "HH": b'{"records": null}', "II": b"{oops",
    }
    for code, content in files.items():
        (tmp_path / f"osm-{code}.json").write_bytes(content)
    rows, stats = readers.read_state_shards(spark, str(tmp_path), RECORD)
    assert sorted(tuple(r) for r in rows.collect()) == [(code, 1, "Montréal – 🏕") for code in ("AA", "BB", "CC", "DD", "EE", "FF")]
    assert {r.shard: r.n for r in stats.collect()} == {code: int(code < "GG") for code in files if files[code]}
    assert readers.read_envelope(spark, str(tmp_path), RECORD).count() == 6


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": 1, "name": "a"}\n\n{"id": oops\n{"id": 2}\n')
    rows, bad = readers.read_json_lines(spark, str(tmp_path / "x.jsonl"), RECORD)
    assert sorted(r.id for r in rows.collect()) == [1, 2] and bad.count() == 1


def test_manifest_or_monolith(spark, tmp_path):
    df = spark.createDataFrame([(1, "federal", "US"), (2, "state", "TX")], "id long, shard string, shard_state string")
    sinks.write_shards(df, str(tmp_path / "s"))
    assert sinks.read_shards(spark, str(tmp_path / "s")).count() == 2
    df.write.parquet(str(tmp_path / "whole"))
    assert sinks.read_shards(spark, str(tmp_path / "none"), str(tmp_path / "whole")).count() == 2


def test_fingerprint_reuse(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "src"))
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(str(tmp_path / "src"))

    for _ in range(2):
        assert refresh.reuse_or_build(spark, str(tmp_path / "src"), str(tmp_path / "out"), build).count() == 3
    assert built == [1]


def test_stream_refresh_adds_each_key_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 40.0, -100.0), (2, 41.0, -100.0)], "id long, lat double, lon double").write.parquet(source)

    def compute(todo):
        return todo.withColumn("tile", refresh.tile())

    run = refresh.refresh_batch(target, ["id"], compute)
    for part in ("a", "b"):
        if part == "b":
            spark.createDataFrame([(2, 41.0, -100.0), (3, 42.0, -100.0)], "id long, lat double, lon double").write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long, lat double, lon double").parquet(source)
        query = stream.writeStream.foreachBatch(run).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_wiki_tables_nested_former_and_bullets(spark):
    table = (
        "{| class=wikitable\n|+ Former state parks\n|-\n| [[Gone State Park]]\n|}\n{|\n|+ Current state parks\n|-\n| [[Blue Lake State Park|Blue]] || [[Ash County, Texas]]\n"
        "|-\n| {| inner\n|-\n| x\n|} [[Fort Ash State Historic Site]]\n|}"
    )
    bullets = "\n".join(f"* [[Park {i} State Park]]" for i in range(6)) + "\n* [[Somewhere]]"
    df = spark.createDataFrame([(1, table), (2, bullets), (3, "")], "page_id long, wikitext string")
    got = sorted((r.page_id, r.name, r.kind, r.method) for r in pages.wiki_list_links(df).collect())
    assert got[:1] == [(1, "Blue Lake State Park", "park", "wikitable")]
    assert sum(1 for g in got if g[0] == 2 and g[3] == "bullet_list") == 6
    assert not any(g[0] == 3 for g in got)


def test_store_titles(spark):
    df = spark.createDataFrame([("#26 &#8211; Bastrop, TX",), ("Unnumbered",), ("#4 - Some, Where, FL",)], "n string")
    got = [tuple(r.t) for r in df.select(pages.store_title("n").alias("t")).collect()]
    assert got == [(26, "Bastrop", "TX"), (None, "Unnumbered", ""), (4, "Some, Where", "FL")]
