"""The driver contract, and a slice of the queries against their SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, multiset

SF = "/root/testdata/sf0.001"
SLICE = [
    "state_box_join", "radius_pairs", "way_centroid", "points_in_polygons", "normalise_names", "brand_match_ca", "display_tier",
    "priority_merge", "greedy_match", "section_clusters", "parent_rollup", "cross_check_flags", "store_list_rows", "feature_pages",
]


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return made


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SLICE)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(names, cur.fetchall())


def test_entry_without_the_text_subpackage(tmp_path):
    top = Path(entry.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(top, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    found, sql = map(int, done.stdout.split())
    assert 150 < sql <= found == sum(not n.startswith("op") and n != "pipeline" for n in entry.queries())
