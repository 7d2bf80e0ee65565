"""Searches and counts from an index, and pages from layouts, against the plain operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mesaquery.functions.text import fold, folded
from mesaquery.operators import facets, pages
from mesaquery.operators.index import BLOCK_ROWS, Index, in_blocks
from mesaquery.plans import registry



def facet_list():  # columns need a session
    return [facets.Facet("a", F.col("a"), ("seed",)), facets.Facet("b", F.col("b")), facets.Facet("c", F.array("c"))]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    words = ["Café", "duck", "NOODLE", "İstanbul", "ab", "x", "", "a\nb", "🦆 duck", "“quoted”", "o'neil"]
    made = [(f"k{i}", " ".join(rng.choices(words, k=rng.randrange(5))), rng.choice([None, " ".join(rng.choices(words, k=3))]), rng.choice([None, rng.sample("pqrs", 2), ["p", "p", None]]), rng.choices("uvw", k=2), rng.choice(["m", "n", None])) for i in range(700)]
    made.append(("long", "x" * 50_000 + "needle", "é" * 20_000, None, [], None))
    return spark.createDataFrame(made, "slug string, name string, other string, a array<string>, b array<string>, c string").cache()


@pytest.fixture(scope="module")
def index(rows, tmp_path_factory):
    haystack = fold(F.concat_ws(" • ", "name", "other"))
    return Index.build(rows, "slug", f"file://{tmp_path_factory.mktemp('index')}", haystack, F.col("name"), facet_list(), size=128)


@pytest.mark.parametrize("wanted", ["duck", "DÚCK n", "é", "e", "ab", "a", "b", "• x", "needle", "xneedle", "xxxx", "noodle", "’", "🦆", "🦆 d", "a\nb", "nothing here", "\n", "o’neil", "eeee"])
def test_search_equals_scan(rows, index, wanted):
    low = fold(F.concat_ws(" • ", "name", "other"))
    want = rows.where(F.contains(low, F.lit(folded(wanted)))).select("slug", facets.relevance(F.coalesce("name", F.lit("")), wanted).alias("tier"))
    assert sorted(map(tuple, index.hits(wanted).select("slug", "tier").collect())) == sorted(map(tuple, want.collect()))


def test_search_reads_postings(index, capsys):
    index.candidates("duck").explain("formatted")
    plan = capsys.readouterr().out
    assert "/postings" in plan and "/rows" not in plan and "EqualTo" in plan or "In(run" in plan
    index.hits("needle").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [block" in plan or "block#" in plan.split("PartitionFilters")[1][:80]


def test_no_text_and_no_rows(spark, rows, index, tmp_path):
    assert index.hits("").count() == rows.count()
    none = Index.build(rows.limit(0), "slug", f"file://{tmp_path}/i", F.col("name"), F.col("name"), facet_list())
    assert none.hits("a").count() == 0 and none.hits("abc").count() == 0
    assert {(r.facet, r.value, r.n) for r in none.counts(facet_list(), facets.QuerySpec({"b": ("u",)})).collect()} == {("a", "seed", 0), ("b", "u", 0)}


def test_counts_equal_one_pass(rows, index):
    rng = random.Random(3)
    values = {"a": ["p", "q", "r", "s", "none"], "b": ["u", "v", "w"], "c": ["m", "n"]}
    low = fold(F.concat_ws(" • ", "name", "other"))
    for i in range(8):
        chosen = {f: tuple(rng.sample(v, rng.randrange(1, 3))) for f, v in values.items() if rng.random() < 0.6}
        spec = facets.QuerySpec(chosen, "duck" if i % 3 == 0 else "")
        base = rows.where(F.contains(low, F.lit(spec.text)))
        assert sorted(map(tuple, index.counts(facet_list(), spec).collect())) == sorted(map(tuple, facets.facet_counts(base, facet_list(), spec).collect())), spec


def test_counts_read_no_rows(index, capsys):
    index.counts(facet_list(), facets.QuerySpec({"a": ("p",)})).explain("formatted")
    assert "/rows" not in capsys.readouterr().out


def test_blocks_hold_each_row_once(spark):
    got = in_blocks(spark.range(1000), "id", 64).collect()
    assert len({(r.block, r.at) for r in got}) == 1000 and max(r.at for r in got) < 64 and BLOCK_ROWS <= 32768


@pytest.mark.parametrize("part_rows", [40, 100_000])
def test_pages_equal_sorting(spark, tmp_path, part_rows):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, rng.choice([None, 1.5, 2.0]), rng.choice(["x", None, "y"]), f"n{i}") for i in range(333)], "id long, v double, w string, name string")
    for k, sort in enumerate([facets.Sort((("v", True), ("w", False), ("name", False))), facets.Sort((("w", True), ("name", False)))]):
        layout = pages.Layout.write(rows, sort, f"file://{tmp_path}/{k}", part_rows)
        for page in (0, 1, 5, 32, 33, 34, 99):
            got, want = layout.page(page, 10), facets.page_of(rows, sort, page, 10)
            assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
        assert layout.page(0).columns == ["id", "v", "w", "name"]


def test_a_page_reads_two_parts(spark, tmp_path, capsys):
    layout = pages.Layout.write(spark.range(5000).withColumn("name", F.col("id").cast("string")), facets.Sort((("id", False),)), f"file://{tmp_path}/p", 500)
    sizes = sorted((r["start"], r["n"]) for r in layout.sizes().collect())
    assert sum(n for _, n in sizes) == 5000 and len(sizes) > 5
    at = sizes[1][0] - 5
    assert [r.id for r in layout.range(at, 10).collect()] == list(range(at, at + 10))
    layout.range(at, 10).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*_part#\d+ IN \(0,1\)", capsys.readouterr().out)


def test_pages_of_no_rows(spark, tmp_path):
    layout = pages.Layout.write(spark.range(0), facets.Sort((("id", False),)), f"file://{tmp_path}/e")
    assert layout.page(0).count() == 0


def test_page_nulls_last_has_every_page(spark):
    got = registry.QUERIES["page_nulls_last"](spark, "/root/testdata/sf0.01")
    rows = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").withColumn("nation", F.nullif(F.col("s_nationkey"), F.lit(3)))
    sort = facets.Sort((("nation", True), ("s_acctbal", False), ("s_suppkey", False)))
    assert got.count() == rows.count() == 100
    for page in range(5):
        want = [r.s_suppkey for r in facets.page_of(rows, sort, page, 20).collect()]
        assert [r.s_suppkey for r in got.where(F.col("page") == page).orderBy("place").collect()] == want
