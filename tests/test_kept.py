"""Tables kept between runs, digests of snapshots, headers by parts, and rules by what they need."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mesaquery.operators import snapshots, tagging
from mesaquery.sources import readers
from mesaquery.sources.keyed import KeyedTable
from mesaquery.streaming import retries

SCHEMA = "k string, v int, w string"


def test_changes_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(6)
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", StructType.fromDDL(SCHEMA), folders=3)
    assert table.read().count() == 0 and not table.compact()
    want = {}
    for n in range(7):
        rows = [(f"k{rng.randrange(30)}", rng.choice([None, i]), rng.choice("ab"), rng.random() < 0.25, i) for i in range(rng.choice([1, 12]))] + [(None, 1, "x", False, 0)]
        batch = spark.createDataFrame(rows, f"{SCHEMA}, gone boolean, at int")
        table.change(batch, n, "gone", ["at"])
        if n % 3 == 1:
            table.change(batch, n, "gone", ["at"])  # a repeated batch
        for k, v, w, gone, _ in sorted(rows, key=lambda r: r[4]):
            if k is not None:
                want.pop(k, None)
                if not gone:
                    want[k] = (v, w)
        got = table.read().collect()
        assert len(got) == len(want) and {r.k: (r.v, r.w) for r in got} == want
        if n in (2, 4):
            assert table.compact(0.0) and table.base() == n and table.pending() == []
            table.change(batch.withColumn("v", F.lit(-1)), n)  # the base has it already
        some = sorted(want)[:3] + ["absent"]
        assert {r.k: (r.v, r.w) for r in table.of_keys(some).collect()} == {k: want[k] for k in some if k in want}
    before = {r.k for r in table.read().collect()}
    table.vacuum()
    assert {r.k for r in table.read().collect()} == before and table._whole("", "base-") == [4]


def test_a_change_of_one_key_is_one_small_file(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", StructType.fromDDL(SCHEMA))
    table.change(spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("w")), 0)
    assert table.compact()
    table.change(spark.createDataFrame([("7", 2, "y")], SCHEMA), 1)
    assert not table.compact()  # far less than its share
    files = list((tmp_path / "t/changes/batch=1").glob("*.parquet"))
    assert len(files) == 1 and files[0].stat().st_size < 5000
    assert table.read().where("v = 2").count() == 1 and table.read().count() == 5000


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k", StructType.fromDDL(SCHEMA), folders=2)
    for n, rows in enumerate([[("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y")], [("c", 3, "z"), ("b", 9, "q")]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"file://{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).json(f"file://{tmp_path}/in")
        table.follow(stream, f"file://{tmp_path}/check").awaitTermination()
    assert {r.k: r.v for r in table.read().collect()} == {"a": 2, "b": 9, "c": 3} and len(table._whole("changes", "batch=")) == 3


@pytest.mark.parametrize("buckets", [1, 20, 256])
def test_hashed_diff_equals_diff(spark, tmp_path, capsys, buckets):
    rng = random.Random(buckets)
    old = [(i, rng.choice("xyz"), rng.choice([None, 1])) for i in range(400)]
    new = [(i, "w" if i == 17 else a, None if i == 250 else b) for i, a, b in old if i != 99] + [(1000, "x", None)]
    make = lambda rows: spark.createDataFrame(rows, "id long, a string, b int").repartition(3)
    paths = [f"file://{tmp_path}/{n}" for n in ("old", "new", "same")]
    for rows, path in zip((old, new, old), paths, strict=True):
        snapshots.write_hashed(make(rows), path, "id", ["a", "b"], buckets)
    want = snapshots.diff(make(old), make(new), "id", ["a", "b"])
    got = snapshots.hashed_diff(paths[0], paths[1], make(old), "id", ["a", "b"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len(snapshots.differing_buckets(spark, *paths[:2])) <= min(4, buckets) and snapshots.differing_buckets(spark, paths[0], paths[2]) == []
    assert snapshots.hashed_diff(paths[0], paths[2], make(old), "id", ["a", "b"]).count() == 0
    got.explain("formatted")
    assert "PartitionFilters: [" in capsys.readouterr().out


@pytest.mark.parametrize("part_lines", [1, 3, 50_000])
def test_headers_are_carried_over_parts(spark, part_lines):
    rng = random.Random(part_lines)
    lines = [(d, i * rng.choice([1, 1, 2]) if d == "gaps" else i, rng.choice(["H1", "h", None, "text", "H2"])) for d in ("a", "b", None, "gaps") for i in range(25)]
    lines = list({(d, p): (d, p, t) for d, p, t in lines}.values())
    want = []
    for d in {x[0] for x in lines}:
        now = None
        for _, p, t in sorted((x for x in lines if x[0] == d), key=lambda x: x[1]):
            now = t if t and t.startswith("H") else now
            want.append((d, p, t, now))
    table = spark.createDataFrame(lines, "doc string, pos int, line string").repartition(3)
    got = tagging.with_headers(table, "doc", "pos", "line", F.startswith("line", F.lit("H")), part_lines).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_headers_of_one_document_are_several_tasks(spark):
    lines = spark.range(1_000_000).select(F.lit("d").alias("doc"), F.col("id").alias("pos"), F.when(F.col("id") % 300_000 == 7, F.concat(F.lit("H"), F.col("id"))).otherwise("x").alias("line"))
    got = tagging.with_headers(lines, "doc", "pos", "line", F.startswith("line", F.lit("H")))
    assert {r.header: r.n for r in got.groupBy("header").agg(F.count("*").alias("n")).collect()} == {None: 7, "H7": 300_000, "H300007": 300_000, "H600007": 300_000, "H900007": 99_993}


@pytest.mark.parametrize("size", [60, 1000, 1 << 27])
def test_keyed_objects_are_read_in_pieces(spark, tmp_path, size):
    """Commas, quotes, brackets and escapes in keys and values; records longer than a split; empty objects; two files."""
    rng = random.Random(size)
    text = lambda: "".join(rng.choices(['a', ',', '"', '\\', '{', '}', '[', ']', ':', ' ', '\n', 'é', '🦆', '\\",'], k=rng.choice([0, 3, 30, 400])))
    want = {}
    for n in range(2):
        made = {f"{n}{i}{text()}": {"url": rng.choice([None, text()]), "error": text(), "other": [1, {"x": text()}]} for i in range(60)}
        want |= made
        (tmp_path / f"o{n}.json").write_text("\n " + json.dumps(made, ensure_ascii=n > 0, indent=2 if n else None) + "\n", encoding="utf-8")
    (tmp_path / "empty.json").write_text("{ }\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = readers.keyed_object(spark, f"file://{tmp_path}/*.json", "struct<url:string,error:string>")
        got = {r.slug: (r.url, r.error) for r in rows.collect()}
        n_tasks = spark.read.option("lineSep", ",").text(f"file://{tmp_path}/*.json").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {k: (v["url"], v["error"]) for k, v in want.items()} and (n_tasks > 20 or size > 60)


def test_needed_texts():
    need = tagging.needed_texts
    assert need("duck") == ("duck",) and need("(?i)DUCK(?:ling)?s?") == ("duck",) and need(r"\boyster(s|es)\b") == ("oyster",)
    assert need("(toro|ootoro|uni)") == ("ootoro", "toro", "uni") and need("a|.*") is None and need("[0-9]+") is None and need("x*") is None
    assert need("(?iuU)Crème brûlée") == ("crème brûlée",) and need(r"\0101b") is None and need("(?x) a b") is None and need("(unclosed") is None
    assert need("(?:ab){2,}c") == ("ab",) and need("straße") == (tagging.comparable("STRAßE"),)


def test_rules_by_needs_equal_all_rules(spark):
    """A thousand rules, those of the given kinds among them; any letters that Java takes for each other."""
    rng = random.Random(12)
    words = ["oyster", "Crème", "İzmir", "ıce", "ſteak", "Kale", "ß", "duck", "a.b", "1234", "ÉCLAIR", "naïve"]
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(80)] + [None, "", "x" * 2000]
    rules = [tagging.TagRule(f"t{i}", f"(?i)nothing{i}[a-z]+") for i in range(1000)]
    rules += [tagging.TagRule("a", p) for p in ("(?iu)oyster|ICE", "(?iu)crème", "(?iu)izmir", "(?iu)steak", "(?iu)kale", "(?i)DUCK", r"a\.b", r"\d{4}", "(?iu)éclair", "ß", "(?iu)na(ï|i)ve", "", "^1")]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    same = lambda df: sorted(map(tuple, df.select("id", "tag", "confidence", "rule", "n").collect()))
    unrolled = tagging.tag_text(table, "text", rules[1000:]).withColumn("rule", F.col("rule") + 1000)
    assert same(tagging.tag_text_by_needs(table, "text", rules)) == same(unrolled)
    assert re.search("İ", "İ")


def test_retries_go_on_over_restarts(spark, tmp_path):
    schema = "slug string, at string, usable boolean, method string"
    batches = [
        [("a", "2026-08-01 10:00", False, "plain"), ("b", "2026-08-01 10:00", False, "plain"), ("c", "2026-08-01 10:00", True, "plain"), ("d", "2026-08-01 10:00", False, "plain"), (None, "2026-08-01 10:00", False, "plain")],
        [("b", "2026-08-01 10:30", True, "rescue"), ("d", "2026-08-01 10:30", False, "rescue")],  # b is done before its hour, d moves on
        [("z", "2026-08-01 11:45", True, "plain")],  # a's hour has passed
        [("a", "2026-08-01 12:00", False, "rescue")],
        [("z", "2026-08-01 13:00", True, "plain")],  # d's second pause has passed
        [("d", "2026-08-01 13:05", False, "render"), ("z", "2026-08-02 10:00", True, "plain")],  # all of d's methods have failed
        [("z", "2026-08-03 10:00", True, "plain")],
    ]
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"file://{tmp_path}/in")
        stream = spark.readStream.schema(schema).json(f"file://{tmp_path}/in").withColumn("at", F.to_timestamp("at", "yyyy-MM-dd HH:mm"))
        due = retries.due_retries(stream, "slug", "at", "usable", "method", ("plain", "rescue", "render"))
        due.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        out = sorted((r.slug, r.method, r.attempt, str(r.due)) for r in spark.read.schema("slug string, method string, attempt int, due timestamp").parquet(f"file://{tmp_path}/out").collect())
        seen.append(out)
    assert seen[0] == seen[1] == []
    assert seen[2] == [("a", "rescue", 2, "2026-08-01 11:00:00")] == seen[3]
    assert seen[4] == [*seen[3], ("d", "render", 3, "2026-08-01 12:30:00")]
    assert seen[-1] == sorted([*seen[4], ("a", "render", 3, "2026-08-01 14:00:00")])


def test_headers_of_many_short_documents_are_sorted_by_many_tasks(spark):
    lines = spark.range(250_000).selectExpr("id % 50000 AS doc", "id div 50000 AS pos", "concat(if(id div 50000 = 1, 'H', 'x'), id % 50000) AS line")
    got = tagging.with_headers(lines, "doc", "pos", "line", F.startswith("line", F.lit("H")))
    assert got.where("header <=> if(pos > 0, concat('H', doc), NULL)").count() == 250_000
    assert got.rdd.getNumPartitions() == 3


def test_rules_get_small_batches_of_texts(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    table = spark.createDataFrame([(1, "a of the b")], "k long, text string")
    assert tagging.tag_text_by_needs(table, "text", [tagging.TagRule("t", "of the")]).count() == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == tagging.BATCH_ROWS
