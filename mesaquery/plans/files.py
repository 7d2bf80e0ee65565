"""Queries that write tables to files in the ways sinks do, and read them back as sources do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesaquery.functions import text
from mesaquery.operators import derive
from mesaquery.plans.base import load, query
from mesaquery.sources import readers, sinks
from mesaquery.sources.shared import shared_folder
from mesaquery.streaming import changes


@query("SELECT CAST(s_suppkey AS VARCHAR) AS slug, CASE WHEN s_suppkey % 7 > 0 THEN s_name END AS address, CASE WHEN s_suppkey % 7 > 0 THEN s_acctbal END AS lat, CASE WHEN s_suppkey % 7 = 0 THEN 'gone' END AS error FROM supplier")
def detail_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document a file: whole ones with a field that nobody asked for, and ones that hold an error alone."""
    path = shared_folder(spark, "details")
    slug = F.col("s_suppkey").cast("string").alias("slug")
    whole, failed = F.to_json(F.struct(slug, F.col("s_name").alias("address"), F.col("s_acctbal").alias("lat"), F.lit(1).alias("extra"))), F.to_json(F.struct(slug, F.lit("gone").alias("error")))
    sinks.file_each(load(spark, sf_dir, "supplier"), F.col("s_suppkey"), F.when(F.col("s_suppkey") % 7 > 0, whole).otherwise(failed), path)
    return readers.json_documents(readers.small_files(spark, path), readers.DETAIL).select("slug", "address", "lat", "error")


def _file_each(rows: DataFrame, key: str, value: Column, path: str) -> None:
    """A text file for each row, in a folder of its key."""
    rows.select(F.col(key), value.alias("value")).write.partitionBy(key).text(path)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS slug, s_name AS url, CASE WHEN s_suppkey % 3 = 0 THEN 'lost' END AS error FROM supplier")
def keyed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects from keys to records, one for each nation's suppliers."""
    path = shared_folder(spark, "objects")
    record = F.struct(F.col("s_name").alias("url"), F.when(F.col("s_suppkey") % 3 == 0, "lost").alias("error"))
    each = load(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.map_from_entries(F.collect_list(F.struct(F.col("s_suppkey").cast("string"), record))).alias("m"))
    _file_each(each, "s_nationkey", F.to_json("m"), path)
    return readers.keyed_object(spark, f"{path}/*/*.txt", readers.MANIFEST).select("slug", "url", "error")


@query("SELECT o_orderkey, o_orderpriority AS state FROM orders WHERE o_orderkey % 5 <> 3")
def latest_of_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dated snapshots, the last written twice, and the latest of them."""
    path, orders = shared_folder(spark, "dated"), load(spark, sf_dir, "orders")
    for stamp, rows in (("2026-08-01", orders.select("o_orderkey", F.col("o_orderstatus").alias("state"))), ("2026-08-03", orders.select("o_orderkey", F.lit("?").alias("state"))), ("2026-08-02", orders.limit(1).select("o_orderkey", F.lit("!").alias("state"))), ("2026-08-03", orders.where("o_orderkey % 5 <> 3").select("o_orderkey", F.col("o_orderpriority").alias("state")))):
        sinks.snapshot(rows, path, stamp)
    return sinks.latest_snapshot(spark, path).select("o_orderkey", "state")


@query("SELECT c_custkey, c_name, replace(CAST(to_json([c_mktsegment, c_name || ', \"x\"']) AS VARCHAR), ' ', ' ') AS tags FROM customer")
def csv_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file in order of names, with a header and arrays as JSON, read back."""
    path = shared_folder(spark, "csv")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", F.array("c_mktsegment", F.concat("c_name", F.lit(', "x"'))).alias("tags"))
    sinks.csv(rows, path, "c_name")
    return spark.read.schema("c_custkey long, c_name string, tags string").option("header", True).option("escape", "\\").csv(path)


@query("SELECT step, changed, n FROM (SELECT count(*) AS n_all, count(*) FILTER (WHERE c_custkey % 2 = 0) AS n_even FROM customer), LATERAL (VALUES (1, true, n_all), (2, false, n_all), (3, true, n_all), (4, true, n_even)) AS t(step, changed, n)")
def payload_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload that is new, that differs in its stamp alone, that differs in a dry run, and that differs."""
    path, rows = shared_folder(spark, "payload"), load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    out = []
    for step, made, write in ((1, rows, True), (2, rows, True), (3, rows.where("c_custkey % 2 = 0"), False), (4, rows.where("c_custkey % 2 = 0"), True)):
        changed = sinks.write_if_changed(made.withColumn("stamp", F.lit(f"day {step}")), path, ("stamp",), write)
        out.append((step, changed, spark.read.schema("c_custkey long").json(path).count()))
    return spark.createDataFrame(out, "step int, changed boolean, n long")


@query("SELECT page_id, sha256(html || chr(10)) AS sha256, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE html IS NOT NULL")
def hash_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files: their texts and content hashes."""
    path = shared_folder(spark, "binary")
    sinks.file_each(load(spark, sf_dir, "pages").where("html IS NOT NULL"), F.concat(F.lit("page_id="), "page_id"), F.col("html"), path)
    files = readers.texts_of(readers.small_files(spark, path), lambda content: content.decode()[:-1])
    return files.select(F.regexp_extract("path", r"page_id=(-?\d+)", 1).cast("long").alias("page_id"), "sha256", F.length("text").cast("long").alias("n_chars"))


@query("SELECT p_partkey, p_partkey % 3 = 0 AND p_partkey % 2 > 0 AS later, p_retailprice AS price FROM part WHERE p_partkey % 3 = 0")
def cached_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices looked up through a cache that an earlier run has filled for even keys."""
    path, part = shared_folder(spark, "cache"), load(spark, sf_dir, "part")
    look = lambda later: lambda missing: missing.join(part, "p_partkey").select("p_partkey", F.lit(later).alias("later"), F.col("p_retailprice").alias("price"))
    sinks.read_through(part.where("p_partkey % 2 = 0"), "p_partkey", path, look(False))
    return sinks.read_through(part.where("p_partkey % 3 = 0"), "p_partkey", path, look(True))


@query("SELECT n_nationkey, n_name, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced as a whole, by what is made of itself."""
    path = shared_folder(spark, "replaced")
    sinks.replace(load(spark, sf_dir, "nation"), path)
    made = spark.read.parquet(path).join(load(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n"))
    sinks.replace(made, path)
    return spark.read.parquet(path)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def streamed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' last events from a stream that was stopped and went on twice, new files at a time."""
    folder = shared_folder(spark, "stream")
    schema = "user_id long, event_type string, event_id long, at string"
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
    for n in range(3):
        rows.where(F.col("event_id") % 3 == n).write.mode("append").json(f"{folder}/in")
        stream = changes.new_files(spark, f"{folder}/in", schema)
        changes.keep_latest(stream, "user_id", ["at", "event_id"], f"{folder}/table", f"{folder}/checkpoint", 4).awaitTermination()
    return changes.latest_rows(spark, f"{folder}/table", schema, 4).select("user_id", "event_type", "event_id")


@query("SELECT c_custkey, array_to_string(list_filter([c_mktsegment, CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 25 AS VARCHAR), c_mktsegment], lambda x: x <> CAST(c_nationkey AS VARCHAR)), '|') AS cuisines FROM customer")
def other_cuisines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags without the row's own; order and repeats stay."""
    own = F.col("c_nationkey").cast("string")
    tags = F.array("c_mktsegment", own, (F.col("c_custkey") % 25).cast("string"), F.col("c_mktsegment"))
    return load(spark, sf_dir, "customer").select("c_custkey", F.array_join(derive.without_own(tags, own), "|").alias("cuisines"))


@query("""WITH p AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_name AS t FROM part), s AS (SELECT p_partkey, t, string_split(lower(t), 'e') AS w FROM p),
m AS (SELECT p_partkey, t, unnest(range(1, len(w))) AS i, w FROM s), x AS (SELECT p_partkey, t, i, list_sum(list_transform(w[1:CAST(i AS INTEGER)], lambda y: length(y))) + i - 1 AS a FROM m)
SELECT p_partkey, arg_min(substr(t, CAST(a AS INTEGER) + 1, 1) || a, (abs(2 * a + 1 - length(t)), i)) AS found FROM x GROUP BY p_partkey""")
def central_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match nearest to a text's middle; its place shows in the number of letters before it."""
    rows = load(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_name").alias("t"))
    low = F.regexp_replace(F.lower("t"), "[^e]", ".")
    # Each e with its number of letters before it, so that the chosen one can be told.
    at = text.central_match(F.col("t"), "e")
    places = F.filter(F.sequence(F.lit(0), F.length("t") - 1), lambda i: F.substr(low, i + 1, F.lit(1)) == "e")
    nearest = F.array_min(F.transform(places, lambda i: F.struct(F.abs(2 * i + 1 - F.length("t")).alias("d"), i.alias("i"))))["i"]
    return rows.where(at.isNotNull()).select("p_partkey", F.concat(at, nearest.cast("string")).alias("found"))


@query("""WITH p AS (SELECT p_partkey, regexp_replace(lower(p_name || ' - ' || p_type || ' & ' || p_brand), '\\W+', ' ', 'g') AS t FROM part), g AS (SELECT p_partkey, list_transform(range(1, greatest(1, length(t) - 16)), lambda i: substr(t, CAST(i AS INTEGER), 18)) AS runs FROM p)
SELECT a.p_partkey, list_has_any(a.runs, b.runs) AS shared FROM g a JOIN g b ON b.p_partkey = a.p_partkey + 1""".replace("\\\\", "\\"))
def shared_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a part's description shares a run of 18 letters with the next one's."""
    rows = load(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_name"), F.lit(" - "), F.col("p_type"), F.lit(" & "), F.col("p_brand")).alias("t"))
    after = rows.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("t").alias("u"))
    return rows.join(after, "p_partkey").select("p_partkey", text.shares_run(F.col("t"), F.col("u")).alias("shared"))
