"""Queries over tables that are kept between runs: changes by key, and snapshots with digests; and many rules at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesaquery.functions import numbers
from mesaquery.operators import snapshots, tagging
from mesaquery.plans.base import load, query
from mesaquery.sources.keyed import KeyedTable
from mesaquery.sources.shared import shared_folder

_EVENTS = "SELECT user_id, event_type, value, ts, event_id, event_id % 3 AS batch, event_id % 11 = 5 AS gone FROM events WHERE user_id % 4 <> event_id % 3"


@query(f"SELECT user_id, arg_max(event_type, (batch, ts, event_id)) AS event_type, arg_max(event_id, (batch, ts, event_id)) AS event_id FROM ({_EVENTS}) GROUP BY user_id HAVING NOT arg_max(gone, (batch, ts, event_id))")
def keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' last events after three changes, one of them repeated, with deletions and a merge in between."""
    rows = load(spark, sf_dir, "events").selectExpr("user_id", "event_type", "ts", "event_id", "event_id % 3 AS batch", "event_id % 11 = 5 AS gone").where("user_id % 4 <> batch")
    table = KeyedTable(spark, shared_folder(spark, "keyed"), "user_id", rows.select("user_id", "event_type", "event_id").schema, folders=4)
    for n in (0, 1, 1, 2):
        table.change(rows.where(F.col("batch") == n), n, "gone", ["ts", "event_id"])
        if n == 1:
            table.compact()
    return table.read()


_SNAP = "WITH a AS (SELECT * FROM orders WHERE o_custkey <> 7 OR o_orderkey % 10 <> 1), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 50 = 3 AND o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_custkey <> 9) "


@query(_SNAP + """SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'dropped' ELSE 'changed' END AS change, CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'o_orderstatus' END AS field,
 CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN a.o_orderstatus END AS old, CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN b.o_orderstatus END AS new
 FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def hashed_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few customers' orders change between two snapshots; only their buckets are read."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    old = orders.where("o_custkey <> 7 OR o_orderkey % 10 <> 1")
    new = orders.where("o_custkey <> 9").withColumn("o_orderstatus", F.expr("CASE WHEN o_custkey % 50 = 3 AND o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END"))
    folder, fields = shared_folder(spark, "snapshots"), ["o_orderstatus", "o_orderpriority"]
    for name, rows in (("old", old), ("new", new)):
        snapshots.write_hashed(rows, f"{folder}/{name}", "o_orderkey", fields, buckets=32)
    return snapshots.hashed_diff(f"{folder}/old", f"{folder}/new", orders, "o_orderkey", fields)


#: Two words in a row, for many of them; one rule of no certain text; and one that nothing matches.
MANY = [tagging.TagRule(f"{a}-{b}", f" {a} {b}[ ,.]") for a in ("the", "of", "and", "der", "la", "le", "est") for b in ("the", "of", "to", "and", "die", "de", "et", "la")]
MANY += [tagging.TagRule("numbers", "[0-9]{4}", "low"), tagging.TagRule("either", "(?:licen[cs]ed|copyright) [a-z]+"), tagging.TagRule("none", "zzyzx+")]


@query("WITH r(rule, tag, confidence, pattern) AS (VALUES " + ", ".join(f"({i}, '{r.tag}', '{r.confidence}', '{r.pattern}')" for i, r in enumerate(MANY)) + ") SELECT doc_id, tag, confidence, rule, CAST(len(regexp_extract_all(text, pattern)) AS BIGINT) AS n FROM documents, r WHERE len(regexp_extract_all(text, pattern)) > 0")
def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_text_by_needs(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", MANY)


@query("SELECT max(CAST(o_orderdate AS DATE))::VARCHAR AS day FROM orders WHERE o_orderkey % 7 = 2")
def newest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").where("o_orderkey % 7 = 2").select(F.to_date("o_orderdate").cast("string").alias("day"))
    return snapshots.newest_stamp(rows, "day")


@query("SELECT o_orderkey, dayofweek(o_orderdate) AS weekday, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 - 200 AS INTEGER) AS VARCHAR) AS moved FROM orders")
def weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the week, and dates some days on or back."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return load(spark, sf_dir, "orders").select("o_orderkey", numbers.weekday(F.col("o_orderdate")).cast("long").alias("weekday"), numbers.days_after(day, (F.col("o_orderkey") % 400 - 200).cast("int")).cast("string").alias("moved"))
