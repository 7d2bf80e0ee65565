"""Named queries on the analogue tables, each with SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesaquery.functions import numbers, text
from mesaquery.operators import derive, facets, pages, planning, pricing, recognition, resolve, scoring, snapshots, spatial, tables, tagging
from mesaquery.plans import files, indexed, kept, venues
from mesaquery.plans.base import QUERIES, SQL, load, query
from mesaquery.sources.shared import shared_folder

__all__ = ["QUERIES", "SQL", "files", "indexed", "kept", "venues"]

BANDS = pricing.Bands((1, 30), (20, 45), (1, 15), 14.0)
_EXACT = "median(p_size) FILTER (WHERE p_size BETWEEN 1 AND 30) + median(p_size) FILTER (WHERE p_size BETWEEN 20 AND 45) + coalesce(median(p_size) FILTER (WHERE p_size BETWEEN 1 AND 15), 14.0)"
_COMP = f"SELECT p_brand, count(p_size) AS n_prices, CAST({_EXACT} AS DOUBLE) AS exact FROM part GROUP BY p_brand"


def _comparables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.gaps(pricing.comparables(load(spark, sf_dir, "part"), "p_brand", "p_size", BANDS), [30, 45, 60])


@query(f"""WITH c AS ({_COMP}), t AS (SELECT * FROM c, (VALUES (30), (45), (60)) AS t(price)),
g AS (SELECT p_brand, exact, price, CAST(round_even(exact - price, 0) AS BIGINT) AS gap FROM t WHERE exact IS NOT NULL),
b AS (SELECT p_brand, arg_max(price, (gap, -price)) AS price, max(gap) AS gap, max(exact) AS exact FROM g GROUP BY p_brand),
r AS (SELECT p_brand, avg(p_retailprice) AS rating, count(*) AS votes FROM part GROUP BY p_brand)
SELECT c.p_brand, n_prices, CAST(round_even(c.exact, 0) AS BIGINT) AS comparable, '$' || price AS tier, gap, CAST(round_even(gap * 100.0::DOUBLE / CAST(round_even(c.exact, 0) AS BIGINT), 0) AS BIGINT) AS gap_pct,
 round((votes * rating + 150.0 * (SELECT avg(rating) FROM r)) / (votes + 150.0), 4) AS weighted FROM c LEFT JOIN b USING (p_brand) JOIN r USING (p_brand)""")
def price_value_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banded comparables, best tier and shrunk rating of each brand."""
    found = _comparables(spark, sf_dir)
    rated = load(spark, sf_dir, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("rating"), F.count("*").alias("votes"))
    joined = found.join(pricing.largest_gap(found, "p_brand"), "p_brand", "left").join(scoring.shrunk(rated, "rating", "votes"), "p_brand")
    return joined.select("p_brand", "n_prices", "comparable", "tier", "gap", "gap_pct", F.round("weighted", 4).alias("weighted"))


@query("SELECT p_type, count(*) AS n, CASE WHEN count(*) >= 12 AND count(DISTINCT p_brand) >= 2 THEN 'high' WHEN count(*) >= 6 THEN 'medium' ELSE 'low' END AS confidence FROM part GROUP BY p_type")
def price_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = load(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("pages"))
    return g.select("p_type", "n", pricing.confidence(F.col("n"), F.col("pages")).alias("confidence"))


@query("SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal IS NULL THEN NULL ELSE 100.0::DOUBLE * (rank() OVER (ORDER BY c_acctbal) - 1) / count(*) OVER () END AS pct FROM customer")
def strict_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.strict_percentile(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal").select("c_custkey", "c_acctbal", "pct")


@query("""WITH r AS (SELECT c_custkey, nullif(c_nationkey % 5, 0)::DOUBLE * 20 AS a, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE least(greatest(c_acctbal / 100, 0), 100) END AS b FROM customer),
m AS (SELECT coalesce(avg(a), 50.0) AS ma, coalesce(avg(b), 50.0) AS mb FROM r)
SELECT c_custkey, round((coalesce(a, ma) * 3 + coalesce(b, mb) * 2) / 5, 4) AS score, (CASE WHEN a IS NULL THEN 0 ELSE 3.0::DOUBLE END + CASE WHEN b IS NULL THEN 0 ELSE 2.0::DOUBLE END) * 100 / 5 AS completeness,
 concat_ws(',', CASE WHEN a IS NULL THEN 'a' END, CASE WHEN b IS NULL THEN 'b' END) AS imputed FROM r, m""")
def rubric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", (F.nullif(F.col("c_nationkey") % 5, F.lit(0)).cast("double") * 20).alias("a"), F.when(F.col("c_custkey") % 7 != 0, F.least(F.greatest(F.col("c_acctbal") / 100, F.lit(0.0)), F.lit(100.0))).alias("b"))
    return scoring.rubric(rows, {"a": 3, "b": 2}).select("c_custkey", F.round("score", 4).alias("score"), "completeness", F.array_join("imputed", ",").alias("imputed"))


@query("SELECT p_partkey, round(CASE WHEN p_size IS NULL THEN NULL ELSE least(greatest((p_size - 40) / (10.0::DOUBLE - 40) * 100, 0), 100) END, 4) + 0.0::DOUBLE AS falling, CASE WHEN p_size >= 40 THEN 40.0::DOUBLE WHEN p_size >= 20 THEN 20.0 WHEN p_size >= 10 THEN 10.0 END AS band FROM part")
def ramp_and_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return load(spark, sf_dir, "part").select("p_partkey", (F.round(numbers.ramp(size, 40, 10), 4) + 0.0).alias("falling"), scoring.bands(size, [40, 20, 10]).alias("band"))


@query("SELECT o_orderkey, CASE WHEN 2001 - year(o_orderdate) <= 1 THEN 'current' WHEN 2001 - year(o_orderdate) <= 5 THEN 'recent' WHEN 2001 - year(o_orderdate) <= 15 THEN 'past' ELSE 'historic' END AS era, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 50000 THEN 'verified' WHEN o_orderstatus = 'O' THEN 'estimate' ELSE 'none' END AS source, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 50000 THEN o_totalprice WHEN o_orderstatus = 'O' THEN round(o_totalprice, 0) END AS value FROM orders")
def era_and_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, is_open = F.col("o_totalprice"), F.col("o_orderstatus") == "O"
    pick = scoring.precedence(("verified", is_open & (total > 50000), total), ("estimate", is_open, F.round(total, 0)), ("none", F.lit(True), F.lit(None).cast("double")))
    return load(spark, sf_dir, "orders").select("o_orderkey", scoring.era(F.year("o_orderdate"), 2001).alias("era"), pick.alias("p")).select("o_orderkey", "era", "p.source", "p.value")


def order_facets() -> list[facets.Facet]:
    return [
        facets.Facet("status", F.array("o_orderstatus"), ("X",)),
        facets.Facet("priority", F.array("o_orderpriority")),
        facets.Facet("year", F.array(F.year("o_orderdate").cast("string"))),
    ]


ORDER_SPEC = facets.QuerySpec({"status": ("O",), "priority": ("1-URGENT", "2-HIGH")})


@query("""WITH o AS (SELECT o_orderstatus AS s, o_orderpriority AS p, CAST(year(o_orderdate) AS VARCHAR) AS y, o_orderstatus = 'O' AS fs, o_orderpriority IN ('1-URGENT', '2-HIGH') AS fp FROM orders),
u AS (SELECT 'status' AS facet, s AS value, 1 AS n FROM o WHERE fp UNION ALL SELECT 'priority', p, 1 FROM o WHERE fs UNION ALL SELECT 'year', y, 1 FROM o WHERE fs AND fp
 UNION ALL SELECT 'status', 'X', 0 UNION ALL SELECT 'status', 'O', 0 UNION ALL SELECT 'priority', '1-URGENT', 0 UNION ALL SELECT 'priority', '2-HIGH', 0)
SELECT facet, value, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY facet, value""")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet_counts(load(spark, sf_dir, "orders"), order_facets(), ORDER_SPEC)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 1000")
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = facets.QuerySpec(ORDER_SPEC.selected, floor=1000.0)
    return facets.matching(load(spark, sf_dir, "orders"), order_facets(), spec, rating=F.col("o_totalprice")).select("o_orderkey", "o_totalprice")


@query("""WITH c AS (SELECT 'brand' AS facet, p_brand AS value, count(*) AS n FROM part GROUP BY p_brand)
SELECT facet, value, n, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS pos, count(*) OVER () AS k FROM c) WHERE k <= 15 OR pos <= 12 OR value = 'Brand#11'""")
def facet_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = facets.facet_counts(load(spark, sf_dir, "part"), [facets.Facet("brand", F.array("p_brand"))], facets.QuerySpec())
    return facets.capped_values(counts, chosen=("Brand#11",))


@query("SELECT 'big' AS preset, count(*) FILTER (WHERE o_totalprice > 100000) AS n FROM orders UNION ALL SELECT 'urgent', count(*) FILTER (WHERE o_orderpriority = '1-URGENT') FROM orders")
def preset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.presets(load(spark, sf_dir, "orders"), {"big": F.col("o_totalprice") > 100000, "urgent": F.col("o_orderpriority") == "1-URGENT"})


@query("SELECT p_partkey, p_name, CASE WHEN lower(p_name) = 'blue' THEN 0 WHEN starts_with(lower(p_name), 'blue') THEN 1 WHEN regexp_matches(lower(p_name), '(^|[^a-z0-9''])blue') THEN 2 WHEN contains(lower(p_name), 'blue') THEN 3 ELSE 4 END AS tier FROM part")
def relevance_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select("p_partkey", "p_name", facets.relevance(F.col("p_name"), "blue").alias("tier"))


@query("SELECT s_suppkey, s_name, nation, CAST(place // 20 AS INTEGER) AS page, place FROM (SELECT s_suppkey, s_name, nullif(s_nationkey, 3) AS nation, row_number() OVER (ORDER BY nullif(s_nationkey, 3) DESC NULLS LAST, s_acctbal ASC NULLS LAST, s_suppkey) - 1 AS place FROM supplier)")
def page_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of twenty; rows of no nation come last."""
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.nullif(F.col("s_nationkey"), F.lit(3)).alias("nation"))
    layout = pages.Layout.write(rows, facets.Sort((("nation", True), ("s_acctbal", False), ("s_suppkey", False))), shared_folder(spark, "pages"))
    return layout.numbered().select("s_suppkey", "s_name", "nation", F.floor(F.col("place") / 20).cast("int").alias("page"), "place")


def _two_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    old = orders.where("o_orderkey % 10 <> 1")
    new = orders.where("o_orderkey % 10 <> 2").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 13 == 0, None).otherwise(F.col("o_orderstatus")))
    return old, new


_SNAP = "WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 1), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 2), "
_DIFF = _SNAP + """d AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'dropped' ELSE 'changed' END AS change, CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'o_orderstatus' END AS field,
 CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN a.o_orderstatus END AS old, CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN b.o_orderstatus END AS new
 FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus) """


@query(_DIFF + "SELECT * FROM d")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.diff(*_two_snapshots(spark, sf_dir), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(_DIFF + "SELECT d.* FROM d WHERE change <> 'added' AND o_orderkey % 3 = 0")
def watched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _two_snapshots(spark, sf_dir)
    watch = load(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    return snapshots.watched(snapshots.diff(old, new, "o_orderkey", ["o_orderstatus", "o_orderpriority"]), watch, "o_orderkey")


_MARKED = "CASE WHEN o_orderkey % 7 = 3 THEN o_orderstatus || o_orderpriority ELSE o_orderstatus END"


@query(_SNAP + f"x AS (SELECT o_orderkey, md5(o_orderstatus) AS h FROM a), y AS (SELECT o_orderkey, md5({_MARKED}) AS h FROM b) SELECT x.o_orderkey, x.h AS old, y.h AS new FROM x JOIN y USING (o_orderkey) WHERE x.h <> y.h")
def changed_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order in seven has another content; where a status is gone, nothing is known."""
    old, new = _two_snapshots(spark, sf_dir)
    return snapshots.changed_hashes(old.withColumn("h", F.md5("o_orderstatus")), new.withColumn("h", F.md5(F.expr(_MARKED))), "o_orderkey", "h")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.pending(load(spark, sf_dir, "orders").select("o_orderkey"), load(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND (o_totalprice > 450000 OR o_orderpriority = '1-URGENT'))")
def retry_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), (F.col("o_totalprice") > 450000).alias("usable"), F.col("o_orderpriority").alias("method"))
    return snapshots.retry(load(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey", "usable", "method", "1-URGENT")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    return snapshots.last_wins(rows, "user_id", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT p_brand, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY p_brand")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.first_per_key(load(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"), "p_brand", "p_partkey")


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 2)")
def latest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.latest(load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day")), "day").select("event_id", F.col("day").cast("string").alias("day"))


def _places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    venues = load(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(40.7) + F.col("s_suppkey") % 37 * 0.003).alias("lat"), (F.lit(-74.0) + F.col("s_suppkey") % 23 * 0.004).alias("lng"))
    stations = load(spark, sf_dir, "nation").select("n_name", (F.lit(40.7) + F.col("n_nationkey") % 5 * 0.02).alias("lat"), (F.lit(-74.0) + F.col("n_nationkey") % 4 * 0.02).alias("lng"), F.array(F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("routes"))
    return venues, stations


_WALK = """WITH v AS (SELECT s_suppkey, 40.7::DOUBLE + s_suppkey % 37 * 0.003::DOUBLE AS lat, -74.0::DOUBLE + s_suppkey % 23 * 0.004::DOUBLE AS lng FROM supplier),
t AS (SELECT n_name, n_regionkey, 40.7::DOUBLE + n_nationkey % 5 * 0.02::DOUBLE AS lat2, -74.0::DOUBLE + n_nationkey % 4 * 0.02::DOUBLE AS lng2 FROM nation),
d AS (SELECT s_suppkey, n_name, n_regionkey, 2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lng2 - lng) / 2), 2))) AS m FROM v, t),
w AS (SELECT *, CAST(round_even(m * 1.3::DOUBLE / 80, 0) AS INTEGER) AS minutes FROM d WHERE round_even(m * 1.3::DOUBLE / 80, 0) <= 12) """


@query(_WALK + "SELECT s_suppkey, n_name, minutes, round(m, 3) AS metres FROM w")
def walkable_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.walkable(*_places(spark, sf_dir)).select("s_suppkey", F.col("r_n_name").alias("n_name"), "minutes", F.round("metres", 3).alias("metres"))


@query(_WALK + "SELECT s_suppkey, arg_min(n_name, (minutes, n_name)) AS nearest, min(minutes) AS minutes FROM w GROUP BY s_suppkey")
def nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest(spatial.walkable(*_places(spark, sf_dir)).withColumnRenamed("r_n_name", "n_name"), "s_suppkey", "n_name")


@query(_WALK + ", r AS (SELECT s_suppkey, 'R' || n_regionkey AS route, min(minutes) AS minutes FROM w GROUP BY ALL) SELECT s_suppkey, string_agg(route || '=' || minutes, ',' ORDER BY route) AS routes FROM r GROUP BY s_suppkey")
def route_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spatial.per_route(spatial.walkable(*_places(spark, sf_dir)), "s_suppkey", "r_routes")
    return found.select("s_suppkey", F.array_join(F.transform(F.map_entries("routes"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("routes"))


RULES = [tagging.TagRule("article", " (the|der) "), tagging.TagRule("article", " (la|le) ", "low"), tagging.TagRule("licence", "(?i)licensed")]


@query(r"""SELECT doc_id, tag, confidence, rule, n FROM (
SELECT doc_id, 'article' AS tag, 'high' AS confidence, 0 AS rule, CAST(len(regexp_extract_all(text, ' (the|der) ')) AS BIGINT) AS n FROM documents UNION ALL
SELECT doc_id, 'article', 'low', 1, CAST(len(regexp_extract_all(text, ' (la|le) ')) AS BIGINT) FROM documents UNION ALL
SELECT doc_id, 'licence', 'high', 2, CAST(len(regexp_extract_all(text, '(?i)licensed')) AS BIGINT) FROM documents) WHERE n > 0""")
def tag_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Spaces and not word boundaries: dialects differ in what a boundary is beyond ASCII.
    return tagging.tag_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", RULES)


@query(r"""WITH r(rule, tag, confidence, p) AS (VALUES (0, 'article', 'high', ' (the|der) '), (1, 'article', 'low', ' (la|le) '), (2, 'licence', 'high', '(?i)licensed')),
h AS (SELECT doc_id, tag, confidence, rule, text, regexp_extract(text, p) AS m FROM documents, r WHERE regexp_matches(text, p)),
b AS (SELECT doc_id, tag, arg_max(confidence, CASE confidence WHEN 'high' THEN 1000 + rule ELSE -rule END) AS confidence, arg_max(m, CASE confidence WHEN 'high' THEN 1000 + rule ELSE -rule END) AS m, any_value(text) AS text FROM h GROUP BY doc_id, tag),
c AS (SELECT *, instr(text, m) AS place, greatest(instr(text, m) - 60, 1) AS a FROM b)
SELECT doc_id, tag, confidence, trim(regexp_replace(substr(text, a, place - a + length(m) + 60), '\s+', ' ', 'g')) AS snippet FROM c""")
def tag_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_items(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", RULES)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
SELECT doc_id, pos, last_value(CASE WHEN length(line) <= 20 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM l""")
def section_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return tagging.with_headers(lines, "doc_id", "pos", "line", F.length("line") <= 20).select("doc_id", F.col("pos").cast("long").alias("pos"), "header")


@query("""WITH h AS (SELECT user_id, event_type AS tag, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS confidence, 'k' || (event_id % 7) AS snippet, event_id FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, tag, lower(snippet) ORDER BY confidence <> 'high', event_id) AS d FROM h)
SELECT user_id, tag, event_id, CAST(pos AS INTEGER) AS pos FROM (SELECT *, row_number() OVER (PARTITION BY user_id, tag ORDER BY confidence <> 'high', length(snippet), event_id) AS pos FROM o WHERE d = 1) WHERE pos <= 3""")
def best_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = load(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("tag"), F.when(F.col("value") > 50, "high").otherwise("low").alias("confidence"), F.concat(F.lit("k"), (F.col("event_id") % 7).cast("string")).alias("snippet"), "event_id")
    return tagging.best_hits(hits, "user_id", 3, "event_id").select("user_id", "tag", "event_id", "pos")


@query(None)
def quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted hit of each tag of each document, within the document's budget."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("raw"))
    hits = tagging.tag_items(docs.select("doc_id", F.col("raw").alias("text")), "text", RULES).select("doc_id", "tag", "confidence", F.lit("raw_text").alias("source"), F.col("snippet").alias("matched"))
    return tagging.quoted(hits, docs, "doc_id", RULES)


def _named(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = load(spark, sf_dir, "part").select("p_partkey", text.match_name(F.concat(F.lit("The "), "p_name")).alias("name"), F.when(F.col("p_size") > 5, F.array(F.col("p_size").cast("string"))).alias("streets"))
    venues_ = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("slug"), "name", "streets", F.col("p_partkey").alias("pos"))
    return part.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("ext"), "name", "streets"), venues_


@query("""WITH p AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name, CASE WHEN p_size > 5 THEN p_size END AS street FROM part),
j AS (SELECT e.p_partkey AS ext, v.p_partkey AS slug, e.street IS NOT NULL AND v.street IS NOT NULL AND e.street = v.street AS met, e.street IS NULL OR v.street IS NULL AS unknown FROM p e JOIN p v USING (name) WHERE e.p_partkey % 2 = 1 AND v.p_partkey % 2 = 0),
a AS (SELECT ext, count(*) AS n, min(slug) FILTER (WHERE met) AS sure, min(slug) AS first, bool_or(unknown) AS unknown FROM j GROUP BY ext)
SELECT ext, coalesce(sure, first) AS slug, CASE WHEN sure IS NOT NULL THEN 1.0::DOUBLE WHEN n = 1 AND unknown THEN 0.9 ELSE 0.5 END AS confidence, CASE WHEN sure IS NOT NULL OR (n = 1 AND unknown) THEN 'matched' ELSE 'review' END AS status FROM a""")
def names_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.by_name(*_named(spark, sf_dir))


@query(None)
def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve(*_named(spark, sf_dir))


@query("""WITH p AS (SELECT p_partkey, p_size, list_distinct(string_split(lower(p_name), ' ')) AS w FROM part), q AS (SELECT p_partkey AS other, p_size AS size2, list_distinct(string_split(lower(p_name), ' ')) AS w2, p_brand FROM part),
c AS (SELECT p_partkey, other, abs(p_size - size2) * 50.0::DOUBLE AS metres, len(list_intersect(w, w2)) AS k, len(w) AS n, len(w2) AS n2, (other - p_partkey) // 25 - 1 AS pos FROM p JOIN q ON other > p_partkey AND other - p_partkey <= 125 AND (other - p_partkey) % 25 = 0),
s AS (SELECT *, CASE WHEN k > 0 AND (k = n OR k = n2) THEN 1.0::DOUBLE ELSE k / (n + n2 - k)::DOUBLE END AS similarity FROM c),
j AS (SELECT *, metres <= 150 OR (metres <= 400 AND similarity >= 0.55) AS accepted FROM s)
SELECT p_partkey, other, round(similarity, 6) AS similarity, accepted FROM j QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY accepted DESC, similarity DESC, pos) = 1""")
def candidate_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size", F.array_distinct(F.split(F.lower("p_name"), " ")).alias("words"))
    parts = tables.parts_of(5 * part.count())
    other = part.toDF("other", "size2", "other_words").repartition(parts, "other")
    pairs = part.withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("other", F.col("p_partkey") + 25 * (F.col("pos") + 1)).repartition(parts, "other").join(other, "other")
    pairs = pairs.withColumn("metres", F.abs(F.col("p_size") - F.col("size2")) * 50.0)
    judged = resolve.judged(pairs).select("p_partkey", "other", "pos", "similarity", "accepted")
    return resolve.best_candidate(judged, "p_partkey", "pos", parts=parts).select("p_partkey", "other", F.round("similarity", 6).alias("similarity"), "accepted")


@query("""WITH v AS (SELECT s_suppkey, DATE '2026-08-03' AS today, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE DATE '2026-08-01' + CAST(s_suppkey % 30 AS INTEGER) END AS closes, s_suppkey % 2 = 0 AS sat, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey % 5 = 0 END AS sun FROM supplier),
d AS (SELECT *, CAST(unnest(generate_series(today, least(coalesce(closes, DATE '2026-08-31'), DATE '2026-08-31'), INTERVAL 1 DAY)) AS DATE) AS day FROM v)
SELECT s_suppkey, CAST(day AS VARCHAR) AS day FROM d WHERE NOT (dayofweek(day) = 6 AND NOT coalesce(sat, false)) AND NOT (dayofweek(day) = 0 AND NOT coalesce(sun, false))""")
def open_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    v = load(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 4 != 0, F.date_add(F.lit("2026-08-01").cast("date"), (k % 30).cast("int"))).alias("closes"), (k % 2 == 0).alias("sat"), F.when(k % 3 != 0, k % 5 == 0).alias("sun"))
    return planning.open_dates(v, "s_suppkey", F.lit("2026-08-03").cast("date"), "closes", "sat", "sun", F.lit("2026-08-31").cast("date")).withColumn("day", F.col("day").cast("string"))


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def booking_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.conflicts(load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").cast("string").alias("day")), "day")


@query("""WITH c AS (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 6), f AS (SELECT p_partkey, 'p_retailprice' AS metric, p_retailprice AS value, true AS more FROM c UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS DOUBLE), false FROM c)
SELECT p_partkey, metric, value, value = CASE WHEN more THEN max(value) OVER w ELSE min(value) OVER w END AND max(value) OVER w > min(value) OVER w AS wins FROM f WINDOW w AS (PARTITION BY metric)""")
def compare_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.compare(load(spark, sf_dir, "part"), "p_partkey", {"p_retailprice": True, "p_size": False}, order=[F.desc("p_retailprice"), F.col("p_partkey")]).select("p_partkey", "metric", "value", "wins")


@query("SELECT user_id, event_id, event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS starts_run, count(*) OVER (PARTITION BY user_id, event_type) AS group_size FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def run_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.with_runs(load(spark, sf_dir, "events"), "user_id", "event_type", [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "starts_run", "group_size")


@query("(SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 30) UNION ALL (SELECT c_custkey, c_acctbal, 'bottom' FROM customer WHERE c_acctbal <= 0 ORDER BY c_acctbal, c_custkey DESC LIMIT 20)")
def top_and_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return planning.top_and_bottom(rows, [F.desc("c_acctbal"), F.col("c_custkey")], [F.col("c_acctbal"), F.desc("c_custkey")], low=F.col("c_acctbal") <= 0)


@query("SELECT l_returnflag, list_sort(list(l_quantity))[count(*) // 2 + 1] AS middle FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_returnflag")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.upper_median(load(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")


_BANDS_OF = "median(l_quantity) FILTER (WHERE l_quantity BETWEEN 1 AND 30) + median(l_quantity) FILTER (WHERE l_quantity BETWEEN 20 AND 45) + coalesce(median(l_quantity) FILTER (WHERE l_quantity BETWEEN 1 AND 15), 14.0)"


@query(f"""WITH l AS (SELECT *, 'all' AS g FROM lineitem UNION ALL SELECT *, l_shipdate::DATE::VARCHAR FROM lineitem), c AS (SELECT g, count(l_quantity) AS n_prices, CAST({_BANDS_OF} AS DOUBLE) AS exact, median(l_extendedprice) AS middle FROM l GROUP BY g)
SELECT g, n_prices, round(exact, 6) AS exact, CAST(round_even(exact, 0) AS BIGINT) AS comparable, round(middle, 6) AS middle FROM c""")
def hot_key_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparables and medians of every day's items and, as one more key, of all items."""
    items = load(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("day"))
    found = pricing.spread_comparables(items, "day", "l_quantity", BANDS, total=True)
    middle = scoring.middles(items, ["day"], "l_extendedprice", total=True)
    both = found.alias("f").join(middle.alias("m"), F.col("f.day").eqNullSafe(F.col("m.day")) & (F.col("f.total") == F.col("m.total")), "left")
    g = F.when(F.col("f.total"), "all").otherwise(F.col("f.day").cast("string"))
    return both.select(g.alias("g"), "n_prices", F.round("exact", 6).alias("exact"), "comparable", F.round("middle", 6).alias("middle"))


@query("SELECT o_orderkey, (SELECT list_reduce(list_prepend(0::BIGINT, [('0x' || substr(h, CAST(i AS INTEGER), 2))::BIGINT FOR i IN range(1, 32, 2)]), lambda a, x: (a * 256 + x) % 7) FROM (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS h)) AS shard FROM orders WHERE o_orderkey IS NOT NULL")
def md5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", numbers.shard(F.col("o_orderkey"), 7).alias("shard"))


@query(r"""WITH t AS (SELECT page_id, html, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gsi'), '<style[^>]*>.*?</style>', ' ', 'gsi'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages)
SELECT page_id, length(text) AS n_chars, md5(text) AS digest, CAST(len(list_distinct(regexp_extract_all(html, 'href=["'']([^"''#]+)["'']', 1, 'i'))) AS BIGINT) AS n_links FROM t""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = text.visible_text(F.col("html"))
    return load(spark, sf_dir, "pages").select("page_id", F.length(body).cast("long").alias("n_chars"), F.md5(body).alias("digest"), F.size(text.links(F.col("html"))).cast("long").alias("n_links"))


@query("SELECT p_partkey, array_to_string(list_filter(regexp_extract_all('a $' || p_size || ' b $ ' || p_partkey % 200 || '.50', '\\$ ?(\\d{1,3}(?:\\.\\d\\d)?)', 1), lambda x: x::DOUBLE BETWEEN 4 AND 120), ',') AS prices FROM part".replace("\\\\", "\\"))
def price_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("a $"), F.col("p_size").cast("string"), F.lit(" b $ "), (F.col("p_partkey") % 200).cast("string"), F.lit(".50"))
    shown = F.transform(text.prices(line), lambda x: F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(F.concat(F.floor(x).cast("string"), F.lit(".50"))))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(shown, ",").alias("prices"))


@query(r"""SELECT p_partkey, trim(regexp_replace(replace(lower(p_name), '''', ''), '[^a-z0-9]+', ' ', 'g')) AS name, regexp_extract(url, '([^/?]+)(\?.*)?$', 1) AS file, upper(left(p_name, 1)) AS initial FROM (SELECT *, 'http://x.example.com/m/' || p_partkey || '.pdf?v=1' AS url FROM part)""")
def names_and_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("http://x.example.com/m/"), F.col("p_partkey").cast("string"), F.lit(".pdf?v=1"))
    return load(spark, sf_dir, "part").select("p_partkey", text.simple_name(F.col("p_name")).alias("name"), text.file_name(url, F.lit("none.pdf")).alias("file"), F.upper(F.left("p_name", F.lit(1))).alias("initial"))


@query(r"""SELECT c_custkey, nullif(array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(regexp_replace(lower(a), '(\d)-(\d)', '\1\2', 'g'), '\b(\d{1,4})\b', 1), lambda x: NOT list_contains(regexp_extract_all(lower(a), '\b(\d+)(?:st|nd|rd|th)\b', 1), x)))), ','), '') AS streets, nullif(regexp_extract(a, '^\s*(\d+)', 1), '') AS house FROM (SELECT c_custkey, c_custkey % 300 || '-0' || c_nationkey % 10 || ' ' || c_custkey % 90 || 'th Ave, 10016' AS a FROM customer)""")
def street_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    a = F.concat((k % 300).cast("string"), F.lit("-0"), (F.col("c_nationkey") % 10).cast("string"), F.lit(" "), (k % 90).cast("string"), F.lit("th Ave, 10016"))
    return load(spark, sf_dir, "customer").select("c_custkey", F.array_join(text.street_numbers(a), ",").alias("streets"), text.house_number(a).alias("house"))


@query("SELECT o_orderkey, greatest(0, date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE))) AS days, try_strptime('1998-0' || (o_orderkey % 10) || '-31', '%Y-%m-%d')::DATE::VARCHAR AS parsed, dayofweek(o_orderdate) + 1 AS weekday FROM orders")
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.lit("1998-0"), (F.col("o_orderkey") % 10).cast("string"), F.lit("-31"))
    return load(spark, sf_dir, "orders").select("o_orderkey", numbers.days_left(F.to_date("o_orderdate"), F.lit("1998-01-01").cast("date")).cast("long").alias("days"), numbers.valid_date(made).cast("string").alias("parsed"), F.dayofweek("o_orderdate").cast("long").alias("weekday"))


@query("SELECT o_orderkey, o_custkey, coalesce(n, 0) AS n_lines, coalesce(quality, 'failed') AS quality FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, CASE WHEN count(*) >= 4 THEN 'full' ELSE 'partial' END AS quality FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def left_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines")).withColumn("quality", F.when(F.col("n_lines") >= 4, "full").otherwise("partial"))
    return tables.left_default(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey", {"n_lines": 0, "quality": "failed"})


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def star_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (load(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return tables.enriched(s, [(n, "s_nationkey", "n_nationkey", ("n_name", "n_regionkey")), (r, "n_regionkey", "r_regionkey", ("r_name",))]).select("s_suppkey", "n_name", "r_name")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_distinct, count(*) FILTER (WHERE value > 50) AS n_big, count(*) FILTER (WHERE value > 99) AS n_huge FROM events GROUP BY event_type")
def grouped_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.counts(load(spark, sf_dir, "events"), ["event_type"], "user_id", {"n_big": F.col("value") > 50, "n_huge": F.col("value") > 99})


@query("SELECT max(ts) AS last, min(ts) AS first FROM events")
def column_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").agg(F.max("ts").alias("last"), F.min("ts").alias("first"))


@query("SELECT event_type, user_id FROM events GROUP BY ALL HAVING NOT bool_or(value > 95)")
def low_only_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.low_only(load(spark, sf_dir, "events"), "event_type", "user_id", F.col("value") > 95)


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY o_custkey")
def arg_max_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct(F.col("o_totalprice"), (-F.col("o_orderkey")).alias("k"))
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", order).alias("o_orderkey"), F.max("o_totalprice").alias("o_totalprice"))


@query("SELECT o_orderpriority AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / greatest(1, (SELECT count(*) FROM orders)), 4) AS share FROM orders GROUP BY 1")
def histogram_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.histogram(load(spark, sf_dir, "orders"), F.col("o_orderpriority")).withColumn("share", F.round("share", 4))


@query("SELECT l_returnflag AS flag, l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_linestatus, l_orderkey FROM lineitem WHERE l_linestatus = 'F'")
def bag_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    pick = lambda c, v: li.where(F.col(c) == v).select(F.col(c).alias("flag"), F.col("l_orderkey").alias("k"))
    return tables.bag_union(pick("l_returnflag", "R"), pick("l_linestatus", "F"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", tables.json_field(F.col("props"), "$.k", "bigint").alias("k"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mesaquery.streaming.changes import windowed_counts

    # Days of the session's time zone: times without a zone are taken to be in it.
    return windowed_counts(load(spark, sf_dir, "events"), "ts", "event_type").select(F.to_date("start").cast("string").alias("day"), "event_type", "n")


def _labels() -> Column:
    k = F.col("o_orderkey")
    kinds = F.element_at(F.array(*map(F.lit, ("Lunch", "Brunch Lunch", "Dinner", "Sunday Dinner Price"))), (k % 4 + 1).cast("int"))
    return F.array(F.concat(F.lit("$"), ((k % 5 + 1) * 10).cast("string"), F.lit(" "), kinds), F.concat(F.lit("$"), ((k % 3 + 1) * 15).cast("string"), F.lit(" Dinner")))


@query("""SELECT o_orderkey, array_to_string(list_transform(list_sort(list_distinct([(o_orderkey % 5 + 1) * 10, (o_orderkey % 3 + 1) * 15])), lambda x: '$' || x), ',') AS tiers,
CASE o_orderkey % 4 WHEN 0 THEN 'dinner,lunch' WHEN 1 THEN 'brunch,dinner' ELSE 'dinner' END AS periods, o_orderkey % 4 = 3 AS sunday FROM orders""")
def offer_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", derive.offer_terms(_labels()).alias("t"))
    return o.select("o_orderkey", F.array_join("t.tiers", ",").alias("tiers"), F.array_join("t.periods", ",").alias("periods"), "t.sunday")


@query("SELECT o_orderkey, try_strptime('2026-' || CASE WHEN o_orderkey % 2 = 0 THEN '09' ELSE '08' END || '-' || (o_orderkey % 31 + 1), '%Y-%m-%d')::DATE::VARCHAR AS closes FROM orders")
def end_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    label = F.concat(F.lit("Week 6 (Aug 3 - "), F.when(k % 2 == 0, "Sept ").otherwise(""), (k % 31 + 1).cast("string"), F.lit(")"))
    return load(spark, sf_dir, "orders").select("o_orderkey", derive.end_of_labels(F.array(F.lit("Week 1 (July 1 - 5)"), label), 2026).cast("string").alias("closes"))


@query("""SELECT c_custkey, CASE WHEN ok THEN lat END AS lat, CASE WHEN ok THEN lng END AS lng, CASE WHEN c_nationkey = 3 THEN 'dropped' WHEN c_nationkey BETWEEN 10 AND 12 THEN 'ranked' WHEN c_acctbal < 0 THEN 'note' WHEN c_acctbal > 5000 THEN 'estimate' ELSE 'none' END AS verdict,
CASE WHEN c_nationkey BETWEEN 10 AND 12 THEN -1 WHEN c_mktsegment = 'BUILDING' THEN 0 WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 2 END AS trust,
CASE WHEN c_nationkey % 4 = 0 THEN 'none' WHEN c_nationkey % 4 = 1 THEN 'image_only' ELSE 'pdf' END AS menu, CASE WHEN c_nationkey = 7 THEN 'https://book/?id=' || c_custkey END AS link
FROM (SELECT *, lat BETWEEN 40.45 AND 41.02 AND lng BETWEEN -74.30 AND -73.65 AS ok FROM (SELECT *, 40.4 + (c_custkey % 70) / 100.0::DOUBLE AS lat, -74.4 + (c_custkey % 90) / 100.0::DOUBLE AS lng FROM customer))""")
def row_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates in the box, verdict, trust, menu state and booking link."""
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    rank = F.when(nation.between(10, 12), nation)
    basis = F.when(F.col("c_mktsegment") == "BUILDING", "verified").when(F.col("c_mktsegment") == "MACHINERY", "estimate")
    at = derive.sane_coordinates(40.4 + (F.col("c_custkey") % 70) / 100.0, -74.4 + (F.col("c_custkey") % 90) / 100.0)
    states = (derive.verdict(nation == 3, rank, balance < 0, balance > 5000).alias("verdict"), derive.trust(rank, basis).cast("int").alias("trust"), derive.menu_state(nation % 4 > 0, F.when(nation % 4 > 1, "text")).alias("menu"))
    link = derive.partner_link(nation.cast("string"), F.col("c_custkey").cast("string"), "7", "https://book/?id=")
    return load(spark, sf_dir, "customer").select("c_custkey", at["lat"].alias("lat"), at["lng"].alias("lng"), *states, link.alias("link"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 5 WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN 9 END AS gap, CASE WHEN o_orderkey % 3 = 0 THEN 'verified' WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN 'estimate' END AS basis, CASE WHEN o_orderkey % 2 = 0 THEN 50 ELSE 30 END AS price FROM orders""")
def gap_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    found = derive.gap_of(F.when(k % 3 == 0, 5), F.lit(9), F.when(k % 5 == 0, 20), k % 7 == 0, F.when(k % 2 == 0, 50), F.array(F.lit("$100"), F.lit("$30")))
    return load(spark, sf_dir, "orders").select("o_orderkey", found["gap"].alias("gap"), found["basis"].alias("basis"), found["price"].alias("price"))


#: Ranked kinds of parts, as a guide's levels are ranked.
DISTINCTIONS = (derive.Distinction("Brand#11", r"promo|standard", "first"), derive.Distinction("Brand#12", None, "second"), derive.Distinction("Brand#11", r"economy", "third"))


@query("""SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' AND regexp_matches(lower(p_type), 'promo|standard') THEN 0 WHEN p_brand = 'Brand#12' THEN 1 WHEN p_brand = 'Brand#11' AND regexp_matches(lower(p_type), 'economy') THEN 2 ELSE 3 END AS rank,
CASE WHEN p_brand = 'Brand#11' AND regexp_matches(lower(p_type), 'promo|standard') THEN 'first' WHEN p_brand = 'Brand#12' THEN 'second' WHEN p_brand = 'Brand#11' AND regexp_matches(lower(p_type), 'economy') THEN 'third' WHEN p_brand = 'Brand#13' THEN 'other' ELSE p_brand END AS label FROM part""")
def distinction_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = derive.distinction(F.col("p_brand"), F.col("p_type"), DISTINCTIONS, {"Brand#13": "other"})
    return load(spark, sf_dir, "part").select("p_partkey", found["rank"].alias("rank"), found["label"].alias("label"))


@query("""SELECT l_suppkey, l_returnflag, string_agg(l_linestatus, ',' ORDER BY seen, l_linestatus) AS awards FROM (SELECT l_suppkey, l_returnflag, l_linestatus, min(l_orderkey) AS seen FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def folded_badges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recognition.badges(load(spark, sf_dir, "lineitem"), "l_suppkey", ["l_returnflag"], "l_linestatus", "l_orderkey")
    return found.select("l_suppkey", "l_returnflag", F.array_join("l_linestatus", ",").alias("awards"))


@query("SELECT o_custkey, o_orderpriority, count(*) AS times, max(year(o_orderdate)) AS latest FROM orders WHERE (o_custkey, o_orderstatus) NOT IN (SELECT c_custkey, 'O' FROM customer WHERE c_acctbal >= 0) GROUP BY ALL")
def unsuppressed_pills(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (F.col("c_acctbal") >= 0).alias("active"))
    rows = recognition.unsuppressed(load(spark, sf_dir, "orders"), out, ["o_custkey", "o_orderstatus"])
    return recognition.pills(rows.withColumn("latest", F.year("o_orderdate").cast("long")), "o_custkey", ["o_orderpriority"], "latest")


@query("SELECT o_orderkey, CASE WHEN p_size > 40 THEN 'verified' ELSE 'low' END AS confidence, CASE WHEN p_size > 40 THEN p_name ELSE o_orderpriority END AS keyword FROM orders LEFT JOIN part ON p_partkey = o_orderkey WHERE p_size IS NULL OR p_size >= 10")
def checked_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = load(spark, sf_dir, "orders").select("o_orderkey", F.lit("low").alias("confidence"), F.col("o_orderpriority").alias("keyword"))
    checks = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("o_orderkey"), F.when(F.col("p_size") < 10, "no").when(F.col("p_size") > 40, "yes").alias("verdict"), F.col("p_name").alias("item"))
    return recognition.checked(hits, checks, ["o_orderkey"])


@query("""WITH v AS (SELECT c_custkey, nullif(c_nationkey, 3) AS n, ' ' || upper(c_mktsegment) AS s FROM customer), t AS (SELECT nullif(s_nationkey, 3) AS n, lower(m) AS s, s_name FROM supplier, (VALUES ('building'), ('machinery')) AS x(m))
SELECT c_custkey, coalesce((SELECT string_agg(DISTINCT s_name, ',' ORDER BY s_name) FROM t WHERE t.n IS NOT DISTINCT FROM v.n AND t.s = lower(trim(v.s))), '') AS suppliers FROM v""")
def composite_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", F.expr("nullif(c_nationkey, 3)").alias("n"), F.concat(F.lit(" "), F.upper("c_mktsegment")).alias("s"))
    known = load(spark, sf_dir, "supplier").select(F.expr("nullif(s_nationkey, 3)").alias("n"), F.explode(F.array(F.lit("building"), F.lit("machinery"))).alias("s"), "s_name")
    return recognition.looked_up(rows, known, ["n"], "s", "s_name").select("c_custkey", F.array_join("s_name", ",").alias("suppliers"))


@query("SELECT row_number() OVER (ORDER BY trust, rank NULLS LAST, gap_usd DESC NULLS LAST, name) AS place, name FROM (SELECT c_name AS name, c_nationkey % 3 AS trust, nullif(c_nationkey, 5) AS rank, nullif(c_custkey % 7, 2) AS gap_usd FROM customer) ORDER BY place LIMIT 50")
def named_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of the sort by trust, rank and gap."""
    rows = load(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), (F.col("c_nationkey") % 3).alias("trust"), F.expr("nullif(c_nationkey, 5)").alias("rank"), F.expr("nullif(c_custkey % 7, 2)").alias("gap_usd"))
    order = facets.named_sorts()["best"]
    page = facets.page_of(rows, order, 0)
    return page.select(F.row_number().over(Window.orderBy(*order.columns())).cast("long").alias("place"), "name")


@query("SELECT count(lat) AS shown, count(*) - count(lat) AS missing, min(lat) AS south, max(lat) AS north, min(lng) AS west, max(lng) AS east FROM (SELECT CASE WHEN c_nationkey <> 4 THEN c_acctbal END AS lat, CASE WHEN c_nationkey <> 4 THEN c_custkey END AS lng FROM customer)")
def map_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = F.col("c_nationkey") != 4
    return facets.bounds(load(spark, sf_dir, "customer").select(F.when(there, F.col("c_acctbal")).alias("lat"), F.when(there, F.col("c_custkey")).alias("lng")))


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '#00000001') ORDER BY c_custkey LIMIT 1")
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").withColumn("slug", F.col("c_custkey").cast("string"))
    return facets.first_match(rows, "slug", "c_name", "c_custkey", "#00000001").select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def items_of_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return tables.items_of(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), orders, "l_orderkey")


@query("SELECT p_partkey, unnest(range(len(w))) AS pos, unnest(w) AS word FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)")
def positions_in_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.with_positions(load(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words")), "words", "word")
    return found.withColumn("pos", F.col("pos").cast("long"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'pin' || o_orderkey END, o_orderpriority) AS o_orderpriority FROM orders")
def pinned_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pinned values go before found ones."""
    found = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    pins = found.where("o_orderkey % 3 = 0").select("o_orderkey", F.concat(F.lit("pin"), F.col("o_orderkey").cast("string")).alias("o_orderpriority"))
    return resolve.overridden(found, pins, "o_orderkey", "o_orderpriority")


@query("SELECT CASE o_orderstatus WHEN 'O' THEN 'table' ELSE 'review' END AS goes_to, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1")
def quarantined_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows go to the table, doubtful ones to review, others nowhere."""
    rows = load(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "O", "matched").when(F.col("o_orderstatus") == "F", "review").alias("status"))
    sure, doubtful = resolve.quarantined(rows)
    return tables.counts(tables.bag_union(sure.select(F.lit("table").alias("goes_to")), doubtful.select(F.lit("review").alias("goes_to"))), ["goes_to"])


@query("""WITH h AS (SELECT user_id, event_type AS tag, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN event_id % 2 = 0 THEN 'item' ELSE 'raw_text' END AS source, 'm' || event_id AS matched FROM events)
SELECT user_id, tag, matched FROM h QUALIFY row_number() OVER (PARTITION BY user_id, tag ORDER BY confidence <> 'high', source <> 'item', length(matched), matched) = 1""")
def representative_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = load(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("tag"), F.when(F.col("value") > 50, "high").otherwise("low").alias("confidence"), F.when(F.col("event_id") % 2 == 0, "item").otherwise("raw_text").alias("source"), F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("matched"))
    return tagging.representative(hits, "user_id").select("user_id", "tag", "matched")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 13 WHEN c_custkey % 4 = 1 THEN least(c_custkey % 13, c_custkey % 7) END AS chosen, c_custkey % 5 AS nearest FROM customer")
def walk_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least minutes over chosen lines, or the nearest station's."""
    k = F.col("c_custkey")
    routes = F.when(k % 4 == 0, F.create_map(F.lit("4"), k % 13)).when(k % 4 == 1, F.create_map(F.lit("4"), k % 13, F.lit("6"), k % 7)).otherwise(F.create_map(F.lit("A"), k % 3))
    return load(spark, sf_dir, "customer").select("c_custkey", facets.walk_key(routes, k % 5, ("4", "6")).alias("chosen"), facets.walk_key(routes, k % 5).alias("nearest"))


@query("""WITH l AS (SELECT c_custkey AS k, ['http://a.com/dining' || repeat('/x', CAST(c_custkey % 3 AS INTEGER)), 'http://a.com/menu/' || c_custkey, 'http://a.com/dinner-' || c_custkey % 10] || CASE WHEN c_custkey % 2 = 0 THEN ['http://a.com/menus'] ELSE [] END || CASE WHEN c_custkey % 7 < 3 THEN ['http://a.com/' || repeat('long', CAST(c_custkey % 4 AS INTEGER)) || '-menu'] ELSE [] END AS u FROM customer),
s AS (SELECT k, unnest(list_distinct(u)) AS u, u AS every FROM l), r AS (SELECT k, u, row_number() OVER (PARTITION BY k ORDER BY contains(u, 'menu') DESC, length(u), list_position(every, u)) AS i FROM s)
SELECT k AS c_custkey, string_agg(u, ' ' ORDER BY i) FILTER (WHERE i <= 4) AS pages, array_to_string(([] || CASE WHEN any_value(k) % 3 > 0 THEN ['http://b.com/menu-' || any_value(k) || '.PDF'] ELSE [] END || ['http://a.com/din.pdf'])[1:1 + CAST(any_value(k) % 3 > 0 AS INTEGER)], ' ') AS files FROM r GROUP BY k""")
def ranked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the page's host that are wanted and not blocked, once each, menus first and short before long; files of any host."""
    k = F.col("c_custkey")
    times = lambda x, n: F.repeat(F.lit(x), n.cast("int"))
    hrefs = F.array(
        F.concat(F.lit("http://a.com/dining"), times("/x", k % 3)),
        F.concat(F.lit("http://a.com/menu/"), k.cast("string"), F.lit("#")),
        F.when(k % 3 > 0, F.concat(F.lit("http://b.com/menu-"), k.cast("string"), F.lit(".PDF"))).otherwise("mailto:menu"),
        F.concat(F.lit("http://a.com/dinner-"), (k % 10).cast("string"), F.lit("##")),
        F.when(k % 2 == 0, "http://a.com/menus").otherwise("http://a.com/menu-jobs"),
        F.when(k % 7 < 3, F.concat(F.lit("http://a.com/"), times("long", k % 4), F.lit("-menu"))).otherwise("http://b.com/menu"),
        F.lit("http://a.com/din.pdf"),
        F.concat(F.lit("http://a.com/menu/"), k.cast("string")),
    )
    found = text.ranked_links(hrefs, F.lit("http://a.com/"), "menu|din", "jobs", "menu", pages=4, files=2)
    return load(spark, sf_dir, "customer").select("c_custkey", F.array_join(found["pages"], " ").alias("pages"), F.array_join(found["files"], " ").alias("files"))


@query(r"SELECT doc_id, md5(lower(strip_accents(replace(replace(text, '’', ''''), '–', '-')))) AS folded, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS cleaned FROM documents")
def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded and cleaned forms of texts in several languages."""
    return load(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"), F.md5(text.clean(F.col("text"))).alias("cleaned"))


_SPAN = """['Mon', 'Tuesday', 'wed.', 'THU', 'fri'][c_custkey % 5 + 1] || [' - ', '–', ' to ', ' through '][c_custkey % 4 + 1] || ['Fri', 'sat.', 'Sunday'][c_custkey % 3 + 1] || [': ', ' ', ':'][c_custkey // 7 % 3 + 1] || (c_custkey % 12 + 1) || [' am', 'AM', ':30 am'][c_custkey // 5 % 3 + 1] || ['-', ' – ', ' to '][c_custkey // 3 % 3 + 1] || (c_custkey // 11 % 12 + 1) || 'pm'"""


def _phrase(k: Column) -> Column:
    """Days and clock times in many forms, by a key."""
    one = lambda n, *xs: F.element_at(F.array(*map(F.lit, xs)), (n % len(xs) + 1).cast("int"))
    part = lambda n: F.floor(k / n)
    days = (one(k, "Mon", "Tuesday", "wed.", "THU", "fri"), one(k, " - ", "–", " to ", " through "), one(k, "Fri", "sat.", "Sunday"), one(part(7), ": ", " ", ":"))
    times = ((k % 12 + 1).cast("string"), one(part(5), " am", "AM", ":30 am"), one(part(3), "-", " – ", " to "), (part(11) % 12 + 1).cast("string"), F.lit("pm"))
    return F.concat(*days, *times)


_ALONE = "'Sun ' || (c_custkey % 11 + 1) || ' am to ' || (c_custkey % 9 + 1) || ':15pm'"


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 100 END AS rank, concat_ws('|', CASE WHEN c_custkey % 6 > 0 THEN {_SPAN} END, CASE WHEN c_custkey % 4 > 1 THEN {_ALONE} END) AS hours,
 CASE c_custkey % 5 WHEN 0 THEN 'Mo ' || c_custkey WHEN 1 THEN 'Tu ' || c_custkey || '|{{"opens":"' || c_custkey || '"}}' WHEN 2 THEN 'first ' || c_custkey WHEN 3 THEN 'Th ' || c_custkey ELSE '' END AS listed FROM customer""")
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of notes; opening hours of texts in many forms, and of JSON-LD as graphs, lists, single nodes and beside broken blocks."""
    k = F.col("c_custkey")
    notes = F.when(k % 3 == 0, "Rank 5").otherwise(F.concat(F.when(k % 2 == 0, "it is ranked No. ").otherwise("RANKED NO."), (k % 100).cast("string"), F.lit(" of 100")))
    spoken = F.concat(F.when(k % 6 > 0, _phrase(k)).otherwise("Mon"), F.lit("</p><b>"), F.when(k % 6 > 0, _phrase(k)).otherwise("9am"), F.lit("</b> "), F.when(k % 4 > 1, F.concat(F.lit("Sun "), (k % 11 + 1).cast("string"), F.lit(" am to "), (k % 9 + 1).cast("string"), F.lit(":15pm"))).otherwise("Sun"))
    block = lambda *x: F.concat(F.lit('<script type="application/ld+json">'), *[F.lit(c) if isinstance(c, str) else c.cast("string") for c in x], F.lit("</script>"))
    data = F.when(k % 5 == 0, block('{"@graph": [{"openingHours": "Mo ', k, '"}]}')).when(k % 5 == 1, block('[{"openingHours": "Tu ', k, '"}, {"x": 1}, {"openingHoursSpecification": {"opens": "', k, '"}}]'))
    data = data.when(k % 5 == 2, block('{"openingHours": "We", "openingHoursSpecification": "first ', k, '"}')).when(k % 5 == 3, F.concat(block("{broken"), block('{"openingHours": "Th ', k, '"}'))).otherwise(block('{"name": "', k, '"}'))
    body = F.concat(data, F.lit("<p>"), spoken)
    return load(spark, sf_dir, "customer").select("c_custkey", text.listed_rank(notes).cast("long").alias("rank"), F.array_join(text.hours_in_text(body), "|").alias("hours"), F.array_join(text.opening_hours(body), "|").alias("listed"))
