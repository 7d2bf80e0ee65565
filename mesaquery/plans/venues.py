"""Queries on venues: a programme's rows made of customers, so that each operator meets every state.

``COLUMNS`` states the rows once, in SQL that both engines read; lists are written as ``array(...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesaquery.functions import numbers, text
from mesaquery.operators import derive, display, facets, menus, pages, planning, recognition, scoring, spatial, tables
from mesaquery.plans.base import load, query
from mesaquery.sources import readers
from mesaquery.sources.shared import shared_folder

COLUMNS = {
    "k": "c_custkey",
    "slug": "CAST(c_custkey AS STRING)",
    "name": "c_name",
    "borough": "CASE c_nationkey % 6 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Queens' WHEN 3 THEN 'Bronx' WHEN 4 THEN '' END",
    "neighborhood": "'N' || lpad(CAST(c_nationkey AS STRING), 2, '0')",
    "cuisines": "array('C' || CAST(c_custkey % 7 AS STRING), 'C' || CAST(c_custkey % 20 AS STRING))",
    "tiers": "CASE WHEN c_custkey % 11 > 0 THEN array('$' || CAST((c_custkey % 3 + 1) * 15 AS STRING), '$60') END",
    "meals": "CASE c_custkey % 3 WHEN 0 THEN array('lunch') WHEN 1 THEN array('dinner', 'lunch') END",
    "sunday": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END",
    "rank": "CASE WHEN c_custkey % 50 = 0 THEN CAST(c_custkey / 50 AS BIGINT) END",
    "verdict": "CASE WHEN c_custkey % 50 = 0 THEN 'Ranked pick' WHEN c_custkey % 4 = 0 THEN 'Verified note' WHEN c_custkey % 4 = 1 THEN 'Estimate only' ELSE 'No comparable' END",
    "grade": "CASE c_custkey % 9 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END",
    "basis": "CASE c_custkey % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'estimate' END",
    "gap_usd": "CASE WHEN c_custkey % 4 < 2 THEN c_custkey % 61 - 20 END",
    "gap_high": "CASE WHEN c_custkey % 4 < 2 AND c_custkey % 3 = 0 THEN c_custkey % 61 - 10 END",
    "gap_pct": "CASE WHEN c_custkey % 4 < 2 AND c_custkey % 23 > 0 THEN c_custkey % 83 - 30 END",
    "price": "CASE WHEN c_custkey % 13 > 0 THEN (c_custkey % 4 + 1) * 15 END",
    "closes": "CASE WHEN c_custkey % 6 > 0 THEN CAST('2026-08-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') AS DATE) END",
    "rating": "CASE WHEN c_custkey % 8 > 0 THEN 3e0 + (c_custkey % 21) / 10e0 END",
    "reviews": "CASE WHEN c_custkey % 8 > 0 THEN c_custkey * 37 % 3000 END",
    "rating_weighted": "CASE WHEN c_custkey % 8 > 0 THEN 33e-1 + (c_custkey % 17) / 10e0 END",
    "rubric": "CASE WHEN c_custkey % 17 > 0 THEN (c_custkey * 7 % 997) / 10e0 END",
    "distinctions": "CASE c_custkey % 10 WHEN 0 THEN array('Michelin star', 'James Beard nominee') WHEN 1 THEN array('NYT 100 Best') WHEN 2 THEN array('Michelin Plate') END",
    "recognition_rank": "CASE c_custkey % 10 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 6 END",
    "recognition_year": "CASE WHEN c_custkey % 10 < 3 THEN 2026 - c_custkey % 30 END",
    "eras": "CASE c_custkey % 10 WHEN 0 THEN array('past', 'current', 'past') WHEN 1 THEN array('current') WHEN 2 THEN array('historic') END",
    "tags": "CASE c_custkey % 3 WHEN 0 THEN array('oyster', 'steak') WHEN 1 THEN array('steak') END",
    "lines": "CASE c_custkey % 4 WHEN 0 THEN array('4', 'A') WHEN 1 THEN array('6') WHEN 2 THEN array('A') END",
    "walk": "CASE WHEN c_custkey % 4 < 3 THEN c_custkey % 13 END",
    "offsite": "CASE WHEN c_custkey % 12 = 0 THEN array('seafood tower') END",
    "seating": "CASE c_custkey % 6 WHEN 0 THEN array('licensed', 'sidewalk') WHEN 1 THEN array('licensed', 'roadway', 'sidewalk') WHEN 2 THEN array('described') END",
    "menu": "CASE c_custkey % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'image_only' ELSE 'none' END",
    "flags": "CASE c_custkey % 7 WHEN 0 THEN array('saturday_service') WHEN 1 THEN array('no_sunday_dinner') WHEN 2 THEN array('dropped_in_verification') END",
}
_WITH = "WITH v AS (SELECT " + ", ".join(f"{e.replace('array(', 'list_value(')} AS {n}" for n, e in COLUMNS.items()) + " FROM customer) "
BOOK_BY = "2026-08-12"


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in COLUMNS.items()])


def catalogue() -> list[facets.Facet]:
    """The eighteen facets."""
    one = lambda c: F.array(F.col(c))
    labels = derive.ERAS
    return [
        facets.Facet("borough", F.array(F.nullif(F.col("borough"), F.lit(""))), title="Borough"),
        facets.Facet("neighborhood", one("neighborhood"), title="Neighborhood"),
        facets.Facet("cuisine", F.col("cuisines"), title="Cuisine"),
        facets.Facet("tier", F.col("tiers"), title="Price tier"),
        facets.Facet("meal", F.col("meals"), title="Meal"),
        facets.Facet("sunday", F.array(F.when(F.col("sunday"), "yes").when(~F.col("sunday"), "no")), title="Sunday", labels={"yes": "Serves Sunday", "no": "No Sunday"}),
        facets.Facet("verdict", one("verdict"), title="Verdict"),
        facets.Facet("grade", one("grade"), title="Evidence grade", labels={"A": "A — own menu"}),
        facets.Facet("basis", F.array(F.coalesce("basis", F.lit("none"))), title="Gap basis", labels={"verified": "Verified", "estimate": "Estimate", "none": "No comparable"}),
        facets.Facet("recognition", F.col("distinctions"), title="Recognition"),
        facets.Facet("era", F.col("eras"), title="Award recency", labels=labels, note="Annual guides always count as current."),
        facets.Facet("tag", F.col("tags"), ("duck",), title="Dish tags"),
        facets.Facet("subway", F.map_keys(F.map_from_arrays("lines", F.transform("lines", lambda x: F.length(x)))), title="Subway line"),
        facets.Facet("offsite", F.col("offsite"), title="On their regular menu", note="Found on the venue's own site."),
        facets.Facet("outdoor", F.col("seating"), title="Outdoor seating", labels={"licensed": "Licensed (any)", "sidewalk": "Sidewalk café", "roadway": "Street shed", "described": "Says so on its listing"}),
        facets.Facet("grating", F.array(display.rating_band(F.col("rating_weighted"))), title="Rating"),
        facets.Facet("greviews", F.array(display.review_band(F.col("reviews"))), title="Review volume"),
        facets.Facet("menu", one("menu"), title="Menu PDF", labels={"pdf": "Readable PDF", "image_only": "Image-only PDF", "none": "No menu published"}),
    ]


#: The same facets' values as lists, and which of them the query below chooses.
_BAND = "CASE WHEN rating_weighted >= 4.6 THEN '4.6+' WHEN rating_weighted >= 4.4 THEN '4.4-4.6' WHEN rating_weighted >= 4.2 THEN '4.2-4.4' WHEN rating_weighted >= 4.0 THEN '4.0-4.2' WHEN rating_weighted IS NOT NULL THEN 'under 4.0' END"
_VOLUME = "CASE WHEN reviews >= 2000 THEN '2,000+' WHEN reviews >= 500 THEN '500-2,000' WHEN reviews >= 100 THEN '100-500' WHEN reviews IS NOT NULL THEN 'under 100' END"
_LISTS = {
    "borough": "[nullif(borough, '')]", "neighborhood": "[neighborhood]", "cuisine": "cuisines", "tier": "tiers", "meal": "meals",
    "sunday": "[CASE sunday WHEN true THEN 'yes' WHEN false THEN 'no' END]", "verdict": "[verdict]", "grade": "[grade]", "basis": "[coalesce(basis, 'none')]",
    "recognition": "distinctions", "era": "eras", "tag": "tags", "subway": "lines", "offsite": "offsite", "outdoor": "seating",
    "grating": f"[{_BAND}]", "greviews": f"[{_VOLUME}]", "menu": "[menu]",
}
_CHOSEN = {"meal": ("lunch", "brunch"), "basis": ("verified", "estimate"), "subway": ("4", "6")}
_OK = {f: f"coalesce(list_has_any({_LISTS[f]}, {list(c)}), false)" for f, c in _CHOSEN.items()}


def _counts_sql() -> str:
    parts = []
    for f, values in _LISTS.items():
        others = " AND ".join(ok for g, ok in _OK.items() if g != f)
        parts.append(f"SELECT '{f}' AS facet, unnest(list_distinct({values})) AS value, 1 AS n FROM v WHERE {others}")
    parts += [f"SELECT '{f}', '{x}', 0" for f, c in {**_CHOSEN, "tag": ("duck",)}.items() for x in c]
    return _WITH + ", u AS (" + " UNION ALL ".join(parts) + ") SELECT facet, value, CAST(sum(n) AS BIGINT) AS n FROM u WHERE value IS NOT NULL GROUP BY facet, value"


@query(_counts_sql())
def venue_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet_counts(venues(spark, sf_dir), catalogue(), facets.QuerySpec(_CHOSEN))


@query(f"WITH c AS ({_counts_sql()}), l(facet, value, label) AS (VALUES ('sunday', 'yes', 'Serves Sunday'), ('sunday', 'no', 'No Sunday'), ('menu', 'none', 'No menu published'), ('basis', 'none', 'No comparable'), ('menu', 'pdf', 'Readable PDF'), ('menu', 'image_only', 'Image-only PDF')) SELECT c.facet, c.value, n FROM c LEFT JOIN l USING (facet, value) WHERE c.facet = 'verdict' AND contains(lower(value), 'no ') OR contains(lower(label), 'no ') OR c.facet = 'borough' AND contains(lower(value), 'no ')")
def found_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.found_filters(venue_facets(spark, sf_dir), catalogue(), "NO ")


@query(f"""WITH c AS ({_counts_sql()}), l(facet, value, label) AS (VALUES ('menu', 'none', 'No menu published'), ('menu', 'pdf', 'Readable PDF'), ('menu', 'image_only', 'Image-only PDF'))
SELECT c.facet, c.value, n, CAST(row_number() OVER (PARTITION BY c.facet ORDER BY CASE c.facet WHEN 'tier' THEN CAST(regexp_replace(c.value, '[^0-9]', '', 'g') AS BIGINT) WHEN 'cuisine' THEN -n ELSE 0 END, CASE WHEN c.facet IN ('tier', 'cuisine') THEN c.value ELSE coalesce(label, c.value) END, c.value) AS INTEGER) AS pos
FROM c LEFT JOIN l USING (facet, value) WHERE c.facet IN ('tier', 'cuisine', 'menu', 'meal')""")
def ordered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = venue_facets(spark, sf_dir).where(F.col("facet").isin("tier", "cuisine", "menu", "meal"))
    return facets.value_order(some, catalogue(), ("tier",), ("tag", "neighborhood", "cuisine"))


SPEC = facets.QuerySpec({"meal": ("lunch",)}, "CUSTOMER#00", 3.5, open_on="2026-08-05", closes_by="2026-08-20", saved=True)


@query(_WITH + "SELECT slug FROM v WHERE list_contains(meals, 'lunch') AND contains(lower(name || ' • ' || neighborhood), 'customer#00') AND rating_weighted >= 3.5 AND (closes IS NULL OR closes >= DATE '2026-08-05') AND closes <= DATE '2026-08-20' AND k % 2 = 0")
def venue_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = venues(spark, sf_dir)
    saved = rows.where("k % 2 = 0").select("slug")
    spec = facets.QuerySpec.from_params(SPEC.to_params(), facets.named_sorts(), [f.key for f in catalogue()])
    return facets.matching(rows, catalogue(), spec, text.haystack(F.col("name"), F.col("neighborhood")), F.col("rating_weighted"), F.col("closes"), saved).select("slug")


@query(_WITH + "SELECT slug FROM v WHERE closes IS NULL OR closes >= DATE '2026-08-20'")
def open_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of unknown end stay."""
    return facets.matching(venues(spark, sf_dir), [], facets.QuerySpec(open_on="2026-08-20"), end=F.col("closes")).select("slug")


_ORDERS = {
    "rubric_desc": "rubric DESC NULLS LAST", "google_desc": "rating_weighted DESC NULLS LAST", "google_raw_desc": "rating DESC NULLS LAST, reviews DESC NULLS LAST",
    "distinction": "recognition_rank NULLS LAST, recognition_year DESC NULLS LAST", "best": "trust, rank NULLS LAST, gap_usd DESC NULLS LAST",
    "gap_usd_desc": "gap_usd DESC NULLS LAST", "gap_pct_desc": "gap_pct DESC NULLS LAST", "price_asc": "price NULLS LAST", "price_desc": "price DESC NULLS LAST",
    "end_asc": "end_date NULLS LAST", "end_desc": "end_date DESC NULLS LAST", "walk_asc": "walk NULLS LAST", "name_asc": "1", "rank_asc": "rank NULLS LAST",
}
_TRUST = "CASE WHEN rank IS NOT NULL THEN -1 WHEN basis = 'verified' THEN 0 WHEN basis = 'estimate' THEN 1 ELSE 2 END"


@query(_WITH + f", w AS (SELECT *, closes AS end_date, {_TRUST} AS trust FROM v), s AS (" + " UNION ALL ".join(f"SELECT '{n}' AS sort, row_number() OVER (ORDER BY {o.replace('1', 'name') if o == '1' else o}, name) AS place, slug FROM w" for n, o in _ORDERS.items()) + ") SELECT sort, place, slug FROM s WHERE place <= 50")
def named_sorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each of the fourteen sorts."""
    rows = venues(spark, sf_dir).withColumn("end_date", F.col("closes")).withColumn("trust", derive.trust(F.col("rank"), F.col("basis")))
    pages = []
    for name, sort in facets.named_sorts().items():
        page = facets.page_of(rows, sort, 0)
        pages.append(page.select(F.lit(name).alias("sort"), F.row_number().over(Window.orderBy(*sort.columns())).cast("long").alias("place"), "slug"))
    return tables.bag_union(*pages)


def presets() -> list[facets.Preset]:
    """The eight quick views."""
    q, has = facets.QuerySpec, lambda c, *xs: F.arrays_overlap(F.col(c), F.array(*map(F.lit, xs)))
    michelin, top = ("Michelin star", "Michelin Bib Gourmand", "Michelin Plate"), ("Michelin star", "NYT 100 Best", "James Beard winner")
    return [
        facets.Preset("saved", q(saved=True), F.col("saved")),
        facets.Preset("ranked", q({"verdict": ("Ranked pick",)}, sort="rank_asc"), F.col("rank").isNotNull()),
        facets.Preset("urgent", q(closes_by=BOOK_BY, sort="end_asc"), derive.urgent(F.col("closes"), F.lit(BOOK_BY).cast("date"))),
        facets.Preset("verified", q({"basis": ("verified",)}, sort="gap_usd_desc"), F.col("basis") == "verified"),
        facets.Preset("lex", q({"subway": ("4", "5", "6")}, sort="walk_asc"), has("lines", "4", "5", "6")),
        facets.Preset("sunday", q({"sunday": ("yes",)}), F.col("sunday")),
        facets.Preset("michelin", q({"recognition": michelin}), has("distinctions", *michelin)),
        facets.Preset("toprec", q({"recognition": top}, sort="distinction"), has("distinctions", *top)),
    ]


_PRESETS = {
    "saved": "k % 2 = 0", "ranked": "rank IS NOT NULL", "urgent": f"closes <= DATE '{BOOK_BY}'", "verified": "basis = 'verified'", "lex": "list_has_any(lines, ['4', '5', '6'])",
    "sunday": "sunday", "michelin": "list_has_any(distinctions, ['Michelin star', 'Michelin Bib Gourmand', 'Michelin Plate'])", "toprec": "list_has_any(distinctions, ['Michelin star', 'NYT 100 Best', 'James Beard winner'])",
}


@query(_WITH + " UNION ALL ".join(f"SELECT '{n}' AS preset, count(*) FILTER (WHERE {p}) AS n FROM v" for n, p in _PRESETS.items()))
def quick_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.presets(venues(spark, sf_dir).withColumn("saved", F.col("k") % 2 == 0), {p.key: p.rows for p in presets()})


CONFIG = scoring.RubricConfig({"award": 3, "rating": 2, "lex": 1, "value": 3, "window": 1}, {"Michelin star": 100, "NYT 100 Best": 80}, {"recent": 0.8, "past": 0.5}, 12, 2, 50, 0, 40, 45, {"verified": 1.0, "estimate": 0.5}, 0, 20)
_DUCK_RAMP = "least(greatest(({x} - {a}) / ({b} - {a}) * 100, 0), 100)"
_PARTS = _WITH + f""", r AS (SELECT slug, CASE WHEN rating_weighted IS NULL THEN NULL ELSE 100e0 * (rank() OVER (PARTITION BY rating_weighted IS NULL ORDER BY rating_weighted) - 1) / count(rating_weighted) OVER () END AS rating,
 CASE WHEN distinctions IS NULL THEN 0e0 ELSE (CASE distinctions[1] WHEN 'Michelin star' THEN 100e0 WHEN 'NYT 100 Best' THEN 80e0 ELSE 0e0 END) * (CASE eras[1] WHEN 'recent' THEN 0.8e0 WHEN 'past' THEN 0.5e0 ELSE 1e0 END) END AS award,
 CASE WHEN list_has_any(lines, ['4', '5', '6']) THEN {_DUCK_RAMP.format(x="walk", a="12e0", b="2e0")} ELSE 50e0 END AS lex,
 CASE WHEN gap_pct IS NULL THEN NULL ELSE (CASE basis WHEN 'verified' THEN 1e0 ELSE 0.5e0 END) * {_DUCK_RAMP.format(x="gap_pct", a="0e0", b="40e0")} + (1 - CASE basis WHEN 'verified' THEN 1e0 ELSE 0.5e0 END) * 45 END AS value,
 CASE WHEN closes IS NULL THEN NULL ELSE {_DUCK_RAMP.format(x="greatest(0, closes - DATE '2026-08-03')", a="0e0", b="20e0")} END AS "window" FROM v) """


def _rubric_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.strict_percentile(venues(spark, sf_dir), "rating_weighted", "rating_pct")
    near = F.when(F.arrays_overlap("lines", F.array(*map(F.lit, "456"))), F.col("walk"))
    parts = scoring.rubric_parts(CONFIG, F.try_element_at("distinctions", F.lit(1)), F.try_element_at("eras", F.lit(1)), F.col("rating_pct"), near, F.col("gap_pct"), F.col("basis"), F.col("closes"), F.lit("2026-08-03").cast("date"))
    return rows.select("slug", *[c.alias(n) for n, c in parts.items()])


@query(_PARTS + 'SELECT slug, round(award, 6) AS award, round(rating, 6) AS rating, round(lex, 6) + 0e0 AS lex, round(value, 6) + 0e0 AS value, round("window", 6) + 0e0 AS "window" FROM r')
def rubric_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rubric_parts(spark, sf_dir).select("slug", *[(F.round(c, 6) + 0.0).alias(c) for c in CONFIG.weights])


@query(_PARTS + """, m AS (SELECT coalesce(avg(award), 50) AS a, coalesce(avg(rating), 50) AS b, coalesce(avg(lex), 50) AS c, coalesce(avg(value), 50) AS d, coalesce(avg("window"), 50) AS e FROM r)
SELECT slug, round((coalesce(award, a) * 3 + coalesce(rating, b) * 2 + coalesce(lex, c) + coalesce(value, d) * 3 + coalesce("window", e)) / 10, 4) AS score,
 (3 + CASE WHEN rating IS NULL THEN 0 ELSE 2 END + 1 + CASE WHEN value IS NULL THEN 0 ELSE 3 END + CASE WHEN "window" IS NULL THEN 0 ELSE 1 END) * 10e0 AS completeness,
 concat_ws(',', CASE WHEN rating IS NULL THEN 'rating' END, CASE WHEN value IS NULL THEN 'value' END, CASE WHEN "window" IS NULL THEN 'window' END) AS imputed FROM r, m""")
def venue_rubric(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.rubric(_rubric_parts(spark, sf_dir), dict(CONFIG.weights))
    return found.select("slug", F.round("score", 4).alias("score"), F.round("completeness", 6).alias("completeness"), F.array_join("imputed", ",").alias("imputed"))


@query(_WITH + """SELECT slug, CAST(CASE WHEN k % 7 = 2 THEN closes WHEN k % 4 = 0 THEN DATE '2026-08-30' ELSE closes END AS VARCHAR) AS ends, CASE WHEN k % 7 = 2 THEN 'api_fallback' WHEN k % 4 = 0 THEN CASE WHEN k % 8 = 0 THEN 'phone' ELSE 'printed' END ELSE 'api' END AS ends_by,
 CASE WHEN k % 9 = 0 THEN false ELSE coalesce(sunday, false) END AS sunday, CASE WHEN k % 9 = 0 THEN 'verified' ELSE 'api' END AS sunday_by FROM v""")
def end_and_sunday(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    source = F.when(k % 7 == 2, "api_fallback").when(k % 8 == 0, "phone")
    ends = derive.end_date(F.col("closes"), F.when(k % 4 == 0, F.lit("2026-08-30").cast("date")), source)
    served = derive.sunday(F.col("sunday"), F.when(k % 9 == 0, F.lit(False)))
    return venues(spark, sf_dir).select("slug", ends["date"].cast("string").alias("ends"), ends["source"].alias("ends_by"), served["sunday"].alias("sunday"), served["source"].alias("sunday_by"))


_DAYS = "d AS (SELECT v.*, DATE '2026-08-01' + CAST(i AS INTEGER) AS day FROM v, range(0, 12) AS t(i)), "
_ISSUE = "CASE WHEN day < DATE '2026-08-03' THEN 'past' WHEN day > closes THEN 'closed' WHEN dayofweek(day) = 6 AND NOT coalesce(list_contains(flags, 'saturday_service'), false) THEN 'no saturday' WHEN dayofweek(day) = 0 AND NOT coalesce(sunday, false) THEN 'no sunday' WHEN dayofweek(day) = 0 AND coalesce(list_contains(flags, 'no_sunday_dinner'), false) THEN 'sunday brunch only' END"


def _issue(day: Column) -> Column:
    flag = lambda x: F.coalesce(F.array_contains("flags", x), F.lit(False))
    return planning.date_issue(day, F.lit("2026-08-03").cast("date"), F.col("closes"), flag("saturday_service"), F.col("sunday"), flag("no_sunday_dinner"))


@query(_WITH + ", " + _DAYS + f"i AS (SELECT CAST(day AS VARCHAR) AS day, {_ISSUE} AS issue FROM d) SELECT day, coalesce(issue, '') AS issue, count(*) AS n FROM i GROUP BY ALL")
def date_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = venues(spark, sf_dir).withColumn("day", F.explode(F.sequence(F.lit("2026-08-01").cast("date"), F.lit("2026-08-12").cast("date"))))
    found = days.select(F.col("day").cast("string").alias("day"), F.coalesce(_issue(F.col("day")), F.lit("")).alias("issue"))
    return tables.counts(found, ["day", "issue"])


@query(_WITH + ", b AS (SELECT slug, closes, flags, sunday, CASE WHEN k % 3 > 0 THEN DATE '2026-08-01' + CAST(k % 16 AS INTEGER) END AS day FROM v WHERE k % 2 = 0), " + f"c AS (SELECT slug, closes, CASE WHEN {_ISSUE} IS NULL THEN day END AS day FROM b) SELECT slug, CAST(day AS VARCHAR) AS day, CAST(row_number() OVER (ORDER BY day NULLS LAST, closes NULLS LAST, slug) AS BIGINT) AS place, CASE WHEN day IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY day) END > 1 AS conflict FROM c")
def plan_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All saved venues' bookings in the plan's order: impossible ones lifted, dated first, days booked twice marked."""
    rows = venues(spark, sf_dir)
    k = F.col("k")
    wanted = F.when(k % 3 > 0, F.date_add(F.lit("2026-08-01").cast("date"), (k % 16).cast("int")))
    saved = tables.member_rows(rows, rows.where("k % 2 = 0").select("slug"), "slug").withColumn("day", wanted)
    plan = planning.current_plan(saved, "day", _issue(F.col("day")))
    twice = planning.conflicts(plan, "day").select("day", F.lit(True).alias("conflict"))
    laid = pages.Layout.write(plan.select("slug", "day", "closes"), planning.PLAN_ORDER, shared_folder(spark, "plan"))
    return laid.numbered().join(twice, "day", "left").select("slug", F.col("day").cast("string").alias("day"), (F.col("place") + 1).alias("place"), F.coalesce("conflict", F.lit(False)).alias("conflict"))


_ABS = "CAST(abs({0}) AS VARCHAR)"


@query(_WITH + f"""SELECT slug, CASE WHEN gap_usd IS NULL THEN '—' ELSE concat_ws(' ', CASE WHEN gap_usd < 0 THEN '+' ELSE '' END || '$' || {_ABS.format("gap_usd")} || CASE WHEN gap_high IS NOT NULL AND gap_high <> gap_usd THEN '–' || {_ABS.format("gap_high")} ELSE '' END, CASE WHEN gap_pct IS NOT NULL THEN {_ABS.format("gap_pct")} || '%' || CASE WHEN gap_usd < 0 THEN ' MORE' ELSE ' off' END END) END AS gap,
 CASE WHEN k < 1000 THEN '$' || k WHEN k < 1000000 THEN '$' || CAST(floor(k / 1000) AS BIGINT) || ',' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END AS money, CASE WHEN closes IS NOT NULL THEN 'Aug ' || day(closes) END AS ends,
 CASE WHEN seating IS NULL THEN 'Not established' WHEN list_contains(seating, 'licensed') THEN 'Yes — licensed ' || CASE WHEN list_contains(seating, 'roadway') THEN 'sidewalk café + street shed' ELSE 'sidewalk café' END || ' (city register)' ELSE 'Mentioned on its listing — not in the city register (which covers only pavement and roadway)' END AS outdoor,
 CASE WHEN closes <= DATE '{BOOK_BY}' THEN 'urgent' WHEN basis IS NOT NULL THEN basis ELSE 'none' END AS marker, coalesce(closes <= DATE '{BOOK_BY}', false) AS urgent FROM v""")
def shown_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by, has = F.lit(BOOK_BY).cast("date"), lambda x: F.array_contains("seating", x)
    seating = F.when(F.col("seating").isNotNull(), F.struct(has("sidewalk").alias("sidewalk"), has("roadway").alias("roadway"), has("licensed").alias("licensed"), has("described").alias("described")))
    texts = (display.gap_text(F.col("gap_usd"), F.col("gap_high"), F.col("gap_pct"), F.lit(None).cast("long")).alias("gap"), display.money(F.col("k")).alias("money"), display.short_date(F.col("closes")).alias("ends"), display.outdoor_text(seating).alias("outdoor"))
    return venues(spark, sf_dir).select("slug", *texts, display.marker(F.col("closes"), by, F.col("basis")).alias("marker"), derive.urgent(F.col("closes"), by).alias("urgent"))


@query(_WITH + "SELECT slug, rating, CASE WHEN rating IS NOT NULL THEN k * 37 % 3000 END AS reviews, CASE WHEN rating IS NOT NULL THEN k % 5 = 3 END AS closed FROM (SELECT slug, k, CASE WHEN k % 3 > 0 THEN round(rating, 2) END AS rating FROM v) WHERE rating IS NOT NULL")
def rated_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rated matches, flat."""
    k = F.col("k")
    matched = F.struct(F.col("rating"), F.col("reviews").alias("user_ratings_total"), F.when(k % 5 == 3, "CLOSED_PERMANENTLY").when(k % 5 == 2, "OPERATIONAL").alias("business_status"), F.col("slug").alias("place_id"), F.col("name"))
    found = venues(spark, sf_dir).select("slug", derive.rated(matched, k % 3 > 0).alias("g")).where("g IS NOT NULL")
    return found.select("slug", "g.rating", "g.reviews", "g.closed")


@query(_WITH + "SELECT slug, coalesce(k % 6 = 0, false) AS sidewalk, k % 6 = 0 AS licensed, k % 4 = 1 AS described FROM v WHERE k % 6 = 0 OR k % 4 = 1")
def outdoor_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    made = derive.outdoor(F.when(k % 6 == 0, F.lit(True)), F.lit(None).cast("boolean"), F.when(k % 6 == 0, F.lit("x")), F.when(k % 4 == 1, "a Roof Deck and more").when(k % 4 == 2, "indoors"))
    return venues(spark, sf_dir).select("slug", made.alias("o")).where("o IS NOT NULL").select("slug", "o.sidewalk", "o.licensed", "o.described")


@query(_WITH + """SELECT slug, CASE k % 3 WHEN 0 THEN 'The Plate' WHEN 1 THEN 'semi finalist' ELSE 'Bib Gourmand' END AS level, CASE eras[1] WHEN 'current' THEN 'This year or last' WHEN 'past' THEN 'Past decade' WHEN 'historic' THEN 'Over 15 years ago' END AS era,
 array_to_string(list_filter(['current', 'recent', 'past', 'historic'], lambda x: list_contains(eras, x)), ',') AS eras, CASE WHEN k % 3 = 1 THEN CASE WHEN 2026 - (2026 - k % 30) <= 1 THEN 'current' WHEN k % 30 <= 5 THEN 'recent' WHEN k % 30 <= 15 THEN 'past' ELSE 'historic' END ELSE 'current' END AS aged,
 CASE WHEN k % 3 = 1 THEN 'James Beard nominee ’' || substr(CAST(2026 - k % 30 AS VARCHAR), 3) ELSE 'James Beard nominee' END || CASE WHEN k % 4 > 1 THEN ' ×' || k % 4 ELSE '' END AS pill FROM v""")
def distinction_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    level = F.when(k % 3 == 0, "recommended").when(k % 3 == 1, "semi_finalist").otherwise("bib_gourmand")
    source, year = F.when(k % 3 == 1, "james_beard").otherwise("michelin"), F.lit(2026) - k % 30
    eras = F.array_join(F.coalesce(tables.by_rank(F.col("eras"), list(derive.ERAS)), F.array().cast("array<string>")), ",")
    return venues(spark, sf_dir).select("slug", derive.level_label(level).alias("level"), derive.labelled(F.try_element_at("eras", F.lit(1)), derive.ERAS).alias("era"), eras.alias("eras"), derive.era_of(source, year, 2026).alias("aged"), display.pill_text(F.lit("James Beard nominee"), source, year, k % 4).alias("pill"))


@query(_WITH + "SELECT preset AS line, n, round(n * 100e0 / greatest(1, (SELECT count(*) FROM v)), 4) AS share FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS preset, count(*) FILTER (WHERE {p}) AS n FROM v" for n, p in list(_PRESETS.items())[1:]) + ")")
def programme_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = display.report(venues(spark, sf_dir), {p.key: p.rows for p in presets()[1:]})
    return found.select("line", "n", F.round("share", 4).alias("share"))


@query(_WITH + f"SELECT 'all' AS tile, count(*) AS n FROM v UNION ALL SELECT 'soon', count(*) FILTER (WHERE closes <= DATE '{BOOK_BY}') FROM v UNION ALL SELECT 'stars', count(*) FILTER (WHERE list_contains(distinctions, 'Michelin star')) FROM v UNION ALL SELECT 'verified', count(*) FILTER (WHERE basis = 'verified') FROM v")
def stat_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = F.lit(BOOK_BY).cast("date")
    return tables.tiles(venues(spark, sf_dir), {"soon": derive.urgent(F.col("closes"), by), "stars": F.array_contains("distinctions", "Michelin star"), "verified": F.col("basis") == "verified"})


@query(_WITH + "SELECT value, n FROM (SELECT unnest(cuisines) AS value, count(*) AS n FROM v GROUP BY 1) ORDER BY n DESC, value LIMIT 8")
def top_cuisines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.top_values(venues(spark, sf_dir), F.col("cuisines"))


@query(_WITH + "SELECT borough AS value, count(*) AS n FROM v WHERE borough <> '' GROUP BY 1 UNION ALL SELECT CAST(closes AS VARCHAR), count(*) FROM v WHERE closes IS NOT NULL GROUP BY 1")
def venue_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = venues(spark, sf_dir)
    return tables.bag_union(tables.histogram(rows, F.col("borough"), shares=False), tables.histogram(rows, F.col("closes").cast("string"), shares=False))


@query(_WITH + "SELECT slug, tiers[1] AS tier, k % 100 AS gap FROM v WHERE k % 3 > 0 AND k % 7 > 0 AND tiers IS NOT NULL")
def usable_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates of some confidence with a comparable and gaps."""
    k = F.col("k")
    rows = venues(spark, sf_dir).select("slug", F.when(k % 3 == 0, F.when(k % 2 == 0, "low")).otherwise("medium").alias("confidence"), F.when(k % 7 > 0, k).alias("comparable"), F.when(F.col("tiers").isNotNull(), F.create_map(F.col("tiers")[0], k % 100)).alias("gaps"))
    return derive.usable(rows, "confidence", "comparable", "gaps").select("slug", F.explode("gaps").alias("tier", "gap"))


@query(_WITH + ", r AS (SELECT slug, unnest(distinctions) AS tier, unnest(range(1, len(distinctions) + 1)) AS i FROM v) SELECT v.slug, coalesce((SELECT string_agg(tier, '|' ORDER BY i) FROM r WHERE r.slug = v.slug), '') AS tiers, len(coalesce(tags, [])) AS n_tags, true AS keeps_null FROM v")
def nested_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues with their distinctions as nested arrays, as JSON, and what a reader finds in it."""
    rows = venues(spark, sf_dir)
    badges = rows.select("slug", F.posexplode("distinctions").alias("at", "tier"))
    tags = rows.select("slug", F.explode("tags").alias("tag"))
    made = tables.nested(rows.select("slug", "name", F.lit(None).cast("string").alias("note")), "slug", {"badges": (badges, ["at"], ["tier", "at"]), "tags": (tags, ["tag"], ["tag"])})
    read = tables.payload(made, "slug").select("slug", "document", F.from_json("document", "badges array<struct<tier:string,at:int>>, tags array<struct<tag:string>>").alias("d"))
    return read.select("slug", F.array_join("d.badges.tier", "|").alias("tiers"), F.size("d.tags").cast("long").alias("n_tags"), F.contains("document", F.lit('"note":null')).alias("keeps_null"))


@query(_WITH + ", r AS (SELECT slug, k, unnest(range(0, 3)) AS i FROM v WHERE k % 10 < 3), b AS (SELECT slug, CAST((k + i) % 2 AS INTEGER) AS rank, CASE (k + i) % 3 WHEN 0 THEN 'past' WHEN 1 THEN 'current' END AS era, 2020 + (k * i) % 5 AS year, CAST(i AS BIGINT) AS i FROM r) SELECT slug, i, CAST(row_number() OVER (PARTITION BY slug ORDER BY rank, CASE era WHEN 'current' THEN 0 WHEN 'past' THEN 2 ELSE 4 END, year DESC, i) AS INTEGER) AS place FROM b")
def badge_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, k = F.col("i"), F.col("k")
    rows = venues(spark, sf_dir).where("k % 10 < 3").select("slug", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("i"))
    made = rows.select("slug", ((k + i) % 2).cast("int").alias("rank"), F.when((k + i) % 3 == 0, "past").when((k + i) % 3 == 1, "current").alias("era"), (2020 + (k * i) % 5).alias("year"), "i")
    return recognition.ranked_badges(made, "slug", "rank", "era", "year", list(derive.ERAS)).select("slug", "i", "place")


@query(_WITH + "SELECT slug, CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS position, (row_number() OVER (ORDER BY k) - 1) % 4 = 1 AS own FROM v")
def position_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = scoring.positions(venues(spark, sf_dir).select("k", "slug"), "k")
    return placed.select("slug", "position", (F.col("position") % 4 == 1).alias("own"))


@query(_WITH + "SELECT slug FROM v WHERE borough IS NOT NULL AND borough <> '' AND slug NOT IN ('7', '12') AND grade IS NOT NULL")
def listed_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = venues(spark, sf_dir)
    return tables.excluded(rows.where(tables.present("borough", "grade")), "slug", ["7", "12"]).select("slug")


@query("SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY o_custkey")
def scalar_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.one_per_key(load(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"])


def _menu(i: Column) -> Column:
    """A menu's text of a part: two sections, noise, a long line, supplements and descriptions."""
    t = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    lines = [t("Welcome to lunch with us"), t("STARTERS:"), t("  ", F.col("p_name"), " — with ", F.col("p_type"), " "), t("Soup  -  of the day + $", i.cast("string")), t("12"), t("Tax not included"), t("Add-ons"), t(F.repeat(F.lit("long "), F.lit(30))), t("Cake: chocolate: dark"), t(F.when(i % 2 == 0, "X").otherwise("Pie, supplement $3.50")), t("Fish"), t("Ham")]
    return F.array_join(F.array(*lines), "\n")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts dealt to tasks, as each one's menu is many lines."""
    part = load(spark, sf_dir, "part")
    return part.repartition(tables.parts_of(part.count(), 10_000), "p_partkey")


@query("""WITH d AS (SELECT p_partkey, 2 AS pos, 'Starters' AS section, trim(p_name) AS dish, 'with ' || p_type AS description, NULL::DOUBLE AS supplement_price FROM part
UNION ALL SELECT p_partkey, 3, 'Starters', 'Soup', 'of the day + $' || p_partkey, CAST(substr(CAST(p_partkey AS VARCHAR), 1, 3) AS DOUBLE) FROM part
UNION ALL SELECT p_partkey, 8, 'Add-Ons', 'Cake', 'chocolate: dark', NULL FROM part UNION ALL SELECT p_partkey, 9, 'Add-Ons', 'Pie, supplement $3.50', NULL, 3.5 FROM part WHERE p_partkey % 2 = 1
UNION ALL SELECT p_partkey, 10, 'Add-Ons', 'Fish', NULL, NULL FROM part UNION ALL SELECT p_partkey, 11, 'Add-Ons', 'Ham', NULL, NULL FROM part) SELECT * FROM d""")
def menu_dishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _parts(spark, sf_dir).select("p_partkey", _menu(F.col("p_partkey")).alias("text"), "p_name", "p_type")
    return menus.dishes(menus.menu_lines(docs, "p_partkey", "text"), "p_partkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 2 END AS n_sections, CASE WHEN p_partkey % 5 = 0 THEN 0 WHEN p_partkey % 2 = 1 THEN 6 ELSE 5 END AS n_items, CASE WHEN p_partkey % 5 = 0 THEN 'failed' ELSE 'full' END AS grade FROM part")
def menu_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _parts(spark, sf_dir).select("p_partkey", F.when(F.col("p_partkey") % 5 != 0, _menu(F.col("p_partkey"))).alias("text"))
    return menus.graded(docs, "p_partkey", "text").withColumns({c: F.col(c).cast("int") for c in ("n_sections", "n_items")})


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_partkey || ' Main St' END AS address, 40 + p_size / 100e0 AS lat, -(70 + p_size / 100e0) AS lng, CASE WHEN p_partkey % 2 = 0 THEN '212-555' END AS phone FROM part")
def embedded_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    at = F.format_string("directionHref x Current+Location/%.2f,-%.2f more", 40 + size / 100.0, 70 + size / 100.0)
    html = F.concat(F.when(k % 3 > 0, F.concat(F.lit('a \\"address\\":\\"'), k.cast("string"), F.lit(' Main St\\" b '))).otherwise(""), at, F.when(k % 2 == 0, '\\"phone\\":\\"212-555\\"').otherwise(""))
    return load(spark, sf_dir, "part").select("p_partkey", text.embedded_fields(html).alias("f")).select("p_partkey", "f.*")


@query("SELECT p_partkey, array_to_string(list_filter([p_size, p_partkey % 200, p_size + 60, p_size + 60], lambda x: x BETWEEN 4 AND 120), ',') AS prices, array_to_string(list_filter([p_size, p_partkey % 200], lambda x: x BETWEEN 4 AND 120) || list_filter([7, p_size], lambda x: x BETWEEN 4 AND 120), ',') AS together FROM part")
def whole_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = (F.col(c).cast("string") for c in ("p_partkey", "p_size"))
    page = F.concat(F.lit("a $"), size, F.lit(" b $ "), (F.col("p_partkey") % 200).cast("string"), F.lit(".50, not $1234"))
    data = F.concat(page, F.lit(' {"price": "$'), (F.col("p_size") + 60).cast("string"), F.lit('.00"}'))
    both = text.all_prices(F.array(page, F.concat(F.lit("$7 and $"), size)))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(text.whole_prices(data, structured=True), ",").alias("prices"), F.array_join(both, ",").alias("together"))


@query(r"""WITH h AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root, regexp_extract_all(html, 'href="([^"''#]+)"', 1, 'i') AS hrefs FROM pages),
l AS (SELECT page_id, root, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS i FROM h), f AS (SELECT page_id, root, href, min(i) AS i FROM l WHERE regexp_matches(href, 'an|de') GROUP BY ALL),
p AS (SELECT page_id, list(root || href ORDER BY i)[1:3] AS pages FROM f GROUP BY page_id)
SELECT page_id, array_to_string(coalesce(pages, []), ' ') AS pages, len(coalesce(pages, [])) + 10 >= 8 AS guessed FROM h LEFT JOIN p USING (page_id)""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.page_links(load(spark, sf_dir, "pages"), "html", "url", "an|de")
    return found.select("page_id", F.array_join("pages", " ").alias("pages"), (F.size(text.guessed_links(F.col("pages"), F.col("url"))) == 8).alias("guessed"))


@query("""SELECT p_partkey, array_to_string(list_filter(list_transform(range(len(w)), lambda i: CASE WHEN NOT list_contains(w[1:i], w[i + 1]) THEN w[i + 1] END), lambda x: x IS NOT NULL AND len(x) > 1 AND x NOT IN ('new', 'york', 'the', 'of', 'bar')), ' ') AS tokens, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name, array_to_string(w, ' ') || ' group' AS words,
array_to_string(list_transform(w, lambda x: upper(x[1]) || lower(x[2:])), ' ') || '-Group' AS title FROM (SELECT p_partkey, p_name, string_split(lower(p_name), ' ') AS w FROM part)""")
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telling words, match name, search words and title case of a name with words around it."""
    name = F.col("p_name")
    around = F.concat(F.lit("The "), name, F.lit(" Restaurant, New York City"))
    firm = F.concat(F.lit("The "), name, F.lit(" Group, LLC"))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(text.name_tokens(firm), " ").alias("tokens"), text.match_name(around).alias("name"), F.array_join(text.search_words(F.lower(F.concat(name, F.lit(" • group")))), " ").alias("words"), text.title_case(F.concat(F.upper(name), F.lit("-GROUP"))).alias("title"))


@query("SELECT DISTINCT c_name AS name, upper(c_name) AS legal, c_custkey || ' Main St' AS street, c_custkey % 3 < 2 AS sidewalk, c_custkey % 3 = 1 AS roadway, round(40.7e0 + c_custkey / 1e5, 6) AS lat, -74e0 AS lng FROM customer WHERE c_custkey % 4 > 0 AND c_custkey % 5 > 0")
def valid_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = load(spark, sf_dir, "customer").select(
        F.when(k % 4 > 0, " Issued ").otherwise("revoked").alias("license_status"),
        F.when(k % 3 == 0, "Sidewalk").when(k % 3 == 1, "Sidewalk and Roadway").otherwise("Other").alias("license_type"),
        F.col("c_name").alias("assumed_name_s"),
        F.upper("c_name").alias("business_legal_name"),
        F.concat(F.lit(" "), k.cast("string"), F.lit(" Main St")).alias("street"),
        F.lit("Queens").alias("borough"),
        F.lit("11101").alias("postcode"),
        F.when(k % 5 > 0, (40.7 + k / 1e5).cast("string")).otherwise("n/a").alias("latitude"),
        F.lit("-74.0").alias("longitude"),
    )
    return readers.valid_licences(raw).select("name", "legal", "street", "sidewalk", "roadway", "lat", "lng")


@query("SELECT 'S' || s_nationkey AS name, string_agg(DISTINCT 'x', '') || '' AS mark, CASE s_nationkey % 2 WHEN 0 THEN '4,6X' ELSE 'N' END AS routes, min(s_suppkey) / 1e3 AS lat FROM supplier WHERE s_nationkey % 3 > 0 AND s_suppkey % 7 > 0 GROUP BY s_nationkey")
def valid_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    raw = load(spark, sf_dir, "supplier").select(k.alias("at"), F.concat(F.lit(" S"), n.cast("string")).alias("stop_name"), F.when(k % 7 > 0, (k / 1000.0).cast("string")).alias("gtfs_latitude"), F.lit("-74").alias("gtfs_longitude"), F.when(n % 3 == 0, "-").when(n % 2 == 0, "6X 4  - 4").otherwise("N").alias("daytime_routes"), F.lit("Q").alias("borough"))
    return readers.valid_stations(raw, "at").select("name", F.lit("x").alias("mark"), F.array_join("routes", ",").alias("routes"), "lat")


#: How far a licence lies from its venue in degrees, by the key; 0, 56, 150 and 334 metres.
_APART = (0.0, 0.0005, 0.00135, 0.003)


@query("""WITH s AS (SELECT s_suppkey, s_name, [0e0, 0.0005e0, 0.00135e0, 0.003e0][s_suppkey % 4 + 1] * pi() / 180 * 6371000 AS metres, CASE WHEN s_suppkey % 3 = 1 THEN 0.25 ELSE 1 END AS sim, s_suppkey % 5 > 0 AS same FROM supplier)
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 1 THEN 'Supplier other words' ELSE s_name END AS licence, CAST(round_even(metres, 0) AS INTEGER) AS metres, s_suppkey % 2 = 0 AS sidewalk, s_suppkey % 7 = 0 AS roadway FROM s WHERE metres <= 80 AND (sim >= 0.34 OR same) OR metres <= 250 AND same AND sim = 1""")
def registered_outdoor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences at several distances, of equal and of similar names, at the same house number and at another; trade names are missing."""
    k = F.col("s_suppkey")
    south, west = 40.0 + k % 100 * 0.01, -74.0 + F.floor(k / 100) * 0.01
    places = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", south.alias("lat"), west.alias("lng"))
    own = places.select("s_suppkey", text.name_tokens(F.concat(F.lit("The "), "s_name")).alias("name_words"), text.house_number(F.concat(k.cast("string"), F.lit(" A St"))).alias("house"), "lat", "lng")
    apart = F.element_at(F.array(*map(F.lit, _APART)), (k % 4 + 1).cast("int"))
    legal = F.when(k % 3 == 1, F.lit("Supplier \u0007other  words")).otherwise(F.col("s_name"))
    street = F.concat(F.when(k % 5 > 0, k).otherwise(k + 1).cast("string"), F.lit(" A Street"))
    held = spatial.as_licences(places.select(F.lit("").alias("name"), legal.alias("legal"), street.alias("street"), (k % 2 == 0).alias("sidewalk"), (k % 7 == 0).alias("roadway"), (F.col("lat") + apart).alias("lat"), "lng"))
    return spatial.licensed(own, held, "s_suppkey").select("s_suppkey", "licence", "metres", "sidewalk", "roadway")


_MONTHS = ("July", "Aug.", "August", "Sept.", "October", "nov", "Dec", "Mai")


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 8 AS f, (o_orderkey // 3) % 8 AS t, o_orderkey % 31 + 1 AS d, o_orderkey % 4 AS form FROM orders),
m AS (SELECT *, [7, 8, 8, 9, 10, 11, 12, NULL][CASE WHEN form = 0 THEN f ELSE t END + 1] AS month FROM k)
SELECT o_orderkey, CASE WHEN form < 3 AND month IS NOT NULL THEN CAST(try_cast('2026-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS VARCHAR) END AS ends FROM m""")
def week_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full and short names of months, any dash, no month at the end, days and months that aren't, and labels that aren't of a week."""
    k = F.col("o_orderkey")
    month = lambda n: F.element_at(F.array(*map(F.lit, _MONTHS)), (n % 8 + 1).cast("int"))
    first, last, day = month(k), month(F.expr("o_orderkey div 3")), (k % 31 + 1).cast("string")
    head = F.concat(F.lit("Week "), (k % 12).cast("string"), F.lit(" ("), first, F.lit(" 1 "))
    label = F.when(k % 4 == 0, F.concat(head, F.lit("- "), day, F.lit(")"))).when(k % 4 == 1, F.concat(head, F.lit("— "), last, F.lit(" "), day, F.lit(")")))
    label = label.when(k % 4 == 2, F.concat(head, F.lit("− "), last, day, F.lit(" )"))).otherwise(F.concat(first, F.lit(" 1 - "), last, F.lit(" "), day))
    return load(spark, sf_dir, "orders").select("o_orderkey", derive.end_of_labels(F.array(F.lit("Week 1 (Aug 1 - 2)"), label), 2026).cast("string").alias("ends"))


@query("SELECT c_custkey, CAST(greatest(0, c_custkey % 40 - 14) AS INTEGER) AS days FROM customer")
def shown_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are left until a date, none once it has passed."""
    ends = F.date_add(F.lit("2026-08-01").cast("date"), (F.col("c_custkey") % 40).cast("int"))
    return load(spark, sf_dir, "customer").select("c_custkey", numbers.days_left(ends, F.lit("2026-08-15").cast("date")).alias("days"))
