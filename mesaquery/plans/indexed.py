"""Queries that are answered from an index or a layout built of the venues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesaquery.functions import text
from mesaquery.operators import derive, facets, pages, tables
from mesaquery.operators.index import Index
from mesaquery.plans.base import query
from mesaquery.plans.venues import _LISTS, _ORDERS, _TRUST, _WITH, catalogue, venues
from mesaquery.sources.shared import shared_folder

#: Texts of one letter, two, three and more; across parts of the haystack; and one that nothing has.
TEXTS = ("CUSTOMER#0000001", "#00", "r", "N0", "01 • C1", "customer#000000100 •", "99", "zzz")
_HAY = "lower(concat_ws(' • ', name, nullif(borough, ''), neighborhood, array_to_string(cuisines, ' ')))"


def _haystack() -> list:
    return [F.col("name"), F.col("borough"), F.col("neighborhood"), F.array_join("cuisines", " ")]


def index_of(spark: SparkSession, sf_dir: str) -> Index:
    return Index.build(venues(spark, sf_dir), "slug", shared_folder(spark, "index"), text.haystack(*_haystack()), F.col("name"), catalogue())


def _tier(t: str) -> str:
    low = t.lower()
    return f"CASE WHEN lower(name) = '{low}' THEN 0 WHEN starts_with(lower(name), '{low}') THEN 1 WHEN len(list_filter(regexp_split_to_array(lower(name), '[^a-z0-9'']+'), lambda w: starts_with(w, '{low}'))) > 0 THEN 2 WHEN contains(lower(name), '{low}') THEN 3 ELSE 4 END"


@query(_WITH + " UNION ALL ".join(f"SELECT '{t}' AS searched, slug, {_tier(t)} AS tier FROM v WHERE contains({_HAY}, '{t.lower()}')" for t in TEXTS))
def searched_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have a text, with their relevance, from postings."""
    index = index_of(spark, sf_dir)
    return tables.bag_union(*[index.hits(t).select(F.lit(t).alias("searched"), "slug", "tier") for t in TEXTS])


#: Selections, with and without a text: several facets, one, none, and a value that no row has.
SPECS = {
    "three": facets.QuerySpec({"meal": ("lunch", "brunch"), "basis": ("verified", "estimate"), "subway": ("4", "6")}),
    "text": facets.QuerySpec({"tier": ("$15", "$45"), "menu": ("pdf",)}, "#00000"),
    "one": facets.QuerySpec({"cuisine": ("C3",)}),
    "none": facets.QuerySpec(),
    "nothing": facets.QuerySpec({"borough": ("Staten Island",)}, "9"),
}


def _counts(name: str, spec: facets.QuerySpec) -> str:
    ok = {f: f"coalesce(list_has_any({_LISTS[f]}, {list(c)}), false)" for f, c in spec.selected.items()}
    has = f"contains({_HAY}, '{spec.text.lower()}')" if spec.text else "true"
    parts = [f"SELECT '{f}' AS facet, unnest(list_distinct({values})) AS value, 1 AS n FROM v WHERE " + " AND ".join([has, *(t for g, t in ok.items() if g != f)]) for f, values in _LISTS.items()]
    parts += [f"SELECT '{f}', '{x}', 0" for f, c in [*spec.selected.items(), ("tag", ("duck",))] for x in c]
    return f"SELECT '{name}' AS selection, facet, value, CAST(sum(n) AS BIGINT) AS n FROM (" + " UNION ALL ".join(parts) + ") WHERE value IS NOT NULL GROUP BY facet, value"


@query(_WITH + " UNION ALL ".join(_counts(n, s) for n, s in SPECS.items()))
def indexed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave-one-out counts of all eighteen facets for five selections, from bitmaps."""
    index = index_of(spark, sf_dir)
    return tables.bag_union(*[index.counts(catalogue(), s).select(F.lit(n).alias("selection"), "facet", "value", "n") for n, s in SPECS.items()])


PAGES = (0, 2, 11)


@query(_WITH + f", w AS (SELECT *, closes AS end_date, {_TRUST} AS trust FROM v), s AS (" + " UNION ALL ".join(f"SELECT '{n}' AS sort, row_number() OVER (ORDER BY {o.replace('1', 'name') if o == '1' else o}, name) - 1 AS place, slug FROM w" for n, o in _ORDERS.items()) + ") SELECT sort, CAST(place // 10 AS INTEGER) AS page, CAST(place AS BIGINT) AS place, slug FROM s WHERE place // 10 IN " + str(PAGES))
def laid_out_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages of ten of each of the fourteen sorts, from layouts."""
    rows = venues(spark, sf_dir).withColumn("end_date", F.col("closes")).withColumn("trust", derive.trust(F.col("rank"), F.col("basis")))
    sorts = facets.named_sorts()
    needed = sorted({c for s in sorts.values() for c, _ in s.keys} | {"slug"})
    made = pages.write_all(rows.select(*needed), sorts, shared_folder(spark, "layouts"))
    return tables.bag_union(*[layout.range(10 * p, 10).select(F.lit(n).alias("sort"), F.lit(p).alias("page"), "place", "slug") for n, layout in made.items() for p in PAGES])
