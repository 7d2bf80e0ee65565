"""Comparable prices from banded medians, gaps to programme tiers, and their confidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.functions.numbers import half_even
from mesaquery.operators.scoring import middles, or_total


@dataclass(frozen=True)
class Bands:
    """Inclusive price ranges of the three courses; they may overlap. Prices have no dessert: a default."""

    starter: tuple[float, float] = (8, 28)
    main: tuple[float, float] = (22, 70)
    dessert: tuple[float, float] = (6, 20)
    default_dessert: float = 14.0


def comparables(rows: DataFrame, key: str, price: str, bands: Bands = Bands()) -> DataFrame:
    """key, n_prices, exact, comparable: the sum of band medians; null without starters or mains."""
    p = F.col(price)
    middle = lambda band: F.median(F.when(p.between(*band), p))
    exact = middle(bands.starter) + middle(bands.main) + F.coalesce(middle(bands.dessert), F.lit(bands.default_dessert))
    return rows.groupBy(key).agg(F.count(price).alias("n_prices"), exact.alias("exact")).withColumn("comparable", half_even(F.col("exact")).cast("long"))


def spread_comparables(rows: DataFrame, key: str, price: str, bands: Bands = Bands(), total: bool = False) -> DataFrame:
    """``comparables`` where a key may have any number of prices: no task holds all of a key's values.

    With ``total`` there is a row of all keys' prices, with a null key, that a column ``total`` tells apart.
    """
    p = F.col(price)
    named = {"starter": bands.starter, "main": bands.main, "dessert": bands.dessert}
    found = middles(rows, [key], price, within={n: p.between(*band) for n, band in named.items()}, total=total)
    found = found if total else found.withColumn("total", F.lit(False))
    one = lambda n: F.max(F.when(F.col("within") == n, F.col("middle")))
    exact = found.groupBy(F.col(key).alias("_key"), F.col("total").alias("_total")).agg((one("starter") + one("main") + F.coalesce(one("dessert"), F.lit(bands.default_dessert))).alias("exact"))
    counts = or_total(rows.groupBy(key).agg(F.count(price).alias("_n")), [key], total).groupBy(key, "total").agg(F.sum("_n").alias("n_prices"))
    both = counts.join(exact, F.col("_key").eqNullSafe(F.col(key)) & (F.col("_total") == F.col("total")), "left").select(key, *(["total"] if total else []), "n_prices", "exact")
    return both.withColumn("comparable", half_even(F.col("exact")).cast("long"))


def gaps(found: DataFrame, tiers: list[int]) -> DataFrame:
    """Add ``gaps``: tier to the exact comparable less the tier, rounded on its own; null without one."""
    pairs = [x for t in tiers for x in (F.lit(f"${t}"), half_even(F.col("exact") - t).cast("long"))]
    return found.withColumn("gaps", F.when(F.col("exact").isNotNull(), F.create_map(*pairs)))


def largest_gap(found: DataFrame, key: str) -> DataFrame:
    """key, tier, gap, gap_pct of the largest gap; the cheapest tier at ties."""
    each = found.where("gaps IS NOT NULL").select(key, "comparable", F.explode("gaps").alias("tier", "gap"))
    price = F.regexp_extract("tier", r"(\d+)", 1).cast("int")
    best = each.groupBy(key).agg(F.max_by(F.struct("tier", "gap", "comparable"), F.struct(F.col("gap").alias("g"), (-price).alias("p"))).alias("b"))
    return best.select(key, F.col("b.tier").alias("tier"), F.col("b.gap").alias("gap"), half_even(F.col("b.gap") * 100.0 / F.col("b.comparable")).cast("long").alias("gap_pct"))


def confidence(n: Column, pages: Column, failed: Column | None = None) -> Column:
    """high from 12 prices on 2 pages, medium from 6 prices, else low; none after a failure."""
    grade = F.when((n >= 12) & (pages >= 2), "high").when(n >= 6, "medium").otherwise("low")
    return grade if failed is None else F.when(failed, "none").otherwise(grade)
