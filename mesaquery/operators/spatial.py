"""Distance joins: a quadtree turns them into equi-joins, exact distances decide."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.functions.numbers import half_even, haversine_m, walk_minutes
from mesaquery.functions.text import clean, house_number, name_tokens, subset_jaccard

#: Rows of either side that a cell of the tree may hold before it is split.
CELL_ROWS = 4096
#: The coarsest cells are so many radii high, and are halved so often at most: the finest are half a radius high.
COARSEST, HALVINGS = 64, 7
#: Cells that are broadcast; more are shuffled.
BROADCAST_CELLS = 500_000


def cells(left: DataFrame, right: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """y, x, level, l_deals, r_deals: for each finest cell (y, x) that ``left`` has rows in, its leaf of a quadtree.

    Both sides have finest cells (y, x). A cell of over ``cell_rows`` rows of either side is split in
    four, down to the finest; a finest one that still has more deals its rows to several equal parts.
    Only counts of cells are shuffled.
    """
    counted = lambda df, name: df.groupBy("y", "x").agg(F.count("*").alias(name))
    fine = counted(left, "l").join(counted(right, "r"), ["y", "x"], "full_outer").fillna(0, ["l", "r"])
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("y", HALVINGS - k).alias("ly"), F.shiftright("x", HALVINGS - k).alias("lx")) for k in range(HALVINGS + 1)]))
    each = fine.select("y", "x", "l", "r", levels.alias("c")).select("y", "x", "l", "r", "c.*")
    sums = each.groupBy("level", "ly", "lx").agg(F.sum("l").alias("ls"), F.sum("r").alias("rs"))
    small = (F.greatest("ls", "rs") <= cell_rows) | (F.col("level") == HALVINGS)
    # The coarsest small cell above a finest one is its leaf.
    met = each.where("l > 0").join(sums.where(small), ["level", "ly", "lx"])
    leaf = met.groupBy("y", "x").agg(F.min(F.struct("level", "ls", "rs")).alias("f"))
    deals = lambda n: F.greatest(F.lit(1), F.ceil(F.col(f"f.{n}") / cell_rows)).cast("int")
    return leaf.select("y", "x", "f.level", deals("ls").alias("l_deals"), deals("rs").alias("r_deals"))


def within(left: DataFrame, right: DataFrame, metres: float, lat: str = "lat", lng: str = "lng", max_lat: float = 75.0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pairs of rows at most ``metres`` apart, with ``metres``; ``right``'s columns start with r_.

    A quadtree of counted rows makes cells that hold few rows where rows are dense and reach far where
    they aren't. A left row goes to its leaf; a right row goes to each leaf that the box around its
    circle meets, which is one but near borders. Boxes are exact at latitudes up to ``max_lat`` and
    reach across the date line. Rows without coordinates pair with nothing.
    """
    reach = math.degrees(metres / 6_371_000.0) * (1 + 1e-9) + 1e-12
    finest = max(reach * COARSEST / 2**HALVINGS, 1e-9)
    cell = lambda c: F.floor(c / finest).cast("long")
    own = left.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select("*", cell(F.col(lat)).alias("_y"), cell(F.col(lng)).alias("_x"))
    b = right.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    r_lat, r_lng = F.col(f"r_{lat}"), F.col(f"r_{lng}")
    tree = cells(own.select(F.col("_y").alias("y"), F.col("_x").alias("x")), b.select(cell(r_lat).alias("y"), cell(r_lng).alias("x")), cell_rows).persist()
    small = tree.count() <= BROADCAST_CELLS
    few = F.broadcast if small else lambda df: df

    dealt = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at = tree.select(F.col("y").alias("_y"), F.col("x").alias("_x"), F.col("level").alias("_level"), "l_deals", "r_deals")
    a = own.join(few(at), ["_y", "_x"])
    a = a.withColumn("_y", F.expr(f"shiftright(_y, {HALVINGS} - _level)")).withColumn("_x", F.expr(f"shiftright(_x, {HALVINGS} - _level)"))
    a = a.withColumn("_l", dealt("l_deals")).withColumn("_r", every("r_deals")).drop("l_deals", "r_deals")

    leaves = tree.select(F.col("level").alias("_level"), F.expr(f"shiftright(y, {HALVINGS} - level)").alias("_y"), F.expr(f"shiftright(x, {HALVINGS} - level)").alias("_x"), "l_deals", "r_deals").distinct()
    wide = F.lit(reach) / F.cos(F.radians(F.least(F.abs(r_lat) + reach, F.lit(max_lat))))
    shifts = F.filter(F.array(F.lit(0.0), F.lit(360.0), F.lit(-360.0)), lambda d: (d == 0) | (d > 0) & (r_lng - wide < -180) | (d < 0) & (r_lng + wide > 180))
    span = lambda low, high, k: F.sequence(F.shiftright(cell(low), HALVINGS - k), F.shiftright(cell(high), HALVINGS - k))

    def box(k: int, shift: Column) -> Column:
        across = span(r_lng + shift - wide, r_lng + shift + wide, k)
        row = lambda y: F.transform(across, lambda x: F.struct(F.lit(k).alias("_level"), y.alias("_y"), x.alias("_x")))
        return F.flatten(F.transform(span(r_lat - reach, r_lat + reach, k), row))

    boxes = F.flatten(F.transform(shifts, lambda d: F.flatten(F.array(*[box(k, d) for k in range(HALVINGS + 1)]))))
    met = b.withColumn("_c", F.explode(F.array_distinct(boxes))).select(*b.columns, "_c.*").join(few(leaves), ["_level", "_y", "_x"])
    met = met.withColumn("_r", dealt("r_deals")).withColumn("_l", every("l_deals")).drop("l_deals", "r_deals")
    distance = haversine_m(F.col(lat), F.col(lng), r_lat, r_lng)
    keys = ["_level", "_y", "_x", "_l", "_r"]
    return a.join(met, keys).withColumn("metres", distance).where(F.col("metres") <= metres).drop(*keys)


def walkable(venues: DataFrame, stations: DataFrame, minutes: int = 12) -> DataFrame:
    """Pairs whose estimated walk, rounded, takes at most ``minutes``."""
    reach = (minutes + 0.5) * 80.0 / 1.3
    return within(venues, stations, reach).withColumn("minutes", walk_minutes(F.col("metres"))).where(F.col("minutes") <= minutes)


def nearest(pairs: DataFrame, key: str, label: str) -> DataFrame:
    """key, nearest label and minutes: by rounded minutes, then by label."""
    best = pairs.groupBy(key).agg(F.min(F.struct("minutes", label)).alias("b"))
    return best.select(key, F.col(f"b.{label}").alias("nearest"), F.col("b.minutes").alias("minutes"))


def per_route(pairs: DataFrame, key: str, routes: str) -> DataFrame:
    """key and the map of each route to its least minutes."""
    least = pairs.select(key, F.explode(routes).alias("route"), "minutes").groupBy(key, "route").agg(F.min("minutes").alias("minutes"))
    return least.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("route", "minutes")))).alias("routes"))


def licensed(venues: DataFrame, licences: DataFrame, key: str, near_m: float = 80.0, far_m: float = 250.0, least: float = 0.34) -> DataFrame:
    """key, licence (of the best match), its distance, and whether any match has each kind of seating.

    Venues have name_words, house, lat and lng; licences also name, words and legal_words, sidewalk and
    roadway. Within ``near_m`` a similarity of ``least`` matches, or any at all at an equal house
    number; up to ``far_m`` only equal names at one. Best: similarity, plus 0.3 for the house number,
    then the nearest, then the name.
    """
    pairs = within(venues, licences, far_m)
    sim = F.greatest(subset_jaccard(F.col("name_words"), F.col("r_words")), subset_jaccard(F.col("name_words"), F.col("r_legal_words")))
    pairs = pairs.withColumn("sim", F.coalesce(sim, F.lit(0.0))).withColumn("same", F.coalesce(F.col("house") == F.col("r_house"), F.lit(False)))
    near = (F.col("metres") <= near_m) & ((F.col("sim") >= least) | (F.col("same") & (F.col("sim") > 0)))
    good = pairs.where(near | (F.col("same") & (F.col("sim") >= 1)))
    order = F.struct((F.col("sim") + F.when(F.col("same"), 0.3).otherwise(0.0)).alias("s"), (-F.col("metres")).alias("m"), F.col("r_name").alias("n"))
    best = good.groupBy(key).agg(F.max(order).alias("b"), F.bool_or("r_sidewalk").alias("sidewalk"), F.bool_or("r_roadway").alias("roadway"))
    return best.select(key, clean(F.col("b.n")).alias("licence"), half_even(-F.col("b.m")).cast("int").alias("metres"), "sidewalk", "roadway")


def as_licences(rows: DataFrame) -> DataFrame:
    """Licences as ``licensed`` needs them, of (name, legal, street, sidewalk, roadway, lat, lng).

    Names are told by their telling words; one without a name goes by its legal name.
    """
    shown = F.when(F.coalesce(F.col("name"), F.lit("")) != "", F.col("name")).otherwise(F.col("legal"))
    return rows.select(shown.alias("name"), name_tokens(F.coalesce("name", F.lit(""))).alias("words"), name_tokens(F.coalesce("legal", F.lit(""))).alias("legal_words"), house_number(F.col("street")).alias("house"), "sidewalk", "roadway", "lat", "lng")
