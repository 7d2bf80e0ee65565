"""Distinctions of venues: suppression, folding, headlines, and checks that override findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.operators.tables import parts_of


def unsuppressed(rows: DataFrame, suppressed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose exact keys no active suppression names; a suppression is active unless it says no."""
    active = suppressed.where(F.coalesce("active", F.lit(True))).select(*keys).distinct()
    return rows.join(active, keys, "left_anti")


def badges(rows: DataFrame, key: str, group: list[str], awards: str, position: str) -> DataFrame:
    """One row for each key and group, with the distinct awards of its rows in order of first mention."""
    firsts = rows.groupBy(key, *group, awards).agg(F.min(position).alias("_at"))
    folded = F.array_sort(F.collect_list(F.when(F.col(awards).isNotNull(), F.struct("_at", F.col(awards).alias("a")))))
    return firsts.groupBy(key, *group).agg(F.transform(folded, lambda x: x["a"]).alias(awards))


def ranked_badges(badges_: DataFrame, key: str, rank: str, era: str, year: str, eras: list[str]) -> DataFrame:
    """Add ``place``: the strongest first, then by era in the given order, then the newest; unknown eras and years last."""
    age = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, eras)), F.col(era)), F.lit(0)), F.lit(len(eras) + 1))
    order = Window.partitionBy(key).orderBy(F.col(rank).asc_nulls_last(), age, F.coalesce(F.col(year), F.lit(0)).desc(), *[c for c in badges_.columns if c not in (key, rank, era, year)])
    return badges_.withColumn("place", F.row_number().over(order))


def headline(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The strongest distinction of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def pills(rows: DataFrame, key: str, group: list[str], latest: str) -> DataFrame:
    """Distinctions of one kind as one row, with how many there are and the latest year."""
    return rows.groupBy(key, *group).agg(F.count("*").alias("times"), F.max(latest).alias(latest))


def checked(hits: DataFrame, checks: DataFrame, keys: list[str]) -> DataFrame:
    """Hits after checks by hand (keys, verdict, item): ``no`` removes one, ``yes`` makes it verified."""
    marked = hits.join(checks.select(*keys, "verdict", "item"), keys, "left").where("NOT verdict <=> 'no'")
    yes = F.coalesce(F.col("verdict") == "yes", F.lit(False))
    swap = {"confidence": F.when(yes, "verified").otherwise(F.col("confidence")), "keyword": F.when(yes, F.col("item")).otherwise(F.col("keyword"))}
    return marked.withColumns(swap).drop("verdict", "item")


#: Rows of a task, about, where each gets a list; and over how many tasks at least the rows of one key are dealt.
LISTED_ROWS, SPREAD = 10_000, 8


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], folded: str, value: str) -> DataFrame:
    """Add the list of ``value`` of equal keys, nulls included, and of an equal trimmed lower-case ``folded``.

    Rows are dealt by key, those of one key over ``SPREAD`` tasks, so that a task meets few lists, which
    a file of its rows then holds once, however long they are.
    """
    plain = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    of = lambda spread: F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], plain(F.col(folded)).alias("f"), spread.cast("long").alias("s"))
    parts = parts_of(rows.count(), LISTED_ROWS)
    grouped = table.withColumn("_at", of(F.lit(0))).groupBy("_at").agg(F.array_sort(F.collect_set(value)).alias(value))
    lists = grouped.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).select(F.col("_at").withField("s", F.col("_s").cast("long")).alias("_at"), value)
    dealt = rows.withColumn("_at", of(F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)))).repartition(parts, "_at")
    return dealt.join(lists.repartition(parts, "_at"), "_at", "left").drop("_at").withColumn(value, F.coalesce(value, F.array().cast("array<string>")))

