"""Visit planning, side-by-side comparison, run headers and top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.functions.numbers import date_range
from mesaquery.operators.facets import Sort


def date_issue(day: Column, today: Column, closes: Column, saturday: Column, sunday: Column, no_dinner: Column | None = None) -> Column:
    """The first reason against a date, or null: past, closed, no saturday, no sunday, sunday brunch only."""
    weekday = F.dayofweek(day)
    brunch = F.lit(False) if no_dinner is None else F.coalesce(no_dinner, F.lit(False))
    return (
        F.when(day < today, "past")
        .when(day > closes, "closed")
        .when((weekday == 7) & ~F.coalesce(saturday, F.lit(False)), "no saturday")
        .when((weekday == 1) & ~F.coalesce(sunday, F.lit(False)), "no sunday")
        .when((weekday == 1) & brunch, "sunday brunch only")
    )


def open_dates(rows: DataFrame, key: str, today: Column, closes: str, saturday: str, sunday: str, last: Column) -> DataFrame:
    """key, day: all dates from today to a venue's end, or the programme's, without an issue."""
    until = F.least(F.coalesce(F.col(closes), last), last)
    days = rows.select(key, closes, saturday, sunday, F.explode(date_range(today, until)).alias("day"))
    return days.where(date_issue(F.col("day"), today, F.col(closes), F.col(saturday), F.col(sunday)).isNull()).select(key, "day")


def current_plan(plan: DataFrame, day: str, issue: Column) -> DataFrame:
    """Bookings; a day that has become impossible is taken away."""
    kept = F.when(issue.isNull(), F.col(day))
    return plan.withColumn(day, kept)


#: Dated bookings by day; then the others by when they close, the open-ended last; then by key.
PLAN_ORDER = Sort((("day", False), ("closes", False), ("slug", False)))


def conflicts(plan: DataFrame, day: str) -> DataFrame:
    """Dates with more than one booking, and how many."""
    return plan.where(F.col(day).isNotNull()).groupBy(day).agg(F.count("*").alias("n")).where("n > 1")


def compare(rows: DataFrame, key: str, metrics: dict[str, bool], limit: int = 6, order: list[Column] | None = None) -> DataFrame:
    """metric, key, value, wins of the first ``limit`` rows; ``metrics`` says whether more is better.

    Nobody wins where all values are equal or one alone is known.
    """
    chosen = rows.orderBy(*(order or [F.col(key)])).limit(limit)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(more).alias("more")) for m, more in metrics.items()])
    flat = chosen.select(key, F.explode(cells).alias("c")).select(key, "c.*")
    every = Window.partitionBy("metric")
    best = F.when(F.col("more"), F.max("value").over(every)).otherwise(F.min("value").over(every))
    spread = F.max("value").over(every) > F.min("value").over(every)
    return flat.withColumn("wins", F.coalesce((F.col("value") == best) & spread, F.lit(False))).drop("more")


def with_runs(rows: DataFrame, partition: str, group: str, order: list[Column]) -> DataFrame:
    """Add starts_run (the group differs from the row before) and group_size."""
    seq = Window.partitionBy(partition).orderBy(*order)
    start = ~F.col(group).eqNullSafe(F.lag(group).over(seq)) | (F.row_number().over(seq) == 1)
    return rows.withColumn("starts_run", start).withColumn("group_size", F.count("*").over(Window.partitionBy(partition, group)))


def top_and_bottom(rows: DataFrame, order: list[Column], reverse: list[Column], top: int = 30, bottom: int = 20, low: Column | None = None) -> DataFrame:
    """Add side to the first ``top`` rows, and to the last ``bottom`` of those that ``low`` holds for."""
    first = rows.orderBy(*order).limit(top).withColumn("side", F.lit("top"))
    last = (rows if low is None else rows.where(low)).orderBy(*reverse).limit(bottom).withColumn("side", F.lit("bottom"))
    return first.unionByName(last)


def upper_median(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, middle: the value at place n // 2 of the sorted values, found by running counts.

    Counts of distinct values are summed, so that a key's rows needn't meet in one array.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy(value)
    placed = counts.withColumn("upto", F.sum("n").over(order)).withColumn("of", F.sum("n").over(Window.partitionBy(key)))
    return placed.where("upto > of div 2").groupBy(key).agg(F.min(value).alias("middle"))
