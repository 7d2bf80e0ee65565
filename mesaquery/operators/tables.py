"""Joins with defaults, star look-ups, counts, shares, unions and nested payloads of plain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a task, about, where a step sorts them.
TASK_ROWS = 100_000


def parts_of(rows: int, task_rows: int = TASK_ROWS) -> int:
    """How many tasks share so many rows, so that none sorts more as tables grow."""
    return max(1, -(-rows // task_rows))


def left_default(left: DataFrame, right: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """All rows of ``left`` with the columns of ``right`` named in ``defaults``, which stand in for missing rows and nulls."""
    joined = left.join(right.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def items_of(items: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Items with their parent's columns; items without a parent are dropped."""
    return items.join(parents, key)


def with_positions(rows: DataFrame, values: str, value: str) -> DataFrame:
    """A row for each entry of an array, with its place from 0."""
    return rows.select(*[c for c in rows.columns if c != values], F.posexplode(values).alias("pos", value))


def one_per_key(rows: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """key and the value of the key's first row in an order: what a scalar look-up may return."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def enriched(rows: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """Columns of each look-up (table, key in rows, key in table, columns) added by left joins.

    A look-up's key must be unique in its table; small tables are broadcast by their size.
    """
    for table, here, there, columns in lookups:
        rows = rows.join(table.select(F.col(there).alias("_k"), *columns), rows[here] == F.col("_k"), "left").drop("_k")
    return rows


def member_rows(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of the keys in ``members``; members without a row are dropped."""
    return rows.join(members.select(key).distinct(), key, "left_semi")


def excluded(rows: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Rows whose key isn't in a fixed list; null keys stay."""
    return rows.where(~F.coalesce(F.col(key).isin(*names), F.lit(False))) if names else rows


def present(*columns: str) -> Column:
    """Whether all texts are there and not empty."""
    return reduce(Column.__and__, [F.col(c).isNotNull() & (F.trim(c) != "") for c in columns])


def counts(rows: DataFrame, by: Sequence[str], distinct: str | None = None, tests: Mapping[str, Column] | None = None) -> DataFrame:
    """by, n, and if asked n_distinct of a column and how many rows each named test holds for."""
    aggregates = [F.count("*").alias("n")]
    if distinct:
        aggregates.append(F.count_distinct(distinct).alias("n_distinct"))
    aggregates += [F.count_if(F.coalesce(t, F.lit(False))).alias(k) for k, t in (tests or {}).items()]
    return rows.groupBy(*by).agg(*aggregates) if by else rows.agg(*aggregates)


def histogram(rows: DataFrame, value: Column, shares: bool = True) -> DataFrame:
    """value, n and its share in percent of all rows with a value that isn't null or empty."""
    known = rows.select(value.alias("value")).where("value IS NOT NULL AND CAST(value AS string) <> ''")
    counted = known.groupBy("value").agg(F.count("*").alias("n"))
    if not shares:
        return counted
    total = known.agg(F.greatest(F.lit(1), F.count("*")).alias("_all"))
    return counted.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") * 100.0 / F.col("_all")).alias("share"))  # one row


def top_values(rows: DataFrame, values: Column, most: int = 8) -> DataFrame:
    """value, n of the most frequent entries of an array column; the first in order at ties."""
    each = rows.select(F.explode(values).alias("value")).where("value IS NOT NULL")
    return each.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most)


def tiles(rows: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """tile, n: the number of rows, and of those that each test holds for, in one pass."""
    every = {"all": F.lit(True), **tests}
    one = rows.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(k) for k, t in every.items()])
    return one.selectExpr(f"stack({len(every)}, " + ", ".join(f"'{k}', `{k}`" for k in every) + ") AS (tile, n)")


def bag_union(*frames: DataFrame) -> DataFrame:
    """All rows of all tables, repeats included, by column names."""
    return reduce(DataFrame.unionByName, frames)


def low_only(hits: DataFrame, group: str, key: str, high: Column) -> DataFrame:
    """group, key: distinct keys of a group none of whose hits is high."""
    return hits.groupBy(group, key).agg(F.bool_or(F.coalesce(high, F.lit(False))).alias("_h")).where("NOT _h").select(group, key)


def json_field(text: Column, path: str, kind: str) -> Column:
    """A field of a JSON text; null where the text isn't JSON, or the field is missing or null."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def nested(rows: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Add an array of structs for each child (table, order, columns), in order; empty where a key has none."""
    for name, (table, order, columns) in children.items():
        at = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
        listed = F.array_sort(F.collect_list(F.struct(*at, F.struct(*columns).alias("_v"))))
        found = table.groupBy(key).agg(F.transform(listed, lambda x: x["_v"]).alias(name))
        rows = rows.join(found, key, "left").withColumn(name, F.coalesce(name, F.array().cast(found.schema[name].dataType)))
    return rows


def payload(rows: DataFrame, key: str) -> DataFrame:
    """key and the row as one JSON document; null fields are kept."""
    return rows.select(key, F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("document"))


def split_without(text: Column, sentinel: str = "-") -> Column:
    """Sorted distinct parts of a text parted by white space, without a sentinel."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.trim(text), r"\s+"), lambda x: (x != "") & (x != sentinel))))


def by_rank(values: Column, order: Sequence[str]) -> Column:
    """Distinct known values of an array in a fixed order."""
    return F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(values, x))
