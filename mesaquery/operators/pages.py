"""Sorted rows laid out so that any page is read without sorting again.

``write`` sorts rows once, by ranges, into parts with a folder each, numbers the rows of each part, and
stores how many rows each part has. A page finds its first row's part by prefix sums over these sizes,
and reads from the one or two parts that hold its rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from mesaquery.operators.facets import Sort

#: Rows of a part, about; a page has fewer.
PART_ROWS = 50_000
_PLACE = (StructField("_at", LongType()), StructField("_part", IntegerType()))


@dataclass(frozen=True)
class Layout:
    """Rows of one sort below ``path``."""

    spark: SparkSession
    path: str
    schema: StructType

    @classmethod
    def write(cls, rows: DataFrame, sort: Sort, path: str, part_rows: int = PART_ROWS) -> Layout:
        """Sort ``rows``, whose sort ends in a unique key, and write them with the parts' sizes."""
        order = sort.columns()
        parts = max(1, math.ceil(rows.count() / part_rows))
        placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
        placed = placed.withColumn("_part", F.shiftright("_id", 33).cast("int")).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")
        placed.write.mode("overwrite").partitionBy("_part").parquet(f"{path}/rows")
        layout = cls(rows.sparkSession, path, rows.schema)
        sizes = layout.rows().groupBy("_part").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        sizes.select("_part", "n", F.coalesce(before, F.lit(0)).alias("start")).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")  # a row for each part
        return layout

    def rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema, *_PLACE])).parquet(f"{self.path}/rows")

    def sizes(self) -> DataFrame:
        return self.spark.read.schema("_part int, n long, start long").parquet(f"{self.path}/sizes")

    def range(self, first: int, size: int) -> DataFrame:
        """Rows of the places from ``first``, from 0, in order, with ``place``."""
        held = self.sizes().where((F.col("start") < first + size) & (F.col("start") + F.col("n") > first)).orderBy("_part").collect()  # the parts of one page
        one = [F.lit(r["_part"]) for r in held]
        starts = F.create_map(*[x for r in held for x in (F.lit(r["_part"]), F.lit(r["start"]))]) if held else F.create_map(F.lit(-1), F.lit(0))
        rows = self.rows().where(F.col("_part").isin(*one)) if held else self.rows().where("false")
        placed = rows.withColumn("place", F.element_at(starts, F.col("_part")) + F.col("_at")).where(F.col("place").between(first, first + size - 1))
        return placed.select(*self.schema.names, "place").orderBy("place")

    def numbered(self) -> DataFrame:
        """All rows with ``place``."""
        sizes = self.sizes().select("_part", "start")  # a row for each part
        return self.rows().join(F.broadcast(sizes), "_part").select(*self.schema.names, (F.col("start") + F.col("_at")).alias("place"))

    def page(self, number: int, size: int = 50) -> DataFrame:
        """One page, as ``page_of`` has it."""
        return self.range(number * size, size).drop("place")


def write_all(rows: DataFrame, sorts: dict[str, Sort], path: str, names: Sequence[str] = (), part_rows: int = PART_ROWS) -> dict[str, Layout]:
    """A layout for each named sort."""
    return {n: Layout.write(rows, sorts[n], f"{path}/{n}", part_rows) for n in names or sorts}
