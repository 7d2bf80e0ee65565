"""A table with one row for each key: a base, and small changes beside it that readers merge.

``base-<n>`` holds the rows as of change n, dealt by a hash of the key to folders; ``changes/batch=<n>``
the rows that change n put or, marked as deleted, took away. A change writes its own rows alone, in as
few files as they need, and writing it again under its number writes the same. Readers take the newest
whole base and the changes after it; of a key's rows the last change's counts. Once changes make up a
share of the base, ``compact`` writes a new base beside the old one; a job that fails leaves what was.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

#: Rows of a file, and the share of the base from which changes are merged into a new one.
FILE_ROWS, SHARE = 1_000_000, 0.2


@dataclass(frozen=True)
class KeyedTable:
    """Rows of ``schema`` below ``path``; the key may be null in no row."""

    spark: SparkSession
    path: str
    key: str
    schema: StructType
    folders: int = 64

    def _folder(self, name: str = "") -> tuple:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _whole(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the parts of a folder that were written to their end."""
        at, fs = self._folder(folder)
        if not fs.exists(at):
            return []
        paths = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith(prefix)]
        return sorted(int(p.getName().removeprefix(prefix)) for p in paths if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def base(self) -> int:
        """The newest base's number; -1 before the first."""
        return max(self._whole("", "base-"), default=-1)

    def pending(self) -> list[int]:
        """Changes that the newest base doesn't have."""
        base = self.base()
        return [n for n in self._whole("changes", "batch=") if n > base]

    def change(self, rows: DataFrame, number: int, deleted: str | None = None, order: list[str] | None = None) -> None:
        """Put ``rows``, and take away those where column ``deleted`` holds, as change ``number``, from 0.

        Of several rows of one key the last by ``order`` counts; by all columns without one. A change
        that the base has already is passed over.
        """
        if number <= self.base():
            return
        gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        made = rows.where(F.col(self.key).isNotNull()).select(F.struct(*fields, gone.alias("_gone")).alias("r"), F.struct(*[F.col(c) for c in order or self.schema.names]).alias("o"))
        last = made.groupBy(F.col(f"r.{self.key}").alias("_k")).agg(F.max_by("r", "o").alias("r")).select("r.*")
        n = rows.count()
        last.coalesce(max(1, math.ceil(n / FILE_ROWS))).write.mode("overwrite").parquet(f"{self.path}/changes/batch={number}")

    def _changes(self, numbers: list[int]) -> DataFrame:
        """The last of each key's changes."""
        schema = StructType([*self.schema.fields]).add("_gone", "boolean").add("batch", "long")
        paths = [f"{self.path}/changes/batch={n}" for n in numbers]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/changes").parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        kept = F.struct(*self.schema.names, "_gone")
        return rows.groupBy(F.col(self.key).alias("_k")).agg(F.max_by(kept, "batch").alias("r")).select("r.*")

    def read(self) -> DataFrame:
        """One row for each key: the base without the changed keys, and their last changes."""
        base, pending = self.base(), self.pending()
        held = self.spark.read.schema(self.schema).parquet(f"{self.path}/base-{base}") if base >= 0 else self.spark.createDataFrame([], self.schema)
        if not pending:
            return held.select(*self.schema.names)
        changes = self._changes(pending)
        rest = held.join(changes.select(self.key), self.key, "left_anti")
        return rest.select(*self.schema.names).unionByName(changes.where("NOT _gone").drop("_gone"))

    def of_keys(self, keys: list) -> DataFrame:
        """Rows of a few keys; of the base only their folders are read."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], StructType([self.schema[self.key]])).select(self.key, self._dealt().alias("_f"))
        folders = [r[0] for r in wanted.select("_f").distinct().collect()]  # folders at most
        base, pending = self.base(), self.pending()
        one = F.col(self.key).isin(*keys)
        rest = self.spark.createDataFrame([], self.schema)
        if base >= 0:
            rest = self.spark.read.schema(StructType([*self.schema.fields]).add("_folder", "integer")).parquet(f"{self.path}/base-{base}").where(F.col("_folder").isin(*folders) & one).select(*self.schema.names)
        changes = self._changes(pending).where(one)
        return rest.join(changes.select(self.key), self.key, "left_anti").select(*self.schema.names).unionByName(changes.where("NOT _gone").drop("_gone"))

    def _dealt(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.folders)).cast("int")

    def compact(self, share: float = SHARE) -> bool:
        """Merge the changes into a new base if they have over ``share`` of the base's rows; says whether they had."""
        base, pending = self.base(), self.pending()
        if not pending:
            return False
        n_base = self.spark.read.schema(self.schema).parquet(f"{self.path}/base-{base}").count() if base >= 0 else 0
        if self._changes(pending).count() <= share * n_base:
            return False
        self.read().withColumn("_folder", self._dealt()).repartition("_folder").write.mode("overwrite").partitionBy("_folder").parquet(f"{self.path}/base-{pending[-1]}")
        return True

    def vacuum(self) -> None:
        """Delete what no reader that begins now needs."""
        base = self.base()
        old = [f"base-{n}" for n in self._whole("", "base-") if n < base] + [f"changes/batch={n}" for n in self._whole("changes", "batch=") if n <= base]
        for name in old:
            at, fs = self._folder(name)
            fs.delete(at, True)

    def follow(self, stream: DataFrame, checkpoint: str, deleted: str | None = None, order: list[str] | None = None, share: float = SHARE) -> StreamingQuery:
        """Put all that a stream has now, each batch as a change of its number, and stop."""

        def put(batch: DataFrame, number: int) -> None:
            self.change(batch, number, deleted, order)
            self.compact(share)

        each: Callable[[DataFrame, int], None] = put
        return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
