"""Sinks: tables, CSV, dated snapshots, and payloads that are only written when they change."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mesaquery.sources.shared import filesystem

#: Files of a folder, about, where each row makes one.
FOLDER_FILES = 500


def _moved(spark: SparkSession, made: str, path: str) -> None:
    """Put what was written aside into place: the old table goes only once the new one is whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    new, at, old = hadoop(made), hadoop(path), hadoop(f"{path}.old-{uuid.uuid4().hex}")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(at) and fs.rename(at, old)
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"can't put {made} at {path}")
    if had:
        fs.delete(old, True)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table as a whole: it's written beside and renamed, so that a failed job leaves the old one."""
    aside = f"{path}.new-{uuid.uuid4().hex}"
    df.write.format(fmt).save(aside)
    _moved(df.sparkSession, aside, path)


def csv(df: DataFrame, path: str, order: str) -> None:
    """One CSV file with a header, in order; arrays and maps as JSON."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    df.orderBy(order).select(*flat).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def file_each(rows: DataFrame, name: Column, value: Column, path: str, folder_files: int = FOLDER_FILES) -> None:
    """A file for each row, with its text as a line, in numbered folders below ``path`` that tasks write.

    A file is called by the row's name and its place in the table, so that equal names stay apart and a
    task that is tried again writes the same files; each is put in place once it is whole.
    """
    folders = max(1, math.ceil(rows.count() / folder_files))
    named = rows.select(F.concat_ws("-", name.cast("string"), F.monotonically_increasing_id().cast("string")).alias("name"), value.alias("value"))
    dealt = named.withColumn("folder", F.pmod(F.xxhash64("name"), F.lit(folders))).repartition(folders, "folder")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        made: set[str] = set()
        for batch in batches:
            for name, value, folder in zip(*(batch.column(c) for c in ("name", "value", "folder")), strict=True):
                at = f"{root}/{folder.as_py():07d}"
                if at not in made:
                    fs.create_dir(at, recursive=True)
                    made.add(at)
                aside = f"{at}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(aside) as out:
                    out.write((value.as_py() or "").encode() + b"\n")
                fs.move(aside, f"{at}/{quote(name.as_py(), safe='=')}.txt")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    dealt.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def snapshot(df: DataFrame, path: str, stamp: str) -> None:
    """Add or replace one dated partition."""
    df.withColumn("snapshot_date", F.lit(stamp)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The partition of the greatest date; its path alone is read."""
    dates = [r[0] for r in spark.read.parquet(path).select(F.max("snapshot_date")).collect()]
    return spark.read.parquet(path).where(F.col("snapshot_date") == F.lit(dates[0]))


def differs(old: DataFrame, new: DataFrame, ignore: tuple[str, ...] = ()) -> bool:
    """Whether two tables differ as bags of rows, apart from stamps; one sum of hashes for each."""
    columns = sorted(c for c in new.columns if c not in ignore)
    if sorted(c for c in old.columns if c not in ignore) != columns:
        return True
    print_ = lambda d: d.select(F.xxhash64(*[F.to_json(F.struct(c)) for c in columns]).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    return tuple(print_(old)) != tuple(print_(new))


def write_if_changed(new: DataFrame, path: str, ignore: tuple[str, ...] = (), write: bool = True) -> bool:
    """Write JSON lines unless only ignored columns changed; says whether there was a change."""
    spark = new.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        if not differs(spark.read.schema(new.schema).json(path), new, ignore):
            return False
    if write:
        replace(new, path, "json")
    return True


def read_through(wanted: DataFrame, key: str, path: str, look_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``wanted`` keys from a cache at ``path``; only missing keys are looked up, and added to it."""
    spark = wanted.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    missing = wanted.select(key).distinct()
    if there:
        missing = missing.join(spark.read.parquet(path).select(key), key, "left_anti")
    look_up(missing).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted.select(key).distinct(), key, "left_semi")
