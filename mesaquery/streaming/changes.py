"""Incremental ingest: new files once each, latest state by key, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mesaquery.operators.snapshots import last_wins


def new_files(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """A stream of files that no earlier run of the same checkpoint has read."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def keep_latest(stream: DataFrame, key: str, order: list[str], table: str, checkpoint: str, shards: int = 16) -> StreamingQuery:
    """Keep the last row of each key below ``table``; all that is there now, then stop.

    Keys are dealt to ``shards`` folders, and a batch rewrites only those that it has keys of, each
    under the batch's number; a repeated batch writes the same. Older folders of a shard are deleted
    once the new one is whole; ``latest_rows`` reads the newest of each.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
        dealt = batch.withColumn("_shard", shard).persist()
        for n in sorted(r[0] for r in dealt.select("_shard").distinct().collect()):  # shards at most
            rows = dealt.where(F.col("_shard") == n).drop("_shard")
            earlier = [(b, p) for b, p in _batches(spark, f"{table}/shard={n}") if b < number]
            if earlier:
                rows = spark.read.schema(batch.schema).parquet(max(earlier)[1]).unionByName(rows)
            last_wins(rows, key, order).write.mode("overwrite").parquet(f"{table}/shard={n}/batch={number}")
            for _, path in earlier:
                _delete(spark, path)
        dealt.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _batches(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and paths of a shard's whole batches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    paths = [f.getPath() for f in fs.listStatus(at)]
    whole = [p for p in paths if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [(int(p.getName().partition("=")[2]), p.toString()) for p in whole]


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def latest_rows(spark: SparkSession, table: str, schema: str, shards: int = 16) -> DataFrame:
    """The last row of each key, from the newest batch of each shard."""
    newest = [max(found)[1] for n in range(shards) if (found := _batches(spark, f"{table}/shard={n}"))]
    return spark.read.schema(schema).parquet(*newest) if newest else spark.createDataFrame([], schema)


def windowed_counts(events: DataFrame, ts: str, by: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts of each window; events later than the watermark are dropped from streams."""
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return stamped.groupBy(F.window(ts, size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
