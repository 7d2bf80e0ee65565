"""Comparison of two snapshots, incremental work lists, and last-wins tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, change (added, dropped, changed), field, old, new: one row for each changed field."""
    a = old.select(key, *[F.col(f).cast("string").alias(f"old_{f}") for f in fields], F.lit(True).alias("was"))
    b = new.select(key, *[F.col(f).cast("string").alias(f"new_{f}") for f in fields], F.lit(True).alias("is"))
    both = a.join(b, key, "full_outer")
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"old_{f}").alias("old"), F.col(f"new_{f}").alias("new")) for f in fields])
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new")))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "dropped").otherwise("changed")
    differing = F.filter(rows, lambda r: ~r["old"].eqNullSafe(r["new"]))
    listed = both.select(key, kind.alias("change"), F.explode(F.when(kind == "changed", differing).otherwise(whole)).alias("r"))
    return listed.select(key, "change", "r.field", "r.old", "r.new")


def watched(changes: DataFrame, watch: DataFrame, key: str) -> DataFrame:
    """Changes of watched keys; additions aren't reported."""
    return changes.where("change <> 'added'").join(watch.select(key).distinct(), key, "left_semi")


def changed_hashes(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys whose digests are known in both snapshots and differ."""
    return old.select(key, F.col(digest).alias("old")).join(new.select(key, F.col(digest).alias("new")), key).where("old <> new")


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What isn't done yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def retry(todo: DataFrame, done: DataFrame, key: str, usable: str, method: str, using: str) -> DataFrame:
    """What has no usable result and wasn't tried with a method; ``usable`` is boolean."""
    had = done.where(F.coalesce(F.col(usable), F.lit(False)) | F.col(method).eqNullSafe(F.lit(using)))
    return pending(todo, had, key)


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the last in an explicit, total order."""
    fields = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in fields])


def first_per_key(rows: DataFrame, key: str, position: str) -> DataFrame:
    """One row for each key: the first by position; rank-one pruning keeps the shuffle small."""
    order = Window.partitionBy(key).orderBy(position)
    return rows.withColumn("_p", F.row_number().over(order)).where("_p = 1").drop("_p")


def newest_stamp(rows: DataFrame, stamp: str) -> DataFrame:
    """One row: the greatest stamp, null without rows. Partial maxima meet, and no stamps are sorted."""
    return rows.agg(F.max(stamp).alias(stamp))


def latest(rows: DataFrame, stamp: str, n: int = 2) -> DataFrame:
    """Rows of the ``n`` latest stamps."""
    stamps = rows.select(stamp).distinct().orderBy(F.desc(stamp)).limit(n)
    return rows.join(F.broadcast(stamps), stamp, "left_semi")  # n rows


#: Folders of a hashed snapshot, and how many of them a node of its tree has.
BUCKETS, FANOUT = 256, 16


def write_hashed(rows: DataFrame, path: str, key: str, fields: list[str], buckets: int = BUCKETS) -> None:
    """Write a snapshot by buckets of its key, and beside it a tree of digests over them.

    A bucket's digest is the count of its rows and the sum of their hashes over key and ``fields``, in
    any order; a node's is that of all below it. The tree's leaves are level 0.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
    dealt.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
    level = _hashed(spark, path, rows).groupBy(F.col("_bucket").alias("node")).agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.to_json(F.struct(key, *fields))).cast("decimal(38,0)")).alias("h"))
    made, wide, k = [], buckets, 0
    while True:
        made.append(level.select(F.lit(k).alias("level"), "node", "n", "h"))
        if wide == 1:
            break
        level = level.groupBy((F.col("node") / FANOUT).cast("int").alias("node")).agg(F.sum("n").alias("n"), F.sum("h").cast("decimal(38,0)").alias("h"))
        wide, k = -(-wide // FANOUT), k + 1
    tree = made[0]
    for more in made[1:]:
        tree = tree.unionByName(more)
    tree.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")  # a row for each node


def _hashed(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(StructType([*like.schema.fields]).add("_bucket", "integer")).parquet(f"{path}/rows")


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose rows differ between two hashed snapshots: from the root down, only below nodes that differ."""
    schema = "level int, node int, n long, h decimal(38,0)"
    a, b = (spark.read.schema(schema).parquet(f"{p}/digests") for p in (old, new))
    levels = a.unionByName(b).agg(F.max("level")).first()[0] or 0
    nodes: list[int] = [0]
    for level in range(levels, -1, -1):
        below = F.col("node").isin(*nodes) if level == levels else (F.col("node") / FANOUT).cast("int").isin(*nodes)
        one, other = (d.where((F.col("level") == level) & below).select("node", F.struct("n", "h").alias(c)) for d, c in ((a, "a"), (b, "b")))
        nodes = [r[0] for r in one.join(other, "node", "full_outer").where("NOT (a <=> b)").select("node").collect()]  # buckets at most
        if not nodes:
            return []
    return sorted(nodes)


def hashed_diff(old: str, new: str, like: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``diff`` of two hashed snapshots of rows as ``like`` has them; only buckets that differ are read."""
    spark = like.sparkSession
    found = F.col("_bucket").isin(*differing_buckets(spark, old, new))
    return diff(_hashed(spark, old, like).where(found), _hashed(spark, new, like).where(found), key, fields)
