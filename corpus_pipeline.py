"""A training-data pipeline over ``documents``: language, near-duplicates, benchmark, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesaquery.llm import decontaminate, jaccard_join, language_id, packing
from mesaquery.llm.common import drop, prepare, saved, scratch, swept, table, unused, with_small
from mesaquery.llm.registry import TOKENIZER

#: Words that packing keeps for each worker: fewer than alone, as it follows other stages in one executor.
CACHE_WORDS = 300_000


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a unique key, as ids can be null or repeated, and the key's name.

    The key stays the same however often the rows are read: a file's number and the place in it. Rows
    that don't come from files are saved with their keys.
    """
    key, file, number, place = (unused(docs, x) for x in ("_row", "_file", "_number", "_place"))
    try:
        placed = docs.withColumn(file, F.col("_metadata.file_path")).withColumn(place, F.col("_metadata.row_index"))
    except AnalysisException:
        return saved(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key
    files = saved(placed.select(file).distinct().withColumn(number, F.row_number().over(Window.orderBy(file)).cast("long")), "files")  # a row for each file
    return with_small(placed, files, [file], "inner").withColumn(key, F.col(number) * (1 << 40) + F.col(place)).drop(file, number, place), key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language stay, mixed ones too."""
    prepare(spark)
    model = language_id.fit(docs.where(language_id.is_training("doc_id")))
    return language_id.identified(docs, model).where("lang_pred <> 'und'").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: 5-word shingles, Jaccard >= 0.8.

    It's the one of the smallest id; null ids come last.
    """
    prepare(spark)
    keyed, key = _keyed(docs)
    rows = keyed.select(F.col(key).alias("row"), "doc_id", "text")
    groups = saved(jaccard_join.similar_groups(rows.select("row", "text"), n=5, percent=80, id_col="row").select(F.col("doc_id").alias("row"), "component_id"), "groups")
    several = saved(groups.groupBy("component_id").agg(F.count("*").alias("rows")).where("rows > 1").select("component_id"), "several")
    of_several = saved(with_small(groups, several, ["component_id"], "inner"), "of-several")
    named = saved(with_small(rows.select("row", "doc_id"), of_several, ["row"], "inner"), "named")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("row"))
    first = saved(first.select("row"), "first")
    rejected = saved(with_small(named.select("row"), first, ["row"], "left_anti").withColumnRenamed("row", key), "rejected")
    drop(groups, several, of_several, named, first)
    return with_small(keyed, rejected, [key], "left_anti").drop(key)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination stay."""
    return decontaminate.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, TOKENIZER, end_id=0, capacity=2048, cache_words=CACHE_WORDS)


STAGES = [("language_id", language), ("jaccard_join", near_duplicates), ("decontaminate", benchmark), ("packing", packed)]

#: Language identification and tokenizers aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        with swept(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last is not None:
            drop(last)
        docs = last = spark.read.parquet(path)
        last._scratch_path = path
    return docs
