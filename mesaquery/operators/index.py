"""An index of searched and faceted rows, so that queries read what they ask for and not all rows.

Rows are dealt by a hash of their key to blocks of about ``BLOCK_ROWS`` and numbered within them. Three
tables are built of them:

* ``rows``: key, folded name and folded haystack, a folder for each block;
* ``postings``: for each run of three letters (of fewer at a text's end) and block the rows that have it,
  sorted by letters, a folder for each group of first letters;
* ``bitmaps``: for each facet, value and block a bit for each row.

A search reads the postings of its text's runs, intersects them block by block, and compares the text
with the haystacks of the rows that are left, in their blocks alone. Facet counts are ANDs of bitmaps:
values chosen in one facet are ORed, and each facet is counted under the AND of all others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesaquery.functions.text import fold, folded
from mesaquery.operators.facets import Facet, QuerySpec, relevance_of

#: Rows of a block, at most as many as Spark's bitmaps have bits; blocks are filled to three quarters.
BLOCK_ROWS = 1 << 15
#: Letters of a run, and folders of postings.
RUN, FOLDERS = 3, 64
#: Blocks that a search names one by one; one that meets more reads all.
NAMED_BLOCKS = 1000


def in_blocks(rows: DataFrame, key: str, size: int = BLOCK_ROWS) -> DataFrame:
    """``rows``, one for each key, with ``block`` and ``at``, their place in it from 0.

    Keys are hashed over as many blocks as three quarters of ``size`` rows each make; what is over
    ``size`` in one of them goes to further blocks.
    """
    n_blocks = max(1, math.ceil(rows.count() / (0.75 * size)))
    dealt = rows.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(n_blocks)))
    place = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("_deal").orderBy(key)) - 1)
    return place.withColumn("block", F.col("_deal") + n_blocks * F.expr(f"_at div {size}")).withColumn("at", (F.col("_at") % size).cast("int")).drop("_deal", "_at")


def _runs(text: Column) -> Column:
    """The distinct runs of letters that begin at each place of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{RUN}}}))"), F.lit(1)))


def _folder(run: Column) -> Column:
    return F.ascii(run) % FOLDERS


@dataclass(frozen=True)
class Index:
    """The three tables below ``path``; ``key`` is the key's name, ``kind`` its type."""

    spark: SparkSession
    path: str
    key: str
    kind: str

    @classmethod
    def build(cls, rows: DataFrame, key: str, path: str, haystack: Column, name: Column, facets: Sequence[Facet] = (), size: int = BLOCK_ROWS) -> Index:
        """Write the tables of rows with unique keys; ``haystack`` is folded text."""
        index = cls(rows.sparkSession, path, key, dict(rows.dtypes)[key])
        values = F.array(*[F.struct(F.lit(f.key).alias("facet"), F.coalesce(F.array_compact(F.array_distinct(f.values)), F.array().cast("array<string>")).alias("values")) for f in facets])
        kept = rows.select(F.col(key), F.coalesce(haystack, F.lit("")).alias("haystack"), F.coalesce(fold(name), F.lit("")).alias("name"), values.alias("values") if facets else F.lit(None).cast("array<struct<facet:string,values:array<string>>>").alias("values"))
        in_blocks(kept, key, size).write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows")
        rows_ = index.rows()
        posted = rows_.select("block", "at", F.explode(_runs(F.col("haystack"))).alias("run")).groupBy("run", "block").agg(F.array_sort(F.collect_list("at")).alias("rows"))
        posted.withColumn("folder", _folder(F.col("run"))).repartitionByRange("run", "block").sortWithinPartitions("run", "block").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
        each = rows_.select("block", "at", F.explode("values").alias("v")).select("block", "at", "v.facet", F.explode("v.values").alias("value"))
        # The bits of all rows stand under the facet "".
        every = rows_.select("block", "at", F.lit("").alias("facet"), F.lit("").alias("value"))
        bits = each.unionByName(every).groupBy("facet", "value", "block").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))
        bits.write.mode("overwrite").parquet(f"{path}/bitmaps")
        return index

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def rows(self) -> DataFrame:
        return self._table("rows", f"`{self.key}` {self.kind}, haystack string, name string, values array<struct<facet:string,values:array<string>>>, at int, block long")

    def postings(self) -> DataFrame:
        return self._table("postings", "run string, block long, rows array<int>, folder int")

    def bitmaps(self) -> DataFrame:
        return self._table("bitmaps", "facet string, value string, block long, bits binary")

    def candidates(self, text: str) -> DataFrame:
        """(block, at) of the rows whose haystack has all runs of a folded text, in any order."""
        runs = sorted({text[i : i + RUN] for i in range(len(text) - RUN + 1)}) or [text]
        short = len(text) < RUN
        wanted = F.col("folder").isin(*sorted({ord(r[0]) % FOLDERS for r in runs}))
        wanted &= F.startswith("run", F.lit(text)) if short else F.col("run").isin(*runs)
        lists = self.postings().where(wanted).groupBy("block").agg(F.collect_list("rows").alias("lists"))
        if short:  # any run that begins so
            return lists.select("block", F.explode(F.array_distinct(F.flatten("lists"))).alias("at"))
        met = lists.where(F.size("lists") == len(runs))
        common = F.aggregate(F.slice("lists", 2, len(runs)), F.get("lists", F.lit(0)), F.array_intersect)
        return met.select("block", F.explode(common).alias("at"))

    def hits(self, text: str) -> DataFrame:
        """block, at, key and relevance tier of the rows whose haystack has the text; all rows for no text."""
        wanted = folded(text)
        rows = self.rows()
        if wanted:
            found = self.candidates(wanted)
            blocks = [r[0] for r in found.select("block").distinct().limit(NAMED_BLOCKS + 1).collect()]
            rows = rows.where(F.col("block").isin(*blocks)) if len(blocks) <= NAMED_BLOCKS else rows
            rows = rows.join(found, ["block", "at"], "left_semi").where(F.contains("haystack", F.lit(wanted)))
        return rows.select("block", "at", self.key, relevance_of(F.col("name"), wanted).alias("tier"))

    def counts(self, facets: Sequence[Facet], spec: QuerySpec) -> DataFrame:
        """facet, value, n as ``facet_counts`` has them, among the rows that have the spec's text if there's one."""
        bitmaps = self.bitmaps()
        chosen = {f.key: spec.selected[f.key] for f in facets if spec.selected.get(f.key)}
        one = [(F.col("facet") == k) & F.col("value").isin(*v) for k, v in chosen.items()]
        passed = bitmaps.where(reduce(Column.__or__, one, F.lit(False))).groupBy("block", "facet").agg(F.bitmap_or_agg("bits").alias("bits"))
        always = bitmaps.where("facet = ''").select("block", "bits")
        if spec.text:
            always = self.hits(spec.text).groupBy("block").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))
        # What a facet is counted under: the rows that pass all others. Facets without a choice share one.
        classes = F.array(*map(F.lit, ("", *chosen)))
        tests = passed.unionByName(always.withColumn("facet", F.lit("")).select("block", "facet", "bits"))
        left_out = F.filter(classes, lambda c: (c == "") | (F.col("facet") != c))
        others = tests.select("block", "bits", F.explode(left_out).alias("class")).groupBy("block", "class").agg(F.bitmap_and_agg("bits").alias("others"), F.count("*").alias("n"))
        others = others.where(F.col("n") == F.when(F.col("class") == "", len(chosen) + 1).otherwise(len(chosen)))
        class_ = F.when(F.col("facet").isin(*chosen), F.col("facet")).otherwise("") if chosen else F.lit("")
        both = bitmaps.where(F.col("facet").isin(*[f.key for f in facets])).withColumn("class", class_).join(others.drop("n"), ["block", "class"])
        met = both.select("facet", "value", "block", F.explode(F.array("bits", "others")).alias("bits")).groupBy("facet", "value", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
        counted = met.groupBy("facet", "value").agg(F.sum("n").alias("n")).where("n > 0")
        seeds = sorted({(f.key, v) for f in facets for v in {*f.seed, *spec.selected.get(f.key, ())}})
        if not seeds:
            return counted
        zero = self.spark.createDataFrame(seeds, "facet string, value string").withColumn("n", F.lit(0).cast("long"))
        return counted.unionByName(zero).groupBy("facet", "value").agg(F.sum("n").alias("n"))
