"""Tiered entity resolution and scoring of candidate matches."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesaquery.functions.text import sequence_ratio, subset_jaccard


def by_name(externals: DataFrame, venues: DataFrame) -> DataFrame:
    """ext, slug, confidence, status of externals (ext, name, streets) with a venue (slug, name, streets, pos) of their name.

    * One venue of the name: 1.0 where street numbers meet, 0.9 where either side has none, else review;
    * several: the first whose street numbers meet, else the first for review.
    """
    first = F.min(F.struct("pos", "slug"))
    # Venues are brought down to a row a name, and a row a name and street, before externals meet them.
    alike = venues.groupBy("name").agg(F.count("*").alias("n"), first.alias("first"), F.max(F.col("streets").isNull()).alias("unknown"))
    sure = venues.select("name", F.explode("streets").alias("street"), "pos", "slug").groupBy("name", "street").agg(first.alias("sure"))
    each = externals.select("ext", "name", F.col("streets").isNull().alias("none"), F.posexplode_outer("streets").alias("at", "street"))
    met = each.join(alike, "name").join(sure, ["name", "street"], "left")
    once = F.coalesce(F.col("at"), F.lit(0)) == 0
    exact = met.groupBy("ext").agg(F.sum(F.when(once, F.col("n"))).alias("n"), F.min("sure").alias("sure"), F.min("first").alias("first"), F.max(F.col("none") | F.col("unknown")).alias("unknown"))
    alone = (F.col("n") == 1) & F.col("unknown")
    there = F.col("sure").isNotNull()
    return exact.select("ext", F.coalesce("sure.slug", "first.slug").alias("slug"), F.when(there, 1.0).when(alone, 0.9).otherwise(0.5).alias("confidence"), F.when(there | alone, "matched").otherwise("review").alias("status"))


#: Names up to this length are told by what is left of them without a few letters.
_SHORT = 9


@F.pandas_udf(T.ArrayType(T.StringType()))
def _grams(name: pd.Series) -> pd.Series:
    """Runs of three letters, each with how often it came before."""

    def of(text: str) -> list[str]:
        out, seen = [], Counter()
        for i in range(len(text) - 2):
            gram = text[i : i + 3]
            out.append(f"{gram}{seen[gram]}")
            seen[gram] += 1
        return out

    return name.map(lambda t: [] if t is None else of(t))


def _index(names: DataFrame, frequency: DataFrame, name: str, least: float) -> DataFrame:
    """name, gram: the rarest grams of a name of over ``_SHORT`` letters, so many that a name of a ratio of ``least`` shares one of them.

    At ratio r, strings of lengths a and b match in M = r (a + b) / 2 letters at least, and what doesn't
    match parts these into a + b - 2 M + 1 runs at most. A run of l letters has l - 2 of the three-letter
    runs; so two long strings share M - 2 (a + b - 2 M + 1) of them, and all but that number, less one,
    of the rarest are enough to find one.
    """
    grams = names.where(F.length(name) > _SHORT).select(F.col(name).alias("_name"), F.explode(_grams(name)).alias("gram")).join(frequency, "gram")
    order = Window.partitionBy("_name").orderBy("n", "gram")
    a = F.length("_name")
    both = a * (1 + least / (2 - least))
    shared = F.greatest(F.lit(1.0), F.ceil(least * both / 2 - 2 * ((1 - least) * both + 1) - 1e-6))
    keep = F.col("_at") <= F.greatest(F.lit(1), a - 2 - shared + 1)
    return grams.withColumn("_at", F.row_number().over(order)).where(keep).select(F.col("_name").alias(name), "gram")


def _shortened(names: DataFrame, name: str, least: float) -> DataFrame:
    """name, rest: what is left of a name, of a length that one of ``_SHORT`` letters can be like, without a few of its letters.

    Strings of a ratio of ``least`` have a common subsequence of r (a + b) / 2 letters, as long as the
    shorter of them at most; so the longer loses (1 - r / (2 - r)) of its letters at most to get to it.
    """
    share = 1 - least / (2 - least)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def without(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[str]:
            most = int(share * len(text) + 1e-9)
            return sorted({"".join(c for i, c in enumerate(text) if i not in gone) for k in range(most + 1) for gone in combinations(range(len(text)), k)})

        return texts.map(of)

    fitting = names.where(F.length(name) <= int(_SHORT * (2 - least) / least + 1e-9))
    return fitting.select(name, F.explode(without(name)).alias("rest"))


#: Fixed value: the confidence of a similar name at the same street number.
SIMILAR = 0.8


def by_ratio(externals: DataFrame, venues: DataFrame, sure: float = 0.92, doubtful: float = 0.85) -> DataFrame:
    """ext, slug, confidence, status of externals by their most similar venue name, the first of equally similar ones.

    The confidence is ``SIMILAR`` of a match and the ratio of names for review. matched from ``sure`` on
    with one venue of the name whose street numbers meet, review from ``doubtful`` on, else no row.
    Long names meet where they share one of their rarest grams, short ones where they are equal without
    a few letters, which finds every pair of that ratio, 0.85 at least, without comparing all with all.
    """
    if doubtful < 0.85:
        raise ValueError("names of a ratio below 0.85 need not share a gram")
    names = venues.where("name <> ''").groupBy("name").agg(F.count("*").alias("same"), F.min("pos").alias("pos"), F.min_by("slug", "pos").alias("slug"), F.min_by("streets", "pos").alias("v_streets"))
    names = names.withColumnRenamed("name", "v_name")
    wanted = externals.where("name <> ''").select("name").distinct()
    every = wanted.union(names.select(F.col("v_name").alias("name")))
    frequency = every.select(F.explode(_grams("name")).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    reach = doubtful / (2 - doubtful)
    few = names.select("v_name")
    long_ = _index(wanted, frequency, "name", doubtful).join(_index(few, frequency, "v_name", doubtful), "gram")
    short = _shortened(wanted, "name", doubtful).join(_shortened(few, "v_name", doubtful), "rest").where(F.least(F.length("name"), F.length("v_name")) <= _SHORT)
    pairs = long_.select("name", "v_name").union(short.select("name", "v_name"))
    pairs = pairs.where((F.length("v_name") >= F.length("name") * reach - 1e-9) & (F.length("name") >= F.length("v_name") * reach - 1e-9)).select("name", "v_name").distinct()
    close = pairs.withColumn("ratio", sequence_ratio("name", "v_name")).where(F.col("ratio") >= doubtful).join(names, "v_name")
    met = F.coalesce(F.arrays_overlap("streets", "v_streets"), F.lit(False))
    best = externals.join(close, "name").groupBy("ext").agg(F.max_by(F.struct("slug", "ratio", "same", met.alias("met")), F.struct("ratio", (-F.col("pos")).alias("p"))).alias("b"))
    certain = (F.col("b.ratio") >= sure) & (F.col("b.same") == 1) & F.col("b.met")
    return best.select("ext", F.col("b.slug").alias("slug"), F.when(certain, SIMILAR).otherwise(F.col("b.ratio")).alias("confidence"), F.when(certain, "matched").otherwise("review").alias("status"))


def resolve(externals: DataFrame, venues: DataFrame, sure: float = 0.92, doubtful: float = 0.85) -> DataFrame:
    """ext, slug, confidence, status: ``by_name``, and ``by_ratio`` for externals of a name that no venue has."""
    named = by_name(externals, venues)
    rest = externals.join(venues.select("name").distinct(), "name", "left_anti")
    return named.unionByName(by_ratio(rest, venues, sure, doubtful))


def judged(candidates: DataFrame, near_m: float = 150.0, far_m: float = 400.0, least_similarity: float = 0.55) -> DataFrame:
    """Add ``accepted`` to candidates (metres, words, other_words): near, or not far and alike."""
    alike = subset_jaccard(F.col("words"), F.col("other_words"))
    near = (F.col("metres") <= near_m) | (F.col("metres") <= far_m) & (alike >= least_similarity)
    return candidates.withColumn("similarity", alike).withColumn("accepted", F.coalesce(near, F.lit(False)))


def best_candidate(candidates: DataFrame, key: str, position: str, top: int = 5, parts: int | None = None) -> DataFrame:
    """The best of each key's first candidates by (accepted, similarity); the earliest at ties. ``parts`` tasks share the keys, if given."""
    order = Window.partitionBy(key).orderBy(F.desc("accepted"), F.desc("similarity"), position)
    first = candidates.where(F.col(position) < top)
    if parts:
        first = first.repartition(parts, key)
    return first.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def overridden(found: DataFrame, pins: DataFrame, key: str, value: str) -> DataFrame:
    """Pinned values go first."""
    pin = pins.select(key, F.col(value).alias("_pin"))
    return found.join(pin, key, "left").withColumn(value, F.coalesce("_pin", value)).drop("_pin")


def quarantined(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the table, and rows for review."""
    return found.where("status = 'matched'"), found.where("status = 'review'")
