"""Percentiles, shrinkage, and a weighted rubric that never takes unknown for zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.functions.numbers import ramp, shrink

#: Keys, times conditions, up to which ``middles`` broadcasts a row or two of each.
BROADCAST_KEYS = 100_000


def _bounds(value: str, parts: int) -> Column:
    """Aggregate: the bounds of about ``parts`` ranges of as many values each, approximate percentiles; empty without values."""
    return F.coalesce(F.approx_percentile(F.col(value).cast("double"), [i / parts for i in range(1, parts)], 10 * parts), F.array().cast("array<double>"))


def _placed(rows: DataFrame, value: str, cuts: Column, n: int, out: str = "_part") -> DataFrame:
    """Add how many of at most ``n`` ascending ``cuts`` a value reaches, so that equal values share a range.

    A binary search with a column for each step: these are compiled, unlike a fold over an array.
    """
    rows = rows.withColumn(out, F.lit(0))
    for step in (1 << k for k in reversed(range(n.bit_length()))):
        rows = rows.withColumn(out, F.col(out) + F.when(F.get(cuts, F.col(out) + (step - 1)) <= F.col(value).cast("double"), step).otherwise(0))
    return rows


def in_ranges(counts: DataFrame, value: str, parts: int, out: str = "_part") -> DataFrame:
    """Add the number of the range of values, of about ``parts`` of as many rows each, that a value falls into.

    The ranges' bounds are one row that all tasks get.
    """
    bounds = counts.agg(_bounds(value, parts).alias("_cuts"))
    return _placed(counts.crossJoin(F.broadcast(bounds)), value, F.col("_cuts"), parts - 1, out).drop("_cuts")  # one row of bounds


def _ranked(rows: DataFrame, value: str, parts: int) -> DataFrame:
    """value, _below, _all: for each distinct value how many rows are strictly below, and how many in all.

    Distinct values are dealt to about ``parts`` ranges of equal size, each counted on its own; what
    lies below a range is a prefix sum over the ranges' totals. No task sees all values.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    dealt = in_ranges(counts, value, parts)
    totals = dealt.groupBy("_part").agg(F.sum("_n").alias("_t"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    bases = totals.select("_part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"), F.sum("_t").over(everything).alias("_all"))  # a row for each part
    within = Window.partitionBy("_part").orderBy(value)
    ranked = dealt.withColumn("_below", F.sum("_n").over(within) - F.col("_n")).join(F.broadcast(bases), "_part")
    return ranked.select(value, (F.col("_below") + F.col("_base")).alias("_below"), "_all")


def or_total(rows: DataFrame, keys: Sequence[str], total: bool) -> DataFrame:
    """``rows`` with total, false; with ``total``, each again with null keys and true."""
    if not total:
        return rows.withColumn("total", F.lit(False))
    rest = [c for c in rows.columns if c not in keys]
    own = F.struct(*keys, F.lit(False).alias("total"))
    whole = F.struct(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in keys], F.lit(True).alias("total"))
    return rows.select(F.explode(F.array(own, whole)).alias("_k"), *rest).select("_k.*", *rest)


def middles(rows: DataFrame, keys: Sequence[str], value: str, parts: int = 256, within: Mapping[str, Column] | None = None, total: bool = False) -> DataFrame:
    """keys, middle: the exact median of each key's non-null values, the mean of the two middle ones of an even number.

    ``within`` names conditions, which may overlap: then there is a row for each key and name, as
    ``within``, of the values that satisfy it. With ``total`` there are rows of all keys' values, with null
    keys, that a column ``total`` tells apart.

    Rows aren't moved. One pass takes bounds of about ``parts`` ranges of all values; one counts each key's rows
    by range in partial sums, whose prefix sums, at most ``parts`` rows a name, tell the ranges of the middles;
    and one keeps the rows of just these ranges, counts equal values and sorts them. So a key of all rows
    sends about one in ``parts`` of its values to a task. Middle ranges are broadcast unless keys are many.
    """
    keys, named = list(keys), dict(within or {"": F.lit(True)})
    bit = {name: 1 << k for k, name in enumerate(named)}
    mask = reduce(Column.bitwiseOR, [F.when(holds, bit[name]).otherwise(0) for name, holds in named.items()])
    rows = rows.select(*keys, F.col(value).cast("double").alias("_value"), mask.alias("_mask")).where("_value IS NOT NULL AND _mask <> 0")
    seen = rows.agg(_bounds("_value", parts).alias("cuts"), F.approx_count_distinct(F.xxhash64(*keys)).alias("keys")).first()  # bounds and a number
    cuts = [c for k, c in enumerate(seen["cuts"]) if not k or c != seen["cuts"][k - 1]]
    dealt = _placed(rows, "_value", F.lit(cuts) if cuts else F.array().cast("array<double>"), len(cuts))
    names = F.explode(F.array(*[F.struct(F.lit(name).alias("within"), F.lit(b).alias("_bit")) for name, b in bit.items()]))
    counts = or_total(dealt.groupBy(*keys, "_part", "_mask").agg(F.count("*").alias("_n")), keys, total)
    own, every = [*keys, "total"], [*keys, "total", "within"]
    totals = counts.select("*", names.alias("_name")).select("*", "_name.*").where("_mask & _bit <> 0").groupBy(*every, "_bit", "_part").agg(F.sum("_n").alias("_t"))
    of_key = Window.partitionBy(*every)
    upto = F.sum("_t").over(of_key.orderBy("_part"))
    bases = totals.select(*every, "_bit", "_part", (upto - F.col("_t")).alias("_base"), upto.alias("_upto"), F.sum("_t").over(of_key).alias("_all"))
    low, high = F.expr("(_all - 1) div 2"), F.expr("_all div 2")
    wanted = bases.where((F.col("_upto") > low) & (F.col("_base") <= high)).drop("_upto")
    wanted = F.broadcast(wanted) if seen["keys"] * len(named) <= BROADCAST_KEYS else wanted  # a row or two for each key and name
    same = reduce(Column.__and__, [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*own, "_part")]) & F.expr("d._mask & w._bit <> 0")
    met = or_total(dealt, keys, total).alias("d").join(wanted.alias("w"), same).select(*[F.col(f"d.{c}") for c in (*own, "_part", "_value")], "within", "_base", "_all")
    each = met.groupBy(*every, "_part", "_base", "_all", "_value").agg(F.count("*").alias("_n"))
    ended = each.withColumn("_end", F.col("_base") + F.sum("_n").over(Window.partitionBy(*every, "_part").orderBy("_value")))
    first = lambda rank: F.min(F.when(F.col("_end") > rank, F.col("_value")))
    found = ended.groupBy(*every).agg(((first(low) + first(high)) / 2).alias("middle"))
    return found.drop(*([] if within else ["within"]), *([] if total else ["total"]))


def strict_percentile(rows: DataFrame, value: str, out: str = "pct", parts: int = 256) -> DataFrame:
    """Add the share, in percent, of non-null values strictly below a row's; null for null."""
    return rows.join(_ranked(rows, value, parts), value, "left").withColumn(out, F.col("_below") * 100.0 / F.col("_all")).drop("_below", "_all")


def positions(rows: DataFrame, key: str, out: str = "position", parts: int = 256) -> DataFrame:
    """Add the place, from 0, of each row by a unique numeric key; null for null."""
    return rows.join(_ranked(rows, key, parts), key, "left").withColumn(out, F.col("_below").cast("long")).drop("_below", "_all")


def with_means(rows: DataFrame, columns: list[str], default: float | None = None) -> DataFrame:
    """Add mean_<column> over all rows' known values, by a join with the one row of means."""
    means = rows.agg(*[(F.avg(c) if default is None else F.coalesce(F.avg(c), F.lit(default))).alias(f"mean_{c}") for c in columns])
    return rows.crossJoin(F.broadcast(means))  # one row


def shrunk(rows: DataFrame, mean: str, votes: str, weight: float = 150.0, out: str = "weighted") -> DataFrame:
    """Add the mean pulled towards the mean of all means by ``weight`` votes."""
    return with_means(rows, [mean]).withColumn(out, shrink(F.col(mean), F.col(votes), F.col(f"mean_{mean}"), weight)).drop(f"mean_{mean}")


def rubric(rows: DataFrame, weights: dict[str, float], default: float = 50.0) -> DataFrame:
    """Add score, completeness (percent of weight that is known) and imputed (names of the rest).

    An unknown component takes its mean over all rows, or ``default`` where none is known. Without
    any weight the score is null and completeness 0.
    """
    total = sum(weights.values())
    filled = with_means(rows, list(weights), default)
    if not total:
        return filled.select(*rows.columns, F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("completeness"), F.array(*map(F.lit, weights)).alias("imputed"))
    plus = lambda xs: reduce(Column.__add__, xs)
    score = plus(F.coalesce(F.col(c), F.col(f"mean_{c}")) * w for c, w in weights.items()) / total
    known = plus(F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(0.0) for c, w in weights.items()) * 100 / total
    imputed = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in weights]), lambda x: x.isNotNull())
    return filled.select(*rows.columns, score.alias("score"), known.alias("completeness"), imputed.alias("imputed"))


def era(year: Column, season: int) -> Column:
    """current up to 1 year, recent up to 5, past up to 15, else historic."""
    age = F.lit(season) - year
    return F.when(year.isNull(), None).when(age <= 1, "current").when(age <= 5, "recent").when(age <= 15, "past").otherwise("historic")


def bands(value: Column, cuts: list[float]) -> Column:
    """The highest cut (cuts descending) that a value reaches, or null."""
    return F.coalesce(*[F.when(value >= c, F.lit(float(c))) for c in cuts])


def precedence(*choices: tuple[str, Column, Column]) -> Column:
    """struct<value, source> of the first (source, condition, value) whose condition holds."""
    chain = None
    for source, holds, value in choices:
        pick = F.struct(value.alias("value"), F.lit(source).alias("source"))
        chain = F.when(holds, pick) if chain is None else chain.when(holds, pick)
    return chain


@dataclass(frozen=True)
class RubricConfig:
    """Cut-points of the rubric's components; weights by component."""

    weights: Mapping[str, float]
    tiers: Mapping[str, float]
    decay: Mapping[str, float]
    worst_minutes: float
    best_minutes: float
    no_line: float
    zero_pct: float
    full_pct: float
    neutral: float
    confidence: Mapping[str, float]
    zero_days: float
    full_days: float


def _looked_up(table: Mapping[str, float], key: Column, default: float) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))]), key) if table else F.lit(None).cast("double")
    return F.coalesce(found, F.lit(float(default)))


def rubric_parts(config: RubricConfig, tier: Column, era: Column, rating_pct: Column, minutes: Column, gap_pct: Column, basis: Column, end: Column, today: Column) -> dict[str, Column]:
    """The five components, 0 to 100; null where unknown.

    * award: the tier's worth, less for older eras; without any award 0, as that is a fact;
    * rating: the percentile of the weighted rating;
    * lex: nearness of a preferred line; a fixed score without one;
    * value: the gap's share, drawn to a neutral score by how little its basis is trusted;
    * window: days left until the end.
    """
    trust = _looked_up(config.confidence, basis, 0.0)
    return {
        "award": F.when(tier.isNull(), F.lit(0.0)).otherwise(_looked_up(config.tiers, tier, 0.0) * _looked_up(config.decay, era, 1.0)),
        "rating": rating_pct.cast("double"),
        "lex": F.coalesce(ramp(minutes, config.worst_minutes, config.best_minutes), F.lit(float(config.no_line))),
        "value": trust * ramp(gap_pct, config.zero_pct, config.full_pct) + (1 - trust) * config.neutral,
        "window": F.when(end.isNotNull(), ramp(F.greatest(F.lit(0), F.date_diff(end, today)).cast("double"), config.zero_days, config.full_days)),
    }
