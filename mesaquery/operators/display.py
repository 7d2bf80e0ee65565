"""Texts of rows as they are shown: money, dates, gaps, ratings, outdoor seating, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(n: Column) -> Column:
    """Whole dollars with thousands parted; null for null."""
    return F.concat(F.lit("$"), F.format_number(n.cast("double"), 0))


def short_date(day: Column) -> Column:
    """As in ``Aug 16``."""
    return F.date_format(day, "MMM d")


def _range(low: Column, high: Column) -> Column:
    """A number without its sign, or a range where a different high one is known."""
    plain = lambda x: F.abs(x).cast("long").cast("string")
    return F.when(high.isNotNull() & (high != low), F.concat(plain(low), F.lit("–"), plain(high))).otherwise(plain(low))


def gap_text(usd: Column, usd_high: Column, pct: Column, pct_high: Column) -> Column:
    """A gap in words: a dash without one; a negative one costs MORE, any other is so much off."""
    over = usd < 0
    dollars = F.concat(F.when(over, "+").otherwise(""), money(F.abs(usd)), F.when(usd_high.isNotNull() & (usd_high != usd), F.concat(F.lit("–"), F.abs(usd_high).cast("long").cast("string"))).otherwise(""))
    share = F.when(pct.isNotNull(), F.concat(_range(pct, pct_high), F.lit("%"), F.when(over, " MORE").otherwise(" off")))
    return F.when(usd.isNull(), "—").otherwise(F.concat_ws(" ", dollars, share))


def outdoor_text(seating: Column) -> Column:
    """What is known of a struct of seating: a licence, the listing's word, or nothing."""
    kinds = F.concat_ws(" + ", F.when(seating["sidewalk"], "sidewalk café"), F.when(seating["roadway"], "street shed"))
    told = F.when(seating["described"], ", and mentioned on its listing").otherwise("")
    licensed = F.concat(F.lit("Yes — licensed "), kinds, F.lit(" (city register"), told, F.lit(")"))
    return F.when(seating.isNull(), "Not established").when(seating["licensed"], licensed).otherwise("Mentioned on its listing — not in the city register (which covers only pavement and roadway)")


def marker(end: Column, book_by: Column, basis: Column) -> Column:
    """Kind of a map's marker: urgent, else by the gap's basis."""
    return F.when(end <= book_by, "urgent").when(basis.isin("verified", "estimate"), basis).otherwise("none")


def pill_text(tier: Column, source: Column, year: Column, times: Column, ageing: str = "james_beard") -> Column:
    """A distinction's pill: its tier, the year of those that age, and how often."""
    dated = F.when((source == ageing) & year.isNotNull(), F.concat(F.lit(" ’"), F.substr(year.cast("string"), F.lit(3))))
    return F.concat(F.coalesce(tier, source), F.coalesce(dated, F.lit("")), F.when(times > 1, F.concat(F.lit(" ×"), times.cast("string"))).otherwise(""))


def rating_band(score: Column) -> Column:
    return F.when(score >= 4.6, "4.6+").when(score >= 4.4, "4.4-4.6").when(score >= 4.2, "4.2-4.4").when(score >= 4.0, "4.0-4.2").when(score.isNotNull(), "under 4.0")


def review_band(reviews: Column) -> Column:
    return F.when(reviews >= 2000, "2,000+").when(reviews >= 500, "500-2,000").when(reviews >= 100, "100-500").when(reviews.isNotNull(), "under 100")


def report(rows: DataFrame, lines: dict[str, Column]) -> DataFrame:
    """line, n, share: how many rows each line holds for, in order, of all."""
    one = rows.agg(F.count("*").alias("_all"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in lines.items()])
    stacked = one.selectExpr("_all", f"stack({len(lines)}, " + ", ".join(f"{i}, '{k}', `{k}`" for i, k in enumerate(lines)) + ") AS (at, line, n)")
    return stacked.select("at", "line", "n", (F.col("n") * 100.0 / F.greatest(F.lit(1), F.col("_all"))).alias("share"))


def change_report(changes: DataFrame) -> DataFrame:
    """change, field, n of a snapshot's differences."""
    return changes.groupBy("change", F.coalesce("field", F.lit("")).alias("field")).agg(F.count("*").alias("n"))
