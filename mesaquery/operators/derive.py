"""Columns derived from a listing's labels, states and sources, as expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.functions.numbers import half_even, numeric_sorted
from mesaquery.operators.scoring import era

#: Names of the months, which labels give in full or by three letters (or four: sept).
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Hyphens, dashes and the minus sign.
DASHES = "-\u2010-\u2015\u2212"
#: The box of valid coordinates (south, north, west, east).
BOX = (40.45, 41.02, -74.30, -73.65)


def offer_terms(labels: Column) -> Column:
    """Struct of tiers (by number), periods (by name) and sunday of an array of labels.

    A label's first ``$N`` is its tier. A label of brunch isn't one of lunch. Null labels are empty.
    """
    low = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.lower(x))
    tiers = F.filter(F.transform(low, lambda x: F.regexp_extract(x, r"(\$\d+)", 1)), lambda x: x != "")
    brunch = F.exists(low, lambda x: x.contains("brunch"))
    lunch = F.exists(low, lambda x: x.contains("lunch") & ~x.contains("brunch"))
    dinner = F.exists(low, lambda x: x.contains("dinner"))
    periods = F.array_compact(F.array(F.when(brunch, "brunch"), F.when(dinner, "dinner"), F.when(lunch, "lunch")))
    numbers = F.array_sort(F.array_distinct(F.transform(tiers, lambda x: F.substring(x, 2, 12).cast("int"))))
    return F.struct(F.transform(numbers, lambda n: F.concat(F.lit("$"), n.cast("string"))).alias("tiers"), periods.alias("periods"), F.exists(low, lambda x: x.contains("sunday")).alias("sunday"))


def end_of_labels(labels: Column, year: int) -> Column:
    """Last day that the last label names, as in ``Week 7 (Sept 1 - Sept 6)`` or ``Week 6 (Aug 24 - 31)``.

    The month of the last day falls back to the first one; null without such days or for no real date.
    """
    last = F.lower(F.try_element_at(labels, F.lit(-1)))
    month = r"([a-z]{3,9})\.?\s*"
    pattern = rf"week\s+\d+\s*\(\s*{month}\d{{1,2}}\s*[{DASHES}]\s*(?:{month})?(\d{{1,2}})\s*\)"
    name = F.coalesce(F.nullif(F.regexp_extract(last, pattern, 2), F.lit("")), F.regexp_extract(last, pattern, 1))
    short = F.when(name == "sept", "sep").otherwise(name)
    place = F.array_position(F.array(*[F.lit(x) for n in (None, 3) for x in (m[:n] for m in MONTHS)]), short)
    day = F.regexp_extract(last, pattern, 3)
    text = F.concat_ws("-", F.lit(str(year)), F.lpad(((place - 1) % 12 + 1).cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(place > 0, F.try_to_date(text, "yyyy-MM-dd"))


def end_date(listed: Column, verified: Column, source: Column) -> Column:
    """Struct of date and source: the listed one where checks fell back to it, else the verified, else the listed.

    A verified date without a source is a printed one.
    """
    fell_back = F.coalesce(source == "api_fallback", F.lit(False))
    kind = F.when(fell_back, "api_fallback").when(verified.isNotNull(), F.coalesce(source, F.lit("printed"))).otherwise("api")
    return F.struct(F.when(fell_back, listed).otherwise(F.coalesce(verified, listed)).alias("date"), kind.alias("source"))


def sunday(listed: Column, verified: Column) -> Column:
    """Struct of sunday and source: verified goes first; what isn't listed isn't served."""
    return F.struct(F.coalesce(verified, listed, F.lit(False)).alias("sunday"), F.when(verified.isNotNull(), "verified").otherwise("api").alias("source"))


def urgent(end: Column, book_by: Column) -> Column:
    """Whether a venue ends by a date; not where its end isn't known."""
    return F.coalesce(end <= book_by, F.lit(False))


def era_of(source: Column, year: Column, season: int, ageing: str = "james_beard") -> Column:
    """A distinction's era: annual guides are always current, and only ``ageing`` ones age."""
    return F.when(source.eqNullSafe(F.lit(ageing)), era(year, season)).otherwise("current")


def rated(matched: Column, accepted: Column) -> Column:
    """Struct of rating, reviews and closed of a matched place; null unless accepted and rated.

    A place is closed if its state is known and isn't OPERATIONAL.
    """
    closed = F.coalesce(matched["business_status"] != "OPERATIONAL", F.lit(False))
    made = F.struct(half_even(matched["rating"].cast("double"), 2).alias("rating"), F.coalesce(matched["user_ratings_total"], F.lit(0)).alias("reviews"), closed.alias("closed"), matched["place_id"].alias("place_id"), matched["name"].alias("matched_name"))
    return F.when(F.coalesce(accepted, F.lit(False)) & matched["rating"].isNotNull(), made)


def usable(rows: DataFrame, confidence: str, comparable: str, gaps: str) -> DataFrame:
    """Estimates of more than low confidence that have a comparable and gaps."""
    weak = F.coalesce(F.col(confidence).isin("low", "none"), F.lit(True))
    return rows.where(~weak & F.col(comparable).isNotNull() & (F.size(gaps) > 0))


#: What a listing says of seats outdoors.
OUTDOOR_WORDS = "outdoor|patio|sidewalk|al ?fresco|terrace|rooftop|roof ?deck|backyard|courtyard|open-air|garden"


def outdoor(sidewalk: Column, roadway: Column, licence: Column, summary: Column) -> Column:
    """Struct of sidewalk, roadway, licensed and described; null where neither a licence nor the text tells.

    Null means unknown, never that there is none.
    """
    described = F.coalesce(F.regexp_like(summary, F.lit(f"(?i){OUTDOOR_WORDS}")), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    made = F.struct(yes(sidewalk).alias("sidewalk"), yes(roadway).alias("roadway"), licence.isNotNull().alias("licensed"), described.alias("described"))
    return F.when(licence.isNotNull() | described, made)


def sane_coordinates(lat: Column, lng: Column, box: tuple[float, float, float, float] = BOX) -> Column:
    """Struct of lat and lng, both null outside the box, whose borders count as inside."""
    south, north, west, east = box
    inside = lat.between(south, north) & lng.between(west, east)
    return F.struct(F.when(inside, lat).alias("lat"), F.when(inside, lng).alias("lng"))


def without_own(values: Column, own: Column) -> Column:
    """An array without the row's own value; order and repeats stay."""
    return F.filter(values, lambda v: ~v.eqNullSafe(own))


def partner_link(partner: Column, account: Column, named: str, prefix: str) -> Column:
    """A link for accounts of one partner; null for others and for empty accounts."""
    return F.when((partner == named) & (account != ""), F.concat(F.lit(prefix), account))


def menu_state(has_file: Column, parsed_text: Column) -> Column:
    """none without a file, image_only without text in it, else pdf."""
    return F.when(~F.coalesce(has_file, F.lit(False)), "none").when(F.trim(F.coalesce(parsed_text, F.lit(""))) == "", "image_only").otherwise("pdf")


def parse_grade(n_chars: Column, n_sections: Column, n_items: Column) -> Column:
    return F.when(n_chars < 40, "failed").when((n_sections >= 2) & (n_items >= 4), "full").otherwise("partial")


def verdict(dropped: Column, rank: Column, has_override: Column, has_estimate: Column) -> Column:
    """Where a row's value comes from: the first that holds of dropped, ranked, note and estimate."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(dropped), "dropped").when(yes(rank > 0), "ranked").when(yes(has_override), "note").when(yes(has_estimate), "estimate").otherwise("none")


def trust(rank: Column, basis: Column) -> Column:
    """-1 ranked, 0 verified, 1 estimate, 2 anything else."""
    return F.when(rank.isNotNull(), -1).when(basis == "verified", 0).when(basis == "estimate", 1).otherwise(2)


def gap_of(verified: Column, estimate: Column, override_price: Column, dropped: Column, price: Column, tiers: Column) -> Column:
    """Struct of gap, basis and price: a verified gap, else an estimate that no override speaks against.

    A missing price is the least tier's.
    """
    blocked = override_price.isNotNull() | F.coalesce(dropped, F.lit(False))
    gap = F.coalesce(verified, F.when(~blocked, estimate))
    basis = F.when(verified.isNotNull(), "verified").when(~blocked & estimate.isNotNull(), "estimate")
    least = F.try_element_at(numeric_sorted(F.transform(tiers, lambda t: F.regexp_replace(t, r"\$", ""))), F.lit(1)).cast("int")
    return F.struct(gap.alias("gap"), basis.alias("basis"), F.coalesce(price, least).alias("price"))


def gap_share(gap: Column, comparable: Column) -> Column:
    """Percent of the comparable, half-even; null without one."""
    return F.when(comparable != 0, half_even(gap * 100.0 / comparable).cast("long"))


@dataclass(frozen=True)
class Distinction:
    """A rule of the ranking of distinctions: a source and a pattern of its levels; none fits all."""

    source: str
    pattern: str | None
    label: str


#: Distinctions from the strongest on, by source and a pattern of the level.
PRESTIGE = (
    Distinction("michelin", r"\d+\s*stars?", "Michelin star"),
    Distinction("nyt", None, "NYT 100 Best"),
    Distinction("james_beard", r"winner", "James Beard winner"),
    Distinction("michelin", r"bib gourmand", "Michelin Bib Gourmand"),
    Distinction("james_beard", r"nominee", "James Beard nominee"),
    Distinction("james_beard", r"semifinalist", "James Beard semifinalist"),
    Distinction("michelin", r"the plate", "Michelin Plate"),
)
#: What is shown for codes of the data.
SOURCES = {"michelin": "Michelin", "james_beard": "James Beard", "nyt": "NYT 100"}
LEVELS = {"recommended": "The Plate", "bib_gourmand": "Bib Gourmand", "nyt_100_best": "100 Best", "nyt_starred_review": "starred review"}
ERAS = {"current": "This year or last", "recent": "Last 5 years", "past": "Past decade", "historic": "Over 15 years ago"}


def labelled(code: Column, labels: Mapping[str, str], default: Column | None = None) -> Column:
    """A code's label, or the default; the code itself where there's none."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), code if default is None else default)


def level_label(level: Column) -> Column:
    """A level as shown: known codes by name, others with spaces."""
    return labelled(level, LEVELS, F.replace(level, F.lit("_"), F.lit(" ")))


def distinction(source: Column, level: Column, rules: Sequence[Distinction], names: Mapping[str, str] | None = None) -> Column:
    """Struct of rank (the first rule that fits, else the number of rules) and its label."""
    low = F.lower(F.coalesce(level, F.lit("")))
    names = names or {}
    own = source
    for key, label in names.items():
        own = F.when(source == key, F.lit(label)).otherwise(own)
    fits = [(source == r.source) if r.pattern is None else (source == r.source) & low.rlike(r.pattern) for r in rules]
    rank, label = F.lit(len(rules)), own
    for i in range(len(rules) - 1, -1, -1):
        rank, label = F.when(fits[i], i).otherwise(rank), F.when(fits[i], rules[i].label).otherwise(label)
    return F.struct(rank.alias("rank"), label.alias("label"))
