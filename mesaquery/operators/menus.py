"""Menu texts to sections and dishes: lines, filters, headers carried forward, supplements and grades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesaquery.functions.text import dish_parts, title_case
from mesaquery.operators.derive import parse_grade
from mesaquery.operators.tagging import with_headers

#: Lines that head a section, alone but for a colon.
SECTIONS = (
    "first course", "second course", "third course", "starters?", "appetizers?", "to start", "entr[ée]es?", "mains?", "main course",
    "desserts?", "dolci", "postres", "antipasti", "primi", "secondi", "salads?", "small plates", "snacks", "sides", "lunch", "dinner",
    "brunch", "supplements?", "add[- ]?ons?",
)
#: What shows that a line isn't a dish.
NOISE = (
    "restaurant week", "prix[- ]fixe", "per person", "not includ", "gratuit", "beverage", r"tax(?:es)?\b", "choice of", "choose one",
    r"www\.", "https?://", "@", "follow us", r"\d{3}[-.]\d{3}[-.]\d{4}",
)
#: What marks a supplement, and the longest line that can be a dish.
SUPPLEMENT = (r"\+\s*\$\s?\d+", "supplement", r"sup\.")
LONGEST = 90

_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_any = "|".join


def menu_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, pos, line, is_section: trimmed lines that are neither empty nor too long."""
    lines = texts.select(key, F.posexplode(F.split(text, _BREAK)).alias("pos", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"(?U)^\s+|\s+$", "")).where((F.col("line") != "") & (F.length("line") <= LONGEST))
    return lines.withColumn("is_section", F.rlike("line", F.lit(rf"(?iu)^\s*(?:{_any(SECTIONS)})\s*:?\s*$")))


def dishes(lines: DataFrame, key: str) -> DataFrame:
    """key, pos, section, dish, description, supplement_price of the lines below a section's header.

    A price is a supplement's only on lines that mark one.
    """
    headed = with_headers(lines, key, "pos", "line", F.col("is_section"))
    line = F.col("line")
    fit = ~F.col("is_section") & F.col("header").isNotNull() & ~line.rlike(f"(?i){_any(NOISE)}") & line.rlike("[a-zA-Z]{3}")
    parts = headed.where(fit).withColumn("_p", dish_parts(line)).where(F.length("_p.dish") >= 2)
    price = F.nullif(F.regexp_extract(line, r"\$\s?(\d{1,3}(?:\.\d{2})?)", 1), F.lit("")).cast("double")
    section = title_case(F.regexp_replace("header", ":+$", ""))
    return parts.select(key, "pos", section.alias("section"), "_p.dish", "_p.description", F.when(line.rlike(f"(?i){_any(SUPPLEMENT)}"), price).alias("supplement_price"))


def graded(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_sections, n_items, grade of every menu."""
    lines = menu_lines(texts, key, text)
    sections = lines.groupBy(key).agg(F.count_if("is_section").alias("n_sections"))
    items = dishes(lines, key).groupBy(key).agg(F.count("*").alias("n_items"))
    n_chars = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)^\s+|\s+$", ""))
    whole = texts.select(key, n_chars.alias("_n")).join(sections, key, "left").join(items, key, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_sections", "n_items")}
    whole = whole.withColumns(zero)
    return whole.select(key, "n_sections", "n_items", parse_grade(F.col("_n"), F.col("n_sections"), F.col("n_items")).alias("grade"))
