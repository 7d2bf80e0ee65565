"""Text functions as column expressions; Python only where Spark has no built-in (Unicode forms, ratios)."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that say nothing about which venue a name means; longer ones come first.
QUALIFIERS = ("the", "restaurant", "ristorante", "nyc", "new york city", "new york", "manhattan", "brooklyn")
#: Words of registered names that don't make two of them alike.
NOISE = ("llc", "inc", "corp", "corporation", "ltd", "co", "the", "restaurant", "restaurants", "nyc", "new", "york", "cafe", "bar", "grill", "kitchen", "group", "holdings", "enterprises", "of", "and", "at", "on", "by")
#: Paths where sites keep their menus.
GUESSED_PATHS = ("/menu", "/menus", "/food", "/dinner-menu", "/menu/", "/menus/", "/dinner", "/our-menu", "/food-menu", "/lunch-menu")


#: Characters that searches take for a plain one.
_SAME = {"'": "\u2018\u2019\u02bc\u2032", "-": "\u2012\u2013\u2014\u2212", '"': "\u201c\u201d"}


@F.pandas_udf(T.StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without characters beyond ASCII; null stays null."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def plain_letters(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks; other characters stay."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))



def folded(text: str) -> str:
    """Search form of one text: no combining marks, plain quotes and dashes, lower case."""
    plain = {ord(c): to for to, cs in _SAME.items() for c in cs}
    return "".join(c for c in unicodedata.normalize("NFD", text) if not "\u0300" <= c <= "\u036f").translate(plain).lower()


@F.pandas_udf(T.StringType())
def fold(text: pd.Series) -> pd.Series:
    """``folded`` of each text; null stays null."""
    return text.map(lambda t: None if t is None else folded(t))


def cleaned(text: str) -> str:
    """Composed form without control characters, replacement marks as apostrophes, single spaces."""
    composed = unicodedata.normalize("NFC", text).replace("\ufffd", "'")
    return " ".join("".join(c for c in composed if c == "\n" or unicodedata.category(c)[0] != "C").split())


@F.pandas_udf(T.StringType())
def clean(text: pd.Series) -> pd.Series:
    """``cleaned`` of each text; null stays null."""
    return text.map(lambda t: None if t is None else cleaned(t))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two strings."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def simple_name(name: Column) -> Column:
    """Lower-case ASCII letters and digits, single spaces; apostrophes vanish."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), "['`]", ""), "[^a-z0-9]+", " "))


def match_name(name: Column) -> Column:
    """``simple_name`` without qualifiers; the simple form where nothing else is left."""
    base = simple_name(ascii_fold(name))
    bare = F.trim(F.regexp_replace(F.regexp_replace(base, r"\b(" + "|".join(QUALIFIERS) + r")\b", " "), " +", " "))
    return F.when(bare == "", base).otherwise(bare)


def tokens(text: Column, noise: tuple[str, ...] = (), longer_than: int = 0) -> Column:
    """Distinct words of a simple name, without noise words and short ones."""
    words = F.array_distinct(F.filter(F.split(text, "[^a-z0-9']+"), lambda w: F.length(w) > longer_than))
    return F.array_except(words, F.array(*map(F.lit, noise))) if noise else words


def search_words(text: Column) -> Column:
    """All words of a folded text, repeats included."""
    return F.filter(F.split(text, "[^a-z0-9']+"), lambda w: w != "")


def name_tokens(name: Column) -> Column:
    """Distinct telling words of a registered name: two letters at least, and no noise."""
    plain = F.regexp_replace(F.lower(plain_letters(name)), "[^a-z0-9 ]+", " ")
    return tokens(plain, NOISE, 1)


def title_case(text: Column) -> Column:
    """Each run of letters with a capital first and small ones after it, whatever comes before it."""
    runs = F.split(F.lower(text), r"(?<!\p{L})(?=\p{L})")
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(F.array_union(a, b)))


def subset_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity, 1 where one set holds the other."""
    both = F.size(F.array_intersect(a, b))
    return F.when((both > 0) & ((both == F.size(a)) | (both == F.size(b))), F.lit(1.0)).otherwise(jaccard(a, b))


def street_numbers(address: Column) -> Column:
    """Numbers of an address: hyphens joined, up to four digits, none that is also an ordinal; null if none."""
    text = F.regexp_replace(F.lower(address), r"(\d)-(\d)", "$1$2")
    ordinals = F.regexp_extract_all(text, F.lit(r"\b(\d+)(?:st|nd|rd|th)\b"), F.lit(1))
    numbers = F.array_except(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(\d{1,4})\b"), F.lit(1))), ordinals)
    return F.when(F.size(numbers) > 0, F.array_sort(numbers))


def house_number(address: Column) -> Column:
    """Leading digits of an address, or null."""
    digits = F.regexp_extract(address, r"^\s*(\d+)", 1)
    return F.when(digits != "", digits)


def snippet(text: Column, pattern: str, pad: int = 60) -> Column:
    """The first match with ``pad`` characters on either side, white space joined; null without one."""
    at = F.regexp_instr(text, F.lit(pattern))
    found = F.regexp_substr(text, F.lit(pattern))
    start = F.greatest(at - pad, F.lit(1))
    cut = F.substr(text, start, at - start + F.length(found) + pad)
    return F.when(at > 0, F.trim(F.regexp_replace(cut, r"\s+", " ")))


def prices(text: Column, low: int = 4, high: int = 120) -> Column:
    """Dollar prices within bounds, as doubles in order."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\$ ?(\d{1,3}(?:\.\d\d)?)"), F.lit(1)), lambda x: x.cast("double"))
    return F.filter(found, lambda x: (x >= low) & (x <= high))


def whole_prices(text: Column, structured: bool = False, low: int = 4, high: int = 120) -> Column:
    """Whole dollars of the prices within bounds; with ``structured`` those of JSON fields after them."""
    found = F.regexp_extract_all(text, F.lit(r"\$\s?(\d{1,3})(?:\.\d{2})?\b"), F.lit(1))
    if structured:
        found = F.concat(found, F.regexp_extract_all(text, F.lit(r'"(?:price|amount|cost)"\s*:\s*"?\$?(\d{1,3})(?:\.\d{2})?"?'), F.lit(1)))
    return F.filter(F.transform(found, lambda x: x.cast("int")), lambda x: x.between(low, high))


def all_prices(texts: Column, low: int = 4, high: int = 120) -> Column:
    """Whole dollars of all texts of an array in order: the page's, its links' and its files'."""
    return F.flatten(F.transform(texts, lambda t: whole_prices(t, low=low, high=high)))


def visible_text(html: Column) -> Column:
    """Text outside scripts, styles and tags, white space joined."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " "), r"(?is)<style[^>]*>.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]+>", " "), r"\s+", " "))


def links(html: Column) -> Column:
    """Distinct link targets in order of first appearance, in quotes of either kind."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit("""(?i)href=["']([^"'#]+)["']"""), F.lit(1)))


def host_of(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def page_links(rows: DataFrame, html: str, base: str, wanted: str, pages: int = 3, files: int = 2) -> DataFrame:
    """Add ``pages`` and ``files``: the wanted links of a page to its own host, and to files of any host.

    Relative links are taken from the page's address; order is that of first appearance.
    """
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    each = keyed.select("_row", F.col(base).alias("_base"), F.posexplode(F.filter(links(F.col(html)), lambda h: h.rlike(wanted))).alias("_at", "_href"))
    seen = each.withColumn("_url", absolute(F.col("_base"), F.col("_href"))).withColumn("_file", F.endswith(F.lower("_url"), F.lit(".pdf")))
    good = seen.where(F.col("_file") | (host_of(F.col("_url")) == host_of(F.col("_base")))).groupBy("_row", "_url", "_file").agg(F.min("_at").alias("_at"))
    listed = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(kind, F.struct("_at", "_url")))), lambda x: x["_url"])
    found = good.groupBy("_row").agg(F.slice(listed(~F.col("_file")), 1, pages).alias("pages"), F.slice(listed(F.col("_file")), 1, files).alias("files"))
    none = F.array().cast("array<string>")
    return keyed.join(found, "_row", "left").drop("_row").withColumn("pages", F.coalesce("pages", none)).withColumn("files", F.coalesce("files", none))


def guessed_links(found: Column, base: Column, most: int = 8) -> Column:
    """Found links and then the guessed paths of the base's host, each once, the first ``most``."""
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    guesses = F.array(*[F.concat(root, F.lit(p)) for p in GUESSED_PATHS])
    return F.slice(F.array_distinct(F.concat(found, guesses)), 1, most)


@F.pandas_udf(T.StringType())
def absolute(base: pd.Series, href: pd.Series) -> pd.Series:
    """A link's target as seen from a page; null for null."""
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)], dtype="object")


def embedded_fields(html: Column) -> Column:
    """Struct of address, lat, lng and phone that a page's embedded data holds; null where it doesn't."""
    found = lambda pattern, k=1: F.nullif(F.regexp_extract(html, pattern, k), F.lit(""))
    at = r"(?s)directionHref.*?Current\+Location/(-?[\d.]+),(-?[\d.]+)"
    number = lambda k: found(at, k).try_cast("double")
    return F.struct(found(r'\\"address\\":\\"(.*?)\\"').alias("address"), number(1).alias("lat"), number(2).alias("lng"), found(r'\\"phone\\":\\"([^\\"]+)\\"').alias("phone"))


def dish_parts(line: Column) -> Column:
    """struct<dish, description> of a line split once at a dash or colon."""
    parts = F.split(line, r"\s+[–—-]\s+|:\s+", 2)
    return F.struct(F.trim(parts[0]).alias("dish"), F.trim(F.get(parts, F.lit(1))).alias("description"))


def file_name(url: Column, default: Column) -> Column:
    """Last part of a URL's path without its query, or a default."""
    tail = F.element_at(F.split(F.split_part(url, F.lit("?"), F.lit(1)), "/"), -1)
    return F.when(tail == "", default).otherwise(tail)


def haystack(*parts: Column) -> Column:
    """One folded search string of several columns; nulls and empty ones are left out."""
    return fold(F.concat_ws(" • ", *[F.when(p != "", p) for p in parts]))


def opening_hours(html: Column) -> Column:
    """Opening hours of a page's JSON-LD, as JSON texts: of lists, of ``@graph`` and of single nodes.

    A node's specification goes before its plain hours; blocks that aren't JSON are skipped.
    """
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    parsed = F.filter(F.transform(blocks, F.try_parse_json), lambda v: v.isNotNull())
    own = F.flatten(F.transform(parsed, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    graph = lambda v: F.try_variant_get(v, '$["@graph"]', "array<variant>")
    nodes = F.flatten(F.transform(own, lambda v: F.when(graph(v).isNotNull(), F.concat(F.array(v), graph(v))).otherwise(F.array(v))))
    given = lambda v, k: F.try_variant_get(v, f"$.{k}", "string")
    return F.array_compact(F.transform(nodes, lambda v: F.coalesce(given(v, "openingHoursSpecification"), given(v, "openingHours"))))


def hours_in_text(html: Column, most: int = 14) -> Column:
    """The first distinct phrases of a weekday, or a range of them, with a range of clock times."""
    day = r"(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?"
    clock = r"\d{1,2}(?::\d{2})?\s*(?:am|pm)"
    span = rf"(?i)({day}\s*(?:(?:-|–|to|through)\s*{day}\s*)?:?\s*{clock}\s*(?:-|–|to)\s*{clock})"
    found = F.regexp_extract_all(F.regexp_replace(html, "<[^>]+>", " "), F.lit(span), F.lit(1))
    return F.slice(F.array_distinct(F.transform(found, F.trim)), 1, most)


def listed_rank(notes: Column) -> Column:
    """N of ``Ranked No. N``; null without."""
    return F.try_to_number(F.nullif(F.regexp_extract(notes, r"(?i)ranked no\. ?(\d+)", 1), F.lit("")), F.lit("999999")).cast("int")


def ranked_links(hrefs: Column, base: Column, wanted: str, blocked: str, first: str, pages: int = 8, files: int = 3) -> Column:
    """Struct of pages and files (PDF) among links: wanted ones of the base's host, or files of any host.

    Pages that match ``first`` go before others, then shorter ones; files stay in order of appearance.
    """
    host = lambda u: F.try_parse_url(u, F.lit("HOST"))
    is_file = lambda u: F.endswith(F.lower(u), F.lit(".pdf"))
    links_ = F.array_distinct(F.transform(hrefs, lambda u: F.regexp_replace(u, "#+$", "")))
    good = F.filter(links_, lambda u: F.startswith(u, F.lit("http")) & (u != base) & u.rlike(wanted) & ~u.rlike(blocked) & ((host(u) == host(base)) | is_file(u)))
    keyed = F.transform(F.filter(good, lambda u: ~is_file(u)), lambda u, i: F.struct(F.when(u.rlike(first), 0).otherwise(1).alias("k"), F.length(u).alias("n"), i.alias("i"), u.alias("u")))
    return F.struct(F.slice(F.transform(F.array_sort(keyed), lambda x: x["u"]), 1, pages).alias("pages"), F.slice(F.filter(good, is_file), 1, files).alias("files"))


def shares_run(a: Column, b: Column, n: int = 18) -> Column:
    """Whether two texts share a run of ``n`` characters after lower-casing and joining of non-words."""
    plain = lambda t: F.regexp_replace(F.lower(t), r"(?U)\W+", " ")
    runs = lambda t: F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substr(t, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.arrays_overlap(runs(plain(a)), runs(plain(b))), F.lit(False))


def most_central(text: str, patterns: Sequence[re.Pattern[str]]) -> tuple[int, int] | None:
    """Where the match lies whose middle is nearest the text's; the longest, then the first, of equally near ones."""
    # Twice the distance, so that halves stay whole numbers.
    found = [(abs(m.start() + m.end() - len(text)), m.start() - m.end(), i, m.start(), m.end()) for i, p in enumerate(patterns) for m in p.finditer(text) if m[0].strip()]
    return min(found)[3:] if found else None


def central_match(text: Column, pattern: str) -> Column:
    """The text of the ``most_central`` match of one pattern."""

    @F.pandas_udf(T.StringType())
    def find(texts: pd.Series) -> pd.Series:
        compiled = [re.compile(pattern, re.IGNORECASE)]
        return texts.map(lambda t: t[slice(*at)] if t and (at := most_central(t, compiled)) else None)

    return find(text)


def excerpt(text: str, start: int, stop: int, pad: int) -> str:
    """The text around [start, stop), ``pad`` characters each way, cut at spaces, with ellipses where cut."""
    left, right = max(0, start - pad), min(len(text), stop + pad)
    if left and (gap := text.find(" ", left, start)) >= 0:
        left = gap + 1
    if right < len(text) and (gap := text.rfind(" ", stop + 1, right)) >= 0:
        right = gap
    return "…" * (left > 0) + cleaned(text[left:right]) + "…" * (right < len(text))


def recentred(text: Column, start: Column, stop: Column, pad: int = 25) -> Column:
    """The text around [start, stop), ``pad`` characters each way, cut at spaces, with ellipses where cut."""
    a, b = F.greatest(start - pad, F.lit(0)), F.least(stop + pad, F.length(text))
    before, after = F.substr(text, a + 1, start - a), F.substr(text, stop + 1, b - stop)
    before = F.when((a > 0) & before.contains(" "), F.regexp_replace(before, r"^\S*\s+", "")).otherwise(before)
    after = F.when((b < F.length(text)) & after.contains(" "), F.regexp_replace(after, r"\s+\S*$", "")).otherwise(after)
    body = F.trim(F.concat(before, F.substr(text, start + 1, stop - start), after))
    return F.concat(F.when(a > 0, "…").otherwise(""), body, F.when(b < F.length(text), "…").otherwise(""))
