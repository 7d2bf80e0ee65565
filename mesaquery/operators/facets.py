"""Declarative faceted queries: OR within a facet, AND across facets, leave-one-out counts."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import parse_qsl, quote, unquote, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.functions.text import fold, folded


@dataclass(frozen=True)
class Facet:
    """A name, the array of a row's values as an expression, and how it's shown."""

    key: str
    values: Column
    seed: tuple[str, ...] = ()
    title: str = ""
    labels: Mapping[str, str] = field(default_factory=dict)
    note: str = ""

    def label(self, value: str) -> str:
        return self.labels.get(value, value)


@dataclass(frozen=True)
class Sort:
    """Sort keys as (column, descending); nulls come last either way; the last key should be unique."""

    keys: tuple[tuple[str, bool], ...]

    def columns(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in self.keys]


@dataclass(frozen=True)
class QuerySpec:
    """What a user selected; ``to_params`` and ``from_params`` carry it in a URL.

    ``open_on`` keeps rows of unknown end, ``closes_by`` drops them; ``floor`` drops unrated rows.
    """

    selected: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    text: str = ""
    floor: float | None = None
    sort: str = ""
    page: int = 0
    open_on: str | None = None
    closes_by: str | None = None
    saved: bool = False
    view: str = ""

    def to_params(self) -> str:
        """Values are quoted before they are joined, so that any text comes back; ``by`` is always there."""
        parts = {k: "~".join(quote(x, safe="").replace("~", "%7E") for x in v) for k, v in sorted(self.selected.items()) if v}
        parts["by"] = self.open_on or "any"
        parts |= {k: str(v) for k, v in (("q", self.text), ("to", self.closes_by), ("sort", self.sort), ("page", self.page), ("view", self.view)) if v}
        if self.floor is not None:
            parts["minr"] = str(self.floor)
        if self.saved:
            parts["saved"] = "1"
        return urlencode(parts)

    @classmethod
    def from_params(cls, params: str, sorts: Collection[str] = (), facets: Collection[str] = (), today: str | None = None) -> QuerySpec:
        """Unknown facets and sorts are dropped; without ``by`` the date is today's."""
        got = dict(parse_qsl(params))
        chosen = {k: tuple(unquote(x) for x in v.split("~") if x) for k, v in got.items() if k in facets}
        by = got.get("by", today)
        number = lambda kind, text: kind(text) if re.fullmatch(r"\d+(\.\d+)?", text) else None
        sort = got["sort"] if got.get("sort") in sorts else ""
        return cls({k: v for k, v in chosen.items() if v}, got.get("q", ""), number(float, got.get("minr", "")), sort, int(number(float, got.get("page", "")) or 0), None if by == "any" else by, got.get("to"), got.get("saved") == "1", got.get("view", ""))

    def active(self) -> int:
        """How many filters are on: each chosen value counts."""
        return sum(map(len, self.selected.values())) + sum((bool(self.text), self.floor is not None, bool(self.open_on), bool(self.closes_by), self.saved))

    def listed(self, facets: Sequence[Facet] = (), unrated: int = 0) -> list[tuple[str, str, QuerySpec]]:
        """Active filters as (title, value, the same without it); a floor says how many unrated rows it hides."""
        out = []
        for f in facets:
            for v in (chosen := self.selected.get(f.key, ())):
                rest = tuple(x for x in chosen if x != v)
                out.append((f.title or f.key, f.label(v), replace(self, selected={**self.selected, f.key: rest})))
        if self.floor is not None:
            out.append(("Rating", f"{self.floor:.1f}+" + (f" · {unrated} unrated hidden" if unrated else ""), replace(self, floor=None)))
        off = (("Open on", "open_on", None), ("Closes by", "closes_by", None), ("Shortlist", "saved", False), ("Search", "text", ""))
        return out + [(title, str(value), replace(self, **{name: none})) for title, name, none in off if (value := getattr(self, name))]

    def reset(self) -> QuerySpec:
        """Nothing filtered, in the same sort: what a deep link to a hidden row needs."""
        return QuerySpec(sort=self.sort)


@dataclass(frozen=True)
class Preset:
    """A named selection: what it sets, and the rows that it counts."""

    key: str
    spec: QuerySpec
    rows: Column

    def is_on(self, current: QuerySpec) -> bool:
        chosen = all(set(v) <= set(current.selected.get(k, ())) for k, v in self.spec.selected.items())
        return chosen and all(getattr(current, x) == getattr(self.spec, x) for x in ("closes_by", "saved") if getattr(self.spec, x))

    def toggled(self, current: QuerySpec) -> QuerySpec:
        """The preset alone; nothing selected if it was on."""
        return QuerySpec(sort=current.sort) if self.is_on(current) else replace(self.spec, sort=self.spec.sort or current.sort)


def passes(facet: Facet, chosen: tuple[str, ...]) -> Column:
    """Whether a row has any chosen value; all rows pass without a choice."""
    if not chosen:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(facet.values, F.array(*map(F.lit, chosen))), F.lit(False))


def matching(rows: DataFrame, facets: Sequence[Facet], spec: QuerySpec, haystack: Column | None = None, rating: Column | None = None, end: Column | None = None, saved: DataFrame | None = None, key: str = "slug") -> DataFrame:
    """Rows that pass all facets and filters of ``spec`` whose columns are given.

    ``haystack`` is folded text, and the searched text is folded alike; ``saved`` has the saved keys.
    """
    tests = [passes(f, spec.selected.get(f.key, ())) for f in facets]
    if spec.text and haystack is not None:
        tests.append(F.contains(haystack, F.lit(folded(spec.text))))
    if spec.floor is not None and rating is not None:
        tests.append(rating >= spec.floor)
    if spec.open_on and end is not None:
        tests.append(end.isNull() | (end >= F.lit(spec.open_on).cast("date")))
    if spec.closes_by and end is not None:
        tests.append(end <= F.lit(spec.closes_by).cast("date"))
    found = rows.where(reduce(Column.__and__, tests, F.lit(True)))
    return found.join(saved.select(key).distinct(), key, "left_semi") if spec.saved and saved is not None else found


def facet_counts(rows: DataFrame, facets: list[Facet], spec: QuerySpec) -> DataFrame:
    """facet, value, n: rows with the value that pass every other facet; one pass over the rows.

    A row counts for a facet if all facets but at most that one pass. Seeded and chosen values are
    listed with 0.
    """
    oks = [passes(f, spec.selected.get(f.key, ())) for f in facets]
    failed = reduce(Column.__add__, [(~ok).cast("int") for ok in oks])
    flat = F.array(*[F.struct(F.lit(f.key).alias("facet"), F.when(failed - (~ok).cast("int") == 0, F.array_distinct(f.values)).alias("values")) for f, ok in zip(facets, oks, strict=True)])
    each = rows.select(F.explode(flat).alias("f")).select("f.facet", F.explode("f.values").alias("value")).where("value IS NOT NULL")
    counted = each.groupBy("facet", "value").agg(F.count("*").alias("n"))
    seeds = [(f.key, v) for f in facets for v in {*f.seed, *spec.selected.get(f.key, ())}]
    if not seeds:
        return counted
    zero = rows.sparkSession.createDataFrame(seeds, "facet string, value string").withColumn("n", F.lit(0).cast("long"))
    return counted.union(zero).groupBy("facet", "value").agg(F.sum("n").alias("n"))


def found_filters(counts: DataFrame, facets: Sequence[Facet], text: str) -> DataFrame:
    """Counts of values whose label, or whose facet's title, holds a text."""
    wanted = folded(text)
    whole = [f.key for f in facets if wanted in folded(f.title or f.key)]
    named = [F.struct(F.lit(f.key).alias("facet"), F.lit(v).alias("value")) for f in facets for v, label in f.labels.items() if wanted in folded(label)]
    plain = {f.key: [*f.labels] for f in facets}
    unlabelled = reduce(Column.__and__, [~((F.col("facet") == k) & F.col("value").isin(*v)) for k, v in plain.items() if v], F.lit(True))
    hit = F.col("facet").isin(*whole) | unlabelled & F.contains(fold(F.col("value")), F.lit(wanted))
    return counts.where(hit | F.array_contains(F.array(*named), F.struct("facet", "value")) if named else hit)


def value_order(counts: DataFrame, facets: Sequence[Facet], numeric: Collection[str] = (), frequent: Collection[str] = ()) -> DataFrame:
    """Add ``pos``: by the number in a value, by count and value, or by label, as the facet is shown."""
    pairs = [F.lit(x) for f in facets for v, label in f.labels.items() for x in (f"{f.key}\n{v}", label)]
    label = F.coalesce(F.try_element_at(F.create_map(*pairs), F.concat_ws("\n", "facet", "value")), F.col("value")) if pairs else F.col("value")
    number = F.coalesce(F.nullif(F.regexp_replace("value", r"\D", ""), F.lit("")).try_cast("long"), F.lit(0))
    first = F.when(F.col("facet").isin(*numeric), number).when(F.col("facet").isin(*frequent), -F.col("n")).otherwise(0)
    order = Window.partitionBy("facet").orderBy(first, F.when(F.col("facet").isin(*numeric, *frequent), F.col("value")).otherwise(label), "value")
    return counts.withColumn("pos", F.row_number().over(order))


def capped_values(counts: DataFrame, cap: int = 12, above: int = 15, chosen: tuple[str, ...] = ()) -> DataFrame:
    """Of facets of more than ``above`` values the ``cap`` most frequent, and chosen ones beyond."""
    order = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("pos", F.row_number().over(order)).withColumn("of", F.count("*").over(Window.partitionBy("facet")))
    return ranked.where((F.col("of") <= above) | (F.col("pos") <= cap) | F.col("value").isin(*chosen)).drop("of")


def relevance_of(low: Column, text: str) -> Column:
    """``relevance`` of a folded name to a folded text."""
    prefix = F.exists(F.split(low, "[^a-z0-9']+"), lambda w: F.startswith(w, F.lit(text)))
    return F.when(low == text, 0).when(F.startswith(low, F.lit(text)), 1).when(prefix, 2).when(F.contains(low, F.lit(text)), 3).otherwise(4)


def relevance(name: Column, text: str) -> Column:
    """0 exact, 1 prefix, 2 prefix of a word, 3 within, 4 elsewhere, all of folded texts."""
    return relevance_of(fold(name), folded(text))


def page_of(rows: DataFrame, sort: Sort, page: int, size: int = 50) -> DataFrame:
    """One page of sorted rows."""
    return rows.orderBy(*sort.columns()).offset(page * size).limit(size)


def presets(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """preset, n: how many rows each named predicate holds for, in one pass."""
    names = list(tests)
    counts = rows.agg(*[F.count_if(F.coalesce(tests[n], F.lit(False))).alias(n) for n in names])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) AS (preset, n)")


def named_sorts(rank: str = "rank", name: str = "name") -> dict[str, Sort]:
    """The sorts by name; each ends in the name. Their names are fixed values: URLs hold them."""
    keys: dict[str, tuple[tuple[str, bool], ...]] = {
        "rubric_desc": (("rubric", True),),
        "google_desc": (("rating_weighted", True),),
        "google_raw_desc": (("rating", True), ("reviews", True)),
        "distinction": (("recognition_rank", False), ("recognition_year", True)),
        "best": (("trust", False), (rank, False), ("gap_usd", True)),
        "gap_usd_desc": (("gap_usd", True),),
        "gap_pct_desc": (("gap_pct", True),),
        "price_asc": (("price", False),),
        "price_desc": (("price", True),),
        "end_asc": (("end_date", False),),
        "end_desc": (("end_date", True),),
        "walk_asc": (("walk", False),),
        "name_asc": (),
        "rank_asc": ((rank, False),),
    }
    return {k: Sort((*v, (name, False))) for k, v in keys.items()}


def walk_key(routes: Column, nearest: Column, chosen: tuple[str, ...] = ()) -> Column:
    """Least minutes over the chosen lines of a map; the nearest station's where none is chosen."""
    if not chosen:
        return nearest
    return F.array_min(F.transform(F.array(*map(F.lit, chosen)), lambda k: F.try_element_at(routes, k)))


def first_match(rows: DataFrame, key: str, name: str, position: str, text: str) -> DataFrame:
    """The row of the key ``text``, else the first whose name holds it; no row if none does."""
    low = text.lower()
    found = rows.withColumn("_p", F.when(F.col(key) == low, 0).when(F.contains(F.lower(name), F.lit(low)), 1)).where("_p IS NOT NULL")
    return found.orderBy("_p", position).limit(1).drop("_p")


def bounds(rows: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """One row: how many rows have coordinates and how many lack them, and the box around them."""
    there = F.col(lat).isNotNull() & F.col(lng).isNotNull()
    at = lambda c: F.when(there, F.col(c))
    return rows.agg(F.count_if(there).alias("shown"), F.count_if(~there).alias("missing"), F.min(at(lat)).alias("south"), F.max(at(lat)).alias("north"), F.min(at(lng)).alias("west"), F.max(at(lng)).alias("east"))
