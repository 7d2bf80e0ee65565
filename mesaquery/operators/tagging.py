"""Tagging free text by configured patterns, section headers, and budgets for quoted text."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.functions.text import cleaned, excerpt, most_central, snippet
from mesaquery.operators.tables import parts_of


@dataclass(frozen=True)
class TagRule:
    tag: str
    pattern: str
    confidence: str = "high"


def rules_of(config: dict[str, list[dict]]) -> list[TagRule]:
    """Rules of a configuration; keys that start with an underscore are comments."""
    return [TagRule(t, r["pattern"], r.get("confidence", "high")) for t, rs in config.items() if not t.startswith("_") for r in rs]


def _hits(text: Column, rules: list[TagRule]) -> Column:
    each = [F.struct(F.lit(i).alias("rule"), F.lit(r.tag).alias("tag"), F.lit(r.confidence).alias("confidence"), F.regexp_count(text, F.lit(r.pattern)).alias("n"), snippet(text, r.pattern).alias("snippet")) for i, r in enumerate(rules)]
    return F.filter(F.array(*each), lambda h: h["n"] > 0)


def tag_items(rows: DataFrame, text: str, rules: list[TagRule]) -> DataFrame:
    """One row for each item and tag: the last high hit if there's one, else the first."""
    hits = rows.withColumn("h", F.explode(_hits(F.col(text), rules))).select(*rows.columns, "h.*")
    keys = [c for c in rows.columns if c != text]
    pick = F.max_by(F.struct("confidence", "snippet"), F.when(F.col("confidence") == "high", 1000 + F.col("rule")).otherwise(-F.col("rule")))
    return hits.groupBy(*keys, "tag").agg(pick.alias("p")).select(*keys, "tag", "p.confidence", "p.snippet")


def tag_text(rows: DataFrame, text: str, rules: list[TagRule]) -> DataFrame:
    """Rows (tag, confidence, n): every rule's matches in whole texts; patterns are columns of one scan."""
    return rows.withColumn("h", F.explode(_hits(F.col(text), rules))).select(*[c for c in rows.columns if c != text], "h.tag", "h.confidence", "h.rule", F.col("h.n").cast("long").alias("n"))


def _folded_char(c: str) -> str:
    return (c.upper()[:1].lower() or c)[:1]


class _Folds(dict):
    def __missing__(self, point: int) -> str:
        self[point] = _folded_char(chr(point))
        return self[point]


_folds = _Folds()


def comparable(text: str) -> str:
    """A text in which letters that a pattern may take for each other are the same, one for each letter."""
    return text.lower() if text.isascii() else text.translate(_folds)


def needed_texts(pattern: str) -> tuple[str, ...] | None:
    """Texts one of which each match of a pattern holds, as ``comparable`` has them; None if none is certain.

    Flags at the pattern's start are passed over, as comparable texts fit any case. A pattern with
    escapes that other readings of patterns take differently, or that Python can't read, is of the latter.
    """
    flags = re.match(r"\(\?([a-zA-Z]+)\)", pattern)
    if flags and "x" in flags[1] or re.search(r"\\[^\WAbBdDfnrsStuwW]", pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            parsed = re._parser.parse(pattern[flags.end() :] if flags else pattern)
    except (re.error, Warning, OverflowError, RecursionError):
        return None
    return _needed(list(parsed))


def _needed(items: list) -> tuple[str, ...] | None:
    found: list[tuple[str, ...]] = []
    run = ""
    for kind, value in [*items, (None, None)]:
        if str(kind) == "LITERAL":
            run += chr(value)
            continue
        if run:
            found.append((comparable(run),))
            run = ""
        if str(kind) == "SUBPATTERN":
            inner = _needed(list(value[3]))
        elif str(kind) in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            inner = _needed(list(value[2]))
        elif str(kind) == "BRANCH":
            each = [_needed(list(b)) for b in value[1]]
            inner = None if None in each else tuple(sorted({x for ts in each for x in ts}))
        else:
            inner = None
        if inner:
            found.append(inner)
    # The best one is what is rarest: its shortest text is longest.
    return max(found, key=lambda ts: (min(map(len, ts)), -len(ts)), default=None)


def candidate_rules(text: Column, rules: Sequence[TagRule]) -> Column:
    """Numbers of the rules that a text may match: those whose needed texts it holds, found in one scan, and those without."""
    always = [i for i, r in enumerate(rules) if needed_texts(r.pattern) is None]
    needs = [(t, i) for i, r in enumerate(rules) for t in needed_texts(r.pattern) or ()]

    @F.pandas_udf("array<int>")
    def find(texts: pd.Series) -> pd.Series:
        import ahocorasick

        of: dict[str, list[int]] = {}
        for t, i in needs:
            of.setdefault(t, []).append(i)
        automaton = ahocorasick.Automaton()
        for t, numbers in of.items():
            automaton.add_word(t, numbers)
        if needs:
            automaton.make_automaton()
        return texts.map(lambda t: None if t is None else sorted({*always, *(i for _, ns in (automaton.iter(comparable(t)) if needs else ()) for i in ns)}))

    return find(text)


#: Rows and bytes of the texts that a Python worker gets at once.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def tag_text_by_needs(rows: DataFrame, text: str, rules: Sequence[TagRule]) -> DataFrame:
    """``tag_text`` for many rules: a pattern runs only over texts that hold what each of its matches needs."""
    spark = rows.sparkSession
    # Texts are of any length: small batches keep a worker's memory bounded.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    table = spark.createDataFrame([(i, r.tag, r.confidence, r.pattern) for i, r in enumerate(rules)], "rule int, tag string, confidence string, _pattern string")
    kept = [c for c in rows.columns if c != text]
    met = rows.withColumn("rule", F.explode(candidate_rules(F.col(text), rules))).join(F.broadcast(table), "rule")  # the rules of a configuration
    counted = met.withColumn("n", F.regexp_count(F.col(text), F.col("_pattern")).cast("long")).where("n > 0")
    return counted.select(*kept, "tag", "confidence", "rule", "n")


def best_hits(hits: DataFrame, key: str, top: int, position: str) -> DataFrame:
    """Of each key and tag the best ``top`` hits after removal of equal snippets: high first, then short."""
    rank = F.when(F.col("confidence") == "high", 0).otherwise(1)
    same = Window.partitionBy(key, "tag", F.lower("snippet")).orderBy(rank, position)
    order = Window.partitionBy(key, "tag").orderBy(rank, F.length("snippet"), position)
    once = hits.withColumn("_d", F.row_number().over(same)).where("_d = 1")
    return once.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= top).drop("_d")


#: Lines of a document that are read in order by one task.
PART_LINES = 50_000


def with_headers(lines: DataFrame, doc: str, position: str, text: str, is_header: Column, part_lines: int = PART_LINES) -> DataFrame:
    """Add ``header``: the last header line at or before each line of a document; null before the first.

    A document is cut by position into parts of ``part_lines``, each filled on its own; the last header
    of the parts before is carried on over one row for each part.
    """
    n = parts_of(lines.count())
    parts = lines.withColumn("_part", F.floor(F.col(position) / part_lines)).repartition(n, doc, "_part")
    order = Window.partitionBy(doc, "_part").orderBy(position)
    own = F.last(F.when(is_header, F.col(text)), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    filled = parts.withColumns({"_own": own, "_more": F.lead(F.lit(True)).over(order)})
    # The last line of a part tells its last header.
    ends = filled.where("_more IS NULL AND _part IS NOT NULL").select(F.col(doc).alias("_doc"), F.col("_part").alias("_of"), F.col("_own").alias("_end")).repartition(n, "_doc")
    before = Window.partitionBy("_doc").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).where("_carried IS NOT NULL").drop("_end")
    joined = filled.join(carried, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_part") == F.col("_of")), "left")
    return joined.select(*lines.columns, F.coalesce("_own", "_carried").alias("header"))


def representative(hits: DataFrame, key: str, text: str = "matched") -> DataFrame:
    """Of each key and tag the hit that stands for it: high first, then an item's, then the shortest, then by text."""
    order = Window.partitionBy(key, "tag").orderBy(F.when(F.col("confidence") == "high", 0).otherwise(1), F.when(F.col("source") == "item", 0).otherwise(1), F.length(text), text)
    return hits.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


@dataclass(frozen=True)
class QuoteBudget:
    """How much of a source may be quoted, and how."""

    share: float = 0.045  # of the source's characters
    floor: int = 36  # characters that any source allows
    gap: int = 60  # characters between two quotations of a source
    run: int = 18  # characters in a row that two quotations may not share
    pads: tuple[int, ...] = (25, 21, 17, 13, 9, 5)  # around the keyword, the widest that fits

    def quotes(self, matched: str, at: tuple[int, int] | None) -> list[str]:
        """The quotations of a hit whose keyword lies at ``at``, the widest first."""
        return [cleaned(matched[: 2 * pad])[: 2 * pad] if at is None else excerpt(matched, *at, pad) for pad in self.pads]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(text: Column, n: int) -> Column:
    """The runs of ``n`` letters of a text, lower-cased and with what isn't a word as one space."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " ")
    return F.when(F.length(plain) >= n, F.transform(F.sequence(F.lit(1), F.length(plain) - (n - 1)), lambda i: F.substr(plain, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def _folded(hits: Column, source: Column, budget: QuoteBudget) -> Column:
    """Decide hits in order: each quotation takes room of the source and bars what comes near or repeats it.

    Hits have (tag, confidence, source, keyword, quotes), the widest quotation first. The state is the room
    that is left, where the source was quoted, and the runs of letters that were.
    """
    start = F.struct(
        F.greatest(F.lit(budget.floor), F.floor(F.length(source) * budget.share).cast("int")).alias("room"),
        F.array().cast("array<struct<a:int,b:int>>").alias("spans"),
        F.array().cast("array<string>").alias("runs"),
        F.array().cast("array<struct<tag:string,confidence:string,source:string,keyword:string,quotation:string>>").alias("made"),
    )
    whole = source != ""

    def decide(state: Column, hit: Column, core: Column, quote: Column, runs: Column) -> Column:
        a = (F.instr(source, core) - 1).cast("int")
        b = (a + F.length(core)).cast("int")
        apart = F.forall(state["spans"], lambda s: (a >= s["b"] + budget.gap) | (b <= s["a"] - budget.gap))
        fits = ~F.arrays_overlap(state["runs"], runs) & (~whole | (F.length(core) <= state["room"]) & ((a < 0) | apart))
        made = F.struct(hit["tag"].alias("tag"), hit["confidence"].alias("confidence"), hit["source"].alias("source"), hit["keyword"].alias("keyword"), F.when(fits, quote).alias("quotation"))
        return F.struct(
            F.when(fits & whole, state["room"] - F.length(core)).otherwise(state["room"]).cast("int").alias("room"),
            F.when(fits & whole, F.concat(state["spans"], F.array(F.struct(a.alias("a"), b.alias("b"))))).otherwise(state["spans"]).alias("spans"),
            F.when(fits, F.concat(state["runs"], _runs(quote, budget.run))).otherwise(state["runs"]).alias("runs"),
            F.concat(state["made"], F.array(made)).alias("made"),
        )

    def step(state: Column, hit: Column) -> Column:
        core = lambda q: F.trim(F.regexp_replace(q, "^…+|…+$", ""))
        fitting = F.get(F.filter(hit["quotes"], lambda q: F.length(core(q)) <= state["room"]), F.lit(0))
        widest = F.get(hit["quotes"], F.lit(0))
        quote = F.when(whole, F.coalesce(fitting, F.element_at(hit["quotes"], -1))).otherwise(widest)
        # What a narrower quotation leaves out was still beside it: the widest is compared.
        return _let(F.struct(quote.alias("q"), core(quote).alias("c"), _runs(widest, budget.run).alias("r")), lambda x: decide(state, hit, x["c"], x["q"], x["r"]))

    return F.aggregate(hits, start, step)["made"]


def quoted(hits: DataFrame, sources: DataFrame, key: str, rules: Sequence[TagRule], text: str = "matched", budget: QuoteBudget = QuoteBudget()) -> DataFrame:
    """key, tag, confidence, source, keyword, quotation: one hit of each tag, quoted within the source's budget.

    ``hits`` has (key, tag, confidence, source, text), ``sources`` (key, raw). A hit's keyword and possible
    quotations depend on it alone; which of them is published depends on the earlier ones of the key, by
    tag, so that a key's few hits are folded in order over its source, which Python never sees.
    """
    rule_texts: dict[str, list[str]] = {}
    for r in rules:
        rule_texts.setdefault(r.tag, []).append(r.pattern)
    best = representative(hits.where(F.col("tag").isin(*rule_texts)), key, text)

    @F.pandas_udf("struct<keyword:string,quotes:array<string>>")
    def read(tags: pd.Series, texts: pd.Series) -> pd.DataFrame:
        patterns = {t: [re.compile(p, re.IGNORECASE) for p in ps] for t, ps in rule_texts.items()}
        found = [most_central(m, patterns[t]) for t, m in zip(tags, texts, strict=True)]
        return pd.DataFrame({"keyword": [cleaned(m[slice(*at)]) if at else None for m, at in zip(texts, found, strict=True)], "quotes": [budget.quotes(m, at) for m, at in zip(texts, found, strict=True)]})

    told = best.withColumn("_read", read(F.col("tag"), F.col(text)))
    listed = told.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("tag", "confidence", "source", "_read.keyword", "_read.quotes"))).alias("_hits"))
    joined = listed.join(sources.select(key, F.coalesce(F.trim(F.regexp_replace("raw", r"(?U)[\s\x1C-\x1F]+", " ")), F.lit("")).alias("_raw")), key, "left")
    made = joined.select(key, F.explode(_folded(F.col("_hits"), F.coalesce("_raw", F.lit("")), budget)).alias("x"))
    return made.select(key, "x.*")
