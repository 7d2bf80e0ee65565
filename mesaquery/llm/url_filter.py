"""URL filters: rules first, then a classifier on words that a Viterbi segmentation finds.

A rule names a host, which stands for its subdomains too, and a path prefix; the longest that fits
decides. Other URLs are scored by a classifier that learns from what the rules decide: concatenated
names in host and path are split into words by a unigram Viterbi search, and multinomial naive Bayes
compares an URL's words with those of blocked and of allowed URLs. Labelled words of the module count
as further labelled URLs.

Unigram counts come from the path tokens of all URLs, from the host tokens that several hosts share
(once for each host: a name of one host alone would pass for a word and never be split), and from
the labelled words. All words count and stay tables: the substrings of the names meet the counts in
a join, so that each name has the counts of what can make it up, and each distinct name is split and
weighed once. What a name sends grows with its length alone: words of over ``LONG`` letters are looked
for where their first letters are found. An unknown string of n letters costs as much as in a uniform model of its length, so
that names are kept whole unless known words explain them.

A rule labels the paths of all URLs that it fits, but a host only where it covers the host's every path,
and then once, however many URLs the host has: that a path of a host is blocked says nothing of the
host's other paths, which the rules leave open.

Naive Bayes has add-one smoothing over the words of labelled URLs; other words tell nothing, and
neither do those of the rules themselves: a rule's host and path are in all URLs that it labels, which
says something of the rule and nothing of other URLs. For the same reason the prior ``PRIOR`` is a
parameter, not the labels' share. An URL is blocked at a posterior probability over one half.

Defined results: a null URL or one without ``://`` has an empty host and path; an URL without a word
of a labelled one is allowed; null ids stay null; repeated rows are judged and learnt from each; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import saved, with_small
from mesaquery.llm.decontaminate import LOWER, UPPER

#: Labelled words, and how often labelled sites of their kind hold them. Words that
#: all kinds of sites hold (www, com, en) aren't labelled and so tell nothing.
STRONG = "adult xxx porn sex nude escort casino poker gambling slots jackpot viagra cialis pharmacy warez keygen hookup".split()
WEAK = "cam bet bets betting lottery win pills cheap replica spam farm seo backlinks crack torrent payday loans free dating".split()
ORDINARY = "news science sport culture health travel food music art books school university library museum city weather market research press media forum wiki article story".split()
BLOCKED = {w: 30 for w in STRONG} | {w: 8 for w in WEAK}
ALLOWED = {w: 8 for w in ORDINARY}
#: Words of at most this many letters, 18,278 at most, are broadcast: most names share their substrings.
SHORT_WORD = 3
#: Substrings that a worker hands on at once: a bound on memory.
PART_SUBSTRINGS = 50_000
#: Longer words are looked for by so many first letters.
LONG = 24
#: Share of unwanted URLs.
PRIOR = 0.1

Rule = tuple[str, str, str]  # verdict, host, path


def parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, of a URL."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substr({0}, instr({0}, '://') + 3)".format("url")))
    host = F.coalesce(F.regexp_extract(after, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Number of the longest rule that fits, or null; of equally long ones the first."""
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.lit(i)) for i in order for _, h, p in [rules[i]]]
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


@dataclass
class Words:
    """What the segmentation of all names shares."""

    total: float  # the number of counted words
    labelled: float  # what a labelled word's count is raised by
    longest: int  # letters of the longest known word
    known: frozenset[str]  # labelled words

    def segment(self, name: str, counts: Mapping[str, float]) -> list[str]:
        """The most probable words that make up ``name``, by Viterbi over word ends.

        ``counts`` has at least the substrings of ``name`` that were counted. Only lengths of words that
        are known are looked up; the best unknown string up to an end is kept along.
        """
        lengths = sorted({len(w) for w in (*counts, *self.known) if len(w) <= self.longest})
        letter, total = math.log(26), math.log(self.total)
        best, start = [0.0], [0]
        unknown, since = 0.0, 0  # best[since] + since * letter, the largest so far
        for end in range(1, len(name) + 1):
            top, at = unknown - end * letter - total, since
            for k in lengths:
                if k > end:
                    break
                word = name[end - k : end]
                if n := counts.get(word, 0.0) + (self.labelled if word in self.known else 0.0):
                    p = best[end - k] + math.log(n) - total
                    if p > top or p == top and end - k < at:
                        top, at = p, end - k
            best.append(top)
            start.append(at)
            if top + end * letter > unknown:
                unknown, since = top + end * letter, end
        out, end = [], len(name)
        while end:
            out.append(name[start[end] : end])
            end = start[end]
        return out[::-1]


def fit(urls: DataFrame, known: frozenset[str]) -> tuple[DataFrame, Words]:
    """Word counts (word, n) over the tokens of all URLs (host, path), and what all names share."""
    found = lambda c: F.explode(F.regexp_extract_all(F.translate(c, UPPER, LOWER), F.lit("([a-z]+)"), F.lit(1)))
    of_paths = urls.select(found("path").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    of_hosts = urls.select("host").distinct().select("host", found("host").alias("word")).distinct().groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    words = saved(of_paths.union(of_hosts).groupBy("word").agg(F.sum("n").alias("n")), "words")
    counted, longest = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max(F.length("word")), F.lit(0))).first()
    labelled = max(10.0, counted / 1000)
    return words, Words(counted + labelled * len(known), labelled, max(longest, *map(len, known)) if known else longest, known)


def learnt(seen: DataFrame, segments: DataFrame, blocked: Mapping[str, int], allowed: Mapping[str, int], ignored: Collection[str] = ()) -> DataFrame:
    """(word, odds): the log-odds that a word adds, from names (name, block, allow) of labelled URLs."""
    spark = seen.sparkSession
    words = with_small(seen, segments.select("name", "words"), ["name"], "inner").select(F.explode("words").alias("word"), "block", "allow")
    words = words.where(~F.col("word").isin(*ignored)) if ignored else words
    own = [(w, blocked.get(w, 0), allowed.get(w, 0)) for w in sorted({*blocked, *allowed})]
    given = words.union(spark.createDataFrame(own, "word string, block long, allow long")) if own else words
    counts = saved(given.groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "labelled")
    size, n_block, n_allow = counts.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0))).first()
    odds = F.log((F.col("block") + 1) / F.lit(float(n_block + size))) - F.log((F.col("allow") + 1) / F.lit(float(n_allow + size)))
    return counts.select("word", odds.alias("odds"))


def _substrings(names: DataFrame, lengths: range) -> DataFrame:
    """(number, at, word): all substrings of such lengths of (number, name)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, int, str]] = []
            for number, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a in range(len(name)):
                    held += [(number, a, name[a : a + k]) for k in lengths if a + k <= len(name)]
                    if len(held) > PART_SUBSTRINGS:
                        yield rows(held)
                        held = []
            if held:
                yield rows(held)

    def rows(held: list[tuple[int, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({k: pa.array(c) for k, c in zip(("number", "at", "word"), zip(*held, strict=True), strict=True)})

    return names.select("number", "name").mapInArrow(cut, "number long, at long, word string")


def _long_words(names: DataFrame, words: DataFrame) -> DataFrame:
    """(number, word, n) of the counted words of over ``LONG`` letters within names (number, name).

    A name's places are found by the first ``LONG`` letters; only there, and only at the lengths that
    words of that beginning have, is a longer substring looked at, as a digest.
    """
    lengths = words.groupBy(F.left("word", F.lit(LONG)).alias("word")).agg(F.collect_set(F.length("word")).alias("lengths"))
    places = _substrings(names, range(LONG, LONG + 1)).join(lengths, "word").groupBy("number").agg(F.collect_list(F.struct("at", "lengths")).alias("places"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [(number, hashlib.md5(name[p["at"] : p["at"] + k].encode()).hexdigest()) for number, name, found in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in found for k in p["lengths"] if p["at"] + k <= len(name)]
            for i in range(0, len(held), PART_SUBSTRINGS):
                yield pa.RecordBatch.from_pydict({k: pa.array(c) for k, c in zip(("number", "digest"), zip(*held[i : i + PART_SUBSTRINGS], strict=True), strict=True)})

    found = names.join(places, "number").select("number", "name", "places").mapInArrow(digests, "number long, digest string").distinct()
    return found.join(words.withColumn("digest", F.md5("word")), "digest").select("number", "word", "n")


def segments_of(names: DataFrame, words: DataFrame, model: Words) -> DataFrame:
    """name and words of distinct names, from the counts of their substrings.

    A name of n letters sends at most ``LONG`` substrings from each letter, of ``LONG`` letters at most, with its number.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segment(name, {r["word"]: float(r["n"]) for r in known or ()}) for name, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"name": batch.column(0), "words": pa.array(found, pa.list_(pa.string()))})

    names = saved(names.select(F.monotonically_increasing_id().alias("number"), "name"), "numbered-names")
    few = words.where(F.length("word") <= LONG)
    parts_ = _substrings(names, range(1, LONG + 1))
    n_words = words.count()
    short = F.length("word") <= SHORT_WORD
    met = parts_.join(F.broadcast(few), "word") if n_words <= 100_000 else parts_.where(short).join(F.broadcast(few.where(short)), "word").unionByName(with_small(parts_.where(~short), few.where(~short), ["word"], "inner", n_words))
    met = met.select("number", "word", "n")
    long_ = words.where(F.length("word") > LONG)
    if not long_.isEmpty():
        met = met.union(_long_words(names.where(F.length("name") > LONG), long_))
    counts = met.groupBy("number").agg(F.collect_set(F.struct("word", "n")).alias("counts"))
    return saved(names.join(counts, "number", "left").select("name", "counts").mapInArrow(split, "name string, words array<string>"), "segments")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", blocked: Mapping[str, int] = BLOCKED, allowed: Mapping[str, int] = ALLOWED) -> DataFrame:
    """page_id, host, path, rule, verdict, and the words and score of the method (null under a rule)."""
    url = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = parts(F.col("url"))
    rows = url.select("page_id", host.alias("host"), path.alias("path"))
    counts, model = fit(rows, frozenset({*blocked, *allowed}))
    found = lambda c: F.regexp_extract_all(F.translate(c, UPPER, LOWER), F.lit("([a-z]+)"), F.lit(1))
    ruled = rows.withColumn("number", rule_of(F.col("host"), F.col("path"), rules))
    of_rule = lambda values, kind: F.coalesce(*[F.when(F.col("number") == i, F.lit(v)) for i, v in enumerate(values)], F.lit(None).cast(kind))
    verdict, rule = of_rule([v for v, _, _ in rules], "string"), of_rule([h + p for _, h, p in rules], "string")
    whole_host = of_rule([p in ("", "/") for _, _, p in rules], "boolean")
    # Saved, so that each row keeps its number.
    rows = saved(ruled.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), whole_host.alias("whole_host"), found("host").alias("of_host"), found("path").alias("of_path")), "named")

    names = rows.select("row", "host", "verdict", "whole_host", F.size("of_host").alias("n_host"), F.posexplode(F.concat("of_host", "of_path")).alias("at", "name"))
    segments = segments_of(saved(names.select("name").distinct(), "names"), counts, model)
    of_rules = sorted({w for _, h, p in rules for w in re.findall("[a-z]+", f"{h}/{p}".lower())})
    by_rule = names.where("verdict IS NOT NULL")
    told = by_rule.where("at >= n_host").select("name", "verdict").unionByName(by_rule.where("at < n_host AND whole_host").select("host", "name", "verdict").distinct().drop("host"))
    seen = told.groupBy("name").agg(F.count_if(F.col("verdict") == "block").alias("block"), F.count_if(F.col("verdict") == "allow").alias("allow"))
    odds = learnt(seen, segments, blocked, allowed, of_rules)
    weighed = with_small(segments.select("name", F.explode("words").alias("word")), odds, ["word"], "inner").groupBy("name").agg(F.sum("odds").alias("odds"))
    weighed = saved(segments.join(weighed, "name", "left"), "weighed")

    open_ = with_small(names.where("verdict IS NULL").select("row", "at", "name"), weighed, ["name"], "inner")
    judged = open_.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"), F.sum("odds").alias("odds"))
    whole = rows.join(judged, "row", "left")
    score = F.when(F.col("verdict").isNull(), F.when(F.col("odds").isNull(), F.lit(PRIOR)).otherwise(1 / (1 + F.exp(-(F.col("odds") + math.log(PRIOR / (1 - PRIOR)))))))
    by_method = F.when(F.col("odds").isNotNull() & (score > 0.5), "block").otherwise("allow")
    words = F.when(F.col("verdict").isNull(), F.coalesce("words", F.array().cast("array<string>")))
    return whole.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), words.alias("words"), score.alias("score"))
