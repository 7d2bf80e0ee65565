"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of ASCII digits, letters (A-Z lower-cased) and characters beyond ASCII. A window is
``size`` consecutive words of a benchmark item, or all words of a shorter item.

1. *Winnow*: of every document, keep the smallest k-word hash in each sliding window of w positions,
   with k + w - 1 = size. Any shared span of ``size`` words then shares a kept hash; the same holds
   for the items. (An item of m < size words has one window; documents keep all their m-word
   hashes for each such length m that occurs.)
2. *Join* the kept hashes with those of the items, which gives the texts that may hold a window.
   Equal ones of these go on as one, and their kept hashes are joined again, with their places.
3. *Extend* each hit to the windows around it, size - k words to either side: they alone are hashed
   as a whole, by two independent 64-bit hashes, and joined with the items' windows. A window that
   occurs has its smallest k-word hash kept and hit, and is among them. Overlapping ones are merged.

Texts are told apart by md5, so that null, repeated and missing document ids make no difference.

Defined results: null, empty and wordless texts have no words and aren't contaminated; items without
words have no windows; an item without an id still hits words but isn't counted; repeated items count
once; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mesaquery.llm.common import drop, saved, unused, with_small

SIZE, K = 13, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, an empty array for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS)
    return F.array_remove(parts, "")


def _paired(name: str, shift: int, join: Callable[[Column, Column], Column]) -> Column:
    """Each entry of an array column joined with the one ``shift`` places on (null past the end)."""
    return F.transform(name, lambda x, i: join(x, F.get(name, i + shift)))


def _grams(df: DataFrame, size: int) -> DataFrame:
    """Add g<p> for the powers of two p up to ``size``: the hash of the p words from each place on.

    Places near the end have hashes of fewer words; ``_gram`` cuts them.
    """
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    p = 1
    while 2 * p <= size:
        df = df.withColumn(f"g{2 * p}", _paired(f"g{p}", p, F.xxhash64))
        p *= 2
    return df


def _gram(size: int) -> Column:
    """Hashes of all ``size``-word spans, by place, from two overlapping spans of a power of two."""
    p = 1 << size.bit_length() - 1
    whole = F.col(f"g{p}") if p == size else _paired(f"g{p}", size - p, F.xxhash64)
    return F.slice(whole, 1, F.greatest(F.size("words") - (size - 1), F.lit(0)))


def _kept(df: DataFrame, k: int, w: int) -> DataFrame:
    """Add ``low``: the minima of w consecutive k-word hashes, by place (none for shorter texts)."""
    df = df.withColumn("low1", _gram(k))
    p = 1
    while 2 * p <= w:
        df = df.withColumn(f"low{2 * p}", _paired(f"low{p}", p, F.least))
        p *= 2
    low = f"low{p}"
    if p < w:
        df, low = df.withColumn("lows", _paired(low, w - p, F.least)), "lows"
    return df.withColumn("low", F.slice(low, 1, F.greatest(F.size("words") - (k + w - 2), F.lit(0))))


def _prints(df: DataFrame, size: int, k: int, short: list[int]) -> DataFrame:
    """Rows (key, print) of the texts' kept hashes; ``short`` are the lengths below ``size``."""
    df = _kept(_grams(df, max([k, *short])), k, size - k + 1)
    every = [F.array_distinct("low")] + [F.array_distinct(_gram(m)) for m in short]
    # The outer form: for the inner one the optimiser infers a filter on the array, pushes it below
    # all projections, and so evaluates each of them again inside the next one's lambda.
    return df.select("key", F.explode_outer(F.concat(*every) if short else every[0]).alias("print")).where("print IS NOT NULL")


def _placed(texts: DataFrame, size: int, k: int, short: list[int]) -> DataFrame:
    """Rows (key, m, at, print) of the texts' kept hashes with their places."""
    w = size - k + 1
    df = _kept(_grams(texts, max([k, *short])), k, w).withColumn("gram", _gram(k))
    places = F.array_distinct(F.transform("low", lambda x, j: (F.array_position(F.slice("gram", j + 1, w), x) - 1 + j).cast("int")))
    own = F.transform(places, lambda i: F.struct(F.lit(size).alias("m"), i.alias("at"), F.get("gram", i).alias("print")))

    def at_every_place(m: int) -> Column:
        return F.transform(_gram(m), lambda x, i: F.struct(F.lit(m).alias("m"), i.cast("int").alias("at"), x.alias("print")))

    return df.select("key", F.explode_outer(F.concat(own, *map(at_every_place, short))).alias("p")).where("p IS NOT NULL").select("key", "p.*")


def _spans_of(m: int) -> Callable[[Column], Column]:
    return lambda i: F.slice("words", i + 1, m)


def _hashes(span: Column) -> tuple[Column, Column]:
    """Two independent hashes of a whole window."""
    return F.xxhash64(F.lit("hash"), span).alias("hash"), F.xxhash64(F.lit("check"), span).alias("check")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, k: int = K, share: int = 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """key (md5), n_hit, n_items, items_sha256, contaminated of each distinct text in which a window occurs.

    A text is contaminated if at least one in ``share`` of its words lies in an occurrence.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("m", F.least(F.size("words"), F.lit(size)))
    short = sorted(r[0] for r in items.where(F.col("m") < size).select("m").distinct().collect())  # below size values
    lengths = [*short, size]
    spans = reduce(DataFrame.union, [items.where(F.col("m") == m).select("item", "m", F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - m), _spans_of(m))).alias("span")) for m in lengths])
    spans = saved(spans.select("item", "m", "span", *_hashes(F.col("span"))).distinct(), "spans")
    windows = saved(spans.select("m", "hash", "check").distinct(), "windows")
    prints = [_prints(spans.where(F.col("m") == m).select(F.lit(0).alias("key"), F.col("span").alias("words")), *((size, k) if m == size else (m, m)), []).select(F.lit(m).alias("m"), "print") for m in lengths]
    prints = saved(reduce(DataFrame.union, prints).distinct(), "prints")

    keyed = docs.select(F.col(text_col).alias("text"), F.md5(F.col(text_col).cast("binary")).alias("key"))
    split = keyed.select("key", words(F.col("text")).alias("words"))
    suspects = saved(with_small(_prints(split, size, k, short), prints.select("print").distinct(), ["print"], "left_semi").select("key").distinct(), "suspects")
    texts = with_small(keyed, suspects, ["key"], "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    texts = saved(texts.select("key", words(F.col("text")).alias("words")), "texts")

    hits = with_small(_placed(texts, size, k, short), prints, ["m", "print"], "left_semi")
    reach = F.when(F.col("m") == size, size - k).otherwise(0)
    around = hits.select("key", "m", F.explode(F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.col("at"))).alias("at")).distinct()
    starts = around.groupBy("key").agg(F.collect_list(F.struct("m", "at")).alias("starts"))  # places of one text
    whole = F.transform(F.filter("starts", lambda x: x["at"] + x["m"] <= F.size("words")), lambda x: F.struct(x["m"].alias("m"), x["at"].alias("at"), *_hashes(F.slice("words", x["at"] + 1, x["m"]))))
    tried = texts.join(starts, "key").select("key", F.explode_outer(whole).alias("w")).where("w IS NOT NULL").select("key", "w.*")
    found = saved(with_small(tried, windows, ["m", "hash", "check"], "left_semi"), "found")

    order = Window.partitionBy("key").orderBy("at", "m")
    before = F.max(F.col("at") + F.col("m")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = found.select("key", (F.col("at") + F.col("m") - F.greatest(F.col("at"), F.least(F.coalesce(before, F.lit(0)), F.col("at") + F.col("m")))).alias("new"))
    hit_words = merged.groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    of_item = saved(spans.where("item IS NOT NULL").select("m", "hash", "check", "item").distinct(), "of-item")
    named = with_small(found.select("key", "m", "hash", "check").distinct(), of_item, ["m", "hash", "check"], "inner").select("key", "item").distinct()
    listed = named.groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    n_words = texts.select("key", F.size("words").alias("n_words"))
    verdict = hit_words.join(listed, "key", "left").join(n_words, "key")
    n_items, digest = F.coalesce(F.size("items"), F.lit(0)).cast("long"), F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256)
    verdict = saved(verdict.select("key", "n_hit", n_items.alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") * share >= F.col("n_words")).alias("contaminated")), "verdict")
    drop(spans, windows, prints, suspects, texts, found, of_item)
    return verdict


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, k: int = K, share: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    verdict = contaminated_texts(docs, benchmark, size, k, share, text_col, item_col, item_text_col)
    text = F.col(text_col)
    n_words = F.size(words(text)).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), n_words.alias("n_words"), F.md5(text.cast("binary")).alias("key"))
    judged = with_small(counted, verdict, ["key"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_hit", "n_items")]
    return judged.select("doc_id", "n_words", *zero, F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce("contaminated", F.lit(False)).alias("contaminated"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts aren't contaminated."""
    verdict = contaminated_texts(docs, benchmark, text_col=text_col)
    key = unused(docs, "_text_md5")
    marked = docs.withColumn(key, F.md5(F.col(text_col).cast("binary")))
    return with_small(marked, verdict.where("contaminated").select(F.col("key").alias(key)), [key], "left_anti").drop(key)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
ds AS (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS s FROM dp, (SELECT DISTINCT m FROM bw) WHERE i + m - 1 <= len(w)),
hit AS (SELECT DISTINCT doc_id, i, ds.m, item_id FROM ds JOIN bw ON ds.s = bw.s AND ds.m = bw.m),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN it USING (doc_id)
"""
