"""Exact Jaccard self-join on word n-grams by token-combination prefixes.

A document's set holds the 64-bit hashes of its distinct n-word shingles. All sets are ordered by
one global order: tokens by their estimated document frequency, then by hash. Let a set of size n
link with another at similarity t: at most e = n - ceil(t n) of its tokens are missing in the other.

* Tokens are of two classes. *Rare* tokens are indexed alone, *frequent* ones (whose estimated
  frequency exceeds ``frequent`` of the documents) in combinations of ``k``.
* Frequent tokens are dealt by hash into m classes, where a class with c tokens in the prefix is
  worth max(0, c - k + 1), as two sets that share no combination of a class share at most k - 1
  tokens of it; a rare token is worth 1. The prefix is the shortest one worth e + 1.
* If two sets link, the prefix that ends first in the global order has more worth than tokens can be
  missing in the other set, so that some token or combination of it lies in both prefixes.
* m follows a set's size level (a power of two), so that combinations grow with the prefix and not
  with its power. A set is indexed at its own level and at the lower one if it can link with a set there.

The frequencies come from hashed counts of a fixed size over all documents. They only order tokens:
an error makes no link go missing. Candidates that share a signature are verified on whole sets.

Sets that are equal are one class from the start. Of the sets that share a signature the one of the
smallest id is the *pivot*. All sets are first compared with their pivots. Two sets that share a
signature share its pivot, so that what is left lies among one pivot's sets: those outside its
component are compared with each other and with those inside, in blocks of a bounded size that meet
by pairs of blocks. A group of m near copies takes about m comparisons and not the square, pairs are
never rows, and no group meets in one task. Histograms of the sets' hashes, which bound an overlap
from above, rule out most pairs before their texts are read; whole sets decide on the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.llm.common import claim, drop, give_back, saved, with_small
from mesaquery.llm.components import components
from mesaquery.llm.tokens import texts_of

#: Cells of the hashed document frequencies: a fixed size whatever the corpus holds.
CELLS = 1 << 18
#: Words after which a worker's cache of word hashes starts anew, which bounds its memory.
CACHE_WORDS = 150_000
#: Documents, and shingles, of one of the blocks that are compared in one task.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 250_000
#: Digests of sets that a worker remembers, so that copies count once: a bound on its memory.
SEEN = 200_000
#: Bars of the histogram that rules out most pairs before their texts are read.
BARS = 256
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; the whole sequence if it has fewer words.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at ASCII white space only.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_hashes) > CACHE_WORDS:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    total = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        total = mix(total + h[i : len(h) - k + 1 + i] * _MULTIPLIERS[i % 4])
    return np.unique(total)


def _sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Of each row doc_id, tie (hash of the text), n and set digest; and the hashed frequencies."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        claim("shingles", _hashes.clear)
        cells, seen = np.zeros(CELLS, np.int64), set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            sizes, digests, fresh = [], [], []
            for text in texts_of(batch.column(2)):
                s = shingles(text, n)
                digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                if digest and digest not in seen:  # one copy of a set counts once in a part
                    seen.add(digest)
                    fresh.append(s)
                sizes.append(len(s))
                digests.append(digest)
            if fresh:
                cells += np.bincount((np.concatenate(fresh) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "tie": batch.column(1), "n": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()), "cell": pa.nulls(len(sizes), pa.int32())})
        used = np.flatnonzero(cells)
        for a in range(0, len(used), 1 << 16):
            at = used[a : a + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.nulls(len(at), pa.int64()), "tie": pa.nulls(len(at), pa.int64()), "n": pa.array(cells[at]), "digest": pa.nulls(len(at), pa.binary()), "cell": pa.array(at.astype(np.int32))})
        _hashes.clear()
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(measure, "doc_id long, tie long, n long, digest binary, cell int"), "sets")


def histogram(s: np.ndarray) -> np.ndarray:
    """Counts of a set's hashes by their top bits. The sum of two histograms' minima bounds an overlap."""
    return np.bincount((s >> np.uint64(64 - BARS.bit_length() + 1)).astype(np.int64), minlength=BARS).astype("<i4" if len(s) > 30_000 else "<i2")


def missing(n: int, percent: int) -> int:
    """Tokens of a set of n that a linked set can lack at most."""
    return n - -(-n * percent // 100)


def signatures_of(s: np.ndarray, weight: np.ndarray, limit: int, percent: int, k: int = 2) -> np.ndarray:
    """Signatures of one set; ``weight`` has the frequency of each cell, above ``limit`` frequent."""
    n = len(s)
    if n < 2:
        return np.empty(0, np.uint64)  # it can only link with an equal set
    need = missing(n, percent) + 1
    w = weight[(s & np.uint64(CELLS - 1)).astype(np.int64)]
    order = np.argsort(w, kind="stable")
    rare = int((w <= limit).sum())
    if rare >= need:
        return s[order[:need]]
    out = [s[order[:rare]]]
    often = s[order[rare:]]
    level = n.bit_length()
    levels = [level] + [level - 1] * (level > 2 and n * percent <= 100 * ((1 << level - 1) - 1))
    for at in levels:
        m = max(1, missing(1 << at, percent) // 8)
        salt = mix(np.array([at], np.uint64))
        dealt = (mix(often ^ salt) % np.uint64(m)).astype(np.int64)
        earlier: dict[int, list[int]] = {}
        worth, ends = rare, []
        for i, c in enumerate(dealt.tolist()):
            before = earlier.setdefault(c, [])
            if len(before) >= k - 1:
                worth += 1
                ends.append((i, np.array([*combinations(before, k - 1)], np.int64)))
            before.append(i)
            if worth >= need:
                break
        mixed = mix(often ^ salt)
        for i, others in ends:
            out.append(mix(mixed[others].sum(1, dtype=np.uint64) + mixed[i]))
    return np.unique(np.concatenate(out))


def _signatures(docs: DataFrame, weight: np.ndarray, limit: int, n: int, percent: int, k: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # CELLS numbers

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", _hashes.clear)
        for batch in batches:
            ids, found, bars = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                s = shingles(text, n)
                sig = signatures_of(s, shared.value, limit, percent, k)
                ids.append(np.full(len(sig), doc, np.int64))
                found.append(sig)
                bars.append(histogram(s).tobytes())
            if found:
                flat = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_pydict({"doc": pa.array(np.concatenate(ids)), "sig": pa.array(flat), "bars": pa.nulls(len(flat), pa.binary())})
                yield pa.RecordBatch.from_pydict({"doc": batch.column(0), "sig": pa.nulls(len(bars), pa.int64()), "bars": pa.array(bars, pa.binary())})
        _hashes.clear()
        give_back()

    return docs.mapInArrow(sign, "doc long, sig long, bars binary")


def _linked(ids: list[int], comps: list[int], texts: list[bytes | None], side: np.ndarray, n: int, percent: int) -> list[tuple[int, int]]:
    """Links from rows of side 0 to those of side 1, or among those of side 0 where there is no 1.

    Of the links only those that join components not known to be joined.
    """
    sets = [shingles(t, n) for t in texts]
    sizes = np.array([len(x) for x in sets])
    found, of_set = np.unique(np.concatenate(sets), return_inverse=True)
    useful = np.bincount(of_set, minlength=len(found)) > 1
    place = np.cumsum(useful) - 1
    bits = np.zeros((len(sets), max(1, -(-int(useful.sum()) // 64)) * 8), np.uint8)
    for i, part in enumerate(np.split(of_set, np.cumsum(sizes)[:-1])):
        row = np.zeros(bits.shape[1] * 8, bool)
        row[place[part[useful[part]]]] = True
        bits[i] = np.packbits(row)
    words = bits.view(np.uint64)
    root = {c: c for c in comps}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    left, right, out = np.flatnonzero(side == 0), np.flatnonzero(side == 1), []
    for k, i in enumerate(left):
        others = right if len(right) else left[k + 1 :]
        both = np.bitwise_count(words[i] & words[others]).sum(1, dtype=np.int64)
        for j in others[(both > 0) & (100 * both >= percent * (sizes[i] + sizes[others] - both))]:
            x, y = top(comps[i]), top(comps[j])
            if x != y:
                root[x] = y
                out.append((ids[i], ids[j]))
    return out


def _could_link(comps: np.ndarray, bars: list[bytes], side: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have a partner of another component that the histograms don't rule out."""
    h = np.stack([np.frombuffer(x, "<i2" if len(x) == 2 * BARS else "<i4") for x in bars]).astype(np.int32)
    n = h.sum(1)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    keep = np.zeros(len(bars), bool)
    for k, i in enumerate(left):
        others = right if len(right) else left[k + 1 :]
        others = others[(comps[others] != comps[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
        if len(others):
            most = np.minimum(h[i], h[others]).sum(1)
            hit = others[100 * most >= percent * (n[i] + n[others] - most)]
            keep[hit] = True
            keep[i] |= len(hit) > 0
    return keep


def _each_meet(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], pa.Table]) -> Iterator[pa.RecordBatch]:
    """``work`` on the rows of each ``meet``, which come together: first column, in order."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        meets = rows.column(0).combine_chunks()
        if not len(meets):
            continue
        numbers = np.unique(meets.dictionary_encode().indices.to_numpy(), return_index=True)[1]
        starts = np.sort(numbers)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield from work(rows.slice(a, b - a)).to_batches()
        rest = rows.slice(starts[-1]).combine_chunks()
    if rest is not None:
        yield from work(rest).to_batches()
    _hashes.clear()
    give_back()


def _met(rows: DataFrame) -> DataFrame:
    """Rows with those of one ``meet`` together. Meetings are small, and so is a task's excess."""
    return rows.repartition("meet").sortWithinPartitions("meet")


def _compared(assigned: DataFrame, bars: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) among the saved ``assigned`` (meet, side, doc_id, comp) rows of each ``meet``.

    Histograms go to all meetings; texts only to where some pair may link.
    """

    def sift(group: pa.Table) -> pa.Table:
        keep = _could_link(group.column("comp").to_numpy(), group.column("bars").to_pylist(), group.column("side").to_numpy(), percent) if len(group) > 1 else np.zeros(1, bool)
        return group.select(["meet", "side", "doc_id", "comp"]).filter(pa.array(keep))

    def compare(group: pa.Table) -> pa.Table:
        ids, comps = group.column("doc_id").to_pylist(), group.column("comp").to_pylist()
        found = _linked(ids, comps, texts_of(group.column("text").combine_chunks()), group.column("side").to_numpy(), n, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    shown = assigned.join(bars.select(F.col("doc").alias("doc_id"), "bars"), "doc_id").select("meet", "side", "doc_id", "comp", "bars")
    left = saved(_met(shown).mapInArrow(lambda x: _each_meet(x, sift), "meet string, side int, doc_id long, comp long"), "sifted")
    texts = with_small(docs.select("doc_id", "text"), left, ["doc_id"], "inner").select("meet", "side", "doc_id", "comp", "text")
    links = saved(_met(texts).mapInArrow(lambda x: _each_meet(x, compare), "a long, b long"), "links")
    drop(assigned, left)
    return links


def _blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """Saved rows with doc and n, and ``h``, so that rows of one (by, h) are few and not too long."""
    sums = saved(rows.groupBy(*by).agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")), "sums")
    blocks = saved(with_small(rows, sums, by, "inner").withColumn("h", F.pmod(F.xxhash64("doc", F.lit("block")), "blocks")), "blocks")
    drop(sums)
    return blocks


def _pivot_stars(members: DataFrame, percent: int) -> DataFrame:
    """Meetings of each pivot with blocks of those of its sets that are of a fitting size."""
    fitting = members.where("doc <> p").where(f"100 * least(n, pn) >= {percent} * greatest(n, pn)")
    blocks = _blocks(fitting, ["p"])
    meet = F.concat_ws("/", "p", "h").alias("meet")
    pivots = blocks.select("p", "h").distinct().select(meet, F.lit(0).alias("side"), F.col("p").alias("doc_id"), F.col("p").alias("comp"))
    assigned = saved(blocks.select(meet, F.lit(1).alias("side"), F.col("doc").alias("doc_id"), F.col("doc").alias("comp")).union(pivots), "assigned")
    drop(blocks)
    return assigned


def _left_over(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Meetings of blocks of one pivot's sets, for pairs that aren't in one component."""
    label = labels.select(F.col("node").alias("doc"), "component")
    known = with_small(members.where("doc <> p"), label, ["doc"], "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
    of_pivot = labels.select(F.col("node").alias("p"), F.col("component").alias("of_p"))
    known = saved(with_small(known, of_pivot, ["p"], "left").withColumn("inside", F.coalesce("of_p", "p") == F.col("comp")), "known")
    # A group that fits into one block meets as a whole.
    few = (F.count("*") <= BLOCK_ROWS) & (F.sum("n") <= BLOCK_SHINGLES)
    several = saved(known.groupBy("p").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), few.alias("few")).where("c0 <> c1").select("p", "few"), "several")
    # Sets that link differ by less than one of these levels.
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    left = with_small(known, several, ["p"], "inner")
    left = left.select("p", "doc", "n", "comp", (F.col("inside") & ~F.col("few")).alias("inside"), F.when(F.col("few"), 0).otherwise(level).alias("level"))
    rows = _blocks(left, ["p", "inside", "level"])
    blocks = saved(rows.select("p", "inside", "level", "h").distinct(), "blocks")
    one = blocks.where("NOT inside").select("p", F.col("level").alias("level1"), F.col("h").alias("h1"))
    two = blocks.select("p", "inside", F.col("level").alias("level2"), F.col("h").alias("h2"))
    met = one.join(two, "p").where("abs(level1 - level2) <= 1 AND (inside OR level1 < level2 OR level1 = level2 AND h1 <= h2)")
    met = saved(met.withColumn("meet", F.concat_ws("/", "p", "level1", "h1", "inside", "level2", "h2")), "met")
    first = met.select("meet", F.lit(0).alias("side"), "p", F.lit(False).alias("inside"), F.col("level1").alias("level"), F.col("h1").alias("h"))
    second = met.where("inside OR level1 <> level2 OR h1 <> h2").select("meet", F.lit(1).alias("side"), "p", "inside", F.col("level2").alias("level"), F.col("h2").alias("h"))
    sides = saved(first.union(second), "sides")
    both = with_small(rows, sides, ["p", "inside", "level", "h"], "inner")
    assigned = saved(both.select("meet", "side", F.col("doc").alias("doc_id"), "comp"), "assigned")
    drop(known, several, rows, blocks, met, sides)
    return assigned


def similar_groups(docs: DataFrame, n: int = 4, percent: int = 85, frequent: float = 0.02, id_col: str = "doc_id", text_col: str = "text", k: int = 2) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Documents link at Jaccard similarity >= percent / 100. Null and empty texts have empty sets and
    link with nothing. Rows without an id link with nothing and have a null component_id. Rows that
    share an id count as one document for links but stay separate rows. An empty table gives no rows.
    """
    measured = _sets(docs, n, id_col, text_col)
    rows = measured.where("cell IS NULL").drop("cell")
    spread = measured.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most CELLS rows
    weight = np.zeros(CELLS, np.int64)
    for cell, count in spread:
        weight[cell] = count
    classes = saved(rows.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("size")), "classes")
    n_classes = classes.count()
    # Cells hold many tokens each: what they all hold on average isn't one token's frequency.
    limit = int(np.median(weight)) + max(int(frequent * n_classes), 100)

    ided = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    marked = with_small(rows.where("doc_id IS NOT NULL AND digest IS NOT NULL"), classes.select("digest", "rep"), ["digest"], "inner", n_classes)
    copies = saved(marked.where("doc_id <> rep").select("doc_id", "tie").distinct(), "copies")
    distinct = with_small(ided, copies, ["doc_id", "tie"], "left_anti").select("doc_id", "text")

    signed = saved(_signatures(distinct, weight, limit, n, percent, k), "signatures")
    # One shuffle of the signatures gives each its pivot.
    of_sig = Window.partitionBy("sig")
    met = signed.where("sig IS NOT NULL").select("doc", F.min("doc").over(of_sig).alias("p"), F.max("doc").over(of_sig).alias("last"))
    shared = met.where("p <> last").select("p", "doc").distinct()
    sizes = classes.select(F.col("rep").alias("doc"), F.col("size").alias("n"))
    sized = with_small(shared, sizes, ["doc"], "inner", n_classes)
    members = saved(with_small(sized, sizes.toDF("p", "pn"), ["p"], "inner", n_classes), "members")
    concerned = saved(members.select("doc").distinct(), "concerned")  # pivots are members of their own
    bars = saved(with_small(signed.where("bars IS NOT NULL").select("doc", "bars"), concerned, ["doc"], "left_semi"), "bars")
    drop(signed, concerned)
    links = _compared(_pivot_stars(members, percent), bars, ided, n, percent)
    labels = components(links)
    more = _compared(_left_over(members, labels, percent), bars, ided, n, percent)
    if not more.isEmpty():
        labels = components(labels.toDF("a", "b").union(more))
    drop(members, bars, copies, links, more)
    grouped = with_small(classes, labels.select(F.col("node").alias("rep"), "component"), ["rep"], "left")
    result = with_small(rows, grouped.select("digest", F.coalesce("component", "rep").alias("component")), ["digest"], "left", n_classes)
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM w),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
