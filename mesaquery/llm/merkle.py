"""A Merkle manifest of a dataset by superblock reduction.

Rows of one group are leaves of its tree in a stated order; runs of ``fanout`` nodes become their hash
until one node, the group's subroot, is left. Subroots, in the order of their groups, are the leaves of
one more tree, whose last node is the root.

1. *Numbers.* Leaves are sorted by ranges of (group, order), so that a group of any size is spread over
   tasks; a leaf's index is its place in its task, added to the sizes of the tasks before, less that of
   its group's first leaf.
2. *Superblocks.* The leaves of one group are bucketed by index over fanout^k. ``applyInPandas``
   collapses k levels of a bucket, which holds fanout^k nodes at most whatever the group's size, to the
   bucket's root, and gives each of its nodes the proof of these k levels.
3. *Recursion.* Bucket roots are the nodes of the next round, until each group has one; their number
   falls by fanout^k each time, so that four rounds do for any table.
4. *Proofs.* From the top down, a node's lower proof is followed by that of its bucket's root.

A proof is a list of levels, each with the digests beside a node in its run and how many of them stand
to its left; ``folded`` recomputes a root from a leaf and its proof.

Defined results: a field that is null is hashed as ``-``, so that it differs from an empty one; rows
without a group form one that comes first; equal leaves of one place follow each other and each has
its own proof; a null order comes first; a group of one leaf has that leaf as its subroot and no levels
below it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import drop, saved, unused, with_small

#: Nodes of a run, and levels that one task collapses at once: 729 nodes.
FANOUT, LEVELS = 3, 6
#: Hexadecimal digits of a digest.
_HEX = 64
_PATH = "array<struct<left:int,siblings:binary>>"


def digest_of(*fields: Column) -> Column:
    """The hash of fields, each as its length in bytes, a colon and its text, or ``-`` if null."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in fields]), 256)


def numbered(rows: DataFrame, order: Sequence[str], number: str = "number") -> DataFrame:
    """``rows`` with their place from 0 in ``order``, whose columns must tell all rows apart.

    Only the sizes of the sorted partitions, as many as the session's shuffle has, meet on the driver.
    """
    spark = rows.sparkSession
    place, part, shift = (unused(rows, x) for x in ("_place", "_part", "_shift"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = saved(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "sorted")
    placed_ = placed.withColumn(part, F.shiftright(place, 33))
    sizes = sorted((r[0], r[1]) for r in placed_.groupBy(part).count().collect())
    before = accumulate((n for _, n in sizes), initial=0)
    starts = spark.createDataFrame([(p, start - (p << 33)) for (p, _), start in zip(sizes, before, strict=False)], f"{part} long, {shift} long")
    return placed_.join(F.broadcast(starts), part).withColumn(number, F.col(place) + F.col(shift)).drop(part, place, shift)


def collapsed(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """grp, idx, n, bucket, path, top: each node's proof within its bucket, and the bucket's root.

    ``nodes`` has (grp, idx, n, digest): n nodes of a group at this level. A group of one bucket ends
    where one node is left; buckets of others collapse all ``levels``, a node alone too.
    """
    size = fanout**levels

    def collapse(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        row, at = list(block["digest"]), list(range(len(block)))
        paths: list[list[dict]] = [[] for _ in row]
        for level in range(levels if block["n"].iloc[0] > size else len(row)):
            if len(row) == 1 and block["n"].iloc[0] <= size:
                break
            runs = [row[i : i + fanout] for i in range(0, len(row), fanout)]
            steps = [{"left": k, "siblings": bytes.fromhex("".join(run[:k] + run[k + 1 :]))} for run in runs for k in range(len(run))]
            for i, path in enumerate(paths):
                path.append(steps[at[i]])
                at[i] //= fanout
            row = [hashlib.sha256("".join(run).encode()).hexdigest() for run in runs]
        return pd.DataFrame({"grp": block["grp"], "idx": block["idx"], "n": block["n"], "bucket": block["idx"] // size, "path": paths, "top": row[0]})

    keyed = nodes.withColumn("bucket", F.expr(f"idx div {size}"))
    return keyed.groupBy("grp", "bucket").applyInPandas(collapse, f"grp long, idx long, n long, bucket long, path {_PATH}, top string")


def _climb(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each round the collapsed nodes, and (grp, digest) of the groups that it left with one node."""
    size, lows, done = fanout**levels, [], []
    while True:
        low = saved(collapsed(nodes, fanout, levels), "collapsed")
        tops = saved(low.where(F.col("idx") % size == 0).select("grp", F.col("bucket").alias("idx"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("digest")), "tops")
        lows.append(low)
        done.append(tops.where("n = 1").select("grp", "digest"))
        nodes = tops.where("n > 1")
        if nodes.isEmpty():
            return lows, done


def _descend(lows: list[DataFrame], done: list[DataFrame], beyond: DataFrame) -> DataFrame:
    """(grp, idx, path, subroot, root) of the first round's nodes; ``beyond`` has (grp, path, root) from the subroots on.

    A group's last node meets its row of ``beyond`` once; further down, the nodes of one bucket meet their root's row.
    """
    above: DataFrame | None = None
    for low, ended in zip(reversed(lows), reversed(done), strict=True):
        ends = with_small(ended, beyond, ["grp"], "inner", 8 * beyond.count())
        ends = ends.select("grp", F.lit(0).cast("long").alias("bucket"), F.col("path").alias("further"), F.col("digest").alias("subroot"), "root")
        if above is not None:
            ends = ends.unionByName(above.select("grp", F.col("idx").alias("bucket"), F.col("path").alias("further"), "subroot", "root"))
        ends = saved(ends, "ends")
        above = with_small(low, ends, ["grp", "bucket"], "inner", 8 * ends.count()).select("grp", "idx", F.concat("path", "further").alias("path"), "subroot", "root")
    return above


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``rows`` with path (the leaf's proof up to the root), subroot and root.

    ``rows`` should be narrow: its columns are sorted along. New columns that clash get underscores.
    """
    given, row, number = rows.columns, unused(rows, "_row"), unused(rows, "_number")
    held = saved(rows.withColumn(row, F.monotonically_increasing_id()), "leaves")
    placed = saved(numbered(held, [group, *order, leaf, row], number).drop(row), "numbered")
    drop(held)
    keys = [(F.col(group).isNull()).alias("_none"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_name")]
    groups = saved(placed.groupBy(*keys).agg(F.min(number).alias("grp"), F.count("*").alias("n")), "groups")
    leaves = with_small(placed.select(*keys, F.col(number).alias("number"), F.col(leaf).alias("digest")), groups, ["_none", "_name"], "inner")
    leaves = saved(leaves.select("grp", (F.col("number") - F.col("grp")).alias("idx"), "n", "digest"), "nodes")
    lows, done = _climb(leaves, fanout, levels)
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.union(more)
    n_groups = groups.count()
    tree = saved(numbered(subroots, ["grp"], "idx").withColumnRenamed("grp", "of"), "subroots")
    upper, last = _climb(tree.select(F.lit(0).cast("long").alias("grp"), "idx", F.lit(n_groups).cast("long").alias("n"), "digest"), fanout, levels)
    root = saved(last[-1].select("grp", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root")), "root")
    beyond = _descend(upper, last, root).select("idx", "path", "root")
    beyond = saved(with_small(tree.select("idx", F.col("of").alias("grp")), beyond, ["idx"], "inner", 8 * n_groups).select("grp", "path", "root"), "beyond")
    proofs = _descend(lows, done, beyond).select((F.col("grp") + F.col("idx")).alias(number), *[F.col(c).alias(unused(rows, c)) for c in ("path", "subroot", "root")])
    return placed.join(proofs, number).select(*given, *proofs.columns[1:])


def siblings_of(path: Column) -> Column:
    """All digests of a proof as text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.lower(F.hex(x["siblings"]))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def up(below: Column, level: Column) -> Column:
        beside, cut = F.lower(F.hex(level["siblings"])), level["left"] * _HEX
        return F.sha2(F.concat(F.substring(beside, F.lit(1), cut), below, F.substring(beside, cut + 1, F.length(beside))), 256)

    return F.aggregate(path, leaf, up)


def audited(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """Each row's leaf and proof, held against a text from which line breaks were lost where 2 divides the id's crc32."""
    whole = [F.col(c) for c in fields]
    lost = [F.translate(text, "\n", "") if c == text else F.col(c) for c in fields]
    odd = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.col(group).alias("source"), digest_of(*whole).alias("leaf"), F.when(odd, digest_of(*lost)).otherwise(digest_of(*whole)).alias("seen"))
    found = manifest(leaves, "source", ["doc_id"], "leaf").withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings_of(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(below: int, above: int) -> str:
    """All levels one after the other: of each source, and of the subroots."""
    crc = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length({0}) + 1), lambda j: CAST(ascii(substr({0}, CAST(j AS BIGINT), 1)) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    part = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part.format(x) for x in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    steps = [
        "crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS t)",
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc.format('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS seen FROM documents, crc_table)",
        "a0 AS (SELECT doc_id, coalesce('=' || source, '-') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, leaf AS h FROM d)",
        "p0 AS (SELECT doc_id, g, i, '' AS proof, seen AS f FROM a0 JOIN d USING (doc_id))",
    ]

    def tree(a: str, p: str, keys: str, levels: int) -> None:
        for k in range(levels):
            run = f"(PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN {{}})"
            steps.append(f"s{a}{k} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS c, coalesce(string_agg(h, '') OVER {run.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS l, coalesce(string_agg(h, '') OVER {run.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS r FROM {a}{k})")
            steps.append(f"{p}{k + 1} AS (SELECT {keys}, g, i // 3 AS i, CASE WHEN c = 1 THEN proof ELSE proof || l || r END AS proof, CASE WHEN c = 1 THEN f ELSE sha256(l || f || r) END AS f FROM {p}{k} JOIN s{a}{k} USING (g, i))")
            steps.append(f"{a}{k + 1} AS (SELECT g, i // 3 AS i, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM s{a}{k} GROUP BY g, i // 3)")

    tree("a", "p", "doc_id", below)
    steps.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, g AS of FROM a{below})")
    steps.append(f"q0 AS (SELECT doc_id, 0 AS g, b.i, proof, f, b.h AS subroot FROM p{below} p JOIN b0 b ON p.g = b.of)")
    tree("b", "q", "doc_id, subroot", above)
    return "WITH " + ", ".join(steps) + f" SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b.h AS verified FROM q{above} JOIN d USING (doc_id), b{above} b"


#: Sources of up to 3^11 documents and up to 3^5 sources.
ORACLE_SQL = _sql(11, 5)
