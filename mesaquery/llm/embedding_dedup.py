"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector is padded with zeros to D components and rotated at random to x. Its code is the signs
of x; with u = sign(x) / sqrt(D), the stored correction factor is f = <u, x>. For another unit
vector q, rotated alike, <u, q> / f is an unbiased estimate of their cosine s, and with probability
at least 1 - 2 exp(-E**2 / 2) its error is at most E sqrt((1 - f^2) / f^2) sqrt(1 - s^2) / sqrt(D - 1).
A pair whose estimate plus the bound for s at the threshold reaches the threshold is recomputed in
double precision, and only that decides. At E = 7 a linked pair is missed with probability 5e-11.

Equal vectors are one class. Vectors of one length are compared with each other. Classes of a length
are dealt to cells by the nearest of some pivots (a bounded sample), large cells are cut into blocks,
and blocks meet in pairs. Angles obey the triangle inequality, so that two blocks are skipped if
their pivots are further apart than their radii and the threshold's angle: a lossless rule. Lengths
beyond the ``LENGTHS`` most frequent ones have one cell, whose blocks all meet. Where the vectors
don't cluster the rule skips little, and the work is a block-wise comparison of all classes, which is
what exactness costs there. Which blocks meet is a table; the driver holds pivots and cells only.

Tasks hand on counts of links and the links of a spanning forest, never pairs, so that a group of m
near copies gives about m rows for each pair of its blocks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, and vectors of different lengths don't link with each other; rows of a null id link with
nothing and have a null component; repeated rows of one id count as vectors each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import drop, saved, with_small
from mesaquery.llm.components import components

#: Vectors, and bytes, of the sample that pivots are chosen from; lengths that have pivots.
SAMPLE, SAMPLE_BYTES, LENGTHS = 4096, 32 << 20, 16
#: Vectors, and bytes, of a block; its rows that are estimated at once.
BLOCK, BLOCK_BYTES, TILE = 4096, 16 << 20, 1024
#: Deviations of the confidence bound.
E = 7.0
#: Components up to which a rotation is a dense matrix; beyond, it's three of signs and a Hadamard transform.
DENSE = 2048


class Rotation:
    """A random rotation of D >= 2 dim components, of which the last D - dim are zero."""

    def __init__(self, dim: int, seed: int = 7):
        self.dim, rng = dim, np.random.default_rng(seed)
        self.size = max(128, -(-2 * dim // 64) * 64)
        if self.size <= DENSE:
            q, r = np.linalg.qr(rng.standard_normal((self.size, self.size)))
            self.matrix = (q * np.sign(np.diag(r)))[:dim]
        else:
            self.size = 1 << (self.size - 1).bit_length()
            self.matrix, self.signs = None, rng.choice([-1.0, 1.0], (3, self.size))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.matrix is not None:
            return x @ self.matrix
        out = np.zeros((len(x), self.size))
        out[:, : self.dim] = x
        for signs in self.signs:
            out *= signs
            half = 1
            while half < self.size:
                pairs = out.reshape(len(x), -1, 2, half)
                out = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(len(x), self.size)
                half *= 2
            out /= math.sqrt(self.size)
        return out


_rotations: dict[int, Rotation] = {}


def rotation(dim: int) -> Rotation:
    """The same one in every worker, made once in each."""
    if dim not in _rotations:
        _rotations.clear()
        _rotations[dim] = Rotation(dim)
    return _rotations[dim]


def encode(unit: np.ndarray, rotate: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Codes (signs, packed) and correction factors of unit vectors."""
    x = rotate(unit)
    return np.packbits(x > 0, axis=1), np.abs(x).sum(1) / math.sqrt(rotate.size)


def bound(factor: np.ndarray, threshold: float, d: int) -> np.ndarray:
    """The estimate's error that a pair at the threshold or above exceeds with negligible odds."""
    return E * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2) * math.sqrt(max(0.0, 1 - threshold**2)) / math.sqrt(d - 1)


def linked(left: np.ndarray, right: np.ndarray, codes: np.ndarray, factors: np.ndarray, threshold: float, rotate: Rotation) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of left and right unit vectors with a cosine >= threshold; codes are left's."""
    d = rotate.size
    turned = rotate(right).T.astype(np.float32)
    floor = (threshold - bound(factors, threshold, d) - 1e-6).astype(np.float32)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a in range(0, len(left), TILE):
        signs = np.unpackbits(codes[a : a + TILE], axis=1, count=d).astype(np.float32) * 2 - 1
        estimate = (signs @ turned) / (math.sqrt(d) * factors[a : a + TILE, None]).astype(np.float32)
        i, j = np.nonzero(estimate >= floor[a : a + TILE, None])
        i += a
        for b in range(0, len(i), 1 << 16):
            x, y = i[b : b + (1 << 16)], j[b : b + (1 << 16)]
            keep = np.einsum("ij,ij->i", left[x], right[y]) >= threshold
            found.append((x[keep], y[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # very large and small components keep their squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(classes: DataFrame, block: int) -> dict[int, np.ndarray]:
    """Of each of the most frequent lengths that need several blocks, pivots that lie apart."""
    sizes = classes.groupBy("dim").count().where(F.col("count") > block).orderBy(F.desc("count"), "dim").take(LENGTHS)
    out = {}
    for dim, n in ((r[0], r[1]) for r in sizes):
        wanted = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
        rows = classes.where(F.col("dim") == dim).where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(n)) < wanted)
        sample = np.array([r[0] for r in rows.orderBy("key").limit(2 * wanted).select("v").collect()], np.float64).reshape(-1, dim)
        if not len(sample):
            continue
        sample = _unit(sample)
        # Farthest-first choice: pivots that lie apart give small cells.
        chosen, near = [0], sample @ sample[0]
        while len(chosen) < min(-(-n // block), len(sample)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, sample @ sample[chosen[-1]])
        out[dim] = sample[chosen]
    return out


def _meets(blocks: DataFrame, pivots: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """meet, a, b: pairs of the saved ``blocks`` (dim, cell, block, radius) that aren't proven apart."""
    spark, theta = blocks.sparkSession, math.acos(max(-1.0, min(1.0, threshold)))
    shared = spark.sparkContext.broadcast(pivots)  # a bounded sample

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for dim, cell, block, radius in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                p = shared.value.get(dim)
                apart = np.zeros(1) if p is None else np.arccos(np.clip(p @ p[cell], -1, 1))
                rows += [(block, dim, cell, radius, k, float(apart[k])) for k in range(cell, len(apart))]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64())
            if rows:
                yield pa.RecordBatch.from_pydict({n: pa.array(x, k) for n, x, k in zip(("a", "dim", "cell_a", "radius_a", "cell", "apart"), zip(*rows, strict=True), kinds, strict=True)})

    cells = blocks.groupBy("dim", "cell").agg(F.max("radius").alias("widest"))
    ways = blocks.select("dim", "cell", "block", "radius").mapInArrow(near, "a string, dim int, cell_a int, radius_a double, cell int, apart double")
    ways = with_small(ways, saved(cells, "cells"), ["dim", "cell"], "inner").where(F.col("apart") <= F.col("radius_a") + F.col("widest") + theta + 1e-9)
    other = blocks.select("dim", "cell", F.col("block").alias("b"), F.col("radius").alias("radius_b"))
    pairs = with_small(ways, other, ["dim", "cell"], "inner").where(F.col("apart") <= F.col("radius_a") + F.col("radius_b") + theta + 1e-9).where("cell_a < cell OR a <= b")
    return saved(pairs.select(F.concat_ws("|", "a", "b").alias("meet"), "a", "b"), "pairs")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other vectors at a cosine >= threshold), component_id, kept; one row each."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(good & F.col(id_col).isNotNull(), v).alias("v"))
    # Equal components make one class, told by the digest of their text form.
    keyed = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256)))
    classes = keyed.where("v IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("v").alias("v"))
    # Numbered by themselves, as rows of one id can hold several vectors.
    classes = saved(classes.withColumn("dim", F.size("v")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    pivots = _pivots(classes, block)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, dims = batch.column(2).flatten().to_numpy(), batch.column(3).to_numpy()
            starts = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                unit, rotate = _unit(flat[starts[at, None] + np.arange(dim)]), rotation(dim)
                p = shared.value.get(dim)
                # Without pivots nothing is known of where a vector lies.
                to = np.full((len(at), 1), -1.0) if p is None else unit @ p.T
                cell = to.argmax(1)
                codes, factors = encode(unit, rotate)
                angle = np.arccos(np.clip(to[np.arange(len(at)), cell], -1, 1))
                own = {"rep": batch.column(0).take(pa.array(at)), "copies": batch.column(1).take(pa.array(at)), "dim": pa.array(np.full(len(at), dim, np.int32))}
                yield pa.RecordBatch.from_pydict(own | {"cell": pa.array(cell, pa.int32()), "angle": pa.array(angle), "unit": pa.array([r.tobytes() for r in unit], pa.binary()), "code": pa.array([r.tobytes() for r in codes], pa.binary()), "factor": pa.array(factors)})

    schema = "rep long, copies long, dim int, cell int, angle double, unit binary, code binary, factor double"
    dealt = saved(classes.select("rep", "copies", "v", "dim").mapInArrow(deal, schema), "dealt")
    room = F.least(F.lit(block), F.greatest(F.lit(64), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim")))))
    parts = saved(dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.first(room)).alias("parts")), "parts")
    blocked = with_small(dealt, parts, ["dim", "cell"], "inner").withColumn("block", F.concat_ws("/", "dim", "cell", F.pmod(F.xxhash64("rep"), "parts"))).drop("parts")
    blocks = saved(blocked.groupBy("dim", "cell", "block").agg(F.max("angle").alias("radius")), "blocks")
    pairs = _meets(blocks, pivots, threshold)
    sides = saved(pairs.select("meet", F.col("a").alias("block"), F.lit(0).alias("side")).union(pairs.where("a <> b").select("meet", F.col("b").alias("block"), F.lit(1).alias("side"))), "sides")

    def compare(group: pa.Table) -> pa.Table:
        ids, copies, side = (group.column(c).to_numpy() for c in ("rep", "copies", "side"))
        unit = _matrix(group.column("unit").combine_chunks())
        codes = np.frombuffer(b"".join(group.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        right = left if alone else right
        i, j = linked(unit[left], unit[right], codes[left], group.column("factor").to_numpy()[left], threshold, rotation(unit.shape[1]))
        i, j = left[i], right[j]
        if alone:  # the estimate of (i, j) isn't that of (j, i): either finds the pair
            i, j = np.unique(np.sort(np.stack((i, j)), axis=0)[:, i != j], axis=1)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = list(range(len(ids)))

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        forest = []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            if (p := top(x)) != (q := top(y)):
                root[p] = q
                forest.append((x, y))
        some = np.flatnonzero(links)
        edges = np.array(forest, np.int64).reshape(-1, 2)
        return pa.table({"vec": np.concatenate((ids[some], ids[edges[:, 0]])), "n": pa.array(np.concatenate((links[some], np.zeros(len(edges), np.int64)))), "other": pa.array(np.concatenate((np.zeros(len(some), np.int64), ids[edges[:, 1]])), mask=np.arange(len(some) + len(edges)) < len(some))})

    met = with_small(blocked.select("rep", "copies", "unit", "code", "factor", "block"), sides, ["block"], "inner")
    found = saved(met.select("meet", "side", "rep", "copies", "unit", "code", "factor").groupBy("meet").applyInArrow(compare, "vec long, n long, other long"), "found")
    drop(dealt, parts, blocks, pairs, sides)
    links = found.where("other IS NULL").groupBy(F.col("vec").alias("rep")).agg(F.sum("n").alias("n"))
    labels = components(found.where("other IS NOT NULL").select(F.col("vec").alias("a"), F.col("other").alias("b")))
    named = saved(labels.withColumnRenamed("node", "rep").join(classes.select("rep", "first_id"), "rep"), "labels")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("smallest"))
    of_class = named.select("rep", "component").join(smallest, "component").select("rep", "smallest")
    per_class = saved(classes.select("key", "rep", "first_id", "copies").join(links, "rep", "left").join(of_class, "rep", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("smallest", "first_id").alias("component")), "per-class")
    drop(classes, found, named)
    result = with_small(keyed.select("vec_id", "key"), per_class, ["key"], "left", n)
    component = F.coalesce("component", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
g AS (SELECT vec_id, v FROM v WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a, g b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT vec_id, least(vec_id, coalesce((SELECT min(b) FROM r WHERE r.a = v.vec_id), vec_id)) AS component_id FROM v)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
"""
