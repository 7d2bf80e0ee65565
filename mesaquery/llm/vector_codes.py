"""Vector code compression: product codebooks trained by Lloyd's rounds with heaps of bounds.

Each component x becomes the integer floor(256 x); a vector is cut into ``parts`` consecutive parts.
The codebook of a part position starts as that part of the vectors of the smallest ids. A round
assigns each part to its nearest entry (squared Euclidean distance, ties to the lower index) and moves
each entry to the componentwise floor of its parts' mean; after ``rounds`` of them parts are assigned
once more. All distances and means are integers, so that any partitioning gives the same codes.

Heap Lloyd keeps all but the first assignment from scanning most parts:

1. A task holds blocks of vectors. When a part is scanned, its upper bound is the distance to its
   entry and its lower bound the distance to the second nearest. The block has a heap for each part
   position and entry, keyed by the slack lower - upper plus the entry's cumulative drift at that time.
2. When entries move, an entry's drift grows by its own move and by the largest move of the others
   of its position: by no more can the bounds of its parts have closed. These numbers, one for each
   entry, are all that tasks need to know.
3. Each heap pops while its top isn't above the entry's drift: these are the parts whose bounds may be
   violated. They alone are scanned again, exactly, and pushed to the heap of their nearest entry.
4. A block hands on the changes of its entries' sums and counts; only these meet, summed by Spark.

Blocks with their heaps are a table in the shared folder, rewritten each round, so that a lost task
starts again from its block. The driver holds the codebook.

Defined results: vectors that are null or hold null or non-finite components are dropped; empty
vectors have the code of entry 0; parts are as equal as can be where ``parts`` doesn't divide the
length; vectors of another length than that of the smallest id have null codes and errors; null ids
come last; equal ids are ordered by their vectors; components beyond +-131,072 count as that; fewer
vectors than entries make as many entries; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import drop, saved, with_small

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Scaled components are cut here, so that squared distances fit into 64 bits.
LARGEST = 1 << 25
#: Bytes of the vectors of a block, and parts that are scanned at once.
BLOCK_BYTES, SCANNED = 1 << 20, 2048
#: More than rounding can make bounds differ.
MARGIN = 1e-6


@dataclass
class Book:
    """The codebooks of all part positions as (entries, dims) integers, and each (position, entry)'s drift."""

    entries: np.ndarray
    cuts: list[int]  # where parts begin and end
    drift: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, parts: int) -> Book:
        dims = vectors.shape[1]
        return cls(vectors, [dims * p // parts for p in range(parts + 1)], np.zeros((parts, len(vectors))))

    def scan(self, position: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and slack of parts (rows, width) of one position."""
        a, b = self.cuts[position : position + 2]
        book = self.entries[:, a:b].astype(np.int64)
        best, slack = np.empty(len(found), np.int64), np.full(len(found), np.inf)
        for i in range(0, len(found), SCANNED):
            some = found[i : i + SCANNED].astype(np.int64)
            far = np.zeros((len(some), len(book)), np.int64)
            for k in range(b - a):
                far += np.square(some[:, k, None] - book[None, :, k])
            rows, at = np.arange(len(some)), far.argmin(1)
            upper = np.sqrt(far[rows, at])
            best[i : i + SCANNED] = at
            if len(book) > 1:
                far[rows, at] = np.iinfo(np.int64).max
                slack[i : i + SCANNED] = np.sqrt(far.min(1)) - upper
        return best, slack

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Book:
        """The book after a round: means of the parts' sums (entries, dims), counts (parts, entries)."""
        entries = self.entries.copy()
        drift = self.drift.copy()
        for p, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            used = counts[p] > 0
            entries[used, a:b] = sums[used, a:b] // counts[p][used, None]
            moves = np.sqrt(np.square((entries[:, a:b] - self.entries[:, a:b]).astype(np.float64)).sum(1))
            largest = moves.argmax()
            others = np.full(len(moves), moves[largest])
            others[largest] = np.delete(moves, largest).max(initial=0.0)
            drift[p] += moves + others
        return Book(entries, self.cuts, drift)

    def digest(self) -> str:
        by_part = [str(x) for a, b in zip(self.cuts, self.cuts[1:], strict=False) for entry in self.entries for x in entry[a:b]]
        return hashlib.sha256(",".join(by_part).encode()).hexdigest()


class Heaps:
    """A block's heaps: flat arrays of keys and rows, heap after heap, by position and entry.

    Heaps are taken out of the arrays when something is popped or pushed, and put back at the end.
    """

    def __init__(self, keys: np.ndarray, rows: np.ndarray, ends: np.ndarray):
        self.keys, self.rows, self.ends = keys, rows, ends
        self.starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        self.out: dict[int, list[tuple[float, int]]] = {}

    def heap(self, h: int) -> list[tuple[float, int]]:
        if h not in self.out:
            a, b = self.starts[h], self.ends[h]
            self.out[h] = list(zip(self.keys[a:b].tolist(), self.rows[a:b].tolist(), strict=True))
        return self.out[h]

    def violated(self, limits: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Heaps that have parts at or below their limit, and these parts, popped."""
        full = np.flatnonzero(self.ends > self.starts)
        for h in full[self.keys[self.starts[full]] <= limits[full]].tolist():
            heap, popped = self.heap(h), []
            while heap and heap[0][0] <= limits[h]:
                popped.append(heapq.heappop(heap)[1])
            yield h, popped

    def put_back(self) -> Heaps:
        keys, rows, sizes = [], [], []
        for h in range(len(self.ends)):
            if (heap := self.out.get(h)) is None:
                keys.append(self.keys[self.starts[h] : self.ends[h]])
                rows.append(self.rows[self.starts[h] : self.ends[h]])
            else:
                keys.append(np.array([k for k, _ in heap], np.float64))
                rows.append(np.array([r for _, r in heap], np.int32))
            sizes.append(len(keys[-1]))
        return Heaps(np.concatenate(keys), np.concatenate(rows), np.cumsum(sizes).astype(np.int32))

    def codes(self, n: int, parts: int) -> np.ndarray:
        """The entry of each (row, position)."""
        entries = len(self.ends) // parts
        out = np.empty((n, parts), np.int64)
        of = np.repeat(np.arange(len(self.ends)), self.ends - self.starts)
        out[self.rows, of // entries] = of % entries
        return out


def _first(block: np.ndarray, book: Book) -> tuple[Heaps, np.ndarray, np.ndarray, int]:
    """All parts of a block (rows, dims), scanned: heaps, sums, counts, scans. An ascending run is a heap."""
    n_entries, keys, rows, counts = len(book.entries), [], [], []
    sums = np.zeros(book.entries.shape, np.int64)
    for p, (a, b) in enumerate(zip(book.cuts, book.cuts[1:], strict=False)):
        best, slack = book.scan(p, block[:, a:b])
        order = np.lexsort((slack, best))
        keys.append((slack + book.drift[p, best])[order])
        rows.append(order.astype(np.int32))
        counts.append(np.bincount(best, minlength=n_entries))
        np.add.at(sums[:, a:b], best, block[:, a:b])
    return Heaps(np.concatenate(keys), np.concatenate(rows), np.cumsum(np.concatenate(counts)).astype(np.int32)), sums, np.array(counts), len(block) * len(counts)


def _next(block: np.ndarray, heaps: Heaps, book: Book) -> tuple[Heaps, np.ndarray, np.ndarray, int]:
    """Violated parts of a block, scanned: heaps, changes of sums and counts, scans."""
    n_entries, scans = len(book.entries), 0
    sums, counts = np.zeros(book.entries.shape, np.int64), np.zeros(book.drift.shape, np.int64)
    popped: dict[int, tuple[list[int], list[int]]] = {}
    for h, rows in heaps.violated(book.drift.ravel() + MARGIN):
        at, was = popped.setdefault(h // n_entries, ([], []))
        at += rows
        was += [h % n_entries] * len(rows)
    for p, (at, was) in popped.items():
        a, b = book.cuts[p : p + 2]
        best, slack = book.scan(p, block[at, a:b])
        keys = slack + book.drift[p, best]
        for row, entry, key in zip(at, best.tolist(), keys.tolist(), strict=True):
            heapq.heappush(heaps.heap(p * n_entries + entry), (key, row))
        np.add.at(sums[:, a:b], best, block[at, a:b])
        np.subtract.at(sums[:, a:b], was, block[at, a:b])
        counts[p] += np.bincount(best, minlength=n_entries) - np.bincount(was, minlength=n_entries)
        scans += len(at)
    return heaps.put_back(), sums, counts, scans


def scaled(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int32)


_STATE = ("block binary", "keys binary", "rows binary", "ends binary", "changes array<long>", "scans long")


def _state(ids: pa.Array, labels: pa.Array, block: np.ndarray, made: tuple[Heaps, np.ndarray, np.ndarray, int]) -> pa.RecordBatch:
    heaps, sums, counts, scans = made
    one = lambda x: pa.array([x.tobytes()], pa.binary())
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    columns = [whole(ids), whole(labels), one(block), one(heaps.keys), one(heaps.rows), one(heaps.ends), pa.array([np.concatenate((counts.ravel(), sums.ravel()))], pa.list_(pa.int64())), pa.array([scans], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["ids", "labels", *(c.split()[0] for c in _STATE)])


def _of_state(batch: pa.RecordBatch, i: int, dims: int) -> tuple[pa.Array, pa.Array, np.ndarray, Heaps]:
    raw = lambda k, kind: np.frombuffer(batch.column(k)[i].as_py(), kind)
    ids, labels = (batch.column(k)[i].values for k in (0, 1))
    return ids, labels, raw(2, np.int32).reshape(len(ids), dims), Heaps(raw(3, np.float64), raw(4, np.int32), raw(5, np.int32))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scans: list[int] | None = None) -> DataFrame:
    """vec_id, label, code, error of each kept vector, and the books' digest. ``scans`` gets how many parts each assignment scanned."""
    kept = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    kept = kept.where(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    kinds = dict(kept.dtypes)
    out = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    by_id = (F.col("vec_id").asc_nulls_last(), F.col("vec"))
    short, long_ = kept.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if short is None:
        return vectors.sparkSession.createDataFrame([], out + ", codebooks_sha256 string")
    dims = short if short == long_ else kept.orderBy(*by_id).select(F.size("vec")).first()[0]
    fitting = kept if short == long_ else kept.where(F.size("vec") == dims)
    start = [r[0] for r in fitting.orderBy(*by_id).select("vec").limit(entries).collect()]  # as many as a codebook has
    book = Book.of(scaled(np.array(start, np.float64).reshape(len(start), dims)).astype(np.int64), parts)
    rows = max(1, BLOCK_BYTES // max(1, 4 * dims))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            while held and (last or sum(map(len, held)) >= rows):
                table = pa.Table.from_batches(held).combine_chunks()
                held[:] = table.slice(rows).to_batches()
                some = table.slice(0, rows).combine_chunks().to_batches()[0]
                block = scaled(some.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(some), dims))
                yield _state(some.column(0), some.column(1), block, _first(block, book))

        for batch in batches:
            if len(batch):
                held.append(batch)
            yield from blocks(False)
        yield from blocks(True)

    schema = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, {', '.join(_STATE)}"
    state = saved(fitting.mapInArrow(begin, schema), "heaps")
    counts, sums = np.zeros(book.drift.shape, np.int64), np.zeros(book.entries.shape, np.int64)
    for _ in range(rounds):
        # One number for each entry and for each of its components.
        changes = state.select(F.posexplode("changes").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(counts.size + sums.size, np.int64)
        for at, x in changes:
            flat[at] = x
        counts += flat[: counts.size].reshape(counts.shape)
        sums += flat[counts.size :].reshape(sums.shape)
        if scans is not None:
            scans.append(state.agg(F.sum("scans")).first()[0])
        book = book.moved(sums, counts)

        def advance(batches: Iterator[pa.RecordBatch], book: Book = book) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    ids, labels, block, heaps = _of_state(batch, i, dims)
                    yield _state(ids, labels, block, _next(block, heaps, book))

        later = saved(state.mapInArrow(advance, schema), "heaps")
        drop(state)
        state = later
    if scans is not None:
        scans.append(state.agg(F.sum("scans")).first()[0])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, labels, block, heaps = _of_state(batch, i, dims)
                codes, error = heaps.codes(len(ids), parts), np.zeros(len(ids), np.int64)
                for p, (a, b) in enumerate(zip(book.cuts, book.cuts[1:], strict=False)):
                    error += np.square(block[:, a:b].astype(np.int64) - book.entries[codes[:, p], a:b]).sum(1)
                text = codes.astype(np.uint8).tobytes().hex()
                code = [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    coded = state.select("ids", "labels", "block", "keys", "rows", "ends").mapInArrow(end, out)
    if short != long_:
        nothing = [F.lit(None).cast(k).alias(n) for n, k in (("code", "string"), ("error", "long"))]
        coded = coded.union(kept.where(F.size("vec") != dims).select("vec_id", "label", *nothing))
    return coded.withColumn("codebooks_sha256", F.lit(book.digest()))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the sum of the errors of all vectors of a label; those without one together."""
    coded = saved(coded, "codes")
    keys = [F.col("label").isNull().alias("_none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label")]
    sums = saved(coded.groupBy(*keys).agg(F.sum("error").alias("label_error")), "label-errors")
    return with_small(coded.select("*", *keys), sums, ["_none", "_label"], "inner").drop("_none", "_label")


def codes_query(vectors: DataFrame) -> DataFrame:
    return with_label_errors(compress(vectors)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    """16 parts of 4 components; every assignment scans all entries."""
    xs = [f"x{k}" for k in range(4)]
    book = "sha256(string_agg(x0 || ',' || x1 || ',' || x2 || ',' || x3, ',' ORDER BY pos, e))"
    far = " + ".join(f"(p.{x} - c.{x}) * (p.{x} - c.{x})" for x in xs)
    steps = [
        "k AS (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS (SELECT vec_id, pos, " + ", ".join(f"CAST(floor(256 * CAST(embedding[4 * pos + {i + 1}] AS DOUBLE)) AS BIGINT) AS {x}" for i, x in enumerate(xs)) + " FROM k, range(16) AS t(pos))",
        "c0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, " + ", ".join(xs) + " FROM p QUALIFY row_number() OVER (PARTITION BY pos ORDER BY vec_id) <= 64)",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS (SELECT vec_id, pos, min(({far}) * 64 + e) AS m FROM p JOIN c{r} c USING (pos) GROUP BY vec_id, pos)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT pos, m % 64 AS e, " + ", ".join(f"CAST(floor(sum({x}) / count(*)) AS BIGINT) AS {x}" for x in xs) + f" FROM a{r} JOIN p USING (vec_id, pos) GROUP BY pos, m % 64)")
            steps.append(f"c{r + 1} AS (SELECT c.pos, c.e, " + ", ".join(f"coalesce(m.{x}, c.{x}) AS {x}" for x in xs) + f" FROM c{r} c LEFT JOIN m{r} m ON c.pos = m.pos AND c.e = m.e)")
    steps.append(f"v AS (SELECT vec_id, string_agg(printf('%02x', CAST(m % 64 AS INTEGER)), '' ORDER BY pos) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    return "WITH " + ", ".join(steps) + f" SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT {book} FROM c{rounds}) AS codebooks_sha256 FROM v JOIN k USING (vec_id)"


ORACLE_SQL = _sql()
