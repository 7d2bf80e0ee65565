"""Best-fit packing of token sequences by a linear grouping scheme.

Only the histogram of lengths decides the packing, and lengths are bounded by the capacity, so that
the plan is made on a table of at most ``capacity`` rows whatever the corpus holds:

1. large lengths (over ``small`` tokens), sorted downwards, are cut into ``groups`` groups of equal
   cardinality and every length is rounded up to the largest of its group: few sizes remain;
2. configurations of these few sizes are optimised together: column generation solves the linear
   program of the fewest sequences (a revised simplex whose pricing is an exact knapsack), and its
   solution is rounded down;
3. actual documents are substituted for the rounded sizes of each configuration: the largest left of
   each slot's group, and for the last slot the largest of all that fits, which takes up what
   rounding has lost. What rounding down has left over, less than a sequence for each size, is filled by
   actual lengths, one sequence after the other by an exact knapsack;
4. small documents, longest first, each go to the fullest sequence that still holds them.

Plans are made for each of the shares ``SMALL`` of the capacity, and the one of the fewest sequences counts.

The plan is a list of runs: so many documents of one length, by rank, go to that many sequences in a
row at one offset. Documents then find their place by their rank among those of their length.

Defined results: null and empty texts hold the end id alone; longer ones than the capacity are cut
into full pieces and a rest; repeated rows are packed each; null ids stay null; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.llm.common import give_back, saved
from mesaquery.llm.tokens import CACHE_WORDS, few_rows, texts_of, word_ids

#: Bits of a document's rank among those of its length.
RANK_BITS = 50
#: Groups of large lengths: the sizes that configurations are optimised over.
GROUPS = 64
#: The simplex ends when fewer sequences are to be gained. It has so many steps for each size at most:
#: a guard against cycles, as it needs two or three.
GAIN, PIVOTS = 0.1, 100
#: Up to which shares of the capacity documents can count as small.
SMALL = (1 / 8, 1 / 5, 1 / 3)


def _fill(room: int, sizes: list[int], counts: list[int]) -> list[int]:
    """How many of each size give the largest sum of at most ``room``: an exact bounded knapsack."""
    reached = 1  # bit s: sum s can be made
    steps = []
    for size, count in zip(sizes, counts, strict=True):
        steps.append(reached)
        left, k = min(count, room // size), 1
        while left > 0:  # binary splitting of the count
            take = min(k, left)
            reached |= reached << take * size
            left, k = left - take, k * 2
        reached &= (1 << room + 1) - 1
    total, used = reached.bit_length() - 1, []
    for i in range(len(sizes) - 1, -1, -1):
        k = 0
        while not steps[i] >> total & 1:
            total, k = total - sizes[i], k + 1
        used.append(k)
    return used[::-1]


def _worthiest(capacity: int, sizes: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """How many of each size make the configuration of the most worth: an exact knapsack."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for k in np.flatnonzero(worth > 1e-12).tolist():
        size = int(sizes[k])
        for _ in range(capacity // size):
            better = best[:-size] + worth[k] > best[size:] + 1e-12
            if not better.any():
                break
            places = np.flatnonzero(better) + size
            best[places], last[places] = best[places - size] + worth[k], k
    # ``last`` is the size that came last to a sum; taking it away leaves a sum that was made before,
    # which may since have become worthier, so that the way back is never worth less.
    used, at = np.zeros(len(sizes), np.int64), int(best.argmax())
    while last[at] >= 0:
        used[last[at]] += 1
        at -= int(sizes[last[at]])
    return used


def configurations(capacity: int, sizes: list[int], counts: list[int]) -> list[tuple[list[int], int]]:
    """Configurations of the sizes and how often to use each, none more often than the counts allow.

    The basis of an optimal solution of the linear program, by column generation, rounded down.
    """
    if not sizes:
        return []
    lengths, wanted = np.array(sizes), np.array(counts, float)
    basis = np.diag(capacity // lengths).astype(float)  # a column for each configuration
    for _ in range(PIVOTS * len(sizes)):
        inverse = np.linalg.inv(basis)
        prices = inverse.sum(0)
        column = _worthiest(capacity, lengths, prices)
        worth = prices @ column
        # No solution takes fewer than value / worth sequences: stop when less than one is to be gained.
        if worth <= 1 + 1e-9 or (value := prices @ wanted) - value / worth < GAIN:
            break
        amounts, step = inverse @ wanted, inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(amounts, 0) / step, np.inf)
        basis[:, int(ratio.argmin())] = column
    amounts = np.floor(np.linalg.inv(basis) @ wanted + 1e-6).astype(np.int64)
    left, out = np.array(counts, np.int64), []
    for k in np.argsort(-amounts, kind="stable").tolist():
        config = basis[:, k].round().astype(np.int64)
        times = min(int(amounts[k]), *(left[config > 0] // config[config > 0]).tolist())
        if times > 0:
            left -= times * config
            out.append((config.tolist(), times))
    return out


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, shares: tuple[float, ...] = SMALL) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, count, first sequence, offset) and the number of sequences."""
    return min((_plan(histogram, capacity, groups, int(capacity * share)) for share in shares), key=lambda made: made[1])[:2]


class _Left:
    """The large lengths that still have documents, ascending, and how many."""

    def __init__(self, counts: dict[int, int]):
        self.counts, self.lengths = dict(counts), sorted(counts)

    def largest(self, most: int, used: Counter[int]) -> int:
        """The largest length of at most ``most`` with documents beyond those used; 0 if none."""
        i = bisect_right(self.lengths, most) - 1
        while i >= 0 and self.counts[self.lengths[i]] <= used[self.lengths[i]]:
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            self.lengths.pop(bisect_right(self.lengths, length) - 1)


def _plan(histogram: dict[int, int], capacity: int, groups: int, small: int) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """Runs, the number of sequences, and how many of them come from configurations of two documents or more."""
    runs: list[tuple[int, int, int, int, int]] = []
    rank: Counter[int] = Counter()
    sequences = several = 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, rank[length], n, first, offset))
        rank[length] += n

    if full := histogram.get(capacity, 0):
        place(capacity, full, 0, 0)
        sequences = full
    large = [(length, histogram[length]) for length in sorted(histogram, reverse=True) if small < length < capacity and histogram[length]]
    each = max(1, -(-sum(n for _, n in large) // groups))
    # Of each group the rounded size, its least length, and how many it has.
    sizes: list[int] = []
    least: list[int] = []
    counts: list[int] = []
    room = 0
    for length, n in large:
        while n:
            if not room:
                sizes.append(length)
                least.append(length)
                counts.append(0)
                room = each
            took = min(n, room)
            counts[-1], least[-1] = counts[-1] + took, length
            n, room = n - took, room - took
    left = _Left(dict(large))
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: [(first sequence, count)]

    def put(used: Counter[int], most: int | None = None) -> int:
        """So many sequences of these lengths as there are documents for; says how many."""
        nonlocal sequences
        n = min(left.counts[length] // k for length, k in used.items())
        n = n if most is None else min(n, most)
        offset = 0
        for length, k in used.items():
            left.take(length, n * k)
            for _ in range(k):
                place(length, n, sequences, offset)
                offset += length
        open_[capacity - offset].append((sequences, n))
        sequences += n
        return n

    def substituted(slots: list[int]) -> Counter[int] | None:
        """Actual lengths for a configuration: the largest of each slot's group, and for the last slot what fits best."""
        used: Counter[int] = Counter()
        free = capacity
        for j, g in enumerate(slots):
            length = left.largest(free if j == len(slots) - 1 else sizes[g], used)
            if length < least[g]:
                return None  # the group has run out
            used[length] += 1
            free -= length
        return used

    for config, times in configurations(capacity, sizes, counts):
        slots = [g for g, k in enumerate(config) for _ in range(k)]
        while times and (used := substituted(slots)):
            n = put(used, times)
            times -= n
            several += n if len(slots) > 1 else 0
    while left.lengths:  # what rounding down has left, by actual lengths
        down = left.lengths[::-1]
        rest = _fill(capacity - down[0], down, [left.counts[down[0]] - 1, *(left.counts[x] for x in down[1:])])
        put(Counter({length: k + (i == 0) for i, (length, k) in enumerate(zip(down, rest, strict=True)) if k or not i}))

    rooms = sorted(open_)
    for length in (x for x in sorted(histogram, reverse=True) if x <= small and histogram[x]):
        left = histogram[length]
        while left:
            i = int(np.searchsorted(rooms, length))
            while i < len(rooms) and not open_[rooms[i]]:
                i += 1
            if i == len(rooms):
                free = capacity
                first, n = sequences, -(-left // (capacity // length))
                sequences += n
            else:
                free = rooms[i]
                first, n = open_[free].pop()
            fits = free // length
            whole = min(n, left // fits)
            for j in range(fits if whole else 0):
                place(length, whole, first, capacity - free + j * length)
            left -= whole * fits
            if whole:
                open_[free - fits * length].append((first, whole))
            if whole < n and left:  # one sequence takes what is left, less than it could
                for j in range(left):
                    place(length, 1, first + whole, capacity - free + j * length)
                open_[free - left * length].append((first + whole, 1))
                whole, left = whole + 1, 0
            if whole < n:
                open_[free].append((first + whole, n - whole))
            rooms = sorted(r for r in open_ if open_[r])
    return runs, sequences, several


def cut(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, with their rank among the part's pieces of that length."""

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, seen = word_ids(tokenizer_file, cache_words), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in few_rows(batches):
            flat, stops = encoder.encode(texts_of(batch.column(1)))
            n_docs = len(stops) - 1
            ends = stops[1:] + np.arange(1, n_docs + 1)  # one end id more for each document
            ids = np.full(len(flat) + n_docs, end_id, "<u4")
            own = np.ones(len(ids), bool)
            own[ends - 1] = False
            ids[own] = flat
            sizes = np.diff(ends, prepend=0)
            n_pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(n_docs), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            first = (ends - sizes)[doc] + start
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip((first * 4).tolist(), ((first + length) * 4).tolist(), strict=True)]
            # The rank among equal lengths: the place in a stable order less that of the first one.
            order = np.argsort(length, kind="stable")
            of_length = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - (np.cumsum(of_length) - of_length)[length[order]]
            rank += seen[length]
            seen += of_length
            columns = {"doc_id": batch.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "rank": pa.array(rank)}
            yield pa.RecordBatch.from_pydict(columns | {"part": pa.array(np.full(len(doc), part, np.int32))})
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut_texts, "doc_id long, piece int, start long, length long, ids_crc32 long, rank long, part int")


def assign(pieces: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """Give each of the saved ``pieces`` its sequence_id and offset.

    Ranks within a part become ranks in the corpus by prefix sums over the parts' histograms: rows
    of a length never meet in one task.
    """
    counts = pieces.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = saved(counts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))), "bases")
    histogram = {r[0]: r[1] for r in bases.groupBy("length").agg(F.sum("count")).collect()}  # at most capacity rows
    runs, _ = plan(histogram, capacity, groups)
    runs_ = np.array(sorted((length << RANK_BITS | rank, first - rank, offset) for length, rank, _, first, offset in runs), np.int64).reshape(-1, 3)
    # Runs follow configurations and lengths: their number is bounded by the capacity and the groups.
    shared = pieces.sparkSession.sparkContext.broadcast(runs_)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "rank"))
            run = table[np.searchsorted(table[:, 0], length << RANK_BITS | rank, "right") - 1] if len(length) else table
            kept = {x: batch.column(batch.schema.get_field_index(x)) for x in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": pa.array(run[:, 1] + rank), "offset": pa.array(run[:, 2])})

    ranked = pieces.join(bases.drop("count"), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    names = "doc_id", "piece", "start", "length", "ids_crc32", "rank"
    return ranked.select(*names).mapInArrow(look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_file: str, end_id: int = 0, capacity: int = 2048, groups: int = GROUPS, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` tokens."""
    return assign(saved(cut(docs, tokenizer_file, end_id, capacity, id_col, text_col, cache_words), "pieces"), capacity, groups)
