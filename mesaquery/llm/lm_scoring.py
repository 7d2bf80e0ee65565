"""Language-model scoring by cross-entropy difference.

Two bigram models, of a target (documents of good quality) and of the background (all others), share
one vocabulary: all words of all documents. They are matched: of one order and one smoothing, and
with counts scaled to the same number of tokens, so that neither is surer for being larger. A
document's score is the mean over its tokens of the target's loss less the background's: low scores
look like the target. A document is scored by models without its own words (leave one out), as its
own counts would vouch for it.

All words and bigrams are counted, and what is gathered grows with the input, in the cluster alone:

1. *Chunks.* Texts become numbers of words in chunks of about ``CHUNK_TOKENS`` tokens, saved once.
2. *Requests.* A chunk sends each distinct word and bigram once, as a sorted 64-bit hash with its
   counts, to the part of that hash. However frequent one is, a part gets it once from each chunk.
3. *Replies.* A part sums the counts and replies to each chunk in the order of its request.
4. *Losses.* A chunk meets its replies, takes each document's own counts away and adds up losses.

With c the counts and N the tokens of a side, scaled, and V words, P(b) = (c(b) + A) / (N + A (V + 1))
and P(b | a) = (c(ab) + M P(b)) / (c(a) + M), where A is ``SMOOTHING`` and M ``PRIOR``. A text's first
word has P(b).

Defined results: words are what white space parts, in lower case; null and wordless texts have no
tokens and null losses and score; without target documents its model is uniform, and likewise the
background's; rows with a null id are scored as any other, repeated rows count and are scored each
(a copy is another document); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import claim, give_back, saved, with_small
from mesaquery.llm.jaccard_join import mix
from mesaquery.llm.tokens import texts_of

#: Additive smoothing of words, and the weight of the word model in the bigram one.
SMOOTHING, PRIOR = 0.5, 1.0
#: Tokens of a chunk, and of what a part sums up: bounds on a worker's memory, without effect on results.
CHUNK_TOKENS, PART_TOKENS = 1 << 20, 1 << 20
#: Parts that a chunk's request is dealt to at most: what a chunk sends to one shouldn't get tiny.
MOST_PARTS = 20_000
TARGET, BACKGROUND, NEITHER = 1, 0, -1
_NULL = 16  # added to the side of a row without an id

_CHUNK = "chunk long, n_tokens long, n_target long, n_background long, ids binary, sides binary, sizes binary, words binary, vocabulary binary"
_REPLY = "chunk long, part int, n_words long, words binary, pairs binary"
_SCORE = "doc_id long, n_tokens long, target_loss double, background_loss double"


def _packed(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True)


def _unpacked(x: bytes, kind: str) -> np.ndarray:
    n = int.from_bytes(x[:8], "little")
    return np.frombuffer(pa.decompress(x[8:], n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind) if n else np.empty(0, kind)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted hashes as the first one and the gaps between them, in 6 bytes each where these do."""
    if len(keys) < 2 or int((gaps := np.diff(keys)).max()) >> 48:
        return b"\0" + keys.astype("<u8").tobytes()
    return b"\1" + keys[:1].astype("<u8").tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_gaps(x: bytes) -> np.ndarray:
    if len(x) == 1:
        return np.empty(0, "<u8")
    if not x[0]:
        return np.frombuffer(x, "<u8", offset=1)
    gaps = np.zeros(((len(x) - 9) // 6, 8), np.uint8)
    gaps[:, :6] = np.frombuffer(x, np.uint8, offset=9).reshape(-1, 6)
    return np.cumsum(np.concatenate((np.frombuffer(x, "<u8", 1, 1), gaps.view("<u8").ravel())), dtype=np.uint64)


class _Numbers(dict):
    """Number of each word in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunks(docs: DataFrame) -> DataFrame:
    """Saved chunks of rows (doc_id, side, text)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        claim("lm")
        part, made = TaskContext.get().partitionId(), 0
        index, ids, sides, words, held = _Numbers(), [], [], [], 0

        def row() -> pa.RecordBatch:
            sizes, side = np.array([len(x) for x in words], np.int64), np.array(sides, np.int8)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, index), np.uint64, len(index))
            flat = np.concatenate(words) if words else np.empty(0, np.uint32)
            values = {"chunk": part << 32 | made, "n_tokens": int(sizes.sum())} | {n: int(sizes[side == k].sum()) for n, k in (("n_target", TARGET), ("n_background", BACKGROUND))}
            values |= {"ids": pa.array(ids, pa.int64()).fill_null(0).to_numpy(), "sides": side + _NULL * np.array([x is None for x in ids], np.int8), "sizes": sizes, "words": flat, "vocabulary": hashes}
            return pa.RecordBatch.from_pydict({k: pa.array([_packed(v)], pa.binary()) if isinstance(v, np.ndarray) else pa.array([v], pa.int64()) for k, v in values.items()})

        for batch in batches:
            for doc, side, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(pc.utf8_lower(batch.column(2))), strict=True):
                found = (text or b"").split()
                ids.append(doc)
                sides.append(side)
                words.append(np.fromiter(map(index.__getitem__, found), np.uint32, len(found)))
                held += len(found)
                if held >= CHUNK_TOKENS:
                    yield row()
                    index, ids, sides, words, held, made = _Numbers(), [], [], [], 0, made + 1
        if ids:
            yield row()
        del index, words
        give_back()

    return saved(docs.select("doc_id", "side", "text").mapInArrow(pack, _CHUNK), "lm-chunks")


class _Chunk:
    """A chunk's tokens, and its distinct words' and bigrams' hashes in order."""

    def __init__(self, row: dict):
        marks = _unpacked(row["sides"], "i1")
        self.null = marks >= _NULL - 1
        self.side = marks - _NULL * self.null
        self.ids, self.sizes = _unpacked(row["ids"], "i8"), _unpacked(row["sizes"], "i8")
        words, vocabulary = _unpacked(row["words"], "u4"), _unpacked(row["vocabulary"], "u8")
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.argsort(vocabulary)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.word = vocabulary[order], place[words]
        starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        self.later = np.ones(len(words), bool)  # tokens with a word before them
        self.later[starts] = False
        after = np.flatnonzero(self.later)
        self.before = self.word[after - 1]
        keys = mix(mix(self.words + np.uint64(1))[self.before] + self.words[self.word[after]])
        self.pairs, self.pair = np.unique(keys, return_inverse=True)

    def counts(self, of: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """How often each of n occurs, in documents of either side: target's first."""
        side = self.side[doc]
        return np.concatenate([np.bincount(of[side == k], minlength=n) for k in (TARGET, BACKGROUND)])


def _own(doc: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """For each token how often its document holds what it is one of."""
    _, at, times = np.unique(doc * np.int64(max(1, n)) + of, return_inverse=True, return_counts=True)
    return times[at]


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's keys start, of sorted ones; equal ranges of the hashes make a part."""
    first = np.array([(k << 64) // parts for k in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, first), len(keys))


def _requests(chunks: DataFrame, parts: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lm")
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row)
                sent = []
                for keys, of, doc in ((c.words, c.word, c.doc), (c.pairs, c.pair, c.doc[c.later])):
                    n, at = c.counts(of, doc, len(keys)).reshape(2, -1), _bounds(keys, parts)
                    sent.append([(_gaps(keys[a:b]), _packed(n[:, a:b].astype("<u4").ravel())) for a, b in zip(at[:-1], at[1:], strict=True)])
                for a in range(0, parts, 256):
                    rows = [(row["chunk"], p, *sent[0][p], *sent[1][p]) for p in range(a, min(a + 256, parts))]
                    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4)
                    yield pa.RecordBatch.from_pydict({n: pa.array(x, k) for n, x, k in zip(("chunk", "part", "words", "n_words", "pairs", "n_pairs"), zip(*rows, strict=True), kinds, strict=True)})
                del c, sent
        give_back()

    return chunks.mapInArrow(ask, "chunk long, part int, words binary, n_words binary, pairs binary, n_pairs binary")


def _replies(requests: DataFrame) -> DataFrame:
    """To each chunk the sums of what it asked for, in its order; rows without a chunk count a part's words."""

    def answer(group: pa.Table) -> pa.Table:
        claim("lm")
        chunks, part, back, distinct = group.column("chunk").to_pylist(), group.column("part")[0].as_py(), [], []
        for what in ("words", "pairs"):
            asked = [_from_gaps(x) for x in group.column(what).to_pylist()]
            n = np.concatenate([_unpacked(x, "<u4").reshape(2, -1) for x in group.column("n_" + what).to_pylist()], axis=1)
            keys, of = np.unique(np.concatenate(asked), return_inverse=True)
            sums = np.stack([np.bincount(of, x, len(keys)).astype("<i8") for x in n])[:, of]
            at = np.cumsum([0, *map(len, asked)])
            back.append([_packed(sums[:, a:b].ravel()) for a, b in zip(at[:-1], at[1:], strict=True)])
            distinct.append(len(keys))
            del asked, n, keys, of, sums
        give_back()
        columns = ([*chunks, None], [part] * (len(chunks) + 1), [0] * len(chunks) + distinct[:1], [*back[0], None], [*back[1], None])
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(x, k) for n, x, k in zip(("chunk", "part", "n_words", "words", "pairs"), columns, kinds, strict=True)})

    return saved(requests.groupBy("part").applyInArrow(answer, _REPLY), "lm-replies")


def _losses(c: _Chunk, words: np.ndarray, pairs: np.ndarray, totals: tuple[int, int], size: int) -> list[np.ndarray]:
    """Of each document the sum of its tokens' losses under the target's and the background's model."""
    least = min(totals) or max(totals)
    own_word, own_pair = _own(c.doc, c.word, len(c.words)), _own(c.doc[c.later], c.pair, len(c.pairs))
    after = np.flatnonzero(c.later)
    out = []
    for k, side in enumerate((TARGET, BACKGROUND)):
        scale = least / totals[k] if totals[k] else 1.0
        mine = (c.side == side)[c.doc]
        n_word = words[k][c.word] - own_word * mine
        n_all = totals[k] - (c.sizes * (c.side == side))[c.doc]
        p = (scale * n_word + SMOOTHING) / (scale * n_all + SMOOTHING * (size + 1))
        n_pair = pairs[k][c.pair] - own_pair * mine[after]
        # How often a document holds the word before is what it has of that word at its place.
        n_before = n_word[after - 1]
        p[after] = (scale * n_pair + PRIOR * p[after]) / (scale * n_before + PRIOR)
        out.append(np.bincount(c.doc, -np.log(p), len(c.sizes)))
    return out


def _scores(chunks: DataFrame, replies: DataFrame, totals: tuple[int, int], size: int) -> DataFrame:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        claim("lm")
        out = []
        for row in left.to_pylist():
            c = _Chunk(row)
            rows = sorted(right.select(["part", "words", "pairs"]).to_pylist(), key=lambda r: r["part"])
            words, pairs = (np.concatenate([_unpacked(r[x], "<i8").reshape(2, -1) for r in rows], axis=1) for x in ("words", "pairs"))
            sums = _losses(c, words, pairs, totals, size)
            none = c.sizes == 0
            means = [pa.array(x / np.maximum(c.sizes, 1), mask=none) for x in sums]
            out.append(pa.table({"doc_id": pa.array(c.ids, mask=c.null), "n_tokens": pa.array(c.sizes), "target_loss": means[0], "background_loss": means[1]}))
            del c
        give_back()
        return pa.concat_tables(out)

    return chunks.groupBy("chunk").cogroup(replies.where("chunk IS NOT NULL").groupBy("chunk")).applyInArrow(score, _SCORE)


def score(docs: DataFrame, side: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means per token) and their difference, of all rows.

    ``side`` says whether a row is of the target; rows where it's null are scored but not counted.
    """
    number = F.when(side, TARGET).when(~side, BACKGROUND).otherwise(NEITHER).cast("int")
    chunks = _chunks(docs.select(F.col(id_col).cast("long").alias("doc_id"), number.alias("side"), F.col(text_col).alias("text")))
    sums = [F.coalesce(F.sum(x), F.lit(0)) for x in ("n_tokens", "n_target", "n_background")]
    n_tokens, n_target, n_background = chunks.agg(*sums).first()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // PART_TOKENS))
    replies = _replies(_requests(chunks, min(parts, MOST_PARTS)))
    size = replies.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    means = _scores(chunks, replies, (n_target, n_background), size)
    return means.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents: those labelled as of good quality are the target, all others the background."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().withColumn("_good", F.lit(True))
    marked = with_small(docs.select("doc_id", "text"), good, ["doc_id"], "left")
    return score(marked, F.coalesce("_good", F.lit(False)))


def _loss_sql(side: str) -> str:
    alone = f"(k{side} * u.{side} + 0.5) / (k{side} * a.{side} + 0.5 * (v + 1))"
    return f"-ln(CASE WHEN u.prev IS NULL THEN {alone} ELSE (k{side} * u.p{side} + {alone}) / (k{side} * u.q{side} + 1) END)"


#: Both models on documents and labels: t of the target, b of the background; words are as the operator's.
ORACLE_SQL = rf"""
WITH g AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
d AS (SELECT row_number() OVER () AS rid, d.doc_id, CAST(g.doc_id IS NOT NULL AS INTEGER) AS good, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id),
t AS (SELECT rid, good, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
b AS (SELECT rid, good, word, lag(word) OVER (PARTITION BY rid ORDER BY i) AS prev FROM t),
n AS (SELECT sum(good) AS t, sum(1 - good) AS b, count(DISTINCT word) AS v FROM t),
k AS (SELECT v, CASE WHEN t > 0 THEN CASE WHEN b > 0 THEN least(t, b) ELSE t END / t::DOUBLE ELSE 1 END AS kt, CASE WHEN b > 0 THEN CASE WHEN t > 0 THEN least(t, b) ELSE b END / b::DOUBLE ELSE 1 END AS kb FROM n),
u1 AS (SELECT word, sum(good) AS t, sum(1 - good) AS b FROM t GROUP BY word),
u2 AS (SELECT prev, word, sum(good) AS t, sum(1 - good) AS b FROM b WHERE prev IS NOT NULL GROUP BY prev, word),
o1 AS (SELECT rid, word, count(*) AS n FROM t GROUP BY rid, word),
o2 AS (SELECT rid, prev, word, count(*) AS n FROM b WHERE prev IS NOT NULL GROUP BY rid, prev, word),
a AS (SELECT rid, n.t - good * len(w) AS t, n.b - (1 - good) * len(w) AS b FROM d, n),
u AS (SELECT b.rid, b.prev, w.t - good * ow.n AS t, w.b - (1 - good) * ow.n AS b, q.t - good * oq.n AS qt, q.b - (1 - good) * oq.n AS qb, p.t - good * op.n AS pt, p.b - (1 - good) * op.n AS pb
 FROM b JOIN u1 w ON w.word = b.word JOIN o1 ow ON ow.rid = b.rid AND ow.word = b.word LEFT JOIN u1 q ON q.word = b.prev LEFT JOIN o1 oq ON oq.rid = b.rid AND oq.word = b.prev
 LEFT JOIN u2 p ON p.prev = b.prev AND p.word = b.word LEFT JOIN o2 op ON op.rid = b.rid AND op.prev = b.prev AND op.word = b.word),
l AS (SELECT u.rid, avg({_loss_sql("t")}) AS t, avg({_loss_sql("b")}) AS b FROM u JOIN a ON a.rid = u.rid, k GROUP BY u.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, round(l.t, 6) AS target_loss, round(l.b, 6) AS background_loss, round(l.t - l.b, 6) AS score FROM d LEFT JOIN l ON l.rid = d.rid
"""
