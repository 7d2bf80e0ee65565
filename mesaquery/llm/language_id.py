"""Language identification of mixed texts: script ranges, word scores and a Viterbi path.

A word's script, that of most of its letters by their ranges, narrows the languages to those that use
it. Marks that combine with a letter, such as vowel signs, belong to its word. Each language scores a word by the log-probabilities of its hashed character n-grams. A Viterbi path with
a penalty for each switch labels every word; runs of one label are the spans. The language of most
letters is the document's.

The model is fitted on at most about ``sample`` labelled documents of each language, taken by a hash
of their ids: a documented bound, as a classifier needs no more. Prediction reads the text alone.

Where no other language beats the best one by half the penalty over any stretch, no path with a
switch can win, so that the best language labels all words; other texts go through the full search.

Defined results: null texts and texts without letters are ``und`` with score 0; ties go to the first
language in alphabetical order; without training documents everything is ``und``.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesaquery.llm.common import claim, give_back
from mesaquery.llm.tokens import few_rows

#: Hash cells of the n-gram model: a fixed size for each language.
CELLS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.5
SWITCH_PENALTY = 25.0
#: Loss of a language that doesn't use a word's script.
FOREIGN = -40.0
#: A language uses a script if so many of its letters in training are of that script.
USES = 0.01
CACHE_WORDS = 200_000
#: Texts that are labelled, and words that are scored, at once: bounds on a worker's memory.
ROWS, NEW_WORDS = 256, 16_384
LETTERS = re.compile(r"[^\W\d_]+")
#: Code points among which there are combining marks, roughly: other texts need no search for them.
_MAY_COMBINE = re.compile("[\u0300-\u036f\u0483-\u0489\u0591-\u1fff\u20d0-\u20f0\u2cef-\u2fff\u302a-\u309a\ua000-\uabff\ufb00-\ufeff\U00010000-\U0010ffff]")
#: First and last code point of Unicode blocks, by script.
SCRIPTS = (
    ("latin", ((0x0041, 0x024F), (0x1E00, 0x1EFF))),
    ("greek", ((0x0370, 0x03FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x0400, 0x052F),)),
    ("armenian", ((0x0530, 0x058F),)),
    ("hebrew", ((0x0590, 0x05FF),)),
    ("arabic", ((0x0600, 0x06FF), (0x0750, 0x077F))),
    ("devanagari", ((0x0900, 0x097F),)),
    ("bengali", ((0x0980, 0x09FF),)),
    ("thai", ((0x0E00, 0x0E7F),)),
    ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF),)),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
)
OTHER = len(SCRIPTS)


@cache
def _letters_and_marks() -> re.Pattern[str]:
    """A letter and the letters and combining marks after it."""
    marks, start = [], None
    for point in range(0x300, sys.maxunicode + 2):
        if is_mark := point <= sys.maxunicode and unicodedata.category(chr(point))[0] == "M":
            start = point if start is None else start
        if not is_mark and start is not None:
            marks.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    return re.compile(rf"[^\W\d_](?:[^\W\d_]|[{''.join(marks)}])*")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if text.isascii() or not _MAY_COMBINE.search(text):
        return LETTERS.findall(text)
    return _letters_and_marks().findall(text)


def script_of(points: np.ndarray) -> np.ndarray:
    """Number of the script of each code point."""
    out = np.full(len(points), OTHER, np.int64)
    for k, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            out[(points >= a) & (points <= b)] = k
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all n-grams of the words with a space on either side; word of each; letters by word and script."""
    joined = " " + " ".join(words) + " "
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    word = np.cumsum(space) - 1  # a space belongs to the word that it opens
    cells, of_word = [], []
    for n in ORDERS:
        if len(points) < n:
            break
        h = np.full(len(points) - n + 1, n, np.uint64)
        inner = np.zeros(len(h), bool)
        for i in range(n):
            h = (h ^ points[i : len(h) + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < i < n - 1:
                inner |= space[i : len(h) + i]
        ok = ~inner
        if n == 1:
            ok &= ~space
        elif n == 2:
            ok &= ~(space[:-1] & space[1:])
        # The n-gram is its last letter's word's, but for one that ends in the closing space.
        owner = np.where(space[n - 1 :], word[: len(h)], word[n - 1 :])
        cells.append((h[ok] % np.uint64(CELLS)).astype(np.int64))
        of_word.append(owner[ok])
    letters = ~space
    scripts = np.bincount(word[letters] * (OTHER + 1) + script_of(points[letters].astype(np.int64)), minlength=len(words) * (OTHER + 1))
    return np.concatenate(cells), np.concatenate(of_word), scripts.reshape(len(words), OTHER + 1)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # cells x languages
    uses: np.ndarray  # scripts x languages: 0 or FOREIGN

    def scores(self, words: list[str]) -> np.ndarray:
        cells, of_word, scripts = features(words)
        order = np.argsort(of_word, kind="stable")
        starts = np.searchsorted(of_word[order], np.arange(len(words)))
        return np.add.reduceat(self.log_p[cells[order]], starts, axis=0).astype(np.float64) + self.uses[scripts.argmax(1)]


def is_training(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def fit(docs: DataFrame, sample: int = 1500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the given labelled documents; the n-gram counts of a sample are summed by Spark."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    found = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    languages = sorted(found)
    if not languages:
        return Model([], np.zeros((CELLS, 0)), np.zeros((OTHER + 1, 0)))
    share = F.create_map(*chain.from_iterable((F.lit(x), F.lit(int(min(1.0, sample / found[x]) * (1 << 30)))) for x in languages))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.element_at(share, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        sums = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if words := words_of(text):
                    cells, _, scripts = features(words)
                    own = sums.setdefault(lang, np.zeros(CELLS + OTHER + 1, np.int64))
                    own[:CELLS] += np.bincount(cells, minlength=CELLS)
                    own[CELLS:] += scripts.sum(0)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "cell": pa.array(at, pa.int32()), "n": pa.array(own[at], pa.int64())})

    sums = chosen.select("lang", "text").mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((CELLS + OTHER + 1, len(languages)))
    counts[sums["cell"].to_numpy(np.int64), sums["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)] = sums["n"]
    grams, letters = counts[:CELLS], counts[CELLS:]
    log_p = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * CELLS))
    used = letters >= USES * np.maximum(1, letters.sum(0))
    # A script that no language uses narrows nothing.
    uses = np.where(used | ~used.any(1, keepdims=True), 0.0, FOREIGN)
    return Model(languages, log_p.astype(np.float32), uses)


def path_of(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word (rows) under a penalty for each switch."""
    n, k = scores.shape
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, [best]], axis=0)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
    # A stretch's gain is a difference of two sums, of which the earlier may be the empty one.
    if (gain - np.vstack((np.zeros((1, k)), low[:-1]))).max(initial=0.0) <= penalty / 2:
        return np.full(n, best, np.int64)
    back, now = np.empty((n, k), np.int8 if k < 128 else np.int32), scores[0].tolist()
    labels = range(k)
    for t, row in enumerate(scores.tolist()[1:], 1):
        top = max(labels, key=now.__getitem__)
        floor = now[top] - penalty
        came = [j if now[j] >= floor else top for j in labels]
        now = [max(now[j], floor) + row[j] for j in labels]
        back[t] = came
    out = np.empty(n, np.int64)
    at = max(labels, key=now.__getitem__)
    for t in range(n - 1, -1, -1):
        out[t] = at
        if t:
            at = int(back[t, at])
    return out


class _Scores(dict):
    def __init__(self, new: list[str]):
        self.new = new

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


class Labeller:
    """Labels words by a model; scores of words that a worker has met are kept."""

    def __init__(self, model: Model):
        self.model, self.new = model, []
        self._reset()

    def _reset(self) -> None:
        self.index = _Scores(self.new)
        self.table, self.filled = np.empty((1024, len(self.model.languages))), 0

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        if len(self.index) > CACHE_WORDS:
            self._reset()
        if not self.model.languages:
            return [("und", 0.0, [])] * len(texts)
        words = [words_of(t) for t in texts]
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64)
        if self.new:
            end = self.filled + len(self.new)
            if end > len(self.table):  # twice as large, so that few copies are made
                self.table = np.concatenate((self.table[: self.filled], np.empty((max(end, 2 * len(self.table)) - self.filled, self.table.shape[1]))))
            for a in range(0, len(self.new), NEW_WORDS):
                some = self.new[a : a + NEW_WORDS]
                self.table[self.filled + a : self.filled + a + len(some)] = self.model.scores(some)
            self.filled = end
            self.new.clear()
        out, a = [], 0
        for w in words:
            scores = self.table[at[a : a + len(w)]]
            a += len(w)
            out.append(self._of(w, scores) if w else ("und", 0.0, []))
        return out

    def _of(self, words: list[str], scores: np.ndarray) -> tuple[str, float, list[dict]]:
        path = path_of(scores)
        letters = np.bincount(path, np.fromiter(map(len, words), np.int64, len(words)), scores.shape[1])
        lang = int(letters.argmax())
        total = scores[path == lang].sum(0)
        sure = 1 / np.exp(np.minimum(total - total[lang], 50)).sum()
        starts = np.flatnonzero(np.diff(path, prepend=-1))
        spans = [{"first_word": int(i), "n_words": int(j - i), "lang": self.model.languages[path[i]]} for i, j in zip(starts, np.append(starts[1:], len(path)), strict=True)]
        return self.model.languages[lang], float(min(1.0, sure * letters[lang] / letters.sum())), spans


SPANS = "array<struct<first_word:int,n_words:int,lang:string>>"


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and the labelled spans of words, for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS x languages numbers
    kinds = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        labeller = Labeller(shared.value)
        for batch in few_rows(batches, ROWS):
            if batch.num_rows:
                langs, scores, spans = zip(*labeller.label(batch.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(langs), "score": pa.array(scores, pa.float64()), "spans": pa.array(spans, kinds)})
        del labeller
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(label, f"doc_id long, lang_pred string, score double, spans {SPANS}")


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as they are, with lang_pred: one pass, without a join back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS x languages numbers
    at = docs.columns.index(text_col)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        labeller = Labeller(shared.value)
        for batch in few_rows(batches, ROWS):
            if batch.num_rows:
                texts = batch.column(0).field(at).to_pylist()
                yield pa.RecordBatch.from_pydict({"row": batch.column(0), "lang_pred": pa.array([x[0] for x in labeller.label(texts)])})
        del labeller
        give_back()

    kinds = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType())])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).mapInArrow(label, kinds)


def languages_of(docs: DataFrame, sample: int = 1500) -> DataFrame:
    """Fit on the documents that aren't held out, and predict all."""
    predicted = identify(docs, fit(docs.where(is_training("doc_id")), sample))
    held_out = F.coalesce(~is_training("doc_id"), F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "spans")
