"""Quality rules by distribution divergence: a document's histograms against those of its language.

Two histograms of each document are held against references, one of each language, by the
Jensen-Shannon distance (base 2, between 0 and 1):

* *character classes*: how many of its characters outside white space are of each class;
* *common words*: how often it has each common word of the language, and all other words together.

A word is common in a language if it makes up one in ``COMMON`` of the words of all documents of that
language. References sum the histograms of the language's documents that pass the base rules; what these would
reject is then left out of them, once.

1. A task counts words by language and reports those of one in 2 ``COMMON`` of what it counted, with how
   far they exceed that. A word that no task reports is below that share everywhere, so that the sum of
   the excesses bounds a word's total: at most 2 ``COMMON`` words of a language can still be common.
   Rare words never leave their task.
2. One more pass makes each document's narrow row: base figures, character classes and counts of these
   words. References are sums over these rows, and verdicts come from them, so that a second round
   of references doesn't read texts again.

A document is kept if one language's references are within both limits. Both grow with the sampling
noise of a text of its length: the divergence of n draws from their own distribution over b bins is
about a chi-square of b - 1 degrees over 8 n ln 2, of which four deviations are allowed. Histograms
of fewer than ``LEAST_CHARS`` characters or ``LEAST_WORDS`` words tell too little and aren't held against
anything, nor are references of fewer than ``LEAST_REFERENCE`` words, nor documents whose own
language has too few.

Base rules: fewer than 50 words, or over half of the words in repeated windows of three words.

Defined results: null and empty texts have no words and fail; documents without a language don't
count for any reference and are held against all; without references only the base rules decide;
repeated rows count and are judged each; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import saved, with_small

#: A common word makes up one in so many words of its language.
COMMON = 500
#: Distances that are always allowed, of character classes and of common words.
CHAR_LIMIT, WORD_LIMIT = 0.2, 0.3
#: Characters and words that a histogram needs, and words that a reference needs.
LEAST_CHARS, LEAST_WORDS, LEAST_REFERENCE = 200, 50, 2000
#: How often references are made: later ones of the documents that the earlier ones keep.
ROUNDS = 2
#: Base rules: words, and percent of words in repeated windows.
BASE_WORDS, BASE_REPEATED = 50, 50
#: What is cut off a word's ends, and counted as symbols.
ENDS, SYMBOLS = ".,;:!?\"'()", "#*$%&|<>"
#: Distinct words that a task counts before it reports, and characters whose classes are told at once.
HELD_WORDS, HELD_CHARS = 200_000, 1 << 20
#: Cells of the counts of all possible words that a task holds at once.
HELD_COUNTS = 1 << 22
#: Classes of characters in order: white space, which isn't counted, then by Unicode category, where
#: sentence marks are a class of their own.
CLASSES = ("space", "upper", "lower", "letter", "digit", "mark", "punctuation", "symbol", "other")
_SPACE = " \t\n\r\x0b\x0c"


@functools.cache
def class_table() -> np.ndarray:
    """The class of each code point."""

    def of(c: str) -> str:
        if c in _SPACE or c in ENDS + "-":
            return "space" if c in _SPACE else "mark"
        kind = unicodedata.category(c)
        return {"Lu": "upper", "Ll": "lower"}.get(kind) or {"L": "letter", "M": "letter", "N": "digit", "P": "punctuation", "S": "symbol"}.get(kind[0], "other")

    return np.array([CLASSES.index(of(chr(i))) for i in range(0x110000)], np.uint8)


def classes_of(text: str) -> np.ndarray:
    """How many characters of each class a text has."""
    out = np.zeros(len(CLASSES), np.int64)
    for i in range(0, len(text), HELD_CHARS):
        points = np.frombuffer(text[i : i + HELD_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        out += np.bincount(class_table()[points], minlength=len(CLASSES))
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three words that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def plain(word: bytes) -> bytes:
    """A word without marks at its ends, A-Z lower-cased."""
    return word.strip(ENDS.encode()).lower()


@dataclass
class Figures:
    """What one text is judged by."""

    words: int
    symbols: int
    repeated_lines: int
    repeated: int
    classes: np.ndarray
    found: Counter[int]  # counts of the words that are looked for

    @classmethod
    def of(cls, text: str | None, known: dict[bytes, int]) -> Figures:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()  # at ASCII white space
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        found: Counter[int] = Counter()
        for word, n in Counter(words).items():
            if (at := known.get(plain(word))) is not None:
                found[at] += n
        return cls(len(words), sum(raw.count(c.encode()) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), classes_of(text or ""), found)


def _frequent(docs: DataFrame) -> DataFrame:
    """(lang, word) of all words that can be common, of documents (lang, text)."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[bytes]] = {}

        def rows() -> pa.RecordBatch:
            out = []
            for lang, counts in held.items():
                size = counts.total()
                out.append((lang, None, size))
                out += [(lang, w.decode(), n * 2 * COMMON - size) for w, n in counts.items() if w and n * 2 * COMMON >= size]
            held.clear()
            return pa.RecordBatch.from_pydict({k: pa.array(x, t) for k, x, t in zip(("lang", "word", "n"), zip(*out, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)})

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = held.setdefault(lang, Counter())
                for word, n in Counter((text.as_py() or "").encode("utf-8", "surrogatepass").split()).items():
                    counts[plain(word)] += n
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield rows()
        if held:
            yield rows()

    reported = docs.where("lang IS NOT NULL").select("lang", "text").mapInArrow(report, "lang string, word string, n long")
    summed = saved(reported.groupBy("lang", "word").agg(F.sum("n").alias("n")), "reported")
    totals = summed.where(F.col("word").isNull() & (F.col("n") >= LEAST_REFERENCE)).select("lang", F.col("n").alias("total"))
    return with_small(summed.where("word IS NOT NULL"), totals, ["lang"], "inner").where("n >= total").select("lang", "word")


def features(docs: DataFrame, words: list[str]) -> DataFrame:
    """doc_id, lang, the figures, classes, and (ids, counts) of the ``words`` of each text of (doc_id, lang, text)."""
    known = {w.encode(): i for i, w in enumerate(words)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [Figures.of(text.as_py(), known) for text in batch.column(2)]
            long = lambda get: pa.array([get(x) for x in made], pa.int64())
            many = lambda get: pa.array([get(x) for x in made], pa.list_(pa.int64()))
            columns = [batch.column(0), batch.column(1), long(lambda x: x.words), long(lambda x: int(x.classes[1:].sum())), long(lambda x: x.symbols), long(lambda x: x.repeated_lines), long(lambda x: x.repeated), many(lambda x: x.classes[1:].tolist()), many(lambda x: list(x.found)), many(lambda x: list(x.found.values()))]
            yield pa.RecordBatch.from_arrays(columns, _FEATURES)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "lang", "text").mapInArrow(read, f"doc_id {kind}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<long>, ids array<long>, counts array<long>")


_FEATURES = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "ids", "counts"]
_FAILED = f"(n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEATED} * n_words)"


@dataclass
class Reference:
    """A language's histograms: shares of the classes, and of its common words (by id) and all others."""

    lang: str
    classes: np.ndarray
    ids: np.ndarray
    words: np.ndarray


def references(rows: DataFrame) -> list[Reference]:
    """References of all languages, from feature rows and whether each is ``good``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By (lang, kind, id): kinds are 0 words at all, 1 classes, 2 words that are looked for.
        held: dict[tuple[str, int, int], list[int]] = {}
        for batch in batches:
            for lang, good, n, classes, ids, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind, found in ((0, ((0, n),)), (1, enumerate(classes)), (2, zip(ids, counts, strict=True))):
                    for at, x in found:
                        row = held.setdefault((lang, kind, at), [0, 0])
                        row[0] += x
                        row[1] += x if good else 0
        if held:
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in held], "kind": [k[1] for k in held], "id": [k[2] for k in held], "n": [v[0] for v in held.values()], "good": [v[1] for v in held.values()]})

    labelled = rows.where("lang IS NOT NULL").select("lang", "good", "n_words", "classes", "ids", "counts")
    each = saved(labelled.mapInArrow(sums, "lang string, kind long, id long, n long, good long").groupBy("lang", "kind", "id").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "reference-sums")
    enough = each.where(f"kind = 0 AND good >= {LEAST_REFERENCE}").select("lang")
    by: dict[str, dict[int, list[tuple[int, int, int]]]] = {}
    for lang, kind, at, n, good in with_small(each, enough, ["lang"], "inner").collect():  # a language's classes and possible words
        by.setdefault(lang, {}).setdefault(kind, []).append((at, n, good))
    out = []
    for lang, found in sorted(by.items()):
        _, all_words, good_words = found[0][0]
        classes = np.array([good for _, _, good in sorted(found[1])], np.float64)
        common = sorted((at, good) for at, n, good in found.get(2, ()) if n * COMMON >= all_words)
        shares = np.array([good for _, good in common], np.float64) / good_words
        out.append(Reference(lang, classes / classes.sum(), np.array([at for at, _ in common], np.int64), np.append(shares, 1 - shares.sum())))
    return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared Jensen-Shannon distance of the rows of ``p`` (rows, bins) to ``q``, base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0.0).sum(1) for x in (p, np.broadcast_to(q, p.shape))]
    return np.maximum(0.0, (parts[0] + parts[1]) / 2)


def allowed(limit: float, n: np.ndarray, bins: int) -> np.ndarray:
    """The divergence that ``n`` draws over so many bins may have."""
    noise = bins - 1 + 4 * math.sqrt(2 * (bins - 1))
    return limit**2 + noise / (8 * math.log(2) * np.maximum(1, n))


def _verdicts(made: DataFrame, refs: list[Reference], n_ids: int) -> DataFrame:
    """Feature rows with base_failed, kept, and the nearest references and their distances."""
    known = {r.lang for r in refs}
    at_once = max(1, HELD_COUNTS // max(1, n_ids))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), at_once):
                batch = whole.slice(start, at_once)
                n = batch.column(2).to_numpy()
                classes = np.array(batch.column(7).to_pylist(), np.float64).reshape(len(batch), len(CLASSES) - 1)
                chars = classes.sum(1)
                counts = np.zeros((len(batch), n_ids))
                sizes = np.diff(batch.column(8).offsets.to_numpy())
                counts[np.repeat(np.arange(len(batch)), sizes), batch.column(8).flatten().to_numpy()] = batch.column(9).flatten().to_numpy()
                kept = np.array([not refs or x is not None and x not in known for x in batch.column(1).to_pylist()], bool)
                nearest, best = np.full(len(batch), -1), np.full((len(batch), 3), np.inf)
                for k, ref in enumerate(refs):
                    by_class = divergence(classes / np.maximum(1, chars)[:, None], ref.classes)
                    own = counts[:, ref.ids] / np.maximum(1, n)[:, None]
                    by_word = divergence(np.column_stack((own, 1 - own.sum(1))), ref.words)
                    over_chars = np.where(chars >= LEAST_CHARS, by_class - allowed(CHAR_LIMIT, chars, len(ref.classes)), -1)
                    over_words = np.where(n >= LEAST_WORDS, by_word - allowed(WORD_LIMIT, n, len(ref.words)), -1)
                    over = np.maximum(over_chars, over_words)
                    kept |= over <= 0
                    nearer = over < best[:, 0]
                    nearest[nearer] = k
                    best[nearer] = np.column_stack((over, np.sqrt(by_class), np.sqrt(by_word)))[nearer]
                failed = (n < BASE_WORDS) | (100 * batch.column(6).to_numpy() > BASE_REPEATED * n)
                langs = pa.array([refs[k].lang if k >= 0 else None for k in nearest.tolist()], pa.string())
                more = [pa.array(failed), pa.array(kept & ~failed), langs, *(pa.array(best[:, i], mask=nearest < 0) for i in (1, 2))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*_FEATURES, "base_failed", "kept", "nearest", "char_distance", "word_distance"])

    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(judge, f"{given}, base_failed boolean, kept boolean, nearest string, char_distance double, word_distance double")


def judged(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, figures, base_failed, kept, and the nearest references with char_distance and word_distance."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    words = sorted({r[0] for r in _frequent(rows).select("word").distinct().collect()})  # up to 2 COMMON of a language
    made = saved(features(rows, words), "features")
    refs = references(made.withColumn("good", F.expr(f"NOT {_FAILED}")))
    for _ in range(rounds - 1):
        refs = references(_verdicts(made, refs, len(words)).withColumnRenamed("kept", "good"))
    return _verdicts(made, refs, len(words)).select("doc_id", *_FEATURES[2:7], "base_failed", "kept", "nearest", "char_distance", "word_distance")


def quality_query(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", *_FEATURES[2:7], "base_failed", "kept")


def _sql(rounds: int) -> str:
    """The same figures, references and distances, with all words counted."""
    white = r"[\x20\x09-\x0D]"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    marks = "[" + ENDS + r"\-]"
    quoted = lambda x: x.replace("'", "''")
    many = lambda kind: f"length(regexp_replace(t, '[^{kind}]', '', 'g'))"
    names = ("upper", "lower", "letter", "digit", "mark", "punctuation", "symbol", "other")
    kinds = {"upper": r"\p{Lu}", "lower": r"\p{Ll}", "letter": r"\p{Lt}\p{Lm}\p{Lo}\p{M}", "digit": r"\p{N}", "mark": quoted(marks[1:-1]), "punctuation": r"\p{P}", "symbol": r"\p{S}"}
    steps = [
        "t AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)",
        f"w0 AS (SELECT doc_id, lang, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, lang, regexp_extract_all(t, '[^{white[1:-1]}]+') AS l FROM t))",
        "w1 AS (SELECT *, lead(w, 1) OVER o AS x, lead(w, 2) OVER o AS y FROM w0 WINDOW o AS (PARTITION BY doc_id ORDER BY i))",
        "w2 AS (SELECT doc_id, i FROM w1 WHERE y IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w, x, y) > 1)",
        "again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM w2, range(3) AS r(k) GROUP BY doc_id)",
        f"f0 AS (SELECT doc_id, lang, length(regexp_replace(t, '{white}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^{white[1:-1]}]')) AS lines, " + ", ".join(f"{many(kinds[k])} AS {k}" for k in names[:-1]) + " FROM t)",
        f"f AS (SELECT f0.doc_id, lang, coalesce(c.n, 0) AS n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, upper, lower, letter, digit, mark, punctuation - mark AS punctuation, symbol, word_chars - upper - lower - letter - digit - punctuation - symbol AS other, coalesce(c.n, 0) < {BASE_WORDS} OR 100 * coalesce(again.n, 0) > {BASE_REPEATED} * coalesce(c.n, 0) AS base_failed FROM f0 LEFT JOIN again USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM w0 GROUP BY doc_id) c USING (doc_id))",
        f"dc AS (SELECT doc_id, translate(trim(w, '{quoted(ENDS)}'), '{upper}', '{lower}') AS p, count(*) AS n FROM w0 GROUP BY ALL)",
        f"common AS (SELECT lang, p FROM dc JOIN f USING (doc_id) WHERE lang IS NOT NULL AND p <> '' GROUP BY lang, p HAVING sum(n) * {COMMON} >= (SELECT sum(n_words) FROM f g WHERE g.lang = f.lang))",
        "v0 AS (SELECT doc_id, NOT base_failed AS kept FROM f)",
    ]
    jsd = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END) / 2"
    limit = lambda base, n, bins: f"({base * base} + ({bins} - 1 + 4 * sqrt(2 * ({bins} - 1))) / (8 * ln(2e0) * greatest(1, {n})))"
    for r in range(rounds):
        sums = ", ".join(f"sum({c}) / sum(word_chars) AS r_{c}" for c in names)
        steps += [
            f"r{r} AS (SELECT lang AS ref, sum(n_words) AS good, {sums} FROM f JOIN v{r} USING (doc_id) WHERE kept AND lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {LEAST_REFERENCE})",
            f"q{r} AS (SELECT c.lang AS ref, c.p, coalesce(x.n, 0) / good AS q FROM common c JOIN r{r} ON ref = c.lang LEFT JOIN (SELECT lang, p, sum(n) AS n FROM dc JOIN f USING (doc_id) JOIN v{r} USING (doc_id) WHERE kept GROUP BY lang, p) x ON x.lang = c.lang AND x.p = c.p)",
            f"b{r} AS (SELECT ref, count(p) AS k, coalesce(sum(q), 0) AS q FROM r{r} LEFT JOIN q{r} USING (ref) GROUP BY ref)",
            f"c{r} AS (SELECT doc_id, ref, " + " + ".join(jsd(f"({c} / greatest(1, word_chars))", f"r_{c}") for c in names) + f" AS by_class FROM f, r{r})",
            f"i{r} AS (SELECT f.doc_id, b.ref, sum({jsd('(coalesce(d.n, 0) / greatest(1, n_words))', 'coalesce(q.q, 0)')}) AS inner_, coalesce(sum(d.n), 0) / greatest(1, any_value(n_words)) AS p, any_value(b.q) AS bq FROM f CROSS JOIN b{r} b LEFT JOIN q{r} q USING (ref) LEFT JOIN dc d ON d.doc_id = f.doc_id AND d.p = q.p GROUP BY f.doc_id, b.ref)",
            f"e{r} AS (SELECT doc_id, ref, inner_ + {jsd('(1 - p)', '(1 - bq)')} AS by_word FROM i{r})",
            f"h{r} AS (SELECT DISTINCT doc_id FROM c{r} JOIN e{r} USING (doc_id, ref) JOIN f USING (doc_id) JOIN b{r} USING (ref) WHERE (word_chars < {LEAST_CHARS} OR by_class <= {limit(CHAR_LIMIT, 'word_chars', str(len(names)))}) AND (n_words < {LEAST_WORDS} OR by_word <= {limit(WORD_LIMIT, 'n_words', '(k + 1)')}))",
            f"v{r + 1} AS (SELECT doc_id, NOT base_failed AND (doc_id IN (FROM h{r}) OR NOT EXISTS (FROM r{r}) OR lang IS NOT NULL AND lang NOT IN (SELECT ref FROM r{r})) AS kept FROM f)",
        ]
    return "WITH " + ", ".join(steps) + f" SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM f JOIN v{rounds} USING (doc_id)"


ORACLE_SQL = _sql(ROUNDS)
