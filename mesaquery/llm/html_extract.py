"""HTML extraction by equivalence classes of template tokens.

1. *Occurrence vectors.* A token is a tag with its class, id and role, or a text between two tags. Over
   the pages of one host, its vector has how often it occurs on each page. Vectors are never built: the
   sum over pages of a hash of (page, count) stands for one, so that equal vectors have equal sums, and
   partial sums add up anywhere. The same sums over all hosts make a common template for hosts of few
   pages. Pages without tags, such as null and empty ones, don't count.
2. *Classes.* Tokens of one host and one vector that occur on ``SHARE`` of its pages form a class. The
   outer class is the one that occurs once on most pages, on ``SHARE`` of them at least; its tokens in
   their mean order are valid where a page has them once in that order. Other classes are valid where
   a page repeats their tokens in order and each repetition lies in one slot of the classes before it,
   more widespread first: there they nest and cut that slot further.
3. *Slots.* The classes cut a page into slots, which the tokens around them name. Slots whose open
   template elements are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
   comments are left out; of the others, those of the innermost main element are taken. A page without
   main elements has all others but those of one text on all pages of its template, ``LEAST_PAGES`` at
   least, and texts of the template; where these are all that it has, they stay.
4. Within a slot, elements of those kinds that the template doesn't know are skipped by the same
   rules, the rest is cut into blocks, character references are decoded and white space is joined.

Defined results: null and empty pages have an empty text; a page whose tokens don't fit the template,
or whose main element isn't in it, is judged by its own elements; a null URL belongs to the host of
empty name; repeated rows are each extracted; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesaquery.llm.common import saved, with_small
from mesaquery.llm.url_filter import parts

#: A host of fewer pages uses the common template; a template token is on this share of pages.
LEAST_PAGES, SHARE = 3, 0.6
#: Tokens that a class needs to be a template.
LEAST_TOKENS = 3

_RAW = "script|style|noscript|template|textarea|iframe|svg|title|xmp"
# Quotes hold a ">" only as an attribute's value. Nothing is tried twice (possessive quantifiers), and what
# isn't closed goes up to the end, so that the scan takes linear time on any page.
_INSIDE = r"""(?:[^>="']++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
_TOKEN = re.compile(rf"""(?is)<!--(?:-?>|.*?--!?>|.*\Z)|<({_RAW})(?=[\s/>])(?:{_INSIDE})>(?:.*?</\1(?=[\s/>])[^>]*+>|.*\Z)|<(/?)([a-z][^\s/>]*+)({_INSIDE})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""")
_ATTRIBUTE = re.compile(r"""(?s)([^\s/>="']++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""")
_CLOSED = re.compile(rf"(?is)<!--(?:-?>|.*?--!?>)\Z|<({_RAW})(?=[\s/>])(?:{_INSIDE})>.*?</\1(?=[\s/>])[^>]*+>\Z|<(?!(?:{_RAW})[\s/>])/?[a-z][^\s/>]*+(?:{_INSIDE})>\Z|<[!?/](?!--)[^>]*+>\Z")
_BEGINS = re.compile(r"(?i)<[a-z!?/]")
_TELLING = ("class", "id", "role")
#: Elements, and whole classes, ids and roles, of what isn't main text.
ASIDE_TAGS = frozenset("head nav header footer aside form button select dialog menu object audio video canvas".split())
ASIDE_WORDS = re.compile(r"(?i)(?:(?:site|page|main|global|top|bottom|primary|secondary|cookie|post|article|entry|social|privacy|mobile)[_-])?(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|complementary|consent|contentinfo|cookies?|disqus|footer|gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|pager|popup|promo\w*|recommend\w*|related|replies|respond|search|share|sharing|sidebar\w*|side|signup|social|sponsor\w*|subscribe|tags?|toolbar|widgets?)(?:[_-](?:area|banner|bar|block|box|buttons?|container|content|form|inner|items?|links?|list|menu|nav|notice|outer|section|wrap|wrapper))?")
MAIN_TAGS = ("article", "main")
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Piece:
    """One tag or text of a page."""

    __slots__ = ("a", "b", "close", "name", "aside", "main", "key")

    def __init__(self, a: int, b: int, close: bool, name: str, attributes: str):
        self.a, self.b, self.close, self.name = a, b, close, name
        marks = sorted((k, m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes) if (k := m[1].lower()) in _TELLING) if "=" in attributes else []
        words = [w for _, v in marks for w in v.split()]
        self.main = not close and (name in MAIN_TAGS or any(k == "role" and v == "main" for k, v in marks))
        self.aside = not close and (name in ASIDE_TAGS or bool(words) and name not in ("html", "body") and any(map(ASIDE_WORDS.fullmatch, words)))
        self.key = "/" * close + name + "".join(f" {k}={v}" for k, v in marks)


def pieces_of(page: str) -> list[Piece]:
    """All tags of a page outside raw elements and comments, which are pieces without a name."""
    out = []
    # Behind the last ">" there are no whole tags, but the first that begins swallows what is left.
    stop = page.rfind(">") + 1
    for m in _TOKEN.finditer(page, 0, stop):
        if m[3]:
            out.append(Piece(m.start(), m.end(), bool(m[2]), m[3].lower(), m[4]))
        else:
            out.append(Piece(m.start(), m.end(), False, "", ""))
    if out and out[-1].b == stop and not _CLOSED.match(page, out[-1].a, stop):
        out[-1].b = len(page)
    elif m := _BEGINS.search(page, stop):
        out.append(Piece(m.start(), len(page), False, "", ""))
    return out


def elements(pieces: list[Piece]) -> list[int]:
    """For each opening piece the number of the piece that closes it; itself if none does."""
    ends, open_ = list(range(len(pieces))), {}
    for i, p in enumerate(pieces):
        if not p.name or p.name in VOID_TAGS:
            continue
        if not p.close:
            open_.setdefault(p.name, []).append(i)
        elif open_.get(p.name):
            ends[open_[p.name].pop()] = i
    return ends


def keep_main(pieces: list[Piece], ends: list[int]) -> None:
    """A main element isn't aside, nor is what holds one, except where that is itself inside another."""
    open_: list[int] = []
    for i, p in enumerate(pieces):
        while open_ and ends[open_[-1]] < i:
            open_.pop()
        if p.main:
            p.aside = False
            if not any(pieces[k].main for k in open_):
                for k in open_:
                    pieces[k].aside = False
        if not p.close and ends[i] > i:
            open_.append(i)


def texts_between(page: str, pieces: list[Piece]) -> Iterator[tuple[int, Piece]]:
    """Texts between pieces as pieces themselves, and the number of the piece that follows each."""
    import xxhash

    at = 0
    for i in range(len(pieces) + 1):
        stop = pieces[i].a if i < len(pieces) else len(page)
        if stop > at and (text := " ".join(page[at:stop].split())):
            piece = Piece(at, stop, False, "", "")
            piece.key = "=" + xxhash.xxh3_64_hexdigest(text)
            yield i, piece
        at = pieces[i].b if i < len(pieces) else at


def _with_texts(page: str, pieces: list[Piece], wanted: set[str]) -> list[Piece]:
    """``pieces`` and the texts between them that the template has."""
    out, done = [], 0
    for i, piece in texts_between(page, pieces):
        if piece.key in wanted:
            out += [*pieces[done:i], piece]
            done = i
    return out + pieces[done:]


def main_text(page: str, template: list[list[str]] | None = None, fixed: frozenset[str] = frozenset()) -> str:
    """Main text of one page; ``template`` has the classes' tokens in order, ``fixed`` slots of one text."""
    pieces = pieces_of(page)
    ends = elements(pieces)
    keep_main(pieces, ends)
    if template and not any(p.main and ends[i] > i for i, p in enumerate(pieces)):
        whole = _with_texts(page, pieces, {t for tokens in template for t in tokens if t[0] == "="})
        ends_ = elements(whole)
        if found := _slots(whole, ends_, template):
            # A template text is a cut: none of the slots that it bounds has it.
            own = [(a, b) for a, b in found[0] if slot_name(whole, a, b) not in fixed]
            if text := _joined_text(page, whole, ends_, own):
                return text
    slots = _slots(pieces, ends, [[t for t in tokens if t[0] != "="] for tokens in template or []])
    ranges = _by_elements(pieces, ends) if slots is None or not slots[1] and any(p.main and ends[i] > i for i, p in enumerate(pieces)) else slots[0]
    return _joined_text(page, pieces, ends, ranges)


def _joined_text(page: str, pieces: list[Piece], ends: list[int], slots: list[tuple[int, int]]) -> str:
    return "\n".join(block for a, b in _joined(slots) for block in _blocks(page, pieces, ends, a, b))


def slot_name(pieces: list[Piece], a: int, b: int) -> str:
    return pieces[a].key + "\n" + (pieces[b].key if b < len(pieces) else "")


def _cuts(pieces: list[Piece], template: list[list[str]]) -> list[int] | None:
    """Pieces that cut a page into slots, the outer class's and nested ones'; None where it doesn't fit."""
    wanted = {t for tokens in template for t in tokens}
    places: dict[str, list[int]] = {}
    for i, p in enumerate(pieces):
        if p.key in wanted:
            places.setdefault(p.key, []).append(i)
    cuts = [i for t in template[0] for i in places.get(t, ())]
    if len(cuts) != len(template[0]) or len(set(cuts)) < LEAST_TOKENS or any(len(places.get(t, ())) != 1 for t in template[0]) or cuts != sorted(cuts):
        return None
    for tokens in template[1:]:
        at, k = sorted(i for t in tokens for i in places.get(t, ())), len(tokens)
        if not at or [pieces[i].key for i in at] != tokens * (len(at) // k):
            continue
        if all(bisect_right(cuts, at[j]) == bisect_right(cuts, at[j + k - 1]) for j in range(0, len(at), k)):
            cuts = sorted(cuts + at)
    return cuts


def _slots(pieces: list[Piece], ends: list[int], template: list[list[str]]) -> tuple[list[tuple[int, int]], bool] | None:
    """Ranges of pieces, (after, up to), of the wanted slots, and whether they are of main elements.

    None where the template doesn't fit.
    """
    template = [tokens for tokens in template if tokens]
    at = _cuts(pieces, template) if template else None
    if at is None:
        return None
    bounds = [*zip(at, at[1:], strict=False), (at[-1], len(pieces))]
    open_: list[int] = []
    main: list[tuple[int, int]] = []
    plain: list[tuple[int, int]] = []
    for a, b in bounds:
        while open_ and ends[open_[-1]] <= a:
            open_.pop()
        if not pieces[a].close and ends[a] > a:
            open_.append(a)
        if any(pieces[i].aside for i in open_) and not _own_header(pieces, open_):
            continue
        (main if any(pieces[i].main for i in open_) else plain).append((a, b))
    return main or plain, bool(main)


def _joined(slots: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Adjacent slots as one: an inline template tag between them doesn't end a block."""
    out: list[tuple[int, int]] = []
    for a, b in slots:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _own_header(pieces: list[Piece], open_: list[int]) -> bool:
    """Whether the only odd element is a header inside a main element: an article's own heading."""
    odd = [k for k, i in enumerate(open_) if pieces[i].aside]
    return all(pieces[open_[k]].name == "header" and any(pieces[i].main for i in open_[:k]) for k in odd)


def _by_elements(pieces: list[Piece], ends: list[int]) -> list[tuple[int, int]]:
    out, skip = [], -1
    for i, p in enumerate(pieces):
        if i <= skip or p.close or not p.name:
            continue
        if p.aside and ends[i] > i:
            skip = ends[i]
        elif p.main and ends[i] > i:
            out.append((i, ends[i]))
            skip = ends[i]
    return out or [(-1, len(pieces))]


def _blocks(page: str, pieces: list[Piece], ends: list[int], first: int, last: int) -> list[str]:
    """Texts of the blocks between piece ``first`` and piece ``last``."""
    out: list[str] = []
    parts_: list[str] = []

    def close() -> None:
        if block := " ".join(html.unescape("".join(parts_)).split()):
            out.append(block)
        parts_.clear()

    inside = first >= 0 and (pieces[first].main or not pieces[first].close)
    i, at = first + 1, pieces[first].b if first >= 0 else 0
    while i <= last:
        stop = pieces[i].a if i < len(pieces) else len(page)
        if stop > at:
            parts_.append(page[at:stop])
        if i >= last:
            break
        p = pieces[i]
        if p.aside and ends[i] > i and not (inside and p.name == "header"):
            close()
            i = ends[i]
            if i >= last:
                break
            p = pieces[i]
        if p.name in BLOCK_TAGS:
            close()
        at, i = p.b, i + 1
    close()
    return out


def templates_of(pages: DataFrame) -> DataFrame:
    """host, template (the classes' tokens in order, the outer class first) of rows (host, page, html).

    The common template of all pages has a null host.
    """

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sums: dict[tuple[str, str], list] = {}
            for host, page, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found: Counter[str] = Counter()
                place: dict[str, int] = {}
                pieces = pieces_of(text or "")
                for k, p in enumerate(pieces):
                    if p.name:
                        found[p.key] += 1
                        place.setdefault(p.key, k)
                if not found:
                    continue  # null, empty or plain: nothing that a template could be on
                for k, p in texts_between(text, pieces):
                    found[p.key] += 1
                    place.setdefault(p.key, k - 0.5)
                found["#page"] += 1
                for key, n in found.items():
                    row = sums.setdefault((host, key), [0, 0, 0, 0.0])
                    row[0] += 1
                    row[1] += n == 1
                    row[2] = (row[2] + xxhash.xxh3_64_intdigest(f"{page}/{n}")) & ((1 << 62) - 1)
                    row[3] += place.get(key, 0) / max(1, len(found))
            if sums:
                rows = [(h, k, *v) for (h, k), v in sums.items()]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                names = ("host", "token", "pages", "once", "vector", "place")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})

    # Sums of 62-bit parts wrap by a modulus, as sums of decimals that can't overflow do.
    modulus = F.lit(1 << 62).cast("decimal(38,0)")
    sums = [F.sum("pages").alias("pages"), F.sum("once").alias("once"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"), F.sum("place").alias("place")]
    own = saved(pages.select("host", "page", "html").mapInArrow(occurrences, "host string, token string, pages long, once long, vector long, place double").groupBy("host", "token").agg(*sums), "vectors")
    # A token of one page is in no host's template: texts, most of them, go no further.
    totals = own.where("token = '#page'").select("host", F.col("pages").alias("all_pages"))
    every = totals.agg(F.coalesce(F.sum("all_pages"), F.lit(0))).first()[0]
    tokens = own.where("token <> '#page'")
    of_hosts = tokens.where("pages > 1").join(totals.where(F.col("all_pages") >= LEAST_PAGES), "host").where(F.col("pages") >= SHARE * F.col("all_pages"))
    common = tokens.groupBy("token").agg(*sums).where(F.col("pages") >= SHARE * every)
    common = common.select(F.lit(None).cast("string").alias("host"), "token", "pages", "once", "vector", "place", F.lit(every).cast("long").alias("all_pages"))
    often = of_hosts.select(*common.columns).union(common).withColumn("vector", F.col("vector") % modulus)
    # A class: one host's tokens of one vector. The outer one has each token once on most pages.
    classes = often.groupBy("host", "vector").agg(F.count("*").alias("size"), F.min(F.when(F.col("once") >= SHARE * F.col("all_pages"), F.col("once")).otherwise(0)).alias("outer"), F.first("pages").alias("pages"), F.array_sort(F.collect_list(F.struct((F.col("place") / F.col("pages")).alias("at"), "token"))).alias("tokens"))
    first = Window.partitionBy("host").orderBy(F.desc("outer"), F.desc("size"), "vector")
    ranked = classes.where(F.col("size") >= LEAST_TOKENS).withColumn("rank", F.row_number().over(first)).withColumn("best", F.max("outer").over(Window.partitionBy("host")))
    # Hosts without an outer class have none; the others' classes by how widespread they are.
    order = F.struct((F.col("rank") > 1).alias("inner"), (-F.col("pages")).alias("pages"), "rank", F.col("tokens.token").alias("tokens"))
    return ranked.where("best > 0").groupBy("host").agg(F.array_sort(F.collect_list(order)).alias("found")).select("host", F.col("found.tokens").alias("template"))


def fixed_of(joined: DataFrame, common: list[list[str]] | None) -> DataFrame:
    """host, fixed (names of slots with one text on all pages) of rows (host, html, template).

    Of pages without main elements, which alone drop such slots. Those of the common template have a
    null host.
    """

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows: dict[tuple[str | None, str], list[int]] = {}
            for host, page, template in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                used, pieces = template or common, pieces_of(page or "")
                ends = elements(pieces)
                if not used or any(p.main and ends[i] > i for i, p in enumerate(pieces)):
                    continue
                keep_main(pieces, ends)
                pieces = _with_texts(page or "", pieces, {t for tokens in used for t in tokens if t[0] == "="})
                ends = elements(pieces)
                seen = set()
                for a, b in (_slots(pieces, ends, used) or ((), False))[0]:
                    name, h = slot_name(pieces, a, b), xxhash.xxh3_64_intdigest("\n".join(_blocks(page, pieces, ends, a, b))) >> 1
                    row = rows.setdefault((host if template else None, name), [h, h, 0])
                    row[:2] = min(row[0], h), max(row[1], h)
                    row[2] += name not in seen
                    seen.add(name)
            if rows:
                columns = zip(*((h, n, *v) for (h, n), v in rows.items()), strict=True)
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(("host", "slot", "low", "high", "pages"), columns, kinds, strict=True)})

    found = joined.select("host", "html", "template").mapInArrow(contents, "host string, slot string, low long, high long, pages long")
    slots = found.groupBy("host", "slot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pages").alias("pages"))
    return slots.where((F.col("low") == F.col("high")) & (F.col("pages") >= LEAST_PAGES)).groupBy("host").agg(F.collect_list("slot").alias("fixed"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of the main text of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    hosted = rows.withColumn("host", parts(F.col("url"))[0])
    templates = saved(templates_of(hosted.select("host", F.col("page_id").alias("page"), "html")), "templates")
    common = next((r[0] for r in templates.where("host IS NULL").select("template").collect()), None)  # one row at most
    own = templates.where("host IS NOT NULL")
    # Templates are wide: their bytes count, 16 of them as a row.
    size = own.agg(F.coalesce(F.sum(F.length(F.array_join(F.flatten("template"), ""))), F.lit(0))).first()[0] // 16
    joined = with_small(hosted, own, ["host"], "left", size)
    fixed = saved(fixed_of(joined, common), "fixed")
    common_fixed = frozenset(x for r in fixed.where("host IS NULL").select("fixed").collect() for x in r[0])  # slots of one template
    size = fixed.agg(F.coalesce(F.sum(F.length(F.array_join("fixed", ""))), F.lit(0))).first()[0] // 16
    joined = with_small(joined, fixed.where("host IS NOT NULL"), ["host"], "left", size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", template, frozenset(known or ())) if template else main_text(page or "", common, common_fixed) for page, template, known in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))})

    kind = dict(rows.dtypes)["page_id"]
    return joined.select("page_id", "url", "html", "template", "fixed").mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
